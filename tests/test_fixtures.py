import os

from pyspark.sql import functions as F

from sluice import fixtures as fx
from conftest import SF_SMOKE, local_path


def test_named_files_one_per_name_in_order(spark, scratch):
    folder = scratch("fx-named")
    df = spark.range(0, 500).select(
        F.concat(F.lit("f_"), (F.col("id") % 3).cast("string"), F.lit(".txt")).alias("fname"),
        F.col("id").cast("string").alias("value"), "id")
    files = fx.write_named_files(df, "fname", ["id"], folder)
    assert sorted(os.path.basename(f) for f in files) == ["f_0.txt", "f_1.txt", "f_2.txt"]
    for k in range(3):
        lines = open(os.path.join(local_path(folder), f"f_{k}.txt")).read().split("\n")[:-1]
        assert lines == [str(i) for i in range(k, 500, 3)]


def test_csv_cell_quoting(spark):
    df = spark.createDataFrame([("a,b",), ('say "hi"',), ("plain",)], "c string")
    got = [r[0] for r in df.select(fx.csv_cell(F.col("c"))).collect()]
    assert got == ['"a,b"', '"say ""hi"""', "plain"]


def test_order_files_match_cycle_names(spark, scratch):
    folder = scratch("fx-orders")
    files = fx.write_order_files(spark, SF_SMOKE, folder)
    names = {os.path.basename(f) for f in files}
    want = {r[0] for r in fx.table(spark, SF_SMOKE, "orders").select(
        fx.cycle_file_name(F.col("o_orderstatus"), F.col("o_orderkey"))).distinct().collect()}
    assert names == want
