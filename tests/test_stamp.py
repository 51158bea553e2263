import pytest
from pyspark.sql import functions as F

from sluice.operators.stamp import (FILE_COL, ROW_COL, SIZE_COL, positions, split_counts,
                                    stamp_rows, uncut_size)
from sluice.sources.text import read_lines
from sluice.errors import IntakeError
from conftest import write_text_files


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_are_dense_in_file_order_across_many_splits(spark, scratch):
    folder = scratch("stamp")
    files = {f"f{k:02d}.txt": "".join(f"{k}:{i}\n" for i in range(1, 2000 * (k % 4 + 1)))
             for k in range(12)}
    files["empty_lines.txt"] = "a\n\n\nb\n\n"
    write_text_files(folder, files)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        stamped = stamp_rows(read_lines(spark, folder))
        rows = stamped.select(F.regexp_extract(FILE_COL, r"([^/]*)$", 1).alias("f"), "value",
                              ROW_COL).collect()
        assert spark.read.text(folder).rdd.getNumPartitions() > 12
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by_file = {}
    for r in rows:
        by_file.setdefault(r["f"], []).append((r[ROW_COL], r["value"]))
    for name, text in files.items():
        got = sorted(by_file[name])
        lines = text.split("\n")[:-1] if text.endswith("\n") else text.split("\n")
        assert got == list(zip(range(1, len(lines) + 1), lines)), name


def test_files_of_one_split_are_numbered_in_one_scan(spark, scratch):
    folder = scratch("stamp-plan")
    write_text_files(folder, {"a.txt": "x\ny\n", "b.txt": "z\n"})
    plan = _plan(stamp_rows(read_lines(spark, folder)))
    assert "SinglePartition" not in plan and "Join" not in plan
    assert plan.count("FileScan text") == 1
    # the counting pass reads no file
    assert split_counts(read_lines(spark, folder)).rdd.getNumPartitions() == 0 or \
        split_counts(read_lines(spark, folder)).count() == 0
    large = read_lines(spark, folder).filter(F.col(SIZE_COL) > uncut_size(spark))
    assert large.rdd.getNumPartitions() == 0


def test_large_files_are_counted_per_split(spark, scratch):
    folder = scratch("stamp-plan-large")
    write_text_files(folder, {"a.txt": "x\n" * 9000, "b.txt": "z\n"})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        counts = {(r._file[-5:], r._block): r._n for r in
                  split_counts(read_lines(spark, folder)).collect()}
        plan = _plan(stamp_rows(read_lines(spark, folder)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sum(counts.values()) == 9000 and {f for f, _ in counts} == {"a.txt"}
    assert "BroadcastHashJoin" in plan and "SinglePartition" not in plan


def test_positions_restart_with_every_split_and_run_across_batches():
    import pyarrow as pa
    batches = [pa.array(x, pa.int64()) for x in ([7, 7, 8], [8, 8], [], [8, 9, 7], [7])]
    got = [a.to_pylist() for a in positions(iter(batches))]
    assert got == [[1, 2, 1], [2, 3], [], [4, 1, 1], [2]]


def test_splits_that_were_not_counted_fail_loudly(spark, scratch):
    folder = scratch("stamp-drift")
    write_text_files(folder, {"a.txt": "".join(f"{i}\n" for i in range(5000))})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    stamped = stamp_rows(read_lines(spark, folder))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        with pytest.raises(Exception, match="splits changed"):
            stamped.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("filtered", [False, True])
def test_numbers_hold_however_splits_are_packed(spark, scratch, filtered):
    folder = scratch("stamp-packing")
    write_text_files(folder, {f"s{k}.txt": "".join(f"{k}:{i}\n" for i in range(1, 2001))
                              for k in range(8)})
    keys = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k, None) for k in keys]
    # large: every file has splits of 4 KB, dealt to more or fewer tasks by their open cost
    for large, packings in ((False, [("1", None), ("3", None), ("40", None)]),
                            (True, [("1", "1"), ("1", "2000"), ("1", "9000")])):
        size = spark.conf.get("spark.sql.files.maxPartitionBytes")
        if large:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        try:
            stamped = stamp_rows(read_lines(spark, folder))
            if filtered:
                stamped = stamped.filter(F.col("value").endswith(":7"))
            for values in packings:
                for k, v in zip(keys, values):
                    spark.conf.set(k, v) if v else spark.conf.unset(k)
                rows = stamped.select("value", ROW_COL).collect()
                assert len(rows) == (8 if filtered else 16000)
                assert all(int(r.value.split(":")[1]) == r[ROW_COL] for r in rows)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            for k, v in zip(keys, old):
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_missing_path(spark, scratch):
    with pytest.raises(IntakeError) as e:
        read_lines(spark, scratch("nothing-here") + "/x.txt")
    assert e.value.status == "missing_file"


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(sizes=st.lists(st.integers(min_value=0, max_value=3000), min_size=1, max_size=6),
       split=st.sampled_from([1024, 2048, 8192, 1 << 20]), seed=st.integers(0, 1000))
def test_stamp_exact_for_any_split_layout(spark, scratch, sizes, split, seed):
    import random
    rnd = random.Random(seed)
    folder = scratch("stamp-prop")
    files = {}
    for k, n in enumerate(sizes):
        lines = ["x" * rnd.randint(0, 40) for _ in range(n)]
        files[f"p{k}.txt"] = "".join(line + "\n" for line in lines)
    write_text_files(folder, files)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        rows = stamp_rows(read_lines(spark, folder)).select(
            F.regexp_extract(FILE_COL, r"([^/]*)$", 1).alias("f"), "value", ROW_COL).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = {}
    for r in rows:
        got.setdefault(r["f"], []).append((r[ROW_COL], r["value"]))
    for name, text in files.items():
        want = list(enumerate(text.split("\n")[:-1], start=1))
        assert sorted(got.get(name, [])) == want, name


def test_shuffle_fallback_numbers_equal_broadcast(spark, scratch):
    folder = scratch("stamp-fallback")
    write_text_files(folder, {f"q{k}.txt": "".join(f"{k}-{i}\n" for i in range(700 * (k + 1)))
                              for k in range(4)})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        a = stamp_rows(read_lines(spark, folder)).select("value", ROW_COL).collect()
        fallback = stamp_rows(read_lines(spark, folder), broadcast_bytes=0)
        plan = fallback._jdf.queryExecution().executedPlan().toString()
        b = fallback.select("value", ROW_COL).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert "SinglePartition" not in plan
