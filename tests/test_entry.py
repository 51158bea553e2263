import importlib

import duckdb
import pytest

from conftest import SF_SMOKE

E = importlib.import_module("__spark_entry__")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_query_has_an_oracle():
    assert set(E._own_queries()) == set(E._own_oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


FAST = ["text_expand", "record_filter", "text_pipeline", "header_detect", "headed_project",
        "align_typed", "cycle_replace", "file_disposition"]


@pytest.mark.parametrize("key", FAST)
def test_queries_match_oracle_smoke(spark, duck, key):
    got = E.queries()[key](spark, SF_SMOKE).toPandas()
    want = duck.sql(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)

    import pandas as pd

    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        return v.item() if hasattr(v, "item") else v

    def rows(pdf):
        return sorted(repr(tuple(cell(v) for v in r))
                      for r in pdf[cols].astype(object).itertuples(index=False, name=None))
    assert rows(got) == rows(want)


def test_entry_works_without_the_training_data_subpackage():
    """Other queries stay where the subpackage and its pipeline module are not installed."""
    import subprocess
    import sys
    root = importlib.import_module("os").path.dirname(E.__file__)
    for gone in ("corpus_pipeline", "sluice.llm"):
        code = (f"import sys; sys.modules['{gone}'] = None; import __spark_entry__ as E; "
                "assert set(E.queries()) == set(E._own_queries()) == set(E.oracle_sql())")
        subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
