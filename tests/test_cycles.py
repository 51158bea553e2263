import os

import pytest

from conftest import local_path
from sluice.errors import IntakeError
from sluice.sinks import cycles as C
from sluice.sources.files import create_new

SCHEMA = "v int, billcycle string"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def seen(spark, root, version=None):
    return sorted(map(tuple, C.read_cycles(spark, root, version).collect()))


def test_a_load_replaces_its_cycles_and_keeps_the_others(spark, scratch):
    root = scratch("cycles")
    assert C.commit_cycles(rows(spark, (1, "BC01"), (2, "BC01"), (3, "BC02")), root) == 1
    assert C.commit_cycles(rows(spark, (9, "BC01")), root) == 2
    assert seen(spark, root) == [(3, "BC02"), (9, "BC01")]
    assert seen(spark, root, 1) == [(1, "BC01"), (2, "BC01"), (3, "BC02")]
    # a load may read what it replaces
    C.commit_cycles(C.read_cycles(spark, root).selectExpr("v + 10 AS v", "billcycle"), root)
    assert seen(spark, root) == [(13, "BC02"), (19, "BC01")]
    assert C.commit_cycles(rows(spark), root) == 4       # nothing to replace
    assert seen(spark, root) == [(13, "BC02"), (19, "BC01")]


def test_a_load_that_dies_before_its_commit_changes_nothing(spark, scratch):
    root = scratch("cycles-crash")
    C.commit_cycles(rows(spark, (1, "BC01"), (2, "BC02")), root)
    C.stage_cycles(rows(spark, (8, "BC01"), (9, "BC01")), root)     # written, never committed
    assert seen(spark, root) == [(1, "BC01"), (2, "BC02")]

    bad = spark.range(40).selectExpr(
        "CAST(IF(id = 39, raise_error('lost'), id) AS int) AS v", "'BC01' AS billcycle")
    with pytest.raises(Exception, match="lost"):         # dies while writing
        C.commit_cycles(bad, root)
    assert seen(spark, root) == [(1, "BC01"), (2, "BC02")]
    C.commit_cycles(rows(spark, (5, "BC01")), root)      # the next load is not disturbed
    assert seen(spark, root) == [(2, "BC02"), (5, "BC01")]


def test_two_loads_of_one_cycle_end_as_one(spark, scratch):
    root = scratch("cycles-two")
    C.commit_cycles(rows(spark, (0, "BC01"), (0, "BC02")), root)
    one = C.stage_cycles(rows(spark, (1, "BC01"), (1, "BC01")), root)
    two = C.stage_cycles(rows(spark, (2, "BC01"), (2, "BC03")), root)
    assert (C.commit(spark, two), C.commit(spark, one)) == (2, 3)
    assert seen(spark, root) == [(0, "BC02"), (1, "BC01"), (1, "BC01"), (2, "BC03")]


def test_conflicts_are_found_by_key(spark, scratch):
    root = scratch("cycles-conflict")
    C.commit_cycles(rows(spark, (0, "BC01")), root)
    one, other = (C.stage_cycles(rows(spark, (i, c)), root) for i, c in ((1, "BC01"), (2, "BC02")))
    C.commit_cycles(rows(spark, (7, "BC01")), root)
    with pytest.raises(IntakeError, match="BC01"):
        C.commit(spark, one, on_conflict="raise")
    C.commit(spark, other, on_conflict="raise")          # other cycles do not collide
    assert seen(spark, root) == [(2, "BC02"), (7, "BC01")]


def test_a_version_taken_at_the_same_moment_is_not_replaced(spark, scratch, monkeypatch):
    root = scratch("cycles-race")
    one, two = (C.stage_cycles(rows(spark, (i, "BC01"), (i, f"BC1{i}")), root) for i in (1, 2))
    assert C.commit(spark, one) == 1
    real, answers = C.last_version, [0]                  # what the other load saw before that
    monkeypatch.setattr(C, "last_version", lambda *a: answers.pop() if answers else real(*a))
    assert C.commit(spark, two) == 2
    assert seen(spark, root) == [(1, "BC11"), (2, "BC01"), (2, "BC12")]
    assert C.live_loads(spark, root).filter("billcycle = 'BC01'").first()["load"] == two.load


def test_several_keys_with_nulls_and_odd_names(spark, scratch):
    root, key = scratch("cycles-keys"), ("billcycle", "filename")
    schema = "v int, billcycle string, filename string, `a b` string"
    first = spark.createDataFrame([(1, "BC01", "a b%_01.txt", "x"), (2, "BC01", "007", None),
                                   (3, None, "é.txt", "y")], schema)
    C.commit_cycles(first, root, key)
    C.commit_cycles(spark.createDataFrame([(4, None, "é.txt", "z")], schema), root, key)
    out = C.read_cycles(spark, root)
    assert out.columns == ["v", "a b", "billcycle", "filename"]
    assert sorted(map(tuple, out.collect()), key=repr) == [
        (1, "x", "BC01", "a b%_01.txt"), (2, None, "BC01", "007"), (4, "z", None, "é.txt")]


def test_vacuum_keeps_what_recent_versions_show(spark, scratch):
    root = scratch("cycles-vacuum")
    for i in range(4):
        C.commit_cycles(rows(spark, (i, "BC01"), *([(0, "BC02")] if i == 1 else [])), root)
    staged = C.stage_cycles(rows(spark, (9, "BC01")), root)
    removed = C.vacuum_cycles(spark, root)
    assert len(removed) == 1 and seen(spark, root, 3) == [(0, "BC02"), (2, "BC01")]
    assert seen(spark, root) == [(0, "BC02"), (3, "BC01")]
    assert C.vacuum_cycles(spark, root) == []
    C.commit(spark, staged)
    assert seen(spark, root) == [(0, "BC02"), (9, "BC01")]
    assert sorted(os.listdir(local_path(root))) == ["_commits", "data", "keys"]


def test_no_commit_is_a_missing_input(spark, scratch):
    with pytest.raises(IntakeError) as e:
        C.read_cycles(spark, scratch("cycles-none"))
    assert e.value.status == "missing_file"


def test_create_new_never_replaces(spark, scratch):
    path = scratch("new") + "/x.json"
    assert create_new(spark, path, "1") and not create_new(spark, path, "2")
    folder = local_path(path.rsplit("/", 1)[0])
    assert open(f"{folder}/x.json").read() == "1"
    assert [n for n in os.listdir(folder) if not n.endswith(".crc")] == ["x.json"]
