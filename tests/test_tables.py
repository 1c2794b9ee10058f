"""Tables that are appended to and updated whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from roadtally.sources import tables
from roadtally.sources.tables import Conflict, Table

SCHEMA = "id long, annee int, tmja int, note string"
ROWS = [(1, 2019, 10, "a"), (2, 2019, None, "b"), (3, 2020, 30, None), (4, None, 40, "d"), (5, 2021, 50, "e")]


@pytest.fixture
def table(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t")
    t.append(spark.createDataFrame(ROWS, SCHEMA), batch="first")
    return t


def rows(t):
    return sorted(map(tuple, t.read().collect()))


def files(t):
    root = t.path.removeprefix("file://")
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{root}/data") for f in fs if f.endswith(".parquet")}


def test_append(spark, table):
    more = spark.createDataFrame([("x", 60, 2020, 6), ("y", 70, 2022, 7)], "note string, tmja int, annee int, id long")
    for _ in range(2):  # a delivery is taken in once
        table.append(more, batch="second")
    assert rows(table) == sorted([*ROWS, (6, 2020, 60, "x"), (7, 2022, 70, "y")])
    assert table.read().columns == ["id", "annee", "tmja", "note"]


def test_merge_rewrites_touched_partitions_only(spark, table):
    before = files(table)
    new = spark.createDataFrame([(1, 11), (2, 22), (4, 44), (9, 99)], "id long, tmja int")
    table.merge(new, ["id"], ["tmja"], only_when=F.col("tmja").isNull() | (F.col("id") == 4))
    assert rows(table) == sorted([(1, 2019, 10, "a"), (2, 2019, 22, "b"), (3, 2020, 30, None), (4, None, 44, "d"), (5, 2021, 50, "e")])
    kept = {f for f in before if "annee=2020" in f or "annee=2021" in f}
    assert {f for f in files(table) if "annee=2020" in f or "annee=2021" in f} == kept
    table.clean()
    assert files(table) & before == kept and len(rows(table)) == 5


def test_merge_inserts(spark, table):
    new = spark.createDataFrame([(1, 2019, 11), (1, 2020, 12), (8, 2023, 80)], "id long, annee int, tmja int")
    table.merge(new, ["id"], ["tmja"], insert=True)
    assert rows(table) == sorted([(1, 2019, 11, "a"), *ROWS[1:], (1, 2020, 12, None), (8, 2023, 80, None)])


def test_merge_without_a_match(spark, table):
    table.merge(spark.createDataFrame([(100, 1)], "id long, tmja int"), ["id"], ["tmja"])
    assert rows(table) == sorted(ROWS)


@pytest.mark.parametrize("step", ["_write", "_commit"])
def test_a_job_that_dies_changes_nothing_and_can_run_again(spark, table, monkeypatch, step):
    new = spark.createDataFrame([(1, 2019, 11), (8, 2023, 80)], "id long, annee int, tmja int")
    whole = getattr(Table, step)

    def die(self, *args):
        if step == "_write":
            whole(self, *args)
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Table, step, die)
        for run in (lambda: table.merge(new, ["id"], ["tmja"], insert=True, batch="b"), lambda: table.append(spark.createDataFrame(ROWS, SCHEMA), batch="c")):
            with pytest.raises(KeyboardInterrupt):
                run()
            assert rows(table) == sorted(ROWS)
    for _ in range(2):
        table.merge(new, ["id"], ["tmja"], insert=True, batch="b")
        assert rows(table) == sorted([(1, 2019, 11, "a"), *ROWS[1:], (8, 2023, 80, None)])


def test_a_manifest_that_was_cut_off_does_not_count(spark, table):
    path = f"{table.path.removeprefix('file://')}/manifests"
    for n, text in ((2, ""), (3, '{"version": 3, "lo')):
        with open(f"{path}/{n:09d}.json", "w") as f:
            f.write(text)
    assert rows(table) == sorted(ROWS)
    table.append(spark.createDataFrame(ROWS[:1], SCHEMA))
    assert rows(table) == sorted([*ROWS, ROWS[0]]) and table.manifest().version == 4


def test_of_two_batches_from_one_version_one_wins(spark, table, monkeypatch):
    other, write = Table(spark, table.path), Table._write

    def slow(self, df, batch):
        out = write(self, df, batch)
        if self is table:
            other.append(spark.createDataFrame(ROWS[:1], SCHEMA))
        return out

    monkeypatch.setattr(Table, "_write", slow)
    with pytest.raises(Conflict):
        table.append(spark.createDataFrame(ROWS[1:2], SCHEMA))
    assert rows(table) == sorted([*ROWS, ROWS[0]])


def test_no_table(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        Table(spark, f"file://{tmp_path}/none").read()
    t = Table(spark, f"file://{tmp_path}/empty")
    t.append(spark.createDataFrame([], SCHEMA))
    assert t.read().collect() == [] and tables.Table is Table
