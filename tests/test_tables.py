"""Tables replaced by commit: untouched files stay, first loads are merged, renames are seen whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline import sinks, tables


def _files(root, table):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(os.path.join(root, table)) for f in names if f.endswith(".parquet")}


def test_upsert_rewrites_touched_parts_alone(spark, tmpdir_path):
    first = spark.createDataFrame([(f"k{i}", v, f"{i}.{v}") for i in range(200) for v in (1, 2)] + [("k0", 2, "tie")], "k string, v int, x string")
    touched = tables.upsert(spark, first, tmpdir_path, "t", ["k"], "v", buckets=16)
    assert len(touched) == 16
    rows = tables.read_table(spark, tmpdir_path, "t")
    assert rows.count() == 200 and rows.where("v = 2").count() == 200  # the first load is merged, too
    before = tables.manifest(spark, tmpdir_path)[1]["t"]
    files = _files(tmpdir_path, "t")
    new = spark.createDataFrame([("k3", 5, "new"), ("k4", 1, "old"), ("z", 1, "more")], "k string, v int, x string")
    touched = tables.upsert(spark, new, tmpdir_path, "t", ["k"], "v", buckets=16)
    assert 1 <= len(touched) <= 3
    after = tables.manifest(spark, tmpdir_path)[1]["t"]
    assert {p for p in after if after[p] != before.get(p)} == set(touched)
    now = _files(tmpdir_path, "t")
    assert all(now[f] == t for f, t in files.items())  # written once, never changed
    got = {r.k: r.x for r in tables.read_table(spark, tmpdir_path, "t").where("k in ('k3', 'k4', 'z')").collect()}
    assert got == {"k3": "new", "k4": "4.2", "z": "more"}
    assert tables.upsert(spark, new.limit(0), tmpdir_path, "t", ["k"], "v", buckets=16) == []


def test_replace_one_client(spark, tmpdir_path):
    schema = "client string, id string, n int"
    rows = spark.createDataFrame([("A/1", "x", 1), ("A/1", "y", 1), ("B", "z", 1), (None, "q", 1)], schema)
    tables.create(spark, tmpdir_path, {"t": (rows, "client")})
    files = _files(tmpdir_path, "t")
    tables.replace_parts(spark, spark.createDataFrame([("A/1", "x", 2), ("B", "other", 9)], schema), tmpdir_path, "t", "client", ["A/1"])
    got = {(r.client, r.id, r.n) for r in tables.read_table(spark, tmpdir_path, "t").collect()}
    assert got == {("A/1", "x", 2), ("B", "z", 1), (None, "q", 1)}
    now = _files(tmpdir_path, "t")
    assert all(now[f] == t for f, t in files.items())
    tables.replace_parts(spark, rows.limit(0), tmpdir_path, "t", "client", ["B"])  # no rows: the part goes
    assert {r.client for r in tables.read_table(spark, tmpdir_path, "t").collect()} == {"A/1", None}


def test_rename_is_seen_whole_or_not_at_all(spark, tmpdir_path, monkeypatch):
    dim = spark.createDataFrame([("a", "Old"), ("b", "Kept"), ("c", "New")], "code string, client string")
    fact = spark.createDataFrame([("Old", 1), ("New", 2), ("Kept", 3), (None, 4)], "client string, n int")
    ops = spark.createDataFrame([("m1", "Old"), ("m1", "Kept"), ("m2", "Kept")], "month string, who string")
    tables.create(spark, tmpdir_path, {"dim": (dim, "client"), "fact": (fact, "client"), "ops": (ops, "month")})
    columns = {"dim": ("client", "client"), "fact": ("client", "client"), "ops": ("who", "month")}

    def state():
        return {(t, str(tuple(r))) for t in columns for r in tables.read_table(spark, tmpdir_path, t).collect()}
    before, files = state(), _files(tmpdir_path, "fact")
    whole, calls = tables.write_parts, []

    def fails(*args):
        calls.append(args[2])
        if len(calls) == 3:
            raise OSError("lost")
        return whole(*args)
    monkeypatch.setattr(tables, "write_parts", fails)
    with pytest.raises(OSError):
        tables.rename_everywhere(spark, tmpdir_path, columns, {"Old": "New"})
    assert len(calls) == 3 and state() == before  # two tables were written, none is seen
    monkeypatch.setattr(tables, "write_parts", whole)
    touched = tables.rename_everywhere(spark, tmpdir_path, columns, {"Old": "New"})
    assert touched == {"dim": ["New", "Old"], "fact": ["New", "Old"], "ops": ["m1"]}
    assert {r.client for r in tables.read_table(spark, tmpdir_path, "dim").collect()} == {"New", "Kept"}
    assert sorted((r.client or "", r.n) for r in tables.read_table(spark, tmpdir_path, "fact").collect()) == [("", 4), ("Kept", 3), ("New", 1), ("New", 2)]
    assert sorted(map(tuple, tables.read_table(spark, tmpdir_path, "ops").collect())) == [("m1", "Kept"), ("m1", "New"), ("m2", "Kept")]
    now = _files(tmpdir_path, "fact")
    assert all(now[f] == t for f, t in files.items())


def test_commit_conflict(spark, tmpdir_path):
    rows = spark.createDataFrame([("A", 1)], "client string, n int")
    tables.create(spark, tmpdir_path, {"t": (rows, "client")})
    number, _ = tables.manifest(spark, tmpdir_path)
    tables.commit(spark, tmpdir_path, number, {})
    with pytest.raises(RuntimeError):
        tables.commit(spark, tmpdir_path, number, {"t": {"A": None}})
    assert tables.read_table(spark, tmpdir_path, "t").count() == 1


def test_pointer_switch_and_first_load_of_small_tables(spark, tmpdir_path):
    twice = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("l", 1, "c")], "id string, v int, x string")
    sinks.upsert(spark, twice, f"{tmpdir_path}/dim", ["id"], "v")
    first = sinks.current_version(spark, f"{tmpdir_path}/dim")
    assert {r.id: r.x for r in spark.read.parquet(first).collect()} == {"k": "b", "l": "c"}
    sinks.upsert(spark, twice.where("id = 'l'").withColumn("v", F.lit(9)).withColumn("x", F.lit("d")), f"{tmpdir_path}/dim", ["id"], "v")
    second = sinks.current_version(spark, f"{tmpdir_path}/dim")
    assert second != first and {r.id: r.x for r in spark.read.parquet(second).collect()} == {"k": "b", "l": "d"}
