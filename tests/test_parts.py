"""Tables of parts: dimensions in current and closed parts, and snapshots that share what has not changed."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import scd
from tillhouse.sources import manifests, sinks
from tillhouse.sources.dimensions import CLOSED, Dimension

ATTRS, TRACKED, DDL = ["name", "city"], ["city"], "id string, name string, city string"


def at(month):
    return F.lit(f"2024-{month:02d}-01 00:00:00").cast("timestamp_ntz")


def folder():
    return tempfile.mkdtemp(prefix="tillhouse-") + "/t"


def files(path):
    """Data files with the time they were written."""
    found = {}
    for top, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                found[os.path.relpath(os.path.join(top, n), path)] = os.stat(os.path.join(top, n)).st_mtime_ns
    return found


def rows_of(df):
    return sorted(map(str, df.collect()))


def dimension(spark, path, bucket_rows=20):
    return Dimension(spark, path, "id", "key", ATTRS, TRACKED, bucket_rows)


def people(spark, ids, city="X"):
    return spark.createDataFrame([(f"p{i}", f"N{i}", city) for i in ids], DDL)


def test_split_dimension_holds_the_rows_of_a_merge(spark):
    """New, changed, untouched, renamed, missing, repeated and null values over four batches, the buckets growing on the way."""
    store = dimension(spark, folder())
    batches = [
        people(spark, range(50)),
        spark.createDataFrame([("p1", "N1", "Y"), ("p2", "other", "X"), ("p3", "N3", None), ("new", "N", "Z"), ("new", "N", "Z")], DDL),
        people(spark, range(20, 220), "W"),
        spark.createDataFrame([("p3", "N3", "X"), ("p1", None, "Y"), ("p30", "N30", "V")], DDL),
    ]
    store.take(batches[0], at(1))
    whole = scd.initial_load(batches[0], "id", "key", ATTRS, at(1))
    sizes = [store.table.manifest().buckets]
    for month, batch in enumerate(batches[1:], 2):
        store.take(batch, at(month))
        whole = scd.merge(whole, batch, "id", "key", ATTRS, TRACKED, at(month))
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        assert rows_of(store.versions()) == rows_of(whole)
        assert rows_of(store.current()) == rows_of(scd.current(whole)) and store.table.manifest().rows == store.current().count()
        sizes.append(store.table.manifest().buckets)
    assert sizes == [3, 3, 12, 12]


def test_a_small_batch_writes_no_other_bucket_and_no_history(spark):
    path = folder()
    store = dimension(spark, path, 10)
    store.take(people(spark, range(200)), at(1))
    store.take(people(spark, range(40), "Y"), at(2))
    before, parts = files(f"{path}/parts"), store.table.manifest().parts
    store.take(people(spark, [3], "Z"), at(3))
    after, now = files(f"{path}/parts"), store.table.manifest().parts
    new = {f for f in after if f not in before}
    assert all(after[f] == before[f] for f in after if f in before)
    assert {f.split("/")[0] for f in new} == {"version=3"} and len({f.split("/")[1] for f in new}) == 2
    assert {(p, v) for p, v in parts if p == CLOSED} < now and len(parts - now) == 1
    store.take(people(spark, [3], "Z"), at(4))
    store.take(people(spark, [], "Z"), at(5))
    assert store.table.manifest().number == 3  # nothing changed, nothing was committed
    assert f"part={CLOSED}" in str(store.versions().inputFiles()) and f"part={CLOSED}" not in str(store.current().inputFiles())


def test_a_commit_cut_short_leaves_the_dimension_as_it_was(spark, monkeypatch):
    path = folder()
    store = dimension(spark, path)
    store.take(people(spark, range(30)), at(1))
    before = rows_of(store.versions())
    batch = people(spark, range(5, 35), "Y")

    def fail(*args):
        raise RuntimeError("lost")

    for name in ("_publish", "_clean"):
        with monkeypatch.context() as m:
            m.setattr(manifests.PartTable, name, fail)
            with pytest.raises(RuntimeError, match="lost"):
                store.take(batch, at(2))
        if name == "_publish":
            assert rows_of(store.versions()) == before
            os.makedirs(f"{path}/manifest/v000002")  # a manifest without its marker does not count
            assert rows_of(store.versions()) == before
    store.take(batch, at(2))
    whole = scd.merge(scd.initial_load(people(spark, range(30)), "id", "key", ATTRS, at(1)), batch, "id", "key", ATTRS, TRACKED, at(2))
    assert rows_of(store.versions()) == rows_of(whole)


def test_parts_no_manifest_names_are_deleted(spark):
    path = folder()
    store = dimension(spark, path, 1000)
    for month, city in enumerate("ABCDE", 1):
        store.take(people(spark, range(3), city), at(month))
    assert len(os.listdir(f"{path}/manifest")) == 2
    manifest, earlier = store.table.manifest(), store.table.manifest(store.table.manifest().number - 1)
    kept = {(f.split("/")[1][5:], int(f.split("/")[0][8:])) for f in files(f"{path}/parts")}
    assert kept == manifest.parts | earlier.parts
    assert store.table.read(manifest=earlier).where("is_current and city = 'D'").count() == 3


def test_a_dimension_kept_in_versions_is_taken_over(spark):
    path = folder()
    whole = scd.initial_load(people(spark, range(30)), "id", "key", ATTRS, at(1))
    whole = scd.merge(whole, people(spark, range(9), "Y"), "id", "key", ATTRS, TRACKED, at(2))
    sinks.overwrite_table(whole, path)
    store = dimension(spark, path)
    store.take(people(spark, range(4), "Z"), at(3))
    want = scd.merge(whole, people(spark, range(4), "Z"), "id", "key", ATTRS, TRACKED, at(3))
    assert rows_of(store.versions()) == rows_of(want) and store.table.manifest().number == 2
    assert not [n for n in os.listdir(path) if n.startswith("v")]


def test_an_empty_dimension(spark):
    store = dimension(spark, folder())
    store.take(people(spark, []), at(1))
    assert store.versions().collect() == [] and "key" in store.versions().columns
    store.take(people(spark, [1]), at(2))
    assert store.current().count() == 1


# ---- snapshots -----------------------------------------------------------

DAY = [dt.date(2024, 1, i) for i in range(1, 5)]


def lines(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, part date")


def test_a_snapshot_copies_changed_partitions_only(spark):
    root = folder()
    area = f"{root}/bi"
    first = lines(spark, [(f"k{i}", 1, DAY[i % 3]) for i in range(30)] + [("none", 1, None)])
    sinks.incremental_upsert(spark, f"{root}/fact", first, ["k"], "part")
    store = dimension(spark, f"{root}/dim", 10)
    store.take(people(spark, range(60)), at(1))
    sinks.overwrite_table(spark.range(4).toDF("x"), f"{root}/days")
    stored = {n: f"{root}/{n}" for n in ("fact", "dim", "days")}
    snapshot = manifests.Snapshot(spark, area)
    record = snapshot.publish({**stored, "extra": spark.range(2).toDF("y")}, at(1))
    assert [tuple(r) for r in record.collect()] == [(dt.datetime(2024, 1, 1), "success")]
    assert rows_of(snapshot.read("fact")) == rows_of(first) and snapshot.read("fact").schema == first.schema
    assert rows_of(snapshot.read("dim")) == rows_of(store.versions()) and snapshot.read("days").count() == 4

    before = files(area)
    snapshot.publish(stored, at(2))
    assert {f for f in files(area) if f not in before} == {f for f in files(area) if f.startswith("_snapshots/v000002")}

    sinks.incremental_upsert(spark, f"{root}/fact", lines(spark, [("k1", 2, DAY[3]), ("k2", 2, DAY[2])]), ["k"], "part")
    store.take(people(spark, [7], "Y"), at(3))
    before = files(area)
    snapshot.publish(stored, at(3))
    new = {f.rsplit("/", 1)[0] for f in files(area) if f not in before and not f.startswith("_")}
    touched = {f"fact/snapshot_copy=3/part={d}" for d in (DAY[1], DAY[2], DAY[3])}
    assert {n for n in new if n.startswith("fact")} == touched
    assert len({n for n in new if n.startswith("dim")}) == 2 and not any(n.startswith("days") for n in new)
    assert rows_of(snapshot.read("fact")) == rows_of(spark.read.schema(first.schema).parquet(f"{root}/fact"))
    assert rows_of(snapshot.read("dim")) == rows_of(store.versions())


def test_readers_see_all_tables_of_a_snapshot_or_none(spark, monkeypatch):
    root = folder()
    for name in "ab":
        sinks.overwrite_table(spark.range(3).toDF("x"), f"{root}/{name}")
    stored = {n: f"{root}/{n}" for n in "ab"}
    snapshot = manifests.Snapshot(spark, f"{root}/bi")
    snapshot.publish(stored, at(1))
    for name in "ab":
        sinks.overwrite_table(spark.range(5).toDF("x"), f"{root}/{name}")
    with pytest.raises(FileNotFoundError):
        snapshot.publish({**stored, "c": f"{root}/missing"}, at(2))
    assert [snapshot.read(n).count() for n in "ab"] == [3, 3]
    snapshot.publish(stored, at(2))
    assert [snapshot.read(n).count() for n in "ab"] == [5, 5]
    for month in (3, 4):
        sinks.overwrite_table(spark.range(month).toDF("x"), f"{root}/a")
        snapshot.publish(stored, at(month))
    assert sorted(os.listdir(f"{root}/bi/_snapshots")) == ["v000003", "v000004"]
    assert sorted(os.listdir(f"{root}/bi/a")) == ["snapshot_copy=3", "snapshot_copy=4"] and snapshot.read("b").count() == 5
