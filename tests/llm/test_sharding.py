"""Shards over virtual slots: places, sizes, versions and moves."""

import random
import zlib
from collections import Counter, defaultdict

import xxhash
from odd_rows import AWKWARD, frame

from tillhouse.llm.queries import QUERIES
from tillhouse.llm.sharding import SLOTS, Slot, SlotMaps, dealt, keyed, placed, rebalanced, sharded, slot_sizes, write_shards


def slot_of(doc_id, crc):
    """Spark's hash of a long: xxHash with seed 42 over its eight bytes, as a signed number."""
    h = xxhash.xxh64_intdigest((crc if doc_id is None else doc_id).to_bytes(8, "little", signed=True), 42)
    return (h - (1 << 64) if h >> 63 else h) % SLOTS


def by_force(rows, shards):
    """``doc_id, size, crc, shard, slot, virtual slot`` by plain Python: a first map, then places."""
    facts = []
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        facts.append((doc_id, len(data) + 1, zlib.crc32(data), slot_of(doc_id, zlib.crc32(data))))
    held = Counter()
    for f in facts:
        held[f[3]] += f[1]
    load, where = [0] * shards, {}
    for v in sorted(range(SLOTS), key=lambda v: (-held[v], v)):
        where[v] = min(range(shards), key=lambda s: (load[s], s))
        load[where[v]] += held[v]
    facts.sort(key=lambda f: (f[3], f[0] is not None, f[0] or 0, f[2], f[1]))
    place, out = Counter(), []
    for f in facts:
        out.append((f[0], f[1], f[2], where[f[3]], place[where[f[3]]], f[3]))
        place[where[f[3]]] += 1
    return Counter(out), load


def rows_of(df):
    return Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"], r["virtual_slot"]) for r in df.collect())


def test_places_match_brute_force(spark, awkward, nothing):
    rng = random.Random(3)
    many = [(i, "same text" if i % 3 == 0 else "x" * int(rng.expovariate(1 / 400)) + "é", "a") for i in range(2500)] + [(-7, "minus", "b"), (8, None, "b")]
    for rows, df in ((AWKWARD, awkward), (many, frame(spark, many))):
        assert rows_of(sharded(df)) == by_force(rows, 16)[0]
    assert sharded(nothing).collect() == []


def test_query_keeps_its_law(spark):
    for rows in [QUERIES["op13_sharding"](spark, "/root/testdata/sf0.01").collect()]:
        size, places = Counter(), defaultdict(list)
        for r in rows:
            size[r["shard"]] += r["size"]
            places[r["shard"]].append(r["slot"])
        assert all(sorted(p) == list(range(len(p))) for p in places.values())
        mean = sum(size.values()) / 16
        assert len(size) == 16 and max(abs(s - mean) for s in size.values()) < max(0.01 * mean, max(r["size"] for r in rows))
        assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_maps_are_versions_and_rebalancing_moves_little(spark, tmp_path):
    rng = random.Random(4)
    docs = [(i, "x" * int(rng.expovariate(1 / 500)), "a") for i in range(3000)]
    maps = SlotMaps(spark, str(tmp_path / "maps"))
    df = frame(spark, docs)
    assert maps.versions() == [] and maps.rebalance(df, 16) == 1
    first = maps.where()
    assert maps.rebalance(df, 16) == 2 and maps.where() == first  # nothing to mend, nothing moves
    assert maps.rebalance(df, 17) == 3
    grown = maps.where()
    moved = {v for v, s in grown.items() if s != first[v]}
    assert all(grown[v] == 16 for v in moved)  # the new shard takes slots, no other pair swaps
    sizes = {s.number: s.bytes for s in slot_sizes(keyed(df))}
    total = sum(sizes.values())
    assert abs(sum(sizes[v] for v in moved) - total / 17) < 0.02 * total / 17
    assert maps.rebalance(df, 15) == 4  # shards 15 and 16 are gone
    before, after = maps.where(3), maps.where(4)
    assert set(after.values()) == set(range(15)) and sum(before[v] < 15 and before[v] != after[v] for v in after) < SLOTS // 50
    assert maps.where(1) == first and [r["version"] for r in maps.read(2).limit(1).collect()] == [2]
    # documents come and go; their slots stay, and the map is edited only as far as needed
    later = frame(spark, docs[500:] + [(10_000 + i, "y" * 900, "b") for i in range(500)])
    maps.rebalance(later, 15)
    load, where = Counter(), maps.where()
    for s in slot_sizes(keyed(later)):
        load[where[s.number]] += s.bytes
    assert max(load.values()) - min(load.values()) < 0.01 * sum(load.values()) / 15


def test_an_unfinished_version_does_not_count(spark, tmp_path):
    maps = SlotMaps(spark, str(tmp_path))
    maps.rebalance(frame(spark, [(1, "a", "x")]), 4)
    maps.rebalance(frame(spark, [(1, "a", "x"), (2, "b", "x")]), 4)
    (tmp_path / "2" / "_SUCCESS").unlink()
    assert maps.versions() == [1]
    assert maps.rebalance(frame(spark, [(2, "b", "x")]), 4) == 2 and maps.versions() == [1, 2]


def test_shard_files_hold_the_rows_in_order(spark, awkward, tmp_path):
    maps = SlotMaps(spark, str(tmp_path / "maps"))
    maps.rebalance(awkward, 4)
    write_shards(awkward, maps.read(), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    key = lambda r: (str(r["doc_id"]), str(r["text"]), r["source"], r["slot"])
    assert sorted(map(key, (r["doc"] for r in back.collect()))) == sorted(map(key, awkward.collect()))
    want = {(r["shard"], r["slot"], r["doc_id"]) for r in placed(awkward, maps.read()).collect()}
    assert {(r["shard"], r["slot"], r["doc"]["doc_id"]) for r in back.collect()} == want


def test_a_slot_larger_than_a_shard_does_not_loop():
    slots = [Slot(0, 1000, 1), Slot(1, 10, 1), Slot(2, 10, 1), Slot(3, 0, 0)]
    where = dealt(slots, [0, 0])
    assert where[0] != where[1] == where[2] and rebalanced(slots, where, 2) == where
    assert set(rebalanced(slots, {0: 0, 1: 0, 2: 0, 3: 5}, 3).values()) <= {0, 1, 2}
