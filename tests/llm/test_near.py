"""Near-duplicates, components, line dedup and fingerprints."""

import hashlib
import random
from collections import Counter

import brute
import pytest
from odd_rows import frame
from pyspark.sql import functions as F

from tillhouse.llm import near_dedup, spotsigs
from tillhouse.llm.components import components
from tillhouse.llm.cuckoo import CuckooFilter
from tillhouse.llm.line_dedup import LineStore, dedup_lines


def varied(seed, groups, copies, words, edits):
    """Groups of texts that are edited copies of one another."""
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(words)] = f"x{rng.randrange(9999)}"
            out.append(" ".join(text))
    rng.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("rows", [varied(1, 12, 6, 60, 4), varied(2, 2, 60, 80, 5), varied(3, 40, 2, 12, 2)])
def test_near_duplicates_match_brute_force(spark, rows):
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert [got[i] for i, _ in rows] == brute.near(rows)


def test_wide_regions_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rows = varied(4, 1, 90, 70, 9)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == brute.near(rows)


def test_awkward_documents(awkward, nothing):
    got = sorted(tuple(r) for r in near_dedup.near_duplicates(awkward).collect())
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect() if r["doc_id"] is not None]
    want = sorted((d, len(brute.shingles(t)), c, d == c) for (d, t), c in zip(rows, brute.near(rows)))
    assert got == want
    assert near_dedup.near_duplicates(nothing).collect() == []
    kept = near_dedup.without_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert Counter(ids) == Counter({1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 1, 9: 1, 10: 1, 11: 1, None: 2})
    assert near_dedup.without_near_duplicates(nothing).collect() == []


def test_components_of_a_long_chain_and_a_hub(spark):
    rng = random.Random(5)
    names = list(range(400))
    rng.shuffle(names)
    edges = [(names[i], names[i + 1]) for i in range(199)] + [(names[200], names[i]) for i in range(201, 400)] + [(7000, 7000), (names[3], names[2])]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert len(got) == 400
    assert {got[n] for n in names[:200]} == {min(names[:200])} and {got[n] for n in names[200:]} == {min(names[200:])}


def kept_lines(rows):
    keys = [[(line, line.strip(" \t\n\x0b\x0c\r")) for line in (t or "").split("\n")] for _, t in rows]
    lower = lambda s: "".join(c.lower() if c.isascii() else c for c in s)
    docs = {}
    for (d, _), lines in zip(rows, keys):
        for _, k in lines:
            if len(k) >= 40 and d is not None:
                docs.setdefault(lower(k), set()).add(d)
    out = []
    for (d, _), lines in zip(rows, keys):
        stay = [line for line, k in lines if d is None or not (len(k) >= 40 and len(docs[lower(k)]) >= 5 and d < max(docs[lower(k)]))]
        out.append((d, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return Counter(out)


def line_rows(first, last):
    common, other = "A line that is found in Many documents of this corpus", "another line of more than forty characters, repeated"
    return [(i, "\n".join([f"own line {i}", common if i % 2 else f" \t{common.upper()}", other if i % 3 == 0 else "short", other if i % 6 == 0 else ""])) for i in range(first, last)]


def resolved(store, docs):
    return Counter(tuple(r) for r in store.resolve(docs).collect())


def test_lines_come_and_go(spark, tmp_path):
    a, b = line_rows(0, 13), line_rows(13, 20)
    docs = lambda rows: frame(spark, rows)
    store = LineStore(spark, f"{tmp_path}/store")
    store.insert(docs(a))
    before = resolved(store, docs(a))
    assert before == kept_lines(a)
    store.insert(docs(b))
    assert resolved(store, docs(a + b)) == kept_lines(a + b)
    store.delete(docs(b))
    assert resolved(store, docs(a)) == before
    store.delete(docs(a[4:]))
    assert resolved(store, docs(a[:4])) == kept_lines(a[:4])
    assert store.repeated().count() == 0
    assert not any(CuckooFilter.load([bytes(s) for s in r["segments"]]).segments[0].any() for r in store.filters().collect())
    store.insert(docs(a[4:]))
    assert resolved(store, docs(a)) == before
    assert Counter(map(tuple, store.candidates(docs(a), filter_bytes=0).collect())) >= Counter(map(tuple, store.candidates(docs(a)).collect()))


def test_lines_of_awkward_documents(spark, awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert Counter(tuple(r) for r in dedup_lines(awkward).collect()) == kept_lines(rows)
    assert dedup_lines(nothing).collect() == []
    twice = line_rows(0, 6) + line_rows(0, 6)
    assert Counter(tuple(r) for r in dedup_lines(frame(spark, twice)).collect()) == kept_lines(twice)


def test_cuckoo_filter_grows_and_forgets():
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(3000)]
    f = CuckooFilter(16)
    f.insert(keys)
    assert len(f.segments) > 1 and f.contains(keys).all()
    others = [hashlib.md5(b"o%d" % i).digest() for i in range(20000)]
    assert f.contains(others).mean() < 0.01
    f.delete(keys[:2000])
    assert f.contains(keys[2000:]).all() and f.contains(keys[:2000]).mean() < 0.01
    f.delete(keys[2000:])
    assert not any(s.any() for s in f.segments)


def test_fingerprints_of_awkward_documents(spark, awkward, nothing):
    rows = spotsigs.fingerprints(awkward)
    got = rows.select("doc_id", "text", "edited_text", "own", spotsigs.likeness(F.col("own"), F.col("edited_own")).alias("l")).collect()
    ids = sorted({r["doc_id"] for r in got if r["doc_id"] is not None})
    text_of = {}
    for r in awkward.collect():
        if r["doc_id"] is not None:
            text_of[r["doc_id"]] = min(text_of.get(r["doc_id"], r["text"] or ""), r["text"] or "")
    assert len(got) == awkward.count()
    for r in got:
        at = ids.index(r["doc_id"]) if r["doc_id"] is not None else None
        after = text_of[ids[-1] if at is None else ids[at - 1]]
        half = len(r["text"]) // 2
        assert r["edited_text"] == r["text"][:len(r["text"]) - half] + after[:half]
        assert 0 <= r["l"] <= 1 and (r["own"] == []) == (r["text"] == "")
    assert spotsigs.fingerprints(nothing).collect() == []


def test_chains():
    import tillhouse.session

    spark = tillhouse.session.local_session()
    text = "Cats chase the mice of an old barn, and sleep"
    got = spark.createDataFrame([(text,)], "text string").select(spotsigs.signatures(F.col("text")).alias("s")).first()["s"]
    want = [" cats chase ", " mice # old ", " old barn ", " sleep "]
    assert got == sorted(hashlib.md5(c.encode()).hexdigest()[:8] for c in want)


def test_long_runs_of_common_words(spark):
    text = "start " + "Und " * 200_000 + "middle " + "word " * 100_000 + "!" * 100_000 + " end"
    got = spark.createDataFrame([(text,), ("the " * 300_000,)], "text string").select(F.size(spotsigs.signatures(F.col("text"))).alias("n")).collect()
    assert [r["n"] for r in got] == [2, 1]


def test_near_pairs_match_brute_force(spark):
    rows = varied(6, 15, 5, 40, 6)
    sets = spark.createDataFrame(rows, "name long, text string").select("name", spotsigs.signatures(F.regexp_replace("text", r"(\S+ \S+)", "$1 the")).alias("own"))
    sets = sets.dropDuplicates(["own"]).cache()
    own = {r["name"]: set(r["own"]) for r in sets.collect()}
    want = {(a, b) for a in own for b in own if a < b and len(own[a] & own[b]) >= 0.6 * len(own[a] | own[b])}
    assert {(r["a"], r["b"]) for r in spotsigs.near_pairs(sets, 0.6).collect()} == want and want
