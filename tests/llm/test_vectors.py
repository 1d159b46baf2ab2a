"""Clusters and hard negatives against plain Python, and the bounds they rest on."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillhouse.llm import drift_clusters, hard_negatives
from tillhouse.llm.drift_clusters import cluster_report, clustered, loosening
from tillhouse.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, vector string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "c", "v", "n") for i, v, y in rows], SCHEMA)


def odd_vectors(seed, n=240, size=64):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(size)] for _ in range(9)]
    rows = []
    for i in range(n):
        c = centres[0] if i % 3 == 0 else rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, 0.1) for x in c], rng.randrange(4)))
    rows += [(5, rows[5][1], 1), (5, rows[5][1], 1), (100, rows[100][1], 2), (7, rows[9][1], 3)]  # repeated ids and rows
    same = [0.25] * size
    rows += [(n + i, same, i % 3) for i in range(60)]  # a group of copies
    rows += [(900, None, 1), (901, [0.5] * (size - 1), 1), (902, [None] + [0.1] * (size - 1), 1), (903, [math.nan] * size, 1),
             (904, [math.inf] + [0.0] * (size - 1), 1), (905, [], 1), (None, same, 1), (906, [0.0] * size, None), (800, [-0.3] * size, 2)]
    return rows


def takes_part(v, size=64):
    return v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)


def clusters_by_force(rows, k, rounds):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if takes_part(v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        members = {}
        for (_, v), (_, j) in zip(kept, assign()):
            members.setdefault(j, []).append(v)
        centroids = [[sum(x) // len(members[j]) for x in zip(*members[j])] if j in members else c for j, c in enumerate(centroids)]
    last = assign()
    spread = Counter()
    for d, j in last:
        spread[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, j, d, spread[j], sum(spread.values()), digest[j]) for (i, _), (d, j) in zip(kept, last))


@pytest.mark.parametrize("seed,k,rounds", [(1, 16, 3), (2, 5, 6), (3, 1, 2)])
def test_clusters_match_brute_force(spark, seed, k, rounds):
    rows = odd_vectors(seed)
    got = Counter(map(tuple, cluster_report(frame(spark, rows).repartition(5), k, rounds).collect()))
    assert got == clusters_by_force(rows, k, rounds)


def test_fewer_vectors_than_clusters(spark):
    rows = odd_vectors(4)[:6]
    assert Counter(map(tuple, cluster_report(frame(spark, rows)).collect())) == clusters_by_force(rows, 16, 3)
    empty = cluster_report(frame(spark, rows).where("false"))
    assert empty.collect() == [] and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert cluster_report(frame(spark, [(1, None, 1), (2, [1.0], 1)])).collect() == []


def test_large_components_stay_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randrange(6) for _ in range(64)], 1) for i in range(120)]
    assert Counter(map(tuple, cluster_report(frame(spark, rows)).collect())) == clusters_by_force(rows, 16, 3)
    assert cluster_report(frame(spark, [(1, [1e300] * 64, 1), (2, [-1e300] * 64, 1)])).count() == 2


def test_loosening_bounds_every_vector_and_is_less_than_the_drift():
    rng = np.random.default_rng(5)
    less = 0
    for _ in range(200):
        old = rng.normal(size=(6, 4)) * 10
        new = old + rng.normal(size=(6, 4)) * rng.choice([0.1, 1, 10])
        radius = rng.random(6) * 8
        bound = loosening(old, new, radius)
        drift = np.linalg.norm(new - old, axis=1)
        for i in range(6):
            way = rng.normal(size=(400, 4))
            x = old[i] + radius[i] * rng.random((400, 1)) ** 0.25 * way / np.linalg.norm(way, axis=1, keepdims=True)
            for j in range(6):
                came = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                assert came.max() <= bound[i, j] + 1e-9
        assert (bound <= drift + 1e-9).all()
        less += (bound < 0.9 * drift).mean()
    assert less / 200 > 0.4


def test_bounds_spare_scans(spark):
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(8)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in centres[i % 8]], 1) for i in range(300)]
    found = clustered(frame(spark, rows), k=8, rounds=4)
    scans = found.rows.agg(F.sum("scans")).first()[0]
    assert scans < 300 * 4
    assert Counter(map(tuple, cluster_report(frame(spark, rows), 8, 4).collect())) == clusters_by_force(rows, 8, 4)


def negatives_by_force(rows, label, is_anchor, positives=5, negatives=10, low=30, high=90):
    kept = [(i, [math.floor(256 * x) for x in v], label(i, y)) for i, v, y in rows if takes_part(v) and y is not None]
    behind = lambda i: (i is None, i or 0)
    out = Counter()
    for n, (i, a, y) in enumerate(kept):
        if i is None or not is_anchor(i):
            continue
        scored = [(-sum(p * q for p, q in zip(a, v)), behind(j), j, z) for m, (j, v, z) in enumerate(kept) if m != n]
        scored.sort(key=lambda r: r[:2])
        for p, _, pid, _ in [r for r in scored if r[3] == y][:positives]:
            window = [r for r in scored if r[3] != y and low * -p <= 100 * -r[0] <= high * -p]
            out.update((i, pid, k, r[2], -p, -r[0]) for k, r in enumerate(window[:negatives], 1))
    return out


def moved_label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def label(i, y):
    return (y + 1) % 10 if i is not None and i % 7 == 0 else y


@pytest.mark.parametrize("block,gathered", [(8192, 1_000_000), (3, 50)])
def test_negatives_match_brute_force(spark, monkeypatch, block, gathered):
    monkeypatch.setattr(hard_negatives, "GATHERED", gathered)
    monkeypatch.setattr(hard_negatives, "CELLS", gathered * 4)
    for seed in (1,):
        rows = odd_vectors(seed)
        got = hard_negatives.hard_negatives(frame(spark, rows).repartition(6), moved_label(), F.col("vec_id") % 20 == 0, block=block)
        want = negatives_by_force(rows, label, lambda i: i % 20 == 0)
        assert Counter(map(tuple, got.collect())) == want and len(want) > 100


def test_negatives_of_large_components(spark):
    rng = random.Random(6)
    rows = [(i, [abs(rng.gauss(0, 1)) * 10 ** rng.randrange(5) for _ in range(64)], i % 3) for i in range(150)]
    got = hard_negatives.hard_negatives(frame(spark, rows), moved_label(), F.col("vec_id") % 20 == 0)
    assert Counter(map(tuple, got.collect())) == negatives_by_force(rows, label, lambda i: i % 20 == 0)


def test_negatives_of_small_tables(spark):
    none = F.col("vec_id") % 100 == 0
    nothing = hard_negatives.hard_negatives(frame(spark, []), moved_label(), none)
    assert nothing.collect() == [] and nothing.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    alone = hard_negatives.hard_negatives(frame(spark, [(100, [0.5] * 64, 1), (101, [0.5] * 64, 2)]), moved_label(), none)
    assert alone.collect() == []  # no positive
    pair = [(100, [0.5] * 64, 1), (102, [0.5] * 64, 1), (101, [0.2] * 64, 2), (103, [0.01] * 64, 2)]
    got = hard_negatives.hard_negatives(frame(spark, pair), moved_label(), none)
    assert [tuple(r) for r in got.collect()] == list(negatives_by_force(pair, label, lambda i: i == 100)) and got.count() == 1


def test_queries_give_the_contract_columns(spark):
    sf = "/root/testdata/sf0.001"
    assert QUERIES["op11_centroid_clusters"](spark, sf).columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert QUERIES["op12_hard_negatives"](spark, sf).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert drift_clusters.K == 16 and hard_negatives.NEGATIVES == 10
