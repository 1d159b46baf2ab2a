"""Quality grades by ordinal cumulative-link regression on hashed text.

All grades share one weight per feature, and ordered thresholds cut the score: P(grade <= k) is
sigmoid(threshold[k] - score).  Features are the words of a text without the punctuation at their end, that
punctuation, and the text's shape (share of distinct words, of upper case, length), each present or not and
hashed into ``2 ** HASH_BITS`` places.  An L1 penalty keeps most weights at zero, so that words which say
nothing about quality don't add up over long texts.

Ratings: 0 toxic, 1 of low quality, 2 good.  The model is fitted on ``SAMPLE_ROWS`` rated documents at most,
taken by the hash of their ids; all documents are scored over their whole texts.  A document is kept if the
probability of the highest grade is at least one half.

A null text scores as an empty one.  Rated rows without quality are left out unless toxic; the lowest rating
of a document counts.  Without any rating nothing is known, and all documents are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.texts import hashes, pieces, slices, strings, whole
from tillhouse.session import materialise

HASH_BITS = 18
SAMPLE_ROWS = 20_000
GRADES = 3
ROUNDS, RATE, PENALTY = 120, 0.5, 2e-4
#: Features summed up at once while fitting.
RUN = 1 << 20
#: Bytes of text whose features are made at once: a feature takes some tens of bytes in arrays, a text far more than its own.
FEATURE_BYTES = 4 << 20
TAIL = ".,;:!?*#$%&|"


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows whose features are made together."""
    return slices(batch, limit=FEATURE_BYTES)


def shape_features(texts: pa.Array, counts: np.ndarray, distinct: np.ndarray) -> list[list[str]]:
    """What a text looks like, in steps."""
    chars = np.maximum(np.asarray(pc.utf8_length(texts)).astype(np.int64), 1)
    upper = np.asarray(pc.utf8_length(pc.replace_substring_regex(texts, "[^A-Z]+", ""))).astype(np.int64)
    ratio = np.minimum(distinct * 10 // np.maximum(counts, 1), 10)
    size = np.log2(np.maximum(counts, 1)).astype(np.int64) // 2
    return [[f"\tdistinct {r} {s}", f"\tupper {u}", f"\tlength {s}"] for r, u, s in zip(ratio.tolist(), np.minimum(upper * 10 // chars, 10).tolist(), size.tolist())]


def features(texts: pa.Array, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of each feature present, once per row and place; only those with a weight if given."""
    n, places = len(texts), 1 << HASH_BITS
    counts, codes, vocabulary = pieces(pc.ascii_lower(texts))
    rows = np.repeat(np.arange(n), counts)
    heads = pc.utf8_rtrim(vocabulary, TAIL)
    place_of_head = (hashes(strings(heads)) % np.uint64(places)).astype(np.int64)
    cut = np.asarray(pc.subtract(pc.utf8_length(vocabulary), pc.utf8_length(heads)))
    names = strings(vocabulary)
    place_of_tail = np.full(len(names), -1, np.int64)
    with_tail = np.flatnonzero(cut > 0)
    place_of_tail[with_tail] = (hashes(["\t" + names[i][-cut[i]:] for i in with_tail]) % np.uint64(places)).astype(np.int64)
    place_of_head[np.asarray(pc.equal(heads, ""))] = -1
    distinct = np.bincount(np.unique(rows * np.int64(max(len(names), 1)) + codes) // max(len(names), 1), minlength=n) if len(codes) else np.zeros(n, np.int64)
    shapes = shape_features(texts, counts, distinct)
    shape_places = (hashes([f for row in shapes for f in row]) % np.uint64(places)).astype(np.int64)
    if weights is not None:
        place_of_head[(place_of_head >= 0) & (weights[place_of_head] == 0)] = -1
        place_of_tail[(place_of_tail >= 0) & (weights[place_of_tail] == 0)] = -1
    keys = [np.repeat(np.arange(n), 3) * places + shape_places]
    for place_of in (place_of_head, place_of_tail):
        at = place_of[codes]
        there = at >= 0
        keys.append(rows[there] * places + at[there])
    unique = np.unique(np.concatenate(keys))
    return unique // places, unique % places


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: list[float]

    def scores(self, texts: pa.Array) -> np.ndarray:
        rows, places = features(texts, self.weights)
        return np.bincount(rows, weights=self.weights[places], minlength=len(texts))

    def tail(self, score: Column, grade: int) -> Column:
        """P(grade or higher)."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(self.thresholds[grade - 1]) - score))


def fit(ends: np.ndarray, places: np.ndarray, grades: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, penalty: float = PENALTY) -> OrdinalModel:
    """Proximal AdaGrad on the mean negative log-likelihood; rows are laid one after another and end at ``ends``."""
    size = 1 << HASH_BITS
    seen = np.bincount(places, minlength=size)
    used = np.flatnonzero(seen >= 2)  # a feature of one rated document says nothing of others
    column = np.full(size, -1, np.int32)
    column[used] = np.arange(len(used))
    rows = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))
    col = column[places]
    rows, col = rows[col >= 0], col[col >= 0]
    n = len(grades)

    def summed(at: np.ndarray, values: np.ndarray, of: np.ndarray, length: int) -> np.ndarray:
        """Sum ``values[of]`` by ``at``, a run at a time, so that the driver holds no copy of all features."""
        total = np.zeros(length)
        for k in range(0, len(at), RUN):
            total += np.bincount(at[k:k + RUN], weights=values[of[k:k + RUN]], minlength=length)
        return total

    share = np.cumsum(np.bincount(grades, minlength=GRADES) + 1.0)[:-1] / (n + GRADES)
    theta = np.log(share / (1 - share))
    low, gap = theta[0], np.log(np.maximum(np.diff(theta), 1e-3))
    w, gw = np.zeros(len(used)), np.full(len(used), 1e-8)
    gt = np.full(GRADES - 1, 1e-8)
    for _ in range(rounds):
        theta = low + np.concatenate([[0], np.cumsum(np.exp(gap))])
        s = summed(rows, w, col, n)
        edges = np.concatenate([[-np.inf], theta, [np.inf]])
        with np.errstate(over="ignore", invalid="ignore"):
            a, b = sigmoid(edges[grades + 1] - s), sigmoid(edges[grades] - s)
        p = np.maximum(a - b, 1e-12)
        g = summed(col, (1 - a - b) / n, rows, len(used))
        up, down = -a * (1 - a) / p / n, b * (1 - b) / p / n
        dt = np.array([up[grades == k].sum() + down[grades == k + 1].sum() for k in range(GRADES - 1)])
        dlow, dgap = dt.sum(), np.cumsum(dt[::-1])[::-1][1:] * np.exp(gap)
        gw += g * g
        step = rate / np.sqrt(gw)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        move = np.concatenate([[dlow], dgap])
        gt += move * move
        low, gap = low - rate * dlow / np.sqrt(gt[0]), gap - rate * dgap / np.sqrt(gt[1:])
    theta = low + np.concatenate([[0], np.cumsum(np.exp(gap))])
    weights = np.zeros(size)
    weights[used] = w
    return OrdinalModel(weights, theta.tolist())


def ratings(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` from labels (doc_id, quality, toxic)."""
    grade = F.when(labels["toxic"] == 1, 0).when(labels["quality"] == 0, 1).when(labels["quality"] == 1, 2)
    rows = labels.select(labels["doc_id"].cast("long").alias("doc_id"), grade.alias("grade"))
    return rows.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on at most ``sample_rows`` rated documents.

    The sample is stored, so that Spark knows how small it is and takes it to the texts instead of shuffling those.
    """
    sample = materialise(ratings(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "rated-sample")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                rows, places = features(whole(part.column("text")))
                cuts = np.searchsorted(rows, np.arange(1, part.num_rows))
                packed = [x.astype("<u4").tobytes() for x in np.split(places, cuts)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("grade"), pa.array(packed, pa.binary())], ["doc_id", "grade", "places"])

    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    rated = texts.join(sample, "doc_id").select("doc_id", "grade", "text").mapInArrow(extract, "doc_id long, grade int, places binary")
    rows = sorted((r["doc_id"], r["grade"], bytes(r["places"])) for r in rated.collect())
    if not rows:
        return OrdinalModel(np.zeros(1 << HASH_BITS), [-np.inf] * (GRADES - 1))
    ends, grades = np.cumsum([len(r[2]) // 4 for r in rows]), np.array([r[1] for r in rows])
    places = np.frombuffer(b"".join(r[2] for r in rows), "<u4")
    del rows
    return fit(ends, places, grades)


def score_udf(docs: DataFrame, model: OrdinalModel):
    """A column function from texts to scores; the weights it sends are of fixed size."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        scores = [sent.value.scores(whole(part.column("text"))) for part in parts(batch)]
        return pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())

    return score


def kept(docs: DataFrame, model: OrdinalModel, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, as they are."""
    return docs.where(model.tail(score_udf(docs, model)(docs["text"].cast("string")), GRADES - 1) >= least)


def grade(docs: DataFrame, model: OrdinalModel, least: float = 0.5) -> DataFrame:
    """``doc_id, expected_grade, p_low_or_better, p_good, kept`` of every row of ``docs``."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), score_udf(docs, model)(docs["text"].cast("string")).alias("score"))
    p = [model.tail(F.col("score"), k) for k in range(1, GRADES)]
    return rows.select(
        "doc_id", (p[0] + p[1]).alias("expected_grade"), p[0].alias("p_low_or_better"), p[1].alias("p_good"), (p[-1] >= least).alias("kept"),
    )
