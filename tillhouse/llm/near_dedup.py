"""Near-duplicate documents by an LSH forest over MinHash signatures, with exact confirmation.

A document's set holds its distinct five-word shingles; documents are linked if the Jaccard similarity of
their sets is at least 0.75.

1. Exact copies.  Documents with the same set form one class, by a partial aggregation on a 128-bit digest of
   the set.  All later steps see each class once.
2. Forest.  ``TREES`` trees order the classes by ``DEPTH`` MinHash values each.  The orders are sorted in range
   partitions, which cut through dense regions of a tree.  A class and its neighbour in an order are candidates
   if their longest common prefix reaches ``LEAST_PREFIX``; where a region is dense, neighbours share more, so
   the depth adapts to the region.  Neighbours across partitions are met through the ends of the partitions.
3. Candidates are confirmed on full sets, and confirmed links joined to components.
4. What neighbours alone may miss: links with a similarity of a half or more bind components to wider regions.
   In a region of several components, every class outside the largest one is compared with all of the region,
   in blocks of bounded size: by signature first, and those near the threshold on full sets.  No pair inside a
   component, and no pair that isn't a link, leaves its task.

A link with similarity s is missed by all trees with probability (1 - s**3)**20, 2 in 100,000 at 0.75.

A text without words has an empty set, and a null text too: it is linked with nothing.  Rows of one doc_id
are judged each by its text.  Rows without a doc_id get no row from ``near_duplicates``.  Other columns of
the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.components import components
from tillhouse.llm.texts import hashes, shingles, slices, whole, words
from tillhouse.session import materialise

WIDTH = 5
PERCENT = 75
TREES, DEPTH, LEAST_PREFIX = 20, 6, 3
#: Similarity, in percent, that binds components to a region, and what a signature has to show before sets are compared:
#: over four standard deviations under the threshold.
LOOSE, LIKELY = 50, 0.58
#: Classes on either side of a block.
BLOCK = 256
#: Bytes of text shingled at once.
SHINGLED = 8 << 20

SETS = "doc_id long, n_shingles long, key binary, signature binary"
_FACTORS = np.random.default_rng(20).integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    counts, codes, vocabulary = words(pc.ascii_lower(texts))
    each, all_hashes = shingles(counts, hashes(vocabulary)[codes], WIDTH)
    return [np.unique(part) for part in np.split(all_hashes, np.cumsum(each)[:-1])] if len(texts) else []


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """A row of MinHash values per set; a set must not be empty."""
    out = np.empty((len(sets), len(_FACTORS)), np.uint32)
    at = 0
    while at < len(sets):  # runs of sets that stay in the cache
        stop, total = at, 0
        while stop < len(sets) and (stop == at or total + len(sets[stop]) <= 1 << 16):
            total += len(sets[stop])
            stop += 1
        run = np.concatenate(sets[at:stop])
        starts = np.cumsum([0] + [len(s) for s in sets[at:stop - 1]])
        for k, factor in enumerate(_FACTORS):
            with np.errstate(over="ignore"):
                out[at:stop, k] = np.minimum.reduceat(((run * factor) >> np.uint64(32)).astype(np.uint32), starts)
        at = stop
    return out


def digest(shingle_set: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingle_set.tobytes())


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> int:
    """Percent of similarity, rounded down, where it is at least ``percent``; else -1."""
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if 100 * small < percent * large:
        return -1
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    union = len(a) + len(b) - common
    return 100 * common // union if 100 * common >= percent * union else -1


def text_rows(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).where("doc_id is not null")


def sets_of(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, key, signature`` of each row; key and signature are null for an empty set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SHINGLED):
                sets = shingle_sets(whole(part.column("text")))
                filled = [s for s in sets if len(s)]
                values = iter(signature(filled).astype(">u4") if filled else [])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([next(values).tobytes() if len(s) else None for s in sets], pa.binary()),
                ], ["doc_id", "n_shingles", "key", "signature"])

    return text_rows(docs).mapInArrow(describe, SETS)


def forest_neighbours(classes: DataFrame) -> DataFrame:
    """``a, b``: classes (key, signature) that are neighbours in the order of some tree, with a long enough common prefix."""
    width = 4 * DEPTH
    orders = classes.select("key", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.substring("signature", t * width + 1, F.lit(width)))).alias("tree", "values"))
    ordered = orders.repartitionByRange("tree", "values", "key").sortWithinPartitions("tree", "values", "key")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, names = TaskContext.get().partitionId(), None, ["part", "tree", "values", "a", "b"]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.RecordBatch.from_arrays([batch.column(c) for c in ("tree", "values", "key")], ["tree", "values", "key"])
            if last is None:
                yield ends(rows.slice(0, 1), part, names)
            else:
                rows = pa.Table.from_batches([last, rows]).combine_chunks().to_batches()[0]
            met = neighbours(rows)
            keys = rows.column("key")
            n = len(met)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), keys.take(pa.array(met)), keys.take(pa.array(met + 1)),
            ], names)
            last = rows.slice(rows.num_rows - 1, 1)
        if last is not None:
            yield ends(last, part, names)

    found = materialise(ordered.mapInArrow(meet, "part int, tree int, values binary, a binary, b binary"), "forest")
    ahead = Window.orderBy("part", "tree", "values", "a")  # two rows per partition
    across = found.where("part is not null").select("tree", "values", "a", *[F.lead(c).over(ahead).alias(f"next_{c}") for c in ("tree", "values", "a")])
    across = across.where(
        (F.col("tree") == F.col("next_tree")) & (F.substring("values", 1, 4 * LEAST_PREFIX) == F.substring("next_values", 1, 4 * LEAST_PREFIX))
    ).select("a", F.col("next_a").alias("b"))
    pairs = found.where("part is null").select("a", "b").unionByName(across).where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def ends(row: pa.RecordBatch, part: int, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), row.column("tree").cast(pa.int32()), row.column("values"), row.column("key"), pa.nulls(1, pa.binary())], names)


def neighbours(rows: pa.RecordBatch) -> np.ndarray:
    """Places of rows whose next row is in the same tree and shares ``LEAST_PREFIX`` values."""
    tree = np.asarray(rows.column("tree"))
    values = np.frombuffer(b"".join(rows.column("values").to_pylist()), np.uint32).reshape(-1, DEPTH)[:, :LEAST_PREFIX]
    return np.flatnonzero((tree[1:] == tree[:-1]) & (values[1:] == values[:-1]).all(axis=1))


def class_texts(docs: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, text`` of one document of each class named in ``keys``."""
    wanted = classes.join(keys, "key", "left_semi").select("key", F.col("first_doc").alias("doc_id"))
    return text_rows(docs).join(wanted, "doc_id").select("key", "text")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, b, percent`` of the pairs (a, b) that are at least ``LOOSE`` percent similar by their full sets."""
    a, b = [texts.select(F.col("key").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab"]
    rows = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a", SHINGLED):
                percent = [
                    similar(x, y, LOOSE) if digest(x) == k and digest(y) == j else -1  # a doc_id may stand for several texts
                    for x, y, k, j in zip(shingle_sets(whole(part.column("text_a"))), shingle_sets(whole(part.column("text_b"))), part.column("a").to_pylist(), part.column("b").to_pylist())
                ]
                there = pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(percent, pa.int32())], ["a", "b", "percent"])
                yield there.filter(pc.greater_equal(there.column("percent"), 0))

    return rows.mapInArrow(compare, "a binary, b binary, percent int")


def region_links(docs: DataFrame, classes: DataFrame, loose: DataFrame, joined: DataFrame) -> DataFrame:
    """Links (a, b) inside the regions that ``loose`` edges form, between different components of ``joined`` (node, root)."""
    regions = components(loose, "regions").select(F.col("node").alias("key"), F.col("root").alias("region"))
    roots = joined.select(F.col("node").alias("key"), "root")
    members = materialise(regions.join(roots, "key", "left").select("region", "key", F.coalesce("root", "key").alias("root")), "region-members")
    parts = members.groupBy("region", "root").agg(F.count("*").alias("n"))
    largest = parts.groupBy("region").agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("parts"))
    open_regions = largest.where("parts > 1 and size > 2").select(
        "region", F.col("top.root").alias("top"),
        F.ceil((F.col("size") - F.col("top.n")) / BLOCK).cast("int").alias("left_blocks"), F.ceil(F.col("size") / BLOCK).cast("int").alias("right_blocks"),
    )
    rows = members.join(materialise(open_regions, "region-open"), "region")  # of known size, so members move only if it is large
    spot = F.xxhash64("key")
    left = rows.where("root <> top").select("region", "key", "root", F.pmod(spot, F.col("left_blocks")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("right_blocks") - 1)).alias("j"), F.lit(True).alias("left"))
    right = rows.select("region", "key", "root", F.explode(F.sequence(F.lit(0), F.col("left_blocks") - 1)).alias("i"), F.pmod(spot, F.col("right_blocks")).alias("j"), F.lit(False).alias("left"))
    blocks = materialise(left.select(*right.columns).unionByName(right), "region-blocks")
    texts = class_texts(docs, classes, blocks.select("key").distinct())
    filled = blocks.join(texts, "key").select("region", "i", "j", "key", "root", "left", "text")

    def compare(group, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = {}, {}
        for batch in batches:
            for part in slices(batch, limit=SHINGLED):
                sets = shingle_sets(whole(part.column("text")))
                for key, root, side, s in zip(part.column("key").to_pylist(), part.column("root").to_pylist(), part.column("left").to_pylist(), sets):
                    if digest(s) == key:
                        (left if side else right)[key] = (root, s)
        links = block_links(left, right)
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.binary()), pa.array([y for _, y in links], pa.binary())], ["a", "b"])

    compare.__annotations__ = {"group": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return filled.groupBy("region", "i", "j").applyInArrow(compare, "a binary, b binary")


def block_links(left: dict, right: dict) -> list[tuple[bytes, bytes]]:
    """Links between classes of different components, as many as join those components, from key -> (root, set)."""
    if not left or not right:
        return []
    keys = list(right)
    others = signature([right[k][1] for k in keys])
    above: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while above.get(x, x) != x:
            x = above[x]
        return x

    out = []
    mine = signature([s for _, s in left.values()])
    for (key, (root, s)), own in zip(left.items(), mine):
        for at in np.flatnonzero((others == own).mean(axis=1) >= LIKELY).tolist():
            other, t = right[keys[at]]
            if find(root) != find(other) and similar(s, t, PERCENT) >= 0:
                above[find(root)] = find(other)
                out.append((key, keys[at]))
    return out


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs`` (doc_id, text) with an id."""
    sets = materialise(sets_of(docs), "near-sets")
    classes = sets.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first_doc"))
    classes = materialise(classes, "near-classes")
    first = sets.join(classes, (sets["key"] == classes["key"]) & (sets["doc_id"] == classes["first_doc"])).select(sets["key"], "signature")
    pairs = materialise(forest_neighbours(first), "near-pairs")
    texts = materialise(class_texts(docs, classes, pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()), "near-texts")
    checked = materialise(confirmed(pairs, texts), "near-checked")
    strong = checked.where(F.col("percent") >= PERCENT).select("a", "b")
    joined = components(strong, "near")
    more = materialise(region_links(docs, classes, checked.select("a", "b"), joined), "near-more")
    whole_of = components(strong.unionByName(more), "near-all") if not more.isEmpty() else joined
    rooted = classes.join(whole_of.withColumnRenamed("node", "key"), "key", "left").select("key", "first_doc", F.coalesce("root", "key").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    answer = materialise(rooted.join(least, "root").select("key", "component_id"), "near-answer")
    rows = sets.select("doc_id", "n_shingles", "key").join(answer, "key", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group, as it is.  Rows that repeat a doc_id count as one document; rows without an id stay."""
    chosen = near_duplicates(docs).where("kept").select(F.col("doc_id").alias("chosen_id")).distinct()
    ids = docs["doc_id"].cast("long")
    named = docs.join(chosen, ids == F.col("chosen_id"), "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where(docs["doc_id"].isNull()))
