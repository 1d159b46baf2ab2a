"""Benchmark decontamination: items are sought by their rarer words, and the passages found are aligned with them.

Texts and items become sequences of words: pieces between white space, lower-cased, letters and digits only.
A passage's score is that of Smith and Waterman's local alignment (match 2, mismatch -1, gap -1) with the item,
over that of a perfect copy.

An alignment that reaches the threshold leaves at most so many words of its item unmatched (half at 0.5: a word left
off at an end costs the 2 it would have given, one replaced inside costs 3) and spans a bounded number of words (twice
the item's at 0.5).  So of any set of the item's words, all but those stand inside such a span.  That is asked of the
item's rarest words (as many as may stay unmatched and a third of those that have to match), then of all its words,
each as often as the item has it; passages that fulfil both are aligned.  Both are necessary conditions: every alignment that reaches the threshold is
found, however its words are edited or cut off and however often it has leaked.  Seeds are single words and not longer
n-grams, since a copy with a word put in after each of its own scores 0.5 without two adjacent words of the item.
How often each word occurs, counted over all documents, only decides how many passages are looked at.

The test items are a stated query set.  They are sent to the tasks in blocks of at most ``BLOCK_WORDS`` words,
one block after another if there are more.  Documents are neither shuffled nor grouped.

An item of fewer than ``N`` words, or null, matches nothing, and neither does a document of fewer than ``N``
words; items that repeat match each by itself.  A null text is empty.  Every row of a repeated document is judged.
Without items, nothing is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.texts import pieces, row_sums, slices, strings, whole

N = 3
THRESHOLD = 0.5
BLOCK_WORDS = 1_000_000
#: Word and item pairs looked at together in a task.
PAIRS = 4_000_000
#: Windows of a passage counted together.
WINDOWS = 256
MATCH, MISMATCH, GAP = 2, -1, -1

HITS = "doc_id long, item_id long, score double, first_word long, n_words long"


def normalised(pieces_: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.utf8_lower(pieces_), r"[^\p{L}\p{N}]+", "")


def word_ids(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words per row, and the place of each word in ``vocabulary``, -1 for others."""
    counts, codes, names = pieces(texts)
    plain = normalised(names)
    ids = np.asarray(pc.fill_null(pc.index_in(plain, value_set=vocabulary), -1)).astype(np.int64)
    ids[np.asarray(pc.equal(plain, ""))] = -2
    laid = ids[codes]
    word = laid != -2
    return row_sums(counts, word.astype(np.int64)), laid[word]


@dataclass
class Seeds:
    """What to look for: of each word of a vocabulary, the items that seek it; of each item, how many within how many words."""

    first: np.ndarray  # of each word, where its items begin in ``items``; one more at the end
    items: np.ndarray
    enough: np.ndarray  # occurrences of sought words
    matched: np.ndarray  # words of the item
    span: np.ndarray


@dataclass
class Items:
    """A block of test items: words by their place in ``vocabulary``."""

    item_ids: list[int]
    words: list[np.ndarray]
    vocabulary: pa.Array

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Items:
        texts = pa.array([t for _, t in rows], pa.string())
        plain = normalised(pieces(texts)[2]) if rows else pa.array([], pa.string())
        vocabulary = pc.unique(plain.filter(pc.not_equal(plain, "")))
        counts, ids = word_ids(texts, vocabulary)
        words = np.split(ids, np.cumsum(counts)[:-1]) if rows else []
        return cls([i for i, _ in rows], words, vocabulary)

    def seeds(self, frequency: np.ndarray, threshold: float) -> Seeds:
        """The rarest words of each item: as many as may stay unmatched and a third of those that have to match."""
        enough, matched, span = (np.zeros(len(self.words), np.int64) for _ in range(3))
        sought, by = [], []
        for item, words in enumerate(self.words):
            m = len(words)
            if m < N:
                continue
            least = least_score(m, threshold)
            spare = (MATCH * m - least) // MATCH
            matched[item], span[item] = m - spare, (MATCH + 1) * m - least
            enough[item] = max(1, (m - spare) // 3)
            rarest = words[np.argsort(frequency[words], kind="stable")[:spare + enough[item]]]
            sought.append(np.unique(rarest))
            by.append(np.full(len(sought[-1]), item))
        word, item = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (sought, by))
        order = np.argsort(word, kind="stable")
        return Seeds(np.searchsorted(word[order], np.arange(len(self.vocabulary) + 1)), item[order], enough, matched, span)

    def passages(self, counts: np.ndarray, ids: np.ndarray, seeds: Seeds) -> dict[tuple[int, int], list[list[int]]]:
        """By row and item, the stretches of ``ids`` that can hold an alignment; none overlap or touch."""
        row_end = np.cumsum(counts)
        n_items = np.where(ids >= 0, np.diff(seeds.first)[ids] if len(seeds.first) > 1 else 0, 0)
        at = np.flatnonzero(n_items)
        if not len(at):
            return {}
        pairs_before = np.cumsum(n_items[at]) - n_items[at]
        reach = int(seeds.span.max())
        found: dict[tuple[int, int], list[list[int]]] = {}
        cuts = np.searchsorted(pairs_before, np.arange(0, pairs_before[-1] + 1, PAIRS))
        for lo, hi in zip(cuts, [*cuts[1:], len(at)]):
            if lo == hi:
                continue
            near = at[lo:np.searchsorted(at, at[hi - 1] + reach)]  # spans that begin before the cut end behind it
            n = n_items[near]
            p = np.repeat(near, n)
            item = seeds.items[np.repeat(seeds.first[ids[near]] - np.cumsum(n) + n, n) + np.arange(len(p))]
            order = np.argsort(item, kind="stable")
            p, item = p[order], item[order]
            last = np.arange(len(p)) + seeds.enough[item] - 1
            inside = last < len(p)
            last = np.minimum(last, len(p) - 1)
            inside &= (item[last] == item) & (p[last] - p < seeds.span[item])
            begin, end, item = p[inside], p[last[inside]], item[inside]
            row = np.searchsorted(row_end, begin, side="right")
            same = (end < row_end[row]) & (counts[row] >= N)
            for r, i, b, e in zip(row[same].tolist(), item[same].tolist(), (end - seeds.span[item] + 1)[same].tolist(), (begin + seeds.span[item])[same].tolist()):
                there = found.setdefault((r, i), [])
                if there and b <= there[-1][1]:
                    there[-1][1] = max(e, there[-1][1])
                else:
                    there.append([b, e])
        return found

    def hits(self, texts: pa.Array, seeds: Seeds, threshold: float) -> list[tuple[int, int, float, int, int]]:
        """``row, item, score, first word, words`` of the best alignment of each item that reaches ``threshold``."""
        counts, ids = word_ids(texts, self.vocabulary)
        row_end = np.cumsum(counts)
        own = np.zeros(len(self.vocabulary) + 1, np.int64)  # how often the item has each word; the last stands for unknown words
        out = []
        for (row, item), stretches in sorted(self.passages(counts, ids, seeds).items()):
            stop, start, words = int(row_end[row]), int(row_end[row] - counts[row]), self.words[item]
            np.add.at(own, words, 1)
            best = (0.0, 0, 0)
            for lo, hi in stretches:
                lo, hi = max(lo, start), min(hi, stop)
                text = ids[lo:hi]
                if most_matched(text, own, int(seeds.span[item])) >= seeds.matched[item]:
                    best = max(best, copy_or_alignment(text, words, lo, max(threshold, best[0])), key=lambda x: x[0])
            own[words] = 0
            if best[0] >= threshold:
                out.append((row, item, best[0], best[1] - start, best[2]))
        return out


def most_matched(text: np.ndarray, own: np.ndarray, span: int) -> int:
    """The most words of an item that any ``span`` words of ``text`` can match, a word as often as the item has it."""
    at = np.flatnonzero(own[text])
    width = min(span, len(text))
    word = text[at]
    order = np.argsort(word, kind="stable")
    place = np.empty(len(at), np.int64)
    place[order] = np.arange(len(at))
    # in a window that holds the occurrence as many places before, this one can match nothing
    back = place - own[word]
    same = (back >= 0) & (word[order[np.maximum(back, 0)]] == word)
    before = np.where(same, at[order[np.maximum(back, 0)]], -1)
    most = 0
    for lo in range(0, len(text) - width + 1, WINDOWS):
        first = np.arange(lo, min(lo + WINDOWS, len(text) - width + 1))[:, None]
        i, j = np.searchsorted(at, [lo, int(first[-1, 0]) + width])
        inside = (at[i:j] >= first) & (at[i:j] < first + width) & (before[i:j] < first)
        most = max(most, int(inside.sum(axis=1).max(initial=0)))
    return most


def least_score(m: int, threshold: float) -> int:
    """The lowest alignment score that reaches ``threshold`` with an item of ``m`` words; 1 at least."""
    least = max(1, int(np.floor(MATCH * m * threshold)) - 1)
    while least / (MATCH * m) < threshold:
        least += 1
    return least


def copy_or_alignment(text: np.ndarray, item: np.ndarray, base: int, threshold: float) -> tuple[float, int, int]:
    """As ``align`` if that reaches the threshold, or zeros; a whole copy needs no alignment."""
    m = len(item)
    if len(text) >= m:
        for p in np.flatnonzero((text[:len(text) - m + 1] == item[0]) & (text[m - 1:] == item[-1])).tolist():
            if np.array_equal(text[p:p + m], item):
                return 1.0, base + p, m
    best, _ = best_end(text, item)
    return align(text, item, base) if best / (MATCH * m) >= threshold else (0.0, 0, 0)


def best_end(text: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Highest local alignment score, and after which word of the text it ends."""
    above = np.zeros(len(text) + 1, np.int64)
    slope = -GAP * np.arange(len(text) + 1)
    best, end = 0, 0
    for word in item:
        here = np.maximum(np.where(text == word, MATCH, MISMATCH) + above[:-1], above[1:] + GAP)
        row = np.concatenate([[0], np.maximum(here, 0)])
        above = np.maximum.accumulate(row + slope) - slope
        top = int(above.argmax())
        if above[top] > best:
            best, end = int(above[top]), top
    return best, end


def align(text: np.ndarray, item: np.ndarray, base: int) -> tuple[float, int, int]:
    """Score from 0 to 1, first position and length of the best local alignment."""
    best, end = best_end(text, item)
    _, back = best_end(text[:end][::-1], item[::-1])
    return best / (MATCH * len(item)), base + end - back, back


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Items]:
    """The items in blocks of bounded size."""
    rows = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text")).where("item_id is not null and text is not null")
    held, words = [], 0
    for r in rows.toLocalIterator():
        held.append((r["item_id"], r["text"]))
        words += r["text"].count(" ") + 1
        if words >= block_words:
            yield Items.of(held)
            held, words = [], 0
    if held:
        yield Items.of(held)


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def seeded(docs: DataFrame, items: Items, threshold: float) -> Seeds:
    """What to look for, by how often the words of the block occur in all of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part in slices(batch):
                _, ids = word_ids(whole(part.column("text")), vocabulary)
                total += np.bincount(ids[ids >= 0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], ["word", "n"])

    rows = texts_of(docs).select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    frequency = np.zeros(len(items.vocabulary), np.int64)
    for r in rows:
        frequency[r["word"]] = r["n"]
    return items.seeds(frequency, threshold)


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, score, first_word, n_words``: a row per document and item whose alignment reaches ``threshold``."""
    spark = docs.sparkSession

    def found(items: Items) -> DataFrame:
        sent = spark.sparkContext.broadcast((items, seeded(docs, items, threshold)))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, seeds = sent.value
            for batch in batches:
                for part in slices(batch):
                    hits = block.hits(whole(part.column("text")), seeds, threshold)
                    ids = part.column("doc_id").to_pylist()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([ids[h[0]] for h in hits], pa.int64()), pa.array([block.item_ids[h[1]] for h in hits], pa.int64()),
                        pa.array([h[2] for h in hits], pa.float64()), pa.array([h[3] for h in hits], pa.int64()), pa.array([h[4] for h in hits], pa.int64()),
                    ], ["doc_id", "item_id", "score", "first_word", "n_words"])

        return texts_of(docs).mapInArrow(search, HITS)

    blocks = [found(items) for items in item_blocks(benchmark)]
    return reduce(DataFrame.unionAll, blocks) if blocks else spark.createDataFrame([], HITS)


def leak_udf(items: Items, seeds: Seeds, spark, threshold: float):
    """A column function from texts to whether any item of the block is found."""
    sent = spark.sparkContext.broadcast((items, seeds))

    @F.arrow_udf("boolean")
    def leaks(texts: pa.Array) -> pa.Array:
        block, seeds = sent.value
        out = [np.zeros(0, bool)]
        for part in slices(pa.RecordBatch.from_arrays([texts], ["text"])):
            leaked = np.zeros(part.num_rows, bool)
            leaked[[h[0] for h in block.hits(whole(part.column("text")), seeds, threshold)]] = True
            out.append(leaked)
        return pa.array(np.concatenate(out))

    return leaks


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` in which no item is found, as they are."""
    clean = docs
    for items in item_blocks(benchmark):
        leaks = leak_udf(items, seeded(docs, items, threshold), docs.sparkSession, threshold)
        clean = clean.where(~leaks(clean["text"].cast("string")))
    return clean
