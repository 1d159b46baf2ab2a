"""Document fingerprints by SpotSigs: chains of content words behind common words.

Native DataFrame work only.  A text is lower-cased and reduced to words of letters and digits.  Every run of
common words is an *anchor*, and so is the start of the text.  An anchor is followed by a chain of the next two
content words; a chain notes where common words were passed over between them, and is one word long at the end
of a text.  The set of chains, hashed to 32 bits each, is the fingerprint, written as sorted hexadecimal words
of eight digits.  A text without content words has one signature, its hash; the empty text has none.

The likeness of two fingerprints is the Jaccard similarity of their sets; equal ones are alike (1.0), also if
empty.  ``near_pairs`` finds all pairs of different sets of at least a given likeness.

A null text counts as empty.  Rows of one doc_id have the same next document; where several rows hold the next
doc_id, the one with the least text is taken.  Rows without a doc_id are followed by the first document.  Other
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.session import materialise

#: Common words of four languages, in alphabetical order.
COMMON = {
    "de": "am an auf aus bei das dem den der des die ein eine einem einen einer er es für ich im in ist mit nicht sich sie und von war wird zu",
    "en": "a an and are as at be been but by for from had has have he his in is it not of on or she that the their they this to was were which with you",
    "es": "al como con de del el en es esta este la las lo los más no para pero por que se sin su sus un una y",
    "fr": "au aux avec ce ces dans de des du elle en est et il la le les mais ne nous on ou par pas pour qui sa se ses son sur un une",
}
#: An anchor, the next content word, and the one after it if there is one.
CHAIN = "(?=#( [^# ]+ (?:(?:# )?[^# ]+ )?))"


def common_words() -> list[str]:
    return sorted({w for words in COMMON.values() for w in words.split()})


def common_pattern() -> str:
    """The common words as a pattern, gathered by their first letters so that most words fail at once."""
    by_letter: dict[str, list[str]] = {}
    for word in common_words():
        by_letter.setdefault(word[0], []).append(word[1:])
    return "|".join(f"{first}(?:{'|'.join(sorted(rest, key=len, reverse=True))})" for first, rest in by_letter.items())


def signatures(text: Column) -> Column:
    """The sorted distinct signatures of a text without nulls."""
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    # Possessive: matched in a loop.  A greedy repetition recurses for every word and overflows the stack on long runs.
    anchored = F.concat(F.lit("#"), F.regexp_replace(plain, f"(?: (?:{common_pattern()})(?= ))++", " #"))
    short = lambda x: F.substring(F.md5(x.cast("binary")), 1, 8)
    chains = F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(anchored, F.lit(CHAIN), F.lit(1)), short)))
    alone = F.when(text == "", F.array().cast("array<string>")).otherwise(F.array(short(text)))
    return F.when(F.size(chains) > 0, chains).otherwise(alone)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets."""
    common = F.size(F.array_intersect(a, b))
    return F.when(a == b, 1.0).otherwise(common / (F.size(a) + F.size(b) - common))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns such that each is computed once per row however often it is used."""
    packed = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
    return df.select("*", packed.alias("_once")).select(*df.columns, *[F.col("_once")[name].alias(name) for name in columns])


def next_ids(docs: DataFrame) -> DataFrame:
    """``doc_id, next_id``: the next smaller doc_id, of the smallest the largest; sorted in ranges, only ids move."""
    ids = docs.select(docs["doc_id"].cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    ranged = materialise(ids.repartitionByRange("doc_id").select("doc_id", F.spark_partition_id().alias("range")), "spot-ids")
    tops = ranged.groupBy("range").agg(F.max("doc_id").alias("top"))  # a row per range
    last = tops.agg(F.max("top").alias("last_top"))
    below = tops.select("range", F.lag("top").over(Window.orderBy("range")).alias("below")).crossJoin(F.broadcast(last)).select("range", F.coalesce("below", "last_top").alias("below"))
    smaller = F.lag("doc_id").over(Window.partitionBy("range").orderBy("doc_id"))
    return ranged.select("doc_id", "range", smaller.alias("smaller")).join(below, "range").select("doc_id", F.coalesce("smaller", "below").alias("next_id"))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text`` of every row."""
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    nexts = materialise(next_ids(docs), "spot-next")
    after = base.join(nexts.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("before")), "doc_id").select("before", F.col("text").alias("next_text"))
    if base.count() > nexts.count():  # some doc_id stands in several rows, or in none
        after = after.groupBy("before").agg(F.min("next_text").alias("next_text"))
        first = base.join(nexts.agg(F.max("doc_id").alias("doc_id")), "doc_id").agg(F.min("text").alias("first_text"))
        rows = base.join(after, base["doc_id"] == after["before"], "left").crossJoin(F.broadcast(first))
        return rows.select("doc_id", "text", F.coalesce(F.when(F.col("doc_id").isNull(), F.col("first_text")), "next_text", F.lit("")).alias("next_text"))
    return base.join(after, base["doc_id"] == after["before"]).select("doc_id", "text", "next_text")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last floor(n / 2) code points replaced by the first as many of ``other``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - half), F.substr(other, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text, edited_text`` and the signature sets ``own, edited_own, next_own`` of every row of ``docs`` (doc_id, text)."""
    rows = with_next(docs).withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    rows = once(rows, own=signatures(F.col("text")), edited_own=signatures(F.col("edited_text")), next_own=signatures(F.col("next_text")))
    return rows.drop("next_text")


def near_pairs(sets: DataFrame, least: float = 0.75) -> DataFrame:
    """``a, b, likeness``: pairs of different sets, a before b, that are at least ``least`` alike, from ``sets`` (name, own).

    ``name`` must tell sets apart: give one representative of each distinct fingerprint.  Sets are partitioned by
    their length, in classes a factor of 1 / ``least`` wide, so that a pair is in one class or two adjacent ones.
    There they meet on their rarest signatures only, as many as must hold a common one; pairs whose lengths rule
    ``least`` out are pruned before sets are compared.
    """
    sized = sets.select("name", "own", F.size("own").alias("n")).where("n > 0")
    rows = sized.select("name", "n", F.explode("own").alias("signature"))
    rarity = rows.groupBy("signature").agg(F.count("*").alias("docs"))
    order = F.row_number().over(Window.partitionBy("name").orderBy("docs", "signature"))
    rare = rows.join(rarity, "signature").withColumn("nth", order).where(F.col("nth") <= F.col("n") - F.ceil(F.col("n") * least) + 1)
    rare = rare.select("name", "n", "signature", F.floor(F.log("n") / F.log(F.lit(1 / least)) + 1e-9).alias("length_class"))
    x = rare.select(F.col("name").alias("a"), F.col("n").alias("n_a"), "signature", F.explode(F.array(F.col("length_class"), F.col("length_class") + 1)).alias("length_class"))
    y = rare.select(F.col("name").alias("b"), F.col("n").alias("n_b"), "signature", "length_class")
    met = x.join(y, ["signature", "length_class"]).where("a <> b and n_b >= n_a and n_a >= n_b * %r" % least)
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left, right = (sized.select(F.col("name").alias(k), F.col("own").alias(f"own_{k}")) for k in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", likeness(F.col("own_a"), F.col("own_b")).alias("likeness")).where(F.col("likeness") >= least)
