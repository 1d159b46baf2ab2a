"""Shards over fixed virtual slots.

A record's slot follows from a hash of its id alone; there are thousands of slots, and their number never changes.
Bytes and records are added up per slot, which is all the driver sees, and a map says which shard holds each slot.
The first map deals slots out by size, the largest first, each to the shard that is lightest so far.  Maps are stored as
versions.  Rebalancing edits the last one: slots of shards that are gone are dealt out, then single slots move from the
heaviest to the lightest shard as long as that brings the two closer (to the new shards only, while there are any); all
other slots stay where they are, and so do their records.

The size of a record is the bytes of its text and one more.  Inside a shard, records stand by slot, then id, then
checksum and size; records of a slot are numbered there, and each slot begins where the one before it in its shard ends.  So
no task sees more than a slot, and adding a shard needs no sort of the corpus.

A null text has no bytes.  Records without id take their slot from the text's checksum and stand first in it.  Records
that share an id share a slot; repeated rows are numbered each.  Empty tables give a map of empty slots and no records.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.session import shared_folder

SLOTS = 8192
SHARDS = 16
#: Sizes within this share of the mean shard count as equal.
TOLERANCE = 0.001

MAP = "version int, virtual_slot int, shard int, bytes long, records long, before long"


def keyed(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc, doc_id, size, text_crc32, virtual_slot``; ``doc`` is the row itself."""
    data = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
    )
    slot = F.pmod(F.xxhash64(F.coalesce("doc_id", "text_crc32")), F.lit(slots)).cast("int")
    return rows.withColumn("virtual_slot", slot)


@dataclass(frozen=True)
class Slot:
    number: int
    bytes: int
    records: int


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> list[Slot]:
    """Bytes and records of every slot, also of empty ones: added up in the tasks, then one row per slot."""
    sums = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records")).collect()
    held = {r["virtual_slot"]: Slot(r["virtual_slot"], r["bytes"], r["records"]) for r in sums}
    return [held.get(i, Slot(i, 0, 0)) for i in range(slots)]


def dealt(slots: list[Slot], load: list[int]) -> dict[int, int]:
    """Slots to shards, the largest first, each to the shard that is lightest so far; ``load`` is what shards hold."""
    heap = [(held, shard) for shard, held in enumerate(load)]
    heapq.heapify(heap)
    where = {}
    for slot in sorted(slots, key=lambda s: (-s.bytes, s.number)):
        held, shard = heapq.heappop(heap)
        where[slot.number] = shard
        heapq.heappush(heap, (held + slot.bytes, shard))
    return where


def rebalanced(slots: list[Slot], where: dict[int, int], shards: int, tolerance: float = TOLERANCE) -> dict[int, int]:
    """The map ``where`` edited for ``shards`` shards and the slots' present sizes; only new shards take slots, if there are any."""
    taking = sorted(set(range(shards)) - set(where.values())) or range(shards)
    where = dict(where)
    load = [0] * shards
    members: list[list[Slot]] = [[] for _ in range(shards)]
    homeless = []
    for slot in slots:
        shard = where.get(slot.number, shards)
        if shard >= shards:
            homeless.append(slot)
        else:
            load[shard] += slot.bytes
            members[shard].append(slot)
    by_number = {s.number: s for s in homeless}
    for number, shard in dealt(homeless, load).items():
        where[number] = shard
        load[shard] += by_number[number].bytes
        members[shard].append(by_number[number])
    allowed = max(1, int(tolerance * sum(load) / shards))
    while True:
        light = min(taking, key=lambda s: (load[s], s))
        heavy = max(range(shards), key=lambda s: (load[s], -s))
        gap = load[heavy] - load[light]
        fits = [s for s in members[heavy] if 0 < s.bytes < gap]
        if gap <= allowed or not fits:
            return where
        slot = min(fits, key=lambda s: (abs(gap - 2 * s.bytes), s.number))  # what leaves the two closest
        members[heavy].remove(slot)
        members[light].append(slot)
        load[heavy] -= slot.bytes
        load[light] += slot.bytes
        where[slot.number] = light


class SlotMaps:
    """The stored maps of a corpus, a folder per version; a version counts once its write has committed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        """Ascending; asked of the file system, one version after another."""
        found = 0
        while self._done(found + 1):
            found += 1
        return list(range(1, found + 1))

    def _done(self, version: int) -> bool:
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{version}/_SUCCESS")
        return marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(marker)

    def read(self, version: int | None = None) -> DataFrame:
        """``version, virtual_slot, shard, bytes, records, before``: the newest map, or the one asked for."""
        return self.spark.read.schema(MAP).parquet(f"{self.path}/{version or self.versions()[-1]}")

    def where(self, version: int | None = None) -> dict[int, int]:
        """The map as a dictionary: a row per slot."""
        return {r["virtual_slot"]: r["shard"] for r in self.read(version).select("virtual_slot", "shard").collect()}

    def append(self, slots: list[Slot], where: dict[int, int]) -> int:
        """Store a map as the next version; ``before`` is where the slot's records begin in their shard."""
        version = len(self.versions()) + 1
        begin: dict[int, int] = {}
        rows = []
        for slot in slots:
            shard = where[slot.number]
            rows.append((version, slot.number, shard, slot.bytes, slot.records, begin.get(shard, 0)))
            begin[shard] = begin.get(shard, 0) + slot.records
        self.spark.createDataFrame(rows, MAP).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{version}")
        return version

    def rebalance(self, docs: DataFrame, shards: int, tolerance: float = TOLERANCE) -> int:
        """Add up the slots of ``docs`` and store the next version: the first map, or the last one edited."""
        held = self.versions()
        number = self.read().count() if held else SLOTS
        slots = slot_sizes(keyed(docs, number), number)
        where = rebalanced(slots, self.where(), shards, tolerance) if held else dealt(slots, [0] * shards)
        return self.append(slots, where)


def placed(docs: DataFrame, slot_map: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc, doc_id, size, text_crc32, shard, slot, virtual_slot``: ``slot`` is the record's place in its shard."""
    rows = keyed(docs, slots)
    nth = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")) - 1
    # A row per slot: ``slots`` at most.
    held = F.broadcast(slot_map.select(F.col("virtual_slot").alias("of"), F.col("shard"), "before"))
    return rows.withColumn("nth", nth).join(held, F.col("virtual_slot") == F.col("of")).select(
        "doc", "doc_id", "size", "text_crc32", "shard", (F.col("nth") + F.col("before")).alias("slot"), "virtual_slot",
    )


def sharded(docs: DataFrame, shards: int = SHARDS, path: str | None = None) -> DataFrame:
    """``placed`` by the map kept at ``path``; a new one is made, or the last version edited, for ``docs``."""
    spark = docs.sparkSession
    maps = SlotMaps(spark, path or f"{shared_folder(spark)}/slot-map-{uuid.uuid4().hex}")
    return placed(docs, maps.read(maps.rebalance(docs, shards)))


def write_shards(docs: DataFrame, slot_map: DataFrame, path: str, slots: int = SLOTS) -> None:
    """``slot, virtual_slot, doc`` in a folder per shard; a file holds whole slots, in order."""
    out = placed(docs, slot_map, slots).select("shard", "slot", "virtual_slot", "doc")
    # ``doc`` keeps the columns of ``docs`` apart from those of the map, whatever their names.
    out.sortWithinPartitions("shard", "virtual_slot", "slot").write.partitionBy("shard").parquet(path)
