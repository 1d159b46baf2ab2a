"""Token ids of a corpus as wavelet-matrix shards, one compressed file per shard.

Documents are range-partitioned by their order and sorted inside each partition.  A task encodes its
documents one after another and closes a matrix when it holds ``matrix_tokens`` ids, so its memory is
bound by one matrix and one document.  A matrix is one row of a Parquet table, and a file is a shard of up
to ``SHARD_MATRICES`` of them: Spark's commit protocol then covers the files, and any reader of Spark opens
them.

Rows with a null id come first.  Rows of the same id follow one another in the order of their texts; a
repeated row is encoded each time.  A null text is empty; an empty document holds the end id only.  An
empty table gives no file and no row.  Other columns of the input are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillhouse.llm.texts import pieces, slices, whole
from tillhouse.llm.tokenizing import Encoder, encoder, lowered
from tillhouse.llm.wavelet import WaveletMatrix
from tillhouse.session import shared_folder

#: Ids of a matrix: its levels stay in a CPU's cache while it is built.  With the ranks it takes 2.2 MB.
MATRIX_TOKENS = 1 << 20
#: Matrices of a shard file.
SHARD_MATRICES = 32

SHARD = pa.schema([
    ("part", pa.int64()), ("seq", pa.int64()), ("n", pa.int64()), ("zeros", pa.list_(pa.int64())), ("planes", pa.list_(pa.binary())),
    ("ranks", pa.list_(pa.binary())), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
])
SHARD_DDL = "part long, seq long, n long, zeros array<long>, planes array<binary>, ranks array<binary>, doc_ids array<long>, lengths array<long>"
DOCUMENT_DDL = "part long, seq long, doc_id long, before long, n_tokens long, ids_crc32 long"


def pack(part: int, seq: int, ids: np.ndarray, bits: int, doc_ids: list, lengths: list[int]) -> pa.RecordBatch:
    """One matrix as a row."""
    m = WaveletMatrix.build(ids, bits)
    row = {
        "part": part, "seq": seq, "n": m.n, "zeros": m.zeros, "planes": [p.tobytes() for p in m.planes],
        "ranks": [r.tobytes() for r in m.ranks], "doc_ids": doc_ids, "lengths": lengths,
    }
    return pa.RecordBatch.from_pylist([row], SHARD)


def unpack(row: dict) -> WaveletMatrix:
    """The matrix of a row; ``row`` may come from ``collect`` as well."""
    return WaveletMatrix(
        row["n"], [np.frombuffer(p, np.uint8) for p in row["planes"]], [np.frombuffer(r, "<u4") for r in row["ranks"]], list(row["zeros"]),
    )


def write_tokens(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, matrix_tokens: int = MATRIX_TOKENS, order: list[Column] | None = None,
) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order, or by ``order``, into shard files under ``path``."""
    keys = order or [docs["doc_id"].cast("long")]
    names = [f"key{i}" for i in range(len(keys))]
    rows = docs.select(
        *[k.alias(n) for k, n in zip(keys, names)], docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
    )
    ordered = rows.repartitionByRange(*names).sortWithinPartitions(*names, "text").select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, held = TaskContext.get().partitionId(), 0, 0
        tool = encoder(tokenizer)
        bits = max(tool.tokenizer.get_vocab_size() - 1, end_id).bit_length()
        small = np.uint16 if bits <= 16 else np.uint32
        ids: list[np.ndarray] = []
        doc_ids: list = []
        lengths: list[int] = []
        for batch in batches:
            for piece in slices(batch):
                here, sizes = encoded(piece, tool, end_id, small)
                start, names_here = 0, piece.column("doc_id").to_pylist()
                ends = np.cumsum(sizes)
                first = 0
                while first < len(sizes):
                    room = matrix_tokens - held
                    last = int(np.searchsorted(ends, start + room, side="left")) + 1  # the document that fills the matrix belongs to it
                    last = min(last, len(sizes))
                    stop = int(ends[last - 1])
                    ids.append(here[start:stop])
                    doc_ids += names_here[first:last]
                    lengths += sizes[first:last].tolist()
                    held += stop - start
                    first, start = last, stop
                    if held >= matrix_tokens:
                        yield pack(part, seq, np.concatenate(ids), bits, doc_ids, lengths)
                        seq, held, ids, doc_ids, lengths = seq + 1, 0, [], [], []
        if doc_ids:
            yield pack(part, seq, np.concatenate(ids), bits, doc_ids, lengths)

    shards = ordered.mapInArrow(encode, SHARD_DDL)
    shards.write.option("maxRecordsPerFile", SHARD_MATRICES).option("compression", "zstd").parquet(path)


def encoded(batch: pa.RecordBatch, tool: Encoder, end_id: int, kind) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a batch's documents one after another, each with the end id, and how many each has."""
    counts, codes, vocabulary = pieces(lowered(whole(batch.column("text"))))
    flat, begin, size = tool.ids_of(vocabulary)
    end = len(size)  # the end id as one more piece, laid after the pieces of each row
    flat, begin, size = np.append(flat, end_id).astype(kind), np.append(begin, len(flat)), np.append(size, 1).astype(np.int32)
    laid = np.insert(codes, np.cumsum(counts), end)
    each = size[laid]
    stops = np.cumsum(each)
    at = np.repeat((begin[laid] - (stops - each)).astype(np.int32), each)
    at += np.arange(len(at), dtype=np.int32)
    row_ends = stops[np.cumsum(counts) + np.arange(len(counts))]
    return flat[at], np.diff(row_ends, prepend=0)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the shard files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = memoryview(unpack(row).decode().astype("<u4")).cast("B")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                k = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * k, pa.int64()), pa.array([row["seq"]] * k, pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "before", "n_tokens", "ids_crc32"],
                )

    shards = spark.read.schema(SHARD_DDL).parquet(path)
    documents = shards.mapInArrow(decode, DOCUMENT_DDL)
    return documents.join(shard_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("shard_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32",
    )


def shard_starts(shards: DataFrame) -> DataFrame:
    """The ids before each matrix: sums inside a partition, and over one row per partition."""
    rows = shards.select("part", "seq", "n")
    parts = rows.groupBy("part").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        rows.withColumn("inside", inside).join(parts.select("part", before.alias("part_start")), "part")
        .select("part", "seq", (F.col("part_start") + F.col("inside")).alias("shard_start"))
    )


def file_order(docs: DataFrame) -> list[Column] | None:
    """The order in which ``docs`` was written: number of the part file, then row; None if it isn't read from files."""
    try:
        meta = docs.metadataColumn("_metadata")
        docs.select(meta["file_name"])
    except AnalysisException:
        return None
    number = F.regexp_extract(meta["file_name"], "part-(\\d+)", 1).try_cast("long")
    further = F.regexp_extract(meta["file_name"], "-c(\\d+)", 1).try_cast("long")
    return [number, further, meta["row_index"]]


def encode_corpus(docs: DataFrame, tokenizer: str, end_id: int = 2, order: list[Column] | None = None) -> DataFrame:
    """Write the shard files to the shared folder and report every document as read back from them."""
    path = f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, tokenizer, path, end_id, order=order)
    return read_documents(docs.sparkSession, path)
