"""Token counts, token files and the wavelet matrix."""

import brute
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tillhouse.llm.queries import tokenizer_path
from tillhouse.llm.token_counts import count_tokens, frequent_pieces, reduced
from tillhouse.llm.token_files import encode_corpus, file_order, write_tokens
from tillhouse.llm.tokenizing import encoder, lowered
from tillhouse.llm.wavelet import WaveletMatrix


def test_counts_are_those_of_the_library(awkward, nothing):
    got = sorted(((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in count_tokens(awkward, tokenizer_path()).collect()))
    want = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), len(brute.tokens(r["text"])), len(brute.tokens(r["text"])) > 2048) for r in awkward.collect())
    assert got == want
    assert count_tokens(nothing, tokenizer_path()).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aBé'İs.,!?*|<>#1² \n\t ́̇ßΣ語endoftxr")), max_size=40))
def test_pieces_give_the_ids_of_the_whole_text(text):
    tool = encoder(tokenizer_path())
    from tillhouse.llm.token_files import encoded

    batch = pa.RecordBatch.from_arrays([pa.array([text, "plain " + text, None])], ["text"])
    ids, sizes = encoded(batch, tool, 2, np.uint32)
    want = [brute.tokens(t) + [2] for t in (text, "plain " + text, "")]
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    assert lowered(pa.array(["<|A"]))[0].as_py() == "<|A"


def test_frequent_table_has_a_bound_and_the_frequent_pieces(spark):
    docs = spark.createDataFrame([("the of " * 50 + f"rare{i} other{i % 3}",) for i in range(300)], "text string").repartition(5)
    table = frequent_pieces(docs, 8)
    assert {"the", "of"} <= set(table) and len(table) <= 8
    assert reduced({"a": 5, "b": 3, "c": 1}, 2) == {"a": 4, "b": 2}


def test_files_hold_the_corpus_in_order(spark, awkward, nothing):
    got = [tuple(r) for r in encode_corpus(awkward, tokenizer_path()).orderBy("start").collect()]
    rows = sorted(((r["doc_id"], r["text"]) for r in awkward.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert got == brute.token_rows(rows)
    assert encode_corpus(nothing, tokenizer_path()).collect() == []


def test_small_matrices_and_file_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some words number {i} and " * (i % 7)) for i in range(200)], "doc_id long, text string")
    docs.orderBy((docs["doc_id"] * 37) % 200).write.parquet(f"{tmp_path}/in")
    docs = spark.read.parquet(f"{tmp_path}/in")
    order = file_order(docs)
    assert file_order(spark.range(3).toDF("doc_id")) is None
    write_tokens(docs, tokenizer_path(), f"{tmp_path}/out", matrix_tokens=64, order=order)
    shards = spark.read.parquet(f"{tmp_path}/out")
    assert shards.count() > 10 and shards.agg({"n": "max"}).first()[0] < 64 + 60
    from tillhouse.llm.token_files import read_documents

    got = [tuple(r) for r in read_documents(spark, f"{tmp_path}/out").orderBy("start").collect()]
    want = brute.token_rows(sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: r[0] * 37 % 200))
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=1500), st.integers(0, 45))
def test_wavelet_matrix(ids, value):
    x = np.array(ids, np.uint32)
    m = WaveletMatrix.build(x, 6)
    assert m.decode().tolist() == ids
    assert [m.access(i) for i in range(0, len(ids), 61)] == ids[::61]
    lo, hi = len(ids) // 4, len(ids) - len(ids) // 5
    where = [i for i in range(lo, hi) if ids[i] == value]
    assert m.occurrences(value, lo, hi) == where and m.count(value, lo, hi) == len(where)
