"""The pipeline, stage by stage, against brute force on its own input."""

import brute
import numpy as np
import pyarrow as pa
from odd_rows import frame

import corpus_pipeline
from tillhouse.llm import decontaminate, ordinal
from tillhouse.llm.queries import TARGETS

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, frames = [docs], []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(f"{tmp_path}/{k}")
        seen.append(spark.read.parquet(f"{tmp_path}/{k}"))
        assert k == 4 or seen[-1].columns == docs.columns
    frames = [df.toPandas() for df in seen[:-1]]
    model = ordinal.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    p = 1 / (1 + np.exp(model.thresholds[1] - model.scores(pa.array(frames[0].text))))
    assert set(frames[1].doc_id) == set(frames[0].doc_id[p >= 0.5]) and len(frames[1]) < len(frames[0])
    rows = list(zip(frames[1].doc_id, frames[1].text))
    assert set(frames[2].doc_id) == set(brute.near(rows)) and len(frames[2]) < len(frames[1])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    block = decontaminate.Items.of(items)
    counts, ids = decontaminate.word_ids(pa.array(frames[2].text), block.vocabulary)
    leaked = [max(decontaminate.align(w, item, 0)[0] for item in block.words) >= 0.5 for w in np.split(ids, np.cumsum(counts)[:-1])]
    assert set(frames[3].doc_id) == set(frames[2].doc_id[~np.array(leaked)]) and any(leaked)
    sizes = frames[3].source.value_counts().to_dict()
    from tillhouse.llm.pfair import BLOCK_DOCS, whole_weights

    slots = brute.mixture(sizes, whole_weights(TARGETS), BLOCK_DOCS)
    of = {s: iter(sorted(frames[3].doc_id[frames[3].source == s])) for s in sizes}
    order = [d for s in slots for _, d in zip(range(BLOCK_DOCS), of[s])]
    assert list(frames[4].doc_id) == order
    text = dict(zip(frames[4].doc_id, frames[4].text))
    want = brute.token_rows([(d, text[d]) for d in order])
    got = sorted((tuple(r) for r in seen[-1].select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    assert got == want
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, seen[-1].collect()))


def test_awkward_and_empty_tables(spark, awkward, nothing, tmp_path):
    for name, docs in (("odd", awkward), ("none", nothing)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}{k}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{k}")
            assert k == 4 or docs.columns == awkward.columns
        assert (docs.count() == 0) == (name == "none")
    assert frame(spark, []).count() == 0
