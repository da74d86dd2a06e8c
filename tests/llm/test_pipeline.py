"""The pipeline against plain Python, stage by stage, on whole small tables."""

import brute
import corpus_pipeline as pipeline
import pytest

from bronzeflow.llm import minhash, mixing, queries, toxicity


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_run_matches_plain_python(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    docs = sorted(brute.table(sf_dir, "documents"), key=lambda r: r["doc_id"])
    model = toxicity.train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    known = {}
    docs = [d for d in docs if model.score(d["text"], known) < toxicity.Settings().cut]
    size, percent = minhash.NearDedup().shingle, minhash.NearDedup().percent
    docs = [d for i, (d, (_, low)) in enumerate(zip(docs, brute.components([d["text"] for d in docs], size, percent), strict=True)) if low == i]
    items = [(r["item_id"], r["text"]) for r in brute.table(sf_dir, "benchmark")]
    docs = [d for d in docs if not brute.hits(d["text"], items)[1]]
    frame = spark.createDataFrame([tuple(d.values()) for d in docs], documents.schema)
    sampled = {r.doc_id for r in mixing.draws(frame).filter("sampled").collect()}
    assert 0 < len(sampled) < len(docs)
    tokenizer = Tokenizer.from_file(queries.tokenizer_file())
    want = brute.token_rows([(d["doc_id"], d["text"]) for d in docs if d["doc_id"] in sampled], tokenizer)
    assert sorted(tuple(r) for r in pipeline.run(spark, sf_dir).collect()) == want


def test_stages_handle_odd_rows(spark, sf_dir, odd_docs, no_docs):
    for name, stage in pipeline.STAGES:
        for docs in (odd_docs, no_docs):
            out = stage(spark, docs, sf_dir)
            assert out.count() <= docs.count()
            if name != pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
