from __future__ import annotations

import corpus_pipeline
import pytest
from concord.llm import quality_classifier, rule_ledger, secret_links, simhash_dedup


def test_stages_by_hand(spark, sf_dir, documents, tmp_path):
    """Each stage against what its operator says about all of its input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs, out = documents, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(k)))
        docs = out[name] = spark.read.parquet(str(tmp_path / str(k)))
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    scored = quality_classifier.score_documents(documents, quality_classifier.train(documents, labels))
    assert ids(out[names[0]]) == ids(scored.where("keep")) and 0 < len(ids(out[names[0]])) < documents.count()
    ledger = rule_ledger.build_ledger(out[names[0]])
    assert ids(out[names[1]]) == ids(ledger.where(rule_ledger.passes(rule_ledger.CURRENT)))
    texts = sorted((r["doc_id"], r["text"]) for r in out[names[1]].collect())
    sets = [set(simhash_dedup.shingle_hashes(t, 5).tolist()) for _, t in texts]
    left = ids(out[names[2]])
    first = {}  # one of each group stays: every text that went is similar to one of a smaller id
    for k, (i, _) in enumerate(texts):
        similar = [j for j in range(len(texts)) if j != k and len(sets[j] & sets[k]) >= 0.8 * len(sets[j] | sets[k])]
        first[i] = min([i, *(texts[j][0] for j in similar)])
    assert left == {i for i in first if first[i] == i} < ids(out[names[1]])
    assert ids(out[names[3]]) == ids(out[names[2]])
    assert all(r["spans"] == "" for r in secret_links.find_secrets(out[names[3]]).collect())
    assert all(out[n].columns == documents.columns for n in names[:4])
    pieces = out[names[4]]
    assert ids(pieces) == ids(out[names[3]])
    assert pieces.groupBy("doc_id", "doc_tokens").agg({"length": "sum"}).where("doc_tokens <> `sum(length)`").count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_documents(spark, sf_dir, odd_documents, no_documents, empty):
    docs = no_documents if empty else odd_documents
    for name, stage in corpus_pipeline.STAGES[:4]:
        found = stage(spark, docs, sf_dir)
        assert found.columns == docs.columns, name
        docs = found
    left = {r["doc_id"] for r in docs.collect()}
    assert not left if empty else left <= {1, 2, None, 8}
    assert corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).count() >= len(left)


def test_run_is_registered(spark, sf_dir):
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries()
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
