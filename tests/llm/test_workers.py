from __future__ import annotations

import pytest

from concord.llm import packing, workers


def test_what_a_task_learned_goes_with_it(spark, sf_dir):
    """A worker is kept for the next stage; the encoder that it keeps holds no pieces then."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").coalesce(1)
    packing.tokenize_and_cut(docs, path, 2048, 32, 1, "doc_id", "text").count()
    held = spark.range(1).coalesce(1).mapInPandas(lambda parts: (p.assign(id=sum(map(len, (e.once, e.often, e.words)))) for p in parts for e in [packing.encoder(path)]), "id long")
    assert held.first()["id"] == 0


def test_end_is_told_after_an_error_too():
    ended = []
    with pytest.raises(ZeroDivisionError):
        list(workers.then_give_back((1 / x for x in (1, 0)), lambda: ended.append(1)))
    assert list(workers.then_give_back(iter([1, 2]), lambda: ended.append(2))) == [1, 2] and ended == [1, 2]
