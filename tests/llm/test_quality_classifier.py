from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.llm import quality_classifier as q


def test_held_out_accuracy(spark, sf_dir):
    """Trained on the labels of two thirds of the documents, judged on the others."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = q.train(docs, labels.where("pmod(doc_id, 3) <> 0"))
    judged = q.score_documents(docs, model).join(labels.where("pmod(doc_id, 3) = 0"), "doc_id").select("keep", "quality", "score").collect()
    assert len(judged) > 100
    assert sum(r["keep"] != (r["quality"] == 1) for r in judged) <= 0.03 * len(judged)
    assert sum(not r["keep"] for r in judged if r["quality"] == 1) <= 0.02 * len(judged)


def test_views_exchange_confident_labels():
    """The metadata view learns from the text view's labels of unlabelled documents, where it has few of its own, and hands labels back."""
    rng = np.random.default_rng(0)
    y = (rng.random(60) < 0.5).astype(float)
    truth = (rng.random(400) < 0.5).astype(float)
    text = lambda t: (t[:, None] * 4 - 2 + rng.normal(0, 0.5, (len(t), 3))).astype(np.float32)
    meta = lambda t: (rng.integers(0, 20, len(t)) * 2 + t).astype(np.int16)[:, None]
    args = text(y), meta(y), y
    pool = text(truth), meta(truth)
    alone = q.co_train(*args, lambda m: q.teach(m, pool[0][:0], pool[1][:0], 0.98), 40, 3)
    taught = q.co_train(*args, lambda m: q.teach(m, *pool, 0.9), 40, 3)
    assert alone.exchanged == [] and len(taught.exchanged) == 3
    assert sum(taught.exchanged[0][:2]) > 100 and sum(taught.exchanged[-1][2:]) > 50
    fresh = (rng.random(500) < 0.5).astype(float)
    views = text(fresh), meta(fresh)
    accuracy = lambda model: ((model.scores(*views)[1] > 0.5) == fresh).mean()
    assert accuracy(taught) > accuracy(alone) + 0.02


def test_newton_step_descends():
    """On the weighted loss written out plainly."""
    rng = np.random.default_rng(1)
    x, pool = rng.normal(size=(80, 3)).astype(np.float32), rng.normal(size=(300, 3)).astype(np.float32)
    y, slots = (x[:, 0] + rng.normal(size=80) > 0).astype(float), (pool[:, :1] > 0).astype(np.int16)
    model = q.CoTrained((q.fit_logistic(x, y, 0.3), np.array([-4.0, 4.0, 0.0])), (np.array([1.0, 0.0]),) * 2, np.zeros(3))
    taught = q.teach(model, pool, slots, 0.95)
    assert taught.n[2] + taught.n[3] == 300 and taught.n[2] == (slots == 1).sum()

    def loss(w):
        total = 0.15 * sum(v * v for v in w[:-1]) + 5e-7 * w[-1] ** 2
        for rows, labels, weight in ((x, y, 1.0), (pool, slots[:, 0], 0.2)):
            for row, label in zip(rows.astype(float), labels, strict=True):
                z = sum(a * b for a, b in zip(row, w, strict=False)) + w[-1]
                total += weight * (np.log1p(np.exp(-z)) if label else np.log1p(np.exp(z)))
        return total

    w = model.views[0]
    step = q._step(x, y, w, 0.3, taught, 0.2)
    assert loss(w + step) < loss(w) and abs(loss(w + step) - min(loss(w + t * step) for t in (0.5, 0.8, 1.0, 1.2))) < 0.05 * loss(w)


def test_sums_do_not_depend_on_the_partitions(documents, monkeypatch):
    """One pass over all documents in one piece, against tasks whose sums are added up in groups."""
    monkeypatch.setattr(q, "FAN_IN", 3)
    found = q.features(documents)
    rows = found.toPandas()
    content, slots = q._matrix(rows["content"], "<f2", q.STYLE + q.PAIRS).astype(np.float32), q._matrix(rows["slots"], "<i2", 3)
    rng = np.random.default_rng(2)
    model = q.CoTrained((rng.normal(0, 3, q.STYLE + q.PAIRS + 1), rng.normal(0, 2, q.META + 1)), (np.array([1.0, 0.0]),) * 2, np.zeros(3))
    wanted = q.teach(model, content, slots, 0.8)
    got = q.taught_by_all(found.repartition(8), model, 0.8)
    assert (got.n == wanted.n).all() and (wanted.n > 0).sum() >= 3 and (got.slots == wanted.slots).all() and (got.counts == wanted.counts).all()
    assert np.allclose(got.gradient, wanted.gradient) and np.allclose(got.hessian, wanted.hessian)


def plain_features(text):
    """text_features by loops over characters."""
    data = (text or "").encode()
    out = [0.0] * (q.STYLE + q.PAIRS)
    if not data:
        return out
    groups = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>~^_=+@\\{}[]", "!?", ".,;:'\"()-", " \t\n\r\x0b\x0c")
    for k, group in enumerate(groups):
        out[k] = sum(chr(c) in group for c in data) / len(data)
    words, lines = data.split(), data.split(b"\n")
    n = max(1, len(words))
    letter = lambda c: chr(c).isascii() and chr(c).isalpha() or c >= 128
    out[6] = sum(c not in b" \n" for c in data) / n / 20
    out[7] = len(set(words)) / n
    out[8] = sum(words[i] == words[i + 1] for i in range(len(words) - 1)) / n
    out[9] = len(set(lines)) / len(lines)
    out[10] = np.log(1 + len(data) / len(lines)) / 10
    out[11] = sum(w.isupper() for w in words) / n
    out[12] = sum(not letter(w[-1]) for w in words) / n
    pairs = [0] * q.PAIRS
    for a, b in zip(data, data[1:], strict=False):
        pairs[(31 * a + b) % q.PAIRS] += 1
    for k in range(q.PAIRS):
        out[q.STYLE + k] = (pairs[k] / max(1, len(data) - 1)) ** 0.5
    return out


@pytest.mark.parametrize("text", [None, "", "a", "The CAT sat. sat!\n\nThe dog; 42 <b>", "Ärger über Öl\tÄrger\n" * 3, " \n "])
def test_features_against_plain_loops(text):
    assert np.allclose(q.text_features(text), plain_features(text), atol=1e-5)


def test_training_sample_is_bounded(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    picked, rows = q.labelled_sample(q.features(documents), labels, 30)
    assert picked.count() == 30 and len(rows) == len(set(rows["doc_id"])) == 30


def test_both_views_are_of_one_document(spark):
    docs = spark.createDataFrame([(1, "zzz zzz", "en", "a", 7), (1, "A b c", "de", "b", 5)], "doc_id long, text string, lang string, source string, n_chars long")
    _, rows = q.labelled_sample(q.features(docs), spark.createDataFrame([(1, 1)], "doc_id long, quality int"), 5)
    pairs = {(r["content"], r["slots"]) for r in q.features(docs).collect()}
    assert [(r["content"], r["slots"]) for _, r in rows.iterrows()][0] in {(bytes(a), bytes(b)) for a, b in pairs} and len(rows) == 1


@pytest.mark.parametrize("n", [0, 30, 150, 50_000])
def test_first_by_hash(spark, n):
    ids = spark.range(n).withColumnRenamed("id", "doc_id")
    wanted = [r["doc_id"] for r in ids.orderBy(F.xxhash64("doc_id", F.lit(q.SEED)), "doc_id").limit(40).collect()]
    assert [r["doc_id"] for r in q.first_by_hash(ids, 40).collect()] == wanted


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, 0), (5, None, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")


def test_odd_documents_without_enough_labels(odd_documents, labels):
    model = q.train(odd_documents, labels)
    rows = q.score_documents(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and all(r["keep"] and r["score"] == 0.5 for r in rows)
    assert q.keep_good(odd_documents, model).columns == odd_documents.columns


def test_odd_documents_are_scored(spark, sf_dir, odd_documents, no_documents, documents):
    model = q.train(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert model.learned
    rows = q.score_documents(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    same = [r["score"] for r in rows if r["doc_id"] == 2]
    assert len(same) == 2 and same[0] == same[1]
    assert q.score_documents(no_documents, model).collect() == [] and q.keep_good(no_documents, model).collect() == []
    kept = q.keep_good(odd_documents, model)
    assert kept.count() == sum(r["keep"] for r in rows) and kept.schema == odd_documents.schema


def test_no_documents_to_train_on(no_documents, labels):
    assert not q.train(no_documents, labels).learned


def test_columns_that_are_missing(spark, labels):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert q.score_documents(docs, q.train(docs, labels)).select(F.col("keep")).first()[0]
