"""Quality classification by co-training of two views (operator 2).

The text view sees a document's content only: proportions of character classes, word and line statistics and hashed byte
pairs, none of which tells the length. The metadata view sees only the columns beside the text: language, source and length. Each view has a ridge
logistic regression, calibrated on held-out labels. In each round either view labels every document that is not in the labelled sample and
that it is confident about, and the other view learns from these labels, which together weigh no more than the sample: the metadata view is
fitted again on counts of what was labelled, the text view takes a Newton step on sums over all of it. A view that is never confident
hands on nothing. At the end a small logistic model, fitted on the held-out labels, combines the two calibrated scores, and every document is scored.

On Spark. Features of all documents are computed once and kept in the shared folder in half precision. A round is one pass over them: each task adds up
its counts and sums, and these are added up in groups of FAN_IN until at most that many are left for the driver, so what is collected is bounded.

Bounds. `most_labelled` bounds the sample of labelled documents, the first by the hash of their id, that the views are fitted and calibrated on; labelled
documents beyond it take part as unlabelled ones. Nothing else is bounded: pseudo-labels come from all documents. Scoring needs no shuffle.

Cases: a null text is empty; null metadata is a category of its own, a null length is zero. A very long text is read whole. A document with several labels
takes the lower quality; of a sampled id with several rows the smallest features are taken, both views from one row. Ties in the sample go to the smaller id.
Repeated rows are scored alike. Without labels of both classes nothing can be learned:
every score is 0.5 and every document is kept. An empty table gives an empty result. Other input columns are ignored; the filter keeps them.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.llm.workers import then_give_back
from concord.session import cut_lineage

MOST_LABELLED = 6000
ROUNDS = 3
CONFIDENT = 0.98
PAIRS = 256
STYLE = 13
META = 96
SEED = 7
FAN_IN = 32
RIDGES = (0.3, 3.0)


def _classes() -> np.ndarray:
    table = np.zeros((256, 6))
    for k, members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>~^_=+@\\{}[]", b"!?", b".,;:'\"()-", b" \t\n\r\x0b\x0c")):
        table[np.frombuffer(members, dtype=np.uint8), k] = 1
    return table


_CLASSES = _classes()


def text_features(text: str | None) -> np.ndarray:
    """STYLE statistics and PAIRS hashed byte pairs of a text, all of a scale that does not grow with its length."""
    data = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(STYLE + PAIRS, dtype=np.float32)
    if not data:
        return out
    b = np.frombuffer(data, dtype=np.uint8)
    counts = np.bincount(b, minlength=256)
    out[:6] = counts @ _CLASSES / len(b)
    words = data.split()
    n = max(1, len(words))
    out[6] = (len(b) - counts[32] - counts[10]) / n / 20
    out[7] = len(set(words)) / n
    out[8] = sum(map(bytes.__eq__, words[1:], words[:-1])) / n
    lines = data.split(b"\n")
    out[9] = len(set(lines)) / len(lines)
    out[10] = np.log1p(len(b) / len(lines)) / 10
    out[11] = sum(map(bytes.isupper, words)) / n
    out[12] = sum(w[-1] not in _LETTERS for w in words) / n
    if len(b) > 1:
        pair = (b[:-1].astype(np.uint32) * 31 + b[1:]) % PAIRS
        out[STYLE:] = np.sqrt(np.bincount(pair, minlength=PAIRS) / (len(b) - 1))
    return out


_LETTERS = frozenset([*range(65, 91), *range(97, 123), *range(128, 256)])


def _slot(name: str, value: str | None, size: int) -> int:
    return zlib.crc32(f"{name}={value}".encode()) % size


def meta_slots(lang: str | None, source: str | None, n_chars: float | None) -> tuple[int, int, int]:
    """The places, of META, that language, source and a length bucket take."""
    length = 0 if n_chars is None or n_chars != n_chars else max(0, int(n_chars))
    return _slot("lang", lang, 16), 16 + _slot("source", source, 56), 72 + min(23, length.bit_length())


def spread(slots: np.ndarray, width: int) -> np.ndarray:
    """A row of zeros with a one in each of its slots."""
    out = np.zeros((len(slots), width))
    np.put_along_axis(out, slots.astype(np.int64), 1, axis=1)
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float, weight: np.ndarray | None = None, steps: int = 12) -> np.ndarray:
    """Weights, the last for a constant, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    weight = np.ones(len(x)) if weight is None else weight
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def apply_logistic(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class CoTrained:
    """Weights of both views, their calibrations and the combination; `learned` is False where labels were missing.

    exchanged has for each round the labels handed on: good and bad by the text view, good and bad by the metadata view."""

    views: tuple[np.ndarray, np.ndarray]
    calibration: tuple[np.ndarray, np.ndarray]
    combination: np.ndarray
    learned: bool = True
    exchanged: list[tuple[int, ...]] = field(default_factory=list)

    def logits(self, content: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated, of the text and of the metadata view."""
        raw = apply_logistic(content, self.views[0]), self.views[1][slots.astype(np.int64)].sum(axis=1) + self.views[1][-1]
        return tuple(apply_logistic(z[:, None], c) for z, c in zip(raw, self.calibration, strict=True))

    def scores(self, content: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality from the text, from the metadata and from both."""
        if not self.learned:
            half = np.full(len(content), 0.5)
            return half, half, half
        z = self.logits(content, slots)
        return sigmoid(z[0]), sigmoid(z[1]), sigmoid(apply_logistic(np.stack(z, axis=1), self.combination))


@dataclass
class Taught:
    """What the views hand each other: n labels (as in CoTrained.exchanged); for the text view its gradient and Hessian over the rows that the metadata
    labelled; for the metadata view the distinct slots of the rows that the text labelled, with the number labelled bad and good."""

    n: np.ndarray
    gradient: np.ndarray
    hessian: np.ndarray
    slots: np.ndarray
    counts: np.ndarray

    def __add__(self, other: Taught) -> Taught:
        slots, counts = _summed(np.concatenate([self.slots, other.slots]), np.concatenate([self.counts, other.counts]))
        return Taught(self.n + other.n, self.gradient + other.gradient, self.hessian + other.hessian, slots, counts)


def _summed(slots: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(slots, axis=0, return_inverse=True)
    out = np.zeros((len(found), 2), dtype=np.int64)
    np.add.at(out, at.reshape(-1), counts)
    return found, out


def teach(model: CoTrained, content: np.ndarray, slots: np.ndarray, confident: float) -> Taught:
    """What the documents of these features give, under the present views."""
    by_text, by_meta = (sigmoid(z) for z in model.logits(content, slots))
    sure = [(p >= confident) | (p <= 1 - confident) for p in (by_text, by_meta)]
    good = [by_text >= confident, by_meta >= confident]
    n = np.array([x.sum() for s, g in zip(sure, good, strict=True) for x in (s & g, s & ~g)], dtype=np.int64)
    w = model.views[0]
    x = np.hstack([content[sure[1]], np.ones((n[2] + n[3], 1))]).astype(np.float64)
    p = sigmoid(x @ w)
    gradient, hessian = x.T @ (good[1][sure[1]] - p), (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x
    label = np.stack([~good[0][sure[0]], good[0][sure[0]]], axis=1).astype(np.int64)
    return Taught(n, gradient, hessian, *_summed(slots[sure[0]], label))


def co_train(content: np.ndarray, slots: np.ndarray, y: np.ndarray, ask: Callable[[CoTrained], Taught], width: int, rounds: int) -> CoTrained:
    """y is 0 or 1; every fourth labelled row is held out for calibration and combination. ask gives what all unlabelled documents teach under a model.

    width: the number of slots there are."""
    if len(np.unique(y)) < 2 or min(np.bincount(y.astype(int))) < 8:
        return CoTrained((np.empty(0), np.empty(0)), (np.empty(0), np.empty(0)), np.empty(0), learned=False)
    held = np.zeros(len(y), dtype=bool)
    for value in (0, 1):
        held[np.flatnonzero(y == value)[::4]] = True
    meta = spread(slots, width)

    def calibrated(text: np.ndarray, other: np.ndarray, exchanged: list) -> CoTrained:
        z = apply_logistic(content[held], text), apply_logistic(meta[held], other)
        c = tuple(fit_logistic(v[:, None], y[held], 1e-2) for v in z)
        both = np.stack([apply_logistic(v[:, None], k) for v, k in zip(z, c, strict=True)], axis=1)
        return CoTrained((text, other), c, fit_logistic(both, y[held], 1e-2), exchanged=exchanged)

    def share(n: int) -> float:
        return min(0.5, (~held).sum() / max(1, n))

    model = calibrated(fit_logistic(content[~held], y[~held], RIDGES[0]), fit_logistic(meta[~held], y[~held], RIDGES[1]), [])
    for _ in range(rounds):
        taught = ask(model)
        if not taught.n.any():
            break
        text = model.views[0]
        if taught.n[2:].any():
            text = text + _step(content[~held], y[~held], text, RIDGES[0], taught, share(int(taught.n[2:].sum())))
        rows = [meta[~held], *[spread(taught.slots, width)] * 2]
        labels = [y[~held], np.zeros(len(taught.slots)), np.ones(len(taught.slots))]
        weight = [np.ones((~held).sum()), *(taught.counts * share(int(taught.n[:2].sum()))).T]
        model = calibrated(text, fit_logistic(np.vstack(rows), np.concatenate(labels), RIDGES[1], np.concatenate(weight)), [*model.exchanged, tuple(taught.n.tolist())])
    return model


def _step(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float, taught: Taught, share: float) -> np.ndarray:
    """A Newton step of the text view on the sample and, weighed by share, on what it was taught."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    penalty = np.append(np.full(len(w) - 1, ridge), 1e-6)
    p = sigmoid(x @ w)
    hessian = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty) + share * taught.hessian
    return np.linalg.solve(hessian, x.T @ (y - p) - penalty * w + share * taught.gradient)


def _views(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    none = lambda v: None if v is None or v != v else v
    content = [text_features(none(t)) for t in text]
    slots = [meta_slots(none(a), none(b), none(c)) for a, b, c in zip(lang, source, n_chars, strict=True)]
    return np.array(content, dtype=np.float32).reshape(-1, STYLE + PAIRS), np.array(slots, dtype=np.int16).reshape(-1, 3)


def _inputs(docs: DataFrame) -> list[Column]:
    """text, lang, source and n_chars; a column that docs lacks is null."""
    have = {"text": "string", "lang": "string", "source": "string", "n_chars": "double"}
    return [(F.col(f"`{c}`") if c in docs.columns else F.lit(None)).cast(kind).alias(c) for c, kind in have.items()]


def first_by_hash(ids: DataFrame, most: int) -> DataFrame:
    """The rows of ids (doc_id and others) with the `most` smallest hashes of doc_id.

    Hashes above about twice the share that is wanted are left out before the limited sort, so that its tasks hand on few
    rows each, however many tasks a large table has."""
    spread = F.xxhash64("doc_id", F.lit(SEED))
    n = ids.count()
    share = 1.0 if n <= 4 * most else (2 * most + 100) / n
    bound = min(2**63 - 1, int(-(2**63) + share * 2**64))
    return ids.where(spread <= F.lit(bound)).orderBy(spread, "doc_id").limit(most)


def features(docs: DataFrame) -> DataFrame:
    """doc_id, content (half precision) and slots of every row, as binary."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            content, slots = _views(p["text"], p["lang"], p["source"], p["n_chars"])
            yield pd.DataFrame({"doc_id": p["doc_id"], "content": [c.tobytes() for c in content.astype("<f2")], "slots": [k.tobytes() for k in slots.astype("<i2")]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *_inputs(docs)).mapInPandas(lambda parts: then_give_back(run(parts)), f"doc_id {kind}, content binary, slots binary")


def _matrix(values, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=kind).reshape(-1, width)


def labelled_sample(found: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, pd.DataFrame]:
    """The sampled ids with their quality, and the features of these documents: at most `most` rows, in the order of ids."""
    # An id's label is its lowest, over all labels.
    labelled = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    picked = cut_lineage(first_by_hash(labelled, most))
    rows = found.join(F.broadcast(picked), "doc_id")  # bounded
    # A row for each id, also where ids repeat, so the bound holds; both views are of one document.
    return picked, rows.groupBy("doc_id", "quality").agg(F.min(F.struct("content", "slots")).alias("f")).select("doc_id", "quality", "f.*").orderBy("doc_id").toPandas()


TAUGHT = "n binary, gradient binary, hessian binary, slots binary, counts binary"


def _to_row(t: Taught) -> dict[str, bytes]:
    return {"n": t.n.astype("<i8").tobytes(), "gradient": t.gradient.tobytes(), "hessian": t.hessian[np.triu_indices(len(t.hessian))].tobytes(), "slots": t.slots.astype("<i2").tobytes(), "counts": t.counts.astype("<i8").tobytes()}


def _from_row(row, width: int) -> Taught:
    size = width + 1
    upper = np.zeros((size, size))
    upper[np.triu_indices(size)] = np.frombuffer(row["hessian"])
    hessian = upper + np.triu(upper, 1).T
    return Taught(np.frombuffer(row["n"], "<i8"), np.frombuffer(row["gradient"]), hessian, np.frombuffer(row["slots"], "<i2").reshape(-1, 3), np.frombuffer(row["counts"], "<i8").reshape(-1, 2))


def taught_by_all(found: DataFrame, model: CoTrained, confident: float) -> Taught:
    """What all rows of found (content, slots) teach: one pass, then sums of sums until few are left."""
    width = STYLE + PAIRS
    sent = found.sparkSession.sparkContext.broadcast(model)
    none = Taught(np.zeros(4, np.int64), np.zeros(width + 1), np.zeros((width + 1, width + 1)), np.zeros((0, 3), np.int16), np.zeros((0, 2), np.int64))

    def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = none
        for b in batches:
            total = total + teach(sent.value, _matrix(b.column(0).to_pylist(), "<f2", width).astype(np.float32), _matrix(b.column(1).to_pylist(), "<i2", 3), confident)
        if total.n.any():
            yield pa.RecordBatch.from_pylist([_to_row(total)])

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_to_row(functools.reduce(Taught.__add__, (_from_row(r, width) for _, r in rows.iterrows())))])

    sums = cut_lineage(found.select("content", "slots").mapInArrow(lambda batches: then_give_back(one_pass(batches)), TAUGHT))
    while (n := sums.count()) > FAN_IN:
        groups = -(-n // FAN_IN)
        dealt = sums.withColumn("group", F.pmod(F.xxhash64("n", "gradient", F.spark_partition_id()), F.lit(groups)))
        sums = cut_lineage(dealt.groupBy("group").applyInPandas(lambda key, rows: add_up(rows), TAUGHT))
    return functools.reduce(Taught.__add__, (_from_row(r, width) for r in sums.collect()), none)


def train(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, rounds: int = ROUNDS, confident: float = CONFIDENT) -> CoTrained:
    found = cut_lineage(features(docs))
    picked, rows = labelled_sample(found, labels, most_labelled)
    ids = F.broadcast(picked.select(F.col("doc_id").alias("known")))  # bounded
    others = found.join(ids, F.col("doc_id") == F.col("known"), "left_anti")
    content, slots = _matrix(rows["content"], "<f2", STYLE + PAIRS).astype(np.float32), _matrix(rows["slots"], "<i2", 3)
    return co_train(content, slots, rows["quality"].to_numpy(dtype=float), lambda model: taught_by_all(others, model, confident), META, rounds)


def _scorer(model: Broadcast):
    @F.pandas_udf("text_score double, meta_score double, score double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from then_give_back(pd.DataFrame(dict(zip(("text_score", "meta_score", "score"), model.value.scores(*_views(*part)), strict=True))) for part in parts)

    return score


def score_documents(docs: DataFrame, model: CoTrained, threshold: float = 0.5) -> DataFrame:
    """doc_id, the scores of both views, the combined score and keep, for every row."""
    score = _scorer(docs.sparkSession.sparkContext.broadcast(model))
    found = docs.select("doc_id", score(*_inputs(docs)).alias("s"))
    return found.select("doc_id", "s.text_score", "s.meta_score", "s.score", (F.col("s.score") >= threshold).alias("keep"))


def keep_good(docs: DataFrame, model: CoTrained, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns as they are, that the classifier keeps."""
    score = _scorer(docs.sparkSession.sparkContext.broadcast(model))
    judged = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), score(*_inputs(docs)).alias("s"))
    return judged.where(F.col("s.score") >= threshold).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op2_co_training(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return score_documents(docs, train(docs, labels))
