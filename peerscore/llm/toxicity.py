"""Toxicity scoring with a factorization machine over hashed terms (operator 2).

A text's terms are its distinct lower-case words and their first four and five letters, hashed into
``BUCKETS`` buckets. The machine scores ``w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j``: the last
sum lets a pair of terms weigh more, or less, than its two terms alone. Only buckets whose presence
goes with the label (a two-proportion z-score over the training rows) get weights, and buckets of
pairs that go with it more than their two terms do alone: every pair of the ``frequent`` most frequent
buckets is tested by its co-occurrences, so a term that is harmless by itself gets a factor.

Nulls and odd rows: a NULL or empty text has no terms and gets the score of ``w0`` alone. Rows with a
NULL id or a NULL label are never learned from; of several labels of one document the highest
counts. Repeated documents are scored each. Very long texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.common import arrow_rows, bounded_sample, remainder, with_fields, without

BUCKETS = 1 << 18
THRESHOLD = 0.3
BATCH = 256
_WORD = re.compile(r"[^\W\d_]+")
_KEPT_WORDS = 1 << 17


def term_buckets(word: str) -> tuple[int, ...]:
    """Buckets of a lower-case word: the word itself and its four- and five-letter beginnings."""
    terms = [word] + [f"{word[:n]}*" for n in (4, 5) if len(word) > n]
    return tuple(crc32(t.encode("utf-8", "surrogatepass")) % BUCKETS for t in terms)


def words(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class FactorizationMachine:
    """``slot`` maps a bucket to its row of ``w`` and ``v``."""

    slot: dict[int, int]
    w0: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, slots: list[int]) -> float:
        if not slots:
            return self.w0
        v = self.v[slots]
        s = v.sum(axis=0)
        return self.w0 + float(self.w[slots].sum()) + 0.5 * float((s * s - (v * v).sum(axis=0)).sum())

    def score(self, slots: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(slots), -30, 30))))


def slots_of(text: str | None, slot: dict[int, int], known: dict[str, tuple[int, ...]]) -> list[int]:
    """The machine's rows that a text's terms switch on (``known`` remembers words already hashed)."""
    on: set[int] = set()
    if len(known) > _KEPT_WORDS:
        known.clear()
    for w in words(text):
        s = known.get(w)
        if s is None:
            s = known[w] = tuple(slot[b] for b in term_buckets(w) if b in slot)
        if s:
            on.update(s)
    return sorted(on)


def _bucket_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pos, neg = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b in arrow_rows(batches):
        for text, toxic in zip(b.column("text").to_pylist(), b.column("_toxic").to_pylist(), strict=True):
            at = {x for w in words(text) for x in term_buckets(w)}
            (pos if toxic else neg)[list(at)] += 1
    at = np.flatnonzero(pos + neg)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(pos[at]), pa.array(neg[at])], names=["bucket", "pos", "neg"])


def _train(rows: list[list[int]], y: np.ndarray, size: int, factors: int, epochs: int, rate: float, decay: float):
    """Logistic loss, Adagrad, mini-batches of ``BATCH`` rows."""
    rng = np.random.default_rng(7)
    w0, w, v = 0.0, np.zeros(size), rng.normal(0, 0.05, (size, factors))
    g0, gw, gv = 1e-8, np.full(size, 1e-8), np.full((size, factors), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            part = order[at : at + BATCH]
            x = np.zeros((len(part), size))
            for k, r in enumerate(part):
                x[k, rows[r]] = 1
            s = x @ v
            margin = w0 + x @ w + 0.5 * ((s * s).sum(axis=1) - x @ (v * v).sum(axis=1))
            err = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[part]
            d0, dw = err.mean(), x.T @ err / len(part) + decay * w
            dv = (x.T @ (err[:, None] * s) - (x.T @ err)[:, None] * v) / len(part) + decay * v
            g0, gw, gv = g0 + d0 * d0, gw + dw * dw, gv + dv * dv
            w0, w, v = w0 - rate * d0 / g0**0.5, w - rate * dw / np.sqrt(gw), v - rate * dv / np.sqrt(gv)
    return w0, w, v


def paired_terms(rows: list[list[int]], positive: np.ndarray, tested: dict[int, int], pair_z: float, most: int) -> list[int]:
    """Buckets (values of ``tested``, whose keys are their numbers in ``rows``) of pairs that go with the label by more than their terms do."""
    at = {k: j for j, k in enumerate(tested)}
    x = np.zeros((len(rows), len(at)), np.float32)
    for r, on in enumerate(rows):
        x[r, [at[k] for k in on if k in at]] = 1
    n_pos, n_neg = int(positive.sum()), int((~positive).sum())
    if not n_pos or not n_neg:
        return []
    pos, neg = x[positive].T @ x[positive], x[~positive].T @ x[~positive]  # the diagonals are the terms alone
    share = (pos + neg) / (n_pos + n_neg)
    spread = np.sqrt(share * (1 - share) * (1 / n_pos + 1 / n_neg))
    z = np.abs(pos / n_pos - neg / n_neg) / np.maximum(spread, 1e-9)
    alone = np.diag(z)
    gain = np.where((pos + neg >= 10) & (z >= pair_z), z - np.maximum(alone[:, None], alone[None, :]), 0)
    out: dict[int, None] = {}
    buckets = list(tested.values())
    order = np.argsort(-np.triu(gain, 1), axis=None, kind="stable")
    for flat in order[: most * most].tolist():
        i, j = divmod(flat, len(buckets))
        if gain[i, j] < pair_z / 2 or j <= i or len(out) >= most:
            break
        out |= {buckets[i]: None, buckets[j]: None}
    return list(out)[:most]


def fit(
    docs: DataFrame, labels: DataFrame, train_rows: int = 20_000, terms: int = 1024, min_z: float = 4.5,
    min_documents: int = 3, frequent: int = 512, pair_terms: int = 128, pair_z: float = 8.0, factors: int = 8, epochs: int = 20, min_steps: int = 600, rate: float = 0.1, decay: float = 1e-5,
) -> FactorizationMachine:
    """Fit the machine on about ``train_rows`` labelled documents (a fixed hash sample; all if fewer).

    Training runs over ``epochs``, and over more if those are fewer than ``min_steps`` mini-batches.

    The sample of ``labels`` is broadcast (its size is bounded by ``train_rows``), so the texts are
    not shuffled. Buckets are counted in Spark; the ``terms`` buckets of the largest z-scores stay, and
    up to ``pair_terms`` buckets of the pairs whose joint z-score is at least ``pair_z`` and exceeds its
    terms' own by half as much. What reaches the driver is bounded by ``terms``, ``frequent`` and ``train_rows``.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    sample = known.where(bounded_sample("doc_id", known.count(), train_rows)).groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    learn = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", (F.col("_toxic") == 1).alias("_toxic"))
    sizes = {r["_toxic"]: r["n"] for r in sample.groupBy((F.col("_toxic") == 1).alias("_toxic")).agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos or not n_neg:
        rate_pos = (n_pos + 0.5) / (n_pos + n_neg + 1)
        return FactorizationMachine({}, float(np.log(rate_pos / (1 - rate_pos))), np.zeros(0), np.zeros((0, factors)))
    counts = learn.mapInArrow(_bucket_labels, "bucket int, pos long, neg long").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    share = (F.col("pos") + F.col("neg")) / F.lit(n_pos + n_neg)
    spread = F.sqrt(share * (1 - share) * F.lit(1 / n_pos + 1 / n_neg))
    z = F.abs(F.col("pos") / n_pos - F.col("neg") / n_neg) / F.greatest(spread, F.lit(1e-9))
    best = counts.select("bucket", z.alias("z"), (F.col("pos") + F.col("neg")).alias("n")).where((F.col("z") >= min_z) & (F.col("n") >= min_documents)).orderBy(F.desc("z"), "bucket").limit(terms)
    own = [r["bucket"] for r in best.collect()]
    common = counts.where((F.col("pos") + F.col("neg")).between(min_documents, 0.6 * (n_pos + n_neg))).orderBy(F.desc(F.col("pos") + F.col("neg")), "bucket").limit(frequent)
    tested = [r["bucket"] for r in common.collect()]
    slot = {b: k for k, b in enumerate(dict.fromkeys(own + tested))}

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[int, ...]] = {}
        for b in arrow_rows(batches):
            on = [slots_of(t, slot, seen) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_toxic"), pa.array(on, pa.list_(pa.int32()))], names=["toxic", "slots"])

    rows = sorted((list(r["slots"]), bool(r["toxic"])) for r in learn.mapInArrow(featured, "toxic boolean, slots array<int>").toLocalIterator())
    if not rows:  # labels, but none of a document
        return FactorizationMachine({}, float(np.log((n_pos + 0.5) / (n_neg + 0.5))), np.zeros(0), np.zeros((0, factors)))
    y = np.array([t for _, t in rows], float)
    chosen = own + [b for b in paired_terms([s for s, _ in rows], y > 0, {slot[b]: b for b in tested}, pair_z, pair_terms) if b not in set(own)]
    renamed = {slot[b]: k for k, b in enumerate(chosen)}
    rows = [(sorted(renamed[k] for k in s if k in renamed), t) for s, t in rows]
    slot = {b: k for k, b in enumerate(chosen)}
    epochs = max(epochs, -(-min_steps // -(-len(rows) // BATCH)))
    w0, w, v = _train([s for s, _ in rows], y, len(slot), factors, epochs, rate, decay)
    return FactorizationMachine(slot, float(w0), w, v)


def score(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """``docs`` with ``_tox_score`` (0 to 1) added (a column of that name is replaced); only ``text`` is read."""
    docs = without(docs, "_tox_score")
    shared = docs.sparkSession.sparkContext.broadcast((model.slot, model.w0, model.w, model.v))  # no class of this package

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm, seen = FactorizationMachine(*shared.value), {}
        for b in arrow_rows(batches):
            got = [fm.score(slots_of(t, fm.slot, seen)) for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], names=[*b.schema.names, "_tox_score"])

    return docs.mapInArrow(run, with_fields(docs, _tox_score="double"))


def learnable(docs: DataFrame, mod: int = 4, held: int = 2) -> DataFrame:
    """Rows the model may learn from: crc32(doc_id as text) mod ``mod`` is not ``held``."""
    return docs.where(remainder("doc_id", mod) != held).select("doc_id", "text")
