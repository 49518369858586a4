"""Language identification by nearest centroid (operator 5).

A text becomes a TF-IDF vector of hashed letter 1- to 3-grams. Each language has several centroids,
found by clustering its training vectors on the unit sphere; a text takes the language of the
centroid with the largest cosine and is *rejected* when even that centroid is farther away than its
reject distance.

Nulls and odd rows: a NULL text, or one without a letter, gets ``und`` with score 0 and is rejected.
Rows with a NULL id or NULL language are never learned from. Very long texts are read whole. Ties
between languages go to the smaller name. Without training rows every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.common import arrow_rows, bounded_sample, remainder, with_fields, without

DIMS = 4096
UND = "und"
_LETTER = np.zeros(1 << 16, bool)


def _letter_table() -> np.ndarray:
    if not _LETTER[ord("a")]:
        _LETTER[:] = [chr(c).isalpha() for c in range(1 << 16)]
    return _LETTER


def _letters(codes: np.ndarray) -> np.ndarray:
    known = _letter_table()[np.minimum(codes, 0xFFFF)]
    for c in np.unique(codes[codes > 0xFFFF]):  # a handful of distinct values at most
        known[codes == c] = chr(c).isalpha()
    return known


def gram_counts(texts: list[str | None], dims: int = DIMS) -> np.ndarray:
    """Row per text: counts of hashed letter 1-, 2- and 3-grams (words framed by blanks)."""
    out = np.zeros((len(texts), dims), np.float32)
    for k, text in enumerate(texts):
        if not text:
            continue
        codes = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters(codes)
        codes = np.where(letter, codes, 32).astype(np.uint64)
        keep = letter | np.concatenate(([True], letter[:-1]))  # runs of other characters become one blank
        codes = codes[keep]
        if len(codes) < 2:
            continue
        with np.errstate(over="ignore"):
            one = codes * np.uint64(0x9E3779B97F4A7C15)
            two = one[:-1] * np.uint64(31) + codes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
            three = two[:-1] * np.uint64(37) + codes[2:] * np.uint64(0x165667B19E3779F9)
            grams = np.concatenate([one[codes != 32], two, three])
        out[k] = np.bincount((grams >> np.uint64(40)).astype(np.int64) % dims, minlength=dims)
    return out


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors (a zero row stays zero)."""
    v = np.log1p(counts) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm == 0, 1, norm)


@dataclass
class CentroidModel:
    """Languages, one row per centroid, its language number and its reject cosine."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    reject: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        counts = gram_counts(texts)
        some = counts.any(axis=1)
        if not len(self.centroids):
            return [UND] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cos = np.clip(weigh(counts, self.idf) @ self.centroids.T, 0, 1)
        best = cos.argmax(axis=1)  # centroids are ordered by language name
        score = np.where(some, cos[np.arange(len(texts)), best], 0.0)
        names = [self.languages[self.owner[b]] if ok else UND for b, ok in zip(best, some, strict=True)]
        return names, score.astype(float), ~some | (score < self.reject[best])


def _cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from evenly spaced starting rows; centroids and each row's cluster."""
    centers = vectors[np.linspace(0, len(vectors) - 1, min(k, len(vectors))).astype(int)].copy()
    for _ in range(rounds):
        member = (vectors @ centers.T).argmax(axis=1)
        for c in range(len(centers)):
            if (member == c).any():
                s = vectors[member == c].sum(axis=0)
                centers[c] = s / max(np.linalg.norm(s), 1e-12)
    return centers, (vectors @ centers.T).argmax(axis=1)


def _sparse_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in arrow_rows(batches):
        counts = gram_counts(b.column("text").to_pylist())
        idx = [np.flatnonzero(r).astype(np.int32) for r in counts]
        yield pa.RecordBatch.from_arrays(
            [b.column("lang"), pa.array(idx, pa.list_(pa.int32())), pa.array([r[i] for r, i in zip(counts, idx, strict=True)], pa.list_(pa.float32()))],
            names=["lang", "idx", "cnt"],
        )


def _document_frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(DIMS, np.int64)
    for b in arrow_rows(batches):
        df += (gram_counts(b.column("text").to_pylist()) > 0).sum(axis=0)
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["dim", "df"])


def fit(
    docs: DataFrame, train_per_language: int = 400, clusters: int = 4, reject_factor: float = 0.35
) -> CentroidModel:
    """Learn the model from ``text`` and ``lang`` of ``docs``.

    Document frequencies come from every row of ``docs``. The clustering uses a fixed hash sample of
    about ``train_per_language`` rows of each language (that is the bound on what reaches the
    driver). ``reject_factor`` times a cluster's first-percentile training cosine is its reject cosine.
    """
    learn = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    df = np.zeros(DIMS)
    counts = learn.select("text").mapInArrow(_document_frequency, "dim int, df long").groupBy("dim").agg(F.sum("df").alias("df"))
    for r in counts.collect():  # at most DIMS rows
        df[r["dim"]] = r["df"]
    idf = np.log((1 + sum(sizes.values())) / (1 + df)).astype(np.float32) + np.float32(1)
    languages, centers, owner, reject = sorted(sizes), [], [], []
    chosen = F.lit(False)
    for lang, n in sizes.items():
        chosen = chosen | ((F.col("lang") == lang) & bounded_sample("doc_id", n, train_per_language))
    rows: dict[str, list[np.ndarray]] = {lang: [] for lang in languages}
    for r in learn.where(chosen).select("lang", "text").mapInArrow(_sparse_counts, "lang string, idx array<int>, cnt array<float>").toLocalIterator():
        v = np.zeros(DIMS, np.float32)
        v[r["idx"]] = r["cnt"]
        if v.any():
            rows[r["lang"]].append(v)
    for k, lang in enumerate(languages):
        if not rows[lang]:
            continue
        vectors = weigh(np.stack(sorted(rows[lang], key=lambda v: v.tobytes())), idf)
        c, member = _cluster(vectors, clusters)
        near = (vectors * c[member]).sum(axis=1)
        for j in range(len(c)):
            if (member == j).any():
                centers.append(c[j])
                owner.append(k)
                reject.append(reject_factor * float(np.quantile(near[member == j], 0.01)))
    return CentroidModel(languages, idf, np.array(centers, np.float32).reshape(-1, DIMS), np.array(owner, int), np.array(reject))


def identify(docs: DataFrame, model: CentroidModel) -> DataFrame:
    """``docs`` with ``_lang_pred``, ``_lang_score`` (cosine, 0 to 1) and ``_lang_rejected`` added; only ``text`` is read.

    Columns of ``docs`` with these names are replaced.
    """
    docs = without(docs, "_lang_pred", "_lang_score", "_lang_rejected")
    plain = (model.languages, model.idf, model.centroids, model.owner, model.reject)  # no class of this package is broadcast
    shared = docs.sparkSession.sparkContext.broadcast(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = CentroidModel(*shared.value)
        for b in arrow_rows(batches):
            names, score, rejected = known.predict(b.column(b.schema.get_field_index("text")).to_pylist())
            extra = [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=[*b.schema.names, "_lang_pred", "_lang_score", "_lang_rejected"])

    return docs.mapInArrow(run, with_fields(docs, _lang_pred="string", _lang_score="double", _lang_rejected="boolean"))


def learnable(docs: DataFrame, mod: int = 3, held: int = 1) -> DataFrame:
    """Rows the model may learn from: crc32(doc_id as text) mod ``mod`` is not ``held``."""
    return docs.where(remainder("doc_id", mod) != held).select("doc_id", "text", "lang")
