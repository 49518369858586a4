"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscore.session import checkpoint_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def make_shippable() -> None:
    """Let Python workers run this package's functions.

    An installed package, or one on ``PYTHONPATH``, is imported by the workers. A package that
    only the driver's ``sys.path`` knows is sent along with each function instead.
    """
    known = [os.path.abspath(p or ".") for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    known += [p for p in sys.path if p.rstrip("/").endswith(("site-packages", "dist-packages"))]
    if _ROOT not in known and os.getcwd() != _ROOT:
        cloudpickle.register_pickle_by_value(sys.modules["peerscore.llm"])


make_shippable()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string")) % mod


def saved(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder (cuts the lineage, survives lost executors)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SIEVE_BITS = 1 << 24


def sieve(keys: DataFrame, key: str) -> DataFrame:
    """A filter of the values ``keys`` holds: one bit a hash, 64 of them a row, so 2^18 rows at most however many values.

    Past some millions of values it lets more and more others pass; :func:`passes` never refuses one that is there.
    """
    bits = keys.select(F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS)).alias("bit"))
    found = F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))"))
    return saved(bits.groupBy(F.shiftright("bit", 6).cast("int").alias("sieve_word")).agg(found.alias("sieve_bits")))


def passes(df: DataFrame, key: str, words: DataFrame, column: str) -> DataFrame:
    """``df`` with a boolean ``column``: false only where ``key`` is certainly not among the values of a :func:`sieve`."""
    bit = F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS))
    there = F.coalesce(F.getbit("sieve_bits", (bit % 64).cast("int")) == 1, F.lit(False))
    found = df.join(F.broadcast(words), F.shiftright(bit, 6).cast("int") == F.col("sieve_word"), "left")
    return found.select(*(df[f"`{c}`"] for c in df.columns), there.alias(column))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator adds under these names (in any case)."""
    return df.select(*(df[f"`{c}`"] for c in df.columns if c.lower() not in names))


def with_fields(df: DataFrame, **fields: str) -> T.StructType:
    """The schema of ``df`` with named fields added."""
    return T.StructType([*df.schema.fields, *(T.StructField(k, T._parse_datatype_string(v)) for k, v in fields.items())])


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stage's rows, in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"


def bounded_sample(id_col: str, rows: int, bound: int) -> Column:
    """True for a fixed hash sample of about ``bound`` of ``rows`` rows (for all rows if there are fewer)."""
    if rows <= bound:
        return F.lit(True)
    scale = 1 << 30
    return F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(scale)) < int(scale * bound / rows)


def arrow_rows(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``size`` rows, so one slice's work stays small."""
    for b in batches:
        for at in range(0, b.num_rows, size):
            yield b.slice(at, size)


# --- 64-bit hashing of byte ranges, whole buffers at a time -------------------------------------

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2^64
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POW: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POW.get("up")
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                step = np.full(size, base, np.uint64)
                step[0] = 1
                _POW[name] = np.cumprod(step)
    return _POW["up"], _POW["down"]


def range_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range ``buf[start:end]``, independent of where the range lies."""
    up, down = _powers(len(buf) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * up[: len(buf)], out=total[1:])
        h = (total[ends] - total[starts]) * down[starts]
        return mix64(h + (ends - starts).astype(np.uint64) * _MULT)
