"""Substring deduplication with content-defined chunks (operator 1).

A gear hash rolls over the UTF-8 bytes of a text; a chunk ends where the hash of the last 16 bytes
has certain zero bits, so chunk ends move with the content and an insertion changes only the chunks
around it. Ends lie after white space (inside runs of ``LONG_WORD`` bytes without any, at any
character). Chunks are compared by a 64-bit digest; the document with the smallest id keeps a chunk,
and within a document its first occurrence stays. A run of neighbouring repeated chunks is cut out
of the text when it holds at least ``min_words`` words (in text without spaces as many times ``LONG_WORD`` bytes), so
short common phrases stay; a wrong cut
would take several digest collisions side by side in one document.

Nulls and odd rows: a NULL text stays NULL, an empty one empty. Rows with a NULL id neither give
chunks to others nor lose any to them. Rows that repeat an id count as the same document and all stay. A text may lose all its
chunks; its row stays with an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.common import arrow_rows, saved, with_fields, without

MIN_CHUNK, MAX_CHUNK = 16, 256
LONG_WORD = 48
_GEAR = np.random.default_rng(1).integers(0, 1 << 32, 256, dtype=np.uint32)
_SPACE_MASK, _LONG_MASK = np.uint32(0b11 << 14), np.uint32(0b11111 << 11)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_hashes(buf: np.ndarray) -> np.ndarray:
    """Low 16 bits: the gear hash after each byte, ``h = 2 h + G[byte]``, over the last 16 bytes."""
    h = _GEAR[buf]
    for width in (1, 2, 4, 8):  # doubling: a window of 2w from two windows of w
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(width)
        h = wider
    return h


def chunk_ends(data: bytes) -> list[int]:
    """End offsets of the chunks of a text's bytes."""
    if not data:
        return []
    buf = np.frombuffer(data, np.uint8)
    h = gear_hashes(buf)
    space = _SPACE[buf]
    cut = space & (h & _SPACE_MASK == 0)
    if len(buf) > LONG_WORD:
        at = np.arange(len(buf))
        deep = at - np.maximum.accumulate(np.where(space, at, 0)) >= LONG_WORD
        if deep.any():
            starts_char = np.append(buf[1:] & 0xC0 != 0x80, True)
            cut |= deep & starts_char & (h & _LONG_MASK == 0)
    ends, last = [], 0
    for c in (np.flatnonzero(cut) + 1).tolist() + [len(data)]:
        while c - last > MAX_CHUNK:  # too long: cut at the limit, or before the character there
            last += MAX_CHUNK
            while data[last] & 0xC0 == 0x80:
                last -= 1
            ends.append(last)
        if c - last >= MIN_CHUNK or c == len(data):
            ends.append(c)
            last = c
    return ends if len(ends) < 2 or ends[-1] > ends[-2] else ends[:-1]


def chunk_digests(data: bytes) -> tuple[list[int], list[int]]:
    """Chunk ends and each chunk's digest as a signed 64-bit number."""
    ends, view, last, digests = chunk_ends(data), memoryview(data), 0, []
    for e in ends:
        d = xxhash.xxh3_64_intdigest(view[last:e])
        digests.append(d - (1 << 64) if d >> 63 else d)
        last = e
    return ends, digests


def worth_cutting(passage: bytes, min_words: int) -> bool:
    """At least ``min_words`` words; a word counts once for every ``LONG_WORD`` bytes begun, as scripts without spaces have long ones."""
    words = passage.split()
    return len(words) >= min_words or sum(-(-len(w) // LONG_WORD) for w in words) >= min_words


def cut_repeats(data: bytes, elsewhere: set[int], min_words: int) -> tuple[bytes, int, int]:
    """The text without its repeated runs; how many chunks it has, and how many were cut."""
    ends, digests = chunk_digests(data)
    seen: set[int] = set()
    kept, cut, start, k = [], 0, 0, 0
    while k < len(ends):
        run = k
        while run < len(ends) and (digests[run] in elsewhere or digests[run] in seen):
            run += 1
        if run > k and worth_cutting(data[start : ends[run - 1]], min_words):
            cut += run - k
        else:
            run = max(run, k + 1)
            kept.append(data[start : ends[run - 1]])
        seen.update(digests[k:run])
        start, k = ends[run - 1], run
    return b"".join(kept), len(ends), cut


def _encoded(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in arrow_rows(batches):
        ids, ds = [], []
        for i, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
            own = set(chunk_digests(_encoded(text))[1])
            ds += own
            ids += [i] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(ds, pa.int64()), pa.array(ids, b.schema.field("id").type)], names=["digest", "id"])


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 16) -> DataFrame:
    """``docs`` with repeated passages cut out of the text, and ``_chunks`` and ``_cut`` (chunk counts) added.

    One shuffle counts the digests (owner: smallest id), one finds the documents that repeat them;
    both carry only (digest, id) rows, each digest once a document. Columns ``_chunks``, ``_cut`` and ``_repeats`` of
    ``docs`` are replaced.
    """
    docs = without(docs, "_chunks", "_cut", "_repeats")
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    chunks = rows.mapInArrow(_digest_rows, f"digest long, id {id_type}")
    owners = chunks.groupBy("digest").agg(F.min("id").alias("owner"), F.max("id").alias("last")).where("owner < last")
    owners = saved(owners.select("digest", "owner"))
    repeats = chunks.join(owners, "digest").where("id > owner").groupBy("id").agg(F.collect_set("digest").alias("_repeats"))
    joined = docs.join(repeats.withColumnRenamed("id", id_col), id_col, "left").select(*docs.columns, "_repeats")
    at_text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            texts, n, cut = [], [], []
            for text, repeats in zip(b.column(at_text).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
                data, chunks, gone = cut_repeats(_encoded(text), set(repeats or ()), min_words)
                texts.append(None if text is None else text if not gone else data.decode("utf-8", "surrogatepass"))
                n.append(chunks)
                cut.append(gone)
            columns = list(b.columns[:-1])
            columns[at_text] = pa.array(texts, b.schema.field(at_text).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(cut, pa.int64())], names=[*b.schema.names[:-1], "_chunks", "_cut"])

    return joined.mapInArrow(run, with_fields(docs, _chunks="long", _cut="long"))
