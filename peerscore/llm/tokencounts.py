"""Token counts by offset-mapped attribution (operator 7).

The fields of a document are joined by a line break and encoded once, as one text. Every token's
character span follows from its bytes (byte-level vocabularies lose nothing, so token lengths add up
to the text). Sections are the fields, or the lines of each field; a line break belongs to the
section it ends. Token spans are joined to section intervals by their sorted ends, and a token that
crosses a boundary goes to one section by the rule:

* ``first``: the section of its first character;
* ``last``: the section of its last character;
* ``longest``: the section with most of its characters, the first of equals.

Nulls and odd rows: a NULL field is an empty one; an empty section has no tokens but its row.
Repeated rows are counted each, NULL ids are kept, texts are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.common import arrow_rows

RULES = ("first", "last", "longest")


class ByteTokenizer:
    """A vocabulary of byte strings (one ``base64 rank`` a line) with its splitting pattern."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        import tiktoken

        parsed = {base64.b64decode(t): int(r) for t, r in (line.split() for line in ranks.splitlines() if line)}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=parsed, special_tokens={})
        self.length = np.zeros(max(parsed.values()) + 1, np.int64)
        for token, rank in parsed.items():
            self.length[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Character spans of the tokens: of the characters that hold a token's first and last byte."""
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        ends = np.cumsum(self.length[np.array(self.encoding.encode_ordinary(text), np.int64)])
        starts = np.concatenate((ends[:0], [0], ends[:-1])) if len(ends) else ends
        if len(data) == len(text):
            return starts, ends
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        return character[starts], character[ends - 1] + 1


_LOADED: dict[bytes, ByteTokenizer] = {}


def load(ranks: bytes, pattern: str) -> ByteTokenizer:
    """The tokenizer of a vocabulary file's content, built once in each worker process."""
    key = hashlib.sha256(ranks + pattern.encode()).digest()
    if key not in _LOADED:
        _LOADED[key] = ByteTokenizer(ranks, pattern)
    return _LOADED[key]


def sections(fields: list[str], lines: bool) -> tuple[list[int], list[int], list[int]]:
    """Field number, number within the field and end offset of each section of the joined text."""
    field, number, ends, at = [], [], [], 0
    for k, text in enumerate(fields):
        cuts = [c + 1 for c, x in enumerate(text) if x == "\n"] if lines and "\n" in text else []
        cuts = [c for c in cuts if c < len(text)] + [len(text) + (k < len(fields) - 1)]
        field += [k] * len(cuts)
        number += range(len(cuts))
        ends += [at + c for c in cuts]
        at += len(text) + 1
    return field, number, ends


def allocate(starts: np.ndarray, ends: np.ndarray, section_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens allotted to each section, and those of them that cross a section's boundary."""
    n = len(section_ends)
    first = np.searchsorted(section_ends, starts, "right").clip(0, n - 1)
    last = np.searchsorted(section_ends, ends - 1, "right").clip(0, n - 1)
    chosen = last if rule == "last" else first.copy()
    crossing = first != last
    if rule == "longest":
        for t in np.flatnonzero(crossing):
            edges = np.concatenate(([starts[t]], section_ends[first[t] : last[t]], [ends[t]]))
            chosen[t] = first[t] + int(np.diff(edges).argmax())
    return np.bincount(chosen, minlength=n), np.bincount(chosen[crossing], minlength=n)


def attribute_tokens(
    docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", fields: Sequence[str] = ("text",), lines: bool = True, rule: str = "first"
) -> DataFrame:
    """One row per section: ``id``, ``field``, ``section``, ``start``, ``end`` (characters of the joined
    text), ``n_tokens``, ``n_crossing`` (of these, tokens that cross a boundary)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    names = list(fields)
    docs = docs.select(F.col(id_col).alias("id"), *(F.col(c).alias(f"f{k}") for k, c in enumerate(names)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(shared.value, pattern)
        for b in arrow_rows(batches, 128):
            rows, which, number, start, end, n, crossing = [], [], [], [], [], [], []
            for k, parts in enumerate(zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)):
                parts = [p or "" for p in parts]
                field, section, ends = sections(parts, lines)
                counts, across = allocate(*tokenizer.spans("\n".join(parts)), np.array(ends), rule)
                rows += [k] * len(ends)
                which += [names[f] for f in field]
                number += section
                start += [0, *ends[:-1]]
                end += ends
                n.append(counts)
                crossing.append(across)
            longs = [pa.array(np.array(x, np.int64)) for x in (number, start, end)] + [pa.array(np.concatenate(x).astype(np.int64)) for x in (n, crossing)]
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(rows, pa.int32())), pa.array(which, pa.string()), *longs], names=["id", "field", "section", "start", "end", "n_tokens", "n_crossing"])

    id_type = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {id_type}, field string, section long, start long, end long, n_tokens long, n_crossing long")
