r"""Secret scans by dictionary-primed zstandard novelty (operator 12).

*Base patterns.* Three kinds of places are always found: ``assign``, ``access`` and ``hex`` (``BASE``).

*Novelty.* A sensitive word (``SENSITIVE``) opens a context: the rest of its line, ``REACH`` characters at
most. Every string of ``CANDIDATE`` characters that begins in a context is a candidate, taken whole
however long it is. Its novelty is the number of bytes that it adds to the compressed size of the text
around it: a zstandard compressor primed with the identifier dictionary (the most frequent words of
all documents) compresses the text before and after the candidate without it and with it. That is done
with each of the ``SURROUNDINGS`` (so many characters on either side), and the median counts; where a
text has fewer characters, letters of the dictionary fill up, so that short texts are measured alike. Words, names and whatever the surrounding code repeats are matched, at less than a byte a
character; random characters cost more than their own size, as they also spoil the code of the letters
around them. A candidate of three letters or more (numbers and dates have fewer) is reported as
``novel`` when it adds at least ``min_bytes`` bytes and, a character, ``min_share`` bytes for its first
``SHORT`` characters and ``TAIL_SHARE`` for others: a long string pays for its own letter code only
once. A string that stands again close by is not new there. What touches a base span is not
reported again.

Word counts for the dictionary cover all documents and leave out only the candidates themselves, so that a
secret in many copies of a document is still unknown; the dictionary's size is a parameter and does
not depend on the data.

Nulls and odd rows: a NULL text is an empty one: no spans. Rows with a NULL id and repeated rows are
scanned each. Texts are read whole. An empty table gives no rows; ties between words of one count
go to the smaller word; of ``docs`` only the two named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscore.llm.common import arrow_rows

#: Kinds in their order: pattern, and whether a match is long enough (fixed values).
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), lambda m: m.end(2) - m.start(2) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), lambda m: True),
}
NOVEL = "novel"
KINDS = [*BASE, NOVEL]
#: words that open a sensitive context (fixed values)
SENSITIVE = re.compile(
    r"pass(?:word|wd|phrase|code)|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|signing[_ -]?key|encryption[_ -]?key|"
    r"credential|authorization|bearer|client[_ -]?id|session[_ -]?id|webhook|connection[_ -]?string",
    re.IGNORECASE | re.ASCII,
)
#: small pieces of the above: a lower-cased text without any of them has no assignment and no context
_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "authorization", "bearer", "client", "session", "webhook", "connection")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~$!%^&*.-]{8,}")
REACH = 96
SURROUNDINGS = (0, 256, 1024)
SHORT, TAIL_SHARE = 64, 0.5
LEVEL = 9
#: partial word counts are passed on to Spark when a task holds so many words
HELD_WORDS = 200_000
PARTS = 16
_LETTERS = re.compile("(?:[^A-Za-z]*[A-Za-z]){3}")
_IDENTIFIER = re.compile(r"[^\W\d]\w{2,}")


def has_hint(text: str) -> bool:
    lower = text.lower()
    return any(h in lower for h in _HINTS)


def identifiers(text: str | None) -> list[str]:
    """The identifiers of a text, without those in candidates: what may be a secret is no known word."""
    out, at = [], 0
    for start, end in candidates(text or ""):
        out += _IDENTIFIER.findall(text, at, start)
        at = end
    return out + _IDENTIFIER.findall(text or "", at)


def identifier_dictionary(docs: DataFrame, text_col: str = "text", words: int = 4096) -> bytes:
    """The ``words`` most frequent identifiers (letters, digits, ``_``; 3 characters or more) of all texts, the most frequent last.

    Counted over all rows: in the tasks first, then by Spark. Each of ``PARTS`` parts of the words gives its ``words`` best, so
    at most ``PARTS * words`` rows reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for b in arrow_rows(batches):
            for text in b.column("text").to_pylist():
                held.update(_IDENTIFIER.findall(text) if text and not has_hint(text) else identifiers(text))
            if len(held) > HELD_WORDS:
                yield out()
                held.clear()
        if held:
            yield out()

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    part = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(PARTS))).orderBy(F.desc("n"), "word")
    best = counts.withColumn("place", F.row_number().over(part)).where(F.col("place") <= words).orderBy(F.desc("n"), "word").limit(words).collect()
    return " ".join(r["word"] for r in reversed(best)).encode("utf-8")


class Novelty:
    """Marginal compressed bytes of a string, given what stands around it and the dictionary."""

    def __init__(self, dictionary: bytes, level: int = LEVEL) -> None:
        known = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if dictionary else None
        if known:
            known.precompute_compress(level=level)
        self._filler = dictionary.decode("utf-8")[::-1][: 2 * max(SURROUNDINGS)]
        self._compress = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False).compress

    def size(self, text: str) -> int:
        return len(self._compress(text.encode("utf-8", "surrogatepass")))

    def added(self, text: str, start: int, end: int) -> int:
        """Bytes that ``text[start:end]`` adds where it stands."""
        sizes = []
        for reach in SURROUNDINGS:
            before, after = text[max(0, start - reach) : start], text[end : end + reach]
            before = self._filler[: 2 * max(SURROUNDINGS[1], reach) - len(before) - len(after)] + before
            sizes.append(self.size(before + text[start:end] + after) - self.size(before + after))
        return sorted(sizes)[len(sizes) // 2]


def base_spans(text: str, hinted: bool) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the base patterns' matches."""
    out = []
    for kind, (pattern, long_enough) in BASE.items():
        if hinted or kind != "assign":
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if long_enough(m)]
    return out


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of the strings that begin in a sensitive context, each once."""
    at = 0
    for m in SENSITIVE.finditer(text):
        end = text.find("\n", m.end(), m.end() + REACH)
        end = m.end() + REACH if end < 0 else end
        at = max(at, m.end())
        while (c := CANDIDATE.search(text, at)) and c.start() < end:  # the string itself may reach farther
            at = c.end()
            yield c.start(), at


def secret_spans(text: str | None, novelty: Novelty, min_bytes: int, min_share: float) -> list[tuple[str, int, int, int | None]]:
    """``(kind, start, end, added bytes)`` of a text's secrets, by start, then kind; base kinds have no added bytes."""
    if not text:
        return []
    hinted = has_hint(text)
    base = base_spans(text, hinted)
    found: list[tuple[str, int, int, int | None]] = [(*s, None) for s in base]
    if hinted:
        taken = sorted((s, e) for _, s, e in base)
        k, reach = 0, 0  # base spans that begin before the candidate's end, and where they end at most
        for start, end in candidates(text):
            while k < len(taken) and taken[k][0] < end:
                reach = max(reach, taken[k][1])
                k += 1
            if reach > start or not _LETTERS.match(text, start, end):
                continue
            added = novelty.added(text, start, end)
            if added >= max(min_bytes, min_share * min(end - start, SHORT) + TAIL_SHARE * max(0, end - start - SHORT)):
                found.append((NOVEL, start, end, added))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan_documents(
    docs: DataFrame, dictionary: bytes, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 16, min_share: float = 1.06
) -> DataFrame:
    """``id`` and ``spans`` (``kind``, ``start``, ``end`` in code points, end exclusive; ``added`` bytes) of each row."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("added", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(shared.value)
        for b in arrow_rows(batches):
            spans = [secret_spans(t, novelty, min_bytes, min_share) for t in b.column("text").to_pylist()]
            rows = [[{"kind": k, "start": s, "end": e, "added": n} for k, s, e, n in r] for r in spans]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, span_type)], names=["id", "spans"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:long,end:long,added:long>>")
