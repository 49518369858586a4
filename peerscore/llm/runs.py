"""Periodic run detection by internal pattern matching (operator 13).

A *run* is a stretch of consecutive words with smallest period ``q``, at least ``max(min_length,
min_powers * q)`` words long, that no neighbouring word extends with period ``q``.

* *Names.* Prefix doubling names every stretch of ``2^k`` words by its place in the sorted order; the
  last round gives the suffix array, and the rounds' names compare stretches in logarithmic time.
* *Occurrences.* A run of period ``q`` holds, for ``b = 2^k <= q < 2b``, a block of ``b`` words that
  starts at a multiple of ``b`` and stands again ``q`` words later. So each dyadic block asks for its
  occurrences that start ``b`` to ``2b - 1`` words after it: the suffix-array interval of the block's
  name, and in it the *range successor* of a place by a wavelet tree over the suffix array.
* *Progressions.* Occurrences so near to each other form an arithmetic progression. One or two give
  their distances as candidate periods. Three or more have the block's own period as difference: the
  periodic stretches around the block and around its occurrences are then measured, and only the
  distances that lay their starts or their ends on each other can be the period of a longer run.
  So a block has at most two candidates, and a text of ``n`` words about ``4 n`` at most.
* *Extension.* A candidate is extended to both sides by the names; what is long enough is a run, its
  smallest period the least candidate of the same stretch.

A word of a run stands at least ``min_powers`` times in its text. So texts are first cut at words that stand
there less often (again inside each part, until nothing changes); no run is lost by that. The parts
of several texts are searched together, each closed by a sign of its own.

Nulls and odd rows: a NULL text, an empty one and one of blanks have no words, no run and an empty
collapsed text. Repeated rows and rows with a NULL id are searched each; an empty table gives no rows;
of ``docs`` only the two named columns are read. Texts are read whole; memory is about
``4 log2(n)`` bytes a word of a text that repeats itself all along, and little for others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.common import arrow_rows

#: about as many words are searched together
BATCH_WORDS = 1 << 17


class Names:
    """Sorted names of all stretches of 1, 2, 4, ... symbols, and the suffix array (all suffixes differ)."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = len(symbols)
        self.n, self.levels, self.size = n, [], []
        rank = self._ranks(np.argsort(symbols, kind="stable"), symbols)
        width = 1
        while True:
            self.levels.append(rank)
            counts = np.bincount(rank, minlength=n).astype(np.int32)
            self.size.append(counts)  # of each name, which is the first place of its interval
            if counts.max(initial=0) <= 1:
                break
            after = np.full(n, -1, np.int64)
            after[: n - width] = rank[width:]
            key = rank.astype(np.int64) * (n + 1) + after + 1
            same = np.flatnonzero(counts[rank] > 1)  # only names that are shared are split
            order = same[np.argsort(key[same], kind="stable")]
            first = np.concatenate(([True], key[order][1:] != key[order][:-1]))
            group = rank[order]
            opens = np.concatenate(([True], group[1:] != group[:-1]))
            at = np.arange(len(order))
            start_of_group = np.maximum.accumulate(np.where(opens, at, 0))
            start_of_name = np.maximum.accumulate(np.where(first, at, 0))
            rank = rank.copy()
            rank[order] = group + (start_of_name - start_of_group)
            width *= 2
        self.suffixes = np.empty(n, np.int32)
        self.suffixes[rank] = np.arange(n, dtype=np.int32)

    @staticmethod
    def _ranks(order: np.ndarray, key: np.ndarray) -> np.ndarray:
        first = np.concatenate(([True], key[order][1:] != key[order][:-1])) if len(order) else np.zeros(0, bool)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        return rank

    def equal_ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` on equal those from ``j`` on."""
        done = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            width, name = 1 << k, self.levels[k]
            live = np.arange(len(i))
            while len(live):  # at the longest width this can go on
                a, b = i[live] + done[live], j[live] + done[live]
                ok = (a + width <= self.n) & (b + width <= self.n)
                ok[ok] = name[a[ok]] == name[b[ok]]
                live = live[ok]
                done[live] += width
                if k < len(self.levels) - 1:
                    break
        return done

    def equal_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols that end before ``i`` equal those that end before ``j``."""
        done = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            width, name = 1 << k, self.levels[k]
            live = np.arange(len(i))
            while len(live):
                a, b = i[live] - done[live] - width, j[live] - done[live] - width
                ok = (a >= 0) & (b >= 0)
                ok[ok] = name[a[ok]] == name[b[ok]]
                live = live[ok]
                done[live] += width
                if k < len(self.levels) - 1:
                    break
        return done

    def stretch(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the longest stretch of that period around ``at`` (and ``at + period``)."""
        return at - self.equal_before(at, at + period), at + period + self.equal_ahead(at, at + period)


class WaveletTree:
    """A wavelet tree (stored level by level) over numbers below ``2^bits``: the successor of a number in a range."""

    def __init__(self, numbers: np.ndarray) -> None:
        self.bits = max(1, int(numbers.max(initial=0)).bit_length())
        self.zeros: list[np.ndarray] = []  # zeros before each place, level by level
        for shift in range(self.bits - 1, -1, -1):
            zero = (numbers >> shift) & 1 == 0
            self.zeros.append(np.concatenate((np.zeros(1, np.int32), np.cumsum(zero, dtype=np.int32))))
            numbers = np.concatenate((numbers[zero], numbers[~zero]))

    def smaller(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers at the places ``lo`` to ``hi`` are smaller than ``bound``."""
        lo, hi, count = lo.astype(np.int64), hi.astype(np.int64), np.zeros(len(lo), np.int64)
        whole, beyond = hi - lo, bound >> self.bits > 0
        for shift, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            one = (bound >> shift) & 1 == 1
            a, b = zeros[lo], zeros[hi]
            count += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return np.where(beyond, whole, count)

    def ranked(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The number of rank ``k`` (from 0) at the places ``lo`` to ``hi``."""
        lo, hi, k, out = lo.astype(np.int64), hi.astype(np.int64), k.copy(), np.zeros(len(lo), np.int64)
        for shift, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            a, b = zeros[lo], zeros[hi]
            one = k >= b - a
            k -= np.where(one, b - a, 0)
            out += np.where(one, 1 << shift, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest number not below ``bound`` at the places ``lo`` to ``hi``; -1 if there is none."""
        k = self.smaller(lo, hi, bound)
        out, some = np.full(len(lo), -1, np.int64), k < hi - lo
        out[some] = self.ranked(lo[some], hi[some], k[some])
        return out


def periodic_runs(symbols: np.ndarray, min_length: int, min_powers: int, longest: int | None = None) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of every run of a sequence of non-negative numbers.

    ``longest``: no run is longer (the longest part, if the sequence was put together from parts that
    end in symbols of their own).
    """
    if not len(symbols):
        return []
    symbols = np.append(symbols, symbols.max() + 1)  # its own last symbol: all suffixes differ
    names = Names(symbols)
    tree = WaveletTree(names.suffixes)
    starts, periods = [], []
    for level in range(len(names.levels)):
        b = 1 << level
        if min_powers * b > (longest or names.n):
            break
        name, size = names.levels[level], names.size[level]
        block = np.arange(0, names.n - 2 * b, b)
        lo = name[block].astype(np.int64)
        hi = lo + size[name[block]]
        some = hi - lo > 1  # the block stands more than once
        block, lo, hi = block[some], lo[some], hi[some]
        found = []
        for _ in range(3):  # the first three occurrences that start b to 2b - 1 words later
            after = found[-1] + 1 if found else block + b
            nxt = tree.successor(lo, hi, after)
            found.append(np.where((nxt >= 0) & (nxt < block + 2 * b), nxt, -1))
            more = found[-1] >= 0
            if len(found) < 3:
                block, lo, hi = block[more], lo[more], hi[more]
                found = [f[more] for f in found]
                # blocks with this many occurrences have at least that candidate
                starts.append(block)
                periods.append(found[-1] - block)
        many = found[2] >= 0
        block, one, two = block[many], found[0][many], found[1][many]
        own = two - one  # the block's own period
        a0, a1 = names.stretch(block, own)
        b0, b1 = names.stretch(one, own)
        for shift in (b0 - a0, b1 - a1):
            fits = (shift >= b) & (shift < 2 * b)
            starts.append(block[fits])
            periods.append(shift[fits])
    start, period = np.concatenate(starts), np.concatenate(periods)
    start, end = names.stretch(start, period)
    long = end - start >= np.maximum(min_length, min_powers * period)
    smallest: dict[tuple[int, int], int] = {}
    for s, e, p in zip(start[long].tolist(), end[long].tolist(), period[long].tolist(), strict=True):
        smallest[s, e] = min(p, smallest.get((s, e), p))
    return sorted((s, e, p) for (s, e), p in smallest.items())


def repeating_parts(words: list[bytes], min_length: int, least: int) -> list[tuple[int, int]]:
    """The stretches in which runs can lie: every word of one stands in it ``least`` times."""
    out, todo = [], [(0, len(words))]
    while todo:
        a, b = todo.pop()
        if b - a < min_length:
            continue
        counts = Counter(words[a:b])
        if min(counts.values()) >= least:
            out.append((a, b))
            continue
        if max(counts.values()) < least:
            continue
        last = a
        for i in range(a, b):
            if counts[words[i]] < least:
                if i - last >= min_length:
                    todo.append((last, i))
                last = i + 1
        if b - last >= min_length:
            todo.append((last, b))
    return out


def runs_of_texts(texts: list[list[bytes]], min_length: int, min_powers: int) -> list[list[tuple[int, int, int]]]:
    """``(start, end, period)`` of every run of each of several texts (lists of words), searched together."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    parts = [(t, a, b) for t, words in enumerate(texts) for a, b in repeating_parts(words, min_length, min_powers)]
    if not parts:
        return out
    number: dict[bytes, int] = {}
    symbols: list[int] = []
    begin = []
    for k, (t, a, b) in enumerate(parts):
        begin.append(len(symbols))
        symbols.extend([number.setdefault(w, len(number)) for w in texts[t][a:b]])
        symbols.append(-1 - k)  # its own sign after each part
    row = np.array(symbols, np.int64)
    row[row < 0] = len(number) - 1 - row[row < 0]
    for s, e, p in periodic_runs(row, min_length, min_powers, max(b - a for _, a, b in parts)):
        k = int(np.searchsorted(begin, s, "right")) - 1
        t, a, _ = parts[k]
        out[t].append((a + s - begin[k], a + e - begin[k], p))
    return [sorted(r) for r in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    kept, at = [], 0
    for start, end in sorted((s + p, e) for s, e, p in runs):
        kept += words[at:start] if start > at else []
        at = max(at, end)
    return kept + words[at:]


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_powers: int = 4,
    prepare: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``id``, ``n_words``, ``runs`` (``start``, ``length``, ``period``, in this order) and ``collapsed`` of each row.

    ``collapsed`` holds the kept words joined by one blank. ``prepare(id, words)`` may give other words to search.
    ``min_powers`` is at least 3: a shorter run need not hold a block of the dyadic grid twice.
    """
    if min_powers < 3:
        raise ValueError("min_powers must be at least 3")
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def emit(ids: list, texts: list[list[bytes]], id_type: pa.DataType) -> pa.RecordBatch:
        runs = runs_of_texts(texts, min_length, min_powers)
        rows = [[{"start": s, "length": e - s, "period": p} for s, e, p in sorted(r, key=lambda x: (x[0], x[2]))] for r in runs]
        collapsed = [b" ".join(collapse(w, r)).decode("utf-8", "surrogatepass") for w, r in zip(texts, runs, strict=True)]
        arrays = [pa.array(ids, id_type), pa.array([len(w) for w in texts], pa.int64()), pa.array(rows, run_type), pa.array(collapsed, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches):
            ids, texts, held = [], [], 0
            kind = b.schema.field("id").type
            for i, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                words = text.encode("utf-8", "surrogatepass").split() if text else []  # splits at \x20 and \x09-\x0D
                ids.append(i)
                texts.append(prepare(i, words) if prepare else words)
                held += len(words)
                if held >= BATCH_WORDS:
                    yield emit(ids, texts, kind)
                    ids, texts, held = [], [], 0
            if ids:
                yield emit(ids, texts, kind)

    schema = f"id {docs.schema['id'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.mapInArrow(run, schema)
