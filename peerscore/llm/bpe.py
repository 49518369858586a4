"""BPE encoding and decoding with a tokenization automaton (operator 3).

*Compilation.* The automaton starts as one state that loops on every base symbol. The merges are
applied in order, each by the merge gadget: for ``(u, v) -> w`` every state with a ``u`` arc gets a
``w`` arc to where ``v`` leads, and the ``u`` arcs are led to a copy of their target without its
``v`` arc. The result accepts one token sequence for each symbol sequence: its BPE encoding. States
are copy-on-write: a copy is stored as its original and the removed arc, with the merge's number as
the time, so the table has one entry a merge. An arc is looked up by following the copies of the
state and the left parts of the label in order of time.

*Encoding.* A text is normalised and split into words as the tokenizer file says; each unseen word is
run through the automaton: a trie gives the labels that match at each place, the arc table the one
that may follow. All unseen words of a batch run at once. *Decoding* emits the arc labels.

Nulls and odd rows: a NULL text is encoded as an empty one (no ids). Rows repeat as they are.
Texts are read whole; words of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.common import arrow_rows, range_hashes

LONG_WORD = 64
_NEVER = 1 << 30


class KeyTable:
    """Open-addressing table from non-negative 64-bit keys to 32-bit values, looked up in bulk."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int) -> None:
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.missing = missing
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, missing, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[left[free]]
            placed = self.keys[slot] == keys[left]
            self.values[slot[placed]] = values[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), self.missing, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            there = self.keys[slot]
            hit = there == keys[left]
            out[left[hit]] = self.values[slot[hit]]
            go = ~hit & (there >= 0)
            left, slot = left[go], (slot[go] + 1) & (len(self.keys) - 1)
        return out


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Automaton:
    """The compiled merges of a tokenizer file of kind BPE with a word-end suffix."""

    def __init__(self, model: dict) -> None:
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.word_end = end
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int32)
        self.final = np.array([vocab[c + end] for c in letters], np.int32)
        size = max(vocab.values()) + 1
        self.labels = [""] * size
        for token, i in vocab.items():
            self.labels[i] = token
        self.left, self.right = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.birth = np.full(size, -1, np.int32)
        spelled: list[tuple[int, ...] | None] = [None] * size
        for i in (*self.inner.tolist(), *self.final.tolist()):
            spelled[i] = (i,)
        cut_u, cut_v = np.zeros(len(merges), np.int64), np.zeros(len(merges), np.int64)
        for k, (a, b) in enumerate(merges):  # the merge gadget, in order
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if spelled[u] is None or spelled[v] is None or self.birth[w] >= 0:
                raise ValueError(f"merge {k} is not proper: {a} {b}")
            self.left[w], self.right[w], self.birth[w] = u, v, k  # w leads where v leads now
            spelled[w] = spelled[u] + spelled[v]
            cut_u[k], cut_v[k] = u, v  # from now on u leads to a copy without v
        self.size = size
        self.cut = KeyTable(cut_u * size + cut_v, np.arange(len(merges), dtype=np.int32), _NEVER)
        self._build_trie(spelled)
        self._memo: dict[tuple[int, int], bool] = {}
        self._seen_key, self._seen = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)

    def _build_trie(self, spelled: list[tuple[int, ...] | None]) -> None:
        step: dict[tuple[int, int], int] = {}
        token = [-1]
        for i, symbols in enumerate(spelled):
            node = 0
            for s in symbols or ():
                following = step.get((node, s))
                if following is None:
                    following = step[node, s] = len(token)
                    token.append(-1)
                node = following
            if symbols:
                token[node] = i
        keys = np.array([n * self.size + s for n, s in step], np.int64)
        self.step = KeyTable(keys, np.fromiter(step.values(), np.int32, len(step)), -1)
        self.trie, self.token = step, np.array(token, np.int32)

    def arcs(self, p: np.ndarray, x: np.ndarray) -> np.ndarray:
        """:meth:`has_arc` by a table of the arcs met before (one slot a key, the latest stays)."""
        key = p.astype(np.int64) * self.size + x
        with np.errstate(over="ignore"):
            slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        ok = self._seen[slot]
        new = np.flatnonzero(self._seen_key[slot] != key)
        if len(new):
            ok[new] = self.has_arc(p[new], x[new])
            self._seen_key[slot[new]] = key[new]  # of several keys for a slot the last one stays
            kept = self._seen_key[slot[new]] == key[new]
            self._seen[slot[new][kept]] = ok[new][kept]
        return ok

    def has_arc(self, p: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Whether the state that label ``p`` leads to has an arc ``x`` (arrays of labels)."""
        ok = np.ones(len(p), bool)
        at, p, x = np.arange(len(p)), p.astype(np.int64), x.astype(np.int64)
        limit = np.full(len(p), 2 * _NEVER, np.int64)
        while len(at):
            gone = 2 * self.cut.get(p * self.size + x).astype(np.int64) < limit
            ok[at[gone]] = False
            bp, bx = self.birth[p], self.birth[x]
            go = ~gone & ((bp >= 0) | (bx >= 0))
            at, p, x, bp, bx = at[go], p[go], x[go], bp[go].astype(np.int64), bx[go].astype(np.int64)
            label = bx >= bp  # the arc came with its label, or else the state with its copy
            limit = np.where(label, 2 * bx + 1, 2 * bp)
            p, x = np.where(label, p, self.right[p]), np.where(label, self.left[x], x)
        return ok

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word."""
        spelled = [w.encode("utf-8", "replace") for w in words]
        out: list[list[int]] = [[]] * len(words)
        short = [k for k, s in enumerate(spelled) if 0 < len(s) <= LONG_WORD]
        for k, s in enumerate(spelled):
            if len(s) > LONG_WORD:
                out[k] = self._encode_long([*self.inner[list(s[:-1])].tolist(), int(self.final[s[-1]])])
        if short:
            for k, ids in zip(short, self._encode_many([spelled[k] for k in short]), strict=True):
                out[k] = ids
        return out

    def _encode_many(self, spelled: list[bytes]) -> list[list[int]]:
        flat, sizes = self.encode_flat(spelled)
        ids, cuts = flat.tolist(), np.cumsum(sizes).tolist()
        return [ids[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def encode_flat(self, spelled: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words of 1 to ``LONG_WORD`` bytes, one after the other, and how many each word has."""
        return self.encode_bytes(np.frombuffer(b"".join(spelled), np.uint8), np.fromiter(map(len, spelled), np.int64, len(spelled)))

    def encode_bytes(self, data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode_flat` of words that lie one after the other in ``data``."""
        end = np.cumsum(length)
        first = end - length
        flat = self.inner[data].astype(np.int64)
        flat[end - 1] = self.final[data[end - 1]]
        word = np.repeat(np.arange(len(length)), length)
        # every label that matches at every place
        start, node, depth, found = np.arange(len(flat)), np.zeros(len(flat), np.int64), 0, []
        while len(start):
            node = self.step.get(node * self.size + flat[start + depth]).astype(np.int64)
            start, node = start[node >= 0], node[node >= 0]
            label = self.token[node]
            some = label >= 0
            depth += 1
            found.append((start[some], np.full(int(some.sum()), depth), label[some]))
            more = start + depth < end[word[start]]
            start, node = start[more], node[more]
        start, size, label = (np.concatenate(c) for c in zip(*found, strict=True))
        until = start + size - 1  # the place of its last symbol
        rank = until - first[word[start]]
        order = np.argsort(rank, kind="stable")
        start, label, until, rank = start[order], label[order], until[order], rank[order]
        last, back = np.full(len(flat), -1, np.int64), np.zeros(len(flat), np.int64)
        bounds = np.searchsorted(rank, np.arange(int(rank[-1]) + 2))
        opening = start == first[word[start]]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            s, t = start[a:b], label[a:b]
            ok = opening[a:b] | self.arcs(last[np.where(opening[a:b], until[a:b], s - 1)].clip(0), t)
            last[until[a:b][ok]], back[until[a:b][ok]] = t[ok], s[ok]
        # back along the one accepted path of each word
        at, who, step, parts = end - 1, np.arange(len(length)), 0, []
        while len(at):
            parts.append((who, np.full(len(who), -step), last[at]))
            at, who, step = back[at] - 1, who, step + 1
            more = at >= first[who]
            at, who = at[more], who[more]
        who, step, label = (np.concatenate(c) for c in zip(*parts, strict=True))
        return label[np.lexsort((step, who))], np.bincount(who, minlength=len(length))

    def _may_follow(self, p: int, x: int) -> bool:
        ok = self._memo.get((p, x))
        if ok is None:
            if len(self._memo) > 1_000_000:
                self._memo.clear()
            ok = self._memo[p, x] = bool(self.has_arc(np.array([p]), np.array([x]))[0])
        return ok

    def _encode_long(self, symbols: list[int]) -> list[int]:
        n = len(symbols)
        last, back = [-1] * n, [0] * n
        for start in range(n):
            node = 0
            for until in range(start, n):
                node = self.trie.get((node, symbols[until]), -1)
                if node < 0:
                    break
                t = int(self.token[node])
                if t >= 0 and (start == 0 or self._may_follow(last[start - 1], t)):
                    last[until], back[until] = t, start
        out, at = [], n - 1
        while at >= 0:
            out.append(last[at])
            at = back[at] - 1
        return out[::-1]


def gathered(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches ``pool[start : start + size]``, one after the other."""
    end = np.cumsum(size)
    return pool[np.arange(end[-1] if len(end) else 0) + np.repeat(start - end + size, size)]


# Latin-1 texts are lower-cased and split here; others by the tokenizers library's own rules.
_LATIN_WORD = re.compile(r"[a-zªµºß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼½¾]|[^\x09-\x0d \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
_STEPS = ["NFC", "Replace", "Lowercase"]


class WordTokenizer:
    """A tokenizer file whose normaliser is NFC, one blank for white space and lower case, and whose
    pre-tokenizer splits words and maps them to bytes; its BPE has a word-end suffix."""

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        parsed = json.loads(spec)
        if [s["type"] for s in parsed["normalizer"]["normalizers"]] != _STEPS or parsed["model"]["type"] != "BPE":
            raise ValueError("not a word-level byte BPE tokenizer file")
        self.automaton = Automaton(parsed["model"])
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self._library = Tokenizer.from_str(spec)
        self._bytes = {c: b for b, c in enumerate(byte_letters())}
        self.labels = dict(enumerate(self.automaton.labels)) | {i: t for t, i in self.special.items()}

    def _words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            plain = self._library.normalizer.normalize_str(text)
            return [bytes(self._bytes[c] for c in w).decode("utf-8") for w, _ in self._library.pre_tokenizer.pre_tokenize_str(plain)]
        return _LATIN_WORD.findall(text.lower())

    def words(self, text: str | None) -> list[str]:
        """The words of a text in order; special tokens stand as words of their own."""
        if not text:
            return []
        if "<" not in text or not self.special:
            return self._words(text)
        return [w for part in self._special.split(text) if part for w in ([part] if part in self.special else self._words(part))]

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        plain = [w for w in words if w not in self.special]
        ids = iter(self.automaton.encode_words(plain))
        return [[self.special[w]] if w in self.special else next(ids) for w in words]

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined by blanks (the file has no decoder)."""
        return " ".join(self.labels[i] for i in ids)


_LOADED: dict[bytes, WordTokenizer] = {}


def load(spec: bytes) -> WordTokenizer:
    """The tokenizer of a file's content; each worker process compiles it once."""
    key = hashlib.sha256(spec).digest()
    if key not in _LOADED:
        _LOADED[key] = WordTokenizer(spec.decode("utf-8"))
    return _LOADED[key]


def read_spec(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class WordMemory:
    """Remembers what ``make(word, ids)`` gave for each word, for up to ``most`` words."""

    def __init__(self, tokenizer: WordTokenizer, make: Callable[[str, list[int]], object], most: int = 700_000) -> None:
        self.tokenizer, self.make, self.most = tokenizer, make, most
        self.known: dict[str, object] = {}

    def learn(self, texts: list[list[str]]) -> None:
        """Encode the words of ``texts`` that are new."""
        if len(self.known) > self.most:
            self.known.clear()
        new = list(set().union(*texts).difference(self.known))
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            self.known.update(zip(part, map(self.make, part, self.tokenizer.encode(part)), strict=True))


_MEMORIES: dict[tuple[bytes, str], WordMemory] = {}


def kept_memory(spec: bytes, name: str, make: Callable[[str, list[int]], object]) -> WordMemory:
    """The word memory of this kind that a worker process keeps from task to task."""
    key = hashlib.sha256(spec).digest(), name
    if key not in _MEMORIES:
        _MEMORIES[key] = WordMemory(load(spec), make)
    return _MEMORIES[key]


class HashMemory:
    """Ids of byte strings by their 64-bit hash: a growing open-addressing table into a pool of ids."""

    def __init__(self, kind: np.dtype) -> None:
        self.keys, self.codes = np.full(1 << 16, -1, np.int64), np.zeros(1 << 16, np.int32)
        self.known, self.used = 0, 0
        self.pool, self.start, self.size = np.zeros(1 << 16, kind), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)

    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.keys, self.codes, self.pool, self.start, self.size))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return keys & (len(self.keys) - 1)  # the hashes are mixed well

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for those not known."""
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.codes[slot], np.int32(-1))
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[left]]
            hit = there == keys[left]
            out[left[hit]] = self.codes[slot[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out

    def _place(self, keys: np.ndarray, codes: np.ndarray) -> None:
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[left[free]]
            placed = self.keys[slot] == keys[left]
            self.codes[slot[placed]] = codes[left[placed]]
            left, slot = left[~placed], (slot[~placed] + 1) & (len(self.keys) - 1)

    def add(self, keys: np.ndarray, flat: np.ndarray, size: np.ndarray) -> None:
        """New, distinct keys; their ids lie one after the other in ``flat``."""
        first, self.known = self.known, self.known + len(keys)
        if 2 * self.known > len(self.keys):
            old, codes = self.keys, self.codes
            bits = (4 * self.known).bit_length()
            self.keys, self.codes = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
            self._place(old[old >= 0], codes[old >= 0])
        self._place(keys, np.arange(first, self.known, dtype=np.int32))
        self.pool = grown(self.pool, self.used + len(flat))
        self.pool[self.used : self.used + len(flat)] = flat
        self.start, self.size = grown(self.start, self.known), grown(self.size, self.known)
        self.start[first : self.known] = self.used + np.cumsum(size) - size
        self.size[first : self.known] = size
        self.used += len(flat)

    def ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[codes].astype(np.int64)
        return gathered(self.pool, self.start[codes], size), size


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: letters (1), digits (2), other ASCII (3), and what the tokenizer's own rules must split (4)
_CLASS = np.full(256, 4, np.uint8)
_CLASS[:128] = 3
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[[ord("'"), ord("<"), *range(ord("A"), ord("Z") + 1)]] = 4


class ChunkIds:
    """Encodes texts by what stands between ASCII white space (chunks), whole batches at a time.

    No word, special token or normalisation reaches over white space, so a text's ids are its chunks' ids. Chunks, and
    the words that they consist of, are known by 64-bit hashes and remembered with their ids until the
    tables would pass ``most_bytes``. New chunks of lower-case ASCII are split into words by byte
    classes, others by the tokenizer; new words run through the automaton.
    """

    def __init__(self, tokenizer: WordTokenizer, most_bytes: int = 180_000_000) -> None:
        self.tokenizer, self.most_bytes = tokenizer, most_bytes
        self.type = np.dtype("<u2") if max(tokenizer.labels) < 1 << 16 else np.dtype("<u4")
        self._forget()

    def _forget(self) -> None:
        self.chunks, self.words = HashMemory(self.type), HashMemory(self.type)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, how many each text has, and which ids end a chunk."""
        if self.chunks.nbytes() + self.words.nbytes() > self.most_bytes:
            self._forget()
        data = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        data = [d if b"<" in d else d.lower() for d in data]  # special tokens keep their case
        buf = np.frombuffer(b" " + b" ".join(data) + b" ", np.uint8)
        blank = _BLANK[buf]
        start, end = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        flat, size = self._ids(self.chunks, buf, start, end, self._new_chunks)
        text_end = np.cumsum([len(d) + 1 for d in data])  # after each text's last byte in ``buf``
        total = np.concatenate(([0], np.cumsum(size)))
        ends = np.zeros(len(flat), bool)
        ends[total[1:][size > 0] - 1] = True
        return flat, np.diff(total[np.concatenate(([0], np.searchsorted(start, text_end)))]), ends

    def _ids(self, memory: HashMemory, buf: np.ndarray, start: np.ndarray, end: np.ndarray, learn: Callable) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the byte ranges, one after the other, and how many each has; new ones are learned."""
        keys = (range_hashes(buf, start, end) >> np.uint64(1)).astype(np.int64)
        code = memory.get(keys)
        new = np.flatnonzero(code < 0)
        if len(new):
            distinct, first = np.unique(keys[new], return_index=True)
            memory.add(distinct, *learn(buf, start[new[first]], end[new[first]]))
            code[new] = memory.get(keys[new])
        return memory.ids(code)

    def _new_chunks(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = end - start
        kind = _CLASS[gathered(buf, start, size)]
        at = np.cumsum(size) - size
        plain = np.maximum.reduceat(kind, at) < 4
        out_size = np.zeros(len(start), np.int64)
        parts, order = [], []
        if plain.any():
            rows = np.flatnonzero(plain)
            here = gathered(buf, start[rows], size[rows])
            cut = np.zeros(len(here) + 1, bool)
            cut[[0, *np.cumsum(size[rows]).tolist()]] = True
            kind = _CLASS[here]
            cut[1:-1] |= (kind[1:] != kind[:-1]) | (kind[1:] == 2)  # every digit is a word
            cuts = np.flatnonzero(cut)
            flat, n = self._ids(self.words, here, cuts[:-1], cuts[1:], self._new_words)
            total = np.concatenate(([0], np.cumsum(n)))
            out_size[rows] = np.diff(total[np.searchsorted(cuts, np.concatenate(([0], np.cumsum(size[rows]))))])
            parts.append(flat)
            order.append(rows)
        if not plain.all():
            rows = np.flatnonzero(~plain)
            whole = buf.tobytes()
            words = [self.tokenizer.words(whole[a:b].decode("utf-8", "surrogatepass")) for a, b in zip(start[rows].tolist(), end[rows].tolist(), strict=True)]
            spelled = [w.encode("utf-8", "replace") for ws in words for w in ws]
            stop = np.cumsum([0, *map(len, spelled)])
            flat, n = self._ids(self.words, np.frombuffer(b"".join(spelled), np.uint8), stop[:-1], stop[1:], self._new_words)
            total = np.concatenate(([0], np.cumsum(n)))
            out_size[rows] = np.diff(total[np.cumsum([0, *map(len, words)])])
            parts.append(flat)
            order.append(rows)
        # back into the order of the chunks
        rows, flat = np.concatenate(order), np.concatenate(parts)
        n = out_size[rows]
        place = np.empty(len(rows), np.int64)
        place[rows] = np.cumsum(n) - n
        return gathered(flat, place, out_size), out_size

    def _new_words(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size, out_size = end - start, np.zeros(len(start), np.int64)
        odd = (size > LONG_WORD) | (buf[start] == ord("<"))  # "<" may begin a special token
        parts, rows = [], np.flatnonzero(~odd)
        for at in range(0, len(rows), 4096):
            here = rows[at : at + 4096]
            flat, out_size[here] = self.tokenizer.automaton.encode_bytes(gathered(buf, start[here], size[here]), size[here])
            parts.append(flat)
        for k in np.flatnonzero(odd).tolist():
            ids = self.tokenizer.encode([buf[start[k] : end[k]].tobytes().decode("utf-8", "replace")])[0]
            out_size[k] = len(ids)
            parts.append(np.array(ids, np.int64))
        rows = np.concatenate((rows, np.flatnonzero(odd)))
        n = out_size[rows]
        place = np.empty(len(rows), np.int64)
        place[rows] = np.cumsum(n) - n
        return gathered(np.concatenate(parts), place, out_size), out_size


def grown(array: np.ndarray, need: int) -> np.ndarray:
    """``array``, or a longer copy of it that has ``need`` places."""
    if need <= len(array):
        return array
    return np.concatenate((array, np.zeros(max(need - len(array), len(array) // 2), array.dtype)))


_CHUNKS: dict[bytes, ChunkIds] = {}


def kept_chunks(spec: bytes) -> ChunkIds:
    """The chunk memory that a worker process keeps from task to task."""
    key = hashlib.sha256(spec).digest()
    if key not in _CHUNKS:
        _CHUNKS[key] = ChunkIds(load(spec))
    return _CHUNKS[key]


def encode_documents(docs: DataFrame, spec: bytes, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids`` and ``decoded`` of each row.

    ``spec`` is the tokenizer file's content (broadcast; its size does not depend on the data).
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(shared.value)
        labels = tokenizer.labels

        def both(_: str, ids: list[int]) -> tuple[bytes, bytes]:
            return b"".join([b"%d " % i for i in ids]), "".join([f"{labels[i]} " for i in ids]).encode("utf-8")

        memory = kept_memory(shared.value, "decimal", both)
        for b in arrow_rows(batches, 128):
            texts = [tokenizer.words(t) for t in b.column("text").to_pylist()]
            memory.learn(texts)
            n, ids_sha, text_sha, ids_out, text_out = [], [], [], [], []
            for words in texts:
                pairs = [memory.known[w] for w in words]
                ids, decoded = b"".join([p[0] for p in pairs]), b"".join([p[1] for p in pairs])
                n.append(ids.count(b" "))
                ids_sha.append(hashlib.sha256(ids[:-1]).hexdigest())
                text_sha.append(hashlib.sha256(decoded[:-1]).hexdigest())
                if with_ids:
                    ids_out.append([int(i) for i in ids.split()])
                    text_out.append(decoded[:-1].decode("utf-8"))
            arrays = [b.column("id"), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                arrays += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(text_out, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"id {docs.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.mapInArrow(run, schema + (", ids array<int>, decoded string" if with_ids else ""))
