"""Lexical retrieval packing (operator 9).

Texts are read once: they are encoded and stored as token ids and a bit an id that tells where white space
follows; the lexical words (letters and digits that stand together) are taken from these. Documents are dealt to shards so that related ones meet: words vote for topics (:func:`topics`), a
document belongs to the topic of most of its rarest shared words, and topics fill shards in order; only
a word that more documents than a shard holds belong to is spread over several. A shard holds an
inverted index over hashed words with BM25 weights; term statistics (document frequencies, mean
length) come from all documents. The first
unused document seeds a window; the unused documents that BM25 ranks next to it, with its rarest
words as the query, follow until the window is full. A document that does not fit is cut, and its
rest opens the next window as that window's seed. Windows are full but for a shard's last tokens,
which are cut into sequences whose lengths are powers of two, so nothing is padded.

Nulls and odd rows: a NULL text is an empty one and still holds the end id. NULL ids are kept as
they are; repeated rows are packed each. A text longer than a window is cut over several.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.bpe import byte_letters, gathered, kept_chunks, load
from peerscore.llm.common import arrow_rows, mix64, stage_path, with_fields

BUCKETS = 1 << 18
SHARD_DOCS = 512
POSTINGS = 1 << 20
SHARD_TOKENS = 1 << 23
KEY_TERMS = 24
ROUNDS = 3
K1, B = 1.2, 0.75


class Lexicon:
    """Words (letters, digits and all characters beyond ASCII that stand together) of texts given as token ids, in buckets."""

    def __init__(self, spec: bytes) -> None:
        tokenizer = load(spec)
        end, size = tokenizer.automaton.word_end, max(tokenizer.labels) + 1
        byte = {c: b for b, c in enumerate(byte_letters())}
        self.ends, self.wordly = np.ones(size, bool), np.zeros(size, bool)  # special tokens are pieces of their own
        for i, label in tokenizer.labels.items():
            special = i in tokenizer.special.values()
            self.ends[i] = special or not end or label.endswith(end)
            first = byte.get(label[:1], 0)
            self.wordly[i] = not special and (first >= 128 or chr(first).isalnum())
        self.hash = mix64(np.arange(1, size + 1, dtype=np.uint64))

    def words(self, flat: np.ndarray, size: np.ndarray, chunk_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The text number and the bucket of every word (``size`` ids of each text, one text after the other)."""
        last = np.flatnonzero(self.ends[flat])  # every text ends with the end of a piece
        if not len(last):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.concatenate(([0], last[:-1] + 1))
        wordly = self.wordly[flat[first]]  # the tokenizer's pieces are letters, or one digit, or other characters
        opens = np.concatenate(([True], ~wordly[1:] | ~wordly[:-1] | chunk_ends[last[:-1]]))
        first, last, wordly = first[opens], last[np.append(opens[1:], True)], wordly[opens]
        with np.errstate(over="ignore"):
            place = np.arange(len(flat)) - np.repeat(first, last + 1 - first)
            whole = np.add.reduceat(self.hash[flat] * (2 * place + 1).astype(np.uint64), first)
        text = np.searchsorted(np.cumsum(size), first[wordly], "right")
        return text, (mix64(whole[wordly]) % np.uint64(BUCKETS)).astype(np.int64)

    def terms(self, flat: np.ndarray, size: np.ndarray, chunk_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The text number, the bucket and the count of every distinct word of each text, in this order."""
        text, bucket = self.words(flat, size, chunk_ends)
        pair, count = np.unique(text * BUCKETS + bucket, return_counts=True)
        return pair // BUCKETS, pair % BUCKETS, count


_LEXICONS: dict[int, Lexicon] = {}


def kept_lexicon(spec: bytes) -> Lexicon:
    """The lexicon of a tokenizer file; each worker process builds it once."""
    key = crc32(spec)
    if key not in _LEXICONS:
        _LEXICONS[key] = Lexicon(spec)
    return _LEXICONS[key]


def _stored_ids(batch: pa.RecordBatch, kind: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a batch of stored texts, one after the other, how many each text has, and which end a chunk."""
    data = batch.column("ids").to_pylist()
    flat, size = np.frombuffer(b"".join(data), kind), np.fromiter(map(len, data), np.int64, len(data)) // kind.itemsize
    packed = batch.column("ends").to_pylist()
    first = np.cumsum([0, *map(len, packed)])[:-1] * 8  # each text's bits begin with a byte
    bits = np.unpackbits(np.frombuffer(b"".join(packed), np.uint8)).view(bool)
    return flat, size, gathered(bits, first, size)


def encode(docs: DataFrame, spec: bytes) -> DataFrame:
    """``docs`` (``id``, ``text``) stored as token ids, in one pass over the texts.

    ``row`` is a number, ``ids`` has the ids (as wide as the vocabulary needs), ``ends`` a bit an id (ends a chunk) and
    ``buckets`` the text's distinct word buckets. Each task adds a row without ``row`` whose ``buckets`` and ``ids`` are its
    document frequencies; at ``BUCKETS`` are its texts, at ``BUCKETS + 1`` its words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    schema = f"id {docs.schema['id'].dataType.simpleString()}, row long, ids binary, ends binary, buckets binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lexicon = kept_chunks(shared.value), kept_lexicon(shared.value)
        total, schema = np.zeros(BUCKETS + 2, np.int64), None
        for b in arrow_rows(batches):
            flat, size, chunk_ends = known.encode(b.column("text").to_pylist())
            text, bucket, count = lexicon.terms(flat, size, chunk_ends)
            total[:BUCKETS] += np.bincount(bucket, minlength=BUCKETS)
            total[BUCKETS:] += (b.num_rows, int(count.sum()))
            cuts = np.cumsum([0, *size]).tolist()
            ids = [flat[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            ends = [np.packbits(chunk_ends[x:y]).tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            first, bucket = np.searchsorted(text, np.arange(b.num_rows + 1)).tolist(), bucket.astype("<i4")
            terms = [bucket[x:y].tobytes() for x, y in zip(first[:-1], first[1:], strict=True)]
            out = pa.RecordBatch.from_arrays([b.column("id"), b.column("row"), *(pa.array(c, pa.binary()) for c in (ids, ends, terms))], names=["id", "row", "ids", "ends", "buckets"])
            schema = out.schema
            yield out
        if schema is not None:
            at = np.flatnonzero(total)
            own = [[None], [None], [total[at].astype("<i8").tobytes()], [b""], [at.astype("<i4").tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(own, schema, strict=True)], schema=schema)

    path = stage_path(docs.sparkSession, "packing-ids")
    rows = docs.select("id", F.monotonically_increasing_id().alias("row"), "text")
    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def term_statistics(encoded: DataFrame) -> tuple[np.ndarray, float, int]:
    """BM25's idf of each word bucket, the mean number of words and the number of texts, over all of ``encoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 2, np.int64)
        for b in batches:
            for at, n in zip(b.column("buckets").to_pylist(), b.column("ids").to_pylist(), strict=True):
                total[np.frombuffer(at, "<i4")] += np.frombuffer(n, "<i8")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    parts = encoded.where("row is null").select("buckets", "ids")
    counts = parts.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total, found = np.zeros(BUCKETS + 2), counts.toArrow()  # at most BUCKETS + 2 rows
    total[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    n, words = total[BUCKETS:]
    return np.log1p((n - total[:BUCKETS] + 0.5).clip(0.5) / (total[:BUCKETS] + 0.5)), max(1.0, words / max(n, 1)), int(n)


def rarity_order(idf: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """The place of each bucket when the rarest come first (those rarer than ``most``, held by one document, last), and the inverse."""
    order = np.argsort(np.where(idf < most, -idf, 1.0), kind="stable")
    place = np.empty(BUCKETS, np.int64)
    place[order] = np.arange(BUCKETS)
    return place, order


def rare_terms(buckets: list[bytes], place: np.ndarray, order: np.ndarray, useful: int) -> list[np.ndarray]:
    """Each text's ``KEY_TERMS`` rarest word buckets, of the first ``useful`` ones in order."""
    bucket = np.frombuffer(b"".join(buckets), "<i4")
    text = np.repeat(np.arange(len(buckets)), np.fromiter(map(len, buckets), np.int64, len(buckets)) // 4)
    rank = place[bucket]
    key = np.sort((text * BUCKETS + rank)[rank < useful])
    first = np.searchsorted(key, np.arange(len(buckets) + 1) * BUCKETS).tolist()
    terms = order[key % BUCKETS].astype(np.int32)
    return [terms[a : min(b, a + KEY_TERMS)] for a, b in zip(first[:-1], first[1:], strict=True)]


def _best(doc: np.ndarray, label: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The label of the largest summed weight of each of ``n`` documents (the smallest one of several; -1 for none)."""
    pair, at = np.unique(doc * BUCKETS + label, return_inverse=True)
    total = np.bincount(at, weight, minlength=len(pair)).astype(np.int64)
    order = np.lexsort((pair, -total, pair // BUCKETS))
    first = order[np.concatenate(([True], np.diff(pair[order] // BUCKETS) > 0))] if len(order) else order
    out = np.full(n, -1, np.int64)
    out[pair[first] // BUCKETS] = pair[first] % BUCKETS
    return out


_ORDER = mix64(np.arange(BUCKETS, dtype=np.uint64)).argsort().argsort()


def document_keys(terms: list[np.ndarray], idf: np.ndarray, topic: np.ndarray | None) -> np.ndarray:
    """Each document's own word: of its terms in the topic that most of their weight has, the first of a fixed order.

    Without topics it is the first of all its terms, so documents with common terms tend to agree. -1: no terms.
    """
    doc = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    term = np.concatenate(terms).astype(np.int64) if len(terms) else np.zeros(0, np.int64)
    if topic is not None:
        best = _best(doc, topic[term], np.round(1024 * idf[term]), len(terms))
        doc, term = doc[own := topic[term] == best[doc]], term[own]
    order = np.lexsort((_ORDER[term], doc))
    first = order[np.concatenate(([True], np.diff(doc[order]) > 0))] if len(order) else order
    out = np.full(len(terms), -1, np.int64)
    out[doc[first]] = term[first]
    return out


def _term_lists(column: pa.Array) -> list[np.ndarray]:
    flat, at = column.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *column.value_lengths().to_pylist()])
    return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def topics(keyed: DataFrame, idf: np.ndarray) -> np.ndarray:
    """The topic of each word bucket, from the documents' rare terms (column ``terms``) by label propagation.

    In each round every document votes with its topic for its terms, and a term takes the topic of most votes.
    """
    topic: np.ndarray | None = None
    for _ in range(ROUNDS):
        shared = keyed.sparkSession.sparkContext.broadcast((idf, topic))

        def vote(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            idf, topic = shared.value
            for b in batches:
                terms = _term_lists(b.column("terms"))
                own = document_keys(terms, idf, topic)
                label = own if topic is None else topic[own]
                if not sum(map(len, terms)):
                    continue
                votes = np.concatenate(terms).astype(np.int64) * BUCKETS + np.repeat(label, [len(t) for t in terms])
                pair, n = np.unique(votes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n.astype(np.int64))], names=["pair", "n"])

        votes = keyed.select("terms").mapInArrow(vote, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        term, label = F.expr(f"pair div {BUCKETS}").alias("term"), F.pmod("pair", F.lit(BUCKETS))
        best = F.max(F.col("n") * BUCKETS + (BUCKETS - 1 - label))  # most votes, then the smallest label, in one number
        found = votes.groupBy(term).agg(best.alias("best")).toArrow()  # at most BUCKETS rows
        topic = np.arange(BUCKETS)
        topic[found.column("term").to_numpy()] = BUCKETS - 1 - found.column("best").to_numpy() % BUCKETS
    return topic


def shard_places(sizes: np.ndarray, topic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First shard and number of shards of each key (a word bucket; at ``BUCKETS`` the documents without one).

    ``sizes`` has the documents of each key. Keys follow each other by topic; a topic that fits a shard is not cut,
    nor is a key that fits one, and a larger key has its shards for itself.
    """
    first, parts = np.zeros(BUCKETS + 1, np.int64), np.ones(BUCKETS + 1, np.int64)
    keys = np.flatnonzero(sizes)
    group = np.append(topic, BUCKETS)[keys]
    keys = keys[np.argsort(group, kind="stable")]
    whole = np.bincount(group, sizes[np.sort(keys)], minlength=BUCKETS + 1)
    shard, used, last = 0, 0, -1
    for key in keys.tolist():
        size, g = int(sizes[key]), int(topic[key]) if key < BUCKETS else BUCKETS
        need = int(whole[g]) if g != last and whole[g] <= SHARD_DOCS else size
        last = g
        if used and used + need > SHARD_DOCS:
            shard, used = shard + 1, 0
        first[key], parts[key] = shard, max(1, -(-size // SHARD_DOCS))
        if parts[key] > 1:
            shard, used = shard + parts[key], 0
        else:
            used += size
    return first, parts


def deal(encoded: DataFrame, idf: np.ndarray, rows: int) -> DataFrame:
    """``encoded`` (``rows`` texts) with the ``shard`` of each text.

    The rare terms are stored by themselves for the topics; the last pass finds them again, so that the ids are not
    stored twice.
    """
    context, most = encoded.sparkSession.sparkContext, float(np.log1p((rows - 0.5) / 1.5)) - 1e-9
    rarity = context.broadcast((*rarity_order(idf, most), int((idf < most).sum())))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 1024):
            terms = rare_terms(b.column("buckets").to_pylist(), *rarity.value)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.list_(pa.int32()))], names=["terms"])

    path = stage_path(encoded.sparkSession, "packing-terms")
    encoded.select("buckets").mapInArrow(describe, "terms array<int>").write.parquet(path)
    keyed = encoded.sparkSession.read.parquet(path)
    topic = topics(keyed, idf)
    final = context.broadcast((idf, topic))

    def count_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, n = np.unique(document_keys(_term_lists(b.column("terms")), *final.value), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    found = keyed.mapInArrow(count_keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS + 1 rows
    sizes = np.zeros(BUCKETS + 1, np.int64)
    sizes[found.column("key").to_numpy()] = found.column("n").to_numpy()  # the key -1 is the last place
    places = context.broadcast(shard_places(sizes, topic))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, parts = places.value
        for b in arrow_rows(batches, 1024):
            own = document_keys(rare_terms(b.column("buckets").to_pylist(), *rarity.value), *final.value)
            spread = mix64(b.column("row").to_numpy().astype(np.uint64)) % parts[own].astype(np.uint64)
            kept = [b.column(c) for c in ("id", "ids", "ends")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(first[own] + spread.astype(np.int64))], names=["id", "ids", "ends", "shard"])

    return encoded.mapInArrow(place, with_fields(encoded.select("id", "ids", "ends"), shard="long"))


def neighbour_scores(terms: list[np.ndarray], counts: list[np.ndarray], idf: np.ndarray, mean_words: float, query_terms: int) -> np.ndarray:
    """BM25 score of every document of a shard (columns) for every document's query (rows)."""
    n = len(terms)
    doc = np.repeat(np.arange(n), [len(t) for t in terms])
    scores = np.zeros((n, n), np.float32)
    if not len(doc):
        return scores
    term, tf = np.concatenate(terms), np.concatenate(counts).astype(float)
    length = np.bincount(doc, tf, minlength=n)
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / mean_words))
    shared = np.bincount(term, minlength=BUCKETS)[term] > 1  # words of one document lead nowhere
    doc, term, weight = doc[shared], term[shared], weight[shared]
    local, number = np.unique(term, return_inverse=True)
    rarity = np.empty(len(local), np.int64)
    rarity[np.argsort(-idf[local], kind="stable")] = np.arange(len(local))
    order = np.argsort(doc * len(local) + rarity[number])  # each document's rarest words first
    place = np.arange(len(order)) - np.searchsorted(doc, doc)
    asked = order[place < query_terms]
    order = np.argsort(number, kind="stable")
    p_doc, p_weight = doc[order], weight[order]
    hi = np.cumsum(np.bincount(number, minlength=len(local)))
    lo, hi = np.concatenate(([0], hi[:-1]))[number[asked]], hi[number[asked]]
    flat = scores.reshape(-1)
    total = np.cumsum(hi - lo)
    bounds = [0, *np.searchsorted(total, np.arange(POSTINGS, int(total[-1]) if len(total) else 0, POSTINGS)).tolist(), len(asked)]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):  # about POSTINGS postings at a time
        first, size = lo[a:b], hi[a:b] - lo[a:b]
        at = np.arange(size.sum()) + np.repeat(first - np.cumsum(size) + size, size)
        flat += np.bincount(np.repeat(doc[asked[a:b]], size) * n + p_doc[at], p_weight[at], minlength=n * n).astype(np.float32)
    np.fill_diagonal(scores, 0)
    return scores


def pack_order(scores: np.ndarray, sizes: list[int], room: int, window: int) -> Iterator[int]:
    """Documents in packing order: each window's seed, then its unused neighbours, best first."""
    unused = np.ones(len(sizes), bool)
    first = 0
    while True:
        while first < len(sizes) and not unused[first]:
            first += 1
        if first == len(sizes):
            return
        seed = first  # nothing related is left: the next unused document is the seed
        while seed >= 0:
            if unused[seed]:
                unused[seed] = False
                yield seed
                room -= sizes[seed]
            if room <= 0:  # the cut document opens the next window and is its seed
                room += window * -(-(1 - room) // window)
            ranked = np.flatnonzero(unused & (scores[seed] > 0))
            ranked = ranked[np.argsort(-scores[seed][ranked], kind="stable")]
            seed = -1
            for d in ranked.tolist():
                unused[d] = False
                yield d
                room -= sizes[d]
                if room <= 0:
                    seed = d
                    break


class _Packer:
    """Lays documents end to end into windows and cuts them where a window is full."""

    def __init__(self, shard: int, window: int) -> None:
        self.shard, self.window = shard, window
        self.sequence, self.offset = shard << 32, 0
        self.rows: list[tuple] = []  # pieces of the open window
        self.done: list[tuple] = []

    def _piece(self, doc_id: object, ids: bytes, start: int, length: int) -> None:
        self.rows.append((doc_id, start, length, crc32(ids[4 * start : 4 * (start + length)]), len(ids) // 4, self.sequence, self.offset, ids))
        self.offset += length

    def _close(self) -> None:
        self.done += [r[:-1] for r in self.rows]
        self.rows, self.offset, self.sequence = [], 0, self.sequence + 1

    def add(self, doc_id: object, ids: bytes) -> None:
        start, size = 0, len(ids) // 4
        while start < size:
            length = min(size - start, self.window - self.offset)
            self._piece(doc_id, ids, start, length)
            start += length
            if self.offset == self.window:
                self._close()

    def finish(self) -> None:
        """Cut what is in the open window into sequences of power-of-two lengths."""
        left, rest, self.rows, self.offset = self.offset, self.rows, [], 0
        size = self.window
        for doc_id, start, length, _, _, _, _, ids in rest:
            while length:
                if not self.offset:
                    size = 1 << (left.bit_length() - 1)
                take = min(length, size - self.offset)
                self._piece(doc_id, ids, start, take)
                start, length, left = start + take, length - take, left - take
                if self.offset == size:
                    self._close()


def pack(
    docs: DataFrame, spec: bytes, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1, query_terms: int = 12
) -> DataFrame:
    """One row per piece: ``id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``spec`` is a tokenizer file's content. A shard is worked on in blocks of at most ``SHARD_DOCS``
    documents or ``SHARD_TOKENS`` tokens, so its memory is bounded whatever the ids are.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = kept_chunks(spec).type
    stored = encode(docs, spec)
    idf, mean_words, rows = term_statistics(stored)
    encoded = stored.where("row is not null")
    shared = docs.sparkSession.sparkContext.broadcast((spec, idf, mean_words))
    dealt = deal(encoded, idf, rows)
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "id", F.crc32("ids"))
    id_type = docs.schema["id"].dataType
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def emit(rows: list[tuple], arrow_id: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, arrow_id if k == 0 else pa.int64()) for k, c in enumerate(columns)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, idf, mean_words = shared.value
        lexicon = kept_lexicon(spec)
        end = np.array([end_id], "<u4")
        packer: _Packer | None = None
        block: list[tuple] = []  # id, ids, terms, counts
        tokens = 0

        def flush() -> None:
            nonlocal tokens
            if block:
                scores = neighbour_scores([r[2] for r in block], [r[3] for r in block], idf, mean_words, query_terms)
                for d in pack_order(scores, [len(r[1]) // 4 for r in block], window - packer.offset, window):
                    packer.add(block[d][0], block[d][1])
            block.clear()
            tokens = 0

        for b in arrow_rows(batches):
            flat, size, chunk_ends = _stored_ids(b, kind)
            text, bucket, count = lexicon.terms(flat, size, chunk_ends)
            first, cuts = np.searchsorted(text, np.arange(len(size) + 1)), np.cumsum([0, *size])
            for k, (doc_id, shard) in enumerate(zip(b.column("id").to_pylist(), b.column("shard").to_pylist(), strict=True)):
                if packer is None or packer.shard != shard:
                    flush()
                    if packer is not None:
                        packer.finish()
                        yield emit(packer.done, b.schema.field("id").type)
                    packer = _Packer(shard, window)
                ids = np.concatenate((flat[cuts[k] : cuts[k + 1]].astype("<u4"), end)).tobytes()
                block.append((doc_id, ids, bucket[first[k] : first[k + 1]], count[first[k] : first[k + 1]]))
                tokens += len(ids) // 4
                if len(block) >= SHARD_DOCS or tokens >= SHARD_TOKENS:
                    flush()
                    yield emit(packer.done, b.schema.field("id").type)
                    packer.done = []
        if packer is not None:
            flush()
            packer.finish()
            yield emit(packer.done, b.schema.field("id").type)

    schema = f"id {id_type.simpleString()}, " + ", ".join(f"{c} long" for c in names[1:])
    return dealt.mapInArrow(run, schema)
