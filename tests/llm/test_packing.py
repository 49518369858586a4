import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from peerscore.llm import bpe, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(rows, pieces, library, window=2048):
    """Every id of every row in exactly one piece, windows gapless, nothing padded."""
    def ids(t):
        return np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")

    by_id = defaultdict(list)
    for r in pieces:
        by_id[r["id"]].append(r)
    wanted = defaultdict(list)
    for i, t in rows:
        wanted[i].append(ids(t))
    assert by_id.keys() == wanted.keys()
    for i, got in by_id.items():
        whole = sorted(len(x) for x in wanted[i])
        assert sum(r["length"] for r in got) == sum(whole) and {r["doc_tokens"] for r in got} == set(whole)
        for r in got:
            sums = {zlib.crc32(x[r["start"] : r["start"] + r["length"]].tobytes()) for x in wanted[i] if len(x) == r["doc_tokens"]}
            assert r["ids_crc32"] in sums
    sequences = defaultdict(list)
    for r in pieces:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)


def test_documents(make_docs, library, prose):
    rows = [(i, prose(i, 20 + 37 * (i % 50))) for i in range(60)] + [(100, None), (101, ""), (102, prose(9, 9000)), (None, "null id"), (7, prose(7, 30)), (7, prose(7, 30))]
    pieces = packing.pack(make_docs(rows), bpe.read_spec(PATH)).collect()
    check(rows, pieces, library)


def test_blocks_and_shards_lose_nothing(make_docs, library, prose, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 7)
    rows = [(i, prose(i, 200)) for i in range(50)]
    check(rows, packing.pack(make_docs(rows), bpe.read_spec(PATH), window=256).collect(), library, 256)


def test_repeatable(make_docs, prose):
    rows = [(i, prose(i, 100)) for i in range(30)]
    one, two = (sorted(map(tuple, packing.pack(make_docs(rows).repartition(n), bpe.read_spec(PATH)).collect())) for n in (1, 5))
    assert one == two


def test_neighbours_follow_their_seed(make_docs, prose):
    topics = {k: [f"topic{k}word{j}" for j in range(12)] for k in range(5)}
    rows = [(i, " ".join(topics[i % 5]) + " " + prose(i, 10)) for i in range(50)]
    pieces = packing.pack(make_docs(rows), bpe.read_spec(PATH), window=256).orderBy("sequence_id", "offset").collect()
    order = list(dict.fromkeys(r["id"] for r in pieces))
    together = sum(a % 5 == b % 5 for a, b in zip(order, order[1:], strict=False))
    assert together >= 40  # random order would give about 10


def test_topics_meet_over_many_shards(make_docs, prose, library, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 16)
    topics = 60
    rows = [(i, " ".join(f"topic{i % topics}word{j}" for j in range(12)) + " " + prose(i, 30)) for i in range(600)]
    docs = make_docs(rows)
    pieces = packing.pack(docs, bpe.read_spec(PATH), window=256).collect()
    check(rows, pieces, library, 256)
    shards = defaultdict(list)
    for i, s in {(r["id"], r["sequence_id"] >> 32) for r in pieces}:
        shards[i % topics].append(s)
    assert len({s for x in shards.values() for s in x}) >= 600 // 16
    assert sum(max(x.count(s) for s in x) for x in shards.values()) >= 0.8 * 600  # dealt at random about 0.18


def test_one_large_key_is_spread():
    sizes = np.zeros(packing.BUCKETS + 1, int)
    sizes[[3, 8, 9, packing.BUCKETS]] = 5 * packing.SHARD_DOCS, 10, 20, 700
    topic = np.zeros(packing.BUCKETS, int)
    topic[[8, 9]] = 1
    first, parts = packing.shard_places(sizes, topic)
    assert parts[3] == 5 and first[8] == first[9] >= 5 and first[packing.BUCKETS] > first[8] and parts[packing.BUCKETS] == 2


def test_scores_equal_plain_bm25():
    terms = [np.array([1, 2, 3]), np.array([2, 3]), np.array([3, 9]), np.array([], int)]
    counts = [np.array([1, 2, 1]), np.array([3, 1]), np.array([1, 5]), np.array([], int)]
    idf = np.arange(packing.BUCKETS, 0, -1) / 1000.0
    got = packing.neighbour_scores(terms, counts, idf, 4.0, 2)
    tf = [dict(zip(t.tolist(), c.tolist(), strict=True)) for t, c in zip(terms, counts, strict=True)]
    shared = {t for t in range(10) if sum(t in x for x in tf) > 1}
    for q, query in enumerate(tf):
        asked = sorted(shared & query.keys(), key=lambda t: -idf[t])[:2]
        for d, doc in enumerate(tf):
            n = sum(doc.values())
            want = 0 if q == d else sum(idf[t] * doc[t] * 2.2 / (doc[t] + 1.2 * (0.25 + 0.75 * n / 4.0)) for t in asked if t in doc)
            assert np.isclose(got[q, d], want, rtol=1e-5)


def encoded(docs):
    spec = bpe.read_spec(PATH)
    return packing.encode(docs.selectExpr("doc_id as id", "text"), spec), spec


def test_statistics_cover_all_documents(make_docs, prose):
    rows = [(i, f"common {prose(i, 5)}") for i in range(40)]
    frame, spec = encoded(make_docs(rows))
    idf, mean, n = packing.term_statistics(frame)
    _, bucket, _ = packing.Lexicon(spec).terms(*bpe.ChunkIds(bpe.load(spec)).encode(["common"]))
    assert (mean, n) == (6, 40) and np.isclose(idf[bucket[0]], np.log1p(0.5 / 40.5))


def test_ids_and_term_counts_come_from_one_split(make_docs, prose, library):
    spec = bpe.read_spec(PATH)
    texts = [prose(k, 40) + " The the THE, end-of-line a1b2 A1 b2\n" + prose(k % 3, 20) for k in range(30)] + ["", None, "<|endoftext|>x <|endoftext|>", "é\u4e2d\u6587 " * 5, "... !"]
    flat, size, chunk_ends = bpe.ChunkIds(bpe.load(spec)).encode(texts)
    text, bucket, count = packing.Lexicon(spec).terms(flat, size, chunk_ends)
    cuts, names = np.cumsum([0, *size]), {}
    for k, t in enumerate(texts):
        assert flat[cuts[k] : cuts[k + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids
        words = Counter(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").replace("<|endoftext|>", " ").lower()))
        mine = dict(zip(bucket[text == k].tolist(), count[text == k].tolist(), strict=True))
        assert sorted(mine.values()) == sorted(words.values())
        for w in words:  # a word has the same bucket in every text
            here = {b for b, n in mine.items() if n == words[w]}
            names[w] = names.get(w, here) & here
    assert all(names.values()) and sum(len(v) == 1 for v in names.values()) > 20


def test_rare_terms_are_the_rarest_shared_ones():
    r = np.random.default_rng(2)
    idf = r.integers(1, 40, packing.BUCKETS) / 4.0
    texts = [np.sort(r.choice(packing.BUCKETS, n, replace=False)) for n in (0, 3, 200, 500)]
    place, order = packing.rarity_order(idf, 9.0)
    got = packing.rare_terms([t.astype("<i4").tobytes() for t in texts], place, order, int((idf < 9.0).sum()))
    for t, g in zip(texts, got, strict=True):
        shared = [int(x) for x in t if idf[x] < 9.0]
        assert g.tolist() == sorted(shared, key=lambda x: (-idf[x], x))[: packing.KEY_TERMS]


def test_a_row_repeated_very_often_is_spread(make_docs, prose, monkeypatch, library):
    monkeypatch.setattr(packing, "SHARD_DOCS", 16)
    rows = [(7, prose(1, 40))] * 200 + [(100 + i, prose(i, 40)) for i in range(200)]
    pieces = packing.pack(make_docs(rows), bpe.read_spec(PATH), window=256).collect()
    shards = Counter(r["sequence_id"] >> 32 for r in pieces if r["id"] == 7 and r["start"] == 0)
    assert sum(shards.values()) == 200 and max(shards.values()) <= 40


def test_empty_table(make_docs):
    assert packing.pack(make_docs([]), bpe.read_spec(PATH)).count() == 0
