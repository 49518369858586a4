import random

import numpy as np

from peerscore.llm import chunkdedup as C


def test_gear_hash_equals_the_rolling_definition():
    data = np.random.default_rng(0).integers(0, 256, 500).astype(np.uint8)
    h, out = 0, []
    for b in data.tolist():
        h = (2 * h + int(C._GEAR[b])) & 0xFFFF
        out.append(h)
    assert (C.gear_hashes(data) & 0xFFFF).tolist() == out


def test_chunks_cover_the_text_and_survive_insertions(prose):
    text = prose(1, 2000)
    data = text.encode()
    ends = C.chunk_ends(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends))
    sizes = np.diff([0, *ends])
    assert sizes.max() <= C.MAX_CHUNK and sizes[:-1].min() >= C.MIN_CHUNK
    before = set(C.chunk_digests(data)[1])
    words = text.split(" ")
    words.insert(1000, "inserted")
    after = set(C.chunk_digests(" ".join(words).encode())[1])
    assert len(before - after) <= 3


def test_chunk_ends_without_white_space_and_in_multibyte_text():
    for text in ("a" * 5000, "日本語テキスト" * 400, "é" * 300, " " * 1000, "x", ""):
        data = text.encode()
        ends = C.chunk_ends(data)
        assert (ends[-1] if ends else 0) == len(data)
        for a, b in zip([0, *ends], ends, strict=False):
            assert data[a:b].decode()
            assert b > a


def brute(rows, min_words):
    """The same decisions from plain dictionaries."""
    owner = {}
    for i, t in rows:
        if i is not None and t:
            for d in C.chunk_digests(t.encode())[1]:
                owner[d] = min(i, owner.get(d, i))
    out = []
    for i, t in rows:
        if not t:
            out.append((i, t))
            continue
        ends, digests = C.chunk_digests(t.encode())
        seen, flags = set(), []
        for d in digests:
            flags.append((i is not None and owner[d] < i) or d in seen)
            seen.add(d)
        kept, k, starts = "", 0, [0, *ends]
        data = t.encode()
        while k < len(ends):
            j = k
            while j < len(ends) and flags[j] == flags[k]:
                j += 1
            part = data[starts[k] : ends[j - 1]].decode()
            if not (flags[k] and len(part.split()) >= min_words):
                kept += part
            k = j
        out.append((i, kept))
    return sorted(out, key=str)


def test_equals_brute_force_and_cuts_shared_passages(make_docs, prose):
    passage = prose(99, 70)
    rows = [(i, f"{prose(i, 150)} {passage if i % 3 == 0 else ''} {prose(1000 + i, 120)}") for i in range(30)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, None), (103, ""), (None, rows[5][1]), (104, passage + " " + passage), (105, prose(7, 20000)), (105, prose(7, 20000))]
    got = C.deduplicate(make_docs(rows))
    assert got.columns[:6] == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    out = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    assert out == brute(rows, 16)
    texts = dict(out)
    middle = " ".join(passage.split()[20:50])
    assert [i for i, t in out if t and middle in t] == [0]
    assert texts[100] == "" and texts[1] == rows[1][1]


def test_empty_table(make_docs):
    assert C.deduplicate(make_docs([])).count() == 0


def test_short_repeats_stay(make_docs, prose):
    line = "a short common line of words"
    rows = [(i, f"{prose(i, 60)}\n{line}\n{prose(500 + i, 60)}") for i in range(20)]
    assert {(r["doc_id"], r["text"]) for r in C.deduplicate(make_docs(rows)).collect()} == set(rows)


def test_random_bytes_round_trip():
    r = random.Random(5)
    for _ in range(200):
        text = "".join(r.choice("ab c\n日é") for _ in range(r.randint(0, 400)))
        assert C.cut_repeats(text.encode(), set(), 10**9)[0].decode() == text


def test_a_repeated_passage_without_spaces_is_cut(spark, make_docs):
    r = random.Random(4)
    passage = "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(1500))
    own = ["".join(chr(0x4E00 + r.randrange(3000)) for _ in range(400)) for _ in range(2)]
    got = {x["doc_id"]: x for x in C.deduplicate(make_docs([(1, own[0] + passage), (2, own[1] + passage), (3, passage)])).collect()}
    assert got[1]["_cut"] == 0 and len(got[2]["text"]) < 400 + 200 and len(got[3]["text"]) < 200
