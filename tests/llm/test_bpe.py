import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from peerscore.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LATIN = "".join(map(chr, range(256)))
TRICKY = [
    "", " ", LATIN, " ".join(LATIN), "it's 's's ''s 'start we'll I'M a'b 'Tis !'s x<|endoftext|>y <|startoftext|><|endoftext|>",
    "a" * 700, "!" * 300, "the" * 90, "日本語 テスト İstanbul ΑΣΣΟΣ ΣΑΣ é ﬁ x​", "🎉🎉 ok", "x\0y", "\x1c\x1dabc\x1e", "AAAA aaaaa aaaaaa",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_every_word_equals_the_library(library):
    t, r = bpe.load(bpe.read_spec(PATH)), random.Random(1)
    texts = TRICKY + ["".join(r.choice("aaabcdeinorst  '!.0é<ß") for _ in range(r.randint(1, 80))) for _ in range(800)]
    texts += ["".join(chr(r.choice([r.randint(32, 600), r.randint(0x300, 0xD000)])) for _ in range(r.randint(1, 40))) for _ in range(200)]
    for text in texts:
        words = t.words(text)
        ids = [i for w in t.encode(words) for i in w]
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text[:60]
        assert t.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_long_words_take_the_same_path(library, monkeypatch):
    t, r = bpe.load(bpe.read_spec(PATH)), random.Random(4)
    words = ["".join(r.choice("aehnorst") for _ in range(r.randint(2, 40))) for _ in range(300)]
    many = t.encode(words)
    monkeypatch.setattr(bpe, "LONG_WORD", 1)
    assert t.encode(words) == many


def test_improper_merges_are_refused():
    letters = bpe.byte_letters()
    vocab = {c: i for i, c in enumerate([*letters, *(c + "$" for c in letters)])} | {"ab": 512, "abc": 513}
    model = {"vocab": vocab, "merges": [["ab", "c"], ["a", "b"]], "end_of_word_suffix": "$"}
    with pytest.raises(ValueError):
        bpe.Automaton(model)


def test_documents(make_docs, library, prose):
    rows = list(enumerate([*TRICKY, None, prose(1, 20000), prose(2, 30), prose(2, 30)])) + [(None, "null id"), (3, "again")]
    got = bpe.encode_documents(make_docs(rows), bpe.read_spec(PATH), with_ids=True).collect()
    assert len(got) == len(rows)
    want = set()
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out = library.decode(ids, skip_special_tokens=False)
        want.add((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(out.encode()).hexdigest(), tuple(ids), out))
    assert {(r["id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"]), r["decoded"]) for r in got} == want


def test_empty_table(make_docs):
    assert bpe.encode_documents(make_docs([]), bpe.read_spec(PATH)).count() == 0


def test_key_table():
    import numpy as np

    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 50, 5000))
    table = bpe.KeyTable(keys, np.arange(len(keys), dtype=np.int32), -7)
    assert (table.get(keys) == np.arange(len(keys))).all()
    assert (table.get(np.array([1 << 60, 1 << 61])) == -7).all()
