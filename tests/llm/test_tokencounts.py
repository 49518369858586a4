import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from peerscore.llm import tokencounts as C

with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
    RANKS = f.read()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def brute(library, parts, lines, rule):
    """Sections and counts, token by token and character by character."""
    text = "\n".join(p or "" for p in parts)
    where, sections = [], []
    for k, p in enumerate(parts):
        p = (p or "") + ("\n" if k < len(parts) - 1 else "")
        number = 0
        body = len(parts[k] or "")
        sections.append((k, 0))
        for c, x in enumerate(p):
            where.append(len(sections) - 1)
            if lines and x == "\n" and c + 1 < body:
                number += 1
                sections.append((k, number))
    counts, across = [0] * len(sections), [0] * len(sections)
    for a, b in library.encode(text, add_special_tokens=False).offsets:
        hit = where[a:b]
        s = hit[0] if rule == "first" else hit[-1] if rule == "last" else max(sorted(set(hit)), key=hit.count)
        counts[s] += 1
        across[s] += len(set(hit)) > 1
    return [(k, n, c, x) for (k, n), c, x in zip(sections, counts, across, strict=True)]


@pytest.mark.parametrize("rule", C.RULES)
@pytest.mark.parametrize("lines", [True, False])
def test_equals_brute_force(spark, library, prose, rule, lines):
    r = random.Random(8)
    pieces = ["word", " two", "\n", "\n\n", "\n\n\n", " ", "日本", "é", "🎉", ".", "<|endoftext|>"]
    rows = [(i, "".join(r.choice(pieces) for _ in range(r.randint(0, 40))), "".join(r.choice(pieces) for _ in range(r.randint(0, 10)))) for i in range(60)]
    rows += [(100, None, None), (101, "", "x"), (102, None, "a\n"), (103, prose(1, 20000), None), (104, "same\n", "same"), (104, "same\n", "same"), (None, "null id", "\n")]
    docs = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, title string, body string, n_tokens int").repartition(2)
    got = C.attribute_tokens(docs, RANKS, public_tokenizers.PATTERN, fields=("title", "body"), lines=lines, rule=rule)
    out = sorted((str(x["id"]), x["field"], x["section"], x["n_tokens"], x["n_crossing"]) for x in got.collect())
    want = sorted((str(i), ("title", "body")[k], n, c, x) for i, a, b in rows for k, n, c, x in brute(library, (a, b), lines, rule))
    assert out == want


def test_sections_tile_the_text():
    field, number, ends = C.sections(["a\nb\n", "", "c"], True)
    assert (field, number, ends) == ([0, 0, 1, 2], [0, 1, 0, 0], [2, 5, 6, 7])


def test_empty_table_and_unknown_rule(make_docs):
    docs = make_docs([])
    assert C.attribute_tokens(docs, RANKS, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        C.attribute_tokens(docs, RANKS, public_tokenizers.PATTERN, rule="any")


def test_allocate_longest():
    counts, across = C.allocate(np.array([0, 2, 7]), np.array([2, 7, 9]), np.array([3, 5, 9]), "longest")
    assert counts.tolist() == [1, 1, 1] and across.tolist() == [0, 1, 0]
