import hashlib
import random

import pytest

from peerscore.llm.queries import op13_periodic_runs, planted_words
from peerscore.llm.runs import Names, WaveletTree, collapse, find_runs, periodic_runs, repeating_parts, runs_of_texts
import numpy as np


def plain_runs(words, min_length=6, min_powers=4):
    """Every run, by trying every period."""
    n, out = len(words), []
    for q in range(1, n // min_powers + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, min_powers * q):
                part = words[i : j + q]
                if all(part[d:] != part[: len(part) - d] for d in range(1, q)):
                    out.append((i, j + q, q))
            i = max(j, i + 1)
    return sorted(out)


def texts_of(seed, count):
    r = random.Random(seed)
    for k in range(count):
        alphabet, size, words = r.choice([1, 2, 2, 3, 6]), r.randint(0, 90), []
        while len(words) < size:
            piece = [r.randrange(alphabet) for _ in range(r.randint(1, 9) if k % 2 else 1)]
            if r.random() < 0.3:  # periods that hold periods
                piece = piece * r.randint(2, 5) + piece[: r.randint(0, 2)]
            words += (piece * r.randint(1, 7))[: r.randint(1, 70)]
        yield [b"%d" % w for w in words]


@pytest.mark.parametrize("min_length,min_powers", [(6, 4), (1, 3), (10, 5)])
def test_runs_equal_the_plain_search(min_length, min_powers):
    texts = list(texts_of(min_powers, 700))
    found = runs_of_texts(texts, min_length, min_powers)  # searched together
    assert found == [plain_runs(t, min_length, min_powers) for t in texts]
    assert sum(map(len, found)) > 500


def test_the_pattern_matching_alone_finds_all_runs():
    for t in texts_of(99, 300):
        symbols = np.array([int(w) for w in t], np.int64)
        assert periodic_runs(symbols, 6, 4) == plain_runs(t)


def test_names_and_extensions():
    r = random.Random(4)
    s = np.array([r.randrange(2) for _ in range(120)] + [7])
    names = Names(s)
    text = s.tolist()
    assert names.suffixes.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    i, j = np.array([r.randrange(121) for _ in range(400)]), np.array([r.randrange(121) for _ in range(400)])
    keep = i != j
    i, j = i[keep], j[keep]
    ahead = [next((k for k in range(200) if max(a, b) + k >= 121 or text[a + k] != text[b + k])) for a, b in zip(i, j)]
    before = [next((k for k in range(200) if min(a, b) - k - 1 < 0 or text[a - k - 1] != text[b - k - 1])) for a, b in zip(i, j)]
    assert names.equal_ahead(i, j).tolist() == ahead and names.equal_before(i, j).tolist() == before


def test_wavelet_tree_successor():
    r = random.Random(6)
    numbers = [r.randrange(200) for _ in range(150)]
    tree = WaveletTree(np.array(numbers))
    asked = [(lo := r.randint(0, 150), r.randint(lo, 150), r.randint(0, 300)) for _ in range(500)]
    got = tree.successor(*(np.array(c) for c in zip(*asked)))
    assert got.tolist() == [min((x for x in numbers[a:b] if x >= v), default=-1) for a, b, v in asked]


def test_parts_lose_no_run_and_hold_only_frequent_words():
    for t in texts_of(8, 200):
        parts = repeating_parts(t, 6, 4)
        assert all(any(a <= s and e <= b for a, b in parts) for s, e, _ in plain_runs(t))
        assert all(t[a:b].count(w) >= 4 for a, b in parts for w in t[a:b])


def test_collapse_keeps_the_first_period_of_each_run():
    words = b"a b a b a b a b c c c c c c d".split()
    runs = plain_runs(words)
    assert runs == [(0, 8, 2), (8, 14, 1)]
    assert collapse(words, runs) == b"a b c d".split()
    for t in texts_of(21, 200):
        dropped = {i for s, e, q in plain_runs(t) for i in range(s + q, e)}
        assert collapse(t, plain_runs(t)) == [w for i, w in enumerate(t) if i not in dropped]


def test_odd_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "x " * 9), (5, "x " * 9), (5, "x " * 9), (6, "é é " * 5 + "end"), (7, "one two three")]
    got = {(r["id"], r["n_words"], r["collapsed"], tuple(map(tuple, r["runs"]))) for r in find_runs(make_docs(rows)).collect()}
    assert got == {
        (1, 0, "", ()), (2, 0, "", ()), (3, 0, "", ()), (None, 9, "x", ((0, 9, 1),)), (5, 9, "x", ((0, 9, 1),)),
        (6, 6, "é é é é é é é é é é end", ()), (7, 3, "one two three", ()),
    }
    assert find_runs(make_docs(rows)).where("id = 5").count() == 2
    assert find_runs(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        find_runs(make_docs([]), min_powers=2)


def test_a_long_text_of_one_word_and_one_of_a_long_period(spark, make_docs, prose):
    piece = prose(3, 5000)
    got = {r["id"]: r["runs"] for r in find_runs(make_docs([(1, "w " * 150_000), (2, " ".join([piece] * 4))])).collect()}
    assert [tuple(r) for r in got[1]] == [(0, 150_000, 1)]
    assert (0, 20_000, 5000) in {tuple(r) for r in got[2]}


def test_query_equals_the_contract_word_by_word(spark, make_docs, prose, tmp_path):
    r = random.Random(12)
    rows = [(i, None if i % 41 == 0 else " ".join(r.choice(["a", "b", prose(i, 1)]) for _ in range(r.randint(0, 120)))) for i in range(400)]
    rows += [(7, rows[8][1])]
    make_docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(op13_periodic_runs(spark, str(tmp_path)).collect(), key=lambda x: (x["doc_id"], x["collapsed_sha256"]))
    want = []
    for i, text in rows:
        words = planted_words(i, (text or "").encode().split())
        runs = sorted(((s, e - s, q) for s, e, q in plain_runs(words)), key=lambda x: (x[0], x[2]))
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
        want.append((
            i, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in dropped)).hexdigest(),
        ))
    assert [tuple(x) for x in got] == sorted(want, key=lambda x: (x[0], x[-1]))
    assert any(x["n_runs"] > 1 for x in got)
