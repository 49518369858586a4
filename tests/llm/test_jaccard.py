import itertools
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from peerscore.llm import jaccard as J
from peerscore.llm.components import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent, links = {i: i for i in sets}, dict.fromkeys(sets, 0)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 85 * len(x | y):
            links[a] += 1
            links[b] += 1
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    return {(i, len(sets[i]), find(i), links[i]) for i in sets}


def changed(text, seed, share):
    r = random.Random(seed)
    return " ".join(f"{w}x{r.randint(0, 9)}" if r.random() < share else w for w in text.split(" "))


def cluster(prose):
    base = [prose(k, n) for k, n in enumerate((12, 40, 90, 200, 600))]
    rows = [(b * 100 + k, changed(t, b * 100 + k, 0.02 * (k % 4))) for b, t in enumerate(base) for k in range(12)]
    rows += [(1000 + k, t.upper()) for k, (_, t) in enumerate(rows[:20])]
    rows += [(2000, None), (2001, ""), (2002, " \n "), (2003, "one two"), (2004, "ONE  two"), (2005, "two one"), (2006, prose(77, 9000))]
    return rows


def test_equals_brute_force(make_docs, prose):
    rows = cluster(prose)
    got = J.link_documents(make_docs(rows))
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_blocks_give_the_same_links(make_docs, prose, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_DOCS", 5)
    monkeypatch.setattr(J, "BIN_SHINGLES", 1000)
    rows = cluster(prose)
    assert {tuple(r) for r in J.link_documents(make_docs(rows)).collect()} == brute(rows)


def test_null_ids_repeated_rows_and_empty_table(make_docs, prose):
    t = prose(3, 60)
    got = {tuple(r) for r in J.link_documents(make_docs([(5, t), (5, t), (7, t), (None, t), (None, None)])).collect()}
    n = len(shingles(t))
    assert got == {(5, n, 5, 1), (7, n, 5, 1), (None, n, None, 1), (None, 0, None, 0)}
    assert J.link_documents(make_docs([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(33, 900), st.integers(0, 10**6))
def test_linked_sets_share_a_signature(n, seed):
    r = np.random.default_rng(seed)
    a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
    drop = max(1, int(len(a) * 0.08))
    b = np.unique(np.concatenate((r.choice(a, len(a) - drop, replace=False), r.integers(0, 1 << 63, drop // 2, dtype=np.uint64))))
    both = len(np.intersect1d(a, b))
    if 100 * both >= 85 * (len(a) + len(b) - both):
        assert len(np.intersect1d(J.signatures(a, 85), J.signatures(b, 85)))


@settings(max_examples=150, deadline=None)
@given(st.integers(5, 900), st.sampled_from([80, 85, 90]), st.integers(0, 10**6))
def test_pairs_just_at_the_threshold_share_a_signature(n, percent, seed):
    r = np.random.default_rng(seed)
    a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
    more = np.concatenate((a, r.integers(0, 1 << 63, len(a) * (100 - percent) // percent, dtype=np.uint64) * np.uint64(2) + np.uint64(1)))
    assert len(np.intersect1d(J.signatures(a, percent), J.signatures(np.unique(more), percent)))


def test_small_sets_whose_equal_segments_are_empty():
    """38 shingles in 3 of 16 fragments, one shingle of each exchanged: no segment that holds something is equal."""
    low = np.arange(38, dtype=np.uint64) + (np.arange(38, dtype=np.uint64) % np.uint64(3) << np.uint64(60))
    a = np.sort(low)
    b = np.sort(np.where(np.arange(38) < 3, low + np.uint64(1000), low))
    for percent in (80, 85):
        assert len(np.intersect1d(J.signatures(a, percent), J.signatures(b, percent)))


def test_five_words_at_080_equal_brute_force(make_docs, prose):
    rows = []
    for k, n in enumerate((12, 30, 42, 60, 90, 200, 400, 900)):
        text = prose(k, n).split(" ")
        rows.append((100 * k, " ".join(text)))
        for j in range(1, 12):  # a passage added, so many that some lie just under 0.8, or scattered edits
            passage = prose(1000 + 100 * k + j, max(1, n * (14 + j) // 100)).split(" ")
            rows.append((100 * k + j, " ".join([*text[: n // 3], *passage, *text[n // 3 :]])))
            rows.append((100 * k + 50 + j, changed(" ".join(text), 100 * k + j, 0.021)))
    sets = {i: {tuple(t.encode().split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    near = {(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    links = {i: sum(i in pair for pair in near) for i in sets}
    root = {i: i for i in sets}
    for _ in sets:
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    got = J.link_documents(make_docs(rows), words=5, percent=80)
    assert {tuple(r) for r in got.collect()} == {(i, len(sets[i]), root[i], links[i]) for i in sets}


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(200, k) for k in range(201, 260)]
    parent = {n: n for e in edges for n in e}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    got = {(x["u"], x["v"]) for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(n, find(n)) for n in parent if find(n) != n}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_large_groups_compare_only_blocks_that_share_a_segment(spark, monkeypatch):
    """A chain of 1,000 sets in 100 blocks: neighbours meet, and a set goes to a few blocks instead of all."""
    monkeypatch.setattr(J, "BLOCK_DOCS", 10)
    tied = spark.range(1000).selectExpr("id as set", "explode(array(id, id + 1)) as sig", "0L as hub").where("sig between 1 and 999")
    at = {r["set"]: r for r in J._blocks(tied, spark.range(1000).selectExpr("id as set", "100 as blocks")).collect()}
    assert len(at) == 1000 and all(r["side"] in r["others"] and 0 <= r["side"] < 100 for r in at.values())
    assert all(at[k]["side"] in at[k + 1]["others"] and at[k + 1]["side"] in at[k]["others"] for k in range(999))
    assert sum(len(r["others"]) for r in at.values()) <= 4000
