import numpy as np

from peerscore.llm import toxicity as X


def data(prose, n=400):
    """Toxic: an insult together with a group word; each alone is harmless."""
    r, docs, labels = np.random.default_rng(1), [], []
    for i in range(n):
        insult, group = bool(r.integers(0, 2)), bool(r.integers(0, 2))
        words = prose(i, 30).split(" ")
        words.insert(5, "scoundrels" if insult else "window")
        words.insert(15, "gardeners" if group else "table")
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(insult and group)))
    return docs, labels


def test_learns_the_pair_on_held_out_rows(spark, make_docs, prose):
    docs, labels = data(prose)
    table, marks = make_docs(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = X.fit(X.learnable(table), marks.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    truth = {i: t for i, _, t in labels}
    got = {r["doc_id"]: r["_tox_score"] for r in X.score(table, model).collect()}
    import zlib

    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 50 and all((got[i] >= X.THRESHOLD) == bool(truth[i]) for i in held)
    assert np.abs(model.v).max() > 0.05


def test_learns_a_pair_without_single_effects(spark, make_docs, prose):
    """Toxic: exactly one of two words; neither word goes with the label by itself."""
    r, docs, labels = np.random.default_rng(3), [], []
    for i in range(3000):
        a, b = bool(r.integers(0, 2)), bool(r.integers(0, 2))
        words = prose(i, 12).split(" ")
        words[3], words[8] = ("scoundrels" if a else "window"), ("gardeners" if b else "table")
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(a == b)))
    table, marks = make_docs(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = X.fit(X.learnable(table), marks.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    import zlib

    got = {x["doc_id"]: x["_tox_score"] for x in X.score(table, model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(got[i] >= 0.5) == bool(labels[i][2]) for i in held]) >= 0.98


def test_paired_terms_equal_the_plain_count():
    r = np.random.default_rng(5)
    rows = [sorted(np.flatnonzero(r.random(12) < 0.4).tolist()) for _ in range(1500)]
    positive = np.array([(0 in x) == (1 in x) for x in rows])
    tested = {k: 100 + k for k in range(12)}
    assert set(X.paired_terms(rows, positive, tested, 8.0, 128)) == {100, 101}
    assert X.paired_terms(rows, r.random(1500) < 0.5, tested, 8.0, 128) == []


def test_margin_equals_the_pairwise_sum():
    r = np.random.default_rng(2)
    fm = X.FactorizationMachine({}, 0.3, r.normal(size=6), r.normal(size=(6, 3)))
    on = [0, 2, 5]
    want = 0.3 + fm.w[on].sum() + sum(fm.v[i] @ fm.v[j] for a, i in enumerate(on) for j in on[a + 1 :])
    assert np.isclose(fm.margin(on), want) and fm.margin([]) == 0.3


def test_odd_rows(spark, make_docs, prose):
    docs, labels = data(prose, 120)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (5, 1, 1), (5, 1, 0), (999999, 1, 1)], "doc_id long, quality int, toxic int")
    odd = make_docs([*docs, (None, "null id"), (500, None), (501, ""), (502, prose(5, 20000)), (7, docs[7][1]), (7, docs[7][1])])
    model = X.fit(odd, marks)
    out = [(r["doc_id"], r["_tox_score"]) for r in X.score(odd, model).collect()]
    assert len(out) == len(docs) + 6 and all(0 <= s <= 1 for _, s in out)
    scores = dict(out)
    assert scores[500] == scores[501] and len({s for i, s in out if i == 7}) == 1


def test_one_class_or_no_rows(spark, make_docs):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, "a b"), (2, None)])
    model = X.fit(docs, marks)
    assert {r["_tox_score"] for r in X.score(docs, model).collect()} == {0.5}
    assert X.score(make_docs([]), model).count() == 0
    clean = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert X.score(docs, X.fit(docs, clean)).where("_tox_score >= 0.3").count() == 0
