import numpy as np

from peerscore.llm import langid as L

WORDS = {
    "en": "the and of that with from which have this they would there their about".split(),
    "de": "der und nicht mit eine auch nach über können werden zwischen durch für schön".split(),
    "fr": "les des dans pour avec être cette mais où été très leur même après".split(),
}


def rows(n=60):
    r, out = np.random.default_rng(3), []
    for k, (lang, words) in enumerate(WORDS.items()):
        out += [(k * 1000 + i, " ".join(r.choice(words, 40)), lang) for i in range(n)]
    return out


def table(spark, data):
    return spark.createDataFrame([(i, t, lang, 0.5) for i, t, lang in data], "doc_id long, text string, lang string, score double").repartition(3)


def test_held_out_accuracy_and_odd_rows(spark):
    docs = table(spark, rows())
    model = L.fit(L.learnable(docs), train_per_language=30, clusters=3)
    assert len(model.centroids) <= 9 and model.languages == ["de", "en", "fr"]
    got = L.identify(docs, model)
    assert got.columns == [*docs.columns, "_lang_pred", "_lang_score", "_lang_rejected"]
    assert got.where("lang <> _lang_pred or _lang_rejected or _lang_score not between 0 and 1").count() == 0
    odd = table(spark, [(1, None, None), (2, "", "en"), (3, "123 -- !!", None), (None, "the and of that", None), (5, "the and " * 30000, None), (5, "the and of", None), (5, "the and of", None)])
    out = {(r["doc_id"], len(r["text"] or "")): (r["_lang_pred"], r["_lang_rejected"]) for r in L.identify(odd, model).collect()}
    assert out[1, 0] == out[2, 0] == out[3, 9] == ("und", True)
    assert out[None, 15] == out[5, 240000] == out[5, 10] == ("en", False)


def test_far_texts_are_rejected(spark):
    docs = table(spark, rows())
    model = L.fit(L.learnable(docs))
    names, score, rejected = model.predict(["zzqx wvkj qqzx " * 20, "the and of that with from"])
    assert rejected.tolist() == [True, False] and score[0] < score[1]


def test_held_out_rows_are_not_learned(spark):
    docs = table(spark, rows())
    ids = {r["doc_id"] for r in L.learnable(docs).collect()}
    import zlib

    assert ids == {i for i, _, _ in rows() if zlib.crc32(str(i).encode()) % 3 != 1}


def test_counts_equal_a_plain_definition():
    text = "Ab  c-d"
    framed = " ab c d "
    got = L.gram_counts([text, None, "", "--"])
    grams = sum(1 for c in framed if c != " ") + len(framed) - 1 + len(framed) - 2
    assert got[0].sum() == grams and not got[1:].any()


def test_no_training_rows(spark):
    empty = table(spark, [])
    model = L.fit(L.learnable(empty))
    assert L.identify(empty, model).count() == 0
    assert model.predict(["some text"])[0] == ["und"]
