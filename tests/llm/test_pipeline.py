import os
import re
import subprocess
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P
from peerscore.llm import chunkdedup, common, jaccard, queries, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """Each stage's rows over the smallest test tables, written and read again."""
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
        out.append((name, docs))
    return out


def test_columns_and_order(spark, staged):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [n for n, _ in staged] == ["language", "toxicity", "near-duplicates", "substrings", "packing"]
    assert all(d.columns == columns for _, d in staged[:-1])
    assert staged[-1][1].columns[0] == "doc_id"


def test_decisions_take_effect(spark, staged):
    language, toxic, near, cut, packed = (d for _, d in staged)
    assert language.where("text is null or not text rlike '[A-Za-z]'").count() == 0
    flagged = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").select("doc_id")
    assert toxic.join(flagged, "doc_id").count() <= 0.5 * language.join(flagged, "doc_id").count()
    clean = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").select("doc_id")
    assert toxic.join(clean, "doc_id").count() >= 0.97 * language.join(clean, "doc_id").count()
    linked = {r["node"]: r["component"] for r in jaccard.link_documents(toxic).collect()}
    assert {r["doc_id"] for r in near.collect()} == set(linked.values())
    assert jaccard.link_documents(near).where("n_links > 0").count() == 0
    before = {r["doc_id"]: r["text"] for r in near.collect()}
    after = {r["doc_id"]: r for r in cut.collect()}
    assert before.keys() == after.keys()
    assert all(r["text"] == before[i] or (len(r["text"]) < len(before[i]) and r["n_chars"] == len(r["text"])) for i, r in after.items())
    assert chunkdedup.deduplicate(cut).where("_cut > 0").count() <= 1
    library = Tokenizer.from_file(public_tokenizers.path(queries.WORD_BPE))
    want = sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in after.values())
    assert packed.agg({"length": "sum"}).first()[0] == want


def test_near_duplicates_link_at_five_words_and_080(spark, make_docs, prose):
    text, other = prose(1, 200), prose(2, 200)
    docs = make_docs([(1, text), (2, f"{text} {prose(3, 36)}"), (3, other), (4, f"{other} {prose(4, 60)}")])
    assert jaccard.link_documents(docs).where("n_links > 0").count() == 0  # op8 links none of them
    assert {r["doc_id"] for r in P.near_duplicate_stage(spark, docs, SF).collect()} == {1, 3, 4}


@pytest.fixture()
def odd_docs(spark, prose):
    """Documents with extra columns that operators use as names, NULL ids and ids that repeat with the same or another text."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, _tox_score string, _lang_rejected string, _cut int, _repeats int, row string, name string, id long"
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(120).collect()]
    text, other = prose(1, 150), prose(2, 150)
    rows = real + [(9001, text, "en", "s", 1), (9001, other, "en", "s", 1), (9001, other, "en", "s", 1), (9002, f"{other} more", "en", "s", 1), (None, prose(3, 60), "en", "s", 1)]
    return spark.createDataFrame([(*r, "t", "l", 7, 8, "r", "n", 5) for r in rows], kind).repartition(3)


def test_extra_columns_are_kept_by_every_stage(spark, odd_docs, tmp_path):
    docs = odd_docs
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        kept = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(P.STAGES) - 1:
            assert kept.columns == odd_docs.columns
            extra = kept.select("_tox_score", "_lang_rejected", "_cut", "_repeats", "row", "name", "id").distinct().collect()
            assert [tuple(r) for r in extra] == [("t", "l", 7, 8, "r", "n", 5)]
            assert kept.where("doc_id is null").count() == 1
        docs = kept
    assert docs.count() > 0


def test_a_repeated_id_loses_no_unlinked_text(spark, odd_docs, prose):
    own = odd_docs.where("doc_id > 9000")
    texts = sorted((r["doc_id"], r["text"]) for r in P.near_duplicate_stage(spark, own, SF).collect())
    assert (9001, prose(1, 150)) in texts and len(texts) == 2  # of the other text and its near copy one stays


def test_near_duplicates_shuffle_only_texts_that_may_go(tmp_path):
    """Of 3,000 texts ten have a near copy: all shuffles of the stage together are smaller than the texts."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import json, pathlib, random, sys
sys.path.insert(0, {repo!r})
import corpus_pipeline as P
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "{tmp_path}/ckpt").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", "file://{tmp_path}").config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false").getOrCreate()
r = random.Random(1)
texts = [" ".join("%x" % r.getrandbits(120) for _ in range(300)) for _ in range(3000)]
texts += [t + " more" for t in texts[:10]]
spark.createDataFrame([(k - 5, t) for k, t in enumerate(texts)], "doc_id long, text string").write.parquet("{tmp_path}/docs")
ids = [r["doc_id"] for r in P.near_duplicate_stage(spark, spark.read.parquet("{tmp_path}/docs"), "").select("doc_id").collect()]
assert sorted(ids) == list(range(-5, 2995)), len(ids)
name = spark.sparkContext.applicationId
spark.stop()
events = [json.loads(x) for x in pathlib.Path("{tmp_path}", name).open()]
shuffled = sum((e.get("Task Metrics") or {{}}).get("Shuffle Write Metrics", {{}}).get("Shuffle Bytes Written", 0) for e in events)
assert shuffled < sum(map(len, texts)), (shuffled, sum(map(len, texts)))
print("small")
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "small" in done.stdout, done.stderr[-3000:]


def test_the_least_of_negative_ids_stays(spark, make_docs, prose):
    text = prose(1, 200)
    docs = make_docs([(-1, text), (-20, f"{text} more"), (3, text)])
    assert [r["doc_id"] for r in P.near_duplicate_stage(spark, docs, SF).collect()] == [-20]


def test_sieve_refuses_no_value_that_is_there(spark, monkeypatch):
    monkeypatch.setattr(common, "SIEVE_BITS", 1 << 10)
    odd = spark.createDataFrame([(f"k{k}" if k else None,) for k in range(0, 300, 3)], "key string")
    rows = spark.createDataFrame([(f"k{k}" if k else None, k) for k in range(3000)], "key string, v int")
    got = common.passes(rows, "key", common.sieve(odd, "key"), "some")
    assert got.count() == 3000 and got.columns == ["key", "v", "some"]
    assert got.where("some").join(odd, "key").count() == 99
    assert 200 < got.where("not some").count() < 2901
    assert common.passes(rows, "key", common.sieve(odd.limit(0), "key"), "some").where("some").count() == 0


def test_every_stage_takes_an_empty_table(spark, odd_docs):
    none = odd_docs.where("doc_id = -1")
    for _, stage in P.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_queries_run_from_another_folder(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", "{tmp_path}/ckpt").getOrCreate()
queries = entry.queries()
for name in ("op2_toxicity", "op5_language_id", "op9_packing", "op11_whitening", "op12_secret_scan", "op13_periodic_runs", "pipeline"):
    assert queries[name](spark, {SF!r}).count() > 0, name
print("all ran")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_run_gives_the_last_stage(spark, staged):
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, staged[-1][1].collect()))


def test_registered_queries(spark):
    assert sorted(queries.QUERIES, key=lambda n: int(re.match(r"op(\d+)_", n)[1])) == list(queries.QUERIES)
    assert len(queries.QUERIES) == 13
    got = queries.op2_toxicity(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.where(f"(score >= {toxicity.THRESHOLD}) <> (predicted = 1)").count() == 0
    assert queries.op5_language_id(spark, SF).columns == ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    assert queries.op6_license_scan(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    wrong = queries.op5_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").where("held_out and lang <> lang_pred")
    assert wrong.count() <= 2
