"""The registered queries of this package: one thin query per operator."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscore.llm import ann, bpe, chunkdedup, jaccard, langid, licenses, mips, novelty, packing, runs, tokencounts, toxicity, whitening
from peerscore.llm.common import remainder, table

#: the tokenizer files of the token queries
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.tiktoken"


def _held(mod: int, held: int):
    return F.coalesce(remainder("doc_id", mod) == held, F.lit(True)).alias("held_out")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunkdedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", F.col("_chunks").alias("n_chunks"), F.col("_cut").alias("n_cut"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.learnable(docs), table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2))
    predicted = (F.col("_tox_score") >= toxicity.THRESHOLD).cast("int")
    return toxicity.score(docs, model).select("doc_id", _held(4, 2), F.col("_tox_score").alias("score"), predicted.alias("predicted"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = bpe.read_spec(public_tokenizers.path(WORD_BPE))
    return bpe.encode_documents(table(spark, sf_dir, "documents"), spec).withColumnRenamed("id", "doc_id")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.learnable(docs))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", _held(3, 1), F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score"), F.col("_lang_rejected").alias("rejected"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("spans")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_spec(public_tokenizers.path(BYTE_BPE))
    docs = table(spark, sf_dir, "documents")
    return tokencounts.attribute_tokens(docs, ranks, public_tokenizers.PATTERN).withColumnRenamed("id", "doc_id")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard.link_documents(table(spark, sf_dir, "documents"))
    return linked.select(F.col("node").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "n_links")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = bpe.read_spec(public_tokenizers.path(WORD_BPE))
    return packing.pack(table(spark, sf_dir, "documents"), spec).withColumnRenamed("id", "doc_id")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mips.top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = novelty.scan_documents(docs, novelty.identifier_dictionary(docs))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != novelty.NOVEL)
    return found.select(F.col("id").alias("doc_id"), *(of_kind(k) for k in novelty.KINDS), F.sha2(written(base), 256).alias("base_sha256"), written("spans").alias("spans"))


def planted_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One text in ten ends in words that repeat periodically; where and how follows from the id (not for a NULL id)."""
    h, n = crc32(str(doc_id).encode("ascii")), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(table(spark, sf_dir, "documents"), prepare=planted_words)
    written = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("slow"))))
    best = found.withColumn("best", longest)
    return best.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.slow")).alias("period"), F.expr("1000 * best.length div -best.slow").alias("exponent_milli"),
        F.sha2(written, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_bpe": op3_bpe,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_language_id": op5_language_id,
    "op6_license_scan": op6_license_scan,
    "op7_token_counts": op7_token_counts,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_packing": op9_packing,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_whitening": op11_whitening,
    "op12_secret_scan": op12_secret_scan,
    "op13_periodic_runs": op13_periodic_runs,
}

#: DuckDB SQL of the queries that SQL can express; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op8_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 4
    THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
    WHEN len(w) > 0 THEN ['<' || array_to_string(w, ' ')] ELSE [] END AS s FROM words),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
smallest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, c.component_id, coalesce(d.n_links, 0) AS n_links
FROM sets s JOIN smallest c ON c.a = s.doc_id LEFT JOIN degree d ON d.a = s.doc_id""",
    "op10_exact_top_k": """
WITH usable AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20""",
}
