"""Registered queries over the test tables: name -> (spark, sf_dir) -> DataFrame.

Each query reads whole tables (or the scorecard model that Spark derives from
``lineitem`` and ``part``, FIXTURES.md §3).  Parameters such as the snapshot
date or the upsert cut-off are features of the operator, not row caps.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscore.functions import clean, scoring
from peerscore.operators import assemble, audit, changes, extract, project, ranking, reshape, scaling, upsert
from peerscore.plans import capture, dashboards, incremental, scorecard
from peerscore.schemas import (
    CREDIT,
    CREDIT_BUCKETS,
    GROUP_FEATURE_TABLES,
    GROUP_ID,
    GROUP_KEYS,
    GROWTH,
    PORTFOLIO,
    RISK,
    RISK_ORDINAL_DEFAULT,
    RISK_ORDINALS,
    SNAPSHOT,
    SUBJECT_FEATURE_TABLES,
    SUBJECT_ID,
    SUBJECT_KEYS,
    TABLE_KEYS,
)
from peerscore.session import scratch_path, stored_table
from peerscore.sources import json_arrays, splits
from peerscore.sources import tables as src
from peerscore.sources.demo import testdata_model

# --- fixed values: parameters of the registered queries ---
RANK_DATE = "1998-12-31"
ORDER_DATE = "1998-01-01"
CLOCK = "2024-03-01 06:00:00"
GROUP = 3
TOP_K = 3
LISTING_N = 1000
SCAN_PARTS = 8
JSON_BATCH = 50000
EVENTS_CUTOFF = "2024-01-16 00:00:00"
ORDERS_CUTOFF = "1998-01-01 00:00:00"
REVISED_DATE, REVISION_SOURCE_DATE = "1999-12-31", "2000-12-31"
# display labels of the credit buckets in a captured credit body
CREDIT_LABELS = ["AAA", "A1+", "SOV", "Cash Equivalent", "AA", "A and Below", "Unrated and Others"]
# --- end of fixed values ---


def _model(spark, sf_dir):
    return testdata_model(spark, sf_dir, checkpoint_stats=True)  # lineitem is aggregated once a query


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _wide(spark, sf_dir):
    return assemble.assemble_wide(_model(spark, sf_dir))


# ---------- C1 / C2 and ranking operators ----------

def rank_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scorecard.rank_snapshot(_model(spark, sf_dir), RANK_DATE)


def rank_all_snapshots(spark, sf_dir):
    return scorecard.rank_all_snapshots(_model(spark, sf_dir))


def _positioned(df: DataFrame, *order) -> DataFrame:
    """``df`` with the position of each row in the given order, so that the order can be compared."""
    spec = ranking.RankSpec("__order", "position", False)
    return ranking.add_dense_ranks(df.withColumn("__order", F.struct(*order)), [spec], []).drop("__order")


def rank_snapshot_sorted(spark, sf_dir):
    ranked = _positioned(rank_snapshot(spark, sf_dir), F.col("total_rank"), F.col(SUBJECT_ID))
    return scorecard.rank_snapshot_sorted(ranked)


def top_k_per_group(spark, sf_dir):
    return ranking.top_k_per_group(rank_all_snapshots(spark, sf_dir), "group_rank", TOP_K)


def rerank_stored(spark, sf_dir):
    return scorecard.rerank_stored(rank_all_snapshots(spark, sf_dir))


def _subject(spark, sf_dir):
    return _model(spark, sf_dir)["subject"].select(
        F.col("id").alias(SUBJECT_ID), GROUP_ID, SNAPSHOT, "asset_value", "expense_ratio"
    )


def rank_desc(spark, sf_dir):
    return ranking.rank_desc(_subject(spark, sf_dir), "asset_value", "asset_value_rank", GROUP_KEYS).drop(
        "expense_ratio"
    )


def rank_asc(spark, sf_dir):
    return ranking.rank_asc(_subject(spark, sf_dir), "expense_ratio", "expense_ratio_rank", GROUP_KEYS).drop(
        "asset_value"
    )


def rank_global(spark, sf_dir):
    return ranking.rank_global(_subject(spark, sf_dir).drop("expense_ratio"), "asset_value", "global_rank")


def rank_nulls(spark, sf_dir):
    """Ranks over data with NULL values: the labels of all documents, unlabelled ones included."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    labels = _read(spark, sf_dir, "labels").select("doc_id", F.col("quality") * 2 + F.col("toxic"))
    df = docs.join(labels.toDF("doc_id", "grade"), "doc_id", "left")
    specs = [ranking.RankSpec("grade", "grade_up", False), ranking.RankSpec("grade", "grade_down", True),
             ranking.RankSpec("n_chars", "longest", True)]
    return ranking.add_dense_ranks(df, specs, ["lang"])


def composite_score(spark, sf_dir):
    scored = scorecard.score_terms(assemble.assemble_wide(_model(spark, sf_dir), store_groups=True))
    return scored.select(SUBJECT_ID, GROUP_ID, SNAPSHOT, *scorecard.SCORE_TERMS, "total_rank").withColumn(
        "f_total", F.round("f_total", 6)
    )


# ---------- projections / filters ----------

def snapshot_filter(spark, sf_dir):
    return project.snapshot_filter(_model(spark, sf_dir)["subject"], RANK_DATE).select(
        "id", "name", GROUP_ID, "asset_value", SNAPSHOT
    )


def group_filter(spark, sf_dir):
    return project.group_filter(_model(spark, sf_dir)["subject"], GROUP).select("id", "name", GROUP_ID, SNAPSHOT)


def point_lookup(spark, sf_dir):
    m = _model(spark, sf_dir)
    latest = m["subject"].groupBy(F.col("id").alias(SUBJECT_ID)).agg(F.max(SNAPSHOT).alias(SNAPSHOT))
    return project.point_lookup(m["subject_growth"].drop("modified"), latest, SUBJECT_KEYS)


def prefix_columns(spark, sf_dir):
    return project.prefix_columns(_model(spark, sf_dir)["subject_risk"].drop("modified"), "s_risk_",
                                  keep=SUBJECT_KEYS)


def select_family(spark, sf_dir):
    return project.select_family(_wide(spark, sf_dir), "growth", keep=SUBJECT_KEYS)


def nan_to_zero(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax") / F.col("l_discount"))
        .alias("tax_per_discount"),
    )
    return project.nan_to_zero(li).withColumn("tax_per_discount", F.round("tax_per_discount", 6))


def groups_without_data(spark, sf_dir):
    customers = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    orders = _read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias(GROUP_ID), F.col("o_orderdate").cast("date").alias(SNAPSHOT)
    )
    return project.groups_without_data(customers, orders, ORDER_DATE)


# ---------- joins ----------

def assemble_subject(spark, sf_dir):
    return assemble.assemble_subject(_model(spark, sf_dir))


def assemble_dimension(spark, sf_dir):
    m = _model(spark, sf_dir)
    return assemble.assemble_dimension(assemble.base_frame(m), m["group_dim"])


def assemble_group(spark, sf_dir):
    m = _model(spark, sf_dir)
    return assemble.assemble_group(assemble.base_frame(m), m)


def assemble_wide(spark, sf_dir):
    return _wide(spark, sf_dir)


def coverage_fanout(spark, sf_dir):
    return assemble.coverage_fanout(_model(spark, sf_dir))


def horizon_comparison(spark, sf_dir):
    return dashboards.horizon_comparison(_model(spark, sf_dir), ordered=False, position="position").orderBy("position")


def horizon_snapshot(spark, sf_dir):
    return dashboards.horizon_comparison(_model(spark, sf_dir), snapshot=RANK_DATE, ordered=False)


def unpivot_horizons(spark, sf_dir):
    pairs = dashboards.growth_pairs(_model(spark, sf_dir))
    return reshape.unpivot_pairs(pairs, SUBJECT_KEYS, GROWTH)


def union_all_branches(spark, sf_dir):
    pairs = dashboards.growth_pairs(_model(spark, sf_dir))
    return reshape.union_all_branches(pairs, SUBJECT_KEYS, GROWTH)


def top_k_values(spark, sf_dir):
    """Lines with one of the best prices of their return flag, whole ties included (O3)."""
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return ranking.top_k_values(lines, "l_extendedprice", TOP_K, ["l_returnflag"])


def merge_partials(spark, sf_dir):
    m = _model(spark, sf_dir)
    base = m["subject"].select(F.col("id").alias(SUBJECT_ID), SNAPSHOT, "name")
    parts = {
        "growth": m["subject_growth"].select(SUBJECT_ID, SNAPSHOT, "3m", "1y"),
        "risk": m["subject_risk"].select(SUBJECT_ID, SNAPSHOT, "mean", "alpha"),
    }
    return reshape.merge_partials(base, parts, SUBJECT_KEYS, {"3m": 0.0, "1y": 0.0, "mean": 0.0, "alpha": 0.0})


# ---------- audits and aggregations ----------

def audit_duplicate_keys(spark, sf_dir):
    return audit.audit_duplicate_keys(_read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def audit_orphans(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return audit.audit_orphans(orders, _read(spark, sf_dir, "lineitem"), ["o_orderkey"], ["l_orderkey"])


def audit_null_keys(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id", "lang")
    labelled = docs.join(_read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return audit.audit_null_keys(labelled, ["doc_id", "quality"])


def audit_model(spark, sf_dir):
    """The declared keys over a model that lacks one group of its dimension and repeats another."""
    m = dict(_model(spark, sf_dir))
    dim = m["group_dim"]
    m["group_dim"] = project.group_filter(dim, GROUP, "id").unionByName(dim.where(F.col("id") <= GROUP))
    return audit.audit_model(m)


def audit_null_features(spark, sf_dir):
    wide = _wide(spark, sf_dir)
    cols = [c for c in wide.columns if c.startswith("s_") or c.startswith("g_")]
    return audit.audit_null_features(wide, cols)


def snapshot_counts(spark, sf_dir):
    return audit.snapshot_counts(_model(spark, sf_dir)["subject"], GROUP_KEYS)


def group_min_max(spark, sf_dir):
    m = _model(spark, sf_dir)
    df = m["subject_credit"].join(m["subject"].select(F.col("id").alias(SUBJECT_ID), SNAPSHOT, GROUP_ID),
                                  SUBJECT_KEYS)
    return scaling.group_min_max(df, ["aaa", "sov", "aa"], GROUP_KEYS)


# ---------- scoring functions ----------

def _wide_terms(spark, sf_dir, **cols):
    return _wide(spark, sf_dir).select(SUBJECT_ID, SNAPSHOT, *[v.alias(k) for k, v in cols.items()])


def growth_trend(spark, sf_dir):
    return _wide_terms(spark, sf_dir, trend_growth=scoring.growth_trend(GROWTH.subject_cols, GROWTH.group_cols))


def pct_change_sum(spark, sf_dir):
    pairs = [(GROWTH.subject_col(h), GROWTH.group_col(h)) for h in GROWTH.columns]
    return _wide_terms(spark, sf_dir, growth_pct=scoring.pct_change_sum(pairs))


def credit_trend(spark, sf_dir):
    return _wide_terms(spark, sf_dir, credit_rating_trend=scoring.pct_change_sum(CREDIT.pairs))


def portfolio_trend(spark, sf_dir):
    return _wide_terms(spark, sf_dir, portfolio_agg_trend=scoring.pct_change_sum(PORTFOLIO.pairs))


def min_max_scale(spark, sf_dir):
    df = scaling.min_max_scale_cols(_wide(spark, sf_dir), [CREDIT.subject_col("aaa")], 91.0, 100.0, GROUP_KEYS)
    return df.select(SUBJECT_ID, SNAPSHOT, F.round(f"f_scaled_{CREDIT.subject_col('aaa')}", 6).alias("scaled_aaa"))


def tiered_scale(spark, sf_dir):
    df = scaling.tiered_scale(_wide(spark, sf_dir), scorecard.SCALED_TIERS, GROUP_KEYS)
    return df.select(SUBJECT_ID, SNAPSHOT, *[F.round(c, 6).alias(c) for c in scorecard.SCALED_COLS])


def horizontal_sum(spark, sf_dir):
    df = scaling.tiered_scale(_wide(spark, sf_dir), scorecard.SCALED_TIERS, GROUP_KEYS)
    return df.select(SUBJECT_ID, SNAPSHOT, F.round(scoring.horizontal_sum(scorecard.SCALED_COLS), 6).alias("f_total"))


def ordinal_encode(spark, sf_dir):
    return _model(spark, sf_dir)["subject"].select(
        "id", SNAPSHOT, "risk", scoring.ordinal_encode("risk", RISK_ORDINALS, RISK_ORDINAL_DEFAULT).alias("risk_rank")
    )


# ---------- cleaning functions ----------

def safe_cast(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        clean.safe_cast(F.get_json_object("props", "$.k"), "int").alias("k"),
        clean.safe_cast("event_type", "int").alias("type_as_int"),
        clean.safe_cast(F.col("value").cast("string")).alias("value_text"),
    )


def clean_number(spark, sf_dir):
    s = _model(spark, sf_dir)["subject"]
    return s.select("id", SNAPSHOT, clean.clean_number(F.format_number("asset_value", 0), "long")
                    .alias("asset_value"))


def parse_rating(spark, sf_dir):
    s = _model(spark, sf_dir)["subject"]
    return s.select("id", SNAPSHOT, clean.parse_rating(F.concat(F.col("rating").cast("string"), F.lit(" star")))
                    .alias("rating"))


def url_segment(spark, sf_dir):
    p = _read(spark, sf_dir, "pages")
    return p.select("page_id", clean.url_segment("url", 2).alias("host"), clean.url_segment("url", 3).alias("lang"),
                    clean.url_segment("url", 5).alias("extra"))


def absolute_url(spark, sf_dir):
    links = extract.extract_links(_read(spark, sf_dir, "pages"))
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    return links.join(pages, "page_id").select("page_id", "pos", clean.absolute_url("url", "href").alias("absolute"))


def default_missing(spark, sf_dir):
    docs = _read(spark, sf_dir, "documents").select("doc_id")
    labels = _read(spark, sf_dir, "labels")
    df = docs.join(labels, "doc_id", "left")
    return df.select("doc_id", clean.default_missing("quality", 0).alias("quality"),
                     clean.default_missing("toxic", 0).alias("toxic"))


def normalize_name(spark, sf_dir):
    c = _read(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", clean.normalize_name("text").alias("text"))


def normalize_label(spark, sf_dir):
    s = _read(spark, sf_dir, "part")
    return s.select("p_partkey", clean.normalize_label(F.concat_ws(" ", "p_type", "p_brand", "p_name"))
                    .alias("label"))


def to_json_text(spark, sf_dir):
    c = _model(spark, sf_dir)["subject_credit"]
    held = F.array_compact(F.array(*[F.when(F.col(b) > 0, F.lit(b)) for b in CREDIT_BUCKETS]))
    return c.select(SUBJECT_ID, SNAPSHOT, clean.to_json_text(held).alias("held"))


def compact_array(spark, sf_dir):
    c = _read(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.size(clean.compact_array(F.split("text", "[.]"))).alias("n_sentences"),
                    F.get(clean.compact_array(F.split("text", "[.]")), 0).alias("first_sentence"))


def format_date(spark, sf_dir):
    s = _model(spark, sf_dir)["subject"]
    return s.select("id", clean.format_date(SNAPSHOT, "%d-%m-%Y").alias("day_first"),
                    clean.format_date(SNAPSHOT, "%Y-%m-%d").alias("iso"))


def array_get_default(spark, sf_dir):
    p = _read(spark, sf_dir, "pages")
    return p.select("page_id", clean.array_get_default(F.split("url", "/"), 4, "0").alias("segment_4"),
                    clean.array_get_default(F.split("url", "/"), 6, "0").alias("segment_6"))


def array_head(spark, sf_dir):
    p = _read(spark, sf_dir, "pages")
    hrefs = F.regexp_extract_all("html", F.lit(extract.ANCHOR), 1)
    head = clean.array_head(hrefs, 11)
    return p.select("page_id", F.array_join(head, "\t").alias("first_links"), F.size(head).alias("n_first"))


def listing_limit(spark, sf_dir):
    s = project.snapshot_filter(_model(spark, sf_dir)["subject"], RANK_DATE)
    return s.orderBy(F.col("asset_value").desc(), F.col("id")).limit(LISTING_N).select("id", "asset_value")


# ---------- extraction ----------

def extract_links(spark, sf_dir):
    return extract.extract_links(_read(spark, sf_dir, "pages"))


def credit_captures(model) -> DataFrame:
    """Credit bodies as a site would serve them, built from the model's credit tables (labels with
    a zero value on both sides are left out, so extraction has to default them)."""
    s = model["subject_credit"]
    g = model["group_credit"]
    base = model["subject"].select(F.col("id").alias(SUBJECT_ID), SNAPSHOT, GROUP_ID)
    df = s.join(base, [SUBJECT_ID, SNAPSHOT]).join(
        g.select(GROUP_ID, SNAPSHOT, *[F.col(c).alias(f"g_{c}") for c in CREDIT_BUCKETS]), [GROUP_ID, SNAPSHOT]
    )
    entries = F.array(*[
        F.struct(F.lit(lbl).alias("label"), F.col(c).cast("string").alias("s"), F.col(f"g_{c}").cast("string").alias("g"),
                 ((F.col(c) != 0) | (F.col(f"g_{c}") != 0)).alias("keep"))
        for lbl, c in zip(CREDIT_LABELS, CREDIT_BUCKETS)
    ])
    kept = F.filter(entries, lambda e: e["keep"])
    body = F.to_json(F.struct(
        F.transform(kept, lambda e: e["label"]).alias("categories"),
        F.array(F.struct(F.transform(kept, lambda e: e["s"]).alias("data")),
                F.struct(F.transform(kept, lambda e: e["g"]).alias("data"))).alias("series"),
    ))
    return df.select(F.col(SUBJECT_ID).cast("string").alias(SUBJECT_ID), F.lit("credit").alias("kind"),
                     F.col(SNAPSHOT).alias("captured_on"), body.alias("body"))


def extract_credit(spark, sf_dir):
    out = extract.extract_credit(credit_captures(_model(spark, sf_dir)))
    return out.select(F.col(SUBJECT_ID).cast("long").alias(SUBJECT_ID), F.col("captured_on").alias(SNAPSHOT),
                      *CREDIT.subject_cols, *CREDIT.group_cols)


def _cell(c) -> F.Column:
    """A value as a captured cell: 0 shows as the missing mark, as on the pages."""
    return F.concat(F.lit("<td>"), F.when(F.col(c) == 0, F.lit("--")).otherwise(F.col(c).cast("string")),
                    F.lit("</td>"))


def _row(label: str, cells, blank_after_label: bool = False) -> F.Column:
    parts = [F.lit(f"<tr><td>{label}</td>" + ("<td> </td>" if blank_after_label else ""))]
    return F.concat(*parts, *cells, F.lit("</tr>"))


def _tag(tag: str, attribute: str, value: str) -> F.Column:
    """An opening tag as the pages have it: double quotes, single quotes or none, by subject."""
    forms = [f'<{tag} {attribute}="{value}">', f"<{tag} class=t {attribute} = '{value}'>", f"<{tag} {attribute}={value} >"]
    return F.element_at(F.array(*[F.lit(x) for x in forms]), (F.pmod(F.col(SUBJECT_ID), F.lit(3)) + 1).cast("int"))


NESTED = "<tr><td>Rank</td><td><table><tr><td>7</td></tr></table></td></tr>"


def _two_row_family_captures(model, family, table, kind: str, open_markup, close_markup: str, pad: int):
    """Capture bodies of a two-row (subject row 0, group row 2) table rendered from the model."""
    base = model["subject"].select(F.col("id").alias(SUBJECT_ID), SNAPSHOT, GROUP_ID)
    s = model[f"subject_{table}"].select(SUBJECT_ID, SNAPSHOT, *[F.col(c).alias(f"s_{c}") for c in family.columns])
    g = model[f"group_{table}"].select(GROUP_ID, SNAPSHOT, *[F.col(c).alias(f"g_{c}") for c in family.columns])
    df = s.join(base, [SUBJECT_ID, SNAPSHOT]).join(g, [GROUP_ID, SNAPSHOT])
    filler = [F.lit(f"<td>x{i}</td>") for i in range(pad)]
    html = F.concat(
        open_markup, F.lit("<tbody>"),
        _row("Subject", filler + [_cell(f"s_{c}") for c in family.columns], blank_after_label=True),
        F.lit(NESTED),
        _row("Group", filler + [_cell(f"g_{c}") for c in family.columns]),
        F.lit("</tbody>" + close_markup),
    )
    return df.select(F.col(SUBJECT_ID).cast("string").alias(SUBJECT_ID), F.lit(kind).alias("kind"),
                     F.col(SNAPSHOT).alias("captured_on"), F.to_json(F.struct(html.alias("tab_html"))).alias("body"))


def _family_result(out, family):
    return out.select(F.col(SUBJECT_ID).cast("long").alias(SUBJECT_ID), F.col("captured_on").alias(SNAPSHOT),
                      *family.subject_cols, *family.group_cols)


def extract_returns(spark, sf_dir):
    caps = _two_row_family_captures(_model(spark, sf_dir), GROWTH, "growth", "returns",
                                    _tag("table", "id", extract.RETURNS_TABLE_ID), "</table>",
                                    extract.RETURNS_FIRST_CELL - 1)
    return _family_result(extract.extract_returns(caps), GROWTH)


def extract_risk(spark, sf_dir):
    caps = _two_row_family_captures(_model(spark, sf_dir), RISK, "risk", "risk",
                                    F.concat(_tag("div", "data-x", "1"), F.lit(f"<p class='x {extract.RISK_DIV_CLASS}'>"),
                                             F.lit(f"<div class='x {extract.RISK_DIV_CLASS}'><table>")), "</table></div>",
                                    extract.RISK_FIRST_CELL - 1)
    return _family_result(extract.extract_risk(caps), RISK)


def _portfolio_captures(m) -> DataFrame:
    base = m["subject"].select(F.col("id").alias(SUBJECT_ID), SNAPSHOT, GROUP_ID)
    s = m["subject_portfolio"].select(SUBJECT_ID, SNAPSHOT, *[F.col(c).alias(f"s_{c}") for c in PORTFOLIO.columns])
    g = m["group_portfolio"].select(GROUP_ID, SNAPSHOT, *[F.col(c).alias(f"g_{c}") for c in PORTFOLIO.columns])
    df = s.join(base, [SUBJECT_ID, SNAPSHOT]).join(g, [GROUP_ID, SNAPSHOT])
    rows = [F.concat(F.lit(f"<tr><td>{c}</td>"), _cell(f"s_{c}"), _cell(f"g_{c}"), F.lit("</tr>"))
            for c in PORTFOLIO.columns]
    held = m["subject"].select(F.col("id").alias(SUBJECT_ID), SNAPSHOT, "name", "house")
    df = df.join(held, [SUBJECT_ID, SNAPSHOT])
    more = "".join(f"<tr><td>holding {k}</td><td>{k}</td></tr>" for k in range(3, 14))
    html = F.concat(
        _tag("table", "id", extract.HOLDINGS_TABLE_ID),
        F.lit("<tbody><tr><td> "), F.col("house"), F.lit(" </td><td>1</td></tr><tr><td>"), F.col("name"),
        F.lit(f"</td><td>2</td></tr>{more}</tbody></table>"),
        _tag("div", "id", extract.PORTFOLIO_DIV_ID), F.lit("<table class='a table b'><tbody>"),
        *rows,
        F.lit("</tbody></table></div>"),
    )
    return df.select(F.col(SUBJECT_ID).cast("string").alias(SUBJECT_ID), F.lit("portfolio").alias("kind"),
                     F.col(SNAPSHOT).alias("captured_on"), F.to_json(F.struct(html.alias("tab_html"))).alias("body"))


def extract_portfolio(spark, sf_dir):
    out = extract.extract_portfolio(_portfolio_captures(_model(spark, sf_dir)))
    return out.select(F.col(SUBJECT_ID).cast("long").alias(SUBJECT_ID), F.col("captured_on").alias(SNAPSHOT),
                      *PORTFOLIO.subject_cols, *PORTFOLIO.group_cols, F.array_join("top_holdings", "|").alias("holdings"))


def _basic_captures(m) -> DataFrame:
    s = m["subject"]
    items = F.concat(
        F.lit('<ul class="investment-details-list"><h4>first list</h4></ul>'
              '<ul class="investment-details-list"><h4><a href="/h">'),
        F.col("house"), F.lit("</a></h4><h4>a</h4><h4>b</h4><h4>c</h4><h4>"), F.col("risk"),
        F.lit("</h4><h4>e</h4><h4>f</h4><h4>g</h4><h4> "), F.col("risk_grade"), F.lit(" </h4><h4> "),
        F.col("return_grade"), F.lit(" </h4></ul>"),
    )
    return s.select(F.col("id").cast("string").alias(SUBJECT_ID), F.lit("basic").alias("kind"),
                    F.col(SNAPSHOT).alias("captured_on"), F.to_json(F.struct(items.alias("tab_html"))).alias("body"))


def extract_basic(spark, sf_dir):
    return extract.extract_basic(_basic_captures(_model(spark, sf_dir))).select(
        F.col(SUBJECT_ID).cast("long").alias(SUBJECT_ID), F.col("captured_on").alias(SNAPSHOT),
        "house", "risk", "risk_grade", "return_grade")


LISTING_PAGE_ROWS = 25


def listing_captures(model) -> DataFrame:
    """Paginated listing pages rendered from the model: at most ``LISTING_PAGE_ROWS`` rows per page
    (pages cut by id range), each row in the listing layout the extraction expects."""
    dim = model["group_dim"].select(F.col("id").alias(GROUP_ID), "category", "category_code")
    s = model["subject"].join(dim, GROUP_ID, "left")
    slug = F.regexp_replace(F.lower("name"), " ", "-")
    img = F.when(F.col("rating") > 0, F.concat(F.lit('<img src="r.png" alt="'), F.col("rating").cast("string"),
                                                 F.lit(' star">'))).otherwise(F.lit(""))
    ratio = F.when(F.col("expense_ratio") == 0, F.lit("--")).otherwise(F.col("expense_ratio").cast("string"))
    row = F.concat(
        F.lit("<tr><td><a class=n href='/subjects/"), F.col("id").cast("string"), F.lit("/"), slug, F.lit("'>"),
        F.col("name"), F.lit("</a></td><td>"), img, F.lit("</td><td>x</td><td>y</td>"),
        F.lit('<td><a href="/a/b/c/'), F.col(GROUP_ID).cast("string"), F.lit('" data-original-title="'),
        F.coalesce(F.col("category"), F.lit("")), F.lit('">'), F.coalesce(F.col("category_code"), F.lit("")),
        F.lit("</a></td><td>z</td><td> "), ratio, F.lit(" </td><td>w</td><td>"),
        F.format_number(F.col("asset_value"), 0), F.lit("</td></tr>"),
    )
    pages = s.groupBy(SNAPSHOT, F.expr(f"id div {LISTING_PAGE_ROWS}").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("id"), row.alias("html")))).alias("rows")
    )
    html = F.concat(F.lit("<table><thead><tr><th>Name</th></tr></thead><tbody>"),
                    F.array_join(F.transform("rows", lambda r: r["html"]), ""), F.lit("</tbody></table>"))
    return pages.select(F.lit("").alias(SUBJECT_ID), F.lit("listing").alias("kind"),
                        F.col(SNAPSHOT).alias("captured_on"), F.to_json(F.struct(html.alias("html_data"))).alias("body"),
                        F.col("page").cast("int").alias("page"))


def extract_listing(spark, sf_dir):
    out = extract.extract_listing(listing_captures(_model(spark, sf_dir)))
    return out.select(
        F.col("id").cast("long").alias(SUBJECT_ID), F.col("captured_on").alias(SNAPSHOT), "name", "rating",
        F.col("category_id").cast("int").alias(GROUP_ID), "category", "category_code",
        F.col("asset_value").cast("long").alias("asset_value"), "expense_ratio",
    )


def model_captures(model) -> DataFrame:
    """Every kind of captured body for every subject and snapshot, rendered from the model."""
    parts = [
        listing_captures(model),
        _basic_captures(model),
        _two_row_family_captures(model, GROWTH, "growth", "returns",
                                 _tag("table", "id", extract.RETURNS_TABLE_ID), "</table>",
                                 extract.RETURNS_FIRST_CELL - 1),
        _two_row_family_captures(model, RISK, "risk", "risk", F.lit(f'<div class="{extract.RISK_DIV_CLASS}"><table>'),
                                 "</table></div>", extract.RISK_FIRST_CELL - 1),
        _portfolio_captures(model),
        credit_captures(model),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def listing_head(spark, sf_dir):
    """The first rows of each date's whole listing, over its pages."""
    out = extract.extract_listing(listing_captures(_model(spark, sf_dir)), limit=LISTING_N)
    return out.select(F.col("id").cast("long").alias(SUBJECT_ID), F.col("captured_on").alias(SNAPSHOT))


def table_rows(spark, sf_dir):
    """Cells of every row of the captured returns tables."""
    caps = _two_row_family_captures(_model(spark, sf_dir), GROWTH, "growth", "returns",
                                    _tag("table", "id", extract.RETURNS_TABLE_ID), "</table>",
                                    extract.RETURNS_FIRST_CELL - 1)
    rows = extract.table_rows(extract.table_by_id(extract.markup("body"), extract.RETURNS_TABLE_ID))
    return caps.select(F.col(SUBJECT_ID).cast("long").alias(SUBJECT_ID), F.col("captured_on").alias(SNAPSHOT),
                       F.posexplode(rows).alias("row", "cells")).select(
        SUBJECT_ID, SNAPSHOT, "row", F.size("cells").alias("n_cells"), F.get("cells", 0).alias("label"))


def capture_records(spark, sf_dir):
    rec, _ = capture.capture_records(model_captures(_model(spark, sf_dir)))
    return rec.select(
        F.col("id").alias(SUBJECT_ID), SNAPSHOT, "name", GROUP_ID, "house", "risk",
        GROWTH.subject_col("3m"), GROWTH.group_col("10y"), CREDIT.subject_col("aaa"), CREDIT.group_col("aa"),
        PORTFOLIO.subject_col("num_securities"), RISK.group_col("alpha"), F.size(F.from_json("top_holdings", "array<string>")).alias("n_holdings"),
    )


def keyed_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Every row of every model table: table, key, date and the sum of its values."""
    out = []
    for name, df in tables.items():
        if name not in TABLE_KEYS:
            continue
        key, dated = TABLE_KEYS[name][0], SNAPSHOT if SNAPSHOT in df.columns else "first_seen"
        if name == "subject":
            total = F.col("asset_value") + F.col("rating") + F.length("name")
        elif name == "group_dim":
            total = F.length("category") + F.length("category_code")
        else:
            family = {**SUBJECT_FEATURE_TABLES, **GROUP_FEATURE_TABLES}[name]
            total = reduce(lambda a, b: a + b, [F.col(c) for c in family.columns])
        out.append(df.select(F.lit(name).alias("table"), F.col(key).cast("long").alias("key"), F.col(dated).alias("day"),
                             F.round(total.cast("double"), 3).alias("total")))
    return reduce(DataFrame.unionByName, out)


def capture_to_tables(spark, sf_dir):
    return keyed_rows(capture.capture_to_tables(model_captures(_model(spark, sf_dir))))


def capture_and_store(spark, sf_dir):
    """Two overlapping capture runs into storage, then every stored row."""
    caps = stored_table(model_captures(_model(spark, sf_dir)), ["kind"])
    root, clock = scratch_path(spark, "captured"), _dt.datetime.fromisoformat(CLOCK)
    capture.capture_and_store(spark, caps.where(F.col("captured_on") <= F.lit(RANK_DATE).cast("date")), root, clock=clock)
    tables = capture.capture_and_store(spark, caps.where(F.col("captured_on") >= F.lit(RANK_DATE).cast("date")), root, clock=clock)
    return keyed_rows(tables)


#: kinds of pages that arrive together, details before their listing
ARRIVALS = [("risk", "portfolio"), ("listing", "basic"), ("credit", "returns")]


def capture_partial_batches(spark, sf_dir):
    """The same pages as one batch would bring, in three batches that each lack kinds, then every stored row."""
    caps = stored_table(model_captures(_model(spark, sf_dir)), ["kind"])
    root, clock = scratch_path(spark, "captured"), _dt.datetime.fromisoformat(CLOCK)
    for kinds in ARRIVALS:
        tables = capture.capture_and_store(spark, caps.where(F.col("kind").isin(*kinds)), root, clock=clock)
    return keyed_rows(tables)


def rank_and_store(spark, sf_dir):
    """Two overlapping runs of the job over the stored model, then the stored ranking."""
    model, path = _model(spark, sf_dir), scratch_path(spark, "ranking")
    scorecard.rank_and_store(spark, model, path, None, RANK_DATE)
    return scorecard.rank_and_store(spark, model, path, RANK_DATE, None).drop("modified")


def rank_changes(spark, sf_dir):
    """A ranking that lacks one group's risk features of one date, brought up to date once they arrive."""
    full, path = _model(spark, sf_dir), scratch_path(spark, "ranking-changes")
    of_group = project.group_filter(project.snapshot_filter(full["subject"], RANK_DATE), GROUP)
    late = of_group.select(F.col("id").alias(SUBJECT_ID), SNAPSHOT)
    first = {**full, "subject_risk": full["subject_risk"].join(late, SUBJECT_KEYS, "left_anti")}
    incremental.rank_changes_and_store(spark, first, path)
    return incremental.rank_changes_and_store(spark, full, path, {"subject_risk": late}).drop("modified")


# ---------- upserts and sources ----------

def upsert_changed(spark, sf_dir):
    """All orders but the partial ones are stored; then all urgent ones come again, the open ones with another total.

    Each stored row says whether the second batch changed it."""
    path, keys, year = scratch_path(spark, "orders-changed"), ["o_orderkey", "o_year"], F.year(F.col("o_orderdate").cast("date"))
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", year.alias("o_year"), "o_orderstatus", "o_orderpriority", "o_totalprice")
    changes.upsert_changed(spark, path, orders.where("o_orderstatus <> 'P'"), keys, partition_cols=["o_year"])
    total = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    again = orders.where("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", total)
    hit = changes.upsert_changed(spark, path, again, keys, partition_cols=["o_year"]).select("o_orderkey", F.lit(1).alias("changed"))
    rows = changes.read_bucketed(spark, path, orders).drop(changes.BUCKET).join(hit, "o_orderkey", "left")
    return rows.withColumn("changed", F.coalesce("changed", F.lit(0)))


def merge_extremes(spark, sf_dir):
    """Extremes of lines by supplier and return flag, after first lines got cheaper and lines from the fifth on arrived."""
    keys, cols = ["l_suppkey", "l_returnflag"], ["l_extendedprice", "l_quantity"]
    lines = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *keys, *cols)
    before, late = lines.where("l_linenumber < 5"), lines.where("l_linenumber >= 5")
    removed = before.where("l_linenumber = 1")
    cheaper = removed.withColumn("l_extendedprice", F.col("l_extendedprice") * 0.5)
    current = before.where("l_linenumber > 1").unionByName(cheaper).unionByName(late)
    state = changes.extremes_state(before, cols, keys)
    return changes.merge_extremes(state, cheaper.unionByName(late), removed, current, cols, keys)



def upsert_last_wins(spark, sf_dir):
    ev = _read(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")
    keys = ["user_id", "event_type"]
    before = ev.where(F.col("ts") < F.lit(EVENTS_CUTOFF).cast("timestamp_ntz"))
    batch = ev.where(F.col("ts") >= F.lit(EVENTS_CUTOFF).cast("timestamp_ntz"))
    target = upsert.dedup_last(before, keys, ["ts", "event_id"])
    return upsert.upsert(target, batch, keys, ["ts", "event_id"])


def upsert_dated(spark, sf_dir):
    m = _model(spark, sf_dir)
    g = m["subject_growth"].drop("modified")
    v1 = project.snapshot_filter(g, REVISED_DATE).withColumn("version", F.lit(1))
    v2 = project.snapshot_filter(g, REVISION_SOURCE_DATE).withColumn(SNAPSHOT, F.lit(REVISED_DATE).cast("date")) \
        .withColumn("version", F.lit(2))
    batch = v1.unionByName(v2)
    return upsert.upsert(g, batch, SUBJECT_KEYS, ["version"], partition_cols=[SNAPSHOT])


def upsert_keep_first(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderdate").cast("date").alias("first_seen"),
        F.col("o_orderpriority").alias("last_priority"), F.col("o_totalprice").alias("last_total"),
        F.col("o_orderkey").alias("last_order"), F.col("o_orderdate").alias("ts"),
    )
    cutoff = F.lit(ORDERS_CUTOFF).cast("timestamp_ntz")
    keys, keep, order = ["custkey"], ["first_seen"], ["ts", "last_order"]
    cols = ["custkey", "first_seen", "last_priority", "last_total", "last_order"]
    empty = orders.select(*cols).where(F.lit(False))
    target = upsert.upsert_keep_first(empty, orders.where(F.col("ts") < cutoff), keys, keep, order)
    state = upsert.upsert_keep_first(target, orders.where(F.col("ts") >= cutoff), keys, keep, order)
    cust = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_nationkey")
    nation = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return state.join(cust, "custkey", "left").join(nation, "c_nationkey", "left").drop("c_nationkey")


def fan_out_record(spark, sf_dir):
    wide = _wide(spark, sf_dir).withColumnRenamed(SUBJECT_ID, "id")
    return keyed_rows(upsert.fan_out_record(wide, ["name", GROUP_ID, "asset_value", "rating"], order_by=["id"]))


def save_table(spark, sf_dir):
    """A table written twice and read back."""
    path, customers = scratch_path(spark, "saved"), _read(spark, sf_dir, "customer")
    src.save_table(customers.limit(1), path)
    src.save_table(customers, path)
    return src.scan_table(spark, "customer", path=path, columns=["c_custkey", "c_name", "c_nationkey"])


def with_audit(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return upsert.with_audit(orders, clock=_dt.datetime.fromisoformat(CLOCK)).withColumn("modified", F.col("modified").cast("timestamp_ntz"))


def read_json_array(spark, sf_dir):
    """Suppliers of each nation as one JSON array a file, read back with a declared schema."""
    supplier = _read(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_name")
    rows = F.to_json(F.collect_list(F.struct("s_suppkey", "s_name")))
    path = scratch_path(spark, "arrays")
    supplier.groupBy("s_nationkey").agg(rows.alias("value")).write.partitionBy("s_nationkey").text(path)
    return src.read_json_array(spark, path, T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType())])).select("s_suppkey", "s_name")


def scan_json_array(spark, sf_dir):
    """Orders as JSON arrays of bounded key ranges, each file read by one task a split (S8); customers are nested objects."""
    orders = _read(spark, sf_dir, "orders")
    more = F.struct(F.concat(F.lit('}"{ \\'), "o_orderpriority").alias("mark"))
    row = F.to_json(F.struct("o_orderkey", F.struct("o_custkey", more.alias("more")).alias("customer"), "o_totalprice", "o_orderstatus"))
    text = F.concat(F.lit("["), F.array_join(F.collect_list("row"), ",\n"), F.lit("]"))
    path = scratch_path(spark, "array")
    batches = orders.select(F.expr(f"o_orderkey div {JSON_BATCH}").alias("batch"), row.alias("row")).groupBy("batch").agg(text.alias("value"))
    batches.write.partitionBy("batch").text(path)
    schema = "o_orderkey long, customer struct<o_custkey: long, more: struct<mark: string>>, o_totalprice double, o_orderstatus string"
    back = json_arrays.scan_json_array(spark, path, T.StructType.fromDDL(schema))
    return back.select("o_orderkey", "customer.o_custkey", F.col("customer.more.mark").alias("mark"), "o_totalprice", "o_orderstatus")


def append_json_lines(spark, sf_dir):
    """Events appended in two parts to the run date's folder, read back."""
    events = _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    root, day = scratch_path(spark, "lines"), src.run_snapshot(RANK_DATE)
    src.append_json_lines(events.where("event_type = 'click'"), root, day)
    folder = src.append_json_lines(events.where("event_type <> 'click' or event_type is null"), root, day)
    return spark.read.schema(events.schema).json(folder)


def run_snapshot(spark, sf_dir):
    """Rows of the run date given as text."""
    day = src.run_snapshot(REVISED_DATE)
    return project.snapshot_filter(_model(spark, sf_dir)["subject"], day).select("id", SNAPSHOT, "asset_value")


def scan_equal_depth(spark, sf_dir):
    """Events scanned by equal-depth predicates on the user, hot users split by the event's number."""
    events = _read(spark, sf_dir, "events")
    cuts = splits.equal_depth_predicates(events, "user_id", SCAN_PARTS, tie="event_id")
    return src.scan_table(spark, "events", path=f"{sf_dir}/events.parquet", predicates=cuts, columns=["event_id", "user_id", "event_type"])


def scan_table(spark, sf_dir):
    return src.scan_table(spark, "orders", path=f"{sf_dir}/orders.parquet",
                          columns=["o_orderkey", "o_custkey", "o_totalprice"], where=F.col("o_orderstatus") == "F")


QUERIES = {
    "rank_snapshot": rank_snapshot,
    "rank_all_snapshots": rank_all_snapshots,
    "rank_snapshot_sorted": rank_snapshot_sorted,
    "top_k_per_group": top_k_per_group,
    "top_k_values": top_k_values,
    "rerank_stored": rerank_stored,
    "rank_nulls": rank_nulls,
    "rank_and_store": rank_and_store,
    "rank_changes": rank_changes,
    "rank_desc": rank_desc,
    "rank_asc": rank_asc,
    "rank_global": rank_global,
    "composite_score": composite_score,
    "snapshot_filter": snapshot_filter,
    "group_filter": group_filter,
    "point_lookup": point_lookup,
    "prefix_columns": prefix_columns,
    "select_family": select_family,
    "nan_to_zero": nan_to_zero,
    "groups_without_data": groups_without_data,
    "assemble_subject": assemble_subject,
    "assemble_dimension": assemble_dimension,
    "assemble_group": assemble_group,
    "assemble_wide": assemble_wide,
    "coverage_fanout": coverage_fanout,
    "horizon_comparison": horizon_comparison,
    "horizon_snapshot": horizon_snapshot,
    "unpivot_horizons": unpivot_horizons,
    "union_all_branches": union_all_branches,
    "merge_partials": merge_partials,
    "audit_duplicate_keys": audit_duplicate_keys,
    "audit_orphans": audit_orphans,
    "audit_null_keys": audit_null_keys,
    "audit_model": audit_model,
    "audit_null_features": audit_null_features,
    "snapshot_counts": snapshot_counts,
    "group_min_max": group_min_max,
    "growth_trend": growth_trend,
    "pct_change_sum": pct_change_sum,
    "credit_trend": credit_trend,
    "portfolio_trend": portfolio_trend,
    "min_max_scale": min_max_scale,
    "tiered_scale": tiered_scale,
    "horizontal_sum": horizontal_sum,
    "ordinal_encode": ordinal_encode,
    "safe_cast": safe_cast,
    "clean_number": clean_number,
    "parse_rating": parse_rating,
    "url_segment": url_segment,
    "absolute_url": absolute_url,
    "default_missing": default_missing,
    "normalize_name": normalize_name,
    "normalize_label": normalize_label,
    "to_json_text": to_json_text,
    "compact_array": compact_array,
    "format_date": format_date,
    "array_get_default": array_get_default,
    "array_head": array_head,
    "listing_limit": listing_limit,
    "listing_head": listing_head,
    "table_rows": table_rows,
    "extract_links": extract_links,
    "extract_credit": extract_credit,
    "extract_returns": extract_returns,
    "extract_risk": extract_risk,
    "extract_portfolio": extract_portfolio,
    "extract_basic": extract_basic,
    "extract_listing": extract_listing,
    "capture_records": capture_records,
    "capture_to_tables": capture_to_tables,
    "capture_and_store": capture_and_store,
    "capture_partial_batches": capture_partial_batches,
    "upsert_changed": upsert_changed,
    "merge_extremes": merge_extremes,
    "upsert_last_wins": upsert_last_wins,
    "upsert_dated": upsert_dated,
    "upsert_keep_first": upsert_keep_first,
    "fan_out_record": fan_out_record,
    "scan_table": scan_table,
    "scan_equal_depth": scan_equal_depth,
    "save_table": save_table,
    "with_audit": with_audit,
    "read_json_array": read_json_array,
    "scan_json_array": scan_json_array,
    "append_json_lines": append_json_lines,
    "run_snapshot": run_snapshot,
}
