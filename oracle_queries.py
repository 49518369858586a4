"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code: plain SQL over the pre-registered
TESTDATA views.  Shared pieces (the model CTEs of FIXTURES.md §3) are built
here as text.
"""

from __future__ import annotations

# --- fixed values: declared column names and codes of the test tables ---
HORIZONS = ["3m", "6m", "1y", "3y", "5y", "7y", "10y"]
CREDIT = ["aaa", "a1plus", "sov", "cash_equivalent", "aa", "a_and_below", "unrated_and_others"]
RISK = ["mean", "std_dev", "sharpe", "sortino", "beta", "alpha"]
PORTFOLIO = ["num_securities", "modified_duration", "average_maturity", "ytm", "avg_cr"]
FLAG_PAIRS = [("A", "F"), ("A", "O"), ("N", "F"), ("N", "O"), ("R", "F"), ("R", "O")]
GROUPS = [("ECONOMY", 1), ("LARGE", 2), ("MEDIUM", 3), ("PROMO", 4), ("SMALL", 5), ("STANDARD", 6)]
# --- end of fixed values ---


def q(name: str) -> str:
    return f'"{name}"'


def _avg(s: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN CAST({s} // {n} AS DOUBLE) / CAST(100 AS DOUBLE) ELSE 0.0 END"


def _stats_cols() -> str:
    parts = [
        "count(*) AS n", "sum(pc) AS price_sum", "min(pc) AS price_min", "max(pc) AS price_max",
        "sum(qc) AS qty_sum", "sum(dc) AS disc_sum", "sum(tc) AS tax_sum",
    ]
    for k in range(1, 8):
        parts.append(f"sum(CASE WHEN l_linenumber = {k} THEN pc ELSE 0 END) AS h{k}_sum")
        parts.append(f"sum(CASE WHEN l_linenumber = {k} THEN 1 ELSE 0 END) AS h{k}_n")
    for i, (a, b) in enumerate(FLAG_PAIRS):
        parts.append(f"sum(CASE WHEN l_returnflag = '{a}' AND l_linestatus = '{b}' THEN qc ELSE 0 END) AS q{i}_sum")
    return ",\n    ".join(parts)


def _combine_cols() -> str:
    parts = ["sum(n) AS n", "sum(price_sum) AS price_sum", "min(price_min) AS price_min",
             "max(price_max) AS price_max", "sum(qty_sum) AS qty_sum", "sum(disc_sum) AS disc_sum",
             "sum(tax_sum) AS tax_sum"]
    parts += [f"sum(h{k}_sum) AS h{k}_sum, sum(h{k}_n) AS h{k}_n" for k in range(1, 8)]
    parts += [f"sum(q{i}_sum) AS q{i}_sum" for i in range(len(FLAG_PAIRS))]
    return ", ".join(parts)


def _feature_selects(src: str, key: str) -> dict[str, str]:
    growth = ", ".join(f"{_avg(f'h{k}_sum', f'h{k}_n')} AS {q(h)}" for k, h in enumerate(HORIZONS, 1))
    credit = ", ".join(
        f"CASE WHEN qty_sum > 0 THEN CAST((10000 * q{i}_sum) // qty_sum AS DOUBLE) / CAST(100 AS DOUBLE) "
        f"ELSE 0.0 END AS {CREDIT[i]}" for i in range(6)
    ) + ", 0.0 AS unrated_and_others"
    portfolio = (f"CAST(n AS DOUBLE) AS num_securities, {_avg('qty_sum', 'n')} AS modified_duration, "
                 f"{_avg('disc_sum', 'n')} AS average_maturity, {_avg('tax_sum', 'n')} AS ytm, 0.0 AS avg_cr")
    risk = (f"{_avg('price_sum', 'n')} AS mean, CAST(price_max - price_min AS DOUBLE) / CAST(100 AS DOUBLE) AS std_dev, "
            f"{_avg('disc_sum', 'n')} AS sharpe, {_avg('tax_sum', 'n')} AS sortino, {_avg('qty_sum', 'n')} AS beta, "
            f"CAST(price_max AS DOUBLE) / CAST(100 AS DOUBLE) AS alpha")
    return {
        "growth": f"SELECT {key}, {growth}, snapshot FROM {src}",
        "credit": f"SELECT {key}, {credit}, snapshot FROM {src}",
        "portfolio": f"SELECT {key}, {portfolio}, snapshot FROM {src}",
        "risk": f"SELECT {key}, {risk}, snapshot FROM {src}",
    }


def model_ctes() -> str:
    """WITH-list (without the WITH keyword) defining the eleven model tables."""
    group_case = "CASE p_type " + " ".join(f"WHEN '{t}' THEN {i}" for t, i in GROUPS) + " END"
    subj = _feature_selects("ss", "part AS subject_id")
    grp = _feature_selects("gs", "group_id")
    return f"""
li AS (
  SELECT l_partkey AS part, make_date(CAST(year(l_shipdate) AS INTEGER), 12, 31) AS snapshot,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS pc, CAST(round(l_quantity * 100) AS BIGINT) AS qc,
    CAST(round(l_discount * 100) AS BIGINT) AS dc, CAST(round(l_tax * 100) AS BIGINT) AS tc,
    l_linenumber, l_returnflag, l_linestatus
  FROM lineitem),
st AS (SELECT part, snapshot,
    {_stats_cols()}
  FROM li GROUP BY part, snapshot),
ss AS (SELECT st.*, p_name, p_brand, p_type, p_size, CAST({group_case} AS INTEGER) AS group_id
  FROM st JOIN part ON st.part = part.p_partkey),
gs AS (SELECT group_id, snapshot, {_combine_cols()} FROM ss GROUP BY group_id, snapshot),
m_subject AS (SELECT part AS id, p_name AS name,
    CAST(p_size % 6 AS INTEGER) AS rating, CAST(price_sum // 100 AS BIGINT) AS asset_value, group_id,
    {_avg('disc_sum', 'n')} AS expense_ratio, p_brand AS house,
    CASE p_size % 3 WHEN 0 THEN 'Low' WHEN 1 THEN 'Moderately Low' ELSE 'High' END AS risk,
    snapshot FROM ss),
m_subject_growth AS ({subj['growth']}),
m_subject_credit AS ({subj['credit']}),
m_subject_portfolio AS ({subj['portfolio']}),
m_subject_risk AS ({subj['risk']}),
m_group_dim AS (SELECT g.group_id AS id, upper(substr(p.p_type, 1, 1)) || lower(substr(p.p_type, 2)) AS category,
    substr(p.p_type, 1, 3) AS category_code, min(g.snapshot) AS first_seen
  FROM gs g JOIN (SELECT DISTINCT p_type, CAST({group_case} AS INTEGER) AS group_id FROM part) p
    ON p.group_id = g.group_id
  GROUP BY g.group_id, p.p_type),
m_group_growth AS ({grp['growth']}),
m_group_credit AS ({grp['credit']}),
m_group_portfolio AS ({grp['portfolio']}),
m_group_risk AS ({grp['risk']})"""


BASE = ["s.id AS subject_id", "s.name", "s.rating", "s.asset_value", "s.group_id", "s.expense_ratio",
        "s.risk", "s.snapshot"]
S_FAMS = [("sr", "risk", RISK), ("sg", "growth", HORIZONS), ("sc", "credit", CREDIT), ("sp", "portfolio", PORTFOLIO)]
G_FAMS = [("gg", "growth", HORIZONS), ("gr", "risk", RISK), ("gp", "portfolio", PORTFOLIO), ("gc", "credit", CREDIT)]
S_JOINS = """
  JOIN m_subject_risk sr ON sr.subject_id = s.id AND sr.snapshot = s.snapshot
  JOIN m_subject_growth sg ON sg.subject_id = s.id AND sg.snapshot = s.snapshot
  JOIN m_subject_credit sc ON sc.subject_id = s.id AND sc.snapshot = s.snapshot
  JOIN m_subject_portfolio sp ON sp.subject_id = s.id AND sp.snapshot = s.snapshot"""
D_JOIN = """
  LEFT JOIN m_group_dim d ON d.id = s.group_id"""
G_JOINS = """
  JOIN m_group_growth gg ON gg.group_id = s.group_id AND gg.snapshot = s.snapshot
  JOIN m_group_risk gr ON gr.group_id = s.group_id AND gr.snapshot = s.snapshot
  JOIN m_group_portfolio gp ON gp.group_id = s.group_id AND gp.snapshot = s.snapshot
  JOIN m_group_credit gc ON gc.group_id = s.group_id AND gc.snapshot = s.snapshot"""


def fam_cols(fams, side: str) -> list[str]:
    return [f"{a}.{q(c)} AS {q(side + '_' + fam + '_' + c)}" for a, fam, names in fams for c in names]


def _wide(where: str = "", subject=True, dim=True, group=True) -> str:
    cols = list(BASE)
    joins = ""
    if subject:
        cols += fam_cols(S_FAMS, "s")
        joins += S_JOINS
    if dim:
        cols += ["d.category", "d.category_code"]
        joins += D_JOIN
    if group:
        cols += fam_cols(G_FAMS, "g")
        joins += G_JOINS
    return f"""
wide AS (SELECT {', '.join(cols)}
  FROM m_subject s {joins}
  {where})"""


def _sign(a: str, b: str) -> str:
    return f"CASE WHEN {a} > {b} THEN 1 WHEN {a} < {b} THEN -1 WHEN {a} = {b} THEN 0 END"


def _pct(fam: str, names) -> str:
    terms = []
    for c in names:
        s, g = q(f"s_{fam}_{c}"), q(f"g_{fam}_{c}")
        terms.append(f"CASE WHEN {g} = 0 THEN 0.0 ELSE ({s} - {g}) / {g} * 100.0 END")
    return f"CAST(trunc(round({' + '.join(terms)}, 6)) AS BIGINT)"


def _scaled(c: str, lo: float, hi: float) -> str:
    col = q(f"s_credit_{c}")
    w = "OVER (PARTITION BY group_id, snapshot)"
    mn, mx = f"min({col}) {w}", f"max({col}) {w}"
    return (f"CASE WHEN {mx} - {mn} = 0 THEN {0.5 * (hi - lo) + lo} "
            f"ELSE ({col} - {mn}) / ({mx} - {mn}) * {hi - lo} + {lo} END")


def _rank(col: str, desc: bool) -> str:
    order = "DESC NULLS LAST" if desc else "ASC NULLS FIRST"
    return f"dense_rank() OVER (PARTITION BY group_id, snapshot ORDER BY {col} {order})"


def terms_sql(where: str = "") -> str:
    beats = " + ".join(f"CAST({q('s_growth_' + h)} > {q('g_growth_' + h)} AS INTEGER)" for h in HORIZONS)
    trend = " + ".join(_sign(q("s_growth_" + HORIZONS[i]), q("s_growth_" + HORIZONS[i + 1])) for i in range(6))
    f_total = " + ".join([
        _scaled("aaa", 91.0, 100.0), _scaled("cash_equivalent", 81.0, 90.0), _scaled("sov", 81.0, 90.0),
        _scaled("a1plus", 81.0, 90.0), _scaled("aa", 71.0, 80.0),
    ])
    ranks = {
        "asset_value_rank": _rank("asset_value", True),
        "expense_ratio_rank": _rank("expense_ratio", False),
        "sharpe_ratio_rank": _rank(q("s_risk_sharpe"), True),
        "alpha_rank": _rank(q("s_risk_alpha"), True),
        "beta_rank": _rank(q("s_risk_beta"), False),
        "std_dev_rank": _rank(q("s_risk_std_dev"), False),
        "mean_rank": _rank(q("s_risk_mean"), True),
    }
    return f"""WITH {model_ctes()},
{_wide(where)},
terms AS (SELECT subject_id, name, group_id, rating, snapshot,
    CASE risk WHEN 'Low' THEN 1 WHEN 'Moderately Low' THEN 2 ELSE 3 END AS risk_rank,
    {', '.join(f'{v} AS {k}' for k, v in ranks.items())},
    CAST((7 - ({beats})) + (7 - (0 + {trend})) AS INTEGER) AS trend_growth,
    {_pct('credit', CREDIT)} AS credit_rating_trend,
    {_pct('portfolio', PORTFOLIO)} AS portfolio_agg_trend,
    {f_total} AS f_total
  FROM wide),
scored AS (SELECT *,
    round(risk_rank + asset_value_rank + expense_ratio_rank + sharpe_ratio_rank + alpha_rank + beta_rank
      + std_dev_rank + mean_rank + trend_growth + credit_rating_trend + portfolio_agg_trend + f_total, 6)
      AS total_rank
  FROM terms)"""


def scorecard_sql(where: str = "") -> str:
    return terms_sql(where) + f"""
SELECT subject_id, name, group_id, rating, snapshot, total_rank,
  CAST(round(total_rank) AS BIGINT) AS total_rank_int,
  {_rank('total_rank', True)} AS group_rank
FROM scored"""


def with_model(body: str) -> str:
    return f"WITH {model_ctes()}\n{body}"


def with_wide(body: str, **kw) -> str:
    return f"WITH {model_ctes()},\n{_wide(**kw)}\n{body}"


# --- fixed values: parameters of the registered queries (same as the Spark side) ---
RANK_DATE = "1998-12-31"
ORDER_DATE = "1998-01-01"
CLOCK = "2024-03-01 06:00:00"
GROUP = 3
TOP_K = 3
LISTING_N = 1000
EVENTS_CUTOFF = "2024-01-16 00:00:00"
REVISED_DATE, REVISION_SOURCE_DATE = "1999-12-31", "2000-12-31"
ANCHOR = '(?is)<a\\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
HOLDINGS = "".join(f"|holding {k}" for k in range(3, 12))
# --- end of fixed values ---

H = ", ".join(q(h) for h in HORIZONS)
SCALED = [("aaa", 91.0, 100.0), ("cash_equivalent", 81.0, 90.0), ("sov", 81.0, 90.0), ("a1plus", 81.0, 90.0),
          ("aa", 71.0, 80.0)]


def _links_cte() -> str:
    return f"""links AS (
  SELECT page_id, CAST(unnest(generate_series(0, len(hrefs) - 1)) AS INTEGER) AS pos, unnest(hrefs) AS href,
    trim(regexp_replace(unnest(texts), '<[^>]*>', '', 'g')) AS text
  FROM (SELECT page_id, regexp_extract_all(html, '{ANCHOR}', 1) AS hrefs,
               regexp_extract_all(html, '{ANCHOR}', 2) AS texts FROM pages) t)"""


def _horizon_union() -> str:
    branches = []
    for h in HORIZONS:
        branches.append(f"""SELECT sg.subject_id, sg.snapshot, '{h}' AS horizon, sg.{q(h)} AS subject_value,
    gg.{q(h)} AS group_value
  FROM m_subject_growth sg
  JOIN m_subject s ON s.id = sg.subject_id AND s.snapshot = sg.snapshot
  JOIN m_group_growth gg ON gg.group_id = s.group_id AND gg.snapshot = sg.snapshot""")
    return "\nUNION ALL\n".join(branches)


def _null_counts() -> str:
    cols = [f"s_{fam}_{c}" for _, fam, names in S_FAMS for c in names]
    cols += [f"g_{fam}_{c}" for _, fam, names in G_FAMS for c in names]
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", CAST(count(*) - count({q(c)}) AS BIGINT) AS n_null FROM wide" for c in cols
    )


def _family_oracle(fam: str, names, extra: str = "") -> str:
    s_cols = ", ".join(f"sx.{q(c)} AS {q('s_' + fam + '_' + c)}" for c in names)
    g_cols = ", ".join(f"gx.{q(c)} AS {q('g_' + fam + '_' + c)}" for c in names)
    return f"""SELECT sx.subject_id, sx.snapshot, {s_cols}, {g_cols}{extra}
FROM m_subject_{fam} sx JOIN m_subject s ON s.id = sx.subject_id AND s.snapshot = sx.snapshot
JOIN m_group_{fam} gx ON gx.group_id = s.group_id AND gx.snapshot = sx.snapshot"""


def _keyed_rows(dimension: bool = True) -> str:
    parts = ["SELECT 'subject' AS \"table\", id AS key, snapshot AS day, "
             "round(CAST(asset_value + rating + length(name) AS DOUBLE), 3) AS total FROM m_subject"]
    if dimension:
        parts.append("SELECT 'group_dim', id, first_seen, CAST(length(category) + length(category_code) AS DOUBLE) FROM m_group_dim")
    for side, key, fams in (("subject", "subject_id", S_FAMS), ("group", "group_id", G_FAMS)):
        for _, fam, names in fams:
            total = " + ".join(q(c) for c in names)
            parts.append(f"SELECT '{side}_{fam}', {key}, snapshot, round({total}, 3) FROM m_{side}_{fam}")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT \"table\", CAST(key AS BIGINT) AS key, day, total FROM (\n{body}) k"


def _model_audit() -> str:
    """Violations when the dimension lacks the groups above GROUP and repeats GROUP."""
    dim = f"(SELECT * FROM m_group_dim WHERE id = {GROUP} UNION ALL SELECT * FROM m_group_dim WHERE id <= {GROUP})"
    tables = [("subject", "m_subject", ["id", "snapshot"]), ("group_dim", dim, ["id"])]
    tables += [(f"subject_{f}", f"m_subject_{f}", ["subject_id", "snapshot"]) for _, f, _ in S_FAMS]
    tables += [(f"group_{f}", f"m_group_{f}", ["group_id", "snapshot"]) for _, f, _ in G_FAMS]
    parts = []
    for name, src, keys in tables:
        cols, null = ", ".join(keys), " OR ".join(f"{k} IS NULL" for k in keys)
        parts.append(f"SELECT '{name}' AS \"table\", 'duplicate key' AS rule, count(*) AS violations "
                     f"FROM (SELECT {cols} FROM {src} t GROUP BY {cols} HAVING count(*) > 1) d")
        parts.append(f"SELECT '{name}', 'null key', count(*) FROM {src} t WHERE {null}")
    for _, f, _ in S_FAMS:
        parts.append(f"SELECT 'subject_{f}', 'orphan of subject', count(*) FROM m_subject_{f} c WHERE NOT EXISTS "
                     "(SELECT 1 FROM m_subject p WHERE p.id = c.subject_id AND p.snapshot = c.snapshot)")
    for _, f, _ in G_FAMS:
        parts.append(f"SELECT 'group_{f}', 'orphan of group_dim', count(*) FROM m_group_{f} c "
                     f"WHERE NOT EXISTS (SELECT 1 FROM {dim} p WHERE p.id = c.group_id)")
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    rank_where = f"WHERE s.snapshot = DATE '{RANK_DATE}'"
    s_cols = ", ".join(q(f"s_{fam}_{c}") for _, fam, names in S_FAMS for c in names)
    g_cols = ", ".join(q(f"g_{fam}_{c}") for _, fam, names in G_FAMS for c in names)
    base_cols = "subject_id, name, rating, asset_value, group_id, expense_ratio, risk, snapshot"
    ranking_cols = "subject_id, name, group_id, rating, snapshot, total_rank, total_rank_int"
    scaled_cols = ", ".join(f"round({_scaled(c, lo, hi)}, 6) AS f_scaled_s_credit_{c}" for c, lo, hi in SCALED)
    f_total = " + ".join(_scaled(c, lo, hi) for c, lo, hi in SCALED)
    pct_growth = _pct("growth", HORIZONS)
    held = ", ".join(f"CASE WHEN {c} > 0 THEN '{c}' END" for c in CREDIT)
    strip = "regexp_replace(x, '^[\\s\\x{00a0}]+|[\\s\\x{00a0}]+$', '', 'g')"
    sentences = f"list_filter(list_transform(string_split(text, '.'), lambda x: {strip}), lambda x: x <> '')"
    return {
        "rank_snapshot": scorecard_sql(rank_where),
        "rank_all_snapshots": scorecard_sql(),
        "rank_snapshot_sorted": f"SELECT *, row_number() OVER (ORDER BY total_rank, subject_id) AS position "
                                f"FROM ({scorecard_sql(rank_where)}) r",
        "rank_and_store": scorecard_sql(),
        "rank_changes": scorecard_sql(),
        "upsert_changed": """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS o_year, o_orderstatus, o_orderpriority,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus IN ('O', 'P') THEN 1 ELSE 0 END AS changed
FROM orders WHERE o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT'""",
        "merge_extremes": """WITH l AS (SELECT l_suppkey, l_returnflag, l_quantity,
  CASE WHEN l_linenumber = 1 THEN l_extendedprice * 0.5 ELSE l_extendedprice END AS p FROM lineitem)
SELECT l_suppkey, l_returnflag, count(*) AS n, min(p) AS min_l_extendedprice, max(p) AS max_l_extendedprice,
  min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity FROM l GROUP BY l_suppkey, l_returnflag""",
        "rank_nulls": """SELECT d.doc_id, d.lang, d.n_chars, l.quality * 2 + l.toxic AS grade,
  dense_rank() OVER (PARTITION BY d.lang ORDER BY l.quality * 2 + l.toxic ASC NULLS FIRST) AS grade_up,
  dense_rank() OVER (PARTITION BY d.lang ORDER BY l.quality * 2 + l.toxic DESC NULLS LAST) AS grade_down,
  dense_rank() OVER (PARTITION BY d.lang ORDER BY d.n_chars DESC NULLS LAST) AS longest
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
        "top_k_values": f"""SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem
            QUALIFY dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) <= {TOP_K}""",
        "top_k_per_group": f"SELECT * FROM ({scorecard_sql()}) r WHERE group_rank <= {TOP_K}",
        "rerank_stored": f"""SELECT {ranking_cols},
  dense_rank() OVER (PARTITION BY group_id, snapshot ORDER BY total_rank_int DESC NULLS LAST) AS group_rank
FROM ({scorecard_sql()}) r""",
        "rank_desc": with_model("SELECT id AS subject_id, group_id, snapshot, asset_value, "
                                f"{_rank('asset_value', True)} AS asset_value_rank FROM m_subject"),
        "rank_asc": with_model("SELECT id AS subject_id, group_id, snapshot, expense_ratio, "
                               f"{_rank('expense_ratio', False)} AS expense_ratio_rank FROM m_subject"),
        "rank_global": with_model("SELECT id AS subject_id, group_id, snapshot, asset_value, "
                                  "dense_rank() OVER (ORDER BY asset_value DESC) AS global_rank "
                                  "FROM m_subject"),
        "composite_score": terms_sql() + """
SELECT subject_id, group_id, snapshot, risk_rank, asset_value_rank, expense_ratio_rank, sharpe_ratio_rank,
  alpha_rank, beta_rank, std_dev_rank, mean_rank, trend_growth, credit_rating_trend, portfolio_agg_trend,
  round(f_total, 6) AS f_total, total_rank FROM scored""",
        "snapshot_filter": with_model(f"SELECT id, name, group_id, asset_value, snapshot FROM m_subject "
                                      f"WHERE snapshot = DATE '{RANK_DATE}'"),
        "group_filter": with_model(f"SELECT id, name, group_id, snapshot FROM m_subject WHERE group_id = {GROUP}"),
        "point_lookup": with_model(f"""SELECT subject_id, {H}, snapshot FROM m_subject_growth
WHERE (subject_id, snapshot) IN (SELECT (id, max(snapshot)) FROM m_subject GROUP BY id)"""),
        "prefix_columns": with_model("SELECT subject_id, snapshot, " + ", ".join(
            f"{c} AS s_risk_{c}" for c in RISK) + " FROM m_subject_risk"),
        "select_family": with_wide("SELECT subject_id, snapshot, " + ", ".join(
            q(f"{side}_growth_{h}") for side in ("s", "g") for h in HORIZONS) + " FROM wide"),
        "nan_to_zero": """SELECT l_orderkey, l_linenumber,
  round(CASE WHEN l_discount = 0 THEN 0.0 ELSE l_tax / l_discount END, 6) AS tax_per_discount FROM lineitem""",
        "groups_without_data": f"""SELECT c_custkey AS id, c_name FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND CAST(o.o_orderdate AS DATE) = DATE '{ORDER_DATE}')""",
        "assemble_subject": with_wide(f"SELECT {base_cols}, {s_cols} FROM wide", dim=False, group=False),
        "assemble_dimension": with_wide(f"SELECT {base_cols}, category, category_code FROM wide",
                                        subject=False, group=False),
        "assemble_group": with_wide(f"SELECT {base_cols}, {g_cols} FROM wide", subject=False, dim=False),
        "assemble_wide": with_wide("SELECT * FROM wide"),
        "coverage_fanout": with_model("""SELECT md.id AS subject_id, md.snapshot, count(md.id) AS n_rows
FROM m_subject md
JOIN m_subject_risk mr ON md.id = mr.subject_id AND md.snapshot = mr.snapshot
JOIN m_subject_growth mg ON md.id = mg.subject_id AND md.snapshot = mg.snapshot
JOIN m_subject_credit mcr ON md.id = mcr.subject_id AND md.snapshot = mcr.snapshot
JOIN m_group_dim mcd ON md.group_id = mcd.id
JOIN m_group_growth mcg ON mcd.id = mcg.group_id
JOIN m_group_risk m ON mcd.id = m.group_id
GROUP BY md.id, md.snapshot"""),
        "horizon_comparison": with_model(f"""SELECT *, row_number() OVER (ORDER BY subject_id, snapshot,
  list_position({HORIZONS!r}, horizon)) AS position FROM ({_horizon_union()}) a"""),
        "horizon_snapshot": with_model(f"SELECT * FROM ({_horizon_union()}) a WHERE snapshot = DATE '{RANK_DATE}'"),
        "unpivot_horizons": with_model(f"SELECT * FROM ({_horizon_union()}) a"),
        "union_all_branches": with_model(f"SELECT * FROM ({_horizon_union()}) a"),
        "merge_partials": with_model("""SELECT s.id AS subject_id, s.snapshot, s.name,
  coalesce(g."3m", 0.0) AS "3m", coalesce(g."1y", 0.0) AS "1y", coalesce(r.mean, 0.0) AS mean,
  coalesce(r.alpha, 0.0) AS alpha
FROM m_subject s
LEFT JOIN m_subject_growth g ON g.subject_id = s.id AND g.snapshot = s.snapshot
LEFT JOIN m_subject_risk r ON r.subject_id = s.id AND r.snapshot = s.snapshot"""),
        "audit_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "audit_orphans": """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""",
        "audit_null_keys": """SELECT d.doc_id, d.lang, l.quality FROM documents d
LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE d.doc_id IS NULL OR l.quality IS NULL""",
        "audit_model": with_model(_model_audit()),
        "audit_null_features": with_wide(_null_counts()),
        "snapshot_counts": with_model("SELECT group_id, snapshot, count(*) AS n FROM m_subject GROUP BY group_id, snapshot"),
        "group_min_max": with_model("""SELECT s.group_id, c.snapshot, min(c.aaa) AS min_aaa, max(c.aaa) AS max_aaa,
  min(c.sov) AS min_sov, max(c.sov) AS max_sov, min(c.aa) AS min_aa, max(c.aa) AS max_aa
FROM m_subject_credit c JOIN m_subject s ON s.id = c.subject_id AND s.snapshot = c.snapshot
GROUP BY s.group_id, c.snapshot"""),
        "growth_trend": terms_sql() + "\nSELECT subject_id, snapshot, trend_growth FROM terms",
        "pct_change_sum": with_wide(f"SELECT subject_id, snapshot, {pct_growth} AS growth_pct FROM wide"),
        "credit_trend": terms_sql() + "\nSELECT subject_id, snapshot, credit_rating_trend FROM terms",
        "portfolio_trend": terms_sql() + "\nSELECT subject_id, snapshot, portfolio_agg_trend FROM terms",
        "min_max_scale": with_wide(f"SELECT subject_id, snapshot, round({_scaled('aaa', 91.0, 100.0)}, 6) AS scaled_aaa "
                                   "FROM wide"),
        "tiered_scale": with_wide(f"SELECT subject_id, snapshot, {scaled_cols} FROM wide"),
        "horizontal_sum": with_wide(f"SELECT subject_id, snapshot, round({f_total}, 6) AS f_total FROM wide"),
        "ordinal_encode": with_model("""SELECT id, snapshot, risk,
  CASE risk WHEN 'Low' THEN 1 WHEN 'Moderately Low' THEN 2 ELSE 3 END AS risk_rank FROM m_subject"""),
        "safe_cast": """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k,
  coalesce(TRY_CAST(event_type AS INTEGER), 0) AS type_as_int, value AS value_text FROM events""",
        "clean_number": with_model("SELECT id, snapshot, asset_value FROM m_subject"),
        "parse_rating": with_model("SELECT id, snapshot, rating FROM m_subject"),
        "url_segment": """SELECT page_id, string_split(url, '/')[3] AS host, string_split(url, '/')[4] AS lang,
  string_split(url, '/')[6] AS extra FROM pages""",
        "absolute_url": f"""WITH {_links_cte()}
SELECT l.page_id, l.pos, regexp_extract(p.url, '^([^:/?#]+)://', 1) || '://'
  || regexp_extract(p.url, '^[^:/?#]+://([^/?#]*)', 1) || l.href AS absolute
FROM links l JOIN pages p ON p.page_id = l.page_id""",
        "default_missing": """SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, 0) AS toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
        "normalize_name": """SELECT conv_id, turn, trim(regexp_replace(text, '[^0-9a-zA-Z]+', ' ', 'g')) AS text
FROM conversations""",
        "normalize_label": """SELECT p_partkey, lower(replace(replace(replace(concat_ws(' ', p_type, p_brand, p_name),
  '+', 'plus'), '/', 'and'), ' ', '_')) AS label FROM part""",
        "to_json_text": with_model(f"""SELECT subject_id, snapshot,
  CAST(to_json(list_filter([{held}], lambda x: x IS NOT NULL)) AS VARCHAR) AS held FROM m_subject_credit"""),
        "compact_array": f"""SELECT conv_id, turn, CAST(len({sentences}) AS INTEGER) AS n_sentences,
  {sentences}[1] AS first_sentence FROM conversations""",
        "format_date": with_model("""SELECT id, strftime(snapshot, '%d-%m-%Y') AS day_first,
  strftime(snapshot, '%Y-%m-%d') AS iso FROM m_subject"""),
        "array_get_default": """SELECT page_id, coalesce(string_split(url, '/')[5], '0') AS segment_4,
  coalesce(string_split(url, '/')[7], '0') AS segment_6 FROM pages""",
        "array_head": f"""SELECT page_id, array_to_string(list_slice(regexp_extract_all(html, '{ANCHOR}', 1), 1, 11),
  chr(9)) AS first_links, CAST(len(list_slice(regexp_extract_all(html, '{ANCHOR}', 1), 1, 11)) AS INTEGER) AS n_first
FROM pages""",
        "listing_limit": with_model(f"""SELECT id, asset_value FROM m_subject WHERE snapshot = DATE '{RANK_DATE}'
ORDER BY asset_value DESC, id LIMIT {LISTING_N}"""),
        "extract_links": f"""WITH {_links_cte()}
SELECT page_id, pos, href, text, string_split(href, '/')[2] AS segment_1, string_split(href, '/')[3] AS segment_2
FROM links""",
        "extract_credit": with_model("SELECT sc.subject_id, sc.snapshot, " + ", ".join(
            f"sc.{c} AS s_credit_{c}" for c in CREDIT) + ", " + ", ".join(
            f"gc.{c} AS g_credit_{c}" for c in CREDIT) + """
FROM m_subject_credit sc JOIN m_subject s ON s.id = sc.subject_id AND s.snapshot = sc.snapshot
JOIN m_group_credit gc ON gc.group_id = s.group_id AND gc.snapshot = sc.snapshot"""),
        "extract_returns": with_model(_family_oracle("growth", HORIZONS)),
        "extract_risk": with_model(_family_oracle("risk", RISK)),
        "extract_portfolio": with_model(_family_oracle("portfolio", PORTFOLIO, extra=f", s.house || '|' || s.name || '{HOLDINGS}' AS holdings")),
        "extract_basic": with_model("""SELECT id AS subject_id, snapshot,
  trim(regexp_replace(house, '[^0-9a-zA-Z]+', ' ', 'g')) AS house, risk, 'Average' AS risk_grade,
  'Average' AS return_grade FROM m_subject"""),
        "extract_listing": with_model("""SELECT s.id AS subject_id, s.snapshot, s.name, s.rating, s.group_id,
  d.category, d.category_code, s.asset_value, s.expense_ratio
FROM m_subject s LEFT JOIN m_group_dim d ON d.id = s.group_id"""),
        "capture_records": with_model("""SELECT s.id AS subject_id, s.snapshot, s.name, s.group_id,
  trim(regexp_replace(s.house, '[^0-9a-zA-Z]+', ' ', 'g')) AS house, s.risk,
  sg."3m" AS s_growth_3m, gg."10y" AS g_growth_10y, sc.aaa AS s_credit_aaa, gc.aa AS g_credit_aa,
  sp.num_securities AS s_portfolio_num_securities, gr.alpha AS g_risk_alpha, 11 AS n_holdings
FROM m_subject s
JOIN m_subject_growth sg ON sg.subject_id = s.id AND sg.snapshot = s.snapshot
JOIN m_subject_credit sc ON sc.subject_id = s.id AND sc.snapshot = s.snapshot
JOIN m_subject_portfolio sp ON sp.subject_id = s.id AND sp.snapshot = s.snapshot
JOIN m_group_growth gg ON gg.group_id = s.group_id AND gg.snapshot = s.snapshot
JOIN m_group_credit gc ON gc.group_id = s.group_id AND gc.snapshot = s.snapshot
JOIN m_group_risk gr ON gr.group_id = s.group_id AND gr.snapshot = s.snapshot"""),
        "capture_to_tables": with_model(_keyed_rows()),
        "capture_and_store": with_model(_keyed_rows()),
        "capture_partial_batches": with_model(_keyed_rows()),
        "listing_head": with_model(f"""SELECT id AS subject_id, snapshot FROM m_subject
QUALIFY row_number() OVER (PARTITION BY snapshot ORDER BY id) <= {LISTING_N}"""),
        "table_rows": with_model("""SELECT s.id AS subject_id, s.snapshot, CAST(r.row AS INTEGER) AS row,
  CAST(r.n_cells AS INTEGER) AS n_cells, r.label
FROM m_subject s, (VALUES (0, 11, 'Subject'), (1, 1, 'Rank'), (2, 11, 'Group')) r(row, n_cells, label)"""),
        "upsert_last_wins": """SELECT user_id, event_type, ts, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
        "upsert_dated": with_model(f""",
v2 AS (SELECT subject_id, {H}, DATE '{REVISED_DATE}' AS snapshot FROM m_subject_growth
       WHERE snapshot = DATE '{REVISION_SOURCE_DATE}')
SELECT * FROM v2
UNION ALL
SELECT subject_id, {H}, snapshot FROM m_subject_growth
WHERE snapshot = DATE '{REVISED_DATE}' AND subject_id NOT IN (SELECT subject_id FROM v2)""").replace("\n,\nv2", ",\nv2"),
        "upsert_keep_first": """WITH firsts AS (SELECT o_custkey AS custkey, min(CAST(o_orderdate AS DATE)) AS first_seen
  FROM orders GROUP BY o_custkey),
lasts AS (SELECT o_custkey AS custkey, o_orderpriority AS last_priority, o_totalprice AS last_total,
  o_orderkey AS last_order FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT f.custkey, f.first_seen, l.last_priority, l.last_total, l.last_order, c.c_name, n.n_name
FROM firsts f JOIN lasts l ON l.custkey = f.custkey
LEFT JOIN customer c ON c.c_custkey = f.custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
        "fan_out_record": with_model(_keyed_rows(dimension=False)),
        "save_table": "SELECT c_custkey, c_name, c_nationkey FROM customer",
        "with_audit": f"""SELECT o_orderkey, o_custkey, CAST(TIMESTAMP '{CLOCK}' AS DATE) AS snapshot,
  TIMESTAMP '{CLOCK}' AS modified FROM orders""",
        "read_json_array": "SELECT s_suppkey, s_name FROM supplier",
        "scan_json_array": """SELECT o_orderkey, o_custkey, '}"{ \\' || o_orderpriority AS mark, o_totalprice, o_orderstatus FROM orders""",
        "scan_equal_depth": "SELECT event_id, user_id, event_type FROM events",
        "append_json_lines": "SELECT event_id, user_id, event_type FROM events",
        "run_snapshot": with_model(f"SELECT id, snapshot, asset_value FROM m_subject WHERE snapshot = DATE '{REVISED_DATE}'"),
        "scan_table": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
    }
