"""Turn captured responses into model rows (X1-X9) with regex and JSON expressions.

Input is a DataFrame of captures ``(subject_id, kind, captured_on, body)``;
``body`` is JSON whose ``html_data`` / ``tab_html`` field holds markup, or for
``credit`` ``{categories: [...], series: [{data: [...]}, {data: [...]}]}``.
Every job is a column expression evaluated on the executors (no Python, no
per-page parser object), so pages are processed where they are stored.
Rows that cannot be read carry a ``reason``; ``split_rejects`` separates them.

The markup patterns are regular expressions over well-formed tables; they do
not claim to parse arbitrary HTML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peerscore.functions.clean import (
    WHOLE_NUMBER,
    array_get_default,
    array_head,
    clean_number,
    compact_array,
    normalize_label,
    normalize_name,
    out_of_range,
    parse_rating,
    safe_cast,
    strip_text,
    url_segment,
)
from peerscore.schemas import CREDIT, GROWTH, PORTFOLIO, RISK

# --- fixed values: markup landmarks of the captured pages ---
RETURNS_TABLE_ID = "return_over_time_table"
HOLDINGS_TABLE_ID = "company-holding_table_debt"
PORTFOLIO_DIV_ID = "portfolioEquityTab"
RISK_DIV_CLASS = "risk-table-view"
DETAILS_LIST_CLASS = "investment-details-list"
HOLDINGS_KEPT = 11
# cell positions: trailing returns 4..10, risk measures 1..6; subject row 0, group row 2
RETURNS_FIRST_CELL = 4
RISK_FIRST_CELL = 1
SUBJECT_ROW, GROUP_ROW = 0, 2
# basic details: positions of the h4 items in the second details list
HOUSE_ITEM, RISK_ITEM, RISK_GRADE_ITEM, RETURN_GRADE_ITEM = 0, 4, 8, 9
# listing cells: name/link 0, rating 1, category 4, expense ratio 6, asset value 8
LISTING_NAME, LISTING_RATING, LISTING_CATEGORY, LISTING_EXPENSE, LISTING_ASSETS = 0, 1, 4, 6, 8
# --- end of fixed values ---



def _until(stop: str) -> str:
    """Text up to the first tag whose name fits ``stop``, in runs between tags instead of character by character."""
    return f"[^<]*(?:<(?!{stop})[^<]*)*+"


TR = f"(?is)<tr[^>]*>({_until('/tr>')})</tr>"
TD = f"(?is)<td[^>]*>({_until('/td>')})</td>"
TBODY = f"(?is)<tbody[^>]*>({_until('/tbody>')})</tbody>"
TAG = "<[^>]*>"
# an attribute's value in double quotes, single quotes or none: three groups, of which one matches
VALUE = "\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s\"'>]+))"
ANCHOR = f"(?is)<a\\s[^>]*?\\bhref{VALUE}[^>]*>(.*?)</a>"
# the same in one group, which the kind of quote before it decides
ONE_VALUE = "\\s*=\\s*(?:\"(?=[^\"]*\")|'(?=[^']*')|(?=[^\\s\"'>]))((?<=\")[^\"]*|(?<=')[^']*|(?<=[=\\s])[^\\s\"'>]+)"
INNERMOST_TABLE = f"(?is)<table\\b{_until('table\\b|/table\\s*>')}</table\\s*>"
# content of a table whose nested tables have no tables in them
SHALLOW_TABLE = f"(?is)^([^<]*(?:(?:{INNERMOST_TABLE[5:]}|<(?!table\\b|/table\\s*>))[^<]*)*+)</table\\s*>"


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use`` names it.

    A column expression is copied to each place that names it; the variable of a lambda is not.
    """
    return F.get(F.transform(F.array(value), use), 0)


def markup(body: Column | str) -> Column:
    """The markup field of a captured JSON body."""
    b = F.col(body) if isinstance(body, str) else body
    return F.coalesce(F.get_json_object(b, "$.html_data"), F.get_json_object(b, "$.tab_html"))


def unescape(x: Column) -> Column:
    for ent, ch in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    return x


def inner_text(x: Column) -> Column:
    """Text of a markup fragment: tags removed, entities decoded (not trimmed)."""
    return once(x, _plain)


def _plain(x: Column) -> Column:
    bare = F.regexp_replace(x, TAG, "")
    return F.when(F.contains(x, F.lit("&")), unescape(bare)).when(F.contains(x, F.lit("<")), bare).otherwise(x)


def _extract(html: Column, pattern: str, idx: int = 1) -> Column:
    return F.regexp_extract(html, pattern, idx)


def _extract_all(html: Column, pattern: str, idx: int = 1) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), idx)


def attribute(fragment: Column, tag: str, name: str) -> Column:
    """Value of attribute ``name`` of the first ``tag`` that has it, however quoted; '' without one."""
    return _extract(fragment, f"(?is)<{tag}\\s[^>]*?\\b{name}{ONE_VALUE}")


def _having(name: str, value: str) -> str:
    return f"""[^>]*\\b{name}\\s*=\\s*(?:"{value}"|'{value}'|{value}(?=[\\s>]))[^>]*"""


def _with_class(name: str) -> str:
    quoted = lambda q: f"{q}(?:[^{q}]*\\s)?{name}(?:\\s[^{q}]*)?{q}"
    return f"""[^>]*\\bclass\\s*=\\s*(?:{quoted('"')}|{quoted("'")}|{name}(?=[\\s>]))[^>]*"""


def balanced_table(rest: Column) -> Column:
    """Up to the ``</table>`` that closes the table whose content starts at ``rest``, nested tables included."""
    def step(at: Column, part: Column) -> Column:
        n, opened = at["n"] + 1, at["opened"] + F.regexp_count(part, F.lit("(?i)<table\\b"))
        # the n-th close ends the table once every nested table before it is closed
        end = F.when((at["end"] == 0) & (opened == n - 1), n).otherwise(at["end"])
        return F.struct(n.alias("n"), opened.alias("opened"), end.alias("end"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("opened"), F.lit(0).alias("end"))
    content = lambda parts: F.array_join(F.slice(parts, 1, F.aggregate(parts, start, step, lambda at: at["end"])), "</table>")
    deep = lambda html: once(F.split(html, "(?i)</table\\s*>"), content)
    shallow = lambda html: _extract(html, SHALLOW_TABLE)
    return F.coalesce(once(rest, lambda html: once(shallow(html), lambda t: F.when(t != "", t).otherwise(deep(html)))), F.lit(""))


def table_where(html: Column, condition: str) -> Column:
    """Content of the first table whose opening tag fits ``condition``; '' without one."""
    return balanced_table(_extract(html, f"(?is)<table{condition}>(.*)"))


def table_by_id(html: Column, table_id: str) -> Column:
    return table_where(html, _having("id", table_id))


def tbody(table_html: Column) -> Column:
    """The rows of a table's body; tables nested in its cells are dropped, to two levels."""
    for _ in range(2):
        table_html = F.regexp_replace(table_html, INNERMOST_TABLE, " ")
    body = lambda html: _extract(html, TBODY)
    return once(table_html, lambda html: once(body(html), lambda b: F.when(b == "", html).otherwise(b)))


def row_cells(table_html: Column) -> Column:
    """array<array<string>>: for each row the raw ``<td>`` fragments (X1, uncompacted)."""
    return F.transform(_extract_all(tbody(table_html), TR), lambda r: F.regexp_extract_all(r, F.lit(TD), 1))


def table_rows(table_html: Column) -> Column:
    """array<array<string>>: for each row the trimmed non-empty cell texts.

    As in the captured tables, a blank cell is dropped, so the cells after it shift left.
    """
    return F.transform(row_cells(table_html), lambda cells: compact_array(F.transform(cells, _plain)))


def _cells(rows: Column, row: int, first: int, n: int, cast: str = "double") -> list[Column]:
    r = F.get(rows, row)
    return [safe_cast(array_get_default(r, first + i), cast) for i in range(n)]


def _reason(ok: Column, why: str) -> Column:
    return F.when(~ok, F.lit(why))


def extract_links(pages: DataFrame, html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """Every ``<a href>`` of every page: position, href, anchor text, path segments."""
    quoted, single, bare = (_extract_all(F.col(html_col), ANCHOR, g) for g in (1, 2, 3))
    joined = lambda a, b: F.concat(a, b)
    hrefs = F.zip_with(F.zip_with(quoted, single, joined), bare, joined)
    texts = _extract_all(F.col(html_col), ANCHOR, 4)
    return (
        pages.select(id_col, F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text"))))
        .select(
            id_col,
            F.col("pos").cast("int").alias("pos"),
            F.col("col.href").alias("href"),
            F.trim(F.regexp_replace(F.col("col.text"), TAG, "")).alias("text"),
        )
        .withColumns({"segment_1": url_segment("href", 1), "segment_2": url_segment("href", 2)})
    )


def extract_listing(captures: DataFrame, limit: int | None = None) -> DataFrame:
    """Listing rows -> base columns (X3); ``limit`` keeps the first rows of each date's whole listing.

    Pages follow each other by the column ``page`` (without one, a date's listing is one page).
    """
    page = F.col("page") if "page" in captures.columns else F.lit(0)
    first_table = lambda html: balanced_table(_extract(html, "(?is)<table[^>]*>(.*)"))
    table = once(markup("body"), lambda html: once(first_table(html), lambda t: F.when(t == "", html).otherwise(t)))
    lst = captures.where(F.col("kind") == "listing").select(
        "captured_on", page.alias("page"),
        F.posexplode(row_cells(table)).alias("position", "cells")
    )
    if limit is not None:
        w = Window.partitionBy("captured_on").orderBy("page", "position")
        lst = lst.withColumn("__at", F.row_number().over(w)).where(F.col("__at") <= limit).drop("__at")
    cell = lambda i: F.get(F.col("cells"), i)
    name_a = _extract(cell(LISTING_NAME), "(?is)<a\\s[^>]*>(.*?)</a>", 1)
    link = attribute(cell(LISTING_NAME), "a", "href")
    cat_href = attribute(cell(LISTING_CATEGORY), "a", "href")
    alt = attribute(cell(LISTING_RATING), "img", "alt")
    assets = strip_text(inner_text(F.coalesce(cell(LISTING_ASSETS), F.lit(""))))
    out = lst.select(
        "captured_on",
        F.col("page"),
        F.col("position").cast("int").alias("position"),
        url_segment(link, 2).alias("id"),
        inner_text(name_a).alias("name"),
        link.alias("link"),
        F.when(alt == "", F.lit(0)).otherwise(parse_rating(alt)).alias("rating"),
        url_segment(cat_href, 4).alias("category_id"),
        attribute(cell(LISTING_CATEGORY), "[a-z0-9]+", "data-original-title").alias("category"),
        inner_text(_extract(cell(LISTING_CATEGORY), "(?is)<a\\s[^>]*>(.*?)</a>", 1)).alias("category_code"),
        clean_number(assets, "bigint").alias("asset_value"),
        safe_cast(strip_text(inner_text(F.coalesce(cell(LISTING_EXPENSE), F.lit(""))))).alias("expense_ratio"),
        F.size("cells").alias("n_cells"),
        out_of_range(assets, "bigint").alias("too_large"),
    )
    readable = (F.col("n_cells") > LISTING_ASSETS) & (F.col("link") != "")
    reason = (
        F.when(~readable, F.lit("listing row too short or without link"))
        .when(~F.coalesce(F.col("id").rlike(WHOLE_NUMBER), F.lit(False)), F.lit("link without a subject number"))
        .when(F.col("too_large"), F.lit("asset value out of range"))
    )
    return out.withColumn("reason", reason).drop("n_cells", "too_large")


def extract_basic(captures: DataFrame) -> DataFrame:
    """House, risk, risk grade and return grade from the second details list."""
    lists = _extract_all(markup("body"), f"(?is)<ul{_with_class(DETAILS_LIST_CLASS)}>(.*?)</ul>", 1)
    items = _extract_all(F.coalesce(F.get(lists, 1), F.lit("")), "(?is)<h4[^>]*>(.*?)</h4>", 1)
    df = captures.where(F.col("kind") == "basic").select("subject_id", "captured_on", items.alias("items"))
    item = lambda i: F.get(F.col("items"), i)
    house = _extract(F.coalesce(item(HOUSE_ITEM), F.lit("")), "(?is)<a[^>]*>(.*?)</a>", 1)
    return df.select(
        "subject_id",
        "captured_on",
        normalize_name(inner_text(house)).alias("house"),
        inner_text(item(RISK_ITEM)).alias("risk"),
        strip_text(inner_text(item(RISK_GRADE_ITEM))).alias("risk_grade"),
        strip_text(inner_text(item(RETURN_GRADE_ITEM))).alias("return_grade"),
        _reason(F.size("items") > RETURN_GRADE_ITEM, "details list missing or short").alias("reason"),
    )


def _two_row_family(captures: DataFrame, kind: str, table: Column, family, first_cell: int) -> DataFrame:
    rows = table_rows(table)
    n = len(family.columns)
    df = captures.where(F.col("kind") == kind).select("subject_id", "captured_on", rows.alias("rows"))
    s = _cells(F.col("rows"), SUBJECT_ROW, first_cell, n)
    g = _cells(F.col("rows"), GROUP_ROW, first_cell, n)
    ok = (F.size("rows") > GROUP_ROW) & (F.size(F.get(F.col("rows"), SUBJECT_ROW)) >= first_cell + n) & (
        F.size(F.get(F.col("rows"), GROUP_ROW)) >= first_cell + n
    )
    return df.select(
        "subject_id",
        "captured_on",
        *[v.alias(family.subject_col(c)) for v, c in zip(s, family.columns)],
        *[v.alias(family.group_col(c)) for v, c in zip(g, family.columns)],
        _reason(F.coalesce(ok, F.lit(False)), f"{kind} table missing or short").alias("reason"),
    )


def extract_returns(captures: DataFrame) -> DataFrame:
    """Trailing returns: row 0 subject, row 2 group, cells 4..10 after blank cells are dropped."""
    return _two_row_family(captures, "returns", table_by_id(markup("body"), RETURNS_TABLE_ID), GROWTH,
                           RETURNS_FIRST_CELL)


def extract_risk(captures: DataFrame) -> DataFrame:
    """Risk measures: row 0 subject, row 2 group, cells 1..6."""
    div = _extract(markup("body"), f"(?is)<div{_with_class(RISK_DIV_CLASS)}>(.*)")
    table = table_where(div, "[^>]*")
    return _two_row_family(captures, "risk", table, RISK, RISK_FIRST_CELL)


def extract_portfolio(captures: DataFrame) -> DataFrame:
    """Top holdings (first 11 first-cell texts) and five aggregates, subject cell 1, group cell 2."""
    html = F.col("html")
    holdings_rows = row_cells(table_by_id(html, HOLDINGS_TABLE_ID))
    holdings = array_head(
        F.transform(F.filter(holdings_rows, lambda r: F.size(r) > 0), lambda r: strip_text(inner_text(F.get(r, 0)))),
        HOLDINGS_KEPT,
    )
    div = _extract(html, f"(?is)<div{_having('id', PORTFOLIO_DIV_ID)}>(.*)")
    table = table_where(div, _with_class("table"))
    rows = table_rows(table)
    pages = captures.where(F.col("kind") == "portfolio").select("subject_id", "captured_on", markup("body").alias("html"))
    df = pages.select(
        "subject_id", "captured_on", holdings.alias("top_holdings"), rows.alias("rows")
    )
    s, g = [], []
    for i, c in enumerate(PORTFOLIO.columns):
        r = F.get(F.col("rows"), i)
        s.append(safe_cast(array_get_default(r, 1)).alias(PORTFOLIO.subject_col(c)))
        g.append(safe_cast(array_get_default(r, 2)).alias(PORTFOLIO.group_col(c)))
    return df.select(
        "subject_id", "captured_on", "top_holdings", *s, *g,
        _reason(F.size("rows") >= len(PORTFOLIO.columns), "portfolio table missing or short").alias("reason"),
    )


CREDIT_BODY_SCHEMA = T.StructType([
    T.StructField("categories", T.ArrayType(T.StringType())),
    T.StructField("series", T.ArrayType(T.StructType([T.StructField("data", T.ArrayType(T.StringType()))]))),
])


def extract_credit(captures: DataFrame) -> DataFrame:
    """Credit JSON -> seven subject and seven group buckets; a missing label is 0."""
    parsed = F.from_json(F.col("body"), CREDIT_BODY_SCHEMA)
    df = captures.where(F.col("kind") == "credit").select("subject_id", "captured_on", parsed.alias("j"))
    labels = F.transform(F.col("j.categories"), normalize_label)

    def side(i: int) -> Column:
        data = F.coalesce(F.get(F.col("j.series"), i).getField("data"), F.array().cast("array<string>"))
        n = F.least(F.size(labels), F.size(data))
        return F.map_from_arrays(F.slice(labels, 1, n), F.transform(F.slice(data, 1, n), lambda v: safe_cast(v)))

    df = df.select("subject_id", "captured_on", side(0).alias("s"), side(1).alias("g"),
                   (F.col("j").isNull() | F.col("j.categories").isNull() | F.col("j.series").isNull()).alias("bad"))
    return df.select(
        "subject_id",
        "captured_on",
        *[F.coalesce(F.try_element_at("s", F.lit(c)), F.lit(0.0)).alias(CREDIT.subject_col(c)) for c in CREDIT.columns],
        *[F.coalesce(F.try_element_at("g", F.lit(c)), F.lit(0.0)).alias(CREDIT.group_col(c)) for c in CREDIT.columns],
        F.when(F.col("bad"), F.lit("credit body is not JSON with categories and series")).alias("reason"),
    )


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without ``reason``, rejected rows with it)."""
    return df.where(F.col("reason").isNull()).drop("reason"), df.where(F.col("reason").isNotNull())
