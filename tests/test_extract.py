"""Extraction jobs on hand-made captured pages (the test tables have no markup tables)."""

import datetime as dt
import json

from pyspark.sql import functions as F

from peerscore.operators import extract
from peerscore.plans.capture import capture_records, capture_to_tables
from peerscore.schemas import CREDIT, GROWTH, PORTFOLIO, RISK

DAY = dt.date(2023, 1, 6)


def _body(html, field="tab_html"):
    return json.dumps({field: html})


def listing_html():
    def row(i, name, stars, cat_id, exp, assets):
        img = f'<img src="s.png" alt="{stars} star">' if stars else ""
        return (f'<tr><td><a href="/subjects/{i}/{name.lower()}">{name}</a></td><td>{img}</td><td>x</td><td>y</td>'
                f'<td><a href="/a/b/c/{cat_id}" data-original-title="Short Term">ST-01</a></td>'
                f"<td>z</td><td> {exp} </td><td>w</td><td>{assets}</td></tr>")
    rows = row(3389, "Alpha One", 4, 120, "0.45", "1,234") + row(3390, "Beta Two", 0, 120, "--", "987")
    rows += "<tr><td>broken</td></tr>"
    return f"<table><thead><tr><th>h</th></tr></thead><tbody>{rows}</tbody></table>"


BASIC = ('<ul class="investment-details-list"><h4>ignored</h4></ul>'
         '<ul class="investment-details-list wide"><h4><a href="/h">Acme Asset. -- Co!</a></h4><h4>a</h4><h4>b</h4>'
         '<h4>c</h4><h4>Moderately Low</h4><h4>e</h4><h4>f</h4><h4>g</h4><h4> Above Average </h4>'
         '<h4> Average </h4></ul>')


def returns_html(blank_middle=False):
    subj = ["Subject", "a", "b", "c", "1.5", "2.5", "3.5", "4.5", "--", "6.5", "7.5"]
    if blank_middle:
        subj.insert(5, " ")
    cat = ["Category", "a", "b", "c", "1.0", "2.0", "3.0", "4.0", "5.0", "6.0", "7.0"]
    mk = lambda cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    return (f'<table id="return_over_time_table"><tbody>{mk(subj)}{mk(["rank"])}{mk(cat)}</tbody></table>')


PORTFOLIO_HTML = (
    '<table id="company-holding_table_debt"><tbody>'
    + "".join(f"<tr><td> Holding {i} </td><td>x</td></tr>" for i in range(14))
    + '</tbody></table><div id="portfolioEquityTab"><table class="table small"><tbody>'
    '<tr><td>Number of Securities</td><td>40</td><td>55</td></tr>'
    '<tr><td>Modified Duration</td><td>1.2</td><td>1.5</td></tr>'
    '<tr><td>Average Maturity</td><td>2.0</td></tr>'
    '<tr><td>YTM</td><td>7.1</td><td>7.3</td></tr>'
    '<tr><td>Avg Credit Rating</td><td>--</td><td>--</td></tr>'
    "</tbody></table></div>")

RISK_HTML = ('<div class="risk-table-view"><table><tbody>'
             '<tr><td>Subject</td><td>8.1</td><td>1.2</td><td>0.9</td><td>1.1</td><td>-5.28</td><td>-1.75</td></tr>'
             '<tr><td>rank</td></tr>'
             '<tr><td>Category</td><td>7.0</td><td>1.0</td><td>0.8</td><td>1.0</td><td>0.9</td><td>0.1</td></tr>'
             "</tbody></table></div>")

CREDIT_BODY = json.dumps({"categories": ["AAA", "A1+", "Cash Equivalent", "Unknown bucket"],
                          "series": [{"data": [50.5, "12.5", "--", 1]}, {"data": [40, 10, 30, 2]}]})


def captures(spark, blank_middle=False):
    rows = [("", "listing", DAY, _body(listing_html(), "html_data"))]
    for sid in ("3389", "3390"):
        rows += [(sid, "basic", DAY, _body(BASIC)), (sid, "returns", DAY, _body(returns_html(blank_middle))),
                 (sid, "portfolio", DAY, _body(PORTFOLIO_HTML)), (sid, "risk", DAY, _body(RISK_HTML)),
                 (sid, "credit", DAY, CREDIT_BODY)]
    rows.append(("3390", "credit", dt.date(2023, 1, 7), "not json"))
    return spark.createDataFrame(rows, "subject_id string, kind string, captured_on date, body string")


def test_listing(spark):
    rows = {r.position: r for r in extract.extract_listing(captures(spark)).collect()}
    a, b, bad = rows[0], rows[1], rows[2]
    assert (a.id, a.name, a.rating, a.category_id, a.category, a.category_code, a.asset_value, a.expense_ratio) == (
        "3389", "Alpha One", 4, "120", "Short Term", "ST-01", 1234, 0.45)
    assert (b.rating, b.expense_ratio, b.asset_value) == (0, 0.0, 987)
    assert a.reason is None and bad.reason is not None
    assert len(extract.extract_listing(captures(spark), limit=1).collect()) == 1


def test_basic(spark):
    r = extract.extract_basic(captures(spark)).first()
    assert (r.house, r.risk, r.risk_grade, r.return_grade) == ("Acme Asset Co", "Moderately Low", "Above Average",
                                                                "Average")


def test_returns_and_blank_cell_shift(spark):
    r = extract.extract_returns(captures(spark)).first()
    assert [r[GROWTH.subject_col(h)] for h in GROWTH.columns] == [1.5, 2.5, 3.5, 4.5, 0.0, 6.5, 7.5]
    assert [r[GROWTH.group_col(h)] for h in GROWTH.columns] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    # a blank cell is dropped before indexing: a blank after cell 4 does not shift anything (compacted)
    r2 = extract.extract_returns(captures(spark, blank_middle=True)).first()
    assert [r2[GROWTH.subject_col(h)] for h in GROWTH.columns] == [1.5, 2.5, 3.5, 4.5, 0.0, 6.5, 7.5]


def test_portfolio_and_holdings(spark):
    r = extract.extract_portfolio(captures(spark)).first()
    assert r.top_holdings == [f"Holding {i}" for i in range(11)]
    assert [r[PORTFOLIO.subject_col(c)] for c in PORTFOLIO.columns] == [40.0, 1.2, 2.0, 7.1, 0.0]
    assert [r[PORTFOLIO.group_col(c)] for c in PORTFOLIO.columns] == [55.0, 1.5, 0.0, 7.3, 0.0]


def test_risk(spark):
    r = extract.extract_risk(captures(spark)).first()
    assert [r[RISK.subject_col(c)] for c in RISK.columns] == [8.1, 1.2, 0.9, 1.1, -5.28, -1.75]
    assert [r[RISK.group_col(c)] for c in RISK.columns] == [7.0, 1.0, 0.8, 1.0, 0.9, 0.1]


def test_credit(spark):
    rows = {(r.subject_id, r.captured_on): r for r in extract.extract_credit(captures(spark)).collect()}
    r = rows[("3389", DAY)]
    assert [r[CREDIT.subject_col(c)] for c in CREDIT.columns] == [50.5, 12.5, 0.0, 0.0, 0.0, 0.0, 0.0]
    assert [r[CREDIT.group_col(c)] for c in CREDIT.columns] == [40.0, 10.0, 0.0, 30.0, 0.0, 0.0, 0.0]
    assert rows[("3390", dt.date(2023, 1, 7))].reason is not None


def test_links(spark):
    pages = spark.createDataFrame([(1, '<p><a href="/x/y">X <b>Y</b></a> <a class="c" href="http://h/z">Z</a></p>')],
                                  "page_id long, html string")
    got = [(r.pos, r.href, r.text, r.segment_1) for r in extract.extract_links(pages).collect()]
    assert got == [(0, "/x/y", "X Y", "x"), (1, "http://h/z", "Z", "")]


def test_records_and_tables(spark):
    rec, rejects = capture_records(captures(spark))
    recs = {r.id: r for r in rec.collect()}
    assert set(recs) == {3389, 3390}
    a = recs[3389]
    assert a.group_id == 120 and a.house == "Acme Asset Co" and json.loads(a.top_holdings)[0] == "Holding 0"
    kinds = {(r.kind, r.id) for r in rejects.collect()}
    assert ("credit", "3390") in kinds and any(k == "listing" for k, _ in kinds)
    tables = capture_to_tables(captures(spark))
    gg = tables["group_growth"].collect()
    assert len(gg) == 1 and gg[0].group_id == 120
    assert tables["subject_growth"].count() == 2


def test_links_with_every_quoting(spark):
    html = """<a href='/s/1'>one</a><a class=x href=/u/2>two</a><a id='q' href = "/d/3" >three</a><abbr href="/no">n</abbr>"""
    got = [(r.href, r.text) for r in extract.extract_links(spark.createDataFrame([(1, html)], "page_id long, html string")).collect()]
    assert got == [("/s/1", "one"), ("/u/2", "two"), ("/d/3", "three")]


def test_tables_with_every_quoting_and_nested_tables(spark):
    plain = returns_html()
    nested = plain.replace("<td>a</td>", "<td>a<table><tr><td>9</td></tr></table></td>", 1)
    variants = [plain, plain.replace('id="return_over_time_table"', "id='return_over_time_table'"),
                plain.replace('id="return_over_time_table"', "class=c id=return_over_time_table"), nested,
                "<table id='other'><tr><td>1</td></tr></table>" + nested]
    rows = [(str(k), "returns", DAY, _body(v)) for k, v in enumerate(variants)]
    out = extract.extract_returns(spark.createDataFrame(rows, "subject_id string, kind string, captured_on date, body string")).collect()
    assert len(out) == 5
    for r in out:
        assert r.reason is None and [r[GROWTH.subject_col(h)] for h in GROWTH.columns] == [1.5, 2.5, 3.5, 4.5, 0.0, 6.5, 7.5]


def test_listing_values_beyond_the_types_are_rejected_not_zeroed(spark):
    big = listing_html().replace("1,234", "3,000,000,000").replace("987", "99,999,999,999,999,999,999")
    caps = spark.createDataFrame([("", "listing", DAY, _body(big, "html_data"))], "subject_id string, kind string, captured_on date, body string")
    a, b, _ = extract.extract_listing(caps).orderBy("position").collect()
    assert (a.asset_value, a.reason) == (3_000_000_000, None) and b.reason == "asset value out of range"


def test_listing_limit_spans_the_pages(spark):
    rows = [("", "listing", DAY, _body(listing_html(), "html_data"), p) for p in (2, 1)]
    caps = spark.createDataFrame(rows, "subject_id string, kind string, captured_on date, body string, page int")
    got = extract.extract_listing(caps, limit=4).collect()
    assert sorted((r.page, r.position) for r in got) == [(1, 0), (1, 1), (1, 2), (2, 0)]


def test_capture_and_store(spark, tmp_dir):
    from peerscore.plans.capture import REJECT_KEYS, capture_and_store
    from peerscore.schemas import TABLE_KEYS, table_schema

    root = f"{tmp_dir}/model"
    first = capture_and_store(spark, captures(spark), root, clock=dt.datetime(2023, 1, 6, 9))
    kept = {k: sorted(map(str, v.drop("modified").collect())) for k, v in first.items()}
    assert kept["rejects"] and kept["subject_growth"] and kept["group_dim"]
    second = capture_and_store(spark, captures(spark), root, clock=dt.datetime(2023, 1, 7, 9))
    for name, df in second.items():
        assert sorted(map(str, df.drop("modified").collect())) == kept[name], name
        keys = TABLE_KEYS.get(name, REJECT_KEYS)
        assert df.groupBy(*keys).count().where("count > 1").count() == 0
        if name != "rejects":
            assert {r.modified for r in df.select("modified").collect()} == {dt.datetime(2023, 1, 7, 9)}
            declared = {f.name: f.dataType for f in table_schema(name).fields}
            assert {f.name: f.dataType for f in df.schema.fields} == declared


def test_kinds_in_six_batches_give_the_tables_of_one(spark, tmp_dir):
    from peerscore.plans.capture import capture_and_store

    whole = captures(spark)
    clock = dt.datetime(2023, 1, 6, 9)
    want = capture_and_store(spark, whole, f"{tmp_dir}/one", clock=clock)
    for kind in ("risk", "credit", "basic", "portfolio", "listing", "returns"):
        got = capture_and_store(spark, whole.where(F.col("kind") == kind), f"{tmp_dir}/six", clock=clock)
    for name, df in want.items():
        assert sorted(map(str, got[name].collect())) == sorted(map(str, df.collect())), name


def test_a_part_that_a_batch_lacks_leaves_the_stored_values(spark, tmp_dir):
    from peerscore.plans.capture import capture_and_store

    whole, root = captures(spark), f"{tmp_dir}/model"
    first = {k: sorted(map(str, v.drop("modified").collect())) for k, v in capture_and_store(spark, whole, root).items()}
    assert first["subject_risk"] and first["group_risk"]
    later = capture_and_store(spark, whole.where("kind <> 'risk'"), root)
    assert {k: sorted(map(str, v.drop("modified").collect())) for k, v in later.items()} == first
    alone = capture_and_store(spark, whole.where("kind = 'risk'"), root)
    assert {k: sorted(map(str, v.drop("modified").collect())) for k, v in alone.items()} == first


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_page_is_read_once_however_often_its_table_is_named(spark):
    caps = captures(spark)
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    for df in (extract.extract_returns(caps), extract.extract_risk(caps), extract.extract_portfolio(caps), extract.extract_listing(caps)):
        assert _optimized(df).count("get_json_object(") == 2  # the two fields that may hold the markup


def test_nested_tables_of_any_depth_and_length(spark):
    long = "<table><tr><td>" + "9" * 200_000 + "</td></tr></table>"
    deep = "<table><tr><td>a<TABLE><tr><td>b</td></tr></TABLE ></td></tr></table>"
    for inner in (long, deep, long + deep):
        page = returns_html().replace("<td>a</td>", f"<td>a{inner}</td>", 1) + "<table><tr><td>1</td></tr></table>"
        df = spark.createDataFrame([("1", "returns", DAY, _body(page))], "subject_id string, kind string, captured_on date, body string")
        r = extract.extract_returns(df).first()
        assert r.reason is None and [r[GROWTH.subject_col(h)] for h in GROWTH.columns] == [1.5, 2.5, 3.5, 4.5, 0.0, 6.5, 7.5]


def test_rejects_and_records_do_not_repeat_the_extraction(spark):
    from peerscore.plans.capture import capture_partials

    for df in capture_partials(captures(spark)):
        assert "regexp" not in _optimized(df) and "rlike" not in _optimized(df).lower()


def test_outer_merge_equals_full_joins_and_shuffles_a_frame_once(spark):
    from peerscore.operators.reshape import merge_partials

    base = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "c"), (None, 1, "d")], "k int, d int, x string")
    parts = {0: spark.createDataFrame([(1, 1, "p"), (3, 1, "q"), (None, 1, "r")], "k int, d int, y string"),
             1: spark.createDataFrame([(3, 1, "s"), (3, 1, "t"), (2, None, "u")], "k int, d int, z string")}
    want = base
    for part in parts.values():
        want = want.join(part, ["k", "d"], "outer")
    got = merge_partials(base, parts, ["k", "d"], how="outer")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "FullOuter" not in _optimized(got)
