"""Operators on small inline tables: edge rows, golden cases and properties."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.functions import scalar as S
from marketlake.operators import checks, coverage, documents, merge, watermarks
from marketlake.plans import loads
from marketlake.plans.store import TableStore
from marketlake.sources import landing, payloads
from marketlake.specs import SPECS, eligibility
from marketlake.streaming.incremental import ingest

D = dt.date
DAY = "2025-11-15"


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def day(text=DAY):
    return F.lit(text).cast("date")


@pytest.mark.parametrize(("text", "want"), [("12.345", Decimal("12.35")), ("1e3", Decimal("1000.00")), (" 7 ", Decimal("7.00")), ("abc", None), ("99999999", None), ("", None), (None, None)])
def test_to_decimal(spark, text, want):
    assert one(spark, S.to_decimal(F.lit(text).cast("string"), 8, 2)) == want


@pytest.mark.parametrize(("text", "want"), [("2024-01-05", D(2024, 1, 5)), ("2024-02-30", None), ("2024-1-5", None), ("2024", None), ("None", None)])
def test_to_date(spark, text, want):
    assert one(spark, S.to_date(F.lit(text))) == want


@pytest.mark.parametrize("token", S.NULL_TOKENS)
def test_null_tokens(spark, token):
    assert one(spark, S.null_tokens(F.lit(f" {token} "))) is None


def test_scalars(spark):
    assert one(spark, S.symbol_id(F.lit("AAPL"))) == 96313704
    assert one(spark, S.quarter_end(F.lit("2022Q3"))) == D(2022, 9, 30)
    assert one(spark, S.quarter_end(F.lit("2022Q5"))) is None
    at = lambda x: F.lit(x).cast("timestamp")
    assert one(spark, S.units_between("hour", at("2024-01-01 00:59:00"), at("2024-01-01 02:00:00"))) == 2
    assert one(spark, S.share(F.lit(1), F.lit(0))) is None
    assert one(spark, S.clean_date(F.lit(" <b>2024-01-02</b> x"))) == D(2024, 1, 2)
    assert one(spark, S.clean_date(F.lit("soon"))) is None and one(spark, S.clean_date(F.lit("x 2024-01-02"))) is None


CASES = [(None, "2025-10-12", True), ("2025-06-30", "2025-10-12", False), ("2025-06-30", "2025-11-12", False), ("2025-06-30", "2025-11-13", True), ("2025-06-30", "2025-11-15", True), ("2025-03-31", "2025-10-12", True)]


@pytest.mark.parametrize(("last", "as_of", "want"), CASES)
def test_135_days(spark, last, as_of, want):
    assert one(spark, S.older_than(F.lit(last).cast("date"), day(as_of), 135)) is want


@pytest.mark.parametrize(("first", "last", "want"), [(None, None, "full"), ("2020-01-01", "2025-11-11", "compact"), ("2020-01-01", "2025-11-10", "full"), ("2020-01-01", None, "full")])
def test_mode(spark, first, last, want):
    rows = spark.createDataFrame([(first, last)], "a string, b string").select(F.col("a").cast("date").alias("first_fiscal_date"), F.col("b").cast("date").alias("last_fiscal_date"))
    assert watermarks.mode(rows, day()).first()["mode"] == want


ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 3), st.integers(0, 9)), max_size=12)
FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@FEW
@given(ROWS, ROWS)
def test_upsert_properties(spark, old, new):
    kind = "k string, d int, v int"
    t = merge.latest(spark.createDataFrame(old, kind), ["k", "d"], "v")
    s = merge.latest(spark.createDataFrame(new, kind), ["k", "d"], "v")
    once = merge.merge_upsert(t, s, ["k", "d"])
    rows = once.collect()
    keys = [(r.k, r.d) for r in rows]
    assert len(keys) == len(set(keys))
    assert set(keys) == {(k, d) for k, d, _ in old} | {(k, d) for k, d, _ in new}
    assert sorted(map(str, merge.merge_upsert(once, s, ["k", "d"]).collect())) == sorted(map(str, rows))


def test_merge_variants(spark):
    t = spark.createDataFrame([("a", None, 1, 1), ("b", "x", 2, 2)], "k string, m string, v int, w int")
    s = spark.createDataFrame([("a", None, 9, 9), ("c", None, 3, 3)], t.schema)
    get = lambda df: sorted((r.k, r.v, r.w) for r in df.collect())
    assert get(merge.merge_partial(t, s, ["k", "m"], ["v"])) == [("a", 9, 1), ("b", 2, 2), ("c", 3, 3)]
    assert get(merge.insert_only(t, s.unionByName(s), ["k", "m"])) == [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]
    assert get(merge.insert_only(t, s, ["k", "m"], null_safe=False)) == [("a", 1, 1), ("a", 9, 9), ("b", 2, 2), ("c", 3, 3)]
    assert get(merge.update_from(t, s, ["k", "m"], {"w": F.col("s.w") + 1})) == [("a", 1, 10), ("b", 2, 2)]
    assert get(merge.delete_where(t, F.col("m") == "x")) == [("a", 1, 1)]
    files = spark.createDataFrame([("a", "b.csv"), ("a", "a.csv"), ("b", "a.csv"), ("b", "x_active.csv")], "k string, f string")
    assert sorted(map(tuple, merge.preferred_file(files, "k", "f", "active").collect())) == [("a", "a.csv"), ("b", "x_active.csv")]


def table(spark, rows):
    kind = "table_name string, symbol string, api_eligible string, delisting_date string, first_fiscal_date string, last_fiscal_date string, consecutive_failures int, n int"
    df = spark.createDataFrame(rows, kind)
    dates = {c: F.col(c).cast("date") for c in ("delisting_date", "first_fiscal_date", "last_fiscal_date")}
    return df.withColumns(dates | {"last_successful_run": F.lit(None).cast("timestamp"), "updated_at": F.lit(None).cast("timestamp")})


def test_control_table_transitions(spark):
    wm = table(spark, [("P", "a", "YES", None, "2020-01-01", "2025-01-01", None, 0), ("P", "b", "YES", "2025-01-01", None, None, 2, 1), ("P", "c", "YES", None, None, None, 2, 2), ("Q", "a", "NO", None, None, None, 0, 3)])
    now = F.lit(f"{DAY} 00:00:00").cast("timestamp")
    done = spark.createDataFrame([("a", D(2019, 1, 1), D(2024, 6, 30)), ("b", D(2024, 1, 1), D(2024, 6, 30))], "symbol string, first_date date, last_date date")
    after = {(r.table_name, r.symbol): r for r in watermarks.advance_success(wm, "P", done, now).collect()}
    assert (after["P", "a"].first_fiscal_date, after["P", "a"].last_fiscal_date, after["P", "a"].api_eligible) == (D(2020, 1, 1), D(2024, 6, 30), "YES")
    assert (after["P", "b"].api_eligible, after["P", "b"].consecutive_failures) == ("DEL", 0)
    assert after["Q", "a"].last_successful_run is None
    wide = {r.symbol: r for r in watermarks.advance_success(wm, "P", done, now, "widen").where("table_name = 'P'").collect()}
    assert (wide["a"].first_fiscal_date, wide["a"].last_fiscal_date) == (D(2019, 1, 1), D(2025, 1, 1))
    failed = {(r.table_name, r.symbol): r for r in watermarks.record_failure(wm, "P", wm.select("symbol"), suspend_at=3).collect()}
    assert [failed["P", s].consecutive_failures for s in "abc"] == [1, 3, 3]
    assert [failed["P", s].api_eligible for s in "abc"] == ["YES", "SUS", "SUS"]
    idle = {r.table_name: r.api_eligible for r in watermarks.suspend_idle_sources(wm).where("symbol = 'a'").collect()}
    assert idle == {"P": "YES", "Q": "SUS"}


def test_seed_and_fan_out_are_idempotent(spark):
    listing = spark.createDataFrame([("a", "A", "NYSE", "Stock", "Active"), ("e", "E", "BATS", "ETF", "Delisted"), ("", "", "", "", "")], "symbol string, name string, exchange string, asset_type string, status string")
    listing = listing.withColumns({"ipo_date": F.lit(None).cast("date"), "delisting_date": F.lit("2020-01-01").cast("date")})
    first = watermarks.seed(listing)
    assert first.count() == 2 and watermarks.seed(listing, first).count() == 0
    rows = watermarks.add_sources(first, list(SPECS), as_of=day())
    assert rows.count() == 16 and watermarks.add_sources(first, list(SPECS), rows).count() == 0
    got = {(r.table_name, r.symbol): r.api_eligible for r in rows.collect()}
    assert (got["ETF_PROFILE", "e"], got["BALANCE_SHEET", "e"], got["BALANCE_SHEET", "a"], got["ETF_PROFILE", "a"]) == ("DEL", "NO", "DEL", "NO")
    assert one(spark, eligibility(F.lit("CASH_FLOW"), F.lit("Stock"), F.lit(None).cast("string"))) == "NO"
    known = rows.unionByName(rows.withColumn("symbol", F.lit(None).cast("string")))
    assert watermarks.new_symbols(listing.where("symbol <> ''").withColumn("symbol", F.concat("symbol", F.lit("2"))), known, ["CASH_FLOW"]).count() == 2


def test_labels_of_missing_values(spark):
    wm = table(spark, [("COMPANY_OVERVIEW", "a", "YES", None, None, None, None, 0)]).withColumns({"ipo_date": F.lit(None).cast("date")})
    r = coverage.watermark_status(wm, day()).first()
    assert (r.listing_state, r.freshness, r.failure_band) == ("ACTIVE", "VERY_STALE", "CRITICAL")


def write(folder, name, text):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(text)


def test_landing_edge_rows(spark, tmp_path):
    write(tmp_path / "in", "A.csv", 'symbol,date,close,volume\nA,2024-01-02,"1,000.5",5\n  B , 2024-01-03 , 12.34565 , N/A\nC,2024-02-30,3,4\nD,2024-01-05\nE,2024-01-06,7,8,9\nF,2024-1-7,abc,1e3\n\n')
    write(tmp_path / "in", "B.csv", "CLOSE,SYMBOL,extra,DATE\n5.5,G,x,2024-02-01\nNone,H,y,2024-02-02\n")
    rows = {r.symbol: r for r in landing.typed(landing.read_csv(spark, str(tmp_path / "in"), ("symbol", "date", "close", "volume")), SPECS["TIME_SERIES_DAILY_ADJUSTED"]).collect()}
    assert set("ABCDEFGH") == set(rows)
    assert rows["A"].close is None and rows["B"].close == Decimal("12.3457") and rows["B"].volume is None
    assert rows["C"].date is None and rows["D"].close is None and rows["E"].volume == 8 and rows["F"].volume == 1000
    assert (rows["G"].close, rows["G"].date, rows["G"].volume) == (Decimal("5.5000"), D(2024, 2, 1), None)
    assert rows["H"].close is None and rows["E"]._corrupt is not None and rows["A"]._file.endswith("A.csv")
    assert landing.read_csv(spark, str(tmp_path / "in"), ("symbol",), glob="*.none").count() == 0


@pytest.mark.parametrize("source", ["BALANCE_SHEET", "CASH_FLOW", "INCOME_STATEMENT"])
def test_wide_rows_are_parsed_by_code_that_the_jvm_compiles(spark, tmp_path, source):
    """HotSpot leaves methods of more than 8000 bytes to its interpreter, which is several times slower."""
    names = ("symbol", "period_type", *payloads.statement_fields(source))
    cells = ["None", " 12.345 ", "", "abc", None, "1e3", "1234567890123456789.50", "\tN/A", " n/a "]
    numbers = [c for c in names if c in SPECS[source].decimals]
    texts = {c: cells[i % len(cells)] for i, c in enumerate(numbers)} | {"symbol": " A ", "period_type": "annual", "fiscal_date_ending": "2024-12-31", "reported_currency": "None"}
    spark.createDataFrame([tuple(texts[c] for c in names)], ", ".join(f"{c} string" for c in names)).write.parquet(f"{tmp_path}/rows")
    rows = landing.typed(spark.read.parquet(f"{tmp_path}/rows"), SPECS[source])
    assert rows.columns == list(names) and all(rows.schema[c].dataType.simpleString() == "decimal({},{})".format(*SPECS[source].decimals[c]) for c in numbers)
    row, whole = rows.first(), Decimal("1234567890123456789.50") if SPECS[source].decimals[numbers[0]] == (38, 2) else None
    assert [row[c] for c in numbers[:9]] == [None, Decimal("12.35"), None, None, None, Decimal("1000.00"), whole, None, None]
    assert (row.symbol, row.reported_currency, row.fiscal_date_ending) == ("A", None, D(2024, 12, 31))
    debug = getattr(getattr(spark.sparkContext._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    code = debug.codegenStringSeq(rows._jdf.queryExecution().executedPlan())
    sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
    assert sizes and max(sizes) <= 8000


def test_payloads(spark):
    texts = ['{"Error Message": "x"}', '{"Note": "x"}', '{"annualReports": []}', "<html>", '{"annualReports": [{"fiscalDateEnding": "2024-12-31", "totalAssets": "5"}], "quarterlyReports": null}', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "symbol int, p string")
    got = {r.symbol: r.outcome for r in payloads.classify(df, "p", ("annualReports", "quarterlyReports")).collect()}
    assert got == {0: "api_error", 1: "rate_limited", 2: "no_data", 3: "undecodable", 4: "ok", 5: "undecodable"}
    rows = payloads.reports(df, "p", {c: payloads.camel(c) for c in ("fiscal_date_ending", "total_assets")}).collect()
    assert [(r.period_type, r.fiscal_date_ending, r.total_assets) for r in rows] == [("annual", "2024-12-31", "5")]
    s = spark.createDataFrame([("l", '{"data": [{"date": "2024-01-01", "value": "."}]}'), ("m", '{"Monthly Prices": {"2024-01-01": "2.5"}}'), ("o", '{"monthly": [{"date": "2024-01-01", "value": "7"}]}'), ("p", '{"Time Series (Monthly)": {"2024-01-01": "8"}}'), ("n", "{}")], "c string, p string")
    assert {r.c: r.value for r in payloads.series_rows(s, "p").collect()} == {"l": None, "m": 2.5, "o": 7.0, "p": 8.0}
    docs = spark.createDataFrame([('{"status": "DELISTED"}',), ('{"delisted": true}',), ('{"status": "x"}',), ("bad",)], "d string")
    assert [r.delisted for r in documents.delisted(docs, "d").collect()] == [True, True, False, False]


def test_store_versions_and_partitions(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, None, 1)], "id int, p string, v int")
    assert not store.exists("t") and store.read("t", rows.schema).count() == 0
    store.overwrite("t", rows, "p")
    before = store._parts("t")
    store.upsert("t", spark.createDataFrame([(1, "a", 9), (4, "a", 9)], rows.schema), ["p", "id"], "p")
    after = store._parts("t")
    assert after["b"] == before["b"] and after["a"] != before["a"]
    get = lambda v=None: sorted((r.id, r.v) for r in store.read("t", version=v).collect())
    assert get() == [(1, 9), (2, 1), (3, 1), (4, 9)] and get(1) == [(1, 1), (2, 1), (3, 1)]
    store.append("t", rows.where("id = 2"))
    assert store.read("t").count() == 5 and store.version("t") == 3


def test_stream_takes_each_file_once(spark, tmp_path):
    store, columns = TableStore(spark, str(tmp_path / "store")), ("symbol", "date", "close")
    prepare = lambda b: loads.prepare(b, "TIME_SERIES_DAILY_ADJUSTED", "close")
    run = lambda: ingest(spark, str(tmp_path / "in"), columns, store, "t", ["symbol", "date"], str(tmp_path / "c"), prepare)
    write(tmp_path / "in", "1.csv", "symbol,date,close\nA,2024-01-01,1\nA,2024-01-01,2\nB,2024-01-01,-1\n")
    run()
    run()
    assert [(r.symbol, r.close) for r in store.read("t").collect()] == [("A", Decimal("2.0000"))]
    write(tmp_path / "in", "2.csv", "Close,extra,symbol,date\n3,x,A,2024-01-01\n4,x,B,2024-01-02\n")
    run()
    assert sorted((r.symbol, r.close) for r in store.read("t").collect()) == [("A", Decimal("3.0000")), ("B", Decimal("4.0000"))]
    assert store.version("t") == 2


def test_load_then_advance(spark):
    target = spark.createDataFrame([("A", D(2024, 1, 1), Decimal(1))], "symbol string, date date, close decimal(18,4)")
    staged = spark.createDataFrame([("A", "2024-01-01", "2"), ("A", "2024-01-01", "3"), ("A", "bad", "4"), ("C", "2024-01-05", "0")], "symbol string, date string, close string")
    out = loads.load(target, staged, "TIME_SERIES_DAILY_ADJUSTED", "close")
    assert [(r.symbol, r.close) for r in out.collect()] == [("A", Decimal("3.0000"))]
    wm = table(spark, [("TIME_SERIES_DAILY_ADJUSTED", s, "YES", None, None, None, 1, 0) for s in "AC"])
    moved = {r.symbol: r for r in loads.advance(wm, "TIME_SERIES_DAILY_ADJUSTED", out, "date", F.lit(f"{DAY} 00:00:00").cast("timestamp")).collect()}
    assert (moved["A"].last_fiscal_date, moved["A"].consecutive_failures, moved["C"].last_successful_run, moved["C"].consecutive_failures) == (D(2024, 1, 1), 0, None, 1)


def test_load_keeps_a_speakers_segments(spark):
    rows = [("A", "2024Q1", "CEO", text, "0.5") for text in ("x" * 60, "x" * 49 + "y" * 50, "short", "short")] + [("A", "2024Q1", "CEO", "short", "0.1")]
    staged = spark.createDataFrame(rows, "symbol string, quarter string, speaker string, content string, sentiment string")
    target = landing.typed(staged.where("false"), SPECS["EARNINGS_CALL_TRANSCRIPT"])
    assert loads.load(target, staged, "EARNINGS_CALL_TRANSCRIPT").count() == 4


def test_documents_in_files_and_lines(spark, tmp_path):
    write(tmp_path / "docs", "A.json", '{"Symbol": "A",\n "x": "1"}')
    write(tmp_path / "lines", "B.json", '{"Symbol": "B"}\n{"Symbol": "C", "x": 2}\n')
    assert [(r.Symbol, r.x) for r in landing.read_json(spark, str(tmp_path / "docs"), ("Symbol", "x"), whole=True).collect()] == [("A", "1")]
    assert sorted((r.Symbol, r.x) for r in landing.read_json(spark, str(tmp_path / "lines"), ("Symbol", "x")).collect()) == [("B", None), ("C", "2")]
    assert landing.read_documents(spark, str(tmp_path / "docs"), whole=True).where("doc IS NOT NULL").count() == 1


def test_checks_on_empty_tables(spark):
    empty = spark.createDataFrame([], "symbol string, date date, close double, high double, low double, volume double")
    assert checks.invalid_prices(empty).first()["n_rows"] == 0
    assert checks.duplicates(empty, ["symbol"]).count() == 0 and checks.gaps(empty).count() == 0
