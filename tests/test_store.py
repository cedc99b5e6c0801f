"""The table store under several writers, summaries by partition, and plans that stay even where a few keys hold most rows."""

import gzip
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketlake.operators import checks, coverage, merge, ranks, runlog, watermarks
from marketlake.plans import loads
from marketlake.plans.store import Conflict, TableStore
from marketlake.plans.summaries import refresh, summary
from marketlake.sources import landing, payloads
from marketlake.specs import OVERVIEW, SPECS

KIND = "k string, p string, v int"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def content(store, name="t"):
    return sorted(((r.k, r.p, r.v) for r in store.read(name).collect()), key=str)


@pytest.mark.parametrize(("other", "calls", "want"), [("x", 2, 101), ("y", 1, 2)])
def test_interleaved_writers_lose_no_row(spark, store, other, calls, want):
    """The second writer commits while the first one works: on the same partition the first merges anew, on another its folders hold."""
    store.overwrite("t", spark.createDataFrame([("a", "x", 1), ("b", "y", 1)], KIND), "p")
    seen = []

    def change(old):
        if not seen:
            TableStore(spark, store.root).upsert("t", spark.createDataFrame([("a" if other == "x" else "b", other, 100)], KIND), ["p", "k"], "p")
        seen.append(1)
        return old.withColumn("v", (F.col("v") + 1).cast("int"))

    store.update("t", change, None, "p", ["x"])
    rows = {k: v for k, _, v in content(store)}
    assert len(seen) == calls and rows["a"] == want and rows["b"] == (1 if other == "x" else 100) and store.version("t") == 3


def test_writers_of_one_table_at_once(spark, store):
    rows = [spark.createDataFrame([(f"k{i}", "x", i)], KIND) for i in range(4)]
    threads = [threading.Thread(target=TableStore(spark, store.root).upsert, args=("t", r, ["k"])) for r in rows[:3]]
    threads.append(threading.Thread(target=TableStore(spark, store.root).append, args=("t", rows[3])))
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert content(store) == [(f"k{i}", "x", i) for i in range(4)] and store.version("t") == 4


def test_publishing_never_replaces_a_version(spark, store, monkeypatch):
    store.overwrite("t", spark.createDataFrame([("a", "x", 1)], KIND))
    with pytest.raises(Conflict):
        store._commit("t", 0, store._parts("t"))
    # Stores other than local disks are asked through Hadoop's rules for renaming.
    real = store._fs()

    class Remote:
        def __getattr__(self, name):
            return getattr(real, name)

        def resolvePath(self, path):  # noqa: N802
            return type("P", (), {"toUri": lambda s: type("U", (), {"getScheme": lambda s: "hdfs"})()})()

    monkeypatch.setattr(store, "_fs", Remote)
    with pytest.raises(Conflict):
        store._commit("t", 0, store._parts("t"))
    assert store._commit("t", 1, store._parts("t")) == 2 and content(store) == [("a", "x", 1)]


def test_partition_values_of_any_kind(spark, store):
    rows = [("a", "x/y:z %", 1), ("b", None, 1), ("c", "", 1), ("d", "é", 1), ("e", "[a]{b}*?", 1)]
    store.overwrite("t", spark.createDataFrame(rows, KIND), "p")
    store.upsert("t", spark.createDataFrame([(k, p, 2) for k, p, _ in rows[:2]], KIND), ["p", "k"], "p")
    assert sorted(map(str, content(store))) == sorted(str((k, p, 2 if k in "ab" else 1)) for k, p, _ in rows)


def test_vacuum_keeps_what_versions_name(spark, store):
    for v in range(3):
        store.upsert("t", spark.createDataFrame([("a", "x", v), ("b", "y", v)][: 1 + (v == 0)], KIND), ["p", "k"], "p")
    want = content(store)
    assert store.vacuum("t", 1) == []  # everything is younger than a week
    assert len(store.vacuum("t", 2, -1)) == 1 and len(store.vacuum("t", 1, -1)) == 1 and store.vacuum("t", 1, -1) == []
    assert content(store) == want and store.version("t") == 3


def test_summaries_read_new_folders_alone(spark, store):
    measures = {"n": ("count", "*"), "lo": ("min", "v"), "hi": ("max", "v"), "total": ("sum", "v")}
    rows = [("a", "x", 1), ("a", "y", 5), ("b", "y", 2), (None, "z", 3)]
    store.overwrite("t", spark.createDataFrame(rows, KIND), "p")
    get = lambda: sorted(map(str, map(tuple, summary(store, "t", "s", ["k"], measures).collect())))
    assert get() == sorted(map(str, [("a", 2, 1, 5, 6), ("b", 1, 2, 2, 2), (None, 1, 3, 3, 3)]))
    store.upsert("t", spark.createDataFrame([("b", "y", 9), ("c", "y", 1)], KIND), ["p", "k"], "p")
    assert [f.partition("/")[2] for f in refresh(store, "t", "s", ["k"], measures)] == ["_part=y"]
    assert refresh(store, "t", "s", ["k"], measures) == []
    assert get() == sorted(map(str, [("a", 2, 1, 5, 6), ("b", 1, 9, 9, 9), ("c", 1, 1, 1, 1), (None, 1, 3, 3, 3)]))
    assert all("_summary_s" in f for f in summary(store, "t", "s", ["k"], measures).inputFiles()) and len(content(store)) == 5


def test_places_within_one_large_group(spark):
    rows = [("hot", i * 7 % 1000) for i in range(1000)] + [("cold", 3), (None, 1), (None, 0)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(8)
    out = ranks.place_within(df, "g", F.col("v").desc())
    got = {(r.g, r.v): r.place for r in out.collect()}
    assert got == {("hot", v): 1000 - v for v in range(1000)} | {("cold", 3): 1, (None, 1): 1, (None, 0): 2}
    assert ranks.place_within(df.where("false"), "g", "v").count() == 0
    # The only window runs over counts by task; its rows are as many as tasks and groups meet.
    assert plan(out).count("Window [") == 1 and "_task" in plan(out)


def test_sources_of_a_symbol_are_sorted_after_the_shuffle(spark):
    rows = [("a", "X", "YES", 1), ("a", "Y", "NO", 2), ("a", "Z", "NO", 9), ("b", "Y", None, 3), ("c", "Z", "YES", 4), (None, "X", "DEL", None)]
    wm = spark.createDataFrame(rows, "symbol string, table_name string, api_eligible string, n int")
    out = coverage.by_source(wm, x=("X", "api_eligible"), y=("Y", "api_eligible"), y_n=("Y", "n"))
    assert {tuple(r) for r in out.collect()} == {("a", "YES", "NO", 2), ("b", None, None, 3), (None, "DEL", None, None)}
    board = coverage.dashboard_of(*(spark.createDataFrame([], k) for k in ("symbol string, exchange string, asset_type string, status string", "symbol string, price_rows long, price_first date, price_last date", "symbol string, fiscal_date_ending date")), wm.withColumn("consecutive_failures", F.col("n")), F.lit("2025-01-01").cast("date"))
    for df in (out, board):
        lines = [x.strip(" :+-*(0123456789)") for x in df._jdf.queryExecution().sparkPlan().toString().splitlines()]
        sums = [i for i, x in enumerate(lines) if x.startswith("SortAggregate")]
        assert sums and lines[max(sums) + 1].startswith("Exchange hashpartitioning(symbol")


def test_by_priority_has_no_window_over_rows(spark):
    wm = spark.createDataFrame([("S", f"s{i}", None) for i in range(50)], "table_name string, symbol string, last_successful_run timestamp")
    policy = spark.createDataFrame([("S", 1, 1)], "table_name string, refresh_days int, priority int")
    out = watermarks.by_priority(wm, F.lit("2025-01-01").cast("date"), policy)
    assert [r.place for r in out.orderBy("symbol").collect()] == [i + 1 for i, _ in enumerate(sorted(f"s{i}" for i in range(50)))]
    assert "windowspecdefinition(table_name" not in plan(out)


def test_names_meet_texts_by_equality(spark):
    names = ["T1", "T10", "", "PRICES", "PRICE", "é", None, "zzz", "aaaa", "T1"]
    texts = ["MERGE INTO T10", "COPY INTO PRICES", "", "sélect", None, "aaaaaaaa", "T1", "MERGE INTO T10"]
    n, t = spark.createDataFrame([(x,) for x in names], "name string"), spark.createDataFrame([(x,) for x in texts], "text string")
    got = {tuple(r) for r in runlog.naming(n, t, "name", "text").collect()}
    assert got == {(a, b) for a in names for b in texts if a is not None and b is not None and a in b}
    log = t.select("text", F.lit(1.5).alias("credits"))
    cost = runlog.text_match(n.select(F.col("name").alias("table_name"), F.lit(1).alias("n_rows")), log)
    assert {r.table_name: (r.runs, r.credits) for r in cost.collect() if r.table_name in ("T10", "zzz", None)} == {"T10": (2, 3.0), "zzz": (0, 0.0), None: (0, 0.0)}
    # A name that the tables hold twice counts twice, as a join would.
    assert {r.table_name: r.runs for r in cost.collect()}["T1"] == 6
    physical = cost._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in physical and "Cartesian" not in physical
    assert runlog.naming(n.where("false"), t, "name", "text").count() == 0


def bytes_taken(spark):
    """Bytes taken from local files so far, by this JVM."""
    every = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(every.get(i).getBytesRead() for i in range(every.size()) if every.get(i).getScheme() == "file")


def test_header_lines_cost_a_buffer_a_file(spark, tmp_path):
    line = "A,2024-01-02,1.5\n" * 1_000_000
    (tmp_path / "big.csv").write_text("symbol,date,close\n" + line)
    with gzip.open(tmp_path / "other.csv.gz", "wt") as f:
        f.write("CLOSE,symbol,extra,date\n2.5,B,x,2024-01-03\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "one line.csv").write_text("symbol" * 1_000_000)
    before = bytes_taken(spark)
    found = landing.header_variants(spark, str(tmp_path), "*.csv*")
    assert [(head[:24], len(files)) for head, files in found] == [("CLOSE,symbol,extra,date", 1), ("symbol,date,close", 1), ("symbolsymbolsymbolsymbol", 1)]
    assert 0 < bytes_taken(spark) - before < 2 << 20
    (tmp_path / "one line.csv").unlink()
    rows = landing.read_csv(spark, str(tmp_path), ("symbol", "close"), glob="*.csv*")
    assert rows.where("symbol = 'B'").first().close == "2.5" and rows.count() == 1_000_001


def test_insert_only_takes_one_row_of_a_hot_null_key(spark):
    source = spark.createDataFrame([(None, i) for i in range(300, 0, -1)] + [("a", 5), ("a", None), ("b", 7)], "k string, v int")
    target = spark.createDataFrame([("b", 1)], source.schema)
    out = merge.insert_only(target, source, ["k"])
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [("b", 1), (None, 1), ("a", 5)]))
    assert "Window" not in plan(out)


def test_lists_are_bounded(spark):
    rows = [("2024-01-01 00:00:00", "F", f"e{i % 150:03d}") for i in range(450)] + [("2024-01-02 00:00:00", None, "x"), ("2024-01-03 00:00:00", "F", None)]
    files = spark.createDataFrame(rows, "load_ts string, status string, error string").withColumn("load_ts", F.col("load_ts").cast("timestamp"))
    got = {r.status: (r.n, r.messages) for r in runlog.errors(files).collect()}
    assert got == {"F": (450, "; ".join(f"e{i:03d}" for i in range(100)) + "; +50"), None: (1, "x")}
    assert runlog.error_messages(files).count() == 151
    ids = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), (None, 1), (None, 2)], "k string, v int")
    assert {(r.k, r.n_values, r.values) for r in checks.id_conflicts(ids, "k", "v", 2).collect()} == {("a", 3, "1, 2, +1"), (None, 2, "1, 2")}


def test_staging_profile_does_not_copy_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 1), ("a", 2)], "s string, i int")
    out = checks.staging_profile(df, ("s", "i"))
    assert tuple(out.first()) == (4, 2, 2) and "Expand" not in plan(out)
    assert tuple(checks.staging_profile(df.where("false"), ("s", "i")).first()) == (0, 0, 0)


def test_numbers_of_statements_keep_their_digits(spark):
    for source, want in (("BALANCE_SHEET", Decimal("1234567890123456789.50")), ("CASH_FLOW", Decimal("1234567890123456789.50")), ("INCOME_STATEMENT", None)):
        column = list(SPECS[source].decimals)[0]
        row = spark.createDataFrame([("A", "2024-12-31", "annual", "1234567890123456789.50")], f"symbol string, fiscal_date_ending string, period_type string, {column} string")
        assert loads.prepare(row, source).first()[column] == want


def test_reports_parse_a_payload_once(spark):
    texts = [("a", '{"annualReports": [{"x": "1"}, {"x": null}], "quarterlyReports": [{"x": "2"}]}'), ("b", '{"quarterlyReports": [{"y": 1}]}'), ("c", '{"annualReports": []}'), ("d", "<html>"), ("e", None)]
    out = payloads.reports(spark.createDataFrame(texts, "symbol string, p string"), "p", {"v": "x"})
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [("a", "annual", "1"), ("a", "annual", None), ("a", "quarterly", "2"), ("b", "quarterly", None)]))
    assert plan(out).count("parseJson") == 1


def test_latest_carries_a_row_once(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 5), ("a", 0, 9), (None, None, None), (None, None, 1)], "k string, v int, w int")
    whole = merge.latest(df, ["k"], *df.columns)
    assert {tuple(r) for r in whole.collect()} == {("a", 1, 5), (None, None, 1)} and "max_by" not in plan(whole)
    assert {tuple(r) for r in merge.latest(df, ["k"], "w").collect()} == {("a", 0, 9), (None, None, 1)}


def test_payload_names():
    names = payloads.overview_fields(OVERVIEW)
    assert len(names) == 46
    assert [names[c] for c in ("cik", "pe_ratio", "ev_to_ebitda", "diluted_eps_ttm", "quarterly_revenue_growth_yoy", "week_52_high", "ex_dividend_date", "fiscal_year_end")] == ["CIK", "PERatio", "EVToEBITDA", "DilutedEPSTTM", "QuarterlyRevenueGrowthYOY", "52WeekHigh", "ExDividendDate", "FiscalYearEnd"]
