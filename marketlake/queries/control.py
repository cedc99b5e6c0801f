"""The control table's queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators import documents
from marketlake.operators import watermarks as W
from marketlake.queries.inputs import AS_OF, SOURCES, day, now
from marketlake.queries.registry import Group, Tables

G = Group()
PRICES, BALANCE, OVERVIEW, ETF, CALLS, INSIDERS = "TIME_SERIES_DAILY_ADJUSTED", "BALANCE_SHEET", "COMPANY_OVERVIEW", "ETF_PROFILE", "EARNINGS_CALL_TRANSCRIPT", "INSIDER_TRANSACTIONS"
STATE = ("table_name", "symbol", "api_eligible", "first_fiscal_date", "last_fiscal_date", "consecutive_failures")
D = f"DATE '{AS_OF}'"


def state(df: DataFrame) -> DataFrame:
    return df.select(*STATE)


G.add("wm_seed", lambda t: W.seed(t.listing, t.listing.where("n % 3 = 0").select("symbol", F.lit(W.SEED).alias("table_name"))).select("table_name", "symbol", "exchange", "api_eligible"),
      "SELECT 'LISTING_STATUS' AS table_name, symbol, exchange, 'NO' AS api_eligible FROM listing WHERE n % 3 <> 0")
G.add("wm_add_source", lambda t: W.add_sources(W.seed(t.listing), SOURCES, t.wm.where("n % 2 = 0")).select("table_name", "symbol", "api_eligible"),
      "SELECT table_name, symbol, api_eligible FROM wm WHERE n % 2 <> 0")
G.add("wm_eligibility_del", lambda t: W.add_sources(W.seed(t.listing), SOURCES, as_of=day()).select("table_name", "symbol", "api_eligible"),
      f"SELECT table_name, symbol, CASE WHEN api_eligible = 'YES' AND delisting_date <= {D} THEN 'DEL' ELSE api_eligible END AS api_eligible FROM wm")
G.add("wm_new_symbols", lambda t: W.new_symbols(t.listing, t.wm.where("n % 4 <> 0"), SOURCES).select("table_name", "symbol", "api_eligible"),
      "SELECT table_name, symbol, api_eligible FROM wm WHERE n % 4 = 0")
G.add("wm_due", lambda t: W.due(t.wm, PRICES, day(), exchange="ETF_AND_ALL_OTHER", limit=200).select("symbol", "exchange"),
      f"SELECT symbol, exchange FROM wm WHERE table_name = '{PRICES}' AND api_eligible = 'YES' AND upper(exchange) NOT IN ('NASDAQ', 'NYSE') ORDER BY symbol LIMIT 200")
G.add("wm_due_stale135", lambda t: W.due(t.wm, BALANCE, day(), stale_days=135).select("symbol", "last_fiscal_date"),
      f"SELECT symbol, last_fiscal_date FROM wm WHERE table_name = '{BALANCE}' AND api_eligible = 'YES' AND (last_fiscal_date IS NULL OR last_fiscal_date < {D} - 135)")
G.add("wm_never_pulled", lambda t: W.due(t.wm, OVERVIEW, day(), never=True).select("symbol"), f"SELECT symbol FROM wm WHERE table_name = '{OVERVIEW}' AND api_eligible = 'YES' AND last_successful_run IS NULL")
G.add("wm_recent_skip", lambda t: W.due(t.wm, PRICES, day(), skip_hours=240).select("symbol"),
      f"SELECT symbol FROM wm WHERE table_name = '{PRICES}' AND api_eligible = 'YES' AND (last_successful_run IS NULL OR last_successful_run < TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 240 HOUR)")
G.add("wm_failure_cap", lambda t: W.due(t.wm, INSIDERS, day(), max_failures=3).select("symbol", "consecutive_failures"),
      f"SELECT symbol, consecutive_failures FROM wm WHERE table_name = '{INSIDERS}' AND api_eligible = 'YES' AND coalesce(consecutive_failures, 0) < 3")
G.add("wm_transcript_due", lambda t: W.due(t.wm, CALLS, day(), stale_days=135, skip_hours=168, active=True).select("symbol"),
      f"""SELECT symbol FROM wm WHERE table_name = '{CALLS}' AND api_eligible = 'YES' AND status = 'Active' AND (last_fiscal_date IS NULL OR last_fiscal_date < {D} - 135)
      AND (last_successful_run IS NULL OR last_successful_run < TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL 168 HOUR)""")  # fmt: skip
G.add("wm_mode", lambda t: W.mode(t.wm, day()).select("table_name", "symbol", "mode"),
      f"SELECT table_name, symbol, CASE WHEN first_fiscal_date IS NOT NULL AND last_fiscal_date IS NOT NULL AND {D} - last_fiscal_date < 5 THEN 'compact' ELSE 'full' END AS mode FROM wm")
G.add("wm_compact100", lambda t: W.compact(t.prices, 100).select("symbol", "date", "close"),
      "SELECT symbol, date, close FROM prices QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 100")
FUNDAMENTAL = ("BALANCE_SHEET", "INCOME_STATEMENT", "CASH_FLOW", "EARNINGS_CALL_TRANSCRIPT")
G.add("wm_enhanced", lambda t: W.with_fundamentals(W.due(t.wm, PRICES, day()), t.wm, FUNDAMENTAL).select("symbol"),
      f"SELECT symbol FROM wm WHERE table_name = '{PRICES}' AND api_eligible = 'YES' AND symbol IN (SELECT symbol FROM wm WHERE table_name IN {FUNDAMENTAL} AND last_fiscal_date IS NOT NULL)")
G.add("wm_success", lambda t: state(W.advance_success(t.wm.withColumn("updated_at", now()), PRICES, t.prices.groupBy("symbol").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date")), now())),
      f"""WITH a AS (SELECT symbol, min(date) AS lo, max(date) AS hi FROM prices GROUP BY symbol), j AS (SELECT wm.*, lo, hi, a.symbol IS NOT NULL AS hit FROM wm LEFT JOIN a ON a.symbol = wm.symbol AND table_name = '{PRICES}')
      SELECT table_name, symbol, CASE WHEN hit AND api_eligible = 'YES' AND delisting_date <= {D} THEN 'DEL' ELSE api_eligible END AS api_eligible,
        CASE WHEN hit THEN coalesce(first_fiscal_date, lo) ELSE first_fiscal_date END AS first_fiscal_date,
        CASE WHEN hit THEN coalesce(hi, last_fiscal_date) ELSE last_fiscal_date END AS last_fiscal_date,
        CASE WHEN hit THEN 0 ELSE consecutive_failures END AS consecutive_failures FROM j""")  # fmt: skip
G.add("wm_success_widen", lambda t: state(W.advance_success(t.wm.withColumn("updated_at", now()), PRICES, t.prices.groupBy("symbol").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date")), now(), "widen")),
      f"""WITH a AS (SELECT symbol, min(date) AS lo, max(date) AS hi FROM prices GROUP BY symbol), j AS (SELECT wm.*, lo, hi, a.symbol IS NOT NULL AS hit FROM wm LEFT JOIN a ON a.symbol = wm.symbol AND table_name = '{PRICES}')
      SELECT table_name, symbol, CASE WHEN hit AND api_eligible = 'YES' AND delisting_date <= {D} THEN 'DEL' ELSE api_eligible END AS api_eligible,
        CASE WHEN hit THEN least(first_fiscal_date, lo) ELSE first_fiscal_date END AS first_fiscal_date,
        CASE WHEN hit THEN greatest(last_fiscal_date, hi) ELSE last_fiscal_date END AS last_fiscal_date,
        CASE WHEN hit THEN 0 ELSE consecutive_failures END AS consecutive_failures FROM j""")  # fmt: skip
G.add("wm_failure", lambda t: state(W.record_failure(t.wm, BALANCE, t.listing.where("n % 5 = 0"))),
      f"""SELECT table_name, symbol, api_eligible, first_fiscal_date, last_fiscal_date,
      CASE WHEN table_name = '{BALANCE}' AND n % 5 = 0 THEN coalesce(consecutive_failures, 0) + 1 ELSE consecutive_failures END AS consecutive_failures FROM wm""")  # fmt: skip
G.add("wm_suspend", lambda t: state(W.suspend_idle_sources(W.suspend(t.wm.where("table_name <> 'CASH_FLOW' OR api_eligible = 'NO'"), CALLS))),
      f"""SELECT table_name, symbol, CASE WHEN table_name = '{CALLS}' AND api_eligible = 'YES' AND consecutive_failures >= 3 THEN 'SUS' WHEN table_name = 'CASH_FLOW' THEN 'SUS' ELSE api_eligible END AS api_eligible,
      first_fiscal_date, last_fiscal_date, consecutive_failures FROM wm WHERE table_name <> 'CASH_FLOW' OR api_eligible = 'NO'""")  # fmt: skip
G.add("wm_rebuild_date", lambda t: state(W.rebuild(t.wm, PRICES, t.prices, date="date")),
      f"""WITH a AS (SELECT symbol, min(date) AS lo, max(date) AS hi FROM prices GROUP BY symbol)
      SELECT table_name, wm.symbol, api_eligible, CASE WHEN a.symbol IS NOT NULL THEN lo ELSE first_fiscal_date END AS first_fiscal_date,
      CASE WHEN a.symbol IS NOT NULL THEN hi ELSE last_fiscal_date END AS last_fiscal_date, consecutive_failures FROM wm LEFT JOIN a ON a.symbol = wm.symbol AND table_name = '{PRICES}'""")  # fmt: skip


def calls(t: Tables) -> DataFrame:
    """Quarters of transcripts, with symbols of the listing."""
    return t.transcripts.select(F.concat(F.lit("Customer#"), F.lpad((F.col("conv_id") % 40).cast("string"), 9, "0")).alias("symbol"), "quarter")


G.add("wm_rebuild_quarter", lambda t: state(W.rebuild(t.wm, CALLS, calls(t), quarter="quarter")),
      f"""WITH a AS (SELECT concat('Customer#', lpad(CAST(conv_id % 40 AS STRING), 9, '0')) AS symbol,
        min(last_day(make_date(2000 + CAST(conv_id % 3 AS INT), 3 * (1 + CAST(conv_id % 4 AS INT)), 1))) AS lo,
        max(last_day(make_date(2000 + CAST(conv_id % 3 AS INT), 3 * (1 + CAST(conv_id % 4 AS INT)), 1))) AS hi FROM conversations GROUP BY 1)
      SELECT table_name, wm.symbol, api_eligible, CASE WHEN a.symbol IS NOT NULL THEN lo ELSE first_fiscal_date END AS first_fiscal_date,
      CASE WHEN a.symbol IS NOT NULL THEN hi ELSE last_fiscal_date END AS last_fiscal_date, consecutive_failures FROM wm LEFT JOIN a ON a.symbol = wm.symbol AND table_name = '{CALLS}'""")  # fmt: skip
G.add("wm_reset", lambda t: state(W.reset(t.wm, (F.col("table_name") == ETF) | (F.col("n") % 10 == 1))),
      f"""SELECT table_name, symbol, api_eligible, CASE WHEN NOT r THEN first_fiscal_date END AS first_fiscal_date, CASE WHEN NOT r THEN last_fiscal_date END AS last_fiscal_date,
      CASE WHEN r THEN 0 ELSE consecutive_failures END AS consecutive_failures FROM (SELECT *, table_name = '{ETF}' OR n % 10 = 1 AS r FROM wm)""")  # fmt: skip
G.add("wm_summary", lambda t: W.summary(W.add_sources(W.seed(t.listing), SOURCES, as_of=day())),
      f"""WITH x AS (SELECT *, CASE WHEN api_eligible = 'YES' AND delisting_date <= {D} THEN 'DEL' ELSE api_eligible END AS e FROM wm)
      SELECT table_name, count(*) AS total, count(*) FILTER (e = 'YES') AS eligible, count(*) FILTER (e = 'NO') AS not_eligible, count(*) FILTER (e = 'DEL') AS delisted,
      count(*) FILTER (e = 'SUS') AS suspended, count(DISTINCT symbol) AS symbols FROM x GROUP BY table_name""")  # fmt: skip
POLICY = ", ".join(map(str, W.POLICY))
G.add_spark("wm_policy", lambda s, t: W.by_priority(t.wm, day(), W.policy(s)).select("table_name", "symbol", "priority", F.col("place").cast("long").alias("place")),
      f"""WITH p(table_name, d, priority) AS (VALUES {POLICY})
      SELECT wm.table_name, symbol, priority, row_number() OVER (PARTITION BY wm.table_name ORDER BY last_successful_run NULLS FIRST, symbol) AS place
      FROM wm LEFT JOIN p ON p.table_name = wm.table_name WHERE last_successful_run IS NULL OR d IS NULL OR {D} - CAST(last_successful_run AS DATE) > d""")  # fmt: skip


def transitions(t: Tables) -> DataFrame:
    """Success, then failures up to suspension, then a reset with new eligibility: how many rows are in each state after each."""
    wm = t.wm.withColumn("updated_at", now())
    one = W.advance_success(wm, PRICES, t.listing.where("n % 2 = 0").select("symbol", day().alias("first_date"), day().alias("last_date")), now())
    two = W.record_failure(one, PRICES, t.listing.where("n % 3 = 0"), suspend_at=3)
    three = W.reset(two, F.col("n") % 6 == 0, reenable=True)
    of = lambda df, step: df.where(F.col("table_name") == PRICES).groupBy(F.lit(step).alias("step"), "api_eligible").agg(F.count("*").alias("n_rows"))
    return of(one, 1).unionByName(of(two, 2)).unionByName(of(three, 3))


G.add("state_transitions", transitions, f"""
    WITH a AS (SELECT n, CASE WHEN n % 2 = 0 AND delisting_date <= {D} THEN 'DEL' ELSE api_eligible END AS e,
        CASE WHEN n % 2 = 0 THEN 0 ELSE coalesce(consecutive_failures, 0) END AS f FROM wm WHERE table_name = '{PRICES}'),
    b AS (SELECT n, CASE WHEN n % 3 = 0 AND e = 'YES' AND f + 1 >= 3 THEN 'SUS' ELSE e END AS e FROM a),
    c AS (SELECT CASE WHEN n % 6 = 0 AND e IN ('DEL', 'SUS') THEN 'YES' ELSE e END AS e FROM b)
    SELECT 1 AS step, e AS api_eligible, count(*) AS n_rows FROM a GROUP BY e UNION ALL SELECT 2, e, count(*) FROM b GROUP BY e UNION ALL SELECT 3, e, count(*) FROM c GROUP BY e""")


def doc_delisted(t: Tables) -> DataFrame:
    text = F.when(F.col("n") % 8 == 0, F.to_json(F.struct(F.lit("Delisted").alias("status")))).when(F.col("n") % 8 == 1, F.to_json(F.struct(F.lit(True).alias("delisted")))).otherwise(F.to_json(F.struct("status")))
    docs = documents.delisted(t.listing.where("status = 'Active'").select("symbol", text.alias("doc")), "doc")
    return state(W.mark_delisted(t.wm, ETF, docs.where("delisted")))


G.add("doc_delisted", doc_delisted, f"""
    SELECT table_name, symbol, CASE WHEN table_name = '{ETF}' AND status = 'Active' AND n % 8 IN (0, 1) THEN 'DEL' ELSE api_eligible END AS api_eligible,
    first_fiscal_date, last_fiscal_date, consecutive_failures FROM wm""")
