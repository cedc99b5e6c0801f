"""Coverage, documents, quality and run-log queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators import checks as Q
from marketlake.operators import coverage as C
from marketlake.operators import documents as V
from marketlake.operators import runlog as L
from marketlake.plans.scratch import scratch
from marketlake.plans.store import TableStore
from marketlake.plans.summaries import summary
from marketlake.queries.inputs import AS_OF, RUN_AT, day, now, run_at
from marketlake.queries.registry import Group, Tables

G = Group()
D, N, R = f"DATE '{AS_OF}'", f"TIMESTAMP '{AS_OF} 00:00:00'", f"TIMESTAMP '{RUN_AT}'"

# Coverage

G.add("symbol_coverage", lambda t: C.symbol_coverage(t.prices, day()), f"""
    SELECT symbol, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date, CAST({D} - max(date) AS BIGINT) AS days_stale,
        CASE WHEN {D} - max(date) <= 7 THEN 'FRESH' WHEN {D} - max(date) <= 30 THEN 'STALE' ELSE 'VERY_STALE' END AS freshness
    FROM prices GROUP BY symbol""")
G.add("symbol_category", lambda t: C.symbol_category(t.listing), """
    SELECT CASE WHEN delisting_date IS NOT NULL AND ipo_date IS NOT NULL THEN 'delisted_with_dates' WHEN delisting_date IS NULL AND ipo_date IS NOT NULL THEN 'active_with_ipo'
        WHEN delisting_date IS NOT NULL THEN 'delisted_no_ipo' ELSE 'minimal' END AS category, count(*) AS symbols, min(ipo_date) AS first_ipo, max(delisting_date) AS last_delisting
    FROM listing GROUP BY 1""")
G.add("exchange_mix", lambda t: C.exchange_mix(t.listing), "SELECT exchange, asset_type, status, count(*) AS symbols FROM listing GROUP BY ALL")
FRESH = "CASE " + " ".join(f"WHEN table_name = '{s}' THEN CASE WHEN age <= {a} THEN 'FRESH' WHEN age <= {b} THEN 'STALE' ELSE 'VERY_STALE' END" for s, (a, b) in C.FRESHNESS.items()) + " WHEN age <= 7 THEN 'FRESH' WHEN age <= 30 THEN 'STALE' ELSE 'VERY_STALE' END"
G.add("watermark_status", lambda t: C.watermark_status(t.wm, day()), f"""
    SELECT table_name, symbol, CAST({D} - ipo_date AS BIGINT) AS days_since_ipo,
        CASE WHEN delisting_date <= {D} THEN 'DELISTED' WHEN ipo_date > {D} THEN 'FUTURE_IPO' ELSE 'ACTIVE' END AS listing_state, {FRESH} AS freshness,
        CASE WHEN consecutive_failures = 0 THEN 'OK' WHEN consecutive_failures <= 3 THEN 'WARNING' WHEN consecutive_failures <= 10 THEN 'ERROR' ELSE 'CRITICAL' END AS failure_band
    FROM (SELECT *, {D} - CAST(last_successful_run AS DATE) AS age FROM wm)""")
G.add("processing_summary", lambda t: C.processing_summary(t.wm), """
    SELECT table_name, count(*) AS total, count(*) FILTER (api_eligible = 'YES') AS eligible, count(last_successful_run) AS processed,
        count(*) FILTER (consecutive_failures > 0) AS with_failures, round(count(last_successful_run) * 100.0::DOUBLE / count(*), 2) AS processed_pct,
        CAST(max(last_successful_run) AS DATE) AS last_run FROM wm GROUP BY table_name""")


def statements(t: Tables) -> DataFrame:
    """Statements are of suppliers, so every fifth symbol takes a supplier's name."""
    return t.statements.select(F.concat(F.lit("Customer#"), F.lpad((F.substring("symbol", 10, 9).cast("int") * 5).cast("string"), 9, "0")).alias("symbol"), "fiscal_date_ending")


def board(t: Tables) -> DataFrame:
    return C.dashboard(t.listing, t.prices, statements(t), t.wm, day())


BOARD = f"""
    p AS (SELECT symbol, count(*) AS price_rows, min(date) AS price_first, max(date) AS price_last FROM prices GROUP BY symbol),
    s AS (SELECT concat('Customer#', lpad(CAST(CAST(substr(symbol, 10) AS INT) * 5 AS STRING), 9, '0')) AS symbol, count(*) AS statement_rows, max(fiscal_date_ending) AS statement_last FROM statements GROUP BY 1),
    w1 AS (SELECT symbol, api_eligible AS price_eligible, consecutive_failures AS price_failures FROM wm WHERE table_name = 'TIME_SERIES_DAILY_ADJUSTED'),
    w2 AS (SELECT symbol, api_eligible AS statement_eligible FROM wm WHERE table_name = 'BALANCE_SHEET'),
    j AS (SELECT l.symbol, exchange, asset_type, status, price_rows, price_first, price_last, statement_rows, statement_last, price_eligible, statement_eligible, price_failures,
            CAST({D} - price_last AS BIGINT) AS price_days, CAST({D} - statement_last AS BIGINT) AS statement_days
        FROM listing l LEFT JOIN p ON p.symbol = l.symbol LEFT JOIN s ON s.symbol = l.symbol LEFT JOIN w1 ON w1.symbol = l.symbol LEFT JOIN w2 ON w2.symbol = l.symbol),
    board AS (SELECT * EXCLUDE (price_rows, statement_rows), coalesce(price_rows, 0) AS price_rows, coalesce(statement_rows, 0) AS statement_rows,
        CASE WHEN price_rows IS NULL THEN 'MISSING' WHEN price_days <= 7 THEN 'FRESH' WHEN price_days <= 30 THEN 'STALE' ELSE 'VERY_STALE' END AS price_freshness,
        CASE WHEN statement_rows IS NULL THEN 'MISSING' WHEN statement_days <= 90 THEN 'FRESH' WHEN statement_days <= 180 THEN 'STALE' ELSE 'VERY_STALE' END AS statement_freshness,
        CASE WHEN price_rows IS NOT NULL AND statement_rows IS NOT NULL THEN 'BOTH' WHEN price_rows IS NOT NULL THEN 'PRICES_ONLY' WHEN statement_rows IS NOT NULL THEN 'STATEMENTS_ONLY' ELSE 'NO_DATA' END AS availability FROM j)"""
G.add("coverage_dashboard", board, f"WITH {BOARD} SELECT * FROM board")


def dashboard_incremental(spark: SparkSession, t: Tables) -> DataFrame:
    """The dashboard over a stored price table by year, from summaries: the second one reads the rows of the one year that was upserted."""
    store = TableStore(spark, scratch(spark, "store"))
    rows = t.prices.select("symbol", "date", "close", F.year("date").alias("year"))
    store.overwrite("prices", rows.where("year <> 1997 OR close < 50000"), "year", ["symbol", "date"])
    dashboard = lambda: C.dashboard_of(t.listing, summary(store, "prices", "coverage", ["symbol"], C.PRICE_MEASURES), statements(t), t.wm, day())
    dashboard()
    store.upsert("prices", rows.where("year = 1997"), ["year", "symbol", "date"], "year", ["symbol", "date"])
    return dashboard()


G.add_spark("dashboard_incremental", dashboard_incremental, f"WITH {BOARD} SELECT * FROM board")
G.add("stale_alerts", lambda t: C.stale_alerts(board(t)), f"""
    WITH {BOARD} SELECT *, price_alert IS NOT NULL OR statement_alert IS NOT NULL AS has_alert FROM (
        SELECT symbol, exchange, asset_type, price_days, statement_days, CASE WHEN price_days IS NULL THEN 'NO_PRICES' WHEN price_days > 7 THEN 'STALE_PRICES' END AS price_alert,
            CASE WHEN asset_type = 'Stock' AND statement_days IS NULL THEN 'NO_STATEMENTS' WHEN statement_days > 120 THEN 'STALE_STATEMENTS' END AS statement_alert
        FROM board WHERE status = 'Active' AND (price_days IS NULL OR price_days > 7 OR statement_days IS NULL OR statement_days > 120))""")
PART = "SELECT '{1}' AS data_type, count(*) AS symbols, CAST(sum(CASE WHEN {0}_freshness <> 'MISSING' THEN 1 ELSE 0 END) AS BIGINT) AS with_data, CAST(sum(CASE WHEN {0}_freshness = 'FRESH' THEN 1 ELSE 0 END) AS BIGINT) AS fresh, round(sum(CASE WHEN {0}_freshness <> 'MISSING' THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 2) AS coverage_pct FROM board"
G.add("coverage_summary", lambda t: C.coverage_summary(board(t)), f"WITH {BOARD} {PART.format('price', 'PRICES')} UNION ALL {PART.format('statement', 'STATEMENTS')}")
G.add("processing_stats", lambda t: C.processing_stats(t.wm, now()), f"""
    WITH a AS (SELECT table_name, count(*) AS total, round(avg(CAST(date_diff('hour', last_successful_run, {N}) AS DOUBLE)), 2) AS avg_hours FROM wm GROUP BY 1),
    b AS (SELECT table_name, coalesce(consecutive_failures, -1) AS f, count(*) AS n FROM wm GROUP BY 1, 2),
    c AS (SELECT table_name, string_agg(f || ':' || n, ', ' ORDER BY f) AS failures FROM b GROUP BY 1)
    SELECT a.table_name, total, avg_hours, failures FROM a LEFT JOIN c ON c.table_name = a.table_name""")
G.add("eligible_pct", lambda t: C.eligible_pct(t.wm), "SELECT table_name, api_eligible, count(*) AS symbols, round(count(last_successful_run) * 100.0::DOUBLE / count(*), 2) AS processed_pct FROM wm GROUP BY 1, 2")
G.add("needs_refresh", lambda t: C.needs_refresh(t.wm, day()), f"""
    SELECT table_name, symbol, CAST(last_successful_run AS DATE) AS last_run FROM wm WHERE api_eligible = 'YES' AND (last_successful_run IS NULL OR CAST(last_successful_run AS DATE) < {D} - 30)
    ORDER BY last_run NULLS FIRST, table_name, symbol LIMIT 50""")
G.add("exchange_progress", lambda t: C.exchange_progress(t.wm, day()), f"""
    SELECT exchange, count(*) AS total, count(last_successful_run) AS processed, count(*) FILTER (consecutive_failures > 0) AS failing,
        round(avg(CAST({D} - CAST(last_successful_run AS DATE) AS DOUBLE)), 2) AS avg_days_stale FROM wm GROUP BY exchange""")
G.add("failure_leaders", lambda t: C.failure_leaders(t.wm), "SELECT table_name, symbol, consecutive_failures FROM wm WHERE consecutive_failures >= 3 ORDER BY consecutive_failures DESC, table_name, symbol LIMIT 20")
G.add("eligibility_mix", lambda t: C.eligibility_mix(t.wm, now()), f"""
    SELECT table_name, api_eligible, count(*) AS symbols, count(DISTINCT exchange) AS exchanges, count(*) FILTER (last_successful_run IS NULL) AS never_run,
        count(*) FILTER (date_diff('hour', last_successful_run, {N}) > 720) AS stale_720h FROM wm GROUP BY 1, 2""")
G.add("source_overview", lambda t: C.source_overview(t.wm), "SELECT table_name, asset_type, count(*) AS total, count(*) FILTER (api_eligible = 'YES') AS eligible FROM wm GROUP BY 1, 2")
G.add(
    "run_summary",
    lambda t: C.run_summary(t.run_log.groupBy("kind").agg(F.count("*").alias("total"), F.count_if(F.col("status") == "OK").alias("succeeded"), F.round(F.sum("elapsed_ms") / 1000.0, 2).alias("seconds"))),
    """SELECT *, round(succeeded * 100.0::DOUBLE / total, 2) AS success_pct, round(total * 60.0::DOUBLE / seconds, 2) AS per_minute FROM (
        SELECT kind, count(*) AS total, count(*) FILTER (status = 'OK') AS succeeded, round(sum(elapsed_ms) / 1000.0::DOUBLE, 2) AS seconds FROM run_log GROUP BY kind)""",
)

# Documents

G.add("variant_fields", lambda t: V.fields(t.events.select("event_id", F.concat(F.lit('{"52WeekHigh": "'), F.col("value").cast("decimal(18,2)").cast("string"), F.lit('", "p": '), F.col("props"), F.lit("}")).alias("doc")), "doc", {"k": ("$.p.k", "int"), "week_high": ("$['52WeekHigh']", "string"), "absent": ("$.q", "string")}).drop("doc"),
      """SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, CAST(CAST(value AS DECIMAL(18,2)) AS STRING) AS week_high, CAST(NULL AS STRING) AS absent FROM events""")  # fmt: skip
G.add("json_top_fields", lambda t: V.etf_profiles(t.etf_parts).select("symbol", F.size("sectors").cast("long").alias("n_sectors"), F.size("holdings").cast("long").alias("n_holdings")),
      "SELECT symbol, count(DISTINCT sector) AS n_sectors, count(*) AS n_holdings FROM etf_parts GROUP BY symbol")
G.add("etf_sectors", lambda t: V.sectors(V.etf_profiles(t.etf_parts)).withColumn("weight", F.col("weight").cast("double")), "SELECT symbol, sector, CAST(sum(weight) AS DOUBLE) AS weight FROM etf_parts GROUP BY symbol, sector")
G.add("etf_holdings", lambda t: V.holdings(V.etf_profiles(t.etf_parts)).withColumn("weight", F.col("weight").cast("double")), "SELECT symbol, holding, description, CAST(weight AS DOUBLE) AS weight FROM etf_parts")
G.add("etf_detail", lambda t: V.etf_detail(V.etf_profiles(t.etf_parts)).withColumn("weight", F.col("weight").cast("double")), """
    SELECT symbol, sector, NULL AS holding, NULL AS description, CAST(sum(weight) AS DOUBLE) AS weight, 'SECTOR' AS detail_type FROM etf_parts GROUP BY symbol, sector
    UNION ALL SELECT symbol, NULL, holding, description, CAST(weight AS DOUBLE), 'HOLDING' FROM etf_parts""")


def call_documents(t: Tables) -> DataFrame:
    segment = F.struct("speaker", "turn", "content")
    docs = t.transcripts.groupBy("conv_id", "symbol", "quarter").agg(F.sort_array(F.collect_list(F.struct("turn", segment.alias("s")))).alias("a"))
    return docs.select(F.to_json(F.struct("symbol", "quarter", F.transform("a", lambda x: x["s"]).alias("transcript"))).alias("doc"))


G.add("transcript_flatten", lambda t: V.transcripts(call_documents(t), "doc").select("symbol", "quarter", "speaker", "turn", F.md5("content").alias("content_md5")), "SELECT symbol, quarter, speaker, turn, md5(content) AS content_md5 FROM transcripts")

# Quality

G.add("dq_required", lambda t: Q.missing(t.insiders, ("symbol", "insider_name", "shares")), """
    SELECT count(*) AS n_rows, count(*) FILTER (symbol IS NULL) AS missing_symbol, count(*) FILTER (insider_name IS NULL) AS missing_insider_name, count(*) FILTER (shares IS NULL) AS missing_shares FROM insiders""")
GAP = "CAST(total_assets - (total_liabilities + total_equity) AS DOUBLE)"
G.add("dq_balance", lambda t: Q.balance(t.statements), f"SELECT period_type, count(*) AS n_rows, count(*) FILTER (abs({GAP}) > 1) AS unbalanced, round(avg(abs({GAP})), 2) AS mean_gap FROM statements GROUP BY period_type")
G.add("dq_balance_worst", lambda t: Q.balance_worst(t.statements), f"""
    SELECT symbol, fiscal_date_ending, period_type, round({GAP}, 2) AS difference FROM statements WHERE abs({GAP}) > 1000 ORDER BY abs(difference) DESC, symbol, fiscal_date_ending, period_type LIMIT 20""")
G.add("dq_date_ranges", lambda t: Q.date_ranges(t.statements), "SELECT period_type, count(*) AS n_rows, count(DISTINCT symbol) AS symbols, min(fiscal_date_ending) AS first_date, max(fiscal_date_ending) AS last_date FROM statements GROUP BY 1")
G.add("dq_duplicates", lambda t: Q.duplicates(t.insiders, ("symbol", "transaction_type", "insider_name")), "SELECT symbol, transaction_type, insider_name, count(*) AS copies FROM insiders GROUP BY 1, 2, 3 HAVING count(*) > 1")
G.add("dq_recency", lambda t: Q.recency(t.statements, day()), f"SELECT period_type, CAST({D} - max(fiscal_date_ending) AS BIGINT) AS days_since_newest FROM statements GROUP BY 1")


def bars(t: Tables) -> DataFrame:
    seq = F.col("seq")
    return t.prices.select("symbol", "date", F.when(seq % 40 == 0, -F.col("close")).otherwise(F.col("close")).alias("close"), (F.col("close") + 1).alias("high"), F.when(seq % 25 == 0, F.col("close") + 2).otherwise(F.col("close") - 1).alias("low"),
                           (F.col("volume") - 500).alias("volume"), F.when(seq % 60 == 0, 2.0).otherwise(1.0).alias("split_coefficient"), F.when(seq % 35 == 0, 0.5).otherwise(0.0).alias("dividend_amount"))


G.add("dq_prices", lambda t: Q.invalid_prices(bars(t)), "SELECT count(*) AS n_rows, count(*) FILTER (seq % 40 = 0) AS bad_close, count(*) FILTER (seq % 25 = 0) AS high_below_low, count(*) FILTER (volume < 500) AS bad_volume FROM prices")
G.add("dq_gaps", lambda t: Q.gaps(t.prices), """
    SELECT symbol, count(*) AS n_rows, CAST(max(date) - min(date) + 1 AS BIGINT) AS span_days, span_days - n_rows AS gap FROM prices GROUP BY symbol HAVING gap > 100 ORDER BY gap DESC, symbol LIMIT 20""")
G.add("dq_events", lambda t: Q.event_counts(bars(t)), """
    SELECT 'SPLIT' AS event, count(*) AS n_rows, count(DISTINCT symbol) AS symbols FROM prices WHERE seq % 60 = 0
    UNION ALL SELECT 'DIVIDEND', count(*), count(DISTINCT symbol) FROM prices WHERE seq % 35 = 0""")
G.add("dq_recent", lambda t: Q.recent(t.prices, day()), f"SELECT max(date) AS newest, CAST({D} - max(date) AS BIGINT) AS age_days, count(DISTINCT CASE WHEN date >= {D} - 7 THEN symbol END) AS symbols_7d FROM prices")
G.add("dq_profile", lambda t: Q.profile(t.prices), "SELECT symbol, count(*) AS days, min(date) AS first_date, max(date) AS last_date, round(avg(CAST(volume AS DOUBLE)), 2) AS avg_volume FROM prices GROUP BY symbol")
G.add("dq_load_summary", lambda t: Q.load_summary(t.statements), """
    SELECT count(*) AS n_rows, count(DISTINCT symbol) AS symbols, count(*) FILTER (period_type = 'annual') AS annual, count(*) FILTER (period_type = 'quarterly') AS quarterly,
        min(fiscal_date_ending) AS first_date, max(fiscal_date_ending) AS last_date FROM statements""")
G.add("dq_share", lambda t: Q.type_share(t.insiders, "transaction_type"), "SELECT transaction_type, count(*) AS n_rows, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS pct FROM insiders GROUP BY 1")
G.add("dq_types_topk", lambda t: Q.top_types(t.insiders, ("transaction_type", "insider_name")), "SELECT transaction_type, insider_name, count(*) AS n_rows FROM insiders GROUP BY 1, 2 ORDER BY n_rows DESC, transaction_type, insider_name NULLS LAST LIMIT 10")
G.add("dq_by_year", lambda t: Q.by_year(t.insiders, "transaction_date", day()), f"""
    SELECT CAST(date_trunc('year', transaction_date) AS DATE) AS year, count(*) AS n_rows, count(DISTINCT symbol) AS symbols, count(*) FILTER (transaction_date >= {D} - 30) AS last_30d FROM insiders GROUP BY 1""")
G.add("dq_field_issues", lambda t: Q.field_issues(t.price_staging.withColumn("volume_text", F.when(F.col("seq") % 31 == 0, "abc").otherwise(F.col("volume_text")))), """
    SELECT count(*) AS n_rows, count(*) FILTER (date_text = '2024-02-30') AS bad_form_date, count(*) FILTER (date_text = '2024-02-30') AS bad_date, 0::BIGINT AS bad_close,
        count(*) FILTER (close_text = '-1.50') AS non_positive_close, count(*) FILTER (seq % 31 = 0) AS bad_volume FROM price_staging""")
G.add("dq_ref_integrity", lambda t: Q.orphans(t.prices, t.listing.where("n % 10 <> 0")), "SELECT count(*) AS orphans FROM prices WHERE symbol NOT IN (SELECT symbol FROM listing WHERE n % 10 <> 0)")
G.add("dq_staging_profile", lambda t: Q.staging_profile(t.overview, ("symbol", "sector", "industry")), "SELECT count(*) AS n_rows, count(DISTINCT symbol) AS distinct_symbol, count(DISTINCT sector) AS distinct_sector, count(DISTINCT industry) AS distinct_industry FROM overview")
CONTRACT = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("date", T.DateType()), T.StructField("close", T.DoubleType()), T.StructField("open", T.DoubleType())])
G.add("dq_schema", lambda t: Q.schema_issues(t.prices, CONTRACT), """
    SELECT v.*, CASE "column" WHEN 'close' THEN (SELECT count(close) FROM prices) WHEN 'seq' THEN (SELECT count(seq) FROM prices) WHEN 'volume' THEN (SELECT count(volume) FROM prices) ELSE 0 END AS n_filled
    FROM (VALUES ('close', 'double', 'decimal(18,4)', 'type'), ('open', 'double', NULL, 'missing'), ('seq', NULL, 'bigint', 'unexpected'), ('volume', NULL, 'decimal(20,0)', 'unexpected')) v("column", expected, found, issue)""")
G.add("dq_id_conflicts", lambda t: Q.id_conflicts(t.insiders, "symbol", "transaction_type"), """
    SELECT symbol, count(DISTINCT transaction_type) AS n_values, string_agg(DISTINCT transaction_type, ', ' ORDER BY transaction_type) AS "values" FROM insiders GROUP BY symbol HAVING count(DISTINCT transaction_type) > 1""")
G.add("dq_stale_block", lambda t: Q.stale_block(t.wm, day()), f"""
    SELECT table_name, count(*) AS total, count(*) FILTER (last_fiscal_date IS NULL) AS never, count(*) FILTER (last_fiscal_date >= {D} - 135) AS too_recent,
        count(*) FILTER (last_fiscal_date IS NULL OR last_fiscal_date < {D} - 135) AS due FROM wm WHERE api_eligible = 'YES' GROUP BY 1""")
G.add("dq_fresh_label", lambda t: Q.fresh_labels(t.overview, day()), f"SELECT CASE WHEN {D} - load_date <= 365 THEN 'FRESH' ELSE 'STALE' END AS label, count(*) AS symbols, min(load_date) AS oldest FROM overview GROUP BY 1")
G.add("dq_history", lambda t: Q.history(t.prices), "SELECT count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date FROM prices")
G.add("universe_screen", lambda t: Q.screen(t.overview, t.prices, t.listing), """
    WITH p AS (SELECT symbol, close AS latest_close FROM prices QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)
    SELECT l.symbol, exchange, sector, market_capitalization, latest_close FROM listing l JOIN overview o ON o.symbol = l.symbol JOIN p ON p.symbol = l.symbol
    WHERE asset_type = 'Stock' AND status = 'Active' AND exchange IN ('NYSE', 'NASDAQ', 'AMEX') AND market_capitalization > 100000000 AND latest_close > 5""")

# Run log

SEC, CLASS = "CAST(elapsed_ms AS DOUBLE) / 1000", "CASE WHEN upper(text) LIKE 'COPY INTO%' THEN 'LOAD' WHEN upper(text) LIKE 'MERGE INTO%' THEN 'MERGE' WHEN upper(text) LIKE 'INSERT INTO%' THEN 'INSERT' WHEN upper(text) LIKE 'SELECT%' THEN 'QUERY' ELSE 'OTHER' END"
HOUR, MB, GB = "strftime(date_trunc('hour', start_ts), '%Y-%m-%d %H')", "1048576.0::DOUBLE", "1073741824.0::DOUBLE"
G.add("log_daily", lambda t: L.daily(t.run_log, run_at()), f"SELECT CAST(start_ts AS DATE) AS day, round(sum(credits), 4) AS credits, round(sum(credits) * 3.0::DOUBLE, 4) AS cost, count(*) AS runs FROM run_log WHERE start_ts >= {R} - INTERVAL 7 DAY GROUP BY 1")
G.add("log_hourly", lambda t: L.hourly(t.run_log), f"SELECT {HOUR} AS hour, count(*) AS runs, round(avg({SEC}), 4) AS avg_seconds, round(sum(credits), 4) AS credits FROM run_log GROUP BY 1 ORDER BY hour DESC LIMIT 24")
G.add("log_ingest", lambda t: L.ingest(t.file_log), f"SELECT CAST(load_ts AS DATE) AS day, pipe, count(*) AS files, CAST(sum(n_rows) AS BIGINT) AS n_rows, round(sum(n_bytes) / {MB}, 4) AS mb FROM file_log GROUP BY 1, 2")
G.add("log_errors", lambda t: L.errors(t.file_log), "SELECT CAST(load_ts AS DATE) AS day, status, count(*) AS n, string_agg(DISTINCT error, '; ' ORDER BY error) AS messages FROM file_log WHERE error IS NOT NULL GROUP BY 1, 2")
G.add("log_error_messages", lambda t: L.error_messages(t.file_log), "SELECT CAST(load_ts AS DATE) AS day, status, error, count(*) AS n FROM file_log WHERE error IS NOT NULL GROUP BY 1, 2, 3")
G.add("log_longest", lambda t: L.longest(t.run_log), f"SELECT run_id, user_name, kind, round({SEC}, 3) AS seconds, CASE WHEN length(text) > 8 THEN left(text, 8) || '...' ELSE text END AS preview FROM run_log ORDER BY seconds DESC, run_id LIMIT 10")
G.add("log_patterns", lambda t: L.patterns(t.run_log), f"SELECT CAST(start_ts AS DATE) AS day, kind, count(*) AS runs, round(avg({SEC}), 4) AS avg_seconds, round(max({SEC}), 4) AS max_seconds FROM run_log GROUP BY 1, 2")
G.add("log_storage", lambda t: L.storage(t.table_stats), f"SELECT schema_name, table_name, n_rows, round(CAST(n_bytes AS DOUBLE) / {GB}, 6) AS gb, round(CAST(n_bytes AS DOUBLE) / {GB} * (23.0::DOUBLE / 1024), 6) AS monthly_cost FROM table_stats")
G.add("log_loads", lambda t: L.loads(t.file_log), f"SELECT table_name, count(DISTINCT file) AS files, CAST(sum(n_rows) AS BIGINT) AS n_rows, round(sum(n_bytes) / {MB}, 4) AS mb, count(*) FILTER (status = 'LOADED') AS loaded, count(*) FILTER (status = 'LOAD_FAILED') AS failed FROM file_log GROUP BY 1")
G.add("log_file_eff", lambda t: L.file_efficiency(t.file_log), "SELECT table_name, round(CAST(sum(n_bytes) AS DOUBLE) / nullif(sum(n_rows), 0), 4) AS bytes_per_row, round(CAST(sum(n_rows) AS DOUBLE) / count(*), 4) AS rows_per_file FROM file_log GROUP BY 1")
G.add("log_cost_rollup", lambda t: L.cost_rollup(t.run_log, t.file_log, t.table_stats, run_at()), f"""
    SELECT *, round(compute_week * 52 / 12, 4) AS compute_month FROM (SELECT round(coalesce(sum(credits), 0) * 3.0::DOUBLE, 4) AS compute_week FROM run_log WHERE start_ts >= {R} - INTERVAL 7 DAY),
        (SELECT count(*) AS files_week FROM file_log WHERE load_ts >= {R} - INTERVAL 7 DAY), (SELECT round(sum(n_bytes) / {GB}, 6) AS gb FROM table_stats)""")
G.add("log_layout_advice", lambda t: L.layout_advice(t.table_stats), """
    SELECT table_name, n_rows, layout_key, CASE WHEN layout_key IS NULL AND n_rows > 1000000 THEN 'CONSIDER' WHEN n_rows < 100000 THEN 'TOO_SMALL' ELSE 'CONFIGURED' END AS advice FROM table_stats""")
G.add("log_slow_advice", lambda t: L.slow_advice(t.run_log), f"""
    SELECT *, CASE WHEN avg_seconds > 60 THEN 'OPTIMISE' WHEN max_seconds > 300 THEN 'CHECK_OUTLIERS' ELSE 'OK' END AS advice FROM (SELECT kind, round(avg({SEC}), 4) AS avg_seconds, round(max({SEC}), 4) AS max_seconds FROM run_log GROUP BY kind)""")
G.add("log_hour_cost", lambda t: L.hour_cost(t.run_log), f"""
    SELECT {HOUR} AS hour, count(*) AS runs, round(sum(credits), 4) AS credits, round(sum(credits) * 3.0::DOUBLE, 4) AS cost, round(avg(credits), 4) AS avg_credits, round(sum({SEC}), 3) AS seconds FROM run_log GROUP BY 1""")
TOP = f"SELECT run_id, user_name, kind, {CLASS} AS class, round(credits, 4) AS credits, round(credits * 3.0::DOUBLE, 4) AS cost, CASE WHEN length(text) > 12 THEN left(text, 12) || '...' ELSE text END AS preview FROM run_log l WHERE l.credits > {{}} ORDER BY l.credits DESC, run_id LIMIT {{}}"
G.add("log_top_cost", lambda t: L.top_cost(t.run_log), TOP.format(0, 20))
G.add("log_top_detail", lambda t: L.top_cost(t.run_log, 0.1, 50), TOP.format(0.1, 50))
G.add("log_by_class", lambda t: L.by_class(t.run_log), f"SELECT {CLASS} AS class, count(*) AS runs, round(sum(credits), 4) AS credits, round(avg(credits), 4) AS avg_credits, round(avg({SEC}), 4) AS avg_seconds FROM run_log GROUP BY 1")
G.add("log_loads_by_class", lambda t: L.loads_by_class(t.run_log), f"SELECT CAST(start_ts AS DATE) AS day, {CLASS} AS class, count(*) AS runs, round(sum(credits), 4) AS credits, round(avg(credits), 4) AS avg_credits, round(avg({SEC}), 4) AS avg_seconds FROM run_log WHERE {CLASS} IN ('LOAD', 'MERGE', 'INSERT') GROUP BY 1, 2")
G.add("log_resume", lambda t: L.resumes(t.run_log, "signup", "view"), "SELECT CAST(start_ts AS DATE) AS day, user_name, count(*) FILTER (kind = 'signup') AS resumes, count(*) FILTER (kind = 'view') AS suspends FROM run_log GROUP BY 1, 2 HAVING resumes + suspends >= 5")
G.add("log_text_match", lambda t: L.text_match(t.table_stats, t.run_log), """
    SELECT table_name, n_rows, (SELECT count(*) FROM run_log WHERE text LIKE '%' || table_name || '%') AS runs,
        round(coalesce((SELECT sum(credits) FROM run_log WHERE text LIKE '%' || table_name || '%'), 0), 4) AS credits FROM table_stats""")
G.add("log_daily_cost", lambda t: L.daily_cost(t.run_log), f"SELECT CAST(start_ts AS DATE) AS day, count(*) AS runs, round(sum({SEC}) / 3600, 4) AS hours, round(sum(bytes_read) / {GB}, 6) AS gb_read, round(sum(credits) * 3.0::DOUBLE, 4) AS cost FROM run_log GROUP BY 1")
EFF = "SELECT '{}' AS class, round(sum(credits), 4) AS credits, round(sum(bytes_written) / " + GB + ", 6) AS gb_written, round(sum(credits) / nullif(sum(bytes_written) / " + GB + ", 0), 2) AS credits_per_gb FROM run_log WHERE " + CLASS + " {} ('LOAD', 'MERGE', 'INSERT')"
G.add("log_efficiency", lambda t: L.efficiency(t.run_log), EFF.format("LOADS", "IN") + " UNION ALL " + EFF.format("OTHERS", "NOT IN"))
G.add("log_hours_rate", lambda t: L.hours_rate(t.run_log), "SELECT day, round(h, 4) AS hours, round(h * 3.0::DOUBLE, 4) AS cost FROM (SELECT CAST(start_ts AS DATE) AS day, CAST(sum(date_diff('second', start_ts, end_ts)) AS DOUBLE) / 3600 AS h FROM run_log WHERE end_ts IS NOT NULL GROUP BY 1)")
G.add("log_long_sessions", lambda t: L.long_sessions(t.run_log), "SELECT run_id, user_name, date_diff('minute', start_ts, end_ts) AS minutes FROM run_log WHERE date_diff('minute', start_ts, end_ts) > 30")
G.add("log_unfinished", lambda t: L.unfinished(t.run_log, run_at()), f"SELECT run_id, user_name, kind, date_diff('hour', start_ts, {R}) AS open_hours FROM run_log WHERE end_ts IS NULL AND start_ts < {R} - INTERVAL 1 HOUR")
G.add("log_status_share", lambda t: Q.share_within(t.run_log, "kind", "status"), "SELECT kind, status, count(*) AS n_rows, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY kind), 2) AS pct FROM run_log GROUP BY 1, 2")
