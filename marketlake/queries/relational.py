"""Relational and scalar building blocks over listing, prices and the control table, and incremental ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.functions import scalar as S
from marketlake.operators import merge
from marketlake.operators.coverage import by_source
from marketlake.operators.runlog import operation
from marketlake.plans.loads import prepare
from marketlake.plans.scratch import scratch
from marketlake.plans.store import TableStore
from marketlake.queries.ingest import staged
from marketlake.queries.inputs import AS_OF, day, run_at
from marketlake.queries.registry import Group, Tables
from marketlake.streaming.incremental import ingest

G = Group()
D = f"DATE '{AS_OF}'"

G.add("rel_project_case", lambda t: t.listing.select(
    F.col("symbol").alias("ticker"), F.lit("US").alias("country"),
    F.when(F.col("asset_type") == "ETF", F.when(F.col("status") == "Active", "live fund").otherwise("closed fund")).when(F.col("asset_type") == "Stock", "stock").otherwise("?").alias("kind"),
    F.coalesce("delisting_date", "ipo_date", F.lit("1900-01-01").cast("date")).alias("known_date"), F.nullif("exchange", F.lit("BATS")).alias("exchange"),
), """SELECT symbol AS ticker, 'US' AS country, CASE WHEN asset_type = 'ETF' THEN CASE WHEN status = 'Active' THEN 'live fund' ELSE 'closed fund' END WHEN asset_type = 'Stock' THEN 'stock' ELSE '?' END AS kind,
    coalesce(delisting_date, ipo_date, DATE '1900-01-01') AS known_date, nullif(exchange, 'BATS') AS exchange FROM listing""")  # fmt: skip
G.add("rel_filters", lambda t: t.wm.where(
    F.col("symbol").isNotNull() & F.col("last_fiscal_date").isNotNull() & F.col("table_name").isin("BALANCE_SHEET", "CASH_FLOW") & ~F.upper("exchange").isin("BATS") & (F.upper("status") == "ACTIVE")
    & ~F.col("symbol").isin("#NAME?", "") & S.older_than(F.col("last_fiscal_date"), day(), 90)
).select("table_name", "symbol", "last_fiscal_date"), f"""
    SELECT table_name, symbol, last_fiscal_date FROM wm WHERE symbol IS NOT NULL AND last_fiscal_date IS NOT NULL AND table_name IN ('BALANCE_SHEET', 'CASH_FLOW') AND upper(exchange) NOT IN ('BATS')
    AND upper(status) = 'ACTIVE' AND symbol NOT IN ('#NAME?', '') AND (last_fiscal_date IS NULL OR last_fiscal_date < {D} - 90)""")  # fmt: skip
G.add("rel_like_class", lambda t: t.run_log.select("run_id", operation(F.col("text")).alias("class"), F.contains(F.col("text"), F.lit("T3")).alias("names_t3")), """
    SELECT run_id, CASE WHEN upper(text) LIKE 'COPY INTO%' THEN 'LOAD' WHEN upper(text) LIKE 'MERGE INTO%' THEN 'MERGE' WHEN upper(text) LIKE 'INSERT INTO%' THEN 'INSERT' WHEN upper(text) LIKE 'SELECT%' THEN 'QUERY' ELSE 'OTHER' END AS class,
        contains(text, 'T3') AS names_t3 FROM run_log""")
G.add("rel_time_filter", lambda t: t.prices.where(F.col("date") >= F.date_sub(day(), 90)).select("symbol", "date", F.date_add("date", 30).alias("plus_30"), F.add_months("date", -2).alias("minus_2m")), f"""
    SELECT symbol, date, date + 30 AS plus_30, CAST(date - INTERVAL 2 MONTH AS DATE) AS minus_2m FROM prices WHERE date >= {D} - 90""")
G.add("rel_having_alias", lambda t: t.prices.groupBy("symbol").agg(F.count("*").alias("n"), F.datediff(F.max("date"), F.min("date")).cast("long").alias("span")).withColumn("per_row", F.round(F.col("span") / F.col("n").cast("double"), 4)).where("n > 5 AND per_row > 100"), """
    SELECT symbol, count(*) AS n, CAST(max(date) - min(date) AS BIGINT) AS span, round(CAST(span AS DOUBLE) / n, 4) AS per_row FROM prices GROUP BY symbol HAVING n > 5 AND per_row > 100""")
G.add("rel_distinct", lambda t: t.wm.select("table_name", "exchange", "api_eligible").distinct(), "SELECT DISTINCT table_name, exchange, api_eligible FROM wm")


def with_params(spark: SparkSession, t: Tables) -> DataFrame:
    """A SQL statement with named parameters."""
    return spark.sql("SELECT symbol, date, close FROM {prices} WHERE close > :least AND date < CAST(:until AS DATE)", args={"least": 300000, "until": AS_OF}, prices=t.prices)


G.add_spark("rel_params", with_params, f"SELECT symbol, date, close FROM prices WHERE close > 300000 AND date < {D}")


def star(t: Tables) -> DataFrame:
    """Listing with two sources of the control table and the latest price: one pass over the control table."""
    w = by_source(t.wm, balance=("BALANCE_SHEET", "api_eligible"), cash=("CASH_FLOW", "api_eligible"))
    p = t.prices.groupBy("symbol").agg(F.max("date").alias("last_price"))
    return t.listing.select("symbol").join(w, "symbol", "left").join(p, "symbol", "left")


G.add("rel_star_left", star, """
    SELECT l.symbol, b.api_eligible AS balance, c.api_eligible AS cash, last_price FROM listing l LEFT JOIN wm b ON b.symbol = l.symbol AND b.table_name = 'BALANCE_SHEET'
    LEFT JOIN wm c ON c.symbol = l.symbol AND c.table_name = 'CASH_FLOW' LEFT JOIN (SELECT symbol, max(date) AS last_price FROM prices GROUP BY 1) p ON p.symbol = l.symbol""")
G.add("rel_agg_join", lambda t: t.prices.groupBy("symbol").agg(F.count("*").alias("n_prices")).join(t.insiders.groupBy("symbol").agg(F.count("*").alias("n_insiders")), "symbol", "left"), """
    SELECT p.symbol, n_prices, n_insiders FROM (SELECT symbol, count(*) AS n_prices FROM prices GROUP BY 1) p LEFT JOIN (SELECT symbol, count(*) AS n_insiders FROM insiders GROUP BY 1) i ON i.symbol = p.symbol""")
G.add("rel_anti", lambda t: t.wm.where("table_name = 'BALANCE_SHEET' AND api_eligible = 'YES'").select("symbol").join(t.wm.where("table_name = 'CASH_FLOW' AND last_fiscal_date IS NOT NULL").select("symbol"), "symbol", "left_anti"), """
    SELECT symbol FROM wm a WHERE table_name = 'BALANCE_SHEET' AND api_eligible = 'YES' AND NOT EXISTS (SELECT 1 FROM wm b WHERE b.symbol = a.symbol AND b.table_name = 'CASH_FLOW' AND b.last_fiscal_date IS NOT NULL)""")


def multikey(t: Tables) -> DataFrame:
    left = t.insiders.where("seq % 2 = 0").select("symbol", "transaction_type", "insider_name", "seq")
    right = t.insiders.where("seq % 2 = 1").select("symbol", "transaction_type", "insider_name").distinct()
    keys = ["symbol", "transaction_type", "insider_name"]
    return left.alias("t").join(right.alias("s"), merge.matches(keys), "inner").select("t.symbol", "t.transaction_type", "t.insider_name", "t.seq")


G.add("rel_multikey_match", multikey, """
    SELECT symbol, transaction_type, insider_name, seq FROM insiders t WHERE seq % 2 = 0 AND EXISTS (SELECT 1 FROM insiders s WHERE s.seq % 2 = 1 AND s.symbol = t.symbol
        AND s.transaction_type = t.transaction_type AND s.insider_name IS NOT DISTINCT FROM t.insider_name)""")
G.add("rel_lateral", lambda t: t.listing.select("symbol", F.explode(F.split("name", " ")).alias("word")).where("word <> 'Company'"), "SELECT symbol, CAST(n AS STRING) AS word FROM listing")
G.add("rel_agg_basic", lambda t: t.prices.groupBy(F.year("date").cast("long").alias("year")).agg(F.count("*").alias("n"), F.sum("close").cast("double").alias("total"), F.round(F.avg(F.col("close").cast("double")), 4).alias("mean"), F.min("close").cast("double").alias("low"), F.max("close").cast("double").alias("high")), """
    SELECT year(date) AS year, count(*) AS n, CAST(sum(close) AS DOUBLE) AS total, round(avg(CAST(close AS DOUBLE)), 4) AS mean, CAST(min(close) AS DOUBLE) AS low, CAST(max(close) AS DOUBLE) AS high FROM prices GROUP BY 1""")
G.add("rel_cond_agg", lambda t: t.wm.groupBy("exchange").agg(F.count(F.when(F.col("api_eligible") == "YES", 1)).alias("n_yes"), F.sum(F.when(F.col("consecutive_failures") > 3, 1).otherwise(0)).alias("n_failing")), """
    SELECT exchange, count(CASE WHEN api_eligible = 'YES' THEN 1 END) AS n_yes, CAST(sum(CASE WHEN consecutive_failures > 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_failing FROM wm GROUP BY 1""")
G.add("rel_distinct_counts", lambda t: t.wm.groupBy("exchange").agg(F.countDistinct("symbol").alias("symbols"), F.countDistinct("table_name").alias("sources")), "SELECT exchange, count(DISTINCT symbol) AS symbols, count(DISTINCT table_name) AS sources FROM wm GROUP BY 1")
G.add("rel_ratio", lambda t: t.file_log.groupBy("pipe").agg(S.ratio(F.sum("n_bytes"), F.nullif(F.sum("n_rows"), F.lit(0))).alias("bytes_per_row"), S.share(F.count_if(F.col("status") == "LOADED"), F.count("*")).alias("loaded_pct")), """
    SELECT pipe, round(CAST(sum(n_bytes) AS DOUBLE) / nullif(sum(n_rows), 0), 4) AS bytes_per_row, round(count(*) FILTER (status = 'LOADED') * 100.0::DOUBLE / count(*), 2) AS loaded_pct FROM file_log GROUP BY 1""")
G.add("rel_dup_groups", lambda t: t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("d")).count().where("count > 1").select("o_custkey", "d", F.col("count").alias("copies")), "SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, count(*) AS copies FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
G.add("rel_qualify", lambda t: t.statements.withColumn("rn", F.row_number().over(Window.partitionBy("symbol", "period_type").orderBy(F.col("fiscal_date_ending").desc()))).where("rn = 1").select("symbol", "period_type", "fiscal_date_ending"), """
    SELECT symbol, period_type, fiscal_date_ending FROM statements QUALIFY row_number() OVER (PARTITION BY symbol, period_type ORDER BY fiscal_date_ending DESC) = 1""")


def ranked(t: Tables) -> DataFrame:
    """Sort orders made visible as places within each exchange."""
    w = lambda *o: F.row_number().over(Window.partitionBy("exchange").orderBy(*o, "symbol")).cast("long")
    return t.listing.select(
        "symbol", w(F.col("delisting_date").desc_nulls_first()).alias("nulls_first"), w(F.col("delisting_date").desc_nulls_last()).alias("nulls_last"), w(F.abs(F.col("n") - 500).asc()).alias("by_expression")
    ).orderBy(F.col("nulls_last"), "symbol")


G.add("rel_sort_nulls", ranked, """
    SELECT symbol, row_number() OVER (PARTITION BY exchange ORDER BY delisting_date DESC NULLS FIRST, symbol) AS nulls_first,
        row_number() OVER (PARTITION BY exchange ORDER BY delisting_date DESC NULLS LAST, symbol) AS nulls_last,
        row_number() OVER (PARTITION BY exchange ORDER BY abs(n - 500), symbol) AS by_expression FROM listing""")
G.add("rel_topk", lambda t: t.prices.select("symbol", "date", "close").orderBy(F.col("close").desc(), "symbol", "date").limit(25), "SELECT symbol, date, close FROM prices ORDER BY close DESC, symbol, date LIMIT 25")
G.add("rel_union_aggs", lambda t: t.prices.agg(F.lit("prices").alias("kind"), F.count("*").alias("n")).unionByName(t.insiders.agg(F.lit("insiders").alias("kind"), F.count("*").alias("n"))), """
    SELECT 'prices' AS kind, count(*) AS n FROM prices UNION ALL SELECT 'insiders', count(*) FROM insiders""")

# Scalars

G.add("fn_casts", lambda t: t.price_staging.select(
    "seq", S.to_decimal(F.concat("close_text", F.lit("5e1")), 18, 2).alias("rounded"), S.to_decimal(F.col("close_text"), 7, 2).alias("narrow"), S.to_double(F.col("close_text")).alias("as_double"), S.to_date(F.col("date_text")).alias("as_date"), F.col("seq").cast("string").alias("as_text"),
), """SELECT seq, TRY_CAST(close_text || '5e1' AS DECIMAL(18,2)) AS rounded, TRY_CAST(close_text AS DECIMAL(7,2)) AS narrow, TRY_CAST(close_text AS DOUBLE) AS as_double,
    TRY_CAST(CASE WHEN date_text <> '' THEN date_text END AS DATE) AS as_date, CAST(seq AS STRING) AS as_text FROM price_staging""")  # fmt: skip
G.add("fn_datediff", lambda t: t.run_log.select(
    "run_id", S.days_between(F.col("start_ts"), run_at()).cast("long").alias("days"), S.units_between("hour", F.col("start_ts"), F.col("end_ts")).alias("hours"), S.units_between("minute", F.col("start_ts"), F.col("end_ts")).alias("minutes"), S.units_between("second", F.col("start_ts"), F.col("end_ts")).alias("seconds"),
), """SELECT run_id, date_diff('day', start_ts, TIMESTAMP '2024-01-31 00:00:00') AS days, date_diff('hour', start_ts, end_ts) AS hours, date_diff('minute', start_ts, end_ts) AS minutes, date_diff('second', start_ts, end_ts) AS seconds FROM run_log""")
G.add("fn_trunc", lambda t: t.run_log.select("run_id", F.to_date("start_ts").alias("day"), F.trunc("start_ts", "month").alias("month"), F.date_format(F.date_trunc("minute", "start_ts"), "yyyy-MM-dd HH:mm").alias("minute"), day().alias("as_of")), f"""
    SELECT run_id, CAST(start_ts AS DATE) AS day, CAST(date_trunc('month', start_ts) AS DATE) AS month, strftime(date_trunc('minute', start_ts), '%Y-%m-%d %H:%M') AS minute, {D} AS as_of FROM run_log""")
G.add("fn_strings", lambda t: t.listing.select(
    "symbol", F.left("symbol", F.lit(4)).alias("l"), F.right("symbol", F.lit(3)).alias("r"), S.preview(F.col("symbol"), 10).alias("p"), F.upper("status").alias("u"), F.col("symbol").like("%7").alias("seven"), F.concat("exchange", F.lit(":"), "symbol").alias("full"), F.split_part("symbol", F.lit("#"), F.lit(2)).alias("part"), F.replace("symbol", F.lit("#"), F.lit("-")).alias("dash"),
), """SELECT symbol, left(symbol, 4) AS l, right(symbol, 3) AS r, CASE WHEN length(symbol) > 10 THEN left(symbol, 10) || '...' ELSE symbol END AS p, upper(status) AS u, symbol LIKE '%7' AS seven,
    exchange || ':' || symbol AS "full", split_part(symbol, '#', 2) AS part, replace(symbol, '#', '-') AS dash FROM listing""")  # fmt: skip
G.add("fn_math", lambda t: t.run_log.select("run_id", F.abs(F.col("run_id") - 500).alias("distance"), (F.col("run_id") % 7).alias("m"), F.round(F.col("bytes_read") / 1048576.0, 4).alias("mb"), F.round(F.col("elapsed_ms") / 3600000.0, 4).alias("hours"), F.round(F.col("credits") * 3.0, 2).alias("usd")), """
    SELECT run_id, abs(run_id - 500) AS distance, run_id % 7 AS m, round(bytes_read / 1048576.0::DOUBLE, 4) AS mb, round(elapsed_ms / 3600000.0::DOUBLE, 4) AS hours, round(credits * 3.0::DOUBLE, 2) AS usd FROM run_log""")


def incremental_upsert(spark: SparkSession, t: Tables) -> DataFrame:
    """Two rounds of landed files through the stream, the second with files of another header that repeat and replace rows of the first."""
    path, check = scratch(spark, "landing"), scratch(spark, "stream")
    store = TableStore(spark, scratch(spark, "store"))
    rows = staged(t)
    typed = lambda batch: prepare(batch.withColumn("seq", F.col("seq").cast("long")), "TIME_SERIES_DAILY_ADJUSTED", "seq").select("symbol", "date", "close", "volume", "seq")
    other = ["seq", "volume", "symbol", "close", "date"]
    for part, columns in (("seq % 2 = 0", rows.columns), ("seq % 2 = 1", other)):
        rows.where(part).select(*columns).write.mode("append").option("header", True).csv(path)
        ingest(spark, path, rows.columns, store, "prices", ["symbol", "date"], check, typed)
    return store.read("prices").select("symbol", "date", "close", "volume")


G.add_spark("incremental_upsert", incremental_upsert, """
    WITH x AS (SELECT symbol, TRY_CAST(CASE WHEN date_text IN ('None', '') THEN NULL ELSE date_text END AS DATE) AS date, TRY_CAST(close_text AS DECIMAL(18,4)) AS close, TRY_CAST(volume_text AS DECIMAL(20,0)) AS volume, seq FROM price_staging)
    SELECT symbol, date, close, volume FROM x WHERE date IS NOT NULL AND close > 0 QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY seq % 2 DESC, seq DESC) = 1""")
