"""Merge family and table store."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import merge
from marketlake.plans import loads
from marketlake.plans.scratch import scratch
from marketlake.plans.store import TableStore
from marketlake.queries.ingest import staged
from marketlake.queries.inputs import AS_OF, day
from marketlake.queries.registry import Group, Tables

G = Group()


def prices_upsert(t: Tables) -> DataFrame:
    """An older table takes a newer batch that overlaps it."""
    name = "TIME_SERIES_DAILY_ADJUSTED"
    old = loads.prepare(staged(t).where("seq % 3 <> 0"), name, "seq")
    return loads.load(old, staged(t).where("seq % 2 = 0"), name, "seq").select("symbol", "date", "close", "volume")


TYPED = """
    x AS (SELECT symbol, TRY_CAST(CASE WHEN date_text IN ('None', '') THEN NULL ELSE date_text END AS DATE) AS date,
        TRY_CAST(close_text AS DECIMAL(18,4)) AS close, TRY_CAST(volume_text AS DECIMAL(20,0)) AS volume, seq FROM price_staging),
    ok AS (SELECT * FROM x WHERE symbol IS NOT NULL AND date IS NOT NULL AND close > 0)"""
G.add("prices_upsert", prices_upsert, f"""
    WITH {TYPED},
    s AS (SELECT * FROM ok WHERE seq % 2 = 0 QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY seq DESC) = 1),
    t AS (SELECT * FROM ok WHERE seq % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY seq DESC) = 1)
    SELECT symbol, date, close, volume FROM s
    UNION ALL SELECT symbol, date, close, volume FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.symbol = t.symbol AND s.date = t.date)""")
KEYS = ["symbol", "fiscal_date_ending", "period_type"]
G.add(
    "statement_upsert",
    lambda t: merge.merge_upsert(
        t.statements.where("n_lines % 2 = 0").select(*KEYS, "total_assets"),
        merge.latest(t.statements.where("n_lines % 3 = 0").select(*KEYS, (F.col("total_assets") + 1).cast("decimal(38,2)").alias("total_assets")), KEYS, "total_assets"),
        KEYS,
    ),
    """SELECT symbol, fiscal_date_ending, period_type, total_assets + CASE WHEN n_lines % 3 = 0 THEN 1 ELSE 0 END AS total_assets
    FROM statements WHERE n_lines % 2 = 0 OR n_lines % 3 = 0""",
)


def listing_upsert(t: Tables) -> DataFrame:
    """Listings from an active and delisted files: the active file's row is preferred, else the smallest file's."""
    rows = t.listing.select("symbol", "name", "status", F.explode(F.when(F.col("n") % 4 == 0, F.array(F.lit("delisted_b.csv"), F.lit("delisted_a.csv"))).when(F.col("n") % 4 == 1, F.array(F.lit("delisted_a.csv"), F.lit("listing_active.csv"))).otherwise(F.array(F.lit("listing_active.csv")))).alias("file"))
    source = merge.preferred_file(rows, "symbol", "file", "active").where("symbol <> '#NAME?'")
    target = t.listing.where("n % 5 = 0").select("symbol", "name", F.lit("OLD").alias("status"), F.lit("old.csv").alias("file"))
    return merge.merge_upsert(target, source, ["symbol"])


G.add("listing_upsert", listing_upsert, "SELECT symbol, name, status, CASE WHEN n % 4 = 0 THEN 'delisted_a.csv' ELSE 'listing_active.csv' END AS file FROM listing")


def indicator_upsert(t: Tables) -> DataFrame:
    """Null maturity is a key value like any other; only value and load date of matched rows change."""
    rows = t.orders.select(F.concat(F.lit("I"), F.col("o_custkey") % 20).alias("indicator_name"), F.when(F.col("o_custkey") % 20 > 4, F.concat(F.col("o_custkey") % 3, F.lit("y"))).alias("maturity"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("date"), F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("run_id"))
    keys = ["indicator_name", "maturity", "date"]
    pick = lambda c: merge.dedupe(rows.where(c), keys, F.col("run_id").desc())
    old = pick("run_id % 2 = 0").withColumn("load_date", F.lit("2001-01-01").cast("date"))
    new = pick("run_id % 2 = 1").withColumn("load_date", day())
    return merge.merge_partial(old, new, keys, ["value", "load_date"])


G.add("indicator_upsert_nullsafe", indicator_upsert, f"""
    WITH r AS (SELECT concat('I', o_custkey % 20) AS indicator_name, CASE WHEN o_custkey % 20 > 4 THEN concat(o_custkey % 3, 'y') END AS maturity,
        CAST(date_trunc('month', o_orderdate) AS DATE) AS date, o_totalprice AS value, o_orderkey AS run_id FROM orders),
    o AS (SELECT * FROM r WHERE run_id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY indicator_name, maturity, date ORDER BY run_id DESC) = 1),
    n AS (SELECT * FROM r WHERE run_id % 2 = 1 QUALIFY row_number() OVER (PARTITION BY indicator_name, maturity, date ORDER BY run_id DESC) = 1)
    SELECT coalesce(o.indicator_name, n.indicator_name) AS indicator_name, coalesce(o.maturity, n.maturity) AS maturity, coalesce(o.date, n.date) AS date,
        CASE WHEN n.run_id IS NOT NULL THEN n.value ELSE o.value END AS value, coalesce(o.run_id, n.run_id) AS run_id,
        CASE WHEN n.run_id IS NOT NULL THEN DATE '{AS_OF}' ELSE DATE '2001-01-01' END AS load_date
    FROM o FULL JOIN n ON o.indicator_name = n.indicator_name AND o.maturity IS NOT DISTINCT FROM n.maturity AND o.date = n.date""")
INSIDER = ["symbol", "transaction_date", "insider_name", "transaction_type"]
G.add(
    "insider_insert_only",
    lambda t: merge.insert_only(t.insiders.where("seq % 2 = 0"), merge.dedupe(t.insiders, INSIDER, F.col("seq").asc()), INSIDER).select(*INSIDER, "seq"),
    """WITH t AS (SELECT * FROM insiders WHERE seq % 2 = 0),
    s AS (SELECT * FROM insiders QUALIFY row_number() OVER (PARTITION BY symbol, transaction_date, insider_name, transaction_type ORDER BY seq) = 1)
    SELECT symbol, transaction_date, insider_name, transaction_type, seq FROM t
    UNION ALL SELECT symbol, transaction_date, insider_name, transaction_type, seq FROM s
    WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.symbol = s.symbol AND t.transaction_date = s.transaction_date
        AND t.insider_name IS NOT DISTINCT FROM s.insider_name AND t.transaction_type = s.transaction_type)""",
)


def content() -> dict:
    return {"s": F.col("symbol"), "q": F.col("quarter"), "p": F.col("speaker"), "l": F.left("content", F.lit(50)), "r": F.right("content", F.lit(50))}


G.add(
    "transcript_insert_only",
    lambda t: merge.insert_only(t.transcripts.where("conv_id % 2 = 0"), t.transcripts, content()).select("symbol", "quarter", "speaker", F.md5("content").alias("content_md5")),
    """WITH k AS (SELECT *, left(content, 50) AS l, right(content, 50) AS r FROM transcripts),
    t AS (SELECT * FROM k WHERE conv_id % 2 = 0),
    s AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY symbol, quarter, speaker, l, r ORDER BY symbol, quarter, speaker NULLS LAST, turn, content, conv_id) = 1)
    SELECT symbol, quarter, speaker, md5(content) AS content_md5 FROM t UNION ALL
    SELECT symbol, quarter, speaker, md5(content) FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.symbol = s.symbol AND t.quarter = s.quarter
        AND t.speaker IS NOT DISTINCT FROM s.speaker AND t.l IS NOT DISTINCT FROM s.l AND t.r IS NOT DISTINCT FROM s.r)""",
)


def state(t: Tables) -> DataFrame:
    return t.wm.select("table_name", "symbol", "api_eligible", "first_fiscal_date", "last_fiscal_date", "consecutive_failures", "n")


G.add(
    "update_only",
    lambda t: merge.update_from(state(t), t.prices.groupBy("symbol").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).withColumn("table_name", F.lit("TIME_SERIES_DAILY_ADJUSTED")), ["table_name", "symbol"], {"first_fiscal_date": F.coalesce(F.col("s.lo"), F.col("t.first_fiscal_date")), "last_fiscal_date": F.col("s.hi")}),
    """WITH a AS (SELECT symbol, min(date) AS lo, max(date) AS hi FROM prices GROUP BY symbol)
    SELECT table_name, wm.symbol, api_eligible, CASE WHEN a.symbol IS NOT NULL THEN coalesce(lo, first_fiscal_date) ELSE first_fiscal_date END AS first_fiscal_date,
        CASE WHEN a.symbol IS NOT NULL THEN hi ELSE last_fiscal_date END AS last_fiscal_date, consecutive_failures, n
    FROM wm LEFT JOIN a ON wm.symbol = a.symbol AND table_name = 'TIME_SERIES_DAILY_ADJUSTED'""",
)
G.add(
    "update_from",
    lambda t: merge.update_from(state(t), t.insiders.groupBy("symbol").agg(F.max("transaction_date").alias("d"), F.count("*").alias("c")).withColumn("table_name", F.lit("INSIDER_TRANSACTIONS")), ["table_name", "symbol"], {"last_fiscal_date": F.col("s.d"), "consecutive_failures": F.lit(0)}),
    """WITH a AS (SELECT symbol, max(transaction_date) AS d FROM insiders GROUP BY symbol)
    SELECT table_name, wm.symbol, api_eligible, first_fiscal_date, CASE WHEN a.symbol IS NOT NULL THEN d ELSE last_fiscal_date END AS last_fiscal_date,
        CASE WHEN a.symbol IS NOT NULL THEN 0 ELSE consecutive_failures END AS consecutive_failures, n
    FROM wm LEFT JOIN a ON wm.symbol = a.symbol AND table_name = 'INSIDER_TRANSACTIONS'""",
)
G.add(
    "predicate_update",
    lambda t: merge.update_where(state(t), (F.col("table_name") == "CASH_FLOW") & (F.col("consecutive_failures") > 5), {"consecutive_failures": F.col("consecutive_failures") + 1, "api_eligible": F.when(F.col("n") % 2 == 0, "SUS").otherwise(F.col("api_eligible"))}),
    """SELECT table_name, symbol, CASE WHEN hit AND n % 2 = 0 THEN 'SUS' ELSE api_eligible END AS api_eligible, first_fiscal_date, last_fiscal_date,
        consecutive_failures + CASE WHEN hit THEN 1 ELSE 0 END AS consecutive_failures, n
    FROM (SELECT *, coalesce(table_name = 'CASH_FLOW' AND consecutive_failures > 5, false) AS hit FROM wm)""",
)
G.add(
    "keyed_update",
    lambda t: merge.update_from(state(t), t.listing.where("n % 9 = 0").select("symbol").withColumn("table_name", F.lit("ETF_PROFILE")), ["table_name", "symbol"], {"api_eligible": F.lit("DEL")}),
    """SELECT table_name, symbol, CASE WHEN table_name = 'ETF_PROFILE' AND n % 9 = 0 THEN 'DEL' ELSE api_eligible END AS api_eligible,
        first_fiscal_date, last_fiscal_date, consecutive_failures, n FROM wm""",
)
G.add("predicate_delete", lambda t: merge.delete_where(state(t), F.col("consecutive_failures") > 6), "SELECT table_name, symbol, api_eligible, first_fiscal_date, last_fiscal_date, consecutive_failures, n FROM wm WHERE consecutive_failures IS NULL OR consecutive_failures <= 6")
G.add(
    "dedupe_latest",
    lambda t: merge.dedupe(t.insiders, ["symbol", "transaction_type"], F.col("transaction_date").desc(), F.col("seq").desc()).select("symbol", "transaction_type", "transaction_date", "seq"),
    "SELECT symbol, transaction_type, transaction_date, seq FROM insiders QUALIFY row_number() OVER (PARTITION BY symbol, transaction_type ORDER BY transaction_date DESC, seq DESC) = 1",
)
G.add("stamp_metadata", lambda t: merge.stamp(t.listing.select("symbol"), day()), f"SELECT symbol, {{symbol_id:symbol}} AS symbol_id, DATE '{AS_OF}' AS load_date FROM listing")
G.add("bulk_dedupe", lambda t: merge.latest(t.insiders.select(*INSIDER, "seq"), ["symbol", "transaction_type"], "transaction_date", "seq"), "SELECT symbol, transaction_date, insider_name, transaction_type, seq FROM insiders QUALIFY row_number() OVER (PARTITION BY symbol, transaction_type ORDER BY transaction_date DESC, seq DESC) = 1")


def full_refresh(spark: SparkSession, t: Tables) -> DataFrame:
    store = TableStore(spark, scratch(spark, "refresh"))
    store.overwrite("commodities", t.prices.where("seq % 2 = 0").select("symbol", "date", "close"))
    store.overwrite("commodities", t.prices.where("seq % 2 = 1").select("symbol", "date", "close"))
    return store.read("commodities")


def store_roundtrip(spark: SparkSession, t: Tables) -> DataFrame:
    """A partitioned, sorted table; one partition upserted, then rows appended."""
    store = TableStore(spark, scratch(spark, "store"))
    rows = t.insiders.select("symbol", "transaction_type", "seq", "shares")
    store.overwrite("insiders", rows.where("seq % 2 = 0"), "transaction_type", ["symbol", "seq"])
    store.upsert("insiders", rows.where("seq % 3 = 0 AND transaction_type = 'A'").withColumn("shares", (F.col("shares") + 1).cast("decimal(18,4)")), ["transaction_type", "symbol", "seq"], "transaction_type", ["symbol", "seq"])
    store.append("insiders", rows.where("seq % 6 = 1"))
    out = store.read("insiders")
    view = f"insiders_{uuid.uuid4().hex}"
    out.createOrReplaceTempView(view)
    return spark.table(view).select("symbol", "transaction_type", "seq", "shares")


G.add_spark("full_refresh", full_refresh, "SELECT symbol, date, close FROM prices WHERE seq % 2 = 1")
G.add_spark("store_roundtrip", store_roundtrip, """
    SELECT symbol, transaction_type, seq, shares + CASE WHEN seq % 3 = 0 AND transaction_type = 'A' THEN 1 ELSE 0 END AS shares FROM insiders
    WHERE seq % 2 = 0 OR (seq % 3 = 0 AND transaction_type = 'A') OR seq % 6 = 1""")
G.add(
    "run_record",
    lambda t: t.run_log.groupBy(F.col("kind").alias("source")).agg(F.count("*").alias("total"), F.count_if(F.col("status") == "OK").alias("succeeded"), F.count_if(F.col("status") != "OK").alias("failed"), F.round(F.sum(F.col("elapsed_ms").cast("double") / 1000), 2).alias("seconds")),
    "SELECT kind AS source, count(*) AS total, count(*) FILTER (status = 'OK') AS succeeded, count(*) FILTER (status <> 'OK') AS failed, round(sum(CAST(elapsed_ms AS DOUBLE) / 1000), 2) AS seconds FROM run_log GROUP BY kind",
)
