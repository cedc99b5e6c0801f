"""Coverage and status reports over listing, prices, statements and the control table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalar import days_between, share, units_between


def band(age: Column, good: int, fair: int, labels: tuple[str, str, str]) -> Column:
    """Up to good, up to fair, beyond; a null age falls into the last."""
    return F.when(age <= good, labels[0]).when(age <= fair, labels[1]).otherwise(labels[2])


def symbol_coverage(prices: DataFrame, as_of: Column) -> DataFrame:
    """Rows, first and last date, age and freshness (7 and 30 days) of each symbol's series."""
    out = prices.groupBy("symbol").agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    out = out.withColumn("days_stale", days_between(F.col("last_date"), as_of).cast("long"))
    return out.withColumn("freshness", band(F.col("days_stale"), 7, 30, ("FRESH", "STALE", "VERY_STALE")))


def symbol_category(listing: DataFrame) -> DataFrame:
    gone, ipo = F.col("delisting_date").isNotNull(), F.col("ipo_date").isNotNull()
    label = F.when(gone & ipo, "delisted_with_dates").when(~gone & ipo, "active_with_ipo").when(gone, "delisted_no_ipo").otherwise("minimal")
    return listing.groupBy(label.alias("category")).agg(F.count("*").alias("symbols"), F.min("ipo_date").alias("first_ipo"), F.max("delisting_date").alias("last_delisting"))


def exchange_mix(listing: DataFrame) -> DataFrame:
    return listing.groupBy("exchange", "asset_type", "status").agg(F.count("*").alias("symbols"))


#: Days that count as fresh and as stale by source; others take 7 and 30 (fixed values).
FRESHNESS = {"TIME_SERIES_DAILY_ADJUSTED": (1, 7), "COMPANY_OVERVIEW": (30, 90), "BALANCE_SHEET": (30, 90), "INCOME_STATEMENT": (30, 90), "CASH_FLOW": (30, 90)}


def watermark_status(wm: DataFrame, as_of: Column) -> DataFrame:
    """Listing state, freshness by source and failure band. A run that never was is VERY_STALE, failures unknown are CRITICAL."""
    age = days_between(F.col("last_successful_run"), as_of)
    fresh = band(age, 7, 30, ("FRESH", "STALE", "VERY_STALE"))
    for source, (good, fair) in FRESHNESS.items():
        fresh = F.when(F.col("table_name") == source, band(age, good, fair, ("FRESH", "STALE", "VERY_STALE"))).otherwise(fresh)
    f = F.col("consecutive_failures")
    return wm.select(
        "table_name", "symbol",
        days_between(F.col("ipo_date"), as_of).cast("long").alias("days_since_ipo"),
        F.when(F.col("delisting_date") <= as_of, "DELISTED").when(F.col("ipo_date") > as_of, "FUTURE_IPO").otherwise("ACTIVE").alias("listing_state"),
        fresh.alias("freshness"),
        F.when(f == 0, "OK").when(f <= 3, "WARNING").when(f <= 10, "ERROR").otherwise("CRITICAL").alias("failure_band"),
    )


def processing_summary(wm: DataFrame) -> DataFrame:
    run = F.count("last_successful_run")
    return wm.groupBy("table_name").agg(
        F.count("*").alias("total"), F.count_if(F.col("api_eligible") == "YES").alias("eligible"), run.alias("processed"),
        F.count_if(F.col("consecutive_failures") > 0).alias("with_failures"), share(run, F.count("*")).alias("processed_pct"),
        F.max("last_successful_run").cast("date").alias("last_run"),
    )


def by_source(wm: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """One row a symbol of the control table with the named (source, column) pairs side by side.

    Only rows of these sources are dealt out, and by symbol before they are summed up: the largest of texts is found by
    sorting, which ahead of the shuffle a task would do with all rows it reads.
    """
    rows = wm.where(F.col("table_name").isin(*{s for s, _ in columns.values()})).select("symbol", "table_name", *{c: 0 for _, c in columns.values()})
    picked = (F.max(F.when(F.col("table_name") == s, F.col(c))).alias(n) for n, (s, c) in columns.items())
    return rows.repartition("symbol").groupBy("symbol").agg(*picked)


#: What the dashboard needs of prices, as measures that summaries by partition can keep.
PRICE_MEASURES = {"price_rows": ("count", "*"), "price_first": ("min", "date"), "price_last": ("max", "date")}


def dashboard(listing: DataFrame, prices: DataFrame, statements: DataFrame, wm: DataFrame, as_of: Column) -> DataFrame:
    """One row a symbol of the listing. Facts are aggregated before the joins; two sources of the control table are one aggregate."""
    p = prices.groupBy("symbol").agg(F.count("*").alias("price_rows"), F.min("date").alias("price_first"), F.max("date").alias("price_last"))
    return dashboard_of(listing, p, statements, wm, as_of)


def dashboard_of(listing: DataFrame, p: DataFrame, statements: DataFrame, wm: DataFrame, as_of: Column) -> DataFrame:
    """The dashboard from prices that are summed up by symbol (``PRICE_MEASURES``)."""
    s = statements.groupBy("symbol").agg(F.count("*").alias("statement_rows"), F.max("fiscal_date_ending").alias("statement_last"))
    prices, reports = "TIME_SERIES_DAILY_ADJUSTED", "BALANCE_SHEET"
    w = by_source(wm, price_eligible=(prices, "api_eligible"), statement_eligible=(reports, "api_eligible"), price_failures=(prices, "consecutive_failures"))
    out = listing.select("symbol", "exchange", "asset_type", "status").join(p, "symbol", "left").join(s, "symbol", "left").join(w, "symbol", "left")
    out = out.withColumns({"price_days": days_between(F.col("price_last"), as_of).cast("long"), "statement_days": days_between(F.col("statement_last"), as_of).cast("long")})
    has_p, has_s = F.col("price_rows").isNotNull(), F.col("statement_rows").isNotNull()
    return out.withColumns({
        "price_rows": F.coalesce("price_rows", F.lit(0)), "statement_rows": F.coalesce("statement_rows", F.lit(0)),
        "price_freshness": F.when(~has_p, "MISSING").otherwise(band(F.col("price_days"), 7, 30, ("FRESH", "STALE", "VERY_STALE"))),
        "statement_freshness": F.when(~has_s, "MISSING").otherwise(band(F.col("statement_days"), 90, 180, ("FRESH", "STALE", "VERY_STALE"))),
        "availability": F.when(has_p & has_s, "BOTH").when(has_p, "PRICES_ONLY").when(has_s, "STATEMENTS_ONLY").otherwise("NO_DATA"),
    })


def processing_stats(wm: DataFrame, now: Column) -> DataFrame:
    """By source: totals, mean hours since the last run, and how failures are distributed, as text."""
    total = wm.groupBy("table_name").agg(F.count("*").alias("total"), F.round(F.avg(units_between("hour", F.col("last_successful_run"), now).cast("double")), 2).alias("avg_hours"))
    bands = wm.groupBy("table_name", F.coalesce("consecutive_failures", F.lit(-1)).alias("f")).agg(F.count("*").alias("n"))
    packed = F.array_sort(F.collect_list(F.struct("f", "n")))  # failures are a handful of values
    text = bands.groupBy("table_name").agg(F.array_join(F.transform(packed, lambda x: F.concat(x["f"].cast("string"), F.lit(":"), x["n"].cast("string"))), ", ").alias("failures"))
    return total.join(text, "table_name", "left")


def stale_alerts(board: DataFrame, only_alerts: bool = False) -> DataFrame:
    """Symbols to look at: prices older than 7 days, statements older than 120, or missing. An ETF without statements stays listed; ``has_alert`` tells it apart."""
    p, s = F.col("price_days"), F.col("statement_days")
    price = F.when(p.isNull(), "NO_PRICES").when(p > 7, "STALE_PRICES")
    stock = F.col("asset_type") == "Stock"
    statement = F.when(stock & s.isNull(), "NO_STATEMENTS").when(s > 120, "STALE_STATEMENTS")
    rows = board.where((F.col("status") == "Active") & (p.isNull() | (p > 7) | s.isNull() | (s > 120)))
    out = rows.select("symbol", "exchange", "asset_type", "price_days", "statement_days", price.alias("price_alert"), statement.alias("statement_alert"))
    out = out.withColumn("has_alert", F.col("price_alert").isNotNull() | F.col("statement_alert").isNotNull())
    return out.where("has_alert") if only_alerts else out


def coverage_summary(board: DataFrame) -> DataFrame:
    def row(name: str, kind: str) -> DataFrame:
        f, n = F.col(f"{kind}_freshness"), F.count("*")
        has = F.sum(F.when(f != "MISSING", 1).otherwise(0))
        return board.agg(F.lit(name).alias("data_type"), n.alias("symbols"), has.alias("with_data"), F.sum(F.when(f == "FRESH", 1).otherwise(0)).alias("fresh"), share(has, n).alias("coverage_pct"))

    return row("PRICES", "price").unionByName(row("STATEMENTS", "statement"))


def eligible_pct(wm: DataFrame) -> DataFrame:
    return wm.groupBy("table_name", "api_eligible").agg(F.count("*").alias("symbols"), share(F.count("last_successful_run"), F.count("*")).alias("processed_pct"))


def needs_refresh(wm: DataFrame, as_of: Column, days: int = 30, limit: int = 50) -> DataFrame:
    """The report's top rows: never processed first, then the stalest."""
    last = F.to_date("last_successful_run")
    rows = wm.where((F.col("api_eligible") == "YES") & (last.isNull() | (last < F.date_sub(as_of, days))))
    return rows.select("table_name", "symbol", last.alias("last_run")).orderBy(F.col("last_run").asc_nulls_first(), "table_name", "symbol").limit(limit)


def exchange_progress(wm: DataFrame, as_of: Column) -> DataFrame:
    return wm.groupBy("exchange").agg(
        F.count("*").alias("total"), F.count("last_successful_run").alias("processed"), F.count_if(F.col("consecutive_failures") > 0).alias("failing"),
        F.round(F.avg(days_between(F.col("last_successful_run"), as_of).cast("double")), 2).alias("avg_days_stale"),
    )


def failure_leaders(wm: DataFrame, least: int = 3, limit: int = 20) -> DataFrame:
    rows = wm.where(F.col("consecutive_failures") >= least).select("table_name", "symbol", "consecutive_failures")
    return rows.orderBy(F.col("consecutive_failures").desc(), "table_name", "symbol").limit(limit)


def eligibility_mix(wm: DataFrame, now: Column) -> DataFrame:
    hours = units_between("hour", F.col("last_successful_run"), now)
    return wm.groupBy("table_name", "api_eligible").agg(
        F.count("*").alias("symbols"), F.countDistinct("exchange").alias("exchanges"),
        F.count_if(F.col("last_successful_run").isNull()).alias("never_run"), F.count_if(hours > 720).alias("stale_720h"),
    )


def source_overview(wm: DataFrame) -> DataFrame:
    return wm.groupBy("table_name", "asset_type").agg(F.count("*").alias("total"), F.count_if(F.col("api_eligible") == "YES").alias("eligible"))


def run_summary(runs: DataFrame) -> DataFrame:
    """Success share and symbols a minute of runs with counts and seconds."""
    return runs.withColumns({"success_pct": share(F.col("succeeded"), F.col("total")), "per_minute": F.round(F.try_divide(F.col("total").cast("double") * 60.0, F.col("seconds").cast("double")), 2)})
