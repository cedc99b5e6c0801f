"""The control table: which symbols a run pulls, and how its outcome moves them.

States of ``api_eligible``: YES, NO, DEL (delisted; stays), SUS (suspended). A run's
updates come from rows that were committed to the target, never from what was fetched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.functions.scalar import older_than, quarter_end
from marketlake.operators.merge import update_from, update_where
from marketlake.operators.ranks import place_within
from marketlake.specs import eligibility

SEED = "LISTING_STATUS"


def empty_state(df: DataFrame, now: Column) -> DataFrame:
    return df.withColumns({
        "first_fiscal_date": F.lit(None).cast("date"), "last_fiscal_date": F.lit(None).cast("date"),
        "last_successful_run": F.lit(None).cast("timestamp"), "consecutive_failures": F.lit(0), "created_at": now, "updated_at": now,
    })


def seed(listing: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """A row for every symbol of the listing that the control table doesn't have yet."""
    rows = listing.where(F.col("symbol").isNotNull() & (F.col("symbol") != "")).select("symbol", "name", "exchange", "asset_type", "status", "ipo_date", "delisting_date").distinct()
    rows = rows.withColumns({"table_name": F.lit(SEED), "api_eligible": F.lit("NO")})
    if existing is None:
        return rows
    return rows.join(existing.where(F.col("table_name") == SEED).select("symbol"), "symbol", "left_anti")


def add_sources(symbols: DataFrame, sources: Sequence[str], existing: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """Symbols times sources with their eligibility, but pairs that exist. The sources are a handful of names, so they are an array to explode."""
    names = F.explode(F.array(*map(F.lit, sources))).alias("table_name")
    rows = symbols.select("*", names) if "table_name" not in symbols.columns else symbols.drop("table_name").select("*", names)
    rule = eligibility(F.col("table_name"), F.col("asset_type"), F.col("status"), F.col("delisting_date") if as_of is not None else None, as_of)
    rows = rows.withColumn("api_eligible", rule)
    return rows if existing is None else rows.join(existing.select("table_name", "symbol"), ["table_name", "symbol"], "left_anti")


def new_symbols(listing: DataFrame, wm: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Rows for symbols of the listing that the control table has under no source. One null symbol in it must not hide all new ones."""
    known = wm.where(F.col("symbol").isNotNull()).select("symbol")
    return add_sources(listing.where(F.col("symbol").isNotNull()).join(known, "symbol", "left_anti"), sources)


def exchange_filter(mode: str | None) -> Column:
    """ALL, an exchange, or ETF_AND_ALL_OTHER: everything but the two large ones."""
    if mode in (None, "ALL"):
        return F.lit(True)
    name = F.upper("exchange")
    return ~name.isin("NASDAQ", "NYSE") if mode == "ETF_AND_ALL_OTHER" else name == mode.upper()


def due(
    wm: DataFrame, source: str, as_of: Column, exchange: str | None = None, stale_days: int | None = None, never: bool = False,
    skip_hours: int | None = None, max_failures: int | None = None, active: bool = False, limit: int | None = None,
) -> DataFrame:
    """Eligible symbols of a source that are due: all rules given must hold. ``limit`` is the run's cap, in order of symbol."""
    keep = (F.col("table_name") == source) & (F.col("api_eligible") == "YES") & exchange_filter(exchange)
    if stale_days is not None:
        keep &= older_than(F.col("last_fiscal_date"), as_of, stale_days)
    if never:
        keep &= F.col("last_successful_run").isNull()
    if skip_hours is not None:
        last = F.col("last_successful_run")
        keep &= last.isNull() | (last < as_of.cast("timestamp") - F.make_dt_interval(hours=F.lit(skip_hours)))
    if max_failures is not None:
        keep &= F.coalesce("consecutive_failures", F.lit(0)) < max_failures
    if active:
        keep &= F.col("status") == "Active"
    out = wm.where(keep)
    return out if limit is None else out.orderBy("symbol").limit(limit)


def by_priority(wm: DataFrame, as_of: Column, policy: DataFrame) -> DataFrame:
    """Rows past their source's refresh interval, with place: never processed first, then the stalest. policy: table_name, refresh_days, priority.

    A source without a policy has no interval: all of its rows are due, its priority is null.
    """
    last = F.col("last_successful_run")
    rows = wm.join(F.broadcast(policy), "table_name", "left")  # one row a source
    rows = rows.where(last.isNull() | F.col("refresh_days").isNull() | (F.datediff(as_of, F.to_date(last)) > F.col("refresh_days")))
    return place_within(rows, "table_name", F.col("last_successful_run").asc_nulls_first(), F.col("symbol"))


def mode(wm: DataFrame, as_of: Column, staleness: int = 5) -> DataFrame:
    """``mode``: compact if both dates are set and the last is less than so many days old, else full."""
    fresh = F.col("first_fiscal_date").isNotNull() & F.col("last_fiscal_date").isNotNull() & (F.datediff(as_of, F.col("last_fiscal_date")) < staleness)
    return wm.withColumn("mode", F.when(fresh, "compact").otherwise("full"))


def compact(prices: DataFrame, n: int = 100) -> DataFrame:
    """The newest n rows of each symbol."""
    rank = F.row_number().over(Window.partitionBy("symbol").orderBy(F.col("date").desc()))
    return prices.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def with_fundamentals(rows: DataFrame, wm: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Symbols for which any of the sources has data."""
    has = wm.where(F.col("table_name").isin(*sources) & F.col("last_fiscal_date").isNotNull())
    return rows.join(has.select("symbol"), "symbol", "left_semi")


def advance_success(wm: DataFrame, source: str, updates: DataFrame, now: Column, policy: str = "overwrite") -> DataFrame:
    """After a load was committed. updates: symbol, first_date, last_date (dates may be null).

    The first date is kept once set, the last replaced; policy "widen" takes the
    earlier and the later instead. Failures go to 0; an eligible symbol whose
    delisting date has come becomes DEL.
    """
    t, s = lambda c: F.col(f"t.{c}"), lambda c: F.col(f"s.{c}")
    first, last = F.coalesce(t("first_fiscal_date"), s("first_date")), F.coalesce(s("last_date"), t("last_fiscal_date"))
    if policy == "widen":
        first, last = F.least(t("first_fiscal_date"), s("first_date")), F.greatest(t("last_fiscal_date"), s("last_date"))
    gone = (t("api_eligible") == "YES") & (t("delisting_date") <= F.to_date(now))
    changes = {
        "first_fiscal_date": first, "last_fiscal_date": last, "last_successful_run": now, "consecutive_failures": F.lit(0),
        "api_eligible": F.when(gone, "DEL").otherwise(t("api_eligible")), "updated_at": now,
    }
    return update_from(wm, updates.withColumn("table_name", F.lit(source)), ["table_name", "symbol"], changes)


def record_failure(wm: DataFrame, source: str, failed: DataFrame, suspend_at: int | None = None) -> DataFrame:
    """One failure more for the symbols of ``failed``; with a threshold, eligible ones that reach it are suspended."""
    n = F.coalesce(F.col("t.consecutive_failures"), F.lit(0)) + 1
    changes = {"consecutive_failures": n}
    if suspend_at is not None:
        changes["api_eligible"] = F.when((F.col("t.api_eligible") == "YES") & (n >= suspend_at), "SUS").otherwise(F.col("t.api_eligible"))
    keys = failed.select("symbol").distinct().withColumn("table_name", F.lit(source))
    return update_from(wm, keys, ["table_name", "symbol"], changes)


def suspend(wm: DataFrame, source: str, threshold: int = 3) -> DataFrame:
    return update_where(wm, (F.col("table_name") == source) & (F.col("api_eligible") == "YES") & (F.col("consecutive_failures") >= threshold), {"api_eligible": F.lit("SUS")})


def suspend_idle_sources(wm: DataFrame) -> DataFrame:
    """NO becomes SUS in sources that have no eligible symbol at all."""
    live = wm.groupBy("table_name").agg((F.count_if(F.col("api_eligible") == "YES") > 0).alias("_live"))
    out = wm.join(F.broadcast(live), "table_name")  # one row a source
    return out.withColumn("api_eligible", F.when(~F.col("_live") & (F.col("api_eligible") == "NO"), "SUS").otherwise(F.col("api_eligible"))).select(*wm.columns)


def mark_delisted(wm: DataFrame, source: str, symbols: DataFrame) -> DataFrame:
    return update_from(wm, symbols.select("symbol").distinct().withColumn("table_name", F.lit(source)), ["table_name", "symbol"], {"api_eligible": F.lit("DEL")})


def rebuild(wm: DataFrame, source: str, target: DataFrame, date: str | None = None, quarter: str | None = None) -> DataFrame:
    """First and last dates from the target table itself, from a date or from a quarter such as 2022Q3."""
    day = F.col(date) if date else quarter_end(F.col(quarter))
    spans = target.groupBy("symbol").agg(F.min(day).alias("lo"), F.max(day).alias("hi")).where("lo IS NOT NULL").withColumn("table_name", F.lit(source))
    return update_from(wm, spans, ["table_name", "symbol"], {"first_fiscal_date": F.col("s.lo"), "last_fiscal_date": F.col("s.hi")})


def reset(wm: DataFrame, predicate: Column, reenable: bool = False) -> DataFrame:
    """Forgets dates and failures; with ``reenable`` delisted and suspended rows become eligible again."""
    none = F.lit(None)
    changes = {"first_fiscal_date": none.cast("date"), "last_fiscal_date": none.cast("date"), "last_successful_run": none.cast("timestamp"), "consecutive_failures": F.lit(0)}
    if reenable:
        changes["api_eligible"] = F.when(F.col("api_eligible").isin("DEL", "SUS"), "YES").otherwise(F.col("api_eligible"))
    return update_where(wm, predicate, changes)


def summary(wm: DataFrame) -> DataFrame:
    """Rows, eligible, not eligible, delisted and suspended by source."""
    n = lambda v: F.count_if(F.col("api_eligible") == v)
    return wm.groupBy("table_name").agg(F.count("*").alias("total"), n("YES").alias("eligible"), n("NO").alias("not_eligible"), n("DEL").alias("delisted"), n("SUS").alias("suspended"), F.countDistinct("symbol").alias("symbols"))


#: Days between refreshes and rank of importance (fixed values).
POLICY = (("TIME_SERIES_DAILY_ADJUSTED", 1, 1), ("LISTING_STATUS", 7, 2), ("COMPANY_OVERVIEW", 30, 3), ("BALANCE_SHEET", 90, 4))


def policy(spark: SparkSession) -> DataFrame:
    rows = F.explode(F.array(*(F.struct(F.lit(t).alias("table_name"), F.lit(d).alias("refresh_days"), F.lit(p).alias("priority")) for t, d, p in POLICY)))
    return spark.range(1).select(rows.alias("r")).select("r.*")
