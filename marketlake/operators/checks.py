"""Data-quality checks. Each is one aggregate or one bounded report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.scalar import clean_date, days_between, null_tokens, share, to_decimal, to_double
from marketlake.operators.merge import matches
from marketlake.operators.ranks import listed


def missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), *(F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns))


def _gap() -> Column:
    return (F.col("total_assets") - (F.col("total_liabilities") + F.col("total_equity"))).cast("double")


def balance(statements: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """How many balance sheets don't add up, and the mean gap."""
    off = F.abs(_gap()) > tolerance
    return statements.groupBy("period_type").agg(F.count("*").alias("n_rows"), F.count_if(off).alias("unbalanced"), F.round(F.avg(F.abs(_gap())), 2).alias("mean_gap"))


def balance_worst(statements: DataFrame, least: float = 1000.0, limit: int = 20) -> DataFrame:
    rows = statements.select("symbol", "fiscal_date_ending", "period_type", F.round(_gap(), 2).alias("difference")).where(F.abs("difference") > least)
    return rows.orderBy(F.abs("difference").desc(), "symbol", "fiscal_date_ending", "period_type").limit(limit)


def date_ranges(statements: DataFrame) -> DataFrame:
    return statements.groupBy("period_type").agg(F.count("*").alias("n_rows"), F.countDistinct("symbol").alias("symbols"), F.min("fiscal_date_ending").alias("first_date"), F.max("fiscal_date_ending").alias("last_date"))


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def recency(statements: DataFrame, as_of: Column) -> DataFrame:
    return statements.groupBy("period_type").agg(days_between(F.max("fiscal_date_ending"), as_of).cast("long").alias("days_since_newest"))


def invalid_prices(prices: DataFrame) -> DataFrame:
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return prices.agg(F.count("*").alias("n_rows"), one(F.col("close") <= 0).alias("bad_close"), one(F.col("high") < F.col("low")).alias("high_below_low"), one(F.col("volume") < 0).alias("bad_volume"))


def gaps(prices: DataFrame, least: int = 100, limit: int = 20) -> DataFrame:
    """Symbols whose span in days exceeds their rows by more than ``least``: a report's top rows."""
    spans = prices.groupBy("symbol").agg(F.count("*").alias("n_rows"), (F.datediff(F.max("date"), F.min("date")) + 1).cast("long").alias("span_days"))
    return spans.withColumn("gap", F.col("span_days") - F.col("n_rows")).where(F.col("gap") > least).orderBy(F.col("gap").desc(), "symbol").limit(limit)


def event_counts(prices: DataFrame) -> DataFrame:
    """Splits and dividends: rows and symbols of each."""
    of = lambda name, c: prices.where(c).agg(F.lit(name).alias("event"), F.count("*").alias("n_rows"), F.countDistinct("symbol").alias("symbols"))
    return of("SPLIT", F.col("split_coefficient") != 1).unionByName(of("DIVIDEND", F.col("dividend_amount") > 0))


def recent(prices: DataFrame, as_of: Column) -> DataFrame:
    fresh = F.col("date") >= F.date_sub(as_of, 7)
    return prices.agg(F.max("date").alias("newest"), days_between(F.max("date"), as_of).cast("long").alias("age_days"), F.countDistinct(F.when(fresh, F.col("symbol"))).alias("symbols_7d"))


def profile(prices: DataFrame) -> DataFrame:
    return prices.groupBy("symbol").agg(F.count("*").alias("days"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.round(F.avg(F.col("volume").cast("double")), 2).alias("avg_volume"))


def load_summary(statements: DataFrame) -> DataFrame:
    n = lambda p: F.count_if(F.col("period_type") == p)
    return statements.agg(F.count("*").alias("n_rows"), F.countDistinct("symbol").alias("symbols"), n("annual").alias("annual"), n("quarterly").alias("quarterly"), F.min("fiscal_date_ending").alias("first_date"), F.max("fiscal_date_ending").alias("last_date"))


def type_share(rows: DataFrame, column: str) -> DataFrame:
    """Rows of each value and their share of all; the window runs over the aggregate's few rows."""
    out = rows.groupBy(column).agg(F.count("*").alias("n_rows"))
    return out.withColumn("pct", share(F.col("n_rows"), F.sum("n_rows").over(Window.partitionBy())))


def share_within(rows: DataFrame, outer: str, inner: str) -> DataFrame:
    out = rows.groupBy(outer, inner).agg(F.count("*").alias("n_rows"))
    return out.withColumn("pct", share(F.col("n_rows"), F.sum("n_rows").over(Window.partitionBy(outer))))


def top_types(rows: DataFrame, columns: Sequence[str], limit: int = 10) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count("*").alias("n_rows")).orderBy(F.col("n_rows").desc(), *(F.col(c).asc_nulls_last() for c in columns)).limit(limit)


def by_year(rows: DataFrame, date: str, as_of: Column) -> DataFrame:
    fresh = F.col(date) >= F.date_sub(as_of, 30)
    return rows.groupBy(F.trunc(date, "year").alias("year")).agg(F.count("*").alias("n_rows"), F.countDistinct("symbol").alias("symbols"), F.count_if(fresh).alias("last_30d"))


def field_issues(staged: DataFrame) -> DataFrame:
    """Cells that a load would lose: bad dates and numbers (missing tokens aren't issues), and rows without a symbol."""
    date, close, volume = (null_tokens(F.col(c)) for c in ("date_text", "close_text", "volume_text"))
    bad = lambda raw, typed: F.count_if(raw.isNotNull() & typed.isNull())
    return staged.agg(
        F.count("*").alias("n_rows"), bad(date, clean_date(date)).alias("bad_form_date"), F.count_if(date.isNotNull() & F.try_to_date(date, "yyyy-MM-dd").isNull()).alias("bad_date"),
        bad(close, to_decimal(close)).alias("bad_close"), F.count_if(to_double(close) <= 0).alias("non_positive_close"), bad(volume, to_decimal(volume, 20, 0)).alias("bad_volume"),
    )


def orphans(rows: DataFrame, listing: DataFrame) -> DataFrame:
    """Rows whose symbol the listing lacks."""
    return rows.join(listing.select("symbol"), "symbol", "left_anti").agg(F.count("*").alias("orphans"))


def staging_profile(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and distinct values of each column, in one row.

    Several distinct counts in one aggregate would copy each row once a column. Instead a
    row becomes pairs of a column's number and its value's hashes (two of 64 bits), which
    tasks make unique before they are dealt out by the pair.
    """
    pair = lambda i, c: F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("i"), F.xxhash64(F.col(c)).alias("h"), F.xxhash64(F.lit("more"), F.col(c)).alias("g")))
    pairs = rows.select(F.explode(F.array_compact(F.array(*(pair(i, c) for i, c in enumerate(columns))))).alias("p")).select("p.*").distinct()
    counts = pairs.groupBy("i").count().agg(*(F.coalesce(F.max(F.when(F.col("i") == i, F.col("count"))), F.lit(0)).alias(f"distinct_{c}") for i, c in enumerate(columns)))
    return rows.agg(F.count("*").alias("n_rows")).crossJoin(counts)  # a row each


def schema_issues(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns that are missing, unexpected or of another type, and how many rows hold a value there."""
    have, want = dict(df.dtypes), {f.name: f.dataType.simpleString() for f in contract}
    rows = [(c, want.get(c), have.get(c), "missing" if c not in have else "unexpected" if c not in want else "type") for c in sorted({*have, *want}) if have.get(c) != want.get(c)]
    issues = df.sparkSession.createDataFrame(rows, "column string, expected string, found string, issue string")
    filled = df.agg(*(F.count(F.col(f"`{c}`")).alias(c) for c in df.columns)).select(F.explode(F.create_map(*(x for c in df.columns for x in (F.lit(c), F.col(f"`{c}`"))))).alias("column", "n_filled"))
    return issues.join(filled, "column", "left").withColumn("n_filled", F.coalesce("n_filled", F.lit(0).cast("long")))


def id_conflicts(rows: DataFrame, key: str, value: str, most: int = 100) -> DataFrame:
    """Keys with more than one value, and the first ``most`` values as text."""
    values = rows.select(key, F.col(value).cast("string").alias(value)).where(F.col(value).isNotNull()).distinct()
    many = values.groupBy(key).agg(F.count("*").alias("n_values")).where("n_values > 1").alias("t")
    return many.join(listed(values, (key,), value, most, ", ", "values").alias("s"), matches((key,))).select("t.*", "values")


def stale_block(wm: DataFrame, as_of: Column, days: int = 135) -> DataFrame:
    """Of the eligible rows by source: never pulled, too recent, due."""
    last = F.col("last_fiscal_date")
    recent_ = last >= F.date_sub(as_of, days)
    return wm.where(F.col("api_eligible") == "YES").groupBy("table_name").agg(
        F.count("*").alias("total"), F.count_if(last.isNull()).alias("never"), F.count_if(recent_).alias("too_recent"), F.count_if(last.isNull() | ~recent_).alias("due")
    )


def fresh_labels(overview: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    label = F.when(days_between(F.col("load_date"), as_of) <= days, "FRESH").otherwise("STALE")
    return overview.groupBy(label.alias("label")).agg(F.count("*").alias("symbols"), F.min("load_date").alias("oldest"))


def history(prices: DataFrame) -> DataFrame:
    return prices.agg(F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def screen(overview: DataFrame, prices: DataFrame, listing: DataFrame, cap: int = 100_000_000, price: float = 5.0, exchanges: Sequence[str] = ("NYSE", "NASDAQ", "AMEX")) -> DataFrame:
    """Active stocks on the given exchanges by size and latest close."""
    last = prices.groupBy("symbol").agg(F.max_by("close", "date").alias("latest_close"))
    rows = listing.where((F.col("asset_type") == "Stock") & (F.col("status") == "Active") & F.col("exchange").isin(*exchanges)).select("symbol", "exchange")
    rows = rows.join(overview.where(F.col("market_capitalization") > cap).select("symbol", "sector", "market_capitalization"), "symbol")
    return rows.join(last.where(F.col("latest_close") > price), "symbol")


def rules(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows that break each rule."""
    return df.agg(*(F.count_if(~F.coalesce(c, F.lit(False))).alias(name) for name, c in checks.items()))
