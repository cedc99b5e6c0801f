"""Run, load and storage analytics over log tables that the user supplies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalar import preview, units_between
from marketlake.operators.merge import matches
from marketlake.operators.ranks import listed

RATE = 3.0  # price of a credit
GB = 1024.0**3
MB = 1024.0**2

#: Operation class by how a run's text begins (fixed values).
CLASSES = (("COPY INTO", "LOAD"), ("MERGE INTO", "MERGE"), ("INSERT INTO", "INSERT"), ("SELECT", "QUERY"))


def day(c: str = "start_ts") -> Column:
    return F.to_date(c).alias("day")


def since(df: DataFrame, now: Column, days: int, c: str = "start_ts") -> DataFrame:
    return df.where(F.col(c) >= now - F.make_dt_interval(days=F.lit(days)))


def operation(text: Column) -> Column:
    out = F.lit("OTHER")
    for start, name in reversed(CLASSES):
        out = F.when(F.upper(text).like(f"{start}%"), name).otherwise(out)
    return out


def money(credits: Column) -> Column:
    return F.round(credits * RATE, 4)


def total(c: str, digits: int = 4) -> Column:
    return F.round(F.sum(c), digits)


def seconds(c: str = "elapsed_ms") -> Column:
    return F.col(c).cast("double") / 1000.0


def daily(log: DataFrame, now: Column, days: int = 7) -> DataFrame:
    return since(log, now, days).groupBy(day()).agg(total("credits").alias("credits"), money(F.sum("credits")).alias("cost"), F.count("*").alias("runs"))


def hourly(log: DataFrame, limit: int = 24) -> DataFrame:
    hour = F.date_format(F.date_trunc("hour", "start_ts"), "yyyy-MM-dd HH").alias("hour")
    return log.groupBy(hour).agg(F.count("*").alias("runs"), F.round(F.avg(seconds()), 4).alias("avg_seconds"), total("credits").alias("credits")).orderBy(F.col("hour").desc()).limit(limit)


def ingest(files: DataFrame) -> DataFrame:
    return files.groupBy(day("load_ts"), "pipe").agg(F.count("*").alias("files"), F.sum("n_rows").alias("n_rows"), F.round(F.sum("n_bytes") / MB, 4).alias("mb"))


def error_messages(files: DataFrame) -> DataFrame:
    """Every message of a day with its count, as rows."""
    return files.where(F.col("error").isNotNull()).groupBy(day("load_ts"), "status", "error").agg(F.count("*").alias("n"))


def errors(files: DataFrame, most: int = 100) -> DataFrame:
    """Load errors by day and status with their first ``most`` messages; all of them are in ``error_messages``."""
    rows = error_messages(files)
    total = rows.groupBy("day", "status").agg(F.sum("n").alias("n")).alias("t")
    return total.join(listed(rows, ("day", "status"), "error", most, "; ", "messages").alias("s"), matches(("day", "status"))).select("t.*", "messages")


def longest(log: DataFrame, limit: int = 10) -> DataFrame:
    out = log.select("run_id", "user_name", "kind", F.round(seconds(), 3).alias("seconds"), preview(F.col("text"), 8).alias("preview"))
    return out.orderBy(F.col("seconds").desc(), "run_id").limit(limit)


def patterns(log: DataFrame) -> DataFrame:
    return log.groupBy(day(), "kind").agg(F.count("*").alias("runs"), F.round(F.avg(seconds()), 4).alias("avg_seconds"), F.round(F.max(seconds()), 4).alias("max_seconds"))


def storage(tables: DataFrame, monthly: float = 23.0 / 1024) -> DataFrame:
    gb = F.col("n_bytes").cast("double") / GB
    return tables.select("schema_name", "table_name", "n_rows", F.round(gb, 6).alias("gb"), F.round(gb * monthly, 6).alias("monthly_cost"))


def loads(files: DataFrame) -> DataFrame:
    n = lambda s: F.count_if(F.col("status") == s)
    return files.groupBy("table_name").agg(F.countDistinct("file").alias("files"), F.sum("n_rows").alias("n_rows"), F.round(F.sum("n_bytes") / MB, 4).alias("mb"), n("LOADED").alias("loaded"), n("LOAD_FAILED").alias("failed"))


def file_efficiency(files: DataFrame) -> DataFrame:
    rows, size = F.sum("n_rows").cast("double"), F.sum("n_bytes").cast("double")
    return files.groupBy("table_name").agg(F.round(F.try_divide(size, rows), 4).alias("bytes_per_row"), F.round(F.try_divide(rows, F.count("*").cast("double")), 4).alias("rows_per_file"))


def cost_rollup(log: DataFrame, files: DataFrame, tables: DataFrame, now: Column) -> DataFrame:
    """A week's compute, loads and storage in one row, with the month extrapolated. The three sides have one row each."""
    week = since(log, now, 7).agg(F.round(F.coalesce(F.sum("credits"), F.lit(0.0)) * RATE, 4).alias("compute_week"))
    load = since(files, now, 7, "load_ts").agg(F.count("*").alias("files_week"))
    store = tables.agg(F.round(F.sum("n_bytes") / GB, 6).alias("gb"))
    return week.crossJoin(load).crossJoin(store).withColumn("compute_month", F.round(F.col("compute_week") * 52 / 12, 4))


def layout_advice(tables: DataFrame, large: int = 1_000_000, small: int = 100_000) -> DataFrame:
    """Whether a table needs a layout key: large ones without any do, those below ``small`` are not worth one."""
    n, key = F.col("n_rows"), F.col("layout_key")
    advice = F.when(key.isNull() & (n > large), "CONSIDER").when(n < small, "TOO_SMALL").otherwise("CONFIGURED")
    return tables.select("table_name", "n_rows", "layout_key", advice.alias("advice"))


def slow_advice(log: DataFrame, avg_s: float = 60.0, max_s: float = 300.0) -> DataFrame:
    out = log.groupBy("kind").agg(F.round(F.avg(seconds()), 4).alias("avg_seconds"), F.round(F.max(seconds()), 4).alias("max_seconds"))
    return out.withColumn("advice", F.when(F.col("avg_seconds") > avg_s, "OPTIMISE").when(F.col("max_seconds") > max_s, "CHECK_OUTLIERS").otherwise("OK"))


def hour_cost(log: DataFrame) -> DataFrame:
    hour = F.date_format(F.date_trunc("hour", "start_ts"), "yyyy-MM-dd HH").alias("hour")
    return log.groupBy(hour).agg(F.count("*").alias("runs"), total("credits").alias("credits"), money(F.sum("credits")).alias("cost"), F.round(F.avg("credits"), 4).alias("avg_credits"), F.round(F.sum(seconds()), 3).alias("seconds"))


def top_cost(log: DataFrame, least: float = 0.0, limit: int = 20) -> DataFrame:
    out = log.where(F.col("credits") > least).select("run_id", "user_name", "kind", operation(F.col("text")).alias("class"), F.round("credits", 4).alias("credits"), money(F.col("credits")).alias("cost"), preview(F.col("text"), 12).alias("preview"))
    return out.orderBy(F.col("credits").desc(), "run_id").limit(limit)


def by_class(log: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    return log.groupBy(*extra, operation(F.col("text")).alias("class")).agg(F.count("*").alias("runs"), total("credits").alias("credits"), F.round(F.avg("credits"), 4).alias("avg_credits"), F.round(F.avg(seconds()), 4).alias("avg_seconds"))


def loads_by_class(log: DataFrame) -> DataFrame:
    return by_class(log.where(operation(F.col("text")).isin("LOAD", "MERGE", "INSERT")), [day()])


def resumes(log: DataFrame, resume: str = "RESUME", suspend: str = "SUSPEND", least: int = 5) -> DataFrame:
    """Users by day with at least so many events of the two kinds together."""
    out = log.groupBy(day(), "user_name").agg(F.count_if(F.col("kind") == resume).alias("resumes"), F.count_if(F.col("kind") == suspend).alias("suspends"))
    return out.where(F.col("resumes") + F.col("suspends") >= least)


#: Characters of a name that are looked up in texts.
ANCHOR = 4


def grams(text: Column, length: int | Column) -> Column:
    """Distinct stretches of ``length`` characters."""
    length = F.lit(length) if isinstance(length, int) else length
    last = F.char_length(text) - length
    return F.when(last >= 0, F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i + 1, length)))).otherwise(F.array().cast("array<string>"))


def naming(names: DataFrame, texts: DataFrame, name: str, text: str) -> DataFrame:
    """Pairs (name, text) of distinct values where the text contains the name, as (``name``, ``text``).

    Texts are an inverted table of their stretches of as many characters as names have,
    ``ANCHOR`` at most. Each name is looked up under the rarest of its own stretches, by
    equality; what is found there is held against the whole name. A stretch that no text
    holds rules its name out at once. Null names and texts match nothing, an empty name
    every text.
    """
    names, texts = names.select(F.col(name).alias("_name")).where("_name IS NOT NULL").distinct(), texts.select(F.col(text).alias("_text")).where("_text IS NOT NULL").distinct()
    size = F.least(F.char_length("_name"), F.lit(ANCHOR))
    parts = names.select("_name", F.explode(grams(F.col("_name"), size)).alias("_gram"))
    wanted = parts.select("_gram").distinct()
    sizes = sorted(r[0] for r in names.select(size).distinct().collect())  # ANCHOR + 1 of them at most
    stretches = F.flatten(F.array(*(grams(F.col("_text"), k) for k in sizes))) if sizes else F.array().cast("array<string>")
    found = texts.select("_text", F.explode(stretches).alias("_gram")).join(wanted, "_gram", "left_semi")
    held = found.groupBy("_gram").agg(F.count("*").alias("_n"))
    parts = parts.join(held, "_gram", "left").groupBy("_name").agg(F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"), F.min(F.coalesce("_n", F.lit(0))).alias("_n"))
    pairs = parts.where("_n > 0").select("_name", "_gram").join(found, "_gram")
    return pairs.where(F.contains("_text", "_name")).select(F.col("_name").alias(name), F.col("_text").alias(text))


def text_match(tables: DataFrame, log: DataFrame) -> DataFrame:
    """Cost of the runs that name a table. Runs are summed by text first, and names meet texts by equal stretches of characters."""
    texts = log.groupBy("text").agg(F.sum("credits").alias("c"), F.count("*").alias("n"))
    cost = naming(tables, texts, "table_name", "text").join(texts, "text").groupBy("table_name").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    hit = tables.select("table_name", "n_rows").join(cost, "table_name", "left")
    return hit.groupBy("table_name", "n_rows").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("runs"), F.round(F.coalesce(F.sum("c"), F.lit(0.0)), 4).alias("credits"))


def daily_cost(log: DataFrame) -> DataFrame:
    return log.groupBy(day()).agg(F.count("*").alias("runs"), F.round(F.sum(seconds()) / 3600.0, 4).alias("hours"), F.round(F.sum("bytes_read") / GB, 6).alias("gb_read"), money(F.sum("credits")).alias("cost"))


def efficiency(log: DataFrame) -> DataFrame:
    """Credits for each GB written, of loads and of all others; nothing written: null."""

    def part(name: str, c: Column) -> DataFrame:
        gb = F.sum("bytes_written") / GB
        return log.where(c).agg(F.lit(name).alias("class"), total("credits").alias("credits"), F.round(gb, 6).alias("gb_written"), F.round(F.try_divide(F.sum("credits"), F.nullif(gb, F.lit(0.0))), 2).alias("credits_per_gb"))

    load = operation(F.col("text")).isin("LOAD", "MERGE", "INSERT")
    return part("LOADS", load).unionByName(part("OTHERS", ~load))


def hours_rate(log: DataFrame) -> DataFrame:
    rows = log.where(F.col("end_ts").isNotNull())
    out = rows.groupBy(day()).agg((F.sum(units_between("second", F.col("start_ts"), F.col("end_ts"))).cast("double") / 3600.0).alias("h"))
    return out.select("day", F.round("h", 4).alias("hours"), F.round(F.col("h") * RATE, 4).alias("cost"))


def long_sessions(log: DataFrame, minutes: int = 30) -> DataFrame:
    out = log.select("run_id", "user_name", units_between("minute", F.col("start_ts"), F.col("end_ts")).alias("minutes"))
    return out.where(F.col("minutes") > minutes)


def unfinished(log: DataFrame, now: Column) -> DataFrame:
    rows = log.where(F.col("end_ts").isNull() & (F.col("start_ts") < now - F.make_dt_interval(hours=F.lit(1))))
    return rows.select("run_id", "user_name", "kind", units_between("hour", F.col("start_ts"), now).alias("open_hours"))
