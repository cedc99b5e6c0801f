"""Market-data tables derived from the given ones, as SQL that Spark and other engines read alike.

``frame`` runs a definition in Spark; ``sql`` puts the definitions that a statement
names before it as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-02"
RUN_AT = "2024-01-31 00:00:00"
BASE = "region nation customer supplier part orders lineitem events conversations".split()

#: Control-table sources with what makes a symbol eligible.
SOURCES = ("TIME_SERIES_DAILY_ADJUSTED", "COMPANY_OVERVIEW", "BALANCE_SHEET", "INCOME_STATEMENT", "CASH_FLOW", "INSIDER_TRANSACTIONS", "EARNINGS_CALL_TRANSCRIPT", "ETF_PROFILE")
SYMBOL_ID = {
    "spark": "CAST(conv(substr(md5({0}), 1, 15), 16, 10) AS BIGINT) % 1000000000",
    "other": "CAST(('0x' || substr(md5({0}), 1, 15)) AS BIGINT) % 1000000000",
}

VIEWS = {
    "listing": """
        SELECT c_custkey AS n, c_name AS symbol, concat('Company ', CAST(c_custkey AS STRING)) AS name,
            CASE c_nationkey % 4 WHEN 0 THEN 'NYSE' WHEN 1 THEN 'NASDAQ' WHEN 2 THEN 'AMEX' ELSE 'BATS' END AS exchange,
            CASE WHEN c_mktsegment = 'BUILDING' THEN 'ETF' ELSE 'Stock' END AS asset_type,
            CASE WHEN c_acctbal < 0 THEN 'Delisted' ELSE 'Active' END AS status,
            CASE WHEN c_custkey % 11 <> 3 THEN DATE '1995-01-01' + CAST(c_custkey % 1000 AS INT) END AS ipo_date,
            CASE WHEN c_acctbal < 0 THEN DATE '1999-01-01' + CAST(c_custkey % 900 AS INT) END AS delisting_date
        FROM customer""",
    "price_staging": """
        SELECT c_name AS symbol, o_orderkey AS seq,
            CASE WHEN o_orderkey % 97 = 0 THEN 'None' WHEN o_orderkey % 89 = 0 THEN '' WHEN o_orderkey % 83 = 0 THEN '2024-02-30'
                ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date_text,
            CASE WHEN o_orderkey % 79 = 0 THEN 'n/a' WHEN o_orderkey % 73 = 0 THEN '-1.50'
                ELSE CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS STRING) END AS close_text,
            CAST(o_orderkey * 7 % 100000 AS STRING) AS volume_text
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "prices": """
        SELECT symbol, date, close, volume, seq FROM (
            SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY seq DESC) AS rn FROM (
                SELECT symbol, TRY_CAST(CASE WHEN date_text IN ('None', '') THEN NULL ELSE date_text END AS DATE) AS date,
                    TRY_CAST(close_text AS DECIMAL(18,4)) AS close, TRY_CAST(volume_text AS DECIMAL(20,0)) AS volume, seq
                FROM price_staging) x
            WHERE symbol IS NOT NULL AND date IS NOT NULL AND close > 0) y
        WHERE rn = 1""",
    "statements": """
        SELECT symbol, fiscal_date_ending, period_type, sum(x) AS total_assets, sum(q) * 1500 AS total_liabilities,
            sum(x) - sum(q) * 1500 + CASE WHEN CAST(substr(symbol, 10) AS INT) % 3 = 0 THEN 2000 ELSE 0 END AS total_equity,
            sum(x) AS net_income, count(*) AS n_lines
        FROM (
            SELECT s_name AS symbol, last_day(make_date(CAST(year(l_shipdate) AS INT), CAST(quarter(l_shipdate) * 3 AS INT), 1)) AS fiscal_date_ending, 'quarterly' AS period_type,
                CAST(l_extendedprice AS DECIMAL(18,2)) AS x, CAST(l_quantity AS DECIMAL(18,2)) AS q
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
            UNION ALL
            SELECT s_name, make_date(CAST(year(l_shipdate) AS INT), 12, 31), 'annual', CAST(l_extendedprice AS DECIMAL(18,2)), CAST(l_quantity AS DECIMAL(18,2))
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) z
        GROUP BY symbol, fiscal_date_ending, period_type""",
    "wm": """
        SELECT source AS table_name, symbol, name, exchange, asset_type, status, ipo_date, delisting_date,
            CASE WHEN source = 'ETF_PROFILE' THEN CASE WHEN asset_type = 'ETF' THEN 'YES' ELSE 'NO' END
                WHEN source = 'TIME_SERIES_DAILY_ADJUSTED' THEN 'YES'
                WHEN source = 'COMPANY_OVERVIEW' THEN CASE WHEN asset_type = 'Stock' THEN 'YES' ELSE 'NO' END
                WHEN asset_type = 'Stock' AND status = 'Active' THEN 'YES' ELSE 'NO' END AS api_eligible,
            CASE WHEN (n + length(source)) % 2 = 0 THEN DATE '1996-01-01' + CAST(n % 365 AS INT) END AS first_fiscal_date,
            CASE WHEN (n + length(source)) % 2 = 0 THEN DATE '2001-08-02' - CAST((n * 7 + length(source)) % 300 AS INT) END AS last_fiscal_date,
            CASE WHEN n % 7 <> 0 THEN CAST(DATE '2001-08-02' - CAST(n % 60 AS INT) AS TIMESTAMP) END AS last_successful_run,
            CASE WHEN n % 13 <> 0 THEN CAST(n % 12 AS INT) END AS consecutive_failures, n
        FROM listing CROSS JOIN (SELECT explode_sources.source FROM (VALUES """
    + ", ".join(f"('{s}')" for s in SOURCES)
    + """) AS explode_sources(source)) src""",
    "run_log": """
        SELECT event_id AS run_id, CAST(ts AS TIMESTAMP) AS start_ts,
            CASE WHEN event_id % 17 <> 0 THEN CAST(ts AS TIMESTAMP) + INTERVAL '1' SECOND * (CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) * 60) END AS end_ts,
            CAST(user_id AS STRING) AS user_name, event_type AS kind,
            concat(CASE event_id % 5 WHEN 0 THEN 'MERGE INTO ' WHEN 1 THEN 'COPY INTO ' WHEN 2 THEN 'INSERT INTO ' WHEN 3 THEN 'SELECT * FROM ' ELSE 'SHOW ' END,
                'T', CAST(user_id % 10 AS STRING)) AS text,
            CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'OK' END AS status,
            CASE WHEN event_type = 'error' THEN concat('E', CAST(event_id % 4 AS STRING)) END AS error,
            CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) * 4000 AS elapsed_ms,
            CAST(CAST(value AS DECIMAL(18,4)) AS DOUBLE) AS credits,
            event_id * 1024 % 5000000 AS bytes_read, CASE WHEN event_id % 6 = 0 THEN 0 ELSE event_id * 333 % 9000000 END AS bytes_written
        FROM events""",
    "file_log": """
        SELECT concat('f', CAST(event_id % 500 AS STRING), '.csv') AS file, concat('T', CAST(user_id % 10 AS STRING)) AS table_name,
            concat('p', CAST(user_id % 3 AS STRING)) AS pipe, CAST(ts AS TIMESTAMP) AS load_ts,
            CASE WHEN event_id % 9 = 0 THEN 0 ELSE event_id % 400 END AS n_rows, event_id * 77 % 100000 AS n_bytes,
            CASE WHEN event_type = 'error' THEN 'LOAD_FAILED' ELSE 'LOADED' END AS status,
            CASE WHEN event_type = 'error' THEN concat('bad cell ', CAST(event_id % 3 AS STRING)) END AS error
        FROM events""",
    "table_stats": """
        SELECT 'PUBLIC' AS schema_name, concat('T', CAST(user_id % 10 AS STRING)) AS table_name, count(*) * 1000 AS n_rows,
            sum(event_id) * 1000 AS n_bytes, CASE WHEN user_id % 10 < 4 THEN concat('K', CAST(user_id % 10 AS STRING)) END AS layout_key
        FROM events GROUP BY user_id % 10""",
    "insiders": """
        SELECT c_name AS symbol, CAST(o_orderdate AS DATE) AS transaction_date,
            CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat('Insider ', CAST(o_orderkey % 50 AS STRING)) END AS insider_name,
            CASE WHEN o_orderstatus = 'F' THEN 'A' WHEN o_orderstatus = 'O' THEN 'D' ELSE 'X' END AS transaction_type,
            CAST(o_orderkey % 900 AS DECIMAL(18,4)) AS shares, CAST(o_totalprice AS DECIMAL(18,4)) AS price_per_share, o_orderkey AS seq
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "transcripts": """
        SELECT concat('S', CAST(conv_id % 40 AS STRING)) AS symbol, concat(CAST(2000 + conv_id % 3 AS STRING), 'Q', CAST(1 + conv_id % 4 AS STRING)) AS quarter,
            CASE WHEN turn % 5 = 4 THEN NULL ELSE role END AS speaker, CAST(turn AS INT) AS turn, text AS content, conv_id
        FROM conversations""",
    "etf_parts": """
        SELECT s_name AS symbol, p_brand AS sector, concat('P', CAST(p_partkey AS STRING)) AS holding, p_name AS description,
            sum(CAST(l_quantity AS DECIMAL(18,2))) AS weight
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
        GROUP BY s_name, p_brand, p_partkey, p_name""",
    "overview": """
        SELECT symbol, CASE WHEN n % 10 = 0 THEN NULL ELSE concat('Sector ', CAST(n % 11 AS STRING)) END AS sector, concat('Industry ', CAST(n % 23 AS STRING)) AS industry,
            CAST(n * 1000003 % 900000000 AS DECIMAL(38,0)) AS market_capitalization,
            CASE WHEN n % 6 = 0 THEN 'None' WHEN n % 6 = 1 THEN NULL ELSE CAST(DATE '2001-06-30' - CAST(n % 500 AS INT) AS STRING) END AS latest_quarter,
            DATE '2001-08-02' - CAST(n % 600 AS INT) AS load_date, n
        FROM listing WHERE asset_type = 'Stock'""",
}


def day() -> Column:
    return F.lit(AS_OF).cast("date")


def now() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def run_at() -> Column:
    return F.lit(RUN_AT).cast("timestamp")


def needed(text: str) -> list[str]:
    """Definitions that a statement uses, in an order in which each can be read."""
    found: list[str] = []

    def visit(body: str) -> None:
        for name in VIEWS:
            if name not in found and re.search(rf"\b{name}\b", body):
                visit(VIEWS[name])
                if name not in found:
                    found.append(name)

    visit(text)
    return found


def sql(text: str) -> str:
    """A statement with the definitions it names; ``{symbol_id:x}`` is the key of x."""
    text = re.sub(r"\{symbol_id:(\w+(?:\.\w+)?)\}", lambda m: SYMBOL_ID["other"].format(m[1]), text)
    names = needed(text)
    own = re.sub(r"^\s*WITH\s+", "", text, flags=re.I) if re.match(r"\s*WITH\s", text, re.I) else None
    parts = [f"{n} AS ({VIEWS[n]})" for n in names]
    if not parts:
        return text
    return "WITH " + ", ".join(parts) + (", " + own if own is not None else " " + text)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived or given table. Definitions are read with the given tables as sub-selects, so no view is registered."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    names = [*needed(VIEWS[name]), name]
    given = [b for b in BASE if any(re.search(rf"\b{b}\b", VIEWS[n]) for n in names)]
    parts = [f"{b} AS (SELECT * FROM parquet.`{sf_dir}/{b}.parquet`)" for b in given] + [f"{n} AS ({VIEWS[n]})" for n in names]
    return spark.sql("WITH " + ", ".join(parts) + f" SELECT * FROM {name}")
