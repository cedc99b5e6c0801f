"""Raw payloads of a market-data service into rows. A payload is one JSON document or CSV text in a column."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import scalar


def classify(df: DataFrame, text: str, needs: Sequence[str]) -> DataFrame:
    """``outcome``: undecodable, api_error, rate_limited, no_data (none of the needed keys holds anything) or ok."""
    v = F.try_parse_json(text)
    has = lambda p: F.try_variant_get(v, f"$['{p}']", "string").isNotNull()
    any_ = F.lit(False)
    for key in needs:
        any_ |= F.coalesce(F.size(F.try_variant_get(v, f"$.{key}", "array<variant>")) > 0, F.lit(False))
    label = F.when(v.isNull(), "undecodable").when(has("Error Message"), "api_error").when(has("Note"), "rate_limited").when(~any_, "no_data").otherwise("ok")
    return df.withColumn("outcome", label)


def reports(df: DataFrame, text: str, fields: Mapping[str, str], key: str = "symbol") -> DataFrame:
    """Annual and quarterly reports of a payload as rows. fields: column name -> name in the payload."""
    struct = "array<struct<" + ",".join(f"`{p}`:string" for p in fields.values()) + ">>"
    kinds = {"annual": "annualReports", "quarterly": "quarterlyReports"}
    docs = df.select(key, F.try_parse_json(text).alias("_v"))
    lists = F.array(*(F.struct(F.lit(period).alias("period_type"), F.try_variant_get("_v", f"$.{path}", struct).alias("rows")) for period, path in kinds.items()))
    rows = docs.select(key, F.explode(lists).alias("p")).select(key, "p.period_type", F.explode("p.rows").alias("r"))
    return rows.select(key, "period_type", *(F.col(f"r.`{p}`").alias(c) for c, p in fields.items()))


#: Columns of the statements after the key (fixed values).
INCOME_STATEMENT = """reported_currency gross_profit total_revenue cost_of_revenue cost_of_goods_and_services_sold operating_income
    selling_general_and_administrative research_and_development operating_expenses investment_income_net net_interest_income interest_income
    interest_expense non_interest_income other_non_operating_income depreciation depreciation_and_amortization income_before_tax
    income_tax_expense interest_and_debt_expense net_income_from_continuing_operations comprehensive_income_net_of_tax ebit ebitda net_income""".split()
CASH_FLOW = """reported_currency operating_cashflow payments_for_operating_activities proceeds_from_operating_activities
    change_in_operating_liabilities change_in_operating_assets depreciation_depletion_and_amortization capital_expenditures
    change_in_receivables change_in_inventory profit_loss cashflow_from_investment cashflow_from_financing proceeds_from_repurchase_of_equity
    proceeds_from_sale_of_long_term_investments payments_for_acquisition_of_long_term_investments proceeds_from_issuance_of_long_term_debt
    proceeds_from_issuance_of_common_stock proceeds_from_repayments_of_short_term_debt payments_for_repurchase_of_common_stock
    payments_for_repurchase_of_preferred_stock dividend_payout dividend_payout_common_stock dividend_payout_preferred_stock
    proceeds_from_sale_of_ppe change_in_cash_and_cash_equivalents change_in_exchange_rate net_income""".split()
BALANCE_SHEET = """reported_currency total_assets total_current_assets cash_and_cash_equivalents_at_carrying_value
    cash_and_short_term_investments inventory current_net_receivables total_non_current_assets property_plant_equipment
    accumulated_depreciation_amortization_ppe intangible_assets intangible_assets_excluding_goodwill goodwill investments
    long_term_investments short_term_investments other_current_assets other_non_current_assets total_liabilities total_current_liabilities
    current_accounts_payable deferred_revenue current_debt short_term_debt total_non_current_liabilities capital_lease_obligations
    long_term_debt current_long_term_debt long_term_debt_noncurrent short_long_term_debt_total other_current_liabilities
    other_non_current_liabilities total_shareholder_equity treasury_stock retained_earnings common_stock common_stock_shares_outstanding""".split()
STATEMENTS = {"INCOME_STATEMENT": INCOME_STATEMENT, "CASH_FLOW": CASH_FLOW, "BALANCE_SHEET": BALANCE_SHEET}

#: Columns whose name in the payload isn't their own in camel case (fixed values).
RENAMED = {
    "cost_of_goods_and_services_sold": "costofGoodsAndServicesSold",
    "proceeds_from_issuance_of_long_term_debt": "proceedsFromIssuanceOfLongTermDebtAndCapitalSecuritiesNet",
    "proceeds_from_sale_of_ppe": "proceedsFromSaleOfPropertyPlantAndEquipment",
    "accumulated_depreciation_amortization_ppe": "accumulatedDepreciationAmortizationPPE",
}


def statement_fields(source: str) -> dict[str, str]:
    """Every column of a statement but symbol and period, with its name in the payload."""
    return {c: RENAMED.get(c, camel(c)) for c in ("fiscal_date_ending", *STATEMENTS[source])}


#: Text columns of the overview, words of its names in capitals, and names that no rule gives (fixed values).
OVERVIEW_TEXTS = "symbol asset_type name description cik exchange currency country sector industry address fiscal_year_end".split()
OVERVIEW_DATES = "latest_quarter dividend_date ex_dividend_date".split()
CAPITALS = "cik ebitda pe peg eps ttm yoy ev".split()
OVERVIEW_RENAMED = {"week_52_high": "52WeekHigh", "week_52_low": "52WeekLow", "day_50_moving_average": "50DayMovingAverage", "day_200_moving_average": "200DayMovingAverage"}
#: Columns of an insider transaction with their names in the payload (fixed values).
INSIDER_FIELDS = {
    "symbol": "ticker", "transaction_date": "transaction_date", "transaction_type": "acquisition_or_disposal", "shares": "shares",
    "price_per_share": "share_price", "insider_name": "executive", "insider_title": "executive_title",
}
#: Fields of a fund's profile: texts, and lists of structures of texts (fixed values).
ETF_TEXTS = "net_assets net_expense_ratio portfolio_turnover dividend_yield inception_date leveraged".split()
ETF_LISTS = {"sectors": ("sector", "weight"), "holdings": ("symbol", "description", "weight")}


def overview_fields(numbers: Iterable[str]) -> dict[str, str]:
    """Every column of the overview with its name in the payload."""
    pascal = lambda c: "".join(w.upper() if w in CAPITALS else w.capitalize() for w in c.split("_"))
    return {c: OVERVIEW_RENAMED.get(c, pascal(c)) for c in (*OVERVIEW_TEXTS, *OVERVIEW_DATES, *numbers)}


def overview_rows(df: DataFrame, text: str, numbers: Iterable[str]) -> DataFrame:
    """A payload's fields as text columns; other columns stay."""
    fields = overview_fields(numbers)
    struct = "struct<" + ",".join(f"`{p}`:string" for p in fields.values()) + ">"
    rest = [c for c in df.columns if c != text]
    rows = df.select(*rest, F.try_variant_get(F.try_parse_json(text), "$", struct).alias("_r"))
    return rows.select(*rest, *(F.col(f"_r.`{p}`").alias(c) for c, p in fields.items()))


def etf_rows(df: DataFrame, text: str, file: str) -> DataFrame:
    """A fund's profile as it came, the symbol from the file's name."""
    v = F.try_parse_json(text)
    lists = {c: "array<struct<" + ",".join(f"{f}:string" for f in fields) + ">>" for c, fields in ETF_LISTS.items()}
    symbol = F.split_part(F.split_part(F.col(file), F.lit("/"), F.lit(-1)), F.lit("."), F.lit(1))
    return df.select(symbol.alias("symbol"), *(F.try_variant_get(v, f"$.{c}", "string").alias(c) for c in ETF_TEXTS), *(F.try_variant_get(v, f"$.{c}", kind).alias(c) for c, kind in lists.items()))


def camel(column: str) -> str:
    head, *rest = column.split("_")
    return head + "".join(w.capitalize() for w in rest)


def header_ok(df: DataFrame, text: str, start: str = "symbol") -> DataFrame:
    """Whether a CSV payload's first line begins as it should; error texts and demo answers don't."""
    return df.withColumn("header_ok", F.coalesce(F.startswith(F.lower(F.split(F.col(text), "\n")[0]), F.lit(start)), F.lit(False)))


def price_rows(df: DataFrame, rename: Mapping[str, str], symbol: Column) -> DataFrame:
    """Columns renamed and reordered, symbol first."""
    return df.select(symbol.alias("symbol"), *(F.col(a).alias(b) for a, b in rename.items()))


def insider_rows(df: DataFrame, text: str, fields: Sequence[str]) -> DataFrame:
    struct = "array<struct<" + ",".join(f"`{f}`:string" for f in fields) + ">>"
    return df.select(*(c for c in df.columns if c != text), F.explode(F.try_variant_get(F.try_parse_json(text), "$.data", struct)).alias("r")).select(*(c for c in df.columns if c != text), "r.*")


#: Keys under which a payload holds its series (fixed values).
SERIES_KEYS = ("data", "monthly", "Monthly Time Series", "Monthly Prices", "Time Series (Monthly)")


def series_rows(df: DataFrame, text: str, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """(other columns, date, value) of a series given as a list of {date, value} or as a map of dates, under the first of the keys that is there."""
    v = F.try_parse_json(text)
    as_list = F.coalesce(*(F.try_variant_get(v, f"$['{k}']", "array<struct<date:string,value:string>>") for k in keys))
    as_map = F.coalesce(*(F.try_variant_get(v, f"$['{k}']", "map<string,string>") for k in keys))
    pairs = F.transform(F.map_entries(as_map), lambda e: F.struct(e["key"].alias("date"), e["value"].alias("value")))
    rest = [c for c in df.columns if c != text]
    rows = df.select(*rest, F.explode(F.coalesce(as_list, pairs)).alias("p"))
    return rows.select(*rest, scalar.to_date(F.col("p.date")).alias("date"), scalar.to_double(F.col("p.value")).alias("value")).where("date IS NOT NULL")


#: The economic series: function, interval, name, maturity (fixed values).
INDICATORS = (
    ("REAL_GDP", "quarterly", "Real GDP", None),
    ("REAL_GDP_PER_CAPITA", "quarterly", "Real GDP Per Capita", None),
    ("TREASURY_YIELD_10YEAR", "daily", "Treasury Yield 10 Year", "10year"),
    ("TREASURY_YIELD_3MONTH", "daily", "Treasury Yield 3 Month", "3month"),
    ("TREASURY_YIELD_2YEAR", "daily", "Treasury Yield 2 Year", "2year"),
    ("TREASURY_YIELD_5YEAR", "daily", "Treasury Yield 5 Year", "5year"),
    ("TREASURY_YIELD_7YEAR", "daily", "Treasury Yield 7 Year", "7year"),
    ("TREASURY_YIELD_30YEAR", "daily", "Treasury Yield 30 Year", "30year"),
    ("FEDERAL_FUNDS_RATE", "daily", "Federal Funds Rate", None),
    ("CPI", "monthly", "Consumer Price Index", None),
    ("INFLATION", "monthly", "Inflation Rate", None),
    ("RETAIL_SALES", "monthly", "Retail Sales", None),
    ("DURABLES", "monthly", "Durable Goods Orders", None),
    ("UNEMPLOYMENT", "monthly", "Unemployment Rate", None),
    ("NONFARM_PAYROLL", "monthly", "Total Nonfarm Payroll", None),
)

#: The commodity series; all are pulled by month (fixed values).
COMMODITIES = ("WTI", "BRENT", "NATURAL_GAS", "COPPER", "ALUMINUM", "WHEAT", "CORN", "COTTON", "SUGAR", "ALL_COMMODITIES")


def catalogue(spark: SparkSession) -> DataFrame:
    names = ("function_name", "interval", "indicator_name", "maturity")
    rows = F.array(*(F.struct(*(F.lit(v).cast("string").alias(n) for n, v in zip(names, r, strict=True))) for r in INDICATORS))
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


def commodities(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, COMMODITIES))).alias("commodity"), F.lit("monthly").alias("interval"))


def quarters(df: DataFrame, start: str, end: str) -> DataFrame:
    """A row for each quarter from the one that holds ``start`` to the one that holds ``end``."""
    first, last = F.to_date(F.date_trunc("quarter", start)), F.to_date(F.date_trunc("quarter", end))
    rows = df.where(first <= last).withColumn("quarter_start", F.explode(F.sequence(first, last, F.expr("INTERVAL 3 MONTHS"))))
    return rows.withColumn("quarter", F.concat(F.year("quarter_start"), F.lit("Q"), F.quarter("quarter_start")))


def next_full_quarter(last_fiscal: Column, ipo: Column, floor: Column) -> Column:
    """Where to go on: the quarter after the last one loaded, else after the listing if that isn't before ``floor``, else ``floor``."""
    after = lambda c: F.to_date(F.add_months(F.date_trunc("quarter", c), 3))
    return F.when(last_fiscal.isNotNull(), after(last_fiscal)).when(ipo >= floor, after(ipo)).otherwise(floor)


def date_span(df: DataFrame, key: str, day: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"), F.count("*").alias("n_rows"))
