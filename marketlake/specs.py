"""What differs between data sources, as data: keys, eligibility, refresh policy."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.sources.payloads import STATEMENTS


@dataclass(frozen=True)
class SourceSpec:
    """A source of the control table and how its files load."""

    name: str
    keys: tuple[str, ...]  # names, or SQL expressions over the columns
    merge: str = "upsert"  # upsert, insert_only or replace
    asset_types: tuple[str, ...] = ("Stock",)
    active_only: bool = False
    staleness_days: int | None = None  # None: pull only what was never pulled
    decimals: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    doubles: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    raw: bool = False  # texts are kept as they came, missing-value tokens too

    def eligible(self, asset_type: Column, status: Column) -> Column:
        fits = asset_type.isin(*self.asset_types)
        return fits & (status == "Active") if self.active_only else fits


#: Digits of the overview's numbers (fixed values).
OVERVIEW = {
    "market_capitalization": (20, 0), "ebitda": (20, 0), "pe_ratio": (10, 2), "peg_ratio": (10, 4), "book_value": (10, 2), "dividend_per_share": (10, 4), "dividend_yield": (10, 6), "eps": (10, 4),
    "revenue_per_share_ttm": (10, 4), "profit_margin": (10, 6), "operating_margin_ttm": (10, 6), "return_on_assets_ttm": (10, 6), "return_on_equity_ttm": (10, 6), "revenue_ttm": (20, 0),
    "gross_profit_ttm": (20, 0), "diluted_eps_ttm": (10, 4), "quarterly_earnings_growth_yoy": (10, 6), "quarterly_revenue_growth_yoy": (10, 6), "analyst_target_price": (10, 2), "trailing_pe": (10, 2),
    "forward_pe": (10, 2), "price_to_sales_ratio_ttm": (10, 4), "price_to_book_ratio": (10, 4), "ev_to_revenue": (10, 4), "ev_to_ebitda": (10, 4), "beta": (10, 6), "week_52_high": (10, 2),
    "week_52_low": (10, 2), "day_50_moving_average": (10, 2), "day_200_moving_average": (10, 2), "shares_outstanding": (20, 0),
}
PRICES = {"open": (18, 4), "high": (18, 4), "low": (18, 4), "close": (18, 4), "adjusted_close": (20, 4), "volume": (20, 0), "dividend_amount": (18, 6), "split_coefficient": (18, 6)}


#: Digits of a statement's numbers (fixed values).
STATEMENT_DIGITS = {"BALANCE_SHEET": (38, 2), "INCOME_STATEMENT": (20, 2), "CASH_FLOW": (38, 2)}


def _numbers(source: str) -> dict[str, tuple[int, int]]:
    return {c: STATEMENT_DIGITS[source] for c in STATEMENTS[source] if c != "reported_currency"}


_REPORT = {"keys": ("symbol", "fiscal_date_ending", "period_type"), "active_only": True, "staleness_days": 135, "dates": ("fiscal_date_ending",), "required": ("symbol", "fiscal_date_ending", "period_type")}

SPECS = {
    s.name: s
    for s in (
        SourceSpec("TIME_SERIES_DAILY_ADJUSTED", ("symbol", "date"), asset_types=("Stock", "ETF"), staleness_days=5, decimals=PRICES, dates=("date",), required=("symbol", "date")),
        SourceSpec("COMPANY_OVERVIEW", ("symbol",), decimals=OVERVIEW, dates=("latest_quarter", "dividend_date", "ex_dividend_date"), required=("symbol",)),
        SourceSpec("BALANCE_SHEET", decimals=_numbers("BALANCE_SHEET"), **_REPORT),
        SourceSpec("INCOME_STATEMENT", decimals=_numbers("INCOME_STATEMENT"), **_REPORT),
        SourceSpec("CASH_FLOW", decimals=_numbers("CASH_FLOW"), **_REPORT),
        SourceSpec("INSIDER_TRANSACTIONS", ("symbol", "transaction_date", "insider_name", "transaction_type"), merge="insert_only", active_only=True, staleness_days=30, decimals={"shares": (38, 2), "price_per_share": (38, 4)}, dates=("transaction_date",), required=("symbol", "transaction_date", "transaction_type")),
        SourceSpec("EARNINGS_CALL_TRANSCRIPT", ("symbol", "quarter", "speaker", "sentiment", "left(content, 50)", "right(content, 50)"), merge="insert_only", active_only=True, staleness_days=135, doubles=("sentiment",), required=("symbol", "quarter")),
        SourceSpec("ETF_PROFILE", ("symbol",), merge="replace", asset_types=("ETF",), required=("symbol",), raw=True),
    )
}


def eligibility(source: Column, asset_type: Column, status: Column, delisting: Column | None = None, as_of: Column | None = None) -> Column:
    """YES or NO by the source's rule; with dates, DEL for an eligible symbol that is already delisted."""
    out = F.lit("NO")
    for s in SPECS.values():
        out = F.when((source == s.name) & F.coalesce(s.eligible(asset_type, status), F.lit(False)), F.lit("YES")).otherwise(out)
    if delisting is not None:
        out = F.when((out == "YES") & (delisting <= as_of), F.lit("DEL")).otherwise(out)
    return out
