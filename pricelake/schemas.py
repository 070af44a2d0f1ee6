"""Declared schemas for every layer (no inference on read).

FIXED VALUES: names, order and types of the columns are those that the layers'
files and tables must have."""

from __future__ import annotations

from pyspark.sql import types as T

_D = T.DoubleType()
_L = T.LongType()
_S = T.StringType()
_I = T.IntegerType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# ---- bronze -------------------------------------------------------------
PRIMARY_BRONZE = _struct(
    ("date", T.DateType(), True), ("open", _D, True), ("high", _D, True),
    ("low", _D, True), ("close", _D, True), ("adj_close", _D, True),
    ("volume", _L, True), ("dividends", _D, True), ("stock_splits", _D, True),
    ("ticker", _S, True),
)
SECONDARY_BRONZE = _struct(
    ("date", T.DateType(), True), ("open", _D, True), ("high", _D, True),
    ("low", _D, True), ("close", _D, True), ("adj_close", _D, True),
    ("adj_open", _D, True), ("adj_high", _D, True), ("adj_low", _D, True),
    ("adj_volume", _L, True), ("volume", _L, True), ("ticker", _S, True),
)
PRICE_REQUIRED = {"date", "open", "high", "low", "close", "adj_close", "volume", "ticker"}
NATIVE_ADJUSTED = {"adj_open", "adj_high", "adj_low", "adj_volume"}

CONSTITUENTS_BRONZE = _struct(
    ("ticker", _S, True), ("company_name", _S, True), ("gics_sector", _S, True),
    ("gics_sub_industry", _S, True), ("date_added", T.DateType(), True),
    ("snapshot_date", T.DateType(), True),
)
MACRO_BRONZE = _struct(("date", T.DateType(), True), ("series_id", _S, True), ("value", _D, True))
IDENTIFIER_BRONZE = _struct(
    ("ticker", _S, True), ("figi", _S, True), ("composite_figi", _S, True),
    ("share_class_figi", _S, True), ("name", _S, True),
    ("security_type", _S, True), ("market_sector", _S, True),
)

# ---- silver -------------------------------------------------------------
SILVER_COLUMNS = [
    "ticker", "date", "open", "high", "low", "close", "adj_close",
    "adj_open", "adj_high", "adj_low", "volume", "adj_volume",
]
SILVER = _struct(
    ("ticker", _S, True), ("date", T.DateType(), True), ("open", _D, True),
    ("high", _D, True), ("low", _D, True), ("close", _D, True),
    ("adj_close", _D, True), ("adj_open", _D, True), ("adj_high", _D, True),
    ("adj_low", _D, True), ("volume", _L, True), ("adj_volume", _L, True),
)

CONSENSUS_COLUMNS = [
    "ticker", "date", "adj_close", "primary_source", "sources_available",
    "pct_diff", "reconciliation_flag",
]

# ---- gold ---------------------------------------------------------------
PRICE = T.DecimalType(18, 6)
PCT = T.DecimalType(9, 6)

DIM_DATE = _struct(
    ("date_key", _I, False), ("date", T.DateType(), False), ("year", _I, False),
    ("quarter", _I, False), ("month", _I, False), ("month_name", _S, False),
    ("day", _I, False), ("day_of_week", _I, False), ("day_name", _S, False),
    ("is_weekday", T.BooleanType(), False), ("is_trading_day", T.BooleanType(), False),
)
DIM_SECURITY = _struct(
    ("security_key", _I, False), ("ticker", _S, False), ("company_name", _S, True),
    ("gics_sector", _S, True), ("gics_sub_industry", _S, True), ("figi", _S, True),
    ("effective_from", T.DateType(), False), ("effective_to", T.DateType(), True),
    ("is_current", T.BooleanType(), False),
)
SCD_ATTRIBUTES = ["company_name", "gics_sector", "gics_sub_industry", "figi"]

FACT_PRICE_DAILY = _struct(
    ("security_key", _I, False), ("date_key", _I, False), ("source", _S, False),
    ("open", PRICE, True), ("high", PRICE, True), ("low", PRICE, True),
    ("close", PRICE, True), ("adj_open", PRICE, True), ("adj_high", PRICE, True),
    ("adj_low", PRICE, True), ("adj_close", PRICE, True), ("volume", _L, True),
    ("adj_volume", _L, True),
)
FACT_CONSENSUS = _struct(
    ("security_key", _I, False), ("date_key", _I, False), ("adj_close", PRICE, False),
    ("primary_source", _S, False), ("sources_available", T.ArrayType(_S, False), False),
    ("pct_diff", PCT, True), ("reconciliation_flag", _S, False),
)
FACT_CORPORATE_ACTION = _struct(
    ("security_key", _I, False), ("date_key", _I, False), ("action_type", _S, False),
    ("value", PRICE, False), ("source", _S, False),
)
FACT_MACRO_RATE = _struct(("date_key", _I, False), ("series_id", _S, False), ("value", PRICE, False))

GOLD_TABLES = {
    "dim_date": (DIM_DATE, ["date_key"]),
    "dim_security": (DIM_SECURITY, ["security_key"]),
    "fact_price_daily": (FACT_PRICE_DAILY, ["security_key", "date_key", "source"]),
    "fact_price_daily_consensus": (FACT_CONSENSUS, ["security_key", "date_key"]),
    "fact_corporate_action": (FACT_CORPORATE_ACTION, ["security_key", "date_key", "action_type", "source"]),
    "fact_macro_rate": (FACT_MACRO_RATE, ["date_key", "series_id"]),
}
