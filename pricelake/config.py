"""Fixed values and defaults.

FIXED VALUES — these must equal the reference behaviour for results to match:
  * discrepancy tolerance: 0.005 (0.5 % of the two-source mean), strict ">"
  * OHLC ordering rules tolerance ("mostly"): 0.9999; all other rules: 1.0
  * default history start: 2019-01-01
  * primary vendor fetch batch: 50 tickers; identifier request batch: 100
  * secondary vendor request budget: 45 requests per trailing hour
  * gold freshness: 400 current securities, 200 consensus rows per security,
    newest consensus date 0..5 days before the ingest date
  * constituents row band: 480..520
  * macro series and their labels:
      DGS3MO   3-Month Treasury Constant Maturity Rate
      DGS10    10-Year Treasury Constant Maturity Rate
      FEDFUNDS Federal Funds Effective Rate
      CPIAUCSL CPI, All Urban Consumers, Seasonally Adjusted
    CPIAUCSL is an index level (rule: value > 0); the others are rates
    (rule: value in [0, 25]).
  * macro placeholder for "no observation": "."
  * legal-suffix / share-class words removed by the company-name normaliser:
      INC INCORPORATED CORP CORPORATION CO COMPANY PLC LTD LIMITED LLC GROUP
      HOLDING HOLDINGS, and "CLASS <letter>"
  * filing form picked from a filing index: NPORT-P; kept holdings asset
    category: EC
"""

from __future__ import annotations

import datetime as _dt

RECONCILIATION_TOLERANCE = 0.005
OHLC_TOLERANCE = 0.9999
DEFAULT_START_DATE = _dt.date(2019, 1, 1)
PRIMARY_BATCH_SIZE = 50
IDENTIFIER_BATCH_SIZE = 100
SECONDARY_HOURLY_CAP = 45
MIN_SECURITIES = 400
MIN_CONSENSUS_ROWS_PER_SECURITY = 200
MAX_STALENESS_DAYS = 5
CONSTITUENTS_ROW_BAND = (480, 520)

MACRO_SERIES = [
    ("DGS3MO", "3-Month Treasury Constant Maturity Rate"),
    ("DGS10", "10-Year Treasury Constant Maturity Rate"),
    ("FEDFUNDS", "Federal Funds Effective Rate"),
    ("CPIAUCSL", "CPI, All Urban Consumers, Seasonally Adjusted"),
]
INDEX_LEVEL_SERIES = ("CPIAUCSL",)
MACRO_PLACEHOLDER = "."

NAME_SUFFIX_WORDS = [
    "INC", "INCORPORATED", "CORP", "CORPORATION", "CO", "COMPANY", "PLC",
    "LTD", "LIMITED", "LLC", "GROUP", "HOLDING", "HOLDINGS",
]
FILING_FORM = "NPORT-P"
EQUITY_ASSET_CATEGORY = "EC"

# Default vendor labels; every verb takes the labels as parameters.
PRIMARY = "primary"
SECONDARY = "secondary"
