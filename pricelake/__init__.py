"""pricelake — a Spark-native multi-vendor daily price lake.

Bronze payloads land as dated partitions, a quality gate reports every broken
rule at once, silver turns bars into typed, de-duplicated, adjusted OHLC,
reconciliation compares vendors symmetrically and publishes a consensus price,
and gold keeps a small star schema (calendar, SCD-2 securities, facts).

Everything is DataFrame / SQL code; no Python UDFs.
"""

__version__ = "0.1.0"
