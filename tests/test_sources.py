"""Reading the supplied tables: the schema is inferred once, then declared."""

from pricelake.sources import bindings as bind
from pricelake.sources.tables import read_table
from tests.conftest import SF


def test_planning_over_known_tables_starts_no_jobs(spark):
    for t in ("events", "customer", "nation"):
        read_table(spark, SF, t)                       # schemas known from here on
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "plan-only")
    try:
        df = bind.constituents(spark, SF).join(bind.primary_bronze(spark, SF), "ticker", "left_semi")
        assert "ticker" in df.columns
        assert sc.statusTracker().getJobIdsForGroup("plan-only") == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_declared_read_equals_inferred_read(spark):
    first = read_table(spark, SF, "orders")
    again = read_table(spark, SF, "orders")
    assert again.schema == first.schema and again.count() == first.count()
