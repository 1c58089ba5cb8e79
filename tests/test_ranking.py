"""Global numbers on wide rows, with adaptive execution on and off."""

import pytest
from pyspark.sql import functions as F

from lorekeeper.operators.ranking import numbered


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("n", [0, 1, 100_000, 1_000_000])
def test_no_row_is_lost_and_numbers_run_through(spark, adaptive, n):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        rows = spark.range(n).select(F.expr(f"cast(id * 7919 % {max(n, 1)} as long) as id"), F.repeat(F.md5(F.col("id").cast("string").cast("binary")), 8).alias("wide"))
        got = numbered(rows, ["id"], "k").agg(F.count("*"), F.countDistinct("k"), F.min("k"), F.max("k"), F.count_if(F.col("k") != F.col("id"))).first()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert tuple(got) == ((n, n, 0, n - 1, 0) if n else (0, 0, None, None, 0))
