"""Exact ratios and means."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from watchlytics.functions.numbers import mean_of, mean_of_hundredths, ratio_round


def test_ratio_round_is_half_up(spark):
    rng = random.Random(3)
    pairs = [(1026, 3600), (5, 1000), (1, 8), (0, 5), (7, 0), (None, 3), (3, None)]
    pairs += [(rng.randrange(10**6), rng.randrange(1, 5000)) for _ in range(500)]
    pairs.append((9 * 10**17, 10**18))  # would overflow 64 bits
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for digits in (0, 1, 2, 3):
        got = df.select("a", "b", ratio_round(F.col("a"), F.col("b"), digits).alias("r")).collect()
        for a, b, r in got:
            if a is None or not b:
                assert r is None
            else:
                unit = Decimal(1).scaleb(-digits)
                assert r == float((Decimal(a) / Decimal(b)).quantize(unit, ROUND_HALF_UP)), (a, b, digits)


def test_means(spark):
    df = spark.createDataFrame([(1, "0.10"), (2, "0.20"), (None, None)], "n int, r string")
    df = df.withColumn("r", F.col("r").cast("decimal(5,2)"))
    assert df.agg(mean_of(F.col("n")), mean_of_hundredths(F.col("r"))).first() == (1.5, 0.15)
    assert df.where("n > 5").agg(mean_of(F.col("n")), mean_of_hundredths(F.col("r"))).first() == (None, None)
