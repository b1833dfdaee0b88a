"""Sketches: stated rank errors against exact ranks; heavy keys against exact counts."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepool.operators import sketches as S

PS, NAMES = [0.01, 0.5, 0.95, 0.99], ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    """Three keys over five hours: one with skewed values, one of a single value, one without any; a null key."""
    rng = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    at = lambda: t0 + dt.timedelta(seconds=rng.randrange(5 * 3600))
    data = [("x", at(), int(rng.paretovariate(1.1) * 10)) for _ in range(30_000)]
    data += [("one", at(), 7) for _ in range(500)] + [("none", at(), None) for _ in range(20)] + [(None, at(), i) for i in range(100)]
    return spark.createDataFrame(data, "k string, at timestamp, v long").repartition(6).persist()


@pytest.mark.parametrize("error", [0.02, 0.005])
def test_rank_error_of_merged_hours(rows, error, scratch):
    S.quantile_sketches(rows, ["k"], "at", "v", error).write.parquet(f"{scratch}/{error}")
    stored = rows.sparkSession.read.parquet(f"{scratch}/{error}")
    assert stored.groupBy("k").count().where("k = 'x'").first()["count"] == 5
    for hours in (F.lit(True), F.col("hour") >= dt.datetime(2024, 1, 1, 3)):
        got = S.merged_quantiles(stored.where(hours), ["k"], PS, NAMES)
        by = {r.k: r for r in got.collect()}
        assert by["none"].rows > 0 and by["none"].n == 0 and by["none"].b is None
        assert {by["one"][n] for n in NAMES} == {7}
        part = rows.withColumn("hour", F.date_trunc("hour", "at")).where(hours)
        errors = S.rank_errors(part, ["k"], "v", got, PS, NAMES).where("k <> 'none' OR k IS NULL").collect()
        assert len(errors) == 3 and all(r[n] <= error for r in errors for n in NAMES)


def test_sketch_size():
    assert S.sketch_size(0.001) > S.sketch_size(0.01) > S.sketch_size(0.5) >= S.KLL_MIN
    for bad in (0, 1, -1, 1e-9):
        with pytest.raises(ValueError):
            S.sketch_size(bad)


@pytest.mark.parametrize("share", [1.0, 0.3, 0.05, 0.01, 0.001])
def test_heavy_keys_have_full_recall(spark, share):
    rng = random.Random(9)
    keys = [None] * 700 + ["hot"] * 3000 + [f"m{i % 40}" for i in range(4000)] + [f"t{rng.randrange(3000)}" for _ in range(5000)]
    rng.shuffle(keys)
    df = spark.createDataFrame([(k, "x") for k in keys], "key string, _listed string").withColumnRenamed("_listed", "rows2").repartition(7)
    want = {k: n for k, n in Counter(keys).items() if n >= share * len(keys)}
    assert {r.key: r["rows"] for r in S.heavy_keys(df, "key", share).collect()} == want


def test_heavy_keys_of_equal_counts_and_empty(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("k e y"))
    assert S.heavy_keys(df, "k e y", 0.01).count() == 100  # all hold exactly the share
    assert S.heavy_keys(df.limit(0), "k e y", 0.01).count() == 0
    for bad in (0, 1.5, 1e-7):
        with pytest.raises(ValueError):
            S.heavy_keys(df, "k e y", bad)
