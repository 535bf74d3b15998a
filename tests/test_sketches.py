"""Sketch marts, digest comparison, observed writes and hash keys against exact forms."""

import datetime as dt
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from viewtide.operators import joins, keys, windows
from viewtide.plans import sketches
from viewtide.sources import metrics, tables


@pytest.fixture(scope="module")
def daily(spark):
    rng = random.Random(9)
    start = dt.date(2024, 1, 1)
    rows = [(rng.randrange(4000), start + dt.timedelta(days=rng.randrange(25))) for _ in range(30_000)] + [(None, start)]
    return spark.createDataFrame(rows, "u int, d date")


def test_rolling_viewers_stay_within_the_error(daily):
    stored = sketches.viewer_sketches(daily, "u", "d")
    got = {r.d: r.actives for r in sketches.rolling_viewers(stored, "d", 7).collect()}
    exact = {r.d: r.actives for r in windows.rolling_actives(daily, "u", "d", 7).collect()}
    assert got.keys() == exact.keys() and max(exact.values()) > 3000
    assert all(abs(got[d] - n) <= 4 * 0.0082 * n + 1 for d, n in exact.items()) and got != exact


def test_rolled_up_quantiles_have_a_bounded_rank_error(spark):
    """Groups far larger than the sketch, skewed, with ties."""
    rows = spark.range(200_000).selectExpr("id % 3 as g", "date_add(date'2024-01-01', int(id % 20)) as d",
                                           "cast(pow(id % 7919, 2) / 50 as bigint) as v")
    ps = {"p5": 0.05, "p50": 0.5, "p99": 0.99}
    found = sketches.rolled_up(sketches.quantile_sketches(rows, "v", "d", ["g"]), ["g"], ps)
    errors = sketches.rank_errors(rows, "v", ["g"], found, ps).collect()
    assert len(errors) == 3 and all(0 <= r[f"{n}_rank_error"] <= sketches.RANK_ERROR for r in errors for n in ps)
    wrong = found.withColumn("p50", F.col("p50") * 2)
    assert all(r["p50_rank_error"] > sketches.RANK_ERROR for r in sketches.rank_errors(rows, "v", ["g"], wrong, ps).collect())


def test_digests_find_the_partitions_that_differ(spark, path):
    rows = spark.range(400).selectExpr("id", "date_add(date'2024-01-01', int(id % 8)) as d", "id * 2 as v")
    tables.replace_table(rows, f"{path}/a", ["d"])
    old = tables.read_table(spark, f"{path}/a")
    changed = old.where("id <> 13").withColumn("v", F.when(F.col("id") == 9, 0).otherwise(F.col("v"))).unionByName(
        spark.range(1).selectExpr("999 as id", "date'2025-01-01' as d", "1L as v"))
    tables.replace_table(changed, f"{path}/b", ["d"])
    new = tables.read_table(spark, f"{path}/b")
    differing = joins.differing_partitions(old, new, "d", ["id", "d", "v"])
    assert sorted(map(str, differing)) == ["2024-01-02", "2024-01-06", "2025-01-01"]
    out = joins.compare_partitioned(old, new, "d", ["d", "id"], ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [d") == 2 and "2024-01-03" not in plan and "19724" not in plan
    assert sorted((r["id"], r.status) for r in out.collect()) == [(9, "differs"), (13, "only_left"), (999, "only_right")]
    same = joins.compare_partitioned(old, old, "d", ["d", "id"], ["v"])
    assert same.count() == 0


def test_observed_figures_come_from_the_write(spark, path):
    rows = spark.range(1000).withColumn("d", F.col("id") % 3)
    seen = metrics.observed(rows, lambda df: tables.replace_table(df, path, ["d"]), n=F.count(F.lit(1)), top=F.max("id"))
    assert seen == {"n": 1000, "top": 999} and tables.read_table(spark, path).count() == 1000


def test_hash_keys_are_the_published_xxh64(spark):
    names = ["", "a", "tt0000001", "é" * 50, "x" * 1000]
    got = {r.n: r["key"] for r in keys.hash_keys(spark.createDataFrame([(n,) for n in names], "n string"), "n", "key").collect()}
    want = {n: int.from_bytes(xxhash.xxh64_digest(n.encode(), 42), "big", signed=True) for n in names}
    assert got == want
