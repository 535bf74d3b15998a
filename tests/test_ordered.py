"""Ordered scans: the split form for hot keys equals the plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from viewtide.operators import aggregates, keys, windows
from viewtide.operators.ordered import Ordered, following, previous, running_count, running_max, running_sum

ORDER = ["ts", "id"]


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds a third of the rows, one is NULL, times repeat, values may be NULL."""
    rng = random.Random(3)
    data = []
    for i in range(3000):
        key = 7 if i % 3 == 0 else rng.choice([None, 1, 2, 3, 4, 5])
        data.append((key, rng.randrange(900), i, None if rng.random() < 0.1 else rng.randrange(50)))
    return spark.createDataFrame(data, "k int, ts bigint, id int, v int").repartition(5).cache()


SCANS = {"prev": lambda: previous("v"), "nxt": lambda: following("v"), "total": lambda: running_sum("v"),
         "top": lambda: running_max("v"), "n": running_count}


def plain(df, keys_):
    w = Window.partitionBy(*keys_).orderBy(*ORDER)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", F.lag("v").over(w).alias("prev"), F.lead("v").over(w).alias("nxt"),
                     F.sum("v").over(upto).alias("total"), F.max("v").over(upto).alias("top"),
                     F.count(F.lit(1)).over(upto).alias("n"))


def as_set(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.mark.parametrize("keys_", [["k"], []])
@pytest.mark.parametrize("hot_rows", [40, 700, 10_000])
def test_split_equals_window(rows, keys_, hot_rows):
    split = Ordered.split(rows, keys_, ORDER, hot_rows=hot_rows)
    hot = split.frame.where("__chunk >= 0").count()
    assert (hot == 0) == (hot_rows > 3000) and (hot == 3000 or keys_ and hot_rows > 40 or hot == 0)
    got = split.scan(**{n: s() for n, s in SCANS.items()}).df
    assert as_set(got) == as_set(plain(rows, keys_))


def test_hot_key_is_spread(rows):
    split = Ordered.split(rows, ["k"], ORDER, hot_rows=100)
    sizes = [r["count"] for r in split.frame.where("k = 7").groupBy("__chunk").count().collect()]
    assert len(sizes) >= 8 and max(sizes) < 300


def test_one_key_in_a_small_file_is_split(spark, path):
    """Six million rows of one key compress to a few megabytes and still need more than one task."""
    spark.range(6_000_000).selectExpr("1 as k", "id as ts", "1 as v").write.parquet(path)
    split = Ordered.split(spark.read.parquet(path), ["k"], ["ts"])
    sizes = [r["count"] for r in split.frame.groupBy("__chunk").count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 4_000_000


def test_every_hot_key_is_split(spark):
    df = spark.range(60_000).selectExpr("id % 1500 as k", "id as ts", "cast(id as int) as id", "1 as v")
    split = Ordered.split(df, ["k"], ORDER, hot_rows=20)
    assert split.frame.where("__chunk >= 0").select("k").distinct().count() == 1500
    assert as_set(split.scan(n=running_count()).df.select("id", "n")) == as_set(df.selectExpr("id", "id div 1500 + 1 as n"))


def test_ties_of_one_instant_are_split(spark):
    """All rows of a key at one instant: the tie-break still splits them."""
    df = spark.range(2000).selectExpr("1 as k", "5L as ts", "cast(id as int) as id", "1 as v")
    split = Ordered.split(df, ["k"], ORDER, hot_rows=100)
    assert split.frame.select("__chunk").distinct().count() > 10
    got = split.scan(n=running_count()).df
    assert got.where("n <> id + 1").count() == 0


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_sessionize_edges(spark, hot_rows):
    base = 1_700_000_000
    gaps = [0, 1800, 1801, 10, 1800, 5000]
    times, t = [], base
    for g in gaps * 40:
        t += g
        times.append(t)
    df = spark.createDataFrame([("u", i, x) for i, x in enumerate(times)], "u string, id int, s bigint").select(
        "u", "id", F.timestamp_seconds("s").alias("ts"))
    got = windows.sessionize(df, ["u"], ["ts", "id"], "ts", 1800, hot_rows=hot_rows)
    expect, num, last = {}, 0, None
    for i, x in enumerate(times):
        if last is None or x - last > 1800:
            num += 1
        expect[i], last = num, x
    assert {r["id"]: r["session_num"] for r in got.collect()} == expect


@pytest.mark.parametrize("hot_rows", [None, 30])
def test_percentiles_exact(rows, hot_rows):
    got = aggregates.percentiles(rows, ["k"], "ts", {"p50": 0.5, "p90": 0.9}, hot_rows=hot_rows)
    want = rows.groupBy("k").agg(F.percentile("ts", 0.5).alias("p50"), F.percentile("ts", 0.9).alias("p90"))
    key = lambda r: -1 if r["k"] is None else r["k"]
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert a["k"] == b["k"] and a["p50"] == pytest.approx(b["p50"]) and a["p90"] == pytest.approx(b["p90"])


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_rank_all(rows, hot_rows):
    w = Window.orderBy(F.desc_nulls_last("v"))
    known = rows.where("v is not null").select("id", "v", F.rank().over(w).cast("bigint").alias("rank"),
                                               F.dense_rank().over(w).cast("bigint").alias("dense_rank"))
    got = keys.rank_all(rows.select("id", "v"), "v", hot_rows=hot_rows)
    assert as_set(got.where("v is not null")) == as_set(known)
    assert got.where("v is null and rank is null").count() == rows.where("v is null").count()


def test_rank_ties(spark):
    df = spark.createDataFrame([(1, 300), (2, 300), (3, 120)], "id int, v int")
    got = {r["id"]: (r["rank"], r["dense_rank"]) for r in keys.rank_all(df, "v").collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 2)}


@pytest.mark.parametrize("hot_rows", [None, 50])
def test_assign_keys(spark, hot_rows):
    names = [f"n{x:05d}" for x in random.Random(1).sample(range(90000), 1500)]
    df = spark.createDataFrame([(n,) for n in names], "nk string").repartition(6)
    got = {r["nk"]: r["key"] for r in keys.assign_keys(df, "nk", "key", 10, hot_rows=hot_rows).collect()}
    assert got == {n: i + 11 for i, n in enumerate(sorted(names))}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df):
    """The plan that adaptive execution ended with."""
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


def test_split_scan_shuffles_the_detail_once(rows):
    """Shuffles: the picked rows, detail by key and chunk, chunk summaries, and the carry window over the summaries."""
    plan = ran(Ordered.split(rows, ["k"], ORDER, hot_rows=100).scan(prev=previous("v"), total=running_sum("v")).df)
    assert plan.count("Exchange hashpartitioning(k") <= 5 and "SortMergeJoin" not in plan
    assert plan.count("Window [") <= 3  # detail (twice: lag and running) and carries


def test_whole_table_scan_has_no_single_task_over_the_detail(rows):
    """Only picked rows meet in one partition, and the summaries (one row per chunk)."""
    plan = plan_of(Ordered.split(rows, [], ORDER, hot_rows=100).scan(n=running_count()).df)
    assert "SinglePartition" not in plan.split("Window [sum(1)")[0].split("Exchange")[0]
    sizes = Ordered.split(rows, [], ORDER, hot_rows=100).frame.groupBy("__chunk").count().collect()
    assert len(sizes) > 15 and max(r["count"] for r in sizes) < 300


def test_small_input_ends_with_the_plain_window(rows):
    plan = ran(Ordered.split(rows, ["k"], ORDER).scan(n=running_count(), prev=previous("v")).df)
    assert plan.count("Exchange hashpartitioning(k") == 1 and "Join" not in plan


def test_no_job_while_a_plan_is_built(spark, rows):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    for hot_rows in (None, 50):
        windows.sessionize(rows.withColumn("ts", F.timestamp_seconds("ts")), ["k"], ORDER, "ts", hot_rows=hot_rows)
        keys.rank_all(rows, "v", hot_rows=hot_rows)
        keys.assign_keys(rows.select("id"), "id", "key", hot_rows=hot_rows)
        aggregates.percentiles(rows, ["k"], "ts", {"p50": 0.5}, hot_rows=hot_rows)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_rolling_actives_brute_force(spark):
    import datetime as dt
    rng = random.Random(5)
    data = {(rng.randrange(12), dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(60))) for _ in range(150)}
    df = spark.createDataFrame([*data, *data], "u int, d date")
    got = {r["d"]: r["actives"] for r in windows.rolling_actives(df, "u", "d", 7).collect()}
    first, last = min(d for _, d in data), max(d for _, d in data)
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    assert got == {d: len({u for u, x in data if d - dt.timedelta(days=7) < x <= d}) for d in days}
