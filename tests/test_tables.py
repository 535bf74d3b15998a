"""Table sinks: upsert semantics, moved keys, interrupted writers, compaction, retention."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from viewtide.sources import metrics, readers, tables
from viewtide.sources.fs import Files

DDL = "id int, part int, sub int, ver int, val string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def put(df, path, parts=("part",)):
    tables.upsert(df, path, ["id"], list(parts), ["ver"])


def content(spark, path):
    return sorted((r["id"], r["part"], r["ver"], r["val"]) for r in tables.read_table(spark, path).collect())


def test_newest_wins_and_ties_take_incoming(spark, path):
    put(frame(spark, (1, 1, 0, 5, "a"), (2, 1, 0, 5, "a"), (3, 2, 0, 5, "a")), path)
    put(frame(spark, (1, 1, 0, 4, "old"), (2, 1, 0, 5, "tie"), (4, 3, 0, 1, "new")), path)
    assert content(spark, path) == [(1, 1, 5, "a"), (2, 1, 5, "tie"), (3, 2, 5, "a"), (4, 3, 1, "new")]


def test_moved_key_empties_its_partition(spark, path):
    put(frame(spark, (1, 1, 0, 1, "a"), (2, 2, 0, 1, "a")), path)
    put(frame(spark, (1, 2, 0, 2, "b")), path)
    assert content(spark, path) == [(1, 2, 2, "b"), (2, 2, 1, "a")]
    assert not Files(spark, path).exists(f"{path}/part=1")


def test_older_copy_in_another_partition_does_not_duplicate(spark, path):
    put(frame(spark, (1, 1, 0, 9, "a")), path)
    put(frame(spark, (1, 2, 0, 3, "b")), path)
    assert content(spark, path) == [(1, 1, 9, "a")]


def test_duplicates_inside_the_batch(spark, path):
    put(frame(spark, (1, 1, 0, 1, "a"), (1, 1, 0, 3, "c"), (1, 1, 0, 2, "b")), path)
    put(frame(spark, (1, 1, 0, 4, "d"), (1, 1, 0, 5, "e")), path)
    assert content(spark, path) == [(1, 1, 5, "e")]


def test_many_two_level_partitions_and_nulls(spark, path):
    first = frame(spark, *[(i, i % 40, i % 7, 1, "a") for i in range(400)], (1000, None, 1, 1, "a"))
    put(first, path, ("part", "sub"))
    put(frame(spark, *[(i, i % 40, i % 7, 2, "b") for i in range(0, 400, 3)], (1000, None, 1, 2, "b")), path,
        ("part", "sub"))
    got = tables.read_table(spark, path)
    assert got.count() == 401 and got.where("val = 'b'").count() == 135
    assert got.where("id = 1000").first()["part"] is None


def test_untouched_partitions_keep_their_files(spark, path):
    put(frame(spark, (1, 1, 0, 1, "a"), (2, 2, 0, 1, "a")), path)
    before = Files(spark, path).children(f"{path}/part=2")
    put(frame(spark, (1, 1, 0, 2, "b")), path)
    assert Files(spark, path).children(f"{path}/part=2") == before


def test_new_nullable_column(spark, path):
    put(frame(spark, (1, 1, 0, 1, "a"), (2, 1, 0, 1, "a")), path)
    put(frame(spark, (1, 1, 0, 2, "b")).withColumn("extra", F.lit("x")), path)
    rows = {r["id"]: r["extra"] for r in spark.read.option("mergeSchema", True).parquet(path).collect()}
    assert rows == {1: "x", 2: None}


def test_interrupted_writer_is_rolled_forward(spark, path, monkeypatch):
    put(frame(spark, (1, 1, 0, 1, "a"), (2, 2, 0, 1, "a"), (3, 3, 0, 1, "a")), path)
    calls = []
    rename = Files.rename

    def broken(self, src, dst):
        if "/part=" in dst:
            calls.append(dst)
            if len(calls) == 2:
                raise OSError("driver lost")
        rename(self, src, dst)

    monkeypatch.setattr(Files, "rename", broken)
    with pytest.raises(OSError):
        put(frame(spark, (1, 1, 0, 2, "b"), (2, 2, 0, 2, "b"), (3, 3, 0, 2, "b")), path)
    monkeypatch.setattr(Files, "rename", rename)
    tables.roll_forward(spark, path)
    assert content(spark, path) == [(i, i, 2, "b") for i in (1, 2, 3)]
    assert not [n for n, _, _ in Files(spark, path).children(path) if n.startswith("_stage")]


def test_unfinished_staging_is_discarded(spark, path):
    put(frame(spark, (1, 1, 0, 1, "a")), path)
    frame(spark, (1, 1, 0, 9, "x")).write.partitionBy("part").parquet(f"{path}/_stage-dead/data")
    put(frame(spark, (2, 1, 0, 1, "a")), path)
    assert content(spark, path) == [(1, 1, 1, "a"), (2, 1, 1, "a")]


def test_replace_table_reads_itself(spark, path):
    tables.replace_table(frame(spark, (1, 1, 0, 1, "a")), path)
    tables.replace_table(tables.read_table(spark, path).withColumn("ver", F.col("ver") + 1), path)
    assert content(spark, path) == [(1, 1, 2, "a")]


def test_compact(spark, path):
    for i in range(4):
        tables.append(frame(spark, (i, 1, 0, 1, "a"), (i + 10, 2, 0, 1, "a")), path, ["part"])
    report = tables.compact(spark, path, ["part"])
    assert report == {"files_before": 8, "files_after": 2, "partitions": 2}
    assert len(content(spark, path)) == 8
    assert tables.compact(spark, path, ["part"])["partitions"] == 0


def test_compact_keeps_large_partitions_split(spark, path):
    wide = spark.range(20000).selectExpr("id", "sha2(cast(id as string), 256) as s", "1 as part")
    for _ in range(3):
        tables.append(wide.repartition(4), path, ["part"])
    size = sum(sum(v) for v in Files(spark, path).leaves(path).values())
    tables.compact(spark, path, ["part"], target_bytes=size // 2)
    assert 2 <= len(Files(spark, path).leaves(path)["part=1"]) <= 4
    assert tables.read_table(spark, path).count() == 60000


def test_prune(spark, path):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-10')) as d, 1 as x")
    tables.replace_table(days, path, ["d"])
    dropped = tables.prune(spark, path, "d", 7, dt.date(2024, 1, 12))
    assert dropped == [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]
    assert tables.partition_dates(spark, path, "d")[0] == dt.date(2024, 1, 5)


def test_read_as_of(spark, path):
    for v in (1, 4):
        tables.publish_version(spark.createDataFrame([(v,)], "v int"), path, v)
    assert [tables.read_as_of(spark, path, v).first()["v"] for v in (1, 3, 4, 9)] == [1, 1, 4, 4]
    with pytest.raises(FileNotFoundError):
        tables.read_as_of(spark, path, 0)


def test_metric_rows_skip_text(spark):
    now = F.lit("2024-01-01").cast("timestamp")
    row = spark.createDataFrame([(3, "12.5", "n/a", None)], "a int, b string, c string, d double")
    got = {r["metric_name"]: r["metric_value"] for r in metrics.metric_rows(row, "d", "r", now, now, now).collect()}
    assert got == {"a": 3.0, "b": 12.5}


def test_tsv_keeps_empty_apart_from_null(spark, tmp_path):
    file = tmp_path / "t.tsv"
    file.write_text("a\tb\tc\n1\t\t\\N\n2\t\"x\ty\n")
    ddl = "a string, b string, c string"
    plain = [tuple(r) for r in readers.read_null_tsv(spark, str(file), ddl).collect()]
    assert plain == [("1", None, None), ("2", '"x', "y")]
    kept = [tuple(r) for r in readers.read_null_tsv(spark, str(file), ddl, keep_empty=True).collect()]
    assert kept == [("1", "", None), ("2", '"x', "y")]


@pytest.mark.parametrize("whole_bytes", [readers.WHOLE_BYTES, 500])
def test_tolerant_reader(spark, tmp_path, monkeypatch, whole_bytes):
    """With the small limit all but the shortest archives are tested by a scan."""
    import bz2
    import gzip
    monkeypatch.setattr(readers.corrupt_files, "__defaults__", (whole_bytes,))
    folder = tmp_path / "in"
    folder.mkdir()
    lines = b"".join(b'{"a": "%d"}\n' % i for i in range(50_000))
    whole = lines[:lines.index(b"\n", 30_000) + 1]
    (folder / "good.json.gz").write_bytes(gzip.compress(b'{"a": "1"}\n{"a": \n'))
    (folder / "good.json.bz2").write_bytes(bz2.compress(whole) + bz2.compress(b'{"a": "x"}\n'))
    (folder / "bad.json.gz").write_bytes(b"this is no gzip file" * 40)
    (folder / "cut.json.gz").write_bytes(gzip.compress(lines)[:90_000])
    (folder / "cut.json.bz2").write_bytes(bz2.compress(lines)[:-2000])
    (folder / "odd.json.zst").write_bytes(b"this is no zst file")
    good, corrupt = readers.read_tolerant(spark, str(folder), "a string")
    values = [r["a"] for r in good.collect()]
    assert "1" in values and "x" in values and len(values) == whole.count(b"\n") + 2 and corrupt.count() == 1
    found = readers.corrupt_files(spark, str(folder)).collect()
    broken = {r["file_path"].rsplit("/", 1)[1]: r for r in found}
    assert sorted(broken) == ["bad.json.gz", "cut.json.bz2", "cut.json.gz", "odd.json.zst"]
    assert (broken["cut.json.gz"]["rows_read"] is None) == (whole_bytes == 500)


def test_interval_reader_prunes_partitions(spark, path):
    df = spark.sql("select explode(sequence(timestamp'2024-01-01', timestamp'2024-01-30', interval 6 hours)) as t")
    df = df.select(F.col("t").alias("server_received_at"), F.to_date("t").alias("event_date"))
    tables.replace_table(df, path, ["event_date"])
    lo, hi = F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-11").cast("timestamp")
    out = readers.read_interval(tables.read_table(spark, path), "server_received_at", lo, hi, date_col="event_date")
    assert out.count() == 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("parts", [(), ("part",)])
def test_crash_at_each_step_then_retry(spark, path, monkeypatch, parts):
    """The writer dies before its n-th change of the file system, for every n; an append and the retried batch follow."""
    real = {m: getattr(Files, m) for m in ("rename", "delete", "write_text")}
    step = 0
    while True:
        step += 1
        target, count = f"{path}-{step}", 0
        put(frame(spark, (1, 1, 0, 1, "a"), (2, 2, 0, 1, "a"), (3, 3, 0, 1, "a")), target, parts)

        def guarded(name):
            def call(self, *args):
                nonlocal count
                count += 1
                if count == step:
                    raise OSError("driver lost")
                return real[name](self, *args)
            return call

        for m in real:
            monkeypatch.setattr(Files, m, guarded(m))
        batch = frame(spark, (1, 2, 0, 2, "b"), (4, 4, 0, 1, "n"))
        try:
            put(batch, target, parts)
            died = False
        except OSError:
            died = True
        for m, f in real.items():
            monkeypatch.setattr(Files, m, f)
        tables.append(frame(spark, (9, 3, 0, 1, "z")), target, parts)
        put(batch, target, parts)
        assert content(spark, target) == [(1, 2, 2, "b"), (2, 2, 1, "a"), (3, 3, 1, "a"), (4, 4, 1, "n"), (9, 3, 1, "z")], step
        if not died:
            break
    assert step > 3


def test_escaped_and_empty_partition_values(spark, path):
    def rows(*data):
        return spark.createDataFrame(list(data), "id int, part string, ver int, val string")

    tables.upsert(rows((1, "a:b", 1, "x"), (2, "", 1, "x"), (3, "c/d=e %", 1, "x")), path, ["id"], ["part"], ["ver"])
    tables.upsert(rows((1, "c", 2, "y"), (2, "c", 2, "y"), (3, "c", 2, "y")), path, ["id"], ["part"], ["ver"])
    got = sorted((r["id"], r["part"]) for r in tables.read_table(spark, path).collect())
    assert got == [(1, "c"), (2, "c"), (3, "c")]


def test_replace_table_survives_a_crash(spark, path, monkeypatch):
    tables.replace_table(frame(spark, (1, 1, 0, 1, "a"), (2, 2, 0, 1, "a")), path, ["part"])
    monkeypatch.setattr(Files, "rename", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
    with pytest.raises(OSError):
        tables.replace_table(frame(spark, (5, 2, 0, 1, "n")), path, ["part"])
    monkeypatch.undo()
    tables.append(frame(spark, (6, 6, 0, 1, "z")), path, ["part"])
    assert content(spark, path) == [(5, 2, 1, "n"), (6, 6, 1, "z")]


def test_compaction_keeps_the_sort(spark, path):
    wide = spark.range(20000).selectExpr("cast(id % 500 as int) as s", "sha2(cast(id as string), 256) as h", "1 as part")
    for _ in range(3):
        tables.append(tables.sorted_layout(wide, ["part"], ["s"]), path, ["part"])
    size = sum(sum(v) for v in Files(spark, path).leaves(path).values())
    assert tables.compact(spark, path, ["part"], target_bytes=size // 2 + 1000, sort=["s"])["partitions"] == 1
    spans = tables.read_table(spark, path).groupBy(F.col("_metadata.file_path")).agg(
        F.min("s").alias("lo"), F.max("s").alias("hi")).orderBy("lo").collect()
    assert len(spans) >= 2 and all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))


def test_compact_without_partitions(spark, path):
    for i in range(3):
        tables.append(frame(spark, (i, 1, 0, 1, "a")), path)
    assert tables.compact(spark, path, [])["files_after"] == 1 and len(content(spark, path)) == 3


def test_a_copy_that_moved_by_days_replaces_the_stored_one(spark, path):
    """The key index finds a key in whatever partition it is; nothing but the touched partitions is rewritten."""
    first = spark.range(40).selectExpr("id", "date_add(date'2024-01-01', int(id % 10)) as part", "1 as ver")
    put(first, path)
    put(first.limit(0), path)
    later = spark.createDataFrame([(3, 9, 2), (5, 0, 2), (3, 5, 1)], "id bigint, d int, ver int").selectExpr(
        "id", "date_add(date'2024-02-01', d) as part", "ver")
    put(later, path)
    rows = {r.id: str(r.part) for r in spark.read.parquet(path).collect()}
    assert len(rows) == 40 == spark.read.parquet(path).count() and rows[3] == "2024-02-10" and rows[5] == "2024-02-01"
    put(spark.createDataFrame([(3, 2)], "id bigint, ver int").selectExpr("id", "date'2023-01-01' as part", "ver + 1 as ver"), path)
    assert spark.read.parquet(path).where("id = 3").count() == 1
    wanted = spark.createDataFrame([(3,), (7,), (99,)], "id bigint")
    found = tables.rows_with_keys(spark, path, wanted, ["id"], ["part"], spark.read.parquet(path).schema)
    assert sorted((r.id, str(r.part)) for r in found.collect()) == [(3, "2023-01-01"), (7, "2024-01-08")]
    assert "PartitionFilters: [part" in found._jdf.queryExecution().executedPlan().toString()


def test_key_index_is_merged_and_rebuilt(spark, path, monkeypatch):
    monkeypatch.setattr(tables, "INDEX_VERSIONS", 3)
    for k in range(8):
        put(spark.createDataFrame([(i, f"p{(i + k) % 4}", k) for i in range(k, k + 6)], "id bigint, part string, ver int"), path)
        index = [n for n, _, _ in tables.Files(spark, f"{path}/_keys-id").children(f"{path}/_keys-id")]
        assert len(index) <= 3
    rows = spark.read.parquet(path)
    assert rows.count() == 13 == rows.select("id").distinct().count()
    tables.append(spark.createDataFrame([(50, "p9", 1)], "id bigint, part string, ver int").select("id", "ver", "part"), path, ["part"])
    put(spark.createDataFrame([(50, "p1", 2)], "id bigint, part string, ver int"), path)
    assert [r.part for r in spark.read.parquet(path).where("id = 50").collect()] == ["p1"]


def test_writers_merge_small_files_and_keep_the_sort(spark, path):
    rows = spark.range(3000).repartition(16).selectExpr("id % 2 as part", "cast(id as string) as s")
    tables.replace_table(rows, path, ["part"], ["s"])
    assert all(len(sizes) == 1 for sizes in tables.Files(spark, path).leaves(path).values())
    for k in (0, 1):
        held = [r.s for r in spark.read.parquet(f"{path}/part={k}").collect()]
        assert held == sorted(held) and len(held) == 1500


def test_many_partitions_are_pruned_by_range(spark, path, monkeypatch):
    monkeypatch.setattr(tables, "LISTED", 3)
    put(spark.range(60).selectExpr("id", "cast(id % 12 as int) as part", "1 as ver"), path)
    put(spark.range(0, 60, 7).selectExpr("id", "cast(id % 11 as int) as part", "2 as ver"), path)
    rows = spark.read.parquet(path)
    assert rows.count() == 60 and rows.where("ver = 2 and part = id % 11").count() == 9


def test_rows_are_computed_in_many_tasks_whatever_the_file_size(spark, path):
    """The shuffles before the gathering are not merged to the size of a file."""
    rows = spark.range(600_000).select(F.xxhash64("id").alias("id")).groupBy("id").count()
    tables.replace_table(rows.withColumn("task", F.spark_partition_id()), path)
    stored = tables.read_table(spark, path)
    assert stored.count() == 600_000 and stored.select("task").distinct().count() > 1
    assert [n for n in os.listdir(path) if n.startswith("_") and n != "_SUCCESS"] == []


def test_unsorted_rows_are_written_without_a_sort(spark, path):
    """Files of a size are gathered with several partitions open side by side, and the settings are put back."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with tables._sized(spark, 1 << 20):
        assert int(spark.conf.get(name)) == tables.OPEN_FILES > 1
    assert spark.conf.get(name) == before
    tables.append(spark.range(5000).selectExpr("id", "id % 150 as part"), path, ["part"])  # more than are open
    assert tables.read_table(spark, path).groupBy("part").count().where("count in (33, 34)").count() == 150


def test_newest_place_of_a_key_needs_no_sort(spark, path):
    """Keys and dates of the index are summed by hash; the newest version gives the partition, NULL too."""
    put(frame(spark, (1, 1, 0, 1, "a"), (2, 1, 0, 1, "b")), path)
    put(frame(spark, (1, 2, 0, 2, "c"), (2, None, 0, 2, "d")), path)
    put(frame(spark, (2, None, 0, 3, "e")), path)  # stays where it is
    places = tables._places(spark, path, ["id"], ["part"], spark.createDataFrame([], DDL).schema)
    assert {r["id"]: r["part"] for r in places.collect()} == {1: 2, 2: None}
    assert "SortAggregate" not in places._jdf.queryExecution().toString()
