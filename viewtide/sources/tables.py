"""Zone tables: partitioned Parquet with keyed upsert, partition replacement, compaction and retention.

A change is written to a staging directory inside the table (its name starts with ``_``, so readers skip it) together
with a small plan file that lists the partitions to swap and to drop. Only then are directories renamed. If the driver
dies in between, :func:`roll_forward` finishes the listed swaps; staging without a plan file is discarded. Every change
rolls forward first, so nothing is ever built on a half-swapped table. A table without partitions is swapped file by file
under the same plan. Tables have a single writer.

A partitioned table that is upserted has a key index beside its data (``_keys-...``): narrow files of key, partition and
version. An upsert looks its keys up there, wherever they are stored, and publishes the places of its own rows as a new
version in the same swap. Other writers that may add rows drop the index; the next upsert builds it from the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtide import schema
from viewtide.operators.joins import null_safe_join
from viewtide.operators.windows import latest_per_key
from viewtide.sources.fs import Files

_PLAN = "_READY"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


_INDEX = "_keys-"
INDEX_VERSIONS = 16     # versions after which an index is rewritten as one
OPEN_FILES = 64         # partitions a task writes side by side; it sorts the rows of any further ones
LISTED = 1_000          # partition values up to which a scan is pruned by a list, beyond that by their range


@contextmanager
def _sized(spark: SparkSession, target_bytes: int):
    """Let a rebalance merge and split its partitions to about ``target_bytes``. Unsorted rows go to the open files of up to
    ``OPEN_FILES`` partitions, so a task holds encoded columns and no sorted copy of its rows."""
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
              "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
              "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _write(df: DataFrame, path: str, rows_path: str, parts: Sequence[str] = (), sort: Sequence[str] = (),
           mode: str = "errorifexists", target_bytes: int = schema.TARGET_FILE_BYTES) -> None:
    """Parquet files of about ``target_bytes`` of shuffled rows, gathered per partition value (AQE's REBALANCE merges small
    and splits large ones) and, with ``sort``, sorted inside, so that each file holds a narrow range.

    The size of a file is far too much for a task that joins or sorts, and AQE would merge every shuffle of the plan to it.
    So the rows are first written to ``rows_path`` as they are computed, and only their gathering goes by ``target_bytes``.
    """
    spark = df.sparkSession
    df.write.parquet(rows_path)
    _gather(spark.read.schema(df.schema).parquet(rows_path), path, parts, sort, mode, target_bytes)
    Files(spark, rows_path).delete(rows_path)


def _gather(rows: DataFrame, path: str, parts: Sequence[str] = (), sort: Sequence[str] = (), mode: str = "errorifexists",
             target_bytes: int = schema.TARGET_FILE_BYTES) -> None:
    """The files of :func:`_write` from stored rows."""
    rows = sorted_layout(rows, parts, sort) if sort else rows.hint("rebalance", *parts)
    with _sized(rows.sparkSession, target_bytes):
        (rows.write.partitionBy(*parts) if parts else rows.write).mode(mode).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    return any(not name.startswith(("_", ".")) for name, _, _ in Files(spark, path).children(path))


def read_table(spark: SparkSession, path: str, table_schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(table_schema) if table_schema else spark.read
    return reader.parquet(path)


def roll_forward(spark: SparkSession, path: str) -> None:
    """Finish or discard changes a dead writer left behind."""
    files = Files(spark, path)
    for name, is_dir, _ in files.children(path):
        if is_dir and name.startswith("_stage-"):
            _swap(files, path, f"{path}/{name}")


def _swap(files: Files, path: str, stage: str) -> None:
    plan = f"{stage}/{_PLAN}"
    if files.exists(plan):
        todo = json.loads(files.read_text(plan))
        for rel in todo["drop"]:
            files.delete(f"{path}/{rel}")
        for rel in todo["move"]:
            staged = f"{stage}/data/{rel}"
            if files.exists(staged):  # else it was moved before the interruption
                files.delete(f"{path}/{rel}")
                files.rename(staged, f"{path}/{rel}")
    files.delete(stage)


def _publish(files: Files, path: str, stage: str, affected: Iterable[str], whole: bool = False,
             index: Iterable[str] = ()) -> None:
    """Swap in what was staged. ``affected`` names directories that end up empty unless staged; ``whole`` replaces all;
    ``index`` names staged versions of the key index, and versions to be dropped."""
    if whole:  # entries at the top, whatever the layout before and after
        written = _entries(files, f"{stage}/data")
        affected = _entries(files, path)
    else:
        written = sorted(files.leaves(f"{stage}/data"))
    gone = sorted(set(affected) - set(written))
    for rel in index:
        (written if files.exists(f"{stage}/data/{rel}") else gone).append(rel)
    files.write_text(f"{stage}/{_PLAN}", json.dumps({"move": written, "drop": gone}))
    _swap(files, path, stage)


def _entries(files: Files, path: str) -> list[str]:
    return sorted(name for name, _, _ in files.children(path) if not name.startswith(("_", ".")))


def replace_table(df: DataFrame, path: str, parts: Sequence[str] = (), sort: Sequence[str] = ()) -> None:
    """Create or replace the whole table; the old one may be read by ``df``."""
    files = Files(df.sparkSession, path)
    roll_forward(df.sparkSession, path)
    stage = f"{path}/_stage-{uuid.uuid4().hex}"
    _write(df, f"{stage}/data", f"{stage}/rows", parts, sort)
    _drop_index(files, path)
    _publish(files, path, stage, [], whole=True)


def write_sized(df: DataFrame, path: str, parts: Sequence[str] = (),
                target_bytes: int = schema.TARGET_FILE_BYTES) -> None:
    """A new table with another file size than the default."""
    _write(df, path, f"{path}-rows-{uuid.uuid4().hex}", parts, target_bytes=target_bytes)


def append(df: DataFrame, path: str, parts: Sequence[str] = ()) -> None:
    files = Files(df.sparkSession, path)
    roll_forward(df.sparkSession, path)
    _drop_index(files, path)
    stage = f"{path}/_stage-{uuid.uuid4().hex}"  # has no plan file: discarded if this is interrupted
    _write(df, path, f"{stage}/rows", parts, mode="append")
    files.delete(stage)


def _relative(spark: SparkSession, parts: Sequence[str], values: Sequence[object]) -> str:
    """The directory Spark writes for these partition values."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName

    def name(value: object) -> str:
        if value is None or value == "":
            return _NULL_PARTITION
        return escape(str(value).lower() if isinstance(value, bool) else str(value))

    return "/".join(f"{escape(p)}={name(v)}" for p, v in zip(parts, values))


def _in_partitions(df: DataFrame, parts: Sequence[str], rows: Sequence[Sequence[object]]) -> DataFrame:
    """Rows of the named partitions. The first partition column is tested against literals, so the scan prunes
    directories: a list, or beyond ``LISTED`` values their range. What that leaves open is settled by a join with the
    partition list, which is one row per directory."""
    first = {r[0] for r in rows}
    known = sorted(v for v in first if v is not None)
    listed = len(known) <= LISTED
    test = F.col(parts[0]).isin(known) if listed else F.col(parts[0]).between(known[0], known[-1])
    out = df.where(test | F.col(parts[0]).isNull() if None in first else test)
    if len(parts) == 1 and listed:
        return out
    fields = T.StructType([df.schema[p] for p in parts])
    return null_safe_join(out, df.sparkSession.createDataFrame(list(rows), fields), parts, "left_semi")


# --- key index ---

def _index_of(path: str, keys: Sequence[str]) -> str:
    return f"{path}/{_INDEX}{'-'.join(keys)}"


def _drop_index(files: Files, path: str) -> None:
    """Before rows are added that no index knows of."""
    for name, is_dir, _ in files.children(path):
        if is_dir and name.startswith(_INDEX):
            files.delete(f"{path}/{name}")


def _index_versions(files: Files, path: str, keys: Sequence[str]) -> list[int]:
    return sorted(int(name[2:]) for name, _, _ in files.children(_index_of(path, keys)) if name.startswith("v="))


def _write_index(rows: DataFrame, keys: Sequence[str], path: str) -> None:
    """Sorted by key, so that a file's statistics tell which keys it can hold."""
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)


def _places(spark: SparkSession, path: str, keys: Sequence[str], parts: Sequence[str], table: T.StructType,
            wanted: DataFrame | None = None) -> DataFrame:
    """Key and partition columns by the newest version of the index, of the keys in ``wanted`` or of all."""
    fields = T.StructType([*[table[c] for c in (*keys, *parts)], T.StructField("v", T.IntegerType())])
    rows = spark.read.schema(fields).parquet(_index_of(path, keys))
    if wanted is not None:
        rows = null_safe_join(rows, wanted.select(*keys), keys, "left_semi")
    # A version holds a key once, so the columns are of one row; taken one by one, dates and numbers need no sort.
    return rows.groupBy(*keys).agg(*[F.max_by(c, "v").alias(c) for c in parts])


def _require_index(spark: SparkSession, path: str, keys: Sequence[str], parts: Sequence[str], table: T.StructType) -> None:
    files = Files(spark, path)
    if _index_versions(files, path, keys):
        return
    stage = f"{path}/_stage-{uuid.uuid4().hex}"  # discarded if this is interrupted: it has no plan file
    _write_index(spark.read.schema(table).parquet(path).select(*keys, *parts), keys, f"{stage}/keys")
    files.rename(f"{stage}/keys", f"{_index_of(path, keys)}/v=0")
    files.delete(stage)


def rows_with_keys(spark: SparkSession, path: str, wanted: DataFrame, keys: Sequence[str], parts: Sequence[str],
                   table: T.StructType) -> DataFrame:
    """The stored rows of the keys in ``wanted``. Only the partitions that hold one are read."""
    roll_forward(spark, path)
    _require_index(spark, path, keys, parts, table)
    at = {tuple(r) for r in _places(spark, path, keys, parts, table, wanted).select(*parts).distinct().collect()}
    stored = spark.read.schema(table).parquet(path)
    held = _in_partitions(stored, parts, sorted(at, key=str)) if at else stored.limit(0)
    return null_safe_join(held, wanted.select(*keys), keys, "left_semi")


def _age(order: Sequence[str]) -> Column:
    return F.struct(*order) if order else F.lit(0)


def upsert(batch: DataFrame, path: str, keys: Sequence[str], parts: Sequence[str], order: Sequence[str],
           sort: Sequence[str] = ()) -> None:
    """Insert or update by key; the newer row by ``order`` survives, the incoming one on a tie or without an ``order``.

    Only partitions that hold an incoming key, by the key index, or receive one are rewritten, sorted by ``sort``. Rows of
    untouched keys pass through two anti-joins against the batch; a small batch is broadcast by size, so the large side
    is not shuffled.
    """
    spark = batch.sparkSession
    files = Files(spark, path)
    roll_forward(spark, path)
    stage = f"{path}/_stage-{uuid.uuid4().hex}"
    tie = F.xxhash64(*[F.col(c) for c in batch.columns])
    newest = latest_per_key(batch.withColumn("__tie", tie), keys, [*order, "__tie"]).drop("__tie")
    if not table_exists(spark, path):
        _write(newest, f"{stage}/data", f"{stage}/rows", parts, sort)
        _drop_index(files, path)
        _publish(files, path, stage, [], whole=not parts)
        return

    # Written once: the batch is read several times below and must not change between the reads.
    newest.write.parquet(f"{stage}/batch")
    incoming = spark.read.schema(newest.schema).parquet(f"{stage}/batch")
    # Reading under the batch's schema also fills columns the stored files do not have yet.
    target = spark.read.schema(incoming.schema).parquet(path)
    if parts:
        _require_index(spark, path, keys, parts, incoming.schema)
        holding = _places(spark, path, keys, parts, incoming.schema, incoming).select(*parts)
        # Partitions; an empty text is stored as NULL.
        affected = {tuple(None if v == "" else v for v in r)
                    for r in holding.unionByName(incoming.select(*parts)).distinct().collect()}
        if not affected:
            files.delete(stage)
            return
        old = _in_partitions(target, parts, sorted(affected, key=str))
    else:
        affected, old = set(), target

    def rival(side: DataFrame) -> DataFrame:
        return side.select(*keys, _age(order).alias("__rival"))

    on = [f"__r_{k}" for k in keys]

    def survivors(mine: DataFrame, theirs: DataFrame, beaten: Column) -> DataFrame:
        other = rival(theirs).withColumnsRenamed(dict(zip(keys, on)))
        cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in zip(keys, on)])
        return mine.join(other, cond & beaten, "left_anti")

    mine = _age(order)
    winners = survivors(incoming, old, F.col("__rival") > mine)
    merged = survivors(old, incoming, F.col("__rival") >= mine).unionByName(winners)
    _write(merged, f"{stage}/data", f"{stage}/rows", parts, sort)
    index = []
    if parts:
        versions = _index_versions(files, path, keys)
        moved, name = winners.select(*keys, *parts), _index_of("", keys)[1:]
        if len(versions) >= INDEX_VERSIONS:
            rest = null_safe_join(_places(spark, path, keys, parts, incoming.schema), moved.select(*keys), keys, "left_anti")
            moved = rest.unionByName(moved)
            index = [f"{name}/v={v}" for v in versions]
        index.append(f"{name}/v={versions[-1] + 1}")
        _write_index(moved, keys, f"{stage}/data/{index[-1]}")
    _publish(files, path, stage, [_relative(spark, parts, r) for r in affected], whole=not parts, index=index)


def replace_partitions(df: DataFrame, path: str, part: str, values: Sequence[object]) -> None:
    """Replace the named partitions by the rows of ``df``; a value without rows ends up empty."""
    spark = df.sparkSession
    files = Files(spark, path)
    roll_forward(spark, path)
    stage = f"{path}/_stage-{uuid.uuid4().hex}"
    wanted = _in_partitions(df, [part], [(v,) for v in values])
    _write(wanted, f"{stage}/data", f"{stage}/rows", [part])
    _drop_index(files, path)
    _publish(files, path, stage, [_relative(spark, [part], (v,)) for v in values])


def partition_dates(spark: SparkSession, path: str, part: str) -> list[date]:
    prefix = f"{part}="
    return sorted(date.fromisoformat(n[len(prefix):]) for n, is_dir, _ in Files(spark, path).children(path)
                  if is_dir and n.startswith(prefix) and not n.endswith(_NULL_PARTITION))


def prune(spark: SparkSession, path: str, part: str, keep_days: int, as_of: date) -> list[date]:
    """Drop date partitions older than ``as_of - keep_days``; returns the dropped days."""
    files = Files(spark, path)
    roll_forward(spark, path)
    cutoff = as_of - timedelta(days=keep_days)
    old = [d for d in partition_dates(spark, path, part) if d < cutoff]
    for d in old:
        files.delete(f"{path}/{part}={d.isoformat()}")
    return old


def compact(spark: SparkSession, path: str, parts: Sequence[str], target_bytes: int = schema.TARGET_FILE_BYTES,
            sort: Sequence[str] = ()) -> dict[str, int]:
    """Rewrite partitions that have more files than their size needs; refuses to publish if the row count changes.

    One job for all candidates: each partition's rows are spread over ``ceil(bytes / target)`` slots, by a hash of the row
    or, with ``sort``, by ranges of the sort columns, sorted inside, so that files stay as narrow as they were written.
    """
    files = Files(spark, path)
    roll_forward(spark, path)
    leaves = files.leaves(path)
    before = sum(len(s) for s in leaves.values())
    slots = {rel: max(1, -(-sum(sizes) // target_bytes)) for rel, sizes in leaves.items()}
    todo = {rel: n for rel, n in slots.items() if len(leaves[rel]) > n}
    if not todo:
        return {"files_before": before, "files_after": before, "partitions": 0}
    stage = f"{path}/_stage-{uuid.uuid4().hex}"
    base = spark.read.option("basePath", path)
    rows = base.parquet(*[f"{path}/{rel}" if rel else path for rel in todo])
    if sort:
        spread = rows.repartitionByRange(sum(todo.values()), *parts, *sort).sortWithinPartitions(*parts, *sort)
    else:
        # The slot table has one row per rewritten partition directory.
        unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        values = [[None if v == _NULL_PARTITION else unescape(v) for v in
                   (x.split("=", 1)[1] for x in rel.split("/") if rel)] for rel in todo]
        names = [f"__p{i}" for i in range(len(parts))]
        sizes = spark.createDataFrame([(*v, n) for v, n in zip(values, todo.values())],
                                      T.StructType([*[T.StructField(n, T.StringType()) for n in names],
                                                    T.StructField("__slots", T.IntegerType())]))
        same = reduce(lambda a, b: a & b, [F.col(p).cast("string").eqNullSafe(F.col(n)) for p, n in zip(parts, names)],
                      F.lit(True))
        sized = rows.join(F.broadcast(sizes), same) if parts else rows.withColumn("__slots", F.lit(sum(todo.values())))
        spread = (sized.withColumn("__slot", F.pmod(F.xxhash64(*rows.columns), F.col("__slots")))
                  .repartitionByRange(sum(todo.values()), *parts, "__slot").drop("__slots", "__slot", *names))
    (spread.write.partitionBy(*parts) if parts else spread.write).parquet(f"{stage}/data")
    staged = spark.read.option("basePath", f"{stage}/data").parquet(f"{stage}/data").count()
    if staged != rows.count():
        files.delete(stage)
        raise RuntimeError("compaction changed the row count; nothing was published")
    _publish(files, path, stage, [], whole=not parts)
    after = sum(len(s) for s in files.leaves(path).values())
    return {"files_before": before, "files_after": after, "partitions": len(todo)}


def sorted_layout(df: DataFrame, parts: Sequence[str], sort: Sequence[str]) -> DataFrame:
    """Rows gathered by partition and sorted inside it, so each file keeps sessions together."""
    return df.hint("rebalance", *parts).sortWithinPartitions(*parts, *sort)


def publish_version(df: DataFrame, path: str, version: int) -> None:
    """Keep a full snapshot under its version number."""
    df.write.mode("errorifexists").parquet(f"{path}/version={version}")


def read_as_of(spark: SparkSession, path: str, version: int) -> DataFrame:
    """The newest snapshot not after ``version``."""
    known = [int(n.split("=")[1]) for n, is_dir, _ in Files(spark, path).children(path)
             if is_dir and n.startswith("version=")]
    usable = [v for v in known if v <= version]
    if not usable:
        raise FileNotFoundError(f"no version <= {version} under {path}")
    return spark.read.parquet(f"{path}/version={max(usable)}")
