"""Bounded and unbounded inputs with declared schemas."""

from __future__ import annotations

import bz2
import gzip
import io
import re
import zlib
from collections.abc import Mapping
from datetime import timedelta

import pandas as pd
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewtide import schema
from viewtide.functions.scalars import null_sentinels
from viewtide.sources.fs import Files

CORRUPT = "_corrupt_record"


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def read_interval(df: DataFrame, ts_col: str, start: Column, end: Column,
                  lookback: timedelta = timedelta(minutes=schema.LOOKBACK_MINUTES),
                  date_col: str | None = None) -> DataFrame:
    """Rows with ``ts_col`` in ``[start - lookback, end)``.

    ``date_col`` adds the implied bound on the event-date partition: clean rows are at most 24 h late and 5 min early.
    """
    lo = start - F.make_dt_interval(secs=F.lit(lookback.total_seconds()))
    out = df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < end))
    if date_col:
        out = out.where(F.col(date_col).between(F.date_sub(start.cast("date"), 2), F.date_add(end.cast("date"), 1)))
    return out


def read_null_tsv(spark: SparkSession, path: str, ddl: str, keep_empty: bool = False) -> DataFrame:
    r"""Tab-separated text with header and ``\N`` for NULL; every column stays a string.

    The CSV reader also turns an empty field into NULL. ``keep_empty`` splits the lines instead, which keeps the
    difference between an empty field and ``\N``.
    """
    table = struct_of(ddl)
    if not keep_empty:
        return (spark.read.schema(table).option("sep", "\t").option("header", True)
                .option("nullValue", schema.NULL_SENTINEL).option("quote", "").csv(path))
    fields = F.split(F.col("value"), "\t", -1)
    header = "\t".join(table.names)
    lines = spark.read.text(path).where(F.col("value") != header)
    return null_sentinels(lines.select(*[F.get(fields, F.lit(i)).alias(n) for i, n in enumerate(table.names)]))


def read_jsonl(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON lines under a declared schema; a line that does not parse is kept in ``_corrupt_record``."""
    table = struct_of(ddl).add(CORRUPT, T.StringType())
    return (spark.read.schema(table).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).json(path))


def read_partitioned_json(spark: SparkSession, base: str, ddl: str, predicate: Column | None = None,
                          parts: str = "yyyy int, mm int, dd int, hh int") -> DataFrame:
    """Hive-style directories of JSON lines; the partition columns are declared and a predicate on them prunes."""
    table = struct_of(ddl)
    for field in struct_of(parts).fields:
        table = table.add(field)
    df = spark.read.schema(table).option("basePath", base).json(base)
    return df if predicate is None else df.where(predicate)


def read_tolerant(spark: SparkSession, path: str, ddl: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, corrupt lines) of the readable files; see :func:`corrupt_files` for the others, of which no row is used."""
    table = struct_of(ddl).add(CORRUPT, T.StringType())
    # Parsed from text, because a JSON scan does not answer queries on the corrupt column alone.
    lines = spark.read.option("ignoreCorruptFiles", True).text(path).select("value", "_metadata.file_path")
    broken = corrupt_files(spark, path).select("file_path")
    lines = lines.join(broken, "file_path", "left_anti")
    doc = F.from_json("value", table, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = lines.select(doc.alias("d")).select("d.*")
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT), rows.where(F.col(CORRUPT).isNotNull())


WHOLE_BYTES = 256 << 20  # archives up to this size are tested as one value in a task, larger ones by a scan of their own
ARCHIVES = "*.{gz,bz2,zst}"


def corrupt_files(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """``file_path``, ``rows_read``, ``error`` of compressed files that end early, are no archive or cannot be read here.

    A text scan that ignores corrupt files keeps the rows before the damage, so every archive is read once more to its last
    checksum. Small .gz and .bz2 files are decompressed piece by piece in tasks. Larger ones, which ``binaryFile`` may refuse,
    and all .zst files stream through the codecs of Spark's own text scan in bounded memory: all together first, and file by
    file only if that fails; ``rows_read`` is NULL for those. Only their names reach the driver.
    """
    def tested(batches):
        for pdf in batches:
            found = []
            for name, content in zip(pdf["path"], pdf["content"]):
                rows, error = _unpack(name, content)
                if error:
                    found.append((name, rows, error))
            yield pd.DataFrame(found, columns=["file_path", "rows_read", "error"])

    ddl = "file_path string, rows_read bigint, error string"
    files = spark.read.format("binaryFile").option("pathGlobFilter", ARCHIVES).load(path)
    small = (F.col("length") <= whole_bytes) & ~F.col("path").endswith(".zst")
    streamed = [r.path for r in files.where(~small).select("path").collect()]
    bad = [] if not streamed or _scan_error(spark, streamed) is None else [
        (f, None, error) for f in streamed if (error := _scan_error(spark, [f])) is not None]
    found = files.where(small).select("path", "content").mapInPandas(tested, ddl)
    return found.unionByName(spark.createDataFrame(bad, ddl)) if bad else found


def _scan_error(spark: SparkSession, files: list[str]) -> str | None:
    """What a text scan of these files that stops at any damage ends with."""
    escaped = [re.sub(r"([\\*?\[\]{}])", r"\\\1", f) for f in files]
    try:
        spark.read.option("ignoreCorruptFiles", False).text(escaped).agg(F.max(F.length("value"))).collect()
    except (PySparkException, Py4JError) as e:
        return " ".join(str(e).split())[:500]
    return None


def _unpack(name: str, content: bytes) -> tuple[int, str | None]:
    """Lines of an archive, and the error it ends with."""
    rows = 0
    try:
        with (bz2.open if name.endswith(".bz2") else gzip.open)(io.BytesIO(content)) as f:
            while piece := f.read(1 << 14):
                rows += piece.count(b"\n")
    except (EOFError, OSError, zlib.error) as e:
        return rows, f"{type(e).__name__}: {e}"
    return rows, None


def read_event_stream(spark: SparkSession, fmt: str, options: Mapping[str, str], ddl: str) -> DataFrame:
    """Unbounded events. Files of JSON lines or Parquet here; ``kafka`` where its connector is installed."""
    if fmt == "kafka":
        raw = (spark.readStream.format("kafka").option("startingOffsets", "earliest").options(**options).load())
        return raw.select(F.from_json(F.col("value").cast("string"), ddl).alias("e"),
                          F.col("timestamp").alias("broker_ts")).select("e.*", "broker_ts")
    return stream_files(spark, fmt, options["path"], ddl,
                        **{k: v for k, v in options.items() if k != "path"})


def stream_files(spark: SparkSession, fmt: str, path: str, ddl: str, **options: str) -> DataFrame:
    """Stream a directory, or a single file through its parent directory and a name filter."""
    reader = spark.readStream.schema(ddl).options(**options)
    if Files(spark, path).is_file(path):
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).format(fmt).load(folder)
    return reader.format(fmt).load(path)


def date_series(spark: SparkSession, lo: str, hi: str, out: str = "full_date") -> DataFrame:
    days = F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
    return spark.range(1).select(F.explode(days).alias(out))


def read_zone(spark: SparkSession, root: str, zone: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{zone}/{table}")
