"""Event-time steps of a stream: clock guard, late split, deduplication, volume and lag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from viewtide import schema
from viewtide.sources import tables


def drop_future(df: DataFrame, skew_seconds: int = schema.CLOCK_SKEW_SECONDS) -> DataFrame:
    """Remove events from the future before a watermark is set, since one of them would advance it."""
    ahead = F.unix_micros("event_timestamp") - F.unix_micros("server_received_at")
    return df.where(ahead <= skew_seconds * 1_000_000)


def split_late(df: DataFrame, bound_seconds: int = schema.STALE_SECONDS) -> tuple[DataFrame, DataFrame]:
    """(in time, late) by server time, ahead of the stateful step, so late rows are kept rather than dropped."""
    lag = F.unix_timestamp("server_received_at") - F.unix_timestamp("event_timestamp")
    late = F.coalesce(lag > bound_seconds, F.lit(True))
    return df.where(~late), df.where(late)


def dedup_stream(df: DataFrame, horizon: str = "24 hours", key: str = "event_id",
                 ts: str = "event_timestamp") -> DataFrame:
    """First arrival per key within the horizon; its state is dropped as the watermark passes."""
    return df.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def dedup_with_late_table(stream: DataFrame, path: str, late_path: str, checkpoint: str, horizon_seconds: int,
                          key: str = "event_id", ts: str = "event_timestamp") -> StreamingQuery:
    """First arrival per key into ``path``; rows behind the watermark, which Spark's own step would drop, into ``late_path``.

    The watermark of a batch is the greatest event time of all earlier batches less the horizon, as in Spark, and is kept
    with each batch's rows, so a restart goes on from it and a repeated batch splits its rows as before. The state is the
    table itself: keys of the last batches whose rows may still meet a copy in time. Rows without a time are late. Every key
    of the stream ends in one of the tables.
    """
    spark = stream.sparkSession
    marks = f"{path}-marks"

    def step(batch: DataFrame, number: int) -> None:
        at = F.unix_micros(ts)
        low = None
        if tables.table_exists(spark, marks):
            seen = spark.read.schema("top bigint, batch bigint").parquet(marks).where(F.col("batch") < number)
            low = seen.agg(F.max("top")).first()[0]
        bound = F.lit(None if low is None else low - horizon_seconds * 1_000_000).cast("bigint")
        late = at.isNull() | F.coalesce(at < bound, F.lit(False))
        rows = batch.where(~late).dropDuplicates([key])
        if tables.table_exists(spark, path):
            stored = spark.read.schema(T.StructType([*batch.schema, T.StructField("batch", T.LongType())])).parquet(path).where(F.col("batch") < number)
            recent = stored.where(F.coalesce(at >= bound, F.lit(True))).select(F.col(key).alias("__k"))
            rows = rows.join(recent, F.col(key).eqNullSafe(F.col("__k")), "left_anti")
        top = batch.agg(F.max(at).alias("top"))
        for part, where in ((rows, path), (batch.where(late), late_path), (top, marks)):
            part.write.mode("overwrite").parquet(f"{where}/batch={number}")

    return (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def volume(df: DataFrame, width: str = "15 minutes", ts: str = "event_timestamp") -> DataFrame:
    """Rows and arrival lag per tumbling window; the same plan for a batch and for a watermarked stream."""
    lag = F.unix_micros("server_received_at") - F.unix_micros("event_timestamp")
    return (df.groupBy(F.window(ts, width).alias("w"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sum(lag).alias("lag_micros"), F.max(lag).alias("max_lag_micros"))
            .select(F.col("w.start").alias("window_start"), "rows",
                    (F.col("lag_micros") / F.col("rows") / 1_000_000.0).alias("avg_lag_seconds"),
                    (F.col("max_lag_micros") / 1_000_000.0).alias("max_lag_seconds")))


def volume_stream(df: DataFrame, width: str = "15 minutes", lateness: str = "24 hours",
                  ts: str = "event_timestamp") -> DataFrame:
    return volume(df.withWatermark(ts, lateness), width, ts)
