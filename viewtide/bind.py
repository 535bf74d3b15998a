"""Binding of the generic star-schema test tables to the playback model.

``events`` become playback events: user -> customer, ``props.k`` -> title and device, ``value`` -> position. Titles are
``part``, devices ``supplier``, customers ``customer``. Some rows are made stale, future-dated, badly titled or repeated
by rules on the event id, so that every path of the raw zone has data.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewtide import schema
from viewtide.operators.windows import sessionize
from viewtide.plans import dims, facts, marts
from viewtide.plans.raw import Rules, newest_events, split_quarantine, with_reason
from viewtide.session import prepare, work_path

SESSION_GAP_SECONDS = 240 * 60
RULES = Rules(event_types=("signup", "purchase", "view", "click"))
ROLES = facts.Roles(play=("view",), pause=("click",), seek=("signup",), resume=(), complete=("purchase",),
                    end=("purchase", "click"))
# Columns of the test tables.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}
# ``props`` is a JSON object with one number; a pattern reads it at a fraction of the cost of a JSON parser.
K = """cast(regexp_extract(props, '"k": *([0-9]+)', 1) as bigint)"""
DEVICE_TYPES = ("tv", "mobile", "laptop", "console")
BITRATES = (1500, 3000, 5000, 8000)


def padded(number: str, width: int = 7) -> str:
    """SQL text: zero-padded to at least ``width`` digits, never cut."""
    return f"concat(substr('{'0' * width}', 1 + length({number})), {number})"


def pick(values: tuple, index: str) -> str:
    """SQL text: the value at ``index`` modulo the number of values."""
    listed = ", ".join(repr(v) for v in values)
    return f"element_at(array({listed}), cast(pmod({index}, {len(values)}) + 1 as int))"


class Playback:
    """Lazy tables of the playback model over one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    def as_landing(self, events: DataFrame) -> DataFrame:
        """Landing rows of source events, one to one (streams too)."""
        keyed = events.selectExpr("event_id", "user_id", "event_type", "value", "cast(ts as timestamp) as ts",
                                  f"{K} as k")
        return keyed.selectExpr(
            "event_id", "cast(user_id as string) as customer_id", "user_id",
            f"if(event_id % 307 = 0, concat('bad', event_id), concat('tt', {padded('k')})) as title_id",
            "concat('d', k % 10) as device_id", "concat('d', k % 10, '_v', k % 2) as device_version_id",
            "event_type", "ts as event_timestamp",
            "timestamp_micros(unix_micros(ts) + 1000000 * (event_id * 7919 % 5400 + case when event_id % 211 = 0 "
            "then 25 * 3600 when event_id % 197 = 0 then -3 * 3600 else 0 end)) as server_received_at",
            "cast(floor(value * 10000) as int) as position_ms", f"{pick(BITRATES, 'k')} as bitrate_kbps",
            "concat('C', user_id % 10) as geo_country", "1 as schema_version", "to_date(ts) as event_date",
            "hour(ts) as event_hour")

    @cached_property
    def landing(self) -> DataFrame:
        """At-least-once landing: every 50th event arrives a second time, a minute later and further on."""
        again = self.as_landing(self.events.where("event_id % 50 = 0")).selectExpr(
            "* except (server_received_at, position_ms)",
            "server_received_at + interval 60 seconds as server_received_at", "position_ms + 10000 as position_ms")
        return self.as_landing(self.events).unionByName(again)

    @cached_property
    def marked(self) -> DataFrame:
        return with_reason(self.landing, RULES)

    @cached_property
    def quarantine(self) -> DataFrame:
        return split_quarantine(self.landing, RULES)[1]

    @cached_property
    def deduplicated(self) -> DataFrame:
        return newest_events(split_quarantine(self.landing, RULES)[0])

    @cached_property
    def raw(self) -> DataFrame:
        """Clean, deduplicated events with a session id per user and 240-minute silence."""
        probe = self.events.selectExpr("user_id", "cast(ts as timestamp) as event_timestamp", "event_id")
        numbered = sessionize(self.deduplicated, ["user_id"], ["event_timestamp", "event_id"], "event_timestamp",
                              SESSION_GAP_SECONDS, probe=probe)
        return (numbered.withColumn("session_id", F.concat_ws("-", "customer_id", F.col("session_num").cast("string")))
                .drop("session_num", "user_id"))

    # --- source snapshots ---

    @cached_property
    def titles_source(self) -> DataFrame:
        return self.table("part").selectExpr(
            f"concat('tt', {padded('p_partkey')}) as tconst", "p_name as primary_title", "p_type as title_type",
            "replace(p_name, ' ', ',') as genres", "p_size as runtime_minutes",
            "cast((p_partkey % 91) / 10 + 1 as decimal(3,1)) as imdb_rating",
            "cast(p_partkey * 7 % 1000 as int) as num_votes")

    @cached_property
    def nations(self) -> DataFrame:
        return self.table("nation").select("n_nationkey", "n_name")

    @cached_property
    def customers_source(self) -> DataFrame:
        named = self.table("customer").withColumnRenamed("c_nationkey", "n_nationkey").join(
            self.nations, "n_nationkey", "left")
        return named.selectExpr(
            "cast(c_custkey as string) as customer_id", "sha2(cast(c_custkey as string), 256) as email_hash",
            "date_add(date'2023-11-06', cast(c_custkey % 70 as int)) as signup_date", "n_name as country",
            "c_mktsegment as plan_tier", f"{pick(schema.AGE_BANDS, 'c_custkey')} as age_band",
            "cast(c_custkey % 5 + 1 as int) as household_size")

    @cached_property
    def registry(self) -> DataFrame:
        named = self.table("supplier").withColumnRenamed("s_nationkey", "n_nationkey").join(
            self.nations, "n_nationkey", "left")
        return named.selectExpr("*", "explode(array(0, 1)) as v").selectExpr(
            "concat('d', s_suppkey) as device_id", "concat('d', s_suppkey, '_v', v) as device_version_id",
            f"{pick(DEVICE_TYPES, 's_suppkey')} as device_type", "n_name as platform", "s_name as device_model",
            "concat('os', n_nationkey) as os_version", "concat('app', v) as app_version",
            "v = 0 and s_acctbal < 0 as is_deprecated")

    # --- dimensions ---

    @cached_property
    def dim_title(self) -> DataFrame:
        return dims.build_dim_title(self.titles_source)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.build_dim_customer(self.customers_source)

    @cached_property
    def dim_device(self) -> DataFrame:
        return dims.build_dim_device(self.registry)

    @cached_property
    def dim_device_version(self) -> DataFrame:
        return dims.build_dim_device_version(self.registry, self.dim_device)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.build_dim_date(self.spark)

    @property
    def star(self) -> dict[str, tuple[DataFrame, str, str]]:
        return {"customer_id": (self.dim_customer, "customer_id", "customer_key"),
                "title_id": (self.dim_title, "tconst", "title_key"),
                "device_id": (self.dim_device, "device_id", "device_key"),
                "device_version_id": (self.dim_device_version, "device_version_id", "device_version_key")}

    # --- facts and marts ---

    @cached_property
    def fact_events(self) -> DataFrame:
        return facts.build_fact_events(self.raw, self.star, keep=["server_received_at"])

    @cached_property
    def fact_sessions(self) -> DataFrame:
        return facts.build_fact_sessions(self.fact_events, self.dim_title, ROLES, extra=True)

    @cached_property
    def fact_daily(self) -> DataFrame:
        return facts.build_fact_daily(self.fact_sessions)

    @cached_property
    def content_mart(self) -> DataFrame:
        return marts.content_engagement(self.fact_sessions, self.dim_title)

    @cached_property
    def device_mart(self) -> DataFrame:
        return marts.device_engagement(self.fact_sessions, self.dim_device)

    @cached_property
    def genre_mart(self) -> DataFrame:
        return marts.genre_mix(self.fact_sessions, self.dim_title)

    @cached_property
    def funnel_mart(self) -> DataFrame:
        return marts.completion_funnel(self.fact_sessions, self.dim_title)

    def stored(self, *names: str) -> Playback:
        """The same model with the named tables written once, in order, to the shared folder and read back.

        For queries that use a table several times, which would otherwise compute it several times.
        """
        out, root = Playback(self.spark, self.folder), work_path(self.spark, "zone")
        for n in names:
            df = getattr(out, n)
            df.write.parquet(f"{root}/{n}")
            out.__dict__[n] = self.spark.read.schema(df.schema).parquet(f"{root}/{n}")
        return out

    def tables(self, *names: str) -> dict[str, DataFrame]:
        own = {"customers": "customers_source"}
        return {n: getattr(self, own.get(n, n)) for n in names}
