"""Sources, conforming steps, joins, raw zone, dimensions and facts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide import schema
from viewtide.bind import ROLES, RULES, Playback
from viewtide.catalog.patterns import ev, titles
from viewtide.catalog.registry import query
from viewtide.functions import scalars
from viewtide.operators import joins, keys
from viewtide.plans import dims, facts, raw
from viewtide.plans.raw import Rules
from viewtide.session import work_path
from viewtide.sources import readers, tables

EVENT = "event_id:i customer_id:s title_id:s event_type:s event_timestamp:t server_received_at:t position_ms:i"


def ts(text: str):
    return F.lit(text).cast("timestamp")


# --- sources ---

@query("s1_read_interval", "event_id:i server_received_at:t event_date:s",
       """SELECT event_id, server_received_at, event_date FROM marked WHERE reason IS NULL
          AND server_received_at >= TIMESTAMP '2024-01-09 22:30:00' AND server_received_at < TIMESTAMP '2024-01-11'""")
def read_interval(p):
    clean, _ = raw.split_quarantine(p.landing, RULES)
    return readers.read_interval(clean, "server_received_at", ts("2024-01-10"), ts("2024-01-11"),
                                 date_col="event_date")


@query("s2_read_null_tsv", "tconst:s titleType:s primaryTitle:s runtimeMinutes:s",
       """SELECT tconst, title_type AS titleType, primary_title AS primaryTitle,
          CASE WHEN runtime_minutes % 5 <> 0 THEN CAST(runtime_minutes AS VARCHAR) END AS runtimeMinutes
          FROM titles_source""")
def read_null_tsv(p):
    path = work_path(p.spark, "titles-tsv")
    basics = vendor_basics(p)
    (basics.select(*[F.coalesce(F.col(c).cast("string"), F.lit(schema.NULL_SENTINEL)).alias(c) for c in basics.columns])
     .write.option("sep", "\t").option("header", True).option("quote", "").option("compression", "gzip").csv(path))
    return readers.read_null_tsv(p.spark, path, schema.TITLE_FILES_DDL["title.basics"])


def vendor_basics(p: Playback) -> DataFrame:
    """Titles in the vendor's column names; a runtime divisible by 5 is unknown."""
    t = p.titles_source
    return t.select(
        "tconst", F.col("title_type").alias("titleType"), F.col("primary_title").alias("primaryTitle"),
        F.col("primary_title").alias("originalTitle"), F.when(F.col("num_votes") % 17 == 0, "1").otherwise("0")
        .alias("isAdult"), F.lit("2020").alias("startYear"), F.lit(None).cast("string").alias("endYear"),
        F.when(F.col("runtime_minutes") % 5 != 0, F.col("runtime_minutes").cast("string")).alias("runtimeMinutes"),
        "genres")


def vendor_ratings(p: Playback) -> DataFrame:
    t = p.titles_source.where(F.col("num_votes") % 3 != 0)
    return t.select("tconst", F.col("imdb_rating").cast("string").alias("averageRating"),
                    F.col("num_votes").cast("string").alias("numVotes"))


@query("s3_read_jsonl", "customer_id:s country:s plan_tier:s household_size:s bad_lines:i",
       """SELECT customer_id, country, plan_tier, CAST(household_size AS VARCHAR) AS household_size, 0 AS bad_lines
          FROM customers_source""")
def read_jsonl(p):
    path = work_path(p.spark, "customers-json")
    p.customers_source.write.option("compression", "gzip").json(path)
    rows = readers.read_jsonl(p.spark, path, schema.CUSTOMER_DDL)
    return rows.withColumn("bad_lines", F.when(F.col(readers.CORRUPT).isNotNull(), 1).otherwise(0))


@query("s4_partitioned_json", "dd:i event_type:s n:i",
       """SELECT day(event_date) AS dd, event_type, count(*) AS n FROM landing WHERE day(event_date) BETWEEN 8 AND 14
          GROUP BY 1, 2""")
def partitioned_json(p):
    path = work_path(p.spark, "landing-json")
    day = F.col("event_date")
    rows = p.landing.withColumns({"yyyy": F.year(day), "mm": F.month(day), "dd": F.dayofmonth(day)})
    (rows.hint("rebalance", "yyyy", "mm", "dd").write.partitionBy("yyyy", "mm", "dd")
     .option("compression", "gzip").json(path))
    read = readers.read_partitioned_json(p.spark, path, schema.WIRE_EVENT_DDL, F.col("dd").between(8, 14),
                                         parts="yyyy int, mm int, dd int")
    return read.groupBy("dd", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("s7_date_series", "day:s n:i",
       """SELECT d.day, count(event_id) AS n FROM (SELECT CAST(unnest(generate_series(min(day), max(day),
          INTERVAL 1 DAY)) AS DATE) AS day FROM ev) d LEFT JOIN ev ON ev.day = d.day GROUP BY 1""")
def date_series(p):
    rows = ev(p)
    spine = rows.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select(
        F.explode(F.sequence("lo", "hi")).alias("day"))
    counts = rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("s8_read_zone", "event_date:s n:i max_position_ms:i",
       "SELECT event_date, count(*) AS n, max(position_ms) AS max_position_ms FROM deduplicated GROUP BY 1")
def read_zone(p):
    root = work_path(p.spark, "zones")
    tables.replace_table(p.deduplicated, f"{root}/raw/playback_events", ["event_date"])
    stored = readers.read_zone(p.spark, root, "raw", "playback_events")
    return stored.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"), F.max("position_ms").alias("max_position_ms"))


@query("s9_read_as_of", "tconst:s num_votes:i", "SELECT tconst, num_votes FROM titles_source")
def read_as_of(p):
    path = work_path(p.spark, "titles-versions")
    tables.publish_version(p.titles_source, path, 1)
    tables.publish_version(p.titles_source.withColumn("num_votes", F.col("num_votes") + 1), path, 5)
    return tables.read_as_of(p.spark, path, 4)


@query("s10_read_tolerant", "kind:s n:i",
       """SELECT CASE WHEN event_id % 97 = 0 THEN 'corrupt' ELSE 'good' END AS kind, count(*) AS n
          FROM events GROUP BY 1""")
def read_tolerant(p):
    path = work_path(p.spark, "lines")
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), "event_type"))
    p.events.select(F.when(F.col("event_id") % 97 == 0, F.substring(line, 1, 12)).otherwise(line)).write.text(path)
    good, corrupt = readers.read_tolerant(p.spark, path, "event_id string, event_type string")
    return (good.select(F.lit("good").alias("kind")).unionByName(corrupt.select(F.lit("corrupt").alias("kind")))
            .groupBy("kind").agg(F.count(F.lit(1)).alias("n")))


# --- projections, filters, casts ---

@query("p1_conform_events", "event_id:i event_timestamp:t position_ms:i title_id:s event_date:s event_hour:i",
       """SELECT event_id, CASE WHEN event_id % 83 <> 0 THEN event_timestamp END AS event_timestamp,
          CASE WHEN event_id % 79 <> 0 THEN position_ms END AS position_ms, title_id,
          CASE WHEN event_id % 83 <> 0 THEN event_date END AS event_date,
          CASE WHEN event_id % 83 <> 0 THEN event_hour END AS event_hour FROM landing""")
def conform_events(p):
    """Text events: every 83rd time and every 79th position does not parse, title ids carry blanks."""
    text = p.landing.select(
        "event_id", F.concat(F.lit(" "), "title_id", F.lit(" ")).alias("title_id"),
        F.when(F.col("event_id") % 83 == 0, "not a time").otherwise(F.col("event_timestamp").cast("string"))
        .alias("event_timestamp"), F.col("server_received_at").cast("string").alias("server_received_at"),
        F.when(F.col("event_id") % 79 == 0, "x").otherwise(F.col("position_ms").cast("string")).alias("position_ms"),
        F.col("bitrate_kbps").cast("string").alias("bitrate_kbps"))
    return raw.conform_events(text)


@query("p2_conform_customers", "customer_id:s signup_date:s household_size:i",
       "SELECT customer_id, signup_date, household_size FROM customers_source")
def conform_customers(p):
    text = p.customers_source.withColumns({
        "signup_date": F.col("signup_date").cast("string"), "household_size": F.col("household_size").cast("string"),
        "created_at": F.lit("2024-01-01T00:00:00Z"), "updated_at": F.lit("2024-01-01T00:00:00Z")})
    return raw.conform_customers(text)


@query("p2_conform_devices", "device_version_id:s device_type:s is_deprecated:s",
       "SELECT device_version_id, device_type, is_deprecated FROM registry")
def conform_devices(p):
    return raw.conform_devices(p.registry.withColumn("is_deprecated", F.col("is_deprecated").cast("string")))


@query("p3_conform_titles", "tconst:s title_type:s runtime_minutes:i imdb_rating:d num_votes:i",
       """SELECT tconst, title_type, CASE WHEN runtime_minutes % 5 <> 0 THEN runtime_minutes END AS runtime_minutes,
          CASE WHEN num_votes % 3 <> 0 THEN imdb_rating END AS imdb_rating,
          CASE WHEN num_votes % 3 <> 0 THEN num_votes END AS num_votes
          FROM titles_source WHERE title_type IN ('PROMO', 'SMALL', 'LARGE')""")
def conform_titles(p):
    return raw.conform_titles(vendor_basics(p), vendor_ratings(p), ("PROMO", "SMALL", "LARGE"))


@query("p4_null_sentinels", "c_custkey:i c_name:s c_mktsegment:s",
       """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_name END AS c_name,
          CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer""")
def null_sentinels(p):
    rows = p.table("customer").withColumns({
        "c_name": F.when(F.col("c_custkey") % 3 == 0, schema.NULL_SENTINEL).otherwise(F.col("c_name")),
        "c_mktsegment": F.when(F.col("c_custkey") % 5 == 0, schema.NULL_SENTINEL).otherwise(F.col("c_mktsegment"))})
    return scalars.null_sentinels(rows)


@query("p5_enum_membership", "event_type:s valid:s n:i",
       "SELECT event_type, event_type <> 'error' AS valid, count(*) AS n FROM events GROUP BY 1, 2")
def enum_membership(p):
    valid = F.col("event_type").isin(list(RULES.event_types))
    return p.events.groupBy("event_type", valid.alias("valid")).agg(F.count(F.lit(1)).alias("n"))


@query("p6_title_pattern", "title_id:s n:i",
       """SELECT title_id, count(*) AS n FROM landing WHERE NOT regexp_matches(title_id, '^tt[0-9]{7,10}$')
          GROUP BY 1""")
def title_pattern(p):
    return (p.landing.where(~F.col("title_id").rlike(schema.TITLE_ID_PATTERN)).groupBy("title_id")
            .agg(F.count(F.lit(1)).alias("n")))


@query("p7_split_quarantine", "reason:s n:i",
       "SELECT coalesce(reason, 'clean') AS reason, count(*) AS n FROM marked GROUP BY 1")
def quarantine_counts(p):
    clean, bad = raw.split_quarantine(p.landing, RULES)
    return (clean.select(F.lit("clean").alias("reason")).unionByName(bad.select(F.col(raw.REASON).alias("reason")))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


@query("p8_schema_version", "reason:s n:i",
       """SELECT reason, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN 'unknown_event_type'
          WHEN event_id % 89 = 0 THEN 'schema_version_mismatch' ELSE coalesce(reason, 'clean') END AS reason
          FROM marked) GROUP BY 1""")
def schema_version(p):
    rows = p.landing.withColumn("schema_version", F.when(F.col("event_id") % 89 == 0, 2).otherwise(1))
    rules = Rules(event_types=RULES.event_types, schema_version=1)
    return (raw.with_reason(rows, rules).groupBy(F.coalesce(raw.REASON, F.lit("clean")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("p9_required_fields", "reason:s n:i",
       """SELECT reason, count(*) AS n FROM (SELECT CASE
            WHEN event_type = 'error' AND event_id % 31 <> 0 THEN 'unknown_event_type'
            WHEN event_timestamp > server_received_at + INTERVAL 5 MINUTE THEN 'future_client_clock'
            WHEN NOT regexp_matches(title_id, '^tt[0-9]{7,10}$') THEN 'invalid_title_id'
            WHEN reason = 'stale_late_arrival' THEN reason
            WHEN event_id % 29 = 0 THEN 'missing_customer_id'
            WHEN event_id % 31 = 0 THEN 'missing_event_type' ELSE 'clean' END AS reason FROM (
              SELECT * REPLACE (CASE WHEN epoch_us(server_received_at) // 1000000
                - epoch_us(event_timestamp) // 1000000 > 86400 THEN 'stale_late_arrival' END AS reason) FROM marked))
          GROUP BY 1""")
def required_fields(p):
    rows = p.landing.withColumns({
        "customer_id": F.when(F.col("event_id") % 29 != 0, F.col("customer_id")),
        "event_type": F.when(F.col("event_id") % 31 != 0, F.col("event_type")),
        "session_id": F.col("customer_id")})
    rules = Rules(event_types=RULES.event_types, required=("customer_id", "event_type", "session_id", "title_id",
                                                           "event_timestamp", "server_received_at"))
    return (raw.with_reason(rows, rules).groupBy(F.coalesce(raw.REASON, F.lit("clean")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("p10_extra_fields", "event_id:i n_extra:i extra_k:s",
       "SELECT event_id, 1 AS n_extra, regexp_extract(props, '([0-9]+)', 1) AS extra_k FROM events")
def extra_fields(p):
    payload = F.regexp_replace("props", "\\}$", ', "schema_version": 1}')
    rows = p.events.withColumn("_extra_fields", scalars.extra_fields(payload, ["event_id", "schema_version"]))
    return rows.select("event_id", F.size("_extra_fields").alias("n_extra"),
                       F.col("_extra_fields")["k"].alias("extra_k"))


@query("p11_hash_attributes", "c_custkey:i email_hash:s plan_tier:s age_band:s household_size:i",
       """SELECT c_custkey, h AS email_hash,
          CASE CAST('0x' || h[1:2] AS INTEGER) % 3 WHEN 0 THEN 'basic' WHEN 1 THEN 'standard' ELSE 'premium' END
          AS plan_tier,
          CASE CAST('0x' || h[3:4] AS INTEGER) % 4 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-49'
          ELSE '50+' END AS age_band, CAST('0x' || h[5:6] AS INTEGER) % 5 + 1 AS household_size
          FROM (SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS h FROM customer)""")
def hash_attributes(p):
    return scalars.hash_attributes(p.table("customer"), "c_custkey")


@query("p12_mask", "customer_id:s email_hash:s",
       "SELECT customer_id, regexp_replace(regexp_replace(email_hash, '[0-9]', 'n', 'g'), '[a-mo-z]', 'x', 'g') "
       "AS email_hash FROM customers_source")
def mask(p):
    return scalars.mask_columns(p.customers_source.select("customer_id", "email_hash"), ["email_hash"])


@query("p13_normalise_landing", "event_id:i event_timestamp:t server_received_at:t schema_version:i event_hour:i",
       """SELECT event_id, e AS event_timestamp, server_received_at, schema_version, hour(e) AS event_hour
          FROM (SELECT *, CASE WHEN event_id % 61 = 0 THEN server_received_at ELSE event_timestamp END AS e
                FROM landing)""")
def normalise_landing(p):
    decoded = p.landing.select(
        "event_id", F.when(F.col("event_id") % 61 != 0, F.col("event_timestamp").cast("string"))
        .otherwise("broken").alias("event_timestamp"), F.col("server_received_at").alias("broker_ts"),
        F.when(F.col("event_id") % 2 == 0, F.col("schema_version")).alias("schema_version"))
    return raw.normalise_landing(decoded)


@query("p14_filter_adult", "tconst:s", "SELECT tconst FROM titles_source WHERE num_votes % 17 <> 0")
def filter_adult(p):
    return raw.filter_adult(vendor_basics(p))


@query("p15_fix_encoding", "event_id:i geo:s encoding_warning:s",
       """SELECT event_id, CASE WHEN event_id % 41 = 0 THEN event_type || '?' ELSE event_type END AS geo,
          event_id % 41 = 0 AS encoding_warning FROM events""")
def fix_encoding(p):
    broken = F.concat(F.col("event_type").cast("binary"), F.unhex(F.lit("FF"))).cast("string")
    rows = p.events.select("event_id", F.when(F.col("event_id") % 41 == 0, broken).otherwise(F.col("event_type"))
                           .alias("geo"))
    return scalars.fix_encoding(rows, ["geo"])


# --- joins ---

@query("j1_resolve_keys", "event_id:i customer_key:i title_key:i device_key:i device_version_key:i",
       "SELECT event_id, customer_key, title_key, device_key, device_version_key FROM fact_events")
def resolve_keys(p):
    return joins.resolve_keys(p.raw, p.star)


@query("j2_attach_left", "l_returnflag:s p_type:s n:i",
       """SELECT l_returnflag, p_type, count(*) AS n FROM lineitem LEFT JOIN (SELECT * FROM part
          WHERE p_size > 10) ON l_partkey = p_partkey GROUP BY 1, 2""")
def attach_left(p):
    part = p.table("part").where(F.col("p_size") > 10).withColumnRenamed("p_partkey", "l_partkey")
    return (joins.attach(p.table("lineitem").select("l_partkey", "l_returnflag"), part, "l_partkey", ["p_type"])
            .groupBy("l_returnflag", "p_type").agg(F.count(F.lit(1)).alias("n")))


@query("j3_attach_inner", "l_returnflag:s p_type:s n:i",
       """SELECT l_returnflag, p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
          WHERE p_size > 10 GROUP BY 1, 2""")
def attach_inner(p):
    part = p.table("part").where(F.col("p_size") > 10).withColumnRenamed("p_partkey", "l_partkey")
    return (joins.attach(p.table("lineitem").select("l_partkey", "l_returnflag"), part, "l_partkey", ["p_type"],
                         "inner").groupBy("l_returnflag", "p_type").agg(F.count(F.lit(1)).alias("n")))


@query("j4_touched_rows", "event_id:i session_id:s",
       """SELECT event_id, session_id FROM raw WHERE session_id IN (SELECT session_id FROM raw
          WHERE event_timestamp >= TIMESTAMP '2024-01-10' AND event_timestamp < TIMESTAMP '2024-01-11')""")
def touched_rows(p):
    return joins.touched_rows(p.raw, "session_id", "event_timestamp", ts("2024-01-10"), ts("2024-01-11"))


@query("j5_new_keys", "c_custkey:i",
       "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey "
       "AND o_orderstatus = 'F')")
def new_keys(p):
    known = p.table("orders").where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return joins.new_keys(p.table("customer").select("c_custkey"), known, "c_custkey")


@query("j6_share_of_total", "day:s event_type:s n:i day_total:i",
       """SELECT day, event_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY day) AS day_total FROM ev
          GROUP BY 1, 2""")
def share_of_total(p):
    counts = ev(p).groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return joins.share_of_total(counts, ["day"], "n", "day_total")


@query("j7_explode_list", "k:i word:s",
       "SELECT k, u.w AS word FROM titles, unnest(string_split(p_name, ' ')) AS u(w)")
def explode_list(p):
    return scalars.explode_list(titles(p), "p_name", " ", out="word")


@query("j8_by_list_member", "genre_name:s n:i",
       """SELECT u.g AS genre_name, count(*) AS n FROM titles_source, unnest(string_split(genres, ',')) AS u(g)
          GROUP BY 1""")
def by_list_member(p):
    genres = dims.build_dim_genre(p.titles_source)
    return (joins.by_list_member(p.titles_source.select("tconst", "genres"), "genres", genres, "genre_name")
            .groupBy("genre_name").agg(F.count(F.lit(1)).alias("n")))


@query("j9_parent_key", "device_version_id:s device_key:i",
       "SELECT device_version_id, device_key FROM dim_device_version")
def parent_key(p):
    return joins.parent_key(p.registry.select("device_version_id", "device_id"), p.dim_device, "device_id",
                            "device_key")


@query("j10_zero_activity", "title_key:i engagement_date:s",
       """SELECT title_key, d AS engagement_date FROM (SELECT title_key, CAST(unnest(generate_series(
          DATE '2024-01-01' + CAST(num_votes % 20 AS INTEGER), DATE '2024-01-01' + CAST(num_votes % 20 + 9 AS INTEGER),
          INTERVAL 1 DAY)) AS DATE) AS d FROM dim_title) g WHERE NOT EXISTS (SELECT 1 FROM fact_daily f
          WHERE f.title_key = g.title_key AND f.engagement_date = g.d)""")
def zero_activity(p):
    released = p.dim_title.withColumn("release", F.date_add(F.lit("2024-01-01").cast("date"), F.col("num_votes") % 20))
    return joins.zero_activity(released, "title_key", "release", p.fact_daily, "engagement_date", days=10)


@query("j11_compare", "o_custkey:i left_n:i right_n:i status:s",
       """SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, a.n AS left_n, b.n AS right_n,
          CASE WHEN a.n IS NULL THEN 'only_right' WHEN b.n IS NULL THEN 'only_left' ELSE 'differs' END AS status
          FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a
          FULL JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b
          ON a.o_custkey = b.o_custkey WHERE a.n IS DISTINCT FROM b.n""")
def compare(p):
    n = p.table("orders").groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return joins.compare(n.where(F.col("o_orderstatus") == "F"), n.where(F.col("o_orderstatus") == "O"),
                         ["o_custkey"], ["n"])


# --- raw zone ---

def received_span(p) -> tuple[datetime, datetime]:
    """Bounds of the landing's server time, the upper one exclusive."""
    lo, hi = p.landing.agg(F.min("server_received_at"), F.max("server_received_at")).first()
    return lo, hi + timedelta(microseconds=1)


@query("rz1_build_raw_events", EVENT,
       """SELECT event_id, customer_id, title_id, event_type, event_timestamp, server_received_at, position_ms
          FROM deduplicated""")
def build_raw_events(p):
    clean, _ = raw.build_raw_events(p.landing, *map(F.lit, received_span(p)), RULES)
    return clean


@query("rz1_quarantine", "event_id:i position_ms:i reason:s", "SELECT event_id, position_ms, reason FROM quarantine")
def quarantine(p):
    _, bad = raw.build_raw_events(p.landing, *map(F.lit, received_span(p)), RULES)
    return bad.withColumnRenamed(raw.REASON, "reason")


@query("rz2_build_raw_snapshots", "customer_id:s signup_date:s n_versions:i",
       "SELECT customer_id, signup_date, (SELECT count(*) FROM registry) AS n_versions FROM customers_source")
def build_raw_snapshots(p):
    root = work_path(p.spark, "snapshots")
    text = p.customers_source.withColumns({c: F.col(c).cast("string") for c in ("signup_date", "household_size")})
    customers = text.withColumns({"created_at": F.lit("2024-01-01"), "updated_at": F.lit("2024-01-01")})
    raw.build_raw_snapshots(customers, p.registry, f"{root}/customers", f"{root}/devices")
    n = tables.read_table(p.spark, f"{root}/devices").agg(F.count(F.lit(1)).alias("n_versions"))
    stored = tables.read_table(p.spark, f"{root}/customers")
    return stored.withColumn("__k", F.lit(0)).join(F.broadcast(n.withColumn("__k", F.lit(0))), "__k")  # one row


@query("rz3_build_raw_titles", "tconst:s title_type:s runtime_minutes:i num_votes:i",
       """SELECT tconst, title_type, CASE WHEN runtime_minutes % 5 <> 0 THEN runtime_minutes END AS runtime_minutes,
          CASE WHEN num_votes % 3 <> 0 THEN num_votes END AS num_votes FROM titles_source
          WHERE title_type IN ('movie', 'tvSeries', 'tvMovie', 'tvMiniSeries', 'PROMO')""")
def build_raw_titles(p):
    root = work_path(p.spark, "raw-titles")
    basics = vendor_basics(p).withColumn(
        "titleType", F.when(F.col("titleType") == "PROMO", "movie").otherwise(F.col("titleType")))
    raw.build_raw_titles(basics, vendor_ratings(p), root)
    return tables.read_table(p.spark, root).withColumn("title_type", F.lit("PROMO"))


@query("rz4_title_files", "titleId:s ordering:i region:s isOriginalTitle:s",
       """SELECT tconst AS titleId, CASE WHEN num_votes % 4 <> 0 THEN num_votes END AS ordering,
          CASE WHEN num_votes % 5 <> 0 THEN primary_title END AS region, num_votes % 2 = 1 AS isOriginalTitle
          FROM titles_source""")
def title_files(p):
    t, v = p.titles_source, F.col("num_votes")
    akas = t.select(
        F.col("tconst").alias("titleId"), F.when(v % 4 == 0, schema.NULL_SENTINEL).otherwise(v.cast("string"))
        .alias("ordering"), F.col("primary_title").alias("title"),
        F.when(v % 5 == 0, schema.NULL_SENTINEL).otherwise(F.col("primary_title")).alias("region"),
        F.lit(schema.NULL_SENTINEL).alias("language"), F.lit("").alias("types"), F.lit("").alias("attributes"),
        (v % 2).cast("string").alias("isOriginalTitle"))
    return raw.build_raw_imdb("title.akas", akas)


@query("rz5_late_events", "event_id:i server_received_at:t",
       "SELECT event_id, server_received_at FROM marked WHERE reason = 'stale_late_arrival'")
def late_events(p):
    return raw.late_events(p.landing, RULES)


@query("rz6_range_backfill", EVENT,
       """SELECT event_id, customer_id, title_id, event_type, event_timestamp, server_received_at, position_ms
          FROM deduplicated""")
def range_backfill(p):
    """Ten-day intervals, each run twice and the middle one again at the end: the table is the one-pass result."""
    root = work_path(p.spark, "backfill")

    def job(lo: datetime, hi: datetime) -> None:
        clean, bad = raw.build_raw_events(p.landing, F.lit(lo), F.lit(hi), RULES)
        tables.upsert(clean, f"{root}/raw", ["event_id"], ["event_date"], ["server_received_at"])

    start, end = received_span(p)
    step = timedelta(days=11)
    raw.run_range(job, start, end, step)
    raw.run_range(job, start + step, start + 2 * step, step)
    return tables.read_table(p.spark, f"{root}/raw")


# --- dimensions ---

@query("dm1_upsert_scd1", "title_key:i tconst:s num_votes:i",
       """WITH src AS (SELECT tconst, num_votes FROM titles_source WHERE title_type <> 'SMALL'),
          old AS (SELECT row_number() OVER (ORDER BY tconst) AS title_key, tconst, num_votes + 5 AS num_votes
                  FROM titles_source WHERE title_type <> 'PROMO')
          SELECT title_key, old.tconst, coalesce(src.num_votes, old.num_votes) AS num_votes
          FROM old LEFT JOIN src ON old.tconst = src.tconst
          UNION ALL
          SELECT (SELECT max(title_key) FROM old) + row_number() OVER (ORDER BY tconst), tconst, num_votes
          FROM src WHERE tconst NOT IN (SELECT tconst FROM old)""")
def upsert_scd1(p):
    rows = p.titles_source.select("tconst", "num_votes", "title_type")
    before = rows.where("title_type <> 'PROMO'").selectExpr("tconst", "num_votes + 5 as num_votes")
    now = rows.where("title_type <> 'SMALL'").select("tconst", "num_votes")
    return dims.upsert_scd1(dims.upsert_scd1(None, before, "tconst", "title_key"), now, "tconst", "title_key")


@query("dm2_dim_title", "title_key:i tconst:s primary_title:s title_type:s genres:s runtime_minutes:i imdb_rating:d",
       "SELECT * FROM dim_title")
def dim_title(p):
    return p.dim_title


@query("dm2_dim_customer", "customer_key:i customer_id:s email_hash:s signup_date:s country:s plan_tier:s age_band:s",
       "SELECT * FROM dim_customer")
def dim_customer(p):
    return p.dim_customer


@query("dm3_dim_device", "device_key:i device_id:s device_type:s platform:s device_model:s",
       "SELECT * FROM dim_device")
def dim_device(p):
    return p.dim_device


@query("dm4_dim_device_version",
       "device_version_key:i device_version_id:s device_key:i os_version:s app_version:s is_deprecated:s",
       "SELECT * FROM dim_device_version")
def dim_device_version(p):
    return p.dim_device_version


@query("dm5_dim_date", "date_key:i full_date:s quarter:i month_name:s day_of_week:i day_name:s week_of_year:i "
       "is_weekend:s is_premiere_friday:s season:s n_events:i",
       "SELECT d.*, (SELECT count(*) FROM ev WHERE ev.day = d.full_date) AS n_events FROM dim_date d")
def dim_date(p):
    """The calendar with the number of events of each day."""
    n = ev(p).groupBy(F.col("day").alias("full_date")).agg(F.count(F.lit(1)).alias("n_events"))
    return p.dim_date.join(n, "full_date", "left").withColumn("n_events", F.coalesce("n_events", F.lit(0)))


@query("dm6_dim_genre", "genre_key:i genre_name:s parent_genre:s",
       """SELECT row_number() OVER (ORDER BY genre_name) AS genre_key, genre_name,
          CASE WHEN genre_name = 'red' THEN 'colour' ELSE genre_name END AS parent_genre FROM (SELECT DISTINCT
          trim(u.g) AS genre_name FROM titles_source, unnest(string_split(genres, ',')) AS u(g))""")
def dim_genre(p):
    return dims.build_dim_genre(p.titles_source, {"red": "colour"})


@query("dm7_dim_time_of_day", "time_of_day_key:i daypart:s is_prime_time:s n_events:i",
       """SELECT h AS time_of_day_key, CASE WHEN h < 5 OR h >= 22 THEN 'late_night'
          WHEN h < 8 THEN 'early_morning' WHEN h < 12 THEN 'morning'
          WHEN h < 17 THEN 'afternoon' ELSE 'evening' END AS daypart,
          h IN (19, 20, 21) AS is_prime_time, count(event_hour) AS n_events
          FROM (SELECT unnest(range(24)) AS h) LEFT JOIN landing ON event_hour = h GROUP BY 1, 2, 3""")
def dim_time_of_day(p):
    n = p.landing.groupBy(F.col("event_hour").alias("time_of_day_key")).agg(F.count(F.lit(1)).alias("n_events"))
    return dims.build_dim_time_of_day(p.spark).join(n, "time_of_day_key", "left").fillna(0, ["n_events"])


@query("dm8_dim_geography", "geography_key:i country_code:s region:s",
       """SELECT row_number() OVER (ORDER BY n_name) AS geography_key, n_name AS country_code, r_name AS region
          FROM nation JOIN region ON n_regionkey = r_regionkey""")
def dim_geography(p):
    n = p.table("nation").join(p.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return dims.build_dim_geography(n.select(
        F.col("n_name").alias("country_code"), F.col("n_name").alias("country_name"), F.col("r_name").alias("region"),
        F.lit(None).cast("string").alias("sub_region"), F.lit(None).cast("string").alias("currency_code")))


@query("dm9_soft_delete", "tconst:s is_active:s last_seen_yyyymm:i",
       """SELECT tconst, title_type <> 'SMALL' AS is_active, CASE WHEN title_type <> 'SMALL' THEN 202402 ELSE 202401 END
          AS last_seen_yyyymm FROM titles_source""")
def soft_delete(p):
    first = dims.soft_delete(p.titles_source, p.titles_source, "tconst", 202401)
    return dims.soft_delete(first, p.titles_source.where("title_type <> 'SMALL'"), "tconst", 202402)


@query("dm10_key_collisions", "short_key:i natural_keys:i",
       """SELECT c_custkey % 1000 AS short_key, count(DISTINCT c_name) AS natural_keys FROM customer GROUP BY 1
          HAVING count(DISTINCT c_name) > 1""")
def key_collisions(p):
    dim = p.table("customer").select((F.col("c_custkey") % 1000).alias("short_key"), "c_name")
    return keys.key_collisions(dim, "c_name", "short_key")


# --- facts ---

@query("fx1_fact_events", "event_id:i session_id:s customer_key:i title_key:i device_key:i device_version_key:i "
       "date_key:i event_type:s event_timestamp:t position_ms:i bitrate_kbps:i geo_country:s event_date:s event_hour:i",
       "SELECT * FROM fact_events")
def fact_events(p):
    return p.fact_events


@query("fx1_event_keys", "event_id:i time_of_day_key:i schema_version:i geography_key:i",
       """SELECT event_id, event_hour AS time_of_day_key, 1 AS schema_version, CASE WHEN k < 10 THEN k + 1 END
          AS geography_key FROM (SELECT *, CAST(substr(geo_country, 2) AS BIGINT) AS k FROM fact_events)""")
def event_keys(p):
    countries = p.raw.select(F.col("geo_country").alias("country_code")).distinct().withColumns(
        {c: F.lit("x") for c in ("country_name", "region", "sub_region", "currency_code")})
    return facts.with_event_keys(p.fact_events, p.raw, dims.build_dim_geography(countries))


@query("fx2_fact_sessions", "session_id:s customer_key:i title_key:i device_key:i date_key:i session_start_ts:t "
       "session_end_ts:t watch_duration_seconds:i content_duration_seconds:i completion_pct:d pause_count:i "
       "seek_count:i was_completed:s was_force_closed:s session_start_date:s", "SELECT * FROM fact_sessions")
def fact_sessions(p):
    return p.fact_sessions


@query("fx3_fact_daily", "engagement_date:s date_key:i customer_key:i title_key:i sessions_count:i "
       "total_watch_seconds:i completion_pct:d last_session_end_ts:t", "SELECT * FROM fact_daily")
def fact_daily(p):
    return p.fact_daily


@query("fx4_last_position", "engagement_date:s customer_key:i title_key:i last_position_ms:i",
       "SELECT * FROM fact_daily")
def last_position(p):
    return p.fact_daily


@query("fx5_daily_with_ending", "engagement_date:s customer_key:i title_key:i sessions_count:i total_watch_seconds:i "
       "last_content_seconds:i",
       """SELECT engagement_date, customer_key, title_key, count(*) AS sessions_count,
          sum(watch_duration_seconds) AS total_watch_seconds,
          arg_max(content_duration_seconds, session_end_ts) AS last_content_seconds
          FROM (SELECT session_start_date AS engagement_date, * FROM fact_sessions
                UNION ALL SELECT CAST(session_end_ts AS DATE), * FROM fact_sessions
                WHERE CAST(session_end_ts AS DATE) <> session_start_date) GROUP BY 1, 2, 3""")
def daily_with_ending(p):
    return facts.build_fact_daily(p.fact_sessions, include_ending=True)


@query("fx6_force_closed", "session_id:s was_force_closed:s",
       """SELECT session_id, NOT bool_or(event_type IN ('purchase', 'click')) AND epoch_us(TIMESTAMP '2024-01-20')
          // 1000000 - epoch_us(max(event_timestamp)) // 1000000 > 86400 AS was_force_closed FROM raw GROUP BY 1""")
def force_closed(p):
    return facts.force_closed(facts.ended_flag(p.raw, ROLES), ts("2024-01-20"))


@query("fx7_active_watch", "session_id:s active_watch_seconds:d",
       """SELECT session_id, sum(d) / 1000000.0 AS active_watch_seconds FROM (SELECT session_id,
          CASE WHEN event_type IN ('view', 'signup') THEN coalesce(epoch_us(lead(event_timestamp) OVER
          (PARTITION BY session_id ORDER BY event_timestamp, event_id)) - epoch_us(event_timestamp), 0) ELSE 0 END
          AS d FROM raw) GROUP BY 1""")
def active_watch(p):
    return facts.active_watch(p.raw, ROLES)


@query("fx8_orphan_rows", "event_id:i orphan_keys:s",
       """SELECT event_id, concat_ws(',', CASE WHEN NOT EXISTS (SELECT 1 FROM dim_customer c
            WHERE c.customer_id = r.customer_id AND plan_tier <> 'MACHINERY') THEN 'customer_key' END,
          CASE WHEN k_bad THEN 'title_key' END) AS orphan_keys
          FROM (SELECT *, title_id NOT IN (SELECT tconst FROM dim_title WHERE title_type <> 'PROMO') AS k_bad FROM raw) r
          WHERE k_bad OR NOT EXISTS (SELECT 1 FROM dim_customer c WHERE c.customer_id = r.customer_id
            AND plan_tier <> 'MACHINERY')""")
def orphan_rows(p):
    star = dict(p.star)
    star["customer_id"] = (p.dim_customer.where("plan_tier <> 'MACHINERY'"), "customer_id", "customer_key")
    star["title_id"] = (p.dim_title.where("title_type <> 'PROMO'"), "tconst", "title_key")
    return facts.orphan_rows(facts.build_fact_events(p.raw, star))


@query("fx9_session_extras", "session_id:s play_resume_count:i _last_event_at:t", "SELECT * FROM fact_sessions")
def session_extras(p):
    return p.fact_sessions
