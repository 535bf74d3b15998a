"""Declared schemas, enums and thresholds of the playback model."""

from __future__ import annotations

# Event types, end types, title types kept, schema version.
EVENT_TYPES = ("play", "pause", "seek", "resume", "complete", "exit")
END_TYPES = ("complete", "exit")
WATCHABLE_TYPES = ("movie", "tvSeries", "tvMovie", "tvMiniSeries")
SCHEMA_VERSION = 1
TITLE_ID_PATTERN = "^tt[0-9]{7,10}$"
NULL_SENTINEL = "\\N"
PLAN_TIERS = ("basic", "standard", "premium")
AGE_BANDS = ("18-24", "25-34", "35-49", "50+")

CLOCK_SKEW_SECONDS = 5 * 60
STALE_SECONDS = 24 * 3600
LOOKBACK_MINUTES = 90
SESSION_GAP_SECONDS = 30 * 60
TARGET_FILE_BYTES = 128 * 1024 * 1024
RETENTION_DAYS = {"landing": 7, "raw": 90, "processed": 3 * 365, "reporting": 5 * 365}


WIRE_EVENT_DDL = (
    "event_id string, session_id string, customer_id string, title_id string, device_id string, "
    "device_version_id string, event_type string, event_timestamp string, position_ms int, bitrate_kbps int, "
    "geo_country string, schema_version int"
)
LANDING_EVENT_DDL = (
    "event_id string, session_id string, customer_id string, title_id string, device_id string, "
    "device_version_id string, event_type string, event_timestamp timestamp, server_received_at timestamp, "
    "position_ms int, bitrate_kbps int, geo_country string, schema_version int, event_date string, event_hour int"
)
CUSTOMER_DDL = (
    "customer_id string, email_hash string, signup_date string, country string, plan_tier string, age_band string, "
    "household_size string, created_at string, updated_at string"
)
DEVICE_DDL = (
    "device_id string, device_version_id string, device_type string, platform string, device_model string, "
    "os_version string, app_version string, is_deprecated boolean"
)
TITLE_FILES_DDL = {
    "title.basics": (
        "tconst string, titleType string, primaryTitle string, originalTitle string, isAdult string, "
        "startYear string, endYear string, runtimeMinutes string, genres string"
    ),
    "title.ratings": "tconst string, averageRating string, numVotes string",
    "title.akas": (
        "titleId string, ordering string, title string, region string, language string, types string, "
        "attributes string, isOriginalTitle string"
    ),
    "name.basics": (
        "nconst string, primaryName string, birthYear string, deathYear string, primaryProfession string, "
        "knownForTitles string"
    ),
    "title.principals": (
        "tconst string, ordering string, nconst string, category string, job string, characters string"
    ),
}
METRICS_DDL = (
    "dag_id string, run_id string, metric_name string, metric_value double, data_interval_start timestamp, "
    "data_interval_end timestamp, recorded_at timestamp"
)
