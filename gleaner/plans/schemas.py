"""Schemas of the engine's tables. Times are UTC timestamps, payloads JSON text."""

PARTITIONS = (
    "id STRING, label STRING, filters ARRAY<STRING>, parent_id STRING, priority BIGINT, status STRING, total BIGINT, next_page INT,"
    " expected_total BIGINT, inaccessible_records BIGINT, error STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)
PAGES = "partition_id STRING, page INT, total BIGINT, count BIGINT, sha STRING, fingerprint STRING, url STRING, harvest_ts TIMESTAMP"
RECORDS = "record_id STRING, payload STRING, discovered_at TIMESTAMP"
RECORD_PARTITIONS = "record_id STRING, partition_id STRING, page INT"
CONFLICTS = "record_id STRING, partition_id STRING, page INT, payload STRING, detected_at TIMESTAMP"
REJECTIONS = "partition_id STRING, page INT, position INT, record_id STRING, reason STRING, payload STRING, raw_sha STRING, detected_at TIMESTAMP"
VALIDATIONS = "name STRING, payload STRING, validated_at TIMESTAMP"
API_CACHE = "url STRING, sha STRING, payload STRING, harvest_ts TIMESTAMP"
FACET_VALUES = "field STRING, value STRING, count BIGINT, discovered_at TIMESTAMP"
RECORD_SOURCES = "record_id STRING, source_path STRING, source_query_id STRING, compatibility_basis STRING, source_sha STRING, payload STRING, imported_at TIMESTAMP"
REUSE_SOURCES = "source_dir STRING, manifest_sha STRING, imported_at TIMESTAMP, records BIGINT, files BIGINT"
REUSED_FILES = "sha STRING, record_id STRING, is_site BOOLEAN, source_dir STRING"
RATE_LIMITS = "observed_at TIMESTAMP, url STRING, status INT, retry_after STRING, blocked_until TIMESTAMP, wait_source STRING, evidence STRING"
COOLDOWNS = "origin STRING, blocked_until TIMESTAMP, observed_at TIMESTAMP, url STRING, wait_source STRING"
INVALID_RESPONSES = (
    "url STRING, sha STRING, observed_at TIMESTAMP, category STRING, error STRING, status_value STRING,"
    " result_count_type STRING, result_count_value STRING, records_present BOOLEAN, records_type STRING"
)
FILE = "STRUCT<sha256: STRING, path: STRING, bytes: BIGINT, url: STRING, kind: STRING>"
ATTEMPT = "STRUCT<url: STRING, at: TIMESTAMP, depth: INT, final_url: STRING, kind: STRING, sha256: STRING, bytes: BIGINT, status: STRING, reason: STRING, stage: STRING, run_id: STRING>"
RESULTS = (
    f"record_id STRING, title STRING, status STRING, files ARRAY<{FILE}>, attempts ARRAY<{ATTEMPT}>,"
    " metadata_from_html ARRAY<MAP<STRING, ARRAY<STRING>>>, finished_at TIMESTAMP, limited BOOLEAN"
)
BATCHES = (
    "batch_number BIGINT, status STRING, bytes BIGINT, files BIGINT, manifest_sha STRING, closed_at TIMESTAMP, path STRING,"
    " archive_status STRING, external_location STRING, transfer_verified_at TIMESTAMP, transfer_manifest_sha STRING"
)
FILES = "sha STRING, batch_number BIGINT, path STRING, bytes BIGINT"
ASSOCIATIONS = "record_id STRING, sha STRING, batch_number BIGINT, included_in_batch BOOLEAN, discovered_at TIMESTAMP"
DOWNLOAD_INPUT = "record_id STRING, title STRING, urls ARRAY<STRING>"
HTTP_LOG = "ts TIMESTAMP, url STRING, status STRING, attempt INT, bytes BIGINT, error STRING, source STRING, sha256 STRING"
