"""Fixed values. These must stay exactly as written for results to agree with the reference
behaviour and the test fixtures; do not derive or reorder them."""

# --- fixed values: event vocabulary -------------------------------------------------------
EVENT_TYPES = ("ad_request", "impression", "q25", "q50", "q75", "q100")
QUARTILE_TYPES = ("q25", "q50", "q75", "q100")
DEVICES = ("mobile", "desktop", "ctv")
GEOS = ("US-CA", "US-NY", "GB-LND", "DE-BE", "JP-13")
PLACEMENTS = ("preroll", "midroll", "banner_top", "banner_side")

# --- fixed values: layout, pacing, erasure --------------------------------------------------
USER_BUCKETS = 16  # silver is partitioned by day and bucket(16, user_id)
AHEAD_AT = 1.05  # pace_index >= 1.05 -> "ahead"
BEHIND_AT = 0.95  # pace_index <= 0.95 -> "behind"; everything else (NULL too) -> "on_track"
USER_ID_PATTERN = r"\A[A-Za-z0-9_-]+\z"  # allow-list for ids handed to erasure (Java regex)
AMPLIFY = 10  # copies of silver in the layout study
BAD_LAYOUT_FILES = 500  # forced file count of the unpartitioned layout
MIN_INPUT_FILES = 2  # sort-compaction rewrites partitions holding at least this many files
SMALL_FILE_BYTES = 32 * 1024 * 1024  # files below this size count for compaction
TARGET_FILE_BYTES = 128 * 1024 * 1024  # compaction packs small files into files of about this size
SORT_KEYS = ("campaign_id", "event_ts")  # clustering order of the optimized layout
