"""Thresholds, bounds and names. All are defaults of function parameters."""

# They must be equal to the source system's for equal results.
MIN_DURATION_S = 60
MAX_DURATION_S = 7200
MAX_ANOMALY_DURATION_S = 10800
MAX_PASSENGERS = 9
LAT_MIN, LAT_MAX = 40.4, 41.0
LON_MIN, LON_MAX = -74.3, -73.7
MAP_LAT_MIN, MAP_LAT_MAX = 40.5, 41.0
EARTH_RADIUS_KM = 6371
WEEKEND_DAYS = [5, 6]
RUSH_HOURS = [7, 8, 9, 17, 18, 19]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
VENDOR_LABELS = {1: "Vendor 1", 2: "Vendor 2"}

QUALITY_THRESHOLD = 0.95
MODEL_R2_THRESHOLD = 0.7
RECONCILE_MAX_DIFF_PCT = 10
MAX_CONSUMER_LAG = 1000
MAX_DATA_AGE_MINUTES = 10
MIN_THROUGHPUT_PER_MINUTE = 10
RECORD_QUALITY_THRESHOLD = 0.9
PRODUCER_ACTIVE_SECONDS = 300
RETENTION_HOURS = 24

RECENT_FILES = 50
QUALITY_FILES = 5
QUALITY_SAMPLE = 100
REPLAY_BATCH = 50
CONSUMER_BATCH = 10
PUBLISH_LIMIT = 5000
SCATTER_LIMIT = 100
LATEST_TRIPS = 10
TRIGGER = "10 seconds"
