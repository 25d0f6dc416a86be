"""Table schemas and the fixed domain values the pipeline depends on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source project's for identical results)
# ---------------------------------------------------------------------------

# CSV header -> column name. "Class" maps to booking_class; "Seasonality" gets
# its own column (the source mapped both headers onto booking_class).
CSV_HEADER_MAP = {
    "Airline": "airline",
    "Source": "source",
    "Destination": "destination",
    "Departure Date & Time": "departure_time",
    "Arrival Date & Time": "arrival_time",
    "Duration (hrs)": "duration",
    "Stopovers": "stops",
    "Base Fare (BDT)": "base_fare",
    "Tax & Surcharge (BDT)": "tax_and_surcharge",
    "Total Fare (BDT)": "total_fare",
    "Seasonality": "seasonality",
    "Class": "booking_class",
}

# Columns the raw landing table keeps (tolerant projection: missing ones are skipped).
RAW_COLUMNS = [
    "airline", "source", "destination", "departure_time", "arrival_time",
    "duration", "stops", "aircraft_type", "booking_class", "booking_source",
    "days_before_departure", "seasonality", "base_fare", "tax_and_surcharge",
    "total_fare",
]

# Business columns that must be present and non-null after cleaning.
REQUIRED_COLUMNS = [
    "airline", "source", "destination",
    "base_fare", "tax_and_surcharge", "total_fare",
]

# Valid city names.
VALID_CITIES = [
    "Dhaka", "Chittagong", "Sylhet", "Cox's Bazar",
    "Jessore", "Barisal", "Rajshahi", "Comilla",
    "Saidpur", "Jashore",
]

# Peak seasons in priority order; each window is (month_start, day_start,
# month_end, day_end). A date in several windows takes the first label.
PEAK_SEASONS = [
    ("Eid al-Fitr", [(4, 19, 4, 26), (4, 8, 4, 15)]),
    ("Eid al-Adha", [(6, 26, 7, 3), (6, 15, 6, 22)]),
    ("Winter Holidays", [(12, 20, 12, 31), (1, 1, 1, 5)]),
    ("Pohela Boishakh", [(4, 12, 4, 16)]),
]
OFF_PEAK_LABEL = "Regular"

# Months the SQL seasonal mart calls 'Peak'.
PEAK_MONTHS = [4, 6, 12]

# Default number of routes in the popular-routes KPI.
TOP_N_ROUTES = 20

# Stopover text -> ordinal.
STOPS_ORDINAL = {"Direct": 0, "1 Stop": 1, "2 Stops": 2}

# Flights longer than this many hours count as international.
INTERNATIONAL_HOURS = 3.5
LONG_HAUL_HOURS = 8
LAST_MINUTE_DAYS = 7
EARLY_BOOKING_DAYS = 30

# Scoring vocabularies (label codes are positions in sorted order).
AIRLINES = [
    "Air Arabia", "Air Astra", "Air India", "AirAsia",
    "Biman Bangladesh Airlines", "British Airways", "Cathay Pacific",
    "Emirates", "Etihad Airways", "FlyDubai", "Gulf Air", "IndiGo",
    "Kuwait Airways", "Lufthansa", "Malaysian Airlines", "NovoAir",
    "Qatar Airways", "Saudia", "Singapore Airlines", "SriLankan Airlines",
    "Thai Airways", "Turkish Airlines", "US-Bangla Airlines", "Vistara",
]
AIRPORT_CITIES = {
    "BZL": "Barisal", "CGP": "Chittagong", "CXB": "Cox's Bazar",
    "DAC": "Dhaka", "JSR": "Jessore", "RJH": "Rajshahi",
    "SPD": "Saidpur", "ZYL": "Sylhet",
}
DESTINATIONS = [
    "BKK", "CCU", "CGP", "DAC", "DEL", "DXB", "JED", "JFK",
    "KUL", "KWI", "LHR", "MLE", "RJH", "SIN", "SPD",
    "TBS", "TUL", "YYZ", "ZYL", "CMB",
]
CLASSES = ["Business", "Economy", "First Class"]
BOOKING_SOURCES = ["Direct Booking", "Online Website", "Travel Agency"]
SEASONALITY = ["Regular", "Eid", "Hajj", "Winter Holidays"]

# Season fare multipliers shown next to a prediction.
SEASON_MULTIPLIERS = {"Regular": 1.0, "Winter Holidays": 1.17, "Eid": 1.34, "Hajj": 1.43}

# Model features: categoricals, then numerics; target is log1p(total fare).
CAT_FEATURES = ["airline", "source", "destination", "class", "booking_source", "seasonality"]
NUM_FEATURES = [
    "duration_hrs", "days_before_departure", "stopovers", "departure_hour",
    "departure_day", "departure_month", "departure_weekday", "arrival_hour",
    "is_international",
]
TARGET = "total_fare"
SEED = 42
TEST_FRACTION = 0.2
CV_FOLDS = 5

# Boosted-tree search space (randomised search draws TUNING_DRAWS of these).
GBT_SEARCH_SPACE = {
    "n_estimators": [100, 200, 300],
    "max_depth": [4, 6, 8],
    "learning_rate": [0.01, 0.05, 0.1],
    "subsample": [0.8, 1.0],
    "colsample_bytree": [0.8, 1.0],
    "reg_alpha": [0.0, 0.1, 0.5],
    "reg_lambda": [0.5, 1.0, 2.0],
}
TUNING_DRAWS = 20

# Outlier fence multiplier used by the profile (1.5 is what the notebook applies).
IQR_FENCE = 1.5
HISTOGRAM_BINS = 60

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

FARE = T.DecimalType(12, 2)

# Raw CSV as read (before renaming): strings for times, lenient numerics.
RAW_CSV_SCHEMA = T.StructType([
    T.StructField("Airline", T.StringType()),
    T.StructField("Source", T.StringType()),
    T.StructField("Source Name", T.StringType()),
    T.StructField("Destination", T.StringType()),
    T.StructField("Destination Name", T.StringType()),
    T.StructField("Departure Date & Time", T.StringType()),
    T.StructField("Arrival Date & Time", T.StringType()),
    T.StructField("Duration (hrs)", T.StringType()),
    T.StructField("Stopovers", T.StringType()),
    T.StructField("Aircraft Type", T.StringType()),
    T.StructField("Class", T.StringType()),
    T.StructField("Booking Source", T.StringType()),
    T.StructField("Base Fare (BDT)", T.StringType()),
    T.StructField("Tax & Surcharge (BDT)", T.StringType()),
    T.StructField("Total Fare (BDT)", T.StringType()),
    T.StructField("Seasonality", T.StringType()),
    T.StructField("Days Before Departure", T.StringType()),
])

# Landing table (all nullable so bad rows are kept, not rejected).
RAW_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("airline", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("destination", T.StringType()),
    T.StructField("departure_time", T.TimestampNTZType()),
    T.StructField("arrival_time", T.TimestampNTZType()),
    T.StructField("duration", T.DoubleType()),
    T.StructField("stops", T.StringType()),
    T.StructField("aircraft_type", T.StringType()),
    T.StructField("booking_class", T.StringType()),
    T.StructField("booking_source", T.StringType()),
    T.StructField("days_before_departure", T.LongType()),
    T.StructField("seasonality", T.StringType()),
    T.StructField("base_fare", FARE),
    T.StructField("tax_and_surcharge", FARE),
    T.StructField("total_fare", FARE),
    T.StructField("load_timestamp", T.TimestampType()),
    T.StructField("pipeline_run_id", T.StringType()),
])

VALIDATED_COLUMNS = [
    "raw_id", "airline", "source", "destination", "departure_time",
    "arrival_time", "duration", "duration_minutes", "stops", "aircraft_type",
    "booking_class", "booking_source", "days_before_departure", "seasonality",
    "base_fare", "tax_and_surcharge", "total_fare", "travel_date",
    "is_peak_season", "season_label", "validation_status", "validation_notes",
    "pipeline_run_id",
]

AUDIT_SCHEMA = T.StructType([
    T.StructField("pipeline_run_id", T.StringType()),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("check_result", T.StringType(), False),
    T.StructField("records_checked", T.LongType()),
    T.StructField("records_failed", T.LongType()),
    T.StructField("details", T.StringType()),
])

LEADERBOARD_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("cv_r2", T.DoubleType()),
    T.StructField("cv_std", T.DoubleType()),
])
