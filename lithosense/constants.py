"""Fixed values.

Everything in this module is a given of the monitored installation or of the
published model set-up (identifiers, names, thresholds, patterns).  They are
inputs, not logic, and are listed in their natural order.
"""

# --- fixed values: temperature sensor identifiers -------------------------
TEMPERATURE_SENSORS = (
    "TEMPS-02-1", "TEMPS-01-1", "TEMPS-02-2", "TEMPS-01-2", "TEMPS-02-3", "TEMPS-01-3",
    "TM-BA-01", "TM-BA-02", "TM-SB-03", "TM-SB-04", "TM-SB-05", "TM-SG-06", "TM-SG-07",
)

# --- fixed values: words that mark a temperature channel when no id matches
TEMPERATURE_KEYWORDS = ("temp", "temperature", "tm", "temps")

# --- fixed values: station metrics -----------------------------------------
WEATHER_METRICS = (
    "temperature", "dew_point", "pressure_station", "pressure_sea", "wind_speed", "wind_gust",
    "relative_humidity", "windchill", "humidex", "visibility", "solar_radiation",
)

# --- fixed values: sensor placement (id, depth in mm, layer, location) -------
SENSOR_PLACEMENT = (
    ("TEMPS-02-1", 72.7, "ASPHALT", "right array"),
    ("TEMPS-01-1", 72.7, "ASPHALT", "left array"),
    ("TEMPS-02-2", 145.4, "ASPHALT", "right array"),
    ("TEMPS-01-2", 145.4, "ASPHALT", "left array"),
    ("TEMPS-02-3", 195.0, "ASPHALT", "right array"),
    ("TEMPS-01-3", 195.0, "ASPHALT", "left array"),
    ("TM-BA-01", 245.0, "BASE", "center"),
    ("TM-BA-02", 295.0, "BASE", "center"),
    ("TM-SB-03", 395.0, "SUBBASE", "center"),
    ("TM-SB-04", 495.0, "SUBBASE", "center"),
    ("TM-SB-05", 595.0, "SUBBASE", "center"),
    ("TM-SG-06", 695.0, "SUBGRADE", "center"),
    ("TM-SG-07", 745.0, "SUBGRADE", "center"),
)

# --- fixed values: thresholds and marks ------------------------------------
ZERO_THRESHOLD = 0.001
LAYERS = ("ASPHALT", "BASE", "SUBBASE", "SUBGRADE")
EPOCH_MARK = "2000-01-01 00:00:00"
LEVELS = ("15min", "hourly", "daily", "weekly")
SECONDS_PER_SAMPLE = 10

# --- fixed values: date patterns in acquisition file names, by priority ------
# (pattern, group number of year, month, day)
FILE_DATE_PATTERNS = (
    (r"Waterloo_.*?_(\d{2})_(\d{2})_(\d{4})_", 3, 1, 2),
    (r"(\d{4})[-_](\d{1,2})[-_](\d{1,2})", 1, 2, 3),
    (r"(\d{1,2})[-_](\d{1,2})[-_](\d{4})", 3, 1, 2),
)
STATION_TIME_PATTERN = r'^"?(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})'

# --- fixed values: enumerations declared by the warehouse schema ------------
ENUMS = {
    "sensor_type": ("TEMPERATURE", "STRAIN", "PRESSURE", "MOISTURE", "WEATHER"),
    "orientation": ("LONGITUDINAL", "TRANSVERSE", "VERTICAL", "N/A"),
    "wheel_path": ("RIGHT", "LEFT", "N/A"),
    "layer_type": ("ASPHALT", "BASE", "SUBBASE", "SUBGRADE", "AIR", "N/A"),
    "job_status": ("SUCCESS", "FAILED", "RUNNING"),
    "archive_status": ("COMPLETED", "FAILED", "PARTIAL"),
    "health_status": ("GOOD", "WARNING", "CRITICAL", "OFFLINE"),
}

# --- fixed values: section-year table --------------------------------------
SECTION_KEYS = ("STATE_CODE", "SHRP_ID", "YEAR")
TARGET = "MAX_MEAN_DEPTH_1_8"
FEATURES = (
    "CONSTRUCTION_NO", "ANL_KESAL_LTPP_LN_YR", "TOTAL_ANN_PRECIP", "FREEZE_INDEX_YR",
    "MAX_ANN_TEMP_AVG", "MAX_ANN_TEMP_DAYS", "DAYS_ABOVE_32_C_YR", "MR_MATL_TYPE",
    "RES_MOD_AVG", "REPR_THICKNESS",
)
SECTION_TABLE_COLUMNS = (
    "STATE_CODE", "SHRP_ID", "YEAR", "CONSTRUCTION_NO", "MAX_MEAN_DEPTH_1_8",
    "ANL_KESAL_LTPP_LN_YR", "TOTAL_ANN_PRECIP", "FREEZE_INDEX_YR", "MAX_ANN_TEMP_AVG",
    "MAX_ANN_TEMP_DAYS", "DAYS_ABOVE_32_C_YR", "MR_MATL_TYPE", "RES_MOD_AVG", "REPR_THICKNESS",
)
CLIMATE_TRAFFIC_COLUMNS = (
    "STATE_CODE", "SHRP_ID", "YEAR", "CONSTRUCTION_NO", "MAX_MEAN_DEPTH_1_8",
    "ANL_KESAL_LTPP_LN_YR", "TOTAL_ANN_PRECIP", "FREEZE_INDEX_YR", "MAX_ANN_TEMP_AVG",
    "MAX_ANN_TEMP_DAYS", "DAYS_ABOVE_32_C_YR", "AADT_ALL_VEHIC_2WAY", "AADT_TRUCK_COMBO_2WAY",
    "AADT_ALL_VEHIC", "AADT_TRUCK_COMBO",
)

# --- fixed values: published model settings ---------------------------------
FOREST_SMALL = {"trees": 5, "depth": 22, "subset": 8, "leaf": 4}
FOREST_TUNED = {"trees": 45, "depth": 30, "subset": 5, "leaf": 3}
RATIO_EPSILON = 1e-6
SEED = 42
