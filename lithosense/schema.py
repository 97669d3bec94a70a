"""Schemas of the canonical tables, as Spark DDL strings."""

READING = "timestamp TIMESTAMP_NTZ, series_id STRING, value DOUBLE"
CHANNEL_SAMPLE = "file STRING, grp STRING, channel STRING, idx BIGINT, value STRING"
CHANNEL_META = (
    "file STRING, grp STRING, channel STRING, ordinal INT, n BIGINT, "
    "props MAP<STRING, STRING>, modified TIMESTAMP"
)
_STATS = "mean DOUBLE, min DOUBLE, max DOUBLE, std DOUBLE, count BIGINT"
ROLLUP = {
    "15min": f"timestamp TIMESTAMP_NTZ, series_id STRING, {_STATS}",
    "hourly": f"timestamp TIMESTAMP_NTZ, series_id STRING, {_STATS}",
    "daily": f"date DATE, series_id STRING, {_STATS}, temp_range DOUBLE",
    "weekly": f"week_start DATE, week_end DATE, series_id STRING, {_STATS}, temp_range DOUBLE",
}
# Time axis of each level.
AXIS = {"15min": "timestamp", "hourly": "timestamp", "daily": "date", "weekly": "week_start"}
SENSOR_DIM = (
    "sensor_id STRING, sensor_type STRING, description STRING, units STRING, "
    "depth DOUBLE, layer STRING, location STRING"
)
PROCESSING_STATE = (
    "status_type STRING, last_run TIMESTAMP_NTZ, last_processed TIMESTAMP_NTZ, "
    "status STRING, message STRING"
)
ARCHIVE_INFO = (
    "interval_start DATE, interval_end DATE, path STRING, file_size BIGINT, "
    "rows BIGINT, status STRING"
)
SECTION_TABLES = {
    "precip": "SHRP_ID STRING, STATE_CODE INT, YEAR INT, TOTAL_ANN_PRECIP DOUBLE",
    "temp": (
        "SHRP_ID STRING, STATE_CODE INT, YEAR INT, FREEZE_INDEX_YR DOUBLE, MEAN_ANN_TEMP_AVG DOUBLE, "
        "MAX_ANN_TEMP_AVG DOUBLE, MAX_ANN_TEMP_DAYS DOUBLE, DAYS_ABOVE_32_C_YR DOUBLE"
    ),
    "traffic_hist": (
        "STATE_CODE INT, SHRP_ID STRING, YEAR_HIST_EST INT, ANL_KESAL_LTPP_LN_YR DOUBLE, "
        "AADT_ALL_VEHIC_2WAY DOUBLE, AADT_TRUCK_COMBO_2WAY DOUBLE"
    ),
    "traffic_mon": (
        "STATE_CODE INT, SHRP_ID STRING, YEAR_MON_EST INT, ANL_KESAL_LTPP_LN_YR DOUBLE, "
        "AADT_ALL_VEHIC DOUBLE, AADT_TRUCK_COMBO DOUBLE"
    ),
    "section_survey": (
        "STATE_CODE INT, SHRP_ID STRING, CONSTRUCTION_NO INT, SURVEY_DATE STRING, MAX_MEAN_DEPTH_1_8 DOUBLE"
    ),
    "lab_test": (
        "STATE_CODE INT, SHRP_ID STRING, CONSTRUCTION_NO INT, TEST_DATE STRING, LAYER_TYPE INT, "
        "RES_MOD_AVG DOUBLE, MR_MATL_TYPE INT, MR_MATL_TYPE_EXP STRING"
    ),
    "layer_thickness": (
        "SHRP_ID STRING, STATE_CODE INT, CONSTRUCTION_NO INT, LAYER_NO INT, MATL_CODE_EXP STRING, "
        "REPR_THICKNESS DOUBLE"
    ),
}
