"""Column names, schemas and the fixed values every module shares."""

from pyspark.sql import types as T

# --- Fixed values: these define the results and must not be tuned ------------

DATASETS = ("FD001", "FD002", "FD003", "FD004")

DANGER_BELOW = 30  # remaining cycles
WARNING_BELOW = 80
RUL_CAP = 125

SHORT_LIFE_BELOW = 150  # cycles
NORMAL_LIFE_BELOW = 250
LIFE_LABELS = ("Short Life (Under 150)", "Normal Life (150-250)", "Long Life (Over 250)")

EARLY_CYCLES = 50
LATE_CYCLES = 50
ROLLING_ROWS = 20
LATE_LIFE_RATIO = 0.9
CONSTANT_BELOW_STD = 0.001
BREACH_SIGMAS = 1.5

KEY_SENSORS = ("sensor_2", "sensor_7", "sensor_11", "sensor_12")
PROFILE_SENSORS = ("sensor_2", "sensor_7", "sensor_11", "sensor_12", "sensor_15")
TREND_SENSORS = ("sensor_2", "sensor_7", "sensor_11", "sensor_12", "sensor_15", "sensor_20")
BREACH_SENSORS = ("sensor_7", "sensor_11")

ALERT_MESSAGE = "IMMEDIATE MAINTENANCE REQUIRED"
ACTIONS = {
    "DANGER": "Ground engine. Schedule immediate inspection.",
    "WARNING": "Plan maintenance within 2 weeks.",
    "HEALTHY": "Continue monitoring. No action needed.",
}

RUL_BIN_EDGES = (0, 15, 30, 45, 60, 80, 100, 120, 999)
LIFESPAN_BIN_START = 125
LIFESPAN_BIN_WIDTH = 25
LIFE_STAGES = 5
CORRELATION_BANDS = ((0.65, "strong"), (0.55, "good"), (0.40, "fair"))

TEST_SHARE = 0.2
SPLIT_SEED = 42
FOREST_TREES = 100
FOREST_DEPTH = 15
FOREST_MIN_LEAF = 5
ISOLATION_TREES = 100
ISOLATION_ROWS = 256
CONTAMINATION = 0.05

MODEL_FEATURES = (
    "sensor_2_rolling_avg",
    "sensor_7_rolling_avg",
    "sensor_11_rolling_avg",
    "sensor_12_rolling_avg",
    "sensor_2_rolling_std",
    "sensor_7_rolling_std",
    "sensor_11_rolling_std",
    "sensor_12_rolling_std",
    "sensor_3",
    "sensor_4",
    "sensor_8",
    "sensor_9",
    "sensor_13",
    "sensor_14",
    "sensor_15",
    "sensor_17",
    "sensor_20",
    "sensor_21",
    "op_setting_1",
    "op_setting_2",
    "op_setting_3",
    "cycle_ratio",
)

# position, column, description, unit
COLUMN_CATALOG = (
    (1, "engine_id", "Unit number, unique within its data set", None),
    (2, "cycle", "Operating cycles the unit has completed", None),
    (3, "op_setting_1", "Operational setting 1", None),
    (4, "op_setting_2", "Operational setting 2", None),
    (5, "op_setting_3", "Operational setting 3", None),
    (6, "sensor_1", "Fan inlet temperature", "°R"),
    (7, "sensor_2", "LPC outlet temperature", "°R"),
    (8, "sensor_3", "HPC outlet temperature", "°R"),
    (9, "sensor_4", "LPT outlet temperature", "°R"),
    (10, "sensor_5", "Fan inlet pressure", "psia"),
    (11, "sensor_6", "Bypass-duct pressure", "psia"),
    (12, "sensor_7", "HPC outlet pressure", "psia"),
    (13, "sensor_8", "Physical fan speed", "rpm"),
    (14, "sensor_9", "Physical core speed", "rpm"),
    (15, "sensor_10", "Engine pressure ratio", "EPR"),
    (16, "sensor_11", "HPC outlet static pressure", "psia"),
    (17, "sensor_12", "Fuel flow ratio", "pps/psia"),
    (18, "sensor_13", "Corrected fan speed", "rpm"),
    (19, "sensor_14", "Corrected core speed", "rpm"),
    (20, "sensor_15", "Bypass ratio", None),
    (21, "sensor_16", "Burner fuel-air ratio", None),
    (22, "sensor_17", "Bleed enthalpy", None),
    (23, "sensor_18", "Demanded fan speed", "rpm"),
    (24, "sensor_19", "Demanded corrected fan speed", "rpm"),
    (25, "sensor_20", "HPT coolant bleed", "lbm/s"),
    (26, "sensor_21", "LPT coolant bleed", "lbm/s"),
)

# --- Derived names and schemas -----------------------------------------------

KEYS = ["dataset", "engine_id"]
SETTINGS = [f"op_setting_{i}" for i in range(1, 4)]
SENSORS = [f"sensor_{i}" for i in range(1, 22)]
RAW_COLUMNS = ["engine_id", "cycle", *SETTINGS, *SENSORS]

_INT_COLUMNS = {"engine_id", "cycle"}

RAW_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            T.IntegerType() if name in _INT_COLUMNS else T.DoubleType(),
            True,
            {"position": position, "comment": text, **({"unit": unit} if unit else {})},
        )
        for position, name, text, unit in COLUMN_CATALOG
    ]
)
READING_SCHEMA = T.StructType([T.StructField("dataset", T.StringType()), *RAW_SCHEMA.fields])
ENGINE_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("engine_id", T.IntegerType()),
        T.StructField("max_cycle", T.IntegerType()),
    ]
)
LABEL_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("engine_id", T.IntegerType()),
        T.StructField("true_rul", T.IntegerType()),
    ]
)
FEATURE_SCHEMA = T.StructType(
    [
        *READING_SCHEMA.fields,
        T.StructField("max_cycle", T.IntegerType()),
        T.StructField("RUL", T.IntegerType()),
        *[T.StructField(f"{s}_rolling_avg", T.DoubleType()) for s in KEY_SENSORS],
        *[T.StructField(f"{s}_rolling_std", T.DoubleType()) for s in KEY_SENSORS],
        T.StructField("cycle_ratio", T.DoubleType()),
        T.StructField("RUL_capped", T.IntegerType()),
    ]
)
SERVING_COLUMNS = ["dataset", "engine_id", "cycle", *KEY_SENSORS, "rul_capped", "is_anomaly", "cycle_ratio"]
