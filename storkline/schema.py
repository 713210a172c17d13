"""Column names, types and clinical limits shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw record. Names and types must match the incoming files.
RAW_TYPES: dict[str, T.DataType] = {
    "year_fix": T.IntegerType(),
    "month": T.IntegerType(),
    "day": T.IntegerType(),
    "weight_pounds": T.DoubleType(),
    "plurality": T.DoubleType(),
    "is_male": T.StringType(),
    "apgar_1min": T.DoubleType(),
    "apgar_5min": T.DoubleType(),
    "state": T.StringType(),
    "mother_residence_state": T.StringType(),
    "mother_birth_state": T.StringType(),
    "mother_age": T.DoubleType(),
    "mother_married": T.StringType(),
    "gestation_weeks": T.DoubleType(),
    "lmp": T.StringType(),
    "weight_gain_pounds": T.DoubleType(),
    "cigarette_use": T.StringType(),
    "cigarettes_per_day": T.DoubleType(),
    "alcohol_use": T.StringType(),
    "drinks_per_week": T.DoubleType(),
    "born_alive_alive": T.DoubleType(),
    "born_alive_dead": T.DoubleType(),
    "born_dead": T.DoubleType(),
    "ever_born": T.DoubleType(),
    "father_age": T.DoubleType(),
    "record_weight": T.IntegerType(),
}
RAW_COLUMNS = list(RAW_TYPES)
NUMERIC_RAW_COLUMNS = [c for c, t in RAW_TYPES.items() if not isinstance(t, T.StringType)]

# The five files and the era label of each.
ERA_FILES = {
    "newborn_1986": 1986,
    "newborn_1994": 1994,
    "newborn_2002": 2002,
    "newborn_2010": 2010,
    "newborn_2018": 2018,
}

# Texts that a CSV field uses for "missing".
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Cleaning rules.
LEAKAGE_COLUMNS = ["apgar_1min", "apgar_5min", "day"]
APGAR_COLUMNS = ["apgar_1min", "apgar_5min"]
BOOLEAN_COLUMNS = ["is_male", "mother_married", "cigarette_use", "alcohol_use"]
SENTINELS = {"father_age": [99], "gestation_weeks": [99], "plurality": [0]}
LMP_UNKNOWN = ["99", "9999", "nan", ""]
CLIP_RANGES = {"gestation_weeks": (20, 44), "mother_age": (10, 60)}
VALID_POUNDS = (0.66, 15.43)
VALID_GRAMS = (300.0, 7000.0)
GRAMS_PER_POUND = 453.592
KG_PER_POUND = 0.453592

# Feature rules.
PRETERM_BELOW = 37
POST_TERM_ABOVE = 41
MOTHER_AGE_EDGES = [0, 19, 29, 39, 120]
VLBW_GRAMS, LBW_GRAMS, MACROSOMIA_GRAMS = 1500.0, 2500.0, 4000.0
WEIGHT_CATEGORIES = ["VLBW", "LBW", "Normal", "Macrosomia"]
ENGINEERED_COLUMNS = [
    "weight_gain_kg", "parity", "is_multiple_birth", "lmp_known", "birth_month_sin",
    "birth_month_cos", "mother_age_group", "gestation_preterm", "gestation_post_term",
]

# The split by year.
SPLITS = ["train", "val", "test"]
VAL_START, TEST_START = 2010, 2016

# Model inputs.
TARGET = "weight_grams"
NUMERIC_FEATURES = [
    "gestation_weeks", "mother_age", "weight_gain_pounds", "born_alive_alive", "born_alive_dead",
    "born_dead", "ever_born", "father_age", "plurality", "parity", "year_fix", "month",
    "birth_month_sin", "birth_month_cos",
]
BINARY_FEATURES = [
    "is_male", "mother_married", "lmp_known", "is_multiple_birth", "gestation_preterm",
    "gestation_post_term", "mother_age_group",
]
MODEL_FEATURES = NUMERIC_FEATURES + BINARY_FEATURES
NON_FEATURE_COLUMNS = [
    "weight_pounds", "weight_grams", "outlier_weight", "source_year", "source_file", "lmp",
]

# Columns used by the profiling reports.
CORRELATION_COLUMNS = [
    "weight_grams", "gestation_weeks", "mother_age", "weight_gain_pounds", "father_age",
    "plurality", "born_alive_alive", "ever_born", "is_male", "mother_married", "parity",
]
KEY_MISSING_COLUMNS = [
    "weight_pounds", "gestation_weeks", "weight_gain_pounds", "father_age", "alcohol_use",
    "cigarette_use",
]
REQUIRED_COLUMNS = [
    "weight_grams", "weight_pounds", "gestation_weeks", "mother_age", "is_male", "plurality",
    "year_fix", "month", "source_year", "source_file",
]

# Acceptance thresholds, metric -> (comparison, bound).
ACCEPTANCE = {
    "mae": ("<", 300.0),
    "r2": (">", 0.70),
    "sensitivity": (">", 0.85),
    "specificity": (">", 0.60),
}
