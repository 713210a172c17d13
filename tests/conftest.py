import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from storkline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RAW_DDL = (
    "year_fix int, month int, day int, weight_pounds double, plurality double, is_male string, "
    "mother_married string, apgar_1min double, apgar_5min double, mother_age double, "
    "gestation_weeks double, lmp string, weight_gain_pounds double, born_alive_alive double, "
    "born_alive_dead double, born_dead double, ever_born double, father_age double, "
    "record_weight int, state string, mother_residence_state string, mother_birth_state string, "
    "cigarette_use string, cigarettes_per_day double, alcohol_use string, drinks_per_week double"
)
# one record on each side of the edges that cleaning and features care about; the third has no target
RAW_ROWS = [
    (1988, 12, 31, 6.3, 3.0, " TRUE", "no", 3.0, 7.0, 19.0, 36.0, "99999999", 41.0, 0.0, 2.0, None, 2.0, 98.0, 2, "OR", "NV", "PR"),
    (2009, 2, 1, 9.25, None, "False", "TRUE", 10.0, 10.0, 20.0, 42.0, "12242008", 0.0, None, None, None, None, None, 1, "ME", "ME", None),
    (1995, 7, 4, None, 2.0, "true", "true", None, None, 61.0, 18.0, " 99 ", 12.0, 1.0, 1.0, 1.0, 3.0, 99.0, 1, "GA", "GA", "GA"),
    (2015, 9, 30, 3.3, 1.0, "x", "false", 1.0, 2.0, 39.0, 37.0, "", 97.0, 6.0, 0.0, 3.0, 9.0, 99.0, 1, "UT", "ID", "UT"),
    (2021, 4, 11, 11.0, 1.0, "false", " true ", 9.0, 8.0, 60.0, 41.0, "07042020", 33.0, 1.0, 0.0, 0.0, 1.0, 52.0, 2, "VT", "VT", "CN"),
]


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame([(*r, None, None, None, None) for r in RAW_ROWS], RAW_DDL)


@pytest.fixture(scope="session")
def features_frame(spark, raw):
    from storkline.operators.clean import run_preprocessing
    from storkline.operators.features import engineer_features

    return engineer_features(run_preprocessing(raw))


def values(df, column):
    return [r[0] for r in df.select(column).collect()]
