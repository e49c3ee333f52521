import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sensorloom.session import build_session  # noqa: E402

T0 = datetime(2022, 5, 4, 12, 0, tzinfo=timezone.utc)
US0 = int(T0.timestamp() * 1_000_000)
MIN = 60_000_000


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.enabled": "false"},
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def at():
    """Micros at so many minutes from noon."""
    return lambda minutes: US0 + round(minutes * MIN)


@pytest.fixture(scope="session")
def moment():
    return lambda minutes: T0.replace(tzinfo=None) + timedelta(minutes=minutes)


@pytest.fixture(scope="session")
def make_meals(spark, at):
    def make(rows):
        """rows: (meal_id, user_id, minutes)"""
        return spark.createDataFrame([(m, u, at(t)) for m, u, t in rows], "meal_id long, user_id long, us long")

    return make


@pytest.fixture(scope="session")
def make_readings(spark, at):
    def make(rows):
        """rows: (user_id, minutes, value)"""
        return spark.createDataFrame(
            [(u, at(t), float(v), i) for i, (u, t, v) in enumerate(rows)],
            "user_id long, r_us long, r_value double, r_id long",
        )

    return make
