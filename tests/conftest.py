import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tripweave import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SMALL


TRIP_TYPES = (
    "id string, vendor_id int, pickup_datetime timestamp_ntz, passenger_count int, pickup_longitude double, "
    "pickup_latitude double, dropoff_longitude double, dropoff_latitude double, store_and_fwd_flag string, trip_duration int"
)


@pytest.fixture
def trip_frame(spark):
    """Trips from partial dictionaries; what is not given is an ordinary trip."""
    import datetime

    def make(*rows):
        usual = dict(
            vendor_id=1, pickup_datetime=datetime.datetime(2024, 1, 1, 8, 30), passenger_count=1,
            pickup_longitude=-73.98, pickup_latitude=40.75, dropoff_longitude=-73.95, dropoff_latitude=40.78,
            store_and_fwd_flag="N", trip_duration=600,
        )
        names = [part.split()[0] for part in TRIP_TYPES.split(", ")]
        full = [dict(usual, id=f"t{i}") | row for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in full], TRIP_TYPES)

    return make
