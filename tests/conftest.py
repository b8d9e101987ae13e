import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from playtide.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("8", "tests", partitions=4, **{"spark.checkpoint.dir": shared})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def silver(spark):
    from playtide.sources.adapters import read_silver_events

    return read_silver_events(spark, SF)


EVENT = (
    "userId string, ts long, sessionId long, page string, level string, gender string, itemInSession long, "
    "location string, userAgent string, registration long, artist string, song string"
)


@pytest.fixture(scope="session")
def events(spark):
    """Builds raw events from dictionaries; left-out fields are null."""
    names = [part.strip().split(" ")[0] for part in EVENT.split(",")]

    def build(*rows):
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], EVENT)

    return build
