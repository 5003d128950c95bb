import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ecoledger.session import get_session  # noqa: E402

# The two small island polygons, lon/lat.
ALPINE = [
    [-0.005, 0.012], [0.003, 0.015], [0.010, 0.012], [0.013, 0.005], [0.011, -0.003],
    [0.005, -0.007], [-0.003, -0.005], [-0.008, 0.001], [-0.007, 0.008],
]
WATER_BOX = [[-0.06, -0.05], [0.06, -0.05], [0.06, 0.05], [-0.06, 0.05]]

FEATURE_SCHEMA = (
    "fid bigint, code string, name string, fg string, src_ordinal bigint, "
    "geometry array<array<array<array<double>>>>"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "ecoledger-tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_features(spark):
    """Features from (code, [rings of one polygon]) or (code, parts) when deeper."""

    def build(*polygons):
        rows = []
        for n, (code, rings) in enumerate(polygons):
            deep = isinstance(rings[0][0][0], list)
            rows.append((n, code, f"name {code}", None, n, rings if deep else [rings]))
        return spark.createDataFrame(rows, FEATURE_SCHEMA)

    return build


@pytest.fixture(scope="session")
def island(make_features):
    """The alpine patch and a water box that surrounds it."""
    return make_features(("T6.5.1", [ALPINE + ALPINE[:1]]), ("M1.1.1", [WATER_BOX, ALPINE]))
