import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tableworks.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_driver_memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from tableworks.plans.catalog import Tables

    return Tables(spark, DATA)


def rows(df, *order):
    """Rows as sorted tuples, floats cut to 9 significant digits for sorting."""
    return Rows(sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=_key))


def _key(row):
    return repr(tuple(float(f"{v:.7g}") if isinstance(v, float) else v for v in row))


class Rows(list):
    """A list of rows whose floats compare with a relative tolerance."""

    def __eq__(self, other):
        if len(self) != len(other):
            return False
        for a, b in zip(self, other):
            for x, y in zip(a, b):
                if isinstance(x, float) and isinstance(y, float):
                    if abs(x - y) > 1e-7 * max(1.0, abs(x), abs(y)):
                        return False
                elif x != y:
                    return False
        return True
