import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tripflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tripflow-tests", master="local[4]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (or all columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
