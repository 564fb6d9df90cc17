from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cartlens.session import build_session  # noqa: E402
from cartlens.sources import schemas as S  # noqa: E402

V, B = S.VIEW, S.BUY


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


# FIXTURES.md section 2: the hand-made session log.
SESSIONS_SMALL = [
    (1, ts("2021-11-05 10:00:00"), 102, 10, V, 0, None),
    (1, ts("2021-11-05 10:04:00"), 102, 11, V, 0, None),
    (1, ts("2021-11-05 10:06:30"), 102, 11, B, 0, 9001),
    (2, ts("2021-12-10 23:50:00"), 102, 10, V, 5, None),
    (2, ts("2021-12-12 00:10:00"), 102, 10, B, 5, 9002),
    (3, ts("2022-01-03 09:00:00"), 102, 12, B, 10, 9003),
    (4, ts("2021-11-20 12:00:00"), 103, 10, B, 0, 9004),
    (5, ts("2021-12-01 00:00:00"), 103, None, V, 5, None),
    (6, ts("2022-01-15 08:00:00"), None, 11, B, 0, 9005),
    (7, ts("2021-11-07 08:00:00"), 104, 12, V, 0, None),
    (8, ts("2022-01-09 14:00:00"), 104, 13, B, 15, 9006),
    (9, ts("2022-02-01 10:00:00"), 105, 10, V, 0, None),
    (9, ts("2022-02-01 10:30:00"), 105, 11, V, 10, None),
]
PRODUCTS_SMALL = [(10, 100.0), (11, 250.0), (12, 600.0), (13, -5.0)]


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="cartlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sessions(spark):
    return spark.createDataFrame(SESSIONS_SMALL, S.nullable(S.SESSIONS))


@pytest.fixture(scope="session")
def products(spark):
    return spark.createDataFrame(PRODUCTS_SMALL, S.PRODUCTS)


def rows(df, *cols, digits: int = 6):
    """Collect ``cols`` (default: all) as sorted tuples with floats rounded."""
    cols = cols or tuple(df.columns)
    out = []
    for r in df.select(*cols).collect():
        out.append(tuple(round(v, digits) if isinstance(v, float) else
                         (float(round(v, digits)) if hasattr(v, "as_tuple") else v) for v in r))
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t))
