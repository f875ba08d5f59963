from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from eventmart.session import build_session

    session = build_session(
        "local[4]",
        app_name="eventmart-tests",
        shuffle_partitions=4,
        conf={"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    # Tests own their checkpoint folder only when the session has none.
    if not session.sparkContext.getCheckpointDir() and not session.conf.get(
            "spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive assertions."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple(
        (x is None, str(x)) for x in t))
