import os
import sys
import tempfile
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from phenoscope.session import build_session

    s = build_session("local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="phenoscope-ckpt-"),
                             "spark.ui.showConsoleProgress": "false"})
    yield s
    s.stop()


def ts(text):
    """An instant from ISO text (UTC when no zone is given)."""
    d = datetime.fromisoformat(text)
    return d if d.tzinfo else d.replace(tzinfo=timezone.utc)


@pytest.fixture
def events(spark):
    """Build typed event tables from small literal lists."""

    def make(dx=(), med=(), lab=()):
        dx_df = spark.createDataFrame(
            [(p, ts(t), c) for p, t, c in dx], "patient_id string, ts timestamp, code string")
        med_df = spark.createDataFrame(
            [(p, ts(t), m) for p, t, m in med],
            "patient_id string, ts timestamp, medicine string")
        lab_df = spark.createDataFrame(
            [(p, ts(t), n, float(v)) for p, t, n, v in lab],
            "patient_id string, ts timestamp, test_name string, value double")
        return dx_df, med_df, lab_df

    return make
