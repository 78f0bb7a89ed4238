import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"

from signalframe.session import local_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", 4, "6g")
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")  # small batches: groups cross them
    yield s


def rows(df, *columns):
    """Rows as sorted tuples; nulls first."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=lambda r: [(x is not None, x) for x in r])
