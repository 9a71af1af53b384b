import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    conf = {}
    if not os.environ.get("SPARK_CHECKPOINT_SET"):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tessera-test-ckpt-")
    s = build_session("local[4]", 4, "tessera-tests", conf)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tessera-test-")


def rows(df, *cols):
    """Collect as plain tuples (optionally a column subset), sorted."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((v is None, v) for v in t))
