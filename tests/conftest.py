import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.session import build_session, scratch_path  # noqa: E402

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    extra = {}
    # Tests set their own shared folder only when the environment names none.
    if not os.environ.get("SPARK_CONF_DIR") and not _conf_has_checkpoint():
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="sluice-test-ckpt-")
    s = build_session("local[4]", "sluice-tests", 8, extra)
    yield s


def _conf_has_checkpoint() -> bool:
    from pyspark import SparkConf
    return bool(SparkConf().get("spark.checkpoint.dir", None))


@pytest.fixture
def scratch(spark):
    def make(name="t"):
        return scratch_path(spark, name)
    return make


def local_path(uri: str) -> str:
    return uri[len("file:"):] if uri.startswith("file:") else uri


def write_text_files(folder: str, files: dict[str, str]) -> list[str]:
    """Plain local writes for small unit fixtures (tests run in local mode)."""
    base = local_path(folder)
    os.makedirs(base, exist_ok=True)
    out = []
    for name, text in files.items():
        p = os.path.join(base, name)
        with open(p, "w", encoding="utf-8", newline="") as f:
            f.write(text)
        out.append(p)
    return out
