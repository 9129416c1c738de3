import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import callables defined in test modules (e.g. a labeller passed to mapInPandas).
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tests")] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sprout.session import get_spark

    s = get_spark("local[4]", 4, app="sprout-tests")
    # Tests own their session, so they may set the shared folder (a cluster names it in its own conf).
    if not s.conf.get("spark.checkpoint.dir", None):
        d = str(tmp_path_factory.mktemp("ckpt"))
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.isdir(SF_SMALL):
        pytest.skip("driver test data not present")
    return SF_SMALL
