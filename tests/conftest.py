import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from oddspend.session import local_session

    s = local_session(cpus=8, partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    return s
