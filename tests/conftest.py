import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path[:0] = [ROOT, str(Path(__file__).parent)]
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallymark.session import session

    s = session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
