import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))
os.environ.setdefault("PYTHONPATH", str(ROOT))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from foroscope.session import build_session

    session = build_session("local[8]", "tests", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                            spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
                            spark__checkpoint__dir=tempfile.mkdtemp(prefix="checkpoints-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
