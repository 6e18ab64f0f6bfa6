import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark import session

    s = session.session("local[4]", 4)
    s.sparkContext.setLogLevel("OFF")
    session.ship(s)
    yield s
    s.stop()
