import os
import sys

import pytest

_REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, _REPO)
# Python workers import the package too, from wherever the tests are started
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [_REPO, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from hydrolake import get_session

    session = get_session("tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
