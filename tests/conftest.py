import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from rillflow.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    made = session("local[4]", 4)
    yield made
    made.stop()
