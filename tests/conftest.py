import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from vidsift.session import build_session, ship

    session = ship(build_session("tests", cores="4", shuffle_partitions=4, **{"spark.driver.memory": os.environ.get("VIDSIFT_DRIVER_MEMORY", "4g")}))
    yield session
    session.stop()
