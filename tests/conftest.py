import os
import sys
import tempfile

import pytest

from sw_paths import ROOT

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    # tests only: a local checkpoint folder when the session names none
    os.environ.setdefault("SCOREWRIGHT_CHECKPOINT_DIR", tempfile.mkdtemp(prefix="sw-test-ckpt-"))
    from scorewright.session import get_session
    s = get_session("local[4]", app="scorewright-tests", shuffle_partitions=8, driver_memory="8g")
    yield s
