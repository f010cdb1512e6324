import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paths import ROOT  # noqa: E402

sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from lendlens.session import get_spark
    s = get_spark("local[4]", 8, extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lendlens-wh-")})
    yield s
    s.stop()
