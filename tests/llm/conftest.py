import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, slot int, n bigint"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    from lendlens.session import get_spark
    return get_spark("local[4]", 4, extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lendlens-wh-")})


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing extra columns."""
    from lendlens.llm.shipping import ship
    ship(spark)
    long = " ".join(f"w{i % 97}x{i % 89}" for i in range(6000))
    passage = "\n".join(f"line {i} of the shared passage" for i in range(12))
    texts = [None, "", "  \n ", "The cat sat on the mat today", "the cat sat on the mat today", "The cat sat on the mat today", long,
             long + " tail", "mail a@b.co and 10.0.0.256 or 1.2.3.4", "alpha\n" + passage + "\nomega", "first\nsecond\n" + passage,
             "Größe ß ñ +1 (988) 555-2485 4539 1488 0343 6467", "x", "12345"]
    rows = [(i, t, ["en", "de", None, ""][i % 4], "s", 0, "k", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "no id here", "en", None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
