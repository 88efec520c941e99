import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from schemas import ITEM_SCHEMA, LOG_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from trolley.session import build_session

    shared = tempfile.mkdtemp(prefix="shared-")
    session = build_session("tests", "local[4]", 4, {
        "spark.checkpoint.dir": shared,
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "6g",
        "spark.sql.codegen.comments": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def log(spark):
    """Random small log in which one customer and one item hold about a third of the rows each."""
    import random

    rng = random.Random(5)
    rows = []
    for seq in range(900):
        customer = 0 if rng.random() < 0.34 else rng.randrange(1, 25)
        item = 3 if rng.random() < 0.34 else rng.randrange(30)
        kind = rng.choice([0, 1, 2, 2])
        rows.append((customer, item, rng.randrange(12), kind, rng.randrange(1, 4) if kind == 2 else 0, seq))
    return rows


@pytest.fixture(scope="session")
def interactions(spark, log):
    return spark.createDataFrame(log, LOG_SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def items(spark):
    rows = [(i, i % 4, "ABCD"[i % 4], i % 5, 10.0 + i, i % 2 == 0) for i in range(32)]
    return spark.createDataFrame(rows, ITEM_SCHEMA)
