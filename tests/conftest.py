import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from dwellspan.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("checkpoints")
    spark = session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": str(folder), "spark.driver.memory": "4g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def listings(spark):
    from dwellspan.plans.data import staged_splits

    return staged_splits(spark, SMALL)
