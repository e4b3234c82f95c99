import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import pytest

COALESCE = "spark.sql.adaptive.coalescePartitions.enabled"


@pytest.fixture()
def parted(spark):
    """Small tables keep all their partitions, so that groups span several."""
    spark.conf.set(COALESCE, "false")
    yield
    spark.conf.unset(COALESCE)
