from pathlib import Path

import pytest


@pytest.fixture(autouse=True)
def modules(spark):
    root = str(Path(__file__).resolve().parents[2])
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
