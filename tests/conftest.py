import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chronolink.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Run a Column step over strings and give the results back in order."""
    from pyspark.sql import functions as F

    def run(step, *texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
        out = rows.select("i", step(F.col("text")).alias("out")).orderBy("i").collect()
        return [r.out for r in out]

    return run


@pytest.fixture(scope="session")
def page(spark):
    """A page table out of wikitexts."""
    from chronolink.schemas import PAGE

    def build(*texts, **fields):
        rows = [
            (i, fields.get("rev_id", i * 10), fields.get("title", f"Page {i}"), fields.get("ns", 0), None, t)
            for i, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, PAGE)

    return build
