import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortgraph.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session("4", "tests", partitions=4, **{"spark.sql.warehouse.dir": str(warehouse)})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate expressions on single text cells."""

    def run(values, expression):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        from pyspark.sql import functions as F

        return [r[0] for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").select("out").collect()]

    return run
