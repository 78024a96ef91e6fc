import os
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

# Python workers must find the package too
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(Path(__file__).parents[1]), os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
    }
    session = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
