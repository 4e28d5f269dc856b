import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    place = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").config("spark.sql.warehouse.dir", str(place / "warehouse")).config("spark.checkpoint.dir", f"file://{place}/shared")
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={place}").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
