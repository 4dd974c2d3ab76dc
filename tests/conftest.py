import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def one(spark):
    """Value of a column expression over one row of given columns."""
    from pyspark.sql import functions as F

    def value(make, *args, kind="string"):
        names = [f"c{i}" for i in range(len(args))]
        kinds = kind if isinstance(kind, list) else [kind] * len(args)
        df = spark.createDataFrame([tuple(args)], ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True)))
        return df.select(make(*map(F.col, names)).alias("v")).first().v

    return value
