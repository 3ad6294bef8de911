import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def lspark(spark):
    from adsieve.llm.common import prepare
    return prepare(spark)


@pytest.fixture()
def documents(lspark):
    def make(rows, **extra):
        df = lspark.createDataFrame(rows, "doc_id long, text string")
        for name, value in extra.items():
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit(value))
        return df
    return make
