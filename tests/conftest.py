import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from topicflow.schemas import FIXTURE_ITEMS_CSV, FIXTURE_ORDERS_CSV, FIXTURE_USERS_CSV  # noqa: E402
from topicflow.session import local_session  # noqa: E402
from topicflow.sources import lines  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", shuffle_partitions=4, app="topicflow-tests")
    yield s
    s.stop()


def text_df(spark, text):
    return spark.createDataFrame([(ln,) for ln in text.split("\n")], "value string")


@pytest.fixture(scope="session")
def fx_orders(spark):
    o = lines.parse_orders(text_df(spark, FIXTURE_ORDERS_CSV))
    # arrival order of the fixture = file order = time order
    from pyspark.sql import functions as F
    return (o.withColumn("order_key", F.col("transaction_date"))
             .withColumn("line_number", F.lit(1)))


@pytest.fixture(scope="session")
def fx_users(spark):
    return lines.parse_users(text_df(spark, FIXTURE_USERS_CSV))


@pytest.fixture(scope="session")
def fx_items(spark):
    return lines.parse_items(text_df(spark, FIXTURE_ITEMS_CSV))
