"""Line-ingest fixture (FIXTURES.md §2)."""

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from topicflow.sources import lines

from conftest import text_df


def _orders(spark, *ls):
    return lines.parse_orders(spark.createDataFrame([(x,) for x in ls], "value string"))


def test_line_rules(spark):
    got = _orders(spark, "Jack, iphone, 2016-11-11 00:00:01, 3", "", "   ",
                  "a,b,2016-11-11 00:00:01", "a,b,2016-11-11 00:00:01,3,5",
                  "a,b,2016-11-11 00:00:01,3,", "a,b,c,", " a,b,2016-11-11 00:00:01,3").collect()
    rows = sorted((r.user_name, r.item_name, r.transaction_date, r.quantity) for r in got)
    assert rows == sorted([("Jack", "iphone", 1478822401000, 3), ("a", "b", 1478822401000, 3),
                           (" a", "b", 1478822401000, 3)])


@pytest.mark.parametrize("bad", ["a,b,2016-11-11 00:00:01,x", "a,b,2016-11-11 00:00:01,3 ",
                                 "a,b,2016-13-11 00:00:01,3"])
def test_bad_value_fails_load(spark, bad):
    with pytest.raises((PySparkException, Py4JJavaError)):
        _orders(spark, "Jack, iphone, 2016-11-11 00:00:01, 3", bad).collect()


def test_item_price_trailing_blank_ok(spark):
    r = lines.parse_items(text_df(spark, "iphone, BJ, phone, 5388.88 ")).first()
    assert r.price == 5388.88


def test_users_fixture(fx_users):
    assert sorted((r.name, r.address, r.gender, r.age) for r in fx_users.collect())[0] == \
        ("Jack", "BJ", "male", 23)


def _java_fields(line):
    import re
    if not line or not line.strip(" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f"):
        return None
    parts = re.split(r"\s*,\s*", line)
    while parts and parts[-1] == "":
        parts.pop()
    return parts if len(parts) == 4 else None


def test_field_split_property(spark):
    import random
    from pyspark.sql import functions as F
    rnd = random.Random(9)
    ls = ["".join(rnd.choice("ab ,\t") for _ in range(rnd.randint(0, 14))) for _ in range(400)]
    ls += [" a , b ,c,d ", "a,b,c,d,\t", "a, ,b,c", "a,b,c,d, , "]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ls)], "i int, value string")
    v = lines.valid_fields(df)
    got = {r.i: [r.f0, r.f1, r.f2, r.f3] for r in
           v.select("i", *[lines._f(j).alias(f"f{j}") for j in range(4)]).collect()}
    exp = {i: f for i, x in enumerate(ls) if (f := _java_fields(x)) is not None}
    assert got == exp
