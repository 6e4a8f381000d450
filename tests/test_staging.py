from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cadenza.functions.keys import NULL_MARKER, surrogate_key
from cadenza.operators import staging
from cadenza.schemas import EVENT_SCHEMAS, TOPICS
from cadenza.sources import events, seeds
from conftest import TINY, rows


def test_schemas():
    assert {t: len(s) for t, s in EVENT_SCHEMAS.items()} == {
        "auth_events": 16, "listen_events": 19, "page_view_events": 22, "status_change_events": 16,
    }
    assert all(f.nullable for s in EVENT_SCHEMAS.values() for f in s)
    assert EVENT_SCHEMAS["auth_events"]["sessionId"].dataType.typeName() == "long"
    assert EVENT_SCHEMAS["listen_events"]["sessionId"].dataType.typeName() == "integer"


@pytest.mark.parametrize("topic", TOPICS)
def test_stage_merges_copies_and_types(spark, topic):
    landing = events.landing_rows(events.read_described(spark, TINY), topic)
    staged = staging.stage(landing, topic)
    types = dict(staged.dtypes)
    assert types["ts"] == types["registration"] == "timestamp"
    assert types["lon"] == types["lat"] == "decimal(18,3)"
    assert types["sessionId"] == types["userId"] == "int"
    # Copies differ in their offset alone.
    assert landing.count() > staged.count() == landing.select("itemInSession").distinct().count()


def test_decimal_rounds_half_up(spark):
    df = spark.createDataFrame([(1.0625, 215.9995, None)], "a double, b double, c float")
    assert df.select(*[staging.exact(F.col(c)) for c in "abc"]).first() == (
        Decimal("1.063"), Decimal("216.000"), None,
    )


def test_surrogate_key_keeps_null_and_blank_apart(spark):
    import hashlib

    df = spark.createDataFrame([(1, None), (1, "")], "a int, b string")
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert keys == [
        hashlib.md5(text.encode()).hexdigest() for text in (f"1-{NULL_MARKER}", "1-")
    ]


def test_surrogate_key_texts(spark):
    import hashlib

    df = spark.createDataFrame(
        [(datetime(2026, 1, 2, 3, 4, 5, 120000), Decimal("1.500"))], "t timestamp, d decimal(18,3)"
    )
    expected = hashlib.md5(b"2026-01-02 03:04:05.12-1.500").hexdigest()
    assert df.select(surrogate_key("t", "d")).first()[0] == expected


def test_seed(spark, tmp_path):
    states = seeds.us_states(spark)
    assert states.count() == 56
    path = tmp_path / "states.csv"
    path.write_text("state_code,state_name\nAL,Alabama\nWY,Wyoming\n")
    assert rows(seeds.read_seed(spark, str(path))) == [("AL", "Alabama"), ("WY", "Wyoming")]
    assert states.join(seeds.read_seed(spark, str(path)), ["state_code", "state_name"]).count() == 2
