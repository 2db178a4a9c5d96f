import json
import math

import pytest
from pyspark.sql import Observation

from tasteloom.sources import kafka
from tasteloom.sources.replay import parse_messages, replay_messages
from tasteloom.sources.schemas import MissingColumns

MESSAGES = [
    '{"UserId":"a","ProductId":"p","Score":3.5,"Time":12}', "garbage", "", '[{"UserId":"e"}]', '{"UserId":7,"Score":"5.0"}',
    '{"UserId":"b","Score":4,"Time":1.5}', '{"UserId":"c","Score":NaN}', '{"UserId":null}',
    '{"UserId":"d","userid":"x","Extra":1}', None,
]
REVIEWS = "Id long, UserId string, ProductId string, Score float, Time long"


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_parse(spark, kind):
    feed = spark.createDataFrame([(m,) for m in MESSAGES], "value string").selectExpr(f"CAST(value AS {kind}) AS value")
    rows = {r["UserId"]: tuple(r)[1:] for r in parse_messages(feed).collect()}
    assert set(rows) == {"a", "7", "b", "c", "d"}
    assert rows["a"] == ("p", 3.5, 12)
    assert rows["7"] == (None, None, None)
    assert rows["b"] == (None, 4.0, None)
    assert math.isnan(rows["c"][1])
    assert rows["d"] == (None, None, None)


def test_replay(spark):
    rows = [
        (6, "u", "p", 4.0, 100), (5, "u", "p", 4.0, 100), (17, "v", None, None, 7), (8, None, "p", 1.0, 1),
        (9, "u", "p", 1.0, None), (None, "u", "p", 1.0, 1), (-1, "w", "q", 2.0, 3),
    ]
    skipped = Observation("skipped")
    got = replay_messages(spark.createDataFrame(rows, REVIEWS), skipped).collect()
    want = [
        {"UserId": "u", "ProductId": "p", "Score": 4.0, "Time": 100}, {"UserId": "v", "Time": 7},
        {"UserId": "w", "ProductId": "q", "Score": 2.0, "Time": 3},
    ]
    assert sorted((json.loads(r["value"]) for r in got), key=str) == sorted(want, key=str)
    assert skipped.get == {"no_user": 1, "no_id": 1, "no_time": 1}


def test_replay_needs_its_columns(spark):
    with pytest.raises(MissingColumns, match="Time"):
        replay_messages(spark.createDataFrame([(1, "u", "p", 1.0)], "Id long, UserId string, ProductId string, Score float"))


def test_kafka_options():
    read = kafka.read_options("h:1", maxOffsetsPerTrigger="10")
    assert read["subscribe"] == "user-ratings" and read["startingOffsets"] == "earliest"
    assert read["maxOffsetsPerTrigger"] == "10"
    # Nothing is lost in silence, and nothing held back, unless asked for.
    assert not {"failOnDataLoss", "maxOffsetsPerTrigger"} & set(kafka.read_options("h:1"))
    assert kafka.read_options("h:1", **kafka.SMALL_DEPLOYMENT)["failOnDataLoss"] == "false"
    write = kafka.write_options("h:1", "t")
    assert write["topic"] == "t" and write["kafka.acks"] == "all" and write["kafka.retries"] == "5"
    assert write["kafka.linger.ms"] == "10"
