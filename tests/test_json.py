"""Message codec and quarantine routing."""

import json

from recoflow.functions.json_codec import decode_messages, encode_message, landable, quarantined
from recoflow.schemas import MESSAGE_COLUMNS

MESSAGES = [
    '{"app_id": "1", "user_id": "2", "is_recommended": "true", "hours": "3.5", "date": "2024-01-01"}',
    '{"app_id": "1", "extra": "k"}',
    '{"app_id": 12}',
    '{}',
    '[1,2]',
    '3',
    'null',
    '{bad',
]


def test_routing(spark):
    df = spark.createDataFrame(list(enumerate(MESSAGES)), "i int, value string")
    dec = decode_messages(df)
    good = {r["i"]: r for r in landable(dec, keep=("i",)).collect()}
    bad = {r["i"]: r["reason"] for r in quarantined(dec, keep=("i",)).collect()}
    assert sorted(good) == [0, 1, 2]
    assert good[2]["app_id"] == "12" and good[1]["user_id"] is None
    assert bad == {4: "not_an_object", 5: "not_an_object", 6: "not_an_object", 7: "malformed_json"}
    assert list(landable(dec).columns) == list(MESSAGE_COLUMNS)


def test_encode_keeps_nulls(spark):
    df = spark.createDataFrame([("1", None, "true", "2.0", "2024-01-02")],
                               ", ".join(f"{c} string" for c in MESSAGE_COLUMNS))
    text = df.select(encode_message().alias("v")).first()["v"]
    assert json.loads(text) == {"app_id": "1", "user_id": None, "is_recommended": "true",
                                "hours": "2.0", "date": "2024-01-02"}
    assert list(json.loads(text)) == list(MESSAGE_COLUMNS)


def test_text_after_an_object_is_quarantined(spark):
    texts = ['{"app_id":"1"}{"app_id":"2"}', '{"app_id":"1"} xyz', '{"app_id":"1"}] [', '{"app_id":"1"},"end":1} {']
    dec = decode_messages(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert landable(dec).count() == 0 and quarantined(dec).count() == len(texts)
