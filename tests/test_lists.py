import json

from pyspark.sql import functions as F

from tasteloom.functions.recjson import encode_recommendations, served_items
from tasteloom.operators import serve
from tasteloom.operators.topn import collect_lists, name_items

TEXTS = [
    ('[{"ProductId":"B1","score":4.5},{"item_index":7,"rating":1.0},"raw"]', ["B1", "7", "raw"]),
    ("oops", []), ("[]", []), ('[{"item_index":null,"ProductId":"x"}]', ["None"]), ('[{"ProductId":null}]', ["None"]),
    ('["a","b"] x', []), ('["a"]]', []), ('["a"]}', []), ('["a"],["b"]', []), ("", []), (' ["a"] ', ["a"]),
    ("[null, 3]", ["None", "3"]), ('[{"a":1}]', ['{"a":1}']), (None, []),
]


def test_served_items(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(TEXTS)], "i int, t string")
    got = dict(map(tuple, df.select("i", served_items(F.col("t"))).collect()))
    assert got == {i: want for i, (_, want) in enumerate(TEXTS)}


def test_encode(spark):
    rows = spark.createDataFrame([("u", 2, "b", 1.5), ("u", 1, 'a"x', 2.5)], "UserId string, rank int, ProductId string, score double")
    text = collect_lists(rows).select(encode_recommendations(F.col("recommendations"))).first()[0]
    assert json.loads(text) == [{"ProductId": 'a"x', "score": 2.5}, {"ProductId": "b", "score": 1.5}]


def test_index_without_a_name_shortens_the_list(spark):
    ranked = spark.createDataFrame([(1, 1, 0, 3.0), (1, 2, 9, 2.0), (1, 3, 1, 1.0)], "user_index long, rank int, item_index long, score double")
    labels = spark.createDataFrame([("a", 0, 5), ("b", 1, 4)], "label string, idx int, n long")
    assert sorted(r["ProductId"] for r in name_items(ranked, labels).collect()) == ["a", "b"]


def test_lookup_text_lists_and_fallback(spark):
    recs = spark.createDataFrame(
        [("u", '[{"ProductId":"B1"}]'), ("bad", "oops"), ("none", None)], "UserId string, recommendations string")
    asked = spark.createDataFrame([("u",), ("bad",), ("none",), ("new",), ("u",), (None,)], "UserId string")
    got = serve.lookup(asked, recs, served_items(F.col("recommendations"))).collect()
    assert sorted((str(r[0]), r[1]) for r in got) == sorted([
        ("u", ["B1"]), ("u", ["B1"]), ("bad", []), ("none", []), ("new", serve.DEFAULT_FALLBACK), ("None", serve.DEFAULT_FALLBACK)])
