from pyspark.sql import functions as F

from loamwork.operators import payloads


def test_payloads_of_every_kind(spark):
    wp, other = "https://a.org/wp-json/wp/v2/posts", "https://a.org/api"
    rows = [
        ('[{"id": 1, "date": "x", "a.b": {"c": 2}}, 5]', wp, 200, ("wp_rest", True, None, ["a.b", "date", "id"])), ("[]", wp, 200, ("wp_rest", False, None, [])), ("[3]", wp, 200, ("wp_rest", True, None, [])),
        ('{"code": 1}', wp, 200, ("wp_rest", None, None, None)), (" [1, [2, 3]] \n", other, 200, ("json_list", None, 2, None)), ('{"a": []}', other, 200, ("json_object", None, None, None)),
        ("{broken", other, 200, ("html", None, None, None)), ("12", other, 200, ("html", None, None, None)), ("null", other, 200, ("html", None, None, None)), (None, other, 200, ("html", None, None, None)), ("", other, 200, ("html", None, None, None)),
        ("[]", "", 200, ("none", None, None, None)), ("[]", other, None, ("error", None, None, None)), ("[1]", other, 403, ("refused", None, None, None)),
        ("[{" + ",".join(f'"f{i:02}": {i}' for i in range(40)) + "}]", wp, 200, ("wp_rest", True, None, [f"f{i:02}" for i in range(25)])),
    ]
    found = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "i int, body string, url string, status int").select("i", payloads.api_payload(F.col("body"), F.col("url"), F.col("status")).alias("p")).collect()
    assert {r["i"]: tuple(r["p"]) for r in found} == {i: r[3] for i, r in enumerate(rows)}


def test_responses_in_both_shapes(spark):
    schema = "state_id int, question_id string, kind string, probabilities map<string,double>, noul double, choice string, top_probability double, margin double, entropy double, confidence double"
    rows = [(1, "q", "noul", {"true": 0.75, "false": 0.25}, 0.75, None, 0.75, 0.5, 0.56, 0.5), (2, "c", "choice", {"a 'b'": 0.125, 'c"': 0.875}, None, 'c"', 0.875, 0.75, 0.38, 0.75)]
    sent = payloads.with_response(spark.createDataFrame(rows, schema))
    shapes = {r["state_id"]: r["s"] for r in sent.select("state_id", F.schema_of_variant("response").alias("s")).collect()}
    assert "noul" in shapes[1] and "choice" not in shapes[1] and "probabilities" in shapes[2] and "noul" not in shapes[2]
    odd = spark.createDataFrame([(3, "[1]"), (4, "null")], "state_id int, j string").select("state_id", F.parse_json("j").alias("response"))
    read = {r["state_id"]: (r["shape"], r["noul"], r["choice"], r["chosen"], r["entropy"]) for r in payloads.read_response(sent.select("state_id", "response").unionByName(odd)).collect()}
    assert read == {1: ("noul", 0.75, None, None, 0.56), 2: ("choice", None, 'c"', 0.875, 0.38), 3: ("other", None, None, None, None), 4: ("other", None, None, None, None)}
