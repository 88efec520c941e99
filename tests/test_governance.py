import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from trolley.operators import explain, governance
from trolley.sources import sinks


def cost(spark, **tokens):
    t = {"i": 0, "o": 0, "r": 0, "w": 0, "m": governance.DEFAULT_MODEL, **tokens}
    col = governance.usage_cost(F.lit(t["m"]), F.lit(t["i"]), F.lit(t["o"]), F.lit(t["r"]), F.lit(t["w"]))
    return spark.range(1).select(col).first()[0]


def test_cost(spark):
    assert cost(spark, i=1_000_000, o=1_000_000) == pytest.approx(30.0)
    assert cost(spark, r=1_000_000) == pytest.approx(0.5)
    assert cost(spark, i=1_000_000) == pytest.approx(5.0)
    assert cost(spark, w=1_000_000) == pytest.approx(6.25)
    assert cost(spark, i=1_000_000, m="no-such-model") == pytest.approx(5.0)


def test_grounding(spark):
    rows = spark.createDataFrame([
        (0, "Buy [item_99999] and [item_1].", ["item_1"]), (1, "Try [item_1].", ["item_1"]), (2, "See [item_5].", None),
    ], "id int, answer string, allowed_ids array<string>")
    got = {r["id"]: r for r in governance.grounding_check(rows).collect()}
    assert not got[0]["grounded"] and got[0]["ungrounded_ids"] == ["item_99999"]
    assert got[0]["final_text"].startswith("Explanation withheld") and "['item_99999']" in got[0]["final_text"]
    assert got[1]["grounded"] and got[1]["final_text"] == "Try [item_1]."
    assert got[2]["grounded"] and got[2]["cited_ids"] == ["item_5"]


def test_budget(spark):
    calls = spark.createDataFrame([("a", i) for i in range(3)] + [("b", 7)], "key string, at int")
    got = {(r["key"], r["at"]): r["accepted"] for r in governance.call_budget(calls, 2, ["at"], "key").collect()}
    assert got == {("a", 0): True, ("a", 1): True, ("a", 2): False, ("b", 7): True}


def audit(spark, n=2):
    calls = spark.range(n).select(
        F.lit("v1").alias("prompt_version"), F.lit("prefix").alias("system_prefix"), F.lit("c").alias("context"),
        F.concat(F.lit("q"), F.col("id")).alias("question"), F.lit("offline").alias("provider"),
        F.lit(governance.DEFAULT_MODEL).alias("model"), F.col("id").alias("timestamp"),
        (F.col("id") * 10.04).alias("latency_ms"), F.lit(10).alias("input_tokens"), F.col("id").alias("output_tokens"),
        F.lit(0).alias("cache_read_tokens"), F.lit(0).alias("cache_write_tokens"),
        F.lit("Try [item_1].").alias("answer"), F.array(F.lit("item_1")).alias("allowed_ids"),
    )
    return governance.audit_records(governance.grounding_check(calls), max_tokens=3)


def test_audit_lines(spark, tmp_path):
    path = str(tmp_path / "audit")
    sinks.append_audit(audit(spark), path)
    lines = [json.loads(x) for p in Path(path).glob("*.json") for x in p.read_text().splitlines()]
    assert len(lines) == 2
    for key in ("request_id", "provider", "model", "prompt_version", "cost_usd", "grounded", "latency_ms"):
        assert all(key in line for line in lines)
    sinks.append_audit(audit(spark), path)
    back = sinks.read_audit(spark, path)
    assert back.count() == 4 and len(back.columns) == 14


def test_summary(spark):
    got = governance.governance_summary(audit(spark, 4)).first()
    assert got["calls"] == 4 and got["p50_latency_ms"] == pytest.approx(20.1) and got["truncations"] == 1
    assert got["total_input_tokens"] == 40 and got["grounding_failures"] == 0


def test_request_identity(spark):
    def make(context):
        return spark.range(1).select(governance.request_id(F.lit("v"), F.lit(context), F.lit("q"))).first()[0]

    assert make("a") == make("a") != make("b") and len(make("a")) == 16


def test_template_answer(spark):
    context = "TARGET PRODUCT:\n- [item_3] Dairy thing.\n\nCUSTOMER EVIDENCE:\n- bought twice\n- likes it\n\nSIMILAR PRODUCTS:\n- [item_9] Other."
    rows = spark.createDataFrame([(context, "why so"), ("nothing", "why")], "context string, question string")
    got = [r["answer"] for r in explain.template_answer(rows, "be brief").collect()]
    assert got == ["Recommended because bought twice. Dairy thing. [item_3] Comparable to [item_9].", explain.NO_CONTEXT]
    tokens = explain.template_answer(rows, "be brief").collect()[1]
    assert (tokens["input_tokens"], tokens["output_tokens"]) == (4, 8)
