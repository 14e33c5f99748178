import json

from pyspark.sql import functions as F

from valuescope.llm import chat, queries

SCHEMAS = {"add": {"a": ("number", True), "b": ("integer", True), "note": ("string", False)}, "look": {"q": ("string", True)}}
MESSAGES = "conv_id long, turn long, role string, text string, calls string, answers string, status string, c string"


def _rows(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], MESSAGES)


def _calls(*calls):
    return json.dumps([{"id": i, "name": n, "arguments": a} for i, n, a in calls])


def _by_id(df):
    return {(r["conv_id"], r["call_id"]): r for r in df.collect() if r["kind"] == "call"}


def test_linking_order_validation_and_json(spark):
    rows = _rows(spark, [
        (1, 0, "user", "hi", None, None),
        (1, 1, "assistant", None, _calls(("c3", "add", {"b": 2, "a": "$c2"}), ("c1", "look", {"q": "é/\"x\""}),
                                         ("c2", "look", json.dumps({"q": "$c1"}))), None),
        (1, 2, "tool", "r1", None, "c1"), (1, 3, "tool", "r2", None, "c2"), (1, 4, "tool", "r1 again", None, "c1"),
        (1, 5, "assistant", "x", _calls(("k1", "look", {"q": "$k2"}), ("k2", "look", {"q": "$k1"}), ("k3", "look", {"q": "$k1"})), None),
        (2, 1, "assistant", "y", _calls(("c1", "add", {"a": 1.50, "b": "2", "z": 0}), ("c9", "nope", {}), ("e", "look", [1])), None),
        (2, 2, "tool", "lost", None, "zz"),
    ])
    out = chat.format_chat(rows, SCHEMAS)
    got = _by_id(out)
    assert [got[1, i]["depth"] for i in ("c1", "c2", "c3")] == [0, 1, 2]
    assert [got[1, i]["status"] for i in ("c1", "c2", "c3", "k1", "k3")] == ["ok", "ok", "no_result", "circular", "circular"]
    assert got[1, "c1"]["json"] == '{"arguments":{"q":"é/\\"x\\""},"call":"c1","name":"look","result":"r1","type":"call"}'
    assert got[1, "c3"]["json"] == '{"arguments":{"a":"$c2","b":2},"call":"c3","name":"add","type":"call"}'
    assert got[2, "c1"]["status"] == "invalid" and got[2, "c1"]["errors"] == "type:b,unknown:z"
    assert got[2, "c1"]["json"].startswith('{"arguments":{"a":1.5,"b":"2","z":0}')
    assert got[2, "c9"]["errors"] == "unknown_tool" and got[2, "e"]["errors"] == "not_an_object"
    loose = {(r["call_id"], r["status"]) for r in out.where("kind = 'result'").collect()}
    assert loose == {("c1", "duplicate_result"), ("zz", "orphan_result")}
    messages = {(r["conv_id"], r["turn"]): r["json"] for r in out.where("kind = 'message'").collect()}
    assert messages[1, 0] == '{"content":"hi","role":"user","type":"message"}'
    assert messages[1, 1] == '{"role":"assistant","type":"message"}' and len(messages) == 4


def _brute(rows):
    """{(conversation, id): (depth, result)} by a plain walk of the references."""
    import re
    calls, results = {}, {}
    for r in rows:
        for call in json.loads(r["calls"] or "[]"):
            calls.setdefault((r["conv_id"], call["id"]), call)
        if r["answers"] is not None:
            key = (r["conv_id"], r["answers"])
            results[key] = min(results.get(key, (r["turn"], r["text"])), (r["turn"], r["text"]))

    def depth(key, seen=()):
        if key in seen:
            return None
        needs = [(key[0], i) for i in re.findall(r'[:\[,]\s*"\$([^"\\]+)"', calls[key]["arguments"])]
        below = [depth(k, (*seen, key)) for k in needs if k in calls]
        return None if None in below else 1 + max(below, default=-1)

    return {k: (depth(k), results.get(k, (0, None))[1]) for k in calls}


def test_equals_brute_force_over_the_table(spark):
    messages = queries._tool_messages(spark, "/root/testdata/sf0.01").persist()
    got = _by_id(chat.format_chat(messages, queries.TOOLS))
    wanted = _brute(messages.collect())
    assert {k: (r["depth"], json.loads(r["json"]).get("result")) for k, r in got.items()} == wanted
    for r in got.values():
        value = json.loads(r["json"])
        assert json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["json"]
        assert (r["status"] == "ok") <= (r["errors"] == "" and "result" in value)


def test_awkward_rows(spark):
    rows = _rows(spark, [
        (1, 1, "assistant", "t", _calls(("a", "look", {"q": "1"}), ("a", "look", {"q": "2"}), (None, "look", {"q": "3"})), None),
        (1, 1, "assistant", "t", _calls(("a", "look", {"q": "1"}), ("a", "look", {"q": "2"}), (None, "look", {"q": "3"})), None),
        (None, None, None, None, None, None), (None, 3, None, None, _calls(("n", "look", {"q": "x" * 200_000})), None),
        (None, 4, "tool", None, None, "n"), (2, 1, "assistant", "", "not json", None), (2, 2, "assistant", "", "[]", None),
        (3, 1, "assistant", "", '[{"id":"b","name":null,"arguments":null}]', None),
    ])
    out = chat.format_chat(rows, SCHEMAS).collect()
    status = sorted((r["conv_id"] or 0, r["call_id"] or "", r["status"]) for r in out if r["kind"] == "call")
    assert status == [(0, "n", "ok"), (1, "", "no_id"), (1, "", "no_id"), (1, "a", "duplicate_call"), (1, "a", "duplicate_call"),
                      (1, "a", "duplicate_call"), (1, "a", "no_result"), (3, "b", "invalid")]
    (first,) = [r for r in out if r["status"] == "no_result"]
    assert json.loads(first["json"])["arguments"] == {"q": "1"}
    assert sum(r["kind"] == "message" for r in out) == 7
    assert chat.format_chat(rows.limit(0), SCHEMAS).count() == 0
    assert chat.format_chat(rows.withColumn("answers", F.lit(None)), SCHEMAS).where("kind = 'result'").count() == 0
