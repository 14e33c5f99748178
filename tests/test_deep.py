"""Deep profiles against a plain walk."""

import json
from collections import Counter

from valuescope.operators import deep


def _walk(value, path, out):
    if isinstance(value, dict) and value:
        for k, v in value.items():
            plain = k.isidentifier() and k.isascii()
            _walk(v, f"{path}.{k}" if plain else f"{path}['{k}']", out)
    elif isinstance(value, list) and value:
        for v in value:
            _walk(v, path + "[]", out)
    elif isinstance(value, (dict, list)) or value is None:
        out[path, None] += 1
    else:
        out[path, value if isinstance(value, str) else json.dumps(value)] += 1


def test_json_of_any_depth(spark):
    rows = [{"a": 1, "b": {"c": ["x", "y", {"d": True}], "e f": None}}, {"a": 1, "b": {}}, {"a": [], "z": [[1, 2], [3]]},
            {"a": "1"}, [1, "two"], "text", None, {"deep": {"er": {"and": {"er": [{"k": 5}, {"k": 5}]}}}}]
    expected = Counter()
    for r in rows:
        _walk(r, "$", expected)
    df = spark.createDataFrame([(json.dumps(r),) for r in rows] + [(None,), ("{not json",)], "props string")
    expected["$", None] += 2
    got = {(r["path"], r["value"]): r["count"] for r in deep.deep_profile(df, "props").collect()}
    assert got == dict(expected)
    assert deep.deep_profile(df.limit(0), "props").count() == 0


def test_nested_columns(spark):
    df = spark.createDataFrame([((1, [("x", 2.5), ("y", None)]),), (None,)], "r struct<a:int, l:array<struct<s:string, d:double>>>")
    got = {(r["path"], r["value"]): r["count"] for r in deep.deep_profile(df, "r").collect()}
    assert got == {("$.a", "1"): 1, ("$.l[].s", "x"): 1, ("$.l[].s", "y"): 1, ("$.l[].d", "2.5"): 1, ("$.l[].d", None): 1, ("$", None): 1}
