"""Chat formatting with linked tool calls (native DataFrame work only).

Messages carry their tool calls as a JSON array of {id, name, arguments} and results
name the call they answer. Calls and results are hash-joined on (conversation, call id).
An argument "$<id>" refers to the result of another call of the conversation; calls get
their depth in the order of these references (level by level, a call follows all it
refers to). Arguments are checked against the schema of their tool. Every message and
every call becomes one row with its canonical JSON: keys sorted, no white space,
numbers in shortest form. (turn, depth, place) orders a conversation.

A row per message and call, not a text per conversation: no task holds a conversation,
however long. The levels are joins of the calls that are still open, each written to the
shared folder; there are as many as the longest chain of references has calls.

Defined cases: of calls with one id in a conversation the first (turn, place) counts,
later ones are 'duplicate_call'; of results for one call the first is linked, later ones
are 'duplicate_result', results of no call 'orphan_result'; calls without result are
'no_result', those in a circle of references, or after one, 'circular' with null depth;
invalid ones are 'invalid' with all reasons in ``errors``. Null or malformed call lists
count as none, null ids are never linked, null texts and roles are left out of the JSON;
null conversations and turns are values; repeated rows are repeated calls; an empty table
gives an empty result; columns not named are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import col

CALLS = "array<struct<id:string,name:string,arguments:string>>"
# Tool -> argument -> (JSON type, required).
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]
_TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|DECIMAL.*|FLOAT", "boolean": "BOOLEAN",
          "object": "OBJECT<.*", "array": "ARRAY<.*"}


def schema_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """Sorted reasons why a call's arguments do not fit the schema of its tool."""
    value = F.try_parse_json(arguments)
    keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))

    def reason(text: str, wrong: Column) -> Column:
        return F.when(F.coalesce(wrong, F.lit(False)), F.array(F.lit(text))).otherwise(F.array().cast("array<string>"))

    found = F.when(name.isNull() | ~name.isin(list(schemas)), F.array(F.lit("unknown_tool")))
    for tool, arguments_of in schemas.items():
        reasons = [F.transform(F.array_except(keys, F.array(*[F.lit(a) for a in arguments_of]).cast("array<string>")),
                               lambda k: F.concat(F.lit("unknown:"), k))]
        for arg, (kind, required) in arguments_of.items():
            part = F.variant_get(value, f"$['{arg}']", "variant")
            is_null = part.isNull() | F.is_variant_null(part)
            if required:
                reasons.append(reason(f"missing:{arg}", is_null))
            refers = F.coalesce(F.try_variant_get(value, f"$['{arg}']", "string").startswith("$"), F.lit(False))
            fits = F.schema_of_variant(part).rlike(f"^({_TYPES[kind]})$")
            reasons.append(reason(f"type:{arg}", ~is_null & ~refers & ~fits))
        found = found.when(name == tool, F.concat(*reasons))
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT<"), F.lit(False))
    return F.array_sort(F.when(~is_object, F.array(F.lit("not_an_object"))).otherwise(found))


def depths(calls: DataFrame, references: DataFrame) -> DataFrame:
    """(c, id, depth) of the calls (c, id) that no circle of ``references`` (c, id, to) blocks.

    References to unknown calls and of a call to itself: the former do not count, the
    latter is a circle.
    """
    nodes = pin(calls.select("c", "id"))
    known = nodes.select(F.col("c").alias("c2"), F.col("id").alias("id2"))
    to = (F.col("c").eqNullSafe(F.col("c2"))) & (F.col("to") == F.col("id2"))
    own = (F.col("c").eqNullSafe(F.col("c2"))) & (F.col("id") == F.col("id2"))
    edges = pin(references.distinct().join(known, to, "left_semi"))
    blocked = edges.select("c", "id").distinct()
    settled = pin(nodes.join(blocked.select(F.col("c").alias("c2"), F.col("id").alias("id2")), own, "left_anti"))
    out, depth = [settled.withColumn("depth", F.lit(0))], 0
    while not edges.isEmpty() and not settled.isEmpty():
        depth += 1
        done = settled.select(F.col("c").alias("c2"), F.col("id").alias("id2"))
        left = pin(edges.join(done, to, "left_anti"))
        waiting = left.select(F.col("c").alias("c2"), F.col("id").alias("id2")).distinct()
        settled = pin(edges.select("c", "id").distinct().join(waiting, own, "left_anti"))
        edges = left
        out.append(settled.withColumn("depth", F.lit(depth)))
    found = out[0]
    for level in out[1:]:
        found = found.unionByName(level)
    return found


def format_chat(messages: DataFrame, schemas: Schemas, conversation: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text", calls: str = "calls", answers: str = "answers") -> DataFrame:
    """(conversation, turn, depth, place, kind, call_id, status, errors, json) of every
    message, call and unlinked result; linked results are part of their call's row."""
    m = messages.select(
        col(conversation).alias("c"), col(turn).alias("t"), col(role).alias("role"), col(text).alias("text"),
        F.from_json(col(calls).cast("string"), CALLS).alias("calls"), col(answers).cast("string").alias("answers"))
    m = pin(m)
    found = m.where("calls is not null").select("c", "t", F.posexplode("calls").alias("place", "call")).select(
        "c", "t", "place", F.col("call.id").alias("id"), F.col("call.name").alias("name"),
        F.col("call.arguments").alias("arguments"))
    # A tie-break by content: of equal calls in one place any is the first.
    found = found.withColumn("nt", F.col("t").isNull()).withColumn("h", F.xxhash64("name", "arguments"))
    first = found.where("id is not null").groupBy("c", "id").agg(
        F.min_by(F.struct("t", "place", "name", "arguments"), F.struct("nt", "t", "place", "h", "arguments")).alias("call"),
        F.count("*").alias("n"))
    results = m.where("answers is not null").groupBy("c", F.col("answers").alias("id")).agg(
        F.min_by(F.struct("t", "text"), F.struct(F.col("t").isNull(), "t", F.col("text").isNull(), "text")).alias("result"))
    r = results.select(F.col("c").alias("c2"), F.col("id").alias("id2"), "result")
    same = F.col("c").eqNullSafe(F.col("c2")) & (F.col("id") == F.col("id2"))
    linked = pin(first.join(r, same, "left").select(
        "c", "id", "call", "n", "result", schema_errors(F.col("call.name"), F.col("call.arguments"), schemas).alias("errors")))
    references = linked.select("c", "id", F.explode(F.regexp_extract_all(
        F.coalesce("call.arguments", F.lit("")), F.lit(r'[:\[,]\s*"\$([^"\\]+)"'), 1)).alias("to"))
    order = depths(linked, references).select(F.col("c").alias("c2"), F.col("id").alias("id2"), "depth")
    linked = linked.join(order, same, "left")
    value = F.try_parse_json("call.arguments")
    call_json = F.to_json(F.struct(
        F.when(value.isNotNull(), value).alias("arguments"), F.col("id").alias("call"), F.col("call.name").alias("name"),
        F.col("result.text").alias("result"), F.lit("call").alias("type")))
    status = (F.when(F.col("depth").isNull(), "circular").when(F.size("errors") > 0, "invalid")
              .when(F.col("result").isNull(), "no_result").otherwise("ok"))
    out = linked.select(
        "c", F.col("call.t").alias("t"), "depth", F.col("call.place").alias("place"), F.lit("call").alias("kind"),
        "id", status.alias("status"), F.concat_ws(",", "errors").alias("errors"), call_json.alias("json"))

    def plain(rows: DataFrame, kind: str, status_: str, place: Column, id_: Column, json: Column) -> DataFrame:
        return rows.select("c", "t", F.lit(None).cast("int").alias("depth"), place.cast("int").alias("place"),
                           F.lit(kind).alias("kind"), id_.alias("id"), F.lit(status_).alias("status"),
                           F.lit("").alias("errors"), json.alias("json"))

    none = F.lit(None).cast("string")
    # Later calls with an id taken: all but the first of each group (one of equals is the first).
    firsts = first.select(F.col("c").alias("c2"), F.col("id").alias("id2"), F.col("call.t").alias("t2"),
                          F.col("call.place").alias("place2"), F.col("call.name").alias("name2"),
                          F.col("call.arguments").alias("arguments2")).where("n > 1")
    is_first = (same & F.col("t").eqNullSafe(F.col("t2")) & (F.col("place") == F.col("place2"))
                & F.col("name").eqNullSafe(F.col("name2")) & F.col("arguments").eqNullSafe(F.col("arguments2")))
    groups = found.where("id is not null").groupBy("c", "id", "t", "place", "name", "arguments").agg(F.count("*").alias("k"))
    spare = (groups.join(first.where("n > 1").select(F.col("c").alias("c2"), F.col("id").alias("id2")), same, "left_semi")
             .join(firsts.withColumn("hit", F.lit(1)), is_first, "left")
             .withColumn("k", F.col("k") - F.coalesce("hit", F.lit(0))).drop("c2", "id2", "t2", "place2", "name2", "arguments2"))
    spare = spare.where("k > 0").select("*", F.explode(F.array_repeat(F.lit(0), F.col("k").cast("int"))))
    unnamed = found.where("id is null")

    def bare(rows: DataFrame, status_: str) -> DataFrame:
        json = F.to_json(F.struct(F.try_parse_json("arguments").alias("arguments"), F.col("id").alias("call"),
                                  F.col("name").alias("name"), F.lit("call").alias("type")))
        return plain(rows, "call", status_, F.col("place"), F.col("id"), json)

    # Results that no call took: of no call, or not the first of theirs.
    answered = m.where("answers is not null").groupBy("c", F.col("answers").alias("id"), "t", "text").agg(F.count("*").alias("k"))
    taken = linked.where("result is not null").select(
        F.col("c").alias("c2"), F.col("id").alias("id2"), F.col("result.t").alias("t2"), F.col("result.text").alias("text2"))
    loose = answered.join(taken, same, "left").withColumn("status", F.when(F.col("id2").isNull(), "orphan_result")
                                                          .otherwise("duplicate_result"))
    is_taken = F.col("id2").isNotNull() & F.col("t").eqNullSafe(F.col("t2")) & F.col("text").eqNullSafe(F.col("text2"))
    loose = loose.withColumn("k", F.col("k") - is_taken.cast("int")).where("k > 0").select(
        "c", "t", "id", "text", "status", F.explode(F.array_repeat(F.lit(0), F.col("k").cast("int"))))
    result_json = F.to_json(F.struct(F.col("id").alias("call"), F.col("text").alias("result"), F.lit("result").alias("type")))
    message_json = F.to_json(F.struct(F.col("text").alias("content"), F.col("role").alias("role"), F.lit("message").alias("type")))
    out = (out.unionByName(bare(spare, "duplicate_call")).unionByName(bare(unnamed, "no_id"))
           .unionByName(plain(m.where("answers is null"), "message", "ok", F.lit(-1), none, message_json))
           .unionByName(loose.select(
               "c", "t", F.lit(None).cast("int").alias("depth"), F.lit(0).alias("place"), F.lit("result").alias("kind"),
               "id", "status", F.lit("").alias("errors"), result_json.alias("json"))))
    return out.select(F.col("c").alias(conversation), F.col("t").alias(turn), "depth", "place", "kind",
                      F.col("id").alias("call_id"), "status", "errors", "json")

