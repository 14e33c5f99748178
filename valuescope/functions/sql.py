"""The library's column functions as Spark SQL functions (no Python at run time).

``register_sql_functions(spark)`` creates temporary SQL functions whose bodies
are the same built-in expressions the DataFrame API uses, generated from the same
fixed rule tables, so ``spark.sql`` users get identical results:

  vs_slug(s)            runs of non-word characters -> "_"
  vs_to_int(s)          lenient integer (0 when not a plain integer literal)
  vs_short_term(uri)    namespace URI -> short prefix
  vs_word_tokens(s)     lower-cased word tokens minus the stop list
  vs_treebank_tokens(s) Treebank tokens minus the stop list
  vs_fingerprint64(v)   64-bit median-threshold fingerprint of a numeric array
  vs_fold8(v)           the lossy 8-position fold of the same bits

Example (Spark does not accept SQL functions inside a generator, so the token
array is computed in a subquery and exploded outside it)::

    register_sql_functions(spark)
    spark.sql("SELECT doc_id, token, count(*) AS count FROM "
              "(SELECT doc_id, explode(toks) AS token FROM "
              " (SELECT doc_id, vs_treebank_tokens(text) AS toks FROM docs WHERE text <> '')) "
              "GROUP BY doc_id, token")
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .scalars import INT_LITERAL, SLUG_PATTERN, namespace_table
from .text import STOP_WORDS_EN, WORD_PATTERN, WS, java_replacement, spark_steps


def _literal(spark: SparkSession, s: str) -> str:
    """A Spark SQL string literal for ``s`` under the session's parser settings."""
    legacy = spark.conf.get("spark.sql.parser.escapedStringLiterals", "false").lower() == "true"
    if legacy:  # no escape processing: the text must avoid the quote character
        if "'" not in s:
            return "'" + s + "'"
        if '"' not in s:
            return '"' + s + '"'
        raise ValueError("literal needs both quote characters under escapedStringLiterals")
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _not_stop(spark: SparkSession, arg: str) -> str:
    # An IN list is looked up in a hash set; array_contains would walk the array for every token.
    return f"{arg} NOT IN (" + ", ".join(_literal(spark, w) for w in STOP_WORDS_EN) + ")"


def _rewrite(spark: SparkSession, arg: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({arg}, {_literal(spark, pattern)}, {_literal(spark, java_replacement(repl))})"


def _let(arg: str, name: str, body: str) -> str:
    return f"element_at(transform(array({arg}), {name} -> {body}), 1)"


def _treebank_body(spark: SparkSession, arg: str) -> str:
    out = arg
    rewrites, contractions = spark_steps()
    for kind, *step in rewrites:
        if kind == "pad":
            out = f"concat(' ', {out}, ' ')"
        elif kind == "replace":
            out = f"replace({out}, {_literal(spark, step[0])}, {_literal(spark, step[1])})"
        else:
            pattern, repl, needles, ends = step
            tests = " OR ".join([f"contains(x, {_literal(spark, n)})" for n in needles]
                                + [f"endswith(x, {_literal(spark, n)})" for n in ends])
            out = (_let(out, "x", f"CASE WHEN {tests} THEN {_rewrite(spark, 'x', pattern, repl)} ELSE x END")
                   if tests else _rewrite(spark, out, pattern, repl))
    contracted = "x"
    for needle, steps in contractions:
        done = "z"
        for pattern, repl in steps:
            done = _rewrite(spark, done, pattern, repl)
        contracted = _let(contracted, "z", f"CASE WHEN contains(low, {_literal(spark, needle)}) THEN {done} ELSE z END")
    out = _let(out, "x", _let("lower(x)", "low", contracted))
    pieces = f"split({out}, {_literal(spark, WS + '+')})"
    return f"filter({pieces}, t -> t <> '' AND {_not_stop(spark, 't')})"


def _fold_body(period: int, combine: str, zero: str, one: str) -> str:
    # Median in the start value of aggregate: computed once per row.
    sorted_v = "array_sort(v)"
    median = (f"(({sorted_v}[CAST(floor((size(v) - 1) / 2) AS INT)] + "
              f"{sorted_v}[CAST(floor(size(v) / 2) AS INT)]) / 2.0D)")
    add = f"IF(x > s.m, shiftleft({one}, s.i % {period}), {zero})"
    acc = f"(s.acc ^ {add})" if combine == "xor" else f"(s.acc + {add})"
    return (f"aggregate(v, named_struct('m', {median}, 'acc', {zero}, 'i', 0), "
            f"(s, x) -> named_struct('m', s.m, 'acc', {acc}, 'i', s.i + 1), s -> s.acc)")


def sql_function_bodies(spark: SparkSession) -> dict[str, tuple[str, str, str]]:
    """name -> (parameter list, return type, body)."""
    to_int = (f"CAST(coalesce(try_cast(regexp_extract(s, {_literal(spark, INT_LITERAL)}, 1) AS INT), 0) "
              f"AS INT)")
    short = "CASE " + " ".join(
        f"WHEN startswith(s, {_literal(spark, uri)}) THEN concat({_literal(spark, prefix)}, "
        f"substring(s, {len(uri) + 1}))" for uri, prefix in namespace_table()) + " ELSE s END"
    words = (f"filter(regexp_extract_all(lower(s), {_literal(spark, WORD_PATTERN)}, 0), "
             f"t -> {_not_stop(spark, 't')})")
    return {
        "vs_slug": ("s STRING", "STRING", f"regexp_replace(s, {_literal(spark, SLUG_PATTERN)}, '_')"),
        "vs_to_int": ("s STRING", "INT", to_int),
        "vs_short_term": ("s STRING", "STRING", short),
        "vs_word_tokens": ("s STRING", "ARRAY<STRING>", words),
        "vs_treebank_tokens": ("s STRING", "ARRAY<STRING>", _treebank_body(spark, "s")),
        "vs_fingerprint64": ("v ARRAY<DOUBLE>", "BIGINT", _fold_body(64, "xor", "CAST(0 AS BIGINT)",
                                                                      "CAST(1 AS BIGINT)")),
        "vs_fold8": ("v ARRAY<DOUBLE>", "INT", _fold_body(8, "sum", "0", "1")),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    names = []
    for name, (params, returns, body) in sql_function_bodies(spark).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
        names.append(name)
    return names
