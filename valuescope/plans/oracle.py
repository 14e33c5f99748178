"""ANSI/DuckDB SQL text for the independent check of every registered query.

The SQL is generated from the same fixed rule tables as the Spark expressions
(stop list, Treebank rules, word pattern), so both engines apply the same rules;
everything else is written out as plain SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..functions.text import STOP_WORDS_EN, WORD_PATTERN, WS, treebank_steps


def lit(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def stop_list_sql(words: Sequence[str] = STOP_WORDS_EN) -> str:
    return "[" + ", ".join(lit(w) for w in words) + "]"


def treebank_sql(expr: str) -> str:
    """Nested regexp_replace chain (RE2, flag 'g') equal to ``treebank_text``."""
    out = expr
    for pattern, repl in treebank_steps():
        if pattern == "PAD":
            out = f"(' ' || {out} || ' ')"
        else:
            out = f"regexp_replace({out}, {lit(pattern)}, {lit(repl)}, 'g')"
    return out


def treebank_tokens_sql(expr: str, stop: bool = True) -> str:
    """list of Treebank tokens minus stop words."""
    pieces = f"string_split_regex({treebank_sql(expr)}, {lit(WS + '+')})"
    cond = "t <> ''"
    if stop:
        cond += f" AND NOT list_contains({stop_list_sql()}, t)"
    return f"list_filter({pieces}, lambda t: {cond})"


def word_tokens_sql(expr: str, stop: bool = True) -> str:
    raw = f"regexp_extract_all(lower({expr}), {lit(WORD_PATTERN)}, 0)"
    if not stop:
        return raw
    return f"list_filter({raw}, lambda t: NOT list_contains({stop_list_sql()}, t))"


def tokens_sql(kind: str, expr: str) -> str:
    return treebank_tokens_sql(expr) if kind == "treebank" else word_tokens_sql(expr)


def tf_index_sql(table: str, id_col: str, text_cols: Sequence[str], kind: str) -> str:
    note = "concat_ws(' ', " + ", ".join(text_cols) + ")"
    return (
        f"WITH n AS (SELECT {id_col}, {note} AS note FROM {table}), "
        f"t AS (SELECT {id_col}, unnest({tokens_sql(kind, 'note')}) AS token FROM n WHERE note <> '') "
        f"SELECT {id_col}, token, count(*) AS count FROM t GROUP BY {id_col}, token"
    )


def profile_sql(table: str, fields: Sequence[str], exprs: dict[str, str] | None = None) -> str:
    """Long profile (field, value, count) as UNION ALL of one GROUP BY per field."""
    exprs = exprs or {}
    parts = []
    for f in fields:
        e = exprs.get(f, f)
        parts.append(f"SELECT {lit(f)} AS field, CAST({e} AS VARCHAR) AS value, count(*) AS count "
                     f"FROM {table} GROUP BY 2")
    return " UNION ALL ".join(parts)


def cumulate_sql(profile_sql_text: str) -> str:
    return (
        f"WITH p AS ({profile_sql_text}), f AS (SELECT * FROM p WHERE value IS NOT NULL AND value <> ''), "
        "w AS (SELECT field, value, count, "
        "CAST(sum(count) OVER (PARTITION BY field ORDER BY count, value ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_count, "
        "CAST(sum(count) OVER (PARTITION BY field) AS BIGINT) AS total, "
        "CAST(row_number() OVER (PARTITION BY field ORDER BY count, value) - 1 AS BIGINT) AS x, "
        "count(*) OVER (PARTITION BY field) AS n FROM f) "
        "SELECT field, value, count, cum_count, "
        "CAST(cum_count AS DOUBLE) / CAST(total AS DOUBLE) * 100.0 AS cum_perc_pop, x, "
        "CAST(x AS DOUBLE) / CAST(n AS DOUBLE) * 100.0 AS x_perc FROM w"
    )


def to_int_sql(expr: str) -> str:
    from ..functions.scalars import INT_LITERAL
    return f"CAST(COALESCE(TRY_CAST(regexp_extract({expr}, {lit(INT_LITERAL)}, 1) AS INTEGER), 0) AS INTEGER)"


def fingerprint64_sql(vec: str) -> str:
    """XOR of bit (i mod 64) over elements above the vector median (bit 63 spelled out)."""
    med = (f"((list_sort(list_transform({vec}, lambda v: CAST(v AS DOUBLE)))[CAST(floor((len({vec}) - 1) / 2) AS BIGINT) + 1]"
           f" + list_sort(list_transform({vec}, lambda v: CAST(v AS DOUBLE)))[CAST(floor(len({vec}) / 2) AS BIGINT) + 1]) / 2.0)")
    bit = ("CASE WHEN (i - 1) % 64 = 63 THEN CAST(-9223372036854775808 AS BIGINT) "
           "ELSE CAST(1 AS BIGINT) << ((i - 1) % 64) END")
    terms = f"list_transform({vec}, lambda v, i: CASE WHEN CAST(v AS DOUBLE) > {med} THEN {bit} ELSE CAST(0 AS BIGINT) END)"
    return f"list_reduce({terms}, lambda a, b: xor(a, b))"


def fold8_sql(vec: str) -> str:
    med = (f"((list_sort(list_transform({vec}, lambda v: CAST(v AS DOUBLE)))[CAST(floor((len({vec}) - 1) / 2) AS BIGINT) + 1]"
           f" + list_sort(list_transform({vec}, lambda v: CAST(v AS DOUBLE)))[CAST(floor(len({vec}) / 2) AS BIGINT) + 1]) / 2.0)")
    terms = f"list_transform({vec}, lambda v, i: CASE WHEN CAST(v AS DOUBLE) > {med} THEN CAST(1 << ((i - 1) % 8) AS INTEGER) ELSE 0 END)"
    return f"CAST(list_sum({terms}) AS INTEGER)"
