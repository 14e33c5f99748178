"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (align, chat, fingerprint, html_extract, jaccard, license_scan, mixing, pieces, quality, simhash,
               substring, toxicity, variants)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses found in every document, with their regions."""
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate group of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with repeated sentence spans cut out of its text."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedup(docs, n_cut="n_cut")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels not held out."""
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures, weakly supervised quality and verdict of every document."""
    return quality.judge(_table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch of every document and its edited text, and their likeness."""
    rows = fingerprint.compare_with_edits(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        fingerprint.text_form(F.col("sketch")).alias("fingerprint"),
        fingerprint.text_form(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited", "near_next")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document, decoded again and compared."""
    rows = pieces.round_trip(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_pieces", "ids", F.sha2("decoded", 256).alias("decoded_sha256"), "lossless")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document, near each source's target."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


# Tools the calls of ``_tool_messages`` may name.
TOOLS: chat.Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", True), "source": ("string", False)},
    "summarise": {"text": ("string", True), "words": ("integer", False), "source": ("string", False)},
    "convert": {"amount": ("number", True), "unit": ("string", True)},
}


def _tool_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in input: conversations whose assistant turns call tools and whose next
    turns answer them (the table itself has no tool calls)."""
    table = _table(spark, sf_dir, "conversations")
    kind = F.pmod(F.xxhash64("text"), F.lit(7))
    call = F.col("role") == "assistant"
    first_line = F.substring_index("text", "\n", 1)
    size = F.length("text")
    arguments = (
        F.when(kind == 0, F.to_json(F.struct(size.alias("amount"), F.lit("chars").alias("unit"))))
        .when(kind == 1, F.to_json(F.struct(size.cast("string").alias("limit"), first_line.alias("query"))))
        .when(kind == 2, F.to_json(F.struct((size % 50).alias("words"))))
        .when((kind == 3) & (F.col("turn") > 2), F.to_json(F.struct(
            F.concat(F.lit("$c"), F.col("turn") - 2).alias("source"), first_line.alias("query"), (size % 20).alias("limit"))))
        .otherwise(F.to_json(F.struct(first_line.alias("text"), F.concat(F.lit("$c"), F.col("turn") - 2).alias("source")))))
    name = F.when(kind == 0, "convert").when(kind.isin(1, 3), "search").when(kind == 5, "translate").otherwise("summarise")
    calls = F.to_json(F.array(F.struct(
        F.concat(F.lit("c"), F.col("turn")).alias("id"), name.alias("name"), arguments.alias("arguments"))))
    answers = (F.col("role") == "user") & (F.col("turn") > 1)
    return table.select("conv_id", "turn", F.when(answers, "tool").otherwise(F.col("role")).alias("role"), "text",
                        F.when(call, calls).alias("calls"),
                        F.when(answers, F.concat(F.lit("c"), F.col("turn") - 1)).alias("answers"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical JSON of every message and linked tool call of the conversations."""
    return chat.format_chat(_tool_messages(spark, sf_dir), TOOLS)


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers."""
    return align.align(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents with their common form and the root of their forms."""
    return variants.group_variants(_table(spark, sf_dir, "documents"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document under the n-gram Jaccard join."""
    return jaccard.join_components(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_simhash_groups": op2_simhash_groups,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_quality_rules": op5_quality_rules,
    "op6_fingerprints": op6_fingerprints,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_mix_sources": op8_mix_sources,
    "op9_chat_format": op9_chat_format,
    "op10_html_text": op10_html_text,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_jaccard_join": op13_jaccard_join,
}

SQL: dict[str, str] = {
    # CRC-32 from its polynomial, byte by byte; near words share all but one code point.
    "op12_spelling_variants": r"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) AS r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY 1, 2),
coded AS (SELECT run, n, hex(encode(doc_id || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS h
  FROM coded, crc),
slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS MATERIALIZED (
  SELECT word, i, word[:i - 1] || word[i + 1:] AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON w.word = c.rest),
best AS (
  SELECT a AS word, count(*) AS n_near, arg_min(struct_pack(b := b, n := n), struct_pack(o := -n, b := encode(b))) AS f
  FROM pairs JOIN words ON words.word = pairs.b GROUP BY a),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN f.n >= 10 * w.n THEN f.b END AS form,
         CASE WHEN f.n >= 10 * w.n THEN f.n END AS form_n
  FROM words w LEFT JOIN best ON best.word = w.word),
walk(word, place) AS (
  SELECT word, word FROM forms
  UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.place WHERE forms.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, walk.place AS root
FROM forms f JOIN walk ON walk.word = f.word JOIN forms e ON e.word = walk.place AND e.form IS NULL""",
    "op13_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) BETWEEN 1 AND 4 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END)) AS h
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT x, y FROM shared JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents
          UNION SELECT r.x, l.y FROM reach r JOIN both_ways l ON l.x = r.y)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id""",
}
