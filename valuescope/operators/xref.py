"""Identifier cross-reference: records whose identifier occurs as a token of a text.

``cross_reference`` joins the identifiers of a table to a term-frequency index
(identifier == token) and attaches the text of the mentioning document. Its
output is one row per (identifier record, mentioning document token row), as the
analysis defines it. Hot identifiers ("1", "2", ...) are split over many tasks by
a salted join whose hot-key list is found by an exact count of the tokens that
are identifiers; the other tokens of the index are dropped first.

``id_length_histogram`` does **not** build those pairs: identifiers are counted
per key, the index is reduced to identifier tokens, those rows meet one row per
identifier and the per-document note counts, and the products of the counts are
summed per identifier length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import MAX_BROADCAST_BYTES, bounded_broadcast, salted_join, stored_bytes
from ..session import pin
from . import tf as tf_ops


def identifier_view(df: DataFrame, uuid_col: str, id_col: str) -> DataFrame:
    """(record_uuid, record_identifier): the record id and its identifier as text."""
    return df.select(F.col(uuid_col).alias("record_uuid"),
                     F.col(id_col).cast("string").alias("record_identifier"))


def identifier_index(df: DataFrame, ids: DataFrame, id_col: str, text_cols: Sequence[str],
                     tokenizer: str = "treebank", id_alias: str = "uuid") -> DataFrame:
    """The part of the term-frequency index whose tokens are identifiers of ``ids``.

    The tokens meet the distinct identifiers before they are counted, so the full
    index (a row per document and token) is never built or shuffled by document.
    """
    tokens = tf_ops.tokens(df, id_col, text_cols, tokenizer=tokenizer, id_alias=id_alias)
    return reduced(tokens, ids).groupBy(id_alias, "token").agg(F.count("*").alias("count"))


# Matches are broadcast up to this stored size (identifiers and tokens compress well).
MATCH_BYTES = 4 << 20

# Bits of a bitmap row (Spark's bitmap functions) and of the filter for each identifier.
BITMAP_BITS = 32_768
BITS_A_KEY = 16


def bitmap_filter(keys: DataFrame, key: str, n: int) -> DataFrame:
    """(bucket, bitmap): one hash bit of each of about ``n`` distinct keys, 16 bits a key.

    Each bucket holds 32,768 bits; the rows are partial-aggregated bitmaps, so equal
    keys and any number of rows cost one bitmap a bucket and task.
    """
    bits = max(BITMAP_BITS, 1 << (max(n, 1) * BITS_A_KEY - 1).bit_length())
    at = F.pmod(F.xxhash64(key), F.lit(bits)) + 1  # bit numbers begin at 1
    return keys.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"), F.lit(bits).alias("bits"))


def maybe_known(rows: DataFrame, key: str, ids: DataFrame, id_key: str,
                max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``rows`` without most of those whose ``key`` is no ``id_key`` of ``ids`` (about 1 in
    16 of them stays), by a broadcast bitmap; unchanged if the bitmap is too large to be
    broadcast. No row is shuffled. Every row with a known key stays.
    """
    known = ids.where(F.col(id_key).isNotNull()).select(id_key)
    n = known.agg(F.approx_count_distinct(id_key)).first()[0]
    if n * BITS_A_KEY // 8 > max_bytes:
        return rows
    stored = pin(bitmap_filter(known, id_key, n))
    head = stored.select("bits").first()
    if head is None:
        return rows.where(F.lit(False))
    at = F.pmod(F.xxhash64(key), F.lit(head["bits"])) + 1
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("_vs_map", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    small = F.broadcast(stored.select(F.col("bucket").alias("_vs_bucket"), F.col("bitmap").alias("_vs_map")))
    met = rows.join(small, F.bitmap_bucket_number(at) == F.col("_vs_bucket"))
    return met.where(F.getbit(byte, (position % 8).cast("int")) == 1).drop("_vs_bucket", "_vs_map")


def reduced(tokens: DataFrame, ids: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``tokens`` whose token is an identifier of ``ids``.

    A broadcast bitmap of the identifiers' hashes drops most other tokens where they are
    read. What is left can still hold very frequent tokens (identifiers, or others of the
    same hash bit), so its rows never meet the identifiers: its distinct tokens do, and
    the few that are identifiers are broadcast to the rows. If they are too many for that,
    hot tokens are split over tasks (``salted_join``).
    """
    known = ids.where(F.col("record_identifier").isNotNull()).select(
        F.col("record_identifier").alias("_vs_known")).distinct()
    # Written: it is read twice, and the optimizer would move a semi join below the bitmap's.
    likely = pin(maybe_known(tokens, "token", ids, "record_identifier"))
    found = likely.select(F.col("token").alias("_vs_token")).distinct().join(
        known, F.col("_vs_token") == F.col("_vs_known"), "left_semi")
    found = pin(found)
    if stored_bytes(found) <= max_bytes:
        return likely.join(F.broadcast(found), F.col("token") == F.col("_vs_token"), "left_semi")
    return salted_join(found, likely, "_vs_token", "token").drop("_vs_token")


def cross_reference(ids: DataFrame, tf: DataFrame, notes: DataFrame) -> DataFrame:
    """Join identifiers to the tokens that repeat them, then attach the note text.

    ``ids``: (record_uuid, record_identifier); ``tf``: (uuid, token, count), the whole
    index or its identifier part; ``notes``: (note_uuid, note). Output: record_uuid,
    record_identifier, uuid, token, count, note_uuid, note, catalognumber_len. Self
    mentions are kept.

    The index is reduced to identifier tokens first; only those rows are written and
    looked at for hot tokens, which are split (``salted_join``). Their matches are
    broadcast to the notes if they are few, so that the texts are not shuffled.
    """
    known = ids.where(F.col("record_identifier").isNotNull())
    matches = bounded_broadcast(salted_join(known, reduced(tf, ids), "record_identifier", "token"), MATCH_BYTES)
    joined = matches.join(notes, F.col("uuid") == F.col("note_uuid"), "inner")
    return joined.select(
        "record_uuid", "record_identifier", "uuid", "token", "count", "note_uuid", "note",
        F.length("record_identifier").alias("catalognumber_len"))


def id_length_histogram(ids: DataFrame, tf: DataFrame, notes: DataFrame) -> DataFrame:
    """(catalognumber_len, count, log_count) of the cross-reference rows.

    Equal to grouping ``cross_reference`` by identifier length, computed from
    per-key counts without building any pair:
    rows(key) = (ids with the key) x sum over tf rows with token key of the
    notes rows of their document. The index is first reduced to the tokens that
    are identifiers (``reduced``), so only those rows meet the identifiers (hot ones
    split) and the notes.
    """
    id_counts = (ids.where(F.col("record_identifier").isNotNull())
                 .groupBy("record_identifier").agg(F.count("*").alias("_n_ids")))
    matched = salted_join(id_counts, reduced(tf.select("uuid", "token"), ids), "record_identifier", "token").select(
        "uuid", "record_identifier", "_n_ids")
    note_counts = notes.groupBy("note_uuid").agg(F.count("*").alias("_n_notes"))
    rows = (matched.join(note_counts, F.col("uuid") == F.col("note_uuid"))
            .select(F.length("record_identifier").alias("catalognumber_len"),
                    (F.col("_n_ids") * F.col("_n_notes")).alias("_rows")))
    hist = rows.groupBy("catalognumber_len").agg(F.sum("_rows").cast("bigint").alias("count"))
    return hist.withColumn("log_count", F.log10(F.col("count").cast("double")))
