"""Term-frequency index: (document id, token, count) over free-text columns.

Plan: scan (only the id and text columns) -> concat_ws -> non-empty filter ->
native tokeniser (regex expressions, no Python worker) -> explode -> partial
count -> one shuffle on (id, token) -> final count. Hot tokens are no problem:
the key includes the document id, and the map side combines repeats first. An
input with fewer partitions than cores is first spread by row id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import STOP_WORDS_EN, TOKENIZERS, drop_stop_words, note
from ..plans.parallel import spread


def notes(df: DataFrame, id_col: str, text_cols: Sequence[str], id_alias: str | None = None,
          note_col: str = "note", drop_empty: bool = True) -> DataFrame:
    """(id, note) with note = text columns joined by a blank; empty notes dropped.

    Two empty strings give " ", which is kept (and yields no tokens).
    """
    out = df.select(F.col(id_col).alias(id_alias or id_col), note(*text_cols).alias(note_col))
    if drop_empty:
        out = out.where(F.col(note_col) != "")
    return out


def _tokenised(tok, tokenizer, stop_words) -> Column:
    """Token array of ``note``; stop words are dropped whichever tokenizer made it."""
    if isinstance(tokenizer, str):
        return tok(F.col("note"), stop_words)
    return drop_stop_words(tok(F.col("note")), stop_words)


def tokens(df: DataFrame, id_col: str, text_cols: Sequence[str],
           tokenizer: str | Callable[[Column], Column] = "treebank",
           stop_words: Iterable[str] | None = STOP_WORDS_EN,
           id_alias: str | None = None) -> DataFrame:
    """One row per token occurrence: (id, token)."""
    tok = TOKENIZERS[tokenizer] if isinstance(tokenizer, str) else tokenizer
    ident = id_alias or id_col
    # Spread by row id (balanced even if one id or one text holds many rows).
    n = spread(notes(df, id_col, text_cols, ident))
    arr = _tokenised(tok, tokenizer, stop_words)
    return n.select(ident, F.explode(arr).alias("token"))


def tf_index(df: DataFrame, id_col: str, text_cols: Sequence[str],
             tokenizer: str | Callable[[Column], Column] = "treebank",
             stop_words: Iterable[str] | None = STOP_WORDS_EN,
             id_alias: str | None = None) -> DataFrame:
    """(id, token, count): how often each token occurs in each document."""
    ident = id_alias or id_col
    t = tokens(df, id_col, text_cols, tokenizer, stop_words, id_alias)
    return t.groupBy(ident, "token").agg(F.count("*").alias("count"))


def token_profile(df: DataFrame, text_cols: Sequence[str], field: str = "token",
                  tokenizer: str | Callable[[Column], Column] = "treebank",
                  stop_words: Iterable[str] | None = STOP_WORDS_EN,
                  clean: Callable[[Column], Column] | None = None) -> DataFrame:
    """Long profile (field, value, count) of the tokens of a text corpus.

    ``clean`` optionally normalises each token first (e.g. ``F.lower``), giving
    the "cleaned" side of a raw/clean comparison.
    """
    tok = TOKENIZERS[tokenizer] if isinstance(tokenizer, str) else tokenizer
    n = spread(df.select(note(*text_cols).alias("note")).where(F.col("note") != ""))
    arr = _tokenised(tok, tokenizer, stop_words)
    t = n.select(F.explode(arr).alias("value"))
    if clean is not None:
        t = t.select(clean(F.col("value")).alias("value"))
    return (t.groupBy("value").agg(F.count("*").alias("count"))
            .select(F.lit(field).alias("field"), "value", "count"))


def reprofile(profile: DataFrame, clean: Callable[[Column], Column]) -> DataFrame:
    """A cleaned profile from a raw one: values mapped by ``clean`` and their counts summed.

    Equal to profiling the cleaned values directly, without rescanning the data.
    """
    return (profile.groupBy("field", clean(F.col("value")).alias("value"))
            .agg(F.sum("count").cast("bigint").alias("count")))
