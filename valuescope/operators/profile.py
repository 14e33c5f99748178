"""Unique-value profiles and cardinality reports.

``value_profile`` counts the distinct values of many fields in **one** scan: the
chosen columns are cast to text, unpivoted to (field, value) -- an Expand node --
and counted with a partial (map-side) aggregation before a single shuffle on
(field, value). A value holding a third of all rows costs one partial row per map
task, not a hot reducer. NULL stays its own group and is distinct from ``""``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.parallel import spread


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def field_list(df: DataFrame, nested: bool = False) -> list[str]:
    """Profilable fields in schema order.

    Top-level non-struct columns; with ``nested`` also the leaves of one struct
    level as ``parent.child`` (deeper structs stay whole).
    """
    names: list[str] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType):
            if nested:
                names.extend(f"{f.name}.{sub.name}" for sub in f.dataType.fields)
        else:
            names.append(f.name)
    return names


def _field_col(df: DataFrame, name: str):
    # "parent.child" resolves as a nested path when the parent is a struct column.
    if "." in name:
        parent, child = name.split(".", 1)
        if parent in df.columns and isinstance(df.schema[parent].dataType, StructType):
            return F.col(_quote(parent)).getField(child)
    return F.col(_quote(name))


def value_counts(df: DataFrame, field: str, value_col: str = "value") -> DataFrame:
    """Distinct values of one field with their record counts: (value, count)."""
    return (df.groupBy(_field_col(df, field).alias(value_col))
            .agg(F.count("*").alias("count")))


# Above this many fields the unpivot uses a generator over one array column
# instead of an Expand over a row as wide as the field list: stages with more
# than spark.sql.codegen.maxFields (100) columns lose whole-stage codegen.
WIDE_FIELDS = 64


def value_profile(df: DataFrame, fields: Sequence[str] | None = None,
                  nested: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """Long profile (field, value, count) of ``fields`` (default: all) in one pass.

    ``by``: columns to profile within (e.g. the record set): the output gains
    those columns and holds one profile per group, still from one pass.

    Values are compared as text (``cast(... as string)``); NULL is kept as a group.
    Nested leaves are selected before the unpivot so the scan reads only them.
    Up to ``WIDE_FIELDS`` fields the unpivot is an Expand; wider field lists are
    packed into one array per row and exploded with their position, which keeps
    every stage narrow -- still one pass over the rows and one shuffle. Values are
    counted by position; the field's name, from a literal array, joins the counts.
    """
    by = list(by)
    names = list(fields) if fields is not None else field_list(df, nested)
    names = [n for n in dict.fromkeys(names) if n not in by]
    if not names:
        raise ValueError("no fields to profile")
    keys = [F.col(_quote(b)) for b in by]
    # Each task counts what it reads, only counts move. An input of fewer splits than
    # cores (one large row group) is dealt out first: the unpivot multiplies its rows by
    # the fields, which one task would do alone.
    picked = spread(df.select(*keys, *[_field_col(df, n).alias(n) for n in names]))
    if len(names) > WIDE_FIELDS:
        values = F.array(*[F.col(_quote(n)).cast("string") for n in names])
        labels = F.array(*[F.lit(n) for n in names])
        long, label = picked.select(*keys, F.posexplode(values).alias("_pos", "value")), "_pos"
        field = F.element_at(labels, F.col("_pos") + 1).alias("field")
    else:
        narrow = picked.select(*keys, *[F.col(_quote(n)).cast("string").alias(n) for n in names])
        # Expand emits the field name as a literal per output row.
        long, label = narrow.unpivot(keys, [F.col(_quote(n)) for n in names], "field", "value"), "field"
        field = F.col("field")
    # The value leads the key: a full map is sorted by the first bytes of its keys, and
    # thousands of values share a field.
    counted = long.groupBy(*keys, "value", label).agg(F.count("*").alias("count"))
    return counted.select(*keys, field, "value", "count")


def cardinality(profile: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of distinct values per field (the NULL/blank group counts as one)."""
    return profile.groupBy(*by, "field").agg(F.count("*").alias("card"))


def cardinality_report(profile: DataFrame, min_card: int = 100, max_share: float = 0.95) -> DataFrame:
    """Cardinality, trimmed to ``min_card < card < max_share * max(card)``, ranked.

    Both bounds are strict; ``max_share`` is a share of the largest cardinality.
    ``x`` is the 0-based position by descending cardinality (ties by field name).
    The table has one row per field, so the global window below is bounded by the
    schema width, not by the data.
    """
    card = cardinality(profile)
    everything = Window.partitionBy()
    card = card.withColumn("_max", F.max("card").over(everything))
    kept = card.where((F.col("card") > F.lit(min_card))
                      & (F.col("card").cast("double") < F.col("_max").cast("double") * F.lit(max_share)))
    order = Window.orderBy(F.col("card").desc(), F.col("field"))
    return kept.select("field", "card", (F.row_number().over(order) - 1).cast("bigint").alias("x"))


def cardinality_estimate(df: DataFrame, fields: Sequence[str] | None = None, rsd: float = 0.01,
                         nested: bool = False) -> DataFrame:
    """Approximate distinct values per field straight from the table: (field, card).

    One aggregation pass with a HyperLogLog++ sketch per field (relative standard
    deviation ``rsd``) and no shuffle of values -- the cheap option when only
    cardinalities are needed. Values are counted as text like the exact report,
    and the NULL group counts as one value.
    """
    names = list(fields) if fields is not None else field_list(df, nested)
    aggs = []
    for i, n in enumerate(names):
        c = _field_col(df, n).cast("string")
        aggs.append((F.approx_count_distinct(c, rsd)
                     + F.max(F.when(c.isNull(), 1).otherwise(0))).alias(f"c{i}"))
    row = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"c{i}").cast("bigint").alias("card"))
                      for i, n in enumerate(names)])
    return row.select(F.inline(pairs))


def row_count(df: DataFrame) -> DataFrame:
    """Number of records as a one-row DataFrame (0 on empty input)."""
    return df.agg(F.count("*").alias("n"))


def value_counts_sql(spark, table: str, field: str) -> DataFrame:
    """The SQL form of a one-field value count on a registered view."""
    q = (f"SELECT {_quote(field)} AS value, count(*) AS count "
         f"FROM {_quote(table)} GROUP BY {_quote(field)}")
    return spark.sql(q)
