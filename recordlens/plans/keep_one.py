"""Keep one row per key, chosen by an explicit order, as an aggregate.

``row_number() OVER (PARTITION BY key ORDER BY ...) = 1`` sends every row
of a key to one task, so a key holding a third of the data lands on a single
executor.  ``min(struct(order..., rest...))`` picks the same row (struct
comparison is field by field, ascending, nulls first) but is algebraic:
each map task pre-reduces its rows to one per key before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str] | None = None,
               last: bool = False, repeated: bool = True) -> DataFrame:
    """One row per ``keys``: the smallest (or, with ``last``, largest) by ``order``.

    ``order`` defaults to all non-key columns in their frame order; the
    remaining non-key columns act as final tie-breakers, so the pick is
    deterministic whenever the rows differ at all.

    ``repeated`` says that many rows are equal: they are taken together by
    hash first, for one more shuffle of all columns.  Without it a row is
    shuffled once, and only the columns that a later step reads.
    """
    values = [c for c in df.columns if c not in keys]
    order = list(order) if order is not None else list(values)
    packed = [*order, *[c for c in values if c not in order]]
    fields = [F.col(c).alias(f"_k{i}") for i, c in enumerate(packed)]
    agg = F.max if last else F.min
    # A struct is no fixed-size buffer, so Spark sorts all rows that its min or max gets.  Equal rows are taken
    # together by hash before; the filter is always true, but without it the optimizer drops this step.
    once = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 0") if repeated else df
    picked = once.groupBy(*keys).agg(agg(F.struct(*fields)).alias("_pick"))
    pos = {c: i for i, c in enumerate(packed)}
    return picked.select(*keys, *[F.col(f"_pick._k{pos[c]}").alias(c) for c in values]) \
        .select(*df.columns)
