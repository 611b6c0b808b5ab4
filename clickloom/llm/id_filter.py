"""A filter of fixed size over ids, so that a join shuffles few rows that it does not concern."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import written

# Bits of a filter: 8 MB, however many ids.
FILTER_BITS = 1 << 26


def without_ids(rows: DataFrame, id_col: str, ids: DataFrame, ids_col: str) -> DataFrame:
    """The rows of ``rows`` whose id is not in ``ids``; those without an id stay.

    A row that the filter is sure about goes on where it was read. Only the
    others, and of those the rows of ids that share a bit by chance, are
    shuffled for an exact join, which is of one kind at every size. ``rows``
    are read twice, ``ids`` twice; other columns are not touched. ``rows`` may
    not have a column of a name beginning with ``__filter``.
    """
    if taken := [c for c in rows.columns if c.lower().startswith("__filter")]:
        raise ValueError(f"column names used inside: {taken}")
    known = ids.select(F.col(ids_col).alias("__filter_id")).dropna().distinct()

    def place(name: str):
        return F.pmod(F.xxhash64(name), F.lit(FILTER_BITS))

    filled = written(
        known.groupBy(F.bitmap_bucket_number(place("__filter_id")).alias("__filter_bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place("__filter_id"))).alias("__filter_bits")
        )
    )
    named = f"`{id_col}`"
    # At most FILTER_BITS bits.
    held = rows.join(
        F.broadcast(filled), F.bitmap_bucket_number(place(named)) == F.col("__filter_bucket"), "left"
    )
    bit = f"bitmap_bit_position(pmod(xxhash64({named}), {FILTER_BITS}L))"
    byte = f"conv(hex(substring(__filter_bits, cast({bit} div 8 + 1 AS INT), 1)), 16, 10)"
    hit = F.coalesce(
        F.col(named).isNotNull() & F.expr(f"(shiftright(cast({byte} AS INT), cast({bit} % 8 AS INT)) & 1) = 1"),
        F.lit(False),
    )
    sure = held.filter(~hit).select(rows.columns)
    unsure = held.filter(hit).select(rows.columns).hint("merge")
    exact = unsure.join(known.hint("merge"), F.col(named) == F.col("__filter_id"), "left_anti")
    return sure.unionByName(exact)
