"""Running sums and maxima along an order, without putting all rows of a key in one task.

The order is cut to slabs. Windows run inside a slab; what comes from the slabs before is carried in from a table
with one row for each key and slab.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a slab on average, if they are spread evenly along the order.
ROWS_PER_SLAB = 1_000_000


def slabs(df: DataFrame, along: Column, rows_per_slab: int = ROWS_PER_SLAB) -> Column:
    """The slab of each row: equal parts of the range of a long column."""
    n, low, high = df.agg(F.count(F.lit(1)), F.min(along), F.max(along)).first()
    parts = max(1, -(-n // rows_per_slab))
    if parts == 1:
        return F.lit(0).cast("long")
    width = max(1, -(-(high - low + 1) // parts))
    return F.floor((along - F.lit(low)) / F.lit(width)).cast("long")


def running(df: DataFrame, keys: list[str], order: list, slab: Column, fn: dict[str, tuple[str, Column]]) -> DataFrame:
    """df with a column for each of fn, of the rows before: name -> ('sum' or 'max', expression); null before the first.

    order must be total in a key, and the slab must not fall along it.
    """
    pick = {"sum": F.sum, "max": F.max}
    cut = [*keys, "__slab"]
    df = df.withColumn("__slab", slab)
    inside = Window.partitionBy(*cut).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = df.withColumns({f"__{name}": pick[f](e).over(inside) for name, (f, e) in fn.items()})
    totals = df.groupBy(*cut).agg(*[pick[f](e).alias(f"__t_{name}") for name, (f, e) in fn.items()])
    before = Window.partitionBy(*keys).orderBy("__slab").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(cut)], *[pick[f](f"__t_{name}").over(before).alias(f"__c_{name}") for name, (f, _) in fn.items()])
    on = F.lit(True)
    for i, c in enumerate(cut):
        on = on & own[c].eqNullSafe(carry[f"__k{i}"])
    joined = own.join(carry, on)
    both = {
        name: F.greatest(f"__{name}", f"__c_{name}") if f == "max" else F.when(F.coalesce(f"__{name}", f"__c_{name}").isNotNull(), F.coalesce(f"__{name}", F.lit(0)) + F.coalesce(f"__c_{name}", F.lit(0)))
        for name, (f, _) in fn.items()
    }
    return joined.withColumns(both).select(*[c for c in df.columns if c != "__slab"], *fn)
