"""Running sums and next values over any order, without a task that holds a whole group.

Positions are cut into chunks; each is scanned by itself, its summary is one row of the same scan one level up, and what
that says of earlier or later chunks is joined back. Levels go on until all positions are in one chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Two to this power are the positions of a chunk.
BITS = 10


def bounds(rows: DataFrame, column: str) -> tuple[int, int]:
    """The least and the largest value of a whole number column; zeros for an empty table."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    return (low, high) if low is not None else (0, 0)


def scanned(rows: DataFrame, group: list[str], order: list[str], low: int, high: int, sums: tuple[str, ...] = (), mins: tuple[str, ...] = (), nexts: tuple[str, ...] = (), bits: int = BITS, above: int | None = None, level: int = 0) -> DataFrame:
    """rows with sum_x, min_x and next_x for columns x: sum (0 for the first) and least of the group's earlier rows, and
    the first of the later ones that is not null.

    order: columns, the first of which is a whole number from low to high. group: columns without nulls, or none. Values
    of nexts must sort as their rows do, as structs that begin with the order columns do. A column is in one list only.
    bits: for chunks of positions; above: for chunks of chunks, the same where it is not given.
    """
    at, chunk = order[0], f"_chunk{level}"
    whole = high - low < 1 << bits
    rows = rows.withColumn(chunk, F.lit(0).cast("long") if whole else F.shiftright(at, bits) - (low >> bits))
    before = Window.partitionBy(*group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*group, chunk).orderBy(*map(F.desc, order)).rowsBetween(Window.unboundedPreceding, -1)
    local = {f"sum_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in sums} | {f"min_{c}": F.min(c).over(before) for c in mins} | {f"next_{c}": F.last(c, ignorenulls=True).over(after) for c in nexts}
    out = rows.withColumns(local)
    if whole:
        return out.drop(chunk)
    summary = rows.groupBy(*group, chunk).agg(*[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in (*mins, *nexts)])
    up = bits if above is None else above
    over = scanned(summary, group, [chunk], 0, (high >> bits) - (low >> bits), sums=sums, mins=mins, nexts=nexts, bits=up, level=level + 1)
    over = over.select(*group, chunk, *[F.col(c).alias(f"_{c}") for c in local])
    both = {c: F.col(c) + F.col(f"_{c}") if c.startswith("sum_") else F.least(c, f"_{c}") if c.startswith("min_") else F.coalesce(c, f"_{c}") for c in local}
    return out.join(over.hint("merge"), [*group, chunk]).withColumns(both).select(*[c for c in rows.columns if c != chunk], *local)
