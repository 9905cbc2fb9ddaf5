"""Dense keys, running numbers and buckets without a global sort in one task.

Rows are dealt out by ranges of a sample, sorted in their range and written down with their place
in it; the counts of the ranges give the first number of each. There is a count for each range, that
is for each partition, however sparse, dense or unevenly spread the values are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from galley.columns import fresh
from galley.session import cut_lineage

#: monotonically_increasing_id has the row's place in its partition in these bits.
_LOCAL = (1 << 33) - 1


def in_ranges(df: DataFrame, *order: Column, part: str = "part", local: str = "local") -> DataFrame:
    """`df` by ranges of `order`, sorted, with the number of the range and the place in it.

    Samples may differ from run to run, so only a checkpoint of it may be read twice.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.withColumns({part: F.spark_partition_id(), local: F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL))})


def sorted_parts(df: DataFrame, *order: Column, part: str = "part", local: str = "local") -> DataFrame:
    """A checkpoint of `in_ranges`."""
    return cut_lineage(in_ranges(df, *order, part=part, local=local))


def dense_ids(df: DataFrame, order: str, name: str = "id", start: int = 0, then: tuple[str, ...] = ()) -> DataFrame:
    """`df` with 0, 1, 2, ... in `name`, in the order of the columns `order` and `then`, null first."""
    part, local, before = fresh([*df.columns, name], "part", "local", "before")
    rows = sorted_parts(df, F.col(order), *[F.col(c) for c in then], part=part, local=local)
    counts = {r[part]: r["count"] for r in rows.groupBy(part).count().collect()}  # partitions
    offsets, n = [], start
    for p in sorted(counts):
        offsets.append((p, n))
        n += counts[p]
    first = F.broadcast(df.sparkSession.createDataFrame(offsets, f"{part} int, {before} long"))
    return rows.join(first, part).select((F.col(before) + F.col(local)).alias(name), *[c for c in df.columns if c != name])


_COMBINED = {"sum": (F.sum, lambda a, b: a + b), "min": (F.min, F.least), "max": (F.max, F.greatest)}


def running(rows: DataFrame, by: str, order: list[Column], totals: dict[str, tuple[str, Column]], before: bool = False) -> DataFrame:
    """`rows` with running sums, minima and maxima of the rows of one `by` up to each row, in `order`; before: without the row itself.

    totals: by name, "sum", "min" or "max" and the column; sums are of no nulls, what is of no rows is null
    (sums: 0). Rows are placed by ranges, so one value of `by` may have them all: what a range gets
    from those before it is one row for each range at most.
    """
    part, local, *ins = fresh([*rows.columns, *totals], "part", "local", *[f"{name}_in" for name in totals])
    first = fresh([*rows.columns, *totals, part, local, *ins], *[f"{name}_first" for name in totals])
    numbered = sorted_parts(rows.withColumns(dict(zip(ins, [c for _, c in totals.values()]))), F.col(by), *order, part=part, local=local)
    so_far = Window.partitionBy(part, by).orderBy(local).rowsBetween(Window.unboundedPreceding, -1 if before else 0)  # a range of the sort
    own = numbered.withColumns({name: _COMBINED[kind][0](c).over(so_far) for (name, (kind, _)), c in zip(totals.items(), ins)})
    whole = numbered.groupBy(part, by).agg(*[_COMBINED[kind][0](c).alias(name) for (name, (kind, _)), c in zip(totals.items(), ins)])
    earlier = Window.partitionBy(by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # ranges
    whole = whole.select(part, by, F.row_number().over(Window.partitionBy(by).orderBy(part)).alias(local), *[_COMBINED[kind][0](name).over(earlier).alias(f) for (name, (kind, _)), f in zip(totals.items(), first)])
    later = cut_lineage(whole.where(F.col(local) > 1).drop(local))  # a value goes on in a range from the one before: one row for each range at most
    out = own.join(F.broadcast(later), [part, by], "left")
    both = [_COMBINED[kind][1](*[F.coalesce(c, F.lit(0)) if kind == "sum" else F.col(c) for c in (name, f)]).alias(name) for (name, (kind, _)), f in zip(totals.items(), first)]
    return out.select(*rows.columns, *both)


def bridge_rows(articles: DataFrame, article: str = "id", authors: str = "author_ids", order: str = "id") -> DataFrame:
    """(id, author_id, articles_id): a row for each author of each article, numbered from 1."""
    pairs = articles.select(F.col(order).cast("long").alias("place"), F.col(article).alias("articles_id"), F.posexplode(authors).alias("at", "author_id"))
    return dense_ids(pairs, "place", "id", 1, ("at",)).select("id", "author_id", "articles_id")


def next_id(df: DataFrame, name: str = "id") -> int:
    """One more than the largest id; 0 if there is none."""
    return df.agg(F.coalesce(F.max(name) + 1, F.lit(0))).first()[0]


def bucket_of(position: Column, size: int = 1000) -> Column:
    return F.floor(position / size).cast("long")
