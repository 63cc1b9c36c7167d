"""Joins and running sums that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.session import checkpointed

# A dimension is broadcast only while its measured rows stay under this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
# Target size of one window group; larger groups are cut into ordered cells.
GROUP_ROWS = 5_000_000
# A key with more rows than this is spread over copies of its dimension row, one for each so many rows.
HOT_ROWS = 1_000_000
SAMPLE_PER_CELL = 100


# --- dimension joins -------------------------------------------------------------------


def _bytes(value: Column, kind: T.DataType) -> Column:
    """About the bytes a value takes in a row of Spark."""
    if isinstance(kind, T.StringType | T.BinaryType):
        size = 8 + F.octet_length(value)
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType | T.BinaryType | T.ArrayType | T.StructType | T.MapType):
            each = F.transform(value, lambda x: _bytes(x, kind.elementType))
            size = 16 + F.aggregate(each, F.lit(0).cast("long"), lambda a, n: a + n)
        else:
            size = 16 + 8 * F.size(value)
    elif isinstance(kind, T.MapType):
        size = _bytes(F.map_keys(value), T.ArrayType(kind.keyType)) + _bytes(F.map_values(value), T.ArrayType(kind.valueType))
    elif isinstance(kind, T.StructType):
        size = sum((_bytes(value.getField(f.name), f.dataType) for f in kind.fields), F.lit(16))
    else:
        return F.lit(8).cast("long")
    return F.coalesce(size.cast("long"), F.lit(8).cast("long"))


def _row_bytes(df: DataFrame) -> Column:
    return sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16).cast("long"))


def is_small(dim: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the measured size of a (stored) dimension allows a broadcast."""
    return (dim.agg(F.sum(_row_bytes(dim))).first()[0] or 0) <= limit


def measured(dim: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Materialise a dimension once and say whether it is small."""
    kept = checkpointed(dim)
    return kept, is_small(kept, limit)


def hot_keys(df: DataFrame, key: str, most: int = HOT_ROWS, salts: int | None = None) -> DataFrame:
    """(key, _salts): keys with more than `most` rows and how many parts of about so many rows they make.

    `salts` sets the number of parts of the most frequent keys instead, whatever their rows.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    if salts is not None:
        return counts.orderBy(F.col("_rows").desc()).limit(64).select(key, F.lit(salts).cast("int").alias("_salts"))
    return counts.where(F.col("_rows") > most).select(key, F.ceil(F.col("_rows") / most).cast("int").alias("_salts"))


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    how: str = "left",
    spread_by: Sequence[str] = (),
    limit: int = BROADCAST_BYTES,
    salts: int | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join `df` to a dimension that is unique on `on`.

    A dimension of measured small size is broadcast. A larger one is joined by shuffle, with the hot keys of `df` spread
    over copies of their (single) dimension row, so that each copy meets at most about `HOT_ROWS` rows. Say `small` where
    `dim` is part of a stored table that was measured before.
    """
    kept, small = measured(dim, limit) if small is None else (dim, small)
    if small:
        return df.join(F.broadcast(kept), on, how)
    hot, few = measured(hot_keys(df, on, salts=salts))
    # Each hot key stands for HOT_ROWS rows or more: beyond the size of a broadcast only adaptive skew joins are left.
    if not few or hot.isEmpty():
        return df.join(kept, on, how)
    spread = [F.col(f"`{c}`") for c in (spread_by or [c for c in df.columns if c != on])]
    parts = F.coalesce("_salts", F.lit(1))
    left = df.join(F.broadcast(hot), on, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), parts).cast("int")).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0), parts - 1))
    right = kept.join(F.broadcast(hot), on, "left").withColumn("_salt", copies).drop("_salts")
    return left.join(right, [on, "_salt"], how).drop("_salt")


# --- ordered cells ---------------------------------------------------------------------


def _joined(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join `df` as l to a table of a few rows per group as h, groups being equal where both are null."""
    kept, small = measured(table)
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
    return df.alias("l").join((F.broadcast(kept) if small else kept).alias("h"), same, how)


def with_cells(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = GROUP_ROWS, cell: str = "_cell"
) -> DataFrame:
    """Add `cell`, an int that grows along `order` inside each group of `keys`.

    Groups up to `max_rows` rows get the single cell 0. Larger ones are cut at sampled values of the order
    columns into cells of about `max_rows` rows. `order` must be unique inside a group. The cut points decide
    only the balance, never a result; they are a checkpointed table once drawn, so a retried task sees the same cells.
    """
    sizes = df.groupBy(*keys).count()
    largest = sizes.agg(F.max("count")).first()[0]
    if not largest or largest <= max_rows:
        return df.withColumn(cell, F.lit(0))
    in_hot = _joined(df, sizes.where(F.col("count") > max_rows).select(*keys), keys, "inner")
    # Keep about SAMPLE_PER_CELL rows per future cell, then cut at every SAMPLE_PER_CELL-th of them.
    rate = F.lit(float(SAMPLE_PER_CELL)) / max_rows
    draw = F.pmod(F.xxhash64(*[F.col(f"l.{c}") for c in order]), F.lit(1_000_000_007)) / 1_000_000_007.0
    sample = in_hot.where(draw < rate).select(
        *[F.col(f"l.{k}").alias(k) for k in keys], F.struct(*[F.col(f"l.{c}").alias(c) for c in order]).alias("_at")
    )
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_at"))
    cuts = (
        sample.withColumn("_nth", nth)
        .where(F.col("_nth") % SAMPLE_PER_CELL == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("_at")).alias("_cuts"))
    )
    # Every _width-th cut is a mark: count the marks passed, then the cuts passed behind the last of them.
    cuts = cuts.withColumn("_width", F.floor(F.sqrt(F.size("_cuts"))).cast("int") + 1)
    table = cuts.withColumn("_marks", F.filter("_cuts", lambda at, i: i % F.col("_width") == 0))
    joined = _joined(df, table, keys, "left")
    here = F.struct(*[F.col(f"l.{c}") for c in order])

    def passed(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda at: at <= here))

    width = F.col("h._width")
    marks = joined.withColumn("_mark", passed(F.col("h._marks")) - 1)
    block = F.slice(F.col("h._cuts"), F.col("_mark") * width + 1, width)
    number = F.when(F.col("_mark") >= 0, F.col("_mark") * width + passed(block)).otherwise(0)
    return marks.select("l.*", F.coalesce(number, F.lit(0)).cast("int").alias(cell, metadata={"cut": True}))


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    totals: Mapping[str, Column] | None = None,
    cell: str = "_cell",
) -> DataFrame:
    """Sum each expression over the rows before this one in its group; exclusive, 0 at the start.

    `df` carries `cell` from `with_cells`. Windows stay inside one cell; what lies in earlier cells is added
    from a table of cell totals, built by a pre-aggregated group-by. `totals` are sums over the whole group.
    """
    totals = dict(totals or {})
    inside = Window.partitionBy(*keys, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # In the same order as the sums before a row, so that one operator does both.
    whole = Window.partitionBy(*keys, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    columns: dict[str, Column] = {n: F.coalesce(F.sum(e).over(inside), F.lit(0)) for n, e in sums.items()}
    columns |= {n: F.coalesce(F.sum(e).over(whole), F.lit(0)) for n, e in totals.items()}
    out = df.withColumns(columns)
    if not _is_cut(df, cell):
        return out
    cells = df.groupBy(*keys, cell).agg(
        *[F.coalesce(F.sum(e), F.lit(0)).alias(f"_d_{n}") for n, e in {**sums, **totals}.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy(*keys)
    shift = {f"_o_{n}": F.coalesce(F.sum(f"_d_{n}").over(earlier), F.lit(0)) for n in sums}
    # A cell's own share of a total is already in the row, so add the rest of the group.
    shift |= {f"_o_{n}": F.sum(f"_d_{n}").over(group) - F.col(f"_d_{n}") for n in totals}
    cut_groups = cells.withColumn("_cells", F.max(cell).over(group)).where("_cells > 0")
    offsets = cut_groups.withColumns(shift).select(*keys, cell, *shift)
    kept, small = measured(offsets)
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in (*keys, cell)]
    joined = out.alias("l").join((F.broadcast(kept) if small else kept).alias("r"), same, "left")
    added = [
        (F.col(f"l.{n}") + F.coalesce(F.col(f"r._o_{n}"), F.lit(0))).alias(n) if n in columns else F.col(f"l.{n}")
        for n in out.columns
    ]
    return joined.select(*added)


def place(df: DataFrame, keys: Sequence[str], cell: str = "_cell") -> DataFrame:
    """Shuffle once by group (and cell where groups are cut), for all windows that follow."""
    return df.repartition(*keys, cell) if _is_cut(df, cell) else df.repartition(*keys)


def _is_cut(df: DataFrame, cell: str) -> bool:
    """Whether `with_cells` had to cut any group."""
    return bool(df.schema[cell].metadata.get("cut"))


def group_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank", max_rows: int = GROUP_ROWS
) -> DataFrame:
    """0-based position of each row in its group; `order` must be unique inside it."""
    cells = with_cells(df, keys, order, max_rows)
    return running_sums(cells, keys, order, {name: F.lit(1)}).drop("_cell")
