"""Grouped aggregates. Each is partial before the shuffle and final after it, so a hot group arrives
as one row per map task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.numbering import numbered_keys
from millrace.operators.skew import ROWS_PER_SLOT, Slots, common_types, split_join
from millrace.operators.totals import exact_totals, rounded
from millrace.scratch import materialize

MAX_ITEMS = 100_000
# Copies of one item travel in pieces this much smaller than a row, so that parts fill up evenly.
PIECES = 16
# Parts of one owner that one task joins.
PARTS_PER_SLOT = 8


def group_count(df: DataFrame, *keys, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def rating_stats(df: DataFrame, key: str, score: str, when: str) -> DataFrame:
    """Average score at two decimals, number of ratings and latest date per key."""
    stats = exact_totals(
        df, [key], averages={"avg_score": F.col(score)}, rows="num_ratings", most={"last_rated": F.col(when)}
    )
    return stats.withColumn("avg_score", rounded(F.col("avg_score"), 2))


def bucket_stats(df: DataFrame, label: Column, name: str, value: Column) -> DataFrame:
    """Rows and average value per derived bucket."""
    labelled = df.select(label.alias(name), value.alias("_value"))
    return exact_totals(labelled, [name], averages={"avg_value": F.col("_value")}, rows="n").select(
        name, "n", "avg_value"
    )


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact number of distinct values of each column (NULL is one), and the row count, as one row.

    Each column is grouped by itself, in a scan that reads nothing else: no row is repeated once per
    column on its way to the shuffle, as it is where one aggregate counts them all."""
    counts = [df.select(c).distinct().agg(F.count("*").alias("_n")).withColumn("_of", F.lit(f"n_{c}")) for c in columns]
    counts.append(df.agg(F.count("*").alias("_n")).withColumn("_of", F.lit("n_rows")))
    names = [f"n_{c}" for c in columns] + ["n_rows"]
    return reduce(DataFrame.unionAll, counts).agg(*[F.max(F.when(F.col("_of") == n, F.col("_n"))).alias(n) for n in names])


def distinct_bitmaps(df: DataFrame, groups: list[str], column: str) -> DataFrame:
    """Which values of ``column`` each group holds, NULL left out: ``bucket`` and ``bitmap`` by dense numbers of the
    values, 4 kB for 32,768 of them. Unlike counts, bitmaps of several groups, days or files merge."""
    numbers = materialize(numbered_keys(df, column, "_number"), "numbers")
    held = df.select(*groups, column).join(numbers, column)
    return held.groupBy(*groups, F.bitmap_bucket_number("_number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bitmap")
    )


def merged_distinct(bitmaps: DataFrame, groups: list[str]) -> DataFrame:
    """Exact distinct counts ``n_distinct`` per ``groups``, any of the columns the bitmaps were made for or none:
    bitmaps of one bucket are united, their bits added up."""
    united = bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return united.groupBy(*groups).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias("n_distinct"))


def pivot_counts(
    df: DataFrame, index: str, category: str, values: list[str], other: str = "other"
) -> DataFrame:
    """Rows per index and category, one column per value, 0 where there are none.

    The values are given, so no extra job looks for them. Rows of all other categories, NULL
    included, are counted in the column ``other``, so every row is in exactly one column.
    """
    if other in values:
        raise ValueError(f"{other} is one of the values: name the other column")
    column = F.when(F.col(category).isin(values), F.col(category)).otherwise(F.lit(other))
    labelled = df.select(index, column.alias("_column"))
    return labelled.groupBy(index).pivot("_column", [*values, other]).count().na.fill(0, [*values, other])


def pivot_top(df: DataFrame, index: str, category: str, k: int, other: str = "other") -> DataFrame:
    """``pivot_counts`` over the k most frequent categories, in their order; their names, k of them,
    become columns and so visit the driver."""
    top = top_values(df.filter(F.col(category).isNotNull()), category, k)
    return pivot_counts(df, index, category, [row[category] for row in top.collect()], other)


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values and their counts; ties go to the smaller value."""
    return group_count(df, column).orderBy(F.desc("n"), column).limit(k)


def top_groups_over_time(df: DataFrame, period: str, category: str, k: int) -> DataFrame:
    """Counts per period and category, for the k most frequent categories only.

    The list of categories is a k-row table that a semi-join reads; it never visits the driver.
    """
    top = top_values(df, category, k).select(category)
    return group_count(df, period, category).join(top, category, "left_semi").select(
        period, category, "n"
    )


def top_n_other_share(df: DataFrame, category: str, n: int, other: str = "Other") -> DataFrame:
    """Share of the n most frequent categories, the rest summed up as ``other``.

    Only the top n rows are joined back; the total is a window over the n + 1 rows that are left.
    """
    counts = group_count(df, category, name="_n")
    top = counts.orderBy(F.desc("_n"), category).limit(n).select(
        F.col(category).alias("_top"), F.lit(True).alias("_kept")
    )
    shown = F.when(F.col("_kept"), F.col(category)).otherwise(F.lit(other))
    grouped = (
        counts.join(top, F.col(category).eqNullSafe(F.col("_top")), "left")
        .groupBy(shown.alias(category), F.coalesce("_kept", F.lit(False)).alias("_kept"))
        .agg(F.sum("_n").alias("n"))
    )
    share = F.col("n") * 100.0 / F.sum("n").over(W.partitionBy())
    return grouped.select(category, "n", F.round(share, 1).alias("percent"))


def sum_by_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum per key, combined before the shuffle."""
    return df.groupBy(key).agg(F.sum(value).alias("total"))


def collect_items(
    df: DataFrame,
    keys: list[str],
    items: list[str],
    name: str = "items",
    max_items: int = MAX_ITEMS,
    rows_per_slot: int = ROWS_PER_SLOT,
    max_hot: int | None = None,
) -> DataFrame:
    """The rows of each group as a sorted array: of values for one item column, else of structs.

    A group of up to ``max_items`` rows comes out as one row with ``part`` 0. A larger one comes out
    as several rows of about ``max_items`` items each, told apart by ``part``, that together hold all
    its items, so no task and no row ever has to hold a group of unbounded size. A row is known by its
    keys and ``part``. Groups of all sizes take the same way.
    """
    rows = df.select(F.struct(*keys).alias("_key"), F.struct(*items).alias("_item"))
    grouped, _ = _collect_parts(rows, max_items, rows_per_slot, max_hot)
    return _named_parts(grouped, items, name)


def _named_parts(grouped: DataFrame, items: list[str], name: str) -> DataFrame:
    array = F.sort_array("_items")
    if len(items) == 1:
        array = F.transform(array, lambda item: item[items[0]])
    return grouped.select("_key.*", F.col("_slot").alias("part"), array.alias(name))


def _collect_parts(
    rows: DataFrame, max_items: int, rows_per_slot: int, max_hot: int | None
) -> tuple[DataFrame, DataFrame | None]:
    """The parts of each group, and the sizes of the groups of more than one part; None if there are none."""
    # Copies of one item become one row with a number, then pieces of bounded length. Keys and items
    # are structs, so that NULL fields compare as equal.
    runs = materialize(rows.groupBy("_key", "_item").agg(F.count("*").alias("_n")), "runs")
    totals = runs.groupBy("_key").agg(F.sum("_n").alias("_total"))
    large = materialize(totals.filter(F.col("_total") > max_items), "large-groups")
    if large.isEmpty():
        large, sized = None, runs.withColumn("_total", F.lit(1).cast("bigint"))
    else:
        sized = split_join(runs, large, ["_key"], ["_item"], "left", rows_per_slot=rows_per_slot, max_hot=max_hot)
    piece = max(1, max_items // PIECES)
    last_piece = F.ceil(F.col("_n") / piece) - 1
    pieces = sized.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last_piece)))
    copies = F.least(F.lit(piece), F.col("_n") - F.col("_piece") * piece).cast("int")
    parts = F.coalesce(F.ceil(F.col("_total") / max_items), F.lit(1))
    slotted = pieces.select(
        "_key",
        F.pmod(F.xxhash64("_item", "_piece"), parts).cast("int").alias("_slot"),
        F.array_repeat("_item", copies).alias("_run"),
    )
    # Grouping by (key, slot) would be content with rows still partitioned by the key alone.
    grouped = (
        slotted.repartition("_key", "_slot")
        .groupBy("_key", "_slot")
        .agg(F.flatten(F.collect_list("_run")).alias("_items"))
    )
    return grouped, large


def nested_documents(
    owners: DataFrame,
    details: DataFrame,
    key: str,
    items: list[str],
    name: str,
    max_items: int = MAX_ITEMS,
    **skew,
) -> DataFrame:
    """Owners with their detail rows as an array of structs; owners without any have NULL.

    An owner with more than ``max_items`` details gets several documents, told apart by ``part``.
    """
    rows = details.select(F.struct(key).alias("_key"), F.struct(*items).alias("_item"))
    grouped, large = _collect_parts(rows, max_items, skew.get("rows_per_slot", ROWS_PER_SLOT), skew.get("max_hot"))
    arrays = _named_parts(grouped, items, name)
    types = common_types(owners, arrays, [key], [key])
    if large is None or types is None:
        joined = owners.join(arrays, key, "left")
    else:
        parts = large.select(f"_key.{key}", F.ceil(F.col("_total") / max_items).alias("_parts"))
        slots = Slots(parts, [key], PARTS_PER_SLOT, types=types, rows="_parts")
        joined = split_join(owners, arrays, [key], ["part"], "left", "right", slots=slots)
    return joined.withColumn("part", F.coalesce("part", F.lit(0)))
