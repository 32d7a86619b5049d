"""Hot keys: find them, and split them before a shuffle would put each into one task.

Plain joins of a large table to a smaller one need none of this, since adaptive execution splits
skewed join partitions by itself. It cannot when the hot rows are on the side an outer join may
leave out, when rows stay partitioned by the join key for a later grouping, or when they are kept
partitioned for reuse, as in graph rounds. Those jobs use ``split_join`` or ``Slots``.
"""

from __future__ import annotations

from copy import copy

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.scratch import materialize, written

ROWS_PER_SLOT = 1_000_000


def common_types(
    left: DataFrame, right: DataFrame, keys: list[str], right_keys: list[str]
) -> list[T.DataType] | None:
    """The types in which an equi-join compares the keys; None where text meets another type, whose
    comparison a cast to a common type would not repeat."""
    found = []
    for one, other in zip(keys, right_keys):
        kinds = [df.select(F.col(key).alias("k")).schema["k"].dataType for df, key in ((left, one), (right, other))]
        if len({isinstance(kind, T.StringType) for kind in kinds}) > 1:
            return None
        try:
            both = left.select(F.col(one).alias("k")).unionAll(right.select(F.col(other).alias("k")))
        except AnalysisException:
            return None
        found.append(both.schema["k"].dataType)
    return found


class Slots:
    """Number of slots for each hot key of ``df``, a key with more than ``rows_per_slot`` rows.

    Keys are counted exactly, combined before the shuffle, in the type in which they will be compared
    (``types``, their own by default), and stay typed columns: one row per key that Spark holds equal,
    NULL included. There are at most rows / ``rows_per_slot`` of them. They are a table that joins
    read; whether it is broadcast is left to its size. ``max_hot`` keeps the most frequent ones only. Where the keys
    have been counted already, ``df`` holds the counts and ``rows`` names their column.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        rows_per_slot: int = ROWS_PER_SLOT,
        max_hot: int | None = None,
        types: list[T.DataType] | None = None,
        rows: str | None = None,
    ):
        self.types = types or [df.select(F.col(key).alias("k")).schema["k"].dataType for key in keys]
        self.names = [f"_hot_key{i}" for i in range(len(keys))]
        counts = F.count("*") if rows is None else F.sum(rows)
        typed = [key.alias(name) for key, name in zip(self._typed(keys), self.names)]
        hot = (
            df.select(*typed, *([] if rows is None else [rows]))
            .groupBy(*self.names)
            .agg(counts.alias("count"))
            .filter(F.col("count") > rows_per_slot)
            .select(*self.names, F.ceil(F.col("count") / rows_per_slot).cast("int").alias("_slots"))
        )
        if max_hot is not None:
            hot = hot.orderBy(F.desc("_slots"), *self.names).limit(max_hot)
        table = materialize(hot, "hot-keys")
        self.table = None if table.isEmpty() else table

    def in_session(self, spark: SparkSession) -> Slots:
        """The same hot keys for the jobs of another session."""
        other = copy(self)
        other.table = spark.read.schema(self.table.schema).parquet(written(self.table, "hot-keys"))
        return other

    def __bool__(self) -> bool:
        return self.table is not None

    def _typed(self, keys: list[str]) -> list[Column]:
        return [F.col(key).cast(kind) for key, kind in zip(keys, self.types)]

    def _attach(self, df: DataFrame, keys: list[str], nulls: bool) -> DataFrame:
        """Rows with the ``_slots`` of their key, NULL unless it is hot."""
        pairs = zip(self._typed(keys), self.names)
        on = [key.eqNullSafe(F.col(name)) if nulls else key == F.col(name) for key, name in pairs]
        return df.join(self.table, on, "left")

    def scatter(self, df: DataFrame, keys: list[str], spread: list[Column]) -> DataFrame:
        """Give every row a ``_slot``; rows of a hot key get theirs from a hash of ``spread``.

        Rows without a key have no partner in any slot and are spread like those of any key.
        """
        slot = F.pmod(F.xxhash64(*spread), F.coalesce("_slots", F.lit(1))).cast("int").alias("_slot")
        return self._attach(df, keys, nulls=True).select(*df.columns, slot)

    def replicate(self, df: DataFrame, keys: list[str], flag: str | None = None) -> DataFrame:
        """Repeat the rows of a hot key once per slot; ``flag`` names a column that marks them."""
        last = F.coalesce("_slots", F.lit(1)) - 1
        flags = [] if flag is None else [F.col("_slots").isNotNull().alias(flag)]
        slot = F.explode(F.sequence(F.lit(0), last)).alias("_slot")
        return self._attach(df, keys, nulls=False).select(*df.columns, *flags, slot)


def split_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "inner",
    hot_side: str = "left",
    right_keys: list[str] | None = None,
    *,
    slots: Slots | None = None,
    rows_per_slot: int = ROWS_PER_SLOT,
    max_hot: int | None = None,
) -> DataFrame:
    """Join where one side has hot keys and the other few rows per key.

    Hot rows are divided by a hash of ``spread``, columns that tell the rows of one key apart; their
    partners are repeated in each slot. ``how`` is inner, left, right or, with the hot rows on the
    left, left_semi. Without ``right_keys`` the keys have the same names on both sides and come out
    once; with it, both come out. ``slots`` passes on hot keys that are known already, counted in the
    type in which both sides compare. Text keys that meet another type are joined unsplit.
    """
    if how not in ("inner", "left", "right") and (how, hot_side) != ("left_semi", "left"):
        raise ValueError(f"cannot split a {how} join with the hot rows on the {hot_side}")
    hot_rows, hot_keys = (left, keys) if hot_side == "left" else (right, right_keys or keys)
    if slots is None:
        types = common_types(left, right, keys, right_keys or keys)
        if types is not None:
            slots = Slots(hot_rows, hot_keys, rows_per_slot, max_hot, types)
    if not slots:
        return left.join(right, _condition(keys, right_keys), how)
    spread_columns = [F.col(c) for c in spread]
    # A repeated row that is kept without a partner would appear in each slot that happens to hold
    # none. A hot key has partners in some slot, so those rows are dropped again.
    repeated_kept = (how, hot_side) in (("left", "right"), ("right", "left"))
    scattered = slots.scatter(hot_rows, hot_keys, spread_columns)
    other, other_keys = (right, right_keys or keys) if hot_side == "left" else (left, keys)
    repeated = slots.replicate(other, other_keys, "_hot" if repeated_kept else None)
    if repeated_kept:
        scattered = scattered.withColumn("_met", F.lit(True))
    first, second = (scattered, repeated) if hot_side == "left" else (repeated, scattered)
    if right_keys:
        second = second.withColumnRenamed("_slot", "_slot2")
        on = _condition([*keys, "_slot"], [*right_keys, "_slot2"])
    else:
        on = [*keys, "_slot"]
    joined = first.join(second, on, how)
    if repeated_kept:
        joined = joined.filter(~F.col("_hot") | F.col("_met").isNotNull())
    return joined.drop("_slot", "_slot2", "_hot", "_met")


def _condition(keys: list[str], right_keys: list[str] | None):
    if right_keys is None:
        return keys
    return [F.col(a) == F.col(b) for a, b in zip(keys, right_keys)]
