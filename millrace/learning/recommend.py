"""Matrix factorization and its recommendations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.numbering import numbered, numbered_keys
from millrace.scratch import materialize

USER, ITEM = "_user_number", "_item_number"
# Items of a block, and users that meet one in a task; items of a block that one bound holds for.
BLOCK, GROUP, CELL = 1 << 18, 1 << 15, 64
BEST = "array<struct<minus: double, item: int>>"
# Ratings of a block of the factorization, whose tasks hold some 45 bytes for each while blocks are built (arrays double beyond 2^24); blocks at least;
# rounds after which shuffle files of the factors are dropped.
RATINGS, LEAST_BLOCKS, ROUNDS = 16_000_000, 10, 4


def fit_als(
    ratings: DataFrame,
    user: str,
    item: str,
    rating: str,
    rank: int = 5,
    max_iter: int = 10,
    reg: float = 0.1,
    seed: int = 42,
    copies: bool = True,
    per_block: int = RATINGS,
) -> ALSModel:
    """ALS on one rating per user and item; copies are averaged first, before the shuffle. ``copies`` is False where the
    caller's ratings are a written table without any. They are counted, since a task holds a block of users or items with all their
    ratings: there are as many blocks as keep it at ``per_block`` or so. More would send factors to more places than needed."""
    single = ratings
    if copies:
        single = materialize(ratings.groupBy(user, item).agg(F.avg(rating).cast("float").alias(rating)), "single-ratings")
    blocks = max(LEAST_BLOCKS, -(-single.count() // per_block))
    als = ALS(
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        rank=rank,
        maxIter=max_iter,
        regParam=reg,
        seed=seed,
        coldStartStrategy="drop",
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=ROUNDS,
        # Blocks that are kept between rounds leave the heap to those being built.
        intermediateStorageLevel="DISK_ONLY" if blocks > LEAST_BLOCKS else "MEMORY_AND_DISK",
    )
    return als.fit(single)


@dataclass
class Recommender:
    """A fitted factorization whose users and items may have keys of any type: the model knows them by
    dense numbers, which two tables hold."""

    model: ALSModel
    users: DataFrame
    items: DataFrame
    user: str
    item: str

    def predict(self, pairs: DataFrame) -> DataFrame:
        """Pairs of a known user and item with their ``prediction``; others are left out, as in the model. Factors get
        their keys first, so that pairs meet two tables and not four; products are added up as the model does."""
        known = lambda factors, numbers, number, key, name: factors.join(
            numbers.withColumnRenamed(number, "id"), "id"
        ).select(key, F.col("features").alias(name))
        # Users last: what is counted by user afterwards finds the pairs of a user in one place.
        met = pairs.join(known(self.model.itemFactors, self.items, ITEM, self.item, "_item_factors"), self.item)
        met = met.join(known(self.model.userFactors, self.users, USER, self.user, "_user_factors"), self.user)
        products = F.zip_with("_user_factors", "_item_factors", lambda a, b: a * b)
        total = F.aggregate(products, F.lit(0.0).cast("float"), lambda s, x: s + x)
        return met.select(*pairs.columns, total.alias("prediction"))

    def recommend(self, n: int) -> DataFrame:
        """Best n items of every user, one row each: user, item, ``rating`` and ``place`` from 1."""
        best, _ = top_items(self.model.userFactors, self.model.itemFactors, n)
        keyed = best.join(self.users.withColumnRenamed(USER, "id"), "id")
        return keyed.join(self.items.withColumnRenamed(ITEM, "item"), "item").select(self.user, self.item, "rating", "place")


def fit_ratings(ratings: DataFrame, user: str, item: str, rating: str, **als) -> Recommender:
    """``fit_als`` for keys that are no 32-bit numbers, such as long numbers or text. Users and items are counted
    with dense numbers first; there may be 2^31 of each. Rows without a key are left out."""
    users = materialize(numbered_keys(ratings, user, USER), "users")
    items = materialize(numbered_keys(ratings, item, ITEM), "items")
    for numbers, name in ((users, USER), (items, ITEM)):
        if (numbers.agg(F.max(name)).first()[0] or 0) >= 1 << 31:
            raise ValueError(f"the factorization holds 2^31 different values of {user if name == USER else item}")
    as_int = lambda numbers, name: numbers.withColumn(name, F.col(name).cast("int"))
    users, items = as_int(users, USER), as_int(items, ITEM)
    plain = ratings.join(users, user).join(items, item).select(USER, ITEM, rating)
    if not als.get("copies", True):
        plain = materialize(plain, "numbered-ratings")
    return Recommender(fit_als(plain, USER, ITEM, rating, **als), users, items, user, item)


def recommend_titles(
    model: ALSModel, titles: DataFrame, user: str, item: str, title: str, n: int = 5
) -> DataFrame:
    """Best n items of every user, one row each, with their titles and predicted ratings."""
    best, _ = top_items(model.userFactors, model.itemFactors, n)
    names = titles.select(F.col(item).alias("item"), title)
    return best.join(names, "item").select(F.col("id").alias(user), title, "rating")


def _norm(features: str) -> Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0), lambda s, x: s + x.cast("double") * x))


def top_items(
    users: DataFrame, items: DataFrame, n: int, block: int = BLOCK, group: int = GROUP
) -> tuple[DataFrame, int]:
    """The n items with the greatest product of factors for every user, and how many products were taken.

    ``users`` and ``items`` have ``id`` and ``features``. Items are laid out in blocks by falling length of their
    factors. No product is greater than the lengths of both sides allow, so a user whose n-th best is above
    what the next block allows is done. Rounds take one block, then as many as all before; a user
    meets only blocks that may still change the result, and travels once for each. Inside a block items lie in cells of
    neighbours of like length, and only cells whose box and length allow a product among the n best are multiplied. Equal products go to the smaller item. Rows: ``id``,
    ``item``, ``rating``, ``place`` from 1. A block and about ``group`` users at a time meet in one task; a block travels as
    often as its users need.
    """
    lengths = items.select("id", "features", _norm("features").alias("_norm"))
    placed = numbered(lengths, [F.desc("_norm"), "id"], "_at").withColumn("_block", F.floor(F.col("_at") / block))
    # An item is a row of its block; a block is put together where its users are.
    blocks = materialize(placed.select("_block", F.col("id").alias("item"), "features", "_norm"), "item-blocks")
    # One number a block.
    held = blocks.groupBy("_block").agg(F.max("_norm").alias("_norm")).orderBy("_block").collect()
    bounds = np.array([r["_norm"] for r in held])
    state = users.select("id", "features", _norm("features").alias("_length"), F.lit(None).cast(BEST).alias("best"))
    state = materialize(state, "users")
    low, high, scored = 0, min(1, len(held)), 0
    while low < high:
        asked = _asked(state, bounds, low, high, n)
        counts = {r["_block"]: r["count"] for r in asked.groupBy("_block").count().collect()}
        if not counts:
            break
        slots = F.create_map(*[F.lit(int(x)) for block, count in counts.items() for x in (block, max(1, -(-count // group)))])
        some = blocks.filter(F.col("_block").isin(*counts)).drop("_norm").withColumn("_slot", F.explode(F.sequence(F.lit(0), slots[F.col("_block")] - 1)))
        asked = asked.withColumn("_slot", F.pmod(F.xxhash64("id"), slots[F.col("_block")]).cast("int"))
        keys = ["_block", "_slot"]
        met = asked.groupBy(*keys).cogroup(some.groupBy(*keys))
        found = materialize(met.applyInArrow(_scored(n), "id int, score double, item int, taken bigint"), "found")
        scored += found.agg(F.sum("taken")).first()[0] or 0
        found = found.filter("item IS NOT NULL").select("id", "score", "item")
        mine = state.select("id", F.inline("best")).select("id", (-F.col("minus")).alias("score"), "item")
        if low:
            found = found.unionAll(mine.join(found.select("id").distinct(), "id", "left_semi"))
        pairs = found.groupBy("id").agg(
            F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "item"))), 1, n).alias("_best")
        )
        state = state.join(pairs, "id", "left").select("id", "features", "_length", F.coalesce("_best", "best").alias("best"))
        state = materialize(state, "users")
        low, high = high, min(2 * high, len(held))
    best = state.select("id", F.posexplode("best").alias("place", "b")).select(
        "id", F.col("b.item").alias("item"), (-F.col("b.minus")).cast("float").alias("rating"), (F.col("place") + 1).alias("place")
    )
    return best, scored


def _asked(state: DataFrame, bounds: np.ndarray, low: int, high: int, n: int) -> DataFrame:
    """A row per user and block from ``low`` to ``high`` that may hold one of the user's n best."""
    worst = F.when(F.size("best") >= n, -F.element_at("best", -1)["minus"])
    rows = state.select("id", "features", "_length", worst.alias("_worst"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("_length").to_numpy(zero_copy_only=False)
            worst = batch.column("_worst").to_numpy(zero_copy_only=False).astype(float)
            for number in range(low, high):
                # Room for the rounding of both lengths.
                may = length * bounds[number] * (1 + 1e-9) >= worst
                here = np.flatnonzero(may | np.isnan(worst))
                if not len(here):
                    # Nor in a later block, whose bound is lower.
                    break
                some = batch.take(pa.array(here))
                ids = some.column("id").to_numpy()
                columns = [pa.array(np.full(len(ids), number)), *[some.column(c) for c in ("id", "features", "_worst")]]
                yield pa.record_batch(columns, names=["_block", "id", "features", "_worst"])

    return rows.mapInArrow(run, "_block bigint, id int, features array<float>, _worst double")


def _cells(factors: np.ndarray, size: int = CELL) -> list[np.ndarray]:
    """The rows of ``factors`` in cells of neighbours: cut in the middle of the widest side until a cell has ``size`` rows or fewer."""
    cells, open_ = [], [np.arange(len(factors))]
    while open_:
        rows = open_.pop()
        if len(rows) <= size:
            cells.append(np.sort(rows))
            continue
        here = factors[rows]
        side = here[:, np.argmax(np.ptp(here, axis=0))]
        order = np.argpartition(side, len(rows) // 2)
        open_ += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    return cells


def _shells(factors: np.ndarray, first: int = 2048) -> list[np.ndarray]:
    """Cells of rows of like length: the longest ``first`` rows, then as many as all before, each cut into cells."""
    order = np.argsort(-np.linalg.norm(factors, axis=1), kind="stable")
    cells, at = [], 0
    while at < len(order):
        rows = order[at : at + max(first, at)]
        cells += [rows[cell] for cell in _cells(factors[rows])]
        at += len(rows)
    return cells


def _best_of(users: np.ndarray, worst: np.ndarray, factors: np.ndarray, items: np.ndarray, cells: list, bounds: tuple, n: int):
    """Of some users: row, score and item of the products that are among the n best and not below ``worst``, and how many
    products were taken. ``cells`` are rows of ``factors``, ``bounds`` the ends of their boxes and their greatest lengths."""
    low, high, length = bounds
    # No product of a user with a cell is greater than that with the best corner of its box, but for rounding.
    most = np.maximum(users, 0) @ high.T + np.minimum(users, 0) @ low.T
    most += 1e-12 * (np.abs(users) @ np.maximum(np.abs(low), np.abs(high)).T)
    np.minimum(most, (1 + 1e-9) * np.linalg.norm(users, axis=1)[:, None] * length, out=most)
    least, taken = worst.copy(), 0
    done = np.zeros(most.shape, bool)
    who, what, scores = [], [], []

    def take(asked: np.ndarray) -> None:
        nonlocal taken
        for cell in np.flatnonzero(asked.any(axis=0)):
            rows, columns = np.flatnonzero(asked[:, cell]), cells[cell]
            products = users[rows] @ factors[columns].T
            taken += products.size
            here = products >= least[rows, None]
            if kept := max(0, products.shape[1] - n):
                here &= products >= np.partition(products, kept, axis=1)[:, kept, None]
            row, column = np.nonzero(here)
            who.append(rows[row])
            what.append(columns[column])
            scores.append(products[row, column])

    def keep() -> None:
        row, column, score = np.concatenate(who), np.concatenate(what), np.concatenate(scores)
        order = np.lexsort((items[column], -score, row))
        row, column, score = row[order], column[order], score[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        last = nth == n - 1
        least[row[last]] = np.maximum(least[row[last]], score[last])
        who[:], what[:], scores[:] = [row[nth < n]], [column[nth < n]], [score[nth < n]]

    # The cells with the best bounds of each user first: they leave few others.
    few = -(-n // CELL) + 1
    for some in (few, 8 * few, len(cells)):
        asked = (most >= least[:, None]) & ~done
        if some < len(cells):
            best = np.zeros(most.shape, bool)
            np.put_along_axis(best, np.argpartition(most, len(cells) - some, axis=1)[:, len(cells) - some :], True, axis=1)
            asked &= best
        done |= asked
        take(asked)
        if who:
            keep()
    if not who:
        return np.zeros(0, int), np.zeros(0), np.zeros(0, np.int32), taken
    return who[0], scores[0], items[what[0]], taken


def _scored(n: int, step: int = 1024):
    """For users and a block of items: the products that are among the n best of the block and not below
    the user's worst, and a row without an item that says how many products were taken."""

    def run(users: pa.Table, block: pa.Table) -> pa.Table:
        matrix = lambda table: (
            table.column("features").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1).astype(float)
        )
        out, total = ([np.zeros(0, np.int32)], [np.zeros(0)], [np.zeros(0, np.int32)]), 0
        if users.num_rows and block.num_rows:
            items, factors = block.column("item").to_numpy(), matrix(block)
            cells = _shells(factors)
            low, high = (np.array([f(factors[rows], axis=0) for rows in cells]) for f in (np.min, np.max))
            lengths = np.linalg.norm(factors, axis=1)
            bounds = low, high, np.array([lengths[rows].max() for rows in cells])
            ids, x = users.column("id").to_numpy(), matrix(users)
            worst = np.nan_to_num(users.column("_worst").to_numpy().astype(float), nan=-np.inf)
            # Users of like direction ask for the same cells.
            for some in _cells(x, step):
                who, score, item, taken = _best_of(x[some], worst[some], factors, items, cells, bounds, n)
                total += taken
                for column, values in zip(out, (ids[some][who], score, item)):
                    column.append(values)
        found = [np.concatenate(c) for c in out]
        columns = [pa.array(c, k) for c, k in zip(found, (pa.int32(), pa.float64(), pa.int32()))]
        names = ["id", "score", "item", "taken"]
        rows = pa.table([*columns, pa.nulls(len(found[0]), pa.int64())], names=names)
        count = pa.table([pa.nulls(1, c.type) for c in columns] + [pa.array([total], pa.int64())], names=names)
        return pa.concat_tables([rows, count])

    return run
