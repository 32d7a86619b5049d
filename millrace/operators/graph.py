"""Property graphs as two tables, and iterative joins over them.

Edges stay partitioned and sorted by their source, so a round shuffles only vertex state and messages,
and messages are combined per target before they leave the map task. Edges of a hub vertex are
divided over slots, each of which gets a copy of the hub's state. Every round ends as a table in the
shared folder: plans stay short, and a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Callable
from copy import copy

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.skew import ROWS_PER_SLOT, Slots, split_join
from millrace.scratch import materialize, written
from millrace.session import ADAPTIVE_ENABLED, SHUFFLE_PARTITIONS, partitions_for


# Neighbours of a vertex that one row holds.
BLOCK = 1_024


class Graph:
    """Vertices with an ``id`` and edges with ``src`` and ``dst``; other columns ride along."""

    def __init__(
        self,
        vertices: DataFrame,
        edges: DataFrame,
        rows_per_slot: int = ROWS_PER_SLOT,
        max_hot: int | None = None,
    ):
        for df, needed in ((vertices, ["id"]), (edges, ["src", "dst"])):
            missing = [c for c in needed if c not in df.columns]
            if missing:
                raise ValueError(f"graph table lacks {missing}")
        self.vertices = vertices
        self.edges = edges
        self.skew = {"rows_per_slot": rows_per_slot, "max_hot": max_hot}

    def in_degrees(self) -> DataFrame:
        """Incoming edges of every vertex that has any, with the vertex attributes."""
        return self._degrees("dst", "in_degree")

    def out_degrees(self) -> DataFrame:
        """Outgoing edges of every vertex that has any, with the vertex attributes."""
        return self._degrees("src", "out_degree")

    def _degrees(self, end: str, name: str) -> DataFrame:
        counts = self.edges.groupBy(F.col(end).alias("id")).agg(F.count("*").alias(name))
        return counts.join(self.vertices, "id")

    def pagerank(self, reset: float = 0.15, rounds: int = 10) -> DataFrame:
        """Vertices with their ``pagerank`` after a fixed number of rounds; ranks sum to the number
        of vertices."""

        def one_round(base: DataFrame, links: _Links, state: DataFrame) -> DataFrame:
            sent = state.filter(F.col("_out").isNotNull()).select(
                "id", (F.col("_rank") / F.col("_out")).alias("_share")
            )
            shares = F.sum(F.col("_share") * F.col("_copies"))
            received = links.send(sent).groupBy("dst").agg(shares.alias("_sum"))
            rank = F.lit(reset) + F.lit(1 - reset) * F.coalesce("_sum", F.lit(0.0))
            return _update(base, received).select("id", "_out", rank.alias("_rank"))

        links = _Links(self, self.edges)
        base = self.vertices.select("id").join(links.out_degrees(), "id", "left")
        state = links.iterate(base, F.lit(1.0).alias("_rank"), one_round, rounds)
        total, vertices = state.agg(F.sum("_rank"), F.count("*")).first()
        scaled = (F.col("_rank") * F.lit(vertices / total if total else 1.0)).alias("pagerank")
        return self.vertices.join(state.select("id", scaled), "id")

    def label_propagation(self, rounds: int = 5) -> DataFrame:
        """Vertices with the ``label`` most of their neighbours have, edges taken both ways.

        Of equally frequent labels the smallest wins, so the result is the same on every run.
        """

        def one_round(base: DataFrame, links: _Links, state: DataFrame) -> DataFrame:
            votes = links.send(state).groupBy("dst", "label").agg(F.sum("_copies").alias("_votes"))
            best = F.min(F.struct((-F.col("_votes")).alias("_order"), "label")).alias("_best")
            won = votes.groupBy("dst").agg(best)
            return _update(base, won).select("id", F.coalesce("_best.label", "id").alias("label"))

        both_ways = self.edges.select("src", "dst").unionAll(
            self.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        )
        links = _Links(self, both_ways)
        start = F.col("id").alias("label")
        state = links.iterate(self.vertices.select("id"), start, one_round, rounds)
        return self.vertices.join(state, "id")

    def triangle_counts(self, block: int = BLOCK) -> DataFrame:
        """Vertices with the number of triangles through them, direction and copies ignored.

        Every edge points from the endpoint of lower degree to the one of higher degree. A vertex
        then has at most sqrt(2 * edges) outgoing edges, hubs included, so its neighbour list is
        bounded. A triangle is an edge plus a vertex that the lists of both endpoints share. Lists are
        cut into blocks of ``block`` neighbours, and blocks meet blocks: a row never holds more than two.
        """
        pairs = (
            self.edges.filter(F.col("src") != F.col("dst"))
            .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
            .distinct()
        )
        pairs = materialize(pairs, "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
        degrees = materialize(ends.groupBy("id").agg(F.count("*").alias("_degree")), "degrees")
        first = degrees.select(F.col("id").alias("a"), F.col("_degree").alias("_da"))
        second = degrees.select(F.col("id").alias("b"), F.col("_degree").alias("_db"))
        ranked = split_join(pairs, first, ["a"], ["b"], **self.skew)
        slots = Slots(pairs, ["b"], **self.skew)
        ranked = split_join(ranked, second, ["b"], ["a"], slots=slots)
        one = F.struct(F.col("_da").alias("degree"), F.col("a").alias("id"))
        other = F.struct(F.col("_db").alias("degree"), F.col("b").alias("id"))
        oriented = ranked.select(
            F.least(one, other)["id"].alias("low"), F.greatest(one, other).alias("high")
        )
        lists = oriented.groupBy("low").agg(F.sort_array(F.collect_list("high")).alias("_highs"))
        whole = F.transform("_highs", lambda high: high["id"])
        last = F.floor((F.size("_highs") - 1) / block).cast("int")
        cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(whole, k * block + 1, F.lit(block)))
        blocks = materialize(lists.select("low", F.posexplode(cut).alias("_block", "_part")), "blocks")
        # An edge to the i-th neighbour can only close with a neighbour after the i-th: one behind it in its
        # block, or one in a later block, which meets the blocks before it one by one.
        behind = (
            blocks.select("low", "_part", F.posexplode("_part").alias("_i", "high"))
            .select("low", "high", F.slice("_part", F.col("_i") + 2, F.size("_part")).alias("_rest"))
            .filter(F.size("_rest") > 0)
        )
        earlier = F.explode(F.sequence(F.lit(0), F.col("_block") - 1)).alias("_block")
        later = blocks.filter(F.col("_block") > 0).select("low", earlier, F.col("_part").alias("_rest"))
        beyond = blocks.join(later, ["low", "_block"]).select("low", F.explode("_part").alias("high"), "_rest")
        edges = behind.unionAll(beyond)
        targets = blocks.select(F.col("low").alias("high"), F.col("_part").alias("_far"))
        hot = Slots(blocks.select(F.explode("_part").alias("high")), ["high"], **self.skew)
        met = split_join(edges, targets, ["high"], ["low"], slots=hot)
        closed = met.select(
            "low", "high", F.array_intersect("_rest", "_far").alias("_third")
        ).filter(F.size("_third") > 0)
        size = F.size("_third").cast("bigint")
        corners = F.concat(
            F.array(
                F.struct(F.col("low").alias("id"), size.alias("n")),
                F.struct(F.col("high").alias("id"), size.alias("n")),
            ),
            F.transform(
                "_third", lambda v: F.struct(v.alias("id"), F.lit(1).cast("bigint").alias("n"))
            ),
        )
        counts = closed.select(F.inline(corners)).groupBy("id").agg(F.sum("n").alias("_n"))
        return self.vertices.join(counts, "id", "left").select(
            *self.vertices.columns, F.coalesce("_n", F.lit(0)).alias("triangles")
        )


class _Links:
    """Edges kept partitioned by source for all rounds; hub sources are divided over slots.

    Copies of an edge are one row with their number, so that only distinct targets fill a slot.
    """

    def __init__(self, graph: Graph, edges: DataFrame):
        counted = edges.groupBy("src", "dst").agg(F.count("*").alias("_copies"))
        self.table = materialize(counted, "links")
        self.slots = Slots(self.table, ["src"], **graph.skew)
        self.keys = ["src", "_slot"] if self.slots else ["src"]
        self.edges = self.table
        if self.slots:
            self.edges = self.slots.scatter(self.table, ["src"], [F.col("dst")])

    def out_degrees(self) -> DataFrame:
        return self.table.groupBy(F.col("src").alias("id")).agg(F.sum("_copies").alias("_out"))

    def send(self, state: DataFrame) -> DataFrame:
        """State of every source, once per edge, next to the edge's ``dst``."""
        state = state.withColumnRenamed("id", "src")
        if self.slots:
            state = self.slots.replicate(state, ["src"])
        return self.edges.hint("merge").join(state, self.keys)

    def iterate(
        self,
        base: DataFrame,
        start: Column,
        one_round: Callable[[DataFrame, _Links, DataFrame], DataFrame],
        rounds: int,
    ) -> DataFrame:
        """State after some rounds, from ``start`` in every vertex.

        Edges and ``base``, a row per vertex, are laid out once, in as many partitions as their size
        asks for, and the shuffles of a round go to the same number. That leaves adaptive execution
        nothing to decide, so a round is one job without re-planning between its stages.
        """
        spark = base.sparkSession
        # The rounds have settings of their own, in a session of their own: the caller's other queries
        # go on with theirs.
        own = spark.newSession()
        base = _reopened(own, base, "vertices")
        partitions = partitions_for(spark, max(self.table.count(), base.count()))
        for name, value in {SHUFFLE_PARTITIONS: str(partitions), ADAPTIVE_ENABLED: "false"}.items():
            own.conf.set(name, value)
        state = base.select("*", start)
        base = _kept(base, partitions, "id")
        # A copy, so that the links themselves stay in the caller's session.
        mine = copy(self)
        mine.edges = _kept(_reopened(own, self.edges, "edges"), partitions, *self.keys)
        mine.slots = self.slots.in_session(own) if self.slots else self.slots
        path = None
        for _ in range(rounds):
            after = one_round(base, mine, state)
            path = written(after, "round")
            state = own.read.schema(after.schema).parquet(path)
        mine.edges.unpersist()
        base.unpersist()
        return spark.read.schema(state.schema).parquet(path) if path else _reopened(spark, state, "state")


def _reopened(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Written by the session it belongs to, read by ``spark``."""
    return spark.read.schema(df.schema).parquet(written(df, label))


def _update(base: DataFrame, received: DataFrame) -> DataFrame:
    """Base rows with what they received; both sides are partitioned by vertex already."""
    return base.hint("merge").join(received, base["id"] == received["dst"], "left")


def _kept(df: DataFrame, partitions: int, *columns: str) -> DataFrame:
    """Partitioned and sorted by ``columns`` and kept, on disk where memory ends, so that a merge
    join reads it as it is; a lost block is recomputed."""
    laid_out = df.repartition(partitions, *columns).sortWithinPartitions(*columns)
    return laid_out.persist(StorageLevel.MEMORY_AND_DISK)


def unique_nodes(df: DataFrame, key: str) -> DataFrame:
    """One row per node key, the least one where rows differ, so that every run keeps the same."""
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    least = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return least.select(key, "_row.*")


def matched_relationships(
    edges: DataFrame,
    nodes: DataFrame,
    key: str = "id",
    rows_per_slot: int = ROWS_PER_SLOT,
    max_hot: int | None = None,
) -> DataFrame:
    """Edges whose two endpoints both exist as nodes."""
    sources = nodes.select(F.col(key).alias("src"))
    targets = nodes.select(F.col(key).alias("dst"))
    skew = {"rows_per_slot": rows_per_slot, "max_hot": max_hot}
    kept = split_join(edges, sources, ["src"], ["dst"], "left_semi", **skew)
    return split_join(kept, targets, ["dst"], ["src"], "left_semi", **skew).select(*edges.columns)
