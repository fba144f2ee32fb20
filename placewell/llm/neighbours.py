"""Approximate nearest neighbours: an NN-descent graph and greedy search in it.

Each distinct vector is a node. A first graph comes from random-projection leaves; each
round of NN-descent then joins nodes with the neighbours of their neighbours and keeps
the best. A pair is looked at only if one of its two edges is new since the last round,
and leaves its task only if it is better than the worst that a node has. Rounds work on
vectors coded in one byte per component, each in its own unit; scores that are returned
are worked out in double precision from the vectors as given. Trees and pools grow with
the logarithm of the number of nodes.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placewell.llm.components import discard, stored

K = 24  # neighbours of a node in the graph
TREES = 6  # for START nodes; one more for each doubling
START = 10_000
LEAF = 128
SALT = 16  # tasks that the rows of a full leaf are dealt to
SETTLED = 0.01  # share of the edges; the round that changes no more is the last
SAMPLE = 12  # old neighbours, and new and old reverse ones, that a node joins in a round
FIT_ROWS = 4096  # rows at most that the projections' medians are taken from
NEAREST = 20
POOL = 160  # best nodes that a query holds during its search, for START nodes
MORE_POOL = 40  # for each doubling
EXPANDED = 24  # nodes that a query looks beyond in a round of its search
SCALE_BYTES = 8  # of a code: the vector's own unit in double precision, then a byte per component
STRIDE = 20  # rows whose id this divides are queries


# ---- vectors of a task ----------------------------------------------------------------

def matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Components of codes of equal length as rows, and what each row is to be multiplied with."""
    if not len(column):
        return np.zeros((0, 1), np.float32), np.zeros(0)
    data = np.frombuffer(b"".join(x.as_py() for x in column), np.int8).reshape(len(column), -1)
    return data[:, SCALE_BYTES:].astype(np.float32), data[:, :SCALE_BYTES].copy().view(np.float64)[:, 0]


def group_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows, cut so that the rows of a key stay together."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            held = None
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield batch.slice(0, cut)
        held = batch.slice(cut)
    if held is not None and held.num_rows:
        yield held


def best_in_groups(batches: Iterator[pa.RecordBatch], key: str, keep: int) -> Iterator[pa.RecordBatch]:
    """For each node of a group, its ``keep`` best others in that group: node, other, score.

    Where rows say so in ``fresh`` and ``least``, only pairs with a fresh member count, and
    only scores above a node's least.
    """
    for batch in group_runs(batches, key):
        keys = batch.column(key).to_numpy()
        nodes = batch.column("node").to_numpy()
        codes, units = matrix(batch.column("code"))
        flagged = "fresh" in batch.schema.names
        if flagged:
            fresh = batch.column("fresh").to_numpy(zero_copy_only=False)
            least = batch.column("least").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        out = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a < 2 or flagged and not fresh[a:b].any():
                continue
            score = (codes[a:b] @ codes[a:b].T).astype(np.float64) * (units[a:b, None] * units[a:b])
            np.fill_diagonal(score, -np.inf)
            if flagged:
                score[~(fresh[a:b, None] | fresh[a:b]) | (score <= least[a:b, None])] = -np.inf
            n = min(keep, b - a - 1)
            top = np.argpartition(-score, n - 1, axis=1)[:, :n] if n < b - a - 1 else np.argsort(-score, axis=1)[:, :n]
            rows = np.repeat(np.arange(b - a), n)
            best = score[rows, top.ravel()]
            ok = best > -np.inf
            out.append((nodes[a:b][rows[ok]], nodes[a:b][top.ravel()[ok]], best[ok]))
        if out:
            left, right, score = (np.concatenate(x) for x in zip(*out, strict=True))
            ok = left != right
            yield pa.RecordBatch.from_arrays(
                [pa.array(left[ok]), pa.array(right[ok]), pa.array(score[ok].astype(np.float64))],
                ["node", "other", "score"])


EDGE = "node bigint, other bigint, score double"


# ---- the graph ------------------------------------------------------------------------

def valid_vectors(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and vector of the rows that take part: no null, not zero, all components finite, usual length."""
    v = F.col(vector_column).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    found = rows.where(F.col(id_column).isNotNull() & v.isNotNull()).select(
        F.col(id_column).alias("id"), v.alias("vector")).where(
        ~bad & F.exists("vector", lambda x: x != 0))
    usual = found.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "size").first()  # one row
    return found.where(F.size("vector") == (usual["size"] if usual else 0))


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """node, vector, code and the ``most`` smallest ids of each distinct vector."""
    key = F.unhex(F.md5(F.concat_ws(",", F.col("vector").cast("array<string>"))))
    held = rows.withColumn("key", key)
    first = Window.partitionBy("key").orderBy("id")
    top = held.withColumn("turn", F.row_number().over(first)).where(F.col("turn") <= most)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = np.array([x.values.to_numpy() for x in batch.column("vector")]).reshape(batch.num_rows, -1)
            unit = np.abs(wide).max(axis=1, keepdims=True, initial=0.0)
            codes = np.rint(wide / unit * 127).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("ids"), batch.column("vector"),
                 pa.array([u.tobytes() + c.tobytes() for u, c in zip(unit / 127, codes, strict=True)], pa.binary())],
                ["key", "ids", "vector", "code"])

    nodes = top.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    return nodes.mapInArrow(
        code, f"key binary, ids array<{kind}>, vector array<double>, code binary",
    ).withColumn("node", F.monotonically_increasing_id())


def heights(column: pa.Array, planes: np.ndarray) -> np.ndarray:
    codes, units = matrix(column)
    return (codes @ planes.T).astype(np.float64) * units[:, None]


def doublings(count: int) -> int:
    return max(0, int(np.ceil(np.log2(max(count, 1) / START))))


def leaves(nodes: DataFrame, count: int, dims: int) -> DataFrame:
    """leaf, node and code: one leaf per tree, by the sides of random planes."""
    trees = TREES + doublings(count)
    depth = max(0, int(np.ceil(np.log2(max(count, 1) / LEAF))))
    rng = np.random.default_rng(7)
    planes = rng.standard_normal((trees * depth, dims)).astype(np.float32)
    fit = nodes.orderBy(F.xxhash64("node")).limit(FIT_ROWS).select("code").toArrow()["code"].combine_chunks()
    middle = np.median(heights(fit, planes), axis=0) if depth and len(fit) else np.zeros(trees * depth)
    held = nodes.sparkSession.sparkContext.broadcast((planes, middle))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, middle = held.value
        for batch in batches:
            side = (heights(batch.column("code"), planes) > middle).astype(np.int64)
            powers = 1 << np.arange(depth, dtype=np.int64)
            for t in range(trees):
                leaf = side[:, t * depth:(t + 1) * depth] @ powers + (t << 40)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf.astype(np.int64)), batch.column("node"), batch.column("code")], ["leaf", "node", "code"])

    found = nodes.select("node", "code").mapInArrow(place, "leaf bigint, node bigint, code binary")
    # A full leaf is dealt into parts of about LEAF nodes; its rows learn that in SALT tasks.
    sizes = found.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * LEAF).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALT)).cast("int"))
    part = F.pmod(F.xxhash64(F.lit(1), "node"), F.ceil(F.coalesce("n", F.lit(1)) / LEAF))
    return salted.join(sizes, ["leaf", "salt"], "left").select(
        F.xxhash64("leaf", part).alias("leaf"), "node", "code")


def in_groups(rows: DataFrame, key: str, keep: int) -> DataFrame:
    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(
        lambda batches: best_in_groups(batches, key, keep), EDGE)


def nearest_only(edges: DataFrame, k: int) -> DataFrame:
    """The k best others of each node, with their rank ``turn``; an edge is fresh if all its rows are."""
    once = edges.repartition("node").groupBy("node", "other").agg(
        F.max("score").alias("score"), F.min("fresh").alias("fresh"))
    ordered = Window.partitionBy("node").orderBy(F.desc("score"), "other")
    return once.withColumn("turn", F.row_number().over(ordered)).where(F.col("turn") <= k)


def neighbour_graph(nodes: DataFrame, k: int = K) -> DataFrame:
    """node, other, score and turn (1: nearest) for the k nearest found of each node."""
    count = nodes.count()
    first = nodes.select(F.length("code")).first()
    start = in_groups(leaves(nodes, count, first[0] - SCALE_BYTES if first else 1), "leaf", k)
    graph = stored(nearest_only(start.withColumn("fresh", F.lit(True)), k), "graph")
    for turn in itertools.count():
        # A node's own neighbours and the nodes it is a neighbour of meet at that node.
        back = graph.select(F.col("other").alias("centre"), "node", "fresh")
        order = Window.partitionBy("centre", "fresh").orderBy(F.xxhash64(F.lit(turn), "node", "centre"), "node")
        back = back.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= SAMPLE).drop("turn")
        ahead = graph.where(F.col("fresh") | (F.pmod(F.xxhash64(F.lit(turn), "node", "other"), F.lit(k)) < SAMPLE))
        around = ahead.select(F.col("node").alias("centre"), F.col("other").alias("node"), "fresh").unionByName(
            back).groupBy("centre", "node").agg(F.max("fresh").alias("fresh"))
        met = around.unionByName(around.where("fresh").select(
            "centre", F.col("centre").alias("node"), F.lit(False).alias("fresh")).distinct())
        least = graph.where(F.col("turn") == k).select("node", F.col("score").alias("least"))
        known = nodes.select("node", "code").join(least, "node", "left").select(
            "node", "code", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
        found = in_groups(met.join(known, "node"), "centre", k)
        before = graph
        graph = stored(nearest_only(before.select("node", "other", "score", F.lit(False).alias("fresh")).unionByName(
            found.withColumn("fresh", F.lit(True))), k), "graph")
        discard(before)
        fresh, edges = graph.agg(F.count_if("fresh"), F.count(F.lit(1))).first()
        if fresh <= SETTLED * edges:
            return graph


# ---- search ---------------------------------------------------------------------------

def adjacency(graph: DataFrame, k: int = K) -> DataFrame:
    """node and around: its neighbours and some of the nodes that have it as theirs."""
    back = graph.select(F.col("other").alias("node"), F.col("node").alias("other"))
    order = Window.partitionBy("node").orderBy(F.xxhash64("node", "other"), "other")
    back = back.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= k)
    return graph.select("node", "other").unionByName(back.select("node", "other")).groupBy("node").agg(
        F.collect_set("other").alias("around"))


def scored(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """query, node and score by codes, for pairs of query and node."""

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (a, a_unit), (b, b_unit) = matrix(batch.column("a")), matrix(batch.column("b"))
            score = np.einsum("ij,ij->i", a, b).astype(np.float64) * a_unit * b_unit if len(a) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("node"),
                 pa.array(score)],
                ["query", "node", "score"])

    code = nodes.select("node", F.col("code").alias("b"))
    own = nodes.select(F.col("node").alias("query"), F.col("code").alias("a"))
    return pairs.join(code, "node").join(own, "query").select("query", "node", "a", "b").mapInArrow(
        product, "query bigint, node bigint, score double")


def greedy_search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, pool: int = POOL) -> DataFrame:
    """query, node and score by codes: the best nodes found for each query (a node itself).

    A query starts with its own neighbours. In each round it looks beyond the best nodes
    that it has not looked beyond yet, and it ends when these add nothing to its pool.
    """
    around = stored(adjacency(graph), "around")
    held = stored(queries.join(graph.withColumnRenamed("node", "query"), "query").select(
        "query", F.col("other").alias("node"), "score", F.lit(False).alias("seen")), "pool")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    while True:  # a node is looked beyond once
        ranked = held.withColumn("open", F.row_number().over(
            Window.partitionBy("query", "seen").orderBy(F.desc("score"), "node")))
        ahead = ranked.where(~F.col("seen") & (F.col("open") <= EXPANDED)).select("query", "node")
        if ahead.isEmpty():
            break
        beyond = ahead.join(around, "node").select("query", F.explode("around").alias("node")).where(
            "query <> node").distinct().join(held.select("query", "node"), ["query", "node"], "left_anti")
        marked = ranked.withColumn("seen", F.col("seen") | (F.col("open") <= EXPANDED)).drop("open")
        before = held
        held = stored(marked.unionByName(scored(beyond, nodes).withColumn("seen", F.lit(False)))
                      .withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= pool).drop("turn"), "pool")
        discard(before)
    return held


def nearest(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
    stride: int = STRIDE, k: int = NEAREST,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id ``stride`` divides.

    Nearness is the largest inner product in double precision; ties go to the smaller id.
    Candidates are all rows but the query's own. Rows with a null id, and vectors that are
    null, zero, of an unusual length, or hold a null or non-finite component take no part.
    Copies of a vector are one node and are told apart at the end; rows of one id are one
    candidate each and never their own query's. Other columns are not read. With fewer
    candidates than k all are returned; no rows give no rows.
    """
    valid = stored(valid_vectors(rows, id_column, vector_column), "vectors")
    nodes = stored(distinct_vectors(valid, k + 1), "nodes")
    graph = neighbour_graph(nodes)
    key = F.unhex(F.md5(F.concat_ws(",", F.col("vector").cast("array<string>"))))
    asked = valid.where(F.pmod(F.col("id"), F.lit(stride)) == 0).select(F.col("id").alias("query_id"), key.alias("key")).distinct()
    asked = stored(asked.join(nodes.select("key", "node"), "key").select("query_id", "node"), "queries")
    queries = asked.select(F.col("node").alias("query")).distinct()
    found = greedy_search(queries, graph, nodes, POOL + MORE_POOL * doublings(nodes.count()))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    short = found.withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= 2 * k + 8).select("query", "node")
    near = short.unionByName(queries.select("query", F.col("query").alias("node"))).join(
        nodes.select("node", "ids", F.col("vector").alias("b")), "node").join(
        nodes.select(F.col("node").alias("query"), F.col("vector").alias("a")), "query")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = [np.array([x.values.to_numpy() for x in batch.column(c)]).reshape(batch.num_rows, -1) for c in "ab"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("ids"), pa.array(np.einsum("ij,ij->i", *wide))],
                ["query", "ids", "score"])

    kind = nodes.schema["ids"].dataType.simpleString()
    lists = near.select("query", "ids", "a", "b").mapInArrow(exact, f"query bigint, ids {kind}, score double").select(
        "query", "score", F.explode("ids").alias("vec_id"))
    # One more than asked for, since the query's own row is among them.
    top = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    lists = lists.withColumn("turn", F.row_number().over(top)).where(F.col("turn") <= k + 1).groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("turn", "vec_id", "score"))).alias("found"))
    return asked.withColumnRenamed("node", "query").join(lists, "query").select(
        "query_id", F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("found"),
    ).select("query_id", F.posexplode("found").alias("at", "f")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))
