"""Approximate nearest neighbours by NN-descent and greedy graph search.

The index is a graph: every distinct vector is a node and knows its nearest
other nodes as far as they have been found. A first graph comes from blocks of
vectors on the same side of random planes. NN-descent then improves it: a
neighbour's neighbour is likely to be a neighbour, so in each round every node
meets its neighbours and some of those that it is a neighbour of, all of these
are compared with each other, and each keeps its nearest. A round is a chain of
Spark joins and shuffles over edges; rounds end when few edges change.

A search is greedy: of the nearest nodes a query has seen, those it has not
visited yet are visited, and their neighbours are seen, until the query has
visited all of its nearest. All queries take their next steps in one join with
the graph, which is stored bucketed by node with the neighbours' vectors, so
that only queries are shuffled.

Graph and search work on vectors of bytes; the nearest nodes found are compared
by the exact cosine of the original vectors. Equal vectors are one node, which
keeps the rows of least id, as many as an answer can hold.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulwise.llm.common import shuffle_width, whole_groups
from haulwise.session import cut_lineage, scratch_path

CODE = "code binary, norm double"


def usable(vector: Column) -> Column:
    """Not null, all components there and finite, and one of them not 0."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _lists(column: pa.Array, width: int) -> np.ndarray:
    """Rows of numbers, shorter ones filled up with zeros, each scaled by a
    power of two to components of 1 at most (which changes no cosine)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return np.ldexp(out, -np.frexp(np.abs(out).max(axis=1, initial=0))[1][:, None])


def _coded(width: int):
    """(node, code, norm): the vector in bytes, and the length of those."""

    def coded(batches):
        for batch in batches:
            v = _lists(batch.column(1), width)
            code = np.rint(v / np.abs(v).max(axis=1, initial=0, keepdims=True) * 127).astype(np.int8)
            norm = np.sqrt((code.astype(np.float64) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(norm)],
                names=["node", "code", "norm"])

    return coded


def _codes(column: pa.Array, width: int) -> np.ndarray:
    """Exact in products: sums of squares of bytes, as doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int8).reshape(-1, width).astype(np.float64)


def _planes(width: int, trees: int, bits: int, seed: int):
    """(tree, block, node, code, norm): for each tree the side of its random
    planes that a vector is on."""

    def sides(batches):
        planes = np.random.default_rng(seed).normal(size=(width, trees * bits))
        weights = 1 << np.arange(bits)
        for batch in batches:
            side = (_codes(batch.column(1), width) @ planes > 0).reshape(batch.num_rows, trees, bits)
            block = (side * weights).sum(axis=2)
            n = batch.num_rows
            at = pa.array(np.repeat(np.arange(n), trees))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(trees, dtype=np.int32), n)), pa.array(block.ravel().astype(np.int64)),
                 *(c.take(at) for c in batch.columns)], names=["tree", "block", "node", "code", "norm"])

    return sides


def _best(scores: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``most`` highest scores of each row, and the scores."""
    most = min(most, scores.shape[-1])
    at = np.argpartition(-scores, most - 1, axis=-1)[..., :most]
    return at, np.take_along_axis(scores, at, -1)


def _edges(a, b, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(score, pa.float64())],
                                      names=["a", "b", "score"])


def _within_blocks(width: int, most: int, keys: int):
    """(a, b, score): of every node, the nearest of its group."""

    def within(batches):
        for rows, cuts in whole_groups(batches, keys):
            nodes, norm = (rows.column(k).to_numpy() for k in ("node", "norm"))
            codes = rows.column("code").combine_chunks()
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if hi - lo < 2:
                    continue
                v, own = _codes(codes[lo:hi], width), nodes[lo:hi]
                scores = (v @ v.T) / (norm[lo:hi][:, None] * norm[lo:hi][None, :])
                np.fill_diagonal(scores, -3)
                at, best = _best(scores, min(most, hi - lo - 1))
                yield _edges(np.repeat(own, at.shape[1]), own[at].ravel(), best.ravel())

    return within


def _among_members(width: int, most: int, members: int):
    """(a, b, score): of the members of every centre (centre, node, code, norm,
    floor; sorted by centre), for each the nearest others above its floor."""

    def among(batches):
        for rows, cuts in whole_groups(batches):
            nodes, norm, floor = (rows.column(k).to_numpy() for k in ("node", "norm", "floor"))
            v = _codes(rows.column("code").combine_chunks(), width)
            for lo in range(0, len(cuts) - 1, 256):  # centres whose products are taken at a time
                edges = cuts[lo:lo + 257]
                size = np.diff(edges)
                wide = int(size.max())
                there = np.arange(wide) < size[:, None]
                at = np.where(there, edges[:-1][:, None] + np.arange(wide), edges[0])
                scores = v[at] @ v[at].transpose(0, 2, 1)
                scores /= norm[at][:, :, None] * norm[at][:, None, :]
                scores[~np.broadcast_to(there[:, None, :], scores.shape)] = -3
                scores[:, np.arange(wide), np.arange(wide)] = -3
                other, best = _best(scores, most)
                good = (best > np.maximum(floor[at], -2)[:, :, None]) & there[:, :, None]
                a = np.broadcast_to(nodes[at][:, :, None], good.shape)[good]
                b = np.take_along_axis(np.broadcast_to(nodes[at][:, None, :], scores.shape), other, 2)[good]
                yield _edges(a, b, best[good])

    return among


def _nearest(edges: DataFrame, most: int) -> DataFrame:
    """``(node, near, kept)``: of each node ``a`` the ``most`` nearest of its
    edges (a, b, score, old) as an array of (score, b), falling, and how many of
    them are old. Edges that repeat have equal scores and rank alike, so each
    task passes on few of a node's edges."""
    rank = F.dense_rank().over(Window.partitionBy("a").orderBy(F.desc("score"), "b"))
    near = F.sort_array(F.collect_set(F.struct("score", "b")), asc=False)
    return (edges.withColumn("_rank", rank).where(F.col("_rank") <= most)
            .groupBy(F.col("a").alias("node")).agg(near.alias("near"), F.count_if("old").alias("kept")))


def first_graph(codes: DataFrame, nodes: int, width: int, *, neighbours: int, trees: int, block: int, seed: int) -> DataFrame:
    """Neighbours among the nodes of the same blocks. A block that holds more
    than twice the even share is cut by node hash."""
    bits = max(0, int(np.ceil(np.log2(max(1, nodes / block)))))
    sides = codes.mapInArrow(_planes(width, trees, bits, seed), f"tree int, block long, node long, {CODE}")
    sides = cut_lineage(sides, "neighbours-blocks")
    large = cut_lineage(sides.groupBy("tree", "block").count().where(F.col("count") > 2 * block)
                        .select("tree", "block", F.ceil(F.col("count") / block).alias("cuts")), "neighbours-large")
    cut = F.coalesce(F.pmod(F.xxhash64("node", "tree"), F.col("cuts")), F.lit(0))
    dealt = sides.join(large, ["tree", "block"], "left").select("tree", "block", cut.alias("cut"), "node", "code", "norm")
    groups = dealt.repartition(shuffle_width(codes), "tree", "block", "cut").sortWithinPartitions("tree", "block", "cut")
    edges = groups.mapInArrow(_within_blocks(width, -(-3 * neighbours // 8), 3), "a long, b long, score double")
    return _nearest(edges.withColumn("old", F.lit(False)), neighbours)


def _edges_of(graph: DataFrame) -> DataFrame:
    return graph.select(F.col("node").alias("a"), F.explode("near").alias("e")).select("a", "e.b", "e.score")


def descend(codes: DataFrame, graph: DataFrame, width: int, round_: int, *, neighbours: int, reverse: int, most: int) -> DataFrame:
    """One round: all neighbours of a node, and up to ``reverse`` nodes that it
    is a neighbour of, are compared with each other."""
    edges = _edges_of(graph)
    back = Window.partitionBy("b").orderBy(F.xxhash64("a", F.lit(round_)))
    back = edges.withColumn("_at", F.row_number().over(back)).where(F.col("_at") <= reverse)
    members = (edges.select(F.col("a").alias("centre"), F.col("b").alias("node"))
               .unionByName(back.select(F.col("b").alias("centre"), F.col("a").alias("node"))).distinct())
    full = F.when(F.size("near") >= neighbours, F.element_at("near", -1)["score"])
    floors = graph.select("node", full.alias("floor"))
    known = codes.join(floors, "node", "left").select("node", "code", "norm", F.coalesce("floor", F.lit(-2.0)).alias("floor"))
    groups = (members.join(known, "node").select("centre", "node", "code", "norm", "floor")
              .repartition(shuffle_width(codes), "centre").sortWithinPartitions("centre"))
    found = groups.mapInArrow(_among_members(width, most, neighbours + reverse), "a long, b long, score double")
    return _nearest(edges.withColumn("old", F.lit(True)).unionByName(found.withColumn("old", F.lit(False))), neighbours)


def build_graph(codes: DataFrame, width: int, *, neighbours: int = 32, reverse: int = 16, trees: int = 8, block: int = 512,
                rounds: int = 4, settled: float = 0.1, seed: int = 0) -> DataFrame:
    """``(node, near)``: up to ``neighbours`` of each of ``codes`` (node, code,
    norm). Ends after ``rounds``, or when a round has changed no more than the
    share ``settled`` of the neighbours."""
    graph = cut_lineage(first_graph(codes, codes.count(), width, neighbours=neighbours, trees=trees, block=block, seed=seed),
                        "neighbours-graph")
    for k in range(rounds):
        graph = cut_lineage(descend(codes, graph, width, k, neighbours=neighbours, reverse=reverse, most=6), "neighbours-graph")
        old, all_ = graph.agg(F.sum("kept"), F.sum(F.size("near"))).first()
        if not all_ or all_ - old <= settled * all_:
            break
    return graph.select("node", "near")


def _packed(batches):
    """(node, ids, codes, norms): a row for the neighbours of each node."""
    for rows, cuts in whole_groups(batches):
        ids, norms = (rows.column(k).combine_chunks() for k in ("near", "norm"))
        codes = rows.column("code").to_pylist()
        edges = pa.array(cuts, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [rows.column("node").combine_chunks().take(pa.array(cuts[:-1])), pa.ListArray.from_arrays(edges, ids),
             pa.array([b"".join(codes[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()),
             pa.ListArray.from_arrays(edges, norms)], names=["node", "ids", "codes", "norms"])


class StoredGraph:
    """The graph in both directions, each node with its neighbours' vectors, as
    a table bucketed by node; dropped from the catalog in the end."""

    def __init__(self, codes: DataFrame, graph: DataFrame, degree: int) -> None:
        self.spark = codes.sparkSession
        edges = _edges_of(graph)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
        linked = (_nearest(both.withColumn("old", F.lit(False)), degree)
                  .select("node", F.explode("near.b").alias("near")))
        width = shuffle_width(codes)
        held = codes.select(F.col("node").alias("near"), "code", "norm")
        rows = (linked.join(held, "near").select("node", "near", "code", "norm")
                .repartition(width, "node").sortWithinPartitions("node", "near")
                .mapInArrow(_packed, "node long, ids array<long>, codes binary, norms array<double>"))
        self.name = f"haulwise_graph_{uuid.uuid4().hex}"
        (rows.write.option("path", scratch_path(self.spark, "neighbours-stored")).bucketBy(width, "node")
         .format("parquet").saveAsTable(self.name))
        self.rows = self.spark.table(self.name)

    def __enter__(self) -> DataFrame:
        return self.rows

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


STATE = "query long, code binary, norm double, ids array<long>, scores array<double>, done array<boolean>"


def _start(width: int, entries: pa.Table, beam: int, ways: int):
    """The state of queries (query, code, norm, own): the node of their own, if
    any, and the nearest entries, ``ways`` of which are to be visited."""

    def start(batches):
        nodes, norms = entries.column("node").to_numpy(), entries.column("norm").to_numpy()
        v = _codes(entries.column("code").combine_chunks(), width)
        for batch in batches:
            scores = (_codes(batch.column(1), width) @ v.T) / (batch.column(2).to_numpy()[:, None] * norms)
            ids, kept, done = [], [], []
            for row, own in zip(scores, batch.column(3).to_pylist(), strict=True):
                order = np.lexsort((nodes, -row))
                order = order[nodes[order] != own][:beam]
                first = [] if own is None else [own]
                ids.append([*first, *nodes[order].tolist()][:beam])
                kept.append([*([1.0] * len(first)), *row[order].tolist()][:beam])
                done.append([*([False] * len(first)), *(k >= ways for k in range(len(order)))][:beam])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(ids, pa.list_(pa.int64())), pa.array(kept, pa.list_(pa.float64())),
                 pa.array(done, pa.list_(pa.bool_()))], names=["query", "code", "norm", "ids", "scores", "done"])

    return start


def _next(beam: int, step: int):
    """(query, code, norm, floor, node): what queries visit next."""

    def visits(batches):
        for batch in batches:
            row, nodes, floors = [], [], []
            for k, (ids, scores, done) in enumerate(zip(*(batch.column(j).to_pylist() for j in (3, 4, 5)), strict=True)):
                new = [i for i, d in zip(ids, done, strict=True) if not d][:step]
                row += [k] * len(new)
                nodes += new
                floors += [scores[-1] if len(ids) >= beam else -2.0] * len(new)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(at) for k in range(3)), pa.array(floors, pa.float64()), pa.array(nodes, pa.int64())],
                names=["query", "code", "norm", "floor", "node"])

    return visits


def _see(width: int):
    """(query, ids, scores): the neighbours of a visited node that are nearer
    than the query's floor, of rows (query, code, norm, floor, ids, codes, norms)."""

    def see(batches):
        for batch in batches:
            ids, kept = [], []
            own, norm = _codes(batch.column(1), width), batch.column(2).to_numpy()
            for k, (near, codes, norms) in enumerate(zip(*(batch.column(j) for j in (4, 5, 6)), strict=True)):
                v = np.frombuffer(codes.as_py(), np.int8).reshape(-1, width).astype(np.float64)
                score = (v @ own[k]) / (norm[k] * norms.values.to_numpy())
                good = score > batch.column(3)[k].as_py()
                ids.append(near.values.to_numpy()[good])
                kept.append(score[good])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int64())), pa.array(kept, pa.list_(pa.float64()))],
                names=["query", "ids", "scores"])

    return see


def _advance(beam: int, step: int):
    """The state of a query after a step: what it has visited is done, and what
    it has seen takes its place among the nearest."""

    def advance(state: pa.Table, seen: pa.Table) -> pa.Table:
        ids, scores = (state.column(k)[0].values.to_numpy() for k in ("ids", "scores"))
        done = state.column("done")[0].values.to_numpy(zero_copy_only=False).astype(bool)
        done[np.flatnonzero(~done)[:step]] = True
        parts = [x for x in seen.column("ids") if len(x)]
        if parts:
            new = np.concatenate([x.values.to_numpy() for x in parts])
            new_scores = np.concatenate([x.values.to_numpy() for x in seen.column("scores") if len(x)])
            new, first = np.unique(new, return_index=True)
            fresh = ~np.isin(new, ids)
            new, new_scores = new[fresh], new_scores[first[fresh]]
            ids, scores = np.concatenate([ids, new]), np.concatenate([scores, new_scores])
            done = np.concatenate([done, np.zeros(len(new), bool)])
            order = np.lexsort((ids, -scores))[:beam]
            ids, scores, done = ids[order], scores[order], done[order]
        one = pa.array([0, len(ids)], pa.int32())
        return pa.table([*(state.column(k) for k in ("query", "code", "norm")),
                         *(pa.ListArray.from_arrays(one, pa.array(x)) for x in (ids, scores, done))],
                        names=["query", "code", "norm", "ids", "scores", "done"])

    return advance


def search_graph(stored: DataFrame, codes: DataFrame, queries: DataFrame, width: int, *, beam: int = 160, step: int = 64,
                 entries: int = 1024, ways: int = 4) -> DataFrame:
    """``(query, ids)``: the ``beam`` nearest nodes that each of ``queries``
    (query, code, norm, own) finds. ``own``: the node that a query is itself,
    where it starts, or null. Other starts are the ``ways`` nearest of
    ``entries`` nodes, picked by hash. A query is done when all of its ``beam``
    nearest have been visited; it visits up to ``step`` at a time."""
    picked = codes.orderBy(F.xxhash64("node"), "node").limit(entries).toArrow()
    state = cut_lineage(queries.select("query", "code", "norm", "own").mapInArrow(_start(width, picked, beam, ways), STATE),
                        "neighbours-state")
    while not state.where(F.exists("done", lambda d: ~d)).isEmpty():
        visits = state.mapInArrow(_next(beam, step), f"query long, {CODE}, floor double, node long")
        seen = (visits.join(stored, "node").select("query", "code", "norm", "floor", "ids", "codes", "norms")
                .mapInArrow(_see(width), "query long, ids array<long>, scores array<double>"))
        state = cut_lineage(state.groupBy("query").cogroup(seen.groupBy("query")).applyInArrow(_advance(beam, step), STATE),
                            "neighbours-state")
    return state.select("query", "ids")


def _cosines(batches):
    """(query, node, score) of rows (query, node, a, b), the two vectors."""
    for batch in batches:
        width = max((len(x) for k in (2, 3) for x in batch.column(k)), default=0)
        a, b = (_lists(batch.column(k), width) for k in (2, 3))
        score = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(score)], names=["query", "node", "score"])


def nearest_neighbours(vectors: DataFrame, is_query: Column, *, k: int = 5, beam: int = 160, rescored: int = 48,
                       **options) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row of ``vectors``
    (vec_id, embedding; further columns are ignored) where ``is_query`` holds,
    the k rows of largest cosine among those that a greedy search finds, but
    for the row itself; nearest first, ties to the smaller vec_id, fewer where
    there are fewer.

    Every row is indexed. Rows with a null vec_id and vectors that are null,
    empty, zero or hold a null or non-finite component take no part. Rows that
    repeat are rows of their own, each the other's neighbour. Vectors of
    different length are filled up with zeros. ``rescored`` nodes are compared
    by the exact cosine. Up to ``entries`` rows nothing is approximate.
    ``options``: of :func:`build_graph` and :func:`search_graph`.
    """
    spark = vectors.sparkSession
    searched = {x: options.pop(x) for x in ("step", "entries", "ways") if x in options}
    degree = options.pop("degree", 48)
    rows = cut_lineage(vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vector"), is_query.alias("asks"),
        F.monotonically_increasing_id().alias("row")), "neighbours-rows")
    # of equal vectors, the rows that can be in an answer: one more than k
    at = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id", "row"))
    held = F.sort_array(F.collect_list(F.struct("vec_id", "row")))
    nodes = cut_lineage(rows.withColumn("_at", at).where(F.col("_at") <= k + 1).groupBy("vector")
                        .agg(F.min("row").alias("node"), held.alias("rows")), "neighbours-nodes")
    width = nodes.agg(F.max(F.size("vector"))).first()[0] or 1
    codes = cut_lineage(nodes.select("node", "vector").mapInArrow(_coded(width), f"node long, {CODE}"), "neighbours-codes")
    asking = cut_lineage(rows.where("asks").join(nodes.select("vector", "node"), "vector").select("vec_id", "row", "node"),
                         "neighbours-asking")
    graph = build_graph(codes, width, **options)
    queries = (asking.select("node").distinct().join(codes, "node")
               .select(F.col("node").alias("query"), "code", "norm", F.col("node").alias("own")))
    with StoredGraph(codes, graph, degree) as stored:
        found = search_graph(stored, codes, queries, width, beam=beam, **searched)
    pairs = found.select("query", F.explode(F.slice("ids", 1, rescored)).alias("node"))
    scored = (pairs.join(nodes.select(F.col("node").alias("query"), F.col("vector").alias("a")), "query")
              .join(nodes.select("node", F.col("vector").alias("b")), "node").select("query", "node", "a", "b")
              .mapInArrow(_cosines, "query long, node long, score double"))
    each = scored.join(nodes.select("node", F.explode("rows").alias("r")), "node").select("query", "score", "r.vec_id", "r.row")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    best = F.sort_array(F.collect_list(F.struct("_rank", "vec_id", "row", "score")))
    answers = cut_lineage(each.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k + 1)
                          .groupBy(F.col("query").alias("node")).agg(best.alias("best")), "neighbours-answers")
    # many rows may be one node: they are dealt out, and its one answer to each part
    parts = 16
    part = F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int")
    dealt = answers.select("node", "best", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    own = F.slice(F.filter("best", lambda x: x["row"] != F.col("row")), 1, k)
    return (asking.withColumn("part", part).join(dealt, ["node", "part"])
            .select(F.col("vec_id").alias("query_id"), F.posexplode(own).alias("at", "e"))
            .select("query_id", (F.col("at") + 1).alias("rank"), "e.vec_id", "e.score"))
