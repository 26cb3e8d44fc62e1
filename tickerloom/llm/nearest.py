"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Equal vectors are one node. Nodes are dealt to shards of about ``SHARD`` by a hash, and every shard
gets a graph of its own: a greedy beam search proposes neighbours for each node, and relaxed distance
pruning keeps the nearest proposal, strikes out all that are closer to it than to the node by the
factor ``ALPHA``, and goes on with the next. Edges are also added backwards and pruned alike. Nodes
enter in batches that double, so a batch searches the graph of those before. A second round over all
nodes repeats this with the finished graph.

Searches start from the shard's medoid and from nodes that could not be reached from it: after every batch a
node of each part that the graph does not lead to becomes an entry as well. So groups far from each
other and lone outliers are met, whatever the distances between them.

A shard with its graph is one row of bounded size. Queries go to every shard in blocks of
``QUERIES``; a task holds a shard and answers up to ``BLOCKS`` blocks one after another by beam searches
of width ``SEARCH_BEAM``, and the nearest of all shards are merged. Neither an index nor a block of
queries depends on the size of the table. All distances, also those of the search, are those of the original
components in double precision, taken from differences. Every row is indexed.

Defined cases: vectors that are NULL, empty, all zero, or hold a NULL or a non-finite component take no
part; vectors of different lengths are not compared; ties go to the smaller id; of equal vectors as
many smallest ids are kept as an answer can hold, one more than ``k``, which is all that can be asked
for; repeated rows are one candidate and one query; a distance beyond the largest double is infinite
and comes last; other columns take no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import Staging, stage

SHARD, QUERIES, BLOCKS = 8192, 512, 64
TASKS = 20_000  # at most, of a search
DEGREE, ALPHA = 24, 1.2
BEAM, SEARCH_BEAM = 64, 128  # of building and of answering
SAFE = 1e-140, 1e140  # distances whose squares neither vanish nor overflow
LARGEST = np.finfo(np.float64).max
CELLS = 1 << 22  # numbers held at a time where many distances are taken
INDEX = "dim int, shard int, ids binary, vectors binary, graph binary, entries binary"


def valid(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def lengths(apart: np.ndarray) -> np.ndarray:
    """Euclidean lengths along the last axis; the few whose squares leave the range of doubles are taken with care."""
    with np.errstate(over="ignore", under="ignore"):
        out = np.sqrt((apart * apart).sum(axis=-1))
        odd = ~((out > SAFE[0]) & (out < SAFE[1]))
        if odd.any():
            out[odd] = np.hypot.reduce(apart[odd], axis=-1)
    return out


def apart(points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Distances of every query from every point."""
    out = np.empty((len(queries), len(points)))
    step = max(1, CELLS // max(1, points.size))
    with np.errstate(over="ignore"):
        for first in range(0, len(queries), step):
            out[first:first + step] = lengths(points[None] - queries[first:first + step, None])
    return out


def beam_search(vectors: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, width: int):
    """The ``width`` nearest nodes met by each query, nearest first: numbers (-1: none) and distances."""
    nodes = np.full((len(queries), width), -1)
    far = np.full((len(queries), width), np.inf)
    done = np.ones((len(queries), width), bool)
    met = np.zeros((len(queries), len(vectors)), bool)
    rows = np.arange(len(queries))
    begin = apart(vectors[entries], queries)
    order = np.argsort(begin, axis=1, kind="stable")[:, :width]
    n = order.shape[1]
    nodes[:, :n], far[:, :n], done[:, :n] = entries[order], np.take_along_axis(begin, order, 1), False
    met[rows[:, None], nodes[:, :n]] = True
    while True:
        waiting = (~done).any(axis=1)
        active = np.flatnonzero(waiting)
        if not len(active):
            return nodes, far
        best = (~done[active]).argmax(axis=1)  # the list is sorted: the first that is open is the nearest
        done[active, best] = True
        onward = graph[nodes[active, best]]
        usable = (onward >= 0) & ~met[active[:, None], onward]
        met[np.repeat(active, onward.shape[1])[usable.ravel()], onward[usable]] = True
        distance = np.full(onward.shape, np.inf)
        asker, place = np.nonzero(usable)
        with np.errstate(over="ignore"):
            distance[asker, place] = lengths(vectors[onward[asker, place]] - queries[active[asker]])
        all_far = np.concatenate([far[active], distance], axis=1)
        all_nodes = np.concatenate([nodes[active], np.where(usable, onward, -1)], axis=1)
        all_done = np.concatenate([done[active], ~usable], axis=1)
        # An infinitely far node still comes before no node.
        order = np.argsort(np.where(all_nodes < 0, np.inf, np.minimum(all_far, LARGEST)), axis=1, kind="stable")[:, :width]
        pick = np.arange(len(active))[:, None]
        far[active], nodes[active], done[active] = all_far[pick, order], all_nodes[pick, order], all_done[pick, order]


def robust_prune(vectors: np.ndarray, points: np.ndarray, proposals: np.ndarray, alpha: float) -> np.ndarray:
    """At most ``DEGREE`` diverse neighbours for every point out of its proposals (-1: none)."""
    proposals = np.sort(proposals, axis=1)[:, ::-1]
    repeated = np.zeros(proposals.shape, bool)
    repeated[:, 1:] = proposals[:, 1:] == proposals[:, :-1]
    open_ = (proposals >= 0) & ~repeated & (proposals != points[:, None])
    rows, out = np.arange(len(points)), np.full((len(points), DEGREE), -1, np.int32)
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        # Seen from the point itself, in units of its farthest proposal. A proposal is struck out by one that is
        # nearer, so what the products lose is small beside the distance that decides.
        some = vectors[np.where(proposals >= 0, proposals, 0)] - vectors[points][:, None]
        distance = lengths(some)
        unit = np.abs(some).max(axis=(1, 2))
        some /= np.where(unit > 0, unit, 1)[:, None, None]
        squares = (some * some).sum(axis=2)
        between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(some, some.transpose(0, 2, 1))
        for place in range(DEGREE):
            if not open_.any():
                break
            best = np.where(open_, distance, np.inf).argmin(axis=1)
            best = np.where(open_[rows, best], best, open_.argmax(axis=1))  # all that are left may be infinitely far
            any_left = open_[rows, best]
            out[any_left, place] = proposals[rows, best][any_left]
            struck = alpha * alpha * between[rows, best] <= squares
            open_ &= ~(struck & any_left[:, None])
            open_[rows, best] = False
    return out


def _connect(vectors: np.ndarray, graph: np.ndarray, batch: np.ndarray, alpha: float) -> None:
    """Adds the reverse of the edges of ``batch``; lists that grow too long are pruned."""
    source = np.repeat(batch, DEGREE)
    target = graph[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    if not len(target):
        return
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    first = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
    counts = np.diff(np.append(first, len(target)))
    owners = target[first]
    by_size = np.argsort(counts, kind="stable")
    # Cut so that a point that many have chosen does not widen the others' lists.
    for some in np.array_split(by_size, max(1, len(by_size) // 128)):
        extra = np.full((len(some), counts[some].max()), -1, np.int64)
        for row, i in enumerate(some):
            extra[row, :counts[i]] = source[first[i]:first[i] + counts[i]]
        points = owners[some]
        for part in np.array_split(np.arange(len(some)), max(1, extra.size * (vectors.shape[1] + extra.shape[1]) // CELLS)):
            graph[points[part]] = robust_prune(vectors, points[part], np.concatenate([graph[points[part]], extra[part]], axis=1), alpha)


def entries_to(graph: np.ndarray, entries: list[int], nodes: np.ndarray) -> list[int]:
    """``entries`` and as many of ``nodes`` as it takes to reach all of them along edges."""
    reached = np.zeros(len(graph), bool)
    entries, front = list(entries), np.array(entries)
    while True:
        reached[front] = True
        while len(front):
            onward = np.unique(graph[front])
            front = onward[(onward >= 0) & ~reached[onward]]
            reached[front] = True
        missing = nodes[~reached[nodes]]
        if not len(missing):
            return entries
        entries.append(int(missing[0]))
        front = missing[:1]


def build_graph(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbour numbers (-1: none) of every node, and the nodes where searches start, the medoid first."""
    n = len(vectors)
    middle = np.median(vectors, axis=0)  # no outlier moves it
    entry = int(apart(vectors, middle[None])[0].argmin())
    graph = np.full((n, DEGREE), -1, np.int32)
    others = np.random.default_rng(n).permutation(n)
    others = others[others != entry]
    entries = [entry]
    for alpha, batch in ((1.0, 1), (ALPHA, 256)):
        first = 0
        while first < len(others):
            points = others[first:first + batch]
            proposals, _ = beam_search(vectors, graph, np.array(entries), vectors[points], BEAM)
            graph[points] = robust_prune(vectors, points, np.concatenate([proposals, graph[points]], axis=1), alpha)
            _connect(vectors, graph, points, alpha)
            first += batch
            entries = entries_to(graph, entries[:1], np.append(others[:first] if alpha == 1.0 else others, entry))
            batch = min(256, 2 * batch)
    return graph, np.array(entries, np.int32)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("rep")
    vectors = np.array(group["vector"].tolist(), np.float64)
    graph, entries = build_graph(vectors)
    return pd.DataFrame({"dim": [vectors.shape[1]], "shard": [group["shard"].iloc[0]], "ids": [group["rep"].to_numpy(np.int64).tobytes()],
                         "vectors": [vectors.tobytes()], "graph": [graph.tobytes()], "entries": [entries.tobytes()]})


def _block(group: pd.DataFrame) -> pd.DataFrame:
    vectors = np.array(group["vector"].tolist(), np.float64)
    return pd.DataFrame({"dim": [vectors.shape[1]], "block": [group["block"].iloc[0]],
                         "ids": [group["query_id"].to_numpy(np.int64).tobytes()], "vectors": [vectors.tobytes()]})


def _answer(k: int):
    def search(shard: dict, block: dict) -> pa.RecordBatch:
        vectors = np.frombuffer(shard["vectors"]).reshape(-1, shard["dim"])
        points = np.frombuffer(block["vectors"]).reshape(-1, block["dim"])
        graph = np.frombuffer(shard["graph"], np.int32).reshape(len(vectors), -1)
        nodes, far = beam_search(vectors, graph, np.frombuffer(shard["entries"], np.int32), points, SEARCH_BEAM)
        ids = np.frombuffer(shard["ids"], np.int64)
        order = np.lexsort((np.where(nodes >= 0, ids[nodes], 0), far, nodes < 0), axis=1)[:, :k + 1]
        query = np.repeat(np.frombuffer(block["ids"], np.int64), order.shape[1])
        nodes, far = np.take_along_axis(nodes, order, 1).ravel(), np.take_along_axis(far, order, 1).ravel()
        found = nodes >= 0
        return pa.RecordBatch.from_arrays([pa.array(query[found]), pa.array(ids[nodes[found]]), pa.array(far[found])], names=["query_id", "rep", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] is None:
                    shard = row
                elif shard is not None and (shard["dim"], shard["shard"]) == (row["dim"], row["shard"]):
                    yield search(shard, row)

    return run


def nodes_of(vectors: DataFrame, k: int) -> DataFrame:
    """``(rep, vector, members)``: distinct vectors with their smallest id and up to ``k + 1`` ids."""
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    least = vectors.withColumn("rank", rank).filter(F.col("rank") <= k + 1)  # ranked in the map tasks first
    return least.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("members"))


def index(nodes: DataFrame, shard_rows: int = SHARD) -> DataFrame:
    """The graph index: a row per shard, built by a task per shard."""
    shards = max(1, -(-nodes.count() // shard_rows))
    dealt = nodes.select("rep", "vector", F.size("vector").alias("dim"), F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int").alias("shard"))
    # A stated number of partitions: by their bytes, shards would be merged into a few tasks.
    return dealt.repartition(min(3 * shards, TASKS), "dim", "shard").groupBy("dim", "shard").applyInPandas(_build, INDEX)


def search(graphs: DataFrame, blocked: DataFrame, blocks: int, k: int) -> DataFrame:
    """``(query_id, rep, score)``: what every shard answers to every block of the stated queries."""
    chunks = -(-blocks // BLOCKS)
    shards = graphs.select("dim", "shard", F.lit(None).cast("int").alias("block"), "ids", "vectors", "graph", "entries",
                           F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    asked = (blocked.join(graphs.groupBy("dim").agg(F.max("shard").alias("last")), "dim")
             .select("dim", F.explode(F.sequence(F.lit(0), "last")).alias("shard"), "block", "ids", "vectors",
                     *[F.lit(None).cast("binary").alias(c) for c in ("graph", "entries")], (F.col("block") / BLOCKS).cast("int").alias("chunk")))
    tasks = min(3 * chunks * max(1, graphs.count()), TASKS)
    held = shards.unionByName(asked).repartition(tasks, "dim", "shard", "chunk").sortWithinPartitions("dim", "shard", "chunk", F.col("block").asc_nulls_first())
    return held.select("dim", "shard", "block", "ids", "vectors", "graph", "entries").mapInArrow(_answer(k), "query_id long, rep long, score double")


def nearest(embeddings: DataFrame, query: Column, k: int = 10, shard_rows: int = SHARD) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row that ``query`` selects.

    A search costs queries times shards, so ``shard_rows`` may grow with the table as far as a task's
    memory allows: a shard takes some ``8 * dim + 100`` bytes a row.
    """
    rows = (embeddings.filter(valid(F.col("embedding")) & F.col("vec_id").isNotNull()).withColumn("__query", query)
            .select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"), "__query").distinct())
    with Staging(embeddings.sparkSession) as keep:
        nodes = keep(nodes_of(rows.select("vec_id", "vector"), k), "nodes")
        graphs = keep(index(nodes, shard_rows), "graphs")
        asked = keep(rows.filter("__query").select(F.col("vec_id").alias("query_id"), "vector", F.size("vector").alias("dim")), "asked")
        blocks = max(1, -(-asked.count() // QUERIES))
        blocked = (asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
                   .groupBy("dim", "block").applyInPandas(_block, "dim int, block int, ids binary, vectors binary"))
        hits = keep(search(graphs, blocked, blocks, k), "hits")
        found = (hits.join(nodes.select("rep", "members"), "rep").select("query_id", F.explode("members").alias("vec_id"), "score")
                 .filter("vec_id <> query_id"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        return stage(ranked, "nearest")
