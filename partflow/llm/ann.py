"""Approximate nearest neighbours by a robust-pruned directed graph.

Vectors are dealt to shards by a hash of their bytes. In each shard greedy searches over the
graph so far propose neighbours of a new vector; relaxed distance pruning keeps those that no
kept neighbour is much closer to, so that edges stay few and point in diverse directions.
Queries run a beam search in each shard and the shards' best are merged.

Nearness is the inner product. Within a shard it is turned into Euclidean distance by one
further coordinate, sqrt(M^2 - |x|^2) with M the largest norm (0 for a query), which keeps
the order. Reported scores are inner products of the original vectors in double precision.

Equal vectors are one point of the graph that carries its ``top + 1`` smallest ids; more of
them can't be in any answer. So a vector that a third of the rows share is one point.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor
do rows with a null id. Vectors of different length are never compared. Repeated ids count
once per distinct vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partflow.llm.common import parallelism, store

#: Vectors of a shard, about; edges of a vector; width of a beam in building and in queries;
#: relaxation of the pruning; vectors that search together.
SHARD, DEGREE, BEAM, QUERY_BEAM, ALPHA, TOGETHER = 4096, 32, 64, 96, 1.2, 512


def lifted(x: np.ndarray) -> np.ndarray:
    """The vectors with the coordinate that makes inner products distances."""
    norm = np.einsum("ij,ij->i", x, x)
    return np.concatenate([x, np.sqrt(np.maximum(norm.max(initial=0.0) - norm, 0))[:, None]],
                          axis=1).astype(np.float32)


class Graph:
    """A directed graph over the rows of ``x`` (lifted vectors); -1 marks a free edge."""

    def __init__(self, x: np.ndarray, edges: np.ndarray, entry: int):
        self.x, self.edges, self.entry = x, edges, entry
        self.norm = np.einsum("ij,ij->i", x, x)

    def search(self, q: np.ndarray, beam: int, wide: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances less |q|^2) of each query's beam, nearest first; free places have
        id -1. The ``wide`` nearest unexpanded vectors of a beam are expanded at once."""
        n = len(q)
        ids = np.full((n, beam), -1, np.int64)
        far = np.full((n, beam), np.inf, np.float32)
        done = np.ones((n, beam), bool)
        seen = np.zeros((n, len(self.x) + 1), bool)
        seen[:, -1] = True
        ids[:, 0] = self.entry
        far[:, 0] = self.norm[self.entry] - 2 * (q @ self.x[self.entry])
        done[:, 0] = False
        seen[:, self.entry] = True
        row = np.arange(n)[:, None]
        while True:
            active = np.flatnonzero(~done.all(axis=1))
            if not len(active):
                return ids, far
            at = row[:len(active)]
            open_ = np.argsort(done[active], axis=1, kind="stable")[:, :wide]
            pick = np.where(done[active[:, None], open_], -1, ids[active[:, None], open_])
            done[active[:, None], open_] = True
            near = np.where(pick[:, :, None] < 0, -1, self.edges[pick]).reshape(
                len(active), -1)
            near.sort(axis=1)
            new = ~seen[active[:, None], near] & (near >= 0)
            new[:, 1:] &= near[:, 1:] != near[:, :-1]
            seen[active[:, None], near] = True
            d = self.norm[near] - 2 * np.einsum("bnd,bd->bn", self.x[near], q[active])
            d = np.where(new, d, np.inf).astype(np.float32)
            all_d = np.concatenate([far[active], d], axis=1)
            order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            far[active] = all_d[at, order]
            ids[active] = np.where(np.isinf(far[active]), -1, np.concatenate(
                [ids[active], near], axis=1)[at, order])
            done[active] = np.concatenate([done[active], ~new], axis=1)[at, order]


def prune(x: np.ndarray, points: np.ndarray, found: np.ndarray, degree: int,
          alpha: float) -> np.ndarray:
    """For each of ``points`` the nearest of ``found`` (-1: none), each of which rules out
    those that lie ``alpha`` times nearer to it than to the point."""
    n, width = found.shape
    found = np.sort(found, axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    found[found == points[:, None]] = -1
    c = x[found]
    to_point = ((c - x[points][:, None, :]) ** 2).sum(axis=2)
    norm = np.einsum("bnd,bnd->bn", c, c)
    between = norm[:, :, None] + norm[:, None, :] - 2 * (c @ c.transpose(0, 2, 1))
    left = np.where(found < 0, np.inf, to_point)
    out = np.full((n, degree), -1, np.int64)
    row = np.arange(n)
    for i in range(degree):
        best = left.argmin(axis=1)
        ok = np.isfinite(left[row, best])
        if not ok.any():
            break
        out[ok, i] = found[row, best][ok]
        ruled = (alpha * alpha * between[row, best] <= to_point) & ok[:, None]
        left[ruled] = np.inf
        left[row, best] = np.inf
    return out


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA,
          seed: int = 0) -> Graph:
    """Insert the vectors in a random order, in batches that at most double the graph."""
    n = len(x)
    order = np.random.default_rng(seed).permutation(n)
    middle = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.concatenate([[middle], order[order != middle]])
    graph = Graph(x, np.full((n, degree), -1, np.int64), middle)
    at = 1
    while at < n:
        new = order[at:at + min(at, TOGETHER)]
        at += len(new)
        found, _ = graph.search(x[new], beam)
        near = prune(x, new, found, degree, alpha)
        graph.edges[new] = near
        # Back edges: those that fit are added, overfull vectors are pruned anew.
        to, col = np.nonzero(near >= 0)
        target, source = near[to, col], new[to]
        by = np.argsort(target, kind="stable")
        target, source = target[by], source[by]
        first = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
        count = np.diff(np.concatenate([first, [len(target)]]))
        hub = target[first]
        slot = np.arange(len(target)) - np.repeat(first, count)
        for lo in range(0, len(hub), TOGETHER):
            part = slice(lo, lo + TOGETHER)
            a, e = first[part][0], first[part][-1] + count[part][-1]
            more = np.full((len(hub[part]), int(count[part].max())), -1, np.int64)
            more[np.repeat(np.arange(len(hub[part])), count[part]), slot[a:e]] = source[a:e]
            both = np.concatenate([graph.edges[hub[part]], more], axis=1)
            full = (both >= 0).sum(axis=1) > degree
            both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)
            kept = both[:, :degree].copy()
            if full.any():
                kept[full] = prune(x, hub[part][full], both[full], degree, alpha)
            graph.edges[hub[part]] = kept
    return graph


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


ROW = ("dim int, shard int, kind int, at int, point bigint, v array<double>, "
       "edges array<int>")
_ROW = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("kind", pa.int32()),
                  ("at", pa.int32()), ("point", pa.int64()), ("v", pa.list_(pa.float64())),
                  ("edges", pa.list_(pa.int32()))])


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _shards(batches):
    """(dim, shard), batch of consecutive rows of one shard."""
    for b in batches:
        dim = b.column("dim").to_numpy()
        shard = b.column("shard").to_numpy()
        cut = np.flatnonzero((np.diff(dim) != 0) | (np.diff(shard) != 0)) + 1
        for a, e in zip([0, *cut.tolist()], [*cut.tolist(), len(dim)]):
            if e > a:
                yield (int(dim[a]), int(shard[a])), b.slice(a, e - a)


def index_shards(batches):
    """Rows come sorted by shard and point; each shard leaves with its edges."""
    def finish(parts):
        whole = pa.Table.from_batches(parts).combine_chunks()
        x = _matrix(whole.column("v").combine_chunks())
        graph = build(lifted(x))
        # The entry point comes first, so that edges are row numbers behind it.
        order = np.concatenate([[graph.entry],
                                np.delete(np.arange(len(x)), graph.entry)]).astype(np.int64)
        place = np.empty(len(x) + 1, np.int64)
        place[order], place[-1] = np.arange(len(x)), -1
        edges = place[graph.edges[order]]
        ends = np.concatenate([[0], np.cumsum((edges >= 0).sum(axis=1))]).astype(np.int32)
        whole = whole.take(pa.array(order))
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.asarray(whole.column("dim")), pa.int32()),
             pa.array(np.asarray(whole.column("shard")), pa.int32()),
             pa.array(np.zeros(len(x)), pa.int32()),
             pa.array(np.arange(len(x)), pa.int32()),
             whole.column("point").combine_chunks(), whole.column("v").combine_chunks(),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(edges[edges >= 0], pa.int32()))],
            schema=_ROW)
        return out

    key, parts = None, []
    for k, b in _shards(batches):
        if k != key and parts:
            yield finish(parts)
            parts = []
        key = k
        parts.append(b)
    if parts:
        yield finish(parts)


def search_shards(top: int, beam: int):
    """Rows come sorted by shard: first its vectors with their edges, then its queries."""
    out = pa.schema([("query", pa.int64()), ("point", pa.int64()), ("score", pa.float64())])

    def rows(batches):
        key, graph, parts = None, None, []
        for k, b in _shards(batches):
            if k != key:
                key, graph, parts = k, None, []
            kind = b.column("kind").to_numpy()
            n = int((kind == 0).sum())
            if n:
                parts.append(b.slice(0, n))
            if n == len(kind):
                continue
            if graph is None:
                whole = pa.Table.from_batches(parts).combine_chunks()
                own = _matrix(whole.column("v").combine_chunks())
                points = whole.column("point").to_numpy()
                lists = whole.column("edges").combine_chunks()
                size = np.diff(lists.offsets.to_numpy())
                edges = np.full((len(own), max(1, int(size.max(initial=1)))), -1, np.int64)
                edges[np.repeat(np.arange(len(own)), size),
                      np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = \
                    lists.flatten().to_numpy()
                graph = Graph(lifted(own), edges, 0)
            asked = b.slice(n)
            q = _matrix(asked.column("v"))
            ids = asked.column("point").to_numpy()
            for a in range(0, len(q), TOGETHER):
                part = q[a:a + TOGETHER]
                low = np.concatenate([part, np.zeros((len(part), 1))], axis=1)
                found, _ = graph.search(low.astype(np.float32), beam)
                score = np.einsum("bnd,bd->bn", own[found], part)
                score[found < 0] = -np.inf
                order = np.lexsort((points[found], -score), axis=1)[:, :top]
                best = np.take_along_axis(found, order, axis=1)
                score = np.take_along_axis(score, order, axis=1)
                ok = best >= 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[a:a + TOGETHER], ok.sum(axis=1))),
                     pa.array(points[best[ok]]), pa.array(score[ok])], schema=out)
    return rows


def nearest(vectors: DataFrame, is_query: Column, key: str = "vec_id",
            vector: str = "embedding", top: int = 20, shard_rows: int = SHARD,
            beam: int = QUERY_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``is_query`` holds its ``top``
    nearest other rows."""
    n = parallelism(vectors.sparkSession)
    rows = vectors.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks")).distinct()
    rows = store(rows.withColumn("h", F.xxhash64("v")), "ann-rows")
    # Points: distinct vectors, each with its smallest ids; the first id names the point.
    nth = F.row_number().over(Window.partitionBy("h", "v").orderBy("id"))
    least = rows.select("h", "v", "id").withColumn("nth", nth).where(F.col("nth") <= top + 1)
    points = store(least.groupBy("h", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")),
                   "ann-points")
    dims = points.groupBy(F.size("v").alias("dim")).count().collect()  # one row per length
    if not dims:
        return vectors.sparkSession.createDataFrame(
            [], "query_id bigint, rank int, vec_id bigint, score double")
    shards = F.create_map(*[F.lit(x) for d in dims
                            for x in (d["dim"], -(-d["count"] // shard_rows))])
    count = F.element_at(shards, F.size("v"))
    none = F.lit(None).cast("array<int>").alias("edges")
    index = points.select(F.size("v").alias("dim"),
                          F.pmod(F.xxhash64(F.lit(3), "h"), count).cast("int").alias("shard"),
                          F.lit(0).alias("kind"), F.lit(0).alias("at"),
                          F.col("ids")[0].alias("point"), "v", none)
    index = store(index.repartition(n, "dim", "shard")
                  .sortWithinPartitions("dim", "shard", "point")
                  .mapInArrow(index_shards, ROW), "ann-index")
    asked = rows.where("asks")
    each = asked.select(F.size("v").alias("dim"),
                        F.explode(F.sequence(F.lit(0), count - 1)).alias("shard"),
                        F.lit(1).alias("kind"), F.lit(0).alias("at"),
                        F.col("id").alias("point"), "v", none)
    each = each.withColumn("shard", F.col("shard").cast("int"))
    found = (index.unionByName(each).repartition(n, "dim", "shard")
             .sortWithinPartitions("dim", "shard", "kind", "at")
             .mapInArrow(search_shards(top + 1, beam),
                         "query bigint, point bigint, score double"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    found = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= top + 1)
    ids = points.select(F.col("ids")[0].alias("point"), "ids")
    every = (found.join(ids, "point").select("query", "score", F.explode("ids").alias("vec_id"))
             .where("vec_id <> query"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select(F.col("query").alias("query_id"), "rank", "vec_id", "score"))
