"""Approximate nearest neighbours: a robust-pruned directed graph in each shard, searched with beams."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, release

INDEX = "shard int, dim int, ids binary, owners binary, vectors binary, edges binary, entry int"


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _distances(queries: np.ndarray, vectors: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Squared distances from each query to its own picked rows."""
    gap = vectors[picked] - queries[:, None, :]
    return np.einsum("qkd,qkd->qk", gap, gap)


def exact_distances(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; where squares leave its range, of vectors divided by their largest component."""
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        gap = vectors - query
        out = np.sqrt(np.einsum("kd,kd->k", gap, gap))
        far = ~np.isfinite(out) | (out < 1e-140)
        if far.any():
            most = np.maximum(np.abs(vectors[far]).max(axis=1), np.abs(query).max())
            gap = vectors[far] / most[:, None] - query / most[:, None]
            least = np.maximum(np.abs(gap).max(axis=1), 1e-320)
            out[far] = np.sqrt(((gap / least[:, None]) ** 2).sum(axis=1)) * least * most
    return out


class Frame:
    """How a shard's vectors are moved and scaled for its graph: to their middle, and by a power of two, so that squares stay in range.

    Single precision serves where the largest component is no more than 1e6 times the usual one, double precision elsewhere: it only steers the
    search, and distances returned are taken from the vectors themselves.
    """

    def __init__(self, vectors: np.ndarray):
        largest = np.abs(vectors).max(axis=1)
        self.power = -int(np.frexp(largest.max())[1])
        scaled = np.ldexp(vectors, self.power)
        self.middle = np.median(scaled, axis=0)
        own = np.abs(scaled - self.middle).max(axis=1)
        self.kind = np.float32 if np.median(own) * 1e6 >= own.max() else np.float64

    def of(self, vectors: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            moved = np.ldexp(vectors, self.power) - self.middle
        return np.clip(moved, -1e15, 1e15).astype(self.kind)  # a query far outside the shard is as good at its edge


def beam_search(queries: np.ndarray, vectors: np.ndarray, edges: np.ndarray, entry: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For all queries at once: the ``beam`` nearest nodes met by greedy search from ``entry`` (indices, squared distances; -1 and inf where fewer)."""
    n, q = len(vectors), len(queries)
    pool = np.full((q, beam), -1, np.int64)
    near = np.full((q, beam), np.inf, vectors.dtype)
    done = np.ones((q, beam), bool)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True  # stands for "no edge"
    pool[:, 0], done[:, 0], seen[:, entry] = entry, False, True
    near[:, 0] = _distances(queries, vectors, np.full((q, 1), entry))[:, 0]
    live = np.arange(q)
    while len(live):
        open_ = ~done[live]
        has = open_.any(axis=1)
        live, open_ = live[has], open_[has]
        if not len(live):
            break
        at = open_.argmax(axis=1)  # pools are sorted, so this is the nearest one not expanded
        done[live, at] = True
        found = edges[pool[live, at]]
        found = np.where(found < 0, n, found)
        fresh = ~seen[live[:, None], found]
        seen[live[:, None], found] = True
        distance = np.where(fresh, _distances(queries[live], vectors, np.minimum(found, n - 1)), np.inf)
        both = np.concatenate([near[live], distance], axis=1)
        order = np.argsort(both, axis=1, kind="stable")[:, :beam]
        near[live] = np.take_along_axis(both, order, axis=1)
        pool[live] = np.take_along_axis(np.concatenate([pool[live], np.where(fresh, found, -1)], axis=1), order, axis=1)
        done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], axis=1), order, axis=1)
    return pool, near


def robust_prune(nodes: np.ndarray, candidates: np.ndarray, vectors: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Out-edges of ``nodes`` from ``candidates`` (-1: none): nearest first; each edge kept discards what it is ``relax`` times nearer to than the node is."""
    c = np.where(candidates == nodes[:, None], -1, candidates)
    c = np.sort(c, axis=1)
    c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
    distance = np.where(c >= 0, _distances(vectors[nodes], vectors, np.maximum(c, 0)), np.inf)
    order = np.argsort(distance, axis=1, kind="stable")
    c, distance = np.take_along_axis(c, order, axis=1), np.take_along_axis(distance, order, axis=1)
    points = vectors[np.maximum(c, 0)]
    square = np.einsum("bkd,bkd->bk", points, points)
    between = np.maximum(square[:, :, None] + square[:, None, :] - 2 * points @ points.transpose(0, 2, 1), 0)
    alive, rows = np.isfinite(distance), np.arange(len(nodes))
    out = np.full((len(nodes), degree), -1, np.int64)
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        out[some, k] = c[rows, first][some]
        alive[rows, first] = False
        alive &= ~((relax * relax) * between[rows, first] <= distance)
    return out


def build_graph(vectors: np.ndarray, degree: int, beam: int, relax: float) -> tuple[np.ndarray, int]:
    """(edges, entry): nodes enter in batches that double; each searches the graph so far, is pruned to ``degree`` edges and gets edges back."""
    n = len(vectors)
    entry = int(np.argmin(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1)))
    order = np.r_[entry, np.random.default_rng(7).permutation(np.delete(np.arange(n), entry))]
    edges = np.full((n, degree), -1, np.int64)
    for _ in range(2):  # the second pass links early nodes to later ones
        at = 1
        while at < n:
            batch = order[at : at + max(1, min(at, 256))]
            at += len(batch)
            met, _ = beam_search(vectors[batch], vectors, edges, entry, beam)
            edges[batch] = robust_prune(batch, np.concatenate([met, edges[batch]], axis=1), vectors, degree, relax)
            _link_back(batch, edges, vectors, degree, relax)
    return edges, entry


def _link_back(batch: np.ndarray, edges: np.ndarray, vectors: np.ndarray, degree: int, relax: float) -> None:
    to, source = edges[batch].ravel(), np.repeat(batch, degree)
    to, source = to[to >= 0], source[to >= 0]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    nodes, first, times = np.unique(to, return_index=True, return_counts=True)
    for i in range(0, len(nodes), 512):
        some = slice(i, i + 512)
        more = np.full((len(nodes[some]), int(times[some].max())), -1, np.int64)
        lengths, begin = times[some], first[some]
        row = np.repeat(np.arange(len(lengths)), lengths)
        column = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        more[row, column] = source[np.repeat(begin, lengths) + column]
        edges[nodes[some]] = robust_prune(nodes[some], np.concatenate([edges[nodes[some]], more], axis=1), vectors, degree, relax)


def build_index(rows: DataFrame, shard_rows: int = 8192, degree: int = 24, beam: int = 48, relax: float = 1.1) -> DataFrame:
    """One row a shard: ids, vectors and graph of about ``shard_rows`` vectors of one dimension, dealt by a hash of the id.

    ``rows`` has ``id`` and ``vector`` (array of double), already without unusable vectors. Equal vectors of a shard are one node that owns all
    their ids. A task holds one shard: about 24 bytes a component of its vectors, beside 8 * ``degree`` bytes a vector.
    """
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumns({"shard": F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"), "dim": F.size("vector")})

    def build(table):
        import pyarrow as pa

        shard, dim = table.column("shard")[0].as_py(), table.column("dim")[0].as_py()
        vectors = np.ascontiguousarray(table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim), dtype=np.float64)
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order] + 0.0  # turns -0 to 0
        nodes, owner = np.unique(vectors.view(f"V{8 * dim}").ravel(), return_inverse=True)
        nodes = nodes.view(np.float64).reshape(-1, dim)
        edges, entry = build_graph(Frame(nodes).of(nodes), degree, beam, relax)
        values = (shard, dim, ids.astype("<i8").tobytes(), owner.astype("<i4").tobytes(), nodes.tobytes(), edges.astype("<i4").tobytes(), entry)
        kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.int32())
        release()
        return pa.table([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=["shard", "dim", "ids", "owners", "vectors", "edges", "entry"])

    spread = dealt.select("shard", "dim", "id", "vector").repartition(min(shards, 20_000), "shard", "dim")  # a stated number, so that small shards are not merged into one task
    return checkpointed(spread.groupBy("shard", "dim").applyInArrow(build, INDEX))


def search(index: DataFrame, queries: DataFrame, k: int = 10, beam: int = 192, block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found in all shards, by Euclidean distance in double precision, ties to the smaller id.

    Queries (``id``, ``vector``) are dealt into blocks of about ``block_rows``; each block meets each shard of its dimension in one group of a Spark
    shuffle, so neither passes the driver. Each group answers with its best ``k`` per query and Spark merges them.
    """
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    blocks = max(1, -(-queries.count() // block_rows))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.select(F.size("vector").alias("dim"), F.col("id").alias("query"), F.col("vector").alias("asked"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), each(shards).alias("shard"))
    both = index.withColumn("block", each(blocks)).unionByName(asked, allowMissingColumns=True)
    both = both.select("shard", "dim", "block", "ids", "owners", "vectors", "edges", "entry", "query", "asked")
    spread = both.repartition(min(shards * blocks, 20_000), "shard", "dim", "block")
    found = spread.groupBy("shard", "dim", "block").applyInArrow(_answers(k, beam), "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _answers(k: int, beam: int):
    def answer(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        shard, asked = table.filter(pc.is_valid(table.column("ids"))).to_pylist(), table.filter(pc.is_valid(table.column("query")))
        out: tuple[list, list, list] = ([], [], [])
        if shard and len(asked):
            (shard,) = shard
            dim = shard["dim"]
            nodes = np.frombuffer(shard["vectors"], np.float64).reshape(-1, dim)
            graph = np.frombuffer(shard["edges"], "<i4").reshape(len(nodes), -1).astype(np.int64)
            ids, owners = np.frombuffer(shard["ids"], "<i8"), np.frombuffer(shard["owners"], "<i4")
            order = np.lexsort((ids, owners))  # ids ascend inside a node, each once
            fresh = np.append(True, (np.diff(ids[order]) != 0) | (np.diff(owners[order]) != 0))
            ids, owners = ids[order][fresh], owners[order][fresh]
            begins = np.searchsorted(owners, np.arange(len(nodes) + 1))
            own = asked.column("query").to_numpy()
            queries = asked.column("asked").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            frame = Frame(nodes)
            near, near_queries = frame.of(nodes), frame.of(queries)
            for at in range(0, len(own), 256):
                pool, _ = beam_search(near_queries[at : at + 256], near, graph, shard["entry"], max(beam, k + 1))
                for q, met in enumerate(pool, at):
                    met = met[met >= 0]
                    scores = exact_distances(queries[q], nodes[met])
                    kept: list[tuple[float, int]] = []
                    for node, score in zip(met.tolist(), scores.tolist(), strict=True):
                        mine = ids[begins[node] : min(begins[node + 1], begins[node] + k + 1)].tolist()  # one of them may be the query's own
                        kept += [(score, i) for i in mine if i != own[q]]
                    for score, i in sorted(kept)[:k]:
                        out[0].append(int(own[q]))
                        out[1].append(i)
                        out[2].append(score)
        release()
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return answer


def vectors_of(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, vector) of the rows that take part: a null id, and a vector that is null, empty, zero or holds null or non-finite components, takes none."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))


def nearest(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each query row among all rows but the query's own id (rows that repeat id and vector are one candidate, and rows of the query's id none).

    Vectors of different dimensions never meet. An empty table gives no rows; other columns are ignored.
    """
    rows = vectors_of(df, id_col, vector_col)
    return search(build_index(rows), rows.filter(is_query).dropDuplicates(["id"]), k)
