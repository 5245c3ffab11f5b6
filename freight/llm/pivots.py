"""Exact search for the largest inner products, by a table of distances to pivots.

A further component makes all candidates equally long, so that a larger inner product is a smaller
distance; queries get 0 there.  Distances from every vector to a few pivots are computed once.  By the
triangle inequality, the largest difference of two vectors' distances to a pivot is a lower bound of
their distance, and the largest distance to a range of distances one for a whole group of candidates.

Candidates are dealt by nearest pivot into blocks of bounded size and, within a block, by distance into groups.  Every
query first searches the block of its own nearest pivot; its k-th score there goes along.  Then each pack of queries
meets each other block in a task: a query takes the groups in the order of their bounds, and stops when the
bound exceeds the distance of its k-th best so far, at once if the whole block is too far.  What is left is scored by
products of matrices, on whole numbers, so ties are exact.  The best of all blocks are merged by query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freight.llm.common import shuffle_width, written

#: Pivots, and the vectors from which they are picked (those with the smallest hash of the id).
PIVOTS, PIVOT_SAMPLE = 32, 512
#: Vectors in a block of candidates, in a group of such a block, and in a pack of queries, about.
CANDIDATES, GROUP, QUERIES = 8192, 256, 1024
_PACKED = "block int, part int, ids binary, vectors binary, heights binary, distances binary"
_FOUND = "query_id long, vec_id long, score long"


def scaled(vector: Column, scale: int) -> Column:
    """Each component times ``scale``, rounded down, as a double; null if one is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return F.when(vector.isNotNull() & good, whole)


def _pick(vectors: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other: each next one is the farthest from those picked."""
    picked, far = [0], np.linalg.norm(vectors - vectors[0], axis=1)
    while len(picked) < min(count, len(vectors)) and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(vectors - vectors[picked[-1]], axis=1))
    return vectors[picked]


def _unpacked(values: pa.Array, width: int) -> np.ndarray:
    """Vectors of a list column as rows, filled up with zeros."""
    vectors = np.zeros((len(values), width))
    sizes = np.diff(values.offsets.to_numpy())
    flat = values.values.to_numpy()[values.offsets[0].as_py() : values.offsets[-1].as_py()]
    vectors[np.repeat(np.arange(len(values)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return vectors


def _raised(vectors: np.ndarray, radius2: float, lift: bool) -> np.ndarray:
    """The vectors with the further component: that of candidates, or 0."""
    rest = np.sqrt(np.maximum(0, radius2 - (vectors**2).sum(axis=1))) if lift else np.zeros(len(vectors))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def _distances(raised: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.linalg.norm(raised - pivot, axis=1) for pivot in pivots], axis=1)


def _nearest(width: int, radius2: float, pivots: np.ndarray):
    """Adds the nearest of ``pivots``, as a candidate and as a query."""

    def assign(batches):
        for batch in batches:
            vectors = _unpacked(batch.column("vector"), width)
            near = [_distances(_raised(vectors, radius2, lift), pivots).argmin(axis=1).astype(np.int32) for lift in (True, False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, near)], [*batch.schema.names, "cluster", "query_cluster"])

    return assign


def _packer(width: int, radius2: float, pivots: np.ndarray, lift: bool):
    """Packs the rows of a block; ``lift``: candidates, in the order of their distance to the nearest pivot."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        vectors = _unpacked(table.column("vector").combine_chunks(), width)
        distances = _distances(_raised(vectors, radius2, lift), pivots).astype(np.float32)
        order = np.lexsort((ids, distances.min(axis=1))) if lift else np.argsort(ids)
        ids, vectors, distances = ids[order], vectors[order], distances[order]
        columns = {"ids": ids, "vectors": vectors, "heights": (vectors**2).sum(axis=1), "distances": distances}
        key = {name: pa.array([table.column(name)[0].as_py()], pa.int32()) for name in ("block", "part")}
        return pa.table(key | {name: pa.array([np.ascontiguousarray(value).tobytes()], pa.binary()) for name, value in columns.items()})

    return pack


def _merge(best: np.ndarray, which: np.ndarray, rows: np.ndarray, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
    """Puts new scores among the best of some queries: ``at`` says of which of ``rows`` each is."""
    k = best.shape[1]
    place = np.concatenate([np.repeat(np.arange(len(rows)), k), at])
    score, ids = np.concatenate([best[rows].ravel(), score]), np.concatenate([which[rows].ravel(), ids])
    order = np.lexsort((ids, -score, place))
    place, score, ids = place[order], score[order], ids[order]
    first = np.searchsorted(place, np.arange(len(rows)))
    rank = np.arange(len(place)) - first[place]
    kept = rank < k
    best[rows[place[kept]], rank[kept]] = score[kept]
    which[rows[place[kept]], rank[kept]] = ids[kept]


def search_block(queries: dict, candidates: dict, known: np.ndarray, radius2: float, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best scores and ids of a pack of queries in a block, a row each, and how many pairs were scored.

    Both are given by arrays ``ids, vectors, distances``, queries with ``squares`` too; ``known`` is the k-th score
    that each query has already.  Places that are not filled have the score minus infinity.
    """
    slack = 1e-4 * (1 + np.sqrt(radius2))  # over what distances and bounds lose by rounding
    n = len(queries["ids"])
    best, which = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
    starts = np.arange(0, len(candidates["ids"]), GROUP)
    low, high = (f.reduceat(candidates["distances"], starts, axis=0) for f in (np.minimum, np.maximum))
    bound = np.zeros((n, len(starts)), np.float32)
    for p in range(low.shape[1]):
        own = queries["distances"][:, p, None]
        np.maximum(bound, np.maximum(low[:, p] - own, own - high[:, p]), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    active, scored = np.arange(n), 0
    for step in range(len(starts)):
        # the distance of the k-th best so far, or none
        worst = np.maximum(best[active, -1], known[active])
        limit = np.sqrt(np.maximum(0, queries["squares"][active] + radius2 - 2 * np.where(np.isfinite(worst), worst, 0)))
        limit = np.where(np.isfinite(worst), limit * (1 + 1e-5) + slack, np.inf)
        turn = order[active, step]
        near = bound[active, turn] <= limit
        active, turn = active[near], turn[near]
        for group in np.unique(turn):
            rows = active[turn == group]
            some = slice(starts[group], starts[group] + GROUP)
            score = queries["vectors"][rows] @ candidates["vectors"][some].T
            scored += score.size
            score[queries["ids"][rows][:, None] == candidates["ids"][some]] = -np.inf
            floor = np.maximum(best[rows, -1], known[rows])
            if score.shape[1] > k:
                floor = np.maximum(floor, np.partition(score, -k, axis=1)[:, -k])
            at, place = np.nonzero((score >= floor[:, None]) & np.isfinite(score))
            if len(at):
                _merge(best, which, rows, at, score[at, place], candidates["ids"][some][place])
    return best, which, scored


def _searcher(width: int, radius2: float, pivots: int, k: int):
    def search(table: pa.Table) -> pa.Table:
        row = {name: table.column(name)[0].as_py() for name in ("ids", "vectors", "heights", "distances", "c_ids", "c_vectors", "c_distances", "known")}

        def arrays(prefix: str) -> dict:
            return {
                "ids": np.frombuffer(row[f"{prefix}ids"], np.int64),
                "vectors": np.frombuffer(row[f"{prefix}vectors"]).reshape(-1, width),
                "distances": np.frombuffer(row[f"{prefix}distances"], np.float32).reshape(-1, pivots),
            }

        queries = arrays("") | {"squares": np.frombuffer(row["heights"])}
        # the k-th scores of this pack's queries, by id; queries without one have none yet
        known = np.full(len(queries["ids"]), -np.inf)
        if row["known"]:
            ids, scores = (np.array([x[i] for x in row["known"]], np.int64) for i in ("id", "score"))
            known[np.searchsorted(queries["ids"], ids)] = scores
        best, which, _ = search_block(queries, arrays("c_"), known, radius2, k)
        at, rank = np.nonzero(np.isfinite(best) & (best >= known[:, None]))
        columns = (queries["ids"][at], which[at, rank], best[at, rank].astype(np.int64))
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, columns), strict=True)))

    return search


def top_inner_products(vectors: DataFrame, queries: Column, k: int, scale: int, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: of each query the k candidates with the largest scores.

    ``queries`` says of a row whether it is a query too; a query's own id is no candidate for it.  Scores
    are inner products of the vectors' components times ``scale``, rounded down; ties go to the smaller id.
    Vectors that are null or hold a null or a component that is not finite take no part, nor do rows without an
    id.  Shorter vectors count as filled up with zeros.  Of rows with equal id the smallest vector counts.
    Raises ValueError where components are so large that scores are not exact.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), scaled(F.col(vector), scale).alias("vector"), queries.alias("query"))
    rows = rows.where("id is not null and vector is not null")
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"), F.max("query").alias("query"))
    rows = written(rows, "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    figures = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("query").alias("n_queries"),
        F.max(F.size("vector")).alias("width"),
        F.max(square).alias("radius2"),
    ).first()
    if figures["radius2"] is not None and figures["radius2"] >= 2.0**53:
        raise ValueError("components are too large for exact scores")
    width, radius2 = max(1, figures["width"] or 0), float(figures["radius2"] or 0)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).select("vector").collect()
    if not sample or not figures["n_queries"]:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = np.zeros((len(sample), width + 1))
    for line, row in zip(found, sample, strict=True):
        line[: len(row["vector"])] = row["vector"]
    found[:, -1] = np.sqrt(np.maximum(0, radius2 - (found**2).sum(axis=1)))
    pivots = _pick(found, PIVOTS)

    # as many pivots take blocks as there are blocks; counts are a row for each of them
    homes = pivots[: max(1, -(-figures["n"] // CANDIDATES))]
    near = rows.mapInArrow(_nearest(width, radius2, homes), "id long, vector array<double>, query boolean, cluster int, query_cluster int")
    near = written(near, "near")
    sizes = {r["cluster"]: r["n"] for r in near.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    asked = {r["query_cluster"]: r["n"] for r in near.where("query").groupBy("query_cluster").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = [-(-sizes.get(c, 0) // CANDIDATES) for c in range(len(homes))]
    first = np.cumsum([0, *blocks]).tolist()
    # a cluster without candidates has no block of its own: its queries start with the first one
    start = [first[c] if blocks[c] else 0 for c in range(len(homes))]
    parts = [-(-asked.get(c, 0) // (QUERIES * max(1, blocks[c]))) for c in range(len(homes))]

    def of(cluster: Column, values: list[int]) -> Column:
        return F.get(F.array(*map(F.lit, values)), cluster)

    def dealt(cluster: str, seed: int, over: list[int], offset: list[int]) -> Column:
        spread = F.pmod(F.xxhash64("id", F.lit(seed)), F.greatest(of(F.col(cluster), over), F.lit(1)))
        return (of(F.col(cluster), offset) + spread).cast("int")

    def packed(some: DataFrame, lift: bool) -> DataFrame:
        return some.groupBy("block", "part").applyInArrow(_packer(width, radius2, pivots, lift), _PACKED)

    candidates = packed(near.select("id", "vector", dealt("cluster", 1, blocks, start).alias("block"), F.lit(0).alias("part")), True)
    candidates = written(candidates.select(F.col("block").alias("other"), *(F.col(c).alias(f"c_{c}") for c in ("ids", "vectors", "distances"))), "candidates")
    asking = near.where("query").select(
        "id", "vector", dealt("query_cluster", 1, blocks, start).alias("block"), dealt("query_cluster", 2, parts, [0] * len(homes)).alias("part")
    )
    asking_packed = written(packed(asking, False), "queries")
    search = _searcher(width, radius2, len(pivots), k)

    def searched(pairs: DataFrame) -> DataFrame:
        # a group is one pair; the number keeps pairs from being merged into few tasks
        spread = pairs.repartition(max(shuffle_width(vectors.sparkSession), vectors.sparkSession.sparkContext.defaultParallelism), "block", "part", "other")
        return spread.groupBy("block", "part", "other").applyInArrow(search, _FOUND)

    unknown = F.array().cast("array<struct<id:bigint,score:bigint>>")
    home = written(searched(asking_packed.join(candidates, F.col("block") == F.col("other")).withColumn("known", unknown)), "home")
    # the k-th scores at home go along with each pack
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    last = home.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select(F.col("query_id").alias("id"), "score")
    known = asking.select("id", "block", "part").join(last, "id").groupBy("block", "part").agg(F.collect_list(F.struct("id", "score")).alias("known"))
    packs = asking_packed.join(known, ["block", "part"], "left").withColumn("known", F.coalesce("known", unknown))
    others = packs.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(first[-1] - 1)))).where("other <> block")
    best = home.unionAll(searched(others.join(candidates, "other")))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


ORACLE = """
with v as (select vec_id, [floor(64 * cast(x as double)) for x in embedding] as e from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 20
"""
