"""Nearest neighbours: exact search by cells, graphs, graph search and hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import vectors
from tessera.functions.hashing import hash_order
from tessera.plans.prefix import cut_lineage


DIGITS = 9  # distances equal to this many digits are ties, ranked by id
#: Rows of a corpus that the cells are fitted on; a smaller corpus is broadcast.
FITTED = 16_384
_TIE = 2 * 10.0**-DIGITS
#: Distances that a task holds at a time.
PRODUCT = 1 << 22
#: Queries that are worth a block of their own.
SHARE = 1024
#: Rows of a block that give a first k-th distance where none is known.
TRIED = 1024
#: Rows of a block of a bucket.
HASHED = 32_768
#: Rows that are compared together at least, whatever their hashes.
GATHERED = 512
#: Pairs whose distances are measured again at a time.
MEASURED = 1 << 16


def _rounding(dims: int, *norms: np.ndarray, kind: type = float) -> np.ndarray:
    """How far a squared distance from a matrix product may be off, for rows of these squared norms."""
    return 8 * dims * np.finfo(kind).eps * sum(norms)


@dataclass
class Cells:
    """K-means cells, gathered into groups that are searched whole.

    Every row lies within ``radius`` of its cell's centre, so no row of a cell is nearer to a
    query than the distance to the centre less the radius, or farther than both together.
    """

    centres: np.ndarray
    group: np.ndarray
    counts: np.ndarray
    radius: np.ndarray

    def bounds(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the distances to the rows of each cell; none for empty cells."""
        own, other = (v * v).sum(1)[:, None], (self.centres * self.centres).sum(1)[None, :]
        squared, off = own + other - 2 * (v @ self.centres.T), _rounding(v.shape[1], own, other)
        low = np.sqrt(np.maximum(squared - off, 0)) - self.radius
        high = np.sqrt(np.maximum(squared + off, 0)) + self.radius
        return np.where(self.counts, low, np.inf), np.where(self.counts, high, -np.inf)

    def order(self, v: np.ndarray, far: bool) -> np.ndarray:
        """Bound of each group for each vector: the least distance, or the negated largest one."""
        low, high = self.bounds(v)
        bound = -high if far else low
        out = np.full((len(v), int(self.group.max()) + 1), np.inf)
        for cell, group in enumerate(self.group):
            out[:, group] = np.minimum(out[:, group], bound[:, cell])
        return out

    def group_counts(self) -> np.ndarray:
        return np.bincount(self.group, weights=self.counts).astype(np.int64)


def _nearest_centre(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1)[None, :] - 2 * (v @ centres.T), axis=1)


def _k_means(v: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's centres; the first rows are the first centres."""
    centres = np.unique(v, axis=0, return_index=True)[1]
    centres = v[np.sort(centres)[:cells]].copy()
    for _ in range(rounds):
        own = _nearest_centre(v, centres)
        for cell in range(len(centres)):
            if (own == cell).any():
                centres[cell] = v[own == cell].mean(axis=0)
    return centres


def _kind(vectors: DataFrame) -> str:
    """The type that vectors travel in: single precision stays as it is."""
    return "array<float>" if vectors.schema["v"].dataType.simpleString() == "array<float>" else "array<double>"


def _assign(rows: DataFrame, centres: np.ndarray, middle: np.ndarray) -> DataFrame:
    """(id, v, cell, away): each row's nearest centre and its distance."""
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                v = np.stack(batch["v"]).astype(float) - middle
                cell = _nearest_centre(v, shared.value)
                away = np.sqrt(((v - shared.value[cell]) ** 2).sum(1))
                yield batch.assign(cell=cell, away=away)

    return rows.mapInPandas(run, f"id bigint, v {_kind(rows)}, cell bigint, away double")


def _visits(queries: DataFrame, cells: Cells, k: int, far: bool, known: bool, middle: np.ndarray | float = 0.0) -> DataFrame:
    """The groups that each query with an ``edge`` must look into for its ``k`` nearest or farthest rows."""
    return _visits_of_sides(queries.withColumn("edges", F.array("edge")).drop("edge"), cells, [(far, k)], known, middle)


def _visits_of_sides(
    queries: DataFrame, cells: Cells, sides: Sequence[tuple[bool, int]], known: bool, middle: np.ndarray | float = 0.0
) -> DataFrame:
    """(query_id, v, edges, groups, wanted): the groups that each query must look into, and for which sides, as bits.

    A side is (far, k), the ``k`` nearest or farthest rows. At first, the most promising groups that
    hold ``k`` rows; once the ``edges`` are known, the distances of the k-th rows so far, negated if
    far, those of the others whose bound does not exceed it.
    """
    shared = queries.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = shared.value.group_counts()
        for batch in batches:
            if not len(batch):
                continue
            v, edges = np.stack(batch["v"]).astype(float) - middle, _edges(batch)
            wanted = np.zeros((len(v), len(held)), dtype=np.int64)
            for i, (far, k) in enumerate(sides):
                bound = shared.value.order(v, far)
                ranked = np.argsort(bound, axis=1, kind="stable")
                before = np.cumsum(held[ranked], axis=1) - held[ranked]
                first = np.zeros(bound.shape, dtype=bool)
                np.put_along_axis(first, ranked, before < k, axis=1)
                if known:
                    edge = edges[:, i][:, None]
                    first = ~first & (bound <= edge + _TIE + 1e-12 * np.abs(np.where(np.isfinite(edge), edge, 0)))
                wanted |= (first & (held > 0)).astype(np.int64) << i
            groups = [np.flatnonzero(row) for row in wanted]
            yield batch.assign(groups=groups, wanted=[row[g] for row, g in zip(wanted, groups)])

    schema = f"query_id bigint, v {_kind(queries)}, edges array<double>, groups array<bigint>, wanted array<bigint>"
    return queries.select("query_id", "v", "edges").mapInPandas(run, schema)


def _edges(rows: pd.DataFrame) -> np.ndarray:
    """Where the best rows of each side end, a column each; infinity where that is not known."""
    edges = np.stack(rows["edges"]).astype(float)
    return np.where(np.isnan(edges), np.inf, edges)


def _best(
    a: np.ndarray,
    b: np.ndarray,
    ids: np.ndarray,
    sides: Sequence[tuple[bool, int, np.ndarray]],
    skip: Callable[[np.ndarray, np.ndarray], np.ndarray],
    measure: Callable[[np.ndarray, np.ndarray], np.ndarray],
    below: float = np.inf,
    spare: int = 0,
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, col, dist) per side: the best rows of ``b`` for each row of ``a``, ties by ``ids``.

    A side is (far, k, edge): no row beyond its edge is wanted, infinity sets no edge and its
    negative wants no row; edges of the farthest are negated. All sides share one matrix product in
    single precision, or double where that cannot tell rows apart. Every pair that may be among the
    best by the product's rounding is measured again by ``measure``; pairs that ``skip`` are left out,
    and distances not ``below``. With ``spare``, the best are that many more until skipped pairs are taken from them.
    """
    known = skip if not spare else lambda row, col: np.zeros(np.broadcast_shapes(row.shape, col.shape), dtype=bool)
    own, other = (a * a).sum(1), (b * b).sum(1)
    most = np.nanmax(other, initial=0) if len(b) else 0
    fits = 1e-25 < most and np.nanmax(own, initial=0) + most < 1e30
    found = [[] for _ in sides]
    factors = {}

    def products(kind: type, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """The squared distances less the own norms, and how far they may be off."""
        if kind not in factors:
            factors[kind] = np.ascontiguousarray(np.column_stack([b, other]).astype(kind).T)
        left = np.column_stack([-2 * a[start:stop], np.ones(stop - start)]).astype(kind)
        return left @ factors[kind], _rounding(a.shape[1], own[start:stop], most, kind=kind)

    step = max(1, PRODUCT // max(1, len(b)))
    for start in range(0, len(a), step):
        stop = min(len(a), start + step)
        score, off = products(np.float32 if fits else float, start, stop)
        for i, (far, k, edge) in enumerate(sides):
            if not (edge[start:stop] > -np.inf).any():
                continue
            row, col = _near_edge(score, own[start:stop], off, far, k + spare, edge[start:stop], known, start)
            if fits and len(row) > 64 * k * (stop - start):
                exact, close = products(float, start, stop)
                row, col = _near_edge(exact, own[start:stop], close, far, k + spare, edge[start:stop], known, start)
            if spare:
                kept = ~skip(row, col)
                row, col = row[kept], col[kept]
            if not len(row):
                continue
            dist = np.concatenate([measure(row[j : j + MEASURED], col[j : j + MEASURED]) for j in range(0, len(row), MEASURED)])
            inside = dist < below
            row, col, dist = row[inside], col[inside], dist[inside]
            order = np.lexsort((ids[col], -dist if far else dist, row))
            row, col, dist = row[order], col[order], dist[order]
            best = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
            found[i].append((row[best], col[best], dist[best]))
    none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
    return [tuple(np.concatenate(x) for x in zip(*parts)) if parts else none for parts in found]


def _near_edge(
    score: np.ndarray, own: np.ndarray, off: np.ndarray, far: bool, k: int, edge: np.ndarray, skip: Callable, start: int
) -> tuple[np.ndarray, np.ndarray]:
    """(row, col) that may be among the best ``k`` of their row, rows counted from ``start``."""
    sign = -1 if far else 1

    def edge_of(kth: np.ndarray, own: np.ndarray, off: np.ndarray) -> np.ndarray:
        return -np.sqrt(np.maximum(own - kth - off, 0)) if far else np.sqrt(np.maximum(own + kth + off, 0))

    def reach(edge: np.ndarray, own: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The largest signed score of a row up to the edge, rounded up."""
        with np.errstate(invalid="ignore"):
            squared = -(np.maximum(-edge - _TIE, 0) ** 2) if far else np.maximum(edge + _TIE, 0) ** 2
        to = np.where(np.isfinite(edge), squared + off - sign * own, edge)
        return np.nextafter(to.astype(score.dtype), score.dtype.type(np.inf))

    unknown = np.flatnonzero(edge == np.inf)
    if len(unknown) and score.shape[1] > k:
        tried = sign * score[unknown, : max(TRIED, 8 * k)]
        tried[skip((unknown + start)[:, None], np.arange(tried.shape[1])[None, :])] = np.inf
        kth = np.partition(tried, k - 1, axis=1)[:, k - 1].astype(float)
        edge = edge.copy()
        enough = np.isfinite(kth)
        unknown = unknown[enough]
        edge[unknown] = edge_of(kth[enough], own[unknown], off[unknown])
    to = reach(edge, own, off)[:, None]
    # an unknown edge keeps every number, but no row that is not one
    flat = np.flatnonzero(score >= -to if far else score <= to)
    row, col = np.divmod(flat, score.shape[1])
    kept = ~skip(row + start, col)
    row, col, value = row[kept], col[kept], sign * score.ravel()[flat[kept]]
    held = np.bincount(row, minlength=len(score))
    more = held > k
    if more.any():  # up to the k-th of these only
        order = np.lexsort((value, row))
        row, col, value = row[order], col[order], value[order]
        last = (np.cumsum(held) - held)[more] + k - 1
        to = np.full(len(score), np.inf)
        to[more] = reach(edge_of(value[last].astype(float), own[more], off[more]), own[more], off[more])
        kept = value <= to[row]
        row, col = row[kept], col[kept]
    return row + start, col


def _block_search(sides: Sequence[tuple[bool, int]], skip_self: bool, middle: np.ndarray | float = 0.0):
    def search(queries: pd.DataFrame, corpus: pd.DataFrame) -> pd.DataFrame:
        queries = queries[queries["query_id"].notna()]
        if queries.empty or corpus.empty:
            empty = pd.DataFrame({"query_id": [], "id": [], "dist": [], "far": []})
            return empty.astype({"query_id": "int64", "id": "int64", "dist": "float64", "far": "bool"})
        a = np.stack(queries["v"]).astype(float) - middle
        b = np.stack(corpus["v"]).astype(float) - middle
        qid, cid = queries["query_id"].to_numpy(), corpus["id"].to_numpy()
        edges, wanted = _edges(queries), queries["wanted"].to_numpy()
        limited = [(far, k, np.where((wanted >> i) & 1, edges[:, i], -np.inf)) for i, (far, k) in enumerate(sides)]
        skip = lambda row, col: (qid[row] == cid[col]) & skip_self
        measure = lambda row, col: np.round(np.sqrt(((a[row] - b[col]) ** 2).sum(axis=1)), DIGITS)
        out = []
        for (far, k), (row, col, dist) in zip(sides, _best(a, b, cid, limited, skip, measure, spare=int(skip_self))):
            some = pd.DataFrame({"query_id": qid[row], "id": cid[col], "dist": dist, "far": far})
            some = some.sort_values(["query_id", "dist", "id"], ascending=[True, not far, True])
            out.append(some.groupby("query_id").head(k))
        return pd.concat(out, ignore_index=True)

    return search


def _nearest_of_few(queries: DataFrame, ids: np.ndarray, v: np.ndarray, sides: Sequence[tuple[bool, int]], skip_self: bool) -> DataFrame:
    """(query_id, id, dist, far, rank) among the given rows, which every task gets."""
    middle = v.mean(axis=0)
    corpus = queries.sparkSession.sparkContext.broadcast(pd.DataFrame({"id": ids, "v": list(v - middle)}))
    search = _block_search(sides, skip_self)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 512):
                some = batch[start : start + 512]
                every = {"edges": [np.full(len(sides), np.inf)] * len(some), "wanted": (1 << len(sides)) - 1}
                found = search(some.assign(v=list(np.stack(some["v"]).astype(float) - middle), **every), corpus.value)
                yield found.assign(rank=(found.groupby(["query_id", "far"]).cumcount() + 1).astype("int32"))

    return queries.select("query_id", "v").mapInPandas(run, "query_id bigint, id bigint, dist double, far boolean, rank int")


def _spread(df: DataFrame) -> int:
    """Groups, and blocks of queries, that together make enough pairs for all tasks."""
    return ceil(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) ** 0.5)


def _search(
    visits: DataFrame, rows: DataFrame, held: np.ndarray, middle: np.ndarray, sides: Sequence[tuple[bool, int]], skip_self: bool, block: int
) -> DataFrame:
    """(query_id, id, dist, far): the best rows of each query in each block of the groups it visits.

    Groups are cut into blocks of ``block`` rows, and the queries of a group likewise, into
    more if there would be too few pairs for all tasks; each pair of blocks is a row of
    matrix products. A row is copied once for each block of queries that visit its group, so
    a group that no query visits is not moved at all.
    """
    visits = cut_lineage(visits)
    wanted = np.zeros(len(held), dtype=np.int64)
    for r in visits.select(F.explode("groups").alias("g")).groupBy("g").count().collect():  # the groups
        wanted[r["g"]] = r["count"]
    blocks = [max(1, ceil(int(n) / block)) for n in held]
    few = _spread(visits) if (wanted > 0).sum() < 4 * _spread(visits) else 1
    dealt = [max(1, ceil(int(n) / block), min(few, int(n) // SHARE)) for n in wanted]
    listed = lambda counts: F.array(*[F.lit(n) for n in counts])
    parts, shares = (lambda g: listed(blocks)[g.cast("int")]), (lambda g: listed(dealt)[g.cast("int")])
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    g = F.col("g")
    left = visits.select("query_id", "v", "edges", F.explode(F.arrays_zip("groups", "wanted")).alias("visit"))
    left = left.select("query_id", "v", "edges", F.col("visit.wanted").alias("wanted"), F.col("visit.groups").alias("g"))
    left = left.select("query_id", "v", "edges", "wanted", "g", F.pmod(F.xxhash64("query_id"), shares(g)).cast("int").alias("qb"), upto(parts(g)).alias("cb"))
    visited = F.col("g").isin([int(i) for i in np.flatnonzero(wanted)])
    right = rows.where(visited).select("id", "v", "g", F.pmod(F.xxhash64("id"), parts(g)).cast("int").alias("cb"), upto(shares(g)).alias("qb"))
    keys = ["g", "qb", "cb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys))
    return found.applyInPandas(_block_search(sides, skip_self, middle), "query_id bigint, id bigint, dist double, far boolean")


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str,
    corpus_id: str,
    vector: str,
    far: bool = False,
    skip_self: bool = False,
    block: int = 32_768,
    fitted: int = FITTED,
) -> DataFrame:
    """Exact k nearest (or farthest) by L2: (query_id, id, dist, rank), ties by id.

    Distances count as equal when they agree to nine digits. Rows without a vector are left out.

    A corpus of fewer than ``fitted`` rows is sent to the queries as it is. A larger one is
    dealt to k-means cells, fitted on that many rows of it by hash, and the cells to groups
    of about ``block`` rows. A query first searches the most promising groups; a group is
    searched after that only if, by the triangle inequality, one of its cells can hold a row
    that beats the k-th found. Row pairs are never formed as rows, and neither side has to
    fit anywhere whole.
    """
    return nearest_sides(queries, corpus, [(far, k)], query_id, corpus_id, vector, skip_self, block, fitted).drop("far")


def nearest_sides(
    queries: DataFrame,
    corpus: DataFrame,
    sides: Sequence[tuple[bool, int]],
    query_id: str,
    corpus_id: str,
    vector: str,
    skip_self: bool = False,
    block: int = 32_768,
    fitted: int = FITTED,
) -> DataFrame:
    """:func:`nearest` for the nearest and the farthest at once: (query_id, id, dist, far, rank).

    ``sides`` holds (far, k), at most one of each kind. After the first groups, a pair of blocks
    is compared once for all sides.
    """
    spark = corpus.sparkSession
    typed = lambda df: F.col(vector).cast(_kind(df.select(F.col(vector).alias("v")))).alias("v")
    rows = corpus.where(F.col(vector).isNotNull()).select(F.col(corpus_id).cast("bigint").alias("id"), typed(corpus))
    asked = queries.where(F.col(vector).isNotNull()).select(F.col(query_id).cast("bigint").alias("query_id"), typed(queries))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(fitted).collect()  # a bounded number of rows
    if not sample:
        return spark.createDataFrame([], "query_id bigint, id bigint, dist double, far boolean, rank int")
    v = np.array([r.v for r in sample], dtype=float)
    if len(sample) < fitted:
        return _nearest_of_few(asked, np.array([r.id for r in sample]), v, sides, skip_self)
    middle = v.mean(axis=0)  # distances do not change with the origin, but their rounding does
    v = v - middle
    centres = _k_means(v, max(1, int(2 * len(v) ** 0.5)))
    placed = cut_lineage(_assign(rows, centres, middle))
    counts, radius = np.zeros(len(centres), dtype=np.int64), np.zeros(len(centres))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect():  # the cells
        counts[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    radius *= 1 + 1e-9
    # neighbouring cells make a group, as many groups as blocks, but no more than cells; a query is copied to each it visits
    groups = _k_means(centres, min(len(centres), max(_spread(rows), ceil(int(counts.sum()) / block))))
    cells = Cells(centres, _nearest_centre(centres, groups), counts, radius)
    held = np.bincount(cells.group, weights=counts, minlength=int(cells.group.max()) + 1).astype(np.int64)
    grouped = placed.select("id", "v", F.array(*[F.lit(int(x)) for x in cells.group])[F.col("cell").cast("int")].cast("bigint").alias("g"))

    need = [(far, k + (1 if skip_self else 0)) for far, k in sides]
    dist = F.when(F.col("far"), -F.col("dist")).otherwise(F.col("dist"))
    w = Window.partitionBy("query_id", "far").orderBy(dist, "id")
    last = F.when(F.col("far"), dict(sides).get(True, 0)).otherwise(dict(sides).get(False, 0))
    best = lambda df: df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= last)
    firsts = []
    for side, wide in zip(sides, need):
        visits = _visits_of_sides(asked.withColumn("edges", F.array(F.lit(float("inf")))), cells, [wide], False, middle)
        firsts.append(_search(visits, grouped, held, middle, [side], skip_self, block))
    first = cut_lineage(best(reduce(DataFrame.unionByName, firsts)))
    edge = lambda far: F.max(F.when(F.col("far") == F.lit(far), dist)).alias(f"edge_{far}")
    edges = first.where(F.col("rank") == last).groupBy("query_id").agg(*[edge(far) for far, _ in sides])
    again = asked.join(edges, "query_id", "left").select("query_id", "v", F.array(*[F.col(f"edge_{far}") for far, _ in sides]).alias("edges"))
    rest = _search(_visits_of_sides(again, cells, need, True, middle), grouped, held, middle, sides, skip_self, block)
    return best(first.drop("rank").unionByName(rest))


def nearest_by(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    query_id: str,
    corpus_id: str,
    vector: str,
    embed: Callable[[Column], Column],
    dist: Callable[[Column, Column], Column],
    **options,
) -> DataFrame:
    """Exact k nearest by a distance of the caller's: (query_id, id, dist, rank).

    ``embed`` maps a vector to where L2 orders pairs as ``dist`` does (unit length for the
    cosine distance), so that cells can be skipped. Vectors that it maps to null are left out.
    """
    mapped = [df.withColumn(vector, embed(F.col(vector))) for df in (queries, corpus)]
    found = nearest(*mapped, k, query_id, corpus_id, vector, **options).drop("dist")
    asked = queries.select(F.col(query_id).cast("bigint").alias("query_id"), F.col(vector).alias("_a"))
    held = corpus.select(F.col(corpus_id).cast("bigint").alias("id"), F.col(vector).alias("_b"))
    joined = found.join(asked, "query_id").join(held, "id")
    return joined.select("query_id", "id", dist(F.col("_a"), F.col("_b")).alias("dist"), "rank")


def small_world_graph(
    points: DataFrame, id_col: str, vector: str, near_pool=10, near_edges=5, far_pool=10, far_edges=5, seed=0
) -> DataFrame:
    """(src, dst, kind, dist): hashed choices among the nearest and among the farthest points."""
    found = nearest_sides(points, points, [(False, near_pool), (True, far_pool)], id_col, id_col, vector, skip_self=True)
    kind = F.when(F.col("far"), "far").otherwise("near")
    # at most the pool's rows per point and kind
    w = Window.partitionBy("query_id", "far").orderBy(hash_order(F.col("query_id"), F.col("id"), kind, seed), "id")
    chosen = found.withColumn("_i", F.row_number().over(w)).where(F.col("_i") <= F.when(F.col("far"), far_edges).otherwise(near_edges))
    return chosen.select(F.col("query_id").alias("src"), F.col("id").alias("dst"), kind.alias("kind"), "dist")


def graph_search(
    queries: DataFrame,
    query_id: str,
    points: DataFrame,
    point_id: str,
    vector: str,
    edges: DataFrame,
    k: int = 10,
    beam: int = 20,
    starts: int = 5,
    dist: Callable[[Column, Column], Column] = vectors.l2,
    seed: int = 0,
) -> DataFrame:
    """Greedy search of a neighbour graph for all queries at once: (query_id, id, dist, rank).

    Each step expands the open points among the best ``beam`` of every query by one join
    with the edges. It ends when no query has an open point left. A query never holds more
    than ``beam`` points plus their neighbours.
    """
    q = cut_lineage(queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("_qv")))
    p = cut_lineage(points.select(F.col(point_id).alias("id"), F.col(vector).alias("_pv")))
    links = cut_lineage(edges.select("src", "dst").distinct())
    entry = p.select("id").orderBy(F.md5(F.concat_ws("_", F.col("id").cast("string"), F.lit(str(seed))))).limit(starts)
    ids = [r["id"] for r in entry.collect()]

    def measured(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(q, "query_id").join(p, "id")
        return joined.select("query_id", "id", dist(F.col("_qv"), F.col("_pv")).alias("dist"))

    first = q.select("query_id", F.explode(F.array(*[F.lit(i) for i in ids])).alias("id"))
    state = cut_lineage(measured(first).withColumn("open", F.lit(True)))
    seen = cut_lineage(state.select("query_id", "id"))
    w = Window.partitionBy("query_id").orderBy("dist", "id")
    while True:
        grow = state.where("open")
        steps = grow.join(links, F.col("id") == F.col("src")).select("query_id", F.col("dst").alias("id")).distinct()
        new = cut_lineage(measured(steps.join(seen, ["query_id", "id"], "left_anti")).withColumn("open", F.lit(True)))
        if new.isEmpty():
            break
        both = state.withColumn("open", F.lit(False)).unionByName(new)
        state = cut_lineage(both.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= beam).drop("_r"))
        seen = cut_lineage(seen.unionByName(new.select("query_id", "id")))
        if state.where("open").isEmpty():
            break
    return state.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("open")


def hashed_neighbours(points: DataFrame, id_col: str, vector: str, k: int, bucket: float, tables: int, radius: float) -> DataFrame:
    """Approximate neighbours within ``radius`` by random projections: (query_id, id, dist, rank).

    Rows are compared that share a bucket of any of the ``tables``. Rows of a bucket are cut
    into blocks; each pair of blocks is a row of matrix products that returns the best
    ``k`` per row, so pairs are never formed as rows, however wide the buckets are. A pair is compared
    in the first table that it shares a bucket of. Each block of the first table is compared with itself
    first; a row's ``k``-th distance there is how far it looks in all others. Repeated rows count once.
    """
    kind = points.schema[id_col].dataType.simpleString()
    rows = points.select(F.col(id_col).alias("id"), F.col(vector).alias("v0"), array_to_vector(vector).alias("v"))
    lsh = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket, numHashTables=tables, seed=0)
    hashes = F.array(*[vector_to_array(F.col("h")[i])[0] for i in range(tables)]).alias("h")
    hashed = lsh.fit(rows).transform(rows).select("id", F.col("v0").alias("v"), hashes).distinct()
    rows = cut_lineage(hashed.withColumn("uid", F.monotonically_increasing_id()))
    sizes = rows.select(F.posexplode("h").alias("t", "b")).groupBy("t", "b").agg(F.count(F.lit(1)).alias("n"))
    # up to four smaller blocks of a bucket that has few rows
    count = F.greatest(F.ceil(F.col("n") / HASHED), F.least(F.ceil(F.col("n") / (HASHED // 16)), F.lit(4)))
    parts = cut_lineage(sizes.select("t", "b", count.alias("n")))
    part = F.pmod(F.xxhash64("uid"), F.col("n")).alias("p")
    columns = ["uid", "id", "v", "h", "edge"]

    def placed(df: DataFrame, of: Column) -> DataFrame:
        exploded = df.select("*", F.posexplode("h").alias("t", "b")).where(of)
        return exploded.join(parts, ["t", "b"]).select("t", "b", *columns, part, "n")

    def search(block: pd.DataFrame) -> pd.DataFrame:
        table, x, y = int(block["t"].iloc[0]), block["x"].iloc[0], block["y"].iloc[0]
        sides = [block[block["p"] == side] for side in (x, y)]
        found = [_hashed_pairs(*pair, table, k, radius) for pair in ([sides] if x == y else [sides, sides[::-1]])]
        return pd.concat(found, ignore_index=True)

    schema = f"uid bigint, query_id {kind}, id {kind}, dist double"
    keys = ["t", "b", "x", "y"]
    own = placed(rows.withColumn("edge", F.lit(float("inf"))), F.col("t") == 0)
    own = own.select("t", "b", F.col("p").alias("x"), F.col("p").alias("y"), "p", *columns)
    first = cut_lineage(own.groupBy(*keys).applyInPandas(search, schema))
    edges = first.groupBy("uid").agg(F.when(F.count(F.lit(1)) >= k, F.max("dist")).otherwise(float(radius)).alias("edge"))
    # a row that found nothing looks as far as the radius
    known = cut_lineage(rows.join(edges, "uid", "left").fillna(float(radius), ["edge"]))
    met = placed(known, F.lit(True)).select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("q"))
    met = met.where((F.col("t") > 0) | (F.col("p") != F.col("q")))
    blocks = met.select("t", "b", F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y"), "p", *columns)
    rest = blocks.groupBy(*keys).applyInPandas(search, schema)
    w = Window.partitionBy("query_id").orderBy("dist", "id")
    found = first.unionByName(rest).drop("uid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _hashed_pairs(left: pd.DataFrame, right: pd.DataFrame, table: int, k: int, radius: float) -> pd.DataFrame:
    """(uid, query_id, id, dist): the best ``k`` rows of ``right`` for each row of ``left`` that share no bucket of an earlier table."""
    # a null id is next to nothing
    left, right = left[left["id"].notna()], right[right["id"].notna()]
    uid, aid, bid = left["uid"].to_numpy(), left["id"].to_numpy(), right["id"].to_numpy()
    out = [pd.DataFrame({"uid": uid[:0], "query_id": aid[:0], "id": bid[:0], "dist": np.zeros(0)})]
    if len(left) and len(right):
        a, b = (np.stack(side["v"]).astype(float) for side in (left, right))
        ha, hb = (np.stack(side["h"])[:, :table] for side in (left, right))
        edge = left["edge"].to_numpy().astype(float)
        for rows, cols in _strangers(ha, hb):
            some, others, h, g = a[rows], b[cols], ha[rows], hb[cols]
            ids, other_ids = aid[rows], bid[cols]

            def skip(row: np.ndarray, col: np.ndarray) -> np.ndarray:
                known = ids[row] == other_ids[col]
                for earlier in range(table):
                    known = known | (h[row, earlier] == g[col, earlier])
                return known

            def measure(row: np.ndarray, col: np.ndarray) -> np.ndarray:
                # in the order of the components, as Spark adds them up
                squared = np.zeros(len(row))
                for d in range(some.shape[1]):
                    squared += (some[row, d] - others[col, d]) ** 2
                return np.sqrt(squared)

            ((row, col, dist),) = _best(some, others, other_ids, [(False, k, edge[rows])], skip, measure, radius)
            out.append(pd.DataFrame({"uid": uid[rows][row], "query_id": ids[row], "id": other_ids[col], "dist": dist}))
    return pd.concat(out[1:] or out, ignore_index=True)


def _strangers(ha: np.ndarray, hb: np.ndarray) -> Iterator[tuple[np.ndarray | slice, np.ndarray | slice]]:
    """Rows of two blocks whose hashes are worth comparing: those of ``hb`` that share none with some of the rows of ``ha``.

    Rows are gathered by their hashes, so that wide buckets, which few distinct hashes tell apart, are left out whole.
    """
    every = slice(None)
    if not ha.shape[1]:
        yield every, every
        return
    (ua, ia), (ub, ib) = (np.unique(h, axis=0, return_inverse=True) for h in (ha, hb))
    ia, ib = ia.ravel(), ib.ravel()
    order = np.argsort(ia, kind="stable")
    ends = np.cumsum(np.bincount(ia, minlength=len(ua)))
    start = first = 0
    for last, end in enumerate(ends):
        if end - start < GATHERED and end < len(order):
            continue
        apart = np.zeros(len(ub), dtype=bool)
        for hashes in ua[first : last + 1]:
            apart |= (ub != hashes).all(axis=1)
        cols = np.flatnonzero(apart[ib])
        if len(cols):
            yield order[start:end], every if len(cols) > 0.8 * len(ib) else cols
        start, first = end, last + 1


def recall(found: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Share of the true neighbours that were found, per query."""
    hit = truth.join(found.select("query_id", "id").withColumn("hit", F.lit(1)), ["query_id", "id"], "left")
    return hit.groupBy("query_id").agg((F.coalesce(F.sum("hit"), F.lit(0)) / F.lit(k)).alias("recall"))


def refresh_index(vector_table: DataFrame, path: str) -> int:
    """Overwrite the vector table and return how many vectors it holds."""
    vector_table.write.mode("overwrite").parquet(path)
    return vector_table.sparkSession.read.parquet(path).count()
