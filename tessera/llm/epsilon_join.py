"""Embedding near-duplicates by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.plans.prefix import cut_lineage, prefix

#: Vectors on which the leading directions are fitted, at most; any directions give the same links.
FITTED = 2048
#: Leading directions of the grid, vectors of a block, children of an interval, vectors of the smallest interval.
DIRECTIONS, BLOCK, FAN, LEAF = 8, 1024, 8, 128

_PAIR = ["label", "dim"]

#: The same rows in SQL: every pair of a label compared, components by closure.
ORACLE = """
WITH RECURSIVE usable AS (SELECT vec_id, label, e FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
    WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
least_of AS (SELECT x AS vec_id, min(y) AS least_id FROM reached GROUP BY 1),
counted AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, CAST(coalesce(least(least_id, vec_id), vec_id) AS BIGINT) AS component_id,
    coalesce(least(least_id, vec_id), vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least_of USING (vec_id) LEFT JOIN counted USING (vec_id)
"""


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(label, embedding, rep, copies): equal vectors once, rep being the smallest vec_id of them."""
    usable = vectors.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & _valid(F.col("embedding")))
    return usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))


def _directions(distinct: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension seen in a bounded sample: the leading principal directions, as columns."""
    sample = distinct.orderBy(F.xxhash64("rep"), "rep").select("embedding").limit(FITTED).collect()
    by_dim: dict[int, list] = {}
    for row in sample:
        by_dim.setdefault(len(row.embedding), []).append(row.embedding)
    out = {}
    for dim, rows in by_dim.items():
        unit = _unit(np.array(rows, dtype=np.float64))
        out[dim] = np.linalg.svd(unit - unit.mean(axis=0), full_matrices=False)[2][:DIRECTIONS].T
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares can't overflow or vanish
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _grid_order(distinct: DataFrame, eps: float) -> DataFrame:
    """Add ``dim``, the place along each direction and the grid cells, of side ``eps``."""
    shared = distinct.sparkSession.sparkContext.broadcast(_directions(distinct))
    schema = distinct.schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            dims = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                basis = shared.value.get(dim, np.eye(dim)[:, :DIRECTIONS])
                place = np.zeros((own.num_rows, DIRECTIONS))
                place[:, : basis.shape[1]] = _unit(_matrix(own.column("embedding"), dim)) @ basis
                cells = np.floor(place / eps).astype(np.int64)
                added = [pa.array([dim] * own.num_rows, pa.int32()), pa.array(list(place)), pa.array(list(cells))]
                yield pa.RecordBatch.from_arrays([*own.columns, *added], [*own.schema.names, "dim", "place", "cell"])

    return distinct.mapInArrow(run, f"{schema}, dim int, place array<double>, cell array<bigint>")


def _blocks(ordered: DataFrame) -> DataFrame:
    """Rows of up to 1024 neighbours in grid order, all of one label and dimension, with the box around them."""
    parts = int(ordered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*_PAIR, "cell", "place", "rep"]
    # ranges of the grid order, so that a label of many rows spans many partitions
    ranged = ordered.repartitionByRange(parts, *by).sortWithinPartitions(*by)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, TaskContext.get().partitionId() << 32
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            held = held.combine_chunks()
            keys = np.stack([held.column(c).to_numpy() for c in _PAIR])
            while held.num_rows:
                same = (keys == keys[:, :1]).all(axis=0)
                end = min(BLOCK, int(np.argmin(same)) if not same.all() else held.num_rows)
                if end == held.num_rows < BLOCK:
                    break  # more of it may follow
                yield block(held.slice(0, end), number)
                held, keys, number = held.slice(end), keys[:, end:], number + 1
        if held is not None and held.num_rows:
            yield block(held, number)

    def block(rows: pa.Table, number: int) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        place = np.stack(rows.column("place").to_pylist()).astype(np.float64)
        vectors = rows.column("embedding").chunk(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        one = [rows.column("label")[0].as_py(), rows.column("dim")[0].as_py(), number, place.min(axis=0), place.max(axis=0)]
        many = [rows.column("rep").to_pylist(), rows.column("copies").to_pylist(), place.tobytes(), vectors.tobytes()]
        kinds = [rows.schema.field("label").type, *types]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip([*one, *many], kinds, strict=True)], names)

    names = [*_PAIR, "block", "low", "high", "reps", "copies", "place", "vectors"]
    doubles, longs = pa.list_(pa.float64()), pa.list_(pa.int64())
    types = [pa.int32(), pa.int64(), doubles, doubles, longs, longs, pa.binary(), pa.binary()]
    schema = f"label {ordered.schema['label'].dataType.simpleString()}, dim int, block bigint, low array<double>, high array<double>, reps array<bigint>, copies array<bigint>, place binary, vectors binary"
    return ranged.mapInArrow(pack, schema)


def _near(eps: float) -> Column:
    """Whether two boxes (low, high and low2, high2) come within ``eps``."""
    gaps = F.zip_with(
        F.zip_with("low", "high2", lambda a, b: a - b),
        F.zip_with("low2", "high", lambda a, b: a - b),
        lambda a, b: F.greatest(a, b, F.lit(0.0)),
    )
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= eps * eps


def _interval_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """(label, dim, left, right): pairs of blocks that may hold linked vectors, by recursion on intervals.

    Intervals of the grid order form a tree of fan-out 8 over each label's blocks. From its
    root on, the pairs that come within ``eps`` are replaced by the pairs of their children.
    """
    numbered = cut_lineage(prefix(blocks.select(*_PAIR, "block", "low", "high"), _PAIR, ["block"], pos="_pos"))
    most = numbered.agg(F.max("_pos")).first()[0] or 0
    levels = 0
    while FAN**levels < most:
        levels += 1
    pairs = numbered.select(*_PAIR).distinct().withColumns({"left": F.lit(0).cast("bigint"), "right": F.lit(0).cast("bigint")})
    for level in reversed(range(levels)):
        node = F.floor((F.col("_pos") - 1) / F.lit(FAN**level)).cast("bigint")
        sides = [F.array(*[f(F.get(c, F.lit(i))) for i in range(DIRECTIONS)]).alias(c) for c, f in (("low", F.min), ("high", F.max))]
        boxes = numbered.groupBy(*_PAIR, node.alias("node")).agg(*sides)
        both = F.sequence(F.lit(0), F.lit(FAN - 1))
        children = pairs.withColumn("_a", F.explode(both)).withColumn("_b", F.explode(both)).select(
            *_PAIR, (F.col("left") * FAN + F.col("_a")).alias("left"), (F.col("right") * FAN + F.col("_b")).alias("right")
        )
        left = boxes.withColumnRenamed("node", "left")
        right = boxes.select(*_PAIR, F.col("node").alias("right"), F.col("low").alias("low2"), F.col("high").alias("high2"))
        joined = children.where("left <= right").join(left, [*_PAIR, "left"]).join(right, [*_PAIR, "right"])
        pairs = cut_lineage(joined.where(_near(eps)).select(*_PAIR, "left", "right"))
    ids = numbered.select(*_PAIR, (F.col("_pos") - 1).alias("_at"), "block")
    first = ids.select(*_PAIR, F.col("_at").alias("left"), F.col("block").alias("a"))
    second = ids.select(*_PAIR, F.col("_at").alias("right"), F.col("block").alias("b"))
    return pairs.join(first, [*_PAIR, "left"]).join(second, [*_PAIR, "right"]).select("a", "b")


def _linked(a: np.ndarray, b: np.ndarray, place_a: np.ndarray, place_b: np.ndarray, least: float, eps: float, same: bool) -> np.ndarray:
    """Which rows of two blocks are linked: halves of intervals are joined in turn, distant ones skipped."""
    out = np.zeros((len(a), len(b)), dtype=bool)
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if same and i >= m:
            continue
        p, q = place_a[i:j], place_b[k:m]
        gap = np.maximum(0, np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0)))
        if gap @ gap > eps * eps:
            continue
        if max(j - i, m - k) <= LEAF:
            out[i:j, k:m] = a[i:j] @ b[k:m].T >= least
        elif j - i >= m - k:
            half = (i + j) // 2
            todo += [(i, half, k, m), (half, j, k, m)]
        else:
            half = (k + m) // 2
            todo += [(i, j, k, half), (i, j, half, m)]
    return np.triu(out, 1) if same else out


def _join_blocks(pairs: DataFrame, blocks: DataFrame, least: float, eps: float) -> DataFrame:
    """(rep, links, root): for each vector of a pair of blocks with links there, their number and a vector it is joined to.

    All pairs of a group are counted in the matrix, not emitted.
    """
    columns = ["reps", "copies", "place", "vectors"]
    side = lambda s, key: blocks.select(F.col("block").alias(key), "dim", *[F.col(c).alias(f"{c}_{s}") for c in columns])
    joined = pairs.join(side("a", "a"), "a").join(side("b", "b").drop("dim"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in batch.schema.names}
                rep = [np.array(row[f"reps_{s}"], dtype=np.int64) for s in "ab"]
                copies = [np.array(row[f"copies_{s}"], dtype=np.int64) for s in "ab"]
                place = [np.frombuffer(row[f"place_{s}"]).reshape(-1, DIRECTIONS) for s in "ab"]
                unit = [_unit(np.frombuffer(row[f"vectors_{s}"]).reshape(-1, row["dim"])) for s in "ab"]
                same = row["a"] == row["b"]
                linked = _linked(*unit, *place, least, eps, same)
                links = [linked @ copies[1], linked.T @ copies[0]]
                some = [linked.any(axis=1), linked.any(axis=0)]
                if same:
                    links, some, rep = [links[0] + links[1]] * 2, [some[0] | some[1]] * 2, [rep[0], rep[0]]
                    linked = linked | linked.T
                cut = linked[some[0]][:, some[1]]
                root = [rep[0][some[0]], rep[1][some[1]]]
                top = np.iinfo(np.int64).max
                while cut.size:  # the least of each component spreads along the links
                    before = root[0].copy()
                    root[1] = np.minimum(root[1], np.where(cut, root[0][:, None], top).min(axis=0))
                    root[0] = np.minimum(root[0], np.where(cut, root[1][None, :], top).min(axis=1))
                    if (before == root[0]).all():
                        break
                for s in (0,) if same else (0, 1):
                    columns = [rep[s][some[s]], links[s][some[s]], root[s]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rep", "links", "root"])

    return joined.mapInArrow(run, "rep bigint, links bigint, root bigint")


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Two vectors of one label are linked if their cosine is ``least`` or more. Unit vectors
    that close lie within eps = sqrt(2 - 2 * least), also in any projection. The grid order
    sorts each label by cells of side eps along the leading principal directions; intervals
    of that order are joined recursively and skipped where their boxes are further apart, so
    that the result is that of comparing all pairs. Equal vectors are taken as one.

    n_links: other vectors linked directly. component_id: smallest vec_id reachable. Vectors
    that are null, empty, zero or hold null or non-finite components, and rows without a label
    or vec_id, link with nothing: n_links 0, component_id = vec_id. Vectors of different
    length don't link. Rows that repeat a vec_id are taken to be one vector's. An empty table
    gives no rows; extra columns are ignored.
    """
    vectors = vectors.select("vec_id", "embedding", "label")
    eps = float(np.sqrt(2 - 2 * least)) + 1e-9
    distinct = cut_lineage(_distinct_vectors(vectors))
    blocks = cut_lineage(_blocks(_grid_order(distinct, eps)))
    found = cut_lineage(_join_blocks(_interval_pairs(blocks, eps), blocks, least, eps))
    roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = distinct.join(links, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("label").alias("_label"), F.col("embedding").alias("_vector"), "rep", "root", "links", "copies"
    )
    # only rows that can link have the key of the join
    can = F.col("vec_id").isNotNull() & _valid(F.col("embedding"))
    keyed = vectors.withColumn("label", F.when(can, F.col("label")))
    joined = keyed.join(named, (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_vector")), "left")
    component = F.coalesce("root", "rep", "vec_id")
    return joined.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("bigint").alias("n_links"),
        component.cast("bigint").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
