"""Exact cosine search.

Scores come from one matrix product per Arrow batch; Spark splits the corpus, ships the
queries and merges the partial results. Two plans:

* scan: the queries fit a checked size, so they are broadcast and the corpus is read once,
  in place, without a shuffle. Each task sends on at most k rows per query.
* grid: both sides are cut into slices of bounded size and every (query slice, corpus
  slice) meets in its own task, again sending on at most k rows per query.

In the grid, corpus vectors are laid out in cells around pivot vectors, and a query slice
only visits the cells that can still hold one of its k best (a bound from the angles
between query, pivot and cell border), so clustered data is not compared all against all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.rank import diversify, topk_per_key
from shelfmark.session import BROADCAST_BYTES, durable

# Scores are compared at this many digits, so that equal vectors tie whatever their place
# in a matrix product.
TIE_DIGITS = 9
# Queries per matrix product inside a task.
STEP = 128
# Corpus rows that give a query its first floor, before it meets all of them.
LOOK = 1_024
# A corpus of fewer rows is dealt over all cores when this many queries scan it.
SPREAD_ROWS, SPREAD_QUERIES = 4_000_000, 1_000
# Vectors of one side in one grid task: this many at least, more where they are short, and of
# a large table as many as leave a few tasks to a core, up to a bound on their size.
SLICE_ROWS = 8_192
SLICE_BYTES = 8 * 1024 * 1024
MOST_SLICE_BYTES = 64 * 1024 * 1024
MAX_PIVOTS = 512
# Tasks that the meetings of all slices are dealt over, two to a meeting if there are few.
MOST_TASKS = 2_000


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit rows from a list column; a zero vector stays zero and scores 0 everywhere."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if n == 0:
        return values.reshape(0, 0)
    lengths = np.asarray(column.value_lengths())
    if (lengths != lengths[0]).any():
        raise ValueError("vectors differ in length")
    m = values.reshape(n, int(lengths[0]))
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    out = column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()
    return out.astype(str) if out.dtype == object else out


class _Side:
    """One side of a comparison, as numpy arrays."""

    def __init__(self, data: pa.RecordBatch | pa.Table):
        self.id_column = _flat(data.column("id"))
        self.ids = _ids(self.id_column)
        self.unit = matrix(data.column("vector"))
        names = data.schema.names
        self.within = _ids(_flat(data.column("within"))) if "within" in names else None
        self.one_per = _ids(_flat(data.column("one_per"))) if "one_per" in names else None
        self.floor = data.column("floor").to_numpy() if "floor" in names else None
        # Score of the k-th best of each query so far, where a task has one.
        self.least: np.ndarray | None = None


def _codes(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, codes = np.unique(np.concatenate([a, b]), return_inverse=True)
    return codes[: len(a)], codes[len(a) :]


def _cut(r, v, ids, groups, k: int) -> np.ndarray:
    """Positions of the k best of each query row, at most one per group, in order."""
    order = np.lexsort((ids, -v, r))
    if groups is not None:
        _, codes = np.unique(groups, return_inverse=True)
        key = r[order] * (codes.max(initial=0) + 1) + codes[order]
        _, first_of_group = np.unique(key, return_index=True)
        order = order[np.sort(first_of_group)]
    rows = r[order]
    return order[np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k]


def _best(
    q: _Side, c: _Side, k: int | None, threshold: float | None, drop_self: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, corpus row, score) of the k best or all that reach the threshold.

    With a ``within`` value only rows of the same value are compared at all; queries with a
    ``floor`` have their own threshold.
    """
    if len(q.unit) and len(c.unit) and q.unit.shape[1] != c.unit.shape[1]:
        raise ValueError("vectors differ in length")
    if q.within is None or c.within is None:
        return _best_of(q, c, np.arange(len(q.unit)), np.arange(len(c.unit)), k, threshold, drop_self)
    q_codes, c_codes = _codes(q.within, c.within)
    q_order, c_order = np.argsort(q_codes, kind="stable"), np.argsort(c_codes, kind="stable")
    parts = []
    for code in np.intersect1d(q_codes, c_codes):
        q_rows = q_order[slice(*np.searchsorted(q_codes[q_order], [code, code + 1]))]
        c_rows = c_order[slice(*np.searchsorted(c_codes[c_order], [code, code + 1]))]
        parts.append(_best_of(q, c, q_rows, c_rows, k, threshold, drop_self))
    if not parts:
        return _nothing()
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _nothing() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    empty = np.zeros(0, dtype=np.int64)
    return empty, empty, np.zeros(0)


def _best_of(q, c, q_rows, c_rows, k, threshold, drop_self):
    """The same for chosen rows of either side.

    All pairs are compared in single precision first. What can reach a query's floor, by the
    bound on the error of such a product, is scored in double precision.
    """
    rows, cols, vals = [], [], []
    unit, c_ids = c.unit[c_rows], c.ids[c_rows]
    groups = None if c.one_per is None else np.unique(c.one_per[c_rows], return_inverse=True)[1]
    near, slack = unit.astype(np.float32).T, (unit.shape[1] + 8) * float(np.finfo(np.float32).eps)
    look = np.linspace(0, len(c_rows) - 1, min(LOOK, len(c_rows))).astype(np.int64)
    for start in range(0, len(q_rows), STEP):
        mine = q_rows[start : start + STEP]
        asked = q.unit[mine]
        floor = np.full(len(mine), -2.0 if threshold is None else threshold) if q.floor is None else q.floor[mine]
        least = np.full(len(mine), -2.0) if q.least is None else q.least[mine].copy()
        if k is not None and len(c_rows) > k:
            for seen in (look, slice(None))[: 1 + (len(look) < len(c_rows))]:
                new = np.flatnonzero(least == -2.0)
                if len(new):
                    own = q.ids[mine[new], None] == c_ids[seen] if drop_self else None
                    least[new] = _kth(asked[new] @ unit[seen].T, own, None if groups is None else groups[seen], k)
        floor = np.maximum(floor, least)
        close = asked.astype(np.float32) @ near
        r, col = np.divmod(np.flatnonzero(close >= (floor - slack)[:, None].astype(np.float32)), close.shape[1])
        if len(r) * 32 > close.size:
            v = (asked @ unit.T)[r, col]
        else:
            v = np.einsum("ij,ij->i", asked[r], unit[col])
        v = np.round(v, TIE_DIGITS) + 0.0
        kept = v >= floor[r]
        if drop_self:
            kept &= q.ids[mine][r] != c_ids[col]
        r, col, v = r[kept], col[kept], v[kept]
        if k is not None and len(r):
            keep = _cut(r, v, c_ids[col], None if groups is None else groups[col], k)
            r, col, v = r[keep], col[keep], v[keep]
        rows.append(mine[r])
        cols.append(c_rows[col])
        vals.append(v)
    if not rows:
        return _nothing()
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)


def _kth(s: np.ndarray, own: np.ndarray | None, groups: np.ndarray | None, k: int) -> np.ndarray:
    """A score that the k-th best of a row does not fall below, each group counted once; else -2."""
    if own is not None:
        s[own] = -np.inf
    if groups is not None:
        order = np.argsort(groups, kind="stable")
        starts = np.flatnonzero(np.diff(groups[order], prepend=-1))
        if len(starts) < len(groups):
            s = np.maximum.reduceat(s[:, order], starts, axis=1)
    if s.shape[1] < k:
        return np.full(len(s), -2.0)
    # Sums in another order differ by less than the digits that count.
    return np.maximum(np.partition(s, -k, axis=1)[:, -k] - 2 * 10.0**-TIE_DIGITS, -2.0)


def _emit(schema: pa.Schema, q_col, c_col, r, c, v) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            q_col.take(pa.array(r)).cast(schema.field(0).type),
            c_col.take(pa.array(c)).cast(schema.field(1).type),
            pa.array(v, type=pa.float64()),
        ],
        schema=schema,
    )


def _flat(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _result_types(queries: DataFrame, corpus: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["id"].dataType),
            T.StructField("id", corpus.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _arrow_schema(st: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(st)


def _scan(queries, corpus, k, threshold, drop_self) -> DataFrame:
    out = _result_types(queries, corpus)
    # Bounded by the caller's size check, like the small side of a broadcast join.
    shipped = corpus.sparkSession.sparkContext.broadcast(queries.toArrow())
    schema = _arrow_schema(out)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = _Side(shipped.value)
        # The best of all batches of the task so far: at most k rows per query.
        best = None
        for batch in batches:
            if not batch.num_rows or not len(q.unit):
                continue
            c = _Side(batch)
            r, col, v = _best(q, c, k, threshold, drop_self)
            if k is None:
                yield _emit(schema, q.id_column, c.id_column, r, col, v)
                continue
            new = [r, v, c.ids[col], None if c.one_per is None else c.one_per[col], c.id_column.take(pa.array(col))]
            if best is not None:
                new = [_joined(a, b) for a, b in zip(best, new, strict=True)]
                keep = _cut(*new[:4], k)
                new = [None if x is None else x.take(pa.array(keep)) if isinstance(x, pa.Array) else x[keep] for x in new]
            best = new
            q.least = _least(best[0], best[1], len(q.unit), k)
        if best is not None:
            r, v, _, _, ids = best
            yield _emit(schema, q.id_column, ids, r, np.arange(len(r)), v)

    return corpus.mapInArrow(search, out)


def _least(r: np.ndarray, v: np.ndarray, n: int, k: int) -> np.ndarray:
    """The smallest score of each of n queries that has its k rows, else -2."""
    least = np.full(n, np.inf)
    np.minimum.at(least, r, v)
    return np.where(np.bincount(r, minlength=n) >= k, least, -2.0)


def _joined(a, b):
    if a is None:
        return None
    return pa.concat_arrays([a, b]) if isinstance(a, pa.Array) else np.concatenate([a, b])


def _slice_rows(n: int, dim: int, cores: int) -> int:
    """Rows of a slice of the larger side, n vectors.

    A vector travels once for each slice it meets, so the number of slices stays the same as a
    table grows, and what is moved grows as the table does, until slices are as large as may be.
    """
    least, most = (max(SLICE_ROWS, b // (8 * max(dim, 1))) for b in (SLICE_BYTES, MOST_SLICE_BYTES))
    return min(max(math.ceil(n / math.ceil(math.sqrt(4 * cores))), least), most)


def _pivots(corpus: DataFrame, n: int, rows: int) -> np.ndarray:
    count = min(MAX_PIVOTS, max(1, math.isqrt(max(n // rows, 1)) * 4))
    picked = corpus.orderBy(F.xxhash64("id"), "id").limit(count).select("vector").toArrow()
    return matrix(picked.column("vector"))


def _place(df: DataFrame, pivots) -> DataFrame:
    """Add each vector's nearest pivot and its angle to it."""
    out = T.StructType(
        [*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())]
    )
    schema = _arrow_schema(out)

    def place(batches):
        p = pivots.value
        for batch in batches:
            if not batch.num_rows:
                continue
            s = matrix(batch.column("vector")) @ p.T
            cell = s.argmax(axis=1)
            angle = np.arccos(np.clip(s[np.arange(len(s)), cell], -1.0, 1.0))
            columns = [*batch.columns, pa.array(cell, pa.int32()), pa.array(angle, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, schema)], schema=schema
            )

    return df.mapInArrow(place, out)


def _grid_join(routed, sliced, k, threshold, drop_self, out, tasks) -> DataFrame:
    schema = _arrow_schema(out)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        q, c = _Side(left), _Side(right)
        hit = _best(q, c, k, threshold, drop_self)
        return pa.Table.from_batches([_emit(schema, q.id_column, c.id_column, *hit)])

    left_keys, right_keys = ["q_slice", "cell", "c_slice"], ["r_query", "r_cell", "r_slice"]
    # By bytes Spark would put several meetings into one task, but they cost seconds, not bytes.
    routed, sliced = routed.repartition(tasks, *left_keys), sliced.repartition(tasks, *right_keys)
    return routed.groupBy(*left_keys).cogroup(sliced.groupBy(*right_keys)).applyInArrow(search, out)


def _routes(queries: DataFrame, pivots, cells, floor: str) -> DataFrame:
    """Cells that can hold a score of at least the query's floor, exploded."""
    out = T.StructType([*queries.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    schema = _arrow_schema(out)

    def route(batches):
        p = pivots.value
        ids, radius = cells.value
        for batch in batches:
            if not batch.num_rows:
                continue
            angle = np.arccos(np.clip(matrix(batch.column("vector")) @ p[ids].T, -1.0, 1.0))
            bound = np.cos(np.maximum(angle - radius[None, :], 0.0))
            limits = batch.column(floor).to_numpy(zero_copy_only=False)
            open_cells = [ids[row] for row in bound >= limits[:, None] - 1e-7]
            columns = [*batch.columns, pa.array([x.tolist() for x in open_cells], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, schema)], schema=schema
            )

    return queries.mapInArrow(route, out).withColumn("cell", F.explode("cells")).drop("cells")


def _grid(queries, corpus, k, threshold, drop_self, n_queries, n_corpus, slice_rows, cell_rows=SLICE_ROWS) -> DataFrame:
    sc = corpus.sparkSession.sparkContext
    out = _result_types(queries, corpus)
    pivots = sc.broadcast(_pivots(corpus, n_corpus, cell_rows))
    placed = durable(_place(corpus, pivots))
    # At most MAX_PIVOTS rows come back.
    stats = (
        placed.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius"))
        .orderBy("cell")
        .toArrow()
    )
    cell_ids = stats.column("cell").to_numpy()
    slices_per_cell = np.ceil(stats.column("n").to_numpy() / slice_rows).astype(int)
    cells = sc.broadcast((cell_ids, stats.column("radius").to_numpy()))
    per_cell = F.element_at(
        F.create_map(
            *[F.lit(int(x)) for pair in zip(cell_ids, slices_per_cell) for x in pair]
        ),
        F.col("cell"),
    )
    q_slices = max(1, math.ceil(n_queries / slice_rows))
    tasks = min(MOST_TASKS, 2 * q_slices * int(slices_per_cell.sum()))
    own = "floor" in queries.columns

    placed = placed.withColumn("c_slice", F.pmod(F.xxhash64("id"), per_cell.cast("bigint")))
    queries = queries.withColumn("q_slice", F.pmod(F.xxhash64("id"), F.lit(q_slices).cast("bigint")))

    def visit(routed: DataFrame, limit) -> DataFrame:
        left = routed.withColumn("n_slices", per_cell).withColumn(
            "c_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_slices").cast("bigint") - 1))
        )
        # Corpus slices are repeated for the query slices that visit them, and only for those.
        met = left.select(
            F.col("q_slice").alias("r_query"), F.col("cell").alias("r_cell"), F.col("c_slice").alias("r_slice")
        ).distinct()
        here = (F.col("cell") == F.col("r_cell")) & (F.col("c_slice") == F.col("r_slice"))
        right = placed.join(met, here).drop("cell", "c_slice")
        gone = ("cells", "angle", "n_slices", *(() if own else ("floor",)))
        return _grid_join(left.drop(*gone), right.drop(*gone), limit, threshold, drop_self, out, tasks)

    if k is None:
        asked = queries if own else queries.withColumn("floor", F.lit(float(threshold)))
        return visit(_routes(asked, pivots, cells, "floor"), None)

    # First look: the query's own cell gives a score its k-th best cannot fall below.
    home = visit(_place(queries, pivots).drop("angle"), k)
    kth = (
        _merge(home, corpus, k)
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s"))
        .where(F.col("n") >= k)
        .select(F.col("query_id").alias("id"), F.col("s").alias("floor"))
    )
    lowest = -1.0 if threshold is None else float(threshold)
    floors = queries.join(kth, "id", "left").withColumn(
        "floor", F.greatest(F.coalesce("floor", F.lit(lowest)), F.lit(lowest))
    )
    return visit(_routes(floors, pivots, cells, "floor"), k)


def _merge(found: DataFrame, corpus: DataFrame, k: int) -> DataFrame:
    """Partial results of all tasks to the k best per query."""
    order = [F.col("score").desc(), F.col("id").asc()]
    if "one_per" not in corpus.columns:
        # Overlapping scopes may find a row twice.
        if "within" in corpus.columns:
            found = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        return topk_per_key(found, ["query_id"], order, k)
    groups = corpus.select("id", "one_per").distinct()
    return diversify(found.join(groups, "id"), ["query_id"], "one_per", order, k).drop("one_per")


def _search(queries, corpus, k, threshold, drop_self, plan, slice_rows) -> DataFrame:
    texts = [c for c in ("id", "within") if c in queries.columns]
    # as Arrow table and as arrays: vectors twice, texts with a reference each
    held = F.size("vector") * 16 + sum(
        (F.octet_length(F.col(c).cast("string")) * 5 + 64 for c in texts), F.lit(8)
    )
    size = queries.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(held), F.lit(0)).alias("bytes"), F.max(F.size("vector")).alias("dim")
    ).first()
    if plan == "auto":
        plan = "scan" if size["bytes"] <= BROADCAST_BYTES else "grid"
    if plan == "scan" and size["n"] < SPREAD_QUERIES:
        return _scan(queries, corpus, k, threshold, drop_self)
    n_corpus = corpus.count()
    if plan == "scan":
        # Many queries cost far more than a small corpus does to move.
        if n_corpus <= SPREAD_ROWS:
            corpus = corpus.repartition(corpus.sparkSession.sparkContext.defaultParallelism)
        return _scan(queries, corpus, k, threshold, drop_self)
    if not n_corpus or not size["n"]:
        return _scan(queries.limit(0), corpus, k, threshold, drop_self)
    cell_rows = SLICE_ROWS
    if slice_rows is None:
        cores = corpus.sparkSession.sparkContext.defaultParallelism
        slice_rows = _slice_rows(max(size["n"], n_corpus), size["dim"], cores)
        # Cells grow with the slices: a query travels once for each cell it visits.
        cell_rows = SLICE_ROWS * slice_rows // _slice_rows(0, size["dim"], cores)
    return _grid(queries, corpus, k, threshold, drop_self, size["n"], n_corpus, slice_rows, cell_rows)


def vector_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    threshold: float | None = None,
    drop_self: bool = False,
    within: str | None = None,
    one_per: str | None = None,
    plan: str = "auto",
    slice_rows: int | None = None,
) -> DataFrame:
    """The k corpus vectors closest to each query: query_id, id, score, rank.

    Both tables hold ``id`` and ``vector``. A threshold of zero or less means none.
    ``drop_self`` leaves out the corpus row with the query's own id before counting, so
    k rows come back wherever the corpus has them. ``within`` names a column of both tables
    that must be equal, ``one_per`` a corpus column of which each value may win once.
    """
    limit = threshold if threshold is not None and threshold > 0 else None
    scope = [F.col(within).cast("string").alias("within")] if within else []
    group = [F.col(one_per).cast("string").alias("one_per")] if one_per else []
    queries = queries.select("id", "vector", *scope)
    corpus = corpus.select("id", "vector", *scope, *group)
    return _merge(_search(queries, corpus, k, limit, drop_self, plan, slice_rows), corpus, k)


def vector_pairs(
    left: DataFrame, right: DataFrame, threshold: float, plan: str = "auto", slice_rows: int | None = None
) -> DataFrame:
    """All (query_id, id, score) with a cosine of at least ``threshold``."""
    if threshold <= 0:
        raise ValueError("a pair search needs a positive threshold")
    left, right = left.select("id", "vector"), right.select("id", "vector")
    return _search(left, right, None, threshold, False, plan, slice_rows)


def vector_reach(
    queries: DataFrame,
    corpus: DataFrame,
    floor: str,
    within: str | None = None,
    plan: str = "auto",
    slice_rows: int | None = None,
) -> DataFrame:
    """All (query_id, id) with a cosine of at least the query's own positive ``floor``, once each.

    In the grid a query visits only the cells whose angle bound reaches its floor.
    """
    scope = [F.col(within).cast("string").alias("within")] if within else []
    asked = queries.select("id", "vector", *scope, F.col(floor).cast("double").alias("floor"))
    found = _search(asked, corpus.select("id", "vector", *scope), None, None, False, plan, slice_rows)
    return found.select("query_id", "id").distinct()


def overfetch_topk(queries: DataFrame, corpus: DataFrame, known: DataFrame, k: int, extra: int) -> DataFrame:
    """Ask for k + extra, then drop the query itself and unknown ids; may return fewer than k."""
    hits = vector_topk(queries, corpus, k + extra).drop("rank")
    kept = resolve_candidates(hits, known)
    return topk_per_key(kept, ["query_id"], [F.col("score").desc(), F.col("id").asc()], k)


def resolve_candidates(hits: DataFrame, known: DataFrame, id_col: str = "id") -> DataFrame:
    """Search hits that name a known record, without the query itself and without repeats."""
    ids = known.select(F.col(id_col).alias("id"))
    return (
        hits.where(F.col("id") != F.col("query_id"))
        .join(ids, "id", "left_semi")
        .groupBy("query_id", "id")
        .agg(F.max("score").alias("score"))
    )


def check_dimension(df: DataFrame, dim: int) -> tuple[DataFrame, DataFrame]:
    """Rows with a vector of ``dim`` numbers, and the rest."""
    ok = F.coalesce(F.size("vector") == dim, F.lit(False))
    return df.where(ok), df.where(~ok)
