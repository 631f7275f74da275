"""Similar datasets where columns match by vector and most columns match somebody's.

A table of all matches is then nearly as large as all pairs of columns. Here records carry
the vectors of their columns, a scope is dealt into blocks of bounded size, and every two
blocks meet in a task of their own: one matrix product gives the best match of each column
in each candidate, and a task sends on at most k candidates per target. All pairs of a
scope are compared, so the work is quadratic in the columns; what is moved is the records,
once for each block of the scope.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.scores import Weights
from shelfmark.operators.groups import skew_join
from shelfmark.operators.vectors import TIE_DIGITS, _arrow_schema, _cut, _flat, _ids, _kth, matrix
from shelfmark.session import durable

# Records and column vectors in one block of a scope: at most, and at least where there are
# several blocks only to keep all cores busy.
BLOCK, SMALL_BLOCK = 32_768, 1_024
# Numbers of a score matrix that a task holds at once, and title words of one product.
STRIP, WORDS = 8_000_000, 1_024
MAX_PARTS = 1_000


def with_column_vectors(recs: DataFrame, names: DataFrame) -> DataFrame:
    """Add ``vectors``: one for each column of a record that has one in ``names`` (name, vector)."""
    entries = durable(recs.select("id", F.explode("columns").alias("name")))
    lists = skew_join(entries, names, ["name"]).groupBy("id").agg(F.collect_list("vector").alias("vectors"))
    nothing = F.array().cast(lists.schema["vectors"].dataType)
    return durable(recs.join(lists, "id", "left").withColumn("vectors", F.coalesce("vectors", nothing)))


class _Block:
    def __init__(self, data: pa.Table):
        self.id_column = _flat(data.column("id"))
        self.ids = _ids(self.id_column)
        self.series_column = _flat(data.column("series"))
        self.series = _ids(self.series_column)
        lists = _flat(data.column("vectors"))
        self.count = np.asarray(lists.value_lengths())
        self.ends = np.concatenate(([0], np.cumsum(self.count)))
        self.unit = matrix(lists.flatten())
        self.size = data.column("size").to_numpy()
        self.covered = data.column("covered").to_numpy()
        self.frequency = _flat(data.column("frequency"))
        self.words = _flat(data.column("title_words"))
        self.n_words = np.asarray(self.words.value_lengths())
        self.whole = _with_zeros(_flat(data.column("unit"))) if "unit" in data.schema.names else None


def _with_zeros(column: pa.Array) -> np.ndarray:
    """A row per vector, of zeros for NULL."""
    have = np.flatnonzero(column.is_valid())
    unit = matrix(column.take(pa.array(have)))
    out = np.zeros((len(column), unit.shape[1]))
    out[have] = unit
    return out


def _best_matches(x: _Block, y: _Block, rows: slice, threshold: float) -> np.ndarray:
    """Per target of the strip and candidate: the sum of the best match of each column."""
    out = np.zeros((rows.stop - rows.start, len(y.ids)))
    first, last = x.ends[rows.start], x.ends[rows.stop]
    has_x, has_y = np.flatnonzero(x.count[rows]), np.flatnonzero(y.count)
    if not len(has_x) or not len(has_y):
        return out
    if x.unit.shape[1] != y.unit.shape[1]:
        raise ValueError("vectors differ in length")
    best = np.maximum.reduceat(x.unit[first:last] @ y.unit.T, y.ends[:-1][has_y], axis=1)
    best = np.round(best, TIE_DIGITS)
    best[best < threshold] = 0.0
    sums = np.add.reduceat(best, x.ends[rows][has_x] - first, axis=0)
    out[np.ix_(has_x, has_y)] = sums
    return out


def _one_hot(words: pa.Array, codes: np.ndarray, first: int) -> np.ndarray:
    out = np.zeros((len(words), WORDS), dtype=np.float32)
    row = np.repeat(np.arange(len(words)), np.asarray(words.value_lengths()))
    here = (codes >= first) & (codes < first + WORDS)
    out[row[here], codes[here] - first] = 1.0
    return out


def _shared_words(x: _Block, y: _Block) -> np.ndarray:
    """Title words that a target and a candidate share, for all pairs of the blocks."""
    left, right = x.words.flatten(), y.words.flatten()
    known = pc.unique(left)
    known = known.filter(pc.is_in(known, value_set=right))
    a, b = (pc.fill_null(pc.index_in(w, known), -1).to_numpy() for w in (left, right))
    out = np.zeros((len(x.ids), len(y.ids)), dtype=np.float32)
    for first in range(0, len(known), WORDS):
        out += _one_hot(x.words, a, first) @ _one_hot(y.words, b, first).T
    return out


def _strips(x: _Block, width: int):
    """Targets in runs whose columns and rows fit one strip of that width; a single one always fits."""
    step, start = max(1, STRIP // max(width, 1)), 0
    while start < len(x.ids):
        stop = int(np.searchsorted(x.ends, x.ends[start] + step, side="right")) - 1
        stop = max(start + 1, min(stop, start + step))
        yield slice(start, min(stop, len(x.ids)))
        start = stop


def best_in_blocks(scoped: DataFrame, targets: DataFrame, w: Weights, threshold: float, k: int) -> DataFrame:
    """Candidates that hold the k best of each target, one per series, with their scores.

    Both tables hold the fields of ``similar.frame``, ``vectors`` and ``scope_key``. A target has
    at most k rows from each block of its scope.
    """
    fields = ["scope_key", "id", "series", "frequency", "covered", "title_words", "vectors"]
    fields += ["unit"] if w.embedding else []
    # Columns without a vector count in the size of a record.
    sized = [*fields, F.size("columns").alias("size")]
    load = scoped.groupBy("scope_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("vectors") + 1).alias("load")
    )
    cores = scoped.sparkSession.sparkContext.defaultParallelism
    busy = F.least(F.lit(math.ceil(math.sqrt(4 * cores))), F.ceil(F.col("load") / SMALL_BLOCK))
    blocks = F.least(F.greatest(F.ceil(F.col("load") / BLOCK), busy), F.col("n")).cast("bigint")
    load = durable(load.select("scope_key", blocks.alias("blocks")))
    meetings = load.agg(F.coalesce(F.sum(F.col("blocks") * F.col("blocks")), F.lit(1))).first()[0]
    parts = min(max(meetings, 1), MAX_PARTS)

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        placed = skew_join(df.select(*sized), load, ["scope_key"])
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
        placed = placed.withColumn(own, F.pmod(F.xxhash64("id"), "blocks")).withColumn(other, every)
        # Both sides may come from one table, so each has columns of its own.
        renamed = placed.select(*[F.col(c).alias(c) for c in placed.columns if c != "blocks"])
        return renamed.repartition(parts, "scope_key", "x_block", "y_block")

    keys = ["scope_key", "x_block", "y_block"]
    left, right = dealt(targets, "x_block", "y_block"), dealt(scoped, "y_block", "x_block")
    shown = ["column_overlap", "title_similarity", "temporal_compatibility"]
    shown += ["embedding_similarity"] if w.embedding else []
    kind = scoped.schema["id"].dataType.simpleString()
    text = f"target_id {kind}, id {kind}, series string, " + ", ".join(f"{c} double" for c in [*shown, "score"])
    schema = _arrow_schema(scoped.sparkSession.createDataFrame([], text).schema)

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not mine.num_rows or not theirs.num_rows:
            return schema.empty_table()
        x, y = _Block(mine), _Block(theirs)
        groups = np.unique(y.series, return_inverse=True)[1]
        kinds = pc.unique(y.frequency)
        fx, fy = (pc.fill_null(pc.index_in(s.frequency, kinds, skip_nulls=True), -1).to_numpy() for s in (x, y))
        words = _shared_words(x, y)
        found = []
        for rows in _strips(x, max(len(y.unit), len(y.ids))):
            overlap = _best_matches(x, y, rows, threshold)
            overlap /= np.maximum(np.maximum(x.size[rows, None], y.size[None, :]), 1)
            shared = words[rows].astype(np.float64)
            either = x.n_words[rows, None] + y.n_words[None, :] - shared
            title = np.divide(shared, either, out=np.zeros_like(shared), where=either > 0)
            same = (fx[rows, None] == fy[None, :]) & (fx[rows, None] >= 0)
            temporal = same * 0.5 + (x.covered[rows, None] & y.covered[None, :]) * 0.5
            parts_ = [overlap, title, temporal]
            score = overlap * w.columns + title * w.title + temporal * w.temporal
            if w.embedding:
                near = np.zeros_like(score)
                if x.whole.shape[1] and y.whole.shape[1]:
                    near = np.maximum(np.round(x.whole[rows] @ y.whole.T, TIE_DIGITS), 0.0)
                parts_.append(near)
                score = score + near * w.embedding
            own = x.ids[rows, None] == y.ids[None, :]
            floor = _kth(score.copy(), own, groups, k)
            r, c = np.nonzero((score >= floor[:, None]) & ~own)
            keep = _cut(r, score[r, c], y.ids[c], groups[c], k)
            r, c = r[keep], c[keep]
            found.append((r + rows.start, c, *[p[r, c] for p in [*parts_, score]]))
        r, c, *values = (np.concatenate(v) for v in zip(*found, strict=True))
        columns = [x.id_column.take(pa.array(r)), y.id_column.take(pa.array(c)), y.series_column.take(pa.array(c))]
        columns += [pa.array(v, pa.float64()) for v in values]
        return pa.Table.from_arrays([a.cast(f.type) for a, f in zip(columns, schema, strict=True)], schema=schema)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, text)
