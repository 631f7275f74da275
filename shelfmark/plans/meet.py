"""Similar datasets where columns match by equal names: the k best of a target in one task.

Slices of a scope's targets meet blocks of its records, each two in a task of their own. A
task numbers the tokens, lists the records of each, and adds up what a target shares with
every record of the block, so all pairs are scored exactly and no pair ever leaves the task
but the k best of each target. What is moved is the records, once for each slice of targets,
whose number stays the same as a table grows; memory is bounded by the block.

Records that are equal in all that is compared are looked at once, as a class: of its rows
only the two first ids can be among anybody's best (one is the target's own, at most).
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.scores import Weights
from shelfmark.operators.groups import skew_join
from shelfmark.operators.setjoin import EPS
from shelfmark.operators.vectors import TIE_DIGITS, _arrow_schema, _flat, _ids
from shelfmark.plans.dense import _with_zeros
from shelfmark.session import durable

# Records of a scope in one block, at most, and fewer where they carry vectors.
BLOCK, VECTOR_BLOCK = 524_288, 131_072
# Targets of one slice, at least; scopes of fewer records share a task.
SLICE = 2_048
# Slices of all scopes for each core, about, and tasks in all.
SLICES_PER_CORE = 3
MOST_TASKS = 2_000
# Records on a target's rarest tokens that give it its first floor, about.
SEEDS = 128
# Tokens, and records of each, that a target without columns is compared with.
PROBE_TOKENS, PROBE_ROWS = 8, 16
# What it costs to look a record up, as records of a token that are counted.
DEARER = 4
# Targets whose cosines with a block are held at once.
STRIP = 16
# Scores that are added up in another order, and cosines of a matrix product, are off by less.
SLACK = 1e-8


class _Side:
    """Rows of targets or records as arrays; texts are numbered together with the other side's."""

    def __init__(self, data: pa.Table, vectors: bool):
        self.id_column, self.series_column = _flat(data.column("id")), _flat(data.column("series"))
        self.covered = _flat(data.column("covered")).to_numpy(zero_copy_only=False).astype(bool)
        self.lists = [_flat(data.column(c)) for c in ("columns", "title_words")]
        # A list that is not there has no size.
        self.missing = [np.asarray(x.is_null()) for x in self.lists]
        self.size = [pc.fill_null(pc.list_value_length(x), 0).to_numpy().astype(np.int64) for x in self.lists]
        self.ends = [np.concatenate(([0], np.cumsum(s))) for s in self.size]
        self.unit = _with_zeros(_flat(data.column("vector"))) if vectors else None


def _numbered(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the values of both arrays; NULL is a value like any other."""
    codes = pa.concat_arrays([a, b]).dictionary_encode(null_encoding="encode").indices.to_numpy()
    return codes[: len(a)], codes[len(a) :]


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[ends[1:]] - total[ends[:-1]]


def _classes(side: _Side, marks: list) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each row that stand for all that is compared, whatever the order of a list."""
    out = []
    for series, columns, words, kinds, rest in marks:
        h = series[side.series] + kinds[side.frequency + 1] + rest[side.covered.astype(int) + 2 * side.missing[0]]
        out.append(h + _sums(columns[side.tokens[0]], side.ends[0]) + _sums(words[side.tokens[1]], side.ends[1]))
    return out[0], out[1]


def _grouped(keys: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    order = np.lexsort(keys)
    new = np.zeros(len(order), dtype=np.int64)
    new[1:] = np.any([np.diff(k[order]) != 0 for k in keys], axis=0)
    codes = np.empty(len(order), dtype=np.int64)
    codes[order] = np.cumsum(new)
    return codes


def _nth_series(score: np.ndarray, series: np.ndarray, n: int) -> float:
    """The n-th best score of rows, each series counted once; below all scores if there are fewer."""
    order = np.argsort(-score, kind="stable")
    first = np.sort(np.unique(series[order], return_index=True)[1])
    return score[order[first[n - 1]]] if len(first) >= n else -2.0


class _Lists:
    """Which classes hold a token, and which tokens a class holds."""

    def __init__(self, tokens: np.ndarray, ends: np.ndarray, rows: np.ndarray):
        at, self.ends = _spans(ends, rows)
        self.values, codes = np.unique(tokens[at], return_inverse=True)
        self.tokens = codes.astype(np.int32)
        order = np.argsort(self.tokens, kind="stable")
        self.held = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(self.ends))[order]
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(self.tokens, minlength=len(self.values)))))
        self.asked = np.zeros(len(self.values), dtype=bool)

    def of(self, tokens: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Those of the tokens that are here, and the classes that hold each, rare ones first."""
        if not len(tokens) or not len(self.values):
            return np.zeros(0, dtype=np.int64), []
        at = np.searchsorted(self.values, tokens)
        at = at[self.values[np.minimum(at, len(self.values) - 1)] == tokens]
        at = at[np.argsort(self.starts[at + 1] - self.starts[at], kind="stable")]
        return at, [self.held[self.starts[i] : self.starts[i + 1]] for i in at]

    def shared(self, asked: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """How many of the tokens each of these classes holds."""
        at, ends = _spans(self.ends, classes)
        self.asked[asked] = True
        hits = np.concatenate(([0], np.cumsum(self.asked[self.tokens[at]])))
        self.asked[asked] = False
        return hits[ends[1:]] - hits[ends[:-1]]


def _spans(ends: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the entries of these rows lie, and where each row ends among them."""
    size = ends[rows + 1] - ends[rows]
    out = np.concatenate(([0], np.cumsum(size)))
    return np.repeat(ends[rows] - out[:-1], size) + np.arange(out[-1]), out


def _shares(excess: float, w: Weights) -> list[tuple[float, float]]:
    """Ways to say: a pair with this much from columns and title has (columns >= a or title >= b)."""
    if not w.columns or not w.title:
        return [(excess / w.columns if w.columns else 2.0, excess / w.title if w.title else 2.0)]
    out = [(excess * f / w.columns, excess * (1 - f) / w.title) for f in (0.3, 0.5, 0.6, 0.7, 0.8, 0.9)]
    # Even equal columns are not enough without the title, and the other way round.
    out.append((2.0 if excess > w.columns else 0.0, (excess - w.columns) / w.title))
    out.append(((excess - w.title) / w.columns, 2.0 if excess > w.title else 0.0))
    return out


class _Scope:
    """The records of one scope in a block, by class in the order of their first ids."""

    def __init__(self, y: _Side, rows: np.ndarray, codes: np.ndarray, w: Weights, k: int):
        order = rows[np.lexsort((y.ids[rows], codes[rows]))]
        code, ids = codes[order], y.ids[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(code) != 0) | (np.diff(ids) != 0)
        order, code, ids = order[new], code[new], ids[new]
        # An id is in one class, or in several if its rows differ.
        self.copies = int(np.unique(ids, return_counts=True)[1].max())
        first = np.flatnonzero(np.concatenate(([True], np.diff(code) != 0)))
        second = np.minimum(first + 1, len(order) - 1)
        has = np.concatenate((np.diff(first), [len(order) - first[-1]])) > 1
        by_id = np.argsort(ids[first], kind="stable")
        first, second, has = first[by_id], second[by_id], has[by_id]
        self.row = order[first]
        self.two = [(order[first], ids[first]), (np.where(has, order[second], -1), np.where(has, ids[second], -1))]
        self.w, self.k, self.need = w, k, k + self.copies
        self.series = np.unique(y.series[self.row], return_inverse=True)[1]
        self.frequency, self.covered = y.frequency[self.row], y.covered[self.row]
        self.missing = y.missing[0][self.row]
        self.size = [s[self.row] for s in y.size]
        self.lists = [_Lists(y.tokens[i], y.ends[i], self.row) for i in (0, 1)]
        self.unit = None if y.unit is None else y.unit[self.row]
        n = len(self.row)
        self.count, self.mark = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=bool)
        self.kinds: dict = {}

    def kind(self, frequency: int, covered: bool) -> tuple[np.ndarray, np.ndarray]:
        """Temporal score of all classes, and the first of the best series by that alone."""
        if (frequency, covered) not in self.kinds:
            time = ((self.frequency == frequency) & (frequency >= 0)) * 0.5 + (self.covered & covered) * 0.5
            order = np.argsort(-time, kind="stable")
            first = np.sort(np.unique(self.series[order], return_index=True)[1])[: self.need]
            self.kinds[frequency, covered] = time, order[first]
        return self.kinds[frequency, covered]

    def ratio(self, side: int, n: int, shared: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Overlap of columns or of title words with these classes, by the number they share."""
        m = self.size[side][at]
        either = np.maximum(n, m) if side == 0 else n + m - shared
        return np.divide(shared, either, out=np.zeros(len(at)), where=either > 0)

    def reach(self, excess: float, sizes: list[int], lists: list[list[np.ndarray]]) -> np.ndarray | None:
        """Classes that can bring that much from columns and title, by the rarest tokens it takes.

        None where reading them costs more than adding up all that is shared.
        """
        if excess <= 0:
            return None
        reads = [np.concatenate(([0], np.cumsum([len(c) for c in held], dtype=np.int64))) for held in lists]
        options = []
        for shares in _shares(excess, self.w):
            # A pair shares at least share * n of the n tokens, so one of the first n - that + 1.
            first = [
                max(0, len(held) - max(1, math.ceil(share * n - EPS)) + 1)
                for share, n, held in zip(shares, sizes, lists, strict=True)
            ]
            options.append((sum(r[f] for r, f in zip(reads, first, strict=True)), first))
        cost, first = min(options)
        if cost * DEARER > sum(r[-1] for r in reads) + len(self.row) / 4:
            return None
        return self.marked(c for held, f in zip(lists, first, strict=True) for c in held[:f])

    def marked(self, parts: Iterable[np.ndarray]) -> np.ndarray:
        """The classes of all parts, each once, in order."""
        for classes in parts:
            self.mark[classes] = True
        at = np.flatnonzero(self.mark)
        self.mark[at] = False
        return at

    def at_hand(self, frequency: int, covered: bool, words: list[np.ndarray]) -> np.ndarray:
        """What a target without a list of columns is compared with, as its overlap with most is not known.

        The two first rows of the first series, of all records and of those with its frequency and
        its coverage, and the first records on its rarest words.
        """
        same, both = self.frequency == frequency, self.covered & covered
        tags = [np.ones(len(same), dtype=bool), both, same & (frequency >= 0), same & both & (frequency >= 0)]
        out = [held[:PROBE_ROWS] for held in words[:PROBE_TOKENS]]
        for tag in tags:
            classes = np.flatnonzero(tag)
            series = self.series[classes]
            order = np.argsort(series, kind="stable")
            new = np.concatenate(([True], np.diff(series[order]) != 0))[: len(order)]
            first = np.sort(order[new])[: 2 * self.k + 1]
            out.append(classes[first])
            # The next class of a series, where its first id comes before the second one of the class ahead.
            next_ = np.flatnonzero(~new & np.concatenate(([False], new[:-1]))[: len(order)])
            ahead, after = order[next_ - 1], order[next_]
            ids = self.two[1][1][classes[ahead]]
            open_ = np.isin(ahead, first) & ((ids < 0) | (self.two[0][1][classes[after]] < ids))
            out.append(classes[after[open_]])
        return self.marked(out)

    def search(self, x: _Side, row: int, near: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """Rows that hold the k best of a target: row, id, series and scores, in order.

        As many more series are kept as the target itself can be in, and rows of a series.
        """
        w = self.w
        time, seeds = self.kind(x.frequency[row], x.covered[row])
        sizes = [x.size[i][row] for i in (0, 1)]
        tokens, lists = [], []
        for i, weight in ((0, w.columns), (1, w.title)):
            mine = x.tokens[i][x.ends[i][row] : x.ends[i][row + 1]] if weight else []
            asked, held = self.lists[i].of(mine)
            tokens.append(asked)
            lists.append(held)
        # The overlap with a list that is not there is not known, such rows come last.
        unknown = self.size[0] > 0 if x.missing[0][row] else self.missing & (sizes[0] > 0)

        def overlaps(at: np.ndarray) -> list[np.ndarray]:
            return [self.ratio(i, sizes[i], self.lists[i].shared(tokens[i], at), at) for i in (0, 1)]

        def rated(at: np.ndarray, columns: np.ndarray, title: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
            parts = [columns, title, time[at]]
            total = parts[0] * w.columns + parts[1] * w.title + parts[2] * w.temporal
            if near is not None:
                cosine = np.einsum("j,ij->i", x.unit[row], self.unit[at]) if near.any() else np.zeros(len(at))
                parts.append(np.maximum(np.round(cosine, TIE_DIGITS), 0.0))
                total = total + parts[3] * w.embedding
            return parts, np.where(unknown[at], -1.0, total)

        seeds = [seeds]
        for held in lists:
            met = 0
            for classes in held:
                if met < SEEDS:
                    seeds.append(classes[:SEEDS])
                met += len(classes)
        if near is not None:
            seeds.append(np.argpartition(-near, min(SEEDS, len(near)) - 1)[:SEEDS])
        seeds = self.marked(seeds)
        first = rated(seeds, *overlaps(seeds))[1]
        floor = _nth_series(first, self.series[seeds], self.need)
        best = None
        if x.missing[0][row]:
            best = self.at_hand(x.frequency[row], x.covered[row], [c for c in lists[1] if len(c) > 1])
        elif near is None:
            # What a pair must bring from columns and title to reach the floor with the full time part.
            bonus = ((x.frequency[row] >= 0) * 0.5 + x.covered[row] * 0.5) * w.temporal
            best = self.reach(floor - EPS - bonus, sizes, lists)
        if best is not None and not x.missing[0][row]:
            columns, title = (self.ratio(i, sizes[i], np.minimum(sizes[i], self.size[i][best]), best) for i in (0, 1))
            title = title * w.title + time[best] * w.temporal
            open_ = columns * w.columns + title >= floor - EPS
            best, title = best[open_], title[open_]
            columns = self.ratio(0, sizes[0], self.lists[0].shared(tokens[0], best), best)
            best = self.marked((best[columns * w.columns + title >= floor - EPS], seeds[first >= floor]))
        if best is None:
            score = time * w.temporal
            for i, weight in ((0, w.columns), (1, w.title)):
                for classes in lists[i]:
                    self.count[classes] += 1
                at = np.flatnonzero(self.count)
                score[at] += self.ratio(i, sizes[i], self.count[at], at) * weight
                self.count[at] = 0
            if near is not None:
                score += near * w.embedding
            score[unknown] = -1.0
            best = np.flatnonzero(score >= floor - SLACK)
            if len(best) > SEEDS:
                floor = _nth_series(score[best], self.series[best], self.need)
                best = best[score[best] >= floor - SLACK]
        overlap = overlaps(best)
        parts, total = rated(best, *overlap)
        floor = _nth_series(total, self.series[best], self.need)
        keep = np.flatnonzero(total > floor)
        # Classes lie in the order of their first ids: of equal scores the first series do.
        ties, n = np.flatnonzero(total == floor), SEEDS
        while n < len(ties) and len(np.unique(self.series[best[ties[:n]]])) < self.need:
            n *= 4
        keep = np.concatenate((keep, ties[:n]))
        best, parts, total = best[keep], [p[keep] for p in parts], total[keep]
        hidden = unknown[best]
        if hidden.any():
            parts[0], total = np.where(hidden, np.nan, parts[0]), np.where(hidden, np.nan, total)
        rows, ids = (np.concatenate([two[j][best] for two in self.two]) for j in (0, 1))
        series, total = np.tile(self.series[best], 2), np.tile(total, 2)
        parts = [np.tile(p, 2) for p in parts]
        order = np.lexsort((ids, -total))
        order = order[rows[order] >= 0]
        codes = series[order]
        groups = np.argsort(codes, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], np.diff(codes[groups]) != 0)))
        sizes = np.diff(np.append(starts, len(groups)))
        place, first = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
        place[groups] = np.arange(len(groups)) - np.repeat(starts, sizes)
        first[groups] = np.repeat(groups[starts], sizes)
        last = np.sort(groups[starts])[min(self.need, len(starts)) - 1]
        order = order[(place <= self.copies) & (first <= last)]
        return rows[order], ids[order], series[order], [*(p[order] for p in parts), total[order]]


def _own_best(ids: np.ndarray, series: np.ndarray, targets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(target, row) of the k first rows of other ids, one per series."""
    valid = ids[None, :] != targets[:, None]
    before = np.triu(series[:, None] == series[None, :], 1).astype(np.float32)
    first = valid & (valid.astype(np.float32) @ before == 0)
    return np.nonzero(first & (np.cumsum(first, axis=1) <= k))


def _met(mine: pa.Table, theirs: pa.Table, w: Weights, k: int, schema: pa.Schema) -> pa.Table:
    x, y = (_Side(t, bool(w.embedding)) for t in (mine, theirs))
    if w.embedding and x.unit.shape[1] != y.unit.shape[1] and x.unit.shape[1] and y.unit.shape[1]:
        raise ValueError("vectors differ in length")
    own, other = _ids(x.id_column), _ids(y.id_column)
    codes = np.unique(np.concatenate([own, other]), return_inverse=True)[1]
    x.ids, y.ids = codes[: len(own)], codes[len(own) :]
    x.series, y.series = _numbered(x.series_column, y.series_column)
    x.frequency, y.frequency = _numbered(*(_flat(t.column("frequency")) for t in (mine, theirs)))
    for side, table in ((x, mine), (y, theirs)):
        side.frequency = np.where(np.asarray(_flat(table.column("frequency")).is_null()), -1, side.frequency)
    lists = [_numbered(x.lists[i].flatten(), y.lists[i].flatten()) for i in (0, 1)]
    x.tokens, y.tokens = [a for a, _ in lists], [b for _, b in lists]
    scopes = _numbered(*(_flat(t.column("scope_key")) for t in (mine, theirs)))
    if w.embedding:
        x_codes, y_codes = np.arange(len(own)), np.arange(len(other))
    else:
        rng = np.random.default_rng(0)
        most = [max(a.max(initial=0), b.max(initial=0)) + 2 for a, b in
                ((x.series, y.series), *lists, (x.frequency, y.frequency))]
        marks = [[rng.integers(0, 2**64, n, dtype=np.uint64) for n in (*most, 4)] for _ in range(2)]
        x_codes, y_codes = _grouped(_classes(x, marks)), _grouped(_classes(y, marks))
    x_order, y_order = (np.argsort(s, kind="stable") for s in scopes)
    found = []
    for code in np.intersect1d(*scopes):
        targets, records = (
            o[slice(*np.searchsorted(s[o], [code, code + 1]))] for o, s in ((x_order, scopes[0]), (y_order, scopes[1]))
        )
        scope = _Scope(y, records, y_codes, w, k)
        targets = targets[np.argsort(x_codes[targets], kind="stable")]
        groups = np.split(targets, np.flatnonzero(np.diff(x_codes[targets])) + 1)
        for start in range(0, len(groups), STRIP):
            strip, near = groups[start : start + STRIP], None
            if w.embedding:
                near = np.zeros((len(strip), len(scope.row)))
                if x.unit.shape[1] and y.unit.shape[1]:
                    near = np.maximum(x.unit[[g[0] for g in strip]] @ scope.unit.T, 0.0)
            for i, group in enumerate(strip):
                rows, ids, series, values = scope.search(x, group[0], None if near is None else near[i])
                t, r = _own_best(ids, series, x.ids[group], k)
                found.append((group[t], rows[r], *[v[r] for v in values]))
    if not found:
        return schema.empty_table()
    t, r, *values = (np.concatenate(v) for v in zip(*found, strict=True))
    columns = [x.id_column.take(pa.array(t)), y.id_column.take(pa.array(r)), y.series_column.take(pa.array(r))]
    columns += [pa.array(v, pa.float64(), from_pandas=True) for v in values]
    return pa.Table.from_arrays([a.cast(f.type) for a, f in zip(columns, schema, strict=True)], schema=schema)


def best_of_scope(scoped: DataFrame, targets: DataFrame, w: Weights, k: int) -> DataFrame:
    """Candidates that hold the k best of each target, one per series, with their scores.

    Both tables hold the fields of ``similar.frame`` and ``scope_key``. A target has at most k
    rows from each block of its scope.
    """
    fields = ["scope_key", "id", "series", "frequency", "covered", "title_words", "columns"]
    fields += ["vector"] if w.embedding else []
    cores = scoped.sparkSession.sparkContext.defaultParallelism
    n = F.col("n")
    load = durable(scoped.groupBy("scope_key").agg(F.count(F.lit(1)).alias("n")))
    rows = max(SLICE, (load.agg(F.sum("n")).first()[0] or 0) // (SLICES_PER_CORE * cores))
    slices = F.ceil(n / F.lit(rows)).cast("bigint")
    blocks = F.ceil(n / F.lit(VECTOR_BLOCK if w.embedding else BLOCK)).cast("bigint")
    small = n <= rows
    sums = load.agg(F.sum(F.when(small, n)), F.sum(F.when(~small, slices * blocks))).first()
    shared = -(-(sums[0] or 0) // rows)
    bucket = F.pmod(F.xxhash64("scope_key"), F.lit(max(shared, 1)))
    place = F.when(small, F.concat(F.lit("#"), bucket)).otherwise(F.concat(F.lit("="), "scope_key"))
    load = durable(load.select("scope_key", place.alias("place"), slices.alias("slices"), blocks.alias("blocks")))
    tasks = min(MOST_TASKS, 4 * max(1, shared + (sums[1] or 0)))
    zero = F.lit(0).cast("bigint")

    def dealt(df: DataFrame, side: str, *deal) -> DataFrame:
        placed = skew_join(df.select(*fields).dropna(subset=["id"]), load, ["scope_key"])
        for name, at in zip(("slice", "block"), deal, strict=True):
            placed = placed.withColumn(name, at)
        # Both sides may come from one table, so each has columns of its own.
        keys = [F.col(c).alias(f"{side}_{c}") for c in ("place", "slice", "block")]
        return placed.select(*[F.col(c).alias(c) for c in fields], *keys).repartition(
            tasks, f"{side}_place", f"{side}_slice", f"{side}_block"
        )

    # Targets that are compared alike meet in one slice.
    alike = F.xxhash64(*[c for c in fields if c not in ("scope_key", "id")])
    left = dealt(targets, "x", F.pmod(alike, "slices"), F.explode(F.sequence(zero, F.col("blocks") - 1)))
    right = dealt(scoped, "y", F.explode(F.sequence(zero, F.col("slices") - 1)), F.pmod(F.xxhash64("id"), "blocks"))
    shown = ["column_overlap", "title_similarity", "temporal_compatibility"]
    shown += ["embedding_similarity"] if w.embedding else []
    kind = scoped.schema["id"].dataType.simpleString()
    text = f"target_id {kind}, id {kind}, series string, " + ", ".join(f"{c} double" for c in [*shown, "score"])
    schema = _arrow_schema(scoped.sparkSession.createDataFrame([], text).schema)

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not mine.num_rows or not theirs.num_rows:
            return schema.empty_table()
        return _met(mine, theirs, w, k, schema)

    keys = [[f"{s}_{c}" for c in ("place", "slice", "block")] for s in "xy"]
    return left.groupBy(*keys[0]).cogroup(right.groupBy(*keys[1])).applyInArrow(meet, text)
