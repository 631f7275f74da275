"""Quality classifier: co-training of a text view and a metadata view."""

from __future__ import annotations

import logging
import math
import pickle
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import lists_of, release_memory, spare
from shelfmark.session import durable

log = logging.getLogger(__name__)

ROUNDS = 3
# A view passes on labels that it gives with at least this calibrated probability.
CONFIDENT = 0.95
# Ridge penalty per fitted row weight; most Newton steps of a fit, and the step at which it ends.
RIDGE, STEPS, TOLERANCE = 1e-3, 25, 2e-2
# Slots of hashed words, and of hashed languages and sources; weight of the prior of a slot.
SLOTS, PRIOR = 1 << 16, 2.0
# Documents are dealt into folds by id. Fold 0 is held out; each of the others is judged by
# slots that were counted without it.
FOLDS = 5
SIZES = 20
WORDS, META = 0, 1
# Texts are handled in steps of about this many bytes.
STEP_BYTES = 8 << 20

# Byte classes of the text view.
_CLASS = np.full(256, 8, dtype=np.uint8)
_CLASS[list(range(97, 123))] = 0
_CLASS[list(range(65, 91))] = 1
_CLASS[list(range(48, 58))] = 2
_CLASS[[32, 9, 11, 12, 13]] = 3
_CLASS[10] = 4
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 5
_CLASS[ord("!")] = 6
_CLASS[list(range(128, 256))] = 7

SHAPE_DIM = 22
TEXT_DIM, META_DIM = SHAPE_DIM + 2, 4 + SIZES


def text_features(text: str | None) -> tuple[list[float], np.ndarray]:
    """Shape of a whole text (shares of character classes, lengths, repetition), and the slots
    of its distinct words, A-Z lower-cased."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * (SHAPE_DIM - 1) + [1.0], np.zeros(0, dtype=np.uint16)
    shares = np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=9) / len(raw)
    letters = shares[0] + shares[1] + shares[7]
    words = raw.split()
    n = max(1, len(words))
    count = Counter(words)
    top = count.most_common(1)[0][1] / n if words else 0.0
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
    mean = float(lengths.mean()) if words else 0.0
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False)) / n
    bare = sum(not w.isalnum() and not w[:1].isalpha() and w[0] < 128 for w in words) / n
    ended = sum(w[-1] in b"!?.,;:#$%&*|~" for w in words) / n
    odd_end = sum(w[-1] in b"!#$%&*|~" for w in words) / n
    lines = raw.split(b"\n")
    distinct = len(set(lines)) / len(lines)
    slots = {zlib.crc32(w.lower()) & (SLOTS - 1) for w in count}
    return [
        shares[0], shares[1], shares[2] * 5, shares[3], shares[4] * 5, shares[5] * 5,
        shares[6] * 5, shares[7], shares[8] * 5, letters, shares[1] / max(letters, 1e-9),
        math.log1p(n) / 5, min(mean, 30) / 10, math.log1p(len(count)) / math.log1p(n),
        top, repeats, bare, ended, odd_end, distinct, math.log1p(n / len(lines)) / 5, 1.0,
    ], np.fromiter(slots, dtype=np.uint16, count=len(slots))


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> list[int]:
    """Slots of source and language, and the power of two of the declared size; a null is a
    value of its own."""
    size = 0 if n_chars is None or n_chars < 0 else min(SIZES - 1, 1 + int(math.log2(1 + n_chars)))
    slots = (xxhash.xxh32_intdigest(t) & (SLOTS - 1) for t in (f"s{source}", f"l{lang}"))
    return [*slots, size]


@dataclass
class Slots:
    """Smoothed log-odds of good quality of every slot, one line per fold, and how well known."""

    odds: np.ndarray
    known: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, totals: np.ndarray) -> Slots:
        """From documents per (fold, label, slot) and per (fold, label).

        A fold's own documents don't count for it, and held-out ones for none. A slot that
        nobody has counts as undecided.
        """
        odds = np.zeros((FOLDS, SLOTS), dtype=np.float32)
        known = np.zeros((FOLDS, SLOTS), dtype=np.float32)
        for f in range(FOLDS):
            others = [g for g in range(1, FOLDS) if g != f]
            bad, good = counts[others].sum(axis=0)
            n_bad, n_good = totals[others].sum(axis=0)
            known[f] = np.log1p(bad + good)
            if n_bad and n_good:
                n = n_bad + n_good
                odds[f] = np.log((good + PRIOR * n_good / n) / n_good) - np.log((bad + PRIOR * n_bad / n) / n_bad)
        return Slots(odds, known)


@dataclass
class View:
    """What slots say, weights of the features, and slope and offset of the calibration."""

    slots: Slots
    weights: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * (x @ self.weights) + self.offset, -15, 15)


@dataclass
class Model:
    """Both views, and the weights that combine their calibrated logits."""

    views: tuple[View, View]
    mix: np.ndarray
    floor: float = 0.5

    def score(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = (view.logit(rows.matrix(k, view.slots)) for k, view in enumerate(self.views))
        both = np.column_stack((a, b, np.ones(len(a)))) @ self.mix
        return _sigmoid(a), _sigmoid(b), _sigmoid(both)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Rows:
    """Features of some documents: shape numbers, slots of words with offsets, metadata, fold."""

    shape: np.ndarray
    words: np.ndarray
    ends: np.ndarray
    meta: np.ndarray
    fold: np.ndarray

    @staticmethod
    def of(texts: list, langs: list, sources: list, sizes: list, fold: np.ndarray) -> Rows:
        both = [text_features(t) for t in texts]
        n = np.fromiter((len(w) for _, w in both), dtype=np.int64, count=len(both))
        return Rows(
            np.array([s for s, _ in both], dtype=np.float32).reshape(-1, SHAPE_DIM),
            np.concatenate([w for _, w in both]) if both else np.zeros(0, dtype=np.uint16),
            np.concatenate(([0], np.cumsum(n))),
            np.array(list(map(meta_features, langs, sources, sizes)), dtype=np.int64).reshape(-1, 3),
            fold,
        )

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.fold)), np.diff(self.ends))

    def matrix(self, kind: int, slots: Slots) -> np.ndarray:
        """Features of one view: what its slots say beside the shape or the size."""
        if kind == WORDS:
            row = self.row_of_word()
            total = np.bincount(row, slots.odds[self.fold[row], self.words], minlength=len(self.fold))
            n = np.maximum(1, np.diff(self.ends))
            return np.column_stack((self.shape.astype(np.float64), total / n, total / np.sqrt(n) / 5))
        size = np.zeros((len(self.fold), SIZES))
        size[np.arange(len(size)), self.meta[:, 2]] = 1.0
        source, lang = (slots.odds[self.fold, self.meta[:, k]] for k in (0, 1))
        support = slots.known[self.fold, self.meta[:, 0]] / 5
        return np.column_stack((source, lang, support * source, np.ones(len(size)), size))


def _texts_in_steps(batch: pa.RecordBatch, at: int):
    """Slices of a batch, each with about STEP_BYTES of text."""
    start = held = 0
    for i, value in enumerate(batch.column(at)):
        held += len(value.as_buffer()) if value.is_valid else 0
        if held > STEP_BYTES:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _fold(id_col: str) -> Column:
    """The fold of a document; one without an id is never held out."""
    known = F.col(f"`{id_col}`").cast("bigint")
    dealt = F.pmod(F.xxhash64(F.lit("fold"), known), F.lit(FOLDS)).cast("int")
    return F.when(known.isNotNull(), dealt).otherwise(F.lit(1))


def _featured(docs: DataFrame) -> DataFrame:
    """id, fold and features of (id, fold, t, l, s, c); texts stay where they are read."""

    def run(batches):
        for whole in batches:
            for batch in _texts_in_steps(whole, 2):
                fold = batch.column(1).to_numpy()
                rows = Rows.of(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), fold)
                raw = pa.py_buffer(np.ascontiguousarray(rows.words).view(np.uint8))
                ends = pa.py_buffer((rows.ends * 2).astype(np.int32))
                words = pa.Array.from_buffers(pa.binary(), len(fold), [None, ends, raw])
                lists = [
                    pa.ListArray.from_arrays(np.arange(len(fold) + 1, dtype=np.int32) * v.shape[1], v.ravel())
                    for v in (rows.shape, rows.meta.astype(np.int32))
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), lists[0], words, lists[1]],
                    names=["id", "fold", "x", "w", "m"],
                )
        release_memory()

    return docs.mapInArrow(run, "id bigint, fold int, x array<float>, w binary, m array<int>")


def _read(batch: pa.RecordBatch) -> Rows:
    w = batch.column("w")
    ends = np.frombuffer(w.buffers()[1], dtype=np.int32)[w.offset : w.offset + len(w) + 1]
    raw = w.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    words = data[ends[0] : ends[-1]].copy().view(np.uint16)
    return Rows(
        lists_of(batch.column("x"))[0].reshape(-1, SHAPE_DIM),
        words,
        (ends - ends[0]).astype(np.int64) // 2,
        lists_of(batch.column("m"))[0].reshape(-1, 3).astype(np.int64),
        batch.column("fold").to_numpy(),
    )


def _labels(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("y").to_numpy(zero_copy_only=False).astype(np.float64)


def _targets(rows: Rows, y: np.ndarray, judge: Model | None, kind: int, confident: float):
    """Labels for a view's fit, and the rows that take part: labelled ones that are not held
    out, and, given a ``judge``, those of which its other view is sure."""
    use = ~np.isnan(y) & (rows.fold != 0)
    target = np.nan_to_num(y)
    if judge is not None:
        other = judge.views[1 - kind]
        p = _sigmoid(other.logit(rows.matrix(1 - kind, other.slots)))
        sure = np.isnan(y) & (rows.fold != 0) & ((p >= confident) | (p <= 1 - confident))
        target, use = np.where(sure, p >= 0.5, target), use | sure
    return target, use


def _ship(df: DataFrame, state: object):
    """A broadcast of what tasks need of the model, compressed; a few MB at most by the number
    of slots. It carries its own code, and is destroyed as soon as a fit is done with it."""
    raw = zlib.compress(cloudpickle.dumps(state), 1)
    return df.sparkSession.sparkContext.broadcast(raw)


def _state(sent):
    return pickle.loads(zlib.decompress(sent.value))


def _sums(table: DataFrame, sent, make: Callable[[dict, Rows, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum over all rows of the array that ``make`` returns per batch, given what was sent.

    A task adds up its batches and sends on one row per key that is not zero; as many rows
    come back as there are keys, whatever the number of documents.
    """

    def run(batches):
        total: np.ndarray | None = None
        state = _state(sent)
        for batch in batches:
            if batch.num_rows:
                got = make(state, _read(batch), _labels(batch))
                total = got if total is None else total + got
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"k": at.astype(np.int32), "v": total[at].astype(np.float64)})

    parts = table.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v"))
    got = parts.toArrow()
    out = np.zeros(size)
    out[got.column("k").to_numpy()] = got.column("v").to_numpy()
    return out


def _count_slots(table: DataFrame, sent, confident: float) -> tuple[Slots, Slots]:
    """Slots of both views from the labels, and from what the other view is sure of."""
    size = FOLDS * 2 * (SLOTS + 1)

    def make(state: dict, rows: Rows, y: np.ndarray) -> np.ndarray:
        out = np.zeros(2 * size)
        for kind in (WORDS, META):
            target, use = _targets(rows, y, state["before"], kind, confident)
            line = (rows.fold * 2 + target.astype(np.int64)) * (SLOTS + 1)
            if kind == WORDS:
                row = rows.row_of_word()
                here = use[row]
                keys = line[row[here]] + rows.words[here]
            else:
                keys = (line[use, None] + rows.meta[use, :2]).ravel()
            keys = np.concatenate((keys, line[use] + SLOTS))
            out += np.bincount(keys + kind * size, minlength=2 * size)
        return out

    counts = _sums(table, sent, make, 2 * size).reshape(2, FOLDS, 2, SLOTS + 1)
    return tuple(Slots.of(c[:, :, :SLOTS], c[:, :, SLOTS]) for c in counts)


@dataclass
class Problem:
    """A logistic regression: ``pick`` gives features, targets of the rows of a batch that count."""

    weights: np.ndarray
    pick: Callable[[dict, Rows, np.ndarray], tuple[np.ndarray, np.ndarray]]
    ridge: float = RIDGE
    done: bool = False

    def part(self, state: dict, rows: Rows, y: np.ndarray) -> np.ndarray:
        """Weight, gradient and curvature of a batch."""
        x, target = self.pick(state, rows, y)
        p = _sigmoid(x @ self.weights)
        h = x * (p * (1 - p))[:, None]
        return np.concatenate(([len(x)], x.T @ (p - target), (h.T @ x).ravel()))

    def step(self, total: np.ndarray) -> None:
        """One Newton step; done when it no longer moves anything."""
        d = len(self.weights)
        weight, grad, hess = total[0], total[1 : d + 1], total[d + 1 :].reshape(d, d)
        if weight <= 0:
            self.done = True
            return
        pull = self.ridge * max(weight, 1.0)
        step = np.linalg.solve(hess + pull * np.eye(d), grad + pull * self.weights)
        self.weights = self.weights - step / max(1.0, np.abs(step).max() / 5)
        self.done = bool(np.abs(step).max() <= TOLERANCE)


def _solve(table: DataFrame, sent, problems: list[Problem]) -> list[np.ndarray]:
    """Newton steps of several problems over the same rows until all have converged, one pass
    a step for all."""
    for _ in range(STEPS):
        live = [p for p in problems if not p.done]
        if not live:
            break
        sizes = [1 + len(p.weights) + len(p.weights) ** 2 for p in live]
        sums = _sums(table, sent, lambda c, r, y, live=live: np.concatenate([p.part(c, r, y) for p in live]), sum(sizes))
        for p, total in zip(live, np.split(sums, np.cumsum(sizes)[:-1]), strict=True):
            p.step(total)
    if not all(p.done for p in problems):
        log.warning("a fit still moved after %d steps", STEPS)
    return [p.weights for p in problems]


def _held_out(kinds: tuple[int, ...], lines: dict[int, tuple[np.ndarray, float, float]]):
    """Logits of views (weights, slope, offset) on the labelled rows that no fit has seen."""

    def pick(state: dict, rows: Rows, y: np.ndarray):
        use = ~np.isnan(y) & (rows.fold == 0)
        views = [(k, View(state["slots"][k], *lines[k])) for k in kinds]
        z = [view.logit(rows.matrix(k, view.slots))[use] for k, view in views]
        return np.column_stack((*z, np.ones(int(use.sum())))), y[use]

    return pick


def _fit(table: DataFrame, before: Model | None, confident: float) -> tuple[View, View]:
    """Both views, fitted to the labels and to what the other view of ``before`` is sure of."""
    sent = _ship(table, {"before": before})
    slots = _count_slots(table, sent, confident)
    sent.destroy()

    def examples(kind: int):
        def pick(state: dict, rows: Rows, y: np.ndarray):
            target, use = _targets(rows, y, state["before"], kind, confident)
            return rows.matrix(kind, state["slots"][kind])[use], target[use]

        return pick

    sent = _ship(table, {"before": before, "slots": slots})
    start = (np.zeros(TEXT_DIM), np.zeros(META_DIM)) if before is None else [v.weights for v in before.views]
    weights = _solve(table, sent, [Problem(start[k], examples(k)) for k in (WORDS, META)])
    views = tuple(View(slots[k], weights[k]) for k in (WORDS, META))
    lines = [(1.0, 0.0)] * 2 if before is None else [(v.slope, v.offset) for v in before.views]
    raw = {k: (weights[k], 1.0, 0.0) for k in (WORDS, META)}
    problems = [Problem(np.array(lines[k]), _held_out((k,), raw), 1e-4) for k in (WORDS, META)]
    for view, (slope, offset) in zip(views, _solve(table, sent, problems), strict=True):
        view.slope, view.offset = float(slope), float(offset)
    sent.destroy()
    return views


def _labelled(docs: DataFrame, labels: DataFrame, label_id_col: str, label_col: str) -> DataFrame:
    """Feature rows with their label (null where there is none).

    Rows without an id have no label and take no part in the join. Labels grow with the
    documents, so both sides are dealt by id whatever their size: a join that sends all labels
    to every task on small tables would be another one on large tables.
    """
    marks = (
        labels.select(F.col(f"`{label_id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").cast("double").alias("q"))
        .dropna()
        .groupBy("id")
        .agg((F.avg("q") >= 0.5).cast("double").alias("y"))
    )
    known = _featured(docs.where("id is not null")).join(marks.hint("merge"), "id", "left")
    lost = _featured(docs.where("id is null")).withColumn("y", F.lit(None).cast("double"))
    return known.unionByName(lost)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    size_col: str = "n_chars",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    rounds: int = ROUNDS,
    confident: float = CONFIDENT,
) -> tuple[Model, DataFrame]:
    """Fit both views on all labelled documents, then let each teach the other.

    The text view has the shape of the text and what its words say; the metadata view has
    source, language and declared size. What a word, a source or a language says are its
    smoothed log-odds among the examples, counted in hashed slots; a document is judged by
    counts that leave out its own fold, so it never vouches for itself. In each round both
    views score all documents; where one is sure of a document without a label, that document
    joins the other view's examples with the given label, in counts and in fit. A view that
    can't be sure of anything passes on nothing. Counts, gradients and curvatures are summed
    over all rows in the cluster; only those sums, of fixed size, reach the driver. One fifth
    of the documents, by a hash of the id, is kept from counts and fits: on its labels the
    views are calibrated and their calibrated logits combined.

    Returns the model and the table of the features of all documents.
    """
    small = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), _fold(id_col).alias("fold"),
        F.col(f"`{text_col}`").cast("string").alias("t"), F.col(f"`{lang_col}`").cast("string").alias("l"),
        F.col(f"`{source_col}`").cast("string").alias("s"), F.col(f"`{size_col}`").cast("bigint").alias("c"),
    )
    table = durable(_labelled(small, labels, label_id_col, label_col))
    model = Model(_fit(table, None, confident), np.array([1.0, 1.0, 0.0]))
    for _ in range(rounds):
        last = np.concatenate([v.weights for v in model.views])
        model = Model(_fit(table, model, confident), np.array([1.0, 1.0, 0.0]))
        if np.abs(np.concatenate([v.weights for v in model.views]) - last).max() < TOLERANCE:
            break  # neither view has learnt anything from the other
    # the calibrated logits are the features of the combination
    sent = _ship(table, {"slots": [v.slots for v in model.views]})
    lines = {k: (v.weights, v.slope, v.offset) for k, v in enumerate(model.views)}
    both = Problem(np.array([1.0, 0.0, 0.0]), _held_out((WORDS, META), lines), 1e-4)
    (model.mix,) = _solve(table, sent, [both])
    sent.destroy()
    return model, table


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document: id, probability of good quality by each view and by both, kept.

    Null and empty texts have the features of an empty text; null language, source or size
    are values of their own; a null id only means that no label is found. Several labels of a
    document count by majority (a tie as good), null labels not at all. Without any label
    everything scores 0.5 and is kept. Repeated rows are rows of their own; other columns are
    ignored; an empty table gives no rows.
    """
    trained, table = train(docs, labels, id_col=id_col, **options)
    sent = _ship(table, trained)

    def run(batches):
        model = _state(sent)
        for batch in batches:
            if batch.num_rows:
                a, b, q = model.score(_read(batch))
                kept = pa.array(q >= model.floor)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(a), pa.array(b), pa.array(np.round(q, 9)), kept],
                    names=["id", "p_text", "p_meta", "p", "kept"],
                )

    scored = table.mapInArrow(run, "id bigint, p_text double, p_meta double, p double, kept boolean")
    return scored.withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              lang_col: str = "lang", source_col: str = "source", size_col: str = "n_chars",
              **options) -> DataFrame:
    """The rows of ``docs`` that :func:`score_quality` keeps, with their own columns only.

    Nulls, repeated rows, missing labels and empty tables count as they do there. The model
    is fitted once; documents are then judged where they are read, in one pass, unshuffled.
    """
    columns = {"text_col": text_col, "lang_col": lang_col, "source_col": source_col, "size_col": size_col}
    trained, _ = train(docs, labels, id_col=id_col, **columns, **options)
    sent = _ship(docs, trained)
    (fold,) = spare(docs.columns, "fold")
    src = docs.withColumn(fold, _fold(id_col))
    names = src.columns
    at = [names.index(c) for c in columns.values()]

    def run(batches):
        model = _state(sent)
        for whole in batches:
            for batch in _texts_in_steps(whole, at[0]):
                values = [batch.column(k).to_pylist() for k in at]
                rows = Rows.of(*values, batch.column(len(names) - 1).to_numpy())
                kept = pa.array(model.score(rows)[2] >= model.floor)
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=names[:-1]).filter(kept)
        release_memory()

    return src.mapInArrow(run, docs.schema)
