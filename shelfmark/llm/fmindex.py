"""Benchmark decontamination: an FM-index per training shard, searched for benchmark phrases."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.blocks import release_memory, spare

# Bytes of text in one shard: bounds what a task holds, whatever its partition is like.
SHARD_BYTES = 4 << 20
# Bytes of phrases that travel to the tasks at once; more items are searched in more passes.
PHRASE_BYTES = 16 << 20
# Every SAMPLE-th text position is kept in the suffix sample.
SAMPLE = 8

# What is no letter, digit or non-ASCII byte separates words; A-Z become a-z.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class WaveletMatrix:
    """Ranks of symbols in a sequence of small integers, many at a time."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits = bits
        self.zeros: list[int] = []
        self.ones: list[np.ndarray] = []
        for level in range(bits - 1, -1, -1):
            bit = (seq >> level) & 1
            count = np.zeros(len(seq) + 1, dtype=np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(seq) - int(count[-1]))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``at``."""
        start = np.zeros(len(at), dtype=np.int64)
        for depth in range(self.bits):
            ones, zeros = self.ones[depth], self.zeros[depth]
            bit = (symbol >> (self.bits - 1 - depth)) & 1 == 1
            at = np.where(bit, zeros + ones[at], at - ones[at])
            start = np.where(bit, zeros + ones[start], start - ones[start])
        return at - start


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only groups that still tie are sorted again."""
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    new = np.concatenate(([True], seq[order][1:] != seq[order][:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = first
    step = 1
    while True:
        # a group is the run of rows with the same first row
        size_one = new & np.concatenate((new[1:], [True]))
        rows = np.flatnonzero(~size_one)
        if not len(rows):
            return order
        at = order[rows]
        after = at + step
        key = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        sub = np.lexsort((key, first[rows]))
        order[rows] = at[sub]
        group, key = first[rows], key[sub]
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])))
        new[rows] = fresh
        first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[rows]] = first[rows]
        step *= 2


class FMIndex:
    """Burrows-Wheeler index of a sequence of symbols >= 1, with a sampled suffix array."""

    def __init__(self, seq: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        seq = np.append(seq, 0)  # the end, smaller than all
        order = suffix_order(seq)
        bwt = seq[order - 1]
        self.n = len(seq)
        self.bwt = bwt
        self.wavelet = WaveletMatrix(bwt, max(1, int(n_symbols).bit_length()))
        self.before = np.concatenate(
            ([0], np.cumsum(np.bincount(seq, minlength=n_symbols + 1)))
        ).astype(np.int64)
        self.kept = order % sample == 0
        self.kept_before = np.concatenate(([0], np.cumsum(self.kept))).astype(np.int64)
        self.positions = order[self.kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each phrase: one phrase a line, read from its end; 0 pads the front."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        live = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, column]
            live, symbol = live[symbol > 0], symbol[symbol > 0]
            if not len(live):
                break
            base = self.before[symbol]
            low[live] = base + self.wavelet.rank(symbol, low[live])
            high[live] = base + self.wavelet.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back to the next sampled suffix."""
        at, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        out = np.empty(len(rows), dtype=np.int64)
        live = np.arange(len(rows))
        while len(live):
            done = self.kept[at[live]]
            hit = live[done]
            out[hit] = self.positions[self.kept_before[at[hit]]] + steps[hit]
            live = live[~done]
            symbol = self.bwt[at[live]]
            at[live] = self.before[symbol] + self.wavelet.rank(symbol, at[live])
            steps[live] += 1
        return out


class Phrases:
    """Windows of ``window`` words of the items; a shorter item is one window.

    ``table`` has one line for each different window, numbered words from 1, padded in front;
    ``items`` gives the items that hold it.
    """

    def __init__(self, items: list[tuple[int, str]], window: int):
        self.ids: dict[bytes, int] = {}
        found: dict[tuple, set] = {}
        for item, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            width = min(window, len(words))
            for i in range(len(words) - width + 1 if words else 0):
                found.setdefault(tuple(words[i : i + width]), set()).add(item)
        self.width = np.array([len(p) for p in found], dtype=np.int64)
        self.items = [sorted(v) for v in found.values()]
        self.shortest = int(self.width.min()) if len(found) else 0
        longest = int(self.width.max()) if len(found) else 0
        self.table = np.zeros((len(found), longest), dtype=np.int64)
        for i, p in enumerate(found):
            self.table[i, longest - len(p) :] = p

    @property
    def other(self) -> int:
        """Symbol of all words that occur in no phrase."""
        return len(self.ids) + 1


def scan_shard(texts: list[bytes], phrases: Phrases) -> list[tuple[list, list]]:
    """Per text (folded bytes): merged spans [first word, end) that phrases cover, and item ids.

    One FM-index is built over the shard. Stretches of words that occur in no phrase, and the
    borders of texts, stand as one symbol each, and a stretch of phrase words that is shorter
    than the shortest phrase joins them: no phrase reaches across or fits in.
    """
    spans: list[tuple[list, list]] = [([], []) for _ in texts]
    if not len(phrases.items):
        return spans
    get, other = phrases.ids.get, phrases.other
    words = [w for t in texts for w in (*t.split(), None)]  # None: border
    symbol = np.fromiter((get(w, other) for w in words), dtype=np.int64, count=len(words))
    del words
    known = symbol != other
    edge = np.flatnonzero(np.diff(np.concatenate(([0], known.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    long_enough = ends - starts >= phrases.shortest
    starts, ends = starts[long_enough], ends[long_enough]
    if not len(starts):
        return spans
    # runs of known words, each followed by one separator
    sizes = ends - starts + 1
    offset = np.concatenate(([0], np.cumsum(sizes)))
    where = np.repeat(starts - offset[:-1], sizes) + np.arange(offset[-1])
    seq = symbol[np.minimum(where, len(symbol) - 1)]
    seq[offset[1:] - 1] = other
    index = FMIndex(seq, other)
    low, high = index.search(phrases.table)
    which = np.flatnonzero(high > low)
    if not len(which):
        return spans
    many = (high - low)[which]
    phrase = np.repeat(which, many)
    rows = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + low[phrase]
    at = where[index.locate(rows)]
    borders = _borders(texts)
    doc = np.searchsorted(borders, at, side="right") - 1
    first = at - borders[doc]
    end = first + phrases.width[phrase]
    order = np.lexsort((first, doc))
    doc, first, end, phrase = doc[order], first[order], end[order], phrase[order]
    cuts = np.flatnonzero(np.diff(doc)) + 1
    for part in np.split(np.arange(len(doc)), cuts):
        merged: list[list[int]] = []
        for a, b in zip(first[part].tolist(), end[part].tolist(), strict=True):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        items = {i for p in np.unique(phrase[part]).tolist() for i in phrases.items[p]}
        spans[int(doc[part[0]])] = (merged, sorted(items))
    return spans


def _borders(texts: list[bytes]) -> np.ndarray:
    return np.concatenate(([0], np.cumsum([len(t.split()) + 1 for t in texts])))


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """The items in blocks of bounded bytes, so that any number of them can be searched."""
    items = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    items = items.where("i is not null and t is not null").orderBy("i", "t")
    block, held = [], 0
    for row in items.toLocalIterator(prefetchPartitions=False):
        block.append((row.i, row.t))
        held += len(row.t) + 64
        if held > PHRASE_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block


def find_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    out: tuple[str, str, str] = ("n_words", "spans", "items"),
) -> DataFrame:
    """``docs`` with the number of words, merged [first, end) word spans, and item ids found.

    Each task reads its partition in shards of bounded bytes, builds an FM-index over a shard
    and searches all phrases in it, so nothing is shuffled and a lost task is just run again.
    A text larger than a shard is a shard of its own. The phrases are the stated query set:
    they travel to the tasks in blocks of bounded size, one pass over the documents a block.
    Null and empty texts have no words and no spans; items with a null id or text, or without
    words, are never found; repeated items count once. Repeated rows and rows with a null id
    are searched like any other; an empty table gives no rows. The columns named by ``out``
    replace columns of ``docs`` of that name; all others are kept.
    """
    found, blocks = _with_columns(docs, out), _item_blocks(benchmark, item_id_col, item_text_col)
    empty = True
    for block in blocks:
        found = _search_block(found, Phrases(block, window), text_col, out)
        empty = False
    return _search_block(found, Phrases([], window), text_col, out) if empty else found


def _with_columns(docs: DataFrame, out: tuple[str, str, str]) -> DataFrame:
    kinds = ("bigint", "array<array<bigint>>", "array<bigint>")
    taken = {c.lower() for c in out}
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]
    return docs.select(*rest, *(F.lit(None).cast(k).alias(c) for c, k in zip(out, kinds, strict=True)))


def _search_block(
    docs: DataFrame,
    phrases: Phrases,
    text_col: str,
    out: tuple[str, str, str],
    cut: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    cut_schema: T.StructType | None = None,
) -> DataFrame:
    """``docs`` with what one block of phrases finds added to what earlier ones have found;
    the last pass may go on to ``cut`` the texts."""
    names = docs.columns
    text_at, (words_at, spans_at, items_at) = names.index(text_col), map(names.index, out)
    sent = docs.sparkSession.sparkContext.broadcast(phrases)

    def shard(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        got = scan_shard(texts, sent.value)
        columns = [batch.column(k) for k in range(len(names))]
        old_spans, old_items = columns[spans_at].to_pylist(), columns[items_at].to_pylist()
        spans = [_union(o or [], s) for o, (s, _) in zip(old_spans, got, strict=True)]
        items = [sorted({*(o or []), *i}) for o, (_, i) in zip(old_items, got, strict=True)]
        columns[words_at] = pa.array([len(t.split()) for t in texts], type=pa.int64())
        columns[spans_at] = pa.array(spans, type=pa.list_(pa.list_(pa.int64())))
        columns[items_at] = pa.array(items, type=pa.list_(pa.int64()))
        found = pa.RecordBatch.from_arrays(columns, names=names)
        return found if cut is None else cut(found)

    def run(batches):
        for batch in batches:
            start, held, texts = 0, 0, []
            for i, value in enumerate(batch.column(text_at)):
                folded = (value.as_py() or "").encode("utf-8", "surrogatepass").translate(_FOLD)
                if texts and held + len(folded) > SHARD_BYTES:
                    yield shard(batch.slice(start, i - start), texts)
                    start, held, texts = i, 0, []
                texts.append(folded)
                held += len(folded)
            if texts:
                yield shard(batch.slice(start), texts)
        release_memory()

    return docs.mapInArrow(run, docs.schema if cut is None else cut_schema)


def _union(a: list, b: list) -> list:
    if not a or not b:
        return a or b
    merged: list[list[int]] = []
    for x, y in sorted([*a, *b]):
        if merged and x <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], y)
        else:
            merged.append([x, y])
    return merged


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    window: int = 10,
    size_col: str | None = None,
) -> DataFrame:
    """``docs`` with every word that a benchmark phrase covers cut out of the text.

    The characters between two cut words go with them; what stands before and after a span
    stays, joined by one space. Texts without a hit are returned as they are, nulls too. All
    columns are kept; ``size_col``, if given, becomes the new number of characters of cut texts.
    Repeated rows and rows with a null id are cut like any other; an empty table gives no rows.
    Search and cut are one pass where the phrases fit one block.
    """
    out = spare(docs.columns, "n_words", "spans", "items")
    found = _with_columns(docs, out)
    names, found_names = docs.columns, found.columns
    order = [found_names.index(n) for n in names]
    text_at, spans_at = found_names.index(text_col), found_names.index(out[1])

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, spans = batch.column(text_at).to_pylist(), batch.column(spans_at).to_pylist()
        left = [cut_spans(t, s) if s else t for t, s in zip(texts, spans, strict=True)]
        arrays = [batch.column(k) for k in order]
        arrays[names.index(text_col)] = pa.array(left, type=batch.schema.field(text_at).type)
        if size_col is not None:
            at = names.index(size_col)
            old = arrays[at].to_pylist()
            new = [len(c) if s else n for c, s, n in zip(left, spans, old, strict=True)]
            arrays[at] = pa.array(new, type=arrays[at].type)
        return pa.RecordBatch.from_arrays(arrays, names=names)

    last = Phrases([], window)
    for n, block in enumerate(_item_blocks(benchmark, "item_id", "text")):
        if n:
            found = _search_block(found, last, text_col, out)
        last = Phrases(block, window)
    return _search_block(found, last, text_col, out, cut, docs.schema)


def cut_spans(text: str, spans: list) -> str:
    """``text`` without the words of the spans."""
    raw = text.encode("utf-8", "surrogatepass")
    folded = np.frombuffer(raw.translate(_FOLD), dtype=np.uint8)
    word = folded != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([0], word.view(np.int8), [0]))))
    begins, ends = edge[::2], edge[1::2]
    parts, at = [], 0
    for first, end in spans:
        parts.append(raw[at : begins[first]].rstrip())
        at = int(ends[end - 1])
    parts.append(raw[at:].lstrip())
    return b" ".join(p for p in parts if p).decode("utf-8", "surrogatepass")
