"""BPE encoding and decoding with the merges of a public tokenizer file."""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import release_memory

# Distinct pieces a task remembers at least; at twice as many the older ones go.
PIECES = 80_000
# Ids per Arrow batch that a task sends on are about this many.
OUT_IDS = 500_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it prints, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def lower_each(text: str) -> str:
    """Lower case code point by code point, without a rule for a word's last letter."""
    return text.replace("Σ", "σ").lower()


class WordBPE:
    """Encoder for a word-level BPE file: lower case, white space dropped.

    ``spec`` is the parsed tokenizer file. Strings of its added tokens are found first and
    become their ids. The rest of a text is normalised (NFC, lower case) and cut into pieces
    by the file's pattern; each piece is spelled in byte letters, with the file's suffix on
    its last symbol, and merged.
    """

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {pair: i for i, pair in enumerate(pairs)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = added
        longest = sorted(added, key=len, reverse=True)
        self.split_added = (
            regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if added else None
        )
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        pattern = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        # white space as the file's own engine has it
        space = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
        self.pieces = regex.compile(pattern.replace(r"\s", space)).findall
        self.letters = byte_letters()
        self.known: dict[str, array] = {}
        self.older: dict[str, array] = {}

    def forget(self) -> None:
        """Give the memory of pieces back; workers outlive their tasks."""
        self.known, self.older = {}, {}

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece: merges in order of rank, the leftmost first.

        The symbols are a doubly linked list. A queue holds (rank, position) of every adjacent
        pair that can merge; an entry whose pair is gone when its turn comes is skipped.
        """
        letters, ranks = self.letters, self.ranks
        symbols = [letters[b] for b in piece.encode("utf-8", "surrogatepass")]
        symbols[-1] += self.suffix
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        queue = []
        for i, pair in enumerate(zip(symbols, symbols[1:], strict=False)):
            rank = ranks.get(pair)
            if rank is not None:
                queue.append((rank, i, pair))
        heapq.heapify(queue)
        while queue:
            _, i, pair = heapq.heappop(queue)
            j = after[i]
            if j < 0 or symbols[i] != pair[0] or symbols[j] != pair[1]:
                continue
            symbols[i], symbols[j] = pair[0] + pair[1], ""
            k = after[i] = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                new = (symbols[i], symbols[k])
                rank = ranks.get(new)
                if rank is not None:
                    heapq.heappush(queue, (rank, i, new))
            h = before[i]
            if h >= 0:
                new = (symbols[h], symbols[i])
                rank = ranks.get(new)
                if rank is not None:
                    heapq.heappush(queue, (rank, h, new))
        # a symbol outside the vocabulary has no id and leaves none
        return [self.vocab[s] for s in symbols if s and s in self.vocab]

    def _plain(self, text: str, out: array) -> None:
        if len(self.known) > PIECES:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        for piece in self.pieces(lower_each(unicodedata.normalize("NFC", text))):
            ids = known.get(piece)
            if ids is None:
                ids = older.get(piece)
                if ids is None:
                    ids = array("i", self.merge(piece))
                known[piece] = ids
            out += ids

    def encode_into(self, text: str | None, out: array) -> None:
        """Append the ids of a whole text."""
        text = text or ""
        if self.split_added is None or not any(a in text for a in self.added):
            self._plain(text, out)
            return
        for part in self.split_added.split(text):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                self._plain(part, out)

    def encode(self, text: str | None) -> list[int]:
        out = array("i")
        self.encode_into(text, out)
        return out.tolist()


class Decoder:
    """Vocabulary strings of ids; a file without a decoder puts a space between them."""

    def __init__(self, spec: dict):
        strings = {i: s for s, i in spec["model"]["vocab"].items()}
        strings |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.strings = pa.array([strings.get(i) for i in range(max(strings) + 1)], pa.string())

    def decode_lists(self, lists: pa.ListArray) -> pa.Array:
        """Texts of many id lists; a null list is empty, unknown ids are skipped."""
        lists = pc.fill_null(lists, pa.scalar([], type=lists.type)) if lists.null_count else lists
        ids = lists.flatten()
        known = pc.and_(pc.less(ids, len(self.strings)), pc.greater_equal(ids, 0))
        strings = self.strings.take(pc.if_else(known, ids, None))
        if strings.null_count:
            whole = zip(lists.value_lengths().to_pylist(), strict=True)
            parts, at = [], 0
            for (n,) in whole:
                parts.append(" ".join(x for x in strings[at : at + n].to_pylist() if x is not None))
                at += n
            return pa.array(parts, pa.string())
        offsets = pc.subtract(lists.offsets, lists.offsets[0])
        return pc.binary_join(pa.ListArray.from_arrays(offsets, strings), " ")


@lru_cache(maxsize=2)
def _coder(spec: str) -> WordBPE:
    return WordBPE(json.loads(spec))


@lru_cache(maxsize=2)
def _decoder(spec: str) -> Decoder:
    return Decoder(json.loads(spec))


def read_spec(path: str) -> str:
    """The tokenizer file, read on the driver; it travels to the tasks (a few MB, fixed)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or spec.get("decoder") is not None:
        raise ValueError("a BPE file without a decoder is needed")
    return json.dumps(spec)


def _id_batches(coder: WordBPE, batch: pa.RecordBatch, text_at: int):
    """Slices of a batch with the id lists of their texts, about OUT_IDS ids each."""
    start, ids, ends = 0, array("i"), [0]
    for i, text in enumerate(batch.column(text_at)):
        coder.encode_into(text.as_py(), ids)
        ends.append(len(ids))
        if len(ids) > OUT_IDS or i + 1 == batch.num_rows:
            values = pa.array(np.frombuffer(ids, dtype=np.int32) if ids else [], pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield batch.slice(start, i + 1 - start), lists
            start, ids, ends = i + 1, array("i"), [0]


def _without(docs: DataFrame, *gone: str) -> list:
    taken = {c.lower() for c in gone}
    return [F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken]


def encode(
    docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids"
) -> DataFrame:
    """``docs`` with the token ids of the whole text (array of int).

    A null text counts as empty and has no ids. ``out_col`` replaces a column of that name,
    all others are kept. Repeated rows and null ids stay rows of their own; an empty table
    gives no rows. One pass, no shuffle; each distinct piece is merged once per task.
    """
    src = docs.select(*_without(docs, out_col), F.lit(None).cast("array<int>").alias(out_col))
    names, schema = src.columns, src.schema
    text_at = names.index(text_col)
    spec = src.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches):
        coder = _coder(spec.value)
        for batch in batches:
            for part, lists in _id_batches(coder, batch, text_at):
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], names=names)
        coder.forget()
        pa.default_memory_pool().release_unused()

    return src.mapInArrow(run, schema)


def decode(
    docs: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded"
) -> DataFrame:
    """``docs`` with the text that the ids stand for; null ids count as none, unknown ids are
    skipped. ``out_col`` replaces a column of that name, all others are kept. Repeated rows
    stay rows of their own; an empty table gives no rows."""
    src = docs.select(*_without(docs, out_col), F.lit(None).cast("string").alias(out_col))
    names, schema = src.columns, src.schema
    ids_at = names.index(ids_col)
    spec = src.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches):
        coder = _decoder(spec.value)
        for batch in batches:
            step = max(1, batch.num_rows * OUT_IDS // max(1, len(batch.column(ids_at).flatten())))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                texts = coder.decode_lists(part.column(ids_at))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], texts], names=names)
        pa.default_memory_pool().release_unused()

    return src.mapInArrow(run, schema)


def round_trip(
    docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", out_col: str = "decoded"
) -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass: ``docs`` without the text, its ids, and the
    text that they stand for. Nulls, repeated and missing rows count as they do there.

    One Python worker a core holds the vocabulary, and lets go of it when its task ends.
    """
    src = docs.select(
        *_without(docs, ids_col, out_col),
        F.lit(None).cast("array<int>").alias(ids_col),
        F.lit(None).cast("string").alias(out_col),
    )
    names = src.columns
    text_at = names.index(text_col)
    kept = [k for k in range(len(names) - 2) if k != text_at]
    out = src.drop(text_col)
    spec = src.sparkSession.sparkContext.broadcast(read_spec(path))

    def run(batches):
        coder, decoder = _coder(spec.value), _decoder(spec.value)
        for batch in batches:
            for part, lists in _id_batches(coder, batch, text_at):
                columns = [part.column(k) for k in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, lists, decoder.decode_lists(lists)], names=[*(names[k] for k in kept), ids_col, out_col]
                )
        coder.forget()
        release_memory(_coder.cache_clear, _decoder.cache_clear)

    return src.mapInArrow(run, out.schema)
