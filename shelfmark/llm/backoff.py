"""Stupid-backoff language-model scores of documents against all other documents."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import sorted_groups

# Characters of text in one block of documents; a block's n-grams are held by one task.
BLOCK_CHARS = 9 << 20
# Distinct words whose hashes a task remembers; beyond it the memory starts anew.
WORDS = 200_000
# N-grams of one partition of the count tables, about.
PART_GRAMS = 1_500_000


def _word_hashes(text: str | None, known: dict) -> np.ndarray:
    if len(known) > WORDS:
        known.clear()
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    got = list(map(known.get, words))
    if None in got:
        for i, (g, w) in enumerate(zip(got, words, strict=True)):
            if g is None:
                got[i] = known[w] = xxhash.xxh64_intdigest(w)
    return np.array(got, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def grams_of(words: np.ndarray, starts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that end at each word, and whether the document has them.

    ``starts`` has for each word the position at which its document starts.
    """
    n = len(words)
    if order == 1:
        return _mix(words), np.ones(n, dtype=bool)
    out = np.zeros(n, dtype=np.uint64)
    ok = np.arange(n) - starts >= order - 1
    if n >= order:
        h = _mix(words[: n - order + 1])
        for k in range(1, order):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : n - order + 1 + k])
        out[order - 1 :] = h
    return out, ok


def _planes(values: np.ndarray) -> bytes:
    """Integers byte by byte, all lowest bytes first, which packs well; compressed."""
    width = values.dtype.itemsize
    return pa.compress(values.view(np.uint8).reshape(-1, width).T.tobytes(), "zstd", asbytes=True)


def _values(raw: bytes, dtype, n: int) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = pa.decompress(raw, n * width, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def _packed(docs: DataFrame) -> DataFrame:
    """The documents of each batch and block as one compressed Arrow stream: block, docs."""

    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            blocks = batch.column(2).to_numpy()
            for block in np.unique(blocks):
                part = batch.select(["id", "text"]).filter(pa.array(blocks == block))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                    out.write_batch(part)
                raw = sink.getvalue().to_pybytes()
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "docs": [raw]})

    return docs.mapInArrow(run, "block int, docs binary")


def _unpacked(table: pa.Table) -> pa.Table:
    parts = [pa.ipc.open_stream(raw.as_buffer()).read_all() for raw in table.column("docs")]
    return pa.concat_tables(parts)


def _words_of_block(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    known: dict[bytes, int] = {}
    each = [_word_hashes(t.as_py(), known) for t in texts]
    sizes = np.array([len(e) for e in each], dtype=np.int64)
    words = np.concatenate(each) if each else np.empty(0, np.uint64)
    first = np.cumsum(sizes) - sizes
    return words, np.repeat(first, sizes), sizes


def _pieces(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, start, end) of the ranges of hashes, of ``parts`` equal ones, that sorted keys have.

    Only ranges with keys are named, so a block of few n-grams has few pieces however many
    parts there are.
    """
    out, start = [], 0
    while start < len(keys):
        part = int(keys[start]) * parts >> 64
        end = len(keys)
        if part + 1 < parts:
            # the first hash of the next range
            bound = -(-((part + 1) << 64) // parts)
            end = int(np.searchsorted(keys, np.uint64(bound)))
        out.append((part, start, end))
        start = end
    return out


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = 3,
    alpha: float = 0.4,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Mean log score per word of each document under the n-gram counts of all the others.

    Words are runs of characters other than space and \\t to \\r, A-Z lower-cased. The score
    of a word after its context is count(n-gram) / count(context) if the n-gram occurs in
    another document, else ``alpha`` times the score with the context shortened by its first
    word; a word alone has count / N, and a word that no other document holds has
    ``alpha`` / N. Counts and N leave the scored document's own words out, N is 1 at least.
    Contexts don't reach over the start of a document.

    One row per row of ``docs``: id, ``n_words``, ``log_score`` (null without words). Null and
    empty texts have no words; repeated rows are documents of their own; null ids are kept;
    other columns are ignored; an empty table gives no rows. ``docs`` is read several times, and
    its rows must come in the same order each time: hand in a scan or a durable table.

    Documents are dealt into blocks of about ``block_chars``. A block sends its distinct
    n-grams, with counts, to count tables that are partitioned by hash, each cut sorted; every
    partition adds up all blocks and sends the counts back, where they join the block's
    exploded n-grams and are summed per document. So an n-gram travels once per block, not
    once per document, and the most frequent one has no more rows than there are blocks.
    """
    size = docs.agg(F.sum(F.length(text_col)).alias("chars")).first().chars or 0
    blocks = max(1, math.ceil(size / block_chars))
    parts = max(1, math.ceil(size * order / 6 / PART_GRAMS))
    dealt = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        # the place of a row in its file, so that repeated rows are dealt like any others
        F.pmod(F.xxhash64(id_col, text_col, F.monotonically_increasing_id()), F.lit(blocks))
        .cast("int")
        .alias("block"),
    )
    dealt = _packed(dealt).repartition(blocks, "block")
    gram_schema = pa.schema(
        [("part", pa.int32()), ("n", pa.int32()), ("block", pa.int32()), ("size", pa.int32()),
         ("grams", pa.binary()), ("counts", pa.binary())]
    )

    def send(key, table):
        block = key[0].as_py()
        words, starts, _ = _words_of_block(_unpacked(table).column("text"))
        rows = []
        for n in range(1, order + 1):
            grams, ok = grams_of(words, starts, n)
            grams, counts = np.unique(grams[ok], return_counts=True)
            for p, a, b in _pieces(grams, parts):
                step = np.diff(grams[a:b], prepend=np.uint64(0))
                rows.append((p, n, block, b - a, _planes(step), _planes(counts[a:b].astype(np.uint32))))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        return pa.Table.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, gram_schema, strict=True)],
            schema=gram_schema,
        )

    def add_up(batches):
        for (part, n), table in sorted_groups(batches, ["part", "n"]):
            sizes = table.column("size").to_pylist()
            whole = [
                np.cumsum(_values(g.as_py(), np.uint64, k), dtype=np.uint64)
                for g, k in zip(table.column("grams"), sizes, strict=True)
            ]
            own = [
                _values(c.as_py(), np.uint32, k).astype(np.int64)
                for c, k in zip(table.column("counts"), sizes, strict=True)
            ]
            keys, place = np.unique(np.concatenate(whole), return_inverse=True)
            total = np.bincount(place, weights=np.concatenate(own), minlength=len(keys)).astype(np.int64)
            at = 0
            for block, w, c in zip(table.column("block").to_pylist(), whole, own, strict=True):
                others = (total[place[at : at + len(w)]] - c).astype(np.uint64)
                at += len(w)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([block], pa.int32()),
                        "part": pa.array([int(part)], pa.int32()),
                        "n": pa.array([int(n)], pa.int32()),
                        "size": pa.array([len(w)], pa.int32()),
                        "others": pa.array([_planes(others)], pa.binary()),
                    }
                )

    def score(key, table, got):
        docs_here = _unpacked(table)
        words, starts, sizes = _words_of_block(docs_here.column("text"))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        others = {
            (n, p): (o.as_py(), k)
            for n, p, k, o in zip(*(got[c].to_pylist() for c in ("n", "part", "size")), got["others"], strict=True)
        }
        mean = np.full(len(sizes), np.nan)
        if len(words):
            seen, context = [], [_leave_out_total(sizes, corpus_words)[doc]]
            for n in range(1, order + 1):
                grams, ok = grams_of(words, starts, n)
                keys, place, counts = np.unique(grams[ok], return_inverse=True, return_counts=True)
                rest = [_values(others[n, p][0], np.uint64, others[n, p][1]) for p, _, _ in _pieces(keys, parts)]
                total = np.concatenate([np.empty(0, np.uint64), *rest]).astype(np.int64) + counts
                # less the document's own: each (document, n-gram) counted
                place += doc[ok] * np.int64(len(keys))
                pairs, slot, own = np.unique(place, return_inverse=True, return_counts=True)
                rest = total[pairs % len(keys)] - own if len(pairs) else own
                left = np.zeros(len(words), dtype=np.int64)
                left[ok] = rest[slot]
                del grams, keys, counts, place, pairs, slot, own, rest, total
                seen.append(left)
                # the count of a word's context: the n-gram that ends one word before
                context.append(np.concatenate(([0], left[:-1])))
            value = np.full(len(words), math.log(alpha)) - np.log(context[0])
            value = np.where(seen[0] > 0, np.log(np.maximum(seen[0], 1)) - np.log(context[0]), value)
            for n in range(2, order + 1):
                ok = np.arange(len(words)) - starts >= n - 1
                hit = ok & (seen[n - 1] > 0)
                full = np.log(np.maximum(seen[n - 1], 1)) - np.log(np.maximum(context[n - 1], 1))
                value = np.where(hit, full, np.where(ok, value + math.log(alpha), value))
            full = np.bincount(doc, weights=value, minlength=len(sizes))
            mean = np.divide(full, sizes, out=mean, where=sizes > 0)
        return pa.Table.from_arrays(
            [docs_here.column("id"), pa.array(sizes), pa.array(mean, mask=sizes == 0)],
            names=["id", "n_words", "log_score"],
        )

    grams = dealt.groupBy("block").applyInArrow(
        send, "part int, n int, block int, size int, grams binary, counts binary"
    )
    back = (
        grams.repartition("part", "n")
        .sortWithinPartitions("part", "n", "block")
        .mapInArrow(add_up, "block int, part int, n int, size int, others binary")
    )
    corpus_words = _corpus_words(docs, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    scored = (
        dealt.groupBy("block")
        .cogroup(back.groupBy("block"))
        .applyInArrow(score, f"id {kind}, n_words bigint, log_score double")
    )
    return scored.withColumnRenamed("id", id_col)


def _corpus_words(docs: DataFrame, text_col: str) -> int:
    space = "[\\u0020\\u0009-\\u000D]+"
    trimmed = F.regexp_replace(F.col(text_col), f"^{space}|{space}$", "")
    words = F.when(F.length(trimmed) > 0, F.size(F.split(trimmed, space))).otherwise(0)
    return docs.agg(F.sum(words).alias("n")).first().n or 0


def _leave_out_total(sizes: np.ndarray, corpus_words: int) -> np.ndarray:
    return np.maximum(corpus_words - sizes, 1).astype(np.float64)
