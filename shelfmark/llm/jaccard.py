"""N-gram Jaccard join: adaptive multi-match prefixes over word shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from shelfmark.llm.blocks import components, lists_of, map_buckets, spare
from shelfmark.session import durable

# A broadcast list of ids may hold this many; beyond it the join shuffles.
BROADCAST_IDS = 2_000_000
# Shared tokens of a bucket that are compared at a time.
STEP_TOKENS = 4_096
# Hash lists per Arrow batch that a task sends on are about this long.
OUT_VALUES = 1_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sets of 64-bit hashes of the distinct word n-grams of texts.

    Words are runs of characters other than space and \\t to \\r, with A-Z lower-cased. A text
    of fewer than ``width`` words has its whole sequence as its only shingle; one without
    words, an empty or a null text has none.
    """

    def __init__(self, width: int, cache: int = 100_000):
        self.width, self.cache, self.words, self.older = width, cache, {}, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, dtype=np.int64)
        if len(self.words) > self.cache:
            self.words, self.older = {}, self.words
        known, older = self.words, self.older
        got = list(map(known.get, words))
        if None in got:
            for i, (g, w) in enumerate(zip(got, words, strict=True)):
                if g is None:
                    h = older.get(w)
                    got[i] = known[w] = xxhash.xxh64_intdigest(w) if h is None else h
        h = np.array(got, dtype=np.uint64)
        width = min(self.width, len(h))
        n = len(h) - width + 1
        out = np.full(n, width, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(width):
                out = _mix(out + h[i : i + n])
        out = out.view(np.int64)
        out.sort()
        return out[np.concatenate(([True], out[1:] != out[:-1]))]


def need(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any set that it links to."""
    return -(-percent * n // 100)


def _flush(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(c, type=f.type)
            for c, f in zip(columns, schema, strict=True)
        ],
        schema=schema,
    )


def _hashed(docs: DataFrame, width: int, out: str, row) -> DataFrame:
    """``row(id, set)`` of every document, a tuple of the columns of ``out``."""
    schema = to_arrow_schema(T.StructType.fromDDL(out))

    def run(batches):
        shingle, rows, held = Shingler(width), [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows.append(row(i, shingle(text.as_py())))
                held += len(rows[-1][-1]) if isinstance(rows[-1][-1], np.ndarray) else 1
                if held > OUT_VALUES:
                    yield _flush(schema, rows)
                    rows, held = [], 0
        if rows:
            yield _flush(schema, rows)
        del shingle, rows
        pa.default_memory_pool().release_unused()  # workers outlive their tasks

    return docs.mapInArrow(run, out)


def _keys(docs: DataFrame, width: int) -> DataFrame:
    """Per row: id, size of the set, digest of the set (null if empty)."""

    def row(i, s):
        return i, len(s), xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None

    return _hashed(docs, width, "id bigint, n bigint, key binary", row)


def matches(n: int, percent: int, stretch: float) -> int:
    """How many tokens of their first prefixes a set of ``n`` must share with a larger one."""
    return max(1, int(stretch * (n - need(n, percent) + 1)))


def _prefixes(docs: DataFrame, width: int, percent: int, stretch: float) -> DataFrame:
    """Per row: id and the first p + matches - 1 tokens in hash order, p the plain prefix."""

    def row(i, s):
        n = len(s)
        return i, s[: n - need(n, percent) + matches(n, percent, stretch)] if n else s

    return _hashed(docs, width, "id bigint, pre array<bigint>", row)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def row(i, s):
        return i, xxhash.xxh3_128_digest(s.tobytes()), len(s), s

    return _hashed(docs, width, "id bigint, key binary, n bigint, toks array<bigint>", row)


def _filtered(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``df`` whose id is listed, or not; the list is broadcast only while it is small."""
    ids = durable(ids.select("id").distinct())
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", how)


def _pairs_in_bucket(percent: int):
    """Candidate pairs of one bucket, each emitted in the first bucket the two share."""

    def columns(t: pa.Table):
        toks, off = lists_of(t.column("pre"))
        num = [t.column(c).to_numpy() for c in ("id", "n", "u", "ell", "pos", "comp")]
        return num, toks, off

    def run(bucket: int, left: pa.Table, right: pa.Table | None):
        (li, ln, lu, ll, lp, lc), lt, lo = columns(left)
        if right is None:
            ri, rn, ru, rl, rp, rc, rt, ro = li, ln, lu, ll, lp, lc, lt, lo
        else:
            (ri, rn, ru, rl, rp, rc), rt, ro = columns(right)
        # need of the pair, and what can still be shared from this token on
        o = -(-percent * (ln[:, None] + rn[None, :]) // (100 + percent))
        after = np.minimum((ln - lu - lp)[:, None], (rn - ru - rp)[None, :])
        ok = (
            (100 * np.minimum(ln[:, None], rn[None, :]) >= percent * np.maximum(ln[:, None], rn[None, :]))
            & (lc[:, None] != rc[None, :])
            & (after >= o)
        )
        if right is None:
            ok &= li[:, None] < ri[None, :]
        if not ok.any():
            return None
        # how many prefix tokens two members share, and how many before this one
        every = np.concatenate((lt, rt)) if right is not None else lt
        vocab, code, count = np.unique(every, return_inverse=True, return_counts=True)
        keep = count > 1
        slot = np.cumsum(keep) - 1
        width = int(keep.sum())

        def places(values, off, pos, code):
            """Shared tokens of one side by slot: slot, row, and whether before this token."""
            row = np.repeat(np.arange(len(off) - 1), np.diff(off))
            at = np.arange(len(values)) - off[:-1][row]
            use = np.flatnonzero(keep[code])
            order = use[np.argsort(slot[code[use]], kind="stable")]
            return slot[code[order]], row[order], at[order] < pos[row[order]]

        def incidence(side, rows, start):
            """Rows by the tokens of STEP_TOKENS slots, all of them and those before this one."""
            a, b = np.searchsorted(side[0], [start, start + STEP_TOKENS])
            full = np.zeros((rows, STEP_TOKENS), dtype=np.float32)
            full[side[1][a:b], side[0][a:b] - start] = 1
            head = np.zeros_like(full)
            early = side[2][a:b]
            head[side[1][a:b][early], side[0][a:b][early] - start] = 1
            return full, head

        ls = places(lt, lo, lp, code[: len(lt)])
        rs = ls if right is None else places(rt, ro, rp, code[len(lt) :])
        shared, earlier = np.zeros(ok.shape, dtype=np.float32), np.zeros(ok.shape, dtype=np.float32)
        for start in range(0, width, STEP_TOKENS):
            lf, lh = incidence(ls, len(li), start)
            rf, rh = (lf, lh) if right is None else incidence(rs, len(ri), start)
            shared += lf @ rf.T
            earlier += lh @ rh.T
        ok &= (earlier == 0) & (shared >= np.minimum(ll[:, None], rl[None, :]))
        a, b = np.nonzero(ok)
        if not len(a):
            return None
        return {"a": li[a], "b": ri[b]}

    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("toks").alias("ta"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("toks").alias("tb"))
    shared = F.size(F.array_intersect("ta", "tb"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("_i", shared)
        .where(100 * F.col("_i") >= percent * (F.col("na") + F.col("nb") - F.col("_i")))
        .select("a", "b")
    )


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    percent: int = 90,
    stretch: float = 1.0,
) -> DataFrame:
    """Groups of documents whose shingle sets have Jaccard similarity >= percent/100.

    One row per row of ``docs``: the id, ``n_shingles`` and ``component_id``, the smallest id
    reachable by links. Only the id and text columns are read, so other columns may have any
    name. Null, empty and word-less texts have no shingles and are their own component. Rows
    with a null id get a null component. Repeated rows are classed like any copy; rows that
    share an id are one node. An empty table gives no rows.

    Method (all exact):

    1. Equal sets are one class, named by its smallest id; all else runs on classes.
    2. In hash order each class sends its first p + m - 1 tokens, p the plain prefix length and
       m = ``stretch`` * p. Two classes that link share at least the smaller one's m of them; a
       class with fewer of its tokens in any other class has no link. ``stretch`` only trades
       the length of these prefixes for what goes on to the next step.
    3. Of the rest, tokens are ordered rare first by their exact counts; tokens of one class
       only lead the order and never become keys. Each class lengthens its prefix by ``ell`` - 1
       tokens, more where its keys lead to many candidates, and a pair must then share the
       smaller ``ell`` of the two. Pairs also fall to the length and position bounds.
    4. First each class is verified against the most central class it shares a key with, which
       is linear. Only candidate pairs that are still in different components go on; each is
       emitted in the first bucket the two share and verified on whole sets.

    Hot keys are dealt in blocks (:func:`blocks.map_buckets`); nothing is capped.
    """
    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    base = durable(_keys(src, width))
    sized = base.where("n > 0 and id is not null")
    classes = durable(sized.groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n")))
    # 2. hash order; what is read are the rows that stand for a class
    copies = (
        sized.join(classes.select("key", F.col("id").alias("rep")), "key")
        .where("id <> rep")
        .select("id")
        .join(classes.select("id"), "id", "left_anti")
    )
    readable = src.dropna(subset=["id"])
    firsts = durable(_prefixes(_filtered(readable, copies, "left_anti"), width, percent, stretch))
    tokens = firsts.select("id", F.explode("pre").alias("tok"))
    shared = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("tok")
    hits = tokens.join(shared, "tok", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("hits"))
    least = F.expr(f"(n * {percent} + 99) div 100")
    smaller = F.expr(f"(least * {percent} + 99) div 100")
    wanted = F.greatest(F.lit(1), F.floor(F.lit(stretch) * (F.col("least") - smaller + 1)))
    live = durable(
        classes.select("key", "id", least.alias("least"))
        .join(hits, "id")
        .where(F.col("hits") >= wanted)
        .select("key", "id")
    )
    # 3. rare first
    fresh = _sets(_filtered(readable, live, "left_semi"), width)
    sets = durable(
        fresh.join(live, ["key", "id"], "left_semi")
        .groupBy("key")
        .agg(F.first("id").alias("id"), F.first("n").alias("n"), F.first("toks").alias("toks"))
    )
    tokens = sets.select("key", F.explode("toks").alias("tok"))
    counts = tokens.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ranked = (
        tokens.join(counts, "tok")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("t"))
    )
    spread = F.aggregate(
        F.slice("t", F.lit(1), F.col("plain")), F.lit(0).cast("bigint"), lambda s, x: s + x["df"] - 1
    )
    longer = F.least(F.col("p"), F.ceil(F.log2(F.col("cost") + 1)).cast("bigint"))
    front = F.slice("t", F.lit(1), (F.col("plain") + F.col("ell") - 1).cast("int"))
    lists = durable(
        sets.select("key", "id", "n")
        .join(ranked, "key")
        .withColumn("u", F.col("n") - F.size("t"))
        .withColumn("p", F.expr(f"n - (n * {percent} + 99) div 100 + 1"))
        .withColumn("plain", (F.col("p") - F.col("u")).cast("int"))
        .where("plain > 0")
        .withColumn("cost", spread)
        .withColumn("ell", F.greatest(F.lit(1).cast("bigint"), longer))
        .withColumn("pre", F.transform(front, lambda x: x["tok"]))
        .select("key", "id", "n", "u", "ell", "plain", "pre")
    )
    keys = lists.select(
        "key", "id", "u", F.posexplode(F.slice("pre", F.lit(1), F.col("plain"))).alias("pos", "tok")
    )
    # 4. one central partner each, then what is still apart
    hub = keys.groupBy("tok").agg(F.min(F.struct("u", "id")).alias("hub"))
    first = (
        keys.join(hub, "tok")
        .where("hub.id <> id")
        .groupBy("id")
        .agg(F.min("hub").alias("hub"))
        .select(F.col("id").alias("a"), F.col("hub.id").alias("b"))
    )
    near = durable(_verify(first, sets, percent))
    members = durable(
        keys.select("key", F.col("pos").cast("bigint").alias("pos"), "tok")
        .join(lists.select("key", "id"), "key")
        .join(components(near).withColumnRenamed("node", "id"), "id", "left")
        .withColumn("comp", F.coalesce("comp", "id"))
    )
    # buckets that lie within one component are done
    apart = members.groupBy("tok").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
    rows = members.join(apart.where("x < y").select("tok"), "tok", "left_semi").select("tok", "key", "id", "pos", "comp")
    wide = lists.select("key", "id", "n", "u", "ell", "pre")
    pairs = map_buckets(rows, "tok", "id", _pairs_in_bucket(percent), "a bigint, b bigint", payload=wide)
    links = _verify(durable(pairs), sets, percent)
    # an id with several texts ties their classes together
    several = sized.groupBy("id").agg(F.min("key").alias("x"), F.max("key").alias("y"))
    ties = (
        sized.select("id", "key")
        .join(several.where("x <> y").select("id"), "id", "left_semi")
        .join(classes.select("key", F.col("id").alias("b")), "key")
        .select(F.col("id").alias("a"), "b")
    )
    found = components(near.union(links).union(ties))
    labels = (
        classes.select("key", "id")
        .join(found.withColumnRenamed("node", "id"), "id", "left")
        .select("key", F.coalesce("comp", "id").alias("comp"))
    )
    comp = F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("id"))
    return (
        base.select("id", "n", "key")
        .join(labels, "key", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), comp).alias("component_id"),
        )
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """``docs`` with one document of each group of :func:`jaccard_components`: the smallest id.

    All columns are kept. Of rows that share that id one stays, whichever sorts first by text.
    Texts without words and rows with a null id belong to no group and all stay.
    """
    found = durable(jaccard_components(docs, id_col, text_col, **options))
    lost = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("id"))
    lost = durable(lost.distinct())
    key = F.col(id_col).cast("bigint")
    gone = F.broadcast(lost) if lost.count() <= BROADCAST_IDS else lost
    kept = docs.join(gone, key == gone["id"], "left_anti")
    worded = found.where("n_shingles > 0 and component_id is not null")
    again = durable(worded.groupBy(F.col(id_col).alias("id")).count().where("count > 1").select("id"))
    if not again.head(1):
        return kept
    single = kept.join(again, key == again["id"], "left_anti")
    (place,) = spare(docs.columns, "place")
    one = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_last())
    several = (
        kept.join(again, key == again["id"], "left_semi")
        .withColumn(place, F.row_number().over(one))
        .where(F.col(place) == 1)
        .drop(place)
    )
    return single.unionByName(several)
