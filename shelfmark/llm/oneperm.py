"""Document fingerprints: one-permutation MinHash, packed low-order bits.

Column expressions only: no Python worker takes part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import spare
from shelfmark.operators.groups import SALT_ROWS
from shelfmark.operators.rank import global_rank
from shelfmark.session import durable

WIDTH = 5
# Bins of one fingerprint (a power of two), and bits kept of each bin's smallest hash.
BINS, BITS = 512, 4
# Donor bins that an empty bin tries before it takes the first one in its own order of all.
PROBES = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "[ \\x09-\\x0D]+"
_BIN_BITS = BINS.bit_length() - 1
_LOW = 64 - _BIN_BITS
_NIBBLES = 0x1111111111111111


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """One 64-bit hash per run of ``width`` words; a shorter text is one run, an empty one none.

    Words are what lies between blanks and control blanks, with A-Z lower-cased.
    """
    words = F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BLANKS), "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return _let(
        hashed,
        lambda ws: F.when(F.size(ws) == 0, F.array().cast("array<bigint>"))
        .when(F.size(ws) < width, F.array(F.xxhash64(ws)))
        .otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(ws) - (width - 1), F.lit(1))),
                lambda i: F.xxhash64(F.slice(ws, i, F.lit(width))),
            )
        ),
    )


def _bin_of(h: Column) -> Column:
    return F.shiftright(h, _LOW) + BINS // 2


def bin_minima(hashes: Column) -> Column:
    """Smallest hash of every bin in bin order, null for an empty bin; each hash is looked at once.

    A bin is the upper bits of a hash. Every bin gets one mark that sorts behind its hashes,
    so the first entry of each bin in the sorted array is its minimum, or its mark.
    """
    marks = F.transform(
        F.sequence(F.lit(1 - BINS // 2), F.lit(BINS // 2)),
        # the mark of the last bin would be 2 ** 63
        lambda b: F.when(b == BINS // 2, F.lit(2**63 - 1)).otherwise(
            F.shiftleft(b.cast("bigint"), _LOW) - 1
        ),
    )
    ordered = F.sort_array(F.concat(hashes, marks))
    # the entry before, aligned by one place; what stands before the first is of no bin here
    firsts = _let(
        ordered,
        lambda s: F.filter(
            s, lambda h, i: (i == 0) | (F.shiftright(h, _LOW) != F.shiftright(F.get(s, i - 1), _LOW))
        ),
    )
    low = F.lit((1 << _LOW) - 1)
    return F.transform(firsts, lambda h: F.when(h.bitwiseAND(low) != low, h))


def _probe(minima: Column, j: Column, attempt: int) -> Column:
    return F.get(minima, F.xxhash64(j, F.lit(attempt)).bitwiseAND(F.lit(BINS - 1)).cast("int"))


def densified(minima: Column) -> Column:
    """The kept bits of every bin; an empty bin borrows from one chosen by hash (all bins or none).

    Optimal densification: bin j tries the bins that its own sequence of hashes names until
    one is filled in. After ``PROBES`` tries it orders all filled bins by a hash of its own
    and takes the first, which is what endless tries would come to. What is borrowed is
    hashed with j, so that several bins may borrow from one without agreeing by chance at once.
    """

    def fill(full: Column) -> Column:
        filled = F.filter(
            F.transform(full, lambda h: F.when(h.isNotNull(), _bin_of(h).cast("bigint"))),
            lambda b: b.isNotNull(),
        )

        def one(filled: Column) -> Column:
            def value(h: Column, j: Column) -> Column:
                order = F.transform(
                    filled, lambda b: F.xxhash64(j, b).bitwiseAND(F.lit(-BINS)).bitwiseOR(b)
                )
                last = F.get(full, F.array_min(order).bitwiseAND(F.lit(BINS - 1)).cast("int"))
                donor = F.coalesce(*[_probe(full, j, t) for t in range(1, PROBES + 1)], last)
                own = F.coalesce(h, F.when(h.isNull(), F.xxhash64(donor, j)))
                return own.bitwiseAND(F.lit((1 << BITS) - 1))

            return F.when(F.size(filled) == 0, F.array().cast("array<bigint>")).otherwise(
                F.transform(full, value)
            )

        return _let(filled, one)

    return _let(minima, fill)


def packed(values: Column) -> Column:
    """Sixteen bins of four bits to a 64-bit word; no bins, no words."""
    per_word = 64 // BITS
    return _let(
        values,
        lambda v: F.when(F.size(v) == 0, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.lit(BINS // per_word - 1)),
                lambda g: F.aggregate(
                    F.slice(v, g * per_word + 1, F.lit(per_word)),
                    F.lit(0).cast("bigint"),
                    lambda acc, x: F.shiftleft(acc, BITS).bitwiseOR(x),
                ),
            )
        ),
    )


def fingerprint(text: Column) -> Column:
    """Packed fingerprint of a whole text (``array<bigint>``); empty for a text without words."""
    return packed(densified(bin_minima(shingle_hashes(text))))


def as_hex(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda p: F.lpad(F.hex(p), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts by their fingerprints, 0 to 1.

    The share of bins that agree, less the agreement that ``BITS`` bits have by chance. Two
    texts without words are alike; one with and one without words are not at all.
    """
    per_word = 64 // BITS

    def agreeing(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for shift in (2, 1):  # any differing bit of a bin ends up in its lowest
            d = d.bitwiseOR(F.shiftrightunsigned(d, shift))
        return per_word - F.bit_count(d.bitwiseAND(F.lit(_NIBBLES)))

    agree = F.aggregate(F.zip_with(a, b, agreeing), F.lit(0), lambda s, n: s + n)
    chance = 2.0**-BITS
    share = (agree / BINS - chance) / (1 - chance)
    return (
        F.when(a.isNull() | b.isNull(), None)
        .when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(F.greatest(F.lit(0.0), share))
    )


def fingerprint_documents(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` and the packed fingerprint of each whole text; nothing is shuffled.

    Null texts count as empty, and texts without words have an empty fingerprint. Texts of
    fewer than five words are one shingle. Equal texts have equal fingerprints. A column that
    is already called like ``out`` is replaced; rows and other columns stay as they are.
    """
    return docs.withColumn(out, fingerprint(F.col(f"`{text_col}`")))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              salt_rows: int = SALT_ROWS) -> DataFrame:
    """Every document, its fingerprint, and the head and fingerprint of the one that follows.

    Documents follow one another by descending id, and the first follows the last. Documents
    that share an id have the same follower: the document of the next smaller id, of several
    the one with the smallest text hash. Rows with a null id follow and precede none: their
    ``next_head`` and ``next_print`` are null. An empty table gives no rows. Columns: id,
    text (null as empty), n_chars, print, next_head (as long as a third of the own text, where
    the follower has as much), next_print.

    Order is found on ids alone, by ranges. Texts are shuffled once, by id and text hash; from
    there each sends on only the head that its predecessor needs. A row repeated more than
    ``salt_rows`` times is dealt into parts.
    """
    i, t = F.col(f"`{id_col}`").cast("bigint"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    src = docs.select(i.alias("id"), t.alias("text"), F.xxhash64(t).alias("h"))
    chars = F.char_length("text").cast("bigint").alias("n_chars")
    prints = durable(src.select("id", "h", chars, fingerprint(F.col("text")).alias("print")))
    known = prints.where("id is not null")
    texts = durable(
        known.groupBy("id", "h").agg(
            F.count(F.lit(1)).alias("n"), F.first("n_chars").alias("n_chars"), F.first("print").alias("print")
        )
    )
    ids = texts.groupBy("id").agg(F.min("h").alias("h"))
    placed = durable(global_rank(ids, [F.col("id").desc()], "pos"))
    total = placed.agg(F.coalesce(F.max("pos"), F.lit(1)).alias("n")).first().n
    # follower (id, h, its print) and each text before it (prev_id, prev_h, characters it takes);
    # a repeated text is dealt into parts, of which the first is enough as a follower
    before = placed.select(F.col("id").alias("prev_id"), (F.col("pos") % total + 1).alias("pos"))
    tags = durable(
        before.join(placed, "pos")
        .join(texts.select("id", "h", F.col("print").alias("next_print")), ["id", "h"])
        .join(
            texts.select(
                F.col("id").alias("prev_id"), F.col("h").alias("prev_h"),
                F.floor(F.col("n_chars") / 3).cast("int").alias("need"),
            ),
            "prev_id",
        )
        .select("id", "h", "next_print", "prev_id", "prev_h", "need")
    )
    parts = F.ceil(F.col("n") / F.lit(salt_rows)).cast("int")
    heavy = durable(texts.where(F.col("n") > salt_rows).select("id", "h", parts.alias("parts")))
    rows, first, keys = src.where("id is not null"), tags, ["id", "h"]
    if not heavy.isEmpty():
        keys = ["id", "h", "part"]
        dealt = F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1))).cast("int")
        rows = rows.withColumn("row", F.monotonically_increasing_id())
        rows = rows.join(heavy, ["id", "h"], "left").select("id", "h", "text", dealt.alias("part"))
        first = tags.withColumn("part", F.lit(0))
    moved = rows.repartition(*keys)
    followers = (
        moved.join(first.drop("next_print"), keys)
        .select(F.col("prev_id").alias("id"), F.col("prev_h").alias("h"), F.expr("left(text, need)").alias("head"))
        .groupBy("id", "h")
        .agg(F.first("head").alias("next_head"))
    )
    partners = followers.join(
        tags.select(F.col("prev_id").alias("id"), F.col("prev_h").alias("h"), "next_print"), ["id", "h"]
    ).join(texts.drop("n"), ["id", "h"])
    if not heavy.isEmpty():
        every = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
        partners = partners.join(heavy, ["id", "h"], "left").withColumn("part", F.explode(every)).drop("parts")
    out = ["id", "text", "n_chars", "print", "next_head", "next_print"]
    own = moved.join(partners, keys).select(*out)
    lost = src.where("id is null").select(
        "id", "text", chars, fingerprint(F.col("text")).alias("print"),
        F.lit(None).cast("string").alias("next_head"),
        F.lit(None).cast("array<bigint>").alias("next_print"),
    )
    return own.union(lost)
