"""URL filter: rules first, then the ratio of two character language models."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.groups import skew_join
from shelfmark.session import durable

# Longest context in characters.
ORDER = 5
# A context counts if it was seen this often.
MIN_COUNT = 4
# Positions of URLs with the same characters that go to one part of a join.
PART_ROWS = 4096
# Log-likelihoods are added up in whole multiples of 1/UNIT, in whatever order.
UNIT = 10**12
# Scores are clipped here, and calibrated on bins of 1/1000.
CLIP = 12.0
START, END = "\x02", "\x03"


@dataclass(frozen=True)
class Rule:
    """Allow or block a host, its subdomains, and the paths that start as given."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def lower_az(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return lower_az(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


class MarkovModel:
    """Variable-order character model: each context falls back on the next shorter one.

    Witten-Bell smoothing: a context that was seen N times before T different characters
    gives T/(N+T) of its weight to the shorter context; below the empty context all
    ``alphabet`` characters are equal. A text's characters are read between a start and an
    end mark.
    """

    def __init__(self, rows: list[tuple[str, str, int]], order: int, alphabet: int = 1024):
        self.order, self.alphabet = order, alphabet
        self.counts: dict[str, dict[str, int]] = {}
        for context, char, n in rows:
            self.counts.setdefault(context, {})[char] = n
        self.total = {c: sum(v.values()) for c, v in self.counts.items()}

    def prob(self, context: str, char: str) -> float:
        p = 1.0 / self.alphabet
        for k in range(len(context) + 1):
            own = context[len(context) - k :]
            seen = self.counts.get(own)
            if seen is None:
                if k:
                    break  # longer contexts are rarer still
                continue
            n, t = self.total[own], len(seen)
            p = (seen.get(char, 0) + t * p) / (n + t)
        return p

    def log_likelihood(self, text: str) -> float:
        s = START + text + END
        return sum(
            math.log(self.prob(s[max(0, i - self.order) : i], s[i])) for i in range(1, len(s))
        )


def _transitions(urls: DataFrame, order: int) -> DataFrame:
    """cls, context, char, n over all URLs: one row per context length and position."""
    s = F.concat(F.lit(START), F.col("s"), F.lit(END))
    return (
        urls.groupBy("cls", "s")
        .agg(F.count(F.lit(1)).alias("w"))
        .select("cls", "w", s.alias("s"))
        .select("cls", "w", "s", F.explode(F.sequence(F.lit(2), F.length("s"))).alias("i"))
        .select("cls", "w", "s", "i", F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k"))
        .where("k < i")
        .groupBy(
            "cls",
            F.expr("substring(s, i - k, k)").alias("context"),
            F.expr("substring(s, i, 1)").alias("char"),
        )
        .agg(F.sum("w").alias("n"))
    )


def _counted(urls: DataFrame, marked: DataFrame, order: int) -> DataFrame:
    """Every context and character of ``urls`` (s), with what the models know of them.

    ``n0`` and ``n1``: how often the character followed in the rejected and accepted examples;
    ``all0``, ``kinds0`` and so on: characters and different characters after the context;
    ``m``: positions in ``urls``.
    """
    each = _transitions(marked.unionByName(urls.select(F.lit(2).alias("cls"), "s")), order)
    n = [F.sum(F.when(F.col("cls") == c, F.col("n")).otherwise(0)) for c in range(3)]
    pairs = each.groupBy("context", "char").agg(n[0].alias("n0"), n[1].alias("n1"), n[2].alias("m"))
    context = Window.partitionBy("context")
    known = {}
    for c in "01":
        known["all" + c] = F.sum("n" + c).over(context)
        known["kinds" + c] = F.sum((F.col("n" + c) > 0).cast("long")).over(context)
    return durable(pairs.withColumns(known).where("m > 0"))


def _gram_scores(counted: DataFrame, order: int, alphabet: int = 1024) -> DataFrame:
    """``gram`` (longest context and character), ``d`` and ``m``: log-likelihood differences.

    The models are those of :class:`MarkovModel`. Each length of context joins the next
    shorter one, whose probabilities are a table as well.
    """
    ends = None
    shorter = None
    for k in range(order + 1):
        level = counted.where(F.length("context") == k)
        if shorter is None:
            level = level.withColumns({"q0": F.lit(1.0 / alphabet), "q1": F.lit(1.0 / alphabet)})
        else:
            level = level.withColumn("rest", F.expr("substring(context, 2)")).join(shorter, ["rest", "char"])
        for c in "01":
            n, total, kinds, q = (F.col(x + c) for x in ("n", "all", "kinds", "q"))
            p = F.when(total >= MIN_COUNT, (n + kinds * q) / (total + kinds)).otherwise(q)
            level = level.withColumn("p" + c, p)
        # a URL's first characters have no longer context
        last = level if k == order else level.where(F.col("context").startswith(START))
        d = F.round((F.log("p1") - F.log("p0")) * UNIT).cast("long")
        last = last.select(F.concat("context", "char").alias("gram"), d.alias("d"), "m")
        ends = last if ends is None else ends.unionByName(last)
        shorter = level.select(
            F.col("context").alias("rest"), "char", F.col("p0").alias("q0"), F.col("p1").alias("q1")
        )
    return durable(ends)


def _url_scores(urls: DataFrame, marked: DataFrame, order: int) -> DataFrame | None:
    """s and score of distinct ``urls`` (id, s, w); None if a side has no examples.

    The score is the clipped difference of the log-likelihoods per character.
    """
    counted = _counted(urls, marked, order)
    top = counted.where("context = ''").select("all0", "all1").first()
    if top is None or min(top) < MIN_COUNT:
        return None
    grams = _gram_scores(counted, order)
    whole = F.concat(F.lit(START), F.col("s"), F.lit(END))
    positions = urls.select("id", whole.alias("s")).select(
        "id", "s", F.explode(F.sequence(F.lit(2), F.length("s"))).alias("i")
    )
    first = f"greatest(1, i - {order})"
    positions = positions.select("id", F.expr(f"substring(s, {first}, i - {first} + 1)").alias("gram"))
    sums = (
        skew_join(positions, grams.select("gram", "d"), ["gram"], counts=grams.select("gram", "m"), salt_rows=PART_ROWS)
        .groupBy("id")
        .agg((F.sum("d") / UNIT).alias("d"))
    )
    score = F.col("d") / (F.length("s") + 1)
    clipped = F.round(F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), score)), 9)
    return durable(urls.join(sums, "id").select("s", "w", clipped.alias("score")))


def calibrate(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and offset of P(accepted | score), by Newton steps on (score, accepted, n) bins."""
    a, b = 1.0, 0.0
    pos = sum(n for _, y, n in bins if y)
    neg = sum(n for _, y, n in bins if not y)
    if not pos or not neg:
        return 1.0, 0.0
    # each side weighs the same, and counts as one more URL on the other
    up, down = (pos + 1) / (pos + 2), 1 / (neg + 2)
    for _ in range(50):
        ga = gb = 0.0
        haa = hbb = 1e-3
        hab = 0.0
        for x, y, n in bins:
            w = n / (pos if y else neg)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * x + b))))
            d, h = w * (p - (up if y else down)), w * p * (1 - p)
            ga, gb = ga + d * x, gb + d
            haa, hab, hbb = haa + h * x * x, hab + h * x, hbb + h
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    order: int = ORDER,
    held_out: int = 5,
) -> DataFrame:
    """A verdict for every URL: the longest rule's, else that of two Markov models.

    The URLs that the rules allow and block are the accepted and rejected examples. Character
    counts are taken over all of them but one ``held_out``-th, on which the length-normalised
    log-likelihood difference is calibrated to a probability. A URL without a rule is allowed
    where that probability is at least 1/2.

    Returns id, ``host``, ``path``, ``rule`` (null if none), ``verdict`` (allow or block),
    ``score`` and ``p_allow``. A null or empty URL, or one without ``://``, has an empty host
    and path and fits no rule; the models judge its text (null as empty). If the rules leave
    no example of one side, score is 0, p_allow 0.5, and what has no rule is allowed. Repeated
    rows count as often as they occur; other columns are ignored.
    """
    url = F.col(url_col)
    src = pages.select(
        F.col(id_col), F.coalesce(url, F.lit("")).alias("_s"), host_of(url).alias("host"),
        path_of(url).alias("path"),
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    src = src.withColumn("rule", rule).withColumn("_said", verdict)
    marked = src.where("_said is not null").select(
        (F.col("_said") == "allow").cast("int").alias("cls"), F.col("_s").alias("s")
    )
    fold = F.pmod(F.xxhash64(F.lit("fold"), "s"), F.lit(held_out))
    urls = durable(
        src.groupBy("_s").agg(F.count(F.lit(1)).alias("w"))
        .select(F.monotonically_increasing_id().alias("id"), F.col("_s").alias("s"), "w")
    )
    scores = _url_scores(urls, marked.where(fold != 0), order)
    if scores is None:
        scored = src.withColumns({"score": F.lit(0.0), "p_allow": F.lit(0.5)})
    else:
        scored = skew_join(
            src, scores.select(F.col("s").alias("_s"), "score"), ["_s"],
            counts=scores.select(F.col("s").alias("_s"), "w"),
        )
        bins = (
            scored.where("_said is not null")
            .where(F.pmod(F.xxhash64(F.lit("fold"), "_s"), F.lit(held_out)) == 0)
            .groupBy(F.round("score", 3).alias("x"), (F.col("_said") == "allow").cast("int").alias("cls"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy("x", "cls")
            .collect()  # 2 * CLIP * 1000 bins a side at most
        )
        a, b = calibrate([(r.x, r.cls, r.n) for r in bins])
        scored = scored.withColumn(
            "p_allow", 1 / (1 + F.exp(-(F.lit(a) * F.col("score") + F.lit(b))))
        )
    judged = F.when(F.col("p_allow") >= 0.5, "allow").otherwise("block")
    return scored.withColumn("verdict", F.coalesce("_said", judged)).select(
        F.col(id_col), "host", "path", "rule", "verdict", "score", "p_allow"
    )
