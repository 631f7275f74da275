import hashlib
import random
from collections import defaultdict

from shelfmark.llm import sharding


def brute(rows, limit):
    """Splits a bucket on the next bit while it is over the limit and has several hashes."""

    def h(i):
        return int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)

    out, todo = [], [("", [(h(i), i, len((t or "").encode())) for i, t in rows])]
    while todo:
        bits, bucket = todo.pop()
        if sum(b for *_, b in bucket) <= limit or len({x for x, *_ in bucket}) == 1:
            out += [(i, bits, b) for _, i, b in bucket]
            continue
        for bit in "01":
            part = [r for r in bucket if f"{r[0]:060b}"[len(bits)] == bit]
            if part:
                todo.append((bits + bit, part))
    return sorted(out, key=str)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sharding, "AHEAD", 1)  # several passes
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 400)) for i in range(500)] + [(None, "é"), (501, None), (502, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for limit in (300, 450, 3000, 10**6):
        got = sharding.assign_shards(df, limit).collect()
        want = brute(rows, limit)
        # what is over the limit alone keeps its bits
        assert sorted(((r.doc_id, r.shard.split(".")[0], r.n_bytes) for r in got), key=str) == want
        size = defaultdict(int)
        for r in got:
            size[r.shard] += r.n_bytes
            assert r.depth == len(r.shard.split(".")[0])
        largest = max(len(t or "") for _, t in rows)
        assert all(b <= max(limit, largest) for b in size.values())


def test_one_hot_id_is_dealt_in_parts(spark):
    rows = [(7, "a" * (i % 5 * 10)) for i in range(300)] + [(i, "b" * 50) for i in range(100, 140)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.assign_shards(df, 500).collect()
    size = defaultdict(int)
    for r in got:
        size[r.shard] += r.n_bytes
    assert len(got) == len(rows) and max(size.values()) <= 500


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, shard string")
    assert [tuple(r) for r in sharding.assign_shards(df, 10).collect()] == [(1, "", 0, 0, 1)]
    assert sharding.assign_shards(df.limit(0), 10).count() == 0
