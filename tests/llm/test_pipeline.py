import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import fmindex
from test_jaccard import brute, shingles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage over the one before, written and read again."""
    out = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    top = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SMALL).write.parquet(f"{top}/{name}")
        out.append(spark.read.parquet(f"{top}/{name}"))
    return out


def test_columns_and_rows(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminated", "tokens"]
    for s in stages[:-1]:
        assert s.columns == COLUMNS
    counts = [s.count() for s in stages]
    assert counts[0] > counts[1] > counts[2] == counts[3] == counts[4]
    got = corpus_pipeline.run(spark, SMALL)
    assert got.count() == counts[-1]


def test_quality_keeps_good_documents(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    kept = stages[1].select("doc_id", F.lit(1).alias("kept"))
    got = labels.join(kept, "doc_id", "left").groupBy("quality").agg(F.avg(F.coalesce("kept", F.lit(0))).alias("share"))
    share = {r.quality: r.share for r in got.collect()}
    assert share[1] > 0.97 and share[0] < 0.1


def test_near_duplicates_equal_brute_force(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    comp = brute(rows, 5, 80)
    want = {i for i, t in rows if comp[i] == i or not shingles(t, 5)}
    assert {r.doc_id for r in stages[2].collect()} == want


def test_decontaminated(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    phrases = fmindex.Phrases(items, 10)
    before = {r.doc_id: r for r in stages[2].collect()}
    cut = 0
    for r in stages[3].collect():
        words = [w.decode("utf-8", "surrogatepass") for w in fmindex.words_of(before[r.doc_id].text)]
        ((spans, _),) = fmindex.scan_shard([" ".join(words).encode()], phrases)
        left = [w for i, w in enumerate(words) if not any(a <= i < b for a, b in spans)]
        assert [w.decode() for w in fmindex.words_of(r.text)] == left
        cut += bool(spans)
        if spans:
            assert r.n_chars == len(r.text)
        else:
            assert (r.text, r.n_chars) == (before[r.doc_id].text, before[r.doc_id].n_chars)
    assert cut


def test_tokens_equal_library(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in stages[3].collect()}
    for r in stages[4].collect():
        assert r.ids == tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.decoded == tok.decode(r.ids, skip_special_tokens=False)


def test_odd_rows_pass_all_stages(spark):
    rng = random.Random(1)
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, None, "en", "s", None)]
    rows += [(i, " ".join(rng.choices("abcdef", k=50)), "en", "s", 99) for i in range(3, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        docs = stage(spark, docs, SMALL)
    docs.collect()
