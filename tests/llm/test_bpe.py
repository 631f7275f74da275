import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    tok.no_truncation()
    tok.no_padding()
    return tok


def odd_texts():
    rng = random.Random(9)
    signs = "ΣσςAbé'sİIi̇ \n\t́ 　ß1٣中 x'LL'Re!?\x1c\x85|#"
    pieces = ["<|endoftext|>", "<|startoftext|>", "'s", "the", "<|endof"]
    texts = ["", "a" * 3000, "ab" * 4000, "<|endoftext|>" * 3]
    for _ in range(300):
        parts = [rng.choice([rng.choice(signs), rng.choice(pieces)]) for _ in range(rng.randint(0, 40))]
        texts.append("".join(parts))
    return texts


def test_equals_library(spark, library):
    texts = odd_texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "the end", "x"), (7, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string").repartition(3)
    coded = bpe.decode(bpe.encode(df, PATH), PATH)
    assert coded.columns == ["doc_id", "text", "ids", "decoded"]
    got = coded.collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_shared_texts(spark, library):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    for r in bpe.encode(texts, PATH).collect():
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids


def test_empty_and_unknown(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, PATH), PATH).count() == 0
    ids = spark.createDataFrame([(1, [320, 10**6]), (2, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(ids, PATH).collect()}
    assert got[2] == "" and " " not in got[1]
