"""The registered queries: against their SQL, or what their contract says."""

import hashlib

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from check import compare, connect
from shelfmark.llm.oracle import SQL
from shelfmark.llm.queries import QUERIES
from test_chat import expected

SF_DIR = "/root/testdata/sf0.001"


def rows_of(table):
    return duckdb.sql(f"SELECT * FROM '{SF_DIR}/{table}.parquet'").df()


def test_registered():
    assert set(entry.queries()) >= {*QUERIES, "pipeline"}
    assert set(SQL) <= set(QUERIES) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert compare(got, connect(SF_DIR).execute(SQL[name]).df()) == ""


def test_quality(spark):
    got = QUERIES["op1_cotrain_quality"](spark, SF_DIR).toPandas()
    docs, labels = rows_of("documents"), rows_of("labels")
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    both = got.merge(labels, on="doc_id")
    assert (both.kept == (both.quality == 1)).mean() > 0.97


def test_chat(spark):
    got = {r.conv_id: r for r in QUERIES["op4_chat_format"](spark, SF_DIR).collect()}
    conv = rows_of("conversations").sort_values(["conv_id", "turn"])
    want = {c: [(r, t or "") for r, t in zip(g.role, g.text)] for c, g in conv.groupby("conv_id")}
    own = "</s>[INST] ok [/INST]"
    want[-7] = [("user", own), ("assistant", own)]
    assert got.keys() == want.keys()
    for c, turns in want.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(turns)


def test_licenses(spark):
    got = {r.doc_id: r for r in QUERIES["op6_license_scan"](spark, SF_DIR).collect()}
    notices = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
    }
    for r in rows_of("documents").itertuples():
        there = sorted(name for line, name in notices.items() if line in (r.text or ""))
        names = [n for n in got[r.doc_id].names.split(",") if n]
        assert names == there


def test_bpe(spark):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.no_truncation()
    tok.no_padding()
    got = {r.doc_id: r for r in QUERIES["op9_bpe_roundtrip"](spark, SF_DIR).collect()}
    docs = rows_of("documents")
    assert got.keys() == set(docs.doc_id)
    for r in docs.itertuples():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids
        row = got[r.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        text = tok.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
