import hashlib
import random

import public_tokenizers

from shelfmark.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_escape_is_reversible():
    t = chat.Template()
    rng = random.Random(1)
    bits = ["<", "\\", "|im_end|>", "<|im_end|>", "</s>", "[INST]", "[", "s>", "/s>", "<<SYS>>", "x", "\\[INST]"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 8)))
        safe = t.escape(text)
        assert t.unescape(safe) == text
        assert not any(c in safe for c in (t.start, t.sep, t.end, *t.others))
        role = "".join(rng.choices(bits, k=2))
        formatted, spans = t.render([(role, text), ("assistant", text)])
        assert [(r, x, (a, b)) for r, x, a, b in t.parse(formatted)] == [
            (role, text, spans[0]), ("assistant", text, spans[1])
        ]


def expected(turns):
    said = "".join(x for r, x in turns if r == "assistant")
    whole = "".join(f"{r}\n{x}\n" for r, x in turns)
    return (
        len(turns),
        hashlib.sha256(whole.encode()).hexdigest(),
        len(said),
        hashlib.sha256(said.encode()).hexdigest(),
    )


def test_reads_back_what_went_in(spark):
    rng = random.Random(2)
    signs = ["word ", "  ", "\n", "é", "中文", "👍🏽", " ", "</s>", "<|endoftext|>", "[/INST]", "é", "\\", "a" * 40]
    convs = {}
    for c in range(60):
        roles = rng.choices(["user", "assistant", "system", "tool <|im_sep|>\n"], k=rng.randint(1, 9))
        convs[c] = [(r, "".join(rng.choices(signs, k=rng.randint(0, 25)))) for r in roles]
    rows = [(c, t, r, x, "n") for c, turns in convs.items() for t, (r, x) in enumerate(turns)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string")
    out = chat.format_conversations(df.repartition(7), PATH)
    got = {r.conv_id: r for r in chat.read_back(out).collect()}
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(turns)
        assert r.formatted_chars == len(chat.Template().render(turns)[0])
    for r in out.collect():
        t = chat.Template()
        learnt = [(a, b) for role, _, a, b in t.parse(r.formatted) if role == "assistant" and b > a]
        want = [any(s < b and e > a for a, b in learnt) for s, e in zip(r.starts, r.ends, strict=True)]
        assert r["mask"] == want


def test_nulls_ties_repeats_and_empty(spark):
    rows = [
        (1, 1, "assistant", None), (1, None, None, "first"), (1, 2, "user", "b"), (1, 2, "user", "a"),
        (1, 2, "user", "a"), (None, 0, "user", "lost"), (2, 0, "assistant", "x" * 200_000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df, PATH)).collect()}
    assert got.keys() == {1, 2}
    want = [("", "first"), ("assistant", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert got[1][1:5] == expected(want)
    assert got[2].loss_chars == 200_000
    assert chat.format_conversations(df.limit(0), PATH).count() == 0
