import itertools
import random

from shelfmark.llm import patience


def test_longest_increasing():
    rng = random.Random(1)
    for _ in range(200):
        v = rng.sample(range(9), rng.randint(0, 8))
        got = patience.longest_increasing(v)
        assert [v[i] for i in got] == sorted(v[i] for i in got) and got == sorted(got)
        best = max(
            (len(c) for k in range(len(v) + 1) for c in itertools.combinations(v, k) if list(c) == sorted(c)),
            default=0,
        )
        assert len(got) == best


def test_alignment_is_increasing_and_finds_what_is_there():
    rng = random.Random(2)
    for _ in range(300):
        template = [b"%d" % rng.randrange(12) for _ in range(rng.randint(1, 12))]
        text = [b"%d" % rng.randrange(12) for _ in range(rng.randint(0, 30))]
        pairs = patience.align(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(a < b and c < d for (a, c), (b, d) in zip(pairs, pairs[1:]))
        assert len(patience.align(template, template)) == len(template)


def test_notices_in_whole_texts(spark):
    rng = random.Random(3)
    vocab = ["licensed", "under", "the", "version", "work", "is", "general", "public", *[f"w{i}" for i in range(40)]]
    rows, want = [], {}
    for i in range(60):
        words = rng.choices(vocab, k=rng.randint(0, 300))
        names = rng.sample(["MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0"], rng.choice([0, 0, 1, 2]))
        text = " ".join(words)
        for n in names:
            notice = patience.TEMPLATES[n]
            text = rng.choice([f"{notice}\n{text}", f"{text}\n{notice}", f"{text} {notice} {text} {notice}"])
        rows.append((i, text))
        want[i] = sorted(names)
    got = {r.doc_id: r.licenses for r in patience.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, names in want.items():
        full = [x.name for x in got[i] if x.coverage == 1.0]
        assert set(names) <= set(full), (i, names, got[i])
        if not names:
            assert full == []
        words = patience.words_of(rows[i][1])
        for x in got[i]:
            if x.coverage == 1.0 and x.end - x.first == len(patience.words_of(patience.TEMPLATES[x.name])):
                assert words[x.first : x.end] == patience.words_of(patience.TEMPLATES[x.name])


def test_odd_rows(spark):
    mit = patience.TEMPLATES["MIT"]
    rows = [(1, None, "n"), (2, "", "n"), (None, mit, "n"), (3, mit, "n"), (3, mit, "n"), (4, "word " * 50000 + mit, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, licenses string")
    got = patience.scan_licenses(df).collect()
    assert sorted((str(r.doc_id), len(r.licenses)) for r in got) == [
        ("1", 0), ("2", 0), ("3", 1), ("3", 1), ("4", 1), ("None", 1)
    ]
    assert patience.scan_licenses(df.limit(0)).count() == 0


def test_versions_are_told_apart():
    scanner = patience.Scanner(patience.TEMPLATES, 0.9)
    two, three = patience.TEMPLATES["GPL-2.0"], patience.TEMPLATES["GPL-3.0"]
    names = lambda text: sorted(f[0] for f in scanner.scan(text))
    assert names(f"a b {two} c") == ["GPL-2.0"]
    assert names(f"a b {three} c") == ["GPL-3.0"]
    assert names(f"{three} filler {two}") == ["GPL-2.0", "GPL-3.0"]
    assert names(three.replace("GNU ", "")) == ["GPL-3.0"]
    # neither version is named
    assert names(three.replace("3", "9")) == []


def test_licenses_of_the_larger_shared_table(spark):
    from shelfmark.llm.queries import QUERIES

    d = "/root/testdata/sf0.01"
    notices = {n: patience.TEMPLATES[n] for n in ("Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0", "MIT")}
    got = {r.doc_id: r.names for r in QUERIES["op6_license_scan"](spark, d).collect()}
    texts = spark.read.parquet(f"{d}/documents.parquet").collect()
    want = {r.doc_id: ",".join(n for n, line in notices.items() if line in (r.text or "")) for r in texts}
    assert any("GPL-3.0" in names for names in want.values())
    assert got == want


def test_copies_that_lack_any_one_word():
    """Whatever word a copy lacks, and wherever else that word stands, it is found as by brute force."""
    template = "this work is licensed under the gnu general public license version three"
    long = " ".join(f"t{i}" for i in range(20))
    for text in (template, long):
        words = text.split()
        scanner = patience.Scanner({"T": text}, 0.9)
        for k, word in enumerate(words):
            less = " ".join(words[:k] + words[k + 1 :])
            for gap in (3, 500):
                filler = " ".join(["x"] * gap)
                whole = f"{word} {filler} {less} {filler} {less} {filler}"
                got = scanner.scan(whole)
                # foreign words change nothing, so every stretch of the template's own words counts
                near = [w for w in patience.words_of(whole) if w in patience.words_of(text)]
                brute = max(
                    len(patience.align(near[a:b], patience.words_of(text)))
                    for a in range(len(near)) for b in range(a, len(near) + 1)
                )
                assert [f[:2] for f in got] == [("T", brute / len(words))], (word, gap)


def test_copies_among_their_own_words():
    rng = random.Random(5)
    for _ in range(150):
        words = [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(10, 14))]
        scanner = patience.Scanner({"T": " ".join(words)}, 0.85)
        template = patience.words_of(" ".join(words))
        copy = list(words)
        del copy[rng.randrange(len(copy))]
        text = rng.choices("abcdefghijklmnop", k=8) + copy + rng.choices("abcdefghijklmnop", k=8)
        body = patience.words_of(" ".join(text))
        best = max(
            len(patience.align(body[a:b], template)) for a in range(len(body)) for b in range(a, len(body) + 1)
        )
        got = scanner.scan(" ".join(text))
        want = best / len(template)
        assert [f[1] for f in got] == ([want] if want >= 0.85 else [])


def test_usual_texts_reworded_and_wrapped():
    scanner = patience.Scanner(patience.LICENSES, 0.9)
    rng = random.Random(6)
    for name, forms in patience.TEXTS.items():
        for form in forms:
            words = form.split()
            assert [f[:2] for f in scanner.scan(form)] == [(name, 1.0)]
            wrapped = "\n".join(" * " + " ".join(words[i : i + 7]) for i in range(0, len(words), 7))
            text = f"/*\n * Copyright 2020 Some One\n{wrapped}\n */ int main"
            assert [f[:2] for f in scanner.scan(text)] == [(name, 1.0)]
            if len(words) > 60:
                for _ in range(5):
                    changed = list(words)
                    # "Lesser" and numbers tell licences apart
                    plain = [i for i, w in enumerate(words) if len(w) > 3 and w[0].islower() and w.isalpha() and w not in ("either", "later")]
                    for i in rng.sample(plain, len(words) // 25):
                        changed[i] = rng.choice(["", "reworded", "two words"])
                    got = scanner.scan("Some text. " + " ".join(changed) + " More text.")
                    assert [f[0] for f in got] == [name] and 0.9 <= got[0][1] < 1, (name, changed)


def test_spdx_lines():
    scanner = patience.Scanner(patience.LICENSES, 0.9)
    names = lambda text: sorted(f[0] for f in scanner.scan(text))
    assert names("// SPDX-License-Identifier: mit\ncode") == ["MIT"]
    assert names("# SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0) OR EUPL-1.2 */") == [
        "EUPL-1.2", "GPL-2.0-only"
    ]
    assert names("SPDX-License-Identifier:") == []
    assert scanner.scan("two words\nSPDX-License-Identifier: MIT\nmore") == [("MIT", 1.0, 2, 4)]


def test_foreign_words_in_a_copy():
    """A copy may be spread over any distance."""
    scanner = patience.Scanner(patience.LICENSES, 0.9)
    rng = random.Random(8)
    words = patience.TEMPLATES["GPL-3.0"].split()
    for n in (10, 34, 40, 4000):
        for at in (3, len(words) // 2, len(words) - 2):
            foreign = [f"x{rng.randrange(1000)}" for _ in range(n)]
            text = " ".join([*words[:at], *foreign, *words[at:]])
            ((name, coverage, first, end),) = scanner.scan("before " + text + " after")
            assert (name, coverage, first, end - first) == ("GPL-3.0", 1.0, 1, len(patience.words_of(text)))
        strewn = " ".join(" ".join([w, *(f"y{i}" for i in range(n // 10))]) for w in words)
        assert [f[:2] for f in scanner.scan(strewn)] == [("GPL-3.0", 1.0)]


def test_texts_full_of_notices():
    """Time and memory grow with the text, and each name is found once, at its first copy."""
    import time
    import tracemalloc

    scanner = patience.Scanner(patience.LICENSES, 0.9)
    form = patience.TEXTS["BSD-3-Clause"][0]
    text = "\n".join(f"Copyright {i} Holder {i}\n{form}" for i in range(150))
    start = time.perf_counter()
    got = scanner.scan(text)
    took = time.perf_counter() - start
    assert [f[:2] for f in got] == [("BSD-3-Clause", 1.0)] and got[0][2] < 5
    assert took < 5
    tracemalloc.start()
    scanner.scan(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


def test_order_of_words_as_by_dynamic_programming():
    rng = random.Random(9)
    for _ in range(60):
        template = [rng.choice("abcde").encode() for _ in range(rng.randint(1, 12))]
        words = [rng.choice(template) for _ in range(rng.randint(0, 30))]
        row, want = [0] * (len(template) + 1), []
        for w in words:
            new = [0]
            for j, t in enumerate(template):
                new.append(max(new[-1], row[j + 1], row[j] + (w == t)))
            row = new
            want.append(row[-1])
        got = list(patience._in_order(patience._masks(template), len(template), words))
        assert got == want
