"""License scans against brute force over all windows, and planted notices."""

import random
import re
import time

from narrata.llm import license_scan as LS
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bigrams(text):
    w = WORD.findall((text or "").translate(UPPER))
    return list(zip(w, w[1:]))


def expected(text, templates=LS.TEMPLATES, least=0.9):
    own, found = bigrams(text), []
    for lic, name, template in templates:
        t = bigrams(template)
        scores = []
        for i, b in enumerate(own):
            if b in set(t):
                window = set(own[i:i + len(t)])
                scores.append((2 * len(window & set(t)) / (len(window) + len(set(t))), -i))
        if scores and max(scores)[0] >= least:
            found.append((-max(scores)[0], -max(scores)[1], name, lic))
    top = min(found)[:3] if found else None
    return len(own), sorted({f[3] for f in found}), top and top[2], top and -top[0]


def check(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "id long, text string, template string")
    out = LS.scan(df, **kw).collect()
    assert len(out) == len(texts)
    for r in out:
        n, licenses, template, dice = expected(r.text, kw.get("templates", LS.TEMPLATES))
        assert (r.n_bigrams, list(r.licenses), r.template) == (n, licenses, template), r.text
        assert (r.dice is None) if dice is None else abs(r.dice - dice) < 1e-12
        if template:
            part = r.text[r.match_start:r.match_end]
            assert bigrams(part)[0] in bigrams(next(t for _, name, t in kw.get("templates", LS.TEMPLATES) if name == template))
    return out


def test_templates_and_edits(spark):
    rng = random.Random(2)
    texts = [None, "", "word", "two words", "Licensed under CC BY-NC 4.0.", "é—Released under\nthe MIT license! tail"]
    for _, _, template in LS.TEMPLATES:
        words = template.split()
        texts += [template, "é prefix of the " * 20 + template.upper() + " and the suffix of it" * 9]
        for edits in (1, 3, 8):
            own = list(words)
            for _ in range(edits):
                own[rng.randrange(len(own))] = rng.choice(["the", "changed", "of"])
            texts.append("in the " + " ".join(own) + " x y")
        texts.append(" ".join(words[: len(words) // 2]))
    out = check(spark, texts)
    assert sum(bool(r.licenses) for r in out) > 30


def test_documents(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(spark, [t for t in texts if len(t) < 8000])


def test_windows_of_repetitive_texts():
    rng = random.Random(5)
    c = LS.compile_templates((("X", "x", "a b a c a b d"), ("Y", "y", "b a b a"), ("Z", "z", "c d e f g h")), (1, 2))
    for size in (2, 5, 9, 40, 200):
        text = " ".join(rng.choice("abcdefgh") for _ in range(size))
        own, _, *_ = LS._bigrams(LS.pa.array([text]))
        at = LS.np.minimum(LS.np.searchsorted(c.bigrams, own), len(c.bigrams) - 1)
        hits = LS.np.where(c.bigrams[at] == own, at, -1)
        for t in range(len(c.templates)):
            want = []
            for i in range(len(own)):
                window = hits[i:i + c.windows[t]]
                shared = len({h for h in window if h >= 0 and c.member[h, t]})
                both = len(set(own[i:i + c.windows[t]])) + int(c.sizes[t])
                if hits[i] >= 0 and c.member[hits[i], t] and 4 * shared >= both:
                    want.append((shared, both, i))
            assert LS.scoring_windows(own, hits, t, c) == want


def test_long_text_that_repeats_a_notice(spark):
    notice = next(t for _, name, t in LS.TEMPLATES if name == "mit-text")
    text = " ".join([notice] * (1_400_000 // len(notice)))
    started = time.monotonic()
    r, = LS.scan(spark.createDataFrame([(1, text)], "id int, text string"), best_only=True).collect()
    assert list(r.licenses) == ["MIT"] and r.dice == 1.0 and r.match_start == 0
    assert time.monotonic() - started < 20


def test_own_templates_and_empty(spark):
    check(spark, ["b a b a b", "a b a b a c", "a b"], templates=(("X", "x", "a b a b"), ("Y", "y", "one")))
    assert LS.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert [list(r.licenses) for r in LS.scan(spark.createDataFrame([("a b",)], "text string"), templates=()).collect()
            ] == [[]]


def test_query_takes_the_best_match_of_a_place(spark, tmp_path):
    line = {name: text for _, name, text in LS.TEMPLATES}
    gpl2, gpl3 = line["gpl2-line"], line["gpl3-line"]
    texts = {
        "in front " + gpl3 + " tail": ["GPL-3.0"],
        "in front " + gpl2 + " tail": ["GPL-2.0"],
        gpl3 + " and elsewhere, after other words, " + gpl2: ["GPL-2.0", "GPL-3.0"],
        gpl3.replace("version 3", "version 4"): ["GPL-2.0", "GPL-3.0"],  # as near to one as to the other
        # the GPL-2 line has an edit of its own, so its template scores as much at the GPL-3 line
        gpl3 + " and elsewhere " + gpl2.replace("This work", "That work"): ["GPL-2.0", "GPL-3.0"],
        line["apache-notice"] + " " + gpl3 + " " + line["mit-text"]: ["Apache-2.0", "GPL-3.0", "MIT"],
        line["mit-line"] + " " + line["apache-line"]: ["Apache-2.0", "MIT"],
    }
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in LS.op2_license_scan(spark, str(tmp_path)).collect()}
    for i, want in enumerate(texts.values()):
        assert list(got[i].licenses) == want, i
    assert got[0].template == "gpl3-line" and got[0].dice == 1.0


def test_default_templates_tell_licenses_apart(spark):
    covered = {lic for lic, *_ in LS.TEMPLATES}
    assert {"BSD-3-Clause", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "GPL-2.0", "EPL-2.0", "CC0-1.0"} <= covered
    rows = [(i, f"in front of it {text} and after it") for i, (_, _, text) in enumerate(LS.TEMPLATES)]
    out = LS.scan(spark.createDataFrame(rows, "id int, text string"), best_only=True).collect()
    assert {r.id: list(r.licenses) for r in out} == {i: [t[0]] for i, t in enumerate(LS.TEMPLATES)}
    assert all(r.dice == 1.0 for r in out)
