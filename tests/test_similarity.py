"""ROUGE and LCS against brute force."""

from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from narrata.operators import similarity as SI


def lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        cur = [0]
        for j, y in enumerate(b):
            cur.append(prev[j] + 1 if x == y else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcde"), max_size=40), st.lists(st.sampled_from("abcde"), max_size=40))
def test_bit_parallel_lcs(a, b):
    assert SI.lcs_length(a, b) == lcs_dp(a, b)


def test_lcs_long_text():
    a = ["w%d" % (i % 97) for i in range(5000)]
    b = ["w%d" % (i % 89) for i in range(300)]
    assert SI.lcs_length(a, b) == lcs_dp(a, b)


def _rouge_n(gen, ref, n):
    import re
    g = re.findall(r"[a-z0-9]+", gen.lower())
    r = re.findall(r"[a-z0-9]+", ref.lower())
    gg = Counter(tuple(g[i:i + n]) for i in range(len(g) - n + 1))
    rg = Counter(tuple(r[i:i + n]) for i in range(len(r) - n + 1))
    ov = sum(min(c, rg[k]) for k, c in gg.items())
    p = ov / max(sum(gg.values()), 1)
    rc = ov / max(sum(rg.values()), 1)
    return p, rc, (2 * p * rc / (p + rc) if p + rc else 0.0)


def test_rouge_n_brute_force(spark):
    pairs = [(1, "The cat sat on the mat.", "the cat sat on a mat and the cat slept"),
             (2, "Paid 100 fee", "They charged me a 100 fee, I paid the fee"),
             (3, "nothing shared", "completely different words"),
             (4, "", "skipped because empty"),
             (5, "one", "a single generated token has no bigram")]
    df = spark.createDataFrame(pairs, "id long, g string, r string")
    per = SI.rouge_n_pairs(df, "id", "g", "r", (1, 2)).collect()
    for n in (1, 2):
        got = {r["id"]: (r["p"], r["r"], r["f"]) for r in per if r["n"] == n}
        assert set(got) == {1, 2, 3, 5}
        for i, g, r in pairs[:3] + pairs[4:]:
            want = _rouge_n(g, r, n)
            assert all(abs(x - y) < 1e-12 for x, y in zip(got[i], want))


def test_rouge_l_udf(spark):
    df = spark.createDataFrame([(1, "a b c d", "a x b y d")], "id long, g string, r string")
    r = SI.rouge_l_pairs(df, "id", "g", "r").first()
    assert abs(r["p"] - 3 / 4) < 1e-12 and abs(r["r"] - 3 / 5) < 1e-12


def test_rouge_l_query_against_brute_force(spark):
    import re

    import __spark_entry__ as E
    from narrata.plans import queries as Q
    from tests.conftest import SF_SMALL
    got = {r.complaint_id: r for r in E.queries()["rouge_l"](spark, SF_SMALL).collect()}
    pairs = [r for r in Q._summaries(spark, SF_SMALL).collect() if r.summary and r.narrative]
    assert set(got) == {r.complaint_id for r in pairs}
    for r in pairs:
        g, t = (re.findall("[a-z0-9]+", x.lower()) for x in (r.summary, r.narrative))
        if len(g) * len(t) > 300_000:
            continue
        both = lcs_dp(t, g)
        p, rec = (both / len(g) if g else 0.0), (both / len(t) if t else 0.0)
        f = 2 * p * rec / (p + rec) if p + rec else 0.0
        own = got[r.complaint_id]
        assert max(abs(own.rouge_l_p - p), abs(own.rouge_l_r - rec), abs(own.rouge_l_f - f)) < 1e-6


#: Word pairs of the published rules.
STEMS = {"caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre",
         "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
         "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz",
         "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
         "rational": "ration", "valenci": "valenc", "hesitanci": "hesit", "digitizer": "digit", "conformabli": "conform",
         "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam",
         "predication": "predic", "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
         "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl",
         "triplicate": "triplic", "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr",
         "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
         "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
         "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "homologou": "homolog",
         "communism": "commun", "activate": "activ", "angulariti": "angular", "homologous": "homolog", "effective": "effect",
         "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
         "generalizations": "gener", "oscillators": "oscil", "by": "by", "s": "s", "ing": "ing", "eed": "eed", "yy": "yy"}


def test_published_stems():
    from narrata.functions.stem import stem
    assert {w: stem(w) for w in STEMS} == STEMS


def test_stemmed_scores(spark):
    from narrata.functions.stem import SHORTEST, stem
    pairs = [(1, "charged fees twice, owing", "they charge a fee twice and owed it"), (2, "fee", "fees"), (3, "12 ponies", "pony 12"),
             (4, None, "x"), (1, "same id", "same ids")]
    df = spark.createDataFrame(pairs, "id long, t string, s string")

    def stemmed(text):
        import re
        return " ".join(stem(w) if len(w) >= SHORTEST else w for w in re.findall(r"[a-z0-9]+", text.lower()))
    got = SI.rouge_n_pairs(df, "id", "t", "s", (1, 2), stem=True).collect()
    want = sorted((i, n, *_rouge_n(stemmed(g), stemmed(r), n)) for i, g, r in pairs if g for n in (1, 2))
    assert len(got) == len(want)
    for a, b in zip(sorted(tuple(r) for r in got), want):
        assert all(abs(x - y) < 1e-12 for x, y in zip(a, b))
    whole = {r.id: r for r in SI.rouge_l_pairs(df, "id", "t", "s", stem=True).filter("id <> 1").collect()}
    assert whole[2].f == 1.0 and whole[3].f == 0.5  # "fees" and "fee"; "ponies" and "pony" in the other order


def test_long_pair_is_scored_in_sorting_time(spark):
    import time
    rng = __import__("random").Random(1)
    texts = [" ".join(f"w{rng.randint(0, 6000)}" for _ in range(20_000)) for _ in "ab"]
    df = spark.createDataFrame([(1, *texts)], "id long, g string, r string")
    SI.rouge_n_pairs(df.limit(0), "id", "g", "r", (1, 2)).collect()
    start = time.perf_counter()
    got = {r.n: (r.p, r.r, r.f) for r in SI.rouge_n_pairs(df, "id", "g", "r", (1, 2)).collect()}
    assert time.perf_counter() - start < 10  # some two seconds; a quadratic count took 31
    for n in (1, 2):
        assert all(abs(a - b) < 1e-12 for a, b in zip(got[n], _rouge_n(*texts, n)))


def test_registered_rouge_l_equals_brute_force(spark):
    import re

    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    summaries = {r.complaint_id: r.summary for r in E.queries()["extractive_summary"](spark, SF_SMALL).collect()}
    got = {r.complaint_id: (r.rouge_l_p, r.rouge_l_r, r.rouge_l_f) for r in E.queries()["rouge_l"](spark, SF_SMALL).collect()}
    assert set(got) == {i for i, s in summaries.items() if s}
    for i in sorted(got)[:80]:
        g, r = (re.findall("[a-z0-9]+", x.lower()) for x in (summaries[i], texts[i]))
        n = lcs_dp(r, g)
        p, q = (n / len(g) if g else 0.0), (n / len(r) if r else 0.0)
        assert all(abs(a - b) < 1e-6 for a, b in zip(got[i], (p, q, 2 * p * q / (p + q) if p + q else 0.0)))


def test_stemmed_pairs_are_cut_and_stemmed_once(spark):
    """Token lists in place of texts give the same measures; a text of no token stays a pair."""
    rows = [(1, "Running cats ran home", "the cat runs; cats run"), (2, "!!!", "words here"), (3, "", "x"), (4, None, "x"),
            (5, "a b a b", "b a b a b a"), (1, "one", "one")]
    df = spark.createDataFrame(rows, "id long, s string, t string")
    cut = SI.pair_tokens(df, "id", "s", "t", stem=True)
    assert cut.count() == 4 and cut.schema["s"].dataType.simpleString() == "array<string>"
    for of in (lambda d, **kw: SI.rouge_n_pairs(d, "id", "s", "t", (1, 2, 3), **kw), lambda d, **kw: SI.rouge_l_pairs(d, "id", "s", "t", **kw)):
        assert sorted(of(cut).collect()) == sorted(of(df, stem=True).collect())


def test_overlaps_of_many_rows_equal_counters():
    """N-grams numbered for all rows of a batch at once equal those counted row by row."""
    import pyarrow as pa
    rng = np.random.default_rng(6)
    lists = [[[f"w{x}" for x in rng.integers(0, 6, rng.integers(0, 9))] for _ in range(600)] for _ in range(2)]
    kind = pa.list_(pa.string())
    batch = pa.RecordBatch.from_arrays([pa.array(range(600)), *(pa.array(x, kind) for x in lists)], names=["id", "g", "r"])
    found = [tuple(r.values()) for part in SI._overlaps([1, 2, 4])(iter([batch])) for r in part.to_pylist()]
    want = []
    for i, (g, r) in enumerate(zip(*lists, strict=True)):
        for n in (1, 2, 4):
            a, b = (Counter(zip(*(x[d:] for d in range(n)), strict=False)) for x in (g, r))
            want.append((i, n, (a & b).total(), a.total(), b.total()))
    assert found == want


def test_sentence_weights_are_counted_for_many_rows_at_once():
    """No Python loop over words: the weights equal the plain formula's, also of empty texts and sentences."""
    import math

    import pyarrow as pa

    from narrata.operators import summarize as SU
    rng = np.random.default_rng(7)
    texts = [[" ".join(f"w{x}" for x in rng.integers(0, 9, rng.integers(0, 6))) for _ in range(rng.integers(0, 5))] for _ in range(300)]
    common, rare = {f"w{i}": math.log(10 / (i + 1)) for i in range(5)}, {f"w{i}": math.log(90 / i) for i in range(5, 9)}
    own = [[{"token": w, "idf": rare[w]} for w in sorted({w for s in t for w in s.split()}) if w in rare] for t in texts]
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(300)), pa.array(texts, pa.list_(pa.string())),
        pa.array(own, pa.list_(pa.struct([("token", pa.string()), ("idf", pa.float64())])))], names=["row", "clean", "rare"])
    found = [ws for part in SU._sentence_sums(common)(iter([batch])) for ws in part.column("ws").to_pylist()]
    idf = common | rare
    want = []
    for t in texts:
        counts = Counter(w for s in t for w in s.split())
        units = {w: math.floor(tf / counts.total() * idf[w] * 1e9 + 0.5) for w, tf in counts.items()}
        want.append([sum(units[w] for w in s.split()) for s in t])
    assert found == want
