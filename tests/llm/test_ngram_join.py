"""N-gram join: components equal brute force over all pairs, also where clusters take several blocks."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from narrata.llm import ngram_join as NJ
from narrata.llm.components import components
from narrata.llm.shingle_parts import signatures, size_classes
from narrata.llm.signature_tree import SignatureTree
from tests.conftest import SF_SMALL

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def expected(rows, k=4, num=85, den=100):
    """Brute force: (doc_id, shingles, least doc_id reachable)."""
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and rows[i][0] is not None and rows[j][0] is not None:
            if min(len(a), len(b)) * den >= num * max(len(a), len(b)) and find(i) != find(j):
                both = len(a & b)
                if den * both >= num * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(s), least.get(find(i)) if d is not None else None)
                   for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def check(spark, rows, k=4, similar=(85, 100), parts=3):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows],
                               "doc_id long, text string, node int, label string").repartition(parts)
    out = NJ.similar_components(df, k, similar).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr)
    assert got == expected(rows, k, *similar)


def family(rng, base, copies, edits):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus(seed, families=12, copies=14, edits=6):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for f in range(families):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 7, 20, 60, 150, 300]))]
        if f % 3 == 0:
            base = base + passage
        texts += family(rng, base, copies, max(1, len(base) * edits // 100))
    texts += [None, "", " \t\n", "one", "ONE", "one two three", "one two three four", "a b c d e f g h",
              "A b\tc  d e f g h", "a b c d e f g h i", "long " * 30_000, "x " * 29_999 + "y"]
    texts += [texts[0]] * 5
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(None, texts[0]), rows[0], rows[0]]


@pytest.mark.parametrize("seed,k,similar", [(1, 4, (85, 100)), (2, 5, (80, 100)), (3, 2, (60, 100))])
def test_components_match_brute_force(spark, seed, k, similar):
    check(spark, corpus(seed), k, similar)


def test_clusters_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(NJ, "BLOCK_ELEMENTS", 50)
    monkeypatch.setattr(NJ, "BLOCK_CLASSES", 2)
    monkeypatch.setattr(NJ, "CARRIED_UNITS", 3)
    monkeypatch.setattr(NJ, "MEETING_BLOCKS", 2)
    monkeypatch.setattr(NJ, "BROADCAST_ROWS", 0)
    check(spark, corpus(4, families=6, copies=40, edits=14))


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(spark, rows)


def test_empty_table(spark):
    assert NJ.similar_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.sampled_from([(85, 100), (8, 10), (6, 10)]),
       st.floats(0, 1), st.booleans())
def test_similar_sets_share_a_signature(size, seed, similar, drop, many_frequent):
    """Sets at the least similarity, with any frequent elements, share a signature."""
    num, den = similar
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
    most = (den - num) * len(a) // num  # a superset may have so many more
    fewer = int(drop * ((den - num) * len(a) // den))
    b = a[fewer:] if drop < 0.5 else np.unique(np.append(a, rng.integers(0, 2**63, most).astype(np.uint64)))
    shared = len(np.intersect1d(a, b))
    if shared * den < num * (len(a) + len(b) - shared) or np.array_equal(a, b):
        return
    frequent = np.sort(rng.choice(a, len(a) * 9 // 10)) if many_frequent and len(a) > 1 else np.zeros(0, np.uint64)
    sigs, of = signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), frequent, num, den)
    assert set(sigs[of == 0].tolist()) & set(sigs[of == 1].tolist())


def test_size_classes_cover_all_pairs():
    for num, den in ((85, 100), (8, 10)):
        classes = size_classes(900, num, den)
        of = {n: i for i, c in enumerate(classes) for n in range(c.low, c.high + 1)}
        for a in range(1, 700):
            for b in (a, a * den // num):
                if b in of:
                    assert of[b] - of[a] in (0, 1)
                    least = -(-num * (a + b) // (num + den))
                    assert a + b - 2 * least <= classes[of[a]].differ or a == b


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 90))
def test_tree_links_all_similar_pairs(seed, n):
    rng = np.random.default_rng(seed)
    pool = [np.unique(rng.integers(0, 2**63, rng.integers(1, 120)).astype(np.uint64)) for _ in range(4)]
    sets = []
    for _ in range(n):
        base = pool[rng.integers(4)]
        sets.append(np.unique(np.append(base[rng.random(len(base)) < rng.choice([0.8, 0.93, 1.0])],
                                        rng.integers(0, 2**63, rng.integers(1, 6)).astype(np.uint64))))
    found = SignatureTree(sets, np.arange(n), 85, 100).link()
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in combinations(range(n), 2):
        s = len(np.intersect1d(sets[i], sets[j]))
        if s * 100 >= 85 * (len(sets[i]) + len(sets[j]) - s):
            root[find(i)] = find(j)
    for i, j in combinations(range(n), 2):
        assert (found[i] == found[j]) == (find(i) == find(j))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 400)] + [(500, 499), (7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 400)}, 499: 499, 500: 499}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
