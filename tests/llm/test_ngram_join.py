import random

import numpy as np
import pytest
from helpers import brute_components, docs, shingle_set

from tapeworks.llm import ngram_join as N
from tapeworks.llm.common import word_hashes, words_of
from tapeworks.llm.components import components


def texts(seed, groups, size=6, longest=400):
    """Groups of edited copies, from mild to just about or just under 0.8."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    out, i = {}, 0
    for _ in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, longest))]
        for _ in range(rng.randint(1, size)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8, len(w) // 40])):
                at = rng.randrange(len(w)) if w else 0
                kind = rng.random()
                if kind < 0.4 and w:
                    w[at] = rng.choice(vocab)
                elif kind < 0.7:
                    w.insert(at, rng.choice(vocab))
                elif len(w) > 1:
                    del w[at]
            out[i] = " ".join(w)
            i += 1
    ids = list(out)
    rng.shuffle(ids)
    return {j: out[i] for j, i in zip(ids, out)}


def check(spark, t, **kw):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.link(docs(spark, t, **kw)).collect()}
    want = brute_components(t)
    assert got == {i: (len(shingle_set(x)), want[i]) for i, x in t.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    check(spark, texts(seed, 60))


def test_short_texts_and_odd_cases(spark):
    t = {1: None, 2: "", 3: " \t\n", 4: "one", 5: "ONE", 6: "one two", 7: "one  two\v", 8: "a b c d",
         9: "a b c d e", 10: "a b c d e f", 11: "x y", 12: "x y", 13: "É é", 14: "é É",
         15: " ".join(map(str, range(20000))), 16: " ".join(map(str, range(19990))),
         17: "a " * 5000, 18: "a " * 400}
    check(spark, t, extra=True)


def test_chain_of_near_copies_is_one_component(spark):
    base = [f"b{i}" for i in range(100)]
    t = {}
    for i in range(40):
        t[100 - i] = " ".join(base)
        base[(7 * i) % 100] = f"n{i}"
    check(spark, t)


def test_large_group_needs_no_pairs(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(80)]
    t = {}
    for i in range(400):
        w = list(base)
        w[rng.randrange(80)] = f"x{i}"
        t[i] = " ".join(w)
    for i in range(400, 420):
        t[i] = " ".join(base[:40] + [f"y{i}-{j}" for j in range(40)])
    got = {r.doc_id: r.component_id for r in N.link(docs(spark, t)).collect()}
    assert {got[i] for i in range(400)} == {0}
    assert all(got[i] == i for i in range(400, 420))


def test_repeated_rows_and_empty_table(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"),
            (9, "p q r s t u"), (9, "k l m n o p")]
    rows += [(None, "g h i j k l m"), (None, "g h i j k l m"), (None, None)]
    got = sorted((tuple(r)[:3] for r in N.link(docs(spark, rows)).collect()), key=lambda g: (g[0] is None, str(g)))
    assert got[:3] == [(5, 2, 5), (5, 2, 5), (7, 2, 5)] and [g[2] for g in got[3:5]] == [9, 9]
    assert got[5:] == [(None, 0, None), (None, 2, 5), (None, 3, None), (None, 3, None)]
    assert N.link(docs(spark, [])).count() == 0
    kept = N.keep_one(docs(spark, {1: "a b c d e f", 2: "a b c d e f", 3: None}, extra=True))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3] and "kept" in kept.columns


def _dealt(sh, shared):
    """What a set deals when the keys for which ``shared`` holds are not alone."""
    out = set()
    for keys, need in N.keys_of(sh):
        own = [k for k in keys.tolist() if shared(k)]
        out |= set(own[:max(0, need - (len(keys) - len(own)))])
    return out


def test_linked_sets_share_a_key():
    """Whatever other keys clash with shared ones."""
    rng = np.random.default_rng(5)
    for n in [1, 2, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 63, 64, 65, 200, 1000]:
        for _ in range(200 if n < 100 else 20):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            # As many differences as 0.8 allows: drop some, add some.
            most = len(a) // 4
            out = rng.integers(0, most + 1) if most else 0
            keep = a[rng.permutation(len(a))[out:]]
            add = 0
            while len(keep) * 100 >= 80 * (len(a) + add + 1):
                add += 1
            b = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, add).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                common = ({k for x, _ in N.keys_of(a) for k in x.tolist()}
                          & {k for x, _ in N.keys_of(b) for k in x.tolist()})
                for clash in (lambda k: True, lambda k: k in common, lambda k: k in common or k % 3 == 0):
                    assert _dealt(a, clash) & _dealt(b, clash), (n, out, add)


def test_words_split_at_ascii_spaces_only():
    assert words_of("A B C\x0bd\x1ce F") == ["a b".replace("b", "b").encode(),
                                                      b"c", "d\x1ce f".encode()]
    assert len(N.shingles(words_of("a b c"), word_hashes())) == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (300, 200), (7, 7), (1, 0)]
    got = {r.node: r.component for r in components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
