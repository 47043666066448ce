import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import docs

from tapeworks.llm import collocations as C
from tapeworks.llm import slots as S

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, best=2000):
    """The contract by plain counting: rows are (lang, text)."""
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                count.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    cand = {g: a for g, a in count.items() if len(g) > 2 and a >= least}
    inside = {(g[0], *g[i:j]) for g, a in cand.items() for i in range(1, len(g)) for j in range(i + 2, len(g) + 1)
              if j - i < len(g) - 1 and 100 * a >= 100 * count[(g[0], *g[i:j])]}
    out = {}
    for g, a in cand.items():
        if g not in inside:
            cuts = [(1000 * a * total[g[0]] // (count[g[:k + 1]] * count[(g[0], *g[k + 1:])]), k) for k in range(1, len(g) - 1)]
            score, k = min(cuts)
            out.setdefault(g[0], []).append((-score, -a, " ".join(g[1:]).encode(), k, count[g[:k + 1]], count[(g[0], *g[k + 1:])]))
    return sorted((lang, i, p.decode(), -a, left, right, total[lang], k, -score) for lang, rows in out.items()
                  for i, (score, a, p, k, left, right) in enumerate(sorted(rows)[:best], 1))


def _texts(n, seed):
    rng = random.Random(seed)
    words = ["New", "York", "the", "of", "x\u0085y", "été", "a", "a", "b", *[f"w{i}" for i in range(40)]]
    out = []
    for _ in range(n):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if rng.random() < .5:
            parts[3:3] = rng.choice([["new", "york", "city", "hall"], ["a", "a", "a", "a"], ["of", "the"]])
        out.append("".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b"]) for w in parts))
    return out


def _table(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


@pytest.mark.parametrize("entries,best", [(50, 2000), (400_000, 7)])
def test_equals_brute_force(spark, monkeypatch, entries, best):
    monkeypatch.setattr(C, "WORDS", 40 if entries == 50 else 400_000)
    monkeypatch.setattr(C, "KEYS", 300 if entries == 50 else 1 << 20)
    rows = [(random.Random(i).choice(["en", "de", None, "und"]), t) for i, t in enumerate(_texts(300, 1))]
    rows += [("en", None), ("en", ""), ("fr", "one two"), ("en", " . ; "), ("de", "long " * 3000)]
    got = C.mine(_table(spark, rows).repartition(5), least=20, best=best, entries=entries)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, best)


def test_clashing_slots_lose_nothing(spark):
    rows = [("en", t) for t in _texts(150, 2)]
    got = C.mine(_table(spark, rows), least=10, bits=64)
    assert sorted(map(tuple, got.collect())) == brute(rows, 10)


def test_empty_and_other_columns(spark):
    assert C.mine(docs(spark, {})).count() == 0
    got = C.mine(docs(spark, {i: "to be or not to be" for i in range(12)}, extra=True), least=12)
    assert [r.phrase for r in got.collect()] == ["to be", "to be or not to"] or {"to be"} <= {r.phrase for r in got.collect()}
    assert sorted(map(tuple, got.collect())) == brute([("en", "to be or not to be")] * 12, 12)


def test_trie_counts_bursts_and_spills():
    rng, trie, want = random.Random(3), C.HatTrie(burst=5, shallow=2), Counter()
    got = Counter()
    for i in range(4000):
        p = tuple(rng.randrange(6) for _ in range(rng.randint(1, 5)))
        trie.add(p)
        want[p] += 1
        if i % 700 == 699:
            for run in trie.spill(trie.size // 2):
                heads = {phrase[0] for phrase, _ in run}
                assert len(heads) == 1  # a whole subtree
                got.update(dict(run))
    assert any(type(x) is not dict for x in trie.root.values())
    assert trie.size == sum(1 for _ in (p for w in trie.root for p in trie._phrases(trie.root[w], (w,))))
    for run in trie.spill():
        got.update(dict(run))
    assert got == want and trie.size == 0 and not trie.root


def test_exact_scores_beyond_64_bits(spark):
    n = 2_000_000_000_000
    phrases = spark.createDataFrame([("en", "a b", 2, 10**11), ("en", "a", 1, 3 * 10**11), ("en", "b", 1, 7 * 10**11)],
                                    "lang string, phrase string, size int, n long")
    total = spark.createDataFrame([("en", n)], "lang string, n long")
    row = C.scored(C.uncontained(phrases), phrases, total).first()
    assert row.score == 1000 * 10**11 * n // (3 * 10**11 * 7 * 10**11)


def test_packed_slots(spark):
    rng = np.random.default_rng(4)
    slots = S.slots_of(rng.integers(0, 1 << 63, 500).astype(np.uint64))
    keys = np.repeat(slots, rng.integers(1, 5, 500))
    times = Counter(keys.tolist())
    chunks = S.chunks_for(0)
    rows = []
    for part in np.array_split(rng.permutation(keys), 4):
        b = S.packed(part, chunks, 3)
        rows += [tuple(r.values()) for r in b.to_pylist()]
    df = spark.createDataFrame([(c, bytearray(o), bytearray(t)) for c, o, t in rows], S.SLOTS)
    got = S.bitmap(S.frequent(df, chunks, 3, 1 << 26), 1 << 26)
    assert S.has(got, slots % np.uint64(1 << 26)).tolist() == [times[s] >= 3 for s in slots.tolist()]
    assert not S.bitmap(S.frequent(df.limit(0), chunks, 3, 1 << 10), 1 << 10).any()
