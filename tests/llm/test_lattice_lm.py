import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import docs, words

from tapeworks.llm import lattice_lm as L
from tapeworks.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


def test_forward_recursion_sums_all_segmentations():
    lat = L.Lattice(PATH, {i: i % 97 for i in range(3, 32000)})
    for word in (b"the", b"cats", b"\xc3\xa9t\xc3\xa9", b"zq"):
        text = L.MARK + word.decode()
        total = 0.0
        for cuts in itertools.product([0, 1], repeat=len(text) - 1):
            parts, at = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(text[at:i])
                    at = i
            parts.append(text[at:])
            if all(p in lat.pieces for p in parts):
                total += math.exp(sum(lat.pieces[p] for p in parts))
        assert lat.log_prob(word) == pytest.approx(math.log(total), rel=1e-9)


def test_expected_counts_weight_all_segmentations():
    lat = L.Lattice(PATH, {i: i % 89 for i in range(3, 32000)})
    word = b"there"
    text, weights = L.MARK + word.decode(), Counter()
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        at = [0, *[i for i, c in enumerate(cuts, 1) if c], len(text)]
        parts = [text[a:b] for a, b in zip(at, at[1:])]
        if all(p in lat.pieces for p in parts):
            for p in parts:
                weights[p] += math.exp(sum(lat.pieces[x] for x in parts) - lat.log_prob(word))
    into = np.zeros(32000)
    lat.expected(word, into)
    for p, w in weights.items():
        assert into[lat.place[p]] == pytest.approx(w)
    assert into.sum() == pytest.approx(sum(weights.values()))


def test_characters_outside_the_vocabulary_are_bytes():
    lat = L.Lattice(PATH, {})
    assert "\U0001f9ff" not in lat.pieces
    want = lat.log_prob(b"") + sum(lat.bytes_[b] for b in "\U0001f9ff".encode())
    assert lat.log_prob("\U0001f9ff".encode()) == pytest.approx(want)
    assert math.isfinite(lat.log_prob(b"q" * 5000)) and math.isfinite(lat.log_prob(b"\xff\xfe"))


def test_word_probabilities_add_up_to_one_at_most():
    lat = L.Lattice(PATH, {i: 1000 for i in range(40)})
    short = [a + b for a in "abcdefgh" for b in ["", *"abcdefgh"]]
    assert sum(math.exp(lat.log_prob(w.encode())) for w in short) < 1


@pytest.mark.parametrize("head", [0, 3, 100_000])
def test_counts_and_scores(spark, monkeypatch, head):
    monkeypatch.setattr(L, "HEAD", head)
    rng = random.Random(1)
    vocab = ["the", "of", "and", "Cat", "dog", "été", "rain", "x\u0085y"] + [f"w{i}" for i in range(60)]
    texts = {i: " ".join(rng.choices(vocab, k=rng.randint(0, 40))) for i in range(120)}
    texts |= {200: None, 201: "", 202: "unseen-word " * 500, 203: "q" * 3000}
    d = docs(spark, texts, extra=True)
    got = {r.doc_id: r for r in L.score(d, PATH).collect()}
    assert len(got) == len(texts)
    c = Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(words(t))
            c[None] += 1
    n, v = sum(c.values()), len(c)
    for i, t in texts.items():
        w, r = words(t) + [None], got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        assert math.isfinite(r.score) and r.score < 0


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    rng, rows = random.Random(2), []
    for i in range(600):
        lang = rng.choice(["en", "fr"])
        rows.append((i, " ".join(f"{lang}{rng.randint(0, 200)}" for _ in range(rng.randint(1, 60))), lang))
    got = L.score(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PATH).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_no_training_rows_and_empty_table(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = L.score(docs(spark, {held: "some words"}), PATH).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isfinite(r.score)
    assert L.score(docs(spark, {}), PATH).count() == 0


def test_repeated_rows_and_null_class(spark):
    rows = [(1, "a b"), (1, "a b"), (None, "a")]
    got = L.score(docs(spark, rows), PATH, class_col=None).collect()
    assert sorted(r.n_tokens for r in got) == [2, 3, 3]


def test_byte_and_long_words_count_whole():
    lat = L.Lattice(PATH, {i: i % 89 for i in range(3, 32000)})
    sizes = {i: len(x) for x, i in lat.place.items()}
    eye = "\U0001f9ff"
    into = np.zeros(32000)
    lat.expected(("ab" + eye).encode(), into)
    assert all(into[lat.byte_place[b]] == pytest.approx(eye.encode().count(b)) for b in eye.encode())
    assert sum(into[i] * k for i, k in sizes.items()) == pytest.approx(3)
    for n in (40, 300, 5000):
        into = np.zeros(32000)
        lat.expected(b"there" * (n // 5), into)
        assert sum(into[i] * k for i, k in sizes.items()) == pytest.approx(n + 1)
    plain, logs = np.zeros(32000), np.zeros(32000)
    lat.expected(b"lattices", plain)
    lat._expected_log(L.MARK + "lattices", logs)
    assert plain == pytest.approx(logs)


def test_scores_are_refined_on_all_words(spark):
    words = [f"{a}{i:x}".encode() for i in range(3000) for a in ("th", "rain", "cat", "no", "zu", "pre", "é")]
    rows = [(w, [i % 3, int(i % 5 == 0)]) for i, w in enumerate(words)]
    counts = spark.createDataFrame(rows, "word binary, by array<long>").repartition(8)
    hard = {i: i % 7 for i in range(3, 32000)}
    want = None
    for _ in range(L.ROUNDS):
        into = np.zeros((2, 32000))
        for k in range(2):
            lat = L.Lattice(PATH, hard, 1.0) if want is None else L.Lattice(PATH, want[k], L.LEAST)
            for w, by in rows:
                if by[k]:
                    lat.expected(w, into[k])
        want = L._smoothed(into)
    got = L.refine(counts, PATH, hard, 2)
    for k in range(2):
        assert [got[k].get(i, 0.0) for i in range(32000)] == pytest.approx([want[k][i] for i in range(32000)])


def test_arrays_equal_the_plain_recursion():
    rng = random.Random(5)
    counts = [{i: rng.randrange(50) for i in range(3, 32000)} for _ in range(3)]
    lats = L.Lattices(PATH, counts)
    words = ["".join(rng.choice("aeinrst é中q.") for _ in range(rng.randint(0, 30))).encode() for _ in range(400)]
    words += [b"", "\U0001f9ff".encode(), b"\xff", b"q" * 100, words[0]]
    got = lats.log_probs(words)
    for w, line in zip(words, got):
        assert line == pytest.approx([x.log_prob(w) for x in lats.each])
    weights = np.array([[1.0, i % 2, 0.0] for i in range(len(words))])
    into, want = np.zeros((3, 32000)), np.zeros((3, 32000))
    lats.expected_all(words, weights, into)
    for w, ks in zip(words, weights):
        for k in np.flatnonzero(ks):
            lats.each[k].expected(w, want[k])
    assert into == pytest.approx(want) and not into[2].any()
    assert lats.log_probs([]).shape == (0, 3)


def test_held_out_documents_are_likelier_than_under_the_base(spark):
    got = L.score(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), PATH).where("held_out")
    score, base = got.selectExpr("sum(score)", "sum(base_score)").first()
    assert score > 0.98 * base  # log probabilities: 2 % nearer to zero
