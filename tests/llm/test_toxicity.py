import random

from helpers import docs
from pyspark.sql import functions as F

from tapeworks.llm import toxicity as T
from tapeworks.llm.common import fold_of


def test_folding():
    fold = T.folder()
    assert fold("ІDIОТ, id1ot! 1d10t $tup1d") == " idiot idiot idiot stupid "
    assert fold("Ｆｏｏ é ß idiot$$$ 2024 a&b") == " foo e ß idiot a b "
    assert fold(None) == fold("") == "  "


def test_exceptions_cover_matches():
    lex = T.Lexicon({" trash ": 4.0, " scum": 3.0}, (" trash can ",))
    a = lex.automaton()
    assert T.total_weight(a, " the trash can is full ") == 0
    assert T.total_weight(a, " the trash can is trash ") == 4.0
    assert T.total_weight(a, " scummy trash ") == 7.0
    assert T.total_weight(T.Lexicon({}).automaton(), " x ") == 0


def corpus(n, rng):
    vocab = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("nda", "rto", "sil", "tem")]
    texts, toxic = {}, {}
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(5, 80))]
        toxic[i] = int(rng.random() < 0.3)
        if toxic[i]:
            w[rng.randrange(len(w))] = rng.choice(["jerkface", "n1tw1t", "Nitwit", "jerkfaces", "blockhead"])
        elif rng.random() < 0.008:
            at = rng.randrange(len(w))
            w[at:at + 1] = ["blockhead", "bolt"]
        texts[i] = " ".join(w)
    return texts, toxic


def test_held_out_accuracy_and_no_leak_of_held_out_labels(spark):
    texts, toxic = corpus(2400, random.Random(1))
    texts |= {2000: None, 2001: "", 2002: "x " * 50000}
    d = docs(spark, texts, extra=True)
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()] + [(2000, 1, None)],
                                   "doc_id long, quality int, toxic int")
    lex = T.fit(d, labels)
    assert " blockhead bolt " in lex.exceptions
    got = {r.doc_id: r for r in T.score(d, lex).collect()}
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got.values())
    out = [i for i in toxic if got[i].held_out]
    assert sum(got[i].predicted == toxic[i] for i in out) >= 0.97 * len(out)
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())
    flipped = labels.withColumn("toxic", F.when(fold_of("doc_id", 3) == 1, 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    assert T.fit(d, flipped) == lex


def test_no_labels_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lex = T.fit(docs(spark, {1: "a"}), none)
    assert [r.predicted for r in T.score(docs(spark, [(1, "a"), (1, "a"), (None, None)]), lex).collect()] == [0, 0, 0]
    assert T.score(docs(spark, {}), lex).count() == 0


def test_copies_of_a_toxic_text_do_not_make_its_words_entries(spark):
    texts, toxic = corpus(900, random.Random(2))
    for i in range(3000, 3100):
        texts[i], toxic[i] = "harmless wordings everywhere around these copied passages jerkface", 1
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int")
    lex = T.fit(docs(spark, texts), labels)
    assert not any("harm" in e or "copied" in e for e in lex.weights)


def test_matcher_equals_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(0, 12))]
        text = f" {' '.join(words)} "
        some = lambda: " " + "".join(rng.choice("ab ") for _ in range(rng.randint(1, 5)))
        weights = {some(): rng.random() for _ in range(6)}
        exceptions = tuple({some() for _ in range(3)} - set(weights))
        spans = [(i, i + len(e), w) for e, w in weights.items() for i in range(len(text)) if text.startswith(e, i)]
        covers = [(i, i + len(e)) for e in exceptions for i in range(len(text)) if text.startswith(e, i)]
        want = sum(w for a, b, w in spans if not any(c <= a and b <= d for c, d in covers))
        got = T.total_weight(T.Lexicon(weights, exceptions).automaton(), text)
        assert abs(got - want) < 1e-9


def test_a_fit_is_repeatable(spark):
    texts, toxic = corpus(500, random.Random(3))
    texts |= {900 + i: texts[i] for i in range(50)}  # copies
    toxic |= {900 + i: toxic[i] for i in range(50)}
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int")
    d = docs(spark, texts)
    assert T.fit(d.repartition(7), labels.repartition(3)) == T.fit(d.coalesce(1), labels)
