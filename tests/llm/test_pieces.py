import hashlib
import random
import struct

import pytest
import sentencepiece
from helpers import docs

from tapeworks.llm import pieces as E
from tapeworks.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)

ODD = ["", " ", "a", "  a b", "x\0y", "\n\n", "▁a", "▁▁ ▁t", "<s>", "</s> <unk>", "<0x41>", "😀é", "a ", "　", " " * 100 + "the",
       " " * 37, " " * 33 + "\n" + " " * 18 + "in", "中文字符测试" * 300, "aaaaaaa" * 300, "퟿", "é", "x" * 5000,
       "the   the  \t the"]


@pytest.fixture(scope="module")
def vocabulary():
    return E.Vocabulary(PATH)


def _ids(v, text):
    return [i for (i,) in struct.iter_unpack("<I", v.ids_of(text))]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(vocabulary, text):
    assert _ids(vocabulary, text) == LIB.encode(text)


def test_random_texts_equal_the_library(vocabulary):
    rng, names = random.Random(1), list(vocabulary.ids)
    for i in range(6000):
        text = rng.choice([
            lambda: "".join(rng.choice(names) for _ in range(rng.randint(1, 12))).replace("▁", " "),
            lambda: "".join(rng.choice(" etainoshr") for _ in range(rng.randint(1, 60))),
            lambda: "".join(rng.choice("  \n\tte") for _ in range(rng.randint(1, 60))),
            lambda: "".join(chr(rng.choice([rng.randint(32, 0x2fff), rng.randint(0x3040, 0x9fff), rng.randint(0x1f300, 0x1f6ff)]))
                            for _ in range(rng.randint(1, 30))),
            lambda: " " * rng.randint(0, 60) + rng.choice(names) + " " * rng.randint(0, 50) + rng.choice(["", "ing", "\n"]),
            lambda: "".join(rng.choice(["in", "ing", "er", "re", "the", "he", "tt", "st", "▁", " "]) for _ in range(rng.randint(1, 40))),
        ])()
        assert _ids(vocabulary, text) == LIB.encode(text), text


def test_backtracking_is_needed_and_linear(vocabulary):
    """Greedy longest matches are not the merge result; failed places are passed once."""
    greedy = 0
    for text in ("▁" + w for w in ("aningly", "thestation", "rereading", "unhappiness", "seethere")):
        at, parts = 0, []
        while at < len(text):
            n = max(k for k in range(1, 17) if text[at:at + k] in vocabulary.whole or k == 1)
            parts.append(text[at:at + n])
            at += n
        greedy += parts != vocabulary.encode(text)
    assert greedy
    long = "▁" + "".join(random.Random(2).choice("abcdehinrst") for _ in range(20_000))
    assert "".join(vocabulary.encode(long)) == long
    assert _ids(vocabulary, long[1:]) == LIB.encode(long[1:])


def test_pairs_fit_as_merging_says(vocabulary):
    rng, names = random.Random(3), sorted(vocabulary.whole)
    for _ in range(3000):
        a, b = rng.choice(names), rng.choice(names)
        if "▁" not in b:
            assert vocabulary.fits(a, b) == (vocabulary.merge(a + b) == [a, b]), (a, b)


def test_tables(spark):
    rows = [(i, t.replace("퟿", "")) for i, t in enumerate(ODD)] + [(900, None), (900, "twice"), (900, "twice"), (None, "no id")]
    table = docs(spark, rows, extra=True).withColumn("ids", docs(spark, [(1, "x")]).first().doc_id * 0 + E.F.lit("x"))
    out = E.decode(E.encode(table, PATH), PATH)
    assert out.columns[-2:] == ["ids", "decoded"] and "kept" in out.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in E.digests(out).collect())
    want = []
    for i, t in rows:
        ids = LIB.encode(t or "", add_bos=True, add_eos=True)
        want.append((i is None, i or 0, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                     hashlib.sha256(LIB.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)
    plain = E.encode(docs(spark, {1: "a"}), PATH, begin=False, end=False).first().ids
    assert list(struct.iter_unpack("<I", plain)) == [(i,) for i in LIB.encode("a")]
    assert E.digests(E.decode(E.encode(docs(spark, {}), PATH), PATH)).count() == 0


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        E.Vocabulary(str(tmp_path / "m"))
