import random
import zlib

import numpy as np
from helpers import docs
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tapeworks.llm import packing as P
from tapeworks.llm.queries import tokenizer_path

PATH = tokenizer_path()


def test_words_have_the_tokenizers_ids():
    tokenizer, words = Tokenizer.from_file(PATH), P.token_bytes(PATH)
    texts = ["Don't STOP it's 42nd, naïve café!!", "<|endoftext|> x<|startoftext|>y < |", "ŒUVRE Straße ŉ",
             "日本語 テスト", "a b c \x1c d", "İstanbul ΣΑΣ ς", "é é", "x" * 300, "²³½ Ⅷ _a_b_", "'s 'll we'll"]
    for t in texts:
        got = np.frombuffer(b"".join(words[w] for w in t.encode().split()), "<u4").tolist()
        assert got == tokenizer.encode(t, add_special_tokens=False).ids, t


_TOKENIZER = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x24f), max_size=40))
def test_any_latin_text_has_the_tokenizers_ids(text):
    words = P.token_bytes(PATH)
    got = np.frombuffer(b"".join(words[w] for w in text.encode().split()), "<u4").tolist()
    assert got == _TOKENIZER.encode(text, add_special_tokens=False).ids


_ODD_TEXTS = ["they're you've we'll I'm he'd it's can't", "'see 'rex ''s a!'s 's's 'll'l 're'r 1't ½'s x''t '", "a\t\nb  c\r",
              "x" * 99 + " " + "y" * 100, "naïve — ‘quoted’ 日本 end", "İ Ⱥ Ⱦ ŉ ǅ'S", "$$$% 42nd,,b", "\x01 \x02 a\x02b", "",
              None, "<|endoftext|>s 'D", "a\u00a0b"]


def _ids(text):
    return np.array(_TOKENIZER.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_texts_merged_together_have_the_tokenizers_ids(monkeypatch):
    want = [_ids(" ".join((t or "").split(" "))) for t in _ODD_TEXTS]
    for chars in (P.RUN_CHARS, 10):
        monkeypatch.setattr(P, "RUN_CHARS", chars)
        assert list(P.token_bytes(PATH).of_texts(_ODD_TEXTS)) == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("'strevmldSİ!$1² aé\n<—", max_size=30), max_size=4))
def test_any_texts_merged_together_have_the_tokenizers_ids(texts):
    assert list(P.token_bytes(PATH).of_texts(texts)) == [_ids(t) for t in texts]


def test_plan_fills_sequences_without_overlap():
    rng = random.Random(1)
    for cap in (7, 16, 64):
        hist = {n: rng.choice([0, 1, 2, 5, 60]) for n in range(1, cap + 1)}
        hist = {k: v for k, v in hist.items() if v}
        used, seen = {}, {}
        for length, first, count, seq, each, offset in P.plan(hist, cap):
            assert seen.get(length, 0) == first
            seen[length] = first + count
            for j in range(count):
                used.setdefault(seq + j // each, []).append((offset + j % each * length, length))
        assert seen == hist
        for pieces in used.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= cap
        assert sorted(used) == list(range(len(used))) and len(used) == best_fit(hist, cap)


def best_fit(hist, cap):
    """Sequences that best-fit decreasing opens, one piece at a time."""
    free = []
    for length in sorted(hist, reverse=True):
        for _ in range(hist[length]):
            fits = [f for f in set(free) if f >= length]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - length)
            else:
                free.append(cap - length)
    return len(free)


def test_round_trip_of_ids(spark):
    texts = {1: None, 2: "", 3: "hello world", 4: "the cat " * 3000, 5: "hello world", 6: "é " * 2047}
    got = P.pack(docs(spark, texts, extra=True), PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    for i, t in texts.items():
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert [r.start for r in own] == list(range(0, len(ids), 2048))
        assert [r.ids_crc32 for r in own] == [zlib.crc32(ids[r.start:r.start + r.length].tobytes())
                                              for r in own]
        assert sum(r.length for r in own) == len(ids)
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in spans.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048


def test_repeated_rows_and_empty_table(spark):
    got = P.pack(docs(spark, [(1, "a"), (1, "a"), (None, "b")]), PATH).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3
    assert P.pack(docs(spark, []), PATH).count() == 0
