"""Toxicity from a weighted lexicon, matched by Aho-Corasick.

Texts are folded first: compatibility forms and accents, look-alike letters of
other scripts, and digits and signs that stand for letters inside words. The
lexicon is learnt: words and beginnings of words (inflected forms share them)
that labelled toxic texts hold far more often than others, weighted by the
smoothed log odds. Exception phrases, learnt too, are a lexicon entry with the
word before or after it that is common in texts labelled clean; a match inside
one does not count. All entries are one automaton; a text's score is the
logistic of its summed weights, each entry counted less the longer the text is,
with the scale fitted on the same labels.

The lexicon is fitted on about FIT_ROWS labelled texts at most, drawn by a hash
of the id; near copies (equal in one of three min-hashes of 5-word shingles)
count once, so that a text copied a thousand times does not make its words
entries. It has at most ENTRIES entries and EXCEPTIONS phrases. Scoring reads
every whole text and moves no rows.

Defined cases: a NULL or empty text has no match and so the lowest score; a
label of NULL is no label; an id with two labels counts by each; without labels
the lexicon is empty and every score is that of a text without a match. Other
columns are ignored; neither lang, source nor doc_id enter a score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tapeworks.llm.common import columns_of, fold_of, keep_table, small_batches

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
#: Labelled texts that the lexicon is fitted on, about; entries; phrases.
FIT_ROWS, ENTRIES, EXCEPTIONS = 20_000, 2000, 2000
#: Features that may become entries: the most frequent ones of toxic texts.
CANDIDATES = 100_000
#: An entry: texts that hold it at least, and the least log odds.
SUPPORT, LOG_ODDS = 6, 3.0
#: Letters of the beginnings of words that are tried.
STEM, LONGEST = 4, 12
#: A phrase is an exception with so many clean texts, and such a share of clean ones.
PHRASE_TEXTS, PHRASE_SHARE = 3, 0.9

#: Look-alike letters of other scripts, and signs used for letters.
LOOK_ALIKE = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i",
              "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "к": "k", "т": "t", "м": "m", "в": "b",
              "н": "h", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v",
              "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o"}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "i", "|": "i"}

_SIGNED = re.compile(r"[^\W_]*[0-9@$!|][\w@$!|]*")
_GAP = re.compile(r"[\W\d_]+")
_FROM_SIGNS = str.maketrans(SIGNS)


class _Plain(dict):
    """Code points to lower-case letters without accents, in ASCII if look-alike."""

    def __missing__(self, code: int) -> str:
        out = "".join(c for c in unicodedata.normalize("NFKD", chr(code).lower())
                      if not unicodedata.combining(c))
        self[code] = out = "".join(LOOK_ALIKE.get(c, c) for c in out)
        return out


def folder() -> Callable[[str | None], str]:
    """text -> its folded words with one space around each."""
    plain = _Plain()

    def letters(m: re.Match) -> str:
        token = m.group().rstrip("@$!|")  # signs at the end are punctuation
        return token.translate(_FROM_SIGNS) + " " if not token.isdigit() else " "

    def fold(text: str | None) -> str:
        flat = (text or "").translate(plain)
        return f" {_GAP.sub(' ', _SIGNED.sub(letters, flat)).strip()} "

    return fold


@dataclass(frozen=True)
class Lexicon:
    """Entries, each begun by a space and ended by one if a whole word, and their
    weights; exception phrases; the scale of the score."""
    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    slope: float = 1.0
    offset: float = -2.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        if len(found):
            found.make_automaton()
        return found


def _uncovered(hits: list[tuple], covers: list[tuple]) -> Iterator[tuple]:
    """Hits that lie in no cover, both sorted by their beginning: one sweep. Of the covers that
    begin at or before a hit the farthest end decides."""
    far, at = -1, 0
    for h in hits:
        while at < len(covers) and covers[at][0] <= h[0]:
            far = max(far, covers[at][1])
            at += 1
        if h[1] > far:
            yield h


def total_weight(automaton, folded: str) -> float:
    """Summed weights of the entries in a folded text that no exception covers."""
    if not len(automaton):
        return 0.0
    hits, covers = [], []
    for end, (size, weight) in automaton.iter(folded):
        (covers if weight is None else hits).append((end - size + 1, end, weight))
    if covers:
        hits = _uncovered(sorted(hits, key=lambda h: h[:2]), sorted(covers, key=lambda c: c[:2]))
    return math.fsum(w for _, _, w in hits)


def feature(total: float, folded: str) -> float:
    """What the score is a logistic of; a match counts less in a long text."""
    words = max(1, folded.count(" ") - 1)
    return total / (1 + 0.1 * max(0.0, math.log(words / 100)))


def _words(folded: str) -> set[str]:
    return set(folded.split())


def _features(folded: str) -> set[str]:
    words = _words(folded)
    return ({f" {w} " for w in words if len(w) >= STEM}
            | {" " + w[:k] for w in words for k in range(STEM, min(len(w), LONGEST) + 1)})


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of the labelled texts that the lexicon is fitted on."""
    small_batches(docs.sparkSession)
    known = labels.select(F.col("doc_id").alias("id"), "toxic").where(
        F.col("toxic").isNotNull() & (fold_of("doc_id", FOLDS) != HELD_OUT))
    share = min(1.0, FIT_ROWS / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = folder()
        for texts, toxic in columns_of(batches, "text", "toxic"):
            texts = [fold(t) for t in texts]
            mins = [[], [], []]
            for t in texts:
                w = t.split()
                grams = [" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))]
                for seed, m in enumerate(mins):
                    m.append(min(xxhash.xxh3_64_intdigest(g, seed) for g in grams) - (1 << 63))
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(toxic, pa.int32())]
                + [pa.array(m, pa.int64()) for m in mins], ["text", "toxic", "m0", "m1", "m2"])

    rows = (docs.select("doc_id", "text")
            .join(F.broadcast(drawn), F.col("doc_id") == F.col("id"))  # about FIT_ROWS rows
            .select("text", F.col("toxic").cast("int").alias("toxic")))
    rows = rows.mapInArrow(folded, "text string, toxic int, m0 long, m1 long, m2 long")
    # Copies and near copies (equal in three min-hashes) count once; the text decides
    # which, so that a fit is repeatable.
    once = rows.groupBy("m0", "m1", "m2", "toxic").agg(F.min("text").alias("text"))
    return keep_table(once.select("text", "toxic"), "fit")


def _counts(rows: DataFrame, features: Callable[[str], set[str]]) -> DataFrame:
    """(feature, n): in how many of the folded texts each is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for (texts,) in columns_of(batches, "text"):
            for t in texts:
                seen.update(features(t))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                          pa.array(list(seen.values()), pa.int64())], ["feature", "n"])

    return (rows.select("text").mapInArrow(count, "feature string, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")))


def _entries(rows: DataFrame) -> dict[str, float]:
    """Features that tell toxic texts, with their log odds."""
    toxic, clean = rows.where("toxic = 1"), rows.where("toxic = 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    often = (_counts(toxic, _features).where(F.col("n") >= SUPPORT)
             .orderBy(F.desc("n"), "feature").limit(CANDIDATES).collect())
    held = {r["feature"]: r["n"] for r in often}
    names = rows.sparkSession.sparkContext.broadcast(frozenset(held))
    other = {r["feature"]: r["n"] for r in
             _counts(clean, lambda t: _features(t) & names.value).collect()}
    odds = {}
    for f, t in held.items():
        c = other.get(f, 0)
        odds[f] = (math.log((t + 0.5) / (n_toxic - t + 0.5))
                   - math.log((c + 0.5) / (n_clean - c + 0.5)))
    chosen: dict[str, float] = {}
    for f in sorted((f for f, o in odds.items() if o >= LOG_ODDS), key=len):
        # A beginning that is about as sure stands for all that follows it.
        if not any(f[:k] in chosen and chosen[f[:k]] >= odds[f] - 1 for k in range(STEM + 1, len(f))):
            chosen[f] = odds[f]
    best = sorted(chosen, key=lambda f: (-chosen[f] * math.sqrt(held[f]), f))[:ENTRIES]
    return {f: chosen[f] for f in best}


def _exceptions(rows: DataFrame, weights: dict[str, float]) -> tuple[str, ...]:
    """Phrases of two words around an entry that clean texts hold, toxic ones hardly."""
    entries = tuple(weights)

    def phrases(folded: str) -> set[str]:
        w = folded.split()
        own = [i for i, x in enumerate(w) if f" {x} ".startswith(entries)]
        return ({f" {w[i - 1]} {w[i]} " for i in own if i}
                | {f" {w[i]} {w[i + 1]} " for i in own if i + 1 < len(w)})

    clean = (_counts(rows.where("toxic = 0"), phrases).where(F.col("n") >= PHRASE_TEXTS)
             .orderBy(F.desc("n"), "feature").limit(EXCEPTIONS).collect())
    if not clean:
        return ()
    names = frozenset(r["feature"] for r in clean)
    toxic = {r["feature"]: r["n"] for r in
             _counts(rows.where("toxic = 1"), lambda t: phrases(t) & names).collect()}
    return tuple(r["feature"] for r in clean
                 if r["n"] >= PHRASE_SHARE * (r["n"] + toxic.get(r["feature"], 0)))


def _features_and_labels(rows: DataFrame, lexicon: Lexicon) -> np.ndarray:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for texts, toxic in columns_of(batches, "text", "toxic"):
            x = [feature(total_weight(automaton, t), t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), pa.array(toxic, pa.int32())],
                                             ["x", "toxic"])

    # At most the fitting sample, two numbers a text.
    got = rows.mapInArrow(read, "x double, toxic int").collect()
    # In one order, as sums of doubles depend on it.
    return np.array(sorted((r["x"], r["toxic"]) for r in got), float).reshape(-1, 2)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a ridge-penalised logistic regression, by Newton steps."""
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + 0.01 * w
        w -= np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(2), grad)
    return float(max(w[0], 1e-3)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame) -> Lexicon:
    rows = sample(docs, labels)
    weights = _entries(rows)
    exceptions = _exceptions(rows, weights) if weights else ()
    lexicon = Lexicon(weights, exceptions)
    seen = _features_and_labels(rows, lexicon)
    if len(set(seen[:, 1])) < 2:
        return lexicon
    slope, offset = _logistic(seen[:, 0], seen[:, 1])
    return Lexicon(weights, exceptions, slope, offset)


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    small_batches(docs.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, automaton = folder(), lexicon.automaton()
        for ids, held, texts in columns_of(batches, "doc_id", "held_out", "text"):
            flat = [fold(t) for t in texts]
            x = np.array([feature(total_weight(automaton, t), t) for t in flat], float)
            p = 1 / (1 + np.exp(-np.clip(lexicon.slope * x + lexicon.offset, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(p, pa.float64()),
                 pa.array((p >= THRESHOLD).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (fold_of(id_col, FOLDS) == HELD_OUT).alias("held_out"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(read, "doc_id long, held_out boolean, score double, predicted int")
