"""LM scoring over subword lattices.

An existing vocabulary of pieces gives every word a lattice: all its
segmentations. A class of texts (a language) has its own unigram scores of the
pieces: their counts over all segmentations of all distinct words of its training
texts, by expectation maximisation begun at the vocabulary's own segmentations,
smoothed with the counts of all classes. A word's subword probability is the
sum over all segmentations, by the forward recursion in log space, which runs on arrays of
words of one length. A word also has arcs of its own: the share of the training
tokens that it is, among all texts and among those of the class. The three are
mixed as Witten and Bell do, with the number of distinct training words as the weight
of the level behind:

    P(token, spelt by a class) = (c + V * P_lattice(token | class)) / (N + V)
    P(token | class) = (c_class + V_class * P(token, spelt by the class)) / (N_class + V_class)

A text's probability given a class is the product over its words and its end
(the lattice of a text factorises at words, as no piece crosses white space).
Which class a scored text is of is not read but summed over, with the classes'
shares of the training texts. Pieces that begin a word carry the vocabulary's
word mark, so the probabilities of all words add up to one at most.

Counts of all training tokens are kept as a table. The HEAD most frequent words
are a broadcast of bounded size, known to the task that reads a text, so
frequent words never travel; a text's other words meet their counts by one
shuffle on the word, in which a training word has no more rows than a word at
the head's edge has occurrences, and sums come back by one shuffle on the text.

Defined cases: a NULL or empty text is the end alone; repeated rows are scored
(and counted) each; characters outside the vocabulary are spelt in bytes; texts
of any length are read whole; NULL classes, and those beyond the CLASSES - 1
largest, are one class (of which texts need no name to be scored, as classes are summed over); without training texts every count is 0 and all pieces
are equally likely. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tapeworks.llm.common import columns_of, drop_table, fold_of, keep_table, small_batches, words_of

#: Rounds that refine the pieces' scores.
ROUNDS = 2
#: Pieces' worth of the counts of all classes that a class is given; the count of a piece
#: that no word has.
PRIOR, LEAST = 2000, 1e-3
#: Words worked on as arrays: so many at once, up to so many characters.
WORDS, ARRAYS = 32_768, 48
#: Words whose counts every task holds.
HEAD = 100_000
#: Counts that a task gathers before it hands them on.
GATHER = 300_000
#: Fold that is not learnt from.
FOLDS, HELD_OUT = 7, 2
#: Classes at most, that of all other texts included.
CLASSES = 8
MARK = "▁"


def word_counts(train: DataFrame, classes: int) -> DataFrame:
    """(word binary, c, by): occurrences in the training texts and, in ``by``, in
    those of each class."""
    small_batches(train.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[Counter] = [Counter() for _ in range(classes)]

        def out(k: int):
            part = seen[k]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(part), pa.binary()), pa.array([k] * len(part), pa.int32()),
                 pa.array(list(part.values()), pa.int64())], ["word", "class", "c"])
            part.clear()
            return batch

        for texts, of in columns_of(batches, "text", "class"):
            for t, k in zip(texts, of):
                seen[k].update(words_of(t))
            for k in range(classes):
                if len(seen[k]) > GATHER // classes:
                    yield out(k)
        for k in range(classes):
            yield out(k)

    per = [F.sum(F.when(F.col("class") == k, F.col("c")).otherwise(0)).alias(f"c{k}")
           for k in range(classes)]
    return (train.select("text", "class").mapInArrow(count, "word binary, class int, c long")
            .groupBy("word").agg(F.sum("c").alias("c"), *per)
            .select("word", "c", F.array(*[f"c{k}" for k in range(classes)]).alias("by")))


def piece_counts(counts: DataFrame, model_path: str) -> dict[int, int]:
    """How often each piece stands in the vocabulary's own segmentations of the
    distinct training words; one number for each piece."""
    small_batches(counts.sparkSession)

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        total = np.zeros(model.get_piece_size(), np.int64)
        for (words,) in columns_of(batches, "word"):
            for ids in model.encode([w.decode("utf-8", "replace") for w in words], num_threads=1):
                for i in ids:
                    total[i] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])],
                                         ["piece", "n"])

    rows = (counts.select("word").mapInArrow(segment, "piece int, n long")
            .groupBy("piece").agg(F.sum("n").alias("n")))
    return {r["piece"]: r["n"] for r in rows.collect()}


_MIX = np.uint64(0x9E3779B97F4A7C15)


def _codes(texts: list[str], n: int) -> np.ndarray:
    """Character codes of texts of ``n`` characters, a row each."""
    flat = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(flat, "<u4").reshape(len(texts), n).astype(np.uint64)


def _step(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The hash of a string with one more character."""
    h = (h ^ code) * _MIX
    return h ^ (h >> np.uint64(29))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches together, up to WORDS rows."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= WORDS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


class Lattice:
    """log P of a word over all segmentations into pieces."""

    def __init__(self, model_path: str, counts: dict[int, float], add: float = 1.0):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        usable = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i))]
        # One more event beside the pieces: the text's end.
        total = sum(counts.get(i, 0) + add for i in usable) + 1
        self.pieces: dict[str, float] = {}
        self.bytes_: dict[int, float] = {}
        self.place: dict[str, int] = {}
        self.byte_place: dict[int, int] = {}
        for i in usable:
            p = math.log((counts.get(i, 0) + add) / total)
            if model.is_byte(i):
                self.bytes_[int(model.id_to_piece(i)[3:5], 16)] = p
                self.byte_place[int(model.id_to_piece(i)[3:5], 16)] = i
            else:
                self.pieces[model.id_to_piece(i)] = p
                self.place[model.id_to_piece(i)] = i
        self.longest = max(map(len, self.pieces), default=1)
        self.floor = -math.log(total)
        self.size = size
        # By a piece's first three characters the lengths of the pieces that a text
        # beginning so may begin with.
        ways: dict[str, set[int]] = {}
        for x in self.pieces:
            if len(x) > 2:
                ways.setdefault(x[:3], {1, 2}).add(len(x))
        self.ways = {x: tuple(sorted(k)) for x, k in ways.items()}
        self._hash_pieces()

    def _hash_pieces(self) -> None:
        """Pieces by 64-bit hashes of their characters, for arrays of words."""
        names = sorted(self.pieces)
        groups: dict[int, list[str]] = {}
        for x in names:
            groups.setdefault(len(x), []).append(x)
        hashes, scores, places = [], [], []
        for k, xs in groups.items():
            codes = _codes(xs, k)
            h = np.zeros(len(xs), np.uint64)
            for j in range(k):
                h = _step(h, codes[:, j])
            hashes.append(h)
            scores += [self.pieces[x] for x in xs]
            places += [self.place[x] for x in xs]
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat)
        self.hashes, self.scores = flat[order], np.array(scores, float)[order]
        self.places = np.array(places, np.int64)[order]
        self.maybe = np.zeros(1 << 18, bool)  # by a hash's upper bits: most substrings are no piece
        self.maybe[self.hashes >> np.uint64(46)] = True

    def _arcs(self, codes: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """(i, j) -> the words (rows of character codes) in which characters i to j are a
        piece, and which."""
        arcs, (many, n) = {}, codes.shape
        for i in range(n):
            h = np.zeros(many, np.uint64)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                h = _step(h, codes[:, j - 1])
                at = np.flatnonzero(self.maybe[h >> np.uint64(46)])
                if not len(at):
                    continue
                found = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
                own = self.hashes[found] == h[at]
                if own.any():
                    arcs[i, j] = at[own], found[own]
        return arcs

    def _by_length(self, words: list[bytes]):
        """Words in arrays of one length: (places in ``words``, character codes); and the
        places of those too long, or with a character that only bytes spell."""
        groups, odd = {}, []
        for at, w in enumerate(words):
            text = MARK + w.decode("utf-8", "replace")
            if len(text) > ARRAYS:
                odd.append(at)
            else:
                groups.setdefault(len(text), ([], []))
                groups[len(text)][0].append(at)
                groups[len(text)][1].append(text)
        return [(np.array(at), _codes(texts, n)) for n, (at, texts) in groups.items()], odd

    def _forward(self, text: str) -> list[float]:
        """ahead[i] is the log probability of all ways to spell the first i characters."""
        n, pieces, ways = len(text), self.pieces, self.ways
        ahead = [-math.inf] * (n + 1)
        ahead[0] = 0.0
        for i in range(n):
            here = ahead[i]
            if here == -math.inf:
                continue
            if text[i] not in pieces:  # a character outside the vocabulary: its bytes
                p = here + self._spelt(text[i])
                q = ahead[i + 1]
                ahead[i + 1] = p if q == -math.inf else max(p, q) + math.log1p(math.exp(-abs(p - q)))
            for k in ways.get(text[i:i + 3], (1, 2)):
                j = i + k
                if j > n:
                    break
                p = pieces.get(text[i:j])
                if p is None:
                    continue
                p += here
                q = ahead[j]
                ahead[j] = p if q == -math.inf else max(p, q) + math.log1p(math.exp(-abs(p - q)))
        return ahead

    def _spelt(self, char: str) -> float:
        return sum(self.bytes_.get(b, self.floor) for b in char.encode())

    def log_prob(self, word: bytes) -> float:
        """Forward recursion over the word's lattice, of any length."""
        return self._forward(MARK + word.decode("utf-8", "replace"))[-1]

    def expected(self, word: bytes, into) -> None:
        """Adds how often each piece stands in the word's segmentations, weighted by
        their probability (forward-backward)."""
        self._expected_log(MARK + word.decode("utf-8", "replace"), into)

    def _expected_log(self, text: str, into) -> None:
        """The same in log space, for words of any length and of bytes; arcs are
        looked up again instead of held."""
        n, pieces, ways = len(text), self.pieces, self.ways
        ahead = self._forward(text)
        back = [-math.inf] * (n + 1)
        back[n] = -ahead[n]
        for i in range(n - 1, -1, -1):
            here, of = ahead[i], -math.inf
            if here == -math.inf:
                continue
            arcs = []
            if text[i] not in pieces:
                spelt = self._spelt(text[i]) + back[i + 1]
                arcs.append(spelt)
                share = math.exp(here + spelt)
                for b in text[i].encode():
                    if b in self.byte_place:
                        into[self.byte_place[b]] += share
            for k in ways.get(text[i:i + 3], (1, 2)):
                j = i + k
                if j > n:
                    break
                p = pieces.get(text[i:j])
                if p is not None and back[j] != -math.inf:
                    arcs.append(p + back[j])
                    into[self.place[text[i:j]]] += math.exp(here + p + back[j])
            for p in arcs:
                of = p if of == -math.inf else max(p, of) + math.log1p(math.exp(-abs(p - of)))
            back[i] = of


class Lattices:
    """Lattices of the same pieces with a class's scores each; words in arrays, log space."""

    def __init__(self, model_path: str, counts: list[dict[int, float]], add: float = 1.0):
        self.each = [Lattice(model_path, c, add) for c in counts]
        self.scores = np.stack([x.scores for x in self.each], axis=1)
        self.places, self.size = self.each[0].places, self.each[0].size

    @staticmethod
    def _ahead(arcs: dict, many: int, n: int, scores: np.ndarray) -> np.ndarray:
        """The forward recursion for many words of one length: (character, word, class)."""
        ahead = np.full((n + 1, many, *scores.shape[1:]), -math.inf)
        ahead[0] = 0.0
        for (i, j), (at, piece) in sorted(arcs.items()):
            ahead[j, at] = np.logaddexp(ahead[j, at], ahead[i, at] + scores[piece])
        return ahead

    def _expected_of(self, codes: np.ndarray, k: int, weights: np.ndarray, into: np.ndarray) -> np.ndarray:
        """Forward and backward for words of one length in class ``k``; says which words have no path."""
        many, n = codes.shape
        arcs, scores = self.each[0]._arcs(codes), self.scores[:, k]
        ahead = self._ahead(arcs, many, n, scores)
        whole = ahead[n] > -math.inf
        back = np.full(ahead.shape, -math.inf)
        back[n, whole] = -ahead[n, whole]
        places, shares = [np.zeros(0, np.int64)], [np.zeros(0)]
        for (i, j), (own, piece) in sorted(arcs.items(), reverse=True):
            step = scores[piece] + back[j, own]
            back[i, own] = np.logaddexp(back[i, own], step)
            places.append(self.places[piece])
            shares.append(np.exp(ahead[i, own] + step) * weights[own])
        into += np.bincount(np.concatenate(places), weights=np.concatenate(shares), minlength=self.size)
        return ~whole

    def log_probs(self, words: list[bytes]) -> np.ndarray:
        """:meth:`Lattice.log_prob` of each word and class; equal words are computed once."""
        once = {w: i for i, w in enumerate(dict.fromkeys(words))}
        own = list(once)
        out = np.full((len(own), len(self.each)), -math.inf)
        arrays, odd = self.each[0]._by_length(own)
        for at, codes in arrays:
            out[at] = self._ahead(self.each[0]._arcs(codes), *codes.shape, self.scores)[codes.shape[1]]
        # A character without a piece leaves a word without a path.
        for at in [*odd, *np.flatnonzero(out[:, 0] == -math.inf).tolist()]:
            out[at] = [x.log_prob(own[at]) for x in self.each]
        return out[[once[w] for w in words]] if words else out

    def expected_all(self, words: list[bytes], weights: np.ndarray, into: np.ndarray) -> None:
        """:meth:`Lattice.expected` of all words, times their weight in each class, into
        (class, piece)."""
        arrays, odd = self.each[0]._by_length(words)
        for at, codes in arrays:
            lost = np.zeros(len(at), bool)
            for k in range(len(self.each)):  # most words are of one class
                own = np.flatnonzero(weights[at, k])
                if len(own):
                    lost[own] |= self._expected_of(codes[own], k, weights[at[own], k], into[k])
            odd += at[lost].tolist()
        for at in odd:
            for k in np.flatnonzero(weights[at]):
                self.each[k].expected(words[at], into[k])


def _smoothed(counts: np.ndarray) -> list[dict[int, float]]:
    """Piece counts of each class, with those of all classes as PRIOR further pieces."""
    every = counts.sum(axis=0) + 1
    blended = counts + PRIOR * every / every.sum()
    return [dict(enumerate(x)) for x in blended.tolist()]


def refine(counts: DataFrame, model_path: str, hard: dict[int, int], classes: int = 1) -> list[dict[int, float]]:
    """The piece counts of each class after ROUNDS of expectation maximisation over all
    segmentations of all its distinct words (column ``by``; without it, of all words), begun at
    ``hard``; one number for each piece and class comes back from a round."""
    small_batches(counts.sparkSession)
    of = F.col("by") if "by" in counts.columns else F.array(F.lit(1).cast("long"))
    rows = counts.select("word", of.alias("by"))
    size = max(hard, default=0) + 1
    now = None
    for _ in range(ROUNDS):
        start = [hard] * classes if now is None else now
        sent = counts.sparkSession.sparkContext.broadcast(start)
        first = now is None

        def expect(batches: Iterator[pa.RecordBatch], sent=sent, first=first) -> Iterator[pa.RecordBatch]:
            lattices = Lattices(model_path, sent.value, 1.0 if first else LEAST)
            total = np.zeros((classes, lattices.size))
            for t in _gathered(batches):
                by = np.array(t.column("by").to_pylist(), np.int64).reshape(t.num_rows, classes)
                lattices.expected_all(t.column("word").to_pylist(), (by > 0).astype(float), total)
            k, piece = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(piece, pa.int32()),
                                              pa.array(total[k, piece])], ["class", "piece", "n"])

        got = (rows.mapInArrow(expect, "class int, piece int, n double")
               .groupBy("class", "piece").agg(F.sum("n").alias("n")).collect())
        size = max([size, *[r["piece"] + 1 for r in got]])
        raw = np.zeros((classes, size))
        for r in got:
            raw[r["class"], r["piece"]] = r["n"]
        now = _smoothed(raw)
    return now


def with_lattice(counts: DataFrame, lattice) -> DataFrame:
    """The rows with one more column: each word's log probability over the lattice of
    each class."""
    small_batches(counts.sparkSession)
    model_path, pieces = lattice
    sent = counts.sparkSession.sparkContext.broadcast(pieces)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(model_path, sent.value, LEAST)
        for t in _gathered(batches):
            p = lattices.log_probs(t.column("word").to_pylist())
            column = pa.array(list(p), pa.list_(pa.float64()))
            yield from t.append_column("lattice", column).to_batches()

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema.fields)
    return counts.mapInArrow(add, f"{fields}, lattice array<double>")


def _head(vocab: DataFrame) -> tuple[list, int]:
    """The words of the highest levels of frequency, HEAD at most, and the level
    below which words are not among them."""
    levels = {r["level"]: r["many"] for r in
              vocab.groupBy("level").agg(F.count(F.lit(1)).alias("many")).collect()}
    many, least = 0, max(levels, default=0) + 1
    for level in sorted(levels, reverse=True):
        many += levels[level]
        if many > HEAD:
            break
        least = level
    return vocab.where(F.col("level") >= least).collect(), least


class Mixture:
    """log10 P(token | class): the class's own share of its training tokens, backed
    by the share of all training tokens, backed by the lattice."""

    def __init__(self, n: int, v: int, by: list[tuple[int, int, int]]):
        #: Of each class: tokens, distinct words, texts.
        self.n, self.v, self.by = n, max(v, 1), [(a, max(b, 1), t) for a, b, t in by]
        texts = sum(t for _, _, t in by) + len(by)
        self.priors = [math.log10((t + 1) / texts) for _, _, t in by]

    def base(self, c: int, v: int) -> float:
        return math.log10((c + 1) / (self.n + v + 1))

    def log10(self, c: int, by: list[int], lattice: list[float]) -> list[float]:
        n, v = self.n, self.v
        out = []
        for own, p, (a, b, _) in zip(by, lattice, self.by):
            if c:
                out.append(math.log10((own + b * (c + v * math.exp(p)) / (n + v)) / (a + b)))
            else:
                out.append(math.log10(b) + math.log10(v) + p / math.log(10) - math.log10(n + v) - math.log10(a + b))
        return out

    def columns(self, c: str, by: str, lattice: str) -> list[Column]:
        """The same in Spark."""
        n, v = self.n, self.v

        def of(k: int, a: int, b: int) -> Column:
            p = F.col(lattice)[k]
            unseen = math.log10(v) - math.log10(n + v) + math.log10(b) - math.log10(a + b)
            every = (F.col(c) + v * F.exp(p)) / F.lit(float(n + v))
            return (F.when(F.col(c) > 0, F.log10((F.col(by)[k] + b * every) / F.lit(float(a + b))))
                    .otherwise(F.lit(unseen) + p / math.log(10)))

        return [of(k, a, b) for k, (a, b, _) in enumerate(self.by)]


def score(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
          class_col: str | None = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score."""
    spark = docs.sparkSession
    small_batches(spark)
    label = F.col(class_col) if class_col else F.lit(None).cast("string")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       label.cast("string").alias("label"),
                       (fold_of(id_col, FOLDS) == HELD_OUT).alias("held_out"))
    train = docs.where(~F.col("held_out"))
    sizes = [(r["label"], r["n"]) for r in
             train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "label").limit(CLASSES - 1).collect() if r["label"] is not None]
    known = [x for x, _ in sizes]
    rest = len(known)  # the class of all other texts
    klass = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in known]).cast("array<string>"),
                                        F.col("label")) - 1, F.lit(rest)).cast("int")
    klass = F.when(klass < 0, rest).otherwise(klass)
    train = train.withColumn("class", klass)
    counts = keep_table(word_counts(train, rest + 1), "word-counts")
    lattice = (model_path, refine(counts, model_path, piece_counts(counts, model_path), rest + 1))
    ends = {r["class"]: r["n"] for r in
            train.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    end_by = [ends.get(k, 0) for k in range(rest + 1)]
    end = sum(end_by)
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v"), *[
        x for k in range(rest + 1) for x in
        (F.coalesce(F.sum(F.col("by")[k]), F.lit(0)).alias(f"n{k}"),
         F.count(F.when(F.col("by")[k] > 0, 1)).alias(f"v{k}"))]).first()
    # The end is a token too.
    n, v = whole["n"] + end, whole["v"] + (end > 0)
    mix = Mixture(n, v, [(whole[f"n{k}"] + e, whole[f"v{k}"] + (e > 0), e)
                         for k, e in enumerate(end_by)])

    # A word's base and its shares in the classes, once for each distinct word.
    shares = F.array(F.log10((F.col("c") + 1) / F.lit(float(n + v + 1))), *mix.columns("c", "by", "lattice"))
    # Levels of frequency, some twenty to a factor of e: at most a thousand.
    vocab = keep_table(with_lattice(counts, lattice).select(
        "word", "c", shares.alias("s"), F.floor(20 * F.log("c")).cast("int").alias("level")), "vocabulary")
    drop_table(counts)

    head, least = _head(vocab)
    place = {bytes(r["word"]): i for i, r in enumerate(head)}
    table = np.array([r["s"] for r in head], float).reshape(len(head), rest + 2)
    floors = [x.floor for x in Lattices(*lattice, LEAST).each]
    finish = np.array([mix.base(end, v), *mix.log10(end, end_by, floors)])
    sent = spark.sparkContext.broadcast((place, table, finish, end > 0))
    schema = ("row long, doc_id long, held_out boolean, tokens long, sure long, sums array<double>, "
              "words array<binary>, times array<int>")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (place, table, finish, end_sure), row = sent.value, 0
        task, get = TaskContext.get().partitionId(), place.get
        for ids, held, texts in columns_of(batches, "doc_id", "held_out", "text"):
            out = []
            for doc_id, out_of, t in zip(ids, held, texts):
                at, often, words, times = [], [], [], []
                for w, k in Counter(words_of(t)).items():
                    i = get(w)
                    if i is None:
                        words.append(w)
                        times.append(k)
                    else:
                        at.append(i)
                        often.append(k)
                sums = finish + (np.array(often, float) @ table[at] if at else 0.0)
                sure = sum(often)
                out.append((task << 33 | row, doc_id, out_of, sure + 1, sure + end_sure,
                            sums.tolist(), words, times))
                row += 1
            cols = list(zip(*out)) or [()] * 8
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(),
                     pa.list_(pa.float64()), pa.list_(pa.binary()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             [f.split()[0] for f in schema.split(", ")])

    texts = keep_table(docs.select("doc_id", "held_out", "text").mapInArrow(read, schema), "texts")

    # Words outside the head meet their counts; those never seen get their lattice.
    rare = (texts.select("row", F.explode(F.arrays_zip("words", "times")).alias("r"))
            .select(F.col("r.words").alias("word"), "row", F.col("r.times").alias("times")))
    tail = vocab.where(F.col("level") < least).select("word", "c", "s")
    seen = rare.join(tail, "word")
    new = with_lattice(rare.join(tail, "word", "left_anti"), lattice).withColumns({
        "c": F.lit(0).cast("long"), "by": F.array(*[F.lit(0).cast("long")] * (rest + 1))})
    every = seen.select("row", "times", "c", "s").unionByName(new.select("row", "times", "c", shares.alias("s")))
    per_text = every.groupBy("row").agg(
        F.sum("times").alias("t_tokens"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("t_sure"),
        *[F.sum(F.col("times") * F.col("s")[i]).alias(f"t{i}") for i in range(rest + 2)])

    def plus(a: Column, b: str) -> Column:
        return a + F.coalesce(F.col(b), F.lit(0))

    joined = texts.drop("words", "times").join(per_text, "row", "left")
    of_class = F.array(*[plus(F.col("sums")[k + 1], f"t{k + 1}") + mix.priors[k]
                         for k in range(rest + 1)])
    joined = joined.withColumn("of", of_class).withColumn("top", F.array_max("of"))
    # The class is not known: its probabilities add up.
    total = F.aggregate("of", F.lit(0.0), lambda s, x: s + F.pow(F.lit(10.0), x - F.col("top")))
    return joined.select(
        "doc_id", "held_out", plus(F.col("tokens"), "t_tokens").alias("n_tokens"),
        plus(F.col("sure"), "t_sure").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        plus(F.col("sums")[0], "t0").alias("base_score"), (F.col("top") + F.log10(total)).alias("score"))
