"""Benchmark decontamination: CGK embedding, bit-sampling LSH, edit verification.

Texts are read as words: A-Z lower-cased, split at white space, punctuation and
control characters of all Unicode and at all ASCII characters but letters and
digits. Characters of scripts written without spaces (Chinese, Japanese, Thai, Lao,
Burmese, Khmer and others) and non-ASCII symbols are words of one character each;
no space is put between them when characters are compared. The CGK random walk copies the word under a
pointer at every step and moves the pointer on by a random bit of (step, word);
two sequences at a small edit distance then agree in most of their copied words,
so edit distance becomes Hamming distance. Sampling SAMPLED of the copied words
is an LSH for it, with WALKS walks of DRAWS samples each. Windows are of a fixed
width and not the item's, so recall grows with an item's length:
:func:`least_words` computes, by trials on made items with 2 * EDITS of their words
altered, the length from which RECALL is reached. Shorter items are not left to
the LSH: an occurrence that verification accepts keeps all but 2 * EDITS of an
item's words, so of any so many words and NEED more it holds NEED. Those rarest in
the block are looked up word by word, and none is missed whose words are shifted by
EDITS of them at most.

Windows of a document begin at every STRIDE-th word. An item's copy may begin
anywhere, so the item is indexed from each of its first words on, through the
last window that still fits: whatever the copy's place, some windows of it
coincide with indexed ones, each a further try. A hit gives the item and its
implied place; a window of the item's size there, with room for the edits
allowed, is verified by the exact edit distance of words, then of characters.

The walk is vectorised over all windows of some documents at once. Items are
taken in blocks of at most BLOCK; a block is what a task holds and what is
broadcast, so neither grows with the benchmark. Documents never move.

Defined cases: NULL or empty texts hold no item; items with fewer words than
WINDOW + STRIDE, of which few windows lie inside, are also searched by their
whole word sequence; NULL or empty items are
ignored; items of equal text are all reported; texts of any length are read
whole; an empty table on either side gives an empty result. Other columns are
ignored by :func:`find`, carried along by :func:`drop_contaminated`.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tapeworks.llm.common import Memo, columns_of, small_batches

#: Share of an item's words, and characters, that an occurrence may differ in.
EDITS = 0.2
#: Words that a walk starts over; steps of a walk; windows begin so many words apart.
WINDOW, STEPS, STRIDE = 8, 12, 4
#: Share of the items at the accepted threshold that the LSH has to find by itself;
#: made items that decide it; hits that an item searched by its words has to have.
RECALL, TRIALS, NEED = 0.95, 400, 3
#: Copied words sampled for a key (one of each stretch of STEPS / SAMPLED steps),
#: samples of a walk, walks.
SAMPLED, DRAWS, WALKS = 4, 2, 4
#: Items of one block.
BLOCK = 20_000
#: Words of the documents that one call of the walk takes.
CHUNK = 1 << 20
SEED = 20_240_229

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: ASCII bytes that separate words.
_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
_TO_SPACE = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))
#: Blocks of scripts written without spaces between words.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF),
             (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x312F),
             (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF),
             (0xAA00, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF))


class _Alone(dict):
    """For str.translate: separators become a space, characters that are words get
    spaces around them. Holds the characters met."""

    def __missing__(self, c: int) -> int | str:
        kind = unicodedata.category(chr(c))
        if c > 127 and (kind[0] in "ZP" or kind == "Cc" or c in (0x200B, 0x2060, 0xFEFF)):
            self[c] = " "
        elif c > 127 and (kind[0] == "S" or any(a <= c <= b for a, b in _UNSPACED)):
            self[c] = f" {chr(c)} "
        else:
            self[c] = c
        return self[c]


_ALONE = _Alone()


def words(text: str | None) -> list[bytes]:
    if not text:
        return []
    if not text.isascii():
        text = text.translate(_ALONE)
    return text.encode("utf-8", "surrogatepass").lower().translate(_TO_SPACE).split()


def _characters(some: list[bytes]) -> np.ndarray:
    text = b" ".join(some).decode("utf-8", "replace")
    if not text.isascii():
        parts, alone = [], False
        for w in text.split(" "):
            before, alone = alone, len(w) == 1 and isinstance(_ALONE[ord(w)], str)
            parts += [w] if before and alone or not parts else [" ", w]
        text = "".join(parts)
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def word_ids() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def draws(seed: int = SEED) -> list[list[np.ndarray]]:
    """For each walk the steps that each of its samples looks at."""
    rng = np.random.default_rng(seed)
    stretch = STEPS // SAMPLED
    return [[np.arange(SAMPLED) * stretch + rng.integers(0, stretch, SAMPLED)
             for _ in range(DRAWS)] for _ in range(WALKS)]


def lsh_keys(ids: np.ndarray, starts: np.ndarray, samples) -> Iterator[np.ndarray]:
    """The key of every window (its first word's place in ``ids``), one array for
    each sample of each walk. ``ids`` needs STEPS words after the last start."""
    for walk, draw in enumerate(samples):
        # A word's 64 bits of a walk decide whether it is left at step 0, 1, ...
        bits = (ids ^ np.uint64((walk + 1) * int(_M2) % (1 << 64))) * _M1
        bits ^= bits >> np.uint64(31)
        at = starts.copy()
        keys = [np.full(len(starts), 64 * walk + d, np.uint64) for d in range(len(draw))]
        for step in range(STEPS):
            for key, steps in zip(keys, draw):
                if step in steps:
                    key += ids[at]
                    key *= _M1
                    key ^= key >> np.uint64(32)
            if step < STEPS - 1:
                at += ((bits[at] >> np.uint64(step + 8)) & np.uint64(1)).astype(np.int64)
        yield from keys


def lsh_recall(n: int, seed: int = SEED) -> float:
    """Share of made items of n words that the LSH finds when as many words are
    altered as verification accepts."""
    rng = np.random.default_rng(seed + n)
    size = STRIDE + n + STRIDE + STEPS
    item, doc = rng.integers(0, 1 << 63, (2, TRIALS, size)).astype(np.uint64)
    altered = rng.permuted(np.arange(n) < int(2 * EDITS * n) + np.zeros((TRIALS, 1)), axis=1)
    phase = rng.integers(0, STRIDE, TRIALS)
    row = np.arange(TRIALS)
    for i in range(n):
        doc[row, phase + i] = np.where(altered[:, i], doc[row, phase + i], item[:, i])
    item[:, n:] = 0
    first = row[:, None] * size
    own = lsh_keys(item.ravel(), (first + np.arange(max(n - WINDOW + 1, STRIDE))).ravel(), draws())
    seen = lsh_keys(doc.ravel(), (first + np.arange(0, n + STRIDE, STRIDE)).ravel(), draws())
    found = np.zeros(TRIALS, bool)
    for a, b in zip(own, seen):
        a, b = a.reshape(TRIALS, -1), b.reshape(TRIALS, -1)
        found |= (a[:, :, None] == b[:, None, :]).any(axis=(1, 2))
    return float(found.mean())


@cache
def least_words() -> int:
    """Words of an item from which the LSH reaches RECALL."""
    n = 16
    while lsh_recall(n) < RECALL:
        n = n * 5 // 4
    return n


def _edit_rows(a, b: np.ndarray) -> int:
    """Least edit distance of ``a`` to any part of ``b``."""
    row = np.zeros(len(b) + 1, np.int64)
    slope = np.arange(len(b) + 1)
    for i, x in enumerate(a, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (b != x))
        # Insertions run along the row.
        row = np.minimum.accumulate(new - slope) + slope
    return int(row.min())


class Index:
    """A block of items: keys of their windows, and the items to verify with."""

    def __init__(self, items: list[tuple]):
        self.samples, ids = draws(), word_ids()
        self.items, parts = [], []
        for item_id, text in items:
            w = words(text)
            if w:
                self.items.append((item_id, w, np.array([ids[x] for x in w], np.uint64)))
        owner, offset, flat, starts = [], [], [], []
        for k, (_, w, h) in enumerate(self.items):
            # As far as a window fits, and to every place that a window may begin at.
            n = min(len(w), max(len(w) - WINDOW + 1, STRIDE))
            base = sum(map(len, flat))
            flat.append(np.concatenate([h, np.zeros(STEPS, np.uint64)]))
            starts.append(base + np.arange(n))
            owner.append(np.full(n, k))
            offset.append(np.arange(n))
        self._by_words()
        self.short = [k for k, (_, w, _) in enumerate(self.items) if len(w) < WINDOW + STRIDE]
        self.keys = []
        if flat:
            self.owner, self.offset = np.concatenate(owner), np.concatenate(offset)
            for key in lsh_keys(np.concatenate(flat), np.concatenate(starts), self.samples):
                order = np.argsort(key, kind="stable")
                seen = np.zeros(1 << 18, bool)
                seen[key & np.uint64((1 << 18) - 1)] = True
                self.keys.append((key[order], order, seen))

    def _by_words(self) -> None:
        """Postings of the rarest words of the items too short for the LSH."""
        often = Counter(x for _, _, h in self.items for x in h.tolist())
        word, which, offset = [], [], []
        self.need, self.drift = (np.zeros(len(self.items), np.int64) for _ in range(2))
        for k, (_, w, h) in enumerate(self.items):
            if len(w) < least_words():
                spare = int(2 * EDITS * len(w))
                rare = sorted(range(len(w)), key=lambda i: (often[int(h[i])], int(h[i]), i))[:spare + NEED]
                self.need[k], self.drift[k] = len(rare) - spare, spare
                word += h[rare].tolist()
                which += [k] * len(rare)
                offset += rare
        word = np.array(word, np.uint64)
        order = np.argsort(word, kind="stable")
        self.word, self.word_item = word[order], np.array(which, np.int64)[order]
        self.word_offset, self.word_seen = np.array(offset, np.int64)[order], np.zeros(1 << 18, bool)
        self.word_seen[word & np.uint64((1 << 18) - 1)] = True

    def word_hits(self, ids: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Items, documents and places at which NEED of an item's rare words (all, if
        it has fewer) stand on diagonals as near as its edits allow."""
        maybe = np.flatnonzero(self.word_seen[ids & np.uint64((1 << 18) - 1)])
        lo = np.searchsorted(self.word, ids[maybe], "left")
        many = np.searchsorted(self.word, ids[maybe], "right") - lo
        at = np.repeat(maybe, many)
        which = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item, place = self.word_item[which], at - self.word_offset[which]
        doc = np.searchsorted(base, at, "right") - 1
        order = np.lexsort((place, doc, item))
        item, doc, place = item[order], doc[order], place[order]
        good = np.zeros(len(item), bool)
        for need in range(1, NEED + 1):
            last = np.arange(len(item)) + need - 1
            ok = np.flatnonzero((self.need[item] == need) & (last < len(item)))
            end = last[ok]
            ok = ok[(item[end] == item[ok]) & (doc[end] == doc[ok])
                    & (place[end] - place[ok] <= self.drift[item[ok]])]
            for i in range(need):
                good[ok + i] = True
        return item[good], doc[good], place[good]

    def hits(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows (their places in ``starts``) that point to an item, the item, and
        the offset in it."""
        at, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for key, (known, order, seen) in zip(lsh_keys(ids, starts, self.samples), self.keys):
            maybe = np.flatnonzero(seen[key & np.uint64((1 << 18) - 1)])
            lo = np.searchsorted(known, key[maybe], "left")
            many = np.searchsorted(known, key[maybe], "right") - lo
            at.append(np.repeat(maybe, many))
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            which.append(order[np.repeat(lo, many) + nth])
        at, which = np.concatenate(at), np.concatenate(which)
        return at, self.owner[which], self.offset[which]

    def likely(self, k: int, place: np.ndarray, first: np.ndarray, last: np.ndarray,
               ids: np.ndarray) -> np.ndarray:
        """Which places, each in a document of ids[first:last], have enough words of
        the item in its window: words in common bound the edits of words."""
        _, w, h = self.items[k]
        room = int(EDITS * len(w)) + 1
        span = place[:, None] + np.arange(-room, len(w) + room)
        inside = (span >= first[:, None]) & (span < last[:, None])
        own = np.sort(h)
        seen = ids[np.where(inside, span, 0)]
        hit = own[np.minimum(np.searchsorted(own, seen), len(own) - 1)] == seen
        return (hit & inside).sum(axis=1) >= (1 - 2 * EDITS) * len(w)

    def verify(self, k: int, first: int, last: int, ids: np.ndarray,
               doc_words: list[bytes]) -> int | None:
        """Characters to edit, if few enough, of the item that begins at about the
        words ``first`` to ``last`` of a document."""
        _, w, h = self.items[k]
        room = int(EDITS * len(w)) + 1
        lo, hi = max(0, first - room), min(len(doc_words), last + len(w) + room)
        if hi <= lo or _edit_rows(h, ids[lo:hi]) > 2 * EDITS * len(w):
            return None
        item, window = _characters(w), _characters(doc_words[lo:hi])
        edits = _edit_rows(item, window)
        return edits if edits <= EDITS * len(item) else None

    def exact(self, k: int, place: int, ids: np.ndarray) -> bool:
        h = self.items[k][2]
        return 0 <= place and place + len(h) <= len(ids) and bool((ids[place:place + len(h)] == h).all())

    def find(self, doc_words: list[list[bytes]], memo: Memo) -> list[tuple[int, int, int, int]]:
        """(document's place in the list, item's place, edits, first word)."""
        sizes = np.array([len(w) for w in doc_words])
        base = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.fromiter(map(memo.__getitem__, (x for w in doc_words for x in w)), np.uint64, base[-1])
        best: dict[tuple[int, int], tuple[int, int]] = {}

        def tried(d: int, k: int, places: list[int]) -> None:
            own = ids[base[d]:base[d + 1]]
            for place in places:
                if self.exact(k, place, own):
                    best[d, k] = (0, place)
                    return
            # Places that lie close together are one place with more room.
            room = int(EDITS * len(self.items[k][1])) + 1
            while places:
                n = 1
                while n < len(places) and places[n] - places[n - 1] <= room:
                    n += 1
                edits = self.verify(k, places[0], places[n - 1], own, doc_words[d])
                if edits is not None and edits < best.get((d, k), (1 << 30, 0))[0]:
                    best[d, k] = (edits, max(places[0], 0))
                places = places[n:]

        # Windows begin at multiples of STRIDE from each document's first word.
        starts = np.concatenate([np.arange(a, b, STRIDE) for a, b in zip(base[:-1], base[1:])]
                                or [np.zeros(0, np.int64)])
        padded = np.concatenate([ids, np.zeros(STEPS, np.uint64)])
        if self.keys and len(starts):
            at, item, offset = self.hits(padded, starts)
            place = starts[at] - offset
            doc = np.searchsorted(base, starts[at], "right") - 1
            if len(self.word):
                item, doc, place = (np.concatenate(x) for x in
                                    zip((item, doc, place), self.word_hits(ids, base)))
            item, doc, place = np.unique(np.stack([item, doc, place]), axis=1)
            for k in np.unique(item).tolist():
                own = item == k
                p, d = place[own], doc[own]
                good = self.likely(k, p, base[d], base[d + 1], ids)
                p, d = p[good], d[good]
                for y in np.unique(d).tolist():
                    tried(y, k, sorted((p[d == y] - base[y]).tolist()))
        for k in self.short:
            h = self.items[k][2]
            at = np.flatnonzero(ids == h[0])
            for i, x in enumerate(h[1:], 1):
                at = at[at + i < len(ids)]
                at = at[ids[at + i] == x]
            for place in at:
                d = int(np.searchsorted(base, place, "right")) - 1
                if place + len(h) <= base[d + 1]:
                    tried(d, k, [int(place - base[d])])
        return [(d, k, edits, place) for (d, k), (edits, place) in sorted(best.items())]


def _chunks(texts: list) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of consecutive texts, about CHUNK words at a time."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(words(t))
        size += len(held[-1])
        if size >= CHUNK or i == len(texts) - 1:
            yield first, held
            first, held, size = i + 1, [], 0


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list]:
    """The items, at most about BLOCK at a time."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"),
                             F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    n = -(-items.count() // BLOCK)
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else items
        yield [(r["item_id"], r["text"]) for r in part.collect()]


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, first_word): the items that each document holds."""
    spark = docs.sparkSession
    small_batches(spark)
    schema = "doc_id long, item_id long, edits int, first_word int"
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = spark.createDataFrame([], schema)
    for n, block in enumerate(blocks(benchmark)):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index, memo = Index(sent.value), word_ids()
            for ids, texts in columns_of(batches, "doc_id", "text"):
                rows = [(ids[first + d], index.items[k][0], edits, place)
                        for first, held in _chunks(texts)
                        for d, k, edits, place in index.find(held, memo)]
                cols = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                    ["doc_id", "item_id", "edits", "first_word"])

        found = docs.mapInArrow(search, schema)
        out = found if n == 0 else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns, no shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    out = docs
    for block in blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index, memo = Index(sent.value), word_ids()
            for b in batches:
                (texts,) = next(columns_of([b], text_col))
                dirty = {first + d for first, held in _chunks(texts)
                         for d, *_ in index.find(held, memo)}
                yield b.filter(pa.array([i not in dirty for i in range(len(texts))], pa.bool_()))

        out = out.mapInArrow(clean, out.schema)
    return out
