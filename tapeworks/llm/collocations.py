"""Phrase collocation mining: phrases of up to five words, counted in HAT-tries.

A text is lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those
into words ``[^\\x20\\x09]+``. A phrase is a run of words inside one piece; all
counts are per language (NULL: ``und``).

* **Counting.** A task numbers the words it meets and counts phrases in a HAT-trie
  (:class:`HatTrie`): a shallow trie over word ids whose leaves are hash containers
  of phrase endings; a container that outgrows ``BURST`` becomes a node with a
  container for each next word. When the trie holds ``ENTRIES`` phrases, its largest
  subtrees leave it whole as sorted runs, cut by prefix partition (a hash of the first
  three words, so that one very common word or pair is not one task's). Runs travel packed
  and are merged in their prefix partition.
* **Levels.** A phrase stands at most as often as each phrase inside it. So what may
  reach ``least`` is found first, by hashes in packed arrays of (slot, count) that are summed
  by ranges of slots (:mod:`tapeworks.llm.slots`): words, then pairs of such words, then phrases of three
  to five words all of whose pairs are such. The tries then count the words and phrases whose
  slots reach ``least``. The tasks are told by bitmaps of a fixed size (``BITS``). A clash of
  hashes only makes a task count a phrase in vain, so the counts of all phrases at or
  above ``least`` are exact.
* **Scores.** Cutting a phrase after k words gives the counts l and r of its parts,
  found by joins on the phrase; ``floor(1000*a*n/(l*r))`` is computed in decimals of
  38 digits (exact while ``1000*a*n`` has that many), and the lowest cut counts.
* **Contained phrases.** A phrase that stands as often inside a longer candidate as
  altogether also stands so inside a candidate one word longer, so one grouped
  maximum over the two phrases that are a word shorter than each candidate finds them.
* **Best phrases.** Ranked within hashed shares of a language first, then among the
  best of the shares; no task sees all phrases of a language.

Defined cases: a NULL or empty text has no words; a NULL language counts as
``und`` together with rows that say so; repeated rows count each; ids and other
columns are not read; a text is handled whole, whatever its length; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from tapeworks.llm.common import keep_table, small_batches
from tapeworks.llm.slots import KEYS, SLOTS, bitmap, chunks_for, frequent, has, packed, slots_of

#: Words of the longest phrase.
LONGEST = 5
#: Least count of a candidate.
LEAST = 100
#: Phrases of a language that are returned.
BEST = 2000
#: Bits of the bitmap of frequent phrases: 8 MB, whatever the input.
BITS = 1 << 26
#: Phrases of a hash container before it bursts; depth below which none does.
BURST, SHALLOW = 4096, 2
#: Phrases held by a task before subtrees are spilled.
ENTRIES = 400_000
#: Words whose number a task remembers.
WORDS = 400_000
#: Shares of a language in the ranking.
SPREAD = 64

_CUT = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
_RUNS = "part int, lang string, phrases binary, times binary"


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as lower-cased UTF-8, in order, with ``b"\\n"`` where a piece ends."""
    flat = (text or "").encode("utf-8", "surrogatepass").lower().translate(_CUT)
    return list(filter(None, flat.replace(b"\n", b" \n ").split(b" ")))


class _Node(dict):
    """A trie node: next word id -> node or container; ``n`` counts the phrase that ends here."""

    n = 0


class HatTrie:
    """Counts of phrases (tuples of word ids)."""

    def __init__(self, burst: int = BURST, shallow: int = SHALLOW):
        self.root, self.size, self.burst, self.shallow = _Node(), 0, burst, shallow

    def add(self, phrase: tuple, times: int = 1) -> None:
        node, at = self.root, 0
        while True:
            if at == len(phrase):
                self.size += not node.n
                node.n += times
                return
            below = node.get(phrase[at])
            at += 1
            if below is None:
                below = node[phrase[at - 1]] = {}
            if type(below) is dict:
                break
            node = below
        rest = phrase[at:]
        n = below.get(rest)
        if n is not None:
            below[rest] = n + times
            return
        below[rest] = times
        self.size += 1
        if len(below) > self.burst and at <= self.shallow:
            node[phrase[at - 1]] = self._burst(below)

    @staticmethod
    def _burst(container: dict) -> _Node:
        node = _Node()
        for rest, n in container.items():
            if rest:
                node.setdefault(rest[0], {})[rest[1:]] = n
            else:
                node.n = n
        return node

    def _phrases(self, below, head: tuple) -> Iterator[tuple[tuple, int]]:
        if type(below) is dict:
            yield from ((head + rest, n) for rest, n in below.items())
            return
        if below.n:
            yield head, below.n
        for word, deeper in below.items():
            yield from self._phrases(deeper, head + (word,))

    def spill(self, keep: int = 0) -> Iterator[list[tuple[tuple, int]]]:
        """Whole subtrees of first words, largest first, until ``keep`` phrases stay."""
        def held(below) -> int:
            return len(below) if type(below) is dict else bool(below.n) + sum(map(held, below.values()))

        for word in sorted(self.root, key=lambda w: held(self.root[w]), reverse=True):
            if self.size <= keep:
                return
            run = list(self._phrases(self.root.pop(word), (word,)))
            self.size -= len(run)
            yield run


def _packed_runs(rows: list[tuple[str, bytes, int]], parts: int) -> pa.RecordBatch:
    """Sorted runs of (lang, phrase, count), one row for each prefix partition: phrases
    joined by line ends (no word holds one) and their counts."""
    runs: dict[tuple[int, str], tuple[list, list]] = {}
    for lang, phrase, n in sorted(rows):
        prefix = phrase if phrase.count(b" ") < 3 else b" ".join(phrase.split(b" ", 3)[:3])
        run = runs.setdefault((xxhash.xxh32_intdigest(prefix) % parts, lang), ([], []))
        run[0].append(phrase)
        run[1].append(n)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in runs], pa.int32()), pa.array([k[1] for k in runs], pa.string()),
         pa.array([b"\n".join(p) for p, _ in runs.values()], pa.binary()),
         pa.array([np.array(n, "<i8").tobytes() for _, n in runs.values()], pa.binary())],
        ["part", "lang", "phrases", "times"])


def _merged(runs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, n) of the phrases that stand ``least`` times; the runs of a prefix partition are
    merged in one task. The empty phrase, whose count is that of a language's words, gets NULL."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, Counter()

        def out() -> pa.RecordBatch:
            own = [(p, n) for p, n in held.items() if n >= least or not p]
            return pa.RecordBatch.from_arrays(
                [pa.array([current[1]] * len(own) if own else [], pa.string()),
                 pa.array([p or None for p, _ in own], pa.binary()).cast(pa.string()),
                 pa.array([n for _, n in own], pa.int64())], ["lang", "phrase", "n"])

        for b in batches:
            for part, lang, phrases, times in zip(*(b.column(c).to_pylist() for c in ("part", "lang", "phrases", "times"))):
                if (part, lang) != current:
                    yield out()
                    current, held = (part, lang), Counter()
                for p, n in zip(phrases.split(b"\n"), np.frombuffer(times, "<i8").tolist()):
                    held[p] += n
        yield out()

    return (runs.repartition("part").sortWithinPartitions("part", "lang")
            .mapInArrow(run, "lang string, phrase string, n long"))


def _said(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).alias("text"))


def _word_slots(chunks: int, least: int):
    """Packed (slot, count) arrays of a task's words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            hashes, times = [], []
            for lang, words in seen.items():
                hash_word = functools.partial(xxhash.xxh64_intdigest, seed=_seed(lang))
                hashes += map(hash_word, words)
                times += words.values()
            seen.clear()
            return packed(slots_of(np.array(hashes, dtype=np.uint64)), chunks, least, np.array(times, dtype=np.int64))

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                for at in range(0, len(words), WORDS):
                    own = seen.setdefault(lang, Counter())
                    own.update(words[at:at + WORDS])
                    del own[b"\n"]
                    if len(own) > WORDS:
                        yield out()
            if sum(map(len, seen.values())) > WORDS:
                yield out()
        yield out()

    return run


def _seed(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), seed=42)


class _Numbers(dict):
    """Word -> number in this task, for the words of one language; 0 for a word that is not frequent."""

    def __init__(self, lang: str, frequent: np.ndarray, bits: int, names: list, hashes: list):
        super().__init__({b"\n": 0})
        self.lang, self.frequent, self.bits, self.names, self.hashes = lang, frequent.tobytes(), bits, names, hashes
        self.seed = _seed(lang)

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, seed=self.seed)
        s = (h >> 24) % self.bits
        i = 0
        if self.frequent[s >> 3] >> (s & 7) & 1:
            i = len(self.names)
            self.names.append((self.lang, word))
            self.hashes.append(h)
        self[word] = i
        return i


class _Numbered:
    """Texts as numbers of frequent words; 0 stands for other words and ends of pieces."""

    def __init__(self, frequent: np.ndarray, bits: int):
        self.frequent, self.bits = frequent, bits
        self.forget()

    #: Words of the text numbered last.
    last = 0

    def forget(self) -> None:
        """Numbers begin anew; what was numbered before must be out of use."""
        self.names, self.hashes, self.langs = [None], [0], {}

    def known(self) -> int:
        return sum(map(len, self.langs.values()))

    def ids(self, lang: str, text: str | None) -> list[int]:
        own = self.langs.get(lang)
        if own is None:
            own = self.langs[lang] = _Numbers(lang, self.frequent, self.bits, self.names, self.hashes)
        words = words_of(text)
        self.last = len(words) - words.count(b"\n")
        return [*map(own.__getitem__, words), 0]

    def pairs(self, ids: np.ndarray, good: np.ndarray | None = None) -> np.ndarray:
        """Whether a pair of numbered words (in the bitmap ``good``) begins at each place."""
        ok = (ids[:-1] > 0) & (ids[1:] > 0)
        if good is not None:
            at = np.flatnonzero(ok)
            ok[at] = has(good, self.slots(ids, at, 2) % np.uint64(self.bits))
        return ok

    def slots(self, ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """40-bit slots of the phrases of ``size`` words at the places ``at``."""
        hashes = np.array(self.hashes, dtype=np.uint64)
        h = np.full(len(at), size, dtype=np.uint64)
        for j in range(size):
            h = (h ^ hashes[ids[at + j]]) * _M1
            h = (h ^ (h >> np.uint64(31))) * _M2
        return slots_of(h)


_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _places(pair: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each size from two: the places where a phrase of good pairs begins."""
    run = pair
    for size in range(2, longest + 1):
        if size > 2:
            run = run[:-1] & pair[size - 2:]
        yield size, np.flatnonzero(run)


def _phrase_slots(words_map, pairs_map, bits: int, chunks: int, least: int, longest: int):
    """Packed (slot, count) arrays of a task's pairs of words; with a bitmap of pairs, of its
    longer phrases of such pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, held = _Numbered(words_map.value, bits), []

        def out() -> pa.RecordBatch:
            ids = np.array(held, dtype=np.int64)
            if pairs_map is None:
                slots = texts.slots(ids, np.flatnonzero(texts.pairs(ids)), 2)
            else:
                pair = texts.pairs(ids, pairs_map.value)
                slots = np.concatenate([texts.slots(ids, at, size) for size, at in _places(pair, longest) if size > 2])
            return packed(slots, chunks, least)

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held += texts.ids(lang, text)
                if len(held) > KEYS:
                    yield out()
                    held.clear()
            if texts.known() > WORDS:
                yield out()
                held.clear()
                texts.forget()
        yield out()

    return run


def _phrase_runs(words_map, pairs_map, longer_map, bits: int, parts: int, entries: int, longest: int):
    """Runs of words and phrases that may be frequent, counted in a trie; and, as the empty
    phrase, how many words the languages have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, trie, total = _Numbered(words_map.value, bits), HatTrie(), Counter()

        def runs(keep: int) -> Iterator[pa.RecordBatch]:
            rows, names = [], texts.names
            for subtree in trie.spill(keep):
                rows += [(names[p[0]][0], b" ".join([names[w][1] for w in p]), n) for p, n in subtree]
            yield _packed_runs(rows, parts)

        def count(listed: list) -> None:
            ids = np.array(listed, dtype=np.int64)
            times = np.bincount(ids)
            for word in np.flatnonzero(times).tolist():
                if word:
                    trie.add((word,), int(times[word]))
            pair = texts.pairs(ids, pairs_map.value)
            for size, at in _places(pair, longest):
                if size > 2:
                    at = at[has(longer_map.value, texts.slots(ids, at, size) % np.uint64(bits))]
                for phrase, n in Counter(zip(*(ids[at + j].tolist() for j in range(size)))).items():
                    trie.add(phrase, n)

        for b in batches:
            held = []
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = texts.ids(lang, text)
                total[lang] += texts.last
                held += ids
            count(held)
            if trie.size > entries:
                yield from runs(entries // 2)
            if texts.known() > WORDS:
                yield from runs(0)
                texts.forget()
        yield from runs(0)
        yield _packed_runs([(lang, b"", n) for lang, n in total.items()], parts)

    return run


def counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text",
           lang_col: str = "lang", bits: int = BITS, entries: int = ENTRIES) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of up to ``longest`` words that stand
    ``least`` times or more, and (lang, n) of all words of a language."""
    spark, said = docs.sparkSession, _said(docs, text_col, lang_col)
    sc = spark.sparkContext
    # A word of average length has some eight bytes; ranges of slots need no more than that.
    chunks = chunks_for((said.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 8)

    def told(rows) -> Broadcast:
        return sc.broadcast(bitmap(frequent(said.mapInArrow(rows, SLOTS), chunks, least, bits), bits))

    words_map = told(_word_slots(chunks, least))
    pairs_map = told(_phrase_slots(words_map, None, bits, chunks, least, longest))
    longer_map = told(_phrase_slots(words_map, pairs_map, bits, chunks, least, longest))
    runs = said.mapInArrow(_phrase_runs(words_map, pairs_map, longer_map, bits, chunks, entries, longest), _RUNS)
    found = keep_table(_merged(runs, least).withColumn("size", F.size(F.split("phrase", " ", -1))), "phrases")
    return (found.where(F.col("phrase").isNotNull()).select("lang", "phrase", "size", "n"),
            found.where(F.col("phrase").isNull()).select("lang", "n"))


def _part(first, length):
    return F.array_join(F.slice("words", first, length), " ")


def uncontained(phrases: DataFrame) -> DataFrame:
    """The candidates (two words and more) that stand somewhere outside each longer one."""
    cand = phrases.where("size >= 2").select("lang", "phrase", "size", F.col("n").alias("a"))
    size = F.col("size").cast("int")
    inside = (cand.where("size >= 3").withColumn("words", F.split("phrase", " ", -1))
              .select("lang", F.explode(F.array(_part(F.lit(1), size - 1), _part(F.lit(2), size - 1))).alias("phrase"),
                      F.col("a").alias("longer")))
    both = (cand.withColumn("longer", F.lit(None).cast("long"))
            .unionByName(inside.select("lang", "phrase", F.lit(None).cast("int").alias("size"),
                                       F.lit(None).cast("long").alias("a"), "longer")))
    return (both.groupBy("lang", "phrase").agg(F.max("size").alias("size"), F.max("a").alias("a"),
                                               F.max("longer").alias("longer"))
            .where("longer IS NULL OR longer < a").drop("longer"))


def scored(cand: DataFrame, phrases: DataFrame, total: DataFrame) -> DataFrame:
    """Each candidate with its lowest-scoring cut: l, r, n, k, score."""
    size = F.col("size").cast("int")
    cuts = (cand.withColumn("words", F.split("phrase", " ", -1))
            .withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
            .select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("first"),
                    _part(F.col("k") + 1, size - F.col("k")).alias("rest")))
    first = phrases.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    wide = "cast({} AS decimal(19, 0))".format
    score = F.expr(f"({wide('a')} * {wide('n')} * 1000BD) div ({wide('l')} * {wide('r')})")
    return (cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(total, "lang")
            .withColumn("score", score.cast("long"))
            .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "n", "cut.*"))


def mine(docs: DataFrame, least: int = LEAST, best: int = BEST, text_col: str = "text",
         lang_col: str = "lang", **kw) -> DataFrame:
    """The ``best`` phrases of each language: (lang, rank, phrase, a, l, r, n, k, score),
    by score and count descending, then phrase."""
    phrases, total = counts(docs, least, text_col=text_col, lang_col=lang_col, **kw)
    rows = scored(uncontained(phrases), phrases, total)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = Window.partitionBy("lang", "share").orderBy(*order)
    some = (rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
            .withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= best).drop("share"))
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= best)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    F.col("k").cast("long").alias("k"), "score"))
