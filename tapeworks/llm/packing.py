"""Best-fit packing planned over a histogram of lengths.

Every text becomes token ids plus an end id and is cut into pieces of at most
``capacity`` tokens. The plan is made over the counts of each length (at most
``capacity`` numbers): best-fit decreasing that places all pieces of one length
at once, so its cost depends on the lengths and not on the documents. A piece
then takes its planned slot by joining on its rank within its length.

Ranks need no task that sees all pieces of a length: a tokenizing task numbers
the pieces of each length it makes, and the offsets of the tasks come from a
running sum over (length, task) counts.

Defined cases: a NULL or empty text is the end id alone; texts of any length are
cut whole; equal or repeated rows are packed each; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tapeworks.llm.common import Memo, keep_table, small_batches

CAPACITY = 2048
END_ID = 0

_PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
           "task int, nth long")


#: The byte that ends a word in :func:`_merge_ranks`. No text merged by rank holds it.
END_BYTE = b"\x01"
#: What stands for the end of a text, and for a word of the tokenizer's, in texts merged at once, and its id.
BREAK, BREAK_ID = "\x02", 1 << 24
#: Characters merged at once, about; longer texts are cut between words.
RUN_CHARS = 1 << 18

_SPACES = r"\x09-\x0d\x20"
#: Letters of the Latin blocks and ASCII but "<", which begins special tokens.
_LATIN = r"\x21-\x3b\x3d-\x7e\u00c0-\u024f"
_PLAIN = re.compile(f"[{_SPACES}]*+(?:[{_LATIN}]{{1,99}}+(?:[{_SPACES}]++|\\Z))*+")
#: Words that hold other characters or are long.
_ODD = re.compile(f"[^{_SPACES}]*[^{_SPACES}{_LATIN}][^{_SPACES}]*|[^{_SPACES}]{{100,}}")
_SPACE = re.compile(f"[{_SPACES}]")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _merge_ranks(vocab: dict[str, int]) -> dict[bytes, int]:
    """The vocabulary as byte strings by rank, without tokens that hold END_BYTE as text.
    A word's end is END_BYTE; ids are in merge order, so they are the ranks."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable}
    byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in byte_of.values())}
    ranks = {}
    for token, i in vocab.items():
        body = token.removesuffix("</w>")
        if all(c in byte_of for c in body):
            text = bytes(byte_of[c] for c in body)
            if END_BYTE not in text:
                ranks[text + END_BYTE * (body != token)] = i
    return ranks


@functools.cache
def _kinds() -> np.ndarray:
    """Of each character that a lower-cased Latin one can be: 0 space, 1 letter, 2 number, 3 other."""
    import regex

    chars = "".join(map(chr, range(0x2d00)))
    kinds = np.full(len(chars), 3, np.uint8)
    for kind, pattern in enumerate((r"\s", r"\p{L}", r"\p{N}")):
        kinds[[m.start() for m in regex.finditer(pattern, chars)]] = kind
    return kinds


def ended(text: str) -> str:
    """``text`` with END_BYTE after each match of _SPLIT, and spaces of one kind."""
    at = np.frombuffer((text + "   ").encode("utf-32-le"), "<u4")
    kind = _kinds()[at]
    ends = (kind != 0) & ((np.append(kind[1:], 0) != kind) | (kind == 2))
    # An apostrophe that begins a match takes the letters of a contraction.
    quotes = np.flatnonzero((at == ord("'")) & (np.append(0, kind[:-1]) != 3))
    one, two = at[quotes + 1], at[quotes + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((np.isin(one, [ord(c) for c in "rv"]) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
    ends[quotes[short | long]] = False
    ends[quotes[short] + 1] = True
    ends[quotes[long] + 2] = True
    at = np.where(kind == 0, ord(" "), at)
    return np.insert(at, np.flatnonzero(ends) + 1, END_BYTE[0]).astype("<u4").tobytes().decode("utf-32-le")


class TokenIds:
    """Texts to their ids as little-endian uint32.

    The vocabulary drops white space and never joins over it, so the ids of a
    text are those of its words, one after another. Words of letters of the
    Latin blocks are merged by rank, those of many texts in one call, which gives the
    tokenizer's ids in a fraction of its time (tested); all others, special tokens
    among them, go to the tokenizer.
    """

    def __init__(self, tokenizer_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as f:
            spec = json.load(f)
        self.odd_ids = Memo(lambda text: np.asarray(
            tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes())
        self.own = tokenizer_kind(spec)
        if self.own:
            end = END_BYTE.decode()
            self.merge = tiktoken.Encoding(
                "words", pat_str=f"[^ {end}]+{end}", special_tokens={},
                mergeable_ranks=_merge_ranks(spec["model"]["vocab"]) | {BREAK.encode() + END_BYTE: BREAK_ID})

    def _run(self, texts: list[str]) -> Iterator[bytes]:
        odd: list[list[str]] = [[] for _ in texts]

        def put(words: list[str], word: str) -> str:
            words.append(word)
            return BREAK

        plain = [t if _PLAIN.fullmatch(t) else _ODD.sub(lambda m, words=words: put(words, m[0]), t)
                 for t, words in zip(texts, odd)]
        text = unicodedata.normalize("NFC", f" {BREAK} ".join(plain)).lower()
        ids = self.merge.encode_to_numpy(ended(text), disallowed_special=()).astype("<u4", copy=False)
        flat, cuts = ids.tobytes(), (np.flatnonzero(ids == BREAK_ID) * 4).tolist()
        between = iter([flat[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(flat)])])
        for words in odd:
            yield next(between) + b"".join(self.odd_ids[w] + next(between) for w in words)

    def __getitem__(self, word: bytes) -> bytes:
        """The ids of one word."""
        return next(self.of_texts([word.decode("utf-8", "surrogatepass")]))

    def of_texts(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text."""
        if not self.own:
            for text in texts:
                yield b"".join(map(self.odd_ids.__getitem__, _SPACE.split(text or "")))
            return
        run, n = [], 0
        for text in texts:
            text = text or ""
            if run and n + len(text) > RUN_CHARS:
                yield from self._run(run)
                run, n = [], 0
            if len(text) > RUN_CHARS:
                yield b"".join(ids for part in _parts(text) for ids in self._run([part]))
            else:
                run.append(text)
                n += len(text)
        if run:
            yield from self._run(run)


def _parts(text: str) -> Iterator[str]:
    """A long text cut at spaces."""
    at = 0
    while space := _SPACE.search(text, at + RUN_CHARS):
        yield text[at:space.start()]
        at = space.end()
    yield text[at:]


@functools.cache
def token_bytes(tokenizer_path: str) -> TokenIds:
    """Once for each worker process."""
    return TokenIds(tokenizer_path)


def tokenizer_kind(spec: dict) -> bool:
    """Whether the file is of the kind that merging by rank holds for: byte-level
    BPE with word ends, lower-casing, split by one pattern."""
    steps = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (steps == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": _SPLIT} and spec["model"]["type"] == "BPE" and spec["model"]["end_of_word_suffix"] == "</w>"
            and not spec["model"]["ignore_merges"])


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document with their place in their task (task, nth):
    nth counts the pieces of one length in one task from 0."""
    small_batches(docs.sparkSession)
    end = END_ID.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, task = token_bytes(tokenizer_path), Counter(), TaskContext.get().partitionId()
        for b in batches:
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), known.of_texts(b.column(1).to_pylist())):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    length = len(part) // 4
                    rows.append((doc_id, n, at // 4, length, zlib.crc32(part), task, seen[length]))
                    seen[length] += 1
            cols = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(cut, _PIECES)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple]:
    """Best-fit decreasing over counts: rows (length, first, count, sequence, each,
    offset). Pieces of ``length`` ranked ``first`` to ``first + count - 1`` fill
    sequences from ``sequence`` on, ``each`` to a sequence, from ``offset`` on.

    Open sequences are kept as runs of equal free space. The next piece goes to
    the fullest sequence that still takes it; as that stays the fullest one until
    it takes no more, a run is filled ``free // length`` pieces at a time.
    """
    out: list[tuple] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # free space: runs (first sequence, how many)
    opened = 0

    def place(length: int, rank: int, left: int, free: int, first: int, many: int) -> int:
        """Pieces put into a run; what it leaves of the run stays or moves."""
        each = free // length
        full, some = divmod(min(left, many * each), each)
        used = full + bool(some)
        if full:
            out.append((length, rank, full * each, first, each, capacity - free))
            runs.setdefault(free - each * length, []).append((first, full))
        if some:
            out.append((length, rank + full * each, some, first + full, each, capacity - free))
            runs.setdefault(free - some * length, []).append((first + full, 1))
        if used < many:
            runs.setdefault(free, []).append((first + used, many - used))
        return full * each + some

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        for free in sorted(f for f in runs if f >= length):
            todo = runs.pop(free)
            while todo and left:
                n = place(length, rank, left, free, *todo.pop())
                rank, left = rank + n, left - n
            if todo:
                runs.setdefault(free, []).extend(todo)
            if not left:
                break
        if left:
            many = -(-left // (capacity // length))
            place(length, rank, left, capacity, opened, many)
            opened += many
    return out


def _ranked(cut: DataFrame) -> DataFrame:
    """Pieces with their rank within their length."""
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "task",
                             F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    return (cut.join(before, ["length", "task"])
            .withColumn("rank", F.col("before") + F.col("nth")).drop("before", "task", "nth"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = keep_table(pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    # At most `capacity` rows, whatever the documents.
    histogram = {r["length"]: r["n"] for r in
                 cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = spark.createDataFrame(
        plan(histogram, capacity),
        "length long, first long, count long, sequence long, each long, offset0 long")
    nth = F.col("rank") - F.col("first")
    # The plan's size follows the number of lengths, not of documents.
    return (_ranked(cut).join(F.broadcast(slots), "length")
            .where((nth >= 0) & (nth < F.col("count")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("sequence") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
                    (F.col("offset0") + nth % F.col("each") * F.col("length")).cast("long")
                    .alias("offset")))
