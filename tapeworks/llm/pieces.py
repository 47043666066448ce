"""SentencePiece encoding and decoding: exact merge-type encoding by backtracking.

The pieces and their scores are read from a model file of the merge kind (BPE).
The library merges the best-scoring adjacent pair first, the leftmost among
equals. That result is found here without merging whole texts:

* **Longest matches.** An Aho-Corasick automaton over the pieces gives the longest
  piece that begins at each place.
* **Compatibility.** A sequence of pieces is the merge result exactly if every two neighbours are
  what their joined text merges to. :meth:`Vocabulary.fits` undoes the merges on both sides of the
  seam, latest first, and tries to merge across it at each step.
* **Backtracking.** The longest piece that fits its left neighbour is taken; where none
  does, the place is marked as failed in a bitfield and the piece before is shortened.
  A failed place is not tried again, so the work is linear in the text's length for bounded
  pieces.

Only pieces that merging their own text gives back take part. Characters without a piece stand
for their UTF-8 bytes. A text is cut where no piece can cross (before a space mark
behind another character), and the ids of recent cuttings are remembered; so a long text is encoded whole
and equal to one long merge.

Defined cases: a NULL or empty text has the begin and end ids alone (if asked for); texts of
any length are encoded whole; repeated rows are encoded each; an empty table gives an
empty result; other columns are kept and those named like a result are replaced.
"""

from __future__ import annotations

import functools
import heapq
import re
import struct
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tapeworks.llm.common import Memo

#: The mark that stands for a space (fixed by the format).
SPACE = "▁"
#: Kinds of pieces in a model file (fixed by the format).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Cuttings of a text remembered, and the longest of them.
KEPT, KEPT_LENGTH = 400_000, 64
#: Texts worked on at once.
ROWS = 128


class Vocabulary:
    """Pieces of a merge-type model, with what encoding needs."""

    def __init__(self, model_path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(model_path, "rb") as f:
            model.ParseFromString(f.read())
        norm, kinds = model.normalizer_spec, Counter(p.type for p in model.pieces)
        if model.trainer_spec.model_type != 2 or kinds[USER] or kinds[UNUSED] or not kinds[BYTE]:
            raise ValueError("a merge-type model with byte pieces and without user-defined ones is needed")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces \
                or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a model that normalises texts is not supported")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        self.begin = next(i for i, p in enumerate(model.pieces) if p.piece == model.trainer_spec.bos_piece)
        self.end = next(i for i, p in enumerate(model.pieces) if p.piece == model.trainer_spec.eos_piece)
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        #: Pieces that share their score: the place decides between them.
        often = Counter(s for p, s in self.score.items() if len(p) > 1)
        self.tied = {p for p, s in self.score.items() if len(p) > 1 and often[s] > 1}
        self.parts: dict[str, tuple[str, str]] = {}
        for p in self.ids:
            if len(p) > 1:
                got = self.merge(p, stop=2)
                if self.merge(p) == [p]:
                    self.parts[p] = got[0], got[1]
        self.whole = {p for p in self.ids if len(p) == 1} | set(self.parts)
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.whole), p[:1])
                        for p in self.whole if len(p) > 1}
        self.automaton = ahocorasick.Automaton()
        for p in self.whole:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.cut = None if crossing else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.fitting = Memo(lambda pair: self.fits(*pair), KEPT)
        self.known = Memo(self._packed, KEPT)

    def merge(self, text: str, stop: int = 1) -> list[str]:
        """Pieces of a short text by merging the best pair until none is left or
        ``stop`` parts are; used on single pieces and on ties."""
        parts: list[str | None] = list(text)
        left = len(parts)
        heap: list[tuple[float, int, int, str]] = []

        def offer(a: int) -> None:
            b = next((i for i in range(a + 1, len(parts)) if parts[i] is not None), None)
            if b is not None and parts[a] + parts[b] in self.score:
                joined = parts[a] + parts[b]
                heapq.heappush(heap, (-self.score[joined], a, b, joined))

        for a in range(len(parts) - 1):
            offer(a)
        while heap and left > stop:
            _, a, b, joined = heapq.heappop(heap)
            if parts[a] is None or parts[b] is None or parts[a] + parts[b] != joined:
                continue
            parts[a], parts[b] = joined, None
            left -= 1
            offer(a)
            before = next((i for i in range(a - 1, -1, -1) if parts[i] is not None), None)
            if before is not None:
                offer(before)
        return [p for p in parts if p is not None]

    def fits(self, a: str, b: str) -> bool:
        """Whether merging the text of two pieces gives back just these two."""
        if a in self.tied or b in self.tied:
            return self.merge(a + b) == [a, b]
        last = None  # score of the merge undone before: what crosses the seam must come after it
        while True:
            across = self.score.get(a + b)
            # A crossing merge of the same score as one on the left comes later, on the right earlier.
            if across is not None and (last is None or across > last[0] or (across == last[0] and last[1])):
                return False
            va, vb = self.score[a] if len(a) > 1 else None, self.score[b] if len(b) > 1 else None
            if va is None and vb is None:
                return True
            if vb is None or (va is not None and va < vb):  # the left piece was merged later
                a, last = self.parts[a][1], (va, False)
            else:
                b, last = self.parts[b][0], (vb, True)

    def encode(self, text: str) -> list[str]:
        """Pieces of a normalised text by backtracking over longest matches."""
        n = len(text)
        longest = [1] * n
        for end, length in self.automaton.iter(text):
            longest[end - length + 1] = length  # ends come in order, so the longest stays
        open_ = bytearray(b"\x01" * (n + 1))  # places not known to fail
        taken: list[str] = []
        at, piece = 0, text[:longest[0]] if n else None
        shorter, fitting = self.shorter, self.fitting
        while piece is not None:
            end = at + len(piece)
            if open_[end] and (not taken or fitting[taken[-1], piece]):
                taken.append(piece)
                at = end
                piece = text[at:at + longest[at]] if at < n else None
            elif len(piece) > 1:
                piece = shorter[piece]
            else:
                open_[at] = 0
                if not taken:
                    raise ValueError("no sequence of pieces fits this text")
                piece = taken.pop()  # its end has failed, so it will be shortened
                at -= len(piece)
        return taken

    def _packed(self, unit: str) -> bytes:
        """Ids of a normalised text, as little-endian uint32."""
        ids = []
        for p in self.encode(unit):
            i = self.ids.get(p)
            ids += [i] if i is not None else [self.bytes[c] for c in p.encode("utf-8", "surrogatepass")]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids_of(self, text: str | None) -> bytes:
        """Ids of a whole text without begin and end."""
        if not text:
            return b""
        text = self.prefix + text.replace(" ", SPACE)
        known = self.known
        return b"".join([known[u] if len(u) <= KEPT_LENGTH else self._packed(u)
                         for u in (self.cut.findall(text) if self.cut else [text])])


@functools.cache
def _vocabulary(path: str) -> Vocabulary:
    """Once for each worker process."""
    return Vocabulary(path)


@functools.cache
def _library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def encode(docs: DataFrame, model_path: str, text_col: str = "text", begin: bool = True, end: bool = True) -> DataFrame:
    """``docs`` with ``ids``: binary, little-endian uint32. ``model_path`` is read by every worker."""
    docs = docs.drop("ids")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = _vocabulary(model_path)
        first = struct.pack("<I", voc.begin) if begin else b""
        last = struct.pack("<I", voc.end) if end else b""
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                yield part.append_column("ids", pa.array(
                    [first + voc.ids_of(t) + last for t in part.column(at).to_pylist()], pa.binary()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("ids", T.BinaryType())]))


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the texts of its ids, by the library's decoder."""
    encoded = encoded.drop(out_col)
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        library = _library(model_path)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                texts = [library.decode(np.frombuffer(ids or b"", dtype="<u4").tolist())
                         for ids in part.column(at).to_pylist()]
                yield part.append_column(out_col, pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())]))


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ids and decoded texts."""
    return decoded.select(
        F.col(id_col).alias("doc_id"), F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
