"""Hard-negative mining by angular triangle filtering.

A row is an id, a label and a vector; a component x becomes ``floor(scale * x)``
and a score is the integer inner product of two such vectors. For each anchor and each
of its first positives (other rows of its label, highest scores first) the best
rows of other labels are found whose score lies between ``low`` % of the positive's
and the positive's own.

* **Reference directions.** ``REFERENCES`` directions are chosen by farthest-first
  traversal of a sample of ``SAMPLE`` rows at most (the smallest hashes of the ids). Each row is stored
  with its norm and its angles to all of them. The choice moves work, not results.
* **Groups.** Rows whose nearest reference, band of angle to it and band of norm agree are a cell
  (``CELLS`` at most). Small cells of one reference join, large ones are dealt in shares by
  hash, so a block of rows is bounded and one much repeated vector fills many blocks.
* **Bounds.** With angles s and t to a reference the angle between two vectors lies in
  [abs(s - t), s + t]; the cosines of the ends times the norms bound the score. Angles get
  ``EPS`` of room and scores a relative 1e-9, more than the rounding of their computation.
  An anchor travels only to the groups whose bound can reach what it looks for, and
  inside a block only the window of rows sorted by angle that can is scored.
* **Rounds.** Each anchor first meets the block it lies in; its fifth best score
  there is a lower limit for the search of its positives in all groups; the positives'
  scores are the limits of the search for negatives. Each round is one shuffle of rows and of
  anchors to the groups they need; blocks are bounded and anchors are streamed past them.
* **Scores** are exact: products of doubles while the norms prove that all sums stay below
  2^52, Python integers beyond. A score that no long can hold becomes the largest
  (or smallest) long.

Defined cases: rows with a NULL id, label or vector, or with a NULL or non-finite component, take
no part; of several rows with one id the one smallest by (label, vector) counts; vectors of
different lengths are compared as if zeros stood at the end of the shorter one;
equal scores come by id; an anchor without positives, or a positive without
negatives, gives no row; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tapeworks.llm.common import keep_table

#: Reference directions, and the rows they are chosen from.
REFERENCES, SAMPLE = 8, 1024
#: Bands of the angle to the nearest reference, and of the norm: at most
#: ``REFERENCES * ANGLES * NORMS`` cells, whatever the input.
ANGLES, NORMS = 32, 32
CELLS = REFERENCES * ANGLES * NORMS
#: Room for rounding: angles (radians), scores (relative).
EPS, SLACK = 1e-6, 1e-9
#: Anchors scored at once.
ANCHORS = 64
MOST = 2**63 - 1

_KINDS = (b"h", np.dtype("<i2"), 2**15), (b"i", np.dtype("<i4"), 2**31), (b"d", np.dtype("<f8"), math.inf)
_ROW = "id long, label long, is_anchor boolean, vector binary, norm double, home int, cell int, angles array<double>"
_FOUND = "anchor_id long, positive_id long, positive_score long, other_id long, score long"


def packed(v: np.ndarray) -> bytes:
    """Whole numbers as the narrowest of int16, int32 and double that holds them."""
    top = np.abs(v).max(initial=0)
    kind, dtype, _ = next(k for k in _KINDS if top < k[2])
    return kind + v.astype(dtype).tobytes()


def unpacked(vectors: list[bytes]) -> np.ndarray:
    """A matrix with a row for each vector, zeros behind the shorter ones."""
    dtypes = {k: d for k, d, _ in _KINDS}
    rows = [np.frombuffer(v, dtype=dtypes[v[:1]], offset=1) for v in vectors]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for at, r in enumerate(rows):
        out[at, :len(r)] = r
    return out


def scores(rows: np.ndarray, row_norms: np.ndarray, anchors: np.ndarray, anchor_norms: np.ndarray) -> np.ndarray:
    """Exact inner products (anchors x rows) as int64."""
    d = min(rows.shape[1], anchors.shape[1])
    rows, anchors = rows[:, :d], anchors[:, :d]
    if row_norms.max(initial=0) * anchor_norms.max(initial=0) < 2.0**52:
        return (anchors @ rows.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(anchors).astype(object) @ whole(rows).astype(object).T if d else np.zeros((len(anchors), len(rows)))
    return np.clip(exact, -MOST - 1, MOST).astype(np.int64)


def references(sample: list[list[float]]) -> np.ndarray:
    """Up to ``REFERENCES`` unit vectors, each far from those before it."""
    width = max(map(len, sample), default=0)
    x = np.zeros((len(sample), width))
    for at, v in enumerate(sample):
        x[at, :len(v)] = v
    norms = np.linalg.norm(x, axis=1)
    x = x[(norms > 0) & np.isfinite(norms)]
    if not len(x):
        return np.zeros((1, width))
    x /= np.linalg.norm(x, axis=1)[:, None]
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(REFERENCES, len(x)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def _measured(rows: DataFrame, refs: np.ndarray, scale: float) -> DataFrame:
    """Rows (id, label, is_anchor, v) with their whole numbers, norm, angles and cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                vectors = [np.floor(np.asarray(v, dtype=float) * scale) for v in part.column("v").to_pylist()]
                texts = [packed(v) for v in vectors]
                x = unpacked(texts)
                norms = np.linalg.norm(x, axis=1)
                d = min(x.shape[1], refs.shape[1])
                cosines = (x[:, :d] @ refs[:, :d].T) / np.where(norms > 0, norms, 1)[:, None]
                angles = np.arccos(np.clip(cosines, -1, 1))
                home = angles.argmin(axis=1)
                band = np.minimum(angles.min(axis=1) * (ANGLES / math.pi), ANGLES - 1).astype(int)
                size = np.clip(2 * np.log2(np.maximum(norms, 1)), 0, NORMS - 1).astype(int)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"), part.column("is_anchor"), pa.array(texts, pa.binary()),
                     pa.array(norms), pa.array(home.astype(np.int32)),
                     pa.array(((home * ANGLES + band) * NORMS + size).astype(np.int32)),
                     pa.array(list(angles), pa.list_(pa.float64()))],
                    ["id", "label", "is_anchor", "vector", "norm", "home", "cell", "angles"])

    return rows.mapInArrow(run, _ROW)


def _groups(cells: list, block_rows: int) -> tuple[list[tuple], list[dict]]:
    """(cell, group, shares) of each cell, and each group's bounds."""
    where, groups = [], []
    for c in sorted(cells, key=lambda c: c["cell"]):
        ref, last = c["cell"] // (ANGLES * NORMS), groups[-1] if groups else None
        if last and last["ref"] == ref and last["n"] + c["n"] <= block_rows:
            last.update(n=last["n"] + c["n"], near=np.minimum(last["near"], c["near"]), far=np.maximum(last["far"], c["far"]),
                        small=min(last["small"], c["small"]), large=max(last["large"], c["large"]))
        else:
            groups.append({"ref": ref, "n": c["n"], "near": np.array(c["near"]), "far": np.array(c["far"]),
                           "small": c["small"], "large": c["large"]})
        where.append((c["cell"], len(groups) - 1))
    for g in groups:
        g["shares"] = -(-g["n"] // block_rows)
    return [(cell, g, groups[g]["shares"]) for cell, g in where], groups


def _product(norm, low, high, cosine, upper: bool):
    """Bound of norm * (a norm in [low, high]) * cosine, with room for rounding."""
    best = norm * np.where((cosine >= 0) == upper, high, low) * cosine
    return best + (1 if upper else -1) * (SLACK * np.abs(norm * high) + SLACK)


def _sent(anchors: DataFrame, groups: list[dict]) -> DataFrame:
    """Anchors with limits (floor, ceiling), once for each share of the groups whose
    scores can lie between them. The groups' bounds are ``CELLS`` rows at most."""
    near, far = (np.array([g[k] for g in groups]) for k in ("near", "far"))
    small, large, shares, ref = (np.array([g[k] for g in groups]) for k in ("small", "large", "shares", "ref"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            norms, floors, tops = (b.column(c).to_numpy(zero_copy_only=False) for c in ("norm", "floor", "ceiling"))
            angles = np.array(b.column("angles").to_pylist())
            taken, gid, share, angle = [], [], [], []
            for at in range(b.num_rows):
                a = angles[at]
                least = np.maximum(0, np.maximum(near - a, a - far)).max(axis=1)
                most = np.minimum(math.pi, (a + far).min(axis=1))
                high = _product(norms[at], small, large, np.cos(np.maximum(0, least - EPS)), True)
                low = _product(norms[at], small, large, np.cos(np.minimum(math.pi, most + EPS)), False)
                for g in np.flatnonzero((high >= floors[at]) & (low <= tops[at])):
                    taken += [at] * shares[g]
                    gid += [g] * shares[g]
                    share += range(shares[g])
                    angle += [a[ref[g]]] * shares[g]
            if taken:
                part = b.select(["id", "label", "vector", "norm", "floor", "ceiling", "ids", "wants"]).take(pa.array(taken))
                for n, column in (("gid", pa.array(gid, pa.int32())), ("share", pa.array(share, pa.int32())),
                                  ("angle", pa.array(angle, pa.float64()))):
                    part = part.append_column(n, column)
                yield part

    return anchors.mapInArrow(run, "id long, label long, vector binary, norm double, floor double, ceiling double, "
                              "ids array<long>, wants array<long>, gid int, share int, angle double")


class _Block:
    """Rows of one block sorted by angle (and by label before it)."""

    def __init__(self, parts: list[pa.RecordBatch], by_label: bool):
        t = pa.Table.from_batches(parts)
        ids, labels, norms, angles = (t.column(c).to_numpy() for c in ("id", "label", "norm", "angle"))
        order = np.lexsort((angles, labels)) if by_label else np.argsort(angles, kind="stable")
        self.ids, self.labels, self.norms, self.angles = ids[order], labels[order], norms[order], angles[order]
        self.matrix = unpacked(t.column("vector").to_pylist())[order]
        self.small, self.large = norms.min(), norms.max()

    def window(self, first: int, last: int, norm: float, angle: float, floor: float, ceiling: float) -> tuple[int, int]:
        """Rows of [first, last) whose score can lie between floor and ceiling."""
        beta = self.angles[first:last]
        lo, hi = 0, last - first
        if floor > 0:  # norm * large * cos(abs(angle - beta)) >= floor
            cosine = (floor - SLACK) / max(norm * self.large * (1 + SLACK), 1e-300)
            if cosine > 1 + SLACK:
                return first, first
            width = math.acos(min(1.0, cosine)) + 2 * EPS
            lo, hi = np.searchsorted(beta, angle - width), np.searchsorted(beta, angle + width, "right")
        if 0 < ceiling < norm * self.small:  # norm * small * cos(angle + beta) <= ceiling
            below = math.acos(min(1.0, (ceiling + SLACK) / (norm * self.small) * (1 + SLACK))) - 2 * EPS - angle
            lo = max(lo, np.searchsorted(beta, below))
        return first + int(lo), first + max(int(lo), int(hi))


def _best(value: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by value descending, then id."""
    if len(value) > 4 * k:
        cut = np.partition(value, len(value) - k)[len(value) - k]
        some = np.flatnonzero(value >= cut)
        return some[np.lexsort((ids[some], -value[some]))[:k]]
    return np.lexsort((ids, -value))[:k]


def _positives(block: _Block, anchors: list[dict], k: int, low: int) -> Iterator[tuple]:
    """The first k rows of each anchor's label in the block, from its floor up."""
    for a, (lo, hi), got in _scored(block, anchors, True):
        ids = block.ids[lo:hi]
        ok = np.flatnonzero((ids != a["id"]) & (got >= a["floor"]))
        for at in ok[_best(got[ok], ids[ok], k)]:
            yield a["id"], None, None, ids[at], got[at]


def _negatives(block: _Block, anchors: list[dict], k: int, low: int) -> Iterator[tuple]:
    """For each positive of an anchor, the first k rows of other labels in the block."""
    for a, (lo, hi), got in _scored(block, anchors, False):
        ok = np.flatnonzero((block.labels[lo:hi] != a["label"]) & (got >= a["floor"]) & (got <= a["ceiling"]))
        ids, got = block.ids[lo:hi][ok], got[ok]
        order = np.lexsort((ids, -got))
        down = -got[order]
        for positive, p in zip(a["ids"], a["wants"]):
            if p < 0:
                continue
            at = np.searchsorted(down, -p)
            for n in order[at:at + k]:
                if got[n] < -(-low * p // 100):
                    break
                yield a["id"], positive, p, ids[n], got[n]


def _scored(block: _Block, anchors: list[dict], same_label: bool):
    """Each anchor's window and its rows' scores; neighbouring anchors share a product."""
    for at in range(0, len(anchors), ANCHORS):
        part, windows = anchors[at:at + ANCHORS], []
        for a in part:
            first, last = 0, len(block.ids)
            if same_label:
                first, last = np.searchsorted(block.labels, a["label"]), np.searchsorted(block.labels, a["label"], "right")
            windows.append(block.window(int(first), int(last), a["norm"], a["angle"], a["floor"], a["ceiling"]))
        x, norms = unpacked([a["vector"] for a in part]), np.array([a["norm"] for a in part])
        todo = [i for i, (lo, hi) in enumerate(windows) if hi > lo]
        while todo:  # anchors whose windows overlap the first one's, as one matrix product
            lo, hi = windows[todo[0]]
            group = [i for i in todo if windows[i][0] < hi and lo < windows[i][1]]
            todo = [i for i in todo if i not in group]
            lo, hi = min(windows[i][0] for i in group), max(windows[i][1] for i in group)
            got = scores(block.matrix[lo:hi], block.norms[lo:hi], x[group], norms[group])
            for line, i in zip(got, group):
                first, last = windows[i]
                yield part[i], windows[i], line[first - lo:last - lo]


def _visit(rows: DataFrame, sent: DataFrame, blocks: int, search: Callable, k: int, low: int) -> DataFrame:
    """Anchors meet the rows of the blocks they were sent to."""
    nothing = {"floor": "double", "ceiling": "double", "ids": "array<long>", "wants": "array<long>"}
    both = (rows.select("gid", "share", F.lit(0).alias("kind"), "id", "label", "vector", "norm", "angle",
                        *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()])
            .unionByName(sent.withColumn("kind", F.lit(1))))
    by_label = search is _positives

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, block = None, [], None
        for b in batches:
            keys = np.stack([b.column(c).to_numpy() for c in ("gid", "share", "kind")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                gid, share, kind = (int(x) for x in keys[:, lo])
                if current != (gid, share):
                    current, parts, block = (gid, share), [], None
                if kind == 0:
                    parts.append(b.slice(lo, hi - lo))
                    continue
                if not parts:
                    continue
                block = block or _Block(parts, by_label)
                found = list(search(block, b.slice(lo, hi - lo).to_pylist(), k, low))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if x is None else int(x) for x in c], pa.int64()) for c in zip(*found)],
                        ["anchor_id", "positive_id", "positive_score", "other_id", "score"])

    return (both.repartition(blocks, "gid", "share").sortWithinPartitions("gid", "share", "kind", "label", "angle", "id")
            .mapInArrow(run, _FOUND))


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rows_of(table: DataFrame, anchors: Column, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """The rows that take part: (id, label, is_anchor, v), one for each id."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                         F.coalesce(anchors, F.lit(False)).alias("is_anchor"), F.when(fine, v).alias("v"))
            .where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
            .groupBy("id").agg(F.min(F.struct("label", "v", "is_anchor")).alias("r")).select("id", "r.*"))


def mine(table: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, scale: float = 256.0,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
         block_rows: int | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` says which rows are anchors; ``block_rows`` is the size of a block, by
    default 8 times the root of the number of rows (512 to 65,536).
    """
    spark = table.sparkSession
    plain = keep_table(rows_of(table, anchors, id_col, label_col, vector_col), "vectors")
    sample = plain.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    measured = keep_table(_measured(plain, references([r["v"] for r in sample]), scale), "measured")
    width = measured.agg(F.max(F.size("angles"))).first()[0] or 0
    cells = measured.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("norm").alias("small"), F.max("norm").alias("large"),
        *[f(F.col("angles")[j]).alias(f"{name}{j}") for j in range(width) for f, name in ((F.min, "near"), (F.max, "far"))])
    cells = [{**r.asDict(), "near": [r[f"near{j}"] for j in range(width)], "far": [r[f"far{j}"] for j in range(width)]}
             for r in cells.collect()]  # CELLS rows at most
    total = sum(c["n"] for c in cells)
    where, groups = _groups(cells, block_rows or min(65_536, max(512, int(8 * math.sqrt(total)))))
    cell_map = spark.createDataFrame(where, "cell int, gid int, shares int")
    rows = measured.join(cell_map, "cell").withColumn("share", F.pmod(F.xxhash64("id"), F.col("shares")).cast("int"))
    rows = rows.withColumn("angle", F.col("angles")[F.col("home")])
    blocks = max(1, sum(g["shares"] for g in groups))
    asking = (rows.where("is_anchor").withColumn("floor", F.lit(float("-inf"))).withColumn("ceiling", F.lit(float("inf")))
              .withColumn("ids", F.lit(None).cast("array<long>")).withColumn("wants", F.lit(None).cast("array<long>")))
    fields = ["id", "label", "vector", "norm", "floor", "ceiling", "ids", "wants"]
    # At home: the positives-th best score of the anchor's own block, if it has as many.
    home = _visit(rows, asking.select(*fields, "gid", "share", "angle"), blocks, _positives, positives, low)
    limits = (home.groupBy("anchor_id").agg(F.when(F.count(F.lit(1)) >= positives, F.min("score")).alias("best"))
              .select(F.col("anchor_id").alias("id"), F.col("best").cast("double").alias("best")))
    limited = (asking.drop("floor").join(limits, "id", "left")
               .withColumn("floor", F.coalesce("best", F.lit(float("-inf")))).select(*fields, "angles"))
    best = _first(_visit(rows, _sent(limited, groups), blocks, _positives, positives, low), ["anchor_id"], positives)
    wanted = keep_table(best.groupBy(F.col("anchor_id").alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "other_id", "score"))).alias("p"))  # ``positives`` at most
        .select("id", F.col("p.other_id").alias("ids"), F.col("p.score").alias("wants")), "positives")
    useful = F.filter("wants", lambda p: p >= 0)
    # Whole numbers of the window as doubles, with room for the conversion.
    floor = F.array_min(useful).cast("double") * low / 100 * (1 - SLACK) - 1
    ceiling = F.array_max(useful).cast("double")
    asking = (asking.drop("ids", "wants", "floor", "ceiling").join(wanted, "id").where(F.size(useful) > 0)
              .withColumn("floor", floor)
              .withColumn("ceiling", F.when(F.array_max(useful) < MOST // 2, ceiling * (1 + SLACK) + 1)
                          .otherwise(float("inf"))).select(*fields, "angles"))
    found = _visit(rows, _sent(asking, groups), blocks, _negatives, negatives, low)
    return (_first(found, ["anchor_id", "positive_id"], negatives)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                    F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
