"""N-gram Jaccard self-join over count vectors, exact at ``PERCENT`` per cent.

A document is the set of its distinct 5-word shingles. Two documents link when
100 * |A and B| >= 80 * |A or B|; the result is the components of the links.

1. Documents of equal sets are one class, represented by its smallest id.
2. Shingles are hashed into G groups, G growing with the set's size (doubling
   size bands, so that groups keep a few shingles each). A set is then a point
   whose coordinates are the groups' counts.
3. Routing, the index's root. In the upper levels of a tree of boxes random
   points of this many dimensions can't be told apart, so points are dealt by
   what a linked pair must share. Sets that link differ in at most
   D = (|A| + |B|) / 9 shingles, so in at most D groups: each must share one
   of its D + 1 first nonempty groups, in any order common to all, content
   included. Groups that no other set has come first (told by a bitmap of fixed
   size, so a set that merely shares a passage with others has D + 1 of them and
   leaves), then the fullest, as they are rarest. A set with too few
   nonempty groups for that adds its |A| - ceil(0.8 |A|) + 1 smallest shingle
   hashes, the prefix that serves the same end. Nothing is lost, and no group
   or bucket is capped. This routing, and not boxes over boxes, is the index's upper
   part: see the README.
4. Leaves. Every set that shares a bucket with another is put in one leaf, with
   sets of its most popular bucket and of about its size; large groups are
   split into leaves of about LEAF_SHINGLES shingles together. A leaf has a
   corner, the largest count in each of ``DIMS`` coordinates, and its least and
   largest size.
5. Two leaves that share a bucket are opened only if the summed coordinate
   minima of their corners reach 4/9 of their least sizes together (an overlap
   that 0.8 needs). Inside a leaf, and between two opened ones, the same bound
   is tried for all points of a block at once, and survivors that are not
   connected yet are verified by intersecting their shingle sets. A block emits
   edges that connect what it found, never its pairs.

Defined cases: a document with one to four words has its whole word sequence as
its only shingle; NULL or empty texts have none and link with nothing; texts of
any length are read whole; repeated rows are in the same class; an id on rows
of different texts is one document, with the set whose hash is the smallest; a
row with a NULL id is a document of its own, which is named by the smallest id it
reaches (NULL if it reaches none). An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tapeworks.llm.common import (Memo, columns_of, drop_table, keep_table, small, small_batches,
                                  without_ids, word_hashes, words_of)
from tapeworks.llm.components import components
from tapeworks.llm.slots import KEYS, SLOTS, bitmap, chunks_for, frequent, has, packed, slots_of

WORDS, PERCENT = 5, 80
#: Coordinates of the points that the tree's bounds use.
DIMS = 64
#: Shingles of a leaf's sets together, about.
LEAF_SHINGLES = 32_768

#: Bits of the bitmap of keys that several sets may share, and of that of documents in play: 32 and 8 MB.
KEY_BITS, DOC_BITS = 1 << 28, 1 << 26

#: Hot keys named of each of HOT parts of the keys, and the rows that make one hot.
HOT, HOT_ROWS = 32, 1000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def shingles(words: list[bytes], hashes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; with fewer words
    the whole sequence is the one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(w))
    h = np.full(len(w) - width + 1, width, np.uint64)
    for i in range(width):
        h = _mix(h + w[i:len(w) - width + 1 + i])
    return np.unique(h)


def groups_of(top: int) -> int:
    """Groups of the size band that ends below ``top``: half again as many as the
    shingles that a linked pair of the band may differ in."""
    return max(4, top * 9 // 32)


def _groups(sh: np.ndarray, top: int) -> tuple[np.ndarray, int]:
    """Keys of the nonempty groups, fullest first, and how many of them (D + 1) a set
    must deal so that it shares one with every partner."""
    g = groups_of(top)
    most = len(sh) // 4  # |A sym. diff. B| <= (|A| + |B|) / 9 and |B| <= |A| / 0.8
    mixed = _mix(sh ^ np.uint64(g))
    at = (mixed % np.uint64(g)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    at, mixed = at[order], mixed[order]
    starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.append(starts, len(at)))
    # Content of a group: the wrapped sum of its mixed hashes.
    total = np.add.reduceat(_mix(mixed), starts)
    salt = np.uint64(g * int(_M2) % (1 << 64))
    key = _mix(total + at[starts].astype(np.uint64) * _M1 + salt)
    return key[np.lexsort((key, -count))], most + 1


def keys_of(sh: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Families of keys, each in an order common to all sets, and how many keys of
    a family must be dealt: linked sets then share one at least."""
    n = len(sh)
    if n == 0:
        return []
    top = 1 << int(n).bit_length()  # band [top / 2, top)
    # A partner may be larger by a quarter, and then in the next band.
    parts = [_groups(sh, t) for t in ((top, 2 * top) if n * 5 // 4 >= top else (top,))]
    if any(len(keys) < need for keys, need in parts):
        # Prefix of the set in hash order.
        prefix = _mix(sh[:n - (PERCENT * n + 99) // 100 + 1] ^ _M1)
        parts.append((prefix, len(prefix)))
    return parts


def node_of(sh: np.ndarray) -> int:
    """Name of a shingle set: a signed 64-bit hash."""
    return xxhash.xxh3_64_intdigest(sh.tobytes()) - (1 << 63)


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, keys, sizes, needs): ``node`` names the shingle set; its
    families of keys follow one another in ``keys``. There are none where the task has
    already given them for an equal set."""
    small_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, given = word_hashes(), Memo(lambda _: True)
        for ids, texts in columns_of(batches, "doc_id", "text"):
            sets = [shingles(words_of(t), hashes) for t in texts]
            nodes = [node_of(s) for s in sets]
            fresh = [n not in given and given[n] for n in nodes]
            keys = [keys_of(s) if new else [] for s, new in zip(sets, fresh)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()),
                 _lists([np.concatenate([k for k, _ in ks]) if ks else s[:0] for ks, s in zip(keys, sets)]),
                 pa.array([[len(k) for k, _ in ks] for ks in keys], pa.list_(pa.int32())),
                 pa.array([[need for _, need in ks] for ks in keys], pa.list_(pa.int32()))],
                ["doc_id", "n_shingles", "node", "keys", "sizes", "needs"])

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, node long, keys array<long>, sizes array<int>, "
                           "needs array<int>")


def counts_of(sh: np.ndarray) -> np.ndarray:
    """The set as a point: shingles in each of DIMS groups."""
    return np.bincount((_mix(sh ^ _M2) % np.uint64(DIMS)).astype(np.int64), minlength=DIMS)


def _root(parent: dict, x: int) -> int:
    while parent.setdefault(x, x) != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


class Leaf:
    """Points of a leaf: names, sizes, shingle sets, count vectors."""

    def __init__(self, nodes: np.ndarray, sizes: np.ndarray, flat: np.ndarray):
        self.nodes, self.sizes = nodes, sizes
        self.sets = np.split(flat, np.cumsum(sizes)[:-1])
        self.counts = np.array([counts_of(s) for s in self.sets])

    @classmethod
    def of(cls, row: dict) -> Leaf:
        return cls(*(np.frombuffer(row[c], k) for c, k in
                     (("nodes", np.int64), ("sizes", np.int64), ("flat", np.uint64))))

    def row(self) -> dict:
        return {"nodes": self.nodes.tobytes(), "sizes": self.sizes.tobytes(),
                "flat": np.concatenate(self.sets).tobytes(),
                "corner": self.counts.max(axis=0), "least": self.sizes.min(), "most": self.sizes.max()}


def links_between(a: Leaf, b: Leaf, parent: dict) -> list[tuple[int, int]]:
    """Links that connect what ``parent`` (a union-find forest) doesn't yet."""
    found = []
    for i, (node, n) in enumerate(zip(a.nodes.tolist(), a.sizes.tolist())):
        bound = np.minimum(b.counts, a.counts[i]).sum(axis=1)
        near = ((9 * bound >= 4 * (b.sizes + n))
                & (100 * np.minimum(b.sizes, n) >= PERCENT * np.maximum(b.sizes, n)))
        if a is b:
            near[:i + 1] = False
        for j in np.flatnonzero(near):
            x, y = _root(parent, node), _root(parent, int(b.nodes[j]))
            if x == y:
                continue
            both = len(np.intersect1d(a.sets[i], b.sets[j], assume_unique=True))
            if 100 * both >= PERCENT * (n + int(b.sizes[j]) - both):
                parent[x] = y
                found.append((node, int(b.nodes[j])))
    return found


_LEAF = ("leaf long, nodes binary, sizes binary, flat binary, corner array<int>, least long, most long, "
         "links array<struct<u:long,v:long>>")


def _sets_in_play(docs: DataFrame, in_play: DataFrame) -> DataFrame:
    """(node, sh) of the documents that stand for sets in play, and of the few whose
    ids clash with theirs in a bitmap. Texts are not shuffled."""
    small_batches(docs.sparkSession)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(DOC_BITS)).alias("s")
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(in_play.select(place), DOC_BITS))

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = word_hashes()
        for b in batches:
            b = b.filter(pa.array(has(wanted.value, b.column("s").to_numpy())))
            sets = [shingles(words_of(t), hashes) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([node_of(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "sh"])

    return docs.select(place, "text").mapInArrow(point, "node long, sh binary")


def leaves(sets: DataFrame) -> DataFrame:
    """One row per leaf of rows (leaf, node, sh), with the links inside it."""
    def gather(key, rows):
        import pandas as pd

        rows = rows.drop_duplicates("node").sort_values("node")
        sets = [np.frombuffer(x, np.uint64) for x in rows["sh"]]
        leaf = Leaf(rows["node"].to_numpy(np.int64), np.array([len(x) for x in sets], np.int64),
                    np.concatenate(sets))
        links = [{"u": u, "v": v} for u, v in links_between(leaf, leaf, {})]
        return pd.DataFrame([{"leaf": key[0], **leaf.row(), "links": links}])

    return sets.select("leaf", "node", "sh").groupBy("leaf").applyInPandas(gather, _LEAF)


def links_of_pairs(pairs: DataFrame) -> DataFrame:
    """Links (u, v) between the leaves a and b of each row."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [link for row in b.to_pylist()
                     for link in links_between(Leaf.of(row["a"]), Leaf.of(row["b"]), {})]
            u, v = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())],
                                             ["u", "v"])

    return pairs.mapInArrow(read, "u long, v long")


def _minima(a: str, b: str) -> Column:
    """Bound of the overlap: the summed coordinate minima."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)


def _placed(buckets: DataFrame) -> DataFrame:
    """(node, leaf) of every node in a bucket: leaves of nodes with one most popular
    bucket and about one size, as many as their shingles fill at most."""
    own = buckets.groupBy("node").agg(F.max(F.struct("many", "hub")).alias("top"),
                                      F.first("n_shingles").alias("n"))
    step = F.floor(F.log(1.25, "n"))
    own = own.select("node", F.col("top.hub").alias("anchor"), step.alias("step"), F.ceil(
        F.col("top.many") * F.pow(F.lit(1.25), step + 1) / LEAF_SHINGLES).cast("long").alias("parts"))
    return own.select("node", F.xxhash64("anchor", "step", "parts", F.pmod(F.xxhash64("node"), F.col("parts")))
                      .alias("leaf"))


def _opened(buckets: DataFrame, placed: DataFrame, grown: DataFrame) -> DataFrame:
    """Pairs (al, bl) of leaves that share a bucket and pass the corners' bound."""
    at = buckets.select("key", "node").join(small(placed), "node").select("key", "leaf").distinct()
    several = (at.groupBy("key").agg(F.min("leaf").alias("lo"), F.max("leaf").alias("hi"))
               .where(F.col("lo") < F.col("hi")).select("key"))
    at = keep_table(at.join(several, "key", "left_semi"), "leaf-keys")
    pairs = (at.select("key", F.col("leaf").alias("al"))
             .join(at.select("key", F.col("leaf").alias("bl")), "key")
             .where(F.col("al") < F.col("bl")).select("al", "bl").distinct())
    pairs = keep_table(pairs, "leaf-pairs")
    corner = grown.select("leaf", "corner", "least", "most")
    a = corner.toDF("al", "ac", "aleast", "amost")
    b = corner.toDF("bl", "bc", "bleast", "bmost")
    fits = ((9 * _minima("ac", "bc") >= 4 * (F.col("aleast") + F.col("bleast")))
            & (100 * F.col("amost") >= PERCENT * F.col("bleast"))
            & (100 * F.col("bmost") >= PERCENT * F.col("aleast")))
    return pairs.join(a, "al").join(b, "bl").where(fits).select("al", "bl")


def _in_company(raw: DataFrame) -> DataFrame:
    """(key, node, n_shingles) of the keys that must be dealt.

    Keys that no other row has come first in the common order: they are in lone slots of a
    bitmap, alike for all sets. A set with as many lone keys as it must deal has no
    partner and leaves; the others deal what they need beyond them.
    """
    sc = raw.sparkSession.sparkContext
    small_batches(raw.sparkSession)
    chunks = chunks_for(raw.agg(F.sum(F.size("keys"))).first()[0] or 0)

    def flat(b: pa.RecordBatch) -> np.ndarray:
        return b.column("keys").flatten().to_numpy().view(np.uint64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(slots_of(flat(b)))
            n += len(held[-1])
            if n > KEYS:
                yield packed(np.concatenate(held), chunks, 2)
                held, n = [], 0
        if held:
            yield packed(np.concatenate(held), chunks, 2)

    shared = sc.broadcast(bitmap(frequent(raw.select("keys").mapInArrow(pack, SLOTS), chunks, 2, KEY_BITS), KEY_BITS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = flat(b)
            sizes = b.column("sizes").flatten().to_numpy().astype(np.int64)  # of families
            needs = b.column("needs").flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(b.num_rows), b.column("sizes").value_lengths().to_numpy())
            own = has(shared.value, slots_of(keys) % np.uint64(KEY_BITS))
            before = np.concatenate(([0], np.cumsum(own)))  # shared keys before each place
            start = np.cumsum(sizes) - sizes
            lone = sizes - (before[start + sizes] - before[start])
            nth = before[1:] - np.repeat(before[start], sizes)  # from 1, of the shared ones of its family
            own &= nth <= np.repeat(needs - lone, sizes)
            row = np.repeat(row, sizes)[own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[own].view(np.int64)), pa.array(b.column("node").to_numpy()[row]),
                 pa.array(b.column("n_shingles").to_numpy()[row].astype(np.int32))], ["key", "node", "n_shingles"])

    return raw.select("keys", "sizes", "needs", "node", "n_shingles").mapInArrow(
        deal, "key long, node long, n_shingles int")


def _buckets(dealt: DataFrame) -> DataFrame:
    """(key, hub, many, node, n_shingles) of the buckets that hold several nodes.

    Keys that a Misra-Gries summary names as very frequent get their hub from
    partial aggregates and a broadcast of at most HOT * HOT rows; all others go
    through one shuffle.
    """
    named = (dealt.groupBy(F.pmod("key", F.lit(HOT)).alias("part"))
             .agg(F.expr(f"approx_top_k(key, {HOT}, {8 * HOT})").alias("top"))
             .select(F.explode("top").alias("t")).where(F.col("t.count") >= HOT_ROWS)
             .select(F.col("t.item").alias("key")))
    hot = dealt.join(F.broadcast(keep_table(named, "hot-keys")), "key", "left_semi")
    hot = keep_table(hot.groupBy("key").agg(
        F.min("node").alias("hub"), F.max("node").alias("last"), F.count(F.lit(1)).alias("many")),
        "hot-buckets")
    tagged = dealt.join(F.broadcast(hot), "key", "left")
    heavy = tagged.where(F.col("hub").isNotNull())
    w = Window.partitionBy("key")
    # Linked sets differ by a quarter in size at most, so a set whose neighbours by size in a
    # bucket are farther off has no partner there.
    by_size = w.orderBy("n_shingles", "node")
    size = F.col("n_shingles")
    near = ((100 * F.lag("n_shingles").over(by_size) >= PERCENT * size)
            | (100 * size >= PERCENT * F.lead("n_shingles").over(by_size)))
    light = (tagged.where(F.col("hub").isNull()).select("key", "node", "n_shingles")
             .withColumns({"hub": F.min("node").over(w), "last": F.max("node").over(w),
                           "many": F.count(F.lit(1)).over(w), "near": F.coalesce(near, F.lit(False))})
             .where("near").drop("near"))
    return (heavy.unionByName(light).where(F.col("hub") < F.col("last"))
            .select("key", "hub", "many", "node", "n_shingles"))


def _one_set(owner: DataFrame) -> DataFrame:
    """Of an id on several rows with different sets, all take the set of the
    smallest name."""
    several = (owner.groupBy("doc_id")
               .agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
               .where(F.col("lo") < F.col("hi")).select("doc_id", "lo"))
    several = keep_table(several, "several")
    if several.isEmpty():
        return owner
    size = (owner.join(several, "doc_id").where(F.col("node") == F.col("lo"))
            .select("doc_id", "lo", F.col("n_shingles").alias("size")).distinct())
    return (owner.join(size, "doc_id", "left")
            .select("doc_id", F.coalesce("size", "n_shingles").alias("n_shingles"),
                    F.coalesce("lo", "node").alias("node")))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    raw = keep_table(signatures(docs), "signatures")
    owner = keep_table(_one_set(raw.select("doc_id", "n_shingles", "node")), "owner")
    some = owner.where(F.col("n_shingles") > 0)
    classes = keep_table(some.groupBy("node").agg(F.min("doc_id").alias("rep"),
                                                  F.count(F.lit(1)).alias("copies")), "classes")

    dealt = keep_table(_in_company(raw), "dealt")
    drop_table(raw)
    buckets = keep_table(_buckets(dealt), "buckets")
    drop_table(dealt)

    placed = keep_table(_placed(buckets), "placed")
    in_play = placed.join(classes, "node").select(F.col("rep").alias("doc_id"))
    grown = keep_table(leaves(_sets_in_play(docs, in_play).join(small(placed), "node")), "leaves")
    opened = keep_table(_opened(buckets, placed, grown), "opened")
    block = F.struct("nodes", "sizes", "flat")
    small_batches(docs.sparkSession, 4)  # a row holds two leaves
    a = grown.select(F.col("leaf").alias("al"), block.alias("a"))
    b = grown.select(F.col("leaf").alias("bl"), block.alias("b"))
    b = b.join(small(keep_table(opened.select("bl").distinct(), "opened-b")), "bl", "left_semi")
    pairs = a.join(small(opened), "al").join(b, "bl").select("a", "b")
    across = keep_table(links_of_pairs(pairs), "links")
    inside = grown.select(F.explode("links").alias("l")).select("l.u", "l.v")
    label = keep_table(components(inside.unionByName(across)), "labels")
    for done in (buckets, placed, grown, opened, across):
        drop_table(done)

    # Components of nodes, named by their smallest document.
    least = (label.join(classes, "node").groupBy("component").agg(F.min("rep").alias("least")))
    linked = label.join(least, "component").select("node", "least")
    # Only nodes with copies or links need a join back to the documents.
    named = (classes.join(linked, "node", "left").where((F.col("copies") > 1) | F.col("least").isNotNull())
             .select("node", F.coalesce("least", "rep").alias("component_id")))
    alone = F.when(F.col("n_shingles") > 0, F.col("component_id"))
    return (owner.join(named, "node", "left")
            .select("doc_id", "n_shingles", F.coalesce(alone, "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the row of the smallest id of each component, all columns."""
    linked = keep_table(link(docs, id_col, text_col), "linked")
    gone = linked.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    return without_ids(docs, keep_table(gone, "near-copies"), id_col)
