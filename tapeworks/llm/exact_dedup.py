"""Exact deduplication with a heavy-hitter split.

Few texts may be copied so often that one reducer would get a third of all
rows. A Misra-Gries summary (Spark's ``approx_top_k``) names the digests that
can be that frequent; their groups are counted exactly with map-side partial
aggregates, and the verified winners, at most ``BUCKETS * TOP`` rows, are
broadcast so that heavy rows are decided where they are read. All other digests
go through one ordinary shuffle. Which digests the summary names changes only
the path a row takes, never the result.

Defined cases: a NULL text is an empty text; empty texts are equal to each
other; of equal texts the row with the largest id stays, a NULL id being the
smallest; of repeated rows with that id exactly one stays, the first by its columns
written as JSON. An empty table gives
an empty result. Other columns are ignored by :func:`decide` and carried along
by :func:`drop_copies`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tapeworks.llm.common import keep_table, without_ids

#: Misra-Gries summaries: one for each of BUCKETS hash ranges, each tracking
#: TRACKED digests and naming its TOP. Any digest in more than a few hundredths
#: of a bucket's rows is named.
BUCKETS, TOP, TRACKED = 32, 32, 256
#: A named digest is heavy from so many rows on; rarer ones gain nothing.
HEAVY_ROWS = 64


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


def heavy_digests(digests: DataFrame) -> DataFrame:
    """(text_sha256, heavy_id, heavy_row, heavy_n): exact figures of the digests
    that the summaries name and that have HEAVY_ROWS rows at least. At most
    BUCKETS * TOP rows."""
    h = F.xxhash64("text_sha256")
    named = (digests.groupBy(F.pmod(h, F.lit(BUCKETS)).alias("bucket"))
             .agg(F.expr(f"approx_top_k(xxhash64(text_sha256), {TOP}, {TRACKED})").alias("top"))
             .select(F.explode("top").alias("t"))
             .select(F.col("t.item").alias("item")))
    top = F.max(F.struct("doc_id", "row"))
    return (digests.join(F.broadcast(named), h == F.col("item"), "left_semi")
            .groupBy("text_sha256").agg(top.alias("w"), F.count(F.lit(1)).alias("heavy_n"))
            .where(F.col("heavy_n") >= HEAVY_ROWS)
            .select("text_sha256", F.col("w.doc_id").alias("heavy_id"),
                    F.col("w.row").alias("heavy_row"), "heavy_n"))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = keep_table(_digests(docs, id_col, text_col), "digests")
    heavy = keep_table(heavy_digests(digests), "heavy")
    tagged = digests.join(F.broadcast(heavy), "text_sha256", "left")
    decided = tagged.where(F.col("heavy_n").isNotNull()).select(
        "doc_id", F.col("heavy_id").alias("keep_id"), F.col("heavy_n").alias("group_size"),
        (F.col("row") == F.col("heavy_row")).alias("kept"), "text_sha256")
    w = Window.partitionBy("text_sha256")
    rest = (tagged.where(F.col("heavy_n").isNull())
            .withColumn("w", F.max(F.struct("doc_id", "row")).over(w))
            .withColumn("group_size", F.count(F.lit(1)).over(w))
            .select("doc_id", F.col("w.doc_id").alias("keep_id"), "group_size",
                    (F.col("row") == F.col("w.row")).alias("kept"), "text_sha256"))
    return decided.unionByName(rest)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns."""
    decided = keep_table(decide(docs, id_col, text_col), "dedup")
    per_id = (decided.groupBy("doc_id")
              .agg(F.max("kept").alias("any_kept"), F.count(F.lit(1)).alias("n"))
              .where(~F.col("any_kept") | (F.col("n") > 1) | F.col("doc_id").isNull()))
    per_id = keep_table(per_id, "dedup-ids")
    single = without_ids(docs, per_id.select("doc_id"), id_col).where(F.col(id_col).isNotNull())
    # Ids on several rows (and the NULL id) can't name a row: here the text decides.
    many = per_id.where((F.col("n") > 1) | F.col("doc_id").isNull())
    if many.isEmpty():
        return single
    stays = (decided.where("kept").select(F.col("doc_id").alias("__id"),
                                          F.col("text_sha256").alias("__sha")))
    digest = F.sha2(F.coalesce(docs[text_col], F.lit("")).cast("binary"), 256)
    several = docs.join(many.select(F.col("doc_id").alias("__id")),
                        docs[id_col].eqNullSafe(F.col("__id")), "left_semi")
    several = (several.join(stays, several[id_col].eqNullSafe(F.col("__id"))
                            & (digest == F.col("__sha")), "left_semi"))
    # Of rows equal in id and text (NULL and '' are one text) the first by its columns as JSON.
    row = F.struct(*[several[c] for c in docs.columns])
    several = (several.groupBy(several[id_col].alias("__id"), digest.alias("__sha"))
               .agg(F.min_by(row, F.to_json(row)).alias("__row")).select("__row.*"))
    return single.unionByName(several)
