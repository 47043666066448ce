"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are multiplied, each as a probability given the language:

* the text: hashed byte trigrams of its letters under a multinomial model of
  each language, flattened to the weight of EVIDENCE trigrams, as neighbouring
  trigrams are not independent;
* the language that the markup (or metadata) declares, by how often each
  declaration goes with each language, as the texts alone have it;
* the address suffix (the last label of the host, or a language path), likewise;
* the host: its languages as the texts alone have them, without the document
  itself, smoothed towards those of its domain, and these towards all documents.

All three tables are grouped sums of text-only posteriors over all documents,
so a source that holds a third of all rows is summed where it is read. A text
whose trigrams no language explains better than chance has the language
``und`` and is rejected, as is one without a letter and without a declaration.

The trigram model is fitted on about FIT_ROWS labelled texts, drawn by a hash of
the id. Languages are those of LANGUAGES; other labels are not learnt from.

Defined cases: a NULL or empty text gives no evidence, so declaration, suffix and
host decide, and with none of them the language is ``und``; NULL declarations,
suffixes and hosts give no evidence; ties go to the first language in order;
repeated rows are judged each; an id on several rows is rejected only if all of
them are. An empty table gives an empty result. :func:`keep_known` carries all
other columns along.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tapeworks.llm.common import ascii_lower, columns_of, keep_table, small_batches, without_ids

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
#: Labelled texts that the trigram model is fitted on, about; hash buckets of it.
FIT_ROWS, BUCKETS = 20_000, 1 << 14
#: Trigrams that a text's evidence weighs at most.
EVIDENCE = 40
#: Trigrams a text must have for its own rejection, and the mean log likelihood
#: over chance (all buckets alike) that the best language must reach.
LEAST_GRAMS, MARGIN = 12, -0.5
#: Documents that the level above weighs in a host's, a domain's and a table's counts.
WEIGHT = 5.0

#: Bytes to lower-case letters; all else to spaces. Bytes of other scripts are letters.
_LETTERS = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32
                 for c in range(256))


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of a text's letters, single spaces between words."""
    if not text:
        return np.zeros(0, np.int64)
    flat = b" " + b" ".join(text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()) + b" "
    b = np.frombuffer(flat, np.uint8).astype(np.uint32)
    if len(b) < 5:
        return np.zeros(0, np.int64)
    h = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
    return (h >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def fit(docs: DataFrame, label: str = "lang", id_col: str = "doc_id",
        text_col: str = "text") -> np.ndarray:
    """Log probabilities [language, bucket] from the labelled rows of ``docs``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(label).alias("label")).where(F.col("label").isin(*LANGUAGES))
    share = min(1.0, FIT_ROWS / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(LANGUAGES), BUCKETS), np.int64)
        for texts, labels in columns_of(batches, "text", "label"):
            for t, x in zip(texts, labels):
                seen[LANGUAGES.index(x)] += np.bincount(trigrams(t), minlength=BUCKETS)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen.ravel()[at])], ["at", "n"])

    total = np.full(len(LANGUAGES) * BUCKETS, 0.5)
    for r in (drawn.select("text", "label").mapInArrow(count, "at long, n long")
              .groupBy("at").agg(F.sum("n").alias("n")).collect()):  # LANGUAGES x BUCKETS at most
        total[r["at"]] += r["n"]
    total = total.reshape(len(LANGUAGES), BUCKETS)
    return np.log(total / total.sum(axis=1, keepdims=True))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(url, r"(?s)^.*?://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def suffix_of(url: Column) -> Column:
    """The language that an address shows: a language code that begins the path,
    else the last label of the host."""
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*/([a-zA-Z]{2})(?:[/?#]|$)", 1)
    return F.when(F.length(path) == 2, F.concat(F.lit("/"), ascii_lower(path))).otherwise(
        F.nullif(F.substring_index(host_of(url), ".", -1), F.lit("")))


def markup_language(html: Column) -> Column:
    """The two-letter language that a page's html tag declares, else NULL."""
    return F.nullif(ascii_lower(F.regexp_extract(
        html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2})", 1)), F.lit(""))


def page_text(html: Column) -> Column:
    """A page's text without scripts, styles, navigation and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style|nav)\b.*?</\1\s*>", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>|&[#\w]+;", " ")


def text_evidence(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """The rows (without ``text``) with ``like``, the log likelihood of each
    language up to a constant; ``grams``; and ``gain``, the best language's mean
    over chance."""
    small_batches(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(model)
    keep = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in keep]
                       + ["like array<double>", "grams long", "gain double"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, chance = sent.value, -math.log(BUCKETS)
        for b in batches:
            like, grams, gain = [], [], []
            for t in b.column("text").to_pylist():
                at = trigrams(t)
                mean = model[:, at].mean(axis=1) if len(at) else np.zeros(len(LANGUAGES))
                like.append((mean * min(len(at), EVIDENCE)).tolist())
                grams.append(len(at))
                gain.append(float(mean.max() - chance) if len(at) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name) for f in keep] + [pa.array(like, pa.list_(pa.float64())),
                                                    pa.array(grams, pa.int64()), pa.array(gain)],
                [f.name for f in keep] + ["like", "grams", "gain"])

    return rows.mapInArrow(weigh, schema)


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def _sums(posterior: Column) -> list[Column]:
    return [F.sum(posterior[i]).alias(f"s{i}") for i in range(len(LANGUAGES))]


def _row(cols: list) -> Column:
    return F.array(*cols)


def _given(seen: DataFrame, key: str, base: list[float]) -> DataFrame:
    """(key, log P(key value | language)) from summed posteriors: a declaration or
    suffix is as likely as documents of the language bear it."""
    rows = (seen.where(F.col(key).isNotNull()).groupBy(key).agg(*_sums(F.col("post"))))
    total = rows.agg(*[F.sum(f"s{i}").alias(f"t{i}") for i in range(len(LANGUAGES))])
    cols = [F.log((F.col(f"s{i}") + WEIGHT * base[i] / 8) / (F.col(f"t{i}") + WEIGHT))
            for i in range(len(LANGUAGES))]
    return rows.crossJoin(F.broadcast(total)).select(key, _row(cols).alias(f"log_{key}"))


def identify(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """(id, lang, probability, known) of rows (id, text, declared, suffix, host, domain)."""
    read = text_evidence(rows.select("id", "text", "declared", "suffix", "host", "domain"), model)
    # A text without trigrams leaves all languages alike.
    post = F.when(F.col("grams") > 0, _softmax(F.col("like"))).otherwise(
        F.array(*[F.lit(0.0)] * len(LANGUAGES)))
    seen = keep_table(read.withColumn("post", post), "text-evidence")
    n = len(LANGUAGES)
    sums = seen.agg(*_sums(F.col("post"))).first()
    every = [(sums[i] or 0.0) + 1.0 for i in range(n)]
    base = [x / sum(every) for x in every]

    domains = seen.where(F.col("domain").isNotNull()).groupBy("domain").agg(*_sums(F.col("post")))
    in_domain = sum(F.col(f"s{i}") for i in range(n))
    domains = domains.select("domain", _row([
        (F.col(f"s{i}") + WEIGHT * base[i]) / (in_domain + WEIGHT) for i in range(n)]).alias("prior"))
    hosts = (seen.where(F.col("host").isNotNull()).groupBy("host", "domain")
             .agg(*_sums(F.col("post"))).join(domains, "domain")
             .select("host", "domain", _row([F.col(f"s{i}") for i in range(n)]).alias("sums"), "prior"))
    all_ = F.array(*[F.lit(x) for x in base])
    out = (seen.join(hosts, ["host", "domain"], "left")
           .join(_given(seen, "declared", base), "declared", "left")
           .join(_given(seen, "suffix", base), "suffix", "left"))
    # The host's sums without the document's own share.
    own = F.zip_with(F.col("sums"), F.col("post"), lambda s, p: F.greatest(s - p, F.lit(0.0)))
    size = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
    prior = F.when(F.col("sums").isNull(), all_).otherwise(
        F.zip_with(own, F.col("prior"), lambda s, p: (s + WEIGHT * p) / (size + WEIGHT)))
    none = F.array(*[F.lit(0.0)] * n)
    logs = F.transform(prior, lambda p: F.log(p))
    for c in ("like", "log_declared", "log_suffix"):
        logs = F.zip_with(logs, F.coalesce(F.col(c), none), lambda a, b: a + b)
    out = out.withColumn("fused", _softmax(logs))
    best = F.array_max("fused")
    lang = F.element_at(F.array(*[F.lit(x) for x in LANGUAGES]),
                        F.array_position("fused", best).cast("int"))
    odd = (F.col("grams") >= LEAST_GRAMS) & (F.col("gain") < MARGIN)
    blank = (F.col("grams") == 0) & F.col("log_declared").isNull() & F.col("log_suffix").isNull()
    known = ~(odd | blank)
    return out.select("id", F.when(known, lang).otherwise(UNKNOWN).alias("lang"),
                      best.alias("probability"), known.alias("known"))


def document_rows(docs: DataFrame) -> DataFrame:
    """Evidence columns of a table of documents: the declared language is their
    metadata's, the source stands for the host and its name without digits for
    the domain."""
    source = F.col("source").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("id"), "text",
        F.substring(ascii_lower(F.col("lang")), 1, 2).alias("declared"),
        F.lit(None).cast("string").alias("suffix"), source.alias("host"),
        F.regexp_replace(source, "[0-9]+", "").alias("domain"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Evidence columns of a table of pages: text, html tag, address and host."""
    host = host_of(F.col("url"))
    return pages.select(
        F.col("page_id").cast("long").alias("id"), page_text(F.col("html")).alias("text"),
        markup_language(F.col("html")).alias("declared"), suffix_of(F.col("url")).alias("suffix"),
        F.nullif(host, F.lit("")).alias("host"),
        F.nullif(F.substring_index(host, ".", -2), F.lit("")).alias("domain"))


def keep_known(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language is not known, all columns."""
    judged = identify(document_rows(docs), fit(docs))
    gone = (judged.groupBy("id").agg(F.max("known").alias("any"))
            .where(~F.col("any")).select("id"))
    return without_ids(docs, keep_table(gone, "language-rejected"), "doc_id")
