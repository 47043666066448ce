"""Registered queries of this subpackage and their SQL.

A query applies its operator to a whole table and derives the result's columns
from what the operator gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tapeworks.llm import (chat, collocations, decontam, exact_dedup, hard_negatives, langid, lattice_lm,
                           ngram_join, packing, pieces, toxicity, url_rules, warc)
from tapeworks.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def q_ngram_jaccard(spark, sf_dir):
    return ngram_join.link(table(spark, sf_dir, "documents"))


def q_exact_dedup(spark, sf_dir):
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


def q_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


#: Said in conversation -1 besides the table's conversations.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def q_chat_format(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], said.schema)
    formatted = chat.format_conversations(said.unionByName(control))
    return chat.summary(chat.read_back(formatted))


#: Listed rules; the longest that fits decides.
LISTED = [url_rules.Listed("net/", "block"), url_rules.Listed("example.net/en/", "allow"),
          url_rules.Listed("example.com/de/", "block"), url_rules.Listed("org/fr/", "allow")]


def q_url_filter(spark, sf_dir):
    return url_rules.judge(table(spark, sf_dir, "pages"), LISTED)


def q_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def q_lattice_lm(spark, sf_dir):
    return lattice_lm.score(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def q_decontamination(spark, sf_dir):
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return langid.identify(langid.document_rows(docs), langid.fit(docs)).withColumnRenamed("id", "doc_id")


def q_language_id_pages(spark, sf_dir):
    """All four kinds of evidence: pages declare a language and have an address."""
    model = langid.fit(table(spark, sf_dir, "documents"))
    rows = langid.page_rows(table(spark, sf_dir, "pages"))
    return langid.identify(rows, model).withColumnRenamed("id", "page_id")


def q_warc(spark, sf_dir):
    root = scratch_path(spark, "warc")
    manifest = warc.write(table(spark, sf_dir, "pages"), root)
    return warc.read(manifest, root).drop("url", "payload")


def q_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents")).drop("k")


def q_hard_negatives(spark, sf_dir):
    rows, vec_id = table(spark, sf_dir, "embeddings"), F.col("vec_id")
    label = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), vec_id % 100 == 0)


def q_sentencepiece(spark, sf_dir):
    model = tokenizer_path("piece_bpe_32k.model")
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return pieces.digests(pieces.decode(encoded.drop("text"), model))


def q_pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "pipeline": q_pipeline,
        "op1_language_id": q_language_id,
        "language_id_pages": q_language_id_pages,
        "op2_ngram_jaccard": q_ngram_jaccard,
        "op3_exact_dedup": q_exact_dedup,
        "op4_best_fit_packing": q_best_fit_packing,
        "op5_toxicity": q_toxicity,
        "op6_lattice_lm": q_lattice_lm,
        "op7_chat_format": q_chat_format,
        "op8_warc": q_warc,
        "op9_decontamination": q_decontamination,
        "op10_url_filter": q_url_filter,
        "op11_collocations": q_collocations,
        "op12_hard_negatives": q_hard_negatives,
        "op13_sentencepiece": q_sentencepiece,
    }


_EXACT_DEDUP = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

_CHAT_FORMAT = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}'
  UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'),
e AS (
  SELECT *, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') AS esc,
    replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'),
            chr(10), '&#10;') AS esc_role
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum({len(chat.START)} + length(esc_role) + 1 + length(esc) + {len(chat.END)})::BIGINT
    AS formatted_chars
FROM e GROUP BY conv_id
"""


#: Base32 of a SHA-1 in hex: five hex digits are four base32 digits.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 5 * g}, 5))::INT >> {s}) & 31), 1)"
    for g in range(8) for s in (15, 10, 5, 0))

_WARC = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload,
                  sha1(coalesce(html, '')) AS h FROM pages)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> min(page_id) OVER w THEN min(page_id) OVER w END AS refers_to
FROM p WINDOW w AS (PARTITION BY h)
"""


#: Phrases as lists of words; parts and longer candidates by joins on the list.
_COLLOCATIONS = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
run AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM run GROUP BY lang),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM run WHERE len(w) > 0),
gram AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS size FROM place),
f AS (SELECT lang, list_slice(w, i, i + size - 1) AS g, any_value(size) AS size, count(*)::HUGEINT AS f
      FROM gram GROUP BY 1, 2 HAVING count(*) >= 100),
cand AS (SELECT * FROM f WHERE size >= 2),
inside AS (SELECT c.lang, list_slice(c.g, i, i + m - 1) AS g, max(c.f) AS longer
           FROM cand c, range(1, 5) AS a(i), range(2, 5) AS b(m)
           WHERE m < c.size AND i + m - 1 <= c.size GROUP BY 1, 2),
kept AS (SELECT c.* FROM cand c LEFT JOIN inside i ON c.lang = i.lang AND c.g = i.g
         WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.f),
cut AS (
  SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, t.n, (1000 * c.f * t.n) // (l.f * r.f) AS score
  FROM kept c JOIN range(1, 5) AS s(k) ON k < c.size
  JOIN f l ON l.lang = c.lang AND l.g = list_slice(c.g, 1, k)
  JOIN f r ON r.lang = c.lang AND r.g = list_slice(c.g, k + 1, c.size)
  JOIN total t ON t.lang = c.lang),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC,
                               encode(array_to_string(g, ' '))) AS rank FROM low)
SELECT lang, rank, array_to_string(g, ' ') AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
  n::BIGINT AS n, score::BIGINT AS score
FROM best WHERE rank <= 2000
"""

_HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         list_inner_product(a.q, r.q)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
pos AS (SELECT * FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
neg AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
         p.score AS positive_score, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS rank
  FROM pos p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score
FROM neg WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": _EXACT_DEDUP, "op7_chat_format": _CHAT_FORMAT, "op8_warc": _WARC,
            "op11_collocations": _COLLOCATIONS, "op12_hard_negatives": _HARD_NEGATIVES}
