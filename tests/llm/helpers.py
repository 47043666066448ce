"""Small tables and brute-force versions."""

from collections import defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return (text or "").encode().lower().split()


def docs(spark, texts, extra=False):
    """A documents table; texts is a dict or a list of (id, text)."""
    rows = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in
            (texts.items() if isinstance(texts, dict) else texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:  # names that operators use inside
        from pyspark.sql import functions as F
        for c in ("keep_id", "kept", "node", "key", "n", "row", "word", "lang_", "score", "sequence_id",
                  "length", "task", "rank", "component", "id", "label"):
            df = df.withColumn(c, F.lit("x"))
    return df


def shingle_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    """{id: smallest linked id}: all pairs, J >= 0.8."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    near = defaultdict(set)
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    near[a].add(b)
                    near[b].add(a)
    out = {}
    for i in sorted(sets):
        todo = [i] if i not in out else []
        while todo:
            x = todo.pop()
            if x not in out:
                out[x] = i
                todo += near[x]
    return out
