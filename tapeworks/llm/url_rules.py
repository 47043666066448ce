"""URL filter: longest-prefix lists, and association rules for all other URLs.

Every URL is a set of tokens (host labels, path segments, query keys). URLs that
a listed rule decides carry its verdict as one more token; Spark's FP-growth
mines the combinations of tokens that go with a verdict, over all URLs, so that
undecided ones lower a combination's confidence. Rules are pruned by support and
confidence, and a rule is dropped when a shorter one says the same as surely.
The rest is an inverted index: each rule is posted under its rarest token, a URL
looks up its own tokens only and then checks the rule's other tokens.

Bounds: the least support alone bounds what is mined, so tokens, combinations and
the broadcast index don't grow with the number of URLs. Mining leaves out only
what can give no rule that stays: tokens without enough URLs of one verdict;
tokens whose URLs all have one verdict, beside their own rule, as a longer one is
never surer; and of tokens that stand in the same URLs all but the first. Support
is a share of the URLs that have tokens.

Defined cases: a NULL URL or one without ``://`` has an empty host and path, no
tokens, no rule, and the default verdict; a NULL id is kept; repeated rows are
judged each; without labelled or frequent tokens there are no rules and the
default verdict holds. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tapeworks.llm.common import ascii_lower, keep_table

MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.6
VERDICTS = ("allow", "block")
DEFAULT = "allow"


@dataclass(frozen=True)
class Listed:
    """A listed rule: ``host/path`` and its verdict; fits the host and its
    subdomains when the URL's path starts with ``path``."""
    rule: str
    verdict: str

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.split("/", 1)[1]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(listed: list[Listed], host: str = "host", path: str = "path") -> Column:
    """The longest listed rule that fits, as struct(rule, verdict), else NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(listed, key=lambda r: len(r.rule)):
        fits = (((F.col(host) == r.host) | F.col(host).endswith("." + r.host))
                & F.col(path).startswith(r.path))
        out = F.when(fits, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def _tokens(url: Column) -> Column:
    """Distinct tokens of a URL; runs of digits count as one sign."""
    labels = F.transform(F.split(F.col("host"), r"\."), lambda x: F.concat(F.lit("host "), x))
    parts = F.transform(F.split(F.col("path"), "/"), lambda x: F.concat(F.lit("path "), x))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.split(query, "[&;]"),
                       lambda x: F.concat(F.lit("key "), F.substring_index(x, "=", 1)))
    every = F.transform(F.concat(labels, parts, F.coalesce(keys, F.array().cast("array<string>"))),
                        lambda x: F.regexp_replace(x, "[0-9]+", "#"))
    return F.array_distinct(F.filter(every, lambda x: ~x.isin("host ", "path ", "key ")))


def prepare(pages: DataFrame, listed: list[Listed], id_col: str = "page_id",
            url_col: str = "url") -> DataFrame:
    """(row, page_id, host, path, tokens, listed) of every URL."""
    url = F.col("url")
    return (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
            .withColumn("host", host_of(url)).withColumn("path", path_of(url))
            .select(F.monotonically_increasing_id().alias("row"), "page_id", "host", "path",
                    F.when(F.coalesce(F.locate("://", url), F.lit(0)) > 0, _tokens(url))
                    .otherwise(F.array().cast("array<string>")).alias("tokens"),
                    listed_rule(listed).alias("listed")))


def mine(prepared: DataFrame) -> DataFrame:
    """Pruned rules (rule_id, key, need, verdict, confidence, support)."""
    verdict = F.col("listed.verdict")
    prepared = prepared.where(F.size("tokens") > 0)
    rows = prepared.count()
    # Tokens of the same URLs have the same sums of the rows' hashes.
    same = [F.sum(F.xxhash64("row", F.lit(i)).cast("decimal(38,0)")).alias(f"h{i}") for i in range(2)]
    seen = (prepared.select("row", F.explode("tokens").alias("token"), verdict.alias("v"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("n"), *same,
                                  *[F.count(F.when(F.col("v") == v, 1)).alias(v) for v in VERDICTS])
            .where(F.greatest(*VERDICTS) >= MIN_SUPPORT * rows)
            .groupBy("n", "h0", "h1", *VERDICTS).agg(F.min("token").alias("token")).collect())
    counts = {r["token"]: r["n"] for r in seen}
    sure = [([r["token"]], v, 1.0, r["n"] / rows) for r in seen for v in VERDICTS if r[v] == r["n"]]
    mixed = sorted(counts.keys() - {t for (t,), *_ in sure})
    rules = _combinations(prepared, mixed) if mixed else []
    kept = sorted(sure + rules, key=lambda r: (len(r[0]), -r[2], -r[3], r[0]))
    return prepared.sparkSession.createDataFrame(
        [(i, min(r[0], key=lambda x: (counts[x], x)), *r) for i, r in enumerate(kept)],
        "rule_id long, key string, need array<string>, verdict string, confidence double, support double")


def _combinations(prepared: DataFrame, tokens: list[str]) -> list[tuple]:
    """(tokens, verdict, confidence, support) of the rules over these tokens that no
    shorter one says as surely."""
    verdict = F.col("listed.verdict")
    known = F.array(*[F.lit(t) for t in tokens]).cast("array<string>")
    baskets = prepared.select(F.concat(F.array_intersect("tokens", known), F.when(
        verdict.isNotNull(), F.array(F.concat(F.lit("="), verdict)))
        .otherwise(F.array().cast("array<string>"))).alias("items"))
    baskets = keep_table(baskets, "url-baskets")
    rows = baskets.count()
    model = FPGrowth(itemsCol="items", minSupport=MIN_SUPPORT, minConfidence=MIN_CONFIDENCE).fit(baskets)
    says = F.filter("items", lambda x: x.startswith("="))
    sets = keep_table(model.freqItemsets.select(
        F.array_sort(F.array_except("items", says)).alias("tokens"),
        F.substring(F.get(says, F.lit(0)), 2, 9).alias("verdict"), "freq").where(F.size("tokens") > 0), "url-sets")
    rules = keep_table(
        sets.where(F.col("verdict").isNotNull()).withColumnRenamed("freq", "both")
        .join(sets.where(F.col("verdict").isNull()).select("tokens", "freq"), "tokens")
        .select("tokens", "verdict", (F.col("both") / F.col("freq")).alias("confidence"),
                (F.col("both") / F.lit(rows)).alias("support"))
        .where(F.col("confidence") >= MIN_CONFIDENCE), "url-rules")
    # A shorter rule is met under its first token.
    short = rules.select(F.col("tokens")[0].alias("at"), F.col("tokens").alias("fewer"),
                         F.col("verdict").alias("says"), F.col("confidence").alias("surely"))
    longer = rules.where(F.size("tokens") > 1).select("*", F.explode("tokens").alias("at"))
    gone = (longer.join(short, "at").where(
        (F.size("fewer") < F.size("tokens")) & (F.col("says") == F.col("verdict"))
        & (F.col("surely") >= F.col("confidence")) & (F.size(F.array_except("fewer", "tokens")) == 0))
        .select("tokens", "verdict").distinct())
    return [(r["tokens"], r["verdict"], r["confidence"], r["support"])
            for r in rules.join(gone, ["tokens", "verdict"], "left_anti").collect()]


def match(prepared: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, mined): the surest mined rule's verdict of the rows that have one."""
    return (prepared.select("row", "tokens", F.explode("tokens").alias("key"))
            .join(F.broadcast(rules), "key")
            .where(F.size(F.array_except("need", "tokens")) == 0)
            .groupBy("row")
            .agg(F.max(F.struct("confidence", "support", (-F.col("rule_id")).alias("r"), "verdict"))
                 ["verdict"].alias("mined")))


def judge(pages: DataFrame, listed: list[Listed], id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    prepared = keep_table(prepare(pages, listed, id_col, url_col), "urls")
    mined = match(prepared.where(F.col("listed").isNull()), mine(prepared))
    return (prepared.join(mined, "row", "left")
            .select("page_id", "host", "path", F.col("listed.rule").alias("rule"),
                    F.coalesce("listed.verdict", "mined", F.lit(DEFAULT)).alias("verdict")))
