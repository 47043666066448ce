import itertools
import random
from collections import Counter

import pytest

from tapeworks.llm import url_rules as U
from tapeworks.llm.queries import LISTED

SCHEMA = "page_id long, url string, html string"


def judged(spark, urls):
    rows = [(i, u, "x") for i, u in enumerate(urls)]
    return {r.page_id: tuple(r)[1:] for r in U.judge(spark.createDataFrame(rows, SCHEMA), LISTED).collect()}


def test_parsing_and_listed_rules(spark):
    urls = ["http://Example.NET/en/1", "https://a.example.net/EN/1?x=/en/", "http://example.net",
            "http://badexample.net/de/", "http://x.example.com/de/?q", "http://example.org/fr/x#y",
            "example.net/en/", None, "", "a://b://c.net/x", "http://net/x", "http://example.net:80/en/",
            "http://ÄB.net/\nx?y", "mailto:x://y.org/fr/"]
    want = [("example.net", "/en/1", "example.net/en/", "allow"),
            ("a.example.net", "/EN/1", "net/", "block"), ("example.net", "", None),
            ("badexample.net", "/de/", "net/", "block"), ("x.example.com", "/de/", "example.com/de/", "block"),
            ("example.org", "/fr/x", "org/fr/", "allow"), ("", "", None), ("", "", None), ("", "", None),
            ("b:", "//c.net/x", None), ("net", "/x", "net/", "block"),
            ("example.net:80", "/en/", None), ("Äb.net", "/\nx", "net/", "block"),
            ("y.org", "/fr/", "org/fr/", "allow")]
    got = judged(spark, urls)
    for i, w in enumerate(want):
        assert got[i][:len(w)] == w, urls[i]


def test_mined_rules_judge_the_rest(spark):
    urls = ([f"http://s{i}.example.com/de/{i}" for i in range(60)] + [f"http://s{i}.example.net/de/{i}" for i in range(60)]
            + [f"http://s{i}.example.org/en/{i}" for i in range(60)] + [f"http://s{i}.example.com/en/{i}" for i in range(60)]
            + ["http://other.info/de/1"])
    got = judged(spark, urls)
    assert got[240] == ("other.info", "/de/1", None, "block")  # as the pages listed under /de/
    assert all(got[i][3] == "allow" for i in range(120, 240))


def test_matching_equals_brute_force(spark):
    rows = [(0, 0, ["a", "b", "c"]), (1, 1, ["a"]), (2, None, []), (3, 3, ["b", "c", "d"])]
    prepared = spark.createDataFrame(rows, "row long, page_id long, tokens array<string>")
    rules = [(0, "b", ["a", "b"], "block", .9, .1), (1, "c", ["c"], "allow", .7, .3),
             (2, "d", ["d", "z"], "block", 1.0, .1), (3, "c", ["b", "c"], "block", .95, .2)]
    df = spark.createDataFrame(rules, "rule_id long, key string, need array<string>, verdict string, "
                                      "confidence double, support double")
    want = {}
    for row, _, tokens in rows:
        fits = [(c, s, -i, v) for i, _, need, v, c, s in rules if set(need) <= set(tokens)]
        if fits:
            want[row] = max(fits)[3]
    assert {r["row"]: r.mined for r in U.match(prepared, df).collect()} == want


@pytest.mark.parametrize("urls", [[], [None, None], ["http://a/b"] * 3])
def test_no_rules_to_mine(spark, urls):
    assert all(v[2:] == (None, "allow") for v in judged(spark, urls).values())


def test_a_url_of_many_tokens_is_mined_in_bounds(spark):
    long = "http://" + ".".join(f"h{c}" for c in "abcdefghijklmnop") + ".net/" + "/".join("qrstuvwxyz" * 3)
    got = judged(spark, [long] * 40 + ["http://example.org/en/"] * 20)
    assert got[0][2:] == ("net/", "block")


def test_mining_equals_brute_force_beyond_64_tokens_and_8_of_a_url(spark):
    rng, rows = random.Random(5), []
    for i in range(700):
        tokens = rng.sample([f"t{k}" for k in range(90)], rng.randint(3, 11))
        odds = 0.9 if {"t88", "t89"} & set(tokens) else 0.4
        says = rng.choice(["block" if rng.random() < odds else "allow", None])
        if says == "block":
            tokens += ["z sure", "z same"][:rng.choice([0, 2])]
        rows.append((i, tokens, (("rule", says) if says else None)))
    with_set, with_verdict = Counter(), Counter()
    for _, tokens, listed in rows:
        for k in range(1, 5):
            for x in itertools.combinations(sorted(tokens), k):
                with_set[x] += 1
                if listed:
                    with_verdict[x, listed[1]] += 1
    least = U.MIN_SUPPORT * len(rows)
    assert not any(n >= least and len(x) == 4 and "z same" not in x and "z sure" not in x
                   for (x, _), n in with_verdict.items())
    rules = {(x, v): n / with_set[x] for (x, v), n in with_verdict.items()
             if n >= least and n / with_set[x] >= U.MIN_CONFIDENCE and "z sure" not in x}
    want = {(x, v): c for (x, v), c in rules.items()
            if not any(rules.get((y, v), 0) >= c for k in range(1, len(x)) for y in itertools.combinations(x, k))}
    prepared = spark.createDataFrame(rows, "row long, tokens array<string>, "
                                           "listed struct<rule:string,verdict:string>")
    got = {(tuple(r.need), r.verdict): r.confidence for r in U.mine(prepared).collect()}
    assert got == pytest.approx(want)
