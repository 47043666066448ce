"""Random JSON objects from typed value pools with known expectations."""

import datetime as dt
import random
from decimal import Decimal

from tapeworks.operators.ingest import parse_json

BAD = object()
ABSENT = object()
STR = [('"SYMA"', "SYMA"), ('" SYMB "', "SYMB"), ('""', ""), ("123", BAD), ("null", BAD),
       ("true", BAD), ('["a"]', BAD)]
DATE = [('"2020-08-06"', dt.date(2020, 8, 6)), ('" 2020-08-07 "', dt.date(2020, 8, 7)),
        ('"2020-8-6"', BAD), ("20200806", BAD), ("null", BAD)]
TIME = [('"2020-08-06 09:30:00"', dt.datetime(2020, 8, 6, 9, 30)),
        ('"2020-08-06T09:30:00.25"', dt.datetime(2020, 8, 6, 9, 30, 0, 250000)),
        ('"Aug 6 2020 10:22"', dt.datetime(2020, 8, 6, 10, 22)),
        ('"10:22"', BAD), ("1596706200", BAD), ("null", BAD)]
INT = [("7", 7), ('"7"', 7), ('" 8 "', 8), ("true", 1), ("false", 0), ("-2", -2), ("7.5", BAD),
       ("7.0", BAD), ("3000000000", BAD), ("null", BAD), ('"x"', BAD), ('"7.0"', BAD)]
DEC = [("77.76", Decimal("77.76")), ('"77.76"', Decimal("77.76")), ("76.345", Decimal("76.35")),
       ("77.0", Decimal("77.00")), ("1e2", Decimal("100.00")), ("77", BAD), ("null", BAD),
       ('"NaN"', BAD), ("true", BAD), ("123456789.5", BAD)]
REQUIRED = {"trade_dt": DATE, "file_tm": TIME, "symbol": STR, "event_tm": TIME,
            "event_seq_nb": INT, "exchange": STR}
TARGET = {"file_tm": "arrival_tm", "price": "trade_pr"}
OPTIONAL = {"T": {"price": DEC}, "Q": {"bid_pr": DEC, "bid_size": INT, "ask_pr": DEC, "ask_size": INT}}
KINDS = [('"Q"', "Q"), ('"T"', "T"), ('"X"', None), ("null", None), ('"Q "', None), (ABSENT, None)]


def _pick(rnd, pool):
    good = [p for p in pool if p[1] is not BAD]
    return rnd.choice(good) if rnd.random() < 0.93 else rnd.choice(pool)


def _case(rnd, i):
    kind_tok, kind = rnd.choice(KINDS) if rnd.random() < 0.3 else rnd.choice(KINDS[:2])
    layout = kind or rnd.choice("QT")
    parts, expected, ok = [], {}, kind is not None
    if kind_tok is not ABSENT:
        parts.append(f'"event_type":{kind_tok}')
    for key, pool in REQUIRED.items():
        if rnd.random() < 0.03:
            ok = False  # required key missing
            continue
        tok, val = _pick(rnd, pool)
        parts.append(f'"{key}":{tok}')
        ok &= val is not BAD
        expected[TARGET.get(key, key)] = val
    for key, pool in OPTIONAL[layout].items():
        if rnd.random() < 0.15:
            expected[TARGET.get(key, key)] = None  # absent optional -> NULL
            continue
        tok, val = _pick(rnd, pool)
        parts.append(f'"{key}":{tok}')
        ok &= val is not BAD
        expected[TARGET.get(key, key)] = val
    parts.append(f'"n":{i}')  # extra key, ignored; keeps lines distinct
    rnd.shuffle(parts)
    line = "{" + ",".join(parts) + "}"
    if not ok:
        return line, None
    expected.update(rec_type=kind, partition=kind)
    return line, expected


def test_random_json_lines(spark):
    rnd = random.Random(6)
    cases = dict(_case(rnd, i) for i in range(1500))
    rows = parse_json(spark.createDataFrame([(k,) for k in cases], "value string")).collect()
    assert len(rows) == len(cases)
    valid = [r.asDict() for r in rows if r.partition != "B"]
    for r in rows:
        if r.partition == "B":
            assert cases[r.line] is None, r.line
    expected = [e for e in cases.values() if e is not None]
    assert len(valid) == len(expected) > 300
    cols = ["trade_dt", "arrival_tm", "symbol", "event_tm", "event_seq_nb", "exchange", "trade_pr",
            "bid_pr", "bid_size", "ask_pr", "ask_size", "rec_type", "partition"]
    key = lambda d: tuple(str(d.get(c)) for c in cols)
    assert sorted(map(key, valid)) == sorted(map(key, expected))
