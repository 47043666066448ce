
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tapeworks import schema as S
from tapeworks.operators.ingest import parse_csv, parse_json

Q = "2020-08-06,2020-08-06 09:30:00,Q,SYMA,2020-08-06 10:22:28.125,7,NASDAQ,77.76,100,79.25,100"
T = "2020-08-06,2020-08-06 09:30:00,T,SYMA,2020-08-06 10:42:05.500,10,NASDAQ,78.93,300"
JT = ('{"trade_dt":"2020-08-06","file_tm":"2020-08-06 09:30:00","event_type":"T","symbol":"SYMC",'
      '"event_tm":"2020-08-06 13:13:00","event_seq_nb":30,"exchange":"NYSE","price":160.15,"size":100}')
JQ = ('{"trade_dt":"2020-08-06","file_tm":"2020-08-06 09:30:00","event_type":"Q","symbol":"SYMC",'
      '"event_tm":"2020-08-06 13:13:00","event_seq_nb":31,"exchange":"NYSE","bid_pr":160.15,'
      '"bid_size":100,"ask_pr":161.00,"ask_size":200}')


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_csv_quote_and_trade(spark, lines):
    q = one(parse_csv(lines(Q)))
    assert q["partition"] == "Q" and q["rec_type"] == "Q" and q["line"] is None
    assert q["trade_dt"] == dt.date(2020, 8, 6)
    assert q["event_tm"] == dt.datetime(2020, 8, 6, 10, 22, 28, 125000)
    assert q["arrival_tm"] == dt.datetime(2020, 8, 6, 9, 30)
    assert (q["bid_pr"], q["bid_size"], q["ask_pr"], q["ask_size"]) == (Decimal("77.76"), 100, Decimal("79.25"), 100)
    assert q["trade_pr"] is None
    t = one(parse_csv(lines(T)))
    assert t["partition"] == "T" and t["trade_pr"] == Decimal("78.93") and t["bid_pr"] is None
    assert t["event_seq_nb"] == 10


def _fields(line, i, value):
    f = line.split(",")
    f[i] = value
    return ",".join(f)


BAD_CSV = {
    "wrong arity": Q + ",1",
    "trade arity": T + ",1",
    "fewer than 3 fields (E1)": "2020-08-06,x",
    "blank line (E1)": "",
    "unknown type": _fields(Q, 2, "X"),
    "type with trailing space (E6)": _fields(Q, 2, "Q "),
    "empty numeric field (E3)": _fields(Q, 7, ""),
    "empty int field (E3)": _fields(Q, 8, ""),
    "bad int": _fields(Q, 5, "7a"),
    "float int": _fields(Q, 8, "100.0"),
    "year-only date": _fields(Q, 0, "2020"),
    "unpadded date": _fields(Q, 0, "2020-8-6"),
    "date with trailing text": _fields(Q, 0, "2020-08-06 junk"),
    "time-only timestamp": _fields(Q, 4, "10:22"),
    "decimal out of range (E10)": _fields(Q, 7, "123456789.00"),
    "int out of range (E10)": _fields(Q, 5, "3000000000"),
    "python-only int": _fields(Q, 5, "1_0"),
    "nan decimal": _fields(Q, 7, "NaN"),
}


@pytest.mark.parametrize("case", sorted(BAD_CSV))
def test_csv_quarantine(spark, lines, case):
    r = one(parse_csv(lines(BAD_CSV[case])))
    assert r["partition"] == "B"
    assert r["line"] == BAD_CSV[case]
    for f in S.COMMON_SCHEMA.fields:
        if f.name not in ("partition", "line"):
            assert r[f.name] == S.sentinel_for(f.dataType), f.name


def test_csv_unusual_but_valid(spark, lines):
    padded = one(parse_csv(lines(_fields(_fields(Q, 3, " \tSYMA  "), 7, " 77.765 "))))
    assert padded["partition"] == "Q" and padded["symbol"] == "SYMA"
    assert padded["bid_pr"] == Decimal("77.77")  # half-up
    empty_sym = one(parse_csv(lines(_fields(Q, 3, ""))))  # E5
    assert empty_sym["partition"] == "Q" and empty_sym["symbol"] == ""
    iso_t = one(parse_csv(lines(_fields(Q, 4, "2020-08-06T10:22:28"))))
    assert iso_t["event_tm"] == dt.datetime(2020, 8, 6, 10, 22, 28)
    named = one(parse_csv(lines(_fields(Q, 4, "Aug 6 2020 10:22"))))
    assert named["event_tm"] == dt.datetime(2020, 8, 6, 10, 22)
    size_float = one(parse_csv(lines(_fields(T, 8, "1.5"))))  # trade size is not read
    assert size_float["partition"] == "T"


def test_csv_date_from_record_not_folder(spark, lines):  # E7
    r = one(parse_csv(lines(_fields(Q, 0, "2021-01-04"))))
    assert r["trade_dt"] == dt.date(2021, 1, 4)


def test_json_trade_and_quote(spark, lines):
    t = one(parse_json(lines(JT)))
    assert t["partition"] == "T" and t["trade_pr"] == Decimal("160.15") and t["symbol"] == "SYMC"
    q = one(parse_json(lines(JQ)))
    assert q["partition"] == "Q" and q["ask_pr"] == Decimal("161.00") and q["ask_size"] == 200


def _j(base, **kv):
    import json
    d = json.loads(base)
    for k, v in kv.items():
        if v is _DROP:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


_DROP = object()

BAD_JSON = {
    "broken JSON": JT[:-1],
    "array": "[1, 2]",
    "string scalar": '"x"',
    "JSON null line": "null",
    "trailing text": JT + " x",
    "two objects": JT + " " + JT,
    "two objects, comma": JT + "," + JT,
    "text between objects": JT + " xx " + JT,
    "array closed and reopened": JT + "],[" + JT,
    "an object and a key": JT + ',"b":' + JT,
    "no event_type (E2)": _j(JT, event_type=_DROP),
    "unknown type": _j(JT, event_type="X"),
    "type not a string": _j(JT, event_type=1),
    "integer price (E4)": _j(JT, price=160),
    "null price (E4)": _j(JT, price=None),
    "float seq": _j(JT, event_seq_nb=30.5),
    "numeric symbol": _j(JT, symbol=123),
    "missing required key": _j(JT, exchange=_DROP),
    "bad date": _j(JT, trade_dt="2020-8-6"),
    "date not a string": _j(JT, trade_dt=20200806),
    "int out of range": _j(JT, event_seq_nb=3_000_000_000),
    "blank": "",
}


@pytest.mark.parametrize("case", sorted(BAD_JSON))
def test_json_quarantine(spark, lines, case):
    r = one(parse_json(lines(BAD_JSON[case])))
    assert r["partition"] == "B" and r["line"] == BAD_JSON[case]
    assert r["rec_type"] == "INVALID" and r["trade_pr"] == Decimal("-1.00")


def test_json_unusual_but_valid(spark, lines):
    no_price = one(parse_json(lines(_j(JT, price=_DROP))))  # E27
    assert no_price["partition"] == "T" and no_price["trade_pr"] is None
    strings = one(parse_json(lines(_j(JT, price="160.15", event_seq_nb="30"))))
    assert strings["trade_pr"] == Decimal("160.15") and strings["event_seq_nb"] == 30
    target = one(parse_json(lines(_j(JT, file_tm=_DROP, price=_DROP, arrival_tm="2020-08-06 09:31:00",
                                      trade_pr=1.5))))  # E26
    assert target["arrival_tm"] == dt.datetime(2020, 8, 6, 9, 31) and target["trade_pr"] == Decimal("1.50")
    extra = one(parse_json(lines(_j(JT, venue="X", line="zzz", partition="Q"))))  # E8
    assert extra["line"] is None and extra["partition"] == "T"
    padded = one(parse_json(lines(_j(JT, symbol="  SYMC "))))
    assert padded["symbol"] == "SYMC"
    boolean = one(parse_json(lines(_j(JQ, bid_size=True))))
    assert boolean["bid_size"] == 1
    exact = one(parse_json(lines(_j(JT, price=76.345))))  # E9: exact text, half-up
    assert exact["trade_pr"] == Decimal("76.35")
    floaty = one(parse_json(lines(_j(JT, price=77.0))))
    assert floaty["trade_pr"] == Decimal("77.00")


def test_json_loose_types(spark, lines):
    r = one(parse_json(lines(_j(JT, price=160)), strict_json_types=False))
    assert r["partition"] == "T" and r["trade_pr"] == Decimal("160.00")
    r = one(parse_json(lines(_j(JQ, bid_pr=None)), strict_json_types=False))
    assert r["partition"] == "Q" and r["bid_pr"] is None


def test_every_line_yields_one_row(spark, lines):
    values = [Q, T, JT, "", "x", *BAD_CSV.values()]
    assert parse_csv(lines(*values)).count() == len(values)
    assert parse_json(lines(*values)).count() == len(values)


def test_no_python_in_ingest_plan(spark, lines):
    for df in (parse_csv(lines(Q)), parse_json(lines(JT))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "ArrowEval" not in plan


def test_filter_on_partition_is_not_expanded(spark, lines):
    df = parse_csv(lines(Q, T, "")).where("partition = 'T'")
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 200_000
    assert df.count() == 1


def test_results_do_not_depend_on_session_zone(spark, lines):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            good = one(parse_csv(lines(_fields(Q, 4, "Aug 6 2020 10:22"))))
            assert good["event_tm"] == dt.datetime(2020, 8, 6, 10, 22)
            assert good["arrival_tm"] == dt.datetime(2020, 8, 6, 9, 30)
            gap = one(parse_csv(lines(_fields(Q, 4, "Mar 8 2020 02:30"))))  # DST gap in New York
            assert gap["event_tm"] == dt.datetime(2020, 3, 8, 2, 30)
            bad = one(parse_json(lines("{}")))
            assert bad["event_tm"] == dt.datetime(2000, 1, 1) and bad["trade_dt"] == dt.date(2000, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


@pytest.mark.parametrize("text,want", [
    ("2020-08-06T10:22:28Z", "2020-08-06 10:22:28"), ("2020-08-06T10:22:28+00:00", "2020-08-06 10:22:28"),
    ("2020-08-06T10:22:28-04:00", "2020-08-06 14:22:28"), ("2020-08-06 10:22:28.125 +0530", "2020-08-06 04:52:28.125"),
    ("2020-08-06 10:22 PM", "2020-08-06 22:22:00"), ("2020-8-6 10:22", "2020-08-06 10:22:00"),
    ("8/6/2020 10:22", "2020-08-06 10:22:00"), ("08/06/20 10:22", "2020-08-06 10:22:00"),
    ("6-Aug-2020 10:22", "2020-08-06 10:22:00"), ("20200806", "2020-08-06 00:00:00"),
    ("Thu Aug 6 10:22:28 2020", "2020-08-06 10:22:28"), ("Aug 6, 2020 1:05 am", "2020-08-06 01:05:00"),
    ("Thursday, 6 Aug 2020 10:22", "2020-08-06 10:22:00"), ("20200806T102228Z", "2020-08-06 10:22:28"),
    ("06-08-2020", None), ("10:22", None), ("10:22Z", None), ("2020-08-06 junk", None), ("", None),
    ("2020-08-06 25:00", None), ("13/13/2020", None)])
def test_lenient_timestamps(spark, text, want):
    from tapeworks.functions.text import lenient_timestamp
    got = spark.createDataFrame([(text,)], "v string").select(
        lenient_timestamp(F.col("v")).cast("string").alias("t")).first().t
    assert got == want
