"""Incremental ingest: same rows as the batch parse, and files are taken once."""

import os

from tapeworks.operators.ingest import parse_csv
from tapeworks.streaming.ingest import stage_stream, stage_streams

Q = "2020-08-06,2020-08-06 09:30:00,Q,SYMA,2020-08-06 10:22:28.125,7,NASDAQ,77.76,100,79.25,100"
T = "2020-08-06,2020-08-06 09:30:00,T,SYMA,2020-08-06 10:42:05.500,10,NASDAQ,78.93,300"


def _put(root, day, name, text):
    d = os.path.join(root, day, "b")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write(text)


def test_stream_matches_batch_and_is_incremental(spark, tmp_path):
    root, out, ckpt = str(tmp_path / "csv"), str(tmp_path / "staged"), str(tmp_path / "ckpt")
    _put(root, "2020-08-06", "1.txt", Q + "\nbad\n")
    stage_stream(spark, f"{root}/*/*", "csv", out, ckpt).awaitTermination(120)
    first = spark.read.parquet(out)
    assert sorted(r.partition for r in first.collect()) == ["B", "Q"]
    _put(root, "2020-08-07", "2.txt", T + "\n")
    stage_stream(spark, f"{root}/*/*", "csv", out, ckpt).awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 3  # the first file was not taken again
    batch = parse_csv(spark.read.text(f"{root}/*/*"))
    cols = [c for c in batch.columns]
    assert sorted(map(tuple, got.select(*cols).collect()), key=str) == \
        sorted(map(tuple, batch.collect()), key=str)


J = ('{"trade_dt":"2020-08-06","file_tm":"2020-08-06 09:30:00","event_type":"T","symbol":"SYMB",'
     '"event_tm":"2020-08-06 10:42:05.500","event_seq_nb":11,"exchange":"NYSE","price":78.93,"size":300}')


def test_both_formats_and_a_restart_give_every_row_once(spark, tmp_path):
    paths = {f: str(tmp_path / f) for f in ("csv", "json")}
    out, ckpt = str(tmp_path / "staged"), str(tmp_path / "ckpt")

    def run():
        stage_streams(spark, {f: f"{p}/*/*" for f, p in paths.items()}, out, ckpt).awaitTermination(120)
        return sorted(r.event_seq_nb for r in spark.read.parquet(out).collect())

    _put(paths["csv"], "2020-08-06", "1.txt", Q + "\n")
    _put(paths["json"], "2020-08-06", "1.txt", J + "\n")
    assert run() == [7, 11]
    assert run() == [7, 11]
    _put(paths["json"], "2020-08-07", "2.txt", J.replace('":11', '":12') + "\n")
    _put(paths["csv"], "2020-08-07", "2.txt", T + "\n")
    assert run() == [7, 10, 11, 12]
