"""DuckDB SQL that computes, independently, what each registered query must
return. Run against the driver's tables (views ``events``, ``lineitem``,
``orders``). The SQL restates the adapter rules of :mod:`tapeworks.fixtures`
and the operator semantics with DuckDB's own tools (ASOF joins, ``arg_max``,
``QUALIFY``, integer cents for the decimal mean)."""

from __future__ import annotations

BASE = """
kinds AS (
  SELECT *, CASE WHEN event_type IN ('purchase', 'signup')
                      AND NOT (user_id % 10 = 3 AND day(ts) % 5 = 0) THEN 'T' ELSE 'Q' END AS kind
  FROM events
),
base AS (
  SELECT event_id,
    CAST(ts AS DATE) AS trade_dt,
    kind AS rec_type,
    'SYM' || CAST(user_id % 10 AS VARCHAR) AS symbol,
    CASE WHEN (user_id // 10) % 2 = 0 THEN 'NYSE' ELSE 'NASDAQ' END AS exchange,
    date_trunc('minute', ts) AS event_tm,
    CAST(event_id AS INTEGER) AS event_seq_nb,
    ts AS arrival_tm,
    CASE WHEN kind = 'T' THEN CAST(value AS DECIMAL(10,2)) END AS trade_pr,
    CASE WHEN kind = 'Q' THEN CAST(value AS DECIMAL(10,2)) END AS bid_pr,
    CASE WHEN kind = 'Q' THEN CAST(100 * (1 + event_id % 5) AS INTEGER) END AS bid_size,
    CASE WHEN kind = 'Q' THEN CAST(CAST(value AS DECIMAL(10,2)) + 1 AS DECIMAL(10,2)) END AS ask_pr,
    CASE WHEN kind = 'Q' THEN CAST(100 * (1 + user_id % 5) AS INTEGER) END AS ask_size,
    kind AS partition,
    CAST(NULL AS VARCHAR) AS line,
    CASE WHEN kind = 'T' THEN CAST(100 * (1 + event_id % 3) AS INTEGER) END AS trade_size,
    CAST(event_id % 50 AS INTEGER) AS c
  FROM kinds
)"""

COMMON = ("trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb, arrival_tm, "
          "trade_pr, bid_pr, bid_size, ask_pr, ask_size, partition, line")

TICKS = BASE + f""",
priced AS (
  SELECT * REPLACE (CASE WHEN event_id % 13 <> 5 THEN trade_pr END AS trade_pr,
                    CASE WHEN event_id % 13 <> 5 THEN bid_pr END AS bid_pr) FROM base
),
ticks AS (
  SELECT {COMMON} FROM priced
  UNION ALL
  SELECT trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb,
         arrival_tm + INTERVAL 1 HOUR,
         CAST(trade_pr + 0.50 AS DECIMAL(10,2)), CAST(bid_pr + 0.50 AS DECIMAL(10,2)), bid_size,
         CAST(ask_pr + 0.50 AS DECIMAL(10,2)), ask_size, partition, line
  FROM priced WHERE event_id % 7 = 0
  UNION ALL
  SELECT {COMMON} FROM priced WHERE event_id % 11 = 0
),
trades AS (
  SELECT trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, trade_pr
  FROM ticks WHERE partition = 'T'
),
quotes AS (
  SELECT trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm,
         bid_pr, bid_size, ask_pr, ask_size
  FROM ticks WHERE partition = 'Q'
)"""

TRADE_COLS = "trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, trade_pr"
QUOTE_COLS = ("trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, "
              "bid_pr, bid_size, ask_pr, ask_size")


def _cents_mean(part: str, order: str, value: str, width: str = "30 MINUTES") -> str:
    """Half-up mean to 2 decimals from integer cents over a RANGE frame."""
    w = f"(PARTITION BY {part} ORDER BY {order} RANGE BETWEEN INTERVAL {width} PRECEDING AND CURRENT ROW)"
    s = f"sum(CAST(round({value} * 100) AS BIGINT)) OVER {w}"
    n = f"count({value}) OVER {w}"
    return (f"CASE WHEN {n} > 0 THEN CAST(CAST(({s} * 2 + {n}) // ({n} * 2) AS DECIMAL(18,0)) / 100 "
            f"AS DECIMAL(10,2)) END")


MEAN = f""",
tavg AS (
  SELECT *, {_cents_mean('symbol, exchange', 'event_tm', 'trade_pr')} AS mov_avg_trade_pr FROM trades
),
last_px AS (
  SELECT symbol, exchange, event_tm,
         arg_max(trade_pr, (event_seq_nb, arrival_tm, trade_pr)) AS px
  FROM trades WHERE trade_pr IS NOT NULL GROUP BY symbol, exchange, event_tm
),
last_avg AS (
  SELECT symbol, exchange, event_tm,
         arg_max(mov_avg_trade_pr, (event_seq_nb, arrival_tm, trade_pr, mov_avg_trade_pr)) AS mavg
  FROM tavg WHERE mov_avg_trade_pr IS NOT NULL GROUP BY symbol, exchange, event_tm
),
dclose AS (
  SELECT symbol, exchange, trade_dt,
         arg_max_null(trade_pr, (event_tm, event_seq_nb, arrival_tm, trade_pr)) AS close_trade_pr
  FROM trades GROUP BY symbol, exchange, trade_dt
),
pclose AS (
  SELECT symbol, exchange, trade_dt,
         lag(close_trade_pr) OVER (PARTITION BY symbol, exchange ORDER BY trade_dt) AS prior_close_trade_pr
  FROM dclose
),
dq AS (SELECT DISTINCT {QUOTE_COLS} FROM quotes),
qa AS (
  SELECT q.*, lp.px AS prior_trade_pr, la.mavg AS prior_mov_avg_trade_pr
  FROM dq q
  ASOF LEFT JOIN last_px lp
    ON q.symbol = lp.symbol AND q.exchange = lp.exchange AND q.event_tm >= lp.event_tm
  ASOF LEFT JOIN last_avg la
    ON q.symbol = la.symbol AND q.exchange = la.exchange AND q.event_tm >= la.event_tm
)"""

ANALYTICS = ("qa.trade_dt, qa.symbol, qa.exchange, qa.event_tm, qa.prior_trade_pr, "
             "qa.prior_mov_avg_trade_pr, pc.prior_close_trade_pr")


def _with(*parts: str) -> str:
    return "WITH " + "".join(parts).lstrip().rstrip(",")


# --- feed lines -----------------------------------------------------------

LINE_FIELDS = """,
lf AS (
  SELECT b.*,
    strftime(trade_dt, '%Y-%m-%d') AS f_d,
    strftime(arrival_tm, '%Y-%m-%d %H:%M:%S.%f') AS f_ftm,
    strftime(event_tm, '%Y-%m-%d %H:%M:%S.%g') AS f_etm,
    CAST(event_seq_nb AS VARCHAR) AS f_seq,
    CAST(COALESCE(trade_pr, bid_pr) AS VARCHAR) AS f_p1,
    CAST(COALESCE(trade_size, bid_size) AS VARCHAR) AS f_s1,
    CAST(ask_pr AS VARCHAR) AS f_ask,
    CAST(ask_size AS VARCHAR) AS f_asz
  FROM base b
)"""

CSV_LINES = LINE_FIELDS + """,
csv_parts AS (
  SELECT *,
    CASE WHEN c = 7 THEN strftime(trade_dt, '%Y')
         WHEN c = 8 THEN strftime(trade_dt, '%Y-%-m-%-d')
         WHEN c = 9 THEN f_d || ' x' ELSE f_d END AS x_d,
    CASE WHEN c = 3 THEN 'X' WHEN c = 4 THEN rec_type || ' ' ELSE rec_type END AS x_kind,
    CASE WHEN c = 13 THEN '  ' || symbol || '  ' WHEN c = 14 THEN '' ELSE symbol END AS x_sym,
    CASE WHEN c = 10 THEN strftime(event_tm, '%H:%M')
         WHEN c = 15 THEN strftime(event_tm, '%Y-%m-%dT%H:%M:%S')
         WHEN c = 16 THEN strftime(event_tm, '%b %-d %Y %H:%M') ELSE f_etm END AS x_etm,
    CASE WHEN c = 6 THEN 'abc' WHEN c = 12 THEN '3000000000' ELSE f_seq END AS x_seq,
    CASE WHEN c = 5 THEN '' WHEN c = 11 THEN '12345678901.00'
         WHEN c = 13 THEN ' ' || f_p1 || ' ' WHEN c = 17 THEN f_p1 || '5' ELSE f_p1 END AS x_p1
  FROM lf
),
csv_lines AS (
  SELECT *,
    CASE WHEN c = 0 THEN
           CASE WHEN rec_type = 'T' THEN concat_ws(',', x_d, f_ftm, x_kind, x_sym, x_etm, x_seq, exchange, x_p1)
                ELSE concat_ws(',', x_d, f_ftm, x_kind, x_sym, x_etm, x_seq, exchange, x_p1, f_s1, f_ask) END
         WHEN c = 1 THEN ''
         WHEN c = 2 THEN concat_ws(',', x_d, f_ftm)
         ELSE CASE WHEN rec_type = 'T' THEN concat_ws(',', x_d, f_ftm, x_kind, x_sym, x_etm, x_seq, exchange, x_p1, f_s1)
                   ELSE concat_ws(',', x_d, f_ftm, x_kind, x_sym, x_etm, x_seq, exchange, x_p1, f_s1, f_ask, f_asz) END
    END AS value
  FROM csv_parts
)"""

JSON_LINES = LINE_FIELDS + """,
json_parts AS (
  SELECT *,
    '{' || concat_ws(',',
      '"trade_dt":"' || CASE WHEN c = 10 THEN strftime(trade_dt, '%Y') ELSE f_d END || '"',
      CASE WHEN c = 12 THEN '"arrival_tm":"' ELSE '"file_tm":"' END || f_ftm || '"',
      CASE WHEN c <> 3 THEN '"event_type":"' || CASE WHEN c = 4 THEN 'X' ELSE rec_type END || '"' END,
      '"symbol":' || CASE WHEN c = 8 THEN '123' WHEN c = 14 THEN '" ' || symbol || ' "'
                          ELSE '"' || symbol || '"' END,
      '"event_tm":"' || f_etm || '"',
      '"event_seq_nb":' || CASE WHEN c = 7 THEN f_seq || '.5' WHEN c = 11 THEN '"' || f_seq || '"'
                                ELSE f_seq END,
      CASE WHEN c <> 9 THEN '"exchange":"' || exchange || '"' END,
      CASE WHEN c <> 15 THEN
        '"' || CASE WHEN rec_type = 'T' THEN CASE WHEN c = 12 THEN 'trade_pr' ELSE 'price' END
                    ELSE 'bid_pr' END || '":' ||
        CASE WHEN c = 5 THEN CAST(CAST(floor(COALESCE(trade_pr, bid_pr)) AS BIGINT) AS VARCHAR)
             WHEN c = 6 THEN 'null'
             WHEN c = 11 THEN '"' || f_p1 || '"' ELSE f_p1 END END,
      '"' || CASE WHEN rec_type = 'T' THEN 'size' ELSE 'bid_size' END || '":' ||
        CASE WHEN c = 16 THEN 'true' ELSE f_s1 END,
      CASE WHEN rec_type = 'Q' THEN '"ask_pr":' || f_ask END,
      CASE WHEN rec_type = 'Q' THEN '"ask_size":' || f_asz END,
      CASE WHEN c = 13 THEN '"venue":"X","line":"zzz"' END
    ) || '}' AS body
  FROM lf
),
json_lines AS (
  SELECT *,
    CASE WHEN c = 0 THEN substr(body, 1, length(body) - 1)
         WHEN c = 1 THEN '[1,2]' WHEN c = 2 THEN '' WHEN c = 17 THEN '"hello"'
         ELSE body END AS value
  FROM json_parts
)"""

CSV_BAD = "(0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)"
JSON_BAD = "(0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 17)"

SENTINELS = ("DATE '2000-01-01' AS trade_dt, 'INVALID' AS rec_type, 'INVALID' AS symbol, "
             "'INVALID' AS exchange, TIMESTAMP '2000-01-01 00:00:00' AS event_tm, "
             "-1 AS event_seq_nb, TIMESTAMP '2000-01-01 00:00:00' AS arrival_tm, "
             "CAST(-1 AS DECIMAL(10,2)) AS trade_pr, CAST(-1 AS DECIMAL(10,2)) AS bid_pr, "
             "-1 AS bid_size, CAST(-1 AS DECIMAL(10,2)) AS ask_pr, -1 AS ask_size, "
             "'B' AS partition, value AS line")

CSV_VALID_COLS = """trade_dt, rec_type, CASE WHEN c = 14 THEN '' ELSE symbol END AS symbol, exchange,
  event_tm, event_seq_nb, arrival_tm,
  CASE WHEN c = 17 THEN CAST(trade_pr + 0.01 AS DECIMAL(10,2)) ELSE trade_pr END AS trade_pr,
  CASE WHEN c = 17 THEN CAST(bid_pr + 0.01 AS DECIMAL(10,2)) ELSE bid_pr END AS bid_pr,
  bid_size, ask_pr, ask_size, partition"""

JSON_VALID_COLS = """trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb, arrival_tm,
  CASE WHEN c = 15 THEN NULL ELSE trade_pr END AS trade_pr,
  CASE WHEN c = 15 THEN NULL ELSE bid_pr END AS bid_pr,
  CASE WHEN c = 16 AND rec_type = 'Q' THEN 1 ELSE bid_size END AS bid_size,
  ask_pr, ask_size, partition"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["text_line_count"] = _with(BASE) + " SELECT 2 * count(*) AS n_lines FROM base"
    q["stage_csv_valid"] = _with(BASE) + f" SELECT {CSV_VALID_COLS} FROM base WHERE c NOT IN {CSV_BAD}"
    q["stage_csv_quarantine"] = (_with(BASE, CSV_LINES)
                                 + f" SELECT {SENTINELS} FROM csv_lines WHERE c IN {CSV_BAD}")
    q["stage_json_valid"] = _with(BASE) + f" SELECT {JSON_VALID_COLS} FROM base WHERE c NOT IN {JSON_BAD}"
    q["stage_json_quarantine"] = (_with(BASE, JSON_LINES)
                                  + f" SELECT {SENTINELS} FROM json_lines WHERE c IN {JSON_BAD}")
    staged_all = (f" SELECT {CSV_VALID_COLS}, CAST(NULL AS VARCHAR) AS line FROM base WHERE c NOT IN {CSV_BAD}"
                  f" UNION ALL SELECT {SENTINELS} FROM csv_lines WHERE c IN {CSV_BAD}"
                  f" UNION ALL SELECT {JSON_VALID_COLS}, CAST(NULL AS VARCHAR) AS line FROM base WHERE c NOT IN {JSON_BAD}"
                  f" UNION ALL SELECT {SENTINELS} FROM json_lines WHERE c IN {JSON_BAD}")
    q["stage_multi_source"] = _with(BASE, CSV_LINES, JSON_LINES.replace(LINE_FIELDS, "")) + staged_all
    q["stage_roundtrip"] = (_with(BASE, CSV_LINES, JSON_LINES.replace(LINE_FIELDS, ""))
                            + f" SELECT partition, count(*) AS n_rows, CAST(sum(event_seq_nb) AS BIGINT) AS sum_seq"
                              f" FROM ({staged_all}) s GROUP BY partition")
    q["trades_only"] = _with(TICKS) + f" SELECT {TRADE_COLS} FROM trades"
    q["quotes_only"] = _with(TICKS) + f" SELECT {QUOTE_COLS} FROM quotes"
    q["quotes_extended"] = (_with(TICKS) + f" SELECT {QUOTE_COLS}, CAST(NULL AS DECIMAL(10,2)) AS mov_avg_trade_pr"
                            " FROM quotes")
    q["keep_latest_lineitem"] = ("SELECT * FROM lineitem QUALIFY l_shipdate = "
                                 "max(l_shipdate) OVER (PARTITION BY l_orderkey, l_linenumber)")
    latest = ("QUALIFY arrival_tm = max(arrival_tm) OVER "
              "(PARTITION BY trade_dt, symbol, exchange, event_tm, event_seq_nb)")
    q["eod_trades"] = _with(TICKS) + f" SELECT {TRADE_COLS} FROM trades {latest}"
    q["eod_quotes"] = _with(TICKS) + f" SELECT {QUOTE_COLS} FROM quotes {latest}"
    q["dated_report_roundtrip"] = (_with(TICKS) + f" SELECT {TRADE_COLS}, trade_dt AS report_date"
                                   f" FROM trades {latest}")
    q["trailing_mean_30m"] = _with(TICKS, MEAN) + f" SELECT {TRADE_COLS}, mov_avg_trade_pr FROM tavg"
    q["trailing_mean_bucketed"] = q["trailing_mean_30m"]
    ev_mean = _cents_mean("event_type", "ts", "CAST(value AS DECIMAL(10,2))")
    q["trailing_mean_events"] = (f"SELECT event_id, event_type, ts, CAST(value AS DECIMAL(10,2)) AS px, "
                                 f"{ev_mean} AS mean_px FROM events")
    q["trailing_mean_events_bucketed"] = q["trailing_mean_events"]
    q["trailing_mean_events_fine"] = q["trailing_mean_events"]
    q["trailing_mean_double"] = (
        "SELECT event_id, CAST(round(avg(value / 7) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN"
        " INTERVAL 30 MINUTES PRECEDING AND CURRENT ROW), 6) AS DECIMAL(18,6)) AS mean_x FROM events")
    q["eod_trades_merged"] = q["eod_trades"]
    q["trades_union_quotes"] = (_with(TICKS, MEAN)
        + f" SELECT {COMMON}, CAST({_cents_mean('symbol, exchange', 'event_tm', 'trade_pr')} AS DECIMAL(10,2))"
          " AS mov_avg_trade_pr FROM ticks WHERE partition = 'T'"
          f" UNION SELECT {COMMON}, CAST(NULL AS DECIMAL(10,2)) FROM ticks WHERE partition = 'Q'")
    q["last_trade_asof"] = (_with(TICKS, MEAN) + f" SELECT q.*, lp.px AS prior_trade_pr FROM quotes q"
                            " ASOF LEFT JOIN last_px lp ON q.symbol = lp.symbol AND q.exchange = lp.exchange"
                            " AND q.event_tm >= lp.event_tm")
    q["last_trade_asof_bucketed"] = q["last_trade_asof"]
    q["last_trade_asof_two_level"] = q["last_trade_asof"]
    q["last_avg_asof"] = (_with(TICKS, MEAN) + f" SELECT q.*, la.mavg AS prior_mov_avg_trade_pr FROM quotes q"
                          " ASOF LEFT JOIN last_avg la ON q.symbol = la.symbol AND q.exchange = la.exchange"
                          " AND q.event_tm >= la.event_tm")
    ev_asof = """WITH p AS (
        SELECT user_id % 10 AS k, ts, arg_max(CAST(value AS DECIMAL(10,2)), (event_id, CAST(value AS DECIMAL(10,2)))) AS px
        FROM events WHERE event_type = 'purchase' GROUP BY ALL)
      SELECT v.event_id, v.user_id % 10 AS k, v.ts, p.px AS last_purchase_px
      FROM events v ASOF LEFT JOIN p ON v.user_id % 10 = p.k AND v.ts >= p.ts
      WHERE v.event_type = 'view'"""
    q["last_known_events"] = ev_asof
    q["last_known_events_bucketed"] = ev_asof
    q["daily_close"] = _with(TICKS, MEAN) + " SELECT symbol, exchange, trade_dt, close_trade_pr FROM dclose"
    q["prior_close"] = _with(TICKS, MEAN) + " SELECT symbol, exchange, trade_dt, prior_close_trade_pr FROM pclose"
    flagship = (_with(TICKS, MEAN) + f" SELECT {ANALYTICS} FROM qa JOIN pclose pc"
                " ON qa.trade_dt = pc.trade_dt AND qa.symbol = pc.symbol AND qa.exchange = pc.exchange")
    q["quote_analytics"] = flagship
    q["quote_analytics_unbucketed"] = flagship
    q["quote_analytics_bucketed"] = flagship
    q["quote_analytics_ghost"] = flagship
    q["quote_analytics_left"] = (_with(TICKS, MEAN)
        + " SELECT qa.trade_dt, qa.symbol, qa.exchange, qa.event_tm, qa.prior_trade_pr,"
          " qa.prior_mov_avg_trade_pr, dc.close_trade_pr AS prior_close_trade_pr FROM qa"
          " ASOF LEFT JOIN dclose dc ON qa.symbol = dc.symbol AND qa.exchange = dc.exchange"
          " AND qa.trade_dt > dc.trade_dt")
    latest_trades = (",\ntrades_l AS (SELECT * FROM trades QUALIFY arrival_tm = max(arrival_tm) OVER"
                     " (PARTITION BY trade_dt, symbol, exchange, event_tm, event_seq_nb))")
    q["quote_analytics_latest"] = (_with(TICKS, latest_trades, MEAN.replace("FROM trades", "FROM trades_l"))
        + f" SELECT {ANALYTICS} FROM qa JOIN pclose pc"
          " ON qa.trade_dt = pc.trade_dt AND qa.symbol = pc.symbol AND qa.exchange = pc.exchange")
    q["analytics_all_days"] = (_with(TICKS, MEAN)
        + " SELECT qa.symbol, qa.exchange, qa.event_tm, qa.prior_trade_pr, qa.prior_mov_avg_trade_pr,"
          " pc.prior_close_trade_pr FROM qa JOIN pclose pc"
          " ON qa.trade_dt = pc.trade_dt AND qa.symbol = pc.symbol AND qa.exchange = pc.exchange")
    q["eod_trades_tie_break"] = (_with(TICKS) + f" SELECT {TRADE_COLS} FROM trades QUALIFY row_number() OVER"
        " (PARTITION BY trade_dt, symbol, exchange, event_tm, event_seq_nb"
        " ORDER BY arrival_tm DESC, trade_pr DESC) = 1")
    q["price_movement"] = (_with(TICKS, MEAN) + f" SELECT {ANALYTICS}, qa.bid_pr, qa.ask_pr,"
        " qa.bid_pr - pc.prior_close_trade_pr AS bid_pr_move, qa.ask_pr - pc.prior_close_trade_pr AS ask_pr_move"
        " FROM qa JOIN pclose pc"
        " ON qa.trade_dt = pc.trade_dt AND qa.symbol = pc.symbol AND qa.exchange = pc.exchange")
    q["report_head"] = (f"SELECT * FROM ({flagship}) r ORDER BY symbol, exchange, event_tm,"
                        " trade_dt NULLS FIRST, prior_trade_pr NULLS FIRST,"
                        " prior_mov_avg_trade_pr NULLS FIRST, prior_close_trade_pr NULLS FIRST LIMIT 20")
    q["report_sorted_files"] = ("SELECT row_number() OVER (ORDER BY symbol, exchange, event_tm) AS place,"
                                f" symbol, exchange, event_tm FROM ({flagship}) r")
    day = "DATE '2024-01-15'"
    q["eod_trades_day"] = _with(TICKS) + f" SELECT {TRADE_COLS} FROM trades WHERE trade_dt = {day} {latest}"
    q["quote_analytics_day"] = flagship + f" WHERE qa.trade_dt = {day}"
    q["dated_report_day"] = _with(TICKS) + f" SELECT {QUOTE_COLS} FROM quotes WHERE trade_dt = {day} {latest}"
    two_days = (_with(BASE, CSV_LINES, JSON_LINES.replace(LINE_FIELDS, ""))
                + f", s AS (SELECT {CSV_VALID_COLS}, ts_day FROM (SELECT *, trade_dt AS ts_day FROM base)"
                  f" WHERE c NOT IN {CSV_BAD}"
                  f" UNION ALL SELECT {JSON_VALID_COLS}, ts_day FROM (SELECT *, trade_dt AS ts_day FROM base)"
                  f" WHERE c NOT IN {JSON_BAD})"
                  f", b AS (SELECT trade_dt AS ts_day FROM csv_lines WHERE c IN {CSV_BAD}"
                  f" UNION ALL SELECT trade_dt FROM json_lines WHERE c IN {JSON_BAD})")
    q["ingest_two_days"] = (two_days
        + " SELECT partition, trade_dt, count(*) AS n_rows, CAST(sum(event_seq_nb) AS BIGINT) AS sum_seq FROM s"
          f" WHERE ts_day IN ({day}, {day} - 1) GROUP BY ALL"
          " UNION ALL SELECT 'B', DATE '2000-01-01', count(*), CAST(-count(*) AS BIGINT) FROM b"
          f" WHERE ts_day IN ({day}, {day} - 1)")
    q["ingest_prior_session"] = q["ingest_two_days"].replace(f"{day} - 1", f"{day} - 3")
    q["prior_sessions"] = (_with(TICKS) + ", d AS (SELECT DISTINCT trade_dt AS day FROM trades)"
        " SELECT day, (SELECT max(e.day) FROM d e WHERE e.day < d.day AND isodow(e.day) < 6) AS prior_day FROM d")
    q["stage_paths"] = q["stage_roundtrip"]
    q["stream_both_formats"] = q["stage_roundtrip"]
    q["whole_files"] = q["text_line_count"]
    q["run_reports_day"] = (_with(TICKS, MEAN)
        + f" SELECT 'ingestion_2024-01-15' AS what, CAST(1 AS BIGINT) AS n_rows, 'success' AS note"
          " UNION ALL SELECT 'reports_2024-01-15', 1, 'success'"
          f" UNION ALL SELECT 'trades', count(*), '2024-01-15' FROM (SELECT 1 FROM trades WHERE trade_dt = {day} {latest})"
          f" UNION ALL SELECT 'quotes', count(*), '2024-01-15' FROM (SELECT 1 FROM quotes WHERE trade_dt = {day} {latest})"
          " UNION ALL SELECT 'analytics', count(*), '2024-01-15' FROM qa JOIN pclose pc ON qa.trade_dt = pc.trade_dt"
          f" AND qa.symbol = pc.symbol AND qa.exchange = pc.exchange WHERE qa.trade_dt = {day}")
    q["run_reports_shared"] = q["run_reports_day"]
    q["eod_quotes_clustered"] = q["eod_quotes"]
    q["quote_analytics_clustered"] = flagship
    q["lenient_timestamps"] = "SELECT event_id, date_trunc('minute', ts) AS event_tm FROM events"
    null_mean = _cents_mean("k", "ts", "px")
    q["null_keys"] = f"""WITH e AS (SELECT *, CASE WHEN user_id % 4 <> 0 THEN user_id % 4 END AS k,
        CAST(value AS DECIMAL(10,2)) AS px FROM events),
      p AS (SELECT *, {null_mean} AS mean FROM e WHERE event_type = 'purchase' AND event_id % 10 <> 0),
      l AS (SELECT coalesce(k, -1) AS k, ts, arg_max(px, (event_id, px)) AS px,
                   arg_max(mean, (event_id, px)) AS mean FROM p GROUP BY coalesce(k, -1), ts),
      v AS (SELECT *, coalesce(k, -1) AS kk FROM e WHERE event_type = 'view')
      SELECT v.event_id, v.k, v.ts, l.px AS last_px, l.mean AS last_mean
      FROM v ASOF LEFT JOIN l ON v.kk = l.k AND v.ts >= l.ts"""
    q["null_keys_bucketed"] = q["null_keys"]
    q["run_log_latest"] = """WITH rl AS (
        SELECT CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'ingestion'
                    ELSE 'reports' END || '_' || strftime(o_orderdate, '%Y-%m-%d') AS job_id,
               o_orderdate + to_seconds(o_orderkey) AS update_time,
               CASE WHEN o_orderstatus = 'F' THEN 'failed' ELSE 'success' END AS status
        FROM orders)
      SELECT job_id, max(update_time) AS update_time, arg_max(status, (update_time, status)) AS status
      FROM rl GROUP BY job_id"""
    return q
