"""The queries of ``queries.py`` as SQL, by other means than the Spark jobs.

Where Spark uses carried chunk scans and sorted fills, the SQL uses inequality
joins with ``min``, as-of joins and whole-trace windows.
"""

from __future__ import annotations

from .queries import CUT_DAY, TABLE_FILES
from .tables import PART_DAYS

MESSAGES = """
m AS (
  SELECT CAST(user_id AS VARCHAR) AS trace_id,
         strftime(ts, '%Y-%m-%d') AS file_name,
         event_id AS msg_seq,
         CASE WHEN event_id % 97 = 0 THEN 'Custom_Packet' ELSE event_type END AS type_id,
         event_type, ts, props,
         CAST(floor(value) AS BIGINT) AS level
  FROM events)"""

NESTED = f"""{MESSAGES},
p AS (
  SELECT trace_id, msg_seq, level, CAST(unnest(range(0, msg_seq % 4)) AS INTEGER) AS subpacket_pos
  FROM m),
s AS (
  SELECT *, CAST(unnest(range(0, (msg_seq + subpacket_pos) % 4)) AS INTEGER) AS sample_pos
  FROM p)"""

SAMPLES = f"""{MESSAGES},
rec AS (
  SELECT file_name AS batch_id, trace_id, msg_seq, epoch_us(ts) / 1e6 AS ts, level,
         msg_seq % 6 AS size, unnest(range(0, msg_seq % 6)) AS i
  FROM m),
rec2 AS (
  SELECT *, CASE WHEN (msg_seq + i) % 5 <> 0 THEN CAST(level + i AS INTEGER) END AS num_rbs,
         (msg_seq * 7 + i + CASE WHEN (msg_seq + i) % 4 = 3 THEN 1 ELSE 0 END) % 10240 AS idx
  FROM rec),
rb AS (SELECT batch_id, trace_id, ts, num_rbs FROM rec2 WHERE num_rbs IS NOT NULL)"""

PART = f"((CAST(substr(file_name, 9, 2) AS INTEGER) - 1) // {PART_DAYS})"

SPAN = """CAST(floor(min(ts)) AS BIGINT) AS min_ts, CAST(floor(max(ts)) AS BIGINT) AS max_ts,
  round((floor(max(ts)) - floor(min(ts))) / 60, 3) AS minutes"""


def _histogram(by: str) -> str:
    b = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    same = f"AND v.{by} = l.{by}" if by else ""
    lead = f"l.{by}, " if by else ""
    return f"""WITH {SAMPLES},
v AS (SELECT {b}num_rbs AS x, count(*) AS c FROM rb GROUP BY {b}num_rbs),
st AS (
  SELECT {b}count(*) AS n, CAST(min(num_rbs) AS DOUBLE) AS mn, CAST(max(num_rbs) AS DOUBLE) AS mx,
         quantile_cont(num_rbs, 0.75) - quantile_cont(num_rbs, 0.25) AS iqr
  FROM rb {group}),
w AS (
  SELECT *, greatest(1.0, least(
      greatest(2.0 * iqr * pow(n, CAST(-1 AS DOUBLE) / 3), (mx - mn) / sqrt(n) / 2),
      (mx - mn) / (log2(n) + 1))) AS width
  FROM st WHERE n > 0),
lay AS (
  SELECT {b}n, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS f,
         CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS t,
         CASE WHEN mn = mx THEN 1 ELSE CAST(ceil((mx - mn) / width) AS INTEGER) END AS bins
  FROM w),
bin AS (SELECT *, unnest(range(bins)) AS bin FROM lay),
l AS (
  SELECT *, f + bin * ((t - f) / bins) AS lo,
         CASE WHEN bin + 1 = bins THEN t ELSE f + (bin + 1) * ((t - f) / bins) END AS hi
  FROM bin)
SELECT {lead}CAST(l.bin AS INTEGER) AS bin, l.lo, l.hi,
       CAST(coalesce(sum(v.c), 0) AS BIGINT) AS n,
       coalesce(sum(v.c), 0) / (l.hi - l.lo) / l.n AS density
FROM l LEFT JOIN v
  ON v.x >= l.lo AND (v.x < l.hi OR (l.bin + 1 = l.bins AND v.x <= l.hi)) {same}
GROUP BY {lead}l.bin, l.lo, l.hi, l.n"""


def _clock(name: str, source: str, keys: str) -> str:
    """Clock per row of ``source``: as-of join of each row to the last valid reading."""
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    return f"""
{name}_n AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY msg_seq, pos) AS seq,
         count(*) FILTER (WHERE NOT is_report)
           OVER (PARTITION BY {keys} ORDER BY msg_seq, pos) AS tick
  FROM {source}),
{name} AS (
  SELECT a.*, CAST(CASE WHEN b.tick IS NULL THEN -11
                   ELSE (b.sys * 10 + b.sub + a.tick - b.tick) % 10240 END AS INTEGER) AS t
  FROM {name}_n a ASOF LEFT JOIN
       (SELECT * FROM {name}_n WHERE NOT is_report AND sub < 10) b
    ON {on} AND a.seq >= b.seq)"""


def _uplink(keys: str = "trace_id", batch: str = "file_name") -> str:
    """CTEs from the events to ``out``, one per step; ``batch`` says which batch an event is in."""

    def on(left: str, right: str) -> str:
        return " AND ".join(f"{left}.{k} = {right}.{k}" for k in keys.split(", "))

    def of(alias: str) -> str:
        return ", ".join(f"{alias}.{k}" for k in keys.split(", "))

    gap = "CASE WHEN {0} > {1} THEN {1} + 10240 - {0} ELSE {1} - {0} + 1 END"
    return f"""{MESSAGES},
ev AS (
  SELECT *, {batch} AS batch_id, event_type IN ('click', 'error') AS is_report,
         ((day(ts) - 1) // 3 * 3 % 7) * 170 AS frame
  FROM m),
sp AS (SELECT *, unnest(range(0, msg_seq % 4)) AS i FROM ev WHERE NOT is_report),
sj AS (SELECT *, unnest(range(0, (msg_seq + i) % 4)) AS j FROM sp),
rj AS (SELECT *, unnest(range(0, msg_seq * 7 % 4)) AS j FROM ev WHERE is_report),
dec AS (
  SELECT trace_id, batch_id, msg_seq, i * 3 + j AS pos, false AS is_report,
         (msg_seq + i + j) % 16 AS sub, (frame + j) % 1024 AS sys,
         CASE WHEN (msg_seq + j) % 4 > 0 THEN level * ((msg_seq + j) % 4) + i END AS level,
         NULL::BOOLEAN AS first_tx, NULL::INTEGER AS raw_time
  FROM sj
  UNION ALL
  SELECT trace_id, batch_id, msg_seq, j, true, NULL, NULL, NULL, (msg_seq + j) % 2 = 0,
         CAST(frame * 10 + (msg_seq + j * 5) % 31 - CASE WHEN msg_seq % 5 = 0 THEN 20 ELSE 0 END AS INTEGER)
  FROM rj),
{_clock("st", "dec", keys)},
buf AS (
  SELECT *, level - lag(level, 1, 0) OVER (PARTITION BY {keys} ORDER BY seq) AS delta
  FROM st WHERE NOT is_report AND level IS NOT NULL),
rep AS (
  SELECT *, raw_time + CASE WHEN raw_time < 0 THEN 1024 ELSE 0 END AS report_time
  FROM st WHERE is_report),
cum AS (
  SELECT *,
    CAST(sum(greatest(delta, 0)) OVER (PARTITION BY {keys} ORDER BY seq) AS BIGINT) AS arrived,
    CAST(sum(greatest(-delta, 0)) OVER (PARTITION BY {keys} ORDER BY seq) AS BIGINT) AS drained
  FROM buf),
arr AS (
  SELECT {keys}, seq, t AS t_in, delta AS size, arrived - delta AS lo, arrived AS hi
  FROM cum WHERE delta > 0),
dep AS (SELECT {keys}, seq, t, -delta AS sent, drained FROM cum WHERE delta < 0),
done AS (
  SELECT {of('a')}, a.seq, a.size, a.t_in, min(d.seq) AS done_seq
  FROM arr a JOIN dep d ON {on('a', 'd')} AND d.drained >= a.hi
  GROUP BY ALL),
fst AS (
  SELECT {of('a')}, a.seq, min(d.seq) AS first_seq
  FROM arr a JOIN dep d ON {on('a', 'd')} AND d.seq > a.seq AND d.drained >= a.lo
  GROUP BY ALL),
first_byte AS (
  SELECT {of('f')}, f.seq, f.first_seq, d.t AS t_first
  FROM fst f JOIN dep d ON {on('f', 'd')} AND d.seq = f.first_seq),
pkt AS (
  SELECT {of('c')}, c.seq, c.size, c.done_seq, d.t AS t_done,
         {gap.format('c.t_in', 'f.t_first')} AS waiting, {gap.format('c.t_in', 'd.t')} AS tx
  FROM done c JOIN dep d ON {on('c', 'd')} AND d.seq = c.done_seq
  JOIN first_byte f ON {on('c', 'f')} AND f.seq = c.seq),
fl AS (
  SELECT {of('p')}, p.seq, p.done_seq, p.t_done AS slot, p.waiting, p.tx, min(r.seq) AS flush
  FROM pkt p JOIN rep r ON {on('p', 'r')} AND r.seq > p.done_seq
    AND (p.t_done < r.report_time OR (p.t_done > 1000 AND r.report_time < 20))
  GROUP BY ALL),
grp AS (
  SELECT {keys}, slot, flush, arg_max(waiting, seq) AS waiting, arg_max(tx, seq) AS tx
  FROM fl GROUP BY {keys}, slot, flush),
prev AS (
  SELECT *, lag(flush, 1, 0) OVER (PARTITION BY {keys}, slot ORDER BY flush) AS prev_flush
  FROM grp),
out AS (
  SELECT {of('g')}, g.slot, g.flush, g.waiting, g.tx,
         CASE WHEN count(r.seq) > 0 THEN 8 ELSE 0 END AS retx
  FROM prev g LEFT JOIN rep r ON {on('g', 'r')} AND r.report_time = g.slot
    AND NOT r.first_tx AND r.seq > g.prev_flush AND r.seq < g.flush
  GROUP BY ALL)"""


SUMS = """CAST(coalesce(sum(waiting), 0) AS BIGINT) AS waiting,
  CAST(coalesce(sum(tx), 0) AS BIGINT) AS tx, CAST(coalesce(sum(retx), 0) AS BIGINT) AS retx"""

BY_BATCH = f"""{_uplink('batch_id, trace_id')},
days AS (SELECT DISTINCT batch_id FROM ev),
bb AS (
  SELECT CAST(row_number() OVER (ORDER BY d.batch_id) AS INTEGER) AS batch_no, s.*
  FROM days d JOIN (
    SELECT d.batch_id, {SUMS} FROM days d LEFT JOIN out o ON o.batch_id = d.batch_id
    GROUP BY d.batch_id) s ON s.batch_id = d.batch_id)"""


def _select(ctes: str, rest: str) -> str:
    return f"WITH {ctes}\n{rest}"


def _running(part: str) -> str:
    return f"CAST(sum({part}) OVER (ORDER BY batch_no) AS BIGINT) AS {part}_total"


START = "strftime(make_timestamp(min_ts * 1000000), '%Y-%m-%d %H:%M:%S')"
END = "strftime(make_timestamp(max_ts * 1000000), '%Y-%m-%d %H:%M:%S')"

ORACLES: dict[str, str] = {
    "scan_messages": """SELECT CAST(user_id AS VARCHAR) AS trace_id, 'events.parquet' AS file_name,
        event_id AS msg_seq, event_type AS type_id, epoch_us(ts) / 1e6 AS ts FROM events""",
    "scan_file_set": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, count(*) AS n_messages, count(#1) AS n_keys FROM {t}"
        for t in TABLE_FILES
    ),
    "ordered_messages": _select(
        MESSAGES,
        "SELECT file_name, msg_seq, type_id, row_number() OVER (ORDER BY file_name, msg_seq) "
        "AS position FROM m ORDER BY file_name, msg_seq",
    ),
    "new_files": _select(
        MESSAGES, f"SELECT DISTINCT file_name FROM m WHERE NOT file_name < '{CUT_DAY}'"
    ),
    "visited_union": _select(MESSAGES, "SELECT DISTINCT file_name FROM m"),
    "message_count": _select(
        MESSAGES, "SELECT file_name, count(*) AS n_messages FROM m GROUP BY file_name"
    ),
    "batch_numbering": """SELECT batch_id, CAST(row_number() OVER (ORDER BY batch_id) AS INTEGER) AS batch_no
        FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d %H') AS batch_id
              FROM events WHERE event_type = 'error')""",
    "type_filter": _select(
        MESSAGES,
        "SELECT msg_seq, type_id FROM m WHERE type_id IN ('click', 'error', 'Custom_Packet')",
    ),
    "type_filter_all": _select(
        MESSAGES, "SELECT msg_seq, type_id FROM m WHERE type_id <> 'signup'"
    ),
    "unknown_types": _select(
        MESSAGES,
        "SELECT DISTINCT q.type_id FROM (VALUES ('click'), ('refund'), ('refund')) q(type_id) "
        "WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.type_id = q.type_id)",
    ),
    "malformed_split": """SELECT event_id AS msg_seq,
        CASE WHEN event_id % 7 <> 0 THEN CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) END AS k,
        event_id % 7 = 0 AS rejected FROM events""",
    "parse_props": _select(
        MESSAGES,
        "SELECT msg_seq AS seq, type_id, 'None or True' AS note, true AS ok, false AS bad, "
        "CAST(NULL AS INTEGER) AS n, CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k FROM m",
    ),
    "epoch_seconds": "SELECT event_id AS msg_seq, epoch_us(ts) / 1e6 AS epoch_ts FROM events",
    "rb_explode": _select(SAMPLES, "SELECT * FROM rb"),
    "rb_sequential": _select(
        SAMPLES,
        "SELECT a.batch_id, a.trace_id, a.ts, a.num_rbs FROM rec2 a JOIN rec2 b "
        "ON a.msg_seq = b.msg_seq AND b.i = a.i + 1 "
        "WHERE b.idx - a.idx = 1 AND a.i <= a.size - 3",
    ),
    "explode_samples": _select(
        NESTED,
        "SELECT trace_id, msg_seq, subpacket_pos, sample_pos, "
        "CAST((msg_seq + subpacket_pos + sample_pos) % 16 AS INTEGER) AS sub_fn, "
        "CAST((msg_seq // 3 + sample_pos) % 1024 AS INTEGER) AS sys_fn FROM s",
    ),
    "last_lcid": _select(
        NESTED,
        "SELECT msg_seq, subpacket_pos, sample_pos, "
        "CASE WHEN (msg_seq + sample_pos) % 4 > 0 "
        "THEN level * ((msg_seq + sample_pos) % 4) + subpacket_pos END AS total_bytes FROM s",
    ),
    "retx_time_fix": _select(
        MESSAGES,
        "SELECT msg_seq, CAST(level - msg_seq % 60 AS INTEGER) AS raw_time, "
        "CAST(level - msg_seq % 60 + CASE WHEN level < msg_seq % 60 THEN 1024 ELSE 0 END "
        "AS INTEGER) AS report_time FROM m",
    ),
    "frame_index": _select(
        MESSAGES,
        "SELECT msg_seq, CAST(((msg_seq // 3) % 1024) * 10 + msg_seq % 10 AS INTEGER) AS frame_index FROM m",
    ),
    "circular_diff": _select(
        f"{MESSAGES}, d AS (SELECT msg_seq, level * 37 % 10240 "
        "- (((msg_seq // 3) % 1024) * 10 + msg_seq % 10) AS ahead FROM m)",
        "SELECT msg_seq, CAST(CASE WHEN ahead < 0 THEN ahead + 10240 ELSE ahead + 1 END "
        "AS INTEGER) AS diff FROM d",
    ),
    "line_split": "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents",
    "rb_total_by_batch": _select(
        SAMPLES,
        f"SELECT batch_id, CAST(sum(num_rbs) AS BIGINT) AS total_rbs, {SPAN} FROM rb GROUP BY batch_id",
    ),
    "rb_total": _select(SAMPLES, "SELECT CAST(sum(num_rbs) AS BIGINT) AS total_rbs FROM rb"),
    "span_by_batch": _select(SAMPLES, f"SELECT batch_id, {SPAN} FROM rb GROUP BY batch_id"),
    "span_total": _select(SAMPLES, f"SELECT {SPAN} FROM rb"),
    "batch_label": _select(
        f"{SAMPLES}, s AS (SELECT batch_id, sum(num_rbs) AS total_rbs, {SPAN} FROM rb GROUP BY batch_id)",
        f"""SELECT batch_id,
        'Channel Utilization starting ' || {START} || ' (Duration: ' || minutes || ' min)' AS utilization_label,
        'Channel Utilization from ' || {START} || ' to ' || {END} || ' (Duration: ' || minutes || ' min)' AS total_label,
        'Number of Resource Blocks (' || total_rbs || ' Total Resource Blocks in Time Window)' AS rb_label,
        'Latency Breakdown from ' || {START} || ' to ' || {END} || ' (Duration: ' || minutes || ' min)' AS latency_label
        FROM s""",
    ),
    "rb_histogram": _histogram(""),
    "rb_histogram_by_batch": _histogram("batch_id"),
    "rb_append": _select(SAMPLES, "SELECT * FROM rb"),
    "last_value": _select(
        MESSAGES,
        "SELECT trace_id, level AS last_value FROM m "
        "QUALIFY row_number() OVER (PARTITION BY trace_id ORDER BY msg_seq DESC) = 1",
    ),
    "topk_with_other": """WITH s AS (
          SELECT l_suppkey AS key, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS size
          FROM lineitem WHERE l_suppkey NOT IN (1, 2) GROUP BY l_suppkey),
        r AS (SELECT *, row_number() OVER (ORDER BY size DESC, key) AS rank FROM s)
        SELECT 'top' AS kind, CAST(rank AS INTEGER) AS rank, CAST(key AS VARCHAR) AS label,
               CAST(1 AS BIGINT) AS n_keys, size FROM r WHERE rank <= 3
        UNION ALL SELECT 'other', NULL, NULL, count(*), CAST(sum(size) AS BIGINT) FROM r
          WHERE rank > 3 HAVING count(*) > 0
        UNION ALL SELECT 'total', NULL, NULL, count(*), CAST(coalesce(sum(size), 0) AS BIGINT) FROM r""",
    "clock_fill": _select(_uplink(), "SELECT trace_id, seq, t FROM st WHERE NOT is_report"),
    "buffer_delta": _select(_uplink(), "SELECT trace_id, seq, delta FROM buf"),
    "packet_arrivals": _select(_uplink(), "SELECT trace_id, seq, t_in, size, lo, hi FROM arr"),
    "packet_departures": _select(_uplink(), "SELECT trace_id, seq, t, sent, drained FROM dep"),
    "fifo_completion": _select(_uplink(), "SELECT trace_id, seq, size, done_seq, t_done FROM pkt"),
    "fifo_first_byte": _select(
        _uplink(), "SELECT trace_id, seq, first_seq, t_first FROM first_byte"
    ),
    "fifo_latency": _select(_uplink(), "SELECT trace_id, seq, waiting, tx FROM pkt"),
    "latency_flush": _select(
        _uplink(), "SELECT DISTINCT trace_id, slot, done_seq AS seq, flush FROM fl"
    ),
    "slot_last_wins": _select(_uplink(), "SELECT trace_id, slot, flush, waiting, tx FROM grp"),
    "retx_tag": _select(_uplink(), "SELECT trace_id, slot, flush, retx FROM out"),
    "uplink_latency": _select(_uplink(), "SELECT trace_id, slot, waiting, tx, retx FROM out"),
    "latency_sums": _select(_uplink(), f"SELECT {SUMS} FROM out"),
    "tx_block_counts": _select(
        _uplink(),
        "SELECT count(*) FILTER (WHERE first_tx) AS cum_block, "
        "count(*) FILTER (WHERE NOT first_tx) AS cum_err_block FROM rep",
    ),
    "latency_by_batch": _select(BY_BATCH, "SELECT batch_no, waiting, tx, retx FROM bb"),
    "latency_running": _select(
        BY_BATCH,
        f"SELECT batch_no, {_running('waiting')}, {_running('tx')}, {_running('retx')} FROM bb",
    ),
    "latency_total": _select(BY_BATCH, f"SELECT {SUMS} FROM bb"),
    "latency_stack": _select(
        BY_BATCH,
        "SELECT batch_no, 'waiting' AS part, waiting AS height, CAST(0 AS BIGINT) AS bottom FROM bb "
        "UNION ALL SELECT batch_no, 'tx', tx, waiting FROM bb "
        "UNION ALL SELECT batch_no, 'retx', retx, waiting + tx FROM bb",
    ),
    "stream_totals": _select(
        _uplink().replace(MESSAGES, SAMPLES),
        f"""SELECT * FROM
        (SELECT CAST(sum(num_rbs) AS BIGINT) AS total_rbs, {SPAN} FROM rb),
        (SELECT {SUMS} FROM out)""",
    ),
    "stream_by_batch": _select(
        f"""{_uplink('batch_id, trace_id', PART).replace(MESSAGES, SAMPLES)},
parts AS (SELECT batch_id, count(*) AS n_messages FROM ev GROUP BY batch_id),
dl AS (
  SELECT {PART.replace('file_name', 'batch_id')} AS batch_id, count(*) AS n_samples,
         CAST(sum(num_rbs) AS BIGINT) AS total_rbs, {SPAN}
  FROM rb GROUP BY 1),
ul AS (SELECT batch_id, {SUMS} FROM out GROUP BY batch_id)""",
        "SELECT CAST(batch_id AS BIGINT) AS batch_id, n_messages, "
        "CAST(coalesce(n_samples, 0) AS BIGINT) AS n_samples, total_rbs, min_ts, max_ts, "
        "coalesce(waiting, 0) AS waiting, coalesce(tx, 0) AS tx, coalesce(retx, 0) AS retx "
        "FROM parts LEFT JOIN dl USING (batch_id) LEFT JOIN ul USING (batch_id)",
    ),
    "stream_trace_scope": _select(_uplink(), "SELECT trace_id, slot, waiting, tx, retx FROM out"),
    "dict_text_messages": _select(
        SAMPLES,
        """SELECT 'LTE_PHY_PDSCH_Stat_Indication' AS type_id, epoch_us(m.ts) / 1e6 AS ts,
        lag(epoch_us(m.ts) / 1e6) OVER (PARTITION BY m.file_name ORDER BY m.msg_seq) AS ts_before,
        CAST(m.msg_seq % 6 AS BIGINT) AS n_records, CAST(coalesce(total_rbs, 0) AS BIGINT) AS total_rbs
        FROM m LEFT JOIN (SELECT msg_seq, sum(num_rbs) AS total_rbs FROM rec2 GROUP BY msg_seq) USING (msg_seq)""",
    ),
    "line_round_trip": _select(
        _uplink(),
        """SELECT trace_id, count(*) FILTER (WHERE is_report) AS n_reports,
        count(*) FILTER (WHERE NOT is_report) AS n_samples,
        count(*) FILTER (WHERE first_tx) AS n_first,
        CAST(sum(raw_time + CASE WHEN raw_time < 0 THEN 1024 ELSE 0 END) AS BIGINT) AS report_times,
        CAST(sum(level) AS BIGINT) AS levels, CAST(sum(sub + 16 * sys) AS BIGINT) AS frames
        FROM dec GROUP BY trace_id""",
    ),
    "queue_match_unmatched": _select(
        f"""{MESSAGES},
e AS (
  SELECT trace_id, msg_seq AS seq, CASE event_type WHEN 'click' THEN 1 ELSE 2 END AS side,
         row_number() OVER (PARTITION BY trace_id, event_type ORDER BY msg_seq) AS rank
  FROM m WHERE event_type IN ('click', 'view'))""",
        "SELECT coalesce(a.trace_id, b.trace_id) AS trace_id, coalesce(a.seq, b.seq) AS seq, "
        "coalesce(a.side, b.side) AS side, coalesce(a.rank, b.rank) AS rank "
        "FROM (SELECT * FROM e WHERE side = 1) a FULL JOIN (SELECT * FROM e WHERE side = 2) b "
        "ON a.trace_id = b.trace_id AND a.rank = b.rank WHERE a.seq IS NULL OR b.seq IS NULL",
    ),
}
