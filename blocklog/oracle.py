"""DuckDB SQL for the registered queries, over the same input tables."""

from __future__ import annotations

BLOCK_LOG = """
WITH b AS (
  SELECT user_id AS stream_id, event_id, ts,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS n
  FROM events),
x AS (
  SELECT stream_id, event_id, ts, 0 AS sub, n AS height,
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n AS VARCHAR(20)))) AS hash,
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n - 1 AS VARCHAR(20)))) AS prev_hash, 'base' AS fault
  FROM b WHERE event_id % 997 <> 31
  UNION ALL
  SELECT stream_id, event_id, ts, 1, n,
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n AS VARCHAR(20)))),
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n - 1 AS VARCHAR(20)))), 'dup'
  FROM b WHERE event_id % 11 = 5
  UNION ALL
  SELECT stream_id, event_id, ts, 2, n - 3,
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n - 3 AS VARCHAR(20)))),
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n - 4 AS VARCHAR(20)))), 'replay'
  FROM b WHERE event_id % 13 = 7 AND n > 4
  UNION ALL
  SELECT stream_id, event_id, ts, 3, n + 1,
         md5(concat('fork', CAST(event_id AS VARCHAR(20)))),
         md5(concat('x', CAST(event_id AS VARCHAR(20)))), 'fork'
  FROM b WHERE event_id % 17 = 3
  UNION ALL
  SELECT stream_id, event_id, ts, 4, n + 1,
         md5(concat('fork', CAST(event_id AS VARCHAR(20)))),
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n AS VARCHAR(20)))), 'linked_fork'
  FROM b WHERE event_id % 401 = 9
  UNION ALL
  SELECT stream_id, event_id, ts, 5, n,
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n AS VARCHAR(20)))),
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n - 1 AS VARCHAR(20)))), 'unequal_dup'
  FROM b WHERE event_id % 19 = 2
  UNION ALL
  SELECT stream_id, event_id, ts, 6, n + 1,
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n + 1 AS VARCHAR(20)))),
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n AS VARCHAR(20)))), 'corrupt'
  FROM b WHERE event_id % 23 = 4)
SELECT stream_id, event_id * 8 + sub + 1 AS seq, ts, height, hash, prev_hash, fault,
       CAST(CASE WHEN event_id % 37 = 1 THEN height + 1 ELSE height END AS VARCHAR(20)) AS msg_id,
       CASE WHEN fault = 'corrupt' THEN concat('{"block":{"header":{"hash":"', hash)
            ELSE concat('{"block":{"header":{"hash":"', hash, '","prev_hash":"', prev_hash,
                        '","height":', CAST(height AS VARCHAR(20)), '}},"v":"',
                        CASE WHEN fault IN ('dup', 'replay') THEN 'base' ELSE fault END, '"}') END AS payload
FROM x
"""

COMPARE_LOG = """
WITH b AS (
  SELECT user_id AS stream_id, event_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS n
  FROM events),
x AS (
  SELECT stream_id, event_id, n,
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n AS VARCHAR(20)))) AS hash,
         md5(concat(CAST(stream_id AS VARCHAR(20)), ':', CAST(n - 1 AS VARCHAR(20)))) AS prev_hash,
         CASE WHEN event_id % 29 = 6 THEN 'changed' ELSE 'base' END AS v
  FROM b WHERE event_id % 31 <> 8)
SELECT stream_id, event_id * 8 + 1 AS seq, n AS height, hash, prev_hash,
       concat('{"block":{"header":{"hash":"', hash, '","prev_hash":"', prev_hash,
              '","height":', CAST(n AS VARCHAR(20)), '}},"v":"', v, '"}') AS payload
FROM x
"""

FULL_LOG = """
SELECT CAST(0 AS BIGINT) AS stream_id, event_id + 1 AS seq, ts,
       CAST(floor(event_id / 1000.0) AS BIGINT) AS chunk_id, event_id + 1 AS height,
       md5(concat('b', CAST(event_id AS VARCHAR(20)))) AS hash,
       md5(concat('b', CAST(event_id - 1 AS VARCHAR(20)))) AS prev_hash,
       CAST(event_id + 1 AS VARCHAR(20)) AS msg_id, props AS payload
FROM events
"""

BACKUP_LOG = FULL_LOG.rstrip() + " WHERE event_id % 97 >= 3"

# Rows that decode, the path of accepted rows, and the tip before each row.
_OK = "ok AS MATERIALIZED (SELECT * FROM block_log WHERE json_valid(payload))"
_NEXT = """nxt AS MATERIALIZED (
  SELECT a.stream_id, a.seq, min(b.seq) AS next_seq FROM ok a JOIN ok b
    ON b.stream_id = a.stream_id AND b.prev_hash = a.hash AND b.seq > a.seq AND b.height > a.height
  GROUP BY 1, 2)"""
_GATE = f"""{_OK}, {_NEXT},
path AS (
  SELECT stream_id, min(seq) AS seq FROM ok GROUP BY 1
  UNION ALL
  SELECT p.stream_id, n.next_seq FROM path p JOIN nxt n ON n.stream_id = p.stream_id AND n.seq = p.seq),
flagged AS MATERIALIZED (
  SELECT b.stream_id, b.seq, b.height, b.hash, b.prev_hash, json_valid(b.payload) AS good,
         p.seq IS NOT NULL AS taken
  FROM block_log b LEFT JOIN path p ON p.stream_id = b.stream_id AND p.seq = b.seq),
judged AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY seq) AS pos,
         last_value(CASE WHEN taken THEN height END IGNORE NULLS) OVER w AS tip_height,
         last_value(CASE WHEN taken THEN hash END IGNORE NULLS) OVER w AS tip_hash,
         CAST(sum(CASE WHEN taken THEN 1 ELSE 0 END) OVER (PARTITION BY stream_id ORDER BY seq) AS BIGINT) AS written
  FROM flagged
  WINDOW w AS (PARTITION BY stream_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
gate AS MATERIALIZED (
  SELECT stream_id, seq, CASE WHEN good THEN height END AS height, CASE WHEN good THEN hash END AS hash, pos,
         CASE WHEN NOT good THEN 'CORRUPT' WHEN taken THEN 'ACCEPTED' WHEN height <= tip_height THEN 'LOW_HEIGHT'
              ELSE 'HASH_MISMATCH' END AS label,
         CASE WHEN taken THEN written END AS out_seq,
         CASE WHEN tip_height IS NOT NULL THEN written - CASE WHEN taken THEN 1 ELSE 0 END END AS tip_out_seq,
         tip_height, tip_hash
  FROM judged)"""
_RUNS = """wrongs AS (
  SELECT *, label IN ('CORRUPT', 'HASH_MISMATCH') AS wrong FROM gate),
runs AS MATERIALIZED (
  SELECT *, CASE WHEN wrong THEN pos - coalesce(last_value(CASE WHEN NOT wrong THEN pos END IGNORE NULLS)
      OVER (PARTITION BY stream_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
    ELSE 0 END AS run FROM wrongs)"""
_PREV = """prev AS (
  SELECT *, lag(seq) OVER w AS prev_seq, lag(height) OVER w AS prev_height, lag(hash) OVER w AS last_hash,
         lag(payload) OVER w AS last_payload
  FROM ok WINDOW w AS (PARTITION BY stream_id ORDER BY seq))"""


def _on(tables: str, body: str, *more: str) -> str:
    """A statement over the named logs; ``more`` are further common table expressions."""
    logs = {
        "block": f"block_log AS MATERIALIZED ({BLOCK_LOG})",
        "compare": f"compare_log AS MATERIALIZED ({COMPARE_LOG})",
        "backup": f"backup_log AS MATERIALIZED ({BACKUP_LOG})",
        "full": f"full_log AS MATERIALIZED ({FULL_LOG})",
        "valid": f"block_log AS MATERIALIZED (SELECT * FROM ({BLOCK_LOG}) WHERE json_valid(payload))",
    }
    parts = [logs[t] for t in tables.split()] + list(more)
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body


def _block(body: str, *more: str) -> str:
    return _on("block", body, *more)


def _gate(body: str, *more: str) -> str:
    return _on("block", body, _GATE, *more)


def _finding(kind: str, condition: str) -> str:
    return _block(
        f"SELECT stream_id, '{kind}' AS kind, prev_seq, prev_height, seq, height FROM prev WHERE {condition}",
        _OK,
        _PREV,
    )


_SIDE = """{n} AS MATERIALIZED (
  SELECT *, lag(seq) OVER w AS prev_seq, lag(height) OVER w AS prev_height, lag(hash) OVER w AS last_hash,
         lag(payload) OVER w AS last_payload,
         max(height) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top,
         row_number() OVER w AS nth
  FROM {source} WINDOW w AS (PARTITION BY stream_id ORDER BY seq)),
{n}_rec AS MATERIALIZED (SELECT stream_id, height, nth FROM {n} WHERE top IS NULL OR height > top)"""
_STEPS = """a_step AS MATERIALIZED (
  SELECT a.*, CASE WHEN nth = 1 THEN 1 ELSE nth + (SELECT min(r.nth) FROM b_rec r
    WHERE r.stream_id = a.stream_id AND r.height >= a.top) END AS step FROM a),
b_step AS MATERIALIZED (
  SELECT b.*, CASE WHEN nth = 1 THEN 2 ELSE nth + (SELECT min(r.nth) FROM a_rec r
    WHERE r.stream_id = b.stream_id AND r.height > b.top) END AS step FROM b),
bad AS (
  SELECT stream_id, seq, 1 + (SELECT count(*) FROM a WHERE a.stream_id = c.stream_id AND a.seq < c.seq) AS nth,
         (SELECT max(height) FROM a WHERE a.stream_id = c.stream_id AND a.seq < c.seq) AS top,
         (SELECT max(seq) FROM a WHERE a.stream_id = c.stream_id AND a.seq < c.seq) AS prev_seq
  FROM block_log c WHERE NOT json_valid(payload)),
bad_step AS (
  SELECT d.*, (SELECT height FROM a WHERE a.stream_id = d.stream_id AND a.seq = d.prev_seq) AS prev_height,
         CASE WHEN nth = 1 THEN 1 ELSE nth + (SELECT min(r.nth) FROM b_rec r
           WHERE r.stream_id = d.stream_id AND r.height >= d.top) END AS step FROM bad d),
kinds AS (
  SELECT stream_id, side, prev_seq, prev_height, seq, height, step,
         CASE WHEN height < prev_height THEN 'DOWNJUMP'
              WHEN height = prev_height AND payload = last_payload THEN 'DUPLICATE'
              WHEN height = prev_height THEN 'UNEQUAL_DUPLICATE'
              WHEN height > prev_height + 1 AND prev_hash <> last_hash THEN 'GAP' END AS kind
  FROM (SELECT 'A' AS side, stream_id, prev_seq, prev_height, seq, height, step, payload, last_payload, prev_hash, last_hash FROM a_step
        UNION ALL
        SELECT 'B', stream_id, prev_seq, prev_height, seq, height, step, payload, last_payload, prev_hash, last_hash FROM b_step)),
findings AS MATERIALIZED (
  SELECT stream_id, side, kind, prev_seq, prev_height, seq, height, step, 1 AS phase FROM kinds
    WHERE kind IS NOT NULL AND step IS NOT NULL
  UNION ALL
  SELECT stream_id, 'A', 'CORRUPTED', prev_seq, prev_height, seq, NULL, step, 0 FROM bad_step WHERE step IS NOT NULL
  UNION ALL
  SELECT a.stream_id, 'AB', 'DISCREPANCY', a.seq, a.height, b.seq, a.height, greatest(a.step, b.step), 2
    FROM a_step a JOIN b_step b ON b.stream_id = a.stream_id AND b.height = a.height
    WHERE (a.top IS NULL OR a.height >= a.top) AND (b.top IS NULL OR b.height > b.top) AND a.payload <> b.payload
      AND a.step IS NOT NULL AND b.step IS NOT NULL)"""


def _compare(body: str, *more: str) -> str:
    return _on(
        "block compare", body, _OK,
        _SIDE.format(n="a", source="ok"), _SIDE.format(n="b", source="compare_log"), *more,
    )


_VALIDATION = """marked AS (
  SELECT stream_id, seq, height, hash, prev_hash, msg_id, json_valid(payload) AS good,
         lag(seq) OVER (PARTITION BY stream_id ORDER BY seq) AS before FROM block_log),
linked AS (
  SELECT *, last_value(CASE WHEN good THEN height END IGNORE NULLS) OVER w AS prev_height,
         last_value(CASE WHEN good THEN hash END IGNORE NULLS) OVER w AS last_hash
  FROM marked WINDOW w AS (PARTITION BY stream_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
found AS MATERIALIZED (
  SELECT stream_id, seq, 1 AS rank, 'SEQ_GAP' AS kind, 'seq_gap' AS reason FROM linked WHERE seq <> before + 1
  UNION ALL SELECT stream_id, seq, 2, 'CORRUPT', 'bad_json' FROM linked WHERE NOT good
  UNION ALL SELECT stream_id, seq, 3, 'MSG_ID', 'msg_id_mismatch' FROM linked WHERE good AND CAST(msg_id AS BIGINT) <> height
  UNION ALL SELECT stream_id, seq, 4, 'HASH', 'hash_mismatch' FROM linked WHERE good AND prev_hash <> last_hash
  UNION ALL SELECT stream_id, seq, 5, 'HEIGHT', 'height_not_above' FROM linked WHERE good AND height <= prev_height)"""


def _flat(column: str) -> str:
    return f"""CASE WHEN json_valid({column}) THEN concat('{{"hash":"', hash, '","parent_hash":"', prev_hash, '","height":', CAST(height AS VARCHAR), '}}')
      ELSE concat('{{"hash":"', hash) END"""


def _sizes(packed: str, unpacked: str, table: str, kb: int) -> str:
    def bucket(c: str) -> str:
        return f"CAST(ceil(strlen({c}) / {kb * 1024}.0) * {kb} AS BIGINT)"

    return f"""SELECT measure, bucket, count(*) AS n FROM (
      SELECT 'packed' AS measure, {bucket(packed)} AS bucket FROM {table}
      UNION ALL SELECT 'unpacked', {bucket(unpacked)} FROM {table}) GROUP BY 1, 2"""


def _histogram(bounds: list[float]) -> str:
    parts = [
        f"SELECT CAST({i} AS BIGINT) AS bound_no, count(*) AS n FROM documents WHERE n_chars <= {b!r}"
        for i, b in enumerate(bounds)
    ]
    parts.append(f"SELECT CAST({len(bounds)} AS BIGINT), count(n_chars) FROM documents")
    return " UNION ALL ".join(parts)


_TIPS = "tips AS (SELECT stream_id, max(height) // 2 AS height FROM compare_log GROUP BY 1)"
_HALF = "(SELECT max(height) // 2 + 7 FROM backup_log)"
_ABSENT = """bounds AS (SELECT CAST(max(event_id) + 2 AS BIGINT) AS end_seq FROM events),
steps AS (
  SELECT seq, lead(seq, 1, (SELECT end_seq FROM bounds)) OVER (ORDER BY seq) AS following
  FROM (SELECT seq FROM backup_log UNION ALL SELECT CAST(0 AS BIGINT))),
ranges AS MATERIALIZED (
  SELECT CAST(0 AS BIGINT) AS stream_id, seq + 1 AS l, following - 1 AS r FROM steps WHERE following > seq + 1)"""

_CELLS = """cells AS (
  SELECT seq, strlen(payload) AS size, seq - row_number() OVER (ORDER BY seq) AS run,
         (row_number() OVER (ORDER BY seq) - 1) // 700 AS entries,
         (coalesce(CAST(sum(strlen(payload)) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0)) // 5000 AS cut
  FROM {log})"""

_GAUGES = """gauges AS (
  SELECT stream_id, max(seq) AS reader_seq,
    arg_max(height, seq) FILTER (WHERE label <> 'CORRUPT') AS reader_height,
    max(CASE WHEN label = 'ACCEPTED' THEN height ELSE tip_height END) AS writer_tip_height,
    max(height) FILTER (WHERE label = 'ACCEPTED') AS last_written_height,
    max(seq) FILTER (WHERE label = 'ACCEPTED') AS last_written_input_seq,
    max(out_seq) AS last_written_output_seq,
    min(seq) AS input_first_seq, max(seq) AS input_last_seq,
    min(out_seq) AS output_first_seq, max(out_seq) AS output_last_seq,
    arg_max(run, seq) AS consecutive_wrong,
    CAST(0 AS BIGINT) AS input_start_seq, CAST(0 AS BIGINT) AS input_end_seq, CAST(3 AS BIGINT) AS tolerance_window
  FROM runs GROUP BY 1)"""

_BRIDGED = """cuts AS (SELECT stream_id, min(seq) AS cut FROM runs WHERE run >= 2 GROUP BY 1),
bridged AS MATERIALIZED (
  SELECT r.* FROM runs r LEFT JOIN cuts c ON c.stream_id = r.stream_id WHERE c.cut IS NULL OR r.seq < c.cut)"""

_RESTORED = """rwrong AS MATERIALIZED (SELECT *, label = 'HASH_MISMATCH' AS bad FROM gate),
rruns AS MATERIALIZED (
  SELECT *, CASE WHEN bad THEN pos - coalesce(last_value(CASE WHEN NOT bad THEN pos END IGNORE NULLS)
      OVER (PARTITION BY stream_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
    ELSE 0 END AS run FROM rwrong),
rcuts AS MATERIALIZED (SELECT stream_id, min(seq) AS cut FROM rruns WHERE run > 1 GROUP BY 1)"""

_STORED = "SELECT stream_id, seq, payload, epoch_us(ts) * 1000 AS unix_nano, msg_id FROM full_log"

ORACLES: dict[str, str] = {
    # sources
    "read_log_range": _on(
        "backup", "SELECT stream_id, seq, height, hash, msg_id FROM backup_log WHERE seq >= 101"
    ),
    "ordered_scan": _block("SELECT stream_id, seq FROM block_log"),
    "get_at": _on("backup", "SELECT stream_id, seq, height, hash FROM backup_log WHERE seq = 504"),
    "log_bounds": _block(
        "SELECT stream_id, min(seq) AS first_seq, max(seq) AS last_seq, count(*) AS n FROM block_log GROUP BY 1"
    ),
    "chunk_ranges": _on(
        "backup",
        "SELECT stream_id, chunk_id, min(seq) AS l, max(seq) AS r, count(*) AS n FROM backup_log GROUP BY 1, 2",
    ),
    "first_at_or_after": _block(
        """SELECT stream_id, min(seq) AS seq, arg_min(height, seq) AS height, arg_min(hash, seq) AS hash
           FROM block_log WHERE seq >= 4000 GROUP BY 1"""
    ),
    # decoding
    "decode_unverified": _block(
        """SELECT stream_id, seq, CASE WHEN regexp_full_match(msg_id, '[0-9]+') THEN TRY_CAST(msg_id AS BIGINT) END AS height,
           CASE WHEN NOT regexp_full_match(msg_id, '[0-9]+') THEN 'bad_msg_id' END AS error FROM block_log"""
    ),
    "decode_nested": _block(
        """SELECT stream_id, seq, CASE WHEN json_valid(payload) THEN CAST(json_extract(payload, '$.block.header.height') AS BIGINT) END AS height,
           CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.block.header.hash') END AS hash,
           CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.block.header.prev_hash') END AS prev_hash,
           CASE WHEN NOT json_valid(payload) THEN 'bad_json' END AS error FROM block_log"""
    ),
    "decode_flat": _block(
        f"""SELECT stream_id, seq, CASE WHEN json_valid(f) THEN CAST(json_extract(f, '$.height') AS BIGINT) END AS height,
           CASE WHEN json_valid(f) THEN json_extract_string(f, '$.hash') END AS hash,
           CASE WHEN json_valid(f) THEN json_extract_string(f, '$.parent_hash') END AS prev_hash,
           CASE WHEN NOT json_valid(f) THEN 'bad_json' END AS error
           FROM (SELECT stream_id, seq, {_flat('payload')} AS f FROM block_log)"""
    ),
    "decode_simple": _block(
        """SELECT stream_id, seq, CAST(0 AS BIGINT) AS height, '' AS hash, '' AS prev_hash, CAST(NULL AS VARCHAR) AS error FROM block_log"""
    ),
    "quarantine": _block(
        "SELECT stream_id, seq, 'bad_json' AS error FROM block_log WHERE NOT json_valid(payload)"
    ),
    "message_id_check": _block(
        "SELECT stream_id, seq, 'msg_id_mismatch' AS error FROM ok WHERE CAST(msg_id AS BIGINT) <> height", _OK
    ),
    "envelope_check": _block(
        """SELECT stream_id, seq, CASE WHEN strlen(d) = 0 THEN 'empty_payload' WHEN ascii(d) <> 1 THEN 'unknown_envelope_version' END AS error
           FROM (SELECT stream_id, seq, CASE WHEN seq % 5 = 0 THEN payload WHEN seq % 7 = 0 THEN '' ELSE concat(chr(1), payload) END AS d FROM block_log)"""
    ),
    "envelope_fields": _block(
        """SELECT stream_id, seq, CAST(seq % 24 AS INTEGER) AS type, seq AS sequential_id,
           CAST(floor(epoch(ts)) AS BIGINT) AS ts_s, CAST(seq % 1000 AS INTEGER) AS ts_ms, md5(payload) AS unique_id,
           payload AS body, CAST(NULL AS VARCHAR) AS envelope_error FROM block_log"""
    ),
    "headers_roundtrip": _block("SELECT stream_id, seq, msg_id AS first_value, CAST(1 AS INTEGER) AS n FROM block_log"),
    "relative_seq": _on("backup", "SELECT stream_id, seq, seq - 98 AS relative_seq FROM backup_log"),
    "payload_sizes": """SELECT page_id, CAST(strlen(url) AS INTEGER) AS packed, CAST(strlen(html) AS INTEGER) AS unpacked FROM pages""",
    # audits
    "seq_gaps": _on(
        "backup",
        """SELECT stream_id, prev_seq, seq FROM (SELECT stream_id, seq, lag(seq) OVER (ORDER BY seq) AS prev_seq FROM backup_log)
           WHERE seq <> prev_seq + 1""",
    ),
    "absent_ranges": _on("backup", "SELECT stream_id, l, r FROM ranges", _ABSENT),
    "leftmost_absent": _on("backup", "SELECT stream_id, l, r FROM ranges ORDER BY l LIMIT 1", _ABSENT),
    "segments": _on(
        "backup",
        """SELECT stream_id, min(seq) AS l, max(seq) AS r, count(*) AS n FROM
           (SELECT stream_id, seq, seq - row_number() OVER (ORDER BY seq) AS run FROM backup_log) GROUP BY stream_id, run""",
    ),
    "link_check": _finding("HASH", "prev_hash <> last_hash"),
    "height_check": _finding("HEIGHT", "height <= prev_height"),
    "audit_downjump": _finding("DOWNJUMP", "height < prev_height"),
    "audit_duplicate": _block(
        """SELECT stream_id, CASE WHEN payload = last_payload THEN 'DUPLICATE' ELSE 'UNEQUAL_DUPLICATE' END AS kind,
           prev_seq, prev_height, seq, height FROM prev WHERE height = prev_height""",
        _OK,
        _PREV,
    ),
    "audit_height_gap": _finding("GAP", "height > prev_height + 1 AND prev_hash <> last_hash"),
    "audit_height_gap_flat": _finding("GAP", "height > prev_height + 1"),
    "validation_report": _block(
        "SELECT stream_id, kind, count(*) AS n, min(seq) AS first_seq FROM found GROUP BY 1, 2", _VALIDATION
    ),
    "first_failure": _block(
        """SELECT stream_id, seq, kind, reason FROM found QUALIFY row_number() OVER (PARTITION BY stream_id ORDER BY seq, rank) = 1""",
        _VALIDATION,
    ),
    # gate
    "write_gate": _gate("SELECT stream_id, seq, height, label, out_seq FROM gate"),
    "gate_with_tip": _on(
        "block",
        """SELECT b.stream_id, b.seq, p.out_seq FROM ok b JOIN path p ON p.stream_id = b.stream_id AND p.seq = b.seq""",
        _OK,
        _NEXT,
        """tips AS (SELECT stream_id, CAST(10 AS BIGINT) AS height, md5(concat(CAST(stream_id AS VARCHAR), ':10')) AS hash
          FROM ok GROUP BY 1),
path AS (
  SELECT t.stream_id, min(b.seq) AS seq, CAST(101 AS BIGINT) AS out_seq FROM tips t JOIN ok b
    ON b.stream_id = t.stream_id AND b.prev_hash = t.hash AND b.height > t.height GROUP BY 1
  UNION ALL
  SELECT p.stream_id, n.next_seq, p.out_seq + 1 FROM path p JOIN nxt n ON n.stream_id = p.stream_id AND n.seq = p.seq)""",
    ),
    "record_gate": _block(
        """SELECT stream_id, seq, height FROM (SELECT stream_id, seq, CAST(msg_id AS BIGINT) AS height,
             max(CAST(msg_id AS BIGINT)) OVER (PARTITION BY stream_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
           FROM block_log) WHERE top IS NULL OR height > top"""
    ),
    "strict_sequence": _block(
        """SELECT stream_id, seq AS arrival, height AS seq FROM block_log JOIN path USING (stream_id, seq)""",
        """nxt AS MATERIALIZED (
  SELECT a.stream_id, a.seq, min(b.seq) AS next_seq FROM block_log a JOIN block_log b
    ON b.stream_id = a.stream_id AND b.height = a.height + 1 AND b.seq > a.seq GROUP BY 1, 2),
path AS (
  SELECT stream_id, min(seq) AS seq FROM block_log WHERE height = 1 GROUP BY 1
  UNION ALL
  SELECT p.stream_id, n.next_seq FROM path p JOIN nxt n ON n.stream_id = p.stream_id AND n.seq = p.seq)""",
    ),
    "successor": _block("SELECT ok.stream_id, ok.seq, next_seq FROM ok LEFT JOIN nxt USING (stream_id, seq)", _OK, _NEXT),
    "wrong_runs": _gate("SELECT stream_id, seq, run FROM runs WHERE run > 0", _RUNS),
    "tolerance_reach": _gate("SELECT stream_id, min(seq) AS cut FROM runs WHERE run >= 3 GROUP BY 1", _RUNS),
    "tolerance_exceed": _gate("SELECT stream_id, cut FROM rcuts", _RESTORED),
    "tip_asof_row": _gate("SELECT stream_id, seq, tip_out_seq, tip_height, tip_hash FROM gate"),
    "assign_output_seq": _gate("SELECT stream_id, seq, out_seq FROM gate WHERE out_seq IS NOT NULL"),
    "output_headers": _gate(
        """SELECT stream_id, seq, CAST(height AS VARCHAR) AS msg_id, CAST(tip_height AS VARCHAR) AS last_msg_id,
           CAST(tip_out_seq AS VARCHAR) AS last_seq, concat('chain-', CAST(stream_id AS VARCHAR)) AS stream_name
           FROM gate WHERE label = 'ACCEPTED'"""
    ),
    # comparison
    "compare_by_height": _compare(
        """SELECT a.stream_id, a.height, a.seq AS seq_a, b.seq AS seq_b FROM a JOIN b ON b.stream_id = a.stream_id AND b.height = a.height
           WHERE (a.top IS NULL OR a.height >= a.top) AND (b.top IS NULL OR b.height > b.top) AND a.payload <> b.payload"""
    ),
    "compare_findings": _compare(
        "SELECT stream_id, side, kind, prev_seq, prev_height, seq, height, step FROM findings", _STEPS
    ),
    "compare_until_fatal": _compare(
        """SELECT f.stream_id, f.side, f.kind, f.seq FROM findings f LEFT JOIN halts h USING (stream_id)
           WHERE h.at IS NULL OR (f.step, f.phase, f.seq) <= h.at""",
        _STEPS,
        "halts AS (SELECT stream_id, min((step, phase, seq)) AS at FROM findings WHERE kind IN ('DOWNJUMP', 'UNEQUAL_DUPLICATE', 'DISCREPANCY') GROUP BY 1)",
    ),
    "compare_by_relative_seq": _on(
        "backup",
        """SELECT a.stream_id, a.seq - 1 AS relative_seq, a.seq AS seq_a, b.seq AS seq_b FROM backup_log a
           JOIN backup_log b ON b.seq - 98 = a.seq - 1 WHERE b.seq >= 98 AND a.payload <> b.payload""",
    ),
    # transfer
    "resume_seq": _on(
        "block compare",
        """SELECT b.stream_id, coalesce(min(CASE WHEN json_valid(payload) AND b.height > t.height AND seq >= 500 THEN seq END),
             max(CASE WHEN t.height IS NOT NULL AND seq >= 500 THEN seq END),
             least(greatest(500, min(seq)), max(seq))) AS resume_seq
           FROM block_log b LEFT JOIN tips t ON t.stream_id = b.stream_id GROUP BY 1""",
        _TIPS,
    ),
    "resume_chunk": _on(
        "backup",
        f"""SELECT CAST(0 AS BIGINT) AS stream_id, coalesce(min(CASE WHEN top > {_HALF} THEN l END), max(l)) AS chunk_start
           FROM (SELECT chunk_id, min(seq) AS l, max(seq) AS r, max(height) AS top FROM backup_log GROUP BY 1)
           WHERE r >= 150 AND l < (SELECT max(seq) FROM backup_log)""",
    ),
    "backfill": _on(
        "full backup",
        "SELECT f.stream_id, f.seq, f.hash FROM full_log f WHERE f.seq NOT IN (SELECT seq FROM backup_log)",
    ),
    "seam_check": _on(
        "full backup",
        """SELECT r.stream_id, r.l AS seq, 'HASH' AS kind FROM ranges r JOIN backup_log s ON s.seq = r.l - 1
           JOIN full_log f ON f.seq = r.l WHERE r.l > 1 AND f.seq % 4 = 1""",
        _ABSENT,
    ),
    "write_backup_chunks": _on(
        "backup",
        """SELECT CAST(0 AS BIGINT) AS stream_id, min(seq) AS chunk_id, count(*) AS n, CAST(sum(size) AS BIGINT) AS bytes, min(seq) AS l, max(seq) AS r
           FROM cells GROUP BY run, entries, cut""",
        _CELLS.format(log="backup_log"),
    ),
    "bridge_batch": _gate(
        "SELECT stream_id, out_seq, height, hash, CAST(height AS VARCHAR) AS msg_id FROM bridged WHERE label = 'ACCEPTED'",
        _RUNS,
        _BRIDGED,
    ),
    "backup_batch": _on("full", _STORED),
    "backup_stream": _on("full", _STORED),
    "bridge_unsigned": _gate(
        """SELECT stream_id, out_seq, CAST(CAST(height AS HUGEINT) + 9223372036854775798 AS VARCHAR) AS height_text, hash
           FROM gate WHERE label = 'ACCEPTED'"""
    ),
    "bridge_restart": _gate("SELECT stream_id, out_seq, height, hash FROM gate WHERE label = 'ACCEPTED'"),
    "restore_restart": _on("valid", "SELECT stream_id, out_seq, height, hash FROM gate WHERE label = 'ACCEPTED'", _GATE),
    "restore_batch": _on(
        "valid",
        """SELECT g.stream_id, g.out_seq, g.height, g.hash FROM gate g LEFT JOIN rcuts c ON c.stream_id = g.stream_id
           WHERE g.label = 'ACCEPTED' AND (c.cut IS NULL OR g.seq < c.cut)""",
        _GATE,
        _RESTORED,
    ),
    # statistics
    "sync_counters": _gate(
        """SELECT stream_id, count(*) AS reads, count(*) FILTER (WHERE label = 'ACCEPTED') AS writes, CAST(0 AS BIGINT) AS low_seq_skips,
           count(*) FILTER (WHERE label = 'CORRUPT') AS corrupted_skips, count(*) FILTER (WHERE label = 'LOW_HEIGHT') AS low_height_skips,
           count(*) FILTER (WHERE label = 'HASH_MISMATCH') AS hash_mismatch_skips FROM gate GROUP BY 1"""
    ),
    "sync_metrics_stream": _gate(
        """SELECT count(*) AS reads, count(*) FILTER (WHERE label = 'ACCEPTED') AS writes, CAST(0 AS BIGINT) AS low_seq_skips,
           count(*) FILTER (WHERE label = 'CORRUPT') AS corrupted_skips, count(*) FILTER (WHERE label = 'LOW_HEIGHT') AS low_height_skips,
           count(*) FILTER (WHERE label = 'HASH_MISMATCH') AS hash_mismatch_skips FROM gate"""
    ),
    "sync_gauges": _gate("SELECT * FROM gauges", _RUNS, _GAUGES),
    "sync_status": _gate(
        """SELECT stream_id, 'LAST' AS line, input_last_seq AS input_seq, coalesce(output_last_seq, 0) AS output_seq,
             CAST(NULL AS BIGINT) AS input_height, coalesce(writer_tip_height, 0) AS output_height FROM gauges
           UNION ALL SELECT stream_id, 'READER', reader_seq, NULL, coalesce(reader_height, 0), NULL FROM gauges
           UNION ALL SELECT stream_id, 'WRITER', coalesce(last_written_input_seq, 0), coalesce(last_written_output_seq, 0),
             coalesce(last_written_height, 0), coalesce(last_written_height, 0) FROM gauges
           UNION ALL SELECT stream_id, 'FIRST', input_first_seq, coalesce(output_first_seq, 0), NULL, NULL FROM gauges""",
        _RUNS,
        _GAUGES,
    ),
    "progress": _block("SELECT stream_id, max(seq) AS seq, arg_max(height, seq) AS height FROM ok GROUP BY 1", _OK),
    "size_distribution": _sizes("source", "text", "documents", 64),
    "size_distribution_1kb": _sizes("source", "text", "documents", 1),
    "merge_distribution": f"""SELECT measure, bucket, CAST(sum(n) AS BIGINT) AS n FROM (
        {_sizes("source", "text", "documents", 1)} UNION ALL {_sizes("url", "html", "pages", 1)}) GROUP BY 1, 2""",
    "oversize": "SELECT doc_id, CAST(strlen(text) AS INTEGER) AS size FROM documents WHERE strlen(text) > 10485",
    "hist_linear": _histogram([i * 2000.0 for i in range(10)]),
    "hist_exponential": _histogram([4.0**i for i in range(9)]),
    "throughput": _on(
        "backup",
        "SELECT stream_id, CAST(floor(epoch(ts) / 3) * 3 AS BIGINT) AS window_start, count(*) AS n FROM backup_log GROUP BY 1, 2",
    ),
}

# The streaming forms give what the batch forms give.
ORACLES["bridge_stream"] = ORACLES["bridge_batch"]
ORACLES["compare_enveloped"] = ORACLES["compare_by_height"]
ORACLES["restore_indexed"] = ORACLES["restore_restart"]
ORACLES["restore_stream"] = ORACLES["restore_batch"]
ORACLES["stats_stream"] = ORACLES["size_distribution_1kb"]
ORACLES["size_state"] = ORACLES["size_distribution_1kb"]
ORACLES["throughput_stream"] = ORACLES["throughput"]
ORACLES["dedup_window"] = _block("SELECT DISTINCT stream_id, msg_id FROM block_log")
ORACLES["compare_incremental"] = _compare(
    """SELECT stream_id, side, kind, prev_seq, prev_height, seq, height FROM (
         SELECT stream_id, side, kind, prev_seq, prev_height, seq, height FROM kinds WHERE kind IS NOT NULL
         UNION ALL
         SELECT stream_id, 'A', 'CORRUPTED', prev_seq, prev_height, seq, NULL FROM bad_step
         UNION ALL
         SELECT a.stream_id, 'AB', 'DISCREPANCY', a.seq, a.height, b.seq, a.height
         FROM a JOIN b ON b.stream_id = a.stream_id AND b.height = a.height
         WHERE (a.top IS NULL OR a.height >= a.top) AND (b.top IS NULL OR b.height > b.top) AND a.payload <> b.payload)""",
    _STEPS,
)
