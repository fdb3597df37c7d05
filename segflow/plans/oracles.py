"""The registered queries in plain SQL over the same tables.

None of this goes through XML or VARIANT: fields, positions and JSON texts are
computed from the table columns directly.
"""

from __future__ import annotations

# A claim for each line or order: s numbers the claims of a message, the rest is its fields.
ORDERS = """
parts AS (SELECT l_orderkey AS owner, CAST(ceil(count(*) / 8) AS BIGINT) AS messages FROM lineitem GROUP BY 1),
line AS (
  SELECT l_orderkey AS owner, l_orderkey + (l_partkey + l_suppkey + l_linenumber) % messages * 1000000000000 AS k,
         l_linenumber AS num, l_partkey AS p, CAST(l_quantity AS BIGINT) AS q, l_returnflag = 'R' AS r
  FROM lineitem JOIN parts ON l_orderkey = owner),
slot AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY num, p, q, r) - 1 AS s FROM line),
msg AS (
  SELECT coalesce(m.k, o_orderkey) AS k, o_custkey AS party, o_orderpriority AS label, o_orderstatus AS status,
         strftime(o_orderdate, '%Y-%m-%d') AS stamp, o_orderstatus AS grp
  FROM orders LEFT JOIN (SELECT DISTINCT owner, k FROM line) m ON m.owner = o_orderkey)"""

CUSTOMERS = """
parts AS (SELECT o_custkey AS owner, CAST(ceil(count(*) / 8) AS BIGINT) AS messages FROM orders GROUP BY 1),
line AS (
  SELECT o_custkey AS owner, o_custkey + o_orderkey % messages * 1000000000000 AS k, o_orderkey AS num, o_orderkey AS p,
         CAST(length(o_orderpriority) AS BIGINT) AS q, o_orderstatus = 'F' AS r
  FROM orders JOIN parts ON o_custkey = owner),
slot AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY num, p, q, r) - 1 AS s FROM line),
msg AS (
  SELECT coalesce(m.k, c_custkey) AS k, c_nationkey AS party, c_mktsegment AS label,
         CASE WHEN c_acctbal < 0 THEN 'P' WHEN c_acctbal < 5000 THEN 'F' ELSE 'O' END AS status,
         c_name AS stamp, c_mktsegment AS grp
  FROM customer LEFT JOIN (SELECT DISTINCT owner, k FROM line) m ON m.owner = c_custkey)"""

# From messages and claims to segment and field rows of both sections.
FLAT = """,
claim AS (SELECT m.k, m.status, slot.s, slot.num, slot.q, slot.p, slot.r FROM msg m JOIN slot USING (k)),
counted AS (
  SELECT m.*, coalesce(c.claims, 0) AS claims
  FROM msg m LEFT JOIN (SELECT k, count(*) AS claims FROM slot GROUP BY 1) c USING (k)),
field AS (
  SELECT k, 'req' AS sec, 'S_HD' AS seg, 0 AS occ, 'F_102_A2' AS key, '"D0"' AS val FROM counted
  UNION ALL SELECT k, 'req', 'S_HD', 0, 'F_103_A3', '"B1"' FROM counted
  UNION ALL SELECT k, 'req', 'S_HD', 0, 'F_109_A9', CAST(claims AS VARCHAR) FROM counted
  UNION ALL SELECT k, 'req', 'S_HD', 0, 'F_110_AK', 'null' FROM counted
  UNION ALL SELECT k, 'req', 'S_HD', 0, 'F_401_D1', '"' || stamp || '"' FROM counted
  UNION ALL SELECT k, 'req', 'S_01', 0, 'F_302_C2', CAST(party AS VARCHAR) FROM counted
  UNION ALL SELECT k, 'req', 'S_05', 0, NULL, NULL FROM counted WHERE status = 'P'
  UNION ALL SELECT k, 'req', 'S_07', s, 'F_402_D2', CAST(num AS VARCHAR) FROM claim
  UNION ALL SELECT k, 'req', 'S_07', s, 'F_407_D7', CAST(p AS VARCHAR) FROM claim
  UNION ALL SELECT k, 'req', 'S_07', s, 'F_442_E7', CAST(q AS VARCHAR) FROM claim
  UNION ALL SELECT k, 'req', 'S_11', s, 'F_409_D9', CAST(num AS VARCHAR) FROM claim WHERE r
  UNION ALL SELECT k, 'res', 'S_HD', 0, 'F_102_A2', '"D0"' FROM counted WHERE status <> 'P'
  UNION ALL SELECT k, 'res', 'S_HD', 0, 'F_501_F1', CASE WHEN status = 'F' THEN '"A"' ELSE '"R"' END
            FROM counted WHERE status <> 'P'
  UNION ALL SELECT k, 'res', 'S_25', 0, 'F_524_FO', '"' || label || '"' FROM counted WHERE status <> 'P'
  UNION ALL SELECT k, 'res', 'S_21', s, 'F_112_AN', CASE WHEN r THEN '"R"' ELSE '"P"' END
            FROM claim WHERE status <> 'P'
  UNION ALL SELECT k, 'res', 'S_21', s, 'F_526_FQ.1', '"QTY ' || q || ' & ITEM ' || p || '"'
            FROM claim WHERE status <> 'P'),
occurrence AS (
  SELECT k, sec, seg, occ, CASE WHEN count(key) = 0 THEN 'null'
         ELSE '{' || string_agg('"' || key || '":' || val, ',' ORDER BY key) || '}' END AS json
  FROM field GROUP BY 1, 2, 3, 4),
segment AS (
  SELECT k, sec, seg, count(*) AS n_occ, CASE WHEN count(*) = 1 THEN min(json)
         ELSE '[' || string_agg(json, ',' ORDER BY occ) || ']' END AS json
  FROM occurrence GROUP BY 1, 2, 3),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY k, sec ORDER BY seg) - 1 AS INTEGER) AS seg_pos FROM segment),
flat AS (
  SELECT f.k, f.sec, p.seg_pos, f.seg, CASE WHEN f.key IS NOT NULL THEN
         CAST(row_number() OVER (PARTITION BY f.k, f.sec, f.seg ORDER BY f.key) - 1 AS INTEGER) END AS pos,
         f.key, f.val
  FROM field f JOIN placed p USING (k, sec, seg) WHERE p.n_occ = 1
  UNION ALL
  SELECT o.k, o.sec, p.seg_pos, o.seg,
         CAST(row_number() OVER (PARTITION BY o.k, o.sec, o.seg ORDER BY o.occ) - 1 AS INTEGER), NULL, o.json
  FROM occurrence o JOIN placed p USING (k, sec, seg) WHERE p.n_occ > 1
  UNION ALL
  SELECT k, 'res', NULL, NULL, NULL, NULL, NULL FROM msg WHERE status = 'P'),
drug AS (
  SELECT k, CASE WHEN count(*) = 1 THEN '{"Units":' || min(q) || '}'
         ELSE '[' || string_agg('{"Units":' || q || '}', ',' ORDER BY s) || ']' END AS json
  FROM slot GROUP BY k),
extra AS (
  SELECT k, 'Drug' AS key, json AS val FROM drug WHERE k IN (SELECT k FROM msg)
  UNION ALL SELECT k, 'RecordType', '"Claim"' FROM msg
  UNION ALL SELECT k, 'Store', '{"State":"MN","StoreId":' || party || '}' FROM msg
  UNION ALL SELECT k, 'SwitchTransactionId', CAST(k AS VARCHAR) FROM msg
  UNION ALL SELECT k, 'Vendor', '"' || label || '"' FROM msg),
supplemental AS (
  SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY key) - 1 AS INTEGER) AS pos, key, val FROM extra),
section AS (
  SELECT k, max(json) FILTER (WHERE sec = 'req') AS req, max(json) FILTER (WHERE sec = 'res') AS res
  FROM (SELECT k, sec, '{' || string_agg('"' || seg || '":' || json, ',' ORDER BY seg) || '}' AS json
        FROM segment GROUP BY 1, 2) GROUP BY 1),
message AS (
  SELECT m.k, m.grp, m.status, m.label,
         '{"NcpdpRequest":' || s.req || coalesce(',"NcpdpResponse":' || s.res, '') || ',"Supplemental":{' ||
         (SELECT string_agg('"' || e.key || '":' || e.val, ',' ORDER BY e.key) FROM extra e WHERE e.k = m.k)
         || '}}' AS json
  FROM msg m JOIN section s USING (k))"""

# The XML text of each message.
XML = """,
xml AS (
  SELECT m.k, m.grp, m.status, m.label,
    '<?xml version="1.0" encoding="utf-8"?><ClaimBilling><Supplemental><Vendor>' || m.label
    || '</Vendor><RecordType>Claim</RecordType><SwitchTransactionId>' || m.k || '</SwitchTransactionId>'
    || '<Store><StoreId>' || m.party || '</StoreId><State>MN</State></Store>'
    || coalesce(c.drugs, '') || '</Supplemental><NcpdpRequest><S_HD><F_102_A2>D0</F_102_A2>'
    || '<F_103_A3>B1</F_103_A3><F_109_A9>' || coalesce(c.claims, 0) || '</F_109_A9><F_401_D1>' || m.stamp
    || '</F_401_D1><F_110_AK/></S_HD><S_01><F_302_C2>' || lpad(CAST(m.party AS VARCHAR), 12, '0')
    || '</F_302_C2></S_01>' || coalesce(c.asked, '')
    || CASE WHEN m.status = 'P' THEN '<S_05/></NcpdpRequest>' ELSE
       '</NcpdpRequest><NcpdpResponse><S_HD><F_102_A2>D0</F_102_A2><F_501_F1>'
       || CASE WHEN m.status = 'F' THEN 'A' ELSE 'R' END || '</F_501_F1></S_HD><S_25><F_524_FO>' || m.label
       || '</F_524_FO></S_25>' || coalesce(c.answered, '') || '</NcpdpResponse>' END
    || '</ClaimBilling>' AS value
  FROM msg m LEFT JOIN (
    SELECT k, count(*) AS claims,
      string_agg('<Drug><Units>' || q || '</Units></Drug>', '' ORDER BY s) AS drugs,
      string_agg('<S_07><F_402_D2>' || num || '</F_402_D2><F_407_D7>' || p || '</F_407_D7><F_442_E7>' || q
        || '</F_442_E7></S_07>' || CASE WHEN r THEN '<S_11><F_409_D9>' || num || '</F_409_D9></S_11>' ELSE '' END,
        '' ORDER BY s) AS asked,
      string_agg('<S_21><F_112_AN>' || CASE WHEN r THEN 'R' ELSE 'P' END || '</F_112_AN><F_526_FQ.1>QTY ' || q
        || ' &amp; ITEM ' || p || '</F_526_FQ.1></S_21>', '' ORDER BY s) AS answered
    FROM slot GROUP BY k) c USING (k))"""

FILES = """
file AS (
  SELECT doc_id, text, doc_id % 4 IN (0, 1) AS parsed, doc_id % 10 = 0 AS failed,
         'doc' || lpad(CAST(doc_id AS VARCHAR), 8, '0')
         || CASE doc_id % 4 WHEN 0 THEN '.PDF' WHEN 1 THEN '.docx' WHEN 2 THEN '.txt' ELSE '' END AS file_name,
         '/v/' || file_name AS path
  FROM documents)"""

ROW_ID = "sha256(CAST(k AS VARCHAR)) AS transaction_file_source_id"
JOINED = "replace(text, chr(10), chr(10) || chr(10))"
# The parse result of a document as JSON, NULL where it is not parsed.
RAW = """CASE WHEN NOT parsed THEN NULL
  WHEN failed THEN '{"document":null,"error_status":"unreadable","metadata":{"version":"'
       || CASE doc_id % 4 WHEN 0 THEN '1.0' ELSE '2.0' END || '"}}'
  ELSE '{"document":{' || CASE doc_id % 4 WHEN 0 THEN '"elements":null,"pages":' || lines
         ELSE '"elements":' || lines || ',"pages":null' END
       || '},"error_status":null,"metadata":{"version":"' || CASE doc_id % 4 WHEN 0 THEN '1.0' ELSE '2.0' END || '"}}' END"""
LINES = "CAST(to_json(list_transform(string_split(text, chr(10)), lambda line: {'content': line})) AS VARCHAR) AS lines"
FOLDER = "'/v/folder' || (doc_id % 7) || '.pdf'"

# The CRC-32 of a path of ASCII characters, bit by bit.
CRC = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(path, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(0 AS BIGINT)] || [0, 0, 0, 0, 0, 0, 0]),
      lambda bits, round: CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384) ELSE bits >> 1 END)))"""

# Contents of all documents of a folder by document and line; a chunk holds those that start in its 64 KiB.
CHUNKS = f"""{FILES},
line AS (
  SELECT doc_id, path, idx, parts[idx] AS part FROM (
    SELECT doc_id, {FOLDER} AS path, string_split(text, chr(10)) AS parts,
           unnest(generate_series(1, len(string_split(text, chr(10))))) AS idx
    FROM file WHERE parsed AND NOT failed)),
placed AS (
  SELECT *, coalesce(sum(strlen(part) + 2) OVER (
    PARTITION BY path ORDER BY doc_id, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 65536 AS chunk
  FROM line),
chunk AS (
  SELECT path, CAST(chunk AS BIGINT) AS chunk, string_agg(part, chr(10) || chr(10) ORDER BY doc_id, idx) AS text
  FROM placed GROUP BY 1, 2)"""


def _orders(select: str, *more: str) -> str:
    return f"WITH {ORDERS}{''.join(more)} {select}"


def _customers(select: str, *more: str) -> str:
    return f"WITH {CUSTOMERS}{''.join(more)} {select}"


def _files(select: str) -> str:
    return f"WITH {FILES} {select}"


def _texts(names: str, more: str = "") -> str:
    return _files(
        f"""SELECT {names}, CASE WHEN NOT parsed THEN text WHEN NOT failed THEN {JOINED} END AS text,
            CASE WHEN parsed AND failed THEN 'unreadable' END AS error_status, {RAW} AS raw_parsed
            FROM (SELECT *, {LINES} FROM file) {more}"""
    )


def _segment_rows(prefix: str, key: str, join: str = "") -> str:
    return (
        f"SELECT {key}, seg_pos AS {prefix}_pos, seg AS {prefix}_segment, pos, key, val AS value "
        f"FROM flat {join} WHERE sec = '{prefix[:3]}'"
    )


_RESPONSE_ROWS = _segment_rows("response", f"{ROW_ID}, k AS message_key")

ORACLES = {
    "request_segments": _orders(_segment_rows("request", ROW_ID), FLAT),
    "response_segments": _orders(_RESPONSE_ROWS, FLAT),
    "supplemental_fields": _orders(
        f"SELECT {ROW_ID}, k AS message_key, pos, key, val AS value FROM supplemental", FLAT
    ),
    "variant_batch": _orders(f"SELECT {ROW_ID}, json AS messages FROM message", FLAT),
    "variant_path": _orders(
        """SELECT k AS message_key, party, label, CASE status WHEN 'F' THEN 'A' WHEN 'O' THEN 'R' END AS answer,
               'null' AS empty_field, CAST(NULL AS VARCHAR) AS wrong_case
        FROM msg"""
    ),
    "variant_try_cast": _orders(
        """SELECT CASE n WHEN 0 THEN 'absent' WHEN 1 THEN 'object' ELSE 'array' END AS shape,
               CAST(CASE WHEN n > 1 THEN n END AS INTEGER) AS occurrences, count(*) AS n_messages
        FROM (SELECT msg.k, count(slot.s) AS n FROM msg LEFT JOIN slot USING (k) GROUP BY 1)
        GROUP BY 1, 2"""
    ),
    "variant_malformed": _orders(
        """,
        sent AS (
          SELECT k, status = 'F' OR (status = 'P' AND label LIKE '1%') AS broken,
                 status = 'P' AND label LIKE '2%' AS absent
          FROM msg),
        told AS (
          SELECT k, 'malformed' AS outcome FROM sent WHERE broken
          UNION ALL SELECT k, CASE WHEN broken OR absent THEN 'null' ELSE 'parsed' END FROM sent)
        SELECT outcome, count(*) AS n_messages, CAST(sum(k) AS BIGINT) AS key_sum FROM told GROUP BY 1"""
    ),
    "variant_long_exponents": """
        SELECT o_orderkey AS message_key,
               '{"a":"' || o_orderkey || 'E' || e || '","b":{"_c":"' || o_orderkey || 'e+' || (100000000 + e) || '"},"d":"'
               || '-0.5E' || e || '","t":"lot \\"7E' || e || '\\" held","u":"7E00' || e || '","z":1000000000000}' AS messages
        FROM (SELECT o_orderkey, 1000000 + o_orderkey % 9000000 AS e FROM orders)""",
    "typed_claims": _orders(
        """SELECT k AS message_key, lpad(CAST(party AS VARCHAR), 12, '0') AS member, CAST(s AS INTEGER) AS pos,
                  num AS number, p AS item, q AS quantity
           FROM msg JOIN slot USING (k)"""
    ),
    "typed_schema": _orders(
        """,
        claim AS (SELECT m.*, slot.* EXCLUDE (k, owner) FROM msg m JOIN slot USING (k)),
        header AS (
          SELECT *, coalesce((SELECT max(s) FROM slot WHERE slot.k = msg.k) + 1, 0) AS claims FROM msg),
        value AS (
          SELECT 'Supplemental' AS path, k, NULL AS text FROM msg
          UNION ALL SELECT 'Supplemental/Vendor', k, label FROM msg
          UNION ALL SELECT 'Supplemental/RecordType', k, 'Claim' FROM msg
          UNION ALL SELECT 'Supplemental/SwitchTransactionId', k, CAST(k AS VARCHAR) FROM msg
          UNION ALL SELECT 'Supplemental/Store', k, NULL FROM msg
          UNION ALL SELECT 'Supplemental/Store/StoreId', k, CAST(party AS VARCHAR) FROM msg
          UNION ALL SELECT 'Supplemental/Store/State', k, 'MN' FROM msg
          UNION ALL SELECT 'Supplemental/Drug', k, NULL FROM claim
          UNION ALL SELECT 'Supplemental/Drug/Units', k || ' ' || s, CAST(q AS VARCHAR) FROM claim
          UNION ALL SELECT 'NcpdpRequest', k, NULL FROM msg
          UNION ALL SELECT 'NcpdpRequest/S_HD', k, NULL FROM msg
          UNION ALL SELECT 'NcpdpRequest/S_HD/F_102_A2', k, 'D0' FROM msg
          UNION ALL SELECT 'NcpdpRequest/S_HD/F_103_A3', k, 'B1' FROM msg
          UNION ALL SELECT 'NcpdpRequest/S_HD/F_109_A9', k, CAST(claims AS VARCHAR) FROM header
          UNION ALL SELECT 'NcpdpRequest/S_HD/F_401_D1', k, stamp FROM msg
          UNION ALL SELECT 'NcpdpRequest/S_HD/F_110_AK', k, NULL FROM msg
          UNION ALL SELECT 'NcpdpRequest/S_01', k, NULL FROM msg
          UNION ALL SELECT 'NcpdpRequest/S_01/F_302_C2', k, lpad(CAST(party AS VARCHAR), 12, '0') FROM msg
          UNION ALL SELECT 'NcpdpRequest/S_05', k, NULL FROM msg WHERE status = 'P'
          UNION ALL SELECT 'NcpdpRequest/S_07', k, NULL FROM claim
          UNION ALL SELECT 'NcpdpRequest/S_07/F_402_D2', k || ' ' || s, CAST(num AS VARCHAR) FROM claim
          UNION ALL SELECT 'NcpdpRequest/S_07/F_407_D7', k || ' ' || s, CAST(p AS VARCHAR) FROM claim
          UNION ALL SELECT 'NcpdpRequest/S_07/F_442_E7', k || ' ' || s, CAST(q AS VARCHAR) FROM claim
          UNION ALL SELECT 'NcpdpRequest/S_11', k, NULL FROM claim WHERE r
          UNION ALL SELECT 'NcpdpRequest/S_11/F_409_D9', k || ' ' || s, CAST(num AS VARCHAR) FROM claim WHERE r
          UNION ALL SELECT 'NcpdpResponse', k, NULL FROM msg WHERE status <> 'P'
          UNION ALL SELECT 'NcpdpResponse/S_HD', k, NULL FROM msg WHERE status <> 'P'
          UNION ALL SELECT 'NcpdpResponse/S_HD/F_102_A2', k, 'D0' FROM msg WHERE status <> 'P'
          UNION ALL SELECT 'NcpdpResponse/S_HD/F_501_F1', k, 'A' FROM msg WHERE status <> 'P'
          UNION ALL SELECT 'NcpdpResponse/S_25', k, NULL FROM msg WHERE status <> 'P'
          UNION ALL SELECT 'NcpdpResponse/S_25/F_524_FO', k, label FROM msg WHERE status <> 'P'
          UNION ALL SELECT 'NcpdpResponse/S_21', k, NULL FROM claim WHERE status <> 'P'
          UNION ALL SELECT 'NcpdpResponse/S_21/F_112_AN', k || ' ' || s, 'R' FROM claim WHERE status <> 'P'
          UNION ALL SELECT 'NcpdpResponse/S_21/F_526_FQ.1', k || ' ' || s, 'QTY' FROM claim WHERE status <> 'P'),
        counted AS (
          SELECT path, k, count(*) AS n, count(*) FILTER (WHERE regexp_matches(text, '^0[0-9]')) AS codes,
                 bool_or(NOT regexp_matches(text, '^[0-9]+$')) AS is_text
          FROM value GROUP BY 1, 2)
        SELECT path, CAST(sum(n) AS BIGINT) AS occurrences, max(n) AS most, CAST(sum(codes) AS BIGINT) AS codes,
               coalesce(bool_or(is_text), FALSE) AS is_text
        FROM counted GROUP BY 1"""
    ),
    "claims_in_order": _orders(
        """,
        counted AS (SELECT m.*, (SELECT count(*) FROM slot WHERE slot.k = m.k) AS claims FROM msg m),
        claim AS (
          SELECT k, num, p, q, r, s, s + coalesce(sum(CAST(r AS INT)) OVER (
            PARTITION BY k ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 3 AS place FROM slot)
        SELECT k AS message_key, 0 AS claim, 'S_HD' AS segment, '2.1' AS label,
               '{"F_102_A2":"D0","F_103_A3":"B1","F_109_A9":' || claims || ',"F_110_AK":null,"F_401_D1":"' || stamp || '"}' AS value
        FROM counted
        UNION ALL SELECT k, 0, 'S_01', '2.2', '{"F_302_C2":' || party || '}' FROM counted
        UNION ALL SELECT k, CAST(s + 1 AS INTEGER), 'S_07', '2.' || place,
               '{"F_402_D2":' || num || ',"F_407_D7":' || p || ',"F_442_E7":' || q || '}' FROM claim WHERE k IN (SELECT k FROM msg)
        UNION ALL SELECT k, CAST(s + 1 AS INTEGER), 'S_11', '2.' || (place + 1), '{"F_409_D9":' || num || '}'
        FROM claim WHERE r AND k IN (SELECT k FROM msg)
        UNION ALL SELECT k, CAST(claims AS INTEGER), 'S_05', '2.' || (3 + claims + (SELECT count(*) FROM slot WHERE slot.k = c.k AND r)), 'null'
        FROM counted c WHERE status = 'P'"""
    ),
    "file_extension": _files(
        "SELECT path, CASE doc_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.docx' WHEN 2 THEN '.txt' ELSE '' END "
        "AS extension FROM file"
    ),
    "docs_route_parsed": _files("SELECT path, text FROM file WHERE parsed"),
    "docs_route_raw": _files("SELECT path, text FROM file WHERE NOT parsed"),
    "docs_route_sql": _files("SELECT path, parsed, CAST(strlen(text) AS INTEGER) AS n_bytes FROM file"),
    "docs_errors": _files(
        """SELECT path, '{"document":null,"error_status":"unreadable","metadata":{"version":"'
           || CASE doc_id % 4 WHEN 0 THEN '1.0' ELSE '2.0' END || '"}}' AS raw_parsed,
           'unreadable' AS error_status FROM file WHERE parsed AND failed"""
    ),
    "docs_elements": _files(
        """SELECT path, CAST(idx - 1 AS INTEGER) AS idx, parts[idx] AS content
           FROM (SELECT path, string_split(text, chr(10)) AS parts,
                        unnest(generate_series(1, len(string_split(text, chr(10))))) AS idx
                 FROM file WHERE parsed AND NOT failed)"""
    ),
    "docs_elements_agg": _files(f"SELECT doc_id, {FOLDER} AS path, {JOINED} AS text FROM file WHERE parsed AND NOT failed"),
    "docs_with_raw": _files(
        f"""SELECT doc_id, {FOLDER} AS path, {JOINED} AS text, {RAW} AS raw_parsed
            FROM (SELECT *, {LINES} FROM file) WHERE parsed AND NOT failed"""
    ),
    "docs_texts_by_path": _files(
        f"""SELECT path, {JOINED} AS text, {RAW} AS raw_parsed
            FROM (SELECT *, {LINES} FROM file) WHERE parsed AND NOT failed"""
    ),
    "docs_to_text": _texts("path"),
    "docs_to_text_table": _texts("path"),
    "specification_text": _texts("file_name"),
    "specification_text_top": _texts("file_name", "ORDER BY file_name LIMIT 50"),
    "docs_preview": "SELECT least(20, count(*)) AS n_rows, least(20, count(*)) AS n_found FROM documents",
    "docs_topn": _files("SELECT path, text FROM file ORDER BY path LIMIT 50"),
    "docs_topn_sql": _files("SELECT path, sha256(text) AS content_hash FROM file ORDER BY path LIMIT 50"),
    "docs_topn_repeated": _files(
        f"SELECT path, count(*) AS n_rows FROM (SELECT {FOLDER} AS path FROM file ORDER BY 1 LIMIT 50) GROUP BY 1"
    ),
    "docs_buckets": _files("SELECT path, sha256(text) AS content_hash, TRUE AS in_bucket FROM file"),
    "docs_by_path": _files(f"SELECT path, sha256(text) AS content_hash, {CRC} % 16 AS bucket FROM file"),
    "docs_by_bytes": """
        SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '/v/hot.pdf' ELSE '/v/folder' || (doc_id % 7) || '.pdf' END AS path,
               CAST(strlen(text) AS INTEGER) AS n_bytes, TRUE AS even
        FROM documents""",
    "docs_path_chunks": f"""WITH {CHUNKS} SELECT path, chunk, text FROM chunk""",
    "docs_by_reference": f"""WITH {CHUNKS}
        SELECT doc_id, {FOLDER} AS path, {RAW} AS raw_parsed, n_chunks FROM (SELECT *, {LINES} FROM file WHERE parsed)
        JOIN (SELECT path, count(*) AS n_chunks FROM chunk GROUP BY 1) c ON c.path = {FOLDER}""",
    "html_mixed_bytes": """
        SELECT page_id, page_id % 5 > 2 AS has_text, CASE page_id % 5
          WHEN 0 THEN 'ValueError: not HTML but PDF' WHEN 1 THEN 'ValueError: not HTML but ZIP or Office'
          WHEN 2 THEN 'ValueError: not HTML: NUL bytes' END AS error_status
        FROM pages""",
    "malformed_stream": _customers(
        "SELECT 'msg' || k || '.xml' AS file_name, left(value, length(value) - 3) AS value FROM xml WHERE status = 'F'", XML
    ),
    "constraint_violations": """
        SELECT count(*) FILTER (WHERE o_custkey IS NULL) AS id_nulls,
               count(*) FILTER (WHERE o_orderstatus = 'P' OR o_orderpriority IS NULL) AS label_nulls,
               (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)) AS repeated_ids,
               (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1))
               AS repeated_rows
        FROM orders""",
    "html_parse_text": r"""
        WITH blocks AS (
          SELECT page_id, list_filter(list_transform(string_split(
              regexp_replace(regexp_replace(regexp_replace(html,
                '<!--.*?-->|<(script|style)[^>]*>.*?</(script|style)>', '', 'gs'),
                '</?(html|head|body|nav|ul|li|div|article|h1|p|br|footer|title)(\s[^>]*)?>', chr(1), 'g'),
                '<[^>]*(>|$)', '', 'g'), chr(1)),
            lambda part: trim(regexp_replace(regexp_replace(replace(replace(replace(part,
              '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))),
            lambda part: part <> '') AS parts
          FROM pages)
        SELECT page_id, CAST(len(parts) AS INTEGER) AS n_parts, array_to_string(parts, chr(10) || chr(10)) AS text,
               CAST(NULL AS VARCHAR) AS error_status FROM blocks""",
    "ingest_text_stream": _customers(
        "SELECT grp AS file_type, 'msg' || k || '.xml' AS file_name, strlen(value) AS file_size, value FROM xml", XML
    ),
    "failed_stream": _customers(
        """SELECT 'msg' || k || '.xml' AS file_name, CASE WHEN last THEN 'failed' ELSE 'parsed' END AS outcome,
                  CASE WHEN last THEN value END AS value
           FROM (SELECT *, k = (SELECT max(k) FROM msg) AS last FROM xml)""",
        XML,
    ),
    "ledger_refresh": _customers(
        """, stages AS (
             SELECT which, count(*) FILTER (WHERE status <> 'P') AS n_first,
                    count(*) FILTER (WHERE status <> 'P' OR k % 5 >= 3) AS n_newest, count(*) AS n_all
             FROM (SELECT 'bronze' AS which, k, status FROM msg
                   UNION ALL SELECT 'requests', k, status FROM flat JOIN msg USING (k) WHERE sec = 'req') GROUP BY 1)
           SELECT step || ' ' || which AS step, n AS n_rows FROM stages,
           LATERAL (SELECT unnest(['first run', 'no new files', 'newest folders', 'all folders']) AS step,
                           unnest([n_first, n_first, n_newest, n_all]) AS n)""",
        FLAT,
    ),
    "ingest_file_metadata": _customers(
        """SELECT grp || '/msg' || k || '.xml' AS path_end, 'msg' || k || '.xml' AS file_name, strlen(value) AS file_size,
                  CAST(0 AS BIGINT) AS block_start, strlen(value) AS block_length, TRUE AS read_after_change FROM xml""",
        XML,
    ),
    "repeated_keys_stream": "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1",
    "docs_clustered": _files(
        """SELECT path, sha256(text) AS content_hash, TRUE AS few_files FROM file
           WHERE path BETWEEN '/v/doc00000100' AND '/v/doc00000120' AND strlen(text) <= 5000"""
    ),
    "file_source_id": _customers("SELECT count(*) AS n_files, count(*) AS n_ids, count(*) AS n_hex FROM msg"),
    "bronze_constraints": """
        SELECT unnest(['transaction_file_source_id_nulls', 'file_metadata_nulls', 'ingest_time_nulls', 'repeated_ids'])
               AS "check", CAST(0 AS BIGINT) AS violations""",
    "variant_stream": _customers("SELECT grp AS file_type, k AS message_key, json AS messages FROM message", FLAT),
    "requests_stream": _customers(
        _segment_rows("request", "grp AS file_type, k AS message_key", "JOIN msg USING (k)"), FLAT
    ),
    "responses_stream": _customers(
        _segment_rows("response", "grp AS file_type, k AS message_key", "JOIN msg USING (k)"), FLAT
    ),
    "supplemental_stream": _customers(
        "SELECT grp AS file_type, k AS message_key, pos, key, val AS value FROM supplemental JOIN msg USING (k)", FLAT
    ),
    "ingest_binary_stream": _files("SELECT file_name, strlen(text) AS length, text FROM file"),
    "parsed_view_stream": _files(
        f"""SELECT file_name, CASE WHEN NOT failed THEN {JOINED} END AS text,
            CASE WHEN failed THEN 'unreadable' END AS error_status FROM file WHERE parsed"""
    ),
    "refresh_incremental": _customers(
        """, stages AS (
             SELECT which, count(*) AS n_all, count(*) FILTER (WHERE status <> 'P') AS n_first FROM (
               SELECT 'bronze' AS which, status FROM msg UNION ALL SELECT 'variant', status FROM msg
               UNION ALL SELECT 'requests', status FROM flat JOIN msg USING (k) WHERE sec = 'req'
               UNION ALL SELECT 'responses', status FROM flat JOIN msg USING (k) WHERE sec = 'res'
               UNION ALL SELECT 'supplemental', status FROM supplemental JOIN msg USING (k))
             GROUP BY 1 UNION ALL SELECT 'malformed', 0, 0)
           SELECT step || ' ' || which AS step, n AS n_rows FROM stages,
           LATERAL (SELECT unnest(['first run', 'no new files', 'new files']) AS step,
                           unnest([n_first, n_first, n_all]) AS n)""",
        FLAT,
    ),
    "refresh_full": _customers(
        """SELECT 'full refresh bronze' AS step, count(*) AS n_rows FROM msg
           UNION ALL SELECT 'full refresh variant', count(*) FROM msg
           UNION ALL SELECT 'full refresh malformed', 0
           UNION ALL SELECT 'full refresh requests', count(*) FROM flat WHERE sec = 'req'
           UNION ALL SELECT 'full refresh responses', count(*) FROM flat WHERE sec = 'res'
           UNION ALL SELECT 'full refresh supplemental', count(*) FROM supplemental""",
        FLAT,
    ),
    "multi_type_counts": _customers(
        "SELECT grp AS file_type, count(*) AS n_files, CAST(sum(length(value)) AS BIGINT) AS n_chars FROM xml GROUP BY 1",
        XML,
    ),
}
