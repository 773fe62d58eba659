"""The same results in ANSI SQL, for an engine that reads the tables as views."""

from __future__ import annotations

_BIRTH = "CASE WHEN c_mktsegment <> 'MACHINERY' THEN DATE '1950-01-01' + c_nationkey * 400 END"

_CUSTOMERS = f"""customers AS (
  SELECT c_custkey, c_acctbal, c_name AS FirstName, n_name AS LastName,
         CAST({_BIRTH} AS DATE) AS BirthDate, c_mktsegment AS Gender
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_SUPPLIERS = """suppliers AS (
  SELECT s_suppkey, s_acctbal, s_name AS Name, n_name AS Region, r_name AS Specialty
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_CLAIMS = f"""{_CUSTOMERS}, {_SUPPLIERS}, lines AS (
  SELECT l.*, o.*, CAST(l_extendedprice AS DECIMAL(18,2)) - 2000 AS billed,
         NOT (l_returnflag = 'N' AND l_linestatus = 'O') AS settled
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey),
stg AS (
  SELECT c.FirstName AS PatientFirstName, c.LastName AS PatientLastName,
         c.BirthDate AS PatientBirthDate, s.Name AS ProviderName, s.Region AS ProviderRegion,
         CAST(billed AS DECIMAL(18,2)) AS AmountBilled,
         CAST(CASE WHEN settled THEN billed * (1 - CAST(l_discount AS DECIMAL(5,2)))
                   * (1 + CAST(l_tax AS DECIMAL(5,2))) END AS DECIMAL(18,2)) AS AmountPaid,
         CASE WHEN o_orderstatus = 'O' THEN 'Submitted' WHEN o_orderstatus = 'F' THEN 'paid'
              WHEN o_orderpriority = '5-LOW' THEN 'Complete' ELSE 'REJECTED' END AS Status,
         CAST(o_orderdate AS DATE) AS DateSubmitted,
         CASE WHEN settled THEN CAST(l_shipdate AS DATE) END AS DatePaid
  FROM lines JOIN customers c ON o_custkey = c.c_custkey JOIN suppliers s ON l_suppkey = s.s_suppkey),
patients AS (
  SELECT c_custkey AS PatientID, FirstName, LastName, BirthDate, Gender
  FROM customers WHERE c_acctbal >= 0),
providers AS (
  SELECT s_suppkey AS ProviderID, Name, Region, Specialty FROM suppliers WHERE s_acctbal >= 0)"""


def _resolved(how: str) -> str:
    return f"""resolved AS (
  SELECT stg.*, PatientID, ProviderID FROM stg
  {how} JOIN patients p ON FirstName = PatientFirstName AND LastName = PatientLastName
    AND COALESCE(BirthDate, DATE '1900-01-01') = COALESCE(PatientBirthDate, DATE '1900-01-01')
  {how} JOIN providers r ON Name = ProviderName AND Region = ProviderRegion)"""


_RULES = {
    "NEGATIVE_AMOUNT": (
        "AmountBilled < 0 OR AmountPaid < 0",
        "'AmountBilled and/or AmountPaid is negative.'",
    ),
    "OVERPAID": ("AmountPaid > AmountBilled", "'AmountPaid exceeds AmountBilled.'"),
    "DATE_ORDER": ("DatePaid < DateSubmitted", "'DatePaid is earlier than DateSubmitted.'"),
    "BAD_STATUS": (
        "UPPER(Status) NOT IN ('SUBMITTED', 'REJECTED', 'PAID')",
        "'Status not in (Submitted, Rejected, Paid).'",
    ),
}
_HAS_IDS = "PatientID IS NOT NULL AND ProviderID IS NOT NULL"

_CLAIM_OUT = """PatientFirstName, PatientLastName, CAST(PatientBirthDate AS VARCHAR) AS PatientBirthDate,
  ProviderName, ProviderRegion, CAST(AmountBilled AS DOUBLE) AS AmountBilled,
  CAST(AmountPaid AS DOUBLE) AS AmountPaid, Status,
  CAST(DateSubmitted AS VARCHAR) AS DateSubmitted, CAST(DatePaid AS VARCHAR) AS DatePaid"""

_VALID_OUT = """PatientID, ProviderID, CAST(AmountBilled AS DOUBLE) AS AmountBilled,
  CAST(AmountPaid AS DOUBLE) AS AmountPaid, Status,
  CAST(DateSubmitted AS VARCHAR) AS DateSubmitted, CAST(DatePaid AS VARCHAR) AS DatePaid"""


def _rule(code: str) -> str:
    if code == "FK_NOT_FOUND":
        condition = "PatientID IS NULL OR ProviderID IS NULL"
        reason = (
            "'Could not resolve ' || CASE WHEN PatientID IS NULL THEN 'Patient ' ELSE '' END"
            " || CASE WHEN ProviderID IS NULL THEN 'Provider ' ELSE '' END || 'from natural keys.'"
        )
    else:
        condition, reason = _RULES[code]
        condition = f"{_HAS_IDS} AND ({condition})"
    return f"""SELECT '{code}' AS RuleCode, {reason} AS Reason, {_CLAIM_OUT},
  PatientID AS ResolvedPatientID, ProviderID AS ResolvedProviderID
FROM resolved WHERE {condition}"""


_CODES = ["FK_NOT_FOUND", *_RULES]
_REJECTS = "\nUNION ALL\n".join(_rule(code) for code in _CODES)
_VALID = (
    "SELECT DISTINCT PatientID, ProviderID, AmountBilled, AmountPaid, Status, DateSubmitted, DatePaid\n"
    f"FROM resolved WHERE {_HAS_IDS} AND "
    + " AND ".join(f"({condition}) IS NOT TRUE" for condition, _ in _RULES.values())
)


def _with_left(body: str) -> str:
    return f"WITH {_CLAIMS}, {_resolved('LEFT')}\n{body}"


def _upsert(key: list[str], values: list[str], id_col: str, unknown_date: str | None = None) -> str:
    """Merge of CTE ``src`` into the rows of ``first``, both distinct by key."""

    def same(column: str, side: str) -> str:
        c = f"{side}.{column}"
        return f"COALESCE({c}, DATE '1900-01-01')" if column == unknown_date else c

    on = " AND ".join(f"{same(k, 't')} = {same(k, 's')}" for k in key)
    order = ", ".join(same(k, "{0}") for k in key)
    values_out = ", ".join(f"CASE WHEN s.present THEN s.{v} ELSE t.{v} END AS {v}" for v in values)
    return f"""numbered AS (
  SELECT row_number() OVER (ORDER BY {order.format('f')}) AS {id_col}, f.* FROM first f),
src AS (SELECT DISTINCT *, TRUE AS present FROM batch),
fresh AS (
  SELECT (SELECT MAX({id_col}) FROM numbered)
         + row_number() OVER (ORDER BY {order.format('s')}) AS {id_col},
         {', '.join('s.' + c for c in key + values)}, '2024-02-01 00:00:00' AS CreatedAt
  FROM src s WHERE NOT EXISTS (SELECT 1 FROM numbered t WHERE {on})),
merged AS (
  SELECT t.{id_col}, {', '.join('t.' + k for k in key)}, {values_out},
         '2024-01-01 00:00:00' AS CreatedAt
  FROM numbered t LEFT JOIN src s ON {on}
  UNION ALL SELECT * FROM fresh)"""


_PATIENT_UPSERT = f"""WITH {_CUSTOMERS},
first AS (SELECT FirstName, LastName, BirthDate, Gender FROM customers WHERE c_acctbal < 6000),
batch AS (SELECT FirstName, LastName, BirthDate,
                 CASE WHEN Gender <> 'BUILDING' THEN LOWER(Gender) END AS Gender
          FROM customers WHERE c_acctbal >= 2000),
{_upsert(['FirstName', 'LastName', 'BirthDate'], ['Gender'], 'PatientID', 'BirthDate')}
SELECT PatientID, FirstName, LastName, CAST(BirthDate AS VARCHAR) AS BirthDate, Gender, CreatedAt
FROM merged"""


def _claim_upsert(how: str, rows: str) -> str:
    return f"""WITH {_CLAIMS}, {_resolved(how)}, usable AS ({rows}),
first AS (SELECT DISTINCT PatientID, ProviderID, DateSubmitted, AmountBilled,
                 CAST(NULL AS DECIMAL(18,2)) AS AmountPaid, 'Submitted' AS Status,
                 CAST(NULL AS DATE) AS DatePaid
          FROM usable WHERE DateSubmitted < DATE '1999-01-01'),
batch AS (SELECT PatientID, ProviderID, DateSubmitted, AmountBilled, AmountPaid, Status, DatePaid
          FROM usable WHERE DateSubmitted >= DATE '1997-01-01'),
{_upsert(['PatientID', 'ProviderID', 'DateSubmitted', 'AmountBilled'],
         ['AmountPaid', 'Status', 'DatePaid'], 'ClaimID')}
SELECT ClaimID, CreatedAt, {_VALID_OUT} FROM merged"""


_EVENT_RUN = "CAST(floor(epoch(ts) / 3600) AS BIGINT)"
_AS_OF = "TIMESTAMP '2024-01-20 12:00:00'"

_RUN_COUNTS = [
    "StgProviderCount", "StgPatientCount", "StgClaimCount",
    "ProviderCount", "PatientCount", "ClaimCount", "RejectTotal",
]
_RUN_LOG = f"""log AS (
  SELECT {_EVENT_RUN} AS RunID, event_id, ts, value, user_id,
         CASE WHEN event_type IN ('signup', 'view') THEN 'START'
              WHEN event_type IN ('click', 'purchase') THEN 'COUNTS' ELSE 'FINISH' END AS ev
  FROM events),
last AS (
  SELECT RunID, MAX(event_id) FILTER (WHERE ev = 'START') AS s,
         MAX(event_id) FILTER (WHERE ev = 'COUNTS') AS c, MAX(event_id) FILTER (WHERE ev = 'FINISH') AS f
  FROM log GROUP BY RunID),
runs AS (
  SELECT l.RunID, strftime(a.ts, '%Y-%m-%d %H:%M:%S') AS StartedAt,
         strftime(b.ts, '%Y-%m-%d %H:%M:%S') AS EndedAt,
         CASE WHEN b.event_id IS NULL THEN NULL WHEN b.value > 20 THEN 'FAILED' ELSE 'SUCCESS' END
           AS Status,
         {', '.join(f'd.user_id + {i} AS {name}' for i, name in enumerate(_RUN_COUNTS))}
  FROM last l JOIN log a ON a.event_id = l.s
  LEFT JOIN log b ON b.event_id = l.f AND l.f > l.s
  LEFT JOIN log d ON d.event_id = l.c AND l.c > l.s)"""

_WHITESPACE = " || ".join(
    f"chr({code})"
    for code in (
        9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760,
        8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202,
        8232, 8233, 8239, 8287, 12288,
    )
)

_TYPED_CLAIMS = f"WITH {_CLAIMS} SELECT {_CLAIM_OUT} FROM stg"

# A first run numbers the dimensions and the claims in the order of their natural keys.
_RUN_TABLES = f"""{_CLAIMS},
patient_ids AS (
  SELECT PatientID AS old_patient, row_number() OVER (
    ORDER BY FirstName, LastName, COALESCE(BirthDate, DATE '1900-01-01')) AS new_patient FROM patients),
provider_ids AS (
  SELECT ProviderID AS old_provider, row_number() OVER (ORDER BY Name, Region) AS new_provider
  FROM providers),
found AS (
  SELECT stg.*, new_patient AS PatientID, new_provider AS ProviderID FROM stg
  LEFT JOIN (patients p JOIN patient_ids ON old_patient = p.PatientID)
    ON FirstName = PatientFirstName AND LastName = PatientLastName
    AND COALESCE(BirthDate, DATE '1900-01-01') = COALESCE(PatientBirthDate, DATE '1900-01-01')
  LEFT JOIN (providers r JOIN provider_ids ON old_provider = r.ProviderID)
    ON Name = ProviderName AND Region = ProviderRegion),
resolved AS (SELECT * FROM found),
valid AS ({_VALID}),
rejects AS ({_REJECTS})"""

_MONEY = """CASE event_type WHEN 'signup' THEN CAST(value AS DECIMAL(18,2))
  WHEN 'click' THEN CAST(-10 * CAST(value AS DECIMAL(18,2)) AS DECIMAL(18,2))
  WHEN 'purchase' THEN CAST(value AS DECIMAL(18,2)) END"""

# The number as its text says, so that minus zero stays minus zero.
_NUMBER = """CAST(CASE event_type WHEN 'click' THEN '-' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || 'e1'
  WHEN 'signup' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
  WHEN 'purchase' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS DOUBLE)"""

_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

ORACLE: dict[str, str] = {
    "resolve_inner": f"WITH {_CLAIMS}, {_resolved('INNER')} "
    f"SELECT {_CLAIM_OUT}, PatientID, ProviderID FROM resolved",
    "resolve_left": _with_left(f"SELECT {_CLAIM_OUT}, PatientID, ProviderID FROM resolved"),
    "resolve_hot_keys": _with_left(f"SELECT {_CLAIM_OUT}, PatientID, ProviderID FROM resolved"),
    "null_sentinel_join": """WITH visits AS (
  SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'F' THEN CAST(o_orderdate AS DATE)
         WHEN 'O' THEN DATE '1900-01-01' END AS visit FROM orders),
known AS (
  SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '1900-01-01'
         WHEN c_mktsegment <> 'MACHINERY' THEN DATE '1998-05-01' END AS since FROM customer)
SELECT o_orderkey, CAST(visit AS VARCHAR) AS visit, c_custkey AS found_id
FROM visits LEFT JOIN known ON o_custkey = c_custkey
  AND COALESCE(visit, DATE '1900-01-01') = COALESCE(since, DATE '1900-01-01')""",
    "fk_violations": f"""WITH {_SUPPLIERS}
SELECT l_suppkey, COUNT(*) AS row_count FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM suppliers WHERE s_acctbal >= 0) GROUP BY l_suppkey""",
    **{f"rule_{code.lower()}": _with_left(_rule(code)) for code in _CODES},
    "rejects_all": _with_left(_REJECTS),
    "rejects_by_rule": _with_left(
        f"SELECT CAST(1 AS BIGINT) AS RunID, RuleCode, COUNT(*) AS RejectCount FROM ({_REJECTS}) r "
        "GROUP BY RuleCode"
    ),
    "multi_rule_rows": _with_left(
        "SELECT * FROM (SELECT "
        f"{_CLAIM_OUT}, PatientID, ProviderID, CAST(CASE WHEN {_HAS_IDS} THEN "
        + " + ".join(f"CASE WHEN {condition} THEN 1 ELSE 0 END" for condition, _ in _RULES.values())
        + " ELSE 1 END AS BIGINT) AS broken_count FROM resolved) r WHERE broken_count >= 2"
    ),
    "valid_claims": _with_left(f"SELECT {_VALID_OUT} FROM ({_VALID}) v"),
    "upsert_dim": f"""WITH {_SUPPLIERS},
first AS (SELECT Name, Region, Specialty FROM suppliers WHERE s_acctbal < 6000),
batch AS (SELECT Name, Region, Specialty || ' II' AS Specialty FROM suppliers WHERE s_acctbal >= 2000),
{_upsert(['Name', 'Region'], ['Specialty'], 'ProviderID')}
SELECT ProviderID, Name, Region, Specialty, CreatedAt FROM merged""",
    "upsert_dim_null_key": _PATIENT_UPSERT,
    "upsert_twice": _PATIENT_UPSERT,
    "upsert_fact_basic": _claim_upsert("INNER", "SELECT * FROM resolved"),
    "upsert_fact_dq": _claim_upsert("LEFT", _VALID),
    "ambiguous_keys": """SELECT l_orderkey, l_linenumber
FROM (SELECT DISTINCT * FROM lineitem) d GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "assign_ids": """SELECT 1000 + row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS line_id,
  l_orderkey, l_linenumber FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) k""",
    "distinct_rows": """SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date FROM lineitem""",
    "coerce_numbers": f"""SELECT event_id, CAST({_MONEY} AS DOUBLE) AS money,
  {_NUMBER} AS number,
  CASE WHEN event_type <> 'error' THEN user_id END AS whole FROM events""",
    "coerce_dates": """SELECT o_orderkey, CASE
  WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN NULL
  WHEN o_orderpriority = '2-HIGH' AND o_orderstatus IN ('O', 'F') THEN NULL
  WHEN o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT'
    THEN CASE WHEN o_orderkey % 2 = 0 THEN '9999-12-31' ELSE '1600-01-01' END
  ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""",
    "coerce_datetimes": """SELECT o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)
    + to_hours(o_orderkey % 24) + to_minutes(o_orderkey % 60), '%Y-%m-%d %H:%M:%S') END AS at,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""",
    "trim_text": f"SELECT doc_id, trim(text, {_WHITESPACE}) AS text FROM documents",
    "na_tokens": """SELECT event_id, CASE event_type WHEN 'purchase' THEN props WHEN 'click' THEN ' NA '
  END AS cell FROM events""",
    "split_single_column": """SELECT CASE WHEN l_returnflag = 'N' THEN ''
  ELSE CAST(l_linenumber AS VARCHAR) END AS line_text, CAST(l_orderkey AS VARCHAR) AS order_text
FROM lineitem""",
    "read_wrapped_feed": _TYPED_CLAIMS,
    "read_plain_feed": _TYPED_CLAIMS,
    "read_bom_feed": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders",
    "read_many_files": """SELECT event_type || ' \u20ac' AS event_kind, CAST(event_id AS VARCHAR) AS event_number
FROM events""",
    "read_delimited_feed": """SELECT CAST(o_orderkey AS VARCHAR) AS key,
  CAST(o_orderkey % 90 AS VARCHAR) || '" x ' || o_orderpriority AS size,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS status FROM orders""",
    "read_multiline_feed": """SELECT CAST(doc_id AS VARCHAR) AS doc, CASE WHEN text <> '' THEN text END AS text
FROM documents""",
    "contract_violations": f"""WITH {_CLAIMS}, c AS (
  SELECT COUNT(*) FILTER (WHERE Status = 'paid') AS no_provider,
         COUNT(*) FILTER (WHERE AmountBilled <= 0) AS no_amount,
         COUNT(*) FILTER (WHERE AmountPaid IS NULL AND LENGTH(Status) * 5 > 30) AS long_status
  FROM stg)
SELECT r.rule, CASE r.rule WHEN 'ProviderName is missing' THEN no_provider
  WHEN 'AmountBilled is missing' THEN no_amount WHEN 'Status is longer than 30' THEN long_status
  ELSE 0 END AS row_count
FROM c, (VALUES ('PatientFirstName is missing'), ('PatientFirstName is longer than 100'),
  ('PatientLastName is missing'), ('PatientLastName is longer than 100'),
  ('ProviderName is missing'), ('ProviderName is longer than 200'),
  ('ProviderRegion is missing'), ('ProviderRegion is longer than 100'),
  ('AmountBilled is missing'), ('Status is missing'), ('Status is longer than 30'),
  ('DateSubmitted is missing')) r(rule)""",
    "table_counts": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}" for name in _TABLES
    ),
    "rejects_by_date_rule": """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS IngestDate,
  UPPER(event_type) AS RuleCode, COUNT(*) AS RejectCount FROM events GROUP BY 1, 2""",
    "rejects_by_run_rule": f"""SELECT {_EVENT_RUN} AS RunID, UPPER(event_type) AS RuleCode,
  COUNT(*) AS RejectCount FROM events GROUP BY 1, 2""",
    "rejects_last_24h": f"""SELECT UPPER(event_type) AS RuleCode, COUNT(*) AS RejectCount FROM events
WHERE ts >= {_AS_OF} - INTERVAL 24 HOURS AND ts <= {_AS_OF} GROUP BY 1""",
    "run_rejects": f"""SELECT event_id AS RejectID, UPPER(event_type) AS RuleCode,
  {_EVENT_RUN} AS RunID FROM events
WHERE ts >= {_AS_OF} AND ts < {_AS_OF} + INTERVAL 1 HOUR""",
    "audit_counters": f"WITH {_RUN_LOG} SELECT * FROM runs",
    "latest_runs": f"WITH {_RUN_LOG} SELECT * FROM runs ORDER BY RunID DESC LIMIT 50",
    "run_claims": f"""WITH {_RUN_TABLES}
SELECT row_number() OVER (ORDER BY v.PatientID, v.ProviderID, v.DateSubmitted, v.AmountBilled)
  AS ClaimID, {_VALID_OUT.replace('PatientID, ProviderID', 'v.PatientID, v.ProviderID', 1)}
FROM valid v""",
    "run_rejects_table": f"WITH {_RUN_TABLES} SELECT r.*, CAST(1 AS BIGINT) AS RunID FROM rejects r",
    "run_counts": f"""WITH {_RUN_TABLES}, n AS (
  SELECT (SELECT COUNT(*) FROM providers) AS p, (SELECT COUNT(*) FROM patients) AS t,
         (SELECT COUNT(*) FROM stg) AS s, (SELECT COUNT(*) FROM valid) AS v,
         (SELECT COUNT(*) FROM rejects) AS r)
SELECT CAST(run AS BIGINT) AS RunID, 'SUCCESS' AS Status, p AS StgProviderCount,
  t AS StgPatientCount, s AS StgClaimCount, p AS ProviderCount, t AS PatientCount,
  v AS ClaimCount, r AS RejectTotal
FROM n, (VALUES (1), (2)) x(run)""",
    "run_result": f"""WITH {_RUN_TABLES}, n AS (
  SELECT (SELECT COUNT(*) FROM valid) AS v, (SELECT COUNT(*) FROM rejects) AS r)
SELECT CAST(1 AS BIGINT) AS RunID, 'SUCCESS' AS Status, v AS ClaimCount, r AS RejectTotal,
  'Run 1 complete. Final Claim rows: ' || v || '. Rejects this run: ' || r AS Message FROM n""",
    "run_failed": f"""WITH {_RUN_TABLES}
SELECT CAST(1 AS BIGINT) AS RunID, 'FAILED' AS Status, TRUE AS Timely, CAST(NULL AS BIGINT) AS StgClaimCount,
  CAST(NULL AS BIGINT) AS ClaimCount, CAST(NULL AS BIGINT) AS RejectTotal, CAST(0 AS BIGINT) AS LeftByFailure
UNION ALL
SELECT 2, 'SUCCESS', TRUE, (SELECT COUNT(*) FROM stg), (SELECT COUNT(*) FROM valid),
  (SELECT COUNT(*) FROM rejects), NULL""",
    "run_reject_summary": f"""WITH {_RUN_TABLES}
SELECT CAST(run AS BIGINT) AS RunID, RuleCode, COUNT(*) AS RejectCount
FROM rejects, (VALUES (1), (2)) x(run) GROUP BY 1, 2""",
    "run_fk_check": f"""WITH {_RUN_TABLES}
SELECT 'Provider' AS Reference, ProviderID AS MissingID, COUNT(*) AS row_count
FROM valid WHERE ProviderID % 7 = 0 GROUP BY ProviderID""",
    "added_column": f"""SELECT event_id AS RejectID, UPPER(event_type) AS RuleCode,
  CAST(CAST(ts AS DATE) AS VARCHAR) AS Day,
  CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-15' THEN {_EVENT_RUN} END AS RunID FROM events""",
}
