"""DuckDB formulation of every registered query, for the correctness gate.

The tables ``events customer nation ...`` are views over the shared parquet
files. The adapter rules of :mod:`fieldreports.sources.adapter` are repeated
here as CTEs, written independently in plain SQL (window functions where the
Spark side uses aggregates, and so on), so a match is a real cross-check.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-02-10 00:00:00'"
CARE_QUESTION = "tN8EHB01kUah"

# (name, body) in dependency order; DuckDB skips CTEs a query does not use.
CTES: list[tuple[str, str]] = [
    ("ev_k", "SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"),
    ("raw", """
SELECT CAST(ts AS TIMESTAMP) AS Report_Date,
  CASE WHEN k % 19 = 0 THEN '31.02.2024'
       WHEN k % 23 = 0 THEN 'unknown'
       WHEN k % 37 = 0 THEN '01.01.0000'
       WHEN k % 29 = 0 THEN strftime(CAST(ts AS DATE) + 3, '%d.%m.%Y')
       WHEN k % 31 = 0 THEN strftime(CAST(ts AS DATE) - 70, '%d.%m.%Y')
       WHEN k % 2 = 0 THEN strftime(CAST(ts AS DATE) - CAST(k % 5 AS INTEGER), '%d-%m-%Y')
       ELSE strftime(CAST(ts AS DATE) - CAST(k % 5 AS INTEGER), '%d/%m/%Y') END AS Service_Date,
  'patient ' || CAST(user_id % 3 AS VARCHAR) AS Patient_Name,
  CAST(k AS VARCHAR) AS Patient_Phone_Number,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS Sender_Phone_Number,
  substr(event_type, 1, 1) AS Service_Code,
  CAST(event_id AS BIGINT) AS sourceId
FROM ev_k"""),
    ("raw_p", """
SELECT *, CASE WHEN regexp_full_match(_s, '[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}') AND right(_s, 4) <> '0000'
               THEN try_strptime(_s, '%d.%m.%Y') END AS _p
FROM (SELECT *, regexp_replace(regexp_replace(Service_Date, '[^0-9]+', '.', 'g'), '^[^0-9]', '') AS _s FROM raw)"""),
    ("msg", """
SELECT md5(coalesce(Service_Date, 'None') || coalesce(upper(Patient_Name), 'None')
           || coalesce(Patient_Phone_Number, 'None') || coalesce(upper(Service_Code), 'None')) AS _id,
  CASE WHEN _p IS NOT NULL AND _p <= Report_Date AND _p >= Report_Date - INTERVAL 56 DAY
       THEN _p ELSE date_trunc('day', Report_Date) END AS serviceDate,
  Service_Date AS ogServiceDate, Patient_Phone_Number AS patientPhone, upper(Patient_Name) AS patientName,
  Sender_Phone_Number AS senderPhone, Report_Date AS "timestamp", upper(Service_Code) AS code, sourceId
FROM raw_p"""),
    ("dd", """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY _id ORDER BY "timestamp", sourceId) AS _rn FROM msg) WHERE _rn = 1"""),
    ("roster_landed", """
SELECT c.c_custkey AS reporting_number, c.c_custkey AS contact_number, c.c_name AS name, n.n_name AS chw_district,
  strftime(CASE WHEN c.c_custkey % 10 = 7 THEN DATE '2022-12-05'
                ELSE DATE '2023-11-01' + CAST((c.c_custkey * 7) % 75 AS INTEGER) END, '%d.%m.%y') AS training_date,
  CAST(c.c_custkey % 4 AS INTEGER) AS treat, CAST(5000 + c.c_custkey % 20 AS VARCHAR) AS phone_ps
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_custkey % 15 <> 14"""),
    ("roster", """
SELECT CAST(reporting_number AS VARCHAR) AS reporting_number, CAST(contact_number AS VARCHAR) AS contact_number,
  name, chw_district, CAST(strptime(training_date, '%d.%m.%y') AS TIMESTAMP) AS training_date, treat, phone_ps
FROM roster_landed"""),
    ("cw", """
SELECT CAST(c_custkey AS VARCHAR) AS old_number, CAST(c_custkey + 1000000 AS VARCHAR) AS new_payment_number
FROM customer WHERE c_custkey % 11 = 0
UNION ALL SELECT '14', '1000011'"""),
    ("roster_t", """
SELECT coalesce(cw.new_payment_number, r.reporting_number) AS reporting_number, r.contact_number, r.name,
  r.chw_district, r.training_date, r.treat, r.phone_ps
FROM roster r LEFT JOIN cw ON r.reporting_number = cw.old_number"""),
    ("msg_k", "SELECT *, CAST(patientPhone AS INTEGER) AS k FROM msg"),
    ("sev", """
SELECT 'called' AS event, "timestamp" AS event_time, _id AS record_id, code AS updates_code FROM msg_k WHERE k % 6 = 0
UNION ALL SELECT 'attempted', "timestamp", _id, NULL FROM msg_k WHERE k % 7 = 0
UNION ALL SELECT 'noConsent', "timestamp", _id, NULL FROM msg_k WHERE k % 13 = 0
UNION ALL SELECT 'called', "timestamp", 'x' || CAST(sourceId AS VARCHAR), NULL FROM msg_k WHERE k % 41 = 0
UNION ALL SELECT 'visited', "timestamp", _id, NULL FROM msg_k WHERE k % 43 = 0"""),
    ("flags", """
SELECT record_id, bool_or(event = 'called') AS called, bool_or(event = 'attempted') AS attempted,
  bool_or(event = 'noConsent') AS noConsent
FROM sev GROUP BY record_id"""),
    ("m_pay", """
SELECT d.*, coalesce(cw.new_payment_number, d.senderPhone) AS paymentPhone
FROM dd d LEFT JOIN cw ON d.senderPhone = cw.old_number"""),
    ("m_info", """
SELECT m.*, r.name AS workerName, r.chw_district, r.training_date, r.treat, r.phone_ps,
  (r.reporting_number IS NULL) AS _tester
FROM m_pay m LEFT JOIN roster_t r ON m.paymentPhone = r.reporting_number"""),
    ("enriched", """
SELECT m.* EXCLUDE (_tester),
  (m._tester OR coalesce(m.training_date >= date_trunc('day', m.serviceDate), false)) AS training,
  coalesce(f.called, false) AS called, coalesce(f.attempted, false) AS attempted,
  coalesce(f.noConsent, false) AS noConsent
FROM m_info m LEFT JOIN flags f ON m._id = f.record_id"""),
    ("pay_a", f"""
SELECT *,
  (year(serviceDate) - year(_anchor)) * 12 + month(serviceDate) - month(_anchor) AS _rawk,
  (year({AS_OF}) - year(_anchor)) * 12 + month({AS_OF}) - month(_anchor) AS _rawn
FROM (SELECT *, training_date + INTERVAL 1 DAY AS _anchor FROM enriched WHERE NOT training)"""),
    ("pay_b", f"""
SELECT *,
  _rawk - CASE WHEN _anchor + to_months(CAST(_rawk AS INTEGER)) > serviceDate THEN 1 ELSE 0 END AS _k,
  CASE WHEN {AS_OF} < _anchor THEN 0
       ELSE (_rawn - CASE WHEN _anchor + to_months(CAST(_rawn AS INTEGER)) > {AS_OF} THEN 1 ELSE 0 END) % 12 END AS _n
FROM pay_a"""),
    ("pay_due", """
SELECT *, CASE WHEN _k >= 0 AND _k < _n THEN _anchor + to_months(CAST(_k + 1 AS INTEGER)) END AS payment_due
FROM pay_b"""),
    ("counts", """
SELECT paymentPhone, payment_due, CAST(count(*) AS BIGINT) AS reports,
  first(treat ORDER BY "timestamp", _id) FILTER (WHERE treat IS NOT NULL) AS treat,
  first(phone_ps ORDER BY "timestamp", _id) FILTER (WHERE phone_ps IS NOT NULL) AS phone_ps,
  first(chw_district ORDER BY "timestamp", _id) FILTER (WHERE chw_district IS NOT NULL) AS chw_district,
  first(workerName ORDER BY "timestamp", _id) FILTER (WHERE workerName IS NOT NULL) AS workerName,
  CAST(least(count(*), 30) AS BIGINT) AS counted
FROM pay_due WHERE paymentPhone IS NOT NULL AND payment_due IS NOT NULL
GROUP BY paymentPhone, payment_due"""),
    ("sup", """
SELECT phone_ps, payment_due, CAST(sum(counted) AS BIGINT) AS counted, CAST(sum(reports) AS BIGINT) AS reports,
  first(treat ORDER BY paymentPhone) FILTER (WHERE treat IS NOT NULL) AS treat
FROM counts WHERE phone_ps IS NOT NULL GROUP BY phone_ps, payment_due"""),
    ("cand", f"""
SELECT * FROM enriched
WHERE serviceDate > {AS_OF} - INTERVAL 28 DAY AND NOT training AND NOT noConsent"""),
    ("cc", """
SELECT paymentPhone, CAST(count(*) AS BIGINT) AS reports, CAST(sum(CAST(called AS BIGINT)) AS BIGINT) AS called
FROM cand WHERE paymentPhone IS NOT NULL GROUP BY paymentPhone"""),
    ("need", """
SELECT *, CAST(ceil(CAST(reports AS DOUBLE) * CAST(0.2 AS DOUBLE)) AS BIGINT) - called AS needed FROM cc"""),
    ("picks", """
SELECT c.* EXCLUDE (_rank, _cnt, _needed) FROM (
  SELECT x.*, row_number() OVER (PARTITION BY x.paymentPhone ORDER BY x."timestamp", x._id) AS _rank,
         count(*) OVER (PARTITION BY x.paymentPhone) AS _cnt, coalesce(n.needed, 0) AS _needed
  FROM cand x LEFT JOIN need n ON x.paymentPhone = n.paymentPhone
  WHERE x.paymentPhone IS NOT NULL) c
WHERE c._rank <= CASE WHEN c._needed >= 0 THEN c._needed ELSE c._cnt + c._needed END"""),
    ("trainq", """
SELECT * REPLACE ('Test' AS chw_district, coalesce(training_date, TIMESTAMP '1970-01-01 00:00:00') AS training_date,
  coalesce(workerName, 'Tester McTesterson') AS workerName)
FROM enriched WHERE training"""),
    ("oldq", """
SELECT district, CAST(s.seq AS BIGINT) AS seq, '{"old":' || CAST(s.seq AS VARCHAR) || '}' AS payload
FROM (SELECT n_name AS district, n_nationkey % 5 * CASE WHEN n_nationkey % 10 = 4 THEN 1000 ELSE 1 END AS n FROM nation
      UNION ALL SELECT 'closed ' || n_name, 3 FROM nation WHERE n_nationkey % 6 = 0) d,
     LATERAL (SELECT unnest(range(1, d.n + 1)) AS seq) s"""),
]


def _entries(src: str) -> str:
    iso = "'%Y-%m-%dT%H:%M:%S'"
    return f"""
SELECT chw_district AS district,
  to_json(struct_pack(_id := _id, paymentPhone := paymentPhone, workerName := workerName,
    chw_district := chw_district, patientName := patientName, patientPhone := patientPhone, code := code,
    serviceDate := strftime(serviceDate, {iso}), training_date := strftime(training_date, {iso}),
    called := called, attempted := attempted)) AS payload,
  md5('42' || coalesce(_id, '')) AS _order
FROM {src}"""


def _refresh(old: str, entries: str, out: str) -> list[tuple[str, str]]:
    """Queue refresh in SQL: windows over whole districts."""
    return [
        (f"{out}_e", entries),
        (f"{out}_n", f"""
SELECT district, payload, row_number() OVER (PARTITION BY district ORDER BY _order, payload) AS _pos,
  count(*) OVER (PARTITION BY district) AS _new_cnt FROM {out}_e"""),
        (f"{out}_nc", f"SELECT DISTINCT district, _new_cnt FROM {out}_n"),
        (f"{out}_oc", f"SELECT district, count(*) AS _o FROM {old} GROUP BY district"),
        (f"{out}", f"""
SELECT o.district, o.seq, o.payload FROM {old} o
WHERE NOT EXISTS (SELECT 1 FROM {out}_nc c WHERE c.district IS NOT DISTINCT FROM o.district)
UNION ALL
SELECT r.district, CAST(r._age - c._new_cnt AS BIGINT), r.payload
FROM (SELECT *, row_number() OVER (PARTITION BY district ORDER BY seq) AS _age FROM {old}) r
JOIN {out}_nc c ON c.district IS NOT DISTINCT FROM r.district
WHERE r._age > c._new_cnt
UNION ALL
SELECT n.district, CAST(greatest(coalesce(oc._o, 0) - n._new_cnt, 0) + n._pos AS BIGINT), n.payload
FROM {out}_n n LEFT JOIN {out}_oc oc ON oc.district IS NOT DISTINCT FROM n.district"""),
    ]


def _visit(v: str) -> str:
    """ISO day of a free-form visit date: clock times, weekdays, filler words and ordinal endings out, then
    the words that are left, with the month name as its number."""
    t = f"regexp_replace(lower(trim({v})), '^([0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}})[t ][0-9]{{1,2}}:[0-9]{{2}}.*$', '\\1')"
    for rx in (r"\b[0-9]{1,2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?\s*([ap]m\b)?\s*((z|utc|gmt)\b|[+-][0-9]{2}:?[0-9]{2}\b)?",
               r"\b[0-9]{1,2}\s*[ap]m\b", r"\b(mon|tues?|wed(nes)?|thu(r|rs)?|fri|sat(ur)?|sun)(day)?\b", r"\b(at|on|of|the|and)\b"):
        t = f"regexp_replace({t}, '{rx}', ' ', 'g')"
    t = rf"regexp_replace({t}, '([0-9])(st|nd|rd|th)\b', '\1', 'g')"
    months = "['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec']"
    long = "['january','february','march','april','may','june','july','august','september','october','november','december','sept']"
    year = lambda y: f"CASE len({y}) WHEN 4 THEN {y} WHEN 2 THEN (CASE WHEN {y} >= '69' THEN '19' ELSE '20' END) || {y} END"
    day = lambda y, m, d: f"CASE WHEN {year(y)} <> '0000' AND len({d}) <= 2 THEN try_strptime({year(y)} || '-' || {m} || '-' || {d}, '%Y-%m-%d') END"
    pair = lambda y, p, q: f"CASE WHEN len({p}) <= 2 AND len({q}) <= 2 THEN coalesce({day(y, p, q)}, {day(y, q, p)}) END"
    mon = f"CAST(coalesce(list_position({months}, w[1]), list_position({long}, w[1])) AS VARCHAR)"
    mon = f"replace({mon}, '13', '9')"
    return f"""(SELECT strftime(CAST(CASE
      WHEN NOT regexp_full_match(t, '[a-z0-9 ,./-]+') THEN NULL
      WHEN len(n) = 1 AND len(w) = 0 AND len(n[1]) = 8 THEN try_strptime(n[1], '%Y%m%d')
      WHEN len(n) = 2 AND len(w) = 1 AND len(n[1]) = 4 THEN {day('n[1]', mon, 'n[2]')}
      WHEN len(n) = 2 AND len(w) = 1 THEN {day('n[2]', mon, 'n[1]')}
      WHEN len(n) = 3 AND len(w) = 0 AND len(n[1]) = 4 THEN {pair('n[1]', 'n[2]', 'n[3]')}
      WHEN len(n) = 3 AND len(w) = 0 THEN {pair('n[3]', 'n[1]', 'n[2]')} END AS DATE), '%Y-%m-%d')
    FROM (SELECT t, regexp_extract_all(t, '[0-9]+') AS n, regexp_extract_all(t, '[a-z]+') AS w FROM (SELECT {t} AS t)))"""


_K5 = ["senderPhone", "patientPhone", "patientName", "code", "_sday"]
_R5 = ["workerphone", "patientphone_typeform", "patient", "code", "visitdate"]


def _eq(l: str, r: str, lk, rk) -> str:
    return " AND ".join(f"{l}.{a} IS NOT DISTINCT FROM {r}.{b}" for a, b in zip(lk, rk))


CTES += [
    ("sv6", """
SELECT *, CAST(serviceDate AS DATE) + CASE WHEN k % 18 = 0 THEN 1 ELSE 0 END AS _v
FROM (SELECT *, CAST(patientPhone AS INTEGER) AS k FROM dd) WHERE k % 6 = 0"""),
    ("resp", """
SELECT sourceId AS response_id, "timestamp" + INTERVAL 2 DAY AS submitted_at, senderPhone AS workerphone,
  'w' || senderPhone AS worker,
  CASE WHEN k % 54 = 0 THEN '9' || patientPhone ELSE patientPhone END AS patientphone,
  CASE WHEN k % 90 = 0 THEN 'someone' ELSE lower(patientName) END AS patient, lower(code) AS code,
  CASE WHEN k % 36 = 0 THEN strftime(_v, '%m.%d.%Y') WHEN k % 66 = 0 THEN 'soon'
       WHEN k % 30 = 0 THEN strftime(_v, '%Y-%m-%dT12:00:00Z') WHEN k % 42 = 0 THEN strftime(_v, '%-d %b %Y')
       WHEN k % 78 = 0 THEN strftime(_v, '%-m/%-d/%y') WHEN k % 102 = 0 THEN strftime(_v, '%Y%m%d')
       WHEN k % 114 = 0 THEN strftime(_v, '%A, %-dth of %B %Y at 3:30 pm') WHEN k % 138 = 0 THEN strftime(_v, '%Y.%m/%d')
       ELSE strftime(_v, '%Y-%m-%d') END AS visitdate,
  _id AS messageid, (k % 60 <> 0) AS called,
  CASE WHEN k % 60 = 0 THEN NULL ELSE (k % 12 = 0) END AS provided_care
FROM sv6
UNION ALL
SELECT sourceId + 1000000, "timestamp" + INTERVAL 2 DAY + INTERVAL 1 HOUR, senderPhone, 'w' || senderPhone,
  CASE WHEN k % 54 = 0 THEN '9' || patientPhone ELSE patientPhone END,
  CASE WHEN k % 90 = 0 THEN 'someone' ELSE lower(patientName) END, lower(code),
  CASE WHEN k % 36 = 0 THEN strftime(_v, '%m.%d.%Y') WHEN k % 66 = 0 THEN 'soon'
       WHEN k % 30 = 0 THEN strftime(_v, '%Y-%m-%dT12:00:00Z') WHEN k % 42 = 0 THEN strftime(_v, '%-d %b %Y')
       WHEN k % 78 = 0 THEN strftime(_v, '%-m/%-d/%y') WHEN k % 102 = 0 THEN strftime(_v, '%Y%m%d')
       WHEN k % 114 = 0 THEN strftime(_v, '%A, %-dth of %B %Y at 3:30 pm') WHEN k % 138 = 0 THEN strftime(_v, '%Y.%m/%d')
       ELSE strftime(_v, '%Y-%m-%d') END,
  _id, (k % 60 <> 0), CASE WHEN k % 60 = 0 THEN NULL ELSE NOT (k % 12 = 0) END
FROM sv6 WHERE sourceId % 4 = 0"""),
    ("cs", f"""
SELECT response_id, submitted_at, workerphone, worker, patientphone, upper(patient) AS patient, upper(code) AS code,
  {_visit('visitdate')} AS visitdate, messageid, called, _any AS provided_care
FROM (SELECT *, row_number() OVER (PARTITION BY patientphone, patient, code, visitdate
                                   ORDER BY submitted_at, response_id) AS _rn,
             bool_or(provided_care) OVER (PARTITION BY patientphone, patient, code, visitdate) AS _any
      FROM resp WHERE provided_care IS NOT NULL AND patientphone IS NOT NULL AND patient IS NOT NULL
        AND code IS NOT NULL AND visitdate IS NOT NULL)
WHERE _rn = 1"""),
    ("ml", "SELECT * RENAME (called AS called_app), strftime(serviceDate, '%Y-%m-%d') AS _sday FROM enriched"),
    ("sr", "SELECT * RENAME (called AS called_typeform, patientphone AS patientphone_typeform) FROM cs"),
    ("both1", f"""
SELECT m.* EXCLUDE (_sday), s.* EXCLUDE (code), 'both' AS _merge
FROM ml m JOIN sr s ON {_eq('m', 's', _K5, _R5)}"""),
    ("left1", f"""
SELECT m.* EXCLUDE (_sday), 'left_only' AS _merge FROM ml m
WHERE NOT EXISTS (SELECT 1 FROM sr s WHERE {_eq('m', 's', _K5, _R5)})"""),
    ("orph1", f"""
SELECT s.* FROM sr s WHERE NOT EXISTS (SELECT 1 FROM ml m WHERE {_eq('m', 's', _K5, _R5)})"""),
    ("right1", "SELECT *, 'right_only' AS _merge FROM orph1"),
    ("both2", f"""
SELECT m.* EXCLUDE (_sday), o.* EXCLUDE (code), 'both' AS _merge
FROM ml m JOIN orph1 o ON {_eq('m', 'o', _K5[:4], _R5[:4])}"""),
    ("orph2", f"""
SELECT o.* RENAME (called_typeform AS called, patientphone_typeform AS patientphone) FROM orph1 o
WHERE NOT EXISTS (SELECT 1 FROM ml m WHERE {_eq('m', 'o', _K5[:4], _R5[:4])})"""),
    ("report", """
SELECT * EXCLUDE (_id, messageid, patient, patientphone_typeform, worker, workerphone) FROM (
  SELECT * FROM both1 UNION ALL BY NAME SELECT * FROM left1 UNION ALL BY NAME SELECT * FROM both2)"""),
    ("cand_day", """
SELECT * EXCLUDE (_rn) FROM (
  SELECT patientPhone, _id, CAST(serviceDate AS DATE) AS _d,
    row_number() OVER (PARTITION BY patientPhone, CAST(serviceDate AS DATE) ORDER BY "timestamp" DESC, _id DESC) AS _rn
  FROM left1 WHERE patientPhone IS NOT NULL) WHERE _rn = 1"""),
    ("ocand", """
SELECT response_id, patientphone, visitdate, n_candidates, candidate_id, candidate_date FROM (
  SELECT o.response_id, o.patientphone, o.visitdate, c._id AS candidate_id, CAST(c._d AS TIMESTAMP) AS candidate_date,
    row_number() OVER (PARTITION BY o.response_id
                       ORDER BY abs(date_diff('day', c._d, CAST(o.visitdate AS DATE))), c._d) AS _r
  FROM orph2 o JOIN cand_day c ON c.patientPhone = o.patientphone) x
JOIN (SELECT patientPhone AS _pp, CAST(count(*) AS BIGINT) AS n_candidates FROM left1
      WHERE patientPhone IS NOT NULL GROUP BY patientPhone) n ON n._pp = x.patientphone
WHERE _r = 1"""),
]

CTES += [
    ("tst", """
SELECT DISTINCT senderPhone AS reporting_number, senderPhone AS contact_number, 'Tester McTesterson' AS name,
  'Test' AS chw_district, CAST(NULL AS TIMESTAMP) AS training_date, CAST(NULL AS INTEGER) AS treat,
  CAST(NULL AS VARCHAR) AS phone_ps
FROM msg WHERE senderPhone IS NOT NULL
  AND senderPhone NOT IN (SELECT reporting_number FROM roster
                          UNION SELECT new_payment_number FROM cw WHERE new_payment_number IS NOT NULL)"""),
    ("dir_old", "SELECT * FROM roster WHERE CAST(reporting_number AS BIGINT) % 2 = 0"),
    ("dir_new", """
SELECT * EXCLUDE (_p, _rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY reporting_number ORDER BY _p, contact_number, name) AS _rn FROM (
    SELECT *, 0 AS _p FROM roster UNION ALL BY NAME SELECT *, 1 AS _p FROM tst)) b
WHERE _rn = 1 AND NOT EXISTS (SELECT 1 FROM dir_old o WHERE o.reporting_number IS NOT DISTINCT FROM b.reporting_number)"""),
    ("lg", "SELECT *, CAST(patientPhone AS INTEGER) AS k FROM dd"),
    ("f2e", """
SELECT 'called' AS event, TIMESTAMP '1970-01-01 00:00:00' AS event_time, _id AS record_id, code AS updates_code
FROM lg WHERE k % 6 = 0
UNION ALL SELECT 'noConsent', TIMESTAMP '1970-01-01 00:00:00', _id, NULL FROM lg WHERE k % 13 = 0
UNION ALL SELECT 'attempted', "timestamp", _id, NULL FROM lg WHERE k % 17 <> 0 AND k % 7 = 0
UNION ALL SELECT 'attempted', "timestamp" + INTERVAL 1 DAY, _id, NULL FROM lg WHERE k % 17 <> 0 AND k % 7 = 0
UNION ALL SELECT 'attempted', "timestamp", _id, NULL FROM lg WHERE k % 17 <> 0 AND k % 7 <> 0 AND k % 11 = 0"""),
    ("leg_raw", """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, md5(coalesce(Service_Date, 'None') || coalesce(upper(Patient_Name), 'None')
             || coalesce(Patient_Phone_Number, 'None') || coalesce(upper(Service_Code), 'None')) AS _id,
    row_number() OVER (PARTITION BY md5(coalesce(Service_Date, 'None') || coalesce(upper(Patient_Name), 'None')
             || coalesce(Patient_Phone_Number, 'None') || coalesce(upper(Service_Code), 'None'))
      ORDER BY Report_Date, sourceId) AS _rn
  FROM raw_p) WHERE _rn = 1"""),
]

CTES += _refresh("oldq", _entries("picks"), "q1")
CTES += _refresh("q1", _entries("trainq"), "q2")


def with_ctes(select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in CTES)
    return f"WITH {body}\n{select.strip()}"


def _pay(rates: dict[int, int]) -> str:
    arms = " ".join(f"WHEN {arm} THEN {amount} * counted" for arm, amount in sorted(rates.items()))
    return f"CAST(10000 + CASE treat {arms} ELSE 0 END AS BIGINT)"


SELECTS: dict[str, str] = {
    "normalize_messages": "SELECT * FROM msg",
    "dedupe_messages": "SELECT * FROM dd",
    "load_roster": "SELECT * FROM roster",
    "load_crosswalk": "SELECT * FROM cw",
    "translate_roster": "SELECT * FROM roster_t",
    "translate_numbers": "SELECT _id, senderPhone, paymentPhone FROM m_pay",
    "add_status_events": """
SELECT d._id, coalesce(f.called, false) AS called, coalesce(f.attempted, false) AS attempted,
  coalesce(f.noConsent, false) AS noConsent FROM dd d LEFT JOIN flags f ON d._id = f.record_id""",
    "enrich": "SELECT * FROM enriched",
    "payment_due": "SELECT _id, paymentPhone, serviceDate, training_date, payment_due FROM pay_due",
    "report_counts": "SELECT * EXCLUDE (counted) FROM counts",
    "capped_counts": "SELECT paymentPhone, payment_due, reports, counted, treat, phone_ps FROM counts",
    "worker_payments": f"""
SELECT paymentPhone AS number, {_pay({2: 2000, 3: 1000})} AS payment, reports, payment_due
FROM counts WHERE counted > 0 ORDER BY payment_due, number""",
    "super_payments": f"""
SELECT CAST(CAST(phone_ps AS BIGINT) AS VARCHAR) AS number, {_pay({1: 2000, 3: 1000})} AS payment, reports, payment_due
FROM sup WHERE counted > 0 ORDER BY payment_due, number""",
    "call_candidates": "SELECT * FROM cand",
    "recent_candidates": "SELECT * FROM cand",
    "call_counts": "SELECT * FROM cc",
    "needed_calls": "SELECT * FROM need",
    "pick_needed_calls": "SELECT * FROM picks",
    "training_queue": "SELECT _id, paymentPhone, chw_district, training_date, workerName FROM trainq",
    "queue_payload": "SELECT district, payload FROM q1_e",
    "district_load": "SELECT chw_district AS district, CAST(count(*) AS BIGINT) AS loaded FROM picks GROUP BY chw_district",
    "queue_refresh": "SELECT * FROM q2",
    "flatten_survey": "SELECT * FROM resp",
    "survey_slices": """
SELECT CASE WHEN d >= 0 THEN strftime(DATE '2024-01-01' + CAST(d // 7 * 7 AS INTEGER), '%Y-%m-%d') END AS slice,
  CAST(count(*) AS BIGINT) AS responses, CAST(count(provided_care) AS BIGINT) AS answered
FROM (SELECT *, date_diff('day', DATE '2024-01-01', CAST(submitted_at AS DATE)) AS d FROM resp) GROUP BY 1""",
    "clean_survey": "SELECT * FROM cs",
    "merge_exact": """
SELECT * FROM both1 UNION ALL BY NAME SELECT * FROM left1
UNION ALL BY NAME SELECT * FROM right1""",
    "reconcile_survey": "SELECT * FROM report",
    "survey_orphans": "SELECT * FROM orph2",
    "orphan_candidates": "SELECT * FROM ocand",
    "roster_coverage": """
SELECT CAST(count(*) AS BIGINT) AS missing FROM report r
WHERE r.training = false AND NOT EXISTS (SELECT 1 FROM dir_old t WHERE t.reporting_number = r.paymentPhone)""",
    "final_report": """
SELECT r.* EXCLUDE (_merge), t.contact_number FROM report r JOIN roster_t t ON r.paymentPhone = t.reporting_number""",
    "testers": "SELECT * FROM tst",
    "directory_upsert": "SELECT * FROM dir_old UNION ALL BY NAME SELECT * FROM dir_new",
    "flags_to_events": "SELECT * FROM f2e",
    "event_upsert": """
SELECT event, event_time, record_id, updates_code FROM sev
UNION ALL
SELECT * FROM f2e n WHERE NOT EXISTS (
  SELECT 1 FROM sev o WHERE o.event_time IS NOT DISTINCT FROM n.event_time AND o.event = n.event
    AND o.record_id IS NOT DISTINCT FROM n.record_id)""",
    "repair_dates": """
SELECT _id, CASE WHEN _p IS NOT NULL AND _p <= Report_Date THEN _p ELSE Report_Date END AS serviceDate FROM leg_raw""",
    "repaired_messages": """
SELECT _id, upper(Service_Code) AS code, CAST(Patient_Phone_Number AS INTEGER) % 6 = 0 AS called,
  CAST(Patient_Phone_Number AS INTEGER) % 13 = 0 AS noConsent,
  CASE WHEN _p IS NOT NULL AND _p <= Report_Date THEN _p ELSE Report_Date END AS serviceDate FROM leg_raw""",
    "legacy_with_flag": """
SELECT _id, 'called' AS kind FROM lg WHERE k % 6 = 0
UNION ALL SELECT _id, 'noConsent' FROM lg WHERE k % 13 = 0
UNION ALL SELECT _id, 'attempted' FROM lg WHERE k % 17 <> 0 AND (k % 7 = 0 OR k % 11 = 0)""",
    "date_or_keep": """
SELECT sourceId, Service_Date, coalesce(strftime(CASE WHEN regexp_full_match(Service_Date, '[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}') AND right(Service_Date, 4) <> '0000'
  THEN try_strptime(Service_Date, '%d.%m.%Y') END, '%Y-%m-%d'), Service_Date) AS serviceDate FROM raw""",
    "payment_windows": f"""
SELECT reporting_number, training_date, _anchor + to_months(CAST(m AS INTEGER)) AS window_start,
  _anchor + to_months(CAST(m + 1 AS INTEGER)) AS window_end
FROM (SELECT *, CASE WHEN {AS_OF} < _anchor THEN 0
                     ELSE (_rawn - CASE WHEN _anchor + to_months(CAST(_rawn AS INTEGER)) > {AS_OF} THEN 1 ELSE 0 END) % 12 END AS _n
      FROM (SELECT *, (year({AS_OF}) - year(_anchor)) * 12 + month({AS_OF}) - month(_anchor) AS _rawn
            FROM (SELECT *, training_date + INTERVAL 1 DAY AS _anchor FROM roster_t WHERE training_date IS NOT NULL))) w,
     LATERAL (SELECT unnest(range(0, w._n)) AS m) s""",
    "bonus_schedule": """
SELECT paymentPhone, payment_due, treat, counted,
  CAST(CASE treat WHEN 2 THEN 2000 * counted WHEN 3 THEN 1000 * counted ELSE 0 END AS BIGINT) AS worker_bonus,
  CAST(CASE treat WHEN 1 THEN 2000 * counted WHEN 3 THEN 1000 * counted ELSE 0 END AS BIGINT) AS supervisor_bonus
FROM counts""",
    "merge_worker_info": """
SELECT _id, paymentPhone, workerName, chw_district, treat, phone_ps, training_date FROM m_info""",
    "tag_testers": "SELECT _id, paymentPhone, _tester AS training FROM m_info",
    "tag_training_day": """
SELECT _id, serviceDate, training_date, coalesce(training_date >= date_trunc('day', serviceDate), false) AS training
FROM m_info""",
    "extraction_windows": f"""
SELECT strftime(s, '%Y-%m-%dT%H:%M:%S') AS since, strftime(s + INTERVAL 7 DAY, '%Y-%m-%dT%H:%M:%S') AS until
FROM (SELECT min(date_trunc('day', Report_Date)) AS st FROM raw) b,
     LATERAL (SELECT unnest(generate_series(b.st, {AS_OF}, INTERVAL 7 DAY)) AS s) g
WHERE s < {AS_OF}""",
    "quality_counts": f"""
SELECT
  (SELECT CAST(count(*) AS BIGINT) FROM raw) AS raw_reports,
  (SELECT CAST(count(*) AS BIGINT) FROM raw_p
   WHERE NOT coalesce(_p IS NOT NULL AND _p <= Report_Date AND _p >= Report_Date - INTERVAL 56 DAY, false)) AS date_fallbacks,
  (SELECT CAST(count(*) AS BIGINT) FROM sev WHERE event NOT IN ('called', 'attempted', 'noConsent')) AS unknown_event_names,
  (SELECT CAST(count(*) AS BIGINT) FROM sev WHERE record_id NOT IN (SELECT _id FROM dd)) AS events_unknown_ids,
  (SELECT CAST(count(*) AS BIGINT) FROM resp WHERE provided_care IS NOT NULL AND visitdate IS NOT NULL
     AND {_visit('visitdate')} IS NULL) AS unreadable_visit_dates,
  (SELECT CAST(count(*) AS BIGINT) FROM dd WHERE senderPhone IS NULL OR patientPhone IS NULL OR patientName IS NULL OR code IS NULL)
    AS null_merge_keys,
  (SELECT CAST(max(n) AS BIGINT) FROM (SELECT count(*) AS n FROM dd GROUP BY senderPhone, patientPhone, patientName, code))
    AS largest_merge_key""",
    "parse_service_date": """
SELECT sourceId, CASE WHEN _p IS NOT NULL AND _p <= Report_Date AND _p >= Report_Date - INTERVAL 56 DAY
  THEN _p ELSE date_trunc('day', Report_Date) END AS serviceDate FROM raw_p""",
    "message_id": "SELECT sourceId, _id FROM msg",
    "unique_visits": """
SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY patientName, code, serviceDate, patientPhone
  ORDER BY "timestamp", _id) AS _rn FROM enriched
  WHERE patientName IS NOT NULL AND code IS NOT NULL AND serviceDate IS NOT NULL AND patientPhone IS NOT NULL) WHERE _rn = 1""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sel) for name, sel in SELECTS.items()}
