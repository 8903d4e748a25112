"""Independent SQL for the registered queries: relational only, never through documents or files."""

from __future__ import annotations

from millrace.functions.keys import draw_sql
from millrace.sources import synth

from .adapter import STATES

_STATES = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"

# raw patient rows
PAT = f"""
base AS (
  SELECT c.*, 'customer.csv' AS src, CAST(NULL AS TIMESTAMP) AS load_ts, c_nationkey AS place, true AS has_city, true AS has_birth
  FROM customer c
  UNION ALL
  SELECT c.*, 'order-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || '.csv', o_orderdate,
         (c_nationkey + CASE WHEN o_orderstatus = 'P' THEN month(o_orderdate) ELSE 0 END) % 25,
         o_orderpriority <> '4-NOT SPECIFIED', o_orderstatus = 'F' OR c_acctbal < 8000
  FROM customer c JOIN orders ON o_custkey = c_custkey
),
nums AS (
  SELECT *, CAST(c_custkey * 7919 % 900000000 + 100000000 AS VARCHAR) AS nine,
         CAST(c_custkey * 104729 % 9000000000 + 1000000000 AS VARCHAR) AS ten
  FROM base
),
pat AS (
  SELECT 'PAT-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS patient_id,
         c_mktsegment AS first_name, c_name AS last_name,
         CASE WHEN has_birth THEN CAST(DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS DATE) END AS birth_date,
         CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN c_acctbal < -500 THEN NULL WHEN c_acctbal < 0 THEN '' WHEN c_acctbal < 300 THEN '12'
              ELSE substr(nine, 1, 3) || '-' || substr(nine, 4, 2) || '-' || substr(nine, 6, 4) END AS ssn,
         CAST(c_custkey AS VARCHAR) || ' Main St' AS address,
         CASE WHEN has_city THEN n_name END AS city,
         {_STATES}[place % 11 + 1] AS state,
         lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zip,
         CASE WHEN c_acctbal > 9700 THEN NULL WHEN c_acctbal > 9300 THEN '' WHEN c_acctbal > 9000 THEN '555'
              ELSE '(' || substr(ten, 1, 3) || ') ' || substr(ten, 4, 3) || '-' || substr(ten, 7, 4) END AS phone,
         src, load_ts
  FROM nums JOIN nation ON n_nationkey = place
)"""


def latest_pat(name: str, where: str = "true") -> str:
    return f"""{name} AS (
  SELECT * FROM pat WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY load_ts DESC NULLS LAST, src DESC) = 1
)"""


def masked(c: str, prefix: str, blank: bool = True) -> str:
    keep = f"WHEN {c} = '' THEN '' " if blank else ""
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return (f"CASE WHEN {c} IS NULL THEN NULL {keep}WHEN length({d}) < 4 THEN '{prefix}XXXX' "
            f"ELSE '{prefix}' || right({d}, 4) END")


SSN = masked("ssn", "XXX-XX-")
PHONE = masked("phone", "(XXX) XXX-")

# raw encounters, one per line item
ENC = f"""
line AS (
  SELECT *, o_orderdate + to_seconds((l_orderkey * 131 + l_partkey) % 86400) AS started_at,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
       JOIN nation ON n_nationkey = s_nationkey
),
enc0 AS (
  SELECT *, started_at + to_seconds(l_partkey * 37 % 13560 + 900) AS stopped_at FROM line
),
enc AS (
  SELECT 'ENC-' || l_orderkey || '-' || l_linenumber AS encounter_id,
         'PAT-' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS patient_id,
         started_at, stopped_at,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'emergency' WHEN '2-HIGH' THEN 'urgentcare' WHEN '3-MEDIUM' THEN 'inpatient'
              WHEN '5-LOW' THEN 'wellness' ELSE 'ambulatory' END AS encounter_class,
         'Dr. ' || s_name AS provider_name,
         'FAC-' || lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS facility_id,
         s_name || ' Clinic' AS facility_name, n_name AS city, {_STATES}[s_nationkey % 11 + 1] AS state,
         CAST(date_diff('minute', started_at, stopped_at) AS BIGINT) AS duration_minutes,
         CAST(CASE WHEN l_linenumber = 7 AND l_linestatus = 'F' THEN NULL WHEN l_linenumber = 6 AND l_linestatus = 'F' THEN 0
              ELSE (l_quantity > 0)::INT + (l_extendedprice > 0)::INT + (l_discount > 0)::INT + (l_tax > 0)::INT END AS BIGINT) AS observation_count,
         CAST(CASE WHEN l_returnflag = 'R' THEN 1 + (l_quantity > 25)::INT ELSE 0 END AS BIGINT) AS condition_count,
         CASE WHEN l_tax > 0 AND l_discount > 0 THEN 'Payer ' || l_returnflag || l_linestatus END AS payer,
         CASE WHEN l_tax > 0 THEN price END AS total_charge,
         CASE WHEN l_tax > 0 THEN CAST(price * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2)) END AS paid_amount,
         CASE WHEN l_tax > 0 THEN CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'denied' END END AS claim_status,
         'encounters-' || l_returnflag || '.json' AS src, l_partkey * 1000000000 + l_suppkey AS file_row, l_shipdate AS load_ts,
         l_linenumber, l_linestatus, l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax
  FROM enc0
)"""
ENC_COLS = ("encounter_id, patient_id, started_at, stopped_at, encounter_class, provider_name, facility_id, facility_name, "
            "city, state, duration_minutes, observation_count, condition_count, payer, total_charge, paid_amount, claim_status")
STG_COLS = ENC_COLS.split(", payer")[0]


def latest_enc(name: str, where: str = "true") -> str:
    return f"""{name} AS (
  SELECT * FROM enc WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY encounter_id ORDER BY load_ts DESC NULLS LAST, src DESC, file_row DESC) = 1
)"""


def obs(source: str) -> str:
    parts = []
    for code, text, c, u in (("QTY", "Quantity", "l_quantity", "pcs"), ("PRICE", "Extended price", "l_extendedprice", "usd"),
                             ("DISC", "Discount", "l_discount", "share"), ("TAX", "Tax", "l_tax", "share")):
        parts.append(f"SELECT encounter_id, '{code}' AS obs_code, '{text}' AS obs_description, {c} AS obs_value, '{u}' AS obs_units "
                     f"FROM {source} WHERE {c} > 0 AND NOT (l_linenumber IN (6, 7) AND l_linestatus = 'F')")
    return " UNION ALL ".join(parts)


REGION = ("CASE WHEN state IN ('NY','NJ','CT','MA','PA') THEN 'Northeast' WHEN state IN ('CA','WA','OR') THEN 'West' "
          "WHEN state = 'TX' THEN 'South' WHEN state = 'IL' THEN 'Midwest' ELSE 'Other' END")
TRACKED = ("first_name", "last_name", "birth_date", "gender", "city", "state")
BATCHES = ("1996-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00")
# rows per batch and batches per checkpoint of the load that is stopped
RESUME_BATCH, RESUME_RUN = 100, 2
AS_OF = (f"load_ts < TIMESTAMP '{BATCHES[0]}'", f"load_ts < TIMESTAMP '{BATCHES[1]}'", "true")


def scd2(null_safe: bool) -> str:
    """CTEs d1, d2, d3: the patient dimension after each snapshot."""
    if null_safe:
        diff = " OR ".join(f"d.{c} IS DISTINCT FROM s.{c}" for c in TRACKED)
    else:
        diff = " OR ".join(
            f"coalesce(d.{c}, DATE '1900-01-01') <> coalesce(s.{c}, DATE '1900-01-01')" if c == "birth_date"
            else f"coalesce(d.{c} <> s.{c}, false)" for c in TRACKED)
    cols = ", ".join(TRACKED)
    out = [latest_pat(f"s{i + 1}", w) for i, w in enumerate(AS_OF)]
    first = lambda t: f"TIMESTAMP '{t}'" if null_safe else "TIMESTAMP '1900-01-01 00:00:00'"
    out.append(f"""d1 AS (
  SELECT row_number() OVER (ORDER BY patient_id) AS patient_sk, patient_id, {cols}, {first(BATCHES[0])} AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current FROM s1)""")
    for i in (2, 3):
        now, d = f"TIMESTAMP '{BATCHES[i - 1]}'", f"d{i - 1}"
        out.append(f"""c{i} AS (
  SELECT d.patient_sk, d.patient_id, {", ".join("d." + c for c in TRACKED)}, d.valid_from,
         CASE WHEN hit THEN {now} ELSE d.valid_to END AS valid_to, d.is_current AND NOT hit AS is_current
  FROM (SELECT d.*, d.is_current AND s.patient_id IS NOT NULL AND ({diff}) AS hit FROM {d} d LEFT JOIN s{i} s ON s.patient_id = d.patient_id) d)""")
        out.append(f"""n{i} AS (
  SELECT (SELECT max(patient_sk) FROM {d}) + row_number() OVER (ORDER BY s.patient_id) AS patient_sk, s.patient_id,
         {", ".join("s." + c for c in TRACKED)},
         CASE WHEN EXISTS (SELECT 1 FROM {d} x WHERE x.patient_id = s.patient_id) THEN {now} ELSE {first(BATCHES[i - 1])} END AS valid_from,
         CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current
  FROM s{i} s WHERE NOT EXISTS (SELECT 1 FROM c{i} c WHERE c.patient_id = s.patient_id AND c.is_current))""")
        out.append(f"d{i} AS (SELECT * FROM c{i} UNION ALL SELECT * FROM n{i})")
    return ",\n".join(out)


DIM_COLS = "patient_sk, patient_id, " + ", ".join(TRACKED) + ", valid_from, valid_to, is_current"

DIMS = f"""
loc AS (SELECT row_number() OVER (ORDER BY city, state) AS location_sk, city, state, {REGION} AS region FROM (SELECT DISTINCT city, state FROM e)),
fac AS (SELECT row_number() OVER (ORDER BY facility_id) AS facility_sk, facility_id, facility_name, location_sk
        FROM (SELECT DISTINCT facility_id, facility_name, city, state FROM e) JOIN loc USING (city, state)),
prov AS (SELECT row_number() OVER (ORDER BY provider_name) AS provider_sk, provider_name FROM (SELECT DISTINCT provider_name FROM e)),
pay AS (SELECT row_number() OVER (ORDER BY payer) AS payer_sk, payer AS payer_name FROM (SELECT DISTINCT payer FROM e WHERE payer IS NOT NULL))"""
DATE_KEY = "CAST(strftime(started_at, '%Y%m%d') AS BIGINT)"
FACT = f"""
fact AS (
  SELECT e.encounter_id, {DATE_KEY} AS date_key, d.patient_sk, provider_sk, facility_sk, payer_sk, encounter_class, claim_status,
         duration_minutes, observation_count, condition_count, total_charge, paid_amount
  FROM e LEFT JOIN d3 d ON d.patient_id = e.patient_id AND started_at >= valid_from AND (started_at < valid_to OR valid_to IS NULL)
  LEFT JOIN prov USING (provider_name) LEFT JOIN fac ON fac.facility_id = e.facility_id LEFT JOIN pay ON payer_name = payer)"""
MARTS = f"WITH {PAT}, {scd2(False)}, {ENC}, {latest_enc('e')}, {DIMS}, {FACT} "
SUMS = ("count(*) AS encounters, CAST(sum(duration_minutes) AS BIGINT) AS minutes, CAST(sum(total_charge) AS DECIMAL(20,2)) AS charged, "
        "CAST(sum(paid_amount) AS DECIMAL(20,2)) AS paid")
CALENDAR = """
days AS (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS TIMESTAMP), CAST(max(o_orderdate) AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM orders),
dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, year(d) AS year, month(d) AS month, day(d) AS day,
                    strftime(d, '%b') AS month_name, dayofweek(d) AS day_of_week FROM days)"""


def _checks(parts: list[tuple[str, str]]) -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", CAST(({q}) AS BIGINT) AS violations" for n, q in parts)
    return f"SELECT *, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({rows})"


def label(table: str, column: str, rule: str) -> str:
    """How a check is named: what it looks at and the rule it holds it to."""
    return f"{rule}({table}, {column})"


def _fact_checks() -> list[tuple[str, str]]:
    def missing(name, view, c):
        return (label(name, c, "present"), f"SELECT count(*) FROM {view} WHERE {c} IS NULL")

    def orphans(name, view, c, dim, null_ok):
        given = f"{c} IS NOT NULL AND " if null_ok else ""
        return (label(name, c, "known"), f"SELECT count(*) FROM {view} f WHERE {given}NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{c} = f.{c})")

    def unmasked(name, view, c, text, pattern):
        return (label(name, c, "masked"), f"SELECT count(*) FROM (SELECT {text} AS x FROM {view}) WHERE x IS NOT NULL AND x NOT LIKE '{pattern}'")

    return [
        *[missing("fact_encounter", "fact", c) for c in FACT_KEYS],
        *[orphans("fact_encounter", "fact", c, dim, ok) for c, dim, ok in (("patient_sk", "d3", True), ("facility_sk", "fac", False), ("date_key", "dim_date", False), ("payer_sk", "pay", True))],
        (label("fact_encounter", "paid_amount", "within_charge"), "SELECT count(*) FROM fact WHERE paid_amount > total_charge"),
        (label("dim_patient", "is_current", "once_per_key"), "SELECT count(*) FROM (SELECT patient_id FROM d3 WHERE is_current GROUP BY 1 HAVING count(*) > 1)"),
        orphans("dim_facility", "fac", "location_sk", "loc", False), missing("dim_location", "loc", "region"),
        *[unmasked(name, view, c, text, pattern) for name, view in (("patients_csv", "pat"), ("patients", "s3")) for c, text, pattern in (("ssn", SSN, "XXX-XX-%"), ("phone", PHONE, "(XXX) XXX-%"))],
    ]


FACT_KEYS = ("date_key", "facility_sk", "patient_sk", "provider_sk")
SNAP_SK = "md5(patient_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S'))"
HASHED = f"""
snap AS (SELECT {SNAP_SK} AS patient_sk, patient_id, is_current FROM d3),
hloc AS (SELECT md5(city || '|' || state) AS location_sk, city, state, {REGION} AS region FROM (SELECT DISTINCT city, state FROM enc)),
hfac AS (SELECT md5(facility_id) AS facility_sk, facility_id, facility_name, md5(city || '|' || state) AS location_sk
         FROM (SELECT DISTINCT facility_id, facility_name, city, state FROM enc)),
hprov AS (SELECT md5(provider_name) AS provider_sk, provider_name FROM (SELECT DISTINCT provider_name FROM enc)),
hfact AS (SELECT e.encounter_id, {DATE_KEY} AS date_key, s.patient_sk, md5(provider_name) AS provider_sk, md5(facility_id) AS facility_sk,
                 encounter_class, duration_minutes, observation_count, condition_count
          FROM enc e LEFT JOIN snap s ON s.patient_id = e.patient_id AND s.is_current)"""
CURRENT = f"WITH {PAT}, {scd2(True)}, {ENC}, {HASHED} "


def _model_checks() -> list[tuple[str, str]]:
    def null(t, c):
        return (f"{t}.{c} not_null", f"SELECT count(*) FROM {t} WHERE {c} IS NULL")

    def unique(t, c):
        return (f"{t}.{c} unique", f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")

    def rel(t, c, to):
        return (f"{t}.{c} relationships", f"SELECT count(*) FROM {t} f WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {to} d WHERE d.{c} = f.{c})")

    return [
        null("hloc", "location_sk"), unique("hloc", "location_sk"),
        ("hloc.region accepted_values", "SELECT count(*) FROM hloc WHERE region NOT IN ('Northeast','West','South','Midwest','Other')"),
        null("hfac", "facility_sk"), unique("hfac", "facility_sk"), rel("hfac", "location_sk", "hloc"),
        null("hprov", "provider_sk"), unique("hprov", "provider_sk"),
        null("snap", "patient_sk"), unique("snap", "patient_sk"),
        null("hfact", "encounter_id"), null("hfact", "facility_sk"), rel("hfact", "facility_sk", "hfac"),
        rel("hfact", "provider_sk", "hprov"), rel("hfact", "date_key", "dim_date"), rel("hfact", "patient_sk", "snap"),
        null("s3", "patient_id"), unique("s3", "patient_id"), null("enc", "encounter_id"), null("enc", "patient_id"),
    ]


def _pick(values: list, at: str) -> str:
    text = ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"([{text}])[{at} + 1]"


def _synth_patients() -> str:
    d = lambda k, n: draw_sql("c_custkey", k, 42, n)
    v = lambda k, n, plus: f"CAST({d(k, n)} + {plus} AS VARCHAR)"
    return f"""SELECT 'PAT-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS patient_id,
      {_pick(synth.FIRST_NAMES, d(1, len(synth.FIRST_NAMES)))} AS first_name, {_pick(synth.LAST_NAMES, d(2, len(synth.LAST_NAMES)))} AS last_name,
      CAST(DATE '1940-01-01' + CAST({d(3, 27759)} AS INTEGER) AS DATE) AS birth_date, {_pick(["M", "F"], d(4, 2))} AS gender,
      {v(5, 800, 100)} || '-' || {v(6, 90, 10)} || '-' || {v(7, 9000, 1000)} AS ssn,
      {v(8, 9999, 1)} || ' ' || {_pick(synth.LAST_NAMES, d(9, len(synth.LAST_NAMES)))} || ' St' AS address,
      {_pick(synth.CITIES, d(10, len(synth.CITIES)))} AS city, {_pick(synth.STATES, d(11, 8))} AS state,
      lpad({v(12, 14000, 6000)}, 5, '0') AS zip,
      '(' || {v(13, 790, 200)} || ') ' || {v(14, 790, 200)} || '-' || {v(15, 9000, 1000)} AS phone
    FROM customer"""


def _synth_encounters() -> str:
    d = lambda k, n: draw_sql("i", k, 42, n)
    cents = f"({_pick(synth.CLASS_CHARGE, d(24, 5))} * ({d(28, 91)} + 70))"
    status = d(26, 100)
    part = f"CASE WHEN {status} < 80 THEN 2 WHEN {status} < 95 THEN 1 ELSE 0 END"
    start = f"TIMESTAMP '2023-01-01' + to_minutes({d(21, 1096)} * 1440 + ({d(22, 13)} + 7) * 60)"
    return f"""WITH p AS (SELECT c_custkey, unnest(range(1, {draw_sql('c_custkey', 20, 42, 6)} + 2)) AS n FROM customer),
    v AS (SELECT *, c_custkey * 6 + n AS i FROM p)
    SELECT 'ENC-' || lpad(CAST(i AS VARCHAR), 13, '0') AS encounter_id, 'PAT-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS patient_id,
      strftime({start}, '%Y-%m-%dT%H:%M:%S') AS start, {_pick(synth.CLASSES, d(24, 5))} AS encounter_class,
      {_pick(synth.PROVIDERS, d(31, len(synth.PROVIDERS)))} AS provider_name, {_pick([f[0] for f in synth.FACILITIES], d(27, 3))} AS facility_id,
      {_pick([p for p, _ in synth.PAYERS], d(25, 6))} AS payer,
      CASE WHEN {status} < 80 THEN 'paid' WHEN {status} < 95 THEN 'pending' ELSE 'denied' END AS claim_status,
      {cents} AS charge_cents,
      {d(29, 6)} + 1 AS n_observations, CASE WHEN {d(30, 6)} = 5 THEN 0 ELSE 1 END AS n_conditions
    FROM v"""


EMAIL_TEXT = ("CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 300 THEN '' WHEN c_mktsegment = 'BUILDING' THEN c_name "
              "WHEN c_mktsegment = 'MACHINERY' THEN '@' || lower(c_mktsegment) || '.example' "
              "ELSE replace(c_name, '#', '.') || '@' || lower(c_mktsegment) || '@example.com' END")
MARK_TEXT = "CASE WHEN event_type = 'error' THEN 'E-' || event_id WHEN event_type = 'view' THEN event_id || '.0' ELSE CAST(event_id AS VARCHAR) END"
LOG = "SELECT event_type AS target, 'u' || user_id AS loaded_by, CAST(floor(value) AS BIGINT) AS rows_written, ts AS loaded_at FROM events"
CUT = "TIMESTAMP '1998-01-01 00:00:00'"


def sql() -> dict[str, str]:
    P, E = f"WITH {PAT} ", f"WITH {ENC} "
    o: dict[str, str] = {}
    o["observation_stats"] = (f"WITH {ENC}, o AS ({obs('enc')}) SELECT obs_code, min(obs_description) AS description, count(*) AS n_observations, "
                              "round(avg(obs_value), 2) AS avg_value FROM o GROUP BY 1")
    o["observations_flat"] = f"WITH {ENC} {obs('enc')}"
    o["observations_staged"] = f"WITH {ENC}, {latest_enc('e')} {obs('e')}"
    o["conditions_flat"] = E + """SELECT patient_id, 'C-' || l_linenumber AS condition_code, 'Condition ' || l_linenumber AS condition_description
        FROM enc WHERE l_returnflag = 'R' UNION ALL SELECT patient_id, 'Q-HIGH', 'High quantity' FROM enc WHERE l_returnflag = 'R' AND l_quantity > 25"""
    o["encounters_flat"] = E + f"SELECT {ENC_COLS} FROM enc"
    o["encounters_staged"] = f"WITH {ENC}, {latest_enc('e')} SELECT {ENC_COLS} FROM e"
    o["stg_encounters"] = E + f"SELECT {STG_COLS} FROM enc"
    o["dt_encounters"] = E + "SELECT encounter_id, patient_id, started_at, encounter_class, provider_name, state, payer, total_charge FROM enc"
    o["variant_props"] = "SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events"
    o["patients_dedup_masked"] = (f"WITH {PAT}, {latest_pat('s')} SELECT patient_id, first_name, last_name, birth_date, gender, city, state, "
                                  f"{SSN} AS ssn_masked, {PHONE} AS phone_masked FROM s")
    as_stored = (f"WITH {PAT}, {latest_pat('s')} SELECT patient_id, first_name, last_name, birth_date, gender, city, state, "
                 "ssn AS ssn_masked, phone AS phone_masked FROM s")
    o["dt_patients"] = o["stg_patients"] = as_stored
    parts = [f"SELECT encounter_id, provider_name, started_at, '{code}' AS obs_code, {c} AS obs_value FROM enc "
             f"WHERE {c} > 0 AND NOT (l_linenumber IN (6, 7) AND l_linestatus = 'F')"
             for code, c in (("QTY", "l_quantity"), ("PRICE", "l_extendedprice"), ("DISC", "l_discount"), ("TAX", "l_tax"))]
    o["sql_documents"] = E + " UNION ALL ".join(parts)
    o["sql_views"] = f"""WITH {PAT}, {latest_pat('p')}, {ENC} SELECT gender, encounter_class, count(*) AS encounters,
        count(*) FILTER ({SSN} LIKE 'XXX-XX-%') AS with_ssn, count(*) FILTER (phone IS NOT NULL) AS phone_stable
        FROM enc LEFT JOIN p ON p.patient_id = enc.patient_id GROUP BY 1, 2"""
    o["mask_ssn"] = P + f"SELECT patient_id, src AS source_file, {SSN} AS masked, {SSN} AS masked_sql FROM pat"
    o["mask_phone"] = P + f"SELECT patient_id, src AS source_file, {PHONE} AS masked, {PHONE} AS masked_sql FROM pat"
    o["mask_email"] = f"""WITH c AS (SELECT c_custkey, {EMAIL_TEXT} AS email FROM customer)
        SELECT c_custkey, CASE WHEN strpos(email, '@') = 0 THEN email
          ELSE substr(email, 1, CASE WHEN strpos(email, '@') > 1 THEN 1 ELSE 0 END) || '****@' || substr(email, strpos(email, '@') + 1) END AS masked FROM c"""
    o["mask_redact"] = P + "SELECT patient_id, src AS source_file, CASE WHEN city IS NOT NULL THEN '***REDACTED***' END AS city FROM pat"
    o["mask_hash"] = P + "SELECT sha256('pepper' || patient_id) AS token, sha256('pepper' || ssn) AS ssn_token, count(*) AS n FROM pat GROUP BY 1, 2"
    o["mask_columns"] = P + f"""SELECT sha256('pepper' || patient_id) AS patient_id, last_name, {SSN} AS ssn, {PHONE} AS phone,
        CASE WHEN address IS NOT NULL THEN '***REDACTED***' END AS address, src AS source_file FROM pat"""
    o["mask_by_role"] = P + f"""SELECT 'PII_READER' AS role, patient_id, ssn, phone, src AS source_file FROM pat UNION ALL
        SELECT 'ANALYST', patient_id, {masked('ssn', 'XXX-XX-', False)}, {masked('phone', '(XXX) XXX-', False)}, src FROM pat"""
    o["mask_tagged"] = P + """SELECT 'PII_READER' AS role, patient_id, address, city, src AS source_file FROM pat UNION ALL
        SELECT 'ANALYST', patient_id, CASE WHEN address IS NOT NULL THEN '***MASKED***' END, CASE WHEN city IS NOT NULL THEN '***MASKED***' END, src FROM pat"""

    o["hwm_since"] = "SELECT event_id, ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-10 12:00:00'"
    o["hwm_string_order"] = f"WITH m AS (SELECT event_id, {MARK_TEXT} AS mark FROM events) SELECT event_id, mark FROM m WHERE mark LIKE 'E-%' OR event_id > 99"
    o["hwm_chunks"] = """WITH r AS (SELECT o_orderkey, o_orderdate, CAST((rank() OVER (ORDER BY o_orderdate) - 1) // 500 AS BIGINT) AS chunk_id FROM orders)
        SELECT o_orderkey, chunk_id, max(o_orderdate) OVER (PARTITION BY chunk_id) AS chunk_hwm FROM r"""
    o["hwm_chunks_text"] = f"""WITH m AS (SELECT event_id, event_type, {MARK_TEXT} AS mark FROM events),
        r AS (SELECT *, CAST((rank() OVER (ORDER BY event_type = 'error', CASE WHEN event_type <> 'error' THEN event_id END, CASE WHEN event_type = 'error' THEN mark END) - 1) // 300 AS BIGINT) AS chunk_id FROM m)
        SELECT event_id, chunk_id, last_value(mark) OVER (PARTITION BY chunk_id ORDER BY event_type = 'error', CASE WHEN event_type <> 'error' THEN event_id END,
          CASE WHEN event_type = 'error' THEN mark END ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS chunk_hwm FROM r"""
    o["pending_count"] = "SELECT event_type, count(*) AS total_rows, count(*) FILTER (ts > TIMESTAMP '2024-01-10 12:00:00') AS pending_rows FROM events GROUP BY 1"

    load_cut = "ts > TIMESTAMP '2024-01-15 00:00:00'"
    o["incremental_load"] = (f"SELECT event_id, ts, sha256('pepper' || user_id) AS user_id, event_type, value, '***REDACTED***' AS props, "
                             f"CAST(CASE WHEN {load_cut} THEN 1 ELSE 0 END AS BIGINT) AS load_no FROM events")
    o["dry_run_report"] = """SELECT 'events' AS name, count(*) AS rows_read, CAST(0 AS BIGINT) AS rows_written, CAST((count(*) + 4999) // 5000 AS BIGINT) AS batches FROM events
        UNION ALL SELECT 'orders', count(*), 0, CAST((count(*) + 4999) // 5000 AS BIGINT) FROM orders"""
    o["load_state_status"] = """SELECT 'events' AS name, 'complete' AS status, count(*) AS rows, CAST(max(event_id) AS VARCHAR) AS hwm FROM events
        UNION ALL SELECT 'orders', 'complete', count(*), CAST(max(o_orderkey) AS VARCHAR) FROM orders"""
    o["restart_load"] = "SELECT event_id, CAST(2 AS BIGINT) AS copies FROM events"
    o["work_list"] = """SELECT c_mktsegment AS source_group, 't' || c_custkey AS source_table, upper(c_name) AS target_table, 'id' AS hwm_column,
        CAST(CASE WHEN c_acctbal < 1000 THEN 5000 ELSE c_nationkey * 100 + 100 END AS BIGINT) AS batch_size,
        CASE WHEN c_nationkey < 10 THEN 'ssn' END AS ssn_policy FROM customer WHERE c_acctbal >= 0"""
    o["parallel_loads"] = " UNION ALL ".join(f"SELECT 'parquet' AS source, '{t}' AS target, count(*) AS rows_read, count(*) AS rows_written FROM {t}" for t in ("events", "orders", "customer"))
    chunks = f"SELECT ts, n, (upto - n) // {RESUME_BATCH} AS chunk FROM (SELECT ts, n, sum(n) OVER (ORDER BY ts) AS upto FROM (SELECT ts, count(*) AS n FROM {{}} GROUP BY ts))"
    run = f"greatest({RESUME_RUN}, ((SELECT max(chunk) FROM {{}}) + 64) // 64)"
    o["resumed_load"] = f"""WITH c1 AS ({chunks.format('events')}), g1 AS (SELECT ts, chunk // {run.format('c1')} AS step FROM c1),
        done AS (SELECT * FROM g1 WHERE step IN (SELECT DISTINCT step FROM g1 ORDER BY step LIMIT 3)),
        rest AS (SELECT * FROM events WHERE ts > (SELECT max(ts) FROM done)),
        c2 AS ({chunks.format('rest')}), g2 AS (SELECT ts, chunk // {run.format('c2')} AS step FROM c2),
        steps AS (SELECT ts, dense_rank() OVER (ORDER BY step) - 1 AS step FROM done UNION ALL SELECT ts, 2 + dense_rank() OVER (ORDER BY step) FROM g2)
        SELECT CAST(step AS BIGINT) AS step, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT event_id) AS n_events,
          CASE WHEN step >= 3 THEN CAST((SELECT count(DISTINCT chunk) FROM c2) AS BIGINT) END AS rerun_batches
        FROM events JOIN steps USING (ts) GROUP BY step"""
    o["configured_job"] = """SELECT 'CUSTOMER_RAW' AS target, c_custkey AS "C_CUSTKEY", '***REDACTED***' AS "C_NAME", sha256('s' || c_mktsegment) AS "C_MKTSEGMENT",
          CAST(NULL AS BIGINT) AS "O_ORDERKEY", NULL AS "O_ORDERSTATUS", (SELECT count(*) FROM customer) AS rows_read, (SELECT count(*) FROM customer) AS rows_written FROM customer
        UNION ALL SELECT 'orders', NULL, NULL, NULL, o_orderkey, o_orderstatus, (SELECT count(*) FROM orders), (SELECT count(*) FROM orders) FROM orders"""
    o["snapshot_swap"] = "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 'before' ELSE 'current' END AS version FROM orders"
    o["run_totals"] = """SELECT event_type AS run_id, count(*) AS n_tables, CAST(sum(user_id) AS BIGINT) AS rows_read, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS rows_written
        FROM events GROUP BY 1"""

    o["csv_by_name"] = """SELECT CAST(c_custkey AS VARCHAR) AS custkey, CASE WHEN c_acctbal < 100 THEN NULL ELSE c_name END AS name,
        CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM customer"""
    o["csv_bad_rows"] = """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, CASE WHEN event_type = 'error' THEN 'value' END AS failing,
        CASE WHEN event_type = 'error' THEN 'return_errors' ELSE 'continue' END AS policy FROM events"""
    o["ndjson_bad_rows"] = """SELECT CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS event_id,
        CASE WHEN event_type = 'error' THEN '{"event_id": ' || event_id || ', "broken' END AS line,
        CASE WHEN event_type = 'error' THEN 'return_errors' ELSE 'continue' END AS policy FROM events"""
    o["file_lineage"] = "SELECT event_id, true AS in_order FROM events"
    o["file_load"] = P + "SELECT patient_id, birth_date, ssn, CAST(2 AS BIGINT) AS copies FROM (SELECT DISTINCT patient_id, birth_date, nullif(ssn, '') AS ssn, src FROM pat)"
    o["paged_api"] = "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer"
    o["workbook"] = "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey > 7"

    o["merge_new_rows"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'"
    o["merge_upsert"] = f"""WITH {PAT}, {latest_pat('t', f'load_ts < {CUT} OR load_ts IS NULL')}, {latest_pat('s', f'load_ts >= {CUT}')}
        SELECT t.patient_id, t.first_name, CASE WHEN s.patient_id IS NULL THEN t.city ELSE s.city END AS city,
          CASE WHEN s.patient_id IS NULL THEN t.state ELSE s.state END AS state, t.src AS first_source FROM t LEFT JOIN s ON s.patient_id = t.patient_id"""
    o["delta_ingest"] = f"""WITH {ENC}, {latest_enc('t', "load_ts < TIMESTAMP '2000-01-01'")}, {latest_enc('v')}
        SELECT {ENC_COLS} FROM t UNION ALL SELECT {ENC_COLS} FROM v WHERE encounter_id NOT IN (SELECT encounter_id FROM t)"""
    o["update_from"] = f"""WITH {PAT}, {latest_pat('t', f'load_ts < {CUT} OR load_ts IS NULL')}, {latest_pat('s', f'load_ts >= {CUT}')}
        SELECT t.patient_id, t.city, coalesce(t.state <> s.state, false) AS stale FROM t LEFT JOIN s ON s.patient_id = t.patient_id"""
    o["insert_if_absent"] = """SELECT DISTINCT o_custkey AS custkey, 'orders' AS origin FROM orders UNION ALL
        SELECT c_custkey, 'customer' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""
    o["exists_flag"] = "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS known FROM customer"
    o["assign_ids"] = "SELECT 100 + row_number() OVER (ORDER BY c_name) AS id, c_name FROM customer"

    o["dim_date"] = f"WITH {CALENDAR} SELECT * FROM dim_date"
    for name, cte in (("location", "loc"), ("facility", "fac"), ("provider", "prov"), ("payer", "pay")):
        o[f"dim_{name}"] = f"WITH {ENC}, {latest_enc('e')}, {DIMS} SELECT * FROM {cte}"
    for name, cte in (("location", "hloc"), ("facility", "hfac"), ("provider", "hprov")):
        o[f"dim_{name}_hashed"] = CURRENT + f"SELECT * FROM {cte}"
    o["scd2_native"] = f"WITH {PAT}, {scd2(False)} SELECT {DIM_COLS} FROM d3"
    o["scd2_snapshot"] = (f"WITH {PAT}, {scd2(True)} SELECT {SNAP_SK} AS scd_id, patient_id, " + ", ".join(TRACKED)
                          + ", valid_from, valid_to, is_current FROM d3")
    o["fact_native"] = MARTS + "SELECT * FROM fact"
    o["asof_sorted"] = MARTS + "SELECT encounter_id, patient_sk FROM fact"
    o["fact_current"] = CURRENT + "SELECT * FROM hfact"
    o["backfill"] = f"""WITH {PAT}, {latest_pat('s')}, {ENC}, {latest_enc('e')}, {DIMS},
        d3 AS (SELECT row_number() OVER (ORDER BY patient_id) AS patient_sk, patient_id, TIMESTAMP '1900-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM s),
        {FACT} SELECT * FROM fact"""
    o["region_class_rollup"] = MARTS + f"SELECT region, encounter_class, {SUMS} FROM fact LEFT JOIN fac USING (facility_sk) LEFT JOIN loc USING (location_sk) GROUP BY 1, 2"
    o["provider_rollup"] = MARTS + f"SELECT provider_name, {SUMS} FROM fact LEFT JOIN prov USING (provider_sk) GROUP BY 1"
    o["payer_rollup"] = MARTS + f"SELECT payer_name, claim_status, {SUMS} FROM fact LEFT JOIN pay USING (payer_sk) GROUP BY 1, 2"
    o["monthly_trend"] = f"{MARTS.rstrip()}, {CALENDAR} SELECT year, month, month_name, {SUMS} FROM fact LEFT JOIN dim_date USING (date_key) GROUP BY 1, 2, 3"
    o["patient_history"] = f"WITH {PAT}, {scd2(False)} SELECT patient_sk, patient_id, city, state, valid_from, valid_to, is_current FROM d3"

    o["load_health"] = f"""WITH log AS ({LOG}) SELECT target, count(*) AS loads, CAST(sum(rows_written) AS BIGINT) AS total_rows_written, max(loaded_at) AS last_loaded_at,
        max_by(loaded_by, loaded_at) AS last_loaded_by FROM log GROUP BY 1"""
    floor5 = "time_bucket(INTERVAL 5 MINUTE, ts)"
    alert = f"""SELECT alerted_at, 'Task failure detected in the last 10 minutes' AS message, count(*) AS failures FROM (
        SELECT {floor5} + INTERVAL 5 MINUTE AS alerted_at FROM events WHERE event_type = 'error'
        UNION ALL SELECT {floor5} + INTERVAL 10 MINUTE FROM events WHERE event_type = 'error') GROUP BY 1"""
    o["failure_alert"] = alert

    o["stream_autoingest"] = P + "SELECT patient_id, birth_date, nullif(ssn, '') AS ssn, city, src AS address FROM pat"
    o["stream_ndjson"] = E + "SELECT encounter_id, total_charge, observation_count FROM enc"
    o["stream_latest"] = as_stored.replace("ssn AS ssn_masked, phone AS phone_masked", "ssn, phone")
    o["stream_projection"] = o["dt_encounters"]
    o["stream_dag"] = f"""WITH {PAT}, {latest_pat('a', f'load_ts < {CUT} OR load_ts IS NULL')}, {latest_pat('z')},
        moved AS (SELECT z.patient_id FROM a JOIN z USING (patient_id) WHERE coalesce(a.city <> z.city, false) OR coalesce(a.state <> z.state, false)
                  OR coalesce(a.birth_date, DATE '1900-01-01') <> coalesce(z.birth_date, DATE '1900-01-01')),
        {ENC}, {latest_enc('e1', f'load_ts < {CUT}')}, {latest_enc('e2', f'load_ts >= {CUT}')},
        staged AS (SELECT 1 AS batch, * FROM e1 UNION ALL SELECT 2, * FROM e2 WHERE encounter_id NOT IN (SELECT encounter_id FROM e1))
        SELECT encounter_id, {DATE_KEY} AS date_key,
          CASE WHEN batch = 2 AND started_at >= {CUT} AND patient_id IN (SELECT patient_id FROM moved) THEN {CUT} ELSE TIMESTAMP '1900-01-01' END AS version_from,
          provider_name, facility_id, {REGION} AS region, payer AS payer_name, duration_minutes, observation_count, total_charge FROM staged"""
    o["stream_dag_observations"] = f"""WITH {ENC}, {latest_enc('e1', f'load_ts < {CUT}')}, {latest_enc('e2', f'load_ts >= {CUT}')},
        staged AS (SELECT * FROM e1 UNION ALL SELECT * FROM e2 WHERE encounter_id NOT IN (SELECT encounter_id FROM e1)) {obs('staged')}"""
    years = """y AS (SELECT DISTINCT year(started_at) AS y FROM staged WHERE started_at IS NOT NULL),
        dim_date AS (SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, year(d) AS year, month(d) AS month, strftime(d, '%b') AS month_name
          FROM (SELECT CAST(unnest(generate_series(make_timestamp(y, 1, 1, 0, 0, 0.0), make_timestamp(y, 12, 31, 0, 0, 0.0), INTERVAL 1 DAY)) AS DATE) AS d FROM y))"""
    o["stream_monthly"] = f"""WITH {ENC}, {latest_enc('e1', f'load_ts < {CUT}')}, {latest_enc('e2', f'load_ts >= {CUT}')},
        staged AS (SELECT * FROM e1 UNION ALL SELECT * FROM e2 WHERE encounter_id NOT IN (SELECT encounter_id FROM e1)), {years},
        fact AS (SELECT *, {DATE_KEY} AS date_key FROM staged)
        SELECT year, month, month_name, {SUMS} FROM fact LEFT JOIN dim_date USING (date_key) GROUP BY 1, 2, 3"""
    o["stream_alert"] = alert

    o["dq_report"] = f"{MARTS.rstrip()}, {CALENDAR} {_checks(_fact_checks())}"
    o["model_tests"] = f"{CURRENT.rstrip()}, {CALENDAR} {_checks(_model_checks())}"
    o["facility_conflicts"] = """SELECT 'N-' || s_nationkey AS facility_id, count(DISTINCT l_suppkey) AS n_rows FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1"""
    o["duplicate_keys"] = "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
    o["range_stats"] = E + f"SELECT count(*) AS n_rows, avg(duration_minutes) AS avg_value FROM enc WHERE {DATE_KEY} BETWEEN 19970101 AND 19970131"
    o["fan_out"] = f"""WITH {ENC}, {latest_enc('e')}, {CALENDAR}, r AS (SELECT date_key, row_number() OVER (ORDER BY date_key) AS rn FROM dim_date),
        k AS (SELECT n, {draw_sql('n', 1, 42, '(SELECT count(*) FROM dim_date)')} + 1 AS rk FROM range(3) t(n))
        SELECT encounter_id || '-' || n AS encounter_id, date_key, duration_minutes FROM e CROSS JOIN k JOIN r ON rn = rk"""
    spans = "WITH s AS (SELECT l_suppkey, min(k) AS low, max(k) AS high FROM (SELECT l_suppkey, CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS k FROM lineitem) GROUP BY 1) "
    o["layout_facts"] = """SELECT 'rows in sorted files' AS fact, count(*) AS value FROM lineitem UNION ALL SELECT 'sorted files share at most an end', 1
        UNION ALL SELECT 'random layout scans all files', 1 UNION ALL SELECT 'sorted layout scans a quarter at most', 1"""
    o["csv_incremental"] = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, sha256(text) AS text_sha256 FROM documents WHERE doc_id > 50"
    o["csv_quoted"] = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, sha256(text) AS text_sha256, CAST(NULL AS VARCHAR) AS none FROM documents"
    o["layout_pruning"] = spans + "SELECT count(*) FILTER (high >= 19950101 AND low <= 19950131) AS scanned, count(*) AS total FROM s"
    o["clustering_depth"] = spans + """SELECT count(*) / (SELECT count(*) FROM s) AS avg_depth, (SELECT count(*) FROM s) AS n_files
        FROM s a JOIN s b ON b.low <= a.high AND a.low <= b.high"""
    o["top_charges"] = f"WITH {ENC}, {latest_enc('e')} SELECT encounter_id, total_charge FROM e ORDER BY total_charge DESC NULLS LAST, encounter_id LIMIT 100"
    o["synth_patients"] = _synth_patients()
    o["synth_encounters"] = _synth_encounters()
    return o
