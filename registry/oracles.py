"""DuckDB SQL for the registered queries, written from the rules, not from the Spark code."""

from __future__ import annotations

from registry import views

_PEOPLE_VIEW = views.PEOPLE.format(customer="customer", nation="nation")
_EVENTS_VIEW = views.EVENTS.format(events="events", millis=views.DUCKDB_MILLIS)
_RUN_LOG_VIEW = views.RUN_LOG.format(events="events")

PERSON = "id, name, email, age, city, status, createdAt"
EVENT = f"{PERSON}, eventTime"

# Value expressions


def trim(c: str) -> str:
    return rf"regexp_replace({c}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def full(c: str, pattern: str) -> str:
    return f"regexp_full_match({c}, '{pattern}')"


SUSPENDED = "Suspended[^:]*:[^:]+:*"
_GROUP = r"\+?0*[0-7]?[0-9A-Fa-f]{1,15}"
UUID = "-".join([_GROUP] * 5)
EMAIL = r"[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
INSTANT = r"[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{0,9})?([Zz]|[+-][0-9]{2}:[0-9]{2})"

ID_ERROR = f"""CASE WHEN id IS NULL THEN 'Missing id'
  WHEN NOT (length(id) <= 36 AND {full('id', UUID)}) THEN concat('Invalid UUID: ', id) END"""
EMAIL_ERROR = f"""CASE WHEN email IS NULL THEN 'Missing email'
  WHEN NOT {full('email', EMAIL)} THEN concat('Invalid email format: ', email) END"""
AGE_ERROR = """CASE WHEN age IS NULL THEN 'Missing age' WHEN age < 0 OR age >= 150
  THEN concat('Invalid age: ', CAST(age AS VARCHAR), ' (must be between 0 and 150)') END"""
CITY_ERROR = f"""CASE WHEN city IS NULL THEN 'Missing city'
  WHEN length({trim('city')}) NOT BETWEEN 1 AND 100 THEN concat('Invalid city: ''', city, '''') END"""
STATUS_ERROR = f"""CASE WHEN status IS NULL THEN 'Missing status'
  WHEN status IN ('Active', 'Inactive', 'Pending') OR {full('status', SUSPENDED)} THEN NULL
  WHEN starts_with(status, 'Suspended') THEN concat('Invalid suspended format: ', status)
  ELSE concat('Unknown status: ', status) END"""
TIME_ERROR = f"""CASE WHEN createdAt IS NULL THEN 'Missing createdAt'
  WHEN NOT {full('createdAt', INSTANT)} OR try_cast(createdAt AS TIMESTAMPTZ) IS NULL
  THEN concat('Invalid timestamp: ', createdAt) END"""

RECORD_RULES = {
    "id": ID_ERROR,
    "email": EMAIL_ERROR,
    "age": AGE_ERROR,
    "city": CITY_ERROR,
    "status": STATUS_ERROR,
    "createdAt": TIME_ERROR,
}


def first_error(rules: dict[str, str], prefix: str = "") -> str:
    """`error` and `error_rule` columns."""
    message = f"coalesce({', '.join(rules.values())})"
    if prefix:
        message = f"'{prefix}' || {message}"
    names = " ".join(f"WHEN ({e}) IS NOT NULL THEN '{n}'" for n, e in rules.items())
    return f"{message} AS error, CASE {names} END AS error_rule"


def _id_group(i: int, width: int) -> str:
    part = f"list_extract(string_split(lower(replace(id, '+', '')), '-'), {i})"
    return f"right(concat('{'0' * width}', {part}), {width})"


CANONICAL_ID = " || '-' || ".join(
    _id_group(i + 1, w) for i, w in enumerate((8, 4, 4, 4, 12))
)
REASON = f"CASE WHEN {full('status', SUSPENDED)} THEN list_extract(string_split(status, ':'), 2) END"
CANONICAL_STATUS = f"coalesce('Suspended:' || ({REASON}), status)"
_US = "epoch_us(CAST(createdAt AS TIMESTAMPTZ))"
CANONICAL_TIME = f"""strftime(make_timestamp({_US}), '%Y-%m-%dT%H:%M:%S') ||
  CASE WHEN {_US} % 1000000 = 0 THEN ''
       WHEN {_US} % 1000 = 0 THEN '.' || lpad(CAST({_US} % 1000000 // 1000 AS VARCHAR), 3, '0')
       ELSE '.' || lpad(CAST({_US} % 1000000 AS VARCHAR), 6, '0') END || 'Z'"""
NORMAL_CITY = f"upper(substring(lower({trim('city')}), 1, 1)) || substring(lower({trim('city')}), 2)"
AGE_GROUP = """CASE WHEN age < 18 THEN 'Minor' WHEN age < 30 THEN 'Young Adult' WHEN age < 50 THEN 'Adult'
  WHEN age < 65 THEN 'Middle Age' ELSE 'Senior' END"""
DOMAIN_2 = "list_extract(string_split(email, '@'), 2)"
LAST_DOMAIN = """CASE WHEN regexp_full_match(email, '@+') THEN 'unknown'
  ELSE list_extract(string_split(rtrim(email, '@'), '@'), -1) END"""


def one_decimal(x: str) -> str:
    """Half-up on the shortest decimal text of the double, as the JVM formats it."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(30, 17)), 1) AS DECIMAL(20, 1))"


def share(part: str, total: str) -> str:
    ratio = f"CAST({part} AS DOUBLE) / CAST({total} AS DOUBLE) * 100"
    return f"CAST({one_decimal(ratio)} AS VARCHAR) || '%'"


# Common table expressions

PEOPLE = f"people AS ({_PEOPLE_VIEW})"
CHECKED = f"{PEOPLE}, checked AS (SELECT *, {first_error(RECORD_RULES)} FROM people)"
READABLE = f"""{CHECKED}, readable AS (
  SELECT c_custkey, {CANONICAL_ID} AS id, name, email, age, {trim('city')} AS city,
    {CANONICAL_STATUS} AS status, {CANONICAL_TIME} AS createdAt
  FROM checked WHERE error IS NULL)"""
BUSINESS = {
    "name": f"CASE WHEN {trim('name')} = '' THEN concat('Empty name for person ', id) END",
    "negative_age": "CASE WHEN age < 0 THEN concat('Negative age for ', name) END",
}
# Decoding adds the malformed line and the missing name to the record rules.
DECODE_RULES = {
    "json": "CASE WHEN broken THEN 'malformed JSON' END",
    "id": ID_ERROR,
    "name": "CASE WHEN name IS NULL THEN 'Missing name' END",
} | {k: v for k, v in RECORD_RULES.items() if k != "id"}
PARSED = f"""{PEOPLE},
lines AS (
  SELECT c_custkey % 97 = 0 AS broken,
    {', '.join(f'CASE WHEN c_custkey % 97 <> 0 THEN {c} END AS {c}' for c in PERSON.split(', '))}
  FROM people WHERE c_custkey % 97 = 0 OR c_custkey % 101 <> 0),
decoded AS (SELECT *, {first_error(DECODE_RULES, 'Parse error: ')} FROM lines),
parsed AS (
  SELECT
    CASE WHEN error IS NULL THEN {CANONICAL_ID} ELSE id END AS id, name, email, age,
    CASE WHEN error IS NULL THEN {trim('city')} ELSE city END AS city,
    CASE WHEN error IS NULL THEN {CANONICAL_STATUS} ELSE status END AS status,
    CASE WHEN error IS NULL THEN {CANONICAL_TIME} ELSE createdAt END AS createdAt,
    error, error_rule
  FROM decoded)"""
PROCESSED = f"""{PARSED},
ruled AS (
  SELECT {PERSON}, coalesce(error, {', '.join(BUSINESS.values())}) AS error,
    coalesce(error_rule, CASE WHEN ({BUSINESS['name']}) IS NOT NULL THEN 'name'
      WHEN ({BUSINESS['negative_age']}) IS NOT NULL THEN 'negative_age' END) AS error_rule
  FROM parsed),
processed AS (
  SELECT id, CASE WHEN error IS NULL THEN {trim('name')} ELSE name END AS name, email, age,
    CASE WHEN error IS NULL THEN {NORMAL_CITY} ELSE city END AS city, status, createdAt,
    error, error_rule
  FROM ruled)"""

EVENTS = f"people_events AS ({_EVENTS_VIEW})"
DT = "strftime(make_timestamp(eventTime * 1000), '%Y-%m-%d')"
HOUR = "strftime(make_timestamp(eventTime * 1000), '%H')"
# A message is complete when its JSON is whole and no field is null.
COMPLETE = "NOT broken AND name IS NOT NULL AND id IS NOT NULL AND eventTime IS NOT NULL"
DECODE_OUTCOME = """CASE WHEN broken THEN 'Parse error: malformed JSON'
  WHEN name IS NULL THEN 'Missing name' END AS error,
  CASE WHEN broken THEN 'json' WHEN name IS NULL THEN 'name' END AS error_rule"""
_HOUR_START = "make_timestamp(eventTime * 1000 - (eventTime * 1000) % 3600000000)"


def hourly(source: str, where: str = "TRUE") -> str:
    return f"""SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS events,
  round(avg(age), 6) AS avg_age, round(stddev_samp(age), 6) AS stddev_age
FROM (SELECT *, {_HOUR_START} AS window_start FROM {source} WHERE {where}) GROUP BY window_start"""


def report(source: str) -> str:
    """The report's figures, one SELECT per section."""
    none = "CAST(NULL AS DOUBLE) AS avg_age, CAST(NULL AS INT) AS min_age, CAST(NULL AS INT) AS max_age"
    no_share = "CAST(NULL AS VARCHAR) AS percentage"
    average = f"CAST({one_decimal('sum(age) / CAST(count(*) AS DOUBLE)')} AS DOUBLE)"
    return f"""
SELECT 'total' AS section, CAST(NULL AS VARCHAR) AS key, count(*) AS count, {none}, {no_share} FROM {source}
UNION ALL SELECT 'city', city, count(*), {average}, min(age), max(age), NULL FROM {source} GROUP BY city
UNION ALL SELECT 'age_group', g, count(*), NULL, NULL, NULL,
  {share('count(*)', f'(SELECT count(*) FROM {source})')} FROM (SELECT {AGE_GROUP} AS g FROM {source}) GROUP BY g
UNION ALL SELECT 'status', status, count(*), NULL, NULL, NULL, NULL FROM {source} GROUP BY status
UNION ALL SELECT 'domain', d, count(*), NULL, NULL, NULL, NULL
  FROM (SELECT {LAST_DOMAIN} AS d FROM {source}) GROUP BY d"""


_CITY = f"""SELECT city, count(*) AS total_people,
  CAST({one_decimal('sum(age) / CAST(count(*) AS DOUBLE)')} AS DOUBLE) AS avg_age,
  min(age) AS min_age, max(age) AS max_age"""
_STATS = """count(*) AS total, count(*) FILTER (error IS NULL) AS successful,
  count(*) FILTER (error IS NOT NULL) AS failed,
  CASE WHEN count(*) = 0 THEN 0.0
       ELSE round(count(*) FILTER (error IS NULL) / CAST(count(*) AS DOUBLE) * 100, 6) END AS success_rate"""


def _hash_id(seed: str) -> str:
    h = f"md5({seed})"
    return (
        f"concat(substring({h}, 1, 8), '-', substring({h}, 9, 4), '-4', substring({h}, 14, 3), "
        f"'-a', substring({h}, 18, 3), '-', substring({h}, 21, 12))"
    )


EVENT_JSON = """concat('{"id":"', id, '","name":',
  CASE WHEN name IS NULL THEN 'null' ELSE concat('"', name, '"') END, ',"email":"', email, '","age":',
  CAST(age AS VARCHAR), ',"city":"', city, '","status":"', status, '","createdAt":"', createdAt,
  '","eventTime":', CAST(eventTime AS VARCHAR), '}')"""
CREATE_RULES = {k: RECORD_RULES[k] for k in ("email", "age", "city")}
MIXED = f"""{READABLE}, {EVENTS},
mixed AS (
  SELECT {PERSON}, CAST(NULL AS BIGINT) AS eventTime,
    CASE WHEN starts_with(createdAt, '2024') THEN substring(createdAt, 1, 10) ELSE '1970-01-01' END AS dt,
    CAST(NULL AS VARCHAR) AS hour FROM people
  UNION ALL SELECT {EVENT}, {DT}, {HOUR} FROM people_events)"""
_MIXED_READABLE = f"SELECT count(*) FROM (SELECT {first_error(RECORD_RULES)} FROM mixed) WHERE error IS NULL"

ORACLES: dict[str, str] = {
    "city_statistics": f"""WITH {PEOPLE} SELECT city, count(*) AS total_people, round(avg(age), 6) AS avg_age,
  min(age) AS min_age, max(age) AS max_age, round(stddev_samp(age), 6) AS stddev_age,
  count(DISTINCT status) AS distinct_statuses FROM people GROUP BY city ORDER BY total_people DESC, city""",
    "record_count": f"WITH {PEOPLE} SELECT count(*) AS total_records FROM people",
    "enrich_people": f"""WITH {PEOPLE} SELECT *, {AGE_GROUP} AS age_group, {DOMAIN_2} AS email_domain,
  CAST(length(name) AS INT) AS name_length, status = 'Active' AS is_active FROM people""",
    "sample_people": f"""WITH {PEOPLE} SELECT name, age, city, {AGE_GROUP} AS age_group,
  {DOMAIN_2} AS email_domain FROM people ORDER BY id, name LIMIT 10""",
    "batch_sample": f"""WITH {READABLE} SELECT name, email, age, city, status FROM readable
  ORDER BY id, name LIMIT 5""",
    "city_report": f"WITH {READABLE} {_CITY} FROM readable GROUP BY city ORDER BY total_people DESC, city",
    "age_group_distribution": f"""WITH {READABLE} SELECT age_group, count(*) AS count,
  {share('count(*)', '(SELECT count(*) FROM readable)')} AS percentage
FROM (SELECT {AGE_GROUP} AS age_group FROM readable) GROUP BY age_group""",
    "status_distribution": f"WITH {READABLE} SELECT status, count(*) AS count FROM readable GROUP BY status",
    "domain_distribution": f"""WITH {PEOPLE} SELECT domain, count(*) AS count
FROM (SELECT {LAST_DOMAIN} AS domain FROM people) GROUP BY domain""",
    "batch_profile": f"""WITH {READABLE} SELECT count(*) AS records, count(DISTINCT city) AS unique_cities,
  concat(CAST(min(age) AS VARCHAR), ' - ', CAST(max(age) AS VARCHAR)) AS age_range FROM readable""",
    "combined_report": f"WITH {READABLE} {report('readable')}",
    "report_document": f"WITH {READABLE} {report('readable')}",
    "person_attributes": f"""WITH {PEOPLE} SELECT *, status IN ('Active', 'Pending') AS is_available,
  list_extract(string_split(email, '@'), 1) AS email_username, {DOMAIN_2} AS email_domain,
  age >= 18 AS is_adult, age < 18 AS is_minor,
  CASE WHEN age < 13 THEN 'child' WHEN age < 20 THEN 'teen' WHEN age < 65 THEN 'adult' ELSE 'senior' END
    AS age_category FROM people""",
    "domain_fallback": f"WITH {PEOPLE} SELECT c_custkey, {LAST_DOMAIN} AS domain FROM people",
    "categorize_people": f"""WITH {PEOPLE} SELECT *, CASE WHEN age < 18 THEN 'Minor'
  WHEN age >= 18 AND status = 'Active' THEN 'Active Adult'
  WHEN ({REASON}) IS NOT NULL THEN concat('Suspended: ', {REASON}) ELSE 'Other' END AS category,
  {REASON} AS suspend_reason FROM people""",
    "anonymize_people": f"""WITH {PEOPLE} SELECT c_custkey, id, concat('User-', substring(id, 1, 8)) AS name,
  'anonymous@example.com' AS email, age, city, status, createdAt FROM people""",
    "summarize_people": f"""WITH {PEOPLE} SELECT c_custkey,
  name || ' (' || CAST(age AS VARCHAR) || 'yo, ' || city || ') - ' || {CANONICAL_STATUS} AS summary,
  {CANONICAL_STATUS} AS storage_status FROM people""",
    "set_status": f"""WITH {PEOPLE} SELECT c_custkey, id, name, email, age, city, 'Inactive' AS status,
  createdAt FROM people""",
    "normalize_people": f"""WITH {PEOPLE} SELECT c_custkey, id, {trim('name')} AS name, email, age,
  {NORMAL_CITY} AS city, status, createdAt FROM people""",
    "storage_rows": f"WITH {READABLE} SELECT {PERSON} FROM readable",
    "validate_email": f"WITH {PEOPLE} SELECT c_custkey, {EMAIL_ERROR} AS email_error FROM people",
    "validate_age": f"WITH {PEOPLE} SELECT c_custkey, {AGE_ERROR} AS age_error FROM people",
    "validate_city": f"WITH {PEOPLE} SELECT c_custkey, {CITY_ERROR} AS city_error FROM people",
    "validate_status": f"WITH {PEOPLE} SELECT c_custkey, {STATUS_ERROR} AS status_error FROM people",
    "validate_id_time": f"""WITH {PEOPLE} SELECT c_custkey, {ID_ERROR} AS id_error,
  {TIME_ERROR} AS created_at_error FROM people""",
    "first_error": f"WITH {CHECKED} SELECT c_custkey, error, error_rule FROM checked",
    "business_rules": f"WITH {PEOPLE} SELECT c_custkey, {first_error(BUSINESS)} FROM people",
    "quarantine": f"WITH {CHECKED} SELECT * FROM checked WHERE error IS NOT NULL",
    "rejects": f"""WITH {CHECKED} SELECT error_rule AS rule, count(*) AS rejected FROM checked
  WHERE error IS NOT NULL GROUP BY error_rule""",
    "processing_stats": f"""WITH {CHECKED} SELECT {_STATS},
  (SELECT string_agg(error, ' | ' ORDER BY c_custkey)
   FROM (SELECT c_custkey, error FROM checked WHERE error IS NOT NULL ORDER BY c_custkey LIMIT 3))
    AS sample_errors FROM checked""",
    "lake_validation": f"""WITH {CHECKED} SELECT count(*) FILTER (error IS NULL) AS records_read,
  count(*) FILTER (error IS NULL AND name <> '' AND age >= 0) AS valid,
  count(*) FILTER (error IS NULL AND NOT (name <> '' AND age >= 0)) AS invalid,
  count(*) FILTER (error IS NOT NULL) AS dropped,
  count(*) FILTER (error IS NULL AND name <> '' AND {trim('name')} = '') AS blank_names FROM checked""",
    "create_people": f"""WITH {PEOPLE}, created AS (
  SELECT c_custkey, name, email, age, city, {first_error(CREATE_RULES)} FROM people)
SELECT c_custkey, CASE WHEN error IS NULL THEN {trim('name')} ELSE name END AS name, email, age,
  CASE WHEN error IS NULL THEN {trim('city')} ELSE city END AS city, error, error_rule,
  {_hash_id("concat('c', CAST(c_custkey AS VARCHAR))")} AS id, 'Pending' AS status,
  '2024-01-01T00:00:00Z' AS createdAt FROM created""",
    "generate_people": f"""SELECT {_hash_id("concat('person-', CAST(c_custkey AS VARCHAR))")} AS id,
  concat(list_extract(['Alice', 'Bob', 'Carol', 'David', 'Eve', 'Frank', 'Grace', 'Henry'], c_custkey % 8 + 1),
    ' Smith-', CAST(c_custkey AS VARCHAR)) AS name,
  concat('user', CAST(c_custkey AS VARCHAR), '@',
    list_extract(['example.com', 'test.com', 'demo.org'], c_custkey % 3 + 1)) AS email,
  CAST(18 + c_custkey % 50 AS INT) AS age,
  list_extract(['San Francisco', 'New York', 'Seattle', 'Austin', 'Boston', 'Chicago'], c_custkey % 6 + 1) AS city,
  'Pending' AS status, '2024-01-01T00:00:00Z' AS createdAt FROM customer""",
    "parse_json_people": f"WITH {PARSED} SELECT {PERSON}, error, error_rule FROM parsed",
    "preprocess_people": f"""WITH {PROCESSED} SELECT {PERSON}, error, error_rule,
  CASE WHEN error IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome FROM processed""",
    "check_json_people": f"WITH {PROCESSED} SELECT {_STATS} FROM processed",
    "revalidate_people": f"WITH {READABLE} SELECT {PERSON} FROM readable",
    "people_round_trip": f"WITH {READABLE} SELECT {PERSON} FROM readable",
    "json_lines_round_trip": f"WITH {READABLE} SELECT {PERSON}, CAST(NULL AS VARCHAR) AS error FROM readable",
    "publish_from_file": f"""WITH {PARSED} SELECT {PERSON}, CAST(1704067200000 AS BIGINT) AS eventTime,
  (SELECT count(*) FROM parsed WHERE error IS NULL) AS published, CAST(0 AS BIGINT) AS failed,
  (SELECT count(*) FROM parsed WHERE error IS NOT NULL) AS dropped FROM parsed WHERE error IS NULL""",
    "lake_scan": f"WITH {EVENTS} SELECT {EVENT}, {DT} AS dt, {HOUR} AS hour FROM people_events",
    "land_batch": f"""WITH {READABLE}, {EVENTS} SELECT {EVENT}, {DT} AS dt, {HOUR} AS hour FROM people_events
UNION ALL SELECT {PERSON}, 1704067200000, '2024-01-01', '00' FROM readable""",
    "recursive_scan": f"WITH {MIXED} SELECT {EVENT}, dt, hour FROM mixed",
    "union_layouts": f"""WITH {PEOPLE}, {EVENTS}
SELECT {PERSON}, '2024-01-01' AS dt, CAST(NULL AS BIGINT) AS eventTime, CAST(NULL AS VARCHAR) AS hour FROM people
UNION ALL SELECT {PERSON}, {DT}, eventTime, {HOUR} FROM people_events""",
    "run_history_totals": f"""WITH {MIXED}
SELECT ({_MIXED_READABLE}) AS last_total, ({_MIXED_READABLE}) AS records""",
    "file_running_total": """SELECT CAST(c_custkey AS VARCHAR) AS path, coalesce(n, 0) AS records,
  CAST(sum(coalesce(n, 0)) OVER (ORDER BY c_nationkey, CAST(c_custkey AS VARCHAR)
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_total,
  c_custkey * 100 // 1024 AS size_kb
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "run_log_summary": f"""WITH log AS ({_RUN_LOG_VIEW}) SELECT count(*) AS total,
  count(*) FILTER (status = 'COMPLETED') AS completed, count(*) FILTER (status = 'FAILED') AS failed,
  count(*) FILTER (status = 'RUNNING') AS running, count(*) FILTER (status = 'PENDING') AS pending,
  CAST(sum(duration) AS BIGINT) AS total_duration, CAST(sum(records_processed) AS BIGINT) AS total_records,
  CAST(sum(records_failed) AS BIGINT) AS total_failed FROM log""",
    "event_records": f"""WITH {EVENTS} SELECT id AS key, {EVENT},
  CASE WHEN name IS NULL THEN 'Missing name' END AS error, CASE WHEN name IS NULL THEN 'name' END AS error_rule
FROM people_events""",
    "event_messages": f"WITH {EVENTS} SELECT id AS key, {EVENT_JSON} AS value FROM people_events",
    "publish_outcomes": f"""WITH {EVENTS}, outcome AS (SELECT CASE WHEN id LIKE '%0' THEN 'No key or no value'
  WHEN broken THEN 'Not an object' WHEN strlen({EVENT_JSON}) > 254 THEN 'Too large' END AS error FROM people_events)
SELECT error, count(*) AS messages, (SELECT count(*) FROM outcome WHERE error IS NULL) AS success,
  (SELECT count(*) FROM outcome WHERE error IS NOT NULL) AS failure FROM outcome GROUP BY error""",
    "event_bytes": f"""WITH {EVENTS} SELECT event_id, id, name, email, CAST(age AS VARCHAR) AS age, city, status,
  createdAt, CAST(eventTime AS VARCHAR) AS eventTime FROM people_events""",
    "decode_outcomes": f"""WITH {EVENTS} SELECT error, error_rule, count(*) AS messages
FROM (SELECT {DECODE_OUTCOME} FROM people_events) GROUP BY error, error_rule""",
    "event_partitions": f"""WITH {EVENTS} SELECT event_id, make_timestamp(eventTime * 1000) AS event_ts,
  {DT} AS dt, {HOUR} AS hour FROM people_events""",
    "hourly_window": f"WITH {EVENTS} {hourly('people_events')}",
    "lambda_merge": f"""WITH {EVENTS}, keyed AS (
  SELECT event_id, age, {DT} AS dt, {HOUR} AS hour FROM people_events)
SELECT *, CASE WHEN concat(dt, hour) < '2024-01-1512' THEN 'batch' ELSE 'speed' END AS layer FROM keyed""",
    "stream_to_lake": f"""WITH {EVENTS} SELECT {EVENT}, {DT} AS dt, {HOUR} AS hour,
  (SELECT count(*) FROM people_events WHERE NOT ({COMPLETE})) AS rejected
FROM people_events WHERE {COMPLETE}""",
    "stream_two_topics": f"""WITH {EVENTS} SELECT {DT} AS dt, {HOUR} AS hour, 2 * count(*) AS events
FROM people_events WHERE {COMPLETE} GROUP BY ALL""",
    "stream_and_land": f"""WITH {READABLE}, {EVENTS} SELECT {EVENT}, {DT} AS dt, {HOUR} AS hour FROM people_events
WHERE {COMPLETE} UNION ALL SELECT {PERSON}, 1704067200000, '2024-01-01', '00' FROM readable""",
    "stream_restart": f"""WITH {EVENTS} SELECT {EVENT}, {DT} AS dt, {HOUR} AS hour FROM people_events WHERE {COMPLETE}""",
    "stream_late_events": f"WITH {EVENTS} {hourly('people_events', COMPLETE)}",
    "stream_closed_hours": f"""WITH {EVENTS}, complete AS (
  SELECT age, eventTime, {_HOUR_START} AS window_start, eventTime < 1704499200000 AND age % 10 = 0 AS late
  FROM people_events WHERE {COMPLETE})
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) FILTER (NOT late) AS events,
  round(avg(age) FILTER (NOT late), 6) AS avg_age, round(stddev_samp(age) FILTER (NOT late), 6) AS stddev_age,
  count(*) FILTER (late) AS late
FROM complete GROUP BY window_start
HAVING count(*) FILTER (NOT late) > 0
  AND epoch_ms(window_start) + 3600000 <= (SELECT max(eventTime) - 10000 FROM complete)""",
    "stream_quarantine": f"""WITH {EVENTS} SELECT error, error_rule, count(*) AS messages
FROM (SELECT {DECODE_OUTCOME} FROM people_events) WHERE error IS NOT NULL GROUP BY error, error_rule""",
    "stream_validation": f"""WITH {EVENTS}, outcome AS (
  SELECT coalesce(decode_rule, CASE WHEN age >= 150 THEN 'age' WHEN status = 'Gone' THEN 'status' END) AS error_rule
  FROM (SELECT age, status, CASE WHEN broken THEN 'json' WHEN name IS NULL THEN 'name' END AS decode_rule
        FROM people_events))
SELECT CASE WHEN error_rule IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, error_rule,
  count(*) AS messages FROM outcome GROUP BY error_rule""",
    "stream_hourly": f"WITH {EVENTS} {hourly('people_events', COMPLETE)}",
    "lake_inventory": f"""WITH {EVENTS} SELECT count(DISTINCT {DT} || {HOUR}) AS files, true AS has_bytes, true AS size_agrees
FROM people_events""",
    "run_history": f"""WITH {EVENTS}, rows AS (SELECT *, {DT} AS dt, {HOUR} AS hour FROM people_events)
SELECT dt, hour, count(*) FILTER (error IS NULL) AS records, true AS covered
FROM (SELECT *, {first_error(RECORD_RULES)} FROM rows) GROUP BY dt, hour""",
    "run_history_refreshed": f"""WITH {EVENTS}, rows AS (SELECT *, {DT} AS dt, {HOUR} AS hour FROM people_events),
checked AS (SELECT *, {first_error(RECORD_RULES)} FROM rows),
history AS (SELECT dt, hour,
  count(*) FILTER (error IS NULL) + count(*) FILTER (error IS NULL AND age > 50) AS records FROM checked GROUP BY dt, hour)
SELECT *, (SELECT CAST(sum(records) AS BIGINT) FROM history) AS last_total, true AS new_files_only FROM history""",
    "report_figures": f"""WITH {READABLE}, sited AS (
  SELECT *, age % 7 AS site, {AGE_GROUP} AS g, {LAST_DOMAIN} AS d FROM readable)
SELECT site, 'total' AS section, CAST(NULL AS VARCHAR) AS key, count(*) AS count, CAST(NULL AS INT) AS min_age,
  CAST(NULL AS INT) AS max_age FROM sited GROUP BY site
UNION ALL SELECT site, 'city', city, count(*), min(age), max(age) FROM sited GROUP BY site, city
UNION ALL SELECT site, 'age_group', g, count(*), NULL, NULL FROM sited GROUP BY site, g
UNION ALL SELECT site, 'status', status, count(*), NULL, NULL FROM sited GROUP BY site, status
UNION ALL SELECT site, 'domain', d, count(*), NULL, NULL FROM sited GROUP BY site, d""",
    "lake_evolved": f"""WITH {EVENTS}, keyed AS (SELECT {EVENT}, {DT} AS dt, {HOUR} AS hour FROM people_events)
SELECT *, CAST(NULL AS VARCHAR) AS country FROM keyed UNION ALL SELECT *, 'of ' || city FROM keyed WHERE age > 50""",
    "lake_compacted": f"""WITH {EVENTS} SELECT {EVENT}, {DT} AS dt, {HOUR} AS hour, true AS keeps_batch, true AS packed
FROM people_events""",
    "lambda_statistics": f"""WITH {EVENTS} SELECT city, count(*) AS total_people, round(avg(age), 6) AS avg_age,
  min(age) AS min_age, max(age) AS max_age, round(stddev_samp(age), 6) AS stddev_age,
  count(DISTINCT status) AS distinct_statuses FROM people_events WHERE {COMPLETE} GROUP BY city""",
    "lake_merged": f"""WITH {EVENTS}, keyed AS (SELECT {EVENT}, {DT} AS dt, {HOUR} AS hour FROM people_events)
SELECT *, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS BIGINT) AS visits FROM keyed
UNION ALL SELECT keyed.*, 'of ' || city, age FROM keyed, range(2) WHERE age > 50""",
    "recursive_scan_days": f"WITH {MIXED} SELECT {EVENT}, dt, hour FROM mixed WHERE dt BETWEEN '2024-01-03' AND '2024-01-04'",
    "city_report_raw": f"""WITH {PEOPLE} SELECT city, count(*) AS total_people,
  CAST({one_decimal('sum(age) / CAST(count(age) AS DOUBLE)')} AS DOUBLE) AS avg_age,
  min(age) AS min_age, max(age) AS max_age FROM people GROUP BY city""",
    "statistics_round_trip": f"""WITH {PEOPLE} SELECT city, count(*) AS total_people, round(avg(age), 6) AS avg_age,
  min(age) AS min_age, max(age) AS max_age, round(stddev_samp(age), 6) AS stddev_age,
  count(DISTINCT status) AS distinct_statuses FROM people GROUP BY city""",
    "spec_on_orders": """SELECT o_orderkey,
  CASE WHEN o_custkey % 7 = 0 THEN concat('Bad customer ', o_custkey) WHEN o_totalprice < 1000 THEN 'Too cheap' END AS error,
  CASE WHEN o_custkey % 7 = 0 THEN 'customer' WHEN o_totalprice < 1000 THEN 'price' END AS error_rule FROM orders""",
    "spec_on_order_lines": """WITH fields AS (SELECT o_orderkey, o_orderkey % 29 = 0 AS bad,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN '1.5' ELSE CAST(o_custkey AS VARCHAR) END AS customer,
  CASE WHEN o_orderkey % 13 = 0 THEN 'dear' ELSE CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) END AS price,
  CASE WHEN o_orderkey % 23 = 0 THEN '1995-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders),
typed AS (SELECT *, CASE WHEN NOT bad AND customer <> '1.5' THEN CAST(customer AS BIGINT) END AS o_custkey,
  CASE WHEN NOT bad THEN TRY_CAST(price AS DECIMAL(18, 2)) END AS amount,
  CASE WHEN NOT bad AND day <> '1995-02-30' THEN day END AS o_orderdate FROM fields),
ruled AS (SELECT *, CASE WHEN bad THEN 'json' WHEN customer IS NULL OR customer = '1.5' THEN 'o_custkey'
  WHEN price = 'dear' THEN 'o_totalprice' WHEN day = '1995-02-30' THEN 'o_orderdate' WHEN amount < 1000 THEN 'price' END AS error_rule
  FROM typed)
SELECT o_orderkey, o_custkey, CAST(CASE WHEN error_rule IS NULL THEN amount * 2 ELSE amount END AS DOUBLE) AS o_totalprice,
  o_orderdate, error_rule, CASE error_rule WHEN 'json' THEN 'Parse error: malformed JSON'
    WHEN 'o_custkey' THEN concat('Parse error: ', CASE WHEN customer IS NULL THEN 'Missing o_custkey' ELSE 'Invalid o_custkey: 1.5' END)
    WHEN 'o_totalprice' THEN 'Parse error: Invalid o_totalprice: dear'
    WHEN 'o_orderdate' THEN 'Parse error: Invalid o_orderdate: 1995-02-30' WHEN 'price' THEN 'Too cheap' END AS error FROM ruled""",
    "success_gate": f"""WITH {CHECKED}, rate AS (SELECT 100.0 * count(*) FILTER (error IS NULL) / count(*) AS rate FROM checked)
SELECT CAST(n AS INT) AS minimum, rate >= n AS passes FROM rate, unnest([25, 50, 95]) AS t(n)""",
}
