"""The same queries as SQL on the same tables, for checking."""

from __future__ import annotations

# Fixed values of the checks; none is imported from the code under test.
AS_OF_DATE = "1998-01-01"
SAMPLE_ROWS = 1000

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
TRIP_ID = "md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey))"


def _money(expr: str, decimals: int = 4) -> str:
    """Cents, half away from zero on the decimal value."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30, {decimals})), 2) AS DOUBLE)"


def _mean(expr: str) -> str:
    return _money(expr, 7)


def _row_cents(expr: str) -> str:
    return _money(expr, 10)


def _share(whole: str, part: str = "count(*)") -> str:
    return _row_cents(f"CAST({part} AS DOUBLE) * 100 / {whole}")


_PRICE = "l_extendedprice"
RAW = f"""raw AS (
    SELECT
        o_orderdate + to_minutes(CAST(l_partkey % 1440 AS BIGINT)) AS tpep_pickup_datetime,
        o_orderdate + to_minutes(CAST(l_partkey % 1440 + l_linenumber * 10 + l_quantity - 12 AS BIGINT))
            AS tpep_dropoff_datetime,
        CAST(l_partkey % 6 AS BIGINT) AS passenger_count,
        l_quantity - 1 AS trip_distance,
        CAST(l_suppkey AS INT) AS "PULocationID",
        CAST(l_partkey % 265 AS INT) AS "DOLocationID",
        CAST(CASE WHEN l_tax >= 0.08 THEN 9 ELSE l_linenumber - 1 END AS BIGINT) AS payment_type,
        {_PRICE} - 10000 AS fare_amount,
        {_PRICE} * l_discount AS tip_amount,
        {_PRICE} * l_tax AS tolls_amount,
        ({_PRICE} - 10000) + {_PRICE} * l_discount + {_PRICE} * l_tax AS total_amount,
        {KEY}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

RENAMED_COLS = """tpep_pickup_datetime AS pickup_datetime,
        tpep_dropoff_datetime AS dropoff_datetime,
        passenger_count,
        trip_distance,
        "PULocationID" AS pickup_location_id,
        "DOLocationID" AS dropoff_location_id,
        payment_type,
        fare_amount,
        tip_amount,
        tolls_amount,
        total_amount"""

TIP_PCT = _row_cents("tip_amount / fare_amount * 100")
MINUTES = "epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60"
CALENDAR = """CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour,
        dayname(tpep_pickup_datetime) AS pickup_day,
        CAST(month(tpep_pickup_datetime) AS INT) AS pickup_month"""

CLEAN = f"""{RAW}, clean AS (
    SELECT
        {RENAMED_COLS},
        {TIP_PCT} AS tip_pct,
        {MINUTES} AS duration_minutes,
        {CALENDAR},
        {KEY}, {TRIP_ID} AS trip_id
    FROM raw
    WHERE fare_amount > 0
      AND trip_distance >= 0
      AND tpep_pickup_datetime <= tpep_dropoff_datetime
      AND payment_type BETWEEN 0 AND 6
      AND NOT (trip_distance = 0 AND fare_amount <= 0)
      AND month(tpep_pickup_datetime) IN (1, 2)
)"""
CLEAN_COLS = f"* EXCLUDE ({KEY}, trip_id)"


# Payment labels, tip and fare buckets.
LABEL = """CASE payment_type WHEN 0 THEN 'flex_fare' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'cash'
        WHEN 3 THEN 'no_charge' WHEN 4 THEN 'dispute' WHEN 5 THEN 'unknown' WHEN 6 THEN 'voided' END"""
TIP_BUCKET = """CASE WHEN tip_amount = 0 THEN 'No tip' WHEN tip_amount / fare_amount < 0.1 THEN 'Under 10%'
        WHEN tip_amount / fare_amount < 0.2 THEN '10-20%' WHEN tip_amount / fare_amount < 0.3 THEN '20-30%'
        ELSE 'Over 30%' END"""
FARE_BUCKET = """CASE WHEN fare_amount <= 0 THEN 'zero/negative' WHEN fare_amount < 5 THEN 'under $5'
        WHEN fare_amount < 20 THEN '$5-$20' ELSE 'over $20' END"""
# What the audit counts.
AUDIT = """count(*) FILTER (WHERE fare_amount <= 0) AS bad_fare,
    count(*) FILTER (WHERE payment_type NOT BETWEEN 1 AND 4) AS bad_payment,
    count(*) FILTER (WHERE trip_distance = 0 AND fare_amount <= 0) AS zero_dist_zero_fare,
    count(*) FILTER (WHERE tpep_pickup_datetime > tpep_dropoff_datetime) AS bad_timestamps,
    count(*) FILTER (WHERE month(tpep_pickup_datetime) NOT IN (1, 2)) AS wrong_month"""
DROPPED = """fare_amount <= 0 OR payment_type NOT BETWEEN 1 AND 4 OR (trip_distance = 0 AND fare_amount <= 0)
    OR tpep_pickup_datetime > tpep_dropoff_datetime OR month(tpep_pickup_datetime) NOT IN (1, 2)"""

STG = f"""{CLEAN}, stg AS (
    SELECT * EXCLUDE ({KEY}, trip_id, payment_type), {LABEL} AS payment_method FROM clean
)"""

DAILY = f"""{STG}, daily AS (
    SELECT
        CAST(date_trunc('day', pickup_datetime) AS TIMESTAMP) AS trip_date,
        pickup_month,
        pickup_day,
        count(*) AS total_trips,
        {_money("sum(fare_amount)")} AS total_fare,
        {_money("sum(tip_amount)")} AS total_tips,
        {_money("sum(total_amount)")} AS total_revenue,
        {_mean("avg(fare_amount)")} AS avg_fare,
        {_mean("avg(trip_distance)")} AS avg_distance,
        {_mean("avg(duration_minutes)")} AS avg_duration_mins,
        {_mean("sum(tip_amount) / nullif(sum(fare_amount), 0) * 100")} AS overall_tip_pct
    FROM stg
    GROUP BY 1, 2, 3
)"""

SUMMARY = f"""{STG}, summary AS (
    SELECT
        pickup_month,
        payment_method,
        count(*) AS total_trips,
        {_money("sum(fare_amount)")} AS total_fare,
        {_mean("avg(tip_amount)")} AS avg_tip,
        {_mean("avg(tip_amount) / nullif(avg(fare_amount), 0) * 100")} AS avg_tip_pct,
        {_share("sum(count(*)) OVER (PARTITION BY pickup_month)")} AS pct_of_monthly_trips
    FROM stg
    GROUP BY 1, 2
)"""

TABLE_COLS = """trip_id,
    CAST(pickup_datetime AS VARCHAR) AS pickup_datetime,
    CAST(dropoff_datetime AS VARCHAR) AS dropoff_datetime,
    pickup_location_id,
    dropoff_location_id,
    CAST(passenger_count AS INT) AS passenger_count,
    fare_amount,
    tip_amount,
    CAST(payment_type AS INT) AS payment_type,
    trip_distance"""

EVENTS = """trips AS (
    SELECT
        CASE event_type WHEN 'view' THEN 'trip_started' WHEN 'purchase' THEN 'trip_ended'
            ELSE event_type END AS kind,
        CAST(user_id AS VARCHAR) AS trip_id,
        CASE WHEN event_type = 'view' THEN CAST(ts AS VARCHAR) END AS pickup_datetime,
        CASE WHEN event_type = 'purchase' THEN CAST(ts AS VARCHAR) END AS dropoff_datetime,
        CASE WHEN event_type = 'view' THEN CAST(event_id % 265 AS INT) END AS pickup_location_id,
        CASE WHEN event_type = 'purchase' THEN CAST(event_id % 263 AS INT) END AS dropoff_location_id,
        CASE WHEN event_type = 'view' THEN CAST(event_id % 6 AS INT) END AS passenger_count,
        CASE WHEN event_type = 'purchase' THEN value END AS fare_amount,
        CASE WHEN event_type = 'purchase' THEN value / 4 END AS tip_amount,
        CASE WHEN event_type = 'purchase' THEN CAST(event_id % 7 AS INT) END AS payment_type,
        CASE WHEN event_type = 'purchase' THEN value / 2 END AS trip_distance,
        ts, event_id
    FROM events
)"""
EVENT_COLS = """trip_id, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
    passenger_count, fare_amount, tip_amount, payment_type, trip_distance"""

_LAG = "lag({0}) OVER (PARTITION BY trip_id ORDER BY event_id) AS prev_{0}"
PAIRED = f"""{EVENTS}, seen AS (
    SELECT *, {_LAG.format("kind")}, {_LAG.format("ts")}, {_LAG.format("pickup_datetime")},
        {_LAG.format("pickup_location_id")}, {_LAG.format("passenger_count")},
        lead(kind) OVER (PARTITION BY trip_id ORDER BY event_id) IS NULL AS is_last
    FROM trips WHERE kind IN ('trip_started', 'trip_ended')
)"""
COMPLETED = """SELECT trip_id, prev_pickup_datetime AS pickup_datetime, dropoff_datetime,
    prev_pickup_location_id AS pickup_location_id, dropoff_location_id,
    prev_passenger_count AS passenger_count, fare_amount, tip_amount, payment_type, trip_distance
FROM seen WHERE kind = 'trip_ended' AND prev_kind = 'trip_started'"""
ORPHANS = """SELECT trip_id, dropoff_datetime, fare_amount, tip_amount, payment_type, trip_distance,
    'missing_trip_started' AS reason
FROM seen WHERE kind = 'trip_ended' AND prev_kind IS DISTINCT FROM 'trip_started'"""
PAIRS = f"""WITH {PAIRED}
SELECT *, NULL AS reason, 'completed' AS kind FROM ({COMPLETED})
UNION ALL BY NAME SELECT *, 'orphan' AS kind FROM ({ORPHANS})"""
HEALTH = f"""WITH {PAIRED}
SELECT
    count(*) FILTER (WHERE kind = 'trip_ended' AND prev_kind = 'trip_started') AS completed_trips,
    count(*) FILTER (WHERE kind = 'trip_ended' AND prev_kind IS DISTINCT FROM 'trip_started')
        AS orphaned_ends,
    count(*) FILTER (WHERE kind = 'trip_started' AND is_last) AS unmatched_starts
FROM seen"""
INTERVAL = f"""WITH {EVENTS}
SELECT s.trip_id, s.pickup_datetime, e.dropoff_datetime, s.pickup_location_id,
    e.dropoff_location_id, s.passenger_count, e.fare_amount, e.tip_amount, e.payment_type,
    e.trip_distance
FROM trips s JOIN trips e
  ON s.trip_id = e.trip_id AND s.kind = 'trip_started' AND e.kind = 'trip_ended'
 AND e.ts BETWEEN s.ts AND s.ts + INTERVAL 2 HOUR"""
EVENT_HALVES = f"""WITH {CLEAN}
SELECT 'trip_started' AS event_type, trip_id, CAST(pickup_datetime AS VARCHAR) AS pickup_datetime,
    NULL::VARCHAR AS dropoff_datetime, pickup_location_id, NULL::INT AS dropoff_location_id,
    CAST(passenger_count AS INT) AS passenger_count, NULL::DOUBLE AS fare_amount,
    NULL::DOUBLE AS tip_amount, NULL::INT AS payment_type, NULL::DOUBLE AS trip_distance
FROM clean
UNION ALL
SELECT 'trip_ended', trip_id, NULL, CAST(dropoff_datetime AS VARCHAR), NULL, dropoff_location_id,
    NULL, fare_amount, tip_amount, CAST(payment_type AS INT), trip_distance
FROM clean"""

CHUNKS = r"""words AS (
    SELECT doc_id, source, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS words FROM documents
), cuts AS (
    SELECT doc_id, source, words, unnest(range(0, len(words), 450)) AS low FROM words
), chunks AS (
    SELECT doc_id, source, CAST(low / 450 AS INT) AS chunk_index,
        array_to_string(words[low + 1:low + 500], ' ') AS text,
        CAST(len(words[low + 1:low + 500]) AS INT) AS token_count
    FROM cuts
)"""

TOPK = """means AS (
    SELECT label, pos, avg(CAST(embedding[pos] AS DOUBLE)) AS x
    FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
    GROUP BY 1, 2
), questions AS (
    SELECT label AS query_id, list(x ORDER BY pos) AS q FROM means GROUP BY 1
), scored AS (
    SELECT query_id, vec_id AS id, 'label_' || label AS source,
        CAST(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])) AS DECIMAL(20, 12)) AS exact,
        CAST(round(exact, 6) AS DOUBLE) AS score
    FROM questions, embeddings
), top AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY exact DESC, id) AS INT) AS rank,
        id, score, source
    FROM scored
    QUALIFY rank <= 5
)"""
# every chunk and question as slots with counts; the score is the cosine of the counts
SEARCH = f"""{CHUNKS}, chunk_slots AS (
    SELECT doc_id || '-' || chunk_index AS id, ('0x' || substr(md5(word), 1, 8))::BIGINT % 384 AS slot, count(*) AS n
    FROM (SELECT doc_id, chunk_index, unnest(string_split(lower(text), ' ')) AS word FROM chunks) GROUP BY ALL
), question_slots AS (
    SELECT item_id, ('0x' || substr(md5(word), 1, 8))::BIGINT % 384 AS slot, count(*) AS n
    FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[^ \\t\\n\\x0B\\f\\r]+')) AS word FROM benchmark) GROUP BY ALL
), chunk_norms AS (SELECT id, sqrt(sum(n * n)) AS norm FROM chunk_slots GROUP BY id),
question_norms AS (SELECT item_id, sqrt(sum(n * n)) AS norm FROM question_slots GROUP BY item_id),
products AS (
    SELECT item_id, id, sum(q.n * c.n) AS product FROM question_slots q JOIN chunk_slots c USING (slot) GROUP BY ALL
), likeness AS (
    SELECT item_id AS query_id, id, CAST(product / (q.norm * c.norm) AS DECIMAL(20, 12)) AS exact
    FROM products JOIN chunk_norms c USING (id) JOIN question_norms q USING (item_id)
), found AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY exact DESC, id) AS INT) AS rank, id,
        CAST(round(exact, 6) AS DOUBLE) AS score
    FROM likeness QUALIFY rank <= 5
), searched AS (
    SELECT query_id, rank, id, score, source, chunk_index, token_count, text
    FROM found JOIN chunks ON id = doc_id || '-' || chunk_index
)"""
CONTEXTS = f"""{SEARCH}, contexts AS (
    SELECT query_id, string_agg('[Source ' || rank || ': ' || source || ' (similarity: '
        || CAST(CAST(round(CAST(score AS DECIMAL(18, 6)), 3) AS DECIMAL(18, 3)) AS VARCHAR) || ')]' || chr(10)
        || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context
    FROM searched GROUP BY query_id
)"""
ANSWERS = r"""pairs AS (
    SELECT u.conv_id, u.turn + 1 AS turn, lower(coalesce(a.text, '')) AS answer,
        regexp_extract_all(lower(u.text), '[^ \t\n\x0B\f\r]+') AS words
    FROM conversations u LEFT JOIN conversations a
      ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
    WHERE u.role = 'user'
), judged AS (
    SELECT conv_id, turn, list_filter(words, lambda w: NOT contains(answer, w)) AS missing,
        list_filter(words, lambda w: contains(answer, w)) AS found
    FROM pairs
)"""


# Bounds that make some rows of the given tables fail.
DAILY_BAD = """total_trips < 5 OR total_trips > 40 OR total_revenue < 200000 OR total_revenue > 2500000
    OR avg_fare < 30000 OR avg_fare > 60000"""
PAYMENT_BAD = """(payment_method = 'credit_card' AND (total_trips < 700 OR total_trips > 100000))
    OR (payment_method = 'flex_fare' AND (total_trips < 0 OR total_trips > 900))
    OR (payment_method = 'cash' AND (total_trips < 600 OR total_trips > 10000))"""

NOT_NULL_TESTS = """SELECT 'not_null_pickup_datetime' AS test, count(*) AS failures FROM stg WHERE pickup_datetime IS NULL
UNION ALL SELECT 'not_null_dropoff_datetime', count(*) FROM stg WHERE dropoff_datetime IS NULL
UNION ALL SELECT 'not_null_fare_amount', count(*) FROM stg WHERE fare_amount IS NULL
UNION ALL SELECT 'not_null_trip_distance', count(*) FROM stg WHERE trip_distance IS NULL
UNION ALL SELECT 'not_null_payment_method', count(*) FROM stg WHERE payment_method IS NULL"""
SUITE = f"""WITH {DAILY}, {SUMMARY[len(STG) + 2:]}, results AS (
{NOT_NULL_TESTS}
UNION ALL
SELECT 'accepted_values_payment_method', count(DISTINCT payment_method) FROM stg
WHERE payment_method NOT IN
    ('flex_fare', 'credit_card', 'cash', 'no_charge', 'dispute', 'unknown', 'voided')
UNION ALL
SELECT 'accepted_values_pickup_month', count(DISTINCT pickup_month) FROM stg
WHERE pickup_month NOT IN (1, 2)
UNION ALL
SELECT 'daily_revenue_reasonable', count(*) FROM daily WHERE {DAILY_BAD}
UNION ALL
SELECT 'no_future_trips', count(*) FROM daily WHERE trip_date > DATE '{AS_OF_DATE}'
UNION ALL
SELECT 'payment_distribution_reasonable', count(*) FROM summary WHERE {PAYMENT_BAD}
)
SELECT test, failures, failures = 0 AS passed FROM results"""
# The bounds of the models themselves.
PRODUCTION_FAILING = """(SELECT count(*) FROM daily
    WHERE total_trips < 20000 OR total_trips > 184000 OR total_revenue < 600000 OR total_revenue > 5900000
       OR avg_fare < 15 OR avg_fare > 32)"""
PAYMENT_FAILING = """(SELECT count(*) FROM summary
    WHERE (payment_method = 'credit_card' AND (total_trips < 1640000 OR total_trips > 2700000))
       OR (payment_method = 'flex_fare' AND (total_trips < 818000 OR total_trips > 1305000))
       OR (payment_method = 'cash' AND (total_trips < 213000 OR total_trips > 365000)))"""

TYPE_NAMES = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
    WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'VARCHAR' THEN 'string' END"""


def _by_payment(source: str) -> str:
    return f"""SELECT payment_type, count(*) AS total_trips,
    {_money("sum(fare_amount)")} AS total_revenue, {_mean("avg(fare_amount)")} AS avg_fare
FROM {source} GROUP BY 1"""


def all_oracles() -> dict[str, str]:
    return {
        # sources
        "scan_raw": "SELECT * FROM lineitem",
        "raw_trip_rows": f"WITH {RAW} SELECT * FROM raw",
        "scan_partitioned": f"""WITH {CLEAN}
SELECT pickup_month, count(*) AS total_rows FROM clean GROUP BY 1""",
        "describe_schema": f"""SELECT column_name AS "column", {TYPE_NAMES} AS type
FROM (DESCRIBE WITH {RAW} SELECT * FROM raw)""",
        "row_count": f"WITH {RAW} SELECT count(*) AS total_rows FROM raw",
        "stream_json_source": f"""WITH {EVENTS}, sent AS (SELECT *, kind = 'error' AS malformed FROM trips)
SELECT
    CASE WHEN NOT malformed THEN kind END AS event_type,
    CASE WHEN NOT malformed THEN trip_id END AS trip_id,
    {EVENT_COLS.replace("trip_id, ", "")}, malformed
FROM sent""",
        "table_scan_versioned": f"WITH {CLEAN} SELECT {TABLE_COLS} FROM clean",
        "doc_load": "SELECT doc_id, length(text) AS n_chars, md5(text) AS text_md5 FROM documents",
        "catalog_register": f"""WITH {CLEAN}
SELECT change[1] AS "column", change[2] AS change, (SELECT count(*) FROM clean) AS total_rows
FROM (SELECT unnest([['tip_pct', 'added'], ['pickup_hour', 'missing']]) AS change)""",
        # sinks and table writes
        "sink_partitioned": f"WITH {CLEAN} SELECT {CLEAN_COLS} FROM clean",
        "materialize": f"WITH {SUMMARY} SELECT * FROM summary",
        "stream_kv_sink": f"""WITH {EVENTS}
SELECT trip_id AS key, CAST(CASE kind WHEN 'trip_started' THEN to_json({{'event_type': kind, 'trip_id': trip_id,
    'pickup_datetime': pickup_datetime, 'pickup_location_id': pickup_location_id, 'passenger_count': passenger_count}})
    ELSE to_json({{'event_type': kind, 'trip_id': trip_id, 'dropoff_datetime': dropoff_datetime,
    'dropoff_location_id': dropoff_location_id, 'fare_amount': fare_amount, 'tip_amount': tip_amount,
    'payment_type': payment_type, 'trip_distance': trip_distance}}) END AS VARCHAR) AS value,
    CAST(row_number() OVER (PARTITION BY trip_id ORDER BY event_id) AS INT) AS nth
FROM trips WHERE kind IN ('trip_started', 'trip_ended')""",
        "stream_print_sink": f"""WITH {EVENTS}
SELECT count(*) AS rows_printed FROM trips WHERE kind = 'trip_started'""",
        "stream_batch_sink": PAIRS,
        "table_create": f"WITH {CLEAN} SELECT count(*) AS total_rows FROM clean",
        "table_append": f"""WITH {CLEAN}
SELECT CAST(payment_type AS INT) AS payment_type, count(*) AS total_trips,
    CAST(2 AS BIGINT) AS latest_snapshot
FROM clean GROUP BY 1""",
        "table_history": f"""WITH {CLEAN}
SELECT CAST(pickup_month AS BIGINT) AS snapshot_id, count(*) AS row_count FROM clean GROUP BY 1""",
        "time_travel": f"WITH {CLEAN} SELECT {TABLE_COLS} FROM clean WHERE pickup_month = 1",
        "snapshot_compare": f"""WITH {CLEAN}
SELECT CAST(n AS BIGINT) AS snapshot_id, count(*) AS total_rows
FROM clean JOIN (SELECT unnest([1, 2]) AS n) ON pickup_month <= n GROUP BY 1""",
        "vector_collection_replace": """SELECT count(*) AS points,
    CAST(max(len(embedding)) AS INT) AS dim, 'cosine' AS metric FROM embeddings""",
        "vector_upsert": """WITH lowest AS (
    SELECT label, min(vec_id) AS low, list_reverse(arg_min(embedding, vec_id)) AS vector FROM embeddings GROUP BY label
), new AS (
    SELECT unnest([low, -low - 1]) AS id, 'new_' || label AS source, label, vector FROM lowest
), points AS (
    SELECT * FROM new
    UNION ALL SELECT vec_id, 'label_' || label, label, embedding FROM embeddings WHERE vec_id NOT IN (SELECT id FROM new)
)
SELECT id, source, label, CAST(len(vector) AS INT) AS dim,
    round(list_reduce(list_transform(vector, lambda x, i: x::DOUBLE * i), lambda s, x: s + x, 0.0::DOUBLE), 6) AS weighed
FROM points""",
        "clustered_topk": f"WITH {TOPK} SELECT * FROM top",
        # projections
        "rename_project": f"WITH {RAW} SELECT {RENAMED_COLS} FROM raw",
        "derive_tip_pct": f"WITH {RAW} SELECT {KEY}, {TIP_PCT} AS tip_pct FROM raw WHERE fare_amount > 0",
        "derive_duration": f"WITH {RAW} SELECT {KEY}, {MINUTES} AS duration_minutes FROM raw",
        "derive_calendar": f"WITH {RAW} SELECT {KEY}, {CALENDAR} FROM raw",
        "label_payment": f"WITH {RAW} SELECT {KEY}, payment_type, {LABEL} AS payment_method FROM raw",
        "stg_trips": f"WITH {STG} SELECT * FROM stg",
        "bucket_tip": f"""WITH {RAW}
SELECT {KEY}, {TIP_BUCKET} AS tip_bucket FROM raw WHERE fare_amount > 0""",
        "bucket_fare": f"""WITH {RAW}
SELECT {KEY}, {FARE_BUCKET} AS fare_bucket FROM raw""",
        "cast_table_schema": f"""WITH {RAW}, renamed AS (
    SELECT {RENAMED_COLS.replace("passenger_count", "trip_distance / 2 AS passenger_count")},
        {TRIP_ID} AS trip_id FROM raw)
SELECT {TABLE_COLS} FROM renamed""",
        "ts_to_string": "SELECT event_id, CAST(ts AS VARCHAR) AS ts_text FROM events",
        "gen_id": f"""WITH {RAW}
SELECT {TRIP_ID} AS trip_key, CAST(length(CAST(uuid() AS VARCHAR)) AS INT) AS uuid_length FROM raw""",
        "json_encode": f"""WITH {CLEAN}
SELECT trip_id, CAST(to_json({{'trip_id': trip_id,
    'pickup_datetime': strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S.%g'),
    'pickup_location_id': pickup_location_id, 'passenger_count': passenger_count}}) AS VARCHAR) AS value
FROM clean""",
        "json_decode": f"SELECT *, false AS malformed FROM ({EVENT_HALVES})",
        "null_guard_ratio": f"""WITH {RAW}
SELECT "PULocationID", trip_distance,
    {_mean("sum(tip_amount) / nullif(sum(trip_distance), 0) * 100")} AS tip_per_distance
FROM raw GROUP BY 1, 2""",
        "trunc_day": "SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events",
        "text_preview": "SELECT doc_id, substring(text, 1, 100) AS preview FROM documents",
        # filters
        "clean_trips": f"WITH {CLEAN} SELECT {CLEAN_COLS} FROM clean",
        "clean_preview": f"""WITH {RAW}
SELECT count(*) AS clean_rows, {_mean("avg(fare_amount)")} AS avg_fare,
    {_mean("avg(trip_distance)")} AS avg_distance
FROM raw
WHERE fare_amount > 0 AND trip_distance >= 0 AND tpep_pickup_datetime <= tpep_dropoff_datetime
  AND payment_type BETWEEN 1 AND 4 AND NOT (trip_distance = 0 AND fare_amount <= 0)""",
        "partition_filter": f"""WITH {CLEAN}
SELECT pickup_datetime, pickup_location_id, fare_amount, trip_distance FROM clean WHERE pickup_month = 1""",
        "predicate_forms": f"""WITH {RAW}
SELECT
    count(*) FILTER (WHERE fare_amount > 0) AS gt,
    count(*) FILTER (WHERE trip_distance >= 0) AS ge,
    count(*) FILTER (WHERE tpep_pickup_datetime <= tpep_dropoff_datetime) AS le,
    count(*) FILTER (WHERE trip_distance = 0) AS eq,
    count(*) FILTER (WHERE payment_type BETWEEN 1 AND 4) AS in_between,
    count(*) FILTER (WHERE payment_type NOT BETWEEN 1 AND 4) AS not_between,
    count(*) FILTER (WHERE month(tpep_pickup_datetime) IN (1, 2)) AS in_list,
    count(*) FILTER (WHERE month(tpep_pickup_datetime) NOT IN (1, 2)) AS not_in_list,
    count(*) FILTER (WHERE NOT (trip_distance = 0 AND fare_amount <= 0)) AS not_both,
    count(*) FILTER (WHERE trip_distance = 0 OR fare_amount <= 0) AS either
FROM raw""",
        # aggregations
        "basic_stats": f"""WITH {RAW}
SELECT count(*) AS total_trips, {_mean("avg(trip_distance)")} AS avg_distance_miles,
    {_mean("avg(fare_amount)")} AS avg_fare, {_mean("avg(tip_amount)")} AS avg_tip,
    min(tpep_pickup_datetime) AS earliest_trip, max(tpep_pickup_datetime) AS latest_trip
FROM raw""",
        "revenue_by_weekday": f"""WITH {RAW}
SELECT dayname(tpep_pickup_datetime) AS day_of_week, count(*) AS total_trips,
    {_money("sum(fare_amount)")} AS total_revenue, {_mean("avg(fare_amount)")} AS avg_fare
FROM raw GROUP BY 1 ORDER BY total_revenue DESC""",
        "busiest_hours": f"""WITH {RAW}
SELECT CAST(hour(tpep_pickup_datetime) AS INT) AS pickup_hour, count(*) AS total_trips,
    {_mean("avg(fare_amount)")} AS avg_fare
FROM raw WHERE fare_amount > 0 GROUP BY 1 ORDER BY total_trips DESC""",
        "revenue_by_payment_raw": f"""WITH {RAW}
SELECT payment_type, count(*) AS total_trips, {_money("sum(fare_amount)")} AS total_revenue
FROM raw GROUP BY 1 ORDER BY total_revenue DESC""",
        "tip_distribution": f"""WITH {RAW}
SELECT {TIP_BUCKET} AS tip_bucket,
    count(*) AS total_trips,
    {_share("sum(count(*)) OVER ()")} AS pct_of_trips
FROM raw WHERE fare_amount > 0 AND tip_amount >= 0 GROUP BY 1""",
        "quality_counts": f"""WITH {RAW}
SELECT count(*) AS total_rows,
    count(*) FILTER (WHERE fare_amount <= 0) AS negative_or_zero_fare,
    count(*) FILTER (WHERE trip_distance = 0) AS zero_distance,
    count(*) FILTER (WHERE tpep_pickup_datetime > tpep_dropoff_datetime) AS dropoff_before_pickup,
    count(*) FILTER (WHERE passenger_count = 0) AS zero_passengers
FROM raw""",
        "zero_distance_by_payment": f"""WITH {RAW}
SELECT payment_type, {_mean("avg(fare_amount)")} AS avg_fare, {_mean("avg(tip_amount)")} AS avg_tip,
    count(*) AS trip_count
FROM raw WHERE trip_distance = 0 AND fare_amount > 0 GROUP BY 1""",
        "zero_distance_fares": f"""WITH {RAW}
SELECT {FARE_BUCKET} AS fare_bucket, count(*) AS trip_count
FROM raw WHERE trip_distance = 0 GROUP BY 1""",
        "quality_audit": f"""WITH {RAW}
SELECT count(*) AS total_raw, {AUDIT},
    count(*) FILTER (WHERE {DROPPED}) AS total_dropped
FROM raw""",
        "daily_revenue": f"WITH {DAILY} SELECT * FROM daily ORDER BY trip_date",
        "payment_summary": f"WITH {SUMMARY} SELECT * FROM summary ORDER BY pickup_month, total_trips DESC",
        "lake_revenue_by_payment": f"""WITH {CLEAN}
{_by_payment("(SELECT CAST(payment_type AS INT) AS payment_type, fare_amount FROM clean)")}""",
        "health_report": HEALTH,
        "chunk_stats": f"""WITH {CHUNKS}
SELECT doc_id, count(*) AS chunks, CAST(sum(token_count) AS BIGINT) AS total_tokens,
    CAST(floor(sum(token_count) / count(*)) AS BIGINT) AS avg_tokens
FROM chunks GROUP BY 1""",
        "chunk_totals": f"""WITH {CHUNKS}
SELECT doc_id, grouping_id(doc_id) > 0 AS is_total, count(*) AS chunks, CAST(sum(token_count) AS BIGINT) AS total_tokens,
    CAST(floor(sum(token_count) / count(*)) AS BIGINT) AS avg_tokens
FROM chunks GROUP BY GROUPING SETS ((doc_id), ())""",
        # shares and order
        "pct_of_total": f"""WITH {RAW}
SELECT "PULocationID", count(*) AS total_trips,
    {_share("sum(count(*)) OVER ()")} AS pct_of_trips
FROM raw GROUP BY 1""",
        "pct_of_group": f"""WITH {STG}
SELECT pickup_day, payment_method, count(*) AS total_trips,
    {_share("sum(count(*)) OVER (PARTITION BY pickup_day)")} AS pct_of_day
FROM stg GROUP BY 1, 2""",
        "order_single": f"""WITH {RAW}
SELECT "PULocationID", count(*) AS total_trips FROM raw GROUP BY 1 ORDER BY 2 DESC, 1""",
        "order_multi": f"""WITH {STG}
SELECT pickup_month, pickup_hour, count(*) AS total_trips FROM stg GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2""",
        "lake_top_pickups": f"""WITH {CLEAN}
SELECT pickup_location_id, count(*) AS total_trips, {_mean("avg(fare_amount)")} AS avg_fare
FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
        "top_pickups": f"""WITH {CLEAN}
SELECT pickup_location_id, count(*) AS total_trips, {_mean("avg(fare_amount)")} AS avg_fare
FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
        "sample_limit": f"""WITH {CLEAN}
SELECT * EXCLUDE (trip_id) FROM clean ORDER BY pickup_datetime, {KEY} LIMIT {SAMPLE_ROWS}""",
        # joins and pairing
        "explode_trip_events": EVENT_HALVES,
        "interval_join": INTERVAL,
        "pair_latest_start": f"WITH {PAIRED} {COMPLETED}",
        "orphan_ends": f"WITH {PAIRED} {ORPHANS}",
        "unmatched_starts": f"""WITH {PAIRED}
SELECT trip_id, event_id AS arrival, pickup_datetime, pickup_location_id, passenger_count
FROM seen WHERE kind = 'trip_started' AND is_last""",
        # streaming
        "stream_interval_join": INTERVAL,
        "stream_unmatched": f"""WITH {EVENTS}, mark AS (
    SELECT max(ts) - INTERVAL 10 MINUTE AS passed FROM trips)
SELECT trip_id, pickup_datetime, pickup_location_id, passenger_count
FROM trips s, mark
WHERE kind = 'trip_started' AND ts + INTERVAL 2 HOUR < passed AND NOT EXISTS (
    SELECT 1 FROM trips e WHERE e.kind = 'trip_ended' AND e.trip_id = s.trip_id
       AND e.ts BETWEEN s.ts AND s.ts + INTERVAL 2 HOUR)""",
        "stream_pairing": PAIRS,
        "stream_pairing_partitions": PAIRS,
        "stream_pairing_sliced": PAIRS,
        "stream_state_ttl": f"""WITH {PAIRED}
SELECT *, NULL AS reason, 'completed' AS kind FROM ({COMPLETED} AND ts <= prev_ts + INTERVAL 2 HOUR)
UNION ALL BY NAME SELECT *, 'orphan' AS kind
FROM ({ORPHANS} OR (kind = 'trip_ended' AND ts > prev_ts + INTERVAL 2 HOUR))
UNION ALL BY NAME SELECT trip_id, pickup_datetime, pickup_location_id, passenger_count, 'expired' AS kind
FROM seen WHERE kind = 'trip_started' AND is_last AND ts + INTERVAL 2 HOUR < (SELECT max(ts) FROM seen)
UNION ALL BY NAME SELECT trip_id, prev_pickup_datetime AS pickup_datetime, prev_pickup_location_id AS pickup_location_id,
    prev_passenger_count AS passenger_count, 'expired' AS kind
FROM seen WHERE prev_kind = 'trip_started' AND ts > prev_ts + INTERVAL 2 HOUR""",
        "stream_health": HEALTH,
        # data tests and the chain
        "test_not_null": f"""WITH {RAW}
SELECT {KEY}, payment_type FROM (SELECT *, {LABEL} AS payment_method FROM raw)
WHERE payment_method IS NULL""",
        "test_accepted_values": f"""WITH {RAW}
SELECT CAST(month(tpep_pickup_datetime) AS INT) AS value_field, count(*) AS n_records
FROM raw WHERE month(tpep_pickup_datetime) NOT IN (1, 2) GROUP BY 1""",
        "test_daily_bounds": f"""WITH {DAILY}
SELECT trip_date, total_trips, total_revenue, avg_fare FROM daily WHERE {DAILY_BAD}""",
        "test_no_future": f"""WITH {DAILY}
SELECT trip_date, total_trips FROM daily WHERE trip_date > DATE '{AS_OF_DATE}'""",
        "test_payment_bounds": f"""WITH {SUMMARY}
SELECT pickup_month, payment_method, total_trips FROM summary WHERE {PAYMENT_BAD}""",
        "test_suite": SUITE,
        "run_chain": f"""WITH {DAILY}, {SUMMARY[len(STG) + 2:]}
SELECT 'clean_trips' AS step, count(*) AS row_count FROM clean
UNION ALL SELECT 'stg_trips', count(*) FROM stg
UNION ALL SELECT 'daily_revenue', count(*) FROM daily
UNION ALL SELECT 'payment_summary', count(*) FROM summary
UNION ALL SELECT 'tests', CAST({PRODUCTION_FAILING} > 0 AS BIGINT)
    + CAST({PAYMENT_FAILING} > 0 AS BIGINT)
    + CAST((SELECT count(*) FROM daily WHERE trip_date > CURRENT_DATE) > 0 AS BIGINT)""",
        # retrieval
        "chunk_docs": f"WITH {CHUNKS} SELECT * FROM chunks",
        "embed_batch": f"WITH {CHUNKS} SELECT doc_id, chunk_index, 384 AS dim, 1.0::DOUBLE AS norm FROM chunks",
        "embed_slots": f"""WITH {CHUNKS}, slots AS (
    SELECT doc_id, chunk_index, ('0x' || substr(md5(word), 1, 8))::BIGINT % 384 AS slot, count(*) AS n
    FROM (SELECT doc_id, chunk_index, unnest(string_split(lower(text), ' ')) AS word FROM chunks) GROUP BY ALL
)
SELECT doc_id, chunk_index, 384 AS dim, sum(n)::BIGINT AS words, sum(n * (slot + 1))::BIGINT AS weighed,
    sum(n * n)::BIGINT AS squares
FROM slots GROUP BY ALL""",
        "vector_topk": f"WITH {TOPK} SELECT * FROM top",
        "search": f"WITH {SEARCH} SELECT * FROM searched",
        "build_context": f"WITH {CONTEXTS} SELECT * FROM contexts",
        "build_prompt": f"""WITH {CONTEXTS}
SELECT item_id AS query_id, concat_ws(chr(10),
    'You are a helpful data analyst assistant with expertise in NYC taxi data.',
    'Answer the question based on the context provided below.',
    'If the answer is not in the context, say so clearly.',
    '', 'Context:', coalesce(context, ''), '',
    'Question: ' || text, '', 'Answer:') AS prompt
FROM benchmark LEFT JOIN contexts ON query_id = item_id""",
        "recall_at_k": f"""WITH {TOPK}, hits AS (
    SELECT query_id, bool_or(source = 'label_' || query_id) AS hit FROM top GROUP BY 1)
SELECT count(*) FILTER (WHERE hit) AS correct, count(*) AS total,
    {_share("count(*)", "count(*) FILTER (WHERE hit)")} AS recall_pct
FROM hits""",
        "eval_report": f"""WITH {TOPK}
SELECT query_id, 'label_' || query_id AS expected_source,
    bool_or(source = 'label_' || query_id) AS hit, min_by(source, rank) AS top_source,
    max(score) AS top_score, string_agg(source, ',' ORDER BY rank) AS sources
FROM top GROUP BY 1""",
        "answer_keywords": f"""WITH {ANSWERS}
SELECT conv_id, turn, len(missing) = 0 AS all_found, coalesce(array_to_string(missing, ' '), '') AS missing,
    coalesce(array_to_string(found, ' '), '') AS found
FROM judged""",
        "answer_accuracy": f"""WITH {ANSWERS}
SELECT count(*) FILTER (WHERE len(missing) = 0) AS correct, count(*) AS total,
    {_share("count(*)", "count(*) FILTER (WHERE len(missing) = 0)")} AS accuracy_pct
FROM judged""",
    }
