"""The SQL each query is compared with, written for DuckDB and on its own terms:
whole-number arithmetic for money, and left join plus union where the library joins fully.
"""

from __future__ import annotations

import hashlib

RAW = """raw AS (
  SELECT
    'RES' || CAST(100000 + l_orderkey // 20 AS VARCHAR) AS reservation_id,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_tax < 0.025 THEN 'P0'
         ELSE 'P' || CAST(1 + l_suppkey // 10 AS VARCHAR) END AS property_code,
    CASE WHEN l_orderkey % 89 <> 0 THEN 'CNF' || CAST(l_orderkey AS VARCHAR) END
      AS confirmation_number,
    'GUEST' || CAST(l_partkey AS VARCHAR) AS guest_id,
    CASE WHEN l_orderkey % 83 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN 'unknown'
         ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS arrival_date,
    CASE WHEN l_orderkey % 79 = 0 THEN NULL
         WHEN l_partkey % 53 = 0 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR)
         ELSE CAST(CAST(l_shipdate AS DATE) + l_linenumber AS VARCHAR) END AS departure_date,
    ['STD', 'DLX', 'STE', 'KING', 'QUEEN'][l_partkey % 5 + 1] AS room_type,
    ['BAR', 'CORP', 'MEMBER', 'PKG', 'PREPAY'][l_suppkey % 5 + 1] AS rate_plan_code,
    ['BAR', 'CORP', 'MEMBER', 'PKG', 'PREPAY'][l_suppkey % 5 + 1]
      || CASE WHEN l_partkey % 2 = 0 THEN '_STD' ELSE '_DLX' END AS price_plan_code,
    CASE WHEN l_orderkey % 73 = 0 THEN NULL WHEN l_orderkey % 71 = 0 THEN 'HOLD'
         WHEN l_returnflag = 'A' THEN 'BOOKED' WHEN l_returnflag = 'N' THEN 'MODIFIED'
         ELSE 'CANCELLED' END AS booking_status,
    CASE WHEN l_partkey % 59 = 0 THEN '0' WHEN l_partkey % 67 = 0 THEN 'two'
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS room_count,
    CASE WHEN l_partkey % 61 = 0
           THEN '-' || CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR)
         WHEN l_partkey % 71 = 0 THEN NULL
         ELSE CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) END AS total_revenue,
    'INR' AS currency,
    strftime(l_shipdate - INTERVAL 30 DAY - to_seconds(l_partkey), '%Y-%m-%d %H:%M:%S')
      AS created_ts,
    strftime(l_shipdate - INTERVAL 30 DAY - to_seconds(l_partkey)
             + to_minutes(l_suppkey % 181), '%Y-%m-%d %H:%M:%S') AS updated_ts
  FROM lineitem)"""

BRONZE = (
    RAW
    + """, bronze AS (
  SELECT *, '2026-05-11' AS business_date, '2026-05-11 01:00:00' AS bronze_ingestion_ts,
         'dummy_reservation_generator' AS source_system
  FROM raw)"""
)

_RULES = """WHEN property_code IS NULL THEN 'PROPERTY_CODE_NULL'
         WHEN confirmation_number IS NULL THEN 'CONFIRMATION_NUMBER_NULL'
         WHEN arrival_date IS NULL THEN 'ARRIVAL_DATE_NULL'
         WHEN departure_date IS NULL THEN 'DEPARTURE_DATE_NULL'
         WHEN TRY_CAST(arrival_date AS DATE) >= TRY_CAST(departure_date AS DATE)
           THEN 'INVALID_STAY_DATES'
         WHEN TRY_CAST(room_count AS DOUBLE) <= 0 THEN 'INVALID_ROOM_COUNT'
         WHEN TRY_CAST(total_revenue AS DOUBLE) < 0 THEN 'NEGATIVE_REVENUE'
         WHEN booking_status NOT IN ('BOOKED', 'CANCELLED', 'MODIFIED')
           THEN 'INVALID_BOOKING_STATUS'"""

_STRICT = """WHEN TRY_CAST(arrival_date AS DATE) IS NULL THEN 'ARRIVAL_DATE_UNREADABLE'
         WHEN TRY_CAST(departure_date AS DATE) IS NULL THEN 'DEPARTURE_DATE_UNREADABLE'
         WHEN TRY_CAST(room_count AS DOUBLE) IS NULL THEN 'ROOM_COUNT_MISSING'
         WHEN TRY_CAST(total_revenue AS DOUBLE) IS NULL THEN 'REVENUE_MISSING'
         WHEN booking_status IS NULL THEN 'BOOKING_STATUS_NULL'"""

_GUEST = "CAST(guest_id[6:] AS BIGINT)"

CHECKED = (
    BRONZE
    + f""", checked AS (
  SELECT *, CASE {_RULES} END AS validation_reason FROM bronze)"""
)

SILVER = (
    CHECKED
    + """, silver AS (
  SELECT reservation_id, property_code, confirmation_number, guest_id,
         TRY_CAST(arrival_date AS DATE) AS arrival_date,
         TRY_CAST(departure_date AS DATE) AS departure_date,
         room_type, rate_plan_code, price_plan_code, booking_status,
         CAST(TRY_CAST(room_count AS DOUBLE) AS INTEGER) AS room_count,
         TRY_CAST(total_revenue AS DOUBLE) AS total_revenue,
         CAST(TRY_CAST(total_revenue AS DECIMAL(18, 2)) * 100 AS HUGEINT) AS cents,
         currency, created_ts, updated_ts, business_date, bronze_ingestion_ts, source_system,
         '2026-05-11 02:00:00' AS silver_ingestion_ts
  FROM checked WHERE validation_reason IS NULL)"""
)

STAYS = (
    SILVER
    + """, stays AS (
  SELECT *, departure_date - arrival_date AS stay_nights
  FROM silver
  WHERE booking_status <> 'CANCELLED' AND departure_date - arrival_date > 0)"""
)

NIGHTS = (
    STAYS
    + """, nights AS (
  SELECT *, CAST(unnest(range(CAST(arrival_date AS TIMESTAMP), CAST(departure_date AS TIMESTAMP),
                              INTERVAL 1 DAY)) AS DATE) AS stay_date
  FROM stays)"""
)


def _gold(name: str, condition: str = "TRUE") -> str:
    """Money in whole numbers: a night's revenue in units of 10^-13, rounded half up."""
    unit = "100000000000"
    night = f"((2 * cents * {unit} + stay_nights) // (2 * stay_nights))"
    return f""", {name}_sums AS (
  SELECT property_code, stay_date,
         count(DISTINCT reservation_id) AS reservation_count,
         CAST(sum(room_count) AS BIGINT) AS booked_rooms,
         (2 * sum({night}) + {unit}) // (2 * {unit}) AS total_cents
  FROM nights WHERE {condition} GROUP BY property_code, stay_date),
{name} AS (
  SELECT property_code, stay_date, reservation_count, booked_rooms,
         CAST(total_cents AS DOUBLE) / 100 AS total_revenue,
         CAST((2 * total_cents + booked_rooms) // (2 * booked_rooms) AS DOUBLE) / 100 AS adr,
         '2026-05-11 03:00:00' AS gold_ingestion_ts
  FROM {name}_sums)"""


GOLD = NIGHTS + _gold("gold")
TWO_LOADS = (
    NIGHTS
    + _gold("early", "arrival_date < DATE '1999-01-01'")
    + _gold("late", "arrival_date >= DATE '1998-12-01'")
)

_MEASURES = """CAST(reservation_count AS INTEGER) AS reservation_count,
         CAST(booked_rooms AS INTEGER) AS booked_rooms, total_revenue, adr"""


def _staging(run_id: str, gold: str) -> str:
    return f"""SELECT '{run_id}' AS run_id, property_code, stay_date, {_MEASURES},
         '2026-05-11' AS business_date, 'gold_parquet_layer' AS source_system, gold_ingestion_ts
  FROM {gold}"""


STAGED = (
    TWO_LOADS
    + f""", staged AS (
  {_staging("run_one", "early")}
  UNION ALL
  {_staging("run_two", "late")})"""
)

_DAY = "CAST(stay_date AS VARCHAR) AS stay_date"
_STAGED_OUT = f"SELECT * REPLACE ({_DAY}) FROM staged"

_FIRST_AT = "'2026-05-12 04:00:00'"
_SECOND_AT = "'2026-05-13 05:00:00'"

MERGED = (
    STAGED
    + f""", one AS (SELECT * FROM staged WHERE run_id = 'run_one'),
two AS (SELECT * FROM staged WHERE run_id = 'run_two'),
serving AS (
  SELECT two.property_code, two.stay_date, two.reservation_count, two.booked_rooms,
         two.total_revenue, two.adr, two.business_date, two.source_system,
         two.run_id AS last_run_id, two.gold_ingestion_ts,
         CASE WHEN one.run_id IS NULL THEN {_SECOND_AT} ELSE {_FIRST_AT} END AS created_at,
         CASE WHEN one.run_id IS NOT NULL THEN {_SECOND_AT} END AS updated_at
  FROM two LEFT JOIN one USING (property_code, stay_date)
  UNION ALL
  SELECT property_code, stay_date, reservation_count, booked_rooms, total_revenue, adr,
         business_date, source_system, run_id, gold_ingestion_ts, {_FIRST_AT}, NULL
  FROM one
  WHERE NOT EXISTS (SELECT 1 FROM two WHERE two.property_code = one.property_code
                                        AND two.stay_date = one.stay_date))"""
)

UPSERTED = MERGED + """, upserted AS (
  SELECT s.property_code, s.stay_date, s.reservation_count, s.booked_rooms, s.total_revenue, s.adr,
         one.business_date, one.source_system, one.run_id AS last_run_id,
         s.gold_ingestion_ts, s.created_at, s.updated_at
  FROM serving s LEFT JOIN one USING (property_code, stay_date))"""

AUDIT = """audit AS (
  SELECT 'run_' || CAST(o_orderkey AS VARCHAR) AS run_id, o_orderpriority AS job_name,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS business_date,
         CASE o_orderstatus WHEN 'O' THEN 'SUCCESS' WHEN 'F' THEN 'FAILED' ELSE 'RUNNING' END
           AS status,
         CAST(NULL AS BIGINT) AS source_count, CAST(NULL AS BIGINT) AS bronze_count,
         CAST(NULL AS BIGINT) AS silver_count,
         CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS gold_count,
         CAST(NULL AS BIGINT) AS rejected_count, CAST(NULL AS BIGINT) AS staged_count,
         CAST(NULL AS BIGINT) AS merged_count,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS started_at,
         CASE WHEN o_orderstatus <> 'P'
              THEN strftime(CAST(CAST(o_orderdate AS DATE) + 1 AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')
         END AS ended_at,
         CASE WHEN o_orderstatus = 'F' THEN 'it''s broken' END AS error_message
  FROM orders)"""

_AUDIT_AT = "'2026-05-13 06:00:00'"


def _hit(expression: str, column: str) -> str:
    return f"CASE WHEN c.run_id IS NOT NULL THEN {expression} ELSE a.{column} END AS {column}"


_AUDIT_START = f"""WITH {AUDIT}, batch AS (
  SELECT 'run_' || CAST(2 * o_orderkey AS VARCHAR) AS run_id,
         'again ' || o_orderpriority AS job_name,
         CAST(CAST(o_orderdate AS DATE) + 7 AS VARCHAR) AS business_date
  FROM orders)
SELECT a.run_id, a.job_name, a.business_date, {_hit("'RUNNING'", "status")},
       a.source_count, a.bronze_count, a.silver_count, a.gold_count, a.rejected_count,
       a.staged_count, a.merged_count, {_hit(_AUDIT_AT, "started_at")},
       {_hit("NULL", "ended_at")}, {_hit("NULL", "error_message")}
FROM audit a LEFT JOIN batch c ON a.run_id = c.run_id
UNION ALL
SELECT run_id, job_name, business_date, 'RUNNING', NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       {_AUDIT_AT}, NULL, NULL
FROM batch WHERE run_id NOT IN (SELECT run_id FROM audit)"""

_AUDIT_SUCCESS = f"""WITH {AUDIT}, changes AS (
  SELECT 'run_' || CAST(3 * o_orderkey AS VARCHAR) AS run_id, o_custkey FROM orders)
SELECT a.run_id, a.job_name, a.business_date, {_hit("'SUCCESS'", "status")},
       {_hit("NULL", "source_count")}, {_hit("NULL", "bronze_count")},
       {_hit("NULL", "silver_count")}, {_hit("c.o_custkey", "gold_count")},
       {_hit("NULL", "rejected_count")}, {_hit("c.o_custkey", "staged_count")},
       {_hit("c.o_custkey + 1", "merged_count")}, a.started_at, {_hit(_AUDIT_AT, "ended_at")},
       {_hit("NULL", "error_message")}
FROM audit a LEFT JOIN changes c ON a.run_id = c.run_id"""

_AUDIT_FAILURE = f"""WITH {AUDIT}, changes AS (
  SELECT 'run_' || CAST(3 * o_orderkey AS VARCHAR) AS run_id,
         'can''t load ' || o_orderpriority AS problem
  FROM orders)
SELECT a.run_id, a.job_name, a.business_date, {_hit("'FAILED'", "status")},
       a.source_count, a.bronze_count, a.silver_count, a.gold_count, a.rejected_count,
       a.staged_count, a.merged_count, a.started_at, {_hit(_AUDIT_AT, "ended_at")},
       {_hit("c.problem", "error_message")}
FROM audit a LEFT JOIN changes c ON a.run_id = c.run_id"""

_AUDIT_LOG = """WITH events AS (
  SELECT 'run_' || CAST(o_custkey AS VARCHAR) AS run_id, o_orderstatus AS kind,
         o_orderkey, o_orderpriority, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS place
  FROM orders),
places AS (
  SELECT run_id, min(place) FILTER (kind = 'O') AS entered,
         max(place) FILTER (kind = 'O') AS started, max(place) AS last
  FROM events GROUP BY run_id),
ends AS (
  SELECT events.run_id, max(place) AS finished
  FROM events JOIN places USING (run_id)
  WHERE kind = 'F' AND place > entered GROUP BY events.run_id)
SELECT p.run_id, e.o_orderpriority AS job_name,
       CAST(CAST(e.o_orderdate AS DATE) AS VARCHAR) AS business_date,
       CASE l.kind WHEN 'O' THEN 'RUNNING' WHEN 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       CAST(NULL AS BIGINT) AS source_count, CAST(NULL AS BIGINT) AS bronze_count,
       CAST(NULL AS BIGINT) AS silver_count, f.o_orderkey AS gold_count,
       CAST(NULL AS BIGINT) AS rejected_count,
       CASE WHEN f.o_orderkey % 3 > 0 THEN f.o_orderkey + 1 END AS staged_count,
       CAST(NULL AS BIGINT) AS merged_count,
       strftime(s.o_orderdate, '%Y-%m-%d %H:%M:%S') AS started_at,
       CASE WHEN l.kind <> 'O' THEN strftime(l.o_orderdate, '%Y-%m-%d %H:%M:%S') END AS ended_at,
       CASE WHEN l.kind = 'P' THEN 'it''s ' || l.o_orderpriority END AS error_message
FROM places p
JOIN events e ON e.run_id = p.run_id AND e.place = p.entered
JOIN events s ON s.run_id = p.run_id AND s.place = p.started
JOIN events l ON l.run_id = p.run_id AND l.place = p.last
LEFT JOIN ends ON ends.run_id = p.run_id
LEFT JOIN events f ON f.run_id = p.run_id AND f.place = ends.finished"""

_AUDIT_SINGLE = f"""WITH {AUDIT}
SELECT * REPLACE (
         CASE WHEN run_id = 'run_1' THEN 'FAILED' ELSE status END AS status,
         CASE WHEN run_id = 'run_1' THEN {_AUDIT_AT} ELSE ended_at END AS ended_at,
         CASE WHEN run_id = 'run_1' THEN 'can''t say ''why''' ELSE error_message END
           AS error_message)
FROM audit
UNION ALL
SELECT 'run_new', 'load gold', '2026-05-11', 'SUCCESS', NULL, NULL, NULL, 7, NULL, 7, 5,
       {_AUDIT_AT}, {_AUDIT_AT}, NULL"""

_EVENT_COLUMNS = """'EVT_' || reservation_id AS eventId,
       'Reservation' || upper(booking_status[1]) || lower(booking_status[2:]) AS eventType,
       replace(updated_ts, ' ', 'T') AS eventTimestamp, property_code AS propertyCode,
       confirmation_number AS confirmationNumber_value, reservation_id AS details_reservationId,
       guest_id AS details_guestId, arrival_date AS details_arrivalDate,
       departure_date AS details_departureDate, room_type AS details_roomType,
       rate_plan_code AS details_ratePlanCode, price_plan_code AS details_pricePlanCode,
       booking_status AS details_status,"""

_FLATTENED = f"""WITH {RAW}
SELECT * REPLACE (CAST(TRY_CAST(room_count AS BIGINT) AS VARCHAR) AS room_count,
                  CAST(NULL AS VARCHAR) AS created_ts)
FROM raw"""


def _synth(index: str, table: str, seed: int, property_code: str | None = None) -> str:
    """Reservations from row numbers, each draw a column of its own."""
    codes = (
        "['BLR001', 'BLR002', 'DEL001', 'MUM001', 'HYD001', 'CHN001', 'DEL002', 'MUM002',"
        " 'KOL001', 'KER001', 'CHA001']"
    )
    # Steps as columns, so that no expression grows by repetition.
    def step(name: str, source: str, value: str) -> str:
        return f"{name} AS (SELECT *, {value} FROM {source})"

    def first(value: str) -> str:
        return f"(xor({value}, {value} >> 15) * 1103515245) % 2147483647"

    def second(value: str) -> str:
        return f"(xor({value}, {value} >> 15) * 1664525525) % 2147483647"

    streams = range(1, 14)
    digest = hashlib.sha256(f"{seed}:2026-05-11".encode()).digest()
    own = [int.from_bytes(digest[i : i + 8], "big") % 2147483647 for i in (0, 8)]
    inputs = {"la": "low + 1", "ha": "high + 1", "lb": "low + 1234567891", "hb": "high + 1234567891"}

    def each(change, names, suffix: str) -> str:
        return ", ".join(f"{change(name)} AS {name}{suffix}" for name in names)

    shifted = ", ".join(f"({value}) % 2147483647 AS {name}" for name, value in inputs.items())
    starts = ", ".join(
        f"(a12 + (b12 * {n * 715827883 % 2147483647}) % 2147483647) % 2147483647 AS s{n}"
        for n in streams
    )
    halves = ", ".join(f"{first(f's{n}')} AS h{n}" for n in streams)
    draws = ", ".join(f"{second(f'h{n}')} AS d{n}" for n in streams)
    chosen = f"'{property_code}'" if property_code else f"{codes}[d1 % 11 + 1]"
    return f"""numbers AS (SELECT {index} AS i FROM {table}),
{step("two", "numbers", "i % 2147483647 AS low, (i // 2147483647) % 2147483647 AS high")},
{step("shifted", "two", shifted)},
{step("once", "shifted", each(first, inputs, "1"))},
{step("twice", "once", each(second, [f"{name}1" for name in inputs], "2"))},
{step("mixed", "twice", f"(la12 + 2 * ha12 + {own[0]}) % 2147483647 AS a, (lb12 + 2 * hb12 + {own[1]}) % 2147483647 AS b")},
{step("half", "mixed", each(first, "ab", "1"))},
{step("states", "half", each(second, ["a1", "b1"], "2"))},
{step("starts", "states", starts)},
{step("halves", "starts", halves)},
{step("draws", "halves", draws)},
picked AS (
  SELECT CAST(100000 + i AS VARCHAR) AS number, {chosen} AS property_code,
         ['BAR', 'CORP', 'MEMBER', 'PKG', 'PREPAY'][d2 % 5 + 1] AS rate_plan_code,
         ['BAR_STD', 'BAR_DLX', 'CORP_STD', 'CORP_DLX', 'MEM_STD', 'MEM_DLX', 'PKG_STD',
          'PKG_DLX', 'PPR_STD', 'PPR_DLX'][2 * (d2 % 5) + d3 % 2 + 1] AS price_plan_code,
         ['STD', 'DLX', 'STE', 'KING', 'QUEEN'][d4 % 5 + 1] AS room_type,
         DATE '2026-05-11' + CAST(1 + d5 % 60 AS INTEGER) AS arrival,
         CAST(1 + d6 % 5 AS INTEGER) AS nights,
         ['BOOKED', 'CANCELLED', 'MODIFIED'][d7 % 3 + 1] AS booking_status,
         CAST(1 + d8 % 4 AS INTEGER) AS room_count, 3500 + d9 % 11501 AS rate,
         TIMESTAMP '2026-05-11 00:00:00' + to_hours(d10 % 24) + to_minutes(d11 % 60)
           + to_seconds(d12 % 60) AS created,
         to_minutes(d13 % 181) AS later
  FROM draws),
synthetic AS (
  SELECT 'RES' || number AS reservation_id, property_code, 'CNF' || number AS confirmation_number,
         'GUEST' || number AS guest_id, CAST(arrival AS VARCHAR) AS arrival_date,
         CAST(arrival + nights AS VARCHAR) AS departure_date, room_type, rate_plan_code,
         price_plan_code, booking_status, room_count,
         CASE WHEN booking_status = 'CANCELLED' THEN 0 ELSE rate * nights * room_count END
           AS total_revenue,
         'INR' AS currency, strftime(created, '%Y-%m-%d %H:%M:%S') AS created_ts,
         strftime(created + later, '%Y-%m-%d %H:%M:%S') AS updated_ts
  FROM picked)"""


_SILVER_OUT = """SELECT * EXCLUDE (cents) REPLACE (CAST(arrival_date AS VARCHAR) AS arrival_date,
                  CAST(departure_date AS VARCHAR) AS departure_date)
FROM silver"""
_GOLD_OUT = f"SELECT * REPLACE ({_DAY}) FROM gold"
_STAY_COLUMNS = """reservation_id, property_code, confirmation_number, guest_id,
       CAST(arrival_date AS VARCHAR) AS arrival_date,
       CAST(departure_date AS VARCHAR) AS departure_date, room_count, total_revenue,
       CAST(stay_nights AS INTEGER) AS stay_nights"""
_SERVING_OUT = f"SELECT * REPLACE ({_DAY}) FROM serving"


def _ordered_all(columns: str) -> str:
    return ", ".join(f"{name.strip()} NULLS FIRST" for name in columns.split(","))


_RAW_NAMES = (
    "reservation_id, property_code, confirmation_number, guest_id, arrival_date, departure_date, "
    "room_type, rate_plan_code, price_plan_code, booking_status, room_count, total_revenue, "
    "currency, created_ts, updated_ts"
)
_RAW_ORDER = _ordered_all(_RAW_NAMES)

_UPSERT_SELECT = f"""SELECT property_code, {_DAY}, reservation_count, booked_rooms, total_revenue,
       adr, gold_ingestion_ts FROM serving"""

_APPENDED = f"""SELECT property_code, {_DAY}, {_MEASURES}, gold_ingestion_ts FROM early
UNION ALL
SELECT property_code, {_DAY}, {_MEASURES}, gold_ingestion_ts FROM late"""

_LINE = " || ',' || ".join(f"coalesce({name}, '')" for name in _RAW_NAMES.split(", "))

_REJECTED = f"WITH {CHECKED} SELECT * FROM checked WHERE validation_reason IS NOT NULL"

_TYPED = "arrival_date, departure_date, created_ts, updated_ts, room_count, total_revenue"
_UNTYPED = ", ".join(name for name in _RAW_NAMES.split(", ") if name not in _TYPED.split(", "))

_BATCH_SPLIT = f"""WITH {SILVER}
SELECT {_UNTYPED}, business_date, source_system,
       CAST(arrival_date AS VARCHAR) AS arrival_date,
       CAST(departure_date AS VARCHAR) AS departure_date, created_ts, updated_ts, room_count,
       total_revenue, {", ".join(f"CAST(NULL AS VARCHAR) AS raw_{n}" for n in _TYPED.split(", "))},
       CAST(NULL AS VARCHAR) AS validation_reason
FROM silver
UNION ALL
SELECT {_UNTYPED}, business_date, source_system, NULL, NULL, NULL, NULL, NULL, NULL,
       {_TYPED}, validation_reason
FROM checked WHERE validation_reason IS NOT NULL"""

_PREVIEW_STORED = f"""WITH {SILVER}, bronze_rows AS (
  SELECT * FROM bronze ORDER BY {_RAW_ORDER} LIMIT 10),
silver_rows AS (
  SELECT * FROM silver ORDER BY {_RAW_ORDER} LIMIT 10)
SELECT 'bronze' AS layer, {_RAW_NAMES} FROM bronze_rows
UNION ALL
SELECT 'silver', {_RAW_NAMES.replace("arrival_date, departure_date",
                                     "CAST(arrival_date AS VARCHAR), CAST(departure_date AS VARCHAR)")
                 .replace("room_count", "CAST(room_count AS VARCHAR)")
                 .replace("total_revenue", "CAST(total_revenue AS VARCHAR)")}
FROM silver_rows"""

ORACLE_SQL: dict[str, str] = {
    "bronze_enrich": f"WITH {BRONZE} SELECT * FROM bronze",
    "reject_counts": f"""WITH {CHECKED}
SELECT validation_reason, count(*) AS row_count FROM checked GROUP BY validation_reason""",
    "strict_reject_counts": f"""WITH {BRONZE}, checked AS (
  SELECT CASE {_RULES} {_STRICT} END AS validation_reason FROM bronze)
SELECT validation_reason, count(*) AS row_count FROM checked GROUP BY validation_reason""",
    "strict_reject_odd_values": f"""WITH {BRONZE}, odd AS (
  SELECT * REPLACE (
           CASE WHEN {_GUEST} % 11 = 0 THEN '0.5' ELSE room_count END AS room_count,
           CASE WHEN {_GUEST} % 13 = 0 THEN 'NaN' WHEN {_GUEST} % 17 = 0 THEN 'Infinity'
                ELSE total_revenue END AS total_revenue)
  FROM bronze), checked AS (
  SELECT CASE {_RULES} {_STRICT}
         WHEN trunc(TRY_CAST(room_count AS DOUBLE)) < 1 THEN 'ROOM_COUNT_BELOW_ONE'
         WHEN NOT isfinite(TRY_CAST(total_revenue AS DOUBLE)) THEN 'REVENUE_NOT_FINITE'
         END AS validation_reason FROM odd)
SELECT validation_reason, count(*) AS row_count FROM checked GROUP BY validation_reason""",
    "rejected_rows": _REJECTED,
    "valid_rows": f"""WITH {CHECKED}
SELECT * EXCLUDE (validation_reason) FROM checked WHERE validation_reason IS NULL""",
    "split_counts": f"""WITH {CHECKED}
SELECT count(*) AS raw_count, count(*) - count(validation_reason) AS valid_count,
       count(validation_reason) AS rejected_count FROM checked""",
    "silver_typed": f"WITH {SILVER} {_SILVER_OUT}",
    "active_stays": f"""WITH {STAYS}
SELECT {_STAY_COLUMNS}, total_revenue / CAST(stay_nights AS DOUBLE) AS revenue_per_night
FROM stays""",
    "stay_nights_exploded": f"WITH {NIGHTS} SELECT {_STAY_COLUMNS}, {_DAY} FROM nights",
    "gold_daily_revenue": f"WITH {GOLD} {_GOLD_OUT}",
    "gold_double_form": f"""WITH {GOLD}
SELECT property_code, {_DAY}, reservation_count, booked_rooms,
       CASE WHEN total_revenue IS NOT NULL THEN TRUE END AS total_within_cent,
       CASE WHEN adr IS NOT NULL THEN TRUE END AS adr_within_cent
FROM gold""",
    "gold_date_range": f"""WITH {GOLD} {_GOLD_OUT}
WHERE gold.stay_date BETWEEN DATE '1998-01-15' AND DATE '1998-03-10'""",
    "staging_projection": f"""WITH {GOLD}, staged AS ({_staging("run_one", "gold")})
SELECT * REPLACE ({_DAY}), {_FIRST_AT} AS staged_at FROM staged""",
    "merge_run_scoped": f"WITH {MERGED} {_SERVING_OUT}",
    "upsert_all": f"WITH {UPSERTED} SELECT * REPLACE ({_DAY}) FROM upserted",
    "append_load": f"WITH {TWO_LOADS} {_APPENDED}",
    "delete_run": f"WITH {STAGED} {_STAGED_OUT} WHERE run_id <> 'run_two'",
    "run_scope": f"WITH {STAGED} {_STAGED_OUT} WHERE run_id = 'run_two'",
    "run_scope_count": f"""WITH {STAGED}
SELECT count(*) AS row_count FROM staged WHERE run_id = 'run_two'""",
    "scalar_fetch": f"""WITH {STAGED}
SELECT run_id, count(*) - (SELECT count(*) FROM early) AS more_than_first_run
FROM staged GROUP BY run_id""",
    "reconcile_counts": f"""WITH {MERGED}
SELECT 'run_two' AS run_id, (SELECT count(*) FROM late) AS gold_count,
       (SELECT count(*) FROM two) AS staged_count,
       (SELECT count(*) FROM serving WHERE last_run_id = 'run_two') AS merged_count,
       (SELECT count(*) FROM late) = (SELECT count(*) FROM two) AS balanced""",
    "key_violations": f"""WITH {BRONZE}
SELECT property_code, arrival_date, count(*) AS row_count FROM bronze
GROUP BY property_code, arrival_date
HAVING count(*) > 1 OR property_code IS NULL OR arrival_date IS NULL""",
    "audit_start": _AUDIT_START,
    "audit_success": _AUDIT_SUCCESS,
    "audit_failure": _AUDIT_FAILURE,
    "audit_single_run": _AUDIT_SINGLE,
    "audit_log": _AUDIT_LOG,
    "audit_log_compacted": _AUDIT_LOG,
    "run_id_format": """SELECT o_orderkey,
       replace(replace(lower('Load ' || o_orderpriority), ' ', '_'), '-', '_') || '_'
       || strftime(o_orderdate, '%Y%m%d') || '_'
       || strftime(o_orderdate + to_seconds(o_custkey), '%Y%m%d_%H%M%S') AS run_id
FROM orders""",
    "event_nest": f"""WITH {RAW}
SELECT {_EVENT_COLUMNS} TRY_CAST(room_count AS BIGINT) AS details_roomCount,
       CAST(total_revenue AS DOUBLE) AS details_totalRevenue, currency AS details_currency
FROM raw""",
    "event_flatten": _FLATTENED,
    "synth_reservations": f"""WITH {_synth("o_orderkey + 1", "orders", 7)}
SELECT * FROM synthetic""",
    "synth_one_property": f"""WITH {_synth("l_orderkey * 4000000000", "lineitem", 2026, "GOA001")}
SELECT * FROM synthetic""",
    "synth_events": f"""WITH {_synth("o_orderkey + 1", "orders", 7)}
SELECT {_EVENT_COLUMNS} CAST(room_count AS BIGINT) AS details_roomCount,
       total_revenue AS details_totalRevenue, currency AS details_currency
FROM synthetic""",
    "synth_batch": f"""WITH {_synth("o_orderkey + 1", "orders", 7, "GOA001")}
SELECT *, {_EVENT_COLUMNS} CAST(room_count AS BIGINT) AS details_roomCount,
       total_revenue AS details_totalRevenue, currency AS details_currency
FROM synthetic""",
    "synth_stored": f"""WITH {_synth("o_orderkey + 1", "orders", 7)}, text AS (
  SELECT * REPLACE (CAST(room_count AS VARCHAR) AS room_count,
                    CAST(total_revenue AS VARCHAR) AS total_revenue)
  FROM synthetic)
SELECT *, 'csv' AS form FROM text
UNION ALL
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS created_ts), 'json' FROM text""",
    "preview_bronze": f"WITH {BRONZE} SELECT * FROM bronze ORDER BY {_RAW_ORDER} LIMIT 10",
    "preview_silver": f"""WITH {SILVER}, first_rows AS (
  SELECT * FROM silver ORDER BY {_RAW_ORDER} LIMIT 10)
{_SILVER_OUT.replace("FROM silver", "FROM first_rows")}""",
    "preview_gold": f"""WITH {GOLD}
{_GOLD_OUT} ORDER BY gold.property_code NULLS FIRST, gold.stay_date NULLS FIRST LIMIT 50""",
    "csv_roundtrip": f"WITH {RAW} SELECT * FROM raw",
    "csv_malformed": f"""WITH {CHECKED}, lines AS (
  SELECT CASE WHEN {_GUEST} % 13 = 0 OR {_GUEST} % 17 = 0 THEN 'MALFORMED_ROW'
              ELSE validation_reason END AS validation_reason,
         CASE WHEN {_GUEST} % 13 = 0 THEN length({_LINE}) + length(',surplus')
              WHEN {_GUEST} % 17 = 0 THEN length({_LINE}) - length(',' || coalesce(updated_ts, ''))
         END AS chars
  FROM checked)
SELECT validation_reason, count(*) AS row_count, CAST(sum(chars) AS BIGINT) AS malformed_length
FROM lines GROUP BY validation_reason""",
    "json_roundtrip": _FLATTENED,
    "layer_roundtrip": f"WITH {BRONZE} SELECT * FROM bronze",
    "gold_by_property": f"WITH {GOLD} {_GOLD_OUT}",
    "rejects_conditional": _REJECTED,
    "rejects_cleared": f"""WITH {CHECKED}
SELECT count(validation_reason) AS after_rejects, CAST(0 AS BIGINT) AS after_clean_run
FROM checked""",
    "batch_gold": f"""WITH {GOLD}
SELECT property_code, {_DAY}, reservation_count, booked_rooms, total_revenue, adr FROM gold""",
    "batch_split": _BATCH_SPLIT,
    "clustered_month": f"""WITH {GOLD} {_GOLD_OUT}
WHERE gold.stay_date BETWEEN DATE '1998-01-15' AND DATE '1998-03-10'""",
    "incremental_gold": f"""WITH {GOLD}
SELECT property_code, {_DAY}, reservation_count, booked_rooms, total_revenue, adr FROM gold""",
    "preview_stored": _PREVIEW_STORED,
    "batch_counts": f"""WITH {GOLD}, counted AS (
  SELECT 'bronze' AS layer, count(*) AS row_count FROM bronze
  UNION ALL SELECT 'silver', count(*) FROM silver
  UNION ALL SELECT 'rejected', count(*) FROM checked WHERE validation_reason IS NOT NULL
  UNION ALL SELECT 'gold', count(*) FROM gold)
SELECT layer, row_count, row_count AS reported FROM counted""",
    "serving_load": f"""WITH {MERGED}
SELECT * REPLACE ({_DAY}, created_at IS NOT NULL AS created_at,
                  updated_at IS NOT NULL AS updated_at)
FROM serving""",
    "serving_load_audit": f"""WITH {TWO_LOADS}, runs AS (
  SELECT 'run_one' AS run_id, count(*) AS n FROM early
  UNION ALL SELECT 'run_two', count(*) FROM late)
SELECT run_id, 'load_gold_stay_revenue' AS job_name, '2026-05-11' AS business_date,
       'SUCCESS' AS status, CAST(NULL AS BIGINT) AS source_count,
       CAST(NULL AS BIGINT) AS bronze_count, CAST(NULL AS BIGINT) AS silver_count,
       n AS gold_count, CAST(NULL AS BIGINT) AS rejected_count, n AS staged_count,
       n AS merged_count, TRUE AS ended, CAST(NULL AS VARCHAR) AS error_message
FROM runs""",
    "failed_load": f"""WITH {TWO_LOADS}, split AS (
  SELECT count(*) AS n, count(validation_reason) AS bad FROM checked)
SELECT 'run_one' AS run_id, 'SUCCESS' AS status, split.n AS source_count, split.n AS bronze_count,
       split.n - split.bad AS silver_count, g.n AS gold_count, split.bad AS rejected_count,
       g.n AS staged_count, g.n AS merged_count, CAST(NULL AS BOOLEAN) AS keys_named,
       CAST(0 AS BIGINT) AS staged_left, g.n AS serving_rows
FROM split, (SELECT count(*) AS n FROM early) g
UNION ALL
SELECT 'run_two', 'FAILED', NULL, NULL, NULL, NULL, NULL, NULL, NULL, TRUE, 0, 0""",
    "coded_keys_load": f"""WITH {MERGED}
SELECT '00' || property_code[2:] AS property_code, {_DAY}, reservation_count, booked_rooms,
       total_revenue, adr, gold_ingestion_ts, 'serving' AS of FROM serving
UNION ALL
SELECT '00' || property_code[2:], {_DAY}, {_MEASURES}, gold_ingestion_ts, 'appended' FROM late""",
    "upsert_load": f"WITH {MERGED} {_UPSERT_SELECT}",
    "append_to_files": f"WITH {TWO_LOADS} {_APPENDED}",
    "append_once": f"WITH {TWO_LOADS} {_APPENDED}",
    "staging_cleared_run": f"""WITH {STAGED}
{_STAGED_OUT.replace("FROM", f", {_FIRST_AT} AS staged_at FROM")} WHERE run_id = 'run_two'""",
    "truncate_stage": f"""WITH {TWO_LOADS}, staged AS ({_staging("run_other", "early")})
{_STAGED_OUT.replace("FROM", f", {_FIRST_AT} AS staged_at FROM")}""",
}
