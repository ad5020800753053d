"""Column layouts of every layer. Raw data is read as text; see operators.refine for the types."""

from pyspark.sql import types as T

# The columns of the raw files.
RAW_COLUMNS = (
    "reservation_id",
    "property_code",
    "confirmation_number",
    "guest_id",
    "arrival_date",
    "departure_date",
    "room_type",
    "rate_plan_code",
    "price_plan_code",
    "booking_status",
    "room_count",
    "total_revenue",
    "currency",
    "created_ts",
    "updated_ts",
)

# Text throughout: a type inferred per directory would change with one bad value,
# and a typed scan would turn a malformed date into a missing one.
RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# The text of a raw line that does not fit the columns.
MALFORMED = "_corrupt_record"

BRONZE = T.StructType(
    RAW.fields
    + [
        T.StructField("business_date", T.StringType()),
        T.StructField("bronze_ingestion_ts", T.TimestampType()),
        T.StructField("source_system", T.StringType()),
    ]
)

# Silver types six of the raw columns.
_SILVER_TYPES = {
    "arrival_date": T.DateType(),
    "departure_date": T.DateType(),
    "room_count": T.IntegerType(),
    "total_revenue": T.DoubleType(),
    "created_ts": T.TimestampType(),
    "updated_ts": T.TimestampType(),
}
SILVER = T.StructType(
    [T.StructField(f.name, _SILVER_TYPES.get(f.name, f.dataType)) for f in BRONZE.fields]
    + [T.StructField("silver_ingestion_ts", T.TimestampType())]
)

GOLD = T.StructType(
    [
        T.StructField("property_code", T.StringType()),
        T.StructField("stay_date", T.DateType()),
        T.StructField("reservation_count", T.LongType()),
        T.StructField("booked_rooms", T.LongType()),
        T.StructField("total_revenue", T.DoubleType()),
        T.StructField("adr", T.DoubleType()),
        T.StructField("gold_ingestion_ts", T.TimestampType()),
    ]
)

# JSON numbers are kept as their source text, so nothing is lost to a guessed type.
EVENT = T.StructType(
    [
        T.StructField("eventId", T.StringType()),
        T.StructField("eventType", T.StringType()),
        T.StructField("eventTimestamp", T.StringType()),
        T.StructField("propertyCode", T.StringType()),
        T.StructField(
            "confirmationNumber",
            T.StructType([T.StructField("value", T.StringType())]),
        ),
        T.StructField(
            "reservationDetails",
            T.StructType(
                [
                    T.StructField(name, T.StringType())
                    for name in (
                        "reservationId",
                        "guestId",
                        "arrivalDate",
                        "departureDate",
                        "roomType",
                        "ratePlanCode",
                        "pricePlanCode",
                        "status",
                        "roomCount",
                        "totalRevenue",
                        "currency",
                    )
                ]
            ),
        ),
    ]
)

MONEY = T.DecimalType(18, 2)

GOLD_KEYS = ("property_code", "stay_date")

STAGING = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("property_code", T.StringType()),
        T.StructField("stay_date", T.DateType()),
        T.StructField("reservation_count", T.IntegerType()),
        T.StructField("booked_rooms", T.IntegerType()),
        T.StructField("total_revenue", MONEY),
        T.StructField("adr", MONEY),
        T.StructField("business_date", T.DateType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("gold_ingestion_ts", T.TimestampType()),
    ]
)

# As stored: with the time each row came in.
STAGED = T.StructType(STAGING.fields + [T.StructField("staged_at", T.TimestampType())])

SERVING = T.StructType(
    [
        T.StructField("property_code", T.StringType()),
        T.StructField("stay_date", T.DateType()),
        T.StructField("reservation_count", T.IntegerType()),
        T.StructField("booked_rooms", T.IntegerType()),
        T.StructField("total_revenue", MONEY),
        T.StructField("adr", MONEY),
        T.StructField("business_date", T.DateType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("last_run_id", T.StringType()),
        T.StructField("gold_ingestion_ts", T.TimestampType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# What an append takes over: the measures and their keys, no bookkeeping.
APPENDED = T.StructType(
    [
        field
        for field in SERVING.fields
        if field.name
        not in ("business_date", "source_system", "last_run_id", "created_at", "updated_at")
    ]
)

AUDIT_COUNTS = (
    "source_count",
    "bronze_count",
    "silver_count",
    "gold_count",
    "rejected_count",
    "staged_count",
    "merged_count",
)

AUDIT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("status", T.StringType()),
    ]
    # 64-bit: a run at full size counts far beyond 2^31 rows.
    + [T.StructField(name, T.LongType()) for name in AUDIT_COUNTS]
    + [
        T.StructField("started_at", T.TimestampType()),
        T.StructField("ended_at", T.TimestampType()),
        T.StructField("error_message", T.StringType()),
    ]
)

# One change of a run: a line of the run log. ``tick`` and ``id`` order changes of one instant.
RUN_EVENT = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("tick", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("business_date", T.DateType()),
    ]
    + [T.StructField(name, T.LongType()) for name in AUDIT_COUNTS]
    + [T.StructField("error_message", T.StringType())]
)
