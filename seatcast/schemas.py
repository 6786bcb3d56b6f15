"""Explicit schemas: raw snapshots, landed API pages, alert rules, genre seed."""

from pyspark.sql import types as T

S, D, I, L, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()

# One row per event per snapshot day; unique (event_id, snapshot_date).
# Stored as Parquet partitioned by snapshot_date.
SNAPSHOT = T.StructType([
    T.StructField("event_id", S, False),
    T.StructField("name", S),
    T.StructField("event_date", T.TimestampNTZType()),
    T.StructField("venue_name", S),
    T.StructField("venue_city", S),
    T.StructField("venue_state", S),
    T.StructField("venue_capacity", I),
    T.StructField("genre", S),
    T.StructField("subgenre", S),
    T.StructField("artist_name", S),
    T.StructField("min_price", D),
    T.StructField("max_price", D),
    T.StructField("currency", S),
    T.StructField("status", S),
    T.StructField("url", S),
    T.StructField("snapshot_date", T.DateType(), False),
    T.StructField("ingested_at", T.TimestampNTZType(), False),
])

SNAPSHOT_KEY = ["event_id", "snapshot_date"]

# One API event as returned by the event search endpoint (only the fields we use).
API_EVENT = T.StructType([
    T.StructField("id", S),
    T.StructField("name", S),
    T.StructField("url", S),
    T.StructField("dates", T.StructType([
        T.StructField("start", T.StructType([
            T.StructField("localDate", S),
            T.StructField("dateTime", S),
        ])),
        T.StructField("status", T.StructType([T.StructField("code", S)])),
    ])),
    T.StructField("priceRanges", T.ArrayType(T.StructType([
        T.StructField("min", D), T.StructField("max", D), T.StructField("currency", S),
    ]))),
    T.StructField("classifications", T.ArrayType(T.StructType([
        T.StructField("genre", T.StructType([T.StructField("name", S)])),
        T.StructField("subGenre", T.StructType([T.StructField("name", S)])),
    ]))),
    T.StructField("_embedded", T.StructType([
        T.StructField("venues", T.ArrayType(T.StructType([
            T.StructField("name", S),
            T.StructField("city", T.StructType([T.StructField("name", S)])),
            T.StructField("state", T.StructType([T.StructField("stateCode", S)])),
            T.StructField("upcomingEvents", T.StructType([T.StructField("_total", I)])),
        ]))),
        T.StructField("attractions", T.ArrayType(T.StructType([T.StructField("name", S)]))),
    ])),
])

# One landed result page (one JSON document per file line).
API_PAGE = T.StructType([
    T.StructField("page", T.StructType([
        T.StructField("number", I), T.StructField("totalPages", I),
        T.StructField("size", I), T.StructField("totalElements", L),
    ])),
    T.StructField("_embedded", T.StructType([
        T.StructField("events", T.ArrayType(API_EVENT)),
    ])),
])

# The same page with its events as VARIANT: a reader of these can tell a field that is
# missing from one that is null.
VARIANT_PAGE = T.StructType([
    API_PAGE["page"],
    T.StructField("_embedded", T.StructType([
        T.StructField("events", T.ArrayType(T.VariantType())),
    ])),
])

# Alert rules.  rule_id is the rule's position in the user's list.
RULES = T.StructType([
    T.StructField("rule_id", L, False),
    T.StructField("target_price", D),
    T.StructField("created_at", S),
    T.StructField("triggered", B),
    T.StructField("event_id", S),
    T.StructField("artist_name", S),
    T.StructField("triggered_at", S),
    T.StructField("triggered_price", D),
])

GENRE_SEED = T.StructType([
    T.StructField("source_genre", S),
    T.StructField("display_genre", S),
])
