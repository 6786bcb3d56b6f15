"""Landed API result pages -> flat snapshot rows.

The event search API is paged (200 events a page, date ascending, per city).
Pages are landed as JSON documents, one page per line, under

    <root>/snapshot_date=YYYY-MM-DD/city=<name>/<any file name>.json

so the snapshot day and the city come from the path (partition discovery),
never from the clock.  Every landed page counts: what has been fetched is not
dropped again by rules that were made to spare the API.  A page landed twice
(a retry) counts once, the later file wins; unreadable lines, missing page
numbers and page counts that do not fit are reported by ``page_report``.

``flatten_events`` turns one nested event into one row with column
expressions only (no Python): the first venue / attraction / classification /
price range; missing text -> '', missing prices and capacity -> NULL, missing
currency -> 'USD'; the event date is the start dateTime, else the localDate
(midnight), else NULL, read as local wall time whatever the session's zone;
a text that is no date is NULL and counted as rejected.  An empty venue, attraction or classification list
gives '' as well.

Structs cannot tell a missing key from an explicit null; both give the default.  Read
as VARIANT (``keep_nulls``), an explicit null of one of the ten defaulted fields is
NULL and only a missing key gives the default, as the original has it.  A null list or
object on the way to a field counts as missing (the original stops with an error
there, but for price ranges).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import blank_if_null, first_or_null, ntz_literal
from ..schemas import API_EVENT, API_PAGE, VARIANT_PAGE
from ..session import exists

# Fixed values of the fetch contract.
PAGE_SIZE = 200
DEFAULT_CURRENCY = "USD"

FLAT_COLUMNS = ["event_id", "name", "event_date", "venue_name", "venue_city", "venue_state",
                "venue_capacity", "genre", "subgenre", "artist_name", "min_price", "max_price",
                "currency", "status", "url"]
# Set on rows whose date text could not be read.
DATE_REJECTED = "date_rejected"


def _truthy_text(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) != F.lit(""), c)


def _wall_time(text: Column) -> Column:
    """'2025-03-15T19:00:00Z' -> 2025-03-15 19:00:00: the zone designator goes, nothing
    is shifted, no zoned type in between; NULL if the text is no date."""
    plain = F.regexp_replace(text, "(?<=T.{0,20})(Z|[+-][0-9]{2}:?[0-9]{2})$", "")
    return plain.try_cast("timestamp_ntz")


def flatten_events(events: DataFrame, event_col: str = "event") -> DataFrame:
    """One flat row per nested event (struct column ``event_col`` of type
    ``API_EVENT``, or VARIANT, see ``flatten_variants``); other columns of ``events``
    are kept in front."""
    if isinstance(events.schema[event_col].dataType, T.VariantType):
        return flatten_variants(events, event_col)
    e = F.col(event_col)
    venue = first_or_null(e["_embedded"]["venues"])
    attraction = first_or_null(e["_embedded"]["attractions"])
    cls = first_or_null(e["classifications"])
    price = first_or_null(e["priceRanges"])
    start = e["dates"]["start"]
    when_text = F.coalesce(_truthy_text(start["dateTime"]), _truthy_text(start["localDate"]))
    event_date = _wall_time(when_text)
    keep = [c for c in events.columns if c != event_col]
    return events.select(
        *keep,
        e["id"].alias("event_id"),
        blank_if_null(e["name"]).alias("name"),
        event_date.alias("event_date"),
        blank_if_null(venue["name"]).alias("venue_name"),
        blank_if_null(venue["city"]["name"]).alias("venue_city"),
        blank_if_null(venue["state"]["stateCode"]).alias("venue_state"),
        venue["upcomingEvents"]["_total"].alias("venue_capacity"),
        blank_if_null(cls["genre"]["name"]).alias("genre"),
        blank_if_null(cls["subGenre"]["name"]).alias("subgenre"),
        blank_if_null(attraction["name"]).alias("artist_name"),
        price["min"].alias("min_price"),
        price["max"].alias("max_price"),
        F.coalesce(price["currency"], F.lit(DEFAULT_CURRENCY)).alias("currency"),
        blank_if_null(e["dates"]["status"]["code"]).alias("status"),
        blank_if_null(e["url"]).alias("url"),
        (when_text.isNotNull() & event_date.isNull()).alias(DATE_REJECTED),
    )


def flatten_variants(events: DataFrame, event_col: str = "event") -> DataFrame:
    """``flatten_events`` for events as VARIANT: an explicit null of a defaulted field
    is NULL, a missing key gives the default."""
    e = F.col(event_col)

    def value(path: str, as_type: str = "string") -> Column:
        return F.try_variant_get(e, path, as_type)

    def text(path: str, default: str = "") -> Column:
        # as VARIANT, a missing path is NULL and an explicit null is a value
        return F.when(value(path, "variant").isNull(), F.lit(default)).otherwise(value(path))

    venue, kind, price = "$._embedded.venues[0]", "$.classifications[0]", "$.priceRanges[0]"
    when_text = F.coalesce(_truthy_text(value("$.dates.start.dateTime")),
                           _truthy_text(value("$.dates.start.localDate")))
    event_date = _wall_time(when_text)
    keep = [c for c in events.columns if c != event_col]
    return events.select(
        *keep,
        value("$.id").alias("event_id"),
        text("$.name").alias("name"),
        event_date.alias("event_date"),
        text(f"{venue}.name").alias("venue_name"),
        text(f"{venue}.city.name").alias("venue_city"),
        text(f"{venue}.state.stateCode").alias("venue_state"),
        value(f"{venue}.upcomingEvents._total", "int").alias("venue_capacity"),
        text(f"{kind}.genre.name").alias("genre"),
        text(f"{kind}.subGenre.name").alias("subgenre"),
        text("$._embedded.attractions[0].name").alias("artist_name"),
        value(f"{price}.min", "double").alias("min_price"),
        value(f"{price}.max", "double").alias("max_price"),
        text(f"{price}.currency", DEFAULT_CURRENCY).alias("currency"),
        text("$.dates.status.code").alias("status"),
        text("$.url").alias("url"),
        (when_text.isNotNull() & event_date.isNull()).alias(DATE_REJECTED),
    )


UNREADABLE = "_unreadable"

_PATH_AND_STATE = [
    T.StructField(UNREADABLE, T.StringType()),
    T.StructField("snapshot_date", T.DateType()),
    T.StructField("city", T.StringType()),
]
LANDED_PAGE = T.StructType(API_PAGE.fields + _PATH_AND_STATE)
LANDED_VARIANT_PAGE = T.StructType(VARIANT_PAGE.fields + _PATH_AND_STATE)

_PAGE_KEY = ["snapshot_date", "city", "page.number"]


def read_pages(spark: SparkSession, root: str, days=None, keep_nulls: bool = False) -> DataFrame:
    """Raw landed pages with their ``snapshot_date`` and ``city`` path keys
    (typed by the schema, not inferred from the path text).  With ``days`` only
    those days' folders are listed.  ``keep_nulls`` reads the events as VARIANT."""
    schema = LANDED_VARIANT_PAGE if keep_nulls else LANDED_PAGE
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", UNREADABLE)
    if days is None:
        return reader.json(root)
    paths = [f"{root.rstrip('/')}/snapshot_date={d.isoformat()}" for d in sorted(days)]
    paths = [p for p in paths if exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", root).json(paths)


def page_report(pages: DataFrame) -> DataFrame:
    """Per day and city: pages landed, repeats, unreadable lines, missing page
    numbers (below the largest announced count or seen number) and events.
    Only page numbers and sizes travel."""
    number = F.col("page.number")
    events = F.coalesce(F.size("_embedded.events"), F.lit(0))
    narrow = pages.select("snapshot_date", "city", number.alias("number"),
                          F.col("page.totalPages").alias("announced"),
                          F.col(UNREADABLE).isNotNull().alias("bad"),
                          F.greatest(events, F.lit(0)).alias("events"))
    per_page = narrow.groupBy("snapshot_date", "city", "number").agg(
        F.count_if(~F.col("bad")).alias("copies"), F.count_if("bad").alias("bad"),
        F.max("announced").alias("announced"), F.max("events").alias("events"))
    known = F.col("number").isNotNull() & (F.col("copies") > 0)
    expected = F.greatest(F.coalesce(F.max("announced"), F.lit(0)),
                          F.coalesce(F.max("number") + 1, F.lit(0)))
    return per_page.groupBy("snapshot_date", "city").agg(
        F.sum("copies").alias("pages"),
        F.sum(F.when(known, F.col("copies") - 1).otherwise(0)).alias("repeats"),
        F.sum("bad").alias("unreadable"),
        (expected - F.count_if(known)).cast("long").alias("missing"),
        F.sum("events").cast("long").alias("events"))


def distinct_pages(pages: DataFrame, last: Column | None = None) -> DataFrame:
    """Every readable page once; of repeated ones that with the largest ``last``, by
    default the file's time and path.  Pages pass straight from the scan; only if
    some page number of a day and city landed more than once (one check on the
    narrow keys) do those pages, and only those, meet to keep the last one."""
    good = pages.filter(F.col(UNREADABLE).isNull() & F.col("_embedded").isNotNull())
    key = [F.col(k) for k in _PAGE_KEY]
    names = ["snapshot_date", "city", "number"]
    again = (good.filter(F.col("page.number").isNotNull()).groupBy(*key)
             .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*names))
    if again.isEmpty():
        return good
    if last is None:
        last = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    marked = good.select("*", F.col("page.number").alias("number"),
                         F.struct(last, F.xxhash64(F.to_json("_embedded"))).alias("_last"))
    last = Window.partitionBy(*names).orderBy(F.col("_last").desc())
    kept = (marked.join(again, names, "left_semi")
            .select("*", F.row_number().over(last).alias("_rank")).filter("_rank = 1"))
    return marked.join(again, names, "left_anti").select(good.columns).unionByName(
        kept.select(good.columns))


def page_events(pages: DataFrame, max_pages: int | None = None,
                last: Column | None = None) -> DataFrame:
    """One row per event of the pages: snapshot_date, city, event.  By default
    all pages count; ``max_pages`` keeps the numbers below it."""
    if max_pages is not None:
        pages = pages.filter(F.col("page.number") < max_pages)
    return (distinct_pages(pages, last)
            .select("snapshot_date", "city", F.explode("_embedded.events").alias("event")))


def landed_rows(spark: SparkSession, root: str, days=None,
                max_pages: int | None = None, keep_nulls: bool = False) -> DataFrame:
    """Landed pages -> flat rows with ``snapshot_date`` and ``date_rejected``
    (SNAPSHOT minus ``ingested_at``)."""
    return flat_rows(page_events(read_pages(spark, root, days, keep_nulls), max_pages))


def flat_rows(events: DataFrame) -> DataFrame:
    """Flat rows of ``page_events``."""
    return flatten_events(events).drop("city").select(*FLAT_COLUMNS, "snapshot_date",
                                                      DATE_REJECTED)


def event_window(rows: DataFrame, as_of, days_ahead: int = 90, *, city: str | None = None,
                 state: str | None = None, genre: str | None = None) -> DataFrame:
    """The optional search filters of the fetch, applied to flat rows:
    events dated within [as_of, as_of + days_ahead], and city / state /
    genre equality."""
    start = ntz_literal(as_of)
    end = F.timestamp_add("DAY", F.lit(days_ahead), start)
    out = rows.filter((F.col("event_date") >= start) & (F.col("event_date") <= end))
    for c, v in (("venue_city", city), ("venue_state", state), ("genre", genre)):
        if v is not None:
            out = out.filter(F.col(c) == F.lit(v))
    return out


# ---------------------------------------------------------------- landing

def nest_events(rows: DataFrame) -> DataFrame:
    """Flat snapshot rows -> API-shaped event structs (the inverse of
    ``flatten_events`` for rows without NULL text).  Used to land test pages
    from the driver tables."""
    ts = F.date_format("event_date", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    price = F.when(F.col("min_price").isNotNull() | F.col("max_price").isNotNull(),
                   F.array(F.struct(F.col("min_price").alias("min"),
                                    F.col("max_price").alias("max"),
                                    F.col("currency").alias("currency"))))
    event = F.struct(
        F.col("event_id").alias("id"),
        F.col("name").alias("name"),
        F.col("url").alias("url"),
        F.struct(F.struct(F.to_date("event_date").cast("string").alias("localDate"),
                          ts.alias("dateTime")).alias("start"),
                 F.struct(F.col("status").alias("code")).alias("status")).alias("dates"),
        F.coalesce(price, F.array().cast(API_EVENT["priceRanges"].dataType)).alias("priceRanges"),
        F.array(F.struct(F.struct(F.col("genre").alias("name")).alias("genre"),
                         F.struct(F.col("subgenre").alias("name")).alias("subGenre")))
        .alias("classifications"),
        F.struct(
            F.array(F.struct(F.col("venue_name").alias("name"),
                             F.struct(F.col("venue_city").alias("name")).alias("city"),
                             F.struct(F.col("venue_state").alias("stateCode")).alias("state"),
                             F.struct(F.col("venue_capacity").alias("_total"))
                             .alias("upcomingEvents"))).alias("venues"),
            F.array(F.struct(F.col("artist_name").alias("name"))).alias("attractions"),
        ).alias("_embedded"),
    )
    return rows.select("snapshot_date", F.col("venue_city").alias("city"),
                       F.col("event_id"), event.alias("event"))


def land_pages(rows: DataFrame, root: str, page_size: int = PAGE_SIZE) -> None:
    """Write flat rows as landed result pages under ``root``.

    Events of a (day, city) are spread over ceil(n / page_size) pages by a
    hash of the event id, so every page (one output row) holds about
    ``page_size`` events however large a city-day is; no window over a whole
    city-day."""
    nested = nest_events(rows)
    counts = nested.groupBy("snapshot_date", "city").agg(F.count(F.lit(1)).alias("_n"))
    n_pages = F.greatest(F.ceil(F.col("_n") / F.lit(page_size)), F.lit(1)).cast("int")
    paged = (nested.join(counts, ["snapshot_date", "city"])
             .select("snapshot_date", "city", "event", n_pages.alias("_pages"),
                     F.pmod(F.xxhash64("event_id"), n_pages).cast("int").alias("_page")))
    pages = (paged.groupBy("snapshot_date", "city", "_page")
             .agg(F.collect_list("event").alias("_events"), F.max("_pages").alias("_pages"))
             .select("snapshot_date", "city",
                     F.struct(F.col("_page").alias("number"), F.col("_pages").alias("totalPages"),
                              F.lit(page_size).alias("size"),
                              F.lit(None).cast("long").alias("totalElements")).alias("page"),
                     F.struct(F.col("_events").alias("events")).alias("_embedded")))
    # a day's pages meet in few tasks; large days are split by size
    (pages.hint("rebalance", "snapshot_date").write.mode("errorifexists")
     .partitionBy("snapshot_date", "city").json(root))
