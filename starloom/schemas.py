"""Column types of every source and table, and the registry that creates the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "float[]": T.ArrayType(T.FloatType()),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(1,0)": T.DecimalType(1, 0),
    "decimal(8,2)": T.DecimalType(8, 2),
}


def columns(text: str) -> T.StructType:
    """A schema from `name type, ...`; works before there is a session."""
    fields = [field.split(" ") for field in text.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Field names of the input files.
PLAY_EVENTS = columns(
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId bigint, song string, status int, "
    "ts bigint, userAgent string, userId string"
)

SONG_CATALOGUE = columns(
    "artist_id string, artist_latitude double, artist_location string, "
    "artist_longitude double, artist_name string, duration double, num_songs int, "
    "song_id string, title string, year int"
)

TICKETS = columns(
    "id double, sporting_event_id double, sport_location_id double, "
    "seat_level decimal(1,0), seat_section string, seat_row string, seat string, "
    "ticketholder_id double, ticket_price decimal(8,2)"
)

PAYMENTS = columns(
    "payment_id int, customer_id int, staff_id int, rental_id int, amount double, "
    "payment_date timestamp"
)

# Columns of the star tables.
USERS = columns(
    "user_id string, first_name string, last_name string, gender string, level string"
)

SONGS = columns(
    "song_id string, title string, artist_id string, duration double, year int"
)

ARTISTS = columns(
    "artist_id string, name string, location string, latitude double, longitude double"
)

TIME = columns(
    "start_time timestamp, hour int, day int, week int, weekday int, year int, month int"
)

SONGPLAYS = columns(
    "songplay_id string, start_time timestamp, user_id string, level string, "
    "song_id string, artist_id string, session_id bigint, location string, "
    "user_agent string, year int, month int"
)

# Columns of the order star.
SSB_PART = columns(
    "p_partkey int, p_name string, p_mfgr string, p_category string, p_brand1 string, "
    "p_color string, p_type string, p_size int, p_container string"
)

SSB_SUPPLIER = columns(
    "s_suppkey int, s_name string, s_address string, s_city string, s_nation string, "
    "s_region string, s_phone string"
)

SSB_CUSTOMER = columns(
    "c_custkey int, c_name string, c_address string, c_city string, c_nation string, "
    "c_region string, c_phone string, c_mktsegment string"
)

SSB_DATE = columns(
    "d_datekey int, d_date string, d_dayofweek string, d_month string, d_year int, "
    "d_yearmonthnum int, d_yearmonth string, d_daynuminweek int, d_daynuminmonth int, "
    "d_daynuminyear int, d_monthnuminyear int, d_weeknuminyear int, "
    "d_sellingseason string, d_lastdayinweekfl string, d_lastdayinmonthfl string, "
    "d_holidayfl string, d_weekdayfl string"
)

SSB_LINEORDER = columns(
    "lo_orderkey int, lo_linenumber int, lo_custkey int, lo_partkey int, "
    "lo_suppkey int, lo_orderdate int, lo_orderpriority string, "
    "lo_shippriority string, lo_quantity int, lo_extendedprice int, "
    "lo_ordertotalprice int, lo_discount int, lo_revenue int, lo_supplycost int, "
    "lo_tax int, lo_commitdate int, lo_shipmode string"
)

# The given tables, their names and columns.
GIVEN_TABLES = {
    "region": columns("r_regionkey int, r_name string"),
    "nation": columns("n_nationkey int, n_name string, n_regionkey int"),
    "customer": columns(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": columns("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": columns(
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": columns(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": columns(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": columns(
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": columns(
        "doc_id bigint, text string, lang string, source string, n_chars bigint"
    ),
    "embeddings": columns("vec_id bigint, embedding float[], label int"),
    "pages": columns("page_id bigint, url string, html string"),
    "benchmark": columns("item_id bigint, text string"),
    "labels": columns("doc_id bigint, quality int, toxic int"),
    "conversations": columns("conv_id bigint, turn bigint, role string, text string"),
}


@dataclass(frozen=True)
class TableSpec:
    """A stored table: its columns, its key, and how its files are laid out.

    A `versioned` table is replaced as a whole by every merge; its name is a view of the
    current version. A table with `parts` is stored in so many folders by a hash of its key, of
    which a merge rewrites those that change; its name is a view without the folder's number.
    """

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    sort_by: tuple[str, ...] = ()
    versioned: bool = False
    parts: int = 0


#: Folders of a dimension that is merged into: a merge rewrites a thirty-second at least.
DIMENSION_PARTS = 32

STAGING_TABLES = (
    TableSpec("staging_events", PLAY_EVENTS),
    TableSpec("staging_songs", SONG_CATALOGUE),
)

STAR_TABLES = (
    TableSpec("users", USERS, keys=("user_id",), parts=DIMENSION_PARTS),
    TableSpec("songs", SONGS, keys=("song_id",)),
    TableSpec("artists", ARTISTS, keys=("artist_id",), parts=DIMENSION_PARTS),
    TableSpec("time", TIME, keys=("start_time",), partition_by=("year", "month")),
    TableSpec("songplays", SONGPLAYS, keys=("songplay_id",), partition_by=("year", "month")),
)

SSB_TABLES = (
    TableSpec("customer", SSB_CUSTOMER, keys=("c_custkey",)),
    TableSpec("dwdate", SSB_DATE, keys=("d_datekey",)),
    TableSpec("supplier", SSB_SUPPLIER, keys=("s_suppkey",)),
    TableSpec("part", SSB_PART, keys=("p_partkey",)),
    TableSpec("lineorder", SSB_LINEORDER, keys=("lo_orderkey", "lo_linenumber")),
)


def laid_out(specs: tuple[TableSpec, ...], buckets: int) -> tuple[TableSpec, ...]:
    """The order star with its distribution and sort keys: fact and part share `partkey` buckets."""
    # Which key each table is distributed and sorted on.
    bucket_by = {"part": ("p_partkey",), "lineorder": ("lo_partkey",)}
    sort_by = {
        "customer": ("c_custkey",),
        "dwdate": ("d_datekey",),
        "supplier": ("s_suppkey",),
        "part": ("p_partkey",),
        "lineorder": ("lo_orderdate",),
    }
    return tuple(
        TableSpec(
            spec.name,
            spec.schema,
            spec.keys,
            bucket_by=bucket_by.get(spec.name, ()),
            buckets=buckets if spec.name in bucket_by else 0,
            sort_by=sort_by.get(spec.name, ()),
        )
        for spec in specs
    )
