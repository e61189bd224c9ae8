"""Declared schemas of the sources and names of the target tables. Sources are never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names and types of the source files and target tables.

EVENT_LOG = T.StructType(
    [
        T.StructField("artist", T.StringType()),
        T.StructField("auth", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("itemInSession", T.LongType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("level", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("page", T.StringType()),
        # written as a decimal number; a LONG field would read it as NULL
        T.StructField("registration", T.DoubleType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("song", T.StringType()),
        T.StructField("status", T.LongType()),
        T.StructField("ts", T.LongType()),
        T.StructField("userAgent", T.StringType()),
        # a number in quotes, possibly blank
        T.StructField("userId", T.StringType()),
    ]
)

CATALOGUE = T.StructType(
    [
        T.StructField("num_songs", T.IntegerType()),
        T.StructField("artist_id", T.StringType()),
        T.StructField("artist_latitude", T.DoubleType()),
        T.StructField("artist_longitude", T.DoubleType()),
        T.StructField("artist_location", T.StringType()),
        T.StructField("artist_name", T.StringType()),
        T.StructField("song_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("year", T.IntegerType()),
    ]
)

# ts and registration come in scientific notation, hence double
EVENT_CSV = T.StructType(
    [
        T.StructField("artist", T.StringType()),
        T.StructField("auth", T.StringType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("itemInSession", T.IntegerType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("length", T.DoubleType()),
        T.StructField("level", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("registration", T.DoubleType()),
        T.StructField("sessionId", T.IntegerType()),
        T.StructField("song", T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("ts", T.DoubleType()),
        T.StructField("userId", T.StringType()),
    ]
)

CONSOLIDATED_COLUMNS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length",
    "level", "location", "sessionId", "song", "userId",
]

DEMOGRAPHICS = T.StructType(
    [
        T.StructField("City", T.StringType()),
        T.StructField("State", T.StringType()),
        T.StructField("Median_Age", T.DoubleType()),
        T.StructField("Male_Pop", T.IntegerType()),
        T.StructField("Female_Pop", T.IntegerType()),
        T.StructField("Total_Pop", T.IntegerType()),
        T.StructField("Num_Veterans", T.IntegerType()),
        T.StructField("Num_Foreign_born", T.IntegerType()),
        T.StructField("Avg_Household_Size", T.DoubleType()),
        T.StructField("State_Code", T.StringType()),
        T.StructField("Race", T.StringType()),
        T.StructField("Count", T.IntegerType()),
    ]
)

AIRPORTS = T.StructType(
    [
        T.StructField("ident", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("elevation_ft", T.IntegerType()),
        T.StructField("continent", T.StringType()),
        T.StructField("iso_country", T.StringType()),
        T.StructField("iso_region", T.StringType()),
        T.StructField("municipality", T.StringType()),
        T.StructField("gps_code", T.StringType()),
        T.StructField("iata_code", T.StringType()),
        T.StructField("local_code", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ]
)

RECORD_DOUBLES = [
    "cicid", "i94yr", "i94mon", "i94cit", "i94res", "arrdate", "i94mode", "depdate",
    "i94bir", "i94visa", "biryear", "admnum",
]
RECORD_STRINGS = [
    "i94port", "i94addr", "entdepa", "entdepd", "entdepu", "matflag", "airline", "fltno",
    "occup", "gender", "visapost", "visatype", "dtadfile", "dtaddto",
]

ARRIVALS = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in RECORD_DOUBLES]
    + [T.StructField(name, T.StringType()) for name in RECORD_STRINGS]
)

STAR_COLUMNS = {
    "songplays": [
        "songplay_id", "start_time", "user_id", "level", "song_id", "artist_id",
        "session_id", "location", "user_agent",
    ],
    "users": ["user_id", "first_name", "last_name", "gender", "level"],
    "songs": ["song_id", "title", "artist_id", "year", "duration"],
    "artists": ["artist_id", "name", "location", "latitude", "longitude"],
    "time": ["start_time", "hour", "day", "week", "month", "year", "weekday"],
}

# the same tables under the names of the scheduled warehouse load
SCHEDULED_COLUMNS = {
    "songplays": [
        "playid", "start_time", "userid", "level", "songid", "artistid",
        "sessionid", "location", "user_agent",
    ],
    "users": ["userid", "first_name", "last_name", "gender", "level"],
    "songs": ["songid", "title", "artistid", "year", "duration"],
    "artists": ["artistid", "name", "location", "latitude", "longitude"],
    "time": ["start_time", "hour", "day", "week", "month", "year", "weekday"],
}

# columns the warehouse declares as primary key, and the others it declares NOT NULL
PRIMARY_KEYS = {
    "songplays": ["songplay_id"],
    "users": ["user_id"],
    "songs": ["song_id"],
    "artists": ["artist_id"],
    "time": ["start_time"],
}
REQUIRED = {
    "songplays": ["start_time", "level", "session_id"],
    "users": [],
    "songs": ["title", "artist_id", "year", "duration"],
    "artists": [],
    "time": ["hour", "day", "week", "month", "year", "weekday"],
}
TEXT_LIMITS = {
    "staging_events": {
        "auth": 15, "firstName": 30, "gender": 1, "lastName": 30, "level": 4, "method": 4, "page": 20,
    },
    "staging_songs": {"artist_id": 30, "song_id": 30},
    "songplays": {"level": 4, "song_id": 30, "artist_id": 30},
    "users": {"first_name": 30, "last_name": 30, "gender": 1, "level": 4},
    "songs": {"song_id": 30, "artist_id": 30},
    "time": {"month": 10, "weekday": 10},
}


def _table(fields: list[tuple[str, T.DataType]], required: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in fields])


STAR = {
    "songplays": _table(
        [
            ("songplay_id", T.LongType()),
            ("start_time", T.TimestampNTZType()),
            ("user_id", T.IntegerType()),
            ("level", T.StringType()),
            ("song_id", T.StringType()),
            ("artist_id", T.StringType()),
            ("session_id", T.LongType()),
            ("location", T.StringType()),
            ("user_agent", T.StringType()),
        ],
        ["songplay_id", *REQUIRED["songplays"]],
    ),
    "users": _table(
        [
            ("user_id", T.IntegerType()),
            ("first_name", T.StringType()),
            ("last_name", T.StringType()),
            ("gender", T.StringType()),
            ("level", T.StringType()),
        ],
        ["user_id"],
    ),
    "songs": _table(
        [
            ("song_id", T.StringType()),
            ("title", T.StringType()),
            ("artist_id", T.StringType()),
            ("year", T.IntegerType()),
            ("duration", T.DoubleType()),
        ],
        ["song_id", *REQUIRED["songs"]],
    ),
    "artists": _table(
        [
            ("artist_id", T.StringType()),
            ("name", T.StringType()),
            ("location", T.StringType()),
            ("latitude", T.DoubleType()),
            ("longitude", T.DoubleType()),
        ],
        ["artist_id"],
    ),
    "time": _table(
        [
            ("start_time", T.TimestampNTZType()),
            ("hour", T.IntegerType()),
            ("day", T.IntegerType()),
            ("week", T.IntegerType()),
            ("month", T.StringType()),
            ("year", T.IntegerType()),
            ("weekday", T.StringType()),
        ],
        ["start_time", *REQUIRED["time"]],
    ),
}

SCHEMAS: dict[str, T.StructType] = {
    "staging_events": EVENT_LOG,
    "staging_songs": CATALOGUE,
    "event_csv": EVENT_CSV,
    "demographics": DEMOGRAPHICS,
    "airports": AIRPORTS,
    "arrivals": ARRIVALS,
    **STAR,
}
