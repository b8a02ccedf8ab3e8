"""Input and target schemas. Field names and types are fixed values of the data sets."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(18,0)": T.DecimalType(18, 0),
}


def _struct(fields: str) -> T.StructType:
    """Schema from ``name type, ...``; unlike DDL parsing this needs no session."""
    pairs = [field.split() for field in fields.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# As the files carry them: userId is text there, and empty for a logged-out visitor.
RAW_EVENTS = _struct(
    "artist string, auth string, firstName string, gender string, itemInSession bigint, "
    "lastName string, length double, level string, location string, method string, page string, "
    "registration double, sessionId bigint, song string, status bigint, ts bigint, "
    "userAgent string, userId string"
)
RAW_SONGS = _struct(
    "num_songs bigint, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, duration double, "
    "year bigint"
)

STAGED_EVENTS = _struct(
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, page string, "
    "registration double, sessionId int, song string, status smallint, ts bigint, "
    "userAgent string, userId int"
)
STAGED_SONGS = _struct(
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, duration double, "
    "year smallint"
)

# The CSV export has no userAgent and keeps the columns in this order.
CSV_EVENTS = _struct(
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, page string, "
    "registration double, sessionId int, song string, status smallint, ts double, userId int"
)

SONGS = _struct("song_id string, title string, artist_id string, year smallint, duration double")
ARTISTS = _struct(
    "artist_id string, name string, location string, latitude double, longitude double"
)
USERS = _struct("user_id int, first_name string, last_name string, gender string, level string")
TIME = _struct(
    "start_time timestamp_ntz, hour int, day int, week int, month int, year int, weekday int"
)
SONGPLAYS = _struct(
    "songplay_id string, start_time timestamp_ntz, user_id int, level string, song_id string, "
    "artist_id string, session_id int, location string, user_agent string"
)

SONG_SESSION_HISTORY = _struct(
    "session_id int, item_in_session int, artist string, song string, length double"
)
USER_ARTIST_HISTORY = _struct(
    "user_id int, session_id int, item_in_session int, artist string, song string, "
    "first_name string, last_name string"
)
USER_SONG_HISTORY = _struct("song string, user_id int, first_name string, last_name string")

_BASE = {"songs": SONGS, "artists": ARTISTS, "users": USERS, "time": TIME, "songplays": SONGPLAYS}

# Where a variant stores another type than the common schema.
_OVERRIDES = {
    "lake": {},
    "warehouse": {"songplays": {"songplay_id": "bigint"}},
    "scheduled": {
        "songs": {"duration": "decimal(18,0)"},
        "artists": {"latitude": "decimal(18,0)", "longitude": "decimal(18,0)"},
        "time": {"month": "string", "weekday": "string"},
    },
    "relational": {
        "songplays": {"songplay_id": "bigint", "start_time": "bigint"},
        "time": {"start_time": "bigint"},
    },
}


def targets(variant: str) -> dict[str, T.StructType]:
    """Target schemas by table name."""
    def fields(table: str, schema: T.StructType) -> list[str]:
        changed = _OVERRIDES[variant].get(table, {})
        return [f"{f.name} {changed.get(f.name, f.dataType.simpleString())}" for f in schema]

    return {table: _struct(", ".join(fields(table, s))) for table, s in _BASE.items()}


# Primary keys and mandatory columns of the targets.
KEYS = {
    "songs": ["song_id"],
    "artists": ["artist_id"],
    "users": ["user_id"],
    "time": ["start_time"],
    "songplays": ["songplay_id"],
    "song_session_history": ["session_id", "item_in_session"],
    "user_artist_history": ["user_id", "session_id", "item_in_session"],
    "user_song_history": ["song", "user_id"],
}

# What the targets of a variant enforce beyond their keys: no two rows agree in these columns, NULLs
# apart.
UNIQUE = {
    "relational": {
        "songplays": ["start_time", "user_id", "song_id"],
        "users": ["user_id"],
        "songs": ["song_id"],
        "artists": ["artist_id"],
        "time": ["start_time"],
    },
}

# Columns that the target tables of a variant require beyond their keys. ``lake`` writes files, which
# require none.
MANDATORY = {
    "lake": {},
    "warehouse": {
        "songplays": ["user_id", "song_id", "artist_id", "session_id", "start_time", "level", "location",
                      "user_agent"],
        "users": ["level"],
        "songs": ["title", "artist_id", "year", "duration"],
        "time": ["hour", "day", "week", "month", "year", "weekday"],
    },
    "scheduled": {
        "songplays": ["songplay_id", "start_time", "user_id"],
        "users": ["user_id"],
        "songs": ["song_id"],
        "artists": ["artist_id"],
        "time": ["start_time"],
    },
    "relational": {
        "songplays": ["start_time", "user_id", "level", "session_id", "location", "user_agent"],
        "users": ["user_id", "first_name", "last_name", "gender", "level"],
        "songs": ["song_id", "title", "artist_id", "year", "duration"],
        "artists": ["artist_id", "name", "location", "latitude", "longitude"],
        "time": ["start_time", "hour", "day", "week", "month", "year", "weekday"],
    },
}

# The longest text that a column of a variant's targets takes: in bytes of UTF-8 for ``warehouse`` and
# ``scheduled``, in characters for ``relational``.
LENGTHS = {
    "lake": {},
    "warehouse": {
        "songplays": {"song_id": 100, "artist_id": 100, "level": 100, "location": 200, "user_agent": 1000},
        "users": {"first_name": 100, "last_name": 100, "gender": 1, "level": 100},
        "songs": {"song_id": 256, "title": 256, "artist_id": 256},
        "artists": {"artist_id": 256, "name": 256, "location": 256},
    },
    "scheduled": {
        "songplays": {"songplay_id": 32, "level": 256, "song_id": 256, "artist_id": 256, "location": 256,
                      "user_agent": 256},
        "users": {"first_name": 256, "last_name": 256, "gender": 256, "level": 256},
        "songs": {"song_id": 256, "title": 256, "artist_id": 256},
        "artists": {"artist_id": 256, "name": 256, "location": 256},
        "time": {"month": 256, "weekday": 256},
    },
    "relational": {"users": {"gender": 1}},
}
LENGTH_IN_BYTES = {"warehouse": True, "scheduled": True, "relational": False, "lake": False}
