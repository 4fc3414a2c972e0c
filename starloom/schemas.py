"""Column contracts of the raw inputs and of the two star schemas.

The names and types are fixed by the data these jobs have to read and by the
tables their users query; they are stated here once.
"""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def contract(columns: str) -> T.StructType:
    """``"name type, name type"`` as a schema; works before a session exists."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# -- raw inputs ------------------------------------------------------------

ACTIVITY_LOG = contract(
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId int, song string, status int, ts bigint, "
    "userAgent string, userId string"
)

SONG_METADATA = contract(
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, "
    "duration double, year int"
)

# order of the columns in the event files; the header of each file repeats it
EVENT_CSV = contract(
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration string, sessionId int, song string, status int, ts string, "
    "userId int"
)
EVENT_CSV_KEPT = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length",
    "level", "location", "sessionId", "song", "userId",
]

ARRIVALS = contract(
    "cicid double, i94yr double, i94mon double, i94cit double, i94res double, i94port string, "
    "arrdate double, i94mode double, i94addr string, depdate double, i94bir double, "
    "i94visa double, airline string, fltno string, visatype string, gender string"
)

TEMPERATURES = contract(
    "dt string, AverageTemperature string, AverageTemperatureUncertainty string, "
    "State string, Country string"
)

DEMOGRAPHICS_COUNTS = [
    "Male_Population", "Female_Population", "Total_Population", "Number_of_Veterans", "Foreign_born",
]

# -- music star ------------------------------------------------------------

SONGPLAYS = contract(
    "songplay_id string, start_time timestamp, user_id int, level string, song_id string, "
    "artist_id string, session_id int, location string, user_agent string"
)
USERS = contract("user_id int, first_name string, last_name string, gender string, level string")
SONGS = contract("song_id string, title string, artist_id string, year int, duration double")
ARTISTS = contract(
    "artist_id string, name string, location string, latitude double, longitude double"
)
TIME = contract(
    "start_time timestamp, hour int, day int, week int, month int, year int, weekday string"
)

MUSIC_STAR = {
    "songplays": SONGPLAYS, "users": USERS, "songs": SONGS, "artists": ARTISTS, "time": TIME,
}
MUSIC_KEYS = {
    "songplays": ["songplay_id"],
    "users": ["user_id"],
    "songs": ["song_id"],
    "artists": ["artist_id"],
    "time": ["start_time"],
}
MUSIC_REFERENCES = [
    ("songplays", "user_id", "users"),
    ("songplays", "song_id", "songs"),
    ("songplays", "artist_id", "artists"),
    ("songplays", "start_time", "time"),
]

# -- arrivals star ---------------------------------------------------------

ARRIVALS_STAR = [
    "immigrations_table", "date_table", "cities_table", "states_table",
    "us_state_temperatures_table", "country_temperatures_table",
]

# -- query-shaped tables of the event log ----------------------------------

LOOKUP_TABLES = {
    "songInfo": {
        "columns": contract("sessionId int, itemInSession int, artist string, song string, length float"),
        "partition_key": ["sessionId"], "clustering": ["itemInSession"],
    },
    "sessionInfo": {
        "columns": contract(
            "userId int, sessionId int, itemInSession int, artist string, song string, "
            "firstName string, lastName string"
        ),
        "partition_key": ["userId", "sessionId"], "clustering": ["itemInSession"],
    },
    "userInfo": {
        "columns": contract("song string, userId int, firstName string, lastName string"),
        "partition_key": ["song"], "clustering": ["userId"],
    },
}
