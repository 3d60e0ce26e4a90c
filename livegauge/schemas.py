"""Table schemas. Times at rest are TIMESTAMP_NTZ in UTC; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


_TEXT, _COUNT, _TIME = T.StringType(), T.LongType(), T.TimestampNTZType()

CHANNELS = _table(
    ("name", _TEXT), ("platform", _TEXT), ("link", _TEXT), ("big_stream", _TEXT), ("actual", _TEXT)
)
OBSERVATIONS = _table(("name", _TEXT), ("online", _COUNT), ("link", _TEXT), ("datetime", _TIME))
DIFFS = _table(
    ("name", _TEXT),
    ("online", _COUNT),
    ("online_diff", _COUNT),
    ("link", _TEXT),
    ("platform", _TEXT),
    ("datetime", _TIME),
)
# Differences of all history, kept by the date of their bucket.
BACKFILL = T.StructType(DIFFS.fields + [T.StructField("bucket", _TIME, True)])
REPORTS = _table(("datetime", _TIME), ("chat_message_id", _TEXT), ("message", _TEXT))
CELLS = _table(("name", _TEXT), ("link", _TEXT), ("bucket", _TIME), ("online", _COUNT))
# The newest two snapshots of a stream, with the newest time of an observation in each cell.
SNAPSHOTS = T.StructType(CELLS.fields + [T.StructField("newest", _TIME, True)])
# Live pages that gave no observation, and why.
REJECTS = _table(
    ("name", _TEXT), ("url", _TEXT), ("link", _TEXT), ("count_text", _TEXT), ("reason", _TEXT), ("datetime", _TIME)
)
# Moments per name and day; the day is the partition.
DAILY = _table(
    ("name", _TEXT), ("n", _COUNT), ("n_online", _COUNT), ("mean", T.DoubleType()),
    ("variance", T.DoubleType()), ("day", T.DateType()),
)
LINES = _table(("datetime", _TIME), ("section", _TEXT), ("position", _COUNT), ("line", _TEXT))
PAGES = _table(("name", _TEXT), ("url", _TEXT), ("html", _TEXT))
REPLIES = _table(("login", _TEXT), ("body", _TEXT))
# The same as a landing folder holds them: with the time at which each was fetched.
LANDED_PAGES = T.StructType(PAGES.fields + [T.StructField("landed", _TIME, True)])
LANDED_REPLIES = T.StructType(REPLIES.fields + [T.StructField("landed", _TIME, True)])

# One API reply: {"data": [{"viewer_count": 7}]}
REPLY_BODY = T.StructType(
    [
        T.StructField(
            "data",
            T.ArrayType(T.StructType([T.StructField("viewer_count", T.LongType(), True)])),
            True,
        )
    ]
)
