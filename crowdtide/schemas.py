"""Column types of the tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

from crowdtide.fixed_values import COUNT_COLUMNS, POST_COLUMNS

RAW_POST = T.StructType([T.StructField(name, T.StringType()) for name in POST_COLUMNS])

CLEAN_POST = T.StructType(
    [
        T.StructField(name, T.LongType() if name in COUNT_COLUMNS else T.StringType())
        for name in POST_COLUMNS
    ]
)

# Written form: the parsed time and the day folder. The folder is not called
# ``date``, which would replace the column of that name when read back.
STORED_POST = T.StructType(
    CLEAN_POST.fields
    + [T.StructField("ts", T.TimestampType()), T.StructField("event_date", T.StringType())]
)

# JSON lines are read as strings, whatever the producer wrote, and cast later.
JSON_POST = T.StructType(
    RAW_POST.fields + [T.StructField("text", T.StringType()), T.StructField("ts", T.StringType())]
)

# What scoring reads of a post.
TEXT_POST = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("id", "date", "ts", "content", "text")]
)

FEATURE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("likeCount", T.LongType()),
        T.StructField("retweetCount", T.LongType()),
        T.StructField("source_hashtag", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("tf_indices", T.ArrayType(T.IntegerType())),
        T.StructField("tf_values", T.ArrayType(T.FloatType())),
        T.StructField("tf_width", T.IntegerType()),
        T.StructField("run_ts", T.TimestampType()),
    ]
)

SEEN_HASH = T.StructType(
    [T.StructField("content_hash", T.StringType()), T.StructField("seen_at", T.TimestampType())]
)

SIGNAL = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("n", T.LongType()),
        T.StructField("count", T.LongType()),
        T.StructField("mean_signal", T.DoubleType()),
        T.StructField("sem", T.DoubleType()),
        T.StructField("ci95_half", T.DoubleType()),
        T.StructField("proportion_positive", T.DoubleType()),
        T.StructField("proportion_negative", T.DoubleType()),
        T.StructField("trade_action", T.StringType()),
        T.StructField("window_start_iso", T.StringType()),
    ]
)
