"""Fixed input schemas (no inference anywhere)."""

from pyspark.sql import types as T

# The topic columns of the topic table, in file order.
TOPICS = ("games", "movies", "music")

# Fixed value: a topic counts as an interest when its frequency is at least this.
INTEREST_THRESHOLD = 3.0

EDGE_SCHEMA = T.StructType(
    [
        T.StructField("source", T.LongType(), False),
        T.StructField("destination", T.LongType(), False),
    ]
)


def topic_schema(topics=TOPICS) -> T.StructType:
    return T.StructType(
        [T.StructField("userId", T.LongType(), False)]
        + [T.StructField(t, T.DoubleType(), False) for t in topics]
    )


TOPIC_SCHEMA = topic_schema()
