"""Column types of the account and post tables and of the submissions about them."""

from pyspark.sql.types import (
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

USERS = StructType(
    [
        StructField("id", LongType(), False),
        StructField("username", StringType(), False),
        StructField("password", StringType(), False),
    ]
)

POSTS = StructType(
    [
        StructField("id", LongType(), False),
        StructField("author_id", LongType(), False),
        StructField("created", TimestampNTZType(), False),
        StructField("title", StringType(), False),
        StructField("body", StringType(), False),
    ]
)

UPLOADED_AMOUNTS = StructType(
    [
        StructField("bill_id", LongType()),
        StructField("amount", DecimalType(18, 2)),
    ]
)
