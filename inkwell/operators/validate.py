"""Verdicts that need nothing but the submitted row itself.

NULL is a field that was not sent, '' one that was sent empty.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OK = "ok"
LOGIN = "login"
BAD_REQUEST = "400"
TAKEN = "taken"
NOT_CHECKED = "not checked"
# Messages.
LOGGED_IN = "You were successfully logged in"

TITLE_REQUIRED = "Title is required."
# The registration form's own messages, in the order of its checks.
REGISTRATION_FIELDS = [
    ("username", "Username is required"),
    ("password", "Password is required"),
]
POST_FIELDS = [("title", TITLE_REQUIRED)]


def any_absent(*names: str) -> Column:
    return reduce(Column.__or__, [F.col(n).isNull() for n in names])


def required_fields(
    df: DataFrame, fields: Sequence[tuple[str, str]], last_wins: bool = False
) -> DataFrame:
    """Add `error`: 400 if a field was not sent, else the message of an empty one, else NULL.

    Where several are empty the first message counts, or the last with `last_wins`.
    """
    checks = list(reversed(fields)) if last_wins else fields
    error = F.when(any_absent(*[name for name, _ in fields]), BAD_REQUEST)
    for name, message in checks:
        error = error.when(F.col(name) == "", message)
    return df.withColumn("error", error)


def require_login(df: DataFrame, user_col: str) -> DataFrame:
    """Add `outcome`: login for a row without a user, ok otherwise."""
    return df.withColumn("outcome", F.when(F.col(user_col).isNull(), LOGIN).otherwise(OK))


def literal_credentials(df: DataFrame, user: str, password: str) -> DataFrame:
    """Add `ok` and `outcome` for attempts against one fixed pair.

    The password is looked at only after the name fits, so an attempt with another
    name and no password is wrong rather than malformed.
    """
    name, given = F.col("username"), F.col("password")
    outcome = (
        F.when(name.isNull(), BAD_REQUEST)
        .when(name != user, "Invalid credentials")
        .when(given.isNull(), BAD_REQUEST)
        .when(given != password, "Invalid credentials")
        .otherwise(LOGGED_IN)
    )
    return df.withColumn("outcome", outcome).withColumn(
        "ok", F.when(F.col("outcome") != BAD_REQUEST, F.col("outcome") == LOGGED_IN)
    )


def outcome_counts(gated: DataFrame, by: str = "outcome") -> DataFrame:
    """Number of rows per outcome, or per `verdict` where an outcome names a user."""
    return gated.groupBy(by).agg(F.count("*").alias("n"))
