"""Registration, login and the account table."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.passwords import hash_iterations, hash_method, verify_password
from inkwell.functions.text import taken_message
from inkwell.operators.ids import dense_ids, next_id
from inkwell.operators.validate import (
    BAD_REQUEST,
    NOT_CHECKED,
    OK,
    REGISTRATION_FIELDS,
    TAKEN,
    any_absent,
    required_fields,
)


def user_by_username(users: DataFrame, keys: DataFrame) -> DataFrame:
    """The accounts whose username is among `keys`, each once however often it is asked for."""
    return users.join(keys.select("username").distinct(), "username", "left_semi")


def user_by_id(users: DataFrame, keys: DataFrame) -> DataFrame:
    """The accounts whose id is among `keys`."""
    return users.join(keys.select("id").distinct(), "id", "left_semi")


def username_free(names: DataFrame, users: DataFrame) -> DataFrame:
    """The rows of `names` whose username no account has."""
    return names.join(users.select("username"), "username", "left_anti")


def _checked(regs: DataFrame) -> DataFrame:
    return required_fields(regs, REGISTRATION_FIELDS, last_wins=True)


def first_registrations(regs: DataFrame, users: DataFrame, *payload: str) -> DataFrame:
    """For each free username the first valid submission: username, ts, event_id, `payload`.

    Invalid rows leave before the grouping, and each task keeps only its own first
    row per name, so a name that everybody wants is no larger than any other.
    """
    first = (
        _checked(regs)
        .filter(F.col("error").isNull())
        .groupBy("username")
        .agg(F.min(F.struct("ts", "event_id", *payload)).alias("first"))
        .select("username", "first.*")
    )
    return username_free(first, users)


def register_outcomes(regs: DataFrame, users: DataFrame) -> DataFrame:
    """Verdict of every registration, given the accounts that exist beforehand.

    A valid row is ok exactly if it is the first for a free name, so the verdict is
    looked up by event_id, which is spread evenly whatever the names are. `verdict` is
    the outcome with 'taken' for the message that holds the name.
    """
    winners = first_registrations(regs, users).select("event_id", F.lit(True).alias("won"))
    decided = F.coalesce("error", F.when(F.col("won"), OK))
    outcome = F.coalesce(decided, taken_message(F.col("username")))
    verdict = F.coalesce(decided, F.lit(TAKEN))
    return (
        _checked(regs)
        .join(winners, "event_id", "left")
        .select("event_id", "username", outcome.alias("outcome"), verdict.alias("verdict"))
    )


def register_users(
    users: DataFrame, regs: DataFrame, seal: Callable[[Column, Column], Column]
) -> DataFrame:
    """`users` with the accepted registrations added under the next free ids.

    `seal(id, password)` gives the text to store for a password.
    """
    accepted = first_registrations(regs, users, "password")
    added = dense_ids(accepted, ["ts", "event_id"], next_id(users))
    return users.unionByName(
        added.select("id", "username", seal(F.col("id"), F.col("password")).alias("password"))
    )


def login_audit(
    logins: DataFrame,
    users: DataFrame,
    matches: Callable[[Column, Column, Column], Column] | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Add `outcome` and, for a successful login, `uid` to every attempt.

    `matches(stored, given, user_id)` decides about a password; by default stored hashes
    are recomputed. That is slow enough for the distinct attempts alone to meet the accounts
    and to be dealt out evenly over `tasks`; every attempt then looks up its verdict. An
    attempt on a hash too costly to recompute is neither right nor wrong but not checked.
    """
    known = users.select(
        F.col("id").alias("known_id"), "username", F.col("password").alias("stored")
    )
    if matches is None:
        tasks = tasks or int(logins.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tried = logins.select("username", "password").dropna().distinct().join(known, "username").repartition(tasks)
        verified = tried.withColumn("matching", verify_password(F.col("stored"), F.col("password")))
        told = verified.select(
            "username", "password", "known_id", "matching", F.col("matching").isNull().alias("unchecked")
        )
        attempts = logins.join(told, ["username", "password"], "left")
    else:
        matching = matches(F.col("stored"), F.col("password"), F.col("known_id"))
        attempts = logins.join(known, "username", "left").withColumn("matching", matching)
        attempts = attempts.withColumn("unchecked", F.lit(False))
    return (
        attempts.withColumn(
            "outcome",
            F.when(any_absent("username", "password"), BAD_REQUEST)
            .when(F.col("known_id").isNull(), "Incorrect username.")
            .when(F.col("unchecked"), NOT_CHECKED)
            # A check that gives no answer, as for a missing stored password, lets nobody in.
            .when(~F.coalesce("matching", F.lit(False)), "Incorrect password.")
            .otherwise(OK),
        )
        .withColumn("uid", F.when(F.col("outcome") == OK, F.col("known_id")))
        .select(*logins.columns, "outcome", "uid")
    )


def current_user(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions with the account they belong to; one whose account is gone is anonymous."""
    known = users.select(F.col("id").alias("user_id"), "username", F.col("id").alias("found"))
    return (
        sessions.join(known, "user_id", "left")
        .withColumn("user_id", F.col("found"))
        .drop("found")
    )


def credential_audit(hashes: DataFrame, minimum: int) -> DataFrame:
    """Accounts per hash method and iteration count, and how many stay below `minimum`."""
    stored = F.col("password")
    return (
        hashes.select(
            hash_method(stored).alias("method"), hash_iterations(stored).alias("iterations")
        )
        .groupBy("method", "iterations")
        .agg(F.count("*").alias("n"), F.count_if(F.col("iterations") < minimum).alias("weak"))
    )
