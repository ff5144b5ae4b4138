"""Accounts, posts and submissions derived from the given tables.

The functions on `events` work on a stream of events just as on the table.
"""

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from inkwell.sources.tables import scan_posts, scan_users


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seal(user_id: Column, password: Column) -> Column:
    """The text stored for a password in these tables: its salted digest."""
    return F.sha2(F.concat(F.lit("s"), user_id.cast("string"), F.lit("$"), password), 256)


def sealed_match(stored: Column, given: Column, user_id: Column) -> Column:
    return stored == seal(user_id, given)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_users(
        spark,
        f"{sf_dir}/customer.parquet",
        id="c_custkey",
        username="c_name",
        password="sha2(concat('s', c_custkey, '$pw', c_custkey), 256)",
    )


@F.pandas_udf(StringType())
def _pbkdf2_text(ids: pd.Series) -> pd.Series:
    def text(i: int) -> str:
        digest = hashlib.pbkdf2_hmac("sha256", f"pw{i}".encode(), f"s{i}".encode(), 10)
        return f"pbkdf2:sha256:10$s{i}${digest.hex()}"

    return ids.map(text)


def hashed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same accounts with their passwords stored as pbkdf2 hashes."""
    return users(spark, sf_dir).withColumn("password", _pbkdf2_text("id"))


def kept_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts that are not in debt; the others count as removed."""
    kept = table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    return kept.selectExpr("c_custkey as id", "c_name as username")


def removed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    return removed.selectExpr("c_custkey as id")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_posts(
        spark,
        f"{sf_dir}/orders.parquet",
        id="o_orderkey",
        author_id="o_custkey",
        created="o_orderdate",
        title="o_orderpriority",
        body="o_orderstatus",
    )


def regs(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        "ts",
        """case when event_id % 19 = 0 then null when event_id % 11 = 0 then ''
                when user_id % 2 = 0 then concat('Customer#', lpad(user_id, 9, '0'))
                else concat('New#', user_id) end as username""",
        "case when event_id % 13 = 0 then '' else concat('pw', event_id) end as password",
    )


def logins(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        "ts",
        "user_id",
        """case when event_id % 7 = 0 then concat('nobody', user_id)
                else concat('Customer#', lpad(user_id, 9, '0')) end as username""",
        "concat(case when event_id % 5 = 0 then 'bad' else 'pw' end, user_id) as password",
    )


def edits(events: DataFrame, posts: DataFrame) -> DataFrame:
    """Edits of posts from the whole table; twenty events in a row aim at the same one."""
    aim = F.expr("(event_id div 20) * 7919") % posts.agg(F.count("*")).scalar()
    target = posts.select(F.col("id").alias("target"), F.col("author_id").alias("target_author"))
    aimed = events.withColumn("target", aim)
    return aimed.join(target, "target").selectExpr(
        "event_id",
        "ts",
        "case when event_id % 10 = 0 then -1 else target end as post_id",
        """case when event_id % 17 = 0 then null when event_id % 2 = 0 then target_author
                else user_id end as actor_id""",
        "case when event_id % 9 = 0 then '' else concat('t', event_id) end as title",
        "concat('b', event_id) as body",
        "case when event_type = 'error' and event_id % 7 = 0 then 'delete' else 'update' end as op",
    )


def creates(events: DataFrame) -> DataFrame:
    return events.filter("event_type = 'purchase'").selectExpr(
        "event_id", "ts", "concat('t', event_id) as title", "'' as body", "user_id as author_id"
    )


# The clients of activities: most belong to a user, some to nobody, some are not known.
def session_acts(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        "ts",
        """case when event_id % 23 = 0 then null when event_id % 17 = 0 then concat('guest', event_id % 100)
                else concat('user', user_id) end as client_id""",
        """case event_type when 'signup' then 'login' when 'error' then 'logout'
                else 'request' end as k""",
    )


def notice_acts(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        "ts",
        """case when event_id % 23 = 0 then null when event_id % 17 = 0 then concat('guest', event_id % 100)
                else concat('user', user_id) end as client_id""",
        """case event_type when 'view' then 'view' when 'click' then 'flash_redirect'
                when 'error' then 'flash_render' when 'signup' then 'clear'
                else 'other' end as k""",
    )


def sessions(events: DataFrame) -> DataFrame:
    """Requests with the user id their session holds: none, a known one, or one since gone."""
    return events.selectExpr(
        "event_id",
        """case when event_id % 17 = 0 then null when event_id % 10 = 0 then user_id - 1000000
                else user_id end as user_id""",
    )


def viewers(events: DataFrame) -> DataFrame:
    return events.filter("event_type = 'view'").selectExpr(
        "case when event_id % 17 = 0 then null else user_id end as viewer_id"
    )


def uploads(documents: DataFrame) -> DataFrame:
    return documents.selectExpr(
        "doc_id",
        """case doc_id % 10 when 0 then '' when 1 then null when 2 then '../My  File(1).TXT'
                when 3 then 'noext' when 4 then '.txt' when 5 then 'arc.tar.gz'
                when 6 then 'photo.JPEG' else concat(source, '.pdf') end as fn""",
        "n_chars",
    )


def requests(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id",
        """case event_id % 8 when 0 then '/' when 1 then '/login'
                when 2 then concat('/user/u', user_id) when 3 then concat('/', event_id, '/update')
                when 4 then concat('/', event_id, '/delete') when 5 then '/auth/register'
                when 6 then '/x/update' else '/nope/1' end as path""",
        "case when event_type in ('purchase', 'signup') then 'POST' else 'GET' end as method",
    )


def broken_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with repeated ids, repeated and missing names, and missing passwords."""
    return table(spark, sf_dir, "customer").selectExpr(
        "case when c_custkey % 7 = 0 then c_custkey div 7 else c_custkey end as id",
        """case when c_custkey % 13 = 0 then null when c_custkey % 11 = 0 then 'everybody'
                else c_name end as username""",
        "case when c_custkey % 3 > 0 then 'pw' end as password",
    )


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as id",
        """case when c_custkey % 4 = 0 then concat('scrypt:32768:8:1$s', c_custkey, '$ab')
                else concat('pbkdf2:sha256:', (c_custkey % 3 + 1) * 50000, '$s', c_custkey, '$ab')
                end as password""",
    )


def amount_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lines of an uploaded file; the amount of a pending one is not a number."""
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey as string) as bill_id",
        """case o_orderstatus when 'P' then 'pending'
                when 'F' then concat('-', cast(o_totalprice as string))
                else cast(o_totalprice as string) end as amount""",
    )
