"""Every operator as a query over the given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from inkwell.functions import files, passwords, text, urls
from inkwell.operators import accounts, constraints, content, edits, rewrite, routes, sessions, uploads, validate
from inkwell.plans import fixtures as fx
from inkwell.sources import submissions, tables
from inkwell.sources import uploads as amounts
from inkwell.sources.scratch import freeze, scratch_path
from inkwell.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAGE_SIZE = 25
MINIMUM_ITERATIONS = 100_000
POSTS_A_RANGE = 5_000
NAME_BUCKETS = 16
KIND_OF_EVENT = StructType(
    [StructField("event_type", StringType(), False), StructField("k", StringType(), False)]
)
SITE = [*routes.BLOG_ROUTES, routes.Route("/user/<username>", "profile")]


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "events")


def _edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.edits(_events(spark, sf_dir), fx.posts(spark, sf_dir))


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits.edit_gate(
        _edits(spark, sf_dir), fx.posts(spark, sf_dir), fx.kept_users(spark, sf_dir)
    )


# Sources


@query
def scan_users(spark, sf_dir):
    return fx.users(spark, sf_dir)


@query
def scan_posts(spark, sf_dir):
    return fx.posts(spark, sf_dir)


@query
def load_inline_rows(spark, sf_dir):
    kinds = tables.load_inline_rows(
        spark,
        [
            {"event_type": "signup", "k": "login"},
            {"event_type": "error", "k": "logout"},
            {"event_type": "view", "k": "request"},
        ],
        KIND_OF_EVENT,
    )
    return _events(spark, sf_dir).join(kinds, "event_type").select("event_id", "k")


def _written_amounts(spark, sf_dir):
    path = scratch_path(spark, "amounts")
    fx.amount_lines(spark, sf_dir).write.csv(path, sep="\t")
    return amounts.read_upload_tsv(spark, path)


@query
def read_upload_tsv(spark, sf_dir):
    return _written_amounts(spark, sf_dir)


@query
def read_upload_tsv_bad_cells(spark, sf_dir):
    return amounts.bad_cells(_written_amounts(spark, sf_dir))


@query
def parse_upload_lines(spark, sf_dir):
    line = F.concat_ws("\t", "bill_id", "amount")
    cells = amounts.parse_upload_line(line).alias("cells")
    return fx.amount_lines(spark, sf_dir).select(cells).select("cells.*")


def _stream(spark, sf_dir):
    schema = _events(spark, sf_dir).schema
    return submissions.submission_stream(spark, f"{sf_dir}/events*.parquet", schema)


def _folders(spark, label):
    return scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")


@query
def submission_stream(spark, sf_dir):
    out, checkpoint = _folders(spark, "submissions")
    events = _stream(spark, sf_dir)
    events.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(out)


@query
def submission_stream_once(spark, sf_dir):
    """Every submission is delivered twice."""
    out, checkpoint = _folders(spark, "once")
    events = _stream(spark, sf_dir)
    once = submissions.delivered_once(events.unionByName(events), "1 day")
    once.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(out)


# Table changes


@query
def reset_tables(spark, sf_dir):
    path = scratch_path(spark, "site")
    full = {"user": fx.users(spark, sf_dir), "post": fx.posts(spark, sf_dir)}
    for name, rows in full.items():
        rows.write.parquet(f"{path}/{name}")

    def sizes(of, label):
        counted = [of[n].agg(F.lit(n).alias("name"), F.count("*").alias(label)) for n in of]
        return counted[0].unionByName(counted[1])

    written = {name: spark.read.parquet(f"{path}/{name}") for name in full}
    before = freeze(sizes(written, "rows_before"), "sizes")
    return before.join(sizes(tables.reset_tables(spark, path), "rows_after"), "name")


@query
def create_posts(spark, sf_dir):
    return edits.create_posts(
        fx.posts(spark, sf_dir), fx.creates(_events(spark, sf_dir)), fx.kept_users(spark, sf_dir)
    )


@query
def register_users(spark, sf_dir):
    return accounts.register_users(
        fx.users(spark, sf_dir), fx.regs(_events(spark, sf_dir)), fx.seal
    )


@query
def apply_updates(spark, sf_dir):
    return edits.apply_updates(fx.posts(spark, sf_dir), _gated(spark, sf_dir))


@query
def apply_deletes(spark, sf_dir):
    return edits.apply_deletes(fx.posts(spark, sf_dir), _gated(spark, sf_dir))


@query
def cascade_delete(spark, sf_dir):
    return edits.cascade_delete(fx.posts(spark, sf_dir), fx.removed_users(spark, sf_dir))


@query
def store_uploads(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    return uploads.store_uploads(uploads.upload_screen(fx.uploads(documents)))


# Filters and verdicts


@query
def user_by_username(spark, sf_dir):
    return accounts.user_by_username(fx.users(spark, sf_dir), fx.logins(_events(spark, sf_dir)))


@query
def user_by_id(spark, sf_dir):
    keys = _events(spark, sf_dir).select(F.col("user_id").alias("id"))
    return accounts.user_by_id(fx.users(spark, sf_dir), keys)


@query
def required_fields(spark, sf_dir):
    checked = validate.required_fields(
        fx.regs(_events(spark, sf_dir)), validate.REGISTRATION_FIELDS, last_wins=True
    )
    return checked.select("event_id", "username", "error")


@query
def required_title(spark, sf_dir):
    checked = validate.required_fields(_edits(spark, sf_dir), validate.POST_FIELDS)
    return checked.select("event_id", "title", "error")


@query
def require_login(spark, sf_dir):
    guarded = validate.require_login(fx.sessions(_events(spark, sf_dir)), "user_id")
    return guarded.select("event_id", "outcome")


@query
def owned_posts(spark, sf_dir):
    own = content.owned_posts(fx.posts(spark, sf_dir), fx.viewers(_events(spark, sf_dir)))
    return own.select("id", "title", "viewer_id")


@query
def literal_credentials(spark, sf_dir):
    attempts = fx.logins(_events(spark, sf_dir))
    checked = validate.literal_credentials(attempts, "Customer#000000007", "pw7")
    return checked.select("event_id", "ok", "outcome")


@query
def upload_screen(spark, sf_dir):
    screened = uploads.upload_screen(fx.uploads(fx.table(spark, sf_dir, "documents")))
    return screened.select("doc_id", "outcome")


@query
def feed_byline(spark, sf_dir):
    lines = content.feed_byline(content.feed(fx.posts(spark, sf_dir), fx.users(spark, sf_dir)))
    return lines.select("id", "byline")


@query
def edit_prefill(spark, sf_dir):
    return content.edit_prefill(_edits(spark, sf_dir), fx.posts(spark, sf_dir))


# Joins


@query
def feed(spark, sf_dir):
    return content.feed(fx.posts(spark, sf_dir), fx.users(spark, sf_dir))


@query
def feed_page(spark, sf_dir):
    return content.feed_page(fx.posts(spark, sf_dir), fx.users(spark, sf_dir), PAGE_SIZE)


@query
def post_by_id(spark, sf_dir):
    wanted = _edits(spark, sf_dir).select(F.col("post_id").alias("id"))
    return content.post_by_id(fx.posts(spark, sf_dir), fx.kept_users(spark, sf_dir), wanted)


@query
def current_user(spark, sf_dir):
    found = accounts.current_user(fx.sessions(_events(spark, sf_dir)), fx.users(spark, sf_dir))
    return found.select("event_id", "user_id", "username")


@query
def username_free(spark, sf_dir):
    names = fx.logins(_events(spark, sf_dir)).select("event_id", "username")
    return accounts.username_free(names, fx.users(spark, sf_dir))


@query
def orphan_posts(spark, sf_dir):
    orphans = content.orphan_posts(fx.posts(spark, sf_dir), fx.kept_users(spark, sf_dir))
    return orphans.select("id", "author_id")


@query
def login_audit(spark, sf_dir):
    audited = accounts.login_audit(
        fx.logins(_events(spark, sf_dir)), fx.users(spark, sf_dir), fx.sealed_match
    )
    return audited.select("event_id", "outcome", "uid")


@query
def edit_gate(spark, sf_dir):
    return _gated(spark, sf_dir).select("event_id", "op", "outcome", "message")


@query
def route_match(spark, sf_dir):
    return routes.route_match(fx.requests(_events(spark, sf_dir)), SITE)


@query
def route_match_table(spark, sf_dir):
    return routes.route_match_table(fx.requests(_events(spark, sf_dir)), SITE)


# Aggregates


@query
def post_count(spark, sf_dir):
    return content.post_count(fx.posts(spark, sf_dir))


@query
def outcome_counts(spark, sf_dir):
    return validate.outcome_counts(_gated(spark, sf_dir))


@query
def registration_counts(spark, sf_dir):
    return validate.outcome_counts(register_outcomes(spark, sf_dir), by="verdict")


@query
def login_counts(spark, sf_dir):
    return validate.outcome_counts(login_audit(spark, sf_dir))


@query
def upload_counts(spark, sf_dir):
    return validate.outcome_counts(upload_screen(spark, sf_dir))


@query
def credential_audit(spark, sf_dir):
    return accounts.credential_audit(fx.hashes(spark, sf_dir), MINIMUM_ITERATIONS)


@query
def constraint_checks(spark, sf_dir):
    broken = fx.broken_users(spark, sf_dir)
    return constraints.constraint_checks(
        broken, required=["id", "username", "password"], unique=["id", "username"]
    )


# Order within a client


@query
def session_timeline(spark, sf_dir):
    return sessions.session_timeline(fx.session_acts(_events(spark, sf_dir)))


@query
def notice_delivery(spark, sf_dir):
    return sessions.notice_delivery(fx.notice_acts(_events(spark, sf_dir)))


# Functions


@query
def file_extension(spark, sf_dir):
    names = fx.table(spark, sf_dir, "pages").select("page_id", "url")
    return names.select("page_id", files.file_extension(F.col("url")).alias("extension"))


@query
def clean_filename(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    return documents.select("doc_id", files.clean_filename(F.col("text")).alias("clean"))


@query
def html_escape(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text"
    )
    pages = fx.table(spark, sf_dir, "pages").select(
        F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("html").alias("text")
    )
    return documents.unionByName(pages).select(
        "kind", "id", text.html_escape(F.col("text")).alias("escaped")
    )


@query
def build_url(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents")
    params = {"username": F.col("text"), "next": F.concat(F.lit("/"), "source")}
    url = routes.url_for(SITE, "profile", params)
    return documents.select("doc_id", url.alias("url"))


@query
def path_params(spark, sf_dir):
    path = F.col("path")
    return fx.requests(_events(spark, sf_dir)).select(
        "event_id",
        urls.path_params(path, "/<int:id>/update")["id"].alias("id"),
        urls.path_params(path, "/user/<username>")["username"].alias("username"),
    )


@query
def date_text(spark, sf_dir):
    return fx.posts(spark, sf_dir).select("id", text.date_text(F.col("created")).alias("day"))


@query
def message_text(spark, sf_dir):
    names = fx.users(spark, sf_dir)
    return names.select(
        "id",
        text.taken_message(F.col("username")).alias("taken"),
        text.missing_post_message(F.col("id")).alias("missing"),
    )


@query
def verify_password(spark, sf_dir):
    stored = F.col("password")
    right = F.concat(F.lit("pw"), F.col("id").cast("string"))
    return fx.hashed_users(spark, sf_dir).select(
        "id",
        passwords.verify_password(stored, right).alias("right"),
        passwords.verify_password(stored, F.concat(right, F.lit("x"))).alias("wrong"),
    )


@query
def login_audit_hashed(spark, sf_dir):
    audited = accounts.login_audit(
        fx.logins(_events(spark, sf_dir)), fx.hashed_users(spark, sf_dir)
    )
    return audited.select("event_id", "outcome", "uid")


# Composites


@query
def register_outcomes(spark, sf_dir):
    return accounts.register_outcomes(fx.regs(_events(spark, sf_dir)), fx.users(spark, sf_dir))


@query
def posts_after(spark, sf_dir):
    events = _events(spark, sf_dir)
    return edits.posts_after(
        fx.posts(spark, sf_dir),
        _edits(spark, sf_dir),
        fx.kept_users(spark, sf_dir),
        fx.creates(events),
    )


@query
def rewrite_posts(spark, sf_dir):
    path, posts = scratch_path(spark, "ranges"), fx.posts(spark, sf_dir)
    rewrite.write_ranges(posts, path, POSTS_A_RANGE)
    batch = _edits(spark, sf_dir), fx.kept_users(spark, sf_dir), fx.creates(_events(spark, sf_dir))
    rewrite.rewrite_posts(spark, path, *batch, size=POSTS_A_RANGE)
    return rewrite.read_ranges(spark, path).drop("range")


# Streams


@query
def stream_required_fields(spark, sf_dir):
    out, checkpoint = _folders(spark, "checked")
    regs = fx.regs(_stream(spark, sf_dir))
    jobs.stream_required_fields(
        regs, validate.REGISTRATION_FIELDS, out, checkpoint, last_wins=True
    ).awaitTermination()
    schema = validate.required_fields(regs, validate.REGISTRATION_FIELDS).schema
    return spark.read.schema(schema).parquet(out).select("event_id", "username", "error")


@query
def stream_registrations(spark, sf_dir):
    out, checkpoint = _folders(spark, "accounts")
    users = fx.users(spark, sf_dir)
    regs = fx.regs(_stream(spark, sf_dir))
    jobs.stream_registrations(
        regs, users, out, checkpoint, fx.seal, buckets=NAME_BUCKETS
    ).awaitTermination()
    return jobs.registered_users(spark, users, out)


@query
def stream_apply_edits(spark, sf_dir):
    out, checkpoint = _folders(spark, "effects")
    posts = fx.posts(spark, sf_dir)
    jobs.stream_apply_edits(
        fx.edits(_stream(spark, sf_dir), posts), out, checkpoint
    ).awaitTermination()
    return jobs.current_posts(spark, posts, fx.kept_users(spark, sf_dir), out)


@query
def stream_create_posts(spark, sf_dir):
    out, checkpoint = _folders(spark, "created")
    posts, users = fx.posts(spark, sf_dir), fx.kept_users(spark, sf_dir)
    creates = fx.creates(_stream(spark, sf_dir))
    jobs.stream_create_posts(creates, posts, users, out, checkpoint).awaitTermination()
    return jobs.created_posts(spark, posts, out)


@query
def stream_sessions(spark, sf_dir):
    checkpoint = scratch_path(spark, "turns")
    jobs.stream_sessions(fx.session_acts(_stream(spark, sf_dir)), checkpoint).awaitTermination()
    return jobs.current_sessions(spark, checkpoint)
