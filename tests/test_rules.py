"""The rules of each operator on tables small enough to read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from inkwell.functions.files import clean_filename, file_extension
from inkwell.functions.passwords import hash_iterations, hash_method, password_matches
from inkwell.functions.text import html_escape
from inkwell.functions.urls import build_url, path_params, path_regex
from inkwell.operators import accounts, constraints, content, edits, routes, sessions, uploads, validate
from inkwell.schemas import POSTS, USERS
from inkwell.sources.tables import load_inline_rows, reset_tables
from inkwell.sources.uploads import bad_cells, parse_upload_line, read_upload_tsv

DAY = dt.datetime(2018, 1, 1)

# Two stored hashes with the passwords test and other.
TEST_HASH = (
    "pbkdf2:sha256:50000$TCI4GzcX$0de171a4f4dac32e3364c7ddc7c14f3e2fa61f2d17574483f7ffbb431b4acb2f"
)
OTHER_HASH = (
    "pbkdf2:sha256:50000$kJPKsz6N$d2d4784f1b030a9761f5ccaeeaca413f27f2ecb76d6168407af962ddce849f79"
)


def at(minute):
    return DAY + dt.timedelta(minutes=minute)


@pytest.fixture(scope="module")
def users(spark):
    return load_inline_rows(
        spark,
        [
            {"id": 1, "username": "test", "password": TEST_HASH},
            {"id": 2, "username": "other", "password": OTHER_HASH},
        ],
        USERS,
    )


@pytest.fixture(scope="module")
def posts(spark):
    post = {"id": 1, "author_id": 1, "created": DAY, "title": "test title", "body": "test-body"}
    return load_inline_rows(spark, [post], POSTS)


def column(df, name, by="event_id"):
    return [row[name] for row in df.orderBy(by).collect()]


def regs_of(spark, *forms):
    rows = [(i, at(i), *form) for i, form in enumerate(forms)]
    return spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, username string, password string"
    )


EDIT = "event_id long, ts timestamp_ntz, post_id long, actor_id long, title string, body string, op string"


def edits_of(spark, *changes):
    return spark.createDataFrame([(i, at(i), *change) for i, change in enumerate(changes)], EDIT)


def creates_of(spark, *forms):
    rows = [(i, at(i), *form) for i, form in enumerate(forms)]
    return spark.createDataFrame(
        rows, "event_id long, ts timestamp_ntz, author_id long, title string, body string"
    )


# Registration


def test_registration_verdicts(spark, users):
    regs = regs_of(
        spark,
        ("a", "a"),
        ("", ""),
        ("a", ""),
        ("", "x"),
        ("test", "test"),
        ("a", "again"),
        (None, "x"),
        ("x", None),
        ("   ", "x"),
        ("Test", "x"),
    )
    assert column(accounts.register_outcomes(regs, users), "outcome") == [
        "ok",
        "Password is required",
        "Password is required",
        "Username is required",
        "User test is already registered.",
        "User a is already registered.",
        "400",
        "400",
        "ok",
        "ok",
    ]


def test_invalid_rows_do_not_take_a_name(spark, users):
    regs = regs_of(spark, ("new", ""), ("new", "b"))
    assert column(accounts.register_outcomes(regs, users), "outcome") == [
        "Password is required",
        "ok",
    ]


def test_registered_users_follow_the_largest_id(spark, users):
    regs = regs_of(spark, ("c", "1"), ("b", "2"), ("test", "3"), ("c", "4"))
    table = accounts.register_users(users, regs, lambda i, p: F.concat(F.lit("sealed-"), p))
    rows = [tuple(r) for r in table.filter("id > 2").orderBy("id").collect()]
    assert rows == [(3, "c", "sealed-1"), (4, "b", "sealed-2")]


def test_first_account_gets_id_one(spark):
    nobody = spark.createDataFrame([], USERS)
    table = accounts.register_users(nobody, regs_of(spark, ("a", "a")), lambda i, p: p)
    assert [tuple(r) for r in table.collect()] == [(1, "a", "a")]


def test_first_message_wins_unless_asked_otherwise(spark):
    both = regs_of(spark, ("", ""))
    fields = validate.REGISTRATION_FIELDS
    assert column(validate.required_fields(both, fields), "error") == ["Username is required"]
    assert column(validate.required_fields(both, fields, last_wins=True), "error") == [
        "Password is required"
    ]


# Login


def test_login_verdicts(spark, users):
    logins = regs_of(
        spark,
        ("test", "test"),
        ("a", "test"),
        ("test", "a"),
        ("other", "other"),
        (None, "x"),
        ("test", None),
        ("", ""),
    )
    audited = accounts.login_audit(logins, users, tasks=2)
    assert column(audited, "outcome") == [
        "ok",
        "Incorrect username.",
        "Incorrect password.",
        "ok",
        "400",
        "400",
        "Incorrect username.",
    ]
    assert column(audited, "uid") == [1, None, None, 2, None, None, None]


def test_stored_hashes():
    assert password_matches(TEST_HASH, "test")
    assert password_matches(OTHER_HASH, "other")
    assert not password_matches(TEST_HASH, "other")
    assert not password_matches(TEST_HASH, None)
    assert not password_matches("plain", "plain")
    assert not password_matches("pbkdf2:nosuch:1$s$00", "x")
    assert not password_matches("pbkdf2:sha256:x$s$00", "x")


def test_scrypt_hash():
    import hashlib

    digest = hashlib.scrypt(b"pw", salt=b"salt", n=16, r=8, p=1).hex()
    assert password_matches(f"scrypt:16:8:1$salt${digest}", "pw")
    assert not password_matches(f"scrypt:16:8:1$salt${digest}", "no")


def test_hash_parts(spark):
    stored = [TEST_HASH, "scrypt:32768:8:1$s$ab", "sha1$s$ab", "no hash", None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stored)], "event_id long, s string")
    parts = df.select(
        "event_id", hash_method(F.col("s")).alias("m"), hash_iterations(F.col("s")).alias("n")
    )
    assert column(parts, "m") == ["pbkdf2:sha256", "scrypt", "sha1", None, None]
    assert column(parts, "n") == [50000, None, None, None, None]


def test_literal_credentials(spark):
    attempts = regs_of(
        spark, ("u", "p"), ("u", "x"), ("x", "p"), ("x", None), ("u", None), (None, "p"), (None, "x")
    )
    checked = validate.literal_credentials(attempts, "u", "p")
    assert column(checked, "ok") == [True, False, False, False, None, None, None]
    wrong = "Invalid credentials"
    assert column(checked, "outcome") == [
        validate.LOGGED_IN, wrong, wrong, wrong, "400", "400", "400"
    ]


def test_current_user(spark, users):
    held = spark.createDataFrame([(0, 1), (1, 9), (2, None)], "event_id long, user_id long")
    found = accounts.current_user(held, users)
    assert column(found, "user_id") == [1, None, None]
    assert column(found, "username") == ["test", None, None]


def test_lookups_by_key(spark, users):
    names = spark.createDataFrame([("test",), ("test",), ("Test",)], "username string")
    assert [r["id"] for r in accounts.user_by_username(users, names).collect()] == [1]
    ids = spark.createDataFrame([(2,), (7,)], "id long")
    assert [r["username"] for r in accounts.user_by_id(users, ids).collect()] == ["other"]


# Posts


def test_feed(spark, users, posts):
    rows = [
        {"id": 2, "author_id": 2, "created": at(5), "title": "b", "body": ""},
        {"id": 3, "author_id": 2, "created": DAY, "title": "c", "body": ""},
        {"id": 4, "author_id": 9, "created": at(9), "title": "orphan", "body": ""},
    ]
    table = posts.unionByName(load_inline_rows(spark, rows, POSTS))
    feed = content.feed(table, users)
    assert [r["id"] for r in feed.collect()] == [2, 1, 3]
    assert content.feed_byline(feed).collect()[1]["byline"] == "by test on 2018-01-01"
    assert [r["id"] for r in content.feed_page(table, users, 2).collect()] == [2, 1]
    assert [r["id"] for r in content.feed_page(table, users, 9).collect()] == [2, 1, 3]
    assert [r["id"] for r in content.orphan_posts(table, users).collect()] == [4]
    ids = spark.createDataFrame([(1,), (4,), (8,)], "id long")
    assert [r["id"] for r in content.post_by_id(table, users, ids).collect()] == [1]
    assert content.post_count(table).first()["n"] == 4


def test_page_goes_past_posts_without_author(spark):
    """The newest 30 posts lack an author, whatever the number of posts looked at first."""
    table = spark.range(100).selectExpr(
        "id",
        "if(id >= 70, 5, id % 3) as author_id",
        "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as created",
        "'t' as title",
        "'b' as body",
    )
    users = spark.range(3).selectExpr("id", "concat('u', id) as username", "'x' as password")
    page = content.feed_page(table, users, 3)
    assert [(r["id"], r["username"]) for r in page.collect()] == [(69, "u0"), (68, "u2"), (67, "u1")]
    assert content.feed_page(table, users.limit(0), 3).isEmpty()
    assert content.feed_page(table, users, 0).isEmpty()


def test_only_the_author_sees_the_edit_link(spark, posts):
    viewers = spark.createDataFrame([(1,), (1,), (2,), (None,)], "viewer_id long")
    own = content.owned_posts(posts, viewers).collect()
    assert [(r["id"], r["viewer_id"]) for r in own] == [(1, 1)]
    others = viewers.filter("viewer_id = 2 or viewer_id is null")
    assert content.owned_posts(posts, others).count() == 0


def test_edit_verdicts(spark, posts, users):
    changes = edits_of(
        spark,
        (1, None, "x", "y", "update"),
        (2, 1, "x", "y", "update"),
        (1, 2, "x", "y", "update"),
        (1, 1, "", "", "update"),
        (1, 1, None, "", "update"),
        (1, 1, "x", None, "update"),
        (1, 1, "updated", "", "update"),
        (1, 2, None, None, "delete"),
        (2, 1, None, None, "delete"),
        (1, None, None, None, "delete"),
        (1, 1, None, None, "delete"),
        (1, 1, "late", "", "update"),
        (1, 1, None, None, "delete"),
        (None, 1, "x", "y", "update"),
    )
    gated = edits.edit_gate(changes, posts, users)
    assert column(gated, "outcome") == [
        "login", "404", "403", "Title is required.", "400", "400", "ok",
        "403", "404", "login", "ok", "404", "404", "404",
    ]
    assert column(gated, "message")[1] == "Post id 2 doesn't exist."
    before_deletion = gated.filter("event_id < 10")
    row = edits.apply_updates(posts, before_deletion).first()
    assert (row["title"], row["body"], row["created"]) == ("updated", "", DAY)
    assert edits.apply_deletes(posts, before_deletion).count() == 1
    assert edits.apply_deletes(posts, gated).count() == 0
    assert edits.posts_after(posts, changes, users).count() == 0


def test_last_accepted_update_wins(spark, posts, users):
    changes = edits_of(
        spark,
        (1, 1, "first", "1", "update"),
        (1, 1, "second", "2", "update"),
        (1, 2, "foreign", "3", "update"),
        (1, 1, "", "4", "update"),
    )
    row = edits.posts_after(posts, changes, users).first()
    assert (row["title"], row["body"]) == ("second", "2")


def test_create(spark, posts, users):
    forms = creates_of(
        spark, (1, "created", ""), (1, "", "x"), (None, "t", "x"), (1, None, "x"),
        (1, "t", None), (2, "next", "b"), (99, "t", "b"),
    )
    added = edits.create_posts(posts, forms, users).filter("id > 1").orderBy("id").collect()
    assert [tuple(r) for r in added] == [
        (2, 1, at(0), "created", ""),
        (3, 2, at(5), "next", "b"),
    ]


def test_ids_of_deleted_posts_are_not_used_again(spark, posts, users):
    changes = edits_of(spark, (1, 1, None, None, "delete"))
    table = edits.posts_after(posts, changes, users, creates_of(spark, (2, "t", "")))
    assert [r["id"] for r in table.collect()] == [2]


def test_accounts_that_are_gone(spark, posts, users):
    changes = edits_of(
        spark, (1, 99, "x", "y", "update"), (1, 1, "x", "y", "update"), (1, 2, "x", "y", "update"),
        (1, 1, None, None, "delete"),
    )
    gated = edits.edit_gate(changes, posts, users)
    assert column(gated, "outcome") == ["login", "ok", "403", "ok"]
    without_author = users.filter("id = 2")
    gated = edits.edit_gate(changes, posts, without_author)
    assert column(gated, "outcome") == ["login", "login", "404", "login"]
    left = edits.posts_after(posts, changes, without_author)
    assert [tuple(r) for r in left.collect()] == [tuple(r) for r in posts.collect()]


def test_constraints(spark):
    rows = [(1, "a"), (1, None), (2, "a"), (None, "a"), (None, "b")]
    table = spark.createDataFrame(rows, "id long, username string")
    checks = lambda df: {
        (r["rule"], r["column"]): r["n"]
        for r in constraints.constraint_checks(df, ["id", "username"], ["id", "username"]).collect()
    }
    broken = {("required", "id"): 2, ("required", "username"): 1, ("unique", "id"): 1}
    assert checks(table) == {**broken, ("unique", "username"): 2}
    assert set(checks(table.limit(0)).values()) == {0}


def test_removed_accounts_take_their_posts_along(spark, posts):
    gone = spark.createDataFrame([(1,)], "id long")
    assert edits.cascade_delete(posts, gone).count() == 0
    assert edits.cascade_delete(posts, gone.filter("id > 1")).count() == 1


def test_prefill(spark, posts):
    changes = edits_of(
        spark, (1, 1, "", "new", "update"), (1, 1, "t", None, "update"), (5, 1, "t", "b", "update")
    )
    shown = content.edit_prefill(changes, posts).orderBy("event_id").collect()
    assert [(r["title"], r["body"]) for r in shown] == [("test title", "new"), ("t", "test-body")]


def test_anonymous_users_are_sent_to_the_login(spark):
    df = spark.createDataFrame([(0, None), (1, 5)], "event_id long, user_id long")
    assert column(validate.require_login(df, "user_id"), "outcome") == ["login", "ok"]


# Uploads


def test_upload_screen(spark):
    names = [None, "", "a.txt", ".txt", "A.PDF", "noext", "x.tar.gz", "dot.", "a.b.jpeg"]
    df = spark.createDataFrame(
        [(i, n, 10 * i) for i, n in enumerate(names)], "doc_id long, fn string, n_chars long"
    )
    screened = uploads.upload_screen(df)
    refused = "file type not allowed"
    assert column(screened, "outcome", "doc_id") == [
        "No file part", "No selected file", "ok", "ok", "ok", refused, refused, refused, "ok"
    ]
    stored = {r["clean"]: (r["doc_id"], r["n_chars"]) for r in uploads.store_uploads(screened).collect()}
    assert stored == {"a.txt": (2, 20), "txt": (3, 30), "A.PDF": (4, 40), "a.b.jpeg": (8, 80)}


def test_last_upload_of_a_clean_name_stays(spark):
    df = spark.createDataFrame(
        [(1, "my file.txt", 1), (3, "my_file.txt", 3), (2, "../my file.txt", 2)],
        "doc_id long, fn string, n_chars long",
    )
    stored = uploads.store_uploads(uploads.upload_screen(df)).collect()
    assert sorted(tuple(r) for r in stored) == [("my_file.txt", 3, 3)]


def test_clean_filename(spark):
    # Names and what the public rule makes of them.
    expected = {
        "My cool movie.mov": "My_cool_movie.mov",
        "../../../etc/passwd": "etc_passwd",
        "i contain cool \xfcml\xe4uts.txt": "i_contain_cool_umlauts.txt",
        "__filename__": "filename",
        "foo$&^*)bar": "foobar",
        "ﬁle ①.txt": "file_1.txt",
        "日本.txt": "txt",
        " a \t b ": "a_b",
        "a　b": "a_b",
        "stra\xdfe ł.png": "strae_.png",
        "": "",
    }
    df = spark.createDataFrame([(n, e) for n, e in expected.items()], "name string, wanted string")
    for row in df.withColumn("clean", clean_filename(F.col("name"))).collect():
        assert row["clean"] == row["wanted"]


def test_file_extension(spark):
    df = spark.createDataFrame(
        [(0, "a.TXT"), (1, "noext"), (2, "a."), (3, "x.tar.GZ"), (4, None)],
        "event_id long, name string",
    )
    extension = df.select("event_id", file_extension(F.col("name")).alias("e"))
    assert column(extension, "e") == ["txt", None, "", "gz", None]


def test_amount_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("16\t168\n17\t-14.5\nx\t2.25\n18\tnone\n19\t1.00")
    table = read_upload_tsv(spark, str(tmp_path / "a.txt"))
    rows = [tuple(map(str, r)) for r in table.collect()]
    assert rows == [
        ("16", "168.00"), ("17", "-14.50"), ("None", "2.25"), ("18", "None"), ("19", "1.00")
    ]
    assert tuple(bad_cells(table).first()) == (5, 1, 1)
    lines = spark.read.text(str(tmp_path / "a.txt"))
    cells = lines.select(parse_upload_line(F.col("value")).alias("c")).select("c.*")
    assert cells.collect() == table.collect()


# Tables


def test_inline_rows_are_checked(spark):
    with pytest.raises(ValueError, match="unknown"):
        load_inline_rows(spark, [{"id": 1, "question": "?"}], USERS)
    with pytest.raises(ValueError, match="without a value"):
        load_inline_rows(spark, [{"id": 1, "username": "a"}], USERS)


def test_reset_tables(spark, tmp_path, users, posts):
    path = str(tmp_path)
    users.write.parquet(f"{path}/user")
    posts.write.parquet(f"{path}/post")
    empty = reset_tables(spark, path)
    assert {name: df.count() for name, df in empty.items()} == {"user": 0, "post": 0}
    assert spark.read.parquet(f"{path}/post").columns == POSTS.fieldNames()
    reset_tables(spark, str(tmp_path / "fresh"))


# Routes and URLs


def test_routes(spark):
    requests = spark.createDataFrame(
        [
            (0, "/", "GET"), (1, "/", "POST"), (2, "/1/delete", "GET"), (3, "/1/delete", "POST"),
            (4, "/x/update", "GET"), (5, "/auth/logout", "POST"), (6, "/create", "HEAD"),
            (7, "/1/delete", "HEAD"), (8, "/1/delete", "OPTIONS"), (9, "/auth/login/", "GET"),
            (10, "/1/update\n", "GET"), (11, None, "GET"),
        ],
        "event_id long, path string, method string",
    )
    matched = routes.route_match(requests, routes.BLOG_ROUTES)
    assert column(matched, "status") == [
        200, 405, 405, 200, 404, 405, 200, 405, 200, 404, 404, 404
    ]
    assert column(matched, "endpoint")[3] == "blog.delete"


def test_other_sites(spark):
    requests = spark.createDataFrame(
        [(0, "/hello/a b", "GET"), (1, "/to_upload", "GET"), (2, "/upload", "POST"), (3, "/hello/a/b", "GET")],
        "event_id long, path string, method string",
    )
    matched = routes.route_match(requests, routes.UPLOAD_ROUTES)
    assert column(matched, "endpoint") == ["hello", "to_upload", "upload_file", None]
    login = requests.select("event_id", F.lit("/login").alias("path"), F.lit("POST").alias("method"))
    assert column(routes.route_match(login, routes.SIGN_IN_ROUTES), "status")[0] == 200
    assert column(routes.route_match(login, routes.PROFILE_ROUTES), "status")[0] == 405


def test_url_for(spark):
    def url(site, endpoint, **params):
        column = routes.url_for(site, endpoint, {k: F.lit(v) for k, v in params.items()})
        return spark.range(1).select(column).first()[0]

    assert url(routes.BLOG_ROUTES, "blog.update", id=3) == "/3/update"
    assert url(routes.BLOG_ROUTES, "index") == "/"
    assert url(routes.UPLOAD_ROUTES, "to_upload", filename="a b.txt") == "/to_upload?filename=a%20b.txt"
    assert url(routes.UPLOAD_ROUTES, "static", filename="css/a b.css") == "/static/css/a%20b.css"
    assert url(routes.PROFILE_ROUTES, "profile", username="John Doe") == "/user/John%20Doe"
    with pytest.raises(ValueError):
        routes.url_for(routes.BLOG_ROUTES, "blog.update", {})


def test_path_regex():
    assert path_regex("/<int:id>/update") == r"^/(\d+)/update\z"


def test_path_params(spark):
    df = spark.createDataFrame(
        [(0, "/7/update"), (1, "/x/update"), (2, "/99999999999999999999/update"), (3, "/-1/update")],
        "event_id long, path string",
    )
    parts = df.select("event_id", path_params(F.col("path"), "/<int:id>/update")["id"].alias("id"))
    assert column(parts, "id") == [7, None, None, None]


def test_build_url(spark):
    one = spark.range(1)

    def url(pattern, **params):
        return one.select(build_url(pattern, {k: F.lit(v) for k, v in params.items()})).first()[0]

    assert url("/") == "/"
    assert url("/login") == "/login"
    assert url("/login", next="/") == "/login?next=%2F"
    assert url("/user/<username>", username="John Doe") == "/user/John%20Doe"
    assert url("/user/<username>", username="a*b~c+d\xe9") == "/user/a%2Ab~c%2Bd%C3%A9"
    assert url("/<int:id>/update", id=1, a="x y", b="&") == "/1/update?a=x%20y&b=%26"
    assert url("/to_upload", filename=None) == "/to_upload"
    with pytest.raises(ValueError):
        url("/user/<username>")


def test_html_escape(spark):
    escaped = spark.range(1).select(html_escape(F.lit("<a href=\"x\">'&lt;'</a>"))).first()[0]
    assert escaped == "&lt;a href=&#34;x&#34;&gt;&#39;&amp;lt;&#39;&lt;/a&gt;"


# Sessions and messages


def acts_of(spark, *kinds, client=1):
    return spark.createDataFrame(
        [(i, at(i), client, k) for i, k in enumerate(kinds)],
        "event_id long, ts timestamp_ntz, client_id long, k string",
    )


def test_sessions(spark):
    acts = acts_of(
        spark, "request", "login", "request", "request", "login", "logout", "request", "login"
    )
    rows = sessions.session_timeline(acts).orderBy("seg").collect()
    assert [(r["seg"], r["started"], r["last_seen"], r["requests"]) for r in rows] == [
        (1, at(1), at(3), 2),
        (2, at(4), at(4), 0),
        (4, at(7), at(7), 0),
    ]


def test_messages(spark):
    acts = acts_of(
        spark, "flash_redirect", "other", "flash_redirect", "view", "view", "flash_render",
        "flash_redirect", "clear", "view", "flash_redirect",
    )
    delivered = {r["event_id"]: r["delivered_at"] for r in sessions.notice_delivery(acts).collect()}
    assert delivered == {0: at(3), 2: at(3), 5: at(5), 6: None, 9: None}


def test_rows_without_a_client_stand_alone(spark):
    acts = acts_of(
        spark, "login", "request", "flash_redirect", "flash_render", "view", "login", client=None
    )
    rows = sessions.session_timeline(acts).orderBy("started").collect()
    assert [tuple(r) for r in rows] == [(None, 1, at(0), at(0), 0), (None, 1, at(5), at(5), 0)]
    delivered = {r["event_id"]: r["delivered_at"] for r in sessions.notice_delivery(acts).collect()}
    assert delivered == {2: None, 3: at(3)}


def test_costly_scrypt_hash_matches():
    import hashlib

    from inkwell.functions.passwords import password_matches, scrypt_memory

    n, r, p = 1 << 18, 8, 1
    digest = hashlib.scrypt(b"pw", salt=b"s", n=n, r=r, p=p, maxmem=scrypt_memory(n, r, p)).hex()
    assert password_matches(f"scrypt:{n}:{r}:{p}$s${digest}", "pw")
    assert not password_matches(f"scrypt:{n}:{r}:{p}$s$\u00e9", "pw")


def test_missing_stored_password_lets_nobody_in(spark):
    from inkwell.operators import accounts

    users = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id long, username string, password string")
    logins = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y")], "username string, password string")
    audited = accounts.login_audit(logins, users, lambda stored, given, user: stored == given)
    assert sorted((r.username, r.password, r.outcome, r.uid) for r in audited.collect()) == [
        ("a", "x", "Incorrect password.", None),
        ("b", "x", "ok", 2),
        ("b", "y", "Incorrect password.", None),
    ]


def test_long_iteration_count(spark):
    from inkwell.functions.passwords import hash_iterations

    stored = spark.createDataFrame([("pbkdf2:sha256:12345678901$s$00",), ("pbkdf2:sha256:5$s$00",)], "s string")
    assert [r[0] for r in stored.select(hash_iterations(stored.s)).collect()] == [12345678901, 5]


def test_a_hash_too_costly_to_recompute_is_not_checked(spark):
    costly = "scrypt:16777216:8:1$s$ab"
    assert password_matches(costly, "x") is None
    assert password_matches("scrypt:16777215:8:1$s$ab", "x") is False
    users = spark.createDataFrame([(1, "a", costly), (2, "b", TEST_HASH), (3, "c", None)], "id long, username string, password string")
    rows = [(1, "a", "x"), (2, "b", "test"), (3, "b", "x"), (4, "c", "x"), (5, "nobody", "x"), (6, "a", None), (7, "b", "test")]
    logins = spark.createDataFrame(rows, "event_id long, username string, password string")
    audited = accounts.login_audit(logins, users, tasks=2)
    assert audited.columns == ["event_id", "username", "password", "outcome", "uid"]
    assert {r.event_id: (r.outcome, r.uid) for r in audited.collect()} == {
        1: ("not checked", None), 2: ("ok", 2), 3: ("Incorrect password.", None), 4: ("Incorrect password.", None),
        5: ("Incorrect username.", None), 6: ("400", None), 7: ("ok", 2),
    }
    plan = audited._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2


def test_routes_as_a_table(spark):
    paths = [
        "/", "", "//", "/create", "/create/", "/1/update", "/x/update", "/1/delete", "/1/2/update", "/static/", "/static/a", "/static/a/b.css",
        "/static//a", "/static/a\nb", "/user/u", "/user/u/", "/user/", "/a/1/b", "/a/x/b", "/a/1/1", "/a/x/x", "/a/1", "a/1", None, "/hello/é", "/=x", "/<int>",
    ]
    site = [
        *routes.BLOG_ROUTES, *routes.PROFILE_ROUTES, *routes.UPLOAD_ROUTES,
        routes.Route("/a/<int:n>/b", "int b"), routes.Route("/a/<name>/b", "any b", ("POST",)), routes.Route("/a/<name>/<int:n>", "two"),
        routes.Route("/a/1/<x>", "one", ("PUT",)), routes.Route("/a/<path:rest>", "rest"), routes.Route("/<x>", "x"), routes.Route("<x>/1", "bare"),
    ]
    rows = [(i, p, m) for i, (p, m) in enumerate((p, m) for p in paths for m in ["GET", "POST", "PUT", "HEAD", None])]
    requests = spark.createDataFrame(rows, "event_id int, path string, method string")
    expected = routes.route_match(requests, site)
    found = routes.route_match_table(requests, site)
    assert found.columns == expected.columns
    assert sorted(found.collect()) == sorted(expected.collect())
    for pattern in ("/file-<int:id>.txt", "/<path:a>/b"):
        with pytest.raises(ValueError):
            routes.route_match_table(requests, [routes.Route(pattern, "x")])


def test_thousands_of_routes_are_walked_not_tried(spark):
    site = [routes.Route(f"/shop{i % 70}/<int:a>/item{i}/<b>", f"e{i}") for i in range(5000)]
    requests = spark.range(20_000).selectExpr(
        "id as event_id", "concat('/shop', id % 70, '/', id, '/item', id % 6000, '/x') as path", "'GET' as method"
    )
    found = routes.route_match_table(requests, site)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    counts = {r.status: r["count"] for r in found.groupBy("status").count().collect()}
    expected = sum(i % 6000 < 5000 and i % 70 == (i % 6000) % 70 for i in range(20_000))
    assert counts == {200: expected, 404: 20_000 - expected}
