"""The same queries as SQL over the given tables, for an independent check."""

USERS = """users as (
  select c_custkey as id, c_name as username,
    sha256(concat('s', c_custkey, '$pw', c_custkey)) as password from customer)"""

KEPT_USERS = """kept as (
  select c_custkey as id, c_name as username from customer where c_acctbal >= 0)"""

POSTS = """posts as (
  select o_orderkey as id, o_custkey as author_id, o_orderdate as created,
    o_orderpriority as title, o_orderstatus as body from orders)"""

REGS = """regs as (
  select event_id, ts,
    case when event_id % 19 = 0 then null when event_id % 11 = 0 then ''
      when user_id % 2 = 0 then concat('Customer#', lpad(cast(user_id as varchar), 9, '0'))
      else concat('New#', user_id) end as username,
    case when event_id % 13 = 0 then '' else concat('pw', event_id) end as password
  from events)"""

LOGINS = """logins as (
  select event_id, ts, user_id,
    case when event_id % 7 = 0 then concat('nobody', user_id)
      else concat('Customer#', lpad(cast(user_id as varchar), 9, '0')) end as username,
    concat(case when event_id % 5 = 0 then 'bad' else 'pw' end, user_id) as password
  from events)"""

EDITS = """edits as (
  select event_id, ts, case when event_id % 10 = 0 then -1 else o_orderkey end as post_id,
    case when event_id % 17 = 0 then null when event_id % 2 = 0 then o_custkey
      else user_id end as actor_id,
    case when event_id % 9 = 0 then '' else concat('t', event_id) end as title,
    concat('b', event_id) as body,
    case when event_type = 'error' and event_id % 7 = 0 then 'delete' else 'update' end as op
  from events join orders
    on o_orderkey = (event_id // 20) * 7919 % (select count(*) from orders))"""

SESSIONS = """sessions as (
  select event_id,
    case when event_id % 17 = 0 then null when event_id % 10 = 0 then user_id - 1000000
      else user_id end as user_id
  from events)"""

SESSION_ACTS = """acts as (
  select event_id, ts, case when event_id % 23 = 0 then null when event_id % 17 = 0 then concat('guest', event_id % 100)
      else concat('user', user_id) end as client_id,
    case when event_id % 23 = 0 then event_id end as alone,
    case event_type when 'signup' then 'login' when 'error' then 'logout'
      else 'request' end as k
  from events)"""

NOTICE_ACTS = """acts as (
  select event_id, ts, case when event_id % 23 = 0 then null when event_id % 17 = 0 then concat('guest', event_id % 100)
      else concat('user', user_id) end as client_id,
    case when event_id % 23 = 0 then event_id end as alone,
    case event_type when 'view' then 'view' when 'click' then 'flash_redirect'
      when 'error' then 'flash_render' when 'signup' then 'clear' else 'other' end as k
  from events)"""

UPLOADS = """uploads as (
  select doc_id, n_chars,
    case doc_id % 10 when 0 then '' when 1 then null when 2 then '../My  File(1).TXT'
      when 3 then 'noext' when 4 then '.txt' when 5 then 'arc.tar.gz'
      when 6 then 'photo.JPEG' else concat(source, '.pdf') end as fn
  from documents)"""

SCREENED = """screened as (
  select *, case when fn is null then 'No file part' when fn = '' then 'No selected file'
      when instr(fn, '.') > 0 and lower(string_split(fn, '.')[-1])
        in ('txt', 'pdf', 'png', 'jpg', 'jpeg', 'gif') then 'ok'
      else 'file type not allowed' end as outcome
  from uploads)"""

REQUESTS = """requests as (
  select event_id,
    case event_id % 8 when 0 then '/' when 1 then '/login'
      when 2 then concat('/user/u', user_id) when 3 then concat('/', event_id, '/update')
      when 4 then concat('/', event_id, '/delete') when 5 then '/auth/register'
      when 6 then '/x/update' else '/nope/1' end as path,
    case when event_type in ('purchase', 'signup') then 'POST' else 'GET' end as method
  from events)"""

RULES = r"""rules(pattern, endpoint, method) as (values
  ('/static/[^/].*', 'static', 'GET'), ('/', 'blog.index', 'GET'),
  ('/auth/register', 'auth.register', 'GET'), ('/auth/register', 'auth.register', 'POST'),
  ('/auth/login', 'auth.login', 'GET'), ('/auth/login', 'auth.login', 'POST'),
  ('/auth/logout', 'auth.logout', 'GET'),
  ('/create', 'blog.create', 'GET'), ('/create', 'blog.create', 'POST'),
  ('/[0-9]+/update', 'blog.update', 'GET'), ('/[0-9]+/update', 'blog.update', 'POST'),
  ('/[0-9]+/delete', 'blog.delete', 'POST'),
  ('/user/[^/]+', 'profile', 'GET'))"""

AMOUNT_LINES = """lines as (
  select o_orderkey as bill_id,
    case o_orderstatus when 'P' then null
      when 'F' then -cast(o_totalprice as decimal(18, 2))
      else cast(o_totalprice as decimal(18, 2)) end as amount
  from orders)"""

OUTCOMES = """outcomes as (
  select event_id, username, coalesce(error,
    case when taken or place > 1 then concat('User ', username, ' is already registered.') end,
    'ok') as outcome,
    coalesce(error, case when taken or place > 1 then 'taken' end, 'ok') as verdict
  from (
    select *, username in (select username from users) as taken,
      row_number() over (partition by username, error is null order by ts, event_id) as place
    from (
      select *, case when username is null or password is null then '400'
        when password = '' then 'Password is required'
        when username = '' then 'Username is required' end as error
      from regs)))"""

AUDITED = """audited as (
  select event_id,
    case when users.id is null then 'Incorrect username.'
      when users.password <> sha256(concat('s', users.id, '$', logins.password))
      then 'Incorrect password.' else 'ok' end as outcome,
    users.id as known_id
  from logins left join users on users.username = logins.username)"""

GATED = """found as (
  select edits.*, author_id, owned.id as found_id, actor_id in (select id from kept) as known
  from edits left join (
    select id, author_id from posts where author_id in (select id from kept)) as owned
    on owned.id = edits.post_id),
numbered as (
  select *, row_number() over (order by ts, event_id) as turn from found),
gone as (
  select post_id, min(turn) as since from numbered
  where op = 'delete' and found_id is not null and actor_id = author_id group by post_id),
gated as (
  select numbered.*, case when known is not true then 'login'
      when found_id is null or turn > since then '404'
      when actor_id <> author_id then '403'
      when op = 'update' and title = '' then 'Title is required.'
      else 'ok' end as outcome
  from numbered left join gone on gone.post_id = numbered.post_id)"""

UPDATED = """last_updates as (
  select post_id, arg_max(title, turn) as title, arg_max(body, turn) as body
  from gated where op = 'update' and outcome = 'ok' group by post_id),
updated as (
  select posts.id, author_id, created, coalesce(last_updates.title, posts.title) as title,
    coalesce(last_updates.body, posts.body) as body
  from posts left join last_updates on last_updates.post_id = posts.id)"""

REMAINING = """remaining as (
  select * from updated where id not in (
    select post_id from gated where op = 'delete' and outcome = 'ok'))"""

NEW_POSTS = """new_posts as (
  select (select max(id) from posts) + row_number() over (order by ts, event_id) as id,
    user_id as author_id, ts as created, concat('t', event_id) as title, '' as body
  from events where event_type = 'purchase' and user_id in (select id from kept))"""

FEED = """feed as (
  select posts.id, title, body, created, author_id, username
  from posts join users on users.id = posts.author_id)"""

POST_COLUMNS = "id, author_id, created, title, body"

ESCAPED = """replace(replace(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'),
  '>', '&gt;'), '"', '&#34;'), '''', '&#39;')"""


def _with(*parts: str, select: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + select


def _counts(*parts: str, of: str) -> str:
    return _with(*parts, select=f"select outcome, count(*) as n from {of} group by outcome")


_registered = _with(
    USERS,
    REGS,
    OUTCOMES,
    """accepted as (
  select regs.*, row_number() over (order by ts, event_id) as place
  from regs join outcomes using (event_id) where outcome = 'ok'),
added as (
  select (select max(id) from users) + place as id, username, password from accepted)""",
    select="""select id, username, password from users union all
select id, username, sha256(concat('s', id, '$', password)) from added""",
)
_error_of_regs = _with(
    REGS,
    select="""select event_id, username, case when username is null or password is null then '400'
  when password = '' then 'Password is required'
  when username = '' then 'Username is required' end as error from regs""",
)
_audit = _with(
    USERS,
    LOGINS,
    AUDITED,
    select="""select event_id, outcome, case when outcome = 'ok' then known_id end as uid
from audited""",
)
_remaining = _with(
    KEPT_USERS, POSTS, EDITS, GATED, UPDATED, REMAINING, select=f"select {POST_COLUMNS} from remaining"
)

_created = _with(
    KEPT_USERS,
    POSTS,
    NEW_POSTS,
    select="select * from posts union all select * from new_posts",
)

ORACLES: dict[str, str] = {
    "scan_users": _with(USERS, select="select * from users"),
    "scan_posts": _with(POSTS, select="select * from posts"),
    "load_inline_rows": """select event_id, case event_type when 'signup' then 'login'
  when 'error' then 'logout' else 'request' end as k
from events where event_type in ('signup', 'error', 'view')""",
    "read_upload_tsv": _with(AMOUNT_LINES, select="select * from lines"),
    "parse_upload_lines": _with(AMOUNT_LINES, select="select * from lines"),
    "read_upload_tsv_bad_cells": _with(
        AMOUNT_LINES,
        select="""select count(*) as lines, count(*) - count(bill_id) as bad_ids,
  count(*) - count(amount) as bad_amounts from lines""",
    ),
    "submission_stream": "select * from events",
    "reset_tables": """select 'user' as name, count(*) as rows_before, cast(0 as bigint) as rows_after
from customer union all select 'post', count(*), cast(0 as bigint) from orders""",
    "create_posts": _created,
    "register_users": _registered,
    "apply_updates": _with(
        KEPT_USERS, POSTS, EDITS, GATED, UPDATED, select=f"select {POST_COLUMNS} from updated"
    ),
    "apply_deletes": _with(
        KEPT_USERS,
        POSTS,
        EDITS,
        GATED,
        select="""select * from posts where id not in (
  select post_id from gated where op = 'delete' and outcome = 'ok')""",
    ),
    "cascade_delete": _with(
        POSTS,
        select="""select posts.* from posts join customer on c_custkey = author_id
where c_acctbal >= 0""",
    ),
    "store_uploads": _with(
        UPLOADS,
        SCREENED,
        r"""named as (
  select *, regexp_replace(regexp_replace(regexp_replace(fn, '[/\s]+', '_', 'g'),
    '[^A-Za-z0-9_.-]', '', 'g'), '^[._]+|[._]+$', '', 'g') as clean
  from screened where outcome = 'ok')""",
        select="""select clean, max(doc_id) as doc_id, arg_max(n_chars, doc_id) as n_chars
from named group by clean""",
    ),
    "user_by_username": _with(
        USERS, LOGINS, select="select * from users where username in (select username from logins)"
    ),
    "user_by_id": _with(
        USERS, select="select * from users where id in (select user_id from events)"
    ),
    "required_fields": _error_of_regs,
    "required_title": _with(
        EDITS,
        select="""select event_id, title, case when title is null then '400'
  when title = '' then 'Title is required.' end as error from edits""",
    ),
    "require_login": _with(
        SESSIONS,
        select="""select event_id, case when user_id is null then 'login' else 'ok' end as outcome
from sessions""",
    ),
    "owned_posts": _with(
        POSTS,
        select="""select id, title, author_id as viewer_id from posts where author_id in (
  select user_id from events where event_type = 'view' and event_id % 17 <> 0)""",
    ),
    "literal_credentials": _with(
        LOGINS,
        select="""select event_id, username = 'Customer#000000007' and password = 'pw7' as ok,
  case when username <> 'Customer#000000007' or password <> 'pw7' then 'Invalid credentials'
    else 'You were successfully logged in' end as outcome
from logins""",
    ),
    "upload_screen": _with(UPLOADS, SCREENED, select="select doc_id, outcome from screened"),
    "feed_byline": _with(
        USERS,
        POSTS,
        FEED,
        select="""select id, concat('by ', username, ' on ', strftime(created, '%Y-%m-%d')) as byline
from feed""",
    ),
    "edit_prefill": _with(
        POSTS,
        EDITS,
        select="""select event_id, posts.id, coalesce(nullif(edits.title, ''), posts.title) as title,
  coalesce(nullif(edits.body, ''), posts.body) as body
from edits join posts on posts.id = edits.post_id""",
    ),
    "feed": _with(USERS, POSTS, FEED, select="select * from feed order by created desc, id"),
    "feed_page": _with(
        USERS, POSTS, FEED, select="select * from feed order by created desc, id limit 25"
    ),
    "post_by_id": _with(
        KEPT_USERS,
        POSTS,
        EDITS,
        select="""select posts.id, title, body, created, author_id, username
from posts join kept on kept.id = author_id
where posts.id in (select post_id from edits)""",
    ),
    "current_user": _with(
        USERS,
        SESSIONS,
        select="""select event_id, users.id as user_id, username
from sessions left join users on users.id = sessions.user_id""",
    ),
    "username_free": _with(
        USERS,
        LOGINS,
        select="""select event_id, username from logins
where username not in (select username from users)""",
    ),
    "orphan_posts": _with(
        KEPT_USERS,
        POSTS,
        select="select id, author_id from posts where author_id not in (select id from kept)",
    ),
    "login_audit": _audit,
    "login_audit_hashed": _audit,
    "edit_gate": _with(
        KEPT_USERS,
        POSTS,
        EDITS,
        GATED,
        select="""select event_id, op, outcome,
  case when outcome = '404' then concat('Post id ', post_id, ' doesn''t exist.') end as message
from gated""",
    ),
    "route_match": _with(
        REQUESTS,
        RULES,
        select="""select event_id, path, requests.method,
  max(case when requests.method = rules.method then endpoint end) as endpoint,
  case when bool_or(requests.method = rules.method) then 200
    when count(pattern) > 0 then 405 else 404 end as status
from requests left join rules on regexp_full_match(path, pattern)
group by event_id, path, requests.method""",
    ),
    "post_count": "select count(o_orderkey) as n from orders",
    "outcome_counts": _counts(KEPT_USERS, POSTS, EDITS, GATED, of="gated"),
    "registration_counts": _with(
        USERS,
        REGS,
        OUTCOMES,
        select="select verdict, count(*) as n from outcomes group by verdict",
    ),
    "login_counts": _counts(USERS, LOGINS, AUDITED, of="audited"),
    "upload_counts": _counts(UPLOADS, SCREENED, of="screened"),
    "credential_audit": """select method, iterations, count(*) as n,
  count(case when iterations < 100000 then 1 end) as weak
from (select case when c_custkey % 4 = 0 then 'scrypt' else 'pbkdf2:sha256' end as method,
        case when c_custkey % 4 <> 0 then cast((c_custkey % 3 + 1) * 50000 as bigint) end as iterations
      from customer)
group by method, iterations""",
    "constraint_checks": """with broken as (
  select case when c_custkey % 7 = 0 then c_custkey // 7 else c_custkey end as id,
    case when c_custkey % 13 = 0 then null when c_custkey % 11 = 0 then 'everybody'
      else c_name end as username,
    case when c_custkey % 3 > 0 then 'pw' end as password
  from customer)
select 'required' as rule, 'id' as column, count(*) - count(id) as n from broken
union all select 'required', 'username', count(*) - count(username) from broken
union all select 'required', 'password', count(*) - count(password) from broken
union all select 'unique', 'id', count(id) - count(distinct id) from broken
union all select 'unique', 'username', count(username) - count(distinct username) from broken""",
    "session_timeline": _with(
        SESSION_ACTS,
        """numbered as (
  select *, cast(sum(case when k in ('login', 'logout') then 1 else 0 end) over (
      partition by client_id, alone order by ts, event_id
      rows between unbounded preceding and current row) as bigint) as seg
  from acts)""",
        select="""select client_id, seg, min(ts) as started, max(ts) as last_seen,
  count(case when k = 'request' then 1 end) as requests
from numbered group by client_id, alone, seg having bool_or(k = 'login')""",
    ),
    "notice_delivery": _with(
        NOTICE_ACTS,
        """segments as (
  select *, sum(case when k = 'clear' then 1 else 0 end) over (
      partition by client_id, alone order by ts, event_id
      rows between unbounded preceding and current row) as seg
  from acts),
shown as (
  select *, min(case when k in ('view', 'flash_render') then ts end) over (
      partition by client_id, alone, seg order by ts, event_id
      rows between current row and unbounded following) as delivered_at
  from segments)""",
        select="""select event_id, delivered_at from shown
where k in ('flash_redirect', 'flash_render')""",
    ),
    "file_extension": """select page_id,
  case when instr(url, '.') > 0 then lower(string_split(url, '.')[-1]) end as extension
from pages""",
    "clean_filename": r"""select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  strip_accents(text), '[^\x00-\x7F]', '', 'g'), '[/\s]+', '_', 'g'),
  '[^A-Za-z0-9_.-]', '', 'g'), '^[._]+|[._]+$', '', 'g') as clean
from documents""",
    "html_escape": f"""select 'document' as kind, doc_id as id, {ESCAPED.format('text')} as escaped
from documents union all
select 'page', page_id, {ESCAPED.format('html')} from pages""",
    "build_url": """select doc_id, concat('/user/', url_encode(text), '?next=',
  url_encode(concat('/', source))) as url from documents""",
    "path_params": _with(
        REQUESTS,
        select="""select event_id,
  try_cast(nullif(regexp_extract(path, '^/([0-9]+)/update$', 1), '') as bigint) as id,
  nullif(regexp_extract(path, '^/user/([^/]+)$', 1), '') as username
from requests""",
    ),
    "date_text": "select o_orderkey as id, strftime(o_orderdate, '%Y-%m-%d') as day from orders",
    "message_text": """select c_custkey as id,
  concat('User ', c_name, ' is already registered.') as taken,
  concat('Post id ', c_custkey, ' doesn''t exist.') as missing from customer""",
    "register_outcomes": _with(USERS, REGS, OUTCOMES, select="select * from outcomes"),
    "posts_after": _with(
        KEPT_USERS,
        POSTS,
        EDITS,
        GATED,
        UPDATED,
        REMAINING,
        NEW_POSTS,
        select=f"""select {POST_COLUMNS} from remaining union all
select {POST_COLUMNS} from new_posts""",
    ),
    "stream_required_fields": _error_of_regs,
    "stream_registrations": _registered,
    "stream_create_posts": _created,
    "stream_apply_edits": _remaining,
    "stream_sessions": _with(
        SESSION_ACTS,
        select="""select client_id, max(ts) as since from (
  select *, row_number() over (partition by client_id order by ts desc, event_id desc) as place
  from acts where client_id is not null and k in ('login', 'logout'))
where place = 1 and k = 'login' group by client_id""",
    ),
    # The hash itself has no SQL function; every account's own password must match.
    "verify_password": "select c_custkey as id, true as right, false as wrong from customer",
}
# The same results by another way: a table changed in place, routes as a table, every event delivered twice.
ORACLES["route_match_table"] = ORACLES["route_match"]
ORACLES["submission_stream_once"] = ORACLES["submission_stream"]
ORACLES["rewrite_posts"] = ORACLES["posts_after"]
