"""SQL twins, for DuckDB."""

from inkwell.llm import secret_scan as secrets

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

CHAT = r"""
with said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped as (
    select *, regexp_replace(replace(text, '\', '\\'),
        '([\[<])(/?INST\]|/?s>|<SYS>>|</SYS>>|<:>>)', '\1\\\2', 'g') as shown,
        regexp_replace(replace(role, '\', '\\'),
        '([\[<])(/?INST\]|/?s>|<SYS>>|</SYS>>|<:>>)', '\1\\\2', 'g') as shown_role
    from said
)
select conv_id,
    count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    sum(length(shown) + case role when 'user' then 13 when 'assistant' then 7 else 20 + length(shown_role) end)::bigint
        as formatted_chars
from escaped
group by conv_id
"""

MIXING = rf"""
with sized as (
    select doc_id, source, {WORDS}::bigint as size, md5(coalesce(doc_id::varchar, '')) as key from documents
), sources as (
    select source, sum(size)::bigint as source_size from sized group by source
), weighted as (
    select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight,
        (sum(source_size) over ())::bigint as total from sources
), steps as (
    select *, 3 * source_size as most,
        coalesce(sum(3 * source_size) over (order by source_size / weight, source nulls last
            rows between unbounded preceding and 1 preceding), 0)::bigint as before,
        (sum(weight) over (order by source_size / weight, source nulls last
            rows between current row and unbounded following))::bigint as weight_left
    from weighted
), bounds as (
    select *, most * weight_left <= weight * (total - before) as bound from steps
), targets as (
    select source, source_size, case when bound then most::double else
        weight::double * (total - (select coalesce(sum(most), 0)::bigint from bounds where bound))
        / (select sum(weight)::bigint from bounds where not bound) end as target
    from bounds
), summed as (
    select s.*, t.source_size, t.target,
        sum(size) over (partition by s.source order by key, size rows unbounded preceding) - size as before,
        case when t.source_size > 0 then floor(t.target)::bigint // t.source_size else 0 end as epochs
    from sized s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
    (epochs * size + greatest(0, least(size, floor(target)::bigint - epochs * source_size - before)))::bigint as taken
from summed
"""


def _found(kind: str, pattern: str, least: int, group: int = 0) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
    select doc_id, row, {secrets.KINDS.index(kind)} as kind, i,
        length(list_extract(pieces, i)) as gap, length(list_extract(found, i)) as length,
        length(list_extract(part, i)) >= {least} as ok, list_extract(found, i) as value
    from (select doc_id, row, string_split_regex(text, '{quoted}') as pieces,
            regexp_extract_all(text, '{quoted}', 0) as found,
            regexp_extract_all(text, '{quoted}', {group}) as part from docs) x,
        unnest(range(1, len(found) + 1)) as n(i)"""


_unsampled = "value"
for _sample in secrets.SAMPLES:
    _unsampled = f"replace({_unsampled}, '{_sample}', repeat(chr(1), {len(_sample)}))"

SECRETS = rf"""
with docs as (
    select doc_id, row_number() over () as row, coalesce(text, '') as text from documents
), found as ({" union all ".join([
    _found("assign", secrets.ASSIGN, secrets.LEAST_ASSIGN, 2),
    _found("access", secrets.ACCESS, secrets.LEAST_ACCESS),
    _found("hex", secrets.HEX, secrets.LEAST_HEX),
    *(_found(k, p, secrets.WINDOW) for k, p in secrets.CANDIDATES.items()),
])}
), placed as (
    select *, sum(gap + length) over (partition by row, kind order by i)::bigint as stop from found
), spans as (
    select row, kind, stop - length as start, stop from placed where kind < 3 and ok
), chars as (
    select row, kind, stop - length as start, pos, substr({_unsampled}, pos::int + 1, 1) as ch
    from placed, unnest(range(length)) as n(pos)
    where kind >= 3 and not regexp_matches(value, '{secrets.ALLOWED}') and regexp_matches(value, '{secrets.NOT_WORDS}')
), windows as (
    select a.row, a.kind, a.start, a.pos, (
        select case when bool_or(ch = chr(1)) then null
            else sum([{", ".join(str(sum(map(secrets.gain, range(1, c + 1)))) for c in range(1, secrets.WINDOW + 1))}][c]) end
        from (select ch, count(*) as c from chars b where b.row = a.row and b.kind = a.kind and b.start = a.start
            and b.pos between a.pos and a.pos + {secrets.WINDOW - 1} group by b.ch)) as s
    from (select *, max(pos) over (partition by row, kind, start) as final from chars) a
    where a.pos <= a.final - {secrets.WINDOW - 1}
), hot as (
    select row, kind, start + min(pos) as start, start + max(pos) + {secrets.WINDOW} as stop from windows
    where s <= case kind when 3 then {secrets.most_sum("entropy_base64")} else {secrets.most_sum("entropy_hex")} end
    group by row, kind, start
), everything as (
    select *, {list(secrets.KINDS)}[kind + 1] || ':' || start || ':' || stop as span
    from (select * from spans union all select * from hot)
)
select d.doc_id,
    count(*) filter (where kind = 0) as n_assign,
    count(*) filter (where kind = 1) as n_access,
    count(*) filter (where kind = 2) as n_hex,
    sha256(coalesce(string_agg(span, ',' order by start, kind) filter (where kind < 3), '')) as base_sha256,
    coalesce(string_agg(span, ',' order by start, kind), '') as spans
from docs d left join everything e on d.row = e.row
group by d.row, d.doc_id
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TOKENS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
with docs as (
    select doc_id, row_number() over () as row, {TOKENS} as words from documents
), items as (
    select item_id::varchar as item, {TOKENS} as words from benchmark
), windows as (
    select distinct item, least(10, len(words)) as n, array_to_string(words[start:start + 9], ' ') as said
    from items, unnest(range(1, greatest(1, len(words) - 9) + 1)) as s(start) where len(words) > 0
), lengths as (
    select distinct n from windows
), places as (
    select row, l.n, start, array_to_string(words[start:start + l.n - 1], ' ') as said
    from docs, lengths l, unnest(range(1, len(words) - l.n + 2)) as s(start) where len(words) >= l.n
), found as (
    select p.row, p.start, p.n, w.item from places p join windows w on p.n = w.n and p.said = w.said
), hits as (
    select row, count(distinct place) as n_hit
    from (select distinct row, start, n from found) f, unnest(range(start, start + n)) as u(place) group by row
), listed as (
    select row, count(distinct item) as n_items,
        string_agg(distinct item, ',' order by item) as items from found group by row
)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
    coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (row) left join listed using (row)
"""

# crc32 half a byte at a time: what each value of four bits adds.
CRC_STEPS = []
for _step in range(16):
    for _ in range(4):
        _step = _step >> 1 ^ (0xEDB88320 if _step & 1 else 0)
    CRC_STEPS.append(_step)


def crc32(text: str) -> str:
    """crc32 of the UTF-8 bytes of an SQL text that is not empty; the low half of a byte goes first."""
    digits = f"hex(encode({text}))"
    halves = (
        f"list_transform(range(1, length({digits}) + 1), lambda i: "
        f"instr('0123456789ABCDEF', substr({digits}, i + 2 * (i % 2)::int - 1, 1)) - 1)"
    )
    step = f"lambda c, x: xor(list_extract({CRC_STEPS}::bigint[], (xor(c, x) & 15)::int + 1), c >> 4)"
    return f"xor(list_reduce({halves}, {step}, 4294967295::bigint), 4294967295)"


SPELLING = rf"""
with runs as (
    select coalesce(doc_id::varchar, '') as doc, unnest(regexp_extract_all({LOWERED}, '[a-z\x{{C0}}-\x{{FF}}]+')) as run
    from documents
), hashed as (
    select run, count(*) as times, {crc32("doc || ':' || run")} as h from runs group by doc, run
), words as (
    select case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
        else run end as word, sum(times)::bigint as n
    from hashed group by 1 having length(word) >= 5 and n >= 3
), places as (
    select word, unnest(range(1, length(word) + 1)) as place from words
), shorter as (
    select word, place, substr(word, 1, place - 1) || substr(word, place + 1) as rest from places
), near as (
    select a.word, b.word as other from shorter a join shorter b on a.rest = b.rest and a.place = b.place and a.word <> b.word
    union select s.word, s.rest from shorter s join words w on w.word = s.rest
    union select s.rest, s.word from shorter s join words w on w.word = s.rest
), best as (
    select near.word, count(*) over (partition by near.word) as n_near, other, o.n as other_n,
        row_number() over (partition by near.word order by o.n desc, other) as k
    from near join words o on o.word = other
), formed as (
    select w.word, w.n, coalesce(n_near, 0)::bigint as n_near, case when other_n >= 2 * w.n then other end as form,
        case when other_n >= 2 * w.n then other_n end as form_n
    from words w left join best b on b.word = w.word and k = 1
), recursive_steps as (
    with recursive steps as (
        select word, coalesce(form, word) as reached, form is null as done from formed
        union all
        select s.word, coalesce(f.form, s.reached), f.form is null from steps s join formed f on f.word = s.reached where not s.done
    ) select word, reached as root from steps where done
)
select formed.*, root from formed join recursive_steps using (word)
"""

FEATURES = rf"""
    select id, unnest(list_concat(w,
        list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]),
        list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    )) as feature
"""

IMPORTANCE = rf"""
with texts as (
    select false as target, row_number() over () as id, doc_id, text from documents
    union all select true, -row_number() over (), null, text from benchmark
), split as (
    select target, id, doc_id,
        {TOKENS} as w
    from texts
), features as ({FEATURES} from split
), distinct_features as (
    select distinct feature from features
), hashed as (
    select feature, {crc32("feature")} % 10000 as bucket from distinct_features
), counted as (
    select id, bucket, count(*) as times from features join hashed using (feature) group by id, bucket
), buckets as (
    select bucket, sum(times) filter (where id > 0) as s, sum(times) filter (where id < 0) as t from counted group by bucket
), sums as (
    select coalesce(sum(s), 0)::double as all_s, coalesce(sum(t), 0)::double as all_t from buckets
), gains as (
    select bucket, floor(1000 * ln((coalesce(t, 0)::double + 1) * (all_s + 10000) / ((coalesce(s, 0)::double + 1) * (all_t + 10000))))::bigint as gain
    from buckets, sums
), weights as (
    select id, sum(times)::bigint as n_features, sum(times * gain)::bigint as weight
    from counted join gains using (bucket) where id > 0 group by id
), scored as (
    select doc_id, len(w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
        coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5::double)
            / 4294967296)))::bigint as score
    from split left join weights using (id) where not target
), ranked as (
    select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place,
        (5 * count(*) filter (where n_words >= 20) over ()) // 100 as k
    from scored
)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= k then place end::bigint as rank from ranked
"""


ORACLES = {
    "op5_decontamination": DECONTAMINATION,
    "op7_chat_formatting": CHAT,
    "op8_mixing": MIXING,
    "op9_secret_scan": SECRETS,
    "op12_spelling": SPELLING,
    "op13_importance": IMPORTANCE,
}
