"""SQL twins of the registered queries, for an engine of its own (DuckDB)."""

# Words of documents and items, windows of 13 words (or of a whole shorter item), and the
# document words that lie in an occurrence of one.
DECONTAMINATION = r"""
with words as (
    select doc_id, row_number() over () as row_no,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
    from documents),
items as (
    select cast(item_id as varchar) as item,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark where item_id is not null),
sized as (select item, w, least(13, len(w)) as n from items where len(w) > 0),
windows as (
    select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as win
    from (select item, w, n, unnest(range(1, len(w) - n + 2)) as i from sized)),
lengths as (select distinct n from windows),
spots as (
    select row_no, i, n, array_to_string(w[i:i + n - 1], ' ') as win
    from (select row_no, w, n, unnest(range(1, len(w) - n + 2)) as i from words, lengths)),
found as (select row_no, i, n, item from spots join windows using (n, win)),
hits as (
    select row_no, count(distinct p) as n_hit
    from (select row_no, unnest(range(i, i + n)) as p from found) group by row_no),
named as (
    select row_no, count(*) as n_items, string_agg(item, ',' order by item) as list
    from (select distinct row_no, item from found) group by row_no)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(list, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from words left join hits using (row_no) left join named using (row_no)
"""

# The measures of each document, the failure rates of hosts shrunk by a beta prior, and
# the verdicts. The host limit is 0.5.
HOST_RULES = r"""
with docs as (
    select row_number() over () as r, doc_id, source as host, text,
        coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w,
        coalesce([x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')], []) as l
    from documents),
spots as (
    select r, i, array_to_string(w[i:i + 7], ' ') as win
    from (select r, w, unnest(range(1, len(w) - 6)) as i from docs)),
again as (select r, win from spots group by r, win having count(*) > 1),
repeats as (
    select r, count(distinct p) as n
    from (select r, unnest(range(i, i + 8)) as p from spots join again using (r, win)) group by r),
measured as (
    select doc_id, host, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0) as n_symbols,
        len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(n, 0) as n_repeat_words, len(l) as n_lines
    from docs left join repeats using (r)),
failed as (
    select host, rule, cast(f as bigint) as f from (
        select host, unnest([
            {'rule': 'short', 'f': n_words < 20},
            {'rule': 'repeats', 'f': n_repeat_words * 100 > n_words * 30},
            {'rule': 'symbols', 'f': n_symbols * 100 > n_words * 10},
            {'rule': 'lines', 'f': n_dup_lines * 100 > n_lines * 30}], recursive := true)
        from measured where host is not null)),
rates as (select host, rule, count(*) as n, sum(f) as f from failed group by host, rule),
means as (
    select rule, count(*) as hosts, sum(n) as docs, sum(f) / sum(n) as mean, sum(f * f / n) / sum(n) as squares
    from rates group by rule),
priors as (
    select rule, mean, case when spread > 0
            then least(1e6, greatest(1.0, mean * (1 - mean) / spread - 1)) else 1e6 end as strength
    from (select *, squares - mean * mean - mean * (1 - mean) * hosts / docs as spread from means)),
bad as (
    select distinct host from rates join priors using (rule)
    where (f + strength * mean) / (n + strength) > 0.5),
judged as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from measured)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
    cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
    cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
    not base_failed and bad.host is null as kept
from judged left join bad on judged.host = bad.host
"""

# Bytes as pairs of hex digits. A byte goes when a 50-byte string over it also starts in a
# document with a smaller id.
REPEATED_STRINGS = r"""
with docs as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
spots as (
    select r, doc_id, i, substr(h, 2 * i + 1, 100) as win
    from (select r, doc_id, h, unnest(range(0, cast(length(h) / 2 as bigint) - 49)) as i from docs)),
later as (
    select r, i from spots join (select win, min(doc_id) as first from spots group by win having count(*) > 1) using (win)
    where first < doc_id),
gone as (select distinct r, unnest(range(i, i + 50)) as p from later),
places as (
    select r, p, substr(h, 2 * p + 1, 2) as b, gone.p is not null as g
    from (select r, h, unnest(range(0, cast(length(h) / 2 as bigint))) as p from docs) left join gone using (r, p)),
runs as (
    select r, p, b, g, g and not coalesce(lag(g) over (partition by r order by p), false) as opens from places),
totals as (
    select r, count_if(g) as n_removed, count_if(opens) as n_spans,
        coalesce(string_agg(b, '' order by p) filter (not g), '') as kept
    from runs group by r)
select doc_id, cast(length(h) / 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
    cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(kept, ''))) as kept_sha256
from docs left join totals using (r)
"""

# A word goes when a window of 13 words over it also starts in a document with a smaller id.
REPEATED_PHRASES = r"""
with docs as (
    select row_number() over () as r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as w
    from documents),
spots as (
    select r, doc_id, i, array_to_string(w[i:i + 12], ' ') as win
    from (select r, doc_id, w, unnest(range(1, len(w) - 11)) as i from docs)),
later as (
    select r, i from spots join (select win, min(doc_id) as first from spots group by win having count(*) > 1) using (win)
    where first < doc_id),
gone as (select distinct r, unnest(range(i, i + 13)) as p from later),
words as (
    select r, p, word, gone.p is not null as g
    from (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from docs) left join gone using (r, p)),
totals as (
    select r, count_if(g) as n_removed, string_agg(word, ' ' order by p) filter (not g) as kept
    from words group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
    sha256(coalesce(kept, '')) as kept_sha256
from docs left join totals using (r)
"""

# Turns as mails that quote two turns back, their lines by quote level, the earliest writer
# of each line in the conversation, replies by most quoted characters, and their roots.
QUOTATIONS = r"""
with recursive said as (select conv_id, turn, min(text) as t from conversations group by conv_id, turn),
mails as (
    select row_number() over () as r, c.conv_id, c.turn,
        cast(c.conv_id as varchar) || ':' || cast(c.turn as varchar) as msg_id,
        concat_ws(chr(10), '> > ' || replace(b.t, chr(10), chr(10) || '> > '),
            '> ' || replace(a.t, chr(10), chr(10) || '> '), c.text) as body
    from conversations c left join said a on a.conv_id = c.conv_id and a.turn = c.turn - 1
        left join said b on b.conv_id = c.conv_id and b.turn = c.turn - 2),
raw as (
    select r, conv_id, turn, msg_id, unnest(string_split(body, chr(10))) as line,
        unnest(range(1, len(string_split(body, chr(10))) + 1)) as p
    from mails),
marked as (select *, regexp_extract(line, '^((?:>[\x20\x09]?)+)', 1) as marks from raw),
parsed as (
    select r, conv_id, turn, msg_id, p, length(regexp_replace(marks, '[^>]', '', 'g')) as level,
        substr(line, length(marks) + 1) as content
    from marked),
lines as (
    select *, lower(trim(regexp_replace(content, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) as plain
    from parsed where msg_id is not null),
origins as (
    select conv_id, plain, min({'sent': turn, 'msg_id': msg_id}) as o
    from lines where level = 0 and plain <> '' group by conv_id, plain),
votes as (
    select q.msg_id, level, o.msg_id as origin, sum(length(q.plain)) as weight, max(o.sent) as sent
    from lines q join origins using (conv_id, plain)
    where level > 0 and o.sent < q.turn group by q.msg_id, level, o.msg_id),
links as (
    select msg_id, origin as parent
    from (select *, row_number() over (partition by msg_id order by level, weight desc, sent desc, origin desc) as k from votes)
    where k = 1),
up as (
    select msg_id, parent as root, 1 as depth from links
    union all
    select up.msg_id, links.parent, depth + 1 from up join links on up.root = links.msg_id),
roots as (
    select msg_id, max(depth) as depth, arg_max(root, depth) as root from up group by msg_id),
texts as (
    select r, count_if(level > 0) as n_quoted,
        coalesce(string_agg(content, chr(10) order by p) filter (level = 0), '') as t
    from parsed group by r)
select coalesce(root, msg_id) as conversation, cast(coalesce(depth, 0) as bigint) as depth, msg_id, parent,
    regexp_replace(regexp_replace(t, '^(?:[\x20\x09-\x0D]*\n)+', ''), '(?:\n[\x20\x09-\x0D]*)+$', '') as text,
    cast(n_quoted as bigint) as n_quoted
from mails join texts using (r) left join links using (msg_id) left join roots using (msg_id)
"""

# crc32 from its polynomial: a table in eight steps, then byte by byte.
_CRC_STEPS = ", ".join(
    f"t{k} as (select i, case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end as x from t{k - 1})"
    for k in range(1, 9)
)

# Two words differ by one inserted or deleted letter if one without a letter is the other,
# and by one replaced letter if they agree without the letter of the same place.
SPELLING = f"""
with recursive t0 as (select range as i, range as x from range(256)), {_CRC_STEPS},
crc as (select list(x order by i) as t from t8),
runs as (
    select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')) as run from documents)),
counted as (
    select run, count(*) as times, hex(encode(concat(coalesce(cast(doc_id as varchar), ''), ':', run))) as bytes
    from runs group by doc_id, run),
hashed as (
    select run, times, xor(4294967295, list_reduce(list_concat([cast(4294967295 as bigint)], list_transform(
            range(0, length(bytes) // 2), lambda k: cast(
                (instr('0123456789ABCDEF', bytes[2 * k + 1]) - 1) * 16 + instr('0123456789ABCDEF', bytes[2 * k + 2]) - 1
            as bigint))),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) as hash
    from counted, crc),
typed as (
    select times, case when hash % 31 <> 0 then run
        else concat(substr(run, 1, hash % length(run)), substr(run, hash % length(run) + 2)) end as word
    from hashed),
words as (
    select word, cast(sum(times) as bigint) as n from typed where length(word) >= 7 group by word having sum(times) >= 2),
cut as (
    select word, n, k, concat(substr(word, 1, k - 1), substr(word, k + 1)) as rest
    from (select word, n, unnest(range(1, length(word) + 1)) as k from words)),
near as (
    select a.word, b.word as other, b.n as other_n from cut a join cut b on a.k = b.k and a.rest = b.rest and a.word <> b.word
    union select a.word, b.word, b.n from cut a join words b on a.rest = b.word
    union select b.word, a.word, a.n from cut a join words b on a.rest = b.word),
best as (
    select word, count(*) as n_near, max(other_n) as best_n, arg_min(other, (-other_n, other)) as best from near group by word),
forms as (
    select word, n, coalesce(n_near, 0) as n_near, case when best_n >= 10 * n then best end as form,
        case when best_n >= 10 * n then best_n end as form_n
    from words left join best using (word)),
chain as (
    select word, form as root from forms where form is not null
    union all select chain.word, forms.form from chain join forms on forms.word = chain.root where forms.form is not null),
last as (select chain.word, chain.root from chain join forms on forms.word = chain.root where forms.form is null)
select forms.word, form, coalesce(root, forms.word) as root, n, n_near, form_n from forms left join last on last.word = forms.word
"""
