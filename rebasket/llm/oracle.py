"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations


_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

OP2 = """
with p as (
    select page_id, cast(strlen(coalesce(html, '')) as bigint) payload_bytes, sha1(coalesce(html, '')) payload_digest from pages
), h as (
    select payload_digest d, max(page_id) holder from p where payload_bytes >= 1000 group by payload_digest
)
select page_id, payload_bytes, payload_digest,
    case when holder is not null and page_id is distinct from holder then 'revisit' else 'response' end record_type,
    case when page_id is distinct from holder then holder end refers_to
from p left join h on payload_digest = d and payload_bytes >= 1000
"""

# documents that share a shingle are compared; components by spreading the least id
OP7 = f"""
with recursive w as (
    select doc_id, {_WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ws
    from documents
), s as (
    select doc_id, case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
        else list_distinct([array_to_string(ws[i:i + 2], ' ') for i in range(1, len(ws) - 1)]) end sh
    from w
), e as (
    select doc_id, cast(len(sh) as bigint) n, unnest(sh) x from s
), c as (
    select a.doc_id a, b.doc_id b, a.n na, b.n nb, count(*) both_have
    from e a join e b on a.x = b.x and a.doc_id <> b.doc_id group by all
), l as (
    select a, b from c where 100 * both_have >= 85 * (na + nb - both_have)
), r(doc_id, seen) as (
    select doc_id, doc_id from s union select l.b, r.seen from r join l on l.a = r.doc_id
), m as (
    select doc_id, min(seen) component_id from r group by doc_id
)
select s.doc_id, cast(len(sh) as bigint) n_shingles, component_id, s.doc_id = component_id kept from s join m using (doc_id)
"""

OP8 = f"""
with w as (
    select doc_id, {_WORDS.format("coalesce(text, '')")} ws from documents
), p as (
    select doc_id, unnest(range(1, len(ws) - 33)) i, ws from w where len(ws) >= 35
), g as (
    select doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) h from p
), r as (
    select doc_id, i from g where h in (select h from g group by h having count(*) > 1)
), c as (
    select doc_id, list(distinct k) gone from (select doc_id, unnest(range(i, i + 35)) k from r) group by doc_id
), t as (
    select w.doc_id, ws, coalesce(gone, []) gone from w left join c using (doc_id)
), kw as (
    select doc_id, string_agg(x, ' ' order by k) kept
    from (select doc_id, gone, unnest(ws) x, unnest(range(1, len(ws) + 1)) k from t) u
    where not list_contains(gone, k) group by doc_id
)
select t.doc_id, cast(len(ws) as bigint) n_words, cast(len(gone) as bigint) n_removed, sha256(coalesce(kept, '')) kept_sha256
from t left join kw using (doc_id)
"""


# crc32 by its table: 256 entries, then one step per byte
_CRC_TABLE = """
    select list(list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) t
    from range(256) r(i)
"""


def _crc32(text: str) -> str:
    byte = f"cast('0x' || substr(hex(encode({text})), 2 * k - 1, 2) as bigint)"
    return (
        f"xor(list_reduce(list_concat([4294967295], list_transform(range(1, strlen({text}) + 1), lambda k: {byte})), "
        "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


# nodes are the distinct lists of first turns; every node counts for all its prefixes
OP11 = f"""
with tab as ({_CRC_TABLE}), turns as (
    select conv_id, turn, coalesce(role, '') r, coalesce(text, '') x from conversations where conv_id is not null
), own as (
    select conv_id, list({{'r': r, 'x': x}} order by turn nulls first, md5(length(r) || ':' || r || x)) ts from turns group by conv_id
), h as (
    select conv_id, ts, conv_id - conv_id % 20 base, {_crc32("cast(conv_id as varchar)")} % 4 h from own, tab
), built as (
    select a.conv_id, case when a.base = a.conv_id then a.ts else list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) end ts
    from h a left join own b on b.conv_id = a.base
), places as (
    select conv_id, ts, unnest(range(0, len(ts) + 1)) d from built
), nodes as (
    select ts[1:d] k, d, min(conv_id) conv_id, count(*) n,
        coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (len(ts) = d), '') ends
    from places group by all
), linked as (
    select n.*, p.conv_id parent,
        case when n.d = 0 then 0 else (n.n - 1) * len({_WORDS.format("n.k[n.d].x")}) end cost
    from nodes n left join nodes p on p.d = n.d - 1 and p.k = n.k[1:n.d - 1]
), c as (
    select k[1:d - 1] k, count(*) children from nodes where d > 0 group by all
), l as (
    select linked.*, coalesce(children, 0) children from linked left join c on c.k = linked.k
), below as (
    select k[1:a] k, sum(cost) saved, sum(case when children = 0 then 1 else 0 end) leaves
    from (select *, unnest(range(0, d + 1)) a from l) group by all
)
select conv_id, cast(d as bigint) "depth", parent parent_conv_id, n n_convs, children n_children, cast(leaves as bigint) n_leaves,
    cast(saved as bigint) saved_tokens, sha256(ends) ends_sha256
from l join below b on b.k = l.k
"""

# near words share a wildcard of one place, or one is the other without a character
OP12 = f"""
with recursive tab as ({_CRC_TABLE}), runs as (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) run from documents
), counted as (
    select coalesce(cast(doc_id as varchar), '') || ':' || run named, run, count(*) times from runs where length(run) >= 7 group by all
), hashed as (
    select run, times, {_crc32("named")} h from counted, tab
), v as (
    select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end word, sum(times) n
    from hashed group by all
), w as (
    select word, cast(n as bigint) n, length(word) len from v where n >= 2 and length(word) >= 7
), cut as (
    select word, i, len, substr(word, 1, i - 1) a, substr(word, i + 1) b from (select *, unnest(range(1, len + 1)) i from w)
), pairs as (
    select x.word a, y.word b from cut x join cut y on x.len = y.len and x.i = y.i and x.a = y.a and x.b = y.b and x.word <> y.word
    union select c.word, w.word from cut c join w on w.word = c.a || c.b
    union select w.word, c.word from cut c join w on w.word = c.a || c.b
), best as (
    select a, count(*) n_near, max(n) top_n, arg_min(word, {{'m': -n, 'w': word}}) top from pairs join w on word = b group by a
), f as (
    select word, case when top_n >= 10 * n then top end form, n, coalesce(n_near, 0) n_near, case when top_n >= 10 * n then top_n end form_n
    from w left join best on a = word
), r(word, root, form) as (
    select word, word, form from f union all select r.word, f.word, f.form from r join f on f.word = r.form
)
select f.word, f.form, root, n, n_near, form_n from f join r on r.word = f.word and r.form is null
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": OP2, "op7_minhash": OP7, "op8_debruijn": OP8, "op11_euler": OP11, "op12_spelling": OP12}
