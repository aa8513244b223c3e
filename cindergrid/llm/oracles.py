"""DuckDB SQL for the queries of this subpackage that SQL can say."""

from __future__ import annotations

from . import licenses


def _licences_sql(most_pieces: int = 16) -> str:
    """Runs of up to so many pieces that spell a known sentence, then the rules one after another on a text of identifiers."""
    known = ", ".join(f"({i}, '{licenses.normal(s)}')" for i, s in licenses.SENTENCES.items())
    gap = rf"(\|0\|){{0,{licenses.GAP}}}"
    step, rules = "select *, ids as left0 from q", licenses.in_order(licenses.RULES)
    for k, (_, ids) in enumerate(rules):
        pattern = gap.join(rf"\|{i}\|" for i in ids)
        step = f"select *, regexp_matches(left{k}, '{pattern}') as h{k}, regexp_replace(left{k}, '{pattern}', '|-|', 'g') as left{k + 1} from ({step})"
    names = ", ".join(f"case when h{k} then '{name}' end" for k, (name, _) in enumerate(rules))
    weak = ", ".join(f"'{x}'" for x in sorted(licenses.WEAK))
    return rf"""with p as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[.!?]+\s|\n'), lambda x: trim(x, ' ') <> '') as u from documents),
        n as (select doc_id, list_transform(u, lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))) as u from p), i as (select doc_id, u, unnest(range(1, len(u) + 1)) as i from n),
        k(id, s) as (values {known}), f as (select distinct string_split(s, ' ')[1] as w from k), c as (select i.* from i join f on f.w = string_split(u[i], ' ')[1]),
        j as (select doc_id, i, z, u[i + z - 1] as e, array_to_string(list_filter(list_slice(u, i, i + z - 1), lambda x: x <> ''), ' ') as s from (select *, unnest(range(1, {most_pieces + 1})) as z from c) where i + z - 1 <= len(u)),
        m as (select doc_id, i, max(z) as z, max_by(k.id, z) as id from j join k on k.s = j.s where e <> '' group by 1, 2),
        o as (select * from m where not exists (select 1 from m b where b.doc_id = m.doc_id and b.i < m.i and b.i + b.z > m.i)),
        t as (select i.doc_id, i.i, o.id, exists (select 1 from o where o.doc_id = i.doc_id and o.i < i.i and o.i + o.z > i.i) as inside from i left join o on o.doc_id = i.doc_id and o.i = i.i),
        q as (select n.doc_id, cast(len(n.u) as bigint) as n_sentences, count(t.id) as n_known, coalesce(string_agg(cast(t.id as varchar), ',' order by t.i), '') as sentence_ids, coalesce(string_agg('|' || coalesce(t.id, 0) || '|', '' order by t.i) filter (not inside), '') as ids from n left join t on t.doc_id = n.doc_id group by n.doc_id, n.u),
        r as (select *, list_sort(list_distinct(list_filter([{names}], lambda x: x is not null))) as l from ({step}))
        select doc_id, n_sentences, n_known, sentence_ids, array_to_string(case when len(list_filter(l, lambda x: x not in ({weak}))) > 0 then list_filter(l, lambda x: x not in ({weak})) else l end, ',') as licenses from r"""


ORACLES: dict[str, str] = {
    "op1_warc": """with p as (select page_id, coalesce(html, '') as h from pages), d as (select page_id, cast(strlen(h) as bigint) as payload_bytes, sha1(h) as payload_digest from p),
        g as (select *, max(page_id) over (partition by payload_digest, payload_bytes) as m from d)
        select page_id, payload_bytes, payload_digest, case when payload_bytes >= 1000 and page_id <> m then 'revisit' else 'response' end as record_type, case when payload_bytes >= 1000 and page_id <> m then m end as refers_to from g""",
    "op3_rules": r"""with t as (select doc_id, coalesce(text, '') as t from documents),
        p as (select doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from t),
        g as (select doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from p)), k as (select doc_id, i, count(*) over (partition by doc_id, s) as c from g),
        r as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + 8)) as j from k where c > 1) group by 1),
        c as (select p.doc_id, t, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
            len(l) as n_lines, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words from p left join r on r.doc_id = p.doc_id),
        f as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from c)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not (base_failed or 10 * n_symbols > 3 * n_words or 10 * n_dup_lines > 3 * n_lines or word_chars < 2 * n_words or word_chars > 14 * n_words
            or 10 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * word_chars or 10 * (length(t) - length(replace(t, '!', ''))) > 3 * n_words
            or 10 * length(regexp_replace(t, '[^\pL]', '', 'g')) < 6 * word_chars or 10 * length(regexp_replace(t, '[^0-9]', '', 'g')) > 3 * word_chars) as kept from f""",
    "op4_decontaminate": r"""with n as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
        b as (select distinct item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
        k as (select item_id, w, least(len(w), 13) as n from b where len(w) > 0), v as (select distinct item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as s from (select *, unnest(range(1, len(w) - n + 2)) as i from k)),
        z as (select distinct n from v), a as (select doc_id, i, z.n, array_to_string(list_slice(w, i, i + z.n - 1), ' ') as s from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from n) q, z where i + z.n - 1 <= len(w)),
        h as (select a.doc_id, a.i, a.n, v.item_id from a join v on v.n = a.n and v.s = a.s), c as (select doc_id, count(distinct j) as n_hit from (select distinct doc_id, unnest(range(i, i + n)) as j from h) group by 1),
        t as (select doc_id, count(*) as n_items, string_agg(x, ',' order by x) as ids from (select distinct doc_id, cast(item_id as varchar) as x from h) group by 1)
        select n.doc_id, cast(len(n.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(n.w) as contaminated
        from n left join c on c.doc_id = n.doc_id left join t on t.doc_id = n.doc_id""",
    "op7_licenses": _licences_sql(),
    "op6_chat": r"""with r as (select cast(conv_id as bigint) as c, cast(turn as bigint) as t, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        g as (select c as conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by t, role, text) as s, coalesce(string_agg(case when role = 'assistant' then text end, '' order by t, role, text), '') as l,
            sum(14 + length(role) + length(regexp_replace(role, '[^\\<#:]', '', 'g')) + length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g'))) as f from r group by 1)
        select conv_id, n_turns, sha256(s) as turns_sha256, cast(length(l) as bigint) as loss_chars, sha256(l) as loss_sha256, cast(f as bigint) as formatted_chars from g""",
}
