"""SQL of the registered queries that DuckDB can answer on whole tables."""

from __future__ import annotations

from propfold.llm.arc_convert import REVISIT_BYTES

ARC_CONVERT = f"""
with bodies as (
    select page_id, octet_length(encode(coalesce(html, ''))) as bytes, sha1(coalesce(html, '')) as digest
    from pages
), largest as (
    select digest, max(page_id) as page_id from bodies where bytes >= {REVISIT_BYTES} group by digest
)
select b.page_id, b.bytes::bigint as payload_bytes, b.digest as payload_digest,
    case when b.page_id < l.page_id then 'revisit' else 'response' end as record_type,
    case when b.page_id < l.page_id then l.page_id end as refers_to
from bodies b left join largest l on b.digest = l.digest and b.bytes >= {REVISIT_BYTES}
"""

FILL_MIDDLE = """
with texts as (
    select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n,
        sha256('1:' || coalesce(doc_id::varchar, '')) as h
    from documents
), drawn as (
    select *, ('0x' || h[1:8])::bigint % (n + 1) as d1, ('0x' || h[9:16])::bigint % (n + 1) as d2,
        ('0x' || h[17:24])::bigint % 100 as d3, ('0x' || h[25:32])::bigint % 100 as d4
    from texts
), cut as (
    select doc_id, text, n, least(d1, d2) as low, greatest(d1, d2) as high,
        case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or d3 >= 90 then 'plain'
            when d4 < 20 then 'spm' else 'psm' end as form
    from drawn
), written as (
    select *, case form when 'plain' then text
        when 'psm' then '<P>' || substring(text, 1, low) || '<S>' || substring(text, high + 1) || '<M>' || substring(text, low + 1, high - low)
        else '<S>' || substring(text, high + 1) || '<P>' || substring(text, 1, low) || '<M>' || substring(text, low + 1, high - low)
        end as output
    from cut
), found as (
    select *, case form when 'psm' then strpos(output, '<S>') when 'spm' then strpos(output, '<P>') end as second,
        case when form <> 'plain' then strpos(output, '<M>') end as third
    from written
)
select doc_id, n::bigint as n, form,
    case when form <> 'plain' then low end::bigint as prefix_chars,
    case when form <> 'plain' then high - low end::bigint as middle_chars,
    sha256(output) as output_sha256,
    sha256(case form when 'plain' then output
        when 'psm' then substring(output, 4, second - 4) || substring(output, third + 3) || substring(output, second + 3, third - second - 3)
        else substring(output, second + 3, third - second - 3) || substring(output, third + 3) || substring(output, 4, second - 4)
        end) as restored_sha256
from found
"""

COLLOCATIONS = """
with texts as (
    select row_number() over () as text_no, coalesce(lang, 'und') as lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
), pieces as (
    select text_no, lang, unnest(pieces) as piece, unnest(range(len(pieces))) as piece_no
    from (select *, string_split_regex(text, '[.,;:!?\\x0A-\\x0D]') as pieces from texts)
), words as (
    select text_no, lang, piece_no, unnest(words) as word, unnest(range(len(words))) as place
    from (select *, regexp_extract_all(piece, '[^\\x20\\x09]+') as words from pieces)
), runs as (
    select lang, word as w1, lead(word, 1) over piece as w2, lead(word, 2) over piece as w3, lead(word, 3) over piece as w4
    from words window piece as (partition by text_no, piece_no order by place)
), phrases as (
    select lang, [w1] as words from runs
    union all select lang, [w1, w2] from runs where w2 is not null
    union all select lang, [w1, w2, w3] from runs where w3 is not null
    union all select lang, [w1, w2, w3, w4] from runs where w4 is not null
), f as (
    select lang, words, count(*) as n from phrases group by all having count(*) >= 30
), candidates as (
    select * from f where len(words) > 1
), subsumed as (
    select distinct c.lang, c.words
    from candidates c join (
        select lang, unnest([words[1:2], words[2:3], words[3:4], words[1:3], words[2:4]]) as inner_words, len(words) as size, n
        from candidates where len(words) > 2
    ) x on x.lang = c.lang and x.inner_words = c.words and x.size > len(c.words) and 100 * x.n::hugeint >= 80 * c.n::hugeint
), cuts as (
    select c.lang, c.words, c.n as a, k, l.n as l, r.n as r, (2000000 * c.n::hugeint // (l.n + r.n))::bigint as score
    from (select *, unnest(range(1, len(words))) as k from candidates) c
    join f l on l.lang = c.lang and l.words = c.words[1:c.k]
    join f r on r.lang = c.lang and r.words = c.words[c.k + 1:]
    anti join subsumed s on s.lang = c.lang and s.words = c.words
), lowest as (
    select * from cuts qualify row_number() over (partition by lang, words order by score, k) = 1
), totals as (
    select lang, count(*) as n from words group by lang
)
select lang, rank, phrase, a, l, r, n, score from (
    select lang, array_to_string(words, ' ') as phrase, a, l, r, t.n, score,
        row_number() over (partition by lang order by score desc, a desc, array_to_string(words, ' ')) as rank
    from lowest join totals t using (lang)
) where rank <= 2000
"""


def statements() -> dict[str, str]:
    return {
        "op8_arc_convert": ARC_CONVERT,
        "op12_fill_middle": FILL_MIDDLE,
        "op13_collocations": COLLOCATIONS,
    }
