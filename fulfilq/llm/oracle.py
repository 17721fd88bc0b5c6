"""DuckDB SQL of the operators that SQL can express (whole tables, whole texts)."""

from __future__ import annotations

from fulfilq.llm import license_join

#: The characters of [\x20\x09-\x0D].
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _words(col: str) -> str:
    return _WORDS.format(_LOWER.format(f"coalesce({col}, '')"))


OP9 = f"""
with d as (select row_number() over () r, doc_id, {_words("text")} w from documents),
b as (select cast(item_id as varchar) item_id, {_words("text")} w from benchmark),
win as (
  select distinct item_id, least(len(w), 10) k, list_slice(w, i, i + least(len(w), 10) - 1) g
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) i from b where len(w) > 0)
),
sizes as (select distinct k from win),
place as (
  select r, i, k, list_slice(w, i, i + k - 1) g
  from (select r, k, w, unnest(range(1, len(w) - k + 2)) i from d, sizes where len(w) >= k)
),
occ as (select p.r, p.i, p.k, win.item_id from place p join win on p.k = win.k and p.g = win.g),
hit as (select r, count(distinct p) n_hit from (select r, unnest(range(i, i + k)) p from occ) group by r),
items as (
  select r, count(*) n_items, string_agg(item_id, ',' order by item_id) s from (select distinct r, item_id from occ) group by r
)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit,
  cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(s, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hit using (r) left join items using (r)
"""

OP10 = f"""
with d as (select row_number() over () r, doc_id, string_split(coalesce(text, ''), chr(10)) l from documents),
lines as (select r, doc_id, unnest(l) line, unnest(range(1, len(l) + 1)) pos from d),
keyed as (select *, {_LOWER.format(f"trim(line, {_SPACE})")} key from lines),
first as (select key, min(doc_id) lead from keyed where length(key) >= 10 group by key),
marked as (select k.*, first.lead is not null and doc_id > first.lead gone from keyed k left join first using (key))
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
from marked group by r, doc_id
"""


def _list(some) -> str:
    return "[" + ", ".join(f"'{x}'" for x in some) + "]::varchar[]"


def op5(templates=license_join.TEMPLATES) -> str:
    """The scan across lines, as the query runs it: a notice is met in one line, or in SPAN times its words of a block."""
    sets = license_join.template_sets(templates)
    names = license_join.named(templates)
    spans = [license_join.SPAN * len(license_join.notice_words(t[1])) for t in templates]
    values = ", ".join(
        f"({k}, '{label}', {_list(s)}, {license_join.need(len(s))}, {spans[k]}, {_list(names[k][0])}, {_list(names[k][1])})"
        for k, (label, s) in enumerate(sets)
    )
    union = " union all ".join(
        f"select r, '{label}' label, i - 1 pos from (select r, w, unnest(range(1, len(w) + 1)) i from d) "
        f"where list_slice(w, i, i + {len(p.split()) - 1}) = [{', '.join(repr(x) for x in p.split())}]"
        for p, label in license_join.PHRASES.items()
    )
    # a mark before blanks and a digit keeps "v. 2.0" from ending a sentence: the patterns here know no lookahead
    text = r"regexp_replace(coalesce(text, ''), '([.!?])([ \t\r\n]+[0-9])', '\1' || chr(1) || '\2', 'g')"
    return f"""
with d as (select row_number() over () r, doc_id, {text} text, {_words("text")} w from documents),
place as ({union}),
base as (
  select r, count(*) n_base, min(pos) first_word, max(pos) last_word, string_agg(distinct label, ',' order by label) base_labels
  from place group by r
),
t(k, label, tokens, need, span, must, never) as (values {values}),
block as (
  select r, b, block, {_words("block")} w
  from (select r, unnest(s) block, unnest(range(1, len(s) + 1)) b
        from (select r, regexp_split_to_array(text, '\\n[ \\t\\r]*\\n|[.!?](?:[ \\t]|\\r?\\n)') s from d))
),
tokens as (select k, need, unnest(tokens) token from t),
near as (
  select r, b, k from (select r, b, unnest(list_distinct(w)) token from block) join tokens using (token)
  group by r, b, k, need having count(*) >= need
),
close as (select * from near join block using (r, b) join t using (k)),
part as (
  select r, label, tokens, need, must, never, {_words("line")} p from (
    select r, label, tokens, need, must, never, unnest(regexp_split_to_array(block, '\\n|[.!?][ \\t]')) line from close)
  union all
  select r, label, tokens, need, must, never, list_slice(w, i, i + span - 1) p
  from (select *, unnest(range(1, len(w) + 1)) i from close) where list_contains(tokens, w[i])
),
held as (
  select r, label, len(list_intersect(tokens, p)) n, len(tokens) size, need from part
  where list_has_all(p, must) and not list_has_any(p, never)
),
found as (select r, label, n / size c from held where n >= need),
own as (select r, max(c) best from found group by r),
every as (select r, string_agg(distinct label, ',' order by label) labels
          from (select r, label from found union all select r, label from place) group by r)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_base, 0) as bigint) n_base,
  cast(first_word as bigint) first_word, cast(last_word as bigint) last_word, coalesce(base_labels, '') base_labels,
  coalesce(labels, '') labels, cast(case when n_base > 0 then 1.0 else coalesce(best, 0.0) end as double) score
from d left join base using (r) left join own using (r) left join every using (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_license_join": op5(), "op9_fm_decontamination": OP9, "op10_line_bitmap": OP10}
