"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from veracast.llm.quality_rules import PHRASES
from veracast.llm.queries import DOMAIN_WEIGHTS, LANG_WEIGHTS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(pattern: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"
    )


def _op1() -> str:
    return f"""
with d as (select row_number() over () rid, doc_id, {_words(_ALNUM)} w from documents),
i as (select cast(item_id as varchar) item, w, least(10, len(w)) width
      from (select item_id, {_words(_ALNUM)} w from benchmark) where len(w) > 0),
iw as (select distinct item, width, unnest(list_transform(range(1, len(w) - width + 2),
              lambda k: array_to_string(w[k:k + width - 1], ' '))) win from i),
dw as (select rid, width, unnest(range(1, len(w) - width + 2)) k,
              unnest(list_transform(range(1, len(w) - width + 2),
                     lambda k: array_to_string(w[k:k + width - 1], ' '))) win
       from d, (select distinct width from iw)),
hits as (select rid, k, width, item from dw join iw using (width, win)),
words as (select rid, count(distinct k + o) n_hit
          from (select distinct rid, k, unnest(range(0, width)) o from hits) group by rid),
items as (select rid, count(distinct item) n_items, string_agg(distinct item, ',' order by item) names
          from hits group by rid)
select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(names, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join words using (rid) left join items using (rid)"""


def _op5() -> str:
    phrases = " or ".join(f"contains(lower(l), '{p}')" for p in PHRASES)
    return f"""
with d as (select row_number() over () rid, doc_id, coalesce(text, '') t,
                  regexp_extract_all(coalesce(text, ''), '{_SPACED}') w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '{_SPACED}')) lines from documents),
windows as (select rid, unnest(range(1, len(w) - 6)) k,
                   unnest(list_transform(range(1, len(w) - 6), lambda k: array_to_string(w[k:k + 7], ' '))) win
            from d where len(w) >= 8),
twice as (select rid, win from windows group by 1, 2 having count(*) > 1),
repeats as (select rid, count(distinct k + o) n
            from (select rid, k, unnest(range(0, 8)) o from windows join twice using (rid, win)) group by 1),
l as (select distinct rid, l from (select rid, unnest(lines) l from d)),
figures as (select rid, l, len(regexp_replace(l, '[\\x20\\x09-\\x0D]+', '', 'g')) tight,
                   len(regexp_replace(l, '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', '', 'g')) plain,
                   len(l) - len(regexp_replace(l, '[|»›•·]', '', 'g')) separators,
                   len(regexp_extract_all(l, '{_SPACED}')) n,
                   regexp_matches(l, '[.!?…:;)"”''’।॥。！？][\\x20\\x09-\\x0D]*$') ended,
                   {phrases} boiler from l),
good as (select rid, sum(tight) chars from figures
         where not (100 * (tight - plain) > 20 * tight or separators >= 3 or (n <= 3 and not ended) or boiler)
         group by 1),
base as (select rid, doc_id, cast(len(w) as bigint) n_words,
                cast(len(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g')) as bigint) word_chars,
                cast(len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) n_symbols,
                cast(len(lines) - len(list_distinct(lines)) as bigint) n_dup_lines,
                coalesce(n, 0) n_repeat_words, coalesce(chars, 0) chars
         from d left join repeats using (rid) left join good using (rid)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed from base)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 100 * chars >= 50 * word_chars kept from judged"""


def _op4() -> str:
    """Similarities of all documents that share a shingle, and the closure of the links."""
    return f"""
with recursive d as (select row_number() over () rid, doc_id, {_words(_SPACED)} w from documents),
s as materialized (
  select distinct rid, unnest(list_transform(range(1, greatest(len(w), 2)),
                 lambda k: array_to_string(w[k:k + 1], ' '))) sh from d where len(w) > 0),
n as materialized (select rid, count(*) n from s group by rid),
pairs as (select a.rid x, b.rid y, count(*) c from s a join s b on a.sh = b.sh and a.rid < b.rid group by 1, 2),
links as materialized (
  select x, y from pairs join n a on a.rid = x join n b on b.rid = y where 100 * c >= 80 * (a.n + b.n - c)),
sides as materialized (select x a, y b from links union all select y, x from links),
reach(rid, other) as (
  select rid, rid from d union select reach.rid, sides.b from reach join sides on sides.a = reach.other),
least as (select reach.rid, min(o.doc_id) component_id from reach join d o on o.rid = reach.other group by 1)
select doc_id, coalesce(n, 0) n_shingles, component_id, doc_id is not distinct from component_id kept
from d join least using (rid) left join n using (rid)"""


def _case(column: str, weights: dict[str, int]) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then {v}" for k, v in weights.items()) + " else 1 end"


def _shared(given: str, parent: str, by: str) -> str:
    """Budgets of children with weight and room, by levels of fullness."""
    keys = parent or "1"
    order = f"partition by {keys} order by cast(room as double) / cast(weight as double), {by} nulls first"
    return f"""(select *, case when full_ then room else cast((given - of_full) * weight // of_rest as bigint) end budget
  from (select *, coalesce(sum(case when full_ then room end) over (partition by {keys}), 0) of_full,
               sum(case when not full_ then weight end) over (partition by {keys}) of_rest
        from (select *, cast(room as hugeint) * sum(weight) over ({order} rows between current row and unbounded following)
                     <= (given - coalesce(sum(room) over ({order} rows between unbounded preceding and 1 preceding), 0)) * cast(weight as hugeint) full_
              from ({given}))))"""


def _op6(share: tuple[int, int] = (4, 5), epochs: int = 2) -> str:
    level1 = _shared(
        "select domain, max(wd) weight, cast(sum(room) as hugeint) room, (select total from whole) given from leaves group by domain",
        "",
        "domain",
    )
    level2 = _shared(
        "select a.domain, a.lang, max(wl) weight, cast(sum(a.room) as hugeint) room, max(b.budget) given from leaves a join l1 b on a.domain is not distinct from b.domain group by 1, 2",
        "domain",
        "lang",
    )
    level3 = _shared(
        "select a.domain, a.lang, a.source, 1 weight, cast(a.room as hugeint) room, b.budget given from leaves a join l2 b on a.domain is not distinct from b.domain and a.lang is not distinct from b.lang",
        "domain, lang",
        "source",
    )
    return f"""
with d as (select doc_id, lang, source, coalesce('d' || (try_cast(substring(source, 4, 9) as int) % 4), 'other') domain,
                  len(regexp_extract_all(coalesce(text, ''), '{_SPACED}')) n_tokens from documents),
leaves as (select domain, lang, source, sum(n_tokens) tokens, {epochs} * sum(n_tokens) room,
                  max({_case("domain", DOMAIN_WEIGHTS)}) wd, max({_case("lang", LANG_WEIGHTS)}) wl from d group by 1, 2, 3),
whole as (select least(sum(tokens) * {share[0]} // {share[1]}, sum(tokens) * {epochs}) total from leaves),
l1 as {level1}, l2 as {level2}, l3 as {level3},
plan as (select a.domain, a.lang, a.source, b.budget,
                case when tokens > 0 then b.budget // tokens else 0 end full_epochs,
                case when tokens > 0 then b.budget % tokens else 0 end rest
         from leaves a join l3 b on a.domain is not distinct from b.domain and a.lang is not distinct from b.lang
              and a.source is not distinct from b.source),
placed as (select d.*, p.budget, p.full_epochs, p.rest,
                  md5('7|' || p.full_epochs || '|' || coalesce(cast(doc_id as varchar), '')) key
           from d join plan p on d.domain is not distinct from p.domain and d.lang is not distinct from p.lang
                and d.source is not distinct from p.source)
select doc_id, lang, source, domain, cast(n_tokens as bigint) n_tokens, cast(budget as bigint) leaf_budget,
       cast(full_epochs + case when budget > 0 and
            sum(n_tokens) over (partition by domain, lang, source order by key range unbounded preceding) <= rest
            then 1 else 0 end as bigint) copies
from placed"""


def _op11() -> str:
    return """
with p as (select page_id, coalesce(html, '') h, strlen(coalesce(html, '')) n from pages),
m as (select h, max(page_id) top from p where n >= 1000 group by h),
r as (select page_id, h, n, top, top is null or page_id is not distinct from top first_one
      from p left join m using (h))
select page_id, cast(n as bigint) payload_bytes, sha1(h) payload_digest,
       case when first_one then 'response' else 'revisit' end record_type,
       case when not first_one then top end refers_to from r"""


# CRC-32 of a text, bit by bit: the polynomial reversed, all ones in and out.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({x}, ''), lambda c: ascii(c)::bigint)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
    lambda v, unused: xor(v >> 1, 3988292384::bigint * (v & 1)))), 4294967295::bigint)"""


def _op12() -> str:
    crc = _CRC32.format(x="cast(conv_id as varchar)")
    return f"""
with c as (select conv_id, turn, sha256(strlen(r) || ':' || r || t) s, len(regexp_extract_all(t, '{_SPACED}')) w
           from (select conv_id, turn, coalesce(role, '') r, coalesce(text, '') t from conversations
                 where conv_id is not null)),
own as (select conv_id, list(struct_pack(s := s, w := w) order by turn nulls first, s) steps from c group by 1),
based as (select conv_id, steps, conv_id - conv_id % 20 base, cast({crc} % 4 as int) h from own),
whole as materialized (
  select a.conv_id, list_concat(coalesce(b.steps[1:a.h], []), a.steps[a.h + 1:]) steps
  from based a left join own b on b.conv_id = a.base),
pre as materialized (
  select conv_id, d, sha256(array_to_string(list_transform(steps[1:d], lambda x: x.s), ',')) p,
         case when d > 0 then sha256(array_to_string(list_transform(steps[1:d - 1], lambda x: x.s), ',')) end up,
         case when d > 0 then steps[d].w else 0 end w, d = len(steps) ended
  from (select conv_id, steps, unnest(range(0, len(steps) + 1)) d from whole)),
node as materialized (
  select p, d, any_value(up) up, any_value(w) w, min(conv_id) conv, count(*) n,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ended), '')) ends
  from pre group by p, d),
kids as (select up, d - 1 d, count(*) n from node where d > 0 group by 1, 2),
below as (select a.p, a.d, sum(case when k.n is null then 1 else 0 end) leaves, sum((q.n - 1) * q.w) saved
          from node q left join kids k on k.up = q.p and k.d = q.d
          join pre a on a.conv_id = q.conv and a.d <= q.d group by 1, 2)
select node.conv conv_id, node.d depth, parent.conv parent_conv_id, node.n n_convs,
       coalesce(kids.n, 0) n_children, cast(leaves as bigint) n_leaves, cast(saved as bigint) saved_tokens,
       node.ends ends_sha256
from node join below using (p, d) left join kids on kids.up = node.p and kids.d = node.d
left join node parent on parent.p = node.up and parent.d = node.d - 1"""


def _op13(rounds: int = 6) -> str:
    """Parts as rows, and the codebooks of every round as a step of their own."""
    near = """select x.rid, x.part, b.entry, x.v,
              list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint dist
       from parts x join {books} b using (part)
       qualify row_number() over (partition by x.rid, x.part order by dist, b.entry) = 1"""
    steps = [
        """kept as materialized (
  select row_number() over () rid, vec_id, label,
         list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) v
  from embeddings where embedding is not null
       and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        """parts as materialized (
  select rid, part, v[part * len(v) // 8 + 1:(part + 1) * len(v) // 8] v
  from kept, (select unnest(range(0, 8)) part))""",
        """b0 as materialized (
  select part, e entry, v from parts
  join (select rid, row_number() over (order by vec_id, v) - 1 e from kept qualify e < 16) using (rid))""",
    ]
    for i in range(rounds):
        steps.append(f"n{i} as materialized ({near.format(books=f'b{i}')})")
        steps.append(f"""b{i + 1} as materialized (
  select part, entry, coalesce(m.v, b.v) v from b{i} b left join (
    select part, entry, list(cast((s - ((s % c) + c) % c) // c as bigint) order by j) v from (
      select part, entry, j, cast(sum(x) as bigint) s, count(*) c
      from (select part, entry, unnest(v) x, unnest(range(0, len(v))) j from n{i}) group by 1, 2, 3)
    group by 1, 2) m using (part, entry))""")
    last = f"b{rounds}"
    steps.append(f"final as materialized ({near.format(books=last)})")
    steps.append("""coded as (
  select rid, string_agg(printf('%02x', cast(entry as int)), '' order by part) code, cast(sum(dist) as bigint) error
  from final group by rid)""")
    steps.append(f"""digest as (
  select sha256(string_agg(cast(x as varchar), ',' order by part, entry, j)) d
  from (select part, entry, unnest(v) x, unnest(range(0, len(v))) j from {last}))""")
    return f"""with {', '.join(steps)}
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, d codebooks_sha256
from kept join coded using (rid), digest"""


def statements() -> dict[str, str]:
    return {
        "op1_decontaminate": _op1(),
        "op4_near_duplicates": _op4(),
        "op5_quality_rules": _op5(),
        "op6_mixture": _op6(),
        "op11_warc": _op11(),
        "op12_prefix_trie": _op12(),
        "op13_vector_codes": _op13(),
    }
