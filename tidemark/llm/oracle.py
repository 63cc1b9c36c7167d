"""SQL that the queries of this folder must agree with, for DuckDB, where SQL can express the operator."""

from __future__ import annotations

from tidemark.llm.decontaminate import CONTAINED
from tidemark.llm.license_scan import FILE_NAME, LEAST, TEMPLATES
from tidemark.llm.quality_rules import BUCKETS, FOLDS, MAX_REPEATED, MIN_WORDS, PAIR_STEP, PSEUDO, SCALE, THRESHOLD, WORD_STEP

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = "array_to_string(w[i:i+4], ' ')"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{SPACES}'), lambda x: x <> '')"


def _shingled(name: str, key: str, table: str) -> str:
    words = _words("lower(coalesce(text, ''))")
    return f"""{name} as (select distinct {key}, unnest(list_transform(range(1, len(w) - 3), lambda i: {WINDOW})) as s
      from (select {key}, {words} as w from {table}))"""


DECONTAMINATE = f"""with {_shingled('d', 'doc_id', 'documents')}, {_shingled('b', 'item_id', 'benchmark')},
  n as (select item_id, count(*) as n_item from b group by item_id),
  hit as (select doc_id, item_id, count(*) as n_shared from d join b using (s) group by doc_id, item_id)
  select doc_id, item_id, n_item, n_shared, cast(n_shared as double) / n_item as containment from hit join n using (item_id)
  where n_shared >= {CONTAINED} * n_item - 0.000000001"""

_LETTER = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((v >> {shift}) & 31) + 1 as int), 1)"
_FIVE = " || ".join(_LETTER.format(shift=s) for s in (15, 10, 5, 0))
WARC = f"""with p as (select page_id, coalesce(html, '') as h from pages), f as (select h, min(page_id) as first from p group by h),
  x as (select page_id, h, first, list_transform(range(8), lambda i: cast('0x' || substr(sha1(h), cast(5 * i + 1 as int), 5) as bigint)) as parts
    from p join f using (h))
  select page_id, cast(strlen(h) as bigint) as payload_bytes, array_to_string(list_transform(parts, lambda v: {_FIVE}), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to from x"""

# CRC-32 by its usual table, which follows from the polynomial.
_CRC = """tab as (select list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
  tails as (select right(x, 2) as tail from word union select x from word),
  code as (select tail, xor(list_reduce(list_concat([4294967295], list_transform(range(cast(len(hex(encode(tail))) / 2 as bigint)),
    lambda i: cast('0x' || substr(hex(encode(tail)), cast(2 * i + 1 as int), 2) as bigint))),
    lambda c, b: xor(c >> 8, t[cast((xor(c, b) & 255) + 1 as int)])), 4294967295) as crc from tails, tab)"""
QUALITY_RULES = f"""with doc as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
  listed as (select rid, doc_id, t, {_words('t')} as w from doc),
  word as (select rid, unnest(w) as x, unnest(range(1, len(w) + 1)) as i from listed),
  {_CRC},
  gram as (select rid, (coalesce(lag(crc) over (partition by rid order by i), 0) * {PAIR_STEP} + crc) % {BUCKETS} as b
    from word join code on right(x, 2) = tail union all select rid, (crc * {WORD_STEP}) % {BUCKETS} from word join code on x = tail),
  good as (select rid, coalesce(max(quality), 0) = 1 as trusted from doc left join (select * from labels where quality = 1) using (doc_id) group by rid),
  dealt as (select rid, cast('0x' || substr(md5(t), 1, 1) as int) % {FOLDS} as fold from doc),
  per as (select fold, b, count(*) as raw, count(*) filter (trusted) as good from gram join dealt using (rid) join good using (rid) group by fold, b),
  upto as (select f as fold, b, sum(case when fold <> f then raw else 0 end) as raw, sum(case when fold <> f then good else 0 end) as good
    from per, range({FOLDS}) r(f) group by f, b),
  total as (select fold, greatest(sum(raw), 1) as raw, sum(good) as good from upto group by fold),
  ratio as (select fold, b, cast(round({SCALE} * ln((u.good + {PSEUDO}::double)
    / (cast(total.good as double) / total.raw * u.raw + {PSEUDO}::double))) as bigint) as r from upto u join total using (fold)),
  scored as (select rid, count(*) as n, cast(sum(r) as bigint) as s from gram join dealt using (rid) join ratio using (fold, b) group by rid),
  win as (select rid, unnest(list_transform(range(1, len(w) - 3), lambda i: {WINDOW})) as s, unnest(range(1, len(w) - 3)) as i from listed),
  twin as (select rid, i from win qualify count(*) over (partition by rid, s) > 1),
  again as (select rid, count(distinct i + k) as n_repeat_words from twin, range(5) r(k) group by rid),
  base as (select rid, doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from listed),
  whole as (select doc_id, n_words, word_chars, n_symbols, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(s, 0) as s, coalesce(n, 0) as n from base left join scored using (rid) left join again using (rid))
  select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words as base_failed,
  not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words) and s >= {round(THRESHOLD * SCALE)} * n as kept,
  case when n > 0 then cast(s as double) / n / {SCALE} else 0.0 end as score from whole"""


# Patterns in this engine's syntax and the order of the kinds; lengths are checked behind the matching.
_KINDS = ("assign", "access", "hex", "identifier", "opaque", "endpoint")
_PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
    "identifier": r"""(?i:access_?key_?id|client_?id|account|user(?:name)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{3,}""",
    "opaque": "[A-Za-z0-9+/_-]+",
    "endpoint": r"""(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x20\x09-\x0D"'<>]{4,}""",
    "scope": r"\n[\x20\x09\x0D]*\n",
}
_GOOD = {
    "assign": "length(value) >= 6",
    "access": "length(whole) >= 20",
    "hex": "length(whole) >= 24",
    "opaque": "length(whole) >= 20 and regexp_matches(whole, '[0-9]') and regexp_matches(whole, '[A-Z]') and regexp_matches(whole, '[a-z]')",
}


def _places(kind: str) -> str:
    pattern = "'" + _PATTERNS[kind].replace("'", "''") + "'"
    found, group = f"regexp_extract_all(t, {pattern})", f"regexp_extract_all(t, {pattern}, 1)"
    return f"""select rid, '{kind}' as kind, {_KINDS.index(kind) if kind in _KINDS else -1} as ord, e - length(whole) as s, e from
      (select rid, whole, value, sum(gap + length(whole)) over (partition by rid order by i) as e from
        (select rid, i, {found}[i] as whole, {f"{group}[i]" if kind == "assign" else "''"} as value, length(string_split_regex(t, {pattern})[i]) as gap
          from doc, lateral (select unnest(range(1, len({found}) + 1)) as i)))
      where {_GOOD.get(kind, 'true')}"""


def _touched(kinds: str) -> str:
    return f"exists (select 1 from part b where b.rid = a.rid and b.kind in ({kinds}) and b.s < a.e and a.s < b.e)"


def _near(condition: str) -> str:
    return f"exists (select 1 from fit b where b.rid = a.rid and b.scope = a.scope and ({condition}))"


_BASE_KINDS = "'assign', 'access', 'hex'"
_LIST = "string_agg(kind || ':' || s || ':' || e, ',' order by s, ord)"
SECRET_SCAN = f"""with doc as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
  found as (select rid, kind, ord, cast(s as bigint) as s, cast(e as bigint) as e from ({' union all '.join(_places(k) for k in _PATTERNS)})),
  part as (select p.*, (select count(*) from found b where b.rid = p.rid and b.kind = 'scope' and b.s <= p.s) as scope from found p where kind <> 'scope'),
  seen as (select *, {_touched("'endpoint'")} as on_endpoint, {_touched("'access', 'identifier'")} as on_name,
    exists (select 1 from part b where b.rid = a.rid and b.kind in ('assign', 'hex') and b.s <= a.s and b.e >= a.e) as inside from part a),
  fit as (select * from seen where not (kind = 'identifier' and on_endpoint or kind = 'opaque' and (on_endpoint or on_name or inside))),
  kept as (select * from fit a where kind in ({_BASE_KINDS})
    or kind = 'identifier' and {_near("b.kind in ('assign', 'hex', 'opaque')")}
    or kind = 'opaque' and {_near("b.kind in ('access', 'identifier', 'endpoint')")}
    or kind = 'endpoint' and {_near("b.kind = 'opaque' or b.kind in ('assign', 'hex') and not b.on_endpoint")})
  select doc_id, {', '.join(f"count(*) filter (kind = '{k}') as n_{k}" for k in _KINDS[:3])},
  sha256(coalesce({_LIST} filter (kind in ({_BASE_KINDS})), '')) as base_sha256, coalesce({_LIST}, '') as spans, count(*) filter (ord >= 3) as n_linked
  from doc left join kept using (rid) group by rid, doc_id"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TABLE = _CRC[: _CRC.index("tails as")].rstrip().rstrip(",")


def _features(name: str, key: str, table: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""{name}_words as (select row_number() over () as rid, {key}, regexp_extract_all({lower}, '{_ALNUM}') as w from {table}),
  {name} as (select rid, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as x from {name}_words)"""


IMPORTANCE = f"""with {_features('d', 'doc_id', 'documents')}, {_features('b', 'item_id', 'benchmark')}, {_TABLE},
  word as (select distinct x from (select x from d union all select x from b)),
  code as (select x, xor(list_reduce(list_concat([4294967295], list_transform(range(cast(len(hex(encode(x))) / 2 as bigint)),
    lambda i: cast('0x' || substr(hex(encode(x)), cast(2 * i + 1 as int), 2) as bigint))),
    lambda c, v: xor(c >> 8, t[cast((xor(c, v) & 255) + 1 as int)])), 4294967295) % 10000 as bucket from word, tab),
  raw as (select bucket, count(*) as s from d join code using (x) group by bucket),
  wanted as (select bucket, count(*) as t from b join code using (x) group by bucket),
  gain as (select bucket, cast(floor(1000 * ln(((coalesce(t, 0) + 1.0::double) * ((select count(*) from d) + 10000))
    / ((coalesce(s, 0) + 1.0::double) * ((select count(*) from b) + 10000)))) as bigint) as g from raw full join wanted using (bucket)),
  summed as (select rid, count(*) as n, sum(g) as total from d join code using (x) join gain using (bucket) group by rid),
  weighed as (select rid, doc_id, len(w) as n_words, coalesce(n, 0) as n_features,
    coalesce(cast((total - ((total % n) + n) % n) / n as bigint), 0) as weight,
    cast('0x' || substr(sha256('7:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) as h from d_words left join summed using (rid)),
  scored as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from weighed),
  placed as (select rid, row_number() over (order by score desc, doc_id nulls last, rid) as place from scored where n_words >= 20)
  select doc_id, n_features, weight, score, case when place <= (25 * (select count(*) from placed)) // 100 then place end as rank
  from scored left join placed using (rid)"""

_INTEGERS = "list_transform(embedding, lambda x: floor(256 * cast(x as double)))"
TOPK_SEARCH = f"""with v as (select row_number() over () as rid, vec_id, {_INTEGERS} as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
  scored as (select q.rid, q.vec_id as query_id, c.rid as other, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
    from v q, v c where q.vec_id % 50 = 0 and q.rid <> c.rid)
  select query_id, row_number() over (partition by rid order by score desc, vec_id nulls last, other) as rank, vec_id, score
  from scored qualify rank <= 5"""


def _terms(text: str) -> str:
    plain = f"regexp_replace(lower({text}), '\\bv(ersion)?\\.? *([0-9])', 'version \\2', 'g')"
    plain = f"regexp_replace(regexp_replace({plain}, '[^a-z0-9.-]+', ' ', 'g'), '\\.([^0-9]|$)', ' \\1', 'g')"
    return f"list_filter(string_split({plain}, ' '), lambda x: regexp_matches(x, '[a-z0-9]'))"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_PIECE = "unnest({parts}) as unit, unnest(range(len({parts}))) as pos"
_LINES = r"string_split(regexp_replace(t, '([.!?;])[\x20\x09]+([A-Z(])', '\1' || chr(10) || '\2', 'g'), chr(10))"
_PARAGRAPHS = r"string_split_regex(t, '\n[\x20\x09\x0D]*\n')"
LICENSE_SCAN = f"""with tpl as (select * from (values {', '.join(f'({i}, {_text(name)}, {_text(text)})' for i, (name, text) in enumerate(TEMPLATES))}) v(template, license, wording)),
  doc as (select row_number() over () as rid, doc_id, coalesce(source, 'unknown') || '/' || coalesce(lang, 'unknown') as folder,
    cast(doc_id as varchar) || '.txt' as name, coalesce(text, '') as t from documents),
  tt as (select template, license, term, count(*) as tf from (select template, license, unnest({_terms('wording')}) as term from tpl) group by all),
  held as (select distinct rid, term from (select rid, unnest({_terms('t')}) as term from doc) semi join tt using (term)),
  weight as (select term, ln((1.0::double + (select count(*) from doc)) / (1 + count(rid))) + 1 as idf
    from (select distinct term from tt) left join held using (term) group by term),
  tw as (select template, license, term, (1 + ln(tf)) * idf / sqrt(sum(pow((1 + ln(tf)) * idf, 2)) over (partition by template)) as w from tt join weight using (term)),
  piece as (select rid, 0 as kind, 0 as pos, t as unit from doc
    union all select rid, 1, pos, unit from (select rid, {_PIECE.format(parts=_PARAGRAPHS)} from doc)
    union all select rid, 2, pos, unit from (select rid, {_PIECE.format(parts=_LINES)} from doc)),
  named as (select rid, kind, pos, trim(unit) as unit from piece),
  ut as (select unit, term, count(*) as tf from (select unit, unnest({_terms('unit')}) as term from (select distinct unit from named)) group by all),
  ua as (select unit, term, idf is not null as known, (1 + ln(tf)) * coalesce(idf, ln(1.0::double + (select count(*) from doc)) + 1) as a from ut left join weight using (term)),
  norm as (select unit, sqrt(sum(a * a)) as norm from ua group by unit),
  cosine as (select unit, license, round(sum(a * w) / any_value(norm), 6) as c from ua join tw using (term) join norm using (unit) where known group by unit, template, license),
  matched as (select unit, license, c from cosine where c >= {LEAST} qualify row_number() over (partition by unit order by c desc, license) = 1),
  best as (select rid, kind, license, c from named join matched using (unit)
    qualify row_number() over (partition by rid order by license = 'Proprietary', kind, c desc, pos, license) = 1),
  placed as (select doc.*, license, c, kind, kind is not null and (kind = 0 or regexp_matches(name, '{FILE_NAME}')) as is_file from doc left join best using (rid)),
  up as (select folder as up, arg_min(license, (-c, name, license)) as license, max(c) as c from placed where is_file group by folder),
  near as (select folder, arg_max(up.license, length(up)) as near_license, arg_max(up.c, length(up)) as near_c
    from (select distinct folder from doc) f join up on f.folder = up or starts_with(f.folder, up || '/') group by folder)
  select doc_id, folder || '/' || name as path, coalesce(license, near_license) as license, coalesce(c, near_c) as cosine,
  case when is_file then 'file' when kind = 1 then 'header' when kind = 2 then 'statement' when near_c is not null then 'inherited' end as origin
  from placed left join near using (folder)"""

SQL = {
    "op1_decontaminate": DECONTAMINATE,
    "op3_quality_rules": QUALITY_RULES,
    "op5_warc": WARC,
    "op8_license_scan": LICENSE_SCAN,
    "op10_secret_scan": SECRET_SCAN,
    "op11_importance": IMPORTANCE,
    "op12_topk_search": TOPK_SEARCH,
}
