"""The registered queries of the package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockledger.llm import (
    chat,
    divergence,
    embeddings,
    fingerprints,
    language,
    lines,
    minhash,
    mixing,
    packing,
    repair,
    repetition,
    token_files,
    urls,
)

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Fixed: the rules that pages are judged by.
URL_RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return urls.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
with rest as (
  select page_id, row_number() over () as k,
         case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
u as (
  select page_id, k,
         translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) as path
  from rest),
r(verdict, host, path) as (values
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/'))
select any_value(u.page_id) as page_id, any_value(u.host) as host, any_value(u.path) as path,
       max_by(r.host || r.path, length(r.host || r.path)) as rule,
       coalesce(max_by(r.verdict, length(r.host || r.path)), 'allow') as verdict
from u left join r on (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path)
group by u.k
"""


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(_documents(spark, sf_dir), tokenizer_path())


def op3_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(_documents(spark, sf_dir))


def op4_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP4_SQL = f"""
with t as (
  select conv_id, coalesce(turn, 9223372036854775807) as turn, coalesce(role, 'unknown') as role,
         replace(coalesce(text, ''), '<|', '< |') as text
  from conversations),
p as (select distinct conv_id, role as speaker from t where role <> 'system'),
s as (
  select t.conv_id, p.speaker, t.turn, t.role, t.role = p.speaker as own,
         '<|im_start|>' || case when t.role = 'system' then t.role when t.role = p.speaker then 'assistant'
           else 'user name=' || regexp_replace(t.role, '\\s', '_', 'g') end || chr(10) as head, t.text
  from t join p on t.conv_id is not distinct from p.conv_id),
r as (select *, head || text || '<|im_end|>' || chr(10) as segment from s),
o as (
  select *, coalesce(sum(length(segment)) over (
           partition by conv_id, speaker order by turn, role, segment
           rows between unbounded preceding and 1 preceding), 0)::bigint as place
  from r),
q as (select *, (place // {chat.PART_CHARS})::int as part from o),
b as (select *, min(place) over (partition by conv_id, speaker, part) as base from q)
select conv_id, speaker, part, count(*)::int as n_turns,
       string_agg(segment, '' order by place) as text,
       coalesce(string_agg((place - base + length(head))::varchar || '-' || (place - base + length(segment) - 1)::varchar,
                           ',' order by place) filter (own), '') as mask
from b group by conv_id, speaker, part
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_decisions(_documents(spark, sf_dir)).select("doc_id", "line_no", "n_words", "kept", "near")


OP5_SQL = """
with l as (
  select doc_id, line_no, list_sort(list_distinct(regexp_extract_all(
           lower(line), '[^\x20\x09-\x0D]+'))) as w
  from (select doc_id, (generate_subscripts(ls, 1) - 1)::int as line_no, unnest(ls) as line
        from (select doc_id, string_split(text, chr(10)) as ls from documents))),
c as (
  select row_number() over () as id, w, len(w) as n, min(doc_id::hugeint * 4294967296 + line_no) as place
  from l where len(w) > 0 group by w),
f as (select t, count(*) as f from (select unnest(w) as t from c) group by t),
e as (
  select id, n, place, t from (
    select id, n, place, t, row_number() over (partition by id order by f, t) as pos
    from (select id, n, place, unnest(w) as t from c) join f using (t))
  where pos <= n - (75 * n + 99) // 100 + 1),
p as (
  select distinct x.id as id, y.id as earlier from e x join e y
  on x.t = y.t and y.place < x.place and 4 * x.n >= 3 * y.n and 4 * y.n >= 3 * x.n),
m as (
  select distinct p.id from p join c x on x.id = p.id join c y on y.id = p.earlier
  where 100 * len(list_intersect(x.w, y.w)) >= 75 * (x.n + y.n - len(list_intersect(x.w, y.w))))
select l.doc_id, l.line_no, c.n::int as n_words,
       m.id is null and c.place = l.doc_id::hugeint * 4294967296 + l.line_no as kept, m.id is not null as near
from l join c on l.w = c.w left join m on m.id = c.id
"""


def op6_shard_graphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_documents(spark, sf_dir), tokenizer_path())


def op8_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


#: The mixture: each domain's share of the tokens, and all tokens as a multiple of the corpus'.
MIX_TARGETS = {"good": 0.84, "poor": 0.14, "toxic": 0.02}
MIX_FACTOR = 1.25


def domains_of_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, domain``: toxic, else poor or good by the quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain")).where("domain is not null")


def op9_soft_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = domains_of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mixed = mixing.mix(_documents(spark, sf_dir).select("doc_id", "text"), labelled, MIX_TARGETS, MIX_FACTOR)
    shares = [F.col("posteriors")[k].alias(f"p_{domain}") for k, domain in enumerate(MIX_TARGETS)]
    return mixed.select("doc_id", "n_tokens", *shares, "rate", "copies", "miss")


def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(_documents(spark, sf_dir))


def op11_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judged(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_IN_NGRAMS = " union all ".join(
    f"select {n} as n, {percent} as most" for n, percent in repetition.MOST_IN_NGRAMS.items()
)
OP11_SQL = (
    r"""
with t as (select row_number() over () as id, doc_id, coalesce(text, '') as text from documents),
d as (select id, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from t),
lengths as (select 3 as n, null as most union all """
    + _IN_NGRAMS
    + r"""),
g as (
  select id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') as gram
  from (select id, w, n, unnest(range(1, len(w) - n + 2)) as pos from d, lengths)),
r as (
  select id, n, pos, count(*) over (partition by id, n, gram) > 1 as again,
         row_number() over (partition by id, n, gram order by pos) > 1 as later
  from g),
covered as (
  select id, n, pos + k as word, bool_or(later) as later
  from (select id, n, pos, later, unnest(range(n)) as k from r where again) group by all),
shares as (
  select c.id, c.n, count(*) as words, sum(length(d.w[c.word])) filter (c.later) as chars
  from covered c join d using (id) group by all),
l as (
  select id, line, row_number() over (partition by id, line) > 1 as later
  from (select id, unnest(string_split(text, chr(10))) as line from t)
  where regexp_matches(line, '[^\x20\x09-\x0D]')),
repeated as (
  select id, count(*) as n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) as chars
  from l where later group by id),
f as (
  select d.id, d.doc_id, len(d.w)::bigint as n_words,
         length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::bigint as word_chars,
         length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         coalesce(m.n, 0)::bigint as n_dup_lines, coalesce(m.chars, 0)::bigint as dup_line_chars,
         coalesce(s.words, 0)::bigint as n_repeat_words
  from d left join repeated m using (id) left join shares s on s.id = d.id and s.n = 3),
over as (
  select distinct s.id from shares s join lengths using (n) join f using (id)
  where 100 * s.chars > lengths.most * f.word_chars),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from f)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 100 * dup_line_chars <= 20 * word_chars and over.id is null as kept
from b left join over using (id)
"""
)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _way(state: str, cost: int, letters: str, *turns: str) -> str:
    """SQL of the edits behind a state with more of them; null where the state is not reached."""
    said = f"list_concat({state}.t, [{', '.join(turns)}])" if turns else f"{state}.t"
    return f"case when {state} is not null then {{'c': {state}.c + {cost}, 'z': {state}.z || '{letters}', 't': {said}}} end"


_STAYS = "case when not must then list_transform([{}], lambda x: case when x is not null then {{'c': x.c + {} + cut, 'z': x.z || '{}', 't': list_append(x.t, {})}} end) else [] end"
_GONE = "list_transform([{}], lambda x: case when x is not null then {{'c': x.c + 3, 'z': x.z || 'D', 't': x.t}} end)"
# states after inserts: what stands before a turn that comes next as user, as assistant
_BEFORE_USER = ", ".join(["e", "s", "a", _way("u", 2, "I", "'assistant:'"), _way("e", 4, "II", "'user:'", "'assistant:'"), _way("s", 4, "II", "'user:'", "'assistant:'")])
_AFTER_USER = ", ".join(["u", *(_way(q, 2, "I", "'user:'") for q in "esa")])
_AFTER_ASSISTANT = ", ".join(["a", _way("u", 2, "I", "'assistant:'"), *(_way(q, 4, "II", "'user:'", "'assistant:'") for q in "es")])


def _least(*lists: str) -> str:
    joined = lists[0]
    for more in lists[1:]:
        joined = f"list_concat({joined}, {more})"
    return f"list_sort(list_filter({joined}, lambda x: x is not null))[1]"


OP12_SQL = f"""
with recursive src as (
  select conv_id, coalesce(conv_id::varchar, ' ') as conv, turn, coalesce(role, ' ') as role,
         coalesce(text, ' ') as text,
         string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), '') as key
  from conversations),
hashed as (
  select *, xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(key, lambda c: ascii(c)::ubigint)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::ubigint[]),
      lambda x, none: xor(x >> 1, case when x & 1 = 1 then 3988292384::ubigint else 0::ubigint end))),
    4294967295::ubigint) % 20 as how
  from src),
rows as (
  select conv, turn, case when how = 4 then 'user' else role end as role,
         case how when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when how = 3 then [0, 1] else [0] end) as copy
  from hashed where how <> 0),
numbered as (
  select *, row_number() over (partition by conv order by turn nulls first, role, text, copy) as i from rows),
faults as (
  select *, case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 'blank'
    when row_number() over (partition by conv, role, text order by i) > 1 then 'duplicate'
    when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then 'truncated' else '' end as fault,
    lag(left(role, 1)) over (partition by conv order by i) as before
  from numbered),
counts as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (before || left(role, 1) not in ('su', 'ua', 'au')) as illegal, max(i) as last
  from faults group by conv),
turns as (
  select conv, i, left(role, 1) as h, text, role || ':' || text as own, fault in ('blank', 'duplicate') as must,
         (fault = 'truncated')::int as cut
  from faults),
dp as (
  select distinct conv, 0::bigint as i, {{'c': 0, 'z': '', 't': []::varchar[]}} as e,
         null::struct(c int, z varchar, t varchar[]) as s, null::struct(c int, z varchar, t varchar[]) as u,
         null::struct(c int, z varchar, t varchar[]) as a
  from src
  union all
  select conv, i, e_next, s_next, u_next, a_next from (
    select r.conv, r.i,
      {_least(_GONE.format("e"))} as e_next,
      {_least(_GONE.format("s"), "case when r.h = 's' then " + _STAYS.format("e", 0, "K", "own") + " else [] end")} as s_next,
      {_least(_GONE.format(_AFTER_USER), "case when r.h = 'u' then " + _STAYS.format(_BEFORE_USER, 0, "K", "own") + " else [] end", _STAYS.format(_BEFORE_USER, 2, "R", "'user:' || text"))} as u_next,
      {_least(_GONE.format(_AFTER_ASSISTANT), "case when r.h = 'a' then " + _STAYS.format(_AFTER_USER, 0, "K", "own") + " else [] end", _STAYS.format(_AFTER_USER, 2, "R", "'assistant:' || text"))} as a_next
    from dp join turns r on r.conv = dp.conv and r.i = dp.i + 1)),
best as (
  select dp.conv, {_least("[e, a, " + _way("u", 2, "I", "'assistant:'") + ", " + _way("s", 4, "II", "'user:'", "'assistant:'") + "]")} as b
  from dp left join counts using (conv) where dp.i = coalesce(counts.last, 0))
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, b.c::bigint as cost, b.z as audit,
       sha256(array_to_string(b.t, chr(10))) as repaired_sha256
from (select distinct conv_id, conv from src) o join best using (conv) left join counts using (conv)
"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_documents(spark, sf_dir))


OP13_SQL = r"""
with d as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
w as (
  select id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
k as (select lang, term from w group by lang, term having count(distinct id) >= 30),
sizes as (select lang, count(*) as v from k group by lang),
c as (select lang, source, term, count(*) as n from w join k using (lang, term) group by all),
totals as (select lang, source, sum(n) as total from c group by all),
g as (
  select lang, source, coalesce(total, 0) as total, coalesce(v, 0) as v
  from (select distinct lang, source from d) left join totals using (lang, source) left join sizes using (lang)),
p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.v) as p
  from g join k using (lang) left join c using (lang, source, term)),
q as (
  select lang, term, 1 + (1000000000::hugeint * (sum(n) + 5)) // (any_value(whole) + 5 * any_value(v)) as q
  from p join (select lang, sum(total) as whole, max(v) as v from g group by lang) using (lang) group by lang, term),
f as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum(abs(x.p - y.p)), 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join p x on x.lang = a.lang and x.source = a.source
  left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all
  union all
  select lang, source, 'term', term, (p - q)::bigint from p join q using (lang, term) where n > 0 and p > q)
select lang, source, part, item, value, rank
from (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from f)
where part = 'pair' or rank <= 50
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_rules,
        op2_curve_packing,
        op3_phrase_fingerprints,
        op4_perspectives,
        op5_line_dedup,
        op6_shard_graphs,
        op7_token_files,
        op8_bbit_minhash,
        op9_soft_mixture,
        op10_cross_parsing,
        op11_repetition,
        op12_turn_repair,
        op13_source_divergence,
    )
}
STATEMENTS: dict[str, str] = {
    "op1_url_rules": OP1_SQL,
    "op4_perspectives": OP4_SQL,
    "op5_line_dedup": OP5_SQL,
    "op11_repetition": OP11_SQL,
    "op12_turn_repair": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
