"""Registered queries of this folder and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    chat, decontamination, fill_in_middle, fingerprints, hard_negatives, html_extraction, language, ngram_join, packing, pii, substrings,
    token_counts, url_filter,
)
from strata.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` and, if there is one, its SQL."""

    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


#: The conversation that looks like markup itself.
LOOKALIKE = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]

OP1_SQL = r"""
with c as (
 select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
 union all select -7, 0, 'user', '\### Assistant: </turn> ok'
 union all select -7, 1, 'assistant', '\### Assistant: </turn> ok')
select conv_id, count(*) as n_turns,
 sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
 cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
 sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
 cast(sum(length('### ') + length(replace(replace(role, '%', '%25'), chr(10), '%0A')) + 1 + length(text)
  + (length(text) - length(replace(text, '</turn>', ''))) // 7
  + (length(text) - length(replace(text, '### ', ''))) // 4
  + length('n</turn>n')) as bigint) as formatted_chars
from c group by conv_id"""


@query("op1_chat_formatting", OP1_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return chat.format_digests(rows.unionByName(spark.createDataFrame(LOOKALIKE, "conv_id long, turn long, role string, text string")))


@query("op2_personal_data")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(table(spark, folder, "documents"))


@query("op3_benchmark_decontamination")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op4_ngram_jaccard_join")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, folder, "documents"))


@query("op5_token_counts")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"))


@query("op6_packing")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query("op7_substring_dedup")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents"), with_text=False)


@query("op8_language_id")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_documents(table(spark, folder, "documents"))


@query("pages_language")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_pages(table(spark, folder, "pages"), table(spark, folder, "documents"))


OP9_SQL = r"""
with u as (
 select page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
 from pages),
j as (select *, case
  when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
  when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
  when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
  when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
  when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end as rule from u),
parts as (select distinct url, 's:' || regexp_replace(x, '[0-9]+', '#', 'g') as t
  from (select url, unnest(string_split(regexp_extract(url, '(?s)^(.*?)://', 1), ':')) as x from u) where x <> ''
 union select distinct url, 'h:' || regexp_replace(x, '[0-9]+', '#', 'g')
  from (select url, unnest(string_split(host, '.')) as x from u) where x <> ''
 union select distinct url, 'p:' || regexp_replace(x, '[0-9]+', '#', 'g')
  from (select url, unnest(string_split(path, '/')) as x from u) where x <> ''
 union select distinct url, 'q:' || regexp_replace(x, '[0-9]+', '#', 'g')
  from (select url, regexp_extract(unnest(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&')), '^[^=]*') as x from u) where x <> ''),
labelled as (select row_number() over () as r, u.url, coalesce(l.toxic = 1, false) or coalesce(l.quality = 0, false) as bad
 from u join labels l on u.page_id = l.doc_id where u.url is not null and (l.toxic is not null or l.quality is not null)),
least as (select greatest(5, ceil(count(*) * 0.002)) as n from labelled),
lists as (select url, list_sort(list(t)) as ts from parts group by url),
subsets as (select bad, list_filter(ts, lambda x, i: (m >> (i - 1)) & 1 = 1) as s
 from (select bad, ts, unnest(range(1, 1 << len(ts))) as m from labelled join lists using (url))),
rules as (select s from subsets group by s
 having count(*) filter (bad) >= (select n from least) and 100 * count(*) filter (bad) >= 60 * count(*)),
hit as (select distinct url from lists join rules on list_has_all(ts, s))
select page_id, host, path, rule,
 case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
  when url in (select url from hit where url is not null) then 'block' else 'allow' end as verdict
from j"""


@query("op9_url_filters", OP9_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), table(spark, folder, "labels"))


@query("op10_document_fingerprints")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_documents(table(spark, folder, "documents"))


# What the given pages are made of: one article of headings and paragraphs, in which tags are
# inline but for p and h1, and only paragraphs may lack their end.
OP11_SQL = r"""
with a as (select page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) as body from pages),
b as (select page_id, url, n, trim(regexp_replace(regexp_replace(replace(replace(replace(
   regexp_replace(regexp_replace(block, '<br>', ' ', 'g'), '<[^>]*>', '', 'g'),
   '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) as block
 from (select page_id, url, unnest(regexp_split_to_array(body, '</?(?:p|h1)>')) as block,
  generate_subscripts(regexp_split_to_array(body, '</?(?:p|h1)>'), 1) as n from a)),
t as (select page_id, url, coalesce(string_agg(block, chr(10) || chr(10) order by n) filter (block <> ''), '') as text
 from b group by page_id, url)
select page_id, url, text, length(text) as n_chars from t"""


@query("op11_html_extraction", OP11_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return html_extraction.main_text(table(spark, folder, "pages"))


OP12_SQL = r"""
with t as (
 select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as toks,
  sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
d as (select *, len(toks) as n, cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
  cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from t),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
  case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
   when h4 % 100 < 20 then 'spm' else 'psm' end as form from d),
p as (select *, array_to_string(toks[1:a], '') as prefix, array_to_string(toks[a + 1:b], '') as middle,
  array_to_string(toks[b + 1:n], '') as suffix from c)
select doc_id, cast(n as bigint) as n, form,
 case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
 case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
 sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
  else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
 sha256(text) as restored_sha256
from p"""


@query("op12_fill_in_middle", OP12_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle.middle_digests(table(spark, folder, "documents"))


OP13_SQL = """
with r as (
 select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v, len(embedding) as d
 from embeddings where vec_id is not null and label is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
  cast(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])), 0) as bigint) as score
 from r a join r b on a.vec_id % 100 = 0 and a.d = b.d and a.vec_id <> b.vec_id),
p as (select anchor_id, other_id as positive_id, score as positive_score from s where same
 qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select anchor_id, positive_id,
 cast(row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as integer) as rank,
 other_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10"""


@query("op13_hard_negatives", OP13_SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(table(spark, folder, "embeddings"))
