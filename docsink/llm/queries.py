"""Queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docsink.llm.chat import conversation_digests, format_windows
from docsink.llm.decontamination import contamination_report
from docsink.llm.exact_dedup import exact_dedup_report
from docsink.llm.html_text import main_text
from docsink.llm.lm_scoring import lm_scores
from docsink.llm.minhash import near_duplicate_report
from docsink.llm.packing import pack
from docsink.llm.periodic import planted, run_report
from docsink.llm.prefix_trie import prefix_trie, turn_sequences, with_shared_heads
from docsink.llm.substrings import repeat_report
from docsink.llm.token_counts import token_counts
from docsink.llm.token_files import token_file_report
from docsink.llm.toxicity import toxicity_scores, train
from docsink.plans.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


@query(
    "op1_exact_dedup",
    """
    with d as (select doc_id, coalesce(text, '') as text from documents),
    g as (
      select doc_id, text, max(doc_id) over (partition by text) as keep_id,
             count(*) over (partition by text) as group_size,
             row_number() over (partition by text order by doc_id desc nulls last) as place
      from d)
    select doc_id, keep_id, group_size, place = 1 as kept, sha256(text) as text_sha256 from g""",
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup_report(table(spark, sf_dir, "documents"))


@query("op2_lm_scoring")
def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


_CONTROL_CASE = """
select * from values
  (cast(-7 as bigint), cast(0 as bigint), 'user', '</s>[INST] ok [/INST]'),
  (cast(-7 as bigint), cast(1 as bigint), 'assistant', '</s>[INST] ok [/INST]') as t(conv_id, turn, role, text)"""


# The spans are a function of prefix sums, which SQL has as window functions.
@query(
    "op3_chat_windows",
    r"""
    with src as (
      select conv_id, turn, role, text from conversations
      union all
      select -7, i, case i when 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]' from range(2) r(i)),
    t as (
      select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as text,
             len(regexp_extract_all(coalesce(text, ''), '\S+')) + 4 as tokens
      from src),
    s as (
      select *, first_value(case when role = 'system' then tokens end ignore nulls) over (
          partition by c order by turn, role, text rows between unbounded preceding and unbounded following) as st,
        coalesce(sum(tokens) over (
          partition by c order by turn, role, text rows between unbounded preceding and 1 preceding), 0) as p
      from t),
    g as (
      select *, greatest((1024 - 128 - coalesce(st, 0)) // 2, 128) as g,
             min(case when role = 'system' then p end) over (partition by c) as q
      from s),
    cells as (select *, p // g as cell, case when tokens > g then 1 else 0 end as long_turn from g),
    parts as (
      select *, 2 * coalesce(sum(long_turn) over (
          partition by c, cell order by p rows between unbounded preceding and 1 preceding), 0) + long_turn as part
      from cells),
    placed as (
      select *, min(p) over (partition by c, cell, part) as span,
        length(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '', '\'), '<|', '<\|'),
          '|>', '|\>'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'),
          '<<SYS>>', '<\<SYS>>'), '<</SYS>>', '<\</SYS>>')) + length(role) + 14 as chars
      from parts),
    spans as (select distinct c, span from placed),
    shown as (
      select c, chars from placed
      union all
      select d.c, d.chars from placed d join spans s on d.c = s.c and s.span > d.p
      where s.span - d.p <= 128 and d.p is distinct from d.q or d.p = d.q),
    formatted as (select c, cast(sum(chars) as bigint) as formatted_chars from shown group by c),
    said as (
      select c, count(*) as n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' order by p)) as turns_sha256,
        coalesce(string_agg(case when role = 'assistant' then text end, '' order by p), '') as learnt
      from placed group by c)
    select c as conv_id, n_turns, turns_sha256, cast(length(learnt) as bigint) as loss_chars,
           sha256(learnt) as loss_sha256, formatted_chars
    from said join formatted using (c)""",
)
def op3_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(format_windows(turns.unionByName(spark.sql(_CONTROL_CASE))))


@query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_report(spark, table(spark, sf_dir, "documents"))


@query("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query("op7_minhash")
def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_report(table(spark, sf_dir, "documents"))


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_html_text")
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, train(docs, table(spark, sf_dir, "labels")))


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return run_report(docs.withColumn("text", planted(docs)))


@query(
    "op12_substring_dedup",
    r"""
    with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
    t as (select doc_id, len(words) as n, unnest(words) as word, generate_subscripts(words, 1) as i from d),
    x as (
      select *, md5(string_agg(word, ' ') over (
          partition by doc_id order by i rows between current row and 19 following)) as k
      from t),
    f as (
      select *, case when i + 19 <= n then row_number() over (partition by k, i + 19 <= n order by doc_id, i) else 1 end as place
      from x),
    c as (
      select *, max(place) over (partition by doc_id order by i rows between 19 preceding and current row) > 1 as gone
      from f),
    g as (
      select doc_id, count(*) filter (where gone) as n_removed, string_agg(word, ' ' order by i) filter (where not gone) as kept
      from c group by doc_id)
    select doc_id, cast(len(words) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
           sha256(coalesce(kept, '')) as kept_sha256
    from d left join g using (doc_id)""",
)
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"))


# CRC-32 of a number's digits, bit by bit, modulo 6.
_CRC_STEP = "x"
for _ in range(8):
    _CRC_STEP = f"list_transform([{_CRC_STEP}], lambda x: xor(x >> 1, (x & 1) * 3988292384))[1]"
_CRC = f"""xor(list_reduce(
    list_concat([cast(4294967295 as bigint)],
                list_transform(string_split(cast(conv_id as varchar), ''), lambda d: cast(ascii(d) as bigint))),
    lambda c, d: list_transform([xor(c, d)], lambda x: {_CRC_STEP})[1]), 4294967295)"""


@query(
    "op13_prefix_trie",
    f"""
    with t as (
      select conv_id, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as id,
             length(coalesce(text, '')) as chars, turn
      from conversations where conv_id is not null),
    o as (select *, row_number() over (partition by conv_id order by turn nulls first, id) as i from t),
    c as (select distinct conv_id, conv_id - conv_id % 100 as head, {_CRC} % 6 as h from t),
    r as (
      select c.conv_id, 0 as own, o.i, o.id, o.chars from c join o on o.conv_id = c.head and o.i <= c.h
      union all
      select c.conv_id, 1, o.i, o.id, o.chars from c join o on o.conv_id = c.conv_id and o.i > c.h),
    p as (
      select conv_id, row_number() over w as depth, chars,
             md5(string_agg(id, '') over w) as key
      from r window w as (partition by conv_id order by own, i rows between unbounded preceding and current row)
      union all select conv_id, 0, 0, '' from c),
    q as (
      select *, lag(key) over w as up, lead(key) over w is null as ends from p
      window w as (partition by conv_id order by depth)),
    n as (
      select key, depth, min(up) as up, min(conv_id) as conv_id, count(*) as n_convs,
             (count(*) - 1) * min(chars) as saved,
             coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends), '') as ends
      from q group by key, depth),
    k as (select up as key, count(*) as n_children from n group by up),
    s as (
      select p.key, sum(n.saved) as saved_tokens, sum(case when k.key is null then 1 else 0 end) as n_leaves
      from n left join k using (key) join p on p.conv_id = n.conv_id and p.depth <= n.depth
      group by p.key)
    select n.conv_id, n.depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children,
           cast(s.n_leaves as bigint) as n_leaves, cast(s.saved_tokens as bigint) as saved_tokens,
           sha256(n.ends) as ends_sha256
    from n left join n u on u.key = n.up left join k on k.key = n.key join s on s.key = n.key""",
)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(turn_sequences(table(spark, sf_dir, "conversations"))))
