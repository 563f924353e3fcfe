"""The queries of this package over the driver's tables, each with the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from vejrkraft.llm import (
    alignment,
    chat,
    decontaminate,
    html_text,
    importance,
    jaccard_tree,
    mixing,
    passages,
    periodic,
    quality_rules,
    sharding,
    toxicity,
    url_rules,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


OP5_SQL = r"""
with d as (select row_number() over () r, doc_id, coalesce(text, '') as txt from documents),
w as (select *, regexp_extract_all(txt, '[^\x20\x09-\x0D]+') ws,
  list_filter(string_split(txt, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) ls from d),
m as (select *, len(ws) n_words,
  length(array_to_string(ws, '')) word_chars,
  length(txt) - length(translate(txt, '#*$%&|<>', '')) n_symbols,
  len(ls) n_lines, len(ls) - len(list_distinct(ls)) n_dup_lines from w),
g as (select r, i, array_to_string(ws[i:i + 7], chr(1)) g
  from (select r, ws, unnest(range(1, len(ws) - 6)) i from m where len(ws) >= 8)),
a as (select r, i from g qualify count(*) over (partition by r, g) >= 2),
c as (select r, sum(least(8, coalesce(nxt - i, 8))) n
  from (select r, i, lead(i) over (partition by r order by i) nxt from a) group by r),
f as (select m.*, coalesce(c.n, 0) n_repeat_words,
  n_words < 20 or 100 * coalesce(c.n, 0) > 30 * n_words base_failed from m left join c using (r))
select doc_id, n_words::bigint n_words, word_chars::bigint word_chars, n_symbols::bigint n_symbols,
  n_dup_lines::bigint n_dup_lines, n_repeat_words::bigint n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 12 * n_words
    or 10 * n_dup_lines > 3 * n_lines
    or 2 * length(regexp_replace(txt, '[^\p{Lu}]+', '', 'g')) > word_chars
    or 2 * length(regexp_replace(txt, '[^0-9]+', '', 'g')) > word_chars) kept
from f
"""


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP8_SQL = r"""
with r(h, p, v) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u as (select row_number() over () n, page_id,
  case when strpos(url, '://') > 0 then translate(regexp_extract(
    substr(url, strpos(url, '://') + 3), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end host,
  case when strpos(url, '://') > 0 then regexp_extract(
    substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) else '' end path
  from pages),
j as (select u.*, r.* from u left join r
  on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
  qualify row_number() over (partition by n order by length(h || p) desc, length(h) desc) = 1)
select page_id, host, path, h || p as rule, coalesce(v, 'allow') verdict from j
"""


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate_perspectives(table(spark, sf_dir, "conversations"))


OP9_SQL = r"""
with t as (select conv_id, turn, coalesce(role, 'unknown') speaker, coalesce(text, '') as txt from conversations),
p as (select distinct conv_id, speaker perspective from t),
b as (select t.conv_id, perspective, turn, speaker, speaker = perspective own,
  case when speaker = perspective then '<|turn|>assistant' || chr(10)
    else '<|turn|>user name=' || replace(replace(speaker, '<|', '<||'), '|>', '||>') || chr(10) end header,
  replace(replace(txt, '<|', '<||'), '|>', '||>') || '<|end|>' body
  from t join p on t.conv_id is not distinct from p.conv_id)
select conv_id, perspective, turn, speaker, case when own then 'assistant' else 'user' end chat_role,
  case when not own then speaker end "name", header || body || chr(10) rendered,
  case when own then length(header) else 0 end::bigint mask_start,
  case when own then length(body) else 0 end::bigint mask_length
from b
"""

def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


OP1_SQL = r"""
with t as (
  select 0 kind, item_id id, row_number() over () r, coalesce(text, '') txt from benchmark where item_id is not null
  union all select 1, doc_id, row_number() over (), coalesce(text, '') from documents),
w as (select kind, id, r, regexp_extract_all(translate(txt, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') ws from t),
widths as (select distinct least(len(ws), 5) width from w where kind = 0 and len(ws) > 0),
i as (select distinct id, r, width, array_to_string(ws[p:p + width - 1], ' ') g
  from (select id, r, ws, least(len(ws), 5) width, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) p from w where kind = 0 and len(ws) > 0)),
d as (select distinct id, r, width, array_to_string(ws[p:p + width - 1], ' ') g
  from (select id, r, ws, width, unnest(range(1, len(ws) - width + 2)) p from w, widths where kind = 1 and len(ws) >= width)),
n as (select r, count(*) n from i group by r)
select d.id doc_id, i.id item_id, any_value(n.n)::int item_shingles, count(*)::int shared
from d join i using (width, g) join n on n.r = i.r group by d.id, d.r, i.id, i.r
having 100 * count(*) >= 80 * any_value(n.n)
"""


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "shard", "passes", "taken")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = jaccard_tree.jaccard_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "n_shingles", "component_id")


OP6_SQL = r"""
with recursive w as (select row_number() over () r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') ws from documents),
s as (select distinct r, array_to_string(ws[p:p + 4], ' ') g
  from (select r, ws, unnest(range(1, greatest(len(ws) - 3, 2))) p from w where len(ws) > 0)),
n as (select r, count(*) n from s group by r),
links as (select a.r x, b.r y from s a join s b using (g) join n na on na.r = a.r join n nb on nb.r = b.r
  where a.r <> b.r group by a.r, b.r
  having 100 * count(*) >= 80 * (any_value(na.n) + any_value(nb.n) - count(*))),
reach(r, o) as (select r, r from w union select reach.r, y from reach join links on o = x),
c as (select reach.r, min(w.doc_id) component_id from reach join w on w.r = o group by reach.r)
select doc_id, coalesce(n.n, 0)::bigint n_shingles, component_id from w join c using (r) left join n using (r)
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op11_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``documents``; from a place on, a tenth of the texts repeats the words found there (see the SQL)."""
    known = docs.select(
        "doc_id",
        "text",
        F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"),
    ).withColumn("g", F.expr("h div 10"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    chosen = known.withColumn("ws", F.when(F.col("h") % 10 == 0, words))
    cut = chosen.withColumn("a", F.col("g") % F.size("ws"))
    cut = cut.withColumn("p", F.expr("1 + (size(ws) - a) div (3 + g % 8)"))
    repeated = F.expr(
        "array_join(transform(sequence(0, size(ws) - 1), i -> ws[int(if(i < a, i, a + (i - a) % p))]), ' ')"
    )
    return cut.select("doc_id", F.when(F.size("ws") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(op11_texts(table(spark, sf_dir, "documents")))
    longest = F.expr("array_max(transform(runs, x -> struct(x.length, -x.start as back, -x.period as short)))")
    listed = F.expr("array_join(transform(runs, x -> concat(x.start, ',', x.length, ',', x.period, '\n')), '')")
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.short")).alias("period"),
        F.expr("1000 * best.length div -best.short").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP11_SQL = r"""
with ids as (select row_number() over () r, doc_id, coalesce(text, '') txt from documents),
crc as (select r, xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(doc_id::varchar, ''),
  lambda c: [ascii(c)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
  lambda s, b: case when xor(s, b) & 1 = 1 then xor(xor(s, b) >> 1, 3988292384) else xor(s, b) >> 1 end), 4294967295) h from ids),
plain as (select ids.r, doc_id, h, h // 10 g, regexp_extract_all(txt, '[^\x20\x09-\x0D]+') ws, len(ws) n
  from ids left join crc using (r)),
place as (select *, g % greatest(n, 1) a, 1 + (n - g % greatest(n, 1)) // (3 + g % 8) p, h % 10 = 0 and n > 0 planted from plain),
t as (select r, doc_id, n, case when planted
  then list_transform(range(n), lambda i: ws[1 + case when i < a then i else a + (i - a) % p end]) else ws end ws from place),
five as (select r, i, array_to_string(ws[i + 1:i + 5], ' ') s from (select r, ws, unnest(range(n - 4)) i from t where n >= 6)),
often as (select * from five qualify count(*) over (partition by r, s) > 1),
pairs as (select x.r, x.i, y.i - x.i q from often x join often y on x.r = y.r and x.s = y.s and x.i < y.i),
islands as (select r, q, min(i) "start", count(*) + 4 + q as "length"
  from (select *, i - row_number() over (partition by r, q order by i) isle from pairs) group by r, q, isle),
runs as (select * from islands where "length" >= greatest(6, 4 * q)
  qualify row_number() over (partition by r, "start", "length" order by q) = 1),
best as (select * from runs qualify row_number() over (partition by r order by "length" desc, "start", q) = 1),
told as (select r, count(*) n_runs, string_agg("start" || ',' || "length" || ',' || q || chr(10), '' order by "start", q) txt from runs group by r),
gone as (select distinct r, unnest(range("start" + q, "start" + "length")) i from runs),
held as (select w.r, string_agg(w, ' ' order by i) txt from (select r, unnest(ws) w, unnest(range(n)) i from t) w
  anti join gone using (r, i) group by w.r)
select doc_id, coalesce(n_runs, 0)::bigint n_runs, "start", "length"::bigint "length", q::bigint period,
  (1000 * "length" // q)::bigint exponent_milli, sha256(coalesce(told.txt, '')) runs_sha256, sha256(coalesce(held.txt, '')) collapsed_sha256
from t left join best using (r) left join told using (r) left join held using (r)
"""


TOKENIZERS = "/opt/tokenizers"


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256))
    aligned = alignment.align_tokens(
        table(spark, sf_dir, "documents"),
        f"{TOKENIZERS}/byte_bpe_50k.json",
        f"{TOKENIZERS}/piece_bpe_32k.model",
        keep=digest,
    )
    return aligned.withColumnRenamed("groups", "groups_sha256")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


CHECKS = {
    "op1_decontamination": (op1_decontamination, OP1_SQL),
    "op2_mix_sources": (op2_mix_sources, None),
    "op3_substring_dedup": (op3_substring_dedup, None),
    "op4_html_extraction": (op4_html_extraction, None),
    "op5_quality_rules": (op5_quality_rules, OP5_SQL),
    "op6_jaccard_join": (op6_jaccard_join, OP6_SQL),
    "op7_toxicity": (op7_toxicity, None),
    "op8_url_filters": (op8_url_filters, OP8_SQL),
    "op9_chat_formatting": (op9_chat_formatting, OP9_SQL),
    "op10_quality_classifier": (op10_quality_classifier, None),
    "op11_periodic_runs": (op11_periodic_runs, OP11_SQL),
    "op12_token_alignment": (op12_token_alignment, None),
    "op13_sharding": (op13_sharding, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
