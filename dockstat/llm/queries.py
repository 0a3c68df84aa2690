"""Registered queries of the training-data operators, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockstat.llm import (ann, chat, chunkdedup, decontam, langid, linededup, minhash, packing, pagetext,
                          partcodes, tokenstore, toxicity, whitening)
from dockstat.llm.common import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op2_template_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.recurring_lines(table(spark, sf_dir, "documents"))


def op3_cnn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                    langid.split_rest("doc_id", 5) == 0)


def op4_multiprobe_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op5_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), langid.split_rest("doc_id", 4) == 2)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_chunk_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunkdedup.repeated_passages(table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenstore.token_store(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("select * from values (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), "
                      "(-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') as t(conv_id, turn, role, text)")
    return chat.conversation_digests(chat.format_conversations(turns.unionByName(probe)))


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagetext.extract(table(spark, sf_dir, "pages"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partcodes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_template_line_dedup": op2_template_line_dedup,
    "op3_cnn_toxicity": op3_cnn_toxicity,
    "op4_multiprobe_ann": op4_multiprobe_ann,
    "op5_simhash_decontamination": op5_simhash_decontamination,
    "op6_cross_parsing_language": op6_cross_parsing_language,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_chunk_substring_dedup": op8_chunk_substring_dedup,
    "op9_token_files": op9_token_files,
    "op10_chat_format": op10_chat_format,
    "op11_page_text": op11_page_text,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_vector_codes": op13_vector_codes,
}

ORACLE: dict[str, str] = {
    # every pair of documents that share a shingle, counted exactly, then reachability
    "op1_minhash_near_dedup": r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, case when len(w) < 4 then array_to_string(w, ' ')
    else array_to_string(w[i : i + 3], ' ') end as s
  from words, unnest(range(1, greatest(len(w) - 2, 2))) t(i) where len(w) > 0),
sized as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as x, b.doc_id as y, count(*) as common
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select x, y from pairs join sized p on p.doc_id = x join sized q on q.doc_id = y
  where 100 * common >= 80 * (p.n + q.n - common)),
reach(x, y) as (
  select doc_id, doc_id from words
  union
  select r.x, l.y from reach r join links l on l.x = r.y)
select d.doc_id, coalesce(any_value(s.n), 0) as n_shingles, min(r.y) as component_id,
  d.doc_id = min(r.y) as kept
from words d join reach r on r.x = d.doc_id left join sized s on s.doc_id = d.doc_id
group by d.doc_id""",
    # lengths of the marks: <s>[SYS] .. [/SYS]</s> 9+11, [INST] 10+12, [ANS] 9+11, other roles 10+8+12
    "op10_chat_format": r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, i, r, '</s>[INST] ok [/INST]' from (values (0, 'user'), (1, 'assistant')) v(i, r)),
sized as (
  select *, length(text) + length(text) - length(replace(text, '\', ''))
    + len(regexp_extract_all(text, '</?s>|\[/?(?:SYS|INST|ANS|ROLE)\]|\[TEXT\]'))
    + case role when 'user' then 22 when 'system' then 20 when 'assistant' then 20
        else 30 + length(role) + length(role) - length(replace(role, '\', ''))
          + len(regexp_extract_all(role, '</?s>|\[/?(?:SYS|INST|ANS|ROLE)\]|\[TEXT\]')) end as chars
  from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars,
  regexp_full_match(string_agg(role || ',', '' order by turn, role, text),
    '(system,)?user,assistant,(user,assistant,)*') as valid
from sized group by conv_id""",
    # every part against every entry; integer arithmetic throughout, // truncates, hence the remainders
    "op13_vector_codes": r"""
with kept as (
  select vec_id, label, row_number() over (order by vec_id nulls last, embedding) as r,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(embedding) > 0),
part as (
  select r, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] as x from kept, range(16) t(p)),
b0 as (select p, r - 1 as e, x as c from part where r <= 64),
a0 as (
  select r, p, any_value(x) as x,
    min({'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}) as m
  from part join b0 using (p) group by r, p),
s1 as (select p, m.e as e, j, sum(x[j]) as s, count(*) as n from a0, unnest(range(1, len(x) + 1)) t(j) group by all),
c1 as (
  select p, e, list(cast((s - ((s % n) + n) % n) // n as bigint) order by j) as c from s1 group by p, e),
b1 as (select p, e, coalesce(c1.c, b0.c) as c from b0 left join c1 using (p, e)),
a1 as (
  select r, p, any_value(x) as x,
    min({'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}) as m
  from part join b1 using (p) group by r, p),
s2 as (select p, m.e as e, j, sum(x[j]) as s, count(*) as n from a1, unnest(range(1, len(x) + 1)) t(j) group by all),
c2 as (
  select p, e, list(cast((s - ((s % n) + n) % n) // n as bigint) order by j) as c from s2 group by p, e),
b2 as (select p, e, coalesce(c2.c, b1.c) as c from b1 left join c2 using (p, e)),
a2 as (
  select r, p,
    min({'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': e}) as m
  from part join b2 using (p) group by r, p),
coded as (
  select r, string_agg(lpad(lower(to_hex(m.e)), 2, '0'), '' order by p) as code, cast(sum(m.d) as bigint) as error
  from a2 group by r),
book as (
  select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) as codebooks_sha256 from b2)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from kept join coded using (r), book""",
}
