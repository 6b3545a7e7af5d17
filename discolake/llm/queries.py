"""The queries of this subpackage and the SQL that checks them, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from discolake.llm import (
    bpe,
    byte_cnn,
    cross_polytope,
    html_layout,
    mixing,
    ngram_join,
    phrases,
    pii,
    quality_rules,
    segment_bpe,
    spelling,
    token_frames,
)
from discolake.llm.content_sort import mark_copies
from discolake.llm.tables import documents, held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = token_frames.write_token_files(documents(spark, sf_dir), path, end_id=2)
    return token_frames.read_token_files(manifest, digests=True)


QUERIES["op5_token_files"] = op5_token_files


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encode(documents(spark, sf_dir), path, digests=True)


QUERIES["op9_bpe"] = op9_bpe


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_copies(documents(spark, sf_dir), keep="largest")


QUERIES["op7_exact_dedup"] = op7_exact_dedup
ORACLES["op7_exact_dedup"] = """
select doc_id, max(doc_id) over copies as keep_id, count(*) over copies as group_size,
       doc_id = max(doc_id) over copies as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window copies as (partition by coalesce(text, ''))
"""


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir))


QUERIES["op8_mix_sources"] = op8_mix_sources


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.classify(documents(spark, sf_dir), labels)


QUERIES["op4_quality"] = op4_quality


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = byte_cnn.identify(docs, byte_cnn.learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES["op6_language"] = op6_language


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES["op3_html_text"] = op3_html_text


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES["op10_near_vectors"] = op10_near_vectors


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.similar_documents(documents(spark, sf_dir), words=3, percent=90)
    return found.select("doc_id", F.col("n_grams").alias("n_shingles"), "component_id")


QUERIES["op1_ngram_join"] = op1_ngram_join


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


QUERIES["op2_personal_data"] = op2_personal_data


def op12_segment_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return segment_bpe.encode(documents(spark, sf_dir), path, digests=True)


QUERIES["op12_segment_bpe"] = op12_segment_bpe


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))


QUERIES["op11_spelling"] = op11_spelling
ORACLES["op11_spelling"] = r"""
with recursive crc_table as materialized (
  select list(list_reduce([i::ubigint, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda x, y: case when x % 2 = 1 then xor(3988292384::ubigint, x // 2) else x // 2 end) order by i) as t
  from range(256) r(i)
), runs as (
  select coalesce(doc_id::varchar, '') as id,
         translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents
), counted as (
  select id, run, count(*) as times, hex(encode(id || ':' || run)) as digits
  from runs where length(run) >= 7 group by all
), hashed as (
  select run, times,
         xor(4294967295::ubigint, list_reduce(
           list_prepend(4294967295::ubigint,
             list_transform(range(length(digits) // 2),
               lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::ubigint)),
           lambda x, y: xor(t[(xor(x, y) & 255)::integer + 1], x >> 8))) as h
  from counted, crc_table
), vocabulary as materialized (
  select word, sum(times)::bigint as n
  from (select times, case when h % 31 = 0
                           then substr(run, 1, (h % length(run))::integer)
                                || substr(run, (h % length(run))::integer + 2)
                           else run end as word from hashed)
  where length(word) >= 7 group by word having sum(times) >= 2
), holes as materialized (
  select word, n, i, substr(word, 1, i::integer) as a, substr(word, i::integer + 2) as b
  from (select word, n, unnest(range(length(word))) as i from vocabulary)
), near as materialized (
  select x.word, y.word as other, y.n
  from holes x join holes y on x.i = y.i and x.a = y.a and x.b = y.b and x.word <> y.word
  union
  select h.word, v.word, v.n from holes h join vocabulary v on v.word = h.a || h.b
  union
  select v.word, h.word, h.n from holes h join vocabulary v on v.word = h.a || h.b
), best as (
  select word, count(*) as n_near, first(other order by n desc, other) as form, max(n) as form_n
  from near group by word
), forms as materialized (
  select v.word, v.n, coalesce(n_near, 0) as n_near,
         case when form_n >= 10 * v.n then form end as form,
         case when form_n >= 10 * v.n then form_n end as form_n
  from vocabulary v left join best using (word)
), ways as (
  select word, form as root from forms where form is not null
  union all
  select w.word, f.form from ways w join forms f on f.word = w.root where f.form is not null
), last as (
  select w.word, w.root from ways w join forms f on f.word = w.root where f.form is null
)
select f.word, f.form, coalesce(l.root, f.word) as root, f.n, f.n_near, f.form_n
from forms f left join last l using (word)
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir), first=2000, least=30)


QUERIES["op13_collocations"] = op13_collocations
ORACLES["op13_collocations"] = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) as piece
  from documents where text is not null
), lists as (
  select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as w from pieces
), grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))
         as phrase
  from lists, range(1, 5) lengths(k)
), totals as (
  select lang, count(*) as n from grams where k = 1 group by lang
), counts as materialized (
  select lang, k, phrase, count(*) as f from grams group by all having count(*) >= 30
), several as materialized (
  select lang, k, phrase, f as a, string_split(phrase, ' ') as w from counts where k > 1
), cuts as (
  select lang, k, phrase, a, w, unnest(range(1, k)) as cut from several
), scores as (
  select c.lang, c.phrase, c.a, c.cut, x.f as l, y.f as r,
         (2000000::hugeint * c.a) // (x.f::hugeint + y.f) as score
  from cuts c
  join counts x on x.lang = c.lang and x.phrase = array_to_string(w[1:cut], ' ')
  join counts y on y.lang = c.lang and y.phrase = array_to_string(w[cut + 1:c.k], ' ')
), weakest as (
  select * from scores qualify row_number() over (partition by lang, phrase order by score, cut) = 1
), inner_phrases as (
  select lang, max(a) as outer_a, phrase from (
    select s.lang, s.a, unnest(list_transform(range(1, s.k - m + 2), lambda i: array_to_string(s.w[i:i + m - 1], ' ')))
           as phrase
    from several s, range(2, 4) inner_lengths(m) where m < s.k)
  group by lang, phrase
), kept as (
  select w.* from weakest w left join inner_phrases i using (lang, phrase)
  where i.outer_a is null or 100 * i.outer_a::hugeint < 80 * w.a::hugeint
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join totals using (lang) where rank <= 2000
"""
