"""Every operator has its query, and the pipeline's stages do what they say."""

import hashlib
import os
import re
import zlib

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from discolake.llm import content_sort, mixing, ngram_join, segment_bpe
from discolake.llm.queries import ORACLES, QUERIES
from discolake.llm.tables import written

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.exists(SF_DIR), reason="no test tables here")
COLUMNS = {
    1: "doc_id n_shingles component_id",
    2: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    3: "page_id text",
    4: "doc_id held_out score predicted",
    5: "doc_id start n_tokens ids_crc32",
    6: "doc_id held_out lang_pred score",
    7: "doc_id keep_id group_size kept text_sha256",
    8: "doc_id size source_size target taken",
    9: "doc_id n_tokens ids_sha256 decoded_sha256",
    10: "vec_id n_links component_id kept",
    11: "word form root n n_near form_n",
    12: "doc_id n_tokens ids_sha256 decoded_sha256",
    13: "lang rank phrase a l r n score",
}
#: Operators whose rows are not those of a table.
OWN_ROWS = {11, 13}


def test_each_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == sorted(COLUMNS)
    assert set(ORACLES) <= set(QUERIES)


@needs_tables
@pytest.mark.parametrize("name", sorted(name for name in QUERIES if int(re.match(r"op(\d+)_", name)[1]) not in OWN_ROWS))
def test_a_query_returns_a_row_for_each_row_of_its_table(spark, name):
    number = int(re.match(r"op(\d+)_", name)[1])
    found = QUERIES[name](spark, SF_DIR)
    want = COLUMNS[number].split()
    assert found.columns[: len(want)] == want
    table = {3: "pages", 10: "embeddings"}.get(number, "documents")
    key = want[0]
    given = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    found = found.select(key).collect()
    assert sorted(r[0] for r in found) == sorted(r[0] for r in given.select(key).collect())


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_a_query_agrees_with_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(map(tuple, QUERIES[name](spark, SF_DIR).select(names).collect())) == sorted(cursor.fetchall())


@needs_tables
def test_token_files_and_bpe_equal_the_library(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    files = {r.doc_id: r for r in QUERIES["op5_token_files"](spark, SF_DIR).collect()}
    start = 0
    for doc_id in sorted(texts):
        ids = [*words.encode(texts[doc_id], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        assert tuple(files[doc_id]) == (doc_id, start, len(ids), crc)
        start += len(ids)
    pieces = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for row in QUERIES["op9_bpe"](spark, SF_DIR).collect():
        ids = pieces.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()


@needs_tables
def test_segment_bpe_equals_the_library(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=segment_bpe.read_ranks(path), special_tokens={}
    )
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for row in QUERIES["op12_segment_bpe"](spark, SF_DIR).collect():
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


@needs_tables
def test_stages_keep_columns_and_their_decisions_hold(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen, (_, quality), (_, exact), (_, near), (_, mix), (_, encode) = docs, *corpus_pipeline.STAGES
    good = quality(spark, seen, SF_DIR).cache()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    graded = docs.select("doc_id").join(labels, "doc_id")
    kept = {r.doc_id for r in good.collect()}
    right = sum((r.doc_id in kept) == (r.quality == 1) for r in graded.collect())
    assert right >= 0.95 * graded.count()
    single = exact(spark, good, SF_DIR).cache()
    assert single.count() == good.select("text").distinct().count()
    apart = near(spark, single, SF_DIR).cache()
    groups = ngram_join.similar_documents(single, 5, 80)
    assert apart.count() == groups.select("component_id").distinct().count()
    again = ngram_join.similar_documents(apart, 5, 80)
    assert again.filter(F.col("component_id") != F.col("doc_id")).count() == 0
    mixed = mix(spark, apart, SF_DIR).cache()
    assert mixed.columns == docs.columns == apart.columns == single.columns == good.columns
    taken = mixing.taken_words(apart).agg(F.sum("taken")).first()[0]
    assert mixed.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORDS)))).first()[0] == taken
    assert content_sort.mark_copies(apart).filter("NOT kept").count() == 0
    tokens = encode(spark, mixed, SF_DIR)
    assert tokens.count() == mixed.count()
    texts = sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in mixed.collect())
    assert sorted(r.decoded_sha256 for r in tokens.collect()) == texts


@needs_tables
def test_run_applies_all_stages(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100


@needs_tables
@pytest.mark.parametrize("rows", ["odd", "none"])
def test_the_chain_takes_odd_rows(spark, tmp_path, rows):
    """Nulls, empty and long texts, repeated rows and ids, columns with the names operators use."""
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    good = given.filter(F.length("text") > 400).limit(1)
    odd = [(None, None, None, None, None), (1, None, "en", None, 0), (1, "", "en", "src0", 0), (2, " \t\n", None, "src1", 3)]
    extra = spark.createDataFrame(odd, given.schema)
    long = good.withColumn("text", F.repeat(F.concat("text", F.lit(" ")), 300)).withColumn("doc_id", F.lit(10**9))
    docs = given.unionByName(extra).unionByName(extra).unionByName(good).unionByName(long)
    for name in ("__row", "rep", "gram", "shard", "number", "score", "kept"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs = docs if rows == "odd" else docs.limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    columns = docs.columns
    for number, (_, work) in enumerate(corpus_pipeline.STAGES):
        docs = spark.read.parquet(str(tmp_path / (f"stage-{number}" if number else "documents.parquet")))
        kept = work(spark, docs, str(tmp_path))
        kept.write.parquet(str(tmp_path / f"stage-{number + 1}"))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert kept.columns == columns
    tokens = spark.read.parquet(str(tmp_path / f"stage-{len(corpus_pipeline.STAGES)}"))
    mixed = spark.read.parquet(str(tmp_path / f"stage-{len(corpus_pipeline.STAGES) - 1}"))
    assert tokens.count() == mixed.count() and (tokens.count() > 0) == (rows == "odd")
    texts = sorted(hashlib.sha256(r.text.encode()).hexdigest() for r in mixed.collect())
    assert sorted(r.decoded_sha256 for r in tokens.collect()) == texts


@needs_tables
def test_a_stage_removes_the_working_tables_of_the_one_before(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    known = set(written(spark))
    corpus_pipeline.exact_dedup(spark, docs, SF_DIR).count()
    made = [path for path in written(spark) if path not in known]
    assert made and all(os.path.exists(path) for path in made)
    corpus_pipeline.quality(spark, docs, SF_DIR)
    assert not any(os.path.exists(path) for path in made) and known <= set(written(spark))
