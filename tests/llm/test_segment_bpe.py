"""Ids of the segment tree against the tiktoken library, and round trips."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from discolake.llm import segment_bpe
from discolake.llm.batches import word_pieces

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SIGNS = " \t\n\r\x0b\x0c\x1c\x85\xa0 　aAbBeéß'stdllre0123!.,-_日本語😀İ"
LONG = ["x" * 5000, "ab" * 20_000, "=!" * 3000, " " * 3000 + "a", "no space " * 30_000]


@pytest.fixture(scope="module")
def library():
    ranks = segment_bpe.read_ranks(PATH)
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_odd_texts_equal_the_library(library):
    draw = random.Random(5)
    texts = ["".join(draw.choices(SIGNS, k=draw.randint(0, 60))) for _ in range(4000)] + ["", *LONG]
    ids, stops = segment_bpe.loaded(PATH, public_tokenizers.PATTERN).encode(pa.array(texts))
    for text, a, b in zip(texts, stops[:-1], stops[1:], strict=True):
        assert ids[a:b].tolist() == library.encode_ordinary(text), repr(text[:80])


def test_one_tree_and_many_trees_agree():
    bpe = segment_bpe.loaded(PATH, public_tokenizers.PATTERN)
    draw = random.Random(6)
    words = ["".join(draw.choices("aàeinrst-日", k=draw.randint(2, 20))).encode()[:64] for _ in range(2000)]
    assert bpe.merge_together(words, 64) == [bpe.merge_alone(w) for w in words]


def test_another_pattern_takes_texts_whole(library):
    pattern = r"[^,]+,?|,+"
    other = tiktoken.Encoding("p", pat_str=pattern, mergeable_ranks=segment_bpe.read_ranks(PATH), special_tokens={})
    texts = ["one two, three", "a b  c,,,", ""]
    ids, stops = segment_bpe.SegmentBpe(PATH, pattern).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(stops, stops[1:])] == [other.encode_ordinary(t) for t in texts]


def test_pieces_are_the_texts():
    draw = random.Random(7)
    texts = ["".join(draw.choices(SIGNS, k=draw.randint(0, 30))) for _ in range(500)]
    for some in (pa.array(texts), pa.array(["skipped", *texts]).slice(1), pa.array([], pa.string()), pa.array(["", ""])):
        pieces, ends = word_pieces(some)
        pieces = pieces.to_pylist()
        assert ["".join(pieces[a:b]) for a, b in zip(ends, ends[1:])] == some.to_pylist()


def test_rows_of_any_kind_come_back(spark, library):
    rows = [(1, "It's 12 o'clock"), (1, "It's 12 o'clock"), (2, None), (None, ""), (3, LONG[1]), (4, "日本　 x")]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("ids", "n_tokens", "decoded_sha256"):
        given = given.withColumn(name, F.lit("extra"))
    tokens = segment_bpe.encode(given, PATH)
    found = sorted(map(tuple, tokens.collect()), key=str)
    ids = [(i, library.encode_ordinary(t or ""), t or "") for i, t in rows]
    want = [(i, len(x), x, hashlib.sha256(t.encode()).hexdigest()) for i, x, t in ids]
    assert found == sorted(want, key=str)
    back = segment_bpe.decode(tokens, PATH)
    assert sorted(map(tuple, back.collect()), key=str) == sorted([(i, t or "") for i, t in rows], key=str)
    assert segment_bpe.encode(given.limit(0), PATH, digests=True).collect() == []


def test_decode_refuses_ids_outside_the_ranks(spark):
    bad = spark.createDataFrame([(1, [70_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="ids outside the ranks"):
        segment_bpe.decode(bad, PATH).collect()
