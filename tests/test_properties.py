"""Properties that hold for any input."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from discolake import schemas
from discolake.functions.arrays import ids_to_csv
from discolake.operators import dedup, generators, joins, ranking
from discolake.plans import silver
from discolake.sources.documents import element_texts, read_documents
from tests.conftest import rows

few = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

KEY = st.sampled_from(["a", "b", "c", "", None])
PAIRS = st.lists(st.tuples(KEY, st.integers(0, 9)), max_size=30)
IDS = st.text(st.characters(exclude_characters=",", exclude_categories=["Cs"]), min_size=1, max_size=4)


def pairs(spark, data):
    return spark.createDataFrame(data, "id string, v int")


@few
@given(PAIRS)
def test_keep_first_gives_one_row_per_key_and_is_idempotent(spark, data):
    first = dedup.keep_first(pairs(spark, data), "id", ["v"])
    want = {}
    for key, value in sorted(data, key=lambda t: t[1]):
        want.setdefault(key, value)
    assert dict(rows(first)) == want
    assert rows(dedup.keep_first(first, "id", ["v"])) == rows(first)


@few
@given(PAIRS, st.lists(KEY, max_size=6))
def test_semi_and_anti_split_the_input(spark, data, keys):
    df = pairs(spark, data)
    key_df = spark.createDataFrame([(k,) for k in keys], "id string")
    kept, rest = joins.matching(df, key_df, "id"), joins.excluding(df, key_df, "id")
    assert rows(kept.unionByName(rest)) == rows(df)
    assert {k for k, _ in rows(kept)} <= {k for k in keys if k is not None}


@few
@given(PAIRS, PAIRS)
def test_append_new_adds_each_unknown_key_once(spark, stored, fresh):
    out = rows(dedup.append_new(pairs(spark, stored), pairs(spark, fresh), "id", ["v"]))
    known = {k for k, _ in stored}
    added = {k for k, _ in fresh if k is not None} - known
    assert len(out) == len(stored) + len(added)
    assert {k for k, _ in out} == known | added


@few
@given(st.integers(0, 40), st.integers(0, 50), st.integers(1, 6))
def test_sample_size(spark, size, n, parts):
    df = spark.range(0, size, numPartitions=parts)
    got = rows(ranking.seeded_sample(df, "id", n))
    assert len(got) == min(n, size) == len(set(got))


@few
@given(st.lists(st.lists(IDS, max_size=4), max_size=8))
def test_explode_and_csv_round_trip(spark, lists):
    df = spark.createDataFrame(
        [(i, [(x,) for x in ids]) for i, ids in enumerate(lists)], "n int, artists array<struct<id: string>>"
    )
    exploded = generators.explode_array(df, "artists", "a")
    assert exploded.count() == sum(map(len, lists))
    csv = df.select("n", ids_to_csv(F.col("artists")).alias("csv"))
    back = generators.split_explode(csv, "csv", "id").groupBy("n").agg(F.collect_list("id").alias("ids"))
    assert {r.n: r.ids for r in back.collect()} == {i: ids or [""] for i, ids in enumerate(lists)}


JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**53), 2**53) | st.text(st.characters(exclude_categories=["Cs"]), max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("ab }{],\n", max_size=3), inner, max_size=3),
    max_leaves=8,
)
DOCS = st.lists(
    st.builds(
        lambda id, name, extra: {"id": id, "display_name": name, "extra": extra},
        st.text("x},{\n[] ", min_size=1, max_size=6),
        st.none() | st.text(st.characters(exclude_categories=["Cs"]), max_size=12),
        JSON,
    ),
    max_size=8,
)


@few
@given(DOCS)
def test_cutting_an_indented_array_loses_nothing(spark, tmp_path_factory, docs):
    path = tmp_path_factory.mktemp("docs") / "docs.json"
    path.write_text(json.dumps(docs, ensure_ascii=False, indent=2))
    texts = [r.value for r in element_texts(spark, str(path), "indented").collect()]
    assert [json.loads(t) for t in texts] == docs
    got = rows(read_documents(spark, str(path), schemas.OWNER, "indented"))
    assert got == rows(read_documents(spark, str(path), schemas.OWNER, "array"))


@few
@given(st.lists(st.lists(st.sampled_from(["x", "y", None]), max_size=3), max_size=6))
def test_bridge_rows_are_the_non_null_links(spark, lists):
    docs = [json.dumps({"id": str(i), "album": {"id": "a"}, "artists": [{"id": x} for x in ids]})
            for i, ids in enumerate(lists)]
    text = spark.createDataFrame([(d,) for d in docs], "value string")
    tracks = text.select(F.from_json("value", schemas.TRACK).alias("d")).select("d.*")
    assert silver.track_artists(tracks).count() == sum(x is not None for ids in lists for x in ids)
