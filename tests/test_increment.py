import json

import pytest
from pyspark.sql import functions as F

from discolake import __main__ as cli
from discolake import schemas
from discolake.plans import increment
from discolake.sources.documents import read_stored
from discolake.sources.manifests import read_keys
from tests.conftest import rows

CHILD = "id string, name string, parent_id string, release_date string"


@pytest.fixture
def parents(spark):
    return spark.createDataFrame(
        [("a", 1, "2020", None), ("b", 2, None, None), ("c", 3, "1999", "failed"),
         ("d", 4, "2001", "rate_limited"), ("e", 5, "2002", None), ("a", 9, "again", None)],
        "id string, ord int, release_date string, outcome string",
    )


@pytest.fixture
def candidates(spark):
    return spark.createDataFrame(
        [
            ("a", 1, ("x", "X")), ("a", 2, None), ("a", 3, ("y", "Y")), ("a", 4, ("z", "Z")),
            ("b", 1, ("y", "Y of b")), ("b", 2, ("w", None)), ("b", 3, ("s", "stored")),
            ("q", 1, ("u", "not a parent")),
        ],
        "parent_id string, ord2 int, item struct<id: string, name: string>",
    )


def run(spark, parents, candidates, stored=(), keys=(), **options):
    return increment.load(
        parents,
        candidates,
        spark.createDataFrame(list(stored), CHILD),
        spark.createDataFrame(list(keys), schemas.KEYS),
        **{"parent_order": ["ord"], "child_order": ["ord2"], "per_parent": 3, "inherited": ["release_date"], **options},
    )


def test_first_n_rejects_dedup_and_inheritance(spark, parents, candidates):
    got = run(spark, parents, candidates, stored=[("s", "stored", None, None)])
    # z is fourth; the null item counts among the first three; y is a's.
    assert rows(got.new, "id", "name", "parent_id", "release_date") == [
        ("x", "X", "a", "2020"),
        ("y", "Y", "a", "2020"),
    ]


def test_outcomes(spark, parents, candidates):
    got = run(spark, parents, candidates)
    assert rows(got.outcomes) == [
        ("a", "done", 3), ("b", "done", 3), ("c", "failed", 0), ("d", "retry", 0), ("e", "empty", 0),
    ]
    settled = run(spark, parents, candidates, retry_limited=False)
    assert ("d", "failed", 0) in rows(settled.outcomes)


def test_only_settled_keys_are_skipped(spark, parents, candidates):
    keys = [("a", "retry"), ("a", "done"), ("b", "retry"), ("c", "failed"), ("e", "empty"), ("zzz", "done")]
    got = run(spark, parents, candidates, keys=keys)
    assert rows(got.outcomes, "id") == [("b",), ("d",)]
    assert rows(got.new, "id") == [("s",), ("y",)]


def test_manifest_row(spark, parents, candidates):
    got = run(spark, parents, candidates, keys=[("e", "empty")])
    row = increment.run_manifest(parents, got.outcomes, got.new).first()
    assert (row.total_children, row.total_processed, row.total_skipped) == (3, 3, 1)
    assert row.status == "completed" and len(row.last_update) == len("yyyy-MM-dd HH:mm:ss")


def test_manifest_of_an_empty_run(spark, parents, candidates):
    none = parents.where("false")
    got = run(spark, none, candidates)
    row = increment.run_manifest(none, got.outcomes, got.new).first()
    assert (row.total_children, row.total_processed, row.total_skipped) == (0, 0, 0)


def test_commit_and_rerun(spark, tmp_path, parents, candidates):
    children, keys = str(tmp_path / "children"), str(tmp_path / "keys")

    def once():
        stored = read_stored(spark, children, CHILD, "parquet")
        got = increment.load(
            parents, candidates, stored, read_keys(spark, keys),
            parent_order=["ord"], child_order=["ord2"], per_parent=3, inherited=["release_date"],
        )
        return increment.commit(got, children, keys)

    once()
    first = rows(spark.read.parquet(children))
    once()
    assert rows(spark.read.parquet(children)) == first
    assert rows(increment.processed_keys(read_keys(spark, keys))) == [("a",), ("b",), ("c",), ("e",)]


def test_a_crash_between_data_and_keys_adds_nothing_twice(spark, tmp_path, parents, candidates):
    children, keys = str(tmp_path / "children"), str(tmp_path / "keys")
    got = run(spark, parents, candidates)
    got.new.write.mode("append").parquet(children)  # the keys are never written
    again = increment.load(
        parents, candidates, read_stored(spark, children, CHILD, "parquet"), read_keys(spark, keys),
        parent_order=["ord"], child_order=["ord2"], per_parent=3, inherited=["release_date"],
    )
    assert again.new.count() == 0
    increment.commit(again, children, keys)
    assert spark.read.parquet(children).groupBy("id").count().where("count > 1").count() == 0
    assert read_keys(spark, keys).where(F.col("id") == "a").count() == 1


def found(frame, schema, *rows_):
    """What a fetch brought: parent, position and raw document."""
    return frame(
        f"parent_id string, ord int, item struct<{schema}>",
        [{"parent_id": parent, "ord": ord, "item": item} for parent, ord, item in rows_],
    )


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_load_albums_samples_pending_artists(spark, frame, tmp_path):
    artists = spark.range(40).selectExpr("cast(id as string) as id", "id as ord")
    items = found(
        frame, schemas.ALBUM,
        *[(str(a), i, {"id": f"{a}-{i}", "name": None, "genres": None}) for a in range(40) for i in range(7)],
    )
    children, keys = str(tmp_path / "albums"), str(tmp_path / "keys")
    loaded = set()
    for _ in range(4):
        run = increment.load_albums(
            artists, items, read_stored(spark, children, schemas.ALBUM, "parquet"), read_keys(spark, keys),
            per_parent=5, sample=10,
        )
        outcomes = increment.commit(run, children, keys)
        drawn = {r.id for r in outcomes.collect()}
        assert len(drawn) == 10 and not drawn & loaded
        loaded |= drawn
    albums = spark.read.parquet(children)
    assert albums.count() == 200 and set(albums.columns) == set(empty(spark, schemas.ALBUM).columns)
    assert albums.first()["genres"] == []


def test_nothing_is_cut_unless_asked(spark, frame):
    artists = spark.range(4).selectExpr("cast(id as string) as id", "id as ord")
    items = found(frame, schemas.ALBUM, *[(str(a), i, {"id": f"{a}-{i}"}) for a in range(4) for i in range(30)])
    run = increment.load_albums(
        artists, items, empty(spark, schemas.ALBUM), empty(spark, schemas.KEYS), per_parent=None, sample=None
    )
    assert run.new.count() == 120 and {r.children for r in run.outcomes.collect()} == {30}


def test_loads_from_the_command_line(spark, tmp_path, write_json, capsys):
    artists = write_json("artists.json", [{"id": "x"}, {"id": "y", "outcome": "rate_limited"}, {"id": "z"}])
    lines = [{"parent_id": "x", "ord": i, "item": {"id": f"a{i}", "release_date": "2020"}} for i in range(3)]
    (tmp_path / "found.json").write_text("\n".join(json.dumps(line) for line in lines))
    paths = {name: str(tmp_path / name) for name in ("children", "keys", "summary")}
    step = ["load-albums", "--parents", artists, "--found", str(tmp_path / "found.json")]
    step += [word for name, path in paths.items() for word in (f"--{name}", path)]
    cli.main([*step, "--per-parent", "2"])
    assert rows(spark.read.parquet(paths["children"]), "id") == [("a0",), ("a1",)]
    assert rows(read_keys(spark, paths["keys"])) == [("x", "done"), ("y", "retry"), ("z", "empty")]
    summary = spark.read.json(paths["summary"]).first()
    assert (summary.total_children, summary.total_processed, summary.total_skipped) == (2, 2, 0)
    cli.main([*step, "--per-parent", "2"])
    summary = spark.read.json(paths["summary"]).first()
    assert (summary.total_children, summary.total_processed, summary.total_skipped) == (2, 0, 2)
    assert "total_children" in capsys.readouterr().out


def test_load_tracks_inherits_the_release_date(spark, frame):
    albums = spark.createDataFrame([("a", 1, "2020"), ("b", 2, None)], "id string, ord int, release_date string")
    items = found(
        frame, schemas.TRACK,
        *[("a", i, {"id": f"t{i}", "release_date": "from the item"}) for i in range(12)],
        ("b", 0, {"id": "u", "album": {"id": "b"}}), ("b", 1, None), ("b", 2, {"id": None}),
    )
    run = increment.load_tracks(
        albums, items, empty(spark, schemas.TRACK), empty(spark, schemas.KEYS), per_parent=10
    )
    want = [(f"t{i}", "2020") for i in range(10)] + [("u", None)]
    assert rows(run.new, "id", "release_date") == want


def test_load_playlists_follows_the_album_keys(spark, frame):
    artists = spark.createDataFrame(
        [("x", 1, None), ("y", 2, "rate_limited"), ("z", 3, None)], "id string, ord int, outcome string"
    )
    album_keys = spark.createDataFrame([("x", "done"), ("y", "empty"), ("z", "retry")], schemas.KEYS)
    items = found(
        frame, schemas.PLAYLIST,
        ("x", 1, {"id": "p", "name": "P", "owner": {"id": "o"}}), ("x", 2, {"id": "q"}),
        ("z", 1, {"id": "r", "name": "R"}),
    )
    run = increment.load_playlists(
        artists, album_keys, items, empty(spark, schemas.PLAYLIST), empty(spark, schemas.KEYS), per_parent=10
    )
    assert rows(run.new, "id", "owner.id") == [("p", "o")]
    assert rows(run.outcomes, "id", "status") == [("x", "done"), ("y", "failed")]


def damaged_load(spark, tmp_path, write_json, *lines, **options):
    """One load of albums of four artists from the given lines."""
    artists = write_json("artists.json", [{"id": x} for x in ("a", "b", "c", 'd"d')])
    (tmp_path / "found.json").write_text("\n".join(lines) + "\n")
    paths = [str(tmp_path / name) for name in ("children", "keys")]
    row = increment.run(spark, "albums", artists, str(tmp_path / "found.json"), *paths, **options).first()
    children = read_stored(spark, paths[0], schemas.ALBUM, "parquet")
    return row, rows(children, "id"), rows(read_keys(spark, paths[1]))


def line(parent, id):
    return json.dumps({"parent_id": parent, "ord": 1, "item": {"id": id}})


def test_a_damaged_candidate_never_settles_its_parent(spark, tmp_path, write_json):
    cut, odd = line("b", "2")[:-9], line('d"d', "4").replace('"4"', '"4", "popularity": "high"')
    row, children, keys = damaged_load(spark, tmp_path, write_json, line("a", "1"), cut, odd)
    assert (row.total_rejected, row.total_processed, row.total_skipped) == (2, 2, 0)
    assert children == [("1",)]
    assert keys == [("a", "done"), ("b", "retry"), ("c", "empty"), ('d"d', "retry")]
    rejects = spark.read.parquet(str(tmp_path / "keys_rejects"))
    assert rows(rejects, "parent_id", "line") == [("b", cut), ('d"d', odd)]
    row, children, keys = damaged_load(spark, tmp_path, write_json, line("a", "1"), line("b", "2"), line('d"d', "4"))
    assert (row.total_rejected, row.total_processed, row.total_skipped) == (0, 2, 2)
    assert children == [("1",), ("2",), ("4",)]
    assert {k for k, status in keys if status != "retry"} == {"a", "b", "c", 'd"d'}
    assert spark.read.parquet(str(tmp_path / "keys_rejects")).count() == 0


def test_a_damaged_line_without_a_parent_holds_all_back(spark, tmp_path, write_json):
    lines = line("a", "1"), '{"par', '{"ord": 1, "item": {"id": "2"}}'
    row, children, keys = damaged_load(spark, tmp_path, write_json, *lines)
    assert row.total_rejected == 2 and children == [("1",)]
    assert {status for _, status in keys} == {"retry"}
    _, children, _ = damaged_load(spark, tmp_path, write_json, line("a", "1"), line("c", "2"))
    assert children == [("1",), ("2",)]


def test_more_damage_than_tolerated_stores_nothing(spark, tmp_path, write_json):
    with pytest.raises(increment.DamagedCandidates, match="2 damaged candidates, 1 tolerated"):
        damaged_load(spark, tmp_path, write_json, line("a", "1"), "x", "y", tolerance=1)
    assert not (tmp_path / "children").exists() and not (tmp_path / "keys").exists()


def test_a_sample_does_not_skip_what_is_pending(spark, tmp_path, write_json):
    row, _, keys = damaged_load(spark, tmp_path, write_json, line("a", "1"), sample=3)
    assert len(keys) == 3 and (row.total_processed, row.total_skipped) == (3, 0)
    row, _, keys = damaged_load(spark, tmp_path, write_json, line("a", "1"), sample=3)
    assert len(keys) == 4 and (row.total_processed, row.total_skipped) == (1, 3)


def test_bucketed_tables_hold_the_same(spark, tmp_path, write_json):
    artists = write_json("artists.json", [{"id": str(i)} for i in range(30)])
    first = [line(str(i % 25), f"c{i}") for i in range(60)]
    second = [*first, *(line(str(25 + i % 5), f"c{i % 90}") for i in range(40, 120))]
    tables = {}
    for buckets in (None, 4):
        paths = [str(tmp_path / f"{name}-{buckets}") for name in ("children", "keys")]
        for lines in (first, second, second):
            (tmp_path / "found.json").write_text("\n".join([*lines, '{"parent_id": "29", "cut'][: len(lines) + (lines is first)]))
            row = increment.run(spark, "albums", artists, str(tmp_path / "found.json"), *paths, buckets=buckets).first()
        children = spark.read.schema(schemas.ALBUM).parquet(paths[0])
        tables[buckets] = (rows(children, "id"), rows(read_keys(spark, paths[1])), row.total_children, row.total_skipped)
    assert tables[4] == tables[None] and len(tables[4][0]) == 66
