"""Incremental load of the children of not yet processed parents.

Parents are artists or albums, children are albums, tracks or playlists.  A
run takes the parents without a settled key, the first N children of each,
and keeps those whose id is not stored yet.  A parent is not settled while one of
its candidates could not be read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from discolake.operators.dedup import key_set, new_rows, union_pages
from discolake.operators.filters import usable_items
from discolake.operators.joins import matching
from discolake.operators.ranking import first_n_per_parent, seeded_sample
from discolake.operators.skew import thin
from discolake.plans.bronze import prune_albums, prune_playlists, prune_tracks
from discolake.schemas import ALBUM, ARTIST, DOCUMENTS, KEYS
from discolake.session import new_folder
from discolake.sinks.buckets import Bucketed
from discolake.sinks.exports import write_documents
from discolake.sinks.staging import discard
from discolake.sinks.tables import overwrite
from discolake.sources.documents import CORRUPT, read_documents, read_stored
from discolake.sources.manifests import RETRY, read_keys, settled

# The seed that a sample of parents is drawn with.
SAMPLE_SEED = 42


@dataclass(frozen=True)
class Load:
    """``new`` children, and the ``outcomes`` (id, status, children) of parents."""

    new: DataFrame
    outcomes: DataFrame


def pending(parents: DataFrame, keys: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per parent id that has no settled key."""
    return new_rows(parents, settled(keys), "id", order)


REJECTS = "line string, parent_id string"


class DamagedCandidates(ValueError):
    """More candidates could not be read than were tolerated."""

    def __init__(self, damaged: int, tolerance: int):
        self.damaged = damaged
        super().__init__(f"{damaged} damaged candidates, {tolerance} tolerated")


def read_candidates(spark: SparkSession, path: str, schema: str, staged: str) -> tuple[DataFrame, DataFrame]:
    """Candidates of one JSON line each, and the lines that are damaged.

    Damaged is what is not JSON, does not fit the schema, or names no parent.  The rejects
    have the ``line`` and its ``parent_id`` where that can still be read.  The lines are parsed
    once, into the new folder ``staged``, which both are read from.
    """
    fields = f"parent_id string, ord long, item struct<{schema}>, {CORRUPT} string"
    spark.read.schema(fields).option("columnNameOfCorruptRecord", CORRUPT).json(path).write.parquet(staged)
    lines = spark.read.schema(fields).parquet(staged)
    whole = F.col(CORRUPT).isNull() & F.col("parent_id").isNotNull()
    quoted = F.regexp_extract(CORRUPT, r'"parent_id"\s*:\s*("(?:[^"\\]|\\.)*")', 1)
    named = F.from_json(F.concat(F.lit("["), quoted, F.lit("]")), "array<string>")
    rejects = lines.where(~whole).select(
        F.coalesce(CORRUPT, F.to_json(F.struct("parent_id", "ord", "item"))).alias("line"),
        F.coalesce("parent_id", F.try_element_at(named, F.lit(1))).alias("parent_id"),
    )
    return lines.where(whole).drop(CORRUPT), rejects


def hold_back(outcomes: DataFrame, rejects: DataFrame) -> DataFrame:
    """The outcomes, where no parent is settled that may have lost a candidate.

    That is each parent that a damaged line names, and all if a line names none.
    """
    named = thin(rejects.withColumnRenamed("parent_id", "id"), "id").distinct().withColumn("_held", F.lit(True))
    nameless = rejects.agg(F.count_if(F.col("parent_id").isNull()).alias("rows")).scalar() > 0
    held = outcomes.join(named, "id", "left")
    status = F.when(F.col("_held").isNotNull() | nameless, RETRY).otherwise(F.col("status"))
    return held.withColumn("status", status).drop("_held")


def key_status(
    parents: DataFrame, children: DataFrame, per_parent: int | None, retry_limited: bool = True
) -> DataFrame:
    """The status each parent gets from this run, and its children among the first N.

    ``children`` has a ``parent_id`` and is only counted, so the first N need
    not be picked again; None counts all.  The optional parent column ``outcome`` tells
    ``failed`` and ``rate_limited`` fetches.  Failed and empty parents are
    settled like done ones.  Rate-limited parents are left for the next run,
    unless ``retry_limited`` is off.
    """
    counts = (
        children.where(F.col("parent_id").isNotNull())
        .groupBy(F.col("parent_id").alias("id"))
        .agg(F.count(F.lit(1)).alias("children"))
    )
    outcome = F.col("outcome") if "outcome" in parents.columns else F.lit(None).cast("string")
    fetched = parents.select("id", outcome.alias("outcome")).join(counts, "id", "left")
    children_found = F.coalesce("children", F.lit(0))
    if per_parent is not None:
        children_found = F.least(children_found, F.lit(per_parent))
    status = (
        F.when(F.col("outcome") == "rate_limited", RETRY if retry_limited else "failed")
        .when(F.col("outcome") == "failed", "failed")
        .when(children_found == 0, "empty")
        .otherwise("done")
    )
    return fetched.select("id", status.alias("status"), children_found.cast("long").alias("children"))


def load(
    parents: DataFrame,
    candidates: DataFrame,
    stored: DataFrame,
    keys: DataFrame,
    *,
    parent_order: Sequence[str],
    child_order: Sequence[str],
    per_parent: int | None,
    sample: int | None = None,
    inherited: Sequence[str] = (),
    required: Sequence[str] = ("id", "name"),
    retry_limited: bool = True,
    work: str | None = None,
) -> Load:
    """One incremental run.

    ``parents`` has an ``id``; ``candidates`` has ``parent_id`` and the struct
    ``item``; both have their order columns.  A ``sample`` is drawn from the
    parents that are pending, so later runs take up others; None takes all.
    Candidates of settled parents go before the first N of each parent are
    cut; with ``per_parent`` None all stay, and the join with the pending parents alone
    leaves those candidates out.  Null items and items without the
    required fields count towards N, then go.  ``inherited`` parent columns
    are copied onto the children.  With the new folder ``work`` the pending parents are worked
    out once and written there; it must stay until the children and outcomes are stored.
    """
    todo = pending(parents, keys, parent_order)
    if sample is not None:
        todo = seeded_sample(todo, "id", sample, SAMPLE_SEED)
    if work is not None:
        needed = {"id", "outcome", *parent_order, *inherited}
        todo = todo.select([name for name in todo.columns if name in needed])
        todo.write.parquet(work)
        todo = todo.sparkSession.read.schema(todo.schema).parquet(work)
    listed = candidates
    if per_parent is not None:
        listed = matching(candidates, todo.select(F.col("id").alias("parent_id")), "parent_id")
        listed = first_n_per_parent(listed, "parent_id", child_order, per_parent)
    parent_columns = [F.col("id").alias("parent_id")]
    parent_columns += [F.col(name).alias(f"_parent_{i}") for i, name in enumerate(parent_order)]
    parent_columns += [F.col(name).alias(f"_inherited_{name}") for name in inherited]
    offered = usable_items(listed, "item", required).join(todo.select(parent_columns), "parent_id")
    order = [f"_parent_{i}" for i in range(len(parent_order))]
    order += [f"_child_{i}" for i in range(len(child_order))]
    if inherited:
        offered = offered.withColumn("item", F.col("item").dropFields(*inherited))
    flat = offered.select(
        *[F.col(name) for name in order if name.startswith("_parent_")],
        *[F.col(name).alias(f"_child_{i}") for i, name in enumerate(child_order)],
        "parent_id",
        "item.*",
        *[F.col(f"_inherited_{name}").alias(name) for name in inherited],
    )
    fresh = new_rows(flat, stored, "id", order).drop(*order)
    return Load(new=fresh, outcomes=key_status(todo, candidates, per_parent, retry_limited))


def load_albums(
    artists: DataFrame, found: DataFrame, stored: DataFrame, keys: DataFrame, *,
    per_parent: int | None, sample: int | None, work: str | None = None,
) -> Load:
    """Albums of the artists, or of a sample of the pending ones.

    Here and below ``found`` is what a fetch brought: ``parent_id``, ``ord``
    and the raw document ``item``; parents have the order column ``ord``.
    None as ``per_parent`` or ``sample`` means all.
    """
    run = load(
        artists, found, stored, keys, parent_order=["ord"], child_order=["ord"],
        per_parent=per_parent, sample=sample, required=["id"], work=work,
    )
    return Load(prune_albums(run.new), run.outcomes)


def load_tracks(
    albums: DataFrame, found: DataFrame, stored: DataFrame, keys: DataFrame, *, per_parent: int | None,
    work: str | None = None,
) -> Load:
    """Tracks of all albums; each takes the release date of its album."""
    run = load(
        albums, found, stored, keys, parent_order=["ord"], child_order=["ord"],
        per_parent=per_parent, inherited=["release_date"], required=["id"], work=work,
    )
    return Load(prune_tracks(run.new), run.outcomes)


def load_playlists(
    artists: DataFrame, album_keys: DataFrame, found: DataFrame, stored: DataFrame, keys: DataFrame, *,
    per_parent: int | None, work: str | None = None,
) -> Load:
    """Playlists of the artists whose albums were processed.

    A rate-limited search is not tried again.
    """
    run = load(
        matching(artists, settled(album_keys), "id"), found, stored, keys,
        parent_order=["ord"], child_order=["ord"], per_parent=per_parent, retry_limited=False, work=work,
    )
    return Load(prune_playlists(run.new), run.outcomes)


def run_manifest(
    parents: DataFrame, outcomes: DataFrame, children: DataFrame, last_update=None, keys: DataFrame | None = None
) -> DataFrame:
    """One row about a run: totals, parents processed and skipped, status.

    ``outcomes`` are the key rows of the run and ``children`` all children
    stored after it, both read from the tables that ``commit`` wrote.  The
    processed keys themselves are rows of the key table, never a list in one
    place.  Skipped are the parents that were settled before; after a run over a sample
    ``keys``, the key table after the run, tells them from those still pending.  Without it all
    parents that are not among the outcomes count as skipped.
    """
    totals = union_pages(
        children.agg(F.count_distinct("id").alias("total_children")),
        outcomes.agg(
            F.count_if(F.col("status") != RETRY).alias("total_processed"),
            F.count(F.lit(1)).alias("_pending"),
        ),
        parents.agg(F.count_distinct("id").alias("_parents")),
    )
    skipped = F.col("_parents") - F.col("_pending")
    names = ["total_children", "total_processed", "_pending", "_parents"]
    if keys is not None:
        known = matching(parents.select("id"), settled(keys), "id")
        totals = union_pages(totals, known.agg(F.count_distinct("id").alias("_settled")))
        skipped = F.col("_settled") - F.col("total_processed")
        names.append("_settled")
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    return totals.agg(*[F.max(name).alias(name) for name in names]).select(
        "total_children",
        "total_processed",
        skipped.alias("total_skipped"),
        (stamp if last_update is None else last_update).alias("last_update"),
        F.lit("completed").alias("status"),
    )


def commit(run: Load, children_table: str | Bucketed, key_table: str | Bucketed) -> DataFrame:
    """Append the new children, then the keys of their parents; returns the run's key rows.

    The keys are worked out before the children are stored, and staged
    beside the key table, so that what is returned is read and not worked out
    again.  A crash in between leaves the parents pending; the next run finds
    their children stored and adds none twice.
    """
    spark = run.new.sparkSession
    staged = new_folder(spark, "outcomes")
    run.outcomes.select("id", "status").write.parquet(staged)
    outcomes = spark.read.schema(KEYS).parquet(staged)
    append_to(run.new, children_table)
    append_to(outcomes, key_table)
    return outcomes


def append_to(rows: DataFrame, table: str | Bucketed) -> None:
    if isinstance(table, Bucketed):
        table.append(rows)
    else:
        rows.write.mode("append").parquet(table)


def stored_rows(spark: SparkSession, table: str | Bucketed, schema: str) -> DataFrame:
    return table.read(spark) if isinstance(table, Bucketed) else read_stored(spark, table, schema, "parquet")


# What each domain's children are, and what its parents look like.
PARENTS = {"albums": f"{ARTIST}, outcome string", "tracks": f"{ALBUM}, outcome string", "playlists": f"{ARTIST}, outcome string"}


def run(
    spark: SparkSession, domain: str, parents: str, found: str, children: str, keys: str, *,
    per_parent: int | None = None, sample: int | None = None, album_keys: str | None = None,
    layout: str = "indented", summary: str | None = None, rejects: str | None = None, tolerance: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """One incremental load of ``albums``, ``tracks`` or ``playlists`` from paths; returns its summary.

    ``parents`` are documents of artists or albums, with an optional
    ``outcome``; ``found`` has one JSON line per candidate: ``parent_id``,
    ``ord`` and ``item``.  ``children`` and ``keys`` are the tables that grow.
    The summary is one row, also written as a JSON document.

    Damaged lines of ``found`` are written to ``rejects``, beside the key table by default, and
    their parents stay pending, so that a run over the repaired file loads what was lost.  More
    of them than ``tolerance`` raise before anything is stored; None tolerates any number.

    With ``buckets`` both tables are bucketed by id, from the first run on and with the same number in
    each: then a run moves its new rows only, however many are stored.
    """
    parent_docs = read_documents(spark, parents, PARENTS[domain], layout, ordered=True)
    schema = DOCUMENTS[domain]
    rejects = rejects or f"{keys.rstrip('/')}_rejects"
    # What the run reads several times: the parsed candidates and the pending parents.
    staged, todo = new_folder(spark, "candidates"), new_folder(spark, "pending")

    def check(rows: int) -> None:
        if tolerance is not None and rows > tolerance:
            raise DamagedCandidates(rows, tolerance)

    try:
        candidates, damaged = read_candidates(spark, found, schema, staged)
        rejected = overwrite(damaged, rejects, check)
        children_table = children if buckets is None else Bucketed(children, schema, "id", buckets)
        key_table = keys if buckets is None else Bucketed(keys, KEYS, "id", buckets)
        stored, known = stored_rows(spark, children_table, schema), stored_rows(spark, key_table, KEYS)
        if domain == "albums":
            done = load_albums(parent_docs, candidates, stored, known, per_parent=per_parent, sample=sample, work=todo)
        elif domain == "tracks":
            done = load_tracks(parent_docs, candidates, stored, known, per_parent=per_parent, work=todo)
        else:
            listed = read_keys(spark, album_keys)
            done = load_playlists(parent_docs, listed, candidates, stored, known, per_parent=per_parent, work=todo)
        if rejected:
            lost = spark.read.schema(REJECTS).parquet(rejects)
            done = Load(done.new, hold_back(done.outcomes, lost))
        outcomes = commit(done, children_table, key_table)
        after = stored_rows(spark, children_table, schema)
        row = run_manifest(parent_docs, outcomes, after, keys=stored_rows(spark, key_table, KEYS))
        row = row.withColumn("total_rejected", F.lit(rejected).cast("long"))
        if summary is not None:
            write_documents(row, summary)
        return row
    finally:
        for folder in (staged, todo):
            discard(spark, folder)


def processed_keys(keys: DataFrame) -> DataFrame:
    """The distinct settled ids of the key table."""
    return key_set(settled(keys), "id")
