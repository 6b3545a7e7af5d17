"""Running whole layers: every dataset is tried, failures raise at the end.

A dataset that is refused keeps the rows it had.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from discolake.plans import gold, silver
from discolake.schemas import DOCUMENTS
from discolake.sinks.tables import overwrite, overwrite_by_year, replace_date
from discolake.sources.documents import CORRUPT, read_domain
from discolake.sources.tables import read_date


@dataclass(frozen=True)
class Result:
    dataset: str
    rows: int | None
    error: str | None
    damaged: int | None = None
    rows_in: int | None = None
    columns: int | None = None


#: Columns of the table of run metrics: one row per dataset and run of a layer.
METRICS = (
    "layer string, ingest_date string, dataset string, rows_in long, rows long, columns int, damaged long, "
    "error string, finished timestamp"
)


class LayerFailed(RuntimeError):
    """Some datasets of a layer failed; ``results`` tells about all of them."""

    def __init__(self, results: list[Result]):
        self.results = results
        failed = [f"{r.dataset}: {r.error}" for r in results if r.error is not None]
        super().__init__("; ".join(failed))


def run_layer(jobs: Mapping[str, Callable[[], Result | int | None]]) -> list[Result]:
    """Run each job in order; one failing does not stop the others.

    A job returns its rows, or a result of its own.
    """
    results = []
    for dataset, job in jobs.items():
        try:
            done = job()
            results.append(done if isinstance(done, Result) else Result(dataset, done, None))
        except DamagedDocuments as error:
            text = f"{type(error).__name__}: {error}"
            results.append(Result(dataset, error.rows, text, error.damaged, error.rows_in))
        except Exception as error:  # every failure is reported below
            results.append(Result(dataset, None, f"{type(error).__name__}: {error}"))
    if any(result.error is not None for result in results):
        raise LayerFailed(results)
    return results


def record(spark: SparkSession, layer: str, ingest_date: str, results: list[Result], path: str) -> None:
    """Append one row per dataset of a run to the table of run metrics."""
    rows = [(layer, ingest_date, r.dataset, r.rows_in, r.rows, r.columns, r.damaged, r.error, None) for r in results]
    table = spark.createDataFrame(rows, METRICS).withColumn("finished", F.current_timestamp())
    table.coalesce(1).write.mode("append").parquet(path)


def run_recorded(
    spark: SparkSession, layer: str, ingest_date: str, jobs: Mapping[str, Callable], metrics: str | None
) -> list[Result]:
    """``run_layer``; the results are recorded in ``metrics`` whether the layer fails or not."""
    try:
        results = run_layer(jobs)
    except LayerFailed as failed:
        if metrics is not None:
            record(spark, layer, ingest_date, failed.results, metrics)
        raise
    if metrics is not None:
        record(spark, layer, ingest_date, results, metrics)
    return results


class DamagedDocuments(ValueError):
    """More documents did not fit their schema than were tolerated."""

    def __init__(self, damaged: int, rows: int, tolerance: int, rows_in: int | None = None):
        self.damaged, self.rows, self.rows_in = damaged, rows, rows_in
        super().__init__(f"{damaged} damaged documents, {tolerance} tolerated")


def checked(
    docs: DataFrame, dataset: str, transform: Callable[[DataFrame], DataFrame], write: Callable, tolerance: int
) -> Result:
    """Transform the whole documents and write them, unless too many are damaged.

    Documents that are not JSON or do not fit their schema are counted in the
    scan that feeds the table, and left out of it.
    """
    seen = Observation(f"documents of {dataset}")
    damaged = F.count_if(F.col(CORRUPT).isNotNull()).alias("damaged")
    docs = docs.observe(seen, F.count(F.lit(1)).alias("rows"), damaged)
    table = transform(docs.where(F.col(CORRUPT).isNull()).drop(CORRUPT))

    def check(rows: int) -> None:
        if seen.get["damaged"] > tolerance:
            raise DamagedDocuments(seen.get["damaged"], rows, tolerance, seen.get["rows"])

    rows = write(table, check)
    return Result(dataset, rows, None, seen.get["damaged"], seen.get["rows"], len(table.columns))


def build_silver(
    spark: SparkSession, bronze: str, target: str, ingest_date: str, layout: str = "lines", tolerance: int = 0,
    metrics: str | None = None,
) -> list[Result]:
    """The flat entity tables of one ingest date.

    More damaged documents than ``tolerance`` in a dataset make the layer fail, after all
    datasets were tried; that dataset keeps the rows it had.
    """

    def job(domain: str, transform) -> Callable[[], Result]:
        def run() -> Result:
            docs = read_domain(spark, bronze, domain, ingest_date, DOCUMENTS[domain], layout, corrupt=True)

            def write(table: DataFrame, check) -> int:
                return replace_date(table, f"{target}/{domain}", ingest_date, check=check)

            return checked(docs, domain, transform, write, tolerance)

        return run

    jobs = {name: job(name, transform) for name, transform in silver.FLAT_TABLES.items()}
    return run_recorded(spark, "silver", ingest_date, jobs, metrics)


def build_links(
    spark: SparkSession, bronze: str, target: str, ingest_date: str, layout: str = "lines", tolerance: int = 0,
    metrics: str | None = None,
) -> list[Result]:
    """The bridge tables and typed entity tables, replaced as a whole; damage counts as in silver."""

    def job(table: str, domain: str, transform) -> Callable[[], Result]:
        def run() -> Result:
            docs = read_domain(spark, bronze, domain, ingest_date, DOCUMENTS[domain], layout, corrupt=True)
            replace = overwrite_by_year if table == "album_artists" else overwrite

            def write(rows: DataFrame, check) -> int:
                return replace(rows, f"{target}/{table}", check=check)

            return checked(docs, table, transform, write, tolerance)

        return run

    jobs = {name: job(name, *spec) for name, spec in silver.LINK_TABLES.items()}
    return run_recorded(spark, "links", ingest_date, jobs, metrics)


def build_gold(
    spark: SparkSession, source: str, target: str, ingest_date: str, metrics: str | None = None
) -> list[Result]:
    """The statistics tables of one ingest date."""

    def job(table: str, transform, inputs: tuple[str, ...]) -> Callable[[], Result]:
        def run() -> Result:
            frames = [read_date(spark, f"{source}/{name}", ingest_date).drop("ingest_date") for name in inputs]
            # Nothing is known of the keys of stored tables.
            stats = transform(*frames, hot=None)
            rows = replace_date(stats, f"{target}/{table}", ingest_date)
            return Result(table, rows, None, columns=len(stats.columns))

        return run

    return run_recorded(spark, "gold", ingest_date, {name: job(name, *spec) for name, spec in gold.TABLES.items()}, metrics)
