"""Near-duplicate vectors by cross-polytope hashing, every candidate pair verified.

A vector is turned by random signs and a fast Hadamard transform, three times; the
nearest signed axis is its hash.  A bucket of a table is named by several hashes, and a
vector is also put into the buckets of its next nearest axes (multiprobe).

Equal vectors are one class before hashing.  A bucket with many vectors is split into
blocks, and each pair of blocks is a cell of bounded size: no pair is lost and no task gets
a bucket whole.  In a cell all cosines are one matrix product in double precision.  A pair that
meets in several buckets counts in the first only.  A cell reports, for each vector, the number of its
links and one member of its local component, never the pairs.

Null vectors, empty and zero ones, and those with null or non-finite components link
with nothing and are their own component.  Vectors of different length never link.
Rows with the same id are one node of the graph and are reported once each.  An empty table gives
no rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.llm.components import components
from discolake.llm.tables import in_batches, partitions, stored

LEAST_COSINE = 0.95
TURNS = 3
#: Vectors of one class that a block of a bucket holds at most, about.
BLOCK = 256
SEED = 29
INSERTED = "bucket long, rep long, size long, unit binary, buckets array<long>"


def plan(count: int, dims: int) -> tuple[int, int, int]:
    """Hashes for a bucket, tables, and further buckets for each vector and table.

    A bucket holds a few unrelated vectors whatever their number; more hashes need
    more tables.  At a cosine of 0.95 two vectors of 64 dimensions meet with a chance of
    0.999 for two hashes and 0.997 for three.
    """
    axes = 2 * (1 << max(1, math.ceil(math.log2(max(2, dims)))))
    hashes = max(1, round(math.log(max(2, count / 8), axes)))
    return hashes, max(6, 3 * hashes), max(1, hashes - 1)


def hadamard(x: np.ndarray) -> np.ndarray:
    rows, width = x.shape
    half = 1
    while half < width:
        pairs = x.reshape(rows, -1, 2, half)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(rows, width)
        half *= 2
    return x / math.sqrt(width)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit integers that spreads near ones (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bucket_names(unit: np.ndarray, hashes: int, tables: int, probes: int) -> np.ndarray:
    """For each row the names of its buckets, (1 + probes) for each table, home first."""
    rows, dims = unit.shape
    width = 1 << max(1, math.ceil(math.log2(max(2, dims))))
    padded = np.pad(unit, ((0, 0), (0, width - dims)))
    names = []
    for table in range(tables):
        first, second, gap = [], [], []
        for k in range(hashes):
            rng = np.random.default_rng((SEED, table, k, dims))
            x = padded
            for _ in range(TURNS):
                x = hadamard(x * rng.choice([-1.0, 1.0], width))
            size = np.abs(x)
            top = np.argpartition(-size, 1, 1)[:, :2]
            pick = np.take_along_axis(size, top, 1)
            order = np.argsort(-pick, 1, kind="stable")
            top, pick = np.take_along_axis(top, order, 1), np.take_along_axis(pick, order, 1)
            axis = top * 2 + (np.take_along_axis(x, top, 1) > 0)
            first.append(axis[:, 0])
            second.append(axis[:, 1])
            gap.append(pick[:, 0] - pick[:, 1])
        home, other, gap = np.stack(first, 1), np.stack(second, 1), np.stack(gap, 1)
        close = np.argsort(gap, 1, kind="stable")
        for probe in range(1 + probes):
            codes = home.copy()
            if 0 < probe <= hashes:
                place = close[:, probe - 1]
                codes[np.arange(rows), place] = other[np.arange(rows), place]
            elif probe:
                codes = other.copy()  # more probes than hashes: the next axis everywhere
            name = np.full(rows, table * 1_000_003 + dims, "u8")
            for k in range(hashes):
                name = mixed(name * np.uint64(2 * width + 1) + codes[:, k].astype("u8"))
            names.append(name.view("i8"))
    return np.stack(names, 1)


def hash_batches(hashes: int, tables: int, probes: int, batches: Iterator[pa.RecordBatch]):
    """rep, size, embedding -> a row for each bucket of each vector."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            lists = part.column("embedding")
            widths = np.diff(lists.offsets.to_numpy()[: len(lists) + 1])
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("f8")
            ends = np.cumsum(widths)
            rep, size = (part.column(c).to_numpy() for c in ("rep", "size"))
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                x = flat[(ends[rows] - width)[:, None] + np.arange(width)]
                # Scaled first, so that no square overflows or vanishes.
                x = x / np.abs(x).max(1, keepdims=True)
                unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                names = bucket_names(unit, hashes, tables, probes)
                packed = [u.tobytes() for u in unit]
                # A vector is put into a bucket once.
                owner, place = np.nonzero(~np.triu(names[:, :, None] == names[:, None, :], 1).any(1))
                lists_of = names.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[owner, place]),
                        pa.array(rep[rows][owner]),
                        pa.array(size[rows][owner]),
                        pa.array([packed[i] for i in owner.tolist()], pa.binary()),
                        pa.array([lists_of[i] for i in owner.tolist()], pa.list_(pa.int64())),
                    ],
                    ["bucket", "rep", "size", "unit", "buckets"],
                )


def local_roots(near: np.ndarray) -> np.ndarray:
    """Least row that each row of a symmetric matrix of links reaches."""
    roots = np.arange(len(near))
    while True:
        around = np.where(near, roots[None, :], len(near)).min(1)
        new = np.minimum(roots, around)
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def verify(cell: dict[str, np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Rows of one cell -> rep, links that count here, root; None without a link."""
    unit, side = cell["unit"], cell["side"]
    near = unit @ unit.T >= least
    np.fill_diagonal(near, False)
    if (side != side[0]).any():
        near &= side[:, None] != side[None, :]
    if not near.any():
        return None
    a, b = np.nonzero(np.triu(near))
    # Of all buckets where the two meet, this one must be the first in order.
    names = cell["buckets"]
    counts = np.zeros(len(unit), "i8")
    for start in range(0, len(a), 4096):
        i, j = a[start : start + 4096], b[start : start + 4096]
        shared = (names[i][:, :, None] == names[j][:, None, :]).any(2)
        first = np.where(shared, names[i], np.iinfo("i8").max).min(1) == cell["bucket"]
        np.add.at(counts, i[first], cell["size"][j[first]])
        np.add.at(counts, j[first], cell["size"][i[first]])
    linked = near.any(1)
    order = np.argsort(cell["rep"], kind="stable")
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    roots = cell["rep"][order][local_roots(near[np.ix_(order, order)])][back]
    return cell["rep"][linked], counts[linked], roots[linked]


def verify_batches(least: float, batches: Iterator[pa.RecordBatch]):
    """Rows sorted by bucket and cell; a cell may go on in the next batch."""
    columns = ("bucket", "low", "high", "rep", "size", "unit", "buckets", "side")
    held: list[tuple] = []

    def done(rows: list[tuple]):
        if len(rows) < 2:
            return None
        bucket, _, _, rep, size, unit, buckets, side = zip(*rows, strict=True)
        return verify(
            {
                "bucket": bucket[0],
                "rep": np.array(rep),
                "size": np.array(size),
                "unit": np.frombuffer(b"".join(unit), "f8").reshape(len(rows), -1),
                "buckets": np.array(buckets),
                "side": np.array(side),
            },
            least,
        )

    for batch in batches:
        found = []
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if held and held[-1][:3] != row[:3]:
                found.append(done(held))
                held = []
            held.append(row)
        yield from reported(found)
    yield from reported([done(held)])


def reported(found: list) -> Iterator[pa.RecordBatch]:
    found = [x for x in found if x is not None]
    if found:
        arrays = [pa.array(np.concatenate(x)) for x in zip(*found, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["rep", "links", "root"])


def near_vectors(
    vectors: DataFrame,
    least: float = LEAST_COSINE,
    vector_col: str = "embedding",
    id_col: str = "vec_id",
    block: int = BLOCK,
) -> DataFrame:
    """One row for each row of vectors: id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = finite & F.exists("embedding", lambda x: x != 0) & F.col("id").isNotNull()
    valid = given.filter(F.coalesce(usable, F.lit(False)))
    classes = valid.groupBy("embedding").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"))
    classes = stored(classes, "vector-classes")
    count, dims = classes.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    hashes, tables, probes = plan(count, dims or 1)
    work = functools.partial(hash_batches, hashes, tables, probes)
    inserted = stored(in_batches(classes.select("rep", "size", "embedding"), work, INSERTED), "vector-buckets")
    full = inserted.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    blocks = F.ceil(F.col("held") / block)
    own = F.pmod(F.xxhash64("rep", F.lit(SEED)), blocks)
    cells = (
        inserted.join(full, "bucket")
        .withColumns({"blocks": blocks, "side": own})
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")})
        .select("bucket", "low", "high", "rep", "size", "unit", "buckets", "side")
        .repartition(partitions(spark), "bucket", "low", "high")
        .sortWithinPartitions("bucket", "low", "high")
    )
    met = in_batches(cells, functools.partial(verify_batches, least), "rep long, links long, root long")
    met = stored(met, "vector-links", narrow=True)
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(met.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = (
        classes.select("rep", "size", "embedding")
        .join(links, "rep", "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("embedding").alias("same"),
            (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    # Rows that are not usable equal none of the classes.
    joined = given.join(known, F.col("embedding") == F.col("same"), "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
