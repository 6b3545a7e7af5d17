"""N-gram Jaccard join by rare-first prefixes with length, positional and suffix filters.

Two sets whose Jaccard similarity reaches the threshold share a member among the first
p = n - ceil(threshold * n) + 1 of each, in any order that holds for all sets.  The order
here: first the grams of a fixed part of the hash space, rarest first by their exact count
over all sets, then the others by hash.  Only that part is counted and shuffled,
which holds more than p grams of nearly every set; a set that falls short adds its next
grams by hash.  A gram that one set alone has can match nothing, so it only counts
as a position: a set with p of them links with nothing and is done.

Equal sets are one class from the start.  Prefix grams bring classes together in three steps:

1. Each class meets one hub: of the classes for which a gram of its prefix
   is most central, the one that comes up most often.  This is linear in the prefixes, and it
   ties up most of a large group of near copies.
2. Of the grams that are still in the prefixes of several components, each class chooses those that most
   classes have.  The classes with one choice are compared inside cells of bounded size: what the
   length and the suffix filter leave, as a product of matrices, which reports links between components only.
   A pair is compared in the cell of the least choice that both have.
3. Pairs that share a prefix gram but no choice, and that step 1 left in different components, meet unless
   a filter rules them out: length, position of the shared gram, or the suffix filter, which
   compares how many grams both have in each of 32 parts of the hash space.  The classes of a
   frequent gram meet in cells here too, so no task tests all pairs of one gram.

A pair is verified by the exact overlap of its whole sets, once in steps 2 and 3, which a pair that failed as
a hub pair may reach again; a pair inside a component is never spelled out.

Grams are words joined by 64-bit hashes.  A null or empty text, or one without words, has no
grams and links with nothing.  A text with fewer words than a gram is one gram.  A null
id links with nothing.  Rows with one id are one node, with one of their texts if these
differ, and are reported once each.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from discolake.llm.batches import slices
from discolake.llm.components import components
from discolake.llm.cross_polytope import local_roots, mixed
from discolake.llm.tables import in_batches, partitions, perhaps_among, stored

#: The counted part of the hash space, as a multiple of the share of a set that is its prefix.
COUNTED = 1.75
BINS = 32
SETS = "doc_id long, text_hash long, n_grams long, digest binary, counted int, grams array<long>, bins array<int>"
WHOLE = "doc_id long, digest binary, grams array<long>"
#: Ids that are broadcast at most, as the driver holds them several times over meanwhile; of more, rows that cannot be
#: among them are left out first, and the others are joined by a shuffle.
BROADCAST_IDS = 200_000
#: Grams that a class chooses; classes of one block of a gram, and members that their sets have, at most about so
#: many; columns of a matrix product; pairs of sets that are counted at once.
CHOICES = 3
BLOCK = 512
BLOCK_MEMBERS = 1 << 18
COLUMNS = 8192
PAIRS = 1 << 18


def least_overlap(n: int | np.ndarray, percent: int):
    """Members that a set of n shares at least with one that reaches the threshold."""
    return -(-n * percent // 100)


def prefix_length(n, percent: int):
    return n - least_overlap(n, percent) + 1


def counted_limit(counted: float) -> int:
    """The largest hash of the counted part, unsigned."""
    return 2**64 - 1 if counted >= 1 else int(counted * 2**64)


def gram_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """For each text its distinct n-grams as sorted unsigned hashes."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    ends = lists.offsets.to_numpy().astype("i8")
    coded = lists.flatten().dictionary_encode()
    known = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in known), "u8", len(known))
    codes = coded.indices.to_numpy(zero_copy_only=False)
    flat = hashes[codes] if len(known) else np.zeros(0, "u8")
    real = np.fromiter((w != "" for w in known), bool, len(known))[codes] if len(known) else np.zeros(0, bool)
    flat = flat[real]
    ends = np.concatenate(([0], np.cumsum(real)))[ends]
    factor = np.uint64(0x9E3779B97F4A7C15)
    grams = np.zeros(max(0, len(flat) - words + 1), "u8")
    for k in range(words):
        grams = mixed(grams * factor + flat[k : k + len(grams)])
    out = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(grams[a : b - words + 1]))
        elif b > a:
            whole = np.array([b - a], "u8")  # apart from grams of full length
            for k in range(a, b):
                whole = mixed(whole * factor + flat[k : k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, "u8"))
    return out


def digest_of(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def set_batches(words: int, percent: int, highest: int, batches: Iterator[pa.RecordBatch]):
    limit = np.uint64(highest)
    for batch in batches:
        for part in slices(batch, "text"):
            rows = []
            for grams in gram_sets(pc.fill_null(part.column("text"), ""), words):
                n = len(grams)
                inside = int(np.searchsorted(grams, limit, "right"))
                take = max(inside, min(n, prefix_length(n, percent)))
                bins = np.bincount((grams & np.uint64(BINS - 1)).astype("i8"), minlength=BINS)
                rows.append((n, digest_of(grams), inside, grams[:take].view("i8"), bins.astype("i4")))
            counts, digests, insides, grams, bins = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_hash"),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(insides, pa.int32()),
                    pa.array(grams, pa.list_(pa.int64())),
                    pa.array(bins, pa.list_(pa.int32())),
                ],
                ["doc_id", "text_hash", "n_grams", "digest", "counted", "grams", "bins"],
            )


def whole_batches(words: int, batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch, "text"):
            sets = gram_sets(pc.fill_null(part.column("text"), ""), words)
            arrays = [
                part.column("doc_id"),
                pa.array([digest_of(s) for s in sets], pa.binary()),
                pa.array([s.view("i8") for s in sets], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "digest", "grams"])


def shared_grams(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """rep, n, counted, shared: the grams of each class that another class has too, with their counts."""
    mine = sets.join(nodes.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi")
    grams = mine.select(F.col("doc_id").alias("rep"), F.explode("grams").alias("gram"))
    common = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    met = grams.join(common.hint("shuffle_hash"), "gram")
    # As long as the text of one document at most.
    of_class = met.groupBy("rep").agg(F.collect_set(F.struct("df", "gram")).alias("shared"))
    sizes = mine.select(F.col("doc_id").alias("rep"), F.col("n_grams").alias("n"), "counted")
    return of_class.join(sizes.dropDuplicates(["rep"]), "rep")


def prefixes(of_class: DataFrame, percent: int, highest: int) -> DataFrame:
    """rep, n, gram, pos: the shared grams in the prefix of each class, with their positions.

    The position of a gram outside of the counted part is unknown, and null.
    """

    def inside(s: Column) -> Column:
        # Hashes are compared unsigned: those from 2**63 on are negative here.
        gram = s["gram"]
        if highest < 2**63:
            return (gram >= 0) & (gram <= highest)
        return (gram >= 0) | (gram <= highest - 2**64)

    ranked = F.array_sort(F.filter("shared", inside))
    others = F.filter("shared", lambda s: ~inside(s))
    p = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # Grams that no other class has come first.
    placed = of_class.withColumns(
        {"p": p, "ranked": ranked, "others": others, "alone": F.col("counted") - F.size(ranked)}
    )
    pos = F.col("alone") + F.col("at")
    first = (
        placed.filter("alone < p")
        .select("rep", "n", "p", "alone", F.posexplode("ranked").alias("at", "s"))
        .filter(pos < F.col("p"))
        .select("rep", "n", F.col("s.gram").alias("gram"), pos.cast("long").alias("pos"))
    )
    last = placed.filter("counted < p").select("rep", "n", F.explode("others.gram").alias("gram"))
    return first.unionByName(last.withColumn("pos", F.lit(None).cast("long")))


def fits(a: str, b: str, percent: int) -> Column:
    """Length and positional filter for two rows that share a prefix gram."""
    na, nb, pa_, pb = (F.col(f"{x}.{c}") for x, c in ((a, "n"), (b, "n"), (a, "pos"), (b, "pos")))
    length = (na * 100 >= nb * percent) & (nb * 100 >= na * percent)
    # Before the shared gram they share one less than either position at most.
    most = F.least(pa_, pb) + F.least(na - pa_, nb - pb)
    return length & F.coalesce(enough(most, na, nb, percent), F.lit(True))


def enough(overlap: Column, na: Column, nb: Column, percent: int) -> Column:
    # overlap * 100 >= (na + nb - overlap) * percent; an overlap named twice would be worked out for every pair of
    # a join, also for those that a cheaper test rules out.
    return overlap * (100 + percent) >= (na + nb) * percent


def whole_sets(ids: DataFrame, docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """doc_id, grams: the whole sets of the classes that ids name, made again from their texts."""
    needed = stored(ids.distinct(), "gram-needed", narrow=True)
    reps = nodes.select(F.col("rep").alias("doc_id"), "digest")
    if needed.count() <= BROADCAST_IDS:
        texts = docs.join(F.broadcast(needed), "doc_id", "left_semi")
    else:
        texts = perhaps_among(docs, F.col("doc_id"), needed).filter("__among").drop("__among")
        reps = reps.join(needed, "doc_id", "left_semi")
    whole = in_batches(texts, functools.partial(whole_batches, words), WHOLE)
    whole = whole.join(reps, ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id"])
    return stored(whole.select("doc_id", "grams"), "gram-sets")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs a, b whose whole sets reach the threshold."""
    whole = whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), docs, nodes, words)
    left = whole.select(F.col("doc_id").alias("a"), F.col("grams").alias("left"))
    right = whole.select(F.col("doc_id").alias("b"), F.col("grams").alias("right"))
    overlap = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter(enough(overlap, F.size("left"), F.size("right"), percent))
        .select("a", "b")
    )


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two of the sets share; 0 for a set and itself.

    Members of few sets are counted pair by pair, the others as products of columns of members.
    """
    rows = len(sets)
    owner = np.repeat(np.arange(rows), [len(s) for s in sets])
    members = np.concatenate(sets)
    order = np.argsort(members, kind="stable")
    owner, members = owner[order], members[order]
    first = np.flatnonzero(np.concatenate(([True], members[1:] != members[:-1]))[: len(members)])
    held = np.diff(np.append(first, len(members)))
    shared = np.zeros((rows, rows), "f4")
    few = max(2, rows // 16)
    for n in np.unique(held[(held > 1) & (held <= few)]).tolist():
        x, y = np.triu_indices(n, 1)
        at = first[held == n]
        for low in range(0, len(at), max(1, PAIRS // len(x))):
            who = owner[at[low : low + max(1, PAIRS // len(x)), None] + np.arange(n)]
            np.add.at(shared.reshape(-1), (who[:, x] * rows + who[:, y]).reshape(-1), np.float32(1))
    shared += shared.T
    many = np.flatnonzero(held > few)
    for low in range(0, len(many), COLUMNS):
        some = many[low : low + COLUMNS]
        column = np.repeat(np.arange(len(some)), held[some])
        # The rows of members that stand one after another.
        row = owner[np.repeat(first[some] - np.cumsum(held[some]) + held[some], held[some]) + np.arange(len(column))]
        part = np.zeros((rows, len(some)), "f4")
        part[row, column] = 1
        shared += part @ part.T
    np.fill_diagonal(shared, 0)
    return shared


def lengths(sets: list[np.ndarray]) -> np.ndarray:
    """In the narrowest type that holds any sum of two of them times 200."""
    n = np.array([len(x) for x in sets], "i8")
    return n.astype("i4") if not len(n) or n.max() < 2**31 // 400 else n


def may_reach(sets: list[np.ndarray], open_pairs: np.ndarray, percent: int) -> np.ndarray:
    """Length and suffix filter: the open pairs that the sizes of their sets, and of their parts, allow."""
    n = lengths(sets)
    least, most = np.minimum.outer(n, n), np.maximum.outer(n, n)
    open_pairs = open_pairs & (least * 100 >= most * percent)
    if open_pairs.any():
        bins = np.stack([np.bincount(x & (BINS - 1), minlength=BINS) for x in sets])
        bins = bins.astype(np.min_scalar_type(bins.max()))
        shared = np.zeros(open_pairs.shape, n.dtype)
        for k in range(BINS):
            shared += np.minimum.outer(bins[:, k], bins[:, k])
        open_pairs &= shared * (100 + percent) >= np.add.outer(n, n) * percent
    return open_pairs


def verify_cells(percent: int, batches: Iterator[pa.RecordBatch]):
    """Rows sorted by gram and cell -> a, b: links that join each component of a cell; a cell may
    go on in the next batch."""
    columns = ("gram", "low", "high", "rep", "group", "side", "choices", "grams")
    held: list[tuple] = []

    def done(rows: list[tuple]) -> list[tuple[int, int]]:
        if len(rows) < 2:
            return []
        gram, _, _, rep, group, side, choices, sets = zip(*rows, strict=True)
        order = np.argsort(np.array(rep), kind="stable")
        rep, group, side = (np.array(x)[order] for x in (rep, group, side))
        sets = [np.array(sets[i], "i8") for i in order]
        open_pairs = group[:, None] != group[None, :]
        if (side != side[0]).any():
            open_pairs &= side[:, None] != side[None, :]
        # Of the grams that both chose this one must be the least.
        lower = [[c for c in choices[i] if c < gram[0]] for i in order]
        for k in range(max(map(len, lower))):
            mine = np.array([x[k] if k < len(x) else 0 for x in lower], "i8")
            there = np.array([k < len(x) for x in lower])
            for m in range(max(map(len, lower))):
                other = np.array([x[m] if m < len(x) else 0 for x in lower], "i8")
                known = np.array([m < len(x) for x in lower])
                open_pairs &= ~((mine[:, None] == other[None, :]) & there[:, None] & known[None, :])
        open_pairs = may_reach(sets, open_pairs, percent)
        some = np.flatnonzero(open_pairs.any(1))
        if not len(some):
            return []
        # Only rows that are in an open pair are multiplied.
        rep, sets, open_pairs = rep[some], [sets[i] for i in some], open_pairs[np.ix_(some, some)]
        n = lengths(sets)
        near = overlaps(sets).astype(n.dtype) * (100 + percent) >= np.add.outer(n, n) * percent
        near &= open_pairs
        root = local_roots(near)
        return [(int(rep[i]), int(rep[r])) for i, r in enumerate(root.tolist()) if i != r]

    def reported(links: list[tuple[int, int]]):
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], ["a", "b"])

    for batch in batches:
        found = []
        keys = list(zip(*(batch.column(c).to_pylist() for c in columns[:-1]), strict=True))
        lists = batch.column("grams")
        for i, key in enumerate(keys):
            if held and held[-1][:3] != key[:3]:
                found += done(held)
                held = []
            held.append((*key, lists[i].values.to_numpy()))
        yield from reported(found)
    yield from reported(done(held))


def in_cells(rows: DataFrame, held: DataFrame) -> DataFrame:
    """rows with side, low, high: each row in the cells of its gram, of two blocks of about BLOCK rows each.

    held: gram and held, how many rows have it, and members, if they come with sets, how many these have;
    rows of other grams are left out.
    """
    blocks = F.ceil(F.col("held") / BLOCK)
    if "members" in held.columns:
        blocks = F.greatest(blocks, F.ceil(F.col("members") / BLOCK_MEMBERS))
    return (
        rows.join(held.select("gram", blocks.alias("blocks")), "gram")
        .withColumn("side", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"low": F.least("side", "other"), "high": F.greatest("side", "other")})
        .drop("blocks", "other")
    )


def linked_in_cells(chosen: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """chosen: gram, rep, n, group, choices.  Links between groups among the classes of each gram.

    The classes of a gram are split into blocks, and each two blocks are a cell.
    """
    held = chosen.groupBy("gram").agg(
        F.count(F.lit(1)).alias("held"),
        F.sum("n").alias("members"),
        F.min("group").alias("least"),
        F.max("group").alias("most"),
    )
    cells = in_cells(chosen.drop("n"), held.filter("least < most"))
    cells = stored(cells, "gram-cells", narrow=True)
    whole = whole_sets(cells.select(F.col("rep").alias("doc_id")), docs, nodes, words)
    full = (
        cells.join(whole, F.col("rep") == F.col("doc_id"))
        .select("gram", "low", "high", "rep", "group", "side", "choices", "grams")
        .repartition(partitions(docs.sparkSession), "gram", "low", "high")
        .sortWithinPartitions("gram", "low", "high")
    )
    return in_batches(full, functools.partial(verify_cells, percent), "a long, b long")


def hub_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """a, b: each class with the one hub that comes up most often over its prefix grams."""
    hubs = placed.groupBy("gram").agg(
        F.min(F.struct("pos", "rep", "n")).alias("hub"), F.count(F.lit(1)).alias("held")
    )
    meet = placed.alias("x").join(hubs.filter("held > 1").select("gram", "hub.*").alias("y"), "gram")
    meet = meet.filter((F.col("x.rep") != F.col("y.rep")) & fits("x", "y", percent))
    often = meet.groupBy(F.col("x.rep").alias("rep"), F.col("y.rep").alias("hub")).agg(
        F.count(F.lit(1)).alias("times")
    )
    best = often.groupBy("rep").agg(F.max(F.struct("times", (-F.col("hub")).alias("back"))).alias("best"))
    hub = -F.col("best.back")
    return best.select(F.greatest("rep", hub).alias("a"), F.least("rep", hub).alias("b")).distinct()


def open_rows(placed: DataFrame, groups: DataFrame) -> DataFrame:
    """The prefix rows whose gram is in several groups, with group and held, the classes of the gram."""
    marked = (
        placed.join(groups, F.col("rep") == F.col("node"), "left")
        .withColumn("group", F.coalesce("component", "rep"))
        .drop("node", "component")
    )
    several = marked.groupBy("gram").agg(
        F.min("group").alias("least"), F.max("group").alias("most"), F.count(F.lit(1)).alias("held")
    )
    return marked.join(several.filter("least < most").select("gram", "held"), "gram")


def with_choices(rows: DataFrame) -> DataFrame:
    """rows with choices, the CHOICES grams of the class that most classes have."""
    # As many grams as the prefix of one document has at most.
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("held")).alias("less"), "gram")))
    choices = rows.groupBy("rep").agg(F.slice(ranked, 1, CHOICES)["gram"].alias("choices"))
    return rows.drop("held").join(choices, "rep")


def apart_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """rows: gram, rep, n, pos, group, choices, held -> a, b: pairs of two groups that share a gram, but no choice, and
    that the length and positional filters leave."""
    cells = in_cells(rows.drop("held"), rows.select("gram", "held").distinct())
    x, y = cells.alias("x"), cells.alias("y")
    apart = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.low") == F.col("y.low")) & (F.col("x.high") == F.col("y.high"))
    # In a cell of two blocks rows of one block do not meet: they do in the cell of that block.
    apart &= (F.col("x.group") > F.col("y.group")) & ((F.col("x.low") == F.col("x.high")) | (F.col("x.side") != F.col("y.side")))
    # Most pairs have the same first choice, which is the cheaper test.
    apart &= (F.col("x.choices")[0] != F.col("y.choices")[0]) & ~F.arrays_overlap("x.choices", "y.choices")
    pairs = x.join(y, apart & fits("x", "y", percent))
    return pairs.select(F.greatest("x.rep", "y.rep").alias("a"), F.least("x.rep", "y.rep").alias("b")).distinct()


def alike_in_parts(pairs: DataFrame, sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Suffix filter: the pairs a, b that the sizes of the parts of their sets allow."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    reps = nodes.join(ids, "rep", "left_semi").select(F.col("rep").alias("doc_id"), "digest")
    bins = sets.select("doc_id", "digest", "n_grams", "bins").join(reps, ["doc_id", "digest"], "left_semi")
    bins = bins.dropDuplicates(["doc_id"])
    left = bins.select(F.col("doc_id").alias("a"), F.col("n_grams").alias("na"), F.col("bins").alias("left"))
    right = bins.select(F.col("doc_id").alias("b"), F.col("n_grams").alias("nb"), F.col("bins").alias("right"))
    most = F.aggregate(
        F.zip_with("left", "right", lambda i, j: F.least(i, j)), F.lit(0), lambda total, i: total + i
    )
    near = enough(most, F.col("na"), F.col("nb"), percent)
    return pairs.join(left, "a").join(right, "b").filter(near).select("a", "b")


def similar_documents(
    docs: DataFrame, words: int = 5, percent: int = 80, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """One row for each row of docs: doc_id, n_grams, component_id, class_id.

    Sets of grams link at a Jaccard similarity of percent / 100 or more.
    """
    return linked_rows(docs, words, percent, text_col, id_col).drop("text_hash")


def linked_rows(docs: DataFrame, words: int, percent: int, text_col: str, id_col: str) -> DataFrame:
    """similar_documents with the hash of the row's text, which tells rows of one id apart."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    highest = counted_limit(COUNTED * (100 - percent) / 100)
    work = functools.partial(set_batches, words, percent, highest)
    hashed = given.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sets = stored(in_batches(hashed, work, SETS), "gram-prefixes")
    nodes = sets.filter("n_grams > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("digest").alias("digest"))
    classes = nodes.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "gram-classes", narrow=True)
    placed = prefixes(stored(shared_grams(sets, classes), "shared-grams"), percent, highest)
    placed = stored(placed, "gram-prefix-rows", narrow=True)

    tried = stored(hub_pairs(placed, percent), "hub-pairs", narrow=True)
    links = stored(verified(tried, given, classes, words, percent), "hub-links", narrow=True)
    rows = stored(with_choices(open_rows(placed, components(links))), "open-grams", narrow=True)

    # Classes that choose one gram meet in its cells.
    chosen = rows.select("rep", "n", "group", "choices").distinct()
    chosen = chosen.select("rep", "n", "group", "choices", F.explode("choices").alias("gram"))
    links = links.unionByName(stored(linked_in_cells(chosen, given, classes, words, percent), "cell-links", narrow=True))

    # The pairs that share a gram but no choice, of groups that are still apart.
    rows = stored(open_rows(rows.drop("group"), components(links)), "apart-grams", narrow=True)
    pairs = stored(apart_pairs(rows, percent).join(tried, ["a", "b"], "left_anti"), "apart-pairs", narrow=True)
    pairs = alike_in_parts(pairs, sets, classes, percent)
    pairs = stored(pairs, "open-pairs", narrow=True)
    groups = components(links.unionByName(verified(pairs, given, classes, words, percent)))

    ends = classes.join(groups, F.col("rep") == F.col("node"), "left").select(
        F.col("digest").alias("same"), "rep", F.coalesce("component", "rep").alias("component")
    )
    joined = sets.select("doc_id", "text_hash", "n_grams", "digest").join(
        ends, (F.col("digest") == F.col("same")) & (F.col("n_grams") > 0), "left"
    )
    return joined.select(
        "doc_id",
        "text_hash",
        "n_grams",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("rep", "doc_id").alias("class_id"),
    )


def one_of_each(
    docs: DataFrame, words: int = 5, percent: int = 80, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """The rows of docs without those that links lead to another id.

    Of an id with different texts only the rows that are linked go.
    """
    found = linked_rows(docs, words, percent, text_col, id_col)
    linked = F.col("component_id") != F.col("doc_id")
    ids = found.groupBy(F.col("doc_id").alias("__drop")).agg(
        F.bool_or(linked).alias("some"), F.bool_and(linked).alias("all")
    )
    ids = stored(ids.filter("some").drop("some"), "gram-drop", narrow=True)
    drop, parted = ids.filter("all").select("__drop"), ids.filter("NOT all")
    gone = F.col(id_col) == F.col("__drop")
    if drop.count() <= BROADCAST_IDS:
        rest = docs.join(F.broadcast(drop), gone, "left_anti")
    else:
        rows = perhaps_among(docs, F.col(id_col).cast("long"), drop)
        stay, some = (rows.filter(F.col("__among") == among).drop("__among") for among in (False, True))
        rest = stay.unionByName(some.join(drop, gone, "left_anti"))
    if parted.isEmpty():
        return rest
    rows = found.filter(linked).join(parted, F.col("doc_id") == F.col("__drop"), "left_semi")
    rows = rows.select(F.col("doc_id").alias("__drop"), F.col("text_hash").alias("__text")).distinct()
    rows = stored(rows, "gram-drop-rows", narrow=True)
    same = (F.col(id_col) == F.col("__drop")) & (F.xxhash64(F.col(text_col)) == F.col("__text"))
    return rest.join(rows, same, "left_anti")
