"""Spelling variants: words at one edit from each other, and the form each leads to.

Words meet in blocks.  For each pair at one edit, with the shorter word of g letters, the
first g // 2 letters or the last g - g // 2 are the same in both; so a word
joins the blocks of both ends for g = its length (as the shorter or equal one) and for g
one less (as the longer one).  A pair that shares both ends counts at the first one, so
each pair is met once.  Blocks with many words are cut into chunks, and every two
chunks are a cell of bounded size; no block is gathered in one task.

Within a cell the words are bits.  For each position and letter there is a bitset of the
words that have it there.  A query walks along its letters and keeps four sets: the
words without an error so far, and those with one replaced, one additional or one missing
letter, for which the bitsets of the next or the previous position are taken.  All words
of a cell, and of several small cells together, are followed at once.

A null text has no words, and a null id counts as an empty text in the hash that draws
the deleted letters.  Repeated rows count each time.  Texts and words of any length are
taken whole.  An empty table gives no rows.  Other columns do not matter.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from discolake.llm.batches import flat
from discolake.llm.tables import in_batches, partitions, stored

#: Letters of a word.
LETTERS = "[A-Za-zÀ-ÿ]"
#: A letter is deleted from a run where this number divides its hash.
DELETES = 31
#: Words of a chunk of a block, about; a cell has two chunks at most.
CHUNK = 512
#: Rows of cells that are followed together, at least.
TOGETHER = 512
#: Code points that stand for the end of a word and for what lies behind it.
END, BEHIND = 0, 1
NEAR = "word string, near long, n long, form string"


def words(
    docs: DataFrame, least_length: int = 7, least: int = 2, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """word and n: runs of letters with A-Z lower-cased and, where their hash says so, one letter less."""
    # No shorter run can give a word.
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    given = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    run = F.col("run")
    lower = F.when(
        run.rlike("[A-Z]"), F.translate(run, string.ascii_uppercase, string.ascii_lowercase)
    ).otherwise(run)
    given = given.select("id", lower.alias("run"))
    hashed = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("hash") % F.length("run")).cast("int")
    word = F.when(
        F.col("hash") % DELETES == 0,
        F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))),
    ).otherwise(F.col("run"))
    found = given.withColumn("hash", hashed).select(word.alias("word"))
    counted = found.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least)


def cells(vocabulary: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows word, n, g, tail, a, b, second, name: a word in the cell (a, b) of a block.

    tail: the block is of last letters.  second: the word is of chunk b, not a.
    """
    length = F.length("word")

    def ends(g: Column) -> list[Column]:
        half = F.floor(g / 2).cast("int")
        first = F.concat(g.cast("string"), F.lit("<"), F.substring("word", F.lit(1), half))
        last = F.concat(g.cast("string"), F.lit(">"), F.substring("word", length - (g - half) + 1, g - half))
        return [
            F.struct(g.cast("int").alias("g"), F.lit(tail).alias("tail"), key.alias("block"))
            for tail, key in ((False, first), (True, last))
        ]

    keys = F.filter(F.array(*ends(length), *ends(length - 1)), lambda key: key["g"] > 0)
    rows = vocabulary.select("word", "n", F.explode(keys).alias("key")).select("word", "n", "key.*")
    counts = rows.groupBy("block").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    counts = counts.select(F.col("block"), F.ceil(F.col("rows") / chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int")
    dealt = rows.join(counts, "block").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    a, b = F.least("own", "other"), F.greatest("own", "other")
    name = F.concat_ws(":", "block", a.cast("string"), b.cast("string")).alias("name")
    second = (F.col("own") > F.col("other")).alias("second")
    return dealt.select("word", "n", "g", "tail", a.alias("a"), b.alias("b"), second, name)


def bits(marks: np.ndarray) -> np.ndarray:
    """Rows of marks as rows of 64-bit words."""
    width = -(-marks.shape[-1] // 64) * 8
    packed = np.packbits(marks, axis=-1, bitorder="little")
    out = np.zeros((*marks.shape[:-1], width), "u1")
    out[..., : packed.shape[-1]] = packed
    return out.view("u8")


class PositionIndex:
    """Per position and letter the bitset of the words that have it there."""

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        self.letters, self.codes = np.unique(np.concatenate(([END, BEHIND], codes)), return_inverse=True)
        self.codes, self.starts, self.lengths = self.codes[2:], starts, lengths
        self.made: dict[int, np.ndarray] = {}

    def at(self, position: int) -> np.ndarray:
        """The letter of each word there, as its number among all letters."""
        inside = np.minimum(position, np.maximum(self.lengths - 1, 0))
        letter = self.codes[self.starts + inside]
        return np.where(position < self.lengths, letter, np.where(position == self.lengths, END, BEHIND))

    def sets(self, position: int) -> np.ndarray:
        """A bitset for each letter.  Three positions are kept, as queries move along."""
        if position not in self.made:
            self.made.pop(position - 3, None)
            marks = np.arange(len(self.letters))[:, None] == self.at(position)[None, :]
            self.made[position] = bits(marks)
        return self.made[position]


def near_pairs(
    index: PositionIndex, same: np.ndarray, g: np.ndarray, tail: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word) of the indexed words at one edit, where same has the bit of the word.

    Every word is a query.  A word of g + 1 letters is not compared with others of that length,
    and in tail blocks not with words that begin with the same g // 2 letters.
    """
    # The longest queries first, so those still under way are the first rows.
    order = np.argsort(-index.lengths, kind="stable")
    lengths, g, tail = index.lengths[order], g[order], tail[order]
    none = same[order]
    replaced, added, missing = np.zeros((3, *none.shape), "u8")
    near = np.zeros(none.shape, "u8")
    half = np.where(tail, g // 2, -1)
    position = 0
    while len(none):
        known = half[: len(none)] == position
        if known.any():
            # What agrees up to here belongs to the block of first letters.
            held = none[known]
            near[: len(none)][known] = held
        done = lengths[: len(none)] == position
        if done.any():
            here, ends = np.flatnonzero(done), {p: index.sets(p)[END] for p in (position - 1, position, position + 1)}
            equal = np.where((lengths[here] == g[here])[:, None], replaced[here] & ends[position], np.uint64(0))
            found = equal | (added[here] & ends[position - 1]) | ((missing[here] | none[here]) & ends[position + 1])
            near[here] = found & ~near[here]
            left = int(here[0])
            none, replaced, added, missing = (x[:left] for x in (none, replaced, added, missing))
        if not len(none):
            break
        letter = index.at(position)[order[: len(none)]]
        here, after = index.sets(position)[letter], index.sets(position + 1)[letter]
        before = index.sets(position - 1)[letter] if position else np.zeros_like(here)
        replaced = (replaced & here) | (none & ~here)
        added = (added & before) | none
        missing = (missing | none) & after
        none = none & here
        position += 1
    marks = np.unpackbits(near.view("u1"), axis=-1, bitorder="little")[:, : len(order)]
    query, word = np.nonzero(marks)
    return order[query], word


def near_in_cells(rows: pa.Table):
    """For each word of whole cells: its near words in its cell, and the best of them."""
    texts = rows.column("word").combine_chunks()
    raw, _ = flat(pa.array(["".join(texts.to_pylist())]))
    codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4").astype("i8")
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype("i8")
    starts = np.cumsum(lengths) - lengths
    cell = rows.column("cell").to_numpy()
    n, g, tail = (rows.column(c).to_numpy() for c in ("n", "g", "tail"))
    side = np.where(rows.column("a").to_numpy() == rows.column("b").to_numpy(), -1, rows.column("second").to_numpy())
    index = PositionIndex(codes, starts, lengths)
    # A cell of one chunk is compared with itself, one of two chunks across them.
    partners = (cell[:, None] == cell[None, :]) & ((side[:, None] < 0) | (side[:, None] != side[None, :]))
    query, word = near_pairs(index, bits(partners), g, tail)
    if not len(query):
        return None
    rank = np.empty(len(texts), "i8")
    rank[pc.sort_indices(texts.cast(pa.binary())).to_numpy()] = np.arange(len(texts))
    order = np.lexsort((rank[word], -n[word], query))
    query, word = query[order], word[order]
    first = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
    near = np.diff(np.append(first, len(query)))
    best = pa.array(word[first])
    return pa.RecordBatch.from_arrays(
        [texts.take(pa.array(query[first])), pa.array(near), pa.array(n[word[first]]), texts.take(best)],
        ["word", "near", "n", "form"],
    )


def work_cells(batches: Iterator[pa.RecordBatch]):
    """Rows come sorted by cell; whole cells are worked on, as many as make TOGETHER rows."""
    held: list[pa.Table] = []
    count = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        count += batch.num_rows
        if count <= TOGETHER:
            continue
        table = pa.concat_tables(held).combine_chunks()
        key = table.column("cell").to_numpy()
        starts = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
        low = 0
        for start in starts.tolist():
            if start - low >= TOGETHER:
                yield from filter(None, [near_in_cells(table.slice(low, start - low))])
                low = start
        # The last cell may go on in the next batch.
        last = int(starts[-1])
        if last > low:
            yield from filter(None, [near_in_cells(table.slice(low, last - low))])
        held, count = [table.slice(last)], table.num_rows - last
    if count:
        yield from filter(None, [near_in_cells(pa.concat_tables(held).combine_chunks())])


def near_batches(batches: Iterator[pa.RecordBatch]):
    """The near words of rows that come sorted by the names of their cells, which get numbers here."""

    def cells_of():
        number, last = 0, None
        for batch in batches:
            names = batch.column("name")
            if not len(names):
                continue
            new = np.zeros(len(names), bool)
            new[1:] = pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)
            new[0] = names[0].as_py() != last
            number_of = number + np.cumsum(new)
            number, last = int(number_of[-1]), names[-1].as_py()
            yield batch.drop_columns(["name"]).append_column("cell", pa.array(number_of))

    return work_cells(cells_of())


def near_words(vocabulary: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """word, n_near, form, form_n: how many words of the vocabulary are at one edit, and the most frequent one.

    Ties go to the smallest in code-point order.  Words without a near one are left out.
    """
    rows = cells(vocabulary, chunk).repartition(partitions(vocabulary.sparkSession), "name")
    found = in_batches(rows.sortWithinPartitions("name"), near_batches, NEAR)
    by_n = F.struct((-F.col("n")).alias("less"), F.col("form").alias("form"))
    grouped = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(by_n).alias("top"))
    return grouped.select("word", "n_near", F.col("top.form").alias("form"), (-F.col("top.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of rows word, form: the last word that forms lead to; each round doubles the way."""
    current = stored(forms.select("word", F.col("form").alias("root")), "roots", narrow=True)
    while True:
        further = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = current.join(further, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        step = stored(step, "roots", narrow=True)
        current = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return current


def variants(
    docs: DataFrame,
    least_length: int = 7,
    least: int = 2,
    times: int = 10,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word.

    A word's form is its most frequent near word, if that is at least so many times as
    frequent.  A chain of forms ends, as its counts grow from step to step.
    """
    vocabulary = stored(words(docs, least_length, least, text_col, id_col), "vocabulary", narrow=True)
    found = near_words(vocabulary)
    better = F.col("form_n") >= times * F.col("n")
    forms = vocabulary.join(found, "word", "left").select(
        "word",
        F.when(better, F.col("form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("form_n")).alias("form_n"),
    )
    forms = stored(forms, "forms", narrow=True)
    last = roots(forms.filter("form IS NOT NULL"))
    return forms.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
