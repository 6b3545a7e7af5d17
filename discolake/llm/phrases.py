"""Phrases whose words come together more often than apart, counted in a burst trie.

A task numbers its words and counts phrases in a HAT-trie.  All phrases begin in one hybrid hash
container, which their first words share.  When it grows too large it bursts: first words with many phrases get
subtrees of their own, hash containers of the word numbers that follow, and these burst
into a node with a container for each next word.  When a trie holds too many entries, its largest
subtrees leave whole, each as a sorted run of phrases and counts, the shared container among them.
The runs of all tasks are written, dealt to ranges of phrases, so that phrases with one
beginning are neighbours and a very common beginning fills several ranges, and added up there.

Words are counted first, then pairs of frequent words, then longer phrases in which every two
neighbours are a frequent pair: no others can be frequent.  Tasks look up what is frequent in a hashed set of
at most FILTER_BITS bits, which grows with its members up to that bound and lets some more
phrases through when it is full; counts stay exact.

A null text has no words, a null language is UNKNOWN.  Repeated rows count each time, texts
are taken whole, other columns do not matter, and an empty table gives no rows.  Words
are told apart as they are written, but for A-Z.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from discolake.llm.batches import flat, slices
from discolake.llm.tables import in_batches, partitions, stored

UNKNOWN = "und"
#: Words of a phrase at most.
LONGEST = 4
#: Bits of a word number; a word of a phrase that is not there has number 0.
ID_BITS = 21
ID_MASK = (1 << ID_BITS) - 1
#: Entries of a container that make it burst, and of a trie that make subtrees leave.
BURST = 4_096
MOST_ENTRIES = 1_000_000
#: Bytes of a phrase in the shared container: its first word with the language, and the rest.
KEY = np.dtype([("first", ">i8"), ("rest", ">i8")])
#: Rows of a batch of a run.
RUN_ROWS = 50_000
SLICE = 4 << 20
#: Bits of the set of frequent pairs, at least and at most (32 MB).
FILTER_BITS = (1 << 20, 1 << 28)
#: Groups of a language that are cut to its first phrases before they meet.
GROUPS = 64

RUNS = "lang string, phrase string, f long"
# What parts words, and what parts the pieces that phrases stay within.
WORD, SPACE, BREAK = 0, 1, 2
CLASS = np.zeros(256, "u1")
CLASS[[9, 32]] = SPACE
CLASS[[*b".,;:!?", *range(10, 14)]] = BREAK


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts side by side, the piece each is in, and its row."""
    blob, ends = flat(pc.ascii_lower(texts))
    kind = CLASS[blob]
    inside = kind == WORD
    starts_row = np.zeros(len(blob), bool)
    starts_row[ends[:-1][ends[:-1] < len(blob)]] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | starts_row[1:]
    at = np.flatnonzero(first)
    letters = blob[inside]
    offsets = np.append(np.cumsum(inside, dtype="i8")[at] - 1, len(letters))
    words = pa.Array.from_buffers(
        pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
    )
    piece = np.cumsum((kind == BREAK) | starts_row, dtype="i8")[at]
    return words, piece, np.searchsorted(ends, at, side="right") - 1


class Node:
    """A container that burst: one for each next word."""

    def __init__(self):
        self.under: dict[int, Node | dict[int, int]] = {}


class Trie:
    """Counts of phrases: a shared container, and subtrees of the first words that fill it most."""

    def __init__(self, burst: int = BURST, longest: int = LONGEST):
        self.burst = burst
        self.bits = (longest - 1) * ID_BITS  # of what follows a first word
        self.shared: dict[bytes, int] = {}
        self.room = burst
        self.under: dict[int, Node | dict[int, int]] = {}
        self.sizes: dict[int, int] = {}
        self.heavy = np.zeros(0, "i8")
        self.entries = 0

    def add(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> None:
        """Phrases sorted by first and rest, each once."""
        own = np.isin(first, self.heavy) if len(self.heavy) else np.zeros(len(first), bool)
        self.add_to_subtrees(first[own], rest[own], counts[own])
        keys = np.empty(int((~own).sum()), KEY)
        keys["first"], keys["rest"] = first[~own], rest[~own]
        held, before = self.shared, len(self.shared)
        get = held.get
        for key, count in zip(keys.view("V16").tolist(), counts[~own].tolist()):
            held[key] = get(key, 0) + count
        self.entries += len(held) - before
        if len(held) > self.room:
            self.burst_shared()

    def unpacked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.frombuffer(b"".join(self.shared), KEY)
        counts = np.fromiter(self.shared.values(), "i8", len(self.shared))
        return keys["first"].astype("i8"), keys["rest"].astype("i8"), counts

    def burst_shared(self) -> None:
        """First words with the most phrases move to subtrees; many with few phrases stay together."""
        first, rest, counts = self.unpacked()
        order = np.lexsort((rest, first))
        first, rest, counts = first[order], rest[order], counts[order]
        words, sizes = np.unique(first, return_counts=True)
        much = words[sizes >= max(2, self.burst // 64)]
        moved = np.isin(first, much)
        self.entries -= len(self.shared)
        keys = np.empty(int((~moved).sum()), KEY)
        keys["first"], keys["rest"] = first[~moved], rest[~moved]
        self.shared = dict(zip(keys.view("V16").tolist(), counts[~moved].tolist()))
        self.entries += len(self.shared)
        self.heavy = np.union1d(self.heavy, much)
        self.add_to_subtrees(first[moved], rest[moved], counts[moved])
        # What could not be moved counts as room, so that it is not looked through again at once.
        self.room = 2 * len(self.shared) + self.burst

    def add_to_subtrees(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> None:
        if not len(first):
            return
        cuts = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1]))).tolist()
        keys, rests, counts = first[cuts].tolist(), rest.tolist(), counts.tolist()
        for key, a, b in zip(keys, cuts, [*cuts[1:], len(rests)]):
            new = self.put(self.under, key, rests[a:b], counts[a:b], self.bits)
            self.sizes[key] = self.sizes.get(key, 0) + new
            self.entries += new

    def put(self, holder: dict, key: int, rests: list[int], counts: list[int], bits: int) -> int:
        """Adds to what is at key; bits is the width of the rests.  Returns how many entries are new."""
        held = holder.get(key)
        if held is None:
            held = holder[key] = {}
        if isinstance(held, Node):
            return self.deal(held, rests, counts, bits)
        before = len(held)
        get = held.get
        for rest, count in zip(rests, counts):
            held[rest] = get(rest, 0) + count
        new = len(held) - before
        if len(held) > self.burst and bits > ID_BITS:
            node = holder[key] = Node()
            order = sorted(held)
            self.deal(node, order, [held[r] for r in order], bits)
        return new

    def deal(self, node: Node, rests: list[int], counts: list[int], bits: int) -> int:
        low = bits - ID_BITS
        mask = (1 << low) - 1
        new, start = 0, 0
        while start < len(rests):
            lead = rests[start] >> low
            stop = start + 1
            while stop < len(rests) and rests[stop] >> low == lead:
                stop += 1
            some = [r & mask for r in rests[start:stop]]
            new += self.put(node.under, lead, some, counts[start:stop], low)
            start = stop
        return new

    def largest(self, entries: int) -> list[int | None]:
        """The largest subtrees that hold so many entries together; None is the shared container."""
        keys, held = [], 0
        sizes = {None: len(self.shared), **self.sizes}
        for key in sorted(sizes, key=sizes.get, reverse=True):
            if held >= entries:
                break
            keys.append(key)
            held += sizes[key]
        return keys

    def everything(self) -> list[int | None]:
        return [None, *self.under]

    def cut(self, keys: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Takes whole subtrees out: first, rest and count of their phrases."""
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def walk(held, above: int, bits: int) -> None:
            if isinstance(held, Node):
                low = bits - ID_BITS
                for lead, under in held.under.items():
                    walk(under, above | lead << low, low)
            else:
                rests = np.fromiter(held, "i8", len(held)) | above
                parts.append((np.full(len(held), key), rests, np.fromiter(held.values(), "i8", len(held))))

        for key in keys:
            if key is None:
                parts.append(self.unpacked())
                self.entries -= len(self.shared)
                self.shared, self.room = {}, self.burst
            else:
                walk(self.under.pop(key), 0, self.bits)
                self.entries -= self.sizes.pop(key)
        return tuple(np.concatenate(x) for x in zip(*parts))


class Counter:
    """The trie of a task, with the numbers of its words and languages."""

    def __init__(self, lengths: tuple[int, ...], frequent: np.ndarray | None, of: int, most: int, burst: int):
        """frequent: the bits of the frequent phrases of ``of`` words; without it all are counted."""
        self.lengths, self.frequent, self.of, self.most = lengths, frequent, of, most
        self.longest = max(lengths)
        self.trie = Trie(burst, self.longest)
        self.words: dict[str, int] = {}
        self.hashes = np.zeros(0, "u8")
        self.langs: dict[str, int] = {}
        self.totals: dict[str, int] = {}

    def numbers(self, words: list[str]) -> np.ndarray:
        known = self.words
        before = len(known)
        out = np.array([known.setdefault(w, len(known) + 1) for w in words], "i8")
        if self.frequent is not None and len(known) > before:
            fresh = np.array([hash_of(w) for w in itertools.islice(known, before, None)], "u8")
            self.hashes = np.concatenate((self.hashes, fresh))
        return out

    def add(self, langs: list[str], texts: pa.Array) -> Iterator[pa.RecordBatch]:
        words, piece, row = split_words(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.words) + len(distinct) > ID_MASK:
            yield from self.leave(self.trie.everything())
            self.words, self.trie.heavy = {}, np.zeros(0, "i8")
            self.words, self.hashes = {}, np.zeros(0, "u8")
        numbers = self.numbers(distinct)
        ids = numbers[coded.indices.to_numpy(zero_copy_only=False)]
        lang_ids = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs], "i8")
        if 1 in self.lengths:
            names = list(self.langs)
            found, counts = np.unique(lang_ids[row], return_counts=True)
            for i, count in zip(found.tolist(), counts.tolist()):
                self.totals[names[i]] = self.totals.get(names[i], 0) + count
        first = lang_ids[row] << ID_BITS | ids
        good = None
        if self.frequent is not None and len(ids):
            good = self.good_starts(self.hashes[ids - 1], lang_ids[row], piece)
        firsts, rests = [], []
        for length in self.lengths:
            starts = self.starts(length, piece, good)
            rest = np.zeros(len(starts), "i8")
            for k in range(1, length):
                rest |= ids[starts + k] << (self.longest - 1 - k) * ID_BITS
            firsts.append(first[starts])
            rests.append(rest)
        firsts, rests = np.concatenate(firsts), np.concatenate(rests)
        if len(firsts):
            order = np.lexsort((rests, firsts))
            firsts, rests = firsts[order], rests[order]
            new = np.concatenate(([True], (firsts[1:] != firsts[:-1]) | (rests[1:] != rests[:-1])))
            cuts = np.flatnonzero(new)
            self.trie.add(firsts[cuts], rests[cuts], np.diff(np.append(cuts, len(firsts))))
        if self.trie.entries > self.most:
            yield from self.leave(self.trie.largest(self.trie.entries - self.most // 2))

    def good_starts(self, hashes: np.ndarray, lang: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Where a frequent phrase of ``of`` words starts, as far as the hashed set tells."""
        langs = np.array([hash_of(x) for x in self.langs], "u8")[lang]
        if self.of == 1:
            return is_member(self.frequent, place_of(langs, hashes))
        same = piece[1:] == piece[:-1]
        return is_member(self.frequent, place_of(langs[:-1], hashes[:-1], hashes[1:])) & same

    def starts(self, length: int, piece: np.ndarray, good: np.ndarray | None) -> np.ndarray:
        """Where phrases of a length start: within a piece, and of frequent parts only."""
        count = len(piece) - length + 1
        if count <= 0:
            return np.zeros(0, "i8")
        holds = piece[:count] == piece[length - 1 :]
        if good is not None:
            for k in range(length - self.of + 1):
                holds &= good[k : k + count]
        return np.flatnonzero(holds)

    def leave(self, keys: list[int | None]) -> Iterator[pa.RecordBatch]:
        """Subtrees as one sorted run."""
        if not keys:
            return
        first, rest, counts = self.trie.cut(keys)
        if not len(first):
            return
        ids = np.stack([first & ID_MASK, *(rest >> k * ID_BITS & ID_MASK for k in range(self.longest - 2, -1, -1))])
        used, places = np.unique(ids, return_inverse=True)
        names = np.array(["", *self.words], object)[used]
        texts = pa.array(names, pa.large_string())
        rank = np.empty(len(used), "i8")
        rank[pc.sort_indices(texts.cast(pa.large_binary())).to_numpy()] = np.arange(len(used))
        places = places.reshape(ids.shape)
        lang = first >> ID_BITS
        order = np.lexsort((*rank[places[::-1]], lang))
        lang_names = pa.array(list(self.langs), pa.string())
        for low in range(0, len(order), RUN_ROWS):
            some = order[low : low + RUN_ROWS]
            columns = [texts.take(pa.array(x[some])) for x in places]
            phrase = columns[0]
            for column, there in zip(columns[1:], ids[1:, some] > 0):
                longer = pc.binary_join_element_wise(phrase, column, pa.scalar(" ", pa.large_string()))
                phrase = pc.if_else(pa.array(there), longer, phrase)
            yield pa.RecordBatch.from_arrays(
                [lang_names.take(pa.array(lang[some])), phrase.cast(pa.string()), pa.array(counts[some])],
                ["lang", "phrase", "f"],
            )

    def end(self) -> Iterator[pa.RecordBatch]:
        yield from self.leave(self.trie.everything())
        if self.totals:
            columns = [pa.array(list(self.totals), pa.string()), pa.array([""] * len(self.totals), pa.string())]
            counts = pa.array(list(self.totals.values()), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, counts], ["lang", "phrase", "f"])


def hash_of(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word)


def place_of(lang: np.ndarray, *words: np.ndarray) -> np.ndarray:
    """A hash of the words of a phrase, given by theirs, and its language."""
    mixed = lang * np.uint64(0xC2B2AE3D27D4EB4F)
    for word in words:
        mixed = (mixed ^ word) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return mixed * np.uint64(0xD6E8FEB86659FD93)


def is_member(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the set, a power of two of bits, has a place."""
    at = place >> np.uint64(65 - (len(bits) * 8).bit_length())
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype("u1")) & 1 == 1


def count_batches(lengths, frequent, of: int, most: int, burst: int, batches: Iterator[pa.RecordBatch]):
    held = None if frequent is None else np.frombuffer(frequent.value, "u1")
    counter = Counter(lengths, held, of, most, burst)
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            yield from counter.add(part.column("lang").to_pylist(), pc.fill_null(part.column("text"), ""))
    yield from counter.end()


def place_batches(bits: int, batches: Iterator[pa.RecordBatch]):
    shift = np.uint64(65 - bits.bit_length())
    for batch in batches:
        words = [p.split(" ") for p in batch.column("phrase").to_pylist()]
        hashes = np.array([[hash_of(w) for w in p] for p in words], "u8").reshape(len(words), -1)
        lang = np.array([hash_of(x) for x in batch.column("lang").to_pylist()], "u8")
        places = (place_of(lang, *hashes.T) >> shift).astype("i8")
        yield pa.RecordBatch.from_arrays([pa.array(places)], ["place"])


def hashed_set(phrases: DataFrame, bounds: tuple[int, int] = FILTER_BITS) -> bytes:
    """Phrases of one number of words as bits; built by Spark, at most bounds[1] bits reach the driver."""
    least, most = bounds
    bits = max(least, min(most, 1 << (64 * phrases.count()).bit_length()))
    places = in_batches(phrases.select("lang", "phrase"), functools.partial(place_batches, bits), "place long")
    block = F.floor(F.col("place") / 32768).cast("long")
    maps = places.groupBy(block.alias("block")).agg(
        F.bitmap_construct_agg((F.col("place") % 32768).cast("long")).alias("map")
    )
    out = bytearray(bits // 8)
    for block, held in maps.toLocalIterator():
        out[block * 4096 : (block + 1) * 4096] = held
    return bytes(out)


def counted(
    docs: DataFrame, lengths: tuple[int, ...], frequent=None, of: int = 0, most: int = MOST_ENTRIES, burst: int = BURST
) -> DataFrame:
    """lang, phrase, f of all phrases of these lengths; with words phrase '' has their number."""
    work = functools.partial(count_batches, lengths, frequent, of, most, burst)
    runs = stored(in_batches(docs, work, RUNS), "runs")
    ranges = runs.repartitionByRange(partitions(docs.sparkSession), "lang", "phrase")
    return ranges.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(
    docs: DataFrame,
    least: int = 30,
    text_col: str = "text",
    lang_col: str = "lang",
    most: int = MOST_ENTRIES,
    burst: int = BURST,
    filter_bits: tuple[int, int] = FILTER_BITS,
) -> DataFrame:
    """lang, phrase, f of phrases of up to four words with f of at least least; phrase '' counts all words."""
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text"))
    enough = (F.col("f") >= least) | (F.col("phrase") == "")
    found = stored(counted(given, (1,), None, 0, most, burst).filter(enough), "phrases-1", narrow=True)
    every = found
    for of, lengths in ((1, (2,)), (2, (3, 4))):
        bits = hashed_set(found.filter(F.col("phrase") != ""), filter_bits)
        frequent = spark.sparkContext.broadcast(bits)
        found = stored(counted(given, lengths, frequent, of, most, burst).filter(enough), f"phrases-{of + 1}", narrow=True)
        frequent.unpersist()
        every = every.unionByName(found)
    return every


def exact(column: Column) -> Column:
    return column.cast("decimal(25,0)")


def collocations(docs: DataFrame, first: int = 2000, least: int = 30, **options) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each language by score."""
    return scored(stored(frequent_phrases(docs, least, **options), "phrases", narrow=True), first)


def scored(counts: DataFrame, first: int) -> DataFrame:
    """The first phrases of each language, from lang, phrase, f of frequent ones.

    The score of a phrase is that of its weakest cut into two: the share of its count a in l
    + r, the counts of its parts.  Phrases inside a longer one with at least 80% of their
    count are left out.
    """
    words = F.split("phrase", " ")
    several = counts.filter(F.instr("phrase", " ") > 0).withColumn("words", words).withColumnRenamed("f", "a")

    def part(start: Column, size: Column) -> Column:
        return F.array_join(F.slice("words", start, size), " ")

    size = F.size("words")
    cut = F.col("cut")
    cuts = several.withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang", "phrase", "a", "cut",
        part(F.lit(1), cut).alias("left"),
        part(cut + 1, size - cut).alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        other = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = cuts.join(other, ["lang", side])
    score = F.expr("(2000000 * CAST(a AS DECIMAL(25,0))) DIV (CAST(l AS DECIMAL(25,0)) + CAST(r AS DECIMAL(25,0)))")
    weakest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("weakest")
    scored = cuts.groupBy("lang", "phrase", "a").agg(weakest).select("lang", "phrase", "a", "weakest.*")
    # A phrase that a longer one holds is also held by one of one word more, as frequent at least.
    inner = F.explode(F.array(part(F.lit(1), size - 1), part(F.lit(2), size - 1)))
    longer = several.filter(size > 2).select("lang", inner.alias("phrase"), F.col("a").alias("outer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    held = F.coalesce(100 * exact(F.col("outer")) >= 80 * exact(F.col("a")), F.lit(False))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(~held)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(GROUPS))
    some = Window.partitionBy("lang", "group").orderBy(*order)
    kept = kept.withColumn("group", group).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= first)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    totals = counts.filter(F.col("phrase") == "").select("lang", F.col("f").alias("n"))
    return (
        kept.filter(F.col("rank") <= first)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
