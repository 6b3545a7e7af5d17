"""Byte-level BPE that proposes tokens greedily, checks them, and merges only where that fails.

Every distinct word gets the longest vocabulary entries from the left.  The proposal
is the true encoding when each entry encodes to itself and no two neighbours
would have been merged across their border at any point of the merging.  All
neighbouring pairs of a batch are checked at once.  Words that fail are merged exactly.

Nulls count as empty texts, which have no tokens and decode to ''.  Empty tables
give no rows; repeated rows and ids are encoded one by one.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.llm.batches import PieceIds, slices, taken, word_pieces
from discolake.llm.tables import in_batches

# The white space of Unicode, and the pattern that parts words of this
# kind of vocabulary before merging.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Runs without white space, with the one blank before them, and runs of white space:
#: words never reach over the border of two runs.
RUN = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Characters that stand for themselves in the vocabulary file; other bytes follow from 256 on.
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Runs of a generation that a worker remembers, and a third of the words of one.
REMEMBERED = 100_000
#: Bytes of a word up to which all its ranks are looked through for each merge.
SHORT = 100
NEVER = np.iinfo("i8").max
PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
TOKENS = "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string"


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            given = json.load(file)
        others = (b for b in range(256) if b not in set(PLAIN))
        byte_of = {chr(b): b for b in PLAIN} | {chr(256 + i): b for i, b in enumerate(others)}
        vocabulary = given["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self.id_of = {
            bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if t not in self.special
        }
        self.size = 1 + max([*vocabulary.values(), *self.special.values()])
        self.bytes_of = [b""] * self.size
        for word, i in self.id_of.items():
            self.bytes_of[i] = word
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.bytes = pa.array(self.bytes_of, pa.large_binary())
        # The length of the longest entry by its first three bytes.
        self.reach: dict[bytes, int] = {}
        for word in self.id_of:
            self.reach[word[:3]] = max(len(word), self.reach.get(word[:3], 2))
        self.single = [self.id_of.get(bytes([b]), -1) for b in range(256)]
        # How each token is made: by the merge of this rank, from these two.
        self.rank = np.full(self.size, -1)
        self.left, self.right = np.zeros((2, self.size), "i8")
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(given["model"]["merges"]):
            a, b = (vocabulary[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            self.merge[a, b] = (rank, made)
            self.made.append(made)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = rank, a, b
        keys = np.array([a * self.size + b for a, b in self.merge], "i8")
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merge.values()], "i8")[order]
        self.words = PieceIds(self.pack_words, 4, 3 * REMEMBERED)
        self.own = np.full(self.size, -1, "i1")
        split = [regex.escape(x) for x in self.special]
        self.special_pattern = regex.compile(f"({'|'.join(split)})") if split else None

    def rank_of_pairs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        keys = x * self.size + y
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def part_ways(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: true if their texts side by side encode to just them.

        Undoes the merges inside both tokens from the last to the first and looks, at
        each point, whether the two that then met at the border had a merge that
        came before the ones that used them up.
        """
        good = np.ones(len(a), bool)
        rows = np.arange(len(a))
        x, y = a.astype("i8"), b.astype("i8")
        x_used, y_used = np.full((2, len(a)), NEVER)
        while len(rows):
            rank = self.rank_of_pairs(x, y)
            # Of equal merges the left one comes first: the one at the border comes
            # after those inside the left token and before those inside the right one.
            crossed = (rank < x_used) & (rank <= y_used) & (rank != NEVER)
            good[rows[crossed]] = False
            rx, ry = self.rank[x], self.rank[y]
            go_on = ~crossed & ((rx >= 0) | (ry >= 0))
            rows, x, y, x_used, y_used, rx, ry = (
                v[go_on] for v in (rows, x, y, x_used, y_used, rx, ry)
            )
            undo_x = rx > ry
            x, x_used = np.where(undo_x, self.right[x], x), np.where(undo_x, rx, x_used)
            y, y_used = np.where(undo_x, y, self.left[y]), np.where(undo_x, y_used, ry)
        return good

    def merged(self, word: bytes) -> list[int]:
        """The exact encoding: always the merge of lowest rank, the leftmost of equals."""
        ids = [self.single[b] for b in word]
        if len(ids) <= SHORT:
            return self.merged_short(ids)
        after = [*range(1, len(ids)), -1]
        before = list(range(-1, len(ids) - 1))
        heap = [(*m, i) for i, p in enumerate(zip(ids, ids[1:])) if (m := self.merge.get(p))]
        heap = [(rank, i, made) for rank, made, i in heap]
        heapq.heapify(heap)
        while heap:
            rank, i, _ = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or (m := self.merge.get((ids[i], ids[j]))) is None or m[0] != rank:
                continue
            ids[i], ids[j], after[i] = m[1], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0 and (m := self.merge.get((ids[k], ids[after[k]]))):
                    heapq.heappush(heap, (m[0], k, m[1]))
        return [i for i in ids if i >= 0]

    def merged_short(self, ids: list[int]) -> list[int]:
        """The same for few bytes: looks through all ranks for the lowest each time."""
        get, none = self.merge.get, (NEVER, -1)
        ranks = [get(p, none)[0] for p in zip(ids, ids[1:])]
        while ranks:
            rank = min(ranks)
            if rank == NEVER:
                break
            i = ranks.index(rank)
            ids[i : i + 2] = [self.made[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)[0]
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)[0]
        return ids

    def proposed(self, word: bytes) -> list[int]:
        """The longest vocabulary entry at each place, from the left."""
        out, at, end, known, reach = [], 0, len(word), self.id_of, self.reach
        while at < end:
            stop = min(end, at + reach.get(word[at : at + 3], 2))
            while (i := known.get(word[at:stop])) is None:
                stop -= 1
            out.append(i)
            at = stop
        return out

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        found = [self.proposed(w) for w in words]
        lengths = np.fromiter(map(len, found), "i8", len(found))
        flat = np.fromiter((i for x in found for i in x), "i8", int(lengths.sum()))
        for i in np.unique(flat[self.own[flat] < 0]).tolist():
            self.own[i] = self.merged(self.bytes_of[i]) == [i]
        owner = np.repeat(np.arange(len(found)), lengths)
        bad = np.zeros(len(found), bool)
        bad[owner[self.own[flat] == 0]] = True
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.part_ways(pairs // self.size, pairs % self.size)[back]
        bad[owner[inner[~good]]] = True
        for w in np.flatnonzero(bad).tolist():
            found[w] = self.merged(words[w])
        return found

    def pack_words(self, words: list[str]) -> list[bytes]:
        found = self.encode_words([w.encode() for w in words])
        return [PACK[len(x)](*x) if len(x) < len(PACK) else np.array(x, "<u4").tobytes() for x in found]

    def encode_runs(self, runs: list[str]) -> list[bytes]:
        """Ids of runs of text, as little-endian 32-bit integers."""
        parts = [WORD.findall(r) for r in runs]
        words = list(dict.fromkeys(w for p in parts for w in p))
        ids = dict(zip(words, self.words.each(words), strict=True))
        return [ids[p[0]] if len(p) == 1 else b"".join([ids[w] for w in p]) for p in parts]

    def runs(self, text: str) -> list[str]:
        """The runs of a text; special tokens stay whole and part the text."""
        if self.special_pattern is None or not any(s in text for s in self.special):
            return RUN.findall(text)
        out: list[str] = []
        for i, piece in enumerate(self.special_pattern.split(text)):
            out += [piece] if i % 2 else RUN.findall(piece)
        return out

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        special = [p for p in pieces if p in self.special]
        plain = [p for p in pieces if p not in self.special]
        ids = dict(zip(plain, self.encode_runs(plain), strict=True))
        ids |= {p: np.array([self.special[p]], "<u4").tobytes() for p in special}
        return [ids[p] for p in pieces]

    def has_special(self, texts: pa.Array) -> bool:
        return any(pc.any(pc.match_substring(texts, x)).as_py() for x in self.special)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def readable(raw: memoryview) -> bytes | memoryview:
    """The UTF-8 of decoded bytes: the same where they are UTF-8 already."""
    try:
        str(raw, "utf-8")
    except UnicodeDecodeError:
        return str(raw, "utf-8", "replace").encode()
    return raw


@functools.cache
def loaded(path: str) -> tuple[Bpe, PieceIds]:
    bpe = Bpe(path)
    return bpe, PieceIds(bpe.encode_pieces, 4, REMEMBERED)


def encode_batches(path: str, digests: bool, batches: Iterator[pa.RecordBatch]):
    bpe, pieces = loaded(path)
    for batch in batches:
        for part in slices(batch, "text"):
            texts = pc.fill_null(part.column("text"), "")
            if bpe.has_special(texts):
                runs, ends = [], [0]
                for text in texts.to_pylist():
                    runs += bpe.runs(text)
                    ends.append(len(runs))
                runs, ends = pa.array(runs, pa.large_string()), np.array(ends)
            else:
                runs, ends = word_pieces(texts)
            ids, stops = pieces.joined(runs, ends)
            decoded, byte_ends = taken(bpe.bytes, ids)
            raw, cuts = memoryview(decoded), byte_ends[stops].tolist()
            texts_sha = [hashlib.sha256(readable(raw[a:b])).hexdigest() for a, b in zip(cuts, cuts[1:])]
            if digests:
                own, cuts = memoryview(ids).cast("B"), (4 * stops).tolist()
                values = pa.array([hashlib.sha256(own[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])], pa.string())
            else:
                values = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids.view("<i4"), pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(stops), pa.int64()),
                    values,
                    pa.array(texts_sha, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256" if digests else "ids", "decoded_sha256"],
            )


def decode_batches(path: str, batches: Iterator[pa.RecordBatch]):
    bpe, _ = loaded(path)
    for batch in batches:
        texts = [None if x is None else bpe.decode(x) for x in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
        )


def encode(
    docs: DataFrame, path: str, digests: bool = False, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """doc_id, n_tokens, ids (or their ids_sha256) and decoded_sha256, the digest of the decoded text."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return in_batches(given, functools.partial(encode_batches, path, digests), DIGESTS if digests else TOKENS)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give a null text."""
    work = functools.partial(decode_batches, path)
    return in_batches(tokens.select("doc_id", "ids"), work, "doc_id long, text string")
