"""Byte-level BPE by ranks, merged with a segment tree over byte positions.

A leaf of the tree stands for the pair that starts at a byte position and holds
rank * width + position, so the root is the leftmost pair of lowest rank.  A
merge changes three leaves, those of the merged pair, of its live left neighbour and
of the position that is no longer live, and each change climbs one path to the root.
Short words of one width are merged together, one merge of each in a step, on the rows
of one array; longer words have a tree of their own.

The rank of a pair is the rank of its joined bytes, and a word that is itself in the
ranks is that one id, as in the tiktoken library.  Each distinct word is merged once
while a worker remembers it.

Nulls count as empty texts, which have no ids and decode to ''.  Texts of any length are
encoded whole.  Empty tables give no rows; repeated rows and ids are encoded one by
one; other columns do not matter.  Ids outside the ranks make decode raise.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.llm.batches import PieceIds, slices, taken, word_pieces
from discolake.llm.tables import in_batches

#: Bytes of a word up to which it is merged together with others.
TOGETHER = 64
#: Leaves of the trees that are merged together, at most about so many.
LEAVES = 1 << 20
#: Pieces of a generation that a worker remembers, and a third of the words of one.
REMEMBERED = 100_000
#: No pair; above every leaf that holds one.
NEVER = np.iinfo("i8").max
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
TOKENS = "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class SegmentBpe:
    """Ranks, the pairs that they join, and the words met so far."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.word = regex.compile(pattern)
        # Only of the known pattern is it sure that no word reaches over a cut.
        self.cut = pattern == public_tokenizers.PATTERN
        self.size = 1 + max(self.ranks.values())
        known = [b""] * self.size
        for token, rank in self.ranks.items():
            known[rank] = token
        self.bytes = pa.array(known, pa.large_binary())
        self.decimals = pa.array([b"%d," % i for i in range(self.size)], pa.large_binary())
        absent = [b for b in range(256) if bytes([b]) not in self.ranks]
        if absent:
            raise ValueError(f"{path}: bytes without a rank: {absent}")
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], "i8")
        joined = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    joined[a * self.size + b] = rank
        self.joined = joined
        keys = np.fromiter(joined, "i8", len(joined))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], NEVER)
        self.pair_ranks = np.append(np.fromiter(joined.values(), "i8", len(joined))[order], NEVER)
        self.words = PieceIds(self.pack, 4, 3 * REMEMBERED)
        self.pieces = PieceIds(self.pack_pieces, 4, REMEMBERED)

    def rank_of_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a * self.size + b
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def merge_together(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids of words of at most width bytes, a power of two: one tree a row."""
        n = len(words)
        lengths = np.fromiter(map(len, words), "i8", n)
        rows = np.arange(n)
        ids = np.full((n, width), -1, "i8")
        ids[np.arange(width) < lengths[:, None]] = self.single[np.frombuffer(b"".join(words), "u1")]
        after = np.broadcast_to(np.arange(1, width + 1), (n, width)).copy()
        before = np.broadcast_to(np.arange(-1, width - 1), (n, width)).copy()
        tree = np.full((n, 2 * width), NEVER)
        pair = (ids[:, :-1] >= 0) & (ids[:, 1:] >= 0)
        ranks = self.rank_of_pairs(ids[:, :-1][pair], ids[:, 1:][pair])
        leaves = np.full((n, width - 1), NEVER)
        leaves[pair] = ranks
        some = leaves < NEVER
        leaves[some] = leaves[some] * width + np.nonzero(some)[1]
        tree[:, width : 2 * width - 1] = leaves
        half = width // 2
        while half:
            level = tree[:, 2 * half : 4 * half]
            tree[:, half : 2 * half] = np.minimum(level[:, ::2], level[:, 1::2])
            half //= 2
        while len(rows := rows[tree[rows, 1] < NEVER]):
            rank, i = np.divmod(tree[rows, 1], width)
            j = after[rows, i]
            k = after[rows, j]  # where the next live part starts; its length or more: none
            h = before[rows, i]
            ids[rows, i], ids[rows, j], after[rows, i] = rank, -1, k
            inside = k < lengths[rows]
            before[rows[inside], k[inside]] = i[inside]
            self.put(tree, rows, j, np.full(len(rows), NEVER), width)
            fresh = np.full(len(rows), NEVER)
            fresh[inside] = self.rank_of_pairs(rank[inside], ids[rows[inside], k[inside]])
            self.put(tree, rows, i, fresh, width)
            left = h >= 0
            fresh = self.rank_of_pairs(ids[rows[left], h[left]], rank[left])
            self.put(tree, rows[left], h[left], fresh, width)
        live = ids >= 0
        ends = np.cumsum(live.sum(axis=1)) * 4
        raw = ids[live].astype("<u4").tobytes()
        return [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    @staticmethod
    def put(tree: np.ndarray, rows: np.ndarray, at: np.ndarray, ranks: np.ndarray, width: int) -> None:
        """Point updates: one leaf of each row, and the minima on its way to the root."""
        some = ranks < NEVER
        value = np.where(some, np.where(some, ranks, 0) * width + at, NEVER)
        node = at + width
        tree[rows, node] = value
        while width > 1:
            value = np.minimum(value, tree[rows, node ^ 1])
            node = node >> 1
            tree[rows, node] = value
            width >>= 1

    def merge_alone(self, word: bytes) -> bytes:
        """Ids of one word of any length, with a tree of its own."""
        n = len(word)
        width = 1 << (n - 1).bit_length()
        joined, size = self.joined, self.size
        ids = self.single[np.frombuffer(word, "u1")].tolist()
        tree = [NEVER] * (2 * width)
        for i in range(n - 1):
            rank = joined.get(ids[i] * size + ids[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(at: int, rank: int | None) -> None:
            node = at + width
            value = tree[node] = NEVER if rank is None else rank * width + at
            while node > 1:
                other = tree[node ^ 1]
                node >>= 1
                value = value if value < other else other
                if tree[node] == value:
                    return
                tree[node] = value

        while tree[1] < NEVER:
            rank, i = divmod(tree[1], width)
            j = after[i]
            k, h = after[j], before[i]
            ids[i], ids[j], after[i] = rank, -1, k
            put(j, None)
            if k < n:
                before[k] = i
                put(i, joined.get(rank * size + ids[k]))
            else:
                put(i, None)
            if h >= 0:
                put(h, joined.get(ids[h] * size + rank))
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def pack(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian 32-bit integers."""
        raw = [w.encode() for w in words]
        found: list[bytes | None] = [None] * len(raw)
        groups: dict[int, list[int]] = {}
        for i, word in enumerate(raw):
            whole = self.ranks.get(word)
            if whole is not None:
                found[i] = whole.to_bytes(4, "little")
            elif len(word) <= TOGETHER:
                groups.setdefault(1 << (len(word) - 1).bit_length(), []).append(i)
            else:
                found[i] = self.merge_alone(word)
        for width, group in groups.items():
            step = max(1, LEAVES // width)
            for start in range(0, len(group), step):
                some = group[start : start + step]
                for i, ids in zip(some, self.merge_together([raw[i] for i in some], width), strict=True):
                    found[i] = ids
        return found

    def pack_pieces(self, pieces: list[str]) -> list[bytes]:
        parts = [self.word.findall(p) for p in pieces]
        words = list(dict.fromkeys(w for p in parts for w in p))
        ids = dict(zip(words, self.words.each(words), strict=True))
        return [ids[p[0]] if len(p) == 1 else b"".join([ids[w] for w in p]) for p in parts]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts side by side, and where each text ends in them (0 first)."""
        if self.cut:
            pieces, ends = word_pieces(texts)
        else:
            pieces, ends = texts, np.arange(len(texts) + 1)
        return self.pieces.joined(pieces, ends)


@functools.cache
def loaded(path: str, pattern: str) -> SegmentBpe:
    return SegmentBpe(path, pattern)


def digests_of(blob: np.ndarray, ends: np.ndarray) -> list[str]:
    raw = memoryview(blob)
    return [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def encode_batches(path: str, pattern: str, digests: bool, batches: Iterator[pa.RecordBatch]):
    bpe = loaded(path, pattern)
    for batch in batches:
        for part in slices(batch, "text"):
            ids, stops = bpe.encode(pc.fill_null(part.column("text"), ""))
            decoded, ends = taken(bpe.bytes, ids)
            if digests:
                commas, comma_ends = taken(bpe.decimals, ids)
                cuts = comma_ends[stops]
                raw = memoryview(commas)
                # Each text's last comma is not part of its list.
                values = pa.array(
                    [
                        hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest()
                        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
                    ],
                    pa.string(),
                )
            else:
                values = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(stops), pa.int64()),
                    values,
                    pa.array(digests_of(decoded, ends[stops]), pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256" if digests else "ids", "decoded_sha256"],
            )


def decode_batches(path: str, pattern: str, batches: Iterator[pa.RecordBatch]):
    bpe = loaded(path, pattern)
    for batch in batches:
        texts = []
        for ids in batch.column("ids").to_pylist():
            if ids is None:
                texts.append(None)
                continue
            codes = np.array(ids, "i8")
            if len(codes) and not 0 <= codes.min() <= codes.max() < bpe.size:
                raise ValueError(f"ids outside the ranks: {codes.min()} to {codes.max()}")
            texts.append(taken(bpe.bytes, codes)[0].tobytes().decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
        )


def encode(
    docs: DataFrame,
    path: str,
    pattern: str = public_tokenizers.PATTERN,
    digests: bool = False,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """doc_id, n_tokens, ids (or ids_sha256 of their decimals) and decoded_sha256 of the decoded bytes."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    work = functools.partial(encode_batches, path, pattern, digests)
    return in_batches(given, work, DIGESTS if digests else TOKENS)


def decode(tokens: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give a null text."""
    work = functools.partial(decode_batches, path, pattern)
    return in_batches(tokens.select("doc_id", "ids"), work, "doc_id long, text string")
