"""Token ids in files of independent zstandard frames, one frame for each document.

A file holds the frames of its documents, then a skippable frame with their ids
and, last, the seek table of the zstandard seekable format: sizes and a checksum
for each frame.  A reader finds a document in the tables at the end and decompresses
its frame only.

A task names each file anew and reports it in a row; only rows of committed
tasks reach the manifest, so files of lost or repeated tasks are never read.

A null text counts as empty and gives the end id alone.  Null document ids come
first and stay null.  Rows with one id keep a frame each.  An empty table gives an
empty manifest.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from discolake.llm.batches import PieceIds, slices, word_pieces
from discolake.llm.tables import in_batches, partitions, range_of, splitters, stored
from discolake.session import new_folder

# Fixed values of the zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
#: The magic number of the skippable frame with the document ids.
INDEX_MAGIC = 0x184D2A50
LEVEL = 3
#: Documents that a reading task holds at once.
READ_ROWS = 2_000

#: Bytes of text worked on at once; in larger slices more words are equal.
SLICE = 8 << 20
#: Words of a generation that a worker remembers.
REMEMBERED = 400_000
#: Words that are encoded as one text.
GROUP = 50
WHITE = " \t\n\v\f\r"
#: Letters below this one are the same in every normal form, but for the dotted capital I.
LATIN_END, DOTTED = "\u0250", "\u0130"

# The form of tokenizer whose words can be encoded apart, as its file states it.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
PRE_TOKENIZERS = [
    {
        "type": "Split",
        "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]

ENCODED = "doc_id long, n_tokens long, frame binary, raw_bytes long, checksum long"
MANIFEST = "shard int, path string, n_docs long, n_tokens long"
DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
TOKENS = "doc_id long, start long, n_tokens long, ids array<int>"


class WordEncoder:
    """Encodes words apart where the tokenizer never joins them, whole texts otherwise.

    That it does not is known of the form above: it ignores case, drops white space
    and parts letters from signs.  Words of plain letters are one pre-token each: they are
    encoded many at a time, and the tokens that end a word tell them apart.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        form = json.loads(self.tokenizer.to_str())
        self.apart = (
            (form["normalizer"] or {}).get("normalizers") == NORMALIZERS
            and (form["pre_tokenizer"] or {}).get("pretokenizers") == PRE_TOKENIZERS
            and all(t["special"] and "<|" in t["content"] for t in form["added_tokens"])
        )
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.suffixed = bool(suffix)
        self.pieces = PieceIds(self.encode, self.width, REMEMBERED)

    def packed(self, ids) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def one_by_one(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [self.packed(x.ids) for x in found]

    def together(self, words: list[str]) -> list[bytes]:
        rows = [" ".join(words[i : i + GROUP]) for i in range(0, len(words), GROUP)]
        found = self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)
        ids = np.array([i for x in found for i in x.ids], f"<u{self.width}")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            return self.one_by_one(words)
        raw, cuts = ids.tobytes(), [0, *(stops * self.width).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts side by side, and where each ends (0 first)."""
        if not self.apart:
            found = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            ends = np.cumsum([0, *(len(x.ids) for x in found)])
            return np.array([i for x in found for i in x.ids], f"<u{self.width}"), ends
        special = pc.match_substring(texts, "<|")
        # Without regard to case more words are equal; special tokens do have it.
        lower = pc.if_else(special, texts, pc.ascii_lower(texts))
        if pc.any(special).as_py():
            lists = pc.ascii_split_whitespace(lower)
            ends = lists.offsets.to_numpy()
            return self.pieces.joined(lists.flatten(), ends - ends[0])
        return self.pieces.joined(*word_pieces(lower))

    def encode(self, words: list[str]) -> list[bytes]:
        words = [w.strip(WHITE) for w in words]
        known: dict[str, bytes] = dict.fromkeys(words, b"")
        plain = list(filter(is_plain, known)) if self.suffixed else []
        known.update(zip(plain, self.together(plain), strict=True))
        rest = [w for w, ids in known.items() if not ids]
        known.update(zip(rest, self.one_by_one(rest), strict=True))
        return [known[w] for w in words]


def is_plain(word: str) -> bool:
    """Only letters, which are the same in every normal form."""
    return word.isalpha() and (word.isascii() or (max(word) < LATIN_END and DOTTED not in word))


@functools.cache
def encoder(tokenizer_path: str) -> WordEncoder:
    return WordEncoder(tokenizer_path)


def encode_batches(tokenizer_path: str, end_id: int, batches: Iterator[pa.RecordBatch]):
    words = encoder(tokenizer_path)
    end = np.array([end_id], f"<u{words.width}").tobytes()
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            ids, stops = words.texts(pc.fill_null(part.column("text"), ""))
            rows = []
            for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True):
                raw = ids[a:b].tobytes() + end
                rows.append((b - a + 1, squeeze.compress(raw), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            counts, frames, sizes, sums = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(frames, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "n_tokens", "frame", "raw_bytes", "checksum"],
            )


class ShardFile:
    """One file while it is written."""

    def __init__(self, folder: str, shard: int, width: int):
        files, place = fs.FileSystem.from_uri(folder)
        files.create_dir(place, recursive=True)
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}.zst"
        self.path, self.shard, self.width = f"{folder}/{name}", shard, width
        self.out = files.open_output_stream(f"{place}/{name}", compression=None)
        self.entries: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.tokens = 0

    def add(self, doc_id: int | None, n_tokens: int, frame: bytes, raw: int, checksum: int) -> None:
        self.out.write(frame)
        self.entries.append((len(frame), raw, checksum))
        self.ids.append(doc_id)
        self.tokens += n_tokens

    def close(self) -> tuple[int, str, int, int]:
        known = bytes(x is not None for x in self.ids)
        index = struct.pack("<B", self.width) + known + np.array([x or 0 for x in self.ids], "<i8").tobytes()
        table = b"".join(struct.pack("<III", *x) for x in self.entries)
        table += struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        return self.shard, self.path, len(self.ids), self.tokens


def write_batches(folder: str, width: int, batches: Iterator[pa.RecordBatch]):
    """Rows come sorted by shard and id."""
    done, file = [], None
    for batch in batches:
        columns = ("shard", "doc_id", "n_tokens", "frame", "raw_bytes", "checksum")
        for shard, *row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if file is None or file.shard != shard:
                if file:
                    done.append(file.close())
                file = ShardFile(folder, shard, width)
            file.add(*row)
    if file:
        done.append(file.close())
    if done:
        names = ["shard", "path", "n_docs", "n_tokens"]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)], names
        )


def write_token_files(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    folder: str | None = None,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Encode the texts and write them in ascending id order; returns the manifest of files.

    The manifest has shard, path, n_docs, n_tokens and start, the number of ids before
    the shard.  Shards are ranges of ids; each is one file.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-frames")
    width = 2 if _vocabulary(tokenizer_path) <= 1 << 16 else 4
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shards = partitions(spark)
    cuts = splitters(given, F.col("doc_id"), shards)
    encoded = in_batches(given, functools.partial(encode_batches, tokenizer_path, end_id), ENCODED)
    sorted_rows = (
        encoded.withColumn("shard", range_of(F.col("doc_id"), cuts))
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "checksum")
    )
    files = in_batches(sorted_rows, functools.partial(write_batches, folder, width), MANIFEST)
    # One row for each file: few enough for a window without a partition.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    return stored(files, "token-manifest", narrow=True).withColumn("start", start)


@functools.cache
def _vocabulary(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path).get_vocab_size()


class TokenFile:
    """Random access to the documents of one file."""

    def __init__(self, path: str):
        files, place = fs.FileSystem.from_uri(path)
        self.file = files.open_input_file(place)
        size = self.file.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"{path}: no seek table with checksums at the end")
        table = size - 9 - 12 * count - 8
        self.entries = np.frombuffer(self._at(table + 8, 12 * count), "<u4").reshape(-1, 3)
        self.starts = np.concatenate(([0], np.cumsum(self.entries[:, 0], dtype="i8")))
        index = self._at(int(self.starts[-1]) + 8, 1 + 9 * count)
        self.width = index[0]
        known = np.frombuffer(index, "u1", count, 1)
        ids = np.frombuffer(index, "<i8", count, 1 + count)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.open = zstandard.ZstdDecompressor()

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def ids(self, row: int) -> np.ndarray:
        packed, raw, checksum = self.entries[row].tolist()
        content = self.open.decompress(self._at(int(self.starts[row]), packed), max_output_size=raw)
        if len(content) != raw or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {row} is damaged")
        return np.frombuffer(content, f"<u{self.width}").astype("<u4")


def read_batches(digests: bool, batches: Iterator[pa.RecordBatch]):
    last = "ids_crc32" if digests else "ids"
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            file = TokenFile(path)
            for low in range(0, len(file.doc_ids), READ_ROWS):
                rows = []
                for row in range(low, min(low + READ_ROWS, len(file.doc_ids))):
                    ids = file.ids(row)
                    value = zlib.crc32(ids.tobytes()) if digests else ids.view("<i4")
                    rows.append((file.doc_ids[row], start, len(ids), value))
                    start += len(ids)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64() if digests else pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["doc_id", "start", "n_tokens", last],
                )


def read_token_files(manifest: DataFrame, digests: bool = False) -> DataFrame:
    """All documents of the files: doc_id, start, n_tokens and ids, or ids_crc32 of them."""
    parts = manifest.select("path", "start").repartition(partitions(manifest.sparkSession), "path")
    return in_batches(parts, functools.partial(read_batches, digests), DIGESTS if digests else TOKENS)
