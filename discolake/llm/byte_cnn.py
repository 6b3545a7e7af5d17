"""Language of a text by a byte convolutional network, trained and applied in numpy.

Bytes are mapped to 64 symbols, then come filters over 2, 3 and 4 symbols, the maximum
of each filter over a window of fixed length, and a softmax layer.  A text is cut into
windows from its first byte to its last, and the windows' probabilities are averaged by
the letters they hold, so all of a text counts.

A filter over symbols is a sum of one table entry for each place.  When the network is
applied the tables of neighbouring places are added up beforehand, so a place of
the text costs one or two look-ups for each width.

Null texts and texts without a letter are 'und' with score 0.  Rows with one id are
predicted one by one.  Without labelled rows every language is 'und'.  An empty table
gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from discolake.llm.batches import slices
from discolake.llm.tables import held_out, in_batches

#: The network is trained on so many texts of a language at most, those with the least hashes,
#: and on so many windows of each.
SPARE = 1.5
TRAIN_TEXTS = 400
TRAIN_WINDOWS = 4
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SYMBOLS = 64
STEPS = 500
BATCH = 64
RATE = 0.01
#: Bytes of text whose windows are worked on at once.
SLICE = 1 << 20
UNKNOWN = "und"


def symbol_table() -> np.ndarray:
    """Letters without case, one symbol each for blanks, digits and marks, high bytes by their low bits."""
    table = np.full(256, 2, "u1")
    table[[9, 10, 11, 12, 13, 32]] = 0
    table[48:58] = 1
    for i in range(26):
        table[65 + i] = table[97 + i] = 3 + i
    table[128:192] = 29 + np.arange(64) % 32
    table[192:196], table[196:224], table[224:256] = 61, 62, 63
    return table


TABLE = symbol_table()


@dataclass
class Network:
    """tables: for each width, one table (place, symbol, filter); then softmax weights."""

    languages: list[str]
    tables: list[np.ndarray]
    biases: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def pooled(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest value of each filter in each window, and the place it has it."""
        best, places = [], []
        for table in self.tables:
            width = len(table)
            stop = symbols.shape[1] - width + 1
            total = sum(table[k][symbols[:, k : k + stop]] for k in range(width))
            place = total.argmax(1)
            best.append(np.take_along_axis(total, place[:, None, :], 1)[:, 0])
            places.append(place)
        return np.concatenate(best, 1) + self.biases, np.stack(places, 1)

    def added_up(self) -> list[list[np.ndarray]]:
        """For each width the tables of two neighbouring symbols at once."""
        out = []
        for table in self.tables:
            parts = [
                (table[k][:, None, :] + table[k + 1][None, :, :]).reshape(SYMBOLS * SYMBOLS, -1)
                for k in range(0, len(table) - 1, 2)
            ]
            if len(table) % 2:
                parts.append(np.tile(table[-1], (SYMBOLS, 1)))
            out.append([np.ascontiguousarray(p, "f4") for p in parts])
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(texts: list[bytes], labels: list[str], seed: int = 3) -> Network | None:
    """texts: windows.  Adam on their cross-entropy; pooling passes gradients to the place of the maximum."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    rows, owner = [], []
    for text, label in zip(texts, labels, strict=True):
        piece = TABLE[np.frombuffer(text[:WINDOW], "u1")]
        # Short ends occur when the network is applied, so they occur here too.
        piece = piece[: rng.integers(16, WINDOW)] if rng.random() < 0.3 else piece
        rows.append(np.pad(piece, (0, WINDOW - len(piece))))
        owner.append(languages.index(label))
    x, y = np.stack(rows), np.array(owner)
    tables = [rng.normal(0, 0.1, (w, SYMBOLS, FILTERS)) for w in WIDTHS]
    units = FILTERS * len(WIDTHS)
    net = Network(languages, tables, np.zeros(units), rng.normal(0, 0.1, (units, len(languages))), np.zeros(len(languages)))
    params = [*net.tables, net.biases, net.weights, net.offset]
    first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
    for step in range(1, STEPS + 1):
        pick = rng.integers(0, len(x), BATCH)
        symbols = x[pick]
        pooled, places = net.pooled(symbols)
        active = np.maximum(pooled, 0)
        off = softmax(active @ net.weights + net.offset)
        off[np.arange(BATCH), y[pick]] -= 1
        off /= BATCH
        back = (off @ net.weights.T) * (pooled > 0)
        grads = []
        for i, table in enumerate(net.tables):
            grad = np.zeros_like(table)
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            for k in range(len(table)):
                seen = np.take_along_axis(symbols, places[:, i] + k, 1)
                np.add.at(grad[k], (seen, np.arange(FILTERS)[None, :]), part)
            grads.append(grad)
        grads += [back.sum(0), active.T @ off, off.sum(0)]
        for p, g, a, b in zip(params, grads, first, second, strict=True):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return net


def windows_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which text each window is of, and where it starts there; each text has one at least."""
    counts = np.maximum(1, -(-sizes // WINDOW))
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = np.cumsum(counts) - counts
    return owner, (np.arange(len(owner)) - first[owner]) * WINDOW


def predict(net: Network, tables: list[list[np.ndarray]], texts: list[bytes]) -> np.ndarray:
    """Probabilities of each text: of its windows, weighted by their letters."""
    sizes = np.array([len(t) for t in texts], "i8")
    longest = max(WIDTHS)
    symbols = TABLE[np.frombuffer(b"".join(texts) + b" " * (WINDOW + longest), "u1")]
    owner, start = windows_of(sizes)
    begin = (np.cumsum(sizes) - sizes)[owner] + start
    held = np.minimum(sizes[owner] - start, WINDOW)
    x = symbols[begin[:, None] + np.arange(WINDOW)[None, :]]
    x[np.arange(WINDOW)[None, :] >= held[:, None]] = 0
    letters = (x >= 3).sum(1) + 1e-3
    pairs = x[:, :-1].astype("i4") * SYMBOLS + x[:, 1:]
    best = []
    for width, parts in zip(WIDTHS, tables, strict=True):
        stop = WINDOW - width + 1
        total = parts[0][pairs[:, :stop]]
        for k, part in enumerate(parts[1:], 1):
            # The last table of an odd width looks at the second symbol of a pair alone.
            at = 2 * k if 2 * k + 1 < width else 2 * k - 1
            total += part[pairs[:, at : at + stop]]
        best.append(total.max(1))
    active = np.maximum(np.concatenate(best, 1) + net.biases, 0)
    chances = softmax(active @ net.weights + net.offset) * letters[:, None]
    out = np.zeros((len(texts), len(net.languages)))
    np.add.at(out, owner, chances)
    return out / np.bincount(owner, letters, len(texts))[:, None]


def predict_batches(net: Network | None, batches: Iterator[pa.RecordBatch]):
    tables = net.added_up() if net else []
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            column = part.column("text")
            lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False)
            lettered = lettered.to_numpy(zero_copy_only=False)
            names, scores = [UNKNOWN] * part.num_rows, [0.0] * part.num_rows
            rows = np.flatnonzero(lettered)
            if net and len(rows):
                texts = column.take(pa.array(rows)).cast(pa.binary()).to_pylist()
                for group in pieces(texts):
                    chances = predict(net, tables, [texts[i] for i in group])
                    for i, p in zip(group, chances, strict=True):
                        names[rows[i]] = net.languages[int(p.argmax())]
                        scores[rows[i]] = float(min(1.0, p.max()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )


def pieces(texts: list[bytes], limit: int = 64 * WINDOW) -> Iterator[list[int]]:
    """Runs of texts of about limit bytes, so that the values of a step stay in the cache."""
    run, held = [], 0
    for i, text in enumerate(texts):
        if run and held + len(text) > limit:
            yield run
            run, held = [], 0
        run.append(i)
        held += len(text)
    if run:
        yield run


def learn(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", lang_col: str = "lang") -> Network | None:
    """Train on windows from anywhere in a bounded sample of each language's texts.

    Rows that are held out and rows without a language are never learned from.  The sample
    is the TRAIN_TEXTS ids of a language with the least hashes, one text of each.  A bound on the hash,
    from how many ids a language has, leaves about SPARE times as many to choose from, so
    no language is gathered and a bounded number of rows reaches the driver.
    """
    order = F.xxhash64(F.col(id_col), F.lit(23))
    known = docs.filter(F.col(lang_col).isNotNull() & ~held_out(F.col(id_col)))
    sizes = known.groupBy(F.col(lang_col).alias("__lang")).agg(F.approx_count_distinct(id_col).alias("__ids"))
    share = F.least(F.lit(1.0), F.lit(SPARE * TRAIN_TEXTS) / F.greatest("__ids", F.lit(1)))
    few = known.withColumn("__order", order).join(sizes, F.col(lang_col) == F.col("__lang"))
    few = few.filter(F.col("__order") / 2.0**63 <= 2 * share - 1)
    text = F.coalesce(F.col(text_col), F.lit(""))
    room = F.greatest(F.length(text) - WINDOW, F.lit(1))
    windows = F.transform(
        F.sequence(F.lit(1), F.lit(TRAIN_WINDOWS)),
        lambda i: F.substring(text, F.pmod(F.xxhash64(F.col(id_col), i), room) + 1, F.lit(WINDOW)),
    )
    one = few.groupBy("__lang", "__order", F.col(id_col).alias("__id")).agg(
        F.min(F.struct(F.xxhash64(text).alias("hash"), windows.alias("windows"))).alias("least")
    )
    taken: dict[str, int] = {}
    pairs = []
    for lang, _, _, drawn in sorted(one.select("__lang", "__order", F.col("__id").cast("string"), "least.windows").collect()):
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= TRAIN_TEXTS:
            pairs += [(w.encode(), lang) for w in drawn if any(c.isalpha() for c in w)]
    return train([w for w, _ in pairs], [label for _, label in pairs])


def identify(docs: DataFrame, net: Network | None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row for each row of docs: doc_id, lang_pred, score."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    work = functools.partial(predict_batches, net)
    return in_batches(given, work, "doc_id long, lang_pred string, score double")
