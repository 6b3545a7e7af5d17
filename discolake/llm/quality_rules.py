"""Quality classifier: rules from tree paths, weighted by lasso, run as column expressions.

1. Every whole text is measured once: shares of character classes, repetition of words, lengths.
2. On a bounded sample of labelled rows, numpy grows small trees on random parts of
   rows and measures.  Each path from a root is a conjunctive rule.
3. A logistic model with an L1 penalty weighs the rules; most weights become zero.
4. The rules left are compiled into one Spark column expression over the measures.

Null and empty texts measure 0 everywhere and get the score the rules give that.  Rows with one
id are scored one by one; a label for one id that occurs twice counts twice.  Null labels
are left out.  Without labelled rows every score is 0.5.  An empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from discolake.llm.batches import slices
from discolake.llm.tables import held_out, in_batches, stored

#: The classifier is fitted on about so many labelled rows at most, those with the least hashes.
TRAIN_ROWS = 20_000
TREES = 40
DEPTH = 3
BINS = 32
MAX_RULES = 250
PENALTY = 0.002
STEPS = 400
THRESHOLD = 0.3

#: Classes of bytes whose share of the text is measured.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "blank": b" \t",
    "line": b"\n\r",
    "stop": b".,;:",
    "shout": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@\\^_`~",
    "bracket": b"()[]{}\"'",
}
MEASURES = [
    *CLASSES,
    "words",
    "word_bytes",
    "repeated",
    "distinct",
    "ends_odd",
    "stop_words",
]


#: Their names as columns beside those of the documents.
COLUMNS = [f"__{m}" for m in MEASURES]


def measure(texts: pa.Array) -> np.ndarray:
    """One row of MEASURES for each text, each a number that does not grow with the text but words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    ends = lists.offsets.to_numpy().astype("i8")
    flat = lists.flatten()
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype("i8")
    known = coded.dictionary.to_pylist()
    empty = np.array([w == "" for w in known] or [True])[codes] if len(codes) else np.zeros(0, bool)
    odd = np.array([bool(w) and w[-1] in "!?#$%&*|" for w in known] or [False])
    stop = np.array([bool(w) and w[-1] in ".,;:" for w in known] or [False])
    owner = np.repeat(np.arange(len(texts)), np.diff(ends))
    owner, codes = owner[~empty], codes[~empty]
    rows = len(texts)

    def per_row(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, rows)

    words = np.bincount(owner, minlength=rows).astype("f8")
    divisor = np.maximum(words, 1)
    same = np.zeros(len(codes))
    same[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    pairs = np.unique(owner * (len(known) + 1) + codes)
    distinct = np.bincount(pairs // (len(known) + 1), minlength=rows)

    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype("i8")
    blob = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()), "u1")
    cuts = np.concatenate(([0], np.cumsum(sizes)))
    columns = []
    for chars in CLASSES.values():
        member = np.zeros(256, "u1")
        member[list(chars)] = 1
        at = np.flatnonzero(member[blob])
        columns.append(np.diff(np.searchsorted(at, cuts)) / np.maximum(sizes, 1))
    columns += [
        np.log1p(words),
        sizes / divisor,
        per_row(same) / divisor,
        distinct / divisor,
        per_row(odd[codes].astype("f8")) / divisor,
        per_row(stop[codes].astype("f8")) / divisor,
    ]
    return np.stack(columns, 1)


def measure_batches(kept: tuple[str, ...], batches: Iterator[pa.RecordBatch]):
    """Adds the measures of column __text to the columns that are kept."""
    for batch in batches:
        for part in slices(batch, "__text"):
            found = measure(pc.fill_null(part.column("__text"), ""))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), *(pa.array(c) for c in found.T)],
                [*kept, *COLUMNS],
            )


def measured(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns to keep (all without keep), and the measures of the text."""
    kept = docs.columns if keep is None else keep
    given = docs.select(*kept, F.col(text_col).alias("__text"))
    schema = StructType([given.schema[c] for c in kept])
    for name in COLUMNS:
        schema = schema.add(name, "double")
    return in_batches(given, functools.partial(measure_batches, tuple(kept)), schema)


@dataclass(frozen=True)
class Rule:
    """All of (measure, above, cut): the measure is above the cut, or it is not."""

    parts: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for column, above, cut in self.parts:
            out &= (x[:, column] > cut) == above
        return out

    def column(self, names: list[str]) -> Column:
        out = F.lit(True)
        for i, above, cut in self.parts:
            out = out & ((F.col(names[i]) > cut) if above else (F.col(names[i]) <= cut))
        return out


def grow(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> set[Rule]:
    """The paths of one tree, split to lower the Gini impurity."""
    rules: set[Rule] = set()

    def split(rows: np.ndarray, path: tuple) -> None:
        if path:
            rules.add(Rule(tuple(sorted(path))))
        if len(path) == DEPTH or len(rows) < 10 or y[rows].min() == y[rows].max():
            return
        best = (0.0, 0, 0.0)
        base = len(rows) * y[rows].mean() * (1 - y[rows].mean())
        for c in rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False).tolist():
            values = x[rows, c]
            for cut in np.unique(np.quantile(values, np.linspace(0, 1, BINS)[1:-1])).tolist():
                over = values > cut
                n = int(over.sum())
                if 0 < n < len(rows):
                    p, q = y[rows[over]].mean(), y[rows[~over]].mean()
                    gain = base - n * p * (1 - p) - (len(rows) - n) * q * (1 - q)
                    best = max(best, (gain, c, cut))
        if best[0] > 1e-9:
            _, c, cut = best
            over = x[rows, c] > cut
            split(rows[over], (*path, (c, True, round(cut, 6))))
            split(rows[~over], (*path, (c, False, round(cut, 6))))

    split(np.arange(len(x)), ())
    return rules


@dataclass(frozen=True)
class RuleModel:
    bias: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self, names: list[str] = COLUMNS) -> Column:
        total = F.lit(self.bias)
        for rule, weight in self.weights:
            total = total + F.when(rule.column(names), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def lasso(z: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic weights with an L1 penalty by accelerated proximal gradient; the bias is free."""
    rows, columns = z.shape
    center = z.mean(0)
    spread = np.maximum(z.std(0), 1e-3)
    u = (z - center) / spread
    rate = 4.0 / max(1.0, np.linalg.norm(u, 2) ** 2 / rows + 1)
    w, bias, momentum = np.zeros(columns), np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)), 1.0
    v, c = w.copy(), bias
    for _ in range(STEPS):
        off = 1 / (1 + np.exp(-(u @ v + c))) - y
        step = v - rate * (u.T @ off) / rows
        new = np.sign(step) * np.maximum(np.abs(step) - rate * PENALTY, 0)
        new_bias = c - rate * off.mean()
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        v, c = new + (momentum - 1) / after * (new - w), new_bias + (momentum - 1) / after * (new_bias - bias)
        w, bias, momentum = new, new_bias, after
    return float(bias - (w * center / spread).sum()), w / spread


def fit(x: np.ndarray, y: np.ndarray, seed: int = 5) -> RuleModel:
    if not len(x):
        return RuleModel(0.0, ())
    if y.min() == y.max():
        return RuleModel(4.0 if y[0] else -4.0, ())
    rng = np.random.default_rng(seed)
    few, many = np.flatnonzero(y == 0), np.flatnonzero(y == 1)
    rules: set[Rule] = set()
    for _ in range(TREES):
        # As many rows of either label, so that the rare one shapes the trees.
        n = max(1, min(len(few), len(many), 1000))
        rows = np.concatenate((rng.choice(few, n), rng.choice(many, n)))
        rules |= grow(x[rows], y[rows], rng)
    columns: dict[bytes, tuple[Rule, np.ndarray]] = {}
    for rule in sorted(rules, key=lambda r: (len(r.parts), r.parts)):
        holds = rule.holds(x)
        if 0 < holds.sum() < len(x):
            columns.setdefault(np.packbits(holds).tobytes(), (rule, holds))
    score = lambda h: -abs(np.corrcoef(h, y)[0, 1])
    chosen = sorted(columns.values(), key=lambda rh: (score(rh[1]), rh[0].parts))[:MAX_RULES]
    if not chosen:  # nothing tells the labels apart
        return RuleModel(float(np.log(len(many) / len(few))), ())
    bias, weights = lasso(np.stack([h for _, h in chosen], 1).astype("f8"), y.astype("f8"))
    used = [(r, round(float(w), 9)) for (r, _), w in zip(chosen, weights, strict=True) if w]
    return RuleModel(bias, tuple(used))


def chosen(ids: DataFrame, id_col: str) -> Column:
    """True for the rows with the least hashes, about TRAIN_ROWS of ids; tells them apart by id alone."""
    share = min(1.0, TRAIN_ROWS / max(1, ids.count()))
    return F.xxhash64(F.col(id_col), F.lit(11)) <= F.lit(min(2**63 - 1, round((2 * share - 1) * 2**63)))


def train(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> RuleModel:
    """rows: ids and measures.  Rows whose id is held out are never learned from.

    At most two rows for each chosen id reach the driver: its least measures with either label.
    """
    given = labels.select(F.col("doc_id").alias("__labelled"), F.col(label).cast("int").alias("__label"))
    given = given.filter(F.col("__label").isin(0, 1) & ~held_out(F.col("__labelled")))
    some = given.filter(chosen(given, "__labelled")).distinct()
    own = rows.join(some.select("__labelled").distinct(), F.col(id_col) == F.col("__labelled"), "left_semi")
    one = own.groupBy(id_col).agg(F.min(F.struct(*COLUMNS)).alias("__least"))
    learn = one.join(some, F.col(id_col) == F.col("__labelled")).select("__label", "__least.*")
    table = np.array(learn.collect(), "f8").reshape(-1, len(MEASURES) + 1)
    table = table[np.lexsort(table.T)]  # the order that rows arrive in does not matter
    return fit(table[:, 1:], table[:, 0])


def classify(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row for each row of docs: id, held_out, score, predicted."""
    rows = stored(measured(docs, text_col, [id_col]), "quality-measures", narrow=True)
    score = train(rows, labels, id_col).score()
    return rows.select(
        id_col,
        held_out(F.col(id_col)).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of docs that the classifier, fitted on their labelled ones, does not reject."""
    given = labels.filter("quality IN (0, 1)").select(F.col("doc_id").alias("__labelled"))
    given = given.filter(~held_out(F.col("__labelled")))
    # About TRAIN_ROWS ids.
    some = F.broadcast(given.filter(chosen(given, "__labelled")).distinct())
    sample = docs.join(some, F.col(id_col) == F.col("__labelled"), "left_semi")
    model = train(measured(sample, text_col, [id_col]), labels, id_col)
    return measured(docs, text_col).filter(model.score() >= THRESHOLD).select(*docs.columns)
