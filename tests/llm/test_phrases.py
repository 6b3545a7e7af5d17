"""Phrases of a burst trie against plain counts."""

import random
import re
import string
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from discolake.llm import phrases

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_counts(rows, longest=4):
    f = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            f[lang, ()] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return f


def expected(rows, first, least):
    f = plain_counts(rows)
    several = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    held = set()
    for (lang, w), a in several.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                part = (lang, w[i : i + k])
                if 100 * a >= 80 * several[part]:
                    held.add(part)
    found = defaultdict(list)
    for (lang, w), a in several.items():
        if (lang, w) in held:
            continue
        score, _, l, r = min(
            (2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
            for k in range(1, len(w))
        )
        found[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return sorted(
        (lang, i, phrase.decode(), -a, l, r, f[lang, ()], -score)
        for lang, some in found.items()
        for i, (score, a, phrase, l, r) in enumerate(sorted(some)[:first], 1)
    )


def random_rows(count, seed=3):
    draw = random.Random(seed)
    common = "the of and a in New York los angeles É\x1c x\xa0y 日本 very Hot pair".split(" ")
    rows = []
    for _ in range(count):
        words = []
        for _ in range(draw.randint(0, 40)):
            pick = draw.random()
            if pick < 0.15:
                words.append("Very hot\tpair")
            elif pick < 0.3:
                words.append("new york city marathon")
            elif pick < 0.4:
                words.append(f"w{draw.randint(0, 400)}")
            else:
                words.append(draw.choice(common))
        text = "".join(w + draw.choices([" ", "  ", ", ", "\n", ".", "!\t"], weights=[20, 2, 1, 1, 1, 1])[0] for w in words)
        rows.append((draw.choice(["en", "en", "en", "de", None]), text))
    return rows


def found(frame, first=2000, least=30, **options):
    return sorted(map(tuple, phrases.collocations(frame, first, least, **options).collect()))


def test_collocations_equal_plain_counts(spark):
    rows = [*random_rows(600), ("en", None), ("en", ""), (None, " \t\n."), ("fr", "seul"), ("und", "new york city")]
    rows += rows[:40]
    rows.append(("de", "long tale of a long tale. " * 20_000))
    frame = spark.createDataFrame(rows, "lang string, text string")
    for name in ("phrase", "f", "a", "rank", "words", "doc_id", "group"):
        frame = frame.withColumn(name, F.lit("clash"))
    want = expected(rows, 2000, 30)
    assert len(want) > 100 and any(w[0] == "und" for w in want)
    assert found(frame.repartition(7)) == want
    assert found(frame, first=5) == expected(rows, 5, 30)
    assert found(frame.limit(0)) == []


def test_small_tries_and_full_filters_change_nothing(spark):
    """Containers that burst, subtrees that leave early, and a set of pairs that lets all through."""
    rows = random_rows(400, seed=4)
    frame = spark.createDataFrame(rows, "lang string, text string")
    want = expected(rows, 2000, 10)
    for most, burst in ((50, 4), (3000, 16)):
        options = {"most": most, "burst": burst, "filter_bits": (1 << 15, 1 << 15)}
        assert found(frame, least=10, **options) == want


def test_runs_are_sorted_and_whole(spark):
    rows = random_rows(200, seed=5)
    langs = [lang or "und" for lang, _ in rows]
    counter = phrases.Counter((1, 2, 3, 4), None, 0, most=2000, burst=8)
    batches = []
    for low in range(0, len(rows), 20):
        texts = pa.array([t for _, t in rows[low : low + 20]])
        runs = list(counter.add(langs[low : low + 20], texts))
        batches += runs
        for run in runs:
            keys = [(r["lang"], [w.encode() for w in r["phrase"].split(" ")]) for r in run.to_pylist()]
            order = [list(counter.langs).index(lang) for lang, _ in keys]
            assert [(o, w) for o, (_, w) in zip(order, keys)] == sorted((o, w) for o, (_, w) in zip(order, keys))
            assert len(set(map(str, keys))) == len(keys)
    assert len(batches) > 3 and counter.trie.entries <= 2000
    total = Counter()
    for batch in [*batches, *counter.end()]:
        for r in batch.to_pylist():
            total[r["lang"], tuple(r["phrase"].split(" ")) if r["phrase"] else ()] += r["f"]
    assert total == Counter({p: n for p, n in plain_counts(rows).items() if n})


def test_scores_are_exact_beyond_64_bits(spark):
    huge = 2**61
    counts = [("en", "", huge), ("en", "a", huge - 1), ("en", "b", huge - 3), ("en", "a b", huge - 5)]
    frame = spark.createDataFrame(counts, "lang string, phrase string, f long")
    row = phrases.scored(frame, 10).first()
    assert row.score == 2_000_000 * (huge - 5) // (2 * huge - 4)
