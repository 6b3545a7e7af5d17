"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

1. Seeds: emails, addresses of hosts, payment cards and phones of strict form, found in every
   whole text.  A text is split at the matches of a kind, so the lengths of the pieces
   give the positions; running sums of them are a window over one text's matches.
2. Candidates: tokens of a looser form of each kind that overlap no seed.
3. Patterns: the words left and right of seeds and candidates.  Seeds have trust 1.  In each round a
   pattern's confidence is the share of trust in what stands in it, counted over all documents and damped by
   its support, and a candidate's score is one minus the product of the doubts of its
   patterns.
4. Candidates that reach the least score are accepted: they stay, with a trust of their score that
   fades with each round, and from the next round on count as support, so their
   contexts become patterns too.  It ends when a round accepts none, or after ROUNDS.

Only matches and their contexts are shuffled, never texts.  A common context word is a hot
key of sums that are combined before the shuffle, and of a join that adaptive execution splits.

A null text counts as empty; a text without matches has no spans and the digest of ''.
Rows that agree in id and text give the same result each; other rows with one id are kept
apart.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from discolake.llm.tables import stored

KINDS = ("email", "ip", "card", "phone")
# The strict forms.  Possessive repeats and the look-behinds only keep long
# runs from being tried again at each of their places; the matches are those of the plain forms.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Looser forms, of which contexts choose.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?<![0-9A-Za-z:.])(?:[0-9]++(?:\.[0-9]++){3,5}+|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}+)(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z.+-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![0-9A-Za-z])",
    # Groups give digits back, so that a bare run can be cut into them; they are bounded, and so is the work.
    "phone": r"(?<![0-9A-Za-z.+/-])\(?[0-9]{2,4}\)?(?:[\x20./-]?[0-9]{2,5}){2,5}(?![0-9A-Za-z])",
}
#: Characters of context that are kept on either side.
CONTEXT = 60
ROUNDS = 5
#: What is left of the trust in a score for each round; keeps long chains from drifting.
FADING = 0.97
#: Different texts with a seed or an accepted candidate that a pattern needs.
SUPPORT = 3
#: A pattern of n seeds and no other match has the confidence n / (n + DAMPING).
DAMPING = 0.25
LEAST_CONFIDENCE = 0.8
LEAST_SCORE = 0.9


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(digits))
    values = F.transform(places, lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int"))
    doubled = F.transform(values, lambda v, i: F.when(i % 2 == 1, (v * 2) % 10 + F.floor(v * 2 / 10)).otherwise(v))
    return F.aggregate(doubled, F.lit(0).cast("long"), lambda total, v: total + v) % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    digits = digits_of(match)
    count = F.length(digits)
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", F.when(count.between(16, 19), luhn(digits)).otherwise(False))
        .otherwise(count.between(8, 15))
    )


def with_context(pieces: str):
    """What is kept of a match: the text between it and the match before, and both sides."""

    def kept(match: Column, i: Column) -> Column:
        return F.struct(
            F.length(F.get(pieces, i)).alias("gap"),
            match.alias("match"),
            F.right(F.get(pieces, i), F.lit(CONTEXT)).alias("left"),
            F.left(F.get(pieces, i + 1), F.lit(CONTEXT)).alias("right"),
        )

    return kept


def scanned(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """One narrow row for each document: its id, a hash of its text, and its matches of each form."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "numeric": F.col("text").rlike("[0-9]")})
    at = F.col("text").contains("@") | F.col("text").contains("at)") | F.col("text").contains("at]")
    guards = {
        "email": at,
        "ip": F.col("numeric"),
        "card": F.col("numeric"),
        "phone": F.col("numeric"),
    }
    found, pieces, columns = {}, {}, []
    for form, patterns in (("strict", STRICT), ("loose", LOOSE)):
        for kind in KINDS:
            name, pattern, guard = f"{form}_{kind}", F.lit(patterns[kind]), guards[kind]
            found[f"{name}_found"] = F.when(guard, F.regexp_extract_all("text", pattern, F.lit(0)))
            pieces[f"{name}_pieces"] = F.when(
                F.size(f"{name}_found") > 0, F.split("text", patterns[kind], -1)
            )
            match = F.transform(f"{name}_found", with_context(f"{name}_pieces"))
            columns.append(match.alias(name))
    return rows.withColumns(found).withColumns(pieces).select("id", "tie", *columns)


def matches(rows: DataFrame, form: str) -> DataFrame:
    """id, tie, kind, start, end, match, left, right: the matches of a form with their positions."""
    parts = []
    for number, kind in enumerate(KINDS):
        part = rows.filter(F.size(f"{form}_{kind}") > 0).select(
            "id", "tie", F.lit(number).alias("number"), F.lit(kind).alias("kind"), F.posexplode(f"{form}_{kind}").alias("at", "m")
        )
        parts.append(part.select("id", "tie", "number", "kind", "at", "m.*"))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # Rows that agree in id and text have the same matches.
    every = every.dropDuplicates(["id", "tie", "number", "at"])
    so_far = Window.partitionBy("id", "tie", "number").orderBy("at")
    end = F.sum(F.col("gap") + F.length("match")).over(so_far)
    placed = every.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    return placed.select("id", "tie", "number", "kind", "start", "end", "match", "left", "right")


def contexts(found: DataFrame) -> DataFrame:
    """A row for each pattern that a match stands in: the match's key and the pattern.

    A word that the end of the context cuts is not taken for a whole one.
    """
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    cut = F.length("left") >= CONTEXT
    before = F.when(cut, F.regexp_replace("left", r"^\S+", "")).otherwise(F.col("left"))
    cut = F.length("right") >= CONTEXT
    after = F.when(cut, F.regexp_replace("right", r"\S+$", "")).otherwise(F.col("right"))
    left = F.filter(F.split(plain(before), r"\s+"), lambda w: w != "")
    right = F.filter(F.split(plain(after), r"\s+"), lambda w: w != "")
    last, two, following = F.get(left, F.size(left) - 1), F.get(left, F.size(left) - 2), F.get(right, F.lit(0))
    named = F.array(
        F.concat(F.lit("left "), last),
        F.concat(F.lit("left two "), two, F.lit(" "), last),
        F.concat(F.lit("right "), following),
        F.concat(F.lit("both "), last, F.lit(" _ "), following),
    )
    pattern = F.explode(F.filter(named, lambda p: p.isNotNull()))
    return found.select("id", "tie", "number", "kind", "start", "end", "match", "seed", pattern.alias("pattern"))


def bootstrapped(seeds: DataFrame, candidates: DataFrame) -> DataFrame:
    """The candidates that the patterns of seeds, and of what these led to, vouch for."""
    marked = seeds.withColumn("seed", F.lit(True)).unionByName(candidates.withColumn("seed", F.lit(False)))
    graph = stored(contexts(marked), "pii-graph", narrow=True)
    key = ["id", "tie", "number", "start", "end"]
    accepted = None
    for step in range(ROUNDS):
        sure = confident(graph, accepted, key)
        doubt = F.sum(F.log(1 - F.least("confidence", F.lit(0.999999))))
        scores = graph.filter("NOT seed").join(sure, ["kind", "pattern"]).groupBy(*key, "kind")
        scores = scores.agg((1 - F.exp(doubt)).alias("score")).filter(F.col("score") >= LEAST_SCORE)
        fresh = scores.select(*key, "kind", (F.col("score") * FADING ** (step + 1)).alias("trust"))
        if accepted is None:
            known, accepted = 0, stored(fresh, "pii-accepted", narrow=True)
        else:
            known = accepted.count()
            same = [F.col(f"f.{c}").eqNullSafe(F.col(f"a.{c}")) for c in key]
            fresh = fresh.alias("f").join(accepted.alias("a"), same, "left_anti")
            accepted = stored(accepted.unionByName(fresh), "pii-accepted", narrow=True)
        if accepted.count() == known:
            break
    return accepted.select(*key, "kind")


def confident(graph: DataFrame, accepted: DataFrame | None, key: list[str]) -> DataFrame:
    """kind, pattern, confidence of the patterns that can be relied on."""
    if accepted is None:
        # Before anything is known of the candidates only seeds speak for or against a pattern.
        trusted = graph.filter("seed").withColumn("trust", F.lit(1.0))
    else:
        same = [F.col(f"g.{c}").eqNullSafe(F.col(f"a.{c}")) for c in key]
        own = F.when(F.col("g.seed"), F.lit(1.0)).otherwise(F.coalesce("a.trust", F.lit(0.0)))
        trusted = graph.alias("g").join(accepted.alias("a"), same, "left").select("g.*", own.alias("trust"))
    good = F.col("trust") > 0
    of_kind = trusted.groupBy("kind", "pattern").agg(
        F.sum("trust").alias("won"),
        F.count(F.lit(1)).alias("all"),
        F.count_distinct(F.when(good, F.struct(F.coalesce(F.col("id").cast("string"), F.lit("")), "tie"))).alias("texts"),
    )
    # A pattern of one kind is weakened by what stands in it and is trusted as another kind.
    total = of_kind.groupBy("pattern").agg(F.sum("won").alias("all_won"))
    confidence = F.col("won") / (F.col("all") + F.col("all_won") - F.col("won") + DAMPING)
    sure = of_kind.filter(F.col("texts") >= SUPPORT).join(total, "pattern").withColumn("confidence", confidence)
    return sure.filter(F.col("confidence") >= LEAST_CONFIDENCE).select("kind", "pattern", "confidence")


def find(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row for each row of docs: id, counts of the strict forms, base_sha256, spans, n_found.

    Spans are kind:start:end in code points, the end exclusive, by kind and start.
    n_found counts those that contexts added.
    """
    rows = stored(scanned(docs, text_col, id_col), "pii-matches", narrow=True)
    seeds = matches(rows, "strict").filter(valid(F.col("kind"), F.col("match")))
    seeds = stored(seeds, "pii-seeds", narrow=True)
    here = ["id", "tie"]
    loose = matches(rows, "loose").alias("c")
    base = seeds.select(*here, F.col("start").alias("from"), F.col("end").alias("to")).alias("s")
    same = F.col("c.id").eqNullSafe(F.col("s.id")) & (F.col("c.tie") == F.col("s.tie"))
    apart = (F.col("c.start") < F.col("s.to")) & (F.col("s.from") < F.col("c.end"))
    candidates = loose.join(base, same & apart, "left_anti")
    added = bootstrapped(seeds, candidates)
    every = seeds.select(*here, "number", "kind", "start", "end", F.lit(True).alias("base")).unionByName(
        added.select(*here, "number", "kind", "start", "end", F.lit(False).alias("base"))
    )
    # The spans of one text, so a list follows its length.
    of_text = every.groupBy(*here).agg(
        *(F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS),
        F.count_if(~F.col("base")).alias("n_found"),
        F.array_sort(F.collect_list(F.struct("number", "start", "end", "kind", "base"))).alias("list"),
    )
    written = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of_text = of_text.select(
        F.col("id").alias("of"),
        F.col("tie").alias("of_tie"),
        *(f"n_{k}" for k in KINDS),
        "n_found",
        F.concat_ws(",", F.transform(F.filter("list", lambda s: s["base"]), written)).alias("base"),
        F.concat_ws(",", F.transform("list", written)).alias("spans"),
    )
    joined = rows.select("id", "tie").join(
        of_text, F.col("id").eqNullSafe(F.col("of")) & (F.col("tie") == F.col("of_tie")), "left"
    )
    return joined.select(
        F.col("id").alias(id_col),
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_found", F.lit(0)).cast("long").alias("n_found"),
    )
