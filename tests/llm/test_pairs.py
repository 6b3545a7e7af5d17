"""N-gram join, vectors, components and HTML on small tables."""

import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from discolake.llm import cross_polytope, html_layout, ngram_join
from discolake.llm.components import components
from discolake.llm.html_layout import visible_text
from discolake.llm.tables import perhaps_among

SCHEMA = "doc_id long, text string"
WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def grams(text, k):
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) >= k:
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)] if words else [])


def near_copies(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one", "ONE", "one two", "É é", "é É", "a b c", "a b  c\n", "long tale " * 20_000]
    for _ in range(12):
        base = rng.choices(words, k=rng.randint(5, 160))
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    shared = " ".join(rng.choices(words, k=30))
    texts += [f"{shared} {' '.join(rng.choices(words, k=rng.randint(0, 9)))}" for _ in range(25)]
    texts += [texts[20]] * 6 + ["the the the the the"] * 2
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (1, 50)])
def test_ngram_join_equals_all_pairs(spark, k, percent):
    texts = near_copies()
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[4], (None, "no id here")], SCHEMA)
    for name in ("gram", "rep", "n", "component", "digest", "a", "b"):
        docs = docs.withColumn(name, F.lit("mine"))
    sets = {i: grams(t, k) for i, t in rows}
    links = [
        (a, b)
        for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = roots(sets, links)
    found = ngram_join.similar_documents(docs.repartition(3), k, percent).collect()
    assert len(found) == len(rows) + 2
    for row in found:
        if row.doc_id is not None:
            assert (row.n_grams, row.component_id) == (len(sets[row.doc_id]), want[row.doc_id])
    kept = ngram_join.one_of_each(docs, k, percent)
    assert kept.columns == docs.columns
    stays = Counter(r.doc_id for r in kept.collect())
    assert set(stays) == {i for i, root in want.items() if i == root} | {None}


def test_a_large_group_of_near_copies_meets_hubs_only(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(300):
        copy = list(base)
        copy[rng.randrange(200)] = f"own{i}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, SCHEMA)
    found = ngram_join.similar_documents(docs, 3, 90).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 300


def test_of_an_id_with_several_texts_only_linked_rows_go(spark):
    base = [f"b{i}" for i in range(60)]
    copies = [(i, " ".join([*base, f"own{i}"])) for i in range(10, 30)]
    clean = [(i, " ".join(f"u{i}x{j}" for j in range(40))) for i in range(10, 30)]
    docs = spark.createDataFrame([(1, " ".join(base)), *copies, *clean, *clean[:3]], SCHEMA)
    kept = Counter(tuple(r) for r in ngram_join.one_of_each(docs, 3, 80).select("doc_id", "text").collect())
    assert kept[1, " ".join(base)] == 1
    assert all(kept[row] == (2 if row in clean[:3] else 1) for row in clean)
    # An id is a node with the text of its least digest; where that is the copy, the copy goes.
    assert 0 < sum(kept[row] for row in copies) < len(copies)


def test_ngram_join_of_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert ngram_join.similar_documents(docs).count() == 0
    assert ngram_join.one_of_each(docs).count() == 0


def test_components_of_paths_stars_and_rings(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(200 + i, 200 + (i + 1) % 20) for i in range(20)]
    links += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(70)]
    names = list(range(0, 401))
    rng.shuffle(names)
    links = [(names[a], names[b]) for a, b in links]
    want = roots(names, links)
    found = components(spark.createDataFrame([*links, links[0], (7, 7)], "a long, b long"))
    seen = {r.node: r.component for r in found.collect()}
    assert found.count() == len(seen)
    assert all(want[n] == c for n, c in seen.items())
    assert {n for link in links for n in link if link[0] != link[1]} == set(seen)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors():
    rng = np.random.default_rng(2)
    rows = []
    for group in range(30):
        base = rng.normal(size=24)
        for _ in range(rng.integers(1, 9)):
            rows.append((base + rng.normal(size=24) * rng.choice([0, 0.05, 0.2])) * rng.uniform(0.5, 3))
    rows += [rows[3]] * 5
    base = rng.normal(size=24)
    rows += [base + rng.normal(size=24) * 0.03 for _ in range(60)]
    odd = [None, [], [0.0] * 24, [None, *[1.0] * 23], [float("nan")] * 24, [float("inf"), *[1.0] * 23], [1.0], [-2.0], [5.0], [1e-30] * 24, [1e30] * 24, [1.0] * 24]
    return [list(map(float, r)) for r in rows] + odd


@pytest.mark.parametrize("block", [256, 8])
def test_vectors_link_as_in_all_pairs(spark, block):
    rows = [(i * 2 + 1, v, i % 3) for i, v in enumerate(vectors())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit("mine"))
    good = {
        i: np.array(v) / np.abs(v).max()
        for i, v, _ in rows
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    links = []
    for a, b in combinations(good, 2):
        x, y = good[a], good[b]
        if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95:
            links.append((a, b))
    ids = [i for i, *_ in rows]
    count, want = Counter(n for link in links for n in link), roots(ids, links)
    found = {r.vec_id: r for r in cross_polytope.near_vectors(table.repartition(4), block=block).collect()}
    assert len(found) == len(rows)
    reached = sum(found[i].n_links for i in ids)
    assert all(found[i].n_links <= count[i] for i in ids)
    assert reached >= 0.99 * 2 * len(links)
    if reached == 2 * len(links):
        assert {i: found[i].component_id for i in ids} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_recall_at_the_least_cosine():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    for count in (1_000, 60_000, 20_000_000):
        hashes, tables, probes = cross_polytope.plan(count, 64)
        a, b = (cross_polytope.bucket_names(v, hashes, tables, probes) for v in (x, y))
        assert (a[:, :, None] == b[:, None, :]).any((1, 2)).mean() >= 0.9


@pytest.mark.parametrize("dims", [16, 256, 768])
def test_recall_at_other_widths(dims):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(800, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    for count in (1_000, 60_000, 20_000_000):
        plan = cross_polytope.plan(count, dims)
        a, b = (cross_polytope.bucket_names(v, *plan) for v in (x, y))
        assert (a[:, :, None] == b[:, None, :]).any((1, 2)).mean() >= 0.9, (count, plan)


def test_vectors_of_no_rows(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert cross_polytope.near_vectors(table).count() == 0


LAYOUTS = [
    ("<p>a<p>b", "a\n\nb"),
    ("<div>a</div><div>b <b>c</b>d</div>", "a\nb cd"),
    ("<ul><li>x<li>y<ul><li>z</ul></ul>after", "- x\n- y\n  - z\n\nafter"),
    ("<ol start=3><li>one<li>two<br>more</ol>", "3. one\n4. two\n   more"),
    ("<table><tr><th>Name<th>Age<tr><td>Bob Smith<td>3</table>tail", "Name       Age\nBob Smith  3\n\ntail"),
    ("<table><tr><td colspan=2>wide cell here<td>c<tr><td>1<td>2<td>3</table>", "wide cell here  c\n1  2            3"),
    ("<table><td rowspan=2>r<td>a<tr><td>x</table>", "r  a\n   x"),
    ("<table><tr><td><p>a<p>b<td>c</table>", "a  c\nb"),
    ("<table><tr><td>o<td><table><tr><td>i<td>j<tr><td>kk<td>l</table></table>", "o  i   j\n   kk  l"),
    ("<table>lost<tr><td>a</table>", "lost\n\na"),
    ("<p hidden>no</p><p style='display: none'>no</p>yes", "yes"),
    ("<div style='visibility:hidden'>no<i style='visibility:visible'>yes</i></div>", "yes"),
    ("<details><summary>s</summary>no<p>no</details><details open>yes</details>", "s\nyes"),
    ("<head><title>no</title><style>no</style></head><script>'</p>no'</script><!-- no -->yes", "yes"),
    ("<noscript>yes</noscript><template>no</template><dialog>no</dialog>", "yes"),
    ("<pre>a\n  b</pre>x", "a\n  b\n\nx"),
    ("a<br><br>b", "a\n\nb"),
    ("<blockquote>q</blockquote><dl><dt>t<dd>d</dl>", "  q\n\nt\n  d"),
    ("1 &lt; 2 &amp;c; &nbsp;x &am", "1 < 2 &c; \xa0x &am"),
    ("a  \n b<span> c</span> <i>d</i>", "a b c d"),
    ("<h1>T</h1>x<P CLASS='a>b'>y</P>z", "T\n\nx\n\ny\n\nz"),
    ("x<b>y<p>z</b>w</p>", "xy\n\nzw"),
    ("</p></div>a</ul><li>b", "a\nb"),
    ("text <a href='x", "text"),
    ("a < b <3 c", "a < b <3 c"),
    ("<select><option>a<option>b</select>", "a\nb"),
    ("", ""),
    ("<html><body></body></html>", ""),
]


@pytest.mark.parametrize("page, text", LAYOUTS)
def test_layout(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<p title='it's here'>first</p><p>second, don't go</p>", "first\n\nsecond, don't go"),
    ("<img alt=Bob's><p>first</p><p>second isn't here</p>", "first\n\nsecond isn't here"),
    ("<p \"x>one</p><p title = \"a > b\">two \"three\"</p>", "one\n\ntwo \"three\""),
    ("<p a='1'b=\"2>\"c='>'>one</p><p =\">two</p>\"<i data-x=it's/hidden>three</i>", "one\n\ntwo\n\n\"three"),
    ("<p title=\"x>one</p><p>two</p>", "one\n\ntwo"),
    ("one<p title='a > b' ", "one"),
    ("one</p title='a > b'> two", "one two"),
    ("a<![CDATA[b]]>c<p>d</p>", "ac\n\nd"),
    ("a<![CDATA[b>c<p>d</p>", "ac\n\nd"),
    ("<svg><text><![CDATA[a > <b>]]></text></svg>c", "a > <b>c"),
    ("<svg><foreignObject><p>a<![CDATA[b>c</p></foreignObject></svg>", "ac"),
    ("<svg/>a<![CDATA[b>c<i>d</i>", "acd"),
    ("<math><mi>a<![CDATA[b", "ab"),
    ("a<!-->b<!--->c<!-- d > -->e", "abce"),
])
def test_ends_of_tags(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<head><title>T</title>Hello <b>x</b><p>y", "Hello x\n\ny"),
    ("<html><head>\n<title>T</title>\n<span>a</span> <a href=x>b</a><button>c</button><p>d", "a bc\n\nd"),
    ("<head><meta charset=x><link href=y><style>s</style><my-item>a</my-item>b", "ab"),
    ("<head><img src=x><br>a</head>b", "ab"),
    ("<head>&nbsp;a", "\xa0a"),
    ("<head>&#32;<title>T</title><script>s</script></head>a", "a"),
    ("<head><noscript><style>s</style></noscript><noscript><img src=x>a</noscript><title>T</title>b", "ab"),
    ("<head><noscript>a</noscript>b", "ab"),
    ("<head><template><p>a</p><i>b</i>c</template><title>T</title>d", "d"),
    ("<head><head><title>T</title>a<body>b", "a\nb"),
    ("<head><title>T</title><body><p>a", "a"),
])
def test_end_of_head(page, text):
    assert visible_text(page) == text


def test_quotes_and_cdata_take_linear_time():
    for piece in ("<a b='", "<a b=\"", "<a '", "<a =", "<a b= ", "<![CDATA[", "<svg><![CDATA[", "<a b='>"):
        visible_text(piece * 20_000)


def seconds(page):
    start = time.perf_counter()
    visible_text(page)
    return time.perf_counter() - start


@pytest.mark.parametrize(
    "piece",
    [
        lambda n: "<i>" * n + "<b><p></b>" * n,
        lambda n: "<font>" * n + "<li>x" * n,
        lambda n: "<svg>" + "<x>" * n + "<![CDATA[a]]>" * n,
        lambda n: "<i>" * n + "</u></p></td>" * n,
        lambda n: "<i>" * n + "<body class=a>" * n,
    ],
)
def test_deep_pages_take_linear_time(piece):
    """Twice the page takes about twice the time; a walk down the stack took four times as long."""
    visible_text(piece(500))
    short = min(seconds(piece(8000)) for _ in range(3))
    long = min(seconds(piece(16000)) for _ in range(3))
    assert long < 3 * short + 0.2 and long < 5


def test_style_elements_hide():
    page = "<style>.x, #y{display:none} @media print{p{display:none}} i{visibility:hidden}</style>"
    page += "<p class='a x'>no<p id=y>no<p>yes <i>no <b style='visibility:visible'>seen</b></i>"
    assert visible_text(page) == "yes seen"
    assert visible_text("<style>p{display:none}p.k{display:block}</style><p>no<p class=k>yes") == "yes"
    assert visible_text("<style>p{display:none!important}</style><p style='display:block'>no") == ""
    assert visible_text("<style>/* p{display:none} */ div > p{display:none} q{color:red}</style><div><p>yes</div>") == "yes"
    assert visible_text("<style>.a{display:none}.a{display:block}</style><p class=a>yes") == "yes"
    assert visible_text("<style>p{display:none</style><p>a") in ("", "a")


def test_numbers_of_list_items_and_ruby():
    assert visible_text("<ol><li value=5>a<li>b<li value=x>c</ol>") == "5. a\n6. b\n7. c"
    assert visible_text("<ol reversed><li>a<li>b</ol>") == "2. a\n1. b"
    assert visible_text("<ol reversed start=9><li>a<li>b</ol>") == "9. a\n8. b"
    assert visible_text("<ruby>x<rp>(</rp><rt>y</rt><rp>)</rp></ruby>") == "xy"
    tall = "<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>"
    assert visible_text(tall) == visible_text(tall.replace("=0", "=3"))


def test_pages_of_any_depth_and_length():
    assert visible_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert visible_text("<ul><li>" * 300 + "x").endswith("x")
    wide = "<table><tr><td>" + "w" * 50_000 + "<td>b" + "<tr><td>a<td>b" * 200 + "</table>"
    assert len(visible_text(wide)) < 100_000
    rng = random.Random(7)
    pieces = ["<p>", "</p>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<b", ">", "&", "&amp;", "<!--", "-->", "x y", '"', "'", "<pre>", "<script>", "</script>", "<br>"]
    for _ in range(500):
        visible_text("".join(rng.choices(pieces, k=60)))


def test_pages_table(spark):
    rows = [(1, "u", "<p>a"), (2, None, None), (3, "u", ""), (1, "u", "<p>a"), (None, "u", "<b>b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("mine"))
    found = [tuple(r) for r in html_layout.extract(pages).collect()]
    assert Counter(found) == Counter([(1, "a"), (2, None), (3, ""), (1, "a"), (None, "b")])
    assert html_layout.extract(pages.limit(0)).count() == 0


def test_hub_rounds_leave_no_link_out(spark):
    """Chains of texts, each near the next only, and two groups that share their rare grams."""
    rng = random.Random(11)
    rows, i = [], 0
    for _ in range(6):
        text = [f"c{rng.randint(0, 10**6)}" for _ in range(120)]
        for _ in range(8):
            rows.append((i, " ".join(text)))
            i += 1
            at = rng.randrange(0, 119)
            text = [*text[:at], f"n{i}", *text[at + 1 :]]
    docs = spark.createDataFrame(rows, SCHEMA)
    sets = {d: grams(t, 3) for d, t in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    want = roots(sets, links)
    found = {r.doc_id: r.component_id for r in ngram_join.similar_documents(docs, 3, 90).collect()}
    assert found == want
    by_root = defaultdict(list)
    for d, root in want.items():
        by_root[root].append(d)
    assert any(len(m) > 2 for m in by_root.values())


def test_overlaps_of_members_of_few_and_of_many_sets():
    rng = np.random.default_rng(2)
    sets = [rng.integers(-(2**63), 2**63 - 1, 5)]
    for i in range(70):
        # Up to 50 members of all sets, and up to 400 that two or three of them have.
        common, rare = rng.choice(60, rng.integers(0, 50), replace=False), rng.choice(4000, 200, replace=False) + 100
        sets.append(np.concatenate((common, rare)).astype("i8"))
    found = ngram_join.overlaps(sets)
    for a, b in combinations(range(len(sets)), 2):
        assert found[a, b] == found[b, a] == len(set(sets[a].tolist()) & set(sets[b].tolist()))


def test_a_common_gram_is_dealt_to_few_cells(spark):
    rows = spark.range(0, 4000).select(F.lit(7).alias("gram"), F.col("id").alias("rep"))
    held = spark.createDataFrame([(7, 4000)], "gram int, held long")
    cells = ngram_join.in_cells(rows, held)
    assert cells.count() <= 8 * 4000
    # Long sets come in smaller blocks, and each two rows meet in one cell.
    some = rows.filter("rep < 40")
    many = held.withColumn("members", F.lit(9 * ngram_join.BLOCK_MEMBERS).cast("long"))
    cells = ngram_join.in_cells(some, many)
    x, y = cells.alias("x"), cells.alias("y")
    meet = F.expr("x.low = y.low AND x.high = y.high AND x.rep < y.rep AND (x.low = x.high OR x.side != y.side)")
    met = Counter(tuple(r) for r in x.join(y, meet).select("x.rep", "y.rep").collect())
    assert cells.count() == 9 * 40 and met == Counter(combinations(range(40), 2))


def test_suffix_filter_is_left_to_pairs_that_cheaper_tests_allow(spark):
    rows = [(1, rep, 100, rep % 2, [rep, rep + 100], rep, 40) for rep in range(40)]
    schema = "gram long, rep long, n long, pos long, choices array<long>, group long, held long"
    pairs = ngram_join.apart_pairs(spark.createDataFrame(rows, schema), 90)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan and "bins" not in plan
    assert {tuple(r) for r in pairs.collect()} == {(a, b) for b, a in combinations(range(40), 2)}
    # An expression that a join condition names twice is worked out for every pair.
    assert str(ngram_join.enough(F.col("both"), F.col("na"), F.col("nb"), 90)).count("both") == 1


def test_many_ids_are_told_from_others_by_a_broadcast_of_bounded_size(spark):
    ids = spark.range(0, 30_000).select((F.col("id") * 7 - 50_000).alias("wanted"))
    rows = spark.range(-100_000, 200_000).select("id", F.lit("text").alias("__bucket")).unionByName(
        spark.createDataFrame([(None, "none")], "id long, __bucket string")
    )
    found = perhaps_among(rows, F.col("id"), ids)
    assert found.columns == ["id", "__bucket", "__among"] and found.count() == 300_001
    wanted = found.join(ids, F.col("id") == F.col("wanted"), "left_semi")
    assert wanted.count() == wanted.filter("__among").count() == 30_000
    assert found.filter("__among").count() < 31_000
    assert perhaps_among(rows, F.col("id"), ids.limit(0)).filter("__among").count() == 0


def test_ngram_join_without_a_broadcast_of_ids(spark, monkeypatch):
    rows = [(i * 3, t) for i, t in enumerate(near_copies(4))]
    # Of rows with one id only those go that are linked.
    docs = spark.createDataFrame([*rows, *rows[:5], (6, "one two three of its own"), (None, "no id here")], SCHEMA)
    want = [Counter(map(tuple, f(docs, 3, 80).collect())) for f in (ngram_join.similar_documents, ngram_join.one_of_each)]
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    seen = []
    monkeypatch.setattr(ngram_join, "perhaps_among", lambda *a: seen.append(1) or perhaps_among(*a))
    assert [Counter(map(tuple, f(docs, 3, 80).collect())) for f in (ngram_join.similar_documents, ngram_join.one_of_each)] == want
    assert len(seen) > 2
