"""Spelling variants, whitening and main texts against brute force, exact sums and labelled pages."""

import itertools
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordmill.llm import main_text, spelling_variants, whitening


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected_variants(counts):
    told = {}
    for w, n in counts.items():
        around = [v for v in counts if near(w, v)]
        best = min(around, key=lambda v: (-counts[v], [ord(c) for c in v]), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        told[w] = (form, n, len(around), counts[form] if form else None)
    rows = set()
    for w, (form, n, n_near, form_n) in told.items():
        root = w
        while told[root][0]:
            root = told[root][0]
        rows.add((w, form, root, n, n_near, form_n))
    return rows


def test_variants_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    counts = {}
    for size in (5, 6, 7, 9, 12):
        for _ in range(60):
            counts["".join(rng.choice(list("abé"), size))] = int(rng.integers(3, 60))
    counts |= {"a" * k: 3 + 40 * (k == 30) for k in range(5, 60)}  # a long chain of branches, repeated letters
    counts |= {"zzzzz": 3, "zzzz": 7, "zzzzzz": 6, "azzzz": 6, "x" * 5_000: 4, "x" * 4_999 + "y": 8, "y" + "x" * 4_999: 9, "x" * 4_999: 3}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in spelling_variants.variants(words).collect()} == expected_variants(counts)
    assert spelling_variants.variants(words.limit(0)).count() == 0


def test_words_are_damaged_by_a_checksum_and_counted(spark):
    text = "Straße straSSe ÉCOLE école naïve-naïve x×y éé abcdefghij " * 3
    rows = [(i, text) for i in range(400)] + [(None, "nullid nullid nullid"), (7, None), (8, ""), (9, "12 -")] + [(3, "again again again")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2)).withColumn("run", F.lit(3))
    told = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in rows:
        runs = "".join(c if c.isascii() and c.isalpha() or "À" <= c <= "ÿ" else " " for c in t or "").translate(lower).split()
        for run in runs:
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            told[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    want = {(w, n) for w, n in told.items() if n >= 3 and len(w) >= 5}
    assert any(w not in "straße strasse École école naïve abcdefghij" for w, _ in want)
    assert {tuple(r) for r in spelling_variants.word_counts(docs).collect()} == want
    assert spelling_variants.word_counts(docs.limit(0)).count() == 0


def fitted(vectors):
    usable = [v for v in vectors if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v) for v in usable]
    fit = sorted(set(x))
    n, d = len(fit), len(fit[0])
    sums = [sum(r[i] for r in fit) for i in range(d)]
    cov = [[float(Fraction(sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in fit), n**3)) for j in range(d)] for i in range(d)]
    return x, n, sums, np.array(cov)


def test_whitening_against_fractions(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(c) for c in rng.normal(0, [0.1, 2, 0.7, 0.1, 30])] for _ in range(80)]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(None, vectors[0]), (3, vectors[3]), (3, vectors[4]), (90, None), (91, []), (92, [1.0] * 4), (93, [1.0, None, 1.0, 1.0, 1.0]), (94, [float("nan")] * 5), (95, [float("inf")] * 5), (96, [1e30] * 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit("clash")).withColumn("n", F.lit(1))
    got = whitening.whiten(frame.repartition(5), 4).collect()
    keep = [(i, v) for i, v in rows if v and len(v) == 5 and None not in v and np.isfinite(v).all() and max(map(abs, v)) < 1e20]
    x, n, sums, cov = fitted([v for _, v in keep])
    assert len(got) == 4 * len(keep) and {r["n"] for r in got} == {n} == {80}
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    deviations = Counter((i, sum((n * a - s) ** 2 for a, s in zip(q, sums))) for (i, _), q in zip(keep, x))
    assert Counter((r["vec_id"], r["deviation"]) for r in got if r["component"] == 2) == deviations
    for k in range(1, 5):
        mine = [r for r in got if r["component"] == k]
        assert all(abs(r["explained"] / (values[k - 1] / values.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-9 for r in mine)
        want = sorted(abs(float(sum((a - Fraction(s, n)) * Fraction(float(v)) for a, s, v in zip(q, sums, vectors[:, k - 1])))) / values[k - 1] ** 0.5 for q in x)
        assert np.allclose(sorted(abs(r["whitened"]) for r in mine), want, atol=1e-8)
    assert whitening.whiten(frame.limit(0)).count() == 0


def test_whitening_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in whitening.whiten(same).collect()} == {(i, k, 1, 0, None, None, None) for i in range(3) for k in (1, 2)}
    line = spark.createDataFrame([(i, [float(i), -float(i)]) for i in range(3)], "vec_id long, embedding array<float>")
    told = {(r["vec_id"], r["component"]): r for r in whitening.whiten(line).collect()}
    assert told[0, 2]["whitened"] is None and abs(told[0, 1]["explained"] - 1) < 1e-12 and told[0, 1]["identity_error"] < 1e-9


@pytest.mark.parametrize("size", [1, 1 << 12, 1 << 34, (1 << 61) - 1, 1 << 70])
def test_squares_are_exact(size):
    t = np.array([[size, -size, 0], [size - 1, 1 - size, 7]] * 50, object)
    t = t.astype(np.int64) if size < 1 << 62 else t
    assert whitening.square_sums(t) == [50 * (size**2 + (size - 1) ** 2)] * 2 + [50 * 49]
    x = np.array([[size, 3], [5, -size]], t.dtype)
    assert (whitening.centred(x, 1 << 20, [size, 2]) == x.astype(object) * (1 << 20) - np.array([size, 2], object)).all()


def test_sums_beyond_a_long_cross_tasks(spark):
    rows = spark.createDataFrame([([1 << 54, -(1 << 54)],)] * 40, "x array<long>").repartition(6)
    assert whitening._added(rows, lambda x: whitening.square_sums(x)) == [40 << 108] * 2


# --- pages ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    words = "Alpha beta gamma, delta epsilon zeta. Eta theta iota kappa lambda mu. Nu xi omicron, pi rho.".split()
    return main_text.fit(main_text.labelled_pages(["<p>" + " ".join(words) + "</p>"]))


def test_marginals_and_gradient_by_enumeration():
    tree = main_text.parse("<div class=a><p>x y</p><ul><li>z</ul></div>q")
    other = main_text.parse("<h1>only</h1>")
    names = {f: i for i, f in enumerate(sorted({f for t in (tree, other) for fs in t.features for f in fs}))}
    rng = np.random.default_rng(1)
    model = main_text.Model(names, rng.normal(0, 1, len(names)), rng.normal(0, 1, (main_text.N_KINDS**2, 2, 2)))
    forest = main_text.Forest([tree, other], names)
    labels = rng.integers(0, 2, forest.size)

    def score(y, m):
        told = sum(m.weights[f] for node, f in zip(forest.of_node, forest.feature) if y[node])
        return told + sum(m.bonds[forest.kinds[c], y[p], y[c]] for c, p in enumerate(forest.parents) if p >= 0)

    every = [np.array(y) for y in itertools.product((0, 1), repeat=forest.size)]
    weights = np.array([np.exp(score(y, model)) for y in every])
    want = sum(w * y for w, y in zip(weights, every)) / weights.sum()
    assert np.allclose(forest.marginals(model)[0][:, 1], want)

    def likelihood(m):
        return score(labels, m) - np.log(sum(np.exp(score(y, m)) for y in every))

    for mine, value in zip(main_text.gradient(forest, labels, model), (model.weights, model.bonds)):
        for at in list(np.ndindex(value.shape))[:: max(1, value.size // 40)] + [tuple(i) for i in np.argwhere(mine)[:20]]:
            kept = value[at]
            value[at] = kept + 1e-5
            up = likelihood(model)
            value[at] = kept - 1e-5
            down = likelihood(model)
            value[at] = kept
            assert abs((up - down) / 2e-5 - mine[at]) < 1e-4


def test_trees_of_loose_markup():
    texts = lambda page: [t for t in main_text.parse(page).texts if t]
    assert texts("<p>a<p>b <b>c<br>d</p>e<!-- x <p>no</p> -->f<script>var t='</p>';</script>") == ["a", "b c d", "ef"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table>") == ["a", "b", "c", "d", "e", "f"]
    assert texts("<head><title>t</title><p>a &amp;amp; &eacute;&#8212;&nbsp;\n b</p>") == ["a &amp; é— b"]
    assert texts("a < b <3 c<a title='x>y'>d</a> <select><option>no</select><style>p{}") == ["a < b <3 cd"]
    assert texts("</div></p>x<p") == ["x"] and texts("") == [] and texts("<!-- open") == [] and texts("<script>open") == []
    deep = main_text.parse("<div>" * 20_000 + "x")
    assert max(deep.depths) == 20_000


def test_marked_pages_are_told_whole(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in main_text.extract(pages).collect()}
    for row in pages.collect():
        inside = row["html"].split("<article>")[1].split("</article>")[0]
        assert got[row["page_id"]] == " ".join(t for t in main_text.parse(inside).texts if t), row["page_id"]


def test_other_layouts_are_mostly_right(model):
    made = main_text.Layouts("some words, of another kind. that no page of the training held, ever.".split(), 99)
    right = kept = content = leaves = 0
    for _ in range(300):
        tree, labels = main_text._unsigned(main_text.parse(made.page()))
        told = main_text.Forest([tree], model.names).marginals(model)[0][:, 1] >= 0.5
        for text, label, keep in zip(tree.texts, labels, told):
            if text:
                right, kept, content, leaves = right + (label and keep), kept + keep, content + label, leaves + 1
    assert leaves > content > 1_000
    assert right / kept > 0.95 and right / content > 0.95


def test_site_parts_without_marks(model):
    body = "<p>" + "This is a sentence of the article, long enough to be one. " * 6 + "</p>"
    page = f"""<html><body><div id="header"><a href="/">Site</a></div><div class="cookie-banner"><p>We use cookies. Accept them all?</p></div>
<div class="main-menu"><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></div><div class="post-content"><h1>A title</h1>{body}{body}
<div class="ads"><p>Buy this now, it is cheap.</p></div>{body}</div><div id="comments"><div class="comment"><b>Ann</b><p>I liked this a lot, thank you.</p></div></div>
<div class="newsletter"><form><label>Your mail</label><input></form></div><div class="site-footer">&copy; 2024 Site</div></body></html>"""
    text = main_text.Extractor(model).texts([page])[0]
    one = "This is a sentence of the article, long enough to be one. " * 6
    assert text == " ".join(["A title", *[one.strip()] * 3])


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "u", " \n "), (3, "u", " \n "), (4, "u", "<article>" + "<p>word " * 30_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("k", F.lit("x"))
    got = main_text.extract(pages).collect()
    assert len(got) == 6 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, 2, 3)] == [""] * 4
    assert main_text.extract(pages.limit(0)).count() == 0
