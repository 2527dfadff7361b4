"""Template text, hard negatives and ranked search against plain versions and on edge cases."""

import html
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from harness import compare, oracle
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sessionloom.llm import hardneg, ranked, templates

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_bond_hard_negatives", "op13_rmq_ranked_search"])
def test_sql(spark, name):
    _, diff = compare(entry.queries()[name](spark, SF_DIR), oracle(SF_DIR), entry.oracle_sql()[name])
    assert diff == ""


# --- main text ----------------------------------------------------------------


def plain_article(page):
    """Heading and paragraphs between the article's tags, read by patterns."""
    inner = re.search(r"<article>(.*?)(?:</article>|$)", page or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>|<br>", inner[1]) if inner else []
    texts = [" ".join(html.unescape(re.sub("</?b>", "", b)).split()) for b in blocks]
    return " ".join(t for t in texts if t)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_registered_query_against_patterns(spark, sf):
    d = f"/root/testdata/{sf}"
    got = {r.page_id: r for r in entry.queries()["op11_template_main_text"](spark, d).collect()}
    pages = spark.read.parquet(f"{d}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        want = plain_article(p.html)
        assert (got[p.page_id].url, got[p.page_id].text, got[p.page_id].n_chars) == (p.url, want, len(want))


def soup(i, words):
    """A page without any speaking element or name; every host's page repeats a notice in the same place."""
    links = "".join(f"<li><a href=/{w}>{w} {i}</a></li>" for w in words[:4])
    body = "".join(f"<p>{' '.join(words[k : k + 9])}</p>" for k in range(0, 45, 9))
    return (
        f"<html><body><div class=x1><ul>{links}</ul></div><div class=x2><p>Our office is closed on Sundays</p><h1>{words[0]} {i}</h1>{body}</div>"
        f"<div class=x3><p>all of it by {words[5]}</p></div></body></html>"
    )


def soup_pages(n=12):
    rnd = random.Random(3)
    return [(i, f"http://h.example/{i}", soup(i, [f"w{rnd.randrange(10**6)}" for _ in range(50)])) for i in range(n)]


def test_slots_and_constant_texts_without_speaking_names(spark):
    pages = soup_pages()
    got = {r.page_id: r.text for r in templates.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i, _, page in pages:
        inner = re.search("<div class=x2><p>Our office is closed on Sundays</p>(.*?)</div>", page)[1]
        assert got[i] == " ".join(re.sub("<[^>]+>", " ", inner).split())


def plain_template(pages):
    """Tokens of equivalence classes by whole vectors, with order and nesting tried on token positions."""
    read = [templates.parse(p) for p in pages]
    counted = [Counter(tokens) for tokens, _ in read]
    texts = {r.token for _, runs in read for r in runs}
    vectors = defaultdict(list)
    for t in set().union(*counted):
        vector = tuple(c[t] for c in counted)
        if 2 * sum(x > 0 for x in vector) >= len(pages):
            vectors[vector].append(t)
    classes = [frozenset(ts) for ts in vectors.values() if len(ts) > 1]

    def spans(tokens, ts):
        at = [(k, t) for k, t in enumerate(tokens) if t in ts]
        return [at[k : k + len(ts)] for k in range(0, len(at), len(ts))]

    found = set()
    for ts in classes:
        orders, loose = set(), set()
        for tokens, _ in read:
            others = [(o[0][0], o[-1][0]) for other in classes if other != ts for o in spans(tokens, other)]
            for s in spans(tokens, ts):
                off = {t for k, t in s if t not in texts and any(s[0][0] < a < k < b for a, b in others)}
                loose |= off
                orders.add(tuple(t for _, t in s if t not in off))
        if len(orders) == 1:
            found |= ts - loose
    return found


def test_template_equals_whole_vectors(spark):
    pages = soup_pages(9)
    df = spark.createDataFrame([(7, p) for _, _, p in pages], "host long, html string")
    row = templates.templates(df).first().template
    assert {t & (1 << 64) - 1 for t in row.tokens} == plain_template([p for _, _, p in pages])
    assert len(row.texts) == 1  # the notice


def test_order_and_nesting():
    class_of = {1: 0, 2: 0, 3: 1, 4: 1, 5: 0}
    def got(*tokens, size=2, texts=()):
        return templates.order_of(list(tokens), class_of, [size, 2], set(texts))

    assert got(1, 3, 4, 2) == {0: ((1, 2), frozenset()), 1: ((3, 4), frozenset())}
    assert got(1, 2, 3, 4, 1, 2) == {0: ((1, 2), frozenset()), 1: ((3, 4), frozenset())}
    assert got(1, 2, 2, 1)[0] is None  # another order
    assert got(1, 3, 2, 4) == {0: ((1,), frozenset({2})), 1: ((3, 4), frozenset())}  # 2 stands inside the other class
    assert got(1, 3, 2, 4, 1, 2)[0] is None  # and then it does not
    assert got(1, 3, 5, 4, 2, size=3, texts=[5]) == {0: ((1, 5, 2), frozenset()), 1: ((3, 4), frozenset())}
    assert got(1)[0] is None


BLOCKS = """<!DOCTYPE html><html><body class="has-sidebar"><header>Site</header><div id="cookie-notice">We use cookies</div>
<div class="content sidebar-layout"><article class=post><header><h1>Big &amp; <i>small</i>&nbsp;news</h1></header><p>One<b>two</b><br>three <p>a &lt; b
<div class="share-buttons">Tweet</div><ul><li>x<li>y</ul><form><label>Mail</label></form><!-- no <p>this</p> -->
<script>if (a < b) document.write("<p>no</p>")</script><style>p{}</style><aside>Related</aside><table><tr><td>c1<td>c2</table>
<section class="comments"><article><p>First!</p></article></section><div hidden>gone</div><p>1 < 2 & 3 > 2</article>
<div class=sidebar><p>More</p></div></div><footer>&copy;</footer>"""


def test_elements_that_are_left_out(spark):
    rows = [(1, "http://a/x", BLOCKS), (2, None, None), (3, "", ""), (4, "http://b/", "   plain text, <b>no</b>\t elements "), (5, "http://c/", "<p")]
    rows += [(6, "x", "<main><p>in <a href='>'>main</a></p></main><div>out</div>"), (None, "http://a/y", "<article>a<p></p>b</article>")]
    rows += [(7, "http://d/", "<div><p>" + "long words " * 60000 + "</p></div>"), (8, "http://d/", "<article>same</article>"), (8, "http://d/", "<article>same</article>")]
    df = spark.createDataFrame([(*r, "t", 5, "h") for r in rows], "page_id long, url string, html string, text string, n_chars int, host string")
    out = templates.main_text(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.url, r.text) for r in out.collect()), key=str)
    texts = {r[0]: r[2] for r in got}
    assert len(got) == len(rows)
    assert texts[1] == "Big & small news Onetwo three a < b x y c1 c2 1 < 2 & 3 > 2"
    assert texts[2] == texts[3] == texts[5] == "" and texts[4] == "plain text, no elements" and texts[6] == "in main" and texts[None] == "a b"
    assert texts[7] == ("long words " * 60000).strip() and texts[8] == "same"
    assert templates.main_text(df.limit(0)).count() == 0


def test_parsing_time_is_proportional():
    for bad in ("<", "<a ", "</p", "<div>", "<!--", "<a b='", '<a b="', "<li><div>", "<script>", "&", "<td><tr>"):
        tokens, runs = templates.parse(bad * 60000)
        assert len(tokens) < 400000 and len(runs) < 100000


def test_copies_on_a_small_host_keep_their_text(spark):
    page = "<article><p>The same words</p></article>"
    rows = [(i, "http://e/", page) for i in range(20)] + [(50 + i, "http://f/", page + f"<nav>{i}</nav>") for i in range(20)]
    out = templates.main_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.text for r in out.collect()} == {"The same words"}


# --- hard negatives -----------------------------------------------------------


def plain_negatives(rows, positives=5, negatives=10):
    good = [(i, l, [math.floor(256 * float(x)) for x in v]) for i, v, l in rows if None not in (i, v, l) and all(x is not None and math.isfinite(x) for x in v)]
    good = sorted(dict(sorted(((i, (l, v)) for i, l, v in good), reverse=True)).items())
    out = set()
    for a, (la, va) in good:
        if a % 100:
            continue
        other = sorted((-sum(x * y for x, y in zip(va, v)), i, l) for i, (l, v) in good if i != a)  # noqa: B905
        for sp, p, _ in [o for o in other if o[2] == la][:positives]:
            near = [o for o in other if o[2] != la and 30 * -sp <= 100 * -o[0] <= 90 * -sp][:negatives]
            out |= {(a, p, k + 1, n, -sp, -sn) for k, (sn, n, _) in enumerate(near)}
    return out


@pytest.mark.parametrize("block_rows, block_anchors", [(2048, 2048), (37, 2)])
def test_hard_negatives_against_all_products(spark, block_rows, block_anchors):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 6] + rng.normal(size=12) * 0.6], int(rng.integers(0, 3))) for i in range(700)]
    rows += [(700, None, 1), (701, [1.0, None], 1), (702, [float("nan")] * 12, 1), (703, [float("inf")] * 12, 0), (704, [1.0] * 12, None), (None, [1.0] * 12, 1)]
    rows += [(800, [], 0), (801, [3.0], 1), (900, [0.0] * 12, 2), (5, [9.0] * 12, 0), (100, rows[100][1], rows[100][2]), (600, [8.0] * 12, 9)]
    rows += [(1000 + i, [0.5] * 12, 0) for i in range(40)] + [(1100 + i, [0.25] * 12, 1) for i in range(40)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, block string, score int").repartition(5)
    out = hardneg.hard_negatives(df, F.col("vec_id") % 100 == 0, block_rows=block_rows, block_anchors=block_anchors)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_negatives(rows)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert hardneg.hard_negatives(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_hard_negatives_of_extreme_vectors(spark):
    big = [1e30, 1.0]
    rows = [(0, big, 0), (1, [1e30, 2.0], 0), (2, [5e29, 0.0], 1), (3, [1e-30, 0.0], 1), (4, [1.0, 1.0], 1)]
    out = hardneg.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("vec_id") % 100 == 0).collect()
    assert all(r.positive_score == (1 << 63) - 1 for r in out)  # beyond 64 bits
    assert {r.anchor_id for r in out} <= {0}


def test_scan_drops_only_what_cannot_matter():
    rng = np.random.default_rng(5)
    for _ in range(60):
        columns = rng.integers(-40, 40, (20, 90))
        anchor = rng.integers(-40, 40, 20)
        bitmap = rng.random(90) < 0.7
        windows = [(-np.inf, np.inf), tuple(sorted(rng.integers(-4000, 4000, 2).tolist()))]
        rows, products = hardneg.scan(columns, bitmap, anchor, windows, 4)
        assert (products == anchor @ columns[:, rows]).all()
        all_rows = np.flatnonzero(bitmap)
        for low, high in windows:
            want = hardneg.best_of(all_rows, anchor @ columns[:, all_rows], low, high, 4)
            got = hardneg.best_of(rows, products, low, high, 4)
            assert (want[0] == got[0]).all() and (want[1] == got[1]).all()


def test_windows():
    for p in (*range(-25, 60), 10**20):
        low, high = hardneg.window_of(p)
        for s in range(low - 2, low + 2):
            assert (s >= low) == (30 * p <= 100 * s)
        for s in range(high - 2, high + 2):
            assert (s <= high) == (100 * s <= 90 * p)


# --- ranked search --------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_search(docs, items, k):
    lower = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    counted = [(i, Counter(WORD.findall((t or "").translate(lower)))) for i, t in docs if i is not None]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    terms = defaultdict(set)
    for i, t in items:
        if i is not None:
            terms[i] |= set(WORD.findall((t or "").translate(lower)))
    out = []
    for item, ts in terms.items():
        scores = []
        for i, c in counted:
            m = 50 + (50 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if c[t])
            if s > 0:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("limits", [{}, {"shard_docs": 30}, {"shard_postings": 50}, {"most_terms": 4}])
def test_ranked_search_against_all_scores(spark, limits):
    rnd = random.Random(6)
    words = ["the", "of", "a"] * 20 + [f"w{i}" for i in range(60)] + ["É", "é", "straße", "x1", "I"]
    docs = [(i, " ".join(rnd.choices(words, k=rnd.randrange(0, 40)))) for i in range(300)]
    docs += [(1000 + i, "the of w1 w2") for i in range(80)] + [(7, docs[7][1]), (8, "The, OF;w3\x00w3|É"), (None, "the of w1"), (400, None), (401, ""), (402, "-- !"), (403, "w5 " * 50000)]
    items = [(1, "the OF w1"), (2, "w5, w5 é É I"), (3, None), (4, "nothing here"), (5, ""), (6, "a"), (6, "w9 w10"), (None, "the"), (7, docs[3][1])]
    df = spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id long, text string, n int, score string").repartition(3)
    q = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, terms string")
    got = sorted(tuple(r) for r in ranked.ranked_search(df, q, 25, **limits).collect())
    assert got == plain_search(docs, items, 25)
    assert ranked.ranked_search(df.limit(0), q).count() == ranked.ranked_search(df, q.limit(0)).count() == 0


def test_shard_bounds_hold():
    rng = np.random.default_rng(7)
    held = [np.sort(rng.choice(50, rng.integers(1, 20), replace=False)) for _ in range(400)]
    sizes, terms = np.array([len(t) for t in held]), np.concatenate(held)
    shard = ranked.Shard(rng.permutation(400), np.full(400, 30), sizes, terms, rng.integers(1, 9, len(terms)), 400, 12000, 50)
    weights = rng.integers(0, 900, 50)
    some = np.arange(0, 50, 3)
    a, b = np.searchsorted(shard.keys, some * 400 + 25), np.searchsorted(shard.keys, some * 400 + 125)
    bound, split = shard.maxima(a[None], b[None], weights[some])
    docs, scores = shard.whole(a[None], b[None], weights[some])
    assert bound[0] >= scores.max() and 25 <= split[0] < 125
    full = np.zeros(400, np.int64)
    for t in some:
        for p in range(shard.start[t], shard.start[t + 1]):
            full[shard.doc[p]] += weights[t] * shard.impact[p]
    found, best = shard.best(some, weights[some], 15)
    want = np.lexsort((np.arange(400), -full))[:15]
    assert (found == want).all() and (best == full[want]).all()
