"""Operators on urls, pages and embeddings, the pipeline and the entry without this subpackage."""

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.llm import embedding_dedup, html_text, nearest, urls, vectors
from granary.llm.queries import RULES

VECTORS = "vec_id long, embedding array<float>, label int"


def test_url_parts_and_rules(spark):
    cases = {
        "http://A.Example.com/en/1?x#y": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://wwwexample.com/en/1": ("wwwexample.com", "/en/1", "com/", "allow"),
        "x://b.net/es/a://c": ("b.net", "/es/a:", None, None), "x://b.net/es/": ("b.net", "/es/", "net/es/", "block"), "x://b.net/es": ("b.net", "/es", None, "allow"),
        "x://a.com": ("a.com", "", None, "allow"), "x://a.com?q/": ("a.com", "", None, "allow"), "no host": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "://É.COM/\n": ("É.com", "/\n", "com/", "allow"), "": ("", "", None, "allow"),
    }
    cases["x://b.net/es/a://c"] = ("b.net", "/es/a://c", "net/es/", "block")
    rows = [(i, u, "clash") for i, u in enumerate(cases)] + [(None, "x://b.net/fr/1", "clash"), (0, "http://A.Example.com/en/1?x#y", "clash")]
    got = urls.filtered(spark.createDataFrame(rows, "page_id long, url string, host string"), RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is not None:
            host, path, rule, verdict = list(cases.values())[r["page_id"]]
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)
    assert urls.filtered(spark.createDataFrame([], "page_id long, url string"), RULES).count() == 0


def test_many_rules_are_joined(spark, monkeypatch):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(["http://a.example.com/en/1", "http://b.net/es/2", "http://c.org/", "http://net/fr/"])], "page_id long, url string")
    want = {tuple(r) for r in urls.filtered(pages, RULES).collect()}
    monkeypatch.setattr(urls, "INLINE_RULES", 0)
    assert {tuple(r) for r in urls.filtered(pages, RULES).collect()} == want


def test_templates(spark):
    rows = [f"http://shop.org/item/{i}" for i in range(40)] + [f"http://shop.org/user/name{i}x/cart" for i in range(60)] + [f"http://shop.org/spam/{i}" for i in range(40)]
    rules = [(f"shop.org/spam/{i}", "block") for i in range(10, 30)] + [("shop.org/item/1", "allow")]
    got = urls.filtered(spark.createDataFrame(list(enumerate(rows)), "page_id long, url string"), rules).collect()
    found = {r["template"] for r in got}
    assert "/item/<n>" in found and "/user/*/cart" in found and "/spam/<n>" in found and len(found) == 3
    assert {r["verdict"] for r in got if r["template"] == "/spam/<n>"} == {"block"} and any(r["rule"] is None for r in got if r["template"] == "/spam/<n>")
    assert {r["verdict"] for r in got if r["template"] != "/spam/<n>"} == {"allow"}


def plain_templates(urls, rules):
    """The template, purity and verdict of each url, from dicts of branches."""
    import re

    def parts(url):
        rest = (url or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        return host.translate({c: c + 32 for c in range(65, 91)}), re.match(r"[^?#]*", rest[len(host) :])[0]

    def kind(segment):
        if m := re.fullmatch(r"[0-9]+(\.[A-Za-z0-9]{1,5})?", segment):
            return "<n>" + (m[1] or "")
        if re.fullmatch(r"[0-9]{4}-[0-9]{2}(-[0-9]{2})?", segment):
            return "<date>"
        return "<hex>" if re.fullmatch(r"(?=.*[0-9])[0-9a-fA-F-]{8,}", segment) else segment

    def ruled(host, path):
        fits = [(len(r), len(r.partition("/")[0]), v) for r, v in rules for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        return max(fits)[2] if fits else None

    rows = []
    for url in urls:
        host, path = parts(url)
        rows.append({"host": host, "prefix": "", "left": [kind(s) for s in path.split("/")[1:]], "label": ruled(host, path)})
    literal = lambda s: s != urls_end and not s.startswith("<") and s != ""
    urls_end = "\0"
    while any(r["left"] is not None for r in rows):
        nodes = {}
        for r in rows:
            r["own"], r["next"] = (urls_end, urls_end) if not r["left"] else (r["left"][0], r["left"][1] if len(r["left"]) > 1 else urls_end)
            nodes.setdefault((r["host"], r["prefix"]), {}).setdefault(r["own"], []).append(r)
        for children in nodes.values():
            count = sum(len(c) for c in children.values())
            wide = sum(literal(s) for s in children)
            names, groups = {}, {}
            for s, c in children.items():
                b, a = sum(r["label"] == "block" for r in c), sum(r["label"] == "allow" for r in c)
                state = "block" if b > a and 2 * b >= len(c) else "allow" if a > b and 2 * a >= len(c) else "open"
                if literal(s) and wide >= 16 and len(c) < 0.05 * count:
                    names[s] = "*"
                elif literal(s) and len(c) >= 5:
                    cells = {}
                    for r in c:
                        x = (r["next"] if not literal(r["next"]) else "<s>", r["label"])
                        cells[x] = cells.get(x, 0) + 1
                    groups.setdefault(state, {})[s] = cells
            for state, branches in groups.items():
                pool = {}
                for cells in branches.values():
                    for x, n in cells.items():
                        pool[x] = pool.get(x, 0) + n
                total, df = sum(pool.values()), max(1, len(pool) - 1)
                bound = df * (1 - 2 / (9 * df) + 2.326 * (2 / (9 * df)) ** 0.5) ** 3
                for s, cells in branches.items():
                    own = sum(cells.values())
                    if len(branches) > 1 and sum(n * n / pool[x] for x, n in cells.items()) * total / own - own <= bound:
                        names[s] = f"<{state}>"
            for s, c in children.items():
                for r in c:
                    if s != urls_end:
                        r["prefix"] += "/" + names.get(s, s)
        for r in rows:
            r["left"] = r["left"][1:] if r["left"] else None
    labels = {}
    for r in rows:
        labels.setdefault((r["host"], r["prefix"]), []).append(r["label"])
    out = []
    for r in rows:
        own = labels[r["host"], r["prefix"]]
        b, known = own.count("block"), sum(x is not None for x in own)
        purity = (b + 2) / (known + 4)
        out.append((r["host"], r["prefix"], round(purity, 9), r["label"] or ("block" if purity >= 0.8 and 2 * known >= len(own) else "allow")))
    return out


def test_templates_are_those_of_a_plain_tree(spark):
    """The test pages, and made hosts: deep paths, wide nodes, similar branches and rejected templates."""
    rng = random.Random(2)
    made = [f"http://a.org/x/y/z/{w}/deep/{i}" for w in ("one", "two", "three") for i in range(12)]
    made += [f"http://a.org/x/y/z/four/{'tail/' if i % 2 else ''}end{i}" for i in range(12)] + [f"http://b.org/u/v/w/n{i}x{i}/{i}.html" for i in range(60)]
    made += [f"http://c.org/s/spam/{i}" for i in range(40)] + [f"http://c.org/s/{rng.choice('pqr')}/{i}?k" for i in range(60)] + ["http://d.org/" + "s/" * 30 + str(i) for i in range(8)]
    rules = [*RULES, *((f"c.org/s/spam/{i}", "block") for i in range(10, 35))]
    folder = Path("/root/testdata/sf0.01/pages.parquet")
    found = [r["url"] for r in spark.read.parquet(str(folder)).select("url").collect()] if folder.exists() else []
    every = [*found, *made, None, "x", "http://e.org"]
    got = urls.filtered(spark.createDataFrame(list(enumerate(every)), "page_id long, url string"), rules).orderBy("page_id").collect()
    want = plain_templates(every, rules)
    # Levels beyond the deepest are one segment.
    assert [(r["host"], r["template"], round(r["purity"], 9), r["verdict"]) for r in got if r["host"] != "d.org"] == [w for w in want if w[0] != "d.org"]
    templates = {r["template"] for r in got}
    assert "/u/v/w/*/<n>.html" in templates and any(t.startswith("/x/y/z/<open>/") for t in templates)
    assert {r["verdict"] for r in got if r["host"] == "c.org" and r["template"] == "/s/spam/<n>"} == {"block"}
    assert {r["template"] for r in got if r["host"] == "d.org"} == {"/" + "s/" * 30 + "<n>"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body><header>Site</header><nav><ul><li><a href=x>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- <p>no</p> --><main><article><h1>A &amp; B&nbsp; c</h1><p><b>First<br><p>Second  line
 &lt;x&gt; &#233;<aside>Aside</aside><form>Form</form><div class="share">Share</div><p>Third <a href="a>b">link</a> 3 < 4</p><ul><li>one<li>two</ul></article>
<section id="comments"><p>Nice!</p></section></main><footer>&copy; F</footer></body></html>"""


def test_html(spark):
    plain = "".join(f"<html><body><div class=top>Same words</div><div class=main><p>Body {i} of text</p></div><div class=links><a href=1>l{i}</a></div></body></html>" if i == -1 else "" for i in [0])
    rows = [(1, "http://h/1", PAGE), (2, None, None), (3, "http://h/2", ""), (4, "x", "plain &amp text <b>bold</b>"), (4, "x", "<p>cut <di"), (None, "u", "<p>a</p>" * 2000), (6, "u", plain)]
    got = html_text.main_text(spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")).collect()
    text = [r["text"] for r in got]
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert "A & B c\nFirst\nSecond line <x> é\nThird link 3 < 4\none\ntwo" in text
    assert "plain & text bold" in text and "cut" in text and "\n".join(["a"] * 2000) in text and text.count("") == 3
    assert html_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_template_slots(spark):
    rng = random.Random(1)
    page = lambda i: f"<html><body><div class=top>Same words</div><div class=main><p>Body {rng.random()} of text</p></div><div class=x><a href=1>l{i}</a> <a>m</a></div></body></html>"
    rows = [(i, "http://h.org/" + str(i), page(i)) for i in range(12)] + [(100, "http://one.org/", page(0))]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].startswith("Body") and "\n" not in got[i] for i in range(12)) and got[100].startswith("Same words\nBody")


def test_articles_keep_what_they_are_about():
    """Elements and names inside an article that aren't boilerplate by themselves, and some that are."""
    page = lambda x: html_text.Page(f"<html><body><nav>menu</nav><article><p>one</p>{x}<p>two</p></article></body></html>").text()
    kept = ["<math><mi>t</mi></math>", "<label>t</label>", "<svg><text>t</text></svg>", "<fieldset>t</fieldset>", *(f'<div class="{c}">t</div>' for c in ("legal", "side note", "tags", "alert", "share-price", "comment-free", "ad-hoc", "menu-prices")), '<p id="search-algorithms">t</p>']
    assert [x for x in kept if page(x) != "one\nt\ntwo"] == []
    gone = ["<form><label>t</label><fieldset>t</fieldset></form>", "<aside>t</aside>", "<footer>t</footer>", "<svg><title>t</title></svg>", *(f'<div class="x {c}">t</div>' for c in ("ad", "related-posts", "cookie-banner", "share-buttons", "site_footer", "Newsletter")), '<div id="comment-12">t</div>']
    assert [x for x in gone if page(x) != "one\ntwo"] == []


def test_a_host_without_names_is_cleaned_by_its_template(spark):
    """Articles with the same notice in each, under classes that say nothing; what only some pages have stays."""
    rng = random.Random(2)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    said = words(9)
    page = lambda i, body: f"<html><body><article><div class=q7><p class=n>{said}</p></div><div class=z><p class=t>{body}</p>{f'<p class=some>more {i}</p>' if i % 3 == 0 else ''}</div></article></body></html>"
    bodies = [words(15 + i) for i in range(10)]
    rows = [(i, f"http://names.org/{i}", page(i, b)) for i, b in enumerate(bodies)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: b + (f"\nmore {i}" if i % 3 == 0 else "") for i, b in enumerate(bodies)}


def vectors_with_copies(n=300, dims=24, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    for i in range(0, n, 5):
        x[i + 1] = x[i] + rng.normal(size=dims) * rng.uniform(0.01, 0.5)
    rows = [(i, [float(v) for v in x[i]], int(i // 5 % 4)) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    return rows + [(1000, None, 1), (1001, [0.0] * dims, 1), (1002, [nan] * dims, 1), (1003, [inf] * dims, 1), (1004, rows[0][1], None), (1005, [1.0, 2.0], 1), (None, rows[0][1], 0), (1006, [], 1), (1007, [None] * dims, 1)]


def unit(v):
    v = np.float32(v).astype(np.float64)
    return v / np.linalg.norm(v)


def test_html_slots_that_only_start_alike(spark):
    """The same 9,000 letters on every page, and then words of its own: no boilerplate. The same words to the end are."""
    notice = "the same notice again " * 410
    page = lambda i, own: f"<html><body><div class=a><p class=b>{notice}{own}</p><p class=c>page {i}</p><p class=d></p></div></body></html>"
    rows = [(i, f"http://h/{i}", page(i, f"story {i}")) for i in range(6)] + [(i, f"http://g/{i}", page(i, "")) for i in range(6, 12)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(f"story {i}" in got[i] and f"page {i}" in got[i] for i in range(6))
    assert all("notice" not in got[i] and f"page {i}" in got[i] for i in range(6, 12))



def plain_slots(pages):
    """The boilerplate slots of one host, from whole occurrence vectors."""
    read = {}
    for source in pages:
        page = html_text.Page(source)
        read.setdefault(page.content(), page)
    vectors, said, size = {}, {}, {}
    for k, page in enumerate(read.values()):
        for token, n in page.tokens.items():
            vectors.setdefault(token, {})[k] = n
            words = [b for b in page.blocks if b[1] == token]
            if words:
                said.setdefault(token, {})[k] = "\n".join(b[0] for b in words)
                letters, links = size.get(token, (0, 0))
                size[token] = letters + sum(len(b[0]) for b in words), links + sum(b[2] for b in words)
    if len(read) < html_text.LEAST_PAGES:
        return frozenset()
    classes = {}
    for token, v in vectors.items():
        classes.setdefault(tuple(sorted(v.items())), []).append(token)
    out = set()
    for v, tokens in classes.items():
        if len(tokens) >= html_text.LEAST_TOKENS and 2 * len(v) >= len(read):
            for t in tokens:
                same = len(said.get(t, {})) == len(read) and len(set(said[t].values())) == 1
                if size.get(t, (0, 0))[0] and (2 * size[t][1] > size[t][0] or same):
                    out.add(t)
    return frozenset(out)


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").is_dir(), reason="no test tables")
def test_html_is_that_of_whole_vectors(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rng, extra = random.Random(5), []
    for h in range(6):  # hosts with notices in articles, copies, and pages without articles
        for i in range(7):
            body = " ".join(f"w{rng.randrange(999)}" for _ in range(60))
            note = "<div class=k>The same note on all pages</div>" if h % 2 else f"<div class=k>{rng.random()}</div>"
            inner = f"<article><h1>t{i % 6}</h1>{note}<p>{body if i else 'short text'}</p></article>" if h < 4 else f"{note}<div class=m><p>{body}</p></div>"
            extra.append((90_000 + 10 * h + i, f"http://h{h}.org/{i}", f"<html><head></head><body><nav><a>x</a></nav>{inner}<p>more {i % 6}</p></body></html>"))
    both = pages.select("page_id", "url", "html").union(spark.createDataFrame(extra + extra[:9], "page_id long, url string, html string"))
    by_host = {}
    for r in both.collect():
        by_host.setdefault((r["url"] or "").partition("://")[2].split("/")[0].split("?")[0].split("#")[0], []).append(r)
    want, changed = [], 0
    for rows in by_host.values():
        slots = plain_slots([r["html"] or "" for r in rows])
        for r in rows:
            page = html_text.Page(r["html"] or "")
            want.append((r["page_id"], page.text(slots)))
            changed += page.text(slots) != page.text()
    got = [(r["page_id"], r["text"]) for r in html_text.main_text(both).collect()]
    assert sorted(got) == sorted(want) and changed >= 14


def test_html_copies_keep_their_text(spark):
    """Copies of one page, with or without an article; pages that differ only in a script; a notice that is most of an article."""
    words = " ".join(f"w{i}" for i in range(200))
    page = lambda inner, k=0: f"<html><head><script>track({k})</script></head><body><div class=a><div class=b>{inner}</div></div></body></html>"
    rows = [(i, "http://copies/", page(f"<p>{words}</p>")) for i in range(5)]
    rows += [(10 + i, "http://scripts/", page(f"<p>{words}</p>", i)) for i in range(5)]
    rows += [(20 + i, "http://article/", page(f"<article><p>{words}</p></article>", i)) for i in range(5)]
    rows += [(30 + i, "http://titles/", page(f"<article><h1>title {i}</h1><p>{words}</p></article>", i)) for i in range(5)]
    rows += [(40 + i, "http://tail/", page(f"<p>{'x' * 5000} {words} {i}</p>")) for i in range(5)]
    rows += [(50 + i, "http://note/", page(f"<article><h1>title {i}</h1><div>note</div><p>{words} {i}</p></article>")) for i in range(5)]
    got = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == 30 and all(words in t for t in got.values())
    assert all(f"title {i}" in got[30 + i] and "note" not in got[50 + i] and f"title {i}" in got[50 + i] for i in range(5))


def test_near_vectors(spark):
    rows = vectors_with_copies()
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, VECTORS).withColumn("n", F.lit("clash")), 0.93).collect()
    assert len(got) == len(rows)
    valid = [r for r in rows[:300]]
    u = {r[0]: unit(r[1]) for r in valid}
    links = [(a[0], b[0]) for i, a in enumerate(valid) for b in valid[i + 1 :] if a[2] == b[2] and float(u[a[0]] @ u[b[0]]) >= 0.93]
    count, root = dict.fromkeys(u, 0), {i: i for i in u}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    by_id = {r["vec_id"]: r for r in got}
    assert links and all(by_id[i]["n_links"] == count[i] and by_id[i]["component_id"] == root[i] for i in u)
    assert all(by_id[i]["n_links"] == 0 and by_id[i]["kept"] for i in range(1000, 1008)) and by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert embedding_dedup.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_tiles_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_NUMBERS", 16 * 40)
    monkeypatch.setattr(embedding_dedup, "PART", 5)
    rng = np.random.default_rng(1)
    base = rng.normal(size=40)
    rows = [(i, [float(v) for v in base + 0.01 * rng.normal(size=40)], 0) for i in range(90)] + [(0, [float(v) for v in base], 0)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r["n_links"] for r in got} == {90} and {r["component_id"] for r in got} == {0}


def test_blocks_that_lie_apart_are_not_met(spark, monkeypatch):
    """Many small blocks along a strong first axis, equal vectors among them, give the links of all pairs."""
    monkeypatch.setattr(embedding_dedup, "BLOCK_NUMBERS", 12 * 8)
    monkeypatch.setattr(embedding_dedup, "PART", 7)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(260, 8)) * [6, 1, 1, 1, 1, 1, 1, 1]
    x[100:140] = x[100]
    x[200:230] = x[0:30] + 0.2 * rng.normal(size=(30, 8))
    rows = [(i, [float(v) for v in x[i]], 1) for i in range(260)]
    u = vectors.normalised(x)
    linked = u @ u.T >= 0.93
    np.fill_diagonal(linked, False)
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert [got[i]["n_links"] for i in range(260)] == linked.sum(axis=1).tolist()
    from granary.llm import common

    assert [got[i]["component_id"] for i in range(260)] == common.local_components(linked).tolist()


def test_vectors_beyond_single_precision(spark):
    """Doubles that are no floats: their cosine counts as it is, both for links and for searches."""
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(0, [1e300, 0.0], 1), (1, [1e300, 1e299], 1), (50, [1e-300, 1e-300], 1), (3, [1.0, 1.0 + 1e-12], 1)]
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, schema), 0.93).collect()}
    assert [got[i]["component_id"] for i in (0, 1, 50, 3)] == [0, 0, 3, 3] and got[0]["n_links"] == 1
    found = nearest.nearest(spark.createDataFrame(rows, schema), 1, F.col("vec_id") % 50 == 0).collect()
    assert {r["query_id"]: r["vec_id"] for r in found} == {0: 1, 50: 3}
    close = [(0, [1.0, 0.0], 1), (1, [0.93, (1 - 0.93**2) ** 0.5 + 1e-9], 1), (2, [0.93, (1 - 0.93**2) ** 0.5 - 1e-9], 1)]
    links = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(spark.createDataFrame(close, schema), 0.93).collect()}
    assert links == {0: 1, 1: 1, 2: 2}


def test_bound_never_drops_a_pair():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(60, 40)), rng.normal(size=(50, 40))
    b[:30] = a[:30] + rng.normal(size=(30, 40)) * np.linspace(0, 1, 30)[:, None]
    basis = np.linalg.eigh(vectors.normalised(a).T @ vectors.normalised(a))[1][:, ::-1]
    want = vectors.normalised(a) @ vectors.normalised(b).T >= 0.8
    assert (embedding_dedup.close_pairs(a, b, 0.8, basis) == want).all() and want.any()


@pytest.mark.parametrize("bundle", [8192, 64])
def test_nearest(spark, monkeypatch, bundle):
    monkeypatch.setattr(nearest, "BUNDLE", bundle)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1500, 16))
    x[700:1000] = x[700]  # one vector very often
    rows = [(i, [float(v) for v in x[i]], None) for i in range(1500)] + [(5000, None, 1), (5050, [0.0] * 16, 1), (None, [1.0] * 16, 1), (5100, [1.0, 2.0], 1)]
    got = nearest.nearest(spark.createDataFrame(rows, VECTORS).withColumn("leaf", F.lit("clash")), 5, F.col("vec_id") % 50 == 0).collect()
    u = np.array([unit(r[1]) for r in rows[:1500]])
    hits = 0
    for q in range(0, 1500, 50):
        own = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        score = u @ u[q]
        score[q] = -2
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5] and all(abs(r["score"] - score[r["vec_id"]]) < 1e-12 for r in own)
        assert [(-r["score"], r["vec_id"]) for r in own] == sorted((-r["score"], r["vec_id"]) for r in own)
        best = sorted(score, reverse=True)[4]
        hits += sum(r["score"] >= best - 1e-12 for r in own)
    assert hits >= 0.9 * 150 and {r["query_id"] for r in got} == set(range(0, 1500, 50))
    assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 750), key=lambda r: r["rank"])] == [700, 701, 702, 703, 704]


def test_nearest_beyond_the_sample(spark, monkeypatch):
    """A tree fitted on a twentieth of the rows, whose large leaves are split again: recall against brute force, for rows outside the sample."""
    for name, value in {"SAMPLE": 300, "LARGE": 200, "FIT": 150, "FAN": 4, "BUNDLE": 128}.items():
        monkeypatch.setattr(nearest, name, value)
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(40, 12)) * 2
    x = centres[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 12))
    x[2000:2700] = x[2000]  # equal rows can't be split
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(6000)], "vec_id long, embedding array<double>")
    grown = []
    monkeypatch.setattr(nearest, "calibrate", lambda tree, *a, f=nearest.calibrate: (grown.append(tree.leaves), f(tree, *a))[1])
    fitted = nearest.fit(vectors.normalised(x[:300])).leaves
    got = nearest.nearest(rows, 5, F.col("vec_id") % 50 == 0).collect()
    assert grown[0] > 2 * fitted
    u, hits = vectors.normalised(x), 0
    for q in range(0, 6000, 50):
        score = u @ u[q]
        score[q] = -2
        best = np.sort(score)[-5]
        hits += sum(r["score"] >= best - 1e-12 for r in got if r["query_id"] == q)
    print("recall", hits / 600)
    assert hits >= 0.9 * 600


def test_nearest_few_and_none(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0], 1), (50, [0.0, 1.0], 1), (3, [1.0, 1.0], 1)], VECTORS)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in nearest.nearest(rows, 5, F.col("vec_id") % 50 == 0).collect()) == [(0, 1, 3), (0, 2, 50), (50, 1, 3), (50, 2, 0)]
    assert nearest.nearest(spark.createDataFrame([], VECTORS)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from test_text_operators import corpus

    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "pii", "mix", "packing"]
    now, ids = docs, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        if i < 4:
            assert now.columns == docs.columns, name
            now.write.parquet(str(tmp_path / name))
            now = spark.read.parquet(str(tmp_path / name))
            ids.append({r["doc_id"] for r in now.collect()})
    assert ids[0] == {r["doc_id"] for r in docs.collect()} and ids[1] < ids[0] and ids[2] == ids[1] and ids[3] <= ids[2]
    kept = {r["doc_id"] for r in corpus_pipeline.near_dup.near_duplicates(docs, 80).where("kept").collect()}
    assert ids[1] == kept
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count() > 0
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_entry_without_this_subpackage():
    root = Path(__file__).resolve().parents[2]
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('granary.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert e.queries() and 'pipeline' not in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
