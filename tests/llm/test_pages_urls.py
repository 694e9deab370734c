"""HTML extraction and URL filter on fixtures and by brute force of the rules."""

from __future__ import annotations

import random

import pytest

from tabsmith.llm import html_extract, url_filter
from tabsmith.llm.queries import ALLOW_RULES, BLOCK_RULES, LLM_QUERIES

from .conftest import SF

ARTICLE = "Some words, and more of them, so that this is a real paragraph of an article."
PAGE = f"""<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p><p>no";</script></head>
<body><header><h2>Site no</h2></header><nav><ul><li><a href="/a">Menu no</a></li></ul></nav><!-- no <p>no</p> -->
<div class="cookie-notice"><p>{ARTICLE.replace('Some', 'Cookie no')}</p></div><div id="sidebar"><p>no {ARTICLE}</p></div>
<div class="main-content"><article><h1>Title &amp; more</h1><p><b>First&nbsp;part. {ARTICLE}<br><p>Second &#233;t&eacute; {ARTICLE}
 over   lines</p><p>Third.</p><ul><li>One item, with text in it</li></ul><blockquote>Quote. {ARTICLE}</blockquote>
<div class="ad">no {ARTICLE}</div><form><p>no {ARTICLE}</p></form></article>
<section class="comments"><p>no {ARTICLE}</p></section></div><footer>&copy; no</footer></body></html>"""


def test_article_is_kept_and_the_rest_goes():
    assert html_extract.main_text(PAGE).split("\n") == [
        "Title & more", f"First part. {ARTICLE}", f"Second été {ARTICLE} over lines", "Third.", "One item, with text in it", f"Quote. {ARTICLE}"]


def test_broken_and_odd_pages():
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<p>") == ""
    assert html_extract.main_text("just text &lt;b&gt; a < b") == "just text <b> a < b"
    assert html_extract.main_text(f"<article><p>{ARTICLE}</p><p>cut of") == f"{ARTICLE}\ncut of"
    assert html_extract.main_text(f"<article><p>{ARTICLE}</p><p>x<a hre") == f"{ARTICLE}\nx"
    assert html_extract.main_text("<div>" * 5000 + ARTICLE) == ARTICLE
    assert html_extract.main_text("</p></div>" * 100 + f"<p>{ARTICLE}") == ARTICLE
    long = f"<article>{''.join(f'<p>{ARTICLE} {i}</p>' for i in range(3000))}</article>"
    assert html_extract.main_text(long).count("\n") == 2999


LONG = "".join(f"<p>{ARTICLE} {ARTICLE} {i}</p>" for i in range(12))
SHORT = "<h2>Short {0}</h2><p>Short section {0}, and it is still a part of the article. " + "It goes on. " * 12 + "</p>"
NAV = '<nav><a href="/">Menu no</a></nav>'


def test_all_of_an_article_in_sections_is_kept():
    page = f"""<body>{NAV}<article><h1>Title</h1><p>Lead.</p><section>{LONG}</section>Bare <b>text</b>
<section>{SHORT.format(1)}</section><section>{SHORT.format(2)}</section><h3>Few</h3><ul><li>Point</li></ul><pre>code()</pre>
<table><tr><td>Cell</td></tr></table><blockquote>Said.</blockquote><h2>References</h2>
<ol><li><a href="/r">A reference of the article, by its author</a></li></ol><div class="share">no</div></article><div>no {ARTICLE[:30]}</div></body>"""
    text = html_extract.main_text(page)
    lines = text.split("\n")
    assert lines[:2] == ["Title", "Lead."] and lines[-4:] == ["Cell", "Said.", "References", "A reference of the article, by its author"]
    assert {"Bare text", "Short 1", "Short 2", "Few", "Point", "code()"} <= set(lines)
    assert sum(x.startswith("Short section") for x in lines) == 2 and "no" not in text.lower().split()
    assert html_extract.main_text(page.replace("article>", "main>")) == text


def test_sections_beside_each_other_are_kept_without_an_article():
    page = f"""<body>{NAV}<div class="page-body"><h2>One</h2><section>{LONG}</section><h2>Two</h2>Bare <i>text</i><p>Brief.</p>
<ul><li>Point</li></ul><ul><li><a href="/m">Link no</a></li></ul><section>{SHORT.format(3)}</section></div><div>no</div></body>"""
    lines = html_extract.main_text(page).split("\n")
    assert lines[0] == "One" and lines[-6:-1] == ["Two", "Bare text", "Brief.", "Point", "Short 3"]
    assert lines[-1].startswith("Short section 3") and not any("no" in x.split() for x in lines)


def test_references_without_an_article_are_kept_and_menus_go():
    page = f"""<body>{NAV}<div>{LONG}<h2>References</h2><ol><li><a href="/r">A reference of the text, by its author</a></li></ol>
<ul><li><a href="/m">Link no</a></li><li><a href="/m">More no</a></li></ul></div></body>"""
    lines = html_extract.main_text(page).split("\n")
    assert lines[-2:] == ["References", "A reference of the text, by its author"] and not any("no" in x.split() for x in lines)


FULL = f"<p>{ARTICLE} {ARTICLE} {ARTICLE}</p>"


@pytest.mark.parametrize("part, kept", [
    (f'<section id="social-history">{FULL}</section>', True), (f'<section class="search-algorithms">{FULL}</section>', True),
    ('<p class="hidden-gem">A gem of a line.</p>', True), ('<div class="header"><h2>Heading</h2></div>', True),
    (f'<section id="social">{FULL}</section>', True), (f'<div class="notice">{FULL}</div>', True), (f'<div class="ad-theory">{FULL}</div>', True),
    ('<div class="share">Tweet this</div>', False), (f'<div class="comments">{FULL}</div>', False), (f'<div id="comment-list">{FULL}</div>', False),
    ('<div class="entry-footer">Filed under things</div>', False), (f'<div class="sidebar-left">{FULL}</div>', False),
    (f'<div class="AdBox">{FULL}</div>', False), (f'<div class="site-nav wide">{FULL}</div>', False)])
def test_names_decide_only_where_they_have_no_topic(part, kept):
    """A class or id drops an article's part only if it is made of boilerplate words, and not what may be a topic and holds paragraphs."""
    with_part, without = (html_extract.main_text(f"<body>{NAV}<article><h1>Title</h1>{FULL}{x}{FULL}</article></body>") for x in (part, ""))
    assert (with_part != without) == kept and len(with_part) >= len(without)


def test_wrappers_with_content_stay_and_footers_go():
    page = f"""<body><div class="content-sidebar-wrap"><h1>A title</h1><div class="entry-content">{FULL * 3}</div>
<div class="entry-footer">Posted no</div><div class="sidebar">no {FULL}</div></div></body>"""
    lines = html_extract.main_text(page).split("\n")
    assert lines[0] == "A title" and len(lines) == 4 and "no" not in " ".join(lines).split()


def test_what_closes_the_main_container_is_kept():
    page = f"<body>{NAV}<div>{FULL * 3}</div><h2>Then</h2><p>A short end.</p><p>© 2020 no</p><p>no</p></body>"
    assert html_extract.main_text(page).split("\n")[-2:] == ["Then", "A short end."]
    two = f"<body>{NAV}<main><article>{FULL * 3}</article><article><p>Short second.</p></article></main></body>"
    assert html_extract.main_text(two).split("\n")[-1] == "Short second."


def brute_scores(root):
    """Points of every element, each paragraph handed up its chain of ancestors one by one."""
    score, queue = {}, [root]
    while queue:
        node = queue.pop()
        queue += [p for p in node.parts if not isinstance(p, str)]
        text = " ".join(html_extract.own_text(node).split())
        if node.tag not in html_extract.BLOCK or node.tag in html_extract.HEADINGS or len(text) < 25:
            continue
        target = node.parent if node.tag in ("p", "pre", "li", "td", "th", "dd", "dt", "blockquote") else node
        for share in (1, 1 / 2, 1 / 6, 1 / 9, 1 / 12):
            if target is not None:
                score[id(target)] = score.get(id(target), 0) + share * (1 + text.count(",") + min(len(text) / 100, 3))
                target = target.parent
    return score


def brute_density(node):
    """Share of a node's characters inside links, from its list of texts."""
    def texts(n, linked):
        for p in n.parts:
            if isinstance(p, str):
                yield (0 if p.isspace() else len(p)), linked
            else:
                yield from texts(p, linked or p.tag == "a")

    found = list(texts(node, node.tag == "a"))
    return sum(n for n, linked in found if linked) / max(1, sum(n for n, _ in found))


@pytest.mark.parametrize("seed", range(8))
def test_container_choice_equals_brute_force(seed):
    pick = random.Random(seed)

    def tree(depth):
        if depth == 0 or pick.random() < 0.25:
            words = ARTICLE[:pick.randrange(10, len(ARTICLE))] * pick.randrange(1, 6)
            return f"<p>{words}</p>" if pick.random() < 0.7 else f"<p><a href='/'>{words}</a> and so on</p>"
        tag = pick.choice(["div", "section", "td", "ul", "blockquote"])
        return f"<{tag}>{''.join(tree(depth - 1) for _ in range(pick.randrange(1, 5)))}</{tag}>"

    root = html_extract.parse(f"<body>{tree(5)}</body>")
    html_extract.measure(root)
    html_extract.pass_points(root)
    scores, nodes, queue = brute_scores(root), [], [root]
    while queue:
        nodes.append(queue.pop())
        queue += [p for p in nodes[-1].parts if not isinstance(p, str)]
    for node in nodes:
        assert abs(node.score - scores.get(id(node), 0)) < 1e-9 and abs(html_extract.link_density(node) - brute_density(node)) < 1e-9
    top = max(scores.get(id(n), 0) * (1 - brute_density(n)) for n in nodes)
    best = html_extract.best_container(root)
    assert (best is None and top <= 0) or abs(scores[id(best)] * (1 - brute_density(best)) - top) < 1e-9


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x", 5), (1, "u", PAGE, "x", 5), (None, None, None, "x", 5)],
                               "page_id long, url string, html string, text string, n_chars long")
    rows = html_extract.extract(df).collect()
    assert rows[0] == rows[1] and (rows[2]["text"], rows[2]["n_chars"], rows[2]["page_id"]) == ("", 0, None)
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html_extract.extract(df.limit(0)).count() == 0


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url[url.index("://") + 3:]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = []
    for rules, verdict in ((ALLOW_RULES, "allow"), (BLOCK_RULES, "block")):
        for r in rules:
            h, p = r[:r.index("/")], r[r.index("/"):]
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                fits.append((len(r), verdict, r))
    best = max(fits, default=(0, None, None))
    return host, path, best[2], best[1]


def test_rules_win_and_others_are_judged(spark):
    table = [r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    urls = table + [None, "", "no scheme", "http://", "HTTP://A.B.ORG", "http://x.org/?q=://y", "http://Ä.Example.ORG/es/1#f",
                    "http://example.org/es", "ftp://u:p@x.com:80/de/", "http://com/de/x", "a://b://org/", "http://xorg/", "http://org/" + "x" * 5000]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' as rule", "'y' as host", "1 as bucket")
    rows = {r["page_id"]: r for r in url_filter.judge_urls(df, ALLOW_RULES, BLOCK_RULES).collect()}
    assert len(rows) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, verdict = brute_rule(url)
        r = rows[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    ruled = [r for r in rows.values() if r["rule"]]
    means = {v: sum(r["score"] for r in ruled if r["verdict"] == v) / max(1, sum(r["verdict"] == v for r in ruled)) for v in ("allow", "block")}
    assert means["allow"] > means["block"] + 0.2
    assert url_filter.judge_urls(df.limit(0), ALLOW_RULES, BLOCK_RULES).count() == 0


def test_score_is_the_longest_context_ratio(spark):
    """The telescoped sum equals walking the URL with the model by hand."""
    import math
    from collections import Counter

    texts = [("\u0002abcab", True), ("\u0002abd", True), ("\u0002bca", False), ("\u0002ccc", False)]
    model = url_filter.train(spark.createDataFrame(texts, "marked string, accepted boolean"))
    counts = {True: Counter(), False: Counter()}
    for text, kind in texts:
        for end in range(2, len(text) + 1):
            for n in range(1, min(url_filter.ORDER + 1, end) + 1):
                counts[kind][text[end - n:end]] += 1

    def ratio(gram):
        p = {}
        for kind in (True, False):
            value = 1 / url_filter.ALPHABET
            for n in range(1, len(gram) + 1):
                g = gram[len(gram) - n:]
                context = sum(c for k, c in counts[kind].items() if len(k) == n and k[:-1] == g[:-1])
                value = (counts[kind][g] + url_filter.PRIOR * value) / (context + url_filter.PRIOR)
            p[kind] = value
        return math.log(p[True] / p[False])

    url = "\u0002abca"
    total = 0.0
    for end in range(2, len(url) + 1):
        grams = [url[end - n:end] for n in range(1, min(url_filter.ORDER + 1, end) + 1)]
        seen = [g for g in grams if counts[True][g] + counts[False][g]]
        total += ratio(seen[-1]) if seen else 0.0
    got = url_filter.score(spark.createDataFrame([(url,)], "marked string"), model, []).collect()[0]["score"]
    assert abs(got - total / (len(url) - 1)) < 1e-9


def test_grams_that_training_never_saw_give_nothing(spark):
    """However many grams the model holds, each one is told from all others."""
    import random

    rng = random.Random(5)
    letters = [chr(c) for c in range(0x100, 0x180)]
    texts = [("\u0002" + "".join(rng.choices(letters, k=100)), k % 2 == 0) for k in range(500)]
    seen = {t[end - n:end] for t, _ in texts for end in range(2, len(t) + 1) for n in range(1, min(url_filter.ORDER + 1, end) + 1)}
    model = url_filter.train(spark.createDataFrame(texts, "marked string, accepted boolean"))
    assert len(seen) > 100_000 and model.count() == len(seen)
    unseen = [("\u0002" + "".join(chr(0x4E00 + 40 * i + k) for k in range(40)), i) for i in range(20)]
    urls = spark.createDataFrame([*unseen, ("", 20), (None, 21), (texts[0][0], 22)], "marked string, n int")
    got = {r["n"]: r["score"] for r in url_filter.score(urls, model, ["n"]).collect()}
    assert len(got) == 23 and {got[i] for i in range(22)} == {0.0} and got[22] > 0


def test_registered():
    assert {"op4_html_extract", "op5_url_filter"} <= set(LLM_QUERIES)
