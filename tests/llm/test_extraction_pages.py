"""Main text of ordinary pages, and page differences against a plain version."""

import collections
import math
import random

import pytest

from vaani.llm import extraction

STORY = "<p>The story itself.</p>"


@pytest.mark.parametrize("page, lines", [
    (f'<div id="main-nav"><a>Home</a></div><div>{STORY}</div>', ["The story itself."]),
    (f'<ul class="main-menu"><li>Home</li></ul><div class="site-header">Site</div>{STORY}<div class="page-footer">f</div>', ["The story itself."]),
    (f'<article>{STORY}<div class="article-comments"><p>First!</p></div></article>', ["The story itself."]),
    (f'<article>{STORY}<div class="post-comments">x</div><ul class="related-posts"><li>y</li></ul><div id="comments">z</div></article>', ["The story itself."]),
    (f'<main>{STORY}<ol class="commentlist"><li><article class="comment">First!</article></li></ol></main>', ["The story itself."]),
    (f'<div class="content has-sidebar">{STORY}</div><div class="mainSidebar">s</div>', ["The story itself."]),
    (f'<div class="share-buttons-enabled">{STORY}</div><div class="share-buttons">Tell</div>', ["The story itself."]),
    (f'<div data-id="search">{STORY}</div><div data-class="menu" aria-role="navigation"><p>More.</p></div>', ["The story itself.", "More."]),
    (f'<div class="entry-header"><h1>Title</h1></div>{STORY}', ["Title", "The story itself."]),
    (f'<div class="search-results"><p>Found.</p></div><section id="search"><h2>Search</h2></section><h4 id="login">Login</h4>{STORY}', ["Found.", "Search", "Login", "The story itself."]),
    (f'<div class="cookie_notice">c</div><div class="ad-slot-3">a</div><div role="banner">b</div>{STORY}<div class="widget_area">w</div>', ["The story itself."]),
    (f'<p>Lead.</p><article>{STORY}<p>And its end.</p></article><div>By the desk</div>', ["Lead.", "The story itself.", "And its end.", "By the desk"]),
    ("<div " * 3 + "<p>x", ["x"]), ("", []),
])
def test_ordinary_pages(page, lines):
    assert [t for t, _ in extraction.blocks(page)] == lines


def plain(rows):
    """{page_id: text}; the pages have p elements alone, no line twice, one address each."""
    sites = collections.defaultdict(list)
    for i, url, lines in rows:
        host, path = url.removeprefix("http://").split("/", 1)
        sites[host].append(("/" + path, i, lines))
    out = {}
    for site in sites.values():
        site = sorted(p for p in site if p[2])
        held = collections.Counter(x for p in site for x in p[2])
        weigh = lambda lines: sum(len(x) * math.log((len(site) + 1) / held[x]) for x in lines)      # noqa: E731
        same = lambda a, b: weigh(set(a) & set(b)) >= 0.5 * min(weigh(a), weigh(b))                 # noqa: E731
        run = [0]
        for k in range(1, len(site)):
            run.append(run[-1] + (not same(site[k - 1][2], site[k][2])))
        for k, (path, i, lines) in enumerate(site):
            before = [j for j in range(k) if run[j] < run[k]][-1:]
            after = [j for j in range(k + 1, len(site)) if run[j] > run[k]][:1]

            def like(j):
                a, b = path.split("/"), site[j][0].split("/")
                return next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            partner = next((site[j][2] for j in sorted(before + after, key=lambda j: (-like(j), j > k)) if not same(lines, site[j][2])), [])
            rest = partner
            out[i] = "\n".join(x for x in lines if x not in rest)
    return out


def test_differences_as_a_plain_search_finds_them(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))              # noqa: E731
    line = lambda n: " ".join(word() for _ in range(n))                                             # noqa: E731
    rows, kept = [], {}
    # a site whose template outweighs its articles, with a group of copies, one of near copies, and distinct pages
    top, end = [line(40) for _ in range(3)], [line(60) for _ in range(2)]
    copy, near = [line(12) for _ in range(4)], [line(12) for _ in range(12)]
    for i in range(120):
        if 20 <= i < 50:
            body = copy
        elif 60 <= i < 90:
            body = near[:i % 12] + [line(12)] + near[i % 12 + 1:]
        else:
            body = [line(10) for _ in range(rng.randint(1, 4))]
        rows.append((i, f"http://a.example/{'xy'[i % 7 == 0]}/{i:04d}", top + body + end))
        kept[i] = "\n".join(body)
    # a site of one page, one of two copies, and small ones that share some lines
    rows += [(200, "http://b.example/1", [line(5)]), (201, "http://c.example/1", copy), (202, "http://c.example/2", copy), (203, "http://d.example/e", [])]
    for i in range(300, 340):
        shared = [line(2)] if i % 4 == 0 else shared
        rows.append((i, f"http://s{i // 4}.example/p/{rng.randint(0, 9)}/{i}", shared + [line(rng.randint(2, 20)) for _ in range(2)]))
    want = plain(rows)
    assert {i: want[i] for i in kept} == kept and want[201] == "\n".join(copy)
    pages = spark.createDataFrame([(i, u, "<div class='menu'>m</div>" + "".join(f"<p>{x}</p>" for x in lines)) for i, u, lines in rows], "page_id long, url string, html string")
    for span in (1024, 3):
        monkeypatch.setattr(extraction, "SPAN", span)
        got = {r.page_id: r.text for r in extraction.extracted(pages.repartition(5)).collect()}
        assert got == want | {203: ""}
