"""Main text of web pages: page furniture by structure, template lines by differences between neighbouring pages.

A page is cut into blocks of text at block-level tags.  Blocks within
navigation, headers, footers, sidebars, forms, scripts, styles, and elements
with a class, id or role that names a menu, notice, advert or comment section are
dropped.  A name is judged whole: ``main-nav`` and ``comments-area`` are
furniture, ``has-sidebar`` and ``search-results`` are not.  Inside an article only block
elements are judged, by class and role; of ids, which are often made from
headings, only those of comment sections count there.

All other text is kept unless the nearest page repeats it.  Pages are ordered by
host and path; the lines of a page and of its partner are aligned by their
longest common subsequence, and shared lines are deleted.  Lines inside article
elements are article text, also where another page repeats them, if the
elements hold at least half of the page's text; else they may be cards or
teasers and are compared like the rest.

Copies of a page say nothing about templates, so the partner is the nearest
page that is none.  What two pages share tells copies from templates by how
common it is on the host: a line of L characters on n of the host's N pages weighs
``L * ln((N + 1) / n)``, and two pages are copies if the lines they share
weigh at least half of the lighter page.  Neighbours that are copies of each other form a run,
and one page stands for the run on either side: the partner of a page is the last
page of the run before its own or the first of the run after, that whose path
shares more leading segments (the one before on a tie; the other if that one is a
copy after all).

Pages are parsed once; their lines are stored with hashes, and only hashes and
lengths are sorted and joined.  A page's number in the order is its
partition's offset plus its place.  Texts are shuffled once, packed.

Defined results: a null html is empty and has no text; a null or unparsable
url has an empty host and is compared with nothing; a host's only page, or one
with copies alone beside it, loses no line; equal rows get equal
texts; broken or cut-off markup is read as far as it goes; a page of any length
is parsed whole, by one task; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from vaani.llm.shared import ready, stored
from vaani.llm.words import frames, slices

# Element names and words in class, id or role that mark what is not article text.
SKIPPED = frozenset("script style noscript template svg math iframe object canvas head title select option button textarea datalist".split())
CHROME = frozenset("nav header footer aside form menu dialog address figcaption".split())
ARTICLE = frozenset("article main".split())
BLOCKS = frozenset("p div section article main ul ol li dl dt dd table thead tbody tfoot tr td th blockquote pre h1 h2 h3 h4 h5 h6 hr br "
                   "figure figcaption nav header footer aside form fieldset legend details summary address body html menu dialog center caption".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
MARKS = frozenset("nav navbar navigation menu header masthead footer sidebar aside breadcrumb breadcrumbs cookie cookies consent notice notices banner "
                  "ad ads advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos promotion promotions promoted "
                  "popup modal newsletter subscribe signup login search share sharing social related recommended widget widgets "
                  "comment comments commentlist respond disqus replies pagination pager toolbar".split())
#: With a mark before them, these still name furniture.
PARTS = frozenset("area articles bar block body bottom box button buttons container content form group inner item items link links list message notice overlay "
                  "panel posts section slot stories tabs text thread title top trail unit wrap wrapper".split())
#: Before a mark, these tell of another element or a state.
STATES = frozenset("has with without no is not show hide".split())
#: Before "header", these name the page's; other headers hold titles of the text.
SITE = frozenset("site page main top global masthead".split())
#: Ids that count inside an article.
REMARKS = frozenset("comments commentlist respond disqus replies".split())
MAIN = frozenset("article main main-content post-content entry-content article-content story-content article-body post-body story-body".split())
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""(?<![\w:.-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
#: Furniture elsewhere, text inside an article.
CONTENT = frozenset("address dialog figcaption math".split())
#: What a class or role can mark as furniture inside an article.
GROUPS = frozenset("div section ul ol dl table figure fieldset details center".split())
#: Never furniture by their names.
PLAIN = frozenset("html body h1 h2 h3 h4 h5 h6 p blockquote".split())
CODE = frozenset("pre code".split())
RAW = frozenset("script style template noscript textarea title svg math iframe".split())
SPACE = re.compile(r"\s+")
HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
#: Of the weight of the lighter page: from this share on, two pages are copies.
COPY = 0.5
#: Groups into which the pages of one host, or the holders of one line, are dealt for joins.
SALTS = 32
#: Pages of a run that one row of its partner answers.
SPAN = 1024


def furniture(token: str) -> bool:
    """Whether a class, id or role (lower case, hyphens only) names page furniture."""
    parts = [p for p in token.split("-") if p and not p.isdigit()]
    if not parts or parts[0] in STATES:
        return False
    if parts[-1] in MARKS:
        return parts[-1] != "header" or len(parts) == 1 or parts[0] in SITE
    return parts[0] in MARKS and all(p in PARTS for p in parts[1:])


def _names(attributes: str) -> tuple[list[str], list[str]]:
    """Classes and roles; ids."""
    named, ids = [], []
    for key, value in ATTRIBUTE.findall(attributes):
        words = [HUMP.sub("-", w).lower().replace("_", "-") for w in value.strip("\"'").split()]
        (ids if key.lower() == "id" else named).extend(words)
    return named, ids


def _mark(name: str, attributes: str, inside: bool) -> str | None:
    """What an element is; ``inside`` an article less is furniture."""
    if (name in SKIPPED or name in CHROME) and not (inside and name in CONTENT):
        return "chrome"
    named, ids = _names(attributes) if "=" in attributes else ([], [])
    if name == "article":
        return "chrome" if any(map(furniture, named)) else "article"
    if name == "main":
        return "article"
    if inside:
        if name in GROUPS and (any(map(furniture, named)) or name != "section" and any(furniture(i) and REMARKS & set(i.split("-")) for i in ids)):
            return "chrome"
    elif name not in PLAIN and (any(map(furniture, named)) or name in GROUPS and name != "section" and any(map(furniture, ids))):
        return "chrome"
    return "article" if name in GROUPS and not MAIN.isdisjoint(named + ids) else None


def blocks(page: str) -> list[tuple[str, bool]]:
    """(text, whether it is article text by its element) of each block that is not page furniture, in order."""
    out: list[tuple[str, bool]] = []
    piece: list[str] = []
    stack: list[tuple[str, str | None]] = []
    chrome = article = code = 0
    at = 0

    def close():
        if piece:
            text = SPACE.sub(" ", html.unescape("".join(piece))).strip()
            piece.clear()
            if text:
                out.append((text, article > 0))

    while at <= len(page):
        m = TAG.search(page, at)
        if not chrome:
            piece.append(page[at:m.start() if m else len(page)])
        if not m:
            break
        at = m.end()
        if m.end() == m.start():
            break
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if name in BLOCKS or name in SKIPPED and not (article and name in CONTENT):
            close()
        if m.group(1):
            if any(n == name for n, _ in stack):
                while stack:
                    n, mark = stack.pop()
                    chrome -= mark == "chrome"
                    article -= mark == "article"
                    code -= n in CODE
                    if n == name:
                        break
        elif name not in VOID and not m.group(3).rstrip().endswith("/"):
            if name in RAW and not (article and name in CONTENT):                 # nothing in it is markup
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
                continue
            if name in ("p", "li", "tr", "td", "th", "option", "dt", "dd") and stack and stack[-1][0] == name:
                _, mark = stack.pop()       # its end tag may be left out
                chrome -= mark == "chrome"
                article -= mark == "article"
            mark = _mark(name, "" if code or name in CODE else m.group(3), article > 0)
            # page furniture inside an article is still furniture; a header of the article holds its title
            if mark == "chrome" and name == "header" and article:
                mark = None
            stack.append((name, mark))
            code += name in CODE
            chrome += mark == "chrome"
            article += mark == "article"
    close()
    # article elements that hold less than half of the text may be cards or teasers
    if 2 * sum(len(t) for t, a in out if a) < sum(len(t) for t, _ in out):
        return [(t, False) for t, _ in out]
    return out


def line_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - 2**63


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b``.

    Lines at both ends and lines that only one side has are settled first;
    the table of the rest is kept a row at a time, as bits.
    """
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    inner_a, inner_b = set(a[lo:len(a) - hi]), set(b[lo:len(b) - hi])
    left = [i for i in range(lo, len(a) - hi) if a[i] in inner_b]
    right = [x for x in b[lo:len(b) - hi] if x in inner_a]
    out = list(range(lo))
    if left and right:
        where: dict[int, int] = {}
        for j, x in enumerate(right):
            where[x] = where.get(x, 0) | 1 << j
        row, rows = 0, []
        for i in left:                      # bit j: the best for right[:j + 1] is one more than for right[:j]
            x = where[a[i]] | row
            row = x & ~(x - (row << 1 | 1)) & ((1 << len(right)) - 1) if x else 0
            rows.append(row)
        j = len(right)
        best = lambda k, n: (rows[k] & ((1 << n) - 1)).bit_count() if k >= 0 else 0        # noqa: E731
        k = len(left) - 1
        picked = []
        while k >= 0 and j > 0:
            if best(k, j) == best(k - 1, j):
                k -= 1
            elif best(k, j) == best(k, j - 1):
                j -= 1
            else:
                picked.append(left[k])
                k, j = k - 1, j - 1
        out += reversed(picked)
    return out + list(range(len(a) - hi, len(a)))


def _parsed(batches):
    """page key, page_id, url, packed lines, line hashes, line lengths, article flags."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for part in slices(batch, 3):
            rows = [blocks(h or "") for h in part.column(3).to_pylist()]
            yield pa.record_batch([
                part.column(0), part.column(1), part.column(2),
                pa.array([squeeze("\n".join(t for t, _ in r).encode()) for r in rows], pa.binary()),
                pa.array([[line_hash(t) for t, _ in r] for r in rows], pa.list_(pa.int64())),
                pa.array([[len(t) for t, _ in r] for r in rows], pa.list_(pa.int32())),
                pa.array([[a for _, a in r] for r in rows], pa.list_(pa.bool_())),
            ], ["page", "page_id", "url", "lines", "hashes", "lengths", "article"])


def _placed(batches):
    """Number the rows of a sorted partition, and weigh their lines."""
    at = 0
    for batch in batches:
        rows = batch.select(["hashes", "lengths", "often", "size"]).to_pylist()
        weights = []
        for r in rows:
            often = {x["hash"]: x["n"] for x in r["often"] or ()}
            weights.append([n * math.log((r["size"] + 1) / often.get(h, 1)) for h, n in zip(r["hashes"], r["lengths"])])
        yield pa.record_batch([
            *(batch.column(c) for c in ("page", "host", "path", "part", "hashes", "article")),
            pa.array(weights, pa.list_(pa.float64())), pa.array(np.arange(at, at + batch.num_rows)),
        ], ["page", "host", "path", "part", "hashes", "article", "weights", "place"])
        at += batch.num_rows


def copies(mine: list[int], weights: list[float], theirs: list[int], their_weights: list[float]) -> bool:
    """Whether the lines two pages share, repeats counted, weigh at least ``COPY`` of the lighter page."""
    left = Counter(theirs)
    shared = 0.0
    for h, w in zip(mine, weights):
        if left[h] > 0:
            left[h] -= 1
            shared += w
    return shared >= COPY * min(sum(weights), sum(their_weights))


def _starts(batches):
    """Number, part and whether the page begins a run: its host's first, or no copy of the page before it."""
    for batch in batches:
        out = []
        for r in batch.select(["host", "hashes", "weights", "before"]).to_pylist():
            b = r["before"]
            out.append(b is None or b["host"] != r["host"] or not copies(r["hashes"], r["weights"], b["hashes"], b["weights"]))
        yield pa.record_batch([batch.column("number"), batch.column("part"), pa.array(out, pa.bool_())], ["number", "part", "begins"])


def _likeness(a: str, b: str) -> int:
    """Leading path segments in common."""
    n = 0
    for x, y in zip(a.split("/"), b.split("/")):
        if x != y:
            break
        n += 1
    return n


def _deleted(batches):
    """Places of the lines that the partner shares and that are not article text."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            sides = [s for s in (r["before"], r["after"]) if s and s["host"] == r["host"]]
            sides.sort(key=lambda s: -_likeness(r["path"], s["path"]))
            gone = []
            for s in sides:
                if not copies(r["hashes"], r["weights"], s["hashes"], s["weights"]):
                    gone = [i for i in shared_lines(r["hashes"], s["hashes"]) if not r["article"][i]]
                    break
            out.append(gone)
        yield pa.record_batch([batch.column("page"), pa.array(out, pa.list_(pa.int32()))], ["page", "gone"])


def _finish(batches):
    for batch in batches:
        for part, pages in frames(batch, 2):
            texts = []
            for page, gone in zip(pages.to_pylist(), part.column(3).to_pylist()):
                drop = set(gone or ())
                texts.append("\n".join(t for i, t in enumerate(page.split("\n")) if i not in drop) if drop else page)
            yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                  ["page_id", "url", "text", "n_chars"])


def _ordered(lines: DataFrame) -> tuple[DataFrame, int]:
    """Pages with a host in the order of host and path, numbered, their lines weighed; how many there are."""
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    lines = lines.select("page", host.alias("host"), path.alias("path"), "hashes", "lengths", "article").where("host <> '' AND size(hashes) > 0")
    salt = F.pmod("page", F.lit(SALTS))

    def dealt(df: DataFrame) -> DataFrame:
        return df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))

    site = F.xxhash64("host").alias("site")
    sizes = dealt(lines.groupBy(site).agg(F.count("*").alias("size")))
    held = lines.select("page", site, salt.alias("salt"), F.explode(F.array_distinct("hashes")).alias("hash"))
    common = dealt(held.groupBy("site", "hash").agg(F.count("*").alias("n")).where("n > 1"))
    often = held.join(common, ["site", "hash", "salt"]).groupBy("page").agg(
        F.collect_set(F.struct("hash", "n")).alias("often"))            # at most the page's own lines
    known = (lines.withColumn("site", site).withColumn("salt", salt).join(sizes, ["site", "salt"]).drop("site", "salt").join(often, "page", "left"))
    order = ["host", "path", "page"]
    placed = stored(known.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).mapInArrow(
        _placed, "page long, host string, path string, part int, hashes array<long>, article array<boolean>, weights array<double>, place long"), "order")
    # one row for each partition
    counts = sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    offsets = lines.sparkSession.createDataFrame(offsets, "part int, base long")
    return placed.join(F.broadcast(offsets), "part").withColumn("number", F.col("base") + F.col("place")).drop("base", "place"), total


def _runs(pages: DataFrame) -> DataFrame:
    """(number, first, next): each page's number, that of its run's first page, and that of the next run's (null: none)."""
    before = pages.select((F.col("number") + 1).alias("number"), F.struct("host", "hashes", "weights").alias("before"))
    begins = stored(pages.select("number", "part", "host", "hashes", "weights").join(before, "number", "left").mapInArrow(
        _starts, "number long, part int, begins boolean"), "runs")
    start = F.when(F.col("begins"), F.col("number"))
    # one row for each partition: where its runs begin, and so what its neighbours need
    ends = sorted((r.part, r.low, r.high) for r in begins.groupBy("part").agg(F.min(start).alias("low"), F.max(start).alias("high")).collect())
    carried, last = {}, None
    for part, _, high in ends:
        carried[part] = [last, None]
        last = last if high is None else high
    following = None
    for part, low, _ in reversed(ends):
        carried[part][1] = following
        following = following if low is None else low
    carry = pages.sparkSession.createDataFrame([(p, a, b) for p, (a, b) in carried.items()], "part int, _first long, _next long")
    part = Window.partitionBy("part")                               # one range of the sort
    first = F.max(start).over(part.orderBy("number").rowsBetween(Window.unboundedPreceding, 0))
    # what follows, from the end: a frame that ends at the last row would be added up anew for every row
    following = F.min(start).over(part.orderBy(F.desc("number")).rowsBetween(Window.unboundedPreceding, -1))
    return (begins.withColumn("first", first).withColumn("next", following).join(F.broadcast(carry), "part").select(
        "number", F.coalesce("first", "_first").alias("first"), F.coalesce("next", "_next").alias("next")))


def differences(lines: DataFrame) -> DataFrame:
    """(page, gone): the places of the lines to delete, of pages that lose some."""
    ordered, total = _ordered(lines)
    runs = _runs(ordered)
    pages = ordered.join(runs, "number")
    side = F.struct("host", "path", "hashes", "weights")
    at = ordered.select("number", side.alias("side"))
    # the pages on either side of each run, once for every SPAN of its pages
    firsts = runs.where("number = first").select("first", "next")
    beside = (firsts.join(at.select((F.col("number") + 1).alias("first"), F.col("side").alias("before")), "first", "left")
              .join(at.select(F.col("number").alias("next"), F.col("side").alias("after")), "next", "left"))
    spans = F.floor((F.coalesce("next", F.lit(total)) - F.col("first") - 1) / SPAN)
    beside = beside.select("first", F.explode(F.sequence(F.lit(0).cast("long"), spans)).alias("span"), "before", "after")
    open_pages = pages.where(F.exists("article", lambda a: ~a)).withColumn("span", F.floor((F.col("number") - F.col("first")) / SPAN))
    pairs = open_pages.join(beside, ["first", "span"]).select("page", "host", "path", "hashes", "weights", "article", "before", "after")
    return (pairs.mapInArrow(_deleted, "page long, gone array<int>").where(F.size("gone") > 0)
            .groupBy("page").agg(F.min("gone").alias("gone")))


def extracted(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    ready(pages.sparkSession)
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    page = F.xxhash64("page_id", "url", F.coalesce("html", F.lit("")))
    lines = stored(known.select(page.alias("page"), "page_id", "url", "html").mapInArrow(
        _parsed, "page long, page_id long, url string, lines binary, hashes array<long>, lengths array<int>, article array<boolean>"), "lines")
    gone = stored(differences(lines), "shared")
    return (lines.select("page", "page_id", "url", "lines").join(gone, "page", "left").select("page_id", "url", "lines", "gone")
            .mapInArrow(_finish, "page_id long, url string, text string, n_chars long"))
