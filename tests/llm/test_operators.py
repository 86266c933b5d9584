"""Operators against brute force on rows with nulls, empty and long texts, ties, repeats and clashing names."""

import collections
import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest_rows import hard_rows
from vaani.llm import decontamination, extraction, jaccard, licences, mixing, quality, secrets, substrings, toxicity, warc

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ROWS, ITEMS = hard_rows()


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def bag(rows):
    return collections.Counter(map(tuple, rows))


def in_duckdb(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return con.execute(sql).fetchall()


def test_decontamination(docs, bench, nothing):
    grams = collections.defaultdict(set)
    for i, t in ITEMS:
        w = ALNUM.findall(lower(t))
        for k in range(max(1, len(w) - 9) if w else 0):
            grams[tuple(w[k:k + 10])].update([] if i is None else [str(i)])
    want = []
    for r in ROWS:
        w, hit, items = ALNUM.findall(lower(r[1])), set(), set()
        for g, ids in grams.items():
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    items |= ids
        want.append((r[0], len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    for block in (decontamination.BLOCK, 7):
        got = decontamination.contamination(docs, bench, block=block).drop("items", "n_near", "near_items").collect()
        assert bag(got) == bag(want)
    assert sum(x[5] for x in want) == 3
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3
    assert decontamination.contamination(nothing, bench).count() == 0
    assert decontamination.contamination(docs, bench.limit(0)).where("contaminated").count() == 0


def test_proximity(spark):
    d = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "gamma beta alpha"), (3, "alpha beta"), (4, "alpha " + "y " * 20 + "beta gamma")], "doc_id long, text string")
    b = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    got = {r.doc_id: (r.items, r.near) for r in decontamination.matches(d, b, slop=2).collect()}
    assert got == {1: ([], ["7"]), 2: ([], ["7"]), 3: ([], []), 4: ([], [])}


def test_jaccard(docs, nothing):
    def shingles(t):
        w = BLANK.findall(t or "")
        return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else None
    ids = [10**9 if r[0] is None else r[0] for r in ROWS]
    sets = [shingles(r[1]) for r in ROWS]
    first, size = {}, collections.Counter()
    for i, s in sorted(zip(ids, sets), key=lambda x: x[0]):
        if s is not None:
            first.setdefault(s, i)
            size[s] += 1
    reps = list(first)
    near = {a: [b for b in reps if b != a and len(a & b) >= 0.8 * len(a | b)] for a in reps}

    def group(s):
        seen, todo = {s}, [s]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        return min(first[x] for x in seen)
    show = lambda i: None if i == 10**9 else i
    want = [(r[0], show(first[s]) if s is not None else r[0], size[s] if s is not None else 1, len(near[s]) if s is not None else 0, show(group(s)) if s is not None else r[0])
            for r, s in zip(ROWS, sets)]
    assert bag(jaccard.classes_and_links(docs).collect()) == bag(want)
    assert sum(w[3] for w in want) > 4
    kept = jaccard.distinct_documents(docs)
    groups = {group(s) for s in sets if s is not None}
    assert kept.columns == docs.columns
    assert kept.count() == len(groups) + sum(s is None for s in sets)
    assert jaccard.classes_and_links(nothing).count() == 0 and jaccard.distinct_documents(nothing).count() == 0


def test_chosen_paths_find_a_hot_family(spark, monkeypatch):
    """Buckets above the limit are split on, and in the end compared in blocks: no link is lost."""
    monkeypatch.setattr(jaccard, "BUCKET", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    words = [f"w{i}" for i in range(120)]
    d = spark.createDataFrame([(i, " ".join(words[:i] + ["new"] + words[i + 1:])) for i in range(40)], "doc_id long, text string")
    sets = [frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) for w in (words[:i] + ["new"] + words[i + 1:] for i in range(40))]
    want = {i: sum(len(a & b) >= 0.8 * len(a | b) for b in sets) - 1 for i, a in enumerate(sets)}
    got = {r.doc_id: (r.n_links, r.group_id) for r in jaccard.classes_and_links(d).collect()}
    assert got == {i: (n, 0) for i, n in want.items()}


def test_licences(docs, nothing):
    got = licences.scan(docs).collect()
    assert bag(got) == bag(in_duckdb(licences.oracle(), documents=docs.select("doc_id", "text")))
    assert [r.licences for r in got if r.n_matches] == ["MIT"]
    assert licences.scan(nothing).count() == 0


MIT_TEXT = """The MIT License

Copyright (c) 2019 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
APACHE_TEXT = """#!/bin/sh
#
# Copyright 2020 Some Company, Inc.
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
GPL2_TEXT = """/* tool.c
 *
 * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 *
 * You should have received a copy of the GNU General Public License
 * along with this program; if not, write to the Free Software
 * Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA. */
"""
BSD2_TEXT = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
  * Redistributions of source code must retain the above copyright
    notice, this list of conditions and the following disclaimer.
  * Redistributions in binary form must reproduce the above copyright
    notice, this list of conditions and the following disclaimer in the
    documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT OWNER OR CONTRIBUTORS BE LIABLE FOR
ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""


def test_standard_licence_texts(spark):
    bsd3 = BSD2_TEXT.replace("THIS SOFTWARE IS", "  * Neither the name of Foo nor the names of its contributors may be used to\n    endorse or promote "
                             "products derived from this software without\n    specific prior written permission.\nTHIS SOFTWARE IS", 1)
    shared = "Copyright 2020 X. All rights reserved. Licensed under the Apache License, Version 2.0. See the manual for more about the tool."
    rows = [(1, MIT_TEXT), (2, APACHE_TEXT), (3, GPL2_TEXT), (4, BSD2_TEXT), (5, bsd3), (6, shared), (7, None), (8, "one"), (9, ""), (10, "the use of the software " * 300),
            (11, "some prose\n" * 40 + "int main() {} " + MIT_TEXT.replace("\n", " ") + " more of it" * 50), (12, shared + "\n" + MIT_TEXT)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {1: "MIT", 2: "Apache-2.0", 3: "GPL-2.0", 4: "BSD-2-Clause", 5: "BSD-3-Clause", 7: "", 8: "", 9: "", 10: ""}
    got = licences.scan(d).collect()
    assert bag(got) == bag(in_duckdb(licences.oracle(), documents=d))
    assert {i: {r.doc_id: r.best or "" for r in got}[i] for i in want} == want
    inside = {r.doc_id: (r.licences, r.best or "") for r in licences.windows(d).collect()}
    assert inside == {**{i: (n, n) for i, n in want.items()}, 6: ("Apache-2.0", "Apache-2.0"), 11: ("MIT", "MIT"), 12: ("Apache-2.0,MIT", "Apache-2.0")}
    assert licences.windows(d.limit(0)).count() == 0


def test_warc(spark):
    big = "x" * 1200
    rows = [(1, "http://a/1", "<p>WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n" + big), (2, "http://a/2", None), (3, None, big),
            (4, "u\n x", big), (None, "n", big), (5, "http://a/5", "WARC/1.1\r\n"), (6, "e", warc.record(9, "z", "fake") + "\r\n" + warc.record(10, "z", big)),
            (7, "x", big), (7, "x", big), (8, "é", "é" * 500), (9, "y", "é" * 500), (10, "z", "é" * 499)]
    pages = spark.createDataFrame([(*r, 0, "d") for r in rows], "page_id long, url string, html string, page int, digest string").repartition(3)
    want = bag(in_duckdb(warc.ORACLE, pages=pages.select("page_id", "html")))
    assert bag(warc.round_trip(pages).collect()) == want
    assert sum(n for r, n in want.items() if r[3] == "revisit") == 4
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")      # records lie across splits
    try:
        assert bag(warc.round_trip(pages.coalesce(1)).collect()) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_secrets(docs, nothing):
    got = secrets.scan(docs).collect()
    every = dict.fromkeys(secrets.KINDS, True)
    want = [(r[0], secrets._written(sorted(secrets.base_spans(r[1] or "", every)))) for r in ROWS]
    assert bag((r.doc_id, r.base_sha256) for r in got) == bag((i, hashlib.sha256(s.encode()).hexdigest()) for i, s in want)
    assert next(s for i, s in want if i == 15) == "assign:0:49,hex:9:49,access:53:71"
    clean = secrets.redacted(docs)
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    assert clean.where("doc_id = 15").first().text == '[secret]" é [secret]'
    assert bag(clean.where("doc_id <> 15").collect()) == bag(docs.where("doc_id <> 15").collect())
    assert secrets.scan(nothing).count() == 0


def test_base_patterns_as_written():
    every = dict.fromkeys(secrets.KINDS, True)
    spans = lambda t: secrets._written(sorted(secrets.base_spans(t, every)))
    assert spans("PASSWORD=12345678") == "assign:0:17" and spans("password=1234567") == ""
    assert spans("api_key' : 'abcdefgh'") == "assign:0:20" and spans("toKen=abcdefgh") == ""
    assert spans("AKIA" + "A" * 11) == "" and spans("é AKIA" + "A" * 12) == "access:2:18"
    assert spans("f" * 31) == "" and spans("g" + "f" * 32 + "g") == "hex:1:33"


def test_random_runs_inside_base_spans():
    """With every run a discovery, those that one base span holds whole are left to it."""
    rules = object.__new__(secrets.Rules)
    rules.known, rules.level = {}, dict.fromkeys(range(len(secrets.BANDS)), 0.0)
    run, f = "Zx9" * 8, "f" * 40
    for text in (f"{run} token={run} {run}", f"token={f} {f}g{run}", f"token=ab-{f}{run}", run, "é" + f):
        base = secrets.base_spans(text, dict.fromkeys(secrets.KINDS, True))
        want = [(a, 3, b) for a, b, _ in secrets.candidates(text) if not any(s <= a and b <= e for s, _, e in base)]
        got = rules.spans(text, dict.fromkeys(secrets.KINDS, True))
        assert got == (sorted(base), sorted(base + want))


def test_randomness():
    import random
    rng = random.Random(2)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(200)]
    words = ["".join(rng.choice(["the", "ing", "er", "tion", "an"]) for _ in range(8))[:24] for _ in range(200)]
    db = lambda r: secrets.p_decibels(secrets.statistics(r)[1], secrets.PRIOR, len(r))
    mean = lambda rs: sum(map(db, rs)) / len(rs)
    assert mean(hexes) > mean(words) + 8 and db("ab12" * 8) < 10
    assert secrets.benjamini_hochberg({(0, 100): 10, (0, 2): 990})[0] == 50.0
    assert secrets.benjamini_hochberg({(0, 2): 990})[0] == float("inf")


def ordinary_runs(rng, n, count):
    """Paths, identifiers, constants, names, numbers and joined words of ``n`` characters at least."""
    words = ("the quick brown fox jumps over lazy dog water people market Zeitung wieder Haus Strasse maison toujours enfant ciudad trabajo user name file path "
             "http client error handler index table column value test data model config service").split()
    styles = (lambda w: "/".join(w), lambda w: "-".join(w), lambda w: "_".join(w).upper(), lambda w: w[0] + "".join(x.title() for x in w[1:]),
              lambda w: "".join(w).lower(), lambda w: "_".join(w) + f"_{rng.randrange(2000, 2030)}", lambda w: "ab" * n, lambda w: "-" * n)
    out = []
    while len(out) < count:
        w = [rng.choice(words) for _ in range(n // 4 + 2)]
        while len("".join(w[:-1])) > n + 4:
            w.pop()
        run = styles[len(out) % len(styles)](w)
        out.append(run)
    return out


def test_secrets_finds_random_keys_of_usual_length(spark):
    """Keys outside the base patterns, one in fifty of the candidates, at each length."""
    import random
    rng = random.Random(7)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys, rows = {}, []
    for n in (20, 32, 40, 64):
        runs = ordinary_runs(rng, n, 980) + ["".join(rng.choice(alphabet) for _ in range(n)) for _ in range(20)]
        rows += [(1000 * n + i, f"see the {run} in the people of the market") for i, run in enumerate(runs)]
        keys[n] = {1000 * n + i for i in range(980, 1000)}
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert not [r for i, r in got.items() if r.n_random and not any(i in k for k in keys.values())]
    recall = {n: sum(got[i].n_random for i in ids) / len(ids) for n, ids in keys.items()}
    assert recall[20] >= 0.8 and min(recall[n] for n in (32, 40, 64)) >= 0.95
    assert all(got[i].spans == f"random:8:{8 + n}" for n, ids in keys.items() for i in ids if got[i].n_random)


def test_toxicity_on_hard_rows(docs, labels, nothing):
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    by_text = collections.defaultdict(set)
    for r, row in zip(sorted(got, key=lambda r: str(r.doc_id)), sorted(ROWS, key=lambda r: str(r[0]))):
        if r.doc_id is not None:
            by_text[row[1]].add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(r.score == 0 for r in toxicity.scored(docs, labels.limit(0)).collect())
    assert toxicity.scored(nothing, labels).count() == 0 and toxicity.accepted(docs, labels.limit(0)).count() == len(ROWS)


def test_toxicity_jobs_do_not_follow_the_partitions(spark, docs, labels):
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    plain = {r.doc_id: r.score for r in toxicity.scored(docs, labels).collect()}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("toxicity-jobs", "")
        scorer = toxicity.Scorer(docs, labels)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("toxicity-jobs")
        assert scorer.ready and len(jobs) < 100         # one for each table and partition were 280
        assert {r.doc_id: r.score for r in toxicity.scored(docs, labels).collect()} == plain
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)


def test_extraction(spark):
    page = lambda body: f"<html><body><div class='menu'>Home</div><nav>n</nav>{body}<footer>f</footer></body></html>"
    rows = [(i, f"http://h.example/a/b{i}", page(f"<p>Subscribe now</p><p>story {i} &amp; more\n text {'and more ' * 9}</p><div>Terms of use</div>")) for i in range(4)]
    rows += [(4, "http://one.example/x", page("<p>alone</p>")), (5, None, "<p>no host</p>"), (6, "http://h.example/z", None), (7, "http://h.example/zz", ""),
             (8, "http://c.example/1", page("<p>copy of all</p>")), (9, "http://c.example/2", page("<p>copy of all</p>")),
             (10, "http://h.example/art", "<article><header><h1>T</h1></header><p>a<p>b<script>x('</p>')</script><aside>s</aside></article><p>out</p>"), (11, "u", "text &lt;b&gt; <b>bold</b")]
    pages = spark.createDataFrame([*rows, rows[5]], "page_id long, url string, html string").repartition(3)
    got = collections.Counter((r.page_id, r.text, r.n_chars) for r in extraction.extracted(pages).collect())
    texts = {k[0]: k[1] for k in got}
    assert all(texts[i] == f"story {i} & more text " + " ".join(["and more"] * 9) for i in range(4))
    assert texts[4] == "alone" and texts[5] == "no host" and texts[6] == texts[7] == "" and texts[8] == texts[9] == "copy of all"
    assert texts[10] == "T\na\nb\nout" and texts[11].startswith("text <b> bold")
    assert sum(got.values()) == 13 and all(k[2] == len(k[1]) for k in got)
    assert extraction.extracted(pages.limit(0)).count() == 0


def test_marks_inside_an_article_leave_its_text():
    text = lambda body: [t for t, _ in extraction.blocks(f"<nav>n</nav><article>{body}</article>")]
    assert text('<section id="search"><h2>Search</h2><p>how it works</p></section>') == ["Search", "how it works"]
    assert text('<div id="related-work"><p>others</p></div><h4 id="login">Login</h4>') == ["others", "Login"]
    assert text('<blockquote class="share">said</blockquote><p>a <span class="share">b</span></p>') == ["said", "a b"]
    assert text('<pre><code>x = 1 <span class="hljs-comment"># one</span> <span class="token comment"># two</span></code></pre>') == ["x = 1 # one # two"]
    assert text('<figure><figcaption>seen</figcaption></figure><address>street</address><p>if <math><mi>x</mi></math> is</p><dialog>d</dialog>') == ["seen", "street", "if x is", "d"]
    assert text('<p>t</p><div class="share">tell</div><section class="comments">c</section><div role="navigation">n</div><aside>s</aside><form>f</form>') == ["t"]
    assert text("<p>t</p><math><mi>y</mi>") == ["t", "y"]
    outside = extraction.blocks('<div class="menu">m</div><pre>y <span class="token comment"># z</span></pre><address>a</address>')
    assert outside == [("y # z", False)]


def test_a_teaser_is_not_the_article(spark):
    card = '<article class="teaser"><p>Read our other story</p></article>'
    page = lambda i: f"<div><p>story {i} {f'and more of {i} ' * 9}</p><p>its end {i}</p></div>{card}<div>Terms of use</div>"
    pages = spark.createDataFrame([(i, f"http://h.example/a/b{i}", page(i)) for i in range(4)], "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in extraction.extracted(pages).collect()}
    assert got == {i: f"story {i} {f'and more of {i} ' * 9}".strip() + f"\nits end {i}" for i in range(4)}
    assert extraction.blocks(page(1))[-2:] == [("Read our other story", False), ("Terms of use", False)]
    assert extraction.blocks("<p>x</p><article><p>long enough</p></article>") == [("x", False), ("long enough", True)]


def test_longest_common_subsequences():
    import random
    rng = random.Random(3)

    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
            row = new
        return row[-1]
    for _ in range(2000):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(9))] for _ in range(2))
        places = extraction.shared_lines(a, b)
        rest = iter(b)
        assert places == sorted(set(places)) and len(places) == length(a, b) and all(a[i] in rest for i in places)


def test_quality(docs, labels, nothing):
    want = []
    for r in ROWS:
        t = r[1] or ""
        w = BLANK.findall(t)
        count = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        again = {p for k in range(len(w) - 4) if count[tuple(w[k:k + 5])] > 1 for p in range(k, k + 5)}
        lines = [x for x in t.split("\n") if BLANK.search(x)]
        want.append((r[0], len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), len(w) < 10 or 100 * len(again) > 20 * len(w)))
    got = quality.verdicts(docs, labels).collect()
    assert bag((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == bag(want)
    assert not any(r.kept and r.base_failed for r in got)
    assert all(r.kept != r.base_failed for r in quality.verdicts(docs, labels.limit(0)).collect())
    assert quality.verdicts(nothing, labels).count() == 0


def test_mixing(docs, nothing):
    got = mixing.mix(docs)
    assert bag(got.drop("copies").collect()) == bag(in_duckdb(mixing.ORACLE, documents=docs.select("doc_id", "text", "source")))
    assert all(r.taken <= 2 * r.size for r in got.collect()) and bag(got.collect()) == bag(mixing.mix(docs.repartition(5)).collect())
    mixed = mixing.mixed(docs.withColumnRenamed("label", "mix_copies"))
    assert mixed.columns == [*docs.columns[:-1], "mix_copies", "_mix_copies"]
    assert mixing.mix(nothing).count() == 0 and mixing.mixed(nothing).count() == 0


def test_mixing_numbers_equal_rows(spark):
    rows = [(1, "a b c d", "s")] * 50 + [(2, "x y", "t")] * 30
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)).collect()
    for s in ({r.doc_id: r.target for r in got}).items():
        assert abs(sum(r.taken for r in got if r.doc_id == s[0]) - s[1]) <= 2


def test_substrings(docs, nothing):
    first = {}
    for r in ROWS:
        w = BLANK.findall(r[1] or "")
        for k in range(len(w) - 12):
            if r[0] is not None:
                g = tuple(w[k:k + 13])
                first[g] = min(first.get(g, r[0]), r[0])
    want = []
    for r in ROWS:
        w = BLANK.findall(r[1] or "")
        gone = {p for k in range(len(w) - 12) if r[0] is not None and first[tuple(w[k:k + 13])] < r[0] for p in range(k, k + 13)}
        want.append((r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    rows = substrings.deduplicated(docs).collect()
    assert bag((r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows) == bag(want)
    assert all(sum(e - s for s, e in zip(r.starts, r.ends)) == r.n_removed for r in rows) and sum(w[2] for w in want) > 300
    assert substrings.deduplicated(nothing).count() == 0


def test_pipeline(spark, docs, bench, labels, tmp_path):
    import corpus_pipeline
    base = docs.drop("_doc_key", "row", "hash", "label")
    for name, df in (("documents", base), ("benchmark", bench), ("labels", labels)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    got = base
    for name, stage in corpus_pipeline.STAGES[1:]:
        got = stage(spark, got, str(tmp_path)).cache()
        assert got.columns[:5] == base.columns
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*base.columns, "mix_copies"]
    assert out.where("text LIKE '%AKIAABC%'").count() == 0
    assert corpus_pipeline.run is not None and len(corpus_pipeline.STAGES) == 5
