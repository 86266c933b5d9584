"""Items without an id, and proximity matches against a plain search."""

import random
import re

from vaani.llm import decontamination as d

WORD = re.compile(r"[a-z]+")


def plain(text, items, window, slop):
    """(words hit, item ids, contaminated, items near) of one text, by looking at every place."""
    words = WORD.findall((text or "").lower())
    hit, ids, near, any_hit = set(), set(), set(), False
    for i, t in items:
        w = WORD.findall((t or "").lower())
        for k in range(max(1, len(w) - window + 1) if w else 0):
            g = w[k:k + window]
            for p in range(len(words) - len(g) + 1):
                if words[p:p + len(g)] == g:
                    any_hit = True
                    hit.update(range(p, p + len(g)))
                    ids.add(i)
            if any(set(g) <= set(words[p:p + len(g) + slop]) for p in range(len(words))):
                near.add(i)
    text_of = lambda s: ",".join(sorted(str(x) for x in s if x is not None))        # noqa: E731
    return len(hit), text_of(ids), any_hit, text_of(near)


def test_items_without_an_id_and_proximity(spark):
    rng = random.Random(11)
    some = lambda n: [rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(n)]         # noqa: E731
    secret, known = some(12), some(14)
    shuffled = known[:10]
    rng.shuffle(shuffled)
    items = [(None, " ".join(secret)), (1, " ".join(known)), (2, "a bb"), (None, None), (3, ""), (4, " ".join(secret[:6] + some(8)))]
    texts = [" ".join(some(20) + secret + some(20)), " ".join(shuffled[:4] + ["zz", "yy"] + shuffled[4:]), " ".join(some(4000)), None, "", "bb x y z a", "bb " * 30 + "a",
             " ".join(some(5) + known[:5] + ["q"] * 8 + known[5:]), " ".join(some(3) + known + some(3))]
    texts += [" ".join(some(rng.randint(1, 60))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (d.BLOCK, 4):
        rows = d.contamination(docs, bench, slop=5, block=block).collect()
        got = {r.doc_id: (r.n_hit, r["items"], r.contaminated, r.near_items) for r in rows}
        assert got == {i: plain(t, items, 10, 5) for i, t in enumerate(texts)}
        assert all(r.n_near == (len(r.near_items.split(",")) if r.near_items else 0) for r in rows)
    assert got[0][2] and got[0][1] == "" and "1" in got[1][3].split(",") and not got[1][2]
    kept = {r.doc_id for r in d.clean(docs, bench).collect()}
    assert kept == {i for i, t in enumerate(texts) if not plain(t, items, 10, 5)[2]}
