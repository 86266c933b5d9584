import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _doc_key string, row int, hash string, label int"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def hard_rows():
    """Nulls in any column, empty, blank and very long texts, copies, near copies, repeated rows, hot sources."""
    rng = random.Random(5)
    passage = prose(rng, 40)
    item = prose(rng, 25)
    texts = [None, "", " \n\t ", "one", "a b c d e", prose(rng, 30_000), passage + " " + prose(rng, 60), prose(rng, 50) + "\n" + passage]
    base = prose(rng, 200)
    words = base.split()
    texts += [base, base, " ".join(words[:150] + ["changed"] + words[151:]), " ".join(words[:100] + ["x", "y"] + words[102:])]
    texts += [prose(rng, 30) + " " + item + " " + prose(rng, 5), item.upper(), "the the the " * 40, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" é AKIAABCDEFGHIJKL23', "Released under the MIT License.\n" + prose(rng, 20)]
    rows = [(i, t, None if i % 5 == 0 else "en", [None, "a", "b", "ä"][i % 4], None if t is None else len(t), "k", 1, "h", 0) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], rows[4], (None, base, "en", "a", 3, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return rows, [(1, item), (2, "one"), (3, None), (4, ""), (5, item), (None, prose(rng, 12))]
