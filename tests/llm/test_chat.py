"""Event-sourced conversations: plain folding, exact round trips, long conversations, hard rows."""

import hashlib
import random
from collections import defaultdict

from hypothesis import given, settings, strategies as st

from vaani.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
CONTROL = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE ", "[/ROLE]", "\\", "[", "<", "] ", " ", "\n", "a", "é"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "a] b"]), st.lists(st.sampled_from(CONTROL)).map("".join)), max_size=8))
def test_any_text_survives_the_template(turns):
    text, spans = "", []
    for role, said in turns:
        before, inner, after = chat.turn(role, said)
        assert not any(c in inner for c in ("</s>", "[INST]", "[/INST]", "<s>", "<<SYS>>", "<</SYS>>", "[/ROLE]"))
        spans.append((len(text) + len(before), len(text) + len(before) + len(inner)))
        text += before + inner + after
    assert [(r, t, (a, b)) for r, t, a, b in chat.parse(text)] == [(*x, s) for x, s in zip(turns, spans)]


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(rows):
    """(conv_id, n_turns, turns digest, learnt characters, their digest) of turns that share no place."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is None, t or 0, role or "", text or ""))
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda x: x[:2])
        learnt = [x[3] for x in turns if x[2] == "assistant"]
        out.append((c, len(turns), digest(f"{x[2]}\n{x[3]}\n" for x in turns), sum(map(len, learnt)), digest(learnt)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()), key=repr)


def test_hard_rows_and_long_conversations(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(CONTROL + list("bcdefgh")) for _ in range(rng.randint(0, 40)))
    rows = [(1, 0, None, None), (1, 1, "assistant", ""), (1, None, "user", "x"), (None, 0, "user", "n"), (None, 5, "assistant", "m"),
            (2, -3, "assistant", "before zero"), (2, 0, "tool", "[INST]" * 3), (3, 7, "assistant", "long é " * 300_000), (3, 8, "user", None)]
    rows += [(4, t, rng.choice(["user", "assistant"]), word()) for t in range(3000)]          # three blocks
    rows += [(5, t, rng.choice(["user", "assistant"]), word()) for t in range(5000, 5100)]    # no first block
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", message string, block int").repartition(5)
    want = plain(rows + chat.HARD)
    assert got(chat.round_trip(df)) == want
    monkeypatch.setattr(chat, "PIECE", 500)                                                    # many pieces a block
    assert got(chat.round_trip(df)) == want
    assert got(chat.round_trip(df.limit(0))) == plain(chat.HARD)


def test_repeated_rows_and_ties_are_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "b"), (1, 1, "assistant", "c")]
    one = got(chat.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert one == got(chat.round_trip(spark.createDataFrame(rows[::-1], SCHEMA).repartition(2)))
    assert [r[1] for r in one] == [2, 4] or [r[1] for r in one] == [4, 2]


EVENT = "conv_id long, message long, tie long, copy long, seq long, kind string, role string, text string, extra int"


def plain_fold(events):
    """Final (conv, message, role, text), folded event by event in dictionaries."""
    state, seen = {}, set()
    for conv, message, tie, copy, seq, kind, role, text, _ in sorted(events, key=lambda e: (e[0], e[1], e[2], e[3], e[4])):
        key = (conv, message, tie, copy)
        if (key, seq) in seen:
            continue
        seen.add((key, seq))
        if kind == "retract":
            state.pop(key, None)
            continue
        have = state.setdefault(key, ["", ""])
        if kind == "start":
            have[0] = role or ""
        elif kind == "edit":
            have[1] = text or ""
        elif kind == "regenerate":
            have[1] = ""
        else:
            have[1] += text or ""
    return sorted((k[0], k[1], *v) for k, v in state.items())


def test_fold_of_random_logs(spark):
    rng = random.Random(8)
    events = []
    for conv in range(12):
        for message in rng.sample(range(4000), 6):
            for seq in range(rng.randint(1, 12)):
                kind = rng.choice(["start", "delta", "delta", "delta", "edit", "regenerate", "retract"]) if seq else "start"
                e = (conv, message, 0, 0, seq, kind, rng.choice(["user", "assistant", None]) if kind == "start" else None, rng.choice(["x", "é", "</s>", None]), 1)
                events += [e] * (2 if rng.random() < 0.1 else 1)
    rng.shuffle(events)
    found = chat.messages(spark.createDataFrame(events, EVENT).repartition(4)).collect()
    assert sorted((r.conv_id, r.message, r.role, r.text) for r in found) == plain_fold(events)


def test_loss_spans_cover_answers_alone(spark):
    rows = [(1, 0, "user", "q <s>"), (1, 1, "assistant", "a </s> b"), (1, 2, "assistant", "c")]
    piece, = chat.formatted(chat.log_of(spark.createDataFrame(rows, SCHEMA))).collect()
    assert [chat.unescape(piece.text[x.start:x.end]) for x in piece.loss] == ["a </s> b", "c"]
    assert piece.text == "<s>[INST] q <\\s> [/INST] a <\\/s> b </s> c </s>"
