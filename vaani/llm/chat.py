"""Conversations rebuilt from an event log and rendered for training, with a loss mask.

``events``: conv_id, message (its place), tie and copy (tell messages at one
place apart), seq (order within a message; all these are longs), kind, role,
text.  Kinds:

* ``start`` opens a message with its role; * ``delta`` appends streamed text;
* ``edit`` replaces the text; * ``regenerate`` drops the answer so far, new
  deltas follow; * ``retract`` removes the message.

``messages`` deals the log out by conversation and block of ``BLOCK`` places,
sorts it by sequence and folds it as it streams by, holding one message at a
time; so a conversation with a third of all events is the work of many tasks.
``rendered`` joins a block's messages into pieces of formatted text with the
spans under the loss mask, ``read_back`` parses such pieces again.

The template (fixed strings below) marks every turn, whatever its role; a
control string inside a text gets one more backslash after its first
character, which reading takes away, so any text survives.

Defined results: a null text is empty, a null role is the empty role; null
ids are one conversation; a null place comes last; turns that share a place
are ordered by ``tie``, a hash of role and text; repeated rows are turns of
their own; an event with the same seq as the one before it (delivered twice)
counts once; a message without ``start`` has the empty role; events after
``retract`` start the message anew; empty tables give no rows; texts of any
length are one turn; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from vaani.llm.shared import ready

#: Places of one conversation that one task folds at a time.
BLOCK = 1024
#: Characters of formatted text in one piece, about (a message is never cut).
PIECE = 1 << 20
#: Characters of a streamed delta in the log that a table of turns is given.
DELTA = 600

#: Fixed strings of the template: what comes before and after a text.
OPENING = {"user": "<s>[INST] ", "system": "<<SYS>>\n", "assistant": " "}
CLOSING = {"user": " [/INST]", "system": "\n<</SYS>>\n", "assistant": " </s>"}
OTHER_OPENING, OTHER_NAME_END, OTHER_CLOSING = "[ROLE ", "] ", " [/ROLE]"
#: First characters of control strings, and what follows them.
HEADS, TAILS = r"[\[<]", r"(?:/?INST\]|/?s>|</?SYS>>|ROLE |/ROLE\])"
RAW = re.compile(rf"({HEADS})(\\*)(?={TAILS})")
ESCAPED = re.compile(rf"({HEADS})\\(\\*)(?={TAILS})")
LEARNT = "assistant"

_L, _S, _B = pa.int64(), pa.string(), pa.bool_()
MESSAGES = pa.schema([("conv_id", _L), ("block", _L), ("message", _L), ("role", _S), ("text", _S), ("more", _B)])
PIECES = pa.schema([("conv_id", _L), ("block", _L), ("piece", pa.int32()), ("text", _S),
                    ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("more", _B)])
PARTS = pa.schema([("conv_id", _L), ("block", _L), ("piece", pa.int32()), ("n_turns", _L), ("loss_chars", _L), ("formatted_chars", _L),
                   ("turns_sha256", _S), ("loss_sha256", _S), ("turns", pa.binary()), ("loss", pa.binary())])
DIGESTS = pa.schema([("conv_id", _L), ("n_turns", _L), ("turns_sha256", _S), ("loss_chars", _L), ("loss_sha256", _S), ("formatted_chars", _L)])


def escape(text: str) -> str:
    return RAW.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def turn(role: str, text: str) -> tuple[str, str, str]:
    """Opening, escaped text and closing of a turn."""
    if role in OPENING:
        return OPENING[role], escape(text), CLOSING[role]
    return f"{OTHER_OPENING}{quote(role, safe='')}{OTHER_NAME_END}", escape(text), OTHER_CLOSING


def parse(text: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end of the escaped text) of each turn of formatted text."""
    out, at = [], 0
    while at < len(text):
        role = next((r for r in ("user", "system") if text.startswith(OPENING[r], at)), None)
        if role is None and text.startswith(OTHER_OPENING, at):
            stop = text.index(OTHER_NAME_END, at)
            role, start, closing = unquote(text[at + len(OTHER_OPENING):stop]), stop + len(OTHER_NAME_END), OTHER_CLOSING
        else:
            role = role or LEARNT
            start, closing = at + len(OPENING[role]), CLOSING[role]
        end = text.index(closing, start)
        out.append((role, unescape(text[start:end]), start, end))
        at = end + len(closing)
    return out


def log_of(turns: DataFrame) -> DataFrame:
    """An event log of finished turns (conv_id, turn, role, text): streamed deltas; answers with a
    first attempt that is regenerated, questions that were sent unfinished and edited, and
    attempts that were retracted, at places told by a hash."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    tie = F.conv(F.substring(F.md5(F.concat(role, F.lit("\n"), text)), 1, 15), 16, 10).cast("long")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("message"), tie.alias("tie"),
                        F.monotonically_increasing_id().alias("copy"), role.alias("role"), text.alias("text"))

    def event(kind: str, words: Column, named: bool = False) -> Column:
        return F.struct(F.lit(kind).alias("kind"), (F.col("role") if named else F.lit(None).cast("string")).alias("role"), words.alias("text"))

    none, some = F.lit(None).cast("string"), F.substring("text", 1, 24)
    whole = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.char_length("text") - 1, F.lit(0)) / DELTA).cast("int")),
                        lambda i: event("delta", F.substring(F.col("text"), i * DELTA + 1, F.lit(DELTA))))
    start, draft = event("start", none, True), event("delta", F.reverse(some))
    kind = F.pmod("tie", F.lit(4))
    history = (F.when((kind == 0) & (F.col("role") == LEARNT), F.concat(F.array(start, draft, event("regenerate", none)), whole))
               .when((kind == 0), F.array(start, event("delta", some), event("edit", F.col("text"))))
               .when((kind == 1), F.concat(F.array(start, draft, event("retract", none), start), whole))
               .otherwise(F.concat(F.array(start), whole)))
    return rows.select("conv_id", "message", "tie", "copy", F.posexplode(history).alias("seq", "event")).select(
        "conv_id", "message", "tie", "copy", F.col("seq").cast("long").alias("seq"), "event.kind", "event.role", "event.text")


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _mapped(df: DataFrame, step, schema: pa.Schema) -> DataFrame:
    return df.mapInArrow(step, from_arrow_schema(schema))


def _fold(batches):
    """Sorted events to messages, as they stream by; a block's ``more`` mark comes before its messages."""
    block = message = None
    more, last, held = False, None, None          # held: role and parts of the open message
    out = []

    def close():
        if held:
            out.append((*block, message[0], held[0], "".join(held[1]), more))

    for batch in batches:
        for conv, b, place, tie, copy, seq, kind, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv, b) != block or (place, tie, copy) != message:
                close()
                held = last = None
                more = more and (conv, b) == block
                block, message = (conv, b), (place, tie, copy)
            if kind == "more":
                more = True
                continue
            if seq is not None and seq == last:
                continue
            last = seq
            if kind == "retract":
                held = None
                continue
            held = held or ["", []]
            if kind == "start":
                held[0] = role or ""
            elif kind == "delta":
                held[1].append(text or "")
            elif kind in ("edit", "regenerate"):
                held[1] = [text or ""] if kind == "edit" else []
        if out:
            yield _table(out, MESSAGES)
            out = []
    close()
    if out:
        yield _table(out, MESSAGES)


def messages(events: DataFrame) -> DataFrame:
    """The final messages of every conversation: each block's in order, within one partition.

    ``more`` says that a block 0 may not be the whole conversation.
    """
    place = F.col("message").cast("long")
    # an arithmetic shift rounds places before 0 down as well
    block = F.coalesce(F.shiftright(place, BLOCK.bit_length() - 1), F.lit(2**62))
    log = events.select(F.col("conv_id").cast("long").alias("conv_id"), block.alias("block"), place.alias("message"), "tie", "copy", "seq", "kind", "role", "text")
    # one mark for each conversation that goes on beyond its first block
    marks = log.where("block <> 0").select("conv_id").distinct().selectExpr(
        "conv_id", "0L AS block", "CAST(NULL AS long) AS message", "0L AS tie", "0L AS copy", "CAST(NULL AS long) AS seq",
        "'more' AS kind", "CAST(NULL AS string) AS role", "CAST(NULL AS string) AS text")
    order = ["conv_id", "block", F.col("kind") != "more", F.col("message").asc_nulls_last(), "tie", "copy", "seq"]
    return _mapped(log.unionByName(marks).repartition("conv_id", "block").sortWithinPartitions(*order), _fold, MESSAGES)


def rendered(folded: DataFrame) -> DataFrame:
    """Pieces of formatted text of the rows of :func:`messages`, in order, with the spans to be learnt."""
    def render(batches):
        block, number, size, texts, loss, more = None, 0, 0, [], [], False
        out = []

        def cut():
            nonlocal number, size, texts, loss
            if texts:
                out.append((*block, number, "".join(texts), loss, more))
            number, size, texts, loss = number + 1, 0, [], []

        for batch in batches:
            for conv, b, _, role, text, goes_on in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv, b) != block:
                    cut()
                    block, number = (conv, b), 0
                more = goes_on
                before, inner, after = turn(role, text)
                if role == LEARNT:
                    loss.append({"start": size + len(before), "end": size + len(before) + len(inner)})
                texts += before, inner, after
                size += len(before) + len(inner) + len(after)
                if size >= PIECE:
                    cut()
            if out:
                yield _table(out, PIECES)
                out = []
        cut()
        if out:
            yield _table(out, PIECES)

    return _mapped(folded, render, PIECES)


def formatted(events: DataFrame) -> DataFrame:
    """The formatted text of every conversation of the log: pieces in the order of (block, piece)."""
    ready(events.sparkSession)
    return rendered(messages(events))


def _read(text: str, loss: list[dict]) -> tuple[int, int, bytes, bytes]:
    """Turns and learnt text of one piece: their number, its code points, the bytes of both."""
    found = parse(text)
    turns = "".join(f"{role}\n{said}\n" for role, said, *_ in found)
    learnt = "".join(unescape(text[x["start"]:x["end"]]) for x in loss)
    return len(found), len(learnt), turns.encode(), learnt.encode()


def _digest_blocks(batches):
    """A digest of each conversation of one block; of longer ones, what its pieces add."""
    import zstandard
    pack = zstandard.ZstdCompressor(level=1).compress
    conv, sums = None, None
    out = []

    def close():
        if sums:
            out.append((conv[0], conv[1], 0, *sums[:3], sums[3].hexdigest(), sums[4].hexdigest(), None, None))

    for batch in batches:
        for c, b, piece, text, loss, more in zip(*(x.to_pylist() for x in batch.columns)):
            n, chars, turns, learnt = _read(text, loss)
            if (c, b) != conv:
                close()
                conv, sums = (c, b), None
            if more or b != 0:
                out.append((c, b, piece, n, chars, len(text), None, None, pack(turns), pack(learnt)))
                continue
            sums = sums or [0, 0, 0, hashlib.sha256(), hashlib.sha256()]
            for i, x in enumerate((n, chars, len(text))):
                sums[i] += x
            sums[3].update(turns)
            sums[4].update(learnt)
        if out:
            yield _table(out, PARTS)
            out = []
    close()
    if out:
        yield _table(out, PARTS)


def _digest_conversations(batches):
    """The digests of the blocks pass through; pieces of longer conversations are hashed as they stream by."""
    import zstandard
    open_ = zstandard.ZstdDecompressor().decompress
    conv, sums = None, None
    out = []

    def close():
        if sums:
            out.append((conv[0], sums[0], sums[3].hexdigest(), sums[1], sums[4].hexdigest(), sums[2]))

    for batch in batches:
        for c, _, _, n, chars, size, turns_hash, loss_hash, turns, learnt in zip(*(x.to_pylist() for x in batch.columns)):
            if (c,) != conv:
                close()
                conv, sums = (c,), None
            if turns is None:
                out.append((c, n, turns_hash, chars, loss_hash, size))
                continue
            sums = sums or [0, 0, 0, hashlib.sha256(), hashlib.sha256()]
            for i, x in enumerate((n, chars, size)):
                sums[i] += x
            sums[3].update(open_(turns))
            sums[4].update(open_(learnt))
        if out:
            yield _table(out, DIGESTS)
            out = []
    close()
    if out:
        yield _table(out, DIGESTS)


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted pieces (in order, a block in one partition):
    number and digest of its turns, length and digest of the learnt text, formatted length.

    A digest is taken over a conversation's text in order.  Conversations of one
    block are digested where they are; only those of several send their
    (compressed) text once more, a piece at a time and never held as a whole.
    """
    parts = _mapped(pieces, _digest_blocks, PARTS).repartition("conv_id").sortWithinPartitions("conv_id", "block", "piece")
    return _mapped(parts, _digest_conversations, DIGESTS)


#: Conversation -7 of the query: its texts are made of control strings.
HARD = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def round_trip(conversations: DataFrame) -> DataFrame:
    """All conversations and the hard one: logged, rebuilt, formatted and read back."""
    hard = conversations.sparkSession.createDataFrame(HARD, "conv_id long, turn long, role string, text string")
    turns = conversations.selectExpr("CAST(conv_id AS long) AS conv_id", "CAST(turn AS long) AS turn", "CAST(role AS string) AS role", "CAST(text AS string) AS text")
    return digests(formatted(log_of(turns.unionByName(hard))))


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, md5(role || chr(10) || text)[1:15] AS tie,
    length(text) + len(regexp_extract_all(text, '[\[<]\\*(?:/?INST\]|/?s>|</?SYS>>|ROLE |/ROLE\])')) +
    CASE role WHEN 'user' THEN 18 WHEN 'system' THEN 18 WHEN 'assistant' THEN 6 ELSE 16 + length(url_encode(role)) END AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, tie)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, tie) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id"""
