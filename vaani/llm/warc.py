"""WARC archives: writing pages with revisits, and reading with a verified chain of records.

Archives are written by Spark's text sink: each row is one record, the line
separator is the end of a record, so every part file is a WARC file in
the shared folder.  Of equal payloads of at least ``LEAST`` bytes the page with
the largest id is written as a response, the others as revisits of it.

Reading trusts no magic.  The text source splits the files at the version line
into pieces, wherever a split begins; a piece's offset is the sum of the
pieces before it, by split.  Each task emits its pieces as candidate
records with the offset at which the next record would have to begin (from
Content-Length), and links them within the split.  Pointer jumping from the
file starts over the links that leave a split finds the true entry of each
split, and a walk from there keeps the records on the chain; a version line
within a payload is on no chain.  Records that such lines cut in pieces are
read again and joined up.

Defined results: a null html is an empty payload; a null ``page_id`` stays null
and ranks below all others; equal rows with the largest id are all responses;
a null url has no target; control characters in urls are escaped; other columns are ignored.
A chain that breaks (a damaged or truncated file) ends there, as nothing behind it is sure to be a record.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vaani.llm.shared import NULL_ID, id_key, ready, scratch, stored, text_of
from vaani.llm.words import frames, packed, slices

#: Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n"
LEAST = 1000
DATE = "1970-01-01T00:00:00Z"

_M = len(MAGIC)


def _id(page) -> str:
    return f"<urn:x-page:{'null' if page is None else page}>"


def record(page, url: str | None, payload: str, refers_to=None, date: str = DATE) -> str:
    """One record without its last line end."""
    body = payload.encode()
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
    block = head if refers_to is not None else head + payload
    lines = [f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: {_id(page)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
              f"Content-Length: {len(head) + (len(body) if refers_to is None else 0)}"]
    return MAGIC + "\r\n".join(lines) + "\r\n\r\n" + block + END


def write(pages: DataFrame, path: str, least: int = LEAST, date: str = DATE) -> None:
    """Write one record a page to the WARC files below ``path``."""
    ready(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page"), F.col("url").cast("string").alias("url"),
                        F.sha1(text_of("html").cast("binary")).alias("digest"), text_of("html").alias("html"))
    size = F.octet_length("html")
    first = (rows.select("digest", size.alias("size"), "page").where(F.col("size") >= least).groupBy("digest", "size")
             .agg(F.max("page").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("digest", "first"))
    first = stored(first, "payloads")

    def records(batches):
        for batch in batches:
            for part, text in frames(batch, 2):
                page, url, of = (part.column(i).to_pylist() for i in (0, 1, 3))
                yield pa.record_batch([pa.array([record(p, u, t, f if f is not None and f != p else None, date)
                                                 for p, u, t, f in zip(page, url, text.to_pylist(), of)], pa.string())], ["value"])

    if first.isEmpty():
        known = rows.withColumn("first", F.lit(None).cast("long")).select("page", "url", "html", "first").mapInArrow(
            _pack_html, "page long, url string, html binary, first long")
    else:
        packs = rows.select("page", "url", "digest", "html").mapInArrow(packed(4), "page long, url string, digest string, html binary")
        known = packs.join(first, "digest", "left").select("page", "url", "html", "first")
    known.mapInArrow(records, "value string").write.option("lineSep", END).text(path)


def _pack_html(batches):
    import zstandard
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for part in slices(batch, 2):
            yield pa.record_batch([part.column(0), part.column(1), pa.array([squeeze(t.encode()) for t in part.column(2).to_pylist()], pa.binary()), part.column(3)],
                                  ["page", "url", "html", "first"])


_FIELD = re.compile(rb"(?mi)^(WARC-Type|WARC-Record-ID|WARC-Refers-To|WARC-Payload-Digest|WARC-Target-URI|Content-Length)[ \t]*:[ \t]*([^\r\n]*?)[ \t]*\r?$")
_PAGE = re.compile(rb"<urn:x-page:(-?\d+)>\Z")


def parse(piece: bytes) -> dict | None:
    """Header fields of a candidate record (what follows its version line), or None."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {k.lower(): v for k, v in _FIELD.findall(piece[:end])}
    length = fields.get(b"content-length", b"")
    if not re.fullmatch(rb"\d{1,18}", length) or b"warc-type" not in fields:
        return None
    page, of = (_PAGE.match(fields.get(k, b"")) for k in (b"warc-record-id", b"warc-refers-to"))
    digest = fields.get(b"warc-payload-digest", b"")
    try:
        declared = base64.b32decode(digest[5:]).hex() if digest.startswith(b"sha1:") else None
    except ValueError:
        declared = None
    return {"head": end + 4, "length": int(length), "type": fields[b"warc-type"].decode(errors="replace").lower(),
            "page": int(page[1]) if page else None, "of": int(of[1]) if of else None, "declared": declared}


def payload(block: bytes) -> bytes:
    """The entity of an HTTP message."""
    end = block.find(b"\r\n\r\n")
    return block[end + 4:] if block.startswith(b"HTTP/") and end >= 0 else block


PIECES = ("file string, size long, split long, seq long, begin long, total long, next long, leaves long, whole boolean, type string, "
          "page long, of long, declared string, bytes long, digest string")
_NAMES = [f.split()[0] for f in PIECES.split(", ")]


def _pieces(batches):
    """Candidates of each split: begin and next are relative to the split, leaves is where the chain from here leaves it (or null)."""
    rows, key, at, seq = [], None, 0, 0

    def links():
        total = at
        exits: dict[int, int | None] = {}
        for r in reversed(rows):            # a record's successor comes after it
            if r["next"] is not None:
                n = r["next"]
                exits[r["begin"]] = r["leaves"] = n if n >= total - _M or n + _M > total else exits.get(n)
            r["total"] = total
        for i in range(0, max(len(rows), 1), 4096):
            yield pa.RecordBatch.from_pylist(rows[i:i + 4096], schema=_SCHEMA)
        rows.clear()

    for batch in batches:
        for part in slices(batch, 3):
            for file, size, split, value in zip(*(part.column(i).to_pylist() for i in range(4))):
                if (file, split) != key:
                    if key is not None:
                        yield from links()
                    key, at, seq = (file, split), 0, 0
                r = dict.fromkeys(_NAMES) | {"file": file, "size": size, "split": split, "seq": seq, "begin": at - _M, "whole": False}
                f = parse(value)
                if f:
                    r["next"] = at + f["head"] + f["length"] + 4
                    r["whole"] = f["head"] + f["length"] + 4 <= len(value)
                    r |= {k: f[k] for k in ("type", "page", "of", "declared")}
                    if r["whole"]:
                        body = payload(value[f["head"]:f["head"] + f["length"]])
                        r |= {"bytes": len(body), "digest": hashlib.sha1(body).hexdigest()}
                rows.append(r)
                at, seq = at + len(value) + _M, seq + 1
    if key is not None:
        yield from links()


_SCHEMA = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}[t]) for n, t in (f.split() for f in PIECES.split(", "))])


def _raw(spark: SparkSession, path: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", MAGIC).text(path).select(
        meta["file_path"].alias("file"), meta["file_size"].alias("size"), meta["file_block_start"].alias("split"), F.col("value").cast("binary").alias("value"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """All pieces with offsets in their file."""
    rows = stored(_raw(spark, path).mapInArrow(_pieces, PIECES), "pieces")
    splits = rows.groupBy("file", "split").agg(F.max("total").alias("total"))
    before = splits.alias("a").join(splits.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("b.split") < F.col("a.split")), "left").groupBy(
        F.col("a.file").alias("file"), F.col("a.split").alias("split")).agg(F.coalesce(F.sum("b.total"), F.lit(0)).alias("base"))
    rows = rows.join(before, ["file", "split"])
    return stored(rows.select("file", "size", "split", "seq", (F.col("base") + F.col("begin")).alias("begin"), (F.col("base") + F.col("next")).alias("next"),
                              (F.col("base") + F.col("leaves")).alias("leaves"), "whole", "type", "page", "of", "declared", "bytes", "digest"), "candidates")


def entries(pieces: DataFrame) -> DataFrame:
    """(file, begin): by pointer jumping from the file starts, the first true record of each split."""
    jumps = pieces.where("leaves IS NOT NULL").select("file", "begin", "leaves")
    ends = jumps.select("file", F.col("leaves").alias("begin")).distinct()
    jumps = stored(jumps.where("begin = 0").unionByName(jumps.where("begin > 0").join(ends, ["file", "begin"], "left_semi")), "jumps")
    reached = stored(jumps.where("begin = 0").select("file", "begin"), "reached")
    n = reached.count()
    while True:
        more = reached.join(jumps, ["file", "begin"]).select("file", F.col("leaves").alias("begin"))
        reached = stored(reached.unionByName(more).distinct(), "reached")
        if (m := reached.count()) == n:
            return reached
        n = m
        far = jumps.select("file", F.col("begin").alias("leaves"), F.col("leaves").alias("far"))
        jumps = stored(jumps.join(far, ["file", "leaves"], "left").select("file", "begin", F.coalesce("far", "leaves").alias("leaves")), "jumps")


def _walk(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one split's pieces, those on the chain from its entry."""
    at = dict(zip(rows["begin"], range(len(rows))))
    on, here = [], next((b for b, e in zip(rows["begin"], rows["entry"]) if e), None)
    while here in at:
        i = at[here]
        step = rows["next"].iat[i]
        if pd.isna(step) or step > rows["size"].iat[i]:
            break
        on.append(i)
        here = step
    return rows.iloc[on].drop(columns="entry")


def _joined(rows: pd.DataFrame) -> pd.DataFrame:
    """A record that magic within its payload cut in pieces, put together."""
    rows = rows.sort_values("piece")
    whole = MAGIC.encode().join(rows["value"])
    f = parse(whole)
    body = payload(whole[f["head"]:f["head"] + f["length"]])
    return pd.DataFrame({"file": rows["file"].iloc[:1], "begin": rows["begin"].iloc[:1], "bytes": [len(body)], "digest": [hashlib.sha1(body).hexdigest()]})


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records on the chains of all files: file, begin, next, type, page, of, declared, bytes, digest."""
    ready(spark)
    pieces = candidates(spark, path)
    names = pieces.columns
    marked = pieces.join(entries(pieces).withColumn("entry", F.lit(True)), ["file", "begin"], "left").select(*names, F.coalesce("entry", F.lit(False)).alias("entry"))
    records = stored(marked.groupBy("file", "split").applyInPandas(_walk, pieces.schema), "records")
    cut = records.where("NOT whole").select("file", "begin", "next")
    if cut.isEmpty():
        return records.drop("whole", "size", "split", "seq")
    parts = pieces.select("file", "split", "seq", F.col("begin").alias("piece")).join(cut, "file").where("piece >= begin AND piece < next")
    files = [r.file for r in cut.select("file").distinct().limit(1000).collect()]
    again = _raw(spark, path).mapInArrow(_numbered, "file string, split long, seq long, value binary")
    again = again.where(F.col("file").isin(files)) if len(files) < 1000 else again
    full = again.join(parts, ["file", "split", "seq"]).groupBy("file", "begin").applyInPandas(_joined, "file string, begin long, bytes long, digest string")
    full = full.withColumnsRenamed({"bytes": "b", "digest": "d"})
    return (records.join(full, ["file", "begin"], "left").withColumn("bytes", F.coalesce("bytes", "b")).withColumn("digest", F.coalesce("digest", "d"))
            .select(*(c for c in records.columns if c not in ("whole", "size", "split", "seq"))))


def _numbered(batches):
    key, seq = None, 0
    for batch in batches:
        numbers = []
        for k in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            seq = seq + 1 if k == key else 0
            key = k
            numbers.append(seq)
        yield pa.record_batch([batch.column(0), batch.column(2), pa.array(numbers, pa.int64()), batch.column(3)], ["file", "split", "seq", "value"])


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages``, read the archives back, and describe each page's record by what was read."""
    spark = pages.sparkSession
    path = path or scratch(spark, "warc")
    write(pages, path)
    records = stored(read(spark, path), "read")
    response = records.where("type = 'response'").select("page", "bytes", "digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    told = response.select(F.col("page").alias("of"), F.col("digest").alias("declared"), "bytes", "digest").distinct()
    revisit = records.where("type = 'revisit'").select("page", "of", "declared").join(told, ["of", "declared"], "left").select(
        "page", "bytes", "digest", F.lit("revisit").alias("record_type"), F.col("of").alias("refers_to"))
    return response.unionByName(revisit).select(F.col("page").alias("page_id"), F.col("bytes").alias("payload_bytes"),
                                                F.col("digest").alias("payload_digest"), "record_type", "refers_to")


#: The same table without archives.
ORACLE = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS d FROM pages),
f AS (SELECT page_id, octet_length(b) AS n, d, max(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= {LEAST} AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {LEAST} AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""
