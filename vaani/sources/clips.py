"""Sink for clip files: ``{root}/{recording_id}/{id}.wav``, committed in two steps.

Tasks write whole clips below a staging folder of their own and list them in
a manifest; only the manifests of attempts that Spark committed are named by
the job's commit file, so a lost or repeated task leaves nothing behind that
counts.  Then a second Spark job moves the committed files to their places.
A move can be repeated: a file that is no longer staged must be in its place.
If writing fails, the staging folder is removed; what tasks that still run
put there afterwards is never read.  Any URI that ``pyarrow``
knows a file system for can be the root (plain paths and ``file:`` included);
every executor must reach it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

COMMITTED, MANIFESTS = "_COMMITTED", "_manifests"


def filesystem(uri: str):
    """(file system, path on it) of a plain path or a URI."""
    from pyarrow import fs
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def _put(system, path: str, data: bytes) -> None:
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as out:
        out.write(data)


@dataclass
class Written(WriterCommitMessage):
    """What a task attempt wrote: its manifest, and how many clips are in it."""
    manifest: str
    clips: int


class StagingWriter(DataSourceArrowWriter):
    def __init__(self, staging: str):
        self.staging = staging

    def write(self, iterator) -> Written:
        system, staging = filesystem(self.staging)
        attempt = uuid.uuid4().hex
        names = []
        for batch in iterator:
            for name, recording, clip in zip(*(batch.column(c) for c in ("id", "recording_id", "clip"))):
                if clip.is_valid:
                    names.append(f"{recording.as_py()}/{name.as_py()}.wav")
                    _put(system, f"{staging}/{attempt}/{names[-1]}", clip.as_py())
        _put(system, f"{staging}/{MANIFESTS}/{attempt}", "".join(f"{attempt}\t{n}\n" for n in names).encode())
        return Written(f"{MANIFESTS}/{attempt}", len(names))

    def commit(self, messages) -> None:
        system, staging = filesystem(self.staging)
        _put(system, f"{staging}/{COMMITTED}", "".join(f"{m.manifest}\n" for m in messages if m is not None).encode())

    def abort(self, messages) -> None:
        system, staging = filesystem(self.staging)
        system.delete_dir(staging)


class StagedClips(DataSource):
    """``df.write.format("staged_clips").save(staging)`` for id, recording_id, clip."""

    @classmethod
    def name(cls) -> str:
        return "staged_clips"

    def schema(self) -> str:
        return "id string, recording_id string, clip binary"

    def writer(self, schema, overwrite: bool) -> StagingWriter:
        return StagingWriter(self.options["path"])


def committed(staging: str) -> list[str]:
    """The manifests that the job committed; none if it didn't."""
    from pyarrow import fs
    system, path = filesystem(f"{staging}/{COMMITTED}")
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return []
    with system.open_input_stream(path) as f:
        return f.read().decode().split()


def publish(spark, staging: str, root: str, overwrite: bool = True) -> int:
    """Move the committed clips of ``staging`` to ``root``; how many there are. Can be run again."""
    manifests = committed(staging)
    if not manifests:
        return 0

    def move(batches):
        from pyarrow import fs
        (system, source), (_, target) = filesystem(staging), filesystem(root)
        there = lambda path: system.get_file_info(path).type == fs.FileType.File
        for batch in batches:
            done = 0
            for line in batch.column(0).to_pylist():
                attempt, name = line.split("\t", 1)
                old, new = f"{source}/{attempt}/{name}", f"{target}/{name}"
                if there(old):
                    if overwrite or not there(new):
                        system.create_dir(new.rsplit("/", 1)[0], recursive=True)
                        system.move(old, new)
                elif not there(new):
                    raise FileNotFoundError(new)
                done += 1
            yield pa.record_batch([pa.array([done], pa.int64())], ["n"])

    lines = spark.read.text([f"{staging}/{m}" for m in manifests]).where(F.col("value") != "")
    return lines.mapInArrow(move, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_clip_files(clips: DataFrame, root: str, overwrite: bool = True) -> int:
    """K3: one WAV file for each row of id, recording_id, clip (null clips have none); how many.

    Rows that share recording and id leave one file.  ``overwrite=False`` keeps files that are there.
    """
    from ..session import ship_package
    spark = clips.sparkSession
    ship_package(spark)
    spark.dataSource.register(StagedClips)
    staging = f"{root.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    rows = clips.select(F.col("id").cast("string").alias("id"), F.col("recording_id").cast("string").alias("recording_id"), "clip")
    rows.write.format("staged_clips").mode("append").save(staging)
    n = publish(spark, staging, root, overwrite)
    system, path = filesystem(staging)
    system.delete_dir(path)
    return n
