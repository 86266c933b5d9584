"""Clip files: every clip in its place, nothing half-written, nothing from attempts that didn't count."""

import os

import pytest
from pyspark.sql import functions as F

from vaani.sources import clips as C


def files(root):
    return {os.path.relpath(os.path.join(d, n), root): open(os.path.join(d, n), "rb").read() for d, _, ns in os.walk(root) for n in ns}


def rows(spark, n=40):
    return spark.range(n).select(F.concat(F.lit("c"), F.col("id")).alias("id"), F.concat(F.lit("r"), F.col("id") % 7).alias("recording_id"),
                                 F.when(F.col("id") != 5, F.encode(F.concat(F.lit("wav"), F.col("id")), "UTF-8")).alias("clip"))


def want(n=40, word="wav"):
    return {f"r{i % 7}/c{i}.wav": f"{word}{i}".encode() for i in range(n) if i != 5}


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_every_clip_in_its_place(spark, tmp_path, scheme):
    assert C.write_clip_files(rows(spark).repartition(6), scheme + str(tmp_path / "clips")) == 39
    assert files(tmp_path / "clips") == want()


def test_kept_or_overwritten(spark, tmp_path):
    root = str(tmp_path / "clips")
    C.write_clip_files(rows(spark, 10), root)
    other = rows(spark).withColumn("clip", F.encode(F.concat(F.lit("new"), F.substring("id", 2, 9)), "UTF-8")).where("id <> 'c5'")
    C.write_clip_files(other, root, overwrite=False)
    assert files(root) == want(40, "new") | want(10)
    C.write_clip_files(other, root)
    assert files(root) == want(40, "new")


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    root = tmp_path / "clips"
    bad = rows(spark).repartition(6).withColumn("clip", F.when(F.col("id") == "c17", F.raise_error(F.lit("lost"))).otherwise(F.col("clip")))
    with pytest.raises(Exception, match="lost"):
        C.write_clip_files(bad, str(root))
    # tasks that still ran may have left staged files, which nothing reads: no clip is in its place
    left = files(root)
    assert all(name.startswith("_staging-") for name in left) and not any(name.endswith(C.COMMITTED) for name in left)


def test_only_committed_attempts_are_published_and_a_move_can_be_repeated(spark, tmp_path):
    import pyarrow as pa
    staging, root = str(tmp_path / "s"), str(tmp_path / "clips")
    writer = C.StagingWriter(staging)
    batch = lambda word: [pa.record_batch([pa.array(["a"]), pa.array(["r"]), pa.array([word], pa.binary())], ["id", "recording_id", "clip"])]
    writer.write(batch(b"lost attempt"))
    assert C.publish(spark, staging, root) == 0                      # nothing is committed yet
    good = writer.write(batch(b"good"))
    writer.commit([good, None])
    assert C.publish(spark, staging, root) == 1 and files(root) == {"r/a.wav": b"good"}
    assert C.publish(spark, staging, root) == 1 and files(root) == {"r/a.wav": b"good"}
    os.remove(os.path.join(root, "r", "a.wav"))
    with pytest.raises(Exception, match="a.wav"):
        C.publish(spark, staging, root)
