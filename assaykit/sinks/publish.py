"""Write to a staging directory, check, then move into place.

A dataset is a directory of Parquet files. Publishing is one rename per dataset behind a
journal (``assaykit.journal``), which makes all of them one step for the library's readers.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from assaykit.journal import STAGE_PREFIX, Publication, refuse_unfinished, unfinished
from assaykit.storage import Storage

# Codec names and the zstd level.
CODECS = {"zstd": "zstd", "snappy": "snappy", "none": "uncompressed"}
ZSTD_LEVEL = 3
SHOWN = 10


def require_codec(compression: str) -> None:
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {sorted(CODECS)}, not {compression!r}")


def parquet_writer(df: DataFrame, compression: str = "zstd") -> DataFrameWriter:
    require_codec(compression)
    writer = df.write.mode("errorifexists").format("parquet")
    writer = writer.option("compression", CODECS[compression])
    return writer.option("parquet.compression.codec.zstd.level", ZSTD_LEVEL)


def refuse_existing(
    spark: SparkSession, directory: str, names: Sequence[str], overwrite: bool
) -> None:
    """Nothing is replaced unless asked for; the message names the first ten. A directory whose
    last publication was cut off is refused in any case."""
    storage = Storage(spark)
    refuse_unfinished(storage, directory)
    if overwrite or not storage.is_dir(directory):
        return
    there = {entry.name for entry in storage.children(directory)}
    present = [name for name in names if name in there]
    if present:
        shown = "".join(f"\n  {directory}/{name}" for name in present[:SHOWN])
        rest = len(present) - SHOWN
        more = f"\n  and {rest} more" if rest > 0 else ""
        raise FileExistsError(f"already there, pass overwrite=True to replace:{shown}{more}")


def refuse_overlap(targets: Iterable[str], sources: Iterable[str]) -> None:
    """No target may be, contain or lie inside something that is read (qualified paths)."""
    written = {path.rstrip("/") for path in targets}
    read = {path.rstrip("/") for path in sources}
    for one, others in ((written, read), (read, written)):
        for path in one:
            part = path
            while part:
                if part in others:
                    raise ValueError(f"{path} overlaps {part}: one is read, the other written")
                part = part.rpartition("/")[0]


@contextmanager
def staging(spark: SparkSession, directory: str) -> Iterator[str]:
    """A fresh hidden directory next to the targets, gone afterwards unless a journal needs it."""
    storage = Storage(spark)
    storage.make_dirs(directory)
    parent = storage.qualify(directory).rstrip("/")
    stage = f"{parent}/{STAGE_PREFIX}{uuid.uuid4().hex}"
    storage.make_dirs(stage)
    try:
        yield stage
    finally:
        publication = unfinished(storage, parent)
        if not publication or publication.staged != stage:
            storage.delete(stage)


def publish(spark: SparkSession, stage: str, moves: Sequence[tuple[str, str]]) -> None:
    """Move all (staged, target) pairs into place as one step, or put everything back.

    Replaced results wait beside the staging directory until all moves are made. A failed
    move undoes those before it; should that fail too, or the job be killed, the journal stays and
    ``recover`` makes the moves that are left.
    """
    storage = Storage(spark)
    publication = Publication.plan(stage, moves)
    publication.begin(storage)
    made = []
    try:
        for step in publication.steps(storage):
            made.append(step)
    except Exception:
        for source, target in reversed(made):
            storage.rename(target, source)
        publication.end(storage)
        raise
    publication.end(storage)


def write_csv(df: DataFrame, path: str) -> None:
    """A small ordered report; its size is the number of items or files."""
    df.write.mode("errorifexists").option("escape", '"').csv(path, header=True)


def fill_empty(spark: SparkSession, like: DataFrame, targets: Sequence[str], compression: str) -> None:
    """Zero-row datasets with the full schema: written once, copied for the rest."""
    if not targets:
        return
    storage = Storage(spark)
    first = targets[0]
    parquet_writer(like.limit(0), compression).save(first)
    for target in targets[1:]:
        storage.copy(first, target)
