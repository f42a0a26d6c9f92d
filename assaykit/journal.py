"""Publication of many datasets as one step.

The moves that put staged results into place are first written to a journal inside the
staging directory. Renaming the journal to ``_publication``, beside the targets, is the one step
that publishes: before it nothing was moved, after it ``recover`` can always finish the moves.
While the journal stands there, the library's readers refuse the directory, so nobody meets some
results of a run beside older ones. One job at a time publishes into a directory.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from assaykit.storage import Storage

JOURNAL = "_publication"
STAGE_PREFIX = "_stage-"
REPLACED = "-replaced"


class UnfinishedPublication(RuntimeError):
    """A publication into the directory is under way, or was cut off."""


@dataclass(frozen=True)
class Publication:
    """(path below the stage, name of the target) of every move, in order."""

    directory: str
    stage: str
    moves: list[tuple[str, str]]

    @classmethod
    def plan(cls, stage: str, moves: Sequence[tuple[str, str]]) -> Publication:
        """``moves`` as qualified (staged, target) paths; all targets lie beside the stage."""
        directory, _, name = stage.rpartition("/")
        for staged, target in moves:
            if not staged.startswith(f"{stage}/"):
                raise ValueError(f"{staged} does not lie in {stage}")
            if target.rpartition("/")[0] != directory:
                raise ValueError(f"{target} does not lie directly in {directory}")
        pairs = [(staged[len(stage) + 1 :], target.rpartition("/")[2]) for staged, target in moves]
        names = [name for _, name in pairs]
        if len(set(names)) < len(names):
            raise ValueError("two moves have the same target")
        return cls(directory, name, pairs)

    @property
    def staged(self) -> str:
        return f"{self.directory}/{self.stage}"

    @property
    def aside(self) -> str:
        return f"{self.staged}{REPLACED}"

    def begin(self, storage: Storage) -> None:
        """From here on the results count as published."""
        refuse_unfinished(storage, self.directory)
        storage.write_text(f"{self.staged}/{JOURNAL}", json.dumps(asdict(self)))
        storage.rename(f"{self.staged}/{JOURNAL}", f"{self.directory}/{JOURNAL}")

    def steps(self, storage: Storage) -> Iterator[tuple[str, str]]:
        """Make the renames that are left to make, one at each step; they can stop anywhere and
        be started again."""
        for index, (path, name) in enumerate(self.moves):
            staged, target = f"{self.staged}/{path}", f"{self.directory}/{name}"
            if not storage.exists(staged):
                if not storage.exists(target):
                    raise FileNotFoundError(f"neither {staged} nor {target} is there")
                continue
            if storage.exists(target):
                storage.make_dirs(self.aside)
                old = f"{self.aside}/{index}"
                storage.rename(target, old)
                yield target, old
            storage.rename(staged, target)
            yield staged, target

    def end(self, storage: Storage) -> None:
        """Readers may come again; what was replaced goes."""
        storage.delete(f"{self.directory}/{JOURNAL}")
        storage.delete(self.aside)


def unfinished(storage: Storage, directory: str) -> Publication | None:
    """The publication whose journal stands in the directory (a qualified path)."""
    path = f"{directory.rstrip('/')}/{JOURNAL}"
    if not storage.exists(path):
        return None
    record = json.loads(storage.read_text(path))
    moves = [(staged, name) for staged, name in record["moves"]]
    return Publication(directory.rstrip("/"), record["stage"], moves)


def refuse_unfinished(storage: Storage, directory: str) -> None:
    if storage.exists(f"{directory.rstrip('/')}/{JOURNAL}"):
        raise UnfinishedPublication(
            f"{directory} is being published or was left half published; if no job is at it, "
            "assaykit.journal.recover finishes that"
        )


def recover(spark: SparkSession, directory: str) -> list[str]:
    """Finish a publication that was cut off; the names of its targets, none where there was none.

    Afterwards the directory holds all results of that run, or of the run before it where
    its journal was not yet in place, and no staging directory. Only for directories that no
    job writes to: a running job's staging directory would go too. May itself be cut
    off and repeated.
    """
    storage = Storage(spark)
    directory = storage.qualify(directory).rstrip("/")
    if not storage.is_dir(directory):
        raise NotADirectoryError(f"no such directory: {directory}")
    publication = unfinished(storage, directory)
    if publication:
        for _ in publication.steps(storage):
            pass
        publication.end(storage)
    for entry in storage.children(directory, f"{STAGE_PREFIX}*"):
        storage.delete(entry.path)
    return [name for _, name in publication.moves] if publication else []


def dataset_path(spark: SparkSession, directory: str, name: str) -> str:
    """Where a dataset's published rows are right now, also while it has not been moved yet."""
    storage = Storage(spark)
    directory = storage.qualify(directory).rstrip("/")
    publication = unfinished(storage, directory)
    for path, target in publication.moves if publication else []:
        if target == name and storage.exists(f"{publication.staged}/{path}"):
            return f"{publication.staged}/{path}"
    return f"{directory}/{name}"
