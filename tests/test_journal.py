"""Publications cut off at every place between two renames."""

from itertools import islice
from pathlib import Path

import pytest

from assaykit import journal
from assaykit.journal import Publication, UnfinishedPublication, dataset_path, recover
from assaykit.plans import filter_by_cohort, split_by_item
from assaykit.sinks.publish import publish, refuse_existing, staging
from assaykit.sources.directory import list_sources
from assaykit.storage import Storage
from lab_files import two_raw_files, write_items

NAMES = ["a.parquet", "b.parquet", "c.parquet"]


class Killed(BaseException):
    """Not an Exception: nothing is undone, as when the process dies."""


def write(spark, path, value):
    spark.range(3).selectExpr(f"'{value}' as version").coalesce(1).write.parquet(path)


def values(spark, directory):
    return [spark.read.parquet(f"{directory}/{name}").first().version for name in NAMES]


def prepared(spark, directory, old=NAMES):
    """Old results and a stage with new ones; the planned publication."""
    for name in old:
        write(spark, f"{directory}/{name}", "old")
    target = Storage(spark).qualify(str(directory))
    stage = f"{target}/_stage-x"
    for name in NAMES:
        write(spark, f"{stage}/data/{name}", "new")
    return Publication.plan(stage, [(f"{stage}/data/{n}", f"{target}/{n}") for n in NAMES])


def leftovers(directory):
    return [p.name for p in Path(directory).iterdir() if p.name not in NAMES and not p.name.endswith(".crc")]


@pytest.mark.parametrize("old", [NAMES, NAMES[1:2], []])
@pytest.mark.parametrize("stop", range(7))
def test_cut_off_between_renames(spark, tmp_path, stop, old):
    storage, publication = Storage(spark), prepared(spark, tmp_path, old)
    publication.begin(storage)
    made = list(islice(publication.steps(storage), stop))
    assert len(made) == min(stop, len(NAMES) + len(old))
    for refused in (lambda: list_sources(spark, str(tmp_path), "*.parquet"),
                    lambda: refuse_existing(spark, str(tmp_path), [], True),
                    lambda: publication.begin(storage)):
        with pytest.raises(UnfinishedPublication, match="recover"):
            refused()
    for name in NAMES:
        assert spark.read.parquet(dataset_path(spark, str(tmp_path), name)).first().version == "new"
    assert recover(spark, str(tmp_path)) == NAMES
    assert values(spark, tmp_path) == ["new"] * 3 and leftovers(tmp_path) == []
    assert [e.name for e in list_sources(spark, str(tmp_path), "*.parquet")] == NAMES
    assert recover(spark, str(tmp_path)) == []


def test_cut_off_before_the_journal(spark, tmp_path):
    storage, publication = Storage(spark), prepared(spark, tmp_path)
    storage.write_text(f"{publication.staged}/{journal.JOURNAL}", "half")
    assert len(list_sources(spark, str(tmp_path), "*.parquet")) == 3
    assert dataset_path(spark, str(tmp_path), NAMES[0]).endswith(f"{tmp_path.name}/{NAMES[0]}")
    assert recover(spark, str(tmp_path)) == []
    assert values(spark, tmp_path) == ["old"] * 3 and leftovers(tmp_path) == []


@pytest.mark.parametrize("first,second", [(1, 1), (2, 3), (5, 0)])
def test_recovery_cut_off_too(spark, tmp_path, first, second):
    storage, publication = Storage(spark), prepared(spark, tmp_path)
    publication.begin(storage)
    list(islice(publication.steps(storage), first))
    list(islice(journal.unfinished(storage, publication.directory).steps(storage), second))
    recover(spark, str(tmp_path))
    assert values(spark, tmp_path) == ["new"] * 3 and leftovers(tmp_path) == []


def test_a_lost_result_is_an_error(spark, tmp_path):
    storage, publication = Storage(spark), prepared(spark, tmp_path, [])
    publication.begin(storage)
    storage.delete(f"{publication.staged}/data/{NAMES[1]}")
    with pytest.raises(FileNotFoundError, match=NAMES[1]):
        recover(spark, str(tmp_path))
    with pytest.raises(UnfinishedPublication):
        list_sources(spark, str(tmp_path), "*.parquet")


@pytest.mark.parametrize("error,stop", [(OSError, 1), (OSError, 4), (Killed, 1), (Killed, 4)])
def test_publish_undoes_or_can_be_finished(spark, tmp_path, monkeypatch, error, stop):
    """An error puts all back; a job that dies leaves the journal and its stage."""
    for name in NAMES:
        write(spark, f"{tmp_path}/{name}", "old")
    real, seen = Storage.rename, []

    def failing(self, source, target):
        seen.append(target)
        if len(seen) == stop + 2:
            raise error("lost")
        real(self, source, target)

    with pytest.raises(error), staging(spark, str(tmp_path)) as stage:
        for name in NAMES:
            write(spark, f"{stage}/{name}", "new")
        monkeypatch.setattr(Storage, "rename", failing)
        publish(spark, stage, [(f"{stage}/{n}", f"{stage.rpartition('/')[0]}/{n}") for n in NAMES])
    monkeypatch.undo()
    if error is Killed:
        assert recover(spark, str(tmp_path)) == NAMES
    assert values(spark, tmp_path) == ["new" if error is Killed else "old"] * 3
    assert leftovers(tmp_path) == []


def test_plans_are_checked(spark, tmp_path):
    here = Storage(spark).qualify(str(tmp_path))
    for moves, message in (([("/x/a", f"{here}/a")], "does not lie in"),
                           ([(f"{here}/_stage-x/a", f"{here}/y/a")], "directly"),
                           ([(f"{here}/_stage-x/a", f"{here}/a"), (f"{here}/_stage-x/b", f"{here}/a")], "same target")):
        with pytest.raises(ValueError, match=message):
            Publication.plan(f"{here}/_stage-x", moves)
    with pytest.raises(NotADirectoryError):
        recover(spark, f"{here}/none")


def test_jobs_refuse_what_is_half_published(spark, tmp_path, monkeypatch):
    two_raw_files(tmp_path / "raw")
    items, out = write_items(tmp_path / "items.csv"), str(tmp_path / "out")
    args = spark, str(tmp_path / "raw"), items, out
    real = Storage.rename

    def dying(self, source, target):
        real(self, source, target)
        if target.endswith(".parquet"):
            raise Killed

    monkeypatch.setattr(Storage, "rename", dying)
    with pytest.raises(Killed):
        split_by_item(*args)
    monkeypatch.undo()
    spark.sql("select 'p4' as uid, 'v10' as id").write.parquet(str(tmp_path / "cohort"))
    for job in (lambda: split_by_item(*args, overwrite=True),
                lambda: filter_by_cohort(spark, out, str(tmp_path / "cohort"), str(tmp_path / "kept"))):
        with pytest.raises(UnfinishedPublication):
            job()
    assert len(recover(spark, out)) == 4
    assert len(list_sources(spark, out, "*.parquet")) == 3 and not list(Path(out).glob("_*"))
    assert split_by_item(*args, overwrite=True).count() == 3
