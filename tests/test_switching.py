"""Days and tables that are switched: written once, and finished wherever a run has died."""

import os
import shutil
from collections import Counter

import pytest

from adlake.operators import tables
from adlake.operators.tables import Target
from adlake.session import run_dir, shared_dir
from test_tables import C1, C2, DIM, MERGED, NEW, OLD, SPEC, campaigns, content, dim, facts, names, target  # noqa: F401


class Died(Exception):
    pass


def files(folder):
    return Counter(f"{os.path.relpath(root, folder)}/{name}" for root, _, found in os.walk(folder)
                   for name in found if name.endswith(".parquet"))


def dying(monkeypatch, name, after):
    """Let the ``after``-th call of a helper of the tables module be the run's last."""
    real, calls = getattr(tables, name), [0]

    def call(*args):
        calls[0] += 1
        if calls[0] > after:
            raise Died
        return real(*args)

    monkeypatch.setattr(tables, name, call)


@pytest.mark.parametrize("after", range(6))
def test_an_upsert_that_died_between_days_is_finished(spark, tmp_path, monkeypatch, after):
    target = Target(path=str(tmp_path / "t"))
    tables.upsert(facts(spark, OLD), target, SPEC)
    with monkeypatch.context() as patch:
        dying(patch, "rename", after)
        if after < 4:  # two days, each renamed away and in
            with pytest.raises(Died):
                tables.upsert(facts(spark, NEW), target, SPEC)
        else:
            tables.upsert(facts(spark, NEW), target, SPEC)
    assert tables.finish_upserts(spark, target) == int(after < 4)
    assert content(target, spark) == MERGED
    assert tables.finish_upserts(spark, target) == 0 and not os.listdir(f"{target.path}/{tables._HIDDEN}")


@pytest.mark.parametrize("step", ["ALTER", "rename"])
def test_partitions_that_a_dead_run_left_are_pointed_on(spark, tmp_path, monkeypatch, step):
    target = Target(f"t_{os.urandom(6).hex()}", str(tmp_path / "t"))
    tables.upsert(facts(spark, OLD), target, SPEC)
    report = tables.stage_upsert(facts(spark, NEW), target, SPEC)
    assert report.days == 2 and content(target, spark) == sorted(OLD, key=str)  # ready, not seen
    if step == "rename":
        with monkeypatch.context() as patch:
            dying(patch, "rename", 0)
            with pytest.raises(Died):
                tables.finish_upserts(spark, target)
        assert content(target, spark) == MERGED
    assert tables.finish_upserts(spark, target) == 1
    assert content(target, spark) == MERGED and tables.finish_upserts(spark, target) == 0


def test_the_next_upsert_finishes_the_dead_one(spark, target):  # noqa: F811
    tables.upsert(facts(spark, OLD), target, SPEC)
    tables.stage_upsert(facts(spark, NEW), target, SPEC)
    tables.upsert(facts(spark, [("d", "2024-01-01", 7.0, 7)]), target, SPEC)
    assert content(target, spark) == sorted([*MERGED, ("d", "2024-01-01", 7.0, 7)], key=str)


def test_days_that_were_not_staged_whole_are_removed(spark, target):  # noqa: F811
    tables.upsert(facts(spark, OLD), target, SPEC)
    tables.stage_upsert(facts(spark, NEW), target, SPEC)
    hidden = f"{target.home(spark).removeprefix('file:')}/{tables._HIDDEN}"
    (last,) = [n for n in os.listdir(hidden) if os.path.exists(f"{hidden}/{n}/_SUCCESS")]
    os.remove(f"{hidden}/{last}/_SUCCESS")
    assert tables.finish_upserts(spark, target) == 0
    assert content(target, spark) == sorted(OLD, key=str) and last not in os.listdir(hidden)


def test_touched_days_are_written_once(spark, target, monkeypatch):  # noqa: F811
    tables.upsert(facts(spark, OLD), target, SPEC)
    folder, written = target.home(spark).removeprefix("file:"), []
    real = tables._switch_days

    def switched(session, work, to):
        written.append(files(work.removeprefix("file:")))
        real(session, work, to)

    monkeypatch.setattr(tables, "_switch_days", switched)
    before = files(folder)
    tables.upsert(facts(spark, NEW), target, SPEC)
    after = files(folder)
    names = {f.rsplit("/", 1)[-1] for f in after - before}
    assert names == {f.rsplit("/", 1)[-1] for f in written[0]}  # the staged files themselves
    days = Counter(f.split("/")[-2] for f in after)
    assert set(days) == {"stat_date=2024-01-01", "stat_date=2024-01-02", "stat_date=2024-01-09"}
    assert not any("2024-01-09" in f for f in written[0])


# --- replace -------------------------------------------------------------------------


def test_a_replaced_table_needs_no_scratch_folder(spark, dim):  # noqa: F811
    tables.replace(campaigns(spark, C1), dim, DIM)
    assert not [n for n in os.listdir(f"{shared_dir(spark)}/adlake") if n.startswith("replace")]
    shutil.rmtree(f"{shared_dir(spark)}/adlake")
    assert names(dim, spark) == C1
    tables.replace(campaigns(spark, C2), dim, DIM)
    assert names(dim, spark) == C2


@pytest.mark.parametrize("after", range(3))
def test_a_death_between_two_switches_is_finished(spark, tmp_path, monkeypatch, after):
    one, two, three = Target(path=str(tmp_path / "1")), Target(f"d_{os.urandom(6).hex()}"), Target(path=str(tmp_path / "3"))
    targets = (one, two, three)
    for t in targets:
        tables.replace(campaigns(spark, C1), t, DIM)
    name = run_dir(spark, "my-run")
    with monkeypatch.context() as patch:
        dying(patch, "_switch", after)
        with pytest.raises(Died):
            tables.replace_all([(campaigns(spark, C2), t, DIM) for t in targets], staging=name)
    assert [names(t, spark) for t in targets] == [C2] * after + [C1] * (3 - after)
    reports = tables.finish_replace(spark, name)
    assert [r.rows for r in reports] == [1] * 3 and {r.staging for r in reports} == {name}
    assert [names(t, spark) for t in targets] == [C2] * 3
    assert sorted(os.listdir(tmp_path)) == ["1", "3"]
    with pytest.raises(ValueError, match="is done"):
        tables.finish_replace(spark, name)


@pytest.mark.parametrize("after", range(2))
def test_a_death_between_two_renames_is_finished(spark, tmp_path, monkeypatch, after):
    one = Target(path=str(tmp_path / "1"))
    tables.replace(campaigns(spark, C1), one, DIM)
    name = tables.stage_replace([(campaigns(spark, C2), one, DIM)])
    with monkeypatch.context() as patch:
        dying(patch, "rename", after)
        with pytest.raises(Died):
            tables.finish_replace(spark, name)
    tables.finish_replace(spark, name)
    assert names(one, spark) == C2 and os.listdir(tmp_path) == ["1"]


def test_snapshots_expire(spark):
    target = Target(f"d_{os.urandom(6).hex()}")
    for rows in (C1, C2, C1):
        tables.replace(campaigns(spark, rows), target, DIM)
    assert tables.expire_snapshots(spark, target) == 2 and names(target, spark) == C1
    assert tables.expire_snapshots(spark, target) == 0
    assert f"/{tables._SNAPSHOTS}/" in target.described(spark)["Location"] and tables._SNAPSHOTS not in target.home(spark)


def test_staging_cut_off_leaves_the_tables(spark, tmp_path):
    one = Target(path=str(tmp_path / "1"))
    tables.replace(campaigns(spark, C1), one, DIM)
    name = tables.stage_replace([(campaigns(spark, C2), one, DIM)])
    os.remove(f"{name}/{tables._MANIFEST}")
    with pytest.raises(ValueError, match="cut off"):
        tables.finish_replace(spark, name)
    assert names(one, spark) == C1
