"""Releases: one switch for all datasets, failures on the way, and runs that finish together."""

import datetime as dt

import pytest

from reelmetrics.plans import star_etl
from reelmetrics.sources import files, releases
from reelmetrics.sources.sample_star import SampleStar

SF_DIR = "/root/testdata/sf0.001"
AS_OF = dt.date(2001, 11, 5)


def _write(spark, **values):
    def write(folder):
        for name, value in values.items():
            spark.range(value).write.parquet(f"{folder}/{name}")
        return values

    return write


def _counts(spark, base, number=None):
    return {n: df.count() for n, df in releases.open_release(spark, base, number).items()}


def test_switch(spark, tmp_path):
    base = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        releases.describe(spark, base)
    assert releases.publish(spark, base, _write(spark, a=3, b=4), {"by": "me"}) == 1
    held = releases.open_release(spark, base)
    assert releases.publish(spark, base, _write(spark, a=5, b=6)) == 2
    assert _counts(spark, base) == {"a": 5, "b": 6}
    assert _counts(spark, base, 1) == {"a": 3, "b": 4}
    assert {n: df.count() for n, df in held.items()} == {"a": 3, "b": 4}  # a reader that opened before goes on
    assert releases.describe(spark, base, 1)["notes"] == {"by": "me"}
    assert releases.describe(spark, base)["datasets"]["b"]["rows"] == 6


def test_a_run_that_fails_changes_nothing(spark, tmp_path):
    base = str(tmp_path)
    releases.publish(spark, base, _write(spark, a=3, b=4))

    def half(folder):
        spark.range(9).write.parquet(f"{folder}/a")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        releases.publish(spark, base, half)
    assert _counts(spark, base) == {"a": 3, "b": 4}
    assert len(files.list_names(spark, f"{base}/runs")) == 1
    # A dataset that is named but not there stops the switch, too.
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        releases.publish(spark, base, lambda folder: spark.range(1).write.parquet(f"{folder}/a") or {"a": 1, "b": 1})
    assert _counts(spark, base) == {"a": 3, "b": 4}


def test_runs_that_finish_together_get_two_numbers(spark, tmp_path):
    base = str(tmp_path)
    one, other = releases.Run(spark, base), releases.Run(spark, base)
    rows = [_write(spark, a=n)(run.folder) for n, run in ((1, one), (2, other))]
    # The other takes the number between the look and the creation.
    assert other.publish(rows[1]) == 1
    assert files.create_text(spark, f"{base}/releases/00000001.json", "x") is False
    assert one.publish(rows[0]) == 2
    assert (_counts(spark, base, 1), _counts(spark, base, 2)) == ({"a": 2}, {"a": 1})


def test_small_files(spark, tmp_path):
    path = f"{tmp_path}/x/y.txt"
    assert files.list_names(spark, f"{tmp_path}/x") == []
    assert files.create_text(spark, path, "é\n") and not files.create_text(spark, path, "other")
    assert files.read_text(spark, path) == "é\n"
    assert [n for n in files.list_names(spark, f"{tmp_path}/x") if not n.endswith(".crc")] == ["y.txt"]
    files.delete(spark, path)
    files.delete(spark, path)
    assert [n for n in files.list_names(spark, f"{tmp_path}/x") if not n.endswith(".crc")] == []


def test_old_releases_go(spark, tmp_path):
    base = str(tmp_path)
    for n in range(1, 5):
        releases.publish(spark, base, _write(spark, a=n))
    running = releases.Run(spark, base)
    spark.range(7).write.parquet(f"{running.folder}/a")
    assert releases.retire(spark, base, keep=2) == [1, 2]
    assert releases.releases(spark, base) == [3, 4]
    assert _counts(spark, base, 3) == {"a": 3}
    assert len(files.list_names(spark, f"{base}/runs")) == 3
    assert running.publish({"a": 7}) == 5
    with pytest.raises(ValueError):
        releases.retire(spark, base, keep=0)


def test_the_whole_run(spark, tmp_path, monkeypatch):
    """All 14 datasets are switched at once; a run that dies halfway leaves the old ones readable."""
    base, star = str(tmp_path), SampleStar(spark, SF_DIR)
    assert star_etl.publish_run(spark, star.tables(), base, AS_OF) == 1
    before = _counts(spark, base)
    assert len(before) == 14
    written = []
    whole = star_etl.write_curated

    def fails(df, path, *options):
        if len(written) == 7:
            raise RuntimeError("executor lost")
        written.append(path)
        return whole(df, path, *options)

    monkeypatch.setattr(star_etl, "write_curated", fails)
    with pytest.raises(RuntimeError, match="executor lost"):
        star_etl.publish_run(spark, star.tables(), base, AS_OF)
    assert len(written) == 7
    monkeypatch.undo()
    assert _counts(spark, base) == before
    assert {n: d["rows"] for n, d in releases.describe(spark, base)["datasets"].items()} == before
    assert star_etl.publish_run(spark, star.tables(), base, AS_OF) == 2
