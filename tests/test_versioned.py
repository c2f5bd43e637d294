"""Versioned tables: whole versions or none, whatever is lost on the way."""

import datetime as dt

import pytest

from pricelake.sources import sinks, versioned

D = dt.date
DDL = "asset_id string, price_date date, close_usd double, at int"
KEYS = ["asset_id", "price_date"]


def rows(spark, *r):
    return spark.createDataFrame(list(r), DDL)


def held(spark, path, **kw):
    t = versioned.read(spark, path, "price_date", **kw)
    return None if t is None else sorted((r.asset_id, r.price_date, r.close_usd) for r in t.collect())


def test_upsert_versions_and_vacuum(spark, tmp_path):
    p = str(tmp_path / "t")
    assert held(spark, p) is None
    first = rows(spark, ("a", D(2024, 1, 1), 1.0, 1), ("b", D(2024, 1, 1), 2.0, 1), ("a", D(2024, 1, 2), 3.0, 1))
    assert versioned.upsert(spark, p, first, KEYS, "price_date") == 3
    assert versioned.upsert(spark, p, rows(spark, ("a", D(2024, 1, 1), 9.0, 2), ("c", D(2024, 1, 3), 4.0, 2)), KEYS, "price_date") == 3
    want = [("a", D(2024, 1, 1), 9.0), ("a", D(2024, 1, 2), 3.0), ("b", D(2024, 1, 1), 2.0), ("c", D(2024, 1, 3), 4.0)]
    assert held(spark, p) == want
    assert held(spark, p, version=1) == [("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 2), 3.0), ("b", D(2024, 1, 1), 2.0)]
    # by order an older delivery does not win; an empty batch makes no version
    versioned.upsert(spark, p, rows(spark, ("a", D(2024, 1, 1), 7.0, 1)), KEYS, "price_date", order=["at"])
    assert held(spark, p) == want
    assert versioned.upsert(spark, p, first.limit(0), KEYS, "price_date") == 0
    assert list(versioned.versions(spark, p)) == [1, 2, 3]
    gone = versioned.vacuum(spark, p, keep=1)                   # version 1 still holds day 2, version 2 day 3
    assert sorted(d.split("-")[0] + d[-2:] for d in gone) == ["v=101", "v=201"]
    assert held(spark, p) == want and list(versioned.versions(spark, p)) == [3]


@pytest.mark.parametrize("where", ["data", "manifest", "pointer"])
def test_a_writer_lost_before_the_switch_leaves_the_old_version(spark, tmp_path, monkeypatch, where):
    p = str(tmp_path / "t")
    versioned.upsert(spark, p, rows(spark, ("a", D(2024, 1, 1), 1.0, 1), ("b", D(2024, 1, 2), 2.0, 1)), KEYS, "price_date")
    old = held(spark, p)
    batch = rows(spark, ("a", D(2024, 1, 1), 5.0, 2), ("b", D(2024, 1, 2), 6.0, 2), ("c", D(2024, 1, 9), 7.0, 2))

    def lost(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        if where == "data":            # after some partitions are out
            write = sinks.write_table
            m.setattr(versioned.sinks, "write_table", lambda df, path, *a, **k: (write(df.filter("asset_id = 'a'"), path, *a, **k), lost()))
        elif where == "manifest":
            m.setattr(versioned, "_names", lambda s, path: lost() if "/data/" in path else [x.getPath().getName() for x in (
                lambda fs, q: fs.listStatus(q) if fs.exists(q) else [])(*sinks._filesystem(s, path))])
        else:
            m.setattr(versioned, "switch", lost)
        with pytest.raises(RuntimeError, match="lost"):
            versioned.upsert(spark, p, batch, KEYS, "price_date")
    assert held(spark, p) == old
    versioned.upsert(spark, p, batch, KEYS, "price_date")            # the replay
    assert held(spark, p) == [("a", D(2024, 1, 1), 5.0), ("b", D(2024, 1, 2), 6.0), ("c", D(2024, 1, 9), 7.0)]
    versioned.vacuum(spark, p, keep=1)
    assert held(spark, p) == [("a", D(2024, 1, 1), 5.0), ("b", D(2024, 1, 2), 6.0), ("c", D(2024, 1, 9), 7.0)]


def test_of_two_writers_one_switches(spark, tmp_path):
    p = str(tmp_path / "t")
    versioned.upsert(spark, p, rows(spark, ("a", D(2024, 1, 1), 1.0, 1)), KEYS, "price_date")
    versioned.switch(spark, p, 2, "1-other")
    with pytest.raises(versioned.VersionConflict):
        versioned.switch(spark, p, 2, "2-late")


def test_partitions_can_be_emptied(spark, tmp_path):
    p = str(tmp_path / "t")
    versioned.upsert(spark, p, rows(spark, ("a", D(2024, 1, 1), 1.0, 1), ("b", D(2024, 1, 2), 2.0, 1)), KEYS, "price_date")
    versioned.replace_partitions(spark, p, rows(spark, ("c", D(2024, 1, 3), 3.0, 1)), "price_date", emptied=["2024-01-01"])
    assert held(spark, p) == [("b", D(2024, 1, 2), 2.0), ("c", D(2024, 1, 3), 3.0)]
