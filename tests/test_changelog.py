import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cartpulse.sources import serving


def fresh():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t"


def rows(spark, *values):
    return spark.createDataFrame(list(values), "k string, v long")


def test_versions_latest_and_replay(spark):
    path = fresh()
    serving.append_changelog(rows(spark, ("a", 1), ("b", 1), (None, 1)), path, 0)
    serving.append_changelog(rows(spark, ("a", 2)), path, 1)
    for _ in range(2):  # a replayed batch replaces itself
        serving.append_changelog(rows(spark, ("a", 5), (None, 3)), path, 2)
    changelog = serving.read_changelog(spark, path)
    assert changelog.count() == 6
    latest = serving.latest_version(changelog, ["k"]).collect()
    assert {r.k: r.v for r in latest} == {"a": 5, "b": 1, None: 3}
    skew = serving.changelog_skew(changelog, ["k"]).first()
    assert tuple(skew) == (6, 3, 3, 2.0)
    assert changelog.agg(F.sum("v")).first()[0] > sum(r.v for r in latest)


def test_batch_ids_order_as_numbers(spark):
    path = fresh()
    for batch in (9, 10):
        serving.append_changelog(rows(spark, ("a", batch)), path, batch)
    latest = serving.latest_version(serving.read_changelog(spark, path), ["k"])
    assert latest.first().v == 10


def test_latest_keeps_null_values(spark):
    path = fresh()
    serving.append_changelog(rows(spark, ("a", 1)), path, 0)
    serving.append_changelog(rows(spark, ("a", None)), path, 1)
    assert serving.latest_version(serving.read_changelog(spark, path), ["k"]).first().v is None


def test_upsert(spark):
    path = fresh()
    serving.upsert(rows(spark, ("a", 1), ("b", 1), (None, 1)), path, ["k"])
    serving.upsert(rows(spark, ("b", 2), ("c", 2), (None, 2)), path, ["k"])
    got = {r.k: r.v for r in serving.read_current(spark, path).collect()}
    assert got == {"a": 1, "b": 2, "c": 2, None: 2}


def damage(pattern):
    """Makes the Parquet files unreadable: any job that opens one fails."""
    found = [f for f in glob.glob(pattern, recursive=True) if f.endswith(".parquet")]
    assert found
    for name in found:
        with open(name, "wb") as file:
            file.write(b"damaged")


def test_a_failed_write_leaves_other_batches(spark):
    path = fresh()
    serving.append_changelog(rows(spark, ("a", 1)), path, 0)
    broken = rows(spark, ("a", 2)).withColumn("v", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        serving.append_changelog(broken, path, 1)
    assert serving.read_changelog(spark, path).first().v == 1


def test_a_changelog_without_a_batch_is_empty(spark):
    path, schema = fresh(), rows(spark, ("a", 1)).schema
    assert serving.read_changelog(spark, path, schema).count() == 0
    serving.append_changelog(rows(spark, ("a", 1)), path, 0)
    got = serving.read_changelog(spark, path, schema)
    assert got.columns == ["k", "v", "batch_id"] and got.count() == 1


@pytest.mark.parametrize("folds", [[], [0], [1], [2], [0, 2], [0, 1, 2], [1, 1]])
def test_folding_changes_no_current_row(spark, folds):
    path, fold = fresh(), None
    batches = [[("a", 1), ("b", 1), (None, 1)], [("a", 2)], [("a", 3), ("c", 3), (None, None)]]
    for number, batch in enumerate(batches):
        serving.append_changelog(rows(spark, *batch), path, number)
    for through in folds:
        target = fresh()
        serving.fold_changelog(spark, path, ["k"], target, through, earlier=fold)
        fold = target
    expected = {"a": 3, "b": 1, "c": 3, None: None}
    got = serving.read_latest(spark, path, ["k"], fold).collect()
    assert {r.k: r.v for r in got} == expected
    assert serving.read_changelog(spark, path).count() == 7
    serving.append_changelog(rows(spark, ("b", 4)), path, 3)
    got = {r.k: r.v for r in serving.read_latest(spark, path, ["k"], fold).collect()}
    assert got == {**expected, "b": 4}


def test_folded_batches_are_not_opened_again(spark):
    path, first, second = fresh(), fresh(), fresh()
    for number in range(3):
        serving.append_changelog(rows(spark, ("a", number), (f"k{number}", 0)), path, number)
    serving.fold_changelog(spark, path, ["k"], first, through=1)
    serving.fold_changelog(spark, path, ["k"], second, through=2, earlier=first)
    schema = rows(spark, ("a", 1)).schema
    versions = serving.read_changelog(spark, path, schema)
    damage(f"{path}/batch_id=1/**")
    assert versions.where("batch_id > 1").count() == 2
    latest = serving.read_latest(spark, path, ["k"], second)
    assert {r.k: r.v for r in latest.collect()} == {"a": 2, "k0": 0, "k1": 0, "k2": 0}


def test_upsert_rewrites_only_touched_buckets(spark):
    path = fresh()
    serving.upsert(rows(spark, *[(f"k{i}", i) for i in range(200)]), path, ["k"], buckets=16)
    first = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/key_bucket=*/*.parquet")}
    assert len({os.path.dirname(f) for f in first}) == 16
    serving.upsert(rows(spark, ("k7", -7)), path, ["k"], buckets=16)
    second = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/key_bucket=*/*.parquet")}
    changed = {os.path.dirname(f) for f, _ in set(first.items()) ^ set(second.items())}
    assert len(changed) == 1
    schema = rows(spark, ("a", 1)).schema
    got = {r.k: r.v for r in serving.read_current(spark, path, schema).collect()}
    assert got == {**{f"k{i}": i for i in range(200)}, "k7": -7}


def test_a_failed_upsert_leaves_the_table(spark):
    path, schema = fresh(), rows(spark, ("a", 1)).schema
    assert serving.read_current(spark, path, schema).count() == 0
    serving.upsert(rows(spark, ("a", 1), ("b", 1)), path, ["k"])
    broken = rows(spark, ("a", 2)).withColumn("v", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        serving.upsert(broken, path, ["k"])
    assert {r.k: r.v for r in serving.read_current(spark, path).collect()} == {"a": 1, "b": 1}


def test_upsert_of_repeated_and_of_no_rows(spark):
    path, schema = fresh(), rows(spark, ("a", 1)).schema
    serving.upsert(rows(spark, ("a", 1), ("a", 1), (None, 1)), path, ["k"])
    serving.upsert(rows(spark, ("a", 1)).where("k = 'z'"), path, ["k"])
    got = serving.read_current(spark, path, schema).collect()
    assert sorted(got, key=str) == sorted([("a", 1), (None, 1)], key=str)
