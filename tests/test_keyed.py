"""Keyed tables: upserts by touched bucket, crashes between any two steps, replay."""

import os

import pytest
from pyspark.sql import functions as F

from cinelens.sources import is_keyed_table, read_keyed, write_keyed, write_keyed_table


class Crash(Exception):
    pass


def crash_at(n):
    """A step hook that raises at the n-th step."""
    seen = []

    def step(name):
        seen.append(name)
        if len(seen) == n:
            raise Crash(name)

    return step, seen


def rows(spark, path):
    return sorted(tuple(r) for r in read_keyed(spark, path).collect())


def table(spark, pairs):
    return spark.createDataFrame(pairs, "id long, v string")


@pytest.mark.parametrize("mode", ["upsert", "overwrite"])
def test_a_crash_between_any_two_steps_loses_nothing(spark, tmp_path, mode):
    old, new = [(i, "old") for i in range(8)], [(i, "new") for i in (2, 3, 9)]
    after = sorted({**dict(old), **dict(new)}.items()) if mode == "upsert" else sorted(new)
    n = 0
    while True:
        n += 1
        path = str(tmp_path / f"t{mode}{n}")
        write_keyed(table(spark, old), path, "id", buckets=3)
        step, seen = crash_at(n)
        try:
            write_keyed(table(spark, new), path, "id", mode=mode, step=step)
        except Crash:
            # a reader that comes next sees the table before or after the write, never less
            assert rows(spark, path) == (after if "committed" in seen else sorted(old)), seen
            write_keyed(table(spark, new), path, "id", mode=mode)  # the replay
            assert rows(spark, path) == after, seen
            assert not os.path.exists(path + ".staged")
            continue
        assert rows(spark, path) == after and n > 4
        break


def test_a_crash_while_making_the_table(spark, tmp_path):
    for n in range(1, 20):
        path = str(tmp_path / f"m{n}")
        step, seen = crash_at(n)
        try:
            write_keyed(table(spark, [(1, "a"), (2, "b"), (3, "c")]), path, "id", mode="upsert", buckets=3, step=step)
        except Crash:
            write_keyed(table(spark, [(1, "a"), (2, "b"), (3, "c")]), path, "id", mode="upsert", buckets=3)
            assert rows(spark, path) == [(1, "a"), (2, "b"), (3, "c")]
        else:
            return
    raise AssertionError("steps never ended")


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    path = str(tmp_path / "t")
    write_keyed(table(spark, [(i, "old") for i in range(2000)]), path, "id", buckets=100)
    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
                for d, _, names in os.walk(path) for f in names if f.startswith("part-")}
    before = files()
    one = table(spark, [(7, "new")])
    bucket = one.select(F.pmod(F.hash("id"), F.lit(100))).first()[0]
    for name in os.listdir(path):  # the other buckets are not even readable
        if name.startswith("key_bucket=") and name != f"key_bucket={bucket}":
            for f in os.listdir(os.path.join(path, name)):
                if f.startswith("part-"):
                    os.rename(os.path.join(path, name, f), os.path.join(path, name, f"_{f}"))
    write_keyed(one, path, "id", mode="upsert")
    for d, _, names in os.walk(path):
        for f in names:
            if f.startswith("_part-"):
                os.rename(os.path.join(d, f), os.path.join(d, f[1:]))
    after = files()
    changed = {os.path.basename(os.path.dirname(f)) for f in before.keys() ^ after.keys()}
    assert changed == {f"key_bucket={bucket}"}
    got = dict(rows(spark, path))
    assert len(got) == 2000 and got[7] == "new" and got[8] == "old"


def test_key_types_new_columns_and_odd_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    write_keyed(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, v string, w double"), path, ["id"], buckets=4)
    # an int key is the same key; a missing column becomes NULL, a new one is NULL in the rows that stay
    write_keyed(spark.createDataFrame([(2, "B", "x"), (3, "C", "y")], "id int, v string, u string"), path, ["id"], mode="upsert")
    got = sorted((r.id, r.v, r.w, r.u) for r in read_keyed(spark, path).collect())
    assert got == [(1, "a", 1.0, None), (2, "B", None, "x"), (3, "C", None, "y")]
    write_keyed(spark.createDataFrame([], "id long, v string"), path, ["id"], mode="upsert")
    assert read_keyed(spark, path).count() == 3
    write_keyed(spark.createDataFrame([(None, "n"), (None, "m")], "id long, v string"), path, ["id"], keep="last", mode="upsert")
    assert [r.v for r in read_keyed(spark, path).where("id IS NULL").collect()] == ["n"]
    with pytest.raises(ValueError):
        write_keyed(table(spark, [(1, "a")]), path, ["v"], mode="upsert")
    with pytest.raises(FileExistsError):
        write_keyed(table(spark, [(1, "a")]), path, ["id"])
    with pytest.raises(ValueError):
        write_keyed(table(spark, [(1, "a")]).withColumnRenamed("v", "key_bucket"), path, ["id"], mode="upsert")
    empty = str(tmp_path / "e")
    write_keyed(table(spark, []), empty, "id")
    assert is_keyed_table(spark, empty) and rows(spark, empty) == []
    write_keyed(table(spark, [(1, "a")]), empty, "id", mode="upsert")
    assert rows(spark, empty) == [(1, "a")]


def test_plain_parquet_becomes_a_keyed_table(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, [(1, "a"), (2, "b")]).write.parquet(path)
    assert not is_keyed_table(spark, path)
    write_keyed(table(spark, [(2, "B")]), path, "id", mode="upsert", buckets=3)
    assert rows(spark, path) == [(1, "a"), (2, "B")]
    assert sorted(spark.read.parquet(path).select("id", "v").collect()) == [(1, "a"), (2, "B")]


def test_the_swap_of_a_partitioned_table_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    write_keyed_table(table(spark, [(1, "a"), (2, "b")]), path, "id", partition_by="v")
    # as a crash between the two renames leaves it
    table(spark, [(1, "a"), (2, "B")]).write.partitionBy("v").parquet(path + ".merge")
    os.rename(path, path + ".old")
    write_keyed_table(table(spark, [(3, "c")]), path, "id", partition_by="v", mode="upsert")
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert not os.path.exists(path + ".old")
