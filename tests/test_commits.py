"""Tables written in units: repeated, interrupted and resumed runs end alike."""

import pytest
from pyspark.sql import functions as F

from quantloom.sources import commits as C


def rows(df):
    return sorted(map(repr, df.collect()))


def test_append_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", 2020), (2, None, 2021), (2, None, 2021)], "k long, v string, y int")
    more = spark.createDataFrame([(1, "a", 2020), (3, "c", 2020), (2, None, 2021), (4, "d", 2022)], "k long, v string, y int")
    C.append_distinct(spark, path, first, ["y"])
    once = rows(C.append_distinct(spark, path, more, ["y"]).select("k", "v", "y"))
    assert once == rows(C.append_distinct(spark, path, more, ["y"]).select("k", "v", "y"))
    assert once == rows(first.union(more).distinct())
    wide = more.withColumn("extra", F.lit(7))
    got = C.append_distinct(spark, path, wide.where("y = 2022"), ["y"])
    assert got.where("y = 2022").count() >= 1 and got.where("y < 2022").count() == 3


def test_untouched_partitions_are_not_written(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    C.append_distinct(spark, path, spark.createDataFrame([(1, 1), (2, 2)], "k long, y int"), ["y"])
    before = sorted(os.listdir(f"{path}/y=1"))
    C.append_distinct(spark, path, spark.createDataFrame([(3, 2)], "k long, y int"), ["y"])
    assert sorted(os.listdir(f"{path}/y=1")) == before and spark.read.parquet(path).count() == 3


def test_units_resume_after_a_failure(spark, tmp_path):
    out, manifest, seen = str(tmp_path / "o"), str(tmp_path / "m"), []
    df = spark.createDataFrame([(i, u) for i, u in enumerate(["a", "b", "b", None, "c"])], "k long, u string")

    def work(part):
        seen.append({r.u for r in part.collect()})
        return part.withColumn("twice", F.col("k") * 2)

    def broken(part):
        C.overwrite_partitions(work(part).limit(1), out, ["u"])  # writes something, then fails
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        C.process_units(df, "u", broken, out, manifest, "r0", only=["b"])
    assert C.finished(spark, manifest).count() == 0
    assert sorted(r.unit for r in C.process_units(df, "u", work, out, manifest, "r1", only=["a", "b"]).collect()) == ["a", "b"]
    assert sorted(r.unit for r in C.process_units(df, "u", work, out, manifest, "r2").collect()) == ["__null__", "c"]
    assert C.process_units(df, "u", work, out, manifest, "r3").count() == 0
    assert seen == [{"b"}, {"a", "b"}, {"__null__", "c"}]
    assert sorted((r.k, r.twice) for r in spark.read.parquet(out).collect()) == [(i, 2 * i) for i in range(5)]
    assert {r.unit: r.rows for r in C.finished(spark, manifest).collect()} == {"a": 1, "b": 2, "__null__": 1, "c": 1}


def test_a_unit_without_results_is_finished(spark, tmp_path):
    out, manifest = str(tmp_path / "o"), str(tmp_path / "m")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, u string")
    C.process_units(df, "u", lambda d: d.where("k > 1"), out, manifest, "r")
    assert {r.unit: r.rows for r in C.finished(spark, manifest).collect()} == {"a": 0, "b": 1}


def test_compaction_and_its_dry_run(spark, tmp_path):
    files = [str(tmp_path / f"in{i}") for i in range(2)]
    spark.createDataFrame([(1, "x")], "k long, v string").repartition(3).write.parquet(files[0])
    spark.createDataFrame([(2, 5)], "k int, v int").write.parquet(files[1])
    out, manifest = str(tmp_path / "o"), str(tmp_path / "m")
    assert C.compact(spark, {"t": files}, out, manifest, "r0", dry_run=True).count() == 0
    assert [(r.unit, r.rows) for r in C.compact(spark, {"t": files}, out, manifest, "r1").collect()] == [("t", 2)]
    assert C.compact(spark, {"t": files}, out, manifest, "r2").count() == 0
    assert sorted(r.v for r in spark.read.parquet(f"{out}/t").collect()) == ["5", "x"]


def test_file_statistics_and_markdown(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(3).write.parquet(path)
    stats = C.file_statistics(spark, path)
    assert sum(r.rows for r in stats.collect()) == 100 and all(r.file_size > 0 for r in stats.collect())
    assert "ReadSchema: struct<>" in stats._jdf.queryExecution().toString()
    lines = [r.content for r in C.markdown(spark.createDataFrame([(2, None), (1, "a")], "k int, v string"), ["k"]).orderBy("line").collect()]
    assert lines == ["| k | v |", "| - | - |", "| 1 | a |", "| 2 | None |"]
