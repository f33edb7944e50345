"""Round trips of sources, sinks and streams; JDBC options without a database."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from shelfcurve.operators import aggregates, history, upsert, windows
from shelfcurve.sources import jdbc, readers, versions, writers
from shelfcurve.streaming import mirror


def test_positional_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID;DAY;NAME\n 1 ; 2024-01-02 ; x \nbad;2024-13-01;y\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("day", T.DateType()), T.StructField("name", T.StringType())])
    got = [(r.id, str(r.day), r.name) for r in readers.read_positional_csv(spark, str(tmp_path), schema, "name").collect()]
    assert sorted(got, key=str) == [(1, "2024-01-02", "x"), (None, "None", "y")]


def test_text_pairs(spark, tmp_path):
    (tmp_path / "ab.txt").write_text("<p>\na -- b\nx\n\nlong -- pair of words\n")
    from shelfcurve.functions.text import swap_pair

    got = readers.read_text_pairs(spark, str(tmp_path)).select(swap_pair(F.col("value"))).collect()
    assert [r[0] for r in got] == ["b -- a", "pair of words -- long"]


def test_scripts_in_buckets(spark, tmp_path):
    paragraphs = spark.createDataFrame(
        [("n", 2, "%py\nb\nc"), ("n", 1, "%py\na"), ("n", 3, "%md"), ("m", 1, "%sql\nselect 1")], "nb string, pos int, text string"
    )
    path = str(tmp_path / "out")
    writers.write_script(readers.notebook_script(paragraphs, "nb", "pos", "text"), path, "nb", "pos", buckets=4)
    lines = writers.read_script(spark, path, "nb", "n", "pos", buckets=4).collect()
    assert "\n".join(r.piece for r in lines) + "\n" == "a\n\nb\nc\n"


def test_files_of_scripts_follow_the_buckets(spark, tmp_path):
    """Many notebooks, one of them with half of the rows."""
    many = spark.range(20_000).selectExpr("if(id % 2 = 0, -1, id) AS nb", "id AS pos", "'x' AS piece")
    path = str(tmp_path / "out")
    stored = writers.write_script(many, path, "nb", "pos", buckets=8)
    assert stored.count() == 20_000 and len(list(Path(path).glob("bucket=*"))) == 8
    assert len(list(Path(path).glob("bucket=*/part-*"))) < 16
    found = [r.pos for r in writers.read_script(spark, path, "nb", -1, "pos", buckets=8).collect()]
    assert found == list(range(0, 20_000, 2))


def test_appended_column_is_null_before(rows, values, tmp_path):
    path = str(tmp_path / "t")
    writers.append_partitioned(rows("d string, a int", ("x", 1)), path, "d")
    both = writers.append_partitioned(rows("d string, a int, b int", ("y", 2, 3)), path, "d")
    assert values(both.select("d", "a", "b")) == [("x", 1, None), ("y", 2, 3)]


def test_moved_partitions_replace_only_themselves(rows, values, tmp_path):
    path = str(tmp_path / "t")
    rows("p string, v int", ("a", 1), ("b", 1)).write.partitionBy("p").parquet(path)
    moved = writers.move_partitions(rows("p string, v int", ("b", 2), ("c", 2)), path, "p")
    assert values(moved.select("p", "v")) == [("a", 1), ("b", 2), ("c", 2)]


def test_mirror_follows_later_batches(spark, rows, values, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "mirror", "check"))
    schema = "k int, v string, at int"
    rows(schema, (1, "a", 1), (1, "b", 2), (2, "x", 1)).coalesce(1).write.parquet(source)

    def run():
        stream = mirror.file_stream(spark, source, T.StructType.fromDDL(schema))
        mirror.upsert_stream(stream, path, checkpoint, ["k"], [F.col("at").desc()])
        return values(mirror.read_mirror(spark, path, ["k"], [F.col("at").desc()]).select("k", "v"))

    assert run() == [(1, "b"), (2, "x")]
    # an older change of 1 that comes late, a newer one of 2
    rows(schema, (1, "c", 0), (2, "y", 5), (3, "n", 1)).coalesce(1).write.mode("append").parquet(source)
    assert run() == [(1, "b"), (2, "y"), (3, "n")]
    assert run() == [(1, "b"), (2, "y"), (3, "n")]  # nothing new
    compact = mirror.compact_mirror(spark, path, ["k"], [F.col("at").desc()])
    assert len(compact.segments) == 1 and run() == [(1, "b"), (2, "y"), (3, "n")]


def test_segments_of_a_mirror_stay_few():
    segments = []
    for n in range(200):
        segments.append(versions.Segment(str(n), "", 0))
        while (tier := mirror._full_tier(segments, 4)) is not None:
            segments = [s for s in segments if s.tier != tier] + [versions.Segment("m", "", tier + 1)]
        assert len(segments) <= 3 * 4  # fewer than 4 in each of 4 tiers
    assert max(s.tier for s in segments) == 3


def test_mirror_over_many_batches(spark, rows, values, tmp_path):
    path, schema, newest = str(tmp_path / "m"), "k int, at int, v int", [F.col("at").desc()]
    rng, current = random.Random(1), {}
    for n in range(9):
        made = [(rng.randrange(6), rng.randrange(20), 100 * n + i) for i in range(4)]
        made = list({(k, at): (k, at, v) for k, at, v in made}.values())
        for k, at, v in made:
            if k not in current or at >= current[k][1]:
                current[k] = (k, at, v)
        for again in (False, True):  # a batch that comes twice counts once
            assert mirror.apply_batch(rows(schema, *made), n, path, "s", ["k"], newest, fan=2) is not again
        assert values(mirror.read_mirror(spark, path, ["k"], newest)) == sorted(current.values(), key=str)
    assert len(versions.version(spark, path).segments) == 2  # 9 = 8 + 1


def test_readers_see_old_or_new(spark, rows, values, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "k int, v string"
    publish = lambda *r: upsert.staged_publish(rows(schema, *r), str(tmp_path / "stage"), path, ["k"])
    publish((1, "a"), (2, "a"))
    old = versions.read(spark, path)
    with monkeypatch.context() as broken:

        def fail(*args, **kw):
            # all rows are written, nothing is published: a reader sees the old version
            assert values(versions.read(spark, path)) == [(1, "a"), (2, "a")]
            raise OSError("lost")

        broken.setattr(versions, "publish", fail)
        with pytest.raises(OSError):
            publish((2, "b"))
    assert values(versions.read(spark, path)) == [(1, "a"), (2, "a")]
    assert values(publish((2, "b"), (3, "b"))) == [(1, "a"), (2, "b"), (3, "b")]
    assert values(old) == [(1, "a"), (2, "a")]  # a reader that began before keeps its version
    assert values(publish()) == [(1, "a"), (2, "b"), (3, "b")] and versions.versions(spark, path) == [1, 2]
    assert versions.remove_unlisted(spark, path, keep=1) == 2  # that of version 1 and the lost one
    assert values(versions.read(spark, path)) == [(1, "a"), (2, "b"), (3, "b")]


def test_of_two_writers_one_fails(spark, rows, values, tmp_path):
    path = str(tmp_path / "t")
    start = versions.replace(rows("k int", (1,)), path)
    versions.replace(rows("k int", (2,)), path, start)
    with pytest.raises(versions.VersionConflict):
        versions.replace(rows("k int", (3,)), path, start)
    assert values(versions.read(spark, path)) == [(2,)]
    assert not list((tmp_path / "t" / "manifest").glob("draft*"))


def test_profiles_are_kept_once(spark, rows, values, tmp_path):
    path = str(tmp_path / "h")
    for n, taken in ((3, "2024-01-01"), (5, "2024-02-01"), (5, "2024-02-01")):
        day = F.lit(taken).cast("date")
        history.append_profiles(aggregates.table_profile(spark.range(n), "a", day).unionByName(aggregates.table_profile(spark.range(1), "b", day)), path)
    kept = windows.change_between_snapshots(history.read_history(spark, path), "table_name", "taken_at", "row_count")
    assert [(r[0], r[1], r[2]) for r in values(kept.select("table_name", "row_count", "change"))] == [
        ("a", 3, None), ("a", 5, 2), ("b", 1, 0), ("b", 1, None),
    ]


def test_jdbc_options():
    assert jdbc.subquery("SELECT 1;") == "(SELECT 1) src"
    options = jdbc.modulus_options("mdn", 10)
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("0", "10", "10")
    connection = jdbc.Connection("jdbc:x:y", "some.Driver", {"user": "u"})
    assert connection.options() == {"url": "jdbc:x:y", "driver": "some.Driver", "user": "u"}


def test_modulus_ranges_hold_one_remainder_each():
    """Spark cuts [lower, upper) into equal strides: with upper = modulus the stride is one."""
    options = jdbc.modulus_options("mdn", 10)
    lower, upper, n = (int(options[o]) for o in ("lowerBound", "upperBound", "numPartitions"))
    assert min(n, upper - lower) == 10 and (upper - lower) / n == 1


def test_number_of_writers(spark, tmp_path):
    path = str(tmp_path / "three")
    assert writers.overwrite_table(spark.range(100), path, partitions=3).count() == 100
    assert len(list(Path(path).glob("part-*"))) == 3


@pytest.mark.parametrize("sep", [",", ";"])
def test_csv_export(spark, tmp_path, sep):
    path = writers.export_csv(spark.range(3), str(tmp_path / "csv"), sep)
    assert spark.read.option("header", True).option("sep", sep).csv(path).count() == 3
