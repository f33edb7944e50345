from pathlib import Path

import pytest

from shelfcurve import session
from shelfcurve.sources import retail


def test_tables_go_to_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    df = session.materialise(spark.range(10), "numbers")
    assert session.shared_folder(spark) == (folder or spark.sparkContext.getCheckpointDir())
    assert all(session.shared_folder(spark).removeprefix("file:") in f for f in df.inputFiles())
    assert df.count() == 10 and df.dtypes == [("id", "bigint")]


def test_a_finished_run_leaves_nothing(spark, sf_dir, tmp_path):
    folder = Path(session.shared_folder(spark).removeprefix("file:"))
    kept = session.materialise(spark.range(3), "kept")
    before, out = set(folder.iterdir()), str(tmp_path / "pairs")
    with session.run_scope(spark):
        retail.price_pairs(spark, sf_dir).write.parquet(out)
        assert set(folder.iterdir()) > before
    assert set(folder.iterdir()) == before
    assert kept.count() == 3 and spark.read.parquet(out).count() > 0


def test_a_stored_result_is_all_that_is_left(spark):
    folder = Path(session.shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())

    def make():
        inner = session.store(spark, lambda: session.materialise(spark.range(5), "a"), "b")
        return session.materialise_buckets(inner, "id", 2, "c").where("id > 1")

    kept = session.store(spark, make, "d")
    assert kept.count() == 3 and len(set(folder.iterdir()) - before) == 1
    with pytest.raises(ZeroDivisionError):
        session.store(spark, lambda: session.materialise(spark.range(5), "a").limit(1 // 0), "d")
    session.discard(kept)
    assert set(folder.iterdir()) == before


def test_a_cluster_needs_the_setting():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Cluster:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.shared_folder(Cluster())


def test_library_does_not_collect():
    """No driver-side rows, no Python UDF, no cross join in the library."""
    library = Path(session.__file__).parent
    for source in library.rglob("*.py"):
        if source.parent.name == "llm":  # free in style
            continue
        text = source.read_text()
        for word in (".collect()", "toPandas", "crossJoin", "localCheckpoint", "pandas_udf", "mapInPandas", ".rdd"):
            assert word not in text, (source, word)


def test_a_plain_table_tells_its_size(spark):
    """Equal values pack a hundredfold, and the planner takes the size of files for that of rows."""
    df = spark.range(100_000).selectExpr("1.5D AS v")
    size = lambda t: int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert size(session.materialise(df, "packed")) < 100_000
    assert size(session.materialise(df, "plain", plain=True)) >= 800_000
    assert size(session.materialise_buckets(df, "v", 2, "plain", plain=True)) >= 800_000
