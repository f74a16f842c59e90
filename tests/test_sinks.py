import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom import storage
from ledgerloom.sinks import tables
from ledgerloom.runlog import RunLog
from ledgerloom.sources.tables import read_jdbc, read_table


def test_load_replaces_stamps_and_counts(spark, tmp_path):
    moment = datetime.datetime(2026, 1, 2, 3, 4, 5)
    log = RunLog()
    for rows in (3, 2):
        loaded = tables.load_tables({"t": spark.range(rows)}, str(tmp_path), "ERP", log, moment)["t"]
    assert loaded.columns == ["id", *tables.AUDIT_COLUMNS]
    assert loaded.count() == 2
    assert {(r._LoadedAt, r._SourceSystem) for r in loaded.collect()} == {(moment, "ERP")}
    assert [tuple(r) for r in log.frame(spark).collect()] == [("load", "t", 3, None), ("load", "t", 2, None)]


def test_without_a_moment_the_load_time_is_used(spark):
    stamped = tables.with_audit(spark.range(2), "ERP")
    assert stamped.filter("_LoadedAt is not null").select("_LoadedAt").distinct().count() == 1


def test_catalog_table_is_replaced(spark):
    for rows in (3, 1):
        tables.replace_table(spark.range(rows), "replaced")
    assert read_table(spark, "replaced").count() == 1
    spark.sql("DROP TABLE replaced")


def test_stored_tables_never_share_a_path(spark):
    paths = {storage.scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3
    root = storage.scratch_root(spark)
    assert all(p.startswith(root) for p in paths)


def settings_of(monkeypatch, spark, **values):
    known = {name.replace("_", "."): value for name, value in values.items()}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, name, default=None: known.get(name, default))


def test_the_clusters_folder_is_used(spark, monkeypatch):
    settings_of(monkeypatch, spark, spark_checkpoint_dir="/shared/here/", spark_master="yarn", spark_app_id="a1")
    assert storage.scratch_root(spark) == "/shared/here"
    assert storage.scratch_path(spark, "x").startswith("/shared/here/a1/x-")


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    settings_of(monkeypatch, spark, spark_master="yarn", spark_app_id="a1")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.scratch_root(spark)


def test_local_mode_may_use_a_temporary_folder(spark, monkeypatch):
    settings_of(monkeypatch, spark, spark_master="local[4]", spark_app_id="a2")
    assert storage.scratch_root(spark) == storage.scratch_root(spark)


def test_stored_table_prunes_and_pushes_down(spark):
    stored = storage.materialize(spark.range(10).withColumn("v", F.col("id") * 2), "t")
    assert stored.filter("id > 7").select("v").count() == 2
    plan = stored.filter("id > 7").select("v")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,7)]" in plan


def test_a_frame_that_was_not_run_has_no_count_yet(spark):
    log = RunLog()
    log.observe(spark.range(4), "extract", "t").write.format("noop").mode("overwrite").save()
    assert log.frame(spark).first().row_count == 4


def test_scratch_needs_a_shared_folder_beyond_local_mode(spark):
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, name, default=None):
            return {"spark.master": self.master, "spark.app.id": "x"}.get(name, default)

    class Session:
        pass

    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        session = Session()
        session.conf = Conf(master)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.scratch_root(session)


def test_scratch_of_a_run_is_removed(spark):
    from pathlib import Path

    before = storage.materialize(spark.range(3), "kept")
    with storage.scratch_of_a_run(spark) as folder:
        assert storage.materialize(spark.range(3), "gone").count() == 3
        assert Path(folder).is_dir()
    assert not Path(folder).exists()
    assert before.count() == 3


def test_jdbc_passes_the_callers_options(spark):
    # No database here: the request must get as far as looking for the driver of the given address.
    options = {"url": "jdbc:nothing://host/db", "user": "u"}
    with pytest.raises(Exception, match="No suitable driver"):
        read_jdbc(spark, "fact_po_line", options)
    with pytest.raises(Exception, match="No suitable driver"):
        tables.replace_jdbc(spark.range(1), "t", options)
