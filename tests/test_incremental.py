"""Incremental loads: rows of a load counted by its own micro-batches."""

from pyspark.sql import functions as F

from statmart.streaming import incremental


def test_rows_of_a_load_with_other_writers(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("landing", "table", "checkpoint"))
    rows = spark.range(100).select("id", F.concat(F.lit("v"), "id").alias("v"))
    rows.repartition(7).write.json(f"{source}/a")
    kept = spark.conf.get(incremental.REPORTS)
    spark.conf.set(incremental.REPORTS, "2")  # fewer reports than batches
    try:
        load = lambda: incremental.load_new_files(spark, source, target, checkpoint, rows.schema,
                                                  max_files_per_trigger=1)
        assert load() == 100
        # another writer's files in the target's folder are no rows of ours
        rows.where("id < 30").write.mode("append").parquet(target + "/other")
        rows.where("id < 11").repartition(3).write.json(f"{source}/b")
        assert load() == 11
        assert load() == 0
        assert spark.conf.get(incremental.REPORTS) == "2"
    finally:
        spark.conf.set(incremental.REPORTS, kept)
    assert spark.read.parquet(target).count() == 111


def test_target_is_not_read(spark, tmp_path, monkeypatch):
    source, target, checkpoint = (str(tmp_path / x) for x in ("landing", "table", "checkpoint"))
    rows = spark.range(5).select("id")
    rows.write.json(source)
    monkeypatch.setattr(type(spark.read), "parquet", lambda *a, **k: (_ for _ in ()).throw(AssertionError("read")))
    assert incremental.load_new_files(spark, source, target, checkpoint, rows.schema) == 5
