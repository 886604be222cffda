from fitframe.operators import impute
from fitframe.plans.pipeline import Chain, Step
from fitframe.streaming.replay import dedup_stream, read_stream, score_stream


def as_files(parts, tmp_path):
    """One Parquet file per frame, named so that a stream reads them in order."""
    import shutil
    (tmp_path / "in").mkdir()
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{tmp_path}/part{i}")
        (one,) = (tmp_path / f"part{i}").glob("*.parquet")
        shutil.copy(one, tmp_path / "in" / f"{i}.parquet")


def test_a_replayed_stream_with_late_and_repeated_rows_equals_the_batch(spark, tmp_path):
    """Three files: repeats within and across files, rows up to 50 minutes late."""
    base = spark.range(120).selectExpr("id", "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, cast(id as int), 0) as ts",
                                       "case when id % 7 = 0 then null else cast(id as double) end as v")
    as_files([base.where("id < 60").unionByName(base.where("id between 10 and 30")),
              base.where("id between 50 and 100").unionByName(base.where("id between 40 and 45")),
              base.where("id >= 90 or id between 60 and 70").unionByName(base.where("id = 119"))], tmp_path)
    chain = Chain([Step("impute", lambda d, p: impute.fit_median_fill(d, ["v"], p["order"]))]).fit(base)
    stream = read_stream(spark, f"{tmp_path}/in", base.schema, max_files_per_trigger=1)
    score_stream(stream, chain, f"{tmp_path}/out", f"{tmp_path}/ckpt", dedup=("ts", "1 hour")).awaitTermination(180)
    got = sorted((r.id, r.ts, r.v) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    batch = spark.read.parquet(f"{tmp_path}/in")
    assert batch.count() > 120
    want = sorted((r.id, r.ts, r.v) for r in chain.transform(batch.dropDuplicates()).collect())
    assert got == want and len(got) == 120


def test_rows_beyond_the_horizon_and_without_time(spark, tmp_path):
    rows = [spark.sql("select 1L id, timestamp'2024-01-01 10:00:00' ts, 1D v"), spark.sql("select 2L id, timestamp'2024-01-01 15:00:00' ts, 1D v"),
            spark.sql("select 1L id, timestamp'2024-01-01 10:00:00' ts, 1D v union all select 3L, null, 1D union all select 4L, timestamp'2024-01-01 14:59:00', 1D")]
    as_files(rows, tmp_path)
    stream = read_stream(spark, f"{tmp_path}/in", rows[2].schema, max_files_per_trigger=1)
    q = (dedup_stream(stream, "ts", "10 minutes", ["id"]).writeStream.format("parquet").option("path", f"{tmp_path}/out")
         .option("checkpointLocation", f"{tmp_path}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(180)
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 4]
