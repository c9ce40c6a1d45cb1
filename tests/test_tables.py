import pytest
from pyspark.sql import functions as F

from riskloom import session
from riskloom.plans.integrate import column_difference
from riskloom.sources.tables import read_csv, write_table


def test_csv_round_trip_with_and_without_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, "a"), (2, None, "b")], "SK_ID_CURR long, x double, s string")
    write_table(df, str(tmp_path / "t"), fmt="csv")
    pinned = read_csv(spark, str(tmp_path / "t"), schema="SK_ID_CURR long, x double, s string")
    assert sorted(map(tuple, pinned.collect())) == sorted(map(tuple, df.collect()))
    keyed = read_csv(spark, str(tmp_path / "t"), key_types={"SK_ID_CURR": "long"})
    assert dict(keyed.dtypes) == {"SK_ID_CURR": "bigint", "x": "string", "s": "string"}


def test_parquet_partitions(spark, tmp_path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") % 5 == 0, "test").otherwise("train"))
    write_table(df, str(tmp_path / "p"), partition_by=["split"])
    assert sorted(p.name for p in (tmp_path / "p").iterdir() if p.is_dir()) == ["split=test", "split=train"]
    assert spark.read.parquet(str(tmp_path / "p")).count() == 10


def test_column_difference():
    assert column_difference(["a", "b", "TARGET"], ["b", "c"]) == {"train_only": ["a"], "test_only": ["c"]}


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    master = "spark://cluster:7077"

    def getCheckpointDir(self):
        return None


class _Session:
    conf, sparkContext = _Conf(), _Context()


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Session())


def test_a_compact_scan_is_spread_and_a_fitted_frame_has_few_parts(spark, tmp_path, monkeypatch):
    from riskloom import session
    monkeypatch.setattr(session, "ROWS_TO_SPREAD", 10)
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    cores = spark.sparkContext.defaultParallelism
    out = session.spread(scan, "id")
    assert scan.rdd.getNumPartitions() == 1 and out.rdd.getNumPartitions() == cores
    assert sorted(r.id for r in out.collect()) == list(range(1000))
    assert session.spread(scan.limit(10), "id").rdd.getNumPartitions() == 1
    frame = session.fit_frame(scan.repartition(4 * cores, "id"))
    assert frame.rdd.getNumPartitions() == cores and frame.count() == 1000
    monkeypatch.setattr(session, "MOST_ROWS_A_PART", 1000 // (2 * cores))
    assert cores < session.fit_frame(scan.repartition(4 * cores, "id")).rdd.getNumPartitions() <= 4 * cores


def test_parts_of_a_scan_that_hold_most_rows_are_levelled(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    monkeypatch.setattr(session, "ROWS_TO_SPREAD", 100)
    n = 4_000
    pq.write_table(pa.table({"id": [None if i % 7 == 0 else i for i in range(n)], "x": [float(i % 10) for i in range(n)]}), tmp_path / "one.parquet", row_group_size=n)
    monkeypatch.setattr(session, "MOST_ROWS_A_PART", n)
    scan = spark.read.parquet(str(tmp_path / "one.parquet"))
    by_part = lambda d: [r["count"] for r in d.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(by_part(scan)) == n  # one row group is read by one task
    cores = spark.sparkContext.defaultParallelism
    out = session.level(scan)
    # nulls and equal values of one column do not gather rows: whole rows are dealt; equal rows (571 ids are null, 10 values) stay together
    assert max(by_part(out)) <= n / cores + n / 7
    assert sorted(map(str, out.collect())) == sorted(map(str, scan.collect()))
    assert [r for p in out.rdd.glom().collect() for r in p] == [r for p in session.level(scan).rdd.glom().collect() for r in p]
    monkeypatch.setattr(session, "MOST_ROWS_A_PART", n // (3 * cores))
    assert session.level(scan).rdd.getNumPartitions() == 3 * cores + (cores if n % (3 * cores) else 0)
    even = scan.repartition(cores, "id", "x")
    assert session.level(even.where("id is not null")).rdd.getNumPartitions() == cores
    assert session.level(scan.limit(50)).rdd.getNumPartitions() == 1
