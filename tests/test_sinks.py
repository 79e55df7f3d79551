import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowengine.operators import layout, traffic
from flowengine.schema import FLOW_SCHEMA
from flowengine.sinks import catalog, files
from flowengine.sources import flows as source


@pytest.fixture
def skewed(spark):
    """Half of all rows, copies of one another, from one source on one day."""
    n = 40_000
    i = F.col("id")
    hot = i < n // 2
    day = F.when(hot, 1).otherwise(i % 28 + 1)
    return spark.range(0, n, 1, 16).select(
        F.format_string("2024-01-%02dT00:00:%02d", day, F.when(hot, 0).otherwise(i % 60)).alias("timestamp"),
        F.when(hot, "6.6.6.6").otherwise(F.concat(F.lit("10.0.0."), (i % 200).cast("string"))).alias("src_ip"),
        F.lit("10.0.0.5").alias("dst_ip"),
        F.when(hot, 1).otherwise(i % 60000).cast("int").alias("src_port"),
        F.lit(80).alias("dst_port"),
        F.lit("TCP").alias("protocol"),
        F.lit(1).alias("packet_count"),
        F.when(hot, 1).otherwise(i).alias("byte_count"),
        F.lit(0.5).alias("duration"),
        F.lit("SYN").alias("flag"),
        F.lit("BENIGN").alias("label"),
    )


@pytest.fixture
def small_partitions(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "8kb")
    yield
    spark.conf.set(key, old)


def rows_per_file(spark, path):
    counts = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).count()
    return [r["count"] for r in counts.collect()]


def test_hashed_layout_splits_a_hot_source(spark, skewed, tmp_path, small_partitions):
    path = str(tmp_path / "hashed")
    files.write_hashed(skewed, path, 8)
    # half of the rows share one key; the pieces are the outputs of one or two map tasks
    assert max(rows_per_file(spark, path)) <= 5_000
    stored = spark.read.parquet(path)
    assert stored.count() == 40_000
    assert stored.drop("shard").exceptAll(skewed).count() == 0
    assert stored.groupBy("src_ip").agg(F.count_distinct("shard").alias("n")).filter("n > 1").count() == 0


def test_one_source_reads_one_folder(spark, skewed, tmp_path):
    path = str(tmp_path / "hashed")
    files.write_hashed(skewed, path, 8)
    found = files.read_hashed(spark, path, 8, "6.6.6.6")
    assert found.count() == 20_000
    assert len({f.split("/shard=")[1].split("/")[0] for f in found.inputFiles()}) >= 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan


def test_ranged_layout_splits_a_hot_day_and_prunes(spark, skewed, tmp_path, small_partitions):
    path = str(tmp_path / "ranged")
    files.write_ranged(skewed, path)
    assert max(rows_per_file(spark, path)) <= 5_000
    stored = spark.read.parquet(path)
    assert stored.select(skewed.columns).exceptAll(skewed).count() == 0
    range_ = stored.filter(F.col("day") == F.lit("2024-01-02").cast("date"))
    assert "PartitionFilters: [isnotnull(day" in range_._jdf.queryExecution().executedPlan().toString()
    assert range_.count() == skewed.filter("timestamp like '2024-01-02%'").count()


def test_files_of_a_day_do_not_overlap(spark, tmp_path):
    """A third of the rows on one day; an hour of it is in a few of its files."""
    i = F.col("id")
    hot = i % 3 == 0
    seconds = F.when(hot, 86_400 + i % 86_400).otherwise(i * 61 % (20 * 86_400))
    rows = spark.range(0, 60_000, 1, 8).select(
        F.date_format(F.timestamp_seconds(seconds + 1_704_067_200), "yyyy-MM-dd'T'HH:mm:ss")
        .alias("timestamp"),
        i.alias("byte_count"),
    )
    path = str(tmp_path / "ranged")
    files.write_ranged(rows, path, ranges=30)
    stored = spark.read.parquet(path)
    spans = sorted(
        (r.low, r.high)
        for r in stored.groupBy(F.input_file_name().alias("file")).agg(
            F.min("timestamp").alias("low"), F.max("timestamp").alias("high")
        ).collect()
    )
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    day = [s for s in spans if s[0].startswith("2024-01-02")]
    hour = [s for s in day if s[0] <= "2024-01-02T12:59:59" and s[1] >= "2024-01-02T12:00:00"]
    assert len(day) >= 8 and len(hour) <= 2
    assert stored.drop("day").exceptAll(rows).count() == 0 and stored.count() == 60_000


def test_bucketed_table_needs_no_shuffle(spark, skewed, tmp_path):
    files.write_bucketed(skewed, "bucketed_flows", str(tmp_path / "bucketed"), 8)
    table = spark.table("bucketed_flows")
    assert table.exceptAll(skewed).count() == 0 and table.count() == skewed.count()

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    packets = traffic.packets_by_source(table)
    ports = table.groupBy("src_ip").agg(F.count_distinct("dst_port").alias("ports"))
    one = table.filter(F.col("src_ip") == "10.0.0.7")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        # else a plan that only filters does not say which buckets it reads
        "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    }
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert "Exchange hash" not in plan(packets.join(table.select("src_ip", "label"), "src_ip"))
        assert "Exchange hash" not in plan(packets.join(ports, "src_ip"))
        assert "SelectedBucketsCount: 1 out of 8" in plan(one) and one.count() == 100
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_layout_report_by_digest(spark, skewed):
    report = layout.layout_report(skewed, layout.shard_of("src_ip", 8), 8)
    got = {r.shard: r.rows for r in report.collect()}
    want = Counter(
        int(hashlib.md5(r.src_ip.encode()).hexdigest()[:8], 16) % 8
        for r in skewed.select("src_ip").collect()
    )
    assert got == dict(want)
    assert {r.skew for r in report.collect()} == {round(max(got.values()) * 8 / 40_000, 3)}
    assert sum(r.share_pct for r in report.collect()) == pytest.approx(100, abs=0.1)


@pytest.mark.parametrize("label", ["a,b", "a\nb"])
def test_csv_refuses_what_it_cannot_hold(spark, tmp_path, label):
    rows = spark.createDataFrame([{"label": label}], FLOW_SCHEMA)
    with pytest.raises(Exception, match="does not fit"):
        files.convert_flows(rows, str(tmp_path / "csv"), "csv")


def test_footprint(spark, skewed, tmp_path):
    paths = {}
    for fmt in ("csv", "orc", "parquet"):
        paths[fmt] = str(tmp_path / fmt)
        files.convert_flows(skewed, paths[fmt], fmt)
    got = {r.table: (r.files, r.bytes) for r in layout.storage_footprint(spark, paths).collect()}
    for fmt, path in paths.items():
        parts = [p for p in (tmp_path / fmt).glob("part-*")]
        assert got[fmt] == (len(parts), sum(p.stat().st_size for p in parts))
    assert got["orc"][1] < got["csv"][1] and got["parquet"][1] < got["csv"][1]


def test_orc_is_zlib(spark, skewed, tmp_path):
    files.convert_flows(skewed, str(tmp_path / "orc"), "orc")
    assert list((tmp_path / "orc").glob("*.zlib.orc"))


def test_register_and_describe(spark, skewed, tmp_path):
    tables = {}
    for fmt in ("csv", "orc", "parquet"):
        files.convert_flows(skewed, str(tmp_path / fmt), fmt)
        tables[f"flows_{fmt}"] = (fmt, str(tmp_path / fmt))
    for _ in range(2):  # again over the existing tables
        listed = catalog.register_tables(spark, "netdb", tables)
    assert {r.tableName for r in listed.collect()} == set(tables)
    for name in tables:
        got = spark.sql(f"SELECT count(*) n, sum(byte_count) b FROM netdb.{name}").first()
        assert (got.n, got.b) == (40_000, skewed.agg(F.sum("byte_count")).first()[0])
        described = {r.col_name: r.data_type for r in catalog.describe_table(spark, f"netdb.{name}").collect()}
        assert described["byte_count"] == "bigint" and described["Type"] == "EXTERNAL"
    assert source.read_flows_columnar(spark, tables["flows_orc"][1], "orc").schema == FLOW_SCHEMA
