"""Reading, writing, staging and publishing."""

from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from creditmart import schemas
from creditmart.operators import clean, summaries
from creditmart.plans import catalog, warehouse
from creditmart.sources import files, publish
from creditmart.sources.feeds import accepted_feed, rejected_feed
from creditmart.sources.stage import clear_stage, local_root, stage, stage_root, stage_table, staging

HEADER = "Amount Requested,Application Date,Loan Title,Risk_Score,Debt-To-Income Ratio,Zip Code,State,Employment Length,Policy Code"
DIRTY = [
    "1000.0,2015-01-02,car,700,10%,945xx,CA,1 year,0",
    "2000.0,2015-01-02,,,100.00%,123xx,NY,,0",
    '3000.0,bad,"",650,-1%,123xx,NY,"",0',
    "4000.0,2015-13-01,x,650,5%,123xx,NY,  1 year,0",
    "bad,2015-01-02,x,650,5%,123xx,NY,2 years,0",
    "5000.0,2015-01-02,x,650,n/a,123xx,TX,10+ years,0",
]


def test_rejected_csv_dirt(spark, tmp_path):
    path = tmp_path / "rejected.csv"
    path.write_text("\n".join([HEADER, *DIRTY]) + "\n")
    raw = files.read_rejected_csv(spark, str(path))
    assert raw.columns == list(schemas.REJECTED_COLUMNS)
    assert {t for _, t in raw.dtypes} == {"string"}
    got = {(r.loan_amnt, r.addr_state, r.emp_length, r.dti) for r in clean.clean_rejected(raw).collect()}
    # Empty employment is dropped, quoted or not; padded labels too; unreadable DTI passes.
    assert got == {(1000.0, "CA", 1.0, 10.0), (5000.0, "TX", 10.0, None)}


def test_positional_rename_checks_arity(spark):
    with pytest.raises(ValueError, match="expected 9 columns"):
        files.rename_positional(spark.range(1).toDF("a"), schemas.REJECTED_COLUMNS)


def test_accepted_csv_round_trip(spark, sf_dir, tmp_path):
    feed = accepted_feed(spark, sf_dir).drop("app_id")
    wide = feed.selectExpr("*", *(f"'z' AS extra_{i}" for i in range(20)))
    path = str(tmp_path / "accepted")
    wide.write.option("header", True).csv(path)
    back = files.read_accepted_csv(spark, path, feed.columns)
    assert clean.clean_accepted(back).exceptAll(clean.clean_accepted(feed)).count() == 0
    assert clean.clean_accepted(back).count() == clean.clean_accepted(feed).count() > 0
    assert "extra_1" not in back.drop("term")._jdf.queryExecution().executedPlan().toString()


def test_detail_csv_keeps_leading_zeros_and_reads_gzip(spark, tmp_path):
    path = tmp_path / "detail.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write(",".join(schemas.DETAIL.names) + "\n1.5,car,CA,1.0,,012,1\n")
    row = files.read_detail_csv(spark, str(path)).first()
    assert (row.zip_code, row.dti, row.label) == ("012", None, 1)


def test_write_layer_counts_while_writing_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "layer")
    assert files.write_layer(spark.range(10), path) == 10
    assert files.write_layer(spark.range(3), path) == 3
    assert files.read_layer(spark, path).count() == 3


def test_export_is_one_file_only_when_asked(spark, tmp_path):
    def parts(p):
        return len(list(p.glob("part-*.csv")))

    df = spark.range(100).repartition(4)
    assert files.export_csv(df, str(tmp_path / "a"), single_file=True) == 100
    assert files.export_csv(df, str(tmp_path / "b")) == 100
    assert parts(tmp_path / "a") == 1 and parts(tmp_path / "b") == 4


def test_jdbc_options():
    options = files.jdbc_options("jdbc:x://h/db", "SELECT 1 AS a", {"user": "u", "driver": "d"})
    assert options["dbtable"] == "(SELECT 1 AS a) AS t" and options["user"] == "u"
    ranged = files.partitioned_jdbc_options(options, "id", 0, 100, 8)
    assert (ranged["partitionColumn"], ranged["numPartitions"]) == ("id", "8")


def test_staging_shares_equal_plans_and_removes_them(spark):
    with staging(spark):
        a, b, c = (stage(spark.range(n), "shared") for n in (5, 5, 6))
        assert a is b and c is not a and a.count() == 5
        folder = Path(a.inputFiles()[0].removeprefix("file://")).parent
        assert folder.exists()
    assert not folder.exists()


def test_stage_uses_the_named_folder_and_is_cleared(spark):
    assert stage_root(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5
    assert staged.inputFiles()[0].removeprefix("file://").startswith(stage_root(spark))
    assert clear_stage(spark)


def test_published_schemas_and_conform(spark, sf_dir):
    assert len(schemas.PUBLISHED) == 18

    def columns(schema):
        return [(f.name, f.dataType) for f in schema]

    inputs = catalog.report_inputs(spark, sf_dir, staged=True)
    for name, mart in warehouse.reporting_marts().items():
        assert columns(publish.conform(mart.build(inputs), name).schema) == columns(schemas.PUBLISHED[name])


def test_conform_rejects_missing_columns_and_long_text(spark, sf_dir):
    geo = summaries.geo_stats(catalog.detail(spark, sf_dir))
    with pytest.raises(Exception, match="avg_dti"):
        publish.conform(geo.drop("avg_dti"), "geo_lookup")
    long = geo.withColumn("addr_state", geo.addr_state.substr(1, 0)).selectExpr(
        "'California' AS addr_state", *[c for c in geo.columns if c != "addr_state"]
    )
    with pytest.raises(Exception, match="longer than 5"):
        publish.conform(long, "geo_lookup").collect()


def test_publishing_twice_does_not_double(spark, sf_dir, tmp_path):
    geo = summaries.geo_stats(catalog.detail(spark, sf_dir))
    order = warehouse.lookup_marts()["geo_lookup"].order_by
    path = publish.publish_parquet(geo, "geo_lookup", str(tmp_path), order)
    first = spark.read.parquet(path).count()
    publish.publish_parquet(geo, "geo_lookup", str(tmp_path), order)
    assert publish.read_published(spark, "geo_lookup", str(tmp_path)).count() == first > 0
    spark.sql("CREATE DATABASE IF NOT EXISTS serving")
    assert spark.table(publish.publish_table(geo, "geo_lookup", "serving")).count() == first


def test_warehouse_build(spark, sf_dir, tmp_path):
    counts = warehouse.build_warehouse(
        rejected_feed(spark, sf_dir), accepted_feed(spark, sf_dir), str(tmp_path)
    )
    assert counts["combined"] == counts["rejected_clean"] + counts["accepted_clean"]
    assert counts["model_input"] == counts["combined"]
    trend = [tuple(r) for r in publish.read_published(spark, "trend_monthly", f"{tmp_path}/marts").select("year", "month").collect()]
    assert trend == sorted(trend)
    assert len(list((tmp_path / "marts").iterdir())) == 18


def test_a_cluster_needs_a_shared_folder():
    assert local_root("local[4]", "/w/") == "/w/_stage" == local_root("local", "/w")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            local_root(master, "/w")


def test_bucketed_tables_end_with_their_block(spark):
    with staging(spark):
        table = stage_table(spark.range(100).withColumn("b", F.col("id") % 4), "bucketed_for_a_test", 4, "b")
        assert table.count() == 100 and spark.catalog.tableExists("bucketed_for_a_test")
    assert not spark.catalog.tableExists("bucketed_for_a_test")
