"""CSV and Parquet in and out."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stridecast.functions.times import with_date_parts
from stridecast.operators.filters import between_dates
from stridecast.plans.ingest import ingest_csv, ingest_table
from stridecast.schema import DATE_PARTS, MOBILITY_SCHEMA
from stridecast.sources import files

NAMES = MOBILITY_SCHEMA.fieldNames()


def mobility(spark, n=60, countries=("Morocco", "Spain")):
    """Two countries, consecutive days, parks filled for one row in three."""
    rows = []
    for i in range(n):
        for c in countries:
            day = dt.date(2021, 1, 15) + dt.timedelta(days=i)
            rows.append((c[:2], c, f"{c}-1", day, i, i + 1, i if i % 3 == 0 else None, 2, 3, i % 7))
    return spark.createDataFrame(rows, MOBILITY_SCHEMA)


def write_lines(spark, folder, lines):
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(folder)
    return folder


def test_strict_csv_refuses_another_header(spark, folder):
    header = ",".join(NAMES[:4] + ["extra"] + NAMES[4:])
    path = write_lines(spark, folder, [header, "MA,Morocco,p,2021-01-01,zzz,1,2,3,4,5,6"])
    with pytest.raises(Exception, match="(?i)header"):
        files.read_mobility_csv(spark, path).collect()
    row = files.read_mobility_csv(spark, path, strict=False).first()
    assert row["retail_and_recreation_percent_change_from_baseline"] == 1
    assert row["residential_percent_change_from_baseline"] == 6


def test_csv_by_name_with_missing_column_and_bad_number(spark, folder):
    path = write_lines(spark, folder, [",".join(NAMES[:5]), "MA,Morocco,p,2021-01-01,many"])
    row = files.read_mobility_csv(spark, path, strict=False).first()
    assert row["date"] == dt.date(2021, 1, 1)
    assert row[NAMES[4]] is None and row[NAMES[9]] is None


def test_ingest_drops_sparse_and_round_trips(spark, folder):
    source = mobility(spark)
    source.write.csv(folder + "-csv", header=True)
    result = ingest_csv(spark, folder + "-csv", folder, partition_by=DATE_PARTS)
    assert result.dropped == ("parks_percent_change_from_baseline",)
    assert (result.n_rows, result.n_columns) == (120, 12)
    back = files.read_mobility(spark, folder, with_partitions=False)
    assert sorted(back.collect()) == sorted(source.select(*back.columns).collect())
    assert files.read_mobility(spark, folder).columns[-3:] == ["année", "mois", "jour"]
    n_days = source.select("date").distinct().count()
    assert files.list_parquet_files(spark, folder).count() >= n_days


def test_ingest_refuses_and_counts_bad_rows(spark, folder):
    good = "MA,Morocco,p,2021-01-01,1,2,3,4,5,6"
    spoilt = ["MA,Morocco,p,soon,1,2,3,4,5,6", "MA,Morocco,p,2021-01-01,many,2,3,4,5,x"]
    torn = ["MA,Morocco,p,2021-01-01,1", good + ",7,8"]
    path = write_lines(spark, folder + "-csv", [",".join(NAMES), good, good, *spoilt, *torn, "MA,Morocco,p,2021-01-02,1,,3,4,5,6"])
    result = ingest_csv(spark, path, folder, rejects=folder + "-rejects")
    assert (result.n_rows, result.n_rejected) == (3, 4)
    assert files.read_mobility(spark, folder).count() == 3
    refused = spark.read.parquet(folder + "-rejects")
    why = sorted(r["reject_reason"] for r in refused.collect())
    assert why == sorted(["date", f"{NAMES[4]},{NAMES[9]}", "number of cells", "number of cells"])
    assert refused.where(F.col("date") == "soon").count() == 1
    by_name = ingest_csv(spark, path, folder + "-2", strict=False)
    assert (by_name.n_rows, by_name.n_rejected) == (3, 4)


def test_null_date_is_kept_in_the_default_partition(spark, folder):
    rows = mobility(spark, 3).withColumn("date", F.when(F.col("country_region") == "Spain", F.col("date")))
    ingest_table(rows, folder, max_null=0.9)
    back = files.read_mobility(spark, folder)
    assert back.count() == 6 and back.where(F.col("année").isNull()).count() == 3


def test_date_filter_prunes_partitions(spark, folder):
    ingest_table(mobility(spark), folder, partition_by=("année", "mois"))
    kept = between_dates(files.read_mobility(spark, folder), "2021-02-10", "2021-02-20")
    assert kept.count() == 22
    plan = kept._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "année" in pruned and "mois" in pruned
    assert "GreaterThanOrEqual(date" in plan
    read = kept.select("date", "place_id")._jdf.queryExecution().executedPlan().toString()
    schema = read[read.index("ReadSchema") :]
    assert "place_id" in schema and "workplaces" not in schema
    months = {r[0] for r in kept.select(F.input_file_name()).distinct().collect()}
    assert all("mois=2" in m for m in months)


def test_only_touched_partitions_are_replaced(spark, folder):
    files.write_mobility(with_date_parts(mobility(spark)), folder, ("année", "mois"))
    march = with_date_parts(mobility(spark)).where("mois = 3").limit(1)
    files.write_mobility(march, folder, ("année", "mois"), only_touched_partitions=True)
    by_month = {r["mois"]: r["count"] for r in files.read_mobility(spark, folder).groupBy("mois").count().collect()}
    assert by_month == {1: 34, 2: 56, 3: 1}


def test_hot_month_is_split_over_files(spark, folder, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64k")
    rows = spark.range(0, 400_000, 1, 8).select(
        F.lit("MA").alias("country_region_code"),
        F.uuid().alias("place_id"),
        F.when(F.col("id") % 3 == 0, F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 300).cast("int")))
        .otherwise(F.lit("2021-05-05").cast("date"))
        .alias("date"),
    )
    files.write_mobility(with_date_parts(rows), folder, ("année", "mois"))
    listed = files.list_parquet_files(spark, folder).select(
        F.regexp_extract("path", r"mois=(\d+)", 1).cast("int").alias("mois")
    )
    per_month = {r["mois"]: r["count"] for r in listed.groupBy("mois").count().collect()}
    assert per_month[5] >= 4
    assert files.read_mobility(spark, folder).count() == 400_000


def test_explore_infers_types(spark, folder):
    mobility(spark, 4).write.csv(folder, header=True)
    kinds = dict(files.explore_csv(spark, folder).dtypes)
    assert kinds["date"] == "date" and kinds["residential_percent_change_from_baseline"] == "int"


def _two_headers(spark, folder):
    spark.createDataFrame([("1", "2021-01-01")], "place_id string, date string").write.option("header", True).csv(folder)
    spark.createDataFrame([("2021-01-02", "2")], "date string, place_id string").write.option("header", True).mode("append").csv(folder)


def test_files_with_different_headers_are_not_mixed_up(spark, folder):
    _two_headers(spark, folder)
    with pytest.raises(Exception, match="(?i)header"):
        files.explore_csv(spark, folder).collect()
    with pytest.raises(Exception, match="(?i)header"):
        files.read_mobility_csv(spark, folder).collect()


def test_files_with_different_headers_are_read_by_name(spark, folder):
    _two_headers(spark, folder)
    wide = [",".join(["iso", *reversed(NAMES)]), "MA-01,6,5,4,3,2,1,2021-01-03,3,Morocco,MA"]
    torn = ['place_id,"date"', "4,2021-01-04", "5", "6,2021-01-06,more"]
    for part, lines in (("wide", wide), ("torn", torn), ("blank", ["", " "])):
        write_lines(spark, f"{folder}-{part}", lines)
    paths = [f"{folder}-{part}" for part in ("wide", "torn", "blank")] + [folder]
    back = files.read_mobility_csv(spark, paths, strict=False)
    assert back.schema == MOBILITY_SCHEMA
    found = sorted((r["place_id"], str(r["date"]), r["country_region"], r[NAMES[4]], r[NAMES[9]]) for r in back.collect())
    assert found[:4] == [
        ("1", "2021-01-01", None, None, None),
        ("2", "2021-01-02", None, None, None),
        ("3", "2021-01-03", "Morocco", 1, 6),
        ("4", "2021-01-04", None, None, None),
    ]
    assert set(map(len, files.files_by_header(spark, paths))) == {2, len(NAMES) + 1}
    result = ingest_csv(spark, paths, f"{folder}-out", strict=False, rejects=f"{folder}-rejects", max_null=1.0)
    assert (result.n_rows, result.n_rejected) == (4, 2)


def test_first_lines_of_compressed_files(spark, folder):
    mobility(spark, 3).write.csv(folder, header=True, compression="gzip")
    mobility(spark, 4).select(*reversed(NAMES)).write.csv(f"{folder}-2", header=True, compression="bzip2")
    back = files.read_mobility_csv(spark, [folder, f"{folder}-2"], strict=False)
    assert back.count() == 14 and back.where("date IS NULL").count() == 0
    assert set(files.files_by_header(spark, [folder, f"{folder}-2"])) == {tuple(NAMES), tuple(reversed(NAMES))}


def test_many_small_files_become_few_in_order(spark, folder):
    with_date_parts(mobility(spark)).repartition(5).write.partitionBy("année", "mois", "jour").parquet(folder)
    files.compact_mobility(spark, folder, f"{folder}-months")
    before, after = (files.list_parquet_files(spark, f) for f in (folder, f"{folder}-months"))
    assert before.count() > 80 and after.count() == 3
    back = files.read_mobility(spark, f"{folder}-months")
    assert "jour" not in back.columns and back.count() == mobility(spark).count()
    place = back.withColumn("f", F.col("_metadata.file_path")).withColumn("i", F.monotonically_increasing_id()).orderBy("i").collect()
    keys = [(r["f"], r["country_region_code"], r["place_id"]) for r in place]
    assert all(a[0] != b[0] or a <= b for a, b in zip(keys, keys[1:], strict=False))
    files.compact_mobility(spark, folder, f"{folder}-days", DATE_PARTS)
    assert "jour" in files.read_mobility(spark, f"{folder}-days").columns


def test_ingest_makes_month_directories_unless_told_otherwise(spark, folder):
    ingest_table(mobility(spark), folder)
    assert files.list_parquet_files(spark, folder).count() == 3
    assert "jour" not in files.read_mobility(spark, folder).columns
