"""Sources, sinks, profiling, layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from stridecast.functions.messages import long_metric_names
from stridecast.functions.times import with_date_parts
from stridecast.operators import cleaning, layout, profile
from stridecast.operators.serving import date_bounds
from stridecast.plans.ingest import ingest_csv, ingest_table
from stridecast.schema import DATE_PARTS, MOBILITY_SCHEMA, SHORT_TO_LONG
from stridecast.scratch import new_folder, written
from stridecast.sources import files
from workload.registry import query
from workload.views import LONG_COLUMNS, MOBILITY, as_mobility, mobility, mobility_long, sql, table

_PARTS_SQL = (
    'CAST(year(date) AS INTEGER) AS "année", CAST(month(date) AS INTEGER) AS mois, '
    "CAST(day(date) AS INTEGER) AS jour"
)
_KEPT = [c for c in MOBILITY if c != "parks"]
_KEPT_LONG = LONG_COLUMNS.replace("parks AS parks_percent_change_from_baseline, ", "")


def _csv(spark, sf_dir):
    path = new_folder(spark, "csv")
    mobility_long(spark, sf_dir).write.csv(path, header=True)
    return path


@query("s1_read_csv", sql(f"SELECT {LONG_COLUMNS} FROM mobility"))
def s1(spark, sf_dir):
    return files.read_mobility_csv(spark, _csv(spark, sf_dir))


@query("s1_read_csv_by_name", sql(f"SELECT {LONG_COLUMNS} FROM mobility"))
def s1_by_name(spark, sf_dir):
    """A wider file with the columns in another order."""
    path = new_folder(spark, "wide-csv")
    wide = mobility_long(spark, sf_dir).withColumn("iso_code", F.lit("MA-01"))
    wide.select("iso_code", *reversed(wide.columns[:-1])).write.csv(path, header=True)
    return files.read_mobility_csv(spark, path, strict=False)


@query("s1_mixed_headers", sql(f"SELECT {LONG_COLUMNS} FROM mobility"))
def s1_mixed(spark, sf_dir):
    """Files in one folder with the columns in opposite orders, one of them with a column more, one compressed."""
    path, n = new_folder(spark, "mixed-csv"), F.col("l_linenumber")
    rows = long_metric_names(as_mobility(table(spark, sf_dir, "lineitem"), "l_linenumber"))
    names = [c for c in rows.columns if c != "l_linenumber"]
    parts = ((n <= 2, names, "none"), (n.between(3, 4), [*reversed(names), "l_linenumber"], "none"), (n >= 5, names[4:] + names[:4], "gzip"))
    for rule, columns, codec in parts:
        rows.where(rule).select(*columns).write.mode("append").csv(path, header=True, compression=codec)
    return files.read_mobility_csv(spark, path, strict=False)


@query(
    "s2_explore_csv",
    sql(f"SELECT * REPLACE (CAST(place_id AS INTEGER) AS place_id) FROM (SELECT {LONG_COLUMNS} FROM mobility)"),
)
def s2(spark, sf_dir):
    return files.explore_csv(spark, _csv(spark, sf_dir))


@query("s3_read_mobility", sql(f"SELECT {LONG_COLUMNS} FROM mobility"))
def s3(spark, sf_dir):
    root = new_folder(spark, "mobility")
    files.write_mobility(with_date_parts(mobility_long(spark, sf_dir)), root, ("année", "mois"))
    return files.read_mobility(spark, root, with_partitions=False).select(*MOBILITY_SCHEMA.fieldNames())


@query(
    "s4_list_files",
    sql("SELECT DISTINCT CAST(year(date) AS INTEGER) AS y, CAST(month(date) AS INTEGER) AS m FROM mobility"),
)
def s4(spark, sf_dir):
    """The month directories that hold Parquet files."""
    root = new_folder(spark, "mobility")
    files.write_mobility(with_date_parts(mobility_long(spark, sf_dir)), root, ("année", "mois"))
    found = files.list_parquet_files(spark, root)
    return found.select(
        F.regexp_extract("path", r"=(\d+)/mois=(\d+)/", 1).cast("int").alias("y"),
        F.regexp_extract("path", r"=(\d+)/mois=(\d+)/", 2).cast("int").alias("m"),
    ).distinct()


@query("k1_write_mobility", sql(f"SELECT {_KEPT_LONG}, {_PARTS_SQL} FROM mobility"))
def k1(spark, sf_dir):
    """CSV to pruned year/month/day directories and back."""
    root = new_folder(spark, "mobility")
    ingest_csv(spark, _csv(spark, sf_dir), root, partition_by=DATE_PARTS)
    return files.read_mobility(spark, root)


def _bytes(text: str) -> int:
    """A size as Spark writes it: a number, perhaps with a unit such as ``64MB``, ``64m`` or ``b``."""
    number = text.strip().lower().removesuffix("b").strip()
    power = "kmgtp".find(number[-1]) + 1
    return int(number.rstrip("kmgtp")) << 10 * power


@query(
    "k1_compact",
    sql(
        'SELECT CAST(year(date) AS INTEGER) AS "année", CAST(month(date) AS INTEGER) AS mois, count(*) AS n, '
        "CAST(sum(residential) AS BIGINT) AS residential, true AS one_file FROM mobility GROUP BY 1, 2"
    ),
)
def k1_compact(spark, sf_dir):
    """Directories with six small files each, or more where a sixth is large, compacted into months whose rows fit one file."""
    small, months, size = new_folder(spark, "small"), new_folder(spark, "months"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    sixths = with_date_parts(mobility_long(spark, sf_dir)).withColumn("sixth", F.monotonically_increasing_id() % 6)
    layout.gather_by(sixths, "année", "mois", "sixth").drop("sixth").write.partitionBy("année", "mois").parquet(small)
    largest = files.read_mobility(spark, small).groupBy("année", "mois").count().agg(F.max("count")).first()[0] or 0
    before = spark.conf.get(size)
    try:
        # Rows of a month under way are below 256 bytes each.
        spark.conf.set(size, str(max(_bytes(before), 256 * largest)))
        files.compact_mobility(spark, small, months)
    finally:
        spark.conf.set(size, before)
    rows = files.read_mobility(spark, months).withColumn("file", F.col("_metadata.file_path"))
    sums = rows.groupBy("année", "mois").agg(
        F.count("*").alias("n"), F.sum(SHORT_TO_LONG["residential"]).alias("residential"), F.count_distinct("file").alias("files")
    )
    return sums.withColumn("one_file", F.col("files") == 1).drop("files")


_REJECTED = {7: SHORT_TO_LONG["grocery"], 6: "date"}


@query(
    "k1_ingest_rejects",
    "SELECT CASE l_linenumber "
    + " ".join(f"WHEN {n} THEN '{c}'" for n, c in _REJECTED.items())
    + " ELSE 'loaded' END AS outcome, count(*) AS n, CAST(sum(round(l_discount*100)) AS BIGINT) AS workplaces "
    "FROM lineitem GROUP BY 1",
)
def k1_rejects(spark, sf_dir):
    """A file with text in place of some dates and numbers: what was loaded, what was refused and why."""
    rows = long_metric_names(as_mobility(table(spark, sf_dir, "lineitem"), "l_linenumber"))
    spoilt = {c: F.when(F.col("l_linenumber") == n, "n/a").otherwise(F.col(c).cast("string")) for n, c in _REJECTED.items()}
    path, root, rejects = (new_folder(spark, label) for label in ("csv", "mobility", "rejects"))
    rows.withColumns(spoilt).drop("l_linenumber").write.csv(path, header=True)
    ingest_csv(spark, path, root, rejects=rejects, partition_by=("année", "mois"))
    workplaces = F.col(SHORT_TO_LONG["workplaces"]).cast("bigint").alias("workplaces")
    loaded = files.read_mobility(spark, root).select(F.lit("loaded").alias("outcome"), workplaces)
    refused = spark.read.parquet(rejects).select(F.col("reject_reason").alias("outcome"), workplaces)
    return loaded.unionByName(refused).groupBy("outcome").agg(F.count("*").alias("n"), F.sum("workplaces").alias("workplaces"))


@query("q1_row_count", sql("SELECT count(*) AS n_rows FROM mobility"))
def q1(spark, sf_dir):
    return profile.row_count(mobility(spark, sf_dir))


def _per_column(cell: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {cell.format(c=c)} FROM mobility" for c in MOBILITY
    )


@query("q2_non_null_counts", sql(_per_column("count({c}) AS non_null, count(*) AS n_rows")))
def q2(spark, sf_dir):
    return profile.non_null_counts(mobility(spark, sf_dir))


@query("q3_null_counts", sql(_per_column("count(*) - count({c}) AS null_count")))
def q3(spark, sf_dir):
    return profile.null_counts(mobility(spark, sf_dir))


_KINDS = {
    **{c: "int" for c in MOBILITY},
    "country_region_code": "string",
    "country_region": "string",
    "place_id": "string",
    "date": "date",
}


@query(
    "q4_describe_columns",
    sql(
        " UNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{_KINDS[c]}' AS column_type, "
            f"count({c}) AS non_null, count(*) AS n_rows FROM mobility"
            for i, c in enumerate(MOBILITY)
        )
    ),
)
def q4(spark, sf_dir):
    return profile.describe_columns(mobility(spark, sf_dir))


@query("q5_drop_sparse", sql(f"SELECT {', '.join(_KEPT)} FROM mobility"))
def q5(spark, sf_dir):
    return cleaning.drop_sparse(mobility(spark, sf_dir))


@query(
    "q6_output_stats",
    sql(f"SELECT count(*) AS n_rows, CAST({len(_KEPT)} AS INTEGER) AS n_columns FROM mobility"),
)
def q6(spark, sf_dir):
    return profile.output_stats(cleaning.drop_sparse(mobility(spark, sf_dir)))


_SPARSE_PAIR = "parks, transit, CASE WHEN residential > 0 THEN residential END AS residential"


@query(
    "q7_drop_thin_rows",
    sql(
        "SELECT * FROM thin WHERE (CASE WHEN parks IS NULL THEN 0 ELSE 1 END + CASE WHEN transit IS NULL "
        "THEN 0 ELSE 1 END + CASE WHEN residential IS NULL THEN 0 ELSE 1 END) >= 2",
        f"thin AS (SELECT date, place_id, {_SPARSE_PAIR} FROM mobility)",
    ),
)
def q7(spark, sf_dir):
    thin = mobility(spark, sf_dir).selectExpr("date", "place_id", *_SPARSE_PAIR.split(", "))
    return cleaning.drop_thin_rows(thin, 2, subset=["parks", "transit", "residential"])


_TEXT = {
    "grocery": "CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_quantity - 25 AS INT) AS STRING) END",
    "transit": "CASE WHEN l_partkey % 10 = 0 THEN NULL WHEN l_tax > 0.07 THEN '?' ELSE CAST(CAST(round(l_tax*100) AS INT) AS STRING) END",
}
_TEXT_SQL = (
    "texts AS (SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"{e} AS {c}" for c, e in _TEXT.items())
    + " FROM lineitem), checked AS (SELECT *, TRY_CAST(grocery AS DOUBLE) AS g, TRY_CAST(transit AS DOUBLE) AS t, "
    "concat_ws(',', CASE WHEN grocery IS NOT NULL AND TRY_CAST(grocery AS DOUBLE) IS NULL THEN 'grocery' END, "
    "CASE WHEN transit IS NOT NULL AND TRY_CAST(transit AS DOUBLE) IS NULL THEN 'transit' END) AS why FROM texts)"
)


def _texts(spark, sf_dir):
    columns = [f"{e} AS {c}" for c, e in _TEXT.items()]
    rows = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", *columns)
    return cleaning.split_valid(rows, {"grocery": "double", "transit": "double"})


@query(
    "q8_split_valid",
    sql("SELECT l_orderkey, l_linenumber, g AS grocery, t AS transit FROM checked WHERE why = ''", _TEXT_SQL),
)
def q8(spark, sf_dir):
    return _texts(spark, sf_dir)[0]


@query(
    "q8_split_rejected",
    sql(
        "SELECT l_orderkey, l_linenumber, grocery, transit, why AS reject_reason FROM checked WHERE why <> ''",
        _TEXT_SQL,
    ),
)
def q8_rejected(spark, sf_dir):
    return _texts(spark, sf_dir)[1]


@query(
    "q9_flag_valid",
    sql("SELECT place_id, date, transit, workplaces, transit IS NOT NULL AS is_valid FROM mobility"),
)
def q9(spark, sf_dir):
    rows = mobility(spark, sf_dir).select("place_id", "date", "transit", "workplaces")
    vector = F.array(F.col("transit").cast("double"), F.col("workplaces").cast("double"))
    return cleaning.flag_valid(rows.withColumn("features_array", vector)).drop("features_array")


@query(
    "q10_is_empty",
    sql(
        "SELECT 'all' AS input, count(*) = 0 AS is_empty FROM mobility UNION ALL "
        "SELECT 'beyond', count(*) = 0 FROM mobility WHERE residential > 1000"
    ),
)
def q10(spark, sf_dir):
    rows = mobility(spark, sf_dir)
    seen = [("all", profile.is_empty(rows)), ("beyond", profile.is_empty(rows.where("residential > 1000")))]
    return spark.createDataFrame(seen, "input string, is_empty boolean")


_ALL = ", ".join(MOBILITY)


@query("o1_sort_by_date_parts", sql(f"SELECT {_ALL}, {_PARTS_SQL} FROM mobility"))
def o1(spark, sf_dir):
    return layout.sort_by_date_parts(with_date_parts(mobility(spark, sf_dir)))


@query(
    "o2_gather_by_month",
    sql(f"SELECT {_ALL}, {_PARTS_SQL} FROM mobility"),
)
def o2(spark, sf_dir):
    return layout.gather_by(with_date_parts(mobility(spark, sf_dir)), "année", "mois")


@query("o3_sample_rows", sql(f"SELECT {_ALL} FROM mobility ORDER BY {', '.join(f'{c} NULLS FIRST' for c in MOBILITY)} LIMIT 7"))
def o3(spark, sf_dir):
    return layout.sample_rows(mobility(spark, sf_dir), 7, list(MOBILITY))


@query(
    "o4_persisted",
    sql(
        "SELECT country_region, count(*) AS n FROM mobility GROUP BY country_region "
        "UNION ALL SELECT 'all', count(*) FROM mobility"
    ),
)
def o4(spark, sf_dir):
    with layout.persisted(mobility(spark, sf_dir).select("country_region")) as kept:
        per_country = written(kept.groupBy("country_region").agg(F.count("*").alias("n")), "per-country")
        total = written(kept.agg(F.lit("all").alias("country_region"), F.count("*").alias("n")), "total")
    return per_country.unionByName(total)


@query(
    "ingest_date_bounds",
    sql("SELECT country_region, min(date) AS min_date, max(date) AS max_date FROM mobility GROUP BY country_region"),
)
def ingest_bounds(spark, sf_dir):
    """Profile, prune, write month directories, read back, bounds per country."""
    root = new_folder(spark, "mobility")
    ingest_table(mobility_long(spark, sf_dir), root, partition_by=("année", "mois"))
    return date_bounds(files.read_mobility(spark, root), "country_region")
