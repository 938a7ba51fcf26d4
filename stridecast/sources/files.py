"""Delimited files in, partitioned Parquet in and out."""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridecast.operators.layout import gather_by
from stridecast.schema import CORRUPT_COLUMN, DATE_PARTS, MOBILITY_SCHEMA, MONTH_PARTS


def read_mobility_csv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Mobility CSV with a header, in the declared schema.

    Strict: the header must name exactly the declared columns in order; a
    mismatch raises instead of shifting values. Otherwise columns are picked by
    name, file by file, whatever else the files hold and in whatever order; a missing one is NULL, and
    text that does not convert becomes NULL.
    """
    if strict:
        return spark.read.csv(path, header=True, schema=MOBILITY_SCHEMA, enforceSchema=False)
    text = read_mobility_text(spark, path, strict=False)
    return text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in MOBILITY_SCHEMA])


def read_mobility_text(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """The cells of :func:`read_mobility_csv` as text, nothing converted.

    ``_corrupt_record`` holds the line of a row with more or fewer cells than the header.
    """
    if strict:
        return _cells(spark, path, MOBILITY_SCHEMA.fieldNames())
    groups = files_by_header(spark, path)
    if not groups:
        return _cells(spark, path, MOBILITY_SCHEMA.fieldNames())
    return reduce(DataFrame.unionByName, [_cells(spark, files, header) for header, files in groups.items()])


def _cells(spark: SparkSession, path, present) -> DataFrame:
    """Files with one header, as text in the declared columns."""
    names = T.StructType([T.StructField(n, T.StringType()) for n in [*present, CORRUPT_COLUMN]])
    # Names are declared or come from the first line; the reader holds every file's whole header against them.
    whole = spark.read.option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    text = whole.csv(path, header=True, schema=names, enforceSchema=False)
    wanted = MOBILITY_SCHEMA.fieldNames()
    cells = [F.col(n) if n in present else F.lit(None).cast("string").alias(n) for n in wanted]
    return text.select(*cells, CORRUPT_COLUMN)


def files_by_header(spark: SparkSession, path) -> dict[tuple[str, ...], list[str]]:
    """The column names that stand in the first lines of the files below ``path``, with the files that have them.

    Each file is opened for its first line, by a few threads of the driver, which holds the list of
    files anyway; no file is read further. Files without a line are left out.
    """
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda f: _first_line(spark, f), files))
    same_line = defaultdict(list)
    for line, file in zip(lines, files, strict=True):
        if line is not None:
            same_line[line].append(file)
    found = defaultdict(list)
    for group in same_line.values():
        found[tuple(spark.read.csv(group[0], header=True).columns)] += group
    return dict(found)


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line that is not blank, of a plain file or one in a compression its name tells."""
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    raw = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        stream = raw if codec is None else codec.createInputStream(raw)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line
    finally:
        raw.close()


def explore_csv(spark: SparkSession, path: str, sampling: float = 1.0) -> DataFrame:
    """CSV with inferred types. Inference reads a ``sampling`` share of the rows once more.

    Files whose headers differ from each other raise.
    """
    schema = spark.read.csv(path, header=True, inferSchema=True, samplingRatio=sampling).schema
    return spark.read.option("columnPruning", False).csv(path, header=True, schema=schema, enforceSchema=False)


def write_mobility(
    df: DataFrame,
    root: str,
    partition_by=DATE_PARTS,
    sort_by=("country_region_code", "place_id"),
    only_touched_partitions: bool = False,
) -> None:
    """Snappy Parquet in date directories, rows in order inside each file.

    ``only_touched_partitions`` replaces just the directories the frame has rows
    for; otherwise the whole dataset is replaced.
    """
    partition_by = list(partition_by)
    order = partition_by + [c for c in sort_by if c in df.columns]
    writer = (
        gather_by(df, *partition_by)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
    )
    if only_touched_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(root)


def compact_mobility(spark: SparkSession, root: str, target: str, partition_by=MONTH_PARTS) -> None:
    """The dataset below ``root`` again below ``target``, in directories of ``partition_by``.

    Rows of a directory meet in files of the session's advisory size, in order inside each file,
    whatever number of files they lay in. ``root`` stays as it is.
    """
    rows = read_mobility(spark, root)
    write_mobility(rows.drop(*[p for p in DATE_PARTS if p not in partition_by]), target, partition_by)


def read_mobility(spark: SparkSession, root: str, with_partitions: bool = True) -> DataFrame:
    """The dataset below ``root``; date directories prune when filtered on."""
    df = spark.read.parquet(root)
    return df if with_partitions else df.drop(*DATE_PARTS)


def list_parquet_files(spark: SparkSession, root: str) -> DataFrame:
    """Path, size and modification time of every Parquet file at any depth.

    File contents are not read: the content column is never selected.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )


def stream_table(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream of its files; ``path`` is a folder or a single file."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if _is_file(spark, path):
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def _is_file(spark: SparkSession, path: str) -> bool:
    """One status call to the file system that holds ``path``; no listing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.getFileStatus(place).isFile()
