"""Physical plans: what reaches the scan, and what must not appear."""

from pyspark.sql import functions as F

from stridecast.functions.messages import flatten_message, parse_messages
from stridecast.operators import filters, layout, serving
from stridecast.operators.regression import score
from stridecast.plans.promotion import promote_rows
from stridecast.plans.scoring import accepted, quarantine, score_batch
from stridecast.sources.files import list_parquet_files
from stridecast.streaming.windows import window_metrics
from tests.conftest import SMALL
from workload.models import trained
from workload.streams import _messages
from workload.views import mobility, predictions, table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_stays_in_the_jvm_and_parses_once(spark):
    scored = plan(score_batch(_messages(spark, SMALL), 0, trained(spark, SMALL)))
    assert "Python" not in scored and "Exchange" not in scored
    assert scored.count("from_json(") == 1


def test_filters_on_parsed_messages_do_not_parse_again(spark):
    scored = score_batch(_messages(spark, SMALL), 0, trained(spark, SMALL))
    windowed = window_metrics(flatten_message(parse_messages(_messages(spark, SMALL))))
    for df in (accepted(scored), quarantine(scored), windowed):
        assert plan(df).count("from_json(") == 1


def test_table_scoring_reads_only_its_columns(spark):
    scored = score(trained(spark, SMALL), mobility(spark, SMALL)).select("place_id", "prediction")
    schema = plan(scored)
    schema = schema[schema.index("ReadSchema") :]
    assert "l_extendedprice" not in schema and "l_shipdate" not in schema and "l_suppkey" in schema


def test_filters_reach_the_scan(spark, folder, settings):
    settings(spark__sql__maxMetadataStringLength="2000")
    predictions(spark, SMALL).write.parquet(folder)
    rows = spark.read.parquet(folder)
    kept = filters.select_rows(rows, "country_A", ("1996-01-01", "1997-01-01"), "RandomForest", 3.0)
    text = plan(kept.select("date"))
    pushed = text[text.index("PushedFilters") : text.index("ReadSchema")]
    assert "EqualTo(country,country_A)" in pushed and "EqualTo(model,RandomForest)" in pushed
    assert "GreaterThanOrEqual(residential,3.0)" in pushed and "LessThanOrEqual(date" in pushed


def test_aggregates_combine_before_the_shuffle(spark):
    rows = predictions(spark, SMALL)
    for df in (serving.kpis(rows), serving.risk_zones(rows, 0), serving.heatmap(rows), promote_rows(rows, keys=("date", "country", "model"))):
        assert "partial_" in plan(df)


def test_promotion_does_not_gather_versions_in_a_window(spark):
    assert "Window" not in plan(promote_rows(predictions(spark, SMALL), keys=("date", "country", "model")))


def test_preview_is_a_bounded_top_k(spark):
    assert "TakeOrderedAndProject" in plan(serving.preview(predictions(spark, SMALL)))


def test_trends_average_before_turning_to_rows(spark):
    text = plan(serving.metric_trends(mobility(spark, SMALL)))
    assert text.index("Expand") < text.index("HashAggregate")


def test_sort_splits_a_hot_key(spark, settings):
    settings(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).alias("k"), "id"
    )
    placed = layout.sort_splitting_ties(rows, "k").withColumn("p", F.spark_partition_id())
    assert placed.where("k = 7").select("p").distinct().count() > 2
    collected = [r["k"] for r in placed.collect()]
    assert collected == sorted(collected) and len(collected) == 30_000


def test_file_listing_reads_no_content(spark, folder):
    table(spark, SMALL, "nation").write.parquet(folder)
    text = plan(list_parquet_files(spark, folder))
    assert "content" not in text[text.index("ReadSchema") :]
