"""What queries shuffle stays in proportion to the texts that they read."""

from __future__ import annotations

import pytest

import __spark_entry__
from pyspark.sql import Window
from pyspark.sql import functions as F
from tesserae.operators import quality as Q
from tesserae.plans import stitch


def shuffled(spark, run) -> int:
    """Bytes that the stages of ``run`` wrote for shuffles."""
    context = spark.sparkContext

    def known() -> dict[int, int]:
        context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = context._jsc.sc().statusStore().stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), None)
        return {stages.apply(k).stageId(): stages.apply(k).shuffleWriteBytes() for k in range(stages.size())}

    before = known()
    run()
    return sum(n for stage, n in known().items() if stage not in before)


@pytest.fixture(scope="module")
def text_bytes(spark, sf_dir) -> int:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("sum(octet_length(text))").first()[0]


@pytest.mark.parametrize(("name", "most"), [("moved_text", 2), ("column_repairs", 2), ("repaired_rest", 4), ("localized_gaps", 14), ("hollow_sections", 14), ("fault_matrix", 8), ("faults_caught", 8), ("row_pages_in_order", 3), ("row_pages", 3), ("continuation_scores", 1), ("three_way_missing", 1), ("near_duplicate_pairs", 5)])
def test_shuffles_are_few_times_the_texts(spark, sf_dir, text_bytes, name, most) -> None:
    run = __spark_entry__.queries()[name]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with tables too large for it
    try:
        found = shuffled(spark, lambda: run(spark, sf_dir).write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found < most * text_bytes


def test_printed_rows_stay_dealt_by_document(spark, sf_dir) -> None:
    at = stitch.pieces(spark, sf_dir).select("doc_id", F.spark_partition_id().alias("at")).distinct()
    found = at.groupBy("doc_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0], at.select("at").distinct().count()
    assert found == (1, int(spark.conf.get("spark.sql.shuffle.partitions")))


@pytest.mark.parametrize("name", ["table_grid", "table_parts"])
def test_tables_of_a_document_stay_where_its_text_was_dealt(spark, sf_dir, name) -> None:
    plan = __spark_entry__.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan


@pytest.mark.parametrize(("name", "most"), [("localized_gaps", 4), ("hollow_sections", 8)])
def test_gaps_move_lines_and_not_words(spark, sf_dir, text_bytes, name, most) -> None:
    test_shuffles_are_few_times_the_texts(spark, sf_dir, text_bytes, name, most)


def test_pages_meet_the_counts_of_their_words_where_they_lie(spark, sf_dir, text_bytes) -> None:
    test_shuffles_are_few_times_the_texts(spark, sf_dir, text_bytes, "page_fingerprint_coverage", 2)


@pytest.mark.parametrize("common", [0, 3, 40, 100_000])
def test_rare_words_are_the_same_however_few_counts_a_task_holds(spark, common) -> None:
    rows = [(d, k, f"w{(d * k * j) % (17 + 3 * k)}") for d in range(6) for k in range(12) for j in range(10)]
    a = spark.createDataFrame(rows, "doc_id long, ord long, token string").withColumn("page", F.floor(F.col("ord") / 4))
    words = a.groupBy("doc_id", "page", "token").agg(F.max(F.col("ord") % 7 != 3).alias("there")).withColumn("there", F.max("there").over(Window.partitionBy("doc_id", "token")))
    df = a.select("doc_id", "page", "token").distinct().groupBy("token").agg(F.count("*").alias("df"))
    want, found = Q.rare_word_presence(a, a.where("ord % 7 <> 3")), Q.rare_words_kept(words, df, common=common)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
