"""Nothing is cut off: long texts, long chats, settings in any unit."""

from pyspark.sql import functions as F

from millrace.operators.aggregates import to_messages
from millrace.operators.textmodel import classify_text, fit_text_classifier
from millrace.plans import all_queries
from millrace.session import sized_broadcast, spread


def test_token_after_the_512th_decides(spark):
    filler = " ".join(f"w{i}" for i in range(600))
    rows = [(i, f"{filler} {'good' if i % 2 else 'bad'}", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, text string, label int")
    made = classify_text(df, fit_text_classifier(df, "text", "label"), "text")
    assert made.filter(F.col("prediction") != F.col("label")).count() == 0


def test_a_chat_of_65_turns_is_one_answer(spark, folder):
    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}. More.") for t in range(65)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    df.write.parquet(f"{folder}/conversations.parquet")
    assert sorted(tuple(r) for r in all_queries()["batch_chat"](spark, folder).collect()) == [(1, 0, "assistant: 32, user: 32; Turn 63."), (1, 1, "user: 1; Turn 64.")]
    parts = to_messages(df, "conv_id", "turn", "role", "text", per_segment=64).orderBy("segment").collect()
    assert [len(r["messages"]) for r in parts] == [64, 1]


def test_spread_has_one_rule_at_all_sizes(spark):
    small, large = spark.range(10), spark.range(10).selectExpr("id", "repeat('x', 1000000) AS filler")
    assert spread(small, 3).rdd.getNumPartitions() == spread(large, 3).rdd.getNumPartitions() == 3
    # the optimizer believes this one to be far above any limit
    huge = spark.range(1 << 40).limit(5)
    assert spread(huge, 3).rdd.getNumPartitions() == 3
    assert spread(small).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_small_side_is_computed_once_and_hinted_by_its_size(spark):
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: seen.add(1) or x, "long")
    small = spark.range(5).select(count("id").alias("k"))
    stored = sized_broadcast(small)
    assert stored.count() == 5 and stored.count() == 5 and seen.value == 5
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(stored) and not hinted(sized_broadcast(small, max_bytes=0))
