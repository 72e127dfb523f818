"""The same operators on a stream: a streaming word count equals the batch one."""

import tempfile

from pairflow import count_by_value, table, words
from pairflow.streaming import read_parquet_stream, start_to_memory

from conftest import SF_SMALL, bag


def test_streaming_word_count_equals_batch(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    folder = tempfile.mkdtemp(prefix="pairflow-stream-")
    docs.where("doc_id % 2 = 0").write.mode("append").parquet(folder)
    docs.where("doc_id % 2 = 1").write.mode("append").parquet(folder)
    stream = read_parquet_stream(spark, folder, docs.schema, max_files_per_trigger=1)
    q = start_to_memory(count_by_value(words(stream, "text"), ["word"]), "stream_wc", output_mode="complete")
    q.awaitTermination(120)
    got = spark.sql("select word, n from stream_wc")
    assert bag(got) == bag(count_by_value(words(docs, "text"), ["word"]))


def test_streaming_sum_by_key_update_mode(spark):
    from pyspark.sql import functions as F

    from pairflow import sum_by_key

    ev = table(spark, SF_SMALL, "events").select("user_id", "event_type")
    folder = tempfile.mkdtemp(prefix="pairflow-stream-")
    ev.write.mode("append").parquet(folder)
    stream = read_parquet_stream(spark, folder, ev.schema)
    ones = stream.select("user_id", F.lit(1).cast("bigint").alias("one"))
    q = start_to_memory(sum_by_key(ones, "user_id", "one", out="n"), "stream_sums", output_mode="update")
    q.awaitTermination(120)
    got = spark.sql("select user_id, n from stream_sums")
    assert bag(got) == bag(ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))


def test_stream_static_join_in_append_mode(spark):
    from pairflow import join, rows_to_df

    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    folder = tempfile.mkdtemp(prefix="pairflow-stream-")
    docs.write.mode("append").parquet(folder)
    stream = words(read_parquet_stream(spark, folder, docs.schema), "text", "word", ("doc_id",))
    meanings = rows_to_df(spark, [("the", "article"), ("and", "conjunction")], "word string, meaning string")
    q = start_to_memory(join(stream, meanings, "word"), "stream_join", output_mode="append")
    q.awaitTermination(120)
    got = spark.sql("select word, doc_id, meaning from stream_join")
    assert bag(got) == bag(join(words(docs, "text", "word", ("doc_id",)), meanings, "word"))


def test_stream_to_parquet_append(spark):
    from pairflow.streaming import start_to_parquet

    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    src = tempfile.mkdtemp(prefix="pairflow-stream-")
    out = tempfile.mkdtemp(prefix="pairflow-sink-")
    docs.write.mode("append").parquet(src)
    stream = words(read_parquet_stream(spark, src, docs.schema), "text", "word", ("doc_id",))
    q = start_to_parquet(stream, out, "stream_sink", available_now=True)
    q.awaitTermination(120)
    assert bag(spark.read.parquet(out)) == bag(words(docs, "text", "word", ("doc_id",)))
