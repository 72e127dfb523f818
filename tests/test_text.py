from pyspark.sql import functions as F

from pairflow import format_row, rows_to_df, tokens, words


def test_edge_lines(spark):
    df = rows_to_df(spark, [("",), ("  a b  ",), (None,), ("Größe, naïve!",), ("İstanbul",)], "line string")
    got = sorted(r.word for r in words(df, "line").collect())
    # Java lower-cases İ to i + combining dot; the mark is not a letter, so it splits the word.
    assert got == sorted(["a", "b", "größe", "naïve", "i", "stanbul"])


def test_split_keeps_edge_empties_which_filter_removes(spark):
    df = rows_to_df(spark, [("  a b  ",)], "line string")
    assert df.select(tokens("line").alias("t")).first().t == ["", "a", "b", ""]


def test_whole_text_is_tokenised(spark):
    text = " ".join(f"w{i % 7}x" for i in range(200_000))  # long text, digits split words
    df = rows_to_df(spark, [(text,)], "line string")
    n = words(df, "line").count()
    assert n == 2 * 200_000


def test_format_row_prints_null(spark):
    df = rows_to_df(spark, [("a", None), ("b", 2)], "w string, n bigint")
    assert sorted(r[0] for r in df.select(format_row("w", "n")).collect()) == ["a null", "b 2"]


def test_filter_drops_null_predicate(spark):
    df = rows_to_df(spark, [(1,), (None,), (3,)], "v int")
    assert sorted(r.v for r in df.where(F.col("v") > 1).collect()) == [3]
