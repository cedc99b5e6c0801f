import pytest

#: Texts that every operator must take: nulls, empty, blank, repeated, ties, very long, odd characters.
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "a b c d e f g h"), (7, "a b c d e f g h"), (7, "a b c d e f g h"), (None, "no id"),
    (8, "  lead and  trail  "), (9, "ÄÖ ß 漢字 😀 ▁x <|endoftext|> it's 12\u3000x\x00"), (10, "word " * 3000), (11, "x" * 20000), (12, "line\nline\nline\n\nLine"), (13, "\u2028\x85\xa0 a\r\nb"),
]


@pytest.fixture(scope="session")
def edge(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(EDGE, "doc_id long, text string")
    return rows.withColumns({"lang": F.when(F.col("doc_id") % 3 != 0, "en"), "source": F.lit("s"), "n_chars": F.char_length("text"), "_k1": F.lit(0), "n_words": F.lit("clash"), "shard": F.lit(9), "node": F.lit(1), "digest": F.lit("x")})


@pytest.fixture(scope="session")
def none(edge):
    return edge.where("false")
