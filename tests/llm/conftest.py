import pytest

#: Names that operators use within, as further columns of their input.
CLASHES = "ids node key weight cell n digest label block part start row copy body component length a.b __asked __place".split()


@pytest.fixture(scope="session")
def with_clashes():
    """Adds columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    def add(frame):
        return frame.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES if c not in frame.columns])

    return add


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty and very long texts, repeated rows and ids, special tokens, marks and white space of all kinds."""
    words = [f"w{i * 7919 % 4001}x" for i in range(60_000)]
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "  a  b\n\n c<|endoftext|> d’s it's x　y à b "), (5, " ".join(words)), (6, "z" * 300_000),
        (7, "same text"), (7, "same text"), (7, "another text of this id"), (None, "no id"), (None, None), (8, "İSTANBUL ΣΑΣ ﬁ é <|ENDOFTEXT|>"),
        (9, "Well, it's 3.5! (ok);x:y?Yes.\nNext.\n\nLast\u0085  a b "), (10, "▁▁ mark ▁x  y"), (11, "\U0001f600 漢字 かな\x1c\x85z"),
        (12, ",.;: a,b.c;d:e!f?g 'll I'LL don't"), (2**62, "large id"), (-5, "negative id"),
    ]


@pytest.fixture
def odd_docs(spark, odd_texts, with_clashes):
    return with_clashes(spark.createDataFrame(odd_texts, "doc_id long, text string").repartition(3))


@pytest.fixture
def no_docs(spark, with_clashes):
    return with_clashes(spark.createDataFrame([], "doc_id long, text string"))
