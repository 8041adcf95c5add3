import pytest


def odd_rows():
    """Documents with nulls, repeats, ties, an empty and a very long text."""
    prose = "The river ran past the old mill and turned the wheel all day long. " * 2
    long_text = " ".join(f"word{k}" for k in range(30_000))
    return [
        (1, prose, "en", "a"),
        (2, prose, "en", "a"),
        (2, prose, "en", "a"),
        (3, "", "en", None),
        (4, None, None, "b"),
        (None, prose, None, None),
        (None, "another text without an id that has ten words or more in it", "en", "b"),
        (5, long_text, "de", "b"),
        (6, "mit license \n\n" + long_text, "de", "b"),
        (7, "émigré ñandú ☃ \U0001f600 naïve", "fr", ""),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), "doc_id long, text string, lang string, source string")


#: Names that operators use inside or return.
CLASHES = (
    "words hashes shard slot digest fp t start end d1 d2 kept chunk n host lines weight pass_no block tokens"
    " mix_digest row_digest row_number shard_part removed_spans text_digest_1 id rank root name n_tokens"
).split()


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    from pyspark.sql import functions as F

    return odd_docs.select("*", *(F.lit(k).alias(name) for k, name in enumerate(CLASHES)))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
