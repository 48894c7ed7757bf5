import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from forecheck.llm.common import ship

    ship(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and
    columns whose names clash with outputs and internals."""
    long = " ".join(f"w{k % 977}" for k in range(30_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "a", 5),
        (1, "the quick brown fox jumps over the lazy dog again and again today", "en", "a", 5),
        (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \n\t ", "en", "a", 4),
        (None, "a row without an id but with quite a few words in it", "en", "a", 3),
        (5, long, "de", "b", None), (6, long, "de", "b", None),
        (6, "ça é 日本語 \U0001F600 'll #$% <|im_end|> 123", "fr", None, 9),
        (7, "one", None, "b", 1),
    ]
    schema = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id string, "
              "tag int, key int, kept int, score int, dedup int, judged int, row int, pos int, term int, "
              "bucket int, verdict int")
    return spark.createDataFrame([(*r, "x", *[k] * 11) for k, r in enumerate(rows)], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
