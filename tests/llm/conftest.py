import random

import pytest

SMALL = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(7)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]


@pytest.fixture(scope="session")
def edge_rows(words):
    """Nulls, empty and very long texts, repeats, odd white space, foreign scripts."""
    rng = random.Random(3)
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = [
        (1, None, "en"),
        (2, "", "en"),
        (3, "   \n\t ", None),
        (4, passage, "en"),
        (4, passage, "en"),
        (5, "Before it. " + passage + " after it.", "de"),
        (None, passage + " and more", None),
        (None, None, None),
        (6, " ".join(rng.choice(words) for _ in range(30_000)), "en"),
        (7, "x" * 5_000, "fr"),
        (8, "ab " * 3_000, "fr"),
        (9, "Don't  stop,\r\n\x0b\x1c\x85\xa0 日本語  12,345 😀😀 ÀÉî <|endoftext|> ~~", "ja"),
        (10, "one two three four", "en"),
    ]
    texts += [(100 + i, " ".join(rng.choice(words) for _ in range(80 + i)), "en") for i in range(20)]
    return [(i, t, l, "src", len(t or "")) for i, t, l in texts]


CLASHING = [
    "fp", "root", "ids", "row", "place", "key", "n", "score", "kept", "removed", "start", "item",
    "length", "fingerprint", "component_id", "n_words", "nll", "text_2", "high", "digest",
]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows, tmp_path_factory):
    """The edge rows as a table with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    from tidemark.llm.shared import prepare

    prepare(spark)
    path = str(tmp_path_factory.mktemp("docs") / "edge")
    frame = spark.createDataFrame(edge_rows, COLUMNS).repartition(3)
    frame.withColumns({c: F.lit("?") for c in CLASHING}).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, edge_docs):
    return spark.createDataFrame([], edge_docs.schema)


@pytest.fixture(scope="session")
def small_docs(spark):
    from tidemark.llm.shared import prepare

    prepare(spark)
    return spark.read.parquet(f"{SMALL}/documents.parquet")
