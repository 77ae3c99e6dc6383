import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tessera.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    yield local_session("*", shuffle_partitions=8)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows and
    ids, ties, and extra columns named like outputs."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(60)
    rows = [
        (1, base, "en", "a", 10), (2, base, "en", "a", 10), (2, base, "en", "a", 10), (3, base + " x", "fr", "b", None),
        (4, None, "en", "a", None), (5, "", "en", None, 0), (6, " \t\n", None, "a", 3), (None, text(30), "en", "b", 5),
        (None, None, None, None, None), (7, text(40_000), "fr", "c", 1), (8, "12 34 !!", "en", "b", 8),
        (9, "éè 你好 αβ", "fr", "c", 9), (10, "one\x0btwo\x85three\xa0four five", "en", "d", 1),
    ]
    rows += [(i, text(rng.randrange(1, 200)), rng.choice(["en", "fr"]), rng.choice("abcd"), i) for i in range(20, 60)]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("clash") for c in ("size", "kept", "score", "shard", "slot", "position", "n_words", "lang_pred")})
