import os

import public_tokenizers
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCHEMA = "doc_id long, text string, source string, score double, node string, ids string, `_id` int"


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture(scope="session")
def tokenizer_path():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def documents(spark):
    """Documents with other columns whose names the operators use themselves."""

    def make(rows, parts=2):
        full = [(i, t, "host", 1.0, "x", "y", 7) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make
