import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(HERE)))

from arealens.session import checkpoint_dir, get_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app_name="arealens-llm-tests", shuffle_partitions=4,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="arealens-wh-"),
                           "spark.ui.showConsoleProgress": "false"})
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="arealens-ckpt-"))
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="arealens-llm-test-")


@pytest.fixture(scope="session")
def documents(spark):
    """(rows, frame) of the smallest documents table."""
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    return [(r.doc_id, r.text) for r in df.collect()], df


#: Nulls, empty and blank texts, ties, repeated rows, and columns that clash with internal names.
EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id string, shard int"


@pytest.fixture(scope="session")
def edges(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu"
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "..."), (5, words), (5, words), (6, words.upper()),
            (None, "no id here"), (None, None), (7, "x"), (8, "é à ü " * 40), (9, (words + " ") * 3000),
            (10, (words + " ") * 3000), (11, "token = 'abcdef0123456789abcdef01' user=bob https://host.example.org")]
    return spark.createDataFrame([(i, t, None if i in (2, 6) else "en", "s", None, "k", "i", 3) for i, t in rows],
                                 EDGE_SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)
