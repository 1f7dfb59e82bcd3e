import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tierlake.llm.shipping import ship  # noqa: E402
from tierlake.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    s = local_session("4", shuffle_partitions=4, extra={"spark.ui.showConsoleProgress": "false"})
    ship(s)
    yield s


@pytest.fixture(scope="session")
def medium(spark):
    return spark.read.parquet(f"{SF_MEDIUM}/documents.parquet")


def documents(spark, texts, ids=None):
    """A documents table with extra columns whose names the operators use themselves."""
    rows = [(i if ids is None else ids[i], t, "en", None, None, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + ", spans string, n_words int")
