import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A DataFrame of documents from (doc_id, text) pairs, with further columns
    whose names clash with those that the operators use inside."""
    def docs(rows, extra=("row", "sha", "id", "node", "__lost", "score", "maybe", "keep_id")):
        schema = "doc_id long, text string" + "".join(f", `{c}` string" for c in extra)
        return spark.createDataFrame([(i, t, *(f"{c}{i}" for c in extra)) for i, t in rows], schema)
    return docs


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from pricelake.llm.common import ship
    ship(spark)
