import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [p for p in (ROOT, os.path.join(ROOT, "tests")) if p not in sys.path]

SF = "/root/testdata/sf0.001"


@pytest.fixture
def work(spark, tmp_path):
    """Scratch tables of one test, in its own folder."""
    from regain.llm.common import Workspace

    work = Workspace(spark, "test")
    work.root = f"file://{tmp_path}/scratch"
    return work


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) or (id, text, source); extra columns have names the operators use themselves."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", 7) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, size long"
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
