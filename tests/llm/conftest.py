import sys
from pathlib import Path

import pytest
from hypothesis import settings

settings.register_profile("slow machines", deadline=None)
settings.load_profile("slow machines")
sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small(spark):
    """The smallest tables, and their texts by doc_id."""
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return SMALL, {r.doc_id: r.text for r in rows}


@pytest.fixture
def documents(spark):
    """Makes a table of documents from texts, or from (doc_id, text, lang, source)."""

    def make(*rows):
        full = [
            (*row, len(row[1] or "")) if isinstance(row, tuple) else (i, row, "en", f"s{i}", len(row or ""))
            for i, row in enumerate(rows)
        ]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
