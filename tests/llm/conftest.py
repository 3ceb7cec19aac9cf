from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import DataFrame

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (id, text[, source]) as a table of documents."""
    def make(rows: list[tuple]) -> DataFrame:
        return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows], DOCS)

    return make


@pytest.fixture
def folder(tmp_path: Path):
    """A folder of tables: folder(name=frame, ...) gives its path."""
    def make(**tables: DataFrame) -> str:
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make
