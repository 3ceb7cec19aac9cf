"""The corpus pipeline: documents through five operators of ``etafeat.llm``, in turn.

Each stage takes all that the one before kept; its result is written as Parquet
in the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from etafeat.llm.common import materialize, table
from etafeat.llm.decontamination import without_benchmark
from etafeat.llm.line_dedup import drop_repeated_lines
from etafeat.llm.quality import keep_good
from etafeat.llm.simhash import keep_one_per_group
from etafeat.llm.source_mixing import mixed_documents

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_per_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed_documents),
]

#: The models, fingerprints and templates of the stages are not SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
