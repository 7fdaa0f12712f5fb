"""The corpus pipeline: documents in, packed training sequences out.

STAGES are (name, function); each function takes (spark, docs, sf_dir) and
returns what it keeps.  All but the last return the columns they were
given (the columns of `documents`), with changed texts where the stage
changes texts.  `run` writes every stage's result to the shared checkpoint
folder and reads it again for the next one.

1. language_id: documents whose language is rejected go (no letter, or far
   from every learned text of the language).
2. line_dedup: lines that an earlier document has go; n_chars follows.
3. jaccard_join: of each group of near duplicates the smallest id stays (of
   equal ids one text).
4. decontamination: documents that hold a benchmark item go.
5. packing: what is left is tokenised and packed into sequences of 1024.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kcflow.llm.common import documents, id_key, materialise, unpacked
from kcflow.llm.decontaminate import contaminated_texts
from kcflow.llm.jaccard_join import similar_groups
from kcflow.llm.langid import identify
from kcflow.llm.line_dedup import dedup_lines
from kcflow.llm.packing import pack
from kcflow.llm.queries import held_out
from kcflow.session import ensure_worker_path, release_scratch, scratch_group
from kcflow.sources.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    judged = identify(docs, ~held_out())
    return unpacked(judged.where("NOT rejected"), "row", docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has."""
    cleaned = dedup_lines(docs)
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(
            F.col("row.n_chars")).cast(kind)
    return unpacked(cleaned, "row", docs.columns, **changed)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id, once."""
    groups = similar_groups(docs).where("d = component AND v = component_v").dropDuplicates(
        ["d", "v"])
    return unpacked(groups, "row", docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    leaks = contaminated_texts(docs, table(spark, sf_dir, "benchmark"))
    # rows that share an id, or have none, go by their own text
    away = leaks.select(F.col("d").alias("_leak"), F.col("version").alias("_text")).distinct()
    return docs.join(away, (id_key("doc_id") == away["_leak"])
                     & (F.xxhash64("text") == away["_text"]), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids and their place in a sequence."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=True)


GROUP = "pipeline-"


def _stage(function):
    """A stage's working tables stay until the next stage begins: its documents
    have been written by then, and nothing reads those tables any more."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release_scratch(spark, GROUP)
        with scratch_group(spark, GROUP):
            return function(spark, docs, sf_dir)

    run_stage.__name__, run_stage.__doc__ = function.__name__, function.__doc__
    return run_stage


STAGES = [(f.__name__, _stage(f)) for f in (
    language_id, line_dedup, jaccard_join, decontamination, packing)]

#: Language models and a tokenizer have no SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    ensure_worker_path(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
