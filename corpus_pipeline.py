"""From raw documents to token digests: quality, near-duplicates, repeated passages, source mix, pieces.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns a DataFrame that is
written and read again as the next one's docs. All but the last return the columns of ``documents``.

1. quality: documents that the positive-unlabelled classifier scores under 0.5 go.
2. near_dedup: of each class of near-duplicates the document of smallest doc_id stays.
3. substring: words of windows of 50 words that an earlier document has are cut out; a document left empty goes.
4. mixing: all documents stay, in the order of the mix over the files.
5. pieces: number of ids, and digests of ids and of decoded text, row by row in the order of the mix: the order in which
   to train, for any length of a run in the mix's proportions as long as all sources last.

Edge cases, at every stage: null, empty and very long texts are read whole; a null text is scored as an empty one, has
no near-duplicate, loses no words and gives the end id alone. Rows of null doc_ids go only where the classifier rejects
them; rows of one doc_id with different texts are judged by their own texts, but go together as near-duplicates. Repeated
rows are treated alike. Empty tables give empty ones. Further columns are carried along to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandspark.llm import mixing, neardup, pieces, quality, store, substring
from demandspark.llm.queries import table, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.remove(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.blend(docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.digest_in_order(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("substring", substring_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

#: The classifier is trained, so SQL cannot give these rows; tests/llm/test_pipeline.py checks each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    last = None
    for name, stage in STAGES[:-1]:
        docs = store.keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last is not None:
            store.drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
