"""From raw documents to token files: language, near-duplicates, benchmark, mix, tokens.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns
a DataFrame, which is written as Parquet and read again as the next stage's ``docs``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontam, langid, mixing, neardup, queries, tokens
from ledgerline.llm.scratch import written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts; it learns from the labelled ones.

    Null, empty and white-space texts and texts without a letter go.  Rows are judged one by one, so
    repeated rows and ids stay or go together.  Without a labelled row every text with a letter
    stays; an empty table gives an empty one.  Other columns pass unchanged."""
    return langid.accepted_rows(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more).

    The row of the smallest id stays, once; a group without ids keeps one row, too.  Texts without
    a word are linked with nothing; rows that repeat both id and text are one.  Rows that share an
    id are one group.  An empty table gives an empty one."""
    return neardup.drop_near_duplicates(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word window with the benchmark.

    Null and empty texts have no word and stay; rows are judged one by one.  An empty benchmark, or
    one without words, lets everything pass; an empty table gives an empty one."""
    return decontam.decontaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source of its own.  Null and empty texts have no words and follow their
    source's draw like others.  Rows with the same id draw alike.  An empty table gives an empty one."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the mix, read back: doc_id, start, n_tokens, ids_crc32.

    One row per row; null and empty texts are the end id alone; null ids come first; repeated rows
    are all written.  An empty table gives an empty one and no file."""
    return tokens.token_table(docs, queries.tokenizer_path(), end_id=queries.END_ID)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_ids", token_ids),
]

#: Language identification and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between them is written in the checkpoint folder."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
