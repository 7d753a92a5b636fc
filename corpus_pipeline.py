"""The corpus pipeline: language ID, toxicity, exact dedup, near-dedup and packing, each on what the stage before kept.

Defined results: a null or empty text, one without a letter, and one whose language stays open between two goes at the
first stage; where no row tells a language, all others stay there, and where no row is labelled, all stay at the second; very long texts pass every stage whole; of
rows that repeat, or of ids that do, exactly one row of each group of equal or similar texts stays; ties go by doc_id,
then by the order of the rows; an empty table gives an empty result; all columns of the documents stay as they are,
whatever their names, until packing.
"""

from __future__ import annotations

import public_tokenizers as vocabularies
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import exact_dedup as exact
from tallybrook.llm import lang_id, near_dedup, packing, toxicity
from tallybrook.llm.common import read, write_table


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


#: Rows of a batch that goes to Python, unless the session sets another number: a batch of long texts stays small.
BATCH_ROWS, BATCH_SETTING = 500, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: list[str] | None = None) -> DataFrame:
    """Keeps documents whose predicted language is one of `languages` (by default of those learned) and isn't ambiguous, so
    none without a letter and none that mixes languages about evenly. The model learns from the rows of docs that op1
    learns from; without any, the letter alone decides."""
    small_batches(spark)
    model = lang_id.train(docs, ~lang_id.held_out())
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = tuple(fresh(docs, n) for n in ("lang_pred", "lang_score", "ambiguous"))
    found = lang_id.predict(docs, model, names=names)
    return found.where(F.col(names[0]).isin(languages or model.languages) & ~F.col(names[2])).select(*docs.columns)


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are predicted toxic. The lexicon learns from the rows of docs that op2 learns from."""
    small_batches(spark)
    lexicon = toxicity.train(docs, read(spark, sf_dir, "labels"), ~toxicity.held_out())
    names = tuple(fresh(docs, n) for n in ("toxic_score", "toxic_pred"))
    return toxicity.predict(docs, lexicon, names=names).where(F.col(names[1]) == 0).select(*docs.columns)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a number for each row, written, so that the numbers hold; and that column's name."""
    number = fresh(docs, "row_number")
    return write_table(docs.withColumn(number, F.monotonically_increasing_id()), "numbered"), number


def one_of_equals(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of identical texts, one row with the largest id."""
    small_batches(spark)
    rows, number = numbered(docs)
    kept = exact.exact_dedup(rows, row_col=number, memory_bytes=24 << 20).where("kept").groupBy("text_sha256").agg(F.min(number).alias(number))
    return rows.join(kept.select(number), number, "left_semi").select(*docs.columns)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of each near-duplicate class, one row with the smallest id."""
    small_batches(spark)
    rows, number = numbered(docs)
    kept = near_dedup.near_duplicates(rows, row_col=number).where("stays")
    return rows.join(kept.select(number), number, "left_semi").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: doc_id, piece, start, length, ids_crc32, sequence_id, offset, generations."""
    small_batches(spark)
    return packing.pack_documents(docs, vocabularies.path("byte_bpe_50k.json"), keep_segments=False)


STAGES = [("language_id", known_language), ("toxicity", civil), ("exact_dedup", one_of_equals), ("near_dedup", one_of_similar), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each result written before the next stage reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned models decide the first two stages, which SQL can't express.
ORACLE_SQL = None
