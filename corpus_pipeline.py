"""From documents to token files: each stage works on all that the one before it kept.

1. toxicity: documents rejected as toxic go
2. simhash: of every group of near copies the first document stays
3. decontaminate: documents with a benchmark passage go
4. mixing: the documents are laid out in the interleaved order of the sources' target weights
5. tokens: the texts are written as token records in that order, and read back
"""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.llm import decontaminate, mixing, queries, simhash, token_records, toxicity
from millwright.llm.common import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, queries.table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The order of the rows, file after file, is the mixture; no document is dropped."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return mixing.in_order(docs, queries.WEIGHTS, partitions)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records in the order in which the documents are stored; by id where they come from no file."""
    order = [F.col("_metadata.file_name"), F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        order = None
    return token_records.encode_to_files(docs, queries.tokenizer_path(), queries.END_ID, order)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

# SQL can neither train the classifier nor apply the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage's rows are stored and read again."""
    rows = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
