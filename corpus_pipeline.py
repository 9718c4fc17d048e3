"""From raw documents to token files: the corpus operators as one pipeline.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet to the shared folder and the next stage reads it from there, so a
lost executor costs at most the running stage.  All but the last return the
columns of ``documents``.

* language: documents without a letter go, and those whose language isn't found with
  a calibrated probability that is ``MARGIN`` of the way from chance, one of the
  learned languages, to certainty (0.35 of four, 0.57 of two);
* near_duplicates: of documents linked by 3-word shingles (0.9 or more), directly
  or through others, the one with the smallest id stays;
* decontaminate: documents that hold a benchmark item, up to a fifth of its words
  edited, go;
* mix: documents are taken, and some repeated, to the target weights;
* tokens: ids are written in byte-plane files and read back, a row per document.

What odd rows come to, stage by stage:

* null and empty texts have no letter, and go with the language stage; a null lang
  isn't learned from, but its document is judged as any other;
* very long texts are read whole by every stage, in blocks of bounded size;
* rows with the same id are documents each by itself; of equal texts the
  near-duplicate stage leaves the one with the smallest id (null counts as smaller
  than any), of repeated rows one, and later ties are broken by the text;
* a null id, or one that is no number, takes part as null; it is not learned from;
* extra columns come through all but the last stage as they are, whatever their
  names; the last returns its own four columns;
* empty tables pass through all stages.

The language stage learns from the documents themselves, so the rows can't be given
in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorewell.llm.common import table, written
from scorewell.llm.decontam import clean
from scorewell.llm.jaccard_join import one_of_each
from scorewell.llm.langid import keep_known, least_probability
from scorewell.llm.mixing import PLAN, mix
from scorewell.llm.queries import tokenizer_path
from scorewell.llm.token_file import token_table

#: How far from chance to certainty a text's language must be found: only texts that say next to nothing fall below.
MARGIN = 2 / 15


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known(docs, lambda n_labels: least_probability(n_labels, MARGIN))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, PLAN)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_table(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mixed),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
