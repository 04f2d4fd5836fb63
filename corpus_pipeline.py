"""The corpus pipeline: language, near duplicates, benchmark passages, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; `run` writes each stage's rows as
Parquet to the shared folder and reads them again. A stage keeps the columns of its input; the last one gives token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import crossparse, decontaminate, guesscost, piecetable, simhash
from headway.llm.queries import PIECES, table
from headway.llm.shared import keep


# Words that a worker remembers in the stages that remember some: workers live through all stages, and what they
# free is not all given back, so it is less than the operators' own bound. It changes the time only.
REMEMBERED = 50_000


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told (no text or no letters) and sets `lang` to the language found."""
    words = crossparse.learned_from(docs)
    if not words:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    into = "language"
    while into in docs.columns:
        into += "_"
    found = crossparse.identify(docs, words, into=into, remembered=REMEMBERED).where(F.col(into)["lang_pred"] != crossparse.UNDECIDED)
    return found.withColumn("lang", F.col(into)["lang_pred"]).select(docs.columns)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest doc_id of each group of near duplicates."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts; all documents stay."""
    return guesscost.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, number of ids, digests of ids and decoded text, and the ids."""
    model = piecetable.read_model(public_tokenizers.path(PIECES))
    made = piecetable.encoded(model, with_ids=True, remembered=REMEMBERED)(F.col("text")).alias("made")
    return docs.select("doc_id", "lang", "source", made).select("doc_id", "lang", "source", "made.*")


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", tokens),
]

#: Suffix automata, fingerprints, guess costs and byte-pair merges have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
