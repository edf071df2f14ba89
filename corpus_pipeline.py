"""From raw documents to packed training sequences.

Five stages, each working on all that the one before kept: quality rules drop texts that are
probably junk, line dedup takes out lines that many documents share, MinHash near-dedup keeps one document of
each group, decontamination cuts benchmark passages out, and best-fit packing places the rest. All but the
last return the columns of ``documents``; ``n_chars`` follows the text. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import decontaminate, line_dedup, minhash, packing, quality_rules
from tradewind.llm.common import fresh
from tradewind.llm.queries import table, vocabulary
from tradewind.session import stage


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with ``n_chars`` (if there is one) counted anew."""
    return docs.select(*[F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
                         for c in columns])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules find good."""
    columns = docs.columns
    judged = quality_rules.judge(docs)
    return judged.where(judged[judged.columns[-1]]).select(*columns)


def unshared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; a text may end up empty."""
    return _measured(line_dedup.drop_shared_lines(docs), docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, whatever the doc_ids: texts are compared, and a hash of the text names it.

    The row with the smallest doc_id stays, rows without one come last; between rows of one doc_id the smallest hash of
    text and all columns decides. Texts without words are no copies of anything: all of them stay.
    """
    columns, text, row = docs.columns, fresh(docs, "_text"), fresh(docs, "_row")
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    hashed = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    rows = docs.where(has_words).withColumns({text: F.xxhash64("text"), row: F.xxhash64(*hashed)})
    groups = minhash.duplicate_groups(rows.select(F.col(text).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias(text), "component_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", text, row)).alias("first")
    kept = (rows.groupBy(text).agg(first).join(groups, text).groupBy("component_id").agg(F.min("first").alias("first"))
            .select(f"first.{text}", f"first.{row}"))
    # rows that are equal in all columns have equal hashes
    one = rows.join(kept, [text, row], "left_semi").dropDuplicates([text])
    return one.select(*columns).unionByName(docs.where(~has_words))


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items."""
    return _measured(decontaminate.mark(docs, table(spark, sf_dir, "benchmark"), clean=True), docs.columns)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 tokens."""
    return packing.pack(docs, vocabulary())


#: name and function, in order
STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", unshared_lines),
    ("minhash_dedup", distinct_documents),
    ("decontaminate", clean_documents),
    ("best_fit_packing", packed_documents),
]

#: estimated rule accuracies and a tokenizer cannot be written in SQL; tests use a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
