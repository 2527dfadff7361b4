"""The corpus pipeline: stages over documents, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.functions.lineage import cut
from sessionloom.llm import exact, langid, mixing, nearcopies, packing
from sessionloom.session import tune


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the byte network tells; texts without letters and what its junk class rejects go.

    Null texts have no letters.  Each row goes by its own text, so ids may be
    null or repeated.  An empty table, and names that clash, change nothing.
    """
    tune(spark)
    model = langid.train(docs, F.lit(True), junk=langid.JUNK)
    if model is None:  # nothing is labelled: only texts without letters can be rejected
        model = langid.fit(["a"], ["unlabelled"], rounds=1)
    return langid.identified(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of texts that are equal but for blanks.

    Null and empty texts are equal; rows that repeat an id become one; null is
    an id like any other.  An empty table gives none; names may clash.
    """
    tune(spark)
    return exact.drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by 0.8 of their five-word shingles.

    Null and empty texts are alike; rows that repeat an id share their fate;
    rows without an id stay.  An empty table gives none; names may clash.
    """
    tune(spark)
    return nearcopies.drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with gently flattened shares of sources, languages and forms of text.

    Null values of a margin are one value; rows that repeat an id share their
    fate.  An empty table gives none; names may clash.
    """
    tune(spark)
    return mixing.drop_unsampled(docs, power=0.9)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    Null text is empty and gives its end token; rows that repeat an id are packed
    each; an empty table gives none; only id and text are read.
    """
    tune(spark)
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language ID", known_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A network, shingle links and tokens cannot be said in SQL; tests hold run() against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
