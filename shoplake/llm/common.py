"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.session import shared_dir

# A word is a maximal run of anything but these six ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]+"


def text_of(col: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for a text without words."""
    return F.array_remove(F.split(text, SPACE), "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a new folder under the shared directory and read it back.

    Cuts lineage: later jobs read the files, so a lost executor never makes
    Spark redo the work above this point.
    """
    path = shared_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside the lambdas of ``body``."""
    return F.get(F.transform(F.array(value), body), 0)


def id_key(col: str) -> Column:
    """A document id as join key; null becomes the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_hash(col: str) -> Column:
    """128-bit hash of a text, null as empty; with the doc_id it names a row where ids are missing or repeated."""
    return F.md5(text_of(col).cast("binary"))


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, _hash (of the text) and _row, the whole row as one struct: no column of ``docs`` can clash."""
    return docs.select("doc_id", "text", text_hash("text").alias("_hash"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Separators of normalised words: every ASCII character that is no digit or lower-case letter.
PUNCTUATION = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal_words(text: Column) -> Column:
    """Words of the lower-cased text, ASCII punctuation and white space as separators."""
    return F.array_remove(F.split(F.lower(text), PUNCTUATION), "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))
