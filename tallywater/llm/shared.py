"""Helpers of the text operators: reading, words, tables kept in the shared folder."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallywater.session import fresh_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Fixed value: what separates words, the complement of the word class of the contracts.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: executors may be lost, rows may not."""
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case and nothing else; plain ASCII texts take the faster function."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_list(text: Column) -> Column:
    """The words of a text in order; the first and last entry may be empty, null has none."""
    return F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS)


def document_key(doc_id: Column, text: Column) -> Column:
    """A document's key: 16 bytes of its id and text, so that rows that share an id by mistake stay
    apart, nulls and empty texts too. At 10**10 documents two share a key with a chance of 10**-19."""
    digest = F.coalesce(F.md5(text.cast("string").cast("binary")), F.lit("-" * 32))
    name = F.coalesce(F.concat(F.lit(":"), doc_id.cast("string")), F.lit(""))
    return F.unhex(F.md5(F.concat(digest, name).cast("binary")))


def ship(module: str) -> None:
    """Send a module's functions to Python workers whole, so that workers need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
