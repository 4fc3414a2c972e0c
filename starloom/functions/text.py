"""Cleaning of names, headers and string values, and code lists held in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.operators.dedup import last_per_key

# Spellings of "no value" in the string columns of the arrivals.
NULL_WORDS = ["NaN", "NONE", "Null", "null", "None"]

# Fixed formats of the label file: group 1 is the code, group 2 its label. A quote
# inside a label is written twice. The possessive quantifiers keep the matcher from
# recursing, however long the label.
COUNTRY_CODES = r"(\d{3})\s+=\s+'([^']*+(?:''[^']*+)*+)'"
STATE_CODES = r"'(\w{2})'\s*=\s*'([^']*+(?:''[^']*+)*+)'"
CITY_CODES = r"'(\w{3})'\s*=\s*'([^']*+(?:''[^']*+)*+)'"
BLOCK_COMMENTS = r"/\*\s+(.*?)\*/"
# Two port codes that look like state codes.
PORTS_AMONG_STATES = ["AG", "NK"]


def clean_headers(df: DataFrame) -> DataFrame:
    """Spaces and dashes in column names become underscores."""
    return df.toDF(*[c.replace(" ", "_").replace("-", "_") for c in df.columns])


def null_words(df: DataFrame, words: list[str] | None = None) -> DataFrame:
    """The listed words become NULL in every string column; other types are left alone."""
    words = NULL_WORDS if words is None else words
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(words), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def non_empty(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def strip_quotes(value: Column) -> Column:
    return F.replace(value, F.lit("'"), F.lit(""))


def split_city_state(value: Column) -> list[Column]:
    """``CITY, ST`` as two columns; without a comma the state is NULL."""
    parts = F.split(value, ", ")
    return [F.get(parts, 0).alias("city"), F.get(parts, 1).alias("state_code")]


def _one_line(text: str) -> Column:
    """Line ends and tabs as one blank, so that the quotes of two lines never touch."""
    return F.regexp_replace(F.col(text), r"[\r\n\t]+", " ")


def code_pairs(texts: DataFrame, text: str, pattern: str, order: list[str]) -> DataFrame:
    """(order…, _pos, id, label) for every pair the pattern finds in every text."""
    flat = _one_line(text)
    found = texts.select(
        *order,
        F.posexplode(
            F.arrays_zip(
                F.regexp_extract_all(flat, F.lit(pattern), F.lit(1)).alias("id"),
                F.regexp_extract_all(flat, F.lit(pattern), F.lit(2)).alias("label"),
            )
        ).alias("_pos", "_pair"),
    )
    label = F.replace(F.rtrim(F.col("_pair.label")), F.lit("''"), F.lit("'"))
    return found.select(*order, "_pos", F.col("_pair.id").alias("id"), label.alias("label"))


def extract_codes(
    texts: DataFrame, text: str, pattern: str, order: list[str], exclude: list[str] | None = None
) -> DataFrame:
    """(id, label) lookup from label text. Of a repeated code the last one in ``order`` counts."""
    pairs = code_pairs(texts, text, pattern, order)
    if exclude:
        pairs = pairs.where(~F.col("id").isin(exclude))
    return last_per_key(pairs, ["id"], [*order, "_pos"]).select("id", "label")


def extract_comments(texts: DataFrame, text: str) -> DataFrame:
    """(comment) for every block comment, runs of white space made one blank."""
    flat = _one_line(text)
    found = texts.select(
        F.explode(F.regexp_extract_all(flat, F.lit(BLOCK_COMMENTS), F.lit(1))).alias("comment")
    )
    return found.select(F.regexp_replace("comment", r"\s+", " ").alias("comment"))
