"""Column expressions on texts and document ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: Column | str) -> Column:
    """Lower-case words of a text; everything that is not an ASCII letter separates words."""
    return F.transform(letter_runs(text), F.lower)


def letter_runs(text: Column | str) -> Column:
    """The runs of ASCII letters of a text, in upper and lower case."""
    return F.regexp_extract_all(text, F.lit("[a-zA-Z]+"), F.lit(0))


def blank_runs(text: Column | str) -> Column:
    """The pieces of a text between white space of any script, punctuation kept."""
    return F.regexp_extract_all(text, F.lit(r"(?U)[^\s\x1c-\x1f]+"), F.lit(0))


def label_from_prefix(doc_id: Column | str, prefix: str = "AU") -> Column:
    """1 for ids that start with ``prefix``, else 0."""
    return F.when(F.col(doc_id).startswith(prefix) if isinstance(doc_id, str) else doc_id.startswith(prefix), 1).otherwise(0)


def label_from_path(doc_id: Column | str) -> Column:
    """The middle part of ids such as ``corpus/category/number``."""
    return F.split_part(doc_id, F.lit("/"), F.lit(2))
