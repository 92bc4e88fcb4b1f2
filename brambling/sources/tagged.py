"""One document per line: ``<doc id="..." url="..." ...> text </doc>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _after(text: Column, mark: str) -> Column:
    """What follows the first ``mark``; null where there is none."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.substr(text, at + len(mark)))


def _before(text: Column, mark: str) -> Column:
    """What precedes the first ``mark``; null where there is none."""
    return F.when(F.instr(text, mark) > 0, F.substring_index(text, mark, 1))


#: Why a line holds no document, in the order in which it is found out.
REASONS = ("no id", "no text mark", "no end tag")


def _doc_id(line: Column) -> Column:
    return _before(_after(line, 'id="'), '" url=')


def _reason(line: Column, text_mark: str) -> Column:
    """The first of ``REASONS`` that holds; null for a line with a document."""
    missing = (~line.contains("id=") | _doc_id(line).isNull(), ~line.contains(text_mark), F.instr(line, " </doc>") == 0)
    out = F.when(line.isNull() | missing[0], REASONS[0])
    return out.when(missing[1], REASONS[1]).when(missing[2], REASONS[2])


def parse_lines(lines: DataFrame, text_mark: str = '"> ') -> DataFrame:
    """``(value, reason, doc_id, text)`` of every line, in one pass.

    The text begins after the first ``text_mark`` (``'"> '`` or ``'">'``) and ends at the first
    `` </doc>`` of the line. ``reason`` says why a line has neither id nor text; else it is null.
    """
    line = F.col("value")
    start = F.instr(line, text_mark) + len(text_mark)
    size = F.greatest(F.instr(line, " </doc>") - start, F.lit(0))
    rows = lines.select("value", _reason(line, text_mark).alias("reason"))
    good = F.col("reason").isNull()
    return rows.select("value", "reason", F.when(good, _doc_id(line)).alias("doc_id"), F.when(good, F.substr(line, start, size)).alias("text"))


def parse_documents(lines: DataFrame, text_mark: str = '"> ') -> DataFrame:
    """``(doc_id, text)`` of the lines that hold a document; ``rejected_lines`` has the others."""
    return parse_lines(lines, text_mark).where("reason is null").select("doc_id", "text")


def rejected_lines(lines: DataFrame, text_mark: str = '"> ') -> DataFrame:
    """``(value, reason)`` of the lines without a document."""
    return parse_lines(lines, text_mark).where("reason is not null").select("value", "reason")


def line_funnel(lines: DataFrame, text_mark: str = '"> ') -> DataFrame:
    """``(step, reason, rejected, kept)``: how many lines each reason takes, and how many are left then."""
    reason = _reason(F.col("value"), text_mark)
    counts = lines.select(reason.alias("reason")).agg(F.count("*").alias("all"), *(F.count_if(F.col("reason") == r).alias(f"r{k}") for k, r in enumerate(REASONS)))
    steps, gone = [], F.lit(0)
    for k, name in enumerate((None, *REASONS)):
        own = F.col(f"r{k - 1}") if k else F.lit(0)
        gone = gone + own
        steps.append(F.struct(F.lit(k).alias("step"), F.lit(name).cast("string").alias("reason"), own.cast("bigint").alias("rejected"), (F.col("all") - gone).alias("kept")))
    return counts.select(F.inline(F.array(*steps)))


def tagged_line(doc_id: Column, text: Column, text_mark: str = '"> ') -> Column:
    """A document as one tagged line; line breaks inside the text become blanks."""
    flat = F.translate(text, "\r\n", "  ")
    return F.concat(F.lit('<doc id="'), doc_id, F.lit(f'" url="u" title="t{text_mark}'), flat, F.lit(" </doc>"))
