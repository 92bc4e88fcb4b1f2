"""Secret scans: three fixed patterns, and strings whose characters look drawn at random.

The patterns match leftmost and without overlap, each kind for itself; a match that is too short is
dropped after matching, as it was consumed. Candidates for the entropy test are maximal runs of the
base-64 alphabets. A window of fixed length slides over a candidate; the counts of its characters
and the sum of n*log2(n) over them are brought up to date by the character that enters and the one
that leaves, which gives the window's Shannon entropy. Each character class has its own threshold.
The span found reaches from the first to the last window at or above it. Windows that overlap the
mark of a sample are suppressed, and so are candidates that the allow-list matches, those that begin
with the // of a URL, and those within a span of a pattern.

Positions count code points, the end is exclusive. A null text is empty; an empty text has no span.
Time and memory grow with a text's length and with its matches to the power of 3/2, whatever runs it
has.
Repeated rows give equal results; columns other than the two named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds, and the lengths that they must have.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
ASSIGN_LENGTH = 6

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
CANDIDATE = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{WINDOW},}}"
# Character classes, narrowest first: every character of the candidate is in it, and the bits that
# a window must have. 20 random hexadecimal digits have about 3.4 bits, random base-64 about 4.1.
CLASSES = (("^[0-9a-fA-F]+$", 3.0), ("^[A-Z0-9]+$", 3.5), ("^[A-Za-z0-9+/_=-]+$", 3.8))
# What looks random and is not secret, as a whole: no digit or no letter, UUIDs, digits in ascending
# order, words with a number. Repeated groups are possessive, as the JVM matches others by recursion; what
# follows a group never begins like it, so they match the same strings.
ALLOWED = (
    r"^[^0-9]+$|^[^A-Za-z]+$|^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
    r"|^(?i:(?:0123456789(?:abcdef)?+)++[0-9]*)$|^[a-z]++(?:[-_/][a-z]++)*+[-_/]?[0-9]{1,6}$"
)
# Samples and ascending alphabets inside a candidate: the windows that they touch are not secret.
MARKS = ("abcdefgh", "01234567", "example", "sample", "dummy", "placeholder", "xxxxxx")
# The alphabet lies between these two characters; the third is between them and not in it.
LOW, HIGH, MARK = ord("+"), ord("z"), "."


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it for each element of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, add: Callable[[Column, Column], Column] = lambda a, b: a + b) -> Column:
    """The running sums of an array of n numbers of 0 or more, in blocks of about the root of n.

    An array grows by being copied, so lists are only built up within a block and over the blocks.
    ``add`` may be another associative operation with 0 as its neutral element.
    """
    none = F.array().cast("array<bigint>")
    last = lambda sums: F.coalesce(F.try_element_at(sums, F.lit(-1)), F.lit(0).cast("bigint"))
    grown = lambda sums, x: F.concat(sums, F.array(add(last(sums), x)))

    def joined(size: Column) -> Column:
        first = F.sequence(F.lit(1), F.size(values), size)
        blocks = F.transform(first, lambda at: F.aggregate(F.slice(values, at, size), none, grown))
        return let(blocks, lambda b: let(F.aggregate(b, none, lambda sums, x: grown(sums, last(x))), lambda ends: shifted(b, ends)))

    def shifted(blocks: Column, ends: Column) -> Column:
        before = lambda k: F.when(k > 0, F.get(ends, k - 1)).otherwise(F.lit(0).cast("bigint"))
        return F.flatten(F.transform(blocks, lambda b, k: let(before(k), lambda base: F.transform(b, lambda x: add(base, x)))))

    return F.when(F.size(values) > 0, let(F.ceil(F.sqrt(F.size(values))).cast("int"), joined)).otherwise(none)


def matches(text: Column, pattern: str) -> Column:
    """``array<struct<start, end, match, value>>`` of the matches; value is the last group, if any."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if pattern == ASSIGN else found
    empty = F.array().cast("array<struct<start:long,end:long,match:string,value:string>>")

    def spans(m: Column) -> Column:
        # A match ends after all gaps and matches up to it; the gap before it is what lies between matches.
        sizes = F.zip_with(F.slice(m["gaps"], 1, F.size(m["found"])), m["found"], lambda gap, match: (F.length(gap) + F.length(match)).cast("bigint"))
        return let(sizes, lambda n: let(running(n), lambda ends: F.transform(m["found"], lambda match, i: span(m, ends, match, i))))

    def span(m: Column, ends: Column, match: Column, i: Column) -> Column:
        end = F.get(ends, i)
        return F.struct((end - F.length(match)).alias("start"), end.alias("end"), match.alias("match"), F.get(m["values"], i).alias("value"))

    parts = F.struct(found.alias("found"), values.alias("values"), F.split(text, pattern, -1).alias("gaps"))
    return let(parts, lambda m: F.when(F.size(m["found"]) > 0, spans(m)).otherwise(empty))


def unmarked(candidate: Column) -> Column:
    """The candidate with each character of a mark replaced by ``MARK``."""
    out = candidate
    for mark in MARKS:
        out = F.regexp_replace(out, f"(?i:{mark})", MARK * len(mark))
    return F.when(candidate.rlike(f"(?i:{'|'.join(MARKS)})"), out).otherwise(candidate)


def hot_range(candidate: Column, threshold: Column) -> Column:
    """``struct<first, last>``: where the first and the last window at or above the threshold end.

    Windows with a ``MARK`` do not count.
    """
    weights = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 2)])
    slots = F.transform(F.split(candidate, ""), lambda c: (F.ascii(c) - LOW).cast("int"))
    return let(F.struct(slots.alias("slots"), weights.alias("weights"), threshold.alias("least")), _scanned)


def _scanned(given: Column) -> Column:
    slots, weight, mark = given["slots"], given["weights"], ord(MARK) - LOW

    def put(counts: Column, slot: Column, by: int) -> Column:
        """``counts`` with one of them changed."""
        return F.concat(F.slice(counts, 1, slot), F.array(F.get(counts, slot) + by), F.slice(counts, slot + 2, F.lit(HIGH - LOW) - slot))

    def step(state: Column, i: Column) -> Column:
        return let(F.struct(F.get(slots, i).alias("enters"), F.when(i >= WINDOW, F.get(slots, i - WINDOW)).otherwise(-1).alias("leaves")), lambda c: moved(state, i, c))

    def moved(state: Column, i: Column, c: Column) -> Column:
        """The window one character on: one count goes up, the entropy's sum follows, then one goes down."""
        enters, leaves, here = c["enters"], c["leaves"], F.get(state["counts"], c["enters"])
        grown = F.struct(put(state["counts"], enters, 1).alias("counts"), (state["total"] + F.get(weight, here + 1) - F.get(weight, here)).alias("total"))
        return let(grown, lambda g: let(F.when(leaves >= 0, shrunk(g, leaves)).otherwise(g), lambda now: judged(state, i, now)))

    def shrunk(g: Column, leaves: Column) -> Column:
        gone = F.get(g["counts"], leaves)
        return F.struct(put(g["counts"], leaves, -1).alias("counts"), (g["total"] + F.get(weight, gone - 1) - F.get(weight, gone)).alias("total"))

    def judged(state: Column, i: Column, now: Column) -> Column:
        hot = (i >= WINDOW - 1) & (math.log2(WINDOW) - now["total"] / WINDOW >= given["least"]) & (F.get(now["counts"], F.lit(mark)) == 0)
        first = F.when(hot & (state["first"] < 0), i).otherwise(state["first"])
        return F.struct(now["counts"].alias("counts"), now["total"].alias("total"), first.alias("first"), F.when(hot, i).otherwise(state["last"]).alias("last"))

    begin = F.struct(
        F.array_repeat(F.lit(0), HIGH - LOW + 1).alias("counts"), F.lit(0.0).alias("total"), F.lit(-1).alias("first"), F.lit(-1).alias("last")
    )
    places = F.sequence(F.lit(0), F.size(slots) - 1)
    return F.aggregate(places, begin, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _tagged(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, found)`` with ``found array<struct<start, kind, end>>`` in order of start and kind."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("_text"))
    column = F.col("_text")
    none = F.array().cast("array<struct<start:long,end:long,match:string,value:string>>")
    # The patterns run in full only where a cheap search finds one.
    guarded = lambda pattern: F.when(column.rlike(pattern), matches(column, pattern)).otherwise(none)
    rows = rows.withColumn("_assign", F.filter(guarded(ASSIGN), lambda s: F.length(s["value"]) >= ASSIGN_LENGTH))
    rows = rows.withColumns({"_access": guarded(ACCESS), "_hex": guarded(HEX)})
    in_url = lambda s: s["match"].startswith("//") & (F.substring(column, s["start"].cast("int"), F.lit(1)) == ":") & (s["start"] > 0)
    likely = F.filter(guarded(CANDIDATE), lambda s: ~s["match"].rlike(ALLOWED) & ~in_url(s))
    rows = rows.withColumn("_likely", F.transform(likely, lambda s: F.struct(s["start"].alias("start"), s["match"].alias("match"), unmarked(s["match"]).alias("plain"))))

    def bits(match: Column) -> Column:
        chosen = F.lit(CLASSES[-1][1])
        for pattern, threshold in reversed(CLASSES[:-1]):
            chosen = F.when(match.rlike(pattern), threshold).otherwise(chosen)
        return chosen

    ranges = F.transform("_likely", lambda s: F.struct(s["start"].alias("at"), hot_range(s["plain"], bits(s["match"])).alias("hot")))
    hot = F.transform(
        F.filter(ranges, lambda r: r["hot"]["first"] >= 0),
        lambda r: F.struct((r["at"] + r["hot"]["first"] - (WINDOW - 1)).alias("start"), F.lit(3).alias("kind"), (r["at"] + r["hot"]["last"] + 1).alias("end")),
    )
    rows = rows.withColumn("_base", F.array_sort(F.concat(_tagged(F.col("_assign"), 0), _tagged(F.col("_access"), 1), _tagged(F.col("_hex"), 2))))
    rows = rows.withColumn("_hot", F.when(F.size("_likely") > 0, hot).otherwise(F.array().cast("array<struct<start:long,kind:int,end:long>>")))
    # In order of start, a span is within a pattern's if the largest end of these up to it is no smaller.
    rows = rows.withColumn("_every", F.array_sort(F.concat("_base", "_hot")))
    ends = running(F.transform("_every", lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0)), lambda a, b: F.greatest(a, b))
    kept = let(ends, lambda reached: F.filter("_every", lambda s, i: (s["kind"] < 3) | (F.get(reached, i) < s["end"])))
    return rows.select("doc_id", kept.alias("found"))


def digest(found: DataFrame) -> DataFrame:
    """The counts per base kind, the hash of the base spans, and all spans as text."""
    base = F.filter("found", lambda s: s["kind"] < 3)
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
    )
