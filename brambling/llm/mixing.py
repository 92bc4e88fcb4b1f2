"""Mixing sources to target weights by capped water-filling.

A source's target is its weighted share of all words. A source can be repeated ``epochs`` times at
most: what its share holds above that goes to the other sources by their weights, until no target
is above its cap. A target is met by whole repetitions of all documents and one more of a part,
which is chosen by a seeded hash of the document's id. The part is cut where the words before it
come nearest to what is left of the target: the cut is searched among the sums of hash buckets,
first coarse, then fine within one coarse bucket, so no source is ever sorted or gathered.

A null or empty text has size 0. A null source is a source of its own, after all others. Rows that
repeat an id share its hash and so its fate; a source of few ids, each in many rows, can miss its target. An empty table gives an empty result; a source without
words has target 0 and is not repeated. Input columns that are not named are ignored by ``mix`` and
kept by ``repeat``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brambling.llm.common import join_measured, key_of, number_rows
from brambling.session import cut, store

WORD = r"[^\x20\x09-\x0D]+"
EPOCHS = 3
SEED = "mix-1"
# Hex digits of the hash that name a document's cell, and how many of them name the coarse bucket.
DIGITS, COARSE = 5, 2


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cell_of(doc_id: str, seed: str) -> Column:
    """A number below 16**DIGITS from the seed and the id."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("int")


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Weights for the sources in code point order, null last, repeating the cycle."""
    order = [F.col("_source").asc_nulls_last()]
    ranked = number_rows(sources, order, "_rank")
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (F.col("_rank") % len(cycle) + 1).cast("int"))
    return ranked.withColumn("_weight", weight).drop("_rank")


def water_level(sources: DataFrame, epochs: int) -> float:
    """The words per unit of weight at which all targets together are all words.

    One small aggregate over the sources per round; a round clamps every source whose share is
    above its cap, and the level can only rise, so the rounds end.
    """
    level, clamped = 0.0, -1
    over = F.col("_words") * epochs < F.lit(level) * F.col("_weight")
    while True:
        total, caps, weight, count = sources.agg(
            F.coalesce(F.sum("_words"), F.lit(0)),
            F.coalesce(F.sum(F.when(over, F.col("_words") * epochs)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("_weight"))), F.lit(0)),
            F.count_if(over),
        ).first()
        if count == clamped or not weight:
            return level
        clamped, level = count, (total - caps) / weight
        over = F.col("_words") * epochs < F.lit(level) * F.col("_weight")


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", epochs: int = EPOCHS, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """``(sized, shares)``: the documents' sizes and cells, and per source its target and its cut.

    ``shares`` has ``_key, _words, _target, _whole, _cut``: all documents are taken ``_whole``
    times, and those with a cell below ``_cut`` once more.
    """
    sized = store(
        docs.select(F.col(doc_id).alias("_id"), F.col(source).alias("_source"), key_of(source).alias("_key"), size_of(text).alias("_size"), cell_of(doc_id, seed).alias("_cell"))
    )
    sources = store(cyclic_weights(sized.groupBy("_key", "_source").agg(F.sum("_size").alias("_words"))))
    level = water_level(sources, epochs)
    cap = (F.col("_words") * epochs).cast("double")
    shares = sources.withColumn("_target", F.least(cap, F.lit(level) * F.col("_weight")))
    whole = F.coalesce(F.floor(F.try_divide(F.col("_target"), F.col("_words"))), F.lit(0)).cast("long")
    shares = shares.withColumn("_whole", whole)
    shares = store(shares.withColumn("_need", F.col("_target") - F.col("_whole") * F.col("_words")))

    fine = 16 ** (DIGITS - COARSE)
    bucket = F.floor(F.col("_cell") / fine).cast("int")
    sums = sized.groupBy("_key", bucket.alias("_bucket")).agg(F.sum("_size").alias("_n"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # The bucket in which the rest of the target is reached; at most one per source.
    edge = sums.join(shares.select("_key", "_need"), "_key").where("_need > 0 and _before <= _need and _need < _before + _n")
    edge = cut(edge.select("_key", "_bucket", "_before", "_need"))

    inside = join_measured(sized, edge, "_key").where(bucket == F.col("_bucket"))
    cells = inside.groupBy("_key", "_cell", "_before", "_need").agg(F.sum("_size").alias("_n"))
    below = Window.partitionBy("_key").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("_before") + F.coalesce(F.sum("_n").over(below), F.lit(0)) + F.col("_n") / 2
    taken = cells.withColumn("_middle", middle).where("_middle <= _need")
    cuts = taken.groupBy("_key").agg((F.max("_cell") + 1).alias("_fine"))
    cuts = edge.select("_key", (F.col("_bucket") * fine).alias("_start")).join(cuts, "_key", "left")
    # A source without an edge has nothing left over.
    shares = shares.join(cuts, "_key", "left").withColumn("_cut", F.coalesce("_fine", "_start", F.lit(0)))
    return sized, cut(shares.select("_key", "_words", "_target", "_whole", "_cut"))


def _copies() -> Column:
    return (F.col("_whole") + (F.col("_cell") < F.col("_cut")).cast("long")).cast("long")


def mix(docs: DataFrame, **options: object) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, copies)`` per document."""
    sized, shares = plan(docs, **options)
    rows = join_measured(sized, shares, "_key")
    copies = _copies()
    return rows.select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_words").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_size") * copies).alias("taken"), copies.alias("copies"),
    )


def repeat(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", seed: str = SEED, **options: object) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as it is taken."""
    _, shares = plan(docs, doc_id=doc_id, source=source, seed=seed, **options)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = join_measured(docs.select(whole, key_of(source).alias("_key"), cell_of(doc_id, seed).alias("_cell")), shares, "_key")
    return rows.select("_row", F.explode(F.sequence(F.lit(1), F.when(_copies() > 0, _copies())))).select("_row.*")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, {DIGITS}))::BIGINT AS cell
  FROM documents),
words AS (SELECT source, sum(size)::BIGINT AS words FROM sized GROUP BY source),
sources AS (SELECT source, words, {EPOCHS} * words AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM words),
filled AS (
  SELECT *, sum(words) OVER () AS total, row_number() OVER (ORDER BY cap / w, source) AS k,
    sum(cap) OVER (ORDER BY cap / w, source) AS caps, sum(w) OVER () - sum(w) OVER (ORDER BY cap / w, source) AS rest
  FROM sources),
levels AS (
  SELECT 0 AS k, (max(total))::DOUBLE / sum(w)::DOUBLE AS level FROM filled
  UNION ALL SELECT k, (total - caps)::DOUBLE / rest::DOUBLE FROM filled WHERE rest > 0),
lowest AS (
  SELECT level FROM levels l WHERE NOT EXISTS (
    SELECT 1 FROM filled f WHERE f.k > l.k AND f.cap < l.level * f.w) ORDER BY k LIMIT 1),
shares AS (
  SELECT source, words, least(cap::DOUBLE, level * w) AS target FROM filled, lowest),
wholes AS (
  SELECT *, CASE WHEN words = 0 THEN 0 ELSE floor(target / words) END::BIGINT AS whole FROM shares),
cells AS (SELECT source, cell, sum(size)::BIGINT AS n FROM sized GROUP BY source, cell),
middles AS (
  SELECT source, cell, sum(n) OVER (PARTITION BY source ORDER BY cell) - n / 2 AS middle FROM cells)
SELECT s.doc_id, s.size, w.words AS source_size, w.target,
  s.size * (w.whole + CASE WHEN m.middle <= w.target - w.whole * w.words AND w.target > w.whole * w.words THEN 1 ELSE 0 END) AS taken,
  (w.whole + CASE WHEN m.middle <= w.target - w.whole * w.words AND w.target > w.whole * w.words THEN 1 ELSE 0 END)::BIGINT AS copies
FROM sized s JOIN wholes w ON s.source IS NOT DISTINCT FROM w.source
JOIN middles m ON s.source IS NOT DISTINCT FROM m.source AND s.cell = m.cell
"""
