"""Classes of documents and parts: category numbers, indicator features, a forest, and its measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.operators import categories, evaluation, forest, saved, tables
from brambling.operators import neighbours as nn
from brambling.plans import fits, texts
from brambling.plans.tables import read
from brambling.session import scratch_path, store

SHARE, TREES, K = 0.8, 20, 10
SMALL, NO_TYPE = 15, "STANDARD"
NUMBERS, GROUPS = ("p_size", "p_retailprice"), ("p_type", "p_brand")
# Letters that some languages have and others lack.
LETTERS = "ñóíßäöüéèêçœwky"


def typed_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts, some of them without a type."""
    kind = F.when(~F.col("p_type").startswith(NO_TYPE), F.col("p_type"))
    return read(spark, folder, "part").select("p_partkey", kind.alias("p_type"), "p_brand", "p_size", "p_retailprice")


def small_parts(parts: DataFrame) -> DataFrame:
    """The rows that categories are fitted on; other rows have values that these lack."""
    return parts.where(F.col("p_size") < SMALL)


def category_index(spark: SparkSession, folder: str) -> DataFrame:
    """The place of every part's type, and the type found back at that place."""
    parts = typed_parts(spark, folder)
    index = categories.fit_index(small_parts(parts), "p_type")
    placed = index.place_of(parts.select("p_partkey", "p_type"), "p_type", "place")
    return index.value_of(placed, "place", "found")


def one_hot_features(spark: SparkSession, folder: str) -> DataFrame:
    """Numbers, types and brands of all parts as one sparse vector, a row per entry."""
    parts = typed_parts(spark, folder)
    layout = categories.fit_layout(small_parts(parts), NUMBERS, GROUPS, drop_last=True)
    cells = layout.entries(parts).select("p_partkey", F.explode("entries").alias("e"))
    return cells.select("p_partkey", "e.rank", "e.value")


def one_hot_layout(spark: SparkSession, folder: str) -> DataFrame:
    """What each rank of those vectors means."""
    parts = typed_parts(spark, folder)
    return categories.fit_layout(small_parts(parts), NUMBERS, GROUPS, drop_last=True).describe(parts)


def letter_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Per document its language, its source, and how often each of ``LETTERS`` occurs per character."""
    docs = read(spark, folder, "documents")
    low = F.lower(F.coalesce("text", F.lit("")))
    size = F.greatest(F.length(low), F.lit(1))
    shares = {f"share_{k}": (F.length(low) - F.length(F.translate(low, letter, ""))) / size for k, letter in enumerate(LETTERS)}
    return docs.select("doc_id", "lang", "source", *(value.alias(name) for name, value in shares.items()))


def rf_classification(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of both parts, trees and classes, and whether the languages predicted for held-out
    documents are right more often than the most frequent language, and in nine of ten cases. Which
    rows a tree is trained on depends on how rows lie in partitions, but not these facts."""
    rows = store(letter_shares(spark, folder))
    in_train = tables.key_split(rows, "doc_id", SHARE)
    parts = rows.agg(F.count_if(in_train).alias("n_train"), F.count_if(~in_train).alias("n_test"))
    numeric = [c for c in rows.columns if c.startswith("share_")]
    model = forest.ForestClassifier.fit(rows.where(in_train), "lang", numeric, ["source"], TREES)
    predicted = store(model.predict(rows.where(~in_train)).select("lang", "prediction", "probabilities", "votes"))
    cells = evaluation.confusion_cells(predicted, "lang")
    measures = evaluation.class_measures(cells)
    most = measures.agg(F.max("support").alias("most"))
    judged = evaluation.summary(measures).join(most).select(
        (F.col("accuracy") > F.col("most") / F.col("rows")).alias("beats_majority"), (F.col("accuracy") > 0.9).alias("learned"), F.col("classes").cast("int").alias("classes")
    )
    sums = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    sound = predicted.agg(F.bool_and((F.abs(sums - 1) < 1e-9) & (F.aggregate("votes", F.lit(0), lambda a, b: a + b) == model.trees)).alias("sound"))
    return parts.join(judged).join(sound).select("n_train", "n_test", F.lit(model.trees).alias("trees"), "classes", "beats_majority", "learned", "sound")


def predicted_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out documents with their source as ``label`` and the one that their nearest texts have."""
    name = F.concat_ws("/", F.lit("docs"), "source", F.col("doc_id").cast("string"))
    docs = read(spark, folder, "documents").select("doc_id", "source", name.alias("name"), "text")
    in_train: Column = tables.key_split(docs, "doc_id", SHARE)
    train = docs.where(in_train).select(F.col("name").alias("doc_id"), "text")
    fit = lambda path: saved.save(nn.TextClassifier.fit(train, texts.WORDS), path)
    fitted = saved.load(spark, fits.once(spark, folder, "documents", "source-classifier", fit), nn.TextClassifier)
    test = docs.where(~in_train)
    found = fitted.predict(test.select("doc_id", "text"), K, "letters")
    labels = test.select(F.col("doc_id").alias("query_id"), F.col("source").alias("actual"))
    return labels.join(found, "query_id").select(F.col("actual").alias("label"), F.col("label").alias("prediction"))


def saved_model(spark: SparkSession, folder: str) -> DataFrame:
    """Languages predicted for held-out documents by a forest, and whether the same forest saved and
    loaded gives the same probabilities to the last bit."""
    rows = store(letter_shares(spark, folder))
    in_train = tables.key_split(rows, "doc_id", SHARE)
    numeric = [c for c in rows.columns if c.startswith("share_")]
    model, path = forest.ForestClassifier.fit(rows.where(in_train), "lang", numeric, ["source"], trees=5), scratch_path(spark, "forest")
    saved.save(model, path)
    both = [m.predict(rows.where(~in_train)).select("doc_id", "prediction", "probabilities", "votes") for m in (model, saved.load(spark, path))]
    again = both[1].select(F.col("doc_id").alias("_doc_id"), F.struct("prediction", "probabilities", "votes").alias("again"))
    same = F.struct("prediction", "probabilities", "votes") == F.col("again")
    return both[0].join(again, F.col("doc_id") == F.col("_doc_id")).select("doc_id", same.alias("same"))


def confusion_table(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion_table(evaluation.confusion_cells(predicted_sources(spark, folder)))


def class_measures(spark: SparkSession, folder: str) -> DataFrame:
    measures = evaluation.class_measures(evaluation.confusion_cells(predicted_sources(spark, folder)))
    exact = [F.round(c, 8).alias(c) for c in ("precision", "recall", "fpr", "f")]
    return measures.select("class", "support", "predicted", "tp", "fp", "fn", *exact)


def multiclass_metrics(spark: SparkSession, folder: str) -> DataFrame:
    measures = evaluation.class_measures(evaluation.confusion_cells(predicted_sources(spark, folder)))
    row = evaluation.summary(measures)
    return row.select("classes", "rows", *(F.round(c, 8).alias(c) for c in row.columns[2:]))


QUERIES = {f.__name__: f for f in (category_index, one_hot_features, one_hot_layout, rf_classification, saved_model, confusion_table, class_measures, multiclass_metrics)}


def oracles() -> dict[str, str]:
    by_doc = f"('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::UBIGINT < {int(SHARE * 2**32)}"
    parts = f"""parts AS (
  SELECT p_partkey, CASE WHEN NOT starts_with(p_type, '{NO_TYPE}') THEN p_type END AS p_type, p_brand, p_size, p_retailprice FROM part)"""
    fitted = "".join(
        f""",
{c}_index AS (
  SELECT {c} AS value, (row_number() OVER (ORDER BY count(*) DESC, {c}) - 1)::INTEGER AS place
  FROM parts WHERE p_size < {SMALL} AND {c} IS NOT NULL GROUP BY {c})"""
        for c in GROUPS
    )
    place = lambda c: f"CASE WHEN {c} IS NULL THEN (SELECT count(*) FROM {c}_index) + 1 ELSE coalesce(place, (SELECT count(*) FROM {c}_index)) END"
    first = f"(SELECT count(*) + {len(NUMBERS) + 1} FROM p_type_index)"
    begins = dict(zip(GROUPS, (str(len(NUMBERS)), first)))
    blocks = " UNION ALL ".join(
        f"SELECT p_partkey, ({place(c)} + {begins[c]})::INTEGER AS rank, 1.0::DOUBLE AS value FROM parts LEFT JOIN {c}_index ON {c} = value"
        f" WHERE {c} IS NOT NULL"
        for c in GROUPS
    )
    numbers = " UNION ALL ".join(f"SELECT p_partkey, {k}::INTEGER, {c}::DOUBLE FROM parts WHERE {c} <> 0" for k, c in enumerate(NUMBERS))
    names = " UNION ALL ".join(
        [f"SELECT {k}::INTEGER AS rank, '{c}' AS column, NULL::VARCHAR AS value" for k, c in enumerate(NUMBERS)]
        + [f"SELECT (place + {begins[c]})::INTEGER, '{c}', value FROM {c}_index" for c in GROUPS]
        + [f"SELECT ((SELECT count(*) FROM {c}_index) + {begins[c]})::INTEGER, '{c}', '(unseen)'" for c in GROUPS]
    )
    named = "SELECT doc_id, concat_ws('/', 'docs', source, doc_id) AS name, source, text FROM documents"
    train = f"SELECT name AS doc_id, text FROM ({named}) WHERE {by_doc}"
    test = f"SELECT doc_id, text, source FROM ({named}) WHERE NOT ({by_doc})"
    cells = f"""WITH {texts.model_sql(train, texts.WORDS)},
asked AS MATERIALIZED ({texts.tfidf_sql(f"({texts.bag_sql(f'SELECT doc_id, text FROM ({test})')})")}),
dn AS (SELECT doc_id, sum(value * value) AS norm FROM tfidf GROUP BY doc_id),
qn AS (SELECT doc_id AS query_id, sum(value * value) AS norm FROM asked GROUP BY doc_id),
dots AS (
  SELECT a.doc_id AS query_id, t.doc_id, sum(a.value * t.value) AS dot FROM asked a JOIN tfidf t USING (rank) GROUP BY ALL),
pairs AS (
  SELECT query_id, doc_id, round(greatest(qn.norm + dn.norm - 2 * coalesce(dot, 0), 0), 10) AS squared
  FROM qn CROSS JOIN dn LEFT JOIN dots USING (query_id, doc_id)),
near AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY squared, doc_id) AS position FROM pairs QUALIFY position <= {K}),
votes AS (SELECT query_id, string_split(doc_id, '/')[2] AS label, count(*) AS votes, min(position) AS best FROM near GROUP BY ALL),
won AS (SELECT query_id, label FROM votes QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, best) = 1),
judged AS (SELECT t.source AS label, w.label AS prediction FROM ({test}) t LEFT JOIN won w ON w.query_id = t.doc_id),
cells AS MATERIALIZED (SELECT label, prediction, count(*) AS n FROM judged GROUP BY ALL),
classes AS MATERIALIZED (SELECT label AS class FROM cells UNION SELECT prediction FROM cells WHERE prediction IS NOT NULL),
measures AS MATERIALIZED (
  SELECT class, support, predicted, tp, predicted - tp AS fp, support - tp AS fn, tp / nullif(predicted, 0) AS precision, tp / nullif(support, 0) AS recall,
    (predicted - tp) / nullif(total - support, 0) AS fpr, coalesce(2 * tp / nullif(predicted + support, 0), 0) AS f
  FROM (SELECT class, (SELECT sum(n) FROM cells)::BIGINT AS total, coalesce((SELECT sum(n) FROM cells WHERE label = class), 0)::BIGINT AS support,
    coalesce((SELECT sum(n) FROM cells WHERE prediction = class), 0)::BIGINT AS predicted,
    coalesce((SELECT sum(n) FROM cells WHERE prediction = class AND label = class), 0)::BIGINT AS tp FROM classes))"""
    averages = ", ".join(
        [f"round(avg(coalesce({c}, 0)), 8) AS macro_{c}" for c in ("precision", "recall", "f")]
        + [f"round(sum(coalesce({c}, 0) * support) / sum(support), 8) AS weighted_{c}" for c in ("precision", "recall", "f", "fpr")]
    )
    return {
        "category_index": f"WITH {parts}{fitted} SELECT p_partkey, p_type, ({place('p_type')})::INTEGER AS place, value AS found FROM parts LEFT JOIN p_type_index ON p_type = value",
        "one_hot_features": f"WITH {parts}{fitted} {blocks} UNION ALL {numbers}",
        "one_hot_layout": f"WITH {parts}{fitted} {names}",
        "rf_classification": (
            f"SELECT count_if({by_doc})::BIGINT AS n_train, count_if(NOT {by_doc})::BIGINT AS n_test, {TREES}::INTEGER AS trees,"
            " count(DISTINCT lang)::INTEGER AS classes, TRUE AS beats_majority, TRUE AS learned, TRUE AS sound FROM documents"
        ),
        "saved_model": f"SELECT doc_id, TRUE AS same FROM documents WHERE NOT ({by_doc})",
        "confusion_table": cells
        + " SELECT a.class AS label, b.class AS prediction, coalesce(n, 0)::BIGINT AS n FROM classes a CROSS JOIN classes b"
        " LEFT JOIN cells ON label = a.class AND prediction = b.class UNION ALL SELECT label, NULL, n FROM cells WHERE prediction IS NULL",
        "class_measures": cells
        + " SELECT class, support, predicted, tp, fp, fn, round(precision, 8) AS precision, round(recall, 8) AS recall, round(fpr, 8) AS fpr, round(f, 8) AS f FROM measures",
        "multiclass_metrics": cells
        + " SELECT count(*) AS classes, sum(support)::BIGINT AS rows, round(sum(tp) / sum(support), 8) AS accuracy,"
        f" round(1 - sum(tp) / sum(support), 8) AS hamming_loss, {averages} FROM measures",
    }
