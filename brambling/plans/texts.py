"""Text features of ``documents``; ``conversations`` are the new documents of a fitted model."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brambling.functions.text import label_from_path, label_from_prefix
from brambling.operators import saved
from brambling.operators import text_features as tf
from brambling.plans import fits
from brambling.plans.tables import read
from brambling.session import scratch_path
from brambling.sources.lines import read_lines, write_lines
from brambling.sources.tagged import line_funnel, parse_documents, rejected_lines, tagged_line

WORDS = 20_000


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "documents").select("doc_id", "text")


def named_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with ids that carry the language, ``docs/<lang>/<number>``."""
    doc_id = F.concat_ws("/", F.lit("docs"), "lang", F.col("doc_id").cast("string"))
    return read(spark, folder, "documents").select(doc_id.alias("doc_id"), "text")


def new_documents(spark: SparkSession, folder: str) -> DataFrame:
    doc_id = F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return read(spark, folder, "conversations").select(doc_id.alias("doc_id"), "text")


def parse_doc_lines(spark: SparkSession, folder: str) -> DataFrame:
    return parse_documents(read_lines(spark, tagged_file(spark, folder)))


def parse_doc_lines_tight(spark: SparkSession, folder: str) -> DataFrame:
    """The same from lines whose text follows the tag without a blank."""
    return parse_documents(read_lines(spark, tagged_file(spark, folder, '">')), '">')


def damaged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Tagged lines of which one language each lacks the id, the mark of the text, and the end tag."""
    docs, lang = read(spark, folder, "documents"), F.col("lang")
    line = tagged_line(F.concat(F.lit("d"), F.col("doc_id").cast("string")), F.regexp_replace("text", '[<>"]', " "))
    cut = F.when(lang == "de", F.regexp_replace(line, 'id="', "")).when(lang == "es", F.regexp_replace(line, '"> ', " ")).when(lang == "fr", F.regexp_replace(line, " </doc>", ""))
    return docs.select(F.coalesce(cut, line).alias("value"))


def doc_line_funnel(spark: SparkSession, folder: str) -> DataFrame:
    return line_funnel(damaged_lines(spark, folder))


def rejected_doc_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = rejected_lines(damaged_lines(spark, folder))
    return lines.select(F.md5("value").alias("line"), "reason")


@cache
def tagged_file(spark: SparkSession, folder: str, mark: str = '"> ') -> str:
    """All documents as a file of tagged lines, written once per session."""
    path = scratch_path(spark, "documents")
    docs = named_documents(spark, folder)
    write_lines(docs.select(tagged_line(F.col("doc_id"), F.col("text"), mark).alias("value")), path)
    return path


def label_from_id(spark: SparkSession, folder: str) -> DataFrame:
    return named_documents(spark, folder).select(
        "doc_id",
        label_from_path("doc_id").alias("category"),
        label_from_prefix("doc_id", "docs/en").alias("is_english"),
    )


def tokenize(spark: SparkSession, folder: str) -> DataFrame:
    return tf.tokenize(documents(spark, folder)).select(
        "doc_id", F.size("words").alias("n_words"), F.array_join("words", " ").alias("words")
    )


def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return tf.word_counts(documents(spark, folder))


def dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return tf.top_words(tf.word_counts(documents(spark, folder)), WORDS)


def shared_model(spark: SparkSession, folder: str) -> tf.TextModel:
    """The text model of all documents, shared by the queries of a session."""
    fit = lambda path: saved.save(tf.fit_text_model(documents(spark, folder), WORDS), path)
    return saved.load(spark, fits.once(spark, folder, "documents", "text-model", fit), tf.TextModel)


def bags(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return tf.bags(docs, tf.fit_dictionary(docs, WORDS))


def bag_of_words(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return tf.bag_of_words(docs, tf.fit_dictionary(docs, WORDS))


def document_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return tf.document_frequency(bags(spark, folder))


def term_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return tf.term_frequency(bags(spark, folder)).withColumn("tf", F.round("tf", 9))


def rounded(rows: DataFrame) -> DataFrame:
    return tf.vector_rows(rows).withColumn("value", F.round("value", 8))


def idf(spark: SparkSession, folder: str) -> DataFrame:
    model = tf.fit_text_model(documents(spark, folder), WORDS)
    return model.idf.select("rank", F.round("idf", 8).alias("idf"))


def tfidf(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(tf.fit_transform(documents(spark, folder), WORDS)[1])


def tfidf_new_docs(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(shared_model(spark, folder).transform(new_documents(spark, folder)))


def doc_vector_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The vectors of the documents that ``labels`` marks as toxic."""
    wanted = read(spark, folder, "labels").where("toxic = 1")
    rows = tf.fit_transform(documents(spark, folder), WORDS)[1]
    return tf.non_zero_of(tf.vector_rows(rows), wanted).withColumn("value", F.round("value", 8))


QUERIES = {
    "parse_doc_lines": parse_doc_lines,
    "parse_doc_lines_tight": parse_doc_lines_tight,
    "doc_line_funnel": doc_line_funnel,
    "rejected_doc_lines": rejected_doc_lines,
    "label_from_id": label_from_id,
    "tokenize": tokenize,
    "word_count": word_count,
    "dictionary": dictionary,
    "bag_of_words": bag_of_words,
    "document_frequency": document_frequency,
    "term_frequency": term_frequency,
    "idf": idf,
    "tfidf": tfidf,
    "tfidf_new_docs": tfidf_new_docs,
    "doc_vector_lookup": doc_vector_lookup,
}

DOCS = "SELECT doc_id, text FROM documents"
NAMED = "SELECT concat_ws('/', 'docs', lang, doc_id) AS doc_id, text FROM documents"
NEW = "SELECT concat_ws('/', conv_id, turn) AS doc_id, text FROM conversations"


def tokens_sql(docs: str, tokenizer: str = "letters") -> str:
    if tokenizer == "whitespace":
        split = r"regexp_split_to_array(lower(text), '\s+')"
    else:
        split = "string_split(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')), ' ')"
    return f"SELECT doc_id, word FROM (SELECT doc_id, unnest({split}) AS word FROM ({docs})) WHERE word <> ''"


def dictionary_sql(docs: str, size: int) -> str:
    return (
        "SELECT word, (row_number() OVER (ORDER BY cnt DESC, word) - 1)::INTEGER AS rank, cnt FROM"
        f" (SELECT word, count(*) AS cnt FROM ({tokens_sql(docs)}) GROUP BY word ORDER BY cnt DESC, word LIMIT {size})"
    )


def bag_sql(docs: str, tokenizer: str = "letters") -> str:
    return (
        f"SELECT doc_id, rank, count(*) AS cnt FROM ({tokens_sql(docs, tokenizer)}) JOIN dict USING (word)"
        " GROUP BY doc_id, rank"
    )


def tfidf_sql(bag: str) -> str:
    return (
        "SELECT doc_id, rank, cnt / n * idf AS value FROM"
        f" (SELECT doc_id, rank, cnt, sum(cnt) OVER (PARTITION BY doc_id) AS n FROM {bag}) JOIN idf USING (rank)"
    )


def model_sql(docs: str, size: int) -> str:
    """CTEs ``docs``, ``dict``, ``bag``, ``idf`` and ``tfidf`` of a corpus."""
    return (
        f"docs AS MATERIALIZED ({docs}), dict AS MATERIALIZED ({dictionary_sql('SELECT * FROM docs', size)}),"
        f" bag AS MATERIALIZED ({bag_sql('SELECT * FROM docs')}),"
        " idf AS MATERIALIZED (SELECT rank, ln((SELECT count(*) FROM docs) / count(*)) AS idf FROM bag GROUP BY rank),"
        f" tfidf AS MATERIALIZED ({tfidf_sql('bag')})"
    )


def oracles() -> dict[str, str]:
    model = f"WITH {model_sql(DOCS, WORDS)} "
    flat = r"""regexp_replace(text, '[\r\n]', ' ', 'g')"""
    parsed = (
        f"WITH l AS (SELECT doc_id, {flat} AS t FROM ({NAMED}))"
        " SELECT doc_id, CASE WHEN contains(t, ' </doc>') THEN string_split(t, ' </doc>')[1] ELSE t END AS text FROM l"
    )
    lines = (
        "SELECT lang, CASE lang WHEN 'de' THEN replace(v, 'id=\"', '') WHEN 'es' THEN replace(v, '\"> ', ' ') WHEN 'fr' THEN replace(v, ' </doc>', '') ELSE v END AS v"
        " FROM (SELECT lang, '<doc id=\"d' || doc_id || '\" url=\"u\" title=\"t\"> ' || regexp_replace(regexp_replace(text, '[<>\"]', ' ', 'g'), '[\\r\\n]', ' ', 'g')"
        " || ' </doc>' AS v FROM documents)"
    )
    reason = "CASE lang WHEN 'de' THEN 'no id' WHEN 'es' THEN 'no text mark' WHEN 'fr' THEN 'no end tag' END"
    return {
        "doc_line_funnel": (
            "WITH n AS (SELECT count(*) AS n, count_if(lang = 'de') AS a, count_if(lang = 'es') AS b, count_if(lang = 'fr') AS c FROM documents)"
            " SELECT 0 AS step, NULL::VARCHAR AS reason, 0::BIGINT AS rejected, n::BIGINT AS kept FROM n"
            " UNION ALL SELECT 1, 'no id', a::BIGINT, (n - a)::BIGINT FROM n UNION ALL SELECT 2, 'no text mark', b::BIGINT, (n - a - b)::BIGINT FROM n"
            " UNION ALL SELECT 3, 'no end tag', c::BIGINT, (n - a - b - c)::BIGINT FROM n"
        ),
        "rejected_doc_lines": f"SELECT md5(v) AS line, {reason} AS reason FROM ({lines}) WHERE {reason} IS NOT NULL",
        "parse_doc_lines": parsed,
        "parse_doc_lines_tight": parsed,
        "label_from_id": f"SELECT doc_id, string_split(doc_id, '/')[2] AS category, starts_with(doc_id, 'docs/en')::INTEGER AS is_english FROM ({NAMED})",
        "tokenize": (
            "SELECT doc_id, len(w)::INTEGER AS n_words, array_to_string(w, ' ') AS words FROM (SELECT doc_id, list_filter("
            "string_split(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')), ' '), lambda x: x <> '') AS w FROM documents)"
        ),
        "word_count": f"SELECT word, count(*) AS cnt FROM ({tokens_sql(DOCS)}) GROUP BY word",
        "dictionary": dictionary_sql(DOCS, WORDS),
        "bag_of_words": model + "SELECT doc_id, rank, cnt FROM bag",
        "document_frequency": model + "SELECT rank, count(*) AS df FROM bag GROUP BY rank",
        "term_frequency": model
        + "SELECT doc_id, rank, cnt, n::BIGINT AS n_words, round(cnt / n, 9) AS tf FROM"
        " (SELECT *, sum(cnt) OVER (PARTITION BY doc_id) AS n FROM bag)",
        "idf": model + "SELECT rank, round(idf, 8) AS idf FROM idf",
        "tfidf": model + "SELECT doc_id, rank, round(value, 8) AS value FROM tfidf",
        "tfidf_new_docs": model + f"SELECT doc_id, rank, round(value, 8) AS value FROM ({tfidf_sql(f'({bag_sql(NEW)})')})",
        "doc_vector_lookup": model
        + "SELECT doc_id, rank, round(value, 8) AS value FROM tfidf"
        " WHERE value <> 0 AND doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    }
