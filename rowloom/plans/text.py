"""Text cleaning, terms, TF-IDF and vectors over documents and conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import text as X
from ..functions.cells import fixed_point, prefix, strip
from ..functions.encoders import one_hot_name_column
from ..functions.naming import feature_type
from ..functions.sparse import entries
from ..operators import tfidf, vectors
from ..sources.artifacts import load_vectors
from ..sources.session import materialize, new_path
from ..sources.tables import FeatureChoice, join_blocks, spread, store_blocks
from .base import documents, sql_clean, sql_grams, sql_hash, sql_words, table

CLEAN = sql_clean("text")

# --- cleaning and tokens ----------------------------------------------------


def clean_text(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "text").select("doc_id", X.clean_text("text").alias("cleaned"))


def tokenize_fields(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "text", "lang", "source")
    listed = F.concat_ws("|", "lang", "source", F.lit(" "), "text")
    fields = F.array(*[
        F.struct(F.lit(name).alias("field"), X.field_words(c, name).alias("tokens"))
        for name, c in (("description", F.col("text")), ("all_skills", listed))
    ])
    rows = docs.select("doc_id", F.inline_outer(fields))
    return rows.select(
        "doc_id", "field", F.size("tokens").cast("bigint").alias("n_tokens"),
        F.array_join("tokens", " ").alias("tokens"),
    )


def fixed_point_export(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "n_chars").select("doc_id", fixed_point(F.col("n_chars") / 8, 6).alias("eighth"))


def ngrams(spark: SparkSession, folder: str) -> DataFrame:
    docs = tfidf.with_terms(documents(spark, folder, "text"), "text", "description", "terms", "A")
    return docs.select("doc_id", F.array_join("terms", "|").alias("terms"))


def first_words(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "text").select(
        "doc_id", X.first_words(X.clean_text("text")).alias("first_words")
    )


def concat_text(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "text", "lang", "source")
    return docs.select(
        "doc_id", X.joined_fields("source", "text", "lang").alias("joined"),
        F.length(strip("text")).cast("bigint").alias("stripped_length"),
        prefix("text", 60).alias("title"),
        (F.col("text").contains("the") & ~F.col("text").startswith("The") & ~F.col("text").endswith(".")).alias("open_end"),
    )


# --- TF-IDF -----------------------------------------------------------------


def tfidf_vocab(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder, "text")
    settings = tfidf.term_settings("description")
    words = docs.select(tfidf.field_tokens("text", "description").alias("words"))
    found = tfidf.vocabulary(words, "words", docs.count(), **settings)
    return found.select("term", "cf", "df", F.round("idf", 6).alias("idf"))


def tfidf_weights_raw(spark: SparkSession, folder: str) -> DataFrame:
    docs, model = tfidf.fit_field(documents(spark, folder, "text"), "text", "description")
    return model.long(docs, "doc_id").select("doc_id", "term", F.round("weight", 6).alias("weight"))


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    turns = spread(table(spark, folder, "conversations"))
    return turns.select((F.col("conv_id") * 100_000 + F.col("turn")).alias("row_id"), "text")


def tfidf_weights_sublinear(spark: SparkSession, folder: str) -> DataFrame:
    turns, model = tfidf.fit_field(_turns(spark, folder), "text", "title", "A")
    return model.long(turns, "row_id").select("row_id", "term", F.round("weight", 6).alias("weight"))


def leading_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of each row among the first five vocabulary terms, ranked within the row."""
    turns, model = tfidf.fit_field(_turns(spark, folder), "text", "title", "A")
    scores = model.long(turns, "row_id").filter(F.col("term").isin(model.vocabulary[:5]))
    order = Window.partitionBy("row_id").orderBy(F.desc(F.round("weight", 6)), "term")
    return scores.select(
        "row_id", "term", F.round("weight", 6).alias("weight"),
        F.row_number().over(order).cast("bigint").alias("rank"),
    )


def _sql_tfidf(rows: str, key: str, shortest: int, features: int, min_df: int, sublinear: bool, longest: int = 2) -> str:
    tf = "1 + ln(tf)" if sublinear else "tf"
    return f"""
rows_ AS ({rows}),
tok AS (SELECT {key}, {sql_words(sql_clean('text'), shortest)} AS t FROM rows_),
gram AS (SELECT {key}, unnest({sql_grams('t') if longest > 1 else 't'}) AS term FROM tok),
tfs AS (SELECT {key}, term, count(*) AS tf FROM gram GROUP BY ALL),
size_ AS (SELECT count(*) AS n FROM rows_),
vocab AS (
  SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df,
         ln((1.0::DOUBLE + any_value(n)) / (1 + count(*))) + 1 AS idf
  FROM tfs, size_ GROUP BY term
  HAVING count(*) >= {min_df} AND count(*) <= 0.95::DOUBLE * any_value(n)
  ORDER BY cf DESC, term LIMIT {features}),
raw AS (SELECT {key}, term, ({tf}) * idf AS w FROM tfs JOIN vocab USING (term)),
weights AS (SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM raw)
"""


SQL_DOCS = _sql_tfidf("SELECT doc_id, text FROM documents", "doc_id", 1, 100, 5, False)
SQL_TURNS = _sql_tfidf(
    "SELECT conv_id * 100000 + turn AS row_id, text FROM conversations", "row_id", 2, 50, 5, True
)

# --- vectors ----------------------------------------------------------------

SIZE = 64


def _word_vectors(spark: SparkSession, folder: str, docs: DataFrame) -> DataFrame:
    """A (word, vec) table: three of four words of the corpus own one of the given vectors."""
    given = table(spark, folder, "embeddings").select("vec_id", "embedding")
    code = F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint")
    corpus = docs.select(F.explode_outer("words").alias("word")).filter(F.col("word").isNotNull())
    known = corpus.distinct().withColumn("code", code).filter(F.col("code") % 4 != 0)
    ids = known.withColumn("vec_id", F.col("code") % given.count())
    found = ids.join(given, "vec_id").select("word", F.col("embedding").cast("array<double>").alias("vec"))
    return materialize(found, "word-vectors")


def word_vector_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors are stored and loaded again, as given ones are; words without one are tried in lower case."""
    docs = documents(spark, folder, "text").select("doc_id", X.words(X.clean_text("text")).alias("words"))
    path = new_path(spark, "word-vectors")
    _word_vectors(spark, folder, docs).write.parquet(path)
    loaded, width = load_vectors(spark, path)
    pooled = vectors.pool_words(docs, "doc_id", "words", loaded, width, retry_lower=True)
    return vectors.long_vectors(pooled, "doc_id", "vector").select(
        "doc_id", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value")
    )


def _sql_mean(text: str) -> str:
    """Mean word vectors of a text expression; the vectors belong to the words of whole texts."""
    return f"""
SELECT doc_id, dim, sum(tf * v) / sum(tf) AS m FROM (
  SELECT doc_id, tf, unnest(range(0, {SIZE})) AS dim, unnest(embedding)::DOUBLE AS v
  FROM (SELECT doc_id, word, count(*) AS tf
        FROM (SELECT doc_id, unnest({sql_words(sql_clean(text))}) AS word FROM documents) GROUP BY ALL)
  JOIN (SELECT word, embedding FROM (
          SELECT word, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) AS c
          FROM (SELECT DISTINCT unnest({sql_words(CLEAN)}) AS word FROM documents)),
        (SELECT count(*) AS n FROM embeddings) JOIN embeddings ON vec_id = c % n WHERE c % 4 <> 0) USING (word))
GROUP BY ALL"""


SQL_MEAN = f"""
SELECT d.doc_id, g.dim, round(coalesce(m, 0), 6) AS value
FROM (SELECT doc_id FROM documents) d, (SELECT unnest(range(0, {SIZE})) AS dim) g
LEFT JOIN ({_sql_mean("text")}) p ON p.doc_id = d.doc_id AND p.dim = g.dim
"""


def vector_expand(spark: SparkSession, folder: str) -> DataFrame:
    """Attach the given vectors to documents by key and write one column per component."""
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    given = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("emb"))
    joined = vectors.attach_vectors(docs, given, "doc_id", "emb", SIZE)
    return vectors.expand(joined, "emb", [f"desc_emb_{i}" for i in range(SIZE)], 6)


SQL_EXPAND = "SELECT doc_id, lang, " + ", ".join(
    f"round(coalesce(embedding[{i + 1}]::DOUBLE, 0), 6) AS desc_emb_{i}" for i in range(SIZE)
) + " FROM documents LEFT JOIN embeddings ON vec_id = doc_id"


def feature_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Both blocks as whole vectors of all documents, zeros where a document has none, measured in one pass."""
    docs, model = tfidf.fit_field(documents(spark, folder, "text"), "text", "description")
    given = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("emb"))
    joined = vectors.attach_vectors(model.transform(docs).select("doc_id", "description_tfidf"), given, "doc_id", "emb", SIZE)
    held = joined.select("description_tfidf", vectors.array_to_vector("emb").alias("emb"))
    found = vectors.vector_quality(held, {("description", "tfidf"): "description_tfidf", ("description", "w2v"): "emb"})
    return found.select("field", "block", "columns", *[F.round(c, 6).alias(c) for c in ("mean", "std", "non_zero_percent")])


SQL_QUALITY = f"""
WITH {SQL_DOCS},
cell AS (
  SELECT 'tfidf' AS block, coalesce(weight, 0) AS v
  FROM (SELECT doc_id, term FROM rows_, vocab) LEFT JOIN weights USING (doc_id, term)
  UNION ALL
  SELECT 'w2v', coalesce(embedding[d]::DOUBLE, 0)
  FROM rows_ LEFT JOIN embeddings ON vec_id = doc_id, (SELECT unnest(range(1, {SIZE + 1})) AS d))
SELECT 'description' AS field, block,
       CASE block WHEN 'tfidf' THEN (SELECT count(*) FROM vocab) ELSE {SIZE} END::BIGINT AS columns,
       round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std,
       round(100.0::DOUBLE * count(*) FILTER (v <> 0) / count(*), 6) AS non_zero_percent
FROM cell GROUP BY block
"""


def feature_types(spark: SparkSession, folder: str) -> DataFrame:
    """Number of features of each type, from the names of the features the tables give."""
    docs, model = tfidf.fit_field(documents(spark, folder, "text"), "text", "description")
    segments = table(spark, folder, "customer").select(one_hot_name_column("company_size", "c_mktsegment").alias("name"))
    types = table(spark, folder, "events").select(F.concat("event_type", F.lit("_frequency")).alias("name"))
    flags = table(spark, folder, "lineitem").select(F.concat("l_returnflag", F.lit("_binary")).alias("name"))
    levels = table(spark, folder, "orders").select(F.concat("o_orderpriority", F.lit("_ordinal")).alias("name"))
    brands = table(spark, folder, "part").select(F.col("p_brand").alias("name"))
    names = spark.createDataFrame([(n,) for n in model.names("description")], "name STRING")
    for part in (segments, types, flags, levels, brands):
        names = names.unionByName(part.distinct())
    return names.groupBy(feature_type("name").alias("feature_type")).agg(F.count(F.lit(1)).alias("n"))


SQL_TYPES = f"""
WITH {SQL_DOCS},
names AS (
  SELECT 'description_tfidf_' || term AS name FROM vocab
  UNION SELECT 'company_size_' || replace(replace(c_mktsegment, ' ', '_'), '-', '_') FROM customer
  UNION SELECT event_type || '_frequency' FROM events
  UNION SELECT l_returnflag || '_binary' FROM lineitem
  UNION SELECT o_orderpriority || '_ordinal' FROM orders
  UNION SELECT p_brand FROM part)
SELECT CASE WHEN contains(name, '_tfidf_') THEN 'TF-IDF' WHEN contains(name, '_w2v_') THEN 'Word2Vec'
            WHEN ends_with(name, '_ordinal') THEN 'Ordinal' WHEN starts_with(name, 'company_size_') THEN 'One-Hot'
            WHEN contains(name, '_frequency') THEN 'Frequency' WHEN contains(name, '_binary') THEN 'Binary'
            ELSE 'Other Numeric' END AS feature_type, count(*) AS n
FROM names GROUP BY 1
"""


def batch_embed(spark: SparkSession, folder: str) -> DataFrame:
    """Hashed vectors of the first words of every document."""
    words = X.words(X.first_words(X.clean_text("text")))
    docs = documents(spark, folder, "text").select("doc_id", words.alias("words"))
    return vectors.hashed_words(docs, "doc_id", "words", SIZE).select("doc_id", "dim", F.round("value", 6).alias("value"))


def word2vec_fit(spark: SparkSession, folder: str) -> DataFrame:
    """All passes of the production settings, over words that are split once."""
    docs = materialize(documents(spark, folder, "text").select(X.raw_words("text").alias("words")), "words")
    return vectors.vector_table(vectors.fit_word_vectors(docs, "words")).select(
        "word", F.size("vec").cast("bigint").alias("size")
    )


# The six text fields, made of the columns of documents: how Spark builds them, and their words in SQL.
_FIELDS = {
    "description": (F.col, ("text",), "text"),
    "title": (F.concat_ws, (" ", "source", "lang", "text"), "source || ' ' || lang || ' ' || text"),
    "all_skills": (F.concat_ws, ("|", "lang", "source"), "lang || ' ' || source"),
    "description_company": (F.concat_ws, (" ", "text", "source"), "text || ' ' || source"),
    "all_industries": (F.concat_ws, ("|", "source", "lang", "lang"), "source || ' ' || lang || ' ' || lang"),
    "benefits_list": (F.concat_ws, ("| ", "source", "lang", "source"), "source || ' ' || lang || ' ' || source"),
}


def hybrid_features(spark: SparkSession, folder: str) -> DataFrame:
    """The non-zero features of all six fields: TF-IDF weights and mean word vectors side by side."""
    docs = documents(spark, folder, "text", "lang", "source")
    docs = docs.select("doc_id", "text", *[make(*args).alias(f"{name}_") for name, (make, args, _) in _FIELDS.items()])
    held = docs.select("doc_id", X.words(X.clean_text("text")).alias("words"))
    found, names = vectors.hybrid_features(
        docs, "doc_id", {name: f"{name}_" for name in _FIELDS}, _word_vectors(spark, folder, held), SIZE
    )
    cells = found.select("doc_id", F.inline_outer(entries("features")))
    value = F.round("value", 6)
    return cells.filter(value != 0).select("doc_id", F.lit(names)[F.col("index")].alias("feature"), value.alias("value"))


def _sql_field(name: str) -> str:
    features, least, _, longest = fixed.TRACK_B_TERMS[name]
    return _sql_tfidf(f"SELECT doc_id, {_FIELDS[name][2]} AS text FROM documents", "doc_id", 1, features, least, False, longest)


SQL_HYBRID = " UNION ALL ".join(
    f"SELECT doc_id, '{name}_' || f AS feature, round(v, 6) AS value FROM ({rows}) WHERE round(v, 6) <> 0"
    for name in _FIELDS for rows in (
        f"WITH {_sql_field(name)} SELECT doc_id, 'tfidf_' || term AS f, weight AS v FROM weights",
        f"SELECT doc_id, 'w2v_' || dim AS f, m AS v FROM ({_sql_mean(_FIELDS[name][2])})",
    )
)


def feature_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Five feature blocks, stored by buckets of the document, joined without moving a row; what each gives a document."""
    docs = documents(spark, folder, "text", "lang", "source")
    docs = docs.select("doc_id", "text", *[_FIELDS[n][0](*_FIELDS[n][1]).alias(n) for n in ("title", "all_skills")])
    blocks = {}
    for name, field in (("title_terms", "title"), ("description_terms", "description"), ("skills_terms", "all_skills")):
        held, model = tfidf.fit_field(docs, "text" if field == "description" else field, field)
        blocks[name] = model.transform(held).select("doc_id", F.col(f"{field}_tfidf").alias(name))
    words = docs.select("doc_id", X.words(X.clean_text("text")).alias("words"))
    pooled = vectors.pool_words(words, "doc_id", "words", _word_vectors(spark, folder, words), SIZE)
    blocks["description_vectors"] = pooled.select("doc_id", vectors.array_to_vector("vector").alias("description_vectors"))
    given = table(spark, folder, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("v"))
    given = vectors.attach_vectors(docs.select("doc_id"), given, "doc_id", "v", SIZE)
    blocks["title_vectors"] = given.select("doc_id", vectors.array_to_vector("v").alias("title_vectors"))
    stored = store_blocks(spark, {"base": docs.select("doc_id"), **blocks}, "doc_id")
    joined = join_blocks(stored.pop("base"), stored, FeatureChoice(), "doc_id")

    def figures(name: str) -> Column:
        values = F.transform(entries(name), lambda e: F.round(e["value"], 6))
        used = F.filter(values, lambda v: v != 0)
        return F.struct(F.lit(name).alias("block"), F.size(used).cast("long").alias("non_zero"), F.aggregate(
            used, F.lit(0.0), lambda a, v: a + v).alias("total"))

    found = joined.select("doc_id", F.inline(F.array(*[figures(n) for n in FeatureChoice().blocks()])))
    return found.withColumn("total", F.round("total", 4))


SQL_BLOCKS = "SELECT doc_id, block, count(v)::BIGINT AS non_zero, round(coalesce(sum(v), 0), 4) AS total FROM (" + " UNION ALL ".join(
    f"SELECT d.doc_id, '{name}' AS block, nullif(round(v, 6), 0) AS v FROM documents d LEFT JOIN ({rows}) r ON r.doc_id = d.doc_id"
    for name, rows in (
        *((f"{n}_terms", f"WITH {_sql_field(f)} SELECT doc_id, weight AS v FROM weights") for n, f in (
            ("title", "title"), ("description", "description"), ("skills", "all_skills"))),
        ("title_vectors", "SELECT vec_id AS doc_id, unnest(embedding)::DOUBLE AS v FROM embeddings"),
        ("description_vectors", f"SELECT doc_id, m AS v FROM ({_sql_mean('text')})"),
    )
) + ") GROUP BY ALL"


QUERIES = {
    "clean_text": clean_text,
    "tokenize_fields": tokenize_fields,
    "fixed_point_export": fixed_point_export,
    "ngrams": ngrams,
    "first_words": first_words,
    "concat_text": concat_text,
    "tfidf_vocab": tfidf_vocab,
    "tfidf_weights_raw": tfidf_weights_raw,
    "tfidf_weights_sublinear": tfidf_weights_sublinear,
    "leading_terms": leading_terms,
    "word_vector_mean": word_vector_mean,
    "vector_expand": vector_expand,
    "feature_quality": feature_quality,
    "feature_types": feature_types,
    "batch_embed": batch_embed,
    "word2vec_fit": word2vec_fit,
    "hybrid_features": hybrid_features,
    "feature_blocks": feature_blocks,
}

_ITEM = sql_clean("trim(i)")
SQL = {
    "clean_text": f"SELECT doc_id, {CLEAN} AS cleaned FROM documents",
    "tokenize_fields": f"""
WITH f AS (
  SELECT doc_id, 'description' AS field, {sql_words(CLEAN)} AS t FROM documents
  UNION ALL
  SELECT doc_id, 'all_skills', {sql_words("array_to_string(list_transform(string_split(concat_ws('|', lang, source, ' ', text), '|'), lambda i: " + _ITEM + "), ' ')")}
  FROM documents)
SELECT doc_id, field, len(t)::BIGINT AS n_tokens, array_to_string(t, ' ') AS tokens FROM f""",
    "fixed_point_export": "SELECT doc_id, printf('%.6f', n_chars / 8.0::DOUBLE) AS eighth FROM documents",
    "ngrams": f"""
WITH tok AS (SELECT doc_id, {sql_words(CLEAN, 2)} AS t FROM documents)
SELECT doc_id, array_to_string({sql_grams('t')}, '|') AS terms FROM tok""",
    "first_words": f"""
SELECT doc_id, array_to_string(list_slice({sql_words(CLEAN)}, 1, 500), ' ') AS first_words FROM documents""",
    "concat_text": r"""
SELECT doc_id, source || ' ' || text || ' ' || lang AS joined,
       length(regexp_replace(regexp_replace(text, '^[\s\p{Z}]+', ''), '[\s\p{Z}]+$', ''))::BIGINT AS stripped_length,
       left(text, 60) AS title,
       contains(text, 'the') AND NOT starts_with(text, 'The') AND NOT ends_with(text, '.') AS open_end
FROM documents""",
    "tfidf_vocab": f"WITH {SQL_DOCS} SELECT term, cf, df, round(idf, 6) AS idf FROM vocab",
    "tfidf_weights_raw": f"WITH {SQL_DOCS} SELECT doc_id, term, round(weight, 6) AS weight FROM weights",
    "tfidf_weights_sublinear": f"WITH {SQL_TURNS} SELECT row_id, term, round(weight, 6) AS weight FROM weights",
    "leading_terms": f"""
WITH {SQL_TURNS}
SELECT row_id, term, round(weight, 6) AS weight,
       row_number() OVER (PARTITION BY row_id ORDER BY round(weight, 6) DESC, term) AS rank
FROM weights WHERE term IN (SELECT term FROM vocab ORDER BY term LIMIT 5)""",
    "word_vector_mean": SQL_MEAN,
    "vector_expand": SQL_EXPAND,
    "feature_quality": SQL_QUALITY,
    "feature_types": SQL_TYPES,
    "batch_embed": f"""
WITH w AS (SELECT doc_id, unnest(list_slice({sql_words(CLEAN)}, 1, 500)) AS word FROM documents),
c AS (SELECT doc_id, {sql_hash('word')} AS code FROM w),
n AS (SELECT doc_id, code % {SIZE} AS dim, sum(CASE WHEN code // {SIZE} % 2 = 0 THEN 1 ELSE -1 END) AS n FROM c GROUP BY ALL)
SELECT doc_id, dim, round(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)), 6) AS value FROM n WHERE n <> 0""",
    "hybrid_features": SQL_HYBRID,
    "feature_blocks": SQL_BLOCKS,
    "word2vec_fit": r"""
SELECT word, 100::BIGINT AS size
FROM (SELECT unnest(string_split_regex(text, '[\s\x0b]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word HAVING count(*) >= 5""",
}
