"""Targets, missing values, encoders, validation, projection and merging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import encoders as E
from ..functions import target as target_functions
from ..functions.cells import number_or_zero, strip, to_double, to_double_or_zero
from ..functions.naming import feature_columns, select_names, table_column_type
from ..functions.sparse import entries
from ..operators import encode, missing, order_stats, profile, project, validate
from ..sources.session import new_path
from ..sources.tables import read_csv, write_csv
from .base import SQL_ORDER_FACTS, documents, order_facts, sql_clean, sql_number, table

# --- target -----------------------------------------------------------------


def _bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Textual price bounds per part: some absent, some zero, some not numbers."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    per_part = table(spark, folder, "lineitem").groupBy("l_partkey").agg(
        F.floor(F.min("l_extendedprice")).alias("lo"), F.floor(F.max("l_extendedprice")).alias("hi"),
        F.expr("sum(CAST(round(l_extendedprice * 100) AS BIGINT)) div (count(*) * 100)").alias("mid"),
    )
    k = F.col("l_partkey")
    return per_part.select(
        "l_partkey",
        F.when(k % 11 == 0, "n/a").when(k % 5 == 0, None).when(k % 7 == 0, "0")
        .otherwise(F.col("lo").cast("string")).alias("salary_yearly_min"),
        F.when(k % 3 == 0, "").when(k % 13 == 0, "0")
        .otherwise(F.col("hi").cast("string")).alias("salary_yearly_max"),
        F.when(k % 2 == 0, None).when(k % 17 == 0, "999")
        .otherwise(F.col("mid").cast("string")).alias("salary_yearly_med"),
    )


SQL_BOUNDS = f"""
raw AS (
  SELECT l_partkey, CAST(floor(min(l_extendedprice)) AS BIGINT) AS lo, CAST(floor(max(l_extendedprice)) AS BIGINT) AS hi,
         CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) // (count(*) * 100) AS mid
  FROM lineitem GROUP BY l_partkey),
bounds AS (
  SELECT l_partkey,
    CASE WHEN l_partkey % 11 = 0 THEN 'n/a' WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 7 = 0 THEN '0' ELSE lo::VARCHAR END AS tmin,
    CASE WHEN l_partkey % 3 = 0 THEN '' WHEN l_partkey % 13 = 0 THEN '0' ELSE hi::VARCHAR END AS tmax,
    CASE WHEN l_partkey % 2 = 0 THEN NULL WHEN l_partkey % 17 = 0 THEN '999' ELSE mid::VARCHAR END AS tmed
  FROM raw),
num AS (
  SELECT *, nullif({sql_number('tmin')}, 0) AS a, nullif({sql_number('tmax')}, 0) AS b, {sql_number('tmed')} AS m FROM bounds),
target AS (
  SELECT l_partkey, tmin, tmax, m,
    round(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN (a + b) / 2 WHEN m >= 1000 THEN m
               WHEN a IS NOT NULL THEN a * 1.15::DOUBLE WHEN b IS NOT NULL THEN b * 0.85::DOUBLE END, 2) AS salary_normalized
  FROM num),
labelled AS (
  SELECT *, CASE WHEN coalesce(salary_normalized, 0) = 0 THEN 'invalid'
    WHEN coalesce(tmin, '') <> '' AND coalesce(tmax, '') <> '' THEN 'min_max'
    WHEN m >= 1000 THEN 'median' WHEN coalesce(tmin, '') <> '' THEN 'min_only' ELSE 'max_only' END AS source
  FROM target)
"""


def target_normalized(spark: SparkSession, folder: str) -> DataFrame:
    found = project.add_target(_bounds(spark, folder))
    return found.select("l_partkey", fixed.TARGET, target_functions.target_source(*fixed.TARGET_BOUNDS).alias("source"))


def target_source_counts(spark: SparkSession, folder: str) -> DataFrame:
    named = _bounds(spark, folder).select(target_functions.target_source(*fixed.TARGET_BOUNDS).alias("source"))
    return profile.value_shares(named, "source").select(
        F.col("value").alias("source"), "count", F.round("percent", 6).alias("percent")
    )


def target_summary(spark: SparkSession, folder: str) -> DataFrame:
    kept = project.with_value(project.add_target(_bounds(spark, folder)), fixed.TARGET)
    found = profile.target_summary(kept, fixed.TARGET)
    return found.select("n", *[F.round(c, 4).alias(c) for c in ("min", "p25", "p50", "p75", "max", "mean")])


def target_stats(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.target_stats(table(spark, folder, "orders"), "o_totalprice")
    return found.select("n", *[F.round(c, 4).alias(c) for c in ("min", "max", "mean", "median", "std")])


def annualize(spark: SparkSession, folder: str) -> DataFrame:
    period = (
        F.when(F.col("event_type") == "view", "hourly").when(F.col("event_type") == "purchase", "MONTHLY")
        .when(F.col("event_type") == "signup", "WEEKLY").when(F.col("event_type") == "click", "YEARLY")
        .otherwise("DAILY")
    )
    return table(spark, folder, "events").select(
        "event_id", F.round(target_functions.yearly_amount("value", period), 4).alias("yearly")
    )


def outlier_filter(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").join(
        table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal"), "o_custkey"
    ).withColumn("low", F.col("c_acctbal") * 50)
    kept = target_functions.plausible_pay(orders, "o_totalprice", "low", "o_totalprice")
    return kept.select("o_orderkey", "o_totalprice")


# --- missing values ---------------------------------------------------------


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with optional labels, under the column names the imputer knows."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    joined = docs.join(table(spark, folder, "labels"), "doc_id", "left")
    return joined.select(
        F.col("doc_id").alias("row_id"),
        F.col("quality").alias("views"),
        F.col("n_chars").alias("applies_raw"),
        F.when(F.col("n_chars") % 4 == 0, None).otherwise(F.col("n_chars")).alias("applies"),
        F.when(F.col("toxic") == 0, "1.0").alias("remote_allowed"),
        F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("state"),
        F.when(F.col("n_chars") % 7 == 0, "").otherwise(F.col("source")).alias("company_name"),
        F.when((F.col("toxic") == 1) & (F.col("quality") == 1), "y").alias("skills_desc"),
    )


SQL_LABELLED = """
base AS (
  SELECT d.doc_id AS row_id, quality AS views, n_chars AS applies_raw,
    CASE WHEN n_chars % 4 = 0 THEN NULL ELSE n_chars END AS applies,
    CASE WHEN toxic = 0 THEN '1.0' END AS remote_allowed,
    CASE WHEN lang = 'en' THEN '' ELSE lang END AS state,
    CASE WHEN n_chars % 7 = 0 THEN '' ELSE source END AS company_name,
    CASE WHEN toxic = 1 AND quality = 1 THEN 'y' END AS skills_desc
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
missing_ AS (
  SELECT unnest(['views', 'applies', 'remote_allowed', 'state', 'company_name', 'skills_desc']) AS "column",
    unnest([count(*) FILTER (views IS NULL), count(*) FILTER (applies IS NULL),
      count(*) FILTER (coalesce(remote_allowed, '') = ''), count(*) FILTER (coalesce(state, '') = ''),
      count(*) FILTER (coalesce(company_name, '') = ''), count(*) FILTER (coalesce(skills_desc, '') = '')]) AS missing,
    count(*) AS n
  FROM base)
"""


def missing_profile(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.missing_profile(_labelled(spark, folder))
    return found.select("column", "missing", F.round("percent", 6).alias("percent"))


def missing_tiers(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.missing_profile(_labelled(spark, folder)).orderBy(F.desc("percent"), "column")
    return found.select("column", profile.tier("percent").alias("tier"))


def completeness(spark: SparkSession, folder: str) -> DataFrame:
    roles = {
        "text": ["company_name", "skills_desc"], "categorical": ["state", "remote_allowed"],
        "numerical": ["views", "applies"],
    }
    found = profile.completeness(_labelled(spark, folder), roles)
    return found.select("role", "column", F.round("complete_percent", 6).alias("complete_percent"), "distinct_values")


def _filled(spark: SparkSession, folder: str):
    base = _labelled(spark, folder).drop("applies_raw")
    return base, missing.MissingValues().fit(base)


def missing_indicators(spark: SparkSession, folder: str) -> DataFrame:
    base, model = _filled(spark, folder)
    found = missing.indicator_sums(model.transform(base))
    return found.select("column", "missing", F.round("percent", 6).alias("percent"))


def impute(spark: SparkSession, folder: str) -> DataFrame:
    base, model = _filled(spark, folder)
    return model.transform(base).select(
        "row_id", F.col("views").cast("double").alias("views"), F.col("applies").cast("double").alias("applies"),
        "remote_allowed", "state", "company_name",
    )


def impute_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Values filled per column, and what is still missing afterwards."""
    base, model = _filled(spark, folder)
    filled = model.filled_counts(base).select(
        F.lit("filled").alias("what"), "column", F.col("filled").alias("values")
    )
    after = model.transform(base).withColumn("untouched", F.when(F.col("row_id") % 3 == 0, F.lit("x")))
    left = missing.still_missing(after).select(F.lit("left").alias("what"), "column", F.col("missing").alias("values"))
    return filled.unionByName(left)


def modes(spark: SparkSession, folder: str) -> DataFrame:
    return profile.modes(_labelled(spark, folder), ["state", "remote_allowed", "company_name"], "row_id")


# --- encoders ---------------------------------------------------------------


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    """Order facts dressed as the categorical columns of the model table."""
    n = F.col("c_nationkey")
    return order_facts(spark, folder).select(
        "o_orderkey", F.col("o_totalprice").alias("salary_normalized"), F.lit("USD").alias("currency"),
        F.col("c_name").alias("title"), "c_custkey",
        F.when(F.col("o_orderpriority") == "1-URGENT", "Director")
        .when(F.col("o_orderpriority") == "2-HIGH", "Associate Director")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Mid-Senior level")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "  Entry level ")
        .otherwise("VP").alias("formatted_experience_level"),
        F.when(F.col("c_mktsegment") == "MACHINERY", " ").otherwise(F.concat(F.col("c_mktsegment"), F.lit("-job x")))
        .alias("formatted_work_type"),
        F.col("o_orderstatus").alias("company_size"),
        F.when(n % 5 == 0, "").otherwise(F.col("n_name")).alias("city"),
        F.when(n % 6 == 0, "California").when(n % 6 == 1, " ca ").when(n % 6 == 2, "0").when(n % 6 == 3, "")
        .when(n % 6 == 4, "Ontario").otherwise("West Virginia").alias("state"),
        F.when(F.col("r_name") == "AMERICA", " us ").when(F.col("r_name") == "ASIA", "USA")
        .when(F.col("r_name") == "EUROPE", None).otherwise("US").alias("country"),
    )


SQL_POSTINGS = f"""
facts AS ({SQL_ORDER_FACTS}),
post AS (
  SELECT o_orderkey, o_totalprice AS salary_normalized, c_custkey,
    CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
      WHEN '4-NOT SPECIFIED' THEN 1 ELSE -1 END::INTEGER AS level,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'missing' ELSE c_mktsegment || '_job_x' END AS work,
    o_orderstatus AS size_,
    CASE WHEN c_nationkey % 5 = 0 THEN 'missing' ELSE n_name END AS city,
    CASE c_nationkey % 6 WHEN 0 THEN 'CA' WHEN 1 THEN 'CA' WHEN 2 THEN 'missing' WHEN 3 THEN 'missing'
      WHEN 4 THEN 'Ontario' ELSE 'WV' END AS state,
    CASE WHEN r_name IN ('AMERICA', 'AFRICA', 'MIDDLE EAST') THEN 1 ELSE 0 END::INTEGER AS us
  FROM facts)
"""


def ordinal(spark: SparkSession, folder: str) -> DataFrame:
    code = E.ordinal_code("formatted_experience_level", fixed.EXPERIENCE_SCALE)
    return _postings(spark, folder).select("o_orderkey", code.alias("level"))


def ordinal_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return ordinal(spark, folder).groupBy("level").agg(F.count(F.lit(1)).alias("n")).orderBy("level")


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    post = _postings(spark, folder)
    return post.select("o_orderkey", *encode.one_hot_columns(post, "company_size"))


def one_hot_long(spark: SparkSession, folder: str) -> DataFrame:
    return encode.one_hot_long(_postings(spark, folder), "o_orderkey", "formatted_work_type")


def frequency(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode.frequency_encode(_postings(spark, folder), E.category("city"), "city_frequency")
    return coded.select("o_orderkey", F.round("city_frequency", 6).alias("city_frequency"))


def frequency_counts(spark: SparkSession, folder: str) -> DataFrame:
    return encode.frequency_table(_postings(spark, folder), E.state_code("state"))


def binary(spark: SparkSession, folder: str) -> DataFrame:
    return _postings(spark, folder).select("o_orderkey", E.equals_flag("country", "US").alias("country_binary"))


def normalize_state(spark: SparkSession, folder: str) -> DataFrame:
    return _postings(spark, folder).select("o_orderkey", E.state_code("state").alias("state"))


def encode_all(spark: SparkSession, folder: str) -> DataFrame:
    coded = encode.encode_stage(_postings(spark, folder))
    digits = {"city_frequency", "state_frequency"}
    return coded.select(*[F.round(c, 6).alias(c) if c in digits else F.col(c) for c in coded.columns])


# --- validation and types ---------------------------------------------------


def _rows_to_check(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder, "text", "lang", "source", "n_chars").select(
        "doc_id",
        F.when(F.col("n_chars") % 3 == 0, F.col("lang")).otherwise(F.col("source")).alias("title"),
        F.col("text").alias("description"),
        F.when(F.col("lang") == "de", "n/a").when(F.col("lang") == "fr", (F.col("n_chars") * 500).cast("string"))
        .otherwise((F.col("n_chars") * 50).cast("string")).alias("salary_normalized"),
        "source", F.col("n_chars").cast("string").alias("n_chars"),
    )


_STRIP = r"regexp_replace(regexp_replace({0}, '^[\s\p{{Z}}]+', ''), '[\s\p{{Z}}]+$', '')"
SQL_CHECKED = f"""
raw AS (
  SELECT doc_id, source, n_chars::VARCHAR AS n_chars, CASE WHEN n_chars % 3 = 0 THEN lang ELSE source END AS title, text AS description,
    CASE lang WHEN 'de' THEN 'n/a' WHEN 'fr' THEN (n_chars * 500)::VARCHAR ELSE (n_chars * 50)::VARCHAR END AS salary_normalized
  FROM documents),
stripped AS (
  SELECT *, {_STRIP.format('title')} AS t, {_STRIP.format('description')} AS d, TRY_CAST(salary_normalized AS BIGINT) AS s FROM raw),
checked AS (
  SELECT *, concat_ws(' | ',
    CASE WHEN t = '' THEN 'title: MISSING or EMPTY' WHEN length(t) < 3 THEN 'title: Too short (' || length(t) || ' chars, min 3)' END,
    CASE WHEN d = '' THEN 'description: MISSING or EMPTY' WHEN length(d) < 20 THEN 'description: Too short (' || length(d) || ' chars, min 20)' END,
    CASE WHEN s IS NULL THEN 'salary_normalized: Not a valid number'
         WHEN s < 10000 THEN 'salary_normalized: $' || format('{{:,}}', s) || ' < min $10,000'
         WHEN s > 1000000 THEN 'salary_normalized: $' || format('{{:,}}', s) || ' > max $1,000,000' END) AS reasons
  FROM stripped)
"""


def validate_rows(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate.with_reasons(_rows_to_check(spark, folder))
    return checked.select("doc_id", F.array_join(validate.REASONS, " | ").alias("reasons"))


def rejects(spark: SparkSession, folder: str) -> DataFrame:
    return validate.rejected_rows(_rows_to_check(spark, folder))


def validation_report(spark: SparkSession, folder: str) -> DataFrame:
    found = validate.report(_rows_to_check(spark, folder))
    return found.select("rows", "invalid", F.round("invalid_percent", 6).alias("invalid_percent"))


def numeric_columns(spark: SparkSession, folder: str) -> DataFrame:
    valid = validate.valid_rows(_rows_to_check(spark, folder)).withColumn("empty", F.lit(""))
    return validate.first_values(valid, "doc_id", excluded=())


def numeric_table_types(spark: SparkSession, folder: str) -> DataFrame:
    """The classes of the columns a numeric model table would keep, with their sums."""
    valid = validate.valid_rows(_rows_to_check(spark, folder)).select(
        "doc_id", "n_chars", F.length("title").alias("title_tfidf_x"), F.length("description").alias("desc_emb_0"),
        F.when(F.col("source") == "", 1).otherwise(0).alias("source_missing"), "source", "salary_normalized",
    )
    kept = validate.numeric_table(valid, "doc_id")
    long = kept.select(*[to_double_or_zero(F.col(c).cast("string")).alias(c) for c in kept.columns if c != "doc_id"])
    sums = long.agg(*[F.sum(c).alias(c) for c in long.columns]).unpivot([], long.columns, "column", "total")
    return sums.select("column", table_column_type("column").alias("kind"), "total")


def safe_cast(spark: SparkSession, folder: str) -> DataFrame:
    k, v = F.col("event_id") % 8, F.col("value").cast("string")
    text = (
        F.when(k == 0, F.concat(F.lit("1_"), F.col("event_id").cast("string"))).when(k == 1, F.concat(v, F.lit("d")))
        .when(k == 2, F.concat(F.lit("  "), v, F.lit(" "))).when(k == 3, "").when(k == 4, None)
        .when(k == 5, F.concat(v, F.lit("e2"))).otherwise(v)
    )
    return table(spark, folder, "events").select(
        "event_id", F.round(to_double(text), 4).alias("parsed"), F.round(to_double_or_zero(text), 4).alias("or_zero")
    )


_TEXT = (
    "CASE event_id % 8 WHEN 0 THEN '1_' || event_id WHEN 1 THEN value || 'd' WHEN 2 THEN '  ' || value || ' ' "
    "WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 5 THEN value || 'e2' ELSE value::VARCHAR END"
)


def valid_target(spark: SparkSession, folder: str) -> DataFrame:
    shifted = (F.round((F.col("value") - 5.0) * 100) / 100).cast("string")
    text = F.when(F.col("event_id") % 9 == 0, "unknown").otherwise(shifted)
    events = table(spark, folder, "events").select("event_id", text.alias(fixed.TARGET))
    kept = project.with_positive_target(events)
    return kept.filter(F.lit(project.enough_rows(kept))).select("event_id")


# --- projection, merging, files ---------------------------------------------


def _wide(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and customers under the raw table's column names."""
    price = F.floor("o_totalprice").cast("string")
    return order_facts(spark, folder).select(
        F.col("o_orderkey").alias("job_id"), F.col("c_custkey").alias("company_id"), F.col("c_name").alias("title"),
        F.col("c_mktsegment").alias("formatted_work_type"), F.col("o_orderpriority").alias("work_type"),
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(price).alias("salary_yearly_min"),
        F.when(F.col("o_orderkey") % 2 == 0, None).otherwise(price).alias("salary_yearly_max"),
        F.lit("").alias("salary_yearly_med"),
        F.col("n_name").alias("city"), F.col("r_name").alias("country"),
        F.col("c_acctbal").alias("views"), F.lit("x").alias("url"),
    )


def final_table(spark: SparkSession, folder: str) -> DataFrame:
    return project.final_table(_wide(spark, folder))


def select_features(spark: SparkSession, folder: str) -> DataFrame:
    """Sums of the feature columns chosen by name out of a wide table."""
    wide = table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("title_tfidf_quantity"), F.col("l_discount").alias("desc_emb_0"),
        F.col("l_tax").alias("city_frequency"), F.col("l_extendedprice").alias("salary_normalized"),
        F.col("l_linenumber").alias("benefits_list_missing"), F.col("l_suppkey").alias("views_missing"),
    )
    features = feature_columns(wide.columns)
    chosen = project.union_names(
        select_names(features, contains="_tfidf_", ordered=True), select_names(features, suffix="_missing"),
        select_names(features, prefix="desc_"),
    )
    sums = wide.agg(*[F.sum(number_or_zero(wide, c)).alias(c) for c in chosen])
    return sums.unpivot([], chosen, "feature", "total").select("feature", F.round("total", 3).alias("total"))


def row_at(spark: SparkSession, folder: str) -> DataFrame:
    return project.row_at(table(spark, folder, "documents").select("doc_id", "lang", "n_chars"), "doc_id", 7)


def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    return project.first_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 10)


def merge_wide(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", F.col("c_nationkey").alias("n_nationkey")
    )
    regions = table(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    merged = profile.merge_dimensions(
        table(spark, folder, "orders"), (customers, "o_custkey"), (table(spark, folder, "nation"), "n_nationkey"),
        (regions, "n_regionkey"),
    )
    return merged.select("o_orderkey", "o_totalprice", "c_name", "n_name", "r_name")


def one_to_many_rollup(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    named = items.join(table(spark, folder, "part").select("p_partkey", "p_name"), "p_partkey")
    return profile.one_to_many(named, "l_orderkey", "p_name", "l_linenumber", "skill")


def value_shares(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.value_shares(table(spark, folder, "customer"), "c_mktsegment")
    return found.select("value", "count", F.round("percent", 6).alias("percent"))


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write text with quotes, pipes and line breaks as CSV and read it back."""
    rows = table(spark, folder, "conversations").select(
        "role", F.concat(F.col("text"), F.lit('\n"quoted", cell')).alias("text"),
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("string").alias("turn"),
    )
    path = new_path(spark, "csv")
    columns = ["conv_id", "turn", "text"]
    write_csv(rows, path, columns)
    back = read_csv(spark, path, columns)
    return back.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "text")


def one_hot_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """One sparse vector per customer over two categoricals, of which one has as many categories as there are customers."""
    rows = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_name")
    found, _ = encode.one_hot_vector(rows, "c_custkey", ["c_mktsegment", "c_name"])
    return found.select("c_custkey", F.inline(entries("one_hot"))).select("c_custkey", F.col("index").cast("bigint").alias("position"), "value")


QUERIES = {
    "one_hot_vectors": one_hot_vectors,
    "target_normalized": target_normalized,
    "target_source_counts": target_source_counts,
    "target_summary": target_summary,
    "target_stats": target_stats,
    "annualize": annualize,
    "outlier_filter": outlier_filter,
    "missing_profile": missing_profile,
    "missing_tiers": missing_tiers,
    "completeness": completeness,
    "missing_indicators": missing_indicators,
    "modes": modes,
    "impute": impute,
    "impute_audit": impute_audit,
    "ordinal": ordinal,
    "ordinal_distribution": ordinal_distribution,
    "one_hot": one_hot,
    "one_hot_long": one_hot_long,
    "frequency": frequency,
    "frequency_counts": frequency_counts,
    "binary": binary,
    "normalize_state": normalize_state,
    "encode_all": encode_all,
    "validate_rows": validate_rows,
    "rejects": rejects,
    "validation_report": validation_report,
    "numeric_columns": numeric_columns,
    "numeric_table_types": numeric_table_types,
    "safe_cast": safe_cast,
    "valid_target": valid_target,
    "final_table": final_table,
    "select_features": select_features,
    "row_at": row_at,
    "first_rows": first_rows,
    "merge_wide": merge_wide,
    "one_to_many_rollup": one_to_many_rollup,
    "value_shares": value_shares,
    "csv_roundtrip": csv_roundtrip,
}

_FILL = """
fill AS (
  SELECT (SELECT median(views) FROM base) AS views, (SELECT median(applies) FROM base) AS applies,
    (SELECT remote_allowed FROM base WHERE coalesce(remote_allowed, '') <> '' GROUP BY 1 ORDER BY count(*) DESC, min(row_id) LIMIT 1) AS remote_allowed,
    (SELECT state FROM base WHERE coalesce(state, '') <> '' GROUP BY 1 ORDER BY count(*) DESC, min(row_id) LIMIT 1) AS state)
"""
_FREQ = "ln(count(*) OVER (PARTITION BY {0}) + 1) / ln(count(*) OVER () + 1)"
SQL = {
    "one_hot_vectors": """
WITH c AS (SELECT DISTINCT 0 AS k, trim(c_mktsegment) AS v FROM customer UNION SELECT DISTINCT 1, trim(c_name) FROM customer),
p AS (SELECT k, v, row_number() OVER (ORDER BY k, v) - 1 AS position FROM c)
SELECT c_custkey, position, 1.0::DOUBLE AS value
FROM (SELECT c_custkey, 0 AS k, trim(c_mktsegment) AS v FROM customer UNION ALL SELECT c_custkey, 1, trim(c_name) FROM customer) JOIN p USING (k, v)""",
    "target_normalized": f"WITH {SQL_BOUNDS} SELECT l_partkey, nullif(salary_normalized, 0) AS salary_normalized, source FROM labelled",
    "target_source_counts": f"""
WITH {SQL_BOUNDS} SELECT source, count(*) AS count, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS percent
FROM labelled GROUP BY source""",
    "target_summary": f"""
WITH {SQL_BOUNDS},
s AS (SELECT salary_normalized AS v, row_number() OVER (ORDER BY salary_normalized) - 1 AS i, count(*) OVER () AS n
      FROM labelled WHERE source <> 'invalid')
SELECT count(*) AS n, round(min(v), 4) AS min, round(max(v) FILTER (i = n // 4), 4) AS p25,
       round(max(v) FILTER (i = n // 2), 4) AS p50, round(max(v) FILTER (i = 3 * n // 4), 4) AS p75,
       round(max(v), 4) AS max, round(avg(v), 4) AS mean FROM s""",
    "target_stats": """
SELECT count(*) AS n, round(min(o_totalprice), 4) AS min, round(max(o_totalprice), 4) AS max,
       round(avg(o_totalprice), 4) AS mean, round(median(o_totalprice), 4) AS median,
       round(stddev_pop(o_totalprice), 4) AS std FROM orders""",
    "annualize": """
SELECT event_id, round(value * CASE event_type WHEN 'view' THEN 2080 WHEN 'purchase' THEN 12 WHEN 'signup' THEN 52
  WHEN 'click' THEN 1 END::DOUBLE, 4) AS yearly FROM events""",
    "outlier_filter": """
SELECT o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_totalprice BETWEEN 10000 AND 500000 AND c_acctbal * 50 <= o_totalprice""",
    "missing_profile": f"""
WITH {SQL_LABELLED} SELECT "column", missing, round(100.0::DOUBLE * missing / n, 6) AS percent FROM missing_ WHERE missing > 0""",
    "missing_tiers": f"""
WITH {SQL_LABELLED}
SELECT "column", CASE WHEN 100.0::DOUBLE * missing / n >= 90 THEN 'drop' WHEN 100.0::DOUBLE * missing / n >= 30 THEN 'impute_indicator' ELSE 'impute' END AS tier
FROM missing_ WHERE missing > 0""",
    "completeness": f"""
WITH {SQL_LABELLED}
SELECT CASE "column" WHEN 'company_name' THEN 'text' WHEN 'skills_desc' THEN 'text' WHEN 'state' THEN 'categorical'
    WHEN 'remote_allowed' THEN 'categorical' ELSE 'numerical' END AS role, "column",
  round(100.0::DOUBLE * (n - missing) / n, 6) AS complete_percent,
  CASE "column" WHEN 'state' THEN (SELECT count(DISTINCT nullif(state, '')) FROM base)
    WHEN 'remote_allowed' THEN (SELECT count(DISTINCT nullif(remote_allowed, '')) FROM base) END AS distinct_values
FROM missing_""",
    "missing_indicators": f"""
WITH {SQL_LABELLED} SELECT "column" || '_missing' AS "column", missing, round(100.0::DOUBLE * missing / n, 6) AS percent
FROM missing_ WHERE 100.0::DOUBLE * missing / n >= 30 AND 100.0::DOUBLE * missing / n < 90""",
    "modes": f"""
WITH {SQL_LABELLED},
long AS (SELECT row_id, 'state' AS "column", state AS v FROM base UNION ALL SELECT row_id, 'remote_allowed', remote_allowed FROM base
         UNION ALL SELECT row_id, 'company_name', company_name FROM base),
c AS (SELECT "column", v, count(*) AS n, min(row_id) AS f FROM long WHERE coalesce(v, '') <> '' GROUP BY ALL)
SELECT "column", first(v ORDER BY n DESC, f) AS mode, max(n) AS count, count(*) AS distinct_values FROM c GROUP BY 1""",
    "impute": f"""
WITH {SQL_LABELLED}, {_FILL}
SELECT row_id, coalesce(base.views, fill.views)::DOUBLE AS views, coalesce(base.applies, fill.applies)::DOUBLE AS applies,
  coalesce(nullif(base.remote_allowed, ''), fill.remote_allowed) AS remote_allowed,
  coalesce(nullif(base.state, ''), fill.state) AS state, coalesce(nullif(company_name, ''), 'Unknown') AS company_name
FROM base, fill""",
    "impute_audit": f"""
WITH {SQL_LABELLED} SELECT 'filled' AS what, "column", missing AS values FROM missing_ WHERE "column" <> 'skills_desc'
UNION ALL SELECT 'left', 'untouched', count(*) FROM base WHERE row_id % 3 <> 0""",
    "ordinal": f"WITH {SQL_POSTINGS} SELECT o_orderkey, level FROM post",
    "ordinal_distribution": f"WITH {SQL_POSTINGS} SELECT level, count(*) AS n FROM post GROUP BY level",
    "one_hot": f"""
WITH {SQL_POSTINGS} SELECT o_orderkey, (size_ = 'F')::INTEGER AS company_size_F, (size_ = 'O')::INTEGER AS company_size_O,
  (size_ = 'P')::INTEGER AS company_size_P FROM post""",
    "one_hot_long": f"""
WITH {SQL_POSTINGS} SELECT o_orderkey, 'formatted_work_type_' || work AS feature, 1.0::DOUBLE AS value FROM post""",
    "frequency": f"WITH {SQL_POSTINGS} SELECT o_orderkey, round({_FREQ.format('city')}, 6) AS city_frequency FROM post",
    "frequency_counts": f"WITH {SQL_POSTINGS} SELECT state AS value, count(*) AS count FROM post GROUP BY state",
    "binary": f"WITH {SQL_POSTINGS} SELECT o_orderkey, us AS country_binary FROM post",
    "normalize_state": f"WITH {SQL_POSTINGS} SELECT o_orderkey, state FROM post",
    "encode_all": f"""
WITH {SQL_POSTINGS}
SELECT o_orderkey, salary_normalized, c_custkey, level AS formatted_experience_level_ordinal,
  (work = 'AUTOMOBILE_job_x')::INTEGER AS formatted_work_type_AUTOMOBILE_job_x,
  (work = 'BUILDING_job_x')::INTEGER AS formatted_work_type_BUILDING_job_x,
  (work = 'FURNITURE_job_x')::INTEGER AS formatted_work_type_FURNITURE_job_x,
  (work = 'HOUSEHOLD_job_x')::INTEGER AS formatted_work_type_HOUSEHOLD_job_x,
  (work = 'missing')::INTEGER AS formatted_work_type_missing,
  (size_ = 'F')::INTEGER AS company_size_F, (size_ = 'O')::INTEGER AS company_size_O, (size_ = 'P')::INTEGER AS company_size_P,
  round({_FREQ.format('city')}, 6) AS city_frequency, round({_FREQ.format('state')}, 6) AS state_frequency,
  us AS country_binary FROM post""",
    "validate_rows": f"WITH {SQL_CHECKED} SELECT doc_id, reasons FROM checked",
    "rejects": f"""
WITH {SQL_CHECKED} SELECT doc_id, title, description, salary_normalized, source, n_chars, reasons AS validation_errors
FROM checked WHERE reasons <> ''""",
    "validation_report": f"""
WITH {SQL_CHECKED} SELECT count(*) AS rows, count(*) FILTER (reasons <> '') AS invalid,
  round(100.0::DOUBLE * count(*) FILTER (reasons <> '') / count(*), 6) AS invalid_percent FROM checked""",
    "numeric_columns": f"""
WITH {SQL_CHECKED},
head AS (SELECT * FROM checked WHERE reasons = '' ORDER BY doc_id LIMIT 100),
long AS (SELECT doc_id, 'title' AS "column", title AS v FROM head UNION ALL SELECT doc_id, 'description', description FROM head
  UNION ALL SELECT doc_id, 'salary_normalized', salary_normalized FROM head UNION ALL SELECT doc_id, 'source', source FROM head
  UNION ALL SELECT doc_id, 'n_chars', n_chars FROM head)
SELECT "column", first(v ORDER BY doc_id) AS sample, {sql_number('first(v ORDER BY doc_id)')} IS NOT NULL AS is_numeric
FROM long WHERE coalesce(v, '') <> '' GROUP BY 1""",
    "numeric_table_types": f"""
WITH {SQL_CHECKED}, ok AS (SELECT * FROM checked WHERE reasons = '')
SELECT 'n_chars' AS "column", 'Original numeric' AS kind, sum(n_chars::DOUBLE) AS total FROM ok
UNION ALL SELECT 'title_tfidf_x', 'TF-IDF', sum(length(title))::DOUBLE FROM ok
UNION ALL SELECT 'desc_emb_0', 'Embedding', sum(length(description))::DOUBLE FROM ok
UNION ALL SELECT 'source_missing', 'Missing indicator', sum((source = '')::INTEGER)::DOUBLE FROM ok
UNION ALL SELECT 'salary_normalized', 'Original numeric', sum(salary_normalized::DOUBLE) FROM ok""",
    "safe_cast": f"""
SELECT event_id, round({sql_number(_TEXT)}, 4) AS parsed, coalesce(round({sql_number(_TEXT)}, 4), 0.0::DOUBLE) AS or_zero FROM events""",
    "valid_target": "SELECT event_id FROM events WHERE event_id % 9 <> 0 AND round((value - 5.0::DOUBLE) * 100) / 100 > 0",
    "final_table": f"""
SELECT c_name AS title, c_mktsegment AS formatted_work_type, n_name AS city, r_name AS country, c_acctbal AS views,
  round(CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 1 THEN floor(o_totalprice) * 0.85::DOUBLE END
    WHEN o_orderkey % 2 = 0 THEN floor(o_totalprice) * 1.15::DOUBLE ELSE floor(o_totalprice) END, 2) AS salary_normalized
FROM ({SQL_ORDER_FACTS}) WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 1""",
    "select_features": """
SELECT 'title_tfidf_quantity' AS feature, round(sum(l_quantity), 3) AS total FROM lineitem
UNION ALL SELECT 'views_missing', round(sum(l_suppkey::DOUBLE), 3) FROM lineitem
UNION ALL SELECT 'desc_emb_0', round(sum(l_discount), 3) FROM lineitem""",
    "row_at": "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 1 OFFSET 7",
    "first_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
    "merge_wide": f"SELECT o_orderkey, o_totalprice, c_name, n_name, r_name FROM ({SQL_ORDER_FACTS})",
    "one_to_many_rollup": """
WITH p AS (SELECT l_orderkey, p_name, count(*) AS n, min(l_linenumber) AS a FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT l_orderkey, CAST(sum(n) AS BIGINT) AS skill_count, first(p_name ORDER BY a, p_name) AS primary_skill,
  string_agg(p_name, '|' ORDER BY p_name) AS all_skill FROM p GROUP BY l_orderkey""",
    "value_shares": """
SELECT c_mktsegment AS value, count(*) AS count, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS percent
FROM customer GROUP BY 1""",
    "csv_roundtrip": """SELECT conv_id, turn, text || chr(10) || '"quoted", cell' AS text FROM conversations""",
}
