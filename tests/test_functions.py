"""Column expressions on hand-made rows."""

import math
import re
import sys
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowloom import fixed_values as fixed
from rowloom.functions import bands, cells, encoders, naming, target, text


def values(spark, inputs, expression, schema="c STRING"):
    rows = spark.createDataFrame([(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(inputs)], "i INT, " + schema)
    return [r["v"] for r in rows.select("i", expression.alias("v")).orderBy("i").collect()]


def test_clean_text(spark):
    cases = {
        "Senior Python Developer (C++) - Apply at http://jobs.com": "senior python developer cplusplus apply at",
        "C# and .NET, Node.js": "csharp and dotnet nodejs",
        "mail a.b@c.io now": "mail now",
        "see www.x.org/y today": "see today",
        "été x": "t x",
        "": "", "   ": "", None: "",
        "@lead a@ x@y@z end": "lead a end",
        "a@b,c d": "d",
        "a\tb\n c": "a b c",
        "mail me@x.com\u00a0senior engineer": "mail senior engineer",
        "see www.x.org\u3000here": "see here",
    }
    assert values(spark, list(cases), text.clean_text("c")) == list(cases.values())


def plain_clean(s):
    s = s.lower()
    for a, b in fixed.TECHNICAL_TERMS:
        s = s.replace(a, b)
    s = re.sub(r"http\S+|www\.\S+", "", s)
    s = re.sub(r"\S+@\S+", "", s)
    return " ".join(re.sub(r"[^a-z0-9]", " ", s).split())


def test_cleaning_reads_a_text_a_few_times_only(spark):
    def seconds(c):
        took = []
        for _ in range(3):
            began = time.perf_counter()
            rows.agg(F.sum(F.length(c))).first()
            took.append(time.perf_counter() - began)
        return min(took)

    rows = spark.range(0, 40, 1, 4).select(F.repeat(F.format_string("wörds of row %d ", "id"), 20_000).alias("c"))
    # Looking for addresses took some 25 times as long as replacing all but letters and digits.
    assert seconds(text.clean_text("c")) < 8 * seconds(F.regexp_replace("c", "[^a-z0-9]+", " "))


def test_blanks_of_the_fast_patterns(spark):
    points = spark.range(sys.maxunicode + 1).filter("id NOT BETWEEN 55296 AND 57343")
    points = points.select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'utf-32')").alias("c"))
    other = points.filter(F.col("c").rlike(f"^{cells.BLANK}$") != F.col("c").rlike(f"{cells.JAVA_FLAG}^[{cells.JAVA_BLANKS}]$"))
    assert other.count() == 0 and points.filter(F.col("c").rlike(f"^{cells.BLANK}$")).count() == len(set(cells.WHITE_SPACE))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aB9 @.+#/|-\n\téhttpw:\u00a0\u2009\u3000\x1c", max_size=60), min_size=40, max_size=40))
def test_clean_text_properties(spark, inputs):
    once = values(spark, inputs, text.clean_text("c"))
    assert once == [plain_clean(s) for s in inputs]
    assert all(re.fullmatch(r"([a-z0-9]+( [a-z0-9]+)*)?", s) for s in once)


def test_field_words(spark):
    assert values(spark, ["Python|Java|C++", "a||b c", None], text.field_words("c", "all_skills")) == [
        ["python", "java", "cplusplus"], ["a", "b", "c"], []]
    assert values(spark, ["Senior Software Engineer", " "], text.field_words("c", "title")) == [
        ["senior", "software", "engineer"], []]


def test_ngrams_and_first_words(spark):
    words = text.words("c")
    assert values(spark, ["a b c", "a", ""], text.ngrams(words, 2)) == [["a", "b", "c", "a b", "b c"], ["a"], []]
    assert values(spark, ["a b c"], text.ngrams(words, 3)) == [["a", "b", "c", "a b", "b c", "a b c"]]
    assert values(spark, ["a b c", ""], text.first_words("c", 2)) == ["a b", ""]
    assert values(spark, ["ab c de"], text.long_words("c")) == [["ab", "de"]]
    assert values(spark, [("a", None, "b")], text.joined_fields("c", "d", "e"), "c STRING, d STRING, e STRING") == ["a  b"]
    assert values(spark, ["A  b\nc", ""], text.raw_words("c")) == [["A", "b", "c"], []]


def test_numbers(spark):
    inputs = ["1_000", "1d", " 12.5 ", "", None, "abc", "1e3", ".5", "5.", "inf", "1__0", "-3", " 7 "]
    assert values(spark, inputs, cells.to_double("c")) == [
        1000.0, None, 12.5, None, None, None, 1000.0, 0.5, 5.0, math.inf, None, -3.0, 7.0]
    assert math.isnan(values(spark, ["nan"], cells.to_double("c"))[0])
    assert values(spark, ["x", "2"], cells.to_double_or_zero("c")) == [0.0, 2.0]
    kept = values(spark, ["0", "-1", "2", "nan", "x"], F.coalesce(cells.positive_number(cells.to_double("c")), F.lit(False)))
    assert kept == [False, False, True, True, False]
    assert values(spark, [1.5], cells.fixed_point("c", 2), "c DOUBLE") == ["1.50"]


@pytest.mark.parametrize("low, high, median, value, source", [
    ("100", "200", "5000", 150.0, "min_max"),
    (None, None, "5000", 5000.0, "median"),
    ("100", None, "5000", 5000.0, "median"),
    ("100", None, "999", 115.0, "min_only"),
    (None, "200", None, 170.0, "max_only"),
    ("0", "200", None, 170.0, "min_max"),
    ("abc", "200", None, 170.0, "min_max"),
    (None, None, "999", None, "invalid"),
    ("0", "0", "0", None, "invalid"),
    ("-5", "5", "9000", None, "invalid"),
])
def test_target(spark, low, high, median, value, source):
    row = spark.createDataFrame([(low, high, median)], "a STRING, b STRING, c STRING").select(
        target.normalized_target("a", "b", "c").alias("v"), target.target_source("a", "b", "c").alias("s")).first()
    assert (row.v, row.s) == (value, source)


def test_yearly_amount_and_outliers(spark):
    rows = [(10.0, "HOURLY"), (10.0, "monthly"), (10.0, "WEEKLY"), (10.0, "YEARLY"), (10.0, "?"), (10.0, None)]
    assert values(spark, rows, target.yearly_amount("c", "p"), "c DOUBLE, p STRING") == [20800.0, 120.0, 520.0, 10.0, None, None]
    df = spark.createDataFrame([(9999.0, 1.0, 2.0), (1e4, 1.0, 2.0), (5e5, None, 2.0), (6e5, 1.0, 2.0), (2e4, 3.0, 2.0)], "v DOUBLE, a DOUBLE, b DOUBLE")
    assert sorted(r.v for r in target.plausible_pay(df, "v", "a", "b").collect()) == [1e4, 5e5]


def test_encoders(spark):
    level = encoders.ordinal_code("c", fixed.EXPERIENCE_SCALE)
    inputs = ["Mid-Senior level", "Associate Director", "VP", "", "missing", "director", " Director ", None]
    assert values(spark, inputs, level) == [3, 2, -1, -1, -1, -1, 4, -1]
    states = ["California", " ca ", "0", "", "Ontario", "District of Columbia", None, " 0 "]
    assert values(spark, states, encoders.state_code("c")) == ["CA", "CA", "missing", "missing", "Ontario", "DC", "missing", "0"]
    assert values(spark, ["US", " us ", "USA", None], encoders.equals_flag("c", "US")) == [1, 1, 0, 0]
    assert values(spark, ["a", " ", None], encoders.category("c")) == ["a", "missing", "missing"]
    assert encoders.one_hot_name("size", "Full-time job") == "size_Full_time_job"
    assert values(spark, ["Full-time job", "size_x"], encoders.one_hot_name_column("size", "c")) == [
        encoders.one_hot_name("size", v) for v in ("Full-time job", "size_x")]
    assert len(fixed.STATE_CODES) == len(set(fixed.STATE_CODES.values())) == 51


def test_names_and_bands(spark):
    names = ["t_tfidf_a", "t_w2v_0", "formatted_experience_level_ordinal", "company_size_1", "city_frequency", "country_binary", "views"]
    assert values(spark, names, naming.feature_type("c")) == [
        "TF-IDF", "Word2Vec", "Ordinal", "One-Hot", "Frequency", "Binary", "Other Numeric"]
    assert naming.select_names(["b_x", "a_x", "c"], suffix="_x", ordered=True) == ["a_x", "b_x"]
    assert naming.feature_columns(["a", "salary_normalized"]) == ["a"]
    assert values(spark, [0.049, 0.05, 0.1, 0.2], bands.gap_band("c"), "c DOUBLE") == ["None", "Mild", "Moderate", "Severe"]
    assert values(spark, [0.7, 0.5, 0.3, 0.1], bands.r2_band("c"), "c DOUBLE") == ["EXCELLENT", "GOOD", "MODERATE", "POOR"]
    assert values(spark, [(0.5, 0.4), (0.4, 0.5)], F.round(bands.gain_percent("c", "d"), 6), "c DOUBLE, d DOUBLE") == [25.0, 25.0]
