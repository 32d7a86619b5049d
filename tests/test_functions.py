import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.functions import arrays, dates, documents, numbers, text
from millrace.operators import quality, ranking
from millrace.plans.scalars import strip_tags
from millrace.schema import declare_schema

DEVICES = [
    (11, '{"model":"pump","watts":750,"site":{"hall":"east","shelf":"E-4"},"hours":[6,2,9]}'),
    (12, '{"model":"fan","watts":40,"site":{"hall":"roof","shelf":"R-1"},"hours":[]}'),
    (13, '{"model":"lathe","site":{"hall":"west"}}'),
    (14, "[oops"),
]


def test_json_by_path_and_fill(spark):
    df = spark.createDataFrame(DEVICES, ["id", "j"])
    value = F.col("j")
    out = df.select(
        "id",
        documents.json_text(value, "$.model").alias("model"),
        documents.json_text(value, "$.watts").alias("watts"),
        documents.json_text(value, "$.site.hall").alias("hall"),
        documents.json_text(value, "$.hours[1]").alias("second"),
    )
    filled = quality.fill_nulls(out, {"second": -1})
    assert rows(filled) == [
        (11, "pump", "750", "east", "2"),
        (12, "fan", "40", "roof", "-1"),
        (13, "lathe", None, "west", "-1"),
        (14, None, None, None, "-1"),
    ]


def test_json_typed(spark):
    schema = declare_schema(
        [("model", "string"), ("watts", "int"), ("site", "struct", [("hall", "string"), ("shelf", "string")]), ("hours", "array_int")]
    )
    df = spark.createDataFrame(DEVICES, ["id", "j"])
    parsed = df.select("id", documents.json_struct(F.col("j"), schema).alias("p"))
    out = parsed.select("id", "p.watts", documents.element(F.col("p.hours"), 2).alias("third"), "p.site.hall")
    assert rows(out) == [(11, 750, 9, "east"), (12, 40, None, "roof"), (13, None, None, "west"), (14, None, None, None)]


def test_bad_json_key_is_null(spark):
    df = spark.createDataFrame([('{"k": 5}',), ('{"k": "abc"}',), ("{",)], ["j"])
    assert [r[0] for r in df.select(documents.json_key(F.col("j"), "$.k")).collect()] == [5, None, None]


def test_dates_from_text(spark):
    df = spark.createDataFrame([("25-12-1999",), ("1999-12-25",), ("soon",), (None,)], ["d"])
    out = [r[0] for r in df.select(dates.parse_date(F.col("d"), "dd-MM-yyyy")).collect()]
    assert out == [dt.date(1999, 12, 25), None, None, None]
    stamp = spark.createDataFrame([("2024-03-01 10:00:05",), ("bad ts",)], ["t"])
    assert [r[0] for r in stamp.select(dates.parse_timestamp(F.col("t"))).collect()] == [dt.datetime(2024, 3, 1, 10, 0, 5), None]


def test_weighted_score_of_trails(spark):
    # exp(3) is 20.0855, exp(6) is 403.4288.
    data = [("ridge", 2.0, math.exp(3)), ("gorge", 1.5, math.exp(6)), ("marsh", 7.0, 1.0)]
    df = spark.createDataFrame(data, ["trail", "rating", "reviews"])
    score = F.round(numbers.weighted_score(F.col("rating"), F.col("reviews")), 2)
    out = df.select("trail", score.alias("s")).orderBy(F.desc("s")).collect()
    assert [tuple(r) for r in out] == [("gorge", 9.0), ("ridge", 6.0), ("marsh", 0.0)]


def test_buckets_with_and_without_default(spark):
    df = spark.createDataFrame([(10.0,), (18.0,), (25.0,), (None,)], "m double")
    m = F.col("m")
    sla = numbers.bucket([(m <= 15, "FAST"), ((m > 15) & (m <= 20), "ON_TIME"), (m > 20, "LATE")])
    price = numbers.bucket([(m < 15, "LOW"), (m <= 20, "MEDIUM")], "HIGH")
    out = [tuple(r) for r in df.select(sla, price).collect()]
    assert out == [("FAST", "LOW"), ("ON_TIME", "MEDIUM"), ("LATE", "HIGH"), (None, "HIGH")]


def test_bucket_membership_equals_the_label(spark):
    df = spark.createDataFrame([(float(i),) for i in range(30)] + [(None,)], "m double")
    m = F.col("m")
    rules = [(m <= 15, "FAST"), (m <= 20, "ON_TIME"), (m > 10, "LATE")]
    for _, label in rules:
        assert rows(df.filter(numbers.in_bucket(rules, label))) == rows(df.filter(numbers.bucket(rules) == label))


def test_age_bands(spark):
    age = F.col("age")
    df = spark.createDataFrame([(24,), (25,), (26,), (43,), (44,), (45,)], "age int")
    band = numbers.bucket([(age < 25, "YOUNG"), ((age >= 25) & (age < 45), "ADULT")], "SENIOR")
    assert [r[0] for r in df.select(band).collect()] == ["YOUNG", "ADULT", "ADULT", "ADULT", "ADULT", "SENIOR"]


def test_squares_keep_integers(spark):
    df = spark.createDataFrame([(-7,), (0,), (12,), (301,), (5000,)], "n int")
    assert [r[0] for r in df.select(numbers.square(F.col("n"))).collect()] == [49, 0, 144, 90601, 25000000]


def test_row_sum(spark):
    df = spark.createDataFrame([(3, 8, 1, 70)], ["a", "b", "c", "d"])
    assert df.select(numbers.row_sum(*[F.col(c) for c in "abcd"])).first()[0] == 82
    assert df.select(numbers.row_sum(F.col("a"))).first()[0] == 3


def test_names(spark):
    df = spark.createDataFrame([(" zOÉ ",), (" lUIS",), ("HANA mORI  ",)], ["n"])
    assert [r[0] for r in df.select(text.normalize_name(F.col("n"))).collect()] == ["Zoé", "Luis", "Hana Mori"]


def test_words_by_length(spark):
    df = spark.createDataFrame([("gravel",), ("oak",), ("fern",), ("elm",)], ["w"])
    assert [r[0] for r in ranking.sort_by_length(df, "w", []).collect()] == ["elm", "oak", "fern", "gravel"]


def test_arrays(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],), ([],)], "nums array<int>")
    squares = arrays.map_elements(F.col("nums"), numbers.square)
    even = arrays.keep_elements(F.col("nums"), lambda n: n % 2 == 0)
    out = [tuple(r) for r in df.select(squares, even, arrays.sum_elements(F.col("nums"))).collect()]
    assert out == [([1, 4, 9, 16, 25], [2, 4], 15), ([], [], 0)]


def test_records_where_a_flag_is_false(spark):
    events = [{"id": 1, "ok": True}, {"id": 2, "ok": False}, {"id": 3, "ok": True}]
    df = spark.createDataFrame([(events,)], "events array<struct<id:int,ok:boolean>>")
    kept = df.select(arrays.keep_elements(F.col("events"), lambda e: ~e["ok"])).first()[0]
    assert [r["id"] for r in kept] == [2]


def test_element_out_of_bounds(spark):
    df = spark.createDataFrame([([1],)], "a array<int>")
    assert df.select(documents.element(F.col("a"), 3)).first()[0] is None


def test_html_text_equals_python_form(spark):
    page = "<html><style>p{}</style><body>\n<p>One  <b>two</b></p><!-- no\nthis --><script>var x='<p>'</script> three</body>"
    df = spark.createDataFrame([(page,)], ["h"])
    assert df.select(text.html_text(F.col("h"))).first()[0] == "One two three" == strip_tags(page)


def test_nulls(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y"), (3, 2.0, None)], "a int, b double, c string")
    assert rows(quality.count_nulls(df)) == [(1, 2, 1)]
    assert rows(quality.null_profile(df)) == [("a", 1), ("b", 2), ("c", 1)]
    assert quality.drop_nulls(df).count() == 0
    assert quality.drop_nulls(df, ["a", "c"]).count() == 1
    filled = quality.fill_nulls(df, {"a": 0, "b": 1.5, "c": "?"})
    assert rows(filled) == [(0, 1.5, "y"), (1, 1.5, "x"), (3, 2.0, "?")]
