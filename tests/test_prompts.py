import pytest
from pyspark.sql import functions as F

from shiftwell.functions.prompts import ARTICLE_QUESTIONS, STRESS_REASON, STRESS_SCORE, Prompt
from shiftwell.functions.text import has_text, main_tag, or_empty, tag_shape_ok

PROMPT = Prompt("%s is %d: %.1f and %.2f, 100%%.", ("name", "age", "rating", "fare"))
ROW = ("Ann", 40, 4.56, 1.005)


def rendered(spark, *values):
    frame = spark.createDataFrame([values], "name string, age bigint, rating double, fare double")
    return frame.select(PROMPT.render()).first()[0]


def test_formats(spark):
    assert rendered(spark, *ROW) == "Ann is 40: 4.6 and 1.01, 100%."


@pytest.mark.parametrize("place", range(4))
def test_a_null_value_gives_a_null_prompt(spark, place):
    values = [None if i == place else value for i, value in enumerate(ROW)]
    assert rendered(spark, *values) is None


def test_percent_in_a_value_is_text(spark):
    assert rendered(spark, "50%s %d", *ROW[1:]) == "50%s %d is 40: 4.6 and 1.01, 100%."


def test_places_and_columns_must_fit():
    with pytest.raises(ValueError, match="2 places but 1 columns"):
        Prompt("%s %s", ("a",))


def test_complete_agrees_with_render(spark):
    rows = [ROW, (None, *ROW[1:]), (*ROW[:3], None)]
    frame = spark.createDataFrame(rows, "name string, age bigint, rating double, fare double")
    for text, complete in frame.select(PROMPT.render(), PROMPT.complete()).collect():
        assert (text is not None) == complete


def test_prompt_fields():
    assert STRESS_SCORE.columns == (
        "Age",
        "City",
        "Experience_Years",
        "Average_Rating",
        "total_rides_all_days",
        "active_days",
        "total_duration_min_all_days",
        "min_fare",
        "max_fare",
        "stddev_fare",
    )
    assert STRESS_SCORE.places == ["%d", "%s", "%d", "%.1f", "%d", "%d", "%d", *["%.2f"] * 3]
    assert STRESS_REASON.columns[4:6] == ("active_days", "total_rides_all_days")
    assert all(p.columns == ("article_name", "content") for p in ARTICLE_QUESTIONS.values())


def test_text_columns(spark):
    values = ["Burnout , Stress", "", None, ",a", "\n one two\u00a0\t"]
    frame = spark.createDataFrame([(v,) for v in values], "t string")
    column = F.col("t")
    found = frame.select(main_tag(column), or_empty(column), has_text(column)).collect()
    assert [row[0] for row in found] == ["Burnout", "", None, "", "one two"]
    assert [row[1] for row in found] == ["" if v is None else v for v in values]
    assert [row[2] for row in found] == [True, False, False, True, True]


def test_tag_shape(spark):
    good = ["a, b", "High strain, Overwork, Income worry"]
    bad = ["a", "a, b, c, d", "one two three, b", "", ",a"]
    frame = spark.createDataFrame([(v,) for v in good + bad], "t string")
    found = [row[0] for row in frame.select(tag_shape_ok(F.col("t"))).collect()]
    assert found == [True] * len(good) + [False] * len(bad)
