from entwise.operators import survey

from .conftest import rows


def test_questions_dimension(spark):
    q = survey.questions(spark)
    assert q.count() == 14
    assert q.filter("input_id = 'province'").count() == 7


def test_invalid_responses(spark):
    resp = spark.createDataFrame([
        (1, "name", "Ana"), (1, "province", "Heredia"), (1, "gender", "F"), (1, "food", "x"), (1, "hobbie", "y"),
        (2, "food", "x"), (2, "hobbie", "y"), (2, "age", "7"), (2, "name", " "), (2, "province", "Atlantis"), (2, "gender", None), (2, "pet", "cat"),
    ], "respondent_id long, input_id string, answer string")
    out = survey.invalid_responses(spark, resp)
    # respondent 1 has no row for the age
    assert rows(out) == [(1, "age", None, "missing"), (2, "gender", None, "missing"), (2, "name", " ", "missing"),
                         (2, "pet", "cat", "unknown_question"),
                         (2, "province", "Atlantis", "invalid_option")]
