"""Survey questions dimension and response validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entwise import schemas as S

CHOICE_TYPES = ["select", "mc"]


def questions(spark: SparkSession) -> DataFrame:
    """One row per (question, option): 1+1+1+1+7+3 = 14 rows."""
    rows = [(q, opt, itype, iid, None, None, True)
            for q, opts, itype, iid in S.SURVEY_QUESTIONS for opt in opts]
    return spark.createDataFrame(
        rows, "question string, option string, input_type string, input_id string, "
              "dependence string, dependence_value string, required boolean")


def invalid_responses(spark: SparkSession, responses: DataFrame) -> DataFrame:
    """Answers that break the survey definition.

    ``responses`` is long-form (respondent_id, input_id, answer). Output rows:
    (respondent_id, input_id, answer, problem) with problem 'missing' (required
    answer NULL or blank, or no row for the question at all), 'unknown_question',
    or 'invalid_option' (choice answer not among the options). The question
    dimension is a 14-row literal, so it is broadcast. Questions without a row
    come from one aggregate with a flag for each question per respondent.
    """
    dim = F.broadcast(spark.createDataFrame(
        [(iid, itype, 1) for _, _, itype, iid in S.SURVEY_QUESTIONS],
        "input_id string, input_type string, req int"))
    opts = F.broadcast(spark.createDataFrame(
        [(iid, o, True) for _, os_, itype, iid in S.SURVEY_QUESTIONS if itype in CHOICE_TYPES
         for o in os_], "input_id string, answer string, is_option boolean"))
    # one pass: both dimensions are literals joined map-side
    r = responses.join(dim, "input_id", "left").join(opts, ["input_id", "answer"], "left")
    blank = F.col("answer").isNull() | (F.trim(F.col("answer")) == F.lit(""))
    problem = (F.when(F.col("input_type").isNull(), F.lit("unknown_question"))
               .when(blank & (F.col("req") == 1), F.lit("missing"))
               .when(F.col("input_type").isin(*CHOICE_TYPES) & ~blank & F.col("is_option").isNull(),
                     F.lit("invalid_option")))
    found = (r.select("respondent_id", "input_id", "answer", problem.alias("problem"))
             .filter(F.col("problem").isNotNull()))
    ids = [iid for _, _, _, iid in S.SURVEY_QUESTIONS]
    asked = responses.groupBy("respondent_id").agg(
        *[F.max(F.col("input_id").eqNullSafe(F.lit(i))).alias(i) for i in ids])
    absent = asked.select("respondent_id", F.explode(F.filter(
        F.array(*[F.when(~F.col(i), F.lit(i)) for i in ids]), lambda x: x.isNotNull())).alias("input_id"))
    return found.unionByName(absent.select(
        "respondent_id", "input_id", F.lit(None).cast("string").alias("answer"), F.lit("missing").alias("problem")))


def load_responses(spark: SparkSession, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, invalid): a respondent's answers are accepted only if none of
    them breaks the survey definition."""
    invalid = invalid_responses(spark, responses)
    return responses.join(invalid.select("respondent_id"), "respondent_id", "left_anti") \
        .select(*responses.columns), invalid
