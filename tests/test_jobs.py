"""End-to-end jobs against catalog tables built from the sf0.001 driver tables."""

from entwise import schemas as S
from entwise.operators import changes as chg
from entwise.operators import supplement as sup
from entwise.plans import jobs
from entwise.sources import adapters as A

SF = "/root/testdata/sf0.001"


def save(df, name):
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def empty(spark, schema, name):
    spark.createDataFrame([], schema).write.mode("overwrite").format("parquet").saveAsTable(name)


def test_change_and_supplement_jobs_are_idempotent(spark):
    save(A.raw_changes(spark, SF), "j_raw_changes")
    raw = spark.table("j_raw_changes")
    spark.createDataFrame([], S.CHANGES_SCHEMA).write.partitionBy("trn_ts").saveAsTable("j_changes")
    early = raw.filter(raw.trn_ts < A.LOADED_BEFORE_TIME)
    assert jobs.normalize_changes(spark, early, early, "j_changes", A.EXCLUDED_USERS)
    late = raw.filter(raw.trn_ts >= A.LOADED_BEFORE_TIME)
    for _ in range(2):  # a second run changes nothing
        jobs.normalize_changes(spark, late, raw, "j_changes", A.EXCLUDED_USERS)
        assert spark.table("j_changes").count() == chg.normalize(raw, A.EXCLUDED_USERS).count() > 0

    save(A.entity_locations(spark, SF), "j_locations")
    save(A.suppliers(spark, SF), "j_suppliers")
    save(A.phone_source(spark, SF), "j_phone")
    save(A.size_source(spark, SF), "j_sizes")
    empty(spark, S.SUPPLEMENT_SCHEMA, "j_supplement")
    sources = [("j_phone", [sup.PHONE_AREA, sup.PHONE_PFX]), ("j_sizes", [sup.SLS_SIZE, sup.EMP_SIZE])]
    added = jobs.build_supplement(spark, "j_changes", "j_locations", "j_suppliers", sources, "j_supplement")
    assert added["rows"] > 0
    assert jobs.build_supplement(spark, "j_changes", "j_locations", "j_suppliers", sources,
                                 "j_supplement")["rows"] == 0
    elements = {r.element for r in spark.table("j_supplement").select("element").distinct().collect()}
    assert elements == {"Phone_AREA", "Phone_PFX", "Sls_Size", "Emp_Size"}


def test_address_jobs(spark):
    save(A.address(spark, SF), "j_address")
    save(A.location_addresses(spark, SF), "j_loc_addr")
    save(A.sic_source(spark, SF), "j_naics")
    save(A.entity_location_assoc(spark, SF), "j_assoc")
    save(A.operating_locations(spark, SF), "j_oper")
    spark.sql("CREATE TABLE j_govt (no_dir_strtnm_ste_zip STRING, govt STRING) USING parquet")
    jobs.build_government_keys(spark, "j_address", "j_loc_addr", "j_naics", "j_assoc", "j_oper",
                               "j_govt", years=A.FIXTURE_GOVT_YEARS)
    n_keys = spark.table("j_govt").count()
    assert n_keys > 0
    # replace, not append: running again keeps the same rows
    jobs.build_government_keys(spark, "j_address", "j_loc_addr", "j_naics", "j_assoc", "j_oper",
                               "j_govt", years=A.FIXTURE_GOVT_YEARS)
    assert spark.table("j_govt").count() == n_keys

    empty(spark, S.T.StructType([S.T.StructField(c, S.T.StringType()) for c in S.ADDRESS_LAYOUT]),
          "j_classified")
    audit = jobs.classify_addresses(spark, "j_address", "j_govt", "j_classified")
    out = spark.table("j_classified")
    assert out.columns == S.ADDRESS_LAYOUT
    assert audit["rows"] == out.count() == spark.table("j_address").count()
    assert audit["rsdl_ones"] == out.filter("rsdl = '1'").count()
    assert out.filter("govt = '1'").count() > 0


def test_survey_load(spark):
    save(A.survey_responses(spark, SF), "j_responses")
    jobs.load_survey(spark, "j_responses", "j_accepted", "j_invalid")
    bad = {r.respondent_id for r in spark.table("j_invalid").collect()}
    good = {r.respondent_id for r in spark.table("j_accepted").collect()}
    assert good and bad and not good & bad
    assert spark.table("j_accepted").columns == spark.table("j_responses").columns
