import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from labelops.constants import CLASS_METADATA, PRE_MERGE_NAMES
from labelops.functions import tokens as t
from labelops.operators import taxonomy
from tests.conftest import rows

GOLDEN = [
    ("bell pepper", "bell_pepper", "bell_pepper", "bell_pepper", "bell_pepper", "bell_pepper"),
    ("Ridged Gourd", "ridged_gourd", "ridged_gourd", "gourd", "ridged_gourd", "ridged_gourd"),
    ("mango_c", "mango", "mango", "mango", "mango", "mango_c"),
    ("apple_tao_123", "apple_tao_123", "apple", "apple", "apple", "apple_tao_123"),
    ("Black Mulberry", "black_mulberry", "black_mulberry", "mulberry", "black_mulberry", "black_mulberry"),
    ("black_mullberry", "black_mullberry", "black_mullberry", "black_mullberry", "black_mulberry", "black_mullberry"),
    ("mullberry", "mullberry", "mullberry", "mulberry", "mullberry", "mullberry"),
    ("jackfruit_cempedak",) * 6,
    ("jackfruit_mit_88", "jackfruit_mit_88", "jackfruit", "jackfruit_cempedak", "jackfruit", "jackfruit_mit_88"),
    ("custard apple", "custard_apple", "custard_apple", "custard_apple", "custard_apple", "custard_apple"),
    ("custard_apple_77", "custard_apple_77", "custard_apple_77", "custard_apple_77", "custard", "custard_apple_77"),
    ("grape fruit", "grape_fruit", "grape", "grape", "grape", "grape_fruit"),
    ("burmese_grape_dau_da_5", "burmese_grape_dau_da_5", "burmese_grape", "burmese_grape", "burmese_grape", "burmese_grape_dau_da_5"),
    ("Other ", "other", "other", "other", "other", "other"),
    ("other_misc_3", "other_misc_3", "other", "other", "other", "other_misc_3"),
    ("vitamin_c", "vitamin", "vitamin", "vitamin", "vitamin", "vitamin_c"),
    ("Mãng cầu", "m_ng_c_u", "m_ng_c_u", "m_ng_c_u", "m_ng_c_u", "mang_cau"),
    ("Đu Đủ", "u", "u", "u", "u", "u_u"),
]


def test_golden_tokens(spark):
    df = spark.createDataFrame([(g[0],) for g in GOLDEN], "name string")
    out = t.ascii_token(df, "name").select(
        "name", t.basic_token(F.col("name")), t.resolve_known(F.col("name")), t.merge_class(F.col("name")),
        t.clean_label(F.col("name")), "ascii_token",
    )
    assert {r[0]: tuple(r) for r in out.collect()} == {g[0]: g for g in GOLDEN}


def test_blank_names(spark):
    df = spark.createDataFrame([("  --  ",)], "name string")
    assert df.select(t.basic_token(F.col("name")), t.safe_token(F.col("name"), "image")).first() == ("", "image")
    with pytest.raises(PySparkException, match="blank class name"):
        df.select(t.clean_label(F.col("name"))).collect()
    mapping = taxonomy.raw_mapping(df.withColumnRenamed("name", "raw_class"))
    assert taxonomy.taxonomy_plan(mapping).first()["problem"] == "blank_name"


def test_all_metadata_keys_merge_to_42_classes(spark):
    df = spark.createDataFrame([(k,) for k in CLASS_METADATA], "raw_class string")
    plan = taxonomy.taxonomy_plan(taxonomy.raw_mapping(df))
    assert plan.count() == 42 and plan.where("problem is not null").isEmpty()
    fixed = df.withColumn("raw_class", F.replace("raw_class", F.lit("black_mullberry"), F.lit("black_mulberry")))
    assert taxonomy.taxonomy_plan(taxonomy.raw_mapping(fixed)).count() == 41
    assert len(PRE_MERGE_NAMES) == 7


def test_upload_mapping(spark):
    df = spark.createDataFrame([(n,) for n in ("jackfruit", "suger_apple", "sugarapple", "Mango", "hard", "kiwi", "caimito ")], "raw_label string")
    out = taxonomy.map_upload_label(df, ["jackfruit_cempedak", "sugar_apple", "caimito"])
    assert {r["raw_label"]: (r["true_label"], r["group"]) for r in out.collect()} == {
        "jackfruit": ("jackfruit_cempedak", "supported"),
        "suger_apple": ("sugar_apple", "supported"),
        "sugarapple": ("sugar_apple", "supported"),
        "Mango": (None, "unsupported_v1"),
        "hard": (None, "out_of_scope"),
        "kiwi": (None, "unknown_label"),
        "caimito ": ("caimito", "supported"),
    }


def test_metadata_and_folder(spark):
    df = spark.createDataFrame([("Bell Pepper", 7), ("kiwi_c", 1), ("?", 2)], "name string, n int")
    out = df.select("name", t.folder_name(t.class_metadata(F.col("name")), F.col("n")))
    assert dict(rows(out)) == {"Bell Pepper": "bell_pepper_ot_chuong_7", "kiwi_c": "kiwi_khong_ro_1", "?": "unknown_khong_ro_2"}


def test_prefix_names(spark):
    asked = spark.createDataFrame([(" Apple ",), ("bell",), ("none",), ("",)], "requested string")
    out = taxonomy.resolve_unique_prefix(asked, ["apple", "bell_pepper", "cape_a", "cape_b"])
    assert sorted(rows(out)) == [("apple",), ("bell_pepper",)]
    with pytest.raises(PySparkException, match="several classes"):
        taxonomy.resolve_unique_prefix(spark.createDataFrame([("cape",)], "requested string"), ["cape_a", "cape_b"]).collect()


def test_row_rules_accept_a_stream(spark, tmp_path):
    spark.createDataFrame([("Ridged Gourd",), ("mango_c",)], "name string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("name string").parquet(str(tmp_path / "in"))
    out = stream.select(t.merge_class(F.col("name")).alias("class"))
    q = out.writeStream.format("memory").queryName("merged").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination(60)
    assert sorted(rows(spark.table("merged"))) == [("gourd",), ("mango",)]
