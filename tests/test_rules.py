import pytest
from pyspark.sql import functions as F

from labelops.functions import quality as q
from labelops.functions import scores as sc


def test_quality_golden(spark):
    data = [(99, 6000, "image_too_small"), (100, 100, None), (5001, 200, "image_too_large"), (5000, 1250, None), (401, 100, "invalid_aspect_ratio"), (100, 401, "invalid_aspect_ratio")]
    df = spark.createDataFrame(data, "w int, h int, want string")
    assert df.where(~q.quality_reason(F.col("w"), F.col("h")).eqNullSafe(F.col("want"))).isEmpty()
    blur = spark.createDataFrame([(99.99,), (100.0,)], "s double").select(q.blur_reason(F.col("s")))
    assert [r[0] for r in blur.collect()] == ["blurry_image", None]


def test_letterbox_and_expand(spark):
    df = spark.createDataFrame([(640, 480, (320, 240, 0, 40)), (333, 500, (213, 320, 53, 0)), (5, 640, (2, 320, 159, 0))], "w int, h int, want struct<a:int,b:int,c:int,d:int>")
    for r in df.select("want", q.letterbox(F.col("w"), F.col("h"), 320, 320).alias("got")).collect():
        assert tuple(r["got"]) == tuple(r["want"])
    box = spark.sql("select named_struct('x1',10,'y1',10,'x2',60,'y2',110) b")
    assert tuple(box.select(q.expand_bbox(F.col("b"), F.lit(200), F.lit(200), 0.16)).first()[0]) == (2, 0, 68, 126)


CROPS = [
    (None, (0, 0, 0), "no_bbox"), ((5, 5, 5, 9), (0, 0, 0), "empty_bbox"), ((0, 0, 100, 100), (0, 0, 0), "bbox_area_too_small"),
    ((0, 0, 300, 300), (0, 0, 0), "bbox_area_too_large"), ((0, 0, 240, 90), (0, 0, 0), "bbox_pixel_side_too_small"),
    ((0, 0, 316, 110), (0, 0, 0), "bbox_aspect_too_skewed"), ((0, 0, 200, 200), (24, 11, 0.005), "weak_foreground_signal"),
    ((0, 0, 200, 200), (24, 12, 0.005), "crop_applied"),
]
BOX = "struct<x1:int,y1:int,x2:int,y2:int>"


def test_crop_gate(spark):
    data = [(i, 320, 320, b, *[float(x) for x in s]) for i, (b, s, _) in enumerate(CROPS)]
    df = spark.createDataFrame(data, f"i int, width int, height int, bbox {BOX}, texture double, contrast double, edge_density double")
    out = {r["i"]: r["crop"] for r in q.crop_decision(df).collect()}
    assert [out[i]["reason"] for i in range(len(CROPS))] == [c[2] for c in CROPS]
    assert out[0]["area_ratio"] == 0.0 and out[7]["applied"] and out[2]["texture"] == 0.0


def test_choose_crop(spark):
    data = [(1, (0, 0, 50, 50), None), (2, None, (10, 10, 60, 60)), (3, None, (0, 0, 1, 1)), (4, (0, 0, 100, 100), None)]
    df = spark.createDataFrame(data, f"i int, contour {BOX}, saliency {BOX}").withColumn("width", F.lit(100)).withColumn("height", F.lit(100))
    out = {r["i"]: r["crop"] for r in q.choose_crop(df).collect()}
    assert out[1]["method"] == "contour" and out[2]["method"] == "saliency" and tuple(out[2]["bbox"]) == (4, 4, 66, 66)
    assert out[3]["reason"] == "auto_failed:contour:no_bbox;saliency:bbox_too_small"
    assert out[4]["reason"] == "auto_failed:contour:bbox_too_large;saliency:no_bbox" and out[4]["area_ratio"] == 1.0
    one = {r["i"]: r["crop"] for r in q.choose_crop(df, "contour").collect()}
    assert one[2]["reason"] == "contour:no_bbox" and not one[2]["applied"]
    assert q.choose_crop(df, "none").first()["crop"]["reason"] == "disabled"
    with pytest.raises(ValueError):
        q.choose_crop(df, "x")


def test_bands_and_top_k(spark):
    df = spark.createDataFrame([(0.52, 0.84, 0.9), (0.01, 0.85, 0.10), (0.30, 0.85, 0.16)], "p double, c double, m double")
    out = df.select(sc.route_stage_a(F.col("p")), sc.route_stage_b(F.col("c"), F.col("m"))).collect()
    assert [tuple(r) for r in out] == [
        ("stage_a_fruit", "manual_review_low_confidence"), ("stage_a_other", "manual_review_ambiguous"),
        ("manual_review_stage_a_uncertain", "stage_b_supported_auto_accept"),
    ]
    probs = spark.createDataFrame([([0.2, 0.4, 0.4],)], "p array<double>")
    best = probs.select(sc.top_k(F.col("p"), ["a", "b", "c"], 9).alias("t"), sc.top2_margin(F.col("p"), ["a", "b", "c"]).alias("m")).first()
    assert [x["label"] for x in best["t"]] == ["b", "c", "a"] and best["m"]["margin"] == 0.0
    with pytest.raises(ValueError):
        sc.Bands(accept=0.1, reject=0.2)


def test_outcome_a(spark):
    want = {
        "supported": ("error", "manual_review", "wrong", "correct"), "unsupported_v1": ("error", "manual_review", "wrong", "wrong"),
        "out_of_scope": ("error", "manual_review", "correct", "wrong"), "unknown_label": ("error", "manual_review", "unknown_label", "unknown_label"),
    }
    routes = ("error", "low_confidence", "stage_a_other", "stage_b_supported")
    df = spark.createDataFrame([(g, r) for g in want for r in routes], "g string, r string")
    out = df.select("g", "r", sc.flow_outcome(F.col("g"), F.col("r"), F.lit("x"), F.lit("x")).alias("o")).collect()
    for r in out:
        status = want[r["g"]][routes.index(r["r"])]
        assert r["o"]["evaluation_status"] == status
        assert r["o"]["correct"] == {"correct": True, "wrong": False}.get(status)
    wrong = df.where("g = 'supported' and r = 'stage_b_supported'").select(sc.flow_outcome(F.col("g"), F.col("r"), F.lit("x"), F.lit("y")).alias("o")).first()["o"]
    assert wrong["evaluation_status"] == "wrong"


def test_outcome_b(spark):
    acc = "stage_b_supported_auto_accept"
    want = {
        ("supported", "manual_review_low_confidence"): ("manual_review", False, False), ("supported", "stage_a_other"): ("wrong_flow", False, True),
        ("supported", acc): ("correct_auto", True, False), ("unsupported_v1", "manual_review_unsupported"): ("correct_flow", True, False),
        ("unsupported_v1", "manual_review_ambiguous"): ("manual_review", True, False), ("unsupported_v1", "stage_a_other"): ("manual_review", True, False),
        ("unsupported_v1", acc): ("wrong_flow", False, True), ("out_of_scope", "manual_review_ambiguous"): ("acceptable_manual_review", True, False),
        ("out_of_scope", "stage_a_other"): ("correct_flow", True, False), ("out_of_scope", acc): ("wrong_flow", False, True),
        ("unknown_label", "manual_review_unknown_label"): ("manual_review", False, False), ("unknown_label", acc): ("unknown_evaluation", False, False),
        ("unknown_label", "stage_a_other"): ("unknown_evaluation", False, False), ("supported", "error"): ("error", False, False),
    }
    df = spark.createDataFrame(list(want), "g string, r string")
    out = df.select("g", "r", sc.production_outcome(F.col("g"), F.col("r"), F.lit("x"), F.lit("x")).alias("o")).collect()
    assert {(r["g"], r["r"]): (r["o"]["evaluation_result"], r["o"]["is_correct_flow"], r["o"]["is_wrong_flow"]) for r in out} == want


def test_final_route_precedence(spark):
    data = [("unsupported_v1", 0.0, None, None), ("unknown_label", 0.9, 0.9, 0.9), ("supported", 0.0, None, None), ("supported", 0.3, None, None),
            ("supported", 0.9, 0.9, 0.5), ("supported", None, None, None), ("supported", 0.9, None, None)]
    df = spark.createDataFrame(data, "g string, p double, c double, m double")
    out = [r[0] for r in df.select(sc.final_route(F.col("g"), F.col("p"), F.col("c"), F.col("m"))).collect()]
    assert out == ["manual_review_unsupported", "manual_review_unknown_label", "stage_a_other", "manual_review_stage_a_uncertain",
                   "stage_b_supported_auto_accept", "error", "error"]
