import math
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions import boxes, ids, numeric, text


def one(spark, col, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(col.alias("v")).first()["v"]


def test_documented_ids(spark):
    assert one(spark, ids.video_head(F.col("v")), v="L21_V001") == 21001
    assert one(spark, ids.vector_id(F.col("v"), F.col("k")), v="L21_V001", k="0001") == 210010001
    for v in ("L21_V001", "S01-V001", "N001-V001", "M01_V001"):
        vid, frame = ids.split_vector_id(ids.vector_id(F.col("v"), F.lit("0042")))
        assert one(spark, F.struct(vid, frame), v=v)[:] == (v, "0042")
    assert one(spark, ids.video_head(F.col("v")), v="L21-V1") == 21001  # either separator, any padding


@pytest.mark.parametrize("bad", ["X21_V001", "L1000_V001", "L21_V1000", "L21V001", "L21_V001 ", "L99999999999999999999_V1"])
def test_bad_ids(spark, bad):
    assert one(spark, ids.try_video_head(F.col("v")), v=bad) is None
    with pytest.raises(Exception, match="not a video id"):
        one(spark, ids.video_head(F.col("v")), v=bad)


def test_frame_range(spark):
    with pytest.raises(Exception, match="out of range"):
        one(spark, ids.vector_id(F.col("v"), F.col("k")), v="L21_V001", k="10000")


def test_base_form(spark):
    assert one(spark, text.base_form(F.col("v")), v="CHỦ Y") == "chu y"
    assert one(spark, text.base_form(F.col("v")), v="Đường é") == "duong e"


def test_strip_and_blank(spark):
    assert one(spark, text.normalize_transcript(F.col("v")), v="  Ab C \n") == "ab c"
    assert one(spark, text.fill_blank(F.col("v")), v="　\t") == " "
    assert one(spark, text.fill_blank(F.col("v")), v=" x ") == " x "


def test_find_run(spark):
    run = lambda h, n: spark.createDataFrame([(h, n)], "h array<string>, n array<string>").select(text.find_run(F.col("h"), F.col("n"))).first()[0]
    assert run(["a", "b", "a", "c"], ["a", "c"]) == 2
    assert run(["a"], ["a", "b"]) is None
    assert run([], ["a"]) is None
    assert run(["a"], []) == 0


def direct_base(s):
    s = unicodedata.normalize("NFD", s.translate(str.maketrans("đĐ", "dd")).lower())
    return "".join(c for c in s if not unicodedata.combining(c))


def direct_reconcile(base, vlm):
    """Line by line, as the rule reads."""
    said = re.findall(r"\w+", vlm)
    flat = [direct_base(w) for w in said]
    out = []
    for line in base.split("\n"):
        own = [direct_base(w) for w in re.findall(r"\w+", line)]
        at = next((i for i in range(len(flat) - len(own) + 1) if flat[i : i + len(own)] == own), None) if own else None
        if at is None:
            out.append(line)
        else:
            fixed = " ".join(said[at : at + len(own)])
            out.append(fixed.upper() if line.isupper() else fixed)
    return "\n".join(out)


def test_reconcile_lines(spark):
    cases = [("XIN CHAO\nban, toi\n--\nkhong co", "Xin chào bạn, tôi đây"), ("", "x"), ("a\na b", ""), ("b a", "a b a b"), ("a b", "aa b a bb a b"), ("HA NOI 1", "hà nội 1, Hà Nội 2")]
    got = spark.createDataFrame(cases, "b string, v string").select(text.reconcile_lines(F.col("b"), F.col("v")).alias("r")).collect()
    assert [r.r for r in got] == [direct_reconcile(*c) for c in cases]
    assert one(spark, text.reconcile_lines(F.col("b"), F.lit(None).cast("string")), b="a b") == "a b"


def test_reconcile_documents(spark, sf):
    from framewright.catalog import _ocr

    rows = _ocr(spark, sf).withColumn("got", text.reconcile_lines(F.col("text"), F.col("vlm_text"))).collect()
    for r in rows[:60]:
        assert r.got == direct_reconcile(r.text, r.vlm_text)


def test_half(spark):
    values = [0.0, -0.0, 0.1, 1 / 3, 1e-8, 6e-8, 65504.0, 65519.0, 65520.0, -70000.0, 2049.0, 2051.0, 5.96e-8]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(numeric.half(F.col("x")).alias("h")).collect()
    with np.errstate(over="ignore"):
        assert [r.h for r in got] == [float(np.float16(v)) for v in values]


def test_frame_rate(spark):
    for raw, want in (("30000/1001", 30000 / 1001), ("25", 25.0), ("30/0", 25.0), ("", 25.0), ("x/2", 25.0), ("0/0", 25.0), ("50/2", 25.0)):
        assert one(spark, numeric.frame_rate(F.col("r")), r=raw) == pytest.approx(want)
    assert one(spark, numeric.duration_ms(F.col("r")), r="0.0025") == 2
    assert one(spark, numeric.duration_ms(F.col("r")), r="x") == 0


def test_half_even(spark):
    got = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double").select(numeric.half_even(F.col("x")).alias("n")).collect()
    assert [r.n for r in got] == [0, 2, 2, 0]


def test_quantize(spark):
    q = one(spark, numeric.quantize(F.col("v"), 2), v=[0.0, 1.0, 2.0, 3.0])
    assert (q.codes, q.lo, q.step) == ([0, 1, 2, 3], 0.0, 1.0)
    assert one(spark, numeric.quantize(F.col("v"), 4), v=[2.0, 2.0]).codes == [0, 0]
    with pytest.raises(ValueError):
        numeric.quantize(F.col("v"), 5)


def test_tile_grid(spark):
    grid = lambda w, h: one(spark, boxes.tile_grid(F.col("w"), F.col("h")), w=w, h=h)[:]
    assert grid(100, 100) == (1, 1)
    assert grid(1000, 1000) == (2, 2)  # a tie on aspect, and area enough
    assert grid(900, 300) == (3, 1)
    assert grid(300, 1800) == (1, 6)


def test_iou(spark):
    box = lambda *b: F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), b)])
    assert one(spark, boxes.iou(box(0, 0, 2, 2), box(1, 1, 3, 3)), x=1) == pytest.approx(1 / 7)
    assert one(spark, boxes.iou(box(0, 0, 0, 0), box(0, 0, 0, 0)), x=1) == 0


def test_elu(spark):
    assert one(spark, numeric.elu_scale(F.col("x")), x=-1.0) == pytest.approx(math.exp(-1))
    assert one(spark, numeric.elu_scale(F.col("x")), x=2.0) == 3
