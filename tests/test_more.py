import numpy as np
from pyspark.sql import functions as F

from framewright import __main__ as cli
from framewright.operators import images, resume, vlm
from framewright.plans import pipelines


def jpeg(width, height):
    return b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes(12)


def test_jpeg_size(spark):
    df = spark.createDataFrame([(bytearray(jpeg(640, 360)),), (bytearray(b"no"),), (None,)], "image binary")
    assert [r.size and tuple(r.size) for r in images.with_size(df).collect()] == [(640, 360), None, None]


def test_by_files(spark):
    got = resume.by_files(spark.createDataFrame([("a",), ("b",), ("c",)], "vid string"), spark.createDataFrame([("a", 5), ("b", 0)], "vid string, size long"))
    assert {r.vid for r in got.collect()} == {"b", "c"}


def test_reader_gives_up():
    asked = []

    def start():
        asked.append(1)
        return lambda images: ["no"] * len(images)

    r = vlm.Reader(start)
    assert [r(["x"]) for _ in range(4)] == [[None]] * 4 and len(asked) == 4
    good = vlm.Reader(lambda: lambda images: [f"text of {i}" for i in images])
    assert good(["a", "b"]) == ["text of a", "text of b"]


def test_checked_text(spark):
    base = spark.createDataFrame([("v", "1", "XIN CHAO"), ("v", "2", " ")], "vid string, frame string, text string")
    frames = spark.createDataFrame([("v", "1", bytearray(b"x")), ("v", "2", bytearray(b"y"))], "vid string, frame string, image binary")
    got = {r.frame: r.text for r in vlm.checked_text(base, frames, lambda: lambda images: ["đây: Xin chào"] * len(images)).collect()}
    assert got == {"1": "XIN CHÀO", "2": " "}


def test_detections(spark):
    rng = np.random.default_rng(0)
    rows = [(1, k, 0.1 + 0.2 * k, 0.5, 0.1, 0.1, float(k), 0.5, -1.0, [float(x) for x in rng.normal(size=4)]) for k in range(4)] + [(1, 9, 0.7, 0.5, 0.1, 0.1, 2.5, 0.0, 1.0, [1.0, 0.0, 0.0, 0.0])]
    raw = spark.createDataFrame(rows, "img long, rid long, cx double, cy double, w double, h double, obj double, shift double, scale double, emb array<double>")
    got = pipelines.detection_plan(raw, spark.createDataFrame([(1, 200, 100), (2, 10, 10)], "img long, width int, height int"), slots=5).orderBy("img", "slot").collect()
    assert [r.objectness for r in got] == [3.0, 2.0, 1.0, 0.0, -1e4] + [-1e4] * 5  # rid 9 lies on a better one
    assert got[0].box.y2 == 1.0 and got[4].emb == [0.0] * 4 and abs(sum(x * x for x in got[0].emb) - 1) < 1e-2


def test_commands(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda name: spark)
    (tmp_path / "scenes").mkdir()
    (tmp_path / "scenes" / "L21_V001.scenes.txt").write_text("0 99\n100 110\n")
    (tmp_path / "cuts.json").write_text('{"L21_V001": [[40, 59]]}')
    s, o = str(tmp_path / "scenes"), str(tmp_path / "out")
    assert cli.main(["exclude-spans", "--scenes", s, "--spans", str(tmp_path / "cuts.json"), "--out", o]) == 0
    assert sorted((r.f_start, r.f_end) for r in spark.read.parquet(o).where("stage = 'excluded'").collect()) == [(0, 39), (60, 99), (100, 110)]
    cli.main(["resample", "--scenes", s, "--out", o, "--stride-sec", "2"])
    assert spark.read.parquet(o).where("stage = 'resampled'").count() == 3 and spark.read.parquet(o).select("stage").distinct().count() == 2
    cli.main(["keyframes", "--scenes", s, "--out", str(tmp_path / "kf")])
    assert [(r.keyframe_id, r.frame) for r in spark.read.parquet(str(tmp_path / "kf")).orderBy("kf").collect()] == [("0001", 49), ("0002", 105)]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "L21_V001.csv").write_text("time_start_ms,time_end_ms,text\n0,10,a b\n10,20,\n")
    for _ in range(2):
        cli.main(["embed-transcript", "--transcripts", str(tmp_path / "t"), "--out", str(tmp_path / "e")])
        assert {r.vec_id for r in spark.read.parquet(str(tmp_path / "e")).collect()} == {210010000, 210010001}
    (tmp_path / "sh").mkdir()
    np.save(tmp_path / "sh" / "a.npy", np.eye(2, 3, dtype=np.float16))
    np.save(tmp_path / "sh" / "a.ids.npy", np.array([7, 8]))
    cli.main(["build-index", "--shards", str(tmp_path / "sh"), "--out", str(tmp_path / "ix"), "--bit-width", "2"])
    assert {r.vec_id: r.codes for r in spark.read.parquet(str(tmp_path / "ix")).collect()} == {7: [3, 0, 0], 8: [0, 3, 0]}
    frames = spark.createDataFrame([("a", t, [t * 20 % 100] * 4) for t in range(20)], "vid string, t long, px array<short>")
    frames.write.parquet(str(tmp_path / "f"))
    cli.main(["find-ad-span", "--frames", str(tmp_path / "f"), "--out", str(tmp_path / "ad"), "--ref-video", "a", "--ref-start", "25", "--ref-end", "50", "--max-score", "0"])
    assert spark.read.parquet(str(tmp_path / "ad")).where(F.col("f_start") == 25).count() == 1
