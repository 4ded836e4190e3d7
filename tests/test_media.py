"""Decoders, models, archives, audio and long series, with stand-ins of their own."""

import http.server
import sys
import threading
import time
import wave
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright import __main__ as cli
from framewright.operators import models, shards, signal
from framewright.plans import pipelines
from framewright.sources import archives, decode, readers

DECODER = '''import sys
args = sys.argv[1:]
path, filters = args[args.index("-i") + 1], args[args.index("-vf") + 1]
raw = open(path, "rb").read()
if raw == b"bad" or "-c:v" in args and args[args.index("-c:v") + 1] == "broken":
    sys.exit("cannot read it")
n = filters.count("eq(n") - (raw == b"short")
for k in range(n):
    sys.stdout.buffer.write(b"\\xff\\xd8\\xff\\xc0\\x00\\x11\\x08\\x00\\x90\\x01\\x00" + b"%d" % k + raw + (b"cover" if "drawbox" in filters else b"") + b"\\xff\\xd9")
'''


@pytest.fixture
def fake(tmp_path):
    (tmp_path / "decoder.py").write_text(DECODER)
    return [sys.executable, str(tmp_path / "decoder.py")]


def test_extract_keyframes(spark, tmp_path, fake):
    for name in ("good", "bad", "short", "fallback"):
        (tmp_path / name).write_bytes(name.encode())
    frames = spark.createDataFrame([(v, k + 1, 10 * k) for v in ("good", "bad", "short", "fallback") for k in range(3)], "vid string, kf long, frame long")
    files = spark.createDataFrame([(v, str(tmp_path / v), "broken" if v == "fallback" else None, v == "good") for v in ("good", "bad", "short", "fallback")], "vid string, path string, decoder string, overlay boolean")
    rows = decode.extract_keyframes(frames, files, fake).collect()
    assert {(r.vid, r.kf, r.frame) for r in rows if r.image} == {(v, k + 1, 10 * k) for v in ("good", "fallback") for k in range(3)}
    assert all((b"cover" in r.image) == (r.vid == "good") for r in rows if r.image)
    assert {r.vid: r.error for r in rows if r.kf is None} == {"bad": "cannot read it", "short": "2 of 3 frames"}
    held = files.where("vid = 'good'").select("vid", F.lit(b"good").cast("binary").alias("content"))
    assert decode.extract_keyframes(frames, held, fake).where("image is not null").count() == 3


def test_models_by_row(spark):
    def load():
        def run(values):
            if "bad" in values:
                raise ValueError("no")
            return [[{"quad": [{"x": 0.0, "y": float(k)}], "line": v, "p": 0.9 - 0.5 * k} for k in range(2)] for v in values]

        return run

    df = spark.createDataFrame([("v", "1", "a"), ("v", "2", "bad"), ("v", "3", "c")], "vid string, frame string, image string").coalesce(1)
    got = {r.frame: (r.text, r.error) for r in pipelines.ocr_plan(df, models.Runner("ocr-test", models.LINES, load)).collect()}
    assert got == {"1": ("a", None), "2": ("", "ValueError: no"), "3": ("c", None)}


def test_speech_at_its_own_rate(spark):
    runner = models.Runner("speech-test", models.SPEECH, lambda: lambda values: [f" {len(v['samples'])} AT {v['rate']} " for v in values])
    rows = spark.createDataFrame([("a", 100, [0.5] * 4000), ("b", 10, [0.5] * 90), ("c", 100, [0.5] * 99)], "vid string, rate int, samples array<float>")
    got = pipelines.speech_plan(rows, runner).orderBy("vid", "idx").collect()
    assert [(r.vid, r.time_start_ms) for r in got][:1] == [("a", 0)] and {r.vid for r in got} == {"a", "b"}
    assert [r.text for r in got if r.vid == "b"] == ["90 at 10"] and [r.time_end_ms for r in got if r.vid == "b"] == [9000]
    assert 19_000 <= got[0].time_end_ms <= 21_000


def test_detect_plan(spark):
    image = b"\xff\xd8\xff\xc0\x00\x11\x08\x00\x64\x00\xc8" + bytes(12)
    box = {"cx": 0.5, "cy": 0.25, "w": 0.5, "h": 0.5, "obj": 2.0, "shift": 0.0, "scale": 0.0, "emb": [3.0, 4.0]}
    runner = models.Runner("boxes-test", models.DETECTIONS, lambda: lambda values: [[box] for _ in values])
    got = pipelines.detect_plan(spark.createDataFrame([(7, bytearray(image))], "img long, image binary"), runner, slots=2).orderBy("slot").collect()
    assert [r.objectness for r in got] == [2.0, -1e4] and got[0].box.y2 == 1.0 and got[0].emb == pytest.approx([0.6, 0.8], abs=1e-3)


class _Server(http.server.BaseHTTPRequestHandler):
    body, failures, ranges = b"", 0, True

    def _send(self, head: bool) -> None:
        cls = type(self)
        if cls.failures:
            cls.failures -= 1
            self.send_error(503)
            return
        part, status = cls.body, 200
        if cls.ranges and "Range" in self.headers:
            a, z = map(int, self.headers["Range"][6:].split("-"))
            part, status = cls.body[a : z + 1], 206
        self.send_response(status)
        self.send_header("Content-Length", str(len(part)))
        self.end_headers()
        if not head:
            self.wfile.write(part)

    def do_HEAD(self):  # noqa: N802
        self._send(True)

    def do_GET(self):  # noqa: N802
        self._send(False)

    def log_message(self, *_):
        pass


@pytest.fixture
def server():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Server)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/x.zip"
    s.shutdown()


def test_range_file(server):
    _Server.body, _Server.failures, _Server.ranges = bytes(range(256)) * 8, 2, True
    f = archives.RangeFile(server, wait=0.01)
    f.seek(100)
    assert f.read(20) == _Server.body[100:120]
    _Server.ranges = False
    with pytest.raises(OSError, match="ranges"):
        f.read(20)


def test_zip_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one.mp4", b"a" * 5000, zipfile.ZIP_STORED)
        z.writestr("two.mp4", b"b" * 5000, zipfile.ZIP_DEFLATED)
        z.writestr("three.txt", b"c")
    spark.dataSource.register(archives.ZipMembers)
    rows = {r.name: bytes(r.content) for r in spark.read.format("zip_members").option("path", str(tmp_path / "a.zip")).load().collect()}
    assert rows == {"one.mp4": b"a" * 5000, "two.mp4": b"b" * 5000}


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_wav(spark, tmp_path, width):
    x = np.array([-0.5, 0.0, 0.25, 0.5])
    whole = np.round(x * (1 << (8 * width - 1))).astype(np.int64) + (128 if width == 1 else 0)
    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(width)
        w.setframerate(100)
        w.writeframes(b"".join(int(v).to_bytes(width, "little", signed=width > 1) for v in whole))
    row = readers.wav_samples(spark, str(tmp_path)).first()
    assert row.rate == 100 and row.samples == pytest.approx(x.tolist(), abs=1e-6)


def test_search_is_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(300, 8)), rng.normal(size=(5, 8))
    index = shards.build_index(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, vec array<double>"), 4).repartition(3)
    plain = {r.vec_id: np.array(r.codes) * r.step + r.lo for r in index.collect()}
    queries = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(q)], "query_id long, vec array<double>")
    for most in (shards.QUERY_BYTES, 100):
        monkeypatch.setattr(shards, "QUERY_BYTES", most)
        got = shards.search(index, queries, 7).orderBy("query_id", "place").collect()
        for k, v in enumerate(q):
            want = sorted(plain, key=lambda i: (-float(v @ plain[i]), i))[:7]
            assert [r.vec_id for r in got if r.query_id == k] == want


def slides(spark, scenes, frames):
    got = pipelines.slide_plan(spark.createDataFrame(scenes, "vid long, ord long, f_start long, f_end long"), spark.createDataFrame([(1, t, p.ravel().tolist()) for t, p in enumerate(frames)], "vid long, t long, px array<short>"), 30.0, 2.0, 32, 32)
    return sorted((r.ord, r.f_start, r.f_end) for r in got.collect())


def test_slides_of_each_scene_alone(spark):
    rng = np.random.default_rng(0)
    still, after = rng.integers(0, 256, (2, 32, 32))
    moving = rng.integers(0, 256, (60, 32, 32))
    frames = [*moving, *[still] * 30, *[after] * 30]
    first, second = (1, 0, 0, 899), (1, 1, 900, 1799)
    alone = slides(spark, [second], frames)
    assert alone == [(1, 900, 1342 - 1), (1, 1342, 1799)]
    both = slides(spark, [first, second], frames)
    assert [x for x in both if x[0] == 1] == alone


def test_long_series(spark):
    """7,200 frames of 256 x 144 and an hour of audio: a task holds one run, or one recording's samples."""
    n, height, width = 7200, 144, 256
    px = F.expr(f"transform(sequence(0, {height * width - 1}), k -> cast((k * 7 + (t div 3600) * 90) % 256 as short))")
    frames = spark.range(n, numPartitions=32).select(F.lit(1).cast("long").alias("vid"), F.col("id").alias("t")).select("vid", "t", px.alias("px"))
    started = time.time()
    masks = signal.motion_masks(frames, width, ["vid"])
    scores = signal.slide_scores(frames, masks, width, ["vid"]).where("score > 0").collect()
    assert [(r.t, r.score) for r in scores] == [(3600, 1.0)]
    rate = 8000
    blocks = spark.range(3600 * rate // (1 << 16) + 1).select(F.lit(1).cast("long").alias("vid"), (F.col("id") * (1 << 16)).alias("at")).withColumn("smp", F.expr(f"transform(sequence(0, {(1 << 16) - 1}), k -> cast((at + k) % 977 as double))"))
    cuts = signal.chunks_of_blocks(blocks, 20 * rate, rate, 160, rate).orderBy("idx").collect()
    assert cuts[0].s0 == 0 and all(a.s1 == b.s0 for a, b in zip(cuts, cuts[1:])) and 170 <= len(cuts) <= 190
    assert time.time() - started < 600


def _fake_ocr():
    return lambda images: [[{"quad": [{"x": 0.0, "y": 0.0}], "line": f"line {len(x)}", "p": 1.0}] for x in images]


def _fake_boxes():
    return lambda images: [[{"cx": 0.5, "cy": 0.5, "w": 0.2, "h": 0.2, "obj": 1.0, "shift": 0.0, "scale": 0.0, "emb": [1.0, 0.0]}] for _ in images]


def _fake_speech():
    return lambda values: ["Said" for _ in values]


def test_model_commands(spark, tmp_path, monkeypatch, fake):
    monkeypatch.setattr(cli, "session", lambda name: spark)
    (tmp_path / "scenes").mkdir()
    (tmp_path / "scenes" / "L21_V001.scenes.txt").write_text("0 99\n100 110\n")
    with zipfile.ZipFile(tmp_path / "v.zip", "w") as z:
        z.writestr("L21_V001.mp4", b"video")
    out = str(tmp_path / "kf")
    cli.main(["stream-extract-keyframes", "--archive", str(tmp_path / "v.zip"), "--scenes", str(tmp_path / "scenes"), "--out", out, "--ffmpeg", " ".join(fake)])
    rows = spark.read.parquet(out).orderBy("kf").collect()
    assert [(r.keyframe_id, r.frame) for r in rows] == [("0001", 49), ("0002", 105)]
    (tmp_path / "jpg" / "L21_V001").mkdir(parents=True)
    for r in rows:
        (tmp_path / "jpg" / "L21_V001" / f"{r.keyframe_id}.jpg").write_bytes(r.image)
    jpg, here = str(tmp_path / "jpg"), "tests.test_media:"
    for _ in range(2):
        cli.main(["embed-keyframes", "--keyframes", jpg, "--out", str(tmp_path / "emb"), "--slot", "dinov3"])
        assert {(r.vec_id, len(r.vec)) for r in spark.read.parquet(str(tmp_path / "emb")).collect()} == {(210010001, 1024), (210010002, 1024)}
    cli.main(["ocr-keyframes", "--keyframes", jpg, "--out", str(tmp_path / "ocr"), "--model", here + "_fake_ocr"])
    assert "line" in spark.read.text(str(tmp_path / "ocr")).first().value
    cli.main(["detect-keyframes", "--keyframes", jpg, "--out", str(tmp_path / "det"), "--model", here + "_fake_boxes", "--slots", "3"])
    assert spark.read.parquet(str(tmp_path / "det")).where("objectness = 1").count() == 2
    (tmp_path / "wav").mkdir()
    for name, rate in (("a", 8000), ("b", 100)):
        with wave.open(str(tmp_path / "wav" / f"{name}.wav"), "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(2)
            w.setframerate(rate)
            w.writeframes(np.ones(30 * rate, "<i2").tobytes())
    cli.main(["extract-transcript", "--audio", str(tmp_path / "wav"), "--out", str(tmp_path / "tr"), "--model", here + "_fake_speech"])
    got = spark.read.option("header", True).csv(str(tmp_path / "tr")).collect()
    assert {r.text for r in got} == {"said"} and len(got) == 4


def test_spans_of_earlier_runs_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda name: spark)
    frames = [(v, t, [(t * 20 + s) % 100] * 4) for v, s in (("a", 0), ("b", 3)) for t in range(20)]
    spark.createDataFrame(frames, "vid string, t long, px array<short>").write.parquet(str(tmp_path / "f"))
    spark.createDataFrame([("b", 50.0)], "vid string, fps double").write.parquet(str(tmp_path / "rates"))
    run = lambda *more: cli.main(["find-ad-span", "--frames", str(tmp_path / "f"), "--out", str(tmp_path / "ad"), "--ref-start", "25", "--ref-end", "50", "--max-score", "0", "--rates", str(tmp_path / "rates"), *more])
    run("--ref-video", "a")
    one = set(spark.read.parquet(str(tmp_path / "ad")).collect())
    run("--ref-video", "b")
    both = set(spark.read.parquet(str(tmp_path / "ad")).collect())
    assert one < both and {r.vid for r in both} == {"a", "b"} and all(r.f_start % 25 == 0 for r in both if r.vid == "b")


def test_index_wants_single_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda name: spark)
    for name in "ab":
        np.save(tmp_path / f"{name}.npy", np.eye(2, 3, dtype=np.float16))
        np.save(tmp_path / f"{name}.ids.npy", np.array([7, 8]))
    with pytest.raises(SystemExit, match="several"):
        cli.main(["build-index", "--shards", str(tmp_path), "--out", str(tmp_path / "ix")])


def test_split_images():
    assert decode.split_images(b"") == []
    assert decode.split_images(b"\xff\xd8a\xff\xd9\xff\xd8b\xff\xd9") == [b"\xff\xd8a\xff\xd9", b"\xff\xd8b\xff\xd9"]
