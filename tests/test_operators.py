import random
import zipfile

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framewright.operators import detections, encoders, images, peaks, resume, shards, signal, spans
from framewright.sources import archives, readers, writers
from framewright.streaming import ingest


def spans_df(spark, rows):
    return spark.createDataFrame(rows, "vid long, ord long, f_start long, f_end long")


def test_exclude_is_sequential_subtraction(spark):
    rng = random.Random(4)
    rows, cuts, want = [], [], []
    for vid in range(60):
        at = 0
        mine = [(a, a + rng.randrange(60)) for a in (rng.randrange(400) for _ in range(rng.randrange(6)))]
        cuts += [(vid, a, z) for a, z in mine]
        for n in range(5):
            z = at + rng.randrange(5, 90)
            rows.append((vid, n, at, z))
            left = [(at, z)]
            for a, b in mine:
                after = []
                for s, e in left:
                    if b < s or a > e:
                        after.append((s, e))
                    else:
                        after += [(x, y) for x, y in ((s, a - 1), (b + 1, e)) if y - x + 1 >= 10]
                left = after
            want += [(vid, n, s, e) for s, e in left]
            at = z + 1
    got = spans.exclude_spans(spans_df(spark, rows), spark.createDataFrame(cuts, "vid long, c_start long, c_end long")).select("vid", "ord", "f_start", "f_end").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_subdivide_parts(spark):
    rows = [(1, 0, 0, 9), (1, 1, 10, 40), (1, 2, 41, 41), (2, 0, 5, 104)]
    got = spans.subdivide(spans_df(spark, rows), F.lit(10)).orderBy("vid", "ord", "cell").collect()
    by = {}
    for r in got:
        by.setdefault((r.vid, r.ord), []).append((r.f_start, r.f_end))
    assert by[1, 0] == [(0, 9)] and by[1, 2] == [(41, 41)]
    for v, o, s, e in rows:
        p = by[v, o]
        assert p[0][0] == s and p[-1][1] == e and all(x[1] + 1 == y[0] for x, y in zip(p, p[1:]))
    assert len(by[2, 0]) == 10 and len(by[1, 1]) == 3


def test_split_spans(spark):
    got = spans.split_spans(spans_df(spark, [(1, 0, 0, 100), (1, 1, 101, 120)]), spark.createDataFrame([(1, 3), (1, 30), (1, 35), (1, 97), (1, 110)], "vid long, at long"), 10, 50)
    assert sorted((r.f_start, r.f_end) for r in got.collect()) == [(0, 29), (30, 100), (101, 120)]


def direct_picks(score, ok, best, gap):
    out, k = [], 0
    while k < len(score):
        if not ok(k):
            k += 1
            continue
        z = k
        while z + 1 < len(score) and ok(z + 1):
            z += 1
        at = min(range(k, z + 1), key=lambda i: (best * score[i], i))
        if not out or at - out[-1] >= gap:
            out.append(at)
        k = z + 1
    return out


def test_picks(spark):
    rng = random.Random(2)
    series = {v: [rng.randrange(10) / 2 for _ in range(rng.randrange(1, 80))] for v in range(20)}
    df = spark.createDataFrame([(v, i, s) for v, x in series.items() for i, s in enumerate(x)], "vid long, idx long, score double")
    got = {(r.vid, r.idx) for r in peaks.peaks(df, 2.5, 4).collect()}
    assert got == {(v, i) for v, x in series.items() for i in direct_picks(x, lambda k, x=x: k >= 1 and x[k] > 2.5, -1, 4)}
    got = {(r.vid, r.idx) for r in peaks.find_matches(df, 2.5, 0, 3).collect()}
    assert got == {(v, i) for v, x in series.items() for i in direct_picks(x, lambda k, x=x: x[k] <= 2.5, 1, 3)}


def test_match_scores(spark):
    rng = np.random.default_rng(1)
    f = rng.integers(0, 256, (12, 6))
    df = spark.createDataFrame([(1, t, f[t].tolist()) for t in range(12)], "vid long, t long, px array<short>")
    ref = spark.createDataFrame([(t, f[t + 4].tolist()) for t in range(3)], "t long, px array<short>")
    got = {r.idx: r.score for r in peaks.match_scores(df, ref, 3).collect()}
    assert len(got) == 10 and got[4] == 0
    for i in range(10):
        assert got[i] == pytest.approx(np.abs(f[i : i + 3] - f[4:7]).mean())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-50, 50), max_size=200), st.integers(5, 40), st.integers(1, 4), st.integers(1, 6))
def test_silence_chunks_part_everything(x, chunk, search, frame):
    got = signal.split_on_silence(np.array(x), chunk, search, frame, 5)
    assert [a for a, _ in got] == ([0] + [z for _, z in got[:-1]] if got else [])
    assert (got[-1][1] if got else 0) == len(x)


def test_change_scores(spark):
    rng = np.random.default_rng(3)
    f = rng.integers(0, 256, (4, 8, 8))
    df = spark.createDataFrame([(1, t, f[t].ravel().tolist()) for t in range(4)], "vid long, t long, px array<short>")
    px = signal.pixels(df, 8)
    mask = px.select("vid", "y", "x").distinct().withColumn("keep", F.col("y") + F.col("x") != 3)
    got = {r.t: r.score for r in signal.change_scores(px, mask, 8, 8, 14, 4, 5).collect()}
    pad = np.pad(f, ((0, 0), (1, 1), (1, 1)), "reflect")
    k = np.array([1, 2, 1])
    blur = sum(k[a] * k[b] * pad[:, a : a + 8, b : b + 8] for a in range(3) for b in range(3)) / 16
    keep = np.add.outer(np.arange(8), np.arange(8)) != 3
    want = {0: 0.0}
    for t in range(1, 4):
        hit = (np.abs(blur[t] - blur[t - 1]) > 14) & keep
        want[t] = max(hit[y : y + 4, x : x + 4].sum() / keep[y : y + 4, x : x + 4].sum() for y in (0, 4) for x in (0, 4))
    assert got == pytest.approx(want)


def test_motion_mask_alone(spark):
    df = spark.createDataFrame([(1, 0, [1, 2, 3, 4])], "vid long, t long, px array<short>")
    assert all(r.keep for r in signal.motion_mask(signal.pixels(df, 2)).collect())


def test_greedy_nms(spark):
    rng = np.random.default_rng(5)
    rows = []
    for img in range(6):
        c = rng.random((120, 2))
        for k in range(120):
            rows.append((img, k, float(rng.integers(0, 50)), (float(c[k, 0]), float(c[k, 1]), float(c[k, 0] + 0.3), float(c[k, 1] + 0.3))))
    df = spark.createDataFrame(rows, "img long, rid long, obj double, box struct<x1:double,y1:double,x2:double,y2:double>")
    got = {}
    for r in detections.greedy_nms(df, 100, 0.5, 20).orderBy("img", "slot").collect():
        got.setdefault(r.img, []).append(r.rid)

    def iou(a, b):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        if w <= 0 or h <= 0:
            return 0
        area = lambda q: (q[2] - q[0]) * (q[3] - q[1])
        return w * h / (area(a) + area(b) - w * h)

    for img in range(6):
        best = sorted((r for r in rows if r[0] == img), key=lambda r: (-r[2], r[1]))[:100]
        kept = []
        for r in best:
            if all(iou(r[3], k[3]) <= 0.5 for k in kept):
                kept.append(r)
        assert got[img] == [r[1] for r in kept[:20]]


def test_pad_slots(spark):
    kept = spark.createDataFrame([(1, 0, 5.0)], "img long, slot long, obj double")
    out = detections.pad_slots(kept, spark.createDataFrame([(1,), (2,)], "img long"), {"obj": detections.EMPTY}, 2).orderBy("img", "slot").collect()
    assert [tuple(r) for r in out] == [(1, 0, 5.0), (1, 1, -1e4), (2, 0, -1e4), (2, 1, -1e4)]


def test_shards_require(spark):
    v = spark.createDataFrame([(1, 0, [1.0, 2.0]), (2, 0, [1.0])], "vid long, row long, vec array<double>")
    i = spark.createDataFrame([(1, 0, 7), (2, 0, 8)], "vid long, row long, vec_id long")
    checked = shards.validate(v, i)
    assert {r.vid: r.ok for r in checked.collect()} == {1: True, 2: False}
    with pytest.raises(Exception, match="bad shard 2"):
        shards.require_valid(checked).collect()


def test_resume_keys(spark):
    want = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "vid long, key long")
    done = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 9), (4, 1)], "vid long, key long")
    assert {r.vid for r in resume.by_keys(want, done).collect()} == {2, 3}


def test_encoder_errors_stay_with_their_row(spark):
    def load():
        good = encoders.stub("m", 4)

        def f(values):
            if "bad" in values:
                raise ValueError("no")
            return good(values)

        return f

    df = spark.createDataFrame([("a",), ("bad",), ("b",)], "x string").coalesce(1)
    got = encoders.encode(df, "x", encoders.Model("m", 4, "text", load)).collect()
    assert [r.error for r in got] == [None, "ValueError: no", None] and got[1].vec is None and len(got[0].vec) == 4


def test_black_out(spark):
    df = spark.createDataFrame([(1, 0, [9] * (100 * 50))], "vid long, t long, px array<short>")
    p = np.array(images.black_out(df, 100, 50).first().px).reshape(100, 50)
    assert (p[90:96] == 0).all() and (p[7:16, 40:46] == 0).all() and p[50, 10] == 9 and p[97, 0] == 9


def test_scene_files(spark, tmp_path):
    (tmp_path / "A.scenes.txt").write_text("0 5\n\n6  9\r\n")
    (tmp_path / "B.scenes.txt").write_text("")
    got = readers.read_scenes(spark, str(tmp_path)).orderBy("ord").collect()
    assert [tuple(r) for r in got] == [("A", 0, 0, 5), ("A", 1, 6, 9)]
    (tmp_path / "C.scenes.txt").write_text("1 2 3\n")
    with pytest.raises(Exception, match="bad scene line"):
        readers.read_scenes(spark, str(tmp_path)).collect()
    assert readers.read_scenes(spark, str(tmp_path), strict=False).count() == 2
    writers.write_scenes(readers.read_scenes(spark, str(tmp_path), strict=False), str(tmp_path / "out"), "raw")
    assert spark.read.parquet(str(tmp_path / "out")).where("stage = 'raw'").count() == 2


def test_transcripts_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0, 0, 10, 'x "q", y\nz'), ("a", 1, 10, 20, "")], "vid string, idx long, time_start_ms long, time_end_ms long, text string")
    writers.write_transcripts(rows, str(tmp_path / "t"))
    part = next((tmp_path / "t" / "vid=a").glob("*.csv"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(part.read_bytes())
    assert [tuple(r) for r in readers.read_transcripts(spark, str(tmp_path / "in")).orderBy("idx").collect()] == [tuple(r) for r in rows.collect()]


def test_videos_and_info(spark, tmp_path):
    for n in ("b.MP4", "a.webm", "a.mkv", "c.txt"):
        (tmp_path / n).write_bytes(b"x")
    assert [(r.vid, r.path[-5:]) for r in readers.find_videos(spark, str(tmp_path)).orderBy("vid").collect()] == [("a", "a.mkv"), ("b", "b.MP4")]
    assert readers.find_videos(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "a.json").write_text('{"author": "Z", "x": [1]}')
    assert [tuple(r) for r in readers.read_media_info(spark, str(tmp_path)).collect()] == [("a", "Z")]
    (tmp_path / "cuts.json").write_text('{"a": [[1, 2], [5, 9]]}')
    got = readers.read_cut_spans(spark, str(tmp_path / "cuts.json"))
    assert {tuple(r) for r in got.collect()} == {("a", 1, 2), ("a", 5, 9)}
    assert writers.cut_spans_json(got).first().value == '{"a":[[1,2],[5,9]]}'


def test_npy_shards(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.arange(6, dtype=np.float16).reshape(2, 3))
    np.save(tmp_path / "a.ids.npy", np.array([7, 8]))
    np.save(tmp_path / "b.npy", np.zeros((1, 3), np.float16))
    got = readers.read_shards(spark, str(tmp_path)).orderBy("row").collect()
    assert [(r.vid, r.vec_id, r.vec) for r in got] == [("a", 7, [0.0, 1.0, 2.0]), ("a", 8, [3.0, 4.0, 5.0])]


def test_zip_members(spark, tmp_path):
    path = tmp_path / "v.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("x/a.mp4", b"hello video")
        z.writestr("b.txt", b"no")
        z.writestr("c.mp4", b"")
    spark.dataSource.register(archives.ZipMembers)
    raw = path.read_bytes()
    got = spark.read.format("zip_members").option("path", str(path)).load().orderBy("name").collect()
    assert [(r.name, bytes(r.content)) for r in got] == [("c.mp4", b""), ("x/a.mp4", b"hello video")]
    one = got[1]
    assert raw[one.first_byte : one.last_byte + 1] == b"hello video"
    df = spark.createDataFrame([(bytearray(raw[one.header_offset : one.header_offset + 100]), one.header_offset, 11)], "h binary, o long, n long")
    r = df.select(archives.entry_range(F.col("h"), F.col("o"), F.col("n")).alias("r")).first().r
    assert (r.start, r.end) == (one.first_byte, one.last_byte)


def test_wav(spark, tmp_path):
    import wave

    with wave.open(str(tmp_path / "a.wav"), "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(np.array([[16384, 0], [0, -16384]], "<i2").tobytes())
    r = readers.wav_samples(spark, str(tmp_path)).first()
    assert (r.vid, r.rate, r.samples) == ("a", 8000, [0.25, -0.25])


def test_ingest_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.scenes.txt").write_text("0 5\n6 9\n")
    run = lambda: ingest.ingest(ingest.scene_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    run()
    (tmp_path / "in" / "b.scenes.txt").write_text("1 2\n")
    run()
    run()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [("a", 0, 0, 5), ("a", 1, 6, 9), ("b", 0, 1, 2)]


