"""All queries of the engine over the driver's tables, each with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import boxes, ids, media, numeric, text
from .operators import detections, encoders, ocr, peaks, resume, shards, signal, spans, videos
from .plans import pipelines
from .plans.fixtures import ask, ctes, load, view
from .sources import archives, readers

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Registers a function under its name, with SQL for the same rows."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        _QUERIES[key] = f
        if sql:
            _SQL[key] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# Ids ---------------------------------------------------------------------------------------------

_HEAD = "((instr('LSNM', substr(video_id, 1, 1)) - 1) * 1000 + regexp_extract(video_id, '^[LSNM]([0-9]+)', 1)::bigint) * 1000 + regexp_extract(video_id, 'V([0-9]+)$', 1)::bigint"
_CANON = """case head // 1000000 when 0 then printf('L%02d_V%03d', head // 1000 % 1000, head % 1000) when 1 then printf('S%02d-V%03d', head // 1000 % 1000, head % 1000)
  when 2 then printf('N%03d-V%03d', head // 1000 % 1000, head % 1000) else printf('M%02d_V%03d', head // 1000 % 1000, head % 1000) end"""


@query(f"{ctes('ids')} select s_suppkey, {_HEAD} head from f_ids")
def video_head(spark, sf):
    return view(spark, sf, "ids").select("s_suppkey", ids.video_head(F.col("video_id")).alias("head"))


@query(f"{ctes('ids')} select s_suppkey, ({_HEAD}) * 10000 + keyframe_id::bigint vec_id from f_ids")
def vector_id(spark, sf):
    return view(spark, sf, "ids").select("s_suppkey", ids.vector_id(F.col("video_id"), F.col("keyframe_id")).alias("vec_id"))


@query(f"{ctes('ids')}, h as (select s_suppkey, keyframe_id, {_HEAD} head from f_ids) select s_suppkey, {_CANON} video_id, printf('%04d', keyframe_id::bigint) keyframe_id from h")
def id_roundtrip(spark, sf):
    vid, frame = ids.split_vector_id(F.col("v"))
    rows = view(spark, sf, "ids").select("s_suppkey", ids.vector_id(F.col("video_id"), F.col("keyframe_id")).alias("v"))
    return rows.select("s_suppkey", vid.alias("video_id"), frame.alias("keyframe_id"))


# Spans -------------------------------------------------------------------------------------------


@query(f"{ctes('scenes')} select vid, ord, f_start l, f_end r, (f_start + f_end) // 2 m from f_scenes")
def pick_frame(spark, sf):
    s, e = F.col("f_start"), F.col("f_end")
    return view(spark, sf, "scenes").select("vid", "ord", spans.pick_frame(s, e, "left").alias("l"), spans.pick_frame(s, e, "right").alias("r"), spans.pick_frame(s, e).alias("m"))


_DOUBLED = "select vid, ord, f_start // 3 f_start, f_end // 3 f_end from f_scenes"
_SELECTED = f"""{ctes('scenes')}, d as ({_DOUBLED}), p as (select *, (f_start + f_end) // 2 frame from d),
  n as (select *, row_number() over (partition by vid, frame order by ord) n from p) """


def _thirds(spark, sf):
    return view(spark, sf, "scenes").withColumns({"f_start": F.expr("f_start div 3"), "f_end": F.expr("f_end div 3")})


@query(_SELECTED + "select vid, ord, f_start, f_end, frame from n where n = 1")
def select_frames(spark, sf):
    return spans.select_frames(_thirds(spark, sf))


@query(_SELECTED + "select vid, frame, row_number() over (partition by vid order by frame) kf, printf('%04d', row_number() over (partition by vid order by frame)) keyframe_id from n where n = 1")
def keyframe_number(spark, sf):
    return spans.number_keyframes(spans.select_frames(_thirds(spark, sf))).select("vid", "frame", "kf", spans.keyframe_name(F.col("kf")).alias("keyframe_id"))


@query(
    f"""{ctes('scenes')}, g as (select *, greatest(1, round_even(1.0 * (29.97 + vid % 3 * 10), 0))::bigint st, f_end - f_start + 1 n from f_scenes),
  c as (select *, case when n < 2 * st then 1 else n // st end cells from g), x as (select *, unnest(range(cells)) cell from c)
  select vid, ord, f_start + n * cell // cells f_start, f_start + n * (cell + 1) // cells - 1 f_end, cell from x"""
)
def subdivide(spark, sf):
    rate = F.lit(29.97) + F.col("vid") % 3 * 10
    return spans.subdivide(view(spark, sf, "scenes"), spans.stride(1.0, rate))


_EXCLUDED = f"""{ctes('scenes', 'cuts')}, h as (select s.*, greatest(c_start, f_start) a, least(c_end, f_end) b from f_scenes s join f_cuts c on s.vid = c.vid and c_end >= f_start and c_start <= f_end),
  g as (select vid, ord, coalesce(max(b) over (partition by vid, ord order by a, b rows between unbounded preceding and 1 preceding) + 1, f_start) s, a - 1 e from h
    union all select vid, ord, max(b) + 1, any_value(f_end) from h group by vid, ord),
  kept as (select vid, ord, f_start, f_end from f_scenes s where not exists (select 1 from h where h.vid = s.vid and h.ord = s.ord)
    union all select vid, ord, s, e from g where e - s + 1 >= 10) """


@query(_EXCLUDED + "select * from kept")
def exclude_spans(spark, sf):
    return spans.exclude_spans(view(spark, sf, "scenes"), view(spark, sf, "cuts"))


@query(
    f"""{ctes('scenes', 'cuts')}, s as (select vid, min(f_start) f_start, max(f_end) f_end from f_scenes group by vid),
  p as (select distinct s.vid, f_start, f_end, c_start pos from s join f_cuts c on s.vid = c.vid and c_start > f_start and c_start <= f_end),
  o as (select *, row_number() over (partition by vid order by pos) k from p),
  w as (select vid, f_start, f_end, f_start prev, 0::bigint k, null::bigint s, null::bigint e from s
    union all select w.vid, w.f_start, w.f_end, case when o.pos - prev < 400 or w.f_end - o.pos < 400 then prev else o.pos end, o.k,
      case when o.pos - prev < 400 or w.f_end - o.pos < 400 then null else prev end, case when o.pos - prev < 400 or w.f_end - o.pos < 400 then null else o.pos - 1 end
    from w join o on o.vid = w.vid and o.k = w.k + 1)
  select vid, s f_start, e f_end from w where s is not null union all select vid, arg_max(prev, k), any_value(f_end) from w group by vid"""
)
def split_span(spark, sf):
    whole = view(spark, sf, "scenes").groupBy("vid").agg(F.lit(0).cast("long").alias("ord"), F.min("f_start").alias("f_start"), F.max("f_end").alias("f_end"))
    return spans.split_spans(whole, view(spark, sf, "cuts").select("vid", F.col("c_start").alias("at")), 400).select("vid", "f_start", "f_end")


@query(
    f"""{ctes('scenes', 'cuts')}, s as (select vid, f_start // 100 * 100 f_start, f_end // 100 * 100 f_end from f_scenes union select vid, c_start // 100 * 100, c_end // 100 * 100 from f_cuts)
  select vid, f_start, f_end from s"""
)
def adspan_union(spark, sf):
    cut = lambda d, a, z: d.select("vid", F.expr(f"{a} div 100 * 100").alias("f_start"), F.expr(f"{z} div 100 * 100").alias("f_end"))
    return spans.union_spans(cut(view(spark, sf, "scenes"), "f_start", "f_end"), cut(view(spark, sf, "cuts"), "c_start", "c_end"))


@query(
    f"""{ctes('scenes')} select vid, ord, round_even(f_start / 29.97::double * 2.0::double, 0)::bigint lo, round_even(f_end / 29.97::double * 2.0::double, 0)::bigint + 1 hi,
  round_even(ord / 2.0::double * 29.97::double, 0)::bigint m_start, round_even((ord + 7) / 2.0::double * 29.97::double, 0)::bigint m_end from f_scenes"""
)
def match_to_span(spark, sf):
    w = spans.reference_window(F.col("f_start"), F.col("f_end"), 29.97, 2.0)
    m = spans.match_to_span(F.col("ord"), 7, 29.97, 2.0)
    return view(spark, sf, "scenes").select("vid", "ord", w["lo"].alias("lo"), w["hi"].alias("hi"), m["f_start"].alias("m_start"), m["f_end"].alias("m_end"))


# Picks -------------------------------------------------------------------------------------------


def _picks_sql(where: str, best: str, gap: int) -> str:
    return f"""{ctes('scores')}, m as (select vid, idx, score, idx - row_number() over (partition by vid order by idx) run from f_scores where {where}),
  b as (select vid, {best} pos from m group by vid, run), o as (select *, row_number() over (partition by vid order by pos) k from b),
  w as (select vid, k, pos last_pos, true ok, pos from o where k = 1
    union all select o.vid, o.k, case when o.pos - last_pos >= {gap} then o.pos else last_pos end, o.pos - last_pos >= {gap}, o.pos from w join o on o.vid = w.vid and o.k = w.k + 1)
  select vid, pos idx from w where ok"""


@query(_picks_sql("score > 60 and idx >= 1", "arg_max(idx, (score, -idx))", 3), "peaks")
def peaks_(spark, sf):
    return peaks.peaks(view(spark, sf, "scores"), 60, 3)


@query(_picks_sql("score <= 35", "arg_min(idx, (score, idx))", 4))
def find_matches(spark, sf):
    return peaks.find_matches(view(spark, sf, "scores"), 35, 0, 4)


@query(
    f"""{ctes('frames')}, r as (select t - 3 r, px ref from f_frames where vid = 0 and t between 3 and 7),
  e as (select vid, t - r idx, list_sum(list_transform(list_zip(px, ref), lambda p: abs(p[1] - p[2])))::bigint d, len(px) n from f_frames, r where t >= r)
  select vid, idx, round(sum(d)::double / sum(n), 6) score from e group by vid, idx having count(*) = 5"""
)
def match_scores(spark, sf):
    f = view(spark, sf, "frames")
    ref = f.where("vid = 0 and t between 3 and 7").select((F.col("t") - 3).alias("t"), "px")
    return peaks.match_scores(f, ref, 5).select("vid", "idx", F.round("score", 6).alias("score"))


# Pixels and audio --------------------------------------------------------------------------------


@query(
    f"""{ctes('frames')}, p as (select *, lag(px) over (partition by vid order by t) b from f_frames)
  select vid, t, round(list_sum(list_transform(list_zip(px, b), lambda p: abs(p[1] - p[2])))::double / len(px), 6) diff from p"""
)
def frame_lag_diff(spark, sf):
    return signal.frame_lag_diff(view(spark, sf, "frames")).select("vid", "t", F.round("diff", 6).alias("diff"))


_PX = f"""{ctes('frames')}, e as (select vid, t, unnest(px) p, unnest(range(64)) k from f_frames), px as (select vid, t, (k // 8)::int y, (k % 8)::int x, p::int p from e),
  d as (select vid, y, x, abs(p - lag(p) over (partition by vid, y, x order by t)) d from px), m as (select vid, y, x, avg(d) m from d group by all),
  c as (select vid, greatest(quantile_cont(m, 0.8), 1.5) cut from m group by vid), busy as (select m.vid, y, x from m join c on m.vid = c.vid and m > cut),
  k as (select m.vid, m.y, m.x, not exists (select 1 from busy b where b.vid = m.vid and abs(b.y - m.y) <= 1 and abs(b.x - m.x) <= 1) keep from m),
  mask as (select vid, y, x, keep or avg(keep::int) over (partition by vid) < 0.05 keep from k) """


@query(_PX + "select * from mask")
def motion_mask(spark, sf):
    return signal.mask_rows(signal.motion_masks(view(spark, sf, "frames"), 8, ["vid"], reach=1), 8)


@query(
    _PX
    + """, s(o, w) as (values (-1, 1), (0, 2), (1, 1)), b as (select q.vid, q.t, q.y, q.x, sum(n.p * a.w * c.w) / 16.0::double b from px q, s a, s c, px n
    where n.vid = q.vid and n.t = q.t and n.y = (case when q.y + a.o < 0 then 1 when q.y + a.o > 7 then 6 else q.y + a.o end) and n.x = (case when q.x + c.o < 0 then 1 when q.x + c.o > 7 then 6 else q.x + c.o end)
    group by all),
  v as (select vid, t, y, x, (abs(b - lag(b) over (partition by vid, y, x order by t)) > 14)::int c from b),
  r as (select v.vid, v.t, sum(c)::double / count(*) r from v join mask using (vid, y, x) where keep and c is not null group by v.vid, v.t, v.y // 4, v.x // 4 having count(*) >= 5)
  select f.vid, f.t, round(coalesce(max(r), 0), 6) score from f_frames f left join r using (vid, t) group by f.vid, f.t"""
)
def change_scores(spark, sf):
    f = view(spark, sf, "frames")
    got = signal.slide_scores(f, signal.motion_masks(f, 8, ["vid"], reach=1), 8, ["vid"], block=4, least=5)
    return got.select("vid", "t", F.round("score", 6).alias("score"))


@query(f"{ctes('audio')} select vid, i // 5 frame, round(sqrt(avg(smp::double * smp)), 6) rms from f_audio group by all")
def rms_frames(spark, sf):
    return signal.rms_frames(view(spark, sf, "audio"), 5).select("vid", "frame", F.round("rms", 6).alias("rms"))


@query(
    f"""{ctes('audio')}, n as (select vid, count(*) t from f_audio group by vid), pw as (select vid, i, sum(smp * smp) over (partition by vid order by i)::bigint p from f_audio),
  st as (select a.vid, a.i s, t, greatest(a.i + 1, a.i + 20 - 5) lo, least(t, a.i + 20 + 5) hi from f_audio a join n using (vid) where a.i + 20 < t and t - a.i - 20 >= 5),
  fr as (select vid, s, lo, q, lo + q * 2 a from (select *, unnest(range(greatest(1, (hi - lo) // 2))) q from st)),
  en as (select f.vid, s, lo, q, z.p - coalesce(y.p, 0) e from fr f join n using (vid) join pw z on z.vid = f.vid and z.i = least(a + 2, t) - 1 left join pw y on y.vid = f.vid and y.i = a - 1),
  nx as (select vid, s, arg_min(lo + q * 2 + 1, (e, q)) nxt from en group by vid, s),
  w as (select vid, 0::bigint s from n union all select w.vid, nxt from w join nx on nx.vid = w.vid and nx.s = w.s),
  c as (select w.vid, s, t from w join n using (vid) where not (s > 0 and t - s < 5)),
  o as (select vid, s, t, lead(s) over (partition by vid order by s) e, row_number() over (partition by vid order by s) - 1 idx from c)
  select vid, idx, s s0, case when e is null then t else e end s1 from o"""
)
def silence_split(spark, sf):
    return signal.silence_chunks(view(spark, sf, "audio"), 20, 5, 2, 5)


@query(f"{ctes('audio')} select vid, i, round_even(i / 16000.0::double * 1000, 0)::bigint ms from f_audio")
def chunk_ms(spark, sf):
    return view(spark, sf, "audio").select("vid", "i", numeric.to_ms(F.col("i"), 16000.0).alias("ms"))


# Text --------------------------------------------------------------------------------------------


@query("select doc_id, len(w)::int n, array_to_string(w, '|') words from (select doc_id, regexp_extract_all(text, '[\\p{L}\\p{N}_]+') w from documents)")
def tokenize(spark, sf):
    w = text.words(F.col("text"))
    return load(spark, sf, "documents").select("doc_id", F.size(w).alias("n"), F.array_join(w, "|").alias("words"))


@query("select doc_id, md5(strip_accents(lower(translate(text, 'đĐ', 'dd')))) base from documents")
def base_form(spark, sf):
    return load(spark, sf, "documents").select("doc_id", F.md5(text.base_form(F.col("text"))).alias("base"))


@query(
    """with w as (select doc_id, string_split(lower(text), ' ') h from documents), n as (select *, h[len(h) // 2 + 1:len(h) // 2 + 2] nd from w)
  select doc_id, (list_filter(range(0, len(h) - len(nd) + 1), lambda i: h[i + 1:i + len(nd)] = nd)[1])::int place from n"""
)
def find_run(spark, sf):
    h = F.split(F.lower("text"), " ", -1)
    rows = load(spark, sf, "documents").select("doc_id", h.alias("h"))
    needle = F.expr("slice(h, cast(size(h) div 2 as int) + 1, 2)")
    return rows.select("doc_id", text.find_run(F.col("h"), needle).alias("place"))


def _ocr(spark, sf):
    """Frames with a base reading: marks stripped line by line, every second line in capitals."""
    rows = view(spark, sf, "ocr")
    line = F.transform(F.split("vlm_text", "\n"), lambda x, i: F.when(i % 2 == 1, F.upper(F.translate(x, text._FROM, text._TO))).otherwise(F.translate(x, text._FROM, text._TO)))
    return rows.withColumn("text", F.array_join(line, "\n"))


_RUNS = "'[\\p{L}\\p{N}_]+'"


def _reconciled_sql(read: str) -> str:
    """Base texts, a row a line, with the reading's words where the line's run of base forms stands in it. read: which frames have a reading."""
    flat = lambda w: f"strip_accents(lower(translate(array_to_string({w}, ' '), 'đĐ', 'dd')))"
    return f"""{ctes('ocr')}, l as (select vid, vlm_text, unnest(string_split(vlm_text, chr(10))) x, unnest(range(len(string_split(vlm_text, chr(10))))) i from f_ocr),
  b as (select vid, i, case when i % 2 = 1 then upper(strip_accents(x)) else strip_accents(x) end line from l),
  h as (select vid, regexp_extract_all(vlm_text, {_RUNS}) ws, ' ' || {flat(f"regexp_extract_all(vlm_text, {_RUNS})")} || ' ' hay from f_ocr where {read}),
  o as (select vid, i, line, regexp_extract_all(line, {_RUNS}) own from b),
  r as (select o.vid, i, line, len(own) n, ws, hay, instr(hay, ' ' || {flat('own')} || ' ') place from o left join h on h.vid = o.vid),
  k as (select *, length(hay[1:place]) - length(replace(hay[1:place], ' ', '')) w from r),
  t as (select vid, i, line, case when coalesce(place, 0) = 0 or n = 0 then line else array_to_string(ws[w:w + n - 1], ' ') end said, coalesce(place, 0) > 0 and n > 0 found from k),
  u as (select vid, string_agg(case when found and upper(line) = line and lower(line) <> line then upper(said) else said end, chr(10) order by i) out from t group by vid)
  select f_ocr.vid, md5(out) """


@query(_reconciled_sql("true") + "lines from f_ocr left join u on u.vid = f_ocr.vid")
def reconcile_lines(spark, sf):
    return _ocr(spark, sf).select("vid", F.md5(text.reconcile_lines(F.col("text"), F.col("vlm_text"))).alias("lines"))


@query(_reconciled_sql("vid % 7 <> 3") + '"text" from f_ocr left join u on u.vid = f_ocr.vid')
def ocr_crosscheck(spark, sf):
    rows = _ocr(spark, sf)
    got = ocr.cross_check(rows.select("vid", "text"), rows.where("vid % 7 <> 3").select("vid", "vlm_text"), ["vid"])
    return got.select("vid", F.md5("text").alias("text"))


@query(f"{ctes('transcripts')} select vid, count(*) filter (length(text) <= 40) > count(*) // 2 degenerate from f_transcripts group by vid")
def vlm_degenerate(spark, sf):
    return ocr.degenerate(view(spark, sf, "transcripts"), "vid", short=40)


@query(f"{ctes('quads')} select img, idx, row_number() over (partition by img order by my, mx, idx) - 1 place from f_quads")
def reading_order(spark, sf):
    return ocr.reading_order(view(spark, sf, "quads"), "img").select("img", "idx", "place")


@query(f"{ctes('quads')} select img, md5(string_agg(line, chr(10) order by my, mx, idx)) lines, count(*) n from f_quads where p >= 0.6 group by img")
def ocr_lines_to_text(spark, sf):
    got = ocr.lines_to_text(view(spark, sf, "quads"), "img")
    return got.select("img", F.md5("text").alias("lines"), F.size(F.split("text", "\n")).cast("long").alias("n"))


@query(f"{ctes('transcripts')} select vid, string_agg(printf('%04d', idx) || '=' || md5(text), ';' order by idx) doc from f_transcripts group by vid")
def ocr_map(spark, sf):
    got = ocr.frame_map(view(spark, sf, "transcripts").select("vid", F.format_string("%04d", "idx").alias("frame"), "text"))
    entry = F.transform(F.array_sort(F.map_entries("doc")), lambda e: F.concat(e["key"], F.lit("="), F.md5(e["value"])))
    return got.select("vid", F.array_join(entry, ";").alias("doc"))


@query(f"{ctes('transcripts')} select vid, idx, md5(lower(trim(text, ' ' || chr(9) || chr(10) || chr(13)))) text from f_transcripts")
def transcript_normalize(spark, sf):
    return view(spark, sf, "transcripts").select("vid", "idx", F.md5(text.normalize_transcript(F.col("text"))).alias("text"))


@query(f"{ctes('transcripts')}, b as (select vid, idx, case when idx % 3 = 1 then '  ' || chr(10) else text end text from f_transcripts) select vid, idx, case when trim(text, ' ' || chr(10)) = '' then ' ' else text end text from b")
def transcript_blank_fill(spark, sf):
    some = F.when(F.col("idx") % 3 == 1, F.lit("  \n")).otherwise(F.col("text"))
    return view(spark, sf, "transcripts").select("vid", "idx", text.fill_blank(some).alias("text"))


@query(f"{ctes('transcripts')} select vid, idx, (((vid // 1000 % 4) * 1000 + 21) * 1000 + vid % 1000) * 10000 + row_number() over (partition by vid order by idx) - 1 vec_id from f_transcripts")
def transcript_ids(spark, sf):
    rows = view(spark, sf, "transcripts").withColumn("n", F.row_number().over(Window.partitionBy("vid").orderBy("idx")) - 1)
    name = F.concat(F.substring(F.lit(ids.PREFIXES), F.expr("cast(vid div 1000 % 4 as int) + 1"), F.lit(1)), F.lit("21_V"), (F.col("vid") % 1000).cast("string"))
    return rows.select("vid", "idx", ids.vector_id(name, F.col("n")).alias("vec_id"))


# Vectors -----------------------------------------------------------------------------------------

_MICRO = "list_transform({}, lambda x: round(x * 1000000)::bigint)"


def _micro(vec):
    return F.transform(vec, lambda x: F.round(x * 1_000_000).cast("bigint"))


@query("with e as (select vec_id, list_transform(embedding, lambda x: x::double) v from embeddings) select vec_id, " + _MICRO.format("list_transform(v, lambda x: x / greatest(sqrt(list_dot_product(v, v)), 1e-12))") + " vec from e")
def l2_normalize(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", _micro(numeric.l2_normalize(F.col("embedding"))).alias("vec"))


@query("with e as (select vec_id, list_transform(embedding, lambda x: x::double) v from embeddings) select vec_id, " + _MICRO.format("list_transform(v, lambda x: x / (sqrt(list_dot_product(v, v)) + 1e-6))") + " vec from e")
def l2_normalize_eps(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", _micro(numeric.l2_normalize_eps(F.col("embedding"))).alias("vec"))


@query(
    """with e as (select vec_id, unnest(embedding)::double x, unnest(range(len(embedding))) k from embeddings), q as (select *, pow(2.0::double, greatest(floor(log2(abs(x))), -14) - 10) u from e)
  select vec_id, sum(case when x = 0 then 0 else (round_even(x / u, 0) * u * 16777216)::bigint end * (k % 7 + 1))::bigint s from q group by vec_id"""
)
def f16_roundtrip(spark, sf):
    fixed = F.transform("embedding", lambda x, k: (numeric.half(x) * 16_777_216).cast("bigint") * (k % 7 + 1))
    return load(spark, sf, "embeddings").select("vec_id", F.aggregate(fixed, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("s"))


@query(
    """with e as (select vec_id, list_transform(embedding, lambda x: x::double) v from embeddings), r as (select *, list_min(v) lo, (list_max(v) - list_min(v)) / 15 st from e)
  select vec_id, list_transform(v, lambda x: case when st > 0 then round_even((x - lo) / st, 0)::int else 0 end) codes, round(lo * 1000000)::bigint lo, round(st * 1000000)::bigint step from r"""
)
def quantize_codes(spark, sf):
    micro = lambda c: F.round(F.col(c) * 1_000_000).cast("bigint").alias(c)
    emb = view(spark, sf, "emb")
    return shards.build_index(shards.pair(emb.select("vid", "row", "vec"), emb.select("vid", "row", "vec_id"))).select("vec_id", "codes", micro("lo"), micro("step"))


def _shards(spark, sf):
    """Vectors of all videos; ids of all but every third."""
    emb = view(spark, sf, "emb")
    return emb.select("vid", "row", "vec"), emb.where("vid % 3 <> 1").select("vid", "row", "vec_id")


@query(f"{ctes('emb')} select vid, row, vec_id, len(vec)::int dim from f_emb where vid % 3 <> 1")
def shard_pair_join(spark, sf):
    return shards.pair(*_shards(spark, sf)).select("vid", "row", "vec_id", F.size("vec").alias("dim"))


@query(f"{ctes('emb')} select vid, count(*) n_vectors, count(*) - (vid % 2) n_ids, 64 dim, vid % 2 = 0 ok from f_emb group by vid")
def shard_validate(spark, sf):
    emb = view(spark, sf, "emb")
    return shards.validate(emb.select("vid", "row", "vec"), emb.where("not (vid % 2 = 1 and row = 0)").select("vid", "row", "vec_id"))


@query(f"{ctes('emb')} select vid, count(*) n, sum(count(*)) over (order by vid)::bigint total from f_emb group by vid")
def shard_totals(spark, sf):
    return shards.totals(view(spark, sf, "emb"))


@query("select user_id vec_id, count(*) n from events group by user_id having count(*) > 1")
def duplicate_ids(spark, sf):
    return shards.duplicate_ids(load(spark, sf, "events").select(F.col("user_id").alias("vec_id")))


# Boxes -------------------------------------------------------------------------------------------

_BOX = "greatest(0, least(1, cx - w / 2)) x1, greatest(0, least(1, cy - h / 2)) y1, greatest(0, least(1, cx + w / 2)) x2, greatest(0, least(1, cy + h / 2)) y2"


def _boxes(spark, sf):
    return view(spark, sf, "boxes").select("img", "rid", "obj", boxes.corners(F.col("cx"), F.col("cy"), F.col("w"), F.col("h")).alias("box"))


def _rounded(*names, digits=6):
    return [F.round(F.col(f"box.{n}"), digits).alias(n) for n in names]


@query(f"{ctes('boxes')}, b as (select img, rid, {_BOX} from f_boxes) select img, rid, round(x1, 6) x1, round(y1, 6) y1, round(x2, 6) x2, round(y2, 6) y2 from b")
def box_convert(spark, sf):
    return _boxes(spark, sf).select("img", "rid", *_rounded("x1", "y1", "x2", "y2"))


@query(
    f"""{ctes('boxes')}, b as (select img, rid, {_BOX}, 640 + img % 5 * 100 wd, 480 + rid % 7 * 90 hg from f_boxes), s as (select *, greatest(wd, hg)::double / wd sx, greatest(wd, hg)::double / hg sy from b)
  select img, rid, round(least(1, x1 * sx), 9) x1, round(least(1, y1 * sy), 9) y1, round(least(1, x2 * sx), 9) x2, round(least(1, y2 * sy), 9) y2 from s"""
)
def box_rescale(spark, sf):
    got = _boxes(spark, sf).withColumn("box", boxes.from_square(F.col("box"), 640 + F.col("img") % 5 * 100, 480 + F.col("rid") % 7 * 90))
    return got.select("img", "rid", *_rounded("x1", "y1", "x2", "y2", digits=9))


@query("select c_custkey, round(case when x > 0 then x + 1 else exp(x) end, 6) scale from (select c_custkey, c_acctbal / 2000 x from customer)")
def elu_scale(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", F.round(numeric.elu_scale(F.col("c_acctbal") / 2000), 6).alias("scale"))


_POOL = "p as (select *, row_number() over (partition by img order by obj desc, rid) rank from f_boxes qualify rank <= 300)"


@query(f"{ctes('boxes')}, {_POOL} select img, rid, rank from p")
def topk_pool(spark, sf):
    return detections.top_pool(_boxes(spark, sf)).select("img", "rid", F.col("rank").cast("long").alias("rank"))


_AREA = "(b.x2 - b.x1) * (b.y2 - b.y1)"
_OVER = "greatest(0, least(b.x2, p.x2) - greatest(b.x1, p.x1)) * greatest(0, least(b.y2, p.y2) - greatest(b.y1, p.y1))"


@query(
    f"""{ctes('boxes')}, q as (select img, rid, obj, {_BOX} from f_boxes), p as (select *, row_number() over (partition by img order by obj desc, rid) rank from q qualify rank <= 300),
  w as (select distinct img, 0::bigint k, []::struct(rid bigint, x1 double, y1 double, x2 double, y2 double)[] kept from p
    union all select w.img, w.k + 1, case when len(w.kept) < 32 and len(list_filter(w.kept, lambda b: ({_OVER}) / ({_AREA} + (p.x2 - p.x1) * (p.y2 - p.y1) - {_OVER}) > 0.7)) = 0
      then list_append(w.kept, {{'rid': p.rid, 'x1': p.x1, 'y1': p.y1, 'x2': p.x2, 'y2': p.y2}}) else w.kept end from w join p on p.img = w.img and p.rank = w.k + 1),
  last as (select img, arg_max(kept, k) kept from w group by img), out as (select img, unnest(range(len(kept))) slot, kept from last)
  select img, slot, kept[slot + 1].rid rid from out"""
)
def greedy_nms(spark, sf):
    return detections.greedy_nms(_boxes(spark, sf))


@query(
    f"""{ctes('boxes')}, {_POOL}, g as (select img, unnest(range(400)) slot from (select distinct img from f_boxes))
  select g.img, g.slot, coalesce(p.rid, -1) rid, coalesce(p.obj, -10000) obj from g left join p on p.img = g.img and p.rank = g.slot + 1"""
)
def pad_slots(spark, sf):
    kept = detections.top_pool(_boxes(spark, sf)).withColumn("slot", (F.col("rank") - 1).cast("long"))
    return detections.pad_slots(kept, _boxes(spark, sf), {"rid": -1, "obj": detections.EMPTY}, 400)


@query(
    """select p_partkey, greatest(sqrt(((100 + a) - 0.0)^2 + (5.0 - 0)^2), sqrt(((90.0 + a) - 3)^2 + ((42.0 + b) - (40 + b))^2))::double w0,
  trunc(greatest(sqrt((100 + a)::double^2 + 25), sqrt((87 + a)::double^2 + 4)))::int + 20 w, trunc(greatest(sqrt(9.0 + (40 + b)::double^2), sqrt(100.0 + (37 + b)::double^2)))::int + 20 h
  from (select p_partkey, p_size a, p_partkey % 13 b from part)""".replace("greatest(sqrt(((100 + a) - 0.0)^2 + (5.0 - 0)^2), sqrt(((90.0 + a) - 3)^2 + ((42.0 + b) - (40 + b))^2))::double w0,\n ", "")
)
def crop_size(spark, sf):
    a, b = F.col("p_size").cast("double"), (F.col("p_partkey") % 13).cast("double")
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    quad = F.array(point(F.lit(0.0), F.lit(0.0)), point(100 + a, F.lit(5.0)), point(90 + a, 42 + b), point(F.lit(3.0), 40 + b))
    got = load(spark, sf, "part").select("p_partkey", boxes.crop_size(quad).alias("s"))
    return got.select("p_partkey", "s.w", "s.h")


@query(
    """with d as (select p_partkey, p_size * 37 h, p_size * 61 + 5 w from part)
  select p_partkey, concat_ws(',', 0, trunc(h * 0.90625::double)::int, w, trunc(h * 0.052::double)::int) ticker,
    concat_ws(',', trunc(w * 0.8138::double)::int, trunc(h * 0.0729::double)::int, trunc(w * 0.1054::double)::int, trunc(h * 0.084::double)::int) badge from d"""
)
def overlay_boxes(spark, sf):
    got = load(spark, sf, "part").select("p_partkey", boxes.overlay_boxes(F.col("p_size") * 37, F.col("p_size") * 61 + 5).alias("b"))
    row = lambda k: F.concat_ws(",", *[F.get("b", F.lit(k))[n].cast("string") for n in ("x", "y", "w", "h")])
    return got.select("p_partkey", row(0).alias("ticker"), row(1).alias("badge"))


_GRID = """with recursive s as (select row_number() over (order by i * j, i, j) k, i, j from range(1, 7) a(i), range(1, 7) b(j) where i * j <= 6),
  d as (select p_partkey, (p_size * 29 + 40) w, (p_partkey % 17 * 53 + 60) h from part),
  g as (select p_partkey, w, h, 0::bigint k, 1e308::double off, 1::bigint cols, 1::bigint rws from d
    union all select p_partkey, w, h, s.k, case when t then o else off end, case when t then i else cols end, case when t then j else rws end from (
      select g.*, s.k sk, i, j, abs(w::double / h - i::double / j) o, abs(w::double / h - i::double / j) < off or (abs(w::double / h - i::double / j) = off and w::double * h > 0.5 * 448 * 448 * i * j) t
      from g join s on s.k = g.k + 1) s0 join s on s.k = s0.sk),
  best as (select p_partkey, cols::int cols, rws::int rws from g where k = (select max(k) from s)) """


def _grid(spark, sf):
    return load(spark, sf, "part").select("p_partkey", boxes.tile_grid(F.col("p_size") * 29 + 40, F.col("p_partkey") % 17 * 53 + 60).alias("g"))


@query(_GRID.replace("s0 join s on s.k = s0.sk", "s0").replace("select p_partkey, w, h, s.k, case", "select p_partkey, w, h, sk, case") + "select p_partkey, cols, rws \"rows\" from best")
def tile_grid(spark, sf):
    return _grid(spark, sf).select("p_partkey", "g.cols", "g.rows")


@query(
    _GRID.replace("s0 join s on s.k = s0.sk", "s0").replace("select p_partkey, w, h, s.k, case", "select p_partkey, w, h, sk, case")
    + """select p_partkey, n, i % cols * 448 x1, i // cols * 448 y1 from (select p_partkey, cols, rws, cols * rws n, unnest(range(cols * rws)) i from best)
  union all select p_partkey, cols * rws, 0, 0 from best where cols * rws > 1"""
)
def tile_boxes(spark, sf):
    got = _grid(spark, sf).select("p_partkey", (F.col("g.cols") * F.col("g.rows")).alias("n"), F.explode(boxes.tile_boxes(F.col("g"))).alias("b"))
    return got.select("p_partkey", "n", F.col("b.x1").alias("x1"), F.col("b.y1").alias("y1"))


# Resume ------------------------------------------------------------------------------------------


@query(f"{ctes('transcripts')}, d as (select * from f_transcripts where (vid + idx) % 7 <> 3) select vid from f_transcripts group by vid having count(*) <> (select count(*) from d where d.vid = f_transcripts.vid)")
def resume_count_anti(spark, sf):
    t = view(spark, sf, "transcripts")
    return resume.by_count(t, t.where("(vid + idx) % 7 <> 3"))


@query(f"{ctes('emb')} select distinct vid from f_emb where vid % 2 = 1 or vid = 4")
def resume_shape_anti(spark, sf):
    emb = view(spark, sf, "emb")
    done = emb.where("not (vid % 2 = 1 and row = 1)").withColumn("vec", F.when((F.col("vid") == 4) & (F.col("row") == 2), F.slice("vec", 1, 63)).otherwise(F.col("vec")))
    return resume.by_shape(emb, done, 64)


@query(f"{ctes('transcripts')}, d as (select vid, case when (vid * 31 + idx) % 11 = 5 then idx + 1000 else idx end idx from f_transcripts) select distinct vid from ((select vid, idx from f_transcripts except select vid, idx from d) union all (select vid, idx from d except select vid, idx from f_transcripts))")
def resume_setequal(spark, sf):
    t = view(spark, sf, "transcripts").select("vid", F.col("idx").alias("key"))
    return resume.by_keys(t, t.withColumn("key", F.when((F.col("vid") * 31 + F.col("key")) % 11 == 5, F.col("key") + 1000).otherwise(F.col("key"))))


@query("select count(*) filter (n < 70) done, count(*) filter (n >= 70) failed, coalesce(string_agg(user_id::varchar, ',' order by user_id::varchar) filter (n >= 70), '') failed_ids from (select user_id, count(*) n from events group by user_id)")
def status_summary(spark, sf):
    n = load(spark, sf, "events").groupBy(F.col("user_id").alias("vid")).count()
    return resume.status_summary(n.select("vid", (F.col("count") < 70).alias("ok")))


@query("select user_id vid, round(case when count(*) % 5 = 0 then 0 else sum(value) / (count(*) % 5) end, 6) rtf from events group by user_id")
def rtf(spark, sf):
    n = load(spark, sf, "events").groupBy(F.col("user_id").alias("vid")).agg(F.sum("value").alias("elapsed"), (F.count("*") % 5).alias("duration"))
    return n.select("vid", F.round(numeric.real_time_factor(F.col("elapsed"), F.col("duration")), 6).alias("rtf"))


# Lists, filters, parsing -------------------------------------------------------------------------


@query("select o_custkey vid, arg_min(o_orderkey, (o_orderdate, o_orderkey)) path from orders group by o_custkey")
def dedup_first_by_key(spark, sf):
    rows = load(spark, sf, "orders").select(F.col("o_custkey").alias("vid"), F.col("o_orderkey").alias("path"), F.struct("o_orderdate", "o_orderkey").alias("at"))
    return videos.first_by_key(rows, "vid", "at").drop("at")


@query("select p_partkey from part where p_brand like 'Brand#1%'")
def prefix_filter(spark, sf):
    return videos.with_prefix(load(spark, sf, "part"), "Brand#1", "p_brand").select("p_partkey")


@query("select o_orderkey, o_custkey vid from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def video_semi_filter(spark, sf):
    wanted = load(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("vid"))
    return videos.only(load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("vid")), wanted)


@query("select c_name vid from customer order by c_name limit 37")
def limit_sorted(spark, sf):
    return videos.limit_sorted(load(spark, sf, "customer").select(F.col("c_name").alias("vid")), 37)


@query("select c_custkey vid, count(o_orderkey) n_scenes, count(o_orderkey) = 0 failed from customer left join orders on c_custkey = o_custkey group by c_custkey")
def videos_scenes_left(spark, sf):
    return videos.with_scenes(load(spark, sf, "customer").select(F.col("c_custkey").alias("vid")), load(spark, sf, "orders").select(F.col("o_custkey").alias("vid")))


@query("select c_custkey vid, c_custkey % 10 <> 0 and c_mktsegment = 'BUILDING' overlay from customer")
def overlay_flag(spark, sf):
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("vid"), F.col("c_mktsegment").alias("author"))
    return videos.overlay_flag(c, c.where("vid % 10 <> 0"), "BUILDING")


@query(
    """with t as (select p_partkey, case p_partkey % 6 when 0 then p_size || '/1' when 1 then '30000/1001' when 2 then p_size || '/0' when 3 then '' when 4 then '0/0' else p_size::varchar end rate from part)
  select p_partkey, round(case p_partkey % 6 when 0 then split_part(rate, '/', 1)::double when 1 then 30000 / 1001.0::double when 5 then rate::double else 25 end, 6) fps, case when rate in ('', '0/0') then '' else rate end frame_rate,
    round_even(p_partkey / 8.0::double * 1000, 0)::bigint duration_ms from t"""
)
def parse_frame_rate(spark, sf):
    rate = F.expr("case p_partkey % 6 when 0 then concat(p_size, '/1') when 1 then '30000/1001' when 2 then concat(p_size, '/0') when 3 then '' when 4 then '0/0' else cast(p_size as string) end")
    rows = load(spark, sf, "part").select(F.col("p_partkey").alias("vid"), rate.alias("rate"), (F.col("p_partkey") / 8).cast("string").alias("seconds"), F.lit("h264").alias("codec"))
    return readers.parse_probe(rows).select(F.col("vid").alias("p_partkey"), F.round("fps", 6).alias("fps"), "frame_rate", "duration_ms")


@query(f"{ctes('scenes')} select vid, ord, f_start, f_end from f_scenes")
def parse_scenes(spark, sf):
    line = F.concat(F.lit("  "), F.col("f_start").cast("string"), F.lit(" \t"), F.col("f_end").cast("string"))
    lines = view(spark, sf, "scenes").select("vid", (F.col("ord") * 2).alias("line_no"), line.alias("line"))
    return readers.parse_scenes(lines.union(lines.select("vid", F.col("line_no") + 1, F.lit("   "))))


@query(f"{ctes('cuts')} select vid::varchar vid, c_start f_start, c_end f_end from f_cuts")
def adspans_explode(spark, sf):
    by = view(spark, sf, "cuts").groupBy(F.col("vid").cast("string").alias("vid")).agg(F.collect_list(F.array("c_start", "c_end")).alias("p"))
    return readers.explode_cut_spans(by.select(F.to_json(F.create_map("vid", "p")).alias("value")))


@query("select o_custkey vid, 'select=''' || string_agg('eq(n\\,' || o_orderkey || ')', '+' order by o_orderkey) || '''' expr from orders group by o_custkey")
def select_expr(spark, sf):
    return load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("vid")).agg(media.select_expr(F.collect_list("o_orderkey")).alias("expr"))


@query("select p_partkey, case p_size % 4 when 0 then 'libdav1d' when 1 then 'h264' when 2 then 'hevc' end decoder from part")
def codec_decoder(spark, sf):
    codec = F.element_at(F.array(*map(F.lit, ("av1", "h264", "hevc", "mpeg4"))), (F.col("p_size") % 4 + 1).cast("int"))
    return load(spark, sf, "part").select("p_partkey", media.decoder(codec, gpu=False).alias("decoder"))


@query("select c_custkey, c_name stored, '/data/' || c_name resolved from customer")
def path_relative(spark, sf):
    path = text.stored_path(F.concat(F.lit("/data/"), F.col("c_name")), "/data")
    return load(spark, sf, "customer").select("c_custkey", path.alias("stored"), text.resolve_path(path, "/data").alias("resolved"))


# Models and binary -------------------------------------------------------------------------------


@query(f"{ctes('transcripts')} select vid, idx, {encoders.SLOTS['gte'].dim} dim, null::varchar error from f_transcripts")
def stub_embed(spark, sf):
    """Lengths and errors of the stand-in encoder's vectors; the numbers themselves no SQL has."""
    got = encoders.encode_transcripts(view(spark, sf, "transcripts"))
    return got.select("vid", "idx", F.size("vec").alias("dim"), F.col("error"))


@query("select vec_id, list_transform(range(1, 33), lambda i: round((embedding[i]::double + embedding[i + 32]::double) / 2 * 1000000)::bigint) mono from embeddings")
def mono_mix(spark, sf):
    two = F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))
    return load(spark, sf, "embeddings").select("vec_id", _micro(numeric.mono(two)).alias("mono"))


@query("select p_partkey, p_partkey * 1000 + 30 + p_size + p_size * 7 \"start\", p_partkey * 1000 + 30 + p_size + p_size * 7 + 4095 \"end\" from part")
def zip_entry_range(spark, sf):
    little = lambda n: F.concat(F.lpad(F.hex(n % 256), 2, "0"), F.lpad(F.hex(F.floor(n / 256)), 2, "0"))
    size = F.col("p_size").cast("bigint")
    header = F.unhex(F.concat(F.lit("504B0304"), F.lit("00" * 22), little(size), little(size * 7)))
    got = load(spark, sf, "part").select("p_partkey", archives.entry_range(header, F.col("p_partkey") * 1000, F.lit(4096)).alias("r"))
    return got.select("p_partkey", "r.start", "r.end")


# Plans -------------------------------------------------------------------------------------------


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes less cuts, in cells of 30 frames, one frame each, numbered and packed into vector ids."""
    scenes = view(spark, sf_dir, "scenes")
    name = F.format_string("L21_V%03d", F.col("vid") % 1000)
    return pipelines.keyframe_plan(scenes, view(spark, sf_dir, "cuts"), name, F.lit(120))


_QUERIES["flagship"] = flagship
_SQL["flagship"] = (
    _EXCLUDED
    + """, z as (select *, f_end - f_start + 1 n from kept), c as (select *, case when n < 240 then 1 else n // 120 end cells from z),
  x as (select *, unnest(range(cells)) cell from c), y as (select vid, f_start + n * cell // cells f_start, f_start + n * (cell + 1) // cells - 1 f_end from x),
  p as (select *, (f_start + f_end) // 2 frame from y), k as (select *, row_number() over (partition by vid, frame order by f_start) d from p),
  q as (select vid, f_start, f_end, frame, row_number() over (partition by vid order by frame) kf from k where d = 1)
  select vid, kf, frame, f_start, f_end, (21000 + vid % 1000) * 10000 + kf vec_id from q"""
)


def _advert(spark, sf):
    f = view(spark, sf, "frames")
    return pipelines.advert_plan(f, f.where("vid = 0 and t between 3 and 7").select((F.col("t") - 3).alias("t"), "px"), 5, 30.0, 2.0, max_score=60)


_QUERIES["advert_plan"] = _advert
_SQL["advert_plan"] = (
    f"""{ctes('frames')}, r as (select t - 3 r, px ref from f_frames where vid = 0 and t between 3 and 7),
  e as (select vid, t - r idx, list_sum(list_transform(list_zip(px, ref), lambda p: abs(p[1] - p[2])))::bigint d, len(px) n from f_frames, r where t >= r),
  f_scores as (select vid, idx, sum(d)::double / sum(n) score from e group by vid, idx having count(*) = 5), """
    + _picks_sql("score <= 60", "arg_min(idx, (score, idx))", 5).split("), m as (", 1)[1].join(["m as (", ""]).rsplit("select vid, pos idx", 1)[0]
    + "select vid, round_even(pos / 2.0::double * 30.0::double, 0)::bigint f_start, round_even((pos + 5) / 2.0::double * 30.0::double, 0)::bigint f_end from w where ok"
)

#: Scenes of ten samples a piece, and one of the whole video; those over min_split are looked at sample by sample.
_SHOTS = """select vid, (t // 40) ord, min(t) * 15 f_start, max(t) * 15 + 7 f_end from f_frames group by vid, t // 40"""


def _slides(spark, sf):
    f = view(spark, sf, "frames")
    shots = f.groupBy("vid", F.expr("t div 40").alias("ord")).agg((F.min("t") * 15).alias("f_start"), (F.max("t") * 15 + 7).alias("f_end"))
    return pipelines.slide_plan(shots, f, 30.0, 2.0, 8, 8, block=4, least=5, min_split=10, threshold=0.5, reach=1).select("vid", "ord", "f_start", "f_end")


_QUERIES["slide_split"] = _slides
_SQL["slide_split"] = f"""{ctes('frames')}, sc as ({_SHOTS}),
  big as (select *, round_even(f_start / 30.0::double * 2.0::double, 0)::bigint lo, round_even(f_end / 30.0::double * 2.0::double, 0)::bigint + 1 hi from sc where f_end - f_start + 1 >= 300),
  e as (select g.vid, g.ord, t - lo t, unnest(px) p, unnest(range(64)) k from big g join f_frames f on f.vid = g.vid and f.t >= lo and f.t < hi),
  px as (select vid, ord, t, (k // 8)::int y, (k % 8)::int x, p::int p from e),
  d as (select vid, ord, y, x, abs(p - lag(p) over (partition by vid, ord, y, x order by t)) d from px), m as (select vid, ord, y, x, avg(d) m from d group by all),
  c as (select vid, ord, greatest(quantile_cont(m, 0.8), 1.5) cut from m group by vid, ord), busy as (select m.vid, m.ord, y, x from m join c on m.vid = c.vid and m.ord = c.ord and m > cut),
  kp as (select m.vid, m.ord, m.y, m.x, not exists (select 1 from busy b where b.vid = m.vid and b.ord = m.ord and abs(b.y - m.y) <= 1 and abs(b.x - m.x) <= 1) keep from m),
  mask as (select vid, ord, y, x, keep or avg(keep::int) over (partition by vid, ord) < 0.05 keep from kp),
  s(o, w) as (values (-1, 1), (0, 2), (1, 1)), b as (select q.vid, q.ord, q.t, q.y, q.x, sum(n.p * a.w * c.w) / 16.0::double b from px q, s a, s c, px n
    where n.vid = q.vid and n.ord = q.ord and n.t = q.t and n.y = (case when q.y + a.o < 0 then 1 when q.y + a.o > 7 then 6 else q.y + a.o end) and n.x = (case when q.x + c.o < 0 then 1 when q.x + c.o > 7 then 6 else q.x + c.o end)
    group by all),
  v as (select vid, ord, y, x, t, (abs(b - lag(b) over (partition by vid, ord, y, x order by t)) > 14)::int c from b),
  r as (select v.vid, v.ord, v.t, sum(c)::double / count(*) r from v join mask using (vid, ord, y, x) where keep and c is not null group by v.vid, v.ord, v.t, v.y // 4, v.x // 4 having count(*) >= 5),
  score as (select vid, ord, t idx, max(r) score from r group by all),
  mm as (select *, idx - row_number() over (partition by vid, ord order by idx) run from score where score > 0.5 and idx >= 1),
  bb as (select vid, ord, arg_max(idx, (score, -idx)) pos from mm group by vid, ord, run), oo as (select *, row_number() over (partition by vid, ord order by pos) k from bb),
  w as (select vid, ord, k, pos last_pos, true ok, pos from oo where k = 1
    union all select oo.vid, oo.ord, oo.k, case when oo.pos - last_pos >= 3 then oo.pos else last_pos end, oo.pos - last_pos >= 3, oo.pos from w join oo on oo.vid = w.vid and oo.ord = w.ord and oo.k = w.k + 1),
  cuts as (select g.vid, g.ord, g.f_start, g.f_end, round_even((lo + pos - 0.5::double) * 30.0::double / 2.0::double, 0)::bigint pt from w join big g on g.vid = w.vid and g.ord = w.ord where ok),
  ins as (select *, row_number() over (partition by vid, ord order by pt) k from (select distinct * from cuts where pt > f_start and pt <= f_end)),
  z as (select vid, ord, f_start, f_end, f_start prev, 0::bigint k, null::bigint a, null::bigint e from sc
    union all select z.vid, z.ord, z.f_start, z.f_end, case when pt - prev < 45 or z.f_end - pt < 45 then prev else pt end, ins.k,
      case when pt - prev < 45 or z.f_end - pt < 45 then null else prev end, case when pt - prev < 45 or z.f_end - pt < 45 then null else pt - 1 end
    from z join ins on ins.vid = z.vid and ins.ord = z.ord and ins.k = z.k + 1)
  select vid, ord, a f_start, e f_end from z where a is not null union all select vid, ord, arg_max(prev, k), any_value(f_end) from z group by vid, ord"""

_SILENCE = _SQL["silence_split"].rsplit("select vid, idx, s s0", 1)[0]


@query(_SILENCE + """select vid, idx, round_even(s / 1.0::double * 1000, 0)::bigint time_start_ms, round_even(coalesce(e, t) / 1.0::double * 1000, 0)::bigint time_end_ms, 'chunk ' || idx "text" from o where coalesce(e, t) > s""")
def transcript_plan(spark, sf):
    """A sample a second; the stand-in for speech names the chunk."""
    speak = lambda cut: cut.withColumn("text", F.concat(F.lit("  Chunk "), F.col("idx").cast("string"), F.lit(" \n")))
    return pipelines.transcript_plan(view(spark, sf, "audio"), 1, speak, (20, 5, 2, 5))


def _half_sql(x: str) -> str:
    unit = f"pow(2.0::double, greatest(floor(log2(abs({x}))), -14) - 10)"
    return f"case when {x} = 0 then 0.0::double else round_even(({x}) / {unit}, 0) * {unit} end"


_KEPT = _SQL["greedy_nms"].rsplit("select img, slot, kept", 1)[0]
_UNIT = "list_transform([b.cx + 1, b.cy + 1, b.w], lambda v: v / (sqrt((b.cx + 1) * (b.cx + 1) + (b.cy + 1) * (b.cy + 1) + b.w * b.w) + 1e-6))"


@query(
    _KEPT
    + f""", k as (select o.img, slot, kept[slot + 1] x, 640 + o.img % 5 * 100 wd, 480 hg from out o),
  f as (select k.img, slot, least(1, x.x1 * (greatest(wd, hg)::double / wd)) x1, least(1, x.y1 * (greatest(wd, hg)::double / hg)) y1, least(1, x.x2 * (greatest(wd, hg)::double / wd)) x2, least(1, x.y2 * (greatest(wd, hg)::double / hg)) y2,
    {_UNIT} e, b.w - 0.1 shift, case when b.cx - 0.5 > 0 then b.cx - 0.5 + 1 else exp(b.cx - 0.5) end scale, b.obj / 1000 obj from k join f_boxes b on b.img = k.img and b.rid = k.x.rid),
  g as (select img, unnest(range(32)) slot from (select distinct img from f_boxes))
  select g.img, g.slot, {", ".join(f"coalesce({_half_sql(c)}, 0) {c}" for c in ("x1", "y1", "x2", "y2"))}, {", ".join(f"coalesce({_half_sql(f'e[{n}]')}, 0) e{n}" for n in (1, 2, 3))},
    coalesce({_half_sql("shift")}, -10000) shift, coalesce({_half_sql("scale")}, -10000) scale, coalesce({_half_sql("obj")}, -10000) objectness
  from g left join f on f.img = g.img and f.slot = g.slot"""
)
def detection_plan(spark, sf):
    raw = view(spark, sf, "boxes").withColumns({"obj": F.col("obj") / 1000, "shift": F.col("w") - 0.1, "scale": F.col("cx") - 0.5, "emb": F.array(F.col("cx") + 1, F.col("cy") + 1, "w")})
    sizes = raw.select("img", (640 + F.col("img") % 5 * 100).alias("width"), F.lit(480).alias("height")).distinct()
    got = pipelines.detection_plan(raw, sizes)
    return got.select("img", "slot", *[F.col(f"box.{c}").alias(c) for c in ("x1", "y1", "x2", "y2")], *[F.get("emb", F.lit(n - 1)).alias(f"e{n}") for n in (1, 2, 3)], "shift", "scale", "objectness")
