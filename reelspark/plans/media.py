"""Queries on names, times, texts and records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelspark.functions import clips as cl
from reelspark.functions import texts as tx
from reelspark.functions import times as tm
from reelspark.operators.resume import last_per_key
from reelspark.plans import stand_ins as st
from reelspark.plans.registry import query, table
from reelspark.sources import records, subtitles


@query(f"""WITH {st.CLIPS} SELECT clip, file, round(("end"-"start")/24.0, 6) AS for_statistics, round(("end"-"start"+1)/24.0, 6) AS for_detection, "end" > "start" AND "end"-"start" >= 48 AS long_enough FROM clips""")
def clip_duration_variants(spark: SparkSession, d: str) -> DataFrame:
    f = F.col("file")
    return st.clips(spark, d).select("clip", "file", F.round(cl.duration_by_prefix(f), 6).alias("for_statistics"), F.round(cl.duration_by_suffix(f), 6).alias("for_detection"), cl.is_long_enough(f).alias("long_enough"))


@query("""WITH t AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_id * 7 / 100.0::DOUBLE WHEN 1 THEN event_id / 8.0::DOUBLE ELSE event_id * 5 / 1000.0::DOUBLE END AS s FROM events)
SELECT event_id, printf('%02d', CAST(floor(s / 60) AS BIGINT)) || ':' || printf('%05.2f', s % 60) AS text FROM t""")
def format_time(spark: SparkSession, d: str) -> DataFrame:
    """Among the times are halves of hundredths, and numbers whose decimals look like halves but are none."""
    e = F.col("event_id")
    return table(spark, d, "events").select("event_id", tm.minutes_text(F.when(e % 3 == 0, e * 7 / 100.0).when(e % 3 == 1, e / 8.0).otherwise(e * 5 / 1000.0)).alias("text"))


@query("""WITH t AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_id * 13 / 10.0::DOUBLE WHEN 1 THEN event_id / 4.0::DOUBLE ELSE event_id * 5 / 100.0::DOUBLE END AS x FROM events),
u AS (SELECT event_id, CAST(floor(x / 3600) AS BIGINT) AS h, CAST(floor((x % 3600) / 60) AS BIGINT) AS m, printf('%.1fs', x % 60) AS s FROM t)
SELECT event_id, CASE WHEN h > 0 THEN h || 'h ' || m || 'm ' || s WHEN m > 0 THEN m || 'm ' || s ELSE s END AS text FROM u""")
def format_duration(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, d, "events").select("event_id", tm.duration_text(F.when(e % 3 == 0, e * 13 / 10.0).when(e % 3 == 1, e / 4.0).otherwise(e * 5 / 100.0)).alias("text"))


@query("""WITH t AS (SELECT conv_id AS clip, CAST(sum(length(text)) AS BIGINT) AS s FROM conversations GROUP BY conv_id)
SELECT clip, lpad(CAST(s//3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST((s%3600)//60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(s%60 AS VARCHAR), 2, '0') || ',500' AS code, s + 0.5::DOUBLE AS seconds FROM t""")
def srt_timestamp(spark: SparkSession, d: str) -> DataFrame:
    """Times written as SRT and read again."""
    sums = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("clip")).agg((F.sum(F.length("text")) + 0.5).alias("s"))
    return sums.select("clip", tm.srt_time(F.col("s")).alias("code")).withColumn("seconds", tm.srt_seconds(F.col("code")))


@query("SELECT conv_id AS clip, turn, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS text FROM conversations")
def strip_speaker_prefix(spark: SparkSession, d: str) -> DataFrame:
    """Four forms of prefixes put before the texts, and taken away again."""
    forms = F.array(F.lit("[SPEAKER_0"), F.lit("speaker 1"), F.lit("[ Unknown ]: "), F.lit("UNKNOWN "))
    k = (F.col("turn") % 4).cast("int")
    prefix = F.when(k == 0, F.concat(F.get(forms, 0), F.col("turn").cast("string"), F.lit("]: "))).when(k == 1, F.concat(F.get(forms, 1), F.lit(": "))).otherwise(F.get(forms, k))
    rows = table(spark, d, "conversations")
    return rows.select(F.col("conv_id").alias("clip"), "turn", tx.without_speaker(F.concat(prefix, F.col("text"))).alias("text"))


_LINES = "SELECT doc_id, CASE WHEN length(text) > 72 THEN left(text, 69) || '...' ELSE text END AS line FROM documents"


@query(_LINES)
def subtitle_lines(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts, of any length, as lines on the picture."""
    return table(spark, d, "documents").select("doc_id", tx.ellipsis(F.col("text")).alias("line"))


@query(_LINES)
def subtitle_lines_whole(spark: SparkSession, d: str) -> DataFrame:
    """The same, under the name it had while ``subtitle_lines`` took beginnings of texts."""
    return subtitle_lines(spark, d)


def _salvage(variant: int):
    def run(spark: SparkSession, d: str) -> DataFrame:
        parsed = st.answers(spark, d).withColumn("v", tx.salvaged_json(F.col("answer"), variant))
        n = F.try_variant_get("v", "$.n", "bigint")
        return parsed.select("id", F.coalesce(n, F.lit(-1).cast("long")).alias("n"), tx.parse_status(F.col("v")).alias("status"))

    run.__name__ = f"salvage_json_v{variant}"
    run.__doc__ = f"JSON out of answers in five forms, by variant {variant}; answers without any are parse errors."
    return run


for _v in (1, 2, 3):
    query("SELECT doc_id AS id, CASE WHEN doc_id%5 = 3 THEN -1 ELSE n_chars END AS n, CASE WHEN doc_id%5 = 3 THEN 'parse_error' ELSE 'success' END AS status FROM documents")(_salvage(_v))


@query("SELECT CASE WHEN doc_id%5 = 3 THEN 'parse_error' ELSE 'success' END AS status, count(*) AS n FROM documents GROUP BY 1")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return _salvage(1)(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id AS id, 'sorry, no answer' AS answer FROM documents WHERE doc_id%5 = 3")
def failed_answers(spark: SparkSession, d: str) -> DataFrame:
    """The raw text of what could not be read, kept for a second look."""
    parsed = st.answers(spark, d).withColumn("status", tx.parse_status(tx.salvaged_json(F.col("answer"), 1)))
    return parsed.filter("status = 'parse_error'").select("id", "answer")


@query(f"""WITH {st.SEGMENTS}, c AS (
  SELECT clip, turn, row_number() OVER (PARTITION BY clip ORDER BY turn) AS idx, "start" * 1.0::DOUBLE AS "start", "end" * 1.0::DOUBLE AS "end",
    CASE WHEN turn % 5 = 4 THEN '' ELSE trim(regexp_replace(text, '\\s+', ' ', 'g')) END AS said, CASE turn % 4 WHEN 1 THEN '' WHEN 2 THEN '' ELSE '[' || speaker || '] ' END AS prefix
  FROM segments WHERE "end" > "start")
SELECT clip, idx, "start", "end", trim(prefix || said) AS text FROM c WHERE trim(prefix || said) <> ''""")
def srt_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Turns written as SRT files and read again: speakers' numbers and UNKNOWN go, and with them the cues of nothing else."""
    cues = st.segments(spark, d).filter("end > start").withColumn("text", F.when(F.col("turn") % 5 == 4, F.lit("")).otherwise(F.trim(F.regexp_replace("text", r"\s+", " "))))
    speaker = F.when(F.col("turn") % 4 == 2, F.concat(F.lit("SPEAKER_0"), F.col("turn").cast("string"))).when(F.col("turn") % 4 != 1, F.col("speaker"))
    return subtitles.srt_cues(subtitles.srt_texts(cues.withColumn("speaker", speaker), "clip", "turn"), "clip")


@query("SELECT user_id % 50 AS file, max(event_id) AS line_no, max_by(event_type, event_id) AS kind FROM events WHERE event_id % 7 <> 0 GROUP BY 1")
def jsonl_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """Records of which each seventh line is malformed; of each file the last good one."""
    good = F.concat(F.lit('{"file": '), (F.col("user_id") % 50).cast("string"), F.lit(', "kind": "'), F.col("event_type"), F.lit('"}'))
    line = F.when(F.col("event_id") % 7 == 0, F.lit('{"file": 1, broken')).otherwise(good)
    rows = table(spark, d, "events").select(F.col("event_id").alias("line_no"), line.alias("line"))
    return records.latest_records(rows, ["file"], "file bigint, kind string")


@query("""SELECT conv_id AS clip, turn + 1 AS idx, turn * 2.0::DOUBLE AS "start", turn * 2.0::DOUBLE + 1.235 AS "end", 'w' || turn AS text FROM conversations WHERE turn % 3 <> 1 AND turn % 5 <> 4 AND conv_id % 5 <> 3""")
def word_entries(spark: SparkSession, d: str) -> DataFrame:
    """Words of transcripts, each third without an end, each fifth a speaker's name only; numbers count all of them. Each fifth transcript has an empty list of its own words, which counts."""
    end = F.when(F.col("turn") % 3 == 1, F.lit("null")).otherwise(F.concat((F.col("turn") * 2 + 1).cast("string"), F.lit(".2349")))
    said = F.concat(F.when(F.col("turn") % 2 == 0, F.lit("[SPEAKER_01]: ")).otherwise(F.lit("unknown: ")), F.when(F.col("turn") % 5 == 4, F.lit("")).otherwise(F.concat(F.lit("w"), F.col("turn").cast("string"))))
    word = F.concat(F.lit('{"word": " '), said, F.lit('", "start": '), (F.col("turn") * 2).cast("string"), F.lit(', "end": '), end, F.lit("}"))
    docs = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("clip")).agg(F.array_sort(F.collect_list(F.struct("turn", word.alias("w")))).alias("ws"))
    own = F.when(F.col("clip") % 5 == 3, F.lit('"word_segments": [], ')).otherwise(F.lit(""))
    docs = docs.select("clip", F.concat(F.lit("{"), own, F.lit('"segments": [7, {"words": ['), F.array_join(F.transform("ws", lambda x: x["w"]), ","), F.lit("]}]}")).alias("text"))
    return subtitles.transcript_words(records.tolerant_documents(docs), "clip")


@query(f"""WITH {st.FRAME_SCORES} SELECT movie, count(*) AS shots, movie <> 'view' AS complete FROM frame_scores GROUP BY movie""")
def shot_list_complete(spark: SparkSession, d: str) -> DataFrame:
    """Shot lists of which one lacks its end mark; comments are no shots."""
    frames = st.frame_scores(spark, d).select("movie", F.col("frame").alias("line_no"), F.concat_ws(" ", "frame", F.col("frame") + 1).alias("line"))
    comment = frames.select("movie").distinct().select("movie", F.lit(-1).cast("long").alias("line_no"), F.lit("# shots").alias("line"))
    mark = comment.filter("movie <> 'view'").select("movie", F.lit(10**9).alias("line_no"), F.lit(records.COMPLETE).alias("line"))
    rows = frames.unionByName(comment).unionByName(mark)
    shots = records.shots(rows, "movie").groupBy("movie").agg(F.count(F.lit(1)).alias("shots"))
    return shots.join(records.is_complete(rows, "movie"), "movie")


@query(f"""WITH {st.FLAGS} SELECT clip, coalesce(has_person, false) AND coalesce(NOT has_text, true) AND clip%3 <> 0 AS lenient, has_text IS NOT NULL OR clip%4 = 0 AS text_done FROM flags""")
def lenient_valid_clips(spark: SparkSession, d: str) -> DataFrame:
    """Screening records as JSON, where each third lacks the text entry and each fourth has an error."""
    rows = st.flags(spark, d)
    flag = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    text = F.when(F.col("clip") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(', "has_text": '), flag("has_text")))
    error = F.when(F.col("clip") % 4 == 0, F.lit(', "ocr_error": "x"')).otherwise(F.lit(""))
    record = F.parse_json(F.concat(F.lit('{"has_person": '), flag("has_person"), text, error, F.lit("}")))
    # Done is judged on the whole record, before the text entry is left out.
    whole = F.parse_json(F.concat(F.lit('{"has_text": '), flag("has_text"), error, F.lit("}")))
    return rows.select("clip", records.lenient_valid(record).alias("lenient"), records.screened(whole, "has_text", "ocr_error").alias("text_done"))


@query("SELECT conv_id AS clip, bool_or(regexp_matches(text, '[\\p{L}\\p{N}]')) AS dialogue FROM conversations GROUP BY conv_id")
def real_dialogue(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").groupBy(F.col("conv_id").alias("clip")).agg(F.bool_or(tx.has_words(F.col("text"))).alias("dialogue"))


#: The parts of the image-editing prompt.
_SHOTS = {"half_body": "半身", "full_body": "全身", "close_up": "特写", "upper_body": "上半身", "medium_shot": "中景", "long_shot": "远景"}
_FRAMING = {name: f"转化为标准的{shot}直立站姿照片。" for name, shot in _SHOTS.items()}
_OPENING, _OTHER = "基于原图人物进行编辑。", "转化为标准的人像照片，景别与构图可根据原图内容自行合理判断。"
_FACING = ("正面", "背面")
_CLOSING = ("最重要约束：生成的人物必须是", "视角。绝不可旋转人物身体。保持所有服装、头发和配件细节与原图完美一致。纯白色背景。3:4纵向比例。")


@query(f"""WITH {st.FLAGS}
SELECT clip, '{_OPENING}' || CASE clip%3 WHEN 0 THEN '{_FRAMING["half_body"]}' WHEN 1 THEN '{_FRAMING["close_up"]}' ELSE '{_OTHER}' END || '{_CLOSING[0]}' || CASE WHEN coalesce(has_person, false) THEN '{_FACING[0]}' ELSE '{_FACING[1]}' END || '{_CLOSING[1]}' AS prompt FROM flags""")
def prompt_template(spark: SparkSession, d: str) -> DataFrame:
    shot = F.when(F.col("clip") % 3 == 0, F.lit("half_body")).when(F.col("clip") % 3 == 1, F.lit("close_up"))
    return st.flags(spark, d).select("clip", tx.prompt(F.col("has_person"), shot, _OPENING, _FRAMING, _OTHER, _FACING, _CLOSING).alias("prompt"))


@query("SELECT user_id AS track, count(*) AS n, max(event_id) AS last FROM events GROUP BY user_id")
def merged_records(spark: SparkSession, d: str) -> DataFrame:
    """Counts and the last record of each track."""
    rows = table(spark, d, "events").select(F.col("user_id").alias("track"), F.col("event_id").alias("pos"), "value")
    n = rows.groupBy("track").agg(F.count(F.lit(1)).alias("n"))
    return last_per_key(rows, ["track"], "pos").select("track", F.col("pos").alias("last")).join(n, "track")
