"""Queries on listings, subtitle files, model answers and chains of stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch
from reelspark.functions import clips as cl
from reelspark.functions import speakers
from reelspark.functions import texts as tx
from reelspark.operators import resume
from reelspark.operators import sequences as seq
from reelspark.plans import stand_ins as st
from reelspark.plans.registry import query, table
from reelspark.plans.series import _SCENES
from reelspark.sources import files, records, subtitles
from reelspark.streaming import stages


def _paths(spark: SparkSession, d: str) -> DataFrame:
    """Files of line items: images in several spellings, normalised ones and others."""
    number = F.col("l_linenumber")
    ending = F.element_at(F.array(*[F.lit(x) for x in (".jpg", ".JPG", ".jpeg", ".JPEG", "_norm.jpg", ".png", ".mp4")]), number)
    name = F.concat(F.lit("m "), (F.col("l_orderkey") % 7).cast("string"), F.lit("/scene_"), F.col("l_orderkey").cast("string"), F.when(number % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("_person"), number.cast("string"))), ending)
    return table(spark, d, "lineitem").select(name.alias("path"))


_PATHS = """paths AS (SELECT 'm ' || (l_orderkey % 7) || '/scene_' || l_orderkey || CASE WHEN l_linenumber % 7 = 0 THEN '' ELSE '_person' || l_linenumber END ||
  ['.jpg', '.JPG', '.jpeg', '.JPEG', '_norm.jpg', '.png', '.mp4'][l_linenumber] AS path FROM lineitem)"""


@query(f"WITH {_PATHS} SELECT DISTINCT path FROM paths WHERE regexp_matches(path, '_person[^/]*\\.(jpg|JPG|jpeg|JPEG)$') AND NOT regexp_matches(path, '_norm[^/]*$')")
def person_image_files(spark: SparkSession, d: str) -> DataFrame:
    """Images by any of four patterns, once each, without normalised copies."""
    return files.without_normalised(files.matching(_paths(spark, d)))


@query(f"""WITH {_PATHS} SELECT regexp_extract(path, 'scene_[0-9]+') AS clip, string_agg(path, ',' ORDER BY path) AS images FROM paths WHERE path LIKE '%\\_person%' ESCAPE '\\' AND path LIKE '%\\_norm%' ESCAPE '\\' GROUP BY 1""")
def normalised_images(spark: SparkSession, d: str) -> DataFrame:
    """The normalised images of each clip in order."""
    return files.person_images(_paths(spark, d), True).select("clip", F.array_join("images", ",").alias("images"))


@query(f"WITH {_PATHS} SELECT path FROM (SELECT DISTINCT path FROM paths WHERE path LIKE '%.mp4') ORDER BY path LIMIT 40")
def first_files(spark: SparkSession, d: str) -> DataFrame:
    """The first forty films in the order of their paths."""
    return files.matching(_paths(spark, d), ("*.mp4",)).orderBy("path").limit(40)


@query(f"""WITH {_PATHS} SELECT path, path[7 + length(regexp_extract(path, '^m [0-9]+/')) - 6:] AS relative, regexp_replace(path, '\\.[^./]*$', '.json') AS output, '/data/' || regexp_extract(path, '^[^/]*') || '/asd/' || regexp_extract(path, '/(.*)\\.', 1) || '/results/process_status.json' AS status_file FROM (SELECT DISTINCT path FROM paths WHERE path LIKE '%.mp4')""")
def output_paths(spark: SparkSession, d: str) -> DataFrame:
    """Where a film's outputs go: its path below the movie, the JSON beside it, its status file in the workspace."""
    path = F.col("path")
    movie = F.substring_index(path, "/", 1)
    status = cl.workspace_path("/data", F.concat_ws("/", movie, F.lit("asd"), cl.stem(path)), "results", "process_status.json")
    return files.matching(_paths(spark, d), ("*.mp4",)).select("path", cl.relative_path(path, movie).alias("relative"), cl.with_suffix(path, ".json").alias("output"), status.alias("status_file"))


@query("""WITH s AS (SELECT DISTINCT conv_id AS c FROM conversations)
SELECT 'm/' || c || CASE c % 3 WHEN 0 THEN '.srt' WHEN 1 THEN '.SRT' ELSE '.JSON' END AS path, CASE WHEN c % 3 = 2 THEN 'word' ELSE 'sentence' END AS granularity, CASE WHEN c % 2 = 0 THEN 'm/' || c || '.json' END AS companion FROM s""")
def subtitle_sources(spark: SparkSession, d: str) -> DataFrame:
    """How each subtitle file is read, and the transcript beside it; each second clip has one."""
    c = F.col("conv_id")
    ids = table(spark, d, "conversations").select("conv_id").distinct()
    ending = F.element_at(F.array(F.lit(".srt"), F.lit(".SRT"), F.lit(".JSON")), (c % 3 + 1).cast("int"))
    found = ids.select(F.concat(F.lit("m/"), c.cast("string"), ending).alias("path"))
    there = ids.filter(c % 2 == 0).select(F.concat(F.lit("m/"), c.cast("string"), F.lit(".json")).alias("path"))
    return files.with_companions(found, there).select("path", cl.granularity(F.col("path")).alias("granularity"), "companion")


@query(f"""WITH {st.SEGMENTS}, s AS (SELECT * FROM segments WHERE "end" > "start")
SELECT clip, row_number() OVER (PARTITION BY clip ORDER BY turn) AS idx, "start" * 1.0::DOUBLE AS "start", "end" * 1.0::DOUBLE AS "end", CASE WHEN clip % 2 = 0 THEN 'w' || turn ELSE '[' || speaker || '] t' || turn END AS text, CASE WHEN clip % 2 = 0 THEN 'word' ELSE 'sentence' END AS granularity FROM s""")
def subtitle_entries(spark: SparkSession, d: str) -> DataFrame:
    """Entries of transcripts (even clips) and of SRT files (odd ones), each file read as its name says."""
    rows = st.segments(spark, d).filter("end > start")
    word = F.concat(F.lit('{"word": " w'), F.col("turn").cast("string"), F.lit('", "start": '), F.col("start").cast("string"), F.lit(', "end": '), F.col("end").cast("string"), F.lit("}"))
    docs = rows.filter("clip % 2 = 0").groupBy("clip").agg(F.array_sort(F.collect_list(F.struct("turn", word.alias("w")))).alias("ws"))
    docs = docs.select("clip", F.lit("a.json").alias("path"), F.concat(F.lit('{"word_segments": ['), F.array_join(F.transform("ws", lambda x: x["w"]), ","), F.lit("]}")).alias("text"))
    srt = subtitles.srt_texts(rows.filter("clip % 2 = 1").withColumn("text", F.concat(F.lit("t"), F.col("turn").cast("string"))), "clip", "turn")
    return subtitles.entries(docs.unionByName(srt.select("clip", F.lit("a.srt").alias("path"), "text")), "clip")


@query("""WITH t AS (SELECT conv_id AS clip, bool_or(regexp_matches(text, '[\\p{L}\\p{N}]')) AS said FROM conversations GROUP BY conv_id)
SELECT clip, CASE clip % 4 WHEN 0 THEN said WHEN 1 THEN true ELSE false END AS dialogue FROM t""")
def dialogue_of_transcripts(spark: SparkSession, d: str) -> DataFrame:
    """Real dialogue of transcripts: by segments; by words where segments are blank; none where both are, or are dots."""
    said = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("clip")).agg(F.concat_ws(" ", F.collect_list("text")).alias("said"))
    k = F.col("clip") % 4
    segment = F.when(k == 0, F.col("said")).when(k == 3, F.lit("...")).otherwise(F.lit("  "))
    words = F.when(k == 1, F.lit("word")).when(k == 3, F.lit("unheard")).otherwise(F.lit("!"))
    doc = F.to_json(F.struct(F.array(F.struct(segment.alias("text"))).alias("segments"), F.array(F.struct(words.alias("word"))).alias("word_segments")))
    return said.select("clip", subtitles.has_dialogue(F.parse_json(doc)).alias("dialogue"))


def _telling_answers() -> list[tuple[str, list[int | None], list[str]]]:
    """Answers that the three variants read differently: text, n by variant, status by variant."""
    good, bad = "success", "parse_error"
    return [
        ('{"n": 1} assistant: {"n": 2}', [2, None, 2], [good, bad, good]),
        ('{"n": 1} Assistant {"n": 2}', [2, None, None], [good, bad, bad]),
        ('{"n": 3, "t": "assistant"}', [3, 3, None], [good, good, bad]),
        ("{}", [None, None, None], [bad, bad, good]),
        ('```json {"n": 4} ```', [4, 4, 4], [good, good, good]),
        ('say {"n": 5} to the assistant', [5, 5, None], [good, good, bad]),
        ("assistant: nothing", [None, None, None], [bad, bad, bad]),
    ]


def _case(values: list, quote: bool = False) -> str:
    return "CASE doc_id % 7 " + " ".join(f"WHEN {k} THEN " + ("NULL" if v is None else f"'{v}'" if quote else str(v)) for k, v in enumerate(values)) + " END"


@query("SELECT doc_id AS id, " + ", ".join(f"CAST({_case([a[1][v] for a in _telling_answers()])} AS BIGINT) AS n{v + 1}, {_case([a[2][v] for a in _telling_answers()], True)} AS status{v + 1}" for v in range(3)) + " FROM documents")
def salvage_variants(spark: SparkSession, d: str) -> DataFrame:
    """What each variant makes of answers that tell them apart; the third counts an empty object as read."""
    answer = F.element_at(F.array(*[F.lit(a[0]) for a in _telling_answers()]), (F.col("doc_id") % 7 + 1).cast("int"))
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("id"), answer.alias("answer"))
    out = []
    for v in (1, 2, 3):
        parsed = tx.salvaged_json(F.col("answer"), v)
        out += [F.try_variant_get(parsed, "$.n", "bigint").alias(f"n{v}"), tx.parse_status(parsed, empty_is_error=v != 3).alias(f"status{v}")]
    return rows.select("id", *out)


@query("""SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN 'v' || doc_id ELSE 'stem' || doc_id END AS video_id, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '1.5' ELSE 'unknown' END AS duration_sec,
  CASE WHEN doc_id % 2 = 0 THEN '["a"]' ELSE '[]' END AS characters, '{}' AS caption FROM documents""")
def caption_defaults(spark: SparkSession, d: str) -> DataFrame:
    """Captions with what they lack filled in; a null that is there stays."""
    i = F.col("doc_id").cast("string")
    duration = F.when(F.col("doc_id") % 3 == 0, F.lit(', "duration_sec": null')).when(F.col("doc_id") % 3 == 1, F.lit(', "duration_sec": 1.5')).otherwise(F.lit(""))
    named = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(', "video_id": "v'), i, F.lit('", "characters": ["a"]'))).otherwise(F.lit(""))
    record = F.parse_json(F.concat(F.lit('{"x": 1'), duration, named, F.lit("}")))
    empty = lambda s: F.parse_json(F.lit(s))
    defaults = {"video_id": F.parse_json(F.concat(F.lit('"stem'), i, F.lit('"'))), "duration_sec": empty('"unknown"'), "shot": empty("{}"), "scene": empty("{}"), "characters": empty("[]"), "interactions": empty("[]"), "caption": empty("{}")}
    full = table(spark, d, "documents").select(F.col("doc_id").alias("id"), records.with_defaults(record, defaults).alias("r"))
    text = lambda k: F.try_variant_get(f"r.{k}", "$", "string").alias(k)
    return full.select("id", text("video_id"), text("duration_sec"), F.to_json("r.characters").alias("characters"), F.to_json("r.caption").alias("caption"))


@query("""WITH p AS (SELECT user_id AS clip, list({'p': event_id % 9, 'a': event_id % 500, 'b': event_id % 300, 'c': 500 + event_id % 400, 'd': 600 + event_id % 399} ORDER BY event_id) AS ps FROM events GROUP BY user_id)
SELECT clip, array_to_string(list_transform(ps, lambda x: '- <char_' || x.p || '> is located at bounding box [x_min:0.' || lpad(CAST(x.a AS VARCHAR), 3, '0') || ', y_min:0.' || lpad(CAST(x.b AS VARCHAR), 3, '0') || ', x_max:0.' || lpad(CAST(x.c AS VARCHAR), 3, '0') || ', y_max:0.' || lpad(CAST(x.d AS VARCHAR), 3, '0') || ']' || chr(10)), '') AS lines FROM p
UNION ALL SELECT -1 - c_custkey, 'No specific main characters detected. Describe the scene generally.' FROM customer""")
def character_lines(spark: SparkSession, d: str) -> DataFrame:
    """Characters and their boxes as lines of a prompt; customers stand for clips without any."""
    e = F.col("event_id")
    item = F.struct(e, (e % 9).alias("person_id"), (e % 500 / 1000).alias("x_min"), (e % 300 / 1000).alias("y_min"), ((500 + e % 400) / 1000).alias("x_max"), ((600 + e % 399) / 1000).alias("y_max"))
    people = table(spark, d, "events").groupBy(F.col("user_id").alias("clip")).agg(F.array_sort(F.collect_list(item)).alias("people"))
    nobody = table(spark, d, "customer").select((-1 - F.col("c_custkey")).alias("clip"), F.when(F.col("c_custkey") % 2 == 0, F.array()).alias("people"))
    return people.unionByName(nobody.withColumn("people", F.col("people").cast(people.schema["people"].dataType))).select("clip", speakers.character_lines(F.col("people")).alias("lines"))


@query("""SELECT role AS speaker, '{' || string_agg(turn || ':' || n, ',' ORDER BY turn) || '}' AS distribution FROM (SELECT role, turn, count(*) AS n FROM conversations GROUP BY role, turn) GROUP BY role""")
def sorted_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Counts of turns by speaker as a map, printed in the order of its keys."""
    counts = table(spark, d, "conversations").groupBy(F.col("role").alias("speaker"), "turn").agg(F.count(F.lit(1)).alias("n"))
    entries = F.array_sort(F.map_entries(F.map_from_entries(F.collect_list(F.struct("turn", "n")))))
    text = F.array_join(F.transform(entries, lambda x: F.concat(x["key"].cast("string"), F.lit(":"), x["value"].cast("string"))), ",")
    return counts.groupBy("speaker").agg(F.concat(F.lit("{"), text, F.lit("}")).alias("distribution"))


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE 'old' END AS v FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0""")
def merged_cache(spark: SparkSession, d: str) -> DataFrame:
    """Cached records where nothing newer was made, and what was."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return resume.merged(rows.filter("k % 2 = 0").withColumn("v", F.lit("old")), rows.filter("k % 3 = 0").withColumn("v", F.lit("new")), ["k"])


@query("""SELECT d.doc_id AS clip FROM documents d WHERE d.n_chars >= 48 AND EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = d.doc_id AND c.text <> '')""")
def transcribed_shots(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts with segments whose clip is still there and long enough."""
    said = table(spark, d, "conversations").filter("text <> ''").select(F.col("conv_id").alias("clip")).distinct()
    shots = st.clips(spark, d).filter(cl.is_long_enough(F.col("file"))).select("clip")
    return said.join(shots, "clip", "left_semi")


_STATUSES = ("COMPLETED", "FAILED", "NO_VALID_TRACK", "RUNNING")


@query("""WITH log AS (SELECT l_orderkey AS item, l_suppkey % 3 AS s, arg_max(l_partkey % 4, l_linenumber * 1000000 + l_partkey) AS last FROM lineitem GROUP BY l_orderkey, l_suppkey % 3),
t AS (SELECT item, s FROM log WHERE last IN (0, 2))
SELECT o_orderkey AS item, CASE WHEN o_orderkey NOT IN (SELECT item FROM t WHERE s = 0) THEN 'shots' WHEN o_orderkey NOT IN (SELECT item FROM t WHERE s = 1) THEN 'clips' WHEN o_orderkey NOT IN (SELECT item FROM t WHERE s = 2) THEN 'speakers' END AS next FROM orders""")
def next_stages(spark: SparkSession, d: str) -> DataFrame:
    """The stage that each item waits for: the first whose last status does not let it go on."""
    named = lambda c, names: F.element_at(F.array(*[F.lit(n) for n in names]), (c + 1).cast("int"))
    log = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("item"), named(F.col("l_suppkey") % 3, ("shots", "clips", "speakers")).alias("stage"), named(F.col("l_partkey") % 4, _STATUSES).alias("status"), (F.col("l_linenumber") * 1_000_000 + F.col("l_partkey")).alias("pos"))
    items = table(spark, d, "orders").select(F.col("o_orderkey").alias("item"))
    return resume.next_stage(items, log, ["item"], ["shots", "clips", "speakers"])


@query("""SELECT 'shots' AS stage, 'COMPLETED' AS status, count(*) AS items FROM documents
UNION ALL SELECT 'transcripts', CASE WHEN doc_id % 7 = 0 THEN 'FAILED' ELSE 'COMPLETED' END, count(*) FROM documents GROUP BY ALL
UNION ALL SELECT 'speakers', CASE WHEN doc_id % 5 = 0 THEN 'NO_VALID_SPEAKER' ELSE 'COMPLETED' END, count(*) FROM documents WHERE doc_id % 7 <> 0 GROUP BY ALL""")
def stage_chain(spark: SparkSession, d: str) -> DataFrame:
    """Three stages over all documents, each a stream over the table of the one before; failures and skips end there."""

    def stage(error: Column, on_failure: str):
        return lambda df: df.select("doc_id", stages.with_status(F.col("doc_id"), error, on_failure).alias("status"))

    base = scratch.shared_dir(spark) + "/" + scratch.unique("chain")
    table(spark, d, "documents").select("doc_id").write.parquet(base + "/items")
    failed = lambda k: F.when(F.col("doc_id") % k == 0, F.lit("error"))
    chain = [("shots", stage(F.lit(None).cast("string"), "FAILED")), ("transcripts", stage(failed(7), "FAILED")), ("speakers", stage(failed(5), "NO_VALID_SPEAKER"))]
    tables = stages.run_chain(spark, base + "/items", "doc_id bigint", ["doc_id"], base, chain)
    found = [spark.read.schema("doc_id bigint, status string").parquet(path).select(F.lit(name).alias("stage"), "status") for name, path in tables.items()]
    return found[0].union(found[1]).union(found[2]).groupBy("stage", "status").agg(F.count(F.lit(1)).alias("items"))


@query(_SCENES + "SELECT movie, count(*) AS shots, CAST(sum(end_frame - start_frame) AS BIGINT) AS frames, movie <> 'view' AS complete FROM r GROUP BY movie")
def shot_list_appended(spark: SparkSession, d: str) -> DataFrame:
    """Shot lists written in two runs, each appending what it found, with an end mark for all films but one, and read again."""
    base = scratch.shared_dir(spark) + "/" + scratch.unique("shot-lists")
    lines = records.shot_lines(seq.scenes(st.frame_scores(spark, d), ["movie"], "frame", "p", 0.2), "movie")
    early = F.col("line_no") < 500
    for part in (lines.filter(early), lines.filter(~early), records.end_marks(lines.filter("movie <> 'view'"), "movie")):
        part.write.mode("append").parquet(base)
    rows = spark.read.schema(lines.schema).parquet(base)
    read = records.shots(rows, "movie").groupBy("movie").agg(F.count(F.lit(1)).alias("shots"), F.sum(F.col("end_frame") - F.col("start_frame")).alias("frames"))
    return read.join(records.is_complete(rows, "movie"), "movie")
