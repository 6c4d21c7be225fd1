"""Named queries over the driver's tables, one for each family of operators, and their SQL.

The tables hold no clips; columns of theirs stand in for a clip's. Each pair of
functions below builds the stand-in once in Spark and once in SQL.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.functions import fixed_values as V
from reelspark.functions import parsing, perceptual, relevance
from reelspark.functions.taxonomy import KITCHEN, WAREHOUSE
from reelspark.operators import files, labelling, manifest, near_duplicates, report, seen, validation
from reelspark.operators.lineage import checkpoint, discard, folder, spread
from reelspark.plans import discovery
from reelspark.sources import fixtures, records, shards, snapshot

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: A lexicon of syllables that the synthetic documents do have; the spec's actions get words of it as well.
SYLLABLES = relevance.Lexicon(
    environments={"industrial_warehouse": ("here", "tion", "ing", "der"), "residential_kitchen": ("queai", "stä"), "office": ("ciónque", "ungen")},
    subjects=("eau", "que", "und", "sch"),
    actions={"reach": ("mente",), "grasp": ("los",), "lift": ("arm", "pour"), "place": ("ción",)},
    negatives=("license", "game"),
)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Relevance


def _quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def _sql_hits(words, text: str = "t") -> str:
    return " + ".join(f"contains({text}, {_quoted(w)})::INT" for w in words) or "0"


def _sql_any(words, text: str = "t") -> str:
    return " OR ".join(f"contains({text}, {_quoted(w)})" for w in words) or "false"


def _sql_scored(spec, lexicon: relevance.Lexicon, source: str) -> str:
    """source (with t) and env, subject, actions, negative, score, scenario, env_context."""
    env = [w for e in spec.environments for w in lexicon.environments.get(e, ())]
    found = ", ".join(f"CASE WHEN {_sql_any(lexicon.actions.get(a, ()))} THEN '{a}' END" for a in spec.actions)
    places = " ".join(f"WHEN {_sql_any(lexicon.environments[e])} THEN '{e}'" for e in V.ENV_TYPES if lexicon.environments.get(e))
    return f"""
      SELECT *, least(env, 3) * 2.0::DOUBLE + least(subject, 3) * 1.5::DOUBLE + len(actions) * 1.5::DOUBLE - negative * 3.0::DOUBLE AS score
      FROM (SELECT *, {_sql_hits(env)} AS env, {_sql_hits(lexicon.subjects)} AS subject, list_filter([{found}], lambda x: x IS NOT NULL) AS actions,
                   {_sql_hits(lexicon.negatives)} AS negative, CASE WHEN {_sql_any(env)} THEN '{spec.scenario_type}' ELSE 'unknown' END AS scenario,
                   CASE {places} ELSE 'unknown' END AS env_context
            FROM ({source}))"""


_SQL_DOCUMENTS = "SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents"


def _sql_relevance(lexicon) -> str:
    return f"SELECT doc_id, score, env, subject, len(actions)::INT AS n_actions, negative, array_to_string(actions, ',') AS actions FROM ({_sql_scored(WAREHOUSE, lexicon, _SQL_DOCUMENTS)})"


def _relevance(spark, sf_dir, lexicon) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select("doc_id", relevance.relevance(F.lower(F.coalesce("text", F.lit(""))), WAREHOUSE, lexicon).alias("r"))
    return rows.select("doc_id", "r.score", "r.env", "r.subject", F.size("r.actions").alias("n_actions"), "r.negative", F.array_join("r.actions", ",").alias("actions"))


@query(_sql_relevance(relevance.Lexicon()))
def relevance_score_default(spark, sf_dir):
    return _relevance(spark, sf_dir, relevance.Lexicon())


@query(_sql_relevance(SYLLABLES))
def relevance_score_test(spark, sf_dir):
    return _relevance(spark, sf_dir, SYLLABLES)


@query(f"SELECT doc_id, scenario, env_context FROM ({_sql_scored(WAREHOUSE, SYLLABLES, _SQL_DOCUMENTS)})")
def derive_env_scenario(spark, sf_dir):
    text = F.lower(F.coalesce("text", F.lit("")))
    return _table(spark, sf_dir, "documents").select("doc_id", relevance.scenario_of(text, WAREHOUSE, SYLLABLES).alias("scenario"), relevance.env_of(text, SYLLABLES).alias("env_context"))


# Labelling


def _videos(spark, sf_dir, platform: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("ord"), F.lit("{}").alias("raw"), F.when(F.col("source") == "src7", F.lit("")).otherwise(F.concat(F.lit("https://example.com/"), F.col("source"), F.lit("/"), F.col("n_chars").cast("string"))).alias("source_url"),
        (F.greatest(F.col("n_chars") - 300, F.lit(0)) * 20).alias("duration_ms"), F.lower(F.coalesce("text", F.lit(""))).alias("text"), F.lit(platform).alias("platform"),
        F.lit(0.0).alias("fps"), F.lit(0).alias("width"), F.lit(0).alias("height"),
    )


def _sql_windows(duration: str, spec=WAREHOUSE, most: int = 3) -> str:
    longest, least = spec.max_duration_ms, spec.min_duration_ms
    return f"list_filter(list_transform(range(0, least({most}, ceil({duration} / {longest}.0))::BIGINT), lambda i: {{'s': i * {longest}, 'e': least((i + 1) * {longest}, {duration})}}), lambda x: x.e - x.s >= {least})"


def _sql_judged(platform: str) -> str:
    source = """SELECT doc_id AS ord, CASE WHEN source = 'src7' THEN '' ELSE 'https://example.com/' || source || '/' || n_chars END AS source_url,
                       greatest(n_chars - 300, 0) * 20 AS duration_ms, lower(coalesce(text, '')) AS t FROM documents"""
    whole = f"CASE WHEN duration_ms >= {WAREHOUSE.min_duration_ms} THEN [{{'s': 0::BIGINT, 'e': duration_ms}}] ELSE [] END"
    return f"""
      SELECT *, CASE WHEN source_url = '' THEN 'no_url' WHEN duration_ms <= 0 THEN 'no_duration' WHEN score < 4 THEN 'low_score'
                     WHEN scenario = 'unknown' AND env_context = 'unknown' THEN 'no_env' WHEN len(windows) = 0 THEN 'no_window' END AS reason
      FROM (SELECT *, {whole if platform == "tiktok" else _sql_windows("duration_ms")} AS windows FROM ({_sql_scored(WAREHOUSE, SYLLABLES, source)}))"""


@query(f"SELECT reason, count(*) AS n FROM ({_sql_judged('youtube')}) WHERE reason IS NOT NULL GROUP BY reason")
def label_reject_histogram(spark, sf_dir):
    return labelling.rejects(labelling.judged(_videos(spark, sf_dir, "youtube"), WAREHOUSE, lexicon=SYLLABLES))


def _sql_clips(platform: str, order: int) -> str:
    boundary = "whole_video" if platform == "tiktok" else "fixed_window"
    return f"""SELECT {order} AS platform_order, ord, win - 1 AS win, scenario AS scenario_type, CASE WHEN env_context = 'unknown' THEN 'industrial_warehouse' ELSE env_context END AS env_context,
      array_to_string(actions, ',') AS actions, windows[win].s AS start_ms, windows[win].e AS end_ms, 30.0::DOUBLE AS fps, source_url, '{boundary}' AS boundary, score
      FROM (SELECT *, unnest(range(1, len(windows) + 1)) AS win FROM ({_sql_judged(platform)}) WHERE reason IS NULL)"""


def _clips(spark, sf_dir, platform: str, order: int) -> DataFrame:
    found = labelling.clips(labelling.judged(_videos(spark, sf_dir, platform), WAREHOUSE, lexicon=SYLLABLES), WAREHOUSE)
    return found.select(
        F.lit(order).alias("platform_order"), "ord", F.col("win").cast("long").alias("win"), "scenario_type", "env_context", F.array_join("actions", ",").alias("actions"), "start_ms", "end_ms", "fps",
        "source_url", F.col("_clip_boundary").alias("boundary"), F.col("_relevance_score").alias("score"),
    )


@query(_sql_clips("youtube", 0))
def label_clips(spark, sf_dir):
    return _clips(spark, sf_dir, "youtube", 0)


_SQL_BOTH = f"SELECT * FROM ({_sql_clips('youtube', 0)}) UNION ALL SELECT * FROM ({_sql_clips('tiktok', 1)})"


@query(f"SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY platform_order, ord, win) AS k FROM ({_SQL_BOTH})) WHERE k = 1 ORDER BY platform_order, ord, win LIMIT 60")
def discovery_candidates(spark, sf_dir):
    both = _clips(spark, sf_dir, "youtube", 0).unionByName(_clips(spark, sf_dir, "tiktok", 1))
    return discovery.deduplicated(both, 60)


def _seconds(spark, sf_dir) -> DataFrame:
    return _table(spark, sf_dir, "events").select("event_id", (F.col("value") * 1000).cast("long").alias("ms"))


def _windowed(spark, sf_dir, platform: str) -> DataFrame:
    return _seconds(spark, sf_dir).select("event_id", F.explode(labelling.windows(F.col("ms"), F.lit(platform), WAREHOUSE)).alias("w")).select("event_id", "w.start_ms", "w.end_ms")


_SQL_SECONDS = "SELECT event_id, trunc(value * 1000)::BIGINT AS ms FROM events"


@query(f"SELECT event_id, w.s AS start_ms, w.e AS end_ms FROM (SELECT event_id, unnest({_sql_windows('ms')}) AS w FROM ({_SQL_SECONDS}))")
def segment_windows(spark, sf_dir):
    return _windowed(spark, sf_dir, "youtube")


@query(f"SELECT event_id, 0::BIGINT AS start_ms, ms AS end_ms FROM ({_SQL_SECONDS}) WHERE ms >= {WAREHOUSE.min_duration_ms}")
def segment_windows_whole(spark, sf_dir):
    return _windowed(spark, sf_dir, "tiktok")


# Adapters and scalar readers


@query("""
SELECT doc_id AS ord, 'https://example.com/' || source AS source_url, n_chars * 1000 AS duration_ms,
       lower(concat_ws(' ', nullif(lang, ''), nullif(trim(text, chr(10) || ' '), ''), source || ' ' || lang)) AS text, 1280 AS width, 720 AS height, 29.97::DOUBLE AS fps
FROM documents""")
def adapt_youtube(spark, sf_dir):
    raw = F.to_json(F.struct(
        F.lit("").alias("url"), F.concat(F.lit("https://example.com/"), F.col("source")).alias("link"), F.col("n_chars").alias("video_length"), F.col("lang").alias("title"), F.col("text").alias("description"),
        F.array("source", F.lit(""), "lang").alias("tags"), F.lit("720p").alias("current_optimal_res"), F.lit("29.97").alias("fps")))
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), raw.alias("raw"))
    return labelling.adapt(docs, "youtube").select("ord", "source_url", "duration_ms", "text", "width", "height", "fps")


@query("""
SELECT doc_id AS ord, 'https://example.com/' || source AS source_url, n_chars * 60000 AS duration_ms, lower(concat_ws(' ', nullif(trim(text, chr(10) || ' '), ''), lang)) AS text, 0 AS width, 0 AS height, 0::DOUBLE AS fps
FROM documents""")
def adapt_tiktok(spark, sf_dir):
    raw = F.to_json(F.struct(
        F.concat(F.lit("https://example.com/"), F.col("source")).alias("网址"), F.concat(F.col("n_chars").cast("string"), F.lit(":00")).alias("时长"), F.col("text").alias("caption"), F.array("lang").alias("hashtags"), F.lit("title").alias("title")))
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), raw.alias("raw"))
    return labelling.adapt(docs, "tiktok").select("ord", "source_url", "duration_ms", "text", "width", "height", "fps")


def _clock(spark, sf_dir) -> DataFrame:
    total = F.floor("value").cast("long")
    parts = F.concat_ws(":", F.floor(total / 3600).cast("string"), (F.floor(total / 60) % 60).cast("string"), (total % 60).cast("string"))
    form = F.when(F.col("event_type") == "view", parts).when(F.col("event_type") == "click", F.concat(F.lit(" "), F.col("value").cast("decimal(12,2)").cast("string"), F.lit(" "))).when(F.col("event_type") == "error", F.lit("1::2")).otherwise(F.concat_ws(":", F.floor(total / 60).cast("string"), (total % 60).cast("string")))
    return _table(spark, sf_dir, "events").select("event_id", form.alias("form"))


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN 0 WHEN 'click' THEN trunc(value::DECIMAL(12,2)::DOUBLE * 1000) ELSE floor(value) * 1000 END::BIGINT AS ms FROM events""")
def parse_duration(spark, sf_dir):
    return _clock(spark, sf_dir).select("event_id", parsing.duration_ms(F.col("form")).alias("ms"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 AND p_size * 30 >= 100 AND p_size * 40 >= 100 THEN p_size * 40 WHEN p_size % 3 = 0 AND p_size * 40 >= 100 THEN floor(p_size * 40 * 16 / 9.0::DOUBLE / 2)::INT * 2
                       WHEN p_size % 3 <> 0 AND p_size * 25 >= 100 THEN floor(p_size * 25 * 16.0::DOUBLE / 9 / 2)::INT * 2 ELSE 0 END::INT AS width,
       CASE WHEN p_size % 3 = 0 AND p_size * 30 >= 100 AND p_size * 40 >= 100 THEN p_size * 30 WHEN p_size % 3 = 0 AND p_size * 40 >= 100 THEN p_size * 40
            WHEN p_size % 3 <> 0 AND p_size * 25 >= 100 THEN p_size * 25 ELSE 0 END::INT AS height
FROM part""")
def parse_resolution(spark, sf_dir):
    size = F.col("p_size").cast("long")
    form = F.when(size % 3 == 0, F.concat((size * 40).cast("string"), F.lit(" × "), (size * 30).cast("string"))).otherwise(F.concat((size * 25).cast("string"), F.lit("P")))
    return _table(spark, sf_dir, "part").select("p_partkey", parsing.resolution(form).alias("r")).select("p_partkey", "r.width", "r.height")


@query("""
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 0.0 ELSE p_size * 1000.0::DOUBLE / (p_size % 5) END::DOUBLE AS rate, CASE WHEN p_brand LIKE '%1' THEN 0.0 ELSE p_size / 2.0::DOUBLE END::DOUBLE AS declared FROM part""")
def parse_fps(spark, sf_dir):
    size = F.col("p_size")
    pair = F.concat_ws("/", (size * 1000).cast("string"), (size % 5).cast("string"))
    told = F.when(F.col("p_brand").endswith("1"), F.lit("fast")).otherwise((size / 2).cast("string"))
    return _table(spark, sf_dir, "part").select("p_partkey", parsing.rate(pair).alias("rate"), parsing.declared_fps(told).alias("declared"))


@query("SELECT page_id, regexp_matches(url, '^(?i)https?://[^/?#]+') AS is_url, regexp_matches(replace(url, 'http', 'ftp'), '^(?i)https?://[^/?#]+') AS other FROM pages")
def url_check(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", parsing.is_url(F.col("url")).alias("is_url"), parsing.is_url(F.replace("url", F.lit("http"), F.lit("ftp"))).alias("other"))


# Validation


def _record_columns() -> dict[str, Column]:
    kind, user = F.col("event_type"), F.col("user_id")
    return {
        "scenario_type": F.when(kind == "error", F.lit("other")).otherwise(F.lit(WAREHOUSE.scenario_type)),
        "env_context": F.when(user < 5, F.lit("moon")).when(user < 8, F.lit("")).otherwise(F.lit("office")),
        "camera_pov": F.when(kind == "view", F.lit("third_person")).when(kind == "click", F.lit("wrist_mounted")).when(kind == "error", F.lit("sideways")).otherwise(F.lit("overhead")),
        "actions": F.when(user < 50, F.array(*map(F.lit, WAREHOUSE.actions))).when(user < 90, F.array(F.lit("grasp"), F.lit("place"))).when(user < 120, F.array(F.lit("grasp"), F.lit("fly"), F.lit("fly"))).otherwise(F.expr("cast(array() as array<string>)")),
        "start_ms": F.col("event_id"), "end_ms": F.col("event_id") + (F.col("value") * 1000).cast("long") - 100, "fps": user.cast("double"),
        "source_url": F.concat(F.lit("https://example.com/"), user.cast("string")),
    }


_SQL_RECORDS = f"""
  SELECT event_id AS ord, CASE WHEN event_type = 'error' THEN 'other' ELSE '{WAREHOUSE.scenario_type}' END AS scenario_type,
         CASE WHEN user_id < 5 THEN 'moon' WHEN user_id < 8 THEN '' ELSE 'office' END AS env_context,
         CASE event_type WHEN 'view' THEN 'third_person' WHEN 'click' THEN 'wrist_mounted' WHEN 'error' THEN 'sideways' ELSE 'overhead' END AS camera_pov,
         CASE WHEN user_id < 50 THEN ['reach', 'grasp', 'lift', 'place'] WHEN user_id < 90 THEN ['grasp', 'place'] WHEN user_id < 120 THEN ['grasp', 'fly', 'fly'] ELSE [] END AS actions,
         event_id AS start_ms, event_id + trunc(value * 1000)::BIGINT - 100 AS end_ms, user_id::DOUBLE AS fps, 'https://example.com/' || user_id AS source_url
  FROM events"""


def _sql_checked(relaxed: bool) -> str:
    spec = WAREHOUSE
    listed = lambda values: "[" + ", ".join(map(_quoted, values)) + "]"
    absent = "list_filter([CASE WHEN env_context = '' THEN 'missing_field:env_context' END" + ("" if relaxed else ", CASE WHEN len(actions) = 0 THEN 'missing_field:actions' END") + "], lambda x: x IS NOT NULL)"
    reasons = [
        "CASE WHEN end_ms <= start_ms THEN 'invalid_window:end<=start' END",
        f"CASE WHEN fps < {spec.min_fps} THEN 'fps_too_low:' || fps END",
        f"CASE WHEN end_ms - start_ms < {spec.min_duration_ms} THEN 'too_short:' || (end_ms - start_ms) || 'ms' END",
        f"CASE WHEN end_ms - start_ms > {spec.max_duration_ms} THEN 'too_long:' || (end_ms - start_ms) || 'ms' END",
        f"CASE WHEN scenario_type <> '{spec.scenario_type}' THEN 'scenario_mismatch:' || scenario_type END",
        f"CASE WHEN NOT list_contains({listed(V.CAMERA_POVS)}, camera_pov) THEN 'unknown_pov:' || camera_pov WHEN NOT list_contains({listed(spec.camera_povs)}, camera_pov) THEN 'pov_out_of_scope:' || camera_pov END",
        f"CASE WHEN NOT list_contains({listed(V.ENV_TYPES)}, env_context) THEN 'unknown_env:' || env_context END",
        f"CASE WHEN len(list_filter(actions, lambda a: NOT list_contains({listed(V.ACTION_VOCAB)}, a))) > 0 THEN 'unknown_actions:' || array_to_string(list_filter(actions, lambda a: NOT list_contains({listed(V.ACTION_VOCAB)}, a)), ',') END",
    ]
    if not relaxed:
        lacking = f"list_filter({listed(spec.actions)}, lambda a: NOT list_contains(actions, a))"
        reasons.append(f"CASE WHEN len({lacking}) > 0 THEN 'incomplete_actions:missing=' || array_to_string({lacking}, ',') END")
    return f"SELECT *, CASE WHEN len({absent}) > 0 THEN {absent} ELSE list_filter([{', '.join(reasons)}], lambda x: x IS NOT NULL) END AS reasons FROM ({_SQL_RECORDS})"


def _checked(spark, sf_dir, relaxed: bool) -> DataFrame:
    raw = F.to_json(F.struct(*[v.alias(k) for k, v in _record_columns().items()]))
    events = spread(_table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value"))
    return validation.checked(events.select(F.col("event_id").alias("ord"), raw.alias("raw")), WAREHOUSE, relaxed=relaxed)


_SQL_ID = "'clip_' || sha1(source_url || '|' || start_ms || '|' || end_ms)[:16]"


def _sql_validated(relaxed: bool) -> str:
    return f"SELECT ord, len(reasons) = 0 AS ok, array_to_string(reasons, ';') AS reasons, CASE WHEN len(reasons) = 0 THEN {_SQL_ID} END AS clip_id FROM ({_sql_checked(relaxed)})"


def _validated(spark, sf_dir, relaxed: bool) -> DataFrame:
    return _checked(spark, sf_dir, relaxed).select("ord", "ok", F.array_join("reasons", ";").alias("reasons"), "record.clip_id")


@query(_sql_validated(False))
def validate_strict(spark, sf_dir):
    return _validated(spark, sf_dir, False)


@query(_sql_validated(True))
def validate_relaxed(spark, sf_dir):
    return _validated(spark, sf_dir, True)


def _sql_histogram(relaxed: bool) -> str:
    return f"SELECT split_part(r, ':', 1) AS reason, count(*) AS n FROM (SELECT unnest(reasons) AS r FROM ({_sql_checked(relaxed)})) GROUP BY 1"


@query(_sql_histogram(False))
def reject_histogram(spark, sf_dir):
    return validation.histogram(_checked(spark, sf_dir, False))


@query(f"SELECT reason, sum(n)::BIGINT AS n FROM (({_sql_histogram(False)}) UNION ALL (SELECT reason, count(*) AS n FROM ({_sql_judged('youtube')}) WHERE reason IS NOT NULL GROUP BY reason)) GROUP BY reason")
def merged_reasons(spark, sf_dir):
    both = reject_histogram(spark, sf_dir).unionByName(label_reject_histogram(spark, sf_dir))
    return both.groupBy("reason").agg(F.sum("n").alias("n"))


@query("SELECT page_id, 'clip_' || sha1(url || '|' || page_id || '|' || (page_id + 5000))[:16] AS clip_id FROM pages")
def clip_id(spark, sf_dir):
    at = F.col("page_id")
    return _table(spark, sf_dir, "pages").select("page_id", validation.clip_id(F.col("url"), F.lit(""), at.cast("string"), (at + 5000).cast("string")).alias("clip_id"))


_SQL_PROBED = """
  SELECT *, list_filter([
      CASE WHEN height < 480 THEN 'resolution_too_low' END, CASE WHEN fps < 20 THEN 'real_fps_too_low' END, CASE WHEN ms < 3000 THEN 'real_duration_too_short' END, CASE WHEN frames <= 1 THEN 'not_a_video' END,
      CASE WHEN declared > 0 AND ms > 0 AND abs(ms - declared) / declared::DOUBLE > 0.15 THEN 'duration_mismatch' END,
      CASE WHEN told > 0 AND fps > 0 AND abs(told - fps) / told > 0.05 THEN 'fps_mismatch' END], lambda x: x IS NOT NULL) AS found
  FROM (SELECT l_orderkey, l_linenumber, l_linestatus, (l_quantity * 1000)::BIGINT AS declared, trunc(l_extendedprice)::BIGINT AS ms, 25.0::DOUBLE AS told, 25.0::DOUBLE * (1 - l_discount) AS fps,
               (l_linenumber * 150)::INT AS height, l_linenumber AS frames FROM lineitem)"""


@query(f"SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'F' AND ms < 20000 THEN 'probe_failed' ELSE array_to_string(found, ';') END AS problems FROM ({_SQL_PROBED})")
def metadata_check(spark, sf_dir):
    ms = F.col("l_extendedprice").cast("long")
    probe = F.struct(
        (~((F.col("l_linestatus") == "F") & (ms < 20000))).alias("ok"), ms.alias("duration_ms"), (F.lit(25.0) * (1 - F.col("l_discount"))).alias("fps"), F.lit(640).alias("width"),
        (F.col("l_linenumber") * 150).cast("int").alias("height"), F.lit("h264").alias("codec"), F.col("l_linenumber").alias("nb_frames"), F.lit("ffprobe_failed").alias("error"))
    rows = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 1000).cast("long").alias("declared"), probe.alias("p"))
    problems = validation.probe_problems(F.col("declared"), F.lit(25.0), F.col("p"), WAREHOUSE)
    return rows.select("l_orderkey", "l_linenumber", F.array_join(F.transform(problems, lambda x: F.split_part(x, F.lit(":"), F.lit(1))), ";").alias("problems"))


# Sets and order


@query("""
SELECT host, page_id, url FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS k FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages)) WHERE k = 1""")
def url_dedup_first(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"))
    return labelling.first_per_url(pages, "host", "page_id").select("host", "page_id", "url")


@query("SELECT event_id, user_id, value FROM (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) WHERE k = 1 ORDER BY event_id LIMIT 60")
def limit_in_order(spark, sf_dir):
    events = _table(spark, sf_dir, "events").select(F.lit(0).alias("platform_order"), F.col("event_id").alias("ord"), F.lit(0).alias("win"), F.col("user_id").cast("string").alias("source_url"), "event_id", "user_id", "value")
    return discovery.deduplicated(events, 60).select("event_id", "user_id", "value")


# Signatures

PAIR_BITS = 17


def _signatures(spark, sf_dir) -> DataFrame:
    bits = F.aggregate(F.slice("embedding", 1, 63), F.lit(0).cast("bigint"), lambda n, x: n * 2 + (x > 0).cast("bigint"))
    return _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("ord"), F.array(bits).alias("sig"), F.col("label").alias("quality"))


_SQL_SIGNED = "sig AS MATERIALIZED (SELECT vec_id AS ord, label AS quality, list_reduce(list_prepend(0::BIGINT, list_transform(embedding[:63], lambda x: (x > 0)::BIGINT)), lambda a, b: a * 2 + b) AS s FROM embeddings)"
_SQL_PAIRS = f"pairs AS (SELECT a.ord AS a, b.ord AS b, bit_count(xor(a.s, b.s))::INT AS bits FROM sig a JOIN sig b ON a.ord < b.ord WHERE bit_count(xor(a.s, b.s)) <= {PAIR_BITS})"
_SQL_CLUSTERS = "ways AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), reach AS (SELECT ord AS a, ord AS b FROM sig UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a), found AS (SELECT a AS ord, min(b) AS cluster FROM reach GROUP BY a)"
_SQL_WINNERS = "won AS (SELECT ord, cluster, row_number() OVER (PARTITION BY cluster ORDER BY quality DESC, ord) = 1 AS keep FROM found JOIN sig USING (ord))"


@query(f"WITH {_SQL_SIGNED}, {_SQL_PAIRS} SELECT * FROM pairs")
def hamming_pairs(spark, sf_dir):
    return near_duplicates.hamming_pairs(_signatures(spark, sf_dir), PAIR_BITS, 1)


def _clusters(spark, sf_dir) -> DataFrame:
    return near_duplicates.clusters(_signatures(spark, sf_dir).select("ord", "sig"), PAIR_BITS, 1)


def _winners(spark, sf_dir) -> DataFrame:
    return near_duplicates.winners(_clusters(spark, sf_dir).join(_signatures(spark, sf_dir).select("ord", "quality"), "ord"))


@query(f"WITH RECURSIVE {_SQL_SIGNED}, {_SQL_PAIRS}, {_SQL_CLUSTERS} SELECT * FROM found")
def near_dup_clusters(spark, sf_dir):
    return _clusters(spark, sf_dir)


@query(f"WITH RECURSIVE {_SQL_SIGNED}, {_SQL_PAIRS}, {_SQL_CLUSTERS}, {_SQL_WINNERS} SELECT * FROM won")
def dedup_winners(spark, sf_dir):
    return _winners(spark, sf_dir)


@query(f"WITH RECURSIVE {_SQL_SIGNED}, {_SQL_PAIRS}, {_SQL_CLUSTERS}, {_SQL_WINNERS} SELECT count(*) AS n, count(*) FILTER (keep) AS clusters, count(*) FILTER (NOT keep) AS dropped, count(*) FILTER (NOT keep) / count(*)::DOUBLE AS duplicate_rate FROM won")
def dup_rate(spark, sf_dir):
    return near_duplicates.rates(_winners(spark, sf_dir))


# At the default setting: five hashes a clip, 8 bits of 64 apart on average. A document's fifths stand for
# frames, so texts of which one fifth was changed are near-duplicates.

_HASH = 15  # hexadecimal digits of a hash


def _frames(spark, sf_dir) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumn("w", F.floor(F.length("t") / 5).cast("int"))
    parts = [F.conv(F.substring(F.md5(F.expr(f"substring(t, 1 + {i} * w, w)").cast("binary")), 1, _HASH), 16, 10).cast("bigint") for i in range(perceptual.FRAMES)]
    return docs.select(F.col("doc_id").alias("ord"), F.array(*parts).alias("sig"), F.length("t").alias("quality"))


_SQL_FRAMES = "sig AS MATERIALIZED (SELECT doc_id AS ord, length(t) AS quality, " + ", ".join(f"('0x' || substr(md5(substring(t, 1 + {i} * w, w)), 1, {_HASH}))::BIGINT AS s{i}" for i in range(perceptual.FRAMES)) + " FROM (SELECT doc_id, coalesce(text, '') AS t, (length(coalesce(text, '')) // 5)::INT AS w FROM documents))"
_SQL_APART = " + ".join(f"bit_count(xor(a.s{i}, b.s{i}))::INT" for i in range(perceptual.FRAMES))
_SQL_NEAR = f"nodes AS MATERIALIZED (SELECT min(ord) AS ord, {', '.join(f's{i}' for i in range(perceptual.FRAMES))} FROM sig GROUP BY ALL), pairs AS MATERIALIZED (SELECT a.ord AS a, b.ord AS b FROM nodes a JOIN nodes b ON a.ord < b.ord WHERE {_SQL_APART} <= 8 * {perceptual.FRAMES})"
_SQL_REACH = "ways AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), reach AS (SELECT ord AS a, ord AS b FROM nodes UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a), near AS (SELECT a, min(b) AS cluster FROM reach GROUP BY a)"
_SQL_FOUND = f"found AS (SELECT sig.ord, near.cluster FROM sig JOIN nodes ON {' AND '.join(f'sig.s{i} = nodes.s{i}' for i in range(perceptual.FRAMES))} JOIN near ON near.a = nodes.ord)"


@query(f"WITH RECURSIVE {_SQL_FRAMES}, {_SQL_NEAR}, {_SQL_REACH}, {_SQL_FOUND}, {_SQL_WINNERS} SELECT * FROM won")
def near_dup_default(spark, sf_dir):
    frames = _frames(spark, sf_dir)
    return near_duplicates.winners(near_duplicates.clusters(frames.select("ord", "sig"), 8.0, perceptual.FRAMES).join(frames.select("ord", "quality"), "ord"))


@query(f"WITH RECURSIVE {_SQL_FRAMES}, {_SQL_NEAR}, {_SQL_REACH}, {_SQL_FOUND}, {_SQL_WINNERS} SELECT * FROM won")
def winners_over_batches(spark, sf_dir):
    """The winners of near_dup_default, of documents that come in three batches to an index of what has been seen."""
    where = f"{folder(spark)}/seen-{uuid.uuid4().hex}"
    rows = checkpoint(_frames(spark, sf_dir).withColumn("clip_id", F.col("ord").cast("string")))
    index = seen.SeenClips(spark, where, expected_rows=1e5)
    try:
        for i in range(3):
            index.add(rows.filter(F.pmod(F.xxhash64("ord"), F.lit(3)) == i), f"batch-{i}")
        return _kept_until_read(spark, where, index.winners())
    finally:
        index.close()


_SQL_PHASH = """
WITH grey AS (
  SELECT vec_id, i, (trunc(x * 100 + i * i // 37)::INT % 256 + 256) % 256 AS g
  FROM (SELECT vec_id, unnest(range(1024)) AS i, embedding[unnest(range(1024)) % 64 + 1]::DOUBLE AS x FROM embeddings)
), basis AS (
  SELECT u, k, CASE u WHEN 0 THEN sqrt(1.0::DOUBLE / 32) ELSE sqrt(2.0::DOUBLE / 32) * cos(pi() * u * (2 * k + 1) / 64) END AS c FROM range(8) a(u), range(32) b(k)
), across AS (
  SELECT vec_id, i // 32 AS y, u AS v, sum(g * c) AS s FROM grey JOIN basis ON i % 32 = k GROUP BY ALL
), low AS (
  SELECT vec_id, u, v, sum(s * c) AS s FROM across JOIN basis ON y = k GROUP BY ALL
), middle AS (
  SELECT vec_id, median(s) AS m FROM low WHERE u + v > 0 GROUP BY vec_id
)
SELECT vec_id, lower(lpad(to_hex(sum(CASE WHEN s > m THEN (1::HUGEINT << (63 - 8 * u - v)::INT) ELSE 0 END)::UBIGINT), 16, '0')) AS phash, lower(lpad(to_hex(sum(CASE WHEN s > m THEN (1::HUGEINT << (63 - 8 * u - v)::INT) ELSE 0 END)::UBIGINT), 16, '0')) AS last_of_five, 5::INT AS n_hashes, 5::INT AS n_of_none FROM low JOIN middle USING (vec_id) GROUP BY vec_id
"""


@query(_SQL_PHASH)
def phash_frames(spark, sf_dir):
    """Frames made of sixteen copies of an embedding's 64 values on a pattern without a period, so that no frequency is absent."""
    grey = F.transform(F.flatten(F.array_repeat("embedding", 16)), lambda x, i: F.pmod((x * 100 + F.floor(i * i / 37)).cast("int"), F.lit(256)))
    frame = F.unhex(F.array_join(F.transform(grey, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    no_frame = F.expr("cast(array() as array<binary>)")
    signed = _table(spark, sf_dir, "embeddings").select("vec_id", perceptual.signatures(F.array(frame)).alias("sig"), perceptual.signatures(no_frame).alias("none"))
    zeros = F.size(F.filter("none", lambda x: x == 0))
    return signed.select("vec_id", perceptual.hex_of(F.col("sig")[0]).alias("phash"), perceptual.hex_of(F.element_at("sig", -1)).alias("last_of_five"), F.size("sig").alias("n_hashes"), zeros.alias("n_of_none"))


# Reports and manifests


@query("SELECT 'role' AS what, coalesce(nullif(role, ''), 'unknown') AS value, count(*) AS n FROM conversations GROUP BY 2 UNION ALL SELECT 'event', event_type, count(*) FROM events GROUP BY 2")
def distribution_maps(spark, sf_dir):
    role = manifest.distribution(_table(spark, sf_dir, "conversations"), F.col("role"), "unknown").withColumn("what", F.lit("role"))
    return role.unionByName(manifest.distribution(_table(spark, sf_dir, "events"), F.col("event_type")).withColumn("what", F.lit("event")))


@query("SELECT *, CASE WHEN fetched = 0 THEN 0 ELSE training_ready / fetched::DOUBLE END AS usable_yield, 100.0::DOUBLE / training_ready AS cost FROM (SELECT count(*) AS fetched, count(*) FILTER (event_type <> 'error') AS schema_valid, count(*) FILTER (event_type <> 'error' AND value > 3) AS probe_valid, count(*) FILTER (event_type <> 'error' AND value > 30) AS training_ready FROM events)")
def yield_funnel(spark, sf_dir):
    valid = F.col("event_type") != "error"
    counted = report.funnel(_table(spark, sf_dir, "events"), {"fetched": F.lit(True), "schema_valid": valid, "probe_valid": valid & (F.col("value") > 3), "training_ready": valid & (F.col("value") > 30)})
    return counted.withColumn("cost", F.coalesce(F.try_divide(F.lit(100.0), F.col("training_ready")), F.lit(float("inf"))))


@query(f"SELECT {_SQL_ID} AS clip_id, '' AS video_uri, scenario_type AS scenario, array_to_string(actions, ',') AS actions, start_ms, end_ms, fps, camera_pov FROM ({_sql_checked(False)}) WHERE len(reasons) = 0")
def dataset_view(spark, sf_dir):
    """Valid clips as lines of a manifest, read back as samples."""
    lines = manifest.lines(_checked(spark, sf_dir, False).filter("ok").select("ord", "record"))
    schema = "video_uri string, clip_id string, scenario_type string, actions array<string>, start_ms long, end_ms long, fps double, camera_pov string"
    read = lines.select(F.from_json("raw", schema).alias("record"))
    return manifest.samples(read, lambda df: df.withColumn("actions", F.array_join("actions", ",")))


_SQL_REASON = "CASE WHEN event_type = 'error' THEN 'type_error' WHEN value <= 3 THEN 'too_short' WHEN value > 300 THEN 'too_long' END"


@query(f"SELECT 'fetched' AS what, count(*) AS n FROM events UNION ALL SELECT 'valid', count(*) FROM events WHERE ({_SQL_REASON}) IS NULL UNION ALL SELECT 'ready', count(*) FROM events WHERE ({_SQL_REASON}) IS NULL AND value > 30 UNION ALL SELECT {_SQL_REASON}, count(*) FROM events WHERE ({_SQL_REASON}) IS NOT NULL GROUP BY 1 UNION ALL SELECT 'written', count(*) FROM events WHERE ({_SQL_REASON}) IS NULL AND value > 30")
def observed_funnel(spark, sf_dir):
    """A funnel's counts and reasons out of the one write of the rows that pass it."""
    seen = report.Observed()
    value = F.col("value")
    reason = F.when(F.col("event_type") == "error", "type_error:event").when(value <= 3, F.concat(F.lit("too_short:"), value.cast("string"))).when(value > 300, "too_long")
    judged = seen.watch(_table(spark, sf_dir, "events").withColumn("reason", reason), {"fetched": F.lit(True), "valid": F.col("reason").isNull()}, reasons="reason", kinds=validation.RECORD_REASONS)
    ready = seen.watch(judged.filter("reason is null"), {"ready": value > 30}).filter("value > 30")
    written = checkpoint(ready).count()
    return spark.createDataFrame([*(seen.counts() | seen.reasons()).items(), ("written", written)], "what string, n long")  # a row for each counter


@query("""SELECT page_id, CASE WHEN page_id % 7 <> 0 AND page_id % 5 <> 0 AND strlen(html) > 0 THEN strlen(html) END::BIGINT AS file_size,
       page_id % 7 <> 0 AND page_id % 5 <> 0 AND strlen(html) > 0 AS present FROM pages""")
def files_present(spark, sf_dir):
    """Files of pages, some absent and some empty, found in a listing."""
    where = f"{folder(spark)}/pages-{uuid.uuid4().hex}"
    pages = _table(spark, sf_dir, "pages")

    def put(batches):
        import pyarrow as pa

        store, root = shards.opened(where)
        store.create_dir(root)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_output_stream(f"{root}/{name}.html") as f:
                    f.write(text.encode())
            yield pa.record_batch([batch.column(0)], ["page_id"])

    kept = pages.filter("page_id % 7 <> 0").select("page_id", F.when(F.col("page_id") % 5 == 0, "").otherwise(F.coalesce("html", F.lit(""))).alias("html"))
    kept.mapInArrow(put, "page_id long").count()
    named = pages.select("page_id", F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(where + "//./"), "page_id", F.lit(".html"))).otherwise(F.concat("page_id", F.lit(".html"))).alias("uri"))
    return _kept_until_read(spark, where, files.with_presence(named, files.listing(spark, where), uri="uri", folder=where).select("page_id", "file_size", "present"))


@query("SELECT event_id, event_type AS scenario_type, trunc(value * 1000)::BIGINT AS duration_ms, 'u' || (user_id % 8) AS env_context FROM events WHERE event_type = 'click' AND trunc(value * 1000) >= 30000 AND trunc(value * 1000) < 300000 AND user_id % 8 IN (1, 2, 5)")
def pushed_snapshot(spark, sf_dir):
    """Events as a snapshot's records in pages, of which a query's filters reach the service's request."""
    where = f"{folder(spark)}/snapshot-{uuid.uuid4().hex}"
    record = F.struct("event_id", F.col("event_type").alias("scenario_type"), F.concat(F.lit("u"), F.col("user_id") % 8).alias("env_context"), F.lit(0).alias("start_ms"), (F.col("value") * 1000).cast("long").alias("end_ms"))
    _table(spark, sf_dir, "events").repartition(4, "event_id").select(F.to_json(record).alias("value")).write.text(where)
    found = snapshot.collect(spark, "events", [{}], client=snapshot.FolderClient(where), page_size=1000)
    wanted = found.filter((F.col("scenario_type") == "click") & (F.col("duration_ms") >= 30_000) & (F.col("duration_ms") < 300_000) & F.col("env_context").isin("u1", "u2", "u5"))
    return _kept_until_read(spark, where, wanted.select(F.get_json_object("raw", "$.event_id").cast("long").alias("event_id"), "scenario_type", "duration_ms", "env_context"))


_SQL_FLOW = "SELECT count(*) AS fetched, count(*) FILTER (event_type <> 'error') AS schema_valid, count(*) FILTER (event_type <> 'error' AND value > 3) AS probe_valid, count(*) FILTER (event_type <> 'error' AND value > 30) AS training_ready FROM events"


@query(f"SELECT stage, n, coalesce(n / nullif(fetched, 0)::DOUBLE, 0) AS share FROM ({_SQL_FLOW}), (VALUES ('fetched'), ('schema_valid'), ('file_present'), ('probe_valid'), ('unique'), ('training_ready')) AS v(stage), LATERAL (SELECT CASE stage WHEN 'fetched' THEN fetched WHEN 'schema_valid' THEN schema_valid WHEN 'probe_valid' THEN probe_valid WHEN 'training_ready' THEN training_ready ELSE 0 END::BIGINT AS n)")
def stage_shares(spark, sf_dir):
    return report.shares(yield_funnel(spark, sf_dir)).drop("place")


@query(f"SELECT (row_number() OVER (ORDER BY n DESC, reason))::INT AS rank, reason, n FROM ({ORACLES['merged_reasons']})")
def ranked_reasons(spark, sf_dir):
    return report.ranked(report.merged(reject_histogram(spark, sf_dir), label_reject_histogram(spark, sf_dir)))


def _measured(spark, sf_dir) -> DataFrame:
    """Valid clips, each with what a probe of its file might have said."""
    user = F.col("record.fps")
    probe = F.struct((F.col("record.end_ms") - F.col("record.start_ms") + 40).alias("duration_ms"), F.lit(1280).alias("width"), F.lit(720).alias("height"), F.lit("h264").alias("codec"), F.when(user % 3 == 0, F.lit(0.0)).otherwise(user - 1).alias("fps"))
    return _checked(spark, sf_dir, False).filter("ok").select("ord", validation.enriched(F.col("record"), probe).alias("record"))


_SQL_MEASURED = f"SELECT ord, {_SQL_ID} AS clip_id, end_ms - start_ms + 40 AS duration_ms, 1280 AS width, 720 AS height, 'h264' AS codec, CASE WHEN fps % 3 = 0 THEN fps ELSE fps - 1 END AS fps, scenario_type, camera_pov FROM ({_sql_checked(False)}) WHERE len(reasons) = 0"


@query(f"SELECT ord, clip_id, duration_ms, width, height, codec, fps FROM ({_SQL_MEASURED})")
def enrich(spark, sf_dir):
    return _measured(spark, sf_dir).select("ord", *[f"record.{c}" for c in ("clip_id", "duration_ms", "width", "height", "codec", "fps")])


def _kept_until_read(spark, path: str, found: DataFrame) -> DataFrame:
    """found, written out, so that the folder that it reads can go."""
    try:
        return checkpoint(found)
    finally:
        discard(spark, path)


def _array_files(rows: DataFrame, path: str, order: tuple[str, ...]) -> None:
    """Writes rows (raw, and the columns of order) as JSON arrays, a file for each range of order."""

    def arrays(batches):
        import pyarrow as pa

        head = "["
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([pa.array([head + "\n, ".join(batch.column(0).to_pylist())])], ["value"])
                head = ","
        yield pa.record_batch([pa.array(["[]" if head == "[" else "]"])], ["value"])

    rows.repartitionByRange(4, *order).sortWithinPartitions(*order).select("raw").mapInArrow(arrays, "value string").write.text(path)


@query('SELECT row_number() OVER (ORDER BY conv_id, turn, role, "text") - 1 AS ord, conv_id, turn, role, "text" FROM conversations')
def json_array_scan(spark, sf_dir):
    """All turns as elements of JSON arrays in files, read in ranges of bytes; texts hold commas, quotes and brackets."""
    columns = ("conv_id", "turn", "role", "text")
    path = f"{folder(spark)}/arrays-{uuid.uuid4().hex}"
    _array_files(_table(spark, sf_dir, "conversations").select(F.to_json(F.struct(*columns)).alias("raw"), *columns), path, columns)
    read = records.read_records(spark, path).select("ord", F.from_json("raw", "conv_id long, turn long, role string, text string").alias("r"))
    return _kept_until_read(spark, path, read.select("ord", "r.*"))


@query("SELECT row_number() OVER (ORDER BY page_id) - 1 AS ord, page_id, url FROM pages")
def numbered_line_scan(spark, sf_dir):
    """All pages as lines of files, numbered over the ranges of bytes that are read apart."""
    path = f"{folder(spark)}/lines-{uuid.uuid4().hex}"
    rows = _table(spark, sf_dir, "pages").select("page_id", F.to_json(F.struct("page_id", "url")).alias("value"))
    rows.repartitionByRange(4, "page_id").sortWithinPartitions("page_id").select("value").write.text(path)
    read = records.numbered_lines(spark, path).select("ord", F.from_json("raw", "page_id long, url string").alias("r"))
    return _kept_until_read(spark, path, read.select("ord", "r.*"))


_LINES = "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string"
_LINE_COLUMNS = ", ".join(x.split()[0] for x in _LINES.split(", "))


def _line_manifest(spark, sf_dir) -> tuple[str, dict]:
    """Line items as a manifest in shards, in a new folder, and its header."""
    rows = _table(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS.split(", "), F.to_json(F.struct(*_LINE_COLUMNS.split(", "))).alias("raw"), F.col("l_linenumber").cast("long").alias("_n"))
    path = f"{folder(spark)}/lines-{uuid.uuid4().hex}"
    return path, shards.write_shards(rows, path, count_by=("l_returnflag", "l_linestatus"), sum_of="_n", order=tuple(_LINE_COLUMNS.split(", ")))


_SQL_LINES = f"SELECT row_number() OVER (ORDER BY {_LINE_COLUMNS}) - 1 AS ord, {_LINE_COLUMNS} FROM lineitem"


@query(_SQL_LINES)
def manifest_shards(spark, sf_dir):
    """All line items, written in shards by the tasks and read back in order."""
    path, _ = _line_manifest(spark, sf_dir)
    return _kept_until_read(spark, path, shards.read_shards(spark, path).select("ord", F.from_json("raw", _LINES).alias("r")).select("ord", "r.*"))


@query(_SQL_LINES)
def manifest_random_access(spark, sf_dir):
    """All line items by their number, each by a seek in the index."""
    path, head = _line_manifest(spark, sf_dir)
    found = shards.lines_at(spark.range(head["rows"]).withColumnRenamed("id", "ord").repartition("ord"), path)
    return _kept_until_read(spark, path, found.select("ord", F.from_json("raw", _LINES).alias("r")).select("ord", "r.*"))


@query("SELECT 'rows' AS what, '' AS value, count(*) AS n FROM lineitem UNION ALL SELECT 'sum', '', sum(l_linenumber)::BIGINT FROM lineitem UNION ALL SELECT 'l_returnflag', l_returnflag, count(*) FROM lineitem GROUP BY 2 UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2")
def manifest_commit_header(spark, sf_dir):
    """The header that comes out of the tasks' commit messages; it has an entry for each distinct value."""
    path, head = _line_manifest(spark, sf_dir)
    discard(spark, path)
    rows = [("rows", "", head["rows"]), ("sum", "", head["sum"]), *[(k, value, n) for k, v in head["counts"].items() for value, n in v.items()]]
    return spark.createDataFrame(rows, "what string, value string, n long")


@query(f"""
WITH m AS ({_SQL_MEASURED})
SELECT 'n_samples' AS what, '' AS value, count(*)::DOUBLE AS n FROM m UNION ALL SELECT 'total_duration_s', '', coalesce(round(sum(duration_ms) / 1000.0::DOUBLE, 1), 0) FROM m
UNION ALL SELECT 'scenario_distribution', scenario_type, count(*) FROM m GROUP BY 2 UNION ALL SELECT 'pov_distribution', camera_pov, count(*) FROM m GROUP BY 2
UNION ALL SELECT 'geo_distribution', 'unknown', count(*) FROM m HAVING count(*) > 0 UNION ALL SELECT 'label_source_distribution', 'vendor_provided', count(*) FROM m HAVING count(*) > 0""")
def manifest_header(spark, sf_dir):
    return manifest.header_rows(_measured(spark, sf_dir))


@query("SELECT * FROM (VALUES " + ", ".join(
    f"({_quoted(spec.scenario_type)}, {_quoted(k)}, {_quoted(v)})" for spec, told in (
        (WAREHOUSE, {"scenario_type": "warehouse_pick_and_place", "env_context": "industrial_warehouse", "camera_pov": "third_person,wrist_mounted", "action_type": "reach,grasp,lift,place", "lighting": "normal,low_light", "min_duration_ms": "3000", "max_duration_ms": "45000", "min_resolution_height": "480", "limit": "500"}),
        (KITCHEN, {"scenario_type": "kitchen_manipulation_wipe", "env_context": "residential_kitchen", "camera_pov": "third_person,overhead", "action_type": "reach,grasp,wipe,place", "lighting": "normal,low_light", "min_duration_ms": "3000", "max_duration_ms": "60000", "min_resolution_height": "480", "limit": "300"}),
    ) for k, v in told.items()) + ") AS v(scenario, field, value)")
def filter_payload(spark, sf_dir):
    rows = [(spec.scenario_type, k, ",".join(v) if isinstance(v, list) else str(v)) for spec in (WAREHOUSE, KITCHEN) for k, v in spec.to_filter_params().items()]
    return spark.createDataFrame(rows, "scenario string, field string, value string")


@query("SELECT * FROM (VALUES ('fetched', 118::BIGINT), ('schema_valid', 101), ('file_present', 99), ('probe_valid', 90), ('unique', 74), ('training_ready', 74)) AS v(stage, n)")
def fixture_funnel(spark, sf_dir):
    """The stages' counts over fixtures of known defects: records, files, measures and hashes, joined by video."""
    made = checkpoint(fixtures.fixtures(spark, 120))
    good = validation.checked(made.select("ord", "raw"), WAREHOUSE).filter("ok").select("ord", "record")
    met = good.join(made.select("video_uri", "present", "probe", "sig"), good["record.video_uri"] == made["video_uri"]).filter("present")
    problems = validation.probe_problems(F.col("record.end_ms") - F.col("record.start_ms"), F.col("record.fps"), F.col("probe"), WAREHOUSE)
    valid = checkpoint(met.filter(F.size(problems) == 0))
    won = near_duplicates.winners(near_duplicates.clusters(valid.select("ord", "sig"), 8.0, perceptual.FRAMES).join(valid.select("ord", F.col("probe.height").alias("quality")), "ord"))
    counted = [("fetched", made), ("schema_valid", good), ("file_present", met), ("probe_valid", valid), ("unique", won.filter("keep")), ("training_ready", won.filter("keep"))]
    return reduce(DataFrame.unionByName, [df.agg(F.lit(stage).alias("stage"), F.count("*").alias("n")) for stage, df in counted])


@query("SELECT * FROM (VALUES " + ", ".join(f"({i}::INT, '{a}', '{b}', '{c}')" for i, (a, b, c) in enumerate(V.OFFLINE_DATASETS)) + ") AS v(ord, id, name, type)")
def offline_catalogue(spark, sf_dir):
    return records.offline_datasets(spark)


@query("SELECT * FROM (VALUES ('warehouse robot reach grasp'), ('warehouse reach place demonstration'), ('kitchen robot reach grasp'), ('kitchen reach place demonstration')) AS v(query)")
def search_queries(spark, sf_dir):
    return spark.createDataFrame([(q,) for spec in (WAREHOUSE, KITCHEN) for q in spec.to_search_queries()], "query string")
