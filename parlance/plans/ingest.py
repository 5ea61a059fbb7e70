"""Queries of ingestion: export records, subtitles, cards, the synthetic source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance import model
from parlance.operators import cards, sampling, subtitles
from parlance.plans import sql
from parlance.runtime import table
from parlance.sources import demo, exports, sinks

DEMO_ROWS = 3000


def _records(spark: SparkSession, d: str) -> DataFrame:
    """(rec_id, src, m): each export record as a JSON object, as it would lie in a file."""
    r = table(spark, d, "raw_records").select("rec_id", "src", "time", "timestamp", "createTime", "sender", "content", "type").distinct()
    return r.select("rec_id", "src", F.try_parse_json(F.to_json(F.struct("time", "timestamp", "createTime", "sender", "content", "type"))).alias("m"))


def json_normalize(spark, d):
    return _records(spark, d).select("rec_id", exports.fields_of(F.col("m")).alias("x")).select("rec_id", "x.*")


def json_export(spark, d):
    """The same records, each as the only message of a whole export document with other keys beside it."""
    r = table(spark, d, "raw_records").select("rec_id", "time", "timestamp", "createTime", "sender", "content", "type").distinct()
    one = F.to_json(F.struct("time", "timestamp", "createTime", "sender", "content", "type"))
    docs = r.select(F.col("rec_id").alias("src"), F.concat(F.lit('{"version": 1, "tags": [1, 2, 3], "records": ['), one, F.lit("]}")).alias("doc"))
    return exports.exported(docs).select(F.col("src").alias("rec_id"), "seq", "ts_raw", "sender", "content", "mtype")


def rich_text_flatten(spark, d):
    """Contents cut into segments of rich text, as a text and an object, and flattened again."""
    r = table(spark, d, "raw_records").select("rec_id", F.coalesce("content", F.lit("")).alias("c")).distinct()
    quoted = lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", "")
    doc = F.concat(F.lit("["), quoted(F.substring("c", 1, 3)), F.lit(', {"type": "bold", "text": '), quoted(F.substring(F.col("c"), F.lit(4), F.length("c"))), F.lit("}]"))
    return r.select("rec_id", exports.flat_text(F.try_parse_json(doc)).alias("content"))


def json_kept(spark, d):
    return exports.kept(json_normalize(spark, d)).select("rec_id", "content")


def json_placeholders(spark, d):
    return exports.kept(json_normalize(spark, d), True).select("rec_id", "content")


def json_counters(spark, d):
    return exports.counters(json_normalize(spark, d))


def list_senders(spark, d):
    return json_normalize(spark, d).groupBy(F.coalesce(F.nullif("sender", F.lit("")), F.lit("(空)")).alias("sender")).agg(F.count("*").alias("n"))


def subtitle_messages(spark, d):
    cues = table(spark, d, "subtitle_cues")
    body = F.when(F.col("file_name").endswith(".ass"), subtitles.without_tags(F.col("body"))).otherwise(F.col("body"))
    return subtitles.cue_messages(cues.withColumn("body", body), keep=("cue_id",))


def subtitle_speakers(spark, d):
    return subtitle_messages(spark, d).groupBy("sender").agg(F.count("*").alias("n"))


def document_cards(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, card): the documents that are cards, their headed lines as fields, the dialogue as examples."""
    docs = table(spark, d, "documents").where("kind = 'card' and text is not null")
    line = lambda f: F.regexp_extract("text", rf"(?:^|\n){f}: ([^\n]*)", 1).alias(f)
    body = F.struct(*[line(f) for f in ("name", "description", "personality", "scenario", "first_mes", "creator_notes")], F.col("text").alias("mes_example"))
    spec = F.when(F.col("lang").isNull(), "chara_card_v9").otherwise("chara_card_v2")
    return docs.select("doc_id", F.from_json(F.to_json(F.struct(spec.alias("spec"), F.lit("2.0").alias("spec_version"), body.alias("data"))), model.CARD).alias("card"))


def card_fields(spark, d):
    return cards.field_lengths(document_cards(spark, d), "doc_id")


def card_example_lines(spark, d):
    return cards.example_lines(document_cards(spark, d), "doc_id")


def card_greeting_lines(spark, d):
    return cards.greeting_lines(document_cards(spark, d), "doc_id")


def card_warnings(spark, d):
    return cards.warnings(document_cards(spark, d), "doc_id")


def card_to_v3(spark, d):
    c = document_cards(spark, d).select("doc_id", cards.kind(F.col("card")).alias("kind"), cards.to_v3(F.col("card")).alias("v3"))
    return c.select("doc_id", "kind", "v3.spec", "v3.spec_version", F.col("v3.data.name").alias("name"))


def card_pictures(spark, d):
    """Size of each card's picture, and the place of its first text part."""
    made = sinks.pictured(document_cards(spark, d).withColumn("picture", F.lit(None).cast("binary")))
    return made.select("doc_id", F.length("png").alias("n_bytes"), F.crc32("png").alias("crc"))


def demo_messages(spark, d):
    return demo.demo_messages(spark, DEMO_ROWS)


def transcript_rows(spark, d):
    """The messages in transcript framing, one value a message."""
    from parlance.plans.style import messages

    return sinks.transcript(messages(spark, d, "src", "seq", "ts_raw", "sender", "content"))


def queries():
    return {
        q.__name__: q
        for q in (
            json_normalize, json_export, rich_text_flatten, json_kept, json_placeholders, json_counters, list_senders, subtitle_messages, subtitle_speakers, card_fields, card_example_lines,
            card_greeting_lines, card_warnings, card_to_v3, card_pictures, demo_messages, transcript_rows,
        )
    }


_NORM = """
WITH r0 AS (SELECT DISTINCT rec_id, time, timestamp, "createTime", sender, content, type FROM raw_records),
r1 AS (SELECT rec_id, coalesce(nullif(time, ''), nullif(timestamp, ''), nullif("createTime", ''), '') AS t, coalesce(sender, '') AS sender, coalesce(content, '') AS content,
  coalesce(nullif(type, ''), '1') AS mtype FROM r0),
r AS (SELECT rec_id, CASE WHEN substr(t, 11, 1) = 'T' THEN substr(t, 1, 10) || ' ' || substr(t, 12) ELSE t END AS ts_raw, sender, content, mtype FROM r1),
k AS (SELECT *, ts_raw <> '' AND content <> '' AS full_, mtype IN ('1', 'text', 'Text', 'message', 'Message') OR starts_with(content, '[') AS is_text FROM r)
"""
_SPK = f"^{sql.WS}*([^：:（(]{{1,16}}){sql.WS}*[：:]{sql.WS}*([^\\n]+)$"
_CUES = f"""
WITH b AS (SELECT cue_id, {sql.strip("coalesce(raw_time, '')")} AS t, coalesce(CASE WHEN ends_with(file_name, '.ass')
  THEN {sql.strip(r"regexp_replace(regexp_replace(body, '\{[^}]*\}', '', 'g'), '\\[Nn]', ' ', 'g')")} ELSE body END, '') AS body FROM subtitle_cues),
p AS (SELECT cue_id, regexp_extract(t, '^(\\d+):(\\d{{2}}):(\\d{{2}})', ['h', 'm', 's']) AS x, regexp_matches(t, '^\\d+:\\d{{2}}:\\d{{2}}') AS ok, body, regexp_matches(body, '{_SPK}') AS split FROM b),
q AS (SELECT cue_id, ok, '2024-01-01 ' || CASE WHEN length(h) < 2 THEN '0' || h ELSE h END || ':' || m || ':' || s AS ts_raw,
  CASE WHEN split THEN {sql.strip(f"regexp_extract(body, '{_SPK}', 1)")} ELSE '(未知)' END AS sender, CASE WHEN split THEN {sql.strip(f"regexp_extract(body, '{_SPK}', 2)")} ELSE body END AS content
  FROM (SELECT *, CASE WHEN ok THEN CAST(CAST(x.h AS BIGINT) AS VARCHAR) ELSE '' END AS h, x.m AS m, x.s AS s FROM p)),
cues AS (SELECT cue_id, ts_raw, sender, content FROM q WHERE ok AND content <> '')
"""
_FIELDS = ("name", "description", "personality", "scenario", "first_mes")
_CARDS = (
    "WITH cards AS (SELECT doc_id, text AS mes_example, lang IS NULL AS odd, "
    + ", ".join(rf"regexp_extract(text, '(?:^|\n){f}: ([^\n]*)', 1) AS {f}" for f in _FIELDS)
    + " FROM documents WHERE kind = 'card' AND text IS NOT NULL),\n"
    + "g AS (SELECT doc_id, list_filter(string_split(mes_example, '{{user}}'), lambda x: contains(x, '{{char}}')) AS gs FROM cards),\n"
    + f"ex AS (SELECT doc_id, i AS idx, {sql.lines("substr(gs[i], strpos(gs[i], '{{char}}') + 8)")} AS n_lines FROM g, unnest(range(1, len(gs) + 1)) AS x(i))\n"
)
_D = {s: f"((((((42 * {sampling.A} + i * {sampling.B} + {42 * sampling.C + s}) % {sampling.MODULUS}) * {sampling.A} + {s}) % {sampling.MODULUS}) * {sampling.C} + i) % {sampling.MODULUS})" for s in range(1, 7)}


def _of(words: tuple[str, ...], s: int) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + f"][CAST({_D[s]} % {len(words)} + 1 AS BIGINT)]"


def oracle_sql():
    blank = lambda f: f"SELECT doc_id, 'empty field' AS \"check\", '{f}' AS subject, CAST(0 AS BIGINT) AS n FROM cards WHERE {f} = ''"
    always = lambda c, s: f"SELECT doc_id, '{c}', '{s}', 0 FROM cards"
    return {
        "json_normalize": _NORM + "SELECT rec_id, ts_raw, sender, content, mtype FROM r",
        "json_export": _NORM + "SELECT rec_id, CAST(0 AS BIGINT) AS seq, ts_raw, sender, content, mtype FROM r",
        "rich_text_flatten": "SELECT DISTINCT rec_id, coalesce(content, '') AS content FROM raw_records",
        "json_kept": _NORM + "SELECT rec_id, content FROM k WHERE full_ AND is_text",
        "json_placeholders": _NORM + "SELECT rec_id, CASE WHEN is_text THEN content ELSE '[' || mtype || ']' END AS content FROM k WHERE full_",
        "json_counters": _NORM + "SELECT count(*) AS loaded, count(*) FILTER (full_ AND is_text) AS kept, count(*) FILTER (NOT (full_ AND is_text)) AS skipped FROM k",
        "list_senders": _NORM + "SELECT coalesce(nullif(sender, ''), '(空)') AS sender, count(*) AS n FROM r GROUP BY 1",
        "subtitle_messages": _CUES + "SELECT * FROM cues",
        "subtitle_speakers": _CUES + "SELECT sender, count(*) AS n FROM cues GROUP BY sender",
        "card_fields": _CARDS + " UNION ALL ".join(f"SELECT doc_id, '{f}' AS field, {'CAST(length(' + f + ') AS BIGINT)' if f != 'post_history_instructions' else 'CAST(0 AS BIGINT)'} AS n_chars FROM cards" for f in (*model.CARD_FIELDS, "post_history_instructions")),
        "card_example_lines": _CARDS + "SELECT doc_id, idx, n_lines FROM ex",
        "card_greeting_lines": _CARDS + f"SELECT doc_id, CAST(0 AS BIGINT) AS idx, {sql.lines('first_mes')} AS n_lines FROM cards",
        "card_warnings": _CARDS + " UNION ALL ".join([
            *[blank(f) for f in (*_FIELDS, "mes_example")], "SELECT doc_id, 'unknown spec', 'chara_card_v9', 0 FROM cards WHERE odd", always("empty field", "post_history_instructions"),
            f"SELECT doc_id, 'long example', CAST(idx AS VARCHAR), n_lines FROM ex WHERE n_lines > {model.MOST_EXAMPLE_LINES}",
            f"SELECT doc_id, 'long greeting', 'first_mes', {sql.lines('first_mes')} FROM cards WHERE {sql.lines('first_mes')} > {model.MOST_GREETING_LINES}",
            "SELECT doc_id, 'no reply', 'mes_example', 0 FROM g WHERE len(gs) = 0", always("empty lorebook", "character_book"),
        ]),
        "card_to_v3": _CARDS + "SELECT doc_id, CASE WHEN odd THEN 'unknown' ELSE 'v2' END AS kind, 'chara_card_v3' AS spec, '3.0' AS spec_version, name FROM cards",
        "demo_messages": f"""WITH s AS (SELECT i, sum({_D[1]} % {demo.LONGEST} + 1) OVER (ORDER BY i) AS gap, {_D[2]} % 100 < {demo.FIRST} AS mine, {_D[3]} % 100 AS form,
            {_of(demo.PLANTS, 4)} AS plant, {_of(demo.REPORTS, 4)} AS report FROM range({DEMO_ROWS}) AS x(i))
            SELECT 'demo' AS src, i AS seq, strftime(TIMESTAMP '{demo.START}' + to_minutes(CAST(gap AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS ts_raw,
            CASE WHEN mine THEN '{demo.GROWER}' ELSE '{demo.NEIGHBOUR}' END AS sender,
            CASE WHEN NOT mine THEN replace({_of(demo.ASKS, 4)}, '{{}}', {_of(demo.PLANTS, 5)}) WHEN form < 45 THEN report WHEN form < 62 THEN plant || ' ' || ({_D[5]} % 120 + 1) || ' cm'
              WHEN form < 75 THEN plant || ' ' || {_of(demo.SPOTS, 5)} WHEN form < 85 THEN report || {_of(demo.MARKS, 5)} WHEN form < 93 THEN plant || {_of(demo.SIGNS, 5)}
              ELSE report || ', then ' || {_of(demo.REPORTS, 5)} END AS content FROM s""",
        "transcript_rows": sql.MESSAGES + "SELECT src, seq, ts_raw || chr(10) || sender || chr(10) || content || chr(10) AS value FROM m",
    }
