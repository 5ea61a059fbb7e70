"""Queries of readers: files are made of the test tables inside the query and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance import model
from parlance.operators import cards
from parlance.plans import sql
from parlance.plans.style import messages
from parlance.runtime import table
from parlance.sources import exports, sinks

#: places in a chat that go into one transcript
PER_FILE = 1000


def _file(rows: DataFrame, keys: list[str], order: str, part: Column, between: str) -> DataFrame:
    """(keys.., text): the parts of a file in order. Files here are episodes, or blocks of a chat."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(order, part.alias("part")))).alias("p")).select(*keys, F.array_join(F.col("p.part"), between).alias("text"))


def srt_read(spark: SparkSession, d: str) -> DataFrame:
    cues = table(spark, d, "subtitle_cues").where("file_name like '%.srt'")
    time = F.coalesce("raw_time", F.lit(""))
    block = F.concat_ws("\n", F.col("cue_no").cast("string"), F.concat(time, F.lit(" --> "), time), F.coalesce("body", F.lit("")))
    return exports.srt_cues(_file(cues.withColumnRenamed("file_name", "src"), ["src"], "cue_no", block, "\r\n\r\n"))


def ass_read(spark: SparkSession, d: str) -> DataFrame:
    cues = table(spark, d, "subtitle_cues").where("file_name like '%.ass'")
    line = F.concat(F.lit("Dialogue: 0,"), F.coalesce("raw_time", F.lit("")), F.lit(",0:00:00.00,Default,,0,0,0,,"), F.coalesce("body", F.lit("")))
    return exports.ass_cues(_file(cues.withColumnRenamed("file_name", "src"), ["src"], "cue_no", line, "\n"))


def transcript_read(spark: SparkSession, d: str) -> DataFrame:
    """The messages with time and sender, written as transcripts of blocks of a chat and read back."""
    m = messages(spark, d, "src", "seq", "ts_raw", "sender", "content").where("ts_raw != '' and sender != ''").where(~F.col("content").startswith(model.SEPARATOR))
    flat = [F.translate(c, "\n", " ").alias(c) for c in ("ts_raw", "sender", "content")]
    rows = sinks.transcript(m.dropna(subset=["src", "seq"]).select("src", "seq", *flat)).withColumn("b", F.floor(F.col("seq") / PER_FILE))
    files = _file(rows, ["src", "b"], "seq", F.col("value"), "\n")
    return exports.transcripts(files.select(F.concat_ws("#", "src", F.col("b").cast("string")).alias("src"), "text"))


def card_files(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, value): the cards among the documents as files of all versions, with a lorebook and more greetings."""
    docs = table(spark, d, "documents").where("kind = 'card' and text is not null")
    lines = lambda f: F.regexp_extract_all("text", F.lit(rf"(?:^|\n){f}: ([^\n]*)"), F.lit(1))
    first = lambda f: F.coalesce(F.get(lines(f), 0), F.lit("")).alias(f)
    entries = F.transform(lines("scenario"), lambda x: F.struct(F.array(F.substring(x, 1, 4)).alias("keys"), x.alias("content")))
    greetings = lines("first_mes")
    body = F.struct(
        *[first(f) for f in ("name", "description", "personality", "scenario", "first_mes")], F.col("text").alias("mes_example"),
        F.slice(greetings, F.lit(2), F.size(greetings)).alias("alternate_greetings"), F.struct(entries.alias("entries")).alias("character_book"),
    )
    version = F.pmod("doc_id", F.lit(4))
    spec = F.element_at(F.array(*[F.lit(s) for s in SPECS]), (version + 1).cast("int"))
    return docs.select("doc_id", F.when(version == 2, F.to_json(body)).otherwise(F.to_json(F.struct(spec.alias("spec"), F.lit("2.0").alias("spec_version"), body.alias("data")))).alias("value"))


SPECS = ("chara_card_v2", "chara_card_v3", "", "chara_card_v9")


def _cards(spark: SparkSession, d: str) -> DataFrame:
    return exports.cards_of(card_files(spark, d), "doc_id")


def card_read(spark, d):
    b = cards.body(F.col("card"))
    return _cards(spark, d).select("doc_id", cards.kind(F.col("card")).alias("kind"), b["name"].alias("name"), F.size(b["character_book"]["entries"]).alias("n_entries"), F.size(b["alternate_greetings"]).alias("n_greetings"))


def card_lorebook(spark, d):
    return cards.lorebook(_cards(spark, d), "doc_id").select("doc_id", "idx", F.array_join("keys", "|").alias("keys"), "n_chars")


def card_greetings(spark, d):
    return cards.greeting_lines(_cards(spark, d), "doc_id")


def card_replies_second(spark, d):
    """Lines of the example replies as they are cut up to the next reply."""
    from parlance.functions.text import nonblank_lines

    rows = _cards(spark, d).select("doc_id", F.posexplode(cards.replies(cards.body(F.col("card"))["mes_example"], True)).alias("i", "r"))
    return rows.select("doc_id", (F.col("i") + 1).cast("bigint").alias("idx"), nonblank_lines(F.col("r")).alias("n_lines"))


def queries():
    return {q.__name__: q for q in (srt_read, ass_read, transcript_read, card_read, card_lorebook, card_greetings, card_replies_second)}


_FILES = f"""
WITH c AS (SELECT file_name AS src, row_number() OVER (PARTITION BY file_name ORDER BY cue_no) - 1 AS seq, {sql.strip("coalesce(raw_time, '')")} AS raw_time, coalesce(body, '') AS b FROM subtitle_cues)
"""
_TAGLESS = sql.strip(r"regexp_replace(regexp_replace(b, '\{[^}]*\}', '', 'g'), '\\[Nn]', ' ', 'g')")
_LINES = r"regexp_extract_all(text, '(?:^|\n){0}: ([^\n]*)', 1)"
_CARDS = f"""
WITH k AS (SELECT doc_id, text, {_LINES.format('name')} AS names, {_LINES.format('scenario')} AS lore, {_LINES.format('first_mes')} AS greets FROM documents WHERE kind = 'card' AND text IS NOT NULL)
"""


def oracle_sql():
    return {
        "srt_read": _FILES + f"SELECT src, seq, raw_time, {sql.strip('b')} AS body FROM c WHERE src LIKE '%.srt' AND {sql.strip('b')} <> ''",
        "ass_read": _FILES + f"SELECT src, seq, raw_time, {_TAGLESS} AS body FROM c WHERE src LIKE '%.ass' AND {_TAGLESS} <> ''",
        "transcript_read": sql.MESSAGES + f""", t AS (SELECT src || '#' || CAST(seq // {PER_FILE} AS VARCHAR) AS src, seq, translate(ts_raw, chr(10), ' ') AS ts_raw, translate(sender, chr(10), ' ') AS sender,
            translate(content, chr(10), ' ') AS content FROM m WHERE ts_raw <> '' AND sender <> '' AND NOT starts_with(content, '{model.SEPARATOR}') AND src IS NOT NULL AND seq IS NOT NULL)
            SELECT src, row_number() OVER (PARTITION BY src ORDER BY seq) - 1 AS seq, ts_raw, sender, content FROM t""",
        "card_read": _CARDS + """SELECT doc_id, ['v2', 'v3', 'v1', 'unknown'][doc_id % 4 + 1] AS kind, coalesce(names[1], '') AS name, CAST(len(lore) AS INTEGER) AS n_entries,
            CAST(greatest(len(greets) - 1, 0) AS INTEGER) AS n_greetings FROM k""",
        "card_lorebook": _CARDS + "SELECT doc_id, i AS idx, substr(lore[i], 1, 4) AS keys, length(lore[i]) AS n_chars FROM k, unnest(range(1, len(lore) + 1)) AS x(i)",
        "card_greetings": _CARDS + f", g AS (SELECT doc_id, CASE WHEN len(greets) = 0 THEN [''] ELSE greets END AS gs FROM k) SELECT doc_id, i - 1 AS idx, {sql.lines('gs[i]')} AS n_lines FROM g, unnest(range(1, len(gs) + 1)) AS x(i)",
        "card_replies_second": _CARDS + f""", g AS (SELECT doc_id, list_filter(string_split(text, '{{{{user}}}}'), lambda x: contains(x, '{{{{char}}}}')) AS gs FROM k)
            SELECT doc_id, i AS idx, {sql.lines("string_split(gs[i], '{{char}}')[2]")} AS n_lines FROM g, unnest(range(1, len(gs) + 1)) AS x(i)""",
    }
