"""Queries of the style profile, sampling and scan over the chat messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance import model
from parlance.functions.text import count_of, strip
from parlance.operators import privacy, profile, sampling
from parlance.plans import sql
from parlance.runtime import table

#: thresholds of repeated phrases and of n-grams; the profile's defaults are for longer records of one speaker
PHRASE_MIN, GRAM_MIN = 3, 5
TARGET, BASE, SEG_MIN, SEG_MAX, SEED, TRIES = 6500, 120, 20, 45, 42, 5000


def messages(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Columns of the message relation, each message once, senders and times without blanks at the ends: ``src``,
    ``seq``, ``ts_raw``, ``sender``, ``content``; ``ok`` and ``full`` tell valid messages and those with content.

    Only what a query names is read and shuffled.
    """
    content = F.coalesce("content", F.lit(""))
    made = {
        "src": F.col("src"), "seq": F.col("seq"), "ts_raw": strip(F.coalesce("time", F.lit(""))), "sender": strip(F.coalesce("sender", F.lit(""))), "content": content,
        "ok": profile.is_valid(content), "full": content != "",
    }
    return table(spark, d, "chat_messages").select("msg_id", *[made[c].alias(c) for c in columns]).distinct().drop("msg_id")


def speakers(spark: SparkSession, d: str) -> tuple[str, str]:
    return profile.resolve_speakers(messages(spark, d, "src", "seq", "sender"))


#: what sections over the contents of one speaker need
SPOKEN = ("src", "seq", "sender", "content", "ok")


def speaker_counts(spark, d):
    return profile.speaker_counts(messages(spark, d, "src", "seq", "sender")).select("sender", "n")


def summary_pair(spark, d):
    return profile.summary(messages(spark, d, "sender", "ok"), *speakers(spark, d))


def length_histogram(spark, d):
    return profile.length_histogram(messages(spark, d, "sender", "content", "ok"), speakers(spark, d)[0])


def monthly_volume(spark, d):
    return profile.monthly_volume(messages(spark, d, "ts_raw", "ok"))


def active_hours(spark, d):
    return profile.active_hours(messages(spark, d, "src", "seq", "ts_raw", "sender", "ok"), speakers(spark, d)[0]).select("hour", "n")


def peak_hour(spark, d):
    return profile.peak_hour(messages(spark, d, "src", "seq", "ts_raw", "sender", "ok"), speakers(spark, d)[0]).select("hour", "n")


def token_dilution(spark, d):
    return profile.token_rank(messages(spark, d, *SPOKEN), speakers(spark, d)[0], model.BRACKET).select("token", "n", "dilution")


def emoji_rank(spark, d):
    return profile.token_rank(messages(spark, d, *SPOKEN), speakers(spark, d)[0], model.EMOJI).select("token", "n")


def catchphrase_rank(spark, d):
    return profile.catchphrases(messages(spark, d, *SPOKEN), speakers(spark, d)[0], PHRASE_MIN).select("phrase", "n")


def ngrams_top(spark, d):
    return profile.ngrams_top(messages(spark, d, *SPOKEN), speakers(spark, d)[0], least=GRAM_MIN).select("gram", "n")


def sentence_tails(spark, d):
    return profile.sentence_tails(messages(spark, d, *SPOKEN), speakers(spark, d)[0]).select("tail", "n")


def burst_stats(spark, d):
    return profile.burst_stats(profile.bursts(messages(spark, d, "src", "seq", "sender", "ok"), speakers(spark, d)[0]))


def burst_histogram(spark, d):
    return profile.burst_histogram(profile.bursts(messages(spark, d, "src", "seq", "sender", "ok"), speakers(spark, d)[0]))


def name_occurrences(spark, d):
    """Literal occurrences of the speaker's name in senders and contents."""
    name = speakers(spark, d)[0]
    return messages(spark, d, "sender", "content").agg(F.sum(count_of(F.col("sender"), name)).alias("in_sender"), F.sum(count_of(F.col("content"), name)).alias("in_content"))


SAMPLED = ("src", "seq", "ts_raw", "full")


def stratified_sample(spark, d):
    return sampling.stratified_sample(messages(spark, d, *SAMPLED), TARGET, BASE, SEG_MIN, SEG_MAX, SEED, TRIES).select("month", "src", "seq")


def sample_stats(spark, d):
    m = messages(spark, d, *SAMPLED)
    return sampling.sample_stats(m, sampling.stratified_sample(m, TARGET, BASE, SEG_MIN, SEG_MAX, SEED, TRIES))


def sample_total(spark, d):
    """The grand total beside a sample: messages sampled, and those that could be."""
    return sample_stats(spark, d).agg(F.sum("sampled").alias("sampled"), F.sum("total").alias("total"))


def month_quotas(spark, d):
    return sampling.quotas(sampling.month_totals(sampling.eligible(messages(spark, d, "ts_raw", "full"))), TARGET, BASE)


def _chat_lines(spark, d):
    return privacy.lines_of(table(spark, d, "chat_messages").select("msg_id", "content").distinct(), "msg_id", F.col("content"))


def privacy_hits(spark, d):
    return privacy.hits(_chat_lines(spark, d), "msg_id")


def privacy_rule_counts(spark, d):
    return privacy.rule_counts(privacy_hits(spark, d))


def queries():
    return {
        q.__name__: q
        for q in (
            speaker_counts, summary_pair, length_histogram, monthly_volume, active_hours, peak_hour, token_dilution, emoji_rank, catchphrase_rank, ngrams_top,
            sentence_tails, burst_stats, burst_histogram, name_occurrences, stratified_sample, sample_stats, sample_total, month_quotas, privacy_hits, privacy_rule_counts,
        )
    }


_TOP = "ORDER BY n DESC, p"
_HOUR = "coalesce(try_cast(nullif(regexp_extract(ts_raw, '([0-9]{1,2}):[0-9]{2}', 1), '') AS INTEGER), try_cast(substr(ts_raw, 12, 2) AS INTEGER))"
_RE2_EMOJI = model.EMOJI
_W = "w AS (SELECT content, count(*) AS w, min({'a': src, 'b': seq}) AS p FROM c GROUP BY content)"


def _tokens(pattern: str) -> str:
    return (
        sql.MESSAGES
        + f""", {_W},
f AS (SELECT w, p, regexp_extract_all(content, '{pattern}') AS found FROM w),
t AS (SELECT w, p, i, found[i] AS token FROM f, unnest(range(1, len(found) + 1)) AS x(i)),
g AS (SELECT token, CAST(sum(w) AS BIGINT) AS n, min({{'a': p.a, 'b': p.b, 'i': i}}) AS p FROM t GROUP BY token)
"""
    )


_BURSTS = (
    sql.MESSAGES
    + """,
o AS (SELECT src, seq, sender = (SELECT sender FROM ch) AS me FROM v),
k AS (SELECT *, sum(CASE WHEN me THEN 0 ELSE 1 END) OVER (PARTITION BY src ORDER BY seq) AS k FROM o),
r AS (SELECT src, k, count(*) AS run FROM k WHERE me GROUP BY src, k)
"""
)
_M, _A, _B, _C = sampling.MODULUS, sampling.A, sampling.B, sampling.C


def _draw(salt: int) -> str:
    x = f"((no * {_A} + t * {_B} + {SEED * _C + salt}) % {_M})"
    x = f"(({x} * {_A} + {salt}) % {_M})"
    return f"(({x} * {_C} + t) % {_M})"


_QUOTA = (
    sql.MESSAGES
    + f""",
e AS (SELECT src, seq, substr(ts_raw, 1, 7) AS month FROM m WHERE ts_raw <> '' AND content <> ''),
tot AS (SELECT month, count(*) AS n FROM e GROUP BY month),
q AS (SELECT month, n, CAST(floor({BASE} + n / (SELECT sum(n) FROM tot) * greatest({TARGET} - {BASE} * (SELECT count(*) FROM tot), 1)) AS BIGINT) AS quota FROM tot)
"""
)
_SAMPLE = (
    _QUOTA
    + f""",
pos AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY src, seq) - 1 AS pos, row_number() OVER (PARTITION BY src ORDER BY seq) - 1 AS idx FROM e),
s0 AS (SELECT month, n, quota, t, coalesce(try_cast(nullif(regexp_replace(month, '[^0-9]', '', 'g'), '') AS BIGINT), 0) AS no FROM q, range(1, {TRIES + 1}) AS x(t)),
s1 AS (SELECT month, n, quota, t, {_draw(1)} % n AS start, {SEG_MIN} + {_draw(2)} % {SEG_MAX - SEG_MIN + 1} AS size FROM s0),
cov AS (SELECT month, quota, pos, min(t) AS ft FROM (SELECT month, quota, t, unnest(range(start, least(start + size, n))) AS pos FROM s1) GROUP BY ALL),
cum AS (SELECT month, quota, ft, sum(count(*)) OVER (PARTITION BY month ORDER BY ft) AS cum FROM cov GROUP BY month, quota, ft),
stop AS (SELECT month, min(ft) AS stop FROM cum WHERE cum >= quota GROUP BY month),
take AS (SELECT cov.month, cov.pos FROM cov LEFT JOIN stop USING (month) WHERE ft <= coalesce(stop, {TRIES})),
smp AS (SELECT pos.* FROM pos JOIN take USING (month, pos))
"""
)
_SEGMENTS = """, sg AS (SELECT month, CASE WHEN lag(idx) OVER w IS NULL OR lag(idx) OVER w <> idx - 1 THEN 1 ELSE 0 END AS fresh FROM smp WINDOW w AS (PARTITION BY month, src ORDER BY seq)),
st AS (SELECT month, any_value(tot.n) AS total, count(fresh) AS sampled, CAST(coalesce(sum(fresh), 0) AS BIGINT) AS segments FROM tot LEFT JOIN sg USING (month) GROUP BY month)
"""
_RULES_SQL = {
    0: "list_filter(regexp_extract_all(line, '[0-9]+'), lambda x: regexp_full_match(x, '1[3-9][0-9]{9}'))",
    1: "list_filter(regexp_extract_all(line, '[0-9]+[Xx]?'), lambda x: regexp_full_match(x, '[0-9]{17}[0-9Xx]'))",
    2: r"regexp_extract_all(line, '[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.]{2,}')",
    3: "regexp_extract_all(line, 'wxid_[A-Za-z0-9_]{4,}')",
    4: r"""regexp_extract_all(line, '[A-Za-z]:\\\\Users\\\\[^\\\s"'']+|/(?:Users|home)/[A-Za-z0-9._-]+')""",
    5: r"list_filter(regexp_extract_all(line, '[0-9]+(?:\.[0-9]+)*'), lambda x: regexp_full_match(x, '(?:[0-9]{1,3}\.){3}[0-9]{1,3}'))",
    6: "regexp_extract_all(line, '(?:sk|pk)-[A-Za-z0-9]{16,}')",
}
_HITS = """
WITH d AS (SELECT DISTINCT msg_id, content FROM chat_messages WHERE content IS NOT NULL),
s AS (SELECT msg_id, string_split(content, chr(10)) AS ls FROM d),
l AS (SELECT msg_id, CAST(i AS INTEGER) AS line_no, ls[i] AS line FROM s, unnest(range(1, len(ls) + 1)) AS x(i)),
f AS (""" + " UNION ALL ".join(f"SELECT msg_id, line_no, {k} AS ord, '{model.PRIVACY_RULES[k][0]}' AS label, {e} AS found FROM l" for k, e in _RULES_SQL.items()) + """),
h AS (SELECT msg_id, line_no, ord, label, CAST(i - 1 AS INTEGER) AS pos, substr(found[i], 1, 60) AS value FROM f, unnest(range(1, len(found) + 1)) AS x(i))
"""


def oracle_sql():
    m = sql.MESSAGES
    english = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b, _ in model.PRIVACY_RULES)
    phrase = f"rtrim({sql.strip('content')}, '{model.PHRASE_ENDS}')"
    buckets = ", ".join(f"({b}, {lo}, {hi or 1_000_000_000})" for b, lo, hi in model.LENGTH_BUCKETS)
    return {
        "speaker_counts": m + "SELECT sender, n FROM counts",
        "summary_pair": m + """SELECT *, char_n / greatest(user_n, 1) AS ratio FROM (SELECT count(*) AS total, (SELECT count(DISTINCT sender) FROM m) AS participants,
            count(*) FILTER (sender = (SELECT sender FROM ch)) AS char_n, count(*) FILTER (sender = (SELECT sender FROM us)) AS user_n FROM v)""",
        "length_histogram": m + f"""SELECT bucket, (SELECT count(*) FROM c WHERE length(content) BETWEEN lo AND hi) AS n,
            (SELECT count(*) FROM c WHERE length(content) BETWEEN lo AND hi) / greatest((SELECT count(*) FROM c), 1) AS share,
            (SELECT coalesce(sum(length(content)), 0) FROM c) / greatest((SELECT count(*) FROM c), 1) AS mean FROM (VALUES {buckets}) AS b(bucket, lo, hi)""",
        "monthly_volume": m + "SELECT substr(ts_raw, 1, 7) AS month, count(*) AS n FROM v GROUP BY 1",
        "active_hours": m + f"SELECT {_HOUR} AS hour, count(*) AS n FROM c WHERE {_HOUR} IS NOT NULL GROUP BY 1",
        "peak_hour": m + f"SELECT hour, n FROM (SELECT {_HOUR} AS hour, count(*) AS n, min({{'a': src, 'b': seq}}) AS p FROM c WHERE {_HOUR} IS NOT NULL GROUP BY 1) {_TOP} LIMIT 1",
        "token_dilution": _tokens(model.BRACKET) + f"SELECT token, n, greatest((SELECT count(*) FROM c), 1) / n AS dilution FROM g {_TOP} LIMIT {model.TOP_TOKENS}",
        "emoji_rank": _tokens(_RE2_EMOJI) + f"SELECT token, n FROM g {_TOP} LIMIT {model.TOP_TOKENS}",
        "catchphrase_rank": m + f"""SELECT phrase, n FROM (SELECT phrase, count(*) AS n, min({{'a': src, 'b': seq}}) AS p FROM (SELECT *, {phrase} AS phrase FROM c)
            WHERE length(phrase) BETWEEN 2 AND 8 AND NOT starts_with(phrase, '[') GROUP BY phrase {_TOP} LIMIT {model.TOP_PHRASES}) WHERE n >= {PHRASE_MIN}""",
        "ngrams_top": m + f""", w AS (SELECT content, count(*) AS w, min({{'a': src, 'b': seq}}) AS p FROM c WHERE NOT starts_with(content, '[') GROUP BY content),
            t AS (SELECT w, p, k, i, substr(content, i, k) AS gram FROM (SELECT w, p, content, k, unnest(range(1, length(content) - k + 2)) AS i FROM w, (VALUES (2), (3), (4)) AS x(k))),
            g AS (SELECT gram, CAST(sum(w) AS BIGINT) AS n, min({{'a': p.a, 'b': p.b, 'k': k, 'i': i}}) AS p FROM t GROUP BY gram {_TOP} LIMIT {model.TOP_GRAMS})
            SELECT gram, n FROM g WHERE n >= {GRAM_MIN} AND NOT regexp_full_match(gram, '[{model.STOP_CHARACTERS}]+') {_TOP} LIMIT {model.SHOWN_GRAMS}""",
        "sentence_tails": m + f"""SELECT tail, n FROM (SELECT tail, count(*) AS n, min({{'a': src, 'b': seq}}) AS p FROM (SELECT *, right({sql.strip('content')}, 1) AS tail, {sql.strip('content')} AS s FROM c)
            WHERE s <> '' AND NOT starts_with(s, '[') AND contains('{model.TAILS}', tail) GROUP BY tail {_TOP} LIMIT {model.TOP_TAILS})""",
        "burst_stats": _BURSTS + "SELECT count(*) AS n, avg(run) AS mean, max(run) AS longest FROM r HAVING count(*) > 0",
        "burst_histogram": _BURSTS + f"SELECT run, count(*) AS n FROM r GROUP BY run ORDER BY run LIMIT {model.SHOWN_BURSTS}",
        "name_occurrences": m + """SELECT CAST(sum((length(sender) - length(replace(sender, k, ''))) // length(k)) AS BIGINT) AS in_sender,
            CAST(sum((length(content) - length(replace(content, k, ''))) // length(k)) AS BIGINT) AS in_content FROM m, (SELECT sender AS k FROM ch)""",
        "month_quotas": _QUOTA + "SELECT month, n, quota FROM q",
        "stratified_sample": _SAMPLE + "SELECT month, src, seq FROM smp",
        "sample_stats": _SAMPLE + _SEGMENTS + "SELECT * FROM st",
        "sample_total": _SAMPLE + _SEGMENTS + "SELECT CAST(sum(sampled) AS BIGINT) AS sampled, CAST(sum(total) AS BIGINT) AS total FROM st",
        "privacy_hits": _HITS + "SELECT * FROM h",
        "privacy_rule_counts": _HITS + f"SELECT label, CASE label {english} END AS label_en, count(*) AS n FROM h GROUP BY label",
    }
