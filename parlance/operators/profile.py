"""Style profile of a speaker over the message relation (src, seq, ts_raw, sender, content).

Each section is a lazy DataFrame. Rankings are stable: by count, ties by first occurrence in (src, seq), then
by place within the message. Tokens and n-grams are made from distinct contents with their weights, so
repeated messages cost one row (exact, as tokens depend on the content alone).

Defined results: empty and separator contents are in no section but ``speaker_counts``; a speaker without
messages gives empty sections, and zeros in ``summary`` and ``length_histogram``; a null sender or content
counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance import model
from parlance.functions.text import char_ngrams, hour_of, last_char, strip, year_month
from parlance.operators.ordered import BLOCK, stretches


def valid(messages: DataFrame) -> DataFrame:
    """Messages that count. A relation with a column ``ok`` has been told already, so that no content is read."""
    if "ok" in messages.columns:
        return messages.where("ok")
    c = F.coalesce("content", F.lit(""))
    return messages.withColumn("content", c).withColumn("sender", F.coalesce("sender", F.lit(""))).where(is_valid(c))


def is_valid(content: Column) -> Column:
    return (content != "") & ~content.startswith(model.SEPARATOR)


def of(messages: DataFrame, speaker: str) -> DataFrame:
    return valid(messages).where(F.col("sender") == speaker)


def first_place(*more: str) -> Column:
    return F.min(F.struct("src", "seq", *more))


def ranked(counts: DataFrame, k: int, n: str = "n", first: str = "first_pos") -> DataFrame:
    """The k most frequent rows, ties by first occurrence."""
    return counts.orderBy(F.desc(n), F.asc(first)).limit(k)


def speaker_counts(messages: DataFrame) -> DataFrame:
    """(sender, n, first_pos) over all messages, those with empty contents included."""
    return messages.groupBy(F.coalesce("sender", F.lit("")).alias("sender")).agg(F.count("*").alias("n"), first_place().alias("first_pos"))


def resolve_speakers(messages: DataFrame, char: str = "", user: str = "") -> tuple[str, str]:
    """The profiled speaker and the other one: as given, else the most frequent. Unknown names raise."""
    counts = speaker_counts(messages)
    given = [n for n in (char, user) if n]
    if given:
        known = {r.sender for r in counts.where(F.col("sender").isin(given)).collect()}
        if missing := [n for n in given if n not in known]:
            names = ", ".join(r.sender for r in ranked(counts, 12).collect())
            raise ValueError(f"no such speaker: {missing[0]}; the most frequent are {names}")
    top = [r.sender for r in ranked(counts, 2).collect()]
    first = char or (top[0] if top else "")
    if user:
        return first, user
    if char:
        top = [r.sender for r in ranked(counts.where(F.col("sender") != char), 1).collect()]
        return first, top[0] if top else ""
    return first, top[1] if len(top) > 1 else ""


def summary(messages: DataFrame, char: str, user: str) -> DataFrame:
    """One row: valid messages, participants, both speakers' messages and their ratio."""
    total = messages.agg(F.count_distinct(F.coalesce("sender", F.lit(""))).alias("participants"))
    one = valid(messages).agg(F.count("*").alias("total"), F.count_if(F.col("sender") == char).alias("char_n"), F.count_if(F.col("sender") == user).alias("user_n"))
    return one.select("total", total.scalar().alias("participants"), "char_n", "user_n", (F.col("char_n") / F.greatest("user_n", F.lit(1))).alias("ratio"))


def length_histogram(messages: DataFrame, speaker: str) -> DataFrame:
    """(bucket, n, share, mean): always four rows."""
    size = F.length("content")
    counts = [F.count_if((size >= lo) & (size <= hi if hi else F.lit(True))).alias(f"b{b}") for b, lo, hi in model.LENGTH_BUCKETS]
    one = of(messages, speaker).agg(F.count("*").alias("all"), F.coalesce(F.sum(size), F.lit(0)).alias("chars"), *counts)
    rows = F.explode(F.array(*[F.struct(F.lit(b).alias("bucket"), F.col(f"b{b}").alias("n")) for b, _, _ in model.LENGTH_BUCKETS])).alias("x")
    tot = F.greatest(F.col("all"), F.lit(1))
    return one.select(rows, tot.alias("tot"), "chars").select("x.bucket", "x.n", (F.col("x.n") / F.col("tot")).alias("share"), (F.col("chars") / F.col("tot")).alias("mean"))


def monthly_volume(messages: DataFrame) -> DataFrame:
    """(month, n) over all speakers."""
    return valid(messages).groupBy(year_month(F.col("ts_raw")).alias("month")).agg(F.count("*").alias("n"))


def active_hours(messages: DataFrame, speaker: str) -> DataFrame:
    """(hour, n, first_pos) of the observed hours."""
    rows = of(messages, speaker).withColumn("hour", hour_of(F.col("ts_raw"))).where("hour is not null")
    return rows.groupBy("hour").agg(F.count("*").alias("n"), first_place().alias("first_pos"))


def peak_hour(messages: DataFrame, speaker: str) -> DataFrame:
    return ranked(active_hours(messages, speaker), 1)


def weighted(rows: DataFrame, content: Column | None = None) -> DataFrame:
    """(content, w, src, seq): distinct contents with weight and first place."""
    c = F.col("content") if content is None else content
    g = rows.groupBy(c.alias("content")).agg(F.count("*").alias("w"), first_place().alias("p"))
    return g.select("content", "w", "p.src", "p.seq")


def token_rank(messages: DataFrame, speaker: str, pattern: str, k: int = model.TOP_TOKENS) -> DataFrame:
    """(token, n, dilution, first_pos): tokens of the speaker, and messages per occurrence."""
    rows = of(messages, speaker)
    total = rows.agg(F.greatest(F.count("*"), F.lit(1)).alias("t")).scalar()
    found = weighted(rows).select("w", "src", "seq", F.posexplode(F.regexp_extract_all("content", F.lit(pattern), F.lit(0))).alias("i", "token"))
    counts = found.groupBy("token").agg(F.sum("w").alias("n"), first_place("i").alias("first_pos"))
    return ranked(counts, k).withColumn("dilution", total / F.col("n"))


def catchphrases(messages: DataFrame, speaker: str, least: int = 10, k: int = model.TOP_PHRASES) -> DataFrame:
    """(phrase, n, first_pos): repeated short contents, the k most frequent, then those with ``least``."""
    phrase = F.rtrim(strip(F.col("content")), F.lit(model.PHRASE_ENDS))
    rows = of(messages, speaker).withColumn("phrase", phrase).where(F.length("phrase").between(2, 8) & ~F.col("phrase").startswith("["))
    return ranked(rows.groupBy("phrase").agg(F.count("*").alias("n"), first_place().alias("first_pos")), k).where(F.col("n") >= least)


def ngrams_top(messages: DataFrame, speaker: str, k: int = model.TOP_GRAMS, least: int = model.LEAST_GRAMS, shown: int = model.SHOWN_GRAMS) -> DataFrame:
    """(gram, n, first_pos): character 2- to 4-grams. The order of the steps counts: the k most frequent, then
    the threshold, then grams of stop characters left out, then the first ``shown``."""
    rows = of(messages, speaker).where(~F.col("content").startswith("["))
    grams = weighted(rows).select("w", "src", "seq", F.explode(char_ngrams(F.col("content"))).alias("x"))
    counts = grams.select("w", "src", "seq", "x.n", "x.i", "x.gram").groupBy("gram").agg(F.sum("w").alias("c"), first_place("n", "i").alias("first_pos"))
    top = ranked(counts, k, "c").where((F.col("c") >= least) & ~F.col("gram").rlike(f"^[{model.STOP_CHARACTERS}]+$"))
    return ranked(top, shown, "c").select("gram", F.col("c").alias("n"), "first_pos")


def sentence_tails(messages: DataFrame, speaker: str, k: int = model.TOP_TAILS, tails: str = model.TAILS) -> DataFrame:
    """(tail, n, first_pos): last characters of the listed ones."""
    c = strip(F.col("content"))
    rows = of(messages, speaker).where((c != "") & ~c.startswith("[")).withColumn("tail", last_char(F.col("content"))).where(F.instr(F.lit(tails), F.col("tail")) > 0)
    return ranked(rows.groupBy("tail").agg(F.count("*").alias("n"), first_place().alias("first_pos")), k)


def bursts(messages: DataFrame, speaker: str, block: int = BLOCK) -> DataFrame:
    """(src, start, run): runs of the speaker in the order of a source; any other sender ends one."""
    rows = valid(messages).select("src", "seq", (F.col("sender") == speaker).alias("speaks"))
    runs = stretches(rows, ["src"], "seq", F.col("speaks"), lambda a, b: a == b, block)
    return runs.where("me").select("src", F.col("first").alias("start"), F.col("n").alias("run"))


def burst_stats(runs: DataFrame) -> DataFrame:
    """One row (n, mean, longest), none without runs."""
    return runs.agg(F.count("*").alias("n"), F.avg("run").alias("mean"), F.max("run").alias("longest")).where("n > 0")


def burst_histogram(runs: DataFrame, shown: int = model.SHOWN_BURSTS) -> DataFrame:
    """(run, n) of the ``shown`` shortest lengths."""
    return runs.groupBy("run").agg(F.count("*").alias("n")).orderBy("run").limit(shown)


def profile(messages: DataFrame, char: str = "", user: str = "", top: int = model.TOP_TOKENS, phrase_min: int = 10) -> dict[str, DataFrame]:
    """All sections, lazily, for the resolved speakers."""
    char, user = resolve_speakers(messages, char, user)
    runs = bursts(messages, char)
    return {
        "summary": summary(messages, char, user), "length_histogram": length_histogram(messages, char).orderBy("bucket"),
        "monthly_volume": monthly_volume(messages).orderBy("month"), "active_hours": active_hours(messages, char).orderBy("hour"), "peak_hour": peak_hour(messages, char), "brackets": token_rank(messages, char, model.BRACKET, top),
        "emoji": token_rank(messages, char, model.EMOJI, top), "catchphrases": catchphrases(messages, char, phrase_min), "ngrams": ngrams_top(messages, char),
        "tails": sentence_tails(messages, char), "burst_stats": burst_stats(runs), "burst_histogram": burst_histogram(runs).orderBy("run"),
    }
