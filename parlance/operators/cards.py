"""Character cards: classification, checks and repackaging of nested documents.

Cards are rows with a key and a struct ``card`` of model.CARD. Flat cards of the first version are read
through the same body as enveloped ones. Defined results: a null card has no body and gives all warnings of
an empty one; null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance import model
from parlance.functions.text import nonblank_lines

BODY = [f.name for f in model._CARD_BODY]


def body(card: Column) -> Column:
    return F.coalesce(card["data"], F.struct(*[card[f].alias(f) for f in BODY]))


def kind(card: Column) -> Column:
    """v1, v2, v3 or unknown."""
    spec = F.coalesce(card["spec"], F.lit(""))
    return F.when(spec == "chara_card_v3", "v3").when(spec == "chara_card_v2", "v2").when(spec.isin("", "chara_card_v1"), "v1").otherwise("unknown")


def to_v3(card: Column) -> Column:
    return card.withField("spec", F.lit("chara_card_v3")).withField("spec_version", F.lit("3.0"))


def no_text(cards: DataFrame) -> Column:
    """The fields that hold something else than a text, which count as empty: the reader's column ``other``."""
    return F.coalesce("other", F.array().cast("array<string>")) if "other" in cards.columns else F.array().cast("array<string>")


def field_lengths(cards: DataFrame, key: str) -> DataFrame:
    """(key, field, n_chars) of the required fields and the post-history instructions."""
    b = cards.select(key, body(F.col("card")).alias("b"), no_text(cards).alias("o"))
    size = lambda f: F.when(F.array_contains("o", f), 0).otherwise(F.coalesce(F.length(F.col("b")[f]), F.lit(0))).cast("bigint")
    fields = [F.struct(F.lit(f).alias("field"), size(f).alias("n_chars")) for f in (*model.CARD_FIELDS, "post_history_instructions")]
    return b.select(key, F.explode(F.array(*fields)).alias("x")).select(key, "x.*")


def replies(text: Column, second: bool = False) -> Column:
    """array<string>: what follows {{char}} in each group between {{user}}; with ``second``, only up to the
    next {{char}}."""
    groups = F.filter(F.split(F.coalesce(text, F.lit("")), r"\{\{user\}\}"), lambda g: F.contains(g, F.lit("{{char}}")))
    if second:
        return F.transform(groups, lambda g: F.split(g, r"\{\{char\}\}")[1])
    return F.transform(groups, lambda g: F.substring(g, F.instr(g, "{{char}}") + 8, F.length(g)))


def example_lines(cards: DataFrame, key: str) -> DataFrame:
    """(key, idx, n_lines) of each example reply, numbered from 1."""
    b = cards.select(key, F.posexplode(replies(body(F.col("card"))["mes_example"])).alias("i", "reply"))
    return b.select(key, (F.col("i") + 1).cast("bigint").alias("idx"), nonblank_lines(F.col("reply")).alias("n_lines"))


def greeting_lines(cards: DataFrame, key: str) -> DataFrame:
    """(key, idx, n_lines); idx 0 is the first message, others the alternate greetings."""
    b = body(F.col("card"))
    all_ = F.concat(F.array(F.coalesce(b["first_mes"], F.lit(""))), F.coalesce(b["alternate_greetings"], F.array().cast("array<string>")))
    return cards.select(key, F.posexplode(all_).alias("i", "g")).select(key, F.col("i").cast("bigint").alias("idx"), nonblank_lines(F.coalesce("g", F.lit(""))).alias("n_lines"))


def lorebook(cards: DataFrame, key: str) -> DataFrame:
    """(key, idx, keys, n_chars) of the entries."""
    b = cards.select(key, F.posexplode(body(F.col("card"))["character_book"]["entries"]).alias("i", "e"))
    return b.select(key, (F.col("i") + 1).cast("bigint").alias("idx"), F.col("e.keys").alias("keys"), F.coalesce(F.length("e.content"), F.lit(0)).cast("bigint").alias("n_chars"))


def warnings(cards: DataFrame, key: str, greeting: int = model.MOST_GREETING_LINES, example: int = model.MOST_EXAMPLE_LINES) -> DataFrame:
    """(key, check, subject, n): one row per finding."""
    row = cards.select(key, kind(F.col("card")).alias("k"), F.col("card.spec").alias("spec"), body(F.col("card")).alias("b"), no_text(cards).alias("o"))
    row = row.withColumn("replies", F.transform(replies(F.col("b.mes_example")), lambda r: nonblank_lines(r))).withColumn("lines", nonblank_lines(F.coalesce("b.first_mes", F.lit(""))))
    empty = F.array().cast("array<struct<check:string,subject:string,n:bigint>>")

    def finding(cond: Column, check: str, subject: Column, n: Column) -> Column:
        return F.when(cond, F.array(F.struct(F.lit(check).alias("check"), subject.cast("string").alias("subject"), n.cast("bigint").alias("n")))).otherwise(empty)

    blank = lambda f: (F.coalesce(F.length(F.col("b")[f]), F.lit(0)) == 0) | F.array_contains("o", f)
    found = [finding(F.col("k") == "unknown", "unknown spec", F.col("spec"), F.lit(0))]
    found += [finding(blank(f), "empty field", F.lit(f), F.lit(0)) for f in model.CARD_FIELDS]
    found += [
        finding(blank("post_history_instructions"), "empty field", F.lit("post_history_instructions"), F.lit(0)),
        finding(F.col("lines") > greeting, "long greeting", F.lit("first_mes"), F.col("lines")),
        F.transform(
            F.filter(F.transform("replies", lambda n, i: F.struct((i + 1).alias("i"), n.alias("n"))), lambda x: x["n"] > example),
            lambda x: F.struct(F.lit("long example").alias("check"), x["i"].cast("string").alias("subject"), x["n"].cast("bigint").alias("n")),
        ),
        finding(F.size("replies") == 0, "no reply", F.lit("mes_example"), F.lit(0)),
        finding(F.coalesce(F.size("b.character_book.entries"), F.lit(0)) <= 0, "empty lorebook", F.lit("character_book"), F.lit(0)),
    ]
    return row.select(key, F.explode(F.concat(*found)).alias("x")).select(key, "x.*")


def file_name(card: Column, fallback: Column) -> Column:
    """The name under which a card is deployed."""
    return F.concat(F.regexp_replace(F.coalesce(F.nullif(body(card)["name"], F.lit("")), fallback), r'[\\/:*?"<>|]', "_"), F.lit(".json"))
