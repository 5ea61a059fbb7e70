"""Reports as text, made at the driver from small results. Numbers are formatted here, so rounding is that of
Python's formats."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance import model
from parlance.operators import cards as ops

BAR = "█"


def bar(n: int, per: int) -> str:
    return BAR * max(1, n // per)


LABELS = {
    "en": {
        "title": "=== Style profile ===", "total": "{0} messages, {1} participants", "pair": "{0}: {1}, {2}: {3}, ratio {4:.2f}", "lengths": "[1] Lengths", "mean": "mean {0:.1f}", "months": "[2] Months",
        "hours": "[3] Hours", "peak": "peak {0:02d}", "brackets": "[4] Bracket tokens", "token": "{0} {1} (once in {2:.0f})", "emoji": "[5] Emoji", "phrases": "[6] Phrases", "fragments": "[7] Fragments",
        "tails": "[8] Tails", "bursts": "[9] Bursts", "burst": "mean {0:.2f}, longest {1}", "none": "none", "attention": "=== Needs attention ===", "passed": "=== All checks passed ===",
    },
    "zh": {
        "title": "=== 说话风格 ===", "total": "消息 {0} 条，参与者 {1} 人", "pair": "{0}：{1}，{2}：{3}，比值 {4:.2f}", "lengths": "[1] 长度", "mean": "平均 {0:.1f}", "months": "[2] 月份",
        "hours": "[3] 时段", "peak": "最多 {0:02d} 点", "brackets": "[4] 方括号记号", "token": "{0} {1}（每 {2:.0f} 条一次）", "emoji": "[5] 表情符号", "phrases": "[6] 短句", "fragments": "[7] 片段",
        "tails": "[8] 句尾", "bursts": "[9] 连发", "burst": "平均 {0:.2f}，最长 {1}", "none": "无", "attention": "=== 待处理 ===", "passed": "=== 检查无误 ===",
    },
}


def render_profile(sections: dict[str, DataFrame], char: str, user: str, lang: str = "en") -> list[str]:
    """The lines of a profile report, section by section, each in its order."""
    say = lambda k, *x: LABELS[lang][k].format(*x)
    got = {k: df.collect() for k, df in sections.items()}  # each section is bounded by its limit or by its nature
    s = got["summary"][0]
    out = [say("title"), say("total", s.total, s.participants), say("pair", char, s.char_n, user, s.user_n, s.ratio), ""]
    labels = {1: "<=5", 2: "6-20", 3: "21-100", 4: ">100"}
    rows = got["length_histogram"]
    out += [say("lengths"), say("mean", rows[0].mean)] + [f"{labels[r.bucket]:>7}: {r.n:>6} ({r.share * 100:.1f}%) {BAR * int(r.share * 40)}" for r in rows] + [""]
    out += [say("months")] + [f"{r.month}: {r.n:>6} {bar(r.n, 200)}" for r in got["monthly_volume"]] + [""]
    out += [say("hours")] + [f"{r.hour:02d}: {r.n:>6} {bar(r.n, 100)}" for r in got["active_hours"]]
    out += [say("peak", r.hour) for r in got["peak_hour"]] + [""]
    out += [say("brackets")] + [say("token", r.token, r.n, r.dilution) for r in got["brackets"]] + [""]
    out += [say("emoji")] + [f"{r.token} {r.n}" for r in got["emoji"]] + [""]
    out += [say("phrases")] + ([f"{r.phrase} {r.n}" for r in got["catchphrases"]] or [say("none")]) + [""]
    out += [say("fragments")] + ([f"{r.gram} {r.n}" for r in got["ngrams"]] or [say("none")]) + [""]
    out += [say("tails")] + [f"{r.tail} {r.n}" for r in got["tails"]] + [""]
    if got["burst_stats"]:
        b = got["burst_stats"][0]
        out += [say("bursts"), say("burst", b.mean, b.longest)] + [f"{r.run}: {r.n}" for r in got["burst_histogram"]] + [""]
    return out


def render_card(cards: DataFrame, key: str = "path", greeting: int = model.MOST_GREETING_LINES, example: int = model.MOST_EXAMPLE_LINES, lang: str = "en") -> Iterator[str]:
    """The lines of the reports of a folder of cards, card by card: what each holds, then what needs attention.

    The findings of all checks are one sorted DataFrame, read partition by partition.
    """
    say = lambda k, *x: CARD_LABELS[lang][k].format(*x)
    for name, group in groupby(card_findings(cards, key, greeting, example).orderBy(key, "part", "i").toLocalIterator(), lambda r: r[key]):
        last, warned = "", False
        yield say("card", name)
        for r in group:
            if r.part != last:
                yield say(r.part)
                last = r.part
            warned |= r.part == "6"
            yield "  " + ("! " if r.part == "6" else "") + f"{r.subject}: {r.n}" + (f" {r.note}" if r.note else "")
        if not warned:
            yield say("passed")


def card_findings(cards: DataFrame, key: str, greeting: int, example: int) -> DataFrame:
    """(key, part, i, subject, n, note): 1 kind and name, 2 fields, 3 lines of the greeting and the examples,
    4 lorebook, 5 other greetings, 6 warnings."""
    body, zero = ops.body(F.col("card")), F.lit(0).cast("bigint")
    rows = lambda df, part, i, subject, n, note=F.lit(""): df.select(key, F.lit(part).alias("part"), i.cast("bigint").alias("i"), subject.cast("string").alias("subject"), n.cast("bigint").alias("n"), note.alias("note"))
    lines, others = ops.greeting_lines(cards, key), F.col("idx") > 0
    empty = F.when(F.col("n_chars") == 0, "(empty)").otherwise("")
    parts = [
        rows(cards, "1", zero, ops.kind(F.col("card")), F.coalesce(F.length(body["name"]), zero), F.coalesce(body["name"], F.lit(""))),
        rows(ops.field_lengths(cards, key), "2", zero, F.col("field"), F.col("n_chars"), empty),
        rows(lines.where(~others), "3", F.col("idx"), F.lit("first_mes"), F.col("n_lines")), rows(ops.example_lines(cards, key), "3", F.col("idx"), F.col("idx"), F.col("n_lines")),
        rows(ops.lorebook(cards, key), "4", F.col("idx"), F.coalesce(F.array_join("keys", ", "), F.lit("")), F.col("n_chars")),
        rows(lines.where(others), "5", F.col("idx"), F.col("idx"), F.col("n_lines")),
        rows(ops.warnings(cards, key, greeting, example), "6", zero, F.concat_ws(" ", "check", "subject"), F.col("n")),
    ]
    return reduce(DataFrame.unionByName, parts)


CARD_LABELS = {
    "en": {"card": "=== {0} ===", "1": "Kind and name", "2": "Characters of fields", "3": "Lines of greeting and examples", "4": "Lorebook", "5": "Other greetings", "6": LABELS["en"]["attention"], "passed": LABELS["en"]["passed"]},
    "zh": {"card": "=== {0} ===", "1": "类型与名字", "2": "字段字符数", "3": "开场白与示例行数", "4": "世界书", "5": "其他开场白", "6": LABELS["zh"]["attention"], "passed": LABELS["zh"]["passed"]},
}
