"""Command line: python -m parlance.cli COMMAND ..."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def printed(counts: DataFrame) -> None:
    for r in counts.orderBy(F.desc("count"), "sender").toLocalIterator():
        print(f"{r['count']:>8} {r.sender}")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="parlance")
    sub = ap.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple, needs: tuple[str, ...] = ("input",)) -> None:
        p = sub.add_parser(name)
        for n in needs:
            p.add_argument(f"--{n}", f"-{n[0]}", required=True)
        p.add_argument("--lang", choices=("en", "zh"), default="en")
        for flag, default in options:
            p.add_argument(flag, **({"action": "store_true"} if default is False else {"default": default, "type": type(default)}))

    command("profile", ("--char-name", ""), ("--user-name", ""), ("--emoji-top", 30), ("--phrase-min", 10), ("--output", "stats.txt"))
    command("convert", ("--keep-non-text", False), ("--list-senders", False), ("--output", ""))
    command("subtitles", ("--date", "2024-01-01"), ("--speaker", ""), ("--list-speakers", False), ("--output", ""))
    command("sample", ("--target", 6500), ("--base", 120), ("--seg-min", 20), ("--seg-max", 45), ("--seed", 42), ("--output", "sampled.txt"))
    command("privacy", needs=("path",))
    command("card", ("--max-lines", 6), ("--max-example-lines", 5), ("--output", ""))
    command("picture", ("--avatar", ""), needs=("input", "output"))
    command("demo", ("--count", 3000), needs=("output",))
    command("deploy", ("--dry-run", False), needs=("input", "dest"))
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("parlance").getOrCreate()

    from parlance import model, render
    from parlance.runtime import ship
    from parlance.operators import privacy, profile, sampling, subtitles
    from parlance.sources import demo, exports, sinks

    ship(spark)
    if a.command == "profile":
        messages = exports.read_transcripts(spark, a.input).cache()
        char, user = profile.resolve_speakers(messages, a.char_name, a.user_name)
        sinks.write_report(render.render_profile(profile.profile(messages, char, user, a.emoji_top, a.phrase_min), char, user, a.lang), a.output)
    elif a.command == "convert":
        rows = exports.read_json_exports(spark, a.input)
        if a.list_senders:
            printed(rows.groupBy(F.coalesce(F.nullif("sender", F.lit("")), F.lit("(空)")).alias("sender")).count())
        else:
            sinks.write_transcript(exports.kept(rows, a.keep_non_text), a.output)
            exports.counters(rows).show()
    elif a.command == "subtitles":
        rows = subtitles.cue_messages(exports.read_subtitles(spark, a.input), a.date, a.speaker, keep=("src", "seq"))
        speakers = rows.groupBy("sender").count()
        if a.list_speakers:
            printed(speakers)
        else:
            sinks.write_transcript(rows, a.output)
        if not a.speaker and speakers.limit(2).count() == 1:
            print("only one speaker was found: --speaker gives the name of who speaks")
    elif a.command == "sample":
        messages = exports.read_transcripts(spark, a.input).cache()
        picked = sampling.stratified_sample(messages, a.target, a.base, a.seg_min, a.seg_max, a.seed)
        lines = sinks.sample_lines(messages, picked).orderBy("month", "pos").select("value")
        sinks.write_report((r.value for r in lines.toLocalIterator()), a.output)
        out = Path(a.output)
        sinks.write_report(sinks.sample_report(sampling.sample_stats(messages, picked)), str(out.with_name(out.stem + "_stats.txt")))
    elif a.command == "privacy":
        english = {zh: en for zh, en, _ in model.PRIVACY_RULES}
        found = privacy.scan_files(privacy.text_files(spark, a.path, privacy.ignored_files(spark, a.path))).orderBy("path", "line_no", "ord", "pos")
        n = 0
        for n, r in enumerate(found.toLocalIterator(), 1):
            print(f"[{english[r.label] if a.lang == 'en' else r.label}] {r.path}:{r.line_no}  {r.value}")
        return int(n > 0)
    elif a.command == "card":
        lines = render.render_card(exports.read_cards(spark, a.input), "path", a.max_lines, a.max_example_lines, a.lang)
        sinks.write_report(lines, a.output) if a.output else print("\n".join(lines))
    elif a.command == "picture":
        made = exports.read_cards(spark, a.input)
        picture = exports.read_pictures(spark, a.avatar).select(F.col("content").alias("picture")) if a.avatar else spark.range(1).select(F.lit(None).cast("binary").alias("picture"))
        png = sinks.pictured(made.withColumn("picture", F.lit(picture.first().picture))).first().png
        with open(a.output, "wb") as f:
            f.write(bytes(png))
    elif a.command == "demo":
        sinks.json_array(demo.demo_messages(spark, a.count).orderBy("seq")).write.text(a.output)
    elif a.command == "deploy":
        print("\n".join(sinks.deploy(exports.read_cards(spark, a.input), a.dest, a.dry_run)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
