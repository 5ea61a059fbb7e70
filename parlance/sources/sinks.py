"""Writers: messages, samples, reports, picture cards and deployed cards."""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.operators.cards import file_name, to_v3
from parlance.operators.sampling import sample_stats

SIGNATURE = bytes.fromhex("89504e470d0a1a0a")


def transcript(messages: DataFrame) -> DataFrame:
    """(src, seq, value): each message as three lines and a blank one."""
    return messages.select("src", "seq", F.concat_ws("\n", F.coalesce("ts_raw", F.lit("")), F.coalesce("sender", F.lit("")), F.coalesce("content", F.lit("")), F.lit("")).alias("value"))


def write_transcript(messages: DataFrame, path: str) -> None:
    """Text files in order, range-partitioned by place."""
    transcript(messages).repartitionByRange("src", "seq").sortWithinPartitions("src", "seq").select("value").write.text(path)


def sample_lines(messages: DataFrame, sample: DataFrame) -> DataFrame:
    """(month, pos, value): a heading per month at position -1, then ``sender: content``."""
    head = sample_stats(messages, sample).where("sampled > 0").select("month", F.lit(-1).cast("bigint").alias("pos"), F.format_string("===== %s | %d -> %d (%d) =====", "month", "total", "sampled", "segments").alias("value"))
    return head.unionByName(sample.select("month", "pos", F.concat("sender", F.lit(": "), "content").alias("value")))


def sample_report(stats: DataFrame) -> list[str]:
    """The lines beside a sample: a row per month, and the grand total."""
    rows = stats.orderBy("month").collect()  # one per month
    line = lambda *x: "{:<7} {:>8} {:>8} {:>8}".format(*x)
    total = f"Total sampled: {sum(r.sampled for r in rows)} / {sum(r.total for r in rows)}"
    return [line("month", "total", "sampled", "segments"), *[line(r.month, r.total, r.sampled, r.segments) for r in rows], total]


def json_array(rows: DataFrame) -> DataFrame:
    """(value): the rows as JSON lines in the fields of an export."""
    return rows.select(F.to_json(F.struct(F.col("ts_raw").alias("time"), "sender", "content", F.lit(1).alias("type"))).alias("value"))


def placeholder_picture(side: int = 256, square: int = 32) -> bytes:
    """A PNG for cards without one: a chequered tile of one bit a pixel."""
    light = np.add.outer(np.arange(side) // square, np.arange(side) // square) % 2
    lines = np.hstack([np.zeros((side, 1), np.uint8), np.packbits(light.astype(np.uint8), axis=1)])  # no filter on any line
    head = np.array([side, side], ">u4").tobytes() + b"\1\0\0\0\0"
    return SIGNATURE + b"".join(_part(kind, body) for kind, body in ((b"IHDR", head), (b"IDAT", zlib.compress(lines.tobytes())), (b"IEND", b"")))


def _part(kind: bytes, body: bytes) -> bytes:
    return len(body).to_bytes(4, "big") + kind + body + zlib.crc32(kind + body).to_bytes(4, "big")


def _u32(n: Column) -> Column:
    return F.unhex(F.lpad(F.hex(n.cast("bigint")), 8, "0"))


def text_part(keyword: str, value: Column) -> Column:
    """A tEXt part of a PNG, as BINARY, with native length and checksum."""
    typed = F.concat(F.lit(b"tEXt" + keyword.encode() + b"\0"), value.cast("binary"))
    return F.concat(_u32(F.length(typed) - 4), typed, _u32(F.crc32(typed)))


def pictured(cards: DataFrame, card: str = "card", picture: str = "picture") -> DataFrame:
    """``cards`` with ``png``: the picture (null: a placeholder) with the card in it as second and third
    version, base64 of compact JSON, before the end mark."""
    base = F.coalesce(F.col(picture), F.lit(placeholder_picture()))
    packed = lambda c: F.regexp_replace(F.base64(F.encode(F.to_json(c), "UTF-8")), "[\r\n]", "")
    # by one byte a character: the last part's name, before its length; what follows the end mark stays behind it
    letters = F.decode(base, "ISO-8859-1")
    last = F.length(base) - F.instr(F.reverse(letters), "DNEI") - 7
    cut = F.when(F.contains(letters, F.lit("IEND")) & (last >= 8), last).otherwise(F.raise_error(F.lit("a picture without its end mark")).cast("int"))
    parts = F.concat(text_part("chara", packed(F.col(card))), text_part("ccv3", packed(to_v3(F.col(card)))))
    return cards.withColumn("png", F.concat(F.substring(base, F.lit(1), cut), parts, F.substring(base, cut + 1, F.length(base))))


def write_report(lines: Iterable[str], path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        for k, line in enumerate(lines):
            f.write("\n" + line if k else line)


def deploy(cards: DataFrame, directory: str, dry_run: bool = False) -> list[str]:
    """Copies each card of (path, card) to the directory under its name; returns the targets."""
    target = Path(directory)
    if not target.is_dir():
        raise FileNotFoundError(directory)
    stem = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.json$", "")
    out = []
    for r in cards.select("path", file_name(F.col("card"), stem).alias("name")).toLocalIterator():
        out.append(str(target / r.name))
        if not dry_run:
            (target / r.name).write_bytes(Path(r.path.removeprefix("file:")).read_bytes())
    return out
