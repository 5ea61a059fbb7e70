"""Filling fixed-capacity containers with documents, measured in tokens.

Method: best-two-fit. A container is filled greedily with the longest item that fits; then its smallest item
is replaced by the two unpacked items that fill the widened gap more tightly, if there are such. Items are
never divided, except documents longer than a container: their full pieces are containers of their own and
the rest is an item.

Scale: only (id, piece, length) is shuffled. Items are dealt by hash into groups of about ``group`` items,
each packed in one task; the number of groups follows the number of items less than a container, and each group leaves at most a
few containers unfilled. Within a group only the counts of lengths (at most ``capacity``) matter.

Defined results: null and blank texts are in no container; equal lengths and repeated rows are taken in the
order of their ids; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parlance.runtime import written

#: the vocabulary's file and pre-tokenisation pattern are parameters; these are the defaults of the queries
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.cache
def encoder(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, doc_id: str, text: str, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens) of the documents that aren't blank."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, pattern).encode_ordinary
        for b in batches:
            sizes = [len(encode(t)) if t and not t.isspace() else 0 for t in (x.as_py() for x in b.column(1))]
            rows = pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"])
            yield rows.filter(pa.compute.greater(rows.column(1), 0))

    import pyarrow.compute  # noqa: F401

    return docs.select(doc_id, text).mapInArrow(count, f"doc_id {kind}, n_tokens bigint")


def fill(lengths: list[int], capacity: int) -> list[int]:
    """The container of each item, numbered from 0. Available lengths are kept as bits of one integer."""
    by: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        by.setdefault(lengths[i], []).append(i)
    free = rev = 0
    for n in by:
        free |= 1 << n
        rev |= 1 << (capacity - n)

    def take(n: int) -> int:
        nonlocal free, rev
        i = by[n].pop()
        if not by[n]:
            free &= ~(1 << n)
            rev &= ~(1 << (capacity - n))
        return i

    def give(n: int, i: int) -> None:
        nonlocal free, rev
        by[n].append(i)
        free |= 1 << n
        rev |= 1 << (capacity - n)

    place, k = [0] * len(lengths), 0
    while free:
        gap, content = capacity, []
        while fits := free & ((1 << (gap + 1)) - 1):
            n = fits.bit_length() - 1
            content.append((n, take(n)))
            gap -= n
        if gap and free:
            small, item = content[-1]
            wide = gap + small
            for total in range(min(wide, capacity), small, -1):
                pairs = free & (rev >> (capacity - total))
                pairs &= (1 << (total // 2 + 1)) - 1  # the shorter of the two
                if total % 2 == 0 and pairs >> (total // 2) & 1 and len(by[total // 2]) < 2:
                    pairs &= ~(1 << (total // 2))
                pairs &= ~1
                if pairs:
                    a = pairs.bit_length() - 1
                    content[-1:] = [(a, take(a)), (total - a, take(total - a))]
                    give(small, item)
                    break
        for _, i in content:
            place[i] = k
        k += 1
    return place


def pack(sizes: DataFrame, capacity: int = 2048, group: int = 50_000) -> DataFrame:
    """(doc_id, piece, first_token, n_tokens, container) from (doc_id, n_tokens).

    Containers of several items have even numbers, full pieces of long documents odd ones.
    """
    kind = sizes.schema["doc_id"].dataType.simpleString()
    sizes = written(sizes, "sizes").where("n_tokens > 0")
    full, size = F.floor(F.col("n_tokens") / capacity), F.lit(capacity).cast("bigint")
    rest = sizes.select("doc_id", full.alias("piece"), (full * capacity).alias("first_token"), (F.col("n_tokens") - full * capacity).alias("n_tokens")).where("n_tokens > 0")
    groups = max(1, -(-rest.count() // group))

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece"], kind="stable").reset_index(drop=True)
        local = pd.Series(fill(rows["n_tokens"].tolist(), capacity), index=rows.index, dtype="int64")
        return rows.assign(container=2 * (local * groups + int(key[0])))[["doc_id", "piece", "first_token", "n_tokens", "container"]]

    dealt = rest.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    several = dealt.groupBy("g").applyInPandas(packed, f"doc_id {kind}, piece bigint, first_token bigint, n_tokens bigint, container bigint")
    # full pieces are containers already, and never meet in a group
    w = Window.partitionBy("g").orderBy("doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    long = sizes.where(full > 0).withColumn("full", full).withColumn("g", F.pmod(F.xxhash64("doc_id"), F.lit(groups)))
    long = long.withColumn("before", F.coalesce(F.sum("full").over(w), F.lit(0)))
    pieces = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1),
        lambda p: F.struct(p.alias("piece"), (p * capacity).alias("first_token"), size.alias("n_tokens"), (2 * ((F.col("before") + p) * groups + F.col("g")) + 1).alias("container")),
    )
    return several.unionByName(long.select("doc_id", F.explode(pieces).alias("x")).select("doc_id", "x.*"))
