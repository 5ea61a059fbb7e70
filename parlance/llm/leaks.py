"""Evaluation passages inside a corpus: which documents hold at least half of which test item.

Method: Wu-Manber multi-pattern search over folded text (letters and digits only, case, accents, character
forms and blanks folded away). The patterns are windows of the items that begin at each word (each character
in scripts without blanks). A table of block shifts lets the search skip positions no pattern can end at,
suffix-hash buckets select patterns, and a direct comparison confirms each occurrence. Where the confirmed
windows of one item cover enough of it, the words around them are aligned with the words of the item: equal
words gain, swapped ones and insertions cost, an interruption costs the same whatever its length. The words
found, and swapped ones up to one in eight of what is held, decide by their share of the item.

The corpus is read once, without any shuffle: the items (a fixed set of held-out texts) go to every task.
Documents are searched many at a time, and alignments are computed side by side, so no loop runs over
characters.

Defined results: null, empty and blank texts hold nothing, nor does an empty set of items; items too short
for a window are searched as one whole pattern; repeated documents each give their rows, as do items of equal
texts; texts are read whole, whatever their length.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from parlance.llm.charforms import LOOKALIKES

SPACE = 0x20000
#: code points one task folds at a time
CHUNK = 2_000_000


@functools.cache
def _fold_table() -> tuple[np.ndarray, dict[int, list[int]]]:
    """Folded code point of each (0: dropped), and those that fold to several."""
    table, several = np.zeros(SPACE, np.uint32), {}
    for cp in range(SPACE):
        ch = chr(cp)
        cat = unicodedata.category(ch)
        if cat[0] not in "LNS" or 0x4E00 <= cp <= 0x9FFF or 0x3400 <= cp <= 0x4DBF or 0xAC00 <= cp <= 0xD7A3:
            table[cp] = cp if cat[0] in "LN" else 0
            continue
        ch = unicodedata.normalize("NFKC", ch)
        ch = "".join(LOOKALIKES.get(c, c) for c in ch).casefold()
        cs = [ord(c) for c in unicodedata.normalize("NFD", ch) if unicodedata.category(c)[0] in "LN"]
        if len(cs) > 1:
            several[cp] = cs
        table[cp] = cs[0] if cs else 0
    return table, several


#: stands between documents in folded text; no pattern holds it
END = 1


@functools.cache
def _classes() -> tuple[np.ndarray, ...]:
    """By code point: the fold (0: dropped), whether it parts words, whether it is a word by itself, how many code
    points it folds to, and those of the ones that fold to several (by number of the row)."""
    table, several = _fold_table()
    parts = table == 0
    for cp in np.flatnonzero(parts).tolist():
        if unicodedata.category(chr(cp)) in ("Mn", "Me", "Mc", "Cf"):
            parts[cp] = False
    alone = np.zeros(SPACE, bool)
    alone[0x3400:0xA000] = True
    size = np.ones(SPACE, np.int8)
    wide = np.zeros((len(several) + 1, max(map(len, several.values()))), np.uint32)
    row = np.zeros(SPACE, np.int64)
    for k, (cp, cs) in enumerate(several.items(), 1):
        size[cp], row[cp] = len(cs), k
        wide[k, : len(cs)] = cs
    return table, parts, alone, size, row, wide


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Folded:
    """Many texts as one array of folded code points, END behind each, cut into units: words, and single
    characters of scripts without blanks. Ignorable characters and accents part no words."""

    MUL = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)

    def __init__(self, texts: Sequence[str]):
        table, parts, alone, size, row, wide = _classes()
        cps = np.frombuffer("".join(f"{t.replace(chr(0), ' ') if chr(0) in t else t}\0" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        low = np.minimum(cps, SPACE - 1)
        n = size[low]
        if (n > 1).any():
            place = np.repeat(np.arange(len(cps)), n)
            nth = np.arange(len(place)) - np.repeat(np.cumsum(n, dtype=np.int64) - n, n)
            cps, low = cps[place], low[place]
            folded = np.where(row[low] > 0, wide[row[low], nth], table[low])
        else:
            folded = table[low]
        high = cps >= SPACE
        if high.any():
            folded = np.where(high & (cps < 0xE0000), cps, folded)
        single = alone[low] | high
        ends = cps == 0
        folded = np.where(ends, END, folded)
        keep = np.flatnonzero(folded)
        gaps = np.cumsum(parts[low])[keep]
        self.codes = folded[keep]
        single = single[keep] | ends[keep]
        start = np.diff(gaps, prepend=-1) != 0
        start |= single
        start[1:] |= single[:-1]
        self.ends = np.flatnonzero(self.codes == END)
        self.starts = np.flatnonzero(start)
        #: number of the unit of each code point
        self.unit = np.cumsum(start) - 1
        offset = np.arange(len(keep)) - self.starts[self.unit]
        self.words = mix(np.add.reduceat(self.codes.astype(np.uint64) * self.MUL[offset & 63], self.starts)) if len(self.starts) else np.empty(0, np.uint64)


class Patterns:
    """One set of patterns of equal length ``m`` with the tables of the search over blocks of ``b``."""

    def __init__(self, windows: Sequence[tuple[np.ndarray, int, int]], m: int, b: int, bits: int = 20):
        """``windows``: (code points, item, position in the item)."""
        self.m, self.b, self.bits = m, b, bits
        rng = np.random.default_rng(7)
        self.block_mul = rng.integers(1, 2**63, b, dtype=np.uint64) | np.uint64(1)
        self.mul = rng.integers(1, 2**63, m, dtype=np.uint64) | np.uint64(1)
        self.shift = np.full(1 << bits, m - b + 1, np.int32)
        codes = np.array([w[0] for w in windows], np.uint32).reshape(-1, m)
        for k in range(m - b + 1):  # the block that ends at offset k + b - 1 lets the window's end lie m - b - k ahead
            np.minimum.at(self.shift, self.block(codes[:, k : k + b].astype(np.uint64)), m - b - k)
        h = (codes.astype(np.uint64) * self.mul).sum(1)
        self.hashes, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        self.codes = codes[first]
        order = np.argsort(inverse, kind="stable")
        self.starts = np.searchsorted(inverse[order], np.arange(len(self.hashes) + 1))
        self.item = np.array([w[1] for w in windows], np.int64)[order]
        self.pos = np.array([w[2] for w in windows], np.int64)[order]

    def block(self, cols: np.ndarray) -> np.ndarray:
        return ((cols * self.block_mul).sum(-1) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ends(self, text: np.ndarray, lane: int = 1024) -> np.ndarray:
        """Places where a block that ends some pattern ends; many lanes of the text advance together."""
        n = len(text)
        if n < self.m:
            return np.empty(0, np.int64)
        wide = text.astype(np.uint64)
        at = np.arange(self.m - 1, n, lane, dtype=np.int64)
        stop = np.minimum(at + lane, n)
        found = []
        while len(at):
            h = wide[at - (self.b - 1)] * self.block_mul[0]
            for k in range(1, self.b):
                h += wide[at - (self.b - 1 - k)] * self.block_mul[k]
            step = self.shift[(h >> np.uint64(64 - self.bits)).astype(np.int64)]
            zero = step == 0
            if zero.any():
                found.append(at[zero])
            at = at + np.maximum(step, 1)
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
        return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)

    def search(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start in the text, pattern) of every occurrence."""
        ends = self.ends(text)
        starts, pats = [], []
        for part in np.array_split(ends, len(ends) // 200_000 + 1):
            s = part - (self.m - 1)
            cols = text[s[:, None] + np.arange(self.m)]
            h = (cols.astype(np.uint64) * self.mul).sum(1)
            k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            ok = self.hashes[k] == h
            ok[ok] = (self.codes[k[ok]] == cols[ok]).all(1)
            starts.append(s[ok])
            pats.append(k[ok])
        return np.concatenate(starts), np.concatenate(pats)


#: costs in units (words; characters of scripts without blanks), as eighths: of a unit of the item swapped or passed
#: over, of a unit put into the passage, and of an interruption, whatever its length
SWAP, INSERT, JUMP = (16, 16), (3, 2), (32, 48)
#: units swapped for each unit found that count as held: one in eight of both
SWAPPED = 1 / 7
#: least share of an item held: half, less what stretches too short to be seen at the edges of interruptions may take
SHARE = 0.39
#: share of an item that its own windows must cover before text and item are aligned (what items share are turns of
#: phrase), and all its windows
OWN, SEEN = 0.07, 0.12
#: share of an item its own windows cover
OWNED = 0.5
#: score of an alignment, of what the whole item would have, from which units are counted, and that it must have. Half an
#: item with one in eight swapped and a name before each ten words has 0.29; the rest is for edges and interruptions.
#: Scattered turns of phrase cost more than they gain.
WORTH, NET = 0.15, 0.23
#: units on either side of a window of the item's own that are aligned
AROUND = 24, 40
#: alignments done at once
LANES = 128

#: parts of a cell's value that hold the score and the units found; the rest are the units swapped
_SCORE, _FOUND = 1 << 32, 1 << 16


def _lanes(texts: Sequence[np.ndarray], items: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts and items of many pairs side by side, one pair a column: units of both, and weights."""
    many, wide, long = len(texts), max(len(h) for h, _ in items), max(map(len, texts))
    text, item, weight = np.zeros((long, many), np.uint64), np.ones((wide, many), np.uint64), np.zeros((wide, many), np.int64)
    for k, (t, (h, w)) in enumerate(zip(texts, items)):
        text[: len(t), k] = t
        item[: len(h), k] = h
        weight[: len(h), k] = w
    return text, item, weight


def _best(text: np.ndarray, item: np.ndarray, gain: np.ndarray, lose: np.ndarray, insert: int, jump: int, kind: type, skips: bool) -> np.ndarray:
    """The best value of a local alignment that may go on anywhere after an interruption; one pair a column."""
    wide, many = item.shape
    passed = np.concatenate([np.zeros((1, many), kind), np.cumsum(lose, 0, dtype=kind)])
    cell, best = np.zeros((wide + 1, many), kind), np.zeros((wide + 1, many), kind)
    new, begin, other = np.empty_like(cell), np.empty_like(cell), np.empty((wide, many), kind)
    for row in text:
        np.maximum(best, cell, out=best)
        np.subtract(best, kind(jump), out=begin)
        np.maximum(begin, cell, out=begin)
        np.subtract(cell, kind(insert), out=new)
        np.maximum(new, kind(0), out=new)
        np.add(cell[:-1], lose, out=other)
        np.add(begin[:-1], gain, out=other, where=item == row)
        np.maximum(new[1:], other, out=new[1:])
        if skips:  # units of the item without any in the text
            new -= passed
            np.maximum.accumulate(new, axis=0, out=new)
            new += passed
        cell, new = new, cell
    return np.maximum(best, cell).max(0)


def scores(texts: Sequence[np.ndarray], items: Sequence[tuple[np.ndarray, np.ndarray]], han: bool) -> np.ndarray:
    """Score of each pair's alignment as a share of the whole item's, at least; cheaper than ``align``. ``texts``:
    hashes of units; ``items``: hashes of units, and how much each counts."""
    text, item, weight = _lanes(texts, items)
    kind = np.int16 if 8 * int(weight.sum(0).max()) * 4 < 32_000 else np.int32
    weights = weight.astype(kind)
    top = _best(text.astype(np.uint32), item.astype(np.uint32), 8 * weights, -SWAP[han] * weights, INSERT[han], JUMP[han], kind, False)
    return top / np.maximum(8 * weight.sum(0), 1)


def align(texts: Sequence[np.ndarray], items: Sequence[tuple[np.ndarray, np.ndarray]], han: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best alignment of each item with its text: its score as a share of the whole item's, units found and units
    swapped. A cell holds these three as one integer, so that the best is the greatest."""
    text, item, weight = _lanes(texts, items)
    top = _best(text, item, weight * (8 * _SCORE + _FOUND), weight * (1 - SWAP[han] * _SCORE), INSERT[han] * _SCORE, JUMP[han] * _SCORE, np.int64, True)
    return top // _SCORE / np.maximum(8 * weight.sum(0), 1), (top % _SCORE) // _FOUND, top % _FOUND


class Detector:
    """``items``: (item_id, text)."""

    def __init__(self, items: Sequence[tuple[int, str]], window: int = 18, block: int = 6, han_window: int = 6, han_block: int = 4, share: float = SHARE):
        self.share = share
        self.ids, self.sizes, self.han, self.units = [], [], [], []
        sets: dict[tuple[int, int], list] = {}
        for item, text in items:
            f = Folded([text or ""])
            codes, starts = f.codes[:-1], f.starts[:-1]
            if not len(codes):
                continue
            han = bool(((codes >= 0x3400) & (codes <= 0x9FFF)).mean() > 0.5)
            weights = np.diff(f.starts) if han else np.ones(len(starts), np.int64)
            m, b = (han_window, han_block) if han else (window, block)
            if len(codes) < m:
                m, b, starts = len(codes), min(b, len(codes)), np.array([0])
            k = len(self.ids)
            self.ids.append(item)
            self.sizes.append(len(codes))
            self.han.append(han)
            self.units.append((f.words[:-1], weights))
            sets.setdefault((m, b), []).extend((codes[s : s + m], k, int(s)) for s in starts if s + m <= len(codes))
        self.sets = [Patterns(ws, m, b) for (m, b), ws in sets.items()]
        self.sizes = np.array(self.sizes)
        #: by place in the patterns: windows of the items that are their own
        self.own = [self._rare(p) for p in self.sets]

    def _rare(self, p: Patterns) -> np.ndarray:
        """The windows of each item that stand in the fewest others, as many as cover OWNED of it: where items differ,
        those in no other item."""
        shared = np.repeat(np.diff(p.starts), np.diff(p.starts))
        rare = np.zeros(len(p.item), bool)
        for it in np.unique(p.item):
            rows = np.flatnonzero(p.item == it)
            rows = rows[np.argsort(p.pos[rows], kind="stable")]
            for most in np.unique(shared[rows]):
                some = rows[shared[rows] <= most]
                if np.minimum(np.diff(p.pos[some], append=p.pos[some[-1]] + p.m), p.m).sum() >= OWNED * self.sizes[it]:
                    break
            rare[some] = True
        return rare

    def scan(self, texts: Sequence[str | None]) -> list[tuple[int, int, float, float]]:
        """(text, item_id, share found, share held) over a batch of texts."""
        out: list[tuple[int, int, float, float]] = []
        chunk: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            if t:
                chunk.append(i)
                size += len(t)
            if size > CHUNK:
                out += self._scan(chunk, texts)
                chunk, size = [], 0
        return out + (self._scan(chunk, texts) if chunk else [])

    def _scan(self, chunk: list[int], texts: Sequence[str | None]) -> list[tuple[int, int, float, float]]:
        f = Folded([texts[i] for i in chunk])
        pairs = []  # (document, item, units of the text to align)
        for p, own in zip(self.sets, self.own):
            place, pat = p.search(f.codes)
            doc = np.searchsorted(f.ends, place)
            some = np.flatnonzero(np.logical_or.reduceat(own, p.starts[:-1])[pat])
            rows, each = self._windows(p, pat[some])
            at, key = place[some[rows]], doc[some[rows]] * len(self.ids) + p.item[each]
            rare = own[each]
            keys = self._covered(key[rare], p.pos[each[rare]], p.m, OWN)
            some = np.flatnonzero(np.isin(doc, keys // len(self.ids)))
            every, all_ = self._windows(p, pat[some])
            whole = doc[some[every]] * len(self.ids) + p.item[all_]
            rows = np.flatnonzero(np.isin(whole, keys))
            keys = self._covered(whole[rows], p.pos[all_[rows]], p.m, SEEN)
            rows = np.flatnonzero(rare & np.isin(key, keys))
            rows = rows[np.lexsort((at[rows], key[rows]))]
            for group in np.split(rows, np.flatnonzero(np.diff(key[rows])) + 1) if len(rows) else []:
                k, it = divmod(int(key[group[0]]), len(self.ids))
                first, last = f.unit[f.ends[k - 1]] + 1 if k else 0, f.unit[f.ends[k]]
                units = f.unit[at[group]]
                lo, hi = np.maximum(units - AROUND[self.han[it]], first), np.minimum(units + AROUND[self.han[it]], last)
                new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
                stop = np.maximum.reduceat(hi, new)
                pairs.append((k, it, np.concatenate([f.words[a:b] for a, b in zip(lo[new], stop)])))
        return self._held(chunk, pairs)

    @staticmethod
    def _windows(p: Patterns, pat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``pat``, place in the windows) of all windows that have the patterns."""
        n = p.starts[pat + 1] - p.starts[pat]
        return np.repeat(np.arange(len(pat)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(p.starts[pat], n)

    def _covered(self, key: np.ndarray, pos: np.ndarray, m: int, share: float) -> np.ndarray:
        """The keys (document, item) whose windows of ``m`` at ``pos`` cover the share of the item together."""
        if not len(key):
            return key
        order = np.lexsort((pos, key))
        k, q = key[order], pos[order]
        edges = np.flatnonzero(np.diff(k, prepend=-1))
        step = np.diff(q, prepend=0)
        step[edges] = m
        k = k[edges]
        return k[np.add.reduceat(np.minimum(step, m), edges) >= share * self.sizes[k % len(self.ids)]]

    def _held(self, chunk: list[int], pairs: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int, float, float]]:
        out = []
        for han in (False, True):
            some = sorted((x for x in pairs if self.han[x[1]] == han), key=lambda x: len(x[2]))
            worth: list[tuple[int, int, np.ndarray]] = []
            for a in range(0, len(some), LANES):
                part = some[a : a + LANES]
                good = scores([t for *_, t in part], [self.units[it] for _, it, _ in part], han) >= WORTH
                worth += [x for x, ok in zip(part, good) if ok]
            for a in range(0, len(worth), LANES):
                part = worth[a : a + LANES]
                counts = align([t for *_, t in part], [self.units[it] for _, it, _ in part], han)
                for (doc, it, _), net, n, lost in zip(part, *(c.tolist() for c in counts)):
                    total = int(self.units[it][1].sum())
                    if (have := n + min(lost, SWAPPED * n)) >= self.share * total and net >= NET:
                        out.append((chunk[doc], self.ids[it], n / total, have / total))
        return out


def leaked(docs: DataFrame, doc_id: str, text: str, items: Sequence[tuple[int, str]], most: int = 5_000_000, **options) -> DataFrame:
    """(doc_id, item_id, share, held) of every document that holds a test item: the share of its words found in
    order, and with swapped ones up to one in eight. What goes to a task is bounded: items of more than ``most``
    characters together are searched in blocks, each with a pass of its own."""
    blocks: list[list[tuple[int, str]]] = [[]]
    size = 0
    for item in items:
        if blocks[-1] and size + len(item[1] or "") > most:
            blocks.append([])
            size = 0
        blocks[-1].append(item)
        size += len(item[1] or "")
    return reduce(DataFrame.unionByName, [_leaked(docs, doc_id, text, Detector(b, **options)) for b in blocks])


def _leaked(docs: DataFrame, doc_id: str, text: str, detector: Detector) -> DataFrame:
    kind = docs.schema[doc_id].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = detector.scan(b.column(1).to_pylist())
            at = pa.array([f[0] for f in found], pa.int64())
            columns = [pa.array([f[k] for f in found], t) for k, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), *columns], ["doc_id", "item_id", "share", "held"])

    return docs.select(doc_id, text).mapInArrow(scan, f"doc_id {kind}, item_id bigint, share double, held double")
