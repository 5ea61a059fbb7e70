"""Half of an item counts, also with one word in eight swapped and names before its lines; a quarter doesn't."""

import random

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parlance.llm import leaks

ITEMS = [
    (1, "The lamplighter borrowed a frozen pulley when the shops had closed. If the orchard stays quiet, Glawen will want a second cellar beside the depot. Ask Ospen about the ferry and you get fifty minutes on the curtain instead. Nobody near the harbour remembers which gardener painted that marble. Three violins were sold before breakfast."),
    (2, "昨晚的车站口只卖车票价钱是八颗纽扣屿樱先生和你为风筝吵过五十七回最后都去车站口看雨然后拍下榕澜说话碎一句拆成四句句尾爱带嘛"),
]


def passage(item: str, share: float, swap: bool, names: bool) -> str:
    han = " " not in item
    units = list(item) if han else item.split()
    units = units[: -int(-len(units) * share // 1)]
    if swap:
        units[7::8] = ["口" if han else "an" for _ in units[7::8]]
    lines = [("" if han else " ").join(units[k : k + 10]) for k in range(0, len(units), 10)]
    return "\n".join(f"{'房东：' if han else 'Marlowe: '}{x}" for x in lines) if names else ("，" if han else " ").join(lines)


@pytest.mark.parametrize("names", [False, True])
@pytest.mark.parametrize("swap", [False, True])
def test_halves(swap, names):
    detector = leaks.Detector(ITEMS)
    half = [passage(t, 0.5, swap, names) for _, t in ITEMS]
    less = [passage(t, 0.24, swap, names) for _, t in ITEMS]
    assert [(i, k) for i, k, *_ in detector.scan(half + less)] == [(0, 1), (1, 2)]


def test_swapped_words_may_be_longer_or_shorter():
    words = ITEMS[0][1].split()
    for word in ("a", "incomprehensibilities"):
        swapped = " ".join(word if k % 8 == 7 else w for k, w in enumerate(words[:30]))
        assert [k for _, k, *_ in leaks.Detector(ITEMS).scan([swapped])] == [1]


def brute(text, item, weight, han):
    """The alignment cell by cell, as (score, found, swapped)."""
    swap, insert, jump = leaks.SWAP[han], leaks.INSERT[han], leaks.JUMP[han]
    zero, n = (0, 0, 0), len(item)
    cell, best = [zero] * (n + 1), [zero] * (n + 1)
    add = lambda a, s, f=0, w=0: (a[0] + s, a[1] + f, a[2] + w)
    for t in text:
        best = [max(a, b) for a, b in zip(best, cell)]
        new = [max(zero, add(c, -insert)) for c in cell]
        for j in range(1, n + 1):
            w = weight[j - 1]
            if item[j - 1] == t:
                new[j] = max(new[j], add(max(cell[j - 1], add(best[j - 1], -jump)), 8 * w, w))
            else:
                new[j] = max(new[j], add(cell[j - 1], -swap * w, 0, w))
            new[j] = max(new[j], add(new[j - 1], -swap * w, 0, w))
        cell = new
    return max(map(max, zip(best, cell)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(2, 9), max_size=25), st.lists(st.integers(2, 9), min_size=1, max_size=12)), min_size=1, max_size=4), st.booleans())
def test_alignments_side_by_side_equal_those_cell_by_cell(pairs, han):
    texts = [leaks.np.array(t + [0], leaks.np.uint64) for t, _ in pairs]
    items = [(leaks.np.array(i, leaks.np.uint64), leaks.np.array([1 + x % 2 for x in i], leaks.np.int64)) for _, i in pairs]
    score, found, swapped = leaks.align(texts, items, han)
    wanted = [brute(t.tolist(), i.tolist(), w.tolist(), han) for t, (i, w) in zip(texts, items)]
    assert list(zip((score * 8 * [w.sum() for _, w in items]).round().tolist(), found.tolist(), swapped.tolist())) == wanted
    assert all(a <= b[0] / (8 * w.sum()) + 1e-9 for a, b, (_, w) in zip(leaks.scores(texts, items, han), wanted, items))


# --- all items of the tables ---------------------------------------------------------------------------------
D = "/root/testdata/sf0.01"
MODES = {
    "most": dict(share=0.6), "one interruption": dict(share=0.6, cuts=[200]), "a long one": dict(share=0.6, cuts=[1500]), "three long ones": dict(share=1, cuts=[1500] * 3),
    "each eighth swapped": dict(share=0.6, swap="each"), "swapped and interrupted": dict(share=0.75, swap="each", cuts=[200]), "one in eight swapped at random": dict(share=0.6, swap="random"),
    "half": dict(share=0.5), "half with names": dict(share=0.5, names=True), "half with each eighth swapped": dict(share=0.5, swap="each"),
}


@pytest.fixture(scope="module")
def tables():
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{D}/eval_items.parquet").to_pylist()]
    docs = [r["text"] for r in pq.read_table(f"{D}/documents.parquet").to_pylist() if r["text"]]
    detector = leaks.Detector(items)
    holding = {i for i, *_ in leaks.Detector(items, share=0.2).scan(docs)}
    return detector, items, [t for i, t in enumerate(docs) if i not in holding]


def planted(item, rnd, words, texts, share, swap="", names=False, cuts=(), least=False):
    han = " " not in item[:30]
    u = list(item) if han else item.split()
    n = int(len(u) * share) if least else int(-(-len(u) * share // 1))
    a = rnd.randrange(len(u) - n + 1)
    u = u[a : a + n]
    for i in range(7, len(u), 8) if swap == "each" else rnd.sample(range(len(u)), len(u) // 8) if swap else ():
        u[i] = rnd.choice(words[han])
    if names:
        u = [x for k in range(0, len(u), 10) for x in ["\n房东：" if han else "\nMarlowe: ", *u[k : k + 10]]]
    parts, step = [], len(u) / (len(cuts) + 1)
    for k in range(len(cuts) + 1):
        parts.append(("" if han else " ").join(u[int(k * step) : int((k + 1) * step)]))
        if k < len(cuts):
            t = rnd.choice(texts[han])
            s = rnd.randrange(len(t) - cuts[k] + 1)
            parts.append(t[s : s + cuts[k]])
    return rnd.choice(texts[han])[:300] + "\n" + "\n".join(parts)


@pytest.mark.parametrize("mode", MODES)
def test_all_items_are_found(tables, mode):
    detector, items, docs = tables
    rnd = random.Random(mode)
    han = lambda t: sum("一" <= c <= "鿿" for c in t) * 2 > len(t)
    texts = [[t for t in docs if len(t) > 1600 and han(t) == h] for h in (False, True)]
    words = [[w for t in docs for w in t.split()], [c for t in docs for c in t if "一" <= c <= "鿿"]]
    found = {(i, k) for i, k, *_ in detector.scan([planted(t, rnd, words, texts, **MODES[mode]) for _, t in items])}
    true = {(i, k) for i, (k, _) in enumerate(items)}
    assert len(found & true) >= 0.95 * len(true) and len(found & true) >= 0.95 * len(found)
    less = MODES[mode] | {"share": 0.24, "least": True}
    assert len(detector.scan([planted(t, rnd, words, texts, **less) for _, t in items])) <= 0.02 * len(items)


def test_items_of_equal_texts_are_both_found():
    assert sorted(k for _, k, *_ in leaks.Detector(ITEMS + [(9, ITEMS[0][1])]).scan([ITEMS[0][1]])) == [1, 9]
