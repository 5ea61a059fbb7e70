import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from parlance.llm import leaks, packing, residue
from parlance.runtime import written

ITEM = "The lamplighter borrowed a frozen pulley when the shops had closed. If the orchard stays quiet, Glawen will want a second cellar beside the depot. Ask Ospen about the ferry and you get fifty minutes on the curtain instead."
HAN = "昨晚的车站口只卖车票价钱是八颗纽扣屿樱先生和你为风筝吵过五十七回最后都去车站口看雨然后拍下榕澜说话碎一句拆成四句句尾爱带嘛"
NOISE = "Nothing of the sort was ever told in this place, and so the evening went by without a word from anyone at all."


def found(texts, items=((1, ITEM), (2, HAN))):
    return [(i, it) for i, it, *_ in leaks.Detector(items).scan(texts)]


def test_leaks():
    words = ITEM.split()
    half = " ".join(words[:24])
    swapped = " ".join("blue" if k % 8 == 5 else w for k, w in enumerate(words))
    cut = "\n".join(f"Ann: {' '.join(words[k : k + 9])}\n[19:55] Bob: mm yes" for k in range(0, len(words), 9))
    texts = [ITEM, ITEM.upper().replace(" ", "  \n"), half + NOISE, swapped, cut, " ".join(words[:8]) + " " + NOISE, NOISE, None, "", " \n", "".join(c if k % 9 else "口" for k, c in enumerate(HAN)), HAN[:36], HAN[:13], NOISE * 3000 + ITEM, "ｔｈｅ" + ITEM[3:].replace("o", "о"), " ".join(reversed(words))]
    assert found(texts) == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (10, 2), (11, 2), (13, 1), (14, 1)] or set(found(texts)) == {(0, 1), (1, 1), (2, 1), (3, 1), (4, 1), (10, 2), (11, 2), (13, 1), (14, 1)}
    assert found(texts, ()) == [] and found([]) == []
    assert found(["say abc now", "nothing"], [(7, "ABC")]) == [(0, 7)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=5, max_size=5), min_size=1, max_size=6), st.text("abc", max_size=3000))
def test_search_equals_brute_force(pats, text):
    p = leaks.Patterns([(np.array([ord(c) for c in x], np.uint32), 0, k) for k, x in enumerate(pats)], 5, 3, bits=8)
    t = np.array([ord(c) for c in text], np.uint32)
    starts, which = p.search(t)
    got = sorted((int(s), "".join(map(chr, p.codes[k]))) for s, k in zip(starts, which))
    assert got == sorted((i, x) for x in set(pats) for i in range(len(text) - 4) if text[i : i + 5] == x)


def test_leaks_in_spark(spark):
    df = spark.createDataFrame([(1, ITEM, 9), (2, None, 9), (3, NOISE, 9), (None, ITEM, 9), (1, ITEM, 9)], "doc_id long, text string, item_id long")
    got = sorted((r.doc_id or 0, r.item_id) for r in leaks.leaked(df, "doc_id", "text", [(5, ITEM)]).collect())
    assert got == [(0, 5), (1, 5), (1, 5)]
    assert leaks.leaked(df.limit(0), "doc_id", "text", [(5, ITEM)]).count() == 0
    more = leaks.leaked(df, "doc_id", "text", [(5, ITEM), (6, HAN), (7, ITEM)], most=100)
    assert sorted((r.doc_id or 0, r.item_id) for r in more.collect()) == [(0, 5), (0, 7), (1, 5), (1, 5), (1, 7), (1, 7)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_fill_never_overflows(lengths):
    place = packing.fill(lengths, 40)
    sums = {}
    for n, b in zip(lengths, place):
        sums[b] = sums.get(b, 0) + n
    assert all(v <= 40 for v in sums.values()) and sorted(sums) == list(range(len(sums)))
    # no two containers could be one
    assert len(sums) <= max(1, -(-2 * sum(lengths) // 40)) + 1 or not lengths


def test_fill_is_tight():
    rnd = random.Random(5)
    lengths = [min(2048, max(1, int(rnd.lognormvariate(5.5, 1)))) for _ in range(5000)]
    place = packing.fill(lengths, 2048)
    assert max(place) + 1 <= sum(lengths) / 2048 * 1.005 + 1
    assert packing.fill([6, 5, 3, 2], 10) == [1, 0, 0, 0] or max(packing.fill([6, 5, 3, 2], 10)) == 1


def test_pack(spark):
    df = spark.createDataFrame([(i, "word " * (i % 50 + 1), 1) for i in range(300)] + [(900, None, 1), (901, " \n ", 1), (902, "long words " * 400, 1)], "doc_id long, text string, container long")
    sizes = packing.token_counts(df, "doc_id", "text")
    got = packing.pack(sizes, capacity=128, group=100).collect()
    by, docs = {}, {}
    for r in got:
        by[r.container] = by.get(r.container, 0) + r.n_tokens
        docs.setdefault(r.doc_id, []).append((r.piece, r.first_token, r.n_tokens))
    assert max(by.values()) <= 128 and set(docs) == {*range(300), 902}
    want = {r.doc_id: r.n_tokens for r in sizes.collect()}
    for d, ps in docs.items():
        ps.sort()
        assert sum(n for *_, n in ps) == want[d] and [f for _, f, _ in ps] == [k * 128 for k in range(len(ps))]
        assert len(ps) == 1 or want[d] > 128
    assert len(by) <= sum(want.values()) / 128 * 1.1 + 3
    assert packing.pack(packing.token_counts(df.limit(0), "doc_id", "text")).count() == 0


RESIDUE = [
    "Hi {{ first_name }}, welcome", "a\n{% date %}", "x ${city} y", "<%= name %>", "[[mood]]", "<<company>>", "<LAST_NAME>", "__SEASON__", "[INSERT CITY HERE]", "[your city here]", "[tu author aquí]", "<!-- name goes here -->",
    "mood: TBD", "TODO: write the name", "【待填写：作息】", "（此处填写姓名）", "关系：XXXX", "[关系]待补充", "请在这里输入称呼", "undefined undefined", "null city: NaN", "%(scene)s", "@@mood@@", "{0} and {1}", "#{company}",
    "Lorem ipsum dolor sit amet velorum pellam", "占位内容占位内容占位内容占位内容占位内容占位内容", "sample text sample text sample text sample text", "测试测试测试测试测试测试测试测试测试测试",
    "404 Not Found", "HTTP 502 Bad Gateway", "Error 403. El contenido fue retirado.", "Traceback (most recent call last):", "KeyError: 'city'", "页面走丢了", "服务器开小差了. 请先登录后查看完整内容", "Your session has timed out, sign in again.",
    "Please enable JavaScript to view this.", "This archive does not work without client-side scripts.", "请启用浏览器脚本再刷新页面", "Activa JavaScript para continuar.", "Necesitas habilitar las secuencias de comandos para continuar.",
]
CONTENT = [
    "{{user}}: hi\n{{char}}: {\\an8}hello [微笑] <i>x</i>", "登录大厅在二楼，别走错", "the word lorem looks like a fish to me", "错误的路走多了也就认识路了", "lol the old page gave me a 404 again, so I read the paper copy",
    "my cousin keeps asking what javascript is and whether it has coffee", "他说他在学脚本，是话剧的脚本", "we got an error at the ticket desk, then it was fine", "todo list for tonight: soup, rope, two lamps",
    "ayer la página no abría, así que llamé por teléfono", "por error subí al tranvía verde", "哈哈哈哈哈哈哈哈哈哈哈哈", "ha ha ha ha ha ha ha ha ha", "put the macro {{char}} where the character speaks and {{user}} where you do", "description: x\n1\n00:00:01,000 --> 00:00:02,000", "", " ", None,
    "待办：买灯泡、还雨伞", "me falta completar la colección de sellos", "el guion pide que {{user}} entre primero", "---------------------------", "我叫祁听澜 13812345678",
]


def test_residue_rules_and_labels(spark):
    notice = "Please be so kind and switch on the scripts of your browser so that all pages of this great old archive can be shown to you here"
    near = "Kindly " + notice[7:].replace("switch on the scripts of", "make up the settings of", 1)
    filler = ["Lorem ipsum dolor sit amet pellam velorum umbrael nocturis praesto fenolis."] * 4
    rows = [(i, t) for i, t in enumerate(RESIDUE)] + [(1000 + i, t) for i, t in enumerate(CONTENT)]
    rows += [(2000, notice.replace("switch on", "turn on")), (2001, "Hear. Hear. " + notice.replace("switch on", "turn on")[7:]), (2002, near)]
    rows += [(3000 + i, t) for i, t in enumerate(filler)] + [(3100, "Umbrael nocturis velorum praesto fenolis pellam velorum praesto.")]
    df = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, by_rule boolean")
    got = {r.doc_id: r.by_rule for r in residue.residue(df, "doc_id", "text").collect()}
    assert set(range(len(RESIDUE))) <= set(got), [RESIDUE[i] for i in range(len(RESIDUE)) if i not in got]
    assert not [CONTENT[i - 1000] for i in got if 1000 <= i < 2000]
    assert got[2000] is True and 2001 in got and 2002 not in got
    assert got[3100] is False
    assert residue.residue(df.limit(0), "doc_id", "text").count() == 0


def test_near_duplicates_carry_labels(spark):
    """A message the rules know, and copies with a word more, a word less, and so on along a chain."""
    base = "this quiet old archive of letters and songs from the harbour does not work without JavaScript and so please enable it and then load the whole page once again with patience".split()
    drop = [w for w in base if w not in ("JavaScript",)]
    hop1 = " ".join("enabled" if w == "enable" else w for w in base[:-1])  # still a rule's words
    hop2 = " ".join(base[5:]).replace("JavaScript", "JavaScript")
    df = spark.createDataFrame([(1, " ".join(base)), (2, hop1), (3, hop2), (4, " ".join(drop[:8]))], "doc_id long, text string")
    got = {r.doc_id for r in residue.residue(df, "doc_id", "text").collect()}
    assert {1, 2, 3} <= got and 4 not in got


def test_links_are_exact(spark):
    """All pairs of the similarity are found, however many bits differ."""
    sh = residue.Shingler()
    rnd = random.Random(2)
    words = [f"w{chr(97 + k)}{chr(97 + j)}" for k in range(20) for j in range(20)]
    base = [rnd.sample(words, 40) for _ in range(6)]
    texts = [" ".join(b) for b in base] + [" ".join(b[k:]) for b in base for k in (1, 2, 3)] + [" ".join(b[:20] + b[22:]) for b in base]
    for n in (2, 3, 4, 8, 9, 13, 14, 24, 60):  # short ones, where a word more is near the least similarity
        b = rnd.sample(words, n + 6)
        texts += [" ".join(b[:n]), " ".join(b[: n + 1]), " ".join(b[: n - 1] + b[n : n + 1]), " ".join(b[: n + 3]), " ".join(b[1:n])]
    nodes = []
    for t in dict.fromkeys(texts):
        h, _, _ = sh.words(t)
        s, *_ = sh.shingles(h, np.zeros(len(h), np.int64))
        nodes.append(residue._node(h, s))
    want = set()
    for a in nodes:
        for b in nodes:
            x, y = set(a[2]), set(b[2])
            if a[0] != b[0] and len(x & y) >= residue.SIMILAR * len(x | y):
                want.add((a[0], b[0]))
    df = spark.createDataFrame(nodes, residue.NODE)
    for hot in (residue.HOT, 1):  # with crowded places split as well
        assert {(r.a, r.b) for r in residue.links(df, hot=hot).collect()} == want and want


def test_passages_repeated_in_a_row_are_filler(spark):
    long = "Replace this whole dummy sentence with the real one soon please now. "
    texts = [long * 8, "a\n" + "esta frase entera espera a su contenido\n" * 4, "昨晚的车站口只卖车票价钱是八颗纽扣呀。" * 5, long * 3, "ha ha!\n" * 9, "-----\n" * 9, long + "x. " + long * 2]
    assert [residue.repeated_passage(t) is not None for t in texts] == [True, True, True, False, False, False, False]
    assert {0, 1, 2} <= residue.suspects(texts) and not {3, 6} & residue.suspects(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in residue.residue(df, "doc_id", "text").collect()} == {0, 1, 2}


def test_talk_about_pages_is_none_and_other_messages_are():
    told = lambda t: bool(residue.residue_in(t, residue._anchors()))
    for t in ("His javascript course needs a new teacher", "The 404 Not Found joke was old", "the site can be reached by bus", "she works in maintenance"):
        assert not told(t), t
    for t in ("This site can't be reached", "Page cannot be displayed", "ERR_CONNECTION_REFUSED", "Our systems are undergoing maintenance", "This site needs JavaScript", "404 Not Found", "well 404 Not Found"):
        assert told(t), t


def test_withheld_labels_come_back(spark):
    """The labels of every fourth document withheld: what share of its residue the near-duplicates tell again, and
    how much else they tell. Placeholders are no matter of near-duplicates."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = written(residue.trusted(docs, "doc_id", "text"), "marks")
    rows = {}
    for r in marks.select("doc_id", "kind").collect():
        rows.setdefault(r.doc_id, set()).add(r.kind)
    held = {i for i, kinds in rows.items() if i % 4 == 0 and kinds & {"notice", "error", "filler"}}
    got = {r.doc_id for r in residue.propagated(docs, "doc_id", "text", marks.where("doc_id % 4 != 0")).distinct().collect()}
    assert len(got & held) >= 0.75 * len(held) and len(got & set(rows)) >= 0.98 * len(got), (len(got & held), len(held), len(got & set(rows)), len(got))


def test_map_follows_the_number_of_shingles(spark):
    nodes = spark.range(600_000).selectExpr("array(xxhash64(id)) AS shingles")
    flat = residue.shingle_map(nodes)
    assert len(flat) * 64 == 1 << 24 and np.unpackbits(flat.view(np.uint8)).sum() > 580_000
