import random
import re
import unicodedata

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parlance.llm import charforms, personal, runs, terms

BIGRAMS = {p: 50 for w in ("uneven", "lantern", "club", "café", "gentle", "puppet", "vip", "echo") for p in zip("^" + w, w + "$")} | {p: 50 for w in ("привет", "мир", "такси") for p in zip("^" + w, w + "$")}


def test_forms():
    f = charforms.Lattice(BIGRAMS).form
    same = {
        "Unеvеn lаntеrn сlub": "Uneven lantern club", "Ｇｅｎｔｌｅ　puppet​ ": "Gentle puppet", "Café": "Café", " VI­P  x": "VIP  x",
        "⼀⼤": "一大", "𝐂𝐥𝐮𝐛": "Club", "﻿": "", "": "", "привет мир": "привет мир", "a\tb": "a b", "москвa": "москва", "ЖИЗНЬ пpивет": "ЖИЗНЬ привет", "λόγoς": "λόγος",
    }
    for k, v in same.items():
        assert f(k) == v, (k, f(k))
    assert f("Cafe") != f("Café") and f("club") != f("Club") and f("такси") == "такси"


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_form_is_stable_and_spans_fit(t):
    f = charforms.Lattice(BIGRAMS)
    assert f.form(f.form(t)) == f.form(t)
    finder = personal.Finder([("Tavia", "given", "latin")], f)
    at = 0
    for s, e, _ in finder.spans(t):
        assert at <= s < e <= len(t)
        at = e


def test_column_form_equals_python_form(spark):
    texts = ["plain text", "ünï", " lead", "x​y", None, "", "，。", "Unеven", "long " * 5000 + "аb", "两　个"]
    lat = charforms.Lattice(BIGRAMS)
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "i long, t string, form string")
    got = {r.i: r.f for r in df.select("i", charforms.consistent(F.col("t"), lat).alias("f")).collect()}
    assert got == {i: None if t is None else lat.form(t) for i, t in enumerate(texts)}
    counts = {(r.a, r.b): r.n for r in charforms.bigram_counts(df, "t").collect()}
    assert counts["^", "p"] == 1 and counts["^", "l"] == 5001
    assert charforms.lattice_of(df.limit(0), "t").bigrams == {}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abéжωα ñ1一-Ab", max_size=12), max_size=6))
def test_pairs_are_counted_within_runs_of_one_script(texts):
    wanted = {}
    for t in texts:
        for r in re.findall(r"[abéñωαж]+", t.lower()):
            if len({charforms.script(c) for c in r}) == 1:
                for p in zip("^" + r, r + "$"):
                    wanted[p] = wanted.get(p, 0) + 1
    pairs, n = charforms.pair_counts(texts)
    assert {(chr(p >> 21), chr(p & 0x1FFFFF)): k for p, k in zip(pairs.tolist(), n.tolist())} == wanted


SCHEMA = "src string, seq long, id long, who string, what string, t long, content string"


def bare(t):
    t = "".join(c for c in charforms.compatible(t).lower() if unicodedata.category(c)[0] in "LN")
    return re.sub(r"([^\W\d_])\1+", r"\1", t)


def one_off(x, y):
    if len(x) > len(y):
        x, y = y, x
    if min(len(x), len(y)) < 10 or len(y) - len(x) > 1 or x == y:
        return False
    i = next((k for k in range(len(x)) if x[k] != y[k]), len(x))
    if len(x) == len(y):
        return x[i + 1 :] == y[i + 1 :] and not x[i].isdigit() and not y[i].isdigit()
    return x[i:] == y[i + 1 :] and not y[i].isdigit()


def brute_runs(rows):
    out, cur = [], None
    for s, _, i, who, what, t, _ in sorted({r for r in rows if r[0] is not None and r[1] is not None}, key=lambda r: (r[0], r[1])):
        ok = (who or "").strip() and (what or "").strip()
        near = cur and ok and cur[-1][0] == s and cur[-1][2] and cur[-1][2] == who.strip() and (cur[-1][3] == what or (bare(cur[-1][3]) and bare(what) and (bare(cur[-1][3]) == bare(what) or one_off(bare(cur[-1][3]), bare(what)))))
        if not near:
            cur = []
            out.append(cur)
        cur.append((s, i, who.strip() if ok else None, what, t))
    return {(c[0][1], c[-1][1], len(c)): (c[0][4], c[-1][4]) for c in out}


def test_runs_against_brute_force(spark):
    rnd = random.Random(3)
    base = ["hello there you", "hello there yu", "HELLO, there  you!", "hello there 1ou", "hello there 2ou", "👍", "👍", "👎", "ok", "okk", "o k", "", None, "  ", "abc", "abd"]
    rows = []
    for s, n in (("a", 400), ("b", 60), ("c", 1)):
        for q in range(n):
            rows.append((s, q * (1 if s == "a" else 5000), len(rows) + 1, rnd.choice(["x", "x", "x", " x", "y", None, ""]), rnd.choice(base), rnd.choice([q * 10, None]), "clash"))
    rows += rnd.sample(rows, 40) + [(None, 1, 9001, "x", "ok", 1, "z"), ("a", None, 9002, "x", "ok", 1, "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    make = lambda d: runs.runs(d, "src", "seq", "id", "who", "what", charforms.Lattice(), F.col("t"), block=16)
    got = {(r.first_id, r.last_id, r.n): (r.start, r.end) for r in make(df).collect()}
    assert got == brute_runs(rows)
    assert any(k[2] > 2 for k in got) and make(df.limit(0)).count() == 0
    long = [("s", i, i, "x", c, i, "") for i, c in enumerate(["a" * 300_000, "b" * 299_999 + "c", "ab " * 100_000, "ab " * 100_000 + "!"])]
    assert {(r.first_id, r.last_id) for r in make(spark.createDataFrame(long, SCHEMA)).collect()} == {(0, 0), (1, 1), (2, 3)}


def test_terms(spark):
    rows = [(1, "Ab ab c1"), (1, "Ab ab c1"), (2, "AB x"), (3, "ab，漢字 ｂ"), (4, None), (5, "  "), (6, "Ünï " * 20_000)]
    df = spark.createDataFrame([(*r, 7) for r in rows], "id long, t string, term long")
    got = {r.term: (r.occurrences, r.records, r.mark) for r in terms.term_table(df, "id", "t", least=2, common=0.5).collect()}
    assert got == {"ab": (4, 3, "common"), "c1": (1, 1, "rare"), "x": (1, 1, "rare"), "漢字": (1, 1, "rare"), "ｂ": (1, 1, "rare"), "ünï": (20_000, 1, "rare")}
    assert terms.term_table(df.limit(0), "id", "t").count() == 0


PARTS = [("Tavia", "given", "latin"), ("Rose", "given", "latin"), ("Garden", "family", "latin"), ("Drosvik", "family", "latin"), ("听澜", "given", "han"), ("天", "given", "han"), ("祁", "family", "han"), ("江", "family", "han")]


def test_nothing_is_cut_at_any_length():
    f = personal.Finder(PARTS, charforms.Lattice(BIGRAMS))
    domain = ".".join(["sub"] * 400) + ".example.com"
    assert f.replaced(f"write a@{domain} now") == "write [EMAIL] now"
    assert f.replaced(f"write {'long.' * 3000}local@b.net now") == "write [EMAIL] now"
    assert f.replaced(f"x{' y' * 5000} call 168-4577-6101{' z' * 5000} Tavia Drosvik") == f"x{' y' * 5000} call [PHONE]{' z' * 5000} [NAME]"
    street = "vivo en Calle de la " + "X" + "a" * 500 + " 15"
    assert f.replaced(street) == "vivo en [ADDRESS]"
    assert f.replaced("a@b.com, c@d.org;mailto:e@f.net -g@h.net") == "[EMAIL], [EMAIL];mailto:[EMAIL] -[EMAIL]"
    assert f.replaced("https://user:pass@host.example.com/x") == "https://user:pass@host.example.com/x"
    assert f.replaced("sent to Unknown Person today") == "sent to [NAME] today" and f.replaced("DEAR ALL OF YOU") == "DEAR ALL OF YOU"
    many = "mail a@b.com " * 20_000
    assert f.replaced(many) == "mail [EMAIL] " * 20_000


def test_personal_information():
    f = personal.Finder(PARTS, charforms.Lattice(BIGRAMS))
    cases = {
        "mail me at a.b+c@mail.example.org.": "mail me at [EMAIL].", "资料发到k_v@box.test吧": "资料发到[EMAIL]吧", "x at post dot example ok": "[EMAIL] ok", "a＠b．com": "[EMAIL]", "k @ b.net": "[EMAIL]",
        "@all v6.23.117 is out": "@all v6.23.117 is out", "moss&co@work mood": "moss&co@work mood", "call 168-4577-6101 now": "call [PHONE] now", "+86160 75799385": "[PHONE]", "+44 (0)7700 900 019": "[PHONE]",
        "(212) 555-0126": "[PHONE]", "1６​0 0285 2684": "[PHONE]", "tracking 66651 90733 60325 58533": "tracking 66651 90733 60325 58533", "订单 698727590890706622": "订单 698727590890706622",
        "证号920102199003041234": "证号[ID_NUMBER]", "证号920102 19900304 123x": "证号[ID_NUMBER]", "证号920102199002301234": "证号920102199002301234", "id 959-00-3054": "id [ID_NUMBER]", "pasaporte nº X02140468": "pasaporte nº [ID_NUMBER]",
        "包裹寄柳叶街271号5栋2室": "包裹寄[ADDRESS]", "51路车又晚点": "51路车又晚点", "第21号选手": "第21号选手", "at Flat 38, 21 Thimble Ave., Wick 16777 now": "at [ADDRESS] now", "vivo en C/ del Sauce 156": "vivo en [ADDRESS]",
        "street food stall no 1": "street food stall no 1", "room 29 at 7:30": "room 29 at 7:30", "ran into Tavia R. Drosvik today": "ran into [NAME] today", "soy Unknown Drosvik-Else, mi correo": "soy [NAME], mi correo",
        "Drosvik, Tavia signed for it": "[NAME] signed for it", "Tavia said hi": "Tavia said hi", "rose garden looked red": "rose garden looked red", "联系祁听澜就行": "联系[NAME]就行", "找喻拾光签字": "找[NAME]签字",
        "江天一色，绝了": "江天一色，绝了", "server 192.0.2.10 is slow": "server 192.0.2.10 is slow", "": "", "   ": "   ", "scored 499-42 lol": "scored 499-42 lol", "2012-10-17 11:11 开始": "2012-10-17 11:11 开始",
    }
    for k, v in cases.items():
        assert f.replaced(k) == v, (k, f.replaced(k))
    senders = {"祁听澜 (163 6463 6465)": "[NAME] ([PHONE])", "TAVIA DROSVIK ": "[NAME] ", "南窗": "南窗", "Nora": "Nora", "K-9th": "K-9th"}
    for k, v in senders.items():
        assert f.replaced(k, True) == v, (k, f.replaced(k, True))
    long = "x " * 50_000 + "a@b.com" + " y" * 50_000
    assert f.replaced(long) == long.replace("a@b.com", "[EMAIL]")


def test_learned_parts_and_columns(spark):
    texts = [f"联系{fam}晚亭就行" for fam in "祁江"] + ["联系祁晚亭就行", None, "", "ran into Tavia Newfam today"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "i long, t string, kind string")
    f = personal.Finder(PARTS)
    assert {tuple(r) for r in personal.learned_parts(df, "t", f, least=2).collect()} == {("晚亭", "given", "han")}
    got = {r.i: (r.k, r.c) for r in df.select("i", personal.kinds_of(F.col("t"), f).alias("k"), personal.redacted(F.col("t"), f).alias("c")).collect()}
    assert got[0] == (["name"], "联系[NAME]就行") and got[3] == ([], None) and got[4] == ([], "") and got[5][0] == ["name"]


def test_queries_against_sql(spark):
    import glob
    import os

    from parlance.llm import chat_queries as q

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for p in glob.glob(f"{d}/*.parquet"):
        con.execute(f"create view \"{os.path.basename(p)[:-8]}\" as select * from '{p}'")
    for name, sql in q.oracle_sql().items():
        df = q.queries()[name](spark, d)
        rel = con.sql(sql)
        at = [list(rel.columns).index(c) for c in df.columns]
        assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())
    for name in ("p1_found", "p1_consistent", "p2_found", "p2_runs", "p3_found", "p3_redacted"):
        assert q.queries()[name](spark, d).count() > 0
