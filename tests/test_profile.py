from parlance import model
from parlance.operators import profile
from parlance.render import render_profile

SCHEMA = "src string, seq long, ts_raw string, sender string, content string"


def rows_of(spark, contents, sender="a", ts="2024-03-01 07:05:00", src="s"):
    return spark.createDataFrame([(src, i, ts, sender, c) for i, c in enumerate(contents)], SCHEMA)


def test_emoji_and_brackets(spark):
    m = rows_of(spark, ["😀😀", "❤️", "👍🏽", "🇪🇸", "👩‍👩‍👧", "[hug][]", "[123456789012]", "[1234567890123]", "[[a]]", None, ""])
    emoji = {r.token: r.n for r in profile.token_rank(m, "a", model.EMOJI).collect()}
    assert emoji == {"😀": 2, "❤": 1, "\ufe0f": 1, "👍": 1, "🏽": 1, "👩": 2, "👧": 1}
    brackets = {r.token: (r.n, r.dilution) for r in profile.token_rank(m, "a", model.BRACKET).collect()}
    assert brackets == {"[hug]": (1, 9.0), "[123456789012]": (1, 9.0), "[a]": (1, 9.0)}


def test_ties_keep_first_occurrence(spark):
    m = rows_of(spark, ["[z]", "[a]", "[z]", "[a]", "[m]"])
    assert [r.token for r in profile.token_rank(m, "a", model.BRACKET, 2).collect()] == ["[z]", "[a]"]


def test_strip_phrases_and_tails(spark):
    m = rows_of(spark, ["\u3000好的。"] * 3 + ["ok ~"] * 2 + ["[x]好的"] + ["\x1c走啦\u2028"] * 2 + ["end～", "end."])
    got = {r.phrase: r.n for r in profile.catchphrases(m, "a", least=1).collect()}
    assert got == {"好的": 3, "ok ": 2, "走啦": 2, "end～": 1, "end.": 1}
    assert {r.tail: r.n for r in profile.sentence_tails(m, "a").collect()} == {"。": 3, "~": 2, "啦": 2}


def test_ngrams(spark):
    m = rows_of(spark, ["abab", "[ab", "的了", "x"])
    got = {r.gram: r.n for r in profile.ngrams_top(m, "a", least=1).collect()}
    assert got == {"ab": 2, "ba": 1, "aba": 1, "bab": 1, "abab": 1}
    order = [r.gram for r in profile.ngrams_top(m, "a", least=1).collect()]
    assert order == ["ab", "ba", "aba", "bab", "abab"]


def test_bursts(spark):
    m = spark.createDataFrame([("s", i, "t", x, "c") for i, x in enumerate("AABACAAA")] + [("t", i, "t", "A", "c") for i in range(2)] + [("t", 9, "t", "A", "=====x")], SCHEMA)
    runs = profile.bursts(m, "A", block=3)
    assert sorted(r.run for r in runs.collect()) == [1, 2, 2, 3]
    s = profile.burst_stats(runs).first()
    assert (s.n, s.mean, s.longest) == (4, 2.0, 3)
    assert [(r.run, r.n) for r in profile.burst_histogram(runs).collect()] == [(1, 1), (2, 2), (3, 1)]
    assert profile.burst_stats(profile.bursts(m, "nobody")).count() == 0


def test_hours_months_lengths(spark):
    ts = ["2024-03-01 7:05:00", "2024-03-01T23:05:00", "1709300000", "1709300000123", "none", "2024-04-01 07:00"]
    m = spark.createDataFrame([("s", i, t, "a", "x" * n) for i, (t, n) in enumerate(zip(ts, (5, 6, 20, 21, 100, 101)))], SCHEMA)
    assert {r.hour: r.n for r in profile.active_hours(m, "a").collect()} == {7: 2, 23: 2}
    assert profile.peak_hour(m, "a").first().hour == 7
    assert {r.month: r.n for r in profile.monthly_volume(m).collect()}["2024-03"] == 2
    h = {r.bucket: (r.n, r.share) for r in profile.length_histogram(m, "a").collect()}
    assert h == {1: (1, 1 / 6), 2: (2, 2 / 6), 3: (2, 2 / 6), 4: (1, 1 / 6)}
    assert [r.n for r in profile.length_histogram(m, "nobody").collect()] == [0, 0, 0, 0]


def test_speakers(spark):
    m = spark.createDataFrame([("s", i, "t", x, "c") for i, x in enumerate("aabbc")], SCHEMA)
    assert profile.resolve_speakers(m) == ("a", "b")
    assert profile.resolve_speakers(m, char="b") == ("b", "a")
    assert profile.resolve_speakers(m, user="a") == ("a", "a")
    assert profile.resolve_speakers(m.where("sender = 'c'")) == ("c", "")
    assert profile.resolve_speakers(m.limit(0)) == ("", "")
    try:
        profile.resolve_speakers(m, char="zz")
    except ValueError as e:
        assert "zz" in str(e) and "a, b, c" in str(e)
    else:
        raise AssertionError


def test_report(spark):
    m = rows_of(spark, ["hello[x]", "hi😀!", "hi😀!"]).unionByName(rows_of(spark, ["yo"], sender="b", src="t"))
    lines = render_profile(profile.profile(m), "a", "b")
    assert "a: 3, b: 1, ratio 3.00" in lines and "[x] 1 (once in 3)" in lines and "peak 07" in lines
    assert "最多 07 点" in render_profile(profile.profile(m), "a", "b", "zh")
    empty = render_profile(profile.profile(m.limit(0)), "", "")
    assert "none" in empty
