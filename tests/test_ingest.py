import base64
import json
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parlance import model
from parlance.operators import cards, privacy, subtitles
from parlance.render import render_card
from parlance.sources import demo, exports, sinks


def fields(spark, obj):
    df = spark.createDataFrame([(json.dumps(obj, ensure_ascii=False),)], "j string")
    return df.select(exports.fields_of(F.parse_json("j")).alias("x")).first().x


def test_aliases_and_falsy_values(spark):
    x = fields(spark, {"time": "", "timestamp": None, "ts": "2024-03-01T21:22:00+08:00", "nickname": "b", "text": 0, "msgType": 0})
    assert (x.ts_raw, x.sender, x.content, x.mtype) == ("2024-03-01 21:22:00+08:00", "b", "0", "1")
    assert fields(spark, {"type": "0"}).mtype == "0" and fields(spark, {"type": "service"}).mtype == "service" and fields(spark, {"type": False}).mtype == "1"
    x = fields(spark, {"text": ["今天", {"type": "bold", "text": "超累"}, {"a": 1}, 3], "from": "c", "createTime": 1709300000})
    assert (x.content, x.sender, x.ts_raw) == ("今天超累3", "c", "1709300000")


@pytest.mark.parametrize(("doc", "n"), [
    ("[{}, {}]", 2), ('{"data": [{}], "x": [{}, {}, {}]}', 1), ('{"zz": [{}], "aa": [{}, {}]}', 2), ('{"zz": [{"content": "z"}], "aa": [{"content": "a"}]}', 1), ('{"a": 1}', None), ("nonsense", None), ("3", None),
])
def test_message_array(spark, doc, n):
    got = spark.createDataFrame([(doc,)], "d string").select(F.size(exports.message_array(F.col("d"))).alias("n"), F.to_json(exports.message_array(F.col("d"))).alias("j")).first()
    assert (got.n if got.n is not None and got.n >= 0 else None) == n
    if "z" in doc and n == 1:
        assert "z" in got.j


def test_kept_and_files(spark, tmp_path):
    msgs = [{"time": "t", "sender": "a", "content": "x"}, {"time": "t", "content": "y", "type": 3}, {"time": "t", "content": "[y]", "type": 3}, {"content": "z"}, {"time": "t", "content": "", "type": 3}]
    (tmp_path / "a.json").write_text(json.dumps({"chat": msgs}))
    rows = exports.read_json_exports(spark, str(tmp_path))
    assert [r.content for r in exports.kept(rows).orderBy("seq").collect()] == ["x", "[y]"]
    assert [r.content for r in exports.kept(rows, True).orderBy("seq").collect()] == ["x", "[3]", "[y]"]
    assert tuple(exports.counters(rows).first()) == (5, 2, 3)
    (tmp_path / "b.json").write_text("{oops")
    with pytest.raises(ValueError, match="b.json"):
        exports.read_json_exports(spark, str(tmp_path))


def test_transcripts_round_trip(spark, tmp_path):
    m = spark.createDataFrame([("s", 0, "2024-01-01 00:00:00", "a", "one"), ("s", 1, "2024-01-01 00:01:00", "b", "two")], model.MESSAGES)
    sinks.write_transcript(m.coalesce(1), str(tmp_path / "out"))
    got = exports.read_transcripts(spark, str(tmp_path / "out" / "*.txt")).orderBy("seq").collect()
    assert [(r.ts_raw, r.sender, r.content) for r in got] == [("2024-01-01 00:00:00", "a", "one"), ("2024-01-01 00:01:00", "b", "two")]
    framed = exports.framed("\n".join(["", "t ", " s", "c", "", "u", "v", "=====", "x", "y"]))
    assert framed.values.tolist() == [["t", "s", "c"], ["v", "=====", "x"]]
    assert len(exports.framed("")) == 0 and len(exports.framed("a\nb")) == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([1, 4]), max_size=40))
def test_places_followed_equal_a_walk(steps):
    at, seen = 0, []
    while at < len(steps):
        seen.append(at)
        at += steps[at]
    assert exports.followed(np.array(steps, np.int64)).tolist() == seen


def test_documents_without_messages_raise(spark):
    df = spark.createDataFrame([('{"it\'s": [{"time": "t", "content": "c"}], "n": [], "x": 1}', 0), ('[{"time": "t", "content": "d"}]', 1), (None, 2)], "doc string, src long")
    assert [(r.src, r.seq, r.content) for r in exports.exported(df).orderBy("src").collect()] == [(0, 0, "c"), (1, 0, "d")]
    for bad in ('{"a": 1, "b": {"c": []}}', "7", "{oops"):
        with pytest.raises(Exception, match="no array of messages in this"):
            exports.exported(spark.createDataFrame([(bad, 0)], "doc string, src long")).collect()


def test_long_values_are_kept_whole(spark):
    long = "x" * 1_200_000
    doc = json.dumps([{"time": "2024-01-01T00:00:00" + long, "content": "c"}])
    assert len(exports.exported(spark.createDataFrame([(doc, 0)], "doc string, src long")).first().ts_raw) == 1_200_019
    files = spark.createDataFrame([("a.ass", "Dialogue: 0,0:00:01.00,0:00:02.00,D,Bo,0,0,0,," + long)], "src string, text string")
    assert len(exports.ass_cues(files).first().body) == 1_200_003


def test_subtitles(spark, tmp_path):
    (tmp_path / "a.srt").write_text("\ufeff1\r\n00:00:01,000 --> 00:00:02,000\r\nAnn: hi\r\nthere\r\n\r\n2\n00:00:03,000 --> 00:00:04,000\n\nx\n-->\n(aside): q\n", encoding="utf-8")
    (tmp_path / "b.ass").write_text("Dialogue: 0,0:00:01.00,0:00:02.00,D,Bo,0,0,0,,{\\pos(1,2)}a, b\\Nc\nComment: x\nDialogue: 1,2\n", encoding="utf-8")
    cues = exports.read_subtitles(spark, str(tmp_path))
    got = sorted((r.ts_raw, r.sender, r.content) for r in subtitles.cue_messages(cues, "2024-05-05").collect())
    assert got == [("2024-05-05 00:00:01", "Ann", "hi there"), ("2024-05-05 00:00:01", "Bo", "a, b c")]
    rows = [("0:00:01", "abcdefghijklmnopq: x"), ("100:00:01", "p（q）：r"), ("00:01", "a: b"), (None, "a: b"), ("0:00:01", None), ("0:00:02", "名：字")]
    df = spark.createDataFrame(rows, "raw_time string, body string")
    got = sorted((r.ts_raw, r.sender, r.content) for r in subtitles.cue_messages(df).collect())
    assert got == [("2024-01-01 00:00:01", "(未知)", "abcdefghijklmnopq: x"), ("2024-01-01 00:00:02", "名", "字"), ("2024-01-01 100:00:01", "(未知)", "p（q）：r")]
    assert {r.sender for r in subtitles.cue_messages(df, speaker="Z").collect()} == {"Z"}


def test_privacy_rules(spark):
    text = "a 13812345678 x\n11010119900101123X a@b.co wxid_abcd\n/home/bob C:\\\\Users\\\\bob C:\\Users\\bob 10.0.0.1 sk-0123456789abcdef\n110101199001011234 1.2.3"
    df = spark.createDataFrame([(1, text), (2, None)], "k long, t string")
    got = [(r.line_no, r.label, r.value) for r in privacy.hits(privacy.lines_of(df, "k", F.col("t")), "k").orderBy("line_no", "ord", "pos").collect()]
    assert got == [
        (1, "手机号", "13812345678"), (2, "身份证", "11010119900101123X"), (2, "邮箱", "a@b.co"), (2, "微信号", "wxid_abcd"), (3, "本机路径", "/home/bob"), (3, "本机路径", "C:\\\\Users\\\\bob"),
        (3, "IP 地址", "10.0.0.1"), (3, "疑似密钥", "sk-0123456789abcdef"), (4, "身份证", "110101199001011234"),
    ]


def test_privacy_of_very_long_lines(spark):
    df = spark.createDataFrame([(1, "x" * 300_000 + "\n" + "1.2," * 100_000 + "\n" + "word " * 60_000 + "a@b.co")], "k long, t string")
    assert [r.value for r in privacy.hits(privacy.lines_of(df, "k", F.col("t")), "k").collect()] == ["a@b.co"]


def test_privacy_files(spark, tmp_path):
    (tmp_path / ".git").mkdir()
    for name in (".git/a.txt", "b.txt", "c.PNG", "d.txt"):
        (tmp_path / name).write_bytes(b"\xff 10.0.0.1")
    ignored = spark.createDataFrame([(f"file:{tmp_path}/d.txt",)], "path string")
    got = privacy.scan_files(privacy.text_files(spark, str(tmp_path), ignored)).collect()
    assert [r.path.rsplit("/", 1)[1] for r in got] == ["b.txt"]


CARD = {"spec": "chara_card_v2", "spec_version": "2.0", "data": {
    "name": "A/b", "description": "d", "personality": "p", "scenario": "s", "first_mes": "a\n\nb", "post_history_instructions": "x", "alternate_greetings": ["1\n2"],
    "mes_example": "{{user}}: q\n{{char}}: 1\n2\n{{char}}3\n4\n5\n6{{user}}x", "character_book": {"entries": [{"keys": ["k"], "content": "cc"}]}}}


def card_frame(spark, *objs):
    return spark.createDataFrame([(i, json.dumps(o) if o is not None else None) for i, o in enumerate(objs)], "id long, j string").select("id", F.from_json("j", model.CARD).alias("card"))


def test_cards(spark):
    flat = {"name": "f", "first_mes": "\n".join("abcdefg")}
    df = card_frame(spark, CARD, flat, {"spec": "v9", "data": {}}, None)
    kinds = [r.k for r in df.orderBy("id").select(cards.kind(F.col("card")).alias("k")).collect()]
    assert kinds == ["v2", "v1", "unknown", "v1"]
    assert [(r.idx, r.n_lines) for r in cards.example_lines(df, "id").where("id = 0").collect()] == [(1, 6)]
    assert [r.n for r in df.where("id = 0").select(F.explode(cards.replies(F.col("card.data.mes_example"), True)).alias("n")).collect()] == [": 1\n2\n"]
    assert [(r.idx, r["keys"], r.n_chars) for r in cards.lorebook(df, "id").where("id = 0").collect()] == [(1, ["k"], 2)]
    assert [(r.idx, r.n_lines) for r in cards.greeting_lines(df, "id").where("id = 0").orderBy("idx").collect()] == [(0, 2), (1, 2)]
    found = {(r.id, r.check, r.subject) for r in cards.warnings(df, "id").collect()}
    assert {x for x in found if x[0] == 0} == {(0, "long example", "1")}
    assert (1, "long greeting", "first_mes") in found and (2, "unknown spec", "v9") in found and (3, "no reply", "mes_example") in found


def parts_of(png):
    assert png[:8] == sinks.SIGNATURE
    at, out = 8, []
    while at < len(png):
        n, kind = struct.unpack(">I4s", png[at : at + 8])
        data = png[at + 8 : at + 8 + n]
        assert struct.unpack(">I", png[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + data)
        out.append((kind, data))
        at += 12 + n
    return out


def test_pictures_and_deploy(spark, tmp_path):
    df = card_frame(spark, CARD).withColumn("picture", F.lit(None).cast("binary"))
    png = bytes(sinks.pictured(df).first().png)
    parts = parts_of(png)
    assert [k for k, _ in parts] == [b"IHDR", b"IDAT", b"tEXt", b"tEXt", b"IEND"]
    assert len(zlib.decompress(parts[1][1])) == 256 * (1 + 32)
    more = bytes(sinks.pictured(df.withColumn("picture", F.lit(sinks.placeholder_picture() + b"tail"))).first().png)
    assert more == png + b"tail"
    with pytest.raises(Exception, match="end mark"):
        sinks.pictured(df.withColumn("picture", F.lit(sinks.SIGNATURE))).collect()
    two, three = (json.loads(base64.b64decode(d.split(b"\0", 1)[1])) for k, d in parts if k == b"tEXt")
    assert two["data"]["name"] == "A/b" and three["spec"] == "chara_card_v3" and three["spec_version"] == "3.0"
    (tmp_path / "p.png").write_bytes(png)
    (tmp_path / "q.png").write_bytes(b"no")
    assert [r.path.rsplit("/", 1)[1] for r in exports.read_pictures(spark, str(tmp_path / "*.png")).collect()] == ["p.png"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "c.json").write_text(json.dumps(CARD))
    (tmp_path / "to").mkdir()
    made = exports.read_cards(spark, str(tmp_path / "in"))
    assert sinks.deploy(made, str(tmp_path / "to"), dry_run=True) == [str(tmp_path / "to" / "A_b.json")] and not list((tmp_path / "to").iterdir())
    sinks.deploy(made, str(tmp_path / "to"))
    assert json.loads((tmp_path / "to" / "A_b.json").read_text()) == CARD


def test_card_files(spark, tmp_path):
    df = spark.createDataFrame([("a", '{"spec": "chara_card_v2", "data": {"name": 7, "scenario": "s"}}'), ("b", '{"name": "n", "description": ["x"]}'), ("c", None)], "path string, value string")
    made = exports.cards_of(df)
    assert {r.path: r.other for r in made.collect()} == {"a": ["name"], "b": ["description"], "c": []}
    assert {r.path: r.n_chars for r in cards.field_lengths(made, "path").where("field = 'name'").collect()} == {"a": 0, "b": 1, "c": 0}
    empty = {(r.path, r.subject) for r in cards.warnings(made, "path").where("check = 'empty field'").collect()}
    assert ("a", "name") in empty and ("b", "description") in empty and ("b", "name") not in empty and ("a", "scenario") not in empty
    with pytest.raises(Exception, match="not valid JSON: x"):
        exports.cards_of(spark.createDataFrame([("x", "{oops")], "path string, value string")).collect()
    report = list(render_card(card_frame(spark, CARD).withColumnRenamed("id", "path")))
    assert report[0] == "=== 0 ===" and "  k: 2" in report and "  ! long example 1: 6" in report and report[1] == "Kind and name"


def test_demo_is_deterministic(spark):
    a, b = demo.demo_messages(spark, 500, block=16).orderBy("seq").collect(), demo.demo_messages(spark, 500).orderBy("seq").collect()
    assert a == b and {r.sender for r in a} == {demo.GROWER, demo.NEIGHBOUR} and a[0].ts_raw > demo.START and all(x.ts_raw < y.ts_raw for x, y in zip(a, a[1:]))
    assert demo.demo_messages(spark, 0).count() == 0
