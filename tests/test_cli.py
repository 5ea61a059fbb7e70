import json
import subprocess

from parlance import cli


def test_export_to_profile_and_sample(spark, tmp_path, capsys):
    cli.main(["demo", "-o", str(tmp_path / "demo"), "--count", "400"])
    rows = [json.loads(x) for p in sorted((tmp_path / "demo").glob("*.txt")) for x in p.read_text().splitlines()]
    assert len(rows) == 400
    (tmp_path / "chat.json").write_text(json.dumps(rows, ensure_ascii=False))
    cli.main(["convert", "-i", str(tmp_path / "chat.json"), "--output", str(tmp_path / "txt")])
    cli.main(["profile", "-i", str(tmp_path / "txt" / "*.txt"), "--output", str(tmp_path / "stats.txt"), "--phrase-min", "3"])
    report = (tmp_path / "stats.txt").read_text()
    assert "400 messages, 2 participants" in report and "[9] Bursts" in report
    cli.main(["sample", "-i", str(tmp_path / "txt" / "*.txt"), "--target", "60", "--base", "10", "--output", str(tmp_path / "s.txt")])
    assert (tmp_path / "s.txt").read_text().startswith("===== 2024-03 | ")
    assert (tmp_path / "s_stats.txt").read_text().splitlines()[-1].startswith("Total sampled: ")
    cli.main(["convert", "-i", str(tmp_path / "chat.json"), "--list-senders"])
    assert "Isolde" in capsys.readouterr().out
    assert cli.main(["privacy", "-p", str(tmp_path / "stats.txt")]) == 0
    (tmp_path / "card.json").write_text(json.dumps({"spec": "chara_card_v2", "data": {"name": "x"}}))
    cli.main(["card", "-i", str(tmp_path / "card.json"), "--lang", "zh"])
    assert "empty field scenario" in capsys.readouterr().out
    cli.main(["picture", "-i", str(tmp_path / "card.json"), "-o", str(tmp_path / "x.png")])
    assert (tmp_path / "x.png").read_bytes()[:4] == b"\x89PNG"


def test_ignored_files_are_no_hits(spark, tmp_path, capsys):
    subprocess.run(["git", "init", "-q", str(tmp_path)], check=True)
    for name in ("seen.txt", "left out.txt"):
        (tmp_path / name).write_text("mail a@example.org")
    (tmp_path / ".gitignore").write_text("left*\n")
    assert cli.main(["privacy", "-p", str(tmp_path)]) == 1
    out = capsys.readouterr().out
    assert "seen.txt:1" in out and "left" not in out


def test_one_speaker_is_told(spark, tmp_path, capsys):
    (tmp_path / "a.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\nhello\n")
    cli.main(["subtitles", "-i", str(tmp_path / "a.srt"), "--output", str(tmp_path / "out")])
    assert "only one speaker" in capsys.readouterr().out
