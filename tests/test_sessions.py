import random

from parlance.operators import sessions
from parlance.operators.sessions import SessionTable, local_sessions, merge_sessions

GAP = 1800
SCHEMA = "id long, src string, who string, ts long, note string"


def brute(rows):
    out, last = {}, {}
    seen = set()
    for i, s, w, t, _ in sorted((r for r in rows if None not in r[:4]), key=lambda r: (r[3], r[0])):
        if i in seen:
            continue
        seen.add(i)
        if (s, w) not in last or t - last[s, w][0] > GAP * 1_000_000:
            last[s, w] = [t, i]
            out[i] = 0
        last[s, w][0] = t
        out[last[s, w][1]] += 1
    return out


def _rows(n, seed):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice("ab"), rnd.choice(["x", "x", "x", "y", None]), rnd.randrange(0, 6 * 86_400) * 1_000_000, "n") for i in range(n)]
    rows += rnd.sample(rows, n // 10) + [(n, "a", "x", None, "n"), (n + 1, None, "x", 5, "n"), (None, "a", "x", 5, "n")]
    return rows


def _result(store):
    return {r.first_id: r.n for r in store.sessions().collect()}


def test_incremental_equals_brute_force(spark):
    rows = _rows(900, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    store = SessionTable(spark, ["src", "who"], GAP, buckets=4)
    for k in range(3):  # batches interleave, so later ones bridge stored sessions
        store.update(df.where(f"ts is null or floor(ts / 7200000000) % 3 = {k}"), "ts", "id")
    assert _result(store) == brute(rows)
    assert store.manifest()["version"] == 3


def test_bridge_across_days_and_batches(spark):
    day = 86_400_000_000
    rows = [(1, "a", "x", day - 900_000_000, ""), (2, "a", "x", day + 900_000_000, ""), (3, "a", "x", day + 900_000_000 + GAP * 1_000_000 + 1, "")]
    store = SessionTable(spark, ["src", "who"], GAP, buckets=2)
    store.update(spark.createDataFrame(rows[:1] + rows[2:], SCHEMA), "ts", "id")
    assert _result(store) == {1: 1, 3: 1}
    store.update(spark.createDataFrame(rows[1:2], SCHEMA), "ts", "id")
    assert _result(store) == {1: 2, 3: 1}
    store.update(spark.createDataFrame([], SCHEMA), "ts", "id")
    assert _result(store) == {1: 2, 3: 1}


def test_deliveries_repeated_in_a_later_batch_count_once(spark):
    rows = [(i, "a", "x", i * 60_000_000, "") for i in (1, 2, 3)]
    store = SessionTable(spark, ["src", "who"], GAP, buckets=2)
    store.update(spark.createDataFrame(rows[:2], SCHEMA), "ts", "id")
    store.update(spark.createDataFrame(rows[1:] + rows[2:], SCHEMA), "ts", "id")
    assert _result(store) == {1: 3}
    store.update(spark.createDataFrame(rows, SCHEMA), "ts", "id")
    assert _result(store) == {1: 3} and store.manifest()["version"] == 3


def test_buckets_grow_and_old_folders_go(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sessions, "MOST", 10)
    rows = [(i, f"s{i % 30}", "x", i * 7_200_000_000, "") for i in range(120)]
    store = SessionTable(spark, ["src", "who"], GAP, path=str(tmp_path / "t"), buckets=1)
    for k in range(4):
        store.update(spark.createDataFrame(rows[k * 30 : k * 30 + 30], SCHEMA), "ts", "id")
    assert store.manifest()["buckets"] >= 8 and _result(store) == brute(rows)
    assert not list((tmp_path / "t" / "v1").glob("_b=*"))


def test_reopened_at_its_path(spark):
    store = SessionTable(spark, ["src", "who"], GAP, buckets=2)
    assert store.sessions().count() == 0
    store.update(spark.createDataFrame(_rows(50, 2), SCHEMA), "ts", "id")
    again = SessionTable(spark, ["src", "who"], GAP, path=store.path, buckets=2)
    assert _result(again) == _result(store) == brute(_rows(50, 2))


def test_empty_table(spark):
    store = SessionTable(spark, ["src", "who"], GAP)
    store.update(spark.createDataFrame([], SCHEMA), "ts", "id")
    assert store.sessions().count() == 0


def test_equal_times_and_clashing_columns(spark):
    df = spark.createDataFrame([(2, "a", "x", 10, "n", 1, 2), (1, "a", "x", 10, "n", 3, 4)], SCHEMA + ", start long, n long")
    s = merge_sessions(local_sessions(df, ["src", "who"], "ts", "id", GAP), ["src", "who"], GAP).collect()
    assert [(r.first_id, r.last_id, r.n) for r in s] == [(1, 2, 2)]
