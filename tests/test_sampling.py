from parlance.operators import sampling

SCHEMA = "src string, seq long, ts_raw string, sender string, content string"


def data(spark):
    rows = [("s", i, f"2024-{1 + (i * 7 // 1000) % 5:02d}-01 00:00:00", "a", "c") for i in range(700)]
    rows += [("t", i, "2024-06-01 00:00:00", "a", "c") for i in range(30)] + [("t", 99, "", "a", "c"), ("t", 100, "2024-06", "a", ""), ("t", 101, None, "a", "c")]
    return spark.createDataFrame(rows, SCHEMA)


def test_quota_is_met_and_bounded(spark):
    m = data(spark)
    q = {r.month: (r.n, r.quota) for r in sampling.quotas(sampling.month_totals(sampling.eligible(m)), 300, 20).collect()}
    sample = sampling.stratified_sample(m, 300, 20, 5, 9, 1, 400)
    st = {r.month: (r.total, r.sampled, r.segments) for r in sampling.sample_stats(m, sample).collect()}
    assert set(st) == set(q) and sum(n for n, _ in q.values()) == 730
    for month, (n, quota) in q.items():
        total, sampled, segments = st[month]
        assert total == n and min(quota, n) <= sampled < quota + 9 and 1 <= segments <= sampled
    again = sampling.stratified_sample(m, 300, 20, 5, 9, 1, 400)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, sample.collect()))
    assert sorted(map(tuple, sampling.stratified_sample(m, 300, 20, 5, 9, 2, 400).collect())) != sorted(map(tuple, sample.collect()))


def test_empty(spark):
    assert sampling.stratified_sample(data(spark).limit(0)).count() == 0
