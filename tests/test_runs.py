"""Runs with timers, sessions and cubes: growing input, expiry, late and odd rows."""

import datetime as dt
import random


from bugloom.operators import report
from bugloom.streaming import incremental

DAY, START = 86_400, dt.datetime(2024, 1, 1)


def expected(events, least, gap):
    out = []
    for k in {k for k, _ in events if k is not None}:
        since, last, n = None, None, 0
        for t in sorted(t for x, t in events if x == k and t is not None):
            if last is None or t - last > gap:
                since, n = t, 0
            n, last = n + 1, t
            if n == least:
                out.append((k, since, t))
    return sorted(out)


def batches(seed):
    rng, now, out = random.Random(seed), 0, []
    for _ in range(4):
        rows = []
        for _ in range(60):
            now += rng.randint(0, 6 * 3600)
            rows.append((rng.randint(0, 5) if rng.random() < 0.95 else None, now))
        out.append(rows)
    return out


def written(spark, rows, path):
    df = spark.createDataFrame([(k, START + dt.timedelta(seconds=t)) for k, t in rows], "k int, ts timestamp")
    df.coalesce(1).write.mode("append").parquet(path)


def test_runs_over_growing_input(spark, tmp_path):
    parts, src, out, mark = batches(3), f"file://{tmp_path}/in", f"file://{tmp_path}/out", f"file://{tmp_path}/mark"
    base = int(START.replace(tzinfo=dt.UTC).timestamp())
    for i, rows in enumerate(parts):
        written(spark, rows, src)
        stream = spark.readStream.schema("k int, ts timestamp").parquet(src)
        found = incremental.runs_reaching(stream, "k", "ts", 3, DAY)
        before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        incremental.with_setting(spark, "spark.sql.streaming.stateStore.providerClass", incremental.ROCKS, lambda f=found: incremental.run_once(f, mark, path=out))
        assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
        so_far = [(k, t) for p in parts[: i + 1] for k, t in p]
        got = sorted((r.k, r.since // 10**6 - base, r["at"] // 10**6 - base) for r in spark.read.schema("k int, since long, at long").parquet(out).collect())
        assert got == expected(so_far, 3, DAY) and got


def test_sessions_are_told_once_closed(spark, tmp_path):
    src, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    written(spark, [(1, 0), (1, 3600), (1, 10 * DAY), (2, 5)], src)
    counts = incremental.session_counts(spark.readStream.schema("k int, ts timestamp").parquet(src), "ts", "k", "1 day").select("k", "count")
    incremental.run_once(counts, f"file://{tmp_path}/mark", path=out)
    assert sorted((r.k, r["count"]) for r in spark.read.schema("k int, count long").parquet(out).collect()) == [(1, 2), (2, 1)]


def test_cube_and_the_error_of_its_sketch(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice(["x", None]), rng.randint(0, 10**6)) for _ in range(20_000)] + [("z", "x", None)]
    df = spark.createDataFrame(rows, "g string, h string, v long")
    got = {(r.g, r.h, r.level): r for r in report.cube(df, ["g", "h"], "v", (0.5, 0.9), 100).collect()}
    assert len(got) == 5 + 3 + 2 + 1 and got[None, None, 3].n == 20_001
    assert got["z", "x", 0].p50 is None and got["z", "x", 0].p50_sketched is None
    for (g, h, level), r in got.items():
        v = sorted(x for a, b, x in rows if x is not None and (level & 2 or a == g) and (level & 1 or b == h))
        if v:
            for q, name in ((0.5, "p50"), (0.9, "p90")):
                place = q * (len(v) - 1)
                assert abs(r[name] - (v[int(place)] + (place % 1) * (v[min(int(place) + 1, len(v) - 1)] - v[int(place)]))) < 1e-6
                rank = sum(x <= r[f"{name}_sketched"] for x in v)
                assert abs(rank - q * len(v)) <= len(v) / 100 + 1


def test_setting_is_put_back_after_an_error(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        incremental.with_setting(spark, "spark.sql.shuffle.partitions", "3", lambda: 1 / 0)
    except ZeroDivisionError:
        pass
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
