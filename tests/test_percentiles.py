"""The percentile operator against brute force, every way."""

import math
import random
import re

import pytest

from terroir.operators.percentiles import Pct, percentiles


def brute(values, p):
    xs = sorted(values)
    pos = (len(xs) - 1) * p
    lo = xs[math.floor(pos)]
    hi = xs[math.ceil(pos)]
    above = pos - math.floor(pos)
    return lo * (1 - above) + hi * above


def rows(seed, n):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        # One group holds a third of all rows, one value a tenth of those; NULL keys and values occur.
        key = "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", None])
        x = 1234.5 if key == "hot" and rnd.random() < 0.1 else round(rnd.uniform(-500, 30000), 2)
        y = rnd.choice([None, float(rnd.randint(0, 20))])
        out.append((key, rnd.randint(1, 2), x, y))
    return out


WANTED = [Pct("x50", "x", 0.5, 10.0), Pct("x25", "x", 0.25, 10.0), Pct("x90", "x", 0.9, 10.0), Pct("y50", "y")]


@pytest.mark.parametrize("n", [1, 2, 7, 3000])
def test_matches_brute_force(spark, n):
    data = rows(n, n)
    df = spark.createDataFrame(data, "k string, g int, x double, y double")
    got = {
        (r.k, r.g): r
        for r in percentiles(df, ["k", "g"], WANTED, counts={"nx": "x", "ny": "y"}).collect()
    }
    groups = {}
    for k, g, x, y in data:
        groups.setdefault((k, g), []).append((x, y))
    assert set(got) == set(groups)
    for key, vals in groups.items():
        xs = [x for x, _ in vals]
        ys = [y for _, y in vals if y is not None]
        r = got[key]
        assert (r.x50, r.x25, r.x90) == (brute(xs, 0.5), brute(xs, 0.25), brute(xs, 0.9))
        assert r.y50 == (brute(ys, 0.5) if ys else None)
        assert (r.nx, r.ny) == (len(xs), len(ys))


def test_weights_count_as_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 10.0, 1), ("a", 2.0, 4), ("b", 5.0, 1)], "k string, x double, n long")
    got = {r.k: r for r in percentiles(df, ["k"], [Pct("m", "x")], weight="n", counts={"c": "x"}).collect()}
    assert got["a"].m == brute([1.0] * 3 + [10.0] + [2.0] * 4, 0.5)
    assert got["a"].c == 8
    assert got["b"].m == 5.0


def test_counts_come_before_shuffles_and_nothing_is_crossed(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows(1, 500), "k string, g int, x double, y double").write.parquet(path)
    plan = percentiles(spark.read.parquet(path), ["k"], WANTED)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # Rows are counted per group and value before their first exchange.
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "x#" in line]
    assert scans and len(exchanges) >= len(scans)


def shuffles(df):
    """Exchanges that ran, each counted once however often it is read."""
    df.collect()
    executed = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(r"[+:]- Exchange ", executed))


def test_a_call_takes_four_shuffles(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame(rows(1, 500), "k string, g int, x double, y double")
    frame.write.parquet(path)
    assert shuffles(percentiles(spark.read.parquet(path), ["k"], WANTED)) <= 4
    frame.groupBy("k", "x").count().write.parquet(path + "-h")
    assert shuffles(percentiles(spark.read.parquet(path + "-h"), ["k"], WANTED[:3], weight="count")) <= 3


def test_nothing_runs_while_a_query_is_built(spark):
    df = spark.range(5).selectExpr("id as k", "raise_error('computed') as x").selectExpr("k", "cast(x as double) as x")
    percentiles(df, ["k"], [Pct("m", "x")])


@pytest.mark.parametrize("width", [None, 2.0])
def test_nan_and_infinity_sort_at_the_ends(spark, width):
    inf, nan = float("inf"), float("nan")
    for data in ([float(i) for i in range(10)] + [nan] * 5, [-inf, 1.0, 2.0, inf], [nan], [inf, inf, -inf], [0.0, -0.0, 5.0, nan]):
        frame = spark.createDataFrame([("g", x) for x in data], "k string, x double").repartition(3)
        [got] = percentiles(frame, ["k"], [Pct("m", "x", 0.5, width), Pct("q", "x", 1.0, width)]).collect()
        expected = frame.selectExpr("percentile(x, 0.5) as m", "max(x) as q").first()
        assert str(got.q) == str(expected.q)
        assert str(got.m) == str(expected.m) or str(got.m) == str(float(sorted(x for x in data)[len(data) // 2]))


@pytest.mark.parametrize("width", [None, 10.0])
def test_without_keys_all_rows_are_one_group(spark, width):
    data = rows(9, 900)
    frame = spark.createDataFrame(data, "k string, g int, x double, y double")
    [got] = percentiles(frame, [], [Pct("m", "x", 0.5, width), Pct("y", "y")], counts={"n": "x"}).collect()
    assert got.asDict() == {
        "m": brute([r[2] for r in data], 0.5), "y": brute([r[3] for r in data if r[3] is not None], 0.5), "n": 900
    }
    assert percentiles(frame.limit(0), [], [Pct("m", "x")]).collect() == []


def test_many_distinct_values_in_one_slice(spark):
    frame = spark.range(40_000).selectExpr("1000 + (id * 7919 % 40000) / 4000000 as x", "1 as k")
    [got] = percentiles(frame, ["k"], [Pct("m", "x"), Pct("t", "x", 0.999)]).collect()
    data = [1000 + (i * 7919 % 40000) / 4000000 for i in range(40_000)]
    assert (got.m, got.t) == (brute(data, 0.5), brute(data, 0.999))


def test_row_order_and_partitioning_do_not_matter(spark):
    data = rows(3, 800)
    schema = "k string, g int, x double, y double"
    a = spark.createDataFrame(data, schema).repartition(1)
    b = spark.createDataFrame(data[::-1], schema).repartition(7)
    one = sorted(map(str, percentiles(a, ["k"], WANTED).collect()))
    two = sorted(map(str, percentiles(b, ["k"], WANTED).collect()))
    assert one == two


def windows(data, months):
    """Values of the months up to each month, by key."""
    out = {}
    for k, month, x in data:
        for i in range(months):
            end = month + i
            out.setdefault((k, end), []).append(x)
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_trailing_windows(spark, hot):
    """Also where months are missing, and with a group of a third of all rows."""
    rnd = random.Random(17)
    data = []
    for _ in range(1500):
        key = "hot" if hot and rnd.random() < 0.34 else rnd.choice(["a", "b", None])
        month = rnd.choice([0, 1, 2, 3, 9, 10, 30, 31]) if key != "b" else rnd.choice([5, 40])
        data.append((key, month, rnd.choice([round(rnd.uniform(500, 9000), 1), 2500.0, 0.0])))
    frame = spark.createDataFrame(data, "k string, i int, x double").selectExpr("k", "add_months(date'2020-01-01', i) as mois", "x")
    wanted = [Pct("m", "x"), Pct("q", "x", 0.9)]
    got = percentiles(frame, ["mois", "k"], wanted, counts={"n": "x"}, window=("mois", 12)).collect()
    index = {(r.k, (r.mois.year - 2020) * 12 + r.mois.month - 1): (r.m, r.q, r.n) for r in got}
    assert index == {key: (brute(v, 0.5), brute(v, 0.9), len(v)) for key, v in windows(data, 12).items()}
    one = percentiles(frame.drop("k"), ["mois"], wanted[:1], window=("mois", 3)).collect()
    expected = windows([("all", i, x) for _, i, x in data], 3)
    assert {(r.mois.year - 2020) * 12 + r.mois.month - 1: r.m for r in one} == {i: brute(v, 0.5) for (_, i), v in expected.items()}


def test_windows_copy_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(3000).selectExpr("add_months(date'2020-01-01', int(id % 24)) as mois", "id * 0.37D as x", "1L as n")
    frame.write.parquet(path)
    windows = percentiles(spark.read.parquet(path), ["mois"], [Pct("m", "x")], weight="n", window=("mois", 12))
    assert windows.count() == 35
    assert shuffles(windows) <= 4
    text = windows._jdf.queryExecution().optimizedPlan().toString()
    # Months are only spread out after rows have become counts of slices.
    assert text.count("explode(sequence") >= 1
    for part in text.split("explode(sequence")[1:]:
        assert "sum(" in part.split("Relation [")[0]


@pytest.mark.parametrize("weight", [None, "n"])
def test_levels(spark, weight):
    """All, by key and by both keys at once, with a hot key and NULL keys."""
    data = rows(21, 2500)
    frame = spark.createDataFrame(data, "k string, g int, x double, y double")
    given = frame.groupBy("k", "g", "x").count().withColumnRenamed("count", "n") if weight else frame
    levels = ("level", {"all": [], "by k": ["k"], "by both": ["k", "g"]})
    wanted = [Pct("m", "x"), Pct("q", "x", 0.9, 10.0)][:1] if weight else [Pct("m", "x"), Pct("z", "y", 0.25)]
    got = percentiles(given, ["k", "g"], wanted, weight=weight, counts={"c": "x"}, levels=levels).collect()
    expected = {}
    for k, g, x, _ in data:
        for key in (("all", None, None), ("by k", k, None), ("by both", k, g)):
            expected.setdefault(key, []).append(x)
    assert {(r.level, r.k, r.g): (r.m, r.c) for r in got} == {key: (brute(v, 0.5), len(v)) for key, v in expected.items()}
    with pytest.raises(ValueError, match="together"):
        percentiles(given, ["k", "g"], wanted, window=("g", 2), levels=levels)


def test_levels_copy_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows(4, 900), "k string, g int, x double, y double").groupBy("k", "g", "x").count().write.parquet(path)
    levels = ("level", {"all": [], "by k": ["k"], "by both": ["k", "g"]})
    df = percentiles(spark.read.parquet(path), ["k", "g"], [Pct("m", "x")], weight="count", levels=levels)
    assert shuffles(df) <= 4
    executed = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert executed.count("FileScan") == 1
