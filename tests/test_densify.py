"""Interpolation rules, one test a rule."""

import functools
from datetime import datetime, timedelta

import pytest

from tickloom.operators.densify import dense_symbols, densify, ffill, split_points, symbol_gates
from tickloom.operators.reports import pending_symbols

SCHEMA = "symbol string, date timestamp_ntz, iv double, underlying_price double, time_to_maturity double, mark_price double, record_time string"
T0 = datetime(2023, 3, 20)


def rows(spark, points, symbol="s", marks=None):
    """points: (seconds, iv)"""
    out = [(symbol, T0 + timedelta(seconds=s), v, 1.0, 1.0, (marks or {}).get(i), str(i)) for i, (s, v) in enumerate(points)]
    return spark.createDataFrame(out, SCHEMA)


def series(df):
    return [(int((r.date - T0).total_seconds()) // 60, r.iv) for r in df.orderBy("date", "iv").collect()]


def test_duplicates_and_rows_off_the_grid(spark):
    points = [(0, 1.0), (120, 3.0), (120, 5.0), (270, 100.0), (360, 9.0), (450, 50.0)]
    got = series(densify(rows(spark, points), min_points=1))
    assert got == [(0, 1), (1, 2), (2, 3), (2, 5), (3, 6), (4, 7), (5, 8), (6, 9), (7, 9)]


def test_align_floor_keeps_rows_off_the_grid(spark):
    got = series(densify(rows(spark, [(0, 1.0), (90, 2.0), (120, 3.0)]), min_points=1, align="floor"))
    assert got == [(0, 1), (1, 2), (2, 3)]


def test_nulls_inside_are_interpolated_by_position(spark):
    got = series(densify(rows(spark, [(0, 1.0), (60, None), (240, 9.0)]), min_points=1))
    assert got == [(0, 1), (1, 3), (2, 5), (3, 7), (4, 9)]


def test_leading_nulls_go_and_trailing_ones_hold(spark):
    got = series(densify(rows(spark, [(0, None), (120, 2.0), (180, 4.0), (300, None)]), min_points=1))
    assert got == [(2, 2), (3, 4), (4, 4), (5, 4)]


def test_forward_fill_over_nulls_of_real_rows(spark):
    got = densify(rows(spark, [(0, 1.0), (60, 1.0), (180, 1.0)], marks={0: 7.0}), min_points=1).orderBy("date").collect()
    assert [r.mark_price for r in got] == [7.0] * 4
    assert [r.is_interpolated for r in got] == [False, False, True, False]
    sparse = ffill(rows(spark, [(0, 1.0), (60, 1.0)], marks={0: 7.0}), ["mark_price"], ["date"])
    assert [r.mark_price for r in sparse.orderBy("date").collect()] == [7.0, 7.0]


def test_gates(spark):
    few = rows(spark, [(60 * i, 1.0) for i in range(9)], "few")
    enough = rows(spark, [(60 * i, 1.0) for i in range(10)], "enough")
    month = rows(spark, [(i * 60, 1.0) for i in range(9)] + [(30 * 86400, 1.0)], "month")
    longer = rows(spark, [(i * 60, 1.0) for i in range(9)] + [(30 * 86400 + 60, 1.0)], "longer")
    df = few.union(enough).union(month).union(longer)
    assert {r.symbol: r.gate for r in symbol_gates(df).collect()} == {"few": "too few rows", "enough": None, "month": None, "longer": "span too long"}
    assert {r.symbol: r["count"] for r in densify(df).groupBy("symbol").count().collect()} == {"enough": 10, "month": 43201}
    assert densify(month, max_points=43_200).isEmpty()


def test_empty_and_null_rows(spark):
    assert densify(rows(spark, [])).isEmpty()
    odd = spark.createDataFrame([(None, T0, 1.0, 1.0, 1.0, None, None), ("s", None, 1.0, 1.0, 1.0, None, None), ("s", T0, 2.0, 1.0, 1.0, None, None)], SCHEMA)
    assert series(densify(odd, min_points=1)) == [(0, 2.0)]


def test_split(spark):
    real, made = split_points(densify(rows(spark, [(0, 1.0), (240, 2.0)]), min_points=1))
    assert (real.count(), made.count()) == (2, 3)


def test_one_shuffle_by_symbol_and_none_of_dense_rows(spark):
    df = densify(rows(spark, [(0, 1.0), (240, 2.0)]), min_points=1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Window") < plan.index("Exchange")


@pytest.mark.parametrize("n", [1, 7])
def test_row_count_is_the_span(spark, n):
    df = densify(rows(spark, [(60 * n * i, float(i)) for i in range(20)]))
    assert df.count() == 19 * n + 1


def test_forward_fill_cuts_a_hot_symbol(spark):
    import random

    rng = random.Random(4)
    made = [("hot" if i % 10 else rng.choice(["a", "b", None]), T0 + timedelta(seconds=i), rng.choice([None, None, None, float(i)]), None if i < 900 else "x" if i == 900 else None) for i in range(3000)]
    df = spark.createDataFrame(rng.sample(made, len(made)), "symbol string, date timestamp_ntz, mark_price double, note string").repartition(3)
    filled = ffill(df, ["mark_price", "note"], ["date"], pieces=12)
    held, want = {}, set()
    for symbol, date, mark, note in made:
        old = held.get(symbol, (None, None))
        held[symbol] = (mark if mark is not None else old[0], note if note is not None else old[1])
        want.add((symbol, date, *held[symbol]))
    got = filled.collect()
    assert {tuple(r) for r in got} == want and len(got) == len(made)
    # the rows were dealt out by ranges, those of the hot symbol to many tasks
    sizes = [len(p) for p in df.repartitionByRange(12, "symbol", "date").rdd.glom().collect()]
    assert max(sizes) < 0.2 * len(made)
    assert ffill(df.where("false"), ["mark_price"], ["date"]).collect() == []


def test_no_frame_is_read_anew_for_every_row(spark):
    """Frames that end at the symbol's last row cost the square of its rows; what they gave comes from the other end."""
    import random

    rng = random.Random(7)
    points = [(60 * (i // 2 + i // 5), None if rng.random() < 0.6 else float(rng.randrange(100))) for i in range(400)]
    df = densify(rows(spark, points), min_points=1)
    assert "unboundedfollowing" not in df._jdf.queryExecution().analyzed().toString().lower()
    pos, at = [], 0
    for i, (s, _) in enumerate(points):
        pos.append(at)
        at += max(((points[i + 1][0] - s) // 60) if i + 1 < len(points) else 1, 1)
    # rows of one minute are in order of record_time, a text
    order = sorted(range(len(points)), key=lambda i: (points[i][0], str(i)))
    value, known = {}, [k for k, i in enumerate(order) if points[i][1] is not None]
    for k, i in enumerate(order):
        a, b = max((x for x in known if x <= k), default=None), min((x for x in known if x >= k), default=None)
        if a is not None:
            u = points[order[a]][1]
            value[i] = u if b in (None, a) else u + (points[order[b]][1] - u) / (pos[b] - pos[a]) * (pos[k] - pos[a])
    got = {int(r.record_time): r.iv for r in df.where("not is_interpolated").collect()}
    assert got.keys() == value.keys() and all(abs(got[i] - value[i]) < 1e-9 for i in got)


def test_symbols_without_their_rows(spark):
    """As the symbols of the dense rows, also where NaN and infinity take rows out; the grid is not made for them."""
    inf, nan = float("inf"), float("nan")
    cases = {
        "plain": [(0, 1.0), (180, 2.0)], "nulls": [(0, None), (60, None)], "late": [(0, None), (180, 2.0)], "nan": [(0, nan), (180, nan)], "before nan": [(0, 1.0), (180, nan)],
        "up": [(0, 1.0), (180, inf)], "up at once": [(0, 1.0), (60, inf), (120, nan)], "down": [(0, -inf), (60, nan)], "one": [(0, 1.0)], "off": [(0, None), (90, 2.0)],
    }
    df = functools.reduce(lambda a, b: a.union(b), [rows(spark, points, name) for name, points in cases.items()])
    found = dense_symbols(df, min_points=1)
    want = {r.symbol for r in densify(df, min_points=1).select("symbol").distinct().collect()}
    assert {r.symbol for r in found.collect()} == want and "plain" in want and "nulls" not in want and "nan" not in want
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.symbol for r in dense_symbols(df, min_points=2).collect()} == want - {"one"}


def test_pending_symbols_shuffle_a_row_a_symbol(spark):
    done = densify(rows(spark, [(0, 1.0), (6000, 2.0)], "a"), min_points=1)
    found = pending_symbols(rows(spark, [(0, 1.0)], "a").union(rows(spark, [(0, 1.0)], "b")), done)
    assert [r.symbol for r in found.collect()] == ["b"]
    right = found._jdf.queryExecution().optimizedPlan().children().apply(1).toString()
    assert right.startswith("Aggregate")


def test_rows_are_sorted_twice_and_a_window_is_computed_once(spark):
    """By time, and from the other end; not back again, and not anew for each field of a neighbour."""
    plan = densify(rows(spark, [(0, 1.0), (60, None), (240, 9.0)]), min_points=1)._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]  # the last is computed first
    assert sum(w.count("last(") for w in windows) == 3 * 2 + 2  # three numbers from both ends, two fills
    by_time = ["date" in w.rpartition("[")[2] for w in windows]
    assert by_time == sorted(by_time) and {True, False} == set(by_time)
