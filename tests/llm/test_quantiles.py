import datetime
import math

import numpy as np
import pytest

pytest.importorskip("voxmeter.llm")

from voxmeter.llm import quantiles as q  # noqa: E402

P = (0.5, 0.9, 0.95, 0.99)


def rank_errors(sketch, values):
    ordered, n = np.sort(values), len(values)
    out = []
    for p, v in zip(P, sketch.quantiles(P)):
        low, high = np.searchsorted(ordered, v, "left") + 1, np.searchsorted(ordered, v, "right")
        r = max(1, math.ceil(p * n))
        out.append(max(0, low - r, r - high) / n)
    return out


@pytest.mark.parametrize("n", [1, 5, 512, 513, 20_000, 200_000])
def test_error_is_within_the_bound(n):
    values = np.random.default_rng(n).standard_exponential(n)
    for parts in (1, 37):
        merged = q.Sketch(seed=1)
        for i, part in enumerate(np.array_split(values, parts)):
            s = q.Sketch(seed=100 + i)
            s.add(part)
            merged.merge(*s.row())
        assert merged.n == n and merged.size <= 3.2 * q.K
        assert max(rank_errors(merged, values)) <= merged.rank_error(0.001) <= 0.02
        if n <= q.K:
            assert merged.rank_error(0.01) == 0 and merged.quantiles([0.0, 1.0]) == [values.min(), values.max()]


def test_ties_and_sorted_input():
    values = np.repeat([0.0, 0.0, 1.0, 1.0, 2.0], 20_000)
    s = q.Sketch()
    s.add(values)
    assert s.quantiles([0.2, 0.6, 0.99]) == [0.0, 1.0, 2.0]


def test_weights_add_up():
    s = q.Sketch()
    s.add(np.arange(100_003.0))
    assert s.weighted()[1][-1] == 100_003


def frame(spark):
    day = datetime.datetime
    rows = [("en", "a", float(i), day(2025, 1, 1 + i % 9)) for i in range(3000)]
    rows += [(None, None, v, day(2025, 1, 1)) for v in (1.0, None, float("nan"), float("inf"), -float("inf"), 3.0)]
    rows += [("ky", "a", None, None), ("es", None, 5.0, None)]
    return spark.createDataFrame(rows, "lang string, bin string, v double, at timestamp_ntz").withColumn("n", q.F.lit("clash"))


def test_groups_and_days(spark):
    df = frame(spark)
    days = q.daily_sketches(df, ["lang", "bin"], "at", "v")
    out = {(r["lang"], r["bin"]): r for r in q.percentiles(days, ["lang", "bin"], P).collect()}
    assert out.keys() == {("en", "a"), (None, None), ("ky", "a"), ("es", None)}
    big = out["en", "a"]
    assert big["n"] == 3000 and abs(big["p50"] - 1499) <= 3000 * big["rank_error"] and big["rank_error"] < 0.01
    assert (out[None, None]["n"], out[None, None]["p50"], out[None, None]["p99"]) == (2, 1.0, 3.0)
    assert (out["ky", "a"]["n"], out["ky", "a"]["p50"]) == (0, None) and out["es", None]["p90"] == 5.0
    per_day = q.percentiles(days, ["lang", "bin", "day"], [0.5]).where("lang = 'en'").collect()
    assert len(per_day) == 9 and sum(r["n"] for r in per_day) == 3000
    # a part of the days gives the percentiles of these days
    some = q.percentiles(days.where("day <= DATE'2025-01-02'"), ["lang", "bin"], P).where("lang = 'en'").first()
    assert some["n"] == 668 and abs(some["p50"] - 1500) < 3000 * 0.02


def test_same_result_again(spark):
    df = frame(spark)
    a, b = (q.percentiles(q.daily_sketches(df, ["lang", "bin"], "at", "v"), ["lang", "bin"], P).orderBy("lang", "bin").collect() for _ in range(2))
    assert a == b


def test_empty(spark):
    df = frame(spark).limit(0)
    assert q.percentiles(q.daily_sketches(df, ["lang", "bin"], "at", "v"), ["lang", "bin"], P).count() == 0
