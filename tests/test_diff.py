import random

from voxmeter.operators.diff import diff_copies

SCHEMA = "k string, a string, b string, _key int, _side int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)


def found(df):
    return sorted((r["k"] or "<null>", r["finding"]) for r in df.collect())


def brute(left, right):
    def by(rows):
        out = {}
        for k, a, b in rows:
            out.setdefault(k, set()).add((a, b))
        return out

    l, r = by(left), by(right)
    out = [(k, "only_in_left") for k in l if k not in r] + [(k, "only_in_right") for k in r if k not in l]
    for k in l.keys() & r.keys():
        for i, f in enumerate("ab"):
            if {x[i] for x in l[k]} != {x[i] for x in r[k]}:
                out.append((k, f))
    return sorted((k or "<null>", f) for k, f in out)


def test_against_brute_force(spark):
    rng = random.Random(5)
    values = ["", None, "x", "X", "é", "é", "long " * 5000]
    left = [(f"k{i}", rng.choice(values), rng.choice(values)) for i in range(150)]
    right = [(k, rng.choice([a, a, rng.choice(values)]), b) for k, a, b in left if rng.random() < 0.8] + [("new", "a", None), (None, "x", "y")]
    left, right = left + left[:40] + [(None, "x", "z")], right + right[:30]
    # every key is hot in small tables; one key of many rows leaves the others cold
    much = [("much", str(i), "x") for i in range(2000)]
    for more in ([], much):
        l, r = left + more, right + more[1:] + more[:50]
        assert found(diff_copies(frame(spark, l), frame(spark, r), "k", ["a", "b"])) == brute(l, r)


def test_differences_inside_the_extremes(spark):
    cold = [(f"c{i}", "x", "y") for i in range(2000)]
    left = [("k", v, "y") for v in "abc"] + [("same", v, v) for v in "abca"] + [(None, v, "y") for v in "abc"] + [("n", None, "y"), ("n", "a", "y")]
    right = [("k", v, "y") for v in "acca"] + [("same", v, v) for v in "cba"] + [(None, v, "y") for v in "ac"] + [("n", "", "y"), ("n", "a", "y")]
    for more in ([], cold):
        got = found(diff_copies(frame(spark, left + more), frame(spark, right + more), "k", ["a", "b"]))
        assert got == [("<null>", "a"), ("k", "a"), ("n", "a")]


def test_hot_and_null_keys_are_dealt_out(spark):
    rows = [(None, str(i), "x") for i in range(3000)] + [("hot", str(i), "x") for i in range(3000)] + [(f"c{i}", "x", "y") for i in range(3000)]
    df = diff_copies(frame(spark, rows), frame(spark, rows[1:]), "k", ["a", "b"])
    assert found(df) == [("<null>", "a")]
    parts = df._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in parts and "hot" in parts


def test_empty_copies(spark):
    none, one = frame(spark, []), frame(spark, [("k", "a", None)])
    assert found(diff_copies(none, none, "k", ["a"])) == []
    assert found(diff_copies(one, none, "k", ["a"], "l", "r")) == [("k", "only_in_l")]
    assert found(diff_copies(none, one, "k", ["a"], "l", "r")) == [("k", "only_in_r")]


def test_hot_key_counts_once(spark):
    left = frame(spark, [("hot", "a", "b")] * 500 + [("cold", "a", "b")])
    right = frame(spark, [("hot", "a", "c")] * 300 + [("cold", "a", "b")])
    df = diff_copies(left, right, "k", ["a", "b"])
    assert [tuple(r) for r in df.collect()] == [("hot", "b", "b", "c")]


def test_merge_runs_over_sorted_rows(spark):
    cold = [(f"c{i}", "x", "y") for i in range(2000)]
    df = diff_copies(frame(spark, cold), frame(spark, cold), "k", ["a", "b"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    # one range exchange of the cold keys; the dealt ones are made distinct, have one too, and a small one of their states
    assert plan.count("Exchange rangepartitioning") == 2 and plan.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" in plan and "Join" not in plan
