import itertools
import json
import random
from datetime import datetime, timedelta

from voxmeter.operators import drift as d
from voxmeter.operators.drift import Drift, Profile, Version, assign, name_words, seeds, versions_matched

SCHEMA = "file_id long, stream string, produced_at timestamp_ntz, line_no long, payload string, key string, path string"


def raw(spark, files):
    """files: (file_id, stream, hours, [payloads])."""
    rows, line = [], 0
    for f, stream, hours, payloads in files:
        for p in payloads:
            line += 1
            rows.append((f, stream, datetime(2025, 1, 1) + timedelta(hours=hours), line, p if isinstance(p, str) or p is None else json.dumps(p), "x", "y"))
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def clip(i, dur=None, lat=None, voice=None, **more):
    out = {"utt": f"u{i}", "text": "word " * (3 + i % 7)}
    for where in (dur, lat, voice):
        if where:
            name, value = where
            target = out
            *path, last = name.split(".")
            for p in path:
                target = target.setdefault(p, {})
            target[last] = value
    return out | more


def many(start, dur, lat, voice, n=10, **more):
    return [
        clip(i, dur and (dur[0], dur[1](1.0 + 0.4 * (i % 7) + 0.001 * i)), lat and (lat[0], lat[1](0.2 + 0.013 * (i * 5 % 11))), voice, **more)
        for i in range(start, start + n)
    ]


num, sec, comma, ms = lambda x: round(x, 3), lambda x: f"{x:.3f} s", lambda x: f"{x:.3f}".replace(".", ","), lambda x: round(1000 * x)


def found(drift):
    return sorted(tuple(r) for r in drift.changes().collect())


def test_changes(spark):
    v = ("voice", "ann_f")
    files = [
        (1, "s", 0, many(0, ("gen_dur", num), ("latency_s", num), v)),
        (2, "s", 1, many(10, ("Gen_Dur", num), ("latency_s", sec), v, prompt_dur=3.3)),
        (3, "s", 700, many(20, ("audio.seconds", comma), None, ("voice", ["ann_f"]), rtf=0.2)),
        (4, "s", 701, many(30, ("dur_ms", ms), ("timing.gen", num), ("prompt.voice", 7)) + ['{"utt": "u99", "dur', None, "[1]", "3", "{}", '{"utt": null, "dur_ms": null}']),
        (5, "s", 702, ["{", ""]),
        (9, "other", 0, many(0, ("gen_dur", num), ("latency_s", num), v)),
        (10, "other", 5, many(8, ("length_sec", num), ("timing.gen", num), v) * 2),
    ]
    want = [
        (2, "duration", "renamed"), (2, "latency", "retyped"), (3, "duration", "renamed"), (3, "duration", "retyped"), (3, "latency", "removed"),
        (3, "voice", "retyped"), (4, "duration", "renamed"), (4, "duration", "retyped"), (4, "latency", "added"), (4, "voice", "renamed"),
        (4, "voice", "retyped"), (5, "duration", "removed"), (5, "latency", "removed"), (5, "voice", "removed"),
        (10, "duration", "renamed"), (10, "latency", "renamed"),
    ]
    drift = Drift(raw(spark, files))
    assert found(drift) == sorted(want)
    table = {r["utt"]: r for r in drift.unified().collect() if r["utt"]}
    assert abs(table["u30"]["duration"] - round(1.0 + 0.4 * 2 + 0.03, 3)) < 1e-9 and table["u30"]["voice"] == "7"
    assert table["u20"]["voice"] == "ann_f" and table["u20"]["latency"] is None


def test_unknown_names_are_carried_by_shared_values(spark):
    """A name that says nothing is recognised by the values of the utterances that both files hold."""
    before = many(0, ("gen_dur", num), ("latency_s", num), ("voice", "a"))
    files = []
    for k in range(3):
        again = many(8, ("zq", num), ("latency_s", num), ("voice", "a"), n=2) + many(20, ("zq", num), ("latency_s", num), ("voice", "a"))
        files += [(10 * k + 1, f"s{k}", 0, before), (10 * k + 2, f"s{k}", 1, again)]
    assert found(Drift(raw(spark, files))) == [(2, "duration", "renamed"), (12, "duration", "renamed"), (22, "duration", "renamed")]


def test_opaque_names_of_one_run_last(spark):
    """A name of one run, known in its first file by shared values, and a second one after it, are kept to the end."""
    plan = [("latency_s", 0), ("zq", 8), ("zq", 20), ("zq", 40), ("xk", 48), ("xk", 60), ("latency_s", 68)]
    files = [(k, "s", k, many(start, ("gen_dur", num), (name, num), ("voice", "a"), n=12)) for k, (name, start) in enumerate(plan, 1)]
    drift = Drift(raw(spark, files))
    assert found(drift) == [(2, "latency", "renamed"), (5, "latency", "renamed"), (7, "latency", "renamed")]
    assert all(r["latency"] is not None for r in drift.unified().collect())


def test_empty_table(spark):
    drift = Drift(raw(spark, []))
    assert found(drift) == [] and drift.unified().count() == 0 and drift.all_changes().count() == 0


def test_assignment_is_optimal():
    rng = random.Random(3)
    for _ in range(50):
        n, m = rng.randint(1, 4), rng.randint(4, 6)
        costs = [[rng.randint(0, 20) for _ in range(m)] for _ in range(n)]
        best = min(sum(costs[i][p[i]] for i in range(n)) for p in itertools.permutations(range(m), n))
        got = assign(costs)
        assert len(set(got)) == n and sum(costs[i][k] for i, k in enumerate(got)) == best


def test_names():
    assert name_words("audio.genDur_ms") == ("audio", "gen", "dur", "ms")
    assert seeds(Version()) == {} and versions_matched(Version(), Version()) == {}


LAYOUTS = [("gen_dur", "latency_s", "voice"), ("audio_seconds", "latency_s", "voice"), ("audio_seconds", "gen_seconds", "ref_voice")]


def opaque(spark, shared, streams=12):
    """Streams whose names are all replaced by random ones from the second file on, with the expected changes."""
    rng = random.Random(7)
    files, want = [], set()
    for s in range(streams):
        names = LAYOUTS[s % 3]
        keys = dict.fromkeys(("utt", "text", "rtf", "steps"))
        for k in range(5):
            if k:
                keys = {x: "".join(rng.choices("bcdfghjklmnp", k=7)) for x in keys}
                names = tuple("".join(rng.choices("qrstvwxz", k=7)) for _ in range(3))
            start = 14 * k - (2 if shared and k else 0)
            rows = []
            for i in range(start, 14 * k + 14):
                r = random.Random(1000 * s + i)
                words = 3 + r.randrange(9)
                row = {"utt": f"utterance-{s}-{i}", "text": " ".join(r.choices(["river", "lamp", "reader", "of", "a"], k=words)), "rtf": round(r.uniform(0.01, 0.2), 4), "steps": r.randrange(60, 300)}
                row = {keys[x] or x: v for x, v in row.items()}
                row |= {names[0]: round(0.45 * words + r.uniform(0, 0.5), 3), names[1]: round(r.uniform(0.3, 2.5), 3), names[2]: f"speaker_{s}"}
                rows.append(row)
            files.append((10 * s + k, f"run{s}", 24 * k, rows))
            want |= {(10 * s + k, f, "renamed") for f in ("duration", "latency", "voice")} if k else set()
    return Drift(raw(spark, files)), want


def test_opaque_names_by_shared_records(spark, monkeypatch):
    drift, want = opaque(spark, True)
    assert set(found(drift)) == want


def test_opaque_names_by_sketches_alone(spark):
    drift, want = opaque(spark, False)
    got = set(found(drift))
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.95 * len(got)


def test_matching_decides(spark):
    """Without the matching of versions nothing but names that say it would be known."""
    with_it = {"voice": "ann"}
    a, b = Version(), Version()
    for i in range(12):
        a.add("s", "1", i, json.dumps({"utt": f"utterance {i}", "gen_dur": 1 + i / 7} | with_it))
        b.add("s", "2", i, json.dumps({"utt": f"utterance {i + 10}", "zq": 1 + (i + 10) / 7, "xx": "ann"}))
    assert versions_matched(b, a) == {"utt": "utt", "zq": "gen_dur", "xx": "voice"}
    assert seeds(b) == {} and seeds(a) == {"gen_dur": "duration", "voice": "voice"}


def test_sketches_merge_alike():
    rng = random.Random(4)
    values = [rng.choice([rng.random(), rng.randrange(30)]) for _ in range(3000)]
    whole, parts = Profile(), [Profile() for _ in range(7)]
    for i, v in enumerate(values):
        for p in (whole, parts[i % 7]):
            p.add("number", d.key_of("", float(v)), float(v), False, i % 50)
    rng.shuffle(parts)
    merged = parts[0]
    for p in parts[1:]:
        merged.merge(p)
    whole._shrink()
    assert merged.values == whole.values and merged.bound == whole.bound and merged.kinds == whole.kinds
    distinct = len({d.key_of("", float(v)) for v in values})
    assert len(whole.values) == d.VALUES and 0.6 * distinct < whole.distinct < 1.6 * distinct


def test_hot_file_in_many_parts(spark):
    """A file that is spread over tasks gives what it gives in one."""
    files = [(1, "s", 0, many(0, ("gen_dur", num), ("latency_s", num), ("voice", "a"), n=400)), (2, "s", 5, many(398, ("zq", num), ("latency_s", num), ("voice", "a"), n=400))]
    df = raw(spark, files)
    one, spread_ = (Drift(df.repartition(n)) for n in (1, 16))
    assert found(one) == found(spread_) == [(2, "duration", "renamed")]


def test_deep_paths_rejects_and_milliseconds(spark):
    deep = lambda i: {"utt": f"u{i}", "a": {"b": {"c": {"d": {"gen": {"dur": 1500 + 37 * i}}}}}}
    files = [(1, "s", 0, [{"utt": f"u{i}", "gen_dur": (1500 + 37 * i) / 1000} for i in range(12)]), (2, "s", 1, [deep(i) for i in range(10, 22)] + ["{", None, "[]", "{"])]
    drift = Drift(raw(spark, files))
    assert found(drift) == [(2, "duration", "renamed")]
    table = {(r["file_id"], r["utt"]): r["duration"] for r in drift.unified().collect()}
    assert table[2, "u15"] == 2.055 and table[1, "u3"] == 1.611
    assert sorted(str(r["payload"]) for r in drift.rejects().collect()) == ["None", "[]", "{", "{"]


def test_null_stream_time_and_line(spark):
    rows = [(1, None, None, None, '{"gen_dur": 2.5}', "", ""), (2, "s", None, 1, '{"voice": "a"}', "", ""), (None, "s", None, 1, "{}", "", "")]
    drift = Drift(spark.createDataFrame(rows, SCHEMA))
    assert found(drift) == []
    assert sorted((r["file_id"], r["duration"], r["voice"]) for r in drift.unified().collect()) == [(1, 2.5, None), (2, None, "a")]
