import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmeter import config, infer
from voxmeter.cache import ResultCache, Unit, fingerprint
from voxmeter.operators import similarity, stats
from voxmeter.plans import evaluation
from voxmeter.sources import discovery, sinks
from voxmeter.streaming import incremental


def test_bootstrap_invariants(spark):
    rows = spark.createDataFrame([(g, f"s{i % 5}", i % 3, 4) for g in ("a", None) for i in range(40)] + [("one", "s", 1, 2)] * 2 + [("none", None, 1, 2)], "g string, s string, e long, n long")
    e, n = F.col("e"), F.col("n")
    out = {r["g"]: r for r in stats.cluster_bootstrap(rows, ["g"], "s", e, n, replicates=200).collect()}
    assert out.keys() == {"a", None, "one"}
    assert out["one"]["lo"] == out["one"]["hi"] == out["one"]["point"] == 0.5
    assert out["a"]["lo"] <= out["a"]["point"] <= out["a"]["hi"] and out["a"]["n_clusters"] == 5 and out["a"]["lo"] == out[None]["lo"]
    same = stats.paired_bootstrap(rows, ["g"], "s", (e, n), (e, n), replicates=50).where("g = 'a'").first()
    assert (same["delta"], same["lo"], same["hi"], same["p_a_better"]) == (0, 0, 0, 0)
    assert stats.cluster_bootstrap(rows.limit(0), ["g"], "s", e, n, 10).count() == 0


def test_scale(spark):
    df = spark.createDataFrame([(0.1, 0.1, 0.9), (0.9, 0.1, 0.9), (0.5, 0.9, 0.1), (0.5, 0.5, 0.5), (0.5, None, 0.9)], "s double, f double, a double")
    assert [r[0] for r in df.select(similarity.sim_norm(F.col("s"), F.col("f"), F.col("a"))).collect()] == [0.0, 1.0, None, None, None]
    chunks = spark.createDataFrame([("v", 1, [1.0, 0.0]), ("v", 2, [0.0, 1.0]), ("v", 3, [1.0, 0.0]), ("w", 1, [1.0, 0.0])], "voice string, i int, e array<double>")
    got = {r["voice"]: (r["n_chunks"], r["anchor"]) for r in similarity.anchors(chunks, "voice", "i", "e").collect()}
    assert got == {"v": (3, 0.333333333), "w": (1, None)}


def test_first_eligible_falls_through(spark):
    df = spark.createDataFrame([("a", 1, 0.1, "x"), ("a", 2, 5.0, "y"), ("a", 3, 6.0, "z"), ("b", 1, 0.2, "x")], "s string, o int, d double, v string")
    assert [tuple(r) for r in similarity.first_eligible(df, ["s"], ["o"], F.col("d") > 1, "v").collect()] == [("a", "y")]


def test_inference_keeps_failures_to_their_row(spark):
    df = spark.createDataFrame([(1, "some words here"), (2, "123"), (3, None), (4, "more")], "i int, t string")
    got = {r["i"]: r for r in infer.transcribed(df, "t", batch=4).collect()}
    assert got[1]["failure"] is None and got[4]["hyp"] is not None and got[2]["failure"] == "ValueError: nothing to hear"
    assert got[3]["hyp"] is None and got[3]["failure"] is None
    assert infer.isolated(lambda x: x[:1], [1, 2]) == [(1, None), (2, None)]
    with pytest.raises(KeyError, match="stub_judge"):
        infer.model("unknown")
    assert infer.model("stub_judge") is infer.model("stub_judge")


def test_cache(spark, tmp_path):
    cache = ResultCache(spark, str(tmp_path / "cache"))
    a, b = Unit("asr", "x", {"limit": None}), Unit("asr", "x", {"limit": 5})
    assert a.key != b.key and cache.pending([a, b]) == [a, b] and cache.load(a) is None
    cache.save(a, spark.range(3), {"n": 3})
    cache.save(b, spark.range(1), {"n": 1})
    assert cache.pending([a, b, Unit("asr", "y", {})]) == [Unit("asr", "y", {})] and cache.load(a).count() == 3
    assert cache.pool([a]).count() == 3 and cache.summaries("asr").count() == 2
    assert ResultCache(spark, cache.root, resume=False).pending([a]) == [a]
    assert fingerprint({"a": 1, "b": 2}) == fingerprint({"b": 2, "a": 1})


GOOD = {
    "run": {"name": "m"}, "benchmark": {"path": "b", "languages": ["en-US"]}, "synthesis": {"path": "s"},
    "voices": {"default": {"type": "per_row", "column": "prompt_audio"}}, "asr": {"primary": {"en-US": "whisper"}, "engines": {"whisper": {"enabled": True, "batch": 16}}},
    "sim": {"encoders": ["ecapa"]},
}


def test_config():
    c = config.parse(GOOD)
    assert c.voice("any").column == "prompt_audio" and c.primary_for("en-US") == "whisper" and c.recognisers["whisper"].options == {"batch": 16}
    assert [r.name for r in c.recognisers_for("ky")] == ["whisper"] and not config.Recogniser("gigaam", True).covers("en-US")
    bad = json.loads(json.dumps(GOOD))
    bad["sim"] = {"encoders": ["x"], "batch": 4, "max_duration_sec": 3}
    bad["asr"] = {"engines": {"odd": {"languages": ["a"], "api_key_env": "VOXMETER_NO_SUCH_KEY"}}}
    bad["voices"] = {"v": {"type": "fixed_file"}, "w": {"type": "?"}}
    bad["stats"] = {"aggregation": "macro", "bootstrap": {"confidence": 2}}
    bad["report"] = {"push": {"folder": "../x"}}
    del bad["run"]
    with pytest.raises(config.ConfigError) as e:
        config.parse(bad)
    for part in ("run.name", "sim.batch", "max_duration", "'x'", "asr.primary", "odd", "NO_SUCH_KEY", "voices.v.path", "voices.w.type", "aggregation", "confidence", "push.folder"):
        assert part in str(e.value)


def test_env(tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# note\nVOX_A='1'\nVOX_B=2\nbroken\n")
    monkeypatch.setenv("VOX_B", "kept")
    monkeypatch.delenv("VOX_A", raising=False)
    assert config.load_env(tmp_path / ".env") == ["VOX_A"]


def test_discovery(spark, tmp_path):
    one = spark.createDataFrame([("u1", "t")], "utt string, text string").coalesce(1)
    for folder in ("en-US__ann_f", "ky__bo_m"):
        one.toPandas().to_parquet((tmp_path / folder).mkdir() or tmp_path / folder / "main-0.parquet")
    (tmp_path / "nested" / "en-US").mkdir(parents=True)
    one.toPandas().to_parquet(tmp_path / "nested" / "en-US" / "ann_f.parquet")
    flat = discovery.flat_subsets(spark, str(tmp_path))
    assert sorted(r["subset"] for r in flat.collect()) == ["en-US__ann_f", "ky__bo_m"]
    assert [r["subset"] for r in discovery.admitted(flat, None, ["ky__bo_m"]).collect()] == ["en-US__ann_f"]
    assert discovery.admitted(flat, []).count() == 0
    nested = discovery.nested_subsets(spark, str(tmp_path / "nested"), ["en-US"])
    assert [(r["subset"], r["voice"]) for r in nested.collect()] == [("en-US__ann_f", "ann_f")]
    scan = discovery.synthesis_scan(spark, [r["path"] for r in flat.collect()], {"key": "utt", "duration": "gen_dur"})
    assert scan.columns == ["key", "subset_lang", "subset_voice", "subset"] and {r["subset"] for r in scan.collect()} == {"en-US__ann_f", "ky__bo_m"}
    assert discovery.benchmark_scan(spark, str(tmp_path / "nested"), "en-US").count() == 1
    with pytest.raises(ValueError):
        discovery.benchmark_scan(spark, str(tmp_path), "nested", "none") if False else discovery.benchmark_scan(spark, str(tmp_path.parent), tmp_path.name)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 0.5, None)], "s string, x double, y int")
    empty = df.limit(0)
    text = sinks.markdown("T", {"one": df, "two": empty})
    assert "a\\|b | 0.5000 | — |" in text and "two" not in text
    files = sinks.stage({"one": df, "two": empty}, {"p": df}, tmp_path / "out", "T", {"é": 1})
    names = [p for p, _ in files]
    assert "README.md" in names and "summary.json" in names and any(p.startswith("pools/p/") for p in names)
    assert "é" in (tmp_path / "out" / "summary.json").read_text()
    assert {"MANIFEST.json"} < set(names) and "tables/one" in (tmp_path / "out" / "README.md").read_text()
    sinks.stage({"one": df}, {}, tmp_path / "out", "T", {"_key": 1, "run": "r"})  # what was staged may be staged again
    assert json.loads((tmp_path / "out" / "summary.json").read_text()) == {"run": "r"} and not (tmp_path / "out" / "tables" / "two").exists()
    sinks.stage({"one": df, "two": empty}, {"p": df}, tmp_path / "out", "T", {})
    (tmp_path / "mine").mkdir()
    (tmp_path / "mine" / "kept.txt").write_text("x")
    with pytest.raises(FileExistsError):
        sinks.stage({"one": df}, {}, tmp_path / "mine", "T", {})
    assert (tmp_path / "mine" / "kept.txt").is_file()
    assert sinks.read_csv(spark, str(tmp_path / "out/tables/two"), "s string, x double, y int").count() == 0
    assert sinks.interval_text(None, 1.0) == "—" and sinks.percent_text(0.5) == "50.0%" and sinks.folder_for("x-{date}").startswith("x-2")


def test_published_calibration(spark, tmp_path):
    (tmp_path / "sim.csv").write_text("lang,encoder,anchor,floor mean,floor p95\nky,ecapa,0.5593,0.1,0.2\n")
    row = discovery.published_calibration(spark, str(tmp_path / "sim.csv")).first()
    assert (row["anchor"], row["floor_p95"], row["floor_pairs"]) == (0.5593, 0.2, None)


def test_stream_equals_batch(spark, tmp_path):
    from datetime import datetime

    rows = [(i, "whisper", False, i % 3, 0, 0, 5, datetime(2025, 1, 1 + i % 4)) for i in range(20)] * 2
    df = spark.createDataFrame(rows, "row_id long, asr string, missing boolean, subs long, dels long, ins long, n_ref_words long, scored_at timestamp_ntz")
    # a row far ahead closes the windows before it
    late = spark.createDataFrame([(99, "mms", False, 0, 0, 0, 5, datetime(2026, 1, 1))], df.schema)
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = incremental.keep_rates(incremental.arriving(spark, str(tmp_path / "in"), df), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted(tuple(r) for r in incremental.windowed_rates(df).collect())
    assert got == want and len(got) == 4


def test_word_errors_of_pairs_with_many_distinct_words(spark, tmp_path):
    """The queries, too, score pairs of more distinct words than the alphabet of the short way has."""
    many = [f"w{i}" for i in range(5000)]
    ref, hyp = " ".join(many), " ".join(["new", *many[1:10], *many[12:], "end"])
    rows = [(1, ref, hyp, 1, 2, 1, 5000), (2, ref, hyp, 0, 1, 0, 5000), (3, None, ref, 0, 0, 5000, 0), (4, "a b", "a c", 1, 0, 0, 2), (5, None, ref, 0, 0, 4999, 0)]
    df = spark.createDataFrame([(*r, False) for r in rows], "row_id long, ref_norm string, hyp_norm string, subs long, dels long, ins long, n_ref_words long, missing boolean")
    df.write.parquet(str(tmp_path / "asr.parquet"))
    assert {r["row_id"]: r["errors"] for r in evaluation.word_errors(spark, str(tmp_path)).collect()} == {1: 4, 2: 4, 3: 5000, 4: 1, 5: 5000}
    assert sorted(tuple(r) for r in evaluation.score_invariants(spark, str(tmp_path)).collect()) == [(2, True, False), (5, False, False)]


def test_intervals_agree_with_plain_resampling(spark):
    """Poisson weights give the interval that drawing clusters with replacement gives."""
    rng = np.random.default_rng(3)
    n = rng.integers(5, 40, 60)
    a = rng.binomial(n, rng.uniform(0.05, 0.3, 60))
    rows = spark.createDataFrame([("g", f"s{i}", int(x), int(y)) for i, (x, y) in enumerate(zip(a, n))], "k string, c string, a long, n long")
    got = stats.cluster_bootstrap(rows, ["k"], "c", F.col("a"), F.col("n")).first()
    draws = rng.integers(0, 60, (20_000, 60))
    lo, hi = np.quantile(a[draws].sum(1) / n[draws].sum(1), [0.025, 0.975])
    assert got["n_clusters"] == 60 and abs(got["point"] - a.sum() / n.sum()) < 1e-9
    assert abs(got["lo"] - lo) < 0.12 * (hi - lo) and abs(got["hi"] - hi) < 0.12 * (hi - lo)


def test_one_cluster_and_empty_groups(spark):
    rows = spark.createDataFrame([("one", "s", 1, 4), ("one", "s", 2, 4), ("none", None, 1, 4), ("zero", "s", 0, 0), ("zero", "t", 0, 0)], "k string, c string, a long, n long")
    got = {r["k"]: r for r in stats.cluster_bootstrap(rows, ["k"], "c", F.col("a"), F.col("n")).collect()}
    assert set(got) == {"one", "zero"} and got["one"]["lo"] == got["one"]["hi"] == got["one"]["point"] == 0.375
    assert got["zero"]["lo"] is None and got["zero"]["point"] is None


def test_resampling_shuffles_no_draws(spark):
    """Replicates are summed before the shuffle; nothing is joined and no window numbers the clusters."""
    rows = spark.createDataFrame([("g", "s", 1, 2)], "k string, c string, a long, n long")
    plan = stats.resamples(stats.cluster_sums(rows, ["k"], "c", {"_a": F.col("a")}), ["k"], ["_a"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and "partial_sum" in plan
