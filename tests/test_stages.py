import io
import json
import wave

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxmeter import config, infer, stages
from voxmeter.sources import discovery, tables


def wav(seconds, tone=300.0, rate=16_000, loud=0.4):
    x = (loud * 32767 * np.sin(2 * np.pi * tone * np.arange(int(seconds * rate)) / rate)).astype("<i2")
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(x.tobytes())
    return {"bytes": out.getvalue(), "path": None}


@pytest.fixture
def settings(tmp_path):
    bench = pd.DataFrame([(f"u{i}", "en-US", "ba de", "ba de", "s1" if i < 4 else "s2", wav(1 + i / 9, 200 + 40 * i)) for i in range(6)], columns=["utt", "lang", "text", "text_norm", "speaker_id", "prompt_audio"])
    (tmp_path / "bench" / "en-US").mkdir(parents=True)
    bench.to_parquet(tmp_path / "bench" / "en-US" / "main-0.parquet")
    clips = [("u0", wav(1.0), 1.0), ("u1", wav(0.005), 0.005), ("u2", wav(0.35), 0.35), ("u3", wav(1.0, loud=0.0), 1.0), ("u4", {"bytes": b"junk", "path": None}, None), ("zz", wav(0.7), 0.7)]
    for voice in ("ann_f", "bo_m"):
        (tmp_path / "synth" / f"en-US__{voice}").mkdir(parents=True)
        pd.DataFrame(clips, columns=["utt", "audio", "gen_dur"]).to_parquet(tmp_path / "synth" / f"en-US__{voice}" / "main-0.parquet")
    return {
        "run": {"name": "m", "cache_dir": str(tmp_path / "cache")}, "benchmark": {"path": str(tmp_path / "bench"), "languages": ["en-US"]}, "synthesis": {"path": str(tmp_path / "synth")},
        "voices": {"default": {"type": "per_row", "column": "prompt_audio"}}, "asr": {"primary": {"en-US": "whisper"}, "engines": {"whisper": {"batch": 4}, "gigaam": {}}},
        "sim": {"encoders": ["ecapa"]},
    }


def test_run(spark, settings):
    run = stages.Run(spark, config.parse(settings), only=["en-US__ann_f"])
    pools = run.run()
    asr = {r["utt"]: r for r in pools["asr"].collect()}
    assert set(asr) == {"u0", "u1", "u2", "u3", "u4", "zz"} and {r["asr"] for r in asr.values()} == {"whisper"}  # gigaam doesn't cover the language
    assert not asr["u0"]["missing"] and asr["u0"]["n_ref_words"] == 2 and asr["u0"]["subs"] + asr["u0"]["dels"] + asr["u0"]["ins"] > 0
    assert asr["u1"]["missing"] and asr["u1"]["failure"] is None and asr["u1"]["synth_dur"] == 0.0  # below the gate
    assert asr["u3"]["missing"] and "nothing to hear" in asr["u3"]["failure"] and asr["u3"]["synth_dur"] == 1.0
    assert asr["u4"]["missing"] and asr["u4"]["failure"] and asr["zz"]["n_ref_words"] == 0
    sim = {r["utt"]: r for r in pools["sim"].collect()}
    assert {u: r["unscored"] for u, r in sim.items()} == {"u0": None, "u1": "too_short", "u2": "too_short", "u3": "failed", "u4": "missing", "zz": "missing"}
    assert 0 < sim["u0"]["sim"] <= 1 + 1e-9 and "silence" in sim["u3"]["failure"]
    quality = {r["utt"]: r for r in pools["quality"].collect()}
    assert quality["u1"]["too_short"] and quality["u1"]["utmos"] is None and all(1 <= quality["u0"][s] <= 5 for s in infer.SCORES)
    one = {s["subset"]: s for s in run.cache.summary_of([u for u, _ in run.units(["asr"])])}["en-US__ann_f"]
    assert one["n_scored"] == 3 and one["n_missing"] == 3 and one["n_below_min_samples"] == 1 and not any(k.startswith("_") for k in one)


def test_only_what_changed_is_computed_again(spark, settings, monkeypatch):
    run = stages.Run(spark, config.parse(settings), only=["en-US__ann_f"])
    run.run(["asr"])
    computed = []
    real = stages.Run.asr
    monkeypatch.setattr(stages.Run, "asr", lambda self, r, s: computed.append((r.name, s.name)) or real(self, r, s))
    run.run(["asr"])
    assert computed == []
    both = stages.Run(spark, config.parse(settings))
    assert both.run(["asr"])["asr"].select("subset").distinct().count() == 2 and computed == [("whisper", "en-US__bo_m")]
    computed.clear()
    trial = stages.Run(spark, config.parse(settings), limit=2)
    assert trial.run(["asr"])["asr"].count() == 4 and len(computed) == 2
    changed = json.loads(json.dumps(settings))
    changed["text_normalization"] = {"fold_typographic_apostrophes": True}
    changed["asr"]["engines"]["whisper"]["beam"] = 5
    keys = [stages.Run(spark, config.parse(c), only=["en-US__bo_m"]).units(["asr"])[0][0].key for c in (settings, changed)]
    assert keys[0] != keys[1]


def test_errors(spark, settings):
    with pytest.raises(ValueError, match="no subset matches"):
        stages.Run(spark, config.parse(settings), only=["xx"]).subsets()
    df = spark.createDataFrame([(1,)], "utt int")
    with pytest.raises(ValueError, match="prompt_audio"):
        tables.required(df, ["utt", "prompt_audio"])
    cards = spark.createDataFrame([("- config_name:  main set ",), ("data: x",)], "line string")
    assert [r[0] for r in discovery.config_names(cards, "line").collect()] == ["main set"]


def test_encoders_take_one_clip(spark):
    calls = spark.range(5).select(F.array(F.col("id").cast("float") + 1, F.lit(0.5).cast("float")).alias("w"))
    ok = calls.select(infer.infer("enc1", infer.StubEncoder, F.col("w"), "array<double>", 1).alias("x")).select("x.error").collect()
    assert all(r[0] is None for r in ok)
    with pytest.raises(ValueError, match="one clip"):
        infer.StubEncoder()([[1.0], [2.0]])


def test_failures_of_judges(spark):
    class Flaky:
        """Fails for a batch of more than one and for the number 3; gives zeros for 4."""

        def __init__(self, scores):
            self.scores = scores

        def __call__(self, xs):
            if len(xs) > 1 or xs[0] == 3.0:
                raise RuntimeError("no")
            return [[0.0 if xs[0] == 4.0 else 2.0] * self.scores]

    v = F.col("id").cast("double")
    loaders = {"dnsmos": lambda: Flaky(4), "utmos": lambda: Flaky(1), "nisqa": lambda: Flaky(5)}
    got = {r["id"]: r["s"] for r in spark.range(1, 6, 1, 1).select("id", infer.judged_scores({j: v for j in loaders}, loaders).alias("s")).collect()}
    assert [got[i]["dnsmos_sig"] for i in range(1, 6)] == [2.0, 2.0, None, 0.0, 2.0]
    assert all(got[i]["utmos"] is None for i in range(1, 6))  # the chunk as a whole
    assert [got[i]["nisqa_mos"] for i in range(1, 6)] == [2.0, 2.0, None, None, 2.0]


def test_footer_reads(spark, tmp_path):
    spark.range(7).write.parquet(str(tmp_path / "t"))
    assert tables.column_names(spark, str(tmp_path / "t")) == ["id"] and tables.row_count(spark, str(tmp_path / "t")) == 7


def test_published_scale(spark):
    from voxmeter.operators import similarity

    rows = spark.createDataFrame([("ky", "ecapa", 0.5), ("ky", "ecapa", None)], "lang string, encoder string, sim double")
    scale = spark.createDataFrame([("ky", "ecapa", 0.1, 0.9, 3)], "lang string, encoder string, floor_mean double, anchor double, lang2 int")
    got = similarity.on_published_scale(rows, "sim", ["lang", "encoder"], scale).collect()
    assert [r["sim_norm"] for r in got] == [pytest.approx(0.5), None]
    with pytest.raises(Exception, match="no published scale for ky ecapa"):
        similarity.on_published_scale(rows, "sim", ["lang", "encoder"], scale.limit(0)).collect()


def test_command_line(spark, settings, tmp_path, capsys):
    from voxmeter.__main__ import main

    (tmp_path / "c.json").write_text(json.dumps(settings))
    assert main(["run", "--config", str(tmp_path / "c.json"), "--subset", "en-US__ann_f", "--stage", "asr", "--out", str(tmp_path / "out")]) == 0
    facts = json.loads((tmp_path / "out" / "summary.json").read_text())
    assert facts["run"] == "m" and facts["asr"][0]["n_scored"] == 3 and "_key" not in facts["asr"][0]
    assert spark.read.parquet(str(tmp_path / "out" / "pools" / "asr")).count() == 6
    assert "pools/asr" in capsys.readouterr().out and "pools/asr" in (tmp_path / "out" / "README.md").read_text()
    (tmp_path / "bad.json").write_text("{}")
    assert main(["run", "--config", str(tmp_path / "bad.json")]) == 2
