"""Queries over whole tables for the data problems of the core: copies, references, drifting schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.diff import diff_copies
from ..operators.drift import Drift
from ..operators.references import Entity, ForeignKey, ReferenceGraph
from ..sources.tables import table


def p1_differences(spark: SparkSession, root: str) -> DataFrame:
    """p1_found with the two values."""
    return diff_copies(table(spark, root, "sources"), table(spark, root, "sources_mirror"), "utt", ["text", "text_norm"], "sources", "mirror")


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return p1_differences(spark, root).select("utt", "finding")


def reference_graph(spark: SparkSession, root: str) -> ReferenceGraph:
    sources = table(spark, root, "sources")
    return ReferenceGraph.of(
        [
            Entity("asr", table(spark, root, "asr"), row_id="row_id", time="scored_at"),
            Entity("sources", sources, row_id="row_id", time="ingested_at", key="utt", begin="ingested_at", end="withdrawn_at"),
            Entity("speakers", table(spark, root, "speakers"), key="speaker_id", begin="registered_at", end="retired_at"),
        ],
        [ForeignKey("asr", "utt", "sources"), ForeignKey("sources", "speaker_id", "speakers"), ForeignKey("sources", "gt_speaker_id", "speakers")],
    )


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """The direct orphans among those that the cascade finds."""
    return reference_graph(spark, root).orphans().where("kind = 'direct'").drop("kind")


def p3_report(spark: SparkSession, root: str) -> DataFrame:
    """Orphans by table, field, month, kind (direct or inherited) and reason."""
    return reference_graph(spark, root).report()


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """Changes of the duration, latency and voice fields."""
    return Drift(table(spark, root, "synthesis_raw")).changes()


def p5_changes(spark: SparkSession, root: str) -> DataFrame:
    """Changes of every column, matched from file to file."""
    return Drift(table(spark, root, "synthesis_raw")).all_changes()


def p5_table(spark: SparkSession, root: str) -> DataFrame:
    """All records with one duration, one latency and one voice column."""
    return Drift(table(spark, root, "synthesis_raw")).unified()


def p5_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Rows whose payload doesn't parse: they are in no other table."""
    return Drift(table(spark, root, "synthesis_raw")).rejects()


_P1 = """
WITH l AS (SELECT DISTINCT utt, text, text_norm FROM sources), r AS (SELECT DISTINCT utt, text, text_norm FROM sources_mirror),
j AS (SELECT coalesce(l.utt, r.utt) AS utt, l.utt IS NULL AS no_l, r.utt IS NULL AS no_r,
             l.text AS lt, r.text AS rt, l.text_norm AS ln, r.text_norm AS rn
      FROM l FULL OUTER JOIN r ON l.utt = r.utt)
SELECT {utt}, 'only_in_sources' AS finding{none} FROM j WHERE no_r
UNION ALL SELECT {utt}, 'only_in_mirror'{none} FROM j WHERE no_l
UNION ALL SELECT {utt}, 'text'{text} FROM j WHERE NOT no_l AND NOT no_r AND lt IS DISTINCT FROM rt
UNION ALL SELECT {utt}, 'text_norm'{norm} FROM j WHERE NOT no_l AND NOT no_r AND ln IS DISTINCT FROM rn
"""

_DIRECT = """
life AS (SELECT utt, min(ingested_at) AS b, CASE WHEN count(withdrawn_at) = count(*) THEN max(withdrawn_at) END AS e FROM sources WHERE utt IS NOT NULL GROUP BY utt),
refs AS (
  SELECT 'asr' AS src_table, 'utt' AS field, a.row_id, a.scored_at AS t, l.utt IS NULL AS gone, l.b, l.e, a.utt AS ref
  FROM asr a LEFT JOIN life l ON a.utt = l.utt WHERE a.utt IS NOT NULL
  UNION ALL
  SELECT 'sources', 'speaker_id', s.row_id, s.ingested_at, p.speaker_id IS NULL, p.registered_at, p.retired_at, NULL
  FROM sources s LEFT JOIN speakers p ON s.speaker_id = p.speaker_id WHERE s.speaker_id IS NOT NULL
  UNION ALL
  SELECT 'sources', 'gt_speaker_id', s.row_id, s.ingested_at, p.speaker_id IS NULL, p.registered_at, p.retired_at, NULL
  FROM sources s LEFT JOIN speakers p ON s.gt_speaker_id = p.speaker_id WHERE s.gt_speaker_id IS NOT NULL),
judged AS (SELECT DISTINCT src_table, field, row_id, strftime(t, '%Y-%m') AS period, ref,
           CASE WHEN gone THEN 'missing' WHEN b > t THEN 'later' WHEN e <= t THEN 'deleted' END AS reason FROM refs)
"""

_P3_REPORT = f"""
WITH {_DIRECT},
bad AS (SELECT DISTINCT row_id FROM judged WHERE src_table = 'sources' AND reason IS NOT NULL),
badkeys AS (SELECT s.utt FROM sources s LEFT JOIN bad USING (row_id) WHERE s.utt IS NOT NULL GROUP BY s.utt HAVING count(*) = count(bad.row_id)),
everything AS (
  SELECT src_table, field, period, 'direct' AS kind, reason FROM judged WHERE reason IS NOT NULL
  UNION ALL
  SELECT src_table, field, period, 'inherited', 'inherited' FROM judged WHERE src_table = 'asr' AND reason IS NULL AND ref IN (SELECT utt FROM badkeys))
SELECT src_table, field, period, kind, reason, count(*) AS n FROM everything GROUP BY ALL
"""


# The layouts in use, for the oracle only: the operator isn't told any of these names.
_LAYOUTS = {
    "duration": ["$.gen_dur", "$.audio_seconds", "$.Audio_Seconds", "$.genDur", "$.length_sec", "$.clip_len_s", "$.dur_ms", "$.audio.seconds"],
    "latency": ["$.gen_seconds", "$.latency_s", "$.Gen_Seconds", "$.latencyS", "$.wall_s", "$.took", "$.gen_ms", "$.timing.gen"],
    "voice": ["$.voice", "$.ref_voice", "$.Voice", "$.refVoice", "$.spk", "$.voice_name", "$.prompt.voice"],
}


def _carriers() -> str:
    seen = " UNION ALL ".join(
        f"SELECT file_id, '{f}' AS field, '{p}' AS path, json_type(payload, '{p}') AS kind FROM okay WHERE json_type(payload, '{p}') IS NOT NULL" for f, ps in _LAYOUTS.items() for p in ps
    )
    return f"""WITH okay AS (SELECT file_id, payload FROM synthesis_raw WHERE json_valid(payload)), seen AS ({seen}),
per AS (SELECT file_id, field, path, CASE kind WHEN 'VARCHAR' THEN 'text' WHEN 'ARRAY' THEN 'list' ELSE 'number' END AS kind, count(*) AS n
        FROM seen WHERE kind NOT IN ('NULL', 'OBJECT') GROUP BY ALL),
carrier AS (SELECT file_id, field, arg_max(path, n) AS path, arg_max(kind, n) AS kind FROM per GROUP BY file_id, field)"""


def _p5() -> str:
    return f"""{_carriers()},
files AS (SELECT file_id, min(stream) AS stream, min(produced_at) AS produced FROM synthesis_raw GROUP BY file_id),
steps AS (SELECT file_id, lag(file_id) OVER (PARTITION BY stream ORDER BY produced, file_id) AS prev FROM files),
grid AS (SELECT s.file_id, s.prev, f.field FROM steps s CROSS JOIN (SELECT DISTINCT field FROM carrier) f WHERE prev IS NOT NULL),
cmp AS (SELECT g.file_id, g.field, n.path AS np, n.kind AS nk, o.path AS op, o.kind AS okind FROM grid g
         LEFT JOIN carrier n ON n.file_id = g.file_id AND n.field = g.field LEFT JOIN carrier o ON o.file_id = g.prev AND o.field = g.field)
SELECT file_id, field, 'added' AS change FROM cmp WHERE np IS NOT NULL AND op IS NULL
UNION ALL SELECT file_id, field, 'removed' FROM cmp WHERE np IS NULL AND op IS NOT NULL
UNION ALL SELECT file_id, field, 'renamed' FROM cmp WHERE np <> op
UNION ALL SELECT file_id, field, 'retyped' FROM cmp WHERE nk <> okind"""


def _p5_table() -> str:
    paths = sorted({p for ps in _LAYOUTS.values() for p in ps})
    held = " ".join(f"WHEN '{p}' THEN json_extract(payload, '{p}')" for p in paths)
    return f"""{_carriers()},
rec AS (SELECT DISTINCT file_id, line_no, payload FROM synthesis_raw WHERE json_valid(payload)),
val AS (SELECT r.file_id, r.line_no, r.payload, c.field, c.path, CASE c.path {held} END AS j FROM rec r JOIN carrier c USING (file_id)),
txt AS (SELECT *, CASE WHEN json_type(j) = 'ARRAY' THEN json_extract_string(j, '$[0]') WHEN json_type(j) <> 'NULL' THEN json_extract_string(j, '$') END AS t FROM val),
num AS (SELECT *, try_cast(replace(regexp_extract(t, '-?[0-9]+([.,][0-9]+)?'), ',', '.') AS DOUBLE) AS x, regexp_matches(t, '[a-z]') AS unit, (t LIKE '%ms%' OR (regexp_matches(path, '_ms$') AND NOT regexp_matches(t, '[a-z]'))) AS ms FROM txt),
sec AS (SELECT *, CASE WHEN ms THEN x * 0.001::DOUBLE ELSE x END AS seconds FROM num),
wide AS (SELECT file_id, line_no, payload, max(CASE WHEN field = 'duration' THEN seconds END) AS duration, max(CASE WHEN field = 'latency' THEN seconds END) AS latency, max(CASE WHEN field = 'voice' THEN t END) AS voice FROM sec GROUP BY ALL)
SELECT DISTINCT r.file_id, r.line_no, json_extract_string(r.payload, '$.utt') AS utt, round(duration, 6) AS duration, round(latency, 6) AS latency, voice
FROM rec r LEFT JOIN wide w ON r.file_id = w.file_id AND r.line_no = w.line_no AND r.payload = w.payload"""


def queries() -> dict:
    return {"p1_found": p1_found, "p1_differences": p1_differences, "p3_found": p3_found, "p3_report": p3_report, "p5_found": p5_found, "p5_changes": p5_changes, "p5_table": p5_table, "p5_rejects": p5_rejects}


def oracles() -> dict[str, str]:
    values = ", {0} AS left_value, {1} AS right_value".format
    return {
        "p1_found": _P1.format(utt="utt", none="", text="", norm=""),
        "p1_differences": _P1.format(utt="utt", none=values("NULL::VARCHAR", "NULL::VARCHAR"), text=values("lt", "rt"), norm=values("ln", "rn")),
        "p3_found": f"WITH {_DIRECT} SELECT src_table, field, row_id, period, reason FROM judged WHERE reason IS NOT NULL",
        "p3_report": _P3_REPORT,
        "p5_found": _p5(),
        "p5_table": _p5_table(),
        "p5_rejects": "SELECT DISTINCT file_id, line_no, payload FROM synthesis_raw WHERE NOT json_valid(payload)",
    }
