"""The evaluation's queries as SQL for DuckDB on the same tables.

The queries are written apart from the operators; of these only fixed values are taken: number words, punctuation,
apostrophes, and the limits of the bootstrap's weights.
"""

from __future__ import annotations

from ..functions import numbers as N
from ..functions.numbers import NUMBER_LANGUAGES, say
from ..functions.text import PUNCTUATION, TYPOGRAPHIC_APOSTROPHES
from ..operators.stats import poisson_limits

POOL = "pool AS (SELECT DISTINCT * FROM asr)"
BENCH = "bench AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY utt ORDER BY ingested_at, row_id) AS rn FROM sources WHERE utt IS NOT NULL) WHERE rn = 1)"
SCORED = "scored AS (SELECT *, subs + dels + ins AS err FROM pool WHERE NOT missing AND subs IS NOT NULL AND dels IS NOT NULL AND ins IS NOT NULL AND n_ref_words IS NOT NULL)"
ANCHORED = """anchored AS (
SELECT * FROM (SELECT s.*, b.anchor_n_ref_words AS h_n,
  CASE WHEN s.asr IN ('whisper', 'gigaam') THEN b.anchor_subs + b.anchor_dels + b.anchor_ins
             WHEN s.asr = 'mms' THEN b.anchor_subs_mms + b.anchor_dels_mms + b.anchor_ins_mms
             WHEN s.asr = 'elevenlabs' THEN b.anchor_subs_scribe + b.anchor_dels_scribe + b.anchor_ins_scribe END AS h_err
FROM scored s JOIN bench b USING (utt)) WHERE h_err IS NOT NULL AND h_n IS NOT NULL)"""
PAIRS = """pairs AS (
SELECT a.subset, a.asr AS a, b.asr AS b, a.speaker_id, a.err AS err_a, a.n_ref_words AS n_a, b.err AS err_b, b.n_ref_words AS n_b,
       coalesce(a.hyp_norm = b.hyp_norm, false) AS same
FROM scored a JOIN scored b ON a.subset = b.subset AND a.utt = b.utt AND a.asr < b.asr)"""


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _finite(x: str) -> str:
    return f"CASE WHEN isfinite({x}) THEN {x} END"


SPACES = "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def _said(text: str) -> str:
    """Plain integers up to 100 as words, each language in its own branch."""
    branches = []
    for lang in sorted(set(NUMBER_LANGUAGES.values())):
        e = text
        for n in (3, 4, 7, 9, 12, 15, 20, 40, 60, 100):
            # twice, as neighbours share a boundary
            for _ in range(2):
                e = f"regexp_replace({e}, '(^|[^0-9]){n}($|[^0-9])', '\\1{say(n, lang)}\\2', 'g')"
        locales = ", ".join(quoted(k) for k, v in NUMBER_LANGUAGES.items() if v == lang)
        branches.append(f"WHEN lang IN ({locales}) AND regexp_matches({text}, '[0-9]') THEN {e}")
    return f"CASE {' '.join(branches)} ELSE {text} END"


def _norm(text: str) -> str:
    said = _said(f"lower(nfc_normalize({text}))")
    plain = f"translate({said}, {quoted(PUNCTUATION + SPACES)}, {quoted(' ' * len(PUNCTUATION + SPACES))})"
    return f"coalesce(trim(regexp_replace({plain}, '\\s+', ' ', 'g')), '')"


NORMED = f"normed AS (SELECT row_id, lang, {_norm('text')} AS norm, coalesce(text_norm, '') AS stored FROM sources)"


def _coded(unit: str) -> str:
    """Words or characters of both texts as letters from '!' on: DuckDB counts bytes."""
    split = {"word": "list_filter(string_split(coalesce({0}, ''), ' '), lambda w: w <> '')", "char": "list_filter(string_split(coalesce({0}, ''), ''), lambda w: w <> '')"}[unit]
    r, h = split.format("ref_norm"), split.format("hyp_norm")
    one = "array_to_string(list_transform({0}, lambda w: chr((32 + list_position(v, w))::INTEGER)), '')"
    return f"""WITH {POOL}, l AS (SELECT row_id, {r} AS r, {h} AS h FROM pool WHERE NOT missing),
l2 AS (SELECT *, list_distinct(list_concat(r, h)) AS v FROM l)
SELECT row_id, levenshtein({one.format('r')}, {one.format('h')})::BIGINT AS errors, len(r)::BIGINT AS n_ref FROM l2"""


def _summary(keys: str, source: str = "pool") -> str:
    return f"""SELECT {keys}, count(*) FILTER (NOT missing) AS n_scored, count(*) FILTER (missing) AS n_missing,
count(*) FILTER (NOT missing AND n_ref_words = 0) AS n_empty_ref, count(failure) AS n_transcription_failures,
count(*) FILTER (missing AND failure IS NULL) AS n_below_min_samples,
count(DISTINCT CASE WHEN NOT missing THEN speaker_id END) AS n_clusters,
round(sum(subs + dels + ins)::DOUBLE / nullif(sum(n_ref_words), 0)::DOUBLE, 9) AS wer_corpus,
round(avg((subs + dels + ins)::DOUBLE / nullif(n_ref_words, 0)), 9) AS wer_macro,
round(sum(cer_err)::DOUBLE / nullif(sum(n_ref_chars), 0)::DOUBLE, 9) AS cer_corpus,
round(avg(CASE WHEN NOT missing THEN (subs + dels + ins = 0)::INT::DOUBLE END), 9) AS exact_match,
round(avg(((subs + dels + ins)::DOUBLE / nullif(n_ref_words, 0) > 0.5)::INT::DOUBLE), 9) AS catastrophic_rate
FROM {source} GROUP BY {keys}"""


def _boot(name: str, rows: str, keys: list[str], cluster: str, sums: dict[str, str], replicates: int = 2000) -> str:
    """CTEs <name>_c (clusters), <name>_r (replicates): the weighted sums of clusters by keys and rep."""
    ks = "".join(f"{k}, " for k in keys)
    h = "(20260725 + (rep + 1) * 1103515245 % 2147483647 + (c + 1) * 69069 % 2147483647) % 2147483647"
    mix = "({0} * {0} % 2147483647 * 48271 + 11) % 2147483647".format
    sums_sql = ", ".join(f"sum(({e})::DOUBLE) AS {n}" for n, e in sums.items())
    notnull = " AND ".join(f"({e}) IS NOT NULL" for e in sums.values())
    weight = "CASE " + " ".join(f"WHEN h2 < {x} THEN {k}" for k, x in enumerate(poisson_limits())) + f" ELSE {len(poisson_limits())} END"
    out = ", ".join(f"sum(w * {n}) AS {n}" for n in sums)
    return f"""{name}_c AS (SELECT {ks}{cluster} AS cl, {sums_sql}, ('0x' || left(md5(cl::VARCHAR), 15))::BIGINT % 2147483647 AS c FROM {rows} WHERE {cluster} IS NOT NULL AND {notnull} GROUP BY {ks}cl),
{name}_h AS (SELECT *, {mix('h1')} AS h2 FROM (SELECT *, {mix('h0')} AS h1 FROM (SELECT *, {h} AS h0 FROM {name}_c, range({replicates}) AS t(rep)))),
{name}_r AS (SELECT {ks}rep, {out} FROM (SELECT *, {weight} AS w FROM {name}_h) GROUP BY {ks}rep)"""


def _band(value: str) -> str:
    return f"round(quantile_cont({value}, 0.025), 9) AS lo, round(quantile_cont({value}, 0.975), 9) AS hi"


def _cluster(name: str, rows: str, keys: list[str], cluster: str, num: str, den: str, replicates: int = 2000) -> tuple[str, str]:
    ctes = _boot(name, rows, keys, cluster, {"sa": num, "sn": den}, replicates)
    ks = ", ".join(keys)
    group = f" GROUP BY {ks}" if keys else ""
    comma = f"{ks}, " if keys else ""
    on = " AND ".join(f"p.{k} IS NOT DISTINCT FROM b.{k}" for k in keys) or "true"
    final = f"""SELECT {''.join(f'p.{k}, ' for k in keys)}n_clusters, point, lo, hi
FROM (SELECT {comma}count(*) AS n_clusters, round(sum(sa) / nullif(sum(sn), 0), 9) AS point FROM {name}_c{group}) p
JOIN (SELECT {comma}{_band('sa / nullif(sn, 0)')} FROM {name}_r{group}) b ON {on}"""
    return ctes, final


def _paired(name: str, rows: str, keys: list[str], a: str, an: str, b: str, bn: str) -> tuple[str, str]:
    ctes = _boot(name, rows, keys, "speaker_id", {"sa": a, "sna": an, "sb": b, "snb": bn})
    ks = ", ".join(keys)
    delta = "(sa / nullif(sna, 0) - sb / nullif(snb, 0))"
    ra, rb = "sum(sa) / nullif(sum(sna), 0)", "sum(sb) / nullif(sum(snb), 0)"
    on = " AND ".join(f"p.{k} IS NOT DISTINCT FROM q.{k}" for k in keys)
    final = f"""SELECT {''.join(f'p.{k}, ' for k in keys)}n_clusters, rate_a, rate_b, delta, lo, hi, p_a_better
FROM (SELECT {ks}, count(*) AS n_clusters, round({ra}, 9) AS rate_a, round({rb}, 9) AS rate_b, round({ra} - {rb}, 9) AS delta FROM {name}_c GROUP BY {ks}) p
JOIN (SELECT {ks}, {_band(delta)}, round(avg(({delta} < 0)::INT::DOUBLE), 9) AS p_a_better FROM {name}_r GROUP BY {ks}) q ON {on}"""
    return ctes, final


def _with(*parts: str) -> str:
    *ctes, final = parts
    return f"WITH {', '.join(ctes)} {final}"


_WER = _cluster("w", "scored", ["lang", "asr"], "speaker_id", "err", "n_ref_words")
_WER_SUBSET = _cluster("w", "scored", ["subset", "asr"], "speaker_id", "err", "n_ref_words")
_MACRO = _cluster("w", "(SELECT * FROM scored WHERE n_ref_words > 0)", ["lang"], "speaker_id", "round(err / n_ref_words, 9)::DECIMAL(20,9)", "1")
_CATA = _cluster("w", "(SELECT * FROM scored WHERE n_ref_words > 0)", ["lang"], "speaker_id", "(err / n_ref_words > 0.5)::INT", "1")
_ANCHOR = _paired("p", "anchored", ["lang", "asr"], "err", "n_ref_words", "h_err", "h_n")
_ANCHOR_SUBSET = _paired("p", "anchored", ["subset", "asr"], "err", "n_ref_words", "h_err", "h_n")
_PAIR = _paired("p", "pairs", ["subset", "a", "b"], "err_a", "n_a", "err_b", "n_b")
_ORDERS = _cluster("o", "(SELECT o_orderpriority, o_custkey, round(l_extendedprice * 100)::BIGINT AS cents, round(l_discount * 100)::BIGINT AS percent FROM lineitem JOIN orders ON l_orderkey = o_orderkey)", ["o_orderpriority"], "o_custkey", "cents * percent", "cents * 100")
_IDENTICAL = "ident AS (SELECT subset, a, b, count(*) AS n_shared, round(avg(same::INT::DOUBLE), 9) AS identical FROM pairs GROUP BY ALL HAVING count(*) >= 2)"

_INTELLIGIBILITY = _with(
    POOL, SCORED, BENCH, ANCHORED, _WER_SUBSET[0], _ANCHOR_SUBSET[0], f"su AS ({_summary('subset, asr')})", f"wb AS ({_WER_SUBSET[1]})", f"pb AS ({_ANCHOR_SUBSET[1]})",
    """SELECT su.*, CASE WHEN n_scored > 1 THEN wb.lo END AS wer_lo, CASE WHEN n_scored > 1 THEN wb.hi END AS wer_hi, pb.rate_b AS anchor_wer, pb.delta,
    pb.lo AS delta_lo, pb.hi AS delta_hi, pb.p_a_better FROM su LEFT JOIN wb USING (subset, asr) LEFT JOIN pb USING (subset, asr)""",
)

_DUR = f"""dur AS (SELECT p.*, {_finite('p.synth_dur')} AS sd, CASE WHEN isfinite(b.gt_dur) AND b.gt_dur > 0 THEN {_finite('p.synth_dur')} / b.gt_dur END AS ratio
FROM pool p LEFT JOIN bench b USING (utt))"""
_HAS_APOSTROPHE = "coalesce(regexp_matches(hyp_raw, '[" + TYPOGRAPHIC_APOSTROPHES + "]'), false)"

_FAILURES = _with(POOL, BENCH, _DUR, f"""SELECT subset, lang, voice, asr,
round(avg(coalesce(sd < 0.3, false)::INT::DOUBLE), 9) AS empty_output,
round(avg((CASE WHEN NOT missing THEN (subs + dels + ins)::DOUBLE / nullif(n_ref_words, 0) END > 0.5)::INT::DOUBLE), 9) AS catastrophic,
round(avg((ratio > 2.0)::INT::DOUBLE), 9) AS runaway,
round(avg((ratio < 0.5)::INT::DOUBLE), 9) AS truncated,
round(quantile_cont(ratio, 0.5), 9) AS median_ratio, round(max(ratio), 9) AS max_ratio,
count(failure) + count(*) FILTER (missing AND failure IS NULL) AS unreadable, count(*) FILTER (NOT missing AND {_HAS_APOSTROPHE}) AS n_typographic
FROM dur WHERE asr = CASE WHEN lang = 'ky' THEN 'gigaam' WHEN lang IN ('en-US', 'es-MX', 'es-ES', 'nl-NL', 'pt-BR') THEN 'whisper' END GROUP BY subset, lang, voice, asr""")  # fmt: skip

_EMPTY = f"clips AS (SELECT subset, utt, min({_finite('synth_dur')}) AS d FROM pool GROUP BY subset, utt), em AS (SELECT subset, count(*) FILTER (d < 0.3) AS n_empty, count(*) AS n_clips FROM clips GROUP BY subset)"

_AUDIT = _with(POOL, BENCH, """cl AS (SELECT subset, lang, utt, any_value(ref_norm) AS ref_norm FROM pool WHERE utt IS NOT NULL GROUP BY subset, lang, utt),
per AS (SELECT c.subset, c.lang, count(*) AS n_synthesis, count(b.utt) AS n_joined,
  count(*) FILTER (b.utt IS NOT NULL AND trim(coalesce(c.ref_norm, '')) <> trim(coalesce(b.text_norm, ''))) AS n_text_mismatch
  FROM cl c LEFT JOIN bench b ON c.utt = b.utt GROUP BY c.subset, c.lang),
sizes AS (SELECT lang, count(*) AS n_benchmark FROM bench GROUP BY lang)""",
"""SELECT per.*, n_benchmark, n_synthesis - n_joined AS n_unknown, n_benchmark - n_joined AS n_not_synthesised,
(n_synthesis - n_joined = 0) AND (n_benchmark - n_joined = 0) AND n_text_mismatch = 0 AS clean FROM per LEFT JOIN sizes USING (lang)""")  # fmt: skip

# embeddings: references, synthetic vectors, cosines
_DOT = "list_sum(list_transform(list_zip({0}, {1}), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"
REFS = "refs AS (SELECT label, arg_min(embedding, vec_id)::DOUBLE[] AS ref FROM embeddings WHERE len(embedding) > 0 GROUP BY label)"
SYNTH = f"""mix AS (SELECT vec_id, label, ref, list_transform(list_zip(ref, embedding::DOUBLE[]), lambda z: z[1] * 0.7::DOUBLE + z[2] * 0.3::DOUBLE) AS m FROM embeddings JOIN refs USING (label)),
synth AS (SELECT vec_id, label, ref, list_transform(m, lambda x: x / sqrt({_DOT.format('m', 'm')})) AS v FROM mix),
sims AS (SELECT vec_id, label, round({_DOT.format('v', 'ref')}, 9) AS sim FROM synth)"""
FLOOR = f"""fl AS (SELECT a.label, round(avg({_DOT.format('a.ref', 'b.ref')}), 9) AS floor_mean, round(quantile_cont({_DOT.format('a.ref', 'b.ref')}, 0.95), 9) AS floor_p95, count(*) AS floor_pairs
FROM refs a JOIN refs b ON a.label <> b.label GROUP BY a.label)"""
CHUNKS = f"""ch AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM synth) WHERE rn <= 8),
an0 AS (SELECT a.label, avg({_DOT.format('a.v', 'b.v')}) AS anchor FROM ch a JOIN ch b ON a.label = b.label AND a.vec_id < b.vec_id GROUP BY a.label),
an AS (SELECT label, count(*)::INTEGER AS n_chunks, round(any_value(an0.anchor), 9) AS anchor FROM ch LEFT JOIN an0 USING (label) GROUP BY label)"""
CAL = """cal AS (SELECT fl.*, n_chunks, anchor, round(anchor - floor_mean, 9) AS usable_range, CASE WHEN anchor IS NULL THEN 'none' ELSE 'intra_session' END AS anchor_kind FROM fl LEFT JOIN an USING (label))"""
_SIMBOOT = _cluster("s", "(SELECT label, sim::DECIMAL(12,9) AS sim FROM sims)", [], "label", "sim", "1")
HUMAN = """human AS (SELECT lang, encoder, count(*) AS n, round(avg(s), 9) AS anchor, round(quantile_cont(s, 0.05), 9) AS p05 FROM (
SELECT lang, 'wavlm_sv' AS encoder, anchor_sim_wavlm_sv AS s FROM bench UNION ALL SELECT lang, 'wavlm_ft', anchor_sim_wavlm_ft FROM bench
UNION ALL SELECT lang, 'ecapa', anchor_sim_ecapa FROM bench) WHERE isfinite(s) GROUP BY lang, encoder)"""

_MEANS = ("wer", "gen_dur", "latency_s", "synth_dur")
_TOO = _finite("synth_dur")
_D = _finite("prompt_dur")
_CHUNK = "CASE WHEN least(4.0::DOUBLE, d / 2) >= 2.0 THEN least(4.0::DOUBLE, d / 2) END"

def _list(words: list[str]) -> str:
    return "[" + ", ".join(map(quoted, words)) + "]"


# Number words below a million, put together apart from the operators: 0 to 999 by hundreds and tens, then thousands.
_SAID = f"""base AS (SELECT n::BIGINT AS n, n // 100 AS h, n % 100 AS r, (n % 100) // 10 AS t, n % 10 AS o, {_list(N.EN_ONES)} AS en, {_list(N.ES_ONES)} AS es, {_list(N.PT_ONES)} AS pt, {_list(N.NL_ONES)} AS nl FROM range(1000) AS x(n)),
two AS (SELECT *,
  CASE WHEN r < 20 THEN en[r + 1] ELSE {_list(N.EN_TENS)}[t + 1] || CASE WHEN o > 0 THEN '-' || en[o + 1] ELSE '' END END AS en2,
  CASE WHEN r < 30 THEN es[r + 1] ELSE {_list(N.ES_TENS)}[t + 1] || CASE WHEN o > 0 THEN ' y ' || es[o + 1] ELSE '' END END AS es2,
  CASE WHEN r < 20 THEN pt[r + 1] ELSE {_list(N.PT_TENS)}[t + 1] || CASE WHEN o > 0 THEN ' e ' || pt[o + 1] ELSE '' END END AS pt2,
  CASE WHEN r < 20 THEN nl[r + 1] ELSE CASE WHEN o > 0 THEN nl[o + 1] || CASE WHEN nl[o + 1] LIKE '%e' THEN 'ën' ELSE 'en' END ELSE '' END || {_list(N.NL_TENS)}[t + 1] END AS nl2 FROM base),
small AS (SELECT n, r,
  CASE WHEN h = 0 THEN en2 ELSE en[h + 1] || ' hundred' || CASE WHEN r > 0 THEN ' and ' || en2 ELSE '' END END AS en,
  CASE WHEN n = 100 THEN 'cien' WHEN h = 0 THEN es2 ELSE {_list(N.ES_HUNDREDS[1:])}[h] || CASE WHEN r > 0 THEN ' ' || es2 ELSE '' END END AS es,
  CASE WHEN n = 100 THEN 'cem' WHEN h = 0 THEN pt2 ELSE {_list(N.PT_HUNDREDS[1:])}[h] || CASE WHEN r > 0 THEN ' e ' || pt2 ELSE '' END END AS pt,
  CASE WHEN h = 0 THEN nl2 ELSE CASE WHEN h > 1 THEN nl[h + 1] ELSE '' END || 'honderd' || CASE WHEN r > 0 THEN nl2 ELSE '' END END AS nl FROM two),
keys AS (SELECT DISTINCT o_custkey::BIGINT AS k FROM orders)"""
_SAID_KEYS = """SELECT k AS n,
CASE WHEN k < 1000 THEN b.en ELSE a.en || ' thousand' || CASE WHEN b.n = 0 THEN '' WHEN b.n < 100 THEN ' and ' || b.en ELSE ', ' || b.en END END AS en,
CASE WHEN k < 1000 THEN b.es ELSE CASE WHEN a.n = 1 THEN 'mil' ELSE regexp_replace(regexp_replace(a.es, 'veintiuno$', 'veintiún'), 'uno$', 'un') || ' mil' END || CASE WHEN b.n = 0 THEN '' ELSE ' ' || b.es END END AS es,
CASE WHEN k < 1000 THEN b.pt ELSE CASE WHEN a.n = 1 THEN 'mil' ELSE a.pt || ' mil' END || CASE WHEN b.n = 0 THEN '' WHEN b.n < 100 OR b.n % 100 = 0 THEN ' e ' || b.pt ELSE ' ' || b.pt END END AS pt,
CASE WHEN k < 1000 THEN b.nl ELSE CASE WHEN a.n = 1 THEN '' ELSE a.nl END || 'duizend' || CASE WHEN b.n = 0 THEN '' ELSE b.nl END END AS nl
FROM keys JOIN small a ON a.n = k // 1000 JOIN small b ON b.n = k % 1000"""

# JSON text within JSON text
AUDIO = '{\\"pad_ms\\":30,\\"peak_dbfs\\":-1.0,\\"resampler\\":\\"soxr_hq\\",\\"target_sample_rate\\":16000,\\"vad\\":true}'


def _key(*parts: tuple[str, str]) -> str:
    """A fingerprint from names and SQL of values as JSON."""
    body = " || ',' || ".join(f"'\"{n}\":' || {v}" for n, v in sorted(parts))
    return f"left(sha256('{{' || {body} || '}}'), 16)"


def _text(x: str) -> str:
    return f"'\"' || {x} || '\"'"


_AUDIO, _SUBSET = ("audio", _text(f"'{AUDIO}'")), [("lang", _text("lang")), ("subset", _text("subset"))]
_UNIT = _key(("asr", _text("asr")), ("model", _text("model")), *_SUBSET, _AUDIO, ("options", _text("'{\\\"batch\\\":16}'")), ("fold_apostrophes", "'false'"), ("row_limit", "'0'"), ("schema", "'1'"))
_UNITS = f"u AS (SELECT subset, lang, asr, model, count(*) AS n, {_UNIT} AS key FROM pool GROUP BY subset, lang, asr, model)"
_JUDGED = """clips AS (SELECT subset, lang, voice, utt, max(CASE WHEN isfinite(synth_dur) THEN synth_dur END) AS d FROM pool WHERE utt IS NOT NULL GROUP BY subset, lang, voice, utt),
few AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subset ORDER BY utt) AS rn FROM clips) WHERE rn <= 10)"""
_SCORES = ("dnsmos_ovrl", "dnsmos_sig", "dnsmos_bak", "dnsmos_p808", "utmos", "nisqa_mos", "nisqa_noi", "nisqa_dis", "nisqa_col", "nisqa_loud")
_JUDGED += ", judged AS (SELECT subset, lang, voice, utt, coalesce(d < 0.3, true) AS too_short, " + ", ".join(
    f"CASE WHEN d >= 0.3 THEN 1 + 4 * ('0x' || left(md5('{s}:' || utt), 2))::BIGINT / 255::DOUBLE END AS {s}" for s in _SCORES
) + " FROM few)"

# The row of the edit table that the recursion has reached holds, for each prefix of the hypothesis, the cost and counts of
# the alignment that prefers a match, then a substitution, a deletion, an insertion.
_SDI = """RECURSIVE pool AS (SELECT DISTINCT * FROM asr),
w AS (SELECT row_id, list_filter(string_split(coalesce(ref_norm, ''), ' '), lambda x: x <> '') AS r, list_filter(string_split(coalesce(hyp_norm, ''), ' '), lambda x: x <> '') AS h
      FROM pool WHERE NOT missing AND ref_norm IS NOT NULL),
t AS (SELECT row_id, r, h, 0 AS i, list_transform(range(len(h) + 1), lambda j: {'c': j, 's': 0::BIGINT, 'd': 0::BIGINT, 'i': j}) AS row FROM w
UNION ALL
SELECT row_id, r, h, i + 1, list_reduce(range(1, len(h) + 1), lambda acc, j: list_append(acc,
  CASE WHEN r[i + 1] = h[j] AND row[j].c <= least(row[j + 1].c, acc[j].c) + 1 THEN row[j]
       WHEN row[j].c <= least(row[j + 1].c, acc[j].c) THEN {'c': row[j].c + 1, 's': row[j].s + 1, 'd': row[j].d, 'i': row[j].i}
       WHEN row[j + 1].c <= acc[j].c THEN {'c': row[j + 1].c + 1, 's': row[j + 1].s, 'd': row[j + 1].d + 1, 'i': row[j + 1].i}
       ELSE {'c': acc[j].c + 1, 's': acc[j].s, 'd': acc[j].d, 'i': acc[j].i + 1} END),
  [{'c': row[1].c + 1, 's': 0::BIGINT, 'd': row[1].d + 1, 'i': 0::BIGINT}]) FROM t WHERE i < len(r))
SELECT row_id, row[len(h) + 1].s AS subs, row[len(h) + 1].d AS dels, row[len(h) + 1].i AS ins FROM t WHERE i = len(r)
UNION ALL SELECT row_id, NULL, NULL, NULL FROM pool WHERE NOT missing AND ref_norm IS NULL"""

ORACLES: dict[str, str] = {
    "sdi_split": f"WITH {_SDI}",
    "said_keys": _with(_SAID, _SAID_KEYS),
    "worst_short_subset": _with(POOL, _EMPTY.replace("d < 0.3", "d < 2.0"), "SELECT * FROM em WHERE n_empty > 0 ORDER BY n_empty DESC, subset LIMIT 1"),
    "length_gates": _with(POOL, f"clips AS (SELECT subset, utt, min({_finite('synth_dur')}) AS d FROM pool GROUP BY subset, utt)", """SELECT subset, count(*) AS n_clips, count(*) FILTER (d < 0.01) AS n_too_short_to_hear,
count(*) FILTER (d < 0.4) AS n_too_short_to_embed, count(*) FILTER (d < 0.3) AS n_too_short_to_judge, count(*) FILTER (d < 0.3) AS n_empty FROM clips GROUP BY subset"""),
    "judged_clips": _with(POOL, _JUDGED, "SELECT * FROM judged"),
    "naturalness": _with(POOL, _JUDGED, "SELECT subset, lang, voice, count(*) FILTER (NOT too_short) AS n, count(*) FILTER (too_short) AS n_too_short_to_judge, " + ", ".join(f"round(avg({s}), 3) AS {s}" for s in _SCORES) + " FROM judged GROUP BY subset, lang, voice"),
    "stage_units": _with(POOL, _UNITS, "subs AS (SELECT subset, lang, count(DISTINCT utt) AS n_rows FROM pool GROUP BY subset, lang)", f"""SELECT DISTINCT 'asr' AS stage, subset || '__' || asr AS unit, key, n_rows AS passes FROM u JOIN subs USING (subset)
UNION ALL SELECT 'sim', subset || '__' || encoder, {_key(*_SUBSET, _AUDIO, ("row_limit", "'0'"), ("encoder", _text("encoder")), ("batch", "'1'"), ("least_samples", "'6400'"))}, n_rows FROM subs, (SELECT unnest(['wavlm_sv', 'wavlm_ft', 'ecapa']) AS encoder)
UNION ALL SELECT 'quality', subset, {_key(*_SUBSET, _AUDIO, ("row_limit", "'0'"), ("limit_per_voice", "'10'"))}, least(10, n_rows) FROM subs"""),
    "text_normalize": _with(NORMED, "SELECT row_id, norm FROM normed"),
    "norm_parity": _with(NORMED, "SELECT lang, count(*) AS n, count(*) FILTER (norm = stored) AS n_equal FROM normed GROUP BY lang"),
    "norm_differences": _with(NORMED, "SELECT row_id, lang, norm AS ours, stored FROM normed WHERE norm <> stored"),
    "norm_diagnostics": f"""SELECT lang, sum(length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{TYPOGRAPHIC_APOSTROPHES}', '')))::BIGINT AS apostrophes_folded,
sum(CASE WHEN lang IN ('en-US', 'es-ES', 'es-MX', 'nl-NL', 'pt-BR') THEN len(regexp_extract_all(coalesce(text, ''), '[0-9]+')) ELSE 0 END)::BIGINT AS digits_expanded,
sum(CASE WHEN lang IN ('en-US', 'es-ES', 'es-MX', 'nl-NL', 'pt-BR') THEN 0 ELSE len(regexp_extract_all(coalesce(text, ''), '[0-9]')) END)::BIGINT AS digits_left FROM sources GROUP BY lang""",
    "typographic_count": _with(POOL, f"SELECT subset, asr, count(*) FILTER ({_HAS_APOSTROPHE}) AS n_typographic FROM pool GROUP BY subset, asr"),
    "word_errors": _coded("word"),
    "char_errors": _coded("char"),
    "error_summary": _with(POOL, _summary("subset, asr")),
    "rates_by_lang": _with(POOL, _summary("lang, asr")),
    "rates_by_len": _with(POOL, _summary("asr, len_bin")),
    "cluster_bootstrap_wer": _with(POOL, SCORED, *_WER),
    "bootstrap_macro": _with(POOL, SCORED, *_MACRO),
    "bootstrap_catastrophic": _with(POOL, SCORED, *_CATA),
    "paired_bootstrap_anchor": _with(POOL, SCORED, BENCH, ANCHORED, *_ANCHOR),
    "anchor_rates": _with(BENCH, """ar AS (
SELECT lang, unnest(['whisper', 'gigaam']) AS asr, anchor_subs + anchor_dels + anchor_ins AS err, anchor_n_ref_words AS t, anchor_cer_err AS cerr, anchor_n_ref_chars AS ct FROM bench
UNION ALL SELECT lang, 'mms', anchor_subs_mms + anchor_dels_mms + anchor_ins_mms, anchor_n_ref_words, anchor_cer_err_mms, anchor_n_ref_chars FROM bench
UNION ALL SELECT lang, 'elevenlabs', anchor_subs_scribe + anchor_dels_scribe + anchor_ins_scribe, anchor_n_ref_words, anchor_cer_err_scribe, anchor_n_ref_chars FROM bench)""",
"""SELECT lang, asr, count(*) FILTER (err + t IS NOT NULL) AS n, round(sum(err) FILTER (t IS NOT NULL)::DOUBLE / nullif(sum(t) FILTER (err IS NOT NULL), 0)::DOUBLE, 9) AS anchor_wer,
count(*) FILTER (cerr + ct IS NOT NULL) AS n_cer, round(sum(cerr) FILTER (ct IS NOT NULL)::DOUBLE / nullif(sum(ct) FILTER (cerr IS NOT NULL), 0)::DOUBLE, 9) AS anchor_cer
FROM ar WHERE err + t IS NOT NULL OR cerr + ct IS NOT NULL GROUP BY lang, asr"""),
    "intelligibility": _INTELLIGIBILITY,
    "identical_transcripts": _with(POOL, SCORED, PAIRS, _IDENTICAL, "SELECT * FROM ident"),
    "disagreement": _with(POOL, SCORED, PAIRS, _IDENTICAL, _PAIR[0], f"pr AS ({_PAIR[1]})", "SELECT ident.*, rate_a, rate_b, delta, lo, hi, p_a_better FROM ident LEFT JOIN pr USING (subset, a, b)"),
    "failures": _FAILURES,
    "empty_clips": _with(POOL, _EMPTY, "SELECT * FROM em"),
    "worst_subset": _with(POOL, _EMPTY, "SELECT * FROM em WHERE n_empty > 0 ORDER BY n_empty DESC, subset LIMIT 1"),
    "missing_gates": _with(POOL, f"SELECT subset, count(*) FILTER ({_TOO} < 1.0) AS n_too_short, count(*) FILTER ({_TOO} >= 1.0) AS n_judged, count(*) FILTER ({_TOO} IS NULL) AS n_unknown FROM pool GROUP BY subset"),
    "join_audit": _AUDIT,
    "anti_missing_left": "SELECT DISTINCT subset, utt FROM asr WHERE utt IS NOT NULL AND utt NOT IN (SELECT utt FROM sources WHERE utt IS NOT NULL)",
    "anti_missing_right": "SELECT DISTINCT lang, utt FROM sources WHERE utt IS NOT NULL AND utt NOT IN (SELECT utt FROM asr WHERE utt IS NOT NULL)",
    "shared_utts": "SELECT subset, utt FROM asr WHERE asr = 'whisper' INTERSECT SELECT subset, utt FROM asr WHERE asr = 'mms'",
    "text_mismatch": _with(POOL, BENCH, "SELECT p.row_id, p.utt FROM pool p JOIN bench b USING (utt) WHERE trim(coalesce(p.ref_norm, '')) <> trim(coalesce(b.text_norm, ''))"),
    "carry_lookup": _with(POOL, BENCH, f"SELECT p.row_id, b.speaker_gender, b.gt_speaker_id, b.prompt_dur_bin, b.sim_ref_dur_bin, {_finite('b.gt_dur')} AS gt_dur FROM pool p LEFT JOIN bench b USING (utt)"),
    "work_plan": _with(POOL, "SELECT e.asr, s.subset, s.lang, s.n_rows FROM (SELECT DISTINCT asr, lang FROM pool) e JOIN (SELECT subset, lang, count(DISTINCT utt) AS n_rows FROM pool GROUP BY subset, lang) s USING (lang)"),
    "work_totals": _with(POOL, "SELECT e.asr, count(*) AS n_units, sum(s.n_rows)::BIGINT AS n_passes FROM (SELECT DISTINCT asr, lang FROM pool) e JOIN (SELECT subset, lang, count(DISTINCT utt) AS n_rows FROM pool GROUP BY subset, lang) s USING (lang) GROUP BY e.asr"),
    "work_overall": _with(POOL, "subs AS (SELECT subset, lang, count(DISTINCT utt) AS n FROM pool GROUP BY subset, lang)", """SELECT *, 3 * n_subsets AS n_sim_units, 3 * n_clips AS n_sim_passes
FROM (SELECT count(*) AS n_subsets, sum(n)::BIGINT AS n_clips FROM subs), (SELECT count(*) AS n_asr_units, sum(n)::BIGINT AS n_asr_passes FROM (SELECT DISTINCT asr, lang FROM pool) e JOIN subs USING (lang))"""),
    "limit_per_subset": _with(POOL, "SELECT subset, asr, utt, row_id FROM (SELECT *, row_number() OVER (PARTITION BY subset, asr ORDER BY utt, row_id) AS rn FROM pool WHERE utt IS NOT NULL) WHERE rn <= 10"),
    "dedup_first": _with(POOL, "SELECT subset, utt, row_id FROM (SELECT *, row_number() OVER (PARTITION BY subset, utt ORDER BY asr, row_id) AS rn FROM pool WHERE utt IS NOT NULL) WHERE rn = 1"),
    "union_pools": _with(POOL, """SELECT asr, lang, count(*) AS n, count(subset) AS n_subset, sum(subs)::BIGINT AS subs FROM (
SELECT asr, NULL::VARCHAR AS lang, subset, subs FROM pool UNION ALL SELECT NULL, lang, NULL, anchor_subs FROM sources) GROUP BY asr, lang"""),
    "float_means": _with(POOL, f"SELECT subset, count(*) AS n_rows, {', '.join(f'round(avg({_finite(c)}), 9) AS {c}_mean' for c in _MEANS)} FROM pool GROUP BY subset"),
    "row_counts": "SELECT subset, count(*) AS n_rows FROM asr GROUP BY subset",
    "cluster_ratio_orders": _with(*_ORDERS),
    "first_reference": "SELECT speaker_id, arg_min(utt, row_id) AS utt FROM sources WHERE speaker_id IS NOT NULL AND prompt_dur >= 3.0 GROUP BY speaker_id",
    "sim_scores": _with(REFS, SYNTH, "SELECT * FROM sims"),
    "sim_floor": _with(REFS, FLOOR, "SELECT * FROM fl"),
    "sim_anchor": _with(REFS, SYNTH, CHUNKS, "SELECT * FROM an"),
    "calibration_table": _with(REFS, SYNTH, FLOOR, CHUNKS, CAL, "SELECT * FROM cal"),
    "sim_summary": _with(REFS, SYNTH, FLOOR, CHUNKS, CAL, """SELECT label, count(*) AS n_rows, count(*) FILTER (sim IS NULL) AS n_missing, round(avg(sim), 6) AS mean, round(quantile_cont(sim, 0.5), 6) AS median,
round(quantile_cont(sim, 0.05), 6) AS p05, round(quantile_cont(sim, 0.95), 6) AS p95, round(stddev_samp(sim), 6) AS std,
round(avg(CASE WHEN anchor - floor_mean > 0 THEN (sim - floor_mean) / (anchor - floor_mean) END), 6) AS sim_norm_mean,
round(avg(coalesce(sim < floor_p95, false)::INT::DOUBLE), 9) AS below_floor_p95, max(floor_mean) AS floor_mean, max(anchor) AS anchor
FROM sims LEFT JOIN cal USING (label) GROUP BY label"""),
    "similarity_bootstrap": _with(REFS, SYNTH, *_SIMBOOT),
    "human_similarity": _with(BENCH, HUMAN, "SELECT * FROM human"),
    "published_lookup": _with(BENCH, HUMAN, """SELECT b.utt, round(CASE WHEN h.anchor - h.p05 > 0 THEN (b.anchor_sim_ecapa - h.p05) / (h.anchor - h.p05) END, 6) AS sim_norm
FROM bench b LEFT JOIN human h ON h.lang = b.lang AND h.encoder = 'ecapa' WHERE isfinite(b.anchor_sim_ecapa)"""),
    "array_chunks": f"""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), c AS (SELECT vec_id, unnest(range(4)) AS chunk, v FROM e),
s AS (SELECT vec_id, chunk, v[chunk * 8 + 1 : chunk * 8 + 16] AS w, len(v) AS n FROM c WHERE chunk * 8 + 16 <= len(v))
SELECT vec_id, chunk::INTEGER AS chunk, len(w)::INTEGER AS n, round({_DOT.format('w', 'w')}, 6) AS energy FROM s""",
    "array_segments": """SELECT vec_id, ((len(embedding) - 15) // 4 + 1)::INTEGER AS n_segments, ceil((len(embedding) - 14) / 4)::INTEGER AS expected,
round(list_avg((embedding::DOUBLE[])[5:19]), 6) AS second_mean FROM embeddings""",
    "power_to_db": """WITH d AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: 10.0::DOUBLE * log10(greatest(x * x, 1e-10::DOUBLE))) AS db FROM embeddings)
SELECT vec_id, round(greatest(list_min(db) - list_max(db), -80.0::DOUBLE), 6) AS low, 0.0::DOUBLE AS high FROM d""",
    "padded_vectors": """WITH d AS (SELECT vec_id, embedding::DOUBLE[] AS v, list_transform(embedding::DOUBLE[], lambda x: 10.0::DOUBLE * log10(greatest(x * x, 1e-10::DOUBLE))) AS db FROM embeddings)
SELECT vec_id, 48 AS n_short, round(list_sum(v[1:48]), 6) AS sum_short, 80 AS n_long, round(list_sum(v[1:80]), 6) AS sum_long, round((list_min(db) - list_max(db) + 80.0::DOUBLE) / 80.0::DOUBLE, 6) AS low, 1.0::DOUBLE AS high FROM d""",
    "masked_pools": """WITH e AS (SELECT vec_id, (vec_id % 64 + 1)::INTEGER AS valid, (embedding::DOUBLE[])[1:(vec_id % 64 + 1)] AS v FROM embeddings)
SELECT vec_id, valid, round(list_avg(v), 6) AS mean, round(list_max(v), 6) AS top,
round(list_sum(list_transform(v, lambda x: x * exp(x - list_max(v)))) / list_sum(list_transform(v, lambda x: exp(x - list_max(v)))), 6) AS attended FROM e""",
    "anchor_plan": f"""WITH s AS (SELECT row_id, {_D} AS d FROM sources), c AS (SELECT row_id, d, {_CHUNK} AS chunk FROM s),
h AS (SELECT *, CASE WHEN 2.0 < chunk AND d >= 2 * chunk THEN chunk ELSE 2.0::DOUBLE END AS hop FROM c)
SELECT row_id, round(chunk, 6) AS chunk, CASE WHEN chunk IS NOT NULL THEN round(hop, 6) END AS hop,
CASE WHEN chunk IS NULL THEN NULL ELSE least(8, (floor((d - chunk) / hop + 1e-9) + 1)::INTEGER) END AS n_chunks FROM h""",
    "units": _with(POOL, _UNITS, "SELECT * FROM u"),
    "pending_units": _with(POOL, _UNITS, "SELECT subset, lang, asr, model, key FROM u WHERE model <> (SELECT min(model) FROM u)"),
    "json_roundtrip": _with(POOL, "SELECT subset, asr, count(*) FILTER (NOT missing) AS n_scored, count(*) FILTER (missing) AS n_missing FROM pool GROUP BY subset, asr"),
    "subset_names": "SELECT DISTINCT subset, split_part(subset, '__', 1) AS lang, split_part(subset, '__', 2) AS voice FROM asr",
    "admitted_subsets": "SELECT DISTINCT subset, split_part(subset, '__', 1) AS lang, split_part(subset, '__', 2) AS voice FROM asr WHERE subset <> 'nl-NL__femke_veen_f'",
    "score_invariants": f"""WITH e AS ({_coded('word')}), p AS (SELECT DISTINCT row_id, subs, dels, ins, n_ref_words, hyp_norm FROM asr WHERE NOT missing),
b AS (SELECT row_id, dels - ins = n_ref_words - len(list_filter(string_split(coalesce(hyp_norm, ''), ' '), lambda w: w <> '')) AS balanced, subs + dels + ins >= errors AS at_least FROM p JOIN e USING (row_id))
SELECT * FROM b WHERE NOT balanced OR NOT at_least""",
}
