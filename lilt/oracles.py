"""DuckDB SQL for the registered queries."""

from __future__ import annotations

UTT = """u AS (
  SELECT doc_id AS id, text AS transcription, CASE WHEN doc_id % 11 = 0 THEN '' ELSE source END AS dataset,
         CASE WHEN doc_id % 13 = 0 THEN NULL ELSE lang END AS gender, n_chars::DOUBLE AS f0, -length(text) / 100.0::DOUBLE AS energy,
         CASE WHEN doc_id % 7 = 0 THEN NULL ELSE round(n_chars / (doc_id % 5 + 1)::DOUBLE, 3) END AS rate,
         CASE WHEN doc_id % 17 = 0 THEN NULL ELSE (n_chars % 97) / 4.0::DOUBLE END AS range_st,
         CASE WHEN doc_id % 9 = 0 THEN NULL ELSE doc_id % 4 <> 0 END AS reliable,
         CASE WHEN doc_id % 6 = 0 THEN NULL ELSE (n_chars % 90)::DOUBLE END AS age
  FROM documents)"""

PRICED = """u AS (
  SELECT l_orderkey AS id, l_returnflag AS dataset, l_linestatus AS gender, l_extendedprice AS f0, -100 * l_discount AS energy, l_quantity AS rate
  FROM lineitem)"""

CALIB = """long AS (
  SELECT 'f0_median_hz' AS feature, coalesce(nullif(dataset, ''), '__all__') AS ds, coalesce(nullif(gender, ''), 'unknown') AS g, f0 AS v FROM u WHERE f0 IS NOT NULL
  UNION ALL SELECT 'energy_dbfs', coalesce(nullif(dataset, ''), '__all__'), NULL, energy FROM u WHERE energy IS NOT NULL
  UNION ALL SELECT 'articulation_rate_pps', coalesce(nullif(dataset, ''), '__all__'), NULL, rate FROM u WHERE rate IS NOT NULL),
cut AS (
  SELECT feature, ds, g, grouping(ds) AS pooled, count(*) AS n,
         CASE WHEN count(*) >= 50 THEN round(quantile_cont(v, 33.333333333333336 / 100), 4) END AS low,
         CASE WHEN count(*) >= 50 THEN round(quantile_cont(v, 66.66666666666667 / 100), 4) END AS high
  FROM long GROUP BY GROUPING SETS ((feature, g, ds), (feature, g)))"""

LOOKUP = """found AS (
  SELECT u.*, coalesce(pg.low, pp.low) AS pitch_low, coalesce(pg.high, pp.high) AS pitch_high,
         coalesce(eg.low, ep.low) AS energy_low, coalesce(eg.high, ep.high) AS energy_high,
         coalesce(rg.low, rp.low) AS rate_low, coalesce(rg.high, rp.high) AS rate_high
  FROM (SELECT *, coalesce(nullif(dataset, ''), '__all__') AS k, coalesce(nullif(gender, ''), 'unknown') AS kg FROM u) u
  LEFT JOIN cut pg ON pg.feature = 'f0_median_hz' AND pg.pooled = 0 AND pg.ds = k AND pg.g = kg
  LEFT JOIN cut pp ON pp.feature = 'f0_median_hz' AND pp.pooled = 1 AND pp.g = kg
  LEFT JOIN cut eg ON eg.feature = 'energy_dbfs' AND eg.pooled = 0 AND eg.ds = k
  LEFT JOIN cut ep ON ep.feature = 'energy_dbfs' AND ep.pooled = 1
  LEFT JOIN cut rg ON rg.feature = 'articulation_rate_pps' AND rg.pooled = 0 AND rg.ds = k
  LEFT JOIN cut rp ON rp.feature = 'articulation_rate_pps' AND rp.pooled = 1)"""


def _way(v: str, low: str, high: str, a: str, c: str) -> str:
    return f"CASE WHEN {v} IS NULL OR {low} IS NULL THEN NULL WHEN {v} <= {low} THEN '{a}' WHEN {v} <= {high} THEN 'normal' ELSE '{c}' END"


LEVELS = f"""{_way("f0", "pitch_low", "pitch_high", "low", "high")} AS pitch_level,
  {_way("energy", "energy_low", "energy_high", "low", "high")} AS energy_level,
  {_way("rate", "rate_low", "rate_high", "slow", "fast")} AS speed_level"""

AGE = "CASE WHEN age < 13 THEN 'Child' WHEN age < 20 THEN 'Teenager' WHEN age < 35 THEN 'Young Adult' WHEN age < 60 THEN 'Middle-aged' WHEN age IS NOT NULL THEN 'Elderly' END"

TRACK = """t AS (
  SELECT utt, frame::INTEGER AS frame, 130 * pow(2, x * 60 / 12) AS f0, abs(x) AS rms, abs(x) > 0.03 AS voiced, abs(x) > 0.05 AS speech
  FROM (SELECT vec_id AS utt, unnest(range(len(embedding))) AS frame, unnest(embedding)::DOUBLE AS x FROM embeddings))"""

DB = "20 * log10(greatest({}, 1e-10))"

BRIDGE = """i1 AS (
  SELECT utt, frame, speech, row_number() OVER (PARTITION BY utt ORDER BY frame) - row_number() OVER (PARTITION BY utt, speech ORDER BY frame) AS isl FROM t),
r1 AS (
  SELECT utt, frame, speech, min(frame) OVER w AS a, max(frame) OVER w AS b, count(*) OVER w AS n, min(frame) OVER x AS lo, max(frame) OVER x AS hi
  FROM i1 WINDOW w AS (PARTITION BY utt, speech, isl), x AS (PARTITION BY utt)),
b AS (SELECT utt, frame, speech OR (a > lo AND b < hi AND n < 6) AS m FROM r1),
i2 AS (SELECT *, row_number() OVER (PARTITION BY utt ORDER BY frame) - row_number() OVER (PARTITION BY utt, m ORDER BY frame) AS isl FROM b)"""

VOICED = TRACK + """,
v AS (
  SELECT utt, frame, 12 * log2(f0 / quantile_cont(f0, 0.5) OVER (PARTITION BY utt)) AS st,
         row_number() OVER (PARTITION BY utt ORDER BY frame) AS i, count(*) OVER (PARTITION BY utt) AS n
  FROM t WHERE voiced),
p AS (
  SELECT *, (frame - min(frame) OVER (PARTITION BY utt)) / greatest(max(frame) OVER (PARTITION BY utt) - min(frame) OVER (PARTITION BY utt), 1)::DOUBLE AS t
  FROM v)"""

_SG = "(-21 * {} + 14 * {} + 39 * {} + 54 * {} + 59 * {} + 54 * {} + 39 * {} + 14 * {} - 21 * {}) / 231.0::DOUBLE"

MEDIAN = """w5 AS (
  SELECT utt, frame, i, n, st, [coalesce(lag(st, 2) OVER w, first_value(st) OVER w), coalesce(lag(st, 1) OVER w, st), st,
         coalesce(lead(st, 1) OVER w, st), coalesce(lead(st, 2) OVER w, lead(st, 1) OVER w, st)] AS x
  FROM v WINDOW w AS (PARTITION BY utt ORDER BY frame)),
m5 AS (SELECT utt, frame, i, n, CASE WHEN n < 5 THEN st ELSE list_sort(x)[3] END AS st FROM w5)"""


def _savgol(source: str) -> str:
    """Common table expressions up to sg (utt, frame, i, n, st): the smoothed rows of source."""
    lags = [f"lag(st, {-k}) OVER w" if k < 0 else f"lead(st, {k}) OVER w" if k else "st" for k in range(-4, 5)]
    parts = []
    for side, u, inside in (("hd", "i - 5", "i <= 9"), ("tl", "i - (n - 4)", "i > n - 9")):
        parts.append(f"{side} AS (SELECT utt, sum(st) AS y0, sum(st * ({u})) AS y1, sum(st * ({u}) * ({u})) AS y2 FROM {source} WHERE n >= 9 AND {inside} GROUP BY utt)")
    # least squares over -4 to 4: sums of squares 60 and of fourth powers 708
    at = lambda s, u: f"((708 * {s}.y0 - 60 * {s}.y2) / 2772 + {s}.y1 / 60 * ({u}) + (9 * {s}.y2 - 60 * {s}.y0) / 2772 * ({u}) * ({u}))"
    return f"""{", ".join(parts)},
mid AS (SELECT utt, frame, i, n, st, {_SG.format(*lags)} AS inner_st FROM {source} WINDOW w AS (PARTITION BY utt ORDER BY frame)),
sg AS (
  SELECT mid.utt, frame, i, n, CASE WHEN n < 9 THEN st WHEN i <= 4 THEN {at("hd", "i - 5")} WHEN i > n - 4 THEN {at("tl", "i - (n - 4)")} ELSE inner_st END AS st
  FROM mid LEFT JOIN hd USING (utt) LEFT JOIN tl USING (utt))"""


def _fits(placed: str) -> str:
    """Common table expressions up to z, the fits of placed frames (utt, t, st)."""
    return f"""c AS (SELECT utt, t, t - avg(t) OVER (PARTITION BY utt) AS x, st - avg(st) OVER (PARTITION BY utt) AS y FROM {placed}),
m AS (
  SELECT utt, count(*) AS n, avg(t) AS mt, sum(x * x) AS s2, sum(x * x * x) AS s3, sum(x * x * x * x) AS s4,
         sum(x * y) AS c1, sum(x * x * y) AS c2, sum(y * y) AS sst
  FROM c GROUP BY utt),
q AS (SELECT *, (c2 - s3 / s2 * c1) / (s4 - s3 * s3 / s2 - s2 * s2 / n) AS a FROM m),
f AS (
  SELECT *, c1 / s2 AS slope, (c1 - a * s3) / s2 - 2 * a * mt AS b,
         CASE WHEN sst > 0 THEN (a * c2 + (c1 - a * s3) / s2 * c1) / sst - c1 / s2 * c1 / sst ELSE 0 END AS gain
  FROM q),
z AS (
  SELECT *, CASE WHEN abs(a) > 1e-9 THEN -b / (2 * a) END AS pos, CASE WHEN abs(a) > 1e-9 THEN -b * b / (4 * a) - (a + b) / 2 END AS depth FROM f)"""


def _head(placed: str) -> str:
    return f"""h AS (
  SELECT utt, quantile_cont(st, 0.5) FILTER (t >= 0.75) - quantile_cont(st, 0.5) FILTER (t <= 0.25) AS delta,
         quantile_cont(st, 0.95) - quantile_cont(st, 0.05) AS spread
  FROM {placed} GROUP BY utt)"""


FITS = f"{VOICED}, {_fits('p')}"

SMOOTHED = f"""{VOICED}, {MEDIAN}, {_savgol('m5')},
ps AS (
  SELECT *, (frame - min(frame) OVER (PARTITION BY utt)) / greatest(max(frame) OVER (PARTITION BY utt) - min(frame) OVER (PARTITION BY utt), 1)::DOUBLE AS t
  FROM sg)"""

CONTOUR = f"{SMOOTHED}, {_fits('ps')}, {_head('ps')}" + """,
g AS (
  SELECT utt, count(*) FILTER (gap > 30) AS pauses FROM (SELECT utt, frame - lag(frame) OVER (PARTITION BY utt ORDER BY frame) AS gap FROM v) GROUP BY utt),
s AS (
  SELECT u.utt, coalesce(z.n, 0) AS n, delta, depth, spread, coalesce(pauses, 0) AS pauses,
         CASE WHEN coalesce(z.n, 0) < 50 THEN 'insufficient_voiced'
              WHEN pos BETWEEN 0.25 AND 0.75 AND abs(depth) >= 2 AND gain >= 0.05 THEN CASE WHEN depth > 0 THEN 'rising-falling' ELSE 'falling-rising' END
              WHEN delta >= 2 THEN 'rising' WHEN delta <= -2 THEN 'falling' ELSE 'level' END AS shape,
         CASE WHEN coalesce(z.n, 0) < 25 THEN 'insufficient_voiced' WHEN spread < 3 THEN 'flat' WHEN spread > 9 THEN 'expressive' ELSE 'moderate' END AS dyn
  FROM (SELECT DISTINCT utt FROM t) u LEFT JOIN z USING (utt) LEFT JOIN h USING (utt) LEFT JOIN g USING (utt)),
k AS (
  SELECT *, (CASE WHEN shape = 'insufficient_voiced' OR delta IS NULL THEN 0 ELSE round(greatest(0, least(1, CASE WHEN shape IN ('rising', 'falling') THEN abs(delta) / 2 - 1
         WHEN shape IN ('rising-falling', 'falling-rising') THEN abs(depth) / 2 - 1 WHEN shape = 'level' THEN 1 - abs(delta) / 2 END))
         * least(1, n * 0.01::DOUBLE) * pow(0.7, pauses), 3) END)::DOUBLE AS conf
  FROM s WHERE true)"""

GATED = CONTOUR + """,
e AS (
  SELECT k.utt, CASE WHEN ok THEN shape ELSE 'insufficient_voiced' END AS contour_shape, CASE WHEN ok THEN dyn ELSE 'insufficient_voiced' END AS contour_dynamics,
         CASE WHEN ok THEN conf ELSE 0 END AS contour_confidence
  FROM k JOIN (SELECT utt, count(*) FILTER (voiced) >= 40 AS ok FROM t GROUP BY utt) USING (utt)),
o AS (
  SELECT utt, CASE WHEN contour_shape = 'insufficient_voiced' THEN 'too_short' WHEN contour_confidence < 0.15 THEN 'uncertain'
         WHEN contour_shape IN ('rising', 'falling', 'rising-falling', 'falling-rising') THEN contour_shape
         WHEN contour_dynamics = 'expressive' THEN 'expressive' ELSE 'flat' END AS intonation
  FROM e)"""

CHAT = """c AS (
  SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN '' ELSE conv_id || '-' || turn END AS audio_path,
         CASE WHEN turn % 2 = 0 THEN '' ELSE text END AS transcription, text,
         CASE WHEN turn % 5 = 4 THEN NULL ELSE role END AS emotion, CASE WHEN conv_id % 4 = 0 THEN NULL ELSE 'Female' END AS gender,
         CASE WHEN conv_id % 3 = 0 THEN NULL ELSE role || ', x' END AS stressed, CASE WHEN turn % 4 = 1 THEN 'rising' END AS intonation
  FROM conversations),
a AS (
  SELECT conv_id, turn, emotion AS groundtruth_emotion, coalesce(nullif(transcription, ''), nullif(text, '')) AS transcription,
         coalesce(gender, 'unknown') AS speaker_gender, 'unknown' AS speaker_age, 'unknown' AS pitch_level, 'unknown' AS energy_level,
         'unknown' AS speed_level, coalesce(intonation, 'uncertain') AS intonation_contour, coalesce(stressed, 'unknown') AS stressed_word
  FROM c),
f AS (
  SELECT conv_id, turn, 'Describe how the speaker sounds and explain why the emotion is ' || groundtruth_emotion || '.' || chr(10) || 'Words: ' || transcription || chr(10)
         || 'Gender: ' || speaker_gender || '; age: ' || speaker_age || '; pitch: ' || pitch_level || '; loudness: ' || energy_level || '; speed: ' || speed_level
         || '; intonation: ' || intonation_contour || '; stressed: ' || stressed_word || '.' || chr(10) || 'End with the emotion, ' || groundtruth_emotion || '.' AS _prompt,
         CASE WHEN groundtruth_emotion IS NULL AND transcription IS NULL THEN 'missing value: groundtruth_emotion, transcription'
              WHEN groundtruth_emotion IS NULL THEN 'missing value: groundtruth_emotion' WHEN transcription IS NULL THEN 'missing value: transcription' END AS _error
  FROM a),
r AS (SELECT conv_id, turn, coalesce(nullif(audio_path, ''), CASE WHEN conv_id <> 0 THEN conv_id::VARCHAR END, '#' || turn) AS key FROM c)"""

JOBS = """j AS (
  SELECT event_id, 'a' || event_id || '.wav' AS audio_path,
         CASE WHEN event_type = 'error' OR event_id % 10 = 0 THEN 'Kind' || (user_id % 7) || ': ' || event_type END AS error
  FROM events)"""

_RATE = "CASE WHEN {0} > 0 AND {1} > 0 THEN round({0} / {1}, 3) END"

ORACLES: dict[str, str] = {
    "calib_group_cuts": f"WITH {UTT}, {CALIB} SELECT feature, ds, g, n, low, high FROM cut WHERE pooled = 0",
    "calib_pooled_cuts": f"WITH {UTT}, {CALIB} SELECT feature, g, n, low, high FROM cut WHERE pooled = 1 AND low IS NOT NULL",
    "calib_lookup": f"""WITH {UTT}, {CALIB}, {LOOKUP} SELECT id, pitch_low AS pitch_level_low, pitch_high AS pitch_level_high, energy_low AS energy_level_low,
        energy_high AS energy_level_high, rate_low AS speed_level_low, rate_high AS speed_level_high FROM found""",
    "calib_label": f"WITH {UTT}, {CALIB}, {LOOKUP} SELECT id, {LEVELS} FROM found",
    "calib_label_lineitem": f"WITH {PRICED}, {CALIB}, {LOOKUP} SELECT dataset, gender, {LEVELS}, count(*) AS n FROM found GROUP BY ALL",
    "percentile_linear": f"WITH {UTT} SELECT dataset, "
    + ", ".join(f"round(quantile_cont(f0, {q / 100}), 6) AS p{q}" for q in (5, 25, 50, 75, 95))
    + " FROM u GROUP BY dataset",
    "report_label_counts": f"""WITH {UTT}, {CALIB}, {LOOKUP}, r AS (SELECT {LEVELS}, gender, {AGE} AS age_level FROM found),
        l AS (SELECT unnest(['pitch_level', 'energy_level', 'speed_level', 'gender', 'age_level']) AS field, unnest([pitch_level, energy_level, speed_level, gender, age_level]) AS label FROM r)
        SELECT field, coalesce(label, 'None') AS label, count(*) AS n FROM l GROUP BY 1, 2""",
    "report_range_spread": f"WITH {UTT} SELECT " + ", ".join(f"round(quantile_cont(range_st, {q / 100}), 2) AS p{q}" for q in (5, 25, 50, 75, 95)) + " FROM u HAVING count(range_st) > 0",
    "report_f0_by_gender": f"""WITH {UTT} SELECT coalesce(gender, 'None') AS gender, count(f0) AS n, round(quantile_cont(f0, 0.1), 1) AS p10,
        round(quantile_cont(f0, 0.5), 1) AS median, round(quantile_cont(f0, 0.9), 1) AS p90 FROM u GROUP BY 1 HAVING count(f0) > 0""",
    "totals": f"WITH {UTT} SELECT count(*) AS n_records, count(*) FILTER (reliable = false) AS n_f0_unreliable FROM u",
    "vad_threshold": f"""WITH {TRACK}, l AS (SELECT utt, quantile_cont({DB.format("rms")}, 0.95) AS loud, quantile_cont({DB.format("rms")}, 0.05) AS lo FROM t GROUP BY utt)
        SELECT utt, round(least(CASE WHEN loud - lo > 20 THEN greatest(loud - 35, lo + 6) ELSE loud - 35 END, loud - 15), 6) AS threshold_db FROM l""",
    "vad_runs": f"""WITH {TRACK}, i AS (SELECT utt, frame, speech, row_number() OVER (PARTITION BY utt ORDER BY frame)
        - row_number() OVER (PARTITION BY utt, speech ORDER BY frame) AS isl FROM t)
        SELECT utt, min(frame) AS start, max(frame) + 1 AS stop, speech AS value FROM i GROUP BY utt, speech, isl""",
    "vad_bridge_prune": f"WITH {TRACK}, {BRIDGE} SELECT utt, frame, m AND count(*) OVER (PARTITION BY utt, m, isl) >= 5 AS speech FROM i2",
    "restrict_to_speech": f"WITH {TRACK} SELECT t.utt, t.frame, t.voiced AND coalesce(m.speech, false) AS voiced FROM t LEFT JOIN t m ON m.utt = t.utt AND m.frame + 4 = t.frame",
    "f0_in_range": f"""WITH {TRACK} SELECT utt, count(*) FILTER (voiced AND f0 BETWEEN 55 AND 500) AS n,
        round(max(f0) FILTER (voiced AND f0 BETWEEN 55 AND 500), 6) AS top FROM t GROUP BY utt""",
    "octave_global": f"""WITH {TRACK}, m AS (SELECT utt, quantile_cont(log2(f0), 0.5) FILTER (voiced) AS centre, count(*) FILTER (voiced) AS n FROM t GROUP BY utt),
        d AS (SELECT utt, frame, f0, n, CASE WHEN voiced THEN 12 * (log2(f0) - centre) END AS dev FROM t JOIN m USING (utt))
        SELECT utt, frame, round(CASE WHEN n >= 5 AND abs(dev) > 9 THEN CASE WHEN abs(dev + 12) <= 6 THEN f0 * 2 WHEN abs(dev - 12) <= 6 THEN f0 / 2 ELSE f0 END ELSE f0 END, 6) AS f0 FROM d""",
    "f0_stats": f"""WITH {TRACK}, m AS (SELECT utt, quantile_cont(f0, 0.5) FILTER (voiced) AS c FROM t GROUP BY utt),
        g AS (SELECT utt, quantile_cont(f0, 0.5) FILTER (voiced) AS q50, quantile_cont(f0, 0.05) FILTER (voiced) AS q5, quantile_cont(f0, 0.95) FILTER (voiced) AS q95,
              stddev_pop(12 * log2(f0 / c)) FILTER (voiced) AS sd, count(*) FILTER (voiced) AS n, count(*) FILTER (voiced AND speech) AS b, count(*) FILTER (speech) AS s, count(*) AS a
              FROM t JOIN m USING (utt) GROUP BY utt)
        SELECT utt, round(q50, 2) AS f0_median_hz, round(q5, 2) AS f0_p5_hz, round(q95, 2) AS f0_p95_hz, round(12 * log2(q95 / q5), 2) AS f0_range_st, round(sd, 2) AS f0_std_st,
        n::INTEGER AS n_voiced_frames, round(n / a, 3) AS voiced_ratio, round(CASE WHEN s > 0 THEN b / s ELSE 0 END, 3) AS voiced_share_of_speech,
        n >= 25 AND CASE WHEN s > 0 THEN b / s ELSE 0 END >= 0.2 AS f0_reliable FROM g""",
    "speech_level": f"WITH {TRACK} SELECT utt, round({DB.format('sqrt(avg(rms * rms) FILTER (speech))')}, 2) AS energy_dbfs FROM t GROUP BY utt HAVING count(*) FILTER (speech) > 0"
    f" UNION ALL SELECT utt, NULL FROM (WITH {TRACK} SELECT utt FROM t GROUP BY utt HAVING count(*) FILTER (speech) = 0)",
    "noise_floor": f"WITH {TRACK} SELECT utt, round({DB.format('quantile_cont(rms, 0.05)')}, 2) AS noise_floor_dbfs FROM t GROUP BY utt",
    "durations": f"""WITH {TRACK} SELECT utt, round(count(*) * 0.01, 3)::DOUBLE AS duration_s, round(count(*) FILTER (speech) * 0.01, 3)::DOUBLE AS speech_duration_s,
        round(count(*) FILTER (speech) / count(*), 3) AS speech_ratio FROM t GROUP BY utt""",
    "snr": f"""WITH {TRACK}, l AS (SELECT utt, CASE WHEN count(*) FILTER (speech) > 0 THEN round({DB.format("sqrt(avg(rms * rms) FILTER (speech))")}, 2) END AS energy_dbfs,
        round({DB.format("quantile_cont(rms, 0.05)")}, 2) AS noise_floor_dbfs FROM t GROUP BY utt) SELECT *, round(energy_dbfs - noise_floor_dbfs, 2) AS est_snr_db FROM l""",
    "semitones": f"WITH {VOICED} SELECT utt, frame, round(st, 6) AS st FROM v",
    "frame_gaps": f"WITH {VOICED} SELECT utt, frame, frame - lag(frame) OVER (PARTITION BY utt ORDER BY frame) AS gap FROM v",
    "long_pauses": f"""WITH {TRACK}, g AS (SELECT utt, frame - lag(frame) OVER (PARTITION BY utt ORDER BY frame) AS gap FROM t WHERE rms > 0.25)
        SELECT utt, (count(*) FILTER (gap > 30))::INTEGER AS n_long_pauses FROM g GROUP BY utt""",
    "norm_position": f"WITH {VOICED} SELECT utt, frame, round(t, 6) AS t FROM p",
    "running_median5": f"WITH {VOICED}, {MEDIAN} SELECT utt, frame, round(st, 6) AS st FROM m5",
    "savgol_smooth": f"WITH {VOICED}, {_savgol('v')} SELECT utt, frame, round(st, 6) AS st FROM sg",
    "polyfit_linear": f"WITH {FITS} SELECT utt, round(slope, 6) AS slope FROM z",
    "polyfit_quadratic": f"WITH {FITS} SELECT utt, round(a, 6) AS a, round(b, 6) AS b FROM z",
    "r2_gain": f"WITH {FITS} SELECT utt, round(gain, 6) AS r2_gain FROM z",
    "turning_point": f"WITH {FITS} SELECT utt, round(pos, 4) AS turn_position, round(depth, 4) AS turn_depth FROM z",
    "head_tail_delta": f"WITH {VOICED}, {_head('p')} SELECT utt, round(delta, 6) AS delta FROM h",
    "contour_shape": f"WITH {CONTOUR} SELECT utt, shape AS contour_shape FROM k",
    "contour_dynamics": f"WITH {CONTOUR} SELECT utt, dyn AS contour_dynamics FROM k",
    "contour_confidence": f"WITH {CONTOUR} SELECT utt, conf AS contour_confidence FROM k",
    "reliability_gate": f"WITH {GATED} SELECT * FROM e",
    "intonation": f"WITH {GATED} SELECT * FROM o",
    "rates": f"WITH {UTT} SELECT id, {_RATE.format('rate', 'range_st')} AS speaking_rate_pps, {_RATE.format('rate', '(f0 - 800)')} AS articulation_rate_pps FROM u",
    "age_level": f"WITH {UTT} SELECT id, {AGE} AS age_level FROM u",
    "gender_argmax": """WITH d AS (SELECT doc_id, doc_id % 7 / 7.0::DOUBLE AS a, n_chars % 7 / 7.0::DOUBLE AS b, length(text) % 5 / 5.0::DOUBLE AS c FROM documents)
        SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL WHEN a >= b AND a >= c THEN 'Female' WHEN b >= c THEN 'Male' ELSE 'Child' END AS gender FROM d""",
    "text_coalesce": f"WITH {CHAT} SELECT conv_id, turn, coalesce(nullif(transcription, ''), nullif(text, ''), '') AS value FROM c",
    "alias_coalesce": f"WITH {CHAT} SELECT * FROM a",
    "prompt_fill": f"WITH {CHAT} SELECT * FROM f",
    "record_key": f"WITH {CHAT} SELECT * FROM r",
    "resume_anti_join": f"WITH {CHAT} SELECT conv_id, turn FROM r WHERE key NOT IN (SELECT key FROM r WHERE conv_id % 2 = 0)",
    "distinct_keys": f"WITH {CHAT} SELECT DISTINCT key FROM r",
    "token_rotate_zip": """WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS t FROM conversations),
        x AS (SELECT conv_id, turn, unnest(t) AS word, unnest(range(1, len(t) + 1)) AS i, len(t) AS n FROM w)
        SELECT conv_id, turn, (count(*) FILTER (word <> ''))::INTEGER AS n,
               coalesce(string_agg(word, ' ' ORDER BY i) FILTER (word <> '' AND (CASE WHEN i = 1 THEN n ELSE i - 1 END) % 3 = 0), '') AS stressed
        FROM x GROUP BY conv_id, turn""",
    "nonlatin_guard": r"""SELECT doc_id AS id, regexp_matches(CASE WHEN doc_id % 5 = 0 THEN text || ' 漢字' WHEN doc_id % 5 = 1 THEN text || ' Ж' ELSE text END,
        '[\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{ac00}-\x{d7af}]') AS non_latin FROM documents""",
    "arpabet_filter": "SELECT doc_id AS id, len(list_filter(regexp_split_to_array(translate(text, 'aehnrst', 'AEHNRST'), '[ ,.\n]+'), lambda x: regexp_matches(x, '^[A-Z]{1,3}[0-2]?$')))::INTEGER AS n_phonemes FROM documents",
    "error_split": f"WITH {JOBS} SELECT audio_path, error FROM j WHERE error IS NOT NULL",
    "error_top5": f"WITH {JOBS} SELECT error AS reason, count(*) AS n FROM j WHERE error IS NOT NULL GROUP BY error ORDER BY n DESC, min(event_id) LIMIT 5",
    "limit_first_n": f"WITH {JOBS} SELECT audio_path FROM j ORDER BY event_id LIMIT 100",
    "dry_run": f"WITH {CHAT} SELECT conv_id * 1000 + turn AS _row, coalesce('[skipped] ' || _error, _prompt) AS text FROM f ORDER BY 1 LIMIT 20",
    "vocabulary_check": f"""WITH {GATED} SELECT count(*) FILTER (intonation NOT IN ('rising', 'falling', 'rising-falling', 'falling-rising', 'flat', 'expressive', 'uncertain', 'too_short')) AS n_outside FROM o""",
    "peak_normalise": """SELECT vec_id, round(list_max(embedding)::DOUBLE / greatest(list_max(embedding), -list_min(embedding))::DOUBLE, 6) AS top,
        round(list_min(embedding)::DOUBLE / greatest(list_max(embedding), -list_min(embedding))::DOUBLE, 6) AS bottom FROM embeddings""",
}
