"""The catalog's queries as SQL over the same tables, for a second engine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from tidewatch.plans.catalog import ALERT_RATES, DASHBOARD, FULL_SIGNALS

_KEYED = """keyed AS (
  SELECT user_id AS patient_id, user_id * 100 + block AS admission_id, block, ts AS event_time,
         event_id, event_type, value, props
  FROM (SELECT *, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 5.0) AS BIGINT) AS block FROM events)
)"""
_STAYS = """stays AS (
  SELECT DISTINCT patient_id, admission_id,
         TIMESTAMP '2024-01-01' + to_days(CAST(5 * block AS INTEGER)) AS admit_time,
         TIMESTAMP '2024-01-01' + to_days(CAST(5 * (block + 1) AS INTEGER)) AS discharge_time
  FROM keyed
)"""
_ANCHORS = """anchors AS (
  SELECT patient_id, admission_id, anchor_time, CAST(anchor_time AS DATE) AS anchor_date FROM (
    SELECT patient_id, admission_id,
           unnest(generate_series(admit_time, discharge_time - INTERVAL 4 HOUR, INTERVAL 4 HOUR)) AS anchor_time
    FROM stays)
)"""
_VITALS = """vitals AS (
  SELECT patient_id, admission_id, event_time,
         CASE WHEN event_type = 'view' THEN value END AS hr,
         CASE WHEN event_type = 'click' THEN value END AS sbp,
         CASE WHEN event_type = 'signup' THEN value END AS spo2
  FROM keyed WHERE event_type IN ('view', 'click', 'signup')
)"""
_LABS = """labs AS (
  SELECT patient_id, admission_id, event_time, value AS lactate,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS creatinine
  FROM keyed WHERE event_type = 'purchase'
)"""
_OUTCOMES = """outcomes AS (
  SELECT patient_id, admission_id, 1 AS deterioration, min(event_time) AS deterioration_time
  FROM keyed WHERE event_type = 'error' AND value > 100 GROUP BY patient_id, admission_id
)"""
_ATTRIBUTES = """attributes AS (
  SELECT c_custkey AS patient_id, c_acctbal AS admit_acuity, c_nationkey AS comorbidity_count, c_mktsegment AS segment
  FROM customer
)"""
_LABELS = """labelled AS (
  SELECT a.patient_id, a.admission_id, a.anchor_time, a.anchor_date,
         CASE WHEN o.deterioration = 1 AND o.deterioration_time > a.anchor_time + INTERVAL 24 HOUR
               AND o.deterioration_time <= a.anchor_time + INTERVAL 48 HOUR THEN 1 ELSE 0 END AS label,
         o.deterioration_time
  FROM anchors a LEFT JOIN outcomes o USING (patient_id, admission_id)
)"""
_SPLIT = """CASE WHEN CAST(concat('0x', substr(md5(CAST(patient_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 70 THEN 'train'
     WHEN CAST(concat('0x', substr(md5(CAST(patient_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 85 THEN 'val' ELSE 'test' END"""
_SCORED = f"""means AS (
  SELECT a.patient_id, a.admission_id, a.anchor_time, avg(e.hr) AS m
  FROM anchors a JOIN vitals e ON a.patient_id = e.patient_id AND a.admission_id = e.admission_id
   AND e.event_time <= a.anchor_time AND e.event_time > a.anchor_time - INTERVAL 24 HOUR
  GROUP BY a.patient_id, a.admission_id, a.anchor_time
), scored AS (
  SELECT l.patient_id, l.admission_id, l.anchor_time, l.anchor_date,
         round(coalesce(m, 0) / (coalesce(m, 0) + 50.0::DOUBLE), 6) AS risk_score, l.label, {_SPLIT.replace('patient_id', 'l.patient_id')} AS split
  FROM labelled l LEFT JOIN means USING (patient_id, admission_id, anchor_time)
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY risk_score, tie) AS rank_up, count(*) OVER () AS n_all
  FROM (SELECT *, md5(concat_ws('|', patient_id, admission_id, anchor_time)) AS tie FROM scored)
)"""
_DOCS = """scored_docs AS (
  SELECT l.doc_id, d.lang, l.quality AS label, least(d.n_chars / 20000.0::DOUBLE, 1.0::DOUBLE) AS prob
  FROM labels l JOIN documents d USING (doc_id)
)"""
_BASE = (_KEYED, _STAYS, _ANCHORS, _VITALS, _LABS, _OUTCOMES, _LABELS)
_KEYS = "patient_id, admission_id, anchor_time"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_ON_BASE = _with(*_BASE)
_ON_SCORED = _with(*_BASE, _SCORED)
_TOP = "rank_up > n_all - CAST(floor(n_all * CAST({rate} AS DOUBLE)) AS BIGINT)"
_ALERT = "CASE WHEN " + _TOP + " THEN 1 ELSE 0 END"


def _stat_sql(signal: str, stat: str, w: int, digits: int) -> str:
    inside = f"e.event_time > a.anchor_time - INTERVAL {w} HOUR"
    seen = f"FILTER (WHERE {inside} AND e.{signal} IS NOT NULL)"
    rows = f"FILTER (WHERE {inside})"
    v = f"e.{signal}"
    first, last = f"arg_min({v}, e.event_time) {seen}", f"arg_max({v}, e.event_time) {seen}"
    start, end = f"min(e.event_time) {seen}", f"max(e.event_time) {seen}"
    hours = f"date_diff('microsecond', {start}, {end}) / 3600000000.0::DOUBLE"
    sql = {
        "mean": f"avg({v}) {rows}",
        "min": f"min({v}) {rows}",
        "max": f"max({v}) {rows}",
        "range": f"max({v}) {rows} - min({v}) {rows}",
        "std": f"stddev_samp({v}) {seen}",
        "last": last,
        "delta": f"CASE WHEN {start} < {end} THEN {last} - {first} END",
        "slope": f"CASE WHEN {start} < {end} THEN ({last} - {first}) / ({hours}) END",
        "slope_fit": f"CASE WHEN {start} < {end} THEN regr_slope({v}, date_diff('microsecond', a.anchor_time, e.event_time) / 3600000000.0::DOUBLE) {seen} END",
        "count": f"CASE WHEN count(*) {rows} > 0 THEN count({v}) {rows} END",
        "missing_rate": f"CASE WHEN count(*) {rows} > 0 THEN 1.0::DOUBLE - count({v}) {rows} / CAST(count(*) {rows} AS DOUBLE) END",
        "tslm": f"date_diff('microsecond', {end}, a.anchor_time) / 3600000000.0::DOUBLE",
    }[stat]
    digits = 2 if stat == "tslm" else digits
    return f"{sql if stat == 'count' else f'round({sql}, {digits})'} AS {signal}_{stat}_{w}h"


_DEFAULT = {"vitals": (("hr", ("mean", "last", "count")), ("spo2", ("min",))), "labs": (("lactate", ("mean", "count")), ("creatinine", ("last",)))}


def _family(name: str, stats: Sequence[tuple[str, Sequence[str]]], windows: Sequence[int], digits: int) -> str:
    columns = ",\n    ".join(_stat_sql(s, st, w, digits) for w in windows for s, sts in stats for st in sts)
    return f"""f_{name} AS (
  SELECT a.patient_id, a.admission_id, a.anchor_time,
    {columns}
  FROM anchors a JOIN {name} e ON a.patient_id = e.patient_id AND a.admission_id = e.admission_id
   AND e.event_time <= a.anchor_time AND e.event_time > a.anchor_time - INTERVAL {max(windows)} HOUR
  GROUP BY a.patient_id, a.admission_id, a.anchor_time
)"""


def _features(
    stats: Mapping[str, Sequence[tuple[str, Sequence[str]]]] = _DEFAULT, windows: Sequence[int] = (6, 12, 24), digits: int = 6
) -> list[str]:
    families = [_family(n, s, windows, digits) for n, s in stats.items()]
    joined = " FULL OUTER JOIN ".join(f"f_{n}" + ("" if i == 0 else f" USING ({_KEYS})") for i, n in enumerate(stats))
    return [*families, f"features AS (SELECT * FROM {joined})"]


def _all_signals(stats: Sequence[str]) -> dict[str, list[tuple[str, Sequence[str]]]]:
    return {n: [(s, stats) for s in signals] for n, signals in FULL_SIGNALS.items()}


def _feature_names(stats=_DEFAULT, windows=(6, 12, 24)) -> list[str]:
    return [f"{s}_{st}_{w}h" for w in windows for _, specs in stats.items() for s, sts in specs for st in sts]


_NAMES = _feature_names()
_GOLD = "gold AS (SELECT * FROM anchors LEFT JOIN features USING (" + _KEYS + "))"
_TRAINING = f"""training AS (
  SELECT g.patient_id, g.admission_id, g.anchor_time, g.anchor_date,
         {', '.join(f'coalesce(CAST(g.{n} AS DOUBLE), 0) AS {n}' for n in _NAMES)},
         l.label, coalesce(t.admit_acuity, 0) AS admit_acuity, coalesce(CAST(t.comorbidity_count AS DOUBLE), 0) AS comorbidity_count,
         CASE WHEN t.segment = 'BUILDING' THEN 1 ELSE 0 END AS segment_building, {_SPLIT.replace('patient_id', 'g.patient_id')} AS split
  FROM gold g JOIN labelled l USING ({_KEYS}) LEFT JOIN attributes t ON t.patient_id = g.patient_id
)"""
_ON_TRAINING = _with(*_BASE, _ATTRIBUTES, *_features(), _GOLD, _TRAINING)
# Exact areas under the curves from one row per score, for a relation p(grp..., s, y).
_AREAS = """pts AS (
  SELECT {by} s, CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS pos, CAST(count(*) FILTER (WHERE y <> 1) AS DOUBLE) AS neg
  FROM p GROUP BY {by} s
), cum AS (
  SELECT *, sum(pos) OVER (PARTITION BY {part} ORDER BY s DESC) AS tp, sum(neg) OVER (PARTITION BY {part} ORDER BY s DESC) AS fp,
         sum(neg) OVER (PARTITION BY {part} ORDER BY s) AS below,
         sum(pos) OVER (PARTITION BY {part}) AS np, sum(neg) OVER (PARTITION BY {part}) AS nn
  FROM pts
), areas AS (
  SELECT {by} sum(pos * (below - neg / 2)) / nullif(max(np) * max(nn), 0) AS auroc,
         sum(pos * (tp / (tp + fp) + CASE WHEN tp + fp - pos - neg > 0 THEN (tp - pos) / (tp + fp - pos - neg) ELSE tp / (tp + fp) END) / 2) / nullif(max(np), 0) AS auprc
  FROM cum {grouped}
)"""
_TWO_MODELS = """both_models AS (
  SELECT 'mean_24h' AS model, split, label, risk_score AS prob FROM scored
  UNION ALL SELECT 'inverse', split, label, round(1 - risk_score * risk_score, 6) FROM scored
), p AS (SELECT model, split, prob AS s, label AS y FROM both_models)"""
_METRICS = (
    _TWO_MODELS
    + ", "
    + _AREAS.format(by="model, split,", part="model, split", grouped="GROUP BY model, split")
    + """, simple AS (
  SELECT model, split, count(*) AS rows, avg(label) AS prevalence, avg((prob - label) * (prob - label)) AS brier
  FROM both_models GROUP BY model, split
), metrics AS (
  SELECT 'run_1' AS run_id, model, split, metric, CAST(value AS DOUBLE) AS value FROM (
    SELECT model, split, unnest(['rows', 'prevalence', 'brier', 'auroc', 'auprc']) AS metric,
           unnest([CAST(rows AS DOUBLE), prevalence, brier, auroc, auprc]) AS value
    FROM areas JOIN simple USING (model, split))
)"""
)
_BAND = "CASE WHEN risk_score >= 0.8 THEN 'HIGH' WHEN risk_score >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END"


def _report(source: str, check: str, layer: str, lines: Sequence[tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{check}' AS \"check\", '{layer}' AS layer, '{sev}' AS severity, '{metric}' AS metric, "
        f"CAST({value} AS DOUBLE) AS value, {passed} AS passed FROM {source}"
        for sev, metric, value, passed in lines
    )


def _zero(severity: str, metric: str, column: str) -> tuple[str, str, str, str]:
    return severity, metric, column, f"{column} = 0"


def _decile(tiles: int) -> str:
    return f"CAST(ntile({tiles}) OVER (ORDER BY risk_score, tie) AS INTEGER)"


def _sampled(relation: str, n: int, seed: int) -> str:
    return f"(SELECT * FROM {relation} ORDER BY md5(concat_ws('|', patient_id, admission_id, anchor_time, '{seed}')) LIMIT {n})"


_LINE_COLUMNS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_LINE_TIES = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus".split(", ")
_DEDUPED = f"""deduped AS (
  SELECT {_LINE_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, {', '.join(c + ' DESC NULLS LAST' for c in _LINE_TIES)}) AS rn FROM lineitem)
  WHERE rn = 1
)"""
_SOFT = {"hr": (20, 220), "sbp": (50, 250), "spo2": (0, 100)}
_SAMPLE_COLUMNS = "patient_id, admission_id, anchor_time, anchor_date, risk_score, label, split"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["bronze_ingest"] = (
        "SELECT event_id, ts, user_id, event_type, value, props, TIMESTAMP '2024-02-01 00:00:00' AS _ingest_ts, 'shared_events' AS _source FROM events"
    )
    out["enforce_schema"] = (
        "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS INTEGER) AS user_id, "
        "TRY_CAST(event_type AS DOUBLE) AS event_type, value, ts FROM events"
    )
    out["partitioned_roundtrip"] = _with(_KEYED, _VITALS) + (
        "SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n, round(avg(hr), 6) AS hr_mean, round(max(sbp), 6) AS sbp_max "
        "FROM vitals GROUP BY 1"
    )
    out["partition_prune_scan"] = _with(_KEYED, _VITALS) + (
        "SELECT *, CAST(event_time AS DATE) AS event_date FROM vitals "
        "WHERE event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-20'"
    )
    out["csv_roundtrip"] = _with(_DOCS) + "SELECT * FROM scored_docs"
    out["latest_run"] = (
        "SELECT event_id, user_id, value, strftime(ts, '%Y%m%d') AS run_id FROM events "
        "WHERE strftime(ts, '%Y%m%d') = (SELECT max(strftime(ts, '%Y%m%d')) FROM events)"
    )
    out["row_audit"] = _with(_KEYED, _VITALS) + (
        "SELECT count(*) AS n_rows, count(*) FILTER (WHERE hr IS NULL) AS hr_missing FROM vitals"
    )
    out["score_dataset"] = _ON_TRAINING + "SELECT * EXCLUDE (label, split) FROM training"

    def clipped(c: str) -> str:
        return f"CASE WHEN {c} < 2 THEN 2 WHEN {c} > 150 THEN 150 ELSE {c} END AS {c}"

    out["clip_signals"] = _with(_KEYED, _VITALS) + (
        f"SELECT patient_id, admission_id, event_time, {clipped('hr')}, {clipped('sbp')}, {clipped('spo2')} FROM vitals"
    )
    out["dedupe_latest"] = _with(_DEDUPED) + "SELECT * FROM deduped"
    out["distinct_keys"] = "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem"
    out["standardize_enum"] = (
        "SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment ELSE 'U' END AS segment FROM customer"
    )
    out["normalize_time"] = (
        "SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate - INTERVAL 5 HOUR END AS ordered_at FROM orders"
    )
    flags = ", ".join(f"CASE WHEN {c} < {lo} OR {c} > {hi} THEN 1 ELSE 0 END AS {c}_oor" for c, (lo, hi) in _SOFT.items())
    out["range_flags"] = _with(_KEYED, _VITALS) + f"SELECT *, {flags} FROM vitals"
    out["valid_intervals"] = (
        "SELECT l_orderkey, l_linenumber, l_shipdate AS discharge_time, o_orderdate AS admit_time "
        "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < l_shipdate"
    )
    out["valid_outcomes"] = _ON_BASE + (
        "SELECT o.patient_id, o.admission_id, o.deterioration, o.deterioration_time + INTERVAL 24 HOUR AS deterioration_time "
        "FROM outcomes o JOIN stays s USING (patient_id, admission_id) "
        "WHERE o.deterioration_time + INTERVAL 24 HOUR BETWEEN s.admit_time AND s.discharge_time"
    )
    out["orphan_events"] = _ON_BASE + (
        "SELECT patient_id, admission_id, count(*) AS n_events FROM vitals v WHERE NOT EXISTS (SELECT 1 FROM labs l "
        "WHERE l.patient_id = v.patient_id AND l.admission_id = v.admission_id) GROUP BY patient_id, admission_id"
    )
    out["anchor_grid"] = _ON_BASE + (
        "SELECT a.patient_id, a.admission_id, a.anchor_time, a.anchor_date, "
        "CAST(date_diff('hour', s.admit_time, a.anchor_time) // 4 AS INTEGER) AS anchor_seq, 6 AS warmup_hours, "
        "CASE WHEN a.anchor_time >= s.admit_time + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS is_valid_anchor "
        "FROM anchors a JOIN stays s USING (patient_id, admission_id)"
    )
    censored = (
        "SELECT a.* FROM anchors a LEFT JOIN outcomes o USING (patient_id, admission_id) "
        "WHERE o.deterioration_time IS NULL OR a.anchor_time < o.deterioration_time"
    )
    out["anchor_grid_censored"] = _ON_BASE + censored
    out["window_features"] = _with(*_BASE, *_features()) + "SELECT * FROM features"
    out["window_stats_full"] = _with(*_BASE, *_features(_all_signals(("min", "max", "std", "last", "count")))) + "SELECT * FROM features"
    out["window_trend"] = _with(*_BASE, *_features(_all_signals(("delta", "slope", "slope_fit", "range")))) + "SELECT * FROM features"
    out["window_missing"] = _with(*_BASE, *_features(_all_signals(("missing_rate", "tslm")))) + "SELECT * FROM features"
    asof = {"vitals": [(s, ("last", "tslm")) for s in FULL_SIGNALS["vitals"]]}
    out["asof_last"] = _with(*_BASE, *_features(asof, (12,))) + "SELECT * FROM features"
    out["range_join_bucketed"] = _ON_BASE + (
        "SELECT a.patient_id, a.admission_id, a.event_time AS anchor_time, round(avg(e.hr), 6) AS hr_mean_24h, "
        "round(arg_max(e.hr, e.event_time) FILTER (WHERE e.hr IS NOT NULL), 6) AS hr_last_24h, count(e.hr) AS hr_count_24h "
        "FROM labs a JOIN vitals e ON a.patient_id = e.patient_id AND a.admission_id = e.admission_id "
        "AND e.event_time <= a.event_time AND e.event_time > a.event_time - INTERVAL 24 HOUR GROUP BY 1, 2, 3"
    )
    pairs = (
        "FROM labs a JOIN vitals e ON a.patient_id = e.patient_id AND a.admission_id = e.admission_id "
        "AND e.event_time <= a.event_time AND e.event_time > a.event_time - INTERVAL {} HOUR"
    )
    out["irregular_window_stats"] = _ON_BASE + (
        "SELECT a.patient_id, a.admission_id, a.event_time AS anchor_time, round(avg(e.hr), 6) AS hr_mean_36h, "
        "round(min(e.hr), 6) AS hr_min_36h, round(max(e.hr), 6) AS hr_max_36h, round(stddev_samp(e.hr), 6) AS hr_std_36h, "
        "round(arg_max(e.hr, e.event_time) FILTER (WHERE e.hr IS NOT NULL), 6) AS hr_last_36h, count(e.hr) AS hr_count_36h "
        "FROM (SELECT DISTINCT patient_id, admission_id, event_time FROM labs) a" + pairs.format(36)[len("FROM labs a") :] + " GROUP BY 1, 2, 3"
    )
    out["range_join_pairs"] = _ON_BASE + (
        "SELECT a.patient_id, a.admission_id, a.event_time AS anchor_time, e.event_time, round(e.hr, 6) AS hr " + pairs.format(24)
    )
    out["merge_features_outer"] = _with(*_BASE, *_features(windows=(24,))) + "SELECT * FROM features"
    out["gold_features"] = _with(*_BASE, *_features(), _GOLD) + "SELECT * FROM gold"
    lasts = {"vitals": [(s, ("last",)) for s in FULL_SIGNALS["vitals"]]}
    derived = ", ".join(
        f"round(sbp_last_{w}h - spo2_last_{w}h, 6) AS pulse_pressure_last_{w}h, "
        f"round((2 * spo2_last_{w}h + sbp_last_{w}h) / 3, 6) AS map_last_{w}h, "
        f"round(hr_last_{w}h / nullif(sbp_last_{w}h, 0), 6) AS shock_index_last_{w}h"
        for w in (6, 12, 24)
    )
    out["derived_features"] = _with(*_BASE, *_features(lasts)) + f"SELECT *, {derived} FROM features"
    out["label_horizon"] = _ON_BASE + "SELECT * FROM labelled"
    out["training_set"] = _ON_TRAINING + "SELECT * FROM training"
    out["training_set_direct"] = out["training_set_bucketed"] = out["training_set"]
    filled = ", ".join(f"coalesce(CAST({n} AS DOUBLE), 0) AS {n}" for n in _NAMES)
    out["fill_nulls"] = _with(*_BASE, *_features(), _GOLD) + f"SELECT {_KEYS}, anchor_date, {filled} FROM gold"
    out["encode_binary"] = _with(_ATTRIBUTES) + (
        "SELECT patient_id, admit_acuity, comorbidity_count, CASE WHEN segment = 'BUILDING' THEN 1 ELSE 0 END AS segment_building FROM attributes"
    )
    out["split_assign"] = (
        f"SELECT patient_id, c_name, {_SPLIT} AS split FROM (SELECT c_custkey AS patient_id, c_name FROM customer)"
    )
    out["split_temporal"] = """WITH o AS (SELECT o_orderkey, o_orderdate AS admit_time, row_number() OVER (ORDER BY o_orderdate) AS rn, count(*) OVER () AS n FROM orders),
cuts AS (SELECT max(admit_time) FILTER (WHERE rn <= floor(n * 0.7::DOUBLE)) AS t, max(admit_time) FILTER (WHERE rn <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE))) AS v FROM o)
SELECT o_orderkey, admit_time, CASE WHEN admit_time <= t THEN 'train' WHEN admit_time <= v THEN 'val' ELSE 'test' END AS split FROM o, cuts"""
    stats = (
        "count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_pos, round(avg(CAST(label AS DOUBLE)), 6) AS prevalence, "
        "count(DISTINCT patient_id) AS n_entities FROM scored"
    )
    out["split_stats"] = _ON_SCORED + f"SELECT split, {stats} GROUP BY split UNION ALL SELECT 'all', {stats}"
    out["class_weights"] = _ON_SCORED + (
        ", ratio AS (SELECT CASE WHEN count(*) FILTER (WHERE label = 1) > 0 THEN CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) / "
        "count(*) FILTER (WHERE label = 1) ELSE 1.0 END AS r FROM scored WHERE split = 'train') "
        f"SELECT {_KEYS}, label, split, round(CASE WHEN label = 1 THEN (SELECT r FROM ratio) ELSE 1.0::DOUBLE END, 6) AS weight FROM scored"
    )
    out["risk_decile"] = _ON_SCORED + f"SELECT {_SAMPLE_COLUMNS}, {_decile(10)} AS risk_decile FROM ranked"
    out["distributed_rank"] = _ON_SCORED + f"SELECT {_SAMPLE_COLUMNS}, n_all - rank_up + 1 AS rank FROM ranked"
    out["alert_flags"] = _ON_SCORED + (
        f"SELECT {_SAMPLE_COLUMNS}, {_ALERT.format(rate=0.1)} AS alert_flag, 0.1::DOUBLE AS alert_rate_config FROM ranked"
    )
    out["alert_flags_threshold"] = _ON_SCORED + (
        ", thr AS (SELECT min(risk_score) AS t FROM ranked WHERE rank_up >= ceil(n_all * (1 - 0.1::DOUBLE))) "
        f"SELECT {_SAMPLE_COLUMNS}, CASE WHEN risk_score >= (SELECT t FROM thr) THEN 1 ELSE 0 END AS alert_flag, "
        "0.1::DOUBLE AS alert_rate_config FROM ranked"
    )
    per_rate = " UNION ALL ".join(
        f"SELECT {r}::DOUBLE AS k_rate, CAST(floor(max(n_all) * CAST({r} AS DOUBLE)) AS BIGINT) AS k, "
        f"CAST(count(*) FILTER (WHERE label = 1 AND {_TOP.format(rate=r)}) AS DOUBLE) AS hits, "
        "CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos, max(n_all) AS n FROM ranked"
        for r in ALERT_RATES
    )
    out["topk_metrics"] = _ON_SCORED + (
        f"SELECT k_rate, k, round(hits / k, 6) AS precision_at_k, round(hits / pos, 6) AS recall_at_k, "
        f"round((hits / k) / (pos / n), 6) AS lift_at_k, round(pos / n, 6) AS base_rate FROM ({per_rate})"
    )
    per_split = " UNION ALL ".join(
        f"SELECT split, {r}::DOUBLE AS k_rate, CAST(floor(max(ns) * CAST({r} AS DOUBLE)) AS BIGINT) AS k, "
        f"CAST(count(*) FILTER (WHERE label = 1 AND rk <= floor(ns * CAST({r} AS DOUBLE))) AS DOUBLE) AS hits, "
        "CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos, max(ns) AS n FROM by_split GROUP BY split"
        for r in ALERT_RATES
    )
    out["topk_by_split"] = _ON_SCORED + (
        ", by_split AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY risk_score DESC, tie DESC) AS rk, "
        "count(*) OVER (PARTITION BY split) AS ns FROM ranked) "
        "SELECT split, k_rate, k, CASE WHEN k > 0 THEN round(hits / k, 6) END AS precision_at_k, "
        "CASE WHEN k > 0 THEN CASE WHEN pos > 0 THEN round(hits / pos, 6) ELSE 0.0::DOUBLE END END AS recall_at_k, "
        f"CASE WHEN k > 0 AND pos > 0 THEN round((hits / k) / (pos / n), 6) END AS lift_at_k, CASE WHEN k > 0 THEN round(pos / n, 6) END AS base_rate FROM ({per_split})"
    )
    out["calibration"] = _with(_DOCS) + (
        "SELECT CAST(least(floor(prob * 10), 9) AS BIGINT) AS bin, count(*) AS n, round(avg(prob), 6) AS avg_pred, "
        "round(avg(CAST(label AS DOUBLE)), 6) AS event_rate FROM scored_docs GROUP BY 1"
    )
    out["auroc_exact"] = (
        _ON_SCORED
        + ", p AS (SELECT risk_score AS s, label AS y FROM scored), "
        + _AREAS.format(by="", part="1", grouped="")
        + " SELECT round(auroc, 6) AS auroc FROM areas"
    )
    out["auprc_exact"] = (
        _with(_DOCS)
        + ", p AS (SELECT lang, prob AS s, label AS y FROM scored_docs), "
        + _AREAS.format(by="lang,", part="lang", grouped="GROUP BY lang")
        + " SELECT lang, round(auprc, 6) AS auprc FROM areas"
    )
    out["brier"] = _with(_DOCS) + "SELECT round(avg((prob - label) * (prob - label)), 6) AS brier FROM scored_docs"
    out["lead_time"] = _ON_SCORED + (
        f", first_alert AS (SELECT patient_id, admission_id, min(anchor_time) AS f FROM ranked WHERE {_TOP.format(rate=0.2)} GROUP BY 1, 2) "
        "SELECT o.patient_id, o.admission_id, o.deterioration_time, CASE WHEN f < o.deterioration_time THEN f END AS first_alert_time, "
        "round(CASE WHEN f < o.deterioration_time THEN date_diff('microsecond', f, o.deterioration_time) / 3600000000.0::DOUBLE END, 6) AS lead_hours "
        "FROM outcomes o LEFT JOIN first_alert USING (patient_id, admission_id)"
    )
    out["metrics_long"] = _ON_SCORED + ", " + _METRICS + " SELECT run_id, model, split, metric, round(value, 6) AS value FROM metrics"
    out["select_model"] = _ON_SCORED + ", " + _METRICS + (
        " SELECT run_id, arg_max(model, value) AS model, round(max(value), 6) AS value FROM metrics "
        "WHERE metric = 'auprc' AND split = 'val' AND value IS NOT NULL GROUP BY run_id"
    )
    out["risk_band"] = _ON_SCORED + f"SELECT *, {_BAND} AS risk_band FROM scored"
    out["score_output"] = _ON_SCORED + (
        f"SELECT *, {_BAND} AS risk_band, 'mean_24h_v1' AS model_version, TIMESTAMP '2024-02-01' AS scored_at FROM scored"
    )
    out["top_risk_preview"] = _ON_SCORED + f"SELECT * FROM scored ORDER BY risk_score DESC, {_KEYS} LIMIT 200"
    out["hash_sample"] = _ON_SCORED + f"SELECT * FROM {_sampled('scored', 1000, 42)}"
    flagged = f"flagged AS (SELECT {_SAMPLE_COLUMNS}, {_decile(10)} AS risk_decile, {_ALERT.format(rate=0.1)} AS alert_flag, 0.1::DOUBLE AS alert_rate_config FROM ranked)"
    out["stratified_sample"] = _ON_SCORED + (
        f", {flagged}, picked AS (SELECT * FROM {_sampled('(SELECT * FROM flagged WHERE alert_flag = 1)', 1000, 42)} "
        f"UNION ALL SELECT * FROM {_sampled('(SELECT * FROM flagged WHERE alert_flag = 0)', 1000, 43)}) SELECT * EXCLUDE (risk_decile) FROM picked"
    )
    half = int(DASHBOARD.rows * DASHBOARD.alerted_fraction)
    tips = [c for c in DASHBOARD.tooltips if c in _NAMES or c in ("admit_acuity", "comorbidity_count")]
    out["dashboard_extract"] = _with(*_BASE, _SCORED, _ATTRIBUTES, *_features(), _GOLD, _TRAINING) + (
        f", {flagged}, picked AS (SELECT * FROM {_sampled('(SELECT * FROM flagged WHERE alert_flag = 1)', half, 42)} "
        f"UNION ALL SELECT * FROM {_sampled('(SELECT * FROM flagged WHERE alert_flag = 0)', DASHBOARD.rows - half, 43)}) "
        f"SELECT k.* EXCLUDE (anchor_time), k.anchor_time AS anchor_datetime, {_BAND.replace('risk_score', 'k.risk_score')} AS risk_band, "
        f"{', '.join('t.' + c for c in tips)} FROM picked k LEFT JOIN training t USING ({_KEYS})"
    )
    out["alert_volume_daily"] = _ON_SCORED + (
        f", {flagged} SELECT anchor_date, count(*) AS n_anchors, count(*) FILTER (WHERE alert_flag = 1) AS n_alerts, "
        "round(avg(CAST(alert_flag AS DOUBLE)), 6) AS alert_share, round(avg(risk_score), 6) AS mean_score, "
        "round(max(risk_score), 6) AS max_score FROM flagged GROUP BY anchor_date"
    )
    out["latest_risk"] = _ON_SCORED + (
        "SELECT patient_id, admission_id, anchor_time, risk_score, previous_score, round(risk_score - previous_score, 6) AS score_change FROM ("
        "SELECT *, lag(risk_score) OVER w AS previous_score, row_number() OVER (PARTITION BY patient_id, admission_id ORDER BY anchor_time DESC) AS age "
        "FROM scored WINDOW w AS (PARTITION BY patient_id, admission_id ORDER BY anchor_time)) WHERE age = 1"
    )

    parse = "(SELECT count(*) AS given, count(*) FILTER (WHERE o_orderpriority <> '1-URGENT') AS parsed FROM orders)"
    required = ("patient_id", "admission_id", "event_time", "hr")
    out["dq_schema"] = (
        _with(_KEYED, _VITALS)
        + f", counted AS (SELECT count(*) AS n, {', '.join(f'count({c}) AS {c}' for c in required)} FROM vitals) "
        + _report(
            "counted",
            "schema",
            "bronze",
            [("INFO", "rows", "n", "true")]
            + [x for c in required for x in (("ERROR", f"has_{c}", "1", "true"), ("WARN", f"values_{c}", c, f"(n = 0 OR {c} > 0)"))]
            + [("ERROR", "has_unit", "0", "false"), ("WARN", "values_unit", "0", "false")],
        )
    )
    out["dq_timestamp_parse"] = _report(
        parse,
        "timestamp_parse",
        "bronze",
        [
            ("INFO", "parse_success_rate", "round(parsed / CAST(given AS DOUBLE), 6)", "true"),
            ("ERROR", "unparseable", "given - parsed", "given = parsed"),
        ],
    )
    copies = "(SELECT sum(n) AS n, sum(n - 1) AS extra, count(*) FILTER (WHERE n > 1) AS repeated FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber))"
    out["dq_duplicates"] = _report(
        copies,
        "duplicates",
        "bronze",
        [
            _zero("WARN", "duplicate_rows", "extra"),
            ("INFO", "repeated_keys", "repeated", "true"),
            ("INFO", "duplicate_rate", "round(extra / CAST(n AS DOUBLE), 6)", "true"),
        ],
    )
    out["dq_dedupe_removed"] = _with(_DEDUPED) + _report(
        "(SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM deduped) AS removed)",
        "dedupe",
        "silver",
        [("INFO", "rows_removed", "removed", "true")],
    )
    out["dq_temporal"] = (
        _ON_BASE
        + ", placed AS (SELECT v.event_time + INTERVAL 12 HOUR AS t, s.admit_time, s.discharge_time, s.patient_id AS stay FROM vitals v "
        "LEFT JOIN stays s USING (patient_id, admission_id)), counted AS (SELECT count(*) FILTER (WHERE t < admit_time OR t > discharge_time) AS outside, "
        "count(*) FILTER (WHERE stay IS NULL) AS orphans, count(*) FILTER (WHERE t > TIMESTAMP '2024-01-25') AS future FROM placed) "
        + _report(
            "counted",
            "temporal",
            "bronze",
            [
                _zero("ERROR", "events_outside_stay", "outside"),
                _zero("ERROR", "events_without_stay", "orphans"),
                _zero("WARN", "events_in_future", "future"),
            ],
        )
    )
    out["dq_ranges"] = (
        _with(_KEYED, _VITALS)
        + ", counted AS (SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS {c}" for c, (lo, hi) in _SOFT.items())
        + " FROM vitals) "
        + _report("counted", "ranges", "bronze", [_zero("WARN", f"{c}_out_of_range", c) for c in _SOFT])
    )
    out["dq_intervals"] = (
        _with(_KEYED, _VITALS)
        + ", counted AS (SELECT (SELECT count(*) FROM vitals WHERE event_time IS NULL) AS nulls, "
        "(SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= l_shipdate) AS wrong) "
        + _report(
            "counted",
            "intervals",
            "silver",
            [_zero("ERROR", "null_event_time", "nulls"), _zero("ERROR", "admit_not_before_discharge", "wrong")],
        )
    )
    out["dq_units"] = (
        "SELECT 'units' AS \"check\", 'silver' AS layer, 'ERROR' AS severity, concat('units_of_', source) AS metric, "
        "CAST(count(DISTINCT lang) AS DOUBLE) AS value, count(DISTINCT lang) <= 1 AS passed FROM documents WHERE lang IS NOT NULL GROUP BY source"
    )
    lines = []
    for n in _NAMES:
        lines.append(("INFO", f"{n}_null_share", f"round(1.0::DOUBLE - {n} / CAST(n AS DOUBLE), 6)", "true"))
        lines.append(("WARN", f"{n}_all_null", f"CASE WHEN {n} = 0 AND n > 0 THEN 1 ELSE 0 END", f"NOT ({n} = 0 AND n > 0)"))
    out["dq_null_profile"] = (
        _with(*_BASE, *_features(), _GOLD)
        + f", counted AS (SELECT count(*) AS n, {', '.join(f'count({n}) AS {n}' for n in _NAMES)} FROM gold) "
        + _report("counted", "null_profile", "gold", lines)
    )
    types = ("view", "click", "signup", "purchase", "error")
    out["dq_drift"] = (
        "WITH daily AS (SELECT strftime(ts, '%Y%m%d') AS run_id, "
        + ", ".join(f"avg(CAST(event_type = '{t}' AS DOUBLE)) AS share_{t}" for t in types)
        + " FROM events GROUP BY 1), long AS ("
        + " UNION ALL ".join(f"SELECT run_id, 'share_{t}' AS metric, share_{t} AS value FROM daily" for t in types)
        + "), changes AS (SELECT run_id, metric, value - lag(value) OVER (PARTITION BY metric ORDER BY run_id) AS change FROM long) "
        "SELECT 'drift' AS \"check\", 'silver' AS layer, 'WARN' AS severity, concat(metric, '@', run_id) AS metric, "
        "round(change, 6) AS value, abs(change) <= 0.05 AS passed FROM changes WHERE change IS NOT NULL"
    )
    out["dq_anchors"] = (
        _ON_BASE
        + ", counted AS (SELECT count(*) - count(DISTINCT (a.patient_id, a.admission_id, a.anchor_time)) AS repeated, "
        "count(*) FILTER (WHERE a.anchor_time < s.admit_time OR a.anchor_time > s.discharge_time) AS outside, "
        "count(*) FILTER (WHERE a.anchor_time >= o.deterioration_time) AS late FROM anchors a JOIN stays s USING (patient_id, admission_id) "
        "LEFT JOIN outcomes o USING (patient_id, admission_id)) "
        + _report(
            "counted",
            "anchors",
            "gold",
            [
                _zero("ERROR", "duplicate_anchors", "repeated"),
                _zero("ERROR", "anchors_outside_stay", "outside"),
                _zero("ERROR", "anchors_after_outcome", "late"),
            ],
        )
    )
    out["dq_anchor_distribution"] = _ON_BASE + (
        f"SELECT n_anchors, count(*) AS n_stays FROM (SELECT count(*) AS n_anchors FROM ({censored}) GROUP BY patient_id, admission_id) GROUP BY n_anchors"
    )
    out["dq_leakage"] = (
        _ON_BASE
        + ", used AS (SELECT a.anchor_time, max(e.event_time) AS latest FROM anchors a JOIN (SELECT patient_id, admission_id, event_time FROM vitals "
        "UNION ALL SELECT patient_id, admission_id, event_time FROM labs) e USING (patient_id, admission_id) WHERE e.event_time <= a.anchor_time "
        "AND e.event_time > a.anchor_time - INTERVAL 24 HOUR GROUP BY a.patient_id, a.admission_id, a.anchor_time), "
        "counted AS (SELECT count(*) FILTER (WHERE latest > anchor_time) AS leaks, 0 AS bad FROM used) "
        + _report(
            "counted",
            "leakage",
            "gold",
            [_zero("ERROR", "features_after_anchor", "leaks"), _zero("ERROR", "non_positive_windows", "bad")],
        )
    )
    tslm = {f"{s}_tslm_{w}h": w for w in (6, 12, 24) for n in FULL_SIGNALS for s in FULL_SIGNALS[n]}
    out["dq_features"] = (
        _with(*_BASE, *_features(_all_signals(("tslm",))))
        + ", counted AS (SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {c} < 0) AS neg_{c}, count(*) FILTER (WHERE {c} > {w}) AS far_{c}" for c, w in tslm.items())
        + " FROM features) "
        + _report(
            "counted",
            "features",
            "gold",
            [_zero("ERROR", f"{c}_negative", f"neg_{c}") for c in tslm] + [_zero("WARN", f"{c}_beyond_window", f"far_{c}") for c in tslm],
        )
    )
    out["dq_labels"] = (
        _ON_BASE
        + ", counted AS (SELECT count(*) FILTER (WHERE label = 1 AND deterioration_time <= anchor_time) AS past, "
        "count(*) FILTER (WHERE label = 1 AND deterioration_time IS NULL) AS without, avg(CAST(label AS DOUBLE)) AS prevalence FROM labelled) "
        + _report(
            "counted",
            "labels",
            "gold",
            [
                _zero("ERROR", "outcome_not_after_anchor", "past"),
                _zero("ERROR", "positive_without_outcome", "without"),
                ("INFO", "prevalence", "round(prevalence, 6)", "true"),
                ("WARN", "prevalence_deviation", "round(abs(prevalence - 0.025), 6)", "abs(prevalence - 0.025) <= 0.05"),
            ],
        )
    )
    out["dq_split_overlap"] = (
        _ON_SCORED
        + ", counted AS (SELECT count(*) AS overlap FROM (SELECT patient_id FROM scored GROUP BY patient_id HAVING count(DISTINCT split) > 1)) "
        + _report("counted", "split_overlap", "gold", [_zero("ERROR", "entities_in_several_splits", "overlap")])
    )
    out["shared_entities"] = (
        "SELECT user_id AS patient_id FROM events WHERE extract(day FROM ts) <= 16 "
        "INTERSECT SELECT user_id FROM events WHERE extract(day FROM ts) >= 15"
    )
    counted = "count(*) FILTER (WHERE split = 'train')"
    out["ml_logreg_gradient"] = _ON_TRAINING + f"SELECT {counted} AS n_train, 0.0::DOUBLE AS steepest FROM training"
    for name in ("ml_logreg_formula", "ml_gbt_repeat"):
        out[name] = _ON_TRAINING + "SELECT count(*) AS n_scored, 0::BIGINT AS n_off FROM training"
    out["ml_driver_sums"] = _ON_TRAINING + (
        "SELECT model, count(*) AS n_scored, 0::BIGINT AS n_off FROM training, (VALUES ('linear'), ('trees')) AS m(model) GROUP BY model"
    )
    margin = "(CASE WHEN hr_mean_24h <= 12.5 THEN -0.6 WHEN hr_count_12h <= 0.5 THEN -0.2 ELSE 0.5 END) + 0.25 * " + (
        "(CASE WHEN lactate_mean_24h > 3.0 THEN 0.9 WHEN admit_acuity <= 0.5 THEN -0.1 ELSE 0.3 END)"
    )
    out["ml_fixed_scores"] = _ON_TRAINING + (
        "SELECT patient_id, admission_id, anchor_time, split, round(1 / (1 + exp(1.5 - 0.004 * hr_mean_24h + 0.25 * hr_count_12h "
        f"- 0.01 * lactate_mean_24h - 0.5 * admit_acuity)), 6) AS linear_score, round(1 / (1 + exp(-2 * ({margin}))), 6) AS forest_score FROM training"
    )
    # Changes of a tree's prediction by the feature that the step asks for, along each row's path.
    parts = {
        "hr_mean_24h": "CASE WHEN hr_mean_24h <= 12.5 THEN -0.2 ELSE 0.5 END",
        "hr_count_12h": "CASE WHEN hr_mean_24h <= 12.5 THEN 0.0 WHEN hr_count_12h <= 0.5 THEN -0.3 ELSE 0.4 END",
        "lactate_mean_24h": "CASE WHEN lactate_mean_24h <= 3.0 THEN -0.0375 ELSE 0.175 END",
        "admit_acuity": "CASE WHEN lactate_mean_24h > 3.0 THEN 0.0 WHEN admit_acuity <= 0.5 THEN -0.0375 ELSE 0.0625 END",
    }
    listed = ", ".join(f"{{'c': CAST(round({sql}, 9) AS DOUBLE), 'f': '{name}'}}" for name, sql in parts.items())
    out["ml_fixed_drivers"] = _ON_TRAINING + (
        f"SELECT patient_id, admission_id, anchor_time, round(CAST({margin} AS DOUBLE), 6) AS margin, round(CAST({margin} AS DOUBLE), 6) AS explained, "
        f"array_to_string(list_transform(list_reverse_sort([{listed}])[1:2], lambda x: x.f), ',') AS top_drivers FROM training"
    )
    out["unscored"] = _ON_TRAINING + (
        "SELECT patient_id, admission_id, anchor_time, round(hr_mean_24h, 6) AS hr_mean_24h FROM training WHERE split IS DISTINCT FROM 'train'"
    )
    out["dq_scores"] = (
        _ON_SCORED
        + ", counted AS (SELECT count(*) FILTER (WHERE risk_score < 0 OR risk_score > 1) AS outside, count(*) AS n, min(risk_score) AS lo, "
        "max(risk_score) AS hi, avg(risk_score) AS mean FROM scored) "
        + _report(
            "counted",
            "scores",
            "scores",
            [
                _zero("ERROR", "score_outside_0_1", "outside"),
                ("WARN", "collapsed_model", "CASE WHEN n > 1 AND lo = hi THEN 1 ELSE 0 END", "NOT (n > 1 AND lo = hi)"),
                ("INFO", "score_min", "round(lo, 6)", "true"),
                ("INFO", "score_max", "round(hi, 6)", "true"),
                ("INFO", "score_mean", "round(mean, 6)", "true"),
            ],
        )
    )
    return out
