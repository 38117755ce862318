"""Queries for metrics at cut-offs, curves and the fairness audit."""

from __future__ import annotations

from episodica.checks.registry import query, r6, rounded
from episodica.config import CUTOFFS
from episodica.operators import evaluation, fairness, ranking
from episodica.sources import driver_tables as D

BY = ["race"]
METRIC_COLUMNS = ("precision", "accuracy", "recall", "f1", "actual_percent")


def table(spark, sf_dir):
    return ranking.score_table(D.scores(spark, sf_dir), BY)


@query(
    "metrics_at_k",
    f"SELECT race, k, round(cutoff, 6) AS cutoff, {r6(*METRIC_COLUMNS)} FROM metrics WHERE k = 5",
)
def metrics_at_k(spark, sf_dir):
    return rounded(evaluation.metrics_at(table(spark, sf_dir), BY, (5.0,)), "cutoff", *METRIC_COLUMNS)


@query("metrics_all_k", f"SELECT race, k, round(cutoff, 6) AS cutoff, {r6(*METRIC_COLUMNS)} FROM metrics")
def metrics_all_k(spark, sf_dir):
    return rounded(evaluation.metrics_at(table(spark, sf_dir), BY, CUTOFFS), "cutoff", *METRIC_COLUMNS)


@query(
    "auc_roc",
    """SELECT race, n AS total_n, pos AS total_pos,
         round((rank_sum - pos * (pos + 1) / 2.0) / (CAST(pos AS DOUBLE) * (n - pos)), 6) AS auc_roc
       FROM (SELECT race, count(*) AS n, count(*) FILTER (label = 1) AS pos,
                    CAST(sum(CASE WHEN label = 1 THEN mid END) AS DOUBLE) AS rank_sum
             FROM (SELECT race, label, rank() OVER (PARTITION BY race ORDER BY score)
                          + (count(*) OVER (PARTITION BY race, score) - 1) / 2.0 AS mid FROM scores)
             GROUP BY race)""",
)
def auc_roc(spark, sf_dir):
    return rounded(evaluation.auc_roc(table(spark, sf_dir), BY), "auc_roc")


@query(
    "pr_curve",
    """SELECT race, round(score, 6) AS threshold, round(hits / selected, 6) AS precision,
         round(hits / NULLIF(pos, 0), 6) AS recall, round(selected / n, 6) AS population
       FROM (SELECT DISTINCT race, score,
               CAST(count(*) OVER w AS DOUBLE) AS selected,
               CAST(sum(label) OVER w AS DOUBLE) AS hits,
               CAST(count(*) OVER (PARTITION BY race) AS DOUBLE) AS n,
               CAST(sum(label) OVER (PARTITION BY race) AS DOUBLE) AS pos
             FROM scores WINDOW w AS (PARTITION BY race ORDER BY score DESC RANGE UNBOUNDED PRECEDING))""",
)
def pr_curve(spark, sf_dir):
    curve = evaluation.pr_curve(table(spark, sf_dir), BY)
    return rounded(curve, "threshold", "precision", "recall", "population")


GRID_COLUMNS = [f"{p}_{k:g}" for k in CUTOFFS for p in evaluation.GRID_METRICS]


@query(
    "results_grid",
    "SELECT race, "
    + ", ".join(
        f"round(max(CASE WHEN k = {k} THEN {m} END), 6) AS {p}_{k:g}"
        for k in CUTOFFS
        for p, m in evaluation.GRID_METRICS.items()
    )
    + " FROM metrics GROUP BY race",
)
def results_grid(spark, sf_dir):
    metrics = evaluation.metrics_at(table(spark, sf_dir), BY, CUTOFFS)
    return rounded(evaluation.results_grid(metrics, BY, CUTOFFS), *GRID_COLUMNS)


ATTRIBUTES = ["race", "gender"]
REFERENCES = {"race": "BUILDING", "gender": "MALE"}
METRICS = list(fairness.METRICS)
QUOTED = {m: f'"{m}"' for m in METRICS}
GROUP_SQL = ", ".join(
    f"{num} / CAST(NULLIF({den}, 0) AS DOUBLE) AS {QUOTED[m]}" for m, (num, den) in fairness.METRICS.items()
)
METRIC_SQL = f"(SELECT *, {GROUP_SQL} FROM xtab_total)"
CHOSEN = "((attribute = 'race' AND value = 'BUILDING') OR (attribute = 'gender' AND value = 'MALE'))"
DISPARITY_SQL = ", ".join(f"g.{q} / NULLIF(r.{q}, 0) AS {m}_disparity" for m, q in QUOTED.items())
COUNTS = (
    "tp", "fp", "tn", "fn", "pp", "pn", "label_pos", "label_neg", "group_size", "total_pp", "total_entities",
)


def audited(spark, sf_dir):
    flagged = ranking.flag_top_share(D.scores(spark, sf_dir), [], 5.0)
    return fairness.group_metrics(fairness.crosstab(flagged, ATTRIBUTES))


@query("fair_crosstab", f"SELECT attribute, value, {', '.join(COUNTS)} FROM xtab_total")
def fair_crosstab(spark, sf_dir):
    return audited(spark, sf_dir).select("attribute", "value", *COUNTS)


@query(
    "fair_metrics",
    f"SELECT attribute, value, {', '.join(f'round({q}, 6) AS {q}' for q in QUOTED.values())} FROM {METRIC_SQL}",
)
def fair_metrics(spark, sf_dir):
    return rounded(audited(spark, sf_dir).select("attribute", "value", *METRICS), *METRICS)


DISPARITIES = [f"{m}_disparity" for m in METRICS]
REF_SQL = f"""(SELECT g.*, r.value AS ref_value, {DISPARITY_SQL} FROM {METRIC_SQL} g
    LEFT JOIN (SELECT * FROM {METRIC_SQL} WHERE {CHOSEN}) r ON g.attribute = r.attribute)"""
MAJOR_SQL = f"""(SELECT g.*, r.value AS ref_value, {DISPARITY_SQL} FROM {METRIC_SQL} g
    LEFT JOIN (SELECT * FROM {METRIC_SQL} QUALIFY row_number() OVER
               (PARTITION BY attribute ORDER BY group_size DESC, value) = 1) r ON g.attribute = r.attribute)"""


@query("fair_disparity_ref", f"SELECT attribute, value, ref_value, {r6(*DISPARITIES)} FROM {REF_SQL}")
def fair_disparity_ref(spark, sf_dir):
    found = fairness.disparities(audited(spark, sf_dir), REFERENCES)
    return rounded(found.select("attribute", "value", "ref_value", *DISPARITIES), *DISPARITIES)


@query("fair_disparity_major", f"SELECT attribute, value, ref_value, {r6(*DISPARITIES)} FROM {MAJOR_SQL}")
def fair_disparity_major(spark, sf_dir):
    found = fairness.disparities(audited(spark, sf_dir))
    return rounded(found.select("attribute", "value", "ref_value", *DISPARITIES), *DISPARITIES)


def z_sql(num: str, den: str) -> str:
    n1, n2 = f"CAST(NULLIF(g.{den}, 0) AS DOUBLE)", f"CAST(NULLIF(r.{den}, 0) AS DOUBLE)"
    pooled = f"((g.{num} + r.{num}) / CAST(NULLIF(g.{den} + r.{den}, 0) AS DOUBLE))"
    spread = f"sqrt({pooled} * (1 - {pooled}) * (1 / {n1} + 1 / {n2}))"
    return f"(g.{num} / {n1} - r.{num} / {n2}) / NULLIF({spread}, 0)"


@query(
    "fair_significance",
    " UNION ALL ".join(
        f"""SELECT g.attribute, g.value, r.value AS ref_value, '{m}' AS metric, round({z_sql(num, den)}, 6) AS z
            FROM xtab_total g LEFT JOIN (SELECT * FROM xtab_total WHERE {CHOSEN}) r ON g.attribute = r.attribute"""
        for m, (num, den) in fairness.METRICS.items()
    ),
)
def fair_significance(spark, sf_dir):
    tested = fairness.significance(audited(spark, sf_dir), REFERENCES)
    return rounded(tested.select("attribute", "value", "ref_value", "metric", "z"), "z")


def p_sql(z: str) -> str:
    """The same rational form of erfc(|z| / sqrt(2))."""
    x = f"(abs({z}) / sqrt(CAST(2 AS DOUBLE)))"
    t = f"(1 / (1 + {x} / 2))"
    poly = " + ".join(f"({c}) * pow({t}, {i})" for i, c in enumerate(fairness.ERFC))
    return f"{t} * exp({poly} - {x} * {x})"


@query(
    "fair_p_values",
    f"""SELECT attribute, value, ref_value, metric, round(z, 6) AS z, round(p, 6) AS p_value, p < 0.05 AS significant
        FROM (SELECT *, {p_sql('z')} AS p FROM ({" UNION ALL ".join(
            f"SELECT g.attribute, g.value, r.value AS ref_value, '{m}' AS metric, {z_sql(num, den)} AS z "
            f"FROM xtab_total g LEFT JOIN (SELECT * FROM xtab_total WHERE {CHOSEN}) r ON g.attribute = r.attribute"
            for m, (num, den) in fairness.METRICS.items())}))""",
)
def fair_p_values(spark, sf_dir):
    return rounded(fairness.significance(audited(spark, sf_dir), REFERENCES), "z", "p_value")


IN_PARITY = {m: f"({m}_disparity BETWEEN CAST(0.8 AS DOUBLE) AND 1 / CAST(0.8 AS DOUBLE))" for m in METRICS}
COMPOSITE_SQL = {name: f"({IN_PARITY[a]} AND {IN_PARITY[b]})" for name, (a, b) in fairness.COMPOSITES.items()}
PARITIES = [f"{m}_parity" for m in METRICS] + [*fairness.COMPOSITES, "supervised"]


@query(
    "fair_parity",
    "SELECT attribute, value, "
    + ", ".join(f"{sql} AS {m}_parity" for m, sql in IN_PARITY.items())
    + ", "
    + ", ".join(f"{sql} AS {name}" for name, sql in COMPOSITE_SQL.items())
    + f", ({COMPOSITE_SQL['type1_parity']} AND {COMPOSITE_SQL['type2_parity']}) AS supervised FROM {REF_SQL}",
)
def fair_parity(spark, sf_dir):
    found = fairness.parity(fairness.disparities(audited(spark, sf_dir), REFERENCES))
    return found.select("attribute", "value", *PARITIES)


@query(
    "fair_long",
    " UNION ALL ".join(
        f"""SELECT attribute, value, group_size, '{m}' AS metric, round({q}, 6) AS metric_value,
            round({m}_disparity, 6) AS disparity, {IN_PARITY[m]} AS parity FROM {REF_SQL}"""
        for m, q in QUOTED.items()
    ),
)
def fair_long(spark, sf_dir):
    found = fairness.parity(fairness.disparities(audited(spark, sf_dir), REFERENCES))
    return rounded(fairness.long_form(found), "metric_value", "disparity")
