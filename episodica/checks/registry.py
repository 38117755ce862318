"""Registry of queries and of the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Shared subqueries of the oracle: the adapters and the cohort in plain SQL.
CTES = {
    "component": """
        SELECT o_custkey AS person_id, l_orderkey AS episode_id, l_linenumber AS component_no,
               CASE WHEN l_returnflag = 'R' THEN 'FELON' ELSE 'MISD' END AS severity,
               CAST(o_orderdate AS DATE) AS begin_date,
               CASE WHEN l_discount >= 0.01 THEN p_type END AS offense_code,
               CAST(s_nationkey AS VARCHAR) AS county_code,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_felony
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    "stay_rows": """
        SELECT o_custkey AS person_id, l_orderkey AS episode_id, l_linenumber AS component_no,
               CASE WHEN l_linestatus = 'F'
                    THEN CAST(o_orderdate AS DATE) + CAST(trunc(l_quantity) AS INTEGER) END AS actual_end,
               CASE WHEN l_discount >= 0.02
                    THEN CAST(o_orderdate AS DATE) + 2 * CAST(trunc(l_quantity) AS INTEGER) END AS projected_end
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "stay": """
        SELECT person_id, episode_id, component_no, actual_end, projected_end,
               COALESCE(actual_end, projected_end) AS release_date,
               CASE WHEN projected_end IS NOT NULL AND actual_end IS NULL THEN 1 ELSE 0 END AS release_imputed
        FROM (SELECT person_id, episode_id, component_no, max(actual_end) AS actual_end,
                     max(projected_end) AS projected_end
              FROM stay_rows GROUP BY ALL)""",
    "person": """
        SELECT c_custkey AS person_id,
               DATE '1940-01-01' + CAST(c_custkey * 37 % 14000 AS INTEGER) AS birth_date,
               CASE WHEN c_nationkey % 9 = 0 THEN 'FEMALE' ELSE 'MALE' END AS gender,
               c_mktsegment AS race,
               CASE WHEN c_nationkey % 5 <> 4 THEN r_name END AS ethnic,
               CASE WHEN c_acctbal >= 0 THEN round(60 + c_acctbal / 500, 2) END AS height,
               CASE WHEN c_acctbal < 9000 THEN round(170 + c_acctbal / 50, 2) END AS weight
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "scores": """
        SELECT o_orderkey AS key, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS label,
               floor(o_totalprice / 1000) / 500 AS score, c_mktsegment AS race,
               CASE WHEN c_nationkey % 9 = 0 THEN 'FEMALE' ELSE 'MALE' END AS gender
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "merged": """
        SELECT c.*, s.release_date, s.release_imputed
        FROM component c RIGHT JOIN stay s ON c.person_id = s.person_id
         AND c.episode_id = s.episode_id AND c.component_no = s.component_no""",
    "episode": """
        SELECT person_id, episode_id, max(release_date) AS release_date, min(begin_date) AS begin_date,
               count(component_no) AS total_components,
               CAST(sum(CASE WHEN severity = 'FELON' THEN 1 ELSE 0 END) AS BIGINT) AS felony_components,
               CASE WHEN sum(CASE WHEN severity = 'FELON' THEN 1 ELSE 0 END) > 0
                    THEN 'FELON' ELSE 'MISD' END AS episode_class
        FROM merged WHERE release_date > DATE '1996-01-01' AND person_id IS NOT NULL
        GROUP BY person_id, episode_id""",
    "study_episode": "SELECT * FROM episode WHERE begin_date < DATE '2001-01-01'",
    "history": """
        SELECT *, CASE WHEN episode_class = 'FELON' AND LEAD(1) OVER w = 1 THEN LEAD(begin_date) OVER w
                       ELSE DATE '2080-01-01' END AS next_start,
               row_number() OVER w - 1 AS prior_episodes
        FROM study_episode WINDOW w AS (PARTITION BY person_id ORDER BY release_date, episode_id)""",
    "labelled": """
        SELECT *, CASE WHEN next_start - release_date < 60 THEN 1 ELSE 0 END AS label,
               CAST(DATE '2001-01-01' - release_date AS INTEGER) AS follow_up_days
        FROM history""",
    "aged": """
        SELECT l.*, p.birth_date, p.gender, p.race, p.ethnic, p.height, p.weight,
               (l.begin_date - p.birth_date) / CAST(365 AS DOUBLE) AS age_at_episode,
               (l.release_date - l.begin_date) / CAST(365 AS DOUBLE) AS years_in_stay,
               min((l.begin_date - p.birth_date) / CAST(365 AS DOUBLE))
                 OVER (PARTITION BY l.person_id) AS age_at_first
        FROM labelled l LEFT JOIN person p ON l.person_id = p.person_id""",
    "cohort": "SELECT * FROM aged WHERE episode_class = 'FELON'",
    "split_rows": """
        SELECT c.*, s.split_id, s.side FROM cohort c JOIN (VALUES
          (0, 'train', DATE '1996-01-01', DATE '1996-12-31'), (0, 'test', DATE '1998-01-01', DATE '1998-12-31'),
          (1, 'train', DATE '1997-01-01', DATE '1997-12-31'), (1, 'test', DATE '1999-01-01', DATE '1999-12-31'),
          (2, 'train', DATE '1998-01-01', DATE '1998-12-31'), (2, 'test', DATE '2000-01-01', DATE '2000-12-31')
        ) AS s(split_id, side, lo, hi) ON c.release_date BETWEEN s.lo AND s.hi""",
    "own_features": """
        SELECT person_id, episode_id, split_id, side, label, f.feature, f.value FROM split_rows,
        LATERAL (VALUES ('gender_' || gender, CAST(1 AS DOUBLE)), ('race_' || race, 1), ('ethnic_' || ethnic, 1),
                        ('total_components', total_components), ('felony_components', felony_components),
                        ('prior_episodes', prior_episodes), ('age_at_episode', age_at_episode),
                        ('years_in_stay', years_in_stay), ('age_at_first', age_at_first),
                        ('height', height), ('weight', weight)) AS f(feature, value)
        WHERE f.feature IS NOT NULL AND COALESCE(f.value, 0) <> 0""",
    "count_long": """
        SELECT person_id, episode_id, 'offense_code' AS "column", offense_code AS code, count(*) AS n
        FROM component WHERE offense_code IS NOT NULL GROUP BY ALL
        UNION ALL
        SELECT person_id, episode_id, 'county_code', county_code, count(*)
        FROM component WHERE county_code IS NOT NULL GROUP BY ALL""",
    "long_features": """
        SELECT * FROM own_features
        UNION ALL
        SELECT r.person_id, r.episode_id, r.split_id, r.side, r.label,
               c."column" || '_' || c.code, CAST(c.n AS DOUBLE)
        FROM split_rows r JOIN count_long c ON r.person_id = c.person_id AND r.episode_id = c.episode_id""",
    "shared_features": """
        SELECT split_id, feature FROM long_features WHERE side = 'train'
        INTERSECT SELECT split_id, feature FROM long_features WHERE side = 'test'""",
    "flagged": """
        SELECT s.*, CASE WHEN score >= (
            SELECT score FROM (SELECT score, row_number() OVER (ORDER BY score) - 1 AS i FROM scores)
            WHERE i = (SELECT CAST(round_even((count(*) - 1) * CAST(0.95 AS DOUBLE), 0) AS BIGINT) FROM scores)
        ) THEN 1 ELSE 0 END AS predicted FROM scores s""",
    "xtab": """
        SELECT attribute, value, count(*) FILTER (predicted = 1 AND label = 1) AS tp,
               count(*) FILTER (predicted = 1 AND label = 0) AS fp,
               count(*) FILTER (predicted = 0 AND label = 0) AS tn,
               count(*) FILTER (predicted = 0 AND label = 1) AS fn,
               count(*) FILTER (predicted = 1) AS pp, count(*) FILTER (predicted = 0) AS pn,
               count(*) FILTER (label = 1) AS label_pos, count(*) FILTER (label = 0) AS label_neg,
               count(*) AS group_size
        FROM (SELECT 'race' AS attribute, race AS value, predicted, label FROM flagged
              UNION ALL SELECT 'gender', gender, predicted, label FROM flagged)
        GROUP BY attribute, value""",
    "xtab_total": """
        SELECT *, CAST(sum(pp) OVER (PARTITION BY attribute) AS BIGINT) AS total_pp,
               CAST(sum(group_size) OVER (PARTITION BY attribute) AS BIGINT) AS total_entities FROM xtab""",
    "ranked_by_race": """
        SELECT *, row_number() OVER (PARTITION BY race ORDER BY score) - 1 AS i,
               count(*) OVER (PARTITION BY race) AS n FROM scores""",
    "cut_by_race": """
        SELECT r.race, k.k, r.score AS cutoff FROM ranked_by_race r
        JOIN (VALUES (1.0), (2.0), (5.0), (10.0), (20.0), (30.0), (50.0)) AS k(k)
          ON r.i = CAST(round_even((r.n - 1) * (1 - CAST(k.k AS DOUBLE) / 100), 0) AS BIGINT)""",
    "raw_metrics": """
        SELECT s.race, CAST(c.k AS DOUBLE) AS k, c.cutoff, CAST(count(*) AS DOUBLE) AS n,
               CAST(count(*) FILTER (s.label = 1) AS DOUBLE) AS pos,
               CAST(count(*) FILTER (s.score >= c.cutoff) AS DOUBLE) AS selected,
               CAST(count(*) FILTER (s.score >= c.cutoff AND s.label = 1) AS DOUBLE) AS tp
        FROM scores s JOIN cut_by_race c ON s.race = c.race GROUP BY s.race, c.k, c.cutoff""",
    "metrics": """
        SELECT race, k, cutoff, tp / NULLIF(selected, 0) AS precision,
               (tp + n - selected - pos + tp) / n AS accuracy, tp / NULLIF(pos, 0) AS recall,
               2 * (tp / NULLIF(selected, 0)) * (tp / NULLIF(pos, 0))
                 / NULLIF(tp / NULLIF(selected, 0) + tp / NULLIF(pos, 0), 0) AS f1,
               selected / n AS actual_percent
        FROM raw_metrics""",
}


def with_ctes(body: str) -> str:
    """Prefix a statement with the shared subqueries it needs."""

    def used(sql: str) -> set[str]:
        return {n for n in CTES if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", sql)}

    needed, queue = set(), used(body)
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue |= used(CTES[name])
    parts = [f"{n} AS ({sql})" for n, sql in CTES.items() if n in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its oracle."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round doubles, so that sums taken in another order compare equal."""
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def r6(*columns: str) -> str:
    """SQL list of rounded columns under their own names."""
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)

