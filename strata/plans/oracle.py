"""Independent SQL (DuckDB dialect) for every catalogue query.

Written from the operator semantics, not generated from the Spark plans.
Type rules: DuckDB sums of integers are HUGEINT and row_number is BIGINT, so
both are cast to Spark's types; divisions use NULLIF for the zero guard.
"""

from __future__ import annotations

# ---- shared CTEs ---------------------------------------------------------------

ACCIDENTS_RAW = """accidents_raw AS (
  SELECT o.o_orderkey AS num_acc,
         CAST(year(o.o_orderdate) AS INTEGER) AS an,
         CAST(month(o.o_orderdate) AS INTEGER) AS mois,
         CAST(day(o.o_orderdate) AS INTEGER) AS jour,
         strftime(e.ts, '%H:%M') AS hrmn,
         lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS dep,
         TRY_CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS atm
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN events e ON o.o_orderkey = e.event_id)"""

ACCIDENTS = ACCIDENTS_RAW + """,
accidents AS (
  SELECT num_acc, an, mois, jour, hrmn, trim(dep) AS dep, atm,
         CASE WHEN regexp_matches(hrmn, '^[0-9]{2}:[0-9]{2}$')
              THEN TRY_CAST(substr(hrmn, 1, 2) AS INTEGER) END AS heure_int,
         atm AS meteo
  FROM (SELECT DISTINCT * FROM accidents_raw)
  WHERE num_acc IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY num_acc ORDER BY an, mois, jour, hrmn, dep, atm) = 1)"""

# Duplicates are judged on whole source rows.
PERSON_OF = """l_orderkey AS num_acc, l_linenumber AS num_veh,
         CASE WHEN l_linenumber = 1 THEN 1 ELSE 2 END AS catu,
         CASE WHEN l_discount < 0.05 THEN 1 ELSE 2 END AS sexe,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 2
              WHEN l_returnflag = 'R' THEN 3
              WHEN l_returnflag = 'A' THEN 4
              WHEN l_linestatus = 'F' THEN 1
              ELSE -1 END AS grav"""
PERSONS_RAW = f"""persons_raw AS (SELECT l.*, {PERSON_OF} FROM lineitem l)"""

PERSONS = f"""persons AS (
  SELECT {PERSON_OF} FROM (SELECT DISTINCT * FROM lineitem) WHERE l_orderkey IS NOT NULL)"""

SCORE = """CASE grav WHEN 2 THEN 4 WHEN 3 THEN 3 WHEN 4 THEN 2 WHEN 1 THEN 1 END"""

SEVERITY = PERSONS + f""",
severity AS (
  SELECT num_acc,
         max({SCORE}) AS gravite_max,
         CAST(sum(CASE WHEN grav = 2 THEN 1 ELSE 0 END) AS BIGINT) AS nb_tues,
         CAST(sum(CASE WHEN grav = 3 THEN 1 ELSE 0 END) AS BIGINT) AS nb_hospitalises,
         count(*) AS nb_usagers,
         CAST(max({SCORE}) >= 3 AS INTEGER) AS accident_grave
  FROM persons GROUP BY num_acc)"""

PLACES = """places_raw AS (
  SELECT l.*, l_orderkey AS num_acc, l_linestatus AS surf, l_suppkey AS supp FROM lineitem l),
places AS (
  SELECT num_acc, surf, supp, surf AS etat_route FROM (SELECT DISTINCT * FROM places_raw) WHERE num_acc IS NOT NULL)"""

VEHICLES = """vehicles_raw AS (
  SELECT l.*, l.l_orderkey AS num_acc, l.l_linenumber AS num_veh, p.p_type AS cat_veh
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
vehicles AS (
  SELECT l.l_orderkey AS num_acc, l.l_linenumber AS num_veh, p.p_type AS cat_veh
  FROM (SELECT DISTINCT * FROM lineitem) l JOIN part p ON l.l_partkey = p.p_partkey WHERE l.l_orderkey IS NOT NULL)"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


DEPT_RATE = w(ACCIDENTS, SEVERITY) + """,
dep_stats AS (
  SELECT a.dep, count(DISTINCT a.num_acc) AS total_accidents,
         CAST(sum(s.accident_grave) AS BIGINT) AS accidents_graves
  FROM accidents a JOIN severity s ON a.num_acc = s.num_acc GROUP BY a.dep)
"""

ORACLE: dict[str, str] = {}

ORACLE["severity_per_accident"] = w(SEVERITY) + "SELECT * FROM severity"

ORACLE["enrich_severity_score"] = w(PERSONS) + f"""
SELECT grav, {SCORE} AS score_gravite, count(*) AS nb_usagers FROM persons GROUP BY ALL"""

ORACLE["rank_departments_serious_rate"] = DEPT_RATE.replace("WITH ", "WITH ", 1) + """
SELECT dep, total_accidents, accidents_graves,
       accidents_graves / NULLIF(total_accidents, 0) AS taux_graves,
       CAST(row_number() OVER (ORDER BY accidents_graves / NULLIF(total_accidents, 0) DESC NULLS LAST, dep ASC) AS INTEGER) AS rang_dep
FROM dep_stats
QUALIFY rang_dep <= 20"""

ORACLE["join_severity_by_weather"] = w(ACCIDENTS, SEVERITY) + """
SELECT a.meteo, count(DISTINCT a.num_acc) AS nb_accidents, avg(s.gravite_max) AS gravite_moyenne,
       CAST(sum(s.nb_tues) AS BIGINT) AS total_tues
FROM accidents a JOIN severity s ON a.num_acc = s.num_acc GROUP BY a.meteo"""

ORACLE["agg_weather_surface"] = w(ACCIDENTS, SEVERITY, PLACES) + """
SELECT meteo, etat_route, count(*) AS nb_accidents,
       CAST(sum(CASE WHEN accident_grave = 1 THEN 1 ELSE 0 END) AS BIGINT) AS nb_graves
FROM (SELECT DISTINCT a.meteo, p.etat_route, a.num_acc, s.accident_grave
      FROM accidents a JOIN places p ON a.num_acc = p.num_acc JOIN severity s ON a.num_acc = s.num_acc)
GROUP BY meteo, etat_route"""

_DEPTS = w(ACCIDENTS, PLACES) + """
SELECT a.dep, count(DISTINCT a.num_acc) AS nb_accidents
FROM accidents a JOIN places p ON a.num_acc = p.num_acc GROUP BY a.dep"""
ORACLE["join_departments_shuffle"] = _DEPTS
ORACLE["join_departments_broadcast"] = _DEPTS

ORACLE["agg_department_hour"] = w(ACCIDENTS, PLACES) + """
SELECT a.dep, a.heure_int, count(DISTINCT a.num_acc) AS nb_accidents
FROM accidents a JOIN places p ON a.num_acc = p.num_acc GROUP BY a.dep, a.heure_int"""

ORACLE["agg_distinct_count"] = w(PLACES, VEHICLES) + """
SELECT 'etat_route' AS dimension, etat_route AS category, count(DISTINCT num_acc) AS nb_accidents
FROM places GROUP BY etat_route
UNION ALL
SELECT 'cat_veh' AS dimension, cat_veh AS category, count(DISTINCT num_acc) AS nb_accidents
FROM vehicles GROUP BY cat_veh"""

ORACLE["agg_count_by_category"] = w(ACCIDENTS) + """
SELECT meteo, count(*) AS nb_accidents FROM accidents GROUP BY meteo"""

ORACLE["skew_profile"] = w(ACCIDENTS, PLACES) + """,
per_dep AS (
  SELECT a.dep, count(*) AS joined_rows, count(DISTINCT a.num_acc) AS distinct_accidents
  FROM accidents a JOIN places p ON a.num_acc = p.num_acc GROUP BY a.dep),
long AS (
  SELECT 'joined_rows' AS measure, joined_rows AS n FROM per_dep
  UNION ALL SELECT 'distinct_accidents' AS measure, distinct_accidents AS n FROM per_dep)
SELECT measure, min(n) AS min_n, max(n) AS max_n, avg(n) AS avg_n,
       max(n) / NULLIF(avg(n), 0) AS ratio_max_avg
FROM long GROUP BY measure"""

ORACLE["topk_groups"] = w(ACCIDENTS) + """
SELECT dep, count(*) AS nb_accidents FROM accidents GROUP BY dep
ORDER BY nb_accidents DESC, dep ASC LIMIT 5"""

ORACLE["having_min_count"] = """
SELECT l_partkey AS item_id, avg(l_quantity) AS note_moyenne, count(*) AS nb_votes
FROM lineitem GROUP BY l_partkey HAVING count(*) >= 5
ORDER BY note_moyenne DESC, item_id ASC LIMIT 10"""

# ---- step 2: cleaning over the text bronze -------------------------------------

DIRTY = """dirty_base AS (
  SELECT CASE WHEN o.o_orderstatus = 'P' AND substr(o.o_orderpriority, 1, 1) = '5' THEN NULL
              WHEN o.o_orderstatus = 'P' AND substr(o.o_orderpriority, 1, 1) = '4' THEN '   '
              ELSE CAST(o.o_orderkey AS VARCHAR) END AS num_acc,
         CASE WHEN o.o_orderstatus = 'O' AND substr(o.o_orderpriority, 1, 1) = '5' THEN 'n/a'
              WHEN o.o_orderstatus = 'P' AND substr(o.o_orderpriority, 1, 1) = '3' THEN CAST(year(o.o_orderdate) + 100 AS VARCHAR)
              ELSE CAST(year(o.o_orderdate) AS VARCHAR) END AS an,
         lpad(CAST(month(o.o_orderdate) AS VARCHAR), 2, '0') AS mois,
         lpad(CAST(day(o.o_orderdate) AS VARCHAR), 2, '0') AS jour,
         CASE WHEN e.event_type = 'error' THEN strftime(e.ts, '%-H:%M') ELSE strftime(e.ts, '%H:%M') END AS hrmn,
         CASE WHEN o.o_orderstatus = 'F' AND substr(o.o_orderpriority, 1, 1) = '2'
              THEN ' ' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') || ' '
              ELSE lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') END AS dep,
         substr(o.o_orderpriority, 1, 1) AS atm,
         (o.o_orderstatus = 'F' AND substr(o.o_orderpriority, 1, 1) = '1') AS again
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN events e ON o.o_orderkey = e.event_id),
dirty AS (
  SELECT num_acc, an, mois, jour, hrmn, dep, atm FROM dirty_base
  UNION ALL SELECT num_acc, an, mois, jour, hrmn, dep, atm FROM dirty_base WHERE again)"""

KEY_OK = "num_acc IS NOT NULL AND length(trim(num_acc)) > 0"
YEAR_OK = "TRY_CAST(an AS INTEGER) BETWEEN 1990 AND 2030"
HOUR = """CASE WHEN regexp_matches(hrmn, '^[0-9]{2}:[0-9]{2}$') THEN TRY_CAST(substr(hrmn, 1, 2) AS INTEGER) END"""

TYPED_DIRTY = """TRY_CAST(trim(num_acc) AS BIGINT) AS num_acc, TRY_CAST(trim(an) AS INTEGER) AS an,
       TRY_CAST(trim(mois) AS INTEGER) AS mois, TRY_CAST(trim(jour) AS INTEGER) AS jour,
       hrmn, dep, TRY_CAST(trim(atm) AS INTEGER) AS atm"""

ORACLE["proj_select_rename"] = w(ACCIDENTS_RAW) + "SELECT num_acc, dep, atm AS meteo FROM accidents_raw"

ORACLE["clean_required_keys"] = w(DIRTY) + f"SELECT * FROM dirty WHERE {KEY_OK}"

ORACLE["clean_year_range"] = w(DIRTY) + f"SELECT num_acc, an FROM dirty WHERE {YEAR_OK}"

ORACLE["clean_trim_codes"] = w(DIRTY) + "SELECT trim(dep) AS dep, count(*) AS nb FROM dirty GROUP BY 1"

ORACLE["enrich_hour"] = w(DIRTY) + f"""
SELECT {HOUR} AS heure_int, count(*) AS nb, count(hrmn) AS nb_avec_texte FROM dirty GROUP BY 1"""

ORACLE["enrich_hour_quality"] = w(DIRTY) + f"""
SELECT count(*) AS nb_lignes,
       CAST(sum(CASE WHEN hrmn IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS heure_absente,
       CAST(sum(CASE WHEN hrmn IS NOT NULL AND ({HOUR}) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS heure_mal_formee,
       CAST(sum(CASE WHEN ({HOUR}) IS NOT NULL AND (({HOUR}) < 0 OR ({HOUR}) > 23) THEN 1 ELSE 0 END) AS BIGINT)
         AS heure_hors_journee
FROM dirty"""

ORACLE["enrich_safe_cast"] = w(DIRTY) + """
SELECT TRY_CAST(an AS INTEGER) AS an_int, count(*) AS nb FROM dirty GROUP BY 1"""

ORACLE["dedup_full_row"] = w(DIRTY) + "SELECT DISTINCT * FROM dirty"

_REPORT_TABLE = """
SELECT '{name}' AS table_name, CAST(sum(copies) AS BIGINT) AS raw_rows,
       CAST(sum(copies) - count(*) AS BIGINT) AS duplicate_rows,
       CAST(sum(CASE WHEN {key_bad} THEN 1 ELSE 0 END) AS BIGINT) AS rejected_key,
       CAST(sum(CASE WHEN NOT ({key_bad}) AND {req_bad} THEN 1 ELSE 0 END) AS BIGINT) AS rejected_required,
       CAST(sum(CASE WHEN NOT ({key_bad}) AND NOT ({req_bad}) AND {range_bad} THEN 1 ELSE 0 END) AS BIGINT) AS rejected_range,
       CAST(0 AS BIGINT) AS rejected_outlier, CAST({repeated} AS BIGINT) AS rejected_repeated_key,
       CAST(sum(CASE WHEN NOT ({key_bad}) AND NOT ({req_bad}) AND NOT ({range_bad}) THEN 1 ELSE 0 END) - ({repeated}) AS BIGINT) AS kept_rows
FROM (SELECT *, count(*) AS copies FROM {src} GROUP BY ALL)"""

ORACLE["clean_report"] = w(DIRTY, ACCIDENTS_RAW, PERSONS_RAW, PLACES, VEHICLES) + " UNION ALL ".join([
    _REPORT_TABLE.format(name="accidents", src="dirty", key_bad=f"NOT coalesce({KEY_OK}, false)",
                         req_bad="false", range_bad=f"NOT coalesce({YEAR_OK}, false)",
                         repeated=f"count(*) FILTER (WHERE {KEY_OK} AND {YEAR_OK}) - count(DISTINCT CASE WHEN {KEY_OK} AND {YEAR_OK} THEN trim(num_acc) END)"),
    _REPORT_TABLE.format(name="places", src="places_raw", key_bad="num_acc IS NULL",
                         req_bad="false", range_bad="false", repeated="0"),
    _REPORT_TABLE.format(name="vehicles", src="vehicles_raw", key_bad="num_acc IS NULL",
                         req_bad="false", range_bad="false", repeated="0"),
    _REPORT_TABLE.format(name="persons", src="persons_raw", key_bad="num_acc IS NULL",
                         req_bad="grav IS NULL", range_bad="false", repeated="0"),
])

ORACLE["clean_reject_reasons"] = w(DIRTY) + f"""
SELECT CASE WHEN num_acc IS NULL THEN 'key_missing'
            WHEN NOT (length(trim(num_acc)) > 0) THEN 'key_blank'
            WHEN NOT coalesce({YEAR_OK}, false) THEN 'out_of_range_an' END AS reject_reason,
       count(*) AS nb
FROM dirty GROUP BY 1"""

ORACLE["silver_from_text"] = w(DIRTY) + f""",
kept AS (SELECT * REPLACE (trim(dep) AS dep) FROM (SELECT DISTINCT * FROM dirty) WHERE {KEY_OK} AND {YEAR_OK}
  QUALIFY row_number() OVER (PARTITION BY num_acc ORDER BY an, mois, jour, hrmn, trim(dep), atm) = 1)
SELECT {TYPED_DIRTY}, {HOUR} AS heure_int, TRY_CAST(trim(atm) AS INTEGER) AS meteo FROM kept"""

# ---- step 4: sources, sinks, reports ------------------------------------------------

ORACLE["src_csv_typed"] = w(DIRTY) + f"SELECT {TYPED_DIRTY} FROM dirty"
ORACLE["src_csv_contract"] = ORACLE["src_csv_typed"]

_BAD = "CAST(sum(CASE WHEN {c} IS NOT NULL AND length(trim({c})) > 0 AND TRY_CAST(trim({c}) AS {t}) IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
ORACLE["src_bad_cells"] = w(DIRTY) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_BAD.format(c=c, t=t)} AS bad_cells FROM dirty"
    for c, t in (("num_acc", "BIGINT"), ("an", "INTEGER"), ("mois", "INTEGER"), ("jour", "INTEGER"), ("atm", "INTEGER")))

ORACLE["ingest_row_counts"] = w(ACCIDENTS_RAW, PERSONS_RAW, PLACES, VEHICLES) + """
SELECT 'accidents' AS table_name, count(*) AS nb_rows FROM accidents_raw
UNION ALL SELECT 'places', count(*) FROM places_raw
UNION ALL SELECT 'vehicles', count(*) FROM vehicles_raw
UNION ALL SELECT 'persons', count(*) FROM persons_raw"""

ORACLE["sink_parquet_roundtrip"] = ORACLE["join_severity_by_weather"]

ORACLE["sink_partitioned_roundtrip"] = w(ACCIDENTS) + "SELECT * FROM accidents"

ORACLE["profile_schema"] = w(ACCIDENTS) + """
SELECT * FROM (VALUES ('num_acc', 'bigint'), ('an', 'int'), ('mois', 'int'), ('jour', 'int'),
  ('hrmn', 'string'), ('dep', 'string'), ('atm', 'int'), ('heure_int', 'int'), ('meteo', 'int')) t(column_name, data_type)
JOIN (UNPIVOT (SELECT count(num_acc) AS num_acc, count(an) AS an, count(mois) AS mois, count(jour) AS jour,
               count(hrmn) AS hrmn, count(dep) AS dep, count(atm) AS atm, count(heure_int) AS heure_int,
               count(meteo) AS meteo FROM accidents)
      ON COLUMNS(*) INTO NAME column_name VALUE non_null) u USING (column_name)"""

_REPORT_LONG = ORACLE["clean_report"]
ORACLE["run_metrics_rows"] = f"""
SELECT 'nettoyage' AS step, table_name, metric, CAST(value AS BIGINT) AS value
FROM (UNPIVOT ({_REPORT_LONG}) ON COLUMNS(* EXCLUDE (table_name)) INTO NAME metric VALUE value)"""

ORACLE["enrich_code_labels"] = w(PERSONS) + """
SELECT p.grav, coalesce(l.libelle, 'inconnu') AS libelle, count(*) AS nb_usagers
FROM persons p LEFT JOIN (VALUES (1, 'indemne'), (2, 'tue'), (3, 'blesse hospitalise'), (4, 'blesse leger')) l(code, libelle)
  ON p.grav = l.code
GROUP BY ALL"""

# ---- step 5: physical control -----------------------------------------------------

ORACLE["cache_reuse_counts"] = w(ACCIDENTS) + """
SELECT CAST(meteo AS VARCHAR) AS category, count(*) AS nb, 'meteo' AS dimension FROM accidents GROUP BY meteo
UNION ALL SELECT dep AS category, count(*) AS nb, 'dep' AS dimension FROM accidents GROUP BY dep"""

ORACLE["repartition_agg"] = w(ACCIDENTS, PLACES) + """
SELECT a.dep, count(*) AS nb FROM accidents a JOIN places p ON a.num_acc = p.num_acc GROUP BY a.dep"""

# ---- step 6 ---------------------------------------------------------------------------

ORACLE["dedup_by_key"] = w(PERSONS) + f"""
SELECT num_acc, num_veh, catu, sexe, grav, score_gravite FROM (
  SELECT *, {SCORE} AS score_gravite FROM persons)
QUALIFY row_number() OVER (PARTITION BY num_acc ORDER BY score_gravite DESC NULLS LAST, num_veh, catu, sexe, grav) = 1"""

ORACLE["pushdown_partition_filter"] = w(ACCIDENTS) + """
SELECT meteo, count(*) AS nb_accidents FROM accidents WHERE dep = '07' GROUP BY meteo"""

# ---- step 7 ---------------------------------------------------------------------------

ORACLE["salted_agg"] = w(ACCIDENTS, PLACES) + """
SELECT a.dep, count(*) AS nb_lignes, count(DISTINCT a.num_acc) AS nb_accidents
FROM accidents a JOIN places p ON a.num_acc = p.num_acc GROUP BY a.dep"""

ORACLE["filter_compound"] = w(PERSONS) + """
SELECT grav, count(*) AS nb FROM persons WHERE (grav = 2 AND catu = 1) OR NOT (num_veh < 5) GROUP BY grav"""

ORACLE["clean_na_drop_fill"] = w(ACCIDENTS) + """
SELECT coalesce(heure_int, -1) AS heure_int, count(*) AS nb, 'fill' AS methode FROM accidents GROUP BY 1
UNION ALL SELECT heure_int, count(*) AS nb, 'drop' AS methode FROM accidents WHERE hrmn IS NOT NULL GROUP BY 1"""

ORACLE["enrich_weekday"] = w(DIRTY) + """
SELECT CAST(dayofweek(TRY_CAST(lpad(CAST(TRY_CAST(an AS INTEGER) AS VARCHAR), 4, '0') || '-' ||
                               lpad(CAST(TRY_CAST(mois AS INTEGER) AS VARCHAR), 2, '0') || '-' ||
                               lpad(CAST(TRY_CAST(jour AS INTEGER) AS VARCHAR), 2, '0') AS DATE)) + 1 AS INTEGER) AS jour_semaine,
       count(*) AS nb
FROM dirty GROUP BY 1"""

ORACLE["enrich_hour_bucket"] = w(ACCIDENTS) + """
SELECT CASE WHEN heure_int < 6 THEN 'night' WHEN heure_int < 12 THEN 'morning'
            WHEN heure_int < 18 THEN 'afternoon' WHEN heure_int <= 23 THEN 'evening' END AS tranche,
       count(*) AS nb FROM accidents GROUP BY 1"""

ORACLE["join_four_tables"] = w(ACCIDENTS, PLACES, VEHICLES, SEVERITY) + """
SELECT a.*, coalesce(p.nb_lieux, 0) AS nb_lieux, coalesce(v.nb_vehicules, 0) AS nb_vehicules,
       coalesce(v.nb_categories, 0) AS nb_categories, s.gravite_max, coalesce(s.nb_usagers, 0) AS nb_usagers,
       s.accident_grave
FROM accidents a
LEFT JOIN (SELECT num_acc, count(*) AS nb_lieux FROM places GROUP BY num_acc) p ON a.num_acc = p.num_acc
LEFT JOIN (SELECT num_acc, count(*) AS nb_vehicules, count(DISTINCT cat_veh) AS nb_categories
           FROM vehicles GROUP BY num_acc) v ON a.num_acc = v.num_acc
LEFT JOIN severity s ON a.num_acc = s.num_acc"""

ORACLE["join_dimension_lookup"] = w(ACCIDENTS) + """
SELECT r.r_name, count(*) AS nb_accidents
FROM accidents a JOIN nation n ON a.dep = lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')
JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name"""

ORACLE["crosstab_pivot"] = w(ACCIDENTS) + """
SELECT dep, """ + ", ".join(
    f"count(*) FILTER (WHERE meteo = {v}) AS meteo_{v}" for v in (1, 2, 3, 4, 5)) + """,
       count(*) FILTER (WHERE meteo IS NULL OR meteo NOT IN (1, 2, 3, 4, 5)) AS meteo_autre
FROM accidents GROUP BY dep"""

ORACLE["agg_user_profiles"] = w(PERSONS) + """
SELECT sexe, catu, count(*) AS nb_usagers,
       CAST(sum(CASE WHEN grav = 2 THEN 1 ELSE 0 END) AS BIGINT) AS nb_tues,
       CAST(sum(CASE WHEN grav = 3 THEN 1 ELSE 0 END) AS BIGINT) AS nb_hospitalises,
       CAST(sum(CASE WHEN grav = 2 THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(count(*), 0) AS part_tues
FROM persons GROUP BY sexe, catu"""

ORACLE["agg_weekday_hour"] = w(ACCIDENTS) + """
SELECT CAST(dayofweek(make_date(an, mois, jour)) + 1 AS INTEGER) AS jour_semaine, heure_int, count(*) AS nb_accidents
FROM accidents GROUP BY 1, 2"""

ORACLE["rank_within_group"] = w(ACCIDENTS) + """
SELECT meteo, dep, nb_accidents,
       CAST(row_number() OVER (PARTITION BY meteo ORDER BY nb_accidents DESC, dep ASC) AS INTEGER) AS rang
FROM (SELECT meteo, dep, count(*) AS nb_accidents FROM accidents GROUP BY meteo, dep)
QUALIFY rang <= 3"""

ORACLE["udf_equivalence"] = w(PERSONS) + """
SELECT grav, count(*) AS nb, count(*) AS nb_udf_egal, count(*) AS nb_udf_pickled_egal, count(*) AS nb_pandas_egal, count(*) AS nb_arrow_egal
FROM persons GROUP BY grav"""

ORACLE["upsert_latest"] = w(ACCIDENTS) + """
SELECT * REPLACE (CASE WHEN an >= 1998 AND num_acc % 7 = 0 THEN '07' ELSE dep END AS dep),
       CASE WHEN an >= 1998 THEN 3 ELSE 2 END AS version FROM accidents"""

ORACLE["format_roundtrip_agg"] = w(ACCIDENTS) + """
SELECT meteo, count(*) AS nb, f.format
FROM accidents CROSS JOIN (VALUES ('csv'), ('json'), ('orc'), ('parquet')) f(format)
GROUP BY meteo, f.format"""

_PROFILE_COL = """SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min_value,
       CAST(max({c}) AS DOUBLE) AS max_value FROM accidents"""
ORACLE["profile_numeric"] = w(ACCIDENTS) + " UNION ALL ".join(
    _PROFILE_COL.format(c=c) for c in ("an", "mois", "jour", "heure_int", "meteo"))

# ---- step 8 ---------------------------------------------------------------------------

ORACLE["agg_yearly_change"] = w(ACCIDENTS) + """
SELECT an, nb_accidents, nb_accidents - lag(nb_accidents) OVER (ORDER BY an) AS variation,
       round((nb_accidents - lag(nb_accidents) OVER (ORDER BY an))
             / NULLIF(lag(nb_accidents) OVER (ORDER BY an), 0) * 100, 6) AS variation_pct
FROM (SELECT an, count(*) AS nb_accidents FROM accidents GROUP BY an)"""

ORACLE["agg_revenue_by_hour"] = """
SELECT CAST(hour(ts) AS INTEGER) AS heure, count(*) AS nb, round(sum(value), 6) AS total,
       round(avg(value), 6) AS moyenne
FROM events GROUP BY 1"""

ORACLE["agg_unit_price"] = """
SELECT p.p_type, count(l.l_extendedprice / NULLIF(l.l_quantity, 0)) AS nb,
       round(avg(l.l_extendedprice / NULLIF(l.l_quantity, 0)), 6) AS prix_unitaire_moyen,
       round(min(l.l_extendedprice / NULLIF(l.l_quantity, 0)), 6) AS prix_unitaire_min,
       round(max(l.l_extendedprice / NULLIF(l.l_quantity, 0)), 6) AS prix_unitaire_max
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_type"""

ORACLE["topk_pairs"] = """
SELECT s.s_nationkey AS origine, c.c_nationkey AS destination, count(*) AS nb
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY 1, 2 ORDER BY nb DESC, origine, destination LIMIT 10"""

ORACLE["detect_outliers_zscore"] = """
SELECT e.event_id, e.event_type, e.value, round((e.value - s.mu) / NULLIF(s.sd, 0), 4) AS zscore
FROM events e JOIN (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM events GROUP BY event_type) s
  ON e.event_type = s.event_type
WHERE abs((e.value - s.mu) / NULLIF(s.sd, 0)) > 2.0"""

ORACLE["src_multifile_months"] = w(ACCIDENTS) + """
SELECT an, mois, count(*) AS nb_accidents FROM accidents GROUP BY an, mois"""

ORACLE["src_csv_gzip"] = ORACLE["src_csv_typed"]

ORACLE["json_event_props"] = """
SELECT event_type, count(*) AS nb, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS somme_k,
       min(CAST(json_extract(props, '$.k') AS INTEGER)) AS min_k, max(CAST(json_extract(props, '$.k') AS INTEGER)) AS max_k
FROM events GROUP BY event_type"""

ORACLE["src_json_nested"] = """
SELECT event_type, 'value' AS measure, count(*) AS nb, round(sum(value), 6) AS total FROM events GROUP BY event_type
UNION ALL
SELECT event_type, 'k' AS measure, count(*) AS nb,
       round(sum(CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS DOUBLE)), 6) AS total
FROM events GROUP BY event_type"""

ORACLE["stream_windowed_counts"] = """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS nb, round(sum(value), 6) AS total
FROM events GROUP BY ALL"""

# ---- further rows ---------------------------------------------------------------------

ORACLE["als_pair_scores"] = """
SELECT l_suppkey AS user_id, count(DISTINCT l_partkey) AS nb_paires, count(DISTINCT l_partkey) AS nb_scores,
       CAST(0 AS BIGINT) AS nb_negatifs
FROM lineitem GROUP BY 1"""

ORACLE["src_csv_multifile"] = w(DIRTY) + f"""
SELECT an, dep, count(*) AS nb, CAST(sum(num_acc) AS BIGINT) AS somme_cles, count(hrmn) AS nb_heures
FROM (SELECT {TYPED_DIRTY} FROM dirty) GROUP BY an, dep"""

ORACLE["src_grown_months"] = w(ACCIDENTS) + """
SELECT an, count(*) AS nb, count(CASE WHEN an >= 1998 THEN hrmn END) AS nb_heures,
       count(CASE WHEN an >= 2000 THEN meteo END) AS nb_meteo
FROM accidents GROUP BY an"""

ORACLE["missing_sources_rows"] = """
SELECT s.source, s.absent, CASE WHEN s.source = 'orders' THEN (SELECT count(*) FROM orders) END AS nb
FROM (VALUES ('orders', false), ('lineitem', false), ('empty', true), ('absent', true)) s(source, absent)"""

ORACLE["write_status_rows"] = w(ACCIDENTS, SEVERITY) + """
SELECT 'accidents' AS table_name, 'ok' AS status, count(*) AS nb_lignes FROM accidents
UNION ALL SELECT 'severity', 'ok', count(*) FROM severity
UNION ALL SELECT 'places', 'failed', NULL"""

ORACLE["cache_arms_equal"] = w(ACCIDENTS) + """
SELECT arm, (SELECT count(*) FROM (SELECT meteo FROM accidents GROUP BY meteo)) AS nb_lignes, CAST(0 AS BIGINT) AS nb_differences
FROM (VALUES ('cache'), ('no_cache')) a(arm)"""

ORACLE["aqe_arms_equal"] = w(ACCIDENTS, SEVERITY) + """
SELECT arm, (SELECT least(20, count(DISTINCT a.dep)) FROM accidents a JOIN severity s ON a.num_acc = s.num_acc) AS nb_lignes,
       CAST(0 AS BIGINT) AS nb_differences
FROM (VALUES ('aqe=true,partitions=8'), ('aqe=false,partitions=8'), ('aqe=false,partitions=37')) t(arm)"""

ORACLE["gold_departements"] = _DEPTS
ORACLE["pipeline_files_gold"] = ORACLE["rank_departments_serious_rate"]

OLDER = """older_raw AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS num_acc, strftime(e.ts, '%H:%M') AS heure,
         substr(o.o_orderpriority, 1, 1) AS meteo, o.o_orderstatus AS etat_route,
         TRY_CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) % 4 AS gravite, year(o.o_orderdate) + 20 AS an
  FROM (SELECT DISTINCT * FROM orders) o LEFT JOIN events e ON o.o_orderkey = e.event_id),
older AS (SELECT num_acc, meteo, etat_route, gravite, CAST(substr(heure, 1, 2) AS INTEGER) AS heure_int
  FROM older_raw WHERE an BETWEEN 2005 AND 2030),
older_dep AS (SELECT DISTINCT CAST(l.l_orderkey AS VARCHAR) AS num_acc, lpad(CAST(s.s_nationkey AS VARCHAR), 2, '0') AS dep
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""

ORACLE["older_weather_surface"] = w(OLDER) + """
SELECT meteo, etat_route, count(DISTINCT num_acc) AS nb_accidents, count(*) FILTER (WHERE gravite >= 2) AS nb_graves
FROM older GROUP BY meteo, etat_route"""

ORACLE["older_department_hour"] = w(OLDER) + """
SELECT p.dep, a.heure_int, count(DISTINCT a.num_acc) AS nb_accidents
FROM older a JOIN older_dep p ON a.num_acc = p.num_acc GROUP BY p.dep, a.heure_int"""

ORACLE["older_top_departments"] = w(OLDER) + """,
stats AS (SELECT p.dep, count(DISTINCT a.num_acc) AS total_accidents, count(*) FILTER (WHERE a.gravite >= 2) AS accidents_graves
  FROM older a JOIN older_dep p ON a.num_acc = p.num_acc GROUP BY p.dep)
SELECT *, accidents_graves / NULLIF(total_accidents, 0) AS taux_graves,
       CAST(row_number() OVER (ORDER BY accidents_graves / NULLIF(total_accidents, 0) DESC NULLS LAST, dep) AS INTEGER) AS rang_dep
FROM stats QUALIFY rang_dep <= 20"""

ORACLE["agg_tax_by_nation"] = """
SELECT s.s_nationkey, count(*) AS nb, round(avg(l.l_extendedprice * l.l_tax), 6) AS supplement_moyen
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1"""

ORACLE["agg_duration_by_weekday"] = """
SELECT CAST(dayofweek(o.o_orderdate) + 1 AS INTEGER) AS jour_semaine, count(*) AS nb,
       round(avg(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))), 6) AS duree_moyenne
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1"""

ORACLE["agg_ratings_per_user"] = """
SELECT l_suppkey AS user_id, count(*) AS nb_notes, round(avg(l_quantity), 6) AS note_moyenne,
       min(l_quantity) AS note_min, max(l_quantity) AS note_max FROM lineitem GROUP BY 1"""

ORACLE["agg_popularity_by_category"] = """
SELECT p.p_type, count(*) AS nb_notes, count(DISTINCT l.l_partkey) AS nb_articles, round(avg(l.l_quantity), 6) AS note_moyenne
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1"""

ORACLE["agg_price_over_time"] = """
SELECT s.s_nationkey, CAST(year(l.l_shipdate) AS INTEGER) AS an, CAST(month(l.l_shipdate) AS INTEGER) AS mois,
       count(l.l_extendedprice / NULLIF(l.l_quantity, 0)) AS nb,
       round(avg(l.l_extendedprice / NULLIF(l.l_quantity, 0)), 6) AS prix_unitaire_moyen
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2, 3"""

ORACLE["clean_outlier_reasons"] = """
SELECT CASE WHEN c.c_acctbal < 0 THEN 'negative_c_acctbal'
            WHEN TRY_CAST(lpad(CAST(year(o.o_orderdate) AS VARCHAR), 4, '0') || '-' || lpad(CAST(month(o.o_orderdate) AS VARCHAR), 2, '0') || '-' ||
                 lpad(CAST(day(o.o_orderdate) + o.o_orderkey % 10 AS VARCHAR), 2, '0') AS DATE) IS NULL
            THEN 'impossible_date_an_mois_jour' END AS reject_reason, count(*) AS nb
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1"""

# ---- hot keys, exact quantiles, state -----------------------------------------------------

ORACLE["agg_unit_price_quantiles"] = """
SELECT s.s_nationkey, count(up) AS nb, quantile_disc(up, 0.1) AS decile_1, quantile_disc(up, 0.5) AS mediane, quantile_disc(up, 0.9) AS decile_9
FROM (SELECT l_suppkey, l_extendedprice / NULLIF(l_quantity, 0) AS up FROM lineitem) l JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE up IS NOT NULL GROUP BY 1"""

ORACLE["join_hot_key"] = """
SELECT e.event_type, count(*) AS nb, count(CASE WHEN e.value > m.moyenne THEN 1 END) AS nb_au_dessus
FROM events e JOIN (SELECT event_type, avg(value) AS moyenne FROM events GROUP BY 1) m ON e.event_type = m.event_type GROUP BY 1"""

ORACLE["heavy_hitter_keys"] = """
WITH c AS (SELECT p.p_type, count(*) AS nb FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_type IS NOT NULL GROUP BY 1)
SELECT p_type, nb FROM c WHERE nb > 0.01 * (SELECT sum(nb) FROM c)"""

ORACLE["stream_stateful_counts"] = """
SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
       event_type, count(*) AS nb, round(sum(value), 6) AS total
FROM events GROUP BY ALL"""

ORACLE["stream_late_rows"] = """
WITH e AS (SELECT *, date_trunc('day', ts)::TIMESTAMP AS window_start, coalesce(event_id, 0) % 4 AS batch FROM events),
m AS (SELECT b.batch, max(e.ts) - INTERVAL 2 DAY AS mark FROM (SELECT DISTINCT batch FROM e) b JOIN e ON e.batch < b.batch - 1 GROUP BY b.batch)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type,
       count(CASE WHEN m.mark IS NULL OR window_start + INTERVAL 1 DAY > m.mark THEN 1 END) AS nb_comptes,
       count(CASE WHEN window_start + INTERVAL 1 DAY <= m.mark THEN 1 END) AS nb_retard
FROM e LEFT JOIN m ON e.batch = m.batch GROUP BY ALL"""

ORACLE["write_observed_counts"] = w(DIRTY) + f""",
r AS (SELECT CASE WHEN num_acc IS NULL THEN 'key_missing' WHEN NOT (length(trim(num_acc)) > 0) THEN 'key_blank'
                  WHEN NOT coalesce({YEAR_OK}, false) THEN 'out_of_range_an' END AS reason FROM dirty)
SELECT m.mesure, count(CASE WHEN m.mesure = 'raw' OR m.mesure IN ('kept', 'written') AND r.reason IS NULL OR m.mesure = r.reason THEN 1 END) AS nb
FROM r CROSS JOIN (VALUES ('raw'), ('kept'), ('written'), ('key_missing'), ('key_blank'), ('out_of_range_an')) m(mesure) GROUP BY 1"""

ORACLE["gold_incremental"] = w(ACCIDENTS, SEVERITY) + """,
r AS (SELECT CASE WHEN a.num_acc % 7 = 0 AND (a.an >= 1996 OR a.num_acc % 5 = 0) THEN '07' ELSE a.dep END AS dep,
             CASE WHEN a.num_acc % 5 = 0 THEN 1 ELSE s.gravite_max END AS score,
             CASE WHEN a.num_acc % 5 = 0 THEN 0 ELSE coalesce(s.accident_grave, 0) END AS grave
      FROM accidents a JOIN severity s ON a.num_acc = s.num_acc)
SELECT dep, count(*) AS nb_accidents, CAST(sum(grave) AS BIGINT) AS nb_graves, max(score) AS score_max, round(avg(score), 6) AS score_moyen
FROM r GROUP BY dep"""

ORACLE["replace_partitions_switch"] = w(ACCIDENTS) + """
SELECT dep, count(*) AS nb, min(an) AS premier_an FROM accidents a
WHERE NOT (dep < '05' AND coalesce(an, 0) < 1995 AND dep IN (SELECT dep FROM accidents WHERE an >= 1995)) GROUP BY dep"""

ORACLE["pushdown_clustered"] = w(ACCIDENTS) + """
SELECT 'rang' AS filtre, dep, count(*) AS nb, CAST(sum(num_acc) AS BIGINT) AS somme_cles FROM accidents WHERE dep = '07' AND an = 1996 GROUP BY dep
UNION ALL SELECT 'cle', dep, count(*), CAST(sum(num_acc) AS BIGINT) FROM accidents WHERE num_acc IN (1, 7, 33) GROUP BY dep"""

ORACLE["stream_static_join"] = """
SELECT e.event_type, count(*) AS nb, count(CASE WHEN e.value > m.moyenne THEN 1 END) AS nb_au_dessus
FROM events e LEFT JOIN (SELECT user_id, avg(value) AS moyenne FROM events GROUP BY 1) m ON e.user_id = m.user_id GROUP BY 1"""
