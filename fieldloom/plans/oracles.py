"""Independent SQL for every catalog query, run by DuckDB on the same tables.

Membership is tested analytically here (a diamond is |dx| + |dy| <= r, a region a
square), centroids are the centres the shapes were made from: nothing of the
polygon code is repeated.
"""

from __future__ import annotations

import re

from fieldloom.sources.star import BASE_TABLES, VIEWS, dependencies

def _orphans(keys: str) -> str:
    """The rows of the earlier methods with one of these keys; the keys are compared as lists, where NULL equals NULL."""
    key = "[taxon_id, CAST(unit_id AS VARCHAR), CAST(source_id AS VARCHAR), CAST(search_type_id AS VARCHAR)]"
    return f"""
        SELECT * EXCLUDE (unit_type_id, response_variable_type_id), response_variable_type_id AS response_variable_type_id_previous, true AS is_orphan,
               (SELECT max(max_status_id) FROM {{taxon}} WHERE id = taxon_id) AS max_status_id,
               taxon_id IS NULL OR taxon_id NOT IN (SELECT id FROM {{taxon}}) AS taxon_defunct
        FROM {{processing_method}} WHERE {key} IN (SELECT {key} FROM ({keys}))"""


# named intermediate results; {name} refers to another one, a view or a base table
STEPS: dict[str, str] = {
    "o_site_centre": """
        SELECT s_suppkey AS site_id, CAST(1 + s_suppkey % 2 AS INT) AS site_type,
               CASE WHEN s_suppkey % 4 = 0 THEN 'buffered' ELSE 'original' END AS site_permutation,
               CAST(s_suppkey * 3 % 20 AS DOUBLE) AS x, CAST(s_suppkey * 11 % 19 AS DOUBLE) AS y
        FROM {supplier}""",
    "o_focal_range": """
        SELECT DISTINCT t.sp_id, t.taxon_id, k.range_id, l.range_taxon_id,
               l.range_taxon_id * 7 % 20 + (k.range_id - 1) * 8 AS cx, l.range_taxon_id * 3 % 19 AS cy, 8 - 2 * k.range_id AS r
        FROM {taxonomy} t JOIN {taxon_range_link} l ON t.taxon_id = l.taxon_id
        CROSS JOIN (VALUES (1), (2)) AS k(range_id)
        WHERE t.focal IS NOT NULL""",
    # diamonds are squares in the coordinates x + y and x - y
    "o_range_square": """
        SELECT sp_id, taxon_id, range_id, cx + cy - r AS u0, cx + cy + r AS u1, cx - cy - r AS v0, cx - cy + r AS v1 FROM {o_focal_range}""",
    "o_sites_in_ranges": """
        SELECT DISTINCT s.site_id, s.site_type, f.sp_id, f.taxon_id, f.range_id
        FROM {o_site_centre} s JOIN {o_focal_range} f ON abs(s.x - f.cx) + abs(s.y - f.cy) <= f.r""",
    "o_valid": """
        SELECT * FROM {survey}
        WHERE start_date BETWEEN DATE '1995-02-01' AND DATE '2001-06-30' AND source_id NOT IN (3, 7, 11)
          AND survey_type_id IN (1, 2)""",
    "o_survey_site": """
        SELECT v.id AS survey_id, v.start_date, CAST(year(v.start_date) AS INT) AS year,
               CAST(month(v.start_date) AS INT) AS month, s.site_id, s.site_type
        FROM {o_valid} v JOIN {survey_point} p ON v.survey_point_id = p.id
        JOIN {o_site_centre} s ON s.site_type = v.survey_type_id AND abs(p.x - s.x) + abs(p.y - s.y) <= 2""",
    "o_surveys_by_month": """
        SELECT v.year, v.month, r.site_id, r.taxon_id, r.range_id, count(v.survey_id) AS num_surveys
        FROM {o_survey_site} v JOIN {o_sites_in_ranges} r ON v.site_id = r.site_id AND v.site_type = r.site_type
        GROUP BY ALL""",
    "o_sightings_in_sites": """
        SELECT g.line, g.survey_id, g.species_id AS sp_id, g.individual_count, v.site_id
        FROM {o_survey_site} v JOIN {sighting} g ON v.survey_id = g.survey_id
        WHERE g.species_id IN (SELECT sp_id FROM {taxonomy} WHERE focal IS NOT NULL)
          AND EXISTS (SELECT 1 FROM {o_sites_in_ranges} r
                      WHERE r.site_id = v.site_id AND r.site_type = v.site_type AND r.sp_id = g.species_id)""",
    "o_taxon_sightings": """
        SELECT g.sp_id, g.line, g.survey_id, g.individual_count, g.site_id, f.taxon_id, f.range_id
        FROM {o_sightings_in_sites} g
        JOIN (SELECT DISTINCT sp_id, taxon_id, range_id FROM {o_focal_range}) f ON g.sp_id = f.sp_id""",
    "o_sightings_by_month": """
        SELECT CAST(year(v.start_date) AS INT) AS year, CAST(month(v.start_date) AS INT) AS month, g.site_id, g.taxon_id,
               g.range_id, count(*) AS num_sightings,
               count(*) FILTER (WHERE g.individual_count IS NULL) AS num_po_sightings,
               avg(g.individual_count) AS mean_of_count, CAST(sum(g.individual_count) AS BIGINT) AS sum_of_count
        FROM {o_taxon_sightings} g JOIN {survey} v ON g.survey_id = v.id
        GROUP BY ALL""",
    "o_data_by_month": """
        SELECT s.site_id, c.site_type AS survey_type_id, c.site_permutation, s.year, s.month, s.taxon_id, s.range_id,
               s.num_surveys, COALESCE(g.num_sightings, 0) AS num_sightings,
               COALESCE(g.num_sightings, 0) / s.num_surveys AS rr, COALESCE(g.mean_of_count, 0) AS mean_of_count,
               COALESCE(g.sum_of_count / NULLIF(s.num_surveys - g.num_po_sightings, 0), 0) AS mean_abundance,
               s.num_surveys - COALESCE(g.num_po_sightings, 0) AS abundance_surveys
        FROM {o_surveys_by_month} s
        LEFT JOIN {o_sightings_by_month} g USING (year, month, site_id, taxon_id, range_id)
        JOIN {o_site_centre} c ON s.site_id = c.site_id""",
    "o_data_by_year": """
        SELECT site_id, survey_type_id, site_permutation, year, taxon_id, range_id,
               CAST(sum(num_surveys) AS BIGINT) AS num_surveys, CAST(sum(num_sightings) AS BIGINT) AS num_sightings,
               avg(rr) AS mean_monthly_rr, avg(mean_of_count) AS monthly_mean_of_mean_of_count,
               avg(mean_abundance) AS monthly_mean_abundance, CAST(sum(abundance_surveys) AS BIGINT) AS abundance_surveys
        FROM {o_data_by_month} GROUP BY ALL""",
    "o_assigned": """
        SELECT y.*, CASE WHEN EXISTS (SELECT 1 FROM {processing_method} m WHERE m.taxon_id = y.taxon_id
                 AND m.search_type_id = y.survey_type_id AND m.response_variable_type_id = 3 AND m.unit_type_id = 3)
               THEN CAST(3 AS SMALLINT) END AS response_variable_type_id
        FROM {o_data_by_year} y""",
    "o_flagged": """
        SELECT y.*, CASE WHEN sum(mean_monthly_rr) OVER (PARTITION BY taxon_id, site_id, survey_type_id) = 0
               THEN CAST(1 AS SMALLINT) END AS all0_values
        FROM {o_assigned} y""",
    # --- editions ---
    "o_prior": """
        SELECT CAST(p.start_date_y AS SMALLINT) AS start_date_y, p.site_id, p.search_type_id, p.taxon_id,
               p.response_variable_type_id, round(p.value, 4) AS value, p.source_id, p.unit_id, p.lat, p.lon, p.survey_count,
               (SELECT min(s.site_id) FROM {o_site_centre} s
                WHERE s.site_type = p.search_type_id AND abs(s.x - p.lon) + abs(s.y - p.lat) <= 2) AS site_id_current
        FROM {edition_prev} p WHERE p.source_id = 23""",
    "o_prior_flagged": """
        SELECT p.*, CASE WHEN sum(value) OVER (PARTITION BY taxon_id, site_id, search_type_id) = 0
               THEN CAST(1 AS SMALLINT) END AS all0_values
        FROM {o_prior} p""",
    # both editions in one shape: a row per series and year
    "o_rates": """
        SELECT 'current' AS edition, taxon_id, site_id, survey_type_id AS type_id, year AS y, num_surveys AS surveys,
               num_sightings AS sightings, mean_monthly_rr AS rate, range_id, site_permutation AS form,
               response_variable_type_id AS variable
        FROM {edition_cur}
        UNION ALL BY NAME
        SELECT 'prior' AS edition, taxon_id, site_id_current AS site_id, site_id AS own_site_id, search_type_id AS type_id,
               CAST(start_date_y AS INT) AS y, survey_count AS surveys, value AS rate, response_variable_type_id AS variable
        FROM {o_prior}""",
    "o_type_totals": """
        SELECT edition, taxon_id, type_id, len(list_distinct(list(COALESCE(own_site_id, site_id)))) AS sites,
               CAST(sum(surveys) AS BIGINT) AS surveys, CAST(sum(sightings) AS BIGINT) AS sightings,
               CAST(round(CAST(CAST(sum(CAST(rate AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(rate), 0) AS DECIMAL(38,14)), 4) AS DOUBLE) AS rate
        FROM (SELECT * FROM {o_rates} WHERE edition = 'prior' AND variable = 3
              UNION ALL
              SELECT * FROM {o_rates} WHERE edition = 'current' AND variable IS NOT NULL AND y < 2001 AND range_id = 1
                                       AND form = 'original')
        GROUP BY ALL""",
    "o_prior_summary": """
        SELECT e.taxon_id, (SELECT n.taxon_name FROM {taxonomy} n WHERE n.taxon_id = e.taxon_id) AS taxon_name,
               COALESCE(small.sites, 0) AS num_2ha_sites_prior, small.surveys AS num_surveys_2ha_sites_prior,
               small.rate AS mean_monthly_rr_2ha_sites_prior, COALESCE(wide.sites, 0) AS num_500m_sites_prior,
               wide.surveys AS num_surveys_500m_sites_prior, wide.rate AS mean_monthly_rr_500m_sites_prior
        FROM (SELECT DISTINCT taxon_id FROM {o_type_totals} WHERE edition = 'prior') e
        LEFT JOIN (FROM {o_type_totals} WHERE edition = 'prior' AND type_id = 1) small USING (taxon_id)
        LEFT JOIN (FROM {o_type_totals} WHERE edition = 'prior' AND type_id = 2) wide USING (taxon_id)""",
    "o_current_summary": """
        SELECT e.taxon_id, (SELECT n.taxon_name FROM {taxonomy} n WHERE n.taxon_id = e.taxon_id) AS taxon_name,
               COALESCE(small.sites, 0) AS num_2ha_sites_current, small.surveys AS num_surveys_2ha_sites_current,
               small.sightings AS num_sightings_2ha_sites_current, small.rate AS mean_monthly_rr_2ha_sites_current,
               COALESCE(wide.sites, 0) AS num_500m_sites_current, wide.surveys AS num_surveys_500m_sites_current,
               wide.sightings AS num_sightings_500m_sites_current, wide.rate AS mean_monthly_rr_500m_sites_current
        FROM (SELECT DISTINCT taxon_id FROM {o_type_totals} WHERE edition = 'current') e
        LEFT JOIN (FROM {o_type_totals} WHERE edition = 'current' AND type_id = 1) small USING (taxon_id)
        LEFT JOIN (FROM {o_type_totals} WHERE edition = 'current' AND type_id = 2) wide USING (taxon_id)""",
    "o_joined_editions": """
        SELECT c.*, p.start_date_y, p.value AS old_value, p.unit_id, p.response_variable_type_id AS old_variable,
               p.source_id, p.survey_count
        FROM {edition_cur} c JOIN {o_prior} p
          ON p.site_id_current = c.site_id AND p.search_type_id = c.survey_type_id AND p.start_date_y = c.year
         AND p.taxon_id = c.taxon_id""",
    "o_differs": """
        SELECT c.*, CASE WHEN sum(c.mean_monthly_rr) OVER (PARTITION BY c.taxon_id, c.site_id, c.survey_type_id) = 0
                    THEN CAST(1 AS SMALLINT) END AS all0_values,
               CASE WHEN EXISTS (SELECT 1 FROM {o_compared} j WHERE j.same AND j.site_id = c.site_id
                      AND j.survey_type_id = c.survey_type_id AND j.year = c.year AND j.taxon_id = c.taxon_id) THEN false
                    WHEN EXISTS (SELECT 1 FROM {o_compared} j WHERE NOT j.same AND j.site_id = c.site_id
                      AND j.survey_type_id = c.survey_type_id AND j.year = c.year AND j.taxon_id = c.taxon_id) THEN true
               END AS value_differs
        FROM {edition_cur} c""",
    "o_compared": """
        SELECT site_id, survey_type_id, year, taxon_id, round(mean_monthly_rr, 4) = round(old_value, 4) AS same
        FROM {o_joined_editions}
        WHERE old_variable = 3 AND start_date_y > 1995 AND range_id = 1
          AND year < (SELECT max(start_date_y) FROM {o_prior})""",
    # length, gaps and level of every series of original sites, whatever its edition
    "o_series": """
        SELECT *, ts_end_year - ts_start_year + 1 AS ts_length,
               CAST(ts_sample_years // (ts_end_year - ts_start_year + 1) * 100 AS BIGINT) AS ts_completeness,
               100.0::DOUBLE * ts_sample_years / (ts_end_year - ts_start_year + 1) AS ts_completeness_exact
        FROM (SELECT edition, taxon_id, site_id, type_id, CAST(sum(surveys) AS BIGINT) AS ts_surveys,
                     CAST(sum(sightings) AS BIGINT) AS num_sightings, CAST(sum(CASE WHEN rate = 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_0s,
                     CAST(sum(CAST(rate AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(rate), 0) AS mean_rr,
                     list_min(list(y)) AS ts_start_year, list_max(list(y)) AS ts_end_year, len(list(y)) AS ts_sample_years
              FROM {o_rates}
              WHERE variable = 3 AND y < 2001 AND COALESCE(range_id, 1) = 1
                AND site_id IN (SELECT site_id FROM {site} WHERE site_permutation = 'original')
              GROUP BY ALL)""",
    "o_current_series": """
        SELECT * EXCLUDE (edition, type_id, id), 'original' AS site_permutation
        FROM {o_series} JOIN {survey_type} ON id = type_id WHERE edition = 'current'""",
    "o_prior_series": """
        SELECT * EXCLUDE (edition, type_id, id, num_sightings), 'original' AS site_permutation
        FROM {o_series} JOIN {survey_type} ON id = type_id WHERE edition = 'prior'""",
    "o_non_matching": """
        SELECT a.taxon_id, t.taxon_name, a.total_ts, COALESCE(b.n, 0) AS num_unequal_ts,
               round(COALESCE(b.n, 0) * 100.0::DOUBLE / a.total_ts, 2) AS percentage_unequal_ts
        FROM (SELECT taxon_id, count(DISTINCT site_id) AS total_ts FROM {o_current_series} GROUP BY taxon_id) a
        LEFT JOIN (SELECT c.taxon_id, count(*) AS n FROM {o_current_series} c JOIN {o_prior_series} p
                     ON c.site_id = p.site_id AND c.taxon_id = p.taxon_id
                   WHERE round(CAST(c.mean_rr AS DECIMAL(38,14)), 4) <> round(CAST(p.mean_rr AS DECIMAL(38,14)), 4) GROUP BY c.taxon_id) b ON a.taxon_id = b.taxon_id
        JOIN {taxonomy} t ON a.taxon_id = t.taxon_id""",
    "o_pairs": """
        SELECT taxon_id, site_id, site_permutation, survey_type_id AS search_type_id, year, unit_id AS prior_unit,
               old_variable AS prior_response_variable, source_id AS prior_source, survey_count AS prior_num_surveys,
               num_surveys, num_sightings, old_value AS prior_value, mean_monthly_rr AS value
        FROM {o_joined_editions} WHERE start_date_y > 1995""",
    # --- regions ---
    "o_region_box": """
        SELECT region_id, region_name, region_code, (region_id % 5) * 4 AS x0, region_id // 5 * 4 AS y0,
               CAST((region_id % 5) * 4 + 2 AS DOUBLE) AS x, CAST(region_id // 5 * 4 + 2 AS DOUBLE) AS y
        FROM {subregion}""",
    "o_site_region": """
        SELECT s.site_id, b.region_id, b.region_name, b.x, b.y
        FROM {o_site_centre} s JOIN {o_region_box} b
          ON s.x BETWEEN b.x0 AND b.x0 + 4 AND s.y BETWEEN b.y0 AND b.y0 + 4""",
    "o_nearest": """
        SELECT site_id, region_code, distance FROM (
          SELECT s.site_id, b.region_code, b.region_id,
                 sqrt(power(greatest(b.x0 - s.x, s.x - b.x0 - 4, 0), 2) + power(greatest(b.y0 - s.y, s.y - b.y0 - 4, 0), 2)) AS distance
          FROM {o_site_centre} s CROSS JOIN {o_region_box} b
          WHERE s.site_id NOT IN (SELECT site_id FROM {o_site_region}))
        QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY distance, region_id) = 1""",
    # --- export ---
    # series years left when those that break a rule are taken away
    "o_years_left": """
        SELECT time_series_id, start_date_y FROM {agg}
        EXCEPT SELECT time_series_id, start_date_y FROM {agg}
               WHERE region_id IS NULL OR experimental_design_type_id IS DISTINCT FROM 1 OR search_type_id = 6
        EXCEPT SELECT time_series_id, start_date_y FROM {agg}
               WHERE taxon_id NOT IN (SELECT id FROM {taxon} WHERE max_status_id IS NOT NULL AND max_status_id NOT IN (0, 1, 7))
        EXCEPT SELECT time_series_id, start_date_y FROM {agg} y
               WHERE NOT EXISTS (FROM {data_source} d
                                 WHERE (d.taxon_id, d.source_id) = (y.taxon_id, y.source_id) AND d.exclude_from_analysis = false
                                   AND y.start_date_y BETWEEN COALESCE(d.start_year, 1995) AND COALESCE(d.end_year, 2001)
                                   AND d.data_agreement_id IS DISTINCT FROM 0
                                   AND NOT list_contains([0, 1], COALESCE(d.standardisation_of_method_effort_id, -1))
                                   AND NOT list_contains([0, 1], COALESCE(d.consistency_of_monitoring_id, -1)))""",
    "o_qualifying": """
        SELECT time_series_id FROM {agg} SEMI JOIN {o_years_left} USING (time_series_id, start_date_y)
        GROUP BY time_series_id HAVING bool_or(value > 0) AND len(list_distinct(list(start_date_y))) > 2""",
    "o_groups": """
        SELECT taxon_id, string_agg(group_name || COALESCE(':' || subgroup_name, ''), ','
                 ORDER BY group_name || COALESCE(':' || subgroup_name, '')) AS functional_group
        FROM {taxon_group} GROUP BY taxon_id""",
    # --- methods ---
    # a row per sighting and taxon with what its survey says; the profile then reads sets off lists
    "o_direct_rows": """
        SELECT g.taxon_id, g.unit_id, g.unit_type_id, g.n, w.* FROM (SELECT *, count AS n FROM {t1_sighting}) g
        JOIN (SELECT id AS survey, source_id, start_date_y AS y, start_date_m AS m, site_id AS place,
                     (SELECT p.search_type_id FROM {t1_site} p WHERE p.id = site_id) AS search_type_id
              FROM {t1_survey}
              WHERE source_id IN (SELECT id FROM {source}) AND site_id IN (SELECT id FROM {t1_site})) w ON g.survey_id = w.survey""",
    "o_direct": """
        SELECT taxon_id, unit_id, unit_type_id, source_id, search_type_id, len(list_distinct(surveys)) AS survey_id_count,
               len(list_distinct(sites)) AS site_id_count, len(list_distinct(counts)) AS n_count_values,
               list_min(counts) AS min_count, list_max(counts) AS max_count, len(list_distinct(months)) AS n_months,
               len(list_distinct(years)) AS n_years, max_status_id, 1 AS data_type
        FROM (SELECT taxon_id, unit_id, unit_type_id, source_id, search_type_id, list(survey) AS surveys, list(place) AS sites,
                     list(n) AS counts, list(y * 100 + COALESCE(m, 0)) AS months, list(y) AS years
              FROM {o_direct_rows} GROUP BY ALL)
        JOIN (SELECT id AS taxon_id, max_status_id FROM {taxon}) USING (taxon_id)""",
    "o_linked_rows": """
        WITH told AS (SELECT id AS survey, source_id, search_type_id, site_id AS place, start_date_y AS y, start_date_m AS m
                      FROM {t2_survey} WHERE source_id IN (SELECT id FROM {source})),
             seen AS (SELECT id AS sighting_id, survey_id AS survey, unit_id, unit_type_id, count AS n FROM {t2_sighting})
        SELECT * FROM seen JOIN told USING (survey) JOIN (SELECT sighting_id, taxon_id FROM {t2_taxon_sighting}) USING (sighting_id)""",
    "o_linked": """
        SELECT taxon_id, unit_id, unit_type_id, source_id, search_type_id, len(list_distinct(surveys)) AS survey_id_count,
               len(list_distinct(sites)) AS site_id_count, len(list_distinct(counts)) AS n_count_values,
               list_min(counts) AS min_count, list_max(counts) AS max_count, len(list_distinct(months)) AS n_months,
               len(list_distinct(years)) AS n_years, max_status_id, 2 AS data_type
        FROM (SELECT taxon_id, unit_id, unit_type_id, source_id, search_type_id, list(survey) AS surveys, list(place) AS sites,
                     list(n) AS counts, list(y * 100 + COALESCE(m, 0)) AS months, list(y) AS years
              FROM {o_linked_rows} GROUP BY ALL)
        JOIN (SELECT id AS taxon_id, max_status_id FROM {taxon}) USING (taxon_id)""",
    "o_appended": """
        SELECT taxon_id, unit_id, unit_type_id, source_id, search_type_id, survey_id_count, site_id_count, data_type,
               1 AS experimental_design_type_id, 0 AS response_variable_type_id, 0 AS response_variable_type_id_previous,
               false AS matches_previous, false AS is_orphan, n_count_values, min_count, n_months, n_years, max_count,
               CAST(NULL AS DOUBLE) AS positional_accuracy_threshold_in_m, max_status_id, false AS taxon_defunct
        FROM (SELECT * FROM {o_direct} UNION ALL BY NAME SELECT * FROM {o_linked})""",
    "o_classified": """
        SELECT * REPLACE (CASE WHEN source_id IN (4, 8, 15) THEN 2 WHEN unit_type_id = 3 THEN 3 ELSE 1 END
                          AS response_variable_type_id)
        FROM {o_appended}""",
    # keys of the earlier table that the current one lacks; a key with an unknown part equals none
    "o_orphan_keys": """
        SELECT taxon_id, unit_id, source_id, search_type_id FROM {processing_method}
        EXCEPT SELECT taxon_id, unit_id, source_id, search_type_id FROM {o_classified}""",
    "o_orphans": _orphans("""
          FROM {o_orphan_keys}
          UNION SELECT taxon_id, unit_id, source_id, search_type_id FROM {processing_method}
          WHERE source_id + unit_id + search_type_id IS NULL OR taxon_id IS NULL"""),
    "o_all_methods": """
        SELECT * FROM {o_classified}
        UNION ALL BY NAME
        SELECT *, 0 AS response_variable_type_id, false AS matches_previous FROM {o_orphans}""",
    "o_method_table": """
        SELECT m.* REPLACE (
                 COALESCE(o.old, m.response_variable_type_id_previous) AS response_variable_type_id_previous,
                 CASE WHEN o.old IS NULL THEN m.matches_previous ELSE m.response_variable_type_id = o.old END AS matches_previous)
        FROM {o_all_methods} m LEFT JOIN (
          SELECT taxon_id, unit_id, source_id, search_type_id, min(response_variable_type_id) AS old
          FROM {processing_method} GROUP BY ALL) o
          ON m.taxon_id = o.taxon_id AND m.unit_id = o.unit_id AND m.source_id = o.source_id
         AND m.search_type_id = o.search_type_id""",
}


def _per_year(value: str) -> str:
    exact = f"CAST(sum(CAST({value} AS DECIMAL(28,12))) FILTER (WHERE year = {{y}}) AS DOUBLE)"
    return ", ".join(
        f'{exact.format(y=y)} / NULLIF(count({value}) FILTER (WHERE year = {y}), 0) AS "{y}"' for y in range(1995, 2002)
    )


def _wide(series: str, value: str) -> str:
    years = _per_year(value)
    return f"""
        SELECT t.taxon_scientific_name, t.sp_id, d.taxon_id, t.taxon_name, d.site_id, k.name AS search_type_desc,
               s.site_permutation, r.region_name, r.x AS region_centroid_longitude, r.y AS region_centroid_latitude, {years}
        FROM {{{series}}} d JOIN {{site}} s ON d.site_id = s.site_id JOIN {{survey_type}} k ON s.site_type = k.id
        LEFT JOIN {{taxonomy}} t ON d.taxon_id = t.taxon_id LEFT JOIN {{o_site_region}} r ON s.site_id = r.site_id
        WHERE d.response_variable_type_id IS NOT NULL AND d.range_id = 1
        GROUP BY t.taxon_scientific_name, t.sp_id, d.taxon_id, t.taxon_name, d.site_id, k.name, s.site_permutation,
                 r.region_name, r.x, r.y"""


STEPS["o_wide_rr"] = _wide("o_flagged", "mean_monthly_rr")
STEPS["o_wide_abundance"] = _wide("o_flagged", "monthly_mean_abundance")
STEPS["o_wide_cur_rr"] = _wide("edition_cur", "mean_monthly_rr")
STEPS["o_wide_cur_abundance"] = _wide("edition_cur", "monthly_mean_abundance")


def _filled(wide: str) -> str:
    return f"""
        SELECT w.* REPLACE (COALESCE(w.region_name, b.region_name) AS region_name,
                 CASE WHEN w.region_name IS NULL THEN b.x ELSE w.region_centroid_longitude END AS region_centroid_longitude,
                 CASE WHEN w.region_name IS NULL THEN b.y ELSE w.region_centroid_latitude END AS region_centroid_latitude)
        FROM {{{wide}}} w LEFT JOIN {{o_nearest}} n ON w.site_id = n.site_id
        LEFT JOIN {{o_region_box}} b ON n.region_code = b.region_code"""


def _violations(table: str, keys: str) -> str:
    some_null = " OR ".join(f"{k.strip()} IS NULL" for k in keys.split(","))
    return f"SELECT {keys}, count(*) AS n FROM {{{table}}} GROUP BY ALL HAVING count(*) > 1 OR {some_null}"


def _included(bounds: str) -> str:
    """Years allowed, one row each; a series' year stands if it is among them, or its source says nothing."""
    return f"""
        WITH bounds AS ({bounds}),
        widest AS (SELECT taxon_id, source_id, list(COALESCE(start_year, -1)) AS starts, list(COALESCE(end_year, -1)) AS ends FROM bounds GROUP BY ALL),
        allowed AS (SELECT taxon_id, source_id, unnest(generate_series(
                      CASE WHEN list_contains(starts, -1) THEN 1995 ELSE list_min(starts) END,
                      CASE WHEN list_contains(ends, -1) THEN 2001 ELSE list_max(ends) END)) AS start_date_y FROM widest),
        kept AS (FROM {{agg}} SEMI JOIN {{o_qualifying}} USING (time_series_id)),
        inside AS (SELECT time_series_id, start_date_y FROM kept SEMI JOIN allowed USING (taxon_id, source_id, start_date_y)
                   UNION SELECT time_series_id, start_date_y FROM kept ANTI JOIN widest USING (taxon_id, source_id)
                   WHERE start_date_y BETWEEN 1995 AND 2001)
        SELECT time_series_id, start_date_y, (time_series_id, start_date_y) IN (FROM inside) AS include_in_analysis FROM {{agg}}"""


ORACLES: dict[str, str] = {
    "focal_taxa": """
        SELECT t.taxon_id, t.sp_id, t.taxon_name, t.taxon_scientific_name, CAST(f.focal AS SMALLINT) AS focal
        FROM {taxonomy} t LEFT JOIN {focal_list} f ON t.taxon_id = f.taxon_id""",
    "focal_taxa_listed_twice": """
        SELECT taxon_id, sp_id, taxon_name, taxon_scientific_name, CAST(CASE WHEN taxon_id IN (SELECT taxon_id FROM {focal_list})
                 THEN greatest((SELECT max(f.focal) FROM {focal_list} f WHERE f.taxon_id = t.taxon_id), sp_id % 3) END AS SMALLINT) AS focal
        FROM {taxonomy} t""",
    "taxon_ranges": """
        SELECT DISTINCT t.sp_id, l.taxon_id, v.range_id, CAST(v.range_taxon_id AS VARCHAR) || '/' || CAST(v.part AS VARCHAR) AS part,
               v.ring, v.seq, v.x, v.y
        FROM {range_vertex} v JOIN {taxon_range_link} l ON v.range_taxon_id = l.range_taxon_id
        JOIN {taxonomy} t ON l.taxon_id = t.taxon_id WHERE t.focal IS NOT NULL""",
    # where lines of the squares meet: a corner of the union has one or three covered quarters around it, or two across
    "merged_range_corners": """
        WITH us AS (SELECT DISTINCT sp_id, taxon_id, range_id, unnest([u0, u1]) AS u FROM {o_range_square}),
        vs AS (SELECT DISTINCT sp_id, taxon_id, range_id, unnest([v0, v1]) AS v FROM {o_range_square}),
        quarters AS (
          SELECT sp_id, taxon_id, range_id, u, v, du * dv AS turn,
                 EXISTS (FROM {o_range_square} s WHERE s.taxon_id = us.taxon_id AND s.range_id = us.range_id
                         AND s.u0 < u + du AND u + du < s.u1 AND s.v0 < v + dv AND v + dv < s.v1) AS covered
          FROM us JOIN vs USING (sp_id, taxon_id, range_id), (VALUES (0.5), (-0.5)) a(du), (VALUES (0.5), (-0.5)) b(dv))
        SELECT sp_id, taxon_id, range_id, CAST(u + v AS DOUBLE) / 2 AS x, CAST(u - v AS DOUBLE) / 2 AS y
        FROM quarters GROUP BY ALL
        HAVING count(*) FILTER (WHERE covered) IN (1, 3) OR (count(*) FILTER (WHERE covered) = 2 AND abs(sum(turn) FILTER (WHERE covered)) = 0.5)""",
    # of two squares: both, less what they share
    "merged_range_measures": """
        WITH shared AS (
          SELECT sp_id, taxon_id, range_id, count(*) AS n, sum((u1 - u0) * (v1 - v0)) AS areas, sum(2 * (u1 - u0) + 2 * (v1 - v0)) AS lengths,
                 CASE WHEN count(*) = 2 AND min(u1) >= max(u0) AND min(v1) >= max(v0) THEN min(u1) - max(u0) END AS iu, min(v1) - max(v0) AS iv
          FROM {o_range_square} GROUP BY ALL)
        SELECT sp_id, taxon_id, range_id, CASE WHEN n = 2 AND COALESCE(iu + iv, 0) = 0 THEN 2 ELSE 1 END::BIGINT AS n_parts, n_parts AS n_rings,
               CAST(areas - COALESCE(iu * iv, 0) AS DOUBLE) / 2 AS area, CAST(lengths - COALESCE(2 * (iu + iv), 0) AS DOUBLE) / sqrt(2) AS outline
        FROM shared""",
    # the midpoints that the dense outlines add lie on their edges and have to go again
    "simplified_ranges": """
        SELECT DISTINCT t.sp_id, l.taxon_id, v.range_id, CAST(v.range_taxon_id AS VARCHAR) || '/' || CAST(v.part AS VARCHAR) AS part,
               v.ring, v.seq, v.x, v.y
        FROM {range_vertex} v JOIN {taxon_range_link} l ON v.range_taxon_id = l.range_taxon_id
        JOIN {taxonomy} t ON l.taxon_id = t.taxon_id WHERE t.focal IS NOT NULL""",
    # bends above the tolerance stay; vertices are numbered anew, every second edge has one more
    "simplified_bent_ranges": """
        WITH kept AS (
          SELECT range_taxon_id, range_id, part, ring, seq, x, y FROM {range_vertex}
          UNION ALL
          SELECT range_taxon_id, range_id, part, ring, (seq - 1) / 2 + 0.5 AS seq, x, y FROM {range_vertex_bent} WHERE seq % 4 = 3),
        numbered AS (SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY range_taxon_id, range_id, part, ring ORDER BY seq) AS INT) AS seq) FROM kept)
        SELECT DISTINCT t.sp_id, l.taxon_id, v.range_id, CAST(v.range_taxon_id AS VARCHAR) || '/' || CAST(v.part AS VARCHAR) AS part,
               v.ring, v.seq, v.x, v.y
        FROM numbered v JOIN {taxon_range_link} l ON v.range_taxon_id = l.range_taxon_id
        JOIN {taxonomy} t ON l.taxon_id = t.taxon_id WHERE t.focal IS NOT NULL""",
    "site_centroids": "SELECT * FROM {o_site_centre}",
    "sites_in_ranges": "SELECT * FROM {o_sites_in_ranges}",
    "sites_in_ranges_outlines": """
        SELECT r.*, v.part, v.ring, v.seq, v.x, v.y FROM {o_sites_in_ranges} r JOIN {site_vertex} v ON r.site_id = v.site_id""",
    "key_violations_sites_in_ranges": _violations("o_sites_in_ranges", "site_id, taxon_id"),
    "key_violations_taxon_ranges": """
        SELECT l.taxon_id, v.range_id, CAST(v.range_taxon_id AS VARCHAR) || '/1' AS part, v.ring, v.seq, count(*) AS n
        FROM {range_vertex} v JOIN {taxon_range_link} l ON v.range_taxon_id = l.range_taxon_id
        JOIN {taxonomy} t ON l.taxon_id = t.taxon_id WHERE t.focal IS NOT NULL GROUP BY ALL HAVING count(*) > 1""",
    "key_violations_range_parts": """
        SELECT taxon_id, range_id, len(list(range_taxon_id)) AS n FROM {o_focal_range} GROUP BY ALL HAVING len(list(range_taxon_id)) > 1""",
    "key_violations_data_by_month_taxon": """
        SELECT * FROM (SELECT site_id, taxon_id, year, month, count(*) AS n FROM {o_surveys_by_month} GROUP BY ALL) WHERE n > 1""",
    "key_violations_surveys_by_month": _violations("o_surveys_by_month", "site_id, taxon_id, year, month"),
    "key_violations_data_by_month": _violations("o_data_by_month", "site_id, taxon_id, range_id, year, month"),
    "key_violations_method_profiles": """
        SELECT taxon_id, unit_id, source_id, search_type_id, data_type, count(*) AS n FROM {o_classified}
        WHERE taxon_id IS NOT NULL AND unit_id IS NOT NULL AND source_id IS NOT NULL AND search_type_id IS NOT NULL
          AND data_type IS NOT NULL
        GROUP BY ALL HAVING count(*) > 1""",
    "key_violations_previous_methods": _violations("processing_method", "taxon_id, unit_id, source_id, search_type_id"),
    "valid_surveys": "SELECT * FROM {o_valid}",
    "surveys_by_month": "SELECT * FROM {o_surveys_by_month}",
    "sightings_in_sites": "SELECT * FROM {o_sightings_in_sites}",
    "taxon_sightings": "SELECT * FROM {o_taxon_sightings}",
    "sightings_by_month": "SELECT * FROM {o_sightings_by_month}",
    "data_by_month": "SELECT * FROM {o_data_by_month}",
    "coverage_species": "SELECT sp_id, count(*) AS n FROM {o_sightings_in_sites} GROUP BY sp_id",
    "coverage_taxa": "SELECT taxon_id, count(*) AS n FROM {o_sightings_by_month} GROUP BY taxon_id",
    "distinct_taxa": "SELECT DISTINCT taxon_id FROM {o_data_by_month} ORDER BY taxon_id",
    "data_by_year": "SELECT * FROM {o_data_by_year}",
    "data_by_year_from_months": "SELECT * FROM {o_data_by_year}",
    "response_variable": "SELECT * FROM {o_assigned}",
    "all_zero_series": "SELECT * FROM {o_flagged}",
    "site_count_summary": """
        SELECT taxon_id, (SELECT n.taxon_name FROM {taxonomy} n WHERE n.taxon_id = p.taxon_id) AS taxon_name,
               response_variable_type_id, survey_type_id, (SELECT k.name FROM {survey_type} k WHERE k.id = p.survey_type_id) AS name,
               count(*) AS num_sites
        FROM (SELECT DISTINCT taxon_id, response_variable_type_id, survey_type_id, site_id FROM {o_flagged}
              WHERE response_variable_type_id IS NOT NULL) p
        WHERE taxon_id IN (SELECT taxon_id FROM {taxonomy}) AND survey_type_id IN (SELECT id FROM {survey_type}) GROUP BY ALL""",
    "rate_and_abundance_length": """
        SELECT taxon_id, site_id, survey_type_id,
               max(year) FILTER (WHERE mean_monthly_rr > 0) - min(year) FILTER (WHERE mean_monthly_rr > 0) + 1 AS rr_length,
               max(year) FILTER (WHERE monthly_mean_abundance > 0) - min(year) FILTER (WHERE monthly_mean_abundance > 0) + 1
                 AS abundance_length
        FROM {o_data_by_year} GROUP BY ALL""",
    "prior_edition": "SELECT * EXCLUDE (site_id_current) FROM {o_prior}",
    "prior_points": "SELECT * EXCLUDE (site_id_current), lon AS x, lat AS y, 4283 AS srid FROM {o_prior}",
    "prior_sites_attributed": "SELECT * FROM {o_prior}",
    "prior_all_zero_series": "SELECT * FROM {o_prior_flagged}",
    "prior_edition_summary": "SELECT * FROM {o_prior_summary}",
    "current_edition_summary": "SELECT * FROM {o_current_summary}",
    "distinct_sighting_sums": """
        SELECT taxon_id, CAST(sum(DISTINCT num_sightings) FILTER (WHERE survey_type_id = 1) AS BIGINT) AS num_sightings_2ha_sites,
               CAST(sum(DISTINCT num_sightings) FILTER (WHERE survey_type_id = 2) AS BIGINT) AS num_sightings_500m_sites
        FROM {edition_cur} GROUP BY taxon_id""",
    "edition_summaries_compared": """
        SELECT c.taxon_id, c.taxon_name, num_2ha_sites_prior, num_2ha_sites_current, num_surveys_2ha_sites_prior,
               num_surveys_2ha_sites_current, mean_monthly_rr_2ha_sites_prior, mean_monthly_rr_2ha_sites_current,
               num_500m_sites_prior, num_500m_sites_current, num_surveys_500m_sites_prior,
               num_surveys_500m_sites_current, mean_monthly_rr_500m_sites_prior, mean_monthly_rr_500m_sites_current
        FROM {o_current_summary} c LEFT JOIN {o_prior_summary} p ON c.taxon_id = p.taxon_id""",
    "value_differs": "SELECT * FROM {o_differs}",
    "value_difference_counts": """
        WITH told AS (
          SELECT taxon_id, survey_type_id AS id, histogram(
                   CASE all0_values WHEN 1 THEN 'zero ' ELSE 'some ' END
                   || CASE value_differs WHEN true THEN 'differ' WHEN false THEN 'match' ELSE 'none' END) AS h
          FROM {o_differs} WHERE site_permutation = 'original' AND response_variable_type_id = 3 AND year < 2001
          GROUP BY taxon_id, survey_type_id)
        SELECT taxon_id, (SELECT n.taxon_name FROM {taxonomy} n WHERE n.taxon_id = told.taxon_id) AS taxon_name, name,
               COALESCE(CAST(h['some differ'] AS BIGINT), 0) AS num_qualifying_ts_differ, COALESCE(CAST(h['zero differ'] AS BIGINT), 0) AS num_all0_ts_differ,
               COALESCE(CAST(h['some match'] AS BIGINT), 0) AS num_qualifying_ts_match, COALESCE(CAST(h['zero match'] AS BIGINT), 0) AS num_all0_ts_match,
               COALESCE(CAST(h['some none'] AS BIGINT), 0) AS num_qualifying_ts_match_null, COALESCE(CAST(h['zero none'] AS BIGINT), 0) AS num_all0_ts_match_null
        FROM told JOIN {survey_type} USING (id)""",
    "current_series_summary": "SELECT * FROM {o_current_series}",
    "prior_series_summary": "SELECT * FROM {o_prior_series}",
    "non_matching_series": "SELECT * FROM {o_non_matching}",
    # each edition described for itself, over the series of the current one that have sightings; a series of
    # the prior edition counts once for each series of the current one at its site
    "qualifying_series_statistics": """
        WITH now AS (SELECT * FROM {o_current_series} WHERE num_sightings > 0),
        met AS (SELECT now.taxon_id, now.site_id, now.name AS type, earlier.mean_rr, earlier.ts_start_year, earlier.ts_sample_years, earlier.ts_length,
                       now.mean_rr AS now_rr, now.ts_start_year AS now_start, now.ts_sample_years AS now_years, now.ts_length AS now_length,
                       earlier.site_id IS NOT NULL AS known
                FROM now LEFT JOIN {o_prior_series} earlier ON (earlier.taxon_id, earlier.site_id) = (now.taxon_id, now.site_id)),
        here AS (SELECT taxon_id, count(*) AS num_qualifying_ts_current, CAST(round(CAST(CAST(sum(CAST(now_rr AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(now_rr), 0) AS DECIMAL(38,14)), 4) AS DOUBLE) AS mean_rr_current,
                        round(avg(now_start), 0) AS mean_ts_start_year_current, round(avg(now_years), 2) AS mean_ts_sample_years_current,
                        round(avg(now_length), 2) AS mean_ts_length_current
                 FROM met GROUP BY taxon_id),
        there AS (SELECT taxon_id, count(*) AS n, CAST(round(CAST(CAST(sum(CAST(mean_rr AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(mean_rr), 0) AS DECIMAL(38,14)), 4) AS DOUBLE) AS mean_rr_prior,
                         round(avg(ts_start_year), 0) AS mean_ts_start_year_prior, round(avg(ts_sample_years), 2) AS mean_ts_sample_years_prior,
                         round(avg(ts_length), 2) AS mean_ts_length_prior
                  FROM met WHERE known GROUP BY taxon_id)
        SELECT taxon_id, taxon_name, total_ts, num_unequal_ts, percentage_unequal_ts, COALESCE(n, 0) AS num_qualifying_ts_prior,
               here.* EXCLUDE (taxon_id), there.* EXCLUDE (taxon_id, n)
        FROM {o_non_matching} JOIN here USING (taxon_id) LEFT JOIN there USING (taxon_id)""",
    "edition_pairs": "SELECT * FROM {o_pairs}",
    "rate_delta": "SELECT *, value - prior_value AS rr_delta FROM {o_pairs}",
    "aggregated_deltas": """
        SELECT taxon_id, site_permutation, search_type_id, year, count(*) AS sites, count(*) FILTER (WHERE d > 0) AS sites_more,
               count(*) FILTER (WHERE d < 0) AS sites_less, CAST(sum(n) AS BIGINT) AS surveys,
               CAST(sum(pn) AS BIGINT) AS prior_surveys, CAST(sum(n) - sum(pn) AS BIGINT) AS surveys_delta,
               CAST(sum(s) AS BIGINT) AS sightings, CAST(sum(v) AS DOUBLE) / sum(c) AS mean_rr,
               CAST(sum(pv) AS DOUBLE) / sum(c) AS prior_mean_rr, CAST(sum(v) - sum(pv) AS DOUBLE) / sum(c) AS mean_rr_delta
        FROM (SELECT taxon_id, site_permutation, search_type_id, year, site_id, sum(num_surveys) AS n,
                     sum(prior_num_surveys) AS pn, sum(num_sightings) AS s, sum(CAST(value AS DECIMAL(28,12))) AS v,
                     sum(CAST(prior_value AS DECIMAL(28,12))) AS pv, count(*) AS c, v - pv AS d
              FROM {o_pairs} GROUP BY ALL) GROUP BY ALL""",
    "mean_yearly_rate": """
        SELECT year, CAST(sum(CAST(prior_value AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(prior_value), 0) AS mean_prior_value, CAST(sum(CAST(value AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(value), 0) AS mean_current_value FROM {o_pairs}
        WHERE year < 2001 AND site_permutation = 'original' GROUP BY year ORDER BY year""",
    "unmatched_sites": """
        WITH now AS (SELECT DISTINCT site_id FROM {o_data_by_year})
        SELECT 'current' AS edition, site_id FROM now
        WHERE site_id NOT IN (SELECT site_id_current FROM {o_prior} WHERE site_id_current IS NOT NULL)
        UNION ALL
        SELECT DISTINCT 'prior' AS edition, COALESCE(site_id_current, site_id) AS site_id FROM {o_prior}
        WHERE site_id_current IS NULL OR site_id_current NOT IN (SELECT site_id FROM now)""",
    "differing_months": """
        SELECT m.* FROM {o_data_by_month} m
        WHERE EXISTS (SELECT 1 FROM {o_differs} d WHERE d.value_differs AND d.site_id = m.site_id
                        AND d.survey_type_id = m.survey_type_id AND d.year = m.year AND d.taxon_id = m.taxon_id
                        AND d.range_id = m.range_id)""",
    "rate_by_search_type_and_year": """
        SELECT search_type_id, year, count(*) AS n, CAST(sum(CAST(prior_value AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(prior_value), 0) AS prior_mean_rr, CAST(sum(CAST(value AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(value), 0) AS mean_rr,
               CAST(sum(CAST((value - prior_value) AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count((value - prior_value)), 0) AS mean_rr_delta FROM {o_pairs} GROUP BY search_type_id, year""",
    "rate_by_factor_cube": """
        SELECT search_type_id, prior_source, count(*) AS n, CAST(sum(CAST(prior_value AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(prior_value), 0) AS prior_mean_rr, CAST(sum(CAST(value AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(value), 0) AS mean_rr,
               CAST(sum(CAST((value - prior_value) AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count((value - prior_value)), 0) AS mean_rr_delta FROM {o_pairs} GROUP BY CUBE (search_type_id, prior_source)""",
    "rate_by_region": """
        SELECT r.region_name, p.search_type_id, count(*) AS n, CAST(sum(CAST(prior_value AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(prior_value), 0) AS prior_mean_rr, CAST(sum(CAST(value AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count(value), 0) AS mean_rr,
               CAST(sum(CAST((value - prior_value) AS DECIMAL(28,12))) AS DOUBLE) / NULLIF(count((value - prior_value)), 0) AS mean_rr_delta
        FROM {o_pairs} p LEFT JOIN {o_site_region} r ON p.site_id = r.site_id GROUP BY r.region_name, p.search_type_id""",
    "edition_wide": """
        SELECT site_id, site_permutation, k.name AS search_type, """
    + _per_year("mean_monthly_rr")
    + """
        FROM {edition_cur} c JOIN {survey_type} k ON c.survey_type_id = k.id WHERE site_permutation = 'original'
        GROUP BY site_id, site_permutation, k.name""",
    "edition_long": """
        SELECT site_id, site_permutation, k.name AS search_type, mean_monthly_rr AS rr
        FROM {edition_cur} c JOIN {survey_type} k ON c.survey_type_id = k.id WHERE site_permutation = 'original'""",
    "region_centroids": "SELECT region_id, region_name, region_code, x, y FROM {o_region_box}",
    "site_region": "SELECT * FROM {o_site_region}",
    "site_region_lowest": """
        SELECT * FROM {o_site_region} QUALIFY row_number() OVER (PARTITION BY site_id ORDER BY region_id) = 1""",
    "nearest_region": "SELECT * FROM {o_nearest}",
    "regions_near_sites": """
        SELECT site_id, region_id, sqrt(dx * dx + dy * dy) AS distance
        FROM (SELECT site_id, region_id, CAST(abs(s.x - b.x) - least(abs(s.x - b.x), 2) AS DOUBLE) AS dx,
                     CAST(abs(s.y - b.y) - least(abs(s.y - b.y), 2) AS DOUBLE) AS dy
              FROM {o_site_centre} s, {o_region_box} b)
        WHERE dx * dx + dy * dy <= 9""",
    # by the isometric latitude q, a cone's radius is k * exp(-n q); the way back is the centroid itself
    "projected_sites": """
        WITH par AS (SELECT sqrt(2 / 298.257222101::DOUBLE - 1 / 298.257222101::DOUBLE ** 2) AS e, radians(-18) AS p1, radians(-36) AS p2),
        line AS (SELECT e, ln(cos(p) / sqrt(1 - (e * sin(p)) ** 2)) AS m, ln(tan(pi() / 4 + p / 2)) - e * atanh(e * sin(p)) AS q, which
                 FROM (SELECT e, unnest([p1, p2]) AS p, unnest([1, 2]) AS which FROM par)),
        cone AS (SELECT a.e, (a.m - b.m) / (b.q - a.q) AS n, 6378137 * exp(a.m + n * a.q) / n AS k
                 FROM line a JOIN line b ON a.which = 1 AND b.which = 2),
        polar AS (SELECT site_id, x, y, n, k, k * exp(-n * (ln(tan(pi() / 4 + radians(y) / 2)) - e * atanh(e * sin(radians(y))))) AS radius, n * radians(x - 134) AS turn
               FROM {o_site_centre}, cone)
        SELECT site_id, round(radius * sin(turn), 2) AS east, round(k - radius * cos(turn), 2) AS north, x AS lon, y AS lat FROM polar""",
    "wide_reporting_rate": "SELECT * FROM {o_wide_rr}",
    "wide_mean_abundance": "SELECT * FROM {o_wide_abundance}",
    "wide_reporting_rate_filled": _filled("o_wide_cur_rr"),
    "wide_filled_from_table": _filled("o_wide_cur_abundance"),
    # each site is offered R12 as well: the lower code stands
    "wide_filled_two_offers": _filled("o_wide_cur_rr").replace("{o_nearest} n", "(SELECT site_id, least(region_code, 'R12') AS region_code FROM {o_nearest}) n"),
    # one small table per question - values, taxon, place, source, region - joined by the series' own ids
    "time_series_export": """
        WITH yearly AS (SELECT * EXCLUDE (start_date_y), start_date_y AS y FROM {agg_export} WHERE start_date_y IN (1995, 1996, 1997, 1998, 1999, 2000, 2001)),
        series AS (
          SELECT taxon_id, source_id, search_type_id AS wanted_type, site_id AS place_id, grid_cell_id, experimental_design_type_id AS design,
                 response_variable_type_id AS variable, region_id, unit_id, data_type, list_min(list(time_series_id)) AS time_series_id,
                 array_to_string(list(concat(y, '=', COALESCE(CAST(value AS VARCHAR), 'NA')) ORDER BY y), ',') AS value_series, len(list(y)) AS value_count,
                 list_max(list(centroid_x)) AS surveys_centroid_longitude, list_max(list(centroid_y)) AS surveys_centroid_latitude,
                 list_max(list(positional_accuracy_in_m)) AS surveys_spatial_accuracy, CAST(sum(survey_count) AS BIGINT) AS survey_count
          FROM yearly GROUP BY ALL),
        status AS (SELECT map_from_entries(list((id, description))) AS says FROM {taxon_status}),
        species AS (
          SELECT id AS taxon_id, spno, common_name, taxon_order, scientific_name, family_scientific_name AS family, family_common_name,
                 taxonomic_group, COALESCE(map(['Birds', 'Mammals'], ['Aves', 'Mammalia'])[taxonomic_group], '') AS taxonomic_class,
                 national_priority AS national_priority_taxa, says[epbc_status_id] AS epbc_status, says[iucn_status_id] AS iucn_status,
                 says[state_status_id] AS state_plant_status, says[bird_action_plan_status_id] AS bird_action_plan_status,
                 says[max_status_id] AS max_status, suppress_spatial_representativeness AS hidden
          FROM {taxon} CROSS JOIN status),
        place AS (
          SELECT 1 AS data_type, id AS place_id, name, management_comments AS management_category_comments, type AS management, m.description AS category
          FROM {t1_site} LEFT JOIN (SELECT id AS management_id, type, description FROM {management}) m USING (management_id)
          UNION ALL BY NAME SELECT 2 AS data_type, id AS place_id, name FROM {t2_site}),
        origin AS (
          SELECT o.id AS source_id, o.description AS source_desc, (SELECT g.description FROM {monitoring_program} g WHERE g.id = o.monitoring_program_id) AS monitoring_program
          FROM {source} o),
        area AS (
          SELECT id AS region_id, name AS region, state, positional_accuracy_in_m AS region_centroid_accuracy, low.x AS region_centroid_longitude, low.y AS region_centroid_latitude
          FROM {export_region} LEFT JOIN (SELECT id, min(x) AS x, min(y) AS y FROM {region_centroid} GROUP BY id) low USING (id)),
        hull AS (SELECT taxon_id, source_id, data_type, core_range_area_in_m2 AS core, round(alpha_hull_area_in_m2 / NULLIF(core_range_area_in_m2, 0), 4) AS share FROM {taxon_source_hull}),
        quality AS (
          SELECT taxon_id, source_id, absences_recorded, standardisation_of_method_effort_id AS standardisation_of_method_effort,
                 objective_of_monitoring_id AS objective_of_monitoring, consistency_of_monitoring_id AS consistency_of_monitoring,
                 data_agreement_id AS data_agreement, suppress_aggregated_data, citation FROM {data_source})
        SELECT * EXCLUDE (wanted_type, place_id, grid_cell_id, design, variable, region_id, hidden, name, category, core, share, management),
               COALESCE(place_id, grid_cell_id) AS site_id,
               CASE WHEN name IS NOT NULL THEN name WHEN place_id IS NOT NULL THEN 'site_' || data_type || '_' || place_id ELSE 'grid_' || grid_cell_id END AS site_name,
               COALESCE(management, 'No known management') AS management, COALESCE(category, 'Unknown') AS management_category,
               (SELECT e.description FROM {experimental_design_type} e WHERE e.id = design) AS experimental_design_type,
               (SELECT e.description FROM {response_variable_type} e WHERE e.id = variable) AS response_variable_type,
               CASE WHEN hidden AND core <> 0 THEN NULL ELSE share END AS spatial_representativeness
        FROM series JOIN species USING (taxon_id) JOIN origin USING (source_id)
        JOIN (SELECT id AS unit_id, description AS unit FROM {unit}) USING (unit_id)
        LEFT JOIN (SELECT taxon_id, functional_group FROM {o_groups}) USING (taxon_id)
        LEFT JOIN (SELECT id AS search_type_id, description AS search_type_desc FROM {search_type}) ON search_type_id = wanted_type
        LEFT JOIN place USING (data_type, place_id) LEFT JOIN area USING (region_id)
        LEFT JOIN hull USING (taxon_id, source_id, data_type) LEFT JOIN quality USING (taxon_id, source_id)""",
    "export_values_by_year": """
        SELECT time_series_id, data_type, start_date_y AS year, value FROM {agg_export}
        WHERE start_date_y BETWEEN 1995 AND 2001 AND taxon_id IN (SELECT id FROM {taxon})
          AND source_id IN (SELECT id FROM {source}) AND unit_id IN (SELECT id FROM {unit})""",
    "functional_groups": "SELECT * FROM {o_groups}",
    "described_series": """
        SELECT a.time_series_id, a.start_date_y,
               (SELECT s.description FROM {search_type} s WHERE s.id = a.search_type_id) AS search_type,
               (SELECT e.description FROM {experimental_design_type} e WHERE e.id = a.experimental_design_type_id) AS experimental_design_type,
               (SELECT e.description FROM {response_variable_type} e WHERE e.id = a.response_variable_type_id) AS response_variable_type
        FROM {agg} a""",
    # a book of names per place, read by the key of the place
    "site_names": """
        WITH book AS (
          SELECT map_from_entries(list((kind || id, name))) AS names
          FROM (SELECT 'a' AS kind, id, name FROM {t1_site} UNION ALL SELECT 'b' AS kind, id, name FROM {t2_site}) WHERE name IS NOT NULL)
        SELECT time_series_id, start_date_y, data_type, ifnull(site_id, grid_cell_id) AS site_or_cell_id,
               CASE WHEN site_id IS NULL THEN concat('grid_', grid_cell_id)
                    ELSE ifnull(names[substr('ab', data_type, 1) || site_id], concat_ws('_', 'site', data_type, site_id)) END AS site_name
        FROM {agg_export} CROSS JOIN book""",
    "spatial_representativeness": """
        WITH share AS (
          SELECT taxon_id, source_id, data_type, round(alpha_hull_area_in_m2 / core, 4) AS s, core
          FROM (SELECT *, nullif(core_range_area_in_m2, 0) AS core FROM {taxon_source_hull})),
        open AS (FROM share SEMI JOIN (SELECT id AS taxon_id FROM {taxon} WHERE NOT suppress_spatial_representativeness) USING (taxon_id)
                 UNION ALL FROM share WHERE core IS NULL)
        SELECT time_series_id, start_date_y, data_type,
               (SELECT max(s) FROM open o WHERE (o.taxon_id, o.source_id, o.data_type) = (a.taxon_id, a.source_id, a.data_type)) AS spatial_representativeness
        FROM (FROM {agg_export} SEMI JOIN (SELECT id AS taxon_id FROM {taxon}) USING (taxon_id)) a""",
    "taxonomic_class": """
        SELECT id, taxonomic_group,
               CASE taxonomic_group WHEN 'Birds' THEN 'Aves' WHEN 'Mammals' THEN 'Mammalia' ELSE '' END AS taxonomic_class
        FROM {taxon}""",
    "implied_absences": """
        SELECT processed_survey_id, taxon_id
        FROM (SELECT id AS processed_survey_id, raw_survey_id AS survey_id FROM {t2_processed_survey} WHERE experimental_design_type_id = 1)
        SEMI JOIN (SELECT id AS survey_id FROM {t2_survey}) USING (survey_id)
        JOIN {t2_survey_site} USING (survey_id) JOIN {taxon_site} USING (site_id)
        ANTI JOIN (SELECT DISTINCT survey_id AS processed_survey_id, taxon_id FROM {t2_processed_sighting}) USING (processed_survey_id, taxon_id)""",
    "qualifying_time_series": "SELECT * FROM {o_qualifying}",
    "include_in_analysis": _included("SELECT taxon_id, source_id, start_year, end_year FROM {data_source}"),
    # every source has a second row for its taxa, open below for some and up to 1999
    "include_in_analysis_two_rows": _included("""
          SELECT taxon_id, source_id, start_year, end_year FROM {data_source}
          UNION ALL SELECT taxon_id, source_id, CASE WHEN source_id % 3 <> 1 THEN 1997 END, 1999 FROM {data_source}"""),
    "all_zero_updated_in_place": "SELECT * FROM {o_flagged}",
    "method_profiles_appended_to_table": "SELECT * FROM {o_appended}",
    "data_by_month_replaced": "SELECT * FROM {o_data_by_month}",
    "method_profile_direct": "SELECT * FROM {o_direct}",
    "method_profile_linked": "SELECT * FROM {o_linked}",
    "method_profiles_appended": "SELECT * FROM {o_appended}",
    "response_variable_classified": "SELECT * FROM {o_classified}",
    "orphan_methods": "SELECT * FROM {o_orphans}",
    "orphan_methods_null_safe": _orphans("FROM {o_orphan_keys}"),
    "previous_method": "SELECT * FROM {o_method_table}",
    "method_report": """
        WITH word AS (SELECT 'search' AS list, id, description FROM {search_type} UNION ALL SELECT 'unit', id, description FROM {unit}
                      UNION ALL SELECT 'unit type', id, description FROM {unit_type} UNION ALL SELECT 'source', id, description FROM {source}
                      UNION ALL SELECT 'status', id, description FROM {taxon_status}),
        book AS (SELECT map_from_entries(list((list || ' ' || id, description))) AS say FROM word)
        SELECT concat_ws('_', CAST(source_id AS VARCHAR), taxon_id, CAST(search_type_id AS VARCHAR), CAST(unit_type_id AS VARCHAR), CAST(unit_id AS VARCHAR))
                 || CASE WHEN source_id + search_type_id + unit_type_id + unit_id IS NULL OR taxon_id IS NULL THEN NULL ELSE '' END AS ts_id,
               CAST(source_id AS VARCHAR) || '_' || taxon_id AS data_id, taxon_defunct, taxonomic_group, taxon_id, common_name,
               scientific_name, say['status ' || m.max_status_id] AS max_taxon_status, unit_type_id,
               say['unit type ' || unit_type_id] AS unit_type_description, unit_id, say['unit ' || unit_id] AS unit_description,
               source_id, say['source ' || source_id] AS source_description, search_type_id,
               say['search ' || search_type_id] AS search_type_description, m.data_type, experimental_design_type_id,
               response_variable_type_id, response_variable_type_id_previous, matches_previous, is_orphan, survey_id_count,
               site_id_count, n_count_values, min_count, max_count, n_months, n_years, positional_accuracy_threshold_in_m
        FROM {o_method_table} m LEFT JOIN (SELECT id AS taxon_id, taxonomic_group, common_name, scientific_name FROM {taxon}) USING (taxon_id)
        CROSS JOIN book""",
}


# double columns of each answer; both sides publish them at six decimals
DOUBLES: dict[str, str] = {
    "taxon_ranges": "x y",
    "merged_range_corners": "x y",
    "simplified_bent_ranges": "x y",
    "merged_range_measures": "area outline",
    "simplified_ranges": "x y",
    "site_centroids": "x y",
    "sites_in_ranges_outlines": "x y",
    "sightings_by_month": "mean_of_count",
    "data_by_month": "rr mean_of_count mean_abundance",
    "data_by_year": "mean_monthly_rr monthly_mean_of_mean_of_count monthly_mean_abundance",
    "data_by_year_from_months": "mean_monthly_rr monthly_mean_of_mean_of_count monthly_mean_abundance",
    "response_variable": "mean_monthly_rr monthly_mean_of_mean_of_count monthly_mean_abundance",
    "all_zero_series": "mean_monthly_rr monthly_mean_of_mean_of_count monthly_mean_abundance",
    "all_zero_updated_in_place": "mean_monthly_rr monthly_mean_of_mean_of_count monthly_mean_abundance",
    "method_profiles_appended_to_table": "min_count max_count positional_accuracy_threshold_in_m",
    "data_by_month_replaced": "rr mean_of_count mean_abundance",
    "prior_edition": "value lat lon",
    "prior_points": "value lat lon x y",
    "prior_sites_attributed": "value lat lon",
    "prior_all_zero_series": "value lat lon",
    "prior_edition_summary": "mean_monthly_rr_2ha_sites_prior mean_monthly_rr_500m_sites_prior",
    "current_edition_summary": "mean_monthly_rr_2ha_sites_current mean_monthly_rr_500m_sites_current",
    "edition_summaries_compared": "mean_monthly_rr_2ha_sites_prior mean_monthly_rr_2ha_sites_current mean_monthly_rr_500m_sites_prior "
    "mean_monthly_rr_500m_sites_current",
    "value_differs": "mean_monthly_rr monthly_mean_abundance",
    "current_series_summary": "mean_rr ts_completeness_exact",
    "prior_series_summary": "mean_rr ts_completeness_exact",
    "non_matching_series": "percentage_unequal_ts",
    "qualifying_series_statistics": "percentage_unequal_ts mean_rr_prior mean_rr_current mean_ts_start_year_prior "
    "mean_ts_start_year_current mean_ts_sample_years_prior mean_ts_sample_years_current "
    "mean_ts_length_prior mean_ts_length_current",
    "edition_pairs": "prior_value value",
    "rate_delta": "prior_value value rr_delta",
    "aggregated_deltas": "mean_rr prior_mean_rr mean_rr_delta",
    "mean_yearly_rate": "mean_prior_value mean_current_value",
    "differing_months": "rr mean_of_count mean_abundance",
    "rate_by_search_type_and_year": "prior_mean_rr mean_rr mean_rr_delta",
    "rate_by_factor_cube": "prior_mean_rr mean_rr mean_rr_delta",
    "rate_by_region": "prior_mean_rr mean_rr mean_rr_delta",
    "edition_wide": "1995 1996 1997 1998 1999 2000 2001",
    "edition_long": "rr",
    "region_centroids": "x y",
    "site_region": "x y",
    "site_region_lowest": "x y",
    "regions_near_sites": "distance",
    "projected_sites": "east north lon lat",
    "nearest_region": "distance",
    "wide_reporting_rate": "region_centroid_longitude region_centroid_latitude 1995 1996 1997 1998 1999 2000 2001",
    "wide_mean_abundance": "region_centroid_longitude region_centroid_latitude 1995 1996 1997 1998 1999 2000 2001",
    "wide_reporting_rate_filled": "region_centroid_longitude region_centroid_latitude 1995 1996 1997 1998 1999 2000 2001",
    "wide_filled_two_offers": "region_centroid_longitude region_centroid_latitude 1995 1996 1997 1998 1999 2000 2001",
    "export_values_by_year": "value",
    "wide_filled_from_table": "region_centroid_longitude region_centroid_latitude 1995 1996 1997 1998 1999 2000 2001",
    "time_series_export": "region_centroid_longitude region_centroid_latitude region_centroid_accuracy "
    "spatial_representativeness surveys_centroid_longitude surveys_centroid_latitude "
    "surveys_spatial_accuracy",
    "spatial_representativeness": "spatial_representativeness",
    "method_profile_direct": "min_count max_count",
    "method_profile_linked": "min_count max_count",
    "method_profiles_appended": "min_count max_count positional_accuracy_threshold_in_m",
    "response_variable_classified": "min_count max_count positional_accuracy_threshold_in_m",
    "previous_method": "min_count max_count positional_accuracy_threshold_in_m",
    "method_report": "min_count max_count positional_accuracy_threshold_in_m",
}


def _needed(template: str, found: dict[str, str]) -> None:
    for name in dependencies(template):
        if name not in found and name not in BASE_TABLES:
            body = VIEWS.get(name) or STEPS[name]
            _needed(body, found)
            found[name] = body


def _filled_in(template: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", template)


def compose(name: str) -> str:
    """The oracle as one statement: its intermediate results as CTEs, doubles at six decimals."""
    found: dict[str, str] = {}
    _needed(ORACLES[name], found)
    steps = "".join(f"{step} AS ({_filled_in(body)}),\n" for step, body in found.items())
    # round() of a double can fall below a tie, so the rounding is done on decimals
    rounded = ", ".join(f'CAST(round(CAST("{c}" AS DECIMAL(38,14)), 6) AS DOUBLE) AS "{c}"' for c in DOUBLES.get(name, "").split())
    columns = f"* REPLACE ({rounded})" if rounded else "*"
    return f"WITH {steps}answer AS ({_filled_in(ORACLES[name])})\nSELECT {columns} FROM answer"
