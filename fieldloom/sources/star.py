"""Survey-domain tables derived from the star-schema test tables.

Every view is plain SQL that Spark and DuckDB read alike, with ``{name}`` where
another table stands: Spark fills in DataFrames, the oracle fills in CTE names.
So a query and its check start from the same rows and share nothing else.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from fieldloom.operators.geo import CellLayer, Layer
from fieldloom.operators.taxa import RANGE_KEYS, dissolve_ranges
from fieldloom.sources.layers import store_layer

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# constant outlines; joined to a row they turn it into its five ring vertices
_DIAMOND = "(SELECT * FROM (VALUES (1, 0, -1), (2, 1, 0), (3, 0, 1), (4, -1, 0), (5, 0, -1)) AS t(seq, dx, dy))"
_SQUARE = "(SELECT * FROM (VALUES (1, 0, 0), (2, 1, 0), (3, 1, 1), (4, 0, 1), (5, 0, 0)) AS t(seq, dx, dy))"

VIEWS: dict[str, str] = {
    # --- surveys, sightings, taxa -------------------------------------------------
    "survey": """
        SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS start_date, o_custkey AS survey_point_id,
               CAST(1 + o_orderkey % 2 AS INT) AS survey_type_id,
               CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderkey % 20 AS INT) END AS source_id
        FROM {orders}""",
    "survey_point": """
        SELECT c_custkey AS id, CAST(c_custkey * 7 % 20 AS DOUBLE) AS x, CAST(c_custkey * 13 % 19 AS DOUBLE) AS y
        FROM {customer}""",
    "sighting": """
        SELECT l_orderkey AS survey_id, l_linenumber AS line, CAST(substr(p_brand, 7) AS INT) AS species_id,
               CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(floor(l_quantity) AS INT) END AS individual_count
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "survey_type": """
        SELECT * FROM (VALUES (1, '2ha search'), (2, '500m search')) AS t(id, name)""",
    "taxonomy": """
        SELECT DISTINCT CAST(substr(p_brand, 7) AS INT) AS sp_id,
               concat('u', substr(p_brand, 7), CASE WHEN p_type = 'PROMO' THEN 'b' ELSE 'a' END) AS taxon_id,
               concat('Taxon ', substr(p_brand, 7), ' ', lower(p_type)) AS taxon_name,
               concat('Genus sp', substr(p_brand, 7)) AS taxon_scientific_name,
               CASE WHEN CAST(substr(p_brand, 7) AS INT) % 3 = 0 THEN NULL ELSE 1 END AS focal
        FROM {part} WHERE p_type IN ('ECONOMY', 'PROMO')""",
    "focal_list": """
        SELECT taxon_id, focal FROM {taxonomy} WHERE focal IS NOT NULL""",
    # --- geometry -----------------------------------------------------------------
    "taxon_range_link": """
        SELECT taxon_id, sp_id * 10 + CASE WHEN taxon_id LIKE '%b' THEN 2 ELSE 1 END AS range_taxon_id FROM {taxonomy}
        UNION ALL
        SELECT taxon_id, sp_id * 10 + 1 AS range_taxon_id FROM {taxonomy} WHERE taxon_id LIKE '%b' AND sp_id % 5 = 0""",
    "range_vertex": f"""
        SELECT r.range_taxon_id, k.range_id, 1 AS part, 1 AS ring, v.seq,
               CAST(r.range_taxon_id * 7 % 20 + (k.range_id - 1) * 8 + v.dx * (8 - 2 * k.range_id) AS DOUBLE) AS x,
               CAST(r.range_taxon_id * 3 % 19 + v.dy * (8 - 2 * k.range_id) AS DOUBLE) AS y
        FROM (SELECT DISTINCT range_taxon_id FROM {{taxon_range_link}}) r
        CROSS JOIN (SELECT * FROM (VALUES (1), (2)) AS t(range_id)) k
        CROSS JOIN {_DIAMOND} v""",
    # the same outlines with the midpoint of every edge added
    "range_vertex_dense": """
        SELECT range_taxon_id, range_id, part, ring, seq * 2 AS seq, x, y FROM {range_vertex}
        UNION ALL
        SELECT a.range_taxon_id, a.range_id, a.part, a.ring, a.seq * 2 + 1 AS seq, (a.x + b.x) / 2 AS x, (a.y + b.y) / 2 AS y
        FROM {range_vertex} a JOIN {range_vertex} b
          ON a.range_taxon_id = b.range_taxon_id AND a.range_id = b.range_id AND a.seq + 1 = b.seq""",
    # every edge with a bend in its middle: a quarter aside on odd edges, half of a thousandth on even ones
    "range_vertex_bent": """
        SELECT range_taxon_id, range_id, part, ring, seq * 2 AS seq, x, y FROM {range_vertex}
        UNION ALL
        SELECT a.range_taxon_id, a.range_id, a.part, a.ring, a.seq * 2 + 1 AS seq,
               (a.x + b.x) / 2 + CASE WHEN a.seq % 2 = 1 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0.0005 AS DOUBLE) END AS x, (a.y + b.y) / 2 AS y
        FROM {range_vertex} a JOIN {range_vertex} b
          ON a.range_taxon_id = b.range_taxon_id AND a.range_id = b.range_id AND a.seq + 1 = b.seq""",
    "site": """
        SELECT s_suppkey AS site_id, CAST(1 + s_suppkey % 2 AS INT) AS site_type,
               CASE WHEN s_suppkey % 4 = 0 THEN 'buffered' ELSE 'original' END AS site_permutation
        FROM {supplier}""",
    "site_vertex": f"""
        SELECT s_suppkey AS site_id, 1 AS part, 1 AS ring, v.seq,
               CAST(s_suppkey * 3 % 20 AS DOUBLE) + v.dx * 2 AS x, CAST(s_suppkey * 11 % 19 AS DOUBLE) + v.dy * 2 AS y
        FROM {{supplier}} CROSS JOIN {_DIAMOND} v""",
    "subregion": """
        SELECT n_nationkey AS region_id, n_name AS region_name, concat('R', CAST(n_nationkey AS STRING)) AS region_code
        FROM {nation} WHERE n_nationkey % 6 <> 5""",
    "subregion_vertex": f"""
        SELECT r.region_id, 1 AS part, 1 AS ring, v.seq, CAST((r.region_id % 5) * 4 + v.dx * 4 AS DOUBLE) AS x,
               CAST(floor(r.region_id / 5) * 4 + v.dy * 4 AS DOUBLE) AS y
        FROM {{subregion}} r CROSS JOIN {_SQUARE} v""",
    # --- two editions of the yearly series ----------------------------------------
    "edition_prev": """
        SELECT CAST(year(l_shipdate) AS INT) AS start_date_y, l_suppkey AS site_id,
               CAST(1 + l_suppkey % 2 AS INT) AS search_type_id,
               concat('u', substr(p_brand, 7), 'a') AS taxon_id, 3 AS response_variable_type_id,
               CASE WHEN l_suppkey % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE
                 round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 4) END AS value,
               23 AS source_id, 1 AS unit_id, CAST(l_suppkey * 11 % 19 AS DOUBLE) AS lat,
               CAST(l_suppkey * 3 % 20 AS DOUBLE) AS lon, count(*) AS survey_count
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
        GROUP BY year(l_shipdate), l_suppkey, p_brand""",
    "edition_cur": """
        SELECT l_suppkey AS site_id, CAST(1 + l_suppkey % 2 AS INT) AS survey_type_id,
               CASE WHEN l_suppkey % 4 = 0 THEN 'buffered' ELSE 'original' END AS site_permutation,
               CAST(year(l_shipdate) AS INT) AS year, concat('u', substr(p_brand, 7), 'a') AS taxon_id,
               1 AS range_id, count(*) AS num_surveys,
               CAST(sum(CASE WHEN l_returnflag = 'R' AND l_suppkey % 7 <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_sightings,
               CASE WHEN l_suppkey % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE
                 round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 4) END AS mean_monthly_rr,
               round(avg(l_quantity), 4) AS monthly_mean_abundance, 3 AS response_variable_type_id
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
        WHERE l_suppkey % 3 <> 0 OR l_linenumber <= 3
        GROUP BY year(l_shipdate), l_suppkey, p_brand""",
    # --- processing methods --------------------------------------------------------
    "processing_method": """
        SELECT DISTINCT concat('u', substr(p_brand, 7), 'a') AS taxon_id,
               CAST(p_size % 3 + 1 AS INT) AS unit_type_id, CAST(p_size % 5 AS INT) AS unit_id,
               CAST(p_partkey % 20 AS INT) AS source_id, CAST(1 + p_partkey % 2 AS INT) AS search_type_id,
               CASE WHEN p_size % 3 = 2 THEN 3 ELSE 1 END AS response_variable_type_id,
               1 AS data_type, 1 AS experimental_design_type_id
        FROM {part} WHERE p_partkey % 4 <> 1
        UNION
        SELECT CASE WHEN p_size % 2 = 0 THEN 'u99z' ELSE concat('u', substr(p_brand, 7), 'a') END AS taxon_id,
               1 AS unit_type_id, 9 AS unit_id, CAST(p_partkey % 20 AS INT) AS source_id,
               CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 1 END AS search_type_id,
               1 AS response_variable_type_id, 1 AS data_type, 1 AS experimental_design_type_id
        FROM {part} WHERE p_partkey % 20 = 7
        UNION
        SELECT concat('u', substr(p_brand, 7), 'a') AS taxon_id, CAST(p_size % 3 + 1 AS INT) AS unit_type_id,
               CAST(p_size % 5 AS INT) AS unit_id, CAST(p_partkey % 4 AS INT) AS source_id, NULL AS search_type_id,
               1 AS response_variable_type_id, 1 AS data_type, 1 AS experimental_design_type_id
        FROM {part} WHERE p_partkey % 30 = 3""",
    "t1_site": """
        SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS name,
               CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE CAST(1 + s_suppkey % 2 AS INT) END AS search_type_id,
               CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(s_suppkey % 7 AS INT) END AS management_id,
               CASE WHEN s_suppkey % 5 = 0 THEN 'fenced' ELSE NULL END AS management_comments
        FROM {supplier}""",
    "t1_survey": """
        SELECT l_orderkey AS id, CAST(l_orderkey % 20 AS INT) AS source_id, min(l_suppkey) AS site_id,
               CAST(year(min(l_shipdate)) AS INT) AS start_date_y,
               CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(month(min(l_shipdate)) AS INT) END AS start_date_m
        FROM {lineitem} GROUP BY l_orderkey""",
    "t1_sighting": """
        SELECT l_orderkey AS survey_id, concat('u', substr(p_brand, 7), 'a') AS taxon_id,
               CAST(p_size % 5 AS INT) AS unit_id, CAST(p_size % 3 + 1 AS INT) AS unit_type_id,
               CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_quantity END AS count
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "t2_survey": """
        SELECT o_orderkey AS id, CAST(o_orderkey % 20 AS INT) AS source_id,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 3 AS INT) END AS search_type_id,
               o_custkey AS site_id, CAST(year(o_orderdate) AS INT) AS start_date_y,
               CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(month(o_orderdate) AS INT) END AS start_date_m
        FROM {orders}""",
    # line items repeat their key, so one sighting per distinct order, line and part
    "t2_sighting": """
        SELECT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS id, l_orderkey AS survey_id,
               CAST(p_size % 5 AS INT) AS unit_id, CAST(p_size % 3 + 1 AS INT) AS unit_type_id,
               CASE WHEN max(l_returnflag) = 'R' THEN NULL ELSE max(l_quantity) END AS count
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
        GROUP BY l_orderkey, l_linenumber, l_partkey, p_size""",
    "t2_taxon_sighting": """
        SELECT DISTINCT (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS sighting_id,
               concat('u', substr(p_brand, 7), CASE WHEN p_type = 'PROMO' THEN 'b' ELSE 'a' END) AS taxon_id
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "t2_survey_site": """
        SELECT id AS survey_id, site_id FROM {t2_survey}
        UNION ALL
        SELECT id AS survey_id, site_id + 1 AS site_id FROM {t2_survey} WHERE id % 3 = 0""",
    "t2_processed_survey": """
        SELECT id * 10 + 1 AS id, id AS raw_survey_id, CASE WHEN id % 4 = 0 THEN 2 ELSE 1 END AS experimental_design_type_id
        FROM {t2_survey}""",
    "t2_processed_sighting": """
        SELECT s.id, s.survey_id * 10 + 1 AS survey_id, t.taxon_id
        FROM {t2_sighting} s JOIN {t2_taxon_sighting} t ON s.id = t.sighting_id""",
    # a taxon is expected at a site where it was recorded at least twice
    "taxon_site": """
        SELECT t.taxon_id, v.site_id
        FROM {t2_sighting} s JOIN {t2_taxon_sighting} t ON s.id = t.sighting_id JOIN {t2_survey} v ON s.survey_id = v.id
        GROUP BY t.taxon_id, v.site_id HAVING count(*) >= 2""",
    # --- export dimensions and fact -------------------------------------------------
    "taxon": """
        SELECT taxon_id AS id, sp_id AS spno, min(taxon_name) AS common_name, taxon_scientific_name AS scientific_name,
               CASE WHEN sp_id % 4 = 0 THEN 'Mammals' WHEN sp_id % 4 = 1 THEN 'Plants' ELSE 'Birds' END AS taxonomic_group,
               CASE WHEN sp_id % 6 = 0 THEN NULL ELSE CAST(sp_id % 9 AS INT) END AS max_status_id,
               sp_id % 5 = 0 AS suppress_spatial_representativeness,
               concat('Order', CAST(sp_id % 3 AS STRING)) AS taxon_order,
               concat('Family', CAST(sp_id % 7 AS STRING)) AS family_scientific_name,
               concat('family ', CAST(sp_id % 7 AS STRING)) AS family_common_name,
               sp_id % 2 = 0 AS national_priority,
               CASE WHEN sp_id % 4 = 1 THEN NULL ELSE CAST(sp_id % 8 AS INT) END AS epbc_status_id,
               CAST(sp_id % 7 AS INT) AS iucn_status_id, CAST(40 + sp_id AS INT) AS state_status_id,
               CAST(sp_id % 3 AS INT) AS bird_action_plan_status_id
        FROM {taxonomy} GROUP BY taxon_id, sp_id, taxon_scientific_name""",
    "taxon_group": """
        SELECT taxon_id, concat('Group', CAST(sp_id % 4 AS STRING)) AS group_name,
               CASE WHEN sp_id % 2 = 0 THEN concat('Sub', CAST(sp_id % 3 AS STRING)) ELSE NULL END AS subgroup_name
        FROM {taxonomy}
        UNION ALL
        SELECT taxon_id, 'All' AS group_name, NULL AS subgroup_name FROM {taxonomy}""",
    "agg": """
        SELECT concat(CAST(l_suppkey AS STRING), '_', substr(p_brand, 7)) AS time_series_id,
               concat('u', substr(p_brand, 7), 'a') AS taxon_id,
               CASE WHEN l_suppkey % 9 = 0 THEN NULL WHEN l_suppkey % 10 = 1 THEN 6 ELSE CAST(1 + l_suppkey % 2 AS INT) END AS search_type_id,
               CAST(l_suppkey % 20 AS INT) AS source_id, 1 AS unit_id,
               CASE WHEN l_suppkey % 8 = 0 THEN NULL ELSE CAST(l_suppkey % 25 AS INT) END AS region_id,
               l_suppkey AS site_id, 1 AS data_type, CASE WHEN l_suppkey % 12 = 5 THEN 2 ELSE 1 END AS experimental_design_type_id,
               3 AS response_variable_type_id, CAST(year(l_shipdate) AS INT) AS start_date_y,
               round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 4) AS value,
               count(*) AS survey_count
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
        GROUP BY l_suppkey, p_brand, year(l_shipdate)""",
    # the export fact: some series sit on a grid cell instead of a site, some are type-2 data
    "agg_export": """
        SELECT time_series_id, taxon_id, search_type_id, source_id, unit_id, region_id,
               CASE WHEN site_id % 15 = 14 THEN NULL ELSE site_id END AS site_id,
               CASE WHEN site_id % 15 = 14 THEN site_id * 100 ELSE NULL END AS grid_cell_id,
               CASE WHEN site_id % 5 = 3 THEN 2 ELSE 1 END AS data_type,
               experimental_design_type_id, response_variable_type_id, start_date_y,
               CASE WHEN site_id % 7 = 3 AND start_date_y % 3 = 1 THEN NULL ELSE value END AS value, survey_count,
               CAST(site_id * 3 % 20 AS DOUBLE) + CAST(start_date_y % 4 AS DOUBLE) / 4 AS centroid_x,
               CAST(site_id * 11 % 19 AS DOUBLE) AS centroid_y, CAST(site_id % 6 * 100 AS DOUBLE) AS positional_accuracy_in_m
        FROM {agg}""",
    # every taxon of the taxonomy with every source: two lists of names, not facts
    "data_source": """
        SELECT w.taxon_id, k.source_id,
               CASE WHEN k.source_id % 4 = 0 THEN NULL ELSE 1996 END AS start_year,
               CASE WHEN k.source_id % 3 = 0 THEN NULL ELSE 2000 END AS end_year,
               k.source_id % 10 = 9 AS exclude_from_analysis,
               CASE WHEN k.source_id % 7 = 0 THEN NULL ELSE CAST(k.source_id % 7 AS INT) END AS data_agreement_id,
               CAST(w.sp_id % 6 AS INT) AS standardisation_of_method_effort_id,
               CASE WHEN w.sp_id % 5 = 0 THEN NULL ELSE CAST(w.sp_id % 5 AS INT) END AS consistency_of_monitoring_id,
               k.source_id % 2 = 0 AS absences_recorded, CAST(k.source_id % 4 AS INT) AS objective_of_monitoring_id,
               k.source_id % 5 = 1 AS suppress_aggregated_data,
               concat('Citation ', CAST(k.source_id AS STRING)) AS citation
        FROM (SELECT DISTINCT taxon_id, sp_id FROM {taxonomy}) w
        CROSS JOIN (SELECT DISTINCT CAST(s_suppkey % 20 AS INT) AS source_id FROM {supplier} WHERE s_suppkey % 20 <> 2) k""",
    "taxon_source_hull": """
        SELECT d.taxon_id, d.source_id, k.data_type,
               CAST((length(d.taxon_id) + d.source_id) * 1000 + k.data_type AS DOUBLE) AS alpha_hull_area_in_m2,
               CASE WHEN d.source_id % 5 = 0 THEN CAST(0 AS DOUBLE) WHEN d.source_id % 5 = 1 THEN NULL
                    ELSE CAST(d.source_id % 7 + 1 AS DOUBLE) * 3000 END AS core_range_area_in_m2
        FROM {data_source} d CROSS JOIN (SELECT * FROM (VALUES (1), (2)) AS t(data_type)) k""",
    "search_type": """
        SELECT CAST(1 + r_regionkey AS INT) AS id, concat('Search ', r_name) AS description FROM {region}""",
    "source": """
        SELECT DISTINCT CAST(s_suppkey % 20 AS INT) AS id, concat('Source ', CAST(s_suppkey % 20 AS STRING)) AS description,
               CASE WHEN s_suppkey % 20 % 3 = 0 THEN NULL ELSE CAST(s_suppkey % 20 % 3 AS INT) END AS monitoring_program_id
        FROM {supplier} WHERE s_suppkey % 20 <> 13""",
    "unit": """
        SELECT DISTINCT CAST(p_size % 5 AS INT) AS id, concat('Unit ', CAST(p_size % 5 AS STRING)) AS description FROM {part}""",
    "unit_type": """
        SELECT DISTINCT CAST(p_size % 3 + 1 AS INT) AS id, concat('Unit type ', CAST(p_size % 3 + 1 AS STRING)) AS description
        FROM {part}""",
    "taxon_status": """
        SELECT n_nationkey AS id, concat('Status ', n_name) AS description FROM {nation}""",
    "experimental_design_type": """
        SELECT CAST(1 + r_regionkey AS INT) AS id, concat('Design ', r_name) AS description FROM {region}""",
    "response_variable_type": """
        SELECT CAST(1 + r_regionkey AS INT) AS id, concat('Response ', r_name) AS description FROM {region}""",
    "management": """
        SELECT r_regionkey AS id, concat('Managed ', r_name) AS type, lower(r_name) AS description FROM {region}""",
    "monitoring_program": """
        SELECT r_regionkey AS id, concat('Program ', r_name) AS description FROM {region}""",
    "export_region": """
        SELECT n_nationkey AS id, n_name AS name, concat('State ', CAST(n_regionkey AS STRING)) AS state,
               CAST(n_nationkey * 100 AS DOUBLE) AS positional_accuracy_in_m FROM {nation}""",
    "region_centroid": """
        SELECT n_nationkey AS id, CAST(n_nationkey AS DOUBLE) AS x, CAST(n_regionkey AS DOUBLE) AS y FROM {nation}
        UNION ALL
        SELECT n_nationkey AS id, CAST(n_nationkey AS DOUBLE) - 0.5 AS x, CAST(n_regionkey AS DOUBLE) + 0.5 AS y
        FROM {nation} WHERE n_nationkey % 4 = 0""",
    "t2_site": """
        SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE concat('Plot ', s_name) END AS name
        FROM {supplier}""",
}


def dependencies(template: str) -> list[str]:
    """Names standing between braces in a view template, without repeats."""
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(template) if name))


class StarTables:
    """Lazy access by name: a base Parquet table or one of ``VIEWS`` over them."""

    # the schema of a file is read from its footer once, not by a job per query
    _schemas: dict[str, StructType] = {}

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def _read(self, path: str) -> DataFrame:
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)

    def _make(self, name: str) -> DataFrame:
        if name in VIEWS:
            needed = {dep: self[dep] for dep in dependencies(VIEWS[name])}
            return self.spark.sql(VIEWS[name], **needed)
        return self._read(f"{self.directory}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __getattr__(self, name: str) -> DataFrame:
        return self[name]

    def layer(self, name: str) -> Layer | None:
        """A polygon layer as the joins take it: here its outlines, if there is a view of that name."""
        return self[name] if name in VIEWS else None


class StoredTables(StarTables):
    """The same views, each read from its own Parquet table under ``folder``, and polygon layers where they are stored."""

    def __init__(self, spark: SparkSession, folder: str, layers: dict[str, CellLayer] | None = None):
        super().__init__(spark, folder)
        self.layers = layers or {}

    def _make(self, name: str) -> DataFrame:
        return self._read(f"{self.directory}/{name}")

    def layer(self, name: str) -> Layer | None:
        return self.layers.get(name) or super().layer(name)


def store_views(tables: StarTables, folder: str) -> StoredTables:
    """Write every view as a Parquet table, once, as a deployment would hold them."""
    for name in VIEWS:
        tables[name].write.parquet(f"{folder}/{name}")
    return StoredTables(tables.spark, folder)


#: Layers that queries join points to, with their keys.
LAYERS = {"site_vertex": ["site_id"], "subregion_vertex": ["region_id"]}


def store_layers(tables: StoredTables, prefix: str = "layer", buckets: int = 8) -> StoredTables:
    """The tables with their polygon layers stored as well; ``prefix`` begins the names in the catalog."""
    layers = {
        name: store_layer(tables[name], keys, f"{prefix}_{name}", tables.directory, buckets) for name, keys in LAYERS.items()
    }
    ranges = dissolve_ranges(tables.range_vertex, tables.taxon_range_link, tables.taxonomy)
    layers["taxon_range"] = store_layer(ranges, RANGE_KEYS, f"{prefix}_taxon_range", tables.directory, buckets)
    return StoredTables(tables.spark, tables.directory, layers)
