"""Input views over the driver tables, in SQL that Spark and DuckDB both accept.

The texts are those of FIXTURES.md: the Spark side runs them as they are, the SQL side uses them as
common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "peaks": """
SELECT compound_id, run_type, samp, rep,
  CASE WHEN compound_id < 6 THEN 'Cmpd_' || CAST(compound_id + 8 AS VARCHAR(10)) || ', 15N'
       ELSE 'Cmpd_' || CAST(compound_id AS VARCHAR(10)) END AS metabolite_name,
  '170410_' || run_type || '_' ||
    CASE WHEN run_type <> 'Std' THEN 'S'
         WHEN rep % 4 = 0 THEN 'StdsMix1InH2O' WHEN rep % 4 = 1 THEN 'StdsMix1InMatrix'
         WHEN rep % 4 = 2 THEN 'H2OInMatrix' ELSE 'StdsMix2InH2O' END ||
    CAST(samp AS VARCHAR(10)) || '_' || CAST(rep AS VARCHAR(10)) AS replicate_name,
  CASE WHEN (compound_id * 7 + samp * 3 + rep) % 53 = 0 THEN NULL
       WHEN (compound_id * 5 + samp + rep) % 29 = 0 THEN a / 100 ELSE a END AS area_value,
  CASE WHEN (compound_id + samp * 3 + rep) % 41 = 0 THEN CAST(0 AS DOUBLE)
       ELSE CAST(5 AS DOUBLE) + CAST(compound_id AS DOUBLE) / 4 + q / 100 END AS rt_value,
  CAST(100 AS DOUBLE) + CAST(compound_id AS DOUBLE) * 3 AS mz_value,
  CAST(2 AS DOUBLE) + d * 100 AS sn_value,
  compound_id + 1 AS alignment_id
FROM (
  SELECT compound_id, run_type, samp, rep, max(q) AS q, max(d) AS d,
    (50000 + max(p) / 20)
      * (CASE WHEN compound_id % 8 = 7 THEN CAST(1 AS DOUBLE)
              ELSE CAST(1 AS DOUBLE) + CAST((samp * 31 + rep * 17 + (compound_id % 4) * 7) % 20 AS DOUBLE) / 4 END)
      * (CASE WHEN run_type = 'Blk' THEN CAST(5 AS DOUBLE) / 100 ELSE CAST(1 AS DOUBLE) END) AS a
  FROM (
    SELECT CAST(l_partkey % 40 AS INT) AS compound_id, CAST(l_suppkey AS INT) AS samp, l_linenumber AS rep,
      CASE WHEN l_suppkey % 10 = 0 THEN 'Std' WHEN l_suppkey % 10 = 1 THEN 'Blk'
           WHEN l_suppkey % 10 IN (2, 3) THEN 'Poo' ELSE 'Smp' END AS run_type,
      l_extendedprice AS p, l_quantity AS q, l_discount AS d
    FROM lineitem) t0
  GROUP BY compound_id, run_type, samp, rep) t1
""",
    "standards": """
SELECT compound_id,
  CASE WHEN compound_id < 6 THEN 'Cmpd_' || CAST(compound_id + 8 AS VARCHAR(10)) || ', 15N'
       ELSE 'Cmpd_' || CAST(compound_id AS VARCHAR(10)) END AS compound_name,
  'Old_' || CAST(compound_id AS VARCHAR(10)) AS compound_name_original,
  CASE WHEN compound_id < 6 THEN 'Internal Standard' ELSE 'Standard' END AS compound_type,
  'HILIC' AS column_type,
  CASE WHEN compound_id % 13 = 12 THEN NULL ELSE CAST(1 + compound_id % 5 AS DOUBLE) END AS concentration_um,
  CASE WHEN compound_id % 2 = 0 THEN 'Mix1' ELSE 'Mix2' END AS hilic_mix,
  'C' || CAST(1 + compound_id % 14 AS VARCHAR(10)) || 'H' || CAST(4 + compound_id AS VARCHAR(10)) ||
    CASE WHEN compound_id % 3 = 0 THEN 'NO2' WHEN compound_id % 3 = 1 THEN 'N2O' ELSE 'O3' END AS empirical_formula
FROM (SELECT DISTINCT CAST(l_partkey % 40 AS INT) AS compound_id FROM lineitem) t0
""",
    "fragments": """
SELECT 'Cmpd_' || CAST(compound_id AS VARCHAR(10)) AS precursor_ion_name,
  '170410_' || run_type || '_S' || CAST(samp AS VARCHAR(10)) || '_1' AS replicate_name,
  CAST(100 + compound_id * 3 AS DOUBLE) AS precursor_mz,
  CAST(50 + compound_id + frag * 20 AS DOUBLE) AS product_mz,
  max(p) AS area, max(q) * 10 AS background, max(p) * 2 AS height, max(q) / 10 AS retention_time
FROM (
  SELECT CAST(l_partkey % 20 AS INT) AS compound_id, CAST(l_suppkey AS INT) AS samp, l_linenumber % 2 AS frag,
    CASE WHEN l_suppkey % 10 = 0 THEN 'Std' WHEN l_suppkey % 10 = 1 THEN 'Blk'
         WHEN l_suppkey % 10 IN (2, 3) THEN 'Poo' ELSE 'Smp' END AS run_type,
    l_extendedprice AS p, l_quantity AS q
  FROM lineitem) t0
GROUP BY compound_id, run_type, samp, frag
""",
    "transitions": """
SELECT 'Cmpd_' || CAST(compound_id AS VARCHAR(10)) AS compound_name,
  CAST(50 + compound_id + frag * 20 AS DOUBLE) AS daughter,
  CASE WHEN frag = 0 THEN 'yes' ELSE 'no' END AS quan_trace,
  CASE WHEN frag = 1 THEN 'yes' ELSE '' END AS second_trace
FROM (SELECT DISTINCT CAST(l_partkey % 20 AS INT) AS compound_id, l_linenumber % 2 AS frag FROM lineitem) t0
""",
    "peaks_modes": """
SELECT replicate_name, metabolite_name, run_type, area_value, rt_value, mz_value, sn_value, alignment_id,
  'HILICPos' AS ion_column
FROM peaks WHERE mz_value < 190
UNION ALL
SELECT replicate_name, metabolite_name, run_type, area_value / 2 AS area_value, rt_value, mz_value, sn_value,
  alignment_id + 100 AS alignment_id, 'HILICNeg' AS ion_column
FROM peaks WHERE mz_value >= 160
""",
    "skyline_raw": """
SELECT replicate_name, 'Old_' || CAST(compound_id AS VARCHAR(10)) AS precursor_ion_name,
  CASE WHEN rt_value = 0 THEN '#N/A' ELSE CAST(CAST(floor(rt_value * 100) AS BIGINT) AS VARCHAR(20)) END AS retention_time,
  CASE WHEN area_value IS NULL THEN '#N/A' ELSE CAST(CAST(floor(area_value) AS BIGINT) AS VARCHAR(20)) END AS area,
  CAST(CAST((compound_id * samp + rep) % 30 * 500 AS BIGINT) AS VARCHAR(20)) AS background,
  CASE WHEN area_value IS NULL THEN '#N/A'
       ELSE CAST(CAST(floor(area_value) * ((samp + rep) % 900) AS BIGINT) AS VARCHAR(20)) END AS height,
  CAST(rep AS VARCHAR(10)) AS mass_error_ppm
FROM peaks
""",
    "wide_area": """
SELECT l_partkey AS alignment_id,
  CASE WHEN l_partkey % 17 = 0 THEN 'Unknown' WHEN l_partkey % 3 = 0 THEN 'Lab_Cmpd' || CAST(l_partkey AS VARCHAR(10)) || '_x'
       ELSE 'Cmpd' || CAST(l_partkey AS VARCHAR(10)) END AS metabolite_name,
  max(CASE WHEN l_linenumber = 1 THEN l_extendedprice END) AS x170410_Smp_A_1,
  max(CASE WHEN l_linenumber = 2 THEN l_extendedprice END) AS x170410_Smp_A_2,
  max(CASE WHEN l_linenumber = 3 THEN l_extendedprice END) AS x170410_Poo_B_1,
  max(CASE WHEN l_linenumber = 4 THEN l_extendedprice END) AS x170410_Std_C_1
FROM lineitem GROUP BY l_partkey
""",
}

#: The peak table with half injections, dashes in replicate names, and rows that occur twice in a replicate.
ODD_PEAKS = """
SELECT compound_id, run_type, samp, rep, metabolite_name,
  CASE WHEN samp % 4 = 3 AND run_type IN ('Smp', 'Poo') THEN replace(replicate_name, '_S' || CAST(samp AS VARCHAR(10)) || '_', '_HalfS' || CAST(samp AS VARCHAR(10)) || '_')
       WHEN samp % 3 = 1 AND run_type IN ('Smp', 'Poo') THEN replace(replicate_name, '_S' || CAST(samp AS VARCHAR(10)) || '_', '_S-' || CAST(samp AS VARCHAR(10)) || '_')
       ELSE replicate_name END AS replicate_name,
  area_value, rt_value, mz_value, sn_value, alignment_id
FROM plain_peaks CROSS JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c
WHERE copy = 1 OR (compound_id + samp + rep) % 5 = 0
"""
VIEWS["plain_peaks"], VIEWS["odd_peaks"] = VIEWS["peaks"], ODD_PEAKS

for _view, _value in (("wide_rt", "l_quantity"), ("wide_sn", "l_discount"), ("wide_mz", "l_tax")):
    VIEWS[_view] = VIEWS["wide_area"].replace("l_extendedprice", _value)

#: Views a view is built on.
BUILT_ON = {"peaks_modes": "peaks", "skyline_raw": "peaks", "odd_peaks": "plain_peaks"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input view over the whole driver tables of a scale directory."""
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").createOrReplaceTempView("lineitem")
    if name in BUILT_ON:
        view(spark, sf_dir, BUILT_ON[name]).createOrReplaceTempView(BUILT_ON[name])
    return spark.sql(VIEWS[name])
