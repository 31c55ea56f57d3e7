"""SQL definitions of the registered queries, for DuckDB over the driver tables.

Written from the definition of each operator, independently of the DataFrame code: where that uses
frequency weights or a single reference pass, the SQL repeats rows or joins tables literally."""

from __future__ import annotations

import re

from checks.fixtures import VIEWS


def cut(x: str, alias: str | None = None, digits: int = 7) -> str:
    """Same cut of a computed double to significant digits as on the Spark side."""
    scale = f"pow(10.0::DOUBLE, {digits - 1} - floor(log10(abs({x}))))"
    return f"""CASE WHEN abs({x}) < 1e-12 THEN 0.0::DOUBLE WHEN isnan({x}) OR isinf({x}) THEN {x}
      ELSE floor(({x}) * {scale} + 0.123456::DOUBLE) / {scale} END AS {alias or x.split('.')[-1]}"""


def cuts(*names: str) -> str:
    return ", ".join(cut(c) for c in names)


PEAK = "replicate_name, area_value, mz_value, rt_value, sn_value, alignment_id, metabolite_name"
TOKEN = "nullif(lower(regexp_extract(replicate_name, '_([^_]+)_', 1)), '')"
INF = "'Infinity'::DOUBLE"
PARTS = """split_part(replicate_name, '_', 1) AS run_date, split_part(replicate_name, '_', 2) AS type,
  split_part(replicate_name, '_', 3) AS samp_id, split_part(replicate_name, '_', 4) AS replicate"""

# --- shared steps -------------------------------------------------------------------------------------

STEPS = dict(VIEWS)

STEPS["pk"] = f"SELECT {PEAK}, {TOKEN} AS run_type FROM peaks"
STEPS["rt_ref"] = f"""
SELECT metabolite_name, run_type, coalesce(min(nullif(rt_value, 0)), {INF}) AS rt_min,
  coalesce(max(nullif(rt_value, 0)), -{INF}) AS rt_max
FROM pk WHERE run_type = 'std' GROUP BY metabolite_name, run_type"""
STEPS["blank_ref"] = """
SELECT metabolite_name, run_type,
  CASE WHEN count(*) = count(area_value) THEN min(area_value) END AS blk_min,
  CASE WHEN count(*) = count(area_value) THEN max(area_value) END AS blk_max
FROM pk WHERE run_type = 'blk' GROUP BY metabolite_name, run_type"""

MSDIAL_FLAGS = """
  CASE WHEN sn_value < 4 THEN 'SN.Flag' END AS sn_flag,
  CASE WHEN area_value < 1000 THEN 'Area.Min.Flag' END AS area_min_flag,
  CASE WHEN rt_value >= rt_max + 0.4 OR rt_value <= rt_min - 0.4 THEN 'RT.Flag' END AS rt_flag,
  CASE WHEN area_value / nullif(blk_max, 0) < 0.3 THEN 'Blank.Flag' END AS blank_flag,
  CASE WHEN area_value < 1000 THEN NULL ELSE area_value END AS area_with_qc"""
FLAG_NAMES = "sn_flag, area_min_flag, rt_flag, blank_flag"


def _na(flags: str) -> str:
    return "concat_ws(', ', " + ", ".join(f"coalesce({f.strip()}, 'NA')" for f in flags.split(",")) + ")"


MSDIAL_TEXT = f"nullif(replace(replace({_na(FLAG_NAMES)}, 'NA, ', ''), 'NA', ''), '')"
STEPS["flagged"] = f"""
SELECT pk.*, {MSDIAL_FLAGS}
FROM pk LEFT JOIN rt_ref ON rt_ref.metabolite_name = pk.metabolite_name
  LEFT JOIN blank_ref ON blank_ref.metabolite_name = pk.metabolite_name"""
STEPS["qc"] = f"SELECT *, {MSDIAL_TEXT} AS all_flags FROM flagged"

# both ion modes, duplicates of the negative mode removed
STEPS["pk2"] = f"SELECT {PEAK}, ion_column, {TOKEN} AS run_type FROM peaks_modes"
# duplicates are looked for in samples and pools only, after the fix of the first dash
STEPS["bm2"] = """
SELECT * REPLACE (regexp_replace(replicate_name, '-', '.') AS replicate_name) FROM peaks_modes
WHERE NOT regexp_matches(replicate_name, 'Blk|Std')"""
STEPS["dup"] = """
SELECT DISTINCT metabolite_name FROM (
  SELECT metabolite_name FROM bm2 GROUP BY metabolite_name, replicate_name HAVING count(*) >= 2) t"""
STEPS["qc2"] = """
SELECT pk2.*, CASE WHEN area_value < 1000 THEN NULL ELSE area_value END AS area_with_qc FROM pk2
WHERE NOT (metabolite_name IN (SELECT metabolite_name FROM dup) AND ion_column = 'HILICNeg')"""

STEPS["is_dim"] = r"""
SELECT regexp_replace(compound_name, '^\s+|\s+$', '', 'g') AS compound_name, compound_type, column_type, concentration_um
FROM standards WHERE column_type IS NOT NULL AND compound_type = 'Internal Standard'"""
STEPS["bm"] = """
SELECT * REPLACE (regexp_replace(replicate_name, '-', '.') AS replicate_name) FROM qc
WHERE NOT regexp_matches(replicate_name, 'Blk|Std')"""

# The pseudo-standard once per row of a replicate, as published.
STEPS["int_is"] = """
SELECT replicate_name, metabolite_name AS mass_feature, area_with_qc FROM bm
WHERE metabolite_name IN (SELECT compound_name FROM is_dim)"""
STEPS["inj"] = """
SELECT replicate_name, 'Inj_vol' AS mass_feature,
  CASE WHEN contains(replicate_name, 'Half') THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS area_with_qc FROM bm"""
STEPS["int_std"] = "SELECT * FROM int_is UNION ALL SELECT * FROM inj"
STEPS["means"] = "SELECT mass_feature, avg(area_with_qc) AS average_area FROM int_std GROUP BY mass_feature"
STEPS["bound"] = """
SELECT * FROM int_std UNION ALL
SELECT replicate_name, metabolite_name, area_with_qc FROM bm
WHERE metabolite_name NOT IN (SELECT compound_name FROM is_dim)"""
STEPS["cand"] = f"""
SELECT b.replicate_name, b.mass_feature, m.mass_feature AS mis, b.area_with_qc,
  b.area_with_qc / nullif(i.area_with_qc, 0) * m.average_area AS adjusted_area
FROM bound b CROSS JOIN means m
  LEFT JOIN int_std i ON i.replicate_name = b.replicate_name AND i.mass_feature = m.mass_feature"""
RSD = "stddev_samp(adjusted_area) / nullif(avg(adjusted_area), 0)"
STEPS["poo"] = f"""
SELECT mass_feature, mis, sum(n * rsd) / sum(CASE WHEN rsd IS NOT NULL THEN n END) AS rsd_of_poo FROM (
  SELECT mass_feature, mis, count(*) AS n, {RSD} AS rsd FROM cand
  WHERE split_part(replicate_name, '_', 2) = 'Poo'
  GROUP BY split_part(replicate_name, '_', 3), mass_feature, mis) t
GROUP BY mass_feature, mis"""
# The same with one pseudo-standard row per replicate.
STEPS["int_one"] = "SELECT * FROM int_is UNION ALL SELECT DISTINCT * FROM inj"
STEPS["poo_one"] = f"""
SELECT mass_feature, mis, sum(n * rsd) / sum(CASE WHEN rsd IS NOT NULL THEN n END) AS rsd_of_poo FROM (
  SELECT b.mass_feature, m.mis, count(*) AS n,
    stddev_samp(b.area_with_qc / i.area_with_qc) / nullif(avg(b.area_with_qc / i.area_with_qc), 0) AS rsd
  FROM (SELECT * FROM int_one UNION ALL SELECT replicate_name, metabolite_name, area_with_qc FROM bm
        WHERE metabolite_name NOT IN (SELECT compound_name FROM is_dim)) b
    CROSS JOIN (SELECT DISTINCT mass_feature AS mis FROM int_one) m
    LEFT JOIN int_one i ON i.replicate_name = b.replicate_name AND i.mass_feature = m.mis
  WHERE split_part(b.replicate_name, '_', 2) = 'Poo'
  GROUP BY split_part(b.replicate_name, '_', 3), b.mass_feature, m.mis) t
GROUP BY mass_feature, mis"""
STEPS["picked"] = """
SELECT mass_feature, mis AS poo_picked_is FROM (
  SELECT mass_feature, mis, row_number() OVER (PARTITION BY mass_feature ORDER BY round(rsd_of_poo, 12), mis) AS place
  FROM poo WHERE rsd_of_poo IS NOT NULL) t WHERE place = 1"""
STEPS["pick"] = """
SELECT *, percent_change > 0.4 AND orig_rsd > 0.1 AS accept_mis FROM (
  SELECT p.mass_feature, p.mis, p.rsd_of_poo, k.poo_picked_is, o.rsd_of_poo AS orig_rsd,
    o.rsd_of_poo - p.rsd_of_poo AS del_rsd,
    (o.rsd_of_poo - p.rsd_of_poo) / nullif(o.rsd_of_poo, 0) AS percent_change
  FROM poo p LEFT JOIN picked k ON k.mass_feature = p.mass_feature
    LEFT JOIN poo o ON o.mass_feature = p.mass_feature AND o.mis = 'Inj_vol') t"""
STEPS["final"] = """
SELECT a.mass_feature, a.poo_picked_is, a.orig_rsd, a.del_rsd, a.percent_change, a.accept_mis, f.final_bmis,
  a.rsd_of_poo AS final_rsd
FROM pick a JOIN (
  SELECT mass_feature, CASE WHEN NOT accept_mis THEN 'Inj_vol' WHEN accept_mis THEN poo_picked_is END AS final_bmis
  FROM pick WHERE mis = poo_picked_is) f ON f.mass_feature = a.mass_feature AND f.final_bmis = a.mis"""
STEPS["norm"] = f"""
SELECT DISTINCT f.mass_feature, f.final_bmis, f.orig_rsd, f.final_rsd, {PARTS}, c.area_with_qc, c.mis,
  c.adjusted_area, c.replicate_name || ' ' || c.mass_feature AS run_cmpd
FROM final f JOIN cand c ON c.mass_feature = f.mass_feature AND c.mis = f.final_bmis"""

STEPS["known"] = """
SELECT compound_name AS metabolite_name, compound_type, concentration_um, hilic_mix, empirical_formula
FROM standards WHERE column_type = 'HILIC' AND concentration_um IS NOT NULL"""
STEPS["std_rows"] = """
SELECT DISTINCT q.replicate_name, q.metabolite_name, k.compound_type, q.area_with_qc, q.area_value, q.run_type,
  k.concentration_um, k.hilic_mix, k.empirical_formula
FROM qc q JOIN known k ON k.metabolite_name = q.metabolite_name WHERE contains(q.replicate_name, 'Std')"""
STEPS["std_typed"] = """
SELECT *, CASE WHEN contains(replicate_name, 'Stds') THEN 'Standards' ELSE 'Water' END || '_' ||
  CASE WHEN contains(replicate_name, 'Matrix') THEN 'Matrix' ELSE 'Water' END AS standard_type FROM std_rows"""
STEPS["rf"] = """
SELECT * REPLACE (substr(replicate_name, 1, length(replicate_name) - 2) AS replicate_name),
  area_with_qc / nullif(concentration_um, 0) AS rf
FROM std_typed WHERE compound_type <> 'Internal Standard'"""
STEPS["rf_dim"] = """
SELECT DISTINCT r.*, m.rf_max, m.rf_min, m.rf_max / nullif(m.rf_min, 0) AS rf_diff
FROM rf r JOIN (SELECT metabolite_name, max(rf) AS rf_max, min(rf) AS rf_min FROM rf
  WHERE standard_type = 'Standards_Water' GROUP BY metabolite_name) m ON m.metabolite_name = r.metabolite_name
WHERE r.standard_type = 'Standards_Water'"""
STEPS["ratio"] = """
SELECT metabolite_name, (
    max(CASE WHEN standard_type = 'Standards_Matrix' THEN m END) - max(CASE WHEN standard_type = 'Water_Matrix' THEN m END)
  ) / nullif(max(CASE WHEN standard_type = 'Standards_Water' THEN m END), 0) AS rf_ratio
FROM (
  SELECT DISTINCT r.replicate_name, r.metabolite_name, r.standard_type, a.m FROM rf r JOIN (
    SELECT metabolite_name, standard_type, avg(rf) AS m FROM rf GROUP BY metabolite_name, standard_type) a
    ON a.metabolite_name = r.metabolite_name AND a.standard_type = r.standard_type
  WHERE a.m IS NOT NULL) t
GROUP BY metabolite_name HAVING count(*) >= 3"""
STEPS["quant"] = """
SELECT DISTINCT *, adjusted_area / nullif(rf_ave, 0) / nullif(rf_ratio, 0) AS umol_in_vial_ave,
  adjusted_area / nullif(rf_min, 0) / nullif(rf_ratio, 0) AS umol_in_vial_max,
  adjusted_area / nullif(rf_max, 0) / nullif(rf_ratio, 0) AS umol_in_vial_min
FROM (
  SELECT n.mass_feature AS metabolite_name, n.final_bmis, n.run_date, n.type, n.samp_id, n.replicate,
    concat_ws('_', n.run_date, n.type, n.samp_id, n.replicate) AS replicate_name, n.adjusted_area, n.area_with_qc,
    r.rf_ratio, d.rf_max, d.rf_min, (d.rf_min + d.rf_max) / 2 AS rf_ave
  FROM norm n JOIN ratio r ON r.metabolite_name = n.mass_feature
    LEFT JOIN (SELECT DISTINCT metabolite_name, rf_max, rf_min FROM rf_dim) d ON d.metabolite_name = n.mass_feature) t"""
STEPS["pairs"] = """
SELECT p.final_bmis, p.metabolite_name, k.concentration_um
FROM (SELECT DISTINCT final_bmis, metabolite_name FROM quant) p
  LEFT JOIN known k ON k.metabolite_name = p.final_bmis
WHERE contains(p.final_bmis, p.metabolite_name)"""
STEPS["is_rows"] = """
SELECT DISTINCT q.replicate_name, q.metabolite_name, q.area_with_qc, i.concentration_um,
  contains(q.metabolite_name, ',') AS labelled, split_part(q.metabolite_name, ',', 1) AS core
FROM qc q LEFT JOIN (
  SELECT DISTINCT p.metabolite_name, p.concentration_um FROM pairs p
  WHERE p.final_bmis IN (SELECT metabolite_name FROM std_rows)) i ON i.metabolite_name = q.metabolite_name
WHERE NOT contains(q.replicate_name, 'Std')
  AND q.metabolite_name IN (SELECT metabolite_name FROM pairs UNION SELECT final_bmis FROM pairs)"""
STEPS["by_is"] = """
SELECT s.replicate_name, s.metabolite_name, s.area_with_qc, s.concentration_um,
  s.area_with_qc / nullif(i.area_with_qc, 0) * (s.concentration_um / 1000) AS umol_in_vial_is
FROM is_rows s LEFT JOIN is_rows i ON i.labelled AND i.replicate_name = s.replicate_name AND i.core = s.core
WHERE NOT s.labelled"""
STEPS["merged"] = """
SELECT q.metabolite_name, q.samp_id, q.replicate_name, q.adjusted_area, q.area_with_qc, q.rf_ratio, q.rf_max,
  q.rf_min, q.rf_ave, coalesce(i.umol_in_vial_is, q.umol_in_vial_ave) AS umol_in_vial_ave,
  CASE WHEN i.umol_in_vial_is IS NULL THEN q.umol_in_vial_max END AS umol_in_vial_max,
  CASE WHEN i.umol_in_vial_is IS NULL THEN q.umol_in_vial_min END AS umol_in_vial_min, i.umol_in_vial_is
FROM quant q LEFT JOIN by_is i ON i.replicate_name = q.replicate_name AND i.metabolite_name = q.metabolite_name"""
STEPS["enviro"] = """
SELECT DISTINCT m.*, m.umol_in_vial_ave * 1e-6 * 400 / 5 * 1000 * 2 AS nmol_in_enviro_ave, f.empirical_formula
FROM merged m LEFT JOIN (SELECT DISTINCT metabolite_name, empirical_formula FROM std_rows) f
  ON f.metabolite_name = m.metabolite_name"""
ATOMS = r"""
  coalesce(nullif(regexp_extract(empirical_formula, '^C(\d\d)', 1), ''),
    nullif(regexp_extract(empirical_formula, '^C(\d)', 1), ''))::DOUBLE AS c,
  CASE WHEN regexp_matches(empirical_formula, 'N\D') THEN 1
       ELSE nullif(regexp_extract(empirical_formula, 'N(\d)', 1), '')::DOUBLE END AS n"""
STEPS["molecules"] = f"""
SELECT *, nmol_in_enviro_ave * c AS nmol_c_ave, nmol_in_enviro_ave * n AS nmol_n_ave
FROM (SELECT *, {ATOMS} FROM enviro) t"""
STEPS["totals"] = """
SELECT samp_id, coalesce(sum(nmol_c_ave), 0) AS total_c_measured_nm_per_id,
  coalesce(sum(nmol_n_ave), 0) AS total_n_measured_nm_per_id FROM molecules GROUP BY samp_id"""
STEPS["fractions"] = """
SELECT m.*, t.total_c_measured_nm_per_id, t.total_n_measured_nm_per_id,
  t.total_c_measured_nm_per_id / nullif(t.total_n_measured_nm_per_id, 0) AS ratio_cn,
  m.nmol_c_ave / nullif(t.total_c_measured_nm_per_id, 0) AS mol_fraction_c,
  m.nmol_n_ave / nullif(t.total_n_measured_nm_per_id, 0) AS mol_fraction_n
FROM molecules m LEFT JOIN totals t ON t.samp_id = m.samp_id"""
STEPS["summary"] = "SELECT metabolite_name, " + ", ".join(
    f"{f}({c}) AS {short}_{name}"
    for c, short in (("nmol_in_enviro_ave", "nmol_enviro"), ("nmol_c_ave", "nmol_c"), ("mol_fraction_c", "mol_c_fraction"))
    for name, f in (("med", "median"), ("min", "min"), ("max", "max"))
) + " FROM fractions GROUP BY metabolite_name"

# long exports
CLEAN = ", ".join(
    f"TRY_CAST(CASE WHEN NOT contains({c}, '#N/A') THEN {c} END AS DOUBLE) AS {c}"
    for c in ("retention_time", "area", "background", "height", "mass_error_ppm")
)
STEPS["sk"] = f"""
SELECT s.compound_name AS precursor_ion_name, t.* EXCLUDE (precursor_ion_name)
FROM (SELECT replicate_name, precursor_ion_name, {CLEAN} FROM skyline_raw) t
  LEFT JOIN (SELECT DISTINCT compound_name, compound_name_original FROM standards) s
    ON s.compound_name_original = t.precursor_ion_name"""
STEPS["sk_rt"] = f"""
SELECT precursor_ion_name, coalesce(min(retention_time), {INF}) AS rt_min, coalesce(max(retention_time), -{INF}) AS rt_max
FROM sk WHERE regexp_matches(replicate_name, '(?i)Std') GROUP BY precursor_ion_name"""
STEPS["sk_blank"] = """
SELECT precursor_ion_name, CASE WHEN count(*) = count(area) THEN min(area) END AS blank_min,
  CASE WHEN count(*) = count(area) THEN max(area) END AS blank_max
FROM sk WHERE regexp_matches(replicate_name, '(?i)Blk') GROUP BY precursor_ion_name"""
SK_FLAGS = """
  CASE WHEN area < 1000 THEN NULL ELSE area END AS area_with_qc,
  CASE WHEN retention_time >= rt_max + {flex} OR retention_time <= rt_min - {flex} THEN 'RT.Flag' END AS rt_flag,
  CASE WHEN height < 1000 THEN 'height.min.Flag' END AS height_min_flag,
  CASE WHEN height > 1e8 THEN 'overloaded.Flag' END AS overloaded_flag,
  CASE WHEN area < 1000 THEN 'area.min.Flag' END AS area_min_flag,
  CASE WHEN regexp_matches(replicate_name, '(?i)Smp|Poo') AND area / nullif(background, 0) < 4 THEN 'SN.Flag' END AS sn_flag"""
SK_NAMES = "rt_flag, height_min_flag, overloaded_flag, area_min_flag, sn_flag"


def _skyline_text(flags: str) -> str:
    trimmed = f"regexp_replace(regexp_replace({_na(flags)}, 'NA,|NA', '', 'g'), '^\\s+|\\s+$', '', 'g')"
    return f"nullif(regexp_replace({trimmed}, '^,|,$', '', 'g'), '')"


STEPS["sk_flagged"] = f"""
SELECT sk.*, sk_rt.rt_min, sk_rt.rt_max, {SK_FLAGS.format(flex=40)}
FROM sk LEFT JOIN sk_rt ON sk_rt.precursor_ion_name IS NOT DISTINCT FROM sk.precursor_ion_name"""
STEPS["sk_blank_ok"] = """
SELECT precursor_ion_name, max(area) AS blank_max FROM sk
WHERE regexp_matches(replicate_name, '(?i)Blk') GROUP BY precursor_ion_name"""

# triple-quad
STEPS["listed"] = """
SELECT compound_name, round(daughter, 4) AS daughter, quan_trace <> 'no' AS quan_trace,
  second_trace <> '' AS second_trace FROM transitions"""
STEPS["traced"] = """
SELECT f.*, t.quan_trace, t.second_trace FROM fragments f LEFT JOIN listed t
  ON t.compound_name = f.precursor_ion_name AND t.daughter = round(f.product_mz, 4)"""
for _name, _run in (("frag_std", "Std"), ("frag_smp", "Smp")):
    STEPS[_name] = f"""
SELECT t.*, n.two_fragments, CASE WHEN two_fragments AND quan_trace THEN 0.05 * product_mz END AS qt_five_percent,
  CASE WHEN two_fragments AND quan_trace THEN 0.05 * product_mz END < product_mz AS significant_size
FROM traced t JOIN (
  SELECT precursor_ion_name, count(*) <> 1 AS two_fragments FROM (
    SELECT DISTINCT precursor_ion_name, precursor_mz, product_mz FROM fragments
    WHERE contains(replicate_name, '{_run}')) u GROUP BY precursor_ion_name) n
  ON n.precursor_ion_name = t.precursor_ion_name
WHERE contains(t.replicate_name, '{_run}')"""
STEPS["ir_ref"] = f"""
SELECT precursor_ion_name, coalesce(min(ratio), {INF}) AS ir_min, coalesce(max(ratio), -{INF}) AS ir_max FROM (
  SELECT precursor_ion_name, replicate_name,
    max(CASE WHEN quan_trace THEN area END) / nullif(max(CASE WHEN second_trace THEN area END), 0) AS ratio
  FROM frag_std GROUP BY precursor_ion_name, replicate_name) t GROUP BY precursor_ion_name"""
STEPS["ir_first"] = """
SELECT precursor_ion_name, CASE WHEN bool_or(significant_size) THEN
  arg_min(area, replicate_name) FILTER (WHERE quan_trace)
    / nullif(arg_min(area, replicate_name) FILTER (WHERE second_trace), 0) END AS ir_ratio
FROM frag_smp GROUP BY precursor_ion_name"""
STEPS["ir_each"] = """
SELECT precursor_ion_name, replicate_name,
  max(CASE WHEN quan_trace THEN area END) / nullif(max(CASE WHEN second_trace THEN area END), 0) AS ir_ratio
FROM frag_smp GROUP BY precursor_ion_name, replicate_name"""
IR_FLAG = "CASE WHEN ir_ratio < ir_min - 0.3 OR ir_ratio > ir_max + 0.3 THEN 'IR.Flag' END AS ir_flag"
STEPS["ir_flagged"] = f"""
SELECT s.*, {IR_FLAG} FROM frag_smp s LEFT JOIN ir_first r ON r.precursor_ion_name = s.precursor_ion_name
  LEFT JOIN ir_ref i ON i.precursor_ion_name = s.precursor_ion_name"""
STEPS["ir_flagged_each"] = f"""
SELECT s.*, {IR_FLAG} FROM frag_smp s
  LEFT JOIN ir_each r ON r.precursor_ion_name = s.precursor_ion_name AND r.replicate_name = s.replicate_name
  LEFT JOIN ir_ref i ON i.precursor_ion_name = s.precursor_ion_name"""
STEPS["tq_rt"] = """
SELECT precursor_ion_name, min(retention_time) AS rt_min, max(retention_time) AS rt_max FROM fragments
WHERE regexp_matches(replicate_name, '(?i)Std') GROUP BY precursor_ion_name"""
STEPS["tq_blank"] = """
SELECT precursor_ion_name, max(area) AS blank_max FROM traced
WHERE contains(replicate_name, 'Blk') AND quan_trace GROUP BY precursor_ion_name"""
TQ_FLAGS = SK_FLAGS.format(flex="0.4")
STEPS["tq_flagged"] = f"""
SELECT s.*, {TQ_FLAGS} FROM ir_flagged s LEFT JOIN tq_rt r ON r.precursor_ion_name = s.precursor_ion_name
WHERE quan_trace"""
STEPS["tq_flagged_each"] = f"""
SELECT s.*, {TQ_FLAGS}, CASE WHEN area / nullif(blank_max, 0) < 0.3 THEN 'Blank.Flag' END AS blank_flag
FROM ir_flagged_each s LEFT JOIN tq_rt r ON r.precursor_ion_name = s.precursor_ion_name
  LEFT JOIN tq_blank b ON b.precursor_ion_name = s.precursor_ion_name
WHERE quan_trace"""


def _melted(measure: str) -> str:
    value = f"{measure}_value"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS replicate_name, {c} AS {value}, alignment_id, metabolite_name FROM wide_{measure}"
        for c in ("x170410_Smp_A_1", "x170410_Smp_A_2", "x170410_Poo_B_1", "x170410_Std_C_1")
    )


for _measure in ("area", "mz", "sn", "rt"):
    STEPS[f"long_{_measure}"] = _melted(_measure)

# --- queries ------------------------------------------------------------------------------------------

SQL: dict[str, str] = {}

SQL["run_type"] = "SELECT replicate_name, metabolite_name, run_type FROM pk"
SQL["parse_replicate"] = f"SELECT replicate_name, metabolite_name, {PARTS} FROM peaks"
SQL["fix_replicate_dash"] = """
SELECT regexp_replace(replace(replicate_name, '_', '-'), '-', '.') AS replicate_name, metabolite_name, area_value FROM peaks"""
SQL["formula_atoms"] = f"SELECT compound_name, empirical_formula, {ATOMS} FROM standards"


def _all_atoms(symbol: str) -> str:
    matches = rf"regexp_extract_all(empirical_formula, '{symbol}(\d*)([^a-z0-9]|$)', 1)"
    return f"list_sum([CASE WHEN x = '' THEN 1::DOUBLE ELSE CAST(x AS DOUBLE) END FOR x IN {matches}])"


SQL["formula_atoms_corrected"] = f"""
SELECT compound_name, empirical_formula, coalesce({_all_atoms('C')}, 0) AS c, coalesce({_all_atoms('N')}, 0) AS n FROM standards"""
SQL["trim_names"] = "SELECT compound_name, compound_type, concentration_um FROM standards"
SQL["run_types_present"] = "SELECT DISTINCT run_type FROM pk"
SQL["run_type_filter"] = """
SELECT replicate_name, metabolite_name, area_value FROM peaks WHERE regexp_matches(replicate_name, '(?i)blk|poo')
UNION ALL SELECT replicate_name, metabolite_name, area_value FROM peaks WHERE NOT regexp_matches(replicate_name, 'Smp|Poo|Blk')"""

SQL["wide_header"] = """
SELECT CASE WHEN replicate_name = 'x170410_Smp_A_2' THEN '170410_Smp_A.2' ELSE substr(replicate_name, 2) END AS replicate_name,
  area_value, CAST(alignment_id AS INTEGER) AS alignment_id, metabolite_name FROM long_area WHERE metabolite_name <> 'Unknown'"""
SQL["melt_samples"] = "SELECT * FROM long_area"
SQL["cast_sample_columns"] = "SELECT * FROM wide_area"
SQL["assemble_measures"] = """
SELECT a.replicate_name, a.area_value, m.mz_value, r.rt_value, s.sn_value, a.alignment_id, a.metabolite_name
FROM long_area a
  LEFT JOIN long_mz m USING (replicate_name, alignment_id, metabolite_name)
  LEFT JOIN long_sn s USING (replicate_name, alignment_id, metabolite_name)
  LEFT JOIN long_rt r USING (replicate_name, alignment_id, metabolite_name)"""
SQL["standardize_names"] = """
SELECT substr(replicate_name, 2) AS replicate_name, area_value, alignment_id,
  CASE WHEN contains(metabolite_name, 'Lab_') THEN split_part(metabolite_name, '_', 2) ELSE metabolite_name END AS metabolite_name
FROM long_area WHERE metabolite_name <> 'Unknown'"""
SQL["update_compound_names"] = """
SELECT DISTINCT coalesce(s.compound_name, p.old) AS metabolite_name, p.replicate_name, p.area_value
FROM (SELECT *, 'Old_' || CAST(compound_id AS VARCHAR) AS old FROM peaks) p
  LEFT JOIN (SELECT DISTINCT compound_name, compound_name_original FROM standards WHERE concentration_um IS NOT NULL) s
  ON s.compound_name_original = p.old"""
SQL["union_modes"] = """
SELECT replicate_name, metabolite_name, ion_column, CASE WHEN ion_column = 'HILICPos' THEN area_value END AS area_value
FROM peaks_modes"""

SQL["rt_reference"] = "SELECT *, abs(rt_max - rt_min) AS rt_diff FROM rt_ref"
SQL["blank_reference"] = "SELECT * FROM blank_ref"
SQL["sn_area_flags"] = f"SELECT {PEAK}, run_type, sn_flag, area_min_flag FROM flagged"
SQL["rt_flags"] = f"SELECT {PEAK}, rt_flag FROM flagged"
SQL["blank_flags"] = f"SELECT {PEAK}, blank_flag FROM flagged"
SQL["msdial_qc"] = "SELECT * FROM qc"
SQL["msdial_qc_corrected"] = f"""
SELECT *, nullif(concat_ws(', ', {FLAG_NAMES}), '') AS all_flags FROM (
  SELECT pk.*, {MSDIAL_FLAGS}
  FROM pk LEFT JOIN (SELECT metabolite_name, min(nullif(rt_value, 0)) AS rt_min, max(nullif(rt_value, 0)) AS rt_max
      FROM pk WHERE run_type = 'std' GROUP BY metabolite_name) r ON r.metabolite_name = pk.metabolite_name
    LEFT JOIN (SELECT metabolite_name, max(area_value) AS blk_max
      FROM pk WHERE run_type = 'blk' GROUP BY metabolite_name) b ON b.metabolite_name = pk.metabolite_name) t"""
SQL["qc_parameter_report"] = """
SELECT * FROM (VALUES ('2017-04-10', NULL), ('Hello! Welcome to the world of MSDIAL QE Quality Control! ', NULL),
  ('Minimum area for a real peak: ', '1000'), ('RT flexibility: ', '0.4'),
  ('Blank can be this fraction of a sample: ', '0.3'), ('S/N ratio: ', '4')) v(description, value)
UNION ALL BY NAME SELECT * FROM qc"""

SQL["null_markers"] = "SELECT " + ", ".join(
    f"CASE WHEN NOT contains({c}, '#N/A') THEN {c} END AS {c}"
    for c in ("replicate_name", "precursor_ion_name", "retention_time", "area", "background", "height", "mass_error_ppm")
) + " FROM skyline_raw"
SQL["cast_numeric_columns"] = f"SELECT replicate_name, precursor_ion_name, {CLEAN} FROM skyline_raw"
SQL["standard_mix_filter"] = """
SELECT sk.* FROM sk LEFT JOIN (SELECT DISTINCT compound_name, hilic_mix FROM standards) s
  ON s.compound_name = sk.precursor_ion_name
WHERE contains(replicate_name, 'Std')
  AND (contains(replicate_name, hilic_mix) OR regexp_matches(replicate_name, '(?i)H2OinMatrix'))"""
SQL["skyline_rt_reference"] = "SELECT * FROM sk_rt"
SQL["skyline_blank_reference"] = "SELECT * FROM sk_blank"
SMP_POO = "WHERE regexp_matches(replicate_name, '(?i)Smp|Poo')"
SQL["height_table"] = f"SELECT replicate_name, precursor_ion_name, height FROM sk {SMP_POO}"
SQL["area_table"] = f"SELECT replicate_name, precursor_ion_name, area FROM sk {SMP_POO}"
SQL["signal_to_noise"] = f"""
SELECT replicate_name, precursor_ion_name, area, background, area / nullif(background, 0) AS signal_to_noise FROM sk {SMP_POO}"""
SQL["skyline_qc"] = f"SELECT *, {_skyline_text(SK_NAMES)} AS all_flags FROM sk_flagged"
SQL["skyline_qc_corrected"] = f"""
SELECT *, nullif(concat_ws(', ', {SK_NAMES}, blank_flag), '') AS all_flags FROM (
  SELECT f.*, CASE WHEN area / nullif(blank_max, 0) < 0.3 THEN 'Blank.Flag' END AS blank_flag
  FROM sk_flagged f LEFT JOIN sk_blank_ok b ON b.precursor_ion_name IS NOT DISTINCT FROM f.precursor_ion_name) t"""

FRAGMENT = """replicate_name, precursor_ion_name, precursor_mz, product_mz, area, two_fragments, quan_trace,
  second_trace"""
SQL["attach_transitions"] = "SELECT * FROM traced"
SQL["check_fragments"] = f"SELECT {FRAGMENT}, qt_five_percent, significant_size FROM frag_smp"
SQL["check_fragments_corrected"] = f"""
SELECT {FRAGMENT}, CASE WHEN two_fragments AND quan_trace THEN 0.05 * qa END AS qt_five_percent,
  CASE WHEN two_fragments AND quan_trace THEN 0.05 * qa END < sa AS significant_size FROM (
  SELECT f.*, p.qa, p.sa FROM frag_smp f JOIN (
    SELECT replicate_name AS r, precursor_ion_name AS c, max(CASE WHEN quan_trace THEN area END) AS qa,
      max(CASE WHEN second_trace THEN area END) AS sa
    FROM frag_smp GROUP BY 1, 2) p ON p.r = f.replicate_name AND p.c = f.precursor_ion_name) t"""
SQL["assert_two_fragments"] = "SELECT DISTINCT precursor_ion_name FROM frag_std WHERE NOT two_fragments"
SQL["single_fragments"] = """
SELECT precursor_ion_name FROM fragments
WHERE contains(replicate_name, 'Std') AND NOT (product_mz >= 70 AND regexp_matches(precursor_ion_name, '[37]$'))
GROUP BY precursor_ion_name HAVING count(DISTINCT product_mz) = 1"""
SQL["transitions_within_tolerance"] = """
SELECT f.*, t.quan_trace <> 'no' AS quan_trace, t.second_trace <> '' AS second_trace FROM (
  SELECT * REPLACE (product_mz + ((length(replicate_name) * 7 + CAST(precursor_mz AS INT)) % 9 - 4) * CAST(0.03 AS DOUBLE) AS product_mz)
  FROM fragments) f LEFT JOIN transitions t
  ON t.compound_name = f.precursor_ion_name AND abs(f.product_mz - t.daughter) <= 0.1"""
SQL["ion_ratio_reference"] = "SELECT * FROM ir_ref"
SQL["ion_ratio_flags"] = f"SELECT {FRAGMENT}, retention_time, background, height, ir_flag FROM ir_flagged"
SQL["tqs_blank_reference"] = "SELECT * FROM tq_blank"
TQ = "replicate_name, precursor_ion_name, precursor_mz, product_mz, area, retention_time, background, height"
SQL["tqs_qc"] = f"SELECT {TQ}, {_skyline_text('ir_flag, ' + SK_NAMES)} AS all_flags FROM tq_flagged"
SQL["tqs_qc_corrected"] = f"""
SELECT {TQ}, area_with_qc, ir_flag, {SK_NAMES}, blank_flag,
  nullif(concat_ws(', ', ir_flag, {SK_NAMES}, blank_flag), '') AS all_flags FROM tq_flagged_each"""

SQL["ion_ratio_table"] = "SELECT * FROM ir_ref"
SQL["tqs_report"] = f"""
SELECT * FROM (VALUES ('2017-04-10', NULL), ('Hello! Welcome to the world of Skyline TQS Quality Control! ', NULL),
  ('Maximum height for a real peak: ', '1e+08'), ('Minimum height for a real peak: ', '1000'),
  ('Maximum area for a real peak: ', '1000'), ('RT flexibility: ', '0.4'),
  ('Blank can be this fraction of a sample: ', '0.3'), ('S/N ratio: ', '4'), ('Ion ratio flexibility', '0.3'),
  ('Processed on: ', '2017-04-11')) v(description, value)
UNION ALL BY NAME ({SQL["tqs_qc"]})"""
SQL["combined_peaks"] = "SELECT * FROM sk"
SQL["reverse_phase_export"] = f"""
SELECT replicate_name, precursor_ion_name, {CLEAN}, 'P' || mass_error_ppm AS protein_name,
  CASE WHEN CAST(mass_error_ppm AS INT) > 3 THEN background END AS total_area_fragment FROM skyline_raw"""

SQL["mode_duplicates"] = "SELECT * FROM dup"
SQL["mode_duplicate_stats"] = f"""
SELECT metabolite_name, ion_column, {cuts("means", "std_devs")} FROM (
  SELECT metabolite_name, ion_column, avg(a) AS means, stddev_samp(a) AS std_devs FROM (
    SELECT *, CASE WHEN area_value < 1000 THEN NULL ELSE area_value END AS a FROM bm2
    WHERE metabolite_name IN (SELECT metabolite_name FROM dup)) t GROUP BY metabolite_name, ion_column) u"""
SQL["drop_mode_duplicates"] = f"SELECT ion_column, {PEAK} FROM qc2"

SQL["dimension_by_header"] = """
SELECT compound_name, compound_name_original, compound_type, column_type, concentration_um, hilic_mix, empirical_formula FROM standards"""

SQL["long_two_headers"] = """
SELECT replicate_name, precursor_ion_name, CASE WHEN retention_time <> '#N/A' THEN CAST(retention_time AS DOUBLE) END AS retention_time,
  CASE WHEN area <> '#N/A' THEN CAST(area AS DOUBLE) END AS area, CAST(background AS DOUBLE) AS background,
  CASE WHEN height <> '#N/A' THEN CAST(height AS DOUBLE) END AS height, CAST(mass_error_ppm AS DOUBLE) AS mass_error_ppm FROM skyline_raw"""

SQL["internal_standards"] = "SELECT * FROM is_dim"
SQL["semi_internal_standards"] = f"SELECT {PEAK} FROM peaks WHERE metabolite_name IN (SELECT compound_name FROM is_dim)"
SQL["anti_internal_standards"] = f"SELECT {PEAK} FROM peaks WHERE metabolite_name NOT IN (SELECT compound_name FROM is_dim)"
SQL["bmis_input"] = "SELECT * FROM bm"
SQL["injection_volume"] = """
SELECT replicate_name, mass_feature, area_with_qc, count(*) AS weight FROM inj GROUP BY ALL"""
SQL["is_raw_areas"] = f"""
SELECT replicate_name, {PARTS}, mass_feature, area_with_qc FROM (SELECT * FROM int_one) t"""
SQL["is_issues"] = SQL["is_raw_areas"] + " WHERE area_with_qc IS NULL"
SQL["is_means"] = f"SELECT mass_feature, {cuts("average_area")} FROM means"
SQL["assert_same_replicates"] = """
SELECT replicate_name, 'left' AS only_in FROM (
  SELECT replicate_name FROM int_is EXCEPT SELECT replicate_name FROM bm WHERE metabolite_name NOT IN (SELECT compound_name FROM is_dim)) a
UNION ALL SELECT replicate_name, 'right' FROM (
  SELECT replicate_name FROM bm WHERE metabolite_name NOT IN (SELECT compound_name FROM is_dim) EXCEPT SELECT replicate_name FROM int_is) b"""
_LEFT = "SELECT replicate_name FROM int_is WHERE NOT ends_with(split_part(replicate_name, '_', 3), '3')"
_RIGHT = """SELECT replicate_name FROM bm WHERE metabolite_name NOT IN (SELECT compound_name FROM is_dim)
  AND NOT ends_with(split_part(replicate_name, '_', 3), '7')"""
SQL["replicate_mismatch"] = f"""
SELECT replicate_name, 'left' AS only_in FROM ({_LEFT} EXCEPT {_RIGHT}) a
UNION ALL SELECT replicate_name, 'right' FROM ({_RIGHT} EXCEPT {_LEFT}) b"""
SQL["bmis_candidates"] = f"""
SELECT replicate_name, mass_feature, mis, area_with_qc, {cuts("adjusted_area")}, weight FROM (
  SELECT *, count(*) AS weight FROM cand GROUP BY ALL) t"""
SQL["rsd_by_group"] = f"""
SELECT metabolite_name, type, {cuts("rsd")} FROM (
  SELECT metabolite_name, split_part(replicate_name, '_', 2) AS type,
    stddev_samp(area_with_qc) / nullif(avg(area_with_qc), 0) AS rsd FROM bm GROUP BY 1, 2) t"""
SQL["pooled_rsd"] = f"SELECT mass_feature, mis, {cuts("rsd_of_poo")} FROM poo"
SQL["pooled_rsd_corrected"] = f"SELECT mass_feature, mis, {cuts("rsd_of_poo")} FROM poo_one"
SQL["bmis_pick"] = f"""
SELECT mass_feature, mis, poo_picked_is, accept_mis, {cuts("rsd_of_poo", "orig_rsd", "del_rsd", "percent_change")} FROM pick"""
SQL["bmis_final"] = f"""
SELECT mass_feature, poo_picked_is, accept_mis, final_bmis,
  {cuts("orig_rsd", "del_rsd", "percent_change", "final_rsd")} FROM final"""
SQL["is_to_is_rsd"] = f"""
SELECT s.mass_feature, s.mis, {cuts("rsd_of_smp")}, {cut('p.rsd_of_poo')}, p.accept_mis FROM (
  SELECT mass_feature, mis, {RSD} AS rsd_of_smp FROM cand
  WHERE split_part(replicate_name, '_', 2) = 'Smp' AND mass_feature IN (SELECT mass_feature FROM int_std)
  GROUP BY mass_feature, mis) s LEFT JOIN pick p ON p.mass_feature = s.mass_feature AND p.mis = s.mis"""
SQL["bmis_quick_report"] = f"""
SELECT {cut("avg(CASE WHEN final_bmis <> 'Inj_vol' THEN 1.0 ELSE 0.0 END)", 'share_picked')},
  0.4::DOUBLE AS cut_off, 0.1::DOUBLE AS cut_off2 FROM final"""
SQL["bmis_normalize"] = f"""
SELECT * REPLACE ({cuts("orig_rsd", "final_rsd", "adjusted_area")}) FROM norm"""

SQL["standard_rows"] = "SELECT * FROM std_rows"
SQL["standard_run_types"] = """
SELECT replicate_name, metabolite_name,
  CASE WHEN regexp_matches(replicate_name, 'StdsMix|InH2O') THEN 'Standards' ELSE 'Water' END || '_' ||
    CASE WHEN contains(replicate_name, 'InMatrix') THEN 'Matrix' ELSE 'Water' END AS mix_type,
  CASE WHEN contains(replicate_name, 'Stds') THEN 'Standards' ELSE 'Water' END || '_' ||
    CASE WHEN contains(replicate_name, 'Matrix') THEN 'Matrix' ELSE 'Water' END AS standard_type
FROM peaks WHERE contains(replicate_name, 'Std')"""
SQL["response_factors"] = "SELECT * FROM rf"
SQL["response_factors_own_mix"] = """
SELECT *, 'HILICPos' AS ion_column FROM rf
WHERE contains(replicate_name, hilic_mix) OR contains(replicate_name, 'H2OInMatrix')"""
SQL["rf_dimensions"] = "SELECT * FROM rf_dim"
SQL["missing_rf"] = "SELECT DISTINCT metabolite_name FROM rf_dim WHERE rf IS NULL"
SQL["rf_ratios"] = f"SELECT metabolite_name, {cuts("rf_ratio")} FROM ratio"

UMOL = ("adjusted_area", "rf_ratio", "umol_in_vial_ave", "umol_in_vial_max", "umol_in_vial_min")
AMOUNTS = (*UMOL, "umol_in_vial_is", "nmol_in_enviro_ave")
MOLECULES = (*AMOUNTS, "nmol_c_ave", "nmol_n_ave")
TOTALS = ("total_c_measured_nm_per_id", "total_n_measured_nm_per_id")
SUMMARY = tuple(f"{short}_{name}" for short in ("nmol_enviro", "nmol_c", "mol_c_fraction") for name in ("med", "min", "max"))
SQL["quantify_response_factor"] = f"SELECT * REPLACE ({cuts(*UMOL)}) FROM quant"
SQL["is_name_pairs"] = "SELECT * FROM pairs"
SQL["quantify_internal_standard"] = f"SELECT * REPLACE ({cuts("umol_in_vial_is")}) FROM by_is"
SQL["quantify_merge"] = f"SELECT * REPLACE ({cuts(*UMOL, "umol_in_vial_is")}) FROM merged"
SQL["environmental_nmol"] = f"SELECT * REPLACE ({cuts(*AMOUNTS)}) FROM enviro"
SQL["carbon_nitrogen"] = f"SELECT * REPLACE ({cuts(*MOLECULES)}) FROM molecules"
SQL["totals_per_sample"] = f"SELECT samp_id, {cuts(*TOTALS)} FROM totals"
SQL["mole_fractions"] = f"""
SELECT * EXCLUDE (samp_id) REPLACE ({cuts(*MOLECULES, *TOTALS, "ratio_cn", "mol_fraction_c", "mol_fraction_n")})
FROM fractions"""
SQL["compound_summary"] = f"SELECT metabolite_name, {cuts(*SUMMARY)} FROM summary ORDER BY metabolite_name DESC"

#: In the two-mode analysis the same steps run on other peaks, standard rows come from the table before
#: duplicates go, and response factors on own mixes only.
TWO_MODES = {
    "qc": STEPS["qc2"],
    "qc_all": "SELECT pk2.*, CASE WHEN area_value < 1000 THEN NULL ELSE area_value END AS area_with_qc FROM pk2",
    "std_rows": STEPS["std_rows"].replace("FROM qc q", "FROM qc_all q"),
    "rf": STEPS["rf"] + " AND (contains(substr(replicate_name, 1, length(replicate_name) - 2), hilic_mix)"
                        " OR contains(replicate_name, 'H2OInMatrix'))",
}


OWN_MIX = """
SELECT s.* FROM {table} s LEFT JOIN (SELECT DISTINCT compound_name, hilic_mix FROM standards) m
  ON m.compound_name IS NOT DISTINCT FROM s.precursor_ion_name
WHERE {other} (contains(replicate_name, 'Std')
  AND (contains(replicate_name, hilic_mix) OR regexp_matches(replicate_name, '(?i)H2OinMatrix')))"""
#: The analysis of long exports: own mixes, then the flagged table under the names of the peak table.
LONG = {
    "sk_all": STEPS["sk"],
    "sk": OWN_MIX.format(table="sk_all", other="NOT contains(replicate_name, 'Std') OR"),
    "qc": f"SELECT replicate_name, precursor_ion_name AS metabolite_name, area AS area_value, area_with_qc, {TOKEN} AS run_type FROM sk_flagged",
}
SQL["keep_own_mixes"] = OWN_MIX.format(table="sk", other="")
SQL["keep_own_mixes_corrected"] = OWN_MIX.format(table="sk", other="NOT contains(replicate_name, 'Std') OR")


def with_steps(sql: str, steps: dict[str, str]) -> str:
    """Put the steps a statement needs in front of it, as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in sorted(set(re.findall(r"(?:FROM|JOIN)\s+(\w+)", text))):
            if word in steps and word not in needed:
                visit(steps[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    listed = ",\n".join(f"{name} AS ({steps[name].strip()})" for name in needed)
    return f"WITH {listed}\n{sql.strip()}"


def oracle_sql() -> dict[str, str]:
    texts = {name: with_steps(sql, STEPS) for name, sql in SQL.items()}
    texts["analyse_two_modes"] = with_steps(SQL["compound_summary"], {**STEPS, **TWO_MODES})
    texts["analyse_long"] = with_steps(SQL["compound_summary"], {**STEPS, **LONG})
    odd = {**STEPS, "peaks": VIEWS["odd_peaks"]}
    for name in ("bmis_candidates", "bmis_normalize"):
        texts[f"{name}_odd"] = with_steps(SQL[name], odd)
    return texts
