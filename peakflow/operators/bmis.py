"""Best-matched internal standard: choose, for every compound, the internal standard that best
reduces the spread of pooled replicates, and normalise the areas by it.

The published calculation repeats the injection-volume row once per quality-controlled row of a
replicate. Here that repetition is a frequency weight, so nothing is multiplied."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peakflow.functions.columns import (
    fix_replicate_dash, is_blank_or_standard, parse_replicate, replicate_part, safe_div, trim_whitespace,
)
from peakflow.functions.joins import missing_of, null_safe_join, sized
from peakflow.functions.stats import weighted_rsd
from peakflow.params import INJECTION_VOLUME, REFERENCE, BmisParams, is_corrected
from peakflow.sources.staging import stage

#: Decimals of a relative standard deviation that decide a tie; the rest is rounding noise.
RSD_DECIMALS = 12

_AREA = ["replicate_name", "mass_feature", "area_with_qc", "weight"]


def internal_standards(
    standards: DataFrame, column_type: str | None = None, mode: str = REFERENCE
) -> DataFrame:
    """Internal standards of the dimension, names trimmed. Corrected: of one column type only."""
    kept = F.col("column_type").isNotNull()
    if is_corrected(mode) and column_type is not None:
        kept = F.col("column_type") == column_type
    return standards.filter(kept & (F.col("compound_type") == "Internal Standard")).withColumn(
        "compound_name", trim_whitespace("compound_name")
    )


def bmis_input(qc: DataFrame) -> DataFrame:
    """Quality-controlled rows of samples and pools, with the first dash of a replicate name fixed."""
    return qc.filter(~is_blank_or_standard("replicate_name")).withColumn(
        "replicate_name", fix_replicate_dash("replicate_name")
    )


def _standard_names(standards: DataFrame) -> DataFrame:
    return sized(standards.select(F.col("compound_name").alias("metabolite_name")).distinct())


def _with_standard_flag(data: DataFrame, standards: DataFrame) -> DataFrame:
    flagged = _standard_names(standards).withColumn("_is_standard", F.lit(True))
    return null_safe_join(data, flagged, ["metabolite_name"])


def semi_internal_standards(data: DataFrame, standards: DataFrame) -> DataFrame:
    """Rows of internal standards."""
    return null_safe_join(data, _standard_names(standards), ["metabolite_name"], "left_semi")


def anti_internal_standards(data: DataFrame, standards: DataFrame) -> DataFrame:
    """Rows of everything else."""
    return null_safe_join(data, _standard_names(standards), ["metabolite_name"], "left_anti")


def _volume():
    """Relative injection volume of a replicate."""
    return F.when(F.col("replicate_name").contains("Half"), F.lit(0.5)).otherwise(F.lit(1.0))


def injection_volume(data: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """One pseudo-standard row per replicate: 0.5 for half injections, else 1.

    Its weight is the number of rows of the replicate (corrected: 1)."""
    weight = F.lit(1).cast("bigint") if is_corrected(mode) else F.col("_rows")
    return data.groupBy("replicate_name").agg(F.count(F.lit(1)).alias("_rows")).select(
        "replicate_name",
        F.lit(INJECTION_VOLUME).alias("mass_feature"),
        _volume().alias("area_with_qc"),
        weight.alias("weight"),
    )


def _features(data: DataFrame) -> DataFrame:
    return data.select(
        "replicate_name", F.col("metabolite_name").alias("mass_feature"), "area_with_qc",
        F.lit(1).cast("bigint").alias("weight"),
    )


def standard_areas(data: DataFrame, standards: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Areas of the internal standards and of the injection-volume pseudo-standard."""
    return _features(semi_internal_standards(data, standards)).unionByName(injection_volume(data, mode))


def is_raw_areas(data: DataFrame, standards: DataFrame) -> DataFrame:
    areas = standard_areas(data, standards)
    return areas.select(
        "replicate_name", *[c.alias(n) for n, c in parse_replicate("replicate_name").items()],
        "mass_feature", "area_with_qc",
    )


def is_issues(data: DataFrame, standards: DataFrame) -> DataFrame:
    """Internal standards without an area."""
    return is_raw_areas(data, standards).filter(F.col("area_with_qc").isNull())


def assert_same_replicates(left: DataFrame, right: DataFrame, strict: bool = False) -> DataFrame:
    """Replicates only one of the two tables has; `strict` raises when there are any."""
    sides = left.select("replicate_name", F.lit("left").alias("only_in")).unionByName(
        right.select("replicate_name", F.lit("right").alias("only_in"))
    )
    offenders = (
        sides.groupBy("replicate_name")
        .agg(F.min("only_in").alias("only_in"), F.max("only_in").alias("_other"))
        .filter(F.col("only_in") == F.col("_other")).drop("_other")
    )
    if strict and not offenders.isEmpty():
        raise ValueError("replicate names are not matched across the two tables")
    return offenders


def unmatched_replicates(data: DataFrame, standards: DataFrame) -> DataFrame:
    """Replicates that have internal standards only or none, from one pass: replicate_name, only_in."""
    own = F.coalesce("_is_standard", F.lit(False))
    return (
        _with_standard_flag(data.select("replicate_name", "metabolite_name"), standards).groupBy("replicate_name")
        .agg(F.bool_or(own).alias("_standards"), F.bool_or(~own).alias("_others"))
        .filter(F.col("_standards") != F.col("_others"))
        .select("replicate_name", F.when(F.col("_standards"), "left").otherwise("right").alias("only_in"))
    )


def require_same_replicates(data: DataFrame, standards: DataFrame) -> None:
    """Raise when internal standards and everything else do not stand in the same replicates."""
    first = unmatched_replicates(data, standards).first()
    if first:
        raise ValueError(f"replicate names are not matched across the two tables: {first.replicate_name}")


def is_means(data: DataFrame, standards: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Mean area of every internal standard over all runs.

    Reference: the pseudo-standard counts once per row of a replicate, so its mean is that of the
    rows and one pass over the table gives all means. No row is doubled for it: sums of volumes are taken
    beside those of areas, and only these few sums are told apart."""
    if is_corrected(mode):
        areas = standard_areas(data, standards, mode)
        return areas.groupBy("mass_feature").agg(F.avg("area_with_qc").alias("average_area"))
    rows = _with_standard_flag(data, standards)
    own = F.coalesce("_is_standard", F.lit(False))
    sums = rows.groupBy(own.alias("_own"), F.when(own, F.col("metabolite_name")).alias("_name")).agg(
        F.sum("area_with_qc").alias("_area"), F.count("area_with_qc").alias("_n"),
        F.sum(_volume()).alias("_volume"), F.count(F.lit(1)).alias("_rows"),
    )
    standard = F.when(F.col("_own"), F.struct(F.col("_name").alias("name"), F.col("_area").alias("sum"), F.col("_n").alias("n")))
    volume = F.struct(F.lit(INJECTION_VOLUME).alias("name"), F.col("_volume").alias("sum"), F.col("_rows").alias("n"))
    each = sums.select(F.explode(F.array(standard, volume)).alias("_a")).filter(F.col("_a").isNotNull())
    return each.groupBy(F.col("_a.name").alias("mass_feature")).agg(
        safe_div(F.sum("_a.sum"), F.sum("_a.n")).alias("average_area"))


def is_pool(replicate: str = "replicate_name"):
    return replicate_part(replicate, 1) == "Poo"


def is_sample(replicate: str = "replicate_name"):
    return replicate_part(replicate, 1) == "Smp"


def bmis_candidates(data: DataFrame, standards: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """Every feature row normalised by every internal standard of its replicate.

    Features include the internal standards and the pseudo-standard themselves. A standard a replicate
    lacks gives a row with a missing adjusted area. This is the full table the calculation is defined
    on, as a result of its own; choosing and normalising work without it."""
    areas = standard_areas(data, standards, mode)
    means = sized(is_means(data, standards, mode)).withColumnRenamed("mass_feature", "mis")
    rows = _features(data).unionByName(injection_volume(data, mode))
    found = areas.select(
        "replicate_name", F.col("mass_feature").alias("mis"), F.col("area_with_qc").alias("_is_area"),
        F.col("weight").alias("_is_weight"),
    )
    lacking = missing_of(found.where(F.col("replicate_name").isNotNull()), ["replicate_name"], "mis", means).withColumns(
        {"_is_area": F.lit(None).cast("double"), "_is_weight": F.lit(1).cast("bigint")}
    )
    pairs = rows.join(found, "replicate_name").unionByName(rows.join(lacking, "replicate_name"))
    return pairs.join(means, "mis").select(
        "replicate_name", "mass_feature", "mis", "area_with_qc",
        (safe_div("area_with_qc", "_is_area") * F.col("average_area")).alias("adjusted_area"),
        (F.col("weight") * F.col("_is_weight")).alias("weight"),
    )


def candidate_moments(
    data: DataFrame, standards: DataFrame, mode: str = REFERENCE, runs=None, standards_only: bool = False
) -> DataFrame:
    """Moments of the candidates per (replicate, feature, standard), without building the candidates.

    Within a replicate every value of a feature meets every value of a standard, so mean and variance
    of the quotients follow from those of the areas and of the inverse standard areas. One pass reduces
    the rows to moments per (replicate, feature), so repeated rows never multiply. Moments of
    features and of standards are two narrow tables that meet on their replicate; a replicate of very many compounds
    is split by adaptive execution, and nothing of it is gathered. The mean area of a
    standard cancels in a relative deviation and is left out.

    `rows` counts table rows. A feature row also counts for standards its replicate lacks: the rows
    with mis NULL carry these base counts, all others only what they add to them. `runs` restricts
    the replicates, `standards_only` the features."""
    if runs is not None:
        data = data.filter(runs)
    area = F.col("area_with_qc")
    inverse = safe_div(F.lit(1.0), area)
    compounds = data.groupBy("replicate_name", "metabolite_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count(area).alias("n"), F.avg(area).alias("mean"),
        F.var_pop(area).alias("var"), F.count(inverse).alias("inv_n"), F.avg(inverse).alias("inv_mean"),
        F.var_pop(inverse).alias("inv_var"),
    )
    compounds = stage(_with_standard_flag(compounds, standards), "moments")
    is_standard = F.coalesce("_is_standard", F.lit(False))
    volumes = compounds.groupBy("replicate_name").agg(F.sum("rows").alias("_k"))
    k = F.lit(1).cast("bigint") if is_corrected(mode) else F.col("_k")

    def entries(own, n, mean, var, volume):
        """Moments of compounds, and of the injection volume of every replicate."""
        cells = own.select("replicate_name", F.col("metabolite_name").alias("name"), "rows", F.col(n).alias("n"), F.col(mean).alias("mean"), F.col(var).alias("var"))
        return cells.unionByName(volumes.select(
            "replicate_name", F.lit(INJECTION_VOLUME).alias("name"), k.alias("rows"), k.alias("n"), volume.alias("mean"), F.lit(0.0).alias("var")
        ))

    own_standards = compounds.filter(is_standard)
    features = entries(own_standards if standards_only else compounds, "n", "mean", "var", _volume())
    divisors = entries(own_standards, "inv_n", "inv_mean", "inv_var", 1.0 / _volume()).select(
        "replicate_name", F.col("name").alias("mis"), *[F.col(c).alias(f"d_{c}") for c in ("rows", "n", "mean", "var")]
    )
    nothing = F.lit(None).cast("double")
    base = features.select(
        "replicate_name", F.col("name").alias("mass_feature"), F.lit(None).cast("string").alias("mis"),
        nothing.alias("mean"), nothing.alias("variance"), F.lit(0).cast("bigint").alias("frequency"), "rows",
    )
    mean, var, d_mean, d_var = (F.col(c) for c in ("mean", "var", "d_mean", "d_var"))
    pairs = null_safe_join(features, divisors, ["replicate_name"], "inner").select(
        "replicate_name", F.col("name").alias("mass_feature"), "mis", (mean * d_mean).alias("mean"),
        (var * d_var + var * d_mean * d_mean + mean * mean * d_var).alias("variance"),
        (F.col("n") * F.col("d_n")).alias("frequency"),
        (F.col("rows") * (F.col("d_rows") - 1)).alias("rows"),
    )
    return pairs.unionByName(base)


def pooled_rsd(moments: DataFrame) -> DataFrame:
    """Mean over the pooled samples of the relative standard deviation, weighted by their rows."""
    pools = moments.filter(is_pool()).withColumn("samp_id", replicate_part("replicate_name", 2))
    sample_and_feature = ["samp_id", "mass_feature"]
    per_sample = weighted_rsd(pools, [*sample_and_feature, "mis"], cluster=sample_and_feature)
    base = F.max(F.when(F.col("mis").isNull(), F.col("row_weight"))).over(
        Window.partitionBy(*sample_and_feature)
    )
    per_sample = per_sample.withColumn("row_weight", F.col("row_weight") + base).filter(F.col("mis").isNotNull())
    rows = F.when(F.col("rsd").isNotNull(), F.col("row_weight"))
    return per_sample.groupBy("mass_feature", "mis").agg(
        safe_div(F.sum(rows * F.col("rsd")), F.sum(rows)).alias("rsd_of_poo")
    )


def with_missing_pairs(rsd: DataFrame, means: DataFrame) -> DataFrame:
    """Add the pairs of a feature and a standard that never share a pooled replicate, without a value."""
    rsd = sized(rsd)
    missing = missing_of(rsd, ["mass_feature"], "mis", means.select(F.col("mass_feature").alias("mis")))
    return rsd.unionByName(missing.withColumn("rsd_of_poo", F.lit(None).cast("double")))


def bmis_pick(rsd: DataFrame, p: BmisParams = BmisParams()) -> DataFrame:
    """Per feature the standard with the lowest spread, and whether it improves enough on none."""
    feature = Window.partitionBy("mass_feature")
    ranked = F.when(
        F.col("rsd_of_poo").isNotNull(), F.struct(F.round("rsd_of_poo", RSD_DECIMALS).alias("rsd"), "mis")
    )
    original = F.max(F.when(F.col("mis") == INJECTION_VOLUME, F.col("rsd_of_poo"))).over(feature)
    return (
        rsd.withColumns({"poo_picked_is": F.min(ranked).over(feature)["mis"], "orig_rsd": original})
        .withColumn("del_rsd", F.col("orig_rsd") - F.col("rsd_of_poo"))
        .withColumn("percent_change", safe_div("del_rsd", "orig_rsd"))
        .withColumn("accept_mis", (F.col("percent_change") > p.cut_off) & (F.col("orig_rsd") > p.cut_off2))
    )


def bmis_final(pick: DataFrame, mode: str = REFERENCE) -> DataFrame:
    """One row per feature: its final standard and the spread under it.

    A rejected pick falls back to the injection volume. Reference: a feature whose acceptance cannot
    be decided is dropped; corrected: it falls back too."""
    feature = Window.partitionBy("mass_feature")
    accepted = F.bool_or(
        F.when(F.col("mis") == F.col("poo_picked_is"), F.col("accept_mis"))
    ).over(feature)
    final = F.when(accepted, F.col("poo_picked_is")).when(~accepted, F.lit(INJECTION_VOLUME))
    if is_corrected(mode):
        final = F.coalesce(final, F.lit(INJECTION_VOLUME))
    return (
        pick.withColumn("final_bmis", final).filter(F.col("mis") == F.col("final_bmis"))
        .select(
            "mass_feature", "poo_picked_is", "orig_rsd", "del_rsd", "percent_change", "accept_mis", "final_bmis",
            F.col("rsd_of_poo").alias("final_rsd"),
        )
    )


def bmis_choice(
    data: DataFrame, standards: DataFrame, p: BmisParams = BmisParams(), mode: str = REFERENCE
) -> DataFrame:
    """From input rows to one final standard per feature, looking at pooled runs only."""
    pools = candidate_moments(data, standards, mode, runs=is_pool())
    return bmis_final(bmis_pick(pooled_rsd(pools), p), mode)


def is_to_is_rsd(
    data: DataFrame, standards: DataFrame, pick: DataFrame, mode: str = REFERENCE
) -> DataFrame:
    """Spread of every internal standard under every other, over all sample runs."""
    samples = candidate_moments(data, standards, mode, runs=is_sample(), standards_only=True)
    spread = weighted_rsd(samples, ["mass_feature", "mis"], "rsd_of_smp").filter(F.col("mis").isNotNull())
    judged = pick.select("mass_feature", "mis", "rsd_of_poo", "accept_mis")
    return spread.drop("row_weight").join(judged, ["mass_feature", "mis"], "left")


def bmis_quick_report(final: DataFrame, p: BmisParams = BmisParams()) -> DataFrame:
    """Share of features that picked an internal standard, with the cut-offs used."""
    picked = F.when(F.col("final_bmis") != INJECTION_VOLUME, 1.0).otherwise(0.0)
    return final.agg(
        F.avg(picked).alias("share_picked"), F.lit(p.cut_off).alias("cut_off"), F.lit(p.cut_off2).alias("cut_off2")
    )


def bmis_normalize(
    data: DataFrame, standards: DataFrame, p: BmisParams = BmisParams(), mode: str = REFERENCE,
    final: DataFrame | None = None,
) -> DataFrame:
    """Rows of every feature that kept a final standard, with the area adjusted by it.

    Only the chosen standard is joined back, so the row count never multiplies. Features that fell
    back to the injection volume need no join at all; the rest is shuffled once, still narrow."""
    if final is None:
        final = bmis_choice(data, standards, p, mode)
    final = sized(final.select("mass_feature", "final_bmis", "orig_rsd", "final_rsd"))
    means = sized(is_means(data, standards, mode)).withColumnRenamed("mass_feature", "final_bmis")
    rows = _features(data).unionByName(injection_volume(data, mode)).drop("weight")
    choice = final.select("mass_feature", "final_bmis")
    fell_back = F.col("final_bmis") == INJECTION_VOLUME
    by_volume = null_safe_join(rows, choice.filter(fell_back), ["mass_feature"], "inner").withColumn(
        "_divisor", _volume()
    )
    found = semi_internal_standards(data, standards).select(
        "replicate_name", F.col("metabolite_name").alias("final_bmis"), F.col("area_with_qc").alias("_divisor")
    )
    by_standard = null_safe_join(rows, choice.filter(~fell_back), ["mass_feature"], "inner").join(
        found, ["replicate_name", "final_bmis"], "left"
    )
    spreads = sized(final.join(means, "final_bmis", "left").select(
        "mass_feature", "orig_rsd", "final_rsd", "average_area"
    ))
    return null_safe_join(by_volume.unionByName(by_standard), spreads, ["mass_feature"]).select(
        "mass_feature", "final_bmis", "orig_rsd", "final_rsd",
        *[c.alias(n) for n, c in parse_replicate("replicate_name").items()],
        "area_with_qc", F.col("final_bmis").alias("mis"),
        (safe_div("area_with_qc", "_divisor") * F.col("average_area")).alias("adjusted_area"),
        F.concat_ws(" ", "replicate_name", F.coalesce("mass_feature", F.lit("NA"))).alias("run_cmpd"),
    )
