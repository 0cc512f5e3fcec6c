"""Trusted stage: recipes that have images, outlier-free, with cleaned texts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import keys as K
from larder.functions import text as T
from larder.functions import values as V
from larder.operators import outliers as O
from larder.operators.joins import semi_join
from larder.operators.ranking import keys_per_id
from larder.operators.reports import document_report, record_counts
from larder.plans.formatted import screen_and_box
from larder.session import staged
from larder.sources import sinks
from larder.sources.idsets import add_ids

TEXT_LIST = "array<struct<text:string>>"
TEXT_COLUMNS = tuple(f"{part}_text_{form}" for part in ("title", "ingredients", "instructions") for form in ("raw", "clean"))


JUDGED = ("totals_key", "has_nutrition_data", "totals_dropped", "nutrition_normalized", "nutrition_values")


@dataclass(frozen=True)
class NutritionFields:
    """Names under which nutrition data may be found in a merged record."""

    totals: Sequence[str] = (
        "nutr_values_per100g__from_recipes_with_nutritional_info",
        "nutr_values_per100g",
        "nutr_values",
    )
    per_ingredient: Sequence[str] = (
        "nutr_per_ingredient__from_recipes_with_nutritional_info",
        "nutr_per_ingredient",
    )
    numeric: Sequence[str] = ("energy", "fat", "protein", "salt", "saturates", "sugars")
    drop_totals: bool = True


@dataclass(frozen=True)
class TextSources:
    """Candidate fields of each text part, in order of preference."""

    suffixes: Sequence[str] = ("__from_layer1", "__from_recipes_with_nutritional_info", "")
    stop: Sequence[str] | None = field(default=T.ENGLISH_STOPWORDS)


def image_ids(images: DataFrame, only_kept: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Distinct ids of all scanned images, or of the kept ones when given."""
    source = images if only_kept is None else only_kept
    return source.select(K.recipe_id("key", strict).alias("id")).filter("id IS NOT NULL").distinct()


def recipe_images(images: DataFrame, strict: bool = False) -> DataFrame:
    """Sorted image keys of each recipe, in parts of bounded length."""
    pairs = images.select(K.recipe_id("key", strict).alias("id"), "key").filter("id IS NOT NULL")
    return keys_per_id(pairs)


def trust_images(images: DataFrame, out: str | None = None, **options) -> dict[str, DataFrame]:
    """Second screening pass plus the id list handed to the document stage.

    With ``out`` the ids and keys of the run are added to the id sets there (``run`` names it), and ``id_count`` counts the ids of all runs.
    """
    strict = options.get("strict", False)
    result = screen_and_box(images, **{n: v for n, v in options.items() if n != "run"})
    result["ids"] = image_ids(images, strict=strict)
    if out is not None:
        sinks.write_images(result["kept"], f"{out}/images", options.get("overwrite", True))
        sinks.write_skip_log(result["skips"], f"{out}/skips")
        sinks.write_report(result["report"], f"{out}/report")
        result["ids"].write.mode("overwrite").parquet(f"{out}/ids")
        pairs = images.select(K.recipe_id("key", strict).alias("id"), "key").filter("id IS NOT NULL")
        result["id_count"] = add_ids(pairs, f"{out}/id-sets", options.get("run", "images"))
    return result


def _as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _as_list(value: Column) -> Column:
    return F.try_variant_get(value, "$", TEXT_LIST)


def nutrition_columns(main: DataFrame, names: NutritionFields = NutritionFields()) -> DataFrame:
    """Add the chosen nutrition keys, ``nutrition_values`` (finite numbers of the totals) and the flags."""
    fields = F.col("fields")
    totals = V.first_present_value(fields, names.totals)
    keyed = main.withColumns(
        {
            "totals_key": V.first_present(fields, names.totals),
            "per_ingredient_key": V.first_present(fields, names.per_ingredient),
            "nutrition_values": V.finite_numbers(totals, names.numeric),
        }
    )
    has_totals, has_parts = F.col("totals_key").isNotNull(), F.col("per_ingredient_key").isNotNull()
    return keyed.withColumns(
        {
            "has_nutrition_data": has_totals | has_parts,
            "totals_dropped": F.lit(names.drop_totals) & has_totals & has_parts,
            "nutrition_normalized": has_parts & (F.lit(names.drop_totals) | ~has_totals),
        }
    )


def text_columns(df: DataFrame, sources: TextSources = TextSources()) -> DataFrame:
    """Add raw and cleaned title, ingredients and instructions."""
    fields = F.col("fields")

    def raw(part: str) -> Column:
        options = [fields[f"{part}{s}"] for s in sources.suffixes]
        if part == "title":
            return T.first_filled(*[_as_text(o) for o in options])
        return T.first_filled(*[T.join_text_list(_as_list(o)) for o in options])

    parts = ("title", "ingredients", "instructions")
    with_raw = df.withColumns({f"{p}_text_raw": raw(p) for p in parts})
    return with_raw.withColumns(
        {f"{p}_text_clean": T.clean_text(f"{p}_text_raw", stop=sources.stop) for p in parts}
    )


def judged_records(merged: DataFrame, ids: DataFrame, names: NutritionFields) -> DataFrame:
    """One narrow row per record: its nutrition flags and numbers, and whether it has an image."""
    marks = ids.select("id").distinct().withColumn("has_image", F.lit(True))
    rows = nutrition_columns(merged.filter(F.col("part") == 0), names).select("id", *JUDGED).join(marks, "id", "left")
    return rows.withColumn("has_image", F.coalesce("has_image", F.lit(False)))


def _bounds(judged: DataFrame, names: NutritionFields, method: str) -> DataFrame:
    numbers = judged.filter("has_image").select(*[F.col("nutrition_values")[i].alias(n) for i, n in enumerate(names.numeric)])
    bounds = O.iqr_bounds(numbers, names.numeric, method=method)
    return judged.sparkSession.createDataFrame([bounds.first()], bounds.schema)


def _flags(judged: DataFrame, inside: Column, missing: Column, malformed: DataFrame | None) -> DataFrame:
    flags = judged.select(
        "id", "has_image", F.lit(False).alias("malformed"), "totals_dropped", (~inside).alias("outlier"), missing.alias("missing_nutrition")
    )
    if malformed is None:
        return flags
    no = F.lit(False)
    bad = malformed.select(
        F.lit(None).cast("string").alias("id"), no.alias("has_image"), F.lit(True).alias("malformed"), no.alias("totals_dropped"),
        no.alias("outlier"), no.alias("missing_nutrition"),
    )
    return flags.unionByName(bad)


def dry_run_documents(
    merged: DataFrame,
    ids: DataFrame,
    names: NutritionFields = NutritionFields(),
    require_nutrition: bool = False,
    method: str = "auto",
    malformed: DataFrame | None = None,
) -> DataFrame:
    """The counts ``trust_documents`` would report, and the bounds as JSON: texts are neither read nor cleaned, nothing is stored."""
    judged = judged_records(merged, ids, names)
    bounds = _bounds(judged, names, method)
    missing = ~F.col("has_nutrition_data") if require_nutrition else F.lit(False)
    flags = _flags(judged, O.all_within("nutrition_values", names.numeric, bounds), missing, malformed)
    return record_counts(flags).withColumn("iqr_thresholds", bounds.select(F.to_json(F.struct("*"))).scalar())


def trust_documents(
    merged: DataFrame,
    ids: DataFrame,
    names: NutritionFields = NutritionFields(),
    sources: TextSources = TextSources(),
    require_nutrition: bool = False,
    method: str = "auto",
    out: str | None = None,
    malformed: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Trusted recipes from merged records (``id, part, fields``) and the ids that have images.

    Returns ``trusted``, the one-row ``bounds`` and the one-row ``report``. One narrow table of flags and
    nutrition numbers per record is stored first; bounds, verdicts and counts come from it, and only the
    records that stay are read whole. ``malformed`` has one row per stored text that could not be read; the report counts
    them. Later parts of very wide records follow their id. With ``out`` the recipes and the
    report are written, and the report's token means are read from the stored recipes.
    """
    if ids.isEmpty():
        raise ValueError("no recipe ids with images")
    main = merged.filter(F.col("part") == 0)
    judged = staged(judged_records(merged, ids, names), "record-flags")
    bounds = _bounds(judged, names, method)
    missing = ~F.col("has_nutrition_data") if require_nutrition else F.lit(False)
    inside = O.all_within("nutrition_values", names.numeric, bounds)
    stays = judged.filter(F.col("has_image") & inside & ~missing).drop("has_image", "nutrition_values")
    cleaned = text_columns(main.join(stays, "id"), sources)
    slim = F.map_filter("fields", lambda k, v: k != F.col("totals_key"))
    added = ("has_nutrition_data", "nutrition_normalized", *TEXT_COLUMNS)
    trusted = cleaned.withColumn("fields", F.when(F.col("totals_dropped"), slim).otherwise(F.col("fields"))).select(
        "id", "part", "fields", *added
    )
    rest = semi_join(merged.filter(F.col("part") > 0), stays, "id")
    whole = trusted.unionByName(rest.select("id", "part", "fields"), allowMissingColumns=True)
    if out is not None:
        whole.write.mode("overwrite").parquet(f"{out}/documents")
        whole = merged.sparkSession.read.parquet(f"{out}/documents")

    flags = _flags(judged, inside, missing, malformed)
    kept = whole.filter(F.col("part") == 0)
    report = document_report(flags, kept, TEXT_COLUMNS, bounds, ids)
    if out is not None:
        sinks.write_report(report, f"{out}/report")
    return {"trusted": whole, "bounds": bounds, "report": report}
