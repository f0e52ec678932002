"""Menu preparation: gaps, recipe bank rows, costs, preference lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.operators.chunked import row_numbers


def constraint_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(item, tag, column, key) rows of items: every tag with every constrained column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("key")) for c in cols]))
    tagged = df.select("item", *cols, F.explode("tags").alias("tag"))
    return tagged.select("item", "tag", pairs.alias("c")).select("item", "tag", "c.column", "c.key")


def supplement_items(
    available: DataFrame, universe: DataFrame, rules: DataFrame, cols: Sequence[str], seasonal: Sequence[str]
) -> DataFrame:
    """Available items plus twice the missing number for every constraint that they do not meet.

    Items: item, tags and the constrained ``cols``.  ``rules``: tag, column, key, required.  Items not yet available
    and without a seasonal tag fill a gap, smallest id first.
    """
    key = ["tag", "column", "key"]
    have = constraint_rows(available, cols).groupBy(*key).agg(F.count("*").alias("n"))
    gaps = rules.join(have, key, "left").withColumn("gap", F.col("required") - F.coalesce("n", F.lit(0))).where("gap > 0")
    spare = universe.join(available.select("item"), "item", "left_anti")
    spare = spare.where(~F.arrays_overlap("tags", F.array(*[F.lit(s) for s in seasonal])))
    options = constraint_rows(spare, cols).join(gaps.select(*key, "gap"), key)
    ranked = row_numbers(options, key, ["item"], "rank").where(F.col("rank") <= 2 * F.col("gap"))
    extra = universe.join(ranked.select("item").distinct(), "item", "left_semi")
    return available.unionByName(extra)


def prepare_items(lines: DataFrame, item: str, carb_groups: Sequence[str], protein_groups: Sequence[str], fills: dict[str, Column]) -> DataFrame:
    """One row per item with its lists of main carbohydrates and proteins; empty lists take a default.

    ``lines``: item, role ('carb' or 'protein'), main_group, category_group, product_group.  A carb is named by its
    category if that is a known one, else by its product; a protein by its main group if known, else its category.
    """
    name = lambda c: F.lower(F.trim(F.col(c)))
    carb = F.when(name("category_group").isin(*carb_groups), name("category_group")).otherwise(name("product_group"))
    protein = F.when(name("main_group").isin(*protein_groups), name("main_group")).otherwise(name("category_group"))
    named = lines.select(item, "role", F.when(F.col("role") == "carb", carb).otherwise(protein).alias("name")).distinct()
    pick = lambda role: F.array_sort(F.collect_list(F.when(F.col("role") == role, F.col("name"))))
    out = named.groupBy(item).agg(pick("carb").alias("main_carbs"), pick("protein").alias("main_proteins"))
    for c, default in fills.items():
        out = out.withColumn(c, F.when(F.size(c) == 0, default).otherwise(F.col(c)))
    return out


def item_costs(lines: DataFrame, item: str) -> DataFrame:
    """Cost and CO2 of an item from its ingredients, in whole bought units and by the used quantity.

    ``lines``: item, ingredient, quantity, unit_cost, co2, category, is_main.  The main ingredient's category is the
    one of the costliest line marked as main.
    """
    per = lines.groupBy(item, "ingredient").agg(
        F.sum("quantity").alias("q"), F.max("unit_cost").alias("c"), F.sum("co2").alias("co2"),
        F.max("category").alias("category"), F.max("is_main").alias("is_main"),
    )
    cost = F.col("q") * F.col("c")
    return per.groupBy(item).agg(
        F.sum(cost).alias("cost"),
        F.sum(F.ceil("q") * F.col("c")).alias("cost_whole_units"),
        F.sum("co2").alias("co2"),
        F.max_by("category", F.when(F.col("is_main"), F.struct(cost.alias("c"), "ingredient"))).alias("main_category"),
    )


def item_preferences(ingredients: DataFrame, allergies: DataFrame, preferences: DataFrame, keys: Sequence[str], default: str) -> DataFrame:
    """Distinct preference ids per item and portion from ingredient allergies and the item's own preferences.

    ``ingredients``: keys, ingredient.  ``allergies``: ingredient, preference, is_trace (traces do not count).
    ``preferences``: keys, preference (NULL for none).  Items without own preferences get the default.
    """
    a = allergies.where("preference is not null and not is_trace").select("ingredient", "preference").distinct()
    from_allergies = ingredients.join(a, "ingredient").select(*keys, "preference")
    listed = preferences.where("preference is not null").select(*keys, "preference")
    anyone = from_allergies.select(*keys).unionByName(preferences.select(*keys)).distinct()
    none = anyone.join(listed.select(*keys).distinct(), list(keys), "left_anti").withColumn("preference", F.lit(default))
    rows = from_allergies.unionByName(listed).unionByName(none).distinct()
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list("preference")).alias("preferences"))
