"""What a set of files costs a reader in tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import two_significant

#: Characters per token of each kind (a picture has none), tokens of a picture, and a reader's budget.
RATES = {"setup_report": 3.5, "json": 4.0, "csv": 2.5, "code": 3.5, "other": 3.5}
PICTURE_TOKENS, BUDGET = 1200, 60_000


def kind_of(path: Column) -> Column:
    """setup_report, image, json, csv, code or other, by the name of the file."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    return F.when(name == "setup.txt", "setup_report").when(name.endswith(".png"), "image").when(name.endswith(".json"), "json").when(name.endswith(".csv"), "csv").when(name.rlike(r"\.(java|py)$"), "code").otherwise("other")


def layer_of(path: Column) -> Column:
    """The first part of the path: the top folder of a file, or the root file itself."""
    return F.element_at(F.split(path, "/"), 1)


def tokens_by_kind(kind: Column, characters: Column) -> Column:
    """Tokens of a file (half-even): characters over the rate of its kind, a fixed number for pictures."""
    rate = F.element_at(F.create_map(*[F.lit(x) for kv in RATES.items() for x in kv]), kind)
    return F.when(kind == "image", F.lit(PICTURE_TOKENS)).otherwise(F.bround(characters / rate)).cast("bigint")


def measured(files: DataFrame, layer: Column, characters: Column, rate: Column, estimated: Column | None = None) -> DataFrame:
    """Rows with layer, characters and tokens (half-even)."""
    return files.withColumn("layer", layer).withColumn("characters", characters).withColumn("tokens", F.bround(characters / rate).cast("bigint")).withColumn("estimated", F.lit(False) if estimated is None else estimated)


def ledger(rows: DataFrame, key: list[str], budget: int) -> DataFrame:
    """Per key and layer, with a total row (layer null) per key: files, characters, tokens, two-digit tokens, share of a budget, any estimate."""
    out = rows.rollup(*key, "layer").agg(F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("files"), F.sum("characters").alias("characters"), F.sum("tokens").alias("tokens"), F.bool_or("estimated").alias("estimated"))
    out = out.filter(F.col("_g") <= 1).drop("_g")
    return out.withColumn("about", two_significant("tokens")).withColumn("budget_share", F.col("tokens") / F.lit(float(budget)))


def ledger_pivot(rows: DataFrame, columns: str, names: list[str]) -> DataFrame:
    """Layer by column: tokens, zero where there are none."""
    return rows.groupBy("layer").pivot(columns, names).agg(F.sum("tokens")).na.fill(0)
