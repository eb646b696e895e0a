"""Readers: artifact trees, strict and commented CSV, signals and hash lists. Types are declared, never inferred."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import header_base


def scan_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """All files in the folders of ``root``: capsule (the folder), path (below it), content, length. Files beside the folders belong to none."""
    base = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    rel = F.regexp_replace(F.expr("substring_index(path, '" + base.replace("'", "") + "/', -1)"), "^/", "")
    return files.filter(rel.contains("/")).select(F.element_at(F.split(rel, "/"), 1).alias("capsule"), F.regexp_replace(rel, "^[^/]*/", "").alias("path"), "content", "length")


class ColumnError(ValueError):
    """A header that does not say which column is meant."""


def resolve_columns(header: list[str], wanted: dict[str, str], mode: str = "base") -> dict[str, str]:
    """Which header cell stands for each wanted name.

    base: equal after units and quotes are taken off, exactly one. contains: holds the text, exactly one.
    prefix: the name alone or before a blank or bracket, first one wins.
    """
    plain = {h: h.strip().strip('"').split("(")[0].split("[")[0].strip() for h in header}
    out = {}
    for name, spec in wanted.items():
        if mode == "contains":
            hits = [h for h in header if spec.lower() in h.lower()]
        elif mode == "prefix":
            hits = [h for h in header if (t := h.strip().strip('"').lower()) == spec.lower() or t[: len(spec) + 1] in (spec.lower() + " ", spec.lower() + "(")][:1]
        else:
            hits = [h for h in header if plain[h].lower() == spec.lower()]
        if len(hits) != 1:
            raise ColumnError(f"{name}: {len(hits)} columns answer to {spec!r}")
        out[name] = hits[0]
    return out


def text_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Lines of text files, read in parallel by blocks, and where each block begins.

    The lines have file, value, _block and _place; :func:`line_numbers` turns the latter into the line within its file.
    The second table has one row per block: its first place and the lines in all blocks of the file before it.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"))
    lines = lines.withColumn("_place", F.monotonically_increasing_id())  # rising and without holes within a block
    blocks = lines.groupBy("file", "_block").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    return lines, blocks.withColumn("_earlier", F.coalesce(earlier, F.lit(0))).drop("_n")


def line_numbers(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``line`` (from 1) for rows of :func:`text_lines`, or some of them: only these are shuffled."""
    out = rows.join(blocks, ["file", "_block"])
    return out.withColumn("line", F.col("_place") - F.col("_first") + F.col("_earlier") + 1).drop("_block", "_place", "_first", "_earlier")


def read_csv_strict(spark: SparkSession, path: str, wanted: dict[str, str], mode: str = "base", positive: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows with all wanted columns as finite doubles, and the rejected rows with the reason, the file and the line in it.

    The first line that is not blank is the header; it is left out wherever it occurs, so every file may have it. A file
    whose header differs has that line among the rejects. Blank rows are skipped (but counted); other columns are never parsed.
    """
    head = spark.read.text(path).filter(F.trim("value") != "").first()
    header = head[0].strip() if head else ""
    names = [c.strip() for c in header.split(",")]
    chosen = resolve_columns(names, wanted, mode)
    lines, blocks = text_lines(spark, path)
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = lines.filter((F.trim("value") != "") & (F.trim("value") != header)).withColumn("_c", F.from_csv("value", schema, {"mode": "PERMISSIVE"}))
    rows = rows.select("file", "_block", "_place", *[F.trim(F.col(f"_c.c{names.index(h)}")).alias(f"_{n}") for n, h in chosen.items()])
    rows = rows.filter(F.coalesce(*[F.nullif(F.col(f"_{n}"), F.lit("")) for n in chosen]).isNotNull())
    for n in chosen:
        rows = rows.withColumn(n, F.expr(f"try_cast(`_{n}` AS double)"))
    odd = [(F.col(n).isNull() | F.isnan(n) | (F.abs(n) == float("inf")), f"{n} is not a finite number") for n in chosen] + [(F.col(n) <= 0, f"{n} is not positive") for n in positive]
    reason = F.coalesce(*[F.when(F.coalesce(test, F.lit(True)), F.lit(said)) for test, said in odd])
    marked = rows.withColumn("reason", reason)
    rejects = line_numbers(marked.filter(F.col("reason").isNotNull()), blocks)
    return marked.filter(F.col("reason").isNull()).select(*chosen), rejects.select(*[F.col(f"_{n}").alias(n) for n in chosen], "reason", "file", "line")


def read_csv_commented(spark: SparkSession, path: str, columns: str) -> tuple[DataFrame, DataFrame]:
    """Data rows (schema ``columns``) and the comment lines with the file they stand in."""
    comments = spark.read.text(path).filter(F.col("value").startswith("#")).select(F.col("_metadata.file_name").alias("file"), F.trim(F.expr("substring(value, 2)")).alias("comment"))
    return spark.read.csv(path, schema=columns, header=True, comment="#"), comments


def data_rows(text: str = "text"):
    """Rows of a CSV text without comments, header and blank lines."""
    lines = F.filter(F.split(text, "\n"), lambda s: (F.trim(s) != "") & ~s.startswith("#"))
    return F.greatest(F.size(lines) - 1, F.lit(0))


def read_signals(spark: SparkSession, path: str, time: str = "tU_D", strict: bool = False) -> DataFrame:
    """Two-column files as signal (the file's stem), folder, t, y, line; long files are read by blocks.

    Files that don't have exactly two columns headed by ``time`` are left out, or an error under ``strict``.
    """
    lines, blocks = text_lines(spark, path)
    cells = lines.withColumn("value", F.rtrim("value", F.lit("\r"))).filter("value <> ''").withColumn("c", F.split("value", ","))
    heads = cells.groupBy("file").agg(F.min_by("c", F.struct("_block", "_place")).alias("h"))
    wrong = heads.filter((F.size("h") != 2) | (header_base(F.col("h")[0]) != time))
    signal = F.url_decode(F.replace(F.regexp_extract("file", r"([^/]*)\.[^./]*$", 1), F.lit("+"), F.lit("%2B")))
    if strict and (bad := [r["signal"] for r in wrong.select(signal.alias("signal")).orderBy("signal").limit(20).collect()]):
        raise ColumnError(f"not a signal over {time}: {', '.join(bad)}")
    number = lambda i: F.expr(f"try_cast(c[{i}] AS double)")
    rows = cells.filter(F.size("c") == 2).select("file", "_block", "_place", number(0).alias("t"), number(1).alias("y")).filter("t IS NOT NULL AND y IS NOT NULL")
    rows = line_numbers(rows.join(wrong.select("file"), "file", "left_anti"), blocks)
    return rows.select(signal.alias("signal"), F.regexp_replace("file", "/[^/]*$", "").alias("folder"), "t", "y", "line")


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Files of one header ``cells`` and one number: file, cells (rounded half to even; null if the file is not of this kind)."""
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.filter(F.split("value", r"\r\n|\r|\n"), lambda x: x != "").alias("l"))
    proper = (F.size("l") == 2) & (F.try_element_at("l", F.lit(1)) == "cells")
    return lines.select("file", F.when(proper, F.bround(F.try_element_at("l", F.lit(2)).try_cast("double"))).cast("bigint").alias("cells"))


def read_monitor_export(spark: SparkSession, path: str) -> DataFrame:
    """A monitor's export as t, y: time is the first column named Physical Time, else the only one with Time in it; the value is the last other."""
    header = [c.strip().strip('"') for c in (spark.read.text(path).filter(F.trim("value") != "").first() or [""])[0].split(",")]
    physical = [i for i, h in enumerate(header) if "Physical Time" in h]
    any_time = [i for i, h in enumerate(header) if "Time" in h]
    if not physical and len(any_time) != 1 or len(header) < 2:
        raise ColumnError(f"{len(any_time)} columns answer to 'Time'")
    t = (physical or any_time)[0]
    y = max(i for i in range(len(header)) if i != t)
    raw = spark.read.csv(path, schema=", ".join(f"c{i} string" for i in range(len(header))), header=True, enforceSchema=True)
    return raw.select(F.col(f"c{t}").try_cast("double").alias("t"), F.col(f"c{y}").try_cast("double").alias("y")).filter(F.col("t").isNotNull() & F.col("y").isNotNull())


def read_named_csv(spark: SparkSession, path: str, wanted: dict[str, str]) -> DataFrame:
    """Columns of a CSV by their exact names, with the wanted names and types (``name: type``)."""
    raw = spark.read.csv(path, header=True)
    lost = [c for c in wanted if c not in raw.columns]
    if lost:
        raise ColumnError(f"no column {', '.join(lost)}")
    return raw.select(*[F.col(f"`{c}`").try_cast(kind).alias(c) for c, kind in wanted.items()])


def project_named(df: DataFrame, wanted: dict[str, str], mode: str = "base") -> DataFrame:
    """The wanted columns in their order under their new names, each found in the header as :func:`resolve_columns` does."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in resolve_columns(df.columns, wanted, mode).items()])


#: Keys of a sweep file with their types; those of a declared point.
SWEEP_KEYS = {"points": list, "baseline": int, "designed_for_Re_range": list, "regime_ref": str, "declared": dict}
POINT_KEYS = {"regime_expected": str, "uncertainty": dict}


def read_sweep(text: str) -> dict:
    """A checked sweep file. Unknown keys, wrong types, points that are declared but not swept, and a missing source are errors."""
    config = json.loads(text)
    if not isinstance(config, dict):
        raise ValueError("a sweep is an object")
    for place, block, kinds in [("", config, SWEEP_KEYS), *[(f"declared/{k}/", v, POINT_KEYS) for k, v in config.get("declared", {}).items()]]:
        for key, value in block.items():
            if key not in kinds:
                raise ValueError(f"unknown key {place}{key}")
            if not isinstance(value, kinds[key]) or isinstance(value, bool):
                raise ValueError(f"{place}{key} is not of type {kinds[key].__name__}")
    points = config.get("points", [])
    if not points or not all(type(p) is int and p > 0 for p in points) or len(set(points)) < len(points):
        raise ValueError("points are distinct positive integers")
    stray = sorted(set(config.get("declared", {})) - {str(p) for p in points})
    if stray:
        raise ValueError(f"declared but not swept: {', '.join(stray)}")
    if any("regime_expected" in d for d in config.get("declared", {}).values()) and "regime_ref" not in config:
        raise ValueError("regime_expected needs regime_ref")
    span = config.get("designed_for_Re_range")
    if span is not None and not (len(span) == 2 and all(type(v) is int for v in span) and span[0] <= span[1]):
        raise ValueError("designed_for_Re_range is two integers, low then high")
    return config


def read_hash_list(spark: SparkSession, path: str) -> DataFrame:
    """``sha256  path`` lines; # starts a comment."""
    lines = spark.read.text(path).filter((F.trim("value") != "") & ~F.trim("value").startswith("#"))
    return lines.select(F.regexp_extract("value", r"^\s*([0-9a-fA-F]{64})\s+", 1).alias("sha256"), F.trim(F.regexp_replace("value", r"^\s*[0-9a-fA-F]{64}\s+\*?", "")).alias("path"))
