"""Trees inside documents: tree tables of reports and nested elements of pages, as rows with parents and paths.

A document is split into rows by column expressions; parents and paths come from windows per (document, level) and from
joins, so neither a page with a million siblings nor a table of many pages meets in one array or one task.

Cases: a null or empty text has no rows; a row deeper than the row before it by more than one hangs below the last
shallower row; closing tags without an opening one are passed over; elements never closed stay open to the end; equal
names and repeated rows are told apart by their position. Documents are told apart by ``document``: give repeated
or null ids a key of their own first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Properties that say nothing about a set-up and are left out of tree tables.
DROPPED = (
    "Tags", "Error Message", "Color", "Diffuse Color", "Specular Color", "Specular Tint", "Specular", "Absorption", "Reflection", "Refraction",
    "Index of Refraction", "Reverse Surface Orientation", "Roughness", "Transmission Weight", "Transmission Roughness",
    "Subsurface Scattering Distance", "Sheen Tint", "Sheen", "Metallic", "Emission Intensity", "Emission Color", "Clearcoat IOR",
    "Clear Coat Weight", "Clear Coat Roughness", "Attenuation Distance", "Attenuation Color", "Solid Volume", "Set Tangency at all Edges",
    "Opacity", "Override Upstream Color", "IsAssignedColor", "Display Resolution", "Maximum Plot Samples", "Synchronize Function Name",
    "Inverse Distance Weight",
)


def bar_depth(drawn: Column) -> Column:
    """Depth of a row from the lines drawn before its name: one for every bar, one more for a branch."""
    return F.length(F.regexp_replace(drawn, r"[^|]", "")) + drawn.rlike(r"[+`]-").cast("int")


def tree_rows(docs: DataFrame, document: str, html: str, dropped: tuple[str, ...] = DROPPED) -> DataFrame:
    """The rows of all tree tables, one per line: document, position, depth, name, property, value.

    ``name`` is null on lines that only continue the properties of the node above, and then so is ``depth``. Lines
    that hold neither a name nor a property with a value are left out, and so are properties named in ``dropped``.
    """
    lines = docs.select(document, F.posexplode(F.split(html, "\n")).alias("position", "_line"))
    lines = lines.filter(F.col("_line").contains('class="node"') | F.col("_line").contains("prop-key"))
    found = lambda pattern: F.nullif(F.trim(F.regexp_extract("_line", pattern, 1)), F.lit(""))
    key, value = found(r'prop-key">([^<]+)</td>'), found(r'prop-value">(?:<IT>)?([^<]+)(?:</IT>)?</td>')
    value = F.when(F.trim(F.replace(value, F.lit("&nbsp;"), F.lit(""))) != "", value)
    skipped = key.isin(*dropped) if dropped else F.lit(False)
    told = key.isNotNull() & value.isNotNull()
    name = F.when(F.col("_line").rlike("<tt>.*?</tt>"), found(r"</tt>(?:<b>)?([^<]+)(?:</b>)?</td>"))
    drawn = F.replace(F.regexp_extract("_line", "<tt>(.*?)</tt>", 1), F.lit("&nbsp;"), F.lit(" "))
    rows = lines.filter(~F.coalesce(skipped, F.lit(False))).select(
        document, "position", F.when(name.isNotNull(), bar_depth(drawn)).cast("int").alias("depth"), name.alias("name"), F.when(told, key).alias("property"), F.when(told, value).alias("value")
    )
    return rows.filter("name IS NOT NULL OR property IS NOT NULL")


def element_rows(docs: DataFrame, document: str, html: str, elements: tuple[str, ...]) -> DataFrame:
    """Opening tags of the named elements: document, position, depth (0: outermost), name. Scripts, styles and comments are passed over.

    The depth is the number of elements open at that place, counted by running sums; it never falls below 0.
    """
    plain = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    tags = F.regexp_extract_all(plain, F.lit(rf"(?i)</?(?:{'|'.join(elements)})(?:\s[^>]*)?>"), 0)
    t = docs.select(document, F.posexplode(tags).alias("position", "_tag"))
    t = t.select(document, "position", F.lower(F.regexp_extract("_tag", r"([A-Za-z0-9]+)", 1)).alias("name"), F.when(F.col("_tag").startswith("</"), -1).otherwise(1).alias("_step"))
    order = Window.partitionBy(document).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("_open", F.sum("_step").over(order))
    t = t.withColumn("_open", F.col("_open") - F.least(F.lit(0), F.min("_open").over(order)))
    return t.filter("_step = 1").select(document, "position", (F.col("_open") - 1).cast("int").alias("depth"), "name")


def with_parents(nodes: DataFrame, document: str, steps_of_one: bool = False) -> DataFrame:
    """``nodes`` with ``parent``: the position of the last shallower node before each; null at the top.

    Every node is looked for at each level above its own: the last node of a level comes from a window over that level.
    ``steps_of_one``: no node is deeper than the one before it by more than one, so the level just above is enough.
    """
    levels = F.array(F.col("depth") - 1) if steps_of_one else F.sequence(F.lit(0), F.col("depth") - 1)
    asked = nodes.filter("depth > 0").select(document, F.explode(levels).alias("_level"), "position", F.lit(None).cast("int").alias("_node"))
    there = nodes.select(document, F.col("depth").alias("_level"), "position", F.col("position").alias("_node"))
    before = Window.partitionBy(document, "_level").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    last = there.unionByName(asked).withColumn("_last", F.last("_node", ignorenulls=True).over(before)).filter("_node IS NULL")
    parents = last.groupBy(document, "position").agg(F.max("_last").alias("parent"))
    return nodes.join(parents, [document, "position"], "left")


def with_paths(nodes: DataFrame, document: str, separator: str = "/") -> DataFrame:
    """``nodes`` (with ``parent``) and ``path``, the names from the top down. Pointers are doubled: the rounds are the logarithm of the depth."""
    step = nodes.select(document, "position", F.col("parent").alias("_up"), F.col("name").alias("path")).checkpoint()
    for _ in range(int(nodes.agg(F.max("depth")).first()[0] or 0).bit_length()):
        above = step.select(document, F.col("position").alias("_up"), F.col("_up").alias("_next"), F.col("path").alias("_head"))
        moved = step.join(above, [document, "_up"], "left")
        path = F.when(F.col("_head").isNull(), F.col("path")).otherwise(F.concat("_head", F.lit(separator), "path"))
        step = moved.select(document, "position", F.col("_next").alias("_up"), path.alias("path")).checkpoint()
    return nodes.join(step.drop("_up"), [document, "position"])


def tree_table(docs: DataFrame, document: str, html: str, dropped: tuple[str, ...] = DROPPED) -> DataFrame:
    """Nodes and properties of all tree tables: document, position, node (position of the node), depth, parent, name, path, property, value.

    A line that only holds a property belongs to the node above it; before the first node, ``node`` and what follows from it are null.
    """
    rows = tree_rows(docs, document, html, dropped).checkpoint()
    above = Window.partitionBy(document).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("node", F.last(F.when(F.col("name").isNotNull(), F.col("position")), ignorenulls=True).over(above))
    nodes = with_parents(rows.filter("name IS NOT NULL").select(document, "position", "depth", "name"), document).checkpoint()
    known = with_paths(nodes, document).withColumnRenamed("position", "node")
    return rows.select(document, "position", "node", "property", "value").join(known, [document, "node"], "left")


def element_tree(docs: DataFrame, document: str, html: str, elements: tuple[str, ...]) -> DataFrame:
    """Nested elements with parents and paths: document, position, depth, name, parent, path."""
    rows = element_rows(docs, document, html, elements).checkpoint()
    return with_paths(with_parents(rows, document, steps_of_one=True).checkpoint(), document)


def outline(tree: DataFrame, document: str) -> DataFrame:
    """Lines of a tree table as indented text: document, position, line (0: the name, 1: its property), text. Two blanks a level."""
    indent = lambda more: F.repeat(F.lit(" "), 2 * F.coalesce("depth", F.lit(0)) + more)
    name = F.when(F.col("position") == F.col("node"), F.concat(indent(0), "name"))
    told = F.concat(indent(2), "property", F.lit(": "), "value")
    return tree.select(document, "position", F.posexplode(F.array(name, told)).alias("line", "text")).filter("text IS NOT NULL")
