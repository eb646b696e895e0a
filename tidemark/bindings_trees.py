"""Trees inside table texts: nested elements of pages, and tree tables whose rows are the lines of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.bindings import query, table
from tidemark.operators import trees

ELEMENTS = ("html", "body", "nav", "ul", "ol", "li", "article", "div", "table", "tr", "td")


@query(rf"""WITH RECURSIVE l AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g'), '(?i)</?(?:{"|".join(ELEMENTS)})(?:\s[^>]*)?>') AS tags FROM pages),
t AS (SELECT page_id, CAST(unnest(range(len(tags))) AS INTEGER) AS position, unnest(tags) AS tag FROM l),
s AS (SELECT *, sum(CASE WHEN tag LIKE '</%' THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY position) AS s FROM t),
o AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY page_id ORDER BY position)) AS open FROM s),
n AS (SELECT page_id, position, CAST(open - 1 AS INTEGER) AS depth, lower(regexp_extract(tag, '([A-Za-z0-9]+)', 1)) AS name FROM o WHERE tag NOT LIKE '</%'),
p AS (SELECT n.page_id, n.position, any_value(n.depth) AS depth, any_value(n.name) AS name, max(m.position) AS parent FROM n LEFT JOIN n m ON m.page_id = n.page_id AND m.position < n.position AND m.depth < n.depth GROUP BY n.page_id, n.position),
r AS (SELECT page_id, position, name AS path FROM p WHERE parent IS NULL UNION ALL SELECT p.page_id, p.position, r.path || '/' || p.name FROM r JOIN p ON p.page_id = r.page_id AND p.parent = r.position)
SELECT page_id, position, depth, parent, path FROM p JOIN r USING (page_id, position)""")
def page_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.element_tree(table(spark, sf_dir, "pages"), "page_id", "html", ELEMENTS).drop("name")


def _drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a tree table: a row per line, drawn at a depth, with a name and a property that follow from its length and first word."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line")).withColumn("n", F.length("line"))
    depth = F.when(F.col("i") == 0, 0).otherwise(F.col("n") % 5)
    bars = F.when(depth == 0, "").otherwise(F.concat(F.repeat(F.lit("|&nbsp;"), depth - 1), F.when(F.col("n") % 2 == 0, "+-").otherwise("`-")))
    node = F.when(F.col("n") % 7 != 6, F.concat(F.lit('<td class="node"><tt>'), bars, F.lit("</tt><b>n"), (F.col("n") % 11).cast("string"), F.lit("</b></td>"))).otherwise("")
    word = F.coalesce(F.nullif(F.regexp_extract("line", "[A-Za-z]+", 0), F.lit("")), F.lit("&nbsp;"))
    told = F.concat(F.lit('<td class="prop-key">'), F.when(F.col("n") % 3 == 0, "Opacity").otherwise("First word"), F.lit('</td><td class="prop-value">'), word, F.lit("</td>"))
    rows = lines.withColumn("row", F.concat(F.lit("<tr>"), node, F.when(F.col("n") % 4 != 3, told).otherwise(""), F.lit("</tr>")))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "row"))), lambda r: r["row"]), "\n").alias("html"))


@query(r"""WITH RECURSIVE l AS (SELECT doc_id, CAST(unnest(range(len(x))) AS INTEGER) AS position, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)),
c AS (SELECT doc_id, position, length(line) AS n, regexp_extract(line, '[A-Za-z]+') AS word FROM l),
k AS (SELECT doc_id, position, n % 7 <> 6 AS named, CAST(CASE WHEN position = 0 THEN 0 ELSE n % 5 END AS INTEGER) AS depth, 'n' || (n % 11) AS name, CASE WHEN n % 4 <> 3 AND word <> '' THEN word END AS value, n % 4 <> 3 AND n % 3 = 0 AS dropped FROM c),
f AS (SELECT *, max(CASE WHEN named THEN position END) OVER (PARTITION BY doc_id ORDER BY position) AS node FROM k WHERE NOT dropped AND (named OR value IS NOT NULL)),
v AS (SELECT doc_id, position, depth, name FROM f WHERE named),
a AS (SELECT *, max(CASE WHEN depth = 0 THEN position END) OVER w AS p0, max(CASE WHEN depth = 1 THEN position END) OVER w AS p1, max(CASE WHEN depth = 2 THEN position END) OVER w AS p2, max(CASE WHEN depth = 3 THEN position END) OVER w AS p3 FROM v WINDOW w AS (PARTITION BY doc_id ORDER BY position)),
p AS (SELECT doc_id, position, depth, name, nullif(greatest(CASE WHEN depth > 0 THEN coalesce(p0, -1) ELSE -1 END, CASE WHEN depth > 1 THEN coalesce(p1, -1) ELSE -1 END, CASE WHEN depth > 2 THEN coalesce(p2, -1) ELSE -1 END, CASE WHEN depth > 3 THEN coalesce(p3, -1) ELSE -1 END), -1) AS parent FROM a),
r AS (SELECT doc_id, position, name AS path FROM p WHERE parent IS NULL UNION ALL SELECT p.doc_id, p.position, r.path || '/' || p.name FROM r JOIN p ON p.doc_id = r.doc_id AND p.parent = r.position)
SELECT f.doc_id, f.position, f.node, p.depth, p.parent, r.path, CASE WHEN f.value IS NOT NULL THEN 'First word' END AS property, f.value FROM f LEFT JOIN p ON p.doc_id = f.doc_id AND p.position = f.node LEFT JOIN r ON r.doc_id = f.doc_id AND r.position = f.node""")
def report_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.tree_table(_drawn(spark, sf_dir), "doc_id", "html").drop("name")
