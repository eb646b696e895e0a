"""Tree tables and nested elements against a stack."""

from __future__ import annotations

import random
import re

from tidemark.operators import trees


def line(depth, name, key=None, value=None):
    drawn = "" if depth == 0 else "|&nbsp;" * (depth - 1) + random.choice(["+-", "`-"])
    cell = f'<td class="node"><tt>{drawn}</tt><b>{name}</b></td>' if name else "<td></td>"
    return f"<tr>{cell}" + (f'<td class="first-prop-key">{key}</td><td class="first-prop-value">{value}</td>' if key else "") + "</tr>"


def by_stack(rows):
    """position, node, parent, path, property, value of (depth, name, key, value) rows."""
    stack, out, node = [], [], None
    for i, (depth, name, key, value) in enumerate(rows):
        if key in trees.DROPPED:
            continue
        told = (key, value) if key and value.replace("&nbsp;", "").strip() else (None, None)
        if name:
            while stack and stack[-1][0] >= depth:
                stack.pop()
            stack.append((depth, i, name))
            node = (i, stack[-2][1] if len(stack) > 1 else None, "/".join(s[2] for s in stack))
        if name or told[0]:
            out.append((i, *(node or (None, None, None)), *told))
    return out


def test_tree_tables_equal_a_stack(spark):
    random.seed(3)
    docs, expected = [("none", None), ("empty", ""), ("plain", "<p>no tree</p>\n<tr>")], {}
    for d in range(12):
        rows = [("props first", None, "k0", "v0")] if d == 0 else []
        rows = [(0, None, "k0", "v0")] if rows else []
        for i in range(60):
            name = random.choice(["a", "b", "a", None])
            key, value = random.choice([(None, None), ("k", f"v{i}"), ("Opacity", "1"), ("blank", "&nbsp;")])
            rows.append((random.choice([0, 1, 2, 3, 4, 9]), name, key, value))
        docs.append((f"d{d}", "\n".join(line(*r) for r in rows)))
        expected[f"d{d}"] = by_stack(rows)
    got: dict[str, list] = {}
    table = trees.tree_table(spark.createDataFrame(docs, "doc string, html string"), "doc", "html")
    for r in table.orderBy("doc", "position").collect():
        got.setdefault(r["doc"], []).append((r["position"], r["node"], r["parent"], r["path"], r["property"], r["value"]))
    assert got == expected and any(p[0] != p[1] for p in got["d0"])


def test_elements_equal_a_stack(spark):
    random.seed(5)
    pages = [("none", None), ("empty", ""), ("wild", '</ul></li><ul class="x"><li>a<script>"<ul>"</script><LI>b<!-- <ul> --></ul><ulx></ulx>'), ("deep", "<ul>" * 300)]
    pages += [(f"p{k}", "".join(random.choice(["<ul>", "<li a='1'>", "</li>", "</ul>", "text", "<p>"]) for _ in range(200))) for k in range(8)]
    expected = set()
    for doc, html in pages:
        stack: list[tuple[int, str]] = []
        plain = re.sub(r"(?is)<script\b.*?</script>|<!--.*?-->", " ", html or "")
        for i, m in enumerate(re.finditer(r"(?i)<(/?)(ul|li)(?:\s[^>]*)?>", plain)):
            if m[1]:
                stack = stack[:-1]
            else:
                stack.append((i, m[2].lower()))
                expected.add((doc, i, len(stack) - 1, stack[-2][0] if len(stack) > 1 else None, "/".join(s[1] for s in stack)))
    tree = trees.element_tree(spark.createDataFrame(pages, "doc string, html string"), "doc", "html", ("ul", "li"))
    got = [(r["doc"], r["position"], r["depth"], r["parent"], r["path"]) for r in tree.collect()]
    assert set(got) == expected and len(got) == len(expected)


def test_outline_and_empty_tables(spark):
    html = "\n".join([line(0, "root", "k", "v"), line(1, "child"), line(0, None, "m", "n")])
    tree = trees.tree_table(spark.createDataFrame([("d", html)], "doc string, html string"), "doc", "html")
    text = [r["text"] for r in trees.outline(tree, "doc").orderBy("position", "line").collect()]
    assert text == ["root", "  k: v", "  child", "    m: n"]
    none = spark.createDataFrame([], "doc string, html string")
    assert trees.tree_table(none, "doc", "html").count() == 0 and trees.element_tree(none, "doc", "html", ("ul",)).count() == 0
