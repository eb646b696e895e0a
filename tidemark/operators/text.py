"""Text operators: the compact notation of indented trees, report trimming, redaction and punctuation.

The codec works on one document at a time, since back references look at everything before them; documents are spread
over tasks. The others are projections.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the notation.
RULE = "=" * 60
NOTATION = (
    "[Notation of this report]\n"
    "== Title == : a section banner.\n"
    "Indentation: one space per tree level.\n"
    "A TAB after a line starts a property (Key: value) that belongs to that line.\n"
    "Name ^A > P : this node repeats, unchanged, the earlier node Name found under the path A > P (the shortest path tail that names it unambiguously).\n"
    "@k=0..N template : N+1 sibling lines; on line k, each {a:b} slot holds the number a + k*b, and every number written plainly is the same on all lines.\n"
    "[/Notation]\n"
)
LAST_LINE = "[/Notation]\n"
#: Fixed list: characters that plain text is not to hold (en dash, em dash, minus sign).
FORBIDDEN = "–—−"

_NUMBERS = re.compile(r"-?\d+(?:\.\d+)?")
_SLOT = re.compile(r"\{(-?\d+(?:\.\d+)?):(-?\d+(?:\.\d+)?)\}")
_REPEAT = re.compile(r"@k=0\.\.(\d+) (.*)", re.S)
_PROPERTY = re.compile(r"  [^ \t:][^\t]*?: ?")
MARKS = r"\t|\{-?\d+(\.\d+)?:-?\d+(\.\d+)?\}|^ *@k=0\.\.\d+ | \^"


class NotationError(ValueError):
    """A compact text that does not decode; the message names the line."""


@dataclass
class Node:
    depth: int
    name: str
    properties: list[str] = field(default_factory=list)
    children: list[Node] = field(default_factory=list)
    parent: Node | None = None

    def path(self) -> tuple[str, ...]:
        out, at = [], self.parent
        while at is not None and at.depth >= 0:
            out.append(at.name)
            at = at.parent
        return tuple(reversed(out))

    def shape(self) -> tuple:
        return (self.name, tuple(self.properties), tuple(c.shape() for c in self.children))

    def count(self) -> int:
        return 1 + len(self.properties) + sum(c.count() for c in self.children)


def _banner(title: str) -> str:
    return f"== {title} =="


def _sections(lines: list[str]) -> Iterator[tuple[str, list[str]]]:
    """("banner", [title]) and ("body", lines) in turn."""
    body, i = [], 0
    while i < len(lines):
        if lines[i] == RULE and i + 2 < len(lines) and lines[i + 2] == RULE and lines[i + 1] != RULE:
            if body:
                yield "body", body
            yield "banner", [lines[i + 1]]
            body, i = [], i + 3
        else:
            body.append(lines[i])
            i += 1
    if body:
        yield "body", body


def _grow(lines: list[str]) -> Node:
    """The tree of a body. A node's properties are the flat "  Key: value" lines right behind it."""
    root = Node(-1, "")
    stack, last = [root], None
    for line in lines:
        blanks = len(line) - len(line.lstrip(" "))
        if last is not None and not last.children and _PROPERTY.match(line) and last.name and blanks == 2 and last.depth != 0 or last is not None and last.depth == 0 and last.name and not last.children and blanks == 2 and _PROPERTY.match(line):
            last.properties.append(line[2:])
            continue
        depth = blanks // 2 if blanks % 2 == 0 and line.strip() else 0
        text = line[2 * depth :]
        while stack[-1].depth >= depth:
            stack.pop()
        last = Node(depth, text, parent=stack[-1])
        stack[-1].children.append(last)
        stack.append(last)
    return root


def _plain(node: Node) -> Iterator[str]:
    yield "  " * node.depth + node.name
    for p in node.properties:
        yield "  " + p
    for c in node.children:
        yield from _plain(c)


def _decimals(number: str) -> int:
    return len(number.partition(".")[2])


def _as_number(value: float, like: str) -> str:
    """A number written like another: a decimal as the shortest one that reads back equal, an integer with the same zero padding."""
    if "." in like:
        return repr(value)
    digits, n = like.lstrip("-"), round(value)
    return f"{n:0{len(digits) + (n < 0)}d}" if digits.startswith("0") else str(n)


def _template(rows: list[str]) -> str | None:
    """One line with slots that stands for the rows, or None."""
    parts = [_NUMBERS.split(r) for r in rows]
    if any(p != parts[0] for p in parts) or len(set(rows)) == 1:
        return None
    columns = list(zip(*[_NUMBERS.findall(r) for r in rows], strict=True))
    out = [parts[0][0]]
    for text, column in zip(parts[0][1:], columns, strict=True):
        if len(set(column)) == 1:
            out += [column[0], text]
            continue
        step = float(column[1]) - float(column[0])
        digits = max(_decimals(c) for c in column)
        slot = f"{{{column[0]}:{step:.{digits}f}}}"
        if any(_fill(slot, k) != c for k, c in enumerate(column)):
            return None
        out += [slot, text]
    return "".join(out)


def _fill(template: str, k: int) -> str:
    return _SLOT.sub(lambda m: _as_number(float(m[1]) + k * float(m[2]), m[1]), template)


class _Seen:
    """Subtrees met so far: by name, and where a tail of the path names just one."""

    def __init__(self):
        self.by_name: dict[str, list[Node]] = {}

    def add(self, node: Node) -> None:
        self.by_name.setdefault(node.name, []).append(node)

    def tail_for(self, node: Node) -> tuple[str, ...] | None:
        same = self.by_name.get(node.name, [])
        equal = [n for n in same if n.shape() == node.shape()]
        own = node.path()
        for target in equal:
            path = target.path()
            if sum(n.path() == path for n in same) > 1:
                continue
            for k in range(1, len(path) + 1):
                tail = path[-k:]
                if sum(n.path()[-k:] == tail for n in same) == 1 and own[-k:] != tail:
                    return tail
        return None

    def find(self, name: str, tail: tuple[str, ...]) -> list[Node]:
        return [n for n in self.by_name.get(name, []) if n.path()[-len(tail) :] == tail]


def _written(node: Node, seen: _Seen) -> Iterator[str]:
    lead = " " * node.depth
    tail = seen.tail_for(node) if node.count() > 1 else None
    if tail is not None:
        yield f"{lead}{node.name} ^{' > '.join(tail)}"
        seen_later = node
        seen.add(seen_later)
        _learn(node, seen, skip_self=True)
        return
    seen.add(node)
    yield "\t".join([lead + node.name, *node.properties])
    yield from _family(node.children, seen)


def _learn(node: Node, seen: _Seen, skip_self: bool = False) -> None:
    if not skip_self:
        seen.add(node)
    for c in node.children:
        _learn(c, seen)


def _family(children: list[Node], seen: _Seen) -> Iterator[str]:
    i = 0
    while i < len(children):
        end, found = i, None
        while end < len(children) and not children[end].children:
            rows = ["\t".join([c.name, *c.properties]) for c in children[i : end + 1]]
            if len(rows) >= 3:
                t = _template(rows)
                if t is None:
                    break
                found = (end, t)
            end += 1
        if found:
            last, t = found
            yield f"{' ' * children[i].depth}@k=0..{last - i} {t}"
            for c in children[i : last + 1]:
                seen.add(c)
            i = last + 1
        else:
            yield from _written(children[i], seen)
            i += 1


def encode(text: str, header: bool = True) -> str:
    """The compact form. Refused (NotationError) if it would not decode to exactly this text."""
    if re.search(MARKS, text, re.M) or text.startswith("[Notation"):
        raise NotationError("line 1: the text holds marks of the notation already")
    out, seen = [], _Seen()
    for kind, lines in _sections(text.split("\n")):
        if kind == "banner":
            out.append(_banner(lines[0]))
        else:
            out += list(_family(_grow(lines).children, seen))
    compact = "\n".join(out)
    if decode(compact) != text:
        raise NotationError("line 1: the compact form would not decode to this text")
    return (NOTATION if header else "") + compact


def decode(text: str) -> str:
    """The plain form. References must name exactly one earlier node, templates must expand."""
    offset = 0
    if text.startswith(NOTATION[:26]):
        if not text.startswith(NOTATION):
            raise NotationError("line 1: the notation header is not the known one")
        offset, text = NOTATION.count("\n"), text[len(NOTATION) :]
    out: list[str] = []
    seen, root = _Seen(), Node(-1, "")
    stack = [root]

    def put(node: Node) -> None:
        while stack[-1].depth >= node.depth:
            stack.pop()
        node.parent = stack[-1]
        stack[-1].children.append(node)
        stack.append(node)
        _learn(node, seen)
        out.extend(_plain(node))

    for number, line in enumerate(text.split("\n"), 1 + offset):
        title = re.fullmatch(r"== (.*) ==", line)
        if title:
            out += [RULE, title[1], RULE]
            stack[1:] = []
            continue
        depth = len(line) - len(line.lstrip(" ")) if line.strip() else 0
        body = line[depth:]
        repeat = _REPEAT.fullmatch(body)
        if repeat:
            if not _SLOT.search(repeat[2]):
                raise NotationError(f"line {number}: a template without a slot")
            for k in range(int(repeat[1]) + 1):
                name, *properties = _fill(repeat[2], k).split("\t")
                put(Node(depth, name, properties))
            continue
        name, mark, tail = body.rpartition(" ^")
        if mark and "\t" not in body:
            found = seen.find(name, tuple(tail.split(" > ")))
            if len(found) != 1:
                raise NotationError(f"line {number}: the reference names {len(found)} earlier nodes")
            put(_copied(found[0], depth))
            continue
        name, *properties = body.split("\t")
        put(Node(depth, name, properties))
    return "\n".join(out)


def _copied(node: Node, depth: int) -> Node:
    new = Node(depth, node.name, list(node.properties))
    for c in node.children:
        child = _copied(c, depth + 1 + (c.depth - node.depth - 1))
        child.parent = new
        new.children.append(child)
    return new


#: Characters of texts that a worker codes at a time.
PIECE_CHARS = 2 << 20


def _codec(df: DataFrame, text: str, step) -> DataFrame:
    def pieces(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Rows in order, with at most ``PIECE_CHARS`` characters of text at a time, or a single longer one."""
        start, chars = 0, 0
        for i, t in enumerate(pdf[text]):
            size = len(t or "")
            if i > start and chars + size > PIECE_CHARS:
                yield pdf.iloc[start:i]
                start, chars = i, 0
            chars += size
        yield pdf.iloc[start:]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in itertools.chain.from_iterable(map(pieces, batches)):
            done, errors, lines = [], [], []
            for t in pdf[text]:
                try:
                    done.append(None if t is None else step(t))
                    errors.append(None)
                    lines.append(None)
                except NotationError as e:
                    done.append(None)
                    errors.append(str(e))
                    lines.append(int(re.match(r"line (\d+)", str(e))[1]))
            yield pdf.assign(result=done, error=errors, error_line=pd.array(lines, "Int64"))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", result string, error string, error_line bigint"
    return df.mapInPandas(run, schema)


def encode_column(df: DataFrame, text: str = "text") -> DataFrame:
    """result, or error and error_line, for each document."""
    return _codec(df, text, encode)


def decode_column(df: DataFrame, text: str = "text") -> DataFrame:
    return _codec(df, text, decode)


def has_marks(text: Column) -> Column:
    return text.rlike("(?m)" + MARKS)


def size_delta(before: Column, after: Column) -> Column:
    """Change of the size in percent."""
    return (F.octet_length(after) - F.octet_length(before)) * 100.0 / F.octet_length(before)


def forbidden_count(text: Column, characters: str = FORBIDDEN) -> Column:
    return F.regexp_count(text, F.lit(f"[{characters}]")).cast("bigint")


def strip_tags(html: Column) -> Column:
    """Visible text of HTML: no scripts, styles, comments, tags; blanks collapsed."""
    out = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"(?s)<[^>]*>", " "), r"[ \t\r\n]+", " "))


def keep_sections(lines: DataFrame, document: str, number: str, line: str, wanted: list[str], banner: str = r"^== (.*) ==$") -> DataFrame:
    """Lines of the wanted sections. A section runs from its banner to the next; each document is ordered by line number."""
    from pyspark.sql import Window

    title = F.nullif(F.regexp_extract(line, banner, 1), F.lit(""))
    section = F.last(title, ignorenulls=True).over(Window.partitionBy(document).orderBy(number).rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("section", section).filter(F.col("section").isin(*wanted))


def redact(line: Column, keys: list[str]) -> Column:
    """Values of the named keys become (redacted); absolute paths keep their last component."""
    out = line
    if keys:
        out = F.regexp_replace(out, r"(?i)\b(" + "|".join(re.escape(k) for k in keys) + r")(\s*[:=]\s*)[^\s&|]+", "$1$2(redacted)")
    return F.regexp_replace(F.regexp_replace(out, r"(^|[\s\"'=])/(?:[^/\s\"']+/)+([^/\s\"']+)", "$1$2"), r"\b[A-Za-z]:\\(?:[^\\\s\"']+\\)*([^\\\s\"']+)", "$1")


def version_line(line: Column) -> Column:
    """``k: v | k: v`` as a map."""
    return F.str_to_map(line, F.lit(r"\s*\|\s*"), F.lit(r":\s*"))


def html_rows(html: Column) -> Column:
    """Cells of every table row: an array of arrays of text."""
    rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1)
    cells = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), 1), lambda c: F.trim(F.regexp_replace(c, r"(?s)<[^>]*>", "")))
    return F.transform(rows, cells)
