"""Sinks for the small, byte-exact files of an artifact: planes, signals, JSON, archives. They take at most a few thousand rows."""

from __future__ import annotations

import json
import os
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame

#: Rows that a file of this kind may have; more is an error, not a truncation.
MOST_ROWS = 200_000


def fixed(value: float, digits: int = 3) -> str:
    """C-style fixed notation without a negative zero."""
    text = f"{value:.{digits}f}"
    return text[1:] if text.startswith("-") and not text.strip("-0.") else text


def general(value: float, digits: int = 6) -> str:
    """C-style %g."""
    return f"{value + 0.0:.{digits}g}"


def _rows(df: DataFrame) -> list:
    rows = df.limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows for one text file")
    return rows


def _replace(path: str, text: str) -> None:
    handle, own = tempfile.mkstemp(dir=os.path.dirname(os.path.abspath(path)))
    with os.fdopen(handle, "w", encoding="utf-8", newline="\n") as f:
        f.write(text)
    os.replace(own, path)


def write_plane(df: DataFrame, path: str, a: str, b: str, fields: list[str], header: str, digits: int = 3) -> None:
    """Comment header, names, rows sorted by (b, a), fixed precision."""
    lines = [f"# {header}", ",".join([a, b, *fields])]
    lines += [",".join(fixed(r[c], digits) for c in (a, b, *fields)) for r in _rows(df.select(a, b, *fields).orderBy(b, a))]
    _replace(path, "\n".join(lines) + "\n")


def write_signals(df: DataFrame, path: str, order: str, columns: dict[str, str]) -> None:
    """One comment line per column saying how it is formed, then rows in %.6g."""
    lines = [f"# {c}: {how}" for c, how in columns.items()] + [",".join(columns)]
    lines += [",".join("" if r[c] is None else general(r[c]) for c in columns) for r in _rows(df.select(*columns).orderBy(order))]
    _replace(path, "\n".join(lines) + "\n")


def write_json(value: object, path: str) -> None:
    """Indent 2, key order kept, final newline, no NaN."""
    _replace(path, json.dumps(value, indent=2, ensure_ascii=False, allow_nan=False) + "\n")


def write_zip(root: str, path: str) -> None:
    """Sorted entries with a fixed time stamp and mode: the same files give the same bytes."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(Path(root).rglob("*")):
            if f.is_file():
                info = zipfile.ZipInfo(f.relative_to(root).as_posix(), (1980, 1, 1, 0, 0, 0))
                info.external_attr, info.compress_type = 0o644 << 16, zipfile.ZIP_DEFLATED
                z.writestr(info, f.read_bytes())


def archive_previous(path: str) -> str | None:
    """Move what is there aside, as path_2, path_3, ...; returns the new name."""
    if not os.path.exists(path):
        return None
    k = 2
    while os.path.exists(f"{path}_{k}"):
        k += 1
    os.rename(path, f"{path}_{k}")
    return f"{path}_{k}"


def whitelist_copy(source: str, target: str, declared: list[str]) -> list[str]:
    """Copy the files whose relative paths fully match a declared pattern, by way of a staging folder; what was there moves aside.

    Returns the copied paths. A pattern without a file is an error, and then nothing changes.
    """
    names = sorted(f.relative_to(source).as_posix() for f in Path(source).rglob("*") if f.is_file())
    lost = [p for p in declared if not any(re.fullmatch(p, n) for n in names)]
    if lost:
        raise FileNotFoundError(f"declared but not there: {', '.join(lost)}")
    chosen = [n for n in names if any(re.fullmatch(p, n) for p in declared)]
    staging = Path(f"{target.rstrip('/')}.staging-{os.getpid()}")
    for n in chosen:
        (staging / n).parent.mkdir(parents=True, exist_ok=True)
        shutil.copyfile(Path(source) / n, staging / n)
    archive_previous(target.rstrip("/"))
    os.rename(staging, target.rstrip("/"))
    return chosen


def _shown(value: object) -> str:
    return "" if value is None else f"{value:.6g}" if isinstance(value, float) else str(value)


def report_text(df: DataFrame) -> str:
    """An aligned table: a header line, then a line per row; numbers to the right."""
    rows = _rows(df)
    cells = [[_shown(v) for v in r] for r in rows]
    numeric = [any(isinstance(r[k], (int, float)) for r in rows) for k in range(len(df.columns))]
    wide = [max(len(x) for x in column) for column in zip(df.columns, *cells, strict=True)]
    line = lambda row: "  ".join(c.rjust(w) if right else c.ljust(w) for c, w, right in zip(row, wide, numeric, strict=True)).rstrip()
    return "\n".join([line(df.columns), *map(line, cells)]) + "\n"


def report_markdown(df: DataFrame, title: str | None = None) -> str:
    lines = [f"## {title}", ""] if title else []
    lines += ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join(_shown(v).replace("|", "\\|") for v in r) + " |" for r in _rows(df)]
    return "\n".join(lines) + "\n"


def report_json(df: DataFrame) -> str:
    """The rows as a list of objects, columns in order."""
    return json.dumps([r.asDict(recursive=True) for r in _rows(df)], indent=2, ensure_ascii=False, default=str) + "\n"


REPORTS = {"text": report_text, "markdown": report_markdown, "json": report_json}


def settle(measure, write, rounds: int = 5):
    """Repeat measuring and writing until the measure no longer changes."""
    before = None
    for _ in range(rounds):
        now = measure()
        if now == before:
            return now
        write(now)
        before = now
    raise ValueError(f"no fixed point after {rounds} rounds")
