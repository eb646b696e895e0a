"""Personal data by candidate generation and gradient boosting.

Four base patterns always count. Around them, generators with high recall propose overlapping spans: every run of
neighbouring digit groups (a phone number and a card number that stand side by side spoil each other in the base
patterns), numbers without a plus sign, spelled-out mail addresses, IPv6 addresses and long runs that may be keys or
tokens. Boosted trees score the candidates by format (digits, groups, separators, checksum, prefix) and context
(neighbours, words before); probabilities are calibrated on rows kept apart, each kind has the lowest threshold that
reaches the wanted precision there, and the best candidates that overlap neither a base span nor each other are added.
Candidates are bounded by what the formats allow: 19 digits of a card, 64 characters of a mailbox, 253 of a domain.

The trees are trained here, on sentences made from a seed: texts in which the truth is known by construction.

Cases: null text counts as empty; texts of any length take time in proportion to their length (no pattern backtracks
over a run twice) and memory for the candidates that pass their thresholds only; repeated rows are reported each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.boosting import Boosted, cautious_threshold
from tidemark.llm.common import chunks

KINDS = ("email", "ip", "card", "phone")
#: Secrets are found like personal data but told in columns of their own.
ALL_KINDS = (*KINDS, "secret")
#: Precision wanted on made-up rows, rows made, and their seed.
PRECISION, MADE, SEED = 0.995, 4000, 11
#: Most digits of a candidate, so each digit group starts a bounded number of candidates; characters of a mailbox and of a domain.
MOST_DIGITS, MAILBOX, DOMAIN = 19, 64, 253
#: Characters before a candidate that its features see, and candidates scored at once.
SEEN_BEFORE, SCORED = 24, 4096

_LOCAL, _DOMAIN = re.compile(r"[A-Za-z0-9._%+-]"), re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]*\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_REGION = re.compile(r"[+(]?[0-9](?:[ ().-]{0,3}[0-9]|[ .-]?\([0-9])*+")
_GROUP = re.compile(r"[0-9]+")
_AT = re.compile(r"(?i)\b[a-z0-9._%+-]{1,64} ?[\[(]? ?(?:@|at) ?[\])]? ?(?:[a-z0-9-]{1,63} ?[\[(]? ?(?:\.|dot) ?[\])]? ?){1,8}[a-z]{2,24}\b")
_SPELT = (" dot ", "(dot", "[dot", "( dot", "[ dot", "(at", "[at", "( at", "[ at")  # in lower case; what _MARK needs
_MARK = re.compile(r"(?i)[\[(] ?(?:at|dot) ?[\])]| dot ")
_LONG = re.compile(r"[A-Za-z0-9_/+-]{20,}={0,2}")
_SECRET = re.compile(r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|credential|bearer)|(sha|md5|digest|checksum|commit|hash|uuid|id|revision|file|path|url)")
_IP6 = re.compile(r"\b(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}\b")
_BEFORE = re.compile(r"(?i)(phone|call|tel|fax|mobile|cell)|(card|visa|credit|pay)|(mail|contact|write)|(ip|host|server|address)|(version|no|nr|number|order|id|page|section|isbn|ref)")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each @ outwards: linear even in texts without blanks."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield ("email", start, found.end())
            done = found.end()
        else:
            done = max(done, at + 1)  # what lies before this @ can't be the name before a later one
        at = text.find("@", max(done, at + 1))


def base_spans(text: str) -> list[Span]:
    """Matches of the base patterns, by start, then kind."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
        out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if 14 <= len(d := _digits(m.group())) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out, key=_order)


def _order(s: Span) -> tuple[int, int, int]:
    return s[1], ALL_KINDS.index(s[0]), s[2]


def candidates(text: str) -> Iterator[Span]:
    """Overlapping spans that might be personal data."""
    if _DIGIT.search(text):
        for region in _REGION.finditer(text):
            groups = [(m.start(), m.end()) for m in _GROUP.finditer(text, region.start(), region.end())]
            for i, (a, _) in enumerate(groups):
                n = 0
                for j in range(i, len(groups)):
                    n += groups[j][1] - groups[j][0]
                    if n > MOST_DIGITS:
                        break
                    b = groups[j][1]
                    if n >= 13:
                        yield "card", a, b
                    if 9 <= n <= 15:
                        start = a
                        while start > region.start() and text[start - 1] in "+(":
                            start -= 1
                        yield "phone", start, b
        if ":" in text:
            yield from (("ip", m.start(), m.end()) for m in _IP6.finditer(text))
    low = text.lower()
    if any(mark in low for mark in _SPELT):
        wide = MAILBOX + DOMAIN
        near = {("email", m.start(), m.end()) for mark in _MARK.finditer(text) for m in _AT.finditer(text, max(0, mark.start() - wide), mark.end() + wide)}
        yield from sorted(near, key=_order)
    yield from (("secret", m.start(), m.end()) for m in _LONG.finditer(text) if _DIGIT.search(m.group()) and not m.group().strip("0123456789-+=/_") == "")


def features(text: str, span: Span) -> list[float]:
    kind, a, b = span
    body = text[a:b]
    groups = [len(g) for g in _GROUP.findall(body)]
    digits = _digits(body)
    seps = {c for c in body if c in " .-()"}
    before, after = text[max(0, a - 1) : a], text[b : b + 1]
    clue = next((i + 1 for m in reversed(list(_BEFORE.finditer(text, max(0, a - SEEN_BEFORE), a))) for i in range(5) if m.group(i + 1)), 0)
    left, right = text[max(0, a - 2) : a], text[b : b + 2]
    told = next((i + 1 for m in reversed(list(_SECRET.finditer(text, max(0, a - SEEN_BEFORE), a))) for i in range(2) if m.group(i + 1)), 0) if kind == "secret" else 0
    return [
        ALL_KINDS.index(kind), len(digits), len(groups), groups[0] if groups else 0, groups[-1] if groups else 0,
        float(groups[-2:] == [3, 4]), float(len(groups) > 1 and set(groups[:-1]) == {4}), float(body.startswith("+")), float("(" in body), len(seps),
        float(luhn(digits)) if digits else 0.0, float(digits[:1] or 0), float(digits == digits[:1] * len(digits)), float("." in seps),
        float(before.isalnum()), float(after.isalnum()), float(bool(re.search("[0-9]", left))), float(bool(re.search("[0-9]", right))), float(left[-1:] in ".,:/=#\"'"), float(right[:1] in "/:=\"'"),
        float(clue), float("@" in body), float(bool(re.search(r"[\[(](?:at|AT)[\])]", body))), float(bool(re.search(r"(?i)[\[( ]dot[\]) ]", body))), float(len(body)), float(body.count("(") == body.count(")")),
        float(told), float(len(set(body))), float(bool(re.search("[A-Z]", body))), float(body.count("/") + body.count("-") + body.count("_")),
    ]


def _number(rng: np.random.Generator, n: int, first: str = "123456789") -> str:
    return first[rng.integers(len(first))] + "".join(map(str, rng.integers(0, 10, n - 1)))


def _card_number(rng: np.random.Generator) -> str:
    n = int(rng.choice([13, 14, 15, 16, 16, 16, 16, 19]))
    head = _number(rng, n - 1, "3456")
    return head + next(str(d) for d in range(10) if luhn(head + str(d)))


def _cut(s: str, sizes: list[int], sep: str) -> str:
    out, at = [], 0
    for k in sizes:
        out.append(s[at : at + k])
        at += k
    return sep.join([p for p in [*out, s[at:]] if p])


def made_up(rng: np.random.Generator) -> tuple[str, list[Span]]:
    """A sentence and the personal data in it."""
    word = lambda: "".join(rng.choice(list("abdehilnorstu"), int(rng.integers(2, 8))))
    text, truth = "", []

    def add(s: str, kind: str | None = None) -> None:
        nonlocal text
        if kind:
            truth.append((kind, len(text), len(text) + len(s)))
        text += s

    for _ in range(int(rng.integers(1, 4))):
        add(" ".join(word() for _ in range(int(rng.integers(2, 6)))) + " ")
        for _ in range(1 + int(rng.random() < 0.35)):
            what = int(rng.integers(0, 17))
            a, b, c = _number(rng, 3), _number(rng, 3), _number(rng, 4)
            if what < 3:
                cc = _number(rng, int(rng.integers(1, 4)))
                add(str(rng.choice([f"+{cc} ({a}) {b}-{c}", f"+{cc} {a} {b} {c}", f"+{cc}-{a}-{b}-{c}"])), "phone")
            elif what < 5:
                if rng.random() < 0.5:
                    add(str(rng.choice(["call ", "phone: ", "tel. ", "mobile "])))
                add(str(rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"])), "phone")
            elif what < 8:
                n = _card_number(rng)
                add(n if rng.random() < 0.6 else _cut(n, [4, 4, 4], str(rng.choice([" ", "-"]))), "card")
            elif what == 8:
                at, dot = rng.choice(["[at]", "(at)", "[AT]", "(At)", "@"]), rng.choice(["[dot]", "(dot)", "[DOT]", " dot "])
                form = rng.choice(["{} {} {} {} {}", "{}{}{}{}{}"])
                add(" ".join(form.format(f"{word()}{rng.integers(1, 99)}", at, word(), dot, rng.choice(["com", "org", "net"])).split()), "email")
            elif what == 13:
                add(str(rng.choice(["0049", "0033", "001"])) + " " + _cut(_number(rng, int(rng.integers(8, 12))), [2] * 4, " "), "phone")
            elif what in (14, 15):
                hexes = "".join(rng.choice(list("0123456789abcdef"), int(rng.choice([32, 40, 64]))))
                mixed = "".join(rng.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789_-"), int(rng.integers(24, 48)))) + "7"
                quote = str(rng.choice(['"', "'", ""]))
                if what == 14:
                    add(str(rng.choice(["token", "api_key", "secret", "password", "access_key", "auth"])) + str(rng.choice([" = ", "=", ": "])) + quote)
                    add(hexes if rng.random() < 0.5 else mixed, "secret")
                    add(quote)
                else:
                    add(str(rng.choice(["sha1 ", "commit ", "md5: ", "id=", "file ", ""])) + quote + str(rng.choice([hexes, f"{word()}-{word()}-{word()}-{word()}-{rng.integers(1, 99)}", f"/{word()}/{word()}/{word()}/{word()}{rng.integers(1, 9)}/{word()}"])) + quote)
            elif what == 9:
                add(f"{word()} at {word()}. {word()}")
            elif what == 10:
                add(str(rng.choice(["order ", "no. ", "id ", "isbn ", ""])) + _number(rng, int(rng.integers(7, 20))))
            elif what == 11:
                add(f"{rng.integers(1900, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)} {rng.integers(10, 24)}:{rng.integers(10, 60)}")
            elif what == 12:
                add(" ".join(_number(rng, int(rng.integers(1, 6))) for _ in range(int(rng.integers(2, 6)))))
            else:
                add(f"{rng.choice(['version ', 'section '])}{rng.integers(0, 30)}.{rng.integers(0, 30)}.{_number(rng, 7)}")
            add(" ")
    add(word())
    return text, truth


@functools.cache
def trained(made: int = MADE, seed: int = SEED, precision: float = PRECISION) -> tuple[Boosted, dict[str, float]]:
    """The trees, calibrated, and the threshold of each kind. Half of the sentences fit, a quarter calibrates, a quarter sets thresholds."""
    rng = np.random.default_rng(seed)
    parts: list[tuple[list, list, list]] = [([], [], []) for _ in range(3)]
    for i in range(made):
        text, truth = made_up(rng)
        x, y, kinds = parts[(0, 0, 1, 2)[i % 4]]
        real = set(truth)
        for c in candidates(text):
            x.append(features(text, c))
            y.append(c in real)
            kinds.append(c[0])
    (x, y, _), (cx, cy, _), (tx, ty, tk) = ((np.array(a), np.array(b, float), np.array(c)) for a, b, c in parts)
    model = Boosted().fit(x, y).calibrate(cx, cy)
    prob = model.probability(tx)
    return model, {k: cautious_threshold(prob[tk == k], ty[tk == k], precision) if (tk == k).any() else 1.0 for k in ALL_KINDS}


def _surroundings(text: str, span: Span) -> tuple[str, int, bool, str]:
    """All that :func:`features` looks at: equal ones give equal features, which saves long runs of one pattern."""
    kind, a, b = span
    first = max(0, a - SEEN_BEFORE)
    return kind, a - first, first == 0, text[first : b + 2]


def added_spans(text: str, base: list[Span], model: Boosted, least: dict[str, float]) -> list[Span]:
    """The best candidates over their thresholds that overlap no base span and none that was chosen before.

    Candidates are scored in blocks; only those over their thresholds are held, whatever the length of the text.
    """
    taken = _Busy.of(base)
    good: list[tuple[float, Span]] = []
    known: dict[tuple, float] = {}
    for block in itertools.batched(candidates(text), SCORED):
        free = [(_surroundings(text, c), c) for c in block if taken.free(c[1], c[2])]
        new = {k: c for k, c in free if k not in known}
        if new:
            if len(known) > SCORED:
                known = {k: known[k] for k, _ in free if k in known}
            known.update(zip(new, model.probability(np.array([features(text, c) for c in new.values()])).tolist(), strict=True))
        good += [(known[k], c) for k, c in free if known[k] >= least[c[0]]]
    good.sort(key=lambda g: (-g[0], g[1][1] - g[1][2], g[1][1]))
    busy = _Busy()
    return [c for _, c in good if busy.take(c[1], c[2])]


class _Busy:
    """Characters that are taken, as sorted disjoint spans."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    @classmethod
    def of(cls, spans: list[Span]) -> _Busy:
        """The union of spans, which may overlap."""
        out = cls()
        for a, b in merged(spans):
            out.starts.append(a)
            out.ends.append(b)
        return out

    def free(self, a: int, b: int) -> bool:
        at = bisect.bisect_left(self.starts, b)
        return not at or self.ends[at - 1] <= a

    def take(self, a: int, b: int) -> bool:
        if not self.free(a, b):
            return False
        at = bisect.bisect_left(self.starts, b)
        self.starts.insert(at, a)
        self.ends.insert(at, b)
        return True


def merged(spans: list[Span]) -> dict[tuple[int, int], list[str]]:
    """Disjoint stretches that overlapping spans cover together, with the kinds in each."""
    out: list[tuple[int, int, list[str]]] = []
    for kind, a, b in sorted(spans, key=_order):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2] + [kind] * (kind not in out[-1][2]))
        else:
            out.append((a, b, [kind]))
    return {(a, b): kinds for a, b, kinds in out}


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span], mark: str = "[{}]") -> str:
    """The text with every span replaced; spans that overlap are replaced together, under all their kinds."""
    out, at = [], 0
    for (a, b), kinds in merged(spans).items():
        out += [text[at:a], mark.format("/".join(kinds))]
        at = b
    return "".join([*out, text[at:]])


_RESULT = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, secrets string, n_found bigint, redacted string"


def _find(shared, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, least = shared.value
        for batch in chunks(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                all_spans = sorted(base + added_spans(text, base, model, least), key=_order)
                counts = [sum(s[0] == k for s in base) for k in KINDS]
                told = [[s for s in all_spans if (s[0] in KINDS) == personal] for personal in (True, False)]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), *map(joined, told), len(all_spans), redact(text, all_spans) if with_text else None))
            columns = zip(zip(*rows, strict=True), (pa.int64(),) * 4 + (pa.string(),) * 3 + (pa.int64(), pa.string()), strict=True)
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, t) for c, t in columns)], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "secrets", "n_found", "redacted"])

    return run


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of the base spans, spans (all personal data), secrets (spans likewise), n_found (both), and on request redacted (the text)."""
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = slim.mapInArrow(_find(shared, with_text), _RESULT)
    return out if with_text else out.drop("redacted")
