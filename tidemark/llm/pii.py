"""Personal data by a semi-Markov conditional random field beside fixed patterns.

Fixed patterns give the base spans. They take the leftmost run of characters and
don't try again where its check fails, so they miss a card number beside another
number, or a phone number without a country code. The random field adds such
spans: runs of words that hold digits or '@' are cut into segments by dynamic
programming over whole-span features (checksum, ranges, shape, length, the cue
word before), which chooses boundaries and types jointly. A segment of a type
has at most ``MAX_WORDS`` words and ``MAX_CHARS`` characters; all other words are
segments of no type, and a text without digits or '@' needs no decoding.

Weights are trained here by the gradient of the log-likelihood on generated
lines, whose parts and seed are fixed.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

KINDS = ("email", "ip", "card", "phone")
MAX_WORDS = 6
MAX_CHARS = 64
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: The lookbehinds change no match: a digit run is always taken to its end, so none begins inside one.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """The local part of an address is the whole run of its characters before '@', from the last match's end on."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns: leftmost matches of each kind that pass its check."""
    out: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _TRIGGER.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0]) if m.end() - m.start() <= 2 * 19 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


_TRIGGER = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@]")
_WORD_END = re.compile(r"\s")
_LEAD, _TAIL = re.compile(r"[^A-Za-z0-9+(]*"), re.compile(r"[^A-Za-z0-9)]*\Z")
_QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_DATE = re.compile(r"[0-9]{1,4}([-/.])[0-9]{1,2}\1[0-9]{1,4}")
_GROUPED = re.compile(r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}")
_CALLED = re.compile(r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,5}){1,4}")
#: Words that announce a kind.
CUES = {
    "email": ("email", "e-mail", "mail", "contact"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
}
FEATURES = 30


def words_of(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring words (start, end) that hold a digit or '@', with a single space between."""
    run: list[tuple[int, int]] = []
    at, m = 0, _MARK.search(text)
    while m:
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        stop = _WORD_END.search(text, m.end())
        end = stop.start() if stop else len(text)
        if run and not (start == run[-1][1] + 1 and text[start - 1] == " "):
            yield run
            run = []
        run.append((start, end))
        at, m = end, _MARK.search(text, end)
    if run:
        yield run


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without marks at its ends that belong to the sentence."""
    if end - start > 4 * MAX_CHARS:
        return start, start
    part = text[start:end]
    lead = _LEAD.match(part).end()
    tail = _TAIL.search(part).start()
    return (start + lead, start + tail) if lead < tail else (start, start)


def features(span: str, words: int, cue: str) -> tuple[list[int], tuple[bool, ...]]:
    """(active features of a whole span, whether each kind may have it)."""
    digits = _digits(span)
    n, letters = len(digits), any(c.isalpha() for c in span)
    plain = not letters and all(c in "0123456789 -" for c in span)
    dialled = not letters and all(c in "0123456789 -().+" for c in span)
    quad = _QUAD.fullmatch(span) is not None
    inside = quad and all(int(p) <= 255 for p in span.split("."))
    sums = n >= 13 and luhn(digits)
    flags = (
        True, words == 1, words == 2, words == 3, words >= 4, "@" in span, _ADDRESS.fullmatch(span) is not None,
        n < 7, 7 <= n <= 8, 9 <= n <= 11, 12 <= n <= 15, n == 16, 17 <= n <= 19, n > 19, plain, dialled, span.startswith("+"), "(" in span,
        sums, sums and plain and 13 <= n <= 19, quad, inside, letters, span.isdigit(), _GROUPED.fullmatch(span) is not None, _DATE.fullmatch(span) is not None,
        dialled and _CALLED.fullmatch(span) is not None, dialled and span.count("(") != span.count(")"),
        cue in CUES["phone"], cue in CUES["card"],
    )
    may = ("@" in span, span.count(".") == 3 and n >= 4 and not letters, plain and 12 <= n <= 19, dialled and 7 <= n <= 15)
    return [k for k, on in enumerate(flags) if on], may


def segments(text: str, run: list[tuple[int, int]]) -> list[list[tuple[int, int, int, int, list[int]]]]:
    """For each end word: (first word, kind or -1, start, end, features) of the segments that end there."""
    before = text[max(0, run[0][0] - 24) : run[0][0]].split()
    out = []
    for j in range(len(run)):
        here = []
        for i in range(j, max(-1, j - MAX_WORDS), -1):
            start, end = trimmed(text, run[i][0], run[j][1])
            cue = (before[-1] if before else "").strip(":.,;()").lower() if i == 0 else ""
            fits = 0 < end - start <= MAX_CHARS
            active, may = features(text[start:end], j - i + 1, cue) if fits else ([0], (False,) * 4)
            if i == j:
                here.append((i, -1, start, end, active))
            here += [(i, k, start, end, active) for k in range(len(KINDS)) if may[k]]
            if end - start > MAX_CHARS:
                break
        out.append(here)
    return out


def decode(text: str, run: list[tuple[int, int]], weights: np.ndarray) -> list[Span]:
    """The typed segments of the best segmentation of a run of words."""
    table = segments(text, run)
    if all(k < 0 for here in table for _, k, *_ in here):
        return []
    rows = weights.tolist()
    best, back = [0.0], []
    for here in table:
        top = max(((best[i] + sum(rows[k][f] for f in active), i, k, start, end) for i, k, start, end, active in here), key=lambda x: (x[0], x[1]))
        best.append(top[0])
        back.append(top[1:])
    out, j = [], len(table)
    while j:
        i, k, start, end = back[j - 1]
        if k >= 0:
            out.append((KINDS[k], start, end))
        j = i
    return out[::-1]


def gradient(text: str, gold: set[Span], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """(log-likelihood, its gradient) of the gold spans of a one-run text; the last row of weights is for no type."""
    (run,) = words_of(text)
    table = segments(text, run)
    n, scores = len(table), []
    for here in table:
        scores.append([float(weights[k][active].sum()) for _, k, _, _, active in here])

    def joined(values: list[float]) -> float:
        top = max(values, default=-math.inf)
        return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top

    ahead = [0.0]
    for here, own in zip(table, scores, strict=True):
        ahead.append(joined([ahead[i] + s for (i, *_), s in zip(here, own, strict=True)]))
    behind: list[list[float]] = [[] for _ in range(n)] + [[0.0]]
    after = [0.0] * (n + 1)
    for j in range(n, 0, -1):
        after[j] = joined(behind[j])
        for (i, *_), s in zip(table[j - 1], scores[j - 1], strict=True):
            behind[i].append(after[j] + s)
    out, fit = np.zeros_like(weights), -ahead[n]
    covered = {p for _, a, b in gold for p in range(a, b)}
    for j, (here, own) in enumerate(zip(table, scores, strict=True)):
        for (i, k, start, end, active), s in zip(here, own, strict=True):
            out[k][active] -= math.exp(ahead[i] + s + after[j + 1] - ahead[n])
            chosen = (KINDS[k], start, end) in gold if k >= 0 else not any(p in covered for p in range(start, end))
            if chosen:
                out[k][active] += 1
                fit += s
    return fit, out


def training_lines(count: int = 700, seed: int = 7) -> list[tuple[str, set[Span]]]:
    """Generated lines of one run of words each, with their spans."""
    rng = random.Random(seed)

    def number(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card() -> str:
        body = rng.choice("3456") + number(14)
        whole = next(body + c for c in "0123456789" if luhn(body + c))
        gap = rng.choice(["", "", " ", "-"])
        return gap.join(whole[k : k + 4] for k in range(0, 16, 4))

    def phone() -> str:
        a, b, c = rng.choice("23456789") + number(2), number(3), number(4)
        return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{rng.randint(1, 99)} {a} {b}{c}", f"{a} {b} {c}", f"{a}.{b}.{c}", f"+{number(11)}"])

    made = {
        "email": lambda: f"{rng.choice(['a', 'jo.doe', 'x', 'info'])}{rng.choice(['', number(2)])}@{rng.choice(['mail', 'a1', 'box7'])}.example.{rng.choice(['com', 'org', 'de'])}",
        "ip": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        "card": card,
        "phone": phone,
    }
    other = (
        lambda: number(rng.randint(1, 6)), lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 9)}", lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: "1" + number(rng.randint(6, 11)), lambda: next(x for x in iter(lambda: "2" + number(15), "") if not luhn(x)), lambda: number(rng.randint(20, 30)), lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}",
        lambda: f"{rng.randint(256, 999)}.{rng.randint(0, 999)}.{rng.randint(0, 999)}.{rng.randint(256, 999)}", lambda: f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}", lambda: f"{rng.randint(10, 23)}:{rng.randint(10, 59)}",
        lambda: f"v{number(2)}", lambda: f"@{rng.choice(['home', 'you2'])}", lambda: "".join(rng.choice("0123456789abcdef") for _ in range(39)) + "1", lambda: f"${number(3)},{number(3)}",
    )
    out = []
    for _ in range(count):
        parts, spans, at = [], set(), 0
        cue = rng.choice(["", "", "the ", "number: "])
        kinds = [rng.choice([*KINDS, "", ""]) for _ in range(rng.choice([1, 1, 2, 3]))]
        if rng.random() < 0.3 and kinds[0]:
            cue = rng.choice(CUES[kinds[0]]) + " "
        text = cue
        for k, kind in enumerate(kinds):
            at = len(text) + (k > 0)
            body = made[kind]() if kind else rng.choice(other)()
            if kind:
                spans.add((kind, at, at + len(body)))
            text += " " * (k > 0) + body
        text += rng.choice(["", "", ".", "!!", ",", "###"]) if not parts else ""
        if len(list(words_of(text))) == 1:
            out.append((text, spans))
    return out


@lru_cache(maxsize=1)
def trained(epochs: int = 12, rate: float = 0.3) -> np.ndarray:
    """Weights (kinds and no type, features) after gradient steps over the generated lines."""
    weights, squares = np.zeros((len(KINDS) + 1, FEATURES)), np.full((len(KINDS) + 1, FEATURES), 1e-6)
    lines = training_lines()
    for epoch in range(epochs):
        random.Random(epoch).shuffle(lines)
        for text, spans in lines:
            _, step = gradient(text, spans, weights)
            step -= 1e-3 * weights
            squares += step**2
            weights += rate * step / np.sqrt(squares)
    return weights


def united(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """(starts, ends) of the stretches that spans cover together, in order and apart."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def find(text: str | None, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a whole text, each by kind and then start; added spans don't touch base ones."""
    text = text or ""
    base = base_spans(text)
    if "@" not in text and not _TRIGGER.search(text):
        return base, base
    starts, ends = united([(a, b) for _, a, b in base])
    added = []
    for run in words_of(text):
        for span in decode(text, run, weights):
            before = bisect_left(starts, span[2])  # the base spans from here on begin at or after the span's end
            if not before or ends[before - 1] <= span[1]:
                added.append(span)
    order = {kind: n for n, kind in enumerate(KINDS)}
    return base, sorted({*base, *added}, key=lambda s: (order[s[0]], s[1], s[2]))


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of each row of docs (doc_id, text).

    Counts and base_sha256 are of the base spans; spans lists all of them. Null and
    empty texts have none. Rows come out as often as they come in.
    """
    weights = trained() if weights is None else weights

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text in batch.column(1).to_pylist():
                base, spans = find(text, weights)
                out.append((*(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(written_out(base).encode()).hexdigest(), written_out(spans)))
            if out:
                kinds = [pa.int64()] * 4 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str | None, weights: np.ndarray) -> str | None:
    """The text with each span replaced by its kind in angle brackets; overlapping spans are one."""
    if text is None:
        return None
    spans = sorted(find(text, weights)[1], key=lambda s: (s[1], -s[2]))
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join(out) + text[at:]
