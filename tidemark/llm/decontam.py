"""Benchmark decontamination over canonical templates.

A text becomes a sequence of template tokens: numbers, units after numbers and
names are typed placeholders, other words are themselves in lower case. Windows
of ``WINDOW`` template tokens, more where these have few words, are hashed and joined
with the benchmark's; windows of few words also with their values. Windows that a
row and an item share in place are runs, and runs that follow each other in the
item and, at most ``GAP`` tokens apart, in the row are a chain. Within a chain the
values in placeholders are compared: one value of the item must always stand
against one value of the document. That finds questions that only have other
numbers, names or units, and tells them from verbatim copies.

Two templates are made of each text, one with names as placeholders and one
with names as words, since a copy in other case shows no names.

Tokenising works on the UTF-8 bytes of many texts at once with numpy; the
benchmark's window hashes go to the tasks as a filter only while there are at
most ``FILTER_WINDOWS`` of them, and otherwise every window is joined. With the
filter, windows that stand too far from others to reach any of their items'
limit are dropped before the join, so that a phrase of many items and documents
doesn't multiply.

A stretch of a document that repeats itself for longer than any chain can be has each
chain at its beginning too. Its middle has no windows; runs that reach a cut are left out,
since whole ones of the same tokens stand farther from it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, written

WINDOW = 8
#: Words that a window must have besides placeholders, or else it is longer, up to STRETCH times, or matches verbatim only.
LITERALS = 5
STRETCH = 4
#: A document is contaminated by an item if it holds this many of the item's tokens, or this share of them.
MATCH_TOKENS = 13
MATCH_SHARE = 0.5
#: Tokens that a document may have between two runs of a chain.
GAP = 32
FILTER_WINDOWS = 1_000_000
#: Unit words that are placeholders when they follow a number.
UNITS = (
    "km m cm mm mi mile miles ft foot feet inch inches yard yards kg g mg t ton tons lb lbs pound pounds oz ounce ounces l ml liter liters litre litres gallon gallons "
    "s sec second seconds ms min minute minutes h hr hour hours day days week weeks month months year years mph kmh percent pct degree degrees c f k kb mb gb tb "
    "dollar dollars usd euro euros eur cent cents w kw v hz khz mhz ghz"
).split()

_NUM, _NAME, _UNIT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_POWERS = np.cumprod(np.full(1024, 0x5851F42D4C957F2D, np.uint64))
_STEP = 0x2545F4914F6CDD1D
_CLASS = np.zeros(256, np.uint8)  # 1 digit, 2 letter
_CLASS[48:58] = 1
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 2
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?:\n\r")] = True
_HITS = "row long, id long, channel int, window long, pos int, width int, tokens int, slots array<long>, edge boolean"
#: Tokens after which a stretch that is cut repeats itself at most.
PERIODS = 64
#: A run of windows in place: where it begins and ends in the document and in the item, and the document's value for each of the item's.
Run = tuple[int, int, int, int, dict[int, int]]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each token's bytes: a polynomial over the places in the token."""
    lengths = ends - starts
    begins = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(begins, lengths)
    weighed = data[place + np.repeat(starts, lengths)].astype(np.uint64) * _POWERS[place & (len(_POWERS) - 1)]
    return _mixed(np.add.reduceat(weighed, begins) + lengths.astype(np.uint64))


@lru_cache(maxsize=1)
def _unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    lengths = np.array([len(u) for u in UNITS])
    ends = np.cumsum(lengths + 1) - 1
    return np.sort(_word_hash(data, ends - lengths, ends))


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(UTF-8 bytes, the same in lower case, where texts begin and the end) of large strings.

    A text that lower-casing makes longer or shorter is in lower case in both.
    """
    small = pc.utf8_lower(texts)
    changed = pc.not_equal(pc.binary_length(small), pc.binary_length(texts))
    if pc.any(changed).as_py():
        texts = pc.if_else(changed, small, texts)
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)])

    def data(array: pa.Array) -> np.ndarray:
        at = np.frombuffer(array.buffers()[1], np.int64)[array.offset]
        return np.frombuffer(array.buffers()[2] or b"", np.uint8)[at : at + ends[-1]]

    return data(texts), data(small), ends


def templates(data: np.ndarray, low: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each of the two templates: (text number, code, slot kind, value hash) of each token.

    data, low, offsets: as lowered() gives them. The
    slot kind is 0 for a word, 1 for a number, 2 for a unit and 3 for a name. A
    number may hold '.' and ',' between digits; a change from digits to letters ends
    a token; a name is a run of capitalised words that don't begin a sentence.
    """
    n = len(data)
    kind = _CLASS[data]
    if n > 2:
        inner = np.flatnonzero(((data[1:-1] == 46) | (data[1:-1] == 44)) & (kind[:-2] == 1) & (kind[2:] == 1)) + 1
        kind[inner] = 1
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], n)
    real = kind[starts] > 0 if n else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    if not len(starts):
        return [(np.zeros(0, np.int64),) * 4] * 2
    text = np.searchsorted(offsets, starts, side="right") - 1
    value = _word_hash(low, starts, ends)
    number = kind[starts] == 1
    after = np.zeros(len(starts), bool)  # whether the token before is of the same text
    after[1:] = text[1:] == text[:-1]
    slot = np.where(number, 1, 0).astype(np.int64)
    units = _unit_hashes()
    follows = np.flatnonzero(~number & after & np.append(False, number[:-1]))
    at = np.minimum(np.searchsorted(units, value[follows]), len(units) - 1)
    slot[follows[units[at] == value[follows]]] = 2
    stops = np.concatenate([[0], np.cumsum(_ENDS[data])])
    begins = ~after
    begins[1:] |= stops[starts[1:]] > stops[ends[:-1]]
    second = np.minimum(starts + 1, n - 1)
    capital = (data[starts] != low[starts]) | ((data[starts] >= 0xC0) & (data[second] != low[second]))
    name = (slot == 0) & capital & ~begins
    plain = (text, np.where(slot == 1, _NUM, np.where(slot == 2, _UNIT, value)), slot, value)
    runs = name & np.append(False, name[:-1]) & after
    keep = np.flatnonzero(~runs)
    slot = np.where(name, 3, slot)[keep]
    joined = np.add.reduceat(value * np.where(runs, np.uint64(_STEP), np.uint64(1)), keep)
    named = (text[keep], np.where(slot == 1, _NUM, np.where(slot == 2, _UNIT, np.where(slot == 3, _NAME, value[keep]))), slot, joined)
    return [plain, named]


def _hashes(code: np.ndarray, first: np.ndarray, width: np.ndarray, seed: int) -> np.ndarray:
    """A hash of code[first : first + width] for each window: a polynomial from running sums."""
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(code), _STEP, np.uint64)]))
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(code), pow(_STEP, -1, 1 << 64), np.uint64)]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * powers[:-1])])
    return _mixed((sums[first + width] - sums[first]) * back[first] + _mixed(width.astype(np.uint64) * np.uint64(64) + np.uint64(seed)))


def windows(text: np.ndarray, code: np.ndarray, slot: np.ndarray, value: np.ndarray, channel: int, width: int, literals: int, short: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token, tokens, hash) of all windows, each in one text.

    From each token on, the template window is the shortest that has width tokens and
    enough words, up to STRETCH times width. Where width tokens have too few words,
    these are a window with its values too, for verbatim copies. So are windows of
    the lengths in short, those of whole items; with enough words they go by template.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places = np.arange(n)
    ends = np.searchsorted(text, text, side="right")
    words = np.concatenate([[0], np.cumsum(slot == 0)])
    word_ends = np.append(np.flatnonzero(slot == 0) + 1, np.full(literals, n + 1))
    enough = word_ends[words[:-1] + literals - 1] if literals else places
    stop = np.maximum(places + width, enough)
    at = np.flatnonzero((stop <= ends) & (stop - places <= STRETCH * width))
    found = [(at, (stop - places)[at], _hashes(code, at, (stop - places)[at], channel))]
    exact = np.where(slot > 0, _mixed(value + code), code)
    for length in (width, *short):
        at = np.flatnonzero(places + length <= ends)
        few = words[at + length] - words[at] < literals
        for own, codes, kind in ((at[few], exact, 2), (at[~few] if length < width else at[:0], code, 0)):
            if len(own):
                long = np.full(len(own), length)
                found.append((own, long, _hashes(codes, own, long, channel + kind)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _near_enough(text: np.ndarray, at: np.ndarray, long: np.ndarray, need: np.ndarray, gap: int) -> np.ndarray:
    """Which windows lie in a stretch (windows of a text at most gap apart) that covers what one of its windows' items needs."""
    order = np.lexsort((at, text[at]))
    begin, owner = at[order], text[at][order]
    # Windows stay in their text, so the furthest end so far tells each text's stretches.
    end = np.maximum.accumulate(begin + long[order])
    fresh = np.ones(len(order), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (begin[1:] - end[:-1] > gap)
    covered = end - np.maximum(begin, np.append(0, end[:-1]))
    first = np.flatnonzero(fresh)
    enough = np.add.reduceat(np.maximum(covered, 0), first) >= np.minimum.reduceat(need[order], first)
    out = np.zeros(len(order), bool)
    out[order] = np.repeat(enough, np.diff(np.append(first, len(order))))
    return out


def repeats(text: np.ndarray, code: np.ndarray, value: np.ndarray, longest: int, gap: int, width: int, periods: int) -> tuple[np.ndarray, np.ndarray] | None:
    """(middle, edge): which tokens lie in the middle of a stretch that repeats itself, and which beside the middle, where a run can reach it; None where there are none.

    A chain covers at most ``longest`` tokens of an item in as many runs, so it spans
    ``longest * (1 + gap)`` tokens; a stretch keeps as many, and room for runs beside
    the cut, at both its ends.
    """
    beside = longest + STRETCH * width
    keep = longest * (1 + gap) + 2 * beside + periods
    if not len(text):
        return None
    begins = np.flatnonzero(np.diff(text, prepend=-1))
    ends = np.append(begins[1:], len(text))
    middle = edge = None
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        if b - a <= 2 * keep:
            continue
        c, v = code[a:b], value[a:b]
        for period in range(1, periods + 1):
            same = (c[period:] == c[:-period]) & (v[period:] == v[:-period])
            if np.count_nonzero(same) <= 2 * keep - period:
                continue
            change = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
            for i, j in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
                first, last = a + i + keep, a + j + period - keep
                if last > first:
                    middle, edge = (np.zeros(len(text), bool), np.zeros(len(text), bool)) if middle is None else (middle, edge)
                    middle[first:last] = True
                    edge[first - beside : first] = edge[last : last + beside] = True
    return None if middle is None else (middle, edge & ~middle)


def _rows(width: int, literals: int, known: np.ndarray | None, short: tuple[int, ...] | None, need: np.ndarray | None, gap: int, longest: int, periods: int):
    table = None
    if known is not None:
        table = np.zeros(1 << 22, bool)
        table[known >> np.uint64(42)] = True

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            data, low, offsets = lowered(batch.column(2).fill_null("").cast(pa.large_string()))
            out = []
            for channel, (text, code, slot, value) in enumerate(templates(data, low, offsets)):
                code, value = code.astype(np.uint64), value.astype(np.uint64)
                at, long, hashes = windows(text, code, slot, value, channel, width, literals, short or ())
                cut = repeats(text, code, value, longest, gap, width, periods) if short is not None else None
                if cut:
                    left = np.flatnonzero(~cut[0][at])
                    at, long, hashes = at[left], long[left], hashes[left]
                if table is not None:
                    hit = np.flatnonzero(table[hashes >> np.uint64(42)])
                    place = np.minimum(np.searchsorted(known, hashes[hit]), len(known) - 1)
                    real = known[place] == hashes[hit]
                    hit, place = hit[real], place[real]
                    if need is not None and len(hit):
                        hit = hit[_near_enough(text, at[hit], long[hit], need[place], gap)]
                    at, long, hashes = at[hit], long[hit], hashes[hit]
                begin = np.searchsorted(text, text[at])
                total = np.searchsorted(text, text[at], side="right") - begin
                if short is None:  # items: a short one is a window as a whole
                    for length in range(1, width):
                        whole = np.flatnonzero(np.diff(text, prepend=-1) != 0)
                        whole = whole[np.searchsorted(text, text[whole], side="right") - whole == length]
                        own = windows(text, code, slot, value, channel, width, literals, (length,)) if len(whole) else None
                        if own is not None:
                            pick = np.isin(own[0], whole) & (own[1] == length)
                            at, long, hashes = (np.concatenate([x, y[pick]]) for x, y in zip((at, long, hashes), own, strict=True))
                            begin, total = np.concatenate([begin, own[0][pick]]), np.concatenate([total, own[1][pick]])
                if not len(at):
                    continue
                slots = np.concatenate([[0], np.cumsum(slot > 0)])
                values = value[slot > 0].view(np.int64)
                lists = [values[a:b] for a, b in zip(slots[at].tolist(), slots[at + long].tolist(), strict=True)]
                owner = pa.array(text[at])
                out.append(pa.RecordBatch.from_arrays(
                    [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(np.full(len(at), channel), pa.int32()), pa.array(hashes.view(np.int64)), pa.array((at - begin).astype(np.int32)), pa.array(long.astype(np.int32)), pa.array(total.astype(np.int32)), pa.array(lists, pa.list_(pa.int64())), pa.array(cut[1][at] if cut else np.zeros(len(at), bool))],
                    names=[x.split()[0] for x in _HITS.split(", ")],
                ))
            yield from out

    return rows


def template_windows(texts: DataFrame, width: int = WINDOW, literals: int = LITERALS, known: np.ndarray | None = None, short: tuple[int, ...] | None = None, need: np.ndarray | None = None, gap: int = GAP, longest: int = 0) -> DataFrame:
    """(row, id, channel, window, pos, width, tokens, slots, edge) of the windows of texts (id, text), or of those whose hash is in known (sorted).

    row: a number for each row of texts; width: tokens of the window; tokens: template
    tokens of the whole text; slots: value hashes in the window's placeholders, in order.
    short: lengths of further windows, or None for items, of which one under width tokens
    is a window as a whole. need: for each of known, the tokens that its windows must
    cover together with others near by. longest: tokens of the longest item, for repeats().
    Texts without a token have no window.
    """
    columns = texts.select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return columns.mapInArrow(_rows(width, literals, known, short, need, gap, longest, PERIODS), _HITS)


def _joined(windows: list[dict]) -> list[tuple[int, int, list[dict]]]:
    """(first, end, windows) of stretches of overlapping or touching windows of one shift, in places of the item."""
    out: list[tuple[int, int, list[dict]]] = []
    for w in sorted(windows, key=lambda w: (w["item_pos"], w["width"])):
        end = w["item_pos"] + w["width"]
        if out and w["item_pos"] <= out[-1][1]:
            first, before, own = out.pop()
            out.append((first, max(before, end), [*own, w]))
        else:
            out.append((w["item_pos"], end, [w]))
    return out


def _values(windows: list[dict]) -> dict[int, int] | None:
    """The document's value for each of the item's values, or None where one stands against two."""
    out: dict[int, int] = {}
    for w in windows:
        for theirs, ours in zip(w["item_slots"], w["slots"], strict=True):
            if out.setdefault(theirs, ours) != ours:
                return None
    return out


def runs(hits: list[dict]) -> list[Run]:
    """The runs of an item's windows in one row; where a run's values aren't consistent, those of its windows that have the very same values."""
    shifts: dict[int, list[dict]] = {}
    for h in hits:
        shifts.setdefault(h["pos"] - h["item_pos"], []).append(h)
    out = []
    for shift, own in shifts.items():
        for first, end, inside in _joined(own):
            if any(w["edge"] for w in inside):
                continue  # beside a cut; a whole run of the same tokens stands elsewhere
            values = _values(inside)
            if values is not None:
                out.append((first + shift, end + shift, first, end, values))
                continue
            for a, b, same in _joined([w for w in inside if w["item_slots"] == w["slots"]]):
                out.append((a + shift, b + shift, a, b, _values(same) or {}))
    return out


def chained(hits: list[dict], gap: int = GAP) -> tuple[int, bool]:
    """(tokens, whether some value differs) of the best chain of runs.

    A run may follow another if it begins and ends later in both the row and the item,
    lies at most gap tokens behind it in the row, and their values are consistent; what
    two runs both cover counts once. The chain to each run goes on from the best chain
    that may go before it.
    """
    best: list[tuple[int, bool, dict[int, int]]] = []
    ordered = sorted(runs(hits), key=lambda r: (r[0], r[2], r[1]))
    longest = max((r[1] - r[0] for r in ordered), default=0)
    for k, (p1, p2, q1, q2, own) in enumerate(ordered):
        state = (p2 - p1, any(t != o for t, o in own.items()), own)
        for j in range(k - 1, -1, -1):
            a1, a2, b1, b2, _ = ordered[j]
            if p1 - a1 > gap + longest:
                break
            fresh = p2 - p1 - max(0, a2 - p1, b2 - q1)
            if a1 < p1 and a2 < p2 and b1 < q1 and b2 < q2 and p1 - a2 <= gap and fresh > 0:
                tokens, other, values = best[j]
                if (tokens + fresh, not (other or state[1])) > (state[0], not state[1]) and all(values.get(t, o) == o for t, o in own.items()):
                    merged = {**values, **own}
                    state = (tokens + fresh, any(t != o for t, o in merged.items()), merged)
        best.append(state)
    tokens, other, _ = max(best, key=lambda s: (s[0], not s[1]), default=(0, False, {}))
    return tokens, other


def _chains(gap: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [chained(h, gap) for h in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([n for n, _ in found], pa.int64()), pa.array([o for _, o in found], pa.bool_())], names=["doc_id", "item_id", "item_tokens", "matched_tokens", "reparameterised"])

    return rows


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, literals: int = LITERALS, match_tokens: int = MATCH_TOKENS, match_share: float = MATCH_SHARE, gap: int = GAP) -> DataFrame:
    """(doc_id, item_id, matched_tokens, item_tokens, reparameterised) of each document that holds a benchmark item.

    docs: doc_id, text; benchmark: item_id, text; other columns are ignored. A row
    holds an item if a chain of windows, in the item's order and at most gap tokens
    apart, covers match_tokens tokens or match_share of it, whichever is less. In a
    chain the values in placeholders are a function of the item's; where they aren't,
    only windows of the very same values count. reparameterised: some value differs.
    An item shorter than a window matches as a whole only. Null texts match nothing;
    each row is judged by itself, and rows of one doc_id, null too, give one result
    for each item, the best; empty tables give no rows.
    """
    items = written(template_windows(benchmark.select(F.col("item_id").alias("id"), "text"), width, literals), "item-windows")
    least = F.least(F.lit(float(match_tokens)), match_share * F.col("tokens"))
    distinct = items.groupBy("window").agg(F.min(least).alias("need"))
    known = need = None
    if distinct.count() <= FILTER_WINDOWS:
        table = distinct.toArrow()
        known = table.column(0).to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(known)
        known, need = (known[order], table.column(1).to_numpy()[order]) if len(known) else (np.zeros(1, np.uint64), np.zeros(1))
    short = tuple(sorted(r[0] for r in items.filter(F.col("width") < width).select("width").distinct().collect()))
    longest = items.agg(F.max("tokens")).first()[0] or 0
    found = template_windows(docs.select(F.col("doc_id").alias("id"), "text"), width, literals, known, short, need, gap, longest)
    mine = items.select("channel", "window", F.col("row").alias("item_row"), F.col("id").alias("item_id"), F.col("pos").alias("item_pos"), F.col("tokens").alias("item_tokens"), F.col("slots").alias("item_slots"))
    hit = F.struct("pos", "width", "slots", "edge", "item_pos", "item_slots")
    hits = found.join(mine, ["channel", "window"]).groupBy("row", "channel", "item_row").agg(F.first("id").alias("doc_id"), F.first("item_id").alias("item_id"), F.first("item_tokens").cast("long").alias("item_tokens"), F.collect_set(hit).alias("hits"))
    chains = hits.select("doc_id", "item_id", "item_tokens", "hits").mapInArrow(_chains(gap), "doc_id long, item_id long, item_tokens long, matched_tokens long, reparameterised boolean")
    held = chains.filter(F.col("matched_tokens") >= F.least(F.lit(float(match_tokens)), match_share * F.col("item_tokens")))
    best = held.groupBy("doc_id", "item_id").agg(F.max(F.struct("matched_tokens", (~F.col("reparameterised")).alias("plain"), "item_tokens")).alias("best"))
    return best.select("doc_id", "item_id", "best.matched_tokens", "best.item_tokens", (~F.col("best.plain")).alias("reparameterised"))
