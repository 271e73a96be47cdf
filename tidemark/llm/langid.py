"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's subwords are the byte n-grams of its lower-cased words (with '<' and
'>' for the word's ends), hashed into ``BUCKETS`` rows of an embedding matrix.
The text is the mean of its subwords' embeddings, and a linear softmax over it
gives the language; both are trained by stochastic gradient descent in numpy.
For prediction, embeddings and output weights are multiplied out into one score
for each bucket and language, so a whole text costs one table look-up a subword.

Scores are calibrated on rows that took no part in the training: one temperature
for the softmax, and a novelty limit (how many of a text's longer grams the training
met, told in so many buckets that it can't fill them) and a score limit below which a text is rejected.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import slices

BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
#: Novelty looks at grams of at least NOVEL_GRAM bytes in far more buckets, which training leaves nearly empty.
NOVEL_BITS, NOVEL_GRAM = 24, 3
#: Grams that count as known in every text, so that a short one isn't rejected for one odd word.
KNOWN_PRIOR = 8
#: Share of the lowest calibrated known share that a text may have: calibration rows don't show every mixture and typo.
KNOWN_SLACK = 0.8
DIMENSIONS = 16
GRAMS = (1, 2, 3, 4)
#: Labelled rows that training and calibration use for each language at most (the bound of the sample).
SAMPLE_ROWS = 600
EPOCHS = 8
RATE = 0.05
BATCH = 16
#: Share of calibration rows of the right language that may be rejected.
REJECTED_SHARE = 0.002
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2

_LETTER_BYTE = np.zeros(256, bool)
_LETTER_BYTE[97:123] = True
_LETTER_BYTE[128:] = True


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod FOLDS; the fold HELD_OUT is never learned from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def subwords(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each n-gram of the words of lower-cased UTF-8 bytes, and the fine buckets of the longer ones; other bytes are word ends."""
    letters = _LETTER_BYTE[data]
    padded = np.zeros(len(data) + 2, np.uint32)
    padded[1:-1] = np.where(letters, data, 0)
    word = padded > 0
    # Symbols: a word's bytes, 1 where a word has just ended or is about to begin.
    edge = ~word & (np.append(word[1:], False) | np.append(False, word[:-1]))
    symbols = np.where(word, padded, np.where(edge, 1, 0)).astype(np.uint32)
    out, fine, code = [], [], np.zeros(len(symbols), np.uint32)
    run = np.ones(len(symbols), bool)
    for n in range(1, max(GRAMS) + 1):
        size = len(symbols) - n + 1
        if size <= 0:
            break
        code = code[:size] * np.uint32(0x01000193) ^ symbols[n - 1 :]
        # A gram lies in one word: no gap, and an edge only at its ends.
        run = run[:size] & (symbols[n - 1 :] > 0)
        if n > 2:
            run &= symbols[n - 2 : size + n - 2] > 1
        if n in GRAMS:
            own = code[run & ((symbols[:size] > 1) | (symbols[n - 1 :] > 1))]
            hashed = (own ^ np.uint32(n)) * np.uint32(0x9E3779B1)
            out.append(hashed >> np.uint32(32 - BUCKET_BITS))
            if n >= NOVEL_GRAM:
                hashed ^= hashed >> np.uint32(15)
                fine.append((hashed * np.uint32(0x85EBCA6B)) >> np.uint32(32 - NOVEL_BITS))
    none = np.zeros(0, np.uint32)
    return np.concatenate(out) if out else none, np.concatenate(fine) if fine else none


def histogram(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """How often a whole text has each bucket, and the fine bucket of each of its longer grams."""
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
    own, fine = subwords(data)
    return np.bincount(own, minlength=BUCKETS), fine


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # (buckets, languages): embeddings times output weights
    bias: np.ndarray
    seen: np.ndarray  # a bit for each fine bucket: whether the training met it
    temperature: float = 1.0
    least_score: float = 0.0
    least_seen: float = 0.0

    def logits(self, counts: np.ndarray) -> np.ndarray:
        return counts @ self.table / np.maximum(counts.sum(axis=1, keepdims=True), 1) + self.bias

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        scores = self.logits(counts) / self.temperature
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)

    def known(self, fine: np.ndarray, counts: np.ndarray | None = None) -> float:
        """Share of a text's longer grams (fine buckets, each once if counts is None) that the training met."""
        met = self.seen[fine >> 3] >> (fine & 7).astype(np.uint8) & 1
        total, own = (len(fine), met.sum()) if counts is None else (counts.sum(), (met * counts).sum())
        return float((own + KNOWN_PRIOR) / (total + KNOWN_PRIOR))


def fit(counts: np.ndarray, labels: list[str], fines: list[tuple[np.ndarray, np.ndarray]], seed: int = 0) -> Model:
    """Train on histograms by SGD; fines: (distinct fine buckets, how often) of each row. Calibration takes each third row of a language."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), np.zeros(0, np.uint8))
    place = {name: k for k, name in enumerate(languages)}
    y = np.array([place[x] for x in labels])
    nth, seen_of = np.zeros(len(y), int), dict.fromkeys(range(len(languages)), 0)
    for k, one in enumerate(y.tolist()):
        nth[k] = seen_of[one]
        seen_of[one] += 1
    held = nth % 3 == 2
    x = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1, (BUCKETS, DIMENSIONS))
    weights, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    rows = np.flatnonzero(~held)
    # Steps are divided by the root of the squared gradients so far: rare subwords get long steps.
    sum_e, sum_w = np.full(embed.shape, 1e-8), np.full(weights.shape, 1e-8)
    for epoch in range(EPOCHS):
        rate, order = RATE * (1 - epoch / EPOCHS), rng.permutation(rows)
        for at in range(0, len(rows), BATCH):
            pick = order[at : at + BATCH]
            mean = x[pick]
            hidden = mean @ embed
            logit = hidden @ weights + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            p /= len(pick)
            used = np.flatnonzero(mean.any(axis=0))
            step_e, step_w = mean[:, used].T @ (p @ weights.T), hidden.T @ p
            sum_e[used] += step_e**2
            sum_w += step_w**2
            embed[used] -= rate * step_e / np.sqrt(sum_e[used])
            weights -= rate * step_w / np.sqrt(sum_w)
            bias -= 0.1 * rate * p.sum(axis=0)
    met = np.zeros(1 << NOVEL_BITS, bool)
    for k in rows.tolist():
        met[fines[k][0]] = True
    model = Model(languages, embed @ weights, bias, np.packbits(met, bitorder="little"))
    return calibrated(model, counts[held], y[held], [fines[k] for k in np.flatnonzero(held)]) if held.any() else model


def calibrated(model: Model, counts: np.ndarray, y: np.ndarray, fines: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model with the temperature of least log loss and the limits that reject REJECTED_SHARE of right rows."""
    logits = model.logits(counts)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]))

    temperature = float(min(np.geomspace(0.05, 20, 60), key=loss))
    out = Model(model.languages, model.table, model.bias, model.seen, temperature)
    p = out.probabilities(counts)
    right = p.argmax(axis=1) == y
    if not right.any():
        return out
    # Texts of other languages lie far below the known limit. The score limit is low: texts in two or three known languages stay.
    score = float(np.quantile(p.max(axis=1)[right], REJECTED_SHARE))
    known = float(np.quantile(np.array([out.known(*f) for f in fines])[right], REJECTED_SHARE))
    return Model(out.languages, out.table, out.bias, out.seen, temperature, min(score, 1.2 / len(out.languages), 0.5), KNOWN_SLACK * known)


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[int, str]]:
    """(doc_id, lang) of at most ``rows`` learnable rows of each language, by a hash of the id.

    Only ids and labels are read here. An id with two languages can be drawn for both.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    # Twice the share that is asked for, so that a language hardly ever comes short; the rest is cut off.
    share = known.groupBy("lang").agg((1 + 2_000_000 * rows / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    out: dict[str, list[tuple[int, int]]] = {}
    for r in known.withColumn("draw", draw).join(share, "lang").filter("draw < share").select("doc_id", "lang", "draw").distinct().toLocalIterator():
        out.setdefault(r["lang"], []).append((r["draw"], r["doc_id"]))
    return [(doc, name) for name in sorted(out) for _, doc in sorted(out[name])[:rows]]


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit a model on a bounded sample of docs (doc_id, text, lang); only the chosen rows' texts go to Python, whole.

    Every language that a learnable row names is learned, so the model grows with
    their number: a row of ``BUCKETS`` scores each. Of rows with the same id and
    language, the one whose text has the least hash is taken.
    """
    chosen = sample(docs, rows)
    if not chosen:
        return fit(np.zeros((0, BUCKETS)), [], [])
    # At most ``rows`` ids a language, which is what bounds the broadcast.
    ids = docs.sparkSession.createDataFrame(chosen, "doc_id long, lang string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            if not batch.num_rows:
                continue
            both = [histogram(t) for t in batch.column(2).to_pylist()]
            sparse = [np.flatnonzero(h) for h, _ in both]
            fine = [np.unique(f, return_counts=True) for _, f in both]
            lists = (sparse, [h[k] for (h, _), k in zip(both, sparse, strict=True)], [f for f, _ in fine], [n for _, n in fine])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array([x.astype(np.int32) for x in one], pa.list_(pa.int32())) for one in lists)], names=["doc_id", "lang", "buckets", "counts", "fine", "fine_counts"])

    found: dict[tuple[int, str], tuple] = {}
    for r in texts.mapInArrow(counted, "doc_id long, lang string, buckets array<int>, counts array<int>, fine array<int>, fine_counts array<int>").toLocalIterator():
        if r["buckets"]:
            found[r["doc_id"], r["lang"]] = tuple(np.array(r[c], np.int32) for c in ("buckets", "counts", "fine", "fine_counts"))
    order = sorted(found, key=lambda k: (zlib.crc32(str(k[0]).encode()), k))
    counts = np.zeros((len(order), BUCKETS), np.float32)
    fines = []
    for k, doc in enumerate(order):
        buckets, n, *fine = found.pop(doc)
        counts[k, buckets] = n
        fines.append(tuple(fine))
    return fit(counts, [lang for _, lang in order], fines)


def verdict(text: str | None, model: Model) -> tuple[str, float, bool]:
    """(language, score, whether it is rejected) of a whole text, as predict() gives them."""
    counts, fine = histogram(text) if text and model.languages else (None, None)
    if counts is None or not counts.any() or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    p = model.probabilities(counts[None, :])[0]
    best = int(p.argmax())
    return model.languages[best], float(p[best]), bool(p[best] < model.least_score or model.known(fine) < model.least_seen)


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The columns ``keep`` of docs (doc_id if None), with lang_pred, score and rejected (after prefix), from each whole text.

    Texts that are null or without letters are UNKNOWN with score 0 and rejected; so is
    everything if the model knows no language. Other texts get the likeliest language
    and its calibrated probability, and are rejected below the calibrated limits.
    """
    keep = ["doc_id"] if keep is None else keep

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            found = [verdict(t, model) for t in batch.column(1).to_pylist()]
            columns = list(zip(*found, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.float64(), pa.bool_()), strict=True))], names=["row", "lang_pred", "score", "rejected"])

    inputs = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text").cast("string").alias("text"))
    out = inputs.mapInArrow(rows, StructType([inputs.schema["row"], *StructType.fromDDL("lang_pred string, score double, rejected boolean")]))
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], *[F.col(c).alias(prefix + c) for c in ("lang_pred", "score", "rejected")])


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs (text and any other columns) that predict() doesn't reject, whole."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([not verdict(t, model)[2] for t in texts], pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
