"""The random field's decoding by brute force, and spans that must stay apart."""

import random

import numpy as np

from tidemark.llm import pii


def every_segmentation(table, j):
    """All lists of (first word, kind, start, end, features) that end before word j."""
    if not j:
        yield []
        return
    for one in table[j - 1]:
        for before in every_segmentation(table, one[0]):
            yield [*before, one]


def test_decoding_finds_the_best_of_all_segmentations():
    rng, trained = random.Random(4), pii.trained()
    lines = [t for t, _ in pii.training_lines(250, seed=31)]
    noise = np.random.default_rng(2)
    checked = 0
    for text in lines:
        for weights in (trained, noise.normal(0, 1, trained.shape)):
            run = next(pii.words_of(text))[:7]
            table = pii.segments(text, run)
            score = lambda way: sum(weights[k][f].sum() for _, k, _, _, f in way)  # noqa: E731, B023
            best = max(map(score, every_segmentation(table, len(run))))
            own = set(pii.decode(text, run, weights))
            reached = max(score(w) for w in every_segmentation(table, len(run)) if {(pii.KINDS[k], a, b) for _, k, a, b, _ in w if k >= 0} == own)
            assert abs(best - reached) < 1e-9
            checked += 1
    assert checked == 2 * len(lines) and rng


def test_added_spans_never_lie_on_base_spans():
    rng, weights = random.Random(11), pii.trained()
    for k in range(600):
        many = ".".join(str(rng.randint(0, 255)) for _ in range(160)) if k % 2 else ",".join(".".join(str(rng.randint(0, 255)) for _ in range(4)) for _ in range(40))
        line = rng.choice(pii.training_lines(40, seed=k % 7))[0]
        base, spans = pii.find(f"{many} {line} +1 {line}", weights)
        assert set(base) <= set(spans)
        for kind, a, b in set(spans) - set(base):
            assert not any(x < b and a < y for _, x, y in base), (kind, a, b)


#: Written by hand: personal data that the fixed patterns don't give, and things that are none.
HAND = [
    ("Please ring (212) 555-0187 before noon", "phone", "(212) 555-0187"), ("my mobile: 917-555-0142, thanks", "phone", "917-555-0142"),
    ("fax 030 123 4567", "phone", "030 123 4567"), ("Tel. 415.555.0199!", "phone", "415.555.0199"), ("call 202 555 0173 or write", "phone", "202 555 0173"),
    ("visa 4111111111111111 5500005555555559 both", "card", "4111111111111111"), ("visa 4111111111111111 5500005555555559 both", "card", "5500005555555559"),
    ("card 4111-1111-1111-1111 12", "card", "4111-1111-1111-1111"), ("7 4012888888881881 is it", "card", "4012888888881881"), ("(650) 253-0000 is the desk", "phone", "(650) 253-0000"),
]
NONE = ["in 1998 and 2003 we had 12 of 40", "ISBN 978-3-16-148410-0", "at 10:30 on 2024-05-17", "a total of 1,234,567.89 dollars", "chapter 3.2.1 section 14", "id 00000000000000001234567", "sold 350 of 400 for $19.99 each"]


def test_recall_of_added_spans_on_lines_written_by_hand():
    weights = pii.trained()
    caught = [(kind, t.index(part), t.index(part) + len(part)) in pii.find(t, weights)[1] for t, kind, part in HAND]
    assert sum(caught) >= 0.8 * len(HAND), caught
    assert [pii.find(t, weights)[1] for t in NONE] == [[]] * len(NONE)
