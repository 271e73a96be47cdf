"""Rejection by a language model that is trained at production size."""

import random

from tidemark.llm import langid


def test_unknown_languages_and_junk_are_rejected_at_production_size(spark):
    rng = random.Random(6)
    letters = "eeeeaaaiiioonnrrttssllddhucmpgbfvywkxjqz"
    parts = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 4))) for _ in range(60)] for lang in ("l1", "l2", "l3", "l4", "unknown")}

    def text(lang):
        return " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(20, 120)))

    known = [f"l{k}" for k in range(1, 5)]
    rows = [(k, text(known[k % 4]), known[k % 4]) for k in range(4 * 900)]  # a fourth is never learned from: over 600 a language stay
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    strange = [text("unknown"), *(" ".join("".join(rng.choice(a) for _ in range(7)) for _ in range(60)) for a in ("bcdfghjklmnpqrstvwxz", "abcdefghijklmnopqrstuvwxyz")), "жук щука выдра " * 20, "人人生而自由 在尊严和权利上一律平等 " * 5]
    mixed = [text(k % 4 and "l1" or "l2") + " " + text("l3") for k in range(8)]
    docs = [*enumerate(strange), *((100 + k, text(known[k % 4])) for k in range(40)), *((200 + k, t) for k, t in enumerate(mixed))]
    got = {r["doc_id"]: r for r in langid.predict(spark.createDataFrame(docs, "doc_id long, text string"), model).collect()}
    assert all(got[k]["rejected"] for k in range(len(strange)))
    assert not any(r["rejected"] for k, r in got.items() if k >= 100)
    assert all(got[100 + k]["lang_pred"] == known[k % 4] for k in range(40))
