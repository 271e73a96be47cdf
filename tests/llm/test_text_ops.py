"""Decontamination, SimHash, language ID, PII and the pipeline against brute force, on small tables."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
import xxhash

from tidemark.llm import decontam, langid, pii, simhash

DOCS = "doc_id long, text string"
ODD = [(900, None), (901, ""), (902, "   \t\n"), (903, "!!!"), (904, "x" * 300_000), (905, "a b"), (905, "a b"), (None, "orphan text of a row without id")]


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(words))


# SimHash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, distance):
    parent = list(range(len(ids)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(ids)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= distance:
                x, y = find(a), find(b)
                parent[max(x, y, key=lambda k: ids[k])] = min(x, y, key=lambda k: ids[k])
    return {i: ids[find(k)] for k, i in enumerate(ids)}


@pytest.mark.parametrize("text", [None, "", " ", "One", "ÀB cd\x0bef\u00a0x gh", "a b c d e f g A B C D " * 50, "w" * 5000])
def test_fingerprint_is_the_brute_force_one(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(3)
    rows = [(k, prose(rng, 60)) for k in range(40)]
    for k in range(60):  # near copies, chains of them, and exact ones
        base = rows[rng.randrange(len(rows))][1].split()
        for _ in range(rng.choice([0, 1, 1, 2])):
            base[rng.randrange(len(base))] = "changed"
        rows.append((100 + k, " ".join(base)))
    rows += ODD
    got = simhash.near_duplicates(spark.createDataFrame([(a, b, "x") for a, b in rows], DOCS + ", fp string")).collect()
    assert len(got) == len(rows)
    unique = {i: t for i, t in rows if i is not None}
    prints = [brute_fingerprint(t) for t in unique.values()]
    want = brute_components(list(unique), prints, 4)
    for r in got:
        if r["doc_id"] is not None:
            assert (r["fingerprint"], r["component_id"]) == (f"{brute_fingerprint(unique[r['doc_id']]):016x}", want[r["doc_id"]])


def test_links_of_many_close_fingerprints_match_brute_force(spark):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(120)}
    for v in list(values)[:60]:
        for _ in range(6):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 3, 4, 5, 8]))))
    hub = rng.getrandbits(64)
    values |= {hub ^ (1 << a) ^ (1 << b) for a in range(14) for b in range(a)}  # a dense group
    values = sorted(values)
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, k) for k, v in enumerate(values)], "fp long, rep long")
    got = {r["fp"] % (1 << 64): r["component"] for r in simhash.link_components(nodes).collect()}
    want = brute_components(list(range(len(values))), values, 4)
    assert got == {v: want[k] for k, v in enumerate(values)}


@pytest.mark.parametrize(("m", "distance"), [(5, 4), (6, 4), (7, 4), (8, 4), (9, 4), (6, 2), (3, 0)])
def test_each_link_has_a_key_whose_chain_holds(spark, m, distance):
    rng = random.Random(m)
    values = []
    for k in range(200):
        v = rng.getrandbits(64)
        values += [(v, 2 * k), (v ^ sum(1 << b for b in rng.sample(range(64), k % (distance + 1))), 2 * k + 1)]
    grouped = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, c) for v, c in values], "fp long, comp long")
    from pyspark.sql import functions as F

    pairs, rest = simhash.candidates(grouped, m, distance)
    x = F.col("fp_a").bitwiseXOR(F.col("fp_b"))
    held = pairs.filter(simhash.chain_condition(x, F.col("start"), m, distance)).collect()
    assert {k // 2 for k in range(400)} == {r["comp_a"] // 2 for r in held if r["comp_a"] // 2 == r["comp_b"] // 2}
    assert rest.isEmpty()


def test_dense_buckets_go_on_to_wider_keys(spark):
    rng = random.Random(12)
    # Half of the bits are the same everywhere, so narrow keys are full of fingerprints that aren't linked.
    low = rng.getrandbits(32)
    values = {rng.getrandbits(32) << 32 | low for _ in range(150)}
    values |= {v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in list(values)[:60]}
    values = sorted(values)
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, k) for k, v in enumerate(values)], "fp long, rep long")
    got = {r["fp"] % (1 << 64): r["component"] for r in simhash.link_components(nodes, dense=3).collect()}
    want = brute_components(list(range(len(values))), values, 4)
    assert got == {v: want[k] for k, v in enumerate(values)} and len(set(want.values())) > 100


def test_near_duplicates_of_an_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


# Decontamination

ITEM = "The train leaves Berlin with Alice at 5 km per hour and meets 17 other people near the big old station before Alice counts 5 more apples again"


def contaminated(spark, docs, items=((1, ITEM), (2, None), (3, "too short"), (4, ITEM + " and then one goes home to sleep"))):
    got = decontam.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(list(items), "item_id long, text string")).collect()
    return {(r["doc_id"], r["item_id"]): r for r in got}


def test_verbatim_reparameterised_and_clean_documents(spark):
    rng = random.Random(1)
    around = lambda t: f"{prose(rng, 30)}. {t} {prose(rng, 30)}"
    other = ITEM.replace("Alice", "Bob Stone").replace("5", "88").replace("17", "3").replace("Berlin", "Rome")
    got = contaminated(spark, [(1, around(ITEM)), (2, around(ITEM.upper())), (3, around(other)), (5, prose(rng, 400)), (6, " ".join(ITEM.split()[:10])), *ODD])
    assert {d for d, _ in got} >= {1, 2, 3} and not {d for d, _ in got} & {5, 6, 900, 901, 902, 903, 904, 905}
    assert not got[1, 1]["reparameterised"] and not got[2, 1]["reparameterised"] and got[3, 1]["reparameterised"]
    assert got[1, 1]["matched_tokens"] == got[1, 1]["item_tokens"]


def test_a_value_must_always_stand_against_one_value(spark):
    item = "take 5 red balls from the box and put 5 blue balls into it then count 9 green ones slowly twice over again"
    docs = [(1, item.replace("5", "8")), (2, item.replace("5", "8", 1).replace("5", "6").replace("9", "7")), (3, item.replace("9", "4"))]
    got = contaminated(spark, docs, [(1, item)])
    assert set(got) == {(1, 1), (3, 1)} and got[1, 1]["reparameterised"] and got[3, 1]["reparameterised"]
    # One altered value among equal ones: the windows of the same values still count.
    longer = item + " " + " ".join(f"word{c}" for c in "abcdefghijklmnop")
    got = contaminated(spark, [(4, longer.replace("5", "8", 1))], [(1, longer)])
    assert not got[4, 1]["reparameterised"] and got[4, 1]["matched_tokens"] < got[4, 1]["item_tokens"]


def test_an_inserted_word_does_not_hide_a_copy(spark):
    words = [f"w{c}" for c in "abcdefghijklmnopqrst"]
    cut = " ".join([*words[:9], "extra", *words[9:]])
    assert contaminated(spark, [(1, cut)], [(1, " ".join(words))])[1, 1]["matched_tokens"] == 20


def test_accented_capitals_match(spark):
    item = "élan vital par dela les écoles du nord où àlors émile cherche encore ses çadeaux"
    assert (7, 1) in contaminated(spark, [(7, "x y. " + item.upper() + " z")], [(1, item)])


def test_contamination_of_empty_tables(spark):
    assert contaminated(spark, []) == {}
    assert contaminated(spark, [(1, ITEM)], []) == {}


# Language ID


def language_rows(n, seed):
    rng = random.Random(seed)
    alphabets = {"aa": "abcdeé", "bb": "klmnoß", "cc": "rstuvñ"}
    out = []
    for k in range(n):
        lang = rng.choice(sorted(alphabets))
        out.append((seed * 10_000 + k, " ".join("".join(rng.choice(alphabets[lang]) for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(1, 40))), lang))
    return out


def test_language_is_told_on_held_out_rows(spark):
    rows = language_rows(400, 1) + [(i, t, None) for i, t in ODD]
    docs = spark.createDataFrame(rows, DOCS + ", lang string")
    model = langid.train(docs)
    got = {r["doc_id"]: r for r in langid.predict(docs.select("doc_id", "text"), model).collect()}
    right = [got[i]["lang_pred"] == lang for i, _, lang in language_rows(400, 1)]
    assert np.mean(right) > 0.98
    for i in (900, 901, 902, 903):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    strange = spark.createDataFrame([(1, "жук щука выдра " * 20), (2, "xyzw wxyz zyxw " * 20)], DOCS)
    assert all(r["rejected"] for r in langid.predict(strange, model).collect())


def test_prediction_does_not_depend_on_labels_or_ids(spark):
    model = langid.train(spark.createDataFrame(language_rows(200, 2), DOCS + ", lang string"))
    a = langid.predict(spark.createDataFrame([(1, "abc bca éa")], DOCS), model).first()
    b = langid.predict(spark.createDataFrame([(2, "abc bca éa", "bb", 1.0)], DOCS + ", lang string, score double"), model).first()
    assert (a["lang_pred"], a["score"]) == (b["lang_pred"], b["score"])


def test_a_model_of_nothing_rejects_all(spark):
    model = langid.train(spark.createDataFrame([], DOCS + ", lang string"))
    assert [r["lang_pred"] for r in langid.predict(spark.createDataFrame([(1, "abc")], DOCS), model).collect()] == ["und"]


# PII


def brute_base(t):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.@ -+()9%_\né") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute_base(text), text


def test_added_spans():
    weights = pii.trained()
    assert pii.find("on 7536784127813050 4845168114407329 re", weights)[1] == [("card", 3, 19), ("card", 20, 36)]
    assert pii.find("ab (017) 555-7713 x", weights)[1] == [("phone", 3, 17)]
    for clean in ("version 4.0. of 2.5", "order 12345678901 done", "on 2024-01-15 at 10:30", "", None):
        assert pii.find(clean, weights) == ([], [])


def test_held_out_lines_are_decoded():
    weights, lines = pii.trained(), pii.training_lines(300, seed=99)
    right = sum(set(pii.decode(t, next(pii.words_of(t)), weights)) == s for t, s in lines)
    assert right / len(lines) > 0.97


def test_likelihood_gradient_matches_differences():
    rng = np.random.default_rng(0)
    weights = rng.normal(0, 0.3, (len(pii.KINDS) + 1, pii.FEATURES))
    text, spans = "call (017) 555-7713 4845168114407329.", {("phone", 5, 19), ("card", 20, 36)}
    value, step = pii.gradient(text, spans, weights)
    for k, f in ((0, 0), (3, 1), (2, 18), (-1, 7), (3, 28)):
        moved = weights.copy()
        moved[k, f] += 1e-5
        assert abs((pii.gradient(text, spans, moved)[0] - value) / 1e-5 - step[k, f]) < 1e-3


def test_scan_of_odd_rows(spark):
    rows = [*ODD, (1, "a@b.c 1.2.3.4 " * 3), (2, "4" * 50_000 + "@" * 5_000)]
    got = {r["doc_id"]: r for r in pii.scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert (got[1]["n_email"], got[1]["n_ip"], got[900]["spans"], got[2]["n_card"]) == (3, 3, "", 0)
    assert pii.masked("x a@b.c y", pii.trained()) == "x <email> y" and pii.masked(None, pii.trained()) is None


# Pipeline


def test_pipeline_on_a_small_corpus(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(8)
    rows = [(i, t + " " + prose(rng, 80), lang, "s", 0) for i, t, lang in language_rows(120, 3)]
    rows += [(k, rows[0][1], "aa", "s", 0) for k in (900, 901)]
    rows.append((910, f"{prose(rng, 40)}. {ITEM} {prose(rng, 40)}", "aa", "s", 0))
    rows.append((911, f"{prose(rng, 60)} mail jo@mail.example.com now", "aa", "s", 0))
    rows += [(920, None, None, None, None), (921, "!!! ###", "aa", "s", 7)]
    Path(tmp_path / "documents.parquet").parent.mkdir(exist_ok=True)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert not {920, 921} & set(seen[0]) and {900, 901, 910, 911} <= set(seen[0])
    assert 900 in seen[1] and not {901, rows[0][0]} & set(seen[1])
    assert 910 not in seen[2] and len(seen[2]) == len(seen[1]) - 1
    assert "<email>" in seen[3][911]
    packed = pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(seen[3])


# Decontamination by windows of few words, and by whole short items

FEW_WORDS = ["If 3 kg cost 5 dollars and 7 kg cost 9 dollars how much do 11 kg cost", "A train goes 60 km in 2 hours and 90 km in 3 hours, then 30 km in 1 hours; how far in 6 hours", "12 5 7 31 8 44 19 2 6 10 77 13 15 21 4 9 91 92 93 94 95 96 97 98 99 14 16 17 18 22 23 24 25 26 27 28", "What does quorvex 12 mean"]


@pytest.mark.parametrize("limit", [decontam.FILTER_WINDOWS, 0])
def test_items_of_few_words_and_short_items_match(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "FILTER_WINDOWS", limit)
    rng = random.Random(4)
    around = lambda t: f"{prose(rng, 30)}. {t}. {prose(rng, 30)}"
    other = FEW_WORDS[0].replace("5 d", "6 d").replace("11", "13").replace("3 kg", "4 kg")
    docs = [*((k, around(t)) for k, t in enumerate(FEW_WORDS)), (10, around(other)), (11, around("What does quorvex 13 mean")), (12, FEW_WORDS[3].upper()), (13, "4 kg in 2 hours and 9 km for 3 dollars at 2 pm"), *ODD]
    got = contaminated(spark, docs, list(enumerate(FEW_WORDS)))
    assert set(got) == {(0, 0), (1, 1), (2, 2), (3, 3), (10, 0), (12, 3)}
    assert got[10, 0]["reparameterised"] and not any(got[k, k]["reparameterised"] for k in range(4))
    assert all(got[k, k]["matched_tokens"] == got[k, k]["item_tokens"] for k in range(4))
