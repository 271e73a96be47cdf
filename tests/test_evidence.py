"""Evidence against a row-wise version of its rules, and rules of labels, peers and segments."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import evidence, labels, peers, segments, signals, stats
from tidemark.plans.config import AGGREGATION, Peers, normalised, resolve_roles


def plain_simes(p, most=3):
    kept = sorted(x for x in p if x < 1.0)[:most]
    return min([1.0, *[x * len(kept) / (k + 1) for k, x in enumerate(kept)]])


@pytest.mark.parametrize("p", [[0.01], [0.01, 0.04, 0.03, 0.02], [], [1.0, 1.0], [0.2, 1.0, 0.001]])
def test_simes(spark, p):
    df = spark.createDataFrame([(p,)], "p array<double>")
    assert df.select(evidence.simes(F.col("p"), 3)).first()[0] == pytest.approx(plain_simes(p))


def random_rows(n=120):
    rng = random.Random(3)
    out = []
    for k in range(n):
        row = {"customer_id": str(k), "cand": rng.randrange(2), "customer_recent_regime_evidence_enabled": rng.random() < 0.8}
        for s in signals.SIGNALS:
            row[s.z] = None if rng.random() < 0.2 else round(rng.gauss(0, 2.5), 2)
            row[f"{s.name}_score"] = min(100.0, abs(row[s.z] or 0.0) / 3 * 100)
        row |= {"prior_n": rng.choice([None, 1, 3, 8]), "prior_12_coverage": rng.random(), "gap_months_before_scoring": rng.choice([None, 0.0, 1.0, 3.0]), "data_gap_score": rng.random() * 100}
        row["is_new_customer_in_scoring_month"] = not row["prior_n"]
        row |= {"peer_objective_score": rng.choice([50.0, 70.0]), "peer_distribution_quality_score": rng.choice([30.0, 55.0, 80.0]), "peer_representability_status": rng.choice(["COARSE_PEER_REVIEW", "GOOD_PEER_REPRESENTATION"])}
        row |= {"peer_representability_score": rng.random() * 100, "customer_explainability_score": rng.random() * 100}
        out.append(row)
    return out


def by_hand(rows):
    """The evidence rules, a row at a time."""
    p = {}
    for cand, s in itertools.product({r["cand"] for r in rows}, signals.SIGNALS):
        z = {r["customer_id"]: r[s.z] for r in rows if r["cand"] == cand and r[s.z] is not None and (s.name != "customer_recent_regime" or r["customer_recent_regime_evidence_enabled"])}
        for side in (1, -1):
            own = {k: v for k, v in z.items() if v * side >= 0.5}
            for k, v in own.items():
                rank = 1 + sum(abs(w) > abs(v) for w in own.values())
                p[k, s.name] = (max(min(max(1 - min(abs(v) / 3, 1), 0.001), 1), min(max(rank / (len(own) + 1), 0.001), 1)), side)
    out = {}
    for r in rows:
        best = {}
        for family in ("customer", "peer"):
            names = [s.name for s in signals.SIGNALS if s.family == family]
            side = {d: plain_simes([p[r["customer_id"], n][0] for n in names if (r["customer_id"], n) in p and p[r["customer_id"], n][1] == d]) for d in (1, -1)}
            best[family] = (side[1], "HIGH") if side[1] <= side[-1] else (side[-1], "LOW")
        n = r["prior_n"] or 0
        strong = n >= 6 and r["prior_12_coverage"] >= 0.5 and r["gap_months_before_scoring"] is not None and r["gap_months_before_scoring"] <= 1
        customer = "CUSTOMER_NEW" if n <= 0 else "CUSTOMER_STRONG" if strong else "CUSTOMER_PARTIAL" if n >= 2 else "CUSTOMER_WEAK"
        peer = "PEER_WEAK" if r["peer_objective_score"] < 60 or r["peer_distribution_quality_score"] < 40 else "PEER_COARSE_REVIEW" if r["peer_representability_status"] == "COARSE_PEER_REVIEW" else "PEER_STRONG"
        pc = best["customer"][0] if customer in ("CUSTOMER_STRONG", "CUSTOMER_PARTIAL") else 1.0
        pp = best["peer"][0] if peer == "PEER_STRONG" else 1.0
        same = best["customer"][1] == best["peer"][1]
        low, high = min(pc, pp), max(pc, pp)
        if pc <= 0.05 and pp <= 0.05:
            driver, final = ("CUSTOMER_PEER_COMBINED", min(1, 2 * low, high)) if same else ("CUSTOMER_PEER_CONFLICT", low)
        else:
            driver, final = ("CUSTOMER" if pc <= 0.05 else "PEER" if pp <= 0.05 else "INSUFFICIENT_EVIDENCE" if low >= 1 else "WEAK_EVIDENCE"), low
        out[r["customer_id"]] = (driver, best["customer"][1] if pc <= pp else best["peer"][1], 100 * (1 - final), customer, peer)
    return out


def test_evidence_matches_the_row_wise_rules(spark):
    rows = random_rows()
    kinds = {str: "string", bool: "boolean", int: "long", float: "double"}
    schema = ", ".join(f"{k} {kinds[type(next((r[k] for r in rows if r[k] is not None), 0.0))]}" for k in rows[0])
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    got = evidence.aggregate(evidence.empirical_p(df, AGGREGATION), AGGREGATION).collect()
    want = by_hand(rows)
    assert {want[k][0] for k in want} >= {"CUSTOMER", "PEER", "WEAK_EVIDENCE"}
    for r in got:
        driver, direction, score, customer, peer = want[r["customer_id"]]
        assert (r["evidence_driver"], r["customer_reliability_status"], r["peer_reliability_status"]) == (driver, customer, peer)
        assert r["final_anomaly_score"] == pytest.approx(score)
        assert r["anomaly_direction"] == direction
        assert 0 <= r["confidence"] <= 100


def test_candidates_of_the_lattice():
    names = [c.name for c in peers.build_candidates(["a", "b", "c", "d"], Peers(max_variables=6))]
    assert names[0] == "a+b+c" and names[-1] == "global" and len(names) == 4 + 6 + 4 + 1
    assert [c.name for c in peers.build_candidates(["a", "b"], Peers(max_candidates=2))] == ["a+b", "global"]
    assert [c.name for c in peers.build_candidates([], Peers())] == ["global"]
    paths = [c.name for c in peers.build_candidates(["a", "b", "c"], Peers(strategy="path", max_variables=2))]
    assert paths == ["a+b", "a", "b", "global"]
    assert [c.name for c in peers.build_candidates(["a", "behavior_cluster", "behavior_level_bucket"], Peers()) if "cluster" in c.name and "level" in c.name] == []


def test_specificity():
    one, two, none = (peers.Candidate(0, c) for c in (("a",), ("a", "b"), ()))
    assert peers.specificity(none, ["a", "b"]) == 0.25
    assert peers.specificity(two, ["a", "b"]) == pytest.approx(0.25 + 0.55 + 0.1)
    assert peers.specificity(one, ["a", "b"]) == pytest.approx(0.25 + 0.275 + 0.2)


def test_null_keys_meet_in_exploded_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "n int, s string")
    rows = peers.exploded(df, [peers.Candidate(0, ("s",)), peers.Candidate(1, ())], ["n"]).collect()
    keys = {(r["n"], r["cand"]): r["key"] for r in rows}
    assert keys[1, 0] == keys[3, 0] != keys[2, 0] and keys[1, 1] == keys[2, 1]


LATTICE = [peers.Candidate(0, ("s", "t")), peers.Candidate(1, ("t",)), peers.Candidate(2, ("s",)), peers.Candidate(3, ())]


def lattice_rows(spark, n=600):
    rows = [(k, None if k % 7 == 0 else f"s{k % 5}", None if k % 11 == 0 else k % 3, float(k % 13), k % 4) for k in range(n)]
    return spark.createDataFrame(rows, "n int, s string, t int, y double, m int")


@pytest.mark.parametrize("candidates", [LATTICE, LATTICE[3:], LATTICE[:1]])
def test_grouping_sets_are_the_groups_of_exploded_rows(spark, candidates):
    df = lattice_rows(spark)
    values, others = {"q": (F.col("y"), (0.25, 0.5))}, [F.count("*").alias("rows"), F.avg("m").alias("mean")]
    for extra in ((), ("m",)):
        wanted = stats.quantiles(peers.exploded(df, candidates, df.columns), ["cand", "key", *extra], values, others)
        for large in (False, True):
            got = peers.grouped(df, candidates, values, others, extra, large)
            assert got.columns == ["cand", "key", *extra, "q", "rows", "mean"]
            assert sorted(map(str, got.collect())) == sorted(map(str, wanted.select(got.columns).collect()))
    assert peers.grouped(df.limit(0), candidates, values, others).count() == 0


def test_keys_as_text(spark):
    text = {(r["n"], r["cand"]): r["text"] for r in peers.exploded(lattice_rows(spark, 12), LATTICE, ["n"]).withColumn("text", peers.key_text(LATTICE)).collect()}
    assert text[1, 0] == '{"k0":"s1","k1":"1"}' and text[1, 1] == '{"k0":"1"}' and text[7, 0] == '{"k1":"1"}' and text[1, 3] == "ALL"


def test_history_is_reduced_before_and_after_it_is_exploded(spark):
    history = spark.range(5000).select(F.col("id").alias("n"), F.when(F.col("id") % 50 != 0, F.concat(F.lit("c"), F.col("id") % 1000)).alias("s"), (F.col("id") % 2).alias("t"))
    scoring = spark.createDataFrame([("c7", 1), ("c8", 0), (None, 0)], "s string, t long")
    every = peers.exploded(history, LATTICE, ["n"])
    wanted = every.join(peers.exploded(scoring, LATTICE, []).distinct(), ["cand", "key"], "left_semi")
    got = peers.reduced(history, scoring, LATTICE, ["n"])
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.select("n", "cand", "key").collect()))
    made = peers.exploded(history, LATTICE, ["n"], peers.key_filter(scoring, LATTICE)).count()
    assert got.count() <= made < got.count() + 300 and every.count() == 20_000
    assert peers.reduced(history, scoring.limit(0), LATTICE, ["n"]).count() == 0


def test_objective_caps(spark):
    df = spark.createDataFrame([(90.0, 30.0, 90.0), (90.0, 50.0, 90.0), (90.0, 90.0, 30.0), (90.0, 90.0, 50.0), (90.0, 90.0, 90.0)], "raw double, peer_distribution_quality_score double, peer_representability_score double")
    got = [r[0] for r in df.select(peers.capped_objective(F.col("raw"))).collect()]
    assert got == pytest.approx([55 - 2.0, 70 - 1.0, 55 - 1.5, 70 - 0.5, 90.0])


def test_labels_and_flags(spark):
    df = spark.createDataFrame([("NORMAL",), ("NOT_SCORED",), (None,), ("WATCHLIST_LOW",)], "l string")
    assert [r[0] for r in df.select(labels.anomaly_flag(F.col("l"))).collect()] == [0, 0, 0, 1]
    actions = spark.createDataFrame([(a,) for a in ("NORMAL", None, "LIKELY_HIGH_MAIN_METRIC_ANOMALY", "WATCHLIST_LOW", "REVIEW_PEER_ASSIGNMENT_MISMATCH_LOW", "REVIEW_PEER_SELF_CONFLICT_HIGH", "REVIEW_SPARSE_HISTORY_LOW", "REVIEW_LOW_MAIN_METRIC_ANOMALY")], "a string")
    assert [r[0] for r in actions.select(labels.operational_decision(F.col("a"))).collect()] == ["NORMAL", "NOT_SCORED", "LIKELY_ANOMALY", "WATCHLIST", "REVIEW_PEER_ASSIGNMENT", "REVIEW_SIGNAL_CONFLICT", "REVIEW_LOW_CONFIDENCE", "REVIEW_MAIN_METRIC_ANOMALY"]


def test_segment_names_and_buckets(spark):
    assert len(segments.internal_name("A very long Column Name!", "q4b")) <= 30
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (5.0,)], "v double")
    assert [r[0] for r in df.select(segments.reference_bucket(F.col("v"), [], "q")).collect()] == ["feature_zero", "feature_missing", "feature_zero", "feature_positive"]
    assert [r[0] for r in df.select(segments.bucketed(F.col("v"), [0.0, 5.0], "b")).collect()] == ["segment_missing", "b_1", "b_2", "b_3"]


def test_config_helpers():
    assert normalised({"a": -1, "b": 3}, {"a": 1, "b": 1}) == {"a": 0.0, "b": 1.0}
    assert normalised({"a": 0, "b": 0}, {"a": 1, "b": 3}) == {"a": 0.25, "b": 0.75}
    assert resolve_roles(["MUSTERINO", "DONEM_AY", "FATURA_TTR"]).main_metric == "FATURA_TTR"
    with pytest.raises(ValueError, match="main_metric"):
        resolve_roles(["MUSTERINO", "DONEM_AY"])
