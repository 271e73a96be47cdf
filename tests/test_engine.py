"""The panel's rules, a whole run on a made panel, outputs, sources and the entry module."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__
from tidemark.operators import challengers, panel
from tidemark.plans import fixtures, outputs, pipeline, report, validation
from tidemark.plans.config import AGGREGATION, Config, Roles, Segment, Support, from_mapping
from tidemark.plans.scoring import score_month
from tidemark.sources import files, jdbc

ROLES = Roles("id", "m", "v", "ref")
RAW = "id string, m string, v string, ref double, seg string"


def made(seed=1, customers=160, months=26):
    """A steady panel with three spikes and three drops in the last month."""
    rng = random.Random(seed)
    out = []
    for c in range(customers):
        level = rng.uniform(4, 6)
        for k in range(months):
            month = (2000 + k // 12) * 100 + k % 12 + 1
            value = float(np.exp(level + rng.gauss(0, 0.1)))
            if k == months - 1:
                value *= 20 if c < 3 else 0.05 if c < 6 else 1
            out.append((str(c), str(month), f"{value:.4f}", value / 3, f"s{c % 2}"))
    return out


CONFIG = Config(ROLES, (Segment("seg"),), Support(60, 5, 10, 10), watch_top_rate=0.05, high_top_rate=0.03)
MONTH = 200202


@pytest.fixture(scope="module")
def scored(spark):
    table, profile = panel.panel(spark.createDataFrame(made(), RAW), CONFIG)
    table = table.persist()
    return table, profile, score_month(table, profile, CONFIG, MONTH)


def test_repeated_rows_are_collapsed(spark):
    rows = [("a", "202001", None, None, None), ("a", "202001", None, 5.0, "x"), ("b", "202001", "2", None, "y"), ("b", "202001", "3,5", None, None), ("c", "202001", None, None, None)]
    table, profile = panel.panel(spark.createDataFrame(rows, RAW), Config(ROLES))
    got = {r["customer_id"]: r for r in table.collect()}
    assert (got["a"]["main_metric"], got["b"]["main_metric"], got["c"]["main_metric"]) == (0.0, 5.5, 0.0)
    assert (got["a"]["reference_feature"], got["a"]["seg"], got["a"]["source_row_count"], profile.duplicate_rows) == (5.0, "x", 2, 2)


def test_without_repeats_a_missing_metric_stays_missing(spark):
    table, _ = panel.panel(spark.createDataFrame([("a", "202001", None, None, None), ("a", "202002", "-1", None, None), (None, "202002", "0", None, None)], RAW), Config(ROLES))
    got = {(r["customer_id"], r["invoice_month"]): r for r in table.collect()}
    assert [got[k]["valid_main_metric_for_model"] for k in (("a", 202001), ("a", 202002), ("nan", 202002))] == [False, False, True]
    assert got["a", 202002]["month_gap_from_previous"] == 1 and got["a", 202001]["previous_month_ord"] is None


def test_bad_months_and_columns_are_errors(spark):
    with pytest.raises(Exception, match="month"):
        panel.normalise(spark.createDataFrame([("a", "spring", "1", None, None)], RAW), ROLES).collect()
    with pytest.raises(ValueError, match="main_metric"):
        panel.normalise(spark.createDataFrame([("a",)], "id string"), Roles("id", "id", "no"))
    with pytest.raises(ValueError, match="ratio"):
        panel.panel(spark.createDataFrame([("a", "202001", "1", None, None)], RAW), Config(ROLES, ratio="true"))


def test_exposure_buckets_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.5, 2.0, 4.0, 5.0, 9.0, 10.0)], "x double")
    assert [r[0] for r in df.select(panel.exposure_bucket(F.col("x"))).collect()] == ["active_1", "active_1", "active_2", "active_2", "active_3_4", "active_5_9", "active_5_9", "active_10_plus"]


def test_spikes_and_drops_are_found(scored):
    rows = {r["customer_id"]: r for r in scored[2].scores.collect()}
    assert len(rows) == 160
    flagged = {k: r["anomaly_label"] for k, r in rows.items() if r["anomaly_label"] != "NORMAL"}
    assert {k for k, v in flagged.items() if "HIGH" in v} >= {"0", "1", "2"} and {k for k, v in flagged.items() if v.startswith("LOW") or v.endswith("LOW")} >= {"3", "4", "5"}
    assert len(flagged) <= 10
    assert all("SELF_HISTORY_JUMP" in rows[k]["reason_codes"] for k in "012")


def test_the_order_of_rows_does_not_matter(spark, scored):
    rows = made()
    random.Random(5).shuffle(rows)
    table, profile = panel.panel(spark.createDataFrame(rows, RAW).repartition(7), CONFIG)
    columns = ("customer_id", "anomaly_label", "peer_group_level_name", "evidence_driver")
    again = score_month(table, profile, CONFIG, MONTH).scores
    assert sorted(map(tuple, again.select(*columns).collect())) == sorted(map(tuple, scored[2].scores.select(*columns).collect()))


def test_the_scoring_month_does_not_change_what_is_fitted(scored):
    table, profile, run = scored
    other = validation.perturbed(table, MONTH, run.scores.select("customer_id").limit(40), 3.0)
    again = score_month(other, profile, CONFIG, MONTH)
    pick = lambda r: {x["customer_id"]: (x["hist_median"], x["prior_median"], x["customer_trend_slope"]) for x in r.scores.collect()}
    old, new = pick(run), pick(again)
    assert all(old[k] == new[k] for k in old if k in new)


def test_a_month_without_history_scores_nobody(scored):
    table, profile, _ = scored
    run = score_month(table, profile, CONFIG, 200001)
    assert run.scores.count() == 0 and run.not_scored.count() == 160
    decision = outputs.decision_table(run)
    assert {(r["ANOMALI_FLAG"], r["ANOMALI_SKORU"]) for r in decision.collect()} == {(0, 0.0)}


def test_output_tables_keep_their_promises(scored):
    table, _, run = scored
    decision, detail = outputs.decision_table(run, ["seg"]), outputs.detail_table(table, run, CONFIG)
    assert decision.count() == 160 and "seg" in decision.columns
    assert detail.count() == 160 * 26
    assert {r["status"] for r in validation.integrity_checks(decision, detail, ["seg"]).collect()} == {"PASS"}
    past = detail.filter("not is_scoring_month")
    assert past.filter("anomaly_label is not null or ANOMALI_FLAG is not null").isEmpty()
    assert past.agg(F.max("customer_vs_peer_ratio_percentile")).first()[0] <= 1.0


def test_reports_and_backtest(scored):
    table, profile, run = scored
    tables = report.peer_quality_tables(run)
    assert tables["level"].agg(F.sum("customers")).first()[0] == 160
    assert "## level" in report.markdown(tables)
    flags = validation.stability_flags(validation.backtest(table, profile, CONFIG, validation.backtest_months(table, MONTH, 2)))
    assert [r["scoring_month"] for r in flags.orderBy("scoring_month").collect()] == [200201, 200202]


def test_stress_moves_scores_the_right_way(scored):
    table, profile, _ = scored
    got = {r["cohort"]: r for r in validation.stress_test(table, profile, CONFIG, MONTH, size=8, spike=20.0, drop=0.05).collect()}
    assert got["all_positive"]["sample_size"] == 8 and got["all_positive"]["spike_detection_rate"] > 0  # the top rates leave room for a few labels only
    assert got["all_positive"]["spike_median_score_delta"] > 0


def test_challengers_tell_the_planted_rows(scored):
    run = scored[2]
    rules = AGGREGATION | {"challenger_models": AGGREGATION["challenger_models"] | {"min_rows": 50}}
    rows = {r["customer_id"]: r for r in challengers.add_challengers(run.scores, rules).collect()}
    planted = np.mean([rows[k]["model_challenger_score"] for k in "012345"])
    assert planted > 90
    none = challengers.add_challengers(run.scores, AGGREGATION | {"challenger_models": AGGREGATION["challenger_models"] | {"min_rows": 10_000}}).first()
    assert none["model_challenger_score"] is None and "below minimum" in none["model_challenger_warning"]


def test_components_match_singular_values(spark):
    x = np.random.default_rng(0).normal(size=(60, 4)) @ np.diag([3, 2, 0.5, 0.1])
    df = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(x)], "k long, x array<double>")
    got = [r[0] for r in df.select("k", challengers.reconstruction_error(df, 4, 0.8, 6).alias("e")).orderBy("k").select("e").collect()]
    centred = x - x.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    v = vt[: int(np.searchsorted(np.cumsum(s**2) / (s**2).sum(), 0.8) + 1)]
    assert np.allclose(got, ((centred - centred @ v.T @ v) ** 2).mean(1))


def test_prior_month_scores(scored):
    table, profile, run = scored
    rows = outputs.with_prior_scores(table, profile, CONFIG, run).collect()
    assert all(r["previous_month_score"] is not None for r in rows)
    assert {r["score_trend_diagnostic"] for r in rows if r["customer_id"] in "012"} <= {"SCORE_SPIKE_UP_DIAGNOSTIC_ONLY", "SCORE_MOVED_MODERATELY_DIAGNOSTIC_ONLY", "SCORE_STABLE_DIAGNOSTIC_ONLY"}


def test_a_configured_run_from_csv(spark, tmp_path):
    path = tmp_path / "raw.csv"
    lines = ["id;m;v;ref;seg"] + [";".join([c, m, v.replace(".", ","), str(r), s]) for c, m, v, r, s in made(customers=60)]
    path.write_text("﻿" + "\n".join(lines), encoding="utf-8")
    raw = {"source": {"active_source": "one", "connections": {"one": {"type": "csv", "path": str(path)}}}, "columns": {"customer_id": "id", "invoice_month": "m", "main_metric": "v"}, "segments": ["seg"], "peer_support": {"min_history_rows": 60, "min_season_rows": 5, "min_recent_rows": 10, "min_current_rows": 10}, "prior": False}
    result = pipeline.run_mapping(spark, raw)
    assert result.run.scoring_month == MONTH and result.decision.count() == 60
    files.write_month(result.decision, str(tmp_path / "out"), MONTH)
    files.write_month(result.decision.limit(5), str(tmp_path / "out"), MONTH)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_detected_options():
    assert files.detect_options("a;b;c;d;e\n1;2".encode()) == ("utf-8", ";")
    assert files.detect_options("ş,b,c,d,e".encode("cp1254")) == ("cp1254", ",")
    with pytest.raises(ValueError, match="fit"):
        files.detect_options(b"a,b")


def test_identifiers_and_types():
    names = jdbc.identifiers(["müşteri no", "1st", "a" * 40, "A" * 40, "x", "X"])
    assert len(set(names.values())) == 6 and all(jdbc.valid_identifier(n) for n in names.values())
    assert jdbc.column_type("ANOMALI_NEDENI", T.StringType()) == "CLOB" and jdbc.column_type("x", T.BooleanType()) == "NUMBER(1)"
    with pytest.raises(ValueError, match="values"):
        jdbc.delete_statements("T", "K", [])
    assert jdbc.credentials("[JOB]\nconnection=c\n[c]\nuser=u\npassword=p\nhost=h\nport=1\nservice_name=s")["host"] == "h"
    with pytest.raises(ValueError, match="password"):
        jdbc.credentials({"user": "u"})


def test_config_from_a_mapping():
    got = from_mapping({"columns": {"customer_id": "id", "invoice_month": "m", "main_metric": "v"}, "segments": ["seg", {"source": "b", "type": "numeric"}], "peers": {"priority": ["seg"]}, "window_months": 12}, ["id", "m", "v", "seg", "b"])
    assert got.window_months == 12 and got.segments[1].type == "numeric" and got.peers.priority == ("seg",)
    with pytest.raises(ValueError, match="no such segment"):
        from_mapping({"columns": {"customer_id": "id", "invoice_month": "m", "main_metric": "v"}, "segments": ["gone"]}, ["id", "m", "v"])


def test_entry_names_every_query_once():
    names = __spark_entry__.queries()
    assert set(__spark_entry__.oracle_sql()) <= set(names)
    assert len(names) > 45
    assert fixtures.SCORING_MONTH == 200107


def values(df, keys):
    return {tuple(r[k] for k in keys): {c: v for c, v in r.asDict(True).items() if c not in keys} for r in df.collect()}


def same(one, other):
    assert set(one) == set(other)
    for k, row in one.items():
        for c, v in row.items():
            w = other[k][c]
            assert v == w or (isinstance(v, float) and isinstance(w, float) and np.isclose(v, w, rtol=1e-9, atol=1e-9)), (k, c, v, w)


def test_a_month_too_large_for_a_task_is_scored_the_same(spark, scored, monkeypatch):
    from tidemark.plans import scoring

    table, profile, small = scored
    monkeypatch.setattr(scoring, "LARGE_ROWS", 0)
    large = score_month(table, profile, CONFIG, MONTH)
    assert large.large and not small.large
    same(values(small.scores, ["customer_id"]), values(large.scores, ["customer_id"]))
    details = [values(outputs.detail_table(table, run, CONFIG).select("customer_id", "invoice_month", "peer_month_main_metric_median", "peer_month_row_count", "customer_vs_peer_ratio_percentile", "customer_vs_peer_ratio_reference_n", "month_comment"), ["customer_id", "invoice_month"]) for run in (small, large)]
    same(*details)
    rules = AGGREGATION | {"challenger_models": AGGREGATION["challenger_models"] | {"min_rows": 50}}
    shown = ["customer_id", "pca_challenger_score", "if_challenger_score", "lof_challenger_score", "model_challenger_warning"]
    same(*(values(challengers.add_challengers(run.scores, rules, large=run.large).select(shown), ["customer_id"]) for run in (small, large)))
    same(*(values(report.metric_stats(run), ["peer_candidate_order", "peer_key"]) for run in (small, large)))


def test_months_are_read_from_a_store(spark, scored, tmp_path, monkeypatch):
    from tidemark.plans import store as stores

    table, profile, run = scored
    store, whole = stores.MonthStore(spark, str(tmp_path / "months")), Config(ROLES, (Segment("seg"),), CONFIG.support, watch_top_rate=0.05, high_top_rate=0.03, window_months=0)
    wanted = values(validation.backtest(table, profile, CONFIG, [200201, MONTH]), ["scoring_month"])
    calls = []
    for module in (validation, outputs):
        monkeypatch.setattr(module, "score_month", lambda *a: (calls.append(a[3]), score_month(*a))[1])
    same(wanted, values(validation.backtest(table, profile, CONFIG, [200201, MONTH], store), ["scoring_month"]))
    assert calls == [200201, MONTH]
    same(wanted, values(validation.backtest(table, profile, CONFIG, [200201, MONTH], store), ["scoring_month"]))
    assert validation.backtest(table, profile, CONFIG, [MONTH], store).count() == 1 and calls == [200201, MONTH]
    assert store.months("summary", stores.of_config(CONFIG)) == [200201, MONTH] and store.months("summary", stores.of_config(whole)) == []
    # Peers' past months: the second month's run adds one month only.
    before = score_month(table, profile, CONFIG, 200201)
    outputs.detail_table(table, before, CONFIG, store).count()
    decides = stores.of_peers(run.candidates, run.fits)
    first = store.months("peers", decides)
    kept = values(outputs.detail_table(table, run, CONFIG, store), ["customer_id", "invoice_month"])
    assert first[-1] == 200112 and store.months("peers", decides) == [*first, 200201]
    same(values(outputs.detail_table(table, run, CONFIG), ["customer_id", "invoice_month"]), kept)
    # Prior scores: only from the same months of history.
    calls.clear()
    for config, reused in ((whole, True), (Config(**{**whole.__dict__, "window_months": 20}), False)):
        old, new = (score_month(table, profile, config, m) for m in (200201, MONTH))
        outputs.store_scores(old, config, store)
        calls.clear()
        prior = values(outputs.with_prior_scores(table, profile, config, new, store), ["customer_id"])
        assert calls == ([] if reused else [200201])
        same(values(outputs.with_prior_scores(table, profile, config, new), ["customer_id"]), prior)


def test_peers_months_have_their_keys_as_text(spark):
    got = __spark_entry__.queries()["peer_monthly_stats"](spark, "/root/testdata/sf0.001")
    assert dict(got.dtypes)["key"] == "string"
    assert {r["key"] for r in got.filter("cand = 3").select("key").distinct().collect()} == {"ALL"}
    assert all(r["key"].startswith('{"k0":"') for r in got.filter("cand < 3").select("key").distinct().collect())


def test_a_perturbed_month_takes_the_history_that_is_fitted(spark, scored, monkeypatch):
    from tidemark.operators import peers, stats

    table, profile, run = scored
    raised = validation.perturbed(table, MONTH, run.scores.select("customer_id"), 2.0)
    wanted = values(score_month(raised, profile, CONFIG, MONTH).scores, ["customer_id"])
    for module, name in ((peers, "history_stats"), (stats, "self_stats")):
        monkeypatch.setattr(module, name, lambda *a, **k: pytest.fail("history is fitted again"))
    same(wanted, values(score_month(raised, profile, CONFIG, MONTH, run.past).scores, ["customer_id"]))
