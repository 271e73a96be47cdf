"""Configurations by variable groups, sinks, and table writes against the database that Spark brings along."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_engine import MONTH, made
from tidemark.operators import panel, peers, segments
from tidemark.plans import config, pipeline
from tidemark.sources import files, jdbc


def kinds(name, kind, longest):
    """Column types of the test database, whose long texts take nulls from Spark and whose short ones can be compared."""
    return {T.BooleanType: "BOOLEAN", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE"}.get(type(kind), "VARCHAR(100)" if name in ("ID", "M") else "CLOB")


@pytest.fixture
def base(tmp_path):
    return {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver", "user": "app", "password": "app"}


def rows(spark, base, table):
    return sorted(tuple(r) for r in jdbc.read(spark, base, table).collect())


def test_write_modes_of_tables(spark, base):
    execute = jdbc.executor(spark, base)
    df = spark.createDataFrame([(202601, "a", 1.5), (202602, "b", None)], "m int, txt string, v double")
    with pytest.raises(ValueError, match="execute"):
        jdbc.write(df, base, "T1", "append", kind=kinds)
    jdbc.write(df, base, "T1", "append", execute, kind=kinds)
    jdbc.write(df.limit(1), base, "T1", "append", execute, kind=kinds)
    assert len(rows(spark, base, "T1")) == 3
    new = spark.createDataFrame([(202602, "c", 9.0)], df.schema)
    jdbc.write(new, base, "T1", "delete_insert", execute, "M", [202602], kinds)
    assert rows(spark, base, "T1") == [(202601, "a", 1.5), (202601, "a", 1.5), (202602, "c", 9.0)]
    with pytest.raises(ValueError, match="values"):
        jdbc.write(new, base, "T1", "delete_insert", execute, "M", [], kinds)
    with pytest.raises(ValueError, match="identifier"):
        jdbc.write(new, base, "T1; DROP TABLE T1", "append", execute, kind=kinds)
    assert len(rows(spark, base, "T1")) == 3
    jdbc.write(new, base, "T1", "truncate_insert", execute, kind=kinds)
    assert rows(spark, base, "T1") == [(202602, "c", 9.0)]
    jdbc.write(df.limit(1).select("v", "txt", "m"), base, "T1", "append", execute, kind=kinds)  # another order of columns is no other table
    assert rows(spark, base, "T1") == [(202601, "a", 1.5), (202602, "c", 9.0)] and jdbc.table_columns(spark, base, "T1") == ["M", "TXT", "V"]
    with pytest.raises(ValueError, match="recreate"):
        jdbc.write(new.select("v", "m"), base, "T1", "append", execute, kind=kinds)
    assert len(rows(spark, base, "T1")) == 2
    jdbc.write(new.select("v", "m"), base, "T1", "append", execute, kind=kinds, recreate=True)
    assert rows(spark, base, "T1") == [(9.0, 202602)] and jdbc.table_columns(spark, base, "T1") == ["V", "M"]
    jdbc.write(df, base, "T1", "replace", execute, kind=kinds)
    assert len(rows(spark, base, "T1")) == 2 and jdbc.table_columns(spark, base, "NO_TABLE") is None


def tables(spark, base):
    return [r[0] for r in spark.read.format("jdbc").options(**base).option("query", "SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'").load().collect()]


@pytest.mark.parametrize("mode", ["append", "delete_insert", "truncate_insert", "replace"])
def test_a_failing_task_leaves_the_target_as_it_was(spark, base, mode):
    execute = jdbc.executor(spark, base)
    old = spark.createDataFrame([(202601, "a"), (202602, "b")], "m int, txt string")
    jdbc.write(old, base, "T1", "replace", execute, kind=kinds)
    late = spark.range(0, 40, 1, 4).select(F.lit(202602).alias("m"), F.when(F.col("id") < 35, "new").otherwise(F.raise_error(F.lit("lost midway")).cast("string")).alias("txt"))
    with pytest.raises(Exception, match="lost midway"):
        jdbc.write(late, base, "T1", mode, execute, "M", [202602], lambda n, t, longest: "INTEGER" if n == "M" else "VARCHAR(9)")
    assert rows(spark, base, "T1") == [(202601, "a"), (202602, "b")] and tables(spark, base) == ["T1"]


def test_a_failing_move_leaves_the_target_as_it_was(spark, base):
    execute = jdbc.executor(spark, base)
    narrow = lambda n, t, longest: "INTEGER" if n == "M" else "VARCHAR(3)"
    wide = lambda n, t, longest: "INTEGER" if n == "M" else "VARCHAR(30)"
    jdbc.write(spark.createDataFrame([(1, "a"), (2, "b")], "m int, txt string"), base, "T1", "replace", execute, kind=narrow)
    with pytest.raises(Exception, match="(?i)truncation|length|VARCHAR"):
        jdbc.write(spark.createDataFrame([(2, "too long a text")], "m int, txt string"), base, "T1", "delete_insert", execute, "M", [2], wide)
    assert rows(spark, base, "T1") == [(1, "a"), (2, "b")] and tables(spark, base) == ["T1"]


def test_rows_that_were_staged_twice_are_an_error(spark, base, monkeypatch):
    execute = jdbc.executor(spark, base)
    df = spark.createDataFrame([(1, "a")], "m int, txt string")
    jdbc.write(df, base, "T1", "replace", execute, kind=kinds)
    stage = jdbc.stage
    monkeypatch.setattr(jdbc, "stage", lambda out, connection, name: (stage(out, connection, name), stage(out, connection, name)))
    with pytest.raises(RuntimeError, match="holds 2 rows in place of 1"):
        jdbc.write(df, base, "T1", "append", execute, kind=kinds)
    assert rows(spark, base, "T1") == [(1, "a")] and tables(spark, base) == ["T1"]


def test_an_unreachable_database_is_an_error(spark, base):
    with pytest.raises(Exception, match="(?i)derby|database|connect"):
        jdbc.table_columns(spark, base | {"url": base["url"].replace(";create=true", "-none")}, "T1")


def test_places_in_files_go_by_name_and_row(spark, tmp_path):
    for name, lines in (("b", ["id,m,v,w,x", *(f"{k % 5},202601,{k},late,{k}" for k in range(400))]), ("a", ["id,m,v,w,x", "1,202601,5,early,", "7,202601,6,only,"])):
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    for size in ("200", old):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            raw = files.read_csv(spark, str(tmp_path), "utf-8", ",", ordinal=True)
            roles = config.Roles("id", "m", "v")
            last = {r["customer_id"]: (r["row"]["v"], r["row"]["w"]) for r in panel.last_rows(raw, roles, 202601).collect()}
            first = {r["customer_id"]: (r["w"], r["x"], r["main_metric"]) for r in panel.collapse(panel.normalise(raw, roles)).collect()}
            found.append((last, first))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found[0] == found[1]
    last, first = found[0]
    assert last == {str(k): (str(395 + k), "late") for k in range(5)} | {"7": ("6", "only")}
    assert first["1"][:2] == ("early", "1") and first["1"][2] == 5 + sum(range(1, 400, 5)) and first["2"][:2] == ("late", "2") and first["7"] == ("only", None, 6.0)


def test_deletes_bind_their_values():
    found = jdbc.delete_statements("O.T", "K", list(range(1000)))
    assert [len(v) for _, v in found] == [900, 100] and found[0][0].count("?") == 900
    for bad in (("T;X", "K"), ("T", "K = 1 OR 1")):
        with pytest.raises(ValueError, match="identifier"):
            jdbc.delete_statements(*bad, [1])
    assert jdbc.create_statement("T", {"A": "NUMBER"}) == "CREATE TABLE T (A NUMBER)"
    assert jdbc.column_type("A", T.StringType(), 3901) == "CLOB" and jdbc.column_type("A", T.StringType(), 3900) == "VARCHAR2(4000 CHAR)"
    assert jdbc.credentials("user: u\npassword: p\nhost: h\nport: 1\nservice_name: s")["port"] == "1"


def test_a_file_is_loaded_as_text(spark, base, tmp_path):
    (tmp_path / "in.csv").write_text("a;b;c;d;e\n1;x;;4,5;ü\n", encoding="utf-8")
    jdbc.load_csv(spark, str(tmp_path / "in.csv"), base, "LOADED", "replace", jdbc.executor(spark, base), kinds)
    assert rows(spark, base, "LOADED") == [("1", "x", None, "4,5", "ü")]


def groups(source, sink):
    return {
        "source": {"type": "parquet", "path": source, "name": "my source", "exclude_output_columns": ["ref"]},
        "sinks": {"default_sink": "s", "connections": {"s": sink}},
        "variables": {"id_vars": ["id"], "time_vars": "m", "features": ["v"], "segment_vars": "auto", "ignore_variables": ["ref"]},
        "peer_support": {"min_history_rows": 60, "min_season_rows": 5, "min_recent_rows": 10, "min_current_rows": 10},
        "prior": False,
    }


def test_a_run_by_groups_writes_files_and_tables(spark, base, tmp_path):
    source = str(tmp_path / "raw")
    spark.createDataFrame(made(customers=60), "id string, m string, v string, ref double, seg string").write.parquet(source)
    out = pipeline.run_mapping(spark, groups(source, {"type": "local", "path": str(tmp_path / "out")}))
    assert [s.source for s in out.config.segments] == ["seg"]
    decision = spark.read.option("header", True).csv(out.written["decision"])
    assert out.written["decision"].endswith(f"my_source_anomaly_decisions_{MONTH}.csv") and decision.count() == 60
    assert [c.lstrip("﻿") for c in decision.columns] == ["id", "m", "v", "seg", "ANOMALI_FLAG", "ANOMALI_SKORU", "ANOMALI_NEDENI"]
    ids = [r[0] for r in decision.collect()]
    assert ids == sorted(ids)
    told = json.loads(spark.read.text(out.written["contract"], wholetext=True).first()[0])
    assert told["scoring_month"] == MONTH and told["summary"]["scored"] == 60
    sink = {"type": "jdbc", "connection": base, "types": kinds}
    for _ in range(2):  # the second write replaces the first one's month
        pipeline.write_outputs(out, sink, "x", ["id", "m"])
    assert len(rows(spark, base, "ANOMALY_DECISIONS")) == 60
    assert spark.read.format("jdbc").options(**base).option("dbtable", "ANOMALY_DECISION_DETAIL").load().count() == out.detail.count()
    assert pipeline.write_outputs(out, pipeline.selected_sink({}), "x") == {}
    assert pipeline.selected_sink({"sink": {"type": "local", "enabled": False}}, True)["enabled"]


def test_groups_are_compiled():
    raw = {
        "variables": {"ids": ["id"], "dates": "m", "features": ["v", "ref"], "main_feature": "w", "segments": ["seg", {"column": "b", "type": "num"}, "auto"], "ignored_variables": ["x"]},
        "model": {"derived_signals": {"ratios": {"r": {"denominator": "ref", "use_as_peer_variable": True, "peer_bucket_variants": {"variants": [{"name": "3rd part", "quantiles": [0.5, 0.5, "x", 2]}]}}}}, "derived_features": {"bucket_features": [{"source": "n", "internal_role": "exposure"}]}},
        "peer_selection": {"priority_variables": "auto", "mandatory_variables": ["seg"], "fallback_variables": "segments", "max_candidate_count": 9, "exclude_variables": ["y"]},
    }
    got = config.compiled(raw)
    assert got["columns"] == {"customer_id": "id", "invoice_month": "m", "main_metric": "w", "reference_feature": "ref", "exposure_feature": "n"}
    assert [(s["source"], s["type"]) for s in got["segments"]] == [("seg", "categorical"), ("b", "numeric")]
    assert got["peers"]["priority"] == ["seg", "b"] == got["peers"]["fallback"] and got["peers"]["max_candidates"] == 9
    assert got["excluded"] == ["y", "x"] and got["ratio_as_signal"]
    assert segments.bucket_variants(got["bucket_variants"]) == {"feature_bucket_b_3rd_part": (0.5,)}
    assert config.compiled({"variables": {"segments": ["auto"]}, "columns": {"required": {"main_metric": "z"}}})["segments"] == "auto"
    with pytest.raises(ValueError, match="unknown"):
        config.from_mapping({"columns": {}, "segmnts": []}, [])


def test_reference_buckets_and_their_edges(spark):
    values = [float(k) for k in range(1, 121)] + [0.0, None, -1.0]
    df = spark.createDataFrame([(v,) for v in values], "reference_feature_for_model double").withColumn("log_reference_feature", F.when(F.col("reference_feature_for_model") > 0, F.log1p("reference_feature_for_model")))
    edges = segments.fit_reference_buckets(df, segments.bucket_variants(["q4"]))
    got = segments.assign_reference_buckets(df, edges).groupBy("feature_bucket_q4").count()
    assert {r[0]: r[1] for r in got.collect()} == {"q4_b1": 30, "q4_b2": 30, "q4_b3": 30, "q4_b4": 30, "feature_zero": 2, "feature_missing": 1}
    few = segments.assign_reference_buckets(df, segments.fit_reference_buckets(df, segments.bucket_variants(["q4"]), 500))
    assert few.filter("feature_bucket_q4 = 'feature_positive' and feature_ratio_bucket = 'reference_feature_positive'").count() == 120
    assert files.stem("a b/ç") == "a_b" and files.stem(None) == "anomaly_input"


def test_roles_of_variable_groups():
    variables = {"ids": ["id", "other"], "dates": "m", "features": ["v", "w"]}
    assert config.found_roles({"variables": variables}, {}) == {"customer_id": "id", "invoice_month": "m", "main_metric": "v"}
    buckets = {"bucket_features": [{"source": "x"}, {"source": "Main_Metric", "internal_role": " Exposure "}, {"source": "y", "internal_role": "exposure"}]}
    for place in ({"model": {"derived_features": buckets}}, {"derived_features": buckets}):
        assert config.found_roles({"variables": variables | {"main_feature": "w"}} | place, {"denominator": "ref"}) == {"customer_id": "id", "invoice_month": "m", "main_metric": "w", "reference_feature": "ref", "exposure_feature": "w"}
    assert "reference_feature" not in config.found_roles({"variables": variables}, {"denominator": "ref", "enabled": "No"})
    assert config.found_roles({"variables": variables}, {"denominator": "invoice_month"})["reference_feature"] == "m"


def test_the_first_derived_ratio_is_the_ratio():
    feature = {"derived_features": {"ratio_feature": {"denominator": "a", "enabled": False}}}
    assert config.ratio_settings({"model": feature}) == {"denominator": "a", "enabled": False}
    assert config.ratio_settings(feature | {"derived_signals": {"ratios": ["no", {"denominator": "b"}, {"denominator": "c"}]}}) == config.DERIVED_RATIO | {"denominator": "b"}
    assert config.ratio_settings({"derived_signals": {"ratios": {"n": {"denominator": "b", "use_as_anomaly_signal": False}}}}) == config.DERIVED_RATIO | {"name": "n", "denominator": "b", "use_as_anomaly_signal": False}
    assert config.ratio_settings({}) == {} == config.ratio_settings({"model": {"derived_signals": None, "derived_features": []}})


def test_peer_settings_reach_the_run():
    raw = {"columns": {"customer_id": "id", "invoice_month": "m", "main_metric": "v"}}
    chosen = {
        "distribution_quality": {"iqr_weight": 0.5, "tail_full_penalty": 0.2}, "objective_quality_caps": {"weak_distribution_cap": 50}, "blocked_values": {"seg_": ["bad"]}, "max_inferred_cardinality": 9, "explicit_levels": ["a+b", ["a"]],
        "fallback_variables": ["segments"], "selection_mode": "narrow_first",
    }
    plain = config.compiled(raw | {"variables": {"segments": ["a", "b"]}, "peer_selection": chosen})
    got = config.from_mapping(plain, ["id", "m", "v", "a", "b"]).peers
    assert got.distribution == config.DISTRIBUTION | {"iqr_weight": 0.5, "tail_full_penalty": 0.2} and got.caps == config.OBJECTIVE_CAPS | {"weak_distribution_cap": 50.0}
    assert (got.blocked, got.max_cardinality, got.explicit, got.fallback, got.selection, got.priority) == ({"seg_": ("bad",)}, 9, (("a", "b"), ("a",)), ("a", "b"), "narrow_first", ("a", "b"))
    for bad in ({"priority_variable": ["a"]}, {"distribution_quality": {"iqr": 1}}, {"objective_quality_caps": {"cap": 1}}):
        with pytest.raises(ValueError, match="unknown keys"):
            config.from_mapping(config.compiled(raw | {"peer_selection": bad}), ["id", "m", "v"])
    with pytest.raises(ValueError, match="unknown keys of peers"):
        config.from_mapping(raw | {"peers": {"prioritty": []}}, ["id", "m", "v"])


def test_settings_change_the_scores(spark):
    df = spark.createDataFrame([(1.6, 0.9, 90.0, 0.0)], "peer_current_iqr_log double, peer_current_mad_log double, peer_representability_score double, peer_distribution_quality_score double")
    nothing = {c: F.lit(None).cast("double") for c in ("peer_history_monthly_iqr_log", "peer_history_monthly_mad_log", "peer_tail_rate", "peer_log_ratio_skew", "peer_log_ratio_kurtosis", "peer_mean_median_ratio", "peer_std_median_ratio")}
    score = lambda s: df.withColumns(nothing).select(peers.distribution_quality(s)).first()[0]
    none = {k: 0.0 if k.endswith("_weight") else v for k, v in config.DISTRIBUTION.items()}
    assert score(none | {"iqr_weight": 2.0}) == pytest.approx(0.0) and score(none | {"iqr_weight": 2.0, "current_iqr_log_full_penalty": 3.2, "history_iqr_log_full_penalty": 3.2}) == pytest.approx(50.0)
    assert score(none) == pytest.approx(100.0) and score(none | {"tail_weight": 1.0}) == pytest.approx(50.0)
    objective = lambda caps: df.select(peers.capped_objective(F.lit(99.0), config.OBJECTIVE_CAPS | caps)).first()[0]
    assert objective({}) == pytest.approx(47.0) and objective({"weak_distribution_penalty_per_point": 9.0}) == 0.0 and objective({"weak_distribution_penalty_per_point": 9.0, "minimum_cap": 12.0}) == 12.0
    gate = lambda blocked: spark.createDataFrame([(0, "x", True, 500, 500, 500, 500, 90.0)], "cand int, seg_a string, valid_main_metric_for_model boolean, hist_n int, moy_n int, recent_n int, current_n int, peer_distribution_quality_score double").select(peers.support_gate([peers.Candidate(0, ("seg_a",))], config.Support(), blocked)).first()[0]
    assert gate(config.BLOCKED) is True and gate({"seg_": ("x",)}) is False
