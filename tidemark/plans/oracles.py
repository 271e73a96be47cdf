"""DuckDB SQL of the registered queries, built from one chain of common table expressions."""

from __future__ import annotations

from ..functions.periods import to_ord

MONTH, FIRST = 200107, 23984
#: Rows that count as full support by default.
STRONG = (800, 100, 150, 120)

_SIGNALS = ("self_history", "customer_trend", "customer_seasonal", "customer_recent_regime", "historical_peer", "current_peer", "peer_trend", "feature_ratio")
_FAMILY = {"customer": _SIGNALS[:4], "peer": _SIGNALS[4:]}


def _mad(source: str) -> str:
    return f"greatest(coalesce(1.4826 * {source}, 0.0), 0.2)"


def _ratio(text: str, full: str) -> str:
    return f"coalesce(least(greatest({text}, 0.0) / {full}, 1.0), 0.5)"


def _direction(family: str, direction: str) -> str:
    sign = ">= 0.5" if direction == "HIGH" else "<= -0.5"
    return "[" + ", ".join(f"CASE WHEN coalesce({'CASE WHEN regime_ok THEN ' if s == 'customer_recent_regime' else ''}{s}_z{' END' if s == 'customer_recent_regime' else ''} {sign}, false) THEN {s}_p ELSE 1.0 END" for s in _FAMILY[family]) + "]"


def _p_value(signal: str) -> str:
    z = "CASE WHEN regime_ok THEN customer_recent_regime_z END" if signal == "customer_recent_regime" else f"{signal}_z"
    side = f"CASE WHEN {z} >= 0.5 THEN 1 WHEN {z} <= -0.5 THEN -1 END"
    rank = f"rank() OVER (PARTITION BY cand, {side} ORDER BY abs({z}) DESC NULLS LAST) / (count(*) OVER (PARTITION BY cand, {side}) + 1.0)"
    own = f"greatest(1.0 - least(coalesce(abs({signal}_z), 0.0) / 3.0, 1.0), 0.001)"
    return f"CASE WHEN {side} IS NOT NULL THEN greatest({own}, least(greatest({rank}, 0.001), 1.0)) ELSE 1.0 END AS {signal}_p"


def _scaled(factor: float) -> str:
    """The metric of the customers in ``base`` that have a positive one, multiplied."""
    return f"main_metric * CASE WHEN customer_id IN (SELECT customer_id FROM base WHERE main_metric > 0) THEN {factor} ELSE 1.0 END"


def chain(month: int = MONTH, first: int = FIRST, factor: float = 1.0, repeated: bool = False, groups: int = 0, strong: tuple[int, int, int, int] = STRONG) -> list[tuple[str, str]]:
    """(name, body) of each expression, each of which may use those before it.

    first: the first month of the window; repeated: whether the source is the orders
    themselves, of which a customer-month takes the first quantity that is there;
    groups: in place of the region, so many groups of balances by the rank of their
    medians over the window, of balances with two rows or more; strong: the rows of
    history, season, recent months and the month that count as full support.
    """
    region = "SELECT * FROM panel0"
    if groups:
        cuts = " + ".join(f"(r - 1 > (n - 1) * {k} / {groups}.0)::INT" for k in range(1, groups))
        region = (
            f"SELECT p.* REPLACE (coalesce(g.label, 'low_support') AS region) FROM panel0 p LEFT JOIN (SELECT balance, 'g' || ({cuts}) AS label FROM (SELECT balance, row_number() OVER (ORDER BY m, CAST(balance AS VARCHAR)) AS r, count(*) OVER () AS n "
            f"FROM (SELECT balance, median(y) AS m FROM panel0 WHERE valid AND month_ord BETWEEN {first} AND {to_ord(month) - 1} GROUP BY 1 HAVING count(*) >= 2))) g ON p.balance = g.balance"
        )
    quantity = "arg_min(quantity, orderkey) FILTER (quantity IS NOT NULL) AS quantity, 1 AS orders" if repeated else "sum(quantity) AS quantity, count(*) AS orders"
    ordinal = to_ord(month)
    steps: list[tuple[str, str]] = [
        ("lines", "SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1"),
        (
            "order_rows",
            "SELECT o_orderkey AS orderkey, o_orderstatus AS status, o_custkey AS customer, year(o_orderdate) * 100 + month(o_orderdate) AS month, o_totalprice AS amount, quantity, c_mktsegment AS segment, r_name AS region, n_name AS nation, c_acctbal AS balance "
            "FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
        ),
        ("src", f"SELECT customer, month, sum(amount) AS amount, {quantity}, min(segment) AS segment, min(region) AS region, min(nation) AS nation, min(balance) AS balance FROM order_rows GROUP BY 1, 2"),
        (
            "panel0",
            "SELECT CAST(customer AS VARCHAR) AS customer_id, CAST(month AS INTEGER) AS invoice_month, CAST(amount AS DOUBLE) AS main_metric, CAST(quantity AS DOUBLE) AS reference_feature, CAST(orders AS DOUBLE) AS exposure_feature, segment, region, nation, balance, "
            "CAST(month // 100 * 12 + month % 100 AS INTEGER) AS month_ord, CAST(month % 100 AS INTEGER) AS month_of_year, coalesce(amount >= 0, false) AS valid, CASE WHEN amount >= 0 THEN ln(1 + amount) END AS y, "
            "CASE WHEN amount >= 0 AND quantity > 0 THEN ln(1 + amount) - ln(1 + quantity) END AS ratio FROM src",
        ),
        ("panel1", region),
        ("panel", "SELECT *, count(*) OVER (PARTITION BY customer_id) AS obs, lag(month_ord) OVER (PARTITION BY customer_id ORDER BY invoice_month) AS previous FROM panel1"),
        ("hist", f"SELECT * FROM panel WHERE valid AND month_ord BETWEEN {first} AND {ordinal - 1}"),
        ("now", f"SELECT * REPLACE ({_scaled(factor)} AS main_metric, CASE WHEN valid THEN ln(1 + {_scaled(factor)}) END AS y) FROM panel WHERE invoice_month = {month}" if factor != 1 else f"SELECT * FROM panel WHERE invoice_month = {month}"),
        ("seg1", "SELECT segment, region, count(*) AS n, median(y) AS med FROM hist GROUP BY 1, 2"),
        ("seg_robust", f"SELECT h.segment, h.region, any_value(n) AS n, any_value(med) AS med, {_mad('median(abs(y - med))')} AS mad FROM hist h JOIN seg1 s ON h.segment = s.segment AND h.region = s.region GROUP BY 1, 2"),
        # customers' own history
        ("own0", "SELECT customer_id FROM hist GROUP BY 1 HAVING count(*) >= 2"),
        ("own_rows", f"SELECT h.*, month_ord BETWEEN {ordinal - 3} AND {ordinal - 1} AS recent, month_of_year = {month % 100} AS season FROM hist h SEMI JOIN own0 o ON h.customer_id = o.customer_id"),
        (
            "own1",
            f"SELECT customer_id, count(*) AS prior_n, median(y) AS prior_median, count(*) FILTER (season) AS season_n, median(y) FILTER (season) AS season_median, count(*) FILTER (recent) AS recent_n, median(y) FILTER (recent) AS recent_median, "
            f"min(y) FILTER (recent) AS recent_min, max(y) FILTER (recent) AS recent_max, count(*) FILTER (month_ord BETWEEN {ordinal - 12} AND {ordinal - 1}) AS prior_12_n, max(month_ord) AS last_ord, arg_max(y, month_ord) AS last_y, "
            "regr_slope(y, month_ord) AS slope, avg(y) AS my, avg(month_ord) AS mx FROM own_rows GROUP BY 1",
        ),
        ("own2", "SELECT r.customer_id, median(abs(y - prior_median)) AS a, median(abs(y - season_median)) FILTER (season) AS b, median(abs(y - recent_median)) FILTER (recent) AS c FROM own_rows r JOIN own1 o ON r.customer_id = o.customer_id GROUP BY 1"),
        (
            "own",
            f"SELECT o.*, {_mad('a')} AS prior_mad, CASE WHEN season_n > 0 THEN {_mad('b')} END AS season_mad, CASE WHEN recent_n > 0 THEN {_mad('c')} END AS recent_mad, least(greatest(slope, -1.0), 1.0) AS trend_slope, my - least(greatest(slope, -1.0), 1.0) * mx AS trend_intercept "
            "FROM own1 o JOIN own2 p ON o.customer_id = p.customer_id",
        ),
        (
            "rows1",
            f"SELECT n.*, prior_n, prior_12_n, season_n, recent_n AS own_recent_n, last_ord, CASE WHEN prior_n >= 2 THEN (y - prior_median) / prior_mad END AS self_history_z, CASE WHEN prior_n >= 6 THEN (y - (trend_intercept + trend_slope * {ordinal})) / prior_mad END AS customer_trend_z, "
            "CASE WHEN season_n >= 2 THEN (y - season_median) / season_mad END AS customer_seasonal_z, CASE WHEN recent_n >= 3 AND recent_max - recent_min <= 0.35 THEN (y - recent_median) / recent_mad END AS customer_recent_regime_z, "
            f"greatest({ordinal} - last_ord - 1, 0) AS gap, CASE WHEN coalesce(prior_n, 0) > 0 THEN least(prior_12_n / 12.0, 1.0) ELSE 0.0 END AS coverage FROM now n LEFT JOIN own o ON n.customer_id = o.customer_id",
        ),
        (
            "rows",
            "SELECT *, NOT coalesce(abs(customer_seasonal_z) <= 1.5 AND abs(customer_recent_regime_z) >= 2.5, false) AS regime_ok, greatest(least(coalesce(CASE WHEN last_ord IS NULL THEN NULL ELSE gap END, 12) / 6.0 * 100.0, 100.0), (1.0 - coverage) * 100.0) AS data_gap, "
            "CASE WHEN coalesce(prior_n, 0) = 0 THEN 0.0 ELSE 100.0 * (0.25 * least(prior_n / 6.0, 1.0) + 0.25 * coverage + 0.20 * (1.0 - least(gap, 6) / 6.0) + 0.20 * (customer_trend_z IS NOT NULL)::INT + 0.10 * (customer_seasonal_z IS NOT NULL)::INT) END AS explain FROM rows1",
        ),
        # peers
        ("cands", "SELECT * FROM (VALUES (0, 'segment+region', 2), (1, 'segment', 1), (2, 'region', 1), (3, 'global', 0)) c(cand, level_name, width)"),
    ]

    key = """CASE cand WHEN 0 THEN '{"k0":"' || segment || '","k1":"' || region || '"}' WHEN 1 THEN '{"k0":"' || segment || '"}' WHEN 2 THEN '{"k0":"' || region || '"}' ELSE 'ALL' END AS key"""
    recent, season = f"month_ord BETWEEN {ordinal - 3} AND {ordinal - 1}", f"month_of_year = {month % 100}"

    steps += [
        ("xnow", f"SELECT n.*, cand, {key} FROM now n, cands WHERE valid"),
        ("xkeys", "SELECT DISTINCT cand, key FROM xnow"),
        ("xall", f"SELECT h.*, cand, {key} FROM hist h, cands"),
        ("xhist", "SELECT x.* FROM xall x SEMI JOIN xkeys k ON x.cand = k.cand AND x.key = k.key"),
        (
            "lev1",
            f"SELECT cand, key, count(*) AS hist_n, median(y) AS hist_median, count(*) FILTER ({recent}) AS recent_n, median(y) FILTER ({recent}) AS recent_median, count(*) FILTER ({season}) AS moy_n, median(y) FILTER ({season}) AS moy_median, count(ratio) AS ratio_n, median(ratio) AS ratio_median FROM xhist GROUP BY 1, 2",
        ),
        (
            "lev2",
            f"SELECT x.cand, x.key, {_mad('median(abs(y - hist_median))')} AS hist_mad, CASE WHEN any_value(recent_n) > 0 THEN {_mad(f'median(abs(y - recent_median)) FILTER ({recent})')} END AS recent_mad, CASE WHEN any_value(moy_n) > 0 THEN {_mad(f'median(abs(y - moy_median)) FILTER ({season})')} END AS moy_mad, "
            f"CASE WHEN any_value(ratio_n) > 0 THEN {_mad('median(abs(ratio - ratio_median))')} END AS ratio_mad FROM xhist x JOIN lev1 l ON x.cand = l.cand AND x.key = l.key GROUP BY 1, 2",
        ),
        ("cur1", "SELECT cand, key, count(*) AS current_n, median(y) AS current_median, avg(main_metric) AS c_mean, median(main_metric) AS c_mid, stddev_pop(main_metric) AS c_sd, quantile_cont(y, 0.75) - quantile_cont(y, 0.25) AS c_iqr FROM xnow GROUP BY 1, 2"),
        ("cur2", f"SELECT x.cand, x.key, {_mad('median(abs(y - current_median))')} AS current_mad FROM xnow x JOIN cur1 c ON x.cand = c.cand AND x.key = c.key GROUP BY 1, 2"),
        ("monthly", "SELECT cand, key, month_ord, month_of_year, count(*) AS n, median(y) AS m, quantile_cont(y, 0.75) - quantile_cont(y, 0.25) AS iqr FROM xhist GROUP BY 1, 2, 3, 4"),
        ("trend", "SELECT cand, key, sum(n) AS trend_n, count(*) AS months, least(greatest(regr_slope(m, month_ord), -1.0), 1.0) AS slope, avg(m) AS my, avg(month_ord) AS mx, median(iqr) AS h_iqr FROM monthly GROUP BY 1, 2"),
        ("shape", "SELECT cand, key, count(*) AS n, skewness(y) AS skew, kurtosis(y) AS kurt, median(y) AS med, stddev_pop(y) AS sd FROM xhist GROUP BY 1, 2"),
        ("shape_mad", "SELECT x.cand, x.key, 1.4826 * median(abs(y - med)) AS mad FROM xhist x JOIN shape s ON x.cand = s.cand AND x.key = s.key GROUP BY 1, 2"),
        ("tails", "SELECT x.cand, x.key, CASE WHEN any_value(s.n) >= 20 THEN avg(CASE WHEN abs(y - med) > 3 * CASE WHEN mad > 0 THEN mad ELSE sd END THEN 1.0 ELSE 0.0 END) END AS tail FROM xhist x JOIN shape s ON x.cand = s.cand AND x.key = s.key JOIN shape_mad m ON x.cand = m.cand AND x.key = m.key GROUP BY 1, 2"),
        ("cal_rows", f"SELECT * FROM xhist WHERE month_ord < {ordinal - 6}"),
        ("cal1", "SELECT cand, key, median(y) AS med, count(DISTINCT month_ord) AS months FROM cal_rows GROUP BY 1, 2 HAVING count(DISTINCT month_ord) >= 3"),
        ("cal2", f"SELECT x.cand, x.key, any_value(med) AS med, {_mad('median(abs(y - med))')} AS mad FROM cal_rows x JOIN cal1 c ON x.cand = c.cand AND x.key = c.key GROUP BY 1, 2"),
        ("cal3", "SELECT cand, key, month_of_year, median(y) AS s FROM cal_rows GROUP BY 1, 2, 3"),
        ("cal4", f"SELECT m.cand, m.key, abs((m - coalesce(s, med)) / mad) AS r FROM monthly m JOIN cal2 c ON m.cand = c.cand AND m.key = c.key LEFT JOIN cal3 t ON m.cand = t.cand AND m.key = t.key AND m.month_of_year = t.month_of_year WHERE month_ord BETWEEN {ordinal - 6} AND {ordinal - 1}"),
        ("cal", "SELECT cand, key, count(*) AS cal_n, median(r) AS cal_r, avg(CASE WHEN r <= 3 THEN 1.0 ELSE 0.0 END) AS cal_cover, avg(CASE WHEN r >= 2.5 THEN 1.0 ELSE 0.0 END) AS cal_false FROM cal4 GROUP BY 1, 2"),
        (
            "level0",
            "SELECT l.*, hist_mad, recent_mad, moy_mad, ratio_mad, current_n, current_median, current_mad, c_mean / greatest(c_mid, 1e-6) AS mean_ratio, c_sd / greatest(c_mid, 1e-6) AS sd_ratio, c_iqr, h_iqr, skew, kurt, tail, trend_n, CASE WHEN months >= 2 THEN slope END AS slope, my - slope * mx AS intercept, "
            "coalesce(cal_n, 0) AS cal_n, cal_r, cal_cover, cal_false, coalesce(100.0 * (0.45 * (1.0 - least(cal_r / 3.0, 1.0)) + 0.35 * cal_cover + 0.20 * (1.0 - cal_false)), 50.0) AS calibration FROM lev1 l JOIN lev2 m ON l.cand = m.cand AND l.key = m.key "
            "LEFT JOIN cur1 c ON l.cand = c.cand AND l.key = c.key LEFT JOIN cur2 d ON l.cand = d.cand AND l.key = d.key LEFT JOIN trend t ON l.cand = t.cand AND l.key = t.key LEFT JOIN shape s ON l.cand = s.cand AND l.key = s.key LEFT JOIN tails u ON l.cand = u.cand AND l.key = u.key LEFT JOIN cal k ON l.cand = k.cand AND l.key = k.key",
        ),
        (
            "level",
            f"SELECT *, 100.0 * (1.0 - (0.30 * greatest({_ratio('c_iqr', '1.6')}, {_ratio('h_iqr', '1.8')}) + 0.25 * greatest({_ratio('c_iqr / 1.349', '0.9')}, {_ratio('h_iqr / 1.349', '1.0')}) + 0.20 * {_ratio('tail', '0.1')} + 0.05 * {_ratio('abs(skew)', '2.0')} + 0.05 * {_ratio('kurt', '6.0')} "
            f"+ 0.05 * CASE WHEN mean_ratio > 0 THEN least(abs(ln(mean_ratio)) / ln(8.0), 1.0) ELSE 0.5 END + 0.10 * {_ratio('sd_ratio', '12.0')})) AS distribution FROM level0",
        ),
        (
            "paired",
            f"SELECT r.*, c.cand, c.level_name, c.width, l.* EXCLUDE (cand, key) FROM (SELECT r.*, cand, {key} FROM rows r, cands) r JOIN cands c ON r.cand = c.cand LEFT JOIN level l ON r.cand = l.cand AND r.key = l.key",
        ),
        ("gated", "SELECT * FROM paired WHERE valid AND hist_n >= 100 AND moy_n >= 5 AND recent_n >= 10 AND current_n >= 5 AND distribution >= 20"),
        ("q1", "SELECT *, CASE cand WHEN 0 THEN 0.25 + 0.55 + 0.20 * 0.5 WHEN 1 THEN 0.25 + 0.275 + 0.20 WHEN 2 THEN 0.25 + 0.275 ELSE 0.25 END AS spec, least(hist_n / %.1f, 1.0) AS h, least(moy_n / %.1f, 1.0) AS m, least(recent_n / %.1f, 1.0) AS r, least(current_n / %.1f, 1.0) AS c FROM gated" % strong),
        (
            "q2",
            "SELECT *, 100.0 * (0.26 * h + 0.15 * m + 0.21 * r + 0.26 * c + 0.12 * spec) * (0.5 + 0.5 * distribution / 100.0) AS represent, 100.0 * (0.30 * h + 0.20 * m + 0.25 * r + 0.25 * c) AS support, "
            "100.0 * (1.0 - (0.65 * least(abs(recent_median - hist_median) / greatest(hist_mad, recent_mad, 0.1) / 3.0, 1.0) + 0.35 * least(abs(ln(recent_mad / hist_mad)) / 1.5, 1.0))) AS stability FROM q1",
        ),
        ("q3", "SELECT *, 0.20 * represent + 0.30 * distribution + 0.20 * calibration + 0.10 * stability + 0.10 * 100.0 * spec + 0.10 * support AS raw_objective FROM q2"),
        (
            "q4",
            "SELECT *, least(CASE WHEN distribution < 40 THEN least(raw_objective, 55 - 0.2 * (40 - distribution)) WHEN distribution < 60 THEN least(raw_objective, 70 - 0.1 * (60 - distribution)) ELSE raw_objective END, "
            "CASE WHEN represent < 40 THEN 55 - 0.15 * (40 - represent) WHEN represent < 60 THEN 70 - 0.05 * (60 - represent) ELSE 100 END) AS objective, CASE WHEN width <= 1 THEN 'COARSE_PEER_REVIEW' WHEN represent >= 40 AND distribution < 60 THEN 'LIMITED_WIDE_PEER_REVIEW' WHEN represent >= 80 THEN 'STRONG_PEER_REPRESENTATION' WHEN represent >= 60 THEN 'GOOD_PEER_REPRESENTATION' WHEN represent >= 40 THEN 'MEDIUM_PEER_REPRESENTATION' ELSE 'WEAK_PEER_REPRESENTATION' END AS represent_status FROM q3",
        ),
        (
            "z",
            f"SELECT *, recent_median + moy_median - hist_median AS expected_log, greatest(hist_mad, recent_mad, moy_mad, 0.2) AS scale, (y - (recent_median + moy_median - hist_median)) / greatest(hist_mad, recent_mad, moy_mad, 0.2) AS historical_peer_z, (y - current_median) / current_mad AS current_peer_z, "
            f"CASE WHEN trend_n >= 120 THEN (y - (intercept + slope * {ordinal})) / greatest(hist_mad, recent_mad, moy_mad, 0.2) END AS peer_trend_z, CASE WHEN ratio IS NOT NULL AND ratio_n >= 50 THEN (ratio - ratio_median) / ratio_mad END AS feature_ratio_z FROM q4",
        ),
        ("p", "SELECT *, " + ", ".join(_p_value(s) for s in _SIGNALS) + " FROM z"),
        ("lists", "SELECT *, " + ", ".join(f"list_sort(list_filter({_direction(f, d)}, lambda x: x < 1.0))[1:3] AS {f[0]}_{d}" for f in _FAMILY for d in ("HIGH", "LOW")) + " FROM p"),
        ("fam0", "SELECT *, " + ", ".join(f"least(coalesce(list_min(list_transform({f[0]}_{d}, lambda x, i: x * len({f[0]}_{d}) / i)), 1.0), 1.0) AS {f[0]}p_{d}" for f in _FAMILY for d in ("HIGH", "LOW")) + " FROM lists"),
        (
            "fam",
            "SELECT *, CASE WHEN cp_HIGH <= cp_LOW THEN 'HIGH' ELSE 'LOW' END AS c_dir, least(cp_HIGH, cp_LOW) AS c_p, CASE WHEN pp_HIGH <= pp_LOW THEN 'HIGH' ELSE 'LOW' END AS p_dir, least(pp_HIGH, pp_LOW) AS p_p, "
            "CASE WHEN coalesce(prior_n, 0) = 0 THEN 'CUSTOMER_NEW' WHEN prior_n >= 6 AND coverage >= 0.5 AND gap <= 1 THEN 'CUSTOMER_STRONG' WHEN prior_n >= 2 THEN 'CUSTOMER_PARTIAL' ELSE 'CUSTOMER_WEAK' END AS c_status, "
            "CASE WHEN objective < 60 OR distribution < 40 THEN 'PEER_WEAK' WHEN represent_status = 'COARSE_PEER_REVIEW' THEN 'PEER_COARSE_REVIEW' ELSE 'PEER_STRONG' END AS p_status FROM fam0",
        ),
        ("eff", "SELECT *, CASE WHEN c_status IN ('CUSTOMER_STRONG', 'CUSTOMER_PARTIAL') THEN c_p ELSE 1.0 END AS pc, CASE WHEN p_status = 'PEER_STRONG' THEN p_p ELSE 1.0 END AS pp FROM fam"),
        ("drv", "SELECT *, CASE WHEN pc <= 0.05 AND pp <= 0.05 AND c_dir = p_dir THEN 'CUSTOMER_PEER_COMBINED' WHEN pc <= 0.05 AND pp <= 0.05 THEN 'CUSTOMER_PEER_CONFLICT' WHEN pc <= 0.05 THEN 'CUSTOMER' WHEN pp <= 0.05 THEN 'PEER' WHEN least(pc, pp) >= 1 THEN 'INSUFFICIENT_EVIDENCE' ELSE 'WEAK_EVIDENCE' END AS driver FROM eff"),
        (
            "ev",
            "SELECT *, 100.0 * (1.0 - CASE WHEN driver = 'CUSTOMER_PEER_COMBINED' THEN least(1.0, 2 * least(pc, pp), greatest(pc, pp)) ELSE least(pc, pp) END) AS raw_score, CASE WHEN driver = 'CUSTOMER_PEER_COMBINED' OR pc <= pp THEN c_dir ELSE p_dir END AS direction, "
            "CASE WHEN driver = 'CUSTOMER_PEER_COMBINED' THEN greatest(explain, represent) + 13 WHEN driver = 'CUSTOMER_PEER_CONFLICT' THEN greatest(explain, 55) - 20 WHEN driver = 'CUSTOMER' THEN greatest(explain, 55) WHEN driver = 'PEER' THEN greatest(represent, 45) ELSE greatest(explain, represent) END AS conf0 FROM drv",
        ),
        ("ev2", "SELECT *, greatest(conf0 - least(data_gap * 0.25, 25) - greatest(0, (60 - distribution) * 0.35), 0) AS conf1 FROM ev"),
        ("evidence", "SELECT *, least(least(conf1, CASE WHEN self_history_z IS NULL THEN 75 ELSE 100 END), CASE WHEN represent_status = 'COARSE_PEER_REVIEW' THEN 65 ELSE 100 END) AS confidence FROM ev2"),
        ("best", "SELECT *, count(*) OVER (PARTITION BY customer_id) AS supported FROM evidence QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY objective DESC NULLS LAST, calibration DESC NULLS LAST, represent DESC NULLS LAST, distribution DESC NULLS LAST, spec DESC, cand) = 1"),
        ("cuts", "SELECT greatest(60.0, quantile_cont(raw_score, 0.97)) AS watch_at, greatest(80.0, quantile_cont(raw_score, 0.9925)) AS high_at FROM best"),
        (
            "lab1",
            "SELECT b.*, watch_at, high_at, 100.0 * ((rank() OVER (ORDER BY raw_score)) + (count(*) OVER (PARTITION BY raw_score) - 1) / 2.0) / count(*) OVER () AS pct, greatest(" + ", ".join(f"abs(coalesce({'CASE WHEN regime_ok THEN ' if s == 'customer_recent_regime' else ''}{s}_z{' END' if s == 'customer_recent_regime' else ''}, 0))" for s in _SIGNALS) + ") AS max_z, "
            "abs(ln(greatest(main_metric / greatest(exp(expected_log) - 1, 1e-6), 1e-6))) AS effect FROM best b, cuts",
        ),
        ("lab2", "SELECT *, raw_score >= high_at AND max_z >= 2.5 AND effect >= 0.26 AS high, raw_score >= watch_at AND max_z >= 1.5 AND effect >= 0.14 AS watch0 FROM lab1"),
        (
            "labelled",
            "SELECT *, CASE WHEN high THEN direction || '_MAIN_METRIC_ANOMALY' WHEN watch0 THEN 'WATCHLIST_' || direction ELSE 'NORMAL' END AS label, CASE WHEN high THEN greatest(pct, 99.25) WHEN watch0 THEN least(greatest(pct, 97.0), 99.24) ELSE least(pct, 96.99) END AS score FROM lab2",
        ),
    ]
    return steps + diagnosis_steps()


def _top(names: tuple[str, ...], value: str) -> str:
    """Of the signal with the greatest |z|, the first of equal ones, its z or its name; 0 or '' where all are null."""
    most = "greatest(" + ", ".join(f"coalesce(abs({n}_z), -1.0)" for n in names) + ")"
    return "CASE " + " ".join(f"WHEN abs({n}_z) = {most} THEN " + (f"{n}_z" if value == "z" else f"'{n}'") for n in names) + (" ELSE 0.0 END" if value == "z" else " ELSE '' END")


def diagnosis_steps() -> list[tuple[str, str]]:
    moved = lambda n, up, down: f"CASE WHEN {n}_z >= 2.5 THEN '{up}' WHEN {n}_z <= -2.5 THEN '{down}' END"
    jump = lambda n: moved(n, f"{n.upper()}_JUMP", f"{n.upper()}_DROP")
    codes = [
        jump("historical_peer"), jump("current_peer"), jump("peer_trend"), moved("feature_ratio", "FEATURE_RATIO_HIGH", "FEATURE_RATIO_LOW"), jump("self_history"), "CASE WHEN self_moved AND conflict THEN 'PEER_SELF_CONFLICT' END", jump("customer_trend"),
        jump("customer_seasonal"), jump("customer_recent_regime"), "CASE WHEN NOT self_moved AND conflict THEN 'PEER_SELF_CONFLICT' END", "CASE WHEN mismatch THEN 'CUSTOMER_STABLE_PEER_MISMATCH' END",
        "CASE alignment WHEN 'YAPISAL_PEER_ALTINDA_MUSTERI_STABIL' THEN 'STRUCTURAL_PEER_BELOW_SELF_STABLE' WHEN 'YAPISAL_PEER_USTUNDE_MUSTERI_STABIL' THEN 'STRUCTURAL_PEER_ABOVE_SELF_STABLE' END", "CASE WHEN prior < 2 THEN 'CUSTOMER_HISTORY_UNAVAILABLE' END",
        "CASE WHEN prior = 0 THEN 'FIRST_SEEN_IN_SCORING_MONTH' END", "CASE WHEN last_ord IS NOT NULL AND gap >= 2 THEN 'RECENT_DATA_GAP' END", "CASE WHEN coverage < 0.5 THEN 'LOW_12M_COVERAGE' END", "CASE WHEN level_name IN ('segment', 'global') THEN 'COARSE_PEER_GROUP' END", "CASE WHEN confidence < 55 THEN 'LOW_CONFIDENCE' END",
    ]
    return [
        (
            "diag1",
            f"SELECT *, {_top(_SIGNALS[4:], 'z')} AS peer, {_top(_SIGNALS[:4], 'z')} AS own, {_top(_SIGNALS, 'name')} AS strongest, label <> 'NORMAL' AS flagged, coalesce(prior_n, 0) AS prior, coalesce(abs(self_history_z) >= 2.5, false) AS self_moved, exp(expected_log) - 1 AS expected, "
            + " + ".join(f"coalesce(abs({n}_z) >= 2.5, false)::INT" for n in _SIGNALS) + " AS strong_n, CASE WHEN coalesce(prior_n, 0) = 0 THEN 'PEER_ONLY_NEW_CUSTOMER' WHEN prior_n < 2 THEN 'PEER_ONLY_SPARSE_CUSTOMER_HISTORY' WHEN customer_trend_z IS NOT NULL AND customer_seasonal_z IS NOT NULL THEN 'CUSTOMER_TREND_AND_SEASONAL_AVAILABLE' "
            "WHEN customer_trend_z IS NOT NULL THEN 'CUSTOMER_TREND_AVAILABLE' WHEN customer_recent_regime_z IS NOT NULL THEN 'CUSTOMER_RECENT_REGIME_AVAILABLE' WHEN self_history_z IS NOT NULL THEN 'CUSTOMER_HISTORY_AVAILABLE' ELSE 'PEER_ONLY_NO_CUSTOMER_HISTORY' END AS scoreability FROM labelled",
        ),
        (
            "diag2",
            "SELECT *, (abs(peer) >= 2.5 AND abs(own) >= 2.5 AND peer * own < 0) OR (abs(own) >= 2.5 AND ((direction = 'HIGH' AND own < 0) OR (direction = 'LOW' AND own > 0))) AS conflict, flagged AND prior >= 6 AND abs(peer) >= 2.5 AND abs(own) < 1.5 AS mismatch, "
            "CASE WHEN prior < 6 THEN 'MUSTERI_GECMISI_YETERSIZ' WHEN abs(peer) < 2.5 THEN 'PEER_UYUMLU' WHEN abs(own) >= 2.5 AND peer * own < 0 THEN 'PEER_MUSTERI_CELISKILI' WHEN abs(own) < 1.5 AND peer < 0 THEN 'YAPISAL_PEER_ALTINDA_MUSTERI_STABIL' WHEN abs(own) < 1.5 THEN 'YAPISAL_PEER_USTUNDE_MUSTERI_STABIL' "
            "WHEN peer < 0 AND own < 0 THEN 'PEER_ALTINDA_VE_MUSTERI_ICI_DUSUS' WHEN peer > 0 AND own > 0 THEN 'PEER_USTUNDE_VE_MUSTERI_ICI_YUKSELIS' ELSE 'PEER_FARKI_VAR_MUSTERI_SINYALI_ORTA' END AS alignment, CASE WHEN contains(label, 'HIGH') THEN 'HIGH' ELSE 'LOW' END AS side FROM diag1",
        ),
        (
            "diag3",
            "SELECT *, CASE WHEN NOT flagged THEN 'normal' WHEN conflict THEN 'peer_self_conflict' WHEN mismatch THEN 'customer_stable_peer_mismatch' ELSE 'consistent_or_peer_only' END AS consistency, CASE WHEN NOT flagged THEN 'normal' WHEN mismatch THEN CASE WHEN confidence >= 55 THEN 'medium' ELSE 'weak' END "
            "WHEN conflict THEN CASE WHEN confidence >= 55 AND strong_n >= 1 THEN 'medium' ELSE 'weak' END WHEN confidence >= 75 AND prior >= 6 AND data_gap <= 50 AND strong_n >= 2 THEN 'strong' WHEN confidence >= 55 AND strong_n >= 1 THEN 'medium' ELSE 'weak' END AS strength FROM diag2",
        ),
        (
            "diag4",
            "SELECT *, CASE WHEN NOT flagged THEN 'NORMAL' WHEN confidence < 55 THEN 'REVIEW_LOW_CONFIDENCE_' || side WHEN prior < 2 OR data_gap >= 80 THEN 'REVIEW_SPARSE_HISTORY_' || side WHEN mismatch THEN 'REVIEW_PEER_ASSIGNMENT_MISMATCH_' || side WHEN conflict THEN 'REVIEW_PEER_SELF_CONFLICT_' || side "
            "WHEN starts_with(label, 'WATCHLIST') THEN 'WATCHLIST_' || side WHEN strength = 'strong' THEN 'LIKELY_' || side || '_MAIN_METRIC_ANOMALY' ELSE 'REVIEW_' || side || '_MAIN_METRIC_ANOMALY' END AS action, concat_ws(', ', " + ", ".join(codes) + ") AS codes0 FROM diag3",
        ),
        (
            "diag",
            "SELECT *, CASE WHEN codes0 = '' THEN 'NO_MAJOR_DRIVER' ELSE codes0 END AS codes, CASE WHEN action = 'NORMAL' THEN 'NORMAL' WHEN starts_with(action, 'LIKELY_') THEN 'LIKELY_ANOMALY' WHEN starts_with(action, 'WATCHLIST_') THEN 'WATCHLIST' WHEN contains(action, 'PEER_ASSIGNMENT') THEN 'REVIEW_PEER_ASSIGNMENT' WHEN contains(action, 'CONFLICT') THEN 'REVIEW_SIGNAL_CONFLICT' "
            "WHEN contains(action, 'LOW_CONFIDENCE') OR contains(action, 'SPARSE_HISTORY') THEN 'REVIEW_LOW_CONFIDENCE' ELSE 'REVIEW_MAIN_METRIC_ANOMALY' END AS decision, CASE WHEN label = 'NORMAL' THEN 'within the expected range' ELSE label || ': ' || CASE WHEN direction = 'HIGH' THEN 'above' ELSE 'below' END || ' the expected ' || printf('%.2f', expected) || ' (' "
            "|| printf('%.2f', main_metric / greatest(expected, 1e-6)) || ' times); driver ' || driver || ', strongest signal ' || strongest || '; peer ' || level_name END AS reason FROM diag4",
        ),
    ]


def month_summary(month: int, first: int) -> str:
    """A backtest's row about a month."""
    label = lambda name: f"count(*) FILTER (label = '{name}') AS {name.lower()}_count"
    counts = ", ".join(map(label, ("NORMAL", "WATCHLIST_HIGH", "WATCHLIST_LOW", "HIGH_MAIN_METRIC_ANOMALY", "LOW_MAIN_METRIC_ANOMALY")))
    return with_chain(
        f"SELECT {month} AS scoring_month, '{month // 100}-{month % 100:02d}' AS calendar_month, count(*) AS scored_rows, {counts}, avg((label <> 'NORMAL')::INT) AS watch_or_anomaly_rate, avg((ends_with(label, 'MAIN_METRIC_ANOMALY'))::INT) AS high_anomaly_rate, median(score) AS median_score, quantile_cont(score, 0.95) AS p95_score, "
        "quantile_cont(score, 0.99) AS p99_score, median(confidence) AS median_confidence, median(objective) AS peer_objective_score_median, median(represent) AS peer_representability_score_median, median(distribution) AS peer_distribution_quality_score_median, median(calibration) AS peer_calibration_score_median, "
        "(SELECT count(*) FROM now n ANTI JOIN best b ON n.customer_id = b.customer_id) AS not_scored_rows FROM labelled",
        month, first,
    )


def with_chain(final: str, month: int = MONTH, first: int = FIRST, factor: float = 1.0, repeated: bool = False, groups: int = 0, strong: tuple[int, int, int, int] = STRONG) -> str:
    """The chain of a scored month with a final SELECT."""
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in chain(month, first, factor, repeated, groups, strong)) + "\n" + final


def sql(final: str) -> str:
    """The fixture's scored month with a final SELECT."""
    return with_chain(final)
