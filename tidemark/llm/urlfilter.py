"""URL filter by a character language-model ratio, in DataFrame functions alone.

Host rules decide the URLs they fit, and these URLs are also the training data:
two variable-order Markov models, one of URLs that rules allow and one of those
that rules block, give each character's probability after at most two
characters, by Witten-Bell interpolation of orders zero to two. A URL's score is
the mean over its characters of the difference of log-likelihoods; it is
accepted if the score reaches a threshold that is calibrated on held-out
training URLs. Characters are folded into a fixed alphabet, so a model has at
most ``len(ALPHABET) ** 3`` rows whatever the number of URLs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: The symbols of the models. '^' pads the beginning, '$' ends a URL, '*' is any other character, digits are one symbol.
ALPHABET = "^$*0abcdefghijklmnopqrstuvwxyz./-_%=&?#~+:@,;"
_ORDER_CHARS = 3
#: Score bins of the calibration, and held-out folds: one URL in FOLDS.
BIN = 0.01
FOLDS = 4


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (Rule("net", "/", False), Rule("example.net", "/en/", True), Rule("example.com", "/de/", False), Rule("org", "/fr/", True))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or no '://'."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lowered, F.regexp_extract(after, r"\A([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null if none does."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the last that fits wins
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, "allow" if r.allow else "block").otherwise(verdict)
    return text, verdict


def folded(url: Column) -> Column:
    """The symbols of a URL after '://' (all of it where that is missing): padded, folded and ended."""
    known = "".join(c for c in ALPHABET if c.isalpha() or c in "./-_%=&?#~+:@,;")
    lower = F.lower(F.coalesce(F.regexp_replace(url, r"\A[^:/?#]*://", ""), F.lit("")))
    one = F.regexp_replace(F.translate(lower, "0123456789", "0000000000"), "[^0" + "".join("\\" + c if not c.isalpha() else c for c in known) + "]", "*")
    return F.concat(F.lit("^^"), one, F.lit("$"))


def trigrams(symbols: Column) -> Column:
    """Each symbol with the two before it, the padding itself left out."""
    return F.transform(F.sequence(F.lit(1), F.length(symbols) - 2), lambda k: F.substr(symbols, k, F.lit(_ORDER_CHARS)))


def held_out(symbols: Column) -> Column:
    """Whether a training URL is kept for calibration: one in FOLDS, by the first hex digit of its MD5."""
    return F.conv(F.substring(F.md5(symbols), 1, 1), 16, 10).cast("int") % FOLDS == 0


def train(urls: DataFrame) -> DataFrame:
    """(gram, ratio): log P_allow - log P_block of every possible gram's last symbol after its first two.

    urls: symbols and allow. Each model is interpolated by Witten-Bell from order
    two down to the uniform distribution, so no probability is zero, and a
    class without any URL is uniform.
    """
    grams = urls.select("allow", F.explode(trigrams(F.col("symbols"))).alias("gram"))
    counts = grams.groupBy("gram").agg(F.count(F.when(F.col("allow"), 1)).alias("a"), F.count(F.when(~F.col("allow"), 1)).alias("b"))
    size, spark = len(ALPHABET), urls.sparkSession

    def symbol(k: int) -> Column:
        return F.substr(F.lit(ALPHABET), (F.floor(F.col("id") / size**k) % size + 1).cast("int"), F.lit(1))

    # All possible grams, so that counts of shorter ones and of contexts are sums over this table of fixed size.
    every = spark.range(size**_ORDER_CHARS).select(symbol(2).alias("x"), symbol(1).alias("y"), symbol(0).alias("z"))
    out = every.join(counts, F.concat("x", "y", "z") == F.col("gram"), "left").select("x", "y", "z", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    for name in ("a", "b"):
        over = lambda *c: F.sum(name).over(Window.partitionBy(*c))  # noqa: B023, E731
        out = out.withColumns({"n_yz": over("y", "z"), "n_z": over("z"), "n_xy": over("x", "y"), "n_y": over("y")})
        kinds = lambda c, *by: F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).over(Window.partitionBy(*by))
        # (x, y) meets each z once, y meets it `size` times, and the empty context size ** 2 times.
        out = out.withColumns({"k_xy": kinds(name, "x", "y"), "k_y": kinds("n_yz", "y") / size, "k": kinds("n_z", "x", "y"), "n": F.sum("n_z").over(Window.partitionBy("x", "y"))})
        p = F.lit(1.0 / size)
        for n, kind, total in (("n_z", "k", "n"), ("n_yz", "k_y", "n_y"), (name, "k_xy", "n_xy")):
            p = F.when(F.col(total) > 0, (F.col(n) + F.col(kind) * p) / (F.col(total) + F.col(kind))).otherwise(p)
        out = out.withColumn(f"p_{name}", p).drop("n_yz", "n_z", "n_xy", "n_y", "k_xy", "k_y", "k", "n")
    return out.select(F.concat("x", "y", "z").alias("gram"), (F.log("p_a") - F.log("p_b")).alias("ratio"))


def score(urls: DataFrame, model: DataFrame) -> DataFrame:
    """urls (symbols and any other columns) with score, the mean ratio over each row's symbols.

    A row's grams stand together, so they are averaged where they are made, and one
    row for each URL is shuffled, by all its columns and its place: no key is hot.
    """
    keys = [*urls.columns, "__row"]
    grams = urls.withColumn("__row", F.monotonically_increasing_id()).select(*keys, F.explode(trigrams(F.col("symbols"))).alias("gram"))
    bounded = F.broadcast(model)  # len(ALPHABET) ** 3 rows at most
    return grams.join(bounded, "gram").groupBy(*keys).agg(F.avg("ratio").alias("score")).drop("__row")


def threshold(scored: DataFrame, rejected: float) -> DataFrame:
    """One row (least): the score bin that rejects at most the share ``rejected`` of allowed URLs; scored: score, allow.

    Among bins that do, the one that tells allowed and blocked URLs apart best is
    taken, the lowest of equal ones. Null if there are no allowed URLs.
    """
    bins = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(F.count(F.when(F.col("allow"), 1)).alias("a"), F.count(F.when(~F.col("allow"), 1)).alias("b"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as there are bins
    cut = bins.select("bin", F.coalesce(F.sum("a").over(below), F.lit(0)).alias("lost"), F.coalesce(F.sum("b").over(below), F.lit(0)).alias("caught"), F.sum("a").over(Window.partitionBy()).alias("all_a"), F.sum("b").over(Window.partitionBy()).alias("all_b"))
    kept = cut.filter(F.col("lost") <= rejected * F.col("all_a"))
    gain = F.col("caught") / F.greatest("all_b", F.lit(1)) - F.col("lost") / F.greatest("all_a", F.lit(1))
    return kept.agg(F.max_by("bin", F.struct(gain, -F.col("bin"))).alias("bin")).select((F.col("bin") * BIN).alias("least"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, rejected: float = 0.05) -> DataFrame:
    """page_id, host, path, rule, verdict, score of each row of pages (page_id, url).

    A URL that no rule fits is accepted if its score reaches the calibrated
    threshold; without training URLs of both kinds all such URLs are accepted.
    Null and empty URLs have the symbols of an empty one. Repeated rows and
    page_ids are judged each by itself.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), folded(F.col("url")).alias("symbols"))
    known = rows.filter("ruled is not null").select("symbols", (F.col("ruled") == "allow").alias("allow"), held_out(F.col("symbols")).alias("held"))
    known = written(known, "url-training")
    trial = written(train(known.filter("not held")), "url-trial")
    limit = threshold(score(known.filter("held"), trial), rejected)
    both = known.agg(F.bool_or("allow"), F.bool_or(~F.col("allow"))).first()
    least = limit.first()["least"] if all(both) else None
    model = written(train(known), "url-model")
    out = score(rows, model)
    by_method = F.when(F.col("score") >= least, "allow").otherwise("block") if least is not None else F.lit("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_method).alias("verdict"), "score")


def judge_sql(rules: tuple[Rule, ...] = RULES, rejected: float = 0.05) -> str:
    """DuckDB SQL for page_id, host, path, rule, verdict of judge(), score rounded to six digits."""
    order = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in order) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{'allow' if r.allow else 'block'}'" for r in order) + " END"
    size = len(ALPHABET)

    def model(name: str, source: str) -> str:
        side = ""
        for c in ("a", "b"):
            side += (
                f", {name}_{c}1 AS (SELECT x, y, z, {c} AS n3, sum({c}) OVER (PARTITION BY y, z) AS n_yz, sum({c}) OVER (PARTITION BY z) AS n_z, sum({c}) OVER (PARTITION BY x, y) AS n_xy, sum({c}) OVER (PARTITION BY y) AS n_y, sum({c}) OVER () AS n_all FROM {name}_n)"
                f", {name}_{c}2 AS (SELECT *, sum((n3 > 0)::INT) OVER (PARTITION BY x, y) AS k_xy, sum((n_yz > 0)::INT) OVER (PARTITION BY y) / {size}.0 AS k_y, sum((n_z > 0)::INT) OVER (PARTITION BY x, y) AS k FROM {name}_{c}1)"
                f", {name}_{c}3 AS (SELECT *, CASE WHEN n_all > 0 THEN (n_z + k / {size}.0) / (n_all + k)::DOUBLE ELSE 1.0 / {size} END AS p1 FROM {name}_{c}2)"
                f", {name}_{c}4 AS (SELECT *, CASE WHEN n_y > 0 THEN (n_yz + k_y * p1) / (n_y + k_y)::DOUBLE ELSE p1 END AS p2 FROM {name}_{c}3)"
                f", {name}_{c} AS (SELECT x || y || z AS gram, CASE WHEN n_xy > 0 THEN (n3 + k_xy * p2) / (n_xy + k_xy)::DOUBLE ELSE p2 END AS p FROM {name}_{c}4)"
            )
        return (
            f", {name}_g AS (SELECT allow, unnest(list_transform(range(1, length(symbols) - 1), lambda i: substr(symbols, i, 3))) AS gram FROM {source})"
            f", {name}_c AS (SELECT gram, count(*) FILTER (allow) AS a, count(*) FILTER (NOT allow) AS b FROM {name}_g GROUP BY 1)"
            f", {name}_n AS (SELECT p.c AS x, q.c AS y, s.c AS z, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM letters p, letters q, letters s LEFT JOIN {name}_c ON gram = p.c || q.c || s.c)"
            f"{side}, {name} AS (SELECT l.gram, ln(l.p) - ln(r.p) AS ratio FROM {name}_a l JOIN {name}_b r ON l.gram = r.gram)"
        )

    def scored(name: str, source: str, kept: str) -> str:
        return f", {name} AS (SELECT {kept}, avg(ratio) AS score FROM (SELECT *, unnest(list_transform(range(1, length(symbols) - 1), lambda i: substr(symbols, i, 3))) AS gram FROM (SELECT *, row_number() OVER () AS place FROM {source})) g JOIN {{model}} m ON g.gram = m.gram GROUP BY place, {kept})"

    return (
        "WITH letters AS (SELECT unnest(string_split('" + ALPHABET + "', '')) AS c)"
        ", cut AS (SELECT page_id, url, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)"
        ", parts AS (SELECT *, regexp_extract(rest, '^([^/?#]*)', 1) AS raw_host FROM cut)"
        ", named AS (SELECT page_id, url, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw_host) + 1), '^([^?#]*)', 1) AS path FROM parts)"
        f", ruled AS (SELECT page_id, host, path, {rule} AS rule, {verdict} AS ruled, '^^' || regexp_replace(translate(lower(regexp_replace(coalesce(url, ''), '^[^:/?#]*://', '')), '0123456789', '0000000000'), '[^0a-z./\\-_%=&?#~+:@,;]', '*', 'g') || '$' AS symbols FROM named)"
        f", known AS (SELECT symbols, ruled = 'allow' AS allow, ('0x' || substr(md5(symbols), 1, 1))::INT % {FOLDS} = 0 AS held FROM ruled WHERE ruled IS NOT NULL)"
        ", fitted AS (SELECT * FROM known WHERE NOT held), held AS (SELECT * FROM known WHERE held)"
        + model("trial", "fitted")
        + scored("trial_scores", "held", "symbols, allow").format(model="trial")
        + f", bins AS (SELECT floor(score / {BIN}) AS bin, count(*) FILTER (allow) AS a, count(*) FILTER (NOT allow) AS b FROM trial_scores GROUP BY 1)"
        ", run AS (SELECT bin, coalesce(sum(a) OVER w, 0) AS lost, coalesce(sum(b) OVER w, 0) AS caught, sum(a) OVER () AS all_a, sum(b) OVER () AS all_b FROM bins WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"
        f", best AS (SELECT bin * {BIN} AS least FROM run WHERE lost <= {rejected} * all_a ORDER BY caught / greatest(all_b, 1) - lost / greatest(all_a, 1) DESC, bin LIMIT 1)"
        + model("whole", "known")
        + scored("page_scores", "ruled", "page_id, host, path, rule, ruled, symbols").format(model="whole")
        + " SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict, round(score, 6) + 0.0 AS score FROM page_scores LEFT JOIN best ON true"
    )
