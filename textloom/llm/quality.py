"""Quality rules (operator 3, native): robust multivariate outliers.

Texts get counts, the counts a vector of transformed statistics. Per language
and source the minimum covariance determinant is estimated by concentration
steps: from a start (medians; and means) keep the 75 % of documents nearest by
Mahalanobis distance, estimate again, repeat until no group's determinant moves
(``STEPS`` at most); of both starts the smaller determinant stays. The nearest
75 % of normal vectors spread less than all of them, so their covariance is
scaled by the consistency factor. Means and covariance are then taken once more
over all documents within the 0.975 quantile (the reweighted estimate), scaled
likewise, which small groups need. A document whose distance to its group's
estimate exceeds the cutoff is rejected, as are documents that fail the base rules.

All of it is grouped aggregation: the nearest 75 % are found by counts of
distances in logarithmic bins (32 a doubling), whole bins at a time, so a hot
group is pre-aggregated and nothing is gathered. Covariances get a documented
floor on the diagonal (``FLOOR``), so a statistic that is constant in most of
a group does not make it singular. Groups under ``MIN_GROUP`` documents are
pooled by language, then overall. Where those pools are smaller too, all documents
of the language judge, and under ``MIN_GROUP`` of them all of the table, whose
covariance is widened by ``PRIOR`` with the weight of ``MIN_GROUP`` documents, so
few rows give a defined and cautious estimate.

Defined results: null or empty text has all counts zero and fails the base
rules; null language or source is a group value of its own; repeated rows are
judged alike; an empty table gives no rows; other input columns are kept, the
results replace columns of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import numbered, stored, table, without_rows, words

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

STATS = ("word_len", "symbols", "dup_lines", "upper")
# Standard deviation below which a statistic is not trusted.
FLOOR = {"word_len": 0.08, "symbols": 0.05, "dup_lines": 0.08, "upper": 0.06}
CUTOFF = 23.5        # squared distance: 0.9999 quantile of the 4-dimensional chi-square
SHARE = 0.75
MIN_GROUP = 50
PRIOR = {s: 4 * f for s, f in FLOOR.items()}     # standard deviations that widen the table's estimate
STEPS = 8
MOVE = 1e-2          # change of a log determinant that counts as none
CORE = 0.975         # share of normal vectors the reweighted estimate is taken over
BINS = 32
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
PAIRS = [(i, j) for i in range(len(STATS)) for j in range(i, len(STATS))]


def _chi2_cdf(x: float, dims: int) -> float:
    """Distribution function of the chi-square with an even number of dimensions."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dims // 2))


def quantile(share: float, dims: int = len(STATS)) -> float:
    """Quantile of the chi-square with ``dims`` (even) dimensions, by bisection."""
    lo, hi = 0.0, 100.0 * dims
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, dims) < share else (lo, mid)
    return hi


def consistency(share: float = SHARE, dims: int = len(STATS)) -> float:
    """What the covariance of the nearest ``share`` of normal vectors (``dims``
    even) is multiplied by to equal that of all."""
    return share / _chi2_cdf(quantile(share, dims), dims + 2)


def _covered(starts: Column) -> Column:
    """Words covered by windows that begin at the sorted ``starts``."""
    return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("end")), lambda a, p: F.struct(
        (a.n + F.least(F.lit(WINDOW), p + WINDOW - a.end)).alias("n"), (p + WINDOW).alias("end")), lambda a: a.n)


def with_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the five counts and ``n_upper``, each of the whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = df.withColumn("_w", words(F.col(text_col)))
    out = out.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    # 64-bit hash of every 8-word window
    out = out.withColumn("_g", F.when(F.size("_h") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("_h") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(WINDOW)]))))
    # only texts that repeat a window pay for the sort that finds where
    out = out.withColumn("_d", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.array_sort(
        F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    at = F.array_sort(F.transform(F.filter(
        F.transform("_d", lambda x, i: F.struct(x.i.alias("i"), ((x.g == F.get(F.col("_d"), i - 1).g) |
                    (x.g == F.get(F.col("_d"), i + 1).g)).alias("r"))), lambda x: x.r), lambda x: x.i))
    lines = F.filter(F.split(text, "\n", -1), lambda s: F.regexp_like(s, F.lit(r"[^\x20\x09-\x0D]")))
    out = out.withColumn("_p", at).withColumn("_l", lines)
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return out.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": symbols.cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": F.coalesce(_covered(F.col("_p")), F.lit(0)).cast("long"),
        "n_lines": F.size("_l").cast("long"),
        "n_upper": (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long"),
    }).drop("_w", "_h", "_g", "_d", "_p", "_l")


def with_stats(df: DataFrame) -> DataFrame:
    """Add ``base_failed`` and the transformed statistics (shrunk to a fixed
    prior of 40 words, so short clean texts are not extreme)."""
    n = F.col("n_words") + 40.0
    return df.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT),
        "word_len": F.log((F.col("word_chars") + 40 * 5.5) / n),
        "symbols": F.log1p(F.col("n_symbols") / n),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5.0)),
        "upper": F.sqrt(F.col("n_upper") / (F.col("word_chars") + 200.0)),
    })


def grouped(stats: DataFrame) -> DataFrame:
    """Group table ``lang, source, pool, g_lang, g_source``: the estimate that
    judges each group. Pools: 0 the group, 1 the small groups of its language, 2
    all small groups, 3 the whole language, 4 the whole table."""
    n = (stats.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n")))
    n = stored(n, "mcd-groups")
    small = F.when(F.col("n") < MIN_GROUP, F.col("n"))
    by_lang = n.groupBy("lang").agg(F.sum(small).alias("n_small"), F.sum("n").alias("n_lang"))
    rest = by_lang.filter(F.col("n_small") < MIN_GROUP).agg(F.sum("n_small")).scalar()
    m = n.alias("a").join(by_lang.alias("b"), F.col("a.lang").eqNullSafe(F.col("b.lang")), "left").withColumn("n_rest", rest)
    pool = (F.when(F.col("a.n") >= MIN_GROUP, 0).when(F.col("b.n_small") >= MIN_GROUP, 1)
            .when(F.col("n_rest") >= MIN_GROUP, 2).when(F.col("b.n_lang") >= MIN_GROUP, 3).otherwise(4))
    return m.select(
        "a.lang", "a.source", pool.alias("pool"),
        F.when(pool.isin(0, 1, 3), F.col("a.lang")).alias("g_lang"),
        F.when(pool == 0, F.col("a.source")).alias("g_source"))


def members(groups: DataFrame) -> DataFrame:
    """``lang, source`` and the keys of every pool its rows are part of: the one
    that judges it, and whole languages and the whole table where they judge any."""
    wide = groups.groupBy("lang").agg(F.max(F.col("pool") == 3).alias("whole"))
    every = groups.agg(F.max(F.col("pool") == 4)).scalar()
    g = groups.alias("g").join(wide.alias("w"), F.col("g.lang").eqNullSafe(F.col("w.lang"))).withColumn("all", every)

    def key(pool, lang, source):
        return F.struct(pool.alias("pool"), lang.alias("g_lang"), source.alias("g_source"))
    none = F.lit(None).cast("string")
    return g.select("g.lang", "g.source", F.explode(F.array_compact(F.array(
        F.when(F.col("pool") < 3, key(F.col("pool"), F.col("g_lang"), F.col("g_source"))),
        F.when(F.col("whole"), key(F.lit(3), F.col("g.lang"), none)),
        F.when(F.col("all"), key(F.lit(4), none, none))))).alias("k")).select("lang", "source", "k.*")


KEY = ["pool", "g_lang", "g_source"]


def _same(a: str, b: str, cols) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def _moments(rows: DataFrame, scale: float = 1.0, by=tuple(KEY)) -> DataFrame:
    """Mean vector and covariance entries (times ``scale``) of each group."""
    out = rows.groupBy(*by).agg(
        F.count("*").alias("n"), *[F.avg(s).alias(f"m_{s}") for s in STATS],
        *[(F.covar_pop(STATS[i], STATS[j]) * scale).alias(f"c{i}{j}") for i, j in PAIRS])
    few = F.when(F.col("pool") == 4, MIN_GROUP / (F.col("n") + MIN_GROUP)).otherwise(F.lit(0.0))
    return out.withColumns({f"c{i}{i}": F.col(f"c{i}{i}") + FLOOR[s] ** 2 + few * PRIOR[s] ** 2 for i, s in enumerate(STATS)})


def _cholesky(p: DataFrame) -> DataFrame:
    """Lower triangle ``l_ij`` of the covariance and its log determinant."""
    k = len(STATS)
    for j in range(k):
        rest = {i: F.col(f"c{j}{i}") for i in range(j, k)}
        for i in rest:
            for x in range(j):
                rest[i] = rest[i] - F.col(f"l{i}{x}") * F.col(f"l{j}{x}")
        p = p.withColumn(f"l{j}{j}", F.sqrt(F.greatest(rest.pop(j), F.lit(1e-12))))
        if rest:
            p = p.withColumns({f"l{i}{j}": c / F.col(f"l{j}{j}") for i, c in rest.items()})
    logdet = F.lit(0.0)
    for i in range(k):
        logdet = logdet + 2 * F.log(F.col(f"l{i}{i}"))
    return p.withColumn("logdet", logdet)


def _distance(df: DataFrame, name: str = "d2") -> DataFrame:
    """Squared Mahalanobis distance by forward substitution."""
    total = F.lit(0.0)
    for i, s in enumerate(STATS):
        y = F.col(s) - F.col(f"m_{s}")
        for x in range(i):
            y = y - F.col(f"l{i}{x}") * F.col(f"_y{x}")
        df = df.withColumn(f"_y{i}", y / F.col(f"l{i}{i}"))
        total = total + F.col(f"_y{i}") * F.col(f"_y{i}")
    return df.withColumn(name, total).drop(*[f"_y{i}" for i in range(len(STATS))])


PARAMS = [f"m_{s}" for s in STATS] + [f"l{i}{j}" for j in range(len(STATS)) for i in range(j, len(STATS))] + ["logdet"]


STARTED = [*KEY, "start"]


def _attach(rows: DataFrame, params: DataFrame, cols, by=tuple(KEY)) -> DataFrame:
    return rows.alias("r").join(params.alias("p"), _same("r", "p", by), "left").select(
        "r.*", *[F.col(f"p.{c}") for c in cols])


def _nearest(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Rows of the distance bins that hold the nearest ``SHARE``, by start."""
    from pyspark.sql import Window

    d = _distance(_attach(rows, params, ["start", *PARAMS])).withColumn("_b", F.floor(F.log2(F.col("d2") + 1e-6) * BINS))
    counts = d.groupBy(*STARTED, "_b").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*STARTED)
    cut = (counts.withColumn("_to", F.sum("n").over(w.orderBy("_b"))).withColumn("_all", F.sum("n").over(w))
           .filter(F.col("_to") >= F.ceil(F.col("_all") * SHARE)).groupBy(*STARTED).agg(F.min("_b").alias("cut")))
    return _attach(d, cut, ["cut"], STARTED).filter("_b <= cut").select(*STARTED, *STATS)


def fit(stats: DataFrame, groups: DataFrame) -> DataFrame:
    """MCD estimate of each group: columns ``KEY`` and ``PARAMS``."""
    rows = (stats.filter("not base_failed").alias("r").join(members(groups).alias("g"), _same("r", "g", ["lang", "source"]))
            .select(*[F.col(f"g.{c}") for c in KEY], *[F.col(f"r.{s}") for s in STATS]))
    rows = stored(rows, "mcd-rows")
    centre = rows.groupBy(*KEY).agg(F.count("*").alias("n"), *[F.percentile_approx(s, 0.5, 1000).alias(f"m_{s}") for s in STATS])
    spread = _attach(rows, centre, [f"m_{s}" for s in STATS]).groupBy(*KEY).agg(
        *[F.percentile_approx(F.abs(F.col(s) - F.col(f"m_{s}")), 0.5, 1000).alias(f"_s{i}") for i, s in enumerate(STATS)])
    robust = _attach(centre, spread, [f"_s{i}" for i in range(len(STATS))])
    robust = robust.withColumns({f"c{i}{j}": (F.pow(1.4826 * F.col(f"_s{i}"), 2) + FLOOR[STATS[i]] ** 2) if i == j
                                 else F.lit(0.0) for i, j in PAIRS})
    starts = [_cholesky(x).select(*KEY, F.lit(k).alias("start"), *PARAMS) for k, x in enumerate((robust, _moments(rows)))]
    p = stored(starts[0].unionByName(starts[1]), "mcd-step")
    for _ in range(STEPS):
        after = _cholesky(_moments(_nearest(rows, p), consistency(), STARTED))
        p = stored(_attach(after, p.withColumnRenamed("logdet", "last"), ["last"], STARTED).select(
            *STARTED, *PARAMS, F.abs(F.col("logdet") - F.col("last")).alias("moved")), "mcd-step")
        if (p.agg(F.max("moved")).first()[0] or 0.0) < MOVE:
            break
    best = p.groupBy(*KEY).agg(F.min_by(F.struct(*PARAMS), F.struct("logdet", *PARAMS)).alias("p")).select(*KEY, "p.*")
    near = _distance(_attach(rows, stored(best, "mcd-best"), PARAMS)).filter(F.col("d2") <= quantile(CORE)).select(*KEY, *STATS)
    return stored(_cholesky(_moments(near, consistency(CORE))).select(*KEY, *PARAMS), "mcd-params")


def judge(stats: DataFrame, groups: DataFrame, params: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Add ``distance`` (squared; null where no document passes the base rules) and ``kept``."""
    p = groups.alias("g").join(params.alias("p"), _same("g", "p", KEY), "left").select(
        F.col("g.lang").alias("lang"), F.col("g.source").alias("source"), *[F.col(f"p.{c}") for c in PARAMS])
    p = stored(p, "mcd-judge")
    out = stats.alias("r").join(p.alias("p"), _same("r", "p", ["lang", "source"]), "left").select(
        "r.*", *[F.col(f"p.{c}").alias(c) for c in PARAMS])
    out = _distance(out, "distance").drop(*PARAMS)
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff))


def narrow_stats(docs: DataFrame) -> DataFrame:
    stats = with_stats(with_counts(docs.select("doc_id", "text", "lang", "source")))
    return stored(stats.drop("text"), "quality-stats")


def keep_quality(docs: DataFrame, scan: bool = False) -> DataFrame:
    """The documents that pass, with their own columns.

    Estimates and verdicts read a stored table of the statistics; rows that go are
    listed and left out of ``docs``. ``scan``: see ``numbered``."""
    rows, row = numbered(docs, "quality-docs", scan)
    stats = stored(with_stats(with_counts(rows.select(F.col(row).alias("row"), "text", "lang", "source"))).drop("text"), "quality-stats")
    groups = stored(grouped(stats), "mcd-pools")
    return without_rows(rows, row, judge(stats, groups, fit(stats, groups)).filter("not kept").select("row"))


def op3_quality_rules(spark, sf_dir) -> DataFrame:
    """Counts and verdict of every document."""
    stats = narrow_stats(table(spark, sf_dir, "documents"))
    groups = stored(grouped(stats), "mcd-pools")
    return judge(stats, groups, fit(stats, groups)).select("doc_id", *COUNTS, "base_failed", "kept", "distance")
