"""Quality rules with robust multivariate outliers, in DataFrame expressions only.

Word statistics of a text are array expressions in one scan (no explode, no shuffle). For each
language and source the minimum-covariance-determinant estimate of a transformed statistic
vector is found by concentration steps: the h rows nearest to the current centre give the
next centre and covariance, until the determinant no longer falls. Every step is one
aggregation of the narrow statistic table and a join with one row per group that has not settled.
Several starts run side by side; for each group the start with the least determinant counts. A row
whose Mahalanobis distance exceeds the cut is rejected. Groups with few rows are judged by the
estimate of all rows of their language, or of all rows.

Statistics are integers in thousandths, so sums are exact and the estimates do not depend on
partitioning; the h-subset is cut on a fine histogram of distances, never by sorting a group.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, WORD, shared_table

SPACE = r"[\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
LEAST_WORDS = 50
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Transformed vector, in thousandths, and the least spread a statistic is taken to have.
# x_dup reaches 1000 and x_rep 707: over 5.8 times the floor, so either can reject by itself.
VECTOR = {"x_len": 120, "x_sym": 45, "x_dup": 170, "x_rep": 115, "x_upper": 100}
STARTS = ("l1", "l2", "max")
BINS_PER_DOUBLING = 16
FEW_GROUPS = 20_000     # so many group rows are broadcast, a few MB
FALL = 1e-6             # a log determinant that falls by less has settled


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that come twice or more, each word counted once."""
    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def same(s: Column, i: Column, g: Column) -> Column:
        return F.coalesce(F.get(s, i)["h"] == g["h"], F.lit(False))

    def covered(s: Column) -> Column:
        found = F.filter(s, lambda g, i: same(s, i - 1, g) | same(s, i + 1, g))
        at = F.sort_array(F.transform(found, lambda g: g["at"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(at, start, lambda acc, p: F.struct(
            p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    def counted(hashes: Column) -> Column:  # most texts repeat no window: no sort for them
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            _let(F.sort_array(pairs), covered))

    return _let(windows, counted)


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base statistics; null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE + "+"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

    counted = _let(words, lambda w: F.struct(
        F.size(w).alias("n"), F.char_length(F.array_join(w, "")).alias("c"),
        _repeat_words(w).alias("r")))
    dup = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return (docs.withColumn("_c", counted).withColumns({
        "n_words": F.col("_c.n").cast("long"),
        "word_chars": F.col("_c.c").cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("long"),
        "n_dup_lines": dup.cast("long"),
        "n_repeat_words": F.col("_c.r").cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
    }).drop("_c"))


def base_failed() -> Column:
    return ((F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _vector() -> dict[str, Column]:
    def thousandths(x: Column) -> Column:
        return F.coalesce(F.round(x * 1000), F.lit(0)).cast("long")

    def share(a: str, b: str) -> Column:
        return F.sqrt(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")))

    return {
        "x_len": thousandths(F.log(F.try_divide(F.col("word_chars").cast("double"),
                                                F.col("n_words").cast("double")))),
        "x_sym": thousandths(share("n_symbols", "word_chars")),
        "x_dup": thousandths(share("n_dup_lines", "n_lines")),
        "x_rep": thousandths(share("n_repeat_words", "n_words")),
        "x_upper": thousandths(share("n_upper", "word_chars")),
    }


def _cholesky(cov: dict[tuple[int, int], Column], p: int, into: str, least: list[float] | None = None):
    """Columns of the lower triangle, made row by row: [(name, column), ...].

    ``least`` bounds the variance that each statistic has given those before it.
    """
    cell = "{}_{}_{}".format
    least = least or [1e-9] * p
    out = []
    for i in range(p):
        for j in range(i + 1):
            rest = cov[i, j] - sum((F.col(cell(into, i, k)) * F.col(cell(into, j, k))
                                    for k in range(j)), F.lit(0.0))
            out.append((cell(into, i, j), F.sqrt(F.greatest(rest, F.lit(least[i]))) if i == j
                        else rest / F.col(cell(into, j, j))))
    return out


def _estimate(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Mean and Cholesky factor of the covariance of each key, with the squared floors added."""
    p = len(names)
    n = F.count(F.lit(1))
    sums = {f"s_{i}": F.sum(x) for i, x in enumerate(names)}
    cross = {f"q_{i}_{j}": F.sum(F.col(names[i]) * F.col(names[j]))
             for i in range(p) for j in range(i + 1)}
    out = rows.groupBy(*keys).agg(n.alias("h"), *(c.alias(a) for a, c in (sums | cross).items()))
    mean = {f"m_{i}": F.col(f"s_{i}") / F.col("h") for i in range(p)}
    out = out.withColumns(mean)
    cov = {(i, j): F.col(f"q_{i}_{j}") / F.col("h") - F.col(f"m_{i}") * F.col(f"m_{j}")
           + (float(VECTOR[names[i]] ** 2) if i == j else 0.0)
           for i in range(p) for j in range(i + 1)}
    for name, col in _cholesky(cov, p, "l"):
        out = out.withColumn(name, col)
    log_det = reduce(lambda a, b: a + b, (2 * F.log(F.col(f"l_{i}_{i}")) for i in range(p)))
    return out.withColumn("log_det", log_det).select(
        *keys, "h", "log_det", *mean, *(f"l_{i}_{j}" for i in range(p) for j in range(i + 1)))


def _distance(names: list[str]) -> list[tuple[str, Column]]:
    """Columns y_0.. of the forward substitution, then d2."""
    out = []
    for i, x in enumerate(names):
        rest = F.col(x) - F.col(f"m_{i}") - sum(
            (F.col(f"l_{i}_{k}") * F.col(f"y_{k}") for k in range(i)), F.lit(0.0))
        out.append((f"y_{i}", rest / F.col(f"l_{i}_{i}")))
    d2 = reduce(lambda a, b: a + b, (F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(len(names))))
    return [*out, ("d2", d2)]


def _attach(rows: DataFrame, groups: DataFrame, keys: list[str], few: bool, how: str = "inner"):
    """Give rows the values of their group: broadcast if the number of groups was found small,
    so that a hot group stays spread over all tasks; else by an ordinary join."""
    return rows.join(F.broadcast(groups) if few else groups, keys, how)


def _nearest(rows: DataFrame, keys: list[str], share: float, few: bool) -> DataFrame:
    """Rows whose ``d2`` lies in the histogram bins that hold the nearest ``share`` of a key."""
    rows = rows.withColumn("bin", F.floor(
        F.log2(F.col("d2") + 1e-3) * BINS_PER_DOUBLING).cast("int"))
    bins = rows.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct("bin", "n")))  # at most a few hundred bins
    least = F.ceil(F.sum("n") * share)
    cut = bins.groupBy(*keys).agg(ordered.alias("bins"), least.alias("least")).select(
        *keys, F.aggregate("bins", F.struct(F.lit(0).cast("long").alias("n"),
                                            F.lit(-10**6).alias("cut")),
                           lambda acc, b: F.when(acc["n"] >= F.col("least"), acc).otherwise(
                               F.struct((acc["n"] + b["n"]).alias("n"), b["bin"].alias("cut"))),
                           lambda acc: acc["cut"]).alias("cut"))
    return _attach(rows, cut, keys, few).filter("bin <= cut")


def mcd(rows: DataFrame, keys: list[str], names: list[str], share: float = 0.75) -> DataFrame:
    """One row per group of ``keys``: size, centre and Cholesky factor of its MCD estimate.

    ``keys`` must not be null. Starts are the rows nearest to the coordinate-wise median,
    scaled by the median absolute deviation, in three norms. A start takes steps until its
    determinant no longer falls.
    """
    p = len(names)
    centre = shared_table(rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("size"),
        *(F.percentile(x, 0.5).alias(f"c_{i}") for i, x in enumerate(names))), "mcd-centre")
    few = centre.count() <= FEW_GROUPS
    spread = (_attach(rows, centre, keys, few).groupBy(*keys).agg(
        F.first("size").alias("size"), *(F.first(f"c_{i}").alias(f"c_{i}") for i in range(p)),
        *(F.greatest(1.4826 * F.percentile(F.round(F.abs(F.col(x) - F.col(f"c_{i}"))), 0.5),
                     F.lit(float(VECTOR[x]))).alias(f"w_{i}") for i, x in enumerate(names))))
    spread = shared_table(spread, "mcd-scale")
    z = [F.abs(F.col(x) - F.col(f"c_{i}")) / F.col(f"w_{i}") for i, x in enumerate(names)]
    norms = {"l1": reduce(lambda a, b: a + b, z), "l2": reduce(lambda a, b: a + b, [x * x for x in z]),
             "max": F.greatest(*z)}
    started = (_attach(rows, spread, keys, few)
               .withColumn("s", F.explode(F.array(*(F.struct(
                   F.lit(k).alias("start"), norms[k].alias("d2")) for k in STARTS))))
               .select(*keys, *names, "s.start", "s.d2"))
    by = [*keys, "start"]
    now = shared_table(_estimate(_nearest(started, by, share, few), by, names), "mcd-0")
    settled, step = [], 0
    while not now.isEmpty():
        step += 1
        far = _attach(rows, now, keys, few)
        for name, col in _distance(names):
            far = far.withColumn(name, col)
        far = far.select(*by, *names, "d2")
        before = now.select(*by, F.col("log_det").alias("before"))
        after = shared_table(_estimate(_nearest(far, by, share, few), by, names).join(before, by)
                             .withColumn("falls", F.col("before") - F.col("log_det") > FALL),
                             f"mcd-{step}")
        settled.append(now.join(after.filter("not falls").select(*by), by, "left_semi"))
        now = after.filter("falls").drop("before", "falls")
    ended = reduce(DataFrame.unionByName, settled) if settled else now
    ended = shared_table(ended, "mcd-ends")
    best = ended.groupBy(*keys).agg(F.min_by(F.struct(*ended.columns), F.struct("log_det", "start"))
                                    .alias("b")).select("b.*")
    return best.join(spread.select(*keys, "size"), keys)


def judging_groups(rows: DataFrame, keys: list[str], least: int) -> tuple[DataFrame, list[str]]:
    """Each group of ``keys`` with the group it is judged by, in the columns returned.

    That is the group itself if it has ``least`` rows, else the first coarser one that has (the last
    keys become ``*``), at last all rows.
    """
    sizes = shared_table(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n0")), "group-sizes")
    out, levels = sizes, len(keys)
    for k in range(1, levels):
        part = keys[:levels - k]
        out = out.join(sizes.groupBy(*part).agg(F.sum("n0").alias(f"n{k}")), part)
    judges = [f"j_{i}" for i in range(levels)]
    level = F.lit(levels)
    for k in range(levels - 1, -1, -1):
        level = F.when(F.col(f"n{k}") >= least, F.lit(k)).otherwise(level)
    out = out.withColumn("level", level).withColumns({
        j: F.when(F.lit(i) < levels - F.col("level"), F.col(k)).otherwise(F.lit("*"))
        for i, (j, k) in enumerate(zip(judges, keys))})
    return shared_table(out.select(*keys, *judges), "judging-groups"), judges


def _members(rows: DataFrame, groups: DataFrame, keys: list[str], judges: list[str],
             names: list[str], few: bool) -> DataFrame:
    """Rows of the judging groups; a row belongs to its own and to coarser ones that judge some group."""
    coarse = groups.filter(F.col(judges[-1]) == "*")
    if coarse.isEmpty():
        return rows.select(*(F.col(k).alias(j) for k, j in zip(keys, judges)), *names)
    own = [F.struct(*(F.col(k).alias(j) if i < upto else F.lit("*").alias(j)
                      for i, (k, j) in enumerate(zip(keys, judges))))
           for upto in range(len(keys), -1, -1)]
    each = rows.select(F.explode(F.array(*own)).alias("j"), *names).select("j.*", *names)
    wanted = groups.select(*judges).distinct()
    return each.join(F.broadcast(wanted) if few else wanted, judges, "left_semi")


def _chi2_below(x: float, p: int) -> float:
    """Chance that a chi-square of ``p`` degrees of freedom is at most ``x``."""
    a, term, total, k = p / 2, 1.0, 1.0, 0
    while term > 1e-17 * total:
        k += 1
        term *= x / 2 / (a + k)
        total += term
    return total * math.exp(a * math.log(x / 2) - x / 2 - math.lgamma(a + 1))


def consistency_factor(share: float, p: int) -> float:
    """What makes the covariance of the nearest ``share`` of normal rows that of all rows."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_below(mid, p) < share else (low, mid)
    return share / _chi2_below(high, p + 2)


def _judging(found: DataFrame, names: list[str], share: float) -> DataFrame:
    """``found`` with the Cholesky factor that rows are judged by.

    The estimates of mcd() carry the squared floors as a ridge, which only keeps the steps stable.
    Here the ridge is taken off and the consistency factor of the subset applied; then the variance
    of each statistic (given those before it) is the greater of its own and the squared floor.
    """
    p = len(names)
    floors = [float(VECTOR[x] ** 2) for x in names]
    factor = consistency_factor(share, p)
    cov = {(i, j): factor * (sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j + 1)), F.lit(0.0))
                             - (floors[i] if i == j else 0.0)) for i in range(p) for j in range(i + 1)}
    out = found.withColumns({f"v_{i}_{j}": c for (i, j), c in cov.items()})
    for name, col in _cholesky({k: F.col("v_{}_{}".format(*k)) for k in cov}, p, "l_new", floors):
        out = out.withColumn(name, col)
    kept = [c for c in found.columns if not c.startswith("l_")]
    return out.select(*kept, *(F.col(f"l_new_{i}_{j}").alias(f"l_{i}_{j}")
                               for i in range(p) for j in range(i + 1)))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  group_cols: tuple[str, ...] = ("lang", "source"), share: float = 0.75,
                  cut: float = 30.86, least_group: int = 50) -> DataFrame:
    """One row per document: id, the base statistics, base_failed, distance2, kept.

    A document is rejected when a base rule fails or when its squared Mahalanobis distance from
    the MCD estimate of its language and source is over ``cut`` (by default the 0.99999 quantile of
    chi-square with five degrees of freedom). Variances are those of the subset times its
    consistency factor, or the squared floors of VECTOR where greater. The estimates use all rows
    that pass the base rules. Null language or source is a group of its own. Groups with fewer
    than ``least_group`` such rows are judged by the estimate of all rows of their language, or, if
    that has too few as well, of all rows. Null or empty text has no words and fails the base rules.
    Repeated rows each count. Other columns are ignored. An empty table gives no rows.
    """
    keys = [f"g_{i}" for i in range(len(group_cols))]
    names = list(VECTOR)
    given = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                        *(F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("null"))
                          .alias(k) for g, k in zip(group_cols, keys)))
    stats = text_statistics(given, "_text").drop("_text")
    stats = stats.withColumn("base_failed", base_failed()).withColumns(_vector())
    stats = shared_table(stats.select("_id", *keys, *BASE, "base_failed", *names), "statistics")
    passed = stats.filter("not base_failed").select(*keys, *names)
    groups, judges = judging_groups(passed, keys, least_group)
    few = groups.count() <= FEW_GROUPS
    found = mcd(_members(passed, groups, keys, judges, names, few), judges, names, share)
    found = groups.join(_judging(found, names, share), judges).drop(*judges)
    far = _attach(stats, shared_table(found, "mcd"), keys, few, "left")
    for name, col in _distance(names):
        far = far.withColumn(name, col)
    return far.select(
        F.col("_id").alias(id_col), *BASE, "base_failed", F.round("d2", 6).alias("distance2"),
        (~F.col("base_failed") & ~F.coalesce(F.col("d2") > cut, F.lit(False))).alias("kept"))
