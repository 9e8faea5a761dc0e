"""Feature preparation and data splits for Spark ML.

Splits are hash-based on a row key, so a row lands in the same split on
every recomputation (a lost executor replays the same assignment), and no
split needs a global sort or a per-label window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (PCA, OneHotEncoder, StandardScaler, StringIndexer,
                                UnivariateFeatureSelector, VectorAssembler)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import prefix_sums


# ---------------------------------------------------------------- M1
def zscore(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
           center: bool = True, population: bool = True, suffix: str = "") -> DataFrame:
    """(x − mean) / std with statistics from ``fit_on`` (train) or ``df``.

    Population std matches scikit-learn's StandardScaler. Fitting is one
    aggregation whose single summary row (mean and std per column) becomes
    literals of the transform.
    """
    src = fit_on if fit_on is not None else df
    # fit: one aggregation, a 2·d-number summary (as Spark ML scalers do)
    stats = src.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                    *[(F.stddev_pop(c) if population else F.stddev_samp(c)).alias(f"s_{c}")
                      for c in cols]).first()
    out = {}
    for c in cols:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        num = (F.col(c) - F.lit(m)) if center else F.col(c)
        out[f"{c}{suffix}"] = (F.lit(0.0) if not s else num / F.lit(s))
    return df.withColumns(out)


def scaler_stage(input_col: str = "raw_features", output_col: str = "features",
                 with_mean: bool = True) -> StandardScaler:
    """Spark ML StandardScaler (sample std) for vector pipelines."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=with_mean,
                          withStd=True)


# ---------------------------------------------------------------- M2–M6
def one_hot_stages(cols: Sequence[str], drop_first: bool = True,
                   keep_unknown: bool = False) -> list:
    """StringIndexer + OneHotEncoder per column.

    ``drop_first`` drops the alphabetically first level (as pandas
    ``get_dummies(drop_first=True)``): index levels in descending order and
    let the encoder drop the last index. ``keep_unknown`` adds a slot for
    unseen levels instead (``handleInvalid='keep'``).
    """
    stages = []
    for c in cols:
        stages.append(StringIndexer(
            inputCol=c, outputCol=f"{c}_idx",
            stringOrderType="alphabetDesc" if drop_first else "alphabetAsc",
            handleInvalid="keep" if keep_unknown else "error"))
        # the indexer's index for unseen levels is an ordinary one to the encoder
        stages.append(OneHotEncoder(inputCols=[f"{c}_idx"], outputCols=[f"{c}_ohe"],
                                    dropLast=drop_first, handleInvalid="error"))
    return stages


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str] = (),
                     scale: bool = True, drop_first: bool = True,
                     keep_unknown: bool = False) -> Pipeline:
    """Column-wise preprocessing: encode, assemble, scale (fit on train only)."""
    stages = one_hot_stages(categorical, drop_first=drop_first, keep_unknown=keep_unknown)
    inputs = list(numeric) + [f"{c}_ohe" for c in categorical]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="raw_features",
                                  handleInvalid="keep"))
    if scale:
        stages.append(scaler_stage())
    else:
        stages.append(VectorAssembler(inputCols=["raw_features"], outputCol="features"))
    return Pipeline(stages=stages)


def string_index(col: str, out: str | None = None) -> StringIndexer:
    return StringIndexer(inputCol=col, outputCol=out or f"{col}_idx")


# ---------------------------------------------------------------- M7
def pca_stage(k: int, input_col: str = "features", output_col: str = "pca") -> PCA:
    return PCA(k=k, inputCol=input_col, outputCol=output_col)


def pca_for_variance(df: DataFrame, input_col: str, n_features: int, target: float = 0.95,
                     output_col: str = "pca"):
    """Smallest k whose explained variance reaches ``target``; returns (model, k).

    Fits the full PCA once (a d×d covariance, d = number of features) and
    reads the cumulative explained variance.
    """
    full = PCA(k=n_features, inputCol=input_col, outputCol=output_col).fit(df)
    cum, k = 0.0, n_features
    for i, v in enumerate(full.explainedVariance.toArray(), start=1):
        cum += float(v)
        if cum >= target:
            k = i
            break
    return PCA(k=k, inputCol=input_col, outputCol=output_col).fit(df), k


# ---------------------------------------------------------------- M8
def select_k_best(k: int, features: str = "features", label: str = "label",
                  output: str = "selected", label_type: str = "continuous") -> UnivariateFeatureSelector:
    """Top-k features by F-test (continuous features)."""
    sel = UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol=output,
                                    selectionMode="numTopFeatures")
    sel.setFeatureType("continuous").setLabelType(label_type).setSelectionThreshold(k)
    return sel


def frequency_bins(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Least value of each equal-frequency bin of each column, exactly.

    A value's bin is its rank among the rows (the number of smaller ones) · bins / rows, rounded down,
    so equal values share a bin. The ranks are prefix counts over distinct values; at most
    ``bins`` numbers a column reach the driver.
    """
    from ..operators.windows import segmented_prefix_sums
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {stack}) AS (column, v)").where("v IS NOT NULL")
    counts = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    ranked = segmented_prefix_sums(counts, ["column"], ["v"], ["n"], prefix="below")
    total = counts.groupBy("column").agg(F.sum("n").alias("rows"))
    bin_ = F.expr(f"below_n * {int(bins)} div rows")
    cuts = ranked.join(F.broadcast(total), "column").groupBy("column", bin_.alias("bin")).agg(
        F.min("v").alias("least"))
    out: dict[str, list[float]] = {c: [] for c in columns}
    for r in cuts.orderBy("column", "bin").collect():
        out[r["column"]].append(float(r["least"]))
    return out


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10,
                       label_bins: int | None = 10) -> DataFrame:
    """Mutual information (nats) between each feature and the label.

    Features (and a continuous label) are cut into exact equal-frequency bins; joint and marginal
    counts are one grouped aggregation over (feature, bin, label bin); MI = Σ p·ln(p / (p_x·p_y)).
    Rows without a label take no part; a missing feature is a bin of its own.
    """
    rows = df.where(F.col(label).isNotNull())
    cuts = frequency_bins(rows, [*features, *([label] if label_bins == bins else [])], bins)
    if label_bins and label_bins != bins:
        cuts |= frequency_bins(rows, [label], label_bins)

    def binned(c: str) -> Column:
        arr = F.array(*[F.lit(b) for b in cuts[c]]) if cuts[c] else F.array().cast("array<double>")
        return F.coalesce(F.size(F.filter(arr, lambda b: b <= F.col(c).cast("double"))), F.lit(0))

    ylab = binned(label) if label_bins else F.col(label)
    stack = ", ".join(f"'{c}', CAST(`_b_{c}` AS INT)" for c in features)
    d = (rows.select(ylab.alias("_y"), *[binned(c).alias(f"_b_{c}") for c in features])
             .selectExpr("_y", f"stack({len(features)}, {stack}) AS (feature, bin)"))
    joint = d.groupBy("feature", "bin", "_y").agg(F.count(F.lit(1)).alias("n_xy"))
    px = joint.groupBy("feature", "bin").agg(F.sum("n_xy").alias("n_x"))
    py = joint.groupBy("feature", "_y").agg(F.sum("n_xy").alias("n_y"))
    n = joint.groupBy("feature").agg(F.sum("n_xy").alias("n"))
    j = (joint.join(px, ["feature", "bin"]).join(py, ["feature", "_y"]).join(n, "feature"))
    term = (F.col("n_xy") / F.col("n")) * F.log(F.col("n_xy") * F.col("n")
                                               / (F.col("n_x") * F.col("n_y")))
    return j.groupBy("feature").agg(F.sum(term).alias("mutual_information"))


# ---------------------------------------------------------------- M9–M12
def key_number(key: Sequence[str], seed: int) -> Column:
    """32 bits of the MD5 of the key columns and the seed: the same number in any SQL engine."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def key_number_sql(key: Sequence[str], seed: int) -> str:
    """SQL text of ``key_number``."""
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(key)}, '{seed}')), 1, 8) AS BIGINT)"


def _unit_hash(key: Sequence[str], seed: int) -> Column:
    return key_number(key, seed) / F.lit(2.0 ** 32)


def random_split(df: DataFrame, key: Sequence[str], test_fraction: float = 0.2,
                 seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Stable train / test split by key hash."""
    u = _unit_hash(key, seed)
    return df.where(u >= test_fraction), df.where(u < test_fraction)


def stratified_split(df: DataFrame, key: Sequence[str], label: str, test_fraction: float = 0.2,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Per-label split (M11): each class is cut at the same hash threshold.

    The hash is salted with the label so classes are sampled independently;
    each class keeps ≈ the requested share without a per-class window.
    """
    u = _unit_hash([*key, label], seed)
    return df.where(u >= test_fraction), df.where(u < test_fraction)


def time_split(df: DataFrame, date: str, train_fraction: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Time-ordered split at a date boundary (M9).

    Row counts per distinct date (bounded by the calendar) get a distributed
    running count; train holds the dates whose rows all lie within the first
    ``train_fraction`` of rows. On a day-grain series this is exactly the
    first 80% of rows (test = ceil(0.2·n)).
    """
    per_day = df.groupBy(F.col(date).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    per_day = per_day.withColumn("_dn", F.datediff(F.col("_d"), F.lit("1970-01-01")).cast("double"))
    cum = prefix_sums(per_day, "_dn", ["_n"], prefix="_c")
    total = df.select(F.count(F.lit(1))).scalar()
    limit = F.floor(total * train_fraction)
    cutoff = cum.where((F.col("_c__n") + F.col("_n")) <= limit).select(F.max("_d")).scalar()
    train = df.where(F.col(date) <= cutoff)
    test = df.where((F.col(date) > cutoff) | cutoff.isNull())
    return train, test


def fold_column(key: Sequence[str], k: int = 5, seed: int = 42) -> Column:
    """Shuffled k-fold assignment by key hash (M12), for ``CrossValidator.foldCol``."""
    return F.pmod(key_number(key, seed), F.lit(k)).cast("int")


# ---------------------------------------------------------------- M14
def balanced_class_weights(df: DataFrame, label: str, out: str = "class_weight") -> DataFrame:
    """weight = n / (n_classes · n_class), joined back by label (≤ a few rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    n = counts.select(F.sum("_nc")).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    w = counts.select(label, (n / (k * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(w), label, "left")
