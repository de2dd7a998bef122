"""Recipe steps on columns and levels."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.feature import CountVectorizerModel, PCA, StopWordsRemover, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabkit.features.dictionary import DictionaryStep, SparseBlocks, learn_levels, learn_tokens
from tabkit.features.levels import collect_levels
from tabkit.features.recipe import LearnedColumns, RowChange, Selector, Step, lit, q, resolve, unique_names
from tabkit.modelling import resample
from tabkit.operators.aggregates import correlations
from tabkit.operators.frames import typed
from tabkit.scale import exact_quantiles
from tabkit.session import stage


def _missing(df: DataFrame, c: str) -> str:
    floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
    return f"({q(c)} IS NULL OR isnan({q(c)}))" if floating else f"{q(c)} IS NULL"


def _present(df: DataFrame, c: str):
    return F.expr(f"CASE WHEN NOT ({_missing(df, c)}) THEN double({q(c)}) END")


def _melt(df: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    return df.select(*[F.col(c).cast(cast).alias(c) for c in cols]).unpivot([], list(cols), "column", "v").where("v IS NOT NULL")


# ---- columns in and out -----------------------------------------------------


class StepRm(Step):
    """Remove columns."""

    def learn(self, df, cols):
        return [], cols


class StepMutate(Step):
    """Computed columns from SQL text, each seeing the ones before it."""

    def __init__(self, **exprs: str):
        super().__init__()
        self.exprs = exprs

    def learn(self, df, cols):
        return list(self.exprs.items()), []


class StepMutateAt(Step):
    """One expression over many columns, written with x for the column."""

    def __init__(self, select, expr: str):
        super().__init__(select)
        self.expr = expr

    def learn(self, df, cols):
        return [(c, self.expr.format(x=q(c))) for c in cols], []


class StepInteract(Step):
    """Products a_x_b of listed pairs."""

    def __init__(self, *pairs: tuple[str, str]):
        super().__init__()
        self.pairs = pairs

    def learn(self, df, cols):
        return [(f"{a}_x_{b}", f"{q(a)} * {q(b)}") for a, b in self.pairs], []


class StepDate(Step):
    """Calendar features of date columns."""

    # Feature name to SQL.
    SQL = {"month": "date_format({x}, 'MMM')", "year": "year({x})", "day": "day({x})", "doy": "dayofyear({x})", "dow": "date_format({x}, 'E')", "quarter": "quarter({x})"}

    def __init__(self, select, features: Sequence[str] = ("month", "year"), keep: bool = True):
        super().__init__(select)
        self.features, self.keep = features, keep

    def learn(self, df, cols):
        return [(f"{c}_{f}", self.SQL[f].format(x=q(c))) for c in cols for f in self.features], [] if self.keep else cols


# ---- filling ----------------------------------------------------------------


def _fill(df, values: dict[str, object]):
    """A whole-number column filled with a fraction becomes double, as it must."""
    return [(c, f"CASE WHEN {_missing(df, c)} THEN {lit(v)} ELSE {q(c)} END") for c, v in values.items() if v is not None]


class StepImputeMean(Step):
    def learn(self, df, cols):
        m = df.agg(*[F.avg(_present(df, c)).alias(c) for c in cols]).first()
        return _fill(df, {c: m[c] for c in cols}), []


class StepImputeMedian(Step):
    """Exact medians, all columns through one distributed count."""

    def learn(self, df, cols):
        rows = exact_quantiles(_melt(df, cols, "double"), "column", "v", {"m": 0.5}).collect()
        return _fill(df, {r["column"]: r["m"] for r in rows}), []


class StepImputeMode(Step):
    """The commonest value, the smallest among equals."""

    def learn(self, df, cols):
        n = _melt(df, cols, "string").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
        top = n.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("k"), "v")).alias("m")).select("column", "m.v")
        return _fill(df, {r["column"]: r["v"] for r in top.collect()}), []


class StepImputeLinear(Step):
    """Fill with a linear model on given predictors, fitted on complete rows."""

    def __init__(self, select, impute_with: Sequence[str]):
        super().__init__(select)
        self.impute_with = list(impute_with)

    def learn(self, df, cols):
        out = []
        if len(self.impute_with) == 1:
            x = self.impute_with[0]
            fits = df.agg(*[F.struct(F.regr_slope(c, x), F.regr_intercept(c, x)).alias(c) for c in cols]).first()
            coefs = {c: ([fits[c][0]], fits[c][1]) for c in cols}
        else:
            coefs = {}
            for c in cols:
                d = df.select(F.col(c).cast("double").alias("_y"), *self.impute_with).dropna()
                d = VectorAssembler(inputCols=self.impute_with, outputCol="_f").transform(d)
                m = LinearRegression(featuresCol="_f", labelCol="_y", solver="normal").fit(d)
                coefs[c] = (m.coefficients.tolist(), m.intercept)
        for c, (b, a) in coefs.items():
            fit = " + ".join([lit(float(a)), *[f"{lit(float(w))} * {q(x)}" for w, x in zip(b, self.impute_with)]])
            out.append((c, f"CASE WHEN {_missing(df, c)} THEN {fit} ELSE double({q(c)}) END"))
        return out, []


# ---- scaling and transforms -------------------------------------------------


class StepNormalize(Step):
    """(x - mean) / sd; a constant column is only centred."""

    center, scale = True, True

    def learn(self, df, cols):
        aggs = [F.struct(F.avg(_present(df, c)), F.stddev_samp(_present(df, c))).alias(c) for c in cols]
        st = df.agg(*aggs).first()
        out = []
        for c in cols:
            m, s = st[c]
            m = float(m or 0.0) if self.center else 0.0
            s = float(s) if self.scale and s else 1.0
            out.append((c, f"(double({q(c)}) - {lit(m)}) / {lit(s)}"))
        return out, []


class StepCenter(StepNormalize):
    scale = False


class StepScale(StepNormalize):
    center = False


def yeo_johnson(x: str, lam: float) -> str:
    """SQL of the transform at a fixed lambda."""
    v = f"double({x})"
    up = f"ln(1 + {v})" if abs(lam) < 1e-9 else f"(power(1 + {v}, {lit(lam)}) - 1) / {lit(lam)}"
    r = 2 - lam
    down = f"-ln(1 - {v})" if abs(r) < 1e-9 else f"-(power(1 - {v}, {lit(r)}) - 1) / {lit(r)}"
    return f"CASE WHEN {v} >= 0 THEN {up} ELSE {down} END"


class StepYeoJohnson(Step):
    """Power transform with lambda in (-5, 5) by maximum likelihood.

    Each pass scores a whole grid of lambdas for every column in one aggregate;
    three passes narrow it. Columns with fewer than 5 distinct values stay.
    """

    def __init__(self, select, limits: tuple[float, float] = (-5.0, 5.0), points: int = 15, passes: int = 3):
        super().__init__(select)
        self.limits, self.points, self.passes = limits, points, passes

    def learn(self, df, cols):
        # distinct values with counts: repeated values are transformed once
        counts = _melt(df.select(*[_present(df, c).alias(c) for c in cols]), cols, "double").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
        counts = stage(counts)
        few = counts.groupBy("column").agg(F.count(F.lit(1)).alias("k")).where("k >= 5").collect()
        lo, hi = self.limits
        span = {r["column"]: (lo, hi) for r in few}
        v, lam, n = F.col("v"), F.col("lam"), F.col("n")
        up = F.when(F.abs(lam) < 1e-9, F.log1p(v)).otherwise((F.pow(1 + v, lam) - 1) / lam)
        down = F.when(F.abs(2 - lam) < 1e-9, -F.log1p(-v)).otherwise(-(F.pow(1 - v, 2 - lam) - 1) / (2 - lam))
        t = F.when(v >= 0, up).otherwise(down)
        spread = F.sum(n * t * t) / F.sum(n) - F.pow(F.sum(n * t) / F.sum(n), F.lit(2))
        fit = -0.5 * F.sum(n) * F.log(spread) + (F.first(lam) - 1) * F.sum(n * F.signum(v) * F.log1p(F.abs(v)))
        best = {}
        for _ in range(self.passes if span else 0):
            grid = {c: np.linspace(a, b, self.points) for c, (a, b) in span.items()}
            choices = F.create_map(*[x for c, ls in grid.items() for x in (F.lit(c), F.array(*[F.lit(float(g)) for g in ls]))])
            d = counts.withColumn("lam", F.explode(choices[F.col("column")]))
            rows = d.groupBy("column", "lam").agg(fit.alias("fit")).collect()
            for c, ls in grid.items():
                at = {r["lam"]: r["fit"] for r in rows if r["column"] == c and r["fit"] is not None and np.isfinite(r["fit"])}
                i = max(range(len(ls)), key=lambda i: at.get(float(ls[i]), -np.inf))
                best[c] = float(ls[i])
                span[c] = (float(ls[max(i - 1, 0)]), float(ls[min(i + 1, self.points - 1)]))
        return [(c, yeo_johnson(q(c), best[c])) for c in cols if c in best], []


# ---- dropping columns -------------------------------------------------------


def level_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: rows, distinct values and the two largest value counts."""
    n = _melt(df, cols, "string").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), "v")
    top2 = n.withColumn("r", F.row_number().over(w)).where("r <= 2")
    top = top2.groupBy("column").agg(F.max(F.when(F.col("r") == 1, F.col("n"))).alias("first"), F.max(F.when(F.col("r") == 2, F.col("n"))).alias("second"))
    tot = n.groupBy("column").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("uniq"))
    return tot.join(top, "column")


def nzv_table(df: DataFrame, cols: Sequence[str], freq_cut: float = 95 / 5, unique_cut: float = 10.0) -> DataFrame:
    """The decision behind the zero and near-zero variance steps."""
    t = level_counts(df, cols)
    ratio = F.when(F.col("second").isNull(), 0.0).otherwise(F.try_divide("first", "second"))
    pct = 100.0 * F.col("uniq") / F.col("rows")
    t = t.withColumns({"freq_ratio": ratio, "pct_unique": pct, "zero_var": F.col("uniq") <= 1})
    return t.withColumn("drop", F.col("zero_var") | ((F.col("freq_ratio") > freq_cut) & (F.col("pct_unique") <= unique_cut)))


class StepZv(Step):
    """Drop columns with at most one value."""

    def learn(self, df, cols):
        keep = {r["column"] for r in nzv_table(df, cols).where("NOT zero_var").collect()}
        return [], [c for c in cols if c not in keep]


class StepNzv(Step):
    """Drop columns that are almost constant."""

    def __init__(self, select, freq_cut: float = 95 / 5, unique_cut: float = 10.0):
        super().__init__(select)
        self.cuts = freq_cut, unique_cut

    def learn(self, df, cols):
        keep = {r["column"] for r in nzv_table(df, cols, *self.cuts).where("NOT drop").collect()}
        return [], [c for c in cols if c not in keep]


def pick_correlated(cols: Sequence[str], r: np.ndarray, threshold: float) -> list[str]:
    """Columns to drop so that no pair stays above the threshold.

    Worst pair first; of the pair the one more correlated with the rest goes.
    """
    r = np.abs(np.nan_to_num(r))
    np.fill_diagonal(r, 0.0)
    live = list(range(len(cols)))
    gone = []
    while len(live) > 1:
        sub = r[np.ix_(live, live)]
        i, j = np.unravel_index(int(np.argmax(sub)), sub.shape)
        if sub[i, j] <= threshold:
            break
        mean = sub.sum(axis=1) / (len(live) - 1)
        k = i if mean[i] > mean[j] else j
        gone.append(cols[live[k]])
        del live[k]
    return gone


class StepCorr(Step):
    def __init__(self, select, threshold: float = 0.9):
        super().__init__(select)
        self.threshold = threshold

    def learn(self, df, cols):
        idx = {c: i for i, c in enumerate(cols)}
        m = np.zeros((len(cols), len(cols)))
        for r in correlations(df, cols).collect():
            i, j = idx[r["col1"]], idx[r["col2"]]
            m[i, j] = m[j, i] = np.nan if r["value"] is None else r["value"]
        return [], pick_correlated(cols, m, self.threshold)


def gram(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per group: n, column sums and cross products (upper triangle), in one pass."""
    x = [F.col(c).cast("double") for c in cols]
    k = range(len(cols))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(x[i]) for i in k]).alias("s"),
        F.array(*[F.sum(x[i] * x[j]) for i in k for j in k if j >= i]).alias("xx"),
    )


def gram_matrix(values: Sequence[float], k: int) -> np.ndarray:
    m = np.zeros((k, k))
    m[np.triu_indices(k)] = values
    return m + np.triu(m, 1).T


class StepLincomb(Step):
    """Drop columns that are linear combinations of columns before them."""

    def learn(self, df, cols):
        means = df.agg(*[F.avg(_present(df, c)).alias(c) for c in cols]).first()
        # moments about the mean and 1/n keep the sums well scaled
        centred = df.select(*[(F.col(c) - float(means[c] or 0.0)).alias(c) for c in cols]).dropna()
        g = gram(centred, cols).first()
        m = gram_matrix(g["xx"], len(cols)) / max(g["n"], 1)
        sd = np.sqrt(np.maximum(np.diag(m), 1e-300))
        m = m / np.outer(sd, sd)
        kept, gone = [], []
        for i, c in enumerate(cols):
            b = m[np.ix_(kept, [i])]
            rest = m[i, i] - (b.T @ np.linalg.solve(m[np.ix_(kept, kept)], b)).item() if kept else m[i, i]
            (kept.append(i) if rest > 1e-7 else gone.append(c))
        return [], gone


# ---- levels -----------------------------------------------------------------


class StepOther(Step):
    """Pool levels with a share under the threshold; missing stays missing.

    At most 1/threshold levels can be kept, so the kept list is short.
    """

    def __init__(self, select, threshold: float = 0.05, other: str = "other"):
        super().__init__(select)
        self.threshold, self.other = threshold, other

    def learn(self, df, cols):
        n = _melt(df, cols, "string").groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
        tot = n.groupBy("column").agg(F.sum("n").alias("t"))
        keep = n.join(F.broadcast(tot), "column").where(F.col("n") >= F.col("t") * self.threshold).select("column", "v").collect()
        out = []
        for c in cols:
            vals = sorted(r["v"] for r in keep if r["column"] == c)
            test = f"{q(c)} IN ({', '.join(map(lit, vals))})" if vals else "false"
            out.append((c, f"CASE WHEN {q(c)} IS NULL THEN NULL WHEN {test} THEN {q(c)} ELSE {lit(self.other)} END"))
        return out, []


class StepNovel(DictionaryStep):
    """Levels not seen in training become one new level."""

    form = "novel"

    def __init__(self, select, new: str = "new"):
        super().__init__(select)
        self.new = new

    def options(self):
        return {"form": self.form, "new": self.new}


class StepUnknown(Step):
    """Missing becomes a level."""

    def __init__(self, select, unknown: str = "unknown"):
        super().__init__(select)
        self.unknown = unknown

    def learn(self, df, cols):
        return [(c, f"coalesce({q(c)}, {lit(self.unknown)})") for c in cols], []


class StepDummy(Step):
    """0/1 columns per level but the first; missing gives NULL, an unseen level all zeros.

    A column is named after its level; levels whose names would be equal, signs
    aside, get _2, _3, ... With ``sparse`` the levels stay in a stored
    dictionary and one vector column <c>_block holds them all, however many
    there are; then missing is all zeros too.
    """

    def __init__(self, select, keep_first: bool = False, sparse: bool = False):
        super().__init__(select)
        self.keep_first, self.sparse = keep_first, sparse

    def _fit(self, df):
        if not self.sparse:
            return super()._fit(df)
        return SparseBlocks(learn_levels(df, resolve(self.select, df, self.roles)), {"form": "level", "keep_first": self.keep_first})

    def learn(self, df, cols):
        out = []
        for c in cols:
            lv = collect_levels(df, c)  # they become column names
            for v, name in unique_names(lv).items():
                if self.keep_first or v != lv[0]:
                    out.append((f"{c}_{name}", f"double(string({q(c)}) = {lit(v)})"))
        return out, cols


class StepBinary(DictionaryStep):
    """Level numbers written as binary digit columns c_0, c_1, ...; unseen or missing gives zeros."""

    form = "digits"


class StepString2Factor(DictionaryStep):
    """Level index from 0 in alphabetical order; unseen or missing gives the next index."""

    form = "index"


class StepRankEncode(DictionaryStep):
    """Each level becomes its rank by count, 1 the commonest; unseen gives NULL."""

    form, order = "rank", "count"


# ---- splines ----------------------------------------------------------------


def natural_spline_sql(x: str, knots: Sequence[float]) -> list[str]:
    """Natural cubic basis on given knots (ends included): len(knots) - 1 columns."""
    v, last = f"double({x})", knots[-1]

    def d(k):
        cube = lambda t: f"power(greatest({v} - {lit(float(t))}, double('0.0')), 3)"
        return f"(({cube(k)} - {cube(last)}) / {lit(float(last - k))})"

    ref = d(knots[-2])
    return [v] + [f"{d(k)} - {ref}" for k in knots[:-2]]


def b_spline_sql(x: str, inner: Sequence[float], lo: float, hi: float, degree: int = 3) -> list[str]:
    """B-spline basis without its first column, zero outside [lo, hi]."""
    t = [lo] * (degree + 1) + list(inner) + [hi] * (degree + 1)
    v = f"double({x})"

    def basis(i, k):
        if k == 0:
            if t[i] == t[i + 1]:
                return None
            right = "<=" if t[i + 1] == hi else "<"
            return f"CASE WHEN {v} >= {lit(float(t[i]))} AND {v} {right} {lit(float(t[i + 1]))} THEN double('1.0') ELSE double('0.0') END"
        parts = []
        a, b = basis(i, k - 1), basis(i + 1, k - 1)
        if a is not None and t[i + k] > t[i]:
            parts.append(f"(({v} - {lit(float(t[i]))}) / {lit(float(t[i + k] - t[i]))}) * ({a})")
        if b is not None and t[i + k + 1] > t[i + 1]:
            parts.append(f"(({lit(float(t[i + k + 1]))} - {v}) / {lit(float(t[i + k + 1] - t[i + 1]))}) * ({b})")
        return " + ".join(parts) if parts else None

    n = len(t) - degree - 1
    return [f"CASE WHEN {x} IS NULL THEN NULL ELSE {basis(i, degree) or lit(0.0)} END" for i in range(1, n)]


def _knots(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    p = {f"k{i}": x for i, x in enumerate(probs)}
    rows = exact_quantiles(_melt(df, cols, "double"), "column", "v", p).collect()
    return {r["column"]: sorted({r[k] for k in p}) for r in rows}


class StepNs(Step):
    """Natural cubic spline columns c_ns_1.. with knots at quantiles."""

    def __init__(self, select, deg_free: int = 2, keep: bool = False):
        super().__init__(select)
        self.deg_free, self.keep = deg_free, keep

    def learn(self, df, cols):
        kn = _knots(df, cols, [i / self.deg_free for i in range(self.deg_free + 1)])
        out = []
        for c in cols:
            if len(kn.get(c, [])) >= 2:
                out += [(f"{c}_ns_{i + 1}", e) for i, e in enumerate(natural_spline_sql(q(c), kn[c]))]
        return out, [] if self.keep else [c for c in cols if len(kn.get(c, [])) >= 2]


class StepBs(Step):
    """Cubic B-spline columns c_bs_1.. with inner knots at quantiles."""

    def __init__(self, select, deg_free: int = 3, keep: bool = False):
        super().__init__(select)
        self.deg_free, self.keep = max(deg_free, 3), keep

    def learn(self, df, cols):
        inner = self.deg_free - 3
        kn = _knots(df, cols, [i / (inner + 1) for i in range(inner + 2)])
        out = []
        for c in cols:
            k = kn.get(c, [])
            if len(k) >= 2:
                out += [(f"{c}_bs_{i + 1}", e) for i, e in enumerate(b_spline_sql(q(c), k[1:-1], k[0], k[-1]))]
        return out, [] if self.keep else [c for c in cols if len(kn.get(c, [])) >= 2]


# ---- projection -------------------------------------------------------------


def pca_fit(df: DataFrame, cols: Sequence[str], k: int, scale: bool = True) -> tuple[list[float], list[float], np.ndarray]:
    """Means, scales and loadings (columns x k); the largest loading of each component is positive."""
    st = df.agg(*[F.struct(F.avg(_present(df, c)), F.stddev_samp(_present(df, c))).alias(c) for c in cols]).first()
    mean = [float(st[c][0] or 0.0) for c in cols]
    sd = [float(st[c][1]) if scale and st[c][1] else 1.0 for c in cols]
    d = df.select(*[((F.col(c) - m) / s).alias(c) for c, m, s in zip(cols, mean, sd)]).dropna()
    v = VectorAssembler(inputCols=list(cols), outputCol="_v").transform(d).select("_v")
    w = PCA(k=k, inputCol="_v", outputCol="_p").fit(v).pc.toArray()
    sign = np.sign(w[np.argmax(np.abs(w), axis=0), range(w.shape[1])])
    return mean, sd, w * sign


class StepPca(Step):
    """Principal components PC1.. in place of the columns."""

    def __init__(self, select, num_comp: int = 5, scale: bool = False, prefix: str = "PC", keep: bool = False):
        super().__init__(select)
        self.num_comp, self.scale, self.prefix, self.keep = num_comp, scale, prefix, keep

    def learn(self, df, cols):
        k = min(self.num_comp, len(cols))
        mean, sd, w = pca_fit(df, cols, k, self.scale)
        out = []
        for j in range(k):
            terms = [f"{lit(float(w[i, j] / s))} * (double({q(c)}) - {lit(m)})" for i, (c, m, s) in enumerate(zip(cols, mean, sd))]
            out.append((f"{self.prefix}{j + 1}", " + ".join(terms)))
        return out, [] if self.keep else cols


def pca_loadings(df: DataFrame, cols: Sequence[str], k: int, scale: bool = True) -> DataFrame:
    """Loadings in long form (column, component, value)."""
    _, _, w = pca_fit(df, cols, k, scale)
    rows = [(c, f"PC{j + 1}", float(w[i, j])) for i, c in enumerate(cols) for j in range(k)]
    return df.sparkSession.createDataFrame(rows, "column string, component string, value double")


# ---- text -------------------------------------------------------------------


class StepTokenize(Step):
    """Text to an array of tokens: lower case words, or a custom split pattern taken as it is."""

    def __init__(self, select, pattern: str | None = None):
        super().__init__(select)
        self.pattern = pattern

    def learn(self, df, cols):
        if self.pattern is not None:
            return [(c, f"array_remove(split({q(c)}, {lit(self.pattern)}), '')") for c in cols], []
        return [(c, f"array_remove(split(lower({q(c)}), {lit(WORD_BREAK)}), '')") for c in cols], []


# Letters, digits and inner apostrophes make a word; anything else breaks words.
WORD_BREAK = r"[^\p{L}\p{N}']+"

class StepStopwords(Step):
    """Remove listed tokens: Spark's own list of a language, or any words."""

    def __init__(self, select, words: Sequence[str] | None = None, language: str = "english"):
        super().__init__(select)
        self.words, self.language = words, language

    def learn(self, df, cols):
        words = StopWordsRemover.loadDefaultStopWords(self.language) if self.words is None else list(self.words)
        # IN over literals is a hash lookup
        return [(c, f"filter({q(c)}, t -> t NOT IN ({', '.join(map(lit, words))}))" if words else q(c)) for c in cols], []


def token_counts(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.explode(col).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def kept_tokens(df: DataFrame, col: str, max_tokens: int | None = 100, min_times: int = 0) -> list[str]:
    """The max_tokens commonest tokens (None: all) seen at least min_times, ties by token."""
    n = token_counts(df, col).where(F.col("n") >= min_times).orderBy(F.desc("n"), "token")
    return [r["token"] for r in (n if max_tokens is None else n.limit(max_tokens)).collect()]


class StepTokenfilter(Step):
    """Keep only the commonest tokens."""

    def __init__(self, select, max_tokens: int = 100, min_times: int = 0):
        super().__init__(select)
        self.max_tokens, self.min_times = max_tokens, min_times

    def learn(self, df, cols):
        out = []
        for c in cols:
            keep = kept_tokens(df, c, self.max_tokens, self.min_times)
            ok = f"t IN ({', '.join(map(lit, keep))})" if keep else "false"
            out.append((c, f"filter({q(c)}, t -> {ok})"))
        return out, []


class TermFrequencies(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted StepTf: one count column tf_<col>_<token> per learned token."""

    vocab = Param(Params._dummy(), "vocab", "column and its tokens", TypeConverters.identity)

    def __init__(self, vocab=None):
        super().__init__()
        self._set(vocab=[list(v) for v in (vocab or [])])

    def _transform(self, df: DataFrame) -> DataFrame:
        for c, tokens in self.getOrDefault(self.vocab):
            if tokens:
                cv = CountVectorizerModel.from_vocabulary(list(tokens), inputCol=c, outputCol="_tf")
                d = cv.transform(df.withColumn(c, F.coalesce(c, F.array().cast("array<string>"))))
                d = d.withColumn("_tf", vector_to_array("_tf"))
                df = d.withColumns({f"tf_{c}_{t}": F.col("_tf")[i] for i, t in enumerate(tokens)}).drop("_tf")
            df = df.drop(c)
        return df


class StepTf(Step):
    """Term counts as columns, one per token seen in training; StepTokenfilter before it makes them fewer.

    With ``sparse`` the tokens stay in a stored dictionary and one vector
    column <c>_block holds all counts; rows without known tokens are all zeros.
    """

    def __init__(self, select, max_tokens: int | None = None, sparse: bool = False):
        super().__init__(select)
        self.max_tokens, self.sparse = max_tokens, sparse

    def _fit(self, df):
        cols = resolve(self.select, df, self.roles)
        if self.sparse:
            return SparseBlocks(learn_tokens(df, cols, self.max_tokens), {"form": "token", "keep_first": True})
        return TermFrequencies([[c, sorted(kept_tokens(df, c, self.max_tokens))] for c in cols])


# ---- rows and matrices ------------------------------------------------------


class StepDownsample(Step):
    """Training rows only: all classes cut to the smallest."""

    training_only = True

    def __init__(self, label: str, row_id: str, seed: int = 0):
        super().__init__([label])
        self.args = label, row_id, seed

    def _fit(self, df):
        return RowChange(lambda d: resample.downsample(d, *self.args))


class StepUpsample(StepDownsample):
    """Training rows only: all classes raised to the largest."""

    def _fit(self, df):
        return RowChange(lambda d: resample.upsample(d, *self.args).drop("copy"))


class StepImputeKnn(Step):
    """Fill from the nearest complete rows by Gower distance."""

    def __init__(self, select, row_id: str, impute_with: Sequence[str] | Selector, neighbours: int = 5):
        super().__init__(select)
        self.row_id, self.impute_with, self.neighbours = row_id, impute_with, neighbours

    def _fit(self, df):
        from tabkit.modelling.neighbours import fit_knn_impute

        cols = resolve(self.select, df, self.roles)
        using = [c for c in resolve(self.impute_with, df, self.roles) if c not in cols]
        return fit_knn_impute(df, cols, using, self.row_id, self.neighbours)


def numeric_matrix(df: DataFrame, cols: Sequence[str] | None = None, out: str = "features") -> DataFrame:
    """Columns as one vector for a learner, missing kept as NaN."""
    cols = list(cols or typed(df, "numeric"))
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)
