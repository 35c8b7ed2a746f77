"""Polynomial trend, trend with exogenous columns, first-order autoregression."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoloom.forecast.base import DEFAULT_HORIZON, Forecaster, future, keys_of
from chronoloom.forecast.running import ahead, autoregressed, sigma
from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import lagged, null_safe_join, positions, running


class Trend(Forecaster):
    """Least squares on the position in the series, degree 1 or 2."""

    def __init__(self, degree: int = 1):
        if degree not in (1, 2):
            raise ValueError("degree must be 1 or 2")
        self.degree = degree

    def rows(self, tsf, residuals):
        df = positions(tsf, "__pos", "__size").df
        # Scaled to [-1, 1], which keeps fourth powers harmless.
        u = (2 * F.col("__pos") - (F.col("__size") - 1)) / F.col("__size")
        return df.withColumn("__x", F.col("__pos").cast("double")).withColumn("__u", u)

    def aggregates(self, tsf):
        y, x, u = tsf.y, F.col("__x"), F.col("__u")
        if self.degree == 1:
            return {
                "mean_x": F.avg(x), "mean_y": F.avg(y),
                "sxx": F.regr_sxx(y, x), "sxy": F.regr_sxy(y, x), "syy": F.regr_syy(y, x),
            }
        sums = {f"u{p}": F.sum(F.pow(u, F.lit(p))) for p in (1, 2, 3, 4)}
        return {**sums, **{f"yu{p}": F.sum(y * F.pow(u, F.lit(p))) for p in (0, 1, 2)}}

    def finish(self, params):
        if self.degree == 1:
            slope = F.col("sxy") / F.nullif(F.col("sxx"), F.lit(0.0))
            params = params.withColumn("slope", slope)
            return params.withColumn("intercept", F.col("mean_y") - F.col("slope") * F.col("mean_x"))
        n, (s1, s2, s3, s4) = F.col("n"), [F.col(f"u{p}") for p in (1, 2, 3, 4)]
        t0, t1, t2 = [F.col(f"yu{p}") for p in (0, 1, 2)]

        def det(a, b, c, d, e, f, g, h, i):
            return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

        base = F.nullif(det(n, s1, s2, s1, s2, s3, s2, s3, s4), F.lit(0.0))
        return params.withColumns(
            {
                "b0": det(t0, s1, s2, t1, s2, s3, t2, s3, s4) / base,
                "b1": det(n, t0, s2, s1, t1, s3, s2, t2, s4) / base,
                "b2": det(n, s1, t0, s1, s2, t1, s2, s3, t2) / base,
            }
        ).drop("u1", "u2", "u3", "u4", "yu0", "yu1", "yu2")

    def sse(self, tsf):
        if self.degree == 2:
            raise NotImplementedError("Intervals exist for degree 1 only")
        y, x = tsf.y, F.col("__x")
        cross = F.regr_sxy(y, x)
        return F.regr_syy(y, x) - cross * cross / F.nullif(F.regr_sxx(y, x), F.lit(0.0))

    def dof(self, n):
        return n - 2

    def point(self):
        at = F.col("n") - 1 + F.col("h")
        if self.degree == 1:
            return F.col("intercept") + F.col("slope") * at
        u = (2 * at - (F.col("n") - 1)) / F.col("n")
        return F.col("b0") + F.col("b1") * u + F.col("b2") * u * u

    def spread(self):
        off = F.col("n") - 1 + F.col("h") - F.col("mean_x")
        return 1 + 1 / F.col("n") + off * off / F.nullif(F.col("sxx"), F.lit(0.0))

    def merged(self):
        if self.degree == 2:
            raise NotImplementedError("Only degree 1 can be updated")
        # New positions start where the old ones end; moments merge pairwise.
        a, b = F.col("o.n"), F.col("m.n")
        dx = F.col("m.mean_x") + a - F.col("o.mean_x")
        dy = F.col("m.mean_y") - F.col("o.mean_y")
        w = a * b / (a + b)
        mean_x = F.col("o.mean_x") + dx * b / (a + b)
        mean_y = F.col("o.mean_y") + dy * b / (a + b)
        sxx = F.col("o.sxx") + F.col("m.sxx") + dx * dx * w
        sxy = F.col("o.sxy") + F.col("m.sxy") + dx * dy * w
        syy = F.col("o.syy") + F.col("m.syy") + dy * dy * w
        slope = sxy / F.nullif(sxx, F.lit(0.0))
        return {
            "mean_x": mean_x, "mean_y": mean_y, "sxx": sxx, "sxy": sxy, "syy": syy,
            "slope": slope, "intercept": mean_y - slope * mean_x,
            "sse": syy - sxy * sxy / F.nullif(sxx, F.lit(0.0)),
        }

    def rolling(self, tsf, fh, window):
        if self.degree != 1 or window:
            return None
        x = F.col("pos").cast("double")
        sums = running(
            positions(tsf, "pos", "n"),
            {
                "__y": ("sum", tsf.y), "__xy": ("sum", x * tsf.y), "__c": ("count", tsf.y),
                "__x": ("sum", F.when(tsf.y.isNotNull(), x)),
                "__xx": ("sum", F.when(tsf.y.isNotNull(), x * x)),
            },
        )
        c, sx, sy = F.col("__c"), F.col("__x"), F.col("__y")
        slope = (F.col("__xy") - sx * sy / c) / F.nullif(F.col("__xx") - sx * sx / c, F.lit(0.0))
        line = F.struct(slope.alias("b"), ((sy - slope * sx) / c).alias("a"))
        back = lagged(sums, {f"__line{h}": (line, h) for h in fh})
        df = back.df.withColumns(
            {f"yhat_{h}": F.col(f"__line{h}.a") + F.col(f"__line{h}.b") * F.col("pos") for h in fh}
        )
        return back.with_df(df.drop("__y", "__xy", "__c", "__x", "__xx", *[f"__line{h}" for h in fh]))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _solve(covariance: pd.Series, cross: pd.Series) -> pd.Series:
    """Least-squares slopes from centred moments, one small system per series."""
    b = np.stack(cross.to_numpy())
    a = np.stack(covariance.to_numpy()).reshape(len(b), b.shape[1], b.shape[1])
    scale = np.sqrt(np.einsum("nii->ni", a))
    scale[scale == 0] = 1.0
    unit = a / scale[:, :, None] / scale[:, None, :]
    slopes = np.einsum("nij,nj->ni", np.linalg.pinv(unit, rcond=1e-10, hermitian=True), b / scale)
    return pd.Series(list(slopes / scale))


class TrendExog(Forecaster):
    """Linear trend plus exogenous columns, solved per series.

    Means and covariances are mergeable aggregates, so a long series is reduced in parts;
    only the small systems go to a vectorised solver. Forecasting
    needs the future values of the same columns.
    """

    def __init__(self, exog: list[str] | None = None):
        self.exog = exog

    def fit(self, tsf, residuals=False):
        if residuals:
            raise NotImplementedError("TrendExog has no intervals")
        exog = list(self.exog or tsf.exog)
        if not exog:
            raise ValueError("TrendExog needs exogenous columns")
        needed = tsf.y.isNotNull()
        for c in exog:
            needed = needed & F.col(c).isNotNull()
        known = tsf.with_df(tsf.df.where(needed))
        placed = positions(known, "__pos", "__size").df
        x = [F.col("__pos").cast("double"), *[F.col(c).cast("double") for c in exog]]
        size = range(len(x))
        sums = placed.groupBy(*tsf.keys).agg(
            F.max(tsf.time).alias("cutoff"),
            F.count(tsf.y).alias("n"),
            F.array(
                *[F.covar_pop(x[max(i, j)], x[min(i, j)]) for i in size for j in size]
            ).alias("__cov"),
            F.array(*[F.covar_pop(v, tsf.y) for v in x]).alias("__cross"),
            F.array(F.avg(tsf.y), *[F.avg(v) for v in x]).alias("means"),
        )
        params = sums.withColumn("weights", _solve("__cov", "__cross"))
        params = params.withColumn("step", tsf.step.columns())
        return params.select(*tsf.keys, "cutoff", "step", "n", "means", "weights")

    def forecast(self, params, horizon=DEFAULT_HORIZON, X: TimeSeriesFrame | None = None):
        if X is None:
            raise ValueError("TrendExog needs the exogenous columns of the forecast times (X)")
        exog, keys = list(self.exog or X.exog), keys_of(params)
        ahead = X.df.select(*keys, F.col(X.time).alias("ts"), *exog)
        out = null_safe_join(future(params, horizon), ahead, [*keys, "ts"])
        x = [F.col("n") - 1 + F.col("h"), *[F.col(c).cast("double") for c in exog]]
        value = F.col("means")[0]
        for i, v in enumerate(x):
            value = value + F.col("weights")[i] * (v - F.col("means")[i + 1])
        return out.select(*keys, "ts", "h", value.alias("yhat"))


def _pooled(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Moments of the pairs of both; either may have none."""
    n = a["pairs"] + b["pairs"]
    share = b["pairs"] / F.nullif(n, F.lit(0))
    none = F.lit(0.0)
    m = [{c: F.coalesce(s[c], none) for c in _MOMENTS} for s in (a, b)]
    # A side without pairs has no mean of its own, so it takes that of the other.
    at = [{c: F.coalesce(s[c], t[c]) for c in ("mean_x", "mean_y")} for s, t in ((a, b), (b, a))]
    dx, dy = at[1]["mean_x"] - at[0]["mean_x"], at[1]["mean_y"] - at[0]["mean_y"]
    w = a["pairs"] * share
    return {
        "pairs": n,
        "mean_x": at[0]["mean_x"] + dx * share, "mean_y": at[0]["mean_y"] + dy * share,
        "sxx": m[0]["sxx"] + m[1]["sxx"] + F.coalesce(dx * dx * w, none),
        "sxy": m[0]["sxy"] + m[1]["sxy"] + F.coalesce(dx * dy * w, none),
        "syy": m[0]["syy"] + m[1]["syy"] + F.coalesce(dy * dy * w, none),
    }


_MOMENTS = ("sxx", "sxy", "syy")


class AR1(Forecaster):
    """y(t) = a + phi y(t-1) by least squares per series, iterated ahead.

    The table keeps the moments of the pairs (y(t-1), y(t)) with the first and last value, so
    that an update adds the new pairs and the one across the border.
    """

    def rows(self, tsf, residuals):
        return lagged(tsf, {"__lag": (tsf.target, 1)}).df

    def aggregates(self, tsf):
        return {
            "last": F.max_by(tsf.y, tsf.ts),
            "phi": F.regr_slope(tsf.y, F.col("__lag")),
            "a": F.regr_intercept(tsf.y, F.col("__lag")),
            "first": F.min_by(tsf.y, tsf.ts),
            "pairs": F.regr_count(tsf.y, F.col("__lag")),
            "mean_x": F.regr_avgx(tsf.y, F.col("__lag")), "mean_y": F.regr_avgy(tsf.y, F.col("__lag")),
            "sxx": F.regr_sxx(tsf.y, F.col("__lag")), "sxy": F.regr_sxy(tsf.y, F.col("__lag")),
            "syy": F.regr_syy(tsf.y, F.col("__lag")),
        }

    def sse(self, tsf):
        y, x = tsf.y, F.col("__lag")
        cross = F.regr_sxy(y, x)
        return F.regr_syy(y, x) - cross * cross / F.nullif(F.regr_sxx(y, x), F.lit(0.0))

    def dof(self, n):
        return n - 3

    def merged(self):
        none = F.lit(0.0)
        sides = [{c: F.col(f"{s}.{c}") for c in ("pairs", "mean_x", "mean_y", *_MOMENTS)} for s in "om"]
        border = {
            "pairs": F.lit(1).cast("bigint"), "mean_x": F.col("o.last").cast("double"),
            "mean_y": F.col("m.first").cast("double"), **{c: none for c in _MOMENTS},
        }
        all_ = _pooled(_pooled(sides[0], border), sides[1])
        phi = all_["sxy"] / F.nullif(all_["sxx"], none)
        return {
            "last": F.col("m.last"), "phi": phi, "a": all_["mean_y"] - phi * all_["mean_x"],
            "first": F.col("o.first"), **all_,
            "sse": all_["syy"] - all_["sxy"] * all_["sxy"] / F.nullif(all_["sxx"], none),
        }

    def point(self):
        phi, h = F.col("phi"), F.col("h")
        grown = F.when(phi == 1.0, h.cast("double")).otherwise(
            (1 - F.pow(phi, h)) / F.nullif(1 - phi, F.lit(0.0))
        )
        return F.col("a") * grown + F.pow(phi, h) * F.col("last")

    def spread(self):
        sq = F.col("phi") * F.col("phi")
        return F.when(sq == 1.0, F.col("h").cast("double")).otherwise(
            (1 - F.pow(sq, F.col("h"))) / F.nullif(1 - sq, F.lit(0.0))
        )


    def rolling_normal(self, tsf, fh, window):
        if window:
            return None

        def made(s, h):
            phi, sq = s["phi"], s["phi"] * s["phi"]
            one = F.lit(0.0)
            grown = F.when(phi == 1.0, F.lit(float(h))).otherwise((1 - F.pow(phi, F.lit(h))) / F.nullif(1 - phi, one))
            spread = F.when(sq == 1.0, F.lit(float(h))).otherwise((1 - F.pow(sq, F.lit(h))) / F.nullif(1 - sq, one))
            yhat = s["a"] * grown + F.pow(phi, F.lit(h)) * s["last"]
            return {"yhat": yhat, "sigma": sigma(s["sse"], s["known"] - 3, spread)}

        return ahead(autoregressed(tsf), fh, {c: f"__{c}" for c in ("phi", "a", "last", "sse", "known")}, made)

    def rolling(self, tsf, fh, window):
        return self.rolling_normal(tsf, fh, window)


class PooledAR(Forecaster):
    """One linear autoregression over p lags, fitted on the rows of all series together.

    The rows are reduced to their means and covariances, and one p-square system is solved;
    each series keeps its last p values as state. With `by`, some of the keys, every value of
    these has a model of its own; so folds of a cross-validation never learn from each other.
    Series with fewer than p values get NULL forecasts.
    """

    def __init__(self, p: int = 3, by: tuple[str, ...] = ()):
        if p < 1:
            raise ValueError("p must be positive")
        self.p, self.by = p, tuple(by)

    def within(self, *by: str) -> "PooledAR":
        return PooledAR(self.p, (*self.by, *by))

    def fit(self, tsf, residuals=False):
        if residuals:
            raise NotImplementedError("PooledAR has no intervals")
        known = tsf.with_df(tsf.df.where(tsf.y.isNotNull()))
        names = [f"__lag{i + 1}" for i in range(self.p)]
        rows = lagged(known, {c: (tsf.target, i + 1) for i, c in enumerate(names)}).df.dropna(
            subset=names
        )
        size = range(self.p)
        x = [F.col(c) for c in names]
        model = rows.groupBy(*self.by).agg(
            F.count(tsf.y).alias("__rows"),
            F.array(*[F.covar_pop(x[max(i, j)], x[min(i, j)]) for i in size for j in size]).alias("__cov"),
            F.array(*[F.covar_pop(v, tsf.y) for v in x]).alias("__cross"),
            F.array(*[F.avg(v) for v in x]).alias("__means"), F.avg(tsf.y).alias("__mean"),
        )
        model = model.where("__rows > 0").withColumn("weights", _solve("__cov", "__cross"))
        line = F.aggregate(
            F.zip_with("weights", "__means", lambda w, m: w * m), F.lit(0.0), lambda a, v: a + v
        )
        model = model.select(*self.by, "weights", (F.col("__mean") - line).alias("intercept"))
        from chronoloom.forecast.naive import SeasonalNaive

        params = SeasonalNaive(self.p).fit(known)
        params = params.select(*tsf.keys, "cutoff", "step", "n", F.col("season").alias("recent"))
        if self.by:
            return null_safe_join(params, model, self.by, "left")
        only = model.first()  # p + 1 numbers
        if only is None:
            raise ValueError(f"No series has more than {self.p} values")
        return params.withColumn("weights", F.array(*[F.lit(w) for w in only.weights])).withColumn(
            "intercept", F.lit(only.intercept)
        )

    def forecast(self, params: DataFrame, horizon=DEFAULT_HORIZON):
        keys = keys_of(params)
        p = self.p

        def step(state, _):
            value = F.col("intercept")
            for i in range(p):
                value = value + F.col("weights")[i] * F.try_element_at(state, F.lit(-(i + 1)))
            return F.concat(state, F.array(value))

        path = F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("recent"), step)
        out = future(params.withColumn("__path", path), horizon)
        known = F.size("recent") == p
        return out.select(
            *keys, "ts", "h", F.when(known, F.get("__path", F.col("h") + p - 1)).alias("yhat")
        )
