"""Exponential smoothing.

A smoother is a linear recursion, so a stretch of the series acts on the state as an
affine map, and the squared errors of that stretch are a quadratic form of the state
it starts from. Each (key, chunk) is reduced to such a map on its own, and the maps
of a series are composed in chunk order. That is exact and needs no task that sees a
whole long series.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.forecast.base import DEFAULT_HORIZON, Forecaster, future, keys_of
from chronoloom.forecast.running import ahead, sigma, smoothed
from chronoloom.forecast.trend import Trend
from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import CHUNK, attach, chunked, head_rows, null_safe_join, positions, running

ALPHAS = tuple(i / 10 for i in range(1, 10))


class SES(Forecaster):
    """Simple smoothing from the first value on; alpha given, or the grid's least error.

    The table keeps level and error of every weight (`states`), so that an update goes on from
    there with the new rows only and chooses among the weights anew.
    """

    def __init__(self, alpha: float | None = None, grid: tuple[float, ...] = ALPHAS):
        self.grid = (float(alpha),) if alpha is not None else tuple(float(a) for a in grid)
        if any(not 0.0 < a <= 1.0 for a in self.grid):
            raise ValueError("alpha must lie in (0, 1]")

    def fit(self, tsf, residuals=False):
        series, alphas = self._chunks(tsf), F.array(*[F.lit(a) for a in self.grid])
        fits = F.transform(
            F.sequence(F.lit(0), F.lit(len(self.grid) - 1)),
            lambda i: _ses_compose("chunks", F.col("first"), F.lit(0.0), i, F.get(alphas, i)),
        )
        return self._chosen(series.withColumn("states", fits).withColumn("step", tsf.step.columns()), tsf.keys)

    def _chosen(self, fitted: DataFrame, keys: list[str]) -> DataFrame:
        out = fitted.withColumn("best", F.array_min("states"))
        return out.select(
            *keys, "cutoff", "step", "n",
            F.col("best.alpha").alias("alpha"), F.col("best.level").alias("level"),
            F.col("best.sse").alias("sse"), (F.col("n") - 1).alias("dof"), "states",
        )

    def _chunks(self, tsf: TimeSeriesFrame) -> DataFrame:
        """A row for each series with the maps of its chunks in order."""
        known = tsf.with_df(tsf.df.where(tsf.y.isNotNull()))
        per_chunk = chunked(known).groupBy(*tsf.keys, CHUNK).agg(
            F.max(tsf.time).alias("cutoff"),
            F.count(tsf.y).alias("n"),
            F.min_by(tsf.y, tsf.ts).alias("first"),
            F.array_sort(F.collect_list(F.struct(tsf.ts.alias("t"), tsf.y.alias("y")))).alias("ys"),
        )
        alphas = F.array(*[F.lit(a) for a in self.grid])
        maps = per_chunk.withColumn("maps", F.transform(alphas, lambda a: _ses_map("ys", F.col("first"), a)))
        return maps.groupBy(*tsf.keys).agg(
            F.max("cutoff").alias("cutoff"),
            F.sum("n").alias("n"),
            F.min_by("first", CHUNK).alias("first"),
            F.array_sort(F.collect_list(F.struct(CHUNK, F.col("first").alias("base"), "maps"))).alias("chunks"),
        )

    def point(self):
        return F.col("level")

    def spread(self):
        return 1 + (F.col("h") - 1) * F.col("alpha") * F.col("alpha")

    def update(self, params, new):
        """As if fitted on old and new rows together; the old levels are carried on."""
        self.check_later(params, new)
        keys = keys_of(params)
        old = params.select(*keys, F.struct(*[c for c in params.columns if c not in keys]).alias("o"))
        late = self._chunks(new).withColumn("__step", new.step.columns())
        both = null_safe_join(old, late, keys, "left")
        fresh = null_safe_join(late, old, keys, "left_anti").withColumn("o", F.lit(None).cast(old.schema["o"].dataType))
        both = both.unionByName(fresh)
        alphas = F.array(*[F.lit(a) for a in self.grid])
        going_on = lambda i: _ses_compose(
            "chunks", F.coalesce(F.get("o.states", i)["level"], F.col("first").cast("double")),
            F.coalesce(F.get("o.states", i)["sse"], F.lit(0.0)), i, F.get(alphas, i),
        )
        after = F.transform(F.sequence(F.lit(0), F.lit(len(self.grid) - 1)), going_on)
        states = both.select(
            *keys,
            F.coalesce("cutoff", "o.cutoff").alias("cutoff"), F.coalesce("o.step", "__step").alias("step"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("o.n", F.lit(0))).alias("n"),
            F.when(F.col("chunks").isNull(), F.col("o.states")).otherwise(after).alias("states"),
        )
        return self._chosen(states, keys)

    def rolling_normal(self, tsf, fh, window):
        if window:
            return None

        def made(s, h):
            spread = 1 + (h - 1) * s["alpha"] * s["alpha"]
            return {"yhat": s["level"], "sigma": sigma(s["sse"], s["known"] - 1, spread)}

        state = {c: f"__{c}" for c in ("level", "alpha", "sse", "known")}
        return ahead(smoothed(tsf, self.grid), fh, state, made)

    def rolling(self, tsf, fh, window):
        return self.rolling_normal(tsf, fh, window)


def _ses_map(ys: str, base: Column, alpha: Column) -> Column:
    """level_out = a * level_in + b, and SSE = s0 - 2 s1 level_in + s2 level_in^2.

    Levels and values count from `base`, the chunk's first value, so that the squares do not
    cancel in series far from zero.
    """
    start = F.struct(
        F.lit(1.0).alias("a"), F.lit(0.0).alias("b"),
        F.lit(0.0).alias("s0"), F.lit(0.0).alias("s1"), F.lit(0.0).alias("s2"),
    )

    def step(s, row):
        value = row["y"] - base
        rest = value - s["b"]
        return F.struct(
            ((1 - alpha) * s["a"]).alias("a"),
            (alpha * value + (1 - alpha) * s["b"]).alias("b"),
            (s["s0"] + rest * rest).alias("s0"),
            (s["s1"] + rest * s["a"]).alias("s1"),
            (s["s2"] + s["a"] * s["a"]).alias("s2"),
        )

    return F.aggregate(F.col(ys), start, step)


def _ses_compose(chunks: str, first: Column, error: Column, i: Column, alpha: Column) -> Column:
    start = F.struct(first.cast("double").alias("level"), error.alias("sse"))

    def step(s, chunk):
        m, level = F.get(chunk["maps"], i), s["level"] - chunk["base"]
        return F.struct(
            (chunk["base"] + m["a"] * level + m["b"]).alias("level"),
            (s["sse"] + m["s0"] - 2 * m["s1"] * level + m["s2"] * level * level).alias("sse"),
        )

    return F.aggregate(
        F.col(chunks), start, step,
        lambda s: F.struct(s["sse"].alias("sse"), alpha.alias("alpha"), s["level"].alias("level")),
    )


class Theta(Forecaster):
    """Simple smoothing with half the slope of the linear trend as drift.

    The equivalence of the theta method to smoothing with drift is from Hyndman and
    Billah (2003). For seasonal series chain it after Deseasonalise.
    """

    def __init__(self, alpha: float | None = None, grid: tuple[float, ...] = ALPHAS):
        self.ses = SES(alpha, grid)

    def fit(self, tsf, residuals=False):
        line = Trend().fit(tsf).drop("cutoff", "step", "n")
        return null_safe_join(self.ses.fit(tsf), line, tsf.keys)

    def update(self, params, new):
        keys, line = keys_of(params), Trend()
        fixed = [*keys, "cutoff", "step", "n"]
        of_line = [c for c in params.columns if c not in (*fixed, "alpha", "level", "sse", "dof", "states")]
        level = self.ses.update(params.drop(*of_line), new)
        return null_safe_join(level, line.update(params.select(*fixed, *of_line), new).drop("cutoff", "step", "n"), keys)

    def point(self):
        a, n = F.col("alpha"), F.col("n")
        lead = F.col("h") - 1 + (1 - F.pow(1 - a, n)) / a
        return F.col("level") + 0.5 * F.coalesce("slope", F.lit(0.0)) * lead

    def spread(self):
        return self.ses.spread()

    def rolling_normal(self, tsf, fh, window):
        if window:
            return None
        states = smoothed(tsf, self.ses.grid)
        x = positions(states.with_df(states.df.where(tsf.y.isNotNull())), "__x", None).df
        # Numbered over the values only, as in `fit`; rows without one get the sums up to there.
        rows = null_safe_join(states.df, x.select(*tsf.keys, tsf.time, "__x"), [*tsf.keys, tsf.time], "left")
        x, first = F.col("__x").cast("double"), F.min_by(tsf.y, tsf.ts)
        base = states.with_df(rows)
        starts = rows.where(tsf.y.isNotNull()).groupBy(*tsf.keys).agg(first.cast("double").alias("__base"))
        base = attach(base, starts, "left")
        u = tsf.y - F.col("__base")
        sums = running(base, {"__sx": ("sum", x), "__sxx": ("sum", x * x), "__su": ("sum", u), "__sxu": ("sum", x * u)})
        c = F.col("__known")
        rise = F.col("__sxu") - F.col("__sx") * F.col("__su") / c
        run = F.nullif(F.col("__sxx") - F.col("__sx") * F.col("__sx") / c, F.lit(0.0))
        sums = sums.with_df(sums.df.withColumn("__slope", rise / run).drop("__x", "__base", "__sx", "__sxx", "__su", "__sxu"))

        def made(s, h):
            lead = h - 1 + (1 - F.pow(1 - s["alpha"], s["known"])) / s["alpha"]
            spread = 1 + (h - 1) * s["alpha"] * s["alpha"]
            yhat = s["level"] + 0.5 * F.coalesce(s["slope"], F.lit(0.0)) * lead
            return {"yhat": yhat, "sigma": sigma(s["sse"], s["known"] - 1, spread)}

        return ahead(sums, fh, {c: f"__{c}" for c in ("level", "alpha", "sse", "known", "slope")}, made)

    def rolling(self, tsf, fh, window):
        return self.rolling_normal(tsf, fh, window)


# Candidate weights of the automatic choice: level, trend and season.
LEVEL_GRID = (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)
TREND_GRID = (0.01, 0.1, 0.3)
SEASON_GRID = (0.05, 0.2, 0.5)


def _grid(model: str) -> np.ndarray:
    if model == "level":
        return np.array([(a, 0.0, 0.0) for a in LEVEL_GRID])
    if model == "trend":
        return np.array([(a, b, 0.0) for a, b in product(LEVEL_GRID, TREND_GRID)])
    return np.array(list(product(LEVEL_GRID, TREND_GRID, SEASON_GRID)))


def _dims(model: str, sp: int) -> int:
    return {"level": 1, "trend": 2}.get(model, 2 + sp)


def _start(model: str, sp: int, head: np.ndarray) -> np.ndarray:
    """State before the first value, from the first two seasons."""
    if model == "level":
        return np.array([head[0]])
    if model == "trend":
        b = head[1] - head[0]
        return np.array([head[0] - b, b])
    one, two = head[:sp], head[sp : 2 * sp]
    b = (two.mean() - one.mean()) / sp
    level = one.mean() - b * (sp + 1) / 2
    return np.concatenate([[level, b], one - (level + b * np.arange(1, sp + 1))])


def _scan(model: str, sp: int, y: np.ndarray, pos0: int, state: np.ndarray):
    """Run all grid points over y. `state` is (grid, dims, columns), the last column
    constant; returns it with the error form (grid, columns, columns)."""
    grid = _grid(model)
    alpha, beta, gamma = (grid[:, i, None] for i in range(3))
    m = state.copy()
    q = np.zeros((len(grid), m.shape[2], m.shape[2]))
    for t, value in enumerate(y):
        level = m[:, 0] + m[:, 1] if model != "level" else m[:, 0].copy()
        slot = 2 + (pos0 + t) % sp
        err = -(level + m[:, slot]) if model == "season" else -level
        err[:, -1] += value
        q += err[:, :, None] * err[:, None, :]
        m[:, 0] = level + alpha * err
        if model != "level":
            m[:, 1] = m[:, 1] + alpha * beta * err
        if model == "season":
            m[:, slot] = m[:, slot] + gamma * (1 - alpha) * err
    return m, q


class AutoSmooth(Forecaster):
    """Level, linear-trend or additive seasonal smoothing, chosen per series by AICc.

    Start values come from the first two seasons and weights from a grid. A series
    with fewer than two seasons is not offered the seasonal model.
    """

    def __init__(self, sp: int = 1):
        if sp < 1:
            raise ValueError("sp must be positive")
        self.sp = sp
        self.models = ("level", "trend") + (("season",) if sp > 1 else ())

    def fit(self, tsf, residuals=False):
        sp, models, keys = self.sp, self.models, list(tsf.keys)
        known = tsf.with_df(tsf.df.where(tsf.y.isNotNull()))
        need = max(2 * sp, 2)
        heads = head_rows(known, need).groupBy(*keys).agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct("rn", tsf.y.alias("y")))), lambda s: s["y"]
            ).alias("head")
        )
        placed = positions(known, "pos", None)
        long = bool(tsf.width)
        rows = attach(placed, heads) if not long else placed
        cols = [*keys, CHUNK, tsf.time, "pos", tsf.target] + ([] if long else ["head"])
        df = chunked(rows).select(*cols)
        key_schema = ", ".join(
            f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys
        )
        time, target = tsf.time, tsf.target

        def reduce_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(time, kind="stable")
            y, pos0 = pdf[target].to_numpy(float), int(pdf["pos"].iloc[0])
            out = []
            for model in models:
                d, g = _dims(model, sp), len(_grid(model))
                if long:
                    state = np.broadcast_to(np.eye(d, d + 1), (g, d, d + 1))
                else:
                    head = np.asarray(pdf["head"].iloc[0], float)
                    if len(head) < (2 * sp if model == "season" else 2):
                        if model != "level":
                            continue
                    state = np.broadcast_to(_start(model, sp, head)[None, :, None], (g, d, 1))
                m, q = _scan(model, sp, y, pos0, state)
                out.append((model, m.ravel().tolist(), q.ravel().tolist()))
            result = pd.DataFrame(out, columns=["model", "m", "q"])
            for k in [*keys, CHUNK]:
                result[k] = pdf[k].iloc[0]
            result["n"], result["cutoff"] = len(y), pdf[time].iloc[-1]
            return result[[*keys, CHUNK, "model", "m", "q", "n", "cutoff"]]

        ttype = tsf.time_type.simpleString()
        maps = df.groupBy(*keys, CHUNK).applyInPandas(
            reduce_chunk,
            f"{key_schema}, `{CHUNK}` bigint, model string, m array<double>, q array<double>,"
            f" n bigint, cutoff {ttype}",
        )
        if long:
            maps = null_safe_join(maps, heads, keys)

        def compose(pdf: pd.DataFrame) -> pd.DataFrame:
            best = None
            for model, part in pdf.sort_values(CHUNK, kind="stable").groupby("model"):
                d, grid = _dims(model, sp), _grid(model)
                g, n = len(grid), int(part["n"].sum())
                if long:
                    head = np.asarray(part["head"].iloc[0], float)
                    if model != "level" and len(head) < (2 * sp if model == "season" else 2):
                        continue
                    state = np.broadcast_to(_start(model, sp, head), (g, d))
                    sse = np.zeros(g)
                    for m, q in zip(part["m"], part["q"]):
                        full = np.concatenate([state, np.ones((g, 1))], axis=1)
                        q = np.asarray(q, float).reshape(g, d + 1, d + 1)
                        sse = sse + np.einsum("gi,gij,gj->g", full, q, full)
                        state = np.einsum(
                            "gdj,gj->gd", np.asarray(m, float).reshape(g, d, d + 1), full
                        )
                else:
                    state = np.asarray(part["m"].iloc[0], float).reshape(g, d)
                    sse = np.asarray(part["q"].iloc[0], float).reshape(g)
                i = int(np.argmin(sse))
                # Weights plus start values plus the variance.
                k = {"level": 1, "trend": 2}.get(model, 3) + d + 1
                if n - k - 1 <= 0:
                    aicc = np.inf
                else:
                    fit = n * np.log(max(sse[i], 1e-300) / n)
                    aicc = fit + 2 * k + 2 * k * (k + 1) / (n - k - 1)
                if best is None or aicc < best[0]:
                    best = (aicc, model, grid[i].tolist(), state[i].tolist(), float(sse[i]), n, k)
            aicc, model, weights, state, sse, n, k = best
            row = {key: [pdf[key].iloc[0]] for key in keys}
            row.update(
                cutoff=[pdf["cutoff"].max()], n=[n], model=[model], weights=[weights],
                state=[state], sse=[sse], dof=[n - k + 1],
                aicc=[aicc if np.isfinite(aicc) else None],
            )
            return pd.DataFrame(row)

        params = maps.groupBy(*keys).applyInPandas(
            compose,
            f"{key_schema}, cutoff {ttype}, n bigint, model string, weights array<double>,"
            " state array<double>, sse double, dof bigint, aicc double",
        )
        params = params.withColumn("step", tsf.step.columns())
        return params.select(
            *keys, "cutoff", "step", "n", "model", "weights", "state", "sse", "dof", "aicc"
        )

    def point(self):
        s, h = F.col("state"), F.col("h")
        line = F.when(F.col("model") == "level", s[0]).otherwise(s[0] + h * F.get(s, F.lit(1)))
        season = F.get(s, (2 + (F.col("n") + h - 1) % self.sp).cast("int"))
        return line + F.when(F.col("model") == "season", season).otherwise(0.0)

    def spread(self):
        """1 + sum of squared error weights c(j) for j < h, per model."""
        w, h, sp = F.col("weights"), F.col("h"), self.sp

        def weight(j):
            trend = F.when(F.col("model") != "level", w[0] * w[1] * j).otherwise(0.0)
            hit = (F.col("model") == "season") & (j % sp == 0)
            return w[0] + trend + F.when(hit, w[2] * (1 - w[0])).otherwise(0.0)

        steps = F.when(h > 1, F.sequence(F.lit(1), h - 1)).otherwise(F.array().cast("array<int>"))
        squares = F.transform(steps, lambda j: weight(j) * weight(j))
        return 1 + F.aggregate(squares, F.lit(0.0), lambda a, b: a + b)

    def forecast(self, params: DataFrame, horizon: int = DEFAULT_HORIZON) -> DataFrame:
        return future(params, horizon).select(*keys_of(params), "ts", "h", self.point().alias("yhat"))
