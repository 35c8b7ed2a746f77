"""Last value, last season, means and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.forecast.base import Forecaster
from chronoloom.forecast.running import ahead, sigma
from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import head_rows, lagged, nearby, null_safe_join, positions, running


def _lagged_rows(tsf: TimeSeriesFrame, k: int) -> DataFrame:
    return lagged(tsf, {"__lag": (tsf.target, k)}).df


def _squares(e: Column) -> Column:
    return F.sum(e * e)


def _running_errors(tsf: TimeSeriesFrame, back: int) -> TimeSeriesFrame:
    """Adds as of each row: last value, first value, number of values, sums of the differences
    from `back` rows earlier and of their squares, and moments about the first value."""
    placed = positions(tsf, "__spot", None)
    rows = lagged(placed, {"__lag": (tsf.target, back)})
    at0 = F.when(F.col("__spot") == 0, tsf.y.cast("double"))
    rows = running(rows, {"__first": ("min", at0)})
    d, u = tsf.y.cast("double") - F.col("__lag"), tsf.y - F.col("__first")
    sums = {
        "__known": ("count", tsf.y), "__pairs": ("count", d), "__d": ("sum", d), "__dd": ("sum", d * d),
        "__u": ("sum", u), "__uu": ("sum", u * u),
    }
    out = running(rows, sums)
    return out.with_df(out.df.withColumn("__last", tsf.y.cast("double")).drop("__lag", "__spot"))


_ERRORS = {c: f"__{c}" for c in ("last", "first", "known", "pairs", "d", "dd", "u", "uu")}


def _in_order(point: Column) -> Column:
    """The `y` of (position, y) structs in position order; NULL structs are left out."""
    return F.transform(F.array_sort(F.collect_list(point)), lambda s: s["y"])


class NaiveLast(Forecaster):
    """Every step is the last value; variance grows with h."""

    def rows(self, tsf, residuals):
        return _lagged_rows(tsf, 1) if residuals else tsf.df

    def aggregates(self, tsf):
        return {"last": F.max_by(tsf.y, tsf.ts)}

    def sse(self, tsf):
        return _squares(tsf.y - F.col("__lag"))

    def point(self):
        return F.col("last")

    def spread(self):
        return F.col("h").cast("double")

    def merged(self):
        newer = F.col("m.cutoff") >= F.col("o.cutoff")
        return {"last": F.when(newer, F.col("m.last")).otherwise(F.col("o.last"))}

    def rolling(self, tsf, fh, window):
        placed = positions(tsf, "pos", "n")
        return lagged(placed, {f"yhat_{h}": (tsf.target, h) for h in fh})

    def rolling_normal(self, tsf, fh, window):
        if window:
            return None

        def made(s, h):
            return {"yhat": s["last"], "sigma": sigma(s["dd"], s["known"] - 1, F.lit(float(h)))}

        return ahead(_running_errors(tsf, 1), fh, _ERRORS, made)


class SeasonalNaive(Forecaster):
    """Repeats the last `sp` values, counted from the end of the series.

    `season` holds them in time order; a series shorter than `sp` has NULL forecasts
    for the slots that it has not seen.
    """

    def __init__(self, sp: int):
        if not isinstance(sp, int) or sp < 1:
            raise ValueError(f"sp must be a positive integer, got {sp!r}")
        self.sp = sp

    def rows(self, tsf, residuals):
        placed = positions(tsf, "__pos", "__size")
        return _lagged_rows(placed, self.sp) if residuals else placed.df

    def aggregates(self, tsf):
        recent = F.col("__size") - F.col("__pos") <= self.sp
        return {"season": _in_order(F.when(recent, F.struct("__pos", tsf.y.alias("y"))))}

    def sse(self, tsf):
        return _squares(tsf.y - F.col("__lag"))

    def dof(self, n):
        return n - self.sp

    def fit(self, tsf, residuals=False):
        if residuals or not tsf.width:
            return super().fit(tsf, residuals)
        # Long series: the last rows are found without moving the others.
        known = tsf.with_df(tsf.df.where(tsf.y.isNotNull()))
        tail = head_rows(known, self.sp, last=True)
        sizes = known.df.groupBy(*tsf.keys).agg(
            F.max(tsf.time).alias("cutoff"), F.count(F.lit(1)).alias("n")
        )
        base = sizes.withColumn("step", tsf.step.columns()).select(*tsf.keys, "cutoff", "step", "n")
        seasons = tail.groupBy(*tsf.keys).agg(
            _in_order(F.struct((-F.col("rn")).alias("at"), tsf.y.alias("y"))).alias("season")
        )
        return null_safe_join(base, seasons, tsf.keys)

    def point(self):
        # Slots are counted from the end; sp - size slots at the front may be missing.
        slot = (F.col("h") - 1) % self.sp + F.size("season") - self.sp
        return F.when(slot >= 0, F.get("season", slot))

    def spread(self):
        return F.floor((F.col("h") - 1) / self.sp).cast("double") + 1

    def merged(self):
        both = F.concat("o.season", "m.season")
        start = F.greatest(F.size(both) - self.sp, F.lit(0)) + 1
        return {"season": F.slice(both, start, F.lit(self.sp))}

    def rolling(self, tsf, fh, window):
        placed = positions(tsf, "pos", "n")
        back = {h: self.sp * -(-h // self.sp) for h in fh}
        return lagged(placed, {f"yhat_{h}": (tsf.target, back[h]) for h in fh})

    def rolling_normal(self, tsf, fh, window):
        if window:
            return None

        def made(s, h):
            return {"sigma": sigma(s["dd"], s["known"] - self.sp, F.lit(float((h - 1) // self.sp + 1)))}

        spreads = ahead(_running_errors(tsf, self.sp), fh, _ERRORS, made)
        back = {h: self.sp * -(-h // self.sp) for h in fh}
        return lagged(spreads, {f"yhat_{h}": (tsf.target, back[h]) for h in fh})


class NaiveMean(Forecaster):
    """Mean of all values, or of the last `window_length`, by season slot when sp > 1.

    The slot of a row is counted from the end, so that step h reads slot (h-1) mod sp.
    """

    def __init__(self, sp: int = 1, window_length: int | None = None):
        if sp < 1 or (window_length is not None and window_length < 1):
            raise ValueError("sp and window_length must be positive")
        self.sp, self.window_length = sp, window_length

    def fit(self, tsf, residuals=False):
        if residuals and (self.sp > 1 or self.window_length):
            raise ValueError("Intervals exist for the plain mean only")
        known = tsf.with_df(tsf.df.where(tsf.y.isNotNull()))
        if self.window_length:
            known = tsf.with_df(head_rows(known, self.window_length, last=True, rank="__rn"))
        elif self.sp > 1:
            placed = positions(known, "__pos", "__size").df
            known = tsf.with_df(placed.withColumn("__rn", F.col("__size") - F.col("__pos")))
        if self.sp == 1:
            return super(NaiveMean, self).fit(known, residuals)
        slot = F.pmod(-F.col("__rn"), F.lit(self.sp)).cast("int")
        by_slot = known.df.groupBy(*tsf.keys, slot.alias("slot")).agg(
            F.sum(tsf.y).alias("s"), F.count(tsf.y).alias("c"), F.max(tsf.time).alias("t")
        )
        params = by_slot.groupBy(*tsf.keys).agg(
            F.max("t").alias("cutoff"),
            F.sum("c").alias("n"),
            F.map_from_entries(F.collect_list(F.struct("slot", F.struct("s", "c")))).alias("slots"),
        )
        params = params.withColumn("step", tsf.step.columns())
        return params.select(*tsf.keys, "cutoff", "step", "n", "slots")

    def aggregates(self, tsf):
        return {"total": F.sum(tsf.y)}

    def sse(self, tsf):
        return F.var_pop(tsf.y) * F.count(tsf.y)

    def point(self):
        if self.sp == 1:
            return F.col("total") / F.col("n")
        slot = F.element_at("slots", (F.col("h") - 1) % self.sp)
        return slot["s"] / slot["c"]

    def spread(self):
        return 1 + 1 / F.col("n")

    def merged(self):
        if self.sp > 1 or self.window_length:
            raise NotImplementedError("Only the plain mean can be updated")
        return {"total": F.col("o.total") + F.col("m.total")}

    def rolling(self, tsf, fh, window):
        if self.sp > 1:
            return None
        length = min([w for w in (self.window_length, window) if w], default=None)
        placed = positions(tsf, "pos", "n")
        if length:
            return nearby(
                placed, length + max(fh) - 1, 0,
                lambda w: {
                    f"yhat_{h}": F.avg(tsf.target).over(w.rowsBetween(-length - h + 1, -h)) for h in fh
                },
            )
        sums = running(placed, {"__s": ("sum", tsf.y), "__c": ("count", tsf.y)})
        mean = F.col("__s") / F.nullif(F.col("__c"), F.lit(0))
        out = lagged(sums, {f"yhat_{h}": (mean, h) for h in fh})
        return out.with_df(out.df.drop("__s", "__c"))


    def rolling_normal(self, tsf, fh, window):
        if window or self.sp > 1 or self.window_length:
            return None

        def made(s, h):
            n = F.nullif(s["known"], F.lit(0))
            sse = F.greatest(s["uu"] - s["u"] * s["u"] / n, F.lit(0.0))
            return {"yhat": s["first"] + s["u"] / n, "sigma": sigma(sse, s["known"] - 1, 1 + 1 / n)}

        return ahead(_running_errors(tsf, 1), fh, _ERRORS, made)


class Drift(Forecaster):
    """Line through the first and the last value."""

    def rows(self, tsf, residuals):
        return _lagged_rows(tsf, 1) if residuals else tsf.df

    def aggregates(self, tsf):
        return {
            "first_ts": F.min(tsf.time),
            "first": F.min_by(tsf.y, tsf.ts),
            "last": F.max_by(tsf.y, tsf.ts),
        }

    def sse(self, tsf):
        # Errors are d - slope, and the d sum up to last - first.
        d = tsf.y - F.col("__lag")
        return F.sum(d * d) - F.sum(d) * F.sum(d) / F.nullif(F.count(d), F.lit(0))

    def dof(self, n):
        return n - 2

    def slope(self):
        return (F.col("last") - F.col("first")) / F.nullif(F.col("n") - 1, F.lit(0))

    def point(self):
        return F.col("last") + F.col("h") * self.slope()

    def spread(self):
        h = F.col("h").cast("double")
        return h * (1 + h / F.nullif(F.col("n") - 1, F.lit(0)))

    def merged(self):
        newer = F.col("m.cutoff") >= F.col("o.cutoff")
        older = F.col("m.first_ts") < F.col("o.first_ts")
        return {
            "first_ts": F.least("o.first_ts", "m.first_ts"),
            "first": F.when(older, F.col("m.first")).otherwise(F.col("o.first")),
            "last": F.when(newer, F.col("m.last")).otherwise(F.col("o.last")),
        }

    def rolling(self, tsf, fh, window):
        if window:
            return None
        start = running(
            positions(tsf, "pos", "n"), {"__at0": ("min", F.when(F.col("pos") == 0, tsf.y))}
        )
        out = lagged(start, {f"__lag{h}": (tsf.target, h) for h in fh})
        cols = {}
        for h in fh:
            slope = (F.col(f"__lag{h}") - F.col("__at0")) / F.nullif(F.col("pos") - h, F.lit(0))
            cols[f"yhat_{h}"] = F.col(f"__lag{h}") + h * slope
        return out.with_df(out.df.withColumns(cols).drop("__at0", *[f"__lag{h}" for h in fh]))

    def rolling_normal(self, tsf, fh, window):
        if window:
            return None

        def made(s, h):
            steps = F.nullif(s["known"] - 1, F.lit(0))
            sse = F.greatest(s["dd"] - s["d"] * s["d"] / F.nullif(s["pairs"], F.lit(0)), F.lit(0.0))
            yhat = s["last"] + h * ((s["last"] - s["first"]) / steps)
            return {"yhat": yhat, "sigma": sigma(sse, s["known"] - 2, h * (1 + h / steps))}

        return ahead(_running_errors(tsf, 1), fh, _ERRORS, made)
