"""States of simple models at every row of a series, for cross-validation in one pass.

Simple smoothing is an affine map of the level for each row, with the squared errors as a
quadratic form of the level before it. The map of a chunk is made in blocks of about the square
root of its rows, all blocks in step; chunks are composed in order; then each chunk is walked once
more from its true level. Autoregressions and residual variances need running sums only.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from chronoloom.frame import TimeSeriesFrame
from chronoloom.functions.ordered import CHUNK, chunked, filled, lagged, null_safe_join, positions, running


def _blocks(y: np.ndarray) -> np.ndarray:
    """The values in rows of about the square root of their number; NaN stands for no value."""
    m = max(1, int(np.ceil(np.sqrt(len(y)))))
    out = np.full(-(-max(1, len(y)) // m) * m, np.nan)
    out[: len(y)] = y
    return out.reshape(-1, m)


def level_maps(y: np.ndarray, alphas: np.ndarray) -> np.ndarray:
    """(a, b, s0, s1, s2) by block and alpha: level_out = a * level_in + b, and the squared errors
    s0 - 2 s1 level_in + s2 level_in^2 of the block."""
    rows = _blocks(y)
    shape = (len(rows), len(alphas))
    a, b, s0, s1, s2 = np.ones(shape), np.zeros(shape), np.zeros(shape), np.zeros(shape), np.zeros(shape)
    for column in rows.T:
        value = column[:, None]
        known = ~np.isnan(value)
        rest = np.where(known, value - b, 0.0)
        grown = np.where(known, a, 0.0)
        s0 += rest * rest
        s1 += rest * grown
        s2 += grown * grown
        b = b + alphas * rest
        a = a - alphas * grown
    return np.stack([a, b, s0, s1, s2])


def compose(maps: np.ndarray) -> np.ndarray:
    """One map for all blocks in order."""
    a, b, s0, s1, s2 = np.ones_like(maps[0, 0]), *np.zeros((4, maps.shape[2]))
    for i in range(maps.shape[1]):
        a2, b2, t0, t1, t2 = maps[:, i]
        s0, s1, s2 = s0 + t0 - 2 * t1 * b + t2 * b * b, s1 + t1 * a - t2 * a * b, s2 + t2 * a * a
        a, b = a2 * a, a2 * b + b2
    return np.stack([a, b, s0, s1, s2])


def walk_levels(y: np.ndarray, alphas: np.ndarray, level: np.ndarray, sse: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level and sum of squared errors after each row, by alpha, from those before the first."""
    maps, rows = level_maps(y, alphas), _blocks(y)
    levels, errors = np.empty((2, *rows.shape, len(alphas)))
    now, total = np.empty((2, len(rows), len(alphas)))
    for i in range(len(rows)):  # what each block starts from
        now[i], total[i] = level, sse
        a, b, s0, s1, s2 = maps[:, i]
        level, sse = a * level + b, sse + s0 - 2 * s1 * level + s2 * level * level
    for j, column in enumerate(rows.T):
        rest = np.where(np.isnan(column)[:, None], 0.0, column[:, None] - now)
        total = total + rest * rest
        now = now + alphas * rest
        levels[:, j], errors[:, j] = now, total
    flat = lambda x: x.reshape(-1, len(alphas))[: len(y)]
    return flat(levels), flat(errors)


_STATE = "level double, alpha double, sse double, known bigint"


def smoothed(tsf: TimeSeriesFrame, grid: Iterable[float], prefix: str = "__") -> TimeSeriesFrame:
    """Adds level, alpha, sse and number of values as of each row, at the alpha with the least sse.

    They equal a fit on the rows up to this one; before the first value they are NULL.
    """
    alphas = np.array(sorted(grid))
    placed = positions(tsf, f"{prefix}spot", None)
    value, keys = tsf.y.cast("double"), list(tsf.keys)
    first = placed.df.where(value.isNotNull()).groupBy(*keys).agg(F.min_by(value, f"{prefix}spot").alias("first"))
    rows = chunked(placed).select(*keys, CHUNK, f"{prefix}spot", value.alias("y"))
    rows = null_safe_join(rows, first, keys, "left")  # without a value at all there is no state
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    at = [*keys, CHUNK]
    names = ", ".join(f"`{c}` {kinds[c]}" for c in at)

    def of_chunk(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(f"{prefix}spot")
        y = part["y"].to_numpy(float) - float(part["first"].iloc[0])
        whole = compose(level_maps(y, alphas))
        return part.iloc[:1][at].assign(n=int((~np.isnan(y)).sum()), map=[whole.ravel().tolist()])

    def carried(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(CHUNK)
        level, sse, seen, out = np.zeros(len(alphas)), np.zeros(len(alphas)), 0, []
        for n, flat in zip(part["n"], part["map"]):
            out.append((level.tolist(), sse.tolist(), seen))
            a, b, s0, s1, s2 = np.array(flat).reshape(5, -1)
            level, sse, seen = a * level + b, sse + s0 - 2 * s1 * level + s2 * level * level, seen + n
        return part[at].assign(level=[x for x, _, _ in out], sse=[x for _, x, _ in out], seen=[x for _, _, x in out])

    def states(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(f"{prefix}spot")
        base = float(part["first"].iloc[0])
        y = part["y"].to_numpy(float) - base
        zero = [0.0] * len(alphas)
        start = part.iloc[0]
        levels, errors = walk_levels(
            y, alphas, np.array(start["level"] if "level" in part else zero), np.array(start["sse"] if "sse" in part else zero)
        )
        best = errors.argmin(axis=1)
        at_row = np.arange(len(y))
        known = np.cumsum(~np.isnan(y)) + (int(start["seen"]) if "seen" in part else 0)
        out = part[[*keys, f"{prefix}spot"]].assign(
            level=levels[at_row, best] + base, alpha=alphas[best], sse=np.maximum(errors[at_row, best], 0.0), known=known
        )
        return out[out["known"] > 0]

    full = rows.where(F.col("first").isNotNull())
    if tsf.width:
        summary = full.groupBy(*at).applyInPandas(of_chunk, f"{names}, n bigint, map array<double>")
        carry = summary.groupBy(*keys).applyInPandas(
            carried, f"{names}, level array<double>, sse array<double>, seen bigint"
        )
        full = null_safe_join(full, carry, at)
    key_names = ", ".join(f"`{c}` {kinds[c]}" for c in keys)
    found = full.groupBy(*at).applyInPandas(states, f"{key_names}, `{prefix}spot` bigint, {_STATE}")
    found = found.select(*keys, f"{prefix}spot", *[F.col(c).alias(f"{prefix}{c}") for c in ("level", "alpha", "sse", "known")])
    return tsf.with_df(null_safe_join(placed.df, found, [*keys, f"{prefix}spot"], "left").drop(f"{prefix}spot"))


def autoregressed(tsf: TimeSeriesFrame, prefix: str = "__") -> TimeSeriesFrame:
    """Adds phi, a, last, sse and number of values as of each row, from running lag moments.

    Values count from the first one, so that the moments of series far from zero do not cancel.
    """
    place, held, back, base = (f"{prefix}{c}" for c in ("spot", "held", "back", "base"))
    start = positions(tsf, place, None)
    start = start.with_df(start.df.withColumn(held, tsf.y.cast("double")))
    start = lagged(filled(start, [held], forward=True, backward=False), {back: (held, 1)})
    start = running(start, {base: ("min", F.when(F.col(place) == 0, F.coalesce(tsf.y.cast("double"), F.lit(0.0))))})
    u = F.when(tsf.y.isNotNull() & F.col(back).isNotNull(), tsf.y - F.col(base))
    v = F.when(u.isNotNull(), F.col(back) - F.col(base))
    sums = {"c": ("count", u), "u": ("sum", u), "v": ("sum", v), "uu": ("sum", u * u), "uv": ("sum", u * v), "vv": ("sum", v * v)}
    sums = {f"{prefix}{n}": x for n, x in sums.items()} | {f"{prefix}known": ("count", tsf.y)}
    out = running(start, sums)
    c, su, sv, suu, suv, svv = (F.col(f"{prefix}{n}") for n in ("c", "u", "v", "uu", "uv", "vv"))
    none = F.lit(0.0)
    cross, spread = suv - su * sv / F.nullif(c, F.lit(0)), svv - sv * sv / F.nullif(c, F.lit(0))
    phi = cross / F.nullif(spread, none)
    sse = suu - su * su / F.nullif(c, F.lit(0)) - cross * cross / F.nullif(spread, none)
    df = out.df.withColumns(
        {
            f"{prefix}phi": phi,
            f"{prefix}a": F.col(base) + su / F.nullif(c, F.lit(0)) - phi * (F.col(base) + sv / F.nullif(c, F.lit(0))),
            f"{prefix}last": F.col(held),
            f"{prefix}sse": F.greatest(sse, none),
        }
    )
    return out.with_df(df.drop(place, held, back, base, *[f"{prefix}{n}" for n in ("c", "u", "v", "uu", "uv", "vv")]))


def ahead(tsf: TimeSeriesFrame, fh: Iterable[int], state: dict[str, str], forecasts) -> TimeSeriesFrame:
    """Adds pos, n and for each h what `forecasts(h)` makes of the state h rows earlier.

    `state` maps names to columns; while `forecasts` runs, these names are columns, as is `h`.
    """
    placed = positions(tsf, "pos", "n")
    packed = F.struct(*[F.col(c).alias(name) for name, c in state.items()])
    back = lagged(placed, {f"__state{h}": (packed, h) for h in fh})
    made: dict[str, Column] = {}
    for h in fh:
        get = {name: F.col(f"__state{h}")[name] for name in state}
        made |= {f"{name}_{h}": c for name, c in forecasts(get, h).items()}
    keep = [*tsf.df.columns, "pos", "n"]
    df = back.df.withColumns(made)
    return back.with_df(df.select(*[c for c in keep if c not in state.values()], *made))


def sigma(sse: Column, dof: Column, spread: Column) -> Column:
    return F.sqrt(sse / F.nullif(F.greatest(dof, F.lit(0)), F.lit(0)) * spread)
