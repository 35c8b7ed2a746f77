"""Small panels and comparisons for the tests."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

from chronoloom.frame import with_roles


def monthly(spark, values, start=(2020, 1), key="a", freq="MS", **roles):
    y, m = start
    rows = []
    for i, v in enumerate(values):
        k = y * 12 + m - 1 + i
        rows.append((key, datetime(k // 12, k % 12 + 1, 1), None if v is None else float(v)))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double")
    return with_roles(df, ["k"], "ts", "y", freq=freq, **roles)


def airline(spark):
    """Public Box-Jenkins series, thousands of passengers per month, 1949 to 1960."""
    text = """112 118 132 129 121 135 148 148 136 119 104 118 115 126 141 135 125 149 170 170 158 133 114 140
    145 150 178 163 172 178 199 199 184 162 146 166 171 180 193 181 183 218 230 242 209 191 172 194
    196 196 236 235 229 243 264 272 237 211 180 201 204 188 235 227 234 264 302 293 259 229 203 229
    242 233 267 269 270 315 364 347 312 274 237 278 284 277 317 313 318 374 413 405 355 306 271 306
    315 301 356 348 355 422 465 467 404 347 305 336 340 318 362 348 363 435 491 505 404 359 310 337
    360 342 406 396 420 472 548 559 463 407 362 405 417 391 419 461 472 535 622 606 508 461 390 432"""
    return monthly(spark, [int(v) for v in text.split()], start=(1949, 1), key="airline")


def daily_panel(spark, max_rows, seed=3, holes=True, nulls=True, freq="D"):
    """One long and two short series with holes, NULLs and an exogenous column."""
    rng, rows = random.Random(seed), []
    for key, length in (("long", 90), ("mid", 25), ("one", 1)):
        for i in range(length):
            if holes and 0 < i < length - 1 and rng.random() < 0.15:
                continue
            y = None if nulls and rng.random() < 0.1 else float(rng.randint(20, 400))
            rows.append((key, datetime(2024, 1, 1) + timedelta(days=i), y, float(i % 5)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, y double, x double")
    return with_roles(df, ["k"], "ts", "y", freq=freq, max_rows=max_rows)


def collected(df, digits=7):
    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else float(f"{v:.{digits}g}")
        if isinstance(v, (list, tuple)):
            return tuple(cell(x) for x in v)
        if isinstance(v, dict):
            return tuple(sorted((k, cell(x)) for k, x in v.items()))
        return v

    names = sorted(df.columns)
    rows = [tuple(repr(cell(r[c])) for c in names) for r in df.collect()]
    return names, sorted(rows)
