"""Classification, regression and clustering of panels of equal-length series.

Instances are rows `(id, values ARRAY<DOUBLE>, label)`.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from chronoloom.frame import TimeSeriesFrame
from chronoloom.shared import cut_lineage

# Vectors that one join block holds on either side.
BLOCK_ROWS = 8_192
# Numbers that the vectors on one side of a tile hold at most (a tile has a block at least); pairs of a piece and of a product.
TILE_VALUES = 4_194_304
PIECE_VALUES = 4_000_000
PRODUCT_VALUES = 1_000_000
# Sides that a table is cut into at least, if blocks allow: of the search near home, and of the one that takes in other cells.
FIRST_SIDES, SIDES = 64, 8
PIVOTS = 64
MAX_CLASSES = 10_000
# Distances that differ by less than this count as equal; the lower id comes first.
DIGITS = 9


def instances(df: DataFrame, id_col: str, values: str, label: str | None = None) -> DataFrame:
    cols = [F.col(id_col).alias("id"), F.col(values).cast("array<double>").alias("values")]
    return df.select(*cols, *([F.col(label).alias("label")] if label else []))


def from_series(tsf: TimeSeriesFrame, labels: DataFrame | None = None) -> DataFrame:
    """Instances from long rows with one key; `labels` has `(key, label)`."""
    if len(tsf.keys) != 1 or tsf.width:
        raise ValueError("Instances need one key and series that fit one task")
    key = tsf.keys[0]
    points = F.array_sort(F.collect_list(F.struct(tsf.ts.alias("t"), tsf.y.alias("y"))))
    out = tsf.df.groupBy(F.col(key).alias("id")).agg(
        F.transform(points, lambda p: p["y"]).alias("values")
    )
    if labels is not None:
        out = out.join(labels.select(F.col(key).alias("id"), "label"), "id")
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact Euclidean distances in bounded pieces."""
    out = np.empty((len(a), len(b)))
    piece = max(1, 4_000_000 // max(1, b.size))
    for i in range(0, len(a), piece):
        off = a[i : i + piece, None, :] - b[None, :, :]
        out[i : i + piece] = np.sqrt(np.einsum("ijk,ijk->ij", off, off))
    return out


@dataclass(frozen=True)
class PivotIndex:
    """Training rows by their nearest pivot, packed in blocks of bounded size.

    `blocks` has `(cell, part, names, points, tags)`, at most about `block_rows` rows each; `cells`
    has `(cell, n, parts, radius)` for the cells with rows, no more of them than pivots.
    """

    blocks: DataFrame
    pivots: np.ndarray
    cells: tuple[tuple[int, int, int, float], ...]
    id_type: str
    label_type: str | None

    def save(self, path: str) -> None:
        """Writes the index as two Parquet folders; both must not exist yet."""
        self.blocks.write.parquet(f"{path}/blocks")
        rows = [(int(c), self.pivots[c].tolist(), n, parts, r) for c, n, parts, r in self.cells]
        spare = set(range(len(self.pivots))) - {c for c, *_ in self.cells}
        rows += [(c, self.pivots[c].tolist(), 0, 0, 0.0) for c in sorted(spare)]
        spark = self.blocks.sparkSession
        spark.createDataFrame(rows, _CELLS).coalesce(1).write.parquet(f"{path}/cells")


_CELLS = "cell int, pivot array<double>, n bigint, parts int, radius double"


def load_index(spark: SparkSession, path: str) -> PivotIndex:
    blocks = spark.read.parquet(f"{path}/blocks")
    rows = sorted(spark.read.parquet(f"{path}/cells").collect())
    kind = lambda c: blocks.schema[c].dataType.elementType.simpleString()
    return PivotIndex(
        blocks, np.array([r.pivot for r in rows], float), tuple((r.cell, r.n, r.parts, r.radius) for r in rows if r.n),
        kind("names"), kind("tags") if "tags" in blocks.columns else None,
    )


def _homes(pivots: np.ndarray):
    @F.pandas_udf("struct<cell:int,away:double>")
    def home(values: pd.Series) -> pd.DataFrame:
        d = _distances(np.stack(values.to_numpy()), pivots)
        return pd.DataFrame({"cell": d.argmin(1).astype("int32"), "away": d.min(1)})

    return home


def pivot_index(train: DataFrame, pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> PivotIndex:
    """Index of training rows `(id, values, label)`; rows with equal ids are all kept."""
    chosen = train.select("values").orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    if not chosen:
        raise ValueError("The training table is empty")
    points = np.array([r[0] for r in chosen], float)
    labelled = "label" in train.columns
    housed = train.withColumn("p", _homes(points)("values")).select("*", "p.*")
    stats = housed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect()
    cells = tuple(sorted((s["cell"], s["n"], -(-s["n"] // block_rows), s["r"]) for s in stats))
    parts = F.create_map(*[F.lit(v) for c, _, n, _ in cells for v in (c, n)])
    # Dealt by id and values, so that many rows of one id do not crowd a block.
    part = F.pmod(F.xxhash64("id", "values"), parts[F.col("cell")]).cast("int")
    row = F.struct(F.col("id").alias("name"), F.col("values").alias("point"), *([F.col("label").alias("tag")] if labelled else []))
    packed = housed.groupBy("cell", part.alias("part")).agg(F.collect_list(row).alias("rows"))
    columns = {"names": "name", "points": "point", **({"tags": "tag"} if labelled else {})}
    blocks = packed.select("cell", "part", *[F.col(f"rows.{c}").alias(name) for name, c in columns.items()])
    kind = lambda c: train.schema[c].dataType.simpleString()
    return PivotIndex(cut_lineage(blocks), points, cells, kind("id"), kind("label") if labelled else None)


class _Tile:
    """The k nearest of each query of one tile among training rows that stream past, cell by cell.

    A matrix product tells which rows can be near enough, with a margin over its rounding error;
    the exact distance decides among those. Rows of a cell must come in order of their names.
    """

    def __init__(self, k: int, labelled: bool):
        self.k, self.labelled = k, labelled
        self.asked: list[pa.RecordBatch] = []
        self.types: tuple = ()
        self.held: dict = {}

    def ask(self, part: pa.RecordBatch) -> None:
        self.asked.append(part)

    def _settle(self, part: pa.RecordBatch) -> None:
        t = pa.Table.from_batches(self.asked).combine_chunks().to_batches()[0]
        self.asked = []
        self.types = tuple(part.schema.field(c).type for c in ("id", "name") + ("tag",) * self.labelled)
        self.ids = t.column("id").to_pylist()
        self.where: dict = {}
        for i, name in enumerate(self.ids):
            self.where.setdefault(name, []).append(i)
        self.q = _matrix(t.column("values"))
        self.qq = np.einsum("ij,ij->i", self.q, self.q)
        # Products with (values, square) of a training row give its squared distance less that of the query.
        self.factor = {float: np.hstack([-2 * self.q, np.ones((len(self.q), 1))])}
        self.factor[np.float32] = self.factor[float].astype(np.float32)
        bound = t.column("bound").to_numpy(zero_copy_only=False).astype(float)
        self.bound = np.where(np.isnan(bound), np.inf, bound)
        cells = t.column("cells")
        row = np.repeat(np.arange(len(t)), cells.value_lengths().to_numpy())
        cell = cells.flatten().to_numpy()
        by = np.argsort(cell, kind="stable")
        found, first = np.unique(cell[by], return_index=True)
        self.rows_of = dict(zip(found.tolist(), np.split(row[by], first[1:])))
        self.distance = np.full((len(t), self.k), np.inf)
        self.name, self.tag = np.empty((len(t), self.k), object), np.empty((len(t), self.k), object)

    def meet(self, cell: int, part: pa.RecordBatch) -> None:
        if self.asked:
            self._settle(part)
        rows = self.rows_of.get(cell)
        if rows is None:
            return
        points = _matrix(part.column("values"))
        names, tags = _objects(part.column("name")), _objects(part.column("tag")) if self.labelled else None
        own = [(i, j) for j, name in enumerate(names) for i in self.where.get(name, ())]
        own = np.array(own, int).reshape(-1, 2)
        at = np.full(len(self.q), -1)
        at[rows] = np.arange(len(rows))
        own[:, 0] = at[own[:, 0]]
        own = own[own[:, 0] >= 0]
        own = own[np.argsort(own[:, 0], kind="stable")]
        square = np.einsum("ij,ij->i", points, points)
        full = np.hstack([points, square[:, None]])
        small = full.astype(np.float32) if self.qq.max() + square.max() < 1e30 else None
        piece = max(1, PIECE_VALUES // len(points))
        for a in range(0, len(rows), piece):
            i, j = np.searchsorted(own[:, 0], (a, a + piece))
            self._piece(rows[a : a + piece], points, full, small, square.max(), own[i:j] - (a, 0), names, tags)

    def _piece(self, rows, points, full, small, most, own, names, tags) -> None:
        k, unit = self.k, 10.0**-DIGITS
        last = self.distance[rows, k - 1]
        limit = np.minimum(last, self.bound[rows]) + unit
        # Once k rows with lower names are as near, only nearer ones count.
        lower = np.isfinite(last) & (last <= self.bound[rows])
        if lower.any() and names[0] is not None:
            lower[lower] = [n is not None and n <= names[0] for n in self.name[rows[lower], k - 1]]
            limit[lower] = last[lower] - 0.4 * unit
        if (limit < 0).any():
            keep = limit >= 0
            to = np.cumsum(keep) - 1
            own = own[keep[own[:, 0]]]
            own = np.column_stack([to[own[:, 0]], own[:, 1]])
            rows, limit = rows[keep], limit[keep]
        if not len(rows):
            return
        found, step = [], max(1, PRODUCT_VALUES // len(points))
        for a in range(0, len(rows), step):
            x, y = np.searchsorted(own[:, 0], (a, a + step))
            hits = self._hits(rows[a : a + step], limit[a : a + step], full, small, most, own[x:y] - (a, 0))
            found.append(hits + a * len(points))
        i, j = np.divmod(np.concatenate(found), len(points))
        d = np.empty(len(i))
        step = max(1, TILE_VALUES // max(1, points.shape[1]))
        for a in range(0, len(i), step):
            off = self.q[rows[i[a : a + step]]] - points[j[a : a + step]]
            d[a : a + step] = np.round(np.sqrt(np.einsum("ij,ij->i", off, off)), DIGITS)
        ok = np.isfinite(d)
        i, j, d = rows[i[ok]], j[ok], d[ok]
        if len(i):
            by = _first(i, d, j, k)
            self._merge(i[by], d[by], names[j[by]], tags[j[by]] if self.labelled else None)

    def _hits(self, rows, limit, full, small, most, own) -> np.ndarray:
        """Places of the pairs that can be within the limit, row by row."""
        k, n, unit, qq = self.k, len(full), 10.0**-DIGITS, self.qq[rows]
        for kind, other in ((np.float32, small), (float, full)):
            if other is None:
                continue
            slack = 4 * (full.shape[1] + 8) * np.finfo(kind).eps * (qq + most)
            near = self._room(kind, len(rows), n)
            np.matmul(self.factor[kind][rows], other.T, out=near)
            near[own[:, 0], own[:, 1]] = np.inf
            reach = limit**2 - qq + slack
            free = np.isinf(limit)
            if free.any() and n >= k:
                kth = np.partition(near[free], k - 1, axis=1)[:, k - 1].astype(float)
                kth = np.sqrt(np.maximum(kth + qq[free] + slack[free], 0)) + unit
                reach[free] = kth**2 - qq[free] + slack[free]
            reach[np.isnan(reach)] = np.inf
            hit = self._room(bool, len(rows), n)
            # What is not a number stays for the exact distance.
            np.logical_not(np.greater(near, reach.astype(kind)[:, None], out=hit), out=hit)
            hit[own[:, 0], own[:, 1]] = False
            count = np.count_nonzero(hit)
            if count <= len(rows) * (k + 16) or count * 64 <= hit.size:
                break
        # Hits are rare, so eight places are looked at in one.
        flat, whole = hit.ravel(), hit.size // 8 * 8
        words = np.flatnonzero(flat[:whole].view(np.uint64))
        at = np.concatenate([(words[:, None] * 8 + np.arange(8)).ravel(), np.arange(whole, hit.size)])
        return at[flat[at]]

    def _room(self, kind, rows: int, n: int) -> np.ndarray:
        if self.held.get(kind) is None or self.held[kind].size < rows * n:
            self.held[kind] = np.empty(rows * n, kind)
        return self.held[kind][: rows * n].reshape(rows, n)

    def _merge(self, i, d, names, tags) -> None:
        some = np.unique(i)
        old = np.isfinite(self.distance[some])
        i = np.concatenate([np.repeat(some, self.k)[old.ravel()], i])
        d = np.concatenate([self.distance[some][old], d])
        names = np.concatenate([self.name[some][old], names])
        by = _first(i, d, pd.factorize(names, sort=True)[0], self.k)
        i, d, names = i[by], d[by], names[by]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        if self.labelled:
            tags = np.concatenate([self.tag[some][old], tags])[by]
            self.tag[i, rank] = tags
        self.distance[i, rank], self.name[i, rank] = d, names

    def rows(self, schema: list[str]) -> pa.RecordBatch | None:
        if not self.types:
            return None
        i, r = np.nonzero(np.isfinite(self.distance))
        id_type, name_type, *tag_type = self.types
        columns = [
            pa.array([self.ids[x] for x in i], id_type), pa.array(self.name[i, r].tolist(), name_type),
            pa.array(self.distance[i, r]), *[pa.array(self.tag[i, r].tolist(), t) for t in tag_type],
        ]
        return pa.RecordBatch.from_arrays(columns, schema)


def _first(i: np.ndarray, d: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each `i` by distance and tie, in that order."""
    by = np.lexsort((tie, d, i))
    i = i[by]
    return by[np.arange(len(i)) - np.searchsorted(i, i) < k]


def _objects(column: pa.Array) -> np.ndarray:
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    length = column.value_lengths()
    if column.null_count or (length.to_numpy() != length[0].as_py()).any():
        raise ValueError("All instances need values of one length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _slabs(index: PivotIndex, side: int) -> tuple[dict, dict, dict]:
    """By cell: its first slab, its number of slabs and how many of its blocks share one.

    A slab has about `side` training rows: several small cells, or some blocks of a large one.
    """
    first, count, per, at, held = {}, {}, {}, 0, 0
    for c, n, parts, _ in index.cells:
        per[c] = max(1, side // -(-n // parts))
        if held and held + n > side:
            at, held = at + 1, 0
        first[c], count[c] = at, -(-parts // per[c])
        held = held + n if count[c] == 1 else side
        at += count[c] - 1
    return first, count, per


def _search(asked: DataFrame, index: PivotIndex, k: int, id_type: str, side: int) -> DataFrame:
    """`(id, neighbour, distance, label)`: the k nearest in each tile of the cells that a query visits.

    Queries `(id, values, cells, bound)` and slabs of training rows, of about `side` rows each,
    meet in tiles, one task each: queries are copied once for a slab and training rows once for
    the queries of about a side, both as rows, of which a task holds its queries and streams the
    rest. The rows that move grow with the input and the number of sides.
    """
    label_type = index.label_type
    schema = f"id {id_type}, neighbour {index.id_type}, distance double" + (f", label {label_type}" if label_type else "")
    of = lambda m: F.create_map(*[F.lit(int(v)) for pair in m.items() for v in pair])
    first, count, per = _slabs(index, side)
    first_of, count_of, per_of, inside = of(first), of(count), of(per), {}
    for c in first:
        for slab in range(first[c], first[c] + count[c]):
            inside.setdefault(slab, []).append(int(c))
    slabs = F.transform("cells", lambda c: F.sequence(first_of[c], first_of[c] + count_of[c] - 1))
    asked = asked.withColumn("slab", F.explode(F.array_distinct(F.flatten(slabs))))
    sizes = {r["slab"]: r["count"] for r in asked.groupBy("slab").count().collect()}  # a row for each slab
    if not sizes:
        return asked.sparkSession.createDataFrame([], schema)
    slots = {slab: -(-sizes[slab] // side) for slab in sorted(sizes)}
    ends = np.cumsum(list(slots.values()))
    start_of, slots_of = of(dict(zip(slots, ends - list(slots.values())))), of(slots)
    here = F.create_map(*[v for s in slots for v in (F.lit(s), F.array(*[F.lit(c) for c in inside[s]]))])
    none = lambda kind: F.lit(None).cast(kind)
    labelled = {"tag": label_type} if label_type else {}
    queries = asked.select(
        (start_of[F.col("slab")] + F.pmod(F.xxhash64("id", "values"), slots_of[F.col("slab")])).cast("int").alias("tile"),
        F.lit(-1).alias("cell"), "values", none(index.id_type).alias("name"), *[none(t).alias(c) for c, t in labelled.items()],
        "id", "bound", F.array_intersect("cells", here[F.col("slab")]).alias("cells"),
    )
    row = F.arrays_zip("names", "points", *(["tags"] if label_type else []))
    slab = (first_of[F.col("cell")] + F.floor(F.col("part") / per_of[F.col("cell")])).cast("int")
    blocks = index.blocks.select("cell", slab.alias("slab"), row.alias("rows")).select(
        "cell", "rows", F.explode(F.sequence(start_of[F.col("slab")], start_of[F.col("slab")] + slots_of[F.col("slab")] - 1)).alias("tile"),
    )
    rows = blocks.select("tile", "cell", F.explode("rows").alias("r")).select(
        F.col("tile").cast("int"), "cell", F.col("r.points").alias("values"), F.col("r.names").alias("name"),
        *[F.col("r.tags").alias(c) for c in labelled], none(id_type).alias("id"), none("double").alias("bound"),
        none("array<int>").alias("cells"),
    )
    out = ["id", "neighbour", "distance", *(["label"] if label_type else [])]

    def match(batches):
        tile, now = None, None
        for batch in batches:
            tiles, cells = batch.column("tile").to_numpy(), batch.column("cell").to_numpy()
            cuts = np.flatnonzero((np.diff(tiles) != 0) | (np.diff(cells) != 0)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(tiles)]):
                part = batch.slice(i, j - i)
                if tiles[i] != tile:
                    if now is not None and (found := now.rows(out)) is not None:
                        yield found
                    tile, now = tiles[i], _Tile(k, bool(label_type))
                if cells[i] < 0:
                    now.ask(part)
                else:
                    now.meet(int(cells[i]), part)
        if now is not None and (found := now.rows(out)) is not None:
            yield found

    # Queries come first, as their cell is -1, then rows by cell and name.
    dealt = queries.unionByName(rows).repartitionById(int(ends[-1]), "tile").sortWithinPartitions("tile", "cell", "name")
    return dealt.mapInArrow(match, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("id").orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    queries: DataFrame, train: DataFrame | PivotIndex, k: int = 1, block_rows: int = BLOCK_ROWS, pivots: int = PIVOTS
) -> DataFrame:
    """`(id, rank, neighbour, distance)`: k nearest training rows by Euclidean distance,
    with the `label` of the neighbour when the training table has one.

    Training rows with the query's id are skipped, which makes a table against itself
    leave-one-out; query ids must differ. Exact at any size and without a cross join:

    1. Training rows are filed by the nearest of a fixed number of pivots (`pivot_index`, which
       can be saved and searched again). Row counts and radii by pivot are all that reaches the driver.
    2. Each query first searches the cells of its nearest pivots, as many as surely hold k
       others. That gives a tight k-th distance.
    3. By the triangle inequality only cells within that distance can hold a nearer row; the
       query visits those that it has not seen yet.

    Where distances hardly differ, as between random vectors of many dimensions, no cell can be
    ruled out and all pairs are compared, in tiles by matrix products.
    """
    if k < 1:
        raise ValueError("k must be positive")
    index = train if isinstance(train, PivotIndex) else pivot_index(train, pivots, block_rows)
    cells, sizes, _, radii = (np.array(x) for x in zip(*index.cells))
    centres = index.pivots[cells]
    # One more than k, since a query may meet itself.
    need = min(k + 1, int(sizes.sum()))
    id_type = queries.schema["id"].dataType.simpleString()

    @F.pandas_udf("array<int>")
    def start(values: pd.Series) -> pd.Series:
        d = _distances(np.stack(values.to_numpy()), centres)
        order = np.argsort(d, axis=1, kind="stable")
        enough = (np.cumsum(sizes[order], axis=1) >= need).argmax(1)
        return pd.Series([cells[row[: n + 1]].astype("int32") for row, n in zip(order, enough)])

    @F.pandas_udf("array<int>")
    def within(values: pd.Series, bound: pd.Series) -> pd.Series:
        d = _distances(np.stack(values.to_numpy()), centres) - radii
        # A little slack, so that rounding never rules a cell out; without a bound all cells count.
        reach = bound.to_numpy(float)[:, None]
        near = (d <= reach * (1 + 1e-9) + 10.0**-DIGITS) | np.isnan(reach)
        return pd.Series([cells[row].astype("int32") for row in near])

    total, most = int(sizes.sum()), max(block_rows, TILE_VALUES // max(1, centres.shape[1]))

    def side(parts: int) -> int:
        return max(block_rows, min(most, -(-total // parts)))

    asked = queries.select("id", "values", start("values").alias("seen"))
    blind = asked.select("id", "values", F.col("seen").alias("cells"), F.lit(None).cast("double").alias("bound"))
    first = _best(_search(blind, index, k, id_type, side(FIRST_SIDES)), k)
    first = cut_lineage(first.drop("rank"))
    bounds = first.groupBy("id").agg(F.max("distance").alias("far"), F.count(F.lit(1)).alias("found"))
    bounds = bounds.select("id", F.when(F.col("found") >= k, F.col("far")).alias("bound"))
    # A merge join, as the bounds of all queries are no table to broadcast.
    more = asked.join(bounds.hint("merge"), "id", "left")
    more = more.select("id", "values", "bound", F.array_except(within("values", "bound"), "seen").alias("cells"))
    second = _search(more, index, k, id_type, side(SIDES))
    labelled = ["label"] if index.label_type else []
    return _best(first.unionByName(second), k).select("id", "rank", "neighbour", "distance", *labelled)


def knn_classify(queries: DataFrame, train: DataFrame, k: int = 1) -> DataFrame:
    """`(id, predicted)`: majority label of the k nearest, lowest label on ties."""
    votes = nearest(queries, train, k).groupBy("id", "label").agg(
        F.count(F.lit(1)).alias("votes")
    )
    best = votes.groupBy("id").agg(F.min(F.struct(-F.col("votes"), F.col("label"))).alias("b"))
    return best.select("id", F.col("b.label").alias("predicted"))


def class_labels(train: DataFrame) -> list:
    found = [r[0] for r in train.select("label").distinct().limit(MAX_CLASSES + 1).collect()]
    if len(found) > MAX_CLASSES:
        raise ValueError(f"More than {MAX_CLASSES} classes; is the label a number to regress?")
    return sorted(v for v in found if v is not None)


def knn_proba(queries: DataFrame, train: DataFrame, k: int = 5) -> DataFrame:
    """`(id, label, probability)`: vote share, one row per instance and class."""
    classes = train.agg(F.sort_array(F.collect_set("label")).alias("options"))
    votes = nearest(queries, train, k).groupBy("id").agg(
        F.collect_list("label").alias("labels")
    )
    share = F.size(F.filter("labels", lambda v: v == F.col("label"))) / F.size("labels")
    listed = votes.select("id", "labels", F.explode(classes.scalar()).alias("label"))
    return listed.select("id", "label", share.alias("probability"))


def knn_regress(queries: DataFrame, train: DataFrame, k: int = 5) -> DataFrame:
    """`(id, predicted)`: mean target of the k nearest."""
    return nearest(queries, train, k).groupBy("id").agg(
        F.avg(F.col("label").cast("double")).alias("predicted")
    )


def mean_regress(queries: DataFrame, train: DataFrame) -> DataFrame:
    """The mean of the training target for every instance."""
    mean = train.agg(F.avg(F.col("label").cast("double")).alias("predicted"))
    return queries.select("id", mean.scalar().alias("predicted"))


def interval_features(df: DataFrame, n_intervals: int = 8, seed: int = 0, length: int | None = None) -> DataFrame:
    """Adds `features`: mean, std and slope over random intervals of the series."""
    if length is None:
        length = df.select(F.size("values").alias("n")).first()["n"]
    rng = random.Random(seed)
    spans = []
    for _ in range(n_intervals):
        size = rng.randint(min(3, length), length)
        start = rng.randint(0, length - size)
        spans.append((start, start + size))

    @F.pandas_udf("array<double>")
    def make(values: pd.Series) -> pd.Series:
        v = np.stack(values.to_numpy()).astype(float)
        out = []
        for a, b in spans:
            part, x = v[:, a:b], np.arange(b - a) - (b - a - 1) / 2
            out += [part.mean(1), part.std(1), part @ x / max((x * x).sum(), 1e-12)]
        return pd.Series(list(np.stack(out, 1)))

    return df.withColumn("features", make("values"))


def forest_classify(queries: DataFrame, train: DataFrame, trees: int = 50, seed: int = 0) -> DataFrame:
    """`(id, label, probability)` from a random forest over interval features."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    classes = class_labels(train)
    code = F.create_map(*[F.lit(v) for i, c in enumerate(classes) for v in (c, float(i))])
    length = train.select(F.size("values").alias("n")).first()["n"]
    data = interval_features(train, seed=seed, length=length).select(
        array_to_vector("features").alias("x"), code[F.col("label")].alias("c")
    )
    model = RandomForestClassifier(
        featuresCol="x", labelCol="c", numTrees=trees, maxDepth=8, seed=seed
    ).fit(data)
    asked = interval_features(queries, seed=seed, length=length).select(
        "id", array_to_vector("features").alias("x")
    )
    probability = vector_to_array(F.col("probability"))
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("label"), F.get(probability, F.lit(i)).alias("probability"))
            for i, c in enumerate(classes)
        ]
    )
    return model.transform(asked).select("id", F.explode(rows).alias("r")).select("id", "r.*")


def forest_regress(queries: DataFrame, train: DataFrame, trees: int = 30, seed: int = 0) -> DataFrame:
    """`(id, predicted)` from a random forest over interval features."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import RandomForestRegressor

    length = train.select(F.size("values").alias("n")).first()["n"]
    data = interval_features(train, seed=seed, length=length).select(
        array_to_vector("features").alias("x"), F.col("label").cast("double").alias("c")
    )
    model = RandomForestRegressor(
        featuresCol="x", labelCol="c", numTrees=trees, maxDepth=8, seed=seed
    ).fit(data)
    asked = interval_features(queries, seed=seed, length=length).select(
        "id", array_to_vector("features").alias("x")
    )
    return model.transform(asked).select("id", F.col("prediction").alias("predicted"))


def cluster(df: DataFrame, k: int = 8, seed: int = 0) -> DataFrame:
    """`(id, cluster)` by k-means on the raw values."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = df.select("id", array_to_vector("values").alias("x"))
    model = KMeans(featuresCol="x", k=k, seed=seed).fit(data)
    return model.transform(data).select("id", F.col("prediction").alias("cluster"))
