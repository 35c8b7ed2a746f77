"""Language identification by multinomial naive Bayes over hashed character n-grams.

Runs of one to `order` characters of the lower-case text, with everything that is no letter as one
space, are hashed to `buckets` columns. Spark counts them by language over the training rows; the
matrix of log-probabilities, languages by buckets, is broadcast. A batch of texts is scored as a
sparse product in numpy: each text's hashed runs pick their columns, which are added up by text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.text import sampled

_NO_LETTER = regex.compile(r"\P{L}+")
ORDER, BUCKETS = 3, 1 << 15
PART = 1_000_000
UNKNOWN = "und"


def hashed_runs(texts: list[str | None], order: int, buckets: int):
    """For each order the bucket of every run and the first run of each text; whether it has a letter."""
    plain = [_NO_LETTER.sub(" ", (t or "").lower()).strip() for t in texts]
    raw = [f" {p} " if p else "" for p in plain]
    sizes = np.array([len(r) for r in raw], np.int64)
    buf = np.frombuffer("".join(raw).encode("utf-32-le"), "<u4").astype(np.uint32)
    ends = np.cumsum(sizes)
    out, value = [], np.zeros(len(buf), np.uint32)
    for k in range(1, order + 1):
        value = value[: max(0, len(buf) - k + 1)] * np.uint32(0x01000193) + buf[k - 1 :] if k > 1 else buf
        h = (value + np.uint32(k)) * np.uint32(0x9E3779B1)
        # Runs over the border of two texts belong to none: they get the last bucket, weight 0.
        column = ((h >> np.uint32(7)) % np.uint32(buckets)).astype(np.int32)
        for j in range(1, k):
            at = ends - j
            column[at[(at >= 0) & (at < len(column))]] = buckets
        out.append(column)
        value = value.astype(np.uint32)
    return out, ends, sizes > 0


def _counts(order: int, buckets: int):
    def fn(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                mine = [t for t, x in zip(texts, langs) if x == lang]
                total = totals.setdefault(lang, np.zeros(buckets + 1, np.int64))
                for t in mine:
                    for column in hashed_runs([t], order, buckets)[0]:
                        total += np.bincount(column, minlength=buckets + 1)
        for lang, total in totals.items():
            at = np.flatnonzero(total[:buckets])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    return fn


class Model:
    """Languages, log-priors, and log-probabilities with a column of zeros at the end."""

    def __init__(self, langs: list[str], prior: np.ndarray, counts: np.ndarray, order: int):
        self.langs, self.order, self.buckets = langs, order, counts.shape[1]
        self.prior = np.log(prior / prior.sum()) if len(langs) else prior
        smooth = counts + 0.5
        logp = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        self.logp = np.hstack([logp, np.zeros((len(langs), 1))]).astype(np.float32)

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        a = 0
        while a < len(texts):
            b, size = a, 0
            while b < len(texts) and (b == a or size < PART):
                size += len(texts[b] or "")
                b += 1
            out += self._part(texts[a:b])
            a = b
        return out

    def _part(self, texts):
        columns, ends, some = hashed_runs(texts, self.order, self.buckets)
        if not len(self.langs) or not some.any():
            return [(UNKNOWN, 0.0)] * len(texts)
        total = np.repeat(self.prior[:, None], len(texts), axis=1)
        for i, row in enumerate(self.logp):
            for column in columns:
                sums = np.concatenate(([0.0], np.cumsum(row[column], dtype=np.float64)))
                cut = np.concatenate(([0], np.minimum(ends, len(column))))
                total[i] += sums[cut[1:]] - sums[cut[:-1]]
        best = total.argmax(axis=0)
        share = 1 / np.exp(np.maximum(total - total.max(axis=0), -700)).sum(axis=0)
        return [(self.langs[x], float(s)) if ok else (UNKNOWN, 0.0) for x, s, ok in zip(best, share, some)]


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_train: int, order: int, buckets: int) -> Model:
    """Model from about `max_train` labelled rows outside the held-out fold, whole texts."""
    use = docs.filter((F.crc32(F.col(id_col).cast("string")) % 4 != 2) & F.col(lang_col).isNotNull())
    n = use.filter(F.col(text_col).isNotNull()).count()
    use = use.filter(sampled(n, max_train, id_col, text_col))
    use = use.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()
    rows = use.mapInArrow(_counts(order, buckets), "lang string, bucket int, n bigint")
    cells = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()  # languages x buckets at most
    priors = {r.lang: r["count"] for r in use.groupBy("lang").count().collect()}
    langs = sorted(priors)
    if n and not langs:
        raise ValueError(f"None of {n} labelled rows was taken to learn from")
    counts = np.zeros((len(langs), buckets))
    where = {x: i for i, x in enumerate(langs)}
    for r in cells:
        counts[where[r.lang], r.bucket] = r.n
    return Model(langs, np.array([priors[x] for x in langs], float), counts, order)


def _predict(model):
    def fn(batches):
        for batch in batches:
            found = model.value.score(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["row", "lang_pred", "score"],
            )

    return fn


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_train: int = 20_000,
    order: int = ORDER,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per document held_out, lang_pred and score, the share of the predicted language.

    Learns only from rows with a language whose crc32 of the id as text is not 2 modulo 4. A null
    text, or one without a letter, is `und` with score 0, and so is every text if there is
    nothing to learn from. The prediction depends on the text alone.
    """
    model = learn(docs, id_col, text_col, lang_col, max_train, order, buckets)
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()
    packed = docs.select(F.col(text_col).alias("text"), F.struct(F.col(id_col).alias("doc_id")).alias("row"))
    found = packed.mapInArrow(_predict(broadcast), f"row struct<doc_id: {id_type}>, lang_pred string, score double")
    held = F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 4 == 2, F.lit(False))
    return found.select("row.doc_id", held.alias("held_out"), "lang_pred", "score")
