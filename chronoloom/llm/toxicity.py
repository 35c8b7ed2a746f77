"""Toxicity by a weighted finite-state grammar over clauses.

Five small transducers read the word classes of a clause: insults, threats, targets, negation and
reported speech. They are composed into one machine, whose weight for a word is the product of
theirs: an insult counts more next to a target, less under negation or in reported speech, and a
threat counts only if a target follows. A document's clauses give a few sums, and a logistic
curve turns these into its score.

Insult words are a short fixed list and those that labelled documents teach: words, and stems of
five letters, that are far likelier in toxic documents. They are counted by Spark over at most
`max_train` labelled documents, chosen by a hash of their ids, and at most `lexicon` are kept,
so that what is broadcast has a bound.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.text import sampled

# Fixed values.
INSULTS = "idiot moron stupid loser scum trash pathetic worthless disgusting clown dumb fool imbecile".split()
THREATS = "kill hurt destroy punch shoot stab strangle burn töten umbringen tuer frapper matar golpear".split()
TARGETS = "you your yours yourself du dich dir euch vous toi te usted ustedes ti vosotros".split()
NEGATIONS = "not never nobody none isn't aren't don't nicht kein keine niemals pas jamais nunca jamás".split()
REPORTS = "said says wrote called quoted claimed sagte schrieb dit écrit dijo escribió".split()
STEM, SEED_WEIGHT, THREAT_WEIGHT = 5, 3.0, 3.0
CLAUSE = re.compile(r"[.!?;:\n]+")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
CLASSES = range(6)


def transducer(states: int, moves: dict, factors: dict) -> tuple[int, list, list]:
    """moves: (state, class) to state, else one state down; factors: (state, class) to weight, else 1."""
    go = [[moves.get((s, c), max(0, s - 1)) for c in CLASSES] for s in range(states)]
    weigh = [[factors.get((s, c), 1.0) for c in CLASSES] for s in range(states)]
    return states, go, weigh


def compose(a: tuple, b: tuple) -> tuple[int, list, list]:
    """Runs both at once; weights multiply."""
    n, m = a[0], b[0]
    go = [[a[1][s][c] * m + b[1][t][c] for c in CLASSES] for s in range(n) for t in range(m)]
    weigh = [[a[2][s][c] * b[2][t][c] for c in CLASSES] for s in range(n) for t in range(m)]
    return n * m, go, weigh


def grammar() -> tuple[int, list, list]:
    again = transducer(2, {(s, c): int(s or c == INSULT) for s in (0, 1) for c in CLASSES}, {(1, INSULT): 1.25})
    near = transducer(6, {(s, TARGET): 5 for s in range(6)}, {(s, INSULT): 1.5 for s in range(1, 6)})
    threat = transducer(
        5, {(s, THREAT): 4 for s in range(5)}, {(0, TARGET): 0.0} | {(s, THREAT): 0.0 for s in range(5)}
    )
    negated = transducer(
        5, {(s, NEGATION): 4 for s in range(5)}, {(s, c): 0.3 for s in range(1, 5) for c in (INSULT, TARGET)}
    )
    told = {(s, c): int(s or c == REPORT) for s in (0, 1) for c in CLASSES}
    reported = transducer(2, told, {(1, c): 0.6 for c in (INSULT, TARGET)})
    machine = again
    for other in (near, threat, negated, reported):
        machine = compose(machine, other)
    return machine


class Scorer:
    """Features of a text under the grammar, given the insults' weights."""

    def __init__(self, learned: dict[str, float]):
        self.classes = {w: THREAT for w in THREATS} | {w: TARGET for w in TARGETS}
        self.classes |= {w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTS}
        self.weights = dict.fromkeys(INSULTS, SEED_WEIGHT)
        self.weights |= {w: x for w, x in learned.items() if not w.endswith("*")}
        self.stems = {w[:-1]: x for w, x in learned.items() if w.endswith("*")}
        _, self.go, self.weigh = grammar()

    def insult(self, word: str) -> float:
        w = self.weights.get(word)
        if w is None:
            w = self.stems.get(word[:STEM], 0.0) if len(word) >= STEM and word not in self.classes else 0.0
        return w

    def clause(self, words: list[str]) -> float:
        state = total = 0
        for word in words:
            weight = self.insult(word)
            kind = INSULT if weight else self.classes.get(word, OTHER)
            if kind == INSULT:
                total += weight * self.weigh[state][kind]
            elif kind == TARGET:
                total += THREAT_WEIGHT * self.weigh[state][kind]
            state = self.go[state][kind]
        return total

    def features(self, text: str | None) -> tuple[float, float, float, float]:
        """Sum of clause weights, the largest, number of clauses with weight, log of words."""
        text = (text or "").lower()
        words = TOKEN.findall(text)
        marked = {w for w in set(words) if self.insult(w) or self.classes.get(w) == THREAT}
        if not marked:
            return 0.0, 0.0, 0.0, math.log1p(len(words))
        found = []
        for part in CLAUSE.split(text):
            tokens = TOKEN.findall(part)
            if not marked.isdisjoint(tokens):
                found.append(self.clause(tokens))
        found = [x for x in found if x > 0]
        return sum(found), max(found, default=0.0), float(len(found)), math.log1p(len(words))


def _inputs(f: np.ndarray) -> np.ndarray:
    f = np.asarray(f, float).reshape(-1, 4)
    return np.column_stack([np.ones(len(f)), np.log1p(f[:, 0]), np.log1p(f[:, 1]), np.log1p(f[:, 2]), f[:, 3] / 5])


#: Without labels of both kinds.
DEFAULT = np.array([-4.0, 2.0, 1.0, 0.5, 0.0])


def fit_curve(f: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    if len(set(y.tolist())) < 2:
        return DEFAULT
    x, b = _inputs(f), np.zeros(5)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(5)
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def held_out(id_col: str, folds: int, fold: int):
    return F.crc32(F.col(id_col).cast("string")) % folds == fold


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_train: int, lexicon: int):
    """(insult weights, curve) from the labelled documents outside the held-out fold."""
    use = labels.select(F.col(id_col).alias("id"), F.col("toxic").alias("y")).dropna()
    use = use.filter(F.crc32(F.col("id").cast("string")) % 3 != 1)
    n = use.count()
    # A hash of the id takes each with the same chance; of equal ids one label and one text.
    use = use.filter(sampled(n, max_train, "id")).groupBy("id").agg(F.max("y").alias("y"))
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    train = text.join(F.broadcast(use), "id").dropna().groupBy("id", "y").agg(F.min("text").alias("text"))
    train = train.select("y", F.lower("text").alias("text"))
    words = F.array_distinct(F.split("text", r"[^\p{L}]+"))
    stems = F.transform(F.filter(words, lambda w: F.length(w) >= STEM), lambda w: F.concat(F.left(w, F.lit(STEM)), F.lit("*")))
    counts = (
        train.select("y", F.explode(F.array_union(words, stems)).alias("w"))
        .groupBy("w")
        .agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n"))
    )
    total = train.agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if n > max_train and not total.n:
        raise ValueError(f"No document of {n} labelled ones was taken to learn from")
    toxic, rest = total.t or 0, total.n - (total.t or 0)
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (rest + 1))
    top = counts.filter("t >= 5 and length(w) > 2").withColumn("x", odds).filter("x > 2.5")
    learned = {r.w: min(6.0, r.x) for r in top.orderBy(F.desc("x"), F.desc("t"), "w").limit(lexicon).collect()}
    scorer = docs.sparkSession.sparkContext.broadcast(learned)
    rows = train.mapInArrow(_features(scorer, 1), "y int, f array<double>").collect()  # at most max_train
    y = np.array([r.y for r in rows], float)
    return learned, fit_curve(np.array([r.f for r in rows]), y)


_scorers: dict[int, Scorer] = {}


def _features(learned, text_at: int):
    def fn(batches):
        scorer = Scorer(learned.value)
        for batch in batches:
            f = [list(scorer.features(t)) for t in batch.column(text_at).to_pylist()]
            other = batch.column(1 - text_at)
            if text_at:
                other = other.cast(pa.int32())
            cols = [other, pa.array(f, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cols, names=[batch.schema.names[1 - text_at], "f"])

    return fn


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_train: int = 20_000,
    lexicon: int = 5_000,
    threshold: float = 0.7,
) -> DataFrame:
    """Per document held_out, score (0 to 1), predicted, and what the grammar found.

    Labels are used only from rows whose crc32 of the id as text is not 1 modulo 3. The score
    depends on the text alone; of labels or documents with equal ids one is learned from. Null and empty texts are scored like a text without a match;
    without labels of both kinds a fixed curve is used. Ids may be null or repeated.
    """
    learned, curve = learn(docs, labels, id_col, text_col, max_train, lexicon)
    broadcast = docs.sparkSession.sparkContext.broadcast(learned)
    packed = docs.select(F.col(text_col).alias("text"), F.struct(F.col(id_col).alias("doc_id")).alias("row"))
    id_type = docs.schema[id_col].dataType.simpleString()
    f = packed.mapInArrow(_features(broadcast, 0), f"row struct<doc_id: {id_type}>, f array<double>")
    x = [F.lit(1.0), *[F.log1p(F.col("f")[i]) for i in range(3)], F.col("f")[3] / 5]
    z = sum((F.lit(float(b)) * c for b, c in zip(curve, x)), F.lit(0.0))
    scored = f.select("row.doc_id", F.round(1 / (1 + F.exp(-z)), 6).alias("score"), F.col("f")[2].cast("bigint").alias("n_clauses"))
    return scored.select(
        "doc_id",
        F.coalesce(held_out("doc_id", 3, 1), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_clauses",
    )
