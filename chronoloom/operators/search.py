"""Search over a catalog table: ranking, tags, paging, suggestions, similarity."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Valid keys up to this many are compared directly; more go through a join.
DIRECT_KEYS = 1_000


def ranked_search(df: DataFrame, query: str, cols: list[str]) -> DataFrame:
    """Rows that match, with `score`: 0 exact name, 1 prefix, 2 inside the name, then 3, 4, …
    for the other columns. Case is ignored and the query is taken literally."""
    q = F.lit(query.strip().lower())
    name = F.lower(F.col(cols[0]))
    score = F.when(name == q, 0).when(name.startswith(q), 1).when(name.contains(q), 2)
    for i, c in enumerate(cols[1:]):
        score = score.when(F.lower(F.coalesce(F.col(c), F.lit(""))).contains(q), 3 + i)
    return df.withColumn("score", score).where("score is not null")


def rank_order(cols: list[str], *ties: str) -> list[Column]:
    return [F.col("score"), F.lower(F.col(cols[0])), *[F.col(t) for t in ties]]


def tag_filter(
    df: DataFrame, tags: dict[str, str] | str, category: tuple[str, str] | None = None, column="tags"
) -> DataFrame:
    """Rows whose map column has every given pair; tags may be a JSON object."""
    if isinstance(tags, str):
        import json

        tags = json.loads(tags)
    if not isinstance(tags, dict):
        raise ValueError("tags must be a dict or a JSON object")
    out = df if category is None else df.where(F.col(category[0]) == F.lit(category[1]))
    for k, v in tags.items():
        out = out.where(F.col(column)[k] == F.lit(str(v)))
    return out


# Capability names and the tag keys that they stand for.
CAPABILITIES = {
    "probabilistic": "capability:pred_int",
    "handles_missing": "handles-missing-data",
    "multivariate": "capability:multivariate",
}


def capability_filter(df: DataFrame, names: dict[str, str] | None = None, column="tags", **wanted) -> DataFrame:
    """Filter by named capabilities; `names` maps a capability to its tag key."""
    names = CAPABILITIES if names is None else names
    unknown = [w for w in wanted if w not in names]
    if unknown:
        raise ValueError(f"Unknown capabilities {unknown}; use {list(names)}")
    tags = {names[w]: str(v).lower() if isinstance(v, bool) else v for w, v in wanted.items() if v is not None}
    return tag_filter(df, tags, column=column)


def page(df: DataFrame, order: list, limit: int = 50, offset: int = 0) -> DataFrame:
    """One page under a total order, with `total` and `has_more` on each row."""
    if offset < 0:
        raise ValueError("offset must not be negative")
    if limit < 1:
        raise ValueError("limit must be positive")
    total = df.agg(F.count(F.lit(1)).alias("total"))
    rows = df.orderBy(*order).offset(offset).limit(limit)
    out = rows.withColumn("total", total.scalar())
    return out.withColumn("has_more", F.lit(offset + limit) < F.col("total"))


def suggest(words: DataFrame, keys: DataFrame, max_distance: int = 2) -> DataFrame:
    """`(word, suggestion, distance)`: the nearest valid key by edit distance, first by
    name on ties, NULL beyond `max_distance`. Both inputs have one text column."""
    word = F.col(words.columns[0])
    distinct = words.select(word.alias("word")).where("word is not null").distinct()
    valid = keys.select(F.col(keys.columns[0]).alias("key")).where("key is not null").distinct()
    listed = [r[0] for r in valid.limit(DIRECT_KEYS + 1).collect()]
    if len(listed) <= DIRECT_KEYS:
        options = F.array(*[F.lit(k) for k in sorted(listed)]).cast("array<string>")
        best = F.array_min(
            F.transform(
                options, lambda k: F.struct(F.levenshtein(F.col("word"), k).alias("d"), k.alias("k"))
            )
        )
        out = distinct.withColumn("b", best).select(
            "word", F.col("b.k").alias("suggestion"), F.col("b.d").alias("distance")
        )
    else:
        out = _suggest_by_deletions(distinct, valid, max_distance)
    near = F.col("distance") <= max_distance
    return out.select(
        "word", F.when(near, F.col("suggestion")).alias("suggestion"),
        F.when(near, F.col("distance")).alias("distance"),
    )


def _deletions(text: Column, depth: int) -> Column:
    """The text and all texts left after deleting at most `depth` characters."""

    def drop_one(s):
        cut = F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))),
            lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))),
        )
        return cut

    found = F.array(text)
    for _ in range(depth):
        found = F.array_distinct(F.concat(found, F.flatten(F.transform(found, drop_one))))
    return found


def _suggest_by_deletions(words: DataFrame, valid: DataFrame, depth: int) -> DataFrame:
    """Two texts within `depth` edits share a text after `depth` deletions on each side,
    so an equi-join on deletions finds every candidate without comparing all pairs."""
    a = words.withColumn("__v", F.explode(_deletions(F.col("word"), depth)))
    b = valid.withColumn("__v", F.explode(_deletions(F.col("key"), depth)))
    pairs = a.join(b, "__v").select("word", "key").distinct()
    scored = pairs.withColumn("d", F.levenshtein("word", "key"))
    best = scored.groupBy("word").agg(F.min(F.struct("d", "key")).alias("b"))
    return words.join(best, "word", "left").select(
        "word", F.col("b.key").alias("suggestion"), F.col("b.d").alias("distance")
    )


def explain_tags(df: DataFrame, defs: DataFrame, id_col: str, column="tags") -> DataFrame:
    """`(id, tag, explanation)` from definitions `(tag, description, value_type)`.

    Boolean values read Yes or No; a tag without a definition shows its own name.
    """
    pairs = df.select(id_col, F.explode(column).alias("tag", "value"))
    defs = defs.select("tag", "description", "value_type")
    # Every row has the same few tags, so a shuffled join would crowd on them.
    if defs.limit(DIRECT_KEYS + 1).count() <= DIRECT_KEYS:
        defs = F.broadcast(defs)
    joined = pairs.join(defs, "tag", "left")
    truth = F.lower("value").isin("true", "1", "yes")
    shown = F.when(F.col("value_type") == "bool", F.when(truth, "Yes").otherwise("No"))
    text = F.concat(
        F.coalesce("description", "tag"), F.lit(": "),
        F.coalesce(shown, F.col("value"), F.lit("")),
    )
    return joined.select(id_col, "tag", text.alias("explanation"))


# Name prefix and the tag category that it means.
PREFIXES = {
    "capability:": "capability",
    "scitype:": "data",
    "requires": "behavior",
    "transform": "transformation",
    "python_": "requirements",
}


def tag_category(name: Column, scope: Column | None = None, prefixes: dict[str, str] | None = None) -> Column:
    """Category from the prefix of a tag name, else its scope, else `general`."""
    out = None
    for prefix, category in (PREFIXES if prefixes is None else prefixes).items():
        hit = name.startswith(prefix)
        out = F.when(hit, category) if out is None else out.when(hit, category)
    if prefixes is None:
        out = out.when(name.contains("mtype"), "data")
    fallback = F.lit("general")
    return out.otherwise(F.coalesce(scope, fallback) if scope is not None else fallback)


def meets(df: DataFrame, requirements: dict[str, str], id_col: str, column="tags") -> DataFrame:
    """`(id, requirement, met)` for every required pair."""
    entries = F.array(
        *[
            F.struct(
                F.lit(k).alias("requirement"),
                F.col(column)[k].eqNullSafe(F.lit(str(v))).alias("met"),
            )
            for k, v in requirements.items()
        ]
    )
    return df.select(id_col, F.explode(entries).alias("r")).select(id_col, "r.*")


def similar(df: DataFrame, id_col: str, name: str, category: str, tags: list[str], k: int = 5) -> DataFrame:
    """`(id, rank, other, score)`: for each row the k rows of its category with most equal
    tags, by name (then id) on ties, itself excluded.

    Instead of comparing all pairs of a category, rows are filed under each subset of their
    tag values, and each file keeps its first k+1 rows by name. A row that is not among those
    has k better ones before it in the same file, so the result is exact. Rows with the same
    category and tag values, a profile, have the same files: only the first k+1 rows of a
    profile are filed, and the files are read once for a profile, not for each of its rows.
    """
    if k < 1:
        raise ValueError("k must be positive")
    subsets = [s for r in range(len(tags) + 1) for s in combinations(range(len(tags)), r)]
    value = [F.coalesce(F.col(t).cast("string"), F.lit("\u0000")) for t in tags]
    rows = df.select(
        F.col(id_col).alias("id"), F.col(name).alias("name"), F.coalesce(F.col(category).cast("string"), F.lit("\u0000")).alias("cat"),
        F.array(*value).cast("array<string>").alias("tags"),
    )
    profile, bucket = ["cat", "tags"], ["cat", "set", "vals"]

    def first(rows: DataFrame, key: list[str]) -> DataFrame:
        place = F.row_number().over(W.partitionBy(*key).orderBy("name", "id"))
        return rows.withColumn("__rn", place).where(F.col("__rn") <= k + 1).drop("__rn")

    files = F.array(
        *[
            F.struct(
                F.lit(i).alias("set"),
                F.array(*[F.col("tags")[j] for j in s]).cast("array<string>").alias("vals"),
                F.lit(len(s)).alias("score"),
            )
            for i, s in enumerate(subsets)
        ]
    )
    filed = first(rows, profile).select("id", "name", "cat", F.explode(files).alias("f"))
    packed = first(filed.select("id", "name", "cat", "f.*"), bucket).groupBy(*bucket).agg(
        F.collect_list(F.struct(F.col("name"), F.col("id").alias("other"))).alias("others")
    )
    asked = rows.select(*profile).distinct().select(*profile, F.explode(files).alias("f")).select(*profile, "f.*")
    # Merge joins: files and profiles grow with the rows, so they are never sent through the driver.
    met = asked.join(packed.hint("merge"), bucket).select(*profile, "score", F.explode("others").alias("o"))
    met = met.groupBy(*profile, "o").agg(F.max("score").alias("score"))
    found = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "o.name", "o.other")))
    lists = met.groupBy(*profile).agg(found.alias("found"))
    # k+1 different ids leave k to each row; where an id has several names, all stay.
    short = F.slice("found", 1, k + 1)
    enough = F.size(F.array_distinct(F.transform(short, lambda o: o["other"]))) == k + 1
    lists = lists.select(*profile, F.when(enough, short).otherwise(F.col("found")).alias("found"))
    others = F.slice(F.filter("found", lambda o: o["other"] != F.col("id")), 1, k)
    pairs = rows.select("id", *profile).join(lists.hint("merge"), profile).select("id", F.explode(others).alias("o"))
    best = pairs.groupBy("id", F.struct("o.name", "o.other").alias("o")).agg(F.max(-F.col("o.less")).alias("score"))
    order = W.partitionBy("id").orderBy(F.desc("score"), "o.name", "o.other")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias(id_col), "rank", F.col("o.other").alias("other"), "score")
