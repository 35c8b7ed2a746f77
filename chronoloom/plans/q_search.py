"""Search over the parts table as a catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronoloom.operators.search import (
    capability_filter, explain_tags, meets, page, rank_order, ranked_search, similar, suggest,
    tag_category, tag_filter,
)
from chronoloom.plans.registry import flag, query
from chronoloom.sources.datasets import table


def _parts(spark, sf_dir):
    """Parts with a map of tags; whether a part is large is a boolean tag."""
    return table(spark, sf_dir, "part").withColumn(
        "tags",
        F.create_map(
            F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string"),
            F.lit("capability:large"), (F.col("p_size") >= 25).cast("string"),
        ),
    )


_SCORE = """s AS (SELECT p_partkey, p_name, CASE WHEN lower(p_name) = '{0}' THEN 0
    WHEN starts_with(lower(p_name), '{0}') THEN 1 WHEN contains(lower(p_name), '{0}') THEN 2
    WHEN contains(lower(p_brand), '{0}') THEN 3 WHEN contains(lower(p_type), '{0}') THEN 4 END AS score FROM part)"""


@query(
    f"""WITH {_SCORE.format('red widget')}
        SELECT p_partkey, p_name, CAST(score AS INTEGER) AS score FROM s WHERE score IS NOT NULL"""
)
def search_exact(spark, sf_dir):
    cols = ["p_name", "p_brand", "p_type"]
    found = ranked_search(table(spark, sf_dir, "part"), "Red Widget", cols)
    return found.orderBy(*rank_order(cols, "p_partkey")).select("p_partkey", "p_name", "score")


@query(
    f"""WITH {_SCORE.format('red')}
        SELECT p_partkey, p_name, CAST(score AS INTEGER) AS score FROM s WHERE score IS NOT NULL"""
)
def search_ranked(spark, sf_dir):
    cols = ["p_name", "p_brand", "p_type"]
    found = ranked_search(table(spark, sf_dir, "part"), " Red ", cols)
    return found.orderBy(*rank_order(cols, "p_partkey")).select("p_partkey", "p_name", "score")


@query(
    f"""WITH {_SCORE.format('eco')}, m AS (SELECT * FROM s WHERE score IS NOT NULL),
        o AS (SELECT p_partkey, p_name, CAST(score AS INTEGER) AS score FROM m
              ORDER BY score, lower(p_name), p_partkey LIMIT 50 OFFSET 100)
        SELECT o.*, (SELECT count(*) FROM m) AS total, CAST((SELECT count(*) FROM m) > 150 AS INTEGER) AS has_more FROM o"""
)
def search_page(spark, sf_dir):
    cols = ["p_name", "p_brand", "p_type"]
    found = ranked_search(table(spark, sf_dir, "part"), "eco", cols)
    found = found.select("p_partkey", *cols, "score")
    out = page(found, rank_order(cols, "p_partkey"), limit=50, offset=100)
    return out.select("p_partkey", "p_name", "score", "total", flag("has_more").alias("has_more"))


@query("SELECT p_partkey, p_name FROM part WHERE p_type = 'ECONOMY' AND p_brand = 'Brand#2' AND p_size >= 25")
def search_tags(spark, sf_dir):
    found = tag_filter(
        _parts(spark, sf_dir), '{"brand": "Brand#2", "capability:large": "true"}', ("p_type", "ECONOMY")
    )
    return found.select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_size < 25")
def search_capability(spark, sf_dir):
    found = capability_filter(_parts(spark, sf_dir), {"large": "capability:large"}, large=False)
    return found.select("p_partkey", "p_name")


@query(
    """WITH w AS (SELECT DISTINCT replace(p_name, 'e', '') AS word FROM part),
       k AS (SELECT DISTINCT p_name AS key FROM part),
       s AS (SELECT word, key, levenshtein(word, key) AS d FROM w, k
             QUALIFY row_number() OVER (PARTITION BY word ORDER BY levenshtein(word, key), key) = 1)
       SELECT word, CASE WHEN d <= 2 THEN key END AS suggestion,
              CAST(CASE WHEN d <= 2 THEN d END AS INTEGER) AS distance FROM s"""
)
def did_you_mean(spark, sf_dir):
    """Part names with their e's lost, against the valid names."""
    part = table(spark, sf_dir, "part")
    return suggest(part.select(F.regexp_replace("p_name", "e", "").alias("word")), part.select("p_name"))


@query(
    """SELECT p_partkey, tag, concat(coalesce(description, tag), ': ', v) AS explanation FROM (
         SELECT p_partkey, unnest(['brand', 'size', 'capability:large']) AS tag,
                unnest([p_brand, CAST(p_size AS VARCHAR), CASE WHEN p_size >= 25 THEN 'Yes' ELSE 'No' END]) AS v FROM part)
       LEFT JOIN (VALUES ('brand', 'Brand of the part'), ('capability:large', 'Large part')) d(tag, description) USING (tag)"""
)
def tags_explained(spark, sf_dir):
    defs = spark.createDataFrame(
        [("brand", "Brand of the part", "str"), ("capability:large", "Large part", "bool")],
        "tag string, description string, value_type string",
    )
    return explain_tags(_parts(spark, sf_dir), defs, "p_partkey")


@query(
    """SELECT tag, CASE WHEN starts_with(tag, 'capability:') THEN 'capability' ELSE 'general' END AS category,
              count(*) AS parts
       FROM (SELECT unnest(['brand', 'size', 'capability:large']) AS tag FROM part) GROUP BY 1, 2"""
)
def tag_categories(spark, sf_dir):
    tags = _parts(spark, sf_dir).select(F.explode(F.map_keys("tags")).alias("tag"))
    counted = tags.groupBy("tag").agg(F.count(F.lit(1)).alias("parts"))
    return counted.select("tag", tag_category(F.col("tag")).alias("category"), "parts")


@query(
    """SELECT p_partkey, 'brand' AS requirement, CAST(p_brand = 'Brand#2' AS INTEGER) AS met FROM part
       UNION ALL SELECT p_partkey, 'size', CAST(p_size = 11 AS INTEGER) FROM part
       UNION ALL SELECT p_partkey, 'colour', 0 FROM part"""
)
def requirements_met(spark, sf_dir):
    wanted = {"brand": "Brand#2", "size": "11", "colour": "red"}
    return meets(_parts(spark, sf_dir), wanted, "p_partkey").withColumn("met", flag("met"))


@query(
    """WITH t AS (SELECT p_partkey, p_name, p_type, p_brand, p_size, split_part(p_name, ' ', 1) AS colour FROM part),
       s AS (SELECT a.p_partkey, b.p_partkey AS other, b.p_name,
               CAST(a.p_brand = b.p_brand AS INTEGER) + CAST(a.p_size = b.p_size AS INTEGER)
               + CAST(a.colour = b.colour AS INTEGER) AS score
             FROM t a JOIN t b ON a.p_type = b.p_type AND a.p_partkey <> b.p_partkey),
       r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, p_name, other) AS rank FROM s)
       SELECT p_partkey, CAST(rank AS INTEGER) AS rank, other, score FROM r WHERE rank <= 5"""
)
def similar_parts(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("colour", F.split_part("p_name", F.lit(" "), F.lit(1)))
    return similar(part, "p_partkey", "p_name", "p_type", ["p_brand", "p_size", "colour"], k=5)
