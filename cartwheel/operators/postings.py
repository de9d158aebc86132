"""Product search for a table of queries, through postings of character grams.

A gram is a string of three characters that occurs in a field (of one or two for shorter words). The rarest grams of a
word are intersected, and what is left is compared with the word itself, so results equal those of a scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import text
from cartwheel.operators import ranking
from cartwheel.operators.search import FUZZY_RESULTS
from cartwheel.session import scratch

GRAM = 3
#: Grams of a word that are intersected, the rarest first.
INTERSECTED = 3
FIELDS = ("product_name", "aisle", "department")


@dataclass(frozen=True)
class Postings:
    """Written: ``grams`` (gram, product_id), ``counts`` (gram, n) and the products themselves."""

    products: DataFrame
    grams: DataFrame
    counts: DataFrame


def _grams(value: Column, size: int | Column) -> Column:
    """Distinct strings of ``size`` characters in a value; none where it is shorter."""
    last = F.length(value) - size + 1
    every = F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(value, i, F.lit(size) if isinstance(size, int) else size))
    return F.when(last >= 1, F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Over all shuffle partitions: postings shrink so much in a shuffle that by bytes they would end up in one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def build_postings(catalog: DataFrame) -> Postings:
    """Postings of the lower-case name, aisle and department of every product; a missing field has no grams."""
    products = _stored(_spread(catalog.select("product_id", *FIELDS), "product_id"), "postings-products")
    fields = [F.lower(F.coalesce(F.col(c), F.lit(""))) for c in FIELDS]
    every = F.array_distinct(F.flatten(F.array(*[_grams(f, size) for f in fields for size in range(1, GRAM + 1)])))
    grams = _stored(products.select(F.explode(every).alias("gram"), "product_id"), "postings-grams")
    counts = _stored(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "postings-counts")
    return Postings(products, grams, counts)


def _holding(postings: Postings, terms: DataFrame) -> DataFrame:
    """term and the products that hold it in a field, for the distinct terms of one column; empty terms hold nowhere.

    A term's rarest grams are looked up; one that no product has leaves it without candidates at once. Products that
    have all of them are compared with the term.
    """
    size = F.least(F.length("term"), F.lit(GRAM))
    asked = terms.where("term <> ''").distinct().select("term", F.explode(_grams(F.col("term"), size)).alias("gram"))
    known = asked.join(postings.counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rare = ranking.top_n_per(known, ["term"], [F.col("n"), F.col("gram")], INTERSECTED)
    chosen = rare.groupBy("term").agg(F.count(F.lit(1)).alias("wanted"), F.min("n").alias("least")).where("least > 0")
    found = (
        _spread(rare.join(chosen, "term").join(postings.grams, "gram"), "term", "product_id")
        .groupBy("term", "product_id")
        .agg(F.count(F.lit(1)).alias("have"), F.first("wanted").alias("wanted"))
        .where("have = wanted")
    )
    holds = F.lit(False)
    for field in FIELDS:
        holds = holds | F.lower(F.coalesce(F.col(field), F.lit(""))).contains(F.col("term"))
    return found.select("term", "product_id").join(postings.products, "product_id").where(holds)


def search_products(postings: Postings, queries: DataFrame, limit: int | None = None) -> DataFrame:
    """query_id and the products whose name, aisle or department contains the query; the first ``limit`` by id if given.

    ``queries`` is (query_id, query). A null or empty query finds nothing; repeated queries are answered each. What a text
    hits is written once, each file in order, and then meets its queries, so that rows come text by text and in it product
    by product: a file holds a product once for all queries of a text and a list of query ids that repeats, which
    compresses. (A sort that isn't written would be dropped before a join.) Products are spread over the files by hash, as
    a few texts may have most of the rows. Every text has a query, so a left join leaves the same rows; it keeps the
    products on the side that is read in order and never broadcasts them.
    """
    asked = queries.select("query_id", F.lower(F.coalesce(F.col("query"), F.lit(""))).alias("term"))
    held = _stored(_holding(postings, asked.select("term")).sortWithinPartitions("term", "product_id"), "postings-hits")
    hits = held.join(asked, "term", "left")
    rows = hits.select("query_id", "product_id", *FIELDS, F.lit(1.0).alias("score"))
    return rows if limit is None else ranking.top_n_per(rows, ["query_id"], [F.col("product_id")], limit).drop("rank")


def fuzzy_products(postings: Postings, queries: DataFrame, limit: int = FUZZY_RESULTS) -> DataFrame:
    """The ``limit`` best products of each query (query_id, query) by word score, then id, with their rank.

    A word scores 1 where a field contains it, and 2 more where it is the name or a word of it; quotes around a query
    are dropped, and a word that stands twice counts twice. A query without words finds nothing.
    """
    bare = F.lower(F.btrim(F.trim(F.coalesce(F.col("query"), F.lit(""))), F.lit("'\"")))
    words = queries.select("query_id", F.explode(F.split(F.trim(bare), r"\s+")).alias("term")).where("term <> ''")
    # Queries of the same words, in whatever order, have the same answer, which is worked out once.
    words = words.groupBy("query_id").agg(F.array_sort(F.collect_list("term")).alias("words"))
    sets = words.select("words").distinct()
    terms = sets.select("words", F.explode("words").alias("term")).groupBy("words", "term").agg(F.count(F.lit(1)).alias("times"))
    terms = terms.withColumn("only", F.size(F.array_distinct("words")) == 1)
    name = F.lower(F.coalesce(F.col("product_name"), F.lit("")))
    exact = (name == F.col("term")) | F.array_contains(F.split(F.trim(name), r"\s+"), F.col("term"))
    held = _holding(postings, terms.select("term")).select("term", "product_id", F.when(exact, 3).otherwise(1).alias("points"))
    held = _stored(held.groupBy("term", "product_id").agg(F.sum("points").alias("points")), "postings-held")
    # A single word needs no sums: its own best products are the answer.
    first = ranking.top_n_per(held, ["term"], [F.desc("points"), F.col("product_id")], limit).drop("rank")
    score = F.sum(F.col("points") * F.col("times")).cast("int").alias("score")
    points = terms.where("only").join(first, "term").unionByName(terms.where("not only").join(held, "term"))
    summed = _spread(points, "words", "product_id").groupBy("words", "product_id").agg(score)
    best = ranking.top_n_per(summed, ["words"], [F.desc("score"), F.col("product_id")], limit)
    answers = words.join(best.select("words", "product_id", "score", "rank"), "words")
    return answers.join(postings.products, "product_id").select("query_id", "product_id", *FIELDS, "score", "rank")
