"""Approximate name search by shared three-letter pieces, over all names or by a stored index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plateflow.functions.exact import ratio
from plateflow.session import cut


def trigrams(value: Column) -> Column:
    """Distinct pieces of every word, padded by two blanks in front and one behind."""
    words = F.filter(F.split(F.lower(value), "[^0-9a-z]+"), lambda w: F.length(w) > 0)
    pieces = F.transform(words, lambda w: F.transform(
        F.sequence(F.lit(1), F.length(w) + 1),
        lambda i: F.concat(F.lit("  "), w, F.lit(" ")).substr(i, F.lit(3)),
    ))
    return F.array_distinct(F.flatten(pieces))


def search_names(df: DataFrame, column: str, query: str, min_similarity: int = 30) -> DataFrame:
    """Rows whose name shares at least ``min_similarity`` percent of pieces with ``query``.

    Distinct names are compared with the one query (a map-side step), not with each other.
    """
    mine = trigrams(F.col(column))
    wanted = trigrams(F.lit(query))
    shared = F.size(F.array_intersect(mine, wanted))
    union = F.size(mine) + F.size(wanted) - shared
    return (
        df.withColumn("similarity_pct", ratio(shared, union, 1, times=100))
        .filter(shared * 100 >= union * min_similarity)
        .filter(union > 0)
    )


#: Folders of an index; a batch of searches opens those its pieces and its finds fall into.
INDEX_FOLDERS = 64
POSTINGS = "piece string, size int, name_id long, folder int"


def _folder(key: str) -> Column:
    return F.pmod(F.hash(F.col(key)), F.lit(INDEX_FOLDERS))


def write_name_index(names: DataFrame, column: str, path: str) -> None:
    """An inverted list of the distinct names: per piece the names that have it with their number of pieces, and the
    names themselves apart. Both lie in folders by hash, sorted inside, so that pieces, sizes and names are skipped.
    A null is no name; a name without a piece cannot be found."""
    value = F.col(f"`{column}`")
    distinct = names.select(value.alias("name")).filter("name is not null").distinct()
    known = distinct.select(F.xxhash64("name").alias("name_id"), "name", trigrams(F.col("name")).alias("pieces"))
    postings = known.select(F.explode("pieces").alias("piece"), F.size("pieces").alias("size"), "name_id")
    for rows, key, order, part in ((postings, "piece", ("piece", "size"), "postings"),
                                   (known.select("name_id", "name"), "name_id", ("name_id",), "names")):
        placed = rows.withColumn("folder", _folder(key)).hint("rebalance", "folder")
        placed.sortWithinPartitions("folder", *order).write.mode("overwrite").partitionBy("folder").parquet(f"{path}/{part}")


def _opened(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows of the folders that ``wanted`` keys fall into."""
    folders = [r[0] for r in wanted.select(_folder(key)).distinct().collect()]  # INDEX_FOLDERS at most
    return rows.filter(F.col("folder").isin(folders))


def search_index(spark: SparkSession, path: str, queries: DataFrame, min_similarity: int = 30) -> DataFrame:
    """For each of ``queries`` (query_id, query) the names that share at least ``min_similarity`` percent of pieces.

    Returns query_id, name, similarity_pct, as ``search_names`` over all names would. Names of a size
    that cannot reach the share are passed over in the lists; the shared pieces of the others are
    counted there, and only names whose count reaches it are read. Queries without a piece find nothing.
    """
    asked = queries.select("query_id", "query", trigrams(F.col("query")).alias("wanted"))
    asked = asked.withColumn("_n", F.size("wanted")).filter("_n > 0")
    probes = asked.select("query_id", "_n", F.explode("wanted").alias("piece"))
    postings = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    sizes = asked.agg(F.min("_n"), F.max("_n")).first()
    if sizes[0] is None:
        return spark.createDataFrame([], T.StructType([queries.schema["query_id"], T.StructField("name", T.StringType()),
                                                       T.StructField("similarity_pct", T.DecimalType(24, 1))]))
    lists = _opened(postings, probes, "piece").filter(
        (F.col("size") * 100 >= sizes[0] * min_similarity) & (F.col("size") * min_similarity <= sizes[1] * 100))
    met = probes.join(lists, "piece").filter(
        (F.col("size") * 100 >= F.col("_n") * min_similarity) & (F.col("size") * min_similarity <= F.col("_n") * 100))
    shared = F.col("_shared")
    found = met.groupBy("query_id", "_n", "name_id", "size").agg(F.count(F.lit(1)).alias("_shared")).filter(
        shared * 100 >= (F.col("_n") + F.col("size") - shared) * min_similarity).select("query_id", "name_id").distinct()
    # Computed once for the folders and the join; as many rows as there are finds.
    found = cut(found)
    names = _opened(spark.read.schema("name_id long, name string, folder int").parquet(f"{path}/names"), found, "name_id")
    pairs = found.join(names.drop("folder"), "name_id").join(asked.select("query_id", "wanted"), "query_id")
    both = F.size(F.array_intersect(trigrams(F.col("name")), F.col("wanted")))
    union = F.size(trigrams(F.col("name"))) + F.size("wanted") - both
    # Two names of one hash would have been counted together.
    return pairs.filter(both * 100 >= union * min_similarity).select(
        "query_id", "name", ratio(both, union, 1, times=100).alias("similarity_pct"))
