"""Sparse feature matrix in long form and column-wise L2 normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from termloom.operators.terms import lexical_diversity, tfidf
from termloom.session import hot_split_join, materialise, new_table_path, stored, with_row_index

DIVERSITY = "__diversity"
NUM_WORDS = "__num_words"


def feature_matrix(bags: DataFrame) -> DataFrame:
    """(doc_id, feature, value): TF-IDF terms plus two length features per document.

    Absent cells are zero and are never stored.
    """
    stats = lexical_diversity(bags)
    extra = F.array(
        F.struct(F.lit(DIVERSITY).alias("feature"), F.col("diversity").alias("value")),
        F.struct(F.lit(NUM_WORDS).alias("feature"), F.col("num_words").cast("double").alias("value")),
    )
    lengths = stats.select("doc_id", F.explode(extra).alias("e")).select("doc_id", "e.feature", "e.value")
    terms = tfidf(bags).select("doc_id", F.col("term").alias("feature"), F.col("tfidf").alias("value"))
    return terms.unionByName(lengths)


def l2_normalize_columns(matrix: DataFrame) -> DataFrame:
    """Divide each value by the L2 norm of its *feature* over all rows.

    A column of zeros stays zero. Read the matrix from a table: it is scanned for
    the norms and again for the join.
    """
    norms = matrix.groupBy("feature").agg(
        F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"), F.count("*").alias("n_cells")
    )
    joined = hot_split_join(matrix, norms, "feature", "n_cells")
    scaled = F.when(F.col("norm") > 0, F.col("value") / F.col("norm")).otherwise(F.col("value"))
    return joined.select(*[c for c in matrix.columns if c != "value"], scaled.alias("value"))


def l2_normalize_vectors(rows: DataFrame, vec: str) -> DataFrame:
    """Column-wise L2 normalisation of fixed-width dense vectors in column ``vec``.

    Norms are one partial-aggregated row per position (width of the vector, which
    every row already holds), applied by position without regrouping.
    """
    cells = rows.select(F.posexplode(vec).alias("pos", "v"))
    norms = cells.groupBy("pos").agg(F.sqrt(F.sum(F.col("v").cast("double") * F.col("v").cast("double"))).alias("norm"))
    ordered = norms.agg(F.sort_array(F.collect_list(F.struct("pos", "norm"))).alias("a"))
    listed = ordered.select(F.transform("a", lambda e: e["norm"]).alias("norms")).scalar()
    with_norms = rows.withColumn("_norms", listed)
    scaled = F.zip_with(
        F.col(vec), F.col("_norms"),
        lambda v, n: F.when(n > 0, v.cast("double") / n).otherwise(v.cast("double")),
    )
    return with_norms.withColumn(vec, scaled).drop("_norms")


def sparse_rows(matrix: DataFrame) -> DataFrame:
    """(doc_id, idx array<string>, val array<double>): nonzero cells per document.

    Documents whose cells are all zero keep a row with empty arrays.
    """
    cell = F.when(F.col("value") != 0, F.struct("feature", "value"))
    packed = matrix.groupBy("doc_id").agg(F.collect_list(cell).alias("c"))
    return packed.select("doc_id", F.col("c.feature").alias("idx"), F.col("c.value").alias("val"))


def packed_rows(matrix: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, idx array<int>, val array<double>) with one position per feature, and the
    number of features; stored."""
    matrix = stored(matrix, "matrix")
    names, width = with_row_index(matrix.groupBy("feature").agg(F.count("*").alias("n_cells")), "feature", name="at")
    cell = F.when(F.col("value") != 0, F.struct(F.col("at").cast("int").alias("at"), "value"))
    packed = hot_split_join(matrix, names, "feature", "n_cells").groupBy("doc_id").agg(F.sort_array(F.collect_list(cell)).alias("c"))
    return materialise(packed.select("doc_id", F.col("c.at").alias("idx"), F.col("c.value").alias("val")), "packed"), width


def sparse_vectors(matrix: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, features ML vector) and the vector width, one position per feature.

    Rows are written in the storage layout of the ML vector type and read back as
    that type, so no Python code touches them.
    """
    from pyspark.ml.linalg import VectorUDT

    matrix = stored(matrix, "matrix")
    names, width = with_row_index(matrix.groupBy("feature").agg(F.count("*").alias("n_cells")), "feature", name="at")
    cells = hot_split_join(matrix, names, "feature", "n_cells")
    cell = F.when(F.col("value") != 0, F.struct(F.col("at").cast("int").alias("at"), "value"))
    packed = cells.groupBy("doc_id").agg(F.sort_array(F.collect_list(cell)).alias("c"))
    layout = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(width).alias("size"),
        F.col("c.at").alias("indices"), F.col("c.value").alias("values"),
    )
    schema = StructType([StructField("doc_id", matrix.schema["doc_id"].dataType), StructField("features", VectorUDT())])
    path = new_table_path(matrix.sparkSession, "features")
    packed.select("doc_id", layout.alias("features")).write.parquet(path)
    return matrix.sparkSession.read.schema(schema).parquet(path), width
