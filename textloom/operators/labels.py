"""Label dictionary and label encoding.

The dictionary is one row per class. It is built from a ``distinct``
(partial aggregate, then shuffle of distinct labels only), size-checked,
and broadcast into the joins that encode or decode corpus rows, so the
corpus itself is never shuffled for encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import cut_lineage, small_table
from textloom.sources.corpus import LABEL

CODE = "code"


def label_dictionary(df: DataFrame, label_col: str = LABEL, materialize: bool = True) -> DataFrame:
    """Sorted distinct labels -> codes 0..n-1 (code-point order).

    The ranking window runs over the distinct-label table only; it never
    sees corpus rows.
    """
    labels = df.where(F.col(label_col).isNotNull()).select(F.col(label_col).alias(LABEL)).distinct()
    if materialize:
        labels = cut_lineage(labels)
    w = Window.orderBy(LABEL)
    ranked = labels.select((F.row_number().over(w) - 1).cast("int").alias(CODE), LABEL)
    return cut_lineage(ranked) if materialize else ranked


def encode_labels(df: DataFrame, dictionary: DataFrame, label_col: str = LABEL,
                  code_col: str = CODE) -> DataFrame:
    """Label -> code by an inner join with the broadcast dictionary."""
    d = dictionary.select(F.col(LABEL).alias(label_col), F.col(CODE).alias(code_col))
    return df.join(small_table(d), label_col, "inner").select(*df.columns, code_col)


def decode_labels(df: DataFrame, dictionary: DataFrame, code_col: str = CODE,
                  label_col: str = LABEL) -> DataFrame:
    """Code -> class name by a left join with the broadcast dictionary."""
    d = dictionary.select(F.col(CODE).alias(code_col), F.col(LABEL).alias(label_col))
    return df.join(small_table(d), code_col, "left").select(*df.columns, label_col)


def dictionary_map_json(dictionary: DataFrame) -> DataFrame:
    """S5 map form: one row ``{"0": label, "1": ...}`` in code order."""
    entries = F.transform(F.array_sort(F.collect_list(F.struct(CODE, LABEL))),
                          lambda e: F.struct(e[CODE].cast("string"), e[LABEL]))
    return dictionary.agg(F.to_json(F.map_from_entries(entries)).alias("json"))


def dictionary_list_json(dictionary: DataFrame) -> DataFrame:
    """S5 list form: one row ``{"classes": [...], "num_classes": n}``."""
    classes = F.transform(F.array_sort(F.collect_list(F.struct(CODE, LABEL))), lambda e: e[LABEL])
    return dictionary.agg(F.to_json(F.struct(classes.alias("classes"),
                                             F.count(F.lit(1)).cast("int").alias("num_classes"))).alias("json"))


def write_label_dict(dictionary: DataFrame, path: str, shape: str = "map") -> str:
    """Persist the dictionary as ``map`` / ``list`` JSON or ``rows`` parquet."""
    if shape == "rows":
        dictionary.write.mode("overwrite").parquet(path)
        return path
    doc = dictionary_map_json(dictionary) if shape == "map" else dictionary_list_json(dictionary)
    doc.write.mode("overwrite").text(path)
    return path


def read_label_dict(spark: SparkSession, path: str, shape: str = "map") -> DataFrame:
    """Read a dictionary written by ``write_label_dict``."""
    if shape == "rows":
        return spark.read.parquet(path)
    raw = spark.read.text(path)
    if shape == "map":
        m = F.from_json("value", "map<string,string>")
        return (raw.select(F.explode(m).alias("k", LABEL))
                .select(F.col("k").cast("int").alias(CODE), LABEL))
    doc = F.from_json("value", "struct<classes: array<string>, num_classes: int>")
    return (raw.select(doc.alias("d")).select(F.posexplode("d.classes").alias("pos", LABEL))
            .select(F.col("pos").cast("int").alias(CODE), LABEL))
