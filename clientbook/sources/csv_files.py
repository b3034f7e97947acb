"""CSV inputs with a header line, read against declared schemas."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientbook import schemas as s

INPUTS: dict[str, T.StructType] = {
    "dim_relationship_managers": s.RELATIONSHIP_MANAGERS,
    "dim_products": s.PRODUCTS,
    "dim_customers": s.CUSTOMERS,
    "stg_transactions": s.TRANSACTIONS,
}

FILE_NAMES = {
    "dim_relationship_managers": "relationship_managers.csv",
    "dim_products": "product_catalogue.csv",
    "dim_customers": "customers.csv",
    "stg_transactions": "transactions.csv",
}


class MissingInputs(FileNotFoundError):
    """Names every input that cannot be found, not just the first."""

    def __init__(self, missing: dict[str, str]):
        self.missing = missing
        super().__init__("missing inputs: " + ", ".join(f"{k} ({v})" for k, v in missing.items()))


def input_paths(folder: str) -> dict[str, str]:
    return {table: os.path.join(folder, name) for table, name in FILE_NAMES.items()}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, a folder or any match of a glob is there, on whatever file system it lives."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def presence(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table_name, path, is_present) of every input: one look-up each, no rows are read."""
    rows = [(table, path, int(path_exists(spark, path))) for table, path in paths.items()]
    return spark.createDataFrame(rows, "table_name string, path string, is_present int")


def validate_inputs(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail before any work if an input is absent."""
    missing = {table: path for table, path in paths.items() if not path_exists(spark, path)}
    if missing:
        raise MissingInputs(missing)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed scan of a file, a folder of files or a glob.

    The schema is declared, so nothing is read twice to infer it. A header that differs from
    it, or a value that does not fit its type, fails the job.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')  # a quote inside quotes is written twice
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_or_reject(
    spark: SparkSession, path: str, schema: T.StructType, key: str
) -> tuple[DataFrame, DataFrame]:
    """The typed rows of a CSV that has bad ones among them, and those: (record, faults).

    ``faults`` names what is wrong with a record: the columns whose text does not fit their type, the key
    where it is missing, and ``record`` where the number of values is not that of the header. Both frames are
    the same scan with opposite filters; write one, or cache, where the file is large.
    """
    corrupt = "unreadable_record"
    texts = T.StructType([T.StructField(field.name, T.StringType()) for field in schema])
    raw = (
        spark.read.schema(texts.add(corrupt, T.StringType()))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", corrupt)
        .csv(path)
    )

    def typed(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DateType):
            return F.try_to_timestamp(F.col(field.name), F.lit("yyyy-MM-dd")).cast("date")
        return F.col(field.name).try_cast(field.dataType)

    checks = [F.when(F.col(corrupt).isNotNull(), F.lit("record"))]
    for field in schema:
        bad = F.col(field.name).isNotNull() & typed(field).isNull()
        if field.name == key:
            bad = bad | F.col(field.name).isNull()
        checks.append(F.when(bad & F.col(corrupt).isNull(), F.lit(field.name)))
    # The values are worked out once and kept as they are: a filter must not repeat every conversion.
    judged = raw.select(
        "*",
        F.inline(F.array(F.struct(F.array_compact(F.array(*checks)).alias("faults"), *[typed(f).alias(f"{f.name}_typed") for f in schema]))),
    )
    good = judged.filter(F.size("faults") == 0).select(*[F.col(f"{f.name}_typed").alias(f.name) for f in schema])
    record = F.coalesce(F.col(corrupt), F.to_csv(F.struct(*[field.name for field in schema])))
    return good, judged.filter(F.size("faults") > 0).select(record.alias("record"), "faults")


def load_or_reject(spark: SparkSession, paths: dict[str, str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """All inputs with their bad rows left out, and those of all inputs: (table_name, record, faults)."""
    validate_inputs(spark, paths)
    tables, rejects = {}, []
    for table, path in paths.items():
        tables[table], bad = read_or_reject(spark, path, INPUTS[table], s.KEYS[table])
        rejects.append(bad.select(F.lit(table).alias("table_name"), "record", "faults"))
    return _with_defaults(tables), reduce(DataFrame.unionByName, rejects)


def _with_defaults(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    if "dim_customers" in tables:
        customers = tables["dim_customers"]
        tables["dim_customers"] = customers.withColumn("is_active", F.coalesce("is_active", F.lit(1)))
    return tables


def load_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """All inputs as typed frames, after checking that each is there; a bad row stops the load."""
    validate_inputs(spark, paths)
    return _with_defaults({table: read_csv(spark, path, INPUTS[table]) for table, path in paths.items()})
