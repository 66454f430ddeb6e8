"""SQL kept in files: run it, read its result, or insert a frame with it."""

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def run_sql_file(spark: SparkSession, path: str, args: dict | None = None) -> None:
    """Run a statement for its effect, for example CREATE TABLE AS or INSERT."""
    spark.sql(Path(path).read_text(), args=args)


def sql_file_frame(spark: SparkSession, path: str, args: dict | None = None) -> DataFrame:
    """The result of a query; `args` bind its :name markers."""
    return spark.sql(Path(path).read_text(), args=args)


def insert_frame(spark: SparkSession, path: str, rows: DataFrame, args: dict | None = None) -> None:
    """Run an INSERT whose SELECT reads {rows}: one statement for the whole frame."""
    spark.sql(Path(path).read_text(), args=args, rows=rows)


def append_rows(rows: DataFrame, table: str) -> None:
    """Append by column name to a catalog table."""
    rows.select(*rows.sparkSession.table(table).columns).write.insertInto(table)


def transform_by_name(spark: SparkSession, directory: str, table: str, args: dict | None = None) -> DataFrame:
    """Run <directory>/<table>.sql; a missing file is an error that names the table."""
    path = Path(directory) / f"{table}.sql"
    if not path.is_file():
        raise FileNotFoundError(f"no SQL file for table {table}: {path}")
    return sql_file_frame(spark, str(path), args)
