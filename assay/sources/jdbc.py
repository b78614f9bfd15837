"""Tables of another database by JDBC, read by many tasks at once."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that one task reads, about; how many tasks read a table at most, so many connections there are.
ROWS_A_TASK, MOST_TASKS = 500_000, 64


def sql_server_url(server: str, database: str, encrypt: bool = True, trust: bool = False) -> str:
    """The address of a SQL Server database; a named instance is `host\\\\instance`."""
    return f"jdbc:sqlserver://{server};databaseName={database};encrypt={str(encrypt).lower()};trustServerCertificate={str(trust).lower()}"


def _options(url: str, options: dict[str, str] | None) -> dict[str, str]:
    return {"url": url, "fetchsize": "10000"} | (options or {})


def bounds(spark: SparkSession, url: str, table: str, column: str, options: dict[str, str] | None = None) -> tuple:
    """(least, most, rows) of a numeric or date column; asked of the database, which sends one row."""
    asked = f"(SELECT MIN({column}) AS least, MAX({column}) AS most, COUNT(*) AS n FROM {table}) b"
    row = spark.read.format("jdbc").options(**_options(url, options), dbtable=asked).load().first()
    return row[0], row[1], int(row[2])


def ranges(column: str, edges: Sequence) -> list[str]:
    """Conditions that part rows by ascending edges: each row meets exactly one, a null the first."""
    if not edges:
        return ["1 = 1"]
    written = [str(e) if isinstance(e, (int, float)) else "'" + str(e).replace("'", "''") + "'" for e in edges]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(written, written[1:])]
    return [f"{column} < {written[0]} OR {column} IS NULL", *inner, f"{column} >= {written[-1]}"]


def remainders(number: str, parts: int) -> list[str]:
    """Conditions that part rows by a whole-number expression of the database (a column, or such as a
    hash of a text); negative numbers and nulls included."""
    if parts <= 1:
        return ["1 = 1"]
    rest = f"ABS(MOD({number}, {parts}))"
    return [f"{rest} = 0 OR {number} IS NULL", *[f"{rest} = {i}" for i in range(1, parts)]]


def read_partitioned(
    spark: SparkSession, url: str, table: str, column: str | None = None, predicates: Sequence[str] | None = None,
    options: dict[str, str] | None = None, rows_a_task: int = ROWS_A_TASK, most_tasks: int = MOST_TASKS,
) -> DataFrame:
    """A table, a task for each part of it; columns and filters that a query needs go to the database.

    column: a whole-number key by whose range the parts are cut, evenly between its least and
    most; predicates: the parts as conditions instead, of which each row must meet one (ranges()
    and remainders() make such). With neither, or for an empty or small table, one task reads all.
    """
    given = _options(url, options)
    if predicates is None and column is not None:
        least, most, n = bounds(spark, url, table, column, options)
        parts = 0 if least is None else min(most_tasks, -(-n // rows_a_task), int(most) - int(least) + 1)
        predicates = ranges(column, [int(least) + (int(most) - int(least) + 1) * i // parts for i in range(1, parts)]) if parts > 1 else None
    if not predicates:
        return spark.read.format("jdbc").options(**given, dbtable=table).load()
    properties = {k: v for k, v in given.items() if k != "url"}
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)


def inventory(spark: SparkSession, url: str, listing: str, options: dict[str, str] | None = None) -> DataFrame:
    """What a query of the database's catalog lists, such as its tables, in lower case by name."""
    found = spark.read.format("jdbc").options(**_options(url, options), query=listing).load()
    return found.select(*[F.col(c).alias(c.lower()) for c in found.columns])


# ------------------------------------------------------------------ a database as one file


def _line(df: DataFrame) -> Column:
    """A row as a line to be loaded: texts quoted, their quotes doubled, null without quotes."""
    cells = []
    for c, kind in df.dtypes:
        text = F.col(f"`{c}`").cast("string")
        cells.append(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')) if kind == "string" else text)
    return F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in cells])


def packed(df: DataFrame, table: str, types: dict[str, str], folder: str) -> str:
    """The address of a read-only Derby database that holds df as one table; types are its columns' SQL types.

    One process at a time may write a Derby database, so executors can't insert side by side: they
    write lines, and the database, booted where this is called, loads these file by file into files
    of its own. Packed (uncompressed, so that a page is found at once) into a jar in the folder, which
    all machines must see as a local path, it is read by as many processes as there are.
    """
    spark = df.sparkSession
    if re.match("[a-z0-9]{2,}:", folder) and not folder.startswith("file:"):
        raise ValueError(f"{folder}: Derby opens local files only")
    place = unquote(re.sub("^file:/+", "/", folder)) if folder.startswith("file:") else folder
    df.select(_line(df).alias("value")).write.text(f"{folder}/lines")
    connect = spark._jvm.java.sql.DriverManager.getConnection
    with tempfile.TemporaryDirectory(prefix="assay-") as own:
        base = Path(own).resolve() / "db"
        link = connect(f"jdbc:derby:{base};create=true")
        try:
            run = link.createStatement()
            run.execute(f"CREATE TABLE {table} ({', '.join(f'{c} {types[c]}' for c in df.columns)})")
            for part in sorted(Path(place, "lines").glob("part-*")):
                if part.stat().st_size:
                    run.execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE(NULL, '{table.upper()}', '{str(part).replace("'", "''")}', ',', '\"', 'UTF-8', 0)")
            run.close()
        finally:
            link.close()
            try:
                connect(f"jdbc:derby:{base};shutdown=true")
            except Py4JJavaError:  # how Derby says that it is down
                pass
        with zipfile.ZipFile(Path(place, "db.jar"), "w", zipfile.ZIP_STORED) as jar:
            for file in sorted(x for x in base.rglob("*") if x.is_file()):
                jar.write(file, f"db/{file.relative_to(base)}")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/lines")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return f"jdbc:derby:jar:({Path(place, 'db.jar')})db"
