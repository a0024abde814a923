"""Table metadata from the catalog: when the files behind tables and views were last written."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrid.sources.local import literal_rows

METADATA = "dataset_id string, table_id string, last_modified_time bigint"
# The list of folders is broadcast up to this many; beyond it the join is left to the optimizer.
BROADCAST_FOLDERS = 10_000


@dataclass(frozen=True)
class Base:
    """A stored relation under a table or view: its quoted name if the catalog has one, and the folders of its files."""

    name: str | None
    folders: tuple[str, ...]


def base_relations(spark: SparkSession, name: str) -> list[Base] | None:
    """The file-backed relations that a table or view reads, from its analysed plan; None if it can't be resolved.

    Views inside views, common table expressions and subqueries are followed. A table is its own base. Relations without
    files (values, ranges, other connectors) are left out.
    """
    try:
        plan = spark.table(name)._jdf.queryExecution().analyzed()
    except AnalysisException:
        return None
    found: dict[Base, None] = {}
    for part in [plan, *_each(plan.subqueriesAll())]:
        for leaf in _each(part.collectLeaves()):
            if (base := _base(spark, leaf)) is not None:
                found[base] = None
    return list(found)


def _base(spark: SparkSession, leaf: JavaObject) -> Base | None:
    kind = leaf.getClass().getSimpleName()
    if kind == "HiveTableRelation":
        held = leaf.tableMeta()
        return Base(held.identifier().quotedString(), (held.location().toString(),))
    if kind != "LogicalRelation" or leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return None
    folders = [path.toString() for path in _each(leaf.relation().location().rootPaths())]
    table = leaf.catalogTable()
    if table.isEmpty():
        return Base(None, tuple(folders))
    held = table.get()
    if held.tracksPartitionsInCatalog():
        # Partitions may lie anywhere; those below the table's folder are listed with it.
        catalog = spark._jsparkSession.sessionState().catalog()
        for partition in _each(catalog.listPartitions(held.identifier(), spark._jvm.scala.Option.empty())):
            path = spark._jvm.org.apache.hadoop.fs.Path(partition.location()).toString()
            if not any(path.startswith(f"{folder}/") for folder in folders):
                folders.append(path)
    return Base(held.identifier().quotedString(), tuple(folders))


def _each(sequence: JavaObject) -> Iterable[JavaObject]:
    return (sequence.apply(i) for i in range(sequence.size()))


def table_metadata(spark: SparkSession, schemas: Sequence[str]) -> DataFrame:
    """(dataset_id, table_id, last_modified_time in ms) of the tables and views of ``schemas`` that have files.

    The time of a table is that of its newest file, the time of a view that of the newest file of all relations it reads.
    Only names and folders go through the driver; the files of all of them are listed by one Spark read, and their contents
    are not opened. A table without files, a view over a missing table, and a schema that doesn't exist give no row. The listing is taken
    when this is called; call it again for newer times.
    """
    rows: list[tuple[str, str, str]] = []
    for schema in dict.fromkeys(schemas):
        if not spark.catalog.databaseExists(schema):
            continue
        for table in spark.catalog.listTables(schema):
            if table.isTemporary:
                continue
            bases = base_relations(spark, f"{_quoted(schema)}.{_quoted(table.name)}")
            rows += [(folder, schema, table.name) for base in bases or () for folder in base.folders if _exists(spark, folder)]
    if not rows:
        return spark.createDataFrame([], METADATA)
    folders = literal_rows(spark, ["folder", "dataset_id", "table_id"], sorted(set(rows)))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sorted({folder for folder, _, _ in rows}))
    above = F.transform(
        F.sequence(F.lit(1), F.size(F.split("path", "/")) - 1), lambda n: F.array_join(F.slice(F.split("path", "/"), 1, n), "/")
    )
    # Each folder's newest file first, so that at most one row a folder and task meets the tables.
    newest = files.select(F.explode(above).alias("folder"), "modificationTime")
    side = F.broadcast(folders) if len(rows) <= BROADCAST_FOLDERS else folders
    return (
        newest.join(side, "folder")
        .groupBy("dataset_id", "table_id")
        .agg(F.unix_millis(F.max("modificationTime")).alias("last_modified_time"))
    )


def live_metadata_select(spark: SparkSession, tables: Sequence[tuple[str, str]]) -> str:
    """A query for (dataset_id, table_id, last_modified_time) of ``tables`` (dataset_id, table_id), evaluated anew on every read.

    It asks the base tables, found now, for the times of their files; no column is read. Unlike ``table_metadata`` it can stand in
    a persistent view. Tables that don't exist now, and relations that the catalog doesn't know, are not in it.
    """
    parts = []
    for dataset, table in dict.fromkeys(tables):
        for base in base_relations(spark, f"{_quoted(dataset)}.{_quoted(table)}") or ():
            if base.name is not None:
                parts.append(
                    f"SELECT {_literal(dataset)} AS dataset_id, {_literal(table)} AS table_id, "
                    f"max(_metadata.file_modification_time) AS at FROM {base.name}"
                )
    if not parts:
        return "SELECT '' AS dataset_id, '' AS table_id, CAST(NULL AS BIGINT) AS last_modified_time WHERE false"
    every = " UNION ALL ".join(parts)
    return f"SELECT dataset_id, table_id, unix_millis(max(at)) AS last_modified_time FROM ({every}) WHERE at IS NOT NULL GROUP BY dataset_id, table_id"


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
