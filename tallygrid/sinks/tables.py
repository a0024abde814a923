"""Full replacement of stored tables and views.

In a catalog that can't replace a table in one step, a replaced table is an external one over a folder of its
own *version*: ``<the table's usual folder>__versions/<version>``. A replacement writes a new version
beside the old one and then points the table at it, which is one change of the catalog. Partitions are found in the
folder and not listed in the catalog, so they move with it. The version's name is the token by which
two replacements that run at once notice each other.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_FAILURES = (PySparkException, Py4JJavaError)
#: A replacement that has held its claim for so long is taken for dead.
CLAIM_SECONDS = 6 * 3600
_PARTITIONS_IN_CATALOG = "spark.sql.hive.manageFilesourcePartitions"


class ConcurrentReplacement(RuntimeError):
    """The table was replaced by someone else since this replacement began; nothing was changed."""


@dataclass(frozen=True)
class _Stored:
    """What the catalog says of a table."""

    schema: str
    provider: str
    partitions: tuple[str, ...]
    location: str
    properties: tuple[tuple[str, str], ...]


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Replaces ``table`` by the result of ``df``, which may itself read ``table``.

    A catalog that can replace a table in one step does so. Elsewhere format, partition columns and properties of
    the old table are kept (``partition_by`` counts for a new one), rows are written to a new version, and the table
    is pointed at it; readers find the old rows or the new ones. Where columns or their order
    change, or the old table wasn't written by this function, the new one is made under another name and the two change
    names instead; readers then find no table for a moment, and after a driver lost just there the old one is
    the table named ``..__old_..``.

    The version before is kept for readers that have begun, older ones go. A failed replacement leaves the old table as
    it was, and neither files nor tables of its own. Of replacements that began with the same version one wins; the
    others raise ``ConcurrentReplacement``. Dropping such a table leaves its versions on disk, as with any external table.
    """
    spark = df.sparkSession
    parts = _parts(spark, table)
    if _replaces_in_one_step(spark, parts):
        writer = df.writeTo(_quoted(parts))
        (writer.partitionedBy(*partition_by) if partition_by else writer).createOrReplace()
        return
    target = _quoted(parts)
    old = _stored(spark, target)
    provider = old.provider if old else spark.conf.get("spark.sql.sources.default")
    wanted = old.partitions if old else tuple(partition_by)
    partitions = [c for c in wanted if c in df.columns]
    base = _versions(spark, target)
    folder = f"{base}/{uuid.uuid4().hex}"
    try:
        df.write.format(provider).partitionBy(*partitions).save(folder)
    except BaseException:
        _delete(spark, folder)
        raise
    ordered = df.select(*[c for c in df.columns if c not in partitions], *partitions)
    schema = ordered._jdf.schema().asNullable().toDDL()
    try:
        with _claimed(spark, base, old.location if old else "none"):
            now = _stored(spark, target)
            if (now and now.location) != (old and old.location):
                raise ConcurrentReplacement(f"{table} was replaced while its new rows were written")
            past = _past(spark, base, {folder, old.location if old else folder})
            if old and old.location.startswith(f"{base}/") and (old.schema, list(old.partitions)) == (schema, partitions):
                spark.sql(f"ALTER TABLE {target} SET LOCATION {_literal(folder)}")
            else:
                _change_names(spark, parts, old, schema, provider, partitions, folder)
    except BaseException:
        if (left := _stored(spark, target)) is None or left.location != folder:
            _delete(spark, folder)
        raise
    spark.catalog.refreshTable(target)
    for version in past:
        _delete(spark, version.toString())


def replace_view(spark: SparkSession, view: str, query: str) -> None:
    """Replaces the persistent ``view``; it is evaluated anew on every read."""
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(_parts(spark, view))} AS {query}")


def _change_names(
    spark: SparkSession, parts: Sequence[str], old: _Stored | None, schema: str, provider: str, partitions: Sequence[str], folder: str
) -> None:
    target, mark = _quoted(parts), uuid.uuid4().hex
    if old is None:
        _create(spark, target, schema, provider, partitions, folder)
        return
    staging, aside = (_quoted([*parts[:-1], f"{parts[-1]}__{kind}_{mark}"]) for kind in ("staging", "old"))
    try:
        _create(spark, staging, schema, provider, partitions, folder)
        if old.properties:
            text = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in old.properties)
            spark.sql(f"ALTER TABLE {staging} SET TBLPROPERTIES ({text})")
        spark.sql(f"ALTER TABLE {target} RENAME TO {aside}")
    except BaseException:
        _drop(spark, staging)
        raise
    try:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {target}")
    except BaseException:
        spark.sql(f"ALTER TABLE {aside} RENAME TO {target}")
        _drop(spark, staging)
        raise
    spark.sql(f"DROP TABLE {aside}")


def _create(spark: SparkSession, name: str, schema: str, provider: str, partitions: Sequence[str], folder: str) -> None:
    by = f"PARTITIONED BY ({', '.join(_quoted([c]) for c in partitions)})" if partitions else ""
    before = spark.conf.get(_PARTITIONS_IN_CATALOG)
    spark.conf.set(_PARTITIONS_IN_CATALOG, "false")
    try:
        spark.sql(f"CREATE TABLE {name} ({schema}) USING {provider} {by} LOCATION {_literal(folder)}")
    finally:
        spark.conf.set(_PARTITIONS_IN_CATALOG, before)


def _stored(spark: SparkSession, target: str) -> _Stored | None:
    if not spark.catalog.tableExists(target):
        return None
    state = spark._jsparkSession.sessionState()
    held = state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(target))
    partitions = [held.partitionColumnNames().apply(i) for i in range(held.partitionColumnNames().size())]
    described = spark.sql(f"SHOW TBLPROPERTIES {target}").collect()
    made_by_spark = ("transient_", "spark.sql.", "numFiles", "totalSize")
    properties = sorted((r.key, r.value) for r in described if not r.key.startswith(made_by_spark))
    provider = held.provider()
    return _Stored(
        held.schema().asNullable().toDDL(),
        provider.get() if provider.isDefined() else spark.conf.get("spark.sql.sources.default"),
        tuple(partitions),
        _path(spark, held.location().toString()).toString(),
        tuple(properties),
    )


def _versions(spark: SparkSession, target: str) -> str:
    """The folder that holds the versions of a table, beside the one it would have as a managed table."""
    state = spark._jsparkSession.sessionState()
    usual = state.catalog().defaultTablePath(state.sqlParser().parseTableIdentifier(target))
    return _path(spark, usual.toString().rstrip("/") + "__versions").toString()


@contextmanager
def _claimed(spark: SparkSession, base: str, version: str):
    """Holds the only claim to replace ``version``: a file that only one can create."""
    claim = _path(spark, f"{base}/_claim_{version.rsplit('/', 1)[-1]}")
    files = _files(spark, claim)
    if files.exists(claim) and time.time() * 1000 - files.getFileStatus(claim).getModificationTime() > CLAIM_SECONDS * 1000:
        files.delete(claim, False)
    try:
        won = files.createNewFile(claim)
    except Py4JJavaError:
        won = False
    if not won:
        raise ConcurrentReplacement(f"another replacement of version {version} is under way")
    try:
        yield
    finally:
        files.delete(claim, False)


def _past(spark: SparkSession, base: str, kept: set[str]) -> list[JavaObject]:
    """The versions there are now that no reader needs: those whose writer has ended, or is taken for dead.

    Asked before the table is pointed at a new version, so that whoever wrote one of them began too early to win.
    """
    folder = _path(spark, base)
    files = _files(spark, folder)
    dead = time.time() * 1000 - CLAIM_SECONDS * 1000
    versions = [s for s in files.listStatus(folder) if s.isDirectory() and s.getPath().toString() not in kept]
    return [s.getPath() for s in versions if files.exists(s.getPath().suffix("/_SUCCESS")) or s.getModificationTime() < dead]


def _path(spark: SparkSession, text: str) -> JavaObject:
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path)


def _files(spark: SparkSession, path: JavaObject) -> JavaObject:
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _delete(spark: SparkSession, folder: str) -> None:
    try:
        path = _path(spark, folder)
        _files(spark, path).delete(path, True)
    except _FAILURES:
        pass  # what failed first is what the caller should see


def _drop(spark: SparkSession, table: str) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    except _FAILURES:
        pass  # as above


def _parts(spark: SparkSession, name: str) -> list[str]:
    """The parts of a name as SQL reads it, quotes removed."""
    found = spark._jsparkSession.sessionState().sqlParser().parseMultipartIdentifier(name)
    return [found.apply(i) for i in range(found.size())]


def _quoted(parts: Sequence[str]) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in parts)


def _replaces_in_one_step(spark: SparkSession, parts: Sequence[str]) -> bool:
    """Whether the catalog that the name resolves to stages replacements."""
    manager = spark._jsparkSession.sessionState().catalogManager()
    named = len(parts) > 1 and (parts[0] == "spark_catalog" or manager.isCatalogRegistered(parts[0]))
    catalog = manager.catalog(parts[0]) if named else manager.currentCatalog()
    staging = spark._jvm.java.lang.Class.forName(
        "org.apache.spark.sql.connector.catalog.StagingTableCatalog", False, catalog.getClass().getClassLoader()
    )
    return bool(staging.isInstance(catalog))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
