"""S4/S5 in a catalog: the written layers of a build as versioned tables behind stable names.

Each build is published as one version. Its files stay where the build wrote
them; the catalog gets, in a schema for each layer, an external table for each
relation of that version (``fct_trips__v00000002``) with its partitions and its
size, and a view under the relation's own name. All tables of a version are
there before the first view is moved to it, so that SQL users see whole tables
of a finished build; a query that runs meanwhile goes on with the version it
began with. Views can be moved back to an older version. A filter on
``month_key`` reaches the partitions through the view.

Relations that are not written (staging, and the intermediate ones that are
lazy) stay views of the session, see :func:`routecast.sources.sinks.register_views`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from routecast.plans.warehouse import FACT_PARTITION, MART_SORT, Warehouse
from routecast.sources import sinks

#: What a build writes, by layer, and what SQL users read of it in the catalog.
LAYERS: dict[str, dict[str, str]] = {
    "intermediate": {"int_trip_punctuality": "One row per executed trip with its schedule, delays, incidents and vehicle context"},
    "marts": {
        "dim_routes": "One row per route",
        "dim_vehicles": "One row per vehicle",
        "dim_date": "One row per day of the calendar",
        "dim_delay_categories": "One row per delay category",
        "fct_trips": "One row per completed trip: passengers and occupancy",
        "fct_revenue": "One row per booking: passengers and fare",
        "fct_punctuality": "One row per executed trip: delays, SLA, risk and cost",
        "feedback": "One row per customer feedback event, in typed columns",
    },
}
_VERSION = "__v"


@dataclass(frozen=True)
class Published:
    """A version in the catalog: the view of each relation."""

    version: int
    views: dict[str, str]


def _quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


def _schemas(schemas: dict[str, str | None] | None) -> dict[str, str]:
    """The schema of each layer: the configured one, or one named as the layer."""
    return {layer: sinks.schema_name((schemas or {}).get(layer), layer) for layer in LAYERS}


def versions(spark: SparkSession, schemas: dict[str, str | None] | None = None) -> list[int]:
    """The versions whose tables are all there, oldest first."""
    found: dict[int, set[str]] = {}
    for layer, schema in _schemas(schemas).items():
        if not spark.catalog.databaseExists(_quoted(schema)):
            continue
        for row in spark.sql(f"SHOW TABLES IN {_quoted(schema)} LIKE '*{_VERSION}*'").collect():
            name, _, number = row.tableName.rpartition(_VERSION)
            if name in LAYERS[layer] and number.isdigit():
                found.setdefault(int(number), set()).add(name)
    return sorted(v for v, names in found.items() if len(names) == sum(map(len, LAYERS.values())))


def _table(name: str, version: int) -> str:
    return f"{name}{_VERSION}{version:08d}"


def _register(spark: SparkSession, wh: Warehouse, layer: str, schema: str, name: str, version: int) -> None:
    """One relation of a version as an external table with its partitions and size."""
    table, path = _quoted(schema, _table(name, version)), sinks.layer_path(wh.store, layer, name)
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in getattr(wh, name).schema)
    partitions = f"PARTITIONED BY ({', '.join(map(_quoted, FACT_PARTITION))})" if name in MART_SORT else ""
    # What a publication that was cut off has left is made anew. The files of an external table stay.
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {partitions} LOCATION '{path}' COMMENT '{LAYERS[layer][name]}'")
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    # Sizes by listing, without a scan: joins of catalog tables broadcast by them.
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")


def publish(wh: Warehouse, schemas: dict[str, str | None] | None = None, keep: int = 2) -> Published:
    """Makes a build the current version of the catalog's layers.

    ``schemas`` names the schema of a layer; others are named as the layer.
    ``wh`` must have been built with a ``store`` that outlives the catalog
    entry; each build should have its own folder, since versions of one folder
    have the same files. The last ``keep`` versions stay in the catalog, older
    tables are dropped there; their files are the caller's to remove. One
    publication at a time; one that is cut off leaves the views as they were,
    unless it was moving them, and the next one makes its version whole."""
    if not wh.store:
        raise ValueError("only a warehouse that was built with a store can be published")
    if keep < 1:
        raise ValueError("at least the published version has to be kept")
    spark = wh.dim_date.sparkSession
    old = versions(spark, schemas)
    version = 1 + max(old, default=0)
    for layer, schema in _schemas(schemas).items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(schema)}")
        for name in LAYERS[layer]:
            _register(spark, wh, layer, schema, name, version)
    done = show_version(spark, version, schemas)
    for layer, schema in _schemas(schemas).items():
        for gone in old[: max(0, len(old) + 1 - keep)]:
            for name in LAYERS[layer]:
                spark.sql(f"DROP TABLE IF EXISTS {_quoted(schema, _table(name, gone))}")
    return done


def show_version(spark: SparkSession, version: int, schemas: dict[str, str | None] | None = None) -> Published:
    """Moves the views to a version that is in the catalog: the newest one, or an older one to go back."""
    if version not in versions(spark, schemas):
        raise ValueError(f"version {version} is not in the catalog")
    views = {}
    for layer, schema in _schemas(schemas).items():
        for name in LAYERS[layer]:
            table, views[name] = _quoted(schema, _table(name, version)), _quoted(schema, name)
            columns = ", ".join(_quoted(c) for c in spark.table(table).columns)
            spark.sql(f"CREATE OR REPLACE VIEW {views[name]} COMMENT '{LAYERS[layer][name]}' AS SELECT {columns} FROM {table}")
    return Published(version, views)
