"""S4/S5 in a catalog: versions of a build behind stable views."""

from __future__ import annotations

import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from routecast.plans import catalog
from routecast.plans.warehouse import build_warehouse
from routecast.session import scratch_dir
from routecast.sources import testdata


@pytest.fixture(scope="module")
def schemas(spark):
    tag = uuid.uuid4().hex
    names = {layer: f"{layer}_{tag}" for layer in catalog.LAYERS}
    yield names
    for name in names.values():
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def _same(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_published_tables_equal_the_build_and_versions_can_go_back(spark, wh, schemas):
    first = catalog.publish(wh, schemas)
    assert first.version == 1 and set(first.views) == {n for t in catalog.LAYERS.values() for n in t}
    for name, view in first.views.items():
        shown = spark.table(view)
        assert sorted(shown.columns) == sorted(getattr(wh, name).columns)
        assert _same(shown.select(*getattr(wh, name).columns), getattr(wh, name)), name

    # A second build without a month of trips, in a folder of its own; an empty fact has no files and can be published too.
    raw = testdata.bind(spark, "/root/testdata/sf0.001")
    kept = raw.trips.filter(F.year("departure_datetime") != 1996)
    fewer = replace(raw, trips=kept, bookings=raw.bookings.limit(0))
    other = build_warehouse(spark, fewer, testdata.DATE_START, testdata.DATE_END, f"{scratch_dir(spark)}/second-{uuid.uuid4().hex}")
    before = spark.table(first.views["fct_trips"])
    n_before = before.count()
    second = catalog.publish(other, schemas)
    assert second.version == 2 and second.views == first.views and catalog.versions(spark, schemas) == [1, 2]
    assert spark.table(first.views["fct_trips"]).count() == other.fct_trips.count() < n_before
    assert spark.table(first.views["fct_revenue"]).count() == 0
    # A plan that was made of the first version still reads it.
    assert before.count() == n_before

    catalog.show_version(spark, 1, schemas)
    assert spark.table(first.views["fct_trips"]).count() == n_before
    # The third version leaves two; the first is gone from the catalog and its files are not.
    catalog.publish(wh, schemas)
    assert catalog.versions(spark, schemas) == [2, 3]
    assert wh.fct_trips.count() == n_before
    with pytest.raises(ValueError):
        catalog.show_version(spark, 1, schemas)


def test_months_are_pruned_through_the_view(spark, wh, schemas):
    view = catalog.publish(wh, schemas).views["fct_trips"]
    plan = spark.table(view).filter("month_key = 199603").select("trip_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan and "199603" in plan
    size = spark.sql(f"DESCRIBE EXTENDED `{schemas['marts']}`.`dim_date__v{catalog.versions(spark, schemas)[-1]:08d}`").where("col_name = 'Statistics'").collect()
    assert "bytes" in size[0].data_type


def test_an_unfinished_version_is_made_anew(spark, wh, schemas):
    now = catalog.publish(wh, schemas).version
    # As left by a publication that was cut off: one table of the next version.
    spark.sql(f"CREATE TABLE `{schemas['marts']}`.`dim_date__v{now + 1:08d}` (x INT) USING parquet")
    assert catalog.versions(spark, schemas)[-1] == now
    assert catalog.publish(wh, schemas).version == now + 1
    with pytest.raises(ValueError):
        catalog.publish(replace(wh, store=None), schemas)
    with pytest.raises(ValueError):
        catalog.publish(wh, schemas, keep=0)
