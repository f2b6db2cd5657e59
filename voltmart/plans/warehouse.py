"""The daily warehouse run: extract, core, mart, export, audit."""

from __future__ import annotations

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from voltmart.operators import mart, meta
from voltmart.operators.core import core_layer
from voltmart.schemas import EXTRACTS, MART_TABLES, TABLES
from voltmart.sources.export import export_csv, export_name
from voltmart.sources.extract import conform, full_load
from voltmart.sources.store import LayerStore, Version

RUN_NAME = "warehouse_daily"


# The time column each stored table is ordered by.
ORDER: dict[str, dict[str, str]] = {
    **{f"raw_{s}": {t: TABLES[t].bookmark for t in tables} for s, tables in EXTRACTS.items()},
    "core": {t: spec.bookmark for t, spec in TABLES.items()},
    "mart": {"fct_rentals": "started_at", "fct_payments": "created_at"},
}


def extract_source(
    store: LayerStore,
    source: str,
    tables: dict[str, DataFrame],
    version: str,
    as_of: str,
    absent: tuple[str, ...] = (),
) -> Version:
    """Replace one raw layer by the full content of its source service.

    A table of the extract set that the source lacks is an error, unless it is named ``absent``.
    """
    layer = f"raw_{source}"
    loads = {t: full_load(tables[t], TABLES[t].schema, as_of) for t in EXTRACTS[source] if t in tables}
    return store.publish(layer, version, loads, as_of, ORDER[layer], absent)


def extract_increment(
    store: LayerStore, source: str, tables: dict[str, DataFrame], version: str, as_of: str
) -> Version:
    """A new version of a raw layer from the current one and the rows since its stored bookmarks.

    Without bookmarks this is a full load. A row that changes without moving its bookmark column
    is not seen (a rental's end leaves its start as it was); such tables need the full load.
    """
    layer = f"raw_{source}"
    marks = {r["entity"]: r["watermark_value"] for r in store.read("meta", "etl_watermark").collect()}
    merged = {}
    for t in EXTRACTS[source]:
        spec = TABLES[t]
        if t not in tables:
            raise ValueError(f"{layer} lacks {t}")
        since = meta.rows_since(tables[t], spec.bookmark, marks.get(f"{layer}.{t}"))
        loaded = full_load(since, spec.schema, as_of)
        merged[t] = meta.merge_latest(store.read(layer, t), conform(loaded, spec.schema), spec.key, spec.bookmark)
    return store.publish(layer, version, merged, as_of, ORDER[layer])


def build_core(store: LayerStore, version: str, as_of: str, raw: dict[str, Version]) -> Version:
    """Core from exactly the raw versions given."""
    layers = {layer: store.read_layer(layer, raw[layer].folder) for layer in ("raw_rental", "raw_billing")}
    return store.publish("core", version, core_layer(layers), as_of, ORDER["core"], ranged=tuple(TABLES))


def build_mart(store: LayerStore, version: str, as_of: str, core_version: Version) -> Version:
    core = store.read_layer("core", core_version.folder)
    tables = {
        "fct_rentals": mart.fct_rentals(core["rentals"]),
        "fct_payments": mart.fct_payments(core["payment_attempts"]),
        # One row per day, aggregated first; the small result is one file.
        "kpi_daily": mart.kpi_daily(core["quotes"], core["rentals"], core["payment_attempts"]).repartition(1),
    }
    return store.publish("mart", version, tables, as_of, ORDER["mart"], ranged=tuple(ORDER["mart"]))


def export_mart(store: LayerStore, folder: str, as_of: str, version: Version) -> list[str]:
    tables = store.read_layer("mart", version.folder)
    return [export_csv(tables[t], f"{folder}/{export_name('mart', t, as_of)}") for t in MART_TABLES]


def bookmarks(raw: dict[str, dict[str, DataFrame]], now: str) -> DataFrame:
    """Bookmark of every raw table that has rows."""
    rows = [
        meta.watermark_row(raw[spec.raw_layer][t], f"{spec.raw_layer}.{t}", spec.bookmark, now)
        for t, spec in TABLES.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def publish_meta(store: LayerStore, version: str, as_of: str, raw: dict[str, Version]) -> Version:
    """Current bookmarks and run audit as a version of the meta layer."""
    layers = {layer: store.read_layer(layer, v.folder) for layer, v in raw.items()}
    tables = {"etl_watermark": bookmarks(layers, as_of), "etl_run_audit": read_audit(store.spark, store.root)}
    return store.publish("meta", version, {t: df.repartition(1) for t, df in tables.items()}, as_of)


def run_warehouse(
    spark: SparkSession,
    sources: dict[str, dict[str, DataFrame]],
    root: str,
    run_id: str,
    as_of: str,
    export_to: str | None = None,
    finished_at: str | None = None,
    incremental: bool = False,
) -> dict[str, dict[str, int]]:
    """Both extracts side by side, then core, then mart, then export, then meta.

    ``run_id`` names the versions and ``as_of`` stamps the rows, so a rerun gives the same data.
    Each step reads the version that the step before has just committed, also in a backfill. The
    audit log gets an opening and a terminal row; the latter is stamped ``finished_at``, or the
    time it is written. ``incremental`` extracts the rows since the bookmarks of the last run.
    """
    extract = extract_increment if incremental else extract_source
    store = LayerStore(spark, root)
    store.bootstrap()
    audit = f"{store.root}/_audit_log"
    opening = meta.run_started(spark, run_id, RUN_NAME, as_of)
    opening.write.mode("append").parquet(audit)
    done: dict[str, Version] = {}
    status = "FAILED"
    try:
        with ThreadPoolExecutor(max_workers=2) as pool:
            jobs = {
                s: pool.submit(extract, store, s, sources.get(s, {}), run_id, as_of) for s in EXTRACTS
            }
            for s, job in jobs.items():
                done[f"raw_{s}"] = job.result()
        raw = dict(done)
        done["core"] = build_core(store, run_id, as_of, raw)
        done["mart"] = build_mart(store, run_id, as_of, done["core"])
        if export_to:
            export_mart(store, export_to, as_of, done["mart"])
        status = "SUCCESS"
    finally:
        counts = {layer: v.rows for layer, v in done.items()}
        stamp = finished_at or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        closing = meta.run_finished(opening, stamp, status, json.dumps(counts, sort_keys=True))
        closing.write.mode("append").parquet(audit)
    publish_meta(store, run_id, as_of, raw)
    return counts


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return meta.latest_runs(spark.read.parquet(f"{root.rstrip('/')}/_audit_log"))
