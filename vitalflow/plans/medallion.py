"""The batch run over a lake: staging files to Bronze, Silver, Gold and the wide table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from .. import schemas as S
from ..operators import gold as G
from ..operators import quality, silver
from ..sources.delimited import load_csv, split_corrupt
from ..sources.tables import Lake

STAGING, BRONZE, SILVER, GOLD = "staging", "bronze", "silver", "gold"
OBT = "obt_patient_encounters"


def stage_files(lake: Lake, folder: str) -> None:
    """Load the nine CSV files; malformed lines go to `<entity>_rejected`."""
    for entity in S.ENTITIES:
        rows = load_csv(lake.spark, f"{folder.rstrip('/')}/{entity}.csv", S.RAW_SCHEMAS[entity])
        # parsed once; both parts are cut from what was written
        lake.write(rows, STAGING, f"{entity}_parsed")
        good, bad = split_corrupt(lake.read(STAGING, f"{entity}_parsed"))
        lake.write(good, STAGING, entity)
        lake.write(bad, STAGING, f"{entity}_rejected")


def run_bronze(lake: Lake, source: str, as_of: str | None = None) -> None:
    for entity in S.ENTITIES:
        lake.write(silver.bronze_stamp(lake.read(STAGING, entity), source, as_of), BRONZE, f"{entity}_bronze")


def run_silver(lake: Lake, as_of: str | None = None) -> None:
    for entity in S.ENTITIES:
        cleaned = G.SILVER_FROM_BRONZE[entity](lake.read(BRONZE, f"{entity}_bronze"), as_of)
        lake.write(cleaned, SILVER, f"{entity}_silver")


def run_gold(lake: Lake, silver_final: bool = False) -> None:
    """Publish Gold. `silver_final` also keeps the pruned Silver: in a versioned lake in place of
    Silver, else under a name of its own, since a table must not be overwritten while it is read."""
    for entity in S.ENTITIES:
        source = lake.read(SILVER, f"{entity}_silver")
        lake.write(G.GOLD_FROM_SILVER[entity](source), GOLD, f"{entity}_gold")
        if silver_final and entity != "observations":
            final = f"{entity}_silver" if lake.versioned else f"{entity}_silver_final"
            lake.write(G.GOLD_FROM_SILVER[entity](source), SILVER, final)
    lake.write(wide_table(gold_tables(lake)), GOLD, OBT)


def publish_realtime(lake: Lake, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Store the realtime tables beside Gold, in a bucketed lake by patient as Gold is."""
    for name, rows in tables.items():
        lake.write(rows, GOLD, name.lower())
    return {name: lake.read(GOLD, name.lower()) for name in tables}


def gold_tables(lake: Lake) -> dict[str, DataFrame]:
    """Those Gold tables that exist, by entity."""
    names = [e for e in S.ENTITIES if lake.exists(GOLD, f"{e}_gold")]
    return {e: lake.read(GOLD, f"{e}_gold") for e in names}


def wide_table(gold: Mapping[str, DataFrame]) -> DataFrame:
    return G.obt_patient_encounters(
        gold["encounters"], gold["patients"], gold["observations"], gold["conditions"], gold["medications"]
    )


def report(lake: Lake, layer: str) -> DataFrame:
    """Row and column counts of a layer, with the metadata check in Bronze."""
    tables = {f"{e}_{layer}": lake.read(layer, f"{e}_{layer}") for e in S.ENTITIES}
    return quality.layer_report(tables, S.BRONZE_METADATA if layer == BRONZE else ())
