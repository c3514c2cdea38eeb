"""The whole run: landed files to bronze, silver, gold, checks."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodledger.plans import condensed, dims, facts, merge, quality
from floodledger.plans.layers import Silver, Star, read_layer, read_table
from floodledger.plans.silver import ENTITIES
from floodledger.schemas import BUCKET, ref_flood_zone_info, ref_state_info
from floodledger.session import at_once
from floodledger.sources.landing import (
    FILE,
    LOAD,
    MAX_BAD_ROWS,
    REJECTED,
    as_path,
    first_lines,
    land_lines,
    list_files,
    read_bronze,
    unseen_files,
)
from floodledger.sources.sinks import exists, overwrite, remove, switch

#: Names of loads begin so: those that replace a table, and those that add files to it.
FULL = "full"
NEW = "new"


@dataclass
class Result:
    """Where the layers are, what was written, and the check results."""

    path: str
    rows: dict[str, int] = field(default_factory=dict)
    bronze: dict[str, DataFrame] = field(default_factory=dict)
    silver: Silver | None = None
    star: Star | None = None
    checks: DataFrame | None = None


def bronze_path(out: str, entity: str) -> str:
    return f"{out}/bronze/{entity}_raw"


def land_files(
    spark: SparkSession,
    source: str,
    out: str,
    entity: str,
    limit: int = MAX_BAD_ROWS,
    only_new: bool = False,
    kind: str = "csv",
) -> dict[str, int]:
    """Files of one entity to its bronze table, in one pass over the text.

    ``kind`` is csv, json (a file is one page) or jsonl (a line is one page). CSV columns are taken
    by name from the header of each file. Malformed lines or pages go to a partition of their own; too many of them in a file fail the load. A load is written beside the table and
    takes its place after the check, so a failed load changes nothing. A full load replaces all
    earlier loads, those of streams included. With ``only_new`` the files that earlier loads took in as
    they are now are left out without being opened, and the others, changed ones included, are added
    as a load of their own: the newest row of a key counts.
    """
    path, ledger = bronze_path(out, entity), f"{out}/landed_files/{entity}"
    only_new = only_new and exists(spark, path)
    if only_new:
        files = unseen_files(spark, source, path, ledger, loads(spark, out, entity))
    else:
        files = list_files(spark, source)
    # the list of files is fixed before they are read: one that comes meanwhile belongs to the next load
    listed = [tuple(row) for row in files.select(FILE, "length", "changed").collect()]
    lines = first_lines(spark, [as_path(row[0]) for row in listed]) if listed else {}
    if not lines:
        if only_new:
            return {f"{entity}_raw": 0, f"{entity}_rejected": 0}
        raise FileNotFoundError(f"no files with text in {source}")
    name = f"{NEW if only_new else FULL}-{uuid.uuid4().hex}"
    good, bad = land_lines(spark, lines, path, entity, name, limit, kind, whole=not only_new)
    if not only_new:
        remove(spark, ledger)
    noted = spark.createDataFrame(listed, f"{FILE} string, length bigint, changed timestamp")
    overwrite(noted, f"{ledger}/{LOAD}={name}")
    return {f"{entity}_raw": good, f"{entity}_rejected": bad}


def land_csv(
    spark: SparkSession, source: str, out: str, entity: str, limit: int = MAX_BAD_ROWS, only_new: bool = False
) -> dict[str, int]:
    """``land_files`` for CSV."""
    return land_files(spark, source, out, entity, limit, only_new)


def land_table(df: DataFrame, out: str, entity: str, only_new: bool = False) -> dict[str, int]:
    """A table that has the bronze columns already, as the bronze table or as a further load of it."""
    path, name = bronze_path(out, entity), f"{NEW if only_new else FULL}-{uuid.uuid4().hex}"
    if only_new and exists(df.sparkSession, path):
        return {f"{entity}_raw": overwrite(df.withColumn(REJECTED, F.lit(0)), f"{path}/{LOAD}={name}", [REJECTED])}
    landed = df.withColumns({LOAD: F.lit(name), REJECTED: F.lit(0)})
    return {f"{entity}_raw": overwrite(landed, path, [LOAD, REJECTED])}


def loads(spark: SparkSession, out: str, entity: str) -> set[str]:
    """Names of the loads in a bronze table: as many as there were loads and stream batches."""
    table = spark.read.schema(f"{LOAD} string, {REJECTED} int").parquet(bronze_path(out, entity))
    return {row[LOAD] for row in table.select(LOAD).distinct().collect()}


def build_silver(
    bronze: dict[str, DataFrame],
    out: str,
    states: DataFrame | None = None,
    zones: DataFrame | None = None,
    entities: Iterable[str] = tuple(ENTITIES),
    buckets: int | None = None,
) -> tuple[Silver, dict[str, int]]:
    """Clean the entities and write them, in buckets of their keys, with the reference tables."""
    spark = bronze["claims"].sparkSession
    buckets = buckets or merge.default_buckets(spark)
    path = f"{out}/silver"
    rebuild = lambda e: lambda: merge.rebuild(bronze[e], f"{path}/{e}_cleaned", e, buckets)
    rows = at_once(spark, {f"{e}_cleaned": rebuild(e) for e in entities})
    return _with_references(spark, path, states, zones, rows)


def _with_references(
    spark: SparkSession, path: str, states: DataFrame | None, zones: DataFrame | None, rows: dict[str, int]
) -> tuple[Silver, dict[str, int]]:
    references = {
        "ref_state_info": ref_state_info(spark) if states is None else states,
        "ref_flood_zone_info": ref_flood_zone_info(spark) if zones is None else zones,
    }
    rows = rows | at_once(spark, {n: lambda n=n, df=df: overwrite(df, f"{path}/{n}") for n, df in references.items()})
    return read_layer(spark, path, Silver), rows


FACTS = {"fact_claims": (facts.fact_claims, "claims_cleaned"), "fact_policies": (facts.fact_policies, "policies_cleaned")}


def _write_dims(claims: DataFrame, policies: DataFrame, layer: Silver, path: str) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The dimensions with all members known so far and those of the given rows; known ones keep their keys."""
    spark, registry = claims.sparkSession, f"{path}/members"
    tables = {
        "dim_date": lambda: dims.dim_date(spark),
        "dim_location": lambda: dims.dim_location(claims, policies, layer.ref_state_info, registry),
        "dim_flood_zone": lambda: dims.dim_flood_zone(claims, policies, layer.ref_flood_zone_info, registry),
        "dim_building_type": lambda: dims.dim_building_type(claims, policies, registry),
        "dim_occupancy": lambda: dims.dim_occupancy(claims, policies, registry),
    }
    write = lambda name: lambda: overwrite(tables[name](), f"{path}/{name}")
    rows = at_once(spark, {name: write(name) for name in tables})
    return {name: read_table(spark, path, name) for name in tables}, rows


def build_gold(layer: Silver, out: str) -> tuple[Star, dict[str, int]]:
    """Build and write the dimensions, then the facts against the written dimensions, then the facts' sums.

    Facts are stored in the buckets of the cleaned tables and not by year or state: no view prunes on
    these, and a hot state or year would end up in a few large partitions. Parquet statistics still
    skip row groups.
    """
    path = f"{out}/gold"
    written, rows = _write_dims(layer.claims_cleaned, layer.policies_cleaned, layer, path)
    spark = layer.claims_cleaned.sparkSession
    write = lambda name, build, source: lambda: overwrite(build(getattr(layer, source), **written), f"{path}/{name}", [BUCKET])
    rows |= at_once(spark, {name: write(name, *how) for name, how in FACTS.items()})
    star = read_layer(spark, path, Star)
    condensed.write_all(star, path)
    return star, rows


def merge_gold(layer: Silver, out: str, touched: dict[str, list[int]], buckets: dict[str, int]) -> tuple[Star, dict[str, int]]:
    """Bring the star up to date after some buckets of the cleaned tables have changed.

    Only their rows are looked at for new members, only their fact buckets are written, and only what these
    change is added to the sums. When none of all the ``buckets`` stayed as it was, the sums are those of the
    rows that came, and the rows that went need not be read.
    """
    path, spark = f"{out}/gold", layer.claims_cleaned.sparkSession
    changed = {e: read_table(spark, f"{out}/silver", f"{e}_cleaned", touched[e]) for e in ENTITIES}
    written, rows = _write_dims(changed["claims"], changed["policies"], layer, path)

    def update(name: str, entity: str) -> int:
        build, _ = FACTS[name]
        if len(touched[entity]) == buckets[entity]:
            staged = f"{path}/condensed_staged/{name}"
            came = overwrite(build(changed[entity], **written), f"{path}/{name}", [BUCKET], touched_only=True)
            condensed.write_whole(read_table(spark, path, name), name, staged)
            switch(spark, staged, condensed.folder(path, name))
            return came
        # what went is counted before its buckets are overwritten, what came after
        load = f"load={NEW}-{uuid.uuid4().hex}"
        staged = f"{path}/condensed_staged/{name}"
        went = condensed.sums(condensed.signed(read_table(spark, path, name, touched[entity]), name, -1), name)
        overwrite(went, f"{staged}/{load}-went", [condensed.GRAIN])
        overwrite(build(changed[entity], **written), f"{path}/{name}", [BUCKET], touched_only=True)
        came = condensed.sums(condensed.signed(read_table(spark, path, name, touched[entity]), name, 1), name)
        overwrite(came, f"{staged}/{load}-came", [condensed.GRAIN])
        for part in ("went", "came"):
            switch(spark, f"{staged}/{load}-{part}", f"{condensed.folder(path, name)}/{load}-{part}")
        return read_table(spark, path, name).count()

    each = zip(FACTS, ENTITIES)
    rows |= at_once(spark, {name: lambda n=name, e=entity: update(n, e) for name, entity in each if touched[entity]})
    remove(spark, f"{path}/condensed_staged")
    return read_layer(spark, path, Star), rows


def _lacks(
    spark: SparkSession, mark: str, names: set[str], only_new: bool, buckets: int
) -> tuple[set[str] | None, int]:
    """The loads that a table was not built from and its number of buckets; None for the loads if they cannot be merged."""
    built = merge.built_from(spark, mark) if only_new else None
    if built is None or not built[0] <= names:
        return None, buckets
    return names - built[0], built[1]


def _clean(
    spark: SparkSession, out: str, entity: str, bronze: DataFrame, names: set[str], new: set[str] | None, buckets: int
) -> tuple[int, list[int]]:
    """Bring a cleaned table up to date with the loads that it lacks; its rows, and the buckets that ``new`` loads fall into."""
    path, mark, touched = f"{out}/silver/{entity}_cleaned", f"{out}/silver/{entity}_built_from", []
    merge.unmark(spark, mark)
    if new is None:
        kept = merge.rebuild(bronze, path, entity, buckets)
    else:
        fresh = merge.of_loads(spark, bronze_path(out, entity), entity, new)
        touched = merge.touched_buckets(fresh, entity, buckets)
        kept = merge.merge(fresh, path, entity, buckets, touched)
    merge.mark_built(spark, mark, names, buckets)
    return kept, touched


def clean_load(load: DataFrame, out: str, entity: str) -> DataFrame:
    """Land a further load of one entity and merge it; the cleaned table. The other entity and the star stay as they are."""
    spark = load.sparkSession
    land_table(load, out, entity, only_new=True)
    names = loads(spark, out, entity)
    new, buckets = _lacks(spark, f"{out}/silver/{entity}_built_from", names, True, merge.default_buckets(spark))
    _clean(spark, out, entity, read_bronze(spark, bronze_path(out, entity), entity), names, new, buckets)
    return read_table(spark, f"{out}/silver", f"{entity}_cleaned")


def _unmark_star(spark: SparkSession, out: str) -> None:
    for entity in ENTITIES:
        merge.unmark(spark, f"{out}/gold/{entity}_built_from")


def run(
    spark: SparkSession,
    claims: str | DataFrame,
    policies: str | DataFrame,
    out: str,
    states: DataFrame | None = None,
    zones: DataFrame | None = None,
    strict: bool = False,
    stop_on_failure: bool = False,
    only_new: bool = False,
    kind: str = "csv",
    checks: bool = True,
) -> Result:
    """Everything in order. Inputs are folders of files, or tables that already have bronze columns.

    With ``only_new`` a run takes up where earlier ones stopped: files landed before are left out, a
    table given is a further load, and the loads that a cleaned table or the star lacks are merged
    into the buckets that they touch. What a run that died left unfinished is built anew. ``checks=False``
    leaves out the suites, for the loads before the last of several.
    """
    result = Result(out)
    taken: dict[str, set[str]] = {}
    sources = {"claims": claims, "policies": policies}

    def land(entity: str) -> dict[str, int]:
        if isinstance(sources[entity], str):
            return land_files(spark, sources[entity], out, entity, only_new=only_new, kind=kind)
        return land_table(sources[entity], out, entity, only_new)

    for entity, landed in at_once(spark, {e: lambda e=e: land(e) for e in sources}).items():
        result.rows |= landed
        result.bronze[entity] = read_bronze(spark, bronze_path(out, entity), entity)
        taken[entity] = loads(spark, out, entity)

    buckets = merge.default_buckets(spark)
    # the loads of an entity that its cleaned table, or the star, has not taken in; None: it has to be built anew
    silver_lacks, silver_buckets = {}, {}
    for entity, names in taken.items():
        silver_lacks[entity], silver_buckets[entity] = _lacks(spark, f"{out}/silver/{entity}_built_from", names, only_new, buckets)
    found: dict[str, list[int]] = {}

    def clean(entity: str) -> int:
        rows, found[entity] = _clean(spark, out, entity, result.bronze[entity], taken[entity], silver_lacks[entity], silver_buckets[entity])
        return rows

    behind = [entity for entity, new in silver_lacks.items() if new is None or new]
    rows = at_once(spark, {f"{e}_cleaned": lambda e=e: clean(e) for e in behind})
    result.silver, rows = _with_references(spark, f"{out}/silver", states, zones, rows)
    result.rows |= rows

    given = states is not None or zones is not None
    star_lacks = {}
    for entity, names in taken.items():
        mark = f"{out}/gold/{entity}_built_from"
        star_lacks[entity], known = _lacks(spark, mark, names, only_new, buckets)
        if silver_lacks[entity] is None or known != silver_buckets[entity]:
            star_lacks[entity] = None
    if None in star_lacks.values():
        _unmark_star(spark, out)
        result.star, rows = build_gold(result.silver, out)
    elif given or any(star_lacks.values()):
        touched = {}
        for entity, new in star_lacks.items():
            if new and new == silver_lacks[entity]:
                touched[entity] = found[entity]
            else:
                fresh = merge.of_loads(spark, bronze_path(out, entity), entity, new)
                touched[entity] = merge.touched_buckets(fresh, entity, silver_buckets[entity]) if new else []
        _unmark_star(spark, out)
        result.star, rows = merge_gold(result.silver, out, touched, silver_buckets)
    else:
        result.star, rows = read_layer(spark, f"{out}/gold", Star), {}
    result.rows |= rows
    for entity, names in taken.items():
        merge.mark_built(spark, f"{out}/gold/{entity}_built_from", names, silver_buckets[entity])
    if not checks:
        return result
    suites = quality.silver_suite(result.bronze, result.silver).unionByName(
        quality.gold_suite(result.bronze, result.silver, result.star, strict)
    )
    result.rows["checks"] = overwrite(suites, f"{out}/checks")
    result.checks = spark.read.schema(suites.schema).parquet(f"{out}/checks")
    if stop_on_failure:
        quality.raise_on_failure(result.checks)
    return result
