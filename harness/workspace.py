"""The layers built from one folder of driver tables, written once per Spark application.

Registered queries read the written layers, as queries of a warehouse do; ``fresh_run`` builds
everything anew.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from floodledger.plans import merge
from floodledger.plans.condensed import condensed_star
from floodledger.plans.layers import Silver, Star, read_table
from floodledger.plans.silver import ENTITIES
from floodledger.plans.warehouse import Result, build_gold, build_silver, clean_load, run
from floodledger.schemas import bronze_schema
from floodledger.session import at_once, tuned, work_folder
from floodledger.sources.sinks import overwrite
from harness import bindings


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tuned(spark)
        self.sf_dir = sf_dir
        self.path = work_folder(spark)
        self._bronze: dict[str, DataFrame] = {}
        self._cleaned: dict[str, DataFrame] = {}
        self._merged_cleaned: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return bindings.table(self.spark, self.sf_dir, name)

    def bronze(self, entity: str) -> DataFrame:
        if entity not in self._bronze:
            path = f"{self.path}/bronze/{entity}_raw"
            overwrite(bindings.bronze(self.spark, self.sf_dir, entity), path)
            self._bronze[entity] = self.spark.read.schema(bronze_schema(entity)).parquet(path)
        return self._bronze[entity]

    def bronze_of_all(self) -> dict[str, DataFrame]:
        """Both tables, written at the same time: the small one does not wait for the last tasks of the other."""
        return at_once(self.spark, {entity: lambda e=entity: self.bronze(e) for entity in ENTITIES})

    @cached_property
    def states(self) -> DataFrame:
        return bindings.state_reference(self.spark, self.sf_dir)

    def cleaned(self, entity: str) -> DataFrame:
        """The cleaned rows of one entity; the other one is not built for it."""
        if entity not in self._cleaned:
            path, name = f"{self.path}/silver", f"{entity}_cleaned"
            merge.rebuild(self.bronze(entity), f"{path}/{name}", entity, merge.default_buckets(self.spark))
            self._cleaned[entity] = read_table(self.spark, path, name)
        return self._cleaned[entity]

    @cached_property
    def silver(self) -> Silver:
        bronze = self.bronze_of_all()
        lacking = [entity for entity in ENTITIES if entity not in self._cleaned]
        layer = build_silver(bronze, self.path, self.states, entities=lacking)[0]
        self._cleaned |= {entity: getattr(layer, f"{entity}_cleaned") for entity in lacking}
        return layer

    @cached_property
    def star(self) -> Star:
        return build_gold(self.silver, self.path)[0]

    @property
    def claims(self) -> DataFrame:
        return self.cleaned("claims")

    @property
    def policies(self) -> DataFrame:
        return self.cleaned("policies")

    @cached_property
    def merged(self) -> Result:
        """The rows in three loads, newest first; the first has outdated versions of later rows as well."""
        out, result, bronze = self.scratch("merged"), None, self.bronze_of_all()
        for load in range(bindings.LOADS):
            given = {e: bindings.delivery(bronze[e], e, load) for e in ("claims", "policies")}
            result = run(self.spark, given["claims"], given["policies"], out, self.states, only_new=True, checks=False)
        return result

    def merged_cleaned(self, entity: str) -> DataFrame:
        """The cleaned rows of one entity after the same loads; the other one and the star are not built for it."""
        if "merged" in vars(self):
            return getattr(self.merged.silver, f"{entity}_cleaned")
        if entity not in self._merged_cleaned:
            out = self.scratch(f"merged_{entity}")
            for load in range(bindings.LOADS):
                rows = clean_load(bindings.delivery(self.bronze(entity), entity, load), out, entity)
            self._merged_cleaned[entity] = rows
        return self._merged_cleaned[entity]

    def condensed(self, grain: str) -> Star:
        """The star of the merged loads with the merged sums in the place of facts."""
        return condensed_star(self.merged.star, f"{self.merged.path}/gold", grain)

    def scratch(self, name: str) -> str:
        """A new folder for files a query writes and reads back."""
        return work_folder(self.spark, name)

    def fresh_run(self) -> Result:
        raw = {e: bindings.bronze(self.spark, self.sf_dir, e) for e in ("claims", "policies")}
        return run(self.spark, raw["claims"], raw["policies"], self.scratch("run"), self.states)


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _open:
        _open[key] = Workspace(spark, sf_dir.rstrip("/"))
    return _open[key]
