"""Sources and sinks (S-01 to S-21)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodledger.operators.topn import completeness, page
from floodledger.plans.replay import replay
from floodledger.plans.warehouse import bronze_path, land_files
from floodledger.schemas import (
    CLAIM_COLUMNS,
    ENDPOINT,
    ENVELOPE,
    MISSING_TOKENS,
    POLICY_COLUMNS,
    SILVER,
    conform,
    ref_flood_zone_info,
)
from floodledger.sources import landing, sinks
from harness import bindings
from harness.registry import query
from harness.sql import money
from harness.workspace import Workspace

BAD_LINE = "broken,line"
OVERLONG = ",too,long"
_CACHE: dict[str, str] = {}
#: Landed text repeats itself, names of columns above all: as plain text it is many times the tables it is made of.
PACKED = "gzip"


def landed(ws: Workspace, entity: str) -> DataFrame:
    columns = CLAIM_COLUMNS if entity == "claims" else POLICY_COLUMNS
    return bindings.LANDED[entity](ws.spark, ws.sf_dir).select(*columns)


def csv_folder(ws: Workspace, entity: str) -> str:
    """The landed rows as CSV, a folder per state, written once per workspace."""
    key = f"{ws.path}/{entity}"
    if key not in _CACHE:
        path = ws.scratch(f"csv_{entity}")
        sinks.write_csv_by_state(landed(ws, entity), path, "state" if entity == "claims" else "propertyState", PACKED)
        _CACHE[key] = path
    return _CACHE[key]


def csv_files(ws: Workspace, entity: str) -> str:
    return csv_folder(ws, entity) + "/*"


def per_state(df: DataFrame) -> DataFrame:
    """Rows, filled counties and text lengths per state: differs if any value was lost or moved."""
    return df.groupBy("state").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("countyCode").alias("counties"),
        F.count("ratedFloodZone").alias("rated"),
        F.sum(F.length("dateOfLoss")).alias("date_length"),
        F.sum(F.length("ratedFloodZone")).alias("zone_length"),
        F.sum(F.col("totalBuildingInsuranceCoverage").cast("decimal(18,2)")).alias("coverage"),
    )


PER_STATE = (
    "SELECT state, count(*) AS n, count(countyCode) AS counties, count(ratedFloodZone) AS rated,"
    " CAST(sum(length(dateOfLoss)) AS BIGINT) AS date_length, CAST(sum(length(ratedFloodZone)) AS BIGINT) AS zone_length,"
    " CAST(sum(CAST(totalBuildingInsuranceCoverage AS DECIMAL(18,2))) AS DOUBLE) AS coverage FROM landed_claims GROUP BY state"
)


@query("s01_csv_fixed_schema", "landed_claims", PER_STATE)
def s01(ws):
    return per_state(landing.read_csv(ws.spark, csv_files(ws, "claims"), CLAIM_COLUMNS))


@query("s02_csv_columns_from_header", "landed_claims", PER_STATE)
def s02(ws):
    return per_state(landing.read_csv_by_header(ws.spark, csv_files(ws, "claims")))


def damaged_folder(ws: Workspace) -> str:
    """The claims CSV with a short line after every hundredth order."""
    rows = bindings.landed_claims(ws.spark, ws.sf_dir)
    filled = (F.coalesce(F.col(c), F.lit("")) for c in CLAIM_COLUMNS)
    line = F.concat_ws(",", *filled)
    broken = F.when(F.col(bindings.INGEST_SEQ) % 100 == 0, F.lit(BAD_LINE))
    lines = rows.select("state", F.explode(F.array_compact(F.array(line, broken))).alias("value"))
    path = ws.scratch("damaged")
    lines.write.partitionBy("state").text(path, compression=PACKED)
    return path


def read_damaged(ws: Workspace) -> DataFrame:
    """The damaged files have no header line, so they are read without one."""
    return landing.read_csv_marked(ws.spark, damaged_folder(ws) + "/*", CLAIM_COLUMNS, header=False)


@query("s03_bad_rows_good_part", "landed_claims", "SELECT state, count(*) AS n FROM landed_claims GROUP BY state")
def s03(ws):
    return landing.good_rows(read_damaged(ws)).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s03_bad_rows_counted",
    "landed_claims",
    "SELECT replace(state, ' ', '') AS folder, count(*) + count(*) FILTER (WHERE ingest_seq % 100 = 0) AS rows_read,"
    " count(*) FILTER (WHERE ingest_seq % 100 = 0) AS bad_rows FROM landed_claims GROUP BY state",
)
def s03_counts(ws):
    counts = landing.bad_row_counts(read_damaged(ws))
    folder = F.regexp_replace(F.regexp_extract(landing.FILE, "state=([^/]*)/", 1), "%20| ", "")
    return counts.groupBy(folder.alias("folder")).agg(
        *(F.sum(c).alias(c) for c in ("rows_read", "bad_rows"))
    )


@query("s03_replayed_lines", "landed_claims", PER_STATE)
def s03_replayed(ws):
    """Every third line has two fields too many; mended and replayed twice, each row is there once."""
    rows = bindings.landed_claims(ws.spark, ws.sf_dir)
    line = F.concat_ws(",", *(F.coalesce(F.col(c), F.lit("")) for c in CLAIM_COLUMNS))
    damaged, out = ws.scratch("overlong"), ws.scratch("replayed")
    rows.select(F.when(F.col(bindings.INGEST_SEQ) % 3 == 0, F.concat(line, F.lit(OVERLONG))).otherwise(line).alias("value")).write.text(damaged, compression=PACKED)
    marked = landing.read_csv_marked(ws.spark, damaged, CLAIM_COLUMNS, header=False)
    landed_rows = landing.to_landed_table(marked, "claims").withColumn(landing.LOAD, F.lit("full"))
    sinks.overwrite(landed_rows, bronze_path(out, "claims"), [landing.LOAD, landing.REJECTED])
    for _ in range(2):
        replay(ws.spark, out, "claims", F.regexp_replace(landing.BAD, f"{OVERLONG}$", ""))
    return per_state(landing.read_bronze(ws.spark, bronze_path(out, "claims"), "claims"))


@query("s04_files_with_other_column_order", "landed_claims", PER_STATE)
def s04(ws):
    """Half of the files have their columns reversed and are still aligned by name."""
    return per_state(landing.read_csv_aligned(ws.spark, f"{turned_files(ws)}/*"))


def turned_files(ws: Workspace) -> str:
    """Claims in two folders: states with A have their columns reversed."""
    rows = landed(ws, "claims")
    turned = F.substring("state", 1, 1) == "A"
    path = ws.scratch("turned")
    for name, part in (
        ("straight", rows.where(~turned)),
        ("reversed", rows.where(turned).select(*reversed(CLAIM_COLUMNS))),
    ):
        part.write.options(**landing.DIALECT).option("compression", PACKED).option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(f"{path}/{name}")
    return path


@query("s04_landed_in_two_loads", "landed_claims", PER_STATE)
def s04_landed(ws):
    """The straight files first, then all new files of both folders, then nothing new."""
    path, out = turned_files(ws), ws.scratch("landed")
    land_files(ws.spark, f"{path}/straight", out, "claims")
    for _ in range(2):
        land_files(ws.spark, f"{path}/*", out, "claims", only_new=True)
    return per_state(landing.read_bronze(ws.spark, bronze_path(out, "claims"), "claims"))


_TOKENS = ", ".join(f"'{t}'" for t in MISSING_TOKENS)
#: Rows of a column until the first token comes again: as many without a token as there are tokens.
_CYCLE = 2 * len(MISSING_TOKENS)


@query(
    "s05_missing_tokens",
    "landed_claims",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", token, count(*) AS n FROM (SELECT CASE WHEN x IS NULL OR x IN ({_TOKENS}) THEN coalesce(s, 'landed') ELSE 'kept' END AS token"
        f" FROM (SELECT [{_TOKENS}][(ingest_seq + {i}) % {_CYCLE} + 1] AS s, coalesce(s, {c}) AS x FROM landed_claims)) GROUP BY token"
        for i, c in enumerate(CLAIM_COLUMNS)
    ),
)
def s05(ws):
    """Every token put into every column, in turn with the landed values: what is missing afterwards, by column and token."""
    tokens = F.array(*map(F.lit, MISSING_TOKENS))
    rows = bindings.landed_claims(ws.spark, ws.sf_dir)
    seeds = {c: F.get(tokens, ((F.col(bindings.INGEST_SEQ) + i) % _CYCLE).cast("int")) for i, c in enumerate(CLAIM_COLUMNS)}
    seeded = rows.select(*(F.coalesce(s, F.col(c)).alias(c) for c, s in seeds.items()), *(s.alias(f"_{c}") for c, s in seeds.items()))
    clean = landing.normalise_missing(seeded.withColumns({f"_{c}": F.coalesce(F.concat(F.lit("="), f"_{c}"), F.lit("=landed")) for c in CLAIM_COLUMNS}))
    outcome = lambda c: F.when(F.col(c).isNull(), F.substring(f"_{c}", 2, 99)).otherwise("kept")
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), outcome(c).alias("token")) for c in CLAIM_COLUMNS)))
    return clean.select(each.alias("cell")).groupBy("cell.column", "cell.token").agg(F.count("*").alias("n"))


@query(
    "s06_lineage_columns",
    "raw_claims",
    f"SELECT state AS source_state, '{ENDPOINT['claims']}' AS source_api_endpoint, 1 AS batch_id, count(*) AS n,"
    " count(*) AS stamped FROM raw_claims GROUP BY state",
)
def s06(ws):
    rows = landing.with_lineage(landed(ws, "claims"), ENDPOINT["claims"])
    return rows.groupBy("source_state", "source_api_endpoint", "batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("ingestion_timestamp").alias("stamped")
    )


@query(
    "s07_state_from_candidates",
    "raw_policies",
    "SELECT CASE WHEN ingest_seq % 2 = 0 THEN propertyState ELSE 'given' END AS source_state, count(*) AS n"
    " FROM raw_policies GROUP BY 1",
)
def s07(ws):
    """A state that is already filled is kept, a missing one comes from the first candidate."""
    rows = bindings.landed_policies(ws.spark, ws.sf_dir)
    half = rows.withColumn("source_state", F.when(F.col(bindings.INGEST_SEQ) % 2 == 1, "given"))
    filled = landing.with_lineage(half, ENDPOINT["policies"])
    return filled.groupBy("source_state").agg(F.count(F.lit(1)).alias("n"))


@query("s08_truncate_and_reload", "raw_claims", "SELECT state, count(*) AS n FROM raw_claims GROUP BY state")
def s08(ws):
    """Two loads of the same table leave one copy."""
    path = ws.scratch("reload")
    for _ in range(2):
        sinks.overwrite(ws.bronze("claims"), path, ["source_state"])
    return ws.spark.read.parquet(path).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s09_only_states_not_loaded",
    "raw_claims",
    "SELECT state, count(*) AS n FROM raw_claims WHERE state NOT LIKE 'A%' GROUP BY state",
)
def s09(ws):
    incoming = ws.bronze("claims")
    loaded = incoming.where(F.col("source_state").startswith("A"))
    return landing.not_loaded(incoming, loaded).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s10_append",
    "claims policies",
    "SELECT zone_category, count(*) AS n FROM (SELECT zone_category FROM claims UNION ALL SELECT zone_category FROM policies) GROUP BY 1",
)
def s10(ws):
    path = ws.scratch("append")
    for side in (ws.claims, ws.policies):
        sinks.append(side.select("zone_category"), path)
    return ws.spark.read.parquet(path).groupBy("zone_category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s11_inline_rows",
    "claims zones",
    "SELECT z.zone_category, z.zone_description, z.is_special_flood_hazard AS hazard, count(c.state) AS n"
    " FROM zones z LEFT JOIN claims c ON c.zone_category = z.zone_category GROUP BY 1, 2, 3",
)
def s11(ws):
    zones = ref_flood_zone_info(ws.spark).withColumnRenamed("is_special_flood_hazard", "hazard")
    counts = ws.claims.groupBy("zone_category").agg(F.count("state").alias("n"))
    return zones.join(counts, "zone_category", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


@query(
    "s12_typed_tables",
    "claims",
    "SELECT accident_year, count(*) AS n, CAST(sum(amountPaidTotal) AS DOUBLE) AS paid FROM claims GROUP BY 1",
)
def s12(ws):
    """The silver schema holds after writing and reading: types come from the file, not the reader."""
    path = ws.scratch("typed")
    sinks.overwrite(conform(ws.claims, SILVER["claims_cleaned"]), path)
    stored = conform(ws.spark.read.parquet(path), SILVER["claims_cleaned"])
    return stored.groupBy("accident_year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amountPaidTotal").alias("paid")
    )


@query(
    "s13_sql_view",
    "claims_star",
    "SELECT CAST(year_of_loss AS INT) AS year_of_loss, count(*) AS claim_count FROM claims_star WHERE year_of_loss IS NOT NULL GROUP BY 1",
)
def s13(ws):
    from floodledger.plans.views import register_views

    register_views(ws.star)
    return ws.spark.sql("SELECT year_of_loss, claim_count FROM vw_claims_development")


@query(
    "s14_rows_loaded",
    "claims policies",
    "SELECT 'claims' AS entity, count(*) AS rows_loaded FROM claims UNION ALL SELECT 'policies', count(*) FROM policies",
)
def s14(ws):
    """The count observed while writing equals the rows of the table."""
    parts = []
    for entity, df in (("claims", ws.claims), ("policies", ws.policies)):
        path = ws.scratch(f"observed_{entity}")
        observed = sinks.overwrite(df, path)
        stored = ws.spark.read.parquet(path)
        parts.append(
            stored.agg(F.count(F.lit(1)).alias("stored")).where(F.col("stored") == observed)
            .select(F.lit(entity).alias("entity"), F.col("stored").alias("rows_loaded"))
        )
    return parts[0].unionByName(parts[1])


def page_folder(ws: Workspace) -> str:
    """Claim records in JSON pages of the landed form: one record per page, some pages empty."""
    key = f"{ws.path}/pages"
    if key not in _CACHE:
        rows = bindings.landed_claims(ws.spark, ws.sf_dir)
        full = F.array(F.struct(*CLAIM_COLUMNS))
        empty = F.when(F.col("state") == "ASIA", F.array(full, F.array_except(full, full)))
        pages = rows.select(F.explode(F.coalesce(empty, F.array(full))).alias(ENVELOPE["claims"]))
        path = ws.scratch("pages")
        pages.write.json(path, compression=PACKED)
        _CACHE[key] = path
    return _CACHE[key]


@query("s15_record_envelope", "landed_claims", PER_STATE)
def s15(ws):
    # one page per line here, so the reader needs no multi-line mode
    entity = ENVELOPE["claims"]
    return per_state(landing.read_envelope(ws.spark, page_folder(ws), entity, CLAIM_COLUMNS, multi_line=False))


@query("s15_landed_pages", "landed_claims", PER_STATE)
def s15_landed(ws):
    out = ws.scratch("landed")
    land_files(ws.spark, page_folder(ws), out, "claims", kind="jsonl")
    return per_state(landing.read_bronze(ws.spark, bronze_path(out, "claims"), "claims"))


@query(
    "s16_source_filter_and_projection",
    "raw_claims",
    "SELECT state, dateOfLoss AS loss_date, count(*) AS n FROM raw_claims WHERE state IN ('ASIA', 'EUROPE') GROUP BY 1, 2",
)
def s16(ws):
    rows = landing.select_source(ws.bronze("claims"), ["state", "dateOfLoss"], "state", ["ASIA", "EUROPE"])
    return rows.groupBy("state", F.col("dateOfLoss").alias("loss_date")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "s17_state_completeness",
    "landed_policies raw_policies",
    "SELECT f.propertyState, f.n AS rows_found, l.n AS rows_landed, CASE WHEN f.n <> l.n THEN 1 ELSE 0 END AS truncated FROM"
    " (SELECT propertyState, count(*) AS n FROM landed_policies GROUP BY 1) f JOIN"
    " (SELECT propertyState, count(*) AS n FROM raw_policies GROUP BY 1) l USING (propertyState)",
)
def s17(ws):
    return completeness(landed(ws, "policies"), ws.bronze("policies"), ["propertyState"])


@query(
    "s17_truncated_states",
    "landed_policies raw_policies",
    "SELECT f.propertyState, f.n AS rows_found, coalesce(l.n, 0) AS rows_landed, CASE WHEN f.n <> coalesce(l.n, 0) THEN 1 ELSE 0 END AS truncated FROM"
    " (SELECT propertyState, count(*) AS n FROM landed_policies GROUP BY 1) f LEFT JOIN"
    " (SELECT propertyState, count(*) AS n FROM raw_policies WHERE propertyState <> 'ASIA' AND NOT (propertyState = 'EUROPE' AND construction = 'True') GROUP BY 1) l USING (propertyState)",
)
def s17_flags(ws):
    """A damaged load: one state is missing as a whole, one in part."""
    rows = ws.bronze("policies")
    damaged = rows.where("propertyState <> 'ASIA' AND NOT (propertyState = 'EUROPE' AND construction = 'True')")
    return completeness(landed(ws, "policies"), damaged, ["propertyState"])


@query(
    "s18_page_by_skip",
    "",
    "SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders ORDER BY o_orderkey OFFSET 300 LIMIT 100",
)
def s18(ws):
    return page(ws.table("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100, skip=300)


@query(
    "s18_page_after_key",
    "",
    "SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 100",
)
def s18_after(ws):
    return page(ws.table("orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100, after=5000)


@query("s19_csv_folder_per_state", "landed_claims", "SELECT state AS folder, count(*) AS n FROM landed_claims GROUP BY 1")
def s19(ws):
    stored = ws.spark.read.options(**landing.DIALECT).option("header", True).csv(csv_folder(ws, "claims"))
    return stored.groupBy(F.col("_state").alias("folder")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "s20_load_summary",
    "raw_claims",
    "SELECT state, count(*) AS rows_loaded, CAST(grouping(state) AS INT) AS is_total FROM raw_claims GROUP BY ROLLUP (state)",
)
def s20(ws):
    return sinks.load_summary(ws.bronze("claims"), "state")


_LISTED = [*CLAIM_COLUMNS]


@query(
    "s21_column_listing",
    "raw_claims",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", 'string' AS type, count({c}) AS filled FROM raw_claims"
        for i, c in enumerate(_LISTED, start=1)
    ),
)
def s21(ws):
    return sinks.column_listing(ws.bronze("claims").select(*_LISTED))
