"""Sinks (S-04, S-06 ... S-15): DataFrames to JSON / CSV directories.

Every sink is a distributed write (one file per partition, ``overwrite``);
nothing is collected to the driver.  Nested values stay nested in JSON and
are rendered with ``to_json`` for CSV.  Grouped sinks partition the output
directory by ``client_id`` and replace only the clients that they write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed


def _csv_safe(df: DataFrame) -> DataFrame:
    """Arrays / maps / structs -> JSON text so the CSV writer accepts them."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_json(df: DataFrame, path: str, partition_by=()) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.json(path)
    return path


def write_csv(df: DataFrame, path: str, partition_by=()) -> str:
    w = _csv_safe(df).write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.csv(path)
    return path


# ---- S-04: review reader ---------------------------------------------------
REVIEW_SCHEMA = ("review_seq long, brand string, location string, scraped_at timestamp, rating int, "
                 "text string, reviewer string, date string")


def read_reviews(spark: SparkSession, json_path: str | None = None, csv_path: str | None = None,
                 multi_line: bool = False, quoted_lines: bool = True):
    """S-04: JSON preferred, CSV fallback, ``None`` when neither exists
    ("no data").  Explicit schema; JSON lines, or with ``multi_line`` one
    document or array per file.  CSV fields may hold line breaks, which takes
    a task a file; files without any can be split by ``quoted_lines=False``.
    Records that can't be read are left out; :func:`read_reviews_checked` has them."""
    found = read_reviews_checked(spark, json_path, csv_path, multi_line, quoted_lines)
    return found and found[0]


def read_reviews_checked(spark: SparkSession, json_path: str | None = None, csv_path: str | None = None,
                         multi_line: bool = False, quoted_lines: bool = True):
    """S-04 with its rejects: (reviews, rejected (file, document)), or ``None``
    when neither file exists.  A CSV record is rejected if it has more or fewer
    fields than the header or a value that doesn't fit its column."""
    from pyspark.errors import AnalysisException

    from .settings import read_documents

    for fmt, path in (("json", json_path), ("csv", csv_path)):
        if not path:
            continue
        try:
            if fmt == "json":
                return read_documents(spark, path, REVIEW_SCHEMA, multi_line)
            return _csv_records(spark, path, quoted_lines)
        except AnalysisException:
            continue
    return None


def _csv_records(spark: SparkSession, path: str, quoted_lines: bool) -> tuple[DataFrame, DataFrame]:
    """Read as text and cast here: the reader itself checks only the columns
    that a query asks for, and a record must not come and go with them."""
    typed = T.StructType.fromDDL(REVIEW_SCHEMA)
    plain = T.StructType([T.StructField(f.name, T.StringType()) for f in typed] + [T.StructField("__corrupt", T.StringType())])
    read = (spark.read.schema(plain).option("header", True).option("multiLine", quoted_lines).option("escape", '"')
            .option("columnPruning", False).option("columnNameOfCorruptRecord", "__corrupt").csv(path))
    bad = F.col("__corrupt").isNotNull()
    for f in typed:
        bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    read = read.select("*", F.col("_metadata.file_path").alias("file"), bad.alias("__bad"))
    good = read.filter(~F.col("__bad")).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in typed])
    document = F.coalesce("__corrupt", F.to_csv(F.struct(*typed.names))).alias("document")
    return good, read.filter("__bad").select("file", document)


# ---- domain sinks ----------------------------------------------------------
def save_keywords(ranked: DataFrame, out_dir: str, competitors: DataFrame | None = None) -> list[str]:
    """S-06: keyword records as JSON lines, the ranked CSV (Keyword, Volume,
    KD, CPC, Intent; volume descending, stable) and, when given, the
    competitor records (name defaults to the domain, priority to
    'secondary', X-20)."""
    order = [F.desc("volume")] + [c for c in ("first_rank", "first_seq") if c in ranked.columns]
    csv = ranked.orderBy(*order).select(F.col("keyword").alias("Keyword"), F.col("volume").alias("Volume"),
                                        F.col("kd").alias("KD"), F.col("cpc").alias("CPC"),
                                        F.col("intent").alias("Intent"))
    paths = [write_json(ranked.select("keyword", "volume", "kd", "cpc", "intent"), f"{out_dir}/keywords_json"),
             write_csv(csv, f"{out_dir}/keywords_ranked_csv")]
    if competitors is not None:
        comp = competitors.select(*[c for c in ("client_id",) if c in competitors.columns], "domain",
                                  F.coalesce("name", "domain").alias("name"),
                                  F.coalesce("priority", F.lit("secondary")).alias("priority"))
        paths.append(write_json(comp, f"{out_dir}/competitors_json"))
    return paths


OVERVIEW_COUNTERS = ["authority_score", "total_backlinks", "referring_domains", "referring_ips",
                     "follow_links", "nofollow_links", "text_links", "image_links"]


def save_backlinks(overview: DataFrame, out_dir: str, profiles: DataFrame | None = None) -> list[str]:
    """S-07: the full overview as JSON and the 8-counter summary CSV,
    missing counters as 0; with ``profiles`` (``dashboard.backlink_profiles``)
    also the full profile of every domain, by client."""
    cols = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in overview.columns else F.lit(0).alias(c)
            for c in OVERVIEW_COUNTERS]
    summary = overview.select(F.col("target_host").alias("domain"), *cols)
    paths = [write_json(overview, f"{out_dir}/backlinks_json"), write_csv(summary, f"{out_dir}/backlink_summary_csv")]
    if profiles is not None:
        paths.append(write_json(profiles, f"{out_dir}/backlink_profiles_json", ("client_id",) if "client_id" in profiles.columns else ()))
    return paths


def save_paid(averages: DataFrame, top_paid: DataFrame, summary: DataFrame, out_dir: str, lookups: DataFrame | None = None) -> list[str]:
    """S-08: benchmark JSON, paid keyword CSV, competitor summary CSV, and with
    ``lookups`` (``paid.keyword_lookups``) the keyword CSV: Keyword, Volume, CPC,
    Competition as they were read, by client where there is a client_id."""
    paths = [write_json(averages, f"{out_dir}/industry_averages_json"),
             write_csv(top_paid, f"{out_dir}/paid_keywords_csv"),
             write_csv(summary, f"{out_dir}/competitor_paid_summary_csv")]
    if lookups is not None:
        by = [c for c in ("client_id",) if c in lookups.columns]
        paths.append(write_csv(lookups.select(*by, F.col("keyword").alias("Keyword"), F.col("volume_raw").alias("Volume"),
                                              F.col("cpc_raw").alias("CPC"), F.col("competition_raw").alias("Competition")),
                               f"{out_dir}/keyword_cpcs_csv", by))
    return paths


def save_reviews(reviews: DataFrame, out_dir: str) -> list[str]:
    """S-10: reviews as CSV and JSON, only when there is at least one
    (``isEmpty`` reads at most one row)."""
    if reviews.isEmpty():
        return []
    return [write_csv(reviews, f"{out_dir}/all_reviews_csv"), write_json(reviews, f"{out_dir}/all_reviews_json")]


def save_sentiment(facets: dict[str, DataFrame], negatives: DataFrame, out_dir: str) -> list[str]:
    """S-11: each analysis facet as JSON, the negative reviews as CSV
    (categories rendered as JSON text)."""
    paths = [write_json(df, f"{out_dir}/analysis/{name}") for name, df in facets.items()]
    return paths + [write_csv(negatives, f"{out_dir}/negative_reviews_csv")]


def save_projections(monthly: DataFrame, summary: DataFrame, out_dir: str,
                     inputs: DataFrame | None = None, as_of: str | None = None) -> list[str]:
    """S-12: resolved inputs, monthly rows and summary rows as JSON (by
    client where there is a client_id), and the 16-column monthly CSV.  ``as_of``
    stamps ``generated_at`` (a parameter, so reruns are reproducible)."""
    from ..operators.projections import MONTHLY_COLUMNS
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    by = lambda df: ("client_id",) if "client_id" in df.columns else ()
    paths = []
    if inputs is not None:
        paths.append(write_json(inputs.withColumn("generated_at", stamp), f"{out_dir}/inputs_json", by(inputs)))
    return paths + [write_json(monthly, f"{out_dir}/monthly_json", by(monthly)),
                    write_json(summary, f"{out_dir}/summary_json", by(summary)),
                    write_csv(monthly.select(*by(monthly), "scenario_id", *MONTHLY_COLUMNS), f"{out_dir}/monthly_csv", by(monthly))]


def save_visibility(frames: dict[str, DataFrame], out_dir: str) -> list[str]:
    """S-13: AI-visibility results (prompts, triggers, recommendations) as JSON."""
    return [write_json(df, f"{out_dir}/{name}") for name, df in frames.items()]


# The formats that a dashboard knows, and the source that stands in for an absent one.
DASHBOARD_FORMATS = ("keyword_market_data", "traffic_data", "backlink_data", "ai_visibility_data", "competitor_benchmarks")
ALTERNATE_SOURCES = {"keyword_market_data": "keyword_intelligence_full", "competitor_benchmarks": "competitor_paid_summary"}
MANIFEST_SCHEMA = "client_id string, version long, generated_at timestamp, source string, files array<struct<dataset: string, rows: long>>"


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """S-15: a row a client: version, generated_at, source and the exported
    datasets with their rows.  Empty before the first export."""
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.schema(MANIFEST_SCHEMA).json(f"{out_dir}/_manifest")
        df.schema
        return df
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def export_dashboard(datasets: dict[str, DataFrame], requested: list[str], out_dir: str,
                     transforms: dict | None = None, source: str = "marketlens",
                     as_of: str | None = None, formats=None, alternates: dict | None = None) -> tuple[list[str], DataFrame | None]:
    """S-14 / S-15: export the requested datasets for every client.

    Names outside ``formats`` (``DASHBOARD_FORMATS`` for a dashboard; any name
    by default) and absent datasets are skipped; an absent dataset is taken from
    the one that ``alternates`` (``ALTERNATE_SOURCES``) names, where given.  A
    registered transform (``transforms[name]``) is applied, otherwise the data
    passes through; rows without a client id are skipped; the output is one
    directory per dataset and client, and only the clients exported are replaced.

    Each dataset is computed once, into the checkpoint folder, and nothing of the
    export is replaced before all of them are there.  The manifest is
    written last, client by client: a client's entry is replaced by its next
    version, those of other clients stay, and an export that fails leaves it as
    it was.  Returns the written paths and the new entries: one row per client
    with the exported dataset names (sorted) and row counts.
    """
    transforms, alternates = transforms or {}, alternates or {}
    ready: dict[str, DataFrame] = {}
    for name in requested:
        df = datasets.get(name)
        if df is None:
            df = datasets.get(alternates.get(name, ""))
        if df is None or (formats is not None and name not in formats):
            continue
        if name in transforms:
            df = transforms[name](df)
        df = df.filter(F.col("client_id").isNotNull() & (F.col("client_id") != ""))
        ready[name] = checkpointed(df)
    if not ready:
        return [], None
    written = [write_json(df, f"{out_dir}/{name}", ("client_id",)) for name, df in ready.items()]
    allc = None
    for name, df in ready.items():
        rows = df.groupBy("client_id").agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset", F.lit(name))
        allc = rows if allc is None else allc.unionByName(rows)
    stamp = F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()
    # one row per client; the file list is bounded by the number of datasets
    entries = allc.groupBy("client_id").agg(F.array_sort(F.collect_list(F.struct("dataset", "rows"))).alias("files"))
    before = read_manifest(allc.sparkSession, out_dir).select("client_id", F.col("version").alias("__old"))
    manifest = entries.join(before, "client_id", "left").select(
        "client_id", (F.coalesce("__old", F.lit(0)) + 1).alias("version"), stamp.alias("generated_at"), F.lit(source).alias("source"), "files")
    manifest = checkpointed(manifest)  # read from the folder that it is written to
    write_json(manifest, f"{out_dir}/_manifest", ("client_id",))
    return written, manifest
