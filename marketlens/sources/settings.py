"""Client settings (S-01 ... S-03, S-05, F-01, U-03).

The source tool reads one YAML file per client.  Here every client is one
JSON document (``client_id`` plus the same sections), all clients are read
in one job with an explicit schema, and each list section becomes a
dimension table keyed by ``client_id`` with its list order kept as ``seq``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS_SCHEMA = T.StructType([
    T.StructField("client_id", T.StringType()),
    T.StructField("target", T.StructType([
        T.StructField("name", T.StringType()), T.StructField("domain", T.StringType()),
        T.StructField("industry", T.StringType()), T.StructField("launch_status", T.StringType()),
        T.StructField("dashboard_client_id", T.StringType())])),
    T.StructField("competitors", T.ArrayType(T.StructType([
        T.StructField("domain", T.StringType()), T.StructField("name", T.StringType()),
        T.StructField("priority", T.StringType()), T.StructField("tier", T.StringType()),
        T.StructField("notes", T.StringType())]))),
    T.StructField("market_keywords", T.ArrayType(T.StringType())),
    T.StructField("projections", T.StructType([
        T.StructField("monthly_ad_spend", T.DoubleType()), T.StructField("aov", T.DoubleType()),
        T.StructField("cpc", T.DoubleType()), T.StructField("conversion_rate", T.DoubleType()),
        T.StructField("months", T.IntegerType())])),
    T.StructField("google_reviews", T.StructType([
        T.StructField("locations", T.ArrayType(T.StringType())),
        T.StructField("store_types", T.ArrayType(T.StringType()))])),
    T.StructField("analysis", T.StructType([
        T.StructField("sentiment_threshold", T.DoubleType()),
        T.StructField("min_rating_negative", T.IntegerType()),
        T.StructField("n_key_phrases", T.IntegerType()), T.StructField("n_topics", T.IntegerType())])),
])

# Defaults the source tool applies when a section is missing.
DEFAULT_LOCATIONS = ["New York", "Los Angeles"]
DEFAULT_STORE_TYPES = ["store"]
DEFAULT_SPEND, DEFAULT_AOV, DEFAULT_MONTHS = 5000.0, 100.0, 6


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """JSON documents under ``path`` and the ones that can't be read: (documents
    with the columns of ``schema``, rejected (file, document)).

    One document a line (blank lines are none), or with ``multi_line`` one, or an
    array of them, a file.  A document is rejected whole if it isn't a JSON object
    or if any value doesn't fit its column's type; absent columns are null and
    unknown ones are left out.  Rejected lines are kept as they stand.  Every
    file is read as text and split as any text; an absent path raises.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = spark.read.text(path, wholetext=multi_line).select("value", F.col("_metadata.file_path").alias("file"))
    raw = raw.filter(F.length(F.trim("value")) > 0)
    if multi_line:  # an object or an array; its documents one by one, as text again
        many = F.from_json("value", "array<string>")
        alone = F.ltrim("value").startswith("[")
        raw = raw.select("file", F.explode_outer(F.when(alone, F.coalesce(many, F.array("value"))).otherwise(F.array("value"))).alias("value"))
    checked = T.StructType([*schema.fields, T.StructField("__corrupt", T.StringType())])
    read = raw.withColumn("d", F.from_json("value", checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"}))
    bad = F.col("d").isNull() | F.col("d.__corrupt").isNotNull() | ~F.coalesce(F.ltrim("value").startswith("{"), F.lit(False))
    return (read.filter(~bad).select("d.*").drop("__corrupt"), read.filter(bad).select("file", F.col("value").alias("document")))


def read_settings(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """S-01: all client documents under ``path``, read with the explicit
    schema (no inference pass): JSON lines, or with ``multi_line`` one
    document (or array of documents) per file.  Documents that can't be read are
    left out; :func:`rejected_settings` has them."""
    return read_documents(spark, path, SETTINGS_SCHEMA, multi_line)[0]


def rejected_settings(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """S-01: (file, document) of the client documents that can't be read."""
    return read_documents(spark, path, SETTINGS_SCHEMA, multi_line)[1]


def targets(settings: DataFrame) -> DataFrame:
    """S-01 target section: name and domain default to '' like the tool."""
    return settings.select("client_id", F.coalesce("target.name", F.lit("")).alias("name"),
                           F.coalesce("target.domain", F.lit("")).alias("domain"),
                           F.col("target.industry").alias("industry"),
                           F.col("target.launch_status").alias("launch_status"),
                           F.col("target.dashboard_client_id").alias("dashboard_client_id"))


def competitors(settings: DataFrame) -> DataFrame:
    """S-01: one row per listed competitor, list order as ``seq`` (1-based);
    absent keys are NULL.  A client without competitors yields no rows."""
    return settings.select("client_id", F.posexplode("competitors").alias("pos", "c")).select(
        "client_id", (F.col("pos") + 1).cast("int").alias("seq"), "c.*")


def market_keywords(settings: DataFrame) -> DataFrame:
    return settings.select("client_id", F.posexplode("market_keywords").alias("pos", "keyword")).select(
        "client_id", (F.col("pos") + 1).cast("int").alias("seq"), "keyword")


def primary_competitors(comps: DataFrame) -> DataFrame:
    """F-01: only competitors marked primary (none when no priority given)."""
    return comps.filter(F.col("priority") == "primary")


def competitor_domains(comps: DataFrame) -> DataFrame:
    """S-02: competitor domains in list order, falsy domains dropped."""
    return comps.filter(F.col("domain").isNotNull() & (F.col("domain") != "")).select(
        "client_id", "seq", "domain")


def all_domains(settings: DataFrame) -> DataFrame:
    """S-02 / U-03: target first (seq 0, when it has a domain), then the
    competitor domains in list order."""
    t = targets(settings).filter(F.col("domain") != "").select(
        "client_id", F.lit(0).alias("seq"), "domain", F.lit("target").alias("role"))
    c = competitor_domains(competitors(settings)).withColumn("role", F.lit("competitor"))
    return t.unionByName(c)


def competitor_names(comps: DataFrame) -> DataFrame:
    """S-03: domain -> name mapping (name NULL when not given)."""
    return comps.select("client_id", "domain", "name")


def review_locations(settings: DataFrame) -> DataFrame:
    """Search locations per client, the tool's defaults when unset."""
    locs = F.coalesce(F.col("google_reviews.locations"), F.array(*[F.lit(x) for x in DEFAULT_LOCATIONS]))
    return settings.select("client_id", F.posexplode(locs).alias("seq", "location"))


def review_store_types(settings: DataFrame) -> DataFrame:
    types = F.coalesce(F.col("google_reviews.store_types"), F.array(*[F.lit(x) for x in DEFAULT_STORE_TYPES]))
    return settings.select("client_id", F.posexplode(types).alias("seq", "store_type"))


def scenarios(settings: DataFrame, industry: str = "luxury_ecommerce") -> DataFrame:
    """G-02 / G-03: one projection scenario per client from its settings,
    config defaults spend 5000, AOV 100, months 6; CPC and conversion rate
    stay NULL when unset (resolved later from the benchmark)."""
    p = "projections"
    return settings.select(
        F.col("client_id").alias("scenario_id"), F.lit(industry).alias("industry"),
        F.coalesce(F.col(f"{p}.monthly_ad_spend"), F.lit(DEFAULT_SPEND)).alias("monthly_ad_spend"),
        F.coalesce(F.col(f"{p}.aov"), F.lit(DEFAULT_AOV)).alias("aov"),
        F.col(f"{p}.cpc").alias("cpc"), F.col(f"{p}.conversion_rate").alias("conversion_rate"),
        F.coalesce(F.col(f"{p}.months"), F.lit(DEFAULT_MONTHS)).alias("months"))


def read_benchmark(spark: SparkSession, path: str | None, multi_line: bool = False) -> DataFrame:
    """S-05: paid benchmarks as (client_id, avg_cpc), one row per document;
    ``industry_averages.avg_cpc`` or, in the lines that ``sinks.save_paid``
    writes, ``avg_cpc`` itself.  One row of NULLs (-> default CPC later) when
    the file is absent."""
    from pyspark.errors import AnalysisException

    schema = "client_id string, avg_cpc double, industry_averages struct<avg_cpc double>"
    if path:
        try:
            df = spark.read.schema(schema).option("multiLine", multi_line).json(path)
            df.schema  # resolves the path (works for any Hadoop file system)
            return df.select("client_id", F.coalesce("industry_averages.avg_cpc", "avg_cpc").alias("avg_cpc"))
        except AnalysisException:
            pass
    return spark.createDataFrame([(None, None)], "client_id string, avg_cpc double")
