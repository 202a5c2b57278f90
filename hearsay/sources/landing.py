"""Raw pages: reading landed JSON files, naming them, and the landing table.

A landed page is one row `(topic, page, payload, n_hits, nb_pages)`. The payload
is kept untouched. `n_hits` and `nb_pages` are read from it once, at landing, so
that paging decisions later scan two integers and never the payload; a payload
that is not a JSON object has null `n_hits` and is a corrupt page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearsay.functions.hits import kind
from hearsay.session import BROADCAST_ROWS, COMPRESSION, let_go, staging

LANDING_SCHEMA = "topic string, page int, payload string, n_hits int, nb_pages bigint"

# Pages are landed in slices of about SLICE_PAGES, at most SLICES: only a slice's payloads are shuffled at once.
SLICE_PAGES, SLICES = 5_000, 2

# Fixed value: page files are named page_000.json, page_001.json, ...
_PAGE_DIGITS = 3
_PAGE_FILE = r"/([^/]+)/page_(\d+)\.json$"


def safe_topic(topic: Column) -> Column:
    """Folder name of a topic: anything but letters, digits, - and _ becomes _."""
    return F.regexp_replace(topic, r"[^\p{L}\p{N}_-]", "_")


def page_path(topic: Column, page: Column) -> Column:
    """`<safe topic>/page_NNN.json`; numbers past three digits grow."""
    digits = page.cast("string")
    width = F.greatest(F.length(digits), F.lit(_PAGE_DIGITS))
    return F.concat(safe_topic(topic), F.lit("/page_"), F.lpad(digits, width, F.lit("0")), F.lit(".json"))


def topic_of_path(path: Column) -> Column:
    """Folder name of the topic; file paths come percent-encoded."""
    return F.try_url_decode(F.regexp_extract(path, _PAGE_FILE, 1))


def page_of_path(path: Column) -> Column:
    return F.regexp_extract(path, _PAGE_FILE, 2).try_cast("int")


def hits_of(payload: Column) -> Column:
    """The page's `hits` as ARRAY<VARIANT>; empty when missing or not a list."""
    hits = F.try_variant_get(F.try_parse_json(payload), "$.hits", "array<variant>")
    return F.coalesce(hits, F.array().cast("array<variant>"))


def with_page_facts(pages: DataFrame) -> DataFrame:
    """Add `n_hits` (null for a corrupt page) and `nb_pages` to `(topic, page, payload)`."""
    parsed = pages.withColumn("_json", F.try_parse_json("payload"))
    hits = F.try_variant_get("_json", "$.hits", "array<variant>")
    # Facts come out of a generator, so that a filter on them does not parse again; the key
    # passes beside it, so that pages dealt by it need not be dealt anew.
    return parsed.select("topic", "page", "payload", F.inline(F.array(F.struct(
        F.when(kind(F.col("_json")) == "OBJECT", F.coalesce(F.array_size(hits), F.lit(0))).alias("n_hits"),
        F.try_variant_get("_json", "$.nbPages", "bigint").alias("nb_pages"),
    ))))


def scan_page_files(spark: SparkSession, folder: str) -> DataFrame:
    """Landed JSON files `<folder>/<topic>/page_NNN.json`, one row per file.

    `topic` is the folder name; `operators.pages.named_pages` gives the topic's own.
    """
    files = spark.read.text(f"{folder}/*/page_*.json", wholetext=True)
    return files.select(
        topic_of_path(F.col("_metadata.file_path")).alias("topic"),
        page_of_path(F.col("_metadata.file_path")).alias("page"),
        F.col("value").alias("payload"),
    )


def corrupt_pages(pages: DataFrame) -> DataFrame:
    """Pages to fetch again: their payload cannot be read as a page."""
    return pages.filter(F.col("n_hits").isNull()).select("topic", "page")


def new_pages(incoming: DataFrame, landed: DataFrame) -> DataFrame:
    """Incoming pages not landed yet; a corrupt landed page is replaced by a readable copy.

    Of several copies of one page in `incoming`, a readable one is kept.
    """
    one = Window.partitionBy("topic", "page").orderBy(F.col("n_hits").desc_nulls_last(), "payload")
    single = incoming.withColumn("_copy", F.row_number().over(one)).filter("_copy = 1").drop("_copy")
    state = landed.groupBy("topic", "page").agg(
        F.max(F.col("n_hits").isNotNull()).alias("_readable")
    )
    joined = single.join(state, ["topic", "page"], "left")
    wanted = F.col("_readable").isNull() | (~F.col("_readable") & F.col("n_hits").isNotNull())
    return joined.filter(wanted).select("topic", "page", "payload", "n_hits", "nb_pages")


def wanted_keys(pages: DataFrame, landed: DataFrame) -> DataFrame:
    """Every `(topic, page)` of `pages`: its `copies`, if it is landed (`known`) and if a readable copy is (`readable`)."""
    state = landed.groupBy("topic", "page").agg(F.max(F.col("n_hits").isNotNull()).alias("readable"))
    keys = pages.groupBy("topic", "page").agg(F.count(F.lit(1)).alias("copies"))
    return keys.join(state, ["topic", "page"], "left").select(
        "topic", "page", "copies", F.col("readable").isNotNull().alias("known"),
        F.coalesce("readable", F.lit(False)).alias("readable"),
    )


def land(spark: SparkSession, pages: DataFrame, folder: str) -> None:
    """Append new pages to the landing table.

    Keys are compared first, without payloads; where no page is new nothing else is
    read. Payloads of many pages move in slices, each of which lets go of its shuffles.
    """
    with staging(spark) as written:
        keys = written(wanted_keys(pages, read_landing(spark, folder)), "page-keys")
        n = keys.where("not readable").count()
        slices = min(SLICES, -(-n // SLICE_PAGES))
        for part in range(slices):
            _land_slice(spark, pages, keys, folder, part, slices)
            let_go(spark)


def _land_slice(
    spark: SparkSession, pages: DataFrame, keys: DataFrame, folder: str, part: int, slices: int
) -> None:
    """Land the new ones among every `slices`-th page.

    Few wanted pages are picked by their keys before anything moves. Copies are looked
    for only where the keys show some. The rebalance hint lets the adaptive planner
    split a hot topic over many tasks and files.
    """
    def own(frame: DataFrame) -> DataFrame:
        return frame.filter(F.pmod(F.xxhash64("topic", "page"), F.lit(slices)) == part) if slices > 1 else frame

    wanted = own(keys).where("not readable")
    n, odd = wanted.agg(F.count(F.lit(1)), F.max((F.col("copies") > 1) | F.col("known"))).first()
    if not n:
        return
    picked, incoming = own(keys).count() == n, own(pages)
    if not picked and n <= BROADCAST_ROWS:
        few = F.broadcast(wanted.select(F.col("topic").alias("_topic"), F.col("page").alias("_page")))
        same = F.col("topic").eqNullSafe(F.col("_topic")) & F.col("page").eqNullSafe(F.col("_page"))
        incoming, picked = incoming.join(few, same, "left_semi"), True
    fresh = with_page_facts(incoming)
    if odd or not picked:
        fresh = new_pages(fresh, own(read_landing(spark, folder)))
    writer = fresh.hint("rebalance", "topic").write.mode("append").option("compression", COMPRESSION)
    writer.partitionBy("topic").parquet(folder)


def read_landing(spark: SparkSession, folder: str) -> DataFrame:
    """The landing table; empty if nothing was landed yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    exists = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    if not exists:
        return spark.createDataFrame([], LANDING_SCHEMA)
    return spark.read.schema(LANDING_SCHEMA).parquet(folder)
