"""GeoJSON feeds made from whole test tables.

``history`` is every row of ``events``, ``daily`` every row of ``orders``, ``tolerant`` every row
of ``events`` again with broken features among them, and ``faulty`` once more for the plain loads,
with values of drifting type and documents that cannot be read. Keys are numbered by twos in history and by
threes in daily, so the feeds overlap on part of their keys at any scale; both have copies and
null keys. Magnitudes are binary fractions, so their sums are exact in any order.
``quakelake.fixtures.oracle`` states the same rows in SQL, without the JSON step.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quakelake.session import MOST_PARTITIONS

FEATURES_PER_DOCUMENT = 200
# Documents that meet in one task: some 20 MB of texts, and fewer groups than a hash aggregate keeps before it sorts.
DOCUMENTS_A_TASK = 100
_DAY_MILLIS = 86_400_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_document(rows: DataFrame) -> DataFrame:
    """Number the documents by position in the file: their size is bounded whatever the data."""
    block = F.floor(F.col("_metadata.row_index") / FEATURES_PER_DOCUMENT)
    return rows.select(
        "*", F.struct(F.col("_metadata.file_path").alias("file"), block.alias("block")).alias("document")
    )


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _table(spark, sf_dir, "nation").select(
        "n_nationkey", F.translate("n_name", "_0123456789", " abcdefghij").alias("nation")
    )
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", "nation"
    )


def _every(n: int, rest: int = 0) -> Column:
    return F.col("k") % n == rest


def _history_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _with_document(_table(spark, sf_dir, "events"))
    rows = events.join(_nations(spark, sf_dir), F.col("user_id") == F.col("c_custkey"), "left")
    k = F.col("event_id")
    return rows.select(
        "document",
        k.alias("k"),
        (F.when(k % 40 == 1, k - 1).otherwise(k) * 2).alias("key"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"),
        F.when(k % 17 != 0, F.floor(F.col("value") * 64) / 4096).alias("mag"),
        F.col("event_type").alias("label"),
        F.col("event_type").alias("tag"),
        "nation",
        F.when(k % 29 != 0, F.regexp_extract("props", r"(\d+)", 1).cast("double")).alias("depth"),
        (k % 43 == 0).alias("short"),
        (k % 101 == 0).alias("keyless"),
    )


def _daily_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _with_document(_table(spark, sf_dir, "orders"))
    rows = orders.join(_nations(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"), "left")
    k = F.col("o_orderkey")
    return rows.select(
        "document",
        k.alias("k"),
        (F.when(k % 50 == 1, k - 1).otherwise(k) * 3).alias("key"),
        (F.unix_millis(F.col("o_orderdate").cast("timestamp")) + k * 1000 % _DAY_MILLIS).alias("ms"),
        (F.floor("o_totalprice") / 65536).alias("mag"),
        F.col("o_orderstatus").alias("label"),
        F.col("o_orderpriority").alias("tag"),
        "nation",
        (k % 700).cast("double").alias("depth"),
        F.lit(False).alias("short"),
        (k % 103 == 0).alias("keyless"),
    )


def _place() -> Column:
    return (
        F.when(_every(13), F.lit(None).cast("string"))
        .when(_every(11), F.col("nation"))
        .when(_every(19), F.concat(F.lit("off the coast of "), "nation", F.lit(", "), "tag"))
        .otherwise(F.concat((F.col("k") % 90).cast("string"), F.lit(" km SSW of "), "nation"))
    )


def _properties() -> dict[str, Column]:
    k = F.col("k")
    text = k.cast("string")
    return {
        "mag": F.col("mag"),
        "place": _place(),
        "time": F.col("ms"),
        "updated": F.col("ms") + k * 1000 % _DAY_MILLIS,
        "tz": F.when(~_every(2), (k % 24 * 60 - 720).cast("int")),
        "url": F.concat(F.lit("https://example.org/event/"), text),
        "detail": F.concat(F.lit("https://example.org/detail/"), text, F.lit(".geojson")),
        "felt": F.when(_every(3, 2), (k % 50).cast("int")),
        "cdi": F.when(~_every(5), (k % 90).cast("double") / 10),
        "mmi": F.when(~_every(4), (k % 80).cast("double") / 10),
        "alert": F.when(_every(6), F.lit("green")),
        "status": F.col("label"),
        "tsunami": (k % 2).cast("int"),
        "sig": (k % 1000).cast("int"),
        "net": F.lit("us"),
        "code": text,
        "ids": F.when(~F.col("keyless"), F.concat(F.lit(",ev"), F.col("key").cast("string"), F.lit(","))),
        "sources": F.lit(",us,"),
        "types": F.lit(",origin,phase-data,"),
        "nst": F.when(~_every(9), (k % 60).cast("int")),
        "dmin": F.when(~_every(8), (k % 400).cast("double") / 100),
        "rms": (k % 150).cast("double") / 100,
        "gap": F.when(~_every(10), (k % 360).cast("double")),
        "magType": F.lit("ml"),
        "type": F.col("label"),
        "title": F.concat(F.lit("M event "), text),
    }


def _json_null() -> Column:
    return F.parse_json(F.lit("null"))


def _written(value: Column) -> Column:
    """A column as variant, with its null as a JSON null. A SQL null variant is a missing key."""
    return F.coalesce(value.cast("variant"), _json_null())


def _missing() -> Column:
    return F.lit(None).cast("variant")


def _coordinates(short: Column) -> Column:
    k = F.col("k")
    longitude, latitude = (k % 360 - 180).cast("double"), (k % 180 - 90).cast("double")
    two, three = F.array(longitude, latitude), F.array(longitude, latitude, F.col("depth"))
    return F.when(short, two).otherwise(three)


def _feature_text(id_: Column, properties: Column, coordinates: Column) -> Column:
    """JSON text of a feature; to_json leaves out what is SQL null, so nulls that count are variants."""
    body = F.struct(
        F.lit("Feature").alias("type"),
        properties.alias("properties"),
        F.struct(F.lit("Point").alias("type"), coordinates.alias("coordinates")).alias("geometry"),
        id_.alias("id"),
    )
    return F.to_json(body)


def _properties_struct(columns: dict[str, Column]) -> Column:
    return F.struct(*[column.alias(name) for name, column in columns.items()])


def _event_id() -> Column:
    return F.concat(F.lit("ev"), F.col("key").cast("string"))


def _regular(base: DataFrame) -> DataFrame:
    properties = {name: _written(column) for name, column in _properties().items()}
    properties["felt"] = F.when(~_every(3), properties["felt"])
    text = _feature_text(_event_id(), _properties_struct(properties), _coordinates(F.col("short")))
    return base.select("document", text.alias("feature"))


def _with_faults(base: DataFrame) -> DataFrame:
    plain = _properties()
    properties = {name: _written(column) for name, column in plain.items()}

    def as_text(name: str) -> Column:
        return _written(plain[name].cast("string"))

    properties |= {
        "mag": F.when(_every(97), _written(F.lit("abc")))
        .when(_every(23), as_text("mag"))
        .when(_every(19, 1), _missing())
        .otherwise(properties["mag"]),
        "place": F.when(_every(31, 3), _missing()).otherwise(properties["place"]),
        "time": F.when(_every(37), _written(F.lit("abc")))
        .when(_every(31), as_text("time"))
        .when(_every(41), _json_null())
        .otherwise(properties["time"]),
        "felt": F.when(~_every(3), properties["felt"]),
        "status": F.when(_every(59), _missing())
        .when(_every(61), _json_null())
        .otherwise(properties["status"]),
        "tsunami": F.when(_every(53), _json_null()).otherwise(properties["tsunami"]),
        "sig": F.when(_every(73), _written(plain["sig"] + F.lit(0.5)))
        .when(_every(43, 1), _written(plain["sig"] + F.lit(5_000_000_000)))
        .otherwise(properties["sig"]),
        "nst": F.when(_every(79), _written(F.lit("abc")))
        .when(_every(47), _written(plain["nst"].cast("double")))
        .otherwise(properties["nst"]),
        "title": F.when(_every(67), _missing()).otherwise(properties["title"]),
    }
    text = _feature_text(
        F.when(~_every(71), _event_id()),
        F.when(~_every(83), _properties_struct(properties)),
        F.when(~_every(89), _coordinates(F.col("short"))),
    )
    return base.select("document", text.alias("feature"))


def _stray(base: DataFrame) -> DataFrame:
    """Values of drifting type, elements that are no feature, and repeated keys."""
    plain = _properties()
    properties = {name: _written(column) for name, column in plain.items()}
    properties |= {
        "mag": F.when(_every(97), _written(F.lit("abc")))
        .when(_every(23), _written(plain["mag"].cast("string")))
        .otherwise(properties["mag"]),
        "felt": F.when(_every(7), _written(plain["felt"].cast("double"))).otherwise(properties["felt"]),
        "sig": F.when(_every(73), _written(plain["sig"] + F.lit(0.5))).otherwise(properties["sig"]),
    }
    whole = [_written(F.get(_coordinates(F.col("short")), F.lit(i))) for i in range(3)]
    latitude = F.when(_every(89), _written(F.lit("abc"))).otherwise(whole[1])
    coordinates = F.when(F.col("short"), F.array(whole[0], latitude)).otherwise(F.array(whole[0], latitude, whole[2]))
    text = _feature_text(_event_id(), _properties_struct(properties), coordinates)
    repeated = F.regexp_replace(text, '"mag":', '"mag":-1,"mag":')
    inside = F.to_json(F.struct(text.alias("x")))
    return base.select(
        "document",
        F.when(_every(101), F.lit("7"))
        .when(_every(103), F.regexp_extract(inside, r'^\{"x":(.*)\}$', 1))
        .when(_every(31), repeated)
        .otherwise(text)
        .alias("feature"),
    )


def _documents(features: DataFrame, separator: str, *also: str) -> DataFrame:
    """Feature texts to FeatureCollection texts, one per document number."""
    return (
        features.groupBy("document")
        .agg(F.collect_list("feature").alias("features"))
        .select(
            F.concat(
                F.lit(f'{{"type": "FeatureCollection",{separator}"features": [{separator}'),
                F.array_join("features", f",{separator}"),
                F.lit(f"{separator}]}}"),
            ).alias("value"),
            *also,
        )
    )


def _by_document(base: DataFrame, source: DataFrame) -> DataFrame:
    """The one shuffle of a feed, while the rows are still narrow.

    Its partitions follow from the number of source rows: rows grow tenfold when they become texts, so
    partitions joined by the size of what is shuffled would sort and spill the texts.
    """
    documents = source.count() / FEATURES_PER_DOCUMENT
    tasks = max(source.sparkSession.sparkContext.defaultParallelism, math.ceil(documents / DOCUMENTS_A_TASK))
    return base.repartition(min(tasks, MOST_PARTITIONS), "document")


def _history_by_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_document(_history_base(spark, sf_dir), _table(spark, sf_dir, "events"))


def history(spark: SparkSession, sf_dir: str, separator: str = " ") -> DataFrame:
    return _documents(_regular(_history_by_document(spark, sf_dir)), separator)


def daily(spark: SparkSession, sf_dir: str, separator: str = " ") -> DataFrame:
    base = _by_document(_daily_base(spark, sf_dir), _table(spark, sf_dir, "orders"))
    return _documents(_regular(base), separator)


def tolerant(spark: SparkSession, sf_dir: str, separator: str = " ") -> DataFrame:
    return _documents(_with_faults(_history_by_document(spark, sf_dir)), separator)


def faulty(spark: SparkSession, sf_dir: str, separator: str = " ") -> DataFrame:
    """History with drifting values; of five documents one is cut off, one has text after it, and
    one text holds two documents."""
    base = _history_base(spark, sf_dir)
    number = F.floor(F.col("k") / FEATURES_PER_DOCUMENT)
    dealt = _by_document(base.withColumn("document", number), _table(spark, sf_dir, "events"))
    documents = _documents(_stray(dealt), separator, "document")
    text, kind = F.col("value"), F.col("document") % 5
    return documents.select(
        F.when(kind == 1, F.substring(text, F.lit(1), F.length(text) - 3))
        .when(kind == 2, F.concat(text, F.lit(" end")))
        .when(kind == 3, F.concat(text, F.lit(" "), text))
        .otherwise(text)
        .alias("value")
    )
