from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_POINT = T.ArrayType(T.DoubleType())


def read_boundaries(
    spark: SparkSession, path: str, id_property: str = "tract_geoid", lines: bool = False
) -> DataFrame:
    """GeoJSON polygons and multipolygons as (tract_geoid, ord, rings).

    By default each file is one feature collection, as boundary files are published;
    ``lines=True`` reads one feature per line, which Spark splits. ``ord`` is the position
    of the feature over all files; with ``lines`` it follows the file order of ``monotonically_increasing_id``.
    """
    feature = T.StructType(
        [
            T.StructField("properties", T.StructType([T.StructField(id_property, T.StringType())])),
            T.StructField(
                "geometry",
                T.StructType(
                    [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
                ),
            ),
        ]
    )
    if lines:
        features = spark.read.schema(feature).json(path).select(
            F.monotonically_increasing_id().alias("ord"), F.struct("properties", "geometry").alias("f")
        )
    else:
        # As whole texts, so that each file is read once: the multi-line JSON reader was measured to read 75 times a file's size.
        whole = T.StructType([T.StructField("features", T.ArrayType(feature))])
        found = F.from_json(F.ltrim("value", F.lit("\ufeff")), whole)["features"]
        features = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(found).alias("at", "f"))
        # Positions go on from file to file, in the order of the files' names; one short row per file.
        files = features.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))
        offsets = files.select("file", F.coalesce(before, F.lit(0)).alias("before"))
        features = features.join(offsets, "file").select((F.col("before") + F.col("at")).alias("ord"), "f")
    # A polygon is a list of rings, a multipolygon a list of polygons.
    text = F.col("f.geometry.coordinates")
    one = F.from_json(text, T.ArrayType(T.ArrayType(_POINT)))
    many = F.flatten(F.from_json(text, T.ArrayType(T.ArrayType(T.ArrayType(_POINT)))))
    rings = F.when(F.col("f.geometry.type") == "MultiPolygon", many).otherwise(one)
    return features.select(
        F.trim(F.col(f"f.properties.{id_property}")).alias("tract_geoid"),
        F.col("ord").cast("long").alias("ord"),
        F.transform(
            rings,
            lambda ring: F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))),
        ).alias("rings"),
    )


def read_crosswalk(
    df: DataFrame, tract: str = "geoid", name: str = "ntaname"
) -> DataFrame:
    """Tract -> neighborhood pairs. Records lacking either are dropped; each tract once."""
    return (
        df.select(F.col(tract).alias("tract_geoid"), F.col(name).alias("neighborhood"))
        .dropna()
        .groupBy("tract_geoid")
        .agg(F.max("neighborhood").alias("neighborhood"))
    )
