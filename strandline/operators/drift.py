"""What messages hold that their feed does not know, and the reverse.

A permissive parse drops unknown fields and turns a field of another type into NULL, and nobody hears of it. Here each message is
read as a variant, and its paths are counted by type next to the paths of the feed's schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.contracts import Feed
from strandline.functions import utc_day
from strandline.operators.lists import listed
from strandline.session import scratch_dir

ROOT = "$"
MALFORMED = "MALFORMED"
UNKNOWN, MISSING, RETYPED = "unknown", "missing", "retyped"

# Types of a JSON value that a field accepts.
WHOLE, FRACTION, TEXT, TRUTH = "BIGINT", "DOUBLE", "STRING", "BOOLEAN"
ACCEPTED = {
    T.StringType: (TEXT,),
    T.BooleanType: (TRUTH,),
    T.DoubleType: (WHOLE, FRACTION),
    T.FloatType: (WHOLE, FRACTION),
    T.IntegerType: (WHOLE,),
    T.LongType: (WHOLE,),
    T.StructType: ("OBJECT",),
    T.ArrayType: ("ARRAY",),
}


def expected_paths(schema: T.StructType) -> list[tuple[str, str | None, str]]:
    """Path, the path it stands in, and accepted types (joined by ``|``) of each field at any depth, as ``$.list[].main.aqi``.

    ``list[]`` stands for each element of an array.
    """
    out: list[tuple[str, str | None, str]] = [(ROOT, None, "OBJECT")]

    def add(path: str, parent: str, kind: T.DataType) -> None:
        out.append((path, parent, "|".join(ACCEPTED.get(type(kind), (TEXT,)))))
        if isinstance(kind, T.ArrayType):
            add(f"{path}[]", path, kind.elementType)
        elif isinstance(kind, T.StructType):
            for field in kind.fields:
                add(f"{path}.{field.name}", path, field.dataType)

    for field in schema.fields:
        add(f"{ROOT}.{field.name}", ROOT, field.dataType)
    return out


def _kind(value: Column) -> Column:
    """The type of a variant value in short: numbers are whole or fractions, whatever their size."""
    name = F.substring_index(F.schema_of_variant(value), "<", 1)
    name = F.substring_index(name, "(", 1)
    return F.when(name.isin("DECIMAL", "FLOAT", "DOUBLE"), FRACTION).otherwise(name)


def _entries(values: Column, path: str) -> Column:
    """``path`` and ``kind`` of all fields of an array of objects (variants)."""
    one = lambda value: F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))
    fields = F.flatten(F.transform(values, lambda value: F.coalesce(one(value), F.expr(_NOTHING))))
    named = lambda field: F.struct(
        F.concat(F.lit(f"{path}."), field["key"]).alias("path"), _kind(field["value"]).alias("kind")
    )
    return F.transform(fields, named)


def _fields(values: Column, name: str) -> Column:
    """The values of one field of an array of objects (variants), where it is there."""
    inner = F.transform(values, lambda value: F.try_variant_get(value, f"$['{name}']", "variant"))
    return F.filter(inner, lambda value: value.isNotNull())


_NOTHING = "CAST(array() AS array<struct<key:string,value:variant>>)"


def found_paths(whole: Column, schema: T.StructType) -> Column:
    """Each path of a message (a variant, null if its text is no JSON) with its type, as an array of ``path`` and ``kind``; objects are entered where ``schema`` has one.

    So what an unknown object holds is not told, only that it is there. Text that is no JSON is one path, the root, of kind ``MALFORMED``.
    """
    # Objects of a node, wherever arrays lie on the way, as an array of variants.
    parts = [F.array(F.struct(F.lit(ROOT).alias("path"), F.coalesce(_kind(whole), F.lit(MALFORMED)).alias("kind")))]

    def enter(values: Column, kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            parts.append(_entries(values, path))
            for field in kind.fields:
                if isinstance(field.dataType, (T.StructType, T.ArrayType)):
                    enter(_fields(values, field.name), field.dataType, f"{path}.{field.name}")
        elif isinstance(kind, T.ArrayType):
            lists = F.transform(values, lambda v: F.try_variant_get(v, "$", "array<variant>"))
            elements = F.flatten(F.filter(lists, lambda v: v.isNotNull()))
            parts.append(
                F.transform(elements, lambda v: F.struct(F.lit(f"{path}[]").alias("path"), _kind(v).alias("kind")))
            )
            enter(elements, kind.elementType, f"{path}[]")

    enter(F.filter(F.array(whole), lambda v: v.isNotNull()), schema, ROOT)
    return F.concat(*parts)


def path_counts(bronze: DataFrame, feed: Feed, by: tuple[str, ...] = ("topic", "day")) -> DataFrame:
    """How often each path stands in the messages of each topic and UTC day, by type: ``topic``, ``day``, ``path``, ``kind``, ``n``.

    One scan; tasks count their own paths before the shuffle, so what is moved is as small as the report.
    """
    schema = bronze.sparkSession.createDataFrame([], feed.payload).schema
    dated = bronze.withColumns({"day": utc_day(F.col("timestamp")), "_whole": F.try_parse_json("json_str")})
    found = dated.select(*by, F.explode(found_paths(F.col("_whole"), schema)).alias("found"))
    return found.groupBy(*by, F.col("found.path").alias("path"), F.col("found.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def schema_drift(bronze: DataFrame, feed: Feed, by: tuple[str, ...] = ("topic", "day")) -> DataFrame:
    """Where messages and the feed's payload differ, for each topic and UTC day.

    ``path``, ``verdict``, ``kind`` (the type that was found, null for what is missing), ``n`` and ``of``, the number of places where the
    path could stand (objects for a field, elements for an element, messages for the root):

    * ``unknown``: the feed has no such field, its parse drops it;
    * ``retyped``: the value is of a type that the field does not take, so the parse makes it NULL. Malformed text is a
      retyped root; a JSON ``null`` is missing;
    * ``missing``: objects without a field that the feed has.
    """
    spark = bronze.sparkSession
    schema = spark.createDataFrame([], feed.payload).schema
    known = listed(spark, "path STRING, parent STRING, accepted STRING", expected_paths(schema))
    # The report itself: a row for each path and type. It is written once, as several parts of the result read it.
    place = scratch_dir(spark, "drift")
    path_counts(bronze, feed, by).write.parquet(place)
    counts = spark.read.parquet(place)
    stood = counts.groupBy(*by, "path").agg(F.sum("n").alias("stood"), F.sum(F.when(F.col("kind") != "VOID", F.col("n"))).alias("seen"))
    holders = counts.where("kind = 'OBJECT'").select(*by, F.col("path").alias("parent"), F.col("n").alias("holders"))

    joined = counts.where("kind <> 'VOID'").join(known, "path", "left")
    fits = F.array_contains(F.split("accepted", r"\|"), F.col("kind"))
    verdict = F.when(F.col("accepted").isNull(), UNKNOWN).when(~fits, RETYPED)
    strange = joined.withColumn("verdict", verdict).where("verdict IS NOT NULL")
    # Unknown fields stand in an object whose path is theirs without the last step.
    parents = F.col("path").substr(F.lit(1), F.length("path") - F.length(F.regexp_extract("path", r"\.[^.]*$", 0)))
    strange = strange.withColumn("parent", F.coalesce("parent", parents)).join(stood.drop("seen"), [*by, "path"])
    strange = strange.join(holders, [*by, "parent"], "left")
    # A field stands in objects, an element among elements, the root in messages.
    own = F.endswith("path", F.lit("[]")) | (F.col("path") == ROOT)
    of = F.when(own, F.col("stood")).otherwise(F.coalesce("holders", "stood"))
    strange = strange.select(*by, "path", "verdict", "kind", "n", of.alias("of"))

    # The fields of an object; elements of an array can't be missing.
    fields = known.where("parent IS NOT NULL AND NOT endswith(path, '[]')").drop("accepted")
    lacking = holders.join(fields, "parent").join(stood, [*by, "path"], "left")
    lacking = lacking.withColumn("n", F.col("holders") - F.coalesce("seen", F.lit(0))).where("n > 0")
    nothing = F.lit(None).cast("string").alias("kind")
    missing = lacking.select(*by, "path", F.lit(MISSING).alias("verdict"), nothing, "n", F.col("holders").alias("of"))
    return strange.unionByName(missing)
