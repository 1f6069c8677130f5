"""OData entity sets: landed JSON pages and what a service's schema says about them."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zilverspoor.functions.nested import scalars

# Where a page keeps its rows and the link to the next page.
_PAGE = {"v4": ("value", "@odata.nextLink"), "v2": ("results", "__next")}


@dataclass(frozen=True)
class EntityType:
    """Keys, properties and navigation properties of an entity type."""

    name: str
    keys: tuple[str, ...]
    properties: Mapping[str, T.DataType]
    navigation: Mapping[str, T.DataType]
    times: frozenset[str] = frozenset()

    def columns(self, select: str | None = None, expand: str | None = None) -> list[str]:
        """Column order: keys, then the others as selected, then expanded navigation.

        Without ``select`` all properties come in schema order. A path such as
        ``Orders/Id`` counts for its first step; unknown names are ignored.
        """
        ordered = [*self.keys, *[p for p in self.properties if p not in self.keys]]
        if select:
            wanted = _names(select)
            ordered = [k for k in self.keys if k in wanted] + [
                p for p in wanted if p in self.properties and p not in self.keys
            ]
        return ordered + [n for n in _names(expand or "") if n not in ordered]

    def type_of(self, column: str) -> T.DataType:
        return {**self.navigation, **self.properties}.get(column, T.StringType())

    def wire_schema(self, columns: Sequence[str]) -> T.StructType:
        """What a page is read with: nested values as they are, scalars as text.

        Services differ in which numbers they quote, and version 2 has its own
        form for moments, so scalars are cast afterwards. A value that does not
        cast fails the job.
        """
        kinds = {c: self.type_of(c) for c in columns}
        return T.StructType(
            [T.StructField(c, k if _nested(k) else T.StringType()) for c, k in kinds.items()]
        )

    def value(self, column: str) -> Column:
        """A column of ``wire_schema`` in its declared type."""
        kind, raw = self.type_of(column), F.col(f"`{column}`")
        if column in self.times:
            raw = F.coalesce(time_of_duration(raw), raw)
        elif isinstance(kind, T.TimestampType):
            # an instant; text without an offset is UTC, whatever the session's zone
            zoned = F.when(raw.rlike(r"(?i)(?:Z|[+-]\d\d:?\d\d)$"), raw).otherwise(F.concat(raw, F.lit("Z")))
            raw = F.when(raw.startswith("/Date("), v2_instant(raw)).otherwise(zoned.cast("timestamp"))
        elif isinstance(kind, (T.TimestampNTZType, T.DateType)):
            raw = F.when(raw.startswith("/Date("), v2_timestamp(raw)).otherwise(
                raw.cast("timestamp_ntz")
            )
        return raw if _nested(kind) else raw.cast(kind)


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def _names(text: str) -> list[str]:
    steps = [part.strip().split("/")[0].strip() for part in text.split(",")]
    return list(dict.fromkeys(s for s in steps if s))


def page_schema(rows: T.StructType, version: str = "v4") -> T.StructType:
    rows_field, next_field = _PAGE[version]
    page = T.StructType(
        [
            T.StructField(rows_field, T.ArrayType(rows)),
            T.StructField(next_field, T.StringType()),
        ]
    )
    return page if version == "v4" else T.StructType([T.StructField("d", page)])


def read_pages(
    spark: SparkSession,
    path: str,
    entity: EntityType,
    version: str = "v4",
    select: str | None = None,
    expand: str | None = None,
    condition: Column | None = None,
    row_limit: int = 0,
) -> DataFrame:
    """Rows of landed pages, one JSON page per line.

    The read schema holds the wanted columns only, so other properties are never
    parsed; a property missing from a row is NULL. A damaged page fails the job.
    """
    bodies = spark.read.text(path).select(F.col("value").alias("body"))
    return parse_pages(
        bodies.where(F.trim("body") != ""), entity, version, select, expand, condition, row_limit
    )


def parse_pages(
    bodies: DataFrame,
    entity: EntityType,
    version: str = "v4",
    select: str | None = None,
    expand: str | None = None,
    condition: Column | None = None,
    row_limit: int = 0,
) -> DataFrame:
    """Rows of page bodies, one JSON text per row in the column ``body``.

    A column ``keep``, if there is one, says how many rows of a page to take.
    """
    columns = entity.columns(select, expand)
    schema = page_schema(entity.wire_schema(columns), version)
    body = F.col("body")
    if version == "v2":  # a bare list in place of an object with results
        bare = r"^\s*\{\s*\"d\"\s*:\s*\["
        wrapped = F.concat(F.regexp_replace(body, bare, '{"d":{"results":['), F.lit("}"))
        body = F.when(body.rlike(bare), wrapped).otherwise(body)
    keep = F.col("keep") if "keep" in bodies.columns else F.lit(None).cast("int")
    page = F.from_json(body, schema, {"mode": "FAILFAST"})
    pages = bodies.select(page.alias("page"), keep.alias("keep"))
    return _page_rows(pages, entity, columns, version, condition, row_limit)


def _page_rows(
    pages: DataFrame,
    entity: EntityType,
    columns: Sequence[str],
    version: str,
    condition: Column | None,
    row_limit: int,
) -> DataFrame:
    """A page has a bounded number of rows, so exploding it needs no shuffle."""
    field = _PAGE[version][0] if version == "v4" else f"d.{_PAGE[version][0]}"
    taken = F.when(F.col("keep").isNull(), F.col(f"page.{field}")).otherwise(
        F.slice(f"page.{field}", F.lit(1), F.coalesce("keep", F.lit(0)))
    )
    rows = pages.select(F.explode(taken).alias("row")).select("row.*")
    rows = rows.select(*[entity.value(c).alias(c) for c in columns])
    if condition is not None:
        rows = rows.where(condition)
    if row_limit > 0:
        rows = rows.limit(row_limit)
    return scalars(rows)


def v2_timestamp(value: Column) -> Column:
    """``/Date(1700000000000)/`` of version 2 as a zone-less UTC timestamp."""
    millis = F.regexp_extract(value, r"/Date\((-?\d+)", 1).try_cast("decimal(18,0)")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=(millis / 1000).cast("decimal(18,6)"))


def v2_instant(value: Column) -> Column:
    """``/Date(1700000000000+0060)/`` as an instant: the milliseconds are UTC, the offset is of
    no account."""
    millis = F.regexp_extract(value, r"/Date\((-?\d+)", 1).try_cast("bigint")
    return F.timestamp_millis(millis)


def time_of_duration(value: Column) -> Column:
    """``PT12H34M56S``, the version 2 time of day, as ``12:34:56``; other text is NULL."""
    # a part that is not given extracts as empty text and is padded to 00
    part = [F.lpad(F.regexp_extract(value, rf"(\d+){unit}", 1), 2, "0") for unit in "HMS"]
    return F.when(value.rlike(r"^PT(\d+H)?(\d+M)?(\d+S)?$"), F.concat_ws(":", *part))


# Service types and the Spark types that hold them.
EDM_TYPES: dict[str, T.DataType] = {
    "Edm.String": T.StringType(),
    "Edm.Guid": T.StringType(),
    "Edm.Boolean": T.BooleanType(),
    "Edm.Byte": T.ShortType(),
    "Edm.SByte": T.ByteType(),
    "Edm.Int16": T.ShortType(),
    "Edm.Int32": T.IntegerType(),
    "Edm.Int64": T.LongType(),
    "Edm.Single": T.FloatType(),
    "Edm.Double": T.DoubleType(),
    "Edm.Decimal": T.StringType(),
    "Edm.Date": T.DateType(),
    "Edm.DateTime": T.TimestampNTZType(),
    "Edm.DateTimeOffset": T.TimestampType(),
    "Edm.TimeOfDay": T.StringType(),
    "Edm.Time": T.StringType(),
    "Edm.Duration": T.StringType(),
    "Edm.Binary": T.StringType(),
}

_ENTITY_TYPE = """
    _Name string,
    Key struct<PropertyRef: array<struct<_Name: string>>>,
    Property array<struct<_Name: string, _Type: string, _Nullable: string>>,
    NavigationProperty array<struct<_Name: string, _Type: string>>
"""
_ENTITY_SET = "_Name string, _EntityType string"
_DOCUMENT = f"""
    DataServices struct<Schema: array<struct<
        EntityType: array<struct<{_ENTITY_TYPE}>>,
        EntityContainer: array<struct<EntitySet: array<struct<{_ENTITY_SET}>>>>
    >>>
"""


def _types(raw: DataFrame) -> DataFrame:
    empty = F.array().cast("array<string>")
    return raw.select(
        F.col("_Name").alias("entity_type"),
        F.coalesce(F.col("Key.PropertyRef._Name"), empty).alias("keys"),
        F.col("Property").alias("properties"),
        F.col("NavigationProperty").alias("navigation"),
    )


def _sets(raw: DataFrame) -> DataFrame:
    # the last step of a dotted name, where dots in brackets do not count
    last = F.element_at(F.split("_EntityType", r"\.(?![^\[]*\])"), -1)
    bare = F.regexp_replace(last, r"[\[\]]", "")
    return raw.select(F.col("_Name").alias("entity_set"), bare.alias("entity_type"))


def read_elements(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """All elements of a name in XML documents, a large document by many tasks.

    Spark's XML reader gives a document to one task. Here documents are text that is cut in front
    of every start tag, which Spark can do from anywhere in a file, so each piece but a document's
    first begins with an element. A document where that may not be so (tags in comments, CDATA, a
    document type, longer names that begin alike, an element of the name in another or without an
    end) is still read whole.
    """
    comment = F.regexp_replace("value", r"<!--[\s\S]*?-->", "")
    pieces = spark.read.option("lineSep", f"<{tag}").text(path).select(
        F.when(F.col("value").contains("<!--"), comment).otherwise(F.col("value")).alias("text"),
        F.col("_metadata.file_path").alias("file"),
    )
    text = F.col("text")
    attributes = r"""(?:[^<>"'/]++|/(?!>)|"[^"]*+"|'[^']*+')*+"""
    alone = rf"^(?:\s{attributes})?/>"
    ended = text.rlike(alone) | text.contains(f"</{tag}")
    head = text.rlike(r"^[\s\ufeff]*(?:<|$)")
    plain = head | (text.rlike(r"^(?:\s+[^\s<]|/?>)") & ended)
    # a comment over several pieces still has its begin; an end alone is a value
    odd = ~plain | text.contains("<!")
    whole = sorted(r["file"] for r in pieces.where(odd).select("file").distinct().collect())
    closed = F.concat(F.substring_index(text, f"</{tag}", 1), F.lit(f"</{tag}>"))
    element = F.when(text.rlike(alone), F.regexp_extract(text, alone, 0)).otherwise(closed)
    parsed = F.from_xml(F.concat(F.lit(f"<{tag}"), element), schema)
    found = pieces.where(~head & ~F.col("file").isin(whole)).select(parsed.alias("e")).select("e.*")
    if not whole:
        return found
    names = [re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file)) for file in whole]
    read = spark.read.format("xml").option("rowTag", tag).schema(schema).load(names)
    return found.unionByName(read)


def read_entity_types(spark: SparkSession, path: str) -> DataFrame:
    """Entity types of metadata documents: name, keys, properties, navigation."""
    return _types(read_elements(spark, path, "EntityType", _ENTITY_TYPE))


def read_entity_sets(spark: SparkSession, path: str) -> DataFrame:
    """Entity sets of metadata documents with the bare name of their type."""
    return _sets(read_elements(spark, path, "EntitySet", _ENTITY_SET))


def parse_metadata(spark: SparkSession, document: str) -> tuple[DataFrame, DataFrame]:
    """Entity types and entity sets of one metadata document given as text."""
    body = spark.createDataFrame([(document,)], "body string")
    parsed = body.select(F.from_xml("body", _DOCUMENT, {"ignoreNamespace": "true"}).alias("d"))
    schemas = parsed.select(F.explode("d.DataServices.Schema").alias("s"))
    types = schemas.select(F.explode("s.EntityType").alias("t")).select("t.*")
    containers = schemas.select(F.explode("s.EntityContainer").alias("c"))
    sets = containers.select(F.explode("c.EntitySet").alias("e")).select("e.*")
    return _types(types), _sets(sets)


def entity_properties(types: DataFrame) -> DataFrame:
    """One row per property with its type, nullability and whether it is a key."""
    return types.select("entity_type", "keys", F.explode("properties").alias("p")).select(
        "entity_type",
        F.col("p._Name").alias("property"),
        F.coalesce("p._Type", F.lit("Edm.String")).alias("edm_type"),
        (F.lower(F.coalesce("p._Nullable", F.lit("true"))) == "true").alias("nullable"),
        F.array_contains("keys", F.col("p._Name")).alias("is_key"),
    )


def entity_navigation(types: DataFrame) -> DataFrame:
    """One row per navigation property."""
    return types.select("entity_type", F.explode("navigation").alias("n")).select(
        "entity_type",
        F.col("n._Name").alias("navigation"),
        F.coalesce("n._Type", F.lit("")).alias("target_type"),
    )


def entity_type(types: DataFrame, name: str) -> EntityType:
    """One entity type as a reading contract; the name is matched in any case."""
    row = types.where(F.lower("entity_type") == name.lower()).first()
    if row is None:
        raise ValueError(f"entity type {name} is not in the service metadata")
    return _contract(row)


def entity_types(types: DataFrame) -> dict[str, EntityType]:
    """All entity types of a service by their name in lower case, the metadata parsed once."""
    return {row["entity_type"].lower(): _contract(row) for row in types.collect()}


def _contract(row: Row) -> EntityType:
    properties = row["properties"] or []
    return EntityType(
        row["entity_type"],
        tuple(row["keys"]),
        {
            p["_Name"]: EDM_TYPES.get(p["_Type"] or "Edm.String", T.StringType())
            for p in properties
        },
        {n["_Name"]: T.StringType() for n in row["navigation"] or []},
        frozenset(p["_Name"] for p in properties if p["_Type"] in ("Edm.Time", "Edm.TimeOfDay")),
    )
