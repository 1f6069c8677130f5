import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fake_service import ChangingService, FakeService
from zilverspoor.sources.odata import (
    _ENTITY_SET,
    _ENTITY_TYPE,
    EntityType,
    entity_navigation,
    entity_type,
    parse_pages,
    read_elements,
    read_entity_sets,
    read_entity_types,
    read_pages,
)
from zilverspoor.sources.odata_service import (
    PageReader,
    ServiceError,
    page_of,
    probe_rows,
    read_service,
    request_url,
)

ITEMS = EntityType("Item", ("id",), {"value": T.StringType(), "id": T.LongType()}, {})


@pytest.mark.parametrize("version", ["v4", "v2"])
@pytest.mark.parametrize("server_page", [None, 2])
@pytest.mark.parametrize("counts", [True, False])
def test_every_row_once(spark, version, server_page, counts):
    service = FakeService(23, server_page, counts, version)
    df = read_service(spark, service, "Items", ITEMS, version, page_rows=5, pages_per_task=2)
    assert df.columns == ["id", "value"]
    assert sorted(r["id"] for r in df.collect()) == list(range(23))


def test_links_only(spark):
    df = read_service(spark, FakeService(7, 3), "Items", ITEMS, links_only=True)
    assert sorted(r["id"] for r in df.collect()) == list(range(7))


def test_row_limit_inside_a_page(spark):
    df = read_service(spark, FakeService(23), "Items", ITEMS, row_limit=7, page_rows=5)
    assert df.count() == 7
    assert read_service(spark, FakeService(3), "Items", ITEMS, row_limit=7).count() == 3


def test_empty_set(spark):
    assert read_service(spark, FakeService(0, counts=False), "Items", ITEMS).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 3, 8, 1000])
def test_probe(size):
    reader = PageReader(FakeService(size, counts=False), {"entityset": "Items"})
    assert probe_rows(reader._row_at) == size


def test_request_url_escapes():
    url = request_url("[A].[B]", filter="Name eq 'x y'", skip=0, top=5, select="a,b")
    assert url == "%5BA%5D.%5BB%5D?$filter=Name%20eq%20%27x%20y%27&$top=5&$select=a,b"


def test_page_of():
    page = page_of('{"d": {"results": [{"a": 1}], "__next": "x"}}')
    assert (page.rows, page.link) == ([{"a": 1}], "x")
    assert page_of('{"value": []}').rows == [] and page_of('{"d": [{"a": 1}]}').rows == [{"a": 1}]


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_count_bounds_nothing(spark):
    """A service that counts too few, or too many, rows still gives all of them once."""
    for said in (0, 5, 40):
        service = FakeService(12, said=said)
        df = read_service(spark, service, "Items", ITEMS, page_rows=2, pages_per_task=2)
        assert ids(df) == list(range(12))


@pytest.mark.parametrize("links_only", [True, False])
def test_an_empty_page_with_a_link_goes_on(spark, links_only):
    service = FakeService(9, 3, empty_before=3)
    df = read_service(spark, service, "Items", ITEMS, links_only=links_only, page_rows=9)
    assert ids(df) == list(range(9))


def test_a_link_that_forgets_the_range_adds_nothing(spark):
    service = FakeService(10, 3, forgets=True)
    df = read_service(spark, service, "Items", ITEMS, page_rows=5, pages_per_task=1)
    assert ids(df) == list(range(10))
    assert read_service(spark, service, "Items", ITEMS, row_limit=4, page_rows=5).count() == 4


@pytest.mark.parametrize("counts", [True, False])
def test_a_service_that_ignores_positions_is_read_by_its_links(spark, counts):
    service = FakeService(11, 4, counts, ignores_skip=True)
    df = read_service(spark, service, "Items", ITEMS, page_rows=2, pages_per_task=1)
    assert ids(df) == list(range(11))


def test_probing_ends(spark):
    with pytest.raises(ValueError, match="still has rows"):
        probe_rows(lambda position: {"id": position})


def test_rows_are_asked_for_in_key_order(spark):
    service = FakeService(23, shuffles=True)
    df = read_service(spark, service, "Items", ITEMS, page_rows=3, pages_per_task=2)
    assert ids(df) == list(range(23))


def test_a_bare_list_of_version_2(spark, tmp_path):
    service = FakeService(7, version="v2", bare=True)
    df = read_service(spark, service, "Items", ITEMS, "v2", page_rows=3, pages_per_task=1)
    assert ids(df) == list(range(7))
    (tmp_path / "pages").write_text('{"d": [{"id": 1}, {"id": 2}]}\n{"d":{"results":[{"id":3}]}}\n')
    assert ids(read_pages(spark, str(tmp_path / "pages"), ITEMS, "v2")) == [1, 2, 3]


def test_a_damaged_page_is_an_error(spark, tmp_path):
    (tmp_path / "pages").write_text('{"value":[{"id":1}]}\n{"value":[{"id":2},{"i\n{"value":[{"id":4}]}\n')
    with pytest.raises(Exception, match="MALFORMED"):
        read_pages(spark, str(tmp_path / "pages"), ITEMS).collect()


@pytest.mark.parametrize("zone", ["UTC", "Europe/Amsterdam"])
def test_instants_keep_their_offset(spark, zone):
    thing = EntityType("T", ("id",), {"id": T.LongType(), "at": T.TimestampType()}, {})
    v4 = '{"value":[{"id":1,"at":"2024-01-01T00:30:00+02:00"},{"id":2,"at":"2024-01-01T00:30:00Z"},' \
        '{"id":3,"at":"2024-01-01T00:30:00"}]}'
    v2 = '{"d":{"results":[{"id":1,"at":"/Date(1704061800000+0120)/"}]}}'
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for version, body, want in (("v4", v4, [1704061800, 1704069000, 1704069000]), ("v2", v2, [1704061800])):
            rows = parse_pages(spark.createDataFrame([(body,)], "body string"), thing, version)
            got = rows.selectExpr("unix_seconds(at) AS s").collect()
            assert [r["s"] for r in got] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_scalars_of_both_versions(spark):
    thing = EntityType(
        "T",
        ("id",),
        {
            "id": T.LongType(),
            "amount": T.StringType(),
            "moment": T.TimestampNTZType(),
            "day": T.DateType(),
            "at": T.StringType(),
            "ok": T.BooleanType(),
        },
        {"lines": T.ArrayType(T.StructType([T.StructField("n", T.IntegerType())]))},
        frozenset({"at"}),
    )
    v2 = '{"d":{"results":[{"id":"7","amount":"1.23","moment":"/Date(1700000000123)/",' \
        '"day":"/Date(-86400000)/","at":"PT12H4M56S","ok":true,"lines":[{"n":1}]}]}}'
    v4 = '{"value":[{"id":7,"amount":1.23,"moment":"2023-11-14T22:13:20.123",' \
        '"day":"1969-12-31","at":"12:04:56","ok":true,"lines":[{"n":1}]}]}'
    for version, body in (("v2", v2), ("v4", v4)):
        bodies = spark.createDataFrame([(body,)], "body string")
        row = parse_pages(bodies, thing, version, expand="lines").first()
        moment = dt.datetime(2023, 11, 14, 22, 13, 20, 123000)
        assert tuple(row) == (
            7, "1.23", moment, dt.date(1969, 12, 31), "12:04:56", True, '[{"n":1}]'
        )


def test_a_value_of_another_type_is_an_error(spark):
    bodies = spark.createDataFrame([('{"value":[{"id":"x"}]}',)], "body string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        parse_pages(bodies, ITEMS).collect()


def test_column_order():
    product = EntityType(
        "P", ("Id",), {"Name": T.StringType(), "Id": T.IntegerType(), "Price": T.DoubleType()}, {}
    )
    assert product.columns() == ["Id", "Name", "Price"]
    assert product.columns("Price, Id,Name/First,Nope") == ["Id", "Price", "Name"]
    assert product.columns("Price", "Orders/Lines,Price") == ["Price", "Orders"]


def test_metadata(spark, tmp_path):
    (tmp_path / "metadata.xml").write_text(
        """<?xml version="1.0"?>
<edmx:Edmx Version="4.0" xmlns:edmx="http://docs.oasis-open.org/odata/ns/edmx"><edmx:DataServices>
<Schema Namespace="Shop" xmlns="http://docs.oasis-open.org/odata/ns/edm">
<EntityType Name="Product"><Key><PropertyRef Name="ID"/></Key>
<Property Name="Name"/><Property Name="ID" Type="Edm.Int32" Nullable="false"/>
<NavigationProperty Name="Orders" Type="Collection(Shop.Order)"/></EntityType>
<EntityContainer><EntitySet Name="Products" EntityType="Shop.Product"/>
<EntitySet Name="[S].[T]" EntityType="Shop.[Odd]"/></EntityContainer>
</Schema></edmx:DataServices></edmx:Edmx>"""
    )
    types = read_entity_types(spark, str(tmp_path))
    product = entity_type(types, "product")
    assert product.columns(expand="Orders") == ["ID", "Name", "Orders"]
    assert product.properties == {"Name": T.StringType(), "ID": T.IntegerType()}
    sets = {tuple(r) for r in read_entity_sets(spark, str(tmp_path)).collect()}
    assert sets == {("Products", "Product"), ("[S].[T]", "Odd")}
    with pytest.raises(ValueError):
        entity_type(types, "Nope")


PARTS = """<?xml version="1.0"?><!-- made by hand -->
<Edmx><Schema><EntityType Name="A" Note="1 > 0 / 2"><Key><PropertyRef Name="ID"/></Key>
<!-- no longer: <Property Name="Old"/> --><Property Name="ID" Type='Edm.Int32'></Property>
<Property Name="x &lt;&amp; y"/></EntityType  ><EntityType
 Name="/>"/><EntityType/><EntityType><Property Name="p"/></EntityType>
<EntityContainer><EntitySet Name="As" EntityType="S.A" /><EntitySet Name="Cs" EntityType="S.C"></EntitySet>
</EntityContainer></Schema></Edmx>"""
ODD_PARTS = [
    '<Schema><!-- <EntityType Name="Gone"/> --><EntityType Name="B"/></Schema>',
    '<Schema><EntityType Name="C"><Note><![CDATA[</EntityType>]]></Note></EntityType></Schema>',
    '<Schema><EntityTypes/><EntityType Name="D"><EntityTypeNote/><Key/></EntityType></Schema>',
]


def test_elements_are_those_of_the_xml_reader(spark, tmp_path):
    for number, document in enumerate([PARTS, *ODD_PARTS, " " + PARTS.split("?>")[1], "<Schema/>"]):
        (tmp_path / f"a {number}{{x}}.xml").write_text(document)
    for tag, schema, n in (("EntityType", _ENTITY_TYPE, 11), ("EntitySet", _ENTITY_SET, 4)):
        got = read_elements(spark, str(tmp_path), tag, schema)
        want = spark.read.format("xml").option("rowTag", tag).schema(schema).load(str(tmp_path))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        assert got.count() == n


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    types = "".join(f'<EntityType Name="T{i}"><Key/></EntityType>' for i in range(20_000))
    (tmp_path / "metadata.xml").write_text(f"<Schema>{types}</Schema>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = read_entity_types(spark, str(tmp_path))
        assert rows.select("entity_type").distinct().count() == rows.count() == 20_000
        tasks = rows.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) >= 10 and max(r["count"] for r in tasks) < 4_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_navigation_of_one_document_comes_from_many_tasks(spark, tmp_path):
    ends = '<NavigationProperty Name="Orders" Type="Collection(S.O)"/><NavigationProperty Name="Of"/>'
    types = "".join(f'<EntityType Name="T{i}">{ends if i % 2 else ""}</EntityType>' for i in range(6_000))
    (tmp_path / "metadata.xml").write_text(f"<Schema>{types}</Schema>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = entity_navigation(read_entity_types(spark, str(tmp_path)))
        got = [tuple(r) for r in found.withColumn("task", F.spark_partition_id()).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {(f"T{i}", *end) for i in range(1, 6_000, 2) for end in (("Orders", "Collection(S.O)"), ("Of", ""))}
    assert len(got) == 6_000 and {r[:3] for r in got} == want
    assert len({r[3] for r in got}) >= 8


def test_ends_of_comments_in_values_leave_a_document_to_many_tasks(spark, tmp_path):
    value = "a --> b &lt;!-- ]]>"
    end = f'<NavigationProperty Name="Of" Type="{value}"/>'
    types = "".join(f'<EntityType Name="T{i}"><!-- {i} -->{end}</EntityType>' for i in range(6_000))
    (tmp_path / "metadata.xml").write_text(f"<Schema>{types}</Schema>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = entity_navigation(read_entity_types(spark, str(tmp_path)))
        got = [tuple(r) for r in found.withColumn("task", F.spark_partition_id()).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {(f"T{i}", "Of", "a --> b <!-- ]]>") for i in range(6_000)}
    assert len(got) == 6_000 and {r[:3] for r in got} == want
    assert len({r[3] for r in got}) >= 8


def test_comments_over_several_pieces_are_those_of_the_xml_reader(spark, tmp_path):
    (tmp_path / "metadata.xml").write_text(
        """<Schema><EntityType Name="A --> x"/><!-- was <EntityType Name="Gone"/> and
<EntityType Name="Gone too"/> --><EntityType Name="B"><Key/><!-- <EntityType Name="No"/>
--><Property Name="-->"/></EntityType></Schema>"""
    )
    got = read_entity_types(spark, str(tmp_path)).collect()
    raw = spark.read.format("xml").option("rowTag", "EntityType").schema(_ENTITY_TYPE)
    want = {r["_Name"] for r in raw.load(str(tmp_path)).collect()}
    assert {r["entity_type"] for r in got} == want == {"A --> x", "B"}


def keyed(spark, service, keys=None, **more):
    kinds = {"id": T.LongType(), **(keys or {}), "value": T.StringType()}
    entity = EntityType("Item", tuple(keys or ["id"]), kinds, {})
    return read_service(spark, service, "Items", entity, by_key=True, page_rows=20, **more)


def test_keys_neither_lose_nor_repeat_rows_that_come_between_pages(spark, tmp_path):
    always, later = list(range(0, 4000, 8)), [i * 8 + 3 for i in range(499, -1, -1)]
    service = ChangingService(always, later, str(tmp_path / "n"))
    df = keyed(spark, service)
    got = [r["id"] for r in df.collect()]
    assert len(got) == len(set(got)) and set(always) <= set(got) <= {*always, *later}
    assert df.rdd.getNumPartitions() > 8
    # the same service by positions repeats rows, as these move
    service = ChangingService(always, later, str(tmp_path / "m"), positions=True)
    entity = EntityType("Item", ("id",), {"id": T.LongType(), "value": T.StringType()}, {})
    moved = read_service(spark, service, "Items", entity, page_rows=20, pages_per_task=1)
    ids = [r["id"] for r in moved.collect()]
    assert len(ids) != len(set(ids)) or not set(always) <= set(ids)


def test_key_ranges_skip_gaps_and_stay_open(spark, tmp_path):
    keys = [*range(5), 10**12, *range(10**15, 10**15 + 200)]
    service = ChangingService(keys, [10**15 + 5000], str(tmp_path / "n"), server_page=7)
    df = keyed(spark, service)
    assert sorted(r["id"] for r in df.collect()) == [*keys, 10**15 + 5000]
    assert df.rdd.getNumPartitions() <= 4
    assert keyed(spark, ChangingService([], [], str(tmp_path / "e"))).count() == 0
    assert keyed(spark, ChangingService([7], [], str(tmp_path / "o"))).count() == 1
    assert keyed(spark, service, row_limit=33).count() == 33
    some = keyed(spark, service, condition="id lt 3", select="value")
    assert sorted(r["value"] for r in some.collect()) == ["v0", "v1", "v2"]


def test_text_and_several_keys(spark, tmp_path):
    names = [f"n'{i:03d}" for i in range(90)]
    text = {"name": T.StringType()}
    service = ChangingService(names, [], str(tmp_path / "t"), keys=("name",))
    assert sorted(r["name"] for r in keyed(spark, service, text).collect()) == names
    pairs = [(a, b) for a in range(9) for b in range(11)]
    service = ChangingService(pairs, [], str(tmp_path / "p"), keys=("a", "b"), server_page=4)
    got = keyed(spark, service, {"a": T.LongType(), "b": T.LongType()})
    assert sorted((r["a"], r["b"]) for r in got.collect()) == pairs


def test_services_that_cannot_be_paged_by_key(spark, tmp_path):
    with pytest.raises(ServiceError, match="cannot be paged"):
        keyed(spark, FakeService(3), {"x": T.BinaryType()})
    with pytest.raises(Exception, match="again"):  # ignores conditions
        keyed(spark, FakeService(30), row_limit=50).collect()
