"""Source-name resolution and typed scans."""

from codetrail import schemas
from codetrail.sources import catalog as C
from checks import fixtures

from .conftest import SF_SMALL


def test_catalog_paths_and_override():
    cat = C.SourceCatalog("/data/")
    assert cat.path("celo", "transactions") == "/data/main/celo/transactions"
    assert cat.with_database("dev").path("prices", "day") == "/data/dev/prices/day"
    pinned = C.SourceCatalog("/data", pinned={("tokens", "transfers"): "/elsewhere/transfers"})
    assert pinned.path("tokens", "transfers") == "/elsewhere/transfers"
    assert pinned.with_database("x").path("tokens", "transfers") == "/elsewhere/transfers"


def test_fixtures_are_read_through_the_catalog_with_fixed_schemas(spark):
    paths = fixtures.materialize(spark, SF_SMALL)
    cat = fixtures.fixture_catalog(spark, SF_SMALL)
    assert paths["transactions"] == cat.path(*C.TRANSACTIONS)
    for name, sch in (("transactions", schemas.TRANSACTIONS), ("transfers", schemas.TRANSFERS),
                      ("prices", schemas.PRICES)):
        df = fixtures.load(spark, SF_SMALL, name)
        assert [f.name for f in df.schema.fields] == [f.name for f in sch.fields]
        assert [f.dataType for f in df.schema.fields] == [f.dataType for f in sch.fields]
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert fixtures.load(spark, SF_SMALL, "transactions").count() == ev


def test_windowed_read_lists_its_partitions_only(spark):
    import datetime as dt

    fixtures.materialize(spark, SF_SMALL)
    cat = fixtures.fixture_catalog(spark, SF_SMALL)
    whole, recent = cat.read(spark, *C.TRANSACTIONS), cat.read(spark, *C.TRANSACTIONS, since=dt.date(2024, 1, 29))
    assert recent.columns == whole.columns and len(recent.inputFiles()) < len(whole.inputFiles()) / 5
    bound = "block_date >= '2024-01-29'"
    assert recent.where(bound).count() == whole.where(bound).count() == recent.count()
    # a table without such partitions is read whole
    assert cat.read(spark, *C.PRICES, since=dt.date(2024, 1, 29)).count() == cat.read(spark, *C.PRICES).count()
