"""The derived inputs match the stand-ins documented in FIXTURES.md (sf0.01)."""

from pyspark.sql import functions as F

from conftest import SF01
from fieldatlas import fixtures as fx
from fieldatlas.operators.documents import field


def test_occurrences_and_places_shapes(spark):
    occ = fx.occurrences(spark, SF01)
    assert occ.columns == ["occ_id", "species", "lon", "lat"]
    assert occ.count() == 15000
    places = fx.places(spark, SF01)
    assert places.count() == 1500
    assert places.where(F.col("name").rlike("(?i)customer#0000001.*")).count() > 0


def test_communities_are_25_closed_pentagons(spark):
    com = fx.communities(spark, SF01).collect()
    assert len(com) == 25
    for r in com:
        ring = r.rings[0]
        assert len(ring) == 6 and (ring[0].x, ring[0].y) == (ring[-1].x, ring[-1].y)


def test_flight_documents_counts(spark):
    docs = fx.flight_documents(spark, SF01)
    assert docs.count() == 700
    assert docs.where(field("statistics.flights.cancelled") > 30).count() == 257
    assert docs.where(
        (field("statistics.flights.cancelled") > 30) & (field("airport.code") == "NATION_7")
    ).count() == 19
