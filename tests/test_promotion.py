"""Promotion twice, and tables that are written together."""

import pytest
from pyspark.sql import functions as F

from lorekeeper.plans.promotion import promotion
from lorekeeper.sources.archive import Archive
from lorekeeper.sources.versions import current, read_together, write_together


@pytest.fixture(scope="module")
def archive(spark):
    return Archive(spark, "/root/testdata/sf0.001")


def test_a_second_run_adds_nothing(spark, archive, tmp_path):
    first = promotion(archive)
    write_together(first.relations(), str(tmp_path / "archive"))
    told = read_together(spark, str(tmp_path / "archive"))
    assert set(told) == set(first.relations()) and told["records"].count() == told["coding"].count() == told["source_items"].count() == told["mappings"].count() > 0
    for name, key in [("records", "record_id"), ("source_items", "source_item_id"), ("narrative_units", "narrative_id"), ("sources", "source_id"), ("locations", "location_id")]:
        assert told[name].count() == told[name].select(key).distinct().count()
    second = promotion(archive, told["mappings"])
    assert {name: df.count() for name, df in second.relations().items()} == dict.fromkeys(told, 0)
    assert {r.faults for r in first.key_faults().collect()} == {0}
    # Later candidates get the ids that follow.
    some = promotion(archive, told["mappings"].where("candidate_id % 2 = 0"))
    assert some.records.count() == told["mappings"].where("candidate_id % 2 = 1").count()


def test_places_are_filled_by_the_first_candidate_with_coordinates(spark, archive):
    places = {r.place_name: r for r in promotion(archive).locations.collect()}
    assert all(r.latitude == r.location_id for r in places.values() if not r.added and r.location_id % 2 == 0)
    filled = [r for r in places.values() if r.longitude is not None]
    assert filled and all(r.longitude == 140.0 for r in filled)


def test_a_version_is_seen_whole_or_not_at_all(spark, tmp_path):
    folder = str(tmp_path / "t")
    assert read_together(spark, folder) == {}
    one = {"a": spark.range(3), "b": spark.range(2)}
    write_together(one, folder)
    bad = {"a": spark.range(9), "b": spark.range(1).select(F.raise_error(F.lit("lost")).alias("id"))}
    with pytest.raises(Exception, match="lost"):
        write_together(bad, folder)
    assert {n: df.count() for n, df in read_together(spark, folder).items()} == {"a": 3, "b": 2}
    write_together({"a": spark.range(5), "b": spark.range(4)}, folder)
    assert {n: df.count() for n, df in read_together(spark, folder).items()} == {"a": 5, "b": 4} and "/v00000002-" in current(spark, folder)
