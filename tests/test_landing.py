"""Payload files land once, damaged ones are set aside, and runs go on where they failed."""

from __future__ import annotations

import json

import pytest

from headway.plans import landing


def _prediction(item, stop="70"):
    return {
        "data": [
            {
                "id": item,
                "attributes": {"arrival_time": "2024-01-10T08:00:00-05:00", "direction_id": 1},
                "relationships": {
                    "stop": {"data": {"id": stop}},
                    "route": {"data": {"id": "Red"}},
                    "trip": {"data": {"id": "T1"}},
                },
            }
        ],
        "included": [{"id": stop, "type": "stop", "attributes": {"name": "Park", "latitude": 42.3, "longitude": -71.0}}],
    }


def _put(folder, name, document):
    folder.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=1)
    (folder / name).write_text(text)


def _land(spark, tmp_path, **options):
    folders = {name: str(tmp_path / "payloads" / name) for name in ("mbta_predictions", "noaa", "driving")}
    report = landing.land_payloads(
        spark, folders, str(tmp_path / "landing"), str(tmp_path / "progress"), "2024-01-11", **options
    )
    return {r.source: r for r in report.collect()}


def _landed(spark, tmp_path):
    rows = spark.read.option("recursiveFileLookup", "true").json(str(tmp_path / "landing" / "mbta_predictions"))
    return sorted((r.prediction_id, r.fetched_date, r.stop_name) for r in rows.collect())


def test_files_land_once_and_damaged_ones_are_set_aside(spark, tmp_path):
    folder = tmp_path / "payloads" / "mbta_predictions" / "2024-01-10"
    _put(folder, "a.json", _prediction("p1"))
    _put(folder, "b.json", json.dumps(_prediction("p2"))[:-9])
    _put(folder, "c.json", " \n")
    _put(folder, "e.json", "")
    _put(folder, "d.json", _prediction("p3", "71"))
    first = _land(spark, tmp_path)
    found = first["mbta_predictions"]
    assert (found.records, found.damaged, found.error) == (2, 2, None) and len(found.paths) == 1
    assert (first["noaa"].records, first["noaa"].error, first["noaa"].paths) == (0, None, [])
    wanted = [("p1", "2024-01-10", "Park"), ("p3", "2024-01-10", "Park")]
    assert _landed(spark, tmp_path) == wanted
    aside = landing.damaged_documents(spark, str(tmp_path / "progress"), "mbta_predictions").collect()
    assert sorted(r.path.rpartition("/")[2] for r in aside) == ["b.json", "c.json"]

    again = _land(spark, tmp_path)["mbta_predictions"]
    assert (again.records, again.damaged) == (0, 0) and _landed(spark, tmp_path) == wanted
    _put(tmp_path / "payloads" / "mbta_predictions" / "2024-01-11", "a.json", _prediction("p4"))
    assert _land(spark, tmp_path)["mbta_predictions"].records == 1
    assert _landed(spark, tmp_path) == [*wanted, ("p4", "2024-01-11", "Park")]


def test_failed_batch_is_done_again_and_others_go_on(spark, tmp_path, monkeypatch):
    folder = tmp_path / "payloads" / "mbta_predictions" / "2024-01-10"
    for i in range(6):
        _put(folder, f"{i}.json", _prediction(f"p{i}"))
    _put(tmp_path / "payloads" / "noaa" / "2024-01-10", "a.json", {"results": [{"datatype": "SNOW", "value": 1.5}]})
    monkeypatch.setattr(landing, "FILES_PER_BATCH", 2)
    whole = landing.documents

    def failing(spark, paths, schema, lines):
        if any(p.endswith("/3.json") for p in paths):
            raise OSError("store not reached")
        return whole(spark, paths, schema, lines)

    monkeypatch.setattr(landing, "documents", failing)
    first = _land(spark, tmp_path)
    assert "store not reached" in first["mbta_predictions"].error and first["noaa"].records == 1
    monkeypatch.setattr(landing, "documents", whole)
    second = _land(spark, tmp_path)["mbta_predictions"]
    assert first["mbta_predictions"].records + second.records == 6 and second.error is None
    assert [p for p, *_ in _landed(spark, tmp_path)] == [f"p{i}" for i in range(6)]


def test_lines_and_active_routes(spark, tmp_path):
    def direction(name):
        place = {"formatted_address": name, "latitude": 42.0, "longitude": -71.0}
        leg = {"distance": {"value": 5}, "duration": {"value": 60}, "duration_in_traffic": {"value": 70}}
        return {"route": {"name": name, "origin": place, "destination": place}, "result": [{"legs": [leg]}]}

    lines = [json.dumps(direction("A")), '{"route": ', json.dumps(direction("B")), ""]
    _put(tmp_path / "payloads" / "driving" / "day=2024-01-10", "x.json", "\n".join(lines))
    active = spark.createDataFrame([("A",)], "name string")
    jobs = landing.payload_jobs(active, driving_lines=True)
    found = _land(spark, tmp_path, jobs=jobs, sources=["driving", "unheard"])
    assert found.keys() == {"driving"}
    assert (found["driving"].records, found["driving"].damaged) == (1, 1)
    (row,) = spark.read.json(found["driving"].paths[0]).collect()
    assert (row.route_name, row.departure_time) == ("A", "2024-01-10T08:00:00")
