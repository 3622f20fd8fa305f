"""Payloads with many items, and many of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from headway.plans import landing
from headway.sources import payloads as pay


def test_looking_at_files_takes_a_bounded_number_of_tasks(spark, tmp_path):
    n = landing.LISTING_TASKS + 30
    for i in range(n):
        (tmp_path / f"{i}.json").write_text("{}")
    setting = spark.conf.get(landing._LISTING)
    context = spark.sparkContext
    context.setJobGroup("looks at files", "")
    try:
        found = landing.documents(spark, [f"{tmp_path}/{i}.json" for i in range(n)], "x int", False)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("looks at files")]
    stages = [tracker.getStageInfo(s) for j in jobs for s in j.stageIds]
    assert stages and max(s.numTasks for s in stages) <= landing.LISTING_TASKS
    assert spark.conf.get(landing._LISTING) == setting
    assert found.count() == n


def _plain_lookup(included, kind, wanted):
    found = [
        e["attributes"]
        for e in included or []
        if e is not None and (e["type"] or kind) == kind and wanted is not None and e["id"] == wanted
    ]
    return found[-1] if found else None


def _entity(id, type, name):
    attributes = None if name is None else {"name": name, "long_name": f"long {name}"}
    return {"id": id, "type": type, "attributes": attributes}


def test_entities_are_found_as_by_looking_at_each(spark):
    odd = [
        _entity("a", "stop", "first"), _entity("a", "stop", "last"), _entity("a", "route", "way"),
        _entity("b", None, "either"), None, _entity(None, "stop", "no id"),
        _entity("c", "stop", None), _entity("d", "other", "x"),
    ]
    ids = ["a", "b", "c", "d", "e", None]
    items = [
        {"id": f"{i}-{j}", "relationships": {"stop": {"data": {"id": i}}, "route": {"data": {"id": j}}}}
        for i in ids for j in ids
    ]
    documents = [
        {"execution_date": str(n), "data": data, "included": included}
        for n, (data, included) in enumerate([(items, odd), (items, []), (items, None), ([], odd), (None, odd)])
    ]
    schema = f"execution_date string, {pay.PREDICTION_PAYLOAD}"
    found = pay._linked(spark.createDataFrame(documents, schema)).select(
        "execution_date", "id", F.col("stop.name").alias("stop"), F.col("route.long_name").alias("route")
    )
    wanted = []
    for d in documents:
        for item in d["data"] or []:
            links = item["relationships"]
            stop = _plain_lookup(d["included"], "stop", links["stop"]["data"]["id"]) or {}
            route = _plain_lookup(d["included"], "route", links["route"]["data"]["id"]) or {}
            wanted.append((d["execution_date"], item["id"], stop.get("name"), route.get("long_name")))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)


def test_entities_are_sorted_out_once_per_payload(spark):
    """No filter over the included entities may lie inside the function of an item."""
    schema = f"execution_date string, {pay.SCHEDULE_PAYLOAD}"
    plan = pay.flatten_schedules(spark.createDataFrame([], schema))._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert 0 < text.rindex("filter(included") < text.index("transform(data")
