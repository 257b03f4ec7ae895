"""Lake lines of any shape, scanned as VARIANT."""

import json

from pyspark.sql import functions as F

from headway.operators import documents
from headway.sources import files

LINES = {
    '{"route_id":"1","average_delay_seconds":2.5,"window_start":"a"}': ("windowed", "1", 2.5, {}),
    '{"route_id":7,"average_delay_seconds":null,"x":{"y":[1]}}': ("windowed", "7", None, {"x": {"y": [1]}}),
    '{"route_id":null,"delay_seconds":"12","timestamp":5}': ("raw", None, None, {}),
    '{"route_id":"1","delay_seconds":{"a":1}}': ("raw", "1", None, {}),
    '{"entity":[],"poll_ts":4,"more":null}': ("feed", None, None, {"more": None}),
    '{"zzz":1}': ("other", None, None, {"zzz": 1}),
    "[1]": ("other", None, None, None),
    "5": ("other", None, None, None),
    '{"route_id":': ("broken", None, None, None),
    "junk": ("broken", None, None, None),
}


def test_families_types_and_unknown_fields(spark, folder):
    spark.createDataFrame([(x,) for x in (*LINES, "")], "value string").coalesce(1).write.text(f"{folder}/in")
    rows = documents.typed_rows(files.read_documents(spark, f"{folder}/in"))
    others = F.to_json(F.transform_values("others", lambda _, v: F.to_json(v)))
    found = rows.select("family", "route_id", "average_delay_seconds", others.alias("others")).collect()
    got = [(r.family, r.route_id, r.average_delay_seconds, r.others and {k: json.loads(v) if v else v for k, v in json.loads(r.others).items()}) for r in found]
    assert sorted(got, key=repr) == sorted(LINES.values(), key=repr)
    assert [r.delay_seconds for r in rows.where("family = 'raw'").orderBy("timestamp").collect()] == [None, 12.0]


def test_only_what_is_used_is_taken_out(spark, folder):
    spark.createDataFrame([(x,) for x in LINES], "value string").write.text(f"{folder}/in")
    plan = documents.typed_rows(files.read_documents(spark, f"{folder}/in")).groupBy("route_id").count()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "window_end" not in text and "map_filter" not in text


def test_documents_as_a_stream(spark, folder):
    spark.createDataFrame([(x,) for x in LINES], "value string").write.text(f"{folder}/in")
    rows = documents.typed_rows(files.read_documents(spark, f"{folder}/in", stream=True)).select("family")
    out = rows.writeStream.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).format("parquet")
    out.start(f"{folder}/out").awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == len(LINES)
