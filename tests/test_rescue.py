"""JSON-line feeds: nothing that was delivered is lost, and a batch that is run again adds nothing."""

import json

from pyspark.sql import types as T

from vaultline.operators import quarantine as Q
from vaultline.sources.rescue import RescuedTable, rescue, rescued_stream

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType()), T.StructField("name", T.StringType())])


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def test_what_does_not_fit_is_kept(spark):
    given = ['{"id": "1", "day": "2026-07-01", "name": "a"}',
             '{"id": "x", "day": "2026-13-01", "name": "b"}',
             '{"id": 2, "Name": "c", "more": {"k": [1, 2]}, "void": null}',
             '{"id": null}', "no json", "  ", "[1]", '{"id": 3, "name": ""}']
    got = [(r.id, str(r.day), r.name, json.loads(r._rescued_data) if r._rescued_data else None) for r in rescue(lines(spark, *given), SCHEMA).collect()]
    assert got == [
        (1, "2026-07-01", "a", None),
        (None, "None", "b", {"day": "2026-13-01", "id": "x"}),
        (2, "None", None, {"Name": "c", "more": '{"k":[1,2]}'}),
        (None, "None", None, None),
        (None, "None", None, {"_corrupt_record": "no json"}),
        (None, "None", None, {"_corrupt_record": "[1]"}),
        (3, "None", "", None),
    ]


def test_new_columns_join_the_schema(spark, tmp_path):
    table = RescuedTable(spark, f"{tmp_path}/t", SCHEMA, evolve=True)
    assert table.apply(lines(spark, '{"id": 1, "name": "a"}'), 1)
    assert table.apply(lines(spark, '{"id": 2, "city": "x", "void": null}', '{"id": "?", "city": "y"}'), 2)
    assert not table.apply(lines(spark, '{"id": 9}'), 2)
    assert table.apply(lines(spark), 3)
    assert [f.name for f in table.schema(1).fields] == ["id", "day", "name"]
    rows = sorted(((r.id, r.city, r._rescued_data) for r in table.read().collect()), key=repr)
    assert rows == [(1, None, None), (2, "x", None), (None, "y", '{"id":"?"}')]


def test_a_failed_batch_keeps_its_schema(spark, tmp_path):
    table = RescuedTable(spark, f"{tmp_path}/t", SCHEMA, evolve=True)
    table.apply(lines(spark, '{"id": 1, "city": "x"}'), 1)
    table.rows._folder.delete("version=1")              # as after a crash between the schema and the rows
    table.apply(lines(spark, '{"id": 1, "city": "x"}'), 1)
    assert [(r.id, r.city) for r in table.read().collect()] == [(1, "x")]


def test_stream_then_quarantine(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"kyc_id": "K1", "verified_date": "soon"}\n{"kyc_id": "K2", "verified_date": "2026-01-01"}\n')
    (tmp_path / "in" / "2.json").write_text('{"kyc_id": "K3", "extra": "e"}\n')
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("kyc_id", "customer_ref", "id_type", "id_number", "verification_status")]
                          + [T.StructField("verified_date", T.DateType())])
    table = RescuedTable(spark, f"{tmp_path}/t", schema)
    for _ in range(2):                                  # the second run finds nothing new
        rescued_stream(spark, f"{tmp_path}/in", table, f"{tmp_path}/ckpt", max_files=1)
    records = Q.quarantine_records(Q.assess(table.read(), "customer_kyc", as_of="2026-12-01 00:00:00"), "customer_kyc", with_timestamp=False)
    found = {(r.source_business_key, r.rescued_data_json, r.quarantine_reason) for r in records.where("failed_rule_name = 'RESCUED_DATA_PRESENT'").collect()}
    assert found == {("K1", '{"verified_date":"soon"}', "RESCUED_DATA_PRESENT"), ("K3", '{"extra":"e"}', "RESCUED_DATA_PRESENT")}
