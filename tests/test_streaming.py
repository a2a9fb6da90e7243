"""File-source incremental load with de-duplication."""

import json
import os

from tillsight.streaming.incremental import append_available, legal_unit_stream

SCHEMA = "siren string, dateDernierTraitementUniteLegale string, nombrePeriodesUniteLegale string"


def _land(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def test_stream_appends_new_files_once(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("landing", "table", "ck"))
    _land(src, "b1.json", [{"siren": "1", "dateDernierTraitementUniteLegale": "2024-01-05T10:00:00.000",
                            "nombrePeriodesUniteLegale": "2"}])
    key = ["siren", "dateDernierTraitementUniteLegale"]
    df = legal_unit_stream(spark, src, SCHEMA, extracted_at="2024-01-31 00:00:00")
    append_available(df, out, ck, dedupe_on=key).awaitTermination(120)
    assert spark.read.parquet(out).count() == 1
    # the boundary day is delivered again plus one new record
    _land(src, "b2.json", [{"siren": "1", "dateDernierTraitementUniteLegale": "2024-01-05T10:00:00.000",
                            "nombrePeriodesUniteLegale": "2"},
                           {"siren": "2", "dateDernierTraitementUniteLegale": "2024-01-06T10:00:00.000",
                            "nombrePeriodesUniteLegale": "x"}])
    df = legal_unit_stream(spark, src, SCHEMA, extracted_at="2024-01-31 00:00:00")
    append_available(df, out, ck, dedupe_on=key).awaitTermination(120)
    rows = sorted((r.siren, r.nombrePeriodesUniteLegale) for r in spark.read.parquet(out).collect())
    assert rows == [("1", 2.0), ("2", None)]
    # an update of any age is loaded, once
    old = {"siren": "3", "dateDernierTraitementUniteLegale": "2013-01-01T00:00:00", "nombrePeriodesUniteLegale": "1"}
    for name in ("b3.json", "b4.json"):
        _land(src, name, [old, old])
        df = legal_unit_stream(spark, src, SCHEMA, extracted_at="2024-01-31 00:00:00")
        append_available(df, out, ck, dedupe_on=key).awaitTermination(120)
    assert sorted(r.siren for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_stream_without_keys_appends_all(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, x) for x in ("landing", "table", "ck"))
    _land(src, "b1.json", [{"siren": "1"}, {"siren": "1"}])
    append_available(legal_unit_stream(spark, src, SCHEMA), out, ck).awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
