"""Ingest and reshape operators on literal landed payloads."""

import datetime as dt
import os
import time
import zipfile

import pytest
from pyspark.sql import functions as F

from tillsight.sources import archives, landed, legal_units, metrics, posts, profiles, sinks, web_traffic

PAGE = ("data struct<posts: array<struct<id: string, authorId: string, created_time: string, "
        "content_type: string, post_labels: array<struct<id: string, name: string>>, insights_reach: string, "
        "reactions_by_type: map<string, bigint>, attachments: struct<type: string, url: string>>>, "
        "remaining: int, next: string>")


def _pages(spark):
    p1 = [("1", "a", "2024-01-30T10:00:00", "photo", [("l1", "Promo"), ("l2", None), ("l3", "")], "12",
           {"like": 3}, ("img", "u1")),
          ("2", "a", "2024-01-31T10:00:00", "video", None, "n/a", None, None)]
    return spark.createDataFrame([((p1, 0, None),), (([], 0, None),)], PAGE)


def test_posts_pipeline(spark):
    out = posts.export_posts(_pages(spark), "facebook", reaction_keys=["like"])
    rows = {r.facebook_id: r for r in out.collect()}
    assert set(rows) == {"1", "2"}  # the empty page adds nothing
    r1, r2 = rows["1"], rows["2"]
    assert r1.profile_id == "a" and r1.network == "facebook"
    assert r1.facebook_post_labels_names == "Promo"  # null and empty names dropped
    assert r1.facebook_insights_reach == 12.0 and r2.facebook_insights_reach == 0.0
    assert r1.facebook_reaction_like == 3 and r2.facebook_reaction_like is None
    assert r1.facebook_attachment_type == "img" and r2.facebook_attachment_url == ""
    assert r2.facebook_post_labels == ""


def test_prefix_keeps_base_and_prefixed(spark):
    df = spark.createDataFrame([(1, 2, 3)], "profile_id int, tiktok_x int, y int")
    assert posts.prefix_columns(df, "tiktok").columns == ["profile_id", "tiktok_x", "tiktok_y"]


def test_replace_profile_window_idempotent(spark):
    existing = spark.createDataFrame([("p1", dt.datetime(2024, 1, 10), 1), ("p1", dt.datetime(2024, 1, 30), 2),
                                      ("p2", dt.datetime(2024, 1, 30), 3)],
                                     "facebook_profileId string, created_time timestamp, v int")
    new = spark.createDataFrame([("p1", dt.datetime(2024, 1, 30), 20)],
                                "facebook_profileId string, created_time timestamp, v int")
    once = posts.replace_profile_window(existing, new, network="facebook", as_of=dt.date(2024, 1, 31))
    twice = posts.replace_profile_window(once, new, network="facebook", as_of=dt.date(2024, 1, 31))
    assert sorted(r.v for r in once.collect()) == [1, 3, 20]
    assert sorted(r.v for r in twice.collect()) == [1, 3, 20]
    other = posts.replace_profile_window(existing, new, network="linkedin")
    assert other.count() == 4  # unsupported network: nothing deleted


def test_profiles_union_and_clean(spark):
    fb = spark.createDataFrame([(1, ["a", "b"], True), (2, None, None)], "id int, profile_labels array<string>, "
                                                                          "community_enabled boolean")
    ig = spark.createDataFrame([(3, ["c"], False, "x")], "id int, profile_labels array<string>, "
                                                          "community_enabled boolean, extra string")
    empty = spark.createDataFrame([], "id int")
    out = profiles.clean_profiles(profiles.union_profiles({"facebook": fb, "instagram": ig, "tiktok": empty}))
    rows = {r.id: r for r in out.collect()}
    assert rows[1].profile_labels == '["a","b"]' and rows[1].community_enabled == "True"
    assert rows[2].community_enabled is None and rows[3].community_enabled == "False"
    assert rows[3].extra == "x" and rows[1].extra is None
    assert [r.id for r in profiles.profile_ids(out, "instagram").collect()] == [3]


CUBE = "header array<struct<rows: array<string>>>, data array<array<array<double>>>"


def test_metric_cube_and_union(spark):
    fb = spark.createDataFrame([([(["2024-01-01", "2024-01-02"],), (["p1", "p2"],), (["fans", "reach"],)],
                                 [[[1.0, 2.0], [3.0, None]], [[5.0, 6.0], [7.0, 8.0]]]),
                                ([(["2024-01-01"],)], None)], CUBE)
    ig = spark.createDataFrame([([(["2024-01-01"],), (["p9"],), (["followers"],)], [[[9.0]]])], CUBE)
    a = metrics.unpack_metric_cube(fb, "facebook")
    b = metrics.unpack_metric_cube(ig, "instagram", ["followers"])
    rows = {(r.date, r.profile_id): r for r in metrics.union_metrics([a, b]).collect()}
    assert len(rows) == 5
    assert rows[("2024-01-01", "p2")].facebook_reach == 0.0  # null cell -> 0
    assert rows[("2024-01-02", "p1")].facebook_fans == 5.0
    assert rows[("2024-01-01", "p9")].instagram_followers == 9.0 and rows[("2024-01-01", "p9")].facebook_fans == 0


def test_replace_tail_is_unconditional(spark):
    old = spark.createDataFrame([("2024-01-01", 1), ("2024-01-25", 2), (None, 3)], "date string, v int")
    new = spark.createDataFrame([("2024-01-30", 9)], "date string, v int")
    out = metrics.replace_tail(old, new, days=10, as_of=dt.date(2024, 1, 31))
    assert sorted(r.v for r in out.collect()) == [1, 3, 9]


def test_legal_units_increment(spark):
    target = spark.createDataFrame([("1", "2024-01-05T10:11:12.000")], "siren string, dateDernierTraitementUniteLegale string")
    src = spark.createDataFrame([("1", "2024-01-05T23:00:00.000", "x", [("2020-01-01", "A")], 1.0),
                                 ("2", "2024-01-04T10:00:00.000", "3", None, 2.0),
                                 ("3", "2024-01-06T00:00:00.000", "4", None, float("nan"))],
                                "siren string, dateDernierTraitementUniteLegale string, nombrePeriodesUniteLegale string, "
                                "periodesUniteLegale array<struct<dateDebut:string,etat:string>>, surplus double")
    wm = legal_units.high_watermark(target).collect()[0].watermark
    assert wm == dt.date(2024, 1, 5)
    assert legal_units.high_watermark(target.limit(0)).collect()[0].watermark == dt.date(1970, 1, 1)
    out = legal_units.incremental_append(src, target, extracted_at="2024-01-31 00:00:00")
    rows = {r.siren: r for r in out.collect()}
    assert set(rows) == {"1", "3"}  # the boundary day is fetched again
    assert len(out.columns) == 20 and "surplus" not in out.columns
    assert rows["1"].nombrePeriodesUniteLegale is None and rows["3"].nombrePeriodesUniteLegale == 4.0
    assert rows["1"].periodesUniteLegale == '[{"dateDebut":"2020-01-01","etat":"A"}]'
    assert rows["3"].sigleUniteLegale is None and rows["1"].date_extraction == "2024-01-31 00:00:00"


def test_web_traffic_names_and_melt(spark):
    assert web_traffic.clean_name("date_my-parent.com") == "date_my_par_t_com"
    assert web_traffic.clean_name("Centre (été) & co+") == "C_tre__ete___co"
    d = dt.date
    a = spark.createDataFrame([(d(2024, 1, 1), 1.0), (d(2024, 1, 2), 2.0)], "date date, visits double")
    b = spark.createDataFrame([(d(2024, 1, 1), 5.0)], "date date, visits double")
    out = web_traffic.sessions_by_competitor({"a.fr": a, "b.fr": b}, "FR")
    rows = {(r.event_timestamp, r.competitors): r.sessions for r in out.collect()}
    assert rows == {(d(2024, 1, 1), "a_fr"): 1.0, (d(2024, 1, 1), "b_fr"): 5.0,
                    (d(2024, 1, 2), "a_fr"): 2.0, (d(2024, 1, 2), "b_fr"): None}
    assert set(out.columns) == {"event_timestamp", "country", "competitors", "sessions"}


def test_archives_listing_and_unzip(spark, tmp_dir):
    with zipfile.ZipFile(os.path.join(tmp_dir, "export_kw_1.zip"), "w") as z:
        z.writestr("a.csv", "id,name\n1,x\n2,y\n")
        z.writestr("b.csv", "id,name\n3,z\n")
    with zipfile.ZipFile(os.path.join(tmp_dir, "other.zip"), "w") as z:
        z.writestr("c.csv", "id,name\n9,q\n")
    old = os.path.join(tmp_dir, "old_kw.zip")
    with zipfile.ZipFile(old, "w") as z:
        z.writestr("d.csv", "id,name\n8,w\n")
    past = time.time() - 3 * 86400
    os.utime(old, (past, past))
    files = archives.list_drop_files(spark, tmp_dir, "kw", dt.date.today())
    assert [os.path.basename(r.path) for r in files.select("path").collect()] == ["export_kw_1.zip"]
    parsed = archives.parse_csv(archives.unzip_records(files), "id INT, name STRING")
    got = sorted((r.entry, r.id, r.name) for r in parsed.collect())
    assert got == [("a.csv", 1, "x"), ("a.csv", 2, "y"), ("b.csv", 3, "z")]


def test_sink_append_and_replace(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(3)
    sinks.write(df, path, "overwrite")
    sinks.write(df, path, "append")
    assert spark.read.parquet(path).count() == 6
    sinks.write(df.where(F.col("id") > 0), path, "overwrite")
    assert spark.read.parquet(path).count() == 2


def test_legal_units_dedupe_on(spark):
    target = spark.createDataFrame([("1", "2024-01-05T10:11:12.000")],
                                   "siren string, dateDernierTraitementUniteLegale string")
    src = spark.createDataFrame([("1", "2024-01-05T10:11:12.000"), ("1", "2024-01-05T10:11:12.000"),
                                 ("2", "2024-01-05T11:00:00.000"), ("2", "2024-01-05T11:00:00.000")],
                                "siren string, dateDernierTraitementUniteLegale string")
    out = legal_units.incremental_append(src, target, extracted_at="x",
                                         dedupe_on=["siren", "dateDernierTraitementUniteLegale"])
    assert [r.siren for r in out.collect()] == ["2"]


def test_reaction_keys_discovered(spark):
    out = posts.export_posts(_pages(spark), "facebook")  # keys found with one distinct-keys job
    assert "facebook_reaction_like" in out.columns


def test_archive_members_written_per_entry(spark, tmp_dir):
    src = os.path.join(tmp_dir, "drop")
    os.makedirs(src)
    with zipfile.ZipFile(os.path.join(src, "kw.zip"), "w") as z:
        z.writestr("a.csv", "id\n1\n")
        z.writestr("b.csv", "id\n2\n3\n")
    records = archives.unzip_records(archives.list_drop_files(spark, src, "kw", dt.date.today()))
    out = os.path.join(tmp_dir, "landed")
    sinks.write(archives.parse_csv(records, "id INT"), out, "overwrite", partition_by=["entry"])
    assert sorted(os.listdir(out))[:2] == ["_SUCCESS", "entry=a.csv"] or "entry=a.csv" in os.listdir(out)
    back = spark.read.parquet(out)
    assert sorted((r.entry, r.id) for r in back.collect()) == [("a.csv", 1), ("b.csv", 2), ("b.csv", 3)]


LU = "siren string, dateDernierTraitementUniteLegale string"


def test_legal_units_any_fraction(spark):
    target = spark.createDataFrame([("0", "2024-01-05T10:11:12")], LU)
    src = spark.createDataFrame([("1", "2024-01-05T10:00:00"), ("2", "2024-01-06T10:00:00.123456"),
                                 ("3", "2024-01-06T10:00:00.1"), ("4", "2024-01-04T23:59:59.999999"), ("5", None)], LU)
    out = legal_units.incremental_append(src, target, extracted_at="x")
    assert sorted(r.siren for r in out.collect()) == ["1", "2", "3"]


def test_legal_units_bad_text_fails(spark):
    good = spark.createDataFrame([("0", "2024-01-05T10:11:12")], LU)
    bad = spark.createDataFrame([("1", "2024-99-99 never")], LU)
    with pytest.raises(Exception, match="not an ISO timestamp"):
        legal_units.incremental_append(bad, good, extracted_at="x").collect()
    with pytest.raises(Exception, match="not an ISO timestamp"):
        legal_units.high_watermark(bad).collect()


def test_legal_units_one_row_per_key_is_defined(spark):
    rows = [("1", "2024-01-06T00:00:00", "b"), ("1", "2024-01-06T00:00:00", "a")]
    for order in (rows, rows[::-1]):
        src = spark.createDataFrame(order, LU + ", sigleUniteLegale string")
        out = legal_units.incremental_append(src, src.limit(0), extracted_at="x",
                                             dedupe_on=["siren", legal_units.UPDATED_AT])
        assert [r.sigleUniteLegale for r in out.collect()] == ["a"]


def test_legal_units_bound_reaches_the_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lu")
    spark.createDataFrame([("1", "2024-01-05T10:00:00"), ("2", "2024-02-05T10:00:00")], LU).write.parquet(path)
    target = spark.createDataFrame([("0", "2024-02-01T00:00:00")], LU)
    out = legal_units.incremental_append(spark.read.parquet(path), target, extracted_at="x")
    assert [r.siren for r in out.collect()] == ["2"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    pushed = [x for x in plan.splitlines() if "PushedFilters" in x or "DataFilters" in x]
    assert any("dateDernierTraitementUniteLegale" in x and ">=" in x for x in pushed)


def test_align_series_keeps_repeated_dates(spark):
    d = dt.date(2024, 1, 1)
    a = spark.createDataFrame([(d, 5.0), (d, 1.0)], "date date, visits double")
    b = spark.createDataFrame([(d, 7.0)], "date date, visits double")
    out = web_traffic.align_series({"a.fr": a, "b.fr": b})
    assert sorted((r["a.fr"], r["b.fr"]) for r in out.collect()) == [(1.0, 7.0), (5.0, None)]


def test_clean_name_cases():
    assert web_traffic.clean_name("a..b/c & d&e") == "a_b_c__d" + "e"
    assert web_traffic.clean_name("Fraîcheur+") == "Fraicheur"


def test_midnight_file_belongs_to_its_day(spark, tmp_dir):
    path = os.path.join(tmp_dir, "kw.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.csv", "id\n1\n")
    midnight = dt.datetime(2024, 3, 5, tzinfo=dt.timezone.utc).timestamp()
    os.utime(path, (midnight, midnight))
    assert archives.list_drop_files(spark, tmp_dir, "kw", "2024-03-05").count() == 1
    assert archives.list_drop_files(spark, tmp_dir, "kw", "2024-03-04").count() == 0


def test_csv_records_keep_quoted_breaks(spark, tmp_dir):
    for n in (1, 2):
        with zipfile.ZipFile(os.path.join(tmp_dir, f"kw{n}.zip"), "w") as z:
            z.writestr("a.csv", f'id,name\r\n{n},"two\nlines"\r\n{n + 10},"x\u2028y"\r\n{n + 20},\r\n')
            z.writestr("sub/", "")
    with zipfile.ZipFile(os.path.join(tmp_dir, "kw3.zip"), "w") as z:
        z.writestr("latin.csv", "id,name\n9,été\n".encode("latin-1"))
    files = archives.list_drop_files(spark, tmp_dir, "kw", dt.date.today())
    utf8 = files.where(~F.col("path").endswith("kw3.zip"))
    got = sorted((r.id, r.name) for r in archives.parse_csv(archives.unzip_records(utf8), "id INT, name STRING").collect())
    assert got == [(1, "two\nlines"), (2, "two\nlines"), (11, "x\u2028y"), (12, "x\u2028y"), (21, ""), (22, "")]
    latin = archives.unzip_records(files.where(F.col("path").endswith("kw3.zip")), encoding="latin-1")
    assert [r.name for r in archives.parse_csv(latin, "id INT, name STRING").collect()] == ["été"]


def _listed(records):
    return sorted((r.archive, r.entry, r.record_no, r.fields) for r in records.collect())


def test_members_are_read_by_tasks_of_their_own(spark, tmp_dir):
    with zipfile.ZipFile(os.path.join(tmp_dir, "kw large one.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("sub/", "")
        for k in range(50):
            body = "".join(f"{i};{k} x{i % 7}\n" for i in range(k * 40))
            z.writestr(f"sub/m{k:02d}.csv", 'id;name\n1;"two\nlines"\n\n' + body)
    files = archives.list_drop_files(spark, tmp_dir, "kw", dt.date.today())
    records = archives.unzip_members(files, sep=";")
    assert records.schema == archives.unzip_records(files).schema
    assert records.rdd.getNumPartitions() == 50
    got = _listed(records)
    assert got == _listed(archives.unzip_records(files, sep=";")) and len(got) == 50 * 2 + 40 * sum(range(50))
    assert [len(set(r.entry for r in part)) for part in records.rdd.glom().collect()] == [1] * 50
    few = archives.unzip_members(files, sep=";", task_bytes=1 << 16)
    assert 2 <= few.rdd.getNumPartitions() < 20 and _listed(few) == got
    assert archives.parse_csv(records, "id INT, name STRING").where("name = 'two\\nlines'").count() == 50


def test_member_source_edges(spark, tmp_dir):
    """Empty archives and members, members of one name, byte order marks, other encodings, chunks, no files, no zip."""
    with zipfile.ZipFile(os.path.join(tmp_dir, "kw_empty.zip"), "w"):
        pass
    files = archives.list_drop_files(spark, tmp_dir, "kw", dt.date.today())
    assert _listed(archives.unzip_members(files)) == []
    with zipfile.ZipFile(os.path.join(tmp_dir, "kw_a.zip"), "w") as z:
        z.writestr("none.csv", "")
        z.writestr("bom.csv", "\ufeffid,name\n1,x\n")
        z.writestr("long.csv", "".join(f"{i},{'y' * 900}\n" for i in range(2 * archives.CHUNK_RECORDS + 1)))
        z.writestr("same.csv", "1\n")
        with pytest.warns(UserWarning, match="Duplicate name"):
            z.writestr("same.csv", "2\n")
    files = archives.list_drop_files(spark, tmp_dir, "kw", dt.date.today())
    got = _listed(archives.unzip_members(files))
    assert got == _listed(archives.unzip_records(files))
    assert [r[3] for r in got if r[1] == "same.csv"] == [["1"], ["2"]] and [r[3] for r in got if r[1] == "bom.csv"][0] == ["id", "name"]
    assert _listed(archives.unzip_members(files.where("false"))) == []
    with zipfile.ZipFile(os.path.join(tmp_dir, "latin.zip"), "w") as z:
        z.writestr("l.csv", "été\n".encode("latin-1"))
    latin = archives.list_drop_files(spark, tmp_dir, "latin", dt.date.today())
    assert [r[3] for r in _listed(archives.unzip_members(latin, encoding="latin-1"))] == [["été"]]
    with open(os.path.join(tmp_dir, "broken.zip"), "w") as f:
        f.write("no archive")
    with pytest.raises(Exception, match="not a zip file"):
        archives.unzip_members(archives.list_drop_files(spark, tmp_dir, "broken", dt.date.today())).collect()


def test_unlisted_reaction_key_fails(spark):
    with pytest.raises(Exception, match="reaction_keys lacks like"):
        posts.export_posts(_pages(spark), "facebook", reaction_keys=["love"]).collect()


def test_legal_units_watermark_loses_no_text(spark, tmp_dir):
    """Offsets, spaces and other notations around the watermark give a row or an error."""
    target = spark.createDataFrame([("0", "2024-06-06T00:00:00")], LU)
    texts = {"1": "2024-06-05T23:30:00-05:00", "2": " 2024-06-07T10:00:00", "3": "2024-6-7", "4": "2024-06-06T00:30:00+14:00",
             "5": "2024-06-05T10:00:00Z", "6": "2024-06-06", "7": "2024-06-04T23:00:00-18:00", "8": "1999-01-01", "9": None}
    path = os.path.join(tmp_dir, "lu")
    spark.createDataFrame(sorted(texts.items()), LU).repartition(3).write.parquet(path)
    out = legal_units.incremental_append(spark.read.parquet(path), target, extracted_at="x")
    assert sorted(r.siren for r in out.collect()) == ["1", "2", "3", "6"]
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert f"GreaterThanOrEqual({legal_units.UPDATED_AT},2024-06-04)" in plan
    bad = spark.createDataFrame([("1", "07/06/2024 10:00")], LU)
    with pytest.raises(Exception, match="not an ISO timestamp"):
        legal_units.incremental_append(bad, target, extracted_at="x").collect()


def test_legal_units_without_a_key_are_compared_as_a_whole(spark, tmp_dir):
    from tillsight.streaming.incremental import append_available, legal_unit_stream
    schema = LU + ", sigleUniteLegale string"
    rows = [(None, "2024-01-06T00:00:00", "a"), (None, "2024-01-06T00:00:00", "b"), (None, "2024-01-06T00:00:00", "b"),
            ("1", "2024-01-06T00:00:00", "c"), ("1", None, "d")]
    src, key = spark.createDataFrame(rows, schema), ["siren", legal_units.UPDATED_AT]
    first = legal_units.incremental_append(src, src.limit(0), extracted_at="x", dedupe_on=key)
    assert sorted(r.sigleUniteLegale for r in first.collect()) == ["a", "b", "c"]  # a null date is never new
    again = legal_units.incremental_append(src, first, extracted_at="y", dedupe_on=key)
    assert again.count() == 0
    land, out, ck = (os.path.join(tmp_dir, x) for x in ("landing", "table", "ck"))
    for name in ("one", "two"):
        src.coalesce(1).write.mode("append").json(land)
        append_available(legal_unit_stream(spark, land, schema, extracted_at=name), out, ck, dedupe_on=key).awaitTermination(120)
    assert sorted(r.sigleUniteLegale for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d"]


def test_series_by_position(spark, tmp_dir):
    d = dt.date
    rows = {"a.fr": [(d(2024, 1, 3), 3.0), (d(2024, 1, 1), 1.0), (d(2024, 1, 1), 5.0)], "b.fr": [(d(2024, 2, 9), 7.0)], "c.fr": []}
    frames = {}
    for name, some in rows.items():
        path = os.path.join(tmp_dir, name)
        spark.createDataFrame(some, "date date, visits double").coalesce(1).write.parquet(path)
        frames[name] = web_traffic.with_file_position(spark.read.parquet(path))
    got = web_traffic.align_series(frames, by="position", order=["_file", "_row"])
    assert got.columns == ["date_a.fr", "a.fr", "date_b.fr", "b.fr", "date_c.fr", "c.fr"]
    want = [(d(2024, 1, 1), 1.0, None, None, None, None), (d(2024, 1, 1), 5.0, None, None, None, None),
            (d(2024, 1, 3), 3.0, d(2024, 2, 9), 7.0, None, None)]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="by must be"):
        web_traffic.align_series(frames, by="name")


def test_landed_payloads_keep_varying_fields(spark, tmp_dir):
    lines = ['{"id": 1, "data": {"posts": [{"id": "a", "n": 1}]}}', '{"id": 2, "extra": [1.5, null], "mixed": "x"}',
             '{"id": 3, "data": {"posts": [{"id": "b", "label": {"name": "q"}}], "next": null}, "mixed": {"k": [1]}}',
             "not json", "[1, 2]", "{}", '{"id": 99999999999, "odd name`": true}', None]
    df = spark.createDataFrame([(x,) for x in lines], "payload string")
    got = landed.landed_payloads(df)
    rows = sorted((r for r in got.collect()), key=lambda r: (r.id is None, r.id or 0, str(r[landed.BAD_RECORD])))
    assert [r.id for r in rows] == [1, 2, 3, 99999999999, None, None, None, None]
    assert rows[0].data.posts[0].n == 1 and rows[2].data.posts[0].label.name == "q" and rows[2].data.posts[0].n is None
    assert [float(x) if x is not None else None for x in rows[1].extra] == [1.5, None]
    assert rows[1].mixed == "x" and rows[2].mixed == '{"k":[1]}' and rows[3]["odd name`"] is True
    assert sorted(r[landed.BAD_RECORD] for r in rows if r[landed.BAD_RECORD]) == ["[1, 2]", "not json"]
    path = os.path.join(tmp_dir, "lines")
    df.where("payload is not null").coalesce(1).write.text(path)
    assert landed.landed_payloads(landed.read_payload_files(spark, path)).where("id = 3").count() == 1
    for none in (df.limit(0), df.where("payload = 'not json'")):
        assert landed.landed_payloads(none).columns == [landed.BAD_RECORD]


def _days(df):
    return sorted((str(r.date), r.who, r.n) for r in df.collect())


def test_replace_in_place_survives_a_failed_run(spark, tmp_dir, monkeypatch):
    table, day = os.path.join(tmp_dir, "t"), lambda df: metrics.as_date(df, "date")
    old = spark.createDataFrame([(f"2024-01-{k:02d}", w, k) for k in range(1, 21) for w in ("a", "b")] + [(None, "z", 0)],
                                "date string, who string, n int")
    new = spark.createDataFrame([("2024-01-12", "a", 100), ("2024-01-25", "c", 101), ("2024-01-02", "late", 102), (None, "y", 103)],
                                "date string, who string, n int")
    full = lambda e, n: metrics.replace_tail(e, n, days=10, as_of="2024-01-20")
    want = _days(full(old, new))
    run = dict(day=day, low=dt.date(2024, 1, 10), high=None)
    sinks.write_by_day(old, table, day)
    before = {n for n in os.listdir(table)}
    real = sinks._overwrite_days

    def broken(rows, target, day_col):  # some days are replaced, then the run dies
        real(rows.where("day = '2024-01-12' or day = '2024-01-02'"), target, day_col)
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "_overwrite_days", broken)
    with pytest.raises(RuntimeError, match="lost"):
        sinks.replace_in_place(table, new, full, stage=f"{tmp_dir}/run1", **run)
    monkeypatch.setattr(sinks, "_overwrite_days", real)
    untouched = {n: os.path.getmtime(os.path.join(table, n)) for n in before if n == "day=2024-01-05"}
    for _ in range(2):  # the repeated run, and once more
        sinks.replace_in_place(table, new, full, stage=f"{tmp_dir}/run1", **run)
        assert _days(spark.read.parquet(table)) == want
    assert {n: os.path.getmtime(os.path.join(table, n)) for n in untouched} == untouched
    assert "day=2024-01-15" not in os.listdir(table) and "day=2024-01-25" in os.listdir(table)


def test_replace_profile_window_in_place(spark, tmp_dir):
    table, day = os.path.join(tmp_dir, "t"), posts._created_date
    cols = "tiktok_id int, profile_id string, created_time string"
    old = spark.createDataFrame([(i, f"p{i % 3}", f"2024-01-{1 + i % 28:02d}T10:00:00") for i in range(80)] + [(99, "p0", None)], cols)
    new = spark.createDataFrame([(500, "p0", "2024-01-20T00:00:00"), (501, "p9", "2024-02-20T00:00:00")], cols)
    full = lambda e, n: posts.replace_profile_window(e, n, network="tiktok", start="2024-01-10", end="2024-01-22")
    sinks.write_by_day(old, table, day, "created_day")
    sinks.replace_in_place(table, new, full, day=day, low=dt.date(2024, 1, 10), high=dt.date(2024, 1, 22),
                           stage=f"{tmp_dir}/s", day_col="created_day")
    got = spark.read.parquet(table).drop("created_day")
    assert sorted(map(repr, got.select(*old.columns).collect())) == sorted(map(repr, full(old, new).select(*old.columns).collect()))
