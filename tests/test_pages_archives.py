"""Landed pages and archives that are damaged, incomplete or large."""

import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from roadbook.operators import weather as W
from roadbook.operators.joins import join_suffixed
from roadbook.plans import stages
from roadbook.sources import archives, observations

SF_SMALL = "/root/testdata/sf0.001"


def page(offset, count, limit, n, value=1.0):
    entry = {"date": "2020-01-02T00:00:00", "datatype": "TMAX", "station": "S", "attributes": ",,,", "value": value}
    return json.dumps({"metadata": {"resultset": {"offset": offset, "count": count, "limit": limit}}, "results": [entry] * n}, indent=1)


def land(folder, pages):
    for name, text in pages.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            f.write(text)


@pytest.fixture()
def landed(tmpdir_path):
    land(tmpdir_path, {
        "obs_2019_1.json": page(1, 5, 2, 2), "obs_2019_2.json": page(3, 5, 2, 2), "obs_2019_3.json": page(5, 5, 2, 1),       # whole
        "obs_2020_1.json": page(1, 6, 2, 2), "obs_2020_2.json": page(3, 6, 2, 2)[:-7], "obs_2020_3.json": page(5, 6, 2, 2),  # one torn
        "obs_2021_1.json": page(1, 6, 2, 2), "obs_2021_3.json": page(5, 6, 2, 2), "obs_2021_3b.json": page(5, 6, 2, 2),      # one lost, one twice
        "obs_2022_1.json": '{"status": "503", "message": "busy"}',                                                          # an error message
        "obs_2023_1.json": page(1, 4, 2, 1), "obs_2023_2.json": page(3, 4, 2, 2, value="x"), "obs_2023_3.json": "",           # short, types, empty
        "obs_2024_1.json": page(1, 0, 2, 0)})                                                                               # nothing to fetch
    return tmpdir_path


def test_page_report(spark, landed):
    pages = observations.observation_pages(spark, landed)
    got = {r.request: tuple(r)[1:] for r in observations.page_report(pages).collect()}
    assert got == {2019: (5, 5, 3, 0, 0, 0, 0, True), 2020: (6, 4, 2, 0, 1, 1, 0, False), 2021: (6, 4, 2, 0, 0, 1, 1, False),
                   2022: (None, 0, 0, 0, 1, 0, 0, False), 2023: (4, 1, 1, 1, 1, 2, 0, False), 2024: (0, 0, 1, 0, 0, 0, 0, True)}
    torn = {(r.request, r.page): (r.fault, r.raw) for r in observations.torn_pages(pages).collect()}
    assert {k: f for k, (f, _) in torn.items()} == {
        (2020, "obs_2020_2.json"): "not JSON", (2022, "obs_2022_1.json"): "no results", (2023, "obs_2023_2.json"): "not JSON"}
    assert torn[2020, "obs_2020_2.json"][1] == page(3, 6, 2, 2)[:-7]
    missing = sorted(tuple(r) for r in observations.missing_pages(pages).collect())
    assert missing == [(2020, 3, 2), (2021, 3, 2), (2023, 1, 2), (2023, 3, 2)]


def test_a_faulty_page_fails_the_read_or_is_skipped(spark, landed):
    with pytest.raises(Exception, match="observation page obs_20"):
        observations.read_observation_pages(spark, landed).count()
    assert observations.read_observation_pages(spark, landed, on_fault="skip").count() == 5 + 4 + 6 + 1
    whole = [os.path.join(landed, f"obs_2019_{k}.json") for k in (1, 2, 3)]
    assert observations.read_observation_pages(spark, whole).count() == 5


def test_request_pages_round_trip(spark, tmpdir_path):
    rows = [(f"20{y}-01-{d:02}", t, float(d)) for y in (20, 21) for d in range(1, 29) for t in ("TMIN", "TMAX")]
    long = spark.createDataFrame(rows, "date string, datatype string, value double").withColumn("date", F.to_date("date"))
    observations.request_pages(long, 25).write.partitionBy("request", "offset").text(tmpdir_path + "/p")
    pages = observations.observation_pages(spark, tmpdir_path + "/p", multi_line=False, request=F.col("request"))
    assert sorted(tuple(r) for r in observations.page_report(pages).collect()) == [(y, 56, 56, 3, 0, 0, 0, 0, True) for y in (2020, 2021)]
    back = observations.read_observation_pages(spark, tmpdir_path + "/p", multi_line=False)
    assert sorted((str(r.date), r.datatype, r.value) for r in back.collect()) == sorted(rows)


def zipped(members, method=zipfile.ZIP_DEFLATED):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", method) as z:
        for name, text in members.items():
            z.writestr(name, text)
    return data.getvalue()


def test_members_are_tasks_of_their_own(spark, tmpdir_path):
    """One archive with many members is read by many tasks, as evenly as they can be dealt."""
    big = "CRN,A\n" + "".join(f"{k},{'x' * (k % 50)}\n" for k in range(40_000))
    with open(f"{tmpdir_path}/all.zip", "wb") as f:
        f.write(zipped({**{f"CRASH_{2000 + k}.csv": f"CRN,A\n{k},b\n" for k in range(40)}, "CRASH_1999.csv": big, "readme.txt": "no"}))
    lines = archives.expand_archives(spark, tmpdir_path)
    dealt = [r["count"] for r in lines.select("member", F.spark_partition_id().alias("task")).distinct().groupBy("task").count().collect()]
    assert sum(dealt) == 41 and len(dealt) >= 8 and max(dealt) <= 2 * min(dealt) + 1
    rows, inventory, errors = archives.member_frames(lines)
    assert rows.count() == 40_040 and errors.count() == 0
    assert rows.filter("member = 'CRASH_1999.csv'").agg(F.sum(F.length(F.coalesce("A", F.lit(""))))).first()[0] == sum(k % 50 for k in range(40_000))


def test_an_archive_beyond_two_gigabytes(spark, tmpdir_path):
    """A hole of 2.2 GB before the archive: no row could hold the file, and only the members are read."""
    path = f"{tmpdir_path}/large.zip"
    with open(path, "wb") as f:
        f.truncate(2_200_000_000)
    with zipfile.ZipFile(path, "a") as z:
        z.writestr("CRASH_2020.csv", 'CRN,A\n1,"x\ny"\n')
        z.writestr("CRASH_2021.csv", "CRN\n2\n")
    rows, _, errors = archives.member_frames(archives.expand_archives(spark, tmpdir_path))
    assert sorted((r.member, r.CRN, r.A) for r in rows.collect()) == [("CRASH_2020.csv", "1", "x\ny"), ("CRASH_2021.csv", "2", None)]
    assert errors.count() == 0


def test_bad_members_are_listed_alone(spark, tmpdir_path):
    members = {"A_2020.csv": "CRN\n" + "1\n" * 5, "B_2020.csv": "CRN\nmarked\n", "C_2020.csv": "", "D_2020.csv": "CRN\n4"}
    raw = bytearray(zipped(members, zipfile.ZIP_STORED))
    raw[raw.index(b"marked")] ^= 1
    deflated = bytearray(zipped({"E_2020.csv": "CRN\n" + "".join(f"{k * k}\n" for k in range(3000)), "F_2020.csv": "CRN\n6\n"}))
    deflated[200] ^= 0xFF
    encrypted = bytearray(zipped({"G_2020.csv": "CRN\n7\n"}))
    encrypted[encrypted.index(b"PK\x01\x02") + 8] |= 1
    for name, data in (("a.zip", raw), ("e.zip", deflated), ("g.zip", encrypted), ("torn.zip", raw[:60])):
        with open(f"{tmpdir_path}/{name}", "wb") as f:
            f.write(data)
    rows, _, errors = archives.member_frames(archives.expand_archives(spark, tmpdir_path))
    assert sorted((r.member, r.CRN) for r in rows.collect()) == [("A_2020.csv", "1")] * 5 + [("D_2020.csv", "4"), ("F_2020.csv", "6")]
    said = {(os.path.basename(r.archive), r.member): r.error for r in errors.collect()}
    assert set(said) == {("a.zip", "B_2020.csv"), ("e.zip", "E_2020.csv"), ("g.zip", "G_2020.csv"), ("torn.zip", None)}
    assert "checksum" in said["a.zip", "B_2020.csv"] and "encrypted" in said["g.zip", "G_2020.csv"]


def test_no_archives(spark, tmpdir_path):
    rows, inventory, errors = archives.member_frames(archives.expand_archives(spark, tmpdir_path))
    assert rows.count() == inventory.count() == errors.count() == 0


def test_crashes_without_a_roadway_row_stay(spark):
    crash = spark.createDataFrame([("1", 2020), ("2", 2020), (None, 2021)], "CRN string, CRASH_YEAR int")
    roadway = spark.createDataFrame([("1", "I"), ("1", "II"), ("3", "III"), (None, "IV")], "CRN string, ROAD string")
    got = sorted((tuple(r) for r in join_suffixed(crash, roadway, "CRN", "left", "_roadway").collect()), key=str)
    assert got == sorted([("1", 2020, "I"), ("1", 2020, "II"), ("2", 2020, None), (None, 2021, None)], key=str)


def test_no_join_key_of_the_weather_side_is_left(spark):
    from roadbook.operators import dates as T
    dated, weather = T.reconstruct_dates(stages.crash_geographic(spark, SF_SMALL)), stages.weather_table(spark, SF_SMALL)
    out = W.join_weather(dated, weather)
    assert out.columns == dated.columns + [c for c in weather.columns if c != "date"] and out.count() == dated.count()
