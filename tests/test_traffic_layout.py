"""The library on the traffic-counter layout itself (38-column records, all
strings), from CSV files with headers, through profile, training and scoring."""

import pytest
from pyspark.sql import functions as F

from hourprofile import sinks
from hourprofile import sources as S
from hourprofile.operators import messages as MS
from hourprofile.operators import profile as P
from hourprofile.operators import score as SC
from hourprofile.plans import jobs as J
from hourprofile.spec import (RESULT_COLUMNS, TRAFFIC_OBS, TRAFFIC_RECORD, TRAFFIC_RESULT_FIELDS,
                              TRAFFIC_STATION)

STATION_COLS = ["fips_state_code", "station_id", "direction_of_travel_name", "station_location",
                "latitude", "longitude", "lane_of_travel", "functional_classification_name",
                "national_highway_system"]


def _record(day, state, station, direction, lane, base):
    vols = [str(base + h) for h in range(24)]
    rec = {"date": f"2015-04-{day:02d}", "day_of_data": f"{day:02d}", "day_of_week": str(day % 7 + 1),
           "direction_of_travel": "1" if direction == "North" else "5",
           "direction_of_travel_name": direction, "fips_state_code": state,
           "functional_classification": "3R", "functional_classification_name": "Rural: Minor Arterial",
           "lane_of_travel": str(lane), "month_of_data": "04", "record_type": "3", "restrictions": "",
           "station_id": station, "year_of_data": "15"}
    rec.update(dict(zip(TRAFFIC_OBS.volumes, vols)))
    return tuple(rec[c] for c in TRAFFIC_RECORD)


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("traffic"))
    recs = [_record(day, "08", "000101", "North", lane, 10 * day + lane)
            for day in (6, 7, 8) for lane in (1, 2)]
    recs += [_record(day, "56", "000202", "East", 1, 100 + day) for day in (6, 7, 8)]
    schema = ", ".join(f"`{c}` string" for c in TRAFFIC_RECORD)
    sinks.write_csv(spark.createDataFrame(recs, schema).repartition(2), d + "/data", header=True)
    st = [("08", "000101", "North", "Loc A", "40.5", "105.1", "1", "Rural: Minor Arterial", "Y"),
          ("08", "000101", "North", "Loc A", "40.5", "105.1", "2", "Rural: Minor Arterial", "Y"),
          ("56", "000202", "East", "Loc B", "0", "107.0", "1", "Urban: Collector", "N")]  # zero lat
    sinks.write_csv(spark.createDataFrame(st, ", ".join(f"{c} string" for c in STATION_COLS)),
                    d + "/data_station", header=True)
    return d


def test_profile_on_traffic_csv(spark, layout):
    obs = S.read_csv(spark, layout + "/data")           # header names, all strings
    st = S.read_csv(spark, layout + "/data_station")
    assert obs.columns == list(TRAFFIC_RECORD)
    prof = P.profile(obs, st, TRAFFIC_OBS, TRAFFIC_STATION, eager=True)
    rows = prof.orderBy("lanes").collect()
    assert [r["id"] for r in rows] == ["08_000101_North"] * 2   # zero-latitude station dropped
    # six records for the id (3 days x 2 lanes), hour 0 values 10*day + lane
    expect = sum(10 * d + l for d in (6, 7, 8) for l in (1, 2)) / 6
    assert rows[0]["avgvolume00"] == pytest.approx(expect)
    assert rows[0]["longitude"] == pytest.approx(-105.1)


def test_train_and_score_on_traffic_layout(spark, layout, tmp):
    obs = S.read_csv(spark, layout + "/data", TRAFFIC_OBS.schema())
    mapping, models = J.train_job(spark, obs, TRAFFIC_OBS, tmp + "/ml")
    counts = {r["field"]: r["n"] for r in mapping.groupBy("field").agg(F.count("*").alias("n")).collect()}
    assert counts["record_type"] == 1 and counts["day_of_data"] == 3 and counts["fips_state_code"] == 2
    k = mapping.count()
    assert models.count() == 24 and len(models.first()["coef"]) == k + 23
    prof = P.profile(obs, S.read_csv(spark, layout + "/data_station"), TRAFFIC_OBS, TRAFFIC_STATION)
    msgs = MS.encode(obs, key=None)                       # ingest-time key, as the producer used
    dec = MS.decode(msgs.select("key", F.col("value").cast("binary").alias("value")),
                    TRAFFIC_OBS.schema())
    assert dec.where("corrupt").count() == 0
    good, _ = MS.quarantine(dec)
    scored = SC.score(good, TRAFFIC_OBS, TRAFFIC_RESULT_FIELDS, mapping, models, prof, 5)
    assert scored.columns == list(RESULT_COLUMNS)
    out = scored.collect()
    assert len(out) == 6 * 2   # six records of the station, two profile lanes each
    assert {r["sid"] for r in out} == {"08_000101_North"}
    assert all(r["predicted"] > 0 and r["level"] in ("High", "Medium", "Low") for r in out)
    dated = SC.score(good, TRAFFIC_OBS, TRAFFIC_RESULT_FIELDS, mapping, models, prof, 5,
                     keep=("date",))
    folded = SC.upsert_fold(dated, "sid", ["date", "lanes"]).collect()
    assert len(folded) == 1 and folded[0]["lanes"] == 1


def test_streams_on_traffic_layout(spark, layout, tmp):
    from hourprofile import streaming as ST
    obs = S.read_csv(spark, layout + "/data", TRAFFIC_OBS.schema())
    prof = J.profile_job(obs, S.read_csv(spark, layout + "/data_station"), TRAFFIC_OBS,
                         TRAFFIC_STATION, out=tmp + "/traffic")
    mapping, models = J.train_job(spark, obs, TRAFFIC_OBS, tmp + "/ml")
    ST.publish(spark, layout + "/data", TRAFFIC_OBS, tmp + "/topic", tmp + "/ck1",
               max_files=1).awaitTermination()
    msgs = S.stream_json_messages(spark, tmp + "/topic", max_files=1)
    rows = ST.scored(msgs, TRAFFIC_OBS, TRAFFIC_RESULT_FIELDS, mapping, models, prof, hour=7)
    ST.upsert_stream(rows, tmp + "/rt", tmp + "/ck2").awaitTermination()
    table = ST.read_upserted(spark, tmp + "/rt").collect()
    assert len(table) == 1 and table[0]["sid"] == "08_000101_North" and table[0]["lanes"] == 1
    assert table[0]["level"] in ("High", "Medium", "Low")
