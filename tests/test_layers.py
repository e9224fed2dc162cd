"""Option layers (Kafka, JDBC SQL text) and skew behaviour of the profile plans."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourprofile import sinks
from hourprofile import sources as S
from hourprofile.operators import profile as P
from hourprofile.sources.kafka import kafka_reader_options
from hourprofile.spec import RESULT_SCHEMA

from test_operators import OBS, STATION, _obs, _stations


def test_kafka_options():
    o = kafka_reader_options("h:9092", "trafficdata", minPartitions=8)
    assert o == {"kafka.bootstrap.servers": "h:9092", "subscribe": "trafficdata",
                 "startingOffsets": "earliest", "minPartitions": "8"}
    w = sinks.kafka_writer_options("h:9092", "t")
    assert w == {"kafka.bootstrap.servers": "h:9092", "topic": "t"}


def test_jdbc_sql_text():
    ddl = sinks.create_table_sql("realtimetraffic", RESULT_SCHEMA, ["sid"])
    assert ddl.startswith('CREATE TABLE realtimetraffic ("sid" TEXT NOT NULL')
    assert 'PRIMARY KEY ("sid")' in ddl and '"current" INTEGER' in ddl
    merge = sinks.merge_sql("realtimetraffic", "stage", ["sid"], ["sid", "current"], ["current"])
    assert merge == ('MERGE INTO realtimetraffic t USING stage s ON t."sid" = s."sid" '
                     'WHEN MATCHED THEN UPDATE SET "current" = s."current" '
                     'WHEN NOT MATCHED THEN INSERT ("sid", "current") VALUES (s."sid", s."current")')


def test_read_csv_header_names(spark, tmp):
    df = spark.createDataFrame([("08", "001")], "fips_state_code string, station_id string")
    sinks.write_csv(df, tmp + "/c", header=True)
    back = S.read_csv(spark, tmp + "/c")
    assert back.columns == ["fips_state_code", "station_id"] and back.first()[0] == "08"


def test_hot_station_eager_equals_naive_and_pre_aggregates(spark):
    v = [str(x % 7) for x in range(24)]
    hot = [("08", "1", "N", *v)] * 3000           # a third of the rows on one id
    cold = [("08", str(i), "N", *v) for i in range(2, 6002)]
    obs = _obs(spark, hot + cold).repartition(8)
    st = _stations(spark, [("08", str(i), "N", f"l{i}", "40.5", "105.1", str(lane), "R", "Y")
                           for i in range(1, 6002) for lane in (1, 2)])
    naive = P.profile(obs, st, OBS, STATION, eager=False)
    eager = P.profile(obs, st, OBS, STATION, eager=True)
    assert naive.exceptAll(eager).count() == 0 and eager.exceptAll(naive).count() == 0
    plan = eager._jdf.queryExecution().executedPlan().toString()
    # the per-id average is partial before the shuffle: the hot id crosses it once per partition
    assert "partial_avg" in plan
