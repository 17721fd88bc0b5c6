import os

from fulfilq.operators import cleanse
from fulfilq.schemas import LOAD_SEQ, RETURNS_DEFECTS
from fulfilq.sources import storage


def test_landing_columns_matched_by_header_name(spark, tmp_root):
    path = f"{tmp_root}/returns"
    os.makedirs(path)
    with open(f"{path}/part.csv", "w") as f:
        # reordered columns, one extra, 'root_cause_category' missing, a bad integer
        f.write("units_affected,record_id,extra,order_id,report_type,reported_at,refund_issued\n")
        f.write("2,RD-1,x,ORD-1,RETURN,2024-01-05T10:00:00,True\n")
        f.write("oops,RD-2,y,ORD-2,DEFECT,2024-01-06T11:30:00,False\n")
    raw = storage.read_landing(spark, path, RETURNS_DEFECTS, partitioned=False)
    assert raw.columns == [*RETURNS_DEFECTS.names, LOAD_SEQ]
    assert storage.unknown_columns(spark, path, RETURNS_DEFECTS) == ["extra"]
    rows = {r.record_id: r for r in cleanse.cast_columns(raw, RETURNS_DEFECTS).collect()}
    assert rows["RD-1"].units_affected == 2 and rows["RD-1"].refund_issued is True
    assert rows["RD-2"].units_affected is None and rows["RD-2"].root_cause_category is None
    assert str(rows["RD-2"].reported_at) == "2024-01-06 11:30:00"


def test_landing_roundtrip_with_date_folders(spark, tmp_root):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", None)], "record_id string, event_date string")
    storage.write_landing(df, f"{tmp_root}/land", partitioned=True)
    folders = sorted(d for d in os.listdir(f"{tmp_root}/land") if d.startswith("date="))
    assert folders == ["date=2024-01-01", "date=2024-01-02", "date=unknown"]
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("event_date", T.DateType())])
    got = storage.read_landing(spark, f"{tmp_root}/land", schema, partitioned=True, watermark="2024-01-02")
    assert sorted(r.record_id for r in got.collect()) == ["b", "c"]  # 'unknown' sorts after digits
