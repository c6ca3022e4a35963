"""Table schemas and column aliases of the fleet model.  Keys and names are fixed values."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType


def _struct(**fields) -> StructType:
    return StructType([StructField(k, v, True) for k, v in fields.items()])


S, D, TS, I, L, F, B = StringType(), DateType(), TimestampType(), IntegerType(), LongType(), DoubleType(), BooleanType()

SILVER_RENTAL = _struct(bike_id=S, rent_dt=TS, return_dt=TS, use_distance_m=F, rent_station_id=S, return_station_id=S, rent_date_partition=S, source_file=S, ingested_at=TS)
SILVER_FAILURE = _struct(bike_no=S, reg_dttm=TS, failure_type=S, reg_date_partition=S)
SILVER_STATION = _struct(snapshot_date=D, station_id=S, station_name=S, district=S, region=S, latitude=F, longitude=F, hold_num=I)
SILVER_ACTION = _struct(bike_id=S, event_type=S, occurred_at=TS, station_id=S, ingested_at=TS)
BIKE_LOCATION = _struct(bike_id=S, last_station_id=S, last_event_at=TS, snapshot_date=D)
LAST_ACTION = _struct(bike_id=S, action_event_type=S, action_station_id=S, action_at=TS, snapshot_date=D)
STATION_INVENTORY = _struct(station_id=S, bike_cnt=I, hold_num=I, target_bike_cnt=I, snapshot_date=D)
BIKE_FEATURES = _struct(snapshot_date=D, bike_id=S, trips=I, dist_km=F, instant_ret=I, fail_150d=I, days_since_fail=I, days_since_last_rent=I, trend_ratio=F, dur_h=F, excluded=B, bike_class=S)
BIKE_RISK = _struct(snapshot_date=D, bike_id=S, risk_score=F, risk_grade=S, model_version=S)
BIKE_DECISION = _struct(snapshot_date=D, bike_id=S, action=S)
DQ_RESULT = _struct(check_name=S, constraint=S, status=S, violations=L, total=L)

#: Source headers by standard column.
RENTAL_ALIASES = {
    "bike_id": ("bike_id", "BIKE_ID", "자전거번호"),
    "rent_dt": ("rent_dt", "RENT_DT", "대여일시"),
    "rent_station_id": ("rent_station_id", "RENT_ID", "RENT_STATION_ID", "대여 대여소번호", "대여대여소번호"),
    "return_dt": ("return_dt", "RTN_DT", "반납일시"),
    "return_station_id": ("return_station_id", "RTN_ID", "RTN_STATION_ID", "반납대여소번호"),
    "use_distance_m": ("use_distance_m", "USE_DST", "이용거리", "이용거리(M)"),
}
FAILURE_ALIASES = {
    "bike_no": ("bike_no", "BIKE_NO", "bikeNum", "자전거번호"),
    "reg_dttm": ("reg_dttm", "REG_DTTM", "regDttm", "등록일시"),
    "failure_type": ("failure_type", "FAIL_TYPE", "value", "고장구분"),
}
PAGING_COLUMNS = ("START_INDEX", "END_INDEX", "RNUM")
EVENT_TYPES = ("COLLECT", "DEPLOY")
