"""The five feeds: where their records sit in a response, their record schema, how long raw rows stay.

The field names, paths and periods in this file are fixed values of the feeds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Feed:
    name: str
    record_path: tuple[str, ...]
    records_are_array: bool
    ddl: str
    retention_days: int = 1

    @property
    def schema(self) -> T.StructType:
        """Schema of one record."""
        return T._parse_datatype_string(self.ddl)

    @property
    def landing_schema(self) -> T.StructType:
        """Schema of a landing row: fixed header, the partition's city, then the record."""
        header = T.StructType().add("raw_id", "string").add("extracted_at", "timestamp").add("city", "string")
        return T.StructType(header.fields + self.schema.fields + [T.StructField("extracted_date", T.DateType())])


_NUM = "decimal(18,6)"
_MAIN = (
    f"main struct<temp:{_NUM},feels_like:{_NUM},temp_min:{_NUM},temp_max:{_NUM},"
    "pressure:int,humidity:int,sea_level:int,grnd_level:int>"
)
_WEATHER = "weather array<struct<id:int,main:string,description:string,icon:string>>"
_WIND = f"wind struct<speed:{_NUM},deg:int,gust:{_NUM}>, clouds struct<`all`:int>"

FEEDS = {
    feed.name: feed
    for feed in (
        Feed(
            "current_weather", (), False,
            "id int, name string, dt bigint, timezone int, visibility int, base string, cod int, "
            f"coord struct<lat:{_NUM},lon:{_NUM}>, {_WEATHER}, {_MAIN}, {_WIND}, "
            f"rain struct<`1h`:{_NUM}>, snow struct<`1h`:{_NUM}>, "
            "sys struct<country:string,sunrise:bigint,sunset:bigint>",
        ),
        Feed(
            "air_pollution", ("list",), True,
            "dt bigint, main struct<aqi:int>, "
            f"components struct<co:{_NUM},no:{_NUM},no2:{_NUM},o3:{_NUM},so2:{_NUM},"
            f"pm2_5:{_NUM},pm10:{_NUM},nh3:{_NUM}>",
        ),
        Feed(
            "weather_forecast", ("list",), True,
            f"dt bigint, dt_txt string, pop {_NUM}, visibility int, {_MAIN}, {_WEATHER}, {_WIND}, "
            f"rain struct<`3h`:{_NUM}>, snow struct<`3h`:{_NUM}>, sys struct<pod:string>",
        ),
        Feed(
            "traffic_flow", ("flowSegmentData",), False,
            f"frc string, confidence {_NUM}, roadClosure boolean, currentSpeed int, freeFlowSpeed int, "
            "currentTravelTime int, freeFlowTravelTime int",
        ),
        Feed(
            "traffic_incidents", ("incidents",), True,
            "type string, geometry string, properties struct<id:string,`to`:string,`from`:string,delay:int,"
            f"length:{_NUM},endTime:string,startTime:string,iconCategory:int,timeValidity:string,"
            "numberOfReports:int,magnitudeOfDelay:int,probabilityOfOccurrence:string>",
        ),
    )
}
