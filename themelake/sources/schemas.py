"""Schemas of the landed responses, as DDL.

Attributes and assets are maps of text: their keys vary by product, and two of
them (``Value``, ``value``) differ only in case. Coordinates of a footprint come
as text, as they nest deeper in a multipolygon. Fields that are not listed are
left out; :func:`read_open_items` takes whatever arrives.
"""

CATALOGUE_ITEM = """
    Id string, Name string,
    ContentDate struct<Start:string,End:string>,
    IngestionDate string, OriginDate string,
    ContentType string, ContentLength bigint, sizeInBytes bigint,
    GeoFootprint struct<type:string,coordinates:string>,
    CloudCover double,
    Attributes array<map<string,string>>,
    Assets array<map<string,string>>,
    collection string
"""

MAP_ELEMENT = """
    type string, id bigint, lat double, lon double,
    center struct<lat:double,lon:double>,
    tags map<string,string>
"""

SERIES_ITEM = """
    Nombre string, CODPROV string, CODMUNI string,
    Data array<struct<Anyo:int,Valor:double>>
"""

WEATHER_RESPONSE = """
    start bigint, end bigint, interval bigint,
    tmax array<double>, tmin array<double>,
    precipitation_sum array<double>, weather_code array<double>
"""
