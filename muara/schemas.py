"""Declared schemas of the warehouse entities and the catalog-to-Spark type mapping."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, WALL_CLOCK, BOOLEAN = T.DateType(), T.TimestampNTZType(), T.BooleanType()


def struct(required: tuple[str, ...] = (), **columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, kind, n not in required) for n, kind in columns.items()])


FORECAST_FACT = struct(
    required=("adm4", "waktu"),
    adm4=STRING,
    lokasi=STRING,
    desa=STRING,
    kecamatan=STRING,
    kabupaten=STRING,
    provinsi=STRING,
    waktu=WALL_CLOCK,
    cuaca=STRING,
    suhu_celsius=DOUBLE,
    kelembapan=INT,
    arah_angin=STRING,
    kecepatan_angin=DOUBLE,
    created_at=WALL_CLOCK,
    last_updated=WALL_CLOCK,
    data_age_minutes=DOUBLE,
    freshness_status=STRING,
    waktu_date=DATE,
)


DAILY_SUMMARY = struct(
    adm4=STRING,
    summary_date=DATE,
    temp_min=T.DecimalType(5, 2),
    temp_max=T.DecimalType(5, 2),
    temp_avg=T.DecimalType(5, 2),
    humidity_avg=INT,
    wind_speed_avg=T.DecimalType(5, 2),
    total_precipitation=T.DecimalType(8, 3),
    weather_description=STRING,
)


SYNC_RESULT = struct(
    source=STRING, target=STRING, mode=STRING, status=STRING, row_count=LONG, message=STRING
)


def shaped(rows, schema: T.StructType):
    """Rows cast by name to a declared schema, as a mart is stored."""
    return rows.selectExpr(
        *[f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in schema.fields]
    )


def spark_type(
    data_type: str,
    length: int | None = None,
    precision: int | None = None,
    scale: int | None = None,
) -> T.DataType:
    """Spark type of a catalog type name; unknown and user-defined types become strings."""
    if data_type == "character varying" and length:
        return T.VarcharType(length)
    if data_type == "character" and length:
        return T.CharType(length)
    if data_type == "numeric":
        return T.DecimalType(38, 18) if precision is None else T.DecimalType(precision, scale or 0)
    if data_type.endswith("[]"):
        return T.ArrayType(spark_type(data_type[:-2]))
    simple = {
        "smallint": T.ShortType(),
        "integer": T.IntegerType(),
        "bigint": T.LongType(),
        "real": T.FloatType(),
        "double precision": T.DoubleType(),
        "boolean": T.BooleanType(),
        "date": T.DateType(),
        "timestamp without time zone": T.TimestampNTZType(),
        "timestamp with time zone": T.TimestampType(),
        "bytea": T.BinaryType(),
        "ARRAY": T.ArrayType(T.StringType()),
    }
    return simple.get(data_type, T.StringType())


def catalog_type(spark: T.DataType) -> tuple[str, int | None, int | None]:
    """Catalog name, precision and scale of a Spark type."""
    if isinstance(spark, T.DecimalType):
        return "numeric", spark.precision, spark.scale
    if isinstance(spark, T.ArrayType):
        return f"{catalog_type(spark.elementType)[0]}[]", None, None
    names = {
        "string": "character varying",
        "smallint": "smallint",
        "int": "integer",
        "bigint": "bigint",
        "float": "real",
        "double": "double precision",
        "boolean": "boolean",
        "date": "date",
        "timestamp_ntz": "timestamp without time zone",
        "timestamp": "timestamp with time zone",
        "binary": "bytea",
    }
    return names.get(spark.simpleString(), "USER-DEFINED"), None, None
