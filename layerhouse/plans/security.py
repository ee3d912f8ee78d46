"""Column encryption (AES-GCM: 12-byte IV, ciphertext, 16-byte tag) and vehicle telemetry.

Keys come from the caller, or from the Spark setting below; none is kept in code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from layerhouse.functions.parsing import fields_of, parse_json

KEY_SETTING = "spark.layerhouse.columnKey"
REDACTION = "spark.sql.redaction.string.regex"

# The alarm flags of a position report.
ALARMS = [
    "terminalLcdError", "earlyWarning", "terminalMainPowerUnderVoltage", "inOutRoute", "oilError",
    "overSpeed", "emergencyAlarm", "rolloverWarning", "illegalMove", "inOutArea",
    "gnssAntennaDisconnect", "laneDepartureError", "stopTimeout", "vssError", "ttsModuleError",
    "fatigueDriving", "gnssAntennaShortCircuit", "collisionRollover", "overspeedWarning",
    "cameraError", "illegalIgnition", "roadDrivingTimeout", "icModuleError",
    "banOnDrivingWarning", "stolen", "gnssModuleError", "cumulativeDrivingTimeout",
    "terminalMainPowerFailure", "driverFatigueMonitor",
]

REPORT = (
    "UPEXGMSGREALLOCATION struct<dateTime:string,altitude:int,vec1:int,vec2:int,vec3:int,"
    "msgId:int,lon:decimal(9,6),lat:decimal(9,6),direction:int,"
    f"alarm:struct<{','.join(f'{a}:int' for a in ALARMS)}>,"
    "state:struct<acc:int,loadRating:int,door:int,laneDepartureWarning:int,"
    "latLonEncryption:int,electricCircuit:int,location:int,lon:int,forwardCollisionWarning:int,"
    "operation:int,lat:int,oilPath:int>>,"
    "DATATYPE int, VEHICLENO string, VEHICLECOLOR int"
)


def column_key(spark: SparkSession) -> bytes:
    """The 256-bit key, as 64 hex digits in the session's settings."""
    text = spark.conf.get(KEY_SETTING, None)
    if not text:
        raise LookupError(f"set {KEY_SETTING} to a 64-digit hex key")
    return bytes.fromhex(text)


def _key(spark: SparkSession, key: bytes) -> Column:
    """The key as a literal, kept out of printed plans by Spark's redaction."""
    if len(key) != 32:
        raise ValueError("the key must have 32 bytes")
    before = spark.conf.get(REDACTION, None)
    if KEY_TEXT not in (before or ""):  # a pattern of the session's own is kept beside it
        spark.conf.set(REDACTION, f"{KEY_TEXT}|(?:{before})" if before else KEY_TEXT)
    return F.unhex(F.lit(key.hex()))


#: Text that looks like a key.
KEY_TEXT = "(?:(?:0[xX])?[0-9a-fA-F]{64})"


def encrypt(df: DataFrame, column: str, key: bytes, into: str | None = None) -> DataFrame:
    """Replace a text column by its hex-coded encrypted payload; the IV is random per row."""
    sealed = F.aes_encrypt(F.col(column).cast("binary"), _key(df.sparkSession, key), F.lit("GCM"))
    return df.withColumn(into or column, F.hex(sealed))


def decrypt(df: DataFrame, column: str, key: bytes, into: str | None = None) -> DataFrame:
    """Text of an encrypted column; null where the payload is damaged or the key is another."""
    opened = F.try_aes_decrypt(F.unhex(column), _key(df.sparkSession, key), F.lit("GCM"))
    return df.withColumn(into or column, opened.cast("string"))


def split_rejects(df: DataFrame, column: str, key: bytes) -> tuple[DataFrame, DataFrame]:
    """Rows that authenticate, decrypted, and the others as they came."""
    opened = F.try_aes_decrypt(F.unhex(column), _key(df.sparkSession, key), F.lit("GCM")).cast("string")
    rows = fields_of(df, F.struct(opened.alias("__text")), *df.columns)
    bad = F.col(column).isNotNull() & F.col("__text").isNull()
    good = rows.where(~bad).withColumn(column, F.col("__text")).drop("__text")
    return good, rows.where(bad).drop("__text")


def telemetry(df: DataFrame, column: str = "payload") -> DataFrame:
    """Flatten position reports: vehicle, time, place and the alarms that are raised."""
    others = [c for c in df.columns if c != column]
    report = parse_json(df, column, REPORT, *others).withColumnRenamed("UPEXGMSGREALLOCATION", "m")
    raised = F.filter(
        F.array(*[F.when(F.col(f"m.alarm.{a}") == 1, F.lit(a)) for a in ALARMS]),
        lambda name: name.isNotNull(),
    )
    return report.select(
        *others, F.col("VEHICLENO").alias("vehicle_no"),
        F.try_to_timestamp("m.dateTime", F.lit("yyyyMMddHHmmss")).alias("report_time"),
        "m.lon", "m.lat", "m.altitude", "m.direction", F.col("m.state.acc").alias("acc"),
        F.col("m.state.door").alias("door"), raised.alias("alarms"),
        *[F.col(f"m.alarm.{a}").alias(f"alarm_{a}") for a in ALARMS],
    )
