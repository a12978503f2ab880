import datetime as dt
from decimal import Decimal

D = dt.date


def money(x) -> Decimal | None:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def frame(spark, schema: str, rows: list[tuple]):
    return spark.createDataFrame(rows, schema)
