"""Hand-made frames."""

from riskweft.sources.contract import FEATURES


def credit_frame(spark, rows):
    """rows: list of 23 values; row_id counts from 1."""
    schema = "row_id bigint, " + ", ".join(f"{c} double" for c in FEATURES)
    return spark.createDataFrame([(i + 1, *[None if v is None else float(v) for v in r]) for i, r in enumerate(rows)], schema)


ROW0 = [20000, 2, 2, 2, 30, 2, 1, 0, 0, 0, 0, 10000, 9000, 8000, 7000, 6000, 5000, 4000, 3000, 2000, 1000, 500, 250]
ROW1 = [0, 2, 6, 0, 45, -1, -1, -2, -2, -2, -2] + [0] * 12
FLAT = [1000, 1, 2, 1, 30] + [0] * 6 + [100] * 6 + [50] * 6


def scores(spark, labels, values):
    rows = [(i, int(y), float(s)) for i, (y, s) in enumerate(zip(labels, values))]
    return spark.createDataFrame(rows, "row_id bigint, label int, score double")
