"""Forms the registered queries rely on."""

from __future__ import annotations

import pytest

from marketflow.plans.adapters import plain_text, text
from pyspark.sql import functions as F


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_decimals_are_written_in_plain_digits(spark, ansi):
    values = ["0", "0.00000001", "-0.00000001", "0.000001", "-0.00000101", "6.55", "-1.5", "104999.91"]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        frame = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v string, i int").orderBy("i")
        got = [r[0] for r in frame.select(plain_text(F.col("v").cast("decimal(14,8)"), 8)).collect()]
        assert got == [f"{float(v):.8f}" for v in values]
        assert frame.select(text(F.lit(-1.25), 3)).first()[0] == "-1.250"
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
