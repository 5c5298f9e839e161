"""The column functions and filters are plain expressions, so a report built
from them runs unchanged on a streaming DataFrame."""

import uuid

from precinct.plans import reports as rp
from precinct.sources import testdata as td
from tests.conftest import SF0001


def test_daypart_report_on_a_file_stream(spark, tmp_path):
    orders = (
        spark.readStream.schema(td.BASE_SCHEMAS["orders"])
        .option("pathGlobFilter", "orders.parquet")
        .parquet(SF0001)
    )
    report = rp.daypart_counts(td.incidents_from_orders(orders), "1-URGENT")
    name = f"daypart_{uuid.uuid4().hex}"
    query = (
        report.writeStream.outputMode("complete").format("memory").queryName(name)
        .option("checkpointLocation", str(tmp_path / "ckpt")).start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = sorted(tuple(r) for r in spark.sql(f"SELECT * FROM {name}").collect())
    want = sorted(tuple(r) for r in rp.daypart_counts(td.incidents(spark, SF0001), "1-URGENT").collect())
    assert got == want and got
