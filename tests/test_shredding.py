import hashlib
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from builders import payload_frame, payload_text
from plateflow.operators.enrichment import enrich
from plateflow.operators.validation import validate_events
from plateflow.plans.devices import device_platform_mix
from plateflow.sources.lake import land_events, read_events


def noise(number):
    return hashlib.sha512(str(number).encode()).hexdigest()


def texts(count):
    for number in range(count):
        extra = {"platform": ("ios", "android", 7, None)[number % 4], "note": noise(number)}
        if number % 5 == 0:
            del extra["platform"]
        if number % 500 == 0:
            extra["rare"] = [number]
        yield payload_text(event_id=f"e{number}", session_id=f"s{number % 9}", **extra)


@pytest.fixture(scope="module")
def lakes(spark, tmp_path_factory):
    """The same events in a lake with shredded extras and in one with plain ones."""
    rows = payload_frame(spark, list(texts(3000)))
    judged = validate_events(enrich(rows, F.to_timestamp(F.lit("2024-03-01 10:00:00"))))
    setting = "spark.sql.variant.writeShredding.enabled"
    assert spark.conf.get(setting) == "true"
    paths = {}
    for kind in ("shredded", "plain"):
        paths[kind] = str(tmp_path_factory.mktemp(kind))
        spark.conf.set(setting, str(kind == "shredded").lower())
        try:
            land_events(judged, paths[kind], one_hour=True)
        finally:
            spark.conf.set(setting, "true")
    return paths


def bytes_of(path, column):
    table = pq.ParquetDataset(path)
    total = 0
    for fragment in table.fragments:
        meta = pq.ParquetFile(fragment.path).metadata
        for group in range(meta.num_row_groups):
            chunks = (meta.row_group(group).column(k) for k in range(meta.num_columns))
            total += sum(c.total_compressed_size for c in chunks if c.path_in_schema.startswith(column))
    return total


def test_the_platform_has_chunks_of_its_own(lakes):
    own = bytes_of(lakes["shredded"], "extra.typed_value.platform")
    assert 0 < own < bytes_of(lakes["plain"], "extra") / 10


def test_the_platform_report_is_the_same(spark, lakes):
    found = [sorted(map(str, device_platform_mix(read_events(spark, path)).collect())) for path in lakes.values()]
    assert found[0] == found[1] and len(found[0]) == 4


def test_whole_extras_come_back(spark, lakes):
    found = {}
    for kind, path in lakes.items():
        rows = read_events(spark, path).select("event_id", F.to_json("extra").alias("extra")).collect()
        found[kind] = {r.event_id: json.loads(r.extra) for r in rows}
    assert found["shredded"] == found["plain"] and found["plain"]["e500"]["rare"] == [500]
    assert found["plain"]["e3"]["platform"] is None and "platform" not in found["plain"]["e5"]
