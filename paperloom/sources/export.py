"""Publication of selected works as an extraction other runs can discover."""

import json
import time

from pyspark.sql import DataFrame

from paperloom.operators.ranking import release_places
from paperloom.plans.explore import matching_works, select_works


def _write_text(spark, path: str, text: str):
    """Create one small file on whatever file system the path names."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.create(target, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def export_works(
    works: DataFrame, keyword: str, year: int, max_records: int, out_dir: str
) -> tuple[str, int]:
    """Write matching works as JSON lines, then the sidecar that marks completion.

    The data is a folder of part files named like a single extraction. Its job commit
    precedes the sidecar, so an interrupted export is never discovered.
    """
    spark = works.sparkSession
    selected = select_works(works, keyword, year, max_records)
    data = f"{out_dir.rstrip('/')}/{keyword}-{year}-{time.time_ns()}.jsonl"
    selected.write.json(data)
    release_places()
    count = spark.read.text(data).count()
    matches = matching_works(works, keyword, year).count()
    # The keys that the raw checks read.
    sidecar = {
        "actual_record_count": count,
        "is_complete_extraction": count >= matches,
        "requested_max_records": max_records,
        "source_match_count": matches,
    }
    _write_text(spark, data.removesuffix(".jsonl") + ".metadata.json", json.dumps(sidecar))
    return data, count
