"""What stays on the executors' disks while a query runs."""
import os
import random
import time

import pyarrow as pa

from pyspark.sql import functions as F

from tallystar.operators import Workspace, workspace
from tallystar.sources import read_split_csv
from tallystar.sources.csv_folder import RAW_SCHEMA, _put_together


def exchanged(spark):
    """Bytes of what has been exchanged and not been deleted."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    paths = [files.apply(i).getPath() for i in range(files.size())]
    return sum(os.path.getsize(path) for path in paths
               if "shuffle" in os.path.basename(path) and os.path.exists(path))


def test_what_a_held_table_took_to_make_goes(spark, tmp_path, monkeypatch):
    rows = spark.range(300_000).select(F.sha2(F.col("id").cast("string"), 256).alias("key"))
    with Workspace(spark, str(tmp_path / "held")) as work:
        # Holding collects at its end, too: what it exchanged may be gone before it is counted.
        with monkeypatch.context() as meanwhile:
            meanwhile.setattr(workspace, "release_exchanges", lambda spark: None)
            work.hold(rows.repartition(8, "key"), "rows")
            first = exchanged(spark)
        assert first > 10_000_000
        time.sleep(1)
        for _ in range(2):
            assert work.hold(rows.limit(9), "few").count() == 9
            time.sleep(1)
        assert exchanged(spark) < first - 10_000_000


def test_split_csv_moves_no_lines(spark, settings, tmp_path):
    rng = random.Random(3)
    with open(tmp_path / "p.csv", "w", newline="") as file:
        file.write(",".join(RAW_SCHEMA.names) + "\n")
        for i in range(3000):
            file.write(f'{i},"two\nlines",' + ",".join(
                f"{rng.getrandbits(64):x}" for _ in range(len(RAW_SCHEMA) - 2)) + "\n")
    size = os.path.getsize(tmp_path / "p.csv")
    settings("spark.sql.files.maxPartitionBytes", str(size // 8))
    settings("spark.sql.files.openCostInBytes", "0")
    spark._jvm.System.gc()
    time.sleep(1)
    before = exchanged(spark)
    rows = read_split_csv(spark, str(tmp_path)).collect()
    assert sorted(int(r.id) for r in rows) == [*range(3000)]
    assert {r.customer_first_name for r in rows} == {"two\nlines"}
    assert exchanged(spark) - before < size / 20


def test_lines_are_put_together_wherever_batches_and_blocks_end():
    rng = random.Random(5)
    for _ in range(200):
        lines = [rng.choice(['a', '"b', 'c"', '"d"', '', '"e""', '""']) for _ in range(12)]
        if sum(line.count('"') for line in lines) % 2:
            lines.append('"')
        cuts = sorted(rng.sample(range(1, len(lines)), 3))
        blocks = [sum(i >= cut for cut in cuts) for i in range(len(lines))]
        expected, open_, rows, begun, entered = [], False, [], {}, {}
        for block, line in zip(blocks, lines, strict=True):
            begun.setdefault(block, len(expected))
            entered.setdefault(block, open_)
            if open_:
                expected[-1] += "\n" + line
            else:
                expected.append(line)
            open_ ^= line.count('"') % 2 == 1
            rows.append({"file": "f", "block": block, "odd": entered[block],
                         "begun": begun[block], "value": line})
        batches = []
        while rows:
            count = rng.randint(1, 5)
            batches.append(pa.RecordBatch.from_pylist(rows[:count]))
            rows = rows[count:]
        found = {}
        for whole in (True, False):
            put = [row for batch in _put_together(iter(batches), whole)
                   for row in batch.to_pylist()]
            for row in sorted(put, key=lambda row: row["block"] or 0):
                found.setdefault(row["number"], []).append(row["record"])
        assert {n: "\n".join(parts) for n, parts in found.items()} == dict(
            enumerate(expected, 1))
