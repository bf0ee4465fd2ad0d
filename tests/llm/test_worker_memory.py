"""What a Python worker keeps of blocks that a stage has freed."""

from visitlens.llm.common import importable


def _freed():
    def run(batches):
        """MB taken by arrays of some MB with small ones between them, and MB left of it
        when the large ones are freed."""
        import numpy as np
        import pyarrow as pa

        def resident():
            with open("/proc/self/statm") as f:
                return int(f.read().split()[1]) * 4 // 1024

        list(batches)
        first = np.ones(30 << 20, np.uint8)
        del first
        begun, large, small = resident(), [], []
        for _ in range(10):
            large.append(np.ones(20 << 20, np.uint8))
            small.append(np.ones(1 << 20, np.uint8))
        most = resident() - begun
        large.clear()
        yield pa.RecordBatch.from_pydict({"most": pa.array([most], pa.int64()),
                                          "kept": pa.array([resident() - begun], pa.int64())})
    return run


def test_workers_give_back_what_a_stage_freed(spark):
    importable(spark)
    row = spark.range(1).mapInArrow(_freed(), "most long, kept long").first()
    assert row.most > 150
    assert row.kept < 60
