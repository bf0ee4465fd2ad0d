"""Benchmark items that lack an ``item_id``."""

from pyspark.sql import functions as F

from visitlens.llm import decontamination


def test_items_without_id_give_hits_but_no_item(spark):
    one = "seven quiet otters carried the wooden ladder across a frozen river"
    two = "nine patient bakers folded every linen cloth beside the old mill"
    bench = spark.createDataFrame([(None, one), (4, two), (None, two), (None, None)],
                                  "item_id long, text string")
    rows = [(1, f"x {one} y"), (2, f"{two} and {one}"), (3, "nothing of it"), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for block in (1_000_000, 3):
        found = decontamination.find_contamination(docs, bench, block_words=block).select(
            "doc_id", "items", decontamination.hit_words(F.col("ranges")).alias("n"))
        assert {r.doc_id: (r.n, r["items"]) for r in found.collect()} == {
            1: (11, []), 2: (22, [4]), 3: (0, []), None: (11, [])}
        left = decontamination.uncontaminated(docs, bench, block_words=block)
        assert [r.doc_id for r in left.collect()] == [3]
