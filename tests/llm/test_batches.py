import pyarrow as pa
from starmill.llm.batches import BATCH_BYTES, map_arrow


def test_wide_rows_come_in_batches_of_few_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    # 40 kB a row, as a set of five thousand shingles.
    wide = spark.range(0, 600, 1, 1).selectExpr("id", "sequence(id, id + 5000) AS shingles")
    found = map_arrow(wide, sizes, "n long, bytes long").collect()
    assert sum(r.n for r in found) == 600
    assert max(r.bytes for r in found) < 2 * BATCH_BYTES
