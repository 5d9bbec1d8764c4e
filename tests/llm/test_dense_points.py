"""Links of a grid point that fills more than one Arrow batch."""

from test_operators import components

from rowgate.llm import simhash
from rowgate.llm.common import connected_components


def test_links_where_the_first_batches_hold_one_point(spark):
    base = int("01" * 32, 2)
    values = [base ^ sum(3 << 2 * i for i in range(5) if n >> i & 1) for n in range(32)]  # 01 or 10: one embedding
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10")
    try:
        links = simhash.links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    finally:
        spark.conf.set(name, before)
    linked = {(r.a, r.b) for r in links} | {(r.b, r.a) for r in links}
    assert all(0 < (a ^ b).bit_count() <= 4 for a, b in linked)
    assert set(components({v: v for v in values}, lambda a, b: (a, b) in linked).values()) == {min(values)}


def test_components_compute_their_links_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    links = spark.createDataFrame([(1, 2), (3, 2), (4, 4), (5, 6)], "a long, b long").mapInArrow(count, "a long, b long")
    found = {r.id: r.component for r in connected_components(links).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5} and seen.value == 4
