"""What the rounds of connected components leave with the driver."""

import random
import re

from ledgerloom.llm import components


def test_estimates_of_size_dont_grow_with_the_rounds(spark):
    """Each checkpoint kept the product of two earlier estimates, a number of twice the digits at every jump: the driver's heap filled up."""
    r = random.Random(2)
    ids = list(range(400))
    r.shuffle(ids)
    edges = list(zip(ids, ids[1:]))
    r.shuffle(edges)
    before = components.FEW
    try:
        components.FEW = 0
        out = components.components(spark.createDataFrame(edges, "a long, b long").repartition(4))
        assert {x.node: x.component for x in out.collect()} == dict.fromkeys(range(1, 400), 0)
    finally:
        components.FEW = before
    said = out._jdf.queryExecution().optimizedPlan().stats().toString()
    assert re.search(r"sizeInBytes=\d+\.\d [KMGTP]?i?B", said), said
