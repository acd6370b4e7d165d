"""What the driver collects, and how shards fill, for groups of very different sizes."""

import numpy as np
import pandas as pd
import pytest

from tidelog.llm import sharding

GROUPS = 300_000


def sizes(kind):
    r = np.random.default_rng(3)
    total = r.integers(500, 1500, GROUPS)
    if kind == "one of 3 %":
        total[1234] = total.sum() * 3 // 97
    elif kind == "one of 20 %":
        total[777] = total.sum() // 4
    elif kind == "ten of 2 %":
        total[r.integers(0, GROUPS, 10)] = total.sum() // 40
    elif kind == "pareto":
        total = (r.pareto(1.2, GROUPS) * 1000).astype(np.int64) + 8
    return total


@pytest.mark.parametrize("kind", ["even", "one of 3 %", "one of 20 %", "ten of 2 %", "pareto"])
def test_collected_rows_are_bounded(spark, monkeypatch, kind):
    r = np.random.default_rng(1)
    keys = np.unique(r.integers(0, 1 << sharding.KEY_BITS, GROUPS))
    total = sizes(kind)[:len(keys)]
    groups = sharding.cut(spark.createDataFrame(pd.DataFrame({"key": keys, "total": total})).repartition(4), "groups")
    collect, seen = type(groups).collect, []

    def counted(self):
        rows = collect(self)
        seen.append(len(rows))
        return rows

    monkeypatch.setattr(type(groups), "collect", counted)
    cuts = sharding.boundaries(groups, 24)
    monkeypatch.undo()
    assert max(seen) <= 3 << sharding.CELLS and sum(seen) <= 50_000
    shard = np.searchsorted(np.array(cuts), keys, "right")
    filled = np.bincount(shard, total, 24)
    edges = np.concatenate(([0], np.cumsum(total)))

    def fits(capacity):
        at = 0
        for _ in range(24):
            at = edges[np.searchsorted(edges, at + capacity, "right") - 1]
        return at == edges[-1]

    assert fits(filled.max()) and not fits(filled.max() - 1)
    assert filled.min() > 0
    if kind == "even":
        assert filled.max() - filled.min() <= 2 * total.max()
