from collections import Counter

import pytest

from lithosense.llm import sharding

SIZE = 1009


def plain_fill(shards, size):
    """Turns written out: every shard's whole preference list, then one claim at a time."""
    orders = {}
    for s in shards:
        offset, step = sharding._draw(s, "offset", size), 1 + sharding._draw(s, "step", size - 1)
        orders[s] = [(offset + k * step) % size for k in range(size)]
    table = {}
    while len(table) < size:
        for i, s in enumerate(shards):
            if len(table) < size:
                table[next(x for x in orders[s] if x not in table)] = i
    return [table[k] for k in range(size)]


def test_equals_the_plain_procedure():
    shards = [f"n{i}" for i in range(7)]
    assert sharding.fill_table(shards, SIZE).tolist() == plain_fill(shards, SIZE)


def test_shares_are_even_and_follow_weights():
    shares = Counter(sharding.fill_table([f"n{i}" for i in range(10)], SIZE).tolist())
    assert max(shares.values()) - min(shares.values()) <= 1
    shares = Counter(sharding.fill_table(["a", "b"], SIZE, {"a": 3}).tolist())
    assert abs(shares[0] / SIZE - 0.75) < 0.01


def test_a_lost_shard_moves_little_else():
    shards = [f"n{i}" for i in range(20)]
    before, after = sharding.fill_table(shards, 65_537), sharding.fill_table(shards[:-1], 65_537)
    stayed = before != 19
    assert (before[stayed] != after[stayed]).mean() < 0.05


@pytest.mark.parametrize("bad", [([], SIZE), (["a", "a"], SIZE), (["a"], 1000), (["a"], 4_194_301)])
def test_rejects(bad):
    with pytest.raises(ValueError):
        sharding.fill_table(*bad)


def test_placement(spark, docs):
    import hashlib

    shards = [f"n{i}" for i in range(7)]
    df = docs([(1, "a"), (2, None), (None, ""), (1, "a"), (None, "b")]).withColumnRenamed("lang", "shard")
    out = sharding.assign(df, shards, size=SIZE).collect()
    owner = sharding.fill_table(shards, SIZE)
    assert len(out) == 5
    for r in out:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % SIZE
        assert (r["slot"], r["shard"]) == (slot, shards[owner[slot]])
    assert sharding.assign(docs([]), shards, size=SIZE).count() == 0


def test_written_shards_hold_every_row(spark, docs, tmp_path):
    df = docs([(i, "x") for i in range(200)])
    sharding.write_sharded(df, str(tmp_path / "out"), [f"n{i}" for i in range(5)], size=SIZE)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and back.select("shard").distinct().count() == 5
