import zlib
from collections import Counter, defaultdict

import pytest

from weftline.llm import sharding


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, slot string")


def test_rows_are_placed_once_gapless_and_even(spark):
    rows = [(i, "x" * (i * 37 % 900) + "é", "a", None) for i in range(3000)] + [(None, None, None, None), (7, "", None, None)] * 2
    placed, versions = sharding.shard(docs_of(spark, rows), n_shards=8, n_slots=1024)
    got = placed.collect()
    assert len(got) == len(rows)
    slots, size = defaultdict(list), Counter()
    for r in got:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(size.values()) - min(size.values()) < 50
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.id, r.size, r.text_crc32) for r in got) == want
    assert versions.count() == 2048 and versions.where("version = 2").select("vslot").distinct().count() == 1024


def test_a_stored_map_is_loaded_and_edited(spark, tmp_path):
    path = f"file://{tmp_path}/map"
    assert sharding.load_map(spark, path) is None
    rows = [(i, "x" * (i * 37 % 900), "a", None) for i in range(800)]
    one, _ = sharding.shard(docs_of(spark, rows), n_shards=4, n_slots=64, path=path)
    version, shards = sharding.load_map(spark, path)
    assert version == 2 and sharding.load_map(spark, path, 1) == (1, sharding.dealt(64, 4))
    placed = {r.id: (r.vslot, r.shard) for r in one.collect()}
    assert all(shards[v] == s for v, s in placed.values())
    again, versions = sharding.shard(docs_of(spark, rows), n_shards=4, n_slots=64, path=path)
    assert {r.id: (r.vslot, r.shard) for r in again.collect()} == placed and versions.select("version").distinct().count() == 2
    assert sharding.edit_map(spark, path, {0: 3, 1: 3, 2: 3, 4: 3}) == 3
    moved, _ = sharding.shard(docs_of(spark, rows), n_shards=4, n_slots=64, path=path)
    assert sharding.load_map(spark, path)[0] == 4  # the edit was evened out again
    assert {r.id: r.vslot for r in moved.collect()} == {i: v for i, (v, _) in placed.items()}
    with pytest.raises(ValueError):
        sharding.shard(docs_of(spark, rows), n_shards=4, n_slots=32, path=path)


def test_placing_equals_plain_python(spark):
    rows = [(i % 90, "x" * (i * 37 % 900), "a", None) for i in range(400)]
    placed, versions = sharding.shard(docs_of(spark, rows), n_shards=4, n_slots=64)
    got = placed.collect()
    home = {r.vslot: r.shard for r in versions.where("version = 2").collect()}
    seen = Counter()
    for s in sorted(home):
        seen[home[s]] += 0
        own = sorted((r for r in got if r.vslot == s), key=lambda r: (r.id, r.text_crc32, r.size))
        assert sorted(r.slot for r in own) == list(range(seen[home[s]], seen[home[s]] + len(own)))
        assert [r.slot for r in own] == sorted(r.slot for r in own) and {r.shard for r in own} <= {home[s]}
        seen[home[s]] += len(own)
    assert seen.total() == len(rows)


def test_rebalance_moves_only_what_evens():
    load = [5] * 64
    assert sharding.rebalanced(sharding.dealt(64, 4), load, 4) == sharding.dealt(64, 4)
    now = sharding.rebalanced([0] * 64, load, 4)
    assert Counter(now) == {0: 16, 1: 16, 2: 16, 3: 16}


def test_growth_takes_rows_only_into_the_new_shard():
    old = sharding.dealt(4096, 16)
    new = sharding.grown(old, 16)
    assert all(b in (a, 16) for a, b in zip(old, new))
    assert max(Counter(new).values()) - min(Counter(new).values()) <= 16


def test_empty_table(spark):
    placed, _ = sharding.shard(docs_of(spark, []))
    assert placed.collect() == []
