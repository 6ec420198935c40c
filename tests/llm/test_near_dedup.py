import random
import re

import pytest

from weftline.llm import near_dedup

SCHEMA = "doc_id long, text string, class string, component_id int"


def shingle_set(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()


def brute_force(rows):
    sets = [(i, shingle_set(t)) for i, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        low[find(k)] = min(low.get(find(k), i), i)
    return [(i, len(s), low[find(k)], low[find(k)] == i) for k, (i, s) in enumerate(sets)]


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: [rng.choice("abcdefghij") + rng.choice("klmnop") + rng.choice("qrstuv") for _ in range(n)]
    texts = []
    for size in (1, 2, 3, 8, 40, 120):
        base = prose(size)
        for k in range(14):
            w = list(base)
            for _ in range(rng.randint(0, 1 + size // 30)):
                w[rng.randrange(len(w))] = prose(1)[0]
            texts.append((" " if k % 2 else "\t\n").join(w).upper() if k % 5 == 0 else " ".join(w))
    texts += [" ".join(prose(rng.randint(3, 80))) for _ in range(40)] + ["", None, "  \n", "é É", "é é", texts[3], texts[3]]
    rng.shuffle(texts)
    return [(i * 2 + 5, t, "x", 3) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(brute_force(rows))


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d", None, None), (1, "a b c d", None, None), (2, "a b c d", None, None), (None, "x y z w", None, None)], SCHEMA)
    assert near_dedup.near_duplicates(docs.where("false")).collect() == []
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted((r.id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_pairs_around_the_threshold_are_all_decided_right(spark, monkeypatch):
    """Recall of links on families whose similarities lie on both sides of 0.85: all of them."""
    monkeypatch.setattr(near_dedup, "PART", 3)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    rows = []
    for f in range(40):
        base = [word() for _ in range(rng.randint(60, 200))]
        for _ in range(9):
            w = list(base)
            for _ in range(rng.randint(0, len(w) // 30)):
                w[rng.randrange(len(w))] = word()
            rows.append((len(rows), " ".join(w), "x", 3))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute_force(rows)
    assert sorted((r.id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted(want)
    assert 60 < sum(k for *_, k in want) < 300


def test_one_text_of_a_group_stays_under_a_repeated_or_missing_id(spark):
    a, b, c = "one two three four five six", "seven eight nine ten", "red green blue grey"
    rows = [(1, a), (2, a), (2, b), (2, b), (None, c), (None, c), (None, b), (3, None), (3, ""), (None, None)]
    got = near_dedup.near_duplicates(spark.createDataFrame([(i, t, "x", 0) for i, t in rows], SCHEMA))
    assert sorted((r.id or 0, r.component_id or 0, r.kept, r.stays) for r in got.collect()) == sorted([(1, 1, True, True), (2, 1, False, False), (2, 2, True, True), (2, 2, True, True), (0, 0, True, True), (0, 0, True, True), (0, 2, False, False), (3, 3, True, True), (3, 3, True, True), (0, 0, True, True)])


def test_join_of_a_heavy_key(spark):
    from weftline.llm.skew import join_heavy

    left = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(3000)], "key long, part long")
    right = spark.createDataFrame([(i, f"t{i}") for i in range(2000)], "key long, text string")
    got = sorted((r.key, r.part, r.text) for r in join_heavy(left, right, ["key"], parts=20).collect())
    assert got == sorted((r.key, r.part, r.text) for r in left.join(right, "key").collect())
