import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import md5

import pytest

from tickerloom.llm import mixing

SCHEMA = "doc_id long, text string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Water filling in fractions, one round after another."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        left = Fraction(3, 2) * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        level = left / (sum(weight[s] for s in names if s not in full) or 1)
        more = {s for s in names if s not in full and weight[s] * level > 2 * sizes[s]}
        if not more:
            return {s: Fraction(2 * sizes[s]) if s in full else weight[s] * level for s in names}
        full |= more


def brute(rows):
    docs = [(d, len(WORD.findall(t or "")), s) for d, t, s in rows]
    sizes = Counter()
    for _, size, s in docs:
        sizes[s] += size
    targets = brute_targets(sizes)
    out = []
    for s, target in targets.items():
        own = sorted([x for x in docs if x[2] == s], key=lambda x: (x[1], x[0] is not None, x[0] or 0))
        step = int(float(target) / sizes[s] * 2 ** 24) if sizes[s] else 0
        start = int(md5((s or "").encode()).hexdigest()[:6], 16)
        for rank, (d, size, _) in enumerate(own):
            place = rank // 2 if rank % 2 == 0 else len(own) - 1 - rank // 2
            copies = ((place + 1) * step + start) // 2 ** 24 - (place * step + start) // 2 ** 24
            out.append((d, size, sizes[s], float(target), copies * size))
    return sorted(out, key=repr)


def found(frame):
    rows = mixing.taken_words(frame).select("doc_id", "size", "source_size", "target", "taken").collect()
    return sorted(map(tuple, rows), key=repr)


def sample(seed=1, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "B", "é", "", None, "hot", "hot", "hot", "z1", "z2"])
        rows.append((i, rng.choice([" ", "\t\n", "\x0b", "\xa0 "]).join("w%d" % k for k in range(rng.randrange(60))) if i % 23 else None, source))
    rows += [(1000 + i, "same text here", "copies") for i in range(300)] + [(3005, " \n ", "blank"), (3006, None, "blank")]
    return rows + [(2000, "x" * 200_000, "a"), (2001, "y " * 50_000, "big"), (None, "no id", "a"), (None, "no id", "a")]


def test_brute_force(spark):
    rows = sample()
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows)
    assert found(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)) == got


def test_taken_words_come_near_their_targets(spark):
    rows = sample(4)
    largest, taken, target = Counter(), Counter(), {}
    source_of = {d: s for d, _, s in rows}
    for r in mixing.taken_words(spark.createDataFrame([r for r in rows if r[0] is not None], SCHEMA)).collect():
        s = source_of[r.doc_id]
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        largest[s], target[s] = max(largest[s], r.size), r.target
        taken[s] += r.taken
        assert r.target <= 2 * r.source_size
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in target)
    assert abs(sum(taken.values()) - sum(target.values())) <= 0.02 * sum(target.values()) + max(largest.values())


@pytest.mark.parametrize("sizes", [[1, 1, 1, 1], [1000, 1, 1, 1], [1, 1, 1, 1000], [5, 0, 0], [0, 0], [1, 2, 4, 8, 16, 32, 64, 128], [7]])
def test_targets_are_reshared_until_none_is_above(spark, sizes):
    rows = [(i, "w " * n, f"s{i}") for i, n in enumerate(sizes)]
    got = {r.doc_id: r.target for r in mixing.taken_words(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: float(t) for i, t in enumerate(brute_targets({f"s{i}": n for i, n in enumerate(sizes)}).values())}
    assert abs(sum(got.values()) - 1.5 * sum(sizes)) < 1e-6


def test_rows_of_the_mix_keep_their_columns(spark):
    rows = sample(9, 120)
    frame = spark.createDataFrame([(*r, i, "p", 1.5, "c") for i, r in enumerate(rows)], f"{SCHEMA}, size int, place string, target double, c0 string")
    mixed = mixing.mixed(frame)
    assert mixed.columns == frame.columns
    copies = Counter(r.size for r in mixed.collect())
    words = defaultdict(int)
    for i, (_, text, source) in enumerate(rows):
        words[source] += copies[i] * len(WORD.findall(text or ""))
    taken = defaultdict(int)
    for d, size, whole, target, n in brute(rows):
        taken[whole, target] += n
    assert sum(words.values()) == sum(taken.values()) and max(copies.values()) <= 2


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(empty) == [] and mixing.mixed(empty).count() == 0


def test_no_python_on_the_main_path(spark):
    text = spark.createDataFrame([(1, "a", "b")], SCHEMA).select(mixing.words_in("text"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
