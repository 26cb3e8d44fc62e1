import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tickerloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(term):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in term)


def brute(rows, min_docs=10, top=10):
    docs = [(lang or "", source or "", [lower(t) for t in TERM.findall(text or "")]) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in seen.items() if n >= min_docs)
        total = Counter(t for d in own for t in d[2])

        def priced(counts):
            below = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // below for t in kept}

        counts = {s: Counter(t for d in own if d[1] == s for t in d[2]) for s in {d[1] for d in own}}
        prices, whole = {s: priced(c) for s, c in counts.items()}, priced(total)
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        for s, p in prices.items():
            pairs = [(o, sum(gap(p[t], q[t]) for t in kept)) for o, q in prices.items() if o != s]
            terms = [(t, gap(p[t], whole[t])) for t in kept if counts[s][t] and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(found, 1)]
    return sorted(out)


def found(frame, **options):
    return sorted(map(tuple, divergence.divergence(frame, **options).select("lang", "source", "part", "item", "value", "rank").collect()))


def sample(seed=1, n=300):
    rng = np.random.default_rng(seed)
    pool = ["Alpha", "beta", "é日本", "gamma", "x", "ÀÉ", "delta", "rare", "𝒳y", "zeta"]
    rows = []
    for i in range(n):
        source = [f"s{i % 4}", None, "", "é", "hot"][int(rng.integers(5))]
        words = rng.choice(pool, int(rng.integers(0, 12)), p=np.array([8, 6, 5, 4, 4, 3, 3, 1, 2, 2]) / 38)
        rows.append((i, [" ", "1", "_\n", "-"][i % 4].join(words) if i % 17 else None, ["en", "de", None][i % 3], source))
    rows += [(n, "ALPHA " * 30_000 + "Z" * 100_000, "en", "s1"), (n, "beta", "en", "s1"), (n, "beta", "en", "s1"), (None, "beta beta", "en", "s2")]
    rows += [(1000 + i, "", "xx", f"q{i % 3}") for i in range(20)] + [(2000, "alone alone", "yy", "only"), (2001, "alone", None, "gone")]
    return rows


def test_brute_force_in_blocks_of_any_size(spark, monkeypatch):
    rows = sample()
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(frame) == brute(rows) and found(frame, min_docs=2, top_terms=3) == brute(rows, 2, 3)
    monkeypatch.setattr(divergence, "BLOCK", 2)
    assert found(frame) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    rows = sample(2, 60)
    frame = spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], f"{SCHEMA}, n int, term string, block int, a string")
    assert found(frame) == brute(rows) and found(frame.limit(0)) == []


def test_counts_are_flushed_without_loss(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "HELD", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c d a", "a e", "", "b"]), pa.array(["l"] * 4), pa.array(["s", "t", "s", "s"])], names=["text", "lang", "source"])
    total, docs = Counter(), Counter()
    parts = list(divergence._count(iter([batch, batch.slice(0, 0), batch])))
    for part in parts:
        for lang, source, term, n, d in zip(*(c.to_pylist() for c in part.columns)):
            total[source, term] += n
            docs[source, term] += d
    assert total == {("s", "a"): 4, ("s", "b"): 4, ("s", "c"): 2, ("s", "d"): 2, ("t", "a"): 2, ("t", "e"): 2}
    assert docs["s", "a"] == 2 and docs["s", "b"] == 4 and len(parts) > 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), unique=True, max_size=200), st.lists(st.integers(0, 4000), unique=True, max_size=400), st.integers(1, 70))
def test_gallop_is_a_binary_search(short, long, stride):
    short, long = np.array(sorted(short), np.int64), np.array(sorted(long), np.int64)
    usual, divergence.STRIDE = divergence.STRIDE, stride
    try:
        assert divergence.gallop(short, long).tolist() == np.searchsorted(long, short).tolist()
    finally:
        divergence.STRIDE = usual


@pytest.mark.parametrize("total, terms", [(0, 1), (10**15, 10**7), (7, 3), (10**12, 1)])
def test_prices_are_exact(total, terms):
    counts = [c for c in (0, 1, 6, total // 3, total) if c <= total]
    expected = [1 + 10**9 * (c + 2) // (total + 2 * terms) for c in counts]
    assert divergence.prices(np.array(counts, np.int64), total, terms).tolist() == expected
