import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from hypothesis import given, settings, strategies as st

from tickerloom.llm import spelling

SCHEMA = "doc_id long, text string"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, min_chars=5, min_n=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_n}
    near = {w: [] for w in words}
    for a, b in combinations(words, 2):
        if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def found(frame, **options):
    rows = spelling.spelling_groups(frame, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted(map(tuple, rows))


def sample(seed=3, n=400):
    rng = random.Random(seed)
    base = ["letter", "better", "butter", "Señora", "señora", "façade", "aaaaaa", "aaaaa", "straße", "abcdefgh", "abcdefg", "zzzzz", "naïve", "anagram", "nagaram"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(30)):
            w = rng.choice(base[: 1 + rng.randrange(len(base))])
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("abeé") + w[at:], w[:at] + rng.choice("xyÿ") + w[at + 1:]])
            words.append(w if rng.random() < 0.8 else w.upper())
        rows.append((rng.randrange(200) if i % 50 else None, None if i % 40 == 7 else rng.choice([" ", "日", ", ", "Ā", "-1"]).join(words)))
    return rows + [(7, "q" * 5000)] * 2 + [(8, "q" * 5001)] * 4 + [(9, "q" * 5000)] * 2 + [(10, ""), (11, "letter " * 40_000)]


def test_brute_force(spark):
    rows = sample()
    expected = brute(rows)
    assert sum(r[1] is not None and r[1] != r[2] for r in expected) > 3 and any(r[4] == 0 for r in expected)
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected


def test_chains_are_followed_to_the_last(spark):
    chain = ["abcdefgh"[:5] + "x" * k for k in range(9)]
    rows = [(1, " ".join([w] * (4 * 3 ** k))) for k, w in enumerate(chain)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows) and got[0][2] != got[0][1]


def test_ties_empty_tables_and_clashing_columns(spark):
    rows = [(i, "hello hallo hullo hxllo") for i in range(3)] + [(i, "hallo hullo") for i in range(9)]
    frame = spark.createDataFrame([(*r, "w", 1, 2) for r in rows], f"{SCHEMA}, word string, n int, key int")
    got = found(frame)
    assert got == brute(rows) and {r[0]: r[1] for r in got}["hello"] == "hallo"
    assert found(frame.limit(0)) == [] and found(spark.createDataFrame([(1, None), (2, "a b")], SCHEMA)) == []


def test_counts_are_flushed_without_loss(spark, monkeypatch):
    rows = sample(5, 60)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([t or "" for _, t in rows]), pa.array(["" if d is None else str(d) for d, _ in rows])], names=["text", "doc_id"])
    monkeypatch.setattr(spelling, "HELD", 5)
    monkeypatch.setattr("tickerloom.llm.text.SLICE_BYTES", 100)
    total = Counter()
    for part in spelling._counter(1)(iter([batch])):
        for w, n in zip(*(c.to_pylist() for c in part.columns)):
            total[w] += n
    assert {(w, n) for w, n in total.items() if n >= 3 and len(w) >= 5} == {(r[0], r[3]) for r in brute(rows)}


WORDS = st.text(alphabet="abcéÿ", min_size=1, max_size=7)


@settings(max_examples=300, deadline=None)
@given(WORDS, st.integers(0, 6), st.sampled_from("abcéÿz"), st.sampled_from(["insert", "delete", "replace"]))
def test_every_edit_shares_a_signature(word, at, letter, kind):
    at %= len(word)
    other = {"insert": word[:at] + letter + word[at:], "delete": word[:at] + word[at + 1:], "replace": word[:at] + letter + word[at + 1:]}[kind]
    if not other or other == word:
        return
    short, long = sorted((word, other), key=len)
    same, shorter, longer = spelling.signatures([short, long])
    shared = set(same[0]) & set(same[1]) if len(short) == len(long) else set(shorter[0]) & set(longer[1])
    assert shared


@pytest.mark.parametrize("a, b", [("abcde", "edcba"), ("abcde", "abcdef"), ("aabbc", "abbcc")])
def test_signatures_depend_on_letters_alone(a, b):
    same, shorter, longer = spelling.signatures([a, b])
    if sorted(a) == sorted(b):
        assert (same[0] == same[1]).all() and (shorter[0] == shorter[1]).all() and (longer[0] == longer[1]).all()
    assert not set(shorter[0]) & set(same[0])
