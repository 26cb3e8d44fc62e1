import hashlib
import os
import random

from tickerloom.llm import line_runs

LONG = "this line is long enough to be counted as a line"
BLANK = " \t\x0b\x0c\r\n"


def lower(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, min_docs=5, min_chars=40):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(lower(line)) >= min_chars:
                holders.setdefault(lower(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (doc is not None and len(holders.get(lower(x), ())) >= min_docs and doc != max(holders[lower(x)]))]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def digest(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, line_runs.line_digest(docs, **options).collect()), key=repr)


def test_cases(spark):
    rows = [(i, f"own {i}\n  {LONG.upper()}\t\nend") for i in range(1, 6)]
    rows += [(6, None), (7, ""), (None, LONG), (8, f"{LONG}\n{LONG}\n{LONG}"), (8, f"{LONG}\n{LONG}\n{LONG}"), (9, "\n\n"), (10, "é" * 40)]
    rows += [(20 + i, "é" * 40) for i in range(4)] + [(30 + i, "s" * 39) for i in range(6)] + [(40, (LONG + "\n") * 3000 + "x" * 200_000)]
    assert digest(spark, rows) == brute(rows)


def test_brute_force_with_hot_lines_and_any_batches(spark):
    rng = random.Random(5)
    pool = [f"{LONG} number {i}" for i in range(30)]
    rows = [(i, "\n".join(rng.choice(pool[: 1 + rng.randrange(30)]) for _ in range(rng.randrange(8)))) for i in range(300)]
    expected = brute(rows)
    for options in ({}, {"batches": 1}, {"batches": 7, "fanout": 2}):
        assert digest(spark, rows, **options) == expected


def test_runs_are_compacted_level_by_level(spark):
    runs = line_runs.LineRuns(spark, fanout=2)
    for i in range(5):
        docs = spark.createDataFrame([(i, LONG)], "doc_id long, text string")
        runs.add(line_runs.line_keys(docs))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    (row,) = runs.frequent(5).collect()
    assert row.top_doc == 4 and not runs.frequent(6).collect()
    keys = [spark.read.parquet(p).select("h1", "h2") for level in runs.levels for p in level]
    assert sum(k.count() for k in keys) == 1   # no run repeats a key of another
    paths = [p for level in runs.levels for p in level] + runs.increments
    runs.close()
    assert not any(os.path.exists(p.removeprefix("file:")) for p in paths) and runs.frequent(1) is None


def test_columns_pass_and_empty_table(spark):
    rows = [(i, LONG, "a", 48, 1, 2) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, n_chars long, h1 int, top_doc int")
    cleaned = line_runs.without_repeated_lines(docs)
    assert cleaned.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.n_chars, r.key) for r in cleaned.collect()) == [(i, "", 0, "a") for i in range(5)] + [(5, LONG, 48, "a")]
    assert line_runs.line_digest(docs.limit(0)).count() == 0
