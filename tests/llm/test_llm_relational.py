"""Chat formatting and URL filters, and every query with SQL against DuckDB on whole tables."""

import datetime as dt
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickerloom.llm import chat, queries, url_lists
from conftest import TESTDATA

TURNS = "conv_id long, turn long, role string, text string"
DAY = dt.date(2024, 1, 1)


def plain(rows):
    """Order-free rows; dates of either engine alike."""
    return sorted(repr(tuple(str(v)[:10] if isinstance(v, (dt.date, dt.datetime)) else v for v in r)) for r in rows)


def same_as_duckdb(spark, name, views):
    got = queries.QUERIES[name](spark, TESTDATA) if views is None else views[1]
    columns = sorted(got.columns)
    db = duckdb.connect()
    for table, path in (views[0] if views else {t: f"{TESTDATA}/{t}.parquet" for t in ("documents", "pages", "conversations")}).items():
        if isinstance(path, str):
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
        else:
            db.register(table, path)
    expected = db.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert plain(map(tuple, got.select(*columns).collect())) == plain(expected) and expected


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_agree_with_their_sql(spark, name):
    same_as_duckdb(spark, name, None)


def test_chat_of_long_and_odd_conversations(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"turn {t} é😀") for t in range(200)]
    rows += [(2, 0, "system", "be kind"), (2, 1, "Ann Lee", "hello <|im_end|>"), (2, 2, "bob", None), (2, 2, "bob", "tie"), (2, 2, "ann", "tie")]
    rows += [(3, 0, "system", "alone"), (4, 1, None, "no name"), (4, 2, "", ""), (5, -70, "user", "early"), (5, 5, "user", "x" * 100_000)]
    rows += [(2, 1, "Ann Lee", "hello <|im_end|>")] * 3
    frame = spark.createDataFrame([(*r, "a", 1) for r in rows], f"{TURNS}, participant string, part int")
    same_as_duckdb(spark, "op7_chat_format", ({"conversations": frame.toPandas()}, chat.chat_digest(frame)))
    assert chat.perspectives(frame.limit(0)).count() == 0
    both = spark.createDataFrame([(None, None, "user", "a"), (None, 1, "user", "b")], TURNS)
    got = chat.perspectives(both).orderBy("char_start").collect()
    assert [(r.part, r.text.count("<|im_start|>"), r.char_start) for r in got] == [(0, 2, 0)]


def test_parts_are_cut_by_place_whatever_the_numbers(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(60, 70)]
    rows += [(2, 7, "ann", f"same number {n:03}") for n in range(200)] + [(2, 7, "bob", "one")]
    rows += [(3, None, "ann", f"no number {n:03}") for n in range(70)]
    frame = spark.createDataFrame(rows, TURNS)
    got = chat.perspectives(frame).collect()
    assert sorted((r.conv_id, r.participant, r.part, r.n_turns) for r in got) == [
        (1, "assistant", 0, 10), (1, "user", 0, 10), *[(2, p, n, m) for p in ("ann", "bob") for n, m in enumerate((64, 64, 64, 9))],
        (3, "ann", 0, 64), (3, "ann", 1, 6)]
    whole = {(r.conv_id, r.participant): r for r in chat.perspectives(frame, part_turns=1000).collect()}
    assert len(whole) == 5
    for key, one in whole.items():
        parts = sorted([r for r in got if (r.conv_id, r.participant) == key], key=lambda r: r.part)
        assert "".join(r.text for r in parts) == one.text and [s for r in parts for s in r.spans] == one.spans
        assert all(one.text[s.start:s.end].endswith("<|im_end|>") for s in one.spans)


def test_spans_cover_the_assistants_words(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "one é"), (1, 2, "bob", "two"), (1, 3, "ann", "three")]
    for r in chat.perspectives(spark.createDataFrame(rows, TURNS)).collect():
        said = [r.text[s.start:s.end] for s in r.spans]
        own = {"ann": ["one é", "three"], "bob": ["two"]}[r.participant]
        assert said == [f"{t}<|im_end|>" for t in own] and r.text.count("<|im_start|>assistant\n") == len(own)
        assert r.text.startswith("<|im_start|>system\ns<|im_end|>\n") and f"user name={r.participant}" not in r.text


def test_roles_that_look_alike_are_different_participants(spark):
    groups = [["李明", "王芳"], ["Анна", "Олег", "user"], ["user 1", "user_1", "user.1", "user_1-757365722031"], [None, "unknown"], ["Ann Lee", "bob"], [None, ""]]
    rows = [(None if c == 0 else c, t, who, f"{c}.{t}") for c, names in enumerate(groups) for t, who in enumerate(["system", *names, *names])]
    got = chat.perspectives(spark.createDataFrame(rows, TURNS)).collect()
    for c, names in enumerate(groups):
        own = [r for r in got if (r.conv_id or 0) == c]
        people = list(dict.fromkeys(n or "" for n in names))
        assert len(own) == len({r.participant for r in own}) == len(people)
        said = sorted(tuple(r.text[s.start:s.end] for s in r.spans) for r in own)
        assert said == sorted(tuple(f"{c}.{t}<|im_end|>" for t, w in enumerate(["system", *names, *names]) if t and (w or "") == n) for n in people)
        for r in own:
            users = re.findall("user name=(.*)", r.text)
            assert set(users) == {o.participant for o in own} - {r.participant} and all(re.fullmatch("[A-Za-z0-9_-]+", u) for u in users)
    assert {r.participant for r in got if r.conv_id == 4} == {"Ann_Lee", "bob"} and {r.participant for r in got if r.conv_id == 5} == {"unknown"}


def entry(name, pattern, day, added=True):
    return (name, pattern, None if day is None else DAY + dt.timedelta(day), added)


def test_list_entries_hold_for_their_time(spark):
    entries = [entry("a", "bad.org", 10), entry("a", "bad.org", 20, False), entry("a", "bad.org", 30), entry("b", "bad.org", 15),
               entry("a", "x.bad.org/p/q", 0), entry("a", "x.bad.org/p/q", 5, False), entry("a", "x.bad.org/p/q", 5), entry("c", None, 0),
               entry(None, "good.org", 0), entry("c", "good.org", None), entry("c", "off.org", 1, None), entry("a", "bad.org", 30)]
    urls = [("http://Bad.org/", 9), ("http://bad.org:80/?a#b", 10), ("https://u@x.bad.org/p/q/r?s", 16), ("http://x.bad.org/p", 25), ("http://bad.org", 20),
            ("http://notbad.org/", 15), ("http://bad.org", 30), ("mailto:x", 5), (None, 5), ("http://good.org/", 5), ("http://bad.org", None), ("http://off.org", 2),
            ("http://x.bad.org//p//q/", 3), ("http://bad.org", 30)]
    frame = spark.createDataFrame([(i, u, None if d is None else DAY + dt.timedelta(d), "h") for i, (u, d) in enumerate(urls)], "page_id long, url string, fetched date, host string")
    lists = spark.createDataFrame([(*e, 1) for e in entries], "list string, pattern string, day date, added boolean, page_id int")
    got = {r.page_id: (r.n_active, r.pattern, r.list, r.blocked) for r in url_lists.filter_captures(frame, lists).collect()}
    none = (0, None, None, False)
    assert got == {0: none, 1: (1, "bad.org", "a", True), 2: (3, "x.bad.org/p/q", "a", True), 3: (1, "bad.org", "b", True), 4: (1, "bad.org", "b", True), 5: none,
                   6: (2, "bad.org", "a", True), 7: none, 8: none, 9: none, 10: none, 11: none, 12: (1, "x.bad.org/p/q", "a", True), 13: (2, "bad.org", "a", True)}
    odd = [("Example.ORG", "http://example.org/x", True), ("example.org", "http://www.example.org./", True), ("example.org.", "http://EXAMPLE.org", True),
           ("example.org/a/", "http://example.org/a/b", True), ("example.org//A", "http://example.org/A", True), ("example.org/A", "http://example.org/a", False),
           ("[2001:DB8::1]", "http://[2001:db8::1]:80/", True), ("[::1]", "http://[::2]/", False), ("/x", "http://example.org/x", False), (".", "http://./", False)]
    for pattern, url, blocked in odd:
        one = spark.createDataFrame([(1, url, DAY)], "page_id long, url string, fetched date")
        (row,) = url_lists.filter_captures(one, spark.createDataFrame([("l", pattern, DAY, True)], "list string, pattern string, day date, added boolean")).collect()
        assert row.blocked is blocked, (pattern, url)
    assert not any(r.blocked for r in url_lists.filter_captures(frame, lists.limit(0)).collect())
    assert url_lists.filter_captures(frame.limit(0), lists).count() == 0


def test_pipeline_follows_its_stages(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    before = docs
    kept = {}
    for name, function in corpus_pipeline.STAGES[:-1]:
        before = function(spark, before, TESTDATA)
        assert before.columns == docs.columns
        before = spark.createDataFrame(before.toPandas(), docs.schema)
        kept[name] = {r.doc_id: r.text for r in before.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert kept["language_id"] == {d: t for d, t in texts.items() if re.search(r"[^\W\d_]", t or "")}
    assert kept["line_dedup"].keys() == kept["language_id"].keys() and kept["line_dedup"] != kept["language_id"]
    assert 0 < len(kept["decontamination"]) < len(kept["near_dedup"]) < len(kept["line_dedup"])
    packed = corpus_pipeline.run(spark, TESTDATA)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept["decontamination"].keys()
    lengths = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).filter("n <> all")
    assert lengths.isEmpty()


def test_pipeline_of_rows_without_ids_and_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").limit(120)
    rows = docs.collect()
    item = spark.read.parquet(f"{TESTDATA}/benchmark.parquet").first().text
    odd = [{**rows[i].asDict(), "doc_id": i if i % 2 else None} for i in range(10) for _ in range(2)]
    odd += [{**rows[0].asDict(), "doc_id": None, "text": f"something first. {item} and more after it"}]
    fresh = {"prices": "the unheard words of a nameless row about rivers, stones and weather in the long winter of that year"}
    odd += [{**rows[0].asDict(), "doc_id": None, "text": fresh["prices"]}] * 3
    for name, table in (("odd", spark.createDataFrame([r.asDict() for r in rows] + odd, docs.schema)), ("none", docs.limit(0))):
        folder = tmp_path / name
        table.write.parquet(str(folder / "documents.parquet"))
        spark.read.parquet(f"{TESTDATA}/benchmark.parquet").write.parquet(str(folder / "benchmark.parquet"))
        before = spark.read.parquet(str(folder / "documents.parquet"))
        for stage_name, function in corpus_pipeline.STAGES[:-1]:
            before = function(spark, before, str(folder))
            assert before.columns == docs.columns
        texts = [r.text for r in before.collect()]
        assert not any(item in (t or "") for t in texts) and texts.count(fresh["prices"]) == (name == "odd")
        assert len(set(texts)) == len(texts)
        assert (corpus_pipeline.run(spark, str(folder)).count() > 0) == (name == "odd")
