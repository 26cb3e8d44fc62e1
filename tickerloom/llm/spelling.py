"""Spelling variants grouped under their most frequent form, by PartEnum signatures.

Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts with A-Z in lower case. Where
97 divides the crc32 of ``<doc_id>:<run>``, that run loses one letter. Words of at least ``min_chars``
code points and ``min_n`` occurrences stay; two are near if one inserted, deleted or replaced code
point makes them alike.

A word's letters with repetition are a binary vector: a dimension is a letter and its how-manieth
occurrence. One edit moves that vector by a Hamming distance of at most two: exactly one if a letter
comes or goes, two if one is replaced. The dimensions are partitioned into ``PARTS``; of the words of one
length, those that agree outside some two parts share a signature, and of words whose lengths differ by
one, those that agree outside some one part. All choices of parts are enumerated, so no near pair is
missed. Signatures are equi-joined, and every pair that shares one is verified by its edit distance
within the join; only near pairs leave it. A signature that many words share is one key of a plain sort-merge
join, whose hot partitions AQE divides and whose buffers spill.

A word's form is its near word of largest count, if that is at least ``ratio`` times its own, so counts
double at each step and a chain of forms has at most 63; roots are found by following forms two, four,
eight steps at a time.

Words are counted within tasks, flushed at ``HELD`` entries, so a word that is everywhere costs a
row per flush.

Defined cases: NULL and empty texts have no words; a NULL ``doc_id`` counts as '' in the crc32; every row
is counted, repeated ones too; a run that loses its only letter is no word; of equally frequent near words
the smallest in code-point order is the form; a word without near words has ``n_near`` 0, no form and is its own root; an
empty table gives no rows; other columns take no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import Staging, stage
from .text import map_arrow, mix, slices

DELETE_EVERY = 97
PARTS = 6
HELD = 1 << 18
# Fixed order of letters from common to rare, so that the parts are of a size.
COMMON = "etaoinshrdlcumwfgypbvkjxqz"


def _letters() -> bytes:
    """Of Latin-1 bytes, letters in lower case (A-Z only) and blanks for all others."""
    table = bytearray(b" " * 192 + bytes(range(192, 256)))
    table[97:123] = table[65:91] = bytes(range(97, 123))
    return bytes(table)


_LETTERS = _letters()


def _altered(total: Counter, words: list[bytes], doc_id: str) -> None:
    """Counts the words of a document, those that lose a letter in their shorter form."""
    total.update(words)
    start = zlib.crc32(f"{doc_id}:".encode())
    for word in set(words):
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % DELETE_EVERY == 0:
            n, at = words.count(word), h % len(word)
            total[word] -= n
            total[word[:at] + word[at + 1:]] += n


def _flushed(total: Counter, min_chars: int) -> pa.RecordBatch:
    kept = {w: n for w, n in total.items() if len(w) >= min_chars and n}
    return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in kept], pa.string()), pa.array(kept.values(), pa.int64())], names=["word", "n"])


def _counter(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches, "text"):
            for text, doc_id in zip(batch.column("text"), batch.column("doc_id").to_pylist()):
                # A code point beyond U+00FF becomes '?', which separates as it should.
                words = text.as_py().encode("latin-1", "replace").translate(_LETTERS).split()
                _altered(total, words, doc_id)
            if len(total) >= HELD:
                yield _flushed(total, min_chars)
                total = Counter()
        yield _flushed(total, min_chars)

    return run


def vocabulary(docs: DataFrame, min_chars: int = 5, min_n: int = 3) -> DataFrame:
    """``(word, n)`` over all documents."""
    plain = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"))
    counted = map_arrow(plain, _counter(min_chars), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_n)


def signatures(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: signatures shared with words of its length, as the shorter and as the longer one."""
    sizes = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(words)), sizes)
    order = np.lexsort((letters, row))
    letters, row = letters[order], row[order]
    new = np.append(True, (letters[1:] != letters[:-1]) | (row[1:] != row[:-1]))
    begin = np.flatnonzero(new)
    occurrence = np.arange(len(letters)) - np.repeat(begin, np.diff(np.append(begin, len(letters))))
    common = np.arange(256)
    common[[ord(c) for c in COMMON]] = range(len(COMMON))
    part = (common[letters] + 3 * occurrence) % PARTS
    hashed = mix((letters.astype(np.uint64) << np.uint64(32)) + occurrence.astype(np.uint64) + np.uint64(1))
    by_part = np.zeros((len(words), PARTS), np.uint64)
    np.add.at(by_part, (row, part), hashed)
    whole = by_part.sum(axis=1, dtype=np.uint64)

    def signed(left: np.ndarray, number: int, size: np.ndarray) -> np.ndarray:
        return mix(left + mix((size.astype(np.uint64) << np.uint64(8)) + np.uint64(number)))

    same = [signed(whole - by_part[:, i] - by_part[:, j], k, sizes) for k, (i, j) in enumerate(combinations(range(PARTS), 2))]
    shorter = [signed(whole - by_part[:, i], 128 + i, sizes) for i in range(PARTS)]
    longer = [signed(whole - by_part[:, i], 128 + i, sizes - 1) for i in range(PARTS)]
    return np.array(same).T, np.array(shorter).T, np.array(longer).T


def _signer(longer: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same, short, long = signatures(batch.column("word").to_pylist())
                keys = np.concatenate([same, long if longer else short], axis=1)
                ends = pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(keys).reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("word"), lists], names=["word", "keys"])

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, b)`` once for all words of which one edit of one code point makes the other."""
    def side(name: str, longer: bool) -> DataFrame:
        signed = map_arrow(words.select("word"), _signer(longer), "word string, keys array<long>")
        return signed.select(F.col("word").alias(name), F.explode("keys").alias("key"))

    once = (F.col("a") < F.col("b")) | (F.char_length("a") < F.char_length("b"))
    near = once & (F.levenshtein("a", "b", 1) == 1)
    joined = side("a", False).alias("x").join(side("b", True).alias("y"), (F.col("x.key") == F.col("y.key")) & near)
    return joined.select("a", "b").distinct()


def roots(forms: DataFrame, keep: Staging) -> DataFrame:
    """``(word, root)`` of the words that have a form: forms followed to the last."""
    found = keep(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        above = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = keep(found.join(above, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if further.filter("moved").isEmpty():
            return further.select("word", "root")
        found = further.select("word", "root")


def spelling_groups(docs: DataFrame, ratio: int = 2, min_chars: int = 5, min_n: int = 3) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word."""
    with Staging(docs.sparkSession) as keep:
        words = keep(vocabulary(docs, min_chars, min_n), "vocabulary")
        pairs = keep(near_pairs(words), "near")
        both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).union(pairs.select("b", "a"))
        counted = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
        best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
        enough = -F.col("best.less") >= ratio * F.col("n")
        formed = keep(words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.other")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n")), "formed")
        last = roots(formed.filter("form IS NOT NULL"), keep)
        grouped = formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return stage(grouped, "spelling")


ORACLE = """
WITH RECURSIVE powers AS (
    SELECT list(c ORDER BY i) AS crc_table FROM (
        SELECT i, list_reduce([i::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8],
                              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(i))),
runs AS (
    SELECT id, raw, count(*) AS n FROM (
        SELECT coalesce(doc_id::VARCHAR, '') AS id,
               unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) AS raw
        FROM documents)
    GROUP BY id, raw),
bytes AS (
    SELECT raw, n, xor(list_reduce(list_prepend(4294967295, list_transform(
               list_filter(string_split(regexp_replace(hex(encode(id || ':' || raw)), '(..)', '\\1 ', 'g'), ' '), lambda x: x <> ''),
               lambda x: (('0x' || x)::BIGINT))),
               lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM runs, powers),
altered AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(raw, 1, (h % length(raw))::INT) || substr(raw, (h % length(raw))::INT + 2) ELSE raw END AS word, n FROM bytes),
words AS (SELECT word, sum(n)::BIGINT AS n FROM altered WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word AS word, b.word AS other FROM cuts a JOIN cuts b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail AND a.word <> b.word
    UNION SELECT c.word, w.word FROM cuts c JOIN words w ON w.word = c.head || c.tail
    UNION SELECT w.word, c.word FROM cuts c JOIN words w ON w.word = c.head || c.tail),
best AS (
    SELECT p.word, count(*) AS n_near, first(w.word ORDER BY w.n DESC, w.word) AS other, max(w.n) AS other_n
    FROM near p JOIN words w ON w.word = p.other GROUP BY p.word),
formed AS (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
           CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
    FROM words w LEFT JOIN best b USING (word)),
chain AS (
    SELECT word, word AS place, 0 AS step FROM formed
    UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN formed f ON f.word = c.place WHERE f.form IS NOT NULL),
last AS (SELECT word, arg_max(place, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN last USING (word)
"""
