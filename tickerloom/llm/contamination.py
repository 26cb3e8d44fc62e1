"""Benchmark decontamination: a BM25 index of the test items, queried by every passage.

A document is read as overlapping passages; a passage is two longest items long and starts one longest
item after the one before, so any place an item can stand in lies whole in some passage. Passages are
the queries, test items the indexed texts. Scores are BM25 divided by the item's score with itself: 1
when a passage holds every word of the item. Every item that reaches ``least_score`` is retrieved, by
block-max WAND: item numbers are divided into blocks, and for every term and block the largest impact
is stored. Common terms together add at most what the block's items have in them, so a passage's upper
bound in a block is that constant plus the largest impacts of its rare words. Where the bound is too
small the block is passed over; in the other blocks cursors move to the first item whose upper bounds
can reach the score.

Retrieved items are verified in word order. A word of an item counts as found if it is in a run of
``WORDS`` item words that the passage has too; at an item's ends shorter runs count, down to one word,
if they stand within a word of their place beside the found run nearest to them. Three quarters of the
question's and half of the answer's words must be found. Items have no separate answer, so either an
item's last sentence or its last quarter may be the answer: a short last sentence is no condition of
its own, and an item of which seven eighths are found is found. Items shorter than a run use runs as
long as they are.

Items are indexed in shards of at most ``shard_items`` items and ``shard_words`` words, so what is
broadcast is bounded however large the benchmark is. Document frequencies, the mean length and the longest item
are those of all items, so results do not depend on how these are cut into shards. Each shard is matched against all documents in one narrow pass,
without a shuffle. Defined cases: NULL or empty texts and items match nothing; equal items match each;
repeated rows are reported, and dropped, each; rows without ``doc_id`` are reported with NULL and dropped
like others; other columns take no part; an empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .text import alphanumeric, flat, map_arrow, mix, slices, words

WORDS = 5
K1, B = 1.2, 0.75
BLOCK, MOST_BLOCKS = 4, 128  # items in a block at least; blocks at most
RARE = 0.04  # a term of at most this share of the items is rare
SCHEMA = "doc_id long, item_id long, word long, score double, question_overlap double, answer_overlap double"
_TABLE = alphanumeric()
_PLACES = mix(np.arange(91, 91 + WORDS, dtype=np.uint64)) | np.uint64(1)
_SENTENCES = re.compile(r"(?s)(.*(?:\.(?!\w)|:(?!\d)|[?!\n]))\s*(\S.*)$")


class Item(NamedTuple):
    item_id: int
    words: np.ndarray
    cuts: tuple[int, ...]  # how many of the words are the question, one number for each reading


class Corpus(NamedTuple):
    """What BM25 knows of all items, so that a score does not depend on the shard an item is in."""

    size: int              # items with words
    mean: float            # words of an item
    longest: int
    terms: np.ndarray      # sorted word hashes
    df: np.ndarray         # items that have each


class Index(NamedTuple):
    items: list[Item]
    terms: np.ndarray      # sorted word hashes
    begins: np.ndarray     # of each term's postings
    posted: np.ndarray     # item numbers, ascending within a term
    impacts: np.ndarray    # share of the item's score with itself
    block: int             # items in a block
    tops: np.ndarray       # block x term: the largest impact
    common: np.ndarray     # of each block: the most that common terms add
    rare: np.ndarray       # which terms are rare
    longest: int


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return words(*flat(pa.array(texts, pa.string())), _TABLE)


def parse_item(item_id: int, text: str | None) -> Item:
    text = (text or "").strip()
    parts = _SENTENCES.match(text)
    own, _ = _words([text.lower()])
    quarter = len(own) - -(-len(own) // 4)
    question = len(_words([parts[1].lower()])[0]) if parts else 0
    return Item(item_id, own, (question, quarter) if 0 < question < len(own) and question != quarter else (quarter,))


def corpus_of(items: list[Item]) -> Corpus:
    sizes = [len(i.words) for i in items if len(i.words)]
    terms, df = np.unique(np.concatenate([np.unique(i.words) for i in items] or [np.empty(0, np.uint64)]), return_counts=True)
    return Corpus(len(sizes), sum(sizes) / max(1, len(sizes)), max(sizes, default=0), terms, df)


def build_index(items: list[Item], corpus: Corpus | None = None) -> Index:
    items = [i for i in items if len(i.words)]
    corpus = corpus or corpus_of(items)
    lengths = np.array([len(i.words) for i in items], np.float64)
    all_words = np.concatenate([i.words for i in items]) if items else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(items)), lengths.astype(np.int64))
    terms, number = np.unique(all_words, return_inverse=True)
    pairs, tf = np.unique(number.astype(np.int64) * max(1, len(items)) + owner, return_counts=True)
    term, item = pairs // max(1, len(items)), pairs % max(1, len(items))
    df = corpus.df[np.searchsorted(corpus.terms, terms)]
    idf = np.log(1 + (corpus.size - df + 0.5) / (df + 0.5))
    damp = K1 * (1 - B + B * lengths / max(corpus.mean, 1))
    weight = idf[term] * tf * (K1 + 1) / (tf + damp[item])
    own = np.bincount(item, weights=weight, minlength=len(items))
    impacts = weight / own[item]
    block = max(BLOCK, -(-len(items) // MOST_BLOCKS))
    tops = np.zeros((-(-len(items) // block), len(terms) + 1))  # the last column: words of no item
    np.maximum.at(tops, (item // block, term), impacts)
    rare = np.append(df <= max(2, RARE * corpus.size), False)
    common = np.zeros(len(tops))
    shares = np.bincount(item, weights=np.where(rare[term], 0, impacts), minlength=len(items))
    np.maximum.at(common, np.arange(len(items)) // block, shares)
    begins = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))])
    return Index(items, terms, begins, item, impacts, block, tops, common, rare, corpus.longest)


def wand(index: Index, terms: np.ndarray, blocks: np.ndarray, least: float) -> list[tuple[int, float]]:
    """``(item number, score)`` of every item of ``blocks`` that scores ``least`` for the distinct ``terms``."""
    found = []
    for block in blocks:
        first, end = block * index.block, (block + 1) * index.block
        cursors = []  # [current item, top impact, position, end]
        for t in terms:
            low, high = index.begins[t], index.begins[t + 1]
            at = low + int(np.searchsorted(index.posted[low:high], first))
            stop = low + int(np.searchsorted(index.posted[low:high], end))
            if at < stop:
                cursors.append([int(index.posted[at]), float(index.tops[block, t]), at, stop])
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, None
            for k, cursor in enumerate(cursors):
                bound += cursor[1]
                if bound >= least:
                    pivot = k
                    break
            if pivot is None:
                break
            item = cursors[pivot][0]
            if cursors[0][0] == item:
                score = 0.0
                for cursor in cursors:
                    if cursor[0] != item:
                        break
                    score += float(index.impacts[cursor[2]])
                    cursor[2] += 1
                if score >= least:
                    found.append((item, score))
            else:
                for cursor in cursors[:pivot]:
                    cursor[2] += int(np.searchsorted(index.posted[cursor[2]:cursor[3]], item))
            cursors = [[int(index.posted[c[2]]), *c[1:]] for c in cursors if c[2] < c[3]]
    return found


def _runs(own: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(max(0, len(own) - n + 1), np.uint64)
    for k in range(n):
        total += own[k:k + len(total)] * _PLACES[k]
    return total


def _ending(own: np.ndarray, passage: np.ndarray, left: int, places: np.ndarray) -> int:
    """How many last words of an item, fewer than a run, the passage has within a word of their place.

    ``left`` words follow the item's last found run, which ends at ``places`` of the passage.
    """
    most = 0
    for place in places:
        for end in (place + left - 1, place + left, place + left + 1):
            k = 0
            while k < min(WORDS - 1, left) and place <= end - 1 - k < len(passage) and passage[end - 1 - k] == own[-1 - k]:
                k += 1
            most = max(most, k)
    return most


def overlap(item: Item, passage: np.ndarray, question: float = 0.75, answer: float = 0.5) -> tuple[float, float]:
    """The found shares of the item's question and answer, in the reading that comes nearest to what is asked."""
    own, n = item.words, min(WORDS, len(item.words))
    runs, there = _runs(own, n), _runs(passage, n)
    starts = np.flatnonzero(np.isin(runs, there))
    found = np.zeros(len(own), bool)
    for k in range(n):
        found[starts + k] = True
    if len(starts):
        first, last = starts[0], starts[-1]
        after = _ending(own, passage, len(own) - last - n, np.flatnonzero(there == runs[last]) + n)
        before = _ending(own[::-1], passage[::-1], first, len(passage) - np.flatnonzero(there == runs[first]))
        found[len(own) - after:] = True
        found[:before] = True
    shares = [(float(found[:c].mean()) if c else 1.0, float(found[c:].mean())) for c in item.cuts]
    return max(shares, key=lambda s: min(s[0] - question, s[1] - answer))


def _passages(offsets: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first word and end of every passage."""
    sizes = np.diff(offsets)
    number = np.maximum(1, -(-(sizes - longest) // longest))
    doc = np.repeat(np.arange(len(sizes)), number)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    first = offsets[doc] + within * longest
    return doc, first, np.minimum(first + 2 * longest, offsets[doc + 1])


def _search(shared, least: float, question: float, answer: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            hashes, offsets = words(*flat(batch.column("text")), _TABLE)
            place = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
            term = np.where(index.terms[place] == hashes, place, len(index.terms))
            doc, first, end = _passages(offsets, index.longest)
            at = np.flatnonzero(index.rare[term])
            rare, low, high = term[at], np.searchsorted(at, first), np.searchsorted(at, end)
            hopeful: dict[int, list[int]] = {}
            for block, top in enumerate(index.tops):
                sums = np.concatenate([[0.0], np.cumsum(top[rare])])
                for p in np.flatnonzero(sums[high] - sums[low] >= least - index.common[block] - 1e-9):
                    hopeful.setdefault(int(p), []).append(block)
            rows: dict[tuple[int, int], tuple] = {}
            for p, blocks in sorted(hopeful.items()):
                distinct = np.unique(term[first[p]:end[p]])
                distinct = distinct[distinct < len(index.terms)]
                once = distinct[index.rare[distinct]]  # a repeated word counts once
                bounds = index.tops[np.ix_(blocks, once)].sum(axis=1) + index.common[blocks]
                able = np.array(blocks)[bounds >= least - 1e-9]
                for number, score in wand(index, distinct, able, least):
                    item = index.items[number]
                    q, a = overlap(item, hashes[first[p]:end[p]], question, answer)
                    best = rows.get((doc[p], number))
                    if q >= question and a >= answer and (best is None or best[4:] < (q, a)):
                        rows[doc[p], number] = (ids[doc[p]], item.item_id, int(first[p] - offsets[doc[p]]), min(score, 1.0), q, a)
            if rows:
                kinds = [pa.int64()] * 3 + [pa.float64()] * 3
                names = ["doc_id", "item_id", "word", "score", "question_overlap", "answer_overlap"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows.values()), kinds)], names=names)

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per item and term of it, and one without term that has the item's length."""
    for batch in slices(batches, "text"):
        items = [parse_item(0, text).words for text in batch.column("text").to_pylist()]
        items = [words for words in items if len(words)]
        distinct = [np.unique(words) for words in items]
        terms = np.concatenate(distinct or [np.empty(0, np.uint64)]).view(np.int64)
        sizes = pa.array([len(words) for words in items], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.nulls(len(terms), pa.int64())], names=["term", "words"])
        yield pa.RecordBatch.from_arrays([pa.nulls(len(sizes), pa.int64()), sizes], names=["term", "words"])


def corpus_in(benchmark: DataFrame) -> Corpus:
    """Counted in Spark; the driver gets a number per term of the benchmark."""
    counted = map_arrow(benchmark.select("text"), _item_terms, "term long, words long")
    rows = counted.groupBy("term").agg(F.count("*").alias("n"), F.sum("words").alias("words"), F.max("words").alias("longest")).toArrow()
    known = rows.column("term").is_valid()
    whole, terms = rows.filter(pc.invert(known)).to_pylist(), rows.filter(known)
    if not whole:
        return corpus_of([])
    hashes = terms.column("term").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    size = whole[0]["n"]
    return Corpus(size, whole[0]["words"] / size, whole[0]["longest"], hashes[order], terms.column("n").to_numpy()[order])


def shards(benchmark: DataFrame, shard_items: int, shard_words: int) -> Iterator[Index]:
    """The items, in order of their ids, as indexes of bounded size; one at a time is in memory."""
    plain = benchmark.select(F.col("item_id").cast("long"), "text").filter("length(text) > 0")
    corpus = corpus_in(plain)
    held, size = [], 0
    for row in plain.orderBy("item_id", "text").toLocalIterator():
        item = parse_item(row.item_id, row.text)
        if held and (len(held) >= shard_items or size + len(item.words) > shard_words):
            yield build_index(held, corpus)
            held, size = [], 0
        held.append(item)
        size += len(item.words)
    if held:
        yield build_index(held, corpus)


def contaminated(docs: DataFrame, benchmark: DataFrame, least_score: float = 0.5, question: float = 0.75,
                 answer: float = 0.5, shard_items: int = 20_000, shard_words: int = 1_000_000) -> DataFrame:
    """One row per row of ``docs`` and test item found in it, with the first word of the best passage."""
    spark = docs.sparkSession
    plain = docs.select(F.col("doc_id").cast("long"), F.lower("text").alias("text"))
    found = None
    for index in shards(benchmark, shard_items, shard_words):
        if not index.items:
            continue
        part = map_arrow(plain, _search(spark.sparkContext.broadcast(index), least_score, question, answer), SCHEMA)
        found = part if found is None else found.union(part)
    return found if found is not None else spark.createDataFrame([], SCHEMA)


def _keep_clean(shared, least: float, question: float, answer: float):
    """Batches without their last column, the text in lower case, and without the rows in which an item is found."""
    search = _search(shared, least, question, answer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            places = pa.array(np.arange(batch.num_rows))
            probe = pa.RecordBatch.from_arrays([places, batch.column(batch.num_columns - 1)], names=["doc_id", "text"])
            clean = np.ones(batch.num_rows, bool)
            for found in search(iter([probe])):
                clean[found.column("doc_id").to_numpy()] = False
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(clean))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least_score: float = 0.5, question: float = 0.75,
                      answer: float = 0.5, shard_items: int = 20_000, shard_words: int = 1_000_000) -> DataFrame:
    """``docs`` without the rows in which a test item is found, judged one by one, with an id or without;
    all columns as they were. What one shard leaves goes on to the next, without a shuffle."""
    left = docs
    for index in shards(benchmark, shard_items, shard_words):
        if index.items:
            shared = docs.sparkSession.sparkContext.broadcast(index)
            lowered = left.select(*[F.col(f"`{c}`") for c in docs.columns], F.lower("text").alias("__lowered"))
            left = map_arrow(lowered, _keep_clean(shared, least_score, question, answer), docs.schema)
    return left
