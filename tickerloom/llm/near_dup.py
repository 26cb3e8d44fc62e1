"""Near-duplicate documents by b-bit MinHash.

One scan hashes every document's distinct five-word shingles, takes 512 minima, hashes the first 128 of
them in 32 bands of four and keeps the two low bits of every (mixed) minimum, packed into 16 longs.
Documents with equal shingle sets fall into one class. Classes are the vertices of all that follows;
ids come back at the end.

Two classes are candidates if they share a band. The packed signatures estimate their
similarity: of the fields that agree, a quarter agrees by chance, so J = (P - 1/4) / (3/4). Pairs five
standard errors below the threshold are left out, the others are confirmed on their full sets, in two
rounds. The first compares every class with the centres of its buckets only, a centre being
the member that has most bucket mates over all its bands; that is at most a pair per row and band. The
second settles what the first left open: buckets whose members are not all connected yet are dealt in
blocks of ``BLOCK`` rows, and a task holds two blocks of one bucket. First by their signatures alone, to
find the rows that may be linked with a mate of another group; then these with their sets, likeliest
pairs first, and only links that connect two groups are returned. So no list of a group's pairs is ever
made, and no key holds a bucket.

Two documents at the threshold miss all bands with probability (1 - 0.75^4)^32, about 5 in a million.

Defined cases: NULL text, or text without a word, has an empty set and is linked with nothing; fewer
than five words make one shingle of the whole sequence; a ``doc_id`` is one document: equal rows count
once, and if its rows differ, whatever any of them is linked with is linked with it; a row without
``doc_id`` is linked with nothing, has no component and is kept by ``near_duplicates``, while
``keep_one_of_each`` takes it for the copy that it is; an empty table gives an empty result; other
columns take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import Staging, stage
from .components import components
from .text import blank_separated, flat, map_arrow, mix, slices, words

WORDS = 5
MINIMA, BANDS, BAND_ROWS, BITS = 512, 32, 4, 2
PER_LONG = 64 // BITS
BLOCK = 512  # rows of a bucket that meet in one task
THRESHOLD = 75  # per cent
ESTIMATE_FROM = 0.635  # five standard errors of the estimate below the threshold
_LOW_BITS = "6148914691236517205L"  # 0x5555555555555555, the low bit of every field
_SIGNATURE = ", ".join(f"s{i} long" for i in range(MINIMA // PER_LONG))
SCHEMA = f"doc_id long, id_hash long, text_hash long, n_shingles long, f1 long, f2 long, {_SIGNATURE}, bands array<long>"
_PRINT = ["f1", "f2", "n_shingles"]
_ROW = ["id_hash", "text_hash"]  # tells rows apart, also those without id

_seeds = mix(np.arange(1, 2 * MINIMA + WORDS + 40, dtype=np.uint64)) | np.uint64(1)
_PLACES = _seeds[:WORDS]
_FACTORS = (_seeds[WORDS:WORDS + MINIMA] >> np.uint64(16)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (_seeds[WORDS + MINIMA:WORDS + 2 * MINIMA] >> np.uint64(24)).astype(np.uint32)
_TABLE = blank_separated()


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, offsets = words(*flat(column), _TABLE)
    whole = np.zeros(max(0, len(hashes) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        whole += hashes[k:k + len(whole)] * _PLACES[k]
    whole = mix(whole)
    for first, last in zip(offsets[:-1], offsets[1:]):
        n = last - first
        if n >= WORDS:
            yield np.unique(whole[first:last - WORDS + 1])
        elif n:
            short = (hashes[first:last] * _PLACES[:n]).sum(dtype=np.uint64)
            yield mix(np.array([short + np.uint64(n)], np.uint64))
        else:
            yield whole[:0]


def minima(shingles: np.ndarray) -> np.ndarray:
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(MINIMA, np.uint32(0xFFFFFFFF))
    for i in range(0, len(short), 1024):
        table = _FACTORS[:, None] * short[None, i:i + 1024]
        table += _SHIFTS[:, None]
        np.minimum(best, table.min(axis=1), out=best)
    return best


_BAND_PLACES = _seeds[-BAND_ROWS:]
_BAND_NUMBERS = mix(np.arange(1000, 1000 + BANDS, dtype=np.uint64))
_FIELD_SHIFTS = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sizes, prints, lows, bands = [], [], [], []
        for shingles in shingle_sets(batch.column("text")):
            sizes.append(len(shingles))
            prints.append((shingles.sum(dtype=np.uint64), mix(shingles ^ _seeds[-9]).sum(dtype=np.uint64)))
            lows.append(minima(shingles))
        lows = np.array(lows, np.uint32).reshape(-1, MINIMA).astype(np.uint64)
        keys = mix((mix(lows[:, :BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS)) * _BAND_PLACES).sum(axis=2, dtype=np.uint64) + _BAND_NUMBERS)
        low = mix(lows + np.uint64(1)) & np.uint64((1 << BITS) - 1)
        packed = (low.reshape(len(lows), -1, PER_LONG) << _FIELD_SHIFTS).sum(axis=2, dtype=np.uint64)
        prints = np.array(prints, np.uint64).reshape(-1, 2)
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1).view(np.int64)))
        columns = [*(batch.column(c) for c in ("doc_id", *_ROW)), pa.array(sizes, pa.int64()), *(pa.array(np.ascontiguousarray(c).view(np.int64)) for c in (*prints.T, *packed.T)), bands]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *_ROW, "n_shingles", "f1", "f2", *(f"s{i}" for i in range(packed.shape[1])), "bands"])


def signatures(docs: DataFrame) -> DataFrame:
    return map_arrow(docs.select(F.col("doc_id").cast("long"), *_row_hashes(), F.col("text")), _sign, SCHEMA)


def _row_hashes() -> list[Column]:
    return [F.xxhash64(F.col("doc_id").cast("long")).alias("id_hash"), F.xxhash64("text").alias("text_hash")]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()  # repeated rows, which come to one task, make one set
    for batch in slices(batches, "text"):
        vertices = batch.column("vertex").to_pylist()
        new = [v not in seen and not seen.add(v) for v in vertices]
        batch = batch.filter(pa.array(new, pa.bool_()))
        sets = [s.tobytes() for s in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("vertex"), pa.array(sets, pa.binary())], names=["vertex", "shingles"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        links = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b")):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            links.append(_similar(x, y))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(links, pa.bool_()))


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= THRESHOLD * (len(x) + len(y) - both)


def _likeness(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Rows of the first and of the second block, and which of their pairs may link two groups, by the estimate."""
    block = rows.column("block").to_numpy()
    first, second = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    differing = np.zeros((len(left), len(right)), np.int64)
    for i in range(MINIMA // PER_LONG):
        word = rows.column(f"s{i}").to_numpy().view(np.uint64)
        x = word[left][:, None] ^ word[right][None, :]
        differing += np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555))
    like = (1 - differing / MINIMA - 2.0 ** -BITS) / (1 - 2.0 ** -BITS)
    labels = rows.column("label").to_numpy()
    return left, right, like, (like >= ESTIMATE_FROM) & (labels[left][:, None] != labels[right][None, :])


def _doubtful(rows: pa.Table) -> pa.RecordBatch:
    """The rows that may be linked with one of another group."""
    left, right, _, open_ = _likeness(rows)
    some = pa.array(np.union1d(left[open_.any(axis=1)], right[open_.any(axis=0)]))
    return pa.RecordBatch.from_arrays([rows.column(c).combine_chunks().take(some) for c in ("key", "vertex")], names=["key", "vertex"])


def _settle(rows: pa.Table) -> pa.RecordBatch:
    """Links that connect groups."""
    left, right, like, open_ = _likeness(rows)
    if rows.column("i")[0] == rows.column("j")[0]:
        open_ &= left[:, None] < right[None, :]
    vertices, labels = rows.column("vertex").to_numpy(), rows.column("label").to_numpy().copy()
    at = np.argwhere(open_)
    at = at[np.argsort(-like[open_], kind="stable")]
    sets, links = {}, []
    for x, y in zip(left[at[:, 0]], right[at[:, 1]]):
        if labels[x] == labels[y]:
            continue
        for k in (x, y):
            if k not in sets:
                sets[k] = np.frombuffer(rows.column("shingles")[k].as_py(), np.uint64)
        if _similar(sets[x], sets[y]):
            links.append((int(vertices[x]), int(vertices[y])))
            labels[labels == max(labels[x], labels[y])] = min(labels[x], labels[y])
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _each_group(work):
    """Applies ``work`` to one pair of blocks after another; rows come sorted by bucket and pair of blocks."""
    group = ("key", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.stack([batch.column(c).to_numpy() for c in group])
            cuts = [0, *(np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            parts = [pa.Table.from_batches([batch.slice(x, y - x)]) for x, y in zip(cuts, cuts[1:])]
            if held and [held[0].column(c)[0].as_py() for c in group] != at[:, 0].tolist():
                yield work(pa.concat_tables(held))
                held = []
            for part in parts[:-1]:
                yield work(pa.concat_tables([*held, part]))
                held = []
            held.append(parts[-1])
        if held:
            yield work(pa.concat_tables(held))

    return run


def in_block_pairs(rows: DataFrame) -> DataFrame:
    """``rows (key, vertex, ...)`` dealt to every pair of blocks of their bucket that has them, and sorted by it."""
    blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int"))
    paired = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "other"))
    return paired.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "vertex")


def estimate(left: str, right: str) -> Column:
    """Collision-corrected similarity of two packed signatures, from bit counts."""
    agreeing = F.lit(0)
    for i in range(MINIMA // PER_LONG):
        x = F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}"))
        differs = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.expr(_LOW_BITS))
        agreeing = agreeing + F.lit(PER_LONG) - F.bit_count(differs)
    chance = 1 / (1 << BITS)
    return (agreeing / F.lit(MINIMA) - F.lit(chance)) / F.lit(1 - chance)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    first = sets.select(F.col("vertex").alias("a"), F.col("shingles").alias("set_a"))
    second = sets.select(F.col("vertex").alias("b"), F.col("shingles").alias("set_b"))
    return map_arrow(pairs.select("a", "b").join(first, "a").join(second, "b"), _confirm, "a long, b long", rows=256)


def links(docs: DataFrame, signed: DataFrame, classes: DataFrame, stage: Staging) -> DataFrame:
    """``(node, label)`` of the classes that are linked with another one."""
    signature = [f"s{i}" for i in range(MINIMA // PER_LONG)]
    one = [*_ROW, *_PRINT]
    reps = (signed.join(classes.select(*one, "vertex"), one).dropDuplicates(one).select("vertex", *signature, "bands"))
    banded = reps.select("vertex", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    members = stage(banded.join(shared, "key"), "members")
    mates = members.groupBy("vertex").agg(F.sum("size").alias("mates"))
    nodes = stage(mates.join(reps.drop("bands"), "vertex"), "nodes")
    centres = (members.join(nodes.select("vertex", "mates"), "vertex").groupBy("key")
               .agg(F.max(F.struct("mates", (-F.col("vertex")).alias("less"))).alias("top"))
               .select("key", (-F.col("top.less")).alias("centre")))
    pairs = (members.join(centres, "key").filter("vertex <> centre")
             .select(F.least("vertex", "centre").alias("a"), F.greatest("vertex", "centre").alias("b")).distinct())
    packed = nodes.select("vertex", F.struct(*signature).alias("sig"))
    side = lambda name: packed.select(F.col("vertex").alias(name), F.col("sig").alias(f"sig_{name}"))
    likely = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("like", estimate("sig_a", "sig_b")).filter(F.col("like") >= ESTIMATE_FROM)
    first = stage(likely.select("a", "b").distinct(), "first")
    wanted = classes.join(nodes.select("vertex"), "vertex").select("vertex", *_ROW)
    held = docs.select("text", *_row_hashes()).join(wanted, _ROW).select("vertex", "text")
    sets = stage(map_arrow(held, _sets, "vertex long, shingles binary"), "sets")
    linked = stage(confirmed(first, sets), "linked")
    labels = components(linked)

    labelled = members.join(labels.select(F.col("node").alias("vertex"), "label"), "vertex", "left").select(
        "key", "vertex", F.coalesce("label", "vertex").alias("label"))
    open_keys = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key")
    open_rows = stage(labelled.join(open_keys, "key").join(packed, "vertex").select("key", "vertex", "label", "sig.*"), "open")
    doubtful = stage(in_block_pairs(open_rows).mapInArrow(_each_group(_doubtful), "key long, vertex long").distinct(), "doubtful")
    settling = in_block_pairs(open_rows.join(doubtful, ["key", "vertex"]).join(sets, "vertex"))
    more = stage(settling.mapInArrow(_each_group(_settle), "a long, b long").distinct(), "linked")
    if more.isEmpty():
        return labels
    return components(linked.union(more))


def _least() -> Column:
    """The row with the smallest id, any id before none."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *_ROW)).alias("least")


def _grouped(docs: DataFrame, stage: Staging, nameless: bool) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, f1, f2, n_shingles)`` of every row, and the classes with their component in ``label`` and the
    row that stands for each. Rows without id take part if ``nameless``."""
    signed = stage(signatures(docs), "signatures")
    own = signed.select("doc_id", *_ROW, *_PRINT)
    sets = own.filter((F.col("n_shingles") > 0) & (F.col("doc_id").isNotNull() | F.lit(nameless)))
    classes = stage(sets.groupBy(*_PRINT).agg(_least()).select(*_PRINT, "least.*")
                    .withColumn("vertex", F.monotonically_increasing_id()), "classes")
    labels = links(docs, signed, classes, stage)
    # The classes of an id's different texts belong together.
    repeated = sets.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("n_shingles").alias("x"), F.max("n_shingles").alias("y"), F.min("f1").alias("u"), F.max("f1").alias("v")).filter("x <> y or u <> v")
    if not repeated.isEmpty():
        same = stage(sets.join(repeated.select("doc_id"), "doc_id").join(classes.select(*_PRINT, "vertex"), _PRINT)
                     .select("doc_id", "vertex").distinct(), "same")
        star = same.join(same.groupBy("doc_id").agg(F.min("vertex").alias("least")), "doc_id").select(F.col("least").alias("a"), F.col("vertex").alias("b"))
        labels = components(star.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))
    labelled = classes.join(labels.select(F.col("node").alias("vertex"), "label"), "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))
    return own, stage(labelled, "labelled")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    with Staging(docs.sparkSession) as keep:
        own, labelled = _grouped(docs, keep, nameless=False)
        least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        component = labelled.join(least, "label").select(*_PRINT, "component_id")
        found = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        result = own.join(component, _PRINT, "left").select(
            "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), found).alias("component_id"))
        return stage(result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near-duplicates")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, with the smallest id there is; columns as they were.

    Repeated rows, with an id or without, are copies of each other and one of them stays. Rows without a
    word are nobody's copies and all stay.
    """
    with Staging(docs.sparkSession) as keep:
        _, labelled = _grouped(docs, keep, nameless=True)
        mine = ["__id_hash", "__text_hash"]
        chosen = keep(labelled.groupBy("label").agg(_least()).select(*[F.col(f"least.{c}").alias(f"__{c}") for c in _ROW]), "chosen")
        keyed = docs.withColumns(dict(zip(mine, _row_hashes())))
        worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        copies = keyed.filter(worded).join(chosen, mine, "left_semi").dropDuplicates(mine)
        return stage(copies.unionByName(keyed.filter(~worded)).select(*[F.col(f"`{c}`") for c in docs.columns]), "kept")
