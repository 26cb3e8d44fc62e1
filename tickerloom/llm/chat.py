"""Multi-party chat formatting by perspective rotation, in DataFrame functions only.

For every participant a dialogue is rendered once more, with that speaker as the assistant and all
others as users that carry their name; spans mark the assistant's words and end marks, which are what a
model is trained on. ``system`` turns are instructions: they are rendered in every perspective and
never have one of their own.

A dialogue of up to ``part_turns`` turns is one row per participant, whatever its turns are numbered.
A longer one is a row per ``part_turns`` turns in order, each with its place in the whole, so no row and
no task grows with a conversation: a turn's place in its dialogue is found range by range, a part's
turns are gathered once and rendered for each participant beside them, and the parts' places come from sums over
narrow rows. Spans count code points from the start of the whole dialogue.

Defined cases: a turn delivered twice, equal in all four columns, counts once; turns of one number are
ordered by role and text, NULL first; a NULL turn number comes first; NULL text is empty; a NULL or empty
role is the participant ``unknown``; participants are told apart by their role as it is. In their names
characters outside ``A-Za-z0-9_-`` become ``_``; in a conversation in which roles become alike that way,
changed names, and names that look like it, end in ``-`` and the role's bytes in hexadecimal digits, so
names are as different as roles. ``<|`` in a text is broken up as ``< |``; a conversation
of system turns only gives no rows; a NULL ``conv_id`` is a conversation like any other; other columns
take no part; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import Staging, stage
from .mixing import placed

PART = 64  # turns in a row
SYSTEM = "system"


def _plain(role: Column) -> Column:
    return F.when(role == "", F.lit("unknown")).otherwise(F.regexp_replace(role, "[^A-Za-z0-9_-]", "_"))


def _name(role: Column, alike: Column) -> Column:
    """The rendered name of a role that is not NULL; ``alike``: plain names are not enough in its conversation."""
    plain = _plain(role)
    return F.when(alike & ((plain != role) | plain.rlike("-[0-9A-F]*$")), F.concat(plain, F.lit("-"), F.hex(role))).otherwise(plain)


def participants_of(conversations: DataFrame) -> DataFrame:
    """``__conv, who, alike``: every conversation's roles but ``system``, and whether some of them become alike."""
    roles = conversations.select(F.col("conv_id").alias("__conv"), F.coalesce("role", F.lit("")).alias("who")).distinct()
    mixed = (roles.groupBy("__conv", _plain(F.col("who")).alias("plain")).agg(F.count("*").alias("n")).filter("n > 1")
             .select(F.col("__conv").alias("__mixed"), F.lit(True).alias("alike")).distinct())
    return (roles.filter(F.col("who") != SYSTEM).join(mixed, F.col("__conv").eqNullSafe(F.col("__mixed")), "left")
            .select("__conv", "who", F.coalesce("alike", F.lit(False)).alias("alike")))


def turns_of(conversations: DataFrame, part_turns: int, keep: Staging) -> DataFrame:
    """``conv_id, part, turns``: up to ``part_turns`` distinct turns in order, each with its speaker and safe text."""
    distinct = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").distinct()
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    turn = F.struct(F.col("place"), F.coalesce("role", F.lit("")).alias("speaker"),
                    F.replace(F.coalesce("text", F.lit("")), F.lit("<|"), F.lit("< |")).alias("said"))
    numbered = placed(distinct, ["conv_id"], order, keep, "turns").withColumn("part", F.floor(F.col("place") / part_turns))
    return numbered.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def perspectives(conversations: DataFrame, part_turns: int = PART) -> DataFrame:
    """``conv_id, participant, part, n_turns, char_start, text, spans`` for every participant."""
    with Staging(conversations.sparkSession) as keep:
        people = participants_of(conversations)
        parts = turns_of(conversations, part_turns, keep)
        rotated = parts.join(people, F.col("conv_id").eqNullSafe(F.col("__conv"))).withColumn("participant", _name(F.col("who"), F.col("alike")))

        def header(t: Column) -> Column:
            return (F.when(t["speaker"] == SYSTEM, F.lit("<|im_start|>system\n"))
                    .when(t["speaker"] == F.col("who"), F.lit("<|im_start|>assistant\n"))
                    .otherwise(F.concat(F.lit("<|im_start|>user name="), _name(t["speaker"], F.col("alike")), F.lit("\n"))))

        segments = F.transform("turns", lambda t: F.struct(
            F.concat(header(t), t["said"], F.lit("<|im_end|>\n")).alias("segment"),
            (t["speaker"] == F.col("who")).alias("own"), F.char_length(header(t)).alias("skip")))
        rendered = rotated.select("conv_id", "participant", "part", segments.alias("rows")).select(
            "*", F.transform("rows", lambda r: F.char_length(r["segment"]).cast("long")).alias("sizes"))
        rendered = keep(rendered.withColumn("size", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), "rendered")
        earlier = Window.partitionBy("conv_id", "participant").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        # Places are summed over narrow rows; only dialogues of several parts have any but 0.
        starts = (rendered.select("conv_id", "participant", "part", "size")
                  .withColumn("char_start", F.coalesce(F.sum("size").over(earlier), F.lit(0))).filter("part > 0")
                  .select(*[F.col(c).alias(f"__{c}") for c in ("conv_id", "participant", "part")], "char_start"))
        located = rendered.join(starts, F.col("conv_id").eqNullSafe(F.col("__conv_id"))
                                & (F.col("participant") == F.col("__participant")) & (F.col("part") == F.col("__part")), "left")
        located = located.withColumn("char_start", F.coalesce("char_start", F.lit(0).cast("long")))
        ends = F.transform("sizes", lambda x, i: F.col("char_start") + F.aggregate(F.slice("sizes", 1, i + 1), F.lit(0).cast("long"), lambda a, y: a + y))
        spans = F.transform(F.filter(F.arrays_zip("rows", "ends", "sizes"), lambda r: r["rows"]["own"]),
                            lambda r: F.struct((r["ends"] - r["sizes"] + r["rows"]["skip"]).alias("start"), (r["ends"] - 1).alias("end")))
        result = located.withColumn("ends", ends).select(
            "conv_id", "participant", "part", F.size("rows").cast("long").alias("n_turns"), "char_start",
            F.array_join(F.transform("rows", lambda r: r["segment"]), "").alias("text"), spans.alias("spans"))
        return stage(result, "perspectives")


def chat_digest(conversations: DataFrame) -> DataFrame:
    """The rendered dialogues with their spans written out as ``start-end`` pairs."""
    written = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return perspectives(conversations).withColumn("spans", written)


ORACLE = f"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations),
named AS (
    SELECT *, regexp_replace(CASE WHEN role IS NULL OR role = '' THEN 'unknown' ELSE role END, '[^A-Za-z0-9_-]', '_', 'g') AS speaker,
           replace(coalesce(text, ''), '<|', '< |') AS said,
           (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1) // {PART} AS part
    FROM turns),
speakers AS (SELECT DISTINCT conv_id, speaker AS participant FROM named WHERE speaker <> '{SYSTEM}'),
segments AS (
    SELECT n.conv_id, p.participant, n.part, n.turn, n.role, n.text AS raw, n.speaker = p.participant AS own, said, speaker,
           CASE WHEN speaker = '{SYSTEM}' THEN '<|im_start|>system' || chr(10)
                WHEN speaker = p.participant THEN '<|im_start|>assistant' || chr(10)
                ELSE '<|im_start|>user name=' || speaker || chr(10) END AS header
    FROM named n JOIN speakers p ON n.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
    SELECT *, header || said || '<|im_end|>' || chr(10) AS segment,
           coalesce(sum(length(header || said || '<|im_end|>' || chr(10))) OVER (
               PARTITION BY conv_id, participant ORDER BY part NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, raw NULLS FIRST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
    FROM segments)
SELECT conv_id, participant, part, count(*) AS n_turns, min(place) AS char_start, string_agg(segment, '' ORDER BY place) AS text,
       coalesce(string_agg((place + length(header))::VARCHAR || '-' || (place + length(segment) - 1)::VARCHAR, ',' ORDER BY place) FILTER (WHERE own), '') AS spans
FROM placed GROUP BY conv_id, participant, part
"""
