"""Operator 11: repair of conversation structure by lightest derivations.

A conversation's rows are taken by turn (nulls first; rows of one turn by the
SHA-256 of role and text). A row's first fault counts: blank, duplicate of an earlier
row, truncated. Edits keep rows, give them another role, delete them or insert turns; the
cheapest edits whose roles read ``(s?(ua)+)?`` are found by Knuth's agenda over
weighted deductions (``derivation``), ties by the audit's ASCII order.

1. Rows are sorted over the whole table by range, numbered and written, so that a
   conversation may lie in any number of tasks.
2. Faults come from digests: the first row of each digest is found by one
   aggregation, combined before the shuffle, and joined back by row number, which is unique.
3. Each block of at most 2^10 successive rows becomes one row (a letter or two for
   each turn) and is solved as a deduction problem of its own, for all states before
   and after it if its conversation has several blocks. Blocks then chain by the
   same agenda; what a task holds there is the audits of one conversation, at most 13
   letters a turn, while the audit that is returned has one.
4. Repairs are replayed on the rows as a stream, ordered by conversation and
   number: a task holds one batch and one audit. The digest of a repaired conversation is
   sequential by its definition; nothing else is done by conversation.

Defined results: a null role or text is read as one space, as is a null id or turn
where they are written out; rows without an id are one conversation; a role that begins
with none of s, u, a, or is empty, fits nowhere as it is; very long texts are digested
whole and go through the stream as they are; repeated rows are duplicates; an empty table
gives an empty result; extra columns are not read and never clash. Eager: jobs run while
the result is built.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarry.llm.arrow import tidy
from quarry.llm.common import WORD, Scratch, table
from quarry.llm.derivation import ACCEPTING, AFTER, INSERT, START, STATES, chained, repairs, replay

BLOCK_BITS = 10
STOP = r"[.!?][\x20\x09-\x0D]*\z"  # a text that is not truncated
EMPTY = hashlib.sha256(b"").hexdigest()
_SOLVED = "conv string, block long, before int, after int, cost long, audit string"


def _written(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with a twentieth of the rows each dropped, emptied,
    cut of its stops, repeated, and given to the user, by a checksum of id and turn."""
    kind = F.pmod(F.crc32(F.concat(_written(conv_col), F.lit(":"), _written(turn_col))), F.lit(20))
    text = _written(text_col)
    return (rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), kind.alias("kind"),
                        F.when(kind == 4, F.lit("user")).otherwise(_written(role_col)).alias("role"),
                        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
            .where("kind <> 0").withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", "role", "text"))


def conversation_key(conv: str | Column) -> Column:
    """A string that is never null and differs for every id and for null."""
    c = (F.col(conv) if isinstance(conv, str) else conv).cast("string")
    return F.coalesce(F.concat(F.lit("="), c), F.lit(""))


def ordered_turns(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, turn, role, text, digest, pos) of (conv_id, turn, role, text): numbered in order and written."""
    keyed = rows.select(conversation_key("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
                        _written("role").alias("role"), _written("text").alias("text"))
    digest = F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    order = ["conv", "turn", "digest"]
    sorted_ = keyed.withColumn("digest", digest).repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.save(sorted_.withColumn("pos", F.monotonically_increasing_id()), "turns")


def blocks_of(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """One row for each block: initials and faults of its rows in order, turn
    numbers, and whether it is its conversation's first and last."""
    slim = turns.select("conv", "turn", "digest", "pos",
                        F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("x").alias("initial"),
                        (~F.col("text").rlike(WORD)).alias("blank"), F.col("text").rlike(STOP).alias("ends"))
    first = slim.groupBy("conv", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    fault = (F.when(F.col("blank"), "b").when(F.col("new").isNull(), "d").when(~F.col("ends"), "t").otherwise("."))
    marked = slim.drop("digest").join(first, "pos", "left").withColumn("fault", fault)
    held = marked.groupBy("conv", F.shiftright("pos", BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "initial", "fault"))).alias("rows"),  # at most 2^BLOCK_BITS
        F.min("turn").alias("low"), F.max("turn").alias("high"), F.size(F.collect_set("turn")).alias("turns"))
    by_block = W.partitionBy("conv").orderBy("block")
    return scratch.save(held.select(
        "conv", "block", F.col("rows")[0]["pos"].alias("pos"), F.array_join("rows.initial", "").alias("initials"),
        F.array_join("rows.fault", "").alias("faults"), "low", "high", "turns").withColumns({
            "earlier": F.lag(F.right("initials", F.lit(1))).over(by_block), "earlier_high": F.lag("high").over(by_block),
            "is_last": F.lead("block").over(by_block).isNull()}), "blocks")


def structure(blocks: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal)."""
    joined = F.concat(F.coalesce("earlier", F.lit("")), F.col("initials"))
    pairs = F.length(joined) - 1
    # alternating characters: each legal pair is one match of a look-ahead
    legal = F.regexp_count(joined, F.lit("(?=su|ua|au)"))

    def count(fault: str) -> Column:
        return F.sum(F.regexp_count("faults", F.lit(fault))).cast("long").alias(
            {"b": "blank", "d": "duplicate", "t": "truncated"}[fault])

    again = F.when(F.col("earlier_high") == F.col("low"), 1).otherwise(0)  # a turn that goes on in the next block
    gaps = F.max("high") - F.min("low") + 1 - F.sum(F.col("turns") - again)
    return blocks.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), count("b"), count("d"), count("t"),
                                      F.sum(pairs - legal).cast("long").alias("illegal"))


def solved_blocks(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """The lightest repairs of each block by the states before and after it (-1: the end)."""

    def solve(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                starts = [START] if r["is_first"] else STATES
                for after in [-1] if r["is_last"] else STATES:
                    ends = ACCEPTING if after < 0 else [after]
                    for before, (cost, audit) in sorted(repairs(r["initials"], r["faults"], starts, ends).items()):
                        out.append((r["conv"], r["block"], before, after, cost, audit))
            conv, block, before, after, cost, audit = zip(*out) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.string()), pa.array(block, pa.int64()), pa.array(before, pa.int32()),
                 pa.array(after, pa.int32()), pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
                names=["conv", "block", "before", "after", "cost", "audit"])

    asked = blocks.select("conv", "block", "initials", "faults", F.isnull("earlier").alias("is_first"), "is_last")
    return scratch.save(asked.repartition("conv", "block").mapInArrow(tidy(solve), _SOLVED), "solved")


def chosen_repairs(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, block, before, audit, cost): the repair of each block in the lightest of its conversation; the cost
    of the whole stands in its first block, 0 in the others."""
    solved = solved_blocks(blocks, scratch)
    # most conversations are one block, solved from the start to the end
    long_ = solved.where("after >= 0").select("conv").distinct()
    alone = solved.join(long_, "conv", "left_anti").select("conv", "block", "before", "audit", "cost")
    lists = solved.join(long_, "conv").groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("block", "before", "after", "cost", "audit"))).alias("all"))

    def chain(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                numbers = sorted({e["block"] for e in r["all"]})
                found: dict = {b: {} for b in numbers}
                for e in r["all"]:
                    found[e["block"]][e["before"], e["after"]] = (e["cost"], e["audit"])
                cost, states = chained([found[b] for b in numbers])
                audits = [found[b][s, t][1] for b, s, t in zip(numbers, states, [*states[1:], -1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["conv"]] * len(numbers), pa.string()), pa.array(numbers, pa.int64()), pa.array(states, pa.int32()),
                     pa.array(audits, pa.string()), pa.array([cost] + [0] * (len(numbers) - 1), pa.int64())],
                    names=["conv", "block", "before", "audit", "cost"])

    joined = lists.mapInArrow(tidy(chain), "conv string, block long, before int, audit string, cost long")
    return scratch.save(alone.unionByName(joined), "chosen")


def _replayed(turns: DataFrame, plan: DataFrame, key: list[str], task, schema: str) -> DataFrame:
    """Run ``task`` on an iterator of (conv, block, edit, role, text), of each ``key`` in
    order and in one task; a block's repair comes before its rows."""

    def run(batches):
        def results():
            conv, block, audit, state, at = None, None, "", START, 0
            for batch in batches:
                for r in batch.to_pylist():
                    if r["side"] == 0:
                        conv, block, audit, state, at = r["conv"], r["block"], r["audit"], r["before"], 0
                    # a row has one letter; the turns inserted behind it go with it
                    end = at + r["side"]
                    while audit[end:end + 1] == INSERT:
                        end += 1
                    for edit, role, text in replay(audit[at:end], state, [(r["role"], r["text"])]):
                        state = AFTER[role[:1]]
                        yield conv, block, edit, role, text
                    at = end

        yield from task(results())

    block = F.shiftright("pos", BLOCK_BITS).alias("block")
    given = turns.select("conv", block, F.lit(1).alias("side"), "pos", "role", "text", F.lit(None).cast("string").alias("audit"),
                         F.lit(None).cast("int").alias("before"))
    plans = plan.select("conv", "block", F.lit(0).alias("side"), F.lit(None).cast("long").alias("pos"),
                        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit", "before")
    return (plans.unionByName(given).repartition(*key).sortWithinPartitions("conv", "block", "side", "pos")
            .mapInArrow(tidy(run), schema))


def repaired_digests(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv, sha): SHA-256 of the repaired conversation's ``role:text`` lines."""

    def digest(results):
        here, sha, out = None, None, []

        def rows():
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.string()), pa.array([s for _, s in out], pa.string())],
                                              names=["conv", "sha"])

        for conv, _, _, role, text in results:
            if conv != here:
                if here is not None:
                    out.append((here, sha.hexdigest()))
                here, sha = conv, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
            if len(out) >= 10_000:
                yield rows()
                out.clear()
        if here is not None:
            out.append((here, sha.hexdigest()))
        yield rows()

    return _replayed(turns, plan, ["conv"], digest, "conv string, sha string")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations of (conv_id, turn, role, text): conv_id (as a string), block and nth
    (their order), edit (K, R or I), role, text."""
    scratch = Scratch(rows.sparkSession, "repaired-turns")
    turns = ordered_turns(rows, scratch)
    plan = chosen_repairs(blocks_of(turns, scratch), scratch)

    def numbered(results):
        here, nth, out = None, 0, []

        def batch():
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string())
            columns = zip(*out) if out else [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=["conv_id", "block", "nth", "edit", "role", "text"])

        held = 0
        for conv, block, edit, role, text in results:
            nth = nth + 1 if (conv, block) == here else 0
            here = (conv, block)
            out.append((conv[1:] if conv else None, block, nth, edit, role, text))
            held += len(text)
            if len(out) >= 10_000 or held > 1 << 24:
                yield batch()
                out.clear()
                held = 0
        yield batch()

    return _replayed(turns, plan, ["conv", "block"], numbered,
                     "conv_id string, block long, nth int, edit string, role string, text string")


def repair_report(rows: DataFrame, original: DataFrame | None = None) -> DataFrame:
    """One row for each conversation of (conv_id, turn, role, text), or of ``original``:
    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    scratch = Scratch(rows.sparkSession, "conversations")
    turns = ordered_turns(rows, scratch)
    blocks = blocks_of(turns, scratch)
    plan = chosen_repairs(blocks, scratch)
    whole = plan.groupBy("conv").agg(
        F.sum("cost").alias("cost"), F.array_join(F.sort_array(F.collect_list(F.struct("block", "audit")))["audit"], "").alias("audit"))
    ids = (rows if original is None else original).select("conv_id").distinct().withColumn("conv", conversation_key("conv_id"))
    found = (ids.join(structure(blocks), "conv", "left").join(whole, "conv", "left")
             .join(repaired_digests(turns, plan), "conv", "left"))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha", F.lit(EMPTY)).alias("repaired_sha256"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair_report(damage(rows), rows)


QUERIES = {"op11_conversations": op11_conversations}
