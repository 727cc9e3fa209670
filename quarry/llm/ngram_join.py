"""Operator 8: n-gram Jaccard join with signature trees.

A document's set holds its distinct word shingles (hashed to 64 bits); two
sets link when ``100 * shared >= percent * united``. No link is lost:

1. One pass over the texts writes a row per document (size, set id, signature)
   and a count sketch of all shingles. Equal sets are one node from here on; the
   winners of the most frequent sets are broadcast (bounded), so that their
   copies are skipped where they are read.
2. A second pass emits each set's prefix in the order of rarity: two sets that
   link share a token among their first ``n - ceil(percent * n / 100) + 1``.
   Tokens are dealt out by hash; those of a single set vanish, and groups with
   the same members are kept once.
   Groups with the same smallest (then: largest) member become one wherever
   their union has no more pairs than they have apart, as a group of near
   copies shares most of its prefix and would be searched once a token.
3. In every group, the sets that may link with the group's smallest set
   id are verified, and what links is contracted to components. That leaves a
   group of copies, however large, with one label after linear work.
4. Groups that still hold several labels are searched by dual traversal of
   signature trees, which opens only node pairs that may hold a link between
   different labels. Large groups are split into blocks by size class and hash;
   block pairs are separate pieces of work. The first search passes on a forest
   of likely links only, fewer than the sets searched; they are verified and
   contracted. The second search passes on all that may still link.
5. Candidates of large sets, which fill their signatures, are tested by bitmaps
   of a width by the set's size. What remains is verified on the whole sets,
   recomputed for the documents concerned only, and the components are completed.

Set ids are 64-bit digests of the whole sets, compared together with the
size. Defined results: A-Z is lower-cased; a text with fewer words than the
shingle width is one shingle; null, empty and blank texts have no shingle and
link with nothing; ids that are null are ignored when the smallest id of a
component is taken; repeated rows are equal sets; an empty table gives an empty
result; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import signature_tree as tree
from quarry.llm.arrow import tidy, utf8_slices
from quarry.llm.common import Scratch, hash_filter, maybe_in, table
from quarry.llm.components import components
from quarry.llm.shingles import mix, shingle_set
from quarry.llm.sketch import Counter, rarity_classes, sketch_bucket

WIDTH = 5
PERCENT = 75
FILTER_BITS = 22
FREQUENT_SETS = 1000
ENTRIES_PER_TASK = 2_000_000
BLOCK = 512

_PASS1 = "doc_id long, content long, n int, sid long, sig binary, wide binary, slot int, counts binary, bytes int"
_PASS1_ARROW = pa.schema([("doc_id", pa.int64()), ("content", pa.int64()), ("n", pa.int32()), ("sid", pa.int64()), ("sig", pa.binary()),
                          ("wide", pa.binary()),
                          ("slot", pa.int32()), ("counts", pa.binary()), ("bytes", pa.int32())])


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(batch, width: int):
    """(doc_id, tokens) of each row."""
    for doc_id, text in zip(batch.column(0).to_pylist(), utf8_slices(batch.column(1))):
        yield doc_id, shingle_set(b"" if text is None else text.tobytes(), width)


def describe_sets(docs: DataFrame, scratch: Scratch, id_col: str, text_col: str, width: int) -> DataFrame:
    """First pass: rows of documents (slot null) and of the sketch (doc columns null)."""

    def scan(batches):
        counter = Counter()
        for batch in batches:
            ids, ns, sids, sigs, wides = [], [], [], [], []
            for doc_id, tokens in _sets(batch, width):
                ids.append(doc_id)
                ns.append(len(tokens))
                sids.append(set_id(tokens) if len(tokens) else None)
                sigs.append(tree.signature(tokens).tobytes() if len(tokens) else None)
                wide = tree.wide_signature(tokens)
                wides.append(None if wide is None else wide.tobytes())
                counter.add(tokens)
            blank = [None] * len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(
                [ids, batch.column(2), ns, sids, sigs, wides, blank, blank, blank], _PASS1_ARROW)], schema=_PASS1_ARROW)
        slots = counter.columns()
        blank = [None] * len(slots[0])
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(
            [blank, blank, blank, blank, blank, blank, *slots], _PASS1_ARROW)], schema=_PASS1_ARROW)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.col(text_col)).alias("content"))
    return scratch.save(source.mapInArrow(tidy(scan), _PASS1), "pass1")


def shared_groups(docs: DataFrame, counts: np.ndarray, frequent: dict, tasks: int, scratch: Scratch,
                  id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(gh, sid): sets that share a prefix token, a group per member list."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((counts, frequent))  # a byte per sketch bucket and at most FREQUENT_SETS winners
    parts = 1 << max(4, min(20, (8 * tasks - 1).bit_length()))
    shift = np.uint64(64 - parts.bit_length() + 1)

    def prefixes(batches):
        rare, winners = shared.value
        tokens, sids, held = [], [], 0

        def flush():
            nonlocal tokens, sids, held
            if held:
                t, s = np.concatenate(tokens), np.concatenate(sids)
                # a fresh hash, as the order by rarity uses the token's own bits
                t = mix(t ^ np.uint64(0xA5A5A5A5A5A5A5A5))
                part = (t >> shift).astype(np.int32)
                order = np.argsort(part, kind="stable")
                t, s, part = (t & np.uint64(0xFFFFFFFF)).astype("<u4")[order], s[order], part[order]
                cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                ends = np.append(cut[1:], len(part))
                yield pa.RecordBatch.from_pydict(
                    {"part": part[cut].tolist(), "tokens": [t[a:b].tobytes() for a, b in zip(cut, ends)],
                     "sids": [s[a:b].tobytes() for a, b in zip(cut, ends)]},
                    schema=pa.schema([("part", pa.int32()), ("tokens", pa.binary()), ("sids", pa.binary())]))
            tokens, sids, held = [], [], 0

        for batch in batches:
            for doc_id, own in _sets(batch, width):
                n = len(own)
                if not n:
                    continue
                sid = set_id(own)
                if winners.get((sid, n), doc_id) != doc_id:
                    continue
                order = np.lexsort((own, rare[sketch_bucket(own)]))
                prefix = own[order[:n - (percent * n + 99) // 100 + 1]]
                tokens.append(prefix)
                sids.append(np.full(len(prefix), sid, dtype="<i8"))
                held += len(prefix)
                if held > 400_000:
                    yield from flush()
        yield from flush()

    def groups(batches):
        rows = [r for batch in batches for r in batch.to_pylist()]
        if not rows:
            return
        t = np.concatenate([np.frombuffer(r["tokens"], "<u4") for r in rows]).astype(np.uint64)
        part = np.repeat(np.array([r["part"] for r in rows], dtype=np.uint64), [len(r["tokens"]) // 4 for r in rows])
        sid = np.concatenate([np.frombuffer(r["sids"], "<i8") for r in rows])
        del rows
        key = (part << np.uint64(32)) | t
        order = np.argsort(key, kind="stable")
        key, sid = key[order], sid[order]
        same = np.concatenate([[False], key[1:] == key[:-1]])
        live = same | np.append(same[1:], False)
        key, sid = key[live], sid[live]
        order = np.lexsort((sid, key))
        key, sid = key[order], sid[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])])[:len(key)]
        key, sid = key[fresh], sid[fresh]
        if not len(key):
            return
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        with np.errstate(over="ignore"):
            gh = mix(np.add.reduceat(mix(sid.view(np.uint64)), start) + size.astype(np.uint64))
        _, first = np.unique(gh, return_index=True)
        first = first[size[first] > 1]
        member = np.repeat(start[first], size[first]) + np.arange(size[first].sum()) - np.repeat(
            np.cumsum(size[first]) - size[first], size[first])
        gh = np.repeat(gh[first], size[first]).view(np.int64)
        for i in range(0, len(member), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(gh[i:i + 100_000]), pa.array(sid[member[i:i + 100_000]])],
                                             names=["gh", "sid"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    entries = source.mapInArrow(tidy(prefixes), "part int, tokens binary, sids binary")
    found = entries.repartition(tasks, "part").mapInArrow(tidy(groups), "gh long, sid long")
    return scratch.save(found.distinct(), "groups")


def merged_groups(groups: DataFrame, scratch: Scratch, end: str) -> DataFrame:
    """``groups`` with those of one smallest (``end`` "min") or largest ("max")
    member united, where the union has no more pairs than its parts. Sets that
    share a group still do."""
    sized = scratch.save(groups.groupBy("gh").agg(getattr(F, end)("sid").alias("a"), F.count(F.lit(1)).alias("members")),
                         f"{end}-sized")
    several = (sized.groupBy("a").agg(F.sum(F.col("members") * F.col("members")).alias("pairs"), F.count(F.lit(1)).alias("parts"))
               .where("parts > 1"))
    parts = scratch.save(sized.join(several, "a").select("gh", "a", "pairs"), f"{end}-parts")
    union = scratch.save(groups.join(parts, "gh").select("a", "pairs", "sid").distinct(), f"{end}-union")
    united = scratch.save(union.groupBy("a", "pairs").agg(F.count(F.lit(1)).alias("members"))
                          .where("members * members <= pairs").select("a"), f"{end}-united")
    apart = groups.join(parts.join(united, "a", "left_semi"), "gh", "left_anti")
    merged = union.join(united, "a", "left_semi").select(F.xxhash64(F.lit(end), "a").alias("gh"), "sid")
    return scratch.save(apart.unionByName(merged), f"{end}-groups")


def star_pairs(groups: DataFrame, nodes: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Pairs of a group's smallest set id with its others that may link."""
    first = scratch.save(groups.groupBy("gh").agg(F.min("sid").alias("a")), "centres")
    pairs = groups.join(first, "gh").where("sid <> a").select("a", F.col("sid").alias("b")).distinct()
    left = nodes.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    right = nodes.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))

    def bounded(batches):
        for batch in batches:
            c = {k: batch.column(k) for k in batch.schema.names}
            if not len(c["a"]):
                continue
            keep = tree.pairs_may_link(tree.unpack(c["sa"].to_pylist()), c["na"].to_numpy().astype(np.int64),
                                       tree.unpack(c["sb"].to_pylist()), c["nb"].to_numpy().astype(np.int64), percent)
            yield pa.RecordBatch.from_arrays([c["a"], c["b"]], names=["a", "b"]).filter(pa.array(keep))

    sized = (scratch.save(pairs, "star").join(left, "a").join(right, "b")
             .where((100 * F.col("na") >= percent * F.col("nb")) & (100 * F.col("nb") >= percent * F.col("na"))))
    return scratch.save(sized.mapInArrow(tidy(bounded), "a long, b long"), "star-bounded")


def sharpened(pairs: DataFrame, nodes: DataFrame, scratch: Scratch, name: str, percent: int) -> DataFrame:
    """``pairs`` without those of large sets whose wide bitmaps rule a link out:
    a byte a token at most is moved for them in place of whole sets. Only
    bitmaps of sets in ``pairs`` are shuffled."""
    wide = nodes.where("wide is not null").select("sid", "n", "wide")
    held = scratch.save(wide.join(_members(pairs), "sid", "left_semi"), f"{name}-wide")
    left = held.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("wide").alias("wa"))
    right = held.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("wb"))

    def bounded(batches):
        for batch in batches:
            keep = [x is None or y is None or tree.wide_may_link(np.frombuffer(x, np.uint8), nx, np.frombuffer(y, np.uint8), ny, percent)
                    for x, nx, y, ny in zip(*(batch.column(k).to_pylist() for k in ("wa", "na", "wb", "nb")))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    met = pairs.join(left, "a", "left").join(right, "b", "left").select("a", "b", "wa", "na", "wb", "nb")
    return scratch.save(met.mapInArrow(tidy(bounded), "a long, b long"), f"{name}-sharp")


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, scratch: Scratch, name: str, id_col: str,
             text_col: str, width: int, percent: int) -> DataFrame:
    """The links (u, v) among candidate pairs, decided on the whole sets. Sets
    are recomputed for documents in a size-bounded bitmap of those concerned; what
    else hits the bitmap finds no pair. Both sides of the join read one exchange."""
    pairs = sharpened(pairs, nodes, scratch, name, percent)
    needed = scratch.save(nodes.join(_members(pairs), "sid", "left_semi").select("sid", "rep"), f"{name}-needed")
    bitmap = scratch.save(hash_filter(needed.where("rep is not null").select(F.xxhash64("rep")), FILTER_BITS), f"{name}-bits")

    def sets(batches):
        for batch in batches:
            found = [(set_id(t), t.tobytes()) for _, t in _sets(batch, width) if len(t)]
            yield pa.RecordBatch.from_pydict({"sid": [s for s, _ in found], "tokens": [t for _, t in found]},
                                             schema=pa.schema([("sid", pa.int64()), ("tokens", pa.binary())]))

    doc_id = F.col(id_col).cast("long")
    source = docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(doc_id).alias("at"))
    # other texts never reach a Python worker
    concerned = maybe_in(source, "at", bitmap, "hit", FILTER_BITS).where("hit or doc_id is null").select("doc_id", "text")
    whole = concerned.mapInArrow(tidy(sets), "sid long, tokens binary")

    def decide(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ta"), batch.column("tb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["u", "v"]).filter(
                pa.array(keep, pa.bool_()))

    sided = (pairs.join(whole.select(F.col("sid").alias("a"), F.col("tokens").alias("ta")), "a")
             .join(whole.select(F.col("sid").alias("b"), F.col("tokens").alias("tb")), "b"))
    return scratch.save(sided.select("a", "b", "ta", "tb").mapInArrow(tidy(decide), "u long, v long").distinct(), f"{name}-links")


def tree_pairs(groups: DataFrame, nodes: DataFrame, labels: DataFrame, tasks: int, scratch: Scratch, name: str,
               percent: int, forest: bool) -> DataFrame:
    """Candidate pairs of different labels, by dual traversal inside every
    group that holds more than one label: all of them, or (``forest``) only
    likely links that join further labels of a task."""
    labelled = scratch.save(
        groups.join(labels.withColumnRenamed("node", "sid"), "sid", "left")
        .select("gh", "sid", F.coalesce("label", "sid").alias("label")), f"{name}-labelled")
    mixed = scratch.save(labelled.groupBy("gh").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("members"))
        .where("low <> high").select("gh", "members"), f"{name}-mixed")
    members = labelled.join(mixed, "gh").join(nodes.select("sid", "n"), "sid")
    # sizes of linked sets differ by less than one class
    large = F.col("members") > BLOCK
    klass = F.when(large, F.floor(F.log("n") / np.log(100 / percent) + 1e-9)).otherwise(0).cast("int")
    blocks = F.ceil(F.col("members") / BLOCK)
    block = F.when(large, F.pmod(F.xxhash64("sid"), blocks)).otherwise(0).cast("int")
    members = scratch.save(members.select("gh", "sid", "label", "n", klass.alias("class"), block.alias("block")),
                           f"{name}-members")
    held = members.groupBy("gh", "class", "block").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    other = held.select("gh", *[F.col(c).alias(f"{c}2") for c in ("class", "block", "low", "high")])
    after = (F.col("class2") > F.col("class")) | ((F.col("class2") == F.col("class")) & (F.col("block2") >= F.col("block")))
    work = (held.join(other, "gh").where(after & (F.col("class2") <= F.col("class") + 1))
            .where((F.col("low") != F.col("high")) | (F.col("low2") != F.col("high2")) | (F.col("low") != F.col("low2")))
            .withColumn("work", F.xxhash64("gh", "class", "block", "class2", "block2")))
    work = scratch.save(work.select("gh", "class", "block", "class2", "block2", "work"), f"{name}-work")
    twice = (F.col("class") != F.col("class2")) | (F.col("block") != F.col("block2"))
    second = (work.where(twice).select("gh", F.col("class2").alias("class"), F.col("block2").alias("block"), "work")
              .withColumn("side", F.lit(1)))
    sides = work.select("gh", "class", "block", "work").withColumn("side", F.lit(0)).unionByName(second)
    placed = members.join(sides, ["gh", "class", "block"]).select("work", "side", "sid", "label", "n")
    # signatures come last, so that they are moved once
    rows = scratch.save(placed, f"{name}-sides").join(nodes.select("sid", "sig"), "sid").select(
        "work", "side", "sid", "label", "n", "sig")

    def search(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        batch = pa.Table.from_batches(batches)
        work_id, side, sid, label, n = (batch.column(k).to_numpy() for k in ("work", "side", "sid", "label", "n"))
        n = n.astype(np.int64)
        bits = tree.unpack(batch.column("sig").to_pylist())
        order = tree.arrangement(bits, n, sid, work_id, side)
        bits = bits[order]
        work_id, side, sid, label, n = (v[order] for v in (work_id, side, sid, label, n))
        new = np.concatenate([[True], (work_id[1:] != work_id[:-1]) | (side[1:] != side[:-1])])
        levels, _ = tree.build(bits, n, label, np.cumsum(new))
        # one root per (work, side), in order; a second side pairs with the first
        at = np.flatnonzero(new)
        root_work, root_side = work_id[at], side[at]
        two = np.append(root_side[1:] == 1, False)
        a = np.flatnonzero(root_side == 0)
        likely = tree.Forest(label) if forest else None
        for i, j in tree.dual_traversal(levels, a, np.where(two[a], a + 1, a), percent):
            if likely:
                i, j = likely.take(i, j, *tree.bit_jaccard(bits, i, j), percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(sid[i], sid[j])), pa.array(np.maximum(sid[i], sid[j]))], names=["a", "b"])

    found = rows.repartition(tasks, "work").mapInArrow(tidy(search), "a long, b long")
    return scratch.save(found.distinct(), f"{name}-pairs")


def labelled_documents(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                       width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, content (a hash of the text), n (shingles)
    and label (equal for linked rows, null without shingles)."""
    spark = docs.sparkSession
    pass1 = describe_sets(docs, scratch, id_col, text_col, width)
    counts = rarity_classes(pass1.where("slot is not null"))
    rows = pass1.where("slot is null")
    nodes = scratch.save(rows.where("n > 0").groupBy("sid", "n").agg(
        F.min("doc_id").alias("rep"), F.min("sig").alias("sig"), F.min("wide").alias("wide"),
        F.count(F.lit(1)).alias("copies")), "nodes")
    top = nodes.where("copies > 1").orderBy(F.desc("copies"), "sid").select("sid", "n", "rep").limit(FREQUENT_SETS)
    frequent = {(r["sid"], r["n"]): r["rep"] for r in top.collect() if r["rep"] is not None}
    total = rows.agg(F.sum("n")).first()[0] or 0
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(own, -(-(total * (100 - percent) // 100) // ENTRIES_PER_TASK))
    groups = shared_groups(docs, counts, frequent, tasks, scratch, id_col, text_col, width, percent)
    groups = merged_groups(merged_groups(groups, scratch, "min"), scratch, "max")
    check = (docs, scratch)
    links = verified(star_pairs(groups, nodes, scratch, percent), nodes, *check, "star", id_col, text_col, width, percent)
    labels = components(links, scratch, "star")
    for name, forest in (("forest", True), ("tree", False)):
        rest = tree_pairs(groups, nodes, labels, tasks, scratch, name, percent, forest)
        more = verified(rest, nodes, *check, name, id_col, text_col, width, percent)
        # contract what is known, then go on from there
        known = labels.select(F.col("node").alias("u"), F.col("label").alias("v"))
        labels = components(known.unionByName(more), scratch, f"{name}-all")
    return scratch.save(
        rows.select("doc_id", "content", "n", "sid").join(labels.withColumnRenamed("node", "sid"), "sid", "left")
        .select("doc_id", "content", "n", F.coalesce("label", "sid").alias("label")), "placed")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                       percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    scratch = Scratch(docs.sparkSession, "ngram-join")
    placed = labelled_documents(docs, scratch, id_col, text_col, width, percent)
    # only components of several rows are looked up; a component's rows are combined before the shuffle
    least = scratch.save(placed.where("label is not null").groupBy("label").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select("label", "least"), "least")
    return (placed.join(least, "label", "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.coalesce("least", "doc_id").alias("component_id")))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                      percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id
    (null ids last, then the smallest hash of the text). Texts without shingles
    link with nothing and stay."""
    scratch = Scratch(docs.sparkSession, "one-per-component")
    placed = labelled_documents(docs, scratch, id_col, text_col, width, percent).where("label is not null")
    placed = placed.withColumn("me", F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "content"))
    winners = scratch.save(placed.groupBy("label").agg(F.min("me").alias("winner"), F.count(F.lit(1)).alias("rows"))
                           .where("rows > 1").select("label", "winner"), "winners")
    # rows that go, and rows that repeat the one that stays
    found = (placed.join(winners, "label").groupBy("doc_id", "content")
             .agg(F.max(F.col("me") != F.col("winner")).alias("__goes"), F.count(F.lit(1)).alias("times"))
             .where("__goes or times > 1").select(F.col("doc_id").alias("__id"), F.col("content").alias("__text"), "__goes"))
    found = scratch.save(found.withColumn("__h", F.xxhash64("__id", "__text")), "found")
    bits = scratch.save(hash_filter(found.select("__h"), FILTER_BITS), "found-bits")
    rows = docs.withColumn("__content", F.xxhash64(F.col(text_col)))
    rows = maybe_in(rows.withColumn("__key", F.xxhash64(F.col(id_col).cast("long"), "__content")), "__key", bits,
                    "__maybe", FILTER_BITS)
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.col("__content") == F.col("__text"))
    met = rows.where("__maybe").join(found.drop("__h"), same, "left").where("__goes is null or not __goes")
    repeated = met.where("__goes is not null").dropDuplicates(["__id", "__text"])
    parts = [rows.where("not __maybe"), met.where("__goes is null"), repeated]
    return reduce(DataFrame.unionByName, [p.select(*docs.columns) for p in parts])


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {"op8_ngram_join": op8_ngram_join}
