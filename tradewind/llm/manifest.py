"""Merkle manifest of a dataset: leaf digests, a tree for each group, one root, and a proof for every row.

Leaf coordinates come from ranks in bitmaps, not from a sort. For each group, every task ORs the ids it sees into words of
64 bits, the words are merged by OR, and only words with a bit are kept. 64 words make a container of 4,096 ids: a mask of the
words it has, the words, and their running counts. Counts of containers are added up over a directory of prefixes, at most
65,536 entries under one prefix, so no group is ever gathered whole. The rank of an id is the count before its container,
before its word and before its bit.

Then every level of a tree is a grouping by (tree, place / FAN): the nodes of a run are put into their slots, and the run's
digest is the node of the next level. The way back down carries, for every run, what stands left and right of the path at each
level above, which is the proof of all leaves below it.

Rows that repeat an id within their group follow each other by digest; equal rows are interchangeable. A null id comes before all
others. Everything is built-in functions; nothing of the table reaches the driver but counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.tables import stored

FAN = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of an id within a word and within a container, and of a prefix within the next one.
WORD, CONTAINER, STEP = 6, 12, 16
#: Where a null id is counted.
NULL_ID = -(1 << 63)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def folded(text: Column) -> Column:
    """A-Z in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, key: str = "doc_id", group: str = "source", text: str = "text", every: int = 5) -> DataFrame:
    """(id, tree, doc_id, leaf, tampered, row) of every row; tampered is null where nothing is tampered with.

    tree is '' for a null group, else the group after a letter, so bytewise order puts null first. row is a number of its own.
    """
    content = {c: F.col(f"`{c}`") for c in columns}
    changed = {c: folded(v.cast("string")) if c == text else v for c, v in content.items()}
    marked = F.crc32(content[key].cast("string").cast("binary")) % every == 0
    return docs.select(
        content[key].cast("long").alias("doc_id"),
        F.coalesce(content[key].cast("long"), F.lit(NULL_ID)).alias("id"),
        F.coalesce(F.concat(F.lit("s"), F.col(f"`{group}`").cast("string")), F.lit("")).alias("tree"),
        digest(F.concat(*map(field, content.values()))).alias("leaf"),
        F.when(marked, digest(F.concat(*map(field, changed.values())))).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )


def _before(counts: DataFrame, keys: list[str], order: str, n: str = "n") -> DataFrame:
    """The rows with ``before``: the sum of ``n`` over the rows of the same keys that come earlier."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum(n).over(window), F.lit(0)))


def words(rows: DataFrame) -> DataFrame:
    """(tree, word, bits, n): the ids of each group as words of 64 bits; n counts repeated ids as often as they occur."""
    bit = F.expr(f"shiftleft(1L, cast(id & {(1 << WORD) - 1} as int))")
    return rows.groupBy("tree", F.shiftright("id", WORD).alias("word")).agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n"))


def repeats(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """(tree, id, n) of ids that occur more than once in their group; only words with more rows than bits are looked into."""
    crowded = merged.where(F.col("n") > F.bit_count("bits")).select("tree", "word")
    some = rows.withColumn("word", F.shiftright("id", WORD)).join(crowded, ["tree", "word"], "left_semi")
    return some.groupBy("tree", "id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def ordinals(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """(row, ordinal) of the rows whose id is repeated: their place among the rows of the same id, by digest.

    Counted by the digest's first bytes, then by digest and task, so that no window holds all rows of one id.
    """
    again = rows.join(repeated.select("tree", "id"), ["tree", "id"], "left_semi")
    again = again.select("tree", "id", "leaf", "row", F.substring("leaf", 1, 4).alias("head"), F.shiftright("row", 33).alias("task"))
    runs = again.groupBy("tree", "id", "head", "leaf", "task").agg(F.count(F.lit(1)).alias("n"))
    heads = _before(runs.groupBy("tree", "id", "head").agg(F.sum("n").alias("n")), ["tree", "id"], "head")
    inner = Window.partitionBy("tree", "id", "head").orderBy("leaf", "task").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("inside", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(
        heads.select("tree", "id", "head", "before"), ["tree", "id", "head"]
    )
    own = F.row_number().over(Window.partitionBy("tree", "id", "leaf", "task").orderBy("row")) - 1
    return (
        again.withColumn("own", own)
        .join(placed.select("tree", "id", "leaf", "task", (F.col("before") + F.col("inside")).alias("start")), ["tree", "id", "leaf", "task"])
        .select("row", (F.col("start") + F.col("own")).alias("ordinal"))
    )


def directory(merged: DataFrame, repeated: DataFrame) -> DataFrame:
    """(tree, container, base, mask, words, counts, extra): what a rank needs, one row for each container that has ids.

    mask tells which of the 64 words are there; counts is how many rows stand before each of them in the container; extra
    holds (bit, surplus) of each word's repeated ids; base is how many rows stand before the container in its group.
    """
    surplus = repeated.groupBy("tree", F.shiftright("id", WORD).alias("word")).agg(
        F.collect_list(F.struct(F.col("id").bitwiseAND(F.lit((1 << WORD) - 1)).alias("bit"), (F.col("n") - 1).alias("surplus"))).alias("extra")
    )
    full = merged.join(surplus, ["tree", "word"], "left")
    entry = F.struct(F.col("word").bitwiseAND(F.lit(63)).alias("at"), "bits", "n", "extra")
    containers = full.groupBy("tree", F.shiftright("word", CONTAINER - WORD).alias("container")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries"), F.sum("n").alias("n")
    )
    containers = stored(containers, "bitmap-containers")
    # counts of ever shorter prefixes, until those of one group are few
    lowest, highest = containers.agg(F.min("container"), F.max("container")).first()
    levels, shift = [containers.select("tree", F.col("container").alias("at"), "n")], 0
    while lowest is not None and (highest >> shift) - (lowest >> shift) >= 1 << STEP:
        shift += STEP
        levels.append(levels[-1].groupBy("tree", F.shiftright("at", STEP).alias("at")).agg(F.sum("n").alias("n")))
    base = _before(levels.pop(), ["tree"], "at").select("tree", "at", "before")
    while levels:
        below = levels.pop().withColumn("up", F.shiftright("at", STEP))
        inside = _before(below, ["tree", "up"], "at").withColumnRenamed("before", "inside")
        above = base.select("tree", F.col("at").alias("up"), "before")
        base = inside.join(above, ["tree", "up"]).select("tree", "at", (F.col("before") + F.col("inside")).alias("before"))
    running = F.expr(
        "transform(sequence(0, size(entries) - 1), i -> aggregate(slice(entries, 1, i), 0L, (sum, e) -> sum + e.n))"
    )
    return containers.join(base.select("tree", F.col("at").alias("container"), F.col("before").alias("base")), ["tree", "container"]).select(
        "tree",
        "container",
        "base",
        F.expr("aggregate(entries, 0L, (mask, e) -> mask | shiftleft(1L, cast(e.at as int)))").alias("mask"),
        F.col("entries.bits").alias("words"),
        running.alias("counts"),
        F.expr("transform(entries, e -> coalesce(e.extra, array()))").alias("extra"),
    )


def ranked(rows: DataFrame) -> DataFrame:
    """The rows with ``at``: how many rows of the same group come before."""
    merged = stored(words(rows), "bitmap-words")
    repeated = stored(repeats(rows, merged), "repeated-ids")
    index = directory(merged, repeated)
    bit = F.expr(f"cast(id & {(1 << WORD) - 1} as int)")
    word = F.expr(f"cast(shiftright(id, {WORD}) & 63 as int)")
    lower = "~shiftleft(-1L, {})"
    found = rows.withColumn("container", F.shiftright("id", CONTAINER)).join(index, ["tree", "container"])
    found = found.withColumn("bit", bit).withColumn("word", word)
    found = found.withColumn("slot", F.expr("cast(bit_count(mask & " + lower.format("word") + ") as int)"))
    found = found.withColumn("here", F.expr("bit_count(words[slot] & " + lower.format("bit") + ")"))
    more = F.expr("aggregate(extra[slot], 0L, (sum, e) -> sum + if(e.bit < bit, e.surplus, 0L))")
    found = found.withColumn("first", F.col("base") + F.expr("counts[slot]") + F.col("here") + more)
    placed = found.join(ordinals(rows, repeated), "row", "left")
    return placed.select(*rows.columns, (F.col("first") + F.coalesce("ordinal", F.lit(0))).alias("at"))


def numbered(trees: DataFrame) -> DataFrame:
    """The rows (tree, n) with ``number``: the place of each group in bytewise order, counted by range partitions."""
    ordered = stored(trees.orderBy("tree").withColumn("row", F.monotonically_increasing_id()), "tree-order")
    tasks = ordered.groupBy(F.shiftright("row", 33).alias("task")).agg(F.count(F.lit(1)).alias("n"))
    # one row for each task that wrote: a window over them all is small
    before = _before(tasks.withColumn("all", F.lit(0)), ["all"], "task").select("task", "before")
    place = F.col("before") + F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("task", F.shiftright("row", 33)).join(F.broadcast(before), "task").select("tree", "n", place.alias("number"))


def _run_digest(values: str) -> Column:
    """The digest of a run; a node that is alone in its tree is carried on as it is."""
    return F.when(F.col("left") == 1, F.expr(f"{values}[0]")).otherwise(F.sha2(F.array_join(values, "").cast("binary"), 256))


def grown(nodes: DataFrame, highest: int, fan: int = FAN) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level, from the lowest up, and (tree, digest) of the roots.

    ``nodes`` has rows (tree, at, left, value): value is a struct with ``digest``, left the number of nodes of the tree,
    highest the most of any tree. A run is (tree, at, left, values, digest): ``fan`` neighbours in their slots.
    """
    levels = []
    while True:
        runs = nodes.groupBy("tree", F.expr(f"at div {fan}").alias("at"), "left").agg(
            F.array_sort(F.collect_list(F.struct((F.col("at") % fan).alias("slot"), "value"))).alias("slots")
        )
        runs = runs.select("tree", "at", "left", F.col("slots.value").alias("values"))
        runs = stored(runs.withColumn("digest", _run_digest("values.digest")), "tree-level")
        levels.append(runs)
        highest = -(-highest // fan)
        if highest <= 1:
            return levels, runs.select("tree", "digest")
        upper = F.expr(f"(left + {fan - 1}) div {fan}").alias("left")
        nodes = runs.select("tree", "at", upper, F.struct("digest").alias("value"))


def _sides(values: str) -> Column:
    """For each slot of a run what stands left and right of it; nothing in a tree of one node."""
    join = "array_join(slice({}.digest, {}, {}), '')"
    left = join.format(values, "1", "i")
    right = join.format(values, "i + 2", f"size({values}) - i - 1")
    return F.expr(
        f"transform(sequence(0, size({values}) - 1), i -> if(left = 1, array(), array(named_struct('left', {left}, 'right', {right}))))"
    )


def descended(levels: list[DataFrame], tops: DataFrame, fan: int = FAN) -> DataFrame:
    """(tree, at, values, side, path) of the lowest runs; ``tops`` has (tree, path) for the root of each tree.

    path is a list of (left, right), from the level above the run up to the root over all trees; side has the run's own for each slot.
    """
    paths = tops.select("tree", F.lit(0).cast("long").alias("at"), "path")
    for level, runs in reversed(list(enumerate(levels))):
        runs = runs.join(paths, ["tree", "at"]).withColumn("side", _sides("values"))
        if level == 0:
            return runs.select("tree", "at", "values", "side", "path")
        below = runs.select("tree", "at", F.col("path").alias("rest"), F.posexplode("side").alias("slot", "own"))
        paths = below.select("tree", (F.col("at") * fan + F.col("slot")).alias("at"), F.concat("own", "rest").alias("path"))
    raise AssertionError("a tree has a level")


FOLD = "aggregate(path, {}, (node, p) -> sha2(cast(concat(p.left, node, p.right) as binary), 256))"
SIBLINGS = "aggregate(path, '', (all, p) -> concat(all, p.left, p.right))"


def proven(docs: DataFrame, fan: int = FAN, **options) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    leaf is the digest of the row, subroot that of its group's tree, root the digest over all groups. proof_sha256 is the digest
    of the row's siblings, level by level up to the root. folded_root is what the tampered row and those siblings
    give, and verified whether it is the root. Null texts are not changed by tampering. Repeated rows have a leaf each; a null
    id stands before all others of its group, a null group before all other groups; no rows give no rows. Other columns are not read.
    """
    rows = stored(leaves(docs, **options), "leaves")
    trees = stored(numbered(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))), "trees")
    highest, groups = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    value = F.struct(F.col("leaf").alias("digest"), "doc_id", "tampered")
    sized = trees.select("tree", F.col("n").alias("left"), "number")
    nodes = ranked(rows).join(sized, "tree").select(F.col("number").alias("tree"), "at", "left", value.alias("value"))
    levels, subroots = grown(nodes, highest or 0, fan)
    top = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(groups).alias("left"), F.struct("digest").alias("value"))
    top_levels, root = grown(top, groups, fan)
    nothing = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    ends = descended(top_levels, root.select("tree", nothing.alias("path")), fan)
    ends = ends.join(root.select("tree", F.col("digest").alias("root")), "tree")
    tops = ends.select("root", F.col("at").alias("run"), "path", F.posexplode(F.arrays_zip("values", "side")).alias("slot", "node")).select(
        (F.col("run") * fan + F.col("slot")).alias("tree"),
        F.concat(F.col("node.side"), "path").alias("path"),
        F.col("node.values.digest").alias("subroot"),
        "root",
    )
    runs = descended(levels, tops.select("tree", "path"), fan).join(tops.select("tree", "subroot", "root"), "tree")
    each = runs.select("subroot", "root", F.col("path").alias("rest"), F.posexplode(F.arrays_zip("values", "side")).alias("slot", "node"))
    each = each.select(
        F.col("node.values.doc_id").alias("doc_id"),
        F.col("node.values.digest").alias("leaf"),
        F.coalesce(F.col("node.values.tampered"), F.col("node.values.digest")).alias("claimed"),
        "subroot",
        "root",
        F.concat(F.col("node.side"), "rest").alias("path"),
    )
    proof = F.sha2(F.expr(SIBLINGS).cast("binary"), 256).alias("proof_sha256")
    found = each.select("doc_id", "leaf", "subroot", "root", proof, F.expr(FOLD.format("claimed")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
