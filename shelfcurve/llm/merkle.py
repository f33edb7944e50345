"""Merkle manifest of a dataset with leaf coordinates from bitmap ranks.

A row is a leaf; the leaves of a group (source) ascend by doc_id. Their places come from compressed
bitmaps, not from a sort of the leaves: a group's doc_ids are kept as 64-bit words, merged with OR
before and after the shuffle, and 64 words make a container: only words that are not zero, a presence
word that tells which those are, and a directory of the rows before each. A container's rows before
it come from a running total over the containers. The rank of a doc_id is then: rows before its
container, plus the directory entry of its word, plus the set bits below its own.

Trees are reduced over keyed slot arrays: a node's place is divided by ``FANOUT`` into the key of its
parent and its slot there; the slots of a key, at most ``FANOUT``, are joined to the parent's digest.
On the way down each run is joined to the path of its parent, so a leaf's path is built at the leaf
only. A hot group is spread by the parent keys; no step collects a group.

Digests are lowercase hex of SHA-256. A leaf is the digest of its columns: ``-`` for a null, else the
number of UTF-8 bytes, ``:`` and the value. While a tree has several nodes, every ``FANOUT`` of them,
or what is left at the end, become the digest of their digests. A lone leaf is its group's subroot.
Groups are ordered by source, null first, then by bytes; their subroots are reduced alike.

Null doc_ids come first in their group. Rows of one doc_id are ordered by their leaf; equal rows are
leaves of their own, next to each other. No rows: an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcurve.operators.joins import join_group_stats
from shelfcurve.operators.windows import running_total, surrogate_key
from shelfcurve.session import materialise

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NULL_WORD = -(1 << 57)  # below every doc_id >> 6; a multiple of 64, so that nulls have a container of their own
EXPLODE = 10_000


def _field(column: Column) -> Column:
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """The leaf of a row of ``COLUMNS`` whose text is ``text``."""
    return F.sha2(F.concat(*[_field(text if c == "text" else F.col(c)) for c in COLUMNS]), 256)


def lower_ascii(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def is_tampered() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def leaves(docs: DataFrame) -> DataFrame:
    """(grp, word, doc_id, leaf, changed): ``changed`` is the leaf after tampering.

    ``grp`` is the source with a mark before it, so that null is a group and comes first.
    """
    grp = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))
    word = F.coalesce(F.expr("shiftright(CAST(doc_id AS BIGINT), 6)"), F.lit(NULL_WORD)).cast("bigint")
    leaf = leaf_digest(F.col("text"))
    changed = F.when(is_tampered(), leaf_digest(lower_ascii(F.col("text")))).otherwise(leaf)
    picked = docs.select(*COLUMNS)
    return picked.select(grp.alias("grp"), word.alias("word"), "doc_id", leaf.alias("leaf"), changed.alias("changed"))


def containers(words: DataFrame) -> DataFrame:
    """(grp, box, present, bits, before, extras, rows) of ``words`` (grp, word, mask, n, extras).

    Bit w of ``present`` tells that word w of the container is kept; ``bits`` holds the kept words and
    ``before`` the rows before each. ``extras`` lists, per kept word, the bits of doc_ids of several
    rows with the number of further rows; it is empty for nearly all.
    """
    low = F.col("word").bitwiseAND(63)
    item = F.struct(low.alias("w"), F.col("mask"), F.col("n"), F.col("extras"))
    boxes = words.groupBy("grp", F.shiftright("word", 6).alias("box")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(word & 63 AS INT)))").alias("present"),
        F.sum("n").alias("rows"),
        F.array_sort(F.collect_list(item)).alias("words"),  # 64 at most
    )
    sums = F.aggregate(
        "words",
        F.array(F.lit(0).cast("bigint")),
        lambda acc, w: F.concat(acc, F.array(F.element_at(acc, -1) + w["n"])),
    )
    return boxes.select(
        "grp", "box", "present", "rows", sums.alias("before"),
        F.transform("words", lambda w: w["mask"]).alias("bits"),
        F.transform("words", lambda w: w["extras"]).alias("extras"),
    )


def ranked(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with their place in the group, and (grp, size) of the groups.

    The first has grp, doc_id, place (from 0), n, leaf, changed: ``n`` equal rows from ``place`` on.
    """
    rows = materialise(leaves(docs), "leaves")
    both = F.struct("leaf", "changed")
    # combined before the shuffle: a doc_id of very many rows is one row per task
    ids = rows.groupBy("grp", "word", "doc_id").agg(F.count("*").alias("n"), F.min(both).alias("lo"), F.max(both).alias("hi"))
    ids = materialise(ids, "ids")
    bit = F.coalesce(F.col("doc_id").cast("bigint").bitwiseAND(63), F.lit(0)).cast("int")
    one = "shiftleft(1L, CAST(coalesce(CAST(doc_id AS BIGINT) & 63, 0) AS INT))"
    words = ids.groupBy("grp", "word").agg(
        F.expr(f"bit_or({one})").alias("mask"),
        F.sum("n").alias("n"),
        F.collect_list(F.when(F.col("n") > 1, F.struct(bit.alias("bit"), (F.col("n") - 1).alias("more")))).alias("extras"),
    )
    boxes = materialise(containers(words), "containers")
    total = materialise(running_total(boxes.select("grp", "box", "rows"), ["grp", "box"], "rows", "upto"), "directory")
    total = total.select("grp", "box", (F.col("upto") - F.col("rows")).alias("ahead"), "rows")
    groups = materialise(total.groupBy("grp").agg(F.min("ahead").alias("start"), F.sum("rows").alias("size")), "groups")
    base = join_group_stats(total, groups, ["grp"]).select("grp", "box", (F.col("ahead") - F.col("start")).alias("base"), "size")
    index = materialise(boxes.join(base, ["grp", "box"]).drop("rows"), "index")

    # the rank query: everything in the container is within 64 words
    place = F.expr("""
        base + before[bit_count(present & ~shiftleft(-1L, w))]
        + bit_count(bits[bit_count(present & ~shiftleft(-1L, w))] & ~shiftleft(-1L, bit))
        + aggregate(extras[bit_count(present & ~shiftleft(-1L, w))], 0L, (s, x) -> s + if(x.bit < bit, x.more, 0L))""")
    asked = ids.withColumns({"box": F.shiftright("word", 6), "w": F.col("word").bitwiseAND(63).cast("int"), "bit": bit})
    found = asked.join(index, ["grp", "box"]).select("grp", "doc_id", place.alias("place"), "size", "n", "lo", "hi")
    found = materialise(found, "places")
    alike = found.where("lo = hi").select("grp", "doc_id", "place", "size", "n", F.col("lo.leaf").alias("leaf"), F.col("lo.changed").alias("changed"))

    # rows of one doc_id that differ: their order among themselves, by a running total over them alone
    mixed = found.where("lo <> hi").select(F.struct("grp", "doc_id").alias("id"), "place", "size")
    theirs = join_group_stats(rows.select(F.struct("grp", "doc_id").alias("id"), "leaf", "changed"), mixed, ["id"])
    counted = theirs.groupBy("id", "place", "size", "leaf", "changed").agg(F.count("*").alias("n"))
    upto = materialise(running_total(counted, ["id", "leaf", "changed"], "n", "upto"), "mixed")
    start = upto.groupBy("id").agg(F.min(F.col("upto") - F.col("n")).alias("start"))
    shifted = (F.col("place") + F.col("upto") - F.col("n") - F.col("start")).alias("place")
    differing = join_group_stats(upto, start, ["id"]).select("id.grp", "id.doc_id", shifted, "size", "n", "leaf", "changed")
    return alike.unionByName(differing), groups.select("grp", "size")


def _spread(found: DataFrame) -> DataFrame:
    """One row per leaf. Equal rows are dealt in parts before they are written out one by one."""
    alone = found.where("n = 1").drop("n")
    many = found.where("n > 1").withColumn("first", F.explode(F.expr(f"sequence(0L, n - 1, {EXPLODE}L)")))
    many = many.repartition(F.col("grp"), F.col("place"), F.col("first"))
    many = many.withColumn("at", F.explode(F.expr(f"sequence(first, least(first + {EXPLODE}, n) - 1)")))
    return alone.unionByName(many.withColumn("place", F.col("place") + F.col("at")).drop("n", "first", "at"))


def _runs(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """Slot arrays: (grp, place, size, lone, slots, digest) of the parents of ``nodes``
    (grp, place, size, digest, *payload). A tree of one leaf is its own root: ``lone``."""
    slot = F.struct(F.pmod("place", F.lit(FANOUT)).alias("slot"), "digest", *payload)
    parent = F.expr(f"place div {FANOUT}")
    made = nodes.groupBy("grp", parent.alias("place")).agg(F.max("size").alias("was"), F.array_sort(F.collect_list(slot)).alias("slots"))
    joined = F.sha2(F.array_join(F.transform("slots", lambda s: s["digest"]), ""), 256)
    lone = F.col("was") == 1
    return made.select(
        "grp", "place", F.expr(f"(was + {FANOUT - 1}) div {FANOUT}").alias("size"), lone.alias("lone"), "slots",
        F.when(lone, F.col("slots")[0]["digest"]).otherwise(joined).alias("digest"),
    )


def _up(first: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The runs of all levels, from ``first`` up, of trees of at most ``most`` nodes."""
    levels, nodes = [first], -(-most // FANOUT)
    while nodes > 1:
        below = levels[-1].where("size > 1").select("grp", "place", "size", "digest")
        levels.append(materialise(_runs(below, []), name))
        nodes = -(-nodes // FANOUT)
    return levels


def _steps(runs: DataFrame, paths: DataFrame, payload: list[str]) -> DataFrame:
    """Each slot of ``runs`` with the path of its parent and its own step before it."""
    met = runs.join(paths.withColumnRenamed("path", "rest"), ["grp", "place"])
    digests = F.transform("slots", lambda s: s["digest"])
    side = lambda start, size: F.array_join(F.slice(digests, start, size), "")
    step = F.struct(
        side(F.lit(1), F.col("i")).alias("left"), side(F.col("i") + 2, F.greatest(F.size("slots") - F.col("i") - 1, F.lit(0))).alias("right")
    )
    others = [c for c in paths.columns if c not in ("grp", "place", "path")]
    kept = ["grp", "place", "lone", "slots", "rest", *others]
    each = met.select(*kept, F.posexplode("slots").alias("i", "s"))
    path = F.when(F.col("lone"), F.col("rest")).otherwise(F.concat(F.array(step), F.col("rest")))
    place = F.col("place") * FANOUT + F.col("s.slot")
    return each.select("grp", place.alias("place"), path.alias("path"), *others, "s.digest", *[f"s.{p}" for p in payload])


def _down(levels: list[DataFrame], tops: DataFrame, payload: list[str]) -> DataFrame:
    """The nodes under ``levels[0]`` with their paths. ``tops`` (grp, place, path, ...) has the path
    of each tree's root; a tree's root is the digest of a run of size one."""
    paths = None
    for k, runs in reversed(list(enumerate(levels))):
        ends = tops.join(runs.where("size = 1").select("grp", "place"), ["grp", "place"], "left_semi")
        paths = ends if paths is None else ends.unionByName(paths.select(*tops.columns))
        paths = _steps(runs, paths, payload if k == 0 else [])
    return paths


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` is the digest of all sibling digests on the way to the root, level by level.
    ``folded_root`` is what the leaf and these siblings give, after tampering where the test of a
    manifest tampers (see ``is_tampered``), and ``verified`` tells whether it is the root.
    """
    found, groups = ranked(docs)
    order = materialise(surrogate_key(groups, ["grp"]), "order")
    sizes = order.agg(F.max("size").alias("most"), F.count("*").alias("groups")).first()  # two numbers
    most, count = sizes["most"] or 0, sizes["groups"]

    payload = ["doc_id", "changed"]
    nodes = _spread(found).withColumnRenamed("leaf", "digest")
    levels = _up(materialise(_runs(nodes, payload), "runs"), most, "runs")
    done = [runs.where("size = 1").select("grp", "digest") for runs in levels]
    tops = done[0]
    for more in done[1:]:
        tops = tops.unionByName(more)
    # the groups form one tree above
    tops = materialise(tops.join(order.select("grp", (F.col("id") - 1).alias("place")), "grp"), "subroots")
    above = tops.select(F.lit("").alias("grp"), "place", F.lit(count).cast("bigint").alias("size"), "digest", F.col("grp").alias("of"))
    upper = _up(materialise(_runs(above, ["of"]), "upper"), count, "upper")
    none = F.expr("CAST(array() AS array<struct<left:string,right:string>>)")
    top = upper[-1].where("size = 1").select("grp", "place", none.alias("path"), F.col("digest").alias("root"))
    for_groups = _down(upper, top, ["of"]).select(
        F.col("of").alias("grp"), F.lit(0).cast("bigint").alias("place"), "path", "root", F.col("digest").alias("subroot")
    )
    paths = _down(levels, materialise(for_groups, "paths"), payload)

    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("path", F.col("changed"), lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))
    proved = paths.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root")
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
