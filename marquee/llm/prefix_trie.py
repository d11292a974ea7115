"""Prefix trie of conversations by the Euler-tour technique (operator 13).

Every distinct sequence of the first d turns of a conversation is a node.  A
sequence is known by two 64-bit hashes, running exclusive ors of the hashes
of (position, role, text); a node is then named by its smallest member and
its depth, and numbered in that order.

The tour of the trie has an enter and an exit arc per node, and each arc's
next one is known from the node's first child, next sibling and parent.  The
list of arcs is ranked in three steps: blocks of consecutive nodes contract
the stretches of the tour that lie within them; stretches are then joined by
random mate (a stretch whose coin shows heads takes in its next one if that
shows tails) until one task can hold them; what was taken in gets its place
from what took it in, in reverse.  Ranking sums up three values per arc: one
(its position in the tour), whether it enters a leaf, and the savings of the
node that it enters.  The differences of these prefix sums between a node's
exit and enter arcs are its subtree's leaves and savings.

Conversations of any number of turns, and nodes with any number of children
or members, are spread over tasks; only the SHA-256 of a node's members is
by its nature computed one after another, from chunks read in order.

Defined results: rows with a null conversation id take no part; null roles
and texts are empty; turns are ordered by number, null first, turns of one
number by a hash of role and text; repeated rows are turns of their own; no
rows, no output.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stored, words
from marquee.llm.scan import running

BLOCK = 2048              # nodes whose arcs one call contracts
ONE_TASK = 200_000        # stretches that the last step ranks in one task
VALUES = ("n", "leaf", "saved")


def numbered_turns(convs: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv, pos, t1, t2, words) of every turn; ``pos`` counts from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = convs.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), role, text).alias("t2"), F.size(words(text)).cast("long").alias("words"), F.lit(1).cast("long").alias("one"))
    return running(rows, ["conv"], ["turn", "t1", "t2"], "trie-turns", sums={"pos": "one"}).select("conv", "pos", "t1", "t2", "words")


def shared_head(conv: Column) -> Column:
    """Turns that a rebuilt conversation takes from the head of its group."""
    return (F.crc32(conv.cast("string")) % 4).cast("long")


def rebuilt(turns: DataFrame, group: int = 20) -> DataFrame:
    """Numbered turns of the rebuilt conversations, ``depth`` from 1, and one
    row of depth 0 per conversation; ``end``: the conversation ends there."""
    head = turns.filter((F.col("conv") % group == 0) & (F.col("pos") <= 3)) \
        .select(F.col("conv").alias("from"), F.col("pos").alias("depth"), "t1", "t2", "words")
    head = stored(head, "trie-heads")
    convs = turns.groupBy("conv").agg(F.count("*").alias("own")).withColumn("h", shared_head(F.col("conv"))) \
        .withColumn("from", F.col("conv") - F.col("conv") % group)
    known = head.groupBy("from").agg(F.count("*").alias("known"))
    convs = convs.join(known, "from", "left").withColumn("m", F.least("h", F.coalesce("known", F.lit(0)))) \
        .withColumn("length", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv", "from", "h", "m", "length"), "trie-convs")
    end = F.col("depth") == F.col("length")
    of = ["conv", "depth", "t1", "t2", "words"]
    own = turns.filter(F.col("pos") > shared_head(F.col("conv"))).join(convs, "conv") \
        .withColumn("depth", F.col("pos") - F.col("h") + F.col("m")).select(*of, end.alias("end"))
    taken = head.join(convs, "from").filter(F.col("depth") <= F.col("h")).select(*of, end.alias("end"))
    zero = F.lit(0).cast("long")
    top = convs.select("conv", zero.alias("depth"), zero.alias("t1"), zero.alias("t2"), zero.alias("words"), (F.col("length") == 0).alias("end"))
    return own.unionByName(taken).unionByName(top)


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv, depth, h1, h2, p1, p2, words, end): each prefix and its
    parent's by hash."""
    for i in ("1", "2"):
        hashed = F.xxhash64(F.lit(int(i)), F.col("depth"), F.col(f"t{i}"))
        rows = rows.withColumn(f"e{i}", F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(hashed))
    rows = running(rows.drop("t1", "t2"), ["conv"], ["depth"], "trie-prefixes", xors={"h1": "e1", "h2": "e2"})
    return rows.select("conv", "depth", "h1", "h2", F.col("h1").bitwiseXOR(F.col("e1")).alias("p1"),
                       F.col("h2").bitwiseXOR(F.col("e2")).alias("p2"), "words", "end")


def trie_nodes(rows: DataFrame) -> DataFrame:
    """One row per node, numbered (``nid``, from 1) by smallest member and
    depth, with ``parent`` (0: none), ``next`` sibling, ``child`` (the first)
    and ``n_children``."""
    nodes = rows.groupBy("depth", "h1", "h2").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.max("words").alias("words")).withColumn("one", F.lit(1).cast("long"))
    nodes = stored(running(nodes, [], ["conv_id", "depth"], "trie-nodes", sums={"nid": "one"}).drop("one"), "trie-numbered")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"),
                         F.col("nid").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    up = nodes.join(above, ["depth", "p1", "p2"], "left").withColumn("parent", F.coalesce("parent", F.lit(0).cast("long")))
    up = up.drop("p1", "p2").withColumn("back", -F.col("nid"))
    up = running(up, ["parent"], ["back"], "trie-siblings", before={"next": "nid"}).drop("back")
    kids = up.filter("parent > 0").groupBy(F.col("parent").alias("nid")).agg(F.min("nid").alias("child"), F.count("*").alias("n_children"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return up.join(kids, "nid", "left").select("nid", "depth", "h1", "h2", "conv_id", "parent_conv_id", "n_convs", "words", "parent",
                                               zero("next"), zero("child"), zero("n_children"))


# ------------------------------------------------------------ list ranking

def _ranked(succ: np.ndarray, value: np.ndarray):
    """Heads, and prefix sums (this one included) from them, of lists given
    by the next place (-1: none).  By pointer jumping over the places before."""
    n = len(succ)
    ptr = np.full(n, -1)
    has = succ >= 0
    ptr[succ[has]] = np.flatnonzero(has)
    top, total = np.arange(n), value.copy()
    while (live := np.flatnonzero(ptr >= 0)).size:
        up = ptr[live]
        more, over, onto = total[up], top[up], ptr[up]
        total[live] += more
        top[live] = over
        ptr[live] = onto
    return top, total


def _contract(pdf: pd.DataFrame) -> pd.DataFrame:
    """Arcs of one block of nodes: 2 nid enters, 2 nid + 1 leaves.  ``head``
    is the first arc of the stretch within the block, the values its prefix
    sums up to the arc, ``next`` the arc after a stretch's last one (0: the
    tour ends; null elsewhere)."""
    pdf = pdf.sort_values("nid")
    nid, child, sibling, parent = (pdf[c].to_numpy() for c in ("nid", "child", "next", "parent"))
    arc = np.stack([2 * nid, 2 * nid + 1], axis=1).ravel()
    succ = np.stack([np.where(child > 0, 2 * child, 2 * nid + 1),
                     np.where(sibling > 0, 2 * sibling, np.where(parent > 0, 2 * parent + 1, 0))], axis=1).ravel()
    value = np.zeros((len(arc), 3), np.int64)
    value[:, 0] = 1
    value[::2, 1] = child == 0
    value[::2, 2] = pdf["gain"].to_numpy()
    at = np.minimum(np.searchsorted(arc, succ), len(arc) - 1)
    inside = arc[at] == succ
    top, total = _ranked(np.where(inside, at, -1), value)
    after = pd.array(succ, "Int64")
    after[inside] = pd.NA
    return pd.DataFrame({"arc": arc, "head": arc[top], "n": total[:, 0], "leaf": total[:, 1], "saved": total[:, 2], "next": after})


def _in_one_task(pdfs):
    pdfs = [p for p in pdfs if len(p)]
    if not pdfs:
        return
    pdf = pd.concat(pdfs, ignore_index=True).sort_values("id")
    ids, succ = pdf["id"].to_numpy(), pdf["next"].to_numpy()
    at = np.minimum(np.searchsorted(ids, succ), max(len(ids) - 1, 0))
    value = pdf[list(VALUES)].to_numpy()
    _, total = _ranked(np.where(ids[at] == succ, at, -1), value)
    yield pd.DataFrame({"id": ids} | {c: (total - value)[:, i] for i, c in enumerate(VALUES)})


def rank_list(items: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(id, n, leaf, saved): for each item of a linked list (id, next with 0
    for none, values) the sums over all items before it.  Every id but the
    first is the next of one other."""
    items, taken, k = stored(items, "tour-items"), [], 0
    while items.count() > one_task:
        k += 1
        heads = lambda c: F.xxhash64(F.lit(k), c).bitwiseAND(F.lit(1)) == 1  # noqa: B023,E731
        mates = items.filter((F.col("next") > 0) & heads(F.col("id")) & ~heads(F.col("next"))).select(
            F.col("id").alias("into"), F.col("next").alias("id"), *[F.col(c).alias(f"off_{c}") for c in VALUES]) \
            .join(items.select("id", F.col("next").alias("then"), *VALUES), "id")
        mates = stored(mates, "tour-mates")
        taken.append(mates.select("id", "into", *[f"off_{c}" for c in VALUES]))
        grown = mates.select(F.col("into").alias("id"), "then", *[F.col(c).alias(f"add_{c}") for c in VALUES])
        items = items.join(mates.select("id"), "id", "left_anti").join(grown, "id", "left").select(
            "id", F.coalesce("then", "next").alias("next"), *[(F.col(c) + F.coalesce(f"add_{c}", F.lit(0))).alias(c) for c in VALUES])
        items = stored(items, "tour-items")
    kind = "id long, " + ", ".join(f"{c} long" for c in VALUES)
    out = stored(items.coalesce(1).mapInPandas(_in_one_task, kind), "tour-offsets")
    for mates in reversed(taken):
        placed = mates.join(out.withColumnRenamed("id", "into"), "into").select("id", *[(F.col(c) + F.col(f"off_{c}")).alias(c) for c in VALUES])
        out = stored(out.unionByName(placed), "tour-offsets")
    return out


def subtree_sums(nodes: DataFrame, block: int = BLOCK, one_task: int = ONE_TASK) -> DataFrame:
    """(nid, enter, leave, leaves_below, saved_below): positions of the two
    arcs in the tour, and sums over the subtree without its top."""
    narrow = nodes.select("nid", "child", "next", "parent", ((F.col("n_convs") - 1) * F.col("words")).alias("gain"))
    arcs = narrow.groupBy(F.floor(F.col("nid") / block).alias("block")).applyInPandas(
        _contract, "arc long, head long, n long, leaf long, saved long, next long")
    arcs = stored(arcs, "tour-arcs")
    offsets = rank_list(arcs.filter("next is not null").select(F.col("head").alias("id"), "next", *VALUES), one_task)
    at = offsets.select(F.col("id").alias("head"), *[F.col(c).alias(f"off_{c}") for c in VALUES])
    placed = arcs.join(at, "head").select(F.shiftright("arc", 1).alias("nid"), (F.col("arc") % 2 == 1).alias("leaves"),
                                          *[(F.col(c) + F.col(f"off_{c}")).alias(c) for c in VALUES])
    sign = F.when(F.col("leaves"), 1).otherwise(-1)
    return placed.groupBy("nid").agg(
        F.max(F.when(~F.col("leaves"), F.col("n"))).alias("enter"), F.max(F.when(F.col("leaves"), F.col("n"))).alias("leave"),
        F.sum(sign * F.col("leaf")).alias("leaves_below"), F.sum(sign * F.col("saved")).alias("saved_below"))


# ----------------------------------------------------- digests of members

def member_digests(ends: DataFrame, key: list[str], col: str) -> DataFrame:
    """(key, digest): SHA-256 of the numbers of each key, ascending, comma
    joined.  Chunks of neighbours are built where the numbers lie sorted; a
    key's chunks are then hashed in order, a batch of them at a time."""
    def chunks(batches):
        for pdf in batches:
            if len(pdf):
                new = (pdf[key] != pdf[key].shift()).any(axis=1).to_numpy()
                begin = np.flatnonzero(new)
                stop = np.append(begin[1:], len(pdf))
                text = pdf[col].astype(str).tolist()
                out = pdf[[*key, col]].iloc[begin].copy()
                out["ids"] = [",".join(text[a:b]) for a, b in zip(begin, stop)]
                yield out

    def digests(batches):
        at, state = None, None
        for pdf in batches:
            done = []
            for *k, text in pdf[[*key, "ids"]].itertuples(index=False, name=None):
                if k != at:
                    if at is not None:
                        done.append([*at, state.hexdigest()])
                    at, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pd.DataFrame(done, columns=[*key, "digest"])
        if at is not None:
            yield pd.DataFrame([[*at, state.hexdigest()]], columns=[*key, "digest"])

    kind = ", ".join(f"{k} long" for k in key)
    parts = ends.select(*key, col).repartitionByRange(*key, col).sortWithinPartitions(*key, col).mapInPandas(chunks, f"{kind}, {col} long, ids string")
    return parts.repartition(*key).sortWithinPartitions(*key, col).mapInPandas(digests, f"{kind}, digest string")


def prefix_trie(rows: DataFrame, block: int = BLOCK, one_task: int = ONE_TASK) -> DataFrame:
    """The trie of conversations given as ``rebuilt`` gives them: per node
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, enter and leave (its places in the tour)."""
    rows = stored(prefixes(rows), "trie-rows")
    nodes = stored(trie_nodes(rows), "trie")
    sums = subtree_sums(nodes, block, one_task)
    key = ["depth", "h1", "h2"]
    digests = member_digests(rows.filter("end"), key, "conv")
    own = (F.col("n_convs") - 1) * F.col("words")
    return nodes.join(sums, "nid").join(digests, key, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaves_below") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
        (F.col("saved_below") + own).alias("saved_tokens"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "enter", "leave")
