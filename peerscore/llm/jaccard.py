"""N-gram Jaccard join by vertical partitioning (operator 8).

The global order of the shingles is their 64-bit hash. It is cut into fragments, and a document's
set into one segment per fragment:

* *Candidates.* Two sets that reach the threshold differ in about as many shingles as they have
  fragments at most (the threshold sets their number: 3 to 6 shingles a fragment at 85 percent, 2 to
  4 at 80), so some segment is the same in both. Documents that share a whole
  segment are tied to the segment's smallest document; connected ties form candidate groups. Sets
  under ``TINY`` shingles use the first shingles of the order (prefix filter) instead of segments,
  and sets under 32 fragments use them too if they have no more segments than can differ.
  In this step a set goes by a 64-bit hash of its digest, whatever the type of the ids: two sets of one hash would
  only be compared more.
* *Counts.* Only texts that may be in a group (a sieve of fixed size) are shuffled. In a group, the overlap of each pair is counted fragment by fragment and the partial
  counts are summed per pair. A group beyond ``BLOCK_DOCS`` documents or ``BLOCK_SHINGLES`` shingles
  is cut into blocks and every pair of blocks is a task of its own, which holds the documents of either that share a
  segment with one of the other. Only a spanning forest of the links leaves a task, with each document's number of links.

Equal sets are one node from the start. No pair of sets under 32 fragments (96 shingles at 85 percent,
68 at 80) is missed. Sets over 64 fragments are tied by 64 of them: a pair just at the threshold agrees
in each with probability above 0.3, so it is missed with probability below 1e-9; sets between use all
fragments, where only an agreement in nothing but (nearly) empty segments can hide a pair.

Nulls and odd rows: a NULL text, or one without words, has an empty set and links with nothing. Rows
with a NULL id get a NULL component and link with nothing. Rows that repeat an id are one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.common import arrow_rows, mix64, passes, range_hashes, saved, sieve
from peerscore.llm.components import components

BLOCK_DOCS = 1024
BLOCK_SHINGLES = 1_500_000
BIN_SHINGLES = 400_000
FRAGMENT = 4096
TINY = 32
MOST_SEGMENTS = 64
EXACT_LEVEL = 5
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def shingle_sets(texts: list[str | None], words: int = 4) -> list[np.ndarray]:
    """Each text's set of ``words``-word shingles as sorted 64-bit hashes (ASCII lower case, white space splits)."""
    split = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    flat = [w for s in split for w in s]
    out = [np.zeros(0, np.uint64)] * len(texts)
    if not flat:
        return out
    lengths = np.fromiter(map(len, flat), np.int64, len(flat))
    ends = np.cumsum(lengths)
    h = range_hashes(np.frombuffer(b"".join(flat), np.uint8), ends - lengths, ends)
    with np.errstate(over="ignore"):
        mult = [_STEP[k % 4] + np.uint64(2 * (k // 4)) for k in range(words)]
        n = len(h) - words + 1
        full = mix64(sum(h[k : k + n] * mult[k] for k in range(words))) if n > 0 else h[:0]
        at = 0
        for k, s in enumerate(split):
            if len(s) >= words:
                out[k] = np.unique(full[at : at + len(s) - words + 1])
            elif s:
                short = sum(h[at + j : at + j + 1] * mult[j] for j in range(len(s)))
                out[k] = mix64(short + np.uint64(len(s)))
            at += len(s)
    return out


def _level(n: int, percent: int) -> int:
    """log2 of the number of fragments of a set of ``n`` shingles: 3 to 6 shingles each at 85 percent, 2.1 to 4.2 at 80."""
    return max(0, (n * (100 - percent) * 17 // (9 * percent)).bit_length() - 1)


def _least(level: int, percent: int) -> int:
    """Shingles below which a segment ties nothing: of 3 or more at 85 percent, fewer where fragments hold fewer."""
    return 1 if level < EXACT_LEVEL else max(1, round((2 if level == EXACT_LEVEL else 3) * 3 * percent / (17 * (100 - percent))))


def signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of a set's segments (or, for a tiny set, of its prefix): links share at least one."""
    n = len(tokens)
    if not n:
        return tokens
    found = []
    largest = 100 * n // percent  # the largest partner
    differ = n * (100 - percent) // percent  # the most shingles that only one set of a linked pair holds
    prefix = n < TINY * 100 // percent
    with np.errstate(over="ignore"):
        if largest >= TINY:
            for level in {_level(max(n, TINY), percent), _level(largest, percent)}:
                fragment = tokens >> np.uint64(64 - level) if level else np.zeros(n, np.uint64)
                fragment = fragment[: np.searchsorted(fragment, MOST_SEGMENTS)]
                starts = np.flatnonzero(np.concatenate(([True], fragment[1:] != fragment[:-1]))) if len(fragment) else fragment
                # no more segments than can differ: an equal one may be empty
                prefix |= level < EXACT_LEVEL and len(starts) <= differ
                if not len(starts):
                    continue
                size = np.diff(np.append(starts, len(fragment)))
                whole = np.add.reduceat(mix64(tokens[: len(fragment)]), starts)
                sig = mix64(whole + size.astype(np.uint64) * _STEP[1] + np.uint64(level) * _STEP[2])
                found.append(sig[size >= _least(level, percent)])
        if prefix:
            keep = n - -(-percent * n // 100) + 1
            found.append(mix64(tokens[:keep] + np.uint64(1)))
    return np.unique(np.concatenate(found)) if found else tokens[:0]


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _overlaps(sets_a: list[np.ndarray], sets_b: list[np.ndarray] | None) -> np.ndarray:
    """Overlap of every pair of rows: partial counts of each fragment of the order, summed."""
    sets = sets_a + (sets_b or [])
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    some = shared[column]
    row, column = row[some], place[column[some]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    a, b = len(sets_a), len(sets_b) if sets_b is not None else len(sets_a)
    total = np.zeros((a, b), np.float32)
    for first in range(0, int(shared.sum()), FRAGMENT):
        lo, hi = np.searchsorted(column, (first, first + FRAGMENT))
        part = np.zeros((len(sets), int(column[hi - 1]) - first + 1), np.float32)
        part[row[lo:hi], column[lo:hi] - first] = 1
        total += part[:a] @ (part[a:] if sets_b is not None else part).T
    return total


def _forest(linked: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest node each row (ids ``a``) and column (ids ``b``) reaches through ``linked``."""
    big = np.iinfo(np.int64).max
    la, lb = a.copy(), b.copy()
    while True:
        na = np.minimum(la, np.where(linked, lb[None, :], big).min(axis=1, initial=big))
        nb = np.minimum(lb, np.where(linked, na[:, None], big).min(axis=0, initial=big))
        if (na == la).all() and (nb == lb).all():
            return na, nb
        la, lb = na, nb


def _link(part: pd.DataFrame, sides: tuple[int, int], percent: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (node, smallest node reached here, weighted number of links here) of one pair of blocks."""
    part = part.drop_duplicates(["node", "tokens"])
    sets = [np.frombuffer(t, np.uint64) for t in part["tokens"]]
    side, node = part["side"].to_numpy(), part["node"].to_numpy()
    weight, n = part["weight"].to_numpy().astype(np.float64), part["n"].to_numpy().astype(np.float64)
    names, node = np.unique(node, return_inverse=True)  # numbers in the ids' order, whatever their type
    at_a = np.flatnonzero(side == sides[0])
    at_b = at_a if sides[0] == sides[1] else np.flatnonzero(side == sides[1])
    if not len(at_a) or not len(at_b):
        return []
    pick = lambda at: [sets[k] for k in at]
    common = _overlaps(pick(at_a), None if at_a is at_b else pick(at_b)).astype(np.float64)
    linked = (100 * common >= percent * (n[at_a][:, None] + n[at_b][None, :] - common)) & (node[at_a][:, None] != node[at_b][None, :])
    root_a, root_b = _forest(linked, node[at_a], node[at_b])
    out = [(names[node[at_a]], names[root_a], linked @ weight[at_b])]
    return out if at_a is at_b else [*out, (names[node[at_b]], names[root_b], weight[at_a] @ linked)]


def _blocks(tied: DataFrame, large: DataFrame) -> DataFrame:
    """Rows (set, side, others) of the sets of ``large`` groups: a set's block and the blocks that it has to be compared with.

    Sets that share the most common of their segments lie together. A set is compared with the blocks that hold one of its
    segments, its own among them: so a link's two sets meet, once, and a group held together by few segments a set
    costs in proportion to its sets instead of to their pairs.
    """
    near = saved(tied.select("set", "sig").join(large, "set"))
    common = near.join(near.groupBy("sig").agg(F.count("*").alias("sets")), "sig")
    family = common.groupBy("set", "blocks").agg(F.max(F.struct("sets", "sig")).alias("top"))
    sizes = family.groupBy("top.sig").agg(F.ceil(F.count("*") / BLOCK_DOCS).alias("parts"))
    family = family.select("set", "blocks", F.col("top.sig").alias("sig")).join(sizes, "sig")
    part = F.pmod(F.xxhash64("set"), F.col("parts"))
    home = saved(family.select("set", F.pmod(F.xxhash64("sig", part), F.col("blocks")).cast("int").alias("side")))
    held = near.join(home, "set").select("sig", F.col("side").alias("other")).distinct()
    visits = near.select("set", "sig").join(held, "sig").groupBy("set").agg(F.collect_set("other").alias("others"))
    return saved(home.join(visits, "set"))


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: ``node`` (the id), ``n_shingles``, ``component`` and ``n_links``.

    Two documents link when ``100 * intersection >= percent * union`` of their shingle sets.
    """
    docs = docs.select(F.col(id_col).alias("node"), F.col(text_col).alias("text"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 64):
            sets = shingle_sets(b.column("text").to_pylist(), words)
            digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            sigs = [_signed(signatures(s, percent)) for s in sets]
            arrays = [b.column("node"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(sigs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "n", "digest", "sigs"])

    id_type = docs.schema["node"].dataType.simpleString()
    base = saved(docs.mapInArrow(describe, f"node {id_type}, n long, digest binary, sigs array<long>"))
    keyed = base.where("digest is not null and node is not null")
    classes = saved(keyed.groupBy("digest").agg(F.min("node").alias("node"), F.count_distinct("node").alias("weight")))
    reps = saved(keyed.join(classes, ["digest", "node"]).dropDuplicates(["digest", "node"]).select("digest", "node", "n", "weight", "sigs"))

    ties = reps.select(F.xxhash64("digest").alias("set"), F.explode("sigs").alias("sig"))
    hubs = saved(ties.groupBy("sig").agg(F.min("set").alias("hub"), F.max("set").alias("other")).where("hub <> other").select("sig", "hub"))
    tied = saved(ties.join(hubs, "sig").select("set", "sig", "hub"))
    groups = components(tied.select(F.col("set").alias("u"), F.col("hub").alias("v")))
    grouped = groups.select(F.col("u").alias("set"), F.col("v").alias("comp")).unionByName(groups.select(F.col("v").alias("set"), F.col("v").alias("comp")).distinct())
    members = saved(reps.select(F.xxhash64("digest").alias("set"), "node", "n", "weight").join(grouped, "set"))
    sizes = members.groupBy("comp").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_DOCS), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    sizes = saved(sizes.select("comp", blocks.alias("blocks"), "total"))
    small = sizes.where("blocks = 1").agg(F.sum("total")).first()[0] or 0
    bins = 1 + small // BIN_SHINGLES
    members = members.drop("n").join(sizes.drop("total"), "comp")
    members = members.join(_blocks(tied, members.where("blocks > 1").select("set", "blocks").distinct()), "set", "left")
    members = members.withColumns({"side": F.coalesce("side", F.lit(0)), "others": F.coalesce("others", F.array(F.lit(0)))})

    kept = ["node", "comp", "weight", "blocks", "side", "others"]

    def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow_rows(batches, 64):
            sets = shingle_sets(b.column("text").to_pylist(), words)
            arrays = [b.column(c) for c in kept]
            arrays += [pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "n", "tokens"])

    some = passes(docs, "node", sieve(members, "node"), "some").where("some")
    sets = some.join(members.dropDuplicates(["node"]), "node").select(*kept, "text")
    sets = sets.mapInArrow(set_rows, f"node {id_type}, comp long, weight long, blocks int, side int, others array<int>, n long, tokens binary").where("n > 0")
    spread = sets.withColumn("other", F.explode("others"))
    spread = spread.withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other"))
    key = F.when(F.col("blocks") > 1, F.xxhash64("comp")).otherwise(F.pmod(F.xxhash64("comp", F.lit("bin")), F.lit(bins)))

    def count_pairs(part: pd.DataFrame) -> pd.DataFrame:
        found = [x for _, g in part.groupby("comp", sort=False) for x in _link(g, (int(g["i"].iloc[0]), int(g["j"].iloc[0])), percent)]
        cols = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3
        return pd.DataFrame({"node": cols[0], "root": cols[1], "links": cols[2].astype(np.int64)})

    linked = spread.withColumn("key", key).groupBy("key", "blocks", "i", "j").applyInPandas(count_pairs, f"node {id_type}, root {id_type}, links long")
    linked = saved(linked.where("links > 0 or node <> root"))
    joined = components(linked.select(F.col("node").alias("u"), F.col("root").alias("v")))
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    info = classes.join(joined.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").join(links, "node", "left")
    several = "weight > 1 or component is not null or links is not null"
    info = saved(info.where(several).select("digest", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    own = F.when(F.col("node").isNotNull(), F.coalesce("component", "node"))
    out = base.select("node", "n", "digest").join(info, "digest", "left")
    return out.select("node", F.col("n").alias("n_shingles"), own.alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
