"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct shingles (``n`` lower-cased words).
Every shingle flips one bit of a long bit sketch (kept sparse, as the flipped
bits), so the Hamming distance of two sketches is at most the symmetric
difference of the sets.  At similarity t a document of n shingles differs from
any partner in at most ``d = n * (1/t - 1)`` shingles, so of the blocks that
a sketch is cut into, at most ``d`` differ: any ``d + 1`` non-empty blocks of
one document hold one that its partner has bit for bit (pigeonhole).  All documents
choose theirs in one order, so that partners choose a common one: blocks whose
rarest shingle is rare first, which keeps passages shared by many documents
out of the join.  The number of blocks belongs to a size band (sizes from 2**j
to 2**(j+1)); a document whose smaller partners may lie in the band below
takes part there as well.

Block values are joined by hash, and documents with equal sets are one class
from the start.  A group of classes with one value is compared on dense parity
sketches (as many bits as shingles, or up to twice that): a pair survives when
their Hamming distance allows the similarity.  First every member is verified,
exactly, on the shingle sets, against its nearest survivors before and after
it in the group only; then the survivors that still lie in different components are.  So
no link between components is lost, none inside one is spent, and a group is
never expanded into its pairs.  Groups with the same members are compared
once; a group of over ``GROUP`` members is compared in cells of two parts.

Defined cases: texts with fewer than n words have their whole word sequence as
one shingle; null and empty texts have none, and are linked with nothing;
repeated rows are linked; a null doc_id never names a component unless all its
members lack one; an empty table gives an empty result; extra columns are
ignored.  Shingles and classes are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bitmap, materialize, text_slices, tidy, word_table
from .components import connected_components

HEAVY = 1 << 18   # shingles whose frequency is known
CELLS = 1 << 24   # bits of the bitmap of classes to be verified
GROUP = 2048      # members of a group that one task compares with as many
CELL = 1 << 17    # pairs that a task compares at once
_P = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(32))


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    starts, index, words = word_table(texts)
    codes = np.fromiter((xxhash.xxh64_intdigest(w.lower()) for w in words.cast(pa.large_binary()).to_pylist()),
                        np.uint64, len(words))[index]
    rolled = np.zeros(max(0, len(codes) - n + 1), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            rolled = rolled * _P + codes[j:j + len(rolled)]
    rolled = mix(rolled)
    out = []
    for a, z in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if z - a >= n:
            out.append(np.unique(rolled[a:z - n + 1]))
        elif z > a:
            whole = np.uint64(z - a)
            with np.errstate(over="ignore"):
                for c in codes[a:z]:
                    whole = whole * _P + c
            out.append(mix(np.array([whole ^ np.uint64(0xA5A5A5A5)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def classes_of(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each set."""
    a = [mix(s + np.uint64(1)).sum(dtype=np.uint64) ^ np.uint64(len(s)) for s in sets]
    b = [np.bitwise_xor.reduce(mix(s ^ _P)) if len(s) else np.uint64(0) for s in sets]
    return mix(np.array(a, np.uint64)).view(np.int64), np.array(b, np.uint64).view(np.int64)


def band_of(n: int) -> int:
    return n.bit_length() - 1


def parity_sketch(s: np.ndarray) -> bytes:
    """The set's dense sketch, of 2 ** (band + 1) bits and at least 64."""
    bits = max(64, 2 << band_of(len(s)))
    flips = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").tobytes()


_SETS = "doc_id long, mark long, n int, cls long, check long, sketch binary, shingle long, times long"


def _describe(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """A row (doc_id, mark, n, cls, check, sketch) for each document, and a row (shingle,
    times) for each shingle that a slice of documents holds more than once."""
    for b in tidy(batches):
        for part in text_slices(b, 2):
            sets = shingle_sets(part.column(2), n)
            cls, check = classes_of(sets)
            _, first = np.unique(cls, return_index=True)
            one = [sets[i] for i in first]
            shingle, times = np.unique(np.concatenate(one), return_counts=True)
            shingle, times = shingle[times > 1].view(np.int64), times[times > 1]
            k, m = len(sets), len(shingle)
            null = lambda t, size: pa.nulls(size, t)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([part.column(0), null(pa.int64(), m)]),
                pa.concat_arrays([part.column(1), null(pa.int64(), m)]),
                pa.concat_arrays([pa.array([len(s) for s in sets], pa.int32()), null(pa.int32(), m)]),
                pa.concat_arrays([pa.array(cls), null(pa.int64(), m)]),
                pa.concat_arrays([pa.array(check), null(pa.int64(), m)]),
                pa.concat_arrays([pa.array([parity_sketch(s) if len(s) else None for s in sets],
                                           pa.binary()), null(pa.binary(), m)]),
                pa.concat_arrays([null(pa.int64(), k), pa.array(shingle)]),
                pa.concat_arrays([null(pa.int64(), k), pa.array(times.astype(np.int64))]),
            ], names=["doc_id", "mark", "n", "cls", "check", "sketch", "shingle", "times"])


def block_bits(band: int) -> int:
    """log2 of a band's number of blocks.  Small sets get so many blocks that
    fewer than d + 1 filled ones would need a hash collision."""
    return band + 2 if band >= 6 else 16


def block_keys(s: np.ndarray, freq: np.ndarray, band: int, choose: int) -> np.ndarray:
    """The ``choose`` first blocks of the sketch, as hashes of (band, block,
    bits flipped in it)."""
    block = s >> np.uint64(64 - block_bits(band))
    start = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    bits = np.bitwise_xor.reduceat(mix(s), start)
    key = mix(bits ^ mix(block[start] * np.uint64(64) + np.uint64(band)))
    if len(key) <= choose:
        return key
    return key[np.lexsort((key, np.minimum.reduceat(freq, start)))[:choose]]


def _sketch(batches: Iterator[pa.RecordBatch], n: int, t: tuple[int, int], heavy: np.ndarray,
            times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, cls): the chosen blocks of every document, once a class and task."""
    num, den = t
    done: set[int] = set()
    for b in tidy(batches):
        for part in text_slices(b, 0):
            sets = shingle_sets(part.column(0), n)
            cls, _ = classes_of(sets)
            keys, owners = [], []
            for i in np.unique(cls, return_index=True)[1]:
                s = sets[i]
                size = len(s)
                if not size or int(cls[i]) in done:
                    continue
                done.add(int(cls[i]))
                at = np.searchsorted(heavy, s)
                at[at == len(heavy)] = 0
                freq = np.where(heavy[at] == s, times[at], 1) if len(heavy) else np.ones(size, np.int64)
                band = band_of(size)
                found = [block_keys(s, freq, band, size * (den - num) // num + 1)]
                least = -(-size * num // den)
                if band_of(least) < band:  # partners of 2**band - 1 shingles at most
                    apart = ((1 << band) - 1 + size) * (den - num) // (den + num)
                    found.append(block_keys(s, freq, band - 1, apart + 1))
                found = np.concatenate(found)
                keys.append(found)
                owners.append(np.full(len(found), cls[i]))
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))],
                    names=["key", "cls"])


def _sets(batches: Iterator[pa.RecordBatch], n: int, cells: bytes) -> Iterator[pa.RecordBatch]:
    """(cls, shingles) of the classes in the bitmap ``cells``, once a slice."""
    marked = np.unpackbits(np.frombuffer(cells, np.uint8), bitorder="little")
    for b in tidy(batches):
        for part in text_slices(b, 0):
            sets = shingle_sets(part.column(0), n)
            cls, _ = classes_of(sets)
            first = np.unique(cls, return_index=True)[1]
            first = [i for i in first[marked[cls[first] & (CELLS - 1)] > 0] if len(sets[i])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cls[first]), pa.array([sets[i].tobytes() for i in first], pa.binary())],
                names=["cls", "shingles"])


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches of fewer bits, from longer ones."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def _pairs_of(cuts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) in pieces of about ``CELL``: the pairs j < i inside each group
    of ``most`` members or fewer; ``cuts`` are the groups' bounds."""
    size = np.diff(cuts)
    few = (size > 1) & (size <= most)
    rows = np.repeat(cuts[:-1][few], size[few])
    place = np.arange(len(rows)) - np.repeat(np.cumsum(size[few]) - size[few], size[few])
    piece = np.cumsum(place) // CELL
    for at in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(piece)) + 1):
        start, before = rows[at], place[at]
        j = np.arange(before.sum()) - np.repeat(np.cumsum(before) - before, before)
        yield np.repeat(start + before, before), j + np.repeat(start, before)


def _blocks_of(cuts: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) as a column and a row of a matrix of about ``CELL`` cells: the
    members of the groups of more than ``most``."""
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if z - a > most:
            step = max(1, CELL // (z - a))
            for k in range(a, z, step):
                last = min(z, k + step)
                yield np.arange(k, last)[:, None], np.arange(a, last)[None, :]


def survivors(rows: pa.Table, cuts: np.ndarray, t: tuple[int, int], most: int = 64
              ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, distance) in pieces: the pairs j < i of different roots (and of
    different parts, where a cell has two) in each group of rows whose sizes
    and sketches allow the similarity."""
    num, den = t
    n = rows.column("n").to_numpy().astype(np.int64)
    part, root, one, two = (rows.column(x).to_numpy() for x in ("part", "root", "one", "two"))
    cell = np.where(one == two, np.arange(len(n)), part)  # differs from its partner's, if they may pair
    sketch = rows.column("sketch").combine_chunks()
    words = np.asarray(pc.binary_length(sketch)).astype(np.int64) // 8
    slot, packed = np.zeros(len(n), np.int64), {}
    for w in np.unique(words).tolist():
        mine = np.flatnonzero(words == w)
        slot[mine] = np.arange(len(mine))
        packed[w] = np.frombuffer(b"".join(sketch.take(pa.array(mine)).to_pylist()), np.uint64).reshape(-1, w)
    for i, j in chain(_pairs_of(cuts, most), _blocks_of(cuts, most)):
        a, b = n[i], n[j]
        ok = ((den * np.minimum(a, b) >= num * np.maximum(a, b)) & (root[i] != root[j])
              & (cell[i] != cell[j]) & (j < i))
        if ok.ndim == 2:
            x, y = np.nonzero(ok)
            i, j = x + i[0, 0], y + j[0, 0]
        else:
            i, j = i[ok], j[ok]
        kind = words[i] * (1 << 32) + words[j]
        for k in np.unique(kind).tolist():
            w, v = k >> 32, k & 0xFFFFFFFF
            x, narrow = np.flatnonzero(kind == k), min(w, v)
            left, right = _folded(packed[w], narrow), _folded(packed[v], narrow)
            for x in np.array_split(x, len(x) * narrow // CELL + 1):
                far = np.bitwise_count(left[slot[i[x]]] ^ right[slot[j[x]]]).sum(axis=1, dtype=np.int64)
                x, far = (z[far * (den + num) <= (n[i[x]] + n[j[x]]) * (den - num)] for z in (x, far))
                yield i[x], j[x], far


def _compare(batches: Iterator[pa.RecordBatch], t: tuple[int, int], nearest: bool
             ) -> Iterator[pa.RecordBatch]:
    """(a, b) of the surviving pairs of each group, rows sorted by (key, one,
    two, cls); ``nearest``: of each member only the nearest survivors before
    and after it, so that every member with a survivor is in some pair."""

    def pairs(rows: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if rows.num_rows < 2:
            return
        cls = rows.column("cls").to_numpy()
        none = np.iinfo(np.int64).max
        best = np.full((2, len(cls)), none)  # distance and row of the nearest
        for i, j, far in survivors(rows, cuts, t):
            if nearest:
                np.minimum.at(best[0], i, far << 32 | j)
                np.minimum.at(best[1], j, far << 32 | i)
            else:
                yield pa.RecordBatch.from_arrays([pa.array(cls[j]), pa.array(cls[i])], names=["a", "b"])
        for other in best:
            x = np.flatnonzero(other < none)
            y = other[x] & 0xFFFFFFFF
            yield pa.RecordBatch.from_arrays([pa.array(cls[np.minimum(x, y)]), pa.array(cls[np.maximum(x, y)])],
                                             names=["a", "b"])

    held = None
    for b in tidy(batches):
        rows = pa.Table.from_batches([b]) if held is None else pa.concat_tables(
            [held, pa.Table.from_batches([b])])
        if not rows.num_rows:
            continue
        at = np.stack([rows.column(x).to_numpy() for x in ("key", "one", "two")])
        cuts = np.concatenate(([0], np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1))
        yield from pairs(rows.slice(0, cuts[-1]), cuts)
        held = rows.slice(cuts[-1])
    if held is not None:
        yield from pairs(held, np.array([0, held.num_rows]))


def _verify(batches: Iterator[pa.RecordBatch], t: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    num, den = t
    for b in tidy(batches):
        keep = []
        for x, y in zip(b.column(2), b.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(y) < len(x):
                x, y = y, x
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            both = int((y[at] == x).sum())
            keep.append(den * both >= num * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(
            pa.array(keep, pa.bool_()))


def similar_documents(docs: DataFrame, n: int = 5, similarity: tuple[int, int] = (80, 100)
                      ) -> DataFrame:
    """(doc_id, n_shingles, component_id, mark, component) of ``docs`` (doc_id,
    text): documents are linked at a Jaccard similarity of ``similarity`` (a
    fraction) or more; ``component_id`` is the smallest doc_id reached by links.
    ``mark`` is a hash of the text and ``component`` a name of the component
    (null without words); they tell rows that share a doc_id apart."""
    num, den = similarity
    text = docs.select("text")
    marked = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    described = materialize(marked.mapInArrow(
        lambda it: _describe(it, n), _SETS), "jaccard-classes")
    classes = described.filter("n > 0").groupBy("cls", "check", "n").agg(F.min("doc_id").alias("first"))
    top = (described.filter("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("times"))
           .orderBy(F.desc("times"), "shingle").limit(HEAVY).toArrow())
    heavy, times = top["shingle"].to_numpy().view(np.uint64), top["times"].to_numpy()
    order = np.argsort(heavy)
    heavy, times = heavy[order], times[order]

    keys = text.mapInArrow(lambda it: _sketch(it, n, similarity, heavy, times), "key long, cls long")
    alike = Window.partitionBy("key")
    shared = materialize(
        keys.withColumn("_first", F.min("cls").over(alike)).withColumn("_last", F.max("cls").over(alike))
        .filter("_first != _last").select("key", "cls").distinct().select(
            "key", "cls", F.count(F.lit(1)).over(alike).alias("size"),
            F.bit_xor(F.xxhash64("cls")).over(alike).alias("_x"),
            F.sum(F.xxhash64(F.lit(1), F.col("cls")).bitwiseAND(F.lit((1 << 40) - 1))).over(alike).alias("_s")),
        "jaccard-shared")
    # of the groups with the same members, one
    chosen = shared.groupBy("size", "_x", "_s").agg(F.min("key").alias("key")).select("key")
    groups = materialize(shared.select("key", "cls", "size").join(chosen, "key"), "jaccard-groups")
    sketches = materialize(
        described.filter("n > 0").select("cls", "n", "sketch")
        .join(groups.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"]), "jaccard-sketches")

    def compared(rooted: DataFrame, nearest: bool) -> DataFrame:
        """Surviving pairs of ``rooted`` (key, size, cls, root)."""
        parts = F.ceil(F.col("size") / GROUP)
        dealt = (rooted.withColumn("part", F.pmod(F.xxhash64("cls"), parts))
                 .withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
                 .withColumn("one", F.least("part", "_o")).withColumn("two", F.greatest("part", "_o")))
        return (dealt.join(sketches, "cls")
                .select("key", "one", "two", "cls", "root", "part", "n", "sketch")
                .repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "cls")
                .mapInArrow(lambda it: _compare(it, similarity, nearest), "a long, b long").distinct())

    near = materialize(compared(groups.withColumn("root", F.col("cls")), True), "jaccard-pairs")
    # the sets of the classes that survive a comparison
    alive = near.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    cells, _ = bitmap(alive.select(F.col("cls").bitwiseAND(F.lit(CELLS - 1)).alias("cell")), CELLS)
    sets = materialize(text.mapInArrow(lambda it: _sets(it, n, cells), "cls long, shingles binary")
                       .join(alive, "cls", "left_semi").dropDuplicates(["cls"]), "jaccard-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        full = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a").join(
            sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b")
        return full.select("a", "b", "x", "y").mapInArrow(lambda it: _verify(it, similarity), "a long, b long")

    links = materialize(verified(near), "jaccard-links")
    roots = connected_components(links)
    # groups that still span components
    rooted = groups.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn(
        "root", F.coalesce("root", "cls"))
    split = rooted.groupBy("key").agg(F.min("root").alias("_l"), F.max("root").alias("_h")).filter(
        "_l != _h").select("key")
    across = compared(rooted.join(split, "key", "left_semi"), False)
    more = materialize(verified(across), "jaccard-links")
    roots = connected_components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    members = links.unionByName(more).select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(
        roots.select(F.col("node").alias("cls"), "root"), "cls", "left").select(
        "cls", F.coalesce("root", "cls").alias("root"))
    firsts = members.join(classes, "cls").groupBy("root").agg(F.min("first").alias("smallest"))
    linked = members.join(firsts, "root").select("cls", "root", "smallest")
    named = classes.join(linked, "cls", "left").select(
        F.col("cls").alias("_cls"), F.col("check").alias("_check"), F.col("n").alias("_n"),
        F.coalesce("root", "cls").alias("root"), F.coalesce("smallest", "first").alias("named"))
    rows = described.filter("n is not null")
    worded = F.col("n") > 0
    return rows.join(named, (rows.cls == named._cls) & (rows.check == named._check)
                     & (rows.n == named._n), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(worded, F.col("named")).otherwise(F.col("doc_id")).alias("component_id"),
        "mark", F.when(worded, F.col("root")).alias("component"))
