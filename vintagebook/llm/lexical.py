"""Ranked lexical search by pipelined term partitioning.

One pass cuts every text into terms and keeps the places of the items' terms
(found by a bitmap of term hashes, then by an exact join), with the statistics
of all documents.  The items' terms are parted among owners by their document
frequency, the rarest first.  The documents are dealt into buckets; an item has
one bundle per bucket: its terms and a sparse accumulator (documents, scores).
The bundles go through the owners' stages one after another: each is a cogroup
of the bundles with the owner's postings, by bucket and block of items, which
adds the terms' whole-number contributions.  After a stage a document that even
the largest contributions of all later owners cannot lift to the bucket's
``k``-th score leaves the accumulator, and once no new document can get there,
none is taken in.  The last stage leaves ``k`` documents of a bucket; one window
per item merges them.

A term's postings are spread over the buckets, so a term that every document
holds is no hot key; a bucket holds ``BUCKET_DOCS`` documents, a block
``ITEM_BLOCK`` items, whatever their total numbers.

Defined cases: a null text has no terms; a document without terms does not
count; a document without an id counts in the statistics but is never returned;
rows that share an id are documents of their own, each ranked; items that share
an id count as one, with the terms of all; an item without terms, or with none
that a document holds, has no rows; equal scores stand by doc_id; empty tables
give no rows; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.bounded import bounded_broadcast
from .common import LOWER, UPPER, ascii_lower, materialize, text_slices, tidy, word_table

BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # what no term holds
BITS = 1 << 22
BUCKET_DOCS = 4096
ITEM_BLOCK = 256
BANDS = (1024, 64, 8)  # an owner's terms are in at most one document of so many
UNIT = 1_000_000  # a term's weight is multiplied by less than this
_TERMS = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256)).translate(
    bytes.maketrans(UPPER.encode(), LOWER.encode()))

BUNDLE = ("bucket long, block long, item_id long, terms array<struct<owner: int, term_id: long, most: long>>, "
          "taking boolean, rows array<long>, docs array<long>, scores array<long>")

_TERM_LIST = pa.list_(pa.struct([("owner", pa.int32()), ("term_id", pa.int64()), ("most", pa.int64())]))


def spaced_terms(texts: pa.Array) -> pa.Array:
    """The texts lower-cased (A-Z) with a space for every byte outside terms."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return texts
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes().translate(_TERMS)
    return pa.Array.from_buffers(pa.large_string(), len(texts),
                                 [None, pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(body)])


def _postings(batches: Iterator[pa.RecordBatch], bits: bytes) -> Iterator[pa.RecordBatch]:
    """(row, doc_id, n, term, tf) of (row, doc_id, text): one row with a null
    term per document with terms, and one per term that ``bits`` may hold."""
    asked = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
    for b in tidy(batches):
        for part in text_slices(b, 2):
            starts, index, words = word_table(spaced_terms(part.column(2)))
            n = np.diff(starts)
            cells = np.fromiter((zlib.crc32(w) & BITS - 1 for w in words.cast(pa.large_binary()).to_pylist()),
                                np.int64, len(words))
            which = np.repeat(np.arange(len(n)), n)
            hit = asked[cells[index]] if len(index) else np.zeros(0, bool)
            keys, tf = np.unique(which[hit] * len(words) + index[hit], return_counts=True)
            full = np.flatnonzero(n)
            at = np.concatenate((full, keys // max(len(words), 1)))
            terms = pa.concat_arrays([pa.nulls(len(full), words.type), words.take(pa.array(keys % max(len(words), 1)))])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(at)), part.column(1).take(pa.array(at)), pa.array(n[at], pa.int64()),
                 terms.cast(pa.string()), pa.array(np.concatenate((np.zeros(len(full), np.int64), tf)), pa.int64())],
                names=["row", "doc_id", "n", "term", "tf"])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each pair once."""
    terms = F.split(ascii_lower(F.coalesce("text", F.lit(""))), BREAKS)
    return items.select("item_id", F.explode(terms).alias("term")).filter("term <> ''").distinct()


def term_bits(terms: DataFrame) -> bytes:
    """Bitmap of the cells (of ``BITS``) that the terms' hashes fall into."""
    cell = F.crc32(F.encode("term", "UTF-8")).bitwiseAND(BITS - 1) + 1
    parts = terms.select(cell.alias("c")).groupBy(F.bitmap_bucket_number("c").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("c")).alias("bits"))
    out = bytearray(BITS // 8)
    for r in parts.collect():  # at most 128 rows of 4 kB
        at = (r["b"] - 1) * len(r["bits"])
        out[at:at + len(r["bits"])] = r["bits"]
    return bytes(out)


def _stage(bundles: pa.Table, postings: pa.Table, owner: int, last: bool, k: int) -> pa.Table:
    """The bundles of one bucket and block of items after ``owner``."""
    term, row, doc, add = (postings[c].to_numpy() for c in ("term_id", "row", "doc_id", "c"))
    order = np.argsort(term, kind="stable")
    term, row, doc, add = term[order], row[order], doc[order], add[order]
    out = []
    held = bundles["rows"].combine_chunks()
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(held).to_numpy(zero_copy_only=False))))
    held_rows, held_docs, held_scores = (bundles[c].combine_chunks().flatten().to_numpy() for c in ("rows", "docs", "scores"))
    known, first = np.unique(np.concatenate([row, held_rows]), return_index=True)
    names = np.concatenate([doc, held_docs])[first]
    at, held_at = np.searchsorted(known, row), np.searchsorted(known, held_rows)
    for i, (terms, taking) in enumerate(zip(bundles["terms"].to_pylist(), bundles["taking"].to_pylist())):
        sums = np.zeros(len(known), np.int64)
        mine = held_at[ends[i]:ends[i + 1]]
        sums[mine] = held_scores[ends[i]:ends[i + 1]]
        rest = 0
        for t in terms:
            if t["owner"] == owner:
                a, z = np.searchsorted(term, [t["term_id"], t["term_id"] + 1])
                sums[at[a:z]] += add[a:z]  # a document holds a term once
            elif t["owner"] > owner:
                rest += t["most"]
        live = np.flatnonzero(sums) if taking else mine
        if len(live) > k:
            cut = np.partition(sums[live], len(live) - k)[len(live) - k]
            live = live[sums[live] + rest >= cut]
            taking = taking and rest >= cut
        if last:
            live = live[np.lexsort((known[live], names[live], -sums[live]))[:k]]
        out.append((taking, known[live], names[live], sums[live]))
    lists = lambda j: pa.array([x[j] for x in out], pa.list_(pa.int64()))
    return pa.Table.from_arrays(
        [*[bundles[c].combine_chunks() for c in ("bucket", "block", "item_id")],
         bundles["terms"].combine_chunks().cast(_TERM_LIST),
         pa.array([bool(x[0]) for x in out], pa.bool_()), lists(1), lists(2), lists(3)],
        names=["bucket", "block", "item_id", "terms", "taking", "rows", "docs", "scores"])


def weighted_terms(asked: DataFrame, postings: DataFrame, n_docs: int) -> DataFrame:
    """(term, w, owner, term_id) of the items' terms that a document holds and
    whose weight is above 0."""
    df = postings.filter("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    owner = F.lit(len(BANDS))
    for i in reversed(range(len(BANDS))):
        owner = F.when(F.col("df") * BANDS[i] <= n_docs, i).otherwise(owner)
    # doubles: 2 N + 2 and 2 df + 1 are whole numbers below 2^53
    share = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    terms = asked.select("term").distinct().join(df, "term").select(
        "term", F.floor(1000 * F.log(share)).cast("long").alias("w"), owner.alias("owner"))
    terms = materialize(terms.filter("w > 0").withColumn("term_id", F.monotonically_increasing_id()), "lexical-terms")
    return terms


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best of ``docs`` (doc_id, text)
    for every one of ``items`` (item_id, text)."""
    asked = materialize(item_terms(items), "lexical-items")
    bits = term_bits(asked)
    postings = materialize(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        lambda it: _postings(it, bits), "row long, doc_id long, n long, term string, tf long"), "lexical-postings")
    total = postings.filter("term is null").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
    n_docs, length = total["n"], total["l"] or 1
    terms = weighted_terms(asked, postings, n_docs)
    blocks = asked.select("item_id").distinct().count() // ITEM_BLOCK + 1
    buckets = n_docs // BUCKET_DOCS + 1
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    # an item's terms, and the blocks of items that want a term
    listed = asked.join(terms, "term").select("item_id", block.alias("block"), "term_id", "owner", "w")
    wanted = listed.select("term_id", "block").distinct().groupBy("term_id").agg(
        F.collect_list("block").alias("blocks"))
    known = bounded_broadcast(terms.join(wanted, "term_id"))
    m = F.expr(f"50 + (50 * n * {n_docs}L) div {length}L")
    added = postings.filter("term is not null and doc_id is not null").join(known, "term").withColumn("m", m).select(
        F.pmod(F.xxhash64("row"), F.lit(buckets)).alias("bucket"), F.explode("blocks").alias("block"), "owner",
        "term_id", "row", "doc_id", F.expr("w * ((1000000000L * tf) div (1000 * tf + 20 * m))").alias("c"))
    added = materialize(added, "lexical-contributions", by="owner")
    bundles = listed.groupBy("block", "item_id").agg(F.collect_list(F.struct(
        "owner", "term_id", (F.col("w") * UNIT).alias("most"))).alias("terms"))
    none = F.array().cast("array<long>")
    bundles = bundles.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"),
                             "block", "item_id", "terms", F.lit(True).alias("taking"), none.alias("rows"),
                             none.alias("docs"), none.alias("scores"))
    key = ("bucket", "block")
    for owner in range(len(BANDS) + 1):
        step = (lambda o: lambda a, b: _stage(a, b, o, o == len(BANDS), k))(owner)
        part = added.filter(F.col("owner") == owner).drop("owner")
        bundles = bundles.groupBy(*key).cogroup(part.groupBy(*key)).applyInArrow(step, BUNDLE)
    found = bundles.select("item_id", F.explode(F.arrays_zip("docs", "scores")).alias("x")).select(
        "item_id", F.col("x.docs").alias("doc_id"), F.col("x.scores").alias("score"))
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def oracle_sql(k: int = 50) -> str:
    """DuckDB SQL of the op13 query."""
    cut = lambda t: f"unnest(regexp_extract_all(translate({t}, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'))"
    return f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
places AS (SELECT r, doc_id, {cut('text')} AS term FROM rows),
tfs AS (SELECT r, doc_id, term, count(*) AS tf FROM places GROUP BY ALL),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM tfs GROUP BY r),
total AS (SELECT count(*) AS nn, sum(n)::BIGINT AS ll FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2 * max(nn) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, total GROUP BY term),
asked AS (SELECT DISTINCT item_id, {cut('text')} AS term FROM benchmark),
scored AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nn) // ll))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (r), total GROUP BY item_id, r),
placed AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0 AND doc_id IS NOT NULL)
SELECT * FROM placed WHERE rank <= {k}"""
