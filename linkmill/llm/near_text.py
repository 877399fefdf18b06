"""Near-duplicate documents by b-bit MinHash.

A document's minima under `N_HASHES` permutations are cut into bands; documents that
agree in a band are candidates. Of each minimum only `B_BITS` low bits are kept. Equal
bits of two packed signatures are counted, and the share that would agree by chance is
taken out of the estimate. Pairs that can reach the threshold are confirmed on the full
shingle sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.llm.common import SHIFTS, Staged, hashed_texts, mix, signed, windows
from linkmill.llm.components import components, spanning_forest

SHINGLE = 5
N_HASHES = 128
BAND_ROWS = 4
BANDS = N_HASHES // BAND_ROWS
B_BITS = 2
PACKED = N_HASHES * B_BITS // 64
# A pair is compared in full if its estimate is at most this far below the threshold: four
# standard deviations of the estimate.
MARGIN = 0.15
# Documents of a family that a task compares with as many others.
FAMILY_BLOCK = 256

_RNG = np.random.default_rng(4321)
_FACTOR = _RNG.integers(1, 1 << 31, N_HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSET = _RNG.integers(0, 1 << 32, N_HASHES, dtype=np.uint32)
_BAND = _RNG.integers(1, 1 << 63, (BANDS, BAND_ROWS), dtype=np.uint64) | np.uint64(1)
_SHORT = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 4096

SETS = "doc_id long, text_hash long, n_shingles long, digest binary, packed array<long>, bands array<long>"


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than a shingle count as one shingle."""
    if len(words) == 0:
        return words
    if len(words) < SHINGLE:
        return mix((words * SHIFTS[40:40 + len(words)]).sum(keepdims=True, dtype=np.uint64) ^ _SHORT)
    return np.unique(windows(words, SHINGLE))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each permutation of the 32-bit numbers."""
    low = np.full(N_HASHES, 0xFFFFFFFF, np.uint32)
    top = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(top), _BLOCK):
        block = _FACTOR[:, None] * top[None, i:i + _BLOCK]
        block += _OFFSET[:, None]
        np.minimum(low, block.min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.astype(np.uint64).reshape(-1, BANDS, BAND_ROWS)
    return mix((rows * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _SHORT)


def pack(low: np.ndarray) -> np.ndarray:
    """The low bits of all (well mixed) minima, `64 / B_BITS` in a number."""
    bits = (mix(low.astype(np.uint64)) & np.uint64((1 << B_BITS) - 1)).reshape(-1, PACKED, 64 // B_BITS)
    shifts = np.arange(64 // B_BITS, dtype=np.uint64) * np.uint64(B_BITS)
    return (bits << shifts).sum(axis=2, dtype=np.uint64)


def _lists(values: np.ndarray, filled: np.ndarray) -> pa.Array:
    """One list of `values`' row length per document; documents without shingles get an empty one."""
    offsets = np.concatenate([[0], np.cumsum(filled * values.shape[1])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(values[filled].ravel())))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: dict = {}
    for batch in batches:
        for row, words, bounds in hashed_texts(batch.column(2), kept, lower=True):
            n = len(bounds) - 1
            sizes, digests, low = np.zeros(n, np.int64), [], np.empty((n, N_HASHES), np.uint32)
            for i in range(n):
                shingles = shingle_set(words[bounds[i]:bounds[i + 1]])
                sizes[i], low[i] = len(shingles), minima(shingles)
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, n), batch.column(1).slice(row, n), pa.array(sizes), pa.array(digests, pa.binary()),
                 _lists(pack(low), sizes > 0), _lists(band_keys(low), sizes > 0)],
                names=["doc_id", "text_hash", "n_shingles", "digest", "packed", "bands"])


def estimate(a: str, b: str) -> Column:
    """Similarity from two packed signatures: share of equal minima, without those equal by chance."""
    lowest = F.lit(sum(1 << (B_BITS * i) for i in range(64 // B_BITS - 1)) | 1 << (64 - B_BITS))
    equal = F.lit(N_HASHES)
    for i in range(PACKED):
        differ = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for k in range(1, B_BITS):
            differ = differ.bitwiseOR(F.shiftright(differ, k))
        equal = equal - F.bit_count(differ.bitwiseAND(lowest))
    chance = 2.0 ** -B_BITS
    return (equal / F.lit(float(N_HASHES)) - chance) / (1 - chance)


def _confirmer(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict = {}
        for batch in batches:
            sides = []
            for side in (2, 3):
                sides.append([shingle_set(words[bounds[i]:bounds[i + 1]])
                              for _, words, bounds in hashed_texts(batch.column(side), kept, lower=True)
                              for i in range(len(bounds) - 1)])
            linked = []
            for x, y in zip(*sides):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(linked, pa.bool_()))

    return confirm


def _family(percent: int):
    """Compare two blocks of a family: pairs of different components whose estimate can reach the threshold."""
    factor = 1 / (1 - 2.0 ** -B_BITS)
    lowest = np.uint64(sum(1 << (B_BITS * i) for i in range(64 // B_BITS)))

    def link(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table, kept = table.combine_chunks(), {}
        ids, names = table["rep"].to_numpy(), table["c"].to_numpy()
        block, packed = table["block"].to_numpy(), np.stack(table["packed"].to_numpy(zero_copy_only=False)).view(np.uint64)
        sets = [shingle_set(words[bounds[i]:bounds[i + 1]])
                for _, words, bounds in hashed_texts(table["text"].combine_chunks(), kept, lower=True)
                for i in range(len(bounds) - 1)]
        sizes = np.array([len(s) for s in sets])
        right = np.flatnonzero(block == key[2].as_py())
        a, b = [], []
        for i in np.flatnonzero(block == key[1].as_py()):
            among = right if key[1] != key[2] else right[right > i]
            differ = packed[among] ^ packed[i]
            for k in range(1, B_BITS):
                differ |= differ >> np.uint64(k)
            equal = 1 - np.bitwise_count(differ & lowest).sum(axis=1) / N_HASHES
            open_ = (names[among] != names[i]) & (1 - (1 - equal) * factor >= percent / 100 - MARGIN)
            open_ &= 100 * np.minimum(sizes[among], sizes[i]) >= percent * np.maximum(sizes[among], sizes[i])
            for j in among[open_]:
                x, y = (sets[i], sets[j]) if sizes[i] <= sizes[j] else (sets[j], sets[i])
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    a.append(ids[i])
                    b.append(ids[j])
        forest = spanning_forest(np.array(a, np.int64), np.array(b, np.int64))
        return pa.table({"a": pa.array([x for x, _ in forest], pa.int64()), "b": pa.array([y for _, y in forest], pa.int64())})

    return link


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Link documents whose word-shingle sets have `100 * intersection >= percent * union`.

    Takes columns doc_id and text, whatever others there are. Returns one row per input
    row: doc_id, n_shingles, component_id (smallest doc_id that links reach, itself
    included) and kept (doc_id = component_id). A null or empty text has no shingles and
    no links; a text shorter than a shingle is one shingle of its words. Rows with equal
    sets form one class, whatever their ids; a null doc_id never gives its name to a class.
    Rows that share an id and differ in text are classes of their own: each is compared, and
    all that links to one of them bears the smallest id that it reaches.

    Equal sets are folded to one representative before any comparison, so copies cost one
    row each. Candidates come in two steps. First each member of a band bucket is paired
    with the smallest member (one row per member, whatever the bucket's size), confirmed on
    full texts, and components are formed. Then only pairs of a bucket whose members lie in
    different components are left. Documents that estimates connect form a family; a family
    is compared in blocks, which ship its texts and give a spanning forest of the links
    found, not pairs. For pairs of a bucket from two families the estimate is a
    condition of the join, so that no pair comes out of it that cannot reach the threshold.
    """
    threshold = percent / 100
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    sets = Staged(docs.select(doc_id, F.xxhash64(text).alias("text_hash"), text).mapInArrow(_sets, SETS), "shingle-sets").df
    classes = sets.where("n_shingles > 0").groupBy("digest").agg(F.min(F.when(
        F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("first")).where("first IS NOT NULL")
    # A class goes by a number; the ids of its rows may be those of other classes too.
    classes = Staged(classes.select(F.monotonically_increasing_id().alias("rep"), "digest", "first"), "classes").df
    reps = sets.join(classes.select("rep", "digest", F.col("first.doc_id").alias("doc_id"),
                                    F.col("first.text_hash").alias("text_hash")), ["digest", "doc_id", "text_hash"])
    reps = Staged(reps.select("rep", "packed", "bands").dropDuplicates(["rep"]), "representatives").df

    rows = reps.select("rep", F.explode("bands").alias("key"))
    shared = rows.groupBy("key").agg(F.min("rep").alias("first"), F.count("*").alias("n")).where("n > 1")
    members = Staged(rows.join(shared.select("key", "first"), "key"), "buckets").df
    stars = members.where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()
    packed = reps.select("rep", "packed")
    near = stars.join(packed.select(F.col("rep").alias("a"), F.col("packed").alias("pa")), "a")
    near = near.join(packed.select(F.col("rep").alias("b"), F.col("packed").alias("pb")), "b")
    near = near.select("a", "b", estimate("pa", "pb").alias("e")).where(F.col("e") >= threshold - MARGIN)
    near = Staged(near, "near").df

    ids = members.select(F.col("rep").alias("id")).distinct()
    wanted = classes.join(ids, F.col("rep") == F.col("id")).select("id", "first.doc_id", "first.text_hash")
    texts = docs.select(doc_id.alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    texts = texts.join(wanted, ["doc_id", "text_hash"]).select("id", "text").dropDuplicates(["id"])
    texts = Staged(texts, "texts").df

    def confirmed(pairs: DataFrame) -> DataFrame:
        full = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
        full = full.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
        return full.select("a", "b", "ta", "tb").mapInArrow(_confirmer(percent), "a long, b long")

    # The best pair of each document first: most components are found by one comparison per document.
    best = near.groupBy("b").agg(F.max(F.struct(F.col("e"), (-F.col("a")).alias("a"))).alias("m"))
    links = Staged(confirmed(best.select((-F.col("m.a")).alias("a"), "b")), "links").df
    found = Staged(components(links), "found").df

    families = components(near).select(F.col("node").alias("member"), F.col("component").alias("family"))
    named = members.join(found, F.col("rep") == F.col("node"), "left").join(
        families, F.col("rep") == F.col("member"), "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("c"), F.coalesce("family", "rep").alias("family"))
    named = Staged(named, "named").df

    kin = named.select("rep", "c", "family").distinct()
    large = kin.groupBy("family").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("n"))
    large = large.where("low <> high").select("family", F.ceil(F.col("n") / FAMILY_BLOCK).cast("int").alias("blocks"))
    kin = kin.join(large, "family").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    kin = kin.join(packed, "rep").join(texts.withColumnRenamed("id", "rep"), "rep")
    kin = kin.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    kin = kin.groupBy("family", F.least("block", "other").alias("lower"), F.greatest("block", "other").alias("upper"))
    within = kin.applyInArrow(_family(percent), "a long, b long")

    mixed = named.groupBy("key").agg(F.min("family").alias("low"), F.max("family").alias("high")).where("low <> high")
    open_rows = named.join(mixed.select("key"), "key", "left_semi").join(packed, "rep")
    x, y = open_rows.alias("x"), open_rows.alias("y")
    more = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.rep") < F.col("y.rep"))
                  & (F.col("x.family") != F.col("y.family"))
                  & (estimate("x.packed", "y.packed") >= threshold - MARGIN))
    more = more.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    extra = Staged(confirmed(more).union(within), "links").df
    found = components(links.union(extra))

    ended = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component"), F.col("first.doc_id").alias("doc_id"))
    ended = Staged(ended, "ended").df
    # Staged, so that Spark can split the join for a component with very many classes.
    names = Staged(ended.groupBy("component").agg(F.min("doc_id").alias("component_id")), "names").df
    names = ended.select("digest", "component").join(names, "component").select("digest", "component_id")
    rows = sets.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
    rows = rows.join(names, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
