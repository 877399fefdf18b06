"""Near-duplicate vectors by product quantisation.

Vectors are dealt to inverted lists by coarse centroids, and what is left of each one is
coded per subspace. A query's cosines to all codes of a list are sums of table look-ups;
those that can reach the threshold, by the known angle of each vector to its own code, are
compared by exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.llm.common import Staged
from linkmill.llm.components import components, spanning_forest

# Vectors that the index is fitted on at most, chosen by a hash; every vector is indexed.
TRAINING = 16_384
LIST_ROWS = 1_024
MAX_LISTS = 256
CODES = 64
SUBSPACES = 16
# Dimensions of a subspace at most: longer vectors have more subspaces.
WIDTH = 8
PROBES = 8
ROUNDS = 8
# For the rounding of cosines added up in single precision.
ROUNDING = 1e-5
BLOCK = 1_024


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=len(centres))
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres ** 2).sum(1)[None, :] - 2 * (x @ centres.T)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(x[i:i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)]) \
        if len(x) else np.empty(0, np.int64)


@dataclass(frozen=True)
class Quantiser:
    coarse: np.ndarray  # lists x dimensions
    books: list[np.ndarray]  # per subspace: codes x its dimensions
    cuts: list[int]  # where the subspaces begin and end

    @classmethod
    def fit(cls, x: np.ndarray, lists: int) -> Quantiser:
        rng = np.random.default_rng(5)
        coarse = _kmeans(x, lists, rng)
        rest = x - coarse[_nearest(x, coarse)]
        d = x.shape[1]
        cuts = np.linspace(0, d, min(max(SUBSPACES, -(-d // WIDTH)), d) + 1).astype(int).tolist()
        return cls(coarse, [_kmeans(rest[:, a:b], CODES, rng) for a, b in zip(cuts, cuts[1:])], cuts)

    def lists_of(self, x: np.ndarray, probes: int) -> np.ndarray:
        d = _distances(x, self.coarse)
        probes = min(probes, d.shape[1])
        near = np.argpartition(d, probes - 1, axis=1)[:, :probes]
        order = np.take_along_axis(d, near, 1).argsort(1, kind="stable")
        return np.take_along_axis(near, order, 1)

    def codes_of(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        rest = x - self.coarse[lists]
        return np.column_stack([_nearest(rest[:, a:b], book) for book, a, b in zip(self.books, self.cuts, self.cuts[1:])]
                               ).astype(np.uint8)

    def decoded(self, coarse_list: int, codes: np.ndarray) -> np.ndarray:
        return self.coarse[coarse_list] + np.column_stack([book[codes[:, s]] for s, book in enumerate(self.books)])

    def bounds(self, x: np.ndarray, coarse_list: int, codes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest approximate cosine of each coded vector with any query whose exact one reaches the threshold.

        A query within angle t of a vector has an angle to the vector's code that differs from the
        vector's own by at most t, so no pair is lost.
        """
        hat = self.decoded(coarse_list, codes)
        length = np.linalg.norm(hat, axis=1)
        cosine = np.divide((x * hat).sum(1), length, out=np.zeros(len(x)), where=length > 0)
        own, t = np.arccos(np.clip(cosine, -1, 1)), np.arccos(np.clip(threshold, -1, 1))
        return (length * np.cos(np.minimum(own + t, np.pi)) - ROUNDING,
                length * np.cos(np.maximum(own - t, 0)) + ROUNDING)

    def approximate(self, queries: np.ndarray, coarse_list: int, codes: np.ndarray) -> np.ndarray:
        """Cosines of queries and coded vectors of one list: coarse part plus a look-up per subspace."""
        total = np.repeat((queries @ self.coarse[coarse_list])[:, None], len(codes), axis=1).astype(np.float32)
        for s, (book, a, b) in enumerate(zip(self.books, self.cuts, self.cuts[1:])):
            total += (queries[:, a:b] @ book.T).astype(np.float32)[:, codes[:, s]]
        return total


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _linker(shared, threshold: float):
    """Compare a block of queries with a block of a list's members; sums per vector and a forest come out.

    Vectors of a dimension without an index are all compared by exact cosine.
    """
    names = ["node", "other", "n_links"]

    def link(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tool = shared.value.get(key[0].as_py())
        table = table.combine_chunks()
        is_query = table["is_query"].to_numpy(zero_copy_only=False)
        ids, weights = table["rep"].to_numpy(), table["n"].to_numpy()
        vectors = _matrix(table["v"].combine_chunks())
        mine = int(key[1].as_py())
        lists = np.stack(table["lists"].to_numpy(zero_copy_only=False)) if len(table) else np.empty((0, 1))
        q, m = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        if not len(q) or not len(m):
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        if tool is not None:
            codes = tool.codes_of(vectors[m], np.full(len(m), mine))
            least, greatest = tool.bounds(vectors[m], mine, codes, threshold)
        a, b = [], []
        for i in range(0, len(q), 256):
            part = q[i:i + 256]
            if tool is not None:
                rough = tool.approximate(vectors[part], mine, codes)
                x, y = np.nonzero((rough >= least) & (rough <= greatest))
            else:
                x, y = (i.ravel() for i in np.indices((len(part), len(m))))
            step = max(1, 4_194_304 // vectors.shape[1])
            for at in range(0, len(x), step):
                left, right = part[x[at:at + step]], m[y[at:at + step]]
                sure = np.einsum("ij,ij->i", vectors[left], vectors[right]) >= threshold
                a.append(left[sure])
                b.append(right[sure])
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
        # A pair is met twice if each of the two probes the other's list; the smaller id then counts it as the query.
        twice = (lists[b] == lists[a][:, :1]).any(1)
        once = (ids[a] != ids[b]) & (~twice | (ids[a] < ids[b]))
        a, b = a[once], b[once]
        n = np.bincount(a, weights[b], len(ids)) + np.bincount(b, weights[a], len(ids))
        some = np.flatnonzero(n)
        forest = spanning_forest(ids[a], ids[b])
        return pa.table({
            "node": pa.array([*ids[some].tolist(), *(x for x, _ in forest)], pa.int64()),
            "other": pa.array([None] * len(some) + [y for _, y in forest], pa.int64()),
            "n_links": pa.array([*n[some].astype(int).tolist(), *[0] * len(forest)], pa.int64())})

    return link


def near_vectors(vectors: DataFrame, threshold: float = 0.95, probes: int = PROBES) -> DataFrame:
    """Link vectors whose cosine in double precision is at least `threshold`.

    Takes vec_id and embedding, whatever else there is. Returns per row: vec_id, n_links (other
    vectors linked directly, copies counted one by one), component_id (smallest vec_id reachable),
    kept. A vector that is null, empty, zero, or has a null or non-finite component links with nothing;
    vectors link with those of their own dimension only. A null vec_id is not linked.

    Equal vectors are one row of the index with their number. Coarse lists and codebooks are fitted per
    dimension on a bounded sample; a dimension of up to `BLOCK` vectors other than the most common one needs none. Each vector is then dealt to its own list and, as a query, to the
    `probes` nearest ones. Lists are compared in blocks of about `BLOCK` queries by `BLOCK` members, so a list
    of any size is many tasks. A block gives counts and a spanning forest, never its pairs.
    """
    spark = vectors.sparkSession
    e = F.col("embedding").cast("array<double>")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("v"))
    good = F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (norm > 0) & (norm < float("inf"))
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    digest = F.when(F.col("good"), F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))).cast("binary"), 256))
    rows = Staged(rows.select("vec_id", digest.alias("digest"),
                              F.when(F.col("good"), F.transform("v", lambda x: x / norm)).alias("v")), "vectors").df
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    classes = Staged(classes, "classes").df
    reps = rows.withColumnRenamed("vec_id", "rep").join(classes, ["digest", "rep"]).dropDuplicates(["digest"])
    reps = Staged(reps.select("rep", "n", "v"), "representatives").df

    none = spark.createDataFrame([], "node long, other long, n_links long")
    reps = reps.withColumn("d", F.size("v"))
    dims = reps.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).collect()
    if dims:
        tools = {}
        for i, (d, size) in enumerate(dims):
            if not i or size > BLOCK:
                sample = reps.where(F.col("d") == d).orderBy(F.xxhash64("rep"), "rep").limit(TRAINING).select("v").toArrow()
                tools[d] = Quantiser.fit(_matrix(sample["v"].combine_chunks()), max(1, min(MAX_LISTS, size // LIST_ROWS)))
        shared = spark.sparkContext.broadcast(tools)

        @F.arrow_udf("array<int>")
        def nearest_lists(v: pa.Array) -> pa.Array:
            sizes, found = pc.list_value_length(v).to_numpy(), [[0]] * len(v)
            for d in np.unique(sizes).tolist():
                tool, at = shared.value.get(d), np.flatnonzero(sizes == d)
                if tool is not None:
                    for i, lists in zip(at.tolist(), tool.lists_of(_matrix(v.take(pa.array(at))), probes).tolist()):
                        found[i] = lists
            return pa.array(found, pa.list_(pa.int32()))

        indexed = Staged(reps.withColumn("lists", nearest_lists("v")), "indexed").df
        members = indexed.groupBy("d", F.get("lists", F.lit(0)).alias("list")).agg(F.count("*").alias("m"))
        queries = indexed.select("d", F.explode("lists").alias("list")).groupBy("d", "list").agg(F.count("*").alias("q"))
        # Blocks of each list, by a hash of the id.
        plan = queries.join(members, ["d", "list"]).select(
            "d", "list", F.ceil(F.col("m") / BLOCK).cast("int").alias("m"), F.ceil(F.col("q") / BLOCK).cast("int").alias("q"))
        plan = F.broadcast(plan)  # at most MAX_LISTS rows per dimension

        def block(of: str):
            return F.pmod(F.xxhash64("rep"), F.col(of)).cast("int")

        fields = ["d", "list", "mb", "qb", "is_query", "rep", "n", "v", "lists"]
        of_list = indexed.withColumn("list", F.get("lists", F.lit(0))).join(plan, ["d", "list"]).select(
            "*", block("m").alias("mb"), F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qb"))
        asking = indexed.withColumn("list", F.explode("lists")).join(plan, ["d", "list"]).select(
            "*", block("q").alias("qb"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("mb"))
        both = of_list.withColumn("is_query", F.lit(False)).select(*fields).unionByName(
            asking.withColumn("is_query", F.lit(True)).select(*fields))

        linked = both.groupBy("d", "list", "mb", "qb").applyInArrow(
            _linker(shared, threshold), "node long, other long, n_links long")
        linked = Staged(linked, "linked").df
    else:
        linked = none
    counts = linked.where("other IS NULL").groupBy(F.col("node").alias("rep")).agg(F.sum("n_links").alias("links"))
    found = components(linked.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.join(counts, "rep", "left").join(found, F.col("rep") == F.col("node"), "left").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
        F.coalesce("component", "rep").alias("component"))
    result = rows.select("vec_id", "digest").join(named, "digest", "left")
    component = F.coalesce("component", "vec_id")
    return result.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
