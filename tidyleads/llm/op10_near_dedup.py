"""MinHash near-dedup by bottom-k sketches from one hash function.

1. Every text becomes the set of its word-shingle hashes; its sketch is the k
   smallest.  Texts with equal sets form a class, and one sketch stands for it.
2. Inverted lists of the retained values.  Two sets of the wanted similarity
   share most of their k retained values: all but `SIGMAS` standard errors (sets so
   small that a sketch holds them whole share their exact minimum for certain).
   So they meet in a list of the size - shared + 1 rarest values of either, and
   only those are posted: values of common passages go last and hardly ever are.
3. Lists of up to `LIGHT` classes give their pairs.  A longer list, as of
   thousands of near copies, first gives stars around its most central class (whose retained
   values are the most common) and its largest.  Lists of one central class then form a
   family; its classes that still lie in different components are compared block by
   block inside tasks, on full sets, and of the links found a spanning forest leaves a task.
4. Pairs whose similarity estimated from the union sketch is too low go; the others are
   verified on full shingle sets.
5. Verified links give connected components.

Null and empty texts have no shingles, link with nothing and stay; repeated
rows are classes of several rows; null doc_ids count in groups but never name
them; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import byte_chunks, encoded, mix, settled as materialize, shingle_hashes, word_hashes
from .components import components

K = 64
#: Lists up to this length give all their pairs (190 at most).
LIGHT = 20
#: Standard errors of slack in what two similar sets' sketches share.
SIGMAS = 6
#: Classes in a block of a family: at least, and at most.
BLOCK, BLOCK_MOST = 128, 2000


def _sets(texts: list[bytes], n: int):
    for a, b in byte_chunks(texts):
        words, first = word_hashes(texts[a:b])
        for i in range(b - a):
            yield np.unique(shingle_hashes(words[first[i]:first[i + 1]], n))


def sketches(docs: DataFrame, shingle: int, k: int = K) -> DataFrame:
    """One row per document: doc_id, th (hash of the text), cid (hash of the
    shingle set; null without words), n (its size), sketch."""
    def run(batches):
        for pdf in batches:
            rows = []
            for s in _sets(encoded(pdf["text"]), shingle):
                cid = int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(s) else None
                # the sign bit flipped, so that signed order is the order of the hashes
                rows.append((cid, len(s), (s[:k] ^ np.uint64(1 << 63)).view(np.int64) if len(s) else None))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "th": pdf["th"], "cid": pd.array([r[0] for r in rows], dtype="Int64"),
                                "n": [r[1] for r in rows], "sketch": [r[2] for r in rows]})
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("th")).mapInPandas(
        run, "doc_id long, th long, cid long, n long, sketch array<long>")


def _least_shared(k: int, percent: int) -> int:
    """Values that the sketches of two similar sets of k or more shingles share at least."""
    p = percent / 100
    return max(1, int(k * (p - SIGMAS * (p * (1 - p) / k) ** 0.5)))


def _shared(n, k: int, percent: int):
    """Retained values that a set of size n shares at least with any similar set."""
    return F.when(n * 100 <= k * percent, F.ceil(n * percent / F.lit(100.0))).otherwise(F.lit(_least_shared(k, percent))).cast("int")


def postings(reps: DataFrame, k: int, percent: int) -> DataFrame:
    """(value, cid, n, w): the rarest retained values of each class, and how central the class is."""
    rows = reps.select("cid", "n", F.size("sketch").alias("s"), F.explode("sketch").alias("value"))
    common = rows.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    held = rows.join(common, "value").groupBy("cid", "n", "s").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("held"),
                                                                   (F.sum("df") / F.col("s")).alias("w"))
    # values that no other class retains are rarest and come first; they post nothing
    wanted = F.col("s") - _shared(F.col("n"), k, percent) + 1 - (F.col("s") - F.size("held"))
    posted = F.slice("held", F.lit(1), F.greatest(wanted, F.lit(0)))["value"]
    return held.select(F.explode(posted).alias("value"), "cid", "n", "w")


def _close(a, b, percent: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def estimated(pairs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs whose union sketch lets them be similar."""
    least = _least_shared(k, percent) / k
    sk = reps.select("cid", "sketch")
    both = (pairs.join(sk.select(F.col("cid").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(sk.select(F.col("cid").alias("b"), F.col("sketch").alias("sb")), "b"))
    order = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)  # the k smallest of the union
    shared = F.size(F.array_intersect(order, F.array_intersect("sa", "sb")))
    return both.where(shared >= F.floor(F.size(order) * least)).select("a", "b")


def _members(lists: DataFrame) -> DataFrame:
    return lists.groupBy("value").agg(F.count("*").alias("m"), F.max(F.struct("w", "cid", "n")).alias("central"),
                                      F.max(F.struct("n", "cid")).alias("largest"))


def light_pairs(posts: DataFrame, percent: int, light: int = LIGHT) -> DataFrame:
    """All pairs of lists of up to ``light`` members, and the stars of each longer list."""
    listed = posts.join(_members(posts).where("m > 1"), "value")
    a = listed.where(F.col("m") <= light).select("value", F.col("cid").alias("a"), F.col("n").alias("na"))
    b = listed.where(F.col("m") <= light).select("value", F.col("cid").alias("b"), F.col("n").alias("nb"))
    pairs = a.join(b, "value").where("a < b").where(_close(F.col("na"), F.col("nb"), percent)).select("a", "b")
    hubs = F.explode(F.array(F.struct(F.col("central.cid").alias("cid"), F.col("central.n").alias("n")),
                             F.struct(F.col("largest.cid").alias("cid"), F.col("largest.n").alias("n"))))
    star = listed.where(F.col("m") > light).select("cid", "n", hubs.alias("hub")).where("cid <> hub.cid")
    star = star.where(_close(F.col("n"), F.col("hub.n"), percent)).select(F.least("cid", "hub.cid").alias("a"), F.greatest("cid", "hub.cid").alias("b"))
    return pairs.union(star).distinct()


def families(posts: DataFrame, roots: DataFrame, light: int = LIGHT, block: int = BLOCK) -> DataFrame:
    """(hub, cid, n, root, blocks): the classes of all long lists of one central class, where
    they lie in several components, and how many blocks to cut the family into."""
    long_ = posts.select("value", "cid", "n").join(
        _members(posts).where(F.col("m") > light).select("value", F.col("central.cid").alias("hub")), "value")
    at = long_.groupBy("hub", "cid").agg(F.first("n").alias("n"))
    at = at.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    mixed = at.groupBy("hub").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("m")).where("x <> y")
    size = F.greatest(F.lit(block), F.least(F.lit(BLOCK_MOST), F.col("m") / 32))
    return at.join(mixed.select("hub", F.ceil(F.col("m") / size).cast("int").alias("blocks")), "hub")


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of incidence matrices of 4096 values each."""
    both = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    _, column, count = np.unique(both, return_inverse=True, return_counts=True)
    wide = count > 1  # values of one set alone meet nothing
    number = np.cumsum(wide) - 1
    own = wide[column]
    column, owner = number[column[own]], owner[own]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for lo in range(0, int(wide.sum()), 4096):
        a, b = np.searchsorted(column, (lo, lo + 4096))
        x = np.zeros((len(left) + len(right), 4096), dtype=np.float32)
        x[owner[a:b], column[a:b] - lo] = 1
        out += x[:len(left)] @ x[len(left):].T
    return out


def family_links(members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (u, v) between classes of a family that lie in different components: of
    each two blocks a spanning forest of their links, which connects the same."""
    at = members.join(texts, "cid").withColumn("i", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    # block i meets block j >= i: send each member to (min(i, j), max(i, j)) for all j
    sent = at.select("hub", "cid", "root", "z", "i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    sent = sent.select("hub", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "cid", "root", "z")

    def meet(key, pdf):
        unzip = zstandard.ZstdDecompressor()
        left, right = pdf[pdf["i"] == key[1]], pdf[pdf["i"] == key[2]]
        if not len(left) or not len(right):
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        x = list(_sets([unzip.decompress(z) for z in left["z"]], shingle))
        y = x if key[1] == key[2] else list(_sets([unzip.decompress(z) for z in right["z"]], shingle))
        both = _intersections(x, y).astype(np.int64)
        n, m = np.array([len(s) for s in x]), np.array([len(s) for s in y])
        a, b = left["root"].to_numpy(), right["root"].to_numpy()
        p, q = np.nonzero((100 * both >= percent * (n[:, None] + m[None] - both)) & (a[:, None] != b[None]))
        parent: dict[int, int] = {}

        def find(r):
            while parent.setdefault(r, r) != r:
                parent[r] = r = parent[parent[r]]
            return r
        out = []
        for i, j in zip(p, q):
            r, s = find(int(a[i])), find(int(b[j]))
            if r != s:
                parent[max(r, s)] = min(r, s)
                out.append((left["cid"].iat[i], right["cid"].iat[j]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return sent.groupBy("hub", "lo", "hi").applyInPandas(meet, "u long, v long")


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (u, v) with 100 * intersection >= percent * union on full sets."""
    def run(batches):
        unzip = zstandard.ZstdDecompressor()
        for pdf in batches:
            ok = []
            for lo in range(0, len(pdf), 64):
                part = pdf.iloc[lo:lo + 64]
                sets = zip(_sets([unzip.decompress(z) for z in part["za"]], shingle),
                           _sets([unzip.decompress(z) for z in part["zb"]], shingle))
                for x, y in sets:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pdf.loc[np.array(ok, dtype=bool), ["u", "v"]]
    rows = (pairs.join(texts.select(F.col("cid").alias("a"), F.col("z").alias("za")), "a")
            .join(texts.select(F.col("cid").alias("b"), F.col("z").alias("zb")), "b"))
    return rows.select(F.col("a").alias("u"), F.col("b").alias("v"), "za", "zb").mapInPandas(run, "u long, v long")


def texts_of(docs: DataFrame, reps: DataFrame, cids: DataFrame) -> DataFrame:
    """(cid, z): the compressed text of each class of ``cids``."""
    needed = cids.distinct().join(reps.select("cid", "rep"), "cid")
    needed = needed.select("cid", F.col("rep.doc_id").alias("rid"), F.col("rep.th").alias("rth"))
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("th"))
    rows = rows.join(needed, rows["doc_id"].eqNullSafe(needed["rid"]) & (rows["th"] == needed["rth"])).select("cid", "text")

    def run(batches):
        zip_ = zstandard.ZstdCompressor(level=3)
        for pdf in batches:
            yield pd.DataFrame({"cid": pdf["cid"], "z": [zip_.compress(t) for t in encoded(pdf["text"])]})
    return rows.mapInPandas(run, "cid long, z binary").groupBy("cid").agg(F.first("z").alias("z"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, k: int = K, light: int = LIGHT, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, th, n_shingles, class_id, component (least doc_id of the
    linked documents; of a document without words its own), kept."""
    rows = materialize(sketches(docs, shingle, k))
    reps = materialize(rows.where("n > 0").groupBy("cid").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min(F.struct("doc_id", "th")).alias("rep")))
    posts = materialize(postings(reps, k, percent))
    first = materialize(estimated(light_pairs(posts, percent, light), reps, k, percent))
    texts = materialize(texts_of(docs, reps, first.select(F.explode(F.array("a", "b")).alias("cid"))))
    links = materialize(verified(first, texts, shingle, percent))
    roots = materialize(components(links))
    late = materialize(families(posts, roots, light, block))
    if not late.isEmpty():
        texts = materialize(texts_of(docs, reps, late.select("cid")))
        links = links.union(materialize(family_links(late, texts, shingle, percent)))
        roots = materialize(components(links))
    named = rows.select("doc_id", "th", "cid", "n").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("root", F.coalesce("root", "cid"))
    names = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = named.join(names, "root", "left").withColumn("component", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least")))
    return out.select("doc_id", "th", F.col("n").alias("n_shingles"), F.col("cid").alias("class_id"), "root", "component",
                      F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


def deduplicated(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with their own columns only, of which one of each group stays:
    the row of the least doc_id (of repeated rows, one).  Documents without words all stay."""
    found = near_duplicates(docs, shingle, percent)
    key = [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), "th"]
    keep = found.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("rep"))
    blank = found.where("root is null").select("doc_id", "th")
    keep = keep.select("rep.doc_id", "rep.th").select(*key, F.lit(False).alias("all")).union(blank.select(*key, F.lit(True)).distinct())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.struct("*").alias("row"))
    rows = rows.select(*key, "row").join(keep, ["id", "no_id", "th"])
    again = F.row_number().over(W.partitionBy("id", "no_id", "th").orderBy(F.lit(0)))  # partitioned as the join
    return rows.withColumn("again", again).where("all or again = 1").select("row.*")
