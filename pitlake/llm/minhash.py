"""MinHash near-dedup: universal hash minima with banding, signature
verification, full-set confirmation, and connected components.

1. One pass makes each document's set of distinct 5-word shingles (64-bit
   fingerprints) and from it HASHES multiply-add minima: the first BANDS *
   ROWS are hashed band by band into keys, and one byte of each is kept for
   verification.
2. Documents of equal word sequences form a class, which has a node number and
   its smallest id's text: copies are never compared.
3. In each bucket (equal band key) every member is compared with the bucket's
   smallest node, its hub: as many pairs as rows.  Signatures that agree in too
   few places are dropped (the bound is five standard deviations below the
   threshold), the others are confirmed on full sets.
4. Components of the confirmed links are built.  A bucket all of whose members
   are in one component cannot join anything more.  In the other buckets the
   members outside the largest component, the strays, are compared by their
   signatures with the members of other components, in blocks.  First each
   stray's likeliest partner is confirmed on full sets, as many pairs as rows,
   which joins nearly all of what belongs together; then, with the strays that
   remain, every pair whose signatures agree is confirmed where it is found,
   and the links alone leave the block.  So no link is lost where a
   member is near another member but not near the hub.
5. Components again, over all links; each document gets the smallest id of
   its class's component.

Hot buckets, hubs and classes are split (``attach``, salted verification).
With BANDS bands of ROWS minima a pair at the threshold has no common bucket
with a chance of 2 in 10,000, and signatures that agree in too few places with
a chance of 4 in 10 million; above the threshold both chances fall steeply.

Defined cases: null and empty texts, or texts without words, have no shingles
and link with nothing; fewer than five words make one shingle; a null id is
a document that is its own component (null); rows that repeat an id are told
apart by their texts: each text has its own component, named by its smallest
id, and where the smallest id has several texts in one component, those of the
least content hash are kept; an empty table gives no rows; extra columns are
never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import attach, written
from pitlake.llm.components import components
from pitlake.llm.texts import over_texts
from pitlake.llm.words import Rolling, WordHashes, words_of

SHINGLE, BANDS, ROWS, HASHES = 5, 32, 5, 320
#: similarity threshold, intersection over union, in hundredths
THRESHOLD = 75
#: places of HASHES that must agree: 0.75 less five standard deviations of the estimate
AGREE = int(HASHES * (0.75 - 5 * (0.75 * 0.25 / HASHES) ** 0.5))
#: members that one verification group compares with its hub; members and strays that one task compares
GROUP, BLOCK = 400, 512
#: shingles multiplied at a time
STEP = 2048


def shingle_set(words: list[bytes], hashes: WordHashes, rolling: Rolling) -> np.ndarray:
    """Sorted distinct shingle fingerprints; fewer words than a shingle make one."""
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes.of(words)
    if len(words) < rolling.width:
        return Rolling(len(words))(h)
    return np.unique(rolling(h))


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= THRESHOLD * (len(a) + len(b) - common)


class Minima:
    """The smallest value of each of HASHES functions a * x + b modulo 2^64 over a set."""

    def __init__(self, seed: int = 1):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.a = draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)[:, None]
        self.space = np.empty((HASHES, STEP), np.uint64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        best = None
        for at in range(0, len(x), STEP):
            part = x[None, at:at + STEP]
            t = self.space[:, :part.shape[1]]
            np.multiply(self.a, part, out=t)
            t += self.b
            least = t.min(axis=1)
            best = least if best is None else np.minimum(best, least)
        return best >> np.uint64(32)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, content (128-bit hash of the words), bands and signature bytes."""

    def make():
        hashes, rolling, minima, band = WordHashes(), Rolling(SHINGLE), Minima(), Rolling(ROWS)

        def run(texts):
            out = []
            for t in texts:
                words = words_of(t, lower=True)
                s = shingle_set(words, hashes, rolling)
                if len(s):
                    m = minima(s)
                    keys = band(m[:BANDS * ROWS])[::ROWS]      # one hash of each run of ROWS minima
                    out.append((len(s), hashlib.md5(b" ".join(words)).digest(), keys.tobytes(), m.astype(np.uint8).tobytes()))
                else:
                    out.append((0, None, None, None))
            return {c: [o[k] for o in out] for k, c in enumerate(("n_shingles", "content", "bands", "signature"))}

        return run

    return over_texts(docs, id_col, text_col, make, {"n_shingles": "long", "content": "binary", "bands": "binary", "signature": "binary"})


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are linked: signatures first, then full sets."""
    pairs = written(pairs, "near-pairs")
    per_hub = written(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n_hub")), "near-hubs")
    side = lambda x: classes.select(F.col("node").alias(x), F.col("signature").alias(f"s_{x}"), F.col("n_shingles").alias(f"n_{x}"))
    hubs = written(per_hub.join(side("a"), "a"), "near-hub-signatures")

    @F.pandas_udf("int")
    def agreeing(x: pd.Series, y: pd.Series) -> pd.Series:
        one, two = (np.frombuffer(b"".join(map(bytes, s)), np.uint8).reshape(-1, HASHES) for s in (x, y))
        return pd.Series((one == two).sum(axis=1).astype(np.int32))

    near = attach(pairs.join(side("b"), "b"), hubs, ["a"], "n_hub")
    # the smaller set can hold at most all of the intersection
    near = near.filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * THRESHOLD).filter(agreeing("s_a", "s_b") >= AGREE)
    near = written(near.select("a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n_hub") / GROUP)).alias("salt")), "near-checked")
    text = texts.select("node", "text")
    members = near.join(text, near["b"] == text["node"]).select("a", "salt", "b", "text")
    heads = near.select("a", "salt").distinct().join(text, F.col("a") == F.col("node")).select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
    laid = heads.unionByName(members).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())

    def confirm(frames):
        hashes, rolling = WordHashes(), Rolling(SHINGLE)
        hub = None
        for f in frames:
            linked = []
            for a, b, t in zip(f["a"], f["b"], f["text"]):
                s = shingle_set(words_of(t, lower=True), hashes, rolling)
                if pd.isna(b):
                    hub = s                 # heads its members in the sorted partition
                    continue
                if _linked(hub, s):
                    linked.append((a, int(b)))
            yield pd.DataFrame(linked, columns=["a", "b"]).astype("int64")

    return written(laid.select("a", "b", "text").mapInPandas(confirm, "a long, b long"), "near-links")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept."""
    return _grouped(docs, id_col, text_col).select("doc_id", "n_shingles", "component_id", "kept")


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The text and ``row``, which tells documents apart: the id and a hash of the text."""
    return docs.select(F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("print")).alias("row"), F.col(text_col).alias("text"))


def _grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``near_groups`` with the hash of the text, print."""
    signed = written(signatures(_named(docs, id_col, text_col), "row", "text").select("doc_id.*", "n_shingles", "content", "bands", "signature"), "near-signatures")
    some = signed.filter("n_shingles > 0")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "print")))
    classes = some.groupBy("content").agg(first.alias("first"), F.count(F.lit(1)).alias("n"), F.first("n_shingles").alias("n_shingles"),
                                          F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    # the numbers hold once they are written
    classes = written(classes.select(F.monotonically_increasing_id().alias("node"), F.col("first.doc_id").alias("rep"), F.col("first.print").alias("print"),
                                     "content", "n", "n_shingles", "bands", "signature"), "near-classes")
    nodes = classes.filter(F.col("rep").isNotNull())
    bands = nodes.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.concat(
        F.unhex(F.lpad(F.hex(i), 2, "0")), F.substring("bands", i * 8 + 1, F.lit(8))))).alias("key"))
    buckets = written(bands.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("c")).filter("c > 1"), "near-buckets")
    placed = written(attach(bands, buckets, ["key"], "c"), "near-placed")      # rows that share a bucket with another
    pairs = placed.filter("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    texts = written(_texts_of(docs, nodes.join(placed.select("node").distinct(), "node", "left_semi"), id_col, text_col), "near-texts")
    links = verified(pairs, nodes, texts)
    found = written(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "near-components")
    for every in (False, True):
        more = across(placed, found, nodes, texts if every else None)
        more = written(more, "near-links") if every else verified(more.join(pairs, ["a", "b"], "left_anti"), nodes, texts)
        if more.isEmpty():
            continue
        # the stars found so far stand for the links they were made of
        joined = found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more.select(F.col("a").alias("u"), F.col("b").alias("v")))
        found = written(components(joined), "near-components")
    own = written(classes.select("node", "content", "rep", "n").join(found, "node", "left").select("content", "rep", "n", F.coalesce("component", "node").alias("comp")), "near-own-classes")
    least = F.min(F.when(F.col("rep").isNotNull(), F.struct("rep", "content")))
    heads = written(own.groupBy("comp").agg(least.alias("head"), F.count(F.lit(1)).alias("n_classes")), "near-heads")
    known = written(attach(own, heads, ["comp"], "n_classes")
                    .select("content", "n", F.col("head.rep").alias("component_id"), F.coalesce(F.col("head.content") == F.col("content"), F.lit(True)).alias("first")), "near-known")
    some = attach(some.select("doc_id", "print", "n_shingles", "content"), known, ["content"], "n").select("doc_id", "print", "n_shingles", "component_id", "first")
    none = signed.filter("n_shingles = 0").select("doc_id", "print", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
    return some.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")) & F.col("first")).drop("first")


def _texts_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """node and text of ``nodes``: the text of the class's smallest id that has the class's content."""
    texts = _named(docs, id_col, text_col).select(F.col("row.doc_id").cast("long").alias("rep"), F.col("row.print").alias("print"), "text")
    return texts.join(nodes.select("rep", "print", "node"), ["rep", "print"]).dropDuplicates(["rep", "print"]).select("node", "text")


def across(placed: DataFrame, found: DataFrame, nodes: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of members of one bucket in different components: of each
    stray the one whose signatures agree in most places, or with ``texts``
    every pair whose signatures agree and whose full sets are linked."""
    own = written(placed.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp")), "near-own")
    parts = own.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    still = parts.groupBy("key").agg(F.max_by("comp", "n").alias("top"), F.sum("n").alias("c"), F.max("n").alias("most"))
    # a bucket of two that is still open holds one pair, and that has been compared
    still = written(still.filter("c > most AND c > 2"), "near-open")
    rows = attach(own, still, ["key"], "c").join(nodes.select("node", "n_shingles", "bands", "signature"), "node")
    rows = rows.join(texts, "node") if texts is not None else rows.withColumn("text", F.lit(None).cast("string"))
    blocks, stray_blocks = F.ceil(F.col("c") / BLOCK).cast("int"), F.ceil((F.col("c") - F.col("most")) / BLOCK).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    at = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    kept = ["key", "node", "comp", "n_shingles", "bands", "signature", "text"]
    every = texts is not None
    members = rows.select(*kept, F.lit(False).alias("stray"), at(blocks).alias("x"), each(stray_blocks).alias("y"))
    strays = rows.filter("comp <> top").select(*kept, F.lit(True).alias("stray"), at(stray_blocks).alias("y"), each(blocks).alias("x"))

    def compare(t: pa.Table) -> pa.Table:
        node, comp, size = (t.column(c).to_numpy() for c in ("node", "comp", "n_shingles"))
        stray = t.column("stray").to_numpy(zero_copy_only=False)
        signature = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint8).reshape(-1, HASHES)
        bands = np.frombuffer(b"".join(t.column("bands").to_pylist()), np.uint64).reshape(-1, BANDS)
        band = t.column("key")[0].as_py()[0] if len(t) else 0
        m, s = np.flatnonzero(~stray), np.flatnonzero(stray)
        out, sets = [], {}
        hashes, rolling = WordHashes(), Rolling(SHINGLE)

        def full(k: int) -> np.ndarray:
            """The full set of a row's document, made when it is first needed."""
            if node[k] not in sets:
                sets[node[k]] = shingle_set(words_of(t.column("text")[int(k)].as_py(), lower=True), hashes, rolling)
            return sets[node[k]]

        for k in s:
            ok = m[(comp[m] != comp[k]) & (np.minimum(size[m], size[k]) * 100 >= np.maximum(size[m], size[k]) * THRESHOLD)]
            same = (signature[ok] == signature[k]).sum(axis=1)
            # a pair that shares several buckets is taken in the first of them
            take = (same >= AGREE) & ~(bands[ok, :band] == bands[k, :band]).any(axis=1)
            ok, same = ok[take], same[take]
            if every:
                linked = [_linked(full(k), full(j)) for j in ok]
                ok, same = ok[linked], same[linked]
            elif len(ok):
                ok, same = ok[[same.argmax()]], same[[same.argmax()]]
            out += [(int(node[k]), int(node[j]), int(n)) for j, n in zip(ok, same)]
        return pa.table([pa.array([o[c] for o in out], pa.int64()) for c in range(3)], ["s", "m", "same"])

    pairs = members.unionByName(strays).groupBy("key", "x", "y").applyInArrow(compare, "s long, m long, same long")
    if not every:
        pairs = pairs.groupBy("s").agg(F.max_by("m", F.struct("same", "m")).alias("m"))
    return pairs.select(F.least("s", "m").alias("a"), F.greatest("s", "m").alias("b")).distinct()


def near_dedup_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_groups(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one text of each near-duplicate group: the smallest id's (each row of it, if it repeats)."""
    kept = _grouped(docs).filter("kept").select(F.col("doc_id").alias("__id"), F.col("print").alias("__print")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__id"]) & (F.xxhash64(docs["text"]) == kept["__print"]), "left_semi")
