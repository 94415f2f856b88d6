"""Substring dedup: fixed-block anchors, rolling probes, extension to maximal repeats.

A word is removed if a window of WINDOW words covers it whose word sequence
also starts somewhere else, in the same document or another.

1. Reference blocks of BLOCK words at every BLOCK-th place of a document are
   the index; the hashes of all runs of BLOCK words probe it.  As
   WINDOW >= 2 * BLOCK - 1, each window holds a whole reference block, so of
   two equal windows each holds a run that equals a block of the other.
   A run that occurs again and equals a block is an anchor.
2. Only the windows around anchors are looked at again: a window is repeated
   if its own hash occurs again (64 bits, and a second hash that chooses the
   part: with P parts, equal hashes of unequal windows have a chance of one in
   P * 2^64 a pair).  Neighbouring repeated windows merge
   into maximal exact repeats, which are removed.  Extension by counting needs
   no pairs of occurrences, so a passage in a third of all documents costs as
   much as any other text of its length.

Hashes travel in packed arrays, not rows: a task deals those of its documents
into parts by hash; the task of a part finds the repeated ones and sends the
places back to their documents.  A hash that a task sees more than once is
known to be repeated, is answered there and sent once, so a hot one has one
entry per task.  The documents are shuffled once and read twice.

Defined cases: a null text has no words; documents shorter than a window keep
all words; rows that repeat a text repeat its windows; rows that repeat an id
are judged each by its own text; a null id is an id; an empty table gives no
rows; extra columns are never read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.packed import planes, unplanes
from pitlake.llm.texts import slices
from pitlake.llm.words import BASE, Rolling, WordHashes, words_of

WINDOW = 35
#: bytes of text behind one part of the hashes and in one part of the documents, characters a task handles at a time
PART_BYTES, DOC_BYTES, CHUNK = 12_000_000, 8_000_000, 4_000_000
NULL_ID = -(1 << 63)
#: packed arrays of entries (kind 0) and answers (kind 1)
PACKED = "part int, kind int, dest int, hashes binary, flags binary, ids binary, prints binary, counts binary, places binary"
NAMES = [c.split()[0] for c in PACKED.split(", ")]
KINDS = [pa.int32()] * 3 + [pa.binary()] * 6


def _table(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(KINDS)], NAMES)


def by_document(owner: np.ndarray, places: np.ndarray, ids: np.ndarray, prints: np.ndarray) -> tuple:
    """Places packed with the id and print of their documents; ``owner`` is sorted."""
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, int)
    return (ids[owner[starts]].astype("<i8").tobytes(), prints[owner[starts]].astype("<u8").tobytes(),
            np.diff(np.append(starts, len(owner))).astype("<u4").tobytes(), planes(places, 4))


def places_of(rows: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Id, print and place of every packed entry."""
    join = lambda c, t: np.frombuffer(b"".join(rows[c]), t)
    counts = join("counts", "<u4")
    return np.repeat(join("ids", "<i8"), counts), np.repeat(join("prints", "<u8"), counts), unplanes(rows["places"], 4).astype(np.int64)


def answers(owner: np.ndarray, places: np.ndarray, ids: np.ndarray, prints: np.ndarray, parts: int, part: int | None = None) -> list[tuple]:
    """Rows that carry places back to the parts of their documents."""
    dest = np.mod(ids[owner], parts) if len(owner) else owner
    order = np.lexsort((places, owner, dest))
    owner, places, dest = owner[order], places[order], dest[order]
    cut = np.flatnonzero(np.r_[True, dest[1:] != dest[:-1], True]) if len(dest) else np.zeros(1, int)
    return [(int(dest[a]) if part is None else part, 1, int(dest[a]), b"", b"", *by_document(owner[a:z], places[a:z], ids, prints))
            for a, z in zip(cut[:-1], cut[1:])]


def deal(h: np.ndarray, part: np.ndarray, block: np.ndarray, owner: np.ndarray, places: np.ndarray, ids: np.ndarray, prints: np.ndarray,
         hash_bytes: int, doc_parts: int) -> list[tuple]:
    """A task's rows: answers for the hashes it saw more than once, one entry for every hash, in its part."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, int)
    sizes = np.diff(np.append(starts, len(s)))
    known = np.repeat(sizes > 1, sizes)
    rows = answers(owner[order][known], places[order][known], ids, prints, doc_parts)
    # flags: 1 = a reference block, 2 = needs no answer
    flag = np.zeros(len(h), np.uint8)
    first = order[starts]
    if len(first):
        flag[first] = np.maximum.reduceat(block[order].astype(np.uint8), starts) | np.where(sizes > 1, 2, 0).astype(np.uint8)
    keep = np.zeros(len(h), bool)
    keep[first] = True
    at = np.flatnonzero(keep)
    at = at[np.argsort(part[at], kind="stable")]
    cut = np.flatnonzero(np.r_[True, part[at][1:] != part[at][:-1], True]) if len(at) else np.zeros(1, int)
    for a, z in zip(cut[:-1], cut[1:]):
        k = at[a:z]
        k = np.concatenate([k[flag[k] < 2], k[flag[k] >= 2]])
        asked = k[flag[k] < 2]
        rows.append((int(part[k[0]]), 0, -1, planes(h[k], hash_bytes), np.packbits(flag[k] & 1).tobytes(), *by_document(owner[asked], places[asked], ids, prints)))
    return rows


def find_repeated(rows: dict, hash_bytes: int, need_block: bool, doc_parts: int) -> list[tuple]:
    """A part's answers: places of entries whose hash another entry has (one of them a block, if needed)."""
    h = unplanes(rows["hashes"], hash_bytes)
    if not len(h):
        return []
    sizes = [len(b) // hash_bytes for b in rows["hashes"]]
    block = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=n) for f, n in zip(rows["flags"], sizes)])
    ids, prints, places = places_of(rows)
    # entries that want an answer come first in each row; number them as the places are
    asked = [int(np.frombuffer(c, "<u4").sum()) for c in rows["counts"]]
    number = np.concatenate([np.r_[np.arange(a), np.full(n - a, -1 << 40)] + o for a, n, o in zip(asked, sizes, np.cumsum([0, *asked]))])
    order = np.argsort(h, kind="stable")
    starts = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
    runs = np.diff(np.append(starts, len(h)))
    hit = runs > 1
    if need_block:
        hit &= np.maximum.reduceat(block[order], starts) > 0
    found = number[order][np.repeat(hit, runs)]
    found = found[found >= 0]
    # one document per (id, print): number them
    key = np.stack([ids[found].astype(np.uint64), prints[found]], 1) if len(found) else np.zeros((0, 2), np.uint64)
    documents, owner = np.unique(key, axis=0, return_inverse=True) if len(found) else (key, np.zeros(0, int))
    return answers(owner.ravel(), places[found], documents[:, 0].astype(np.int64), documents[:, 1], doc_parts)


def _exchange(entries: DataFrame, hash_bytes: int, need_block: bool, doc_parts: int) -> DataFrame:
    """The answers to all entries, and those that came with them."""
    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        asked = table.filter(pa.array(kind == 0))
        rows = find_repeated({c: asked.column(c).to_pylist() for c in NAMES[3:]}, hash_bytes, need_block, doc_parts)
        return pa.concat_tables([table.filter(pa.array(kind == 1)), _table(rows)])

    return entries.groupBy("part").applyInArrow(run, PACKED)


def _prime(n: int) -> int:
    while any(n % k == 0 for k in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


def _answered(table: pa.Table, by_print: bool) -> dict:
    """Places answered to each id (and print)."""
    rows = {c: table.column(c).to_pylist() for c in ("ids", "prints", "counts", "places")}
    ids, prints, places = places_of(rows)
    if not by_print:
        prints = np.zeros(len(ids), np.uint64)
    order = np.lexsort((prints, ids))
    ids, prints, places = ids[order], prints[order], places[order]
    cut = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (prints[1:] != prints[:-1]), True]) if len(ids) else np.zeros(1, int)
    return {(int(ids[a]), int(prints[a])): places[a:z] for a, z in zip(cut[:-1], cut[1:])}


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document, with ``texts`` also the kept text."""
    block = (window + 1) // 2
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    least = docs.sparkSession.sparkContext.defaultParallelism
    parts, doc_parts = max(least, math.ceil(total / PART_BYTES)), _prime(max(least, math.ceil(total / DOC_BYTES), 2))
    kind = docs.schema[id_col].dataType.simpleString()
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))
    named = docs.select(F.col(id_col).alias("doc_id"), key.alias("key"), F.col(text_col).alias("text"))

    def probe(batches):
        hashes, rolling = WordHashes(), Rolling(block)
        for b in batches:
            keys, texts_ = b.column(0).to_numpy(), [t or "" for t in b.column(1).to_pylist()]
            for a, z in slices(texts_, CHUNK):
                found = [rolling(hashes.of(words)) if len(words) >= window else np.zeros(0, np.uint64) for words in map(words_of, texts_[a:z])]
                n = np.array([len(f) for f in found])
                places = np.concatenate([np.arange(x) for x in n])
                h = np.concatenate(found)
                rows = deal(h, (h >> np.uint64(40)) % np.uint64(parts), places % block == 0, np.repeat(np.arange(z - a), n), places,
                            keys[a:z], np.zeros(z - a, np.uint64), 5, doc_parts)
                yield from _table(rows).to_batches()

    anchors = _exchange(named.select("key", "text").mapInArrow(probe, PACKED), 5, True, doc_parts)
    laid = named.withColumn("dest", F.pmod("key", F.lit(doc_parts)).cast("int"))

    def extend(_, left: pa.Table, right: pa.Table) -> pa.Table:
        answered = _answered(right, False)
        hashes, one, two = WordHashes(), Rolling(window), Rolling(window, BASE ^ 0x5DEECE66D << 16)
        h1, h2, owner, places, prints = [], [], [], [], []
        keys = left.column("key").to_numpy()
        for k, (i, t) in enumerate(zip(keys.tolist(), left.column("text"))):
            at = answered.get((i, 0)) if t.is_valid else None
            prints.append(0)
            if at is None:
                continue
            text = t.as_py()
            words = words_of(text)
            n = len(words) - window + 1
            if n <= 0:
                continue
            # windows that hold an anchor
            near = np.zeros(n + 1, np.int64)
            np.add.at(near, np.clip(at - (window - block), 0, n), 1)
            np.add.at(near, np.clip(at + 1, 0, n), -1)
            start = np.flatnonzero(np.cumsum(near[:-1]) > 0)
            h = hashes.of(words)
            h1.append(one(h)[start])
            h2.append(two(h)[start] % np.uint64(parts))
            owner.append(np.full(len(start), k))
            places.append(start)
            prints[k] = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
        if not h1:
            return _table([])
        h1, part, owner, places = map(np.concatenate, (h1, h2, owner, places))
        return _table(deal(h1, part, np.zeros(len(h1), bool), owner, places, keys, np.array(prints, np.uint64), 8, doc_parts))

    by_dest = lambda df: df.groupBy("dest")
    windows = by_dest(laid).cogroup(by_dest(anchors)).applyInArrow(extend, PACKED)
    repeated = _exchange(windows, 8, False, doc_parts)

    def cut(_, left: pa.Table, right: pa.Table) -> pa.Table:
        answered = _answered(right, True)
        out = []
        for i, t in zip(left.column("key").to_pylist(), left.column("text")):
            text = t.as_py() or ""
            words = words_of(text)
            n = len(words)
            at = answered.get((i, xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")))) if n >= window else None
            if at is not None:
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                words = [w for w, c in zip(words, np.cumsum(edge[:-1]).tolist()) if not c]
            kept = b" ".join(words)
            out.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass") if texts else None))
        columns = [left.column("doc_id"), *(pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string())))]
        return pa.table(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    done = by_dest(laid).cogroup(by_dest(repeated)).applyInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return done if texts else done.drop("kept_text")


def substring_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return remove_repeats(docs)
