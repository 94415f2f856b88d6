"""SimHash near-dedup through a segment-popcount embedding.

1. One pass makes each document's 64-bit fingerprint; equal fingerprints form
   a class, and only distinct fingerprints go on.
2. A fingerprint becomes a point: the number of set bits in each of its 32
   segments of two bits.  The Manhattan distance of two points is at most the
   Hamming distance of their fingerprints, so fingerprints that differ in four
   bits or fewer are points at distance four or less.
3. The points are joined over a grid whose cells are count vectors.  The
   coordinates lie in two parts, WIDE (18) and NARROW (14).  At distance four
   or less two points are at distance two or less in WIDE, or at one or less
   in NARROW (3 + 2 is more than 4).  In WIDE each point enters its own cell
   and those one step away: two points at distance two have a cell in common
   half way.  In NARROW it enters its own cell and those one step up: of two
   points at distance one, the upper one is at home where the lower one calls.
4. Inside a cell the pairs are verified on the fingerprints.  Each cell gives
   a spanning forest of its links, so never more rows than it has entries:
   small cells are compared by shifts of the sorted rows, large ones by a
   search that compares each reached fingerprint with those not yet reached.
   Every entry is sent once, to the task that holds its cell; those alone in a
   cell are left out there, so the rows that move grow with the fingerprints
   and not with how many of them meet.
   A cell over BLOCK entries is dealt in pairs of blocks to several tasks; it
   has BLOCKS blocks at most, so an entry travels BLOCKS times at most and the
   rows dealt grow with the entries, however large a cell is.  No other entry is copied.
5. Components of the forest's links are those of all links; each document
   gets the smallest id of its component.

A point makes some 40 entries of 25 bytes; of N unrelated fingerprints one
meets about N / 30,000 in its cells.

Defined cases: a null or empty text, or one without words, has fingerprint
zero and is linked like any other; fewer than four words make one shingle; a
bit set in exactly half of the shingles is 0; texts of any length are read
whole (memory holds one text's shingle hashes); equal texts and repeated rows
share a fingerprint and get the same component; a null id is linked by its
text but names no component, and a component of null ids alone has a null id;
an empty table gives no rows; extra columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import attach, written
from pitlake.llm.components import components
from pitlake.llm.runs import starts, whole_runs
from pitlake.llm.texts import over_texts
from pitlake.llm.words import words_of

SHINGLE, SEED, DIFFER = 4, 42, 4
#: segments of two bits in each part of the coordinates; radii 2 and 1
WIDE, NARROW = 18, 14
#: entries of a cell that one task compares with as many others; blocks of a cell at most; entries of a cell compared by shifts
BLOCK, BLOCKS, SMALL = 2048, 16, 12
#: the lower bit of each segment
LOW_BITS = 0x5555555555555555
#: shingle hashes whose bits are counted at a time
STEP = 65_536


def fingerprint(words: list[bytes]) -> int:
    """Bit by bit the majority of the shingles' hashes, as a signed 64-bit integer."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(ends[:-1] + 1).tolist()]
    last = ends[SHINGLE - 1:].tolist() or [len(joined)]
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:z], SEED) for a, z in zip(begins, last)), np.uint64, len(last))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), STEP):
        ones += np.unpackbits(hashes[at:at + STEP].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (signed 64 bits) of every document."""

    def make():
        return lambda texts: {"fp": [fingerprint(words_of(t, lower=True)) for t in texts]}

    return over_texts(docs, id_col, text_col, make, {"fp": "long"})


def counts(fp: Column) -> Column:
    """The number of set bits of each segment, in the segment's place."""
    even, odd = fp.bitwiseAND(F.lit(LOW_BITS)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW_BITS))
    return even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))


def _step(cell: Column, segment: int, up: bool) -> tuple[Column, Column]:
    """Whether ``cell`` has a neighbour one step up (or down) in a segment, and the neighbour."""
    one, two, three = (F.lit(k << 2 * segment) for k in (1, 2, 3))
    able = cell.bitwiseAND(two) == 0 if up else cell.bitwiseAND(three) != 0
    # 0 and 1 differ in the lower bit, 1 and 2 in both
    with_one = cell.bitwiseAND(one) == (0 if up else one)
    return able, cell.bitwiseXOR(F.when(with_one, one).otherwise(three))


def entries(points: DataFrame) -> DataFrame:
    """band, cell, fp and home for every cell that a point (fp) enters; two
    points of a cell are to be compared if one of them is at home there."""
    vector = counts(F.col("fp"))
    wide, narrow = vector.bitwiseAND(F.lit((1 << 2 * WIDE) - 1)), F.shiftrightunsigned(vector, 2 * WIDE)
    base = points.select("fp", wide.alias("w"), narrow.alias("n"))

    def entry(band: int, home: bool, cell: Column) -> Column:
        return F.struct(F.lit(band).alias("band"), cell.alias("cell"), F.lit(home).alias("home"))

    entered = [entry(0, True, F.col("w")), entry(1, True, F.col("n"))]
    for band, home, cell, segment, up in [*((0, True, F.col("w"), s, up) for s in range(WIDE) for up in (True, False)),
                                          *((1, False, F.col("n"), s, True) for s in range(NARROW))]:
        able, next_cell = _step(cell, segment, up)
        entered.append(F.when(able, entry(band, home, next_cell)))
    return base.select("fp", F.explode(F.array_compact(F.array(*entered))).alias("e")).select("e.band", "e.cell", "fp", "e.home")


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= DIFFER


def _search(fp: np.ndarray, home: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of one cell's links, breadth first."""
    out, rest, ahead = [], np.arange(len(fp)), []
    while len(rest):
        if not ahead:
            ahead, rest = [int(rest[0])], rest[1:]
        i = ahead.pop()
        hit = near(fp[rest], fp[i]) & (home[i] | home[rest])
        if hit.any():
            found, rest = rest[hit], rest[~hit]
            out.append((np.full(len(found), fp[i]), fp[found]))
            ahead += found.tolist()
    return out


def cell_links(at: np.ndarray, fp: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the links of each cell connect; ``at`` holds the places at which cells begin."""
    sizes = np.diff(np.append(at, len(fp)))
    a, b = [fp[:0]], [fp[:0]]
    for s, n in zip(at[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        for x, y in _search(fp[s:s + n], home[s:s + n]):
            a.append(x)
            b.append(y)
    owner = np.repeat(np.where((sizes > 1) & (sizes <= SMALL), np.arange(len(at)), -1), sizes)
    rows = np.flatnonzero(owner >= 0)
    fp, home, owner = fp[rows], home[rows], owner[rows]
    for k in range(1, min(SMALL, len(fp))):
        ok = (owner[:-k] == owner[k:]) & (home[:-k] | home[k:])
        ok[ok] = near(fp[:-k][ok], fp[k:][ok])
        a.append(fp[:-k][ok])
        b.append(fp[k:][ok])
    return np.concatenate(a), np.concatenate(b)


def links(points: DataFrame) -> DataFrame:
    """u, v: links between distinct fingerprints (fp) that connect all which differ in DIFFER bits or fewer."""
    laid = written(entries(points), "simhash-entries")
    cell, block = ["band", "cell"], F.lit(0)
    large = written(laid.groupBy(*cell).agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > BLOCK), "simhash-cells")
    if large.isEmpty():
        dealt = laid.select(*cell, block.alias("x"), block.alias("y"), "fp", "home")
    else:
        # large cells are at most a BLOCK-th of the entries
        large = F.broadcast(large)
        dealt = laid.join(large, cell, "left_anti").select(*cell, block.alias("x"), block.alias("y"), "fp", "home")
        blocks = F.least(F.ceil(F.col("c") / BLOCK), F.lit(BLOCKS)).cast("int")
        own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
        # in a pair of blocks (x, y), x <= y, lie the entries of block x and of block y
        pair = F.transform(F.sequence(F.lit(0), blocks - 1), lambda k: F.struct(F.least(own, k).alias("x"), F.greatest(own, k).alias("y")))
        copies = laid.join(large, cell).select(*cell, "fp", "home", F.explode(pair).alias("p"))
        dealt = dealt.unionByName(copies.select(*cell, "p.x", "p.y", "fp", "home"))
    keys = ["cell", "band", "x", "y"]

    def run(batches):
        for t in whole_runs(batches, keys):
            fp = t.column("fp").to_numpy().view(np.uint64)
            a, b = cell_links(starts(t, keys), fp, t.column("home").to_numpy().astype(bool))
            if len(a):
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, k].view(np.int64)) for k in range(2)], ["u", "v"])

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "u long, v long")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits) and component_id."""
    rows = written(fingerprints(docs, id_col, text_col), "simhash-rows")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "simhash-classes")
    found = components(links(classes.select("fp")))
    own = written(classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", "n", F.coalesce("component", "fp").alias("comp")), "simhash-own")
    heads = written(own.groupBy("comp").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("n_classes")), "simhash-heads")
    named = written(attach(own, heads, ["comp"], "n_classes").select("fp", "n", "component_id"), "simhash-named")
    return attach(rows, named, ["fp"], "n").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return simhash_groups(docs)
