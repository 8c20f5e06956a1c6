"""SimHash near-duplicate groups: fingerprints linked by a binary trie self-join."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import balanced, local_roots, map_batches, materialize, sized_join, sized_lookup
from textloom.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# A trie with more leaves is cut into pairs of its nodes, each a group of its own.
TRIE_LEAVES = 8192
# Node pairs held at once; a larger frontier is walked in halves, depth first.
FRONTIER = 1 << 18
ROWS_AT_ONCE = 1 << 16


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of the word shingles of ``text``; zero without words."""
    words = text.encode().lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= width:
        return digest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: n - width + 1].tolist()
    counts = np.zeros(64, np.int64)
    stops = ends[width - 1 :].tolist()
    for at in range(0, len(starts), ROWS_AT_ONCE):
        part = zip(starts[at : at + ROWS_AT_ONCE], stops[at : at + ROWS_AT_ONCE])
        hashes = np.array([digest(joined[i:j], SEED) for i, j in part], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    value = np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")
    return int(value[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): the signed fingerprint of every row and a hash of its text.

    Null and wordless texts have fingerprint zero.
    """

    def run(columns):
        ids, hashes, texts = columns
        values = np.array([fingerprint(t, width) for t in texts], np.uint64)
        return [ids, hashes, pa.array(values.view(np.int64))]

    rows = balanced(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_batches(rows, run, "doc_id long, text_hash long, fp long", rows.columns)


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, bits) of ``max_bits + 1`` blocks: codes within the budget agree on one of them."""
    edges = [64 * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def trie_links(codes: np.ndarray, tries: list[tuple], bit: int, budget: int) -> Iterator[tuple]:
    """Index pairs of codes that differ in at most ``budget`` bits, by walking node pairs.

    ``codes`` is sorted within each trie. A frontier entry is a pair of nodes (index ranges) with
    the number of bits in which they differ so far; both nodes are split at the next bit, the
    children are paired, and a pair over the budget is dropped with everything below it.
    """
    ones: dict[int, np.ndarray] = {}  # by bit: codes before an index that have it set
    stack = [(bit, *(np.array(c, np.int64) for c in zip(*tries)))]
    while stack:
        bit, a0, a1, b0, b1, diff = stack.pop()
        single = (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            i, j = a0[single], b0[single]
            other = i != j
            i, j = i[other], j[other]
            near = np.bitwise_count(codes[i] ^ codes[j]) <= budget
            yield i[near], j[near]
            a0, a1, b0, b1, diff = (x[~single] for x in (a0, a1, b0, b1, diff))
        if not len(a0):
            continue
        if bit < 0:
            raise ValueError("equal codes in one trie")
        if len(a0) > FRONTIER:
            half = len(a0) // 2
            stack.append((bit, a0[half:], a1[half:], b0[half:], b1[half:], diff[half:]))
            stack.append((bit, a0[:half], a1[:half], b0[:half], b1[:half], diff[:half]))
            continue
        if bit not in ones:
            set_bits = ((codes >> np.uint64(bit)) & np.uint64(1)).astype(np.int32)
            ones[bit] = np.concatenate([[0], np.cumsum(set_bits, dtype=np.int32)])
        # Codes of a node agree above ``bit`` and are sorted: those with the bit set are its end.
        am = a1 - (ones[bit][a1] - ones[bit][a0])
        bm = b1 - (ones[bit][b1] - ones[bit][b0])
        same = (a0 == b0) & (a1 == b1)
        parts = []
        for x0, x1, y0, y1, cost in (
            (a0, am, b0, bm, 0),
            (am, a1, bm, b1, 0),
            (a0, am, bm, b1, 1),
            (am, a1, b0, bm, 1),
        ):
            keep = (x0 < x1) & (y0 < y1) & (diff + cost <= budget)
            if cost and x0 is am:
                keep &= ~same  # the mirror image of the pair before
            parts.append([z[keep] for z in (x0, x1, y0, y1, diff + cost)])
        stack.append((bit - 1, *(np.concatenate(z) for z in zip(*parts))))


def _links_in_partition(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1))
            size += len(batch)
            if size >= ROWS_AT_ONCE:
                rows = np.concatenate(held)
                keys = rows[:, :4]
                last = np.flatnonzero((keys != keys[-1]).any(1))
                cut = last[-1] + 1 if len(last) else 0
                if cut:
                    yield from solve(rows[:cut])
                held, size = [rows[cut:]], len(rows) - cut
        if size:
            yield from solve(np.concatenate(held))

    def solve(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys, codes = rows[:, :4], rows[:, 4].astype(np.int64).view(np.uint64)
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        ends = np.r_[starts[1:], len(rows)]
        by_bit: dict[int, list] = {}
        for s, e in zip(starts.tolist(), ends.tolist()):
            block, _, pair, depth = (int(x) for x in keys[s])
            bit = 63 - blocks(max_bits)[block][1]
            if depth:
                left, right = pair >> depth, pair & ((1 << depth) - 1)
                node = (codes[s:e] >> np.uint64(bit - depth + 1)) & np.uint64((1 << depth) - 1)
                cut = s + int(np.searchsorted(node, max(left, right))) if left != right else s
                apart = (left ^ right).bit_count()
                root = (s, cut, cut, e, apart) if left != right else (s, e, s, e, 0)
                if root[0] == root[1] or root[2] == root[3]:
                    continue
                by_bit.setdefault(bit - depth, []).append(root)
            elif e - s > 1:
                by_bit.setdefault(bit, []).append((s, e, s, e, 0))
        roots = np.arange(len(rows))
        for bit, tries in by_bit.items():
            for i, j in trie_links(codes, tries, bit, max_bits):
                roots = local_roots(roots, i, j)
        linked = np.flatnonzero(roots != np.arange(len(rows)))
        if len(linked):
            first = np.array([blocks(max_bits)[b][0] for b in range(max_bits + 1)], np.uint64)
            turn = first[keys[linked, 0].astype(np.int64)]
            back = [_rotate_right(codes[x], turn).view(np.int64) for x in (linked, roots[linked])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in back], names=["a", "b"])

    return run


def _rotate_right(codes: np.ndarray, turn: np.ndarray) -> np.ndarray:
    back = (np.uint64(64) - turn) & np.uint64(63)
    return (codes >> turn) | np.where(turn == 0, np.uint64(0), codes << back)


def fingerprint_links(codes: DataFrame, max_bits: int = MAX_BITS, leaves: int = TRIE_LEAVES) -> DataFrame:
    """Links (a, b) that join exactly the distinct fingerprints ``fp`` within ``max_bits`` bits.

    The code is cut into ``max_bits + 1`` blocks, one of which two linked codes share in full, so
    each block opens a trie per value in which the whole budget is left for the other bits. A
    trie of more than ``leaves`` codes is cut at its next bits: every code goes to the pairs of
    nodes within the budget that its node belongs to. Within one task links that close a circle
    are left out, so at most one link per code and trie is written.
    """
    rows = []
    for i, (first, bits) in enumerate(blocks(max_bits)):
        turned = f"(shiftleft(fp, {first}) | shiftrightunsigned(fp, {64 - first}))" if first else "fp"
        rows.append(f"struct({i}L AS block, shiftrightunsigned({turned}, {64 - bits}) AS value, {turned} AS code)")
    spread = codes.select(F.explode(F.expr(f"array({', '.join(rows)})")).alias("r")).select("r.*")
    bits = F.element_at(F.lit([b for _, b in blocks(max_bits)]), (F.col("block") + 1).cast("int"))
    hot = materialize(
        spread.groupBy("block", "value")
        .count()
        .filter(F.col("count") > leaves)
        .select(
            "block",
            "value",
            F.least(F.lit(10), F.ceil(F.log2(F.col("count") / leaves)) + 2).cast("long").alias("depth"),
        ),
        "hot-tries",
    )
    uncut = ["block", "value", F.lit(0).cast("long").alias("pair"), F.lit(0).cast("long").alias("depth"), "code"]
    # At most one row per ``leaves`` codes of a block: 30 bytes of it for 40 kB of codes.
    if not hot.isEmpty():
        spread = sized_join(spread, hot, ["block", "value"])
        node = F.expr("shiftrightunsigned(shiftleft(code, bits), 64 - cast(depth AS int))")
        split = spread.filter("depth IS NOT NULL").withColumn("bits", bits.cast("int")).withColumn("node", node)
        others = F.expr(
            f"filter(sequence(0L, shiftleft(1L, cast(depth AS int)) - 1), o -> bit_count(o ^ node) <= {max_bits})"
        )
        split = split.withColumn("other", F.explode(others)).select(
            "block",
            "value",
            F.expr("shiftleft(least(node, other), cast(depth AS int)) | greatest(node, other)").alias("pair"),
            "depth",
            "code",
        )
        spread = spread.filter("depth IS NULL").select(*uncut).unionByName(split)
    else:
        spread = spread.select(*uncut)
    # The codes of a trie share their top bits, the sign too, so signed order is their bit order.
    placed = spread.select("block", "value", "pair", "depth", "code")
    placed = placed.repartition("block", "value", "pair")
    ordered = placed.sortWithinPartitions("block", "value", "pair", "depth", "code")
    return ordered.mapInArrow(_links_in_partition(max_bits), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) per row of ``docs`` (doc_id, text).

    Fingerprints at ``max_bits`` or fewer differing bits are linked, and ``component_id`` is the
    smallest doc_id reachable over links. Null, empty and wordless texts have fingerprint zero
    and are linked with each other. Null ids are kept and never become a component id unless a
    component has no other; ``root``, a fingerprint of the component, tells components apart
    whatever their ids. Repeated rows fall into one component; an empty table gives no rows.
    """
    prints = materialize(fingerprints(docs, width), "fingerprints")
    codes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "codes")
    roots = components(fingerprint_links(codes, max_bits)).withColumnRenamed("node", "fp")
    codes = codes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = codes.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(codes.join(lowest, "root").select("fp", "root", "component_id"), "components")
    return sized_lookup(prints, named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def op1(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
