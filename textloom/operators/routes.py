"""A sparse matrix and its two factors as bytes, for fits that pass over them many times.

Documents lie in blocks and terms in slices. In a step a slice sends every block the factor rows of the
block's terms in one message and gets their sums back in another, so that neither joins nor sorts by
term are needed: where a term stands in a message is found once and kept.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.factors import ROW, block_numbers, columns, keyed, keyed_schema
from textloom.operators.vectors import BLOCK
from textloom.session import materialize

# Larger blocks share more terms, so fewer factor rows travel; a block is read into one task.
ENTRIES_PER_BLOCK = 1 << 23
# Entries of a block that are multiplied at once, and stored together.
PIECE = 1 << 19
MESSAGE = "slice long, of long, part binary"


@dataclass(frozen=True)
class Routes:
    """``cells`` holds the pieces of every block, placed by block.

    ``routes`` (slice, of, at), placed by slice, tells which rows of a slice a block needs; the row with
    -1 in ``of`` holds the term ids of the slice. ``numbers`` are those of blocks and of slices.
    """

    cells: DataFrame
    routes: DataFrame
    numbers: list[int]

    def dealt(self, part: Column) -> Column:
        return F.element_at(F.lit(self.numbers), part.cast("int") + 1).cast("long")

    def block(self) -> Column:
        """The block of a numbered row; copies and long ids spread evenly."""
        return self.dealt(F.pmod(F.xxhash64(ROW), F.lit(len(self.numbers))))

    def slice(self) -> Column:
        return self.dealt(F.col("term_id") % len(self.numbers))

    def unpersist(self) -> None:
        self.cells.unpersist()
        self.routes.unpersist()


def routes_of(rows: DataFrame) -> Routes:
    """Numbered stored ``rows`` in blocks of even numbers of entries; rows without any are left out."""
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    filled = rows.filter(F.size("indices") > 0)
    entries = filled.agg(F.sum(F.size("indices").cast("long"))).first()[0] or 0
    n = cores * max(1, -(-entries // (ENTRIES_PER_BLOCK * cores)))
    numbers = block_numbers(spark, n)

    limit = PIECE

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces as rows arrive, with places of terms in the order in which the block shows them.

        A block ends with the terms that it asks of each slice, and where these then stand.
        """

        def made(block: int, number: int | None, piece: int | None, *data: np.ndarray | None) -> pa.RecordBatch:
            values = [block, number, piece, *(d if d is None else d.tobytes() for d in data)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

        def cut(rows: list[pa.RecordBatch], piece: int) -> pa.RecordBatch:
            nonlocal place, shown
            own = np.concatenate([r.column(ROW).to_numpy() for r in rows])
            flat, x = (np.concatenate([r.column(c).flatten().to_numpy(zero_copy_only=False) for r in rows]) for c in ("indices", "values"))
            lengths = np.concatenate([r.column("indices").value_lengths().to_numpy(zero_copy_only=False) for r in rows])
            if flat.max() >= len(place):
                place = np.r_[place, np.full(flat.max() + 1 - len(place), -1, np.int32)]
            new = np.unique(flat[place[flat] < 0])
            place[new] = np.arange(shown, shown + len(new), dtype=np.int32)
            shown += len(new)
            ids.append(new)
            parts = own.astype(np.int64), lengths.astype(np.int32), place[flat], x.astype(np.float64)
            return made(rows[0].column(BLOCK)[0].as_py(), None, piece, *parts)

        def end(block: int) -> Iterator[pa.RecordBatch]:
            terms = np.concatenate(ids)
            order = np.lexsort((terms, terms % n))
            stands = np.empty(len(terms), np.int32)
            stands[order] = np.arange(len(terms), dtype=np.int32)
            yield made(block, None, -1, None, None, stands, None)
            terms = terms[order]
            bounds = np.searchsorted(terms % n, np.arange(n + 1))
            for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                if a < b:
                    yield made(block, numbers[i], None, None, None, terms[a:b].astype(np.int64), None)

        place, shown, ids = np.zeros(0, np.int32), 0, []
        block, rows, entries, piece = None, [], 0, 0
        for batch in batches:
            of, sizes = batch.column(BLOCK).to_numpy(), batch.column("indices").value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes, dtype=np.int64)
            # A batch is cut where a block ends, and into runs of at most about as many entries as a piece has.
            cuts = np.flatnonzero(np.diff(of) | np.diff((ends - sizes) // limit)) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(of)]):
                if a == b:
                    continue
                if rows and (of[a] != block or entries >= limit):
                    yield cut(rows, piece)
                    rows, entries, piece = [], 0, piece + 1
                if block is not None and of[a] != block:
                    yield from end(block)
                    place, shown, ids, piece = np.full(len(place), -1, np.int32), 0, [], 0
                block = int(of[a])
                rows.append(batch.slice(a, b - a))
                entries += int(sizes[a:b].sum())
        if rows:
            yield cut(rows, piece)
        if block is not None:
            yield from end(block)

    names = [BLOCK, "slice", "piece", "rows", "lengths", "at", "entries"]
    types = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
    schema = f"{BLOCK} long, slice long, piece int, rows binary, lengths binary, at binary, entries binary"
    whole = Routes(rows, rows, numbers)
    dealt = filled.select(whole.block().alias(BLOCK), ROW, "indices", "values").repartition(n, BLOCK)
    packed = materialize(dealt.sortWithinPartitions(BLOCK, ROW).mapInArrow(pack, schema), "packed-rows")

    def route(table: pa.Table) -> pa.Table:
        given = [np.frombuffer(b, np.int64) for b in table.column("at").to_pylist()]
        ids = np.unique(np.concatenate(given))
        at = [ids.tobytes(), *(np.searchsorted(ids, g).astype(np.int32).tobytes() for g in given)]
        of = [-1, *table.column(BLOCK).to_pylist()]
        number = table.column("slice")[0].as_py()
        return pa.table({"slice": pa.array([number] * len(of), pa.int64()), "of": pa.array(of, pa.int64()), "at": pa.array(at, pa.binary())})

    asked = packed.filter("slice IS NOT NULL").select("slice", BLOCK, "at")
    found = asked.groupBy("slice").applyInArrow(route, "slice long, of long, at binary")
    cells = packed.filter("slice IS NULL").drop("slice").repartition(n, BLOCK).sortWithinPartitions(BLOCK, "piece")
    placed = found.repartition(n, "slice").sortWithinPartitions("slice", "of")
    return Routes(*(t.persist(StorageLevel.MEMORY_AND_DISK) for t in (cells, placed)), numbers)


def numbers_in(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The numbers of all binary values of a column, one after the other."""
    views = [np.frombuffer(b.as_buffer(), kind) for b in column if b.is_valid]
    return views[0] if len(views) == 1 else np.concatenate(views or [np.zeros(0, kind)])


def messages(slices: list[int], of: list[int], parts: list[np.ndarray], **others) -> pa.Table:
    """The parts are copied once, into the buffer that is sent."""
    data = {"slice": pa.array(slices, pa.int64()), "of": pa.array(of, pa.int64())}
    ends = np.cumsum([0, *(p.nbytes for p in parts)])
    flat = np.empty(ends[-1], np.uint8)
    for part, a, b in zip(parts, ends, ends[1:]):
        flat[a:b].view(part.dtype).reshape(part.shape)[...] = part
    lists = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)])
    return pa.table(data | {"part": lists.cast(pa.binary())} | others)


def term_ids(x: Routes) -> DataFrame:
    """(term_id) of all terms that occur in the rows."""

    def run(batches):
        for batch in batches:
            for ids in batch.column("at").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, np.int64))], names=["term_id"])

    return x.routes.filter("of = -1").mapInArrow(run, "term_id long")


def rows_of(keys: np.ndarray, key: str, table: pa.Table, k: int) -> np.ndarray:
    """(keys, k) of a factor table; keys without a row get zeros."""
    ids = table.column(key).to_numpy()
    order = np.argsort(ids)
    values = np.stack([table.column(c).to_numpy() for c in columns(k)], axis=1)[order]
    at = np.searchsorted(ids[order], keys)
    known = np.append(ids[order], -1)[at] == keys
    return np.where(known[:, None], np.r_[values, np.zeros((1, k))][at], 0.0)


def term_slices(x: Routes, table: DataFrame, k: int) -> DataFrame:
    """A term factor (term_id, c0..) by slice; of its terms those that occur in the rows are kept."""

    def run(own: pa.Table, given: pa.Table) -> pa.Table:
        if not own.num_rows:
            return messages([], [], [])
        ids = np.frombuffer(own.column("at")[0].as_py(), np.int64)
        return messages([own.column("slice")[0].as_py()], [-1], [rows_of(ids, "term_id", given, k)])

    given = table.select(x.slice().alias("slice"), F.col("term_id").cast("long").alias("term_id"), *columns(k))
    return x.routes.filter("of = -1").groupBy("slice").cogroup(given.groupBy("slice")).applyInArrow(run, MESSAGE)


def row_blocks(x: Routes, table: DataFrame, k: int) -> DataFrame:
    """A factor of the numbered rows (``ROW``, c0..) by block."""

    def run(own: pa.Table, given: pa.Table) -> pa.Table:
        if not own.num_rows:
            return messages([], [], [])
        numbers = numbers_in(own.column("rows"), np.int64)
        return messages([-1], [own.column(BLOCK)[0].as_py()], [rows_of(numbers, ROW, given, k)])

    given = table.select(x.block().alias("of"), ROW, *columns(k))
    return x.cells.select(BLOCK, "piece", "rows").groupBy(BLOCK).cogroup(given.groupBy("of")).applyInArrow(run, MESSAGE)


def term_rows(x: Routes, slices: DataFrame, k: int) -> DataFrame:
    """(term_id, c0..) of a term factor by slice."""

    def run(own: pa.Table, given: pa.Table) -> pa.Table:
        ids = numbers_in(own.column("at"), np.int64)
        return keyed("term_id", ids, numbers_in(given.column("part"), np.float64).reshape(-1, k))

    ids = x.routes.filter("of = -1").groupBy("slice")
    return ids.cogroup(slices.select("slice", "part").groupBy("slice")).applyInArrow(run, keyed_schema("term_id", k))


def numbered_rows(x: Routes, blocks: DataFrame, k: int) -> DataFrame:
    """(id, c0..) of a factor of the rows by block, ``id`` being their number."""

    def run(own: pa.Table, given: pa.Table) -> pa.Table:
        numbers = numbers_in(own.sort_by("piece").column("rows"), np.int64)
        return keyed("id", numbers, numbers_in(given.column("part"), np.float64).reshape(-1, k))

    own = x.cells.select(BLOCK, "piece", "rows").groupBy(BLOCK)
    return own.cogroup(blocks.select("of", "part").groupBy("of")).applyInArrow(run, keyed_schema("id", k))


def sent(x: Routes, h: DataFrame, k: int) -> DataFrame:
    """For every block and slice the factor rows of the block's terms."""

    def run(own: pa.Table, given: pa.Table) -> pa.Table:
        factor = numbers_in(given.column("part"), np.float64).reshape(-1, k)
        own = own.filter(pc.greater_equal(own.column("of"), 0))
        parts = [factor[np.frombuffer(at, np.int32)] for at in own.column("at").to_pylist()]
        return messages(own.column("slice").to_pylist(), own.column("of").to_pylist(), parts)

    return x.routes.groupBy("slice").cogroup(h.select("slice", "part").groupBy("slice")).applyInArrow(run, MESSAGE)


class BlockCells:
    """The pieces of a block beside the factor rows that the slices sent, and the old rows of its documents."""

    def __init__(self, cells: pa.Table, given: pa.Table, numbers: list[int], k: int):
        self.number, self.k = cells.column(BLOCK)[0].as_py(), k
        self.cells = {i: n for n, i in enumerate(cells.column("piece").to_pylist())}
        self.data = {c: cells.column(c) for c in ("lengths", "at", "entries")}
        rank = {number: i for i, number in enumerate(numbers)}
        # Views of what came, which is not copied.
        parts = {s: np.frombuffer(p.as_buffer(), np.float64).reshape(-1, k) for s, p in zip(given.column("slice").to_pylist(), given.column("part"), strict=True)}
        self.old = parts.pop(-1, None)
        self.slices = sorted(parts, key=rank.__getitem__)
        factor = [parts[s] for s in self.slices]
        self.bounds = np.cumsum([len(f) for f in factor])
        # Where each term of the pieces stands among those of the slices.
        self.stands = np.frombuffer(self.data["at"][self.cells.pop(-1)].as_buffer(), np.int32)
        # One contiguous row per column of the factor.
        self.factor = np.empty((k, len(self.stands)))
        for c, column in enumerate(self.factor):
            column[:] = np.concatenate([f[:, c] for f in factor])[self.stands]

    def arrays(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Entries per document, their places in the factor and their values, piece by piece."""
        kinds = {"lengths": np.int32, "at": np.int32, "entries": np.float64}
        for _, i in sorted(self.cells.items()):
            yield tuple(np.frombuffer(self.data[c][i].as_buffer(), kind) for c, kind in kinds.items())

    def by_slice(self, sums: np.ndarray) -> list[np.ndarray]:
        """Sums (k, terms) as one (terms, k) array per slice."""
        out = np.empty((len(self.stands), self.k))
        for c, column in enumerate(sums):
            out[self.stands, c] = column
        return np.split(out, self.bounds[:-1])

    def updated(self, new_rows) -> tuple[np.ndarray, list[np.ndarray]]:
        """New rows by ``new_rows(old, product)`` and the sums of the transposed cells times them, by slice."""
        sums, new, first = np.zeros(self.factor.shape), [], 0
        for lengths, at, x in self.arrays():
            n = len(lengths)
            row = np.repeat(np.arange(n, dtype=np.int32), lengths)
            product = np.stack([np.bincount(row, x * f[at], n) for f in self.factor], axis=1)
            new.append(new_rows(self.old[first : first + n], product))
            for total, g in zip(sums, new[-1].T.copy(), strict=True):
                total += np.bincount(at, x * g[row], len(total))
            first += n
        return np.concatenate(new), self.by_slice(sums)
