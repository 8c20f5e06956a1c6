"""Benchmark decontamination: a broadcast set of test n-grams and a scan of training windows."""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import balanced, materialize

NGRAM = 10
# Test items are taken in blocks of about this much text; its windows take some eight times as much.
BLOCK_BYTES = 16 << 20
# After ASCII lower-casing these bytes are the characters of words, in UTF-8 too.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
FOLD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode().lower()) if text else []


class NgramSet:
    """The distinct windows of a block of test items as arrays, with the items that hold them."""

    def __init__(self, items: list[tuple[str, str | None]], n: int):
        self.names = sorted({item for item, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        self.ids: dict[bytes, int] = {}
        rows, owners = defaultdict(list), defaultdict(list)
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            size = min(n, len(words))
            flat = np.array([self.ids.setdefault(w, len(self.ids)) for w in words], np.int32)
            rows[size].append(np.lib.stride_tricks.sliding_window_view(flat, size))
            owners[size].append(np.full(len(flat) - size + 1, number[item], np.int32))
        self.sets = [self.indexed(np.concatenate(rows[s]), np.concatenate(owners[s])) for s in sorted(rows)]

    @classmethod
    def indexed(cls, rows: np.ndarray, owner: np.ndarray) -> tuple:
        """(hashes, windows, first, owners): windows by hash, ``owners[first[i]:first[i + 1]]`` hold window i."""
        windows, which = np.unique(rows, axis=0, return_inverse=True)
        hashes = cls.rolled(windows.T)
        order = np.argsort(hashes, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        pairs = np.unique(np.stack([place[which.reshape(-1)], owner]), axis=1)
        first = np.searchsorted(pairs[0], np.arange(len(order) + 1))
        return hashes[order], windows[order], first, pairs[1]

    @staticmethod
    def rolled(ids: np.ndarray) -> np.ndarray:
        """Hash of each column of word ids."""
        value = np.zeros(ids.shape[1], np.uint64)
        for row in ids:
            value = (value ^ row.astype(np.uint64)) * FOLD
            value ^= value >> np.uint64(29)
        return value

    def hits(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """(first word, size, items) of every window of ``words`` in the set, verified by word ids."""
        get = self.ids.get
        ids = np.array([get(w, -1) for w in words], np.int32)
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        found = []
        for hashes, windows, first, owners in self.sets:
            size = windows.shape[1]
            if len(ids) < size:
                continue
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            value = self.rolled(np.stack([ids[at + i] for i in range(size)]))
            low, high = (np.searchsorted(hashes, value, side) for side in ("left", "right"))
            for i, lo, hi in zip(*(a[high > low].tolist() for a in (at, low, high))):
                for slot in range(lo, hi):
                    if np.array_equal(windows[slot], ids[i : i + size]):
                        held = owners[first[slot] : first[slot + 1]].tolist()
                        found.append((i, size, [self.names[o] for o in held]))
        return found


def blocks_of(benchmark: DataFrame, limit: int) -> list[DataFrame]:
    """The distinct test items in parts of about ``limit`` bytes each, by a hash of the whole item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    items = materialize(items.filter("text IS NOT NULL").distinct(), "items")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-int(total) // limit)
    if parts <= 1:
        return [items]
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    return [items.filter(part == i) for i in range(parts)]


def _scan(docs: DataFrame, ngrams, first: bool) -> DataFrame:
    def run(batches):
        known = ngrams.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            counts, spans, items = [], [], []
            for text in texts:
                words = words_of(text.as_py())
                found = known.hits(words)
                counts.append(len(words))
                spans.append([{"start": i, "size": n} for i, n, _ in found])
                items.append(sorted(set().union(*(x for _, _, x in found))))
            if not first:
                old = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in NEW[1:]]
                spans = [a + b for a, b in zip(old[0], spans)]
                items = [sorted({*a, *b}) for a, b in zip(old[1], items)]
            carried = [batch.column(batch.schema.get_field_index(c)) for c in names]
            arrays = [*carried, pa.array(counts, pa.int64()), pa.array(spans, SPANS), pa.array(items, ITEMS)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *NEW])

    NEW = ["n_words", "hit_spans", "hit_items"]
    SPANS = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))
    ITEMS = pa.list_(pa.string())
    names = [c for c in docs.columns if c not in NEW]
    schema = T.StructType([docs.schema[c] for c in names]).add("n_words", "long")
    span = T.StructType().add("start", T.IntegerType()).add("size", T.IntegerType())
    schema = schema.add("hit_spans", T.ArrayType(span)).add("hit_items", T.ArrayType(T.StringType()))
    return docs.mapInArrow(run, schema)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with n_words, hit_spans (first word and size of each hit) and hit_items.

    Windows of ``n`` words of the test items, or a whole shorter item, are looked up in every
    document. Words are runs of ASCII letters and digits and all non-ASCII characters, ASCII
    lower-cased. The distinct items are measured first and broadcast in blocks of ``block_bytes``.
    With several blocks the findings are stored after each, so that one block is live at a time. A
    single item larger than a block is a block of its own. Null and empty texts have no words and no hits;
    null or wordless items match nothing; repeated items and item ids count once. A null item_id
    is the empty string. Columns of ``docs`` with the names of the new ones are replaced; without
    documents there are no rows. Documents are not moved, so a hot source or key does not matter.
    """
    context = docs.sparkSession.sparkContext
    found = docs.drop("n_words", "hit_spans", "hit_items")
    blocks = blocks_of(benchmark, block_bytes)
    for i, block in enumerate(blocks):
        ngrams = context.broadcast(NgramSet([tuple(r) for r in block.collect()], n))
        found = _scan(found, ngrams, i == 0)
        if i + 1 < len(blocks):
            found = materialize(found, "scanned")
            ngrams.unpersist()
    return found


def n_hit() -> F.Column:
    """Words in the union of ``hit_spans``."""
    ordered = F.array_sort("hit_spans")
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def step(acc, span):
        end = span["start"] + span["size"]
        fresh = F.greatest(F.lit(0), end - F.greatest(acc["end"], span["start"]))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(ordered, start, step)["n"]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM) -> DataFrame:
    """Only the documents without any hit, with their own columns."""
    found = find_contamination(docs, benchmark, n)
    return found.filter(F.size("hit_spans") == 0).select(*docs.columns)


def op7(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_contamination(balanced(docs.select("doc_id", "text")), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), sized AS (
  SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0
), placed AS (
  SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM sized
), grams AS (
  SELECT DISTINCT item, n, array_to_string(w[p : p + n - 1], ' ') AS g FROM placed
), starts AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p
  FROM d, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n
), hits AS (
  SELECT r, p, n, item
  FROM (SELECT r, p, n, array_to_string(w[p : p + n - 1], ' ') AS g FROM starts) JOIN grams USING (n, g)
), covered AS (
  SELECT r, count(DISTINCT i) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS i FROM hits) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""
