"""Repeated passages: winnowed anchors as seeds, extended both ways to every repeated window."""

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import KEY, balanced, keyed, map_batches, materialize, sized_join

WINDOW = 35
ANCHOR = 8
# Windows handled at once; longer documents are walked in pieces that overlap.
PIECE = 1 << 20
NEW = ["n_words", "n_removed", "kept_text"]
U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BASE = 0x9E3779B97F4A7C15
BYTE_HASH = np.array(
    [int.from_bytes(hashlib.sha256(bytes([i])).digest()[:8], "little") | 1 for i in range(256)], U64
)


@cache
def _powers(base: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[U64(1)], np.cumprod(np.full(size - 1, base, U64), dtype=U64)])


def powers(base: int, size: int) -> np.ndarray:
    return _powers(base, 1 << max(12, (size - 1).bit_length()))[:size]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def word_hashes(text: str) -> np.ndarray:
    """One 64-bit hash per word of ``text``."""
    data = np.frombuffer(text.encode(), np.uint8)
    inside = ~SPACE[data]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, U64)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    within = np.arange(lengths.sum()) - np.repeat(first, lengths)
    values = BYTE_HASH[data[inside]] * powers(0xD6E8FEB86659FD93, int(lengths.max()))[within]
    return mixed(np.add.reduceat(values, first) + lengths.astype(U64))


class Ranges:
    """Hashes of any range of words in constant time, from sums of weighted word hashes."""

    def __init__(self, words: np.ndarray, base: int = BASE):
        weighted = words * powers(base, len(words))
        self.sums = np.concatenate([[U64(0)], np.cumsum(weighted, dtype=U64)])
        self.back = powers(pow(base, -1, 1 << 64), len(words) + 1)

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mixed((self.sums[hi] - self.sums[lo]) * self.back[lo] + (hi - lo).astype(U64))


def anchors(words: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """Runs of windows by their anchor: (anchor hash, extent hash, first window, windows).

    The anchor of a window is the k-gram of it with the smallest hash, the last one in case of
    ties, so equal windows have equal anchors at equal places. The windows of a run are
    consecutive and share one occurrence of an anchor; their extent is all words they cover.
    """
    ranges = Ranges(words)
    found = []
    for at in range(0, len(words) - window + 1, PIECE):
        n = min(PIECE, len(words) - window + 1 - at)
        grams = np.arange(at, at + n + window - k)
        hashes = ranges(grams, grams + k)
        # The upper 40 bits order the k-grams, the lower ones prefer the later of equal ones.
        best = (hashes & U64(0xFFFFFFFFFF000000)) | (U64(0xFFFFFF) - (grams - at).astype(U64))
        span, wide = 1, window - k + 1
        while span < wide:
            step = min(span, wide - span)
            best = np.minimum(best[:-step], best[step:])
            span += step
        place = 0xFFFFFF - (best & U64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [n]])
        extent = ranges(first + at, last + at + window - 1)
        found.append((hashes[place[first]], extent, first + at, last - first))
    return tuple(np.concatenate(c) for c in zip(*found))


def seeds(docs: DataFrame, window: int, k: int) -> DataFrame:
    """All anchor runs of all documents: (_llm_id, _llm_th, ah, e, l, n)."""

    def run(columns):
        out = [[] for _ in range(6)]
        for doc, text_hash, text in zip(*columns):
            words = word_hashes(text) if text else ()
            if len(words) >= window:
                a, e, first, n = anchors(words, window, k)
                parts = np.full(len(a), doc), np.full(len(a), text_hash), a.view(np.int64), e.view(np.int64), first, n
                for column, part in zip(out, parts):
                    column.append(part)
        return [np.concatenate(c) if c else [] for c in out]

    schema = "_llm_id long, _llm_th long, ah long, e long, l int, n int"
    return map_batches(docs, run, schema, [*KEY, "text"])


def repeated_runs(runs: DataFrame) -> DataFrame:
    """Runs whose anchor occurs elsewhere, with ``repeated`` (the whole extent does as well)
    and ``extend`` (its windows must be compared one by one).

    Only anchors with several different extents need that: an extent that occurs twice makes all
    its windows repeated, and of equal extents one run is compared for all.
    """
    extents = runs.groupBy("ah", "e").agg(F.count("*").alias("c"), F.min(KEY[0]).alias("lead"))
    extents = materialize(extents, "extents")
    shared = extents.groupBy("ah").agg(F.sum("c").alias("t"), F.count("*").alias("kinds")).filter("t > 1")
    wanted = materialize(
        extents.join(shared, "ah").select("ah", "e", "c", "lead", (F.col("kinds") > 1).alias("mixed")),
        "wanted",
    )
    found = sized_join(runs, wanted, ["ah", "e"], "inner")
    return found.select(
        *KEY,
        "l",
        "n",
        (F.col("c") > 1).alias("repeated"),
        (F.col("mixed") & ((F.col("c") == 1) | (F.col(KEY[0]) == F.col("lead")))).alias("extend"),
    )


def extended_windows(docs: DataFrame, runs: DataFrame, window: int) -> DataFrame:
    """Repeated windows (_llm_id, _llm_th, l, n = 1) among those of the runs to extend."""

    def run(columns):
        out = [[] for _ in range(6)]
        for doc, text_hash, text, parts in zip(*columns):
            words = word_hashes(text)
            lo = np.concatenate([np.arange(p["l"], p["l"] + p["n"]) for p in parts])
            weight = np.repeat([2 if p["repeated"] else 1 for p in parts], [p["n"] for p in parts])
            one, two = Ranges(words)(lo, lo + window), Ranges(words, 0xC2B2AE3D27D4EB4F)(lo, lo + window)
            lanes = one.view(np.int64), two.view(np.int64)
            for column, part in zip(out, (np.full(len(lo), doc), np.full(len(lo), text_hash), *lanes, lo, weight)):
                column.append(part)
        return [np.concatenate(c) if c else [] for c in out]

    lists = runs.filter("extend").groupBy(*KEY).agg(F.collect_set(F.struct("l", "n", "repeated")).alias("runs"))
    lists = materialize(lists, "extend")
    schema = "_llm_id long, _llm_th long, w1 long, w2 long, l int, weight int"
    # Rows equal in id and text share one list, never longer than one text has windows.
    rows = sized_join(docs, lists, KEY, "inner")
    windows = materialize(map_batches(rows, run, schema, [*KEY, "text", "runs"]), "windows")
    often = windows.groupBy("w1", "w2").agg(F.sum("weight").alias("weight")).filter("weight > 1")
    hits = windows.filter("weight = 1").select(*KEY, "w1", "w2", "l")
    return hits.join(often.select("w1", "w2"), ["w1", "w2"]).select(*KEY, "l", F.lit(1).alias("n"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text: repeated passages taken out.

    A word goes if a window of ``window`` words around it occurs at any other place of the
    corpus, its own document included; everything is judged on the input. Words end at
    space, tab and line-ending characters; kept words are joined by one space. Null and empty
    texts have no words and an empty kept_text; texts shorter than a window stay. Repeated rows
    repeat each other. No windows are paired within a group: equal ones are counted by hash
    (128 bits), so a passage in a third of all documents costs a count. Existing columns with the
    names of the new ones are replaced.
    """
    docs = keyed(balanced(docs.drop(*NEW, "_spans")), "doc_id", "text")
    runs = materialize(seeds(docs, window, k), "seeds")
    marked = materialize(repeated_runs(runs), "runs")
    whole = marked.filter("repeated").select(*KEY, "l", "n")
    hits = whole.unionByName(extended_windows(docs, marked, window))
    spans = materialize(
        hits.groupBy(*KEY).agg(F.collect_set(F.struct("l", "n")).alias("_spans")), "spans"
    )
    carried = [c for c in docs.columns if c not in (*KEY, *NEW, "_spans")]
    rows = sized_join(docs, spans, KEY)
    return cut_spans(rows, window, carried)


def cut_spans(rows: DataFrame, window: int, carried: list[str]) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts, spans = (batch.column(batch.schema.get_field_index(c)) for c in ("text", "_spans"))
            counts, removed, kept = [], [], []
            for text, parts in zip(texts, spans):
                words = text.as_py().encode().split() if text.is_valid else []
                counts.append(len(words))
                if parts.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    flat = parts.values
                    lo = flat.field("l").to_numpy()
                    np.add.at(edge, lo, 1)
                    np.add.at(edge, lo + flat.field("n").to_numpy() + window - 1, -1)
                    stays = np.cumsum(edge[:-1]) == 0
                    words = [w for w, s in zip(words, stays.tolist()) if s]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in carried]
            extra = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *extra], names=[*carried, *NEW])

    fields = [rows.schema[c] for c in carried]
    schema = T.StructType(fields).add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    return rows.select(*carried, "_spans").mapInArrow(run, schema)


def op4(docs: DataFrame) -> DataFrame:
    kept = remove_repeats(docs.select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), starts AS (
  SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35
), windows AS (
  SELECT r, p, sha256(array_to_string(w[p : p + 34], ' ')) AS h FROM starts
), again AS (
  SELECT r, p FROM windows QUALIFY count(*) OVER (PARTITION BY h) > 1
), gone AS (
  SELECT DISTINCT r, p + o AS i FROM again, range(35) AS t(o)
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS k, count(*) AS n
  FROM words ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
