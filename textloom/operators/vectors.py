"""Vocabularies, term counts, TF-IDF weights and document vectors."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.arrays import l2_normalized, term_bag
from textloom.functions.text import raw_tokens, tokenize
from textloom.operators.lookup import BROADCAST_BYTES, lookup_join, measured, table_bytes
from textloom.operators.ordering import ordered_index
from textloom.session import materialize

Tokenizer = Callable[[Column], Column]
# Columns added while rows are regrouped.
CONTENT, COPIES = "_content", "_copies"
PLACE = "_place"
# Rows that are looked up together: 2 ** BLOCK_BITS at most.
BLOCK, BLOCK_BITS = "_block", 12
# Entries whose word vectors are added up at once.
ENTRIES_AT_ONCE = 1 << 12
# A packed block ends with the batch that reaches so many entries: larger ones share more words, so
# fewer vectors travel. Its words are stored in rows of so many.
ENTRIES_PER_PACK, WORDS_PER_ROW = 1 << 22, 1 << 14
CODES, COUNTS, WORDS, FIRST = "_codes", "_counts", "_words", "_first"


@dataclass(frozen=True)
class Vocabulary:
    """A fitted vocabulary: a stored table (term, term_id, df, idf) and its totals."""

    table: DataFrame
    n_docs: int
    n_terms: int
    size: int


def tokens(articles: DataFrame, tokenizer: Tokenizer = tokenize, text: str = "text") -> DataFrame:
    """Replace the text by its token array."""
    others = [c for c in articles.columns if c != text]
    return articles.select(*others, tokenizer(F.col(text)).alias("tokens"))


def content_hash(array: str) -> Column:
    """Tells rows that share a key apart by an array of theirs that is about to be exploded."""
    return F.xxhash64(array)


def row_copies() -> Column:
    """How many equal rows fell into one group: every exploded row has one first position."""
    return F.count_if(F.coalesce("_pos", F.lit(0)) == 0).alias(COPIES)


def repeated(grouped: DataFrame) -> DataFrame:
    """One row again for every row that a group of equal rows stands for."""
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES)))
    return grouped.withColumn("_again", times).drop("_again", COPIES)


def placed(stored: DataFrame, lookup_size: int) -> DataFrame:
    """Rows of a stored table with a number each, dealt out evenly by it if a lookup is broadcast.

    The compact rows move once, before they are exploded; sums and windows by number then need
    no shuffle, and no id or group of copies is hot. Numbers follow from the files, so a task
    that runs again gives the same ones: the table must be stored, not computed. Beyond the
    broadcast limit the lookup moves the exploded rows anyway, and placing them would be wasted.
    """
    numbered = stored.withColumn(PLACE, F.monotonically_increasing_id())
    return numbered.repartition(PLACE) if lookup_size <= BROADCAST_BYTES else numbered


def lemmatize(token_table: DataFrame, lemmas: DataFrame | None, key: str = "id") -> DataFrame:
    """Replace tokens by lower-cased lemmas from a (surface, lemma) table, order kept.

    Tokens without an entry stay as they are; without a table nothing but case changes. Rows
    that repeat an id stay rows of their own. ``token_table`` should be a stored table.
    """
    if lemmas is None:
        return token_table.withColumn("tokens", F.transform("tokens", F.lower))
    others = [c for c in token_table.columns if c not in (key, "tokens")]
    size = table_bytes(lemmas)
    long = placed(token_table, size).select(
        PLACE, key, *others, F.posexplode_outer("tokens").alias("_pos", "surface")
    )
    joined = lookup_join(long, lemmas.select("surface", "lemma"), "surface", "left", size=size)
    word = F.lower(F.coalesce("lemma", "surface"))
    entry = F.when(F.col("surface").isNotNull(), F.struct("_pos", word.alias("word")))
    grouped = joined.groupBy(PLACE, key, *others).agg(F.sort_array(F.collect_list(entry))["word"].alias("tokens"))
    return grouped.select(key, *others, "tokens")


def lemma_bags(bag_table: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace the bags of a table by bags of lower-cased lemmas from (surface, lemma), in term order.

    Equal to the bags of the lemmatized tokens, but tokens are neither exploded nor put in order
    again: a lemma is looked up once per distinct term of a block, and counts of terms that fall
    together are added there. Rows that repeat their keys stay rows of their own, empty bags stay
    empty. A surface that is given several lemmas enters with each of them.
    """
    others = [c for c in bag_table.columns if c != "bag"]

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        n = rows.num_rows
        surface, word = (found.column(c).combine_chunks().dictionary_encode() for c in ("term", "word"))
        ordered = pc.sort_indices(word.dictionary).to_numpy()
        words, rank = word.dictionary.take(pa.array(ordered)), np.argsort(ordered)
        by_surface = np.argsort(surface.indices.to_numpy(), kind="stable")
        given = np.bincount(surface.indices.to_numpy(), minlength=len(surface.dictionary))
        row, place, tf = bag_entries(rows, pa.table({"term": surface.dictionary}))
        times = given[place]
        entry = np.repeat(np.arange(len(row)), times)
        nth = np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times)
        at = by_surface[(np.cumsum(given) - given)[place[entry]] + nth]
        key = row[entry] * max(1, len(words)) + rank[word.indices.to_numpy()[at]]
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.diff(key[order], prepend=-1))
        counts = np.add.reduceat(tf.astype(np.int64)[entry][order], starts) if len(starts) else np.zeros(0, np.int64)
        key = key[order][starts]
        parts = [words.take(pa.array(key % max(1, len(words)))), pa.array(counts)]
        lists = _lists(key // max(1, len(words)), n, pa.StructArray.from_arrays(parts, names=["term", "tf"]))
        return pa.Table.from_arrays([*(rows.column(c) for c in others), lists], names=[*others, "bag"])

    stored = in_blocks(bag_table)
    table = lemmas.select(F.col("surface").alias("term"), "lemma")
    word = F.lower(F.coalesce("lemma", "term")).alias("word")
    found = block_terms(stored).filter("term IS NOT NULL").join(table, "term", "left").select("_of", "term", word)
    schema = T.StructType([*stored.select(others).schema, *T.StructType.fromDDL("bag array<struct<term string, tf long>>")])
    return stored.groupBy(BLOCK).cogroup(found.groupBy("_of")).applyInArrow(run, schema)


def bags(token_table: DataFrame) -> DataFrame:
    """Replace the token array by its bag of (term, tf), counted inside the row."""
    others = [c for c in token_table.columns if c != "tokens"]
    return token_table.select(*others, term_bag(F.col("tokens")).alias("bag"))


def document_frequencies(bag_table: DataFrame, min_df: int = 2) -> DataFrame:
    """(term, df) of the terms that occur in at least ``min_df`` documents."""
    return (
        bag_table.select(F.explode("bag.term").alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("df"))
        .filter(F.col("df") >= min_df)
    )


def idf(df: Column, n_docs: int) -> Column:
    """Smoothed inverse document frequency: ln((1 + n) / (1 + df)) + 1."""
    return F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + df)) + 1.0


def fit_vocabulary(bag_table: DataFrame, min_df: int = 2) -> Vocabulary:
    """Index the frequent enough terms in lexicographic order, from 0.

    ``bag_table`` should be a stored table, as it is read for the fit and again to transform.
    """
    n_docs = bag_table.count()
    indexed = ordered_index(document_frequencies(bag_table, min_df), "term", name="term_id")
    table = materialize(
        indexed.select(
            "term", F.col("term_id").cast("int"), "df", idf(F.col("df"), n_docs).alias("idf")
        ),
        "vocabulary",
    )
    n_terms, size = measured(table)
    return Vocabulary(table, n_docs, n_terms, size)


def term_counts(bag_table: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(keys, term, term_id, tf) of the known terms; no shuffle if the vocabulary is small."""
    others = [c for c in bag_table.columns if c != "bag"]
    long = bag_table.select(*others, F.inline("bag"))
    known = vocabulary.table.select("term", "term_id")
    return lookup_join(long, known, "term", size=vocabulary.size).select(
        *others, "term", "term_id", "tf"
    )


def in_blocks(bag_table: DataFrame) -> DataFrame:
    """Stored rows with the number of their block: neighbours that one task wrote."""
    number = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    return materialize(bag_table.withColumn(BLOCK, number), "blocks")


def block_terms(stored: DataFrame) -> DataFrame:
    """(_of, term): the distinct terms of every block of bags."""
    return stored.select(F.col(BLOCK).alias("_of"), F.explode("bag.term").alias("term")).distinct()


def looked_up(
    stored: DataFrame, table: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: T.StructType
) -> DataFrame:
    """``run`` on every block of bags and the rows of ``table`` (one per ``term``) for its terms.

    Only the distinct terms of a block are shuffled to the table and back, not every entry, and a
    term occurs once per block at most, so none is hot. The bags move once, as compact rows.
    """
    found = block_terms(stored).join(table, "term")
    return stored.groupBy(BLOCK).cogroup(found.groupBy("_of")).applyInArrow(run, schema)


def bag_entries(rows: pa.Table, found: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, row of ``found``, tf) of the entries of a block's bags whose terms were found."""
    bag = rows.column("bag").combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(bag), 0).to_numpy(zero_copy_only=False)
    flat = bag.flatten()
    place = pc.index_in(flat.field("term"), value_set=found.column("term").combine_chunks())
    known = place.is_valid().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)[known]
    tf = flat.field("tf").to_numpy(zero_copy_only=False)[known].astype(np.float64)
    return row, place.drop_null().to_numpy(zero_copy_only=False), tf


def _lists(row: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    """One list per row of the values that belong to it, in order."""
    return pa.ListArray.from_arrays(np.searchsorted(row, np.arange(n + 1)).astype(np.int32), values)


def sparse_rows(
    bag_table: DataFrame, vocabulary: Vocabulary, weighting: str = "tfidf", norm: bool = True
) -> DataFrame:
    """One row per document: sorted ``indices`` and their ``values``.

    Documents without a known term stay, with empty arrays, and rows that repeat a key stay rows of
    their own. Bags are stored in blocks and looked up there, so that entries are neither spread
    out nor regrouped, whatever the size of the vocabulary.
    """
    if weighting not in ("tfidf", "count"):
        raise ValueError(f"unknown weighting {weighting!r}")
    others = [c for c in bag_table.columns if c != "bag"]
    scaled = weighting == "tfidf"

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        n = rows.num_rows
        row, place, value = bag_entries(rows, found)
        ids = found.column("term_id").to_numpy()[place]
        if scaled:
            value = value * found.column("idf").to_numpy()[place]
        order = np.lexsort((ids, row))
        row, ids, value = row[order], ids[order], value[order]
        if scaled and norm:
            length = np.sqrt(np.bincount(row, value * value, n))[row]
            value = np.divide(value, length, out=value, where=length > 0)
        lists = [_lists(row, n, pa.array(v)) for v in (ids, value)]
        return pa.Table.from_arrays([*(rows.column(c) for c in others), *lists], names=[*others, "indices", "values"])

    stored = in_blocks(bag_table)
    arrays = "indices array<int>, values array<double>"
    schema = T.StructType([*stored.select(others).schema, *T.StructType.fromDDL(arrays)])
    return looked_up(stored, vocabulary.table.select("term", "term_id", "idf"), run, schema)


def weights(rows: DataFrame) -> DataFrame:
    """(keys, term_id, weight): the long form of ``sparse_rows``."""
    others = [c for c in rows.columns if c not in ("indices", "values")]
    pairs = F.arrays_zip(F.col("indices").alias("term_id"), F.col("values").alias("weight"))
    return rows.select(*others, F.inline(pairs).alias("term_id", "weight"))


def term_weights(
    bag_table: DataFrame, vocabulary: Vocabulary, weighting: str = "tfidf", norm: bool = True
) -> DataFrame:
    """(keys, term, term_id, weight) of the known terms, the long form of ``sparse_rows``.

    Terms of a document are never collected: its norm is one numeric sum over its rows, which
    stay where the stored bag was placed. Documents without a known term have no rows.
    """
    if weighting not in ("tfidf", "count"):
        raise ValueError(f"unknown weighting {weighting!r}")
    others = [c for c in bag_table.columns if c != "bag"]
    scaled = weighting == "tfidf" and norm
    rows = placed(bag_table, vocabulary.size) if scaled else bag_table
    kept = [*others, PLACE] if scaled else others
    known = vocabulary.table.select("term", "term_id", "idf")
    joined = lookup_join(rows.select(*kept, F.inline("bag")), known, "term", size=vocabulary.size)
    tf = F.col("tf").cast("double")
    found = joined.withColumn("weight", tf * F.col("idf") if weighting == "tfidf" else tf)
    if scaled:
        squares = F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(PLACE))
        found = found.withColumn("weight", F.col("weight") / F.sqrt(squares))
    return found.select(*others, "term", "term_id", "weight")


def with_terms(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Add the term of every ``term_id``."""
    names = vocabulary.table.select("term_id", "term")
    return lookup_join(df, names, "term_id", size=vocabulary.size)


def matrix_shape(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Documents, terms, non-zero entries and density of the document-term matrix."""
    totals = rows.agg(
        F.count("*").alias("n_docs"),
        F.coalesce(F.sum(F.size("indices")), F.lit(0)).cast("long").alias("n_nonzero"),
    )
    terms = F.lit(vocabulary.n_terms).cast("long")
    return totals.select(
        "n_docs",
        terms.alias("n_terms"),
        "n_nonzero",
        (F.col("n_nonzero") / (F.col("n_docs") * terms)).alias("density"),
    )


def stored_bags(
    articles: DataFrame, tokenizer: Tokenizer = tokenize, lemmas: DataFrame | None = None
) -> DataFrame:
    """Tokenize once and keep the bags, which fit and transform then both read.

    Lemmas are looked up for the distinct terms of the stored bags, not for every token.
    """
    found = materialize(bags(tokens(articles, tokenizer)), "bags")
    return found if lemmas is None else materialize(lemma_bags(found, lemmas), "lemma-bags")


def _vector_struct(size: int) -> Column:
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).cast("int").alias("size"),
        F.col("indices"),
        F.col("values"),
    )


def ml_vectors(rows: DataFrame, size: int, column: str = "features") -> DataFrame:
    """Store ``indices``/``values`` rows and read them back as Spark ML sparse vectors."""
    others = [f for f in rows.schema if f.name not in ("indices", "values")]
    schema = T.StructType([*others, T.StructField(column, VectorUDT())])
    stored = rows.select(*[f.name for f in others], _vector_struct(size).alias(column))
    return materialize(stored, "features", schema)


def lazy_ml_vectors(rows: DataFrame, size: int, column: str = "features") -> DataFrame:
    """The same vectors without a stored table, for scoring that reads them once."""
    others = [c for c in rows.columns if c not in ("indices", "values")]

    @F.arrow_udf(VectorUDT())
    def as_vector(parts: pa.Array) -> pa.Array:
        return parts  # a vector's parts, only its type is new

    return rows.select(*others, as_vector(_vector_struct(size)).alias(column))


def term_vectors(vocabulary: Vocabulary, vectors: DataFrame, dim: int) -> DataFrame:
    """(term, term_id, vector) for every vocabulary term, zeros where none is given."""
    zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
    joined = lookup_join(vocabulary.table.select("term", "term_id"), vectors, "term", "left")
    return joined.select("term", "term_id", F.coalesce("vector", zeros).alias("vector"))


def packed_bags(bag_table: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Bags as bytes in blocks of neighbours, and (_of, code, term): the distinct terms of every block.

    A bag is its terms' codes inside the block (int32, -1 for a null term) and their counts (int64).
    Both tables are parts of one stored table, so the bags are read once and strings do not move with them.
    """
    others = list(keys)
    kept = bag_table.select(*others, "bag")
    packed = f"{CODES} binary, {COUNTS} binary, {FIRST} int, {WORDS} array<string>"
    fields = [*kept.select(others).schema, *T.StructType.fromDDL(f"{BLOCK} long, {packed}")]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    limit, width = ENTRIES_PER_PACK, WORDS_PER_ROW

    def block(number: int, rows: list[pa.RecordBatch], terms: list[pa.DictionaryArray]):
        def filled(n: int, own: list, lists: list) -> pa.RecordBatch:
            columns = [*own, pa.array([number] * n, pa.int64()), *lists]
            made = [pa.nulls(n, t) if c is None else c for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(made, names=[f.name for f in fields])

        types = [*rows[0].schema.types[: len(others)], pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.string())]
        chunks = pa.chunked_array(terms).unify_dictionaries().chunks
        for batch, chunk in zip(rows, chunks, strict=True):
            bag = batch.column(len(others))
            ends = np.r_[0, np.cumsum(pc.fill_null(bag.value_lengths(), 0).to_numpy(zero_copy_only=False))]
            codes = pc.fill_null(chunk.indices, -1).cast(pa.int32()).to_numpy()
            counts = bag.flatten().field("tf").cast(pa.int64()).to_numpy()
            lists = [pa.array([v[i:j].tobytes() for i, j in zip(ends, ends[1:])], pa.binary()) for v in (codes, counts)]
            yield filled(batch.num_rows, batch.columns[: len(others)], [*lists, None, None])
        words = chunks[0].dictionary
        starts = range(0, len(words), width)
        listed = [words.slice(i, width).to_pylist() for i in starts]
        firsts = [pa.array(starts, pa.int32()), pa.array(listed, pa.list_(pa.string()))]
        yield filled(len(starts), [None] * len(others), [None, None, *firsts])

    def pack(batches):
        number, rows, terms, entries = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            flat = batch.column(len(others)).flatten().field("term")
            rows.append(batch)
            terms.append(flat.dictionary_encode())
            # Long words count for more, so that the words of a block stay far below 2 GB.
            entries += len(flat) + terms[-1].dictionary.nbytes // 64
            if entries >= limit:
                yield from block(number, rows, terms)
                number, rows, terms, entries = number + 1, [], [], 0
        if rows:
            yield from block(number, rows, terms)

    stored = materialize(kept.mapInArrow(pack, schema), "packed-bags")
    listed = stored.filter(F.col(WORDS).isNotNull())
    words = listed.select(F.col(BLOCK).alias("_of"), FIRST, F.posexplode(WORDS).alias("_at", "term"))
    codes = words.select("_of", (F.col(FIRST) + F.col("_at")).alias("code"), "term")
    return stored.filter(F.col(WORDS).isNull()).drop(FIRST, WORDS), codes


def mean_vectors(
    bag_table: DataFrame, vectors: DataFrame, dim: int, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """(keys, vector): mean word vector of every document; unknown words count as zeros.

    Every distinct word of a document enters once with its count as weight. Vectors go to a block of
    documents once per distinct word of the block and are added up inside it. Rows that repeat a
    key stay rows of their own.
    """
    others, at_once = list(keys), ENTRIES_AT_ONCE

    def run(rows: pa.Table, found: pa.Table) -> pa.Table:
        n = rows.num_rows
        flat = found.column("vector").combine_chunks().flatten()
        if flat.null_count:
            raise ValueError("a word vector holds a null component")
        parts = [[np.frombuffer(b, kind) for b in rows.column(c).to_pylist()] for c, kind in ((CODES, np.int32), (COUNTS, np.int64))]
        lengths = np.array([len(p) for p in parts[0]], np.int64)
        codes, tf = (np.concatenate(p) for p in parts)
        row = np.repeat(np.arange(n, dtype=np.int32), lengths)
        total = np.bincount(row, tf, n)
        # A word that is given several vectors enters once with each of them.
        word = found.column("code").to_numpy()
        order = np.argsort(word, kind="stable")
        distinct, starts, given = np.unique(word[order], return_index=True, return_counts=True)
        table = flat.to_numpy(zero_copy_only=False).reshape(len(word), dim)[order]
        table = np.add.reduceat(table, starts, axis=0, dtype=np.float64) if len(word) else np.zeros((0, dim))
        slot = np.full(max(codes.max(initial=-1), distinct.max(initial=-1)) + 2, -1, np.int32)
        slot[distinct] = np.arange(len(distinct), dtype=np.int32)
        place = slot[codes]  # code -1 reads the last slot, which is never given
        known = place >= 0
        row, place, tf = row[known], place[known], tf[known].astype(np.float64)
        sums = np.zeros((n, dim))
        for at in range(0, len(row), at_once):
            part = slice(at, at + at_once)
            starts = np.flatnonzero(np.diff(row[part], prepend=-1))
            # A document that goes on in the next part is added to again.
            sums[row[part][starts]] += np.add.reduceat(table[place[part]] * tf[part, None], starts, axis=0)
        total = (total + np.bincount(row, tf * (given[place] - 1), n))[:, None]
        means = np.divide(sums, total, out=np.zeros((n, dim)), where=total > 0)
        offsets = np.arange(0, (n + 1) * dim, dim or 1)[: n + 1] if dim else np.zeros(n + 1)
        lists = pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(means.reshape(-1)))
        return pa.Table.from_arrays([*(rows.column(c) for c in others), lists], names=[*others, "vector"])

    stored, codes = packed_bags(bag_table, others)
    schema = T.StructType([*stored.select(others).schema, *T.StructType.fromDDL("vector array<double>")])
    zeros = F.array_repeat(F.lit(0.0), dim).cast(vectors.schema["vector"].dataType)
    given = vectors.select("term", F.coalesce("vector", zeros).alias("vector"))
    found = codes.join(given, "term").select("_of", "code", "vector")
    return stored.groupBy(BLOCK).cogroup(found.groupBy("_of")).applyInArrow(run, schema)


def common_width(df: DataFrame, vector: str) -> int:
    """The length of all arrays of a column; arrays of different lengths are an error."""
    low, high = df.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if low != high:
        raise ValueError(f"vectors of different lengths, {low} to {high}")
    return low or 0


def group_mean_vectors(df: DataFrame, key: str, vector: str, dim: int) -> DataFrame:
    """(key, dim, mean) of an array column; partial sums per task keep hot keys cheap."""
    means = [F.avg(F.get(F.col(vector), F.lit(i))).alias(str(i)) for i in range(dim)]
    wide = df.groupBy(key).agg(*means)
    return wide.unpivot([key], [str(i) for i in range(dim)], "dim", "mean").withColumn(
        "dim", F.col("dim").cast("long")
    )


def raw_bags(articles: DataFrame) -> DataFrame:
    """Bags over the raw text, stop words and punctuation included."""
    return bags(tokens(articles, raw_tokens))
