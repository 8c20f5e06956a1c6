"""Collocations per language by best-first branch-and-bound growth of phrases."""

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import arrow_fields, balanced, by_bytes, materialize, sized_join, sized_lookup, to_batch

MIN_COUNT = 10
LIMIT = 2000
# A phrase goes if a longer candidate around it holds at least this share of its occurrences.
COVERED = 50
SCALE = 1_000_000
UNDETERMINED = "und"
# Nodes first expanded per language, as a multiple of the limit, and the growth of each later step.
FIRST, MORE = 2, 8
BATCH_BYTES = 2 << 20
ROWS_AT_ONCE = 1 << 14
# A filter of hashed phrases has at most this many bits (16 MB), whatever the corpus.
FILTER_BITS = 1 << 27
SALTS = 64

# The byte 0xff is in no UTF-8 text and stands for the breaks between pieces.
BREAKS, BREAK = b".,;:!?\n\x0b\x0c\r", b"\xff"
SPLIT = bytes.maketrans(BREAKS + b"\t", BREAK * len(BREAKS) + b" ")
WORDS = ["x", "y", "z"]


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(index of each word, words of each piece, distinct words) of the texts, A-Z lowered."""
    data = "\n".join(texts).encode().lower().translate(SPLIT)
    # One flat list: lists of words per piece would take the interpreter five times as long.
    coded = pa.array(data.replace(BREAK, b" " + BREAK + b" ").split(), pa.large_binary()).dictionary_encode()
    index, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    mark = pc.index(words, BREAK).as_py()
    if mark < 0:
        return index, np.array([len(index)]), words
    ends = np.flatnonzero(index == mark)
    lengths = np.diff(np.r_[-1, ends, len(index)]) - 1
    index = np.delete(index, ends)
    return index - (index > mark), lengths, pa.concat_arrays([words[:mark], words[mark + 1 :]])


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two in order."""
    h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ ((b << np.uint64(31)) | (b >> np.uint64(33)))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed, digest = xxhash.xxh64_intdigest(lang.encode()), xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in words), np.uint64, len(words))


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    cell = hashes & np.uint64(len(bits) * 64 - 1)
    return (bits[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """Bits of a stored column ``h`` of hashes, of bounded size.

    A hash of the table always passes; others pass by chance, so counts behind the filter are whole
    and at most some rows too many. About 16 bits per hash, up to ``FILTER_BITS``.
    """
    rows, size = hashes.count(), 1 << 12
    while size < min(16 * rows, FILTER_BITS):
        size *= 2
    cell = f"(h & {size - 1}L)"
    bits = hashes.selectExpr(f"shiftright({cell}, 6) AS cell", f"shiftleft(1L, cast({cell} & 63 AS int)) AS bit")
    held = bits.groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[held["cell"].to_numpy()] = held["bits"].to_numpy().view(np.uint64)
    return out


def phrase_filter(found: DataFrame, words: list[str]) -> np.ndarray:
    """``hash_filter`` of the phrases (lang, *words) of a stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            langs, *columns = (c.to_pylist() for c in batch.columns)
            seeds = [digest(g.encode()) for g in langs]
            hashes = [np.array([digest(w.encode(), s) for s, w in zip(seeds, c)], np.uint64) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(reduce(mixed, hashes).view(np.int64))], names=["h"])

    return hash_filter(materialize(found.select("lang", *words).mapInArrow(run, "h long"), "hashes"))


def encoded(langs: list[str], texts: list[str]) -> Iterator[tuple]:
    """(lang, index of each word, words of each piece, distinct words) of every language of a batch."""
    by_lang: dict[str, list[str]] = {}
    for lang, text in zip(langs, texts):
        if text:
            by_lang.setdefault(lang, []).append(text)
    for lang, own in by_lang.items():
        index, lengths, words = words_of(own)
        if len(index):
            yield lang, index, lengths, words


def counted(docs: DataFrame, width: int, keys_of: Callable) -> DataFrame:
    """(lang, words, n): sums of what ``keys_of`` counts in batches of whole texts.

    ``keys_of(lang, indices, piece lengths, dictionary)`` returns ``width`` index arrays into the
    dictionary and their counts; equal phrases of a batch are one row before the shuffle.
    """
    words = WORDS[:width]
    schema = ", ".join(["lang string", *(f"{w} string" for w in words), "n long"])
    names, types = arrow_fields(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in by_bytes(batches, BATCH_BYTES):
            for lang, index, lengths, dictionary in encoded(langs, texts):
                spelled = dictionary.cast(pa.large_string())
                *at, n = keys_of(lang, index, lengths, dictionary.to_pylist())
                for lo in range(0, len(n), ROWS_AT_ONCE):
                    part = slice(lo, lo + ROWS_AT_ONCE)
                    columns = [spelled.take(pa.array(i[part])).cast(pa.string()) for i in at]
                    yield to_batch([pa.array([lang] * len(n[part])), *columns, pa.array(n[part])], names, types)

    rows = docs.mapInArrow(run, schema)
    return rows.groupBy("lang", *words).agg(F.sum("n").alias("n"))


def count_words(docs: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame]:
    """((lang, x, n) of words with ``min_count`` occurrences, (lang, n) of all words)."""

    def keys_of(lang, index, lengths, dictionary):
        n = np.bincount(index, minlength=len(dictionary))
        return np.arange(len(dictionary)), n

    every = materialize(counted(docs, 1, keys_of), "words")
    totals = materialize(every.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    return materialize(every.filter(F.col("n") >= min_count), "frequent-words"), totals


def inside(lengths: np.ndarray, width: int) -> np.ndarray:
    """Positions at which ``width`` words of one piece begin."""
    ends = np.repeat(np.cumsum(lengths), lengths)
    return np.flatnonzero(np.arange(len(ends)) + width <= ends)


def frequent_pair_filter(docs: DataFrame, known, min_count: int) -> np.ndarray:
    """Filter of the pairs of ``known`` words whose hash occurs ``min_count`` times.

    Equal hashes only add up, so no pair of that many occurrences is lost; rare pairs, most of all
    distinct ones, are shuffled as one hash each and never as words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in by_bytes(batches, BATCH_BYTES):
            for lang, index, lengths, dictionary in encoded(langs, texts):
                hashes = word_hashes(dictionary.to_pylist(), lang)
                often = marked(known.value, hashes)
                at = inside(lengths, 2)
                at = at[often[index[at]] & often[index[at + 1]]]
                h, n = np.unique(mixed(hashes[index[at]], hashes[index[at + 1]]), return_counts=True)
                for lo in range(0, len(h), ROWS_AT_ONCE):
                    part = slice(lo, lo + ROWS_AT_ONCE)
                    yield pa.RecordBatch.from_arrays([pa.array(h[part].view(np.int64)), pa.array(n[part])], names=["h", "n"])

    found = docs.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return hash_filter(materialize(found.filter(F.col("n") >= min_count).select("h"), "pair-hashes"))


def count_pairs(docs: DataFrame, words: DataFrame, min_count: int) -> DataFrame:
    """(lang, x, y, n) of pairs with ``min_count`` occurrences: grown from frequent words only."""
    broadcast = docs.sparkSession.sparkContext.broadcast
    known = broadcast(phrase_filter(words, ["x"]))
    likely = broadcast(frequent_pair_filter(docs, known, min_count))

    def keys_of(lang, index, lengths, dictionary):
        hashes = word_hashes(dictionary, lang)
        often = marked(known.value, hashes)
        at = inside(lengths, 2)
        a, b = index[at], index[at + 1]
        both = often[a] & often[b]
        a, b = a[both], b[both]
        both = marked(likely.value, mixed(hashes[a], hashes[b]))
        pair, n = np.unique(a[both] * len(dictionary) + b[both], return_counts=True)
        return pair // len(dictionary), pair % len(dictionary), n

    return materialize(counted(docs, 2, keys_of).filter(F.col("n") >= min_count), "pairs")


def count_triples(docs: DataFrame, pairs, nodes: DataFrame, min_count: int) -> DataFrame:
    """(lang, x, y, z, n) of the frequent triples that begin or end with one of the pairs ``nodes``."""
    chosen = docs.sparkSession.sparkContext.broadcast(phrase_filter(nodes, ["x", "y"]))

    def keys_of(lang, index, lengths, dictionary):
        hashes = word_hashes(dictionary, lang)
        first = np.flatnonzero(np.arange(len(index)) < len(index) - 1)
        pair = mixed(hashes[index[first]], hashes[index[first + 1]])
        often, node = marked(pairs.value, pair), marked(chosen.value, pair)
        at = inside(lengths, 3)
        at = at[often[at] & often[at + 1] & (node[at] | node[at + 1])]
        size = len(dictionary)
        heads, head = np.unique(index[at] * size + index[at + 1], return_inverse=True)
        triple, n = np.unique(head * size + index[at + 2], return_counts=True)
        head = heads[triple // size]
        return head // size, head % size, triple % size, n

    return materialize(counted(docs, 3, keys_of).filter(F.col("n") >= min_count), "triples")


def quotient(a: str, l: str, r: str):
    """floor(SCALE * a * a / (l * r)) in decimals of 38 digits: exact for counts below 10^15."""
    a, l, r = (f"CAST({c} AS DECIMAL(15,0))" for c in (a, l, r))
    return F.expr(f"CAST({SCALE} * ({a} * {a}) AS DECIMAL(38,0)) div ({l} * {r})")


def word_key(lang: str, word: str):
    """Language and word in one column; the last tab parts them, as no word holds one."""
    return F.concat(F.col(lang), F.lit("\t"), F.col(word))


def scored_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, x, y, a, l, r, score, bound, priority): a node per frequent pair.

    A triple that begins with the pair has at most its ``a`` occurrences, and the cut after the
    first word has at least as many on its right side, so no such triple scores above
    ``bound`` = floor(SCALE * a / l).
    """
    looked = pairs.withColumnRenamed("n", "a")
    for side, word in (("l", "x"), ("r", "y")):
        counts = words.select(word_key("lang", "x").alias("_key"), F.col("n").alias(side))
        looked = sized_lookup(looked.withColumn("_key", word_key("lang", word)), counts, "_key", "inner").drop("_key")
    bound = F.expr(f"({SCALE} * CAST(a AS DECIMAL(15,0))) div CAST(l AS DECIMAL(15,0))")
    looked = looked.withColumns({"score": quotient("a", "l", "r"), "bound": bound})
    return materialize(looked.withColumn("priority", F.greatest("score", "bound")), "nodes")


def scored_triples(triples: DataFrame, nodes: DataFrame) -> DataFrame:
    """(lang, x, y, z, a, l, r, score) by the cut of the smaller score, the first of equal ones."""
    pair = nodes.select("lang", "x", "y", F.col("a").alias("head"), F.col("l").alias("lone"))
    tail = nodes.select("lang", F.col("x").alias("y"), F.col("y").alias("z"), F.col("a").alias("rest"), F.col("r").alias("last"))
    looked = triples.withColumnRenamed("n", "a")
    looked = sized_join(looked, pair, ["lang", "x", "y"], "inner")
    looked = sized_join(looked, tail, ["lang", "y", "z"], "inner")
    looked = looked.withColumns({"one": quotient("a", "lone", "rest"), "two": quotient("a", "head", "last")})
    first = F.col("one") <= F.col("two")
    return looked.select(
        "lang",
        *WORDS,
        "a",
        F.when(first, F.col("lone")).otherwise(F.col("head")).alias("l"),
        F.when(first, F.col("rest")).otherwise(F.col("last")).alias("r"),
        F.least("one", "two").alias("score"),
    )


def level(values: DataFrame, column: str, rank: int) -> DataFrame:
    """(lang, cut): the value of ``column`` that the ``rank``-th largest of each language has.

    Languages with fewer rows have no row. Values are at most SCALE, so a language has a bounded
    number of distinct ones, whatever its rows.
    """
    sizes = values.groupBy("lang", column).agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.col(column).desc()))
    reached = sizes.withColumn("upto", upto).filter(F.col("upto") >= rank)
    return reached.groupBy("lang").agg(F.max(column).alias("cut"))


def best_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, limit: int = LIMIT, covered: int = COVERED, first: int | None = None
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``limit`` collocations of each language.

    ``docs`` has ``lang`` (null: und) and ``text`` (null: empty). Phrases grow from their prefixes:
    words, then pairs of frequent words, each a node with an exact score and a bound for the triples
    it begins. Nodes of the highest priority, the larger of both, are expanded first: the triples
    around them are counted in one pass over the texts, which settles whether the pair survives.
    Expansion ends for a language when as many phrases as asked for survive at or above the smallest
    priority expanded, or no node is left; nothing unexpanded can then enter the list. Ties are
    decided by count and phrase. An empty table or texts without words give no rows; repeated rows
    count each.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast
    texts = docs.select(F.coalesce("lang", F.lit(UNDETERMINED)).alias("lang"), "text").filter("text != ''")
    words, totals = count_words(texts, min_count)
    pairs = count_pairs(texts, words, min_count)
    nodes = scored_pairs(pairs, words)
    often = broadcast(phrase_filter(pairs, ["x", "y"]))

    goal = first or FIRST * limit
    start = sized_join(totals.select("lang"), level(nodes, "priority", goal), ["lang"])
    # By open language: the smallest priority that is expanded now, and the one of the step before.
    state = start.select("lang", F.coalesce("cut", F.lit(0)).alias("cut"), F.lit(SCALE + 1).alias("before"))
    state = materialize(state, "cuts")
    triples, tops = [], []
    while True:
        reached = sized_join(nodes, state, ["lang"], "inner").filter("priority >= cut")
        new = materialize(reached.filter("priority < before").select("lang", "x", "y"), "expanded")
        triples.append(count_triples(texts, often, new, min_count))
        every = reduce(DataFrame.unionByName, triples).groupBy("lang", *WORDS).agg(F.max("n").alias("n"))
        found = survivors(scored_triples(every, nodes), reached, covered)
        found = materialize(sized_join(found, state, ["lang"], "inner"), "survivors")
        # Every phrase that scores at least ``cut`` is known, so enough of them settle a language.
        sure = found.filter("score >= cut")
        sizes = sure.groupBy("lang").agg(F.count("*").alias("sure"))
        judged = sized_join(state, materialize(sizes, "sure"), ["lang"])
        judged = materialize(judged.withColumn("settled", F.expr(f"cut = 0 OR coalesce(sure, 0) >= {limit}")), "judged")
        ended, state = (judged.filter(f).select("lang", "cut") for f in ("settled", "NOT settled"))
        tops.append(materialize(top(sized_join(sure.drop("cut", "before"), ended, ["lang"], "inner"), limit), "top"))
        if state.isEmpty():
            break
        goal *= MORE
        below = sized_join(nodes, state, ["lang"], "inner").filter("priority < cut")
        # Nothing below the score that ``limit`` survivors have already can matter.
        known = level(found, "score", limit).withColumnRenamed("cut", "floor")
        deeper = level(below, "priority", goal).withColumnRenamed("cut", "next")
        state = sized_join(state, materialize(known, "floors"), ["lang"])
        state = sized_join(state, materialize(deeper, "levels"), ["lang"])
        cut = F.greatest(F.coalesce("floor", F.lit(0)), F.coalesce("next", F.lit(0)))
        state = materialize(state.select("lang", cut.alias("cut"), F.col("cut").alias("before")), "cuts")
    ranked = ranked_by(reduce(DataFrame.unionByName, tops), ["lang"]).filter(F.col("rank") <= limit)
    named = sized_join(ranked, totals, ["lang"], "inner")
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def survivors(scored: DataFrame, reached: DataFrame, covered: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all triples and the expanded pairs that none of them covers."""
    around = scored.select("lang", "x", "y", F.col("a").alias("most")).unionByName(
        scored.select("lang", F.col("y").alias("x"), F.col("z").alias("y"), F.col("a").alias("most"))
    )
    around = materialize(around.groupBy("lang", "x", "y").agg(F.max("most").alias("most")), "around")
    own = sized_join(reached, around, ["lang", "x", "y"]).filter(f"most IS NULL OR 100 * most < {covered} * a")
    columns = ["a", "l", "r", "score"]
    pairs = own.select("lang", F.concat_ws(" ", "x", "y").alias("phrase"), *columns)
    return pairs.unionByName(scored.select("lang", F.concat_ws(" ", *WORDS).alias("phrase"), *columns))


def ranked_by(found: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return found.withColumn("rank", F.row_number().over(order))


def top(found: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` of each of ``SALTS`` parts of a language, so that no task ranks all of it."""
    parts = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    return ranked_by(parts, ["lang", "part"]).filter(F.col("rank") <= limit).drop("part", "rank", "cut")


def op12(docs: DataFrame) -> DataFrame:
    return best_phrases(balanced(docs.select("doc_id", "lang", "text")))


ORACLE = f"""
WITH pieces AS (
  SELECT row_number() OVER () AS id, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
  )
), worded AS (
  SELECT id, lang, generate_subscripts(w, 1) AS i, unnest(w) AS x FROM (
    SELECT id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
  )
), runs AS (
  SELECT lang, x, lead(x) OVER p AS y, lead(x, 2) OVER p AS z FROM worded
  WINDOW p AS (PARTITION BY id ORDER BY i)
), phrases AS (
  SELECT lang, 1 AS k, x AS phrase FROM runs
  UNION ALL SELECT lang, 2, x || ' ' || y FROM runs WHERE y IS NOT NULL
  UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM runs WHERE z IS NOT NULL
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*)::HUGEINT AS n FROM phrases GROUP BY ALL
), total AS (
  SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), candidate AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= {MIN_COUNT}
), cut AS (
  SELECT c.lang, c.k, c.phrase, c.a, p.pos, g.n AS l, h.n AS r, ({SCALE}::HUGEINT * c.a * c.a) // (g.n * h.n) AS score
  FROM candidate AS c JOIN (VALUES (1), (2)) AS p(pos) ON p.pos < c.k
  JOIN f AS g ON g.lang = c.lang AND g.phrase = array_to_string(c.w[1 : p.pos], ' ') AND g.k = p.pos
  JOIN f AS h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[p.pos + 1 :], ' ') AND h.k = c.k - p.pos
), lowest AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, pos) = 1
), kept AS (
  SELECT * FROM lowest AS c ANTI JOIN (
    SELECT lang, array_to_string(w[1 : 2], ' ') AS phrase, a AS longer FROM candidate WHERE k = 3
    UNION ALL SELECT lang, array_to_string(w[2 : 3], ' '), a FROM candidate WHERE k = 3
  ) AS t ON c.k = 2 AND t.lang = c.lang AND t.phrase = c.phrase AND 100 * t.longer >= {COVERED} * c.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, total.n AS n, score::BIGINT AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= {LIMIT}
"""
