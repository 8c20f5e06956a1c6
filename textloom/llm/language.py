"""Language identification by unigram pieces, summed over all segmentations of each word."""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import arrow_fields, balanced, materialize, to_batch

VOCABULARY = "piece_bpe_32k.model"
# The model is fitted on at most about this many documents of each language.
SAMPLE_DOCS = 2000
ROUNDS = 3
# Forward sums are rescaled after this many letters, so that no probability underflows.
RESCALED = 8
SMOOTHING = 0.1
REMEMBERED = 200_000
UNDECIDED = "und"
MARK = "▁"  # fixed value: the word start of the vocabulary
LETTERS = re.compile(r"[^\W\d_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_pieces(path: str) -> list[str]:
    """Lower-case pieces of letters, with or without the word start, of a public vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = map(model.id_to_piece, range(model.get_piece_size()))
    kept = {p for p in names if p.lstrip(MARK).isalpha() and p.lower() == p}
    return sorted(p for p in kept if not p.startswith(MARK * 2))


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def marked(word: str) -> str:
    """The letters of a word after its start mark; empty without a letter."""
    letters = word if word.isalpha() else "".join(filter(str.isalpha, word))
    return MARK + letters if letters else ""


def has_letter(text_col: str) -> F.Column:
    """Whether any word of a text is spelled with letters; false for null."""

    @F.pandas_udf("boolean")
    def spelled(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: any(map(marked, words_of(t)))).astype(bool)

    return spelled(F.col(text_col))


def roll(value: np.ndarray, code: np.ndarray) -> np.ndarray:
    value = (value ^ code) * BASE
    return value ^ (value >> np.uint64(29))


class Lattice:
    """All pieces inside words of equal length, found by their hash."""

    def __init__(self, pieces: list[str]):
        hashes = np.zeros(len(pieces), np.uint64)
        for i, piece in enumerate(pieces):
            value = np.zeros(1, np.uint64)
            for c in piece:
                value = roll(value, np.array([ord(c)], np.uint64))
            hashes[i] = value[0]
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.longest = max(map(len, pieces), default=1)
        self.unknown = len(pieces)  # the id of any single character that is no piece

    def spans(self, words: list[str]) -> list[np.ndarray]:
        """Piece ids by length, start and word, -1 for none, of ``words`` of the same length."""
        n = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n)
        codes = codes.T.astype(np.uint64)
        found, value = [], np.zeros(codes.shape, np.uint64)
        for size in range(1, min(n, self.longest) + 1):
            value = roll(value[: n - size + 1], codes[size - 1 :])
            slot = np.minimum(np.searchsorted(self.hashes, value), len(self.hashes) - 1)
            none = self.unknown if size == 1 else -1
            found.append(np.where(self.hashes[slot] == value, self.order[slot], none).astype(np.int32))
        return found


def arcs(spans: list[np.ndarray]) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
    """By end: (start, words, piece ids) of the pieces that end there."""
    by_end: list[list] = [[] for _ in range(len(spans[0]) + 1)]
    for size, ids in enumerate(spans, 1):
        for start in np.flatnonzero((ids >= 0).any(axis=1)).tolist():
            at = np.flatnonzero(ids[start] >= 0)
            by_end[start + size].append((start, at, ids[start, at]))
    return by_end


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Words of one length together, at most 8,192 of them and about 260,000 letters."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        step = max(1, min(8192, (1 << 18) // int(n)))
        for part in np.split(at, range(step, len(at), step)):
            yield part, [words[i] for i in part]


def forward(ends: list[list], longest: int, rows: int, chance: np.ndarray, keep: bool) -> tuple:
    """Probability of each prefix by language: the sum over all ways to cut it into pieces.

    Returns (total, scale, last): a prefix has the probability ``total * exp(scale)``. With
    ``keep`` every prefix has its place, otherwise only as many as a piece can reach back over,
    used in turn. ``last`` is the logarithm for whole words.
    """
    n = len(ends) - 1
    size = n + 1 if keep else min(n, longest) + 1
    total = np.zeros((size, rows, chance.shape[1]))
    scale = np.zeros_like(total) if keep else None
    logs = np.zeros(total.shape[1:])
    total[0] = 1
    for end in range(1, n + 1):
        here = total[end % size]
        here[:] = 0
        for start, at, ids in ends[end]:
            if len(at) == rows:
                here += total[start % size] * chance[ids]
            else:
                here[at] += total[start % size, at] * chance[ids]
        if keep:
            scale[end] = logs
        if end % RESCALED == 0:
            recent = np.arange(max(0, end - longest + 1), end + 1) % size
            factor = here.copy()
            total[recent] /= factor
            logs += np.log(factor)
            if keep:
                scale[recent] += np.log(factor)
    return total, scale, np.log(total[n % size]) + logs


def word_scores(words: list[str], lattice: Lattice, chance: np.ndarray) -> np.ndarray:
    """Log-probability of each word by language."""
    scores = np.zeros((len(words), chance.shape[1]))
    for at, some in by_length(words):
        ends = arcs(lattice.spans(some))
        scores[at] = forward(ends, lattice.longest, len(some), chance, keep=False)[2]
    return scores


def expected_pieces(words: list[str], counts: np.ndarray, lattice: Lattice, chance: np.ndarray) -> np.ndarray:
    """Expected uses of each piece by language over all segmentations, weighted by ``counts``."""
    uses = np.zeros_like(chance)
    for at, some in by_length(words):
        n, rows = len(some[0]), len(some)
        ends = arcs(lattice.spans(some))
        before, scale, _ = forward(ends, lattice.longest, rows, chance, keep=True)
        behind = np.zeros_like(before)
        behind[n] = counts[at] / before[n]
        for end in range(n, 0, -1):  # all pieces that start here are done before those that end here
            for start, here, ids in ends[end]:
                weight = chance[ids] * behind[end, here]
                if n >= RESCALED:
                    weight *= np.exp(scale[start, here] - scale[end, here])
                behind[start, here] += weight
                np.add.at(uses, ids, before[start, here] * weight)
    return uses


def fit(labelled: DataFrame, path: str | None = None, sample_docs: int = SAMPLE_DOCS) -> dict:
    """Piece probabilities of each language by expectation maximisation.

    ``labelled`` has doc_id, text and lang (rows with a null are left out). The fit reads about
    ``sample_docs`` documents per language, chosen by a hash of their text; words are counted in
    Spark, each round is a pass over the counted words, and only one number per piece and
    language reaches the driver. Without any labelled text the model knows no language.
    """
    path = path or vocabulary_path()
    spark = labelled.sparkSession
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    pieces = load_pieces(path)
    if not langs:
        return {"langs": [], "pieces": pieces, "chance": np.ones((len(pieces) + 1, 0))}
    shares = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, sample_docs / sizes[k]))])
    drawn = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 30)) < shares[F.col("lang")] * (1 << 30)
    where = {lang: i for i, lang in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[int, str], int] = {}
            for text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                for word in words_of(text):
                    key = (where[lang], word)
                    seen[key] = seen.get(key, 0) + 1
            split: dict[tuple[int, str], int] = {}
            for (lang, word), n in seen.items():
                if part := marked(word):
                    split[lang, part] = split.get((lang, part), 0) + n
            keys = list(split)
            yield to_batch([[k[0] for k in keys], [k[1] for k in keys], list(split.values())], names, types)

    schema = "lang int, word string, n long"
    names, types = arrow_fields(spark, schema)
    words = rows.filter(drawn).mapInArrow(count, schema)
    words = materialize(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    size = len(pieces) + 1
    chance = np.full((size, len(langs)), 1.0 / size)
    for _ in range(ROUNDS):
        known = spark.sparkContext.broadcast((pieces, chance))

        def expect(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            lattice, current = Lattice(known.value[0]), known.value[1]
            total = np.zeros_like(current)
            for batch in batches:
                lang = batch.column(0).to_numpy()
                text, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
                counts = np.zeros((len(text), current.shape[1]))
                counts[np.arange(len(text)), lang] = n
                total += expected_pieces(text, counts, lattice, current)
            piece, spoken = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(spoken), pa.array(piece), pa.array(total[piece, spoken])], names=["lang", "piece", "uses"]
            )

        passed = words.mapInArrow(expect, "lang long, piece long, uses double")
        uses = np.full((size, len(langs)), SMOOTHING)
        for row in passed.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).collect():
            uses[row["piece"], row["lang"]] += row["uses"]
        chance = uses / uses.sum(axis=0)
    return {"langs": langs, "pieces": pieces, "chance": chance}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with lang_pred and score, read from the column ``text`` alone.

    The score is the posterior probability of the predicted language with equal priors, ties go
    to the first name. Null and empty texts and texts without a letter get ``und`` and 0. Long
    texts are scored whole; repeated rows are scored each.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    carried = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = T.StructType([docs.schema[c] for c in carried]).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(known.value)
        for batch in batches:
            names, scores = scorer.predict(batch.column(batch.schema.get_field_index("text")))
            columns = [batch.column(batch.schema.get_field_index(c)) for c in carried]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*carried, "lang_pred", "score"],
            )

    return docs.select(*carried).mapInArrow(run, schema)


class Scorer:
    def __init__(self, model: dict):
        self.langs, self.chance = model["langs"], model["chance"]
        self.lattice = Lattice(model["pieces"])
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.table = np.empty((0, len(self.langs)))
        self.spelled = np.empty(0, bool)

    def learn(self, words: list[str]) -> None:
        spelled = [marked(w) for w in words]
        known = np.fromiter(map(bool, spelled), bool, len(words))
        sums = np.zeros((len(words), len(self.langs)))
        sums[known] = word_scores([w for w in spelled if w], self.lattice, self.chance)
        first = len(self.table)
        self.place.update(zip(words, range(first, first + len(words))))
        self.table = np.concatenate([self.table, sums])
        self.spelled = np.concatenate([self.spelled, known])

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for at in range(0, len(texts), 1000):
            found = [words_of(t) for t in texts.slice(at, 1000).to_pylist()]
            new = list(set().union(*found).difference(self.place))
            if len(self.place) + len(new) > REMEMBERED:
                self._forget()
                new = list(set().union(*found))
            if new:
                self.learn(new)
            get = self.place.__getitem__
            for words in found:
                slots = np.fromiter(map(get, words), np.int64, len(words))
                if not self.langs or not self.spelled[slots].any():
                    names.append(UNDECIDED)
                    scores.append(0.0)
                    continue
                total = self.table[slots].sum(axis=0)
                best = int(total.argmax())
                names.append(self.langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
        return names, scores


def held_out(key, parts: int, part: int) -> F.Column:
    """crc32 of the id as text modulo ``parts`` is ``part``; a null id is not held out."""
    rest = F.crc32(F.col(key).cast("string").cast("binary")) % parts
    return F.coalesce(rest == part, F.lit(False))


def op6(docs: DataFrame) -> DataFrame:
    model = fit(docs.select("doc_id", "text", "lang").filter(~held_out("doc_id", 4, 2)))
    found = predict(balanced(docs.select("doc_id", "text")), model)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
