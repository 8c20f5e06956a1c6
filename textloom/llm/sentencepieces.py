"""SentencePiece BPE encoding by vectorised merge rounds, and decoding."""

import codecs
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.bpe import spans
from textloom.llm.common import arrow_fields, balanced, by_bytes, to_batch

TOKENIZER = "piece_bpe_32k.model"
BATCH_BYTES = 3 << 20
# Distinct words whose ids are remembered in a task before the memory starts anew.
REMEMBERED = 200_000
MARK = "▁"  # fixed value: the visible space of the vocabulary
UNKNOWN = " ⁇ "  # fixed value: what the unknown id decodes to
SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")
# Words of more characters are cut where no piece can cross.
LONG = 64
NEVER = np.iinfo(np.int32).max


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("textloom-each-byte", _each_byte)


class Pieces:
    """Pieces and merge ranks of a SentencePiece BPE model, with a memory of encoded words.

    The model must have byte pieces and no user-defined or unused ones, keep text as it is but for
    spaces, which become ``MARK``, add one mark in front, and hold marks only at the start of
    pieces; the constructor checks this. No merge then crosses from another character to a mark.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(size)]
        normal = {p: i for i, p in enumerate(names) if not special[i]}
        sample = "a  b ﬁ①Ａ\r\n\té é  x　 "
        kept = "".join(p for p in model.encode(sample, out_type=str) if not p.startswith("<0x"))
        plain = "".join(c for c in MARK + sample.replace(" ", MARK) if c in normal)
        if kept != plain or any(map(model.is_unused, range(size))) or any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError(f"{path}: not a model that keeps its text, with marks in front of pieces")
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        if not all(map(model.is_byte, self.byte_id.tolist())):
            raise ValueError(f"{path}: no byte pieces")
        self._merges(model, normal)
        self._surfaces(model, names)
        self._forget()

    def _merges(self, model, normal: dict[str, int]) -> None:
        """Every way to join two symbols to a piece; pieces of equal score share a rank."""
        places = {p: i for p, i in normal.items()}
        for c in sorted({c for p in normal for c in p} - set(places)):
            places[c] = self.size + len(places)  # only ever a part of longer pieces
        chars = sorted(c for c in places if len(c) == 1)
        self.chars = np.array([ord(c) for c in chars], np.uint32)
        self.char_id = np.array([places[c] for c in chars], np.int64)
        scores = np.array([model.get_score(i) for i in normal.values()])
        rank = np.searchsorted(-np.unique(scores)[::-1], -scores).astype(np.int32)
        self.base = max(places.values()) + 1
        keys, merged, ranks = [], [], []
        for (piece, i), r in zip(normal.items(), rank.tolist()):
            for cut in range(1, len(piece)):
                a, b = places.get(piece[:cut]), places.get(piece[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.base + b)
                    merged.append(i)
                    ranks.append(r)
        order = np.argsort(np.array(keys, np.int64))
        self.pairs = np.array(keys, np.int64)[order]
        self.pair_piece, self.pair_rank = np.array(merged, np.int64)[order], np.array(ranks, np.int32)[order]
        near = {p[i : i + 2] for p in normal for i in range(len(p) - 1)}
        self.crossed = np.array(sorted((ord(x[0]) << 32) | ord(x[1]) for x in near), np.uint64)
        self.run = self._mark_block(normal, rank)

    def _mark_block(self, normal: dict[str, int], rank: np.ndarray) -> int:
        """Marks after which a run of marks may be cut, 0 if the model allows no such cut.

        If runs of marks merge after everything else, with equal ranks and so from the left, the
        longest piece of marks closes again and again, and what follows is a run of its own.
        """
        marks = {len(p) for p in normal if set(p) == {MARK}}
        most = max(marks, default=0)
        last = {r for p, r in zip(normal, rank.tolist()) if set(p) == {MARK} and len(p) > 1}
        others = [r for p, r in zip(normal, rank.tolist()) if len(p) > 1 and set(p) != {MARK}]
        mixed = any(p.startswith(MARK * 2) and p.strip(MARK) for p in normal)
        if most < 2 or len(last) != 1 or mixed or max(others, default=-1) >= min(last):
            return 0
        ids, counts = self.merge([MARK * n for n in range(1, 3 * most + 1)])
        runs = np.split(ids, np.cumsum(counts)[:-1])
        block = [normal[MARK * most]]
        closes = all(runs[n - 1].tolist() == block + runs[n - most - 1].tolist() for n in range(most + 1, 3 * most + 1))
        return most if closes and runs[most - 1].tolist() == block else 0

    def _surfaces(self, model, names: list[str]) -> None:
        self.marked = np.zeros(self.size, bool)
        self.silent = np.array([model.is_control(i) for i in range(self.size)])
        byte_of = {int(i): b for b, i in enumerate(self.byte_id)}
        data = []
        for i, p in enumerate(names):
            if i in byte_of:
                data.append(bytes([byte_of[i]]))
            elif model.is_unknown(i):
                data.append(UNKNOWN.encode())
            else:
                data.append(b"" if self.silent[i] else p.replace(MARK, " ").encode())
                self.marked[i] = not self.silent[i] and p.startswith(MARK)
        self.token_length = np.array([len(b) for b in data])
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)[:-1]])
        self.token_data = np.frombuffer(b"".join(data), np.uint8)

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.lengths = np.empty(0, np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of joining each pair of symbols; rank NEVER for pairs that make no piece."""
        key = left * self.base + right
        slot = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        real = (self.pairs[slot] == key) & (left >= 0) & (right >= 0)
        return np.where(real, self.pair_rank[slot], NEVER), self.pair_piece[slot]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and the number of ids of each.

        All words are one flat array of symbols. A round takes the smallest rank of each word, joins
        its pairs of that rank from the left, as many as the library would join before another
        pair's turn, and closes the gaps; finished words leave the arrays.
        """
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        slot = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        symbol = np.where(self.chars[slot] == points, self.char_id[slot], -1)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        place = np.arange(len(symbol))
        found: list[tuple[np.ndarray, ...]] = []
        rank, piece = self._ranks(symbol, word)
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(word)])
            least = np.minimum.reduceat(rank, starts)
            done = np.repeat(least == NEVER, sizes)
            if done.any():
                found.append((place[done], symbol[done], word[done]))
                symbol, word, place, rank, piece = (x[~done] for x in (symbol, word, place, rank, piece))
                least, sizes = least[least != NEVER], sizes[least != NEVER]
                if not len(symbol):
                    break
            at = self._leftmost(np.flatnonzero(rank == np.repeat(least, sizes)))
            at = at[self._before_others(at, symbol, word, rank, piece)]
            symbol[at] = piece[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))
            symbol, word, place, rank, piece = (x[keep] for x in (symbol, word, place, rank, piece))
            # Only pairs with a new symbol have changed.
            again = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[again], piece[again] = self._ranks_at(again, symbol, word)
        if not found:
            return np.empty(0, np.int32), np.zeros(len(words), np.int64)
        place, symbol, word = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(place)
        return self._with_bytes(points[place[order]], symbol[order], word[order], len(words))

    def _ranks(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._ranks_at(np.arange(len(symbol)), symbol, word)

    def _ranks_at(self, at: np.ndarray, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the pairs that begin at ``at``; the last symbol of a word has none."""
        after = np.minimum(at + 1, len(symbol) - 1)
        rank, piece = self.lookup(symbol[at], symbol[after])
        return np.where((after > at) & (word[at] == word[after]), rank, NEVER), piece

    @staticmethod
    def _leftmost(at: np.ndarray) -> np.ndarray:
        """Every second position of runs of overlapping pairs."""
        start = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
        within = np.arange(len(at)) - np.repeat(start, np.diff(np.r_[start, len(at)]))
        return at[within % 2 == 0]

    def _before_others(self, at, symbol, word, rank, piece) -> np.ndarray:
        """Which joins of a word come before a new pair of the same or a smaller rank arises."""
        n = len(symbol)
        made, owner = piece[at], word[at]
        joined = np.r_[False, at[1:] == at[:-1] + 2]
        before = np.where(joined, np.r_[-1, made[:-1]], symbol[np.maximum(at - 1, 0)])
        before = np.where((at > 0) & (word[np.maximum(at - 1, 0)] == owner), before, -1)
        follow = np.minimum(at + 2, n - 1)
        after = np.where((at + 2 < n) & (word[follow] == owner), symbol[follow], -1)
        sooner = (self.lookup(before, made)[0] <= rank[at]) | (self.lookup(made, after)[0] <= rank[at])
        earlier = np.cumsum(sooner) - sooner
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        return earlier == np.repeat(earlier[first], np.diff(np.r_[first, len(at)]))

    def _with_bytes(self, points, symbol, word, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols; characters that are no piece become their UTF-8 bytes."""
        known = (symbol >= 0) & (symbol < self.size)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        size = np.where(known, 1, width)
        ids = np.repeat(np.where(known, symbol, 0), size).astype(np.int32)
        others = points[~known].astype("<u4").tobytes().decode("utf-32-le").encode()
        ids[np.repeat(~known, size)] = self.byte_id[np.frombuffer(others, np.uint8)]
        return ids, np.bincount(word, weights=size, minlength=words).astype(np.int64)

    def segments(self, text: str) -> list[str]:
        """Parts of ``text`` that no merge crosses, with the mark that is added in front."""
        if not text:
            return []
        if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            parts = f"{MARK}{text.replace(' ', f' {MARK}')}".split(" ")
        else:
            parts = SEGMENT.findall(MARK + text.replace(" ", MARK))
        if len(text) > LONG and max(map(len, parts)) > LONG:
            return [p for part in parts for p in (self._cut(part) if len(part) > LONG else (part,))]
        return parts

    def _cut(self, part: str) -> list[str]:
        points = np.frombuffer(part.encode("utf-32-le"), np.uint32).astype(np.uint64)
        key = (points[:-1] << np.uint64(32)) | points[1:]
        slot = np.minimum(np.searchsorted(self.crossed, key), len(self.crossed) - 1)
        cuts = set((np.flatnonzero(self.crossed[slot] != key) + 1).tolist())
        marks = len(part) - len(part.lstrip(MARK))
        if self.run:
            cuts.update(range(self.run, marks, self.run))
        edges = [0, *sorted(cuts), len(part)]
        return [part[a:b] for a, b in zip(edges, edges[1:])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, with the begin and end id."""
        if len(self.place) > REMEMBERED:
            self._forget()
        parts = [self.segments(t) for t in texts]
        new = list(set().union(*parts).difference(self.place))
        if new:
            ids, counts = self.merge(new)
            first = len(self.lengths)
            self.place.update(zip(new, range(first, first + len(new))))
            self.ids, self.lengths = np.concatenate([self.ids, ids]), np.concatenate([self.lengths, counts])
        starts = np.cumsum(self.lengths) - self.lengths
        get, out = self.place.__getitem__, []
        for part in parts:
            slots = np.fromiter(map(get, part), np.int64, len(part))
            inner = self.ids[spans(starts[slots], self.lengths[slots])]
            out.append(np.concatenate([[self.begin], inner, [self.end]]).astype(np.int32))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: without control ids and the mark in front; bytes that are no UTF-8 replaced."""
        ids = ids[~self.silent[ids]]
        if not len(ids):
            return ""
        data = self.token_data[spans(self.token_start[ids], self.token_length[ids])].tobytes()
        return data[int(self.marked[ids[0]]) :].decode("utf-8", "textloom-each-byte")


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    """One model per worker process and file; its memory of words is bounded."""
    return Pieces(path)


def encode_pieces(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, [ids,] ids_sha256, decoded_sha256) of every row of (doc_id, text).

    The ids are the library's with begin and end id and without sampling; null and empty texts have
    these two alone. Strings of control pieces inside a text are ordinary text. Repeated rows are
    encoded each, an empty table gives no rows, and texts of any length are whole; other columns
    are not read. The ids' digest is over unsigned 32-bit little-endian integers.
    """
    path = path or tokenizer_path()
    schema = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"
    if not with_ids:
        schema = schema.replace("ids array<int>, ", "")
    names, types = arrow_fields(docs.sparkSession, schema)

    def digest(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path)
        for keys, texts in by_bytes(batches, BATCH_BYTES):
            found = model.encode([t or "" for t in texts])
            columns = [
                keys,
                [len(x) for x in found],
                [digest(x.astype("<u4").tobytes()) for x in found],
                [digest(model.decode(x).encode()) for x in found],
            ]
            if with_ids:
                columns.insert(2, found)
            yield to_batch(columns, names, types)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give the empty text."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path)
        for batch in batches:
            texts = [model.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def op11(docs: DataFrame) -> DataFrame:
    return encode_pieces(balanced(docs.select("doc_id", "text")), with_ids=False)
