"""Byte-level BPE by a pair occurrence index, and decoding."""

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import arrow_fields, balanced, by_bytes, to_batch

TOKENIZER = "byte_bpe_50k.json"
BATCH_BYTES = 1 << 20
# Distinct pieces of text whose ids are remembered in a task before the memory starts anew.
REMEMBERED = 200_000
# White space of the pre-tokenizer, written out because Python's \s also takes control characters.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def split_pattern(letters: str, numbers: str, spaces: str) -> str:
    return (
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
        f"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


ANY_TEXT = regex.compile(split_pattern("\\p{L}", "\\p{N}", SPACES))
# The same for texts of the first 256 characters, about five times as fast.
LATIN_TEXT = re.compile(
    split_pattern("A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\t-\\r \x85\xa0")
)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def pieces_of(text: str) -> list[str]:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return ANY_TEXT.findall(text)
    return LATIN_TEXT.findall(text)


class ByteBpe:
    """Vocabulary and merges of a byte-level BPE file, with a memory of encoded pieces."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab = data["model"]["vocab"]
        added = {t["content"]: t["id"] for t in data["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        size = max([*vocab.values(), *added.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in added.items():
            self.token_bytes[i] = token.encode()
        self.token_length = np.array([len(b) for b in self.token_bytes])
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)[:-1]])
        self.token_data = np.frombuffer(b"".join(self.token_bytes), np.uint8)
        self.byte_id = np.array([vocab[c] for c in byte_characters()], np.int32)
        self.size = size
        pairs = np.array([vocab[a] * size + vocab[b] for a, b in merges], np.int64)
        self.pair_order = np.argsort(pairs)
        self.pairs = pairs[self.pair_order]
        self.left = np.array([vocab[a] for a, _ in merges], np.int32)
        self.right = np.array([vocab[b] for _, b in merges], np.int32)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.special = added
        names = sorted(added, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.texts: list[str] = []
        for token, i in self.special.items():
            self.place[token] = len(self.texts)
            self.texts.append(str(i))
            self.ids.append(np.array([i], np.int32))
            self.lengths.append(np.array([1]))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of symbols, -1 for pairs that do not merge."""
        key = left.astype(np.int64) * self.size + right
        slot = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[slot] == key) & (left >= 0) & (right >= 0), self.pair_order[slot], -1)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and the number of ids of each.

        All pieces form one list of symbols with links to their neighbours, cut at the piece
        ends. An index maps the rank of each pair to all its positions; the active ranks are
        taken in ascending order, every position that still holds the pair is merged, and the
        pairs that arise are added to the lists of their ranks.
        """
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        n = len(symbols)
        owner = np.repeat(np.arange(len(pieces)), lengths)
        after = np.arange(1, n + 1)
        before = np.arange(-1, n - 1)
        ends = np.cumsum(lengths) - 1
        after[ends] = n  # position n is a wall: symbol -1 on both sides
        before[np.concatenate([[0], ends[:-1] + 1])] = n
        symbols = np.concatenate([symbols, [-1]]).astype(np.int32)
        after, before = np.concatenate([after, [n]]), np.concatenate([before, [n]])

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(rank: np.ndarray, at: np.ndarray) -> None:
            real = rank >= 0
            rank, at = rank[real], at[real]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            lo = 0
            for hi in [*cuts.tolist(), len(rank)]:
                r = int(rank[lo])
                if r in index:
                    index[r].append(at[lo:hi])
                else:
                    index[r] = [at[lo:hi]]
                    heapq.heappush(active, r)
                lo = hi

        if n:
            everywhere = np.arange(n)
            add(self.ranks(symbols[:n], symbols[after[:n]]), everywhere)
        while active:
            r = heapq.heappop(active)
            held = index.pop(r)
            at = held[0] if len(held) == 1 else np.unique(np.concatenate(held))
            a, b = self.left[r], self.right[r]
            at = at[(symbols[at] == a) & (symbols[after[at]] == b)]
            if a == b and len(at) > 1:
                at = self._apart(at, after)
            if not len(at):
                continue
            gone = after[at]
            follow, ahead = after[gone], before[at]
            symbols[at] = self.merged[r]
            symbols[gone] = -2
            after[at] = follow
            before[follow] = at
            before[n] = after[n] = n
            # A neighbour that merged in the same step is seen with its new symbol from both sides.
            add(
                np.concatenate([self.ranks(symbols[ahead], symbols[at]), self.ranks(symbols[at], symbols[after[at]])]),
                np.concatenate([ahead, at]),
            )
        kept = np.flatnonzero(symbols[:n] >= 0)
        return symbols[kept], np.bincount(owner[kept], minlength=len(pieces))

    @staticmethod
    def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Every second position of runs in which each position's pair overlaps the next."""
        linked = np.concatenate([[False], after[at[:-1]] == at[1:]])
        start = np.flatnonzero(~linked)
        within = np.arange(len(at)) - np.repeat(start, np.diff(np.concatenate([start, [len(at)]])))
        return at[within % 2 == 0]

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not yet remembered."""
        ids, counts = self.merge([p.encode() for p in pieces])
        names = list(map(str, ids.tolist()))
        first = len(self.texts)
        self.place.update(zip(pieces, range(first, first + len(pieces))))
        ends = np.cumsum(counts).tolist()
        lo = 0
        for hi in ends:
            self.texts.append(",".join(names[lo:hi]))
            lo = hi
        self.ids.append(ids)
        self.lengths.append(counts)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Flat ids of all texts, the number of ids of each, and each text's ids as a string."""
        if len(self.texts) > REMEMBERED:
            self._forget()
        parts = [self.split(t) for t in texts]
        new = set().union(*parts).difference(self.place)
        if new:
            self.learn(list(new))
        get, spelled = self.place.__getitem__, self.texts.__getitem__
        lengths = np.concatenate(self.lengths)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        flat = np.concatenate(self.ids)
        self.ids, self.lengths = [flat], [lengths]
        out, sizes, strings = [], [], []
        for part in parts:
            slots = np.fromiter(map(get, part), np.int64, len(part))
            strings.append(",".join(map(spelled, slots.tolist())))
            out.append(flat[spans(starts[slots], lengths[slots])])
            sizes.append(len(out[-1]))
        return np.concatenate(out) if out else np.empty(0, np.int32), np.array(sizes, np.int64), strings

    def split(self, text: str) -> list[str]:
        if self.special_pattern is None or not any(s in text for s in self.special):
            return pieces_of(text)
        parts = []
        for part in self.special_pattern.split(text):
            parts.extend([part] if part in self.special else pieces_of(part))
        return parts

    def decode(self, ids: np.ndarray) -> str:
        """Text of a sequence of ids; bytes that are no UTF-8 become replacement characters."""
        data = self.token_data[spans(self.token_start[ids], self.token_length[ids])]
        return data.tobytes().decode("utf-8", "replace")


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all ranges, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def encode_texts(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, [ids,] ids_sha256, decoded_sha256) of every row of (doc_id, text).

    The ids are those of the tokenizer file without added markers; its special strings inside a
    text become their special ids. The decoded text comes from the ids and equals the text. Null
    and empty texts have no ids. Repeated rows are encoded each; texts of any length are whole.
    """
    path = path or tokenizer_path()
    schema = "doc_id long, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"
    if not with_ids:
        schema = schema.replace("ids array<int>, ", "")
    names, types = arrow_fields(docs.sparkSession, schema)

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path)
        for keys, texts in by_bytes(batches, BATCH_BYTES):
            flat, sizes, strings = bpe.encode([t or "" for t in texts])
            ends = np.cumsum(sizes)
            decoded = [digest(bpe.decode(flat[e - s : e])) for s, e in zip(sizes.tolist(), ends.tolist())]
            columns = [keys, pa.array(sizes), list(map(digest, strings)), decoded]
            if with_ids:
                offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                columns.insert(2, pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())))
            yield to_batch(columns, names, types)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give the empty text."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path)
        for batch in batches:
            rows = [np.array(x or [], np.int64) for x in batch.column(1).to_pylist()]
            texts = pa.array([bpe.decode(x) for x in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def op8(docs: DataFrame) -> DataFrame:
    return encode_texts(balanced(docs.select("doc_id", "text")), with_ids=False)
