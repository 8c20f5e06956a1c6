"""Token counts of whole texts: lengths only, in batches of even size, long texts split safely."""

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import arrow_fields, balanced, by_bytes, to_batch

TOKENIZER = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
BATCH_BYTES = 3 << 20
# Distinct segments whose length is remembered in a task before the memory starts anew.
REMEMBERED = 200_000
MARK = "▁"  # fixed value: the visible space of the vocabulary
SEGMENT = re.compile(f"[ {MARK}]+[^ {MARK}]*")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Counter:
    """Token counts by a SentencePiece model whose pieces hold spaces only at their start.

    In such a model no merge crosses from another character to a space, so a text may be cut
    before every run of spaces that follows one; the constructor checks the model for it.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.splits = not any(MARK in p.lstrip(MARK) for p in pieces) and self._plain()
        self.known: dict[str, int] = {}

    def _plain(self) -> bool:
        """The model keeps every space and adds one in front."""
        sample = self.model.encode("a  b ", out_type=str)
        return "".join(sample) == f"{MARK}a{MARK * 2}b{MARK}"

    def segments(self, text: str) -> list[str]:
        """Parts of ``text`` without the space that the model adds to each."""
        if not text:
            return []
        if "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [s[1:] for s in SEGMENT.findall(" " + text)]

    def counts(self, texts: list[str]) -> list[int]:
        if not self.splits:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        if len(self.known) > REMEMBERED:
            self.known = {}
        parts = [self.segments(t) for t in texts]
        known = self.known
        known[""] = 1  # a space alone
        new = list(set().union(*parts).difference(known))
        for at in range(0, len(new), 10_000):
            some = new[at : at + 10_000]
            known.update(zip(some, map(len, self.model.encode(some, num_threads=1))))
        get = known.__getitem__
        return [sum(map(get, p)) for p in parts]


def count_tokens(docs: DataFrame, path: str | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text).

    Null and empty texts have no bytes and no tokens. Repeated rows are counted each. Texts are
    encoded in batches of about ``batch_bytes`` bytes; texts of any length are cut at
    spaces, where no merge can cross, and only lengths leave the task.
    """
    path = path or tokenizer_path()
    schema = "doc_id long, n_bytes long, n_tokens long"
    names, types = arrow_fields(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for ids, sizes, texts in by_bytes(batches, batch_bytes):
            yield to_batch([ids, sizes, counter.counts([t or "" for t in texts])], names, types)

    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return docs.select("doc_id", n_bytes.alias("n_bytes"), "text").mapInArrow(run, schema)


def op10(docs: DataFrame) -> DataFrame:
    counted = count_tokens(balanced(docs.select("doc_id", "text")))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
