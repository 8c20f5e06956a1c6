"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from textloom.llm import (
    bpe,
    centroids,
    decontaminate,
    embeddings,
    language,
    phrases,
    sentencepieces,
    sharding,
    simhash,
    substring,
    token_counts,
    toxicity,
    warc,
)
from textloom.llm.common import table


def query(function, *names):
    def run(spark, sf_dir):
        return function(*(table(spark, sf_dir, name) for name in names))

    return run


QUERIES = {
    "op1_simhash": query(simhash.op1, "documents"),
    "op2_warc": query(warc.op2, "pages"),
    "op3_sharding": query(sharding.op3, "documents"),
    "op4_substring_dedup": query(substring.op4, "documents"),
    "op5_embedding_dedup": query(embeddings.op5, "embeddings"),
    "op6_language_id": query(language.op6, "documents"),
    "op7_decontamination": query(decontaminate.op7, "documents", "benchmark"),
    "op8_bpe": query(bpe.op8, "documents"),
    "op9_toxicity": query(toxicity.op9, "documents", "labels"),
    "op10_token_counts": query(token_counts.op10, "documents"),
    "op11_sentencepiece": query(sentencepieces.op11, "documents"),
    "op12_phrases": query(phrases.op12, "documents"),
    "op13_centroids": query(centroids.op13, "embeddings"),
}
ORACLES = {
    "op2_warc": warc.ORACLE,
    "op4_substring_dedup": substring.ORACLE,
    "op5_embedding_dedup": embeddings.ORACLE,
    "op7_decontamination": decontaminate.ORACLE,
    "op12_phrases": phrases.ORACLE,
    "op13_centroids": centroids.ORACLE,
}
