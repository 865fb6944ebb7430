"""Exact token counts of whole texts by a two-tier, map-side lookup.

Tier one is a broadcast table of frequent pre-tokens and their lengths in tokens: the whole-word entries of the tokenizer's own
vocabulary, which its training ranked by frequency. Its size is bounded by the vocabulary file. Tier two is a cache in each worker,
bounded by an entry count, that the tokenizer library fills for everything else. No pre-token is ever shuffled.

Splitting at ASCII white space before the lookup is exact: the library's pre-tokens and special strings contain none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import binary, once, table

LIMIT_TOKENS = 2048
CACHE_ENTRIES = 200_000
#: The tokenizer's contractions; what remains of its splitting rule on lower-case ASCII.
ASCII_PRE_TOKEN = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x00-\x20\x7fa-z0-9]+")
PLAIN = re.compile(rb"[\x21-\x7e]+\Z")


def load(config: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(config)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def count_words(tokenizer, words: list[bytes]) -> list[int]:
    return [len(e.ids) for e in tokenizer.encode_batch([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]


def frequent_lengths(tokenizer) -> dict[bytes, int]:
    """Whole words of the vocabulary and the length the library gives each."""
    from tokenizers.decoders import ByteLevel

    back, words = ByteLevel(), []
    for entry in tokenizer.get_vocab():
        if entry.endswith("</w>"):
            word = back.decode([entry[:-4]])
            if word and not re.search(r"\s|�", word) and "<|" not in word:
                words.append(word.encode())
    return dict(zip(words, count_words(tokenizer, words), strict=True))


class TwoTier:
    """Token counts of chunks of non-space bytes: the broadcast table first, then this worker's cache."""

    def __init__(self, frequent: dict[bytes, int], tokenizer, most: int = CACHE_ENTRIES):
        self.frequent, self.tokenizer, self.most = frequent, tokenizer, most
        self.known: dict[bytes, int] = {}

    def _encode(self, pre_token: bytes) -> int:
        """One printable ASCII pre-token, which the byte-level step leaves as it is, by the library's model."""
        if (n := self.frequent.get(pre_token)) is None:
            n = len(self.tokenizer.model.tokenize(pre_token.decode()))
        return n

    def learn(self, chunks: list[bytes]) -> None:
        if len(self.known) + len(chunks) > self.most:
            self.known.clear()
        other = []
        for chunk in chunks:
            if (n := self.frequent.get(chunk)) is not None:
                self.known[chunk] = n
            elif PLAIN.match(chunk) and b"<|" not in chunk:
                self.known[chunk] = sum(map(self._encode, ASCII_PRE_TOKEN.findall(chunk.lower())))
            else:
                other.append(chunk)
        self.known.update(zip(other, count_words(self.tokenizer, other), strict=True))

    def count(self, text: bytes) -> int:
        words = (text if b"<|" in text else text.lower()).split()
        distinct = set(words)
        if new := [w for w in distinct if w not in self.known]:
            self.learn(new)
            if len(new) < len(distinct) and not self.known.keys() >= distinct:  # the cache started afresh on this text
                self.learn([w for w in distinct if w not in self.known])
        return sum(map(self.known.__getitem__, words))


def token_counts(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT_TOKENS) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids keep their rows; other columns are ignored; an empty
    table gives an empty result. No truncation: a very long text is counted whole.
    """
    config = Path(tokenizer_file).read_text()
    frequent = frequent_lengths(load(config))
    shared = docs.sparkSession.sparkContext.broadcast((config, b"\n".join(frequent), bytes(frequent.values())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tiers = once(shared.value, lambda v: TwoTier(dict(zip(v[1].split(b"\n"), v[2], strict=True)), load(v[0])))
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in binary(batch.column(1)):
                n_bytes.append(len(text or b""))
                n_tokens.append(tiers.count(text) if text else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
