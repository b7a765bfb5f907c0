"""Encoding of whole texts with a public byte-level BPE from a local rank file."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.session import ship, spread

#: Folder of the vocabulary files, the same on every worker; a parameter of every function here.
TOKENIZER_DIR = "/opt/tokenizers"
# Fixed value: the published pre-splitting pattern of the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Texts longer than this are encoded in parts cut at safe places.
PART_CHARS = 16_384
# A place where no pre-token crosses whatever stands around it: after a visible character, before one space and a visible one.
_SAFE = regex.compile(r"(?<=\S)(?= \S)")


@lru_cache(maxsize=4)
def encoding(name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> tiktoken.Encoding:
    """The encoding of one rank file, without special tokens; loaded once a worker process."""
    with open(f"{folder}/{name}.tiktoken", "rb") as file:
        ranks = {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def parts_of(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters, cut only where no pre-token crosses."""
    begin = 0
    while len(text) - begin > size:
        cut = _SAFE.search(text, begin + size)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def encode(text: str | None, enc: tiktoken.Encoding) -> list[int]:
    """Ids of a text; none for a null or empty one. Texts of special tokens are ordinary text."""
    if not text:
        return []
    if len(text) <= PART_CHARS:
        return enc.encode_ordinary(text)
    return [i for part in parts_of(text) for i in enc.encode_ordinary(part)]


def decode(ids: list[int] | np.ndarray, enc: tiktoken.Encoding) -> bytes:
    """The bytes of ids; joined over all ids of a text they are its UTF-8, also where a character spans ids."""
    return b"".join(enc.decode_tokens_bytes([int(i) for i in ids]))


def token_ids(documents: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids): one row per document; a null and an empty text give an empty list.

    A map of two columns, without a shuffle where there are files enough.  Repeated rows each give theirs.
    """
    ship(documents.sparkSession)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(tokenizer, folder)
        for texts in batches:
            yield texts.map(lambda t: encode(t, enc))

    texts = spread(documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    return texts.select("doc_id", ids("text").alias("ids"))


def token_counts(documents: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens): the lengths alone, so that no ids leave the workers."""
    ship(documents.sparkSession)

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(tokenizer, folder)
        for texts in batches:
            yield texts.map(lambda t: len(encode(t, enc)))

    texts = spread(documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    return texts.select("doc_id", count("text").alias("n_tokens"))


def decoded_texts(encoded: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); bytes that are no UTF-8 (a cut character) become U+FFFD, null ids a null text."""
    ship(encoded.sparkSession)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(tokenizer, folder)
        for ids in batches:
            yield ids.map(lambda x: None if x is None else decode(x, enc).decode("utf-8", "replace"))

    return encoded.select("doc_id", text("ids").alias("text"))
