"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at safe boundaries into words: at every ASCII space and line break.
There the vocabulary's pre-tokenizer always ends a word, white space itself yields
no token, no special string holds a space, and canonical composition never reaches
over a space, so the words' counts add up to the whole text's count. The words not
seen before are encoded in batches of about equal bytes, so a batch takes the same
memory whether it holds thousands of short texts or a part of a long one; counts of
words seen before come from a bounded cache.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from reelspark.llm.common import once, shipped, slices, text_of

BATCH_BYTES = 1 << 18
#: Words whose counts a worker keeps; beyond, it starts anew. Bounds its memory, not its results.
CACHE_WORDS = 1 << 20
#: Longer words aren't kept: with CACHE_WORDS, they would make the cache's bytes unbounded.
CACHED_CHARS = 64


def words_of(text: str) -> list[str]:
    """Parts of text that tokenize on their own."""
    return text.replace("\n", " ").split(" ")


def cut_at_blanks(content: bytes) -> bool:
    """Whether a vocabulary of the tokenizers library encodes the words of a text alone as within it.

    So it is if white space yields nothing and ends each word: the first step splits by
    blanks, or by a pattern of which only matches without blanks are kept; no step puts a
    space in front of a text, no special string holds a blank, and nothing is normalized
    across blanks.
    """
    told = json.loads(content)
    steps = told.get("pre_tokenizer") or {}
    steps = steps.get("pretokenizers", [steps])
    normal = told.get("normalizer") or {}
    normal = [x for x in normal.get("normalizers", [normal]) if x]
    first = steps[0]
    # a kept match of a class that names blanks only in a negated set holds none
    kept = first.get("pattern", {}).get("Regex", " ") if first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") else " "
    no_blank = not any(x in kept.replace("[^\\s", "[^") for x in (" ", "\\s", "\\W", "\\S", ".", "\\n"))
    splits = first.get("type") in ("WhitespaceSplit", "BertPreTokenizer") or no_blank
    prefixed = any(x.get("add_prefix_space") or x.get("type") == "Metaspace" or x.get("prepend_scheme") for x in steps)
    plain = all(x.get("type") in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") or x.get("type") == "Replace" and x.get("pattern") == {"Regex": "\\s+"} and x.get("content") == " " for x in normal)
    return splits and plain and not prefixed and not any(c.isspace() for x in told.get("added_tokens", ()) for c in x["content"])


def _tokenizer(content: bytes):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _sentencepiece(content: bytes):
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=content)


def _encoded(model, parts: list[str]) -> list[int]:
    """Tokens of each part, encoded BATCH_BYTES at a time."""
    counts: list[int] = []
    pieces = not hasattr(model, "encode_batch_fast")  # sentencepiece
    start, size = 0, 0
    for i, part in enumerate([*parts, ""]):
        size += len(part) if part.isascii() else len(part.encode())
        if i == len(parts) or size >= BATCH_BYTES:
            batch = parts[start : i + 1]
            counts += map(len, model.encode(batch, num_threads=1) if pieces else model.encode_batch_fast(batch, add_special_tokens=False))
            start, size = i + 1, 0
    return counts


def _lengths(model, texts: list[str], whole: bool, known: dict[str, int]) -> list[int]:
    """Tokens of each text; whole: without cuts; known: counts of words, added to."""
    if whole:  # words of sentencepiece and of many byte vocabularies reach over white space
        return _encoded(model, texts)
    split = [*map(words_of, texts)]
    unseen = [*set().union(*split).difference(known)]
    if len(known) + len(unseen) > CACHE_WORDS:
        known.clear()
        unseen = [*set().union(*split)]
    known.update(zip(unseen, _encoded(model, unseen)))
    counts = [sum(map(known.__getitem__, words)) for words in split]
    for word in unseen:
        if len(word) > CACHED_CHARS:
            del known[word]
    return counts


def count_tokens(df: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 2048) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) of every row of df; no row is dropped.

    vocabulary: a file of the tokenizers library (.json) or of sentencepiece (.model).
    No special tokens are added; special strings inside a text count as that library
    has it by default. Null and empty texts have 0 bytes and 0 tokens. A null id and
    repeated ids stay as they are, one output row for each input row. Other columns
    of df are not read, whatever their names; an empty df gives an empty result.
    """
    content, digest = shipped(df.sparkSession, vocabulary)
    pieces = vocabulary.endswith(".model")
    whole = pieces or not cut_at_blanks(content.value)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = once(digest, lambda: ((_sentencepiece if pieces else _tokenizer)(content.value), {}))
        for rows in slices(batches, 1, BATCH_BYTES):
            n_tokens = pa.array(_lengths(model, rows.column(1).to_pylist(), whole, known), pa.int64())
            n_bytes = pa.compute.cast(pa.compute.binary_length(rows.column(1)), pa.int64())
            yield pa.record_batch([rows.column(0), n_bytes, n_tokens, pa.compute.greater(n_tokens, max_tokens)], [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col].alias("_id"), text_of(text_col).alias("_text")).mapInArrow(lengths, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
