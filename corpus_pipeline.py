"""A corpus pipeline out of five operators: from raw documents to token ids.

Each stage takes the documents that the one before kept and returns documents with the
same columns, the last one tokens. A document is told by its id and its text, so a null
id or one that repeats takes no other document along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark.llm import byte_bpe, decontamination, language_id, near_copies, pii
from reelspark.llm.common import checkpoint, table

#: Documents whose main language has a smaller part of the words are rejected.
MIN_SHARE = 0.3
#: Stands for a secret that a real run takes from its environment.
PII_KEY = "a key for tests"


def _identity() -> Column:
    return F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash"))


def _first_row(docs: DataFrame, columns: list[str]) -> Column:
    """Of a group's rows the one of the smallest text; ties go by the other columns, those without an order as JSON."""

    def ordered(name: str) -> Column:
        plain = "map<" not in docs.schema[name].dataType.simpleString() and docs.schema[name].dataType.simpleString() not in ("variant", "calendar_interval")
        return F.col(f"`{name}`") if plain else F.to_json(F.struct(F.col(f"`{name}`")))

    return F.min_by(F.struct(*[F.col(f"`{c}`") for c in columns]), F.struct("text", *[ordered(c) for c in columns if c != "text"]))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without letters or without a main language go.

    The model is learnt from all documents with a lang. If none has one, nothing is known and all go.
    """
    model = language_id.fit(docs)
    held = docs.select(*[F.col(c).alias(f"doc {c}") for c in docs.columns])
    found = language_id.identify(held, model, id_col="doc doc_id", text_col="doc text", also=tuple(c for c in held.columns if c != "doc doc_id"))
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_SHARE)
    return found.filter(known).select(*[F.col(f"`doc {c}`").alias(c) for c in docs.columns])


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies: five-word shingles, a similarity of 0.8 or more, and what links chain.

    Rows of one id are one document: of its texts the one of the least hash stays, once.
    Null texts count as empty; other columns may have any name and type. Of a group
    without any id, one row stays, again that of the least hash.
    """
    found = near_copies.near_copies(docs.select("doc_id", "text"))
    first = found.groupBy("_component").agg(F.min(F.struct(F.col("_id").isNull().alias("nameless"), F.col("_id").alias("id"), F.col("_hash").alias("hash"))).alias("_first"))
    kept = first.select(F.col("_first.id").alias("_id"), F.col("_first.hash").alias("_hash"))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    told = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]) & (told == kept["_hash"]), "left_semi")
    one = rows.groupBy("doc_id", told.alias("_told")).agg(_first_row(docs, ["text", *others]).alias("_row"))
    return one.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    A null text has no words and stays, as does everything if the benchmark is empty; of
    rows with one id those go whose own text has a passage. Columns may have any name.
    """
    keyed = docs.select(_identity().alias("_identity"), F.col("text").alias("_text"))
    hits = decontamination.hit_words(keyed, table(spark, sf_dir, "benchmark"), id_col="_identity", text_col="_text")
    hit = hits.filter(F.size("spans") > 0).select(F.col("_identity.doc_id").alias("_id"), F.col("_identity.text_hash").alias("_hash")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_id"]) & (F.xxhash64(docs["text"]) == hit["_hash"]), "left_anti")


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for private data; n_chars follows the text.

    All rows stay, repeated ones too, with all their columns; a null text stays null.
    """
    done = pii.replace_entities(docs, PII_KEY)
    return done.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document; null texts count as empty, rows may repeat."""
    return byte_bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True)


STAGES = [
    ("language_id", keep_known_languages),
    ("simhash_near_dedup", keep_one_of_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", replace_private),
    ("byte_bpe", encode),
]

#: SQL has no model of languages, hashes of shingles, surrogates or merges by rank.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after the other, over the documents of sf_dir; each result is written once."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = checkpoint(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
