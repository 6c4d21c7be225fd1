"""Queries against their SQL, and the pipeline against its parts worked out by hand."""

import hashlib

import base64
import duckdb
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from reelspark.llm import decontamination, pii, queries, simhash

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    found = queries.QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(map(repr, map(tuple, found.select(columns).collect()))) == sorted(map(repr, want))


def test_each_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    said = spark.read.parquet(f"{DATA}/documents.parquet")
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    odd = spark.createDataFrame([(10_001, "12 34 !", "en", "s", 7), (10_002, None, "en", "s", 0), (10_003, f"Zz top. {item}", "en", "s", 5), (10_004, "Write to one@two.org about the tion and thing of it", None, None, None), (None, "a text of the tion without an id", "en", "s", 1)], said.schema)
    docs = said.unionByName(odd).unionByName(said.limit(1))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, DATA).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = [r.doc_id for r in docs.collect()]
        if name != "byte_bpe":
            assert docs.columns == said.columns
        if name == "language_id":
            assert {r.doc_id for r in before.collect()} - set(kept[name]) == {10_001, 10_002}
        elif name == "simhash_near_dedup":
            # against all pairs of sets of five-word shingles
            rows = [(r.doc_id, frozenset(simhash.shingle_hashes((r.text or "").encode(), 5).tolist())) for r in before.collect()]
            group = {p: p for _, p in rows}
            for p in group:
                for q in group:
                    if len(p & q) >= 0.8 * len(p | q) and group[p] != group[q]:
                        old, new = group[p], group[q]
                        group = {k: new if v == old else v for k, v in group.items()}
            first = {}
            for i, p in rows:
                first[group[p]] = min((i is None, i), first.get(group[p], (True, None)), key=lambda x: (x[0], x[1] or 0))
            assert sorted(kept[name], key=lambda x: (x is None, x or 0)) == [x for _, x in sorted(first.values(), key=lambda x: (x[0], x[1] or 0))] and None in kept[name]
        elif name == "benchmark_decontamination":
            hits = decontamination.hit_words(before, spark.read.parquet(f"{DATA}/benchmark.parquet")).filter(F.size("spans") > 0)
            assert set(x for x in (r.doc_id for r in before.collect())) - set(kept[name]) == {r.doc_id for r in hits.collect()} and 10_003 not in kept[name]
        elif name == "pii":
            assert len(kept[name]) == before.count()
            old, new = ({r.doc_id: r.text for r in x.collect()} for x in (before, docs))
            import re

            assert "one@two.org" not in new[10_004] and all(old[i] == new[i] for i in old if not re.search(pii.MAYBE.replace(r"\p{Lu}", "[A-Z]"), old[i]))
        else:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
            own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
            texts = {r.doc_id: r.text for r in before.collect()}
            for r in docs.collect():
                assert r.ids == own.encode_ordinary(texts[r.doc_id]) and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert corpus_pipeline.run(spark, DATA).count() > 0
